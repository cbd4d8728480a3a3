"""Model evaluation reports. Every report is a handful of partial aggregates over one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.features import _c
from leaksafe.operators.windows import global_rank

EPS = 1e-7


def _group(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by)


def regression_columns(actual, pred) -> list[Column]:
    """n, rmse, mae, bias (mean of actual − predicted, so positive means under-prediction), r2, sds."""
    a, p = _c(actual).cast("double"), _c(pred).cast("double")
    r = a - p
    total = F.count(a) * F.var_pop(a)
    return [
        F.count(r).alias("n"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
        F.avg(r).alias("bias"),
        F.when(total > 0, 1 - F.sum(r * r) / total).alias("r2"),
        F.stddev_samp(p).alias("sd_pred"),
        F.stddev_samp(a).alias("sd_actual"),
    ]


def regression(df: DataFrame, actual, pred, by: Sequence[str] = ()) -> DataFrame:
    return _group(df, by).agg(*regression_columns(actual, pred))


def classification(df: DataFrame, actual, prob, by: Sequence[str] = ()) -> DataFrame:
    """Log-loss (clamped), Brier, accuracy at 0.5, majority baseline and lift."""
    a, p = _c(actual).cast("double"), _c(prob).cast("double")
    clamped = F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS)))
    rate = F.avg(a)
    right = F.when(a.isNotNull() & p.isNotNull(), F.when((p >= 0.5).cast("double") == a, 1.0).otherwise(0.0))
    accuracy, baseline = F.avg(right), F.greatest(rate, 1 - rate)
    return _group(df, by).agg(
        F.count(a).alias("n"),
        (-F.avg(a * F.log(clamped) + (1 - a) * F.log(1 - clamped))).alias("logloss"),
        F.avg((a - p) * (a - p)).alias("brier_score"),
        accuracy.alias("accuracy"),
        baseline.alias("baseline_acc"),
        (accuracy - baseline).alias("accuracy_lift"),
        F.avg(p).alias("mean_pred_prob"),
        rate.alias("actual_win_rate"),
    )


def calibration(df: DataFrame, actual, prob, bins: int = 10) -> DataFrame:
    """Mean prediction against actual rate in `bins` equal, right-closed bins; the first holds 0."""
    a, p = _c(actual).cast("double"), _c(prob).cast("double")
    known = df.select(a.alias("__a"), p.alias("__p")).filter(F.col("__a").isNotNull() & F.col("__p").isNotNull())
    bin_ = F.greatest(F.lit(1), F.ceil(F.col("__p") * bins)).cast("int")
    out = known.groupBy(bin_.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("__p").alias("mean_pred"), F.avg("__a").alias("actual_rate")
    )
    label = F.concat(F.round(F.col("mean_pred") * 100).cast("int").cast("string"), F.lit("%"))
    return out.withColumns({"calibration_error": F.col("actual_rate") - F.col("mean_pred"), "bin_label": label})


def expected_calibration_error(table: DataFrame) -> DataFrame:
    """ECE of a calibration table: absolute errors weighted by bin size."""
    return table.agg((F.sum(F.col("n") * F.abs("calibration_error")) / F.sum("n")).alias("ece"))


def residuals(df: DataFrame, targets: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Sample sd, MAE and bias of the residuals of each target `{name: (actual, pred)}`, in one row."""
    out = []
    for name, (actual, pred) in targets.items():
        r = _c(actual) - _c(pred)
        out += [
            F.stddev_samp(r).alias(f"{name}_sd"),
            F.avg(F.abs(r)).alias(f"{name}_mae"),
            F.avg(r).alias(f"{name}_bias"),
            F.count(r).alias(f"{name}_n"),
        ]
    return df.agg(*out)


def by_segment(df: DataFrame, actual, pred, segments: Mapping[str, object]) -> DataFrame:
    """Regression metrics overall and per label of each segmentation `{name: label column}`, in one pass.

    Rows whose label is NULL are left out of that segmentation.
    """
    labels = [F.struct(F.lit("overall").alias("segment"), F.lit("overall").alias("label"))]
    labels += [F.struct(F.lit(n).alias("segment"), _c(c).cast("string").alias("label")) for n, c in segments.items()]
    rows = df.select(_c(actual).alias("__a"), _c(pred).alias("__p"), F.explode(F.array(*labels)).alias("__s"))
    rows = rows.select("__a", "__p", "__s.*").filter(F.col("label").isNotNull())
    return rows.groupBy("segment", "label").agg(*regression_columns("__a", "__p"))


def by_sets(df: DataFrame, actual, pred, dims: Mapping[str, object], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Regression metrics for several groupings at once, `()` for all rows, in one pass over the input.

    `grouping` names the columns a row is grouped by; columns it is not grouped by are NULL, as are labels that are.
    """
    labels = {f"__d{i}": _c(c).cast("string") for i, c in enumerate(dims.values())}
    place = dict(zip(dims, labels, strict=True))
    rows = df.select(_c(actual).alias("__a"), _c(pred).alias("__p"), *[c.alias(n) for n, c in labels.items()])
    grouped = rows.groupingSets([[place[d] for d in s] for s in sets], *[F.col(c) for c in labels])
    flags = [F.grouping(c).alias(f"__g{c}") for c in labels]
    out = grouped.agg(*regression_columns("__a", "__p"), *flags)
    names = F.concat_ws("+", *[F.when(F.col(f"__g{c}") == 0, F.lit(d)) for d, c in place.items()])
    metrics = [c for c in out.columns if not c.startswith("__")]
    return out.select(names.alias("grouping"), *[F.col(c).alias(d) for d, c in place.items()], *metrics)


def by_period(df: DataFrame, actual, pred, period: str, line: str | None = None) -> DataFrame:
    """Regression metrics per period, and how often prediction and outcome fall on the same side of the line."""
    a, p = _c(actual), _c(pred)
    known = df.filter(a.isNotNull() & p.isNotNull())
    columns = [c for c in regression_columns(actual, pred)[:5]]
    if line is not None:
        edge = -_c(line)
        same = F.when(edge.isNotNull(), F.when((a > edge) == (p > edge), 1.0).otherwise(0.0))
        columns.append(F.avg(same).alias("agreement_rate"))
    return known.groupBy(period).agg(*columns)


def ledger(
    df: DataFrame,
    actual,
    line,
    p_a,
    p_b,
    edge: float = 0.0,
    win: float = 100.0,
    lose: float = 110.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Record and return of betting the side whose probability clears 0.5 + edge / 2.

    Side a wins when `actual > line`, side b when `actual < line`; equality is a push. For a
    spread pass the negated line. Rows where no side qualifies are games but not bets.
    """
    a, l, pa, pb = _c(actual), _c(line), _c(p_a), _c(p_b)
    known = df.filter(a.isNotNull() & l.isNotNull() & pa.isNotNull())
    side = F.when(pa > 0.5 + edge / 2, F.lit("a")).when(pb > 0.5 + edge / 2, F.lit("b"))
    won = F.when((side == "a") & (a > l) | (side == "b") & (a < l), 1).when(side.isNotNull() & (a != l), 0)
    rows = known.select(*by, won.alias("__won"), (a == l).cast("int").alias("__push"), side.alias("__side"))
    n_bets, n_won = F.count("__won"), F.coalesce(F.sum("__won"), F.lit(0))
    profit = n_won * win - (n_bets - n_won) * lose
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_games"),
        n_bets.alias("n_bets"),
        n_won.alias("n_won"),
        (n_bets - n_won).alias("n_lost"),
        F.coalesce(F.sum("__push"), F.lit(0)).alias("n_push"),
        F.count(F.when(F.col("__side").isNull(), 1)).alias("n_no_bet"),
        F.avg(F.col("__won").cast("double")).alias("win_pct"),
        profit.alias("profit"),
        F.when(n_bets > 0, profit / (n_bets * lose)).alias("roi"),
        F.lit(lose / (win + lose)).alias("breakeven_wp"),
    )


def _line_rows(df: DataFrame, pred, open_, close) -> DataFrame:
    p, o, c = _c(pred), _c(open_), _c(close)
    known = df.filter(p.isNotNull() & o.isNotNull() & c.isNotNull())
    return known.withColumns(
        {
            "__move": o - c,
            "__size": F.abs(o - c),
            "__agree": ((p > -o) == (c < o)).cast("double"),
            "__edge": p + o,
        }
    )


def line_value(df: DataFrame, pred, open_, close) -> DataFrame:
    """How often the model sides with the later move of the line, in one row."""
    return _line_rows(df, pred, open_, close).agg(
        F.count(F.lit(1)).alias("n_games"),
        F.avg("__agree").alias("pct_agree_with_market"),
        F.avg("__move").alias("mean_line_movement"),
        F.avg("__size").alias("mean_abs_movement"),
        F.avg("__edge").alias("mean_model_vs_opening"),
    )


def line_value_tiles(df: DataFrame, pred, open_, close, tie: Sequence[str], tiles: int = 4) -> DataFrame:
    """The same agreement per tile of movement size: exact tiles over the whole frame, by `global_rank`."""
    rows = global_rank(_line_rows(df, pred, open_, close).select("__size", "__agree", *tie), ["__size", *tie], "__rn", "__all")
    base, extra = F.floor(F.col("__all") / tiles), F.col("__all") % tiles  # the first `extra` tiles hold one row more
    wide = extra * (base + 1)
    tile = F.when(F.col("__rn") <= wide, F.ceil(F.col("__rn") / (base + 1))).otherwise(
        extra + F.ceil((F.col("__rn") - wide) / F.greatest(base, F.lit(1)))
    )
    return rows.groupBy(tile.cast("int").alias("movement_tile")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("__agree").alias("pct_agree"),
        F.avg("__size").alias("mean_movement"),
    )


def attach_actuals(predictions: DataFrame, actuals: DataFrame, id: str, cols: Sequence[str], suffix: str = "_actual"):
    """Left join the outcomes of scored rows by id; names already taken get the suffix."""
    side = actuals.select(id, *[F.col(c).alias(c + suffix if c in predictions.columns else c) for c in cols])
    return predictions.join(side, id, "left")


def report(
    df: DataFrame,
    *,
    regressions: Mapping[str, tuple[str, str]],
    classifications: Mapping[str, tuple[str, str]] | None = None,
    segments: Mapping[str, object] | None = None,
    period: str | None = None,
    line: str | None = None,
    spread: tuple[str, str, str, str] | None = None,
    total: tuple[str, str, str, str] | None = None,
    lines: tuple[str, str, str] | None = None,
    tie: Sequence[str] = (),
    edges: Sequence[float] = (0.0, 0.05),
) -> dict[str, DataFrame]:
    """All reports of one split as frames by name; write them with `write_report`.

    `spread` and `total` are (actual, line, p_a, p_b) for the ledgers, `lines` is
    (pred, open, close). Cache the input if several reports are written.
    """
    out = {}
    for name, (a, p) in regressions.items():
        out[f"accuracy_{name}"] = regression(df, a, p)
    out["residuals"] = residuals(df, regressions)
    for name, (a, p) in (classifications or {}).items():
        out[f"accuracy_{name}"] = classification(df, a, p)
        out[f"calibration_{name}"] = calibration(df, a, p)
        out[f"ece_{name}"] = expected_calibration_error(out[f"calibration_{name}"])
    first_actual, first_pred = next(iter(regressions.values()))
    if segments:
        out["segments"] = by_segment(df, first_actual, first_pred, segments)
    if period:
        out["by_period"] = by_period(df, first_actual, first_pred, period, line)
    for edge in edges:
        tag = "all" if edge == 0 else f"edge_{edge:g}"
        if spread:
            out[f"spread_ledger_{tag}"] = ledger(df, spread[0], -_c(spread[1]), spread[2], spread[3], edge)
        if total:
            out[f"total_ledger_{tag}"] = ledger(df, *total, edge)
    if lines:
        out["line_value"] = line_value(df, *lines)
        if tie:
            out["line_value_tiles"] = line_value_tiles(df, *lines, tie=tie)
    return out
