"""Score scenarios: N reproducible normal draws per row and their summary.

Draws come from a counter-based integer hash of (id, draw, seed), so a lost executor or a
different partitioning reproduces them. `summarise` works inside each Arrow batch: no row
leaves its partition and nothing is shuffled. `expand` gives the same draws as rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.odds import ev

MARGIN_SD = 13.5
TOTAL_SD = 11.0
N_DRAWS = 10_000
MASK = 0x7FFFFFFF
# Odd multipliers of a two-round 31-bit integer mixer, and one offset per uniform stream.
MULTIPLIERS = (0x45D9F3B, 0x119DE1F3)
STREAMS = (0x1F123BB5, 0x2C1B3C6D, 0x297A2D39, 0x0B55A4F0)
DRAW_STEP = 0x1E3779B1
CHUNK_CELLS = 2_000_000

SUMMARY = (
    "p_home_win double, p_away_win double, p_home_cover double, p_away_cover double, p_over double, p_under double, "
    "margin_p10 double, margin_p25 double, margin_p50 double, margin_p75 double, margin_p90 double, "
    "margin_sim_sd double, total_p10 double, total_p50 double, total_p90 double, "
    "p_home_win_ci_lo double, p_home_win_ci_hi double, n_sims int"
)


def _mix(x):
    for multiplier in MULTIPLIERS:
        x = x ^ (x >> 16)
        x = (x * multiplier) & MASK
    return x ^ (x >> 15)


def _draws(ids: np.ndarray, n: int, seed: int):
    """Two standard normals per (id, draw): arrays of shape (len(ids), n)."""
    start = _mix((ids & MASK) ^ _mix(((ids >> 31) + seed) & MASK))[:, None]
    counter = (np.arange(n, dtype=np.int64) * DRAW_STEP) & MASK
    u = [(_mix(_mix(start ^ ((counter + s) & MASK))) + 0.5) / 2147483648.0 for s in STREAMS]
    return (
        np.sqrt(-2 * np.log(u[0])) * np.cos(2 * np.pi * u[1]),
        np.sqrt(-2 * np.log(u[2])) * np.cos(2 * np.pi * u[3]),
    )


def _share(hit: np.ndarray, line: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(line), np.nan, hit.mean(axis=1))


def _summary(ids, mu_margin, mu_total, spread, total, n, seed, sd_margin, sd_total) -> pd.DataFrame:
    z_margin, z_total = _draws(ids, n, seed)
    margins = mu_margin[:, None] + sd_margin * z_margin
    totals = mu_total[:, None] + sd_total * z_total
    home = np.maximum((totals + margins) / 2, 0)
    away = np.maximum((totals - margins) / 2, 0)
    margin, points = home - away, home + away
    p = (margin > 0).mean(axis=1)
    half = 1.96 * np.sqrt(p * (1 - p) / n)
    m = np.quantile(margin, [0.10, 0.25, 0.50, 0.75, 0.90], axis=1)
    t = np.quantile(points, [0.10, 0.50, 0.90], axis=1)
    return pd.DataFrame(
        {
            "p_home_win": p,
            "p_away_win": (margin < 0).mean(axis=1),
            "p_home_cover": _share(margin > -spread[:, None], spread),
            "p_away_cover": _share(margin < -spread[:, None], spread),
            "p_over": _share(points > total[:, None], total),
            "p_under": _share(points < total[:, None], total),
            "margin_p10": m[0], "margin_p25": m[1], "margin_p50": m[2], "margin_p75": m[3], "margin_p90": m[4],
            "margin_sim_sd": margin.std(axis=1, ddof=1),
            "total_p10": t[0], "total_p50": t[1], "total_p90": t[2],
            "p_home_win_ci_lo": p - half,
            "p_home_win_ci_hi": p + half,
            "n_sims": n,
        }
    )


def summarise(
    df: DataFrame,
    id: str,
    mu_margin: str,
    mu_total: str,
    spread: str | Column | None = None,
    total: str | Column | None = None,
    *,
    sd_margin: float = MARGIN_SD,
    sd_total: float = TOTAL_SD,
    n: int = N_DRAWS,
    seed: int = 0,
) -> DataFrame:
    """Add win, cover and over shares, quantiles and an interval per row.

    Scores are (total ± margin) / 2 clipped at 0 and the margin is taken again afterwards.
    `id` must be an integer column; a missing line gives NULL shares for it.
    """

    def batch(ids: pd.Series, mm: pd.Series, mt: pd.Series, sp: pd.Series, tl: pd.Series) -> pd.DataFrame:
        step = max(1, CHUNK_CELLS // n)
        columns = [s.to_numpy(dtype="float64", na_value=np.nan) for s in (mm, mt, sp, tl)]
        keys = ids.to_numpy(dtype="int64")
        parts = [
            _summary(keys[i : i + step], *[c[i : i + step] for c in columns], n, seed, sd_margin, sd_total)
            for i in range(0, len(keys), step)
        ]
        # A row without a predicted margin or total has no distribution.
        out = pd.concat(parts, ignore_index=True)
        shares = [c for c in out.columns if c != "n_sims"]
        out.loc[np.isnan(columns[0]) | np.isnan(columns[1]), shares] = np.nan
        return out  # NaN arrives as NULL

    simulate = F.pandas_udf(batch, SUMMARY)
    as_double = [
        F.lit(None).cast("double") if c is None else (F.col(c) if isinstance(c, str) else c).cast("double")
        for c in (mu_margin, mu_total, spread, total)
    ]
    result = df.withColumn("__s", simulate(F.col(id).cast("bigint"), *as_double))
    return result.select(*df.columns, "__s.*")


def _mix_steps(df: DataFrame, name: str) -> DataFrame:
    for multiplier in MULTIPLIERS:
        df = df.withColumn(name, F.col(name).bitwiseXOR(F.shiftright(name, 16)))
        df = df.withColumn(name, (F.col(name) * multiplier).bitwiseAND(F.lit(MASK)))
    return df.withColumn(name, F.col(name).bitwiseXOR(F.shiftright(name, 15)))


def expand(
    df: DataFrame,
    id: str,
    mu_margin: str,
    mu_total: str,
    *,
    sd_margin: float = MARGIN_SD,
    sd_total: float = TOTAL_SD,
    n: int = N_DRAWS,
    seed: int = 0,
) -> DataFrame:
    """The draws as rows: `draw`, `home_points`, `away_points`, `margin`, `points`."""
    mask = F.lit(MASK)
    key = F.col(id).cast("bigint")
    out = df.withColumn("__hi", (F.shiftright(key, 31) + seed).bitwiseAND(mask))
    out = _mix_steps(out, "__hi").withColumn("__start", key.bitwiseAND(mask).bitwiseXOR(F.col("__hi")))
    out = _mix_steps(out, "__start")
    out = out.withColumn("draw", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    out = out.withColumn("__counter", (F.col("draw") * DRAW_STEP).bitwiseAND(mask))
    for i, stream in enumerate(STREAMS):
        u = f"__u{i}"
        out = out.withColumn(u, F.col("__start").bitwiseXOR((F.col("__counter") + stream).bitwiseAND(mask)))
        out = _mix_steps(_mix_steps(out, u), u).withColumn(u, (F.col(u) + 0.5) / 2147483648.0)

    def normal(a: str, b: str) -> Column:
        return F.sqrt(F.lit(-2.0) * F.log(F.col(a))) * F.cos(F.lit(2 * np.pi) * F.col(b))

    margin = F.col(mu_margin) + sd_margin * normal("__u0", "__u1")
    points = F.col(mu_total) + sd_total * normal("__u2", "__u3")
    zero = F.lit(0.0)
    out = out.withColumns({"__m": margin, "__t": points})
    out = out.withColumns(
        {
            "home_points": F.greatest((F.col("__t") + F.col("__m")) / 2, zero),
            "away_points": F.greatest((F.col("__t") - F.col("__m")) / 2, zero),
        }
    )
    return out.select(
        *df.columns, "draw", "home_points", "away_points",
        (F.col("home_points") - F.col("away_points")).alias("margin"),
        (F.col("home_points") + F.col("away_points")).alias("points"),
    )


def with_ev(df: DataFrame, american: int | str = -110, *, win_prob: str | None = None, market_prob: str | None = None):
    """Add expected value and ROI of each side, and the edge over the market where both are known."""
    price = F.lit(american) if isinstance(american, int) else F.col(american)
    added = {}
    for out, prob in (
        ("spread_home", "p_home_cover"), ("spread_away", "p_away_cover"), ("over", "p_over"), ("under", "p_under"),
    ):
        value = ev(prob, price).getField("ev")
        added[f"ev_{out}"] = value
        added[f"roi_{out}"] = value / 100
    edge = F.col(win_prob) - F.col(market_prob) if win_prob and market_prob else F.lit(None).cast("double")
    return df.withColumns({**added, "win_prob_edge": edge})
