"""Column features: flags, buckets, guarded arithmetic, outcomes, role pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(value)


def flag(condition: Column, out: str | None = None) -> Column:
    """1 where the condition holds, else 0; an unknown condition counts as 0."""
    result = F.when(condition, F.lit(1)).otherwise(F.lit(0))
    return result.alias(out) if out else result


def available(col) -> Column:
    """1 where a value is present."""
    return _c(col).isNotNull().cast("int")


def bucketize(
    col,
    bounds: Sequence[float],
    labels: Sequence[str],
    *,
    first: tuple[Column, str] | None = None,
    otherwise: str | None = None,
    closed: str = "left",
) -> Column:
    """Label a value by ascending `bounds`; `labels` has one entry more than `bounds`.

    `closed="left"` puts a value equal to a bound into the upper bucket, "right" into the
    lower. `first` is an override arm (condition, label). NULL becomes `otherwise`.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("labels must have one entry more than bounds")
    value = _c(col)
    chain = F.when(value.isNull(), F.lit(otherwise))
    if first is not None:
        chain = F.when(first[0], F.lit(first[1])).when(value.isNull(), F.lit(otherwise))
    for bound, label in zip(bounds, labels):
        chain = chain.when(value < bound if closed == "left" else value <= bound, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def code_ranges(col, ranges: Sequence[tuple[float, float, str]], otherwise: str) -> Column:
    """Label an integer code by inclusive ranges; the first that holds wins."""
    value, chain = _c(col), None
    for low, high, label in ranges:
        hit = value.between(low, high)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def ratio(num, den) -> Column:
    """num / den, NULL unless the denominator is positive."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num.cast("double") / den)


def capped_score(
    parts: Sequence[tuple],
    total_cap: float,
    *,
    override: tuple[Column, float] | None = None,
    null_policy: str = "skip",
) -> Column:
    """Sum of `least(greatest((col - offset) * slope, 0), cap)` over `(col, offset, slope, cap)`.

    With `null_policy="skip"` a missing input adds its cap's lower end as LEAST/GREATEST skip
    NULL (0 here); "propagate" makes the score NULL. `override` is (condition, score).
    """
    total = F.lit(0.0)
    for col, offset, slope, cap in parts:
        raw = (_c(col).cast("double") - F.lit(float(offset))) * F.lit(float(slope))
        piece = F.least(F.greatest(raw, F.lit(0.0)), F.lit(float(cap)))
        if null_policy == "propagate":
            piece = F.when(raw.isNotNull(), piece)
        total = total + piece
    score = F.when(total > total_cap, F.lit(float(total_cap))).otherwise(total)
    if override is not None:
        score = F.when(override[0], F.lit(float(override[1]))).otherwise(score)
    return score


def override(col, condition: Column, value) -> Column:
    """`value` where the condition holds, the column elsewhere."""
    return F.when(condition, _c(value)).otherwise(_c(col))


def outcome_flag(a, b) -> Column:
    """1 if a > b, 0 if a < b, NULL for a tie or a missing side."""
    a, b = _c(a), _c(b)
    return F.when(a > b, 1).when(a < b, 0)


def cover_flag(margin, line, *, favourite_sign: int = -1) -> Column:
    """1 if the margin beats the line, 0 if it falls short, NULL for a push or a missing value.

    `favourite_sign=-1`: a negative line means the margin's side is favoured.
    """
    edge = _c(margin) - _c(line) * favourite_sign
    return F.when(edge > 0, 1).when(edge < 0, 0)


def over_flag(total, line) -> Column:
    return outcome_flag(total, line)


def pick_by_role(role_flag, when_one, when_zero) -> Column:
    return F.when(_c(role_flag) == 1, _c(when_one)).otherwise(_c(when_zero))


def progress(period, last: int) -> Column:
    """Position in a cycle of `last` periods after the first, 0 at period 1."""
    return (_c(period) - 1) / F.lit(float(last))


def _role_names(measure, left, right):
    return F.col(f"{left}_{measure}"), F.col(f"{right}_{measure}")


def role_diff(df: DataFrame, measures: Mapping[str, str] | Sequence[str], left="home", right="away") -> DataFrame:
    """Add left − right per measure. A mapping gives {output: measure}; a list names outputs `{m}_diff`."""
    named = measures if isinstance(measures, Mapping) else {f"{m}_diff": m for m in measures}
    pairs = {out: _role_names(m, left, right) for out, m in named.items()}
    return df.withColumns({out: a - b for out, (a, b) in pairs.items()})


def role_sum(df: DataFrame, measures: Mapping[str, str] | Sequence[str], left="home", right="away") -> DataFrame:
    """Add left + right per measure; names as in `role_diff` with `_sum`."""
    named = measures if isinstance(measures, Mapping) else {f"{m}_sum": m for m in measures}
    pairs = {out: _role_names(m, left, right) for out, m in named.items()}
    return df.withColumns({out: a + b for out, (a, b) in pairs.items()})
