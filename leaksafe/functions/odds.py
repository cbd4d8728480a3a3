"""Prices, lines and their movement as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaksafe.functions.features import _c


def to_decimal(american) -> Column:
    """American price → decimal price; NULL strictly between −100 and 100."""
    a = _c(american).cast("double")
    return F.when(a >= 100, a / 100 + 1).when(a <= -100, F.lit(100.0) / F.abs(a) + 1)


def implied_prob(american) -> Column:
    """American price → raw implied probability; NULL strictly between −100 and 100."""
    a = _c(american).cast("double")
    return F.when(a >= 100, F.lit(100.0) / (a + 100)).when(a <= -100, F.abs(a) / (F.abs(a) + 100))


def remove_vig(pa, pb) -> Column:
    """Proportional two-way vig removal: struct(fair_a, fair_b, vig_pct)."""
    pa, pb = _c(pa), _c(pb)
    both = pa + pb
    return F.struct(
        (pa / both).alias("fair_a"), (pb / both).alias("fair_b"), ((both - 1) * 100).alias("vig_pct")
    )


def side_totals(total, spread) -> Column:
    """Market-implied totals per side: struct(home, away); a negative spread favours home."""
    half, tilt = _c(total) / 2, _c(spread) / 2
    return F.struct((half - tilt).alias("home"), (half + tilt).alias("away"))


def crossed(frm, to, keys: Sequence[float]) -> Column:
    """True if the move from `frm` to `to` reaches or passes any key, of either sign.

    Closed on the arrival side; false when either end is missing.
    """
    frm, to = _c(frm), _c(to)
    hit = F.lit(False)
    for key in keys:
        for k in (float(key), -float(key)):
            hit = hit | ((frm < k) & (to >= k)) | ((frm > k) & (to <= k))
    return F.coalesce(hit, F.lit(False))


def key_distance(line, keys: Sequence[float], *, absolute: bool = True) -> Column:
    """Distance from the line to the nearest key number; of the line's size when `absolute`."""
    line = F.abs(_c(line)) if absolute else _c(line)
    gaps = [F.abs(line - float(k)) for k in keys]
    nearest = gaps[0] if len(gaps) == 1 else F.least(*gaps)
    return F.when(line.isNotNull(), nearest)


def movement(open_, close, floor: float = 0.5) -> Column:
    """struct(move, abs_move, flip, volatility) of a line from open to close.

    `flip` is 1 when the sign changes; volatility is relative to |open| above `floor`,
    absolute at or below it.
    """
    o, c = _c(open_), _c(close)
    size = F.abs(c - o)
    return F.struct(
        (c - o).alias("move"),
        size.alias("abs_move"),
        F.when(((o > 0) & (c < 0)) | ((o < 0) & (c > 0)), 1).otherwise(0).alias("flip"),
        F.when(F.abs(o) > floor, size / F.abs(o)).otherwise(size).alias("volatility"),
    )


def ev(p, american, stake: float = 100.0) -> Column:
    """struct(ev, roi, p_win, profit_if_win, edge_pct) of a bet at an American price."""
    p, a = _c(p), _c(american).cast("double")
    profit = F.when(a > 0, F.lit(stake) * a / 100).when(a < 0, F.lit(stake * 100) / F.abs(a))
    value = p * profit - (F.lit(1.0) - p) * stake
    roi = value / stake
    return F.struct(
        F.round(value, 2).alias("ev"),
        F.round(roi, 4).alias("roi"),
        F.round(p, 4).alias("p_win"),
        F.round(profit, 2).alias("profit_if_win"),
        F.round(roi * 100, 2).alias("edge_pct"),
    )
