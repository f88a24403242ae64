"""Column expressions that reproduce the reference's numeric semantics.

The reference computes with pandas: rounding is half-to-even on the
scaled double, a missing value stays missing through ``clip``, a sum of
nothing is 0 and division by zero gives inf/NaN. Spark 4 runs with ANSI
mode, so divisions go through ``try_divide`` (null instead of an error).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def np_round(c: Column | str, digits: int) -> Column:
    """Half-to-even rounding of ``c * 10**digits`` (numpy/pandas ``round``)."""
    scale = float(10 ** digits)
    return F.rint(col_(c).cast("double") * F.lit(scale)) / F.lit(scale)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Division that yields null on a zero or null divisor."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """pandas ``clip``: bounds the value, a missing value stays missing."""
    c = col_(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(float(lo)), F.least(c.cast("double"), F.lit(float(hi)))))


def at_least(c: Column | str, floor: int) -> Column:
    """``max(floor, c)`` with a missing value kept missing."""
    c = col_(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(floor), c))


def bool_mean(c: Column | str) -> Column:
    """Mean of a boolean column as a share in [0, 1]."""
    return F.avg(col_(c).cast("double"))


def labels(*rules: tuple[Column, str]) -> Column:
    """Array of the labels whose condition holds, in the given order.

    Equivalent of appending to a Python list under successive ``if``s;
    an empty array when none holds.
    """
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in rules]))


def band(value: Column | str, bands: Sequence[tuple[str, float, str]], otherwise: str) -> Column:
    """First-match banding: ``bands`` holds (op, bound, label) with op in
    '<', '<=', '>', '>='. A null value gives null."""
    v = col_(value)
    expr = None
    for op, bound, label in bands:
        cond = {"<": v < bound, "<=": v <= bound, ">": v > bound, ">=": v >= bound}[op]
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(otherwise)))


def pct_change(cur: Column | str, prev: Column | str) -> Column:
    """(cur - prev) / prev * 100, null on a zero or missing previous value."""
    return safe_div(col_(cur) - col_(prev), col_(prev)) * F.lit(100.0)


def padded_id(prefix: str, c: Column | str, width: int) -> Column:
    """``f'{prefix}{c:0{width}d}'`` for a non-negative integer column: a
    longer number is kept whole (``lpad`` alone would cut it)."""
    digits = col_(c).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def month_key(c: Column | str) -> Column:
    """``YYYY-MM`` text of a date or timestamp (``ds[:7]``)."""
    return F.substring(col_(c).cast("date").cast("string"), 1, 7)
