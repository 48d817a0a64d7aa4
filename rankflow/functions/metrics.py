"""Business metrics and stamp functions (f25-f36).

ANSI mode is on in Spark 4: every division that the reference relied on to
yield NULL silently is a ``try_divide`` here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
SEASONS = (((3, 4, 5), "spring"), ((6, 7, 8, 9), "summer"), ((10, 11), "fall"), ((12, 1, 2), "winter"))
STAMP_FORMATS = {12: "yyyyMMddHHmm", 10: "yyyyMMddHH", 8: "yyyyMMdd"}
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def conversion_rate(sales: Column | str, views: Column | str) -> Column:
    """f25: ``views != 0 ? sales / views : 0``; NULL views gives 0.0."""
    s, v = _c(sales), _c(views)
    return F.when(v != 0, F.try_divide(s.cast("double"), v.cast("double"))).otherwise(F.lit(0.0))


def conversion_rate_nullable(sales: Column | str, views: Column | str) -> Column:
    """f26: NULL when either side is NULL, ``sales/views`` when views > 0, else 0."""
    s, v = _c(sales), _c(views)
    return (F.when(v.isNull() | s.isNull(), F.lit(None).cast("double"))
             .when(v > 0, F.try_divide(s.cast("double"), v.cast("double")))
             .otherwise(F.lit(0.0)))


def ratio(a: Column | str, b: Column | str) -> Column:
    """f28: unguarded ratio made safe: NULL on a zero or NULL divisor."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def original_price(price: Column | str, discount: Column | str) -> Column:
    """f29: undo a discount given as percent (> 1) or fraction (0, 1]; divisor 0 -> NULL."""
    p, d = _c(price).cast("double"), _c(discount).cast("double")
    return (F.when(d > 1, F.try_divide(p, F.lit(1.0) - d / 100))
             .when((d > 0) & (d <= 1), F.try_divide(p, F.lit(1.0) - d))
             .otherwise(p))


def parse_stamp(c: Column | str) -> Column:
    """f30/f33: ``yyyyMMdd``, ``yyyyMMddHH`` or ``yyyyMMddHHmm`` -> timestamp; else NULL."""
    s = F.trim(_c(c).cast("string"))
    out = F.lit(None).cast("timestamp")
    for width, fmt in STAMP_FORMATS.items():
        out = F.when(F.length(s) == width, F.try_to_timestamp(s, F.lit(fmt))).otherwise(out)
    return out


def season(ts: Column | str) -> Column:
    """f31: meteorological season name from the month of a date/timestamp."""
    m = F.month(_c(ts))
    out = None
    for months, name in SEASONS:
        cond = m.isin(*months)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def stamp_prefix(c: Column | str, width: int = 10) -> Column:
    """f32: first ``width`` characters of the stamp (hour resolution by default)."""
    return F.substring(_c(c).cast("string"), 1, width)


def format_fixed(c: Column | str, digits: int = 2) -> Column:
    """Fixed-point text rounded like Python's ``format(x, ".2f")``.

    ``format_number`` rounds the exact binary value half-to-even (Java's
    ``%.2f`` rounds the shortest decimal text half-up, so 1.125 would print
    1.13 where Python prints 1.12); its grouping commas are removed.  Values
    that are no finite number print as in Python: ``inf``, ``-inf``, ``nan``.
    """
    v = _c(c).cast("double")
    text = F.replace(F.format_number(v, digits), F.lit(","), F.lit(""))
    infinite = F.abs(v) == F.lit(float("inf"))
    return F.when(F.isnan(v), "nan").when(infinite, F.when(v > 0, "inf").otherwise("-inf")).otherwise(text)


def format_2dp(c: Column | str) -> Column:
    """f34: ``%.2f`` text with Python's rounding; NULL stays NULL."""
    return format_fixed(c, 2)


def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """f35: Python's ``round(x, digits)``: half-to-even on the exact binary value
    (0.125 -> 0.12, 0.675 -> 0.68, 0.575 -> 0.57)."""
    v = _c(c).cast("double")
    finite = ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.when(finite, format_fixed(v, digits).cast("double")).otherwise(v)


def snapshot_stamp(at: Column | None = None, fmt: str = "yyyyMMddHH") -> Column:
    """f36: stamp text of ``at`` (default: query start time); inject ``at`` for repeatable runs."""
    return F.date_format(at if at is not None else F.current_timestamp(), fmt)
