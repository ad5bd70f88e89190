"""Column functions. Every one is a composition of built-in expressions; none is a UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text shapes the guards accept.
DATETIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}(:[0-9]{2})?$"
DATE_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} "
DIGITS = r"^[0-9]+$"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- predicates -----------------------------------------------------------------


def all_equal(values: dict) -> Column:
    """Conjunction of column = value."""
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in values.items()])


def is_blank(c) -> Column:
    """Null, empty, or nothing but spaces (a tab is not blank)."""
    c = as_col(c)
    return c.isNull() | (F.trim(c) == "")


def is_datetime_text(c, strict: bool = False) -> Column:
    """Shape check, seconds optional. ``strict`` also demands a real calendar date."""
    c = as_col(c)
    shape = F.coalesce(c.rlike(DATETIME_TEXT), F.lit(False))
    return shape & c.try_cast("timestamp_ntz").isNotNull() if strict else shape


def has_date_prefix(c, strict: bool = False) -> Column:
    c = as_col(c)
    shape = F.coalesce(c.rlike(DATE_PREFIX), F.lit(False))
    return shape & F.substring(c, 1, 10).try_cast("date").isNotNull() if strict else shape


def is_digits(c) -> Column:
    return F.coalesce(as_col(c).rlike(DIGITS), F.lit(False))


def differs(c, value) -> Column:
    """Unequal to a value, null counting as blank."""
    return F.coalesce(as_col(c), F.lit("")) != F.lit(value)


def not_in_domain(c, values) -> Column:
    """Outside the allowed set, or null."""
    c = as_col(c)
    return c.isNull() | ~c.isin(list(values))


def null_safe_ne(a, b) -> Column:
    return ~as_col(a).eqNullSafe(as_col(b))


# ---- text, labels, numbers ------------------------------------------------------


def const(value, type_: str) -> Column:
    """A typed literal; ``None`` gives a typed null."""
    return F.lit(value).cast(type_)


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def null_to(c, value) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def map_label(c, labels: dict) -> Column:
    """Known text to label; unknown text passes through."""
    c = as_col(c)
    return _choose(c, labels, c)


def map_code(c, labels: dict) -> Column:
    """Known integer code to label; unknown code becomes its text."""
    c = as_col(c)
    return _choose(c, labels, c.cast("string"))


def _choose(c: Column, labels: dict, otherwise: Column) -> Column:
    out = F
    for key, label in labels.items():
        out = out.when(c == F.lit(key), F.lit(label))
    return out.otherwise(otherwise)


def diff0(a, b) -> Column:
    """a - b with nulls as zero, as text."""
    zero = F.lit(0)
    return (F.coalesce(as_col(a), zero) - F.coalesce(as_col(b), zero)).cast("string")


def num0(c) -> Column:
    """Text to BIGINT, null and blank counting as zero."""
    return F.coalesce(blank_to_null(c), F.lit("0")).cast("bigint")


def digits_to_long(c) -> Column:
    """BIGINT when the trimmed text is all digits and fits, else null."""
    trimmed = F.trim(as_col(c))
    return F.when(trimmed.rlike(DIGITS), trimmed.try_cast("bigint"))


def safe_cast(c, type_: str) -> Column:
    """Cast that gives null on bad input. Pair it with :func:`cast_fault` in a guard."""
    return as_col(c).try_cast(type_)


def cast_fault(c, type_: str) -> Column:
    """True where a value that is not blank would be lost by :func:`safe_cast`."""
    c = as_col(c)
    return ~is_blank(c.cast("string")) & c.try_cast(type_).isNull()


def day_of(c) -> Column:
    return F.substring(as_col(c), 1, 10)


def rate_pct(n, d) -> Column:
    """100 n / d to 4 decimals as DOUBLE; null when d is zero."""
    return F.round(F.lit(100.0) * as_col(n) / F.nullif(as_col(d), F.lit(0)), 4).cast("double")


def diff_text(new, old) -> Column:
    """Signed difference with its share of the old value, e.g. ``+12（0.35%）``."""
    new, old = as_col(new), as_col(old)
    diff = new - old
    digits = F.regexp_replace(F.regexp_replace(diff.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    signed = F.concat(F.when(diff > 0, F.lit("+")).otherwise(F.lit("")), digits)
    # Half-up hundredths of a percent in decimal arithmetic, so the text never depends on floating point.
    # A share too large for a BIGINT is left out.
    d, o = (F.abs(x).try_cast("decimal(30,6)") for x in (diff, old))
    fits = d < F.try_multiply(o, F.lit(10**9))
    hundredths = F.call_function("div", F.lit(20000) * F.when(fits, d) + o, F.nullif(F.lit(2) * o, F.lit(0)))
    percent = F.concat(
        F.call_function("div", hundredths, F.lit(100)).cast("string"),
        F.lit("."),
        F.lpad((hundredths % 100).cast("string"), 2, "0"),
    )
    shared = F.coalesce(F.concat(signed, F.lit("（"), percent, F.lit("%）")), signed)
    return F.when((diff == 0) | (old == 0), signed).otherwise(shared)


# ---- keys and positions ---------------------------------------------------------


def technical_id(pos, parent, child) -> Column:
    """The child's id, or the parent's id negated for a parent without children."""
    return F.when(as_col(pos).isNull(), F.lit(0) - as_col(parent)).otherwise(as_col(child))


def position_overflow(pos, width: int = 7) -> Column:
    """True where position + 1 no longer fits the padded width."""
    return as_col(pos) + 1 > F.lit(10**width - 1)


def batch_position_id(dt: str, pos, width: int = 7) -> Column:
    """yyyymmdd followed by the zero-padded 1-based position; null past the capacity.

    ``lpad`` would silently truncate there and give two parents one id.
    """
    text = F.concat(F.lit(dt.replace("-", "")), F.lpad((as_col(pos) + 1).cast("string"), width, "0"))
    return F.when(~position_overflow(pos, width), text.cast("bigint"))


def at_pos(arr, pos) -> Column:
    """Element at a 0-based position, null out of range."""
    return F.get(as_col(arr), as_col(pos))


# ---- projection -----------------------------------------------------------------


def conform(df: DataFrame, fields) -> DataFrame:
    """Explicit ordered projection to a declared contract."""
    return df.select(*[f.build().cast(f.type).alias(f.name) for f in fields])
