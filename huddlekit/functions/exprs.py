"""Column-expression helpers. Every function returns a ``Column`` built from
built-in Spark functions, so it stays inside whole-stage codegen."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType

# Whitespace class for "blank" tests. Spark's and DuckDB's trim strip only
# spaces, so blankness is decided with a Unicode-aware regex instead.
_BLANK = r"^(?U)\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_double(x) -> Column:
    """Lenient numeric parse: junk and blanks become NULL (never raises)."""
    return _try_double(_c(x))


def _try_double(c: Column) -> Column:
    text = F.trim(c.cast("string"))
    # Java's number suffixes ('8658d', '1f') are junk here
    return F.when(~text.rlike(r"[0-9.][dDfF]$"), text.try_cast("double"))


def to_long(x) -> Column:
    """Integer parse through double: '8658.0' -> 8658, '1e3' -> 1000,
    ' 7 ' -> 7, junk -> NULL, and a non-integral value ('3.28') -> NULL
    rather than a silent truncation."""
    c = _c(x)
    exact = F.trim(c.cast("string")).try_cast("long")
    d = _try_double(c)
    via_double = F.when((d == F.floor(d)) & (F.abs(d) < F.lit(9.2e18)), d.cast("long"))
    return F.coalesce(exact, via_double)


def to_long_in(df: DataFrame, name: str) -> Column:
    """``to_long`` of column ``name`` of ``df``, skipping the text round trip
    when the column is already numeric (integral doubles only)."""
    from pyspark.sql import types as T
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("long")
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        d = c.cast("double")
        return F.when((d == F.floor(d)) & (F.abs(d) < F.lit(9.2e18)), d.cast("long"))
    return to_long(c)


def to_double_in(df: DataFrame, name: str | None) -> Column:
    """``to_double`` of column ``name`` of ``df`` (a typed NULL when the
    column is absent), with no text round trip for numeric columns."""
    from pyspark.sql import types as T
    if name is None or name not in df.columns:
        return F.lit(None).cast("double")
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    return to_double(c)


def strict_long(x) -> Column:
    """Strict integer parse of a string: digits only (after trim), else NULL."""
    return F.trim(_c(x).cast("string")).try_cast("long")


def safe_rate(num, den) -> Column:
    """num / den as double, NULL (never 0.0) when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den), F.lit(0)).cast("double"))


def is_charted(x) -> Column:
    """True when the value is present and not blank after trimming."""
    c = _c(x)
    return c.isNotNull() & ~c.cast("string").rlike(_BLANK)


def season_from_date(x) -> Column:
    """Season of a game date: January and February belong to the previous
    year's season."""
    d = _c(x)
    return (F.year(d) - (F.month(d) <= 2).cast("int")).cast("long")


def lenient_date(x) -> Column:
    """Date parse that yields NULL for unparseable input."""
    return F.trim(_c(x).cast("string")).try_cast("date")


def first_present(df: DataFrame, *names: str, dtype: DataType | str | None = None) -> Column:
    """The first of ``names`` that exists in ``df`` (plan-time check), else a
    typed NULL."""
    for n in names:
        if n in df.columns:
            c = F.col(n)
            return c.cast(dtype) if dtype is not None else c
    lit = F.lit(None)
    return lit.cast(dtype) if dtype is not None else lit.cast(NullType())


def optional(df: DataFrame, name: str, dtype: DataType | str | None = None) -> Column:
    return first_present(df, name, dtype=dtype)


def count_true(cond: Column) -> Column:
    """Count of rows where ``cond`` is true, as bigint (0 for no rows)."""
    return F.count_if(cond).cast("long")


def season_week_from_key(x) -> tuple[Column, Column]:
    """Parse 'YYYY_WW_AWAY_HOME' into (season, week). Both parts must parse,
    otherwise both are NULL."""
    parts = F.split(_c(x).cast("string"), "_")
    s = F.try_element_at(parts, F.lit(1)).try_cast("long")
    w = F.try_element_at(parts, F.lit(2)).try_cast("long")
    ok = s.isNotNull() & w.isNotNull()
    return F.when(ok, s), F.when(ok, w)
