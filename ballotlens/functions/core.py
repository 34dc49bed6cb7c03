"""Scalar rules shared by every dataset.

* ``epoch_seconds``: a timestamp as whole epoch seconds, rounding the
  fractional value half-to-even (the exports' convention), not truncating.
* ``json_num``: numeric JSON text to INT/BIGINT/DOUBLE; ``12.6`` -> 13,
  ``1.23E10`` -> 12300000000, malformed or empty -> NULL.
* ``ratio``: ``num / nullif(den, 0)`` on doubles (no ANSI divide-by-zero error,
  no DECIMAL result types).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fractional_seconds(ts) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp")) / F.lit(1_000_000.0)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 UTC, fraction rounded half-to-even."""
    return F.rint(_fractional_seconds(ts)).cast("long")


def seconds_between(later, earlier) -> Column:
    """Difference of fractional epoch seconds, rounded once after subtracting."""
    return F.rint(_fractional_seconds(later) - _fractional_seconds(earlier)).cast("long")


def json_num(text, to: str) -> Column:
    """Numeric JSON text -> ``to`` ('int' | 'bigint' | 'double')."""
    c = _col(text)
    if to == "double":
        return c.try_cast("double")
    whole = F.round(c.try_cast("decimal(38,10)"), 0)
    return whole.try_cast(to)


def _string_schema(tree) -> StructType:
    """``{"a": None, "b": {"c": None}}`` -> struct<a string, b struct<c string>>."""
    fields = []
    for name, sub in tree.items():
        dtype: DataType = StringType() if sub is None else _string_schema(sub)
        fields.append(StructField(name, dtype, True))
    return StructType(fields)


def parse_json_strings(text, tree: dict) -> Column:
    """Parse a JSON object column once into a struct whose leaves are the raw
    JSON scalar text (numbers keep their digits; JSON null -> NULL)."""
    return F.from_json(_col(text), _string_schema(tree))


def ratio(num, den) -> Column:
    """``num / den`` as DOUBLE; NULL when ``den`` is 0 or NULL."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def pct(num, den, digits: int = 4) -> Column:
    """``round(num * 100 / den, digits)`` as DOUBLE; NULL on a zero denominator."""
    return F.round(_col(num).cast("double") * F.lit(100.0) / F.nullif(_col(den).cast("double"), F.lit(0.0)),
                   digits)


def asc_last(*cols) -> list[Column]:
    """Ascending sort keys with NULLs last."""
    return [_col(c).asc_nulls_last() for c in cols]
