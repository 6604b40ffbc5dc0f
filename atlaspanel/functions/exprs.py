"""Scalar column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def valid_number(col) -> Column:
    """True for a value that may enter an aggregate: not NULL and not NaN."""
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c)


def case_non_null(test, value) -> Column:
    """``CASE WHEN test IS NOT NULL THEN value END`` (searched CASE, no ELSE)."""
    return F.when(_c(test).isNotNull(), _c(value))


def scale_value(col, divisor: float) -> Column:
    """``x / divisor`` in double arithmetic (e.g. 1e12 for trillions)."""
    return _c(col).cast("double") / F.lit(float(divisor))


def null_safe_order(col, descending: bool = False) -> Column:
    """Sort key with NULLs last in both directions (DuckDB's default, T10)."""
    c = _c(col)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def iso3_of(nationkey) -> Column:
    """Stand-in ISO3 code of a nation key: 'N' followed by the two-digit key."""
    return F.concat(F.lit("N"), F.lpad(_c(nationkey).cast("string"), 2, "0"))


def iso2_of(nationkey) -> Column:
    """Stand-in ISO2 code of a nation key: the two-digit key."""
    return F.lpad(_c(nationkey).cast("string"), 2, "0")
