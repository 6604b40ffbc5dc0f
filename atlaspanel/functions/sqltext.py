"""SQL expression text for wide, generated expression lists.

A ``Column`` built from ``pyspark.sql.functions`` costs one JVM round trip per
function call, so a list of hundreds of generated expressions (every check of
a suite, every aggregate of a wide mart) spends seconds on the driver before a
job starts. The same expressions written as SQL text are parsed once per
expression on the JVM and plan identically (same Catalyst expressions, same
codegen).
"""

from __future__ import annotations

import math


def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    """A Python scalar as a SQL literal of the type ``F.lit`` would give it."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}L" if not -(2**31) <= value < 2**31 else str(value)
    if isinstance(value, float):
        if math.isnan(value) or math.isinf(value):
            return f"CAST('{value}' AS DOUBLE)"
        return f"{value!r}D"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


def in_list(values) -> str:
    """``(v1, v2, ...)`` for an IN predicate."""
    return "(" + ", ".join(literal(v) for v in values) + ")"
