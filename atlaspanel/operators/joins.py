"""Size-checked broadcast.

A broadcast side is shipped whole to every executor, so it is only hinted when
the optimizer's size estimate (from file sizes, no job) is below a bound;
beyond it the join is left to Catalyst/AQE, which decides on measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A country dimension is a few kB; the bound leaves room for a far wider one
# and for the estimate's product over the dimension's own small joins.
DIMENSION_BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (an upper bound over filters and projections of its files)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(
    df: DataFrame, max_bytes: int = DIMENSION_BROADCAST_MAX_BYTES, bounded_by: DataFrame | None = None
) -> DataFrame:
    """``broadcast(df)`` when its estimated size is bounded, else ``df`` unchanged.

    ``bounded_by``: a frame that ``df`` is a projection, filter or distinct of;
    its estimate bounds that of ``df``.
    """
    if estimated_bytes(bounded_by if bounded_by is not None else df) <= max_bytes:
        return F.broadcast(df)
    return df
