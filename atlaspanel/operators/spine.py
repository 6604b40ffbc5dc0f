"""Spine and panel operators U1-U4, J3, J4.

Partitioning: every source is unique on (country_code, year) after the pivot,
so the spine joins are 1:1 and cannot blow up on a hot country; the spine's
``distinct`` and each source's pivot hash-partition on the same two keys, so
the chained left joins reuse that partitioning instead of re-shuffling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaspanel.operators.joins import bounded_broadcast

KEYS = ["country_code", "year"]


def union_all(frames: list[DataFrame], columns: list[str] = KEYS) -> DataFrame:
    """``UNION ALL`` of the key columns of several frames."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*columns) for f in frames])


def spine_distinct(frames: list[DataFrame], keys: list[str] = KEYS) -> DataFrame:
    """``SELECT DISTINCT keys`` over the union (one aggregate, partial per input)."""
    return union_all(frames, keys).distinct()


def union_distinct(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """``UNION`` (set semantics); one distinct instead of three."""
    return a.select(*columns).unionByName(b.select(*columns)).distinct()


def distinct_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """U4: ``SELECT DISTINCT`` of a column pair."""
    return df.select(*columns).distinct()


def merge_sources_on_spine(spine: DataFrame, sources: list[DataFrame], keys: list[str] = KEYS) -> DataFrame:
    """Spine LEFT JOIN each source on the keys (non-key columns must be disjoint)."""
    out = spine
    for src in sources:
        out = out.join(src, on=keys, how="left")
    return out


def fact_panel(
    spine: DataFrame,
    dim: DataFrame,
    sources: list[DataFrame],
    columns: list[str],
    keys: list[str] = KEYS,
) -> DataFrame:
    """Spine LEFT JOIN dimension (name) and every source (indicators).

    Output: ``country_code, country_name, year`` + ``columns`` in order.
    The dimension side is broadcast behind a row-count check; the sources are
    joined on both keys. Pass ``spine=None`` to use the equivalent spine-free
    plan (see ``outer_merge``), which reads every source once.
    """
    names = bounded_broadcast(
        dim.select(F.col("country_code").alias("__dim_code"), F.col("country_name").alias("__dim_name")),
        bounded_by=dim,
    )
    trimmed = [s.drop("country_name") if "country_name" in s.columns else s for s in sources]
    if spine is None:
        out = outer_merge(trimmed, keys)
    else:
        out = merge_sources_on_spine(spine.select(*keys), trimmed, keys)
    out = out.join(names, F.col("country_code") == F.col("__dim_code"), "left")
    return out.select(
        F.col("country_code"),
        F.col("__dim_name").alias("country_name"),
        F.col("year"),
        *[F.col(c) for c in columns],
    )


def outer_merge(sources: list[DataFrame], keys: list[str] = KEYS, unique_null_keys: bool = True) -> DataFrame:
    """``DISTINCT keys of all sources`` LEFT JOIN each source, as FULL OUTER joins.

    For every key k with a_k, b_k, ... rows in the sources (0 counting as one
    all-NULL row) both forms return the product a_k * b_k * ... rows, so they
    are equal; the outer form drops the spine's extra scan and aggregate of
    each source (a source feeding both spine and join is otherwise computed
    twice, since the pruned spine branch is not exchange-reusable).

    A key with a NULL part is one spine row that no source matches. The outer
    joins pair such keys null-safely and their values are blanked, which gives
    that one row where no source repeats a NULL key (a pivot's result never
    does). ``unique_null_keys=False``: sources that may repeat one; then those
    rows are read apart, as distinct keys.
    """
    values = [[c for c in s.columns if c not in keys] for s in sources]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if not unique_null_keys:
        out = reduce(lambda a, b: a.join(b, on=keys, how="full"), [s.filter(whole) for s in sources])
        return out.unionByName(spine_distinct([s.filter(~whole) for s in sources], keys), allowMissingColumns=True)

    def paired(left: DataFrame, right: DataFrame) -> DataFrame:
        other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
        match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        return left.join(other, match, "full").withColumns({k: F.coalesce(k, f"__{k}") for k in keys}).drop(*[f"__{k}" for k in keys])

    out = reduce(paired, sources)
    return out.select(*keys, *[F.when(whole, F.col(c)).alias(c) for cs in values for c in cs])
