"""Mart operators J5, G1, G2: one row per dimension country.

Both marts aggregate the fact by ``country_code`` *before* meeting the
dimension: the aggregate's partial phase collapses a hot country map-side, and
the join that follows is dimension-sized and 1:1 (the reference joins first and
groups after; the result is the same because MAX/MAX_BY only see fact rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaspanel.functions.sqltext import ident
from atlaspanel.operators.joins import bounded_broadcast


def _country_base(dim: DataFrame) -> DataFrame:
    return dim.select("country_code", "country_name").distinct()


def dim_left_fact(dim: DataFrame, fact: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct (code, name) of the dimension LEFT JOIN the fact rows.

    Planned as (fact JOIN dimension) UNION ALL (dimension rows without facts):
    the first part is a map-side join against the size-checked dimension, the
    second an anti join against the fact's distinct codes (partially
    aggregated). A plain left join would shuffle the fact on country_code as
    the non-preserved side, where AQE cannot split a hot country.
    """
    base = _country_base(dim)
    right = fact.select("country_code", "year", *columns)
    matched = right.join(bounded_broadcast(base, bounded_by=dim), "country_code", "inner")
    unmatched = base.join(right.select("country_code").distinct(), "country_code", "left_anti")
    nulls = [F.lit(None).cast(t).alias(c) for c, t in right.dtypes if c != "country_code"]
    out_cols = ["country_code", "country_name", "year", *columns]
    return matched.select(*out_cols).unionByName(unmatched.select("country_code", "country_name", *nulls).select(*out_cols))


def peak_and_last_year(dim: DataFrame, fact: DataFrame, columns: list[str]) -> DataFrame:
    """G1 (literal mart semantics, T1): per country and indicator the largest
    non-null value and, independently, the latest year that has a value.

    Countries without facts are kept with NULLs. ``MAX(CASE WHEN x IS NOT NULL
    THEN x END)`` is ``max(x)``.
    """
    aggs = []
    for c in columns:
        q = ident(c)
        aggs.append(f"max({q}) AS {q}")
        aggs.append(f"max(CASE WHEN {q} IS NOT NULL THEN year END) AS {ident(c + '_year')}")
    per_country = fact.groupBy("country_code").agg(*[F.expr(a) for a in aggs])
    return _attach(dim, per_country, columns)


def latest_value(dim: DataFrame, fact: DataFrame, columns: list[str]) -> DataFrame:
    """G2 (documented intent): per country and indicator the value *at* the
    latest year with a value, and that year. (country, year) is unique in the
    fact, so ``max_by`` has no ties."""
    aggs = []
    for c in columns:
        q = ident(c)
        aggs.append(f"max_by({q}, CASE WHEN {q} IS NOT NULL THEN year END) AS {q}")
        aggs.append(f"max(CASE WHEN {q} IS NOT NULL THEN year END) AS {ident(c + '_year')}")
    per_country = fact.groupBy("country_code").agg(*[F.expr(a) for a in aggs])
    return _attach(dim, per_country, columns)


def _attach(dim: DataFrame, per_country: DataFrame, columns: list[str]) -> DataFrame:
    out_cols = ["country_code", "country_name"]
    for c in columns:
        out_cols += [ident(c), ident(f"{c}_year")]
    # The dimension is the preserved side of the outer join, so it cannot be the
    # broadcast side; the aggregate is already hash-partitioned on country_code,
    # so only the (dimension-sized) base moves in this join.
    return _country_base(dim).join(per_country, "country_code", "left").selectExpr(*out_cols)
