"""Conform operators P1-P4, J1, J2: dimension projection, renames, key joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaspanel import dictionary as D
from atlaspanel.operators.joins import bounded_broadcast

# The published dimension's columns, in order.
DIM_COLUMNS = [
    "country_code",
    "country_name",
    "iso2",
    "continent",
    "region",
    "income_group",
    "is_eu",
    "is_oecd",
    "is_asean",
    "is_brics",
    "is_g20",
    "is_fcs",
]


def conform_dimension(seed: DataFrame) -> DataFrame:
    """Staged dimension -- ``iso3 AS country_code``, flags renamed to ``is_*``."""
    flags = [F.col(f).alias(D.FLAG_RENAMES[f]) for f in D.SEED_FLAG_COLUMNS]
    return seed.select(
        F.col("country_name"),
        F.col("iso3").alias("country_code"),
        F.col("iso2"),
        F.col("continent"),
        F.col("region"),
        F.col("income_group"),
        *flags,
    )


def dim_country(staged: DataFrame) -> DataFrame:
    """The 12-column dimension mart."""
    return staged.select(*DIM_COLUMNS)


def rename_indicators(df: DataFrame, dictionary) -> DataFrame:
    """Raw code -> mart name for every dictionary entry present in ``df``."""
    mapping = {k: v for k, v in D.rename_map(dictionary).items() if k in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df


def cast_year(df: DataFrame, col: str = "year") -> DataFrame:
    """``CAST(year AS INTEGER)``; ANSI mode raises on text that is not a number."""
    return df.withColumn(col, F.col(col).cast("int"))


def join_dim_iso3(df: DataFrame, seed: DataFrame, code_col: str = "country_code") -> DataFrame:
    """Inner join to the country dimension on ISO3 (drops non-member codes).

    Returns ``df`` unchanged in shape (semi-join semantics on a unique key):
    the dimension is broadcast when its size is checked small, so the large
    side is never shuffled for this join.
    """
    dim = bounded_broadcast(seed.select(F.col("iso3").alias("__iso3")), bounded_by=seed)
    return df.join(dim, F.col(code_col) == F.col("__iso3"), "inner").drop("__iso3")


def join_dim_iso2(df: DataFrame, seed: DataFrame, code_col: str = "country_code") -> DataFrame:
    """Inner join on ISO2 and emit ISO3 + the dimension's name (key translation)."""
    dim = bounded_broadcast(
        seed.select(
            F.col("iso2").alias("__iso2"),
            F.col("iso3").alias("__iso3"),
            F.col("country_name").alias("__name"),
        ),
        bounded_by=seed,
    )
    rest = [c for c in df.columns if c not in (code_col, "country_name")]
    return df.join(dim, F.col(code_col) == F.col("__iso2"), "inner").select(
        F.col("__iso3").alias("country_code"), F.col("__name").alias("country_name"), *rest
    )


def attach_dim_name(df: DataFrame, seed: DataFrame, code_col: str = "country_code") -> DataFrame:
    """Inner join on ISO3 taking ``country_name`` from the dimension (IMF staging)."""
    dim = bounded_broadcast(
        seed.select(F.col("iso3").alias("__iso3"), F.col("country_name").alias("__name")), bounded_by=seed
    )
    rest = [c for c in df.columns if c not in (code_col, "country_name")]
    return df.join(dim, F.col(code_col) == F.col("__iso3"), "inner").select(
        F.col(code_col), F.col("__name").alias("country_name"), *rest
    )
