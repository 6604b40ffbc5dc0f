"""Sinks K1-K6 and the landing writers used to round-trip the sources.

Full-refresh semantics: a table is replaced as a whole. Every write makes a new
version, a table of its own folder; the name that readers use is a pointer (a
view of one version) that is switched in one catalog step once the version is
complete. A reader therefore sees the old rows or the new ones, never a part or
nothing, also while its own query runs: the versions before the current one stay
for ``KEEP`` further writes.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The table property of a pointer that names its version.
VERSION = "atlaspanel.version"
#: Versions kept behind the current one, for readers that are still at work on them.
KEEP = 2
_MARK = "__v"


def ensure_layer(spark: SparkSession, layer: str, location: str | None = None) -> str:
    """K2: ``CREATE DATABASE IF NOT EXISTS layer`` (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{loc}")
    return layer


def write_version(
    df: DataFrame, layer: str, name: str, partition_by: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None,
    cluster_by: tuple[int, list[str]] | None = None,
) -> str:
    """A new version of ``layer.name``, not yet pointed to; returns its table name.

    ``partition_by`` (e.g. ``year`` for the fact at scale) gives partition
    pruning to readers that filter on it; rows are rebalanced on it first, so a
    folder holds about one file per advisory partition size, not one per task.
    ``bucket_by`` = (buckets, keys): rows are stored hashed and sorted by the
    keys, one file per bucket, so joins and aggregates on them need no exchange.
    ``cluster_by`` = (files, keys): rows are stored in so many sorted ranges of
    the keys (nulls last), with each file's smallest and largest keys in an index
    table, for ``readers.read_clustered``.
    """
    ensure_layer(df.sparkSession, layer)
    version = f"{name}{_MARK}{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if bucket_by:
        df = df.repartition(bucket_by[0], *bucket_by[1])
    if cluster_by:
        order = [F.col(c).asc_nulls_last() for c in cluster_by[1]]
        df = df.repartitionByRange(cluster_by[0], *order).sortWithinPartitions(*order)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    writer.saveAsTable(f"`{layer}`.`{version}`")
    if cluster_by:
        bounds = [f(c).alias(f"{c}__{n}") for c in cluster_by[1] for n, f in (("min", F.min), ("max", F.max))]
        nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cluster_by[1]]
        stored = df.sparkSession.table(f"`{layer}`.`{version}`").withColumn("file", F.col("_metadata.file_path"))
        index = stored.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *bounds, *nulls)
        index.coalesce(1).write.format("parquet").saveAsTable(f"`{layer}`.`{index_of(version)}`")  # a row per file
    return version


def index_of(version: str) -> str:
    """The name of a clustered version's file index."""
    return "__i".join(version.rsplit(_MARK, 1))


def current_version(spark: SparkSession, layer: str, name: str) -> str:
    """The version that ``layer.name`` points to."""
    return spark.sql(f"SHOW TBLPROPERTIES `{layer}`.`{name}` ('{VERSION}')").first()["value"]


def versions(spark: SparkSession, layer: str, name: str) -> list[str]:
    """The stored versions of ``layer.name``, oldest first."""
    found = spark.sql(f"SHOW TABLES IN `{layer}` LIKE '{name}{_MARK}*'").collect()
    mark = f"{name}{_MARK}"
    return sorted(r["tableName"] for r in found if r["tableName"].startswith(mark) and r["tableName"][len(mark) :].replace("_", "").isalnum())


def point_to(spark: SparkSession, layer: str, name: str, version: str, keep: int = KEEP) -> str:
    """Switch ``layer.name`` to a version (one catalog step), then drop versions older than the ``keep`` before it."""
    full = f"`{layer}`.`{name}`"
    named = lambda kind: [r for r in spark.sql(f"SHOW {kind} IN `{layer}` LIKE '{name}'").collect() if not r["isTemporary"]]
    if named("TABLES") and not named("VIEWS"):
        spark.sql(f"DROP TABLE {full}")  # a plain table of an earlier layout
    spark.sql(f"CREATE OR REPLACE VIEW {full} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT * FROM `{layer}`.`{version}`")
    older = [v for v in versions(spark, layer, name) if v < version]
    for v in older[: max(0, len(older) - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{v}`")
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{index_of(v)}`")
    return full


def replace_table(
    df: DataFrame, layer: str, name: str, partition_by: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None,
    cluster_by: tuple[int, list[str]] | None = None,
) -> str:
    """K1/K5: full refresh of ``layer.name``: a complete new version, then one switch to it."""
    return point_to(df.sparkSession, layer, name, write_version(df, layer, name, partition_by, bucket_by, cluster_by))


publish_table = replace_table


def publish_sql_view(spark: SparkSession, layer: str, name: str, sql: str) -> str:
    """A stored view of a query over the layer's tables."""
    full = f"`{layer}`.`{name}`"
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS {sql}")
    return full


def publish_view(df: DataFrame, name: str) -> str:
    """K4: staging published as a (session) view; nothing is materialised."""
    df.createOrReplaceTempView(name)
    return name


def export_csv_backup(df: DataFrame, path: str) -> str:
    """K3: header CSV copy, as a directory of part files."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )
    return path


def backup_name(source: str, start_year: int, end_year: int) -> str:
    """K3 file naming: the source and the two bounds of the extraction window as given."""
    return f"{source}_{start_year}_{end_year}"


def load_row_count(df: DataFrame, table: str) -> DataFrame:
    """K6: ``SELECT COUNT(*)`` after a load, as a one-row frame (table, rows)."""
    return df.agg(F.count(F.lit(1)).alias("loaded_rows")).select(F.lit(table).alias("table_name"), "loaded_rows")


# --- landing writers (produce the payload files the readers S1-S5 consume) ----


def land_csv(df: DataFrame, path: str) -> str:
    """Write a header CSV where an empty field means NULL (as the seed file does)."""
    return export_csv_backup(df, path)


def land_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def land_json_lines(docs: DataFrame, path: str) -> str:
    """Write one JSON document per line from a single string column ``doc``."""
    docs.select(F.col("doc").alias("value")).write.mode("overwrite").text(path)
    return path
