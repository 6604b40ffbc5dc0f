"""Shared helpers: tables cut to the cluster's shared folder, ranks, hashes, text words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlaspanel.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, path: str | None = None, compression: str | None = None, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of recomputing it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, f"llm-{name}")
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(_nullable(df.schema)).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, from their file sizes (no job); one of unknown size counts for none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 60)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def ranked(df: DataFrame, order: list, name: str, rank: str = "rank") -> DataFrame:
    """``df`` with a gapless 0-based ``rank`` in the given order, without a single-partition window.

    A range-partitioned sort is stored with each row's partition and place in
    it; the row counts per partition (one row per partition, a bound set by the
    shuffle width and not by the data) give every partition its offset.
    """
    spark = df.sparkSession
    placed = F.monotonically_increasing_id()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    t = stored(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__place", placed),
        name,
    )
    pid = F.shiftright("__place", 33)
    counts = {r["p"]: r["count"] for r in t.groupBy(pid.cast("int").alias("p")).count().collect()}
    starts, at = [], 0
    for p in range(max(counts, default=0) + 1):
        starts.append(at)
        at += counts.get(p, 0)
    start = F.element_at(F.lit(starts).cast("array<bigint>"), pid.cast("int") + 1)
    return t.withColumn(rank, start + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))).drop("__place")


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` stored with a number per row, and the number's column: a verdict joins back to exactly its row."""
    (row,) = fresh(docs, "__row")
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash (case-insensitively) with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def texts(batch_column) -> list[str]:
    """A batch's text column as Python strings, null as the empty text."""
    return [t or "" for t in batch_column.to_pylist()]


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8 (``bytes.split`` cuts at exactly these)."""
    return text.encode().split()


def lower_words(text: str) -> list[bytes]:
    """Words after lower-casing A-Z only (``bytes.lower`` leaves all other code points alone)."""
    return text.encode().lower().split()
