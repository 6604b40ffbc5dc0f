"""Sharding: longest-processing-time scheduling of groups that stay together.

Groups, largest first, go to the least-loaded shard through a heap. The heap
runs on the driver over a list bounded by parameters, never over all groups:
a group of at least ``grain`` bytes is an item of its own (there are at most
total / grain of them) and the smaller groups are first strung together, in
buckets, into bundles of about ``grain`` bytes. ``grain`` is the mean shard
divided by ``grains``, so shards end within about one grain of each other
unless a single group is larger than a shard.

Defined results: a null text is a group of its own (all null texts together)
with no bytes; equal texts and repeated rows share a shard; ties in size are
settled by the group's digest; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlaspanel.llm.common import ranked, stored

#: Groups per bucket of the bundling step, until there are as many buckets as grains.
GROUPS_PER_BUCKET = 1_000


def longest_first(items: list[tuple[int, object]], shards: int) -> dict:
    """Item -> shard: largest first onto the least-loaded shard (ties: fewest items, then lowest number)."""
    heap = [(0, 0, s) for s in range(shards)]
    out = {}
    for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
        load, count, s = heapq.heappop(heap)
        out[item] = s
        heapq.heappush(heap, (load + size, count + 1, s))
    return out


def schedule_groups(spark: SparkSession, groups: DataFrame, shards: int, grains: int = 512) -> DataFrame:
    """``groups`` (group string, bytes long; one row each) -> (group, shard)."""
    total, count = groups.agg(F.sum("bytes"), F.count("*")).first()
    grain = max(int(total or 0) // (shards * grains), 1)
    buckets = max(min(int(count) // GROUPS_PER_BUCKET, shards * grains), 1)
    alone = F.col("bytes") >= grain
    # strung together largest first within a bucket, cut whenever a grain is full
    order = Window.partitionBy("bucket", "alone").orderBy(F.desc("bytes"), "group")
    before = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    nth = F.row_number().over(order)
    placed = stored(
        groups.withColumn("alone", alone)
        .withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
        .withColumn("bundle", F.when(F.col("alone"), nth.cast("long")).otherwise((F.coalesce(before, F.lit(0)) / F.lit(grain)).cast("long"))),
        "shard-bundles",
    )
    keys = ["bucket", "alone", "bundle"]
    bundles = placed.groupBy(*keys).agg(F.sum("bytes").alias("bytes"))
    # at most shards * grains large groups, as many full bundles and one more a bucket: 3 * shards * grains rows
    items = [(r["bytes"], (r["bucket"], r["alone"], r["bundle"])) for r in bundles.toLocalIterator()]
    shard_of = longest_first(items, shards)
    table = spark.createDataFrame([(*k, s) for k, s in shard_of.items()], "bucket long, alone boolean, bundle long, shard int")
    return placed.join(table, keys).select("group", "shard")


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) by the law ``bytes``.

    ``slot`` numbers a shard's rows from 0 without a gap: all rows are ranked by
    a range-partitioned sort that starts with the shard, and a shard's first
    rank is taken off.
    """
    text = F.col(text_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            size.alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(text, 256), F.lit("null")).alias("group"),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    shard_of = schedule_groups(spark, groups, shards)
    assigned = rows.join(shard_of, "group").select("doc_id", "size", "text_crc32", "shard")
    # ids, not texts, spread a shard's rows (a text may be held by very many of them)
    order = ["shard", F.xxhash64("doc_id", "size"), "doc_id", "text_crc32"]
    placed = ranked(assigned, order, "shard-slots")
    first = {r["shard"]: r["start"] for r in placed.groupBy("shard").agg(F.min("rank").alias("start")).collect()}  # one row per shard
    start = F.element_at(F.lit([first.get(s, 0) for s in range(shards)]).cast("array<bigint>"), F.col("shard") + 1)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
