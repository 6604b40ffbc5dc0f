"""Size-checked broadcast and payload order."""

import os

from pyspark.sql import functions as F

from atlaspanel.operators import joins
from atlaspanel.sources import readers


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        hinted = big.join(joins.bounded_broadcast(small, max_bytes=800), "k")
        assert "BroadcastHashJoin" in _plan(hinted)
        not_hinted = big.join(joins.bounded_broadcast(big.select("k"), max_bytes=800), "k")
        assert "BroadcastHashJoin" not in _plan(not_hinted)
        assert not_hinted.count() == 1000
        # a derivative is judged by the frame it comes from
        out = joins.bounded_broadcast(big.select("k").limit(3), max_bytes=800, bounded_by=big)
        assert "Hint broadcast" not in out._jdf.queryExecution().logical().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_check_runs_no_job(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(100).write.parquet(path)
    dim = spark.read.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    joins.bounded_broadcast(dim)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_payload_order_follows_files_and_rows(spark, tmp_path):
    d = str(tmp_path)
    for i, rows in enumerate([[("a", 1), ("b", 2)], [("c", 3)]]):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.parquet(os.path.join(d, f"f{i}"))
    df = spark.read.parquet(os.path.join(d, "f0"), os.path.join(d, "f1"))
    paths = [os.path.join(d, "f0"), os.path.join(d, "f1")]
    keyed = readers.payload_order(df, parquet=True, path=paths)
    out = keyed.orderBy("ingest_seq").collect()
    # the payload is scanned once; its files are ranked from their listing
    assert keyed._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert [r.k for r in out] == ["a", "b", "c"]
    assert dict(keyed.dtypes)["ingest_seq"] == "decimal(38,0)"
    assert F is not None


def test_payload_order_ranks_many_files_in_parallel(spark, tmp_path):
    # 120 files over several range partitions: sorting by the key gives path
    # order, then row order within a file; no single-partition window
    d = str(tmp_path)
    for i in range(120):
        with open(os.path.join(d, f"p{i:03d}.json"), "w") as fh:
            fh.write("".join('{"f": %d, "r": %d}\n' % (i, r) for r in range(3)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.read.schema("f int, r int").json(os.path.join(d, "p*.json"))
        files = df.select(F.col("_metadata.file_path").alias("__file")).distinct()
        parts = readers._file_ranks(files).select(F.shiftright("__rank", 33).alias("p")).distinct().count()
        assert parts > 1  # ranks come from several range partitions
        keyed = readers.payload_order(df, parquet=False, path=d)
        got = [(r.f, r.r) for r in keyed.orderBy("ingest_seq").collect()]
        plan = keyed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == [(i, r) for i in range(120) for r in range(3)]
    assert "Window" not in plan


def test_payload_order_exact_across_text_splits(spark, tmp_path):
    # JSON lines split into many tasks (tiny split size), several splits packed
    # per task: sorting by the key restores file order, file by file.
    d = str(tmp_path)
    with open(os.path.join(d, "a.json"), "w") as fh:
        fh.write("".join('{"i": %d, "pad": "%s"}\n' % (i, "x" * (i % 13)) for i in range(3000)))
    with open(os.path.join(d, "b.json"), "w") as fh:
        fh.write("".join('{"i": %d, "pad": ""}\n' % (10_000 + i) for i in range(50)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = spark.read.schema("i int, pad string").json(d)
        assert df.rdd.getNumPartitions() > 10
        keyed = readers.payload_order(df, parquet=False, path=d)
        assert dict(keyed.dtypes)["ingest_seq"] == "decimal(38,0)"
        got = [r.i for r in keyed.orderBy("ingest_seq").select("i").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(range(3000)) + [10_000 + i for i in range(50)]
