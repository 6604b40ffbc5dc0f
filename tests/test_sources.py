"""Landed files and tables, written and read back."""

import json
import os

import pytest
from pyspark.sql import functions as F

from atlaspanel.sources import readers, sinks

SEED_CSV = """country_name,iso3,iso2,continent,region,income_group,EU,OECD,ASEAN,BRICS,G20,FCS
Namibia,NAM,NA,Africa,Sub-Saharan Africa,Upper middle income,0,0,0,0,0,0
"Tanzania, United Republic of",TZA,TZ,Africa,Sub-Saharan Africa,Lower middle income,0,0,0,0,0,0
Nowhere,NWH,,Europe,Europe & Central Asia,High income,1,1,0,0,0,0
"""


def test_seed_csv_na_stays_text_empty_is_null(spark, scratch):
    # Namibia's ISO2 is the literal NA; only the empty field is NULL
    path = os.path.join(scratch, "seed.csv")
    open(path, "w").write(SEED_CSV)
    rows = {r.iso3: r for r in readers.read_country_seed(spark, path).collect()}
    assert rows["NAM"].iso2 == "NA"
    assert rows["TZA"].country_name == "Tanzania, United Republic of"
    assert rows["NWH"].iso2 is None
    assert rows["NWH"].EU == 1 and isinstance(rows["NWH"].OECD, int)


def test_point_records_json_array(spark, scratch):
    path = os.path.join(scratch, "hdr.json")
    recs = [{"countryIsoCode": "AFG", "country": "Afghanistan", "year": 2020, "indicatorCode": "hdi", "value": 0.5}]
    open(path, "w").write(json.dumps(recs, indent=1))
    r = readers.read_point_records(spark, path, multi_line=True).collect()[0]
    assert (r.countryIsoCode, r.year, r.indicatorCode, float(r.value)) == ("AFG", "2020", "hdi", 0.5)


def test_nested_map_payload(spark, scratch):
    path = os.path.join(scratch, "weo.json")
    doc = {"values": {"BCA": {"USA": {"1999": 1.0, "2001": 2.5}, "DEU": {"2001": None}}}}
    open(path, "w").write(json.dumps(doc))
    rows = sorted((r.country_code, r.indicator, r.year, r.value) for r in readers.read_nested_map(spark, path).collect())
    assert rows == [("DEU", "BCA", "2001", None), ("USA", "BCA", "1999", "1.0"), ("USA", "BCA", "2001", "2.5")]


def test_parallel_arrays_zip_truncates(spark, scratch):
    path = os.path.join(scratch, "fdi.json")
    doc = {
        "series": {
            "docs": [
                {"dimensions": {"REF_AREA": "US"}, "period": ["2000", "2001"], "value": [0.5, None]},
                {"dimensions": {"REF_AREA": "DE"}, "period": ["2000", "2001", "2002"], "value": [0.1]},
            ]
        }
    }
    open(path, "w").write(json.dumps(doc))
    rows = sorted((r.country_code, r.year, r.value) for r in readers.read_parallel_arrays(spark, path).collect())
    assert rows == [("DE", "2000", "0.1"), ("US", "2000", "0.5"), ("US", "2001", None)]


def test_wide_years_renames(spark, scratch):
    df = spark.createDataFrame([("AAA", "GDP", "Aland", 1.0)], "economy string, Series string, Country string, `2000` double")
    path = sinks.land_parquet(df, os.path.join(scratch, "wide"))
    out = readers.read_wide_years(spark, path)
    assert out.columns == ["country_code", "indicator", "Country", "2000"]


def test_replace_table_keeps_last_write(spark):
    first = spark.createDataFrame([(1,), (2,)], "k int")
    second = spark.createDataFrame([(3,)], "k int")
    sinks.replace_table(first, "t_raw", "t")
    sinks.replace_table(second, "t_raw", "t")
    assert [r.k for r in readers.read_layer_table(spark, "t_raw", "t").collect()] == [3]
    assert sinks.load_row_count(readers.read_layer_table(spark, "t_raw", "t"), "t").collect()[0].loaded_rows == 1


def test_ensure_layer_idempotent(spark):
    assert sinks.ensure_layer(spark, "t_layer") == "t_layer"
    assert sinks.ensure_layer(spark, "t_layer") == "t_layer"
    assert "t_layer" in [d.name for d in spark.catalog.listDatabases()]


def test_csv_backup_roundtrip(spark, scratch):
    df = spark.createDataFrame([("AAA", 2001, 1.25), ("BBB", 2002, None)], "country_code string, year int, v double")
    path = sinks.export_csv_backup(df, os.path.join(scratch, sinks.backup_name("wb", 2000, 2026)))
    assert path.endswith("wb_2000_2026")
    back = spark.read.schema(df.schema).option("header", True).option("nullValue", "").csv(path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_unreadable_json_loses_nothing_else(spark, scratch):
    """A bad cell is one text value; a broken document is one reject; all other points stay."""
    path = os.path.join(scratch, "weo.json")
    good = {"values": {"BCA": {"USA": {"2001": 1.0, "2002": "n/a", "2003": 2.5}, "DEU": {"2001": 4}, "FRA": {"2001": None}}}}
    open(path, "w").write(json.dumps(good) + "\n{broken\n" + json.dumps({"values": {"BCA": {"ITA": {"2001": 7.5}}}}) + "\n{}\n")
    rows = [tuple(r) for r in readers.read_nested_map(spark, path).collect()]
    assert sorted(rows, key=str) == sorted(
        [("USA", "BCA", "2001", "1.0"), ("USA", "BCA", "2002", "n/a"), ("USA", "BCA", "2003", "2.5"), ("DEU", "BCA", "2001", "4"),
         ("FRA", "BCA", "2001", None), ("ITA", "BCA", "2001", "7.5"), (None, None, None, "{broken")], key=str)
    multi = os.path.join(scratch, "multi.json")
    open(multi, "w").write(json.dumps(good, indent=1))
    assert readers.read_nested_map(spark, multi, multi_line=True).count() == 5

    path = os.path.join(scratch, "fdi.json")
    doc = {"series": {"docs": [{"dimensions": {"REF_AREA": "US"}, "period": ["2000", "2001"], "value": [0.5, "n/a"]}, {"dimensions": {"REF_AREA": "DE"}, "period": [], "value": []}]}}
    open(path, "w").write(json.dumps(doc) + "\n[broken\n")
    rows = [tuple(r) for r in readers.read_parallel_arrays(spark, path).collect()]
    assert sorted(rows, key=str) == sorted([("US", "2000", "0.5"), ("US", "2001", "n/a"), (None, None, "[broken")], key=str)

    path = os.path.join(scratch, "hdr.json")
    open(path, "w").write('{"countryIsoCode": "NAM", "year": 2020, "value": 1}\n{broken\n')
    rows = [(r.countryIsoCode, r.year, r.value) for r in readers.read_point_records(spark, path).collect()]
    assert sorted(rows, key=str) == sorted([("NAM", "2020", "1"), (None, None, "{broken")], key=str)


def test_publish_view_and_head_sample(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "k int, name string")
    sinks.publish_view(df, "v_test")
    assert spark.table("v_test").count() == 10
    assert [r.k for r in readers.head_sample(df, ["k"], ["k"], 5).collect()] == [0, 1, 2, 3, 4]


def test_wide_chunks_keep_every_year(spark, tmp_path):
    first = spark.createDataFrame([("AAA", "x", 1.0, 2.0)], "economy string, Series string, `2000` double, `2001` double")
    second = spark.createDataFrame([("AAA", "x", 3.0, 4.0)], "economy string, Series string, `2002` double, `2001` double")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        for i, chunk in enumerate((first, second)):
            chunk.coalesce(1).write.option("header", True).format(fmt).save(f"{path}/{i}")
        got = readers.read_wide_years(spark, path, fmt=fmt, ordered=True).orderBy("ingest_seq").collect()
        cells = [tuple(None if r[y] is None else float(r[y]) for y in ("2000", "2001", "2002")) for r in got]
        assert cells == [(1.0, 2.0, None), (None, 4.0, 3.0)]


def _versions(spark, layer, name):
    return sinks.versions(spark, layer, name)


def test_a_reader_always_sees_a_whole_table(spark):
    """While a table is replaced again and again, every read gives one version whole."""
    import threading

    n = 5000
    sinks.replace_table(spark.range(n).withColumn("v", F.lit(0)), "t_pub", "t")
    stop, seen, faults = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                r = spark.table("t_pub.t").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).first()
                seen.append((r.n, r.a, r.b))
            except Exception as e:  # noqa: BLE001
                faults.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 6):
        sinks.replace_table(spark.range(n).withColumn("v", F.lit(v)), "t_pub", "t")
    stop.set()
    reader.join()
    assert not faults and seen
    assert all(a == b and rows == n for rows, a, b in seen)
    assert [a for _, a, _ in seen] == sorted(a for _, a, _ in seen)
    assert len(_versions(spark, "t_pub", "t")) == 1 + sinks.KEEP


def test_a_failed_write_leaves_the_table(spark):

    sinks.replace_table(spark.range(3), "t_fail", "t")
    with pytest.raises(Exception, match="stop here"):
        sinks.replace_table(spark.range(9).select(F.raise_error(F.lit("stop here")).alias("id")), "t_fail", "t")
    assert spark.table("t_fail.t").count() == 3
    # columns may change from one version to the next, and a table may be replaced from itself
    sinks.replace_table(spark.table("t_fail.t").withColumn("w", F.lit("x")), "t_fail", "t")
    assert spark.table("t_fail.t").columns == ["id", "w"]
    # a plain table of an earlier layout gives way; a name that begins alike is another table
    spark.range(2).write.saveAsTable("t_fail.old")
    spark.range(1).createOrReplaceTempView("old")  # a session's view of that name is not the stored one
    sinks.replace_table(spark.range(5), "t_fail", "old")
    sinks.replace_table(spark.range(7), "t_fail", "old_v")
    assert spark.table("t_fail.old").count() == 5 and len(_versions(spark, "t_fail", "old")) == 1


def test_clustered_tables(spark):
    rows = [(f"C{(i * 37) % 200:03d}" if i % 50 else None, i % 17, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "code string, year int, v long").repartition(5)
    for _ in range(4):  # an index goes with its version
        sinks.replace_table(df, "t_clu", "t", cluster_by=(6, ["code", "year"]))
    assert len([r for r in spark.sql("SHOW TABLES IN t_clu LIKE 't__i*'").collect()]) == 1 + sinks.KEEP
    whole = readers.read_clustered(spark, "t_clu", "t", ordered=True)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    got = [(r.code, r.year) for r in whole.collect()]
    assert got == [(r.code, r.year) for r in df.orderBy(F.col("code").asc_nulls_last(), F.col("year").asc_nulls_last()).collect()]
    assert sorted(r.v for r in whole.collect()) == list(range(2000))
    # a key filter opens the file that holds it (two, if the key lies on a boundary)
    for code in ("C000", "C099", "C150"):
        one = readers.read_clustered(spark, "t_clu", "t", where={"code": (code, code)})
        assert len(one.inputFiles()) <= 2 < 6
        assert sorted(r.v for r in one.collect()) == sorted(v for c, _, v in rows if c == code)
    some = readers.read_clustered(spark, "t_clu", "t", where={"code": ("C010", "C020"), "year": (3, None)}, ordered=True)
    assert [(r.code, r.year) for r in some.collect()] == sorted((c, y) for c, y, _ in rows if c and "C010" <= c <= "C020" and y >= 3)
    assert readers.read_clustered(spark, "t_clu", "t", where={"code": ("X", None)}).collect() == []


def test_files_larger_than_a_partition_are_sorted(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.pmod(F.col("id") * 7919, F.lit(5000)).cast("string")).alias("k"), "id")
    sinks.replace_table(df, "t_clu", "big", cluster_by=(2, ["k"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = readers.read_clustered(spark, "t_clu", "big", ordered=True)
        assert "Exchange rangepartitioning" in got._jdf.queryExecution().executedPlan().toString()
        assert [r.k for r in got.collect()] == sorted(f"k{i}" for i in range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [readers._bytes(x) for x in ("134217728b", "128m", "4k", "1gb", "10")] == [1 << 27, 1 << 27, 4096, 1 << 30, 10]
