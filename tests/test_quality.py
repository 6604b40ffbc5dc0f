"""Q1-Q14 (FIXTURES F7) and the check suites."""

import pytest

from pyspark.sql import functions as F

from atlaspanel import dictionary as D
from atlaspanel.operators import quality
from atlaspanel.operators.quality import AT_LEAST, POSITIVE, THRESHOLD, Check
from atlaspanel.plans import suites


def _measure(spark, n_invalid, n_null=3):
    rows = [(-1.0,)] * n_invalid + [(None,)] * n_null + [(5.0,)] * 2
    df = spark.createDataFrame(rows, "v double")
    rep = quality.quality_report(df, [Check("invalid_range", ("v",), lo=0, grade=THRESHOLD)], "t").collect()[0]
    return rep.measured, rep.outcome


@pytest.mark.parametrize("n,outcome", [(0, "pass"), (1, "warn"), (149, "warn"), (150, "fail")])
def test_threshold_grading(spark, n, outcome):
    # NULLs are missing, not invalid
    measured, got = _measure(spark, n)
    assert measured == float(n) and got == outcome


def test_one_report_row_per_check(spark):
    df = spark.createDataFrame(
        [(1, "a", 2000), (1, "b", None), (2, None, 2001)], "k int, s string, year int"
    )
    parent = spark.createDataFrame([(1,)], "k int")
    checks = [
        Check("row_count", grade=POSITIVE),
        Check("not_null", ("s",)),
        Check("missing_count", ("year",)),
        Check("unique", ("k",)),
        Check("unique_combination", ("k", "s")),
        Check("duplicate_count", ("k",)),
        Check("accepted_values", ("s",), values=("a",)),
        Check("invalid_values", ("s",), values=("a", "b")),
        Check("relationships", ("k",), parent="p", parent_column="k"),
        Check("min", ("year",), bound=2000, grade=AT_LEAST),
        Check("required_columns", ("k", "nope")),
    ]
    rep = quality.quality_report(df, checks, "t", parents={"p": parent})
    rows = [(r.check, r.column, r.measured, r.outcome) for r in rep.collect()]
    assert len(rows) == len(checks)
    got = {(c, col): (m, o) for c, col, m, o in rows}
    assert got[("row_count", "")] == (3.0, "pass")
    assert got[("not_null", "s")] == (1.0, "fail")
    assert got[("unique", "k")] == (1.0, "fail")
    assert got[("unique_combination", "k,s")] == (0.0, "pass")  # a NULL part is not a duplicate
    assert got[("accepted_values", "s")] == (1.0, "fail")  # NULL ignored
    assert got[("invalid_values", "s")] == (0.0, "pass")
    assert got[("relationships", "k")] == (1.0, "fail")  # 2 has no parent
    assert got[("min", "year")] == (2000.0, "pass")
    assert got[("required_columns", "k,nope")] == (1.0, "fail")


def test_gate_raises_on_fail(spark):
    df = spark.createDataFrame([(None,)], "x string")
    rep = quality.quality_report(df, [Check("not_null", ("x",))], "t")
    with pytest.raises(quality.QualityGateError):
        quality.gate(rep)


def test_suite_sizes_match_reference():
    p = suites.SuiteParams()
    assert suites.count(suites.raw_scan_checks(D.INDICATORS, p)) == 52
    assert suites.count(suites.mart_scan_checks(p)) == 20
    model = suites.source_tests(p), suites.staging_tests(p), suites.mart_tests(p)
    assert [suites.count(s) for s in model] == [15, 28, 13]


def test_dictionary_shape():
    assert len(D.INDICATORS) == 56
    assert [len(D.for_source(s)) for s in ("wb", "hdr", "weo", "fdi")] == [28, 23, 4, 1]
    assert len({i.mart for i in D.INDICATORS}) == 56
    assert len(D.label_map(D.INDICATORS)) == 28


@pytest.mark.parametrize("bound", [1 << 26, 1])
def test_orphan_count_broadcast_and_preaggregated(spark, monkeypatch, bound):
    # A hot child key (a third of the rows) and an orphan key; the parent
    # either fits the broadcast bound (map-side anti join) or does not
    # (child counted per key first, then the anti join on distinct keys).
    monkeypatch.setattr(quality, "DIMENSION_BROADCAST_MAX_BYTES", bound)
    child = spark.createDataFrame([(1,)] * 30 + [(2,)] * 50 + [(9,)] * 10 + [(None,)] * 10, "k int")
    parent = spark.range(1, 4).select(F.col("id").cast("int").alias("pk"))
    one = quality.orphan_count(child, "k", parent, "pk", "m")
    assert one.collect()[0].m == 10.0
    plan = one._jdf.queryExecution().executedPlan().toString()
    # the per-key partial count exists only when the parent is over the bound
    assert ("__rows" in plan) == (bound == 1)
    none = quality.orphan_count(child.filter("k <> 9"), "k", parent, "pk", "m")
    assert none.collect()[0].m == 0.0


def test_sql_text_metrics_quote_names_and_values(spark):
    df = spark.createDataFrame([("it's", 1), ("x", -2), (None, 3)], "`odd name` string, `v-1` int")
    checks = [
        Check("accepted_values", ("odd name",), values=("it's",)),
        Check("invalid_range", ("v-1",), lo=0, hi=2.5, grade=THRESHOLD),
        Check("missing_count", ("odd name",)),
    ]
    got = {r.check: (r.measured, r.outcome) for r in quality.quality_report(df, checks, "t").collect()}
    assert got == {"accepted_values": (1.0, "fail"), "invalid_range": (2.0, "warn"), "missing_count": (1.0, "fail")}


def _many_checks():
    return [
        Check("row_count", grade=POSITIVE), Check("not_null", ("k",)), Check("unique", ("k",)), Check("unique", ("v",)), Check("unique_combination", ("k", "y")),
        Check("unique_combination", ("y", "k")), Check("duplicate_count", ("y",)), Check("relationships", ("k",), parent="p", parent_column="pk"),
        Check("relationships", ("v",), parent="p", parent_column="pk"),
    ]


def _table(spark, path):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "x"), ("b", 2, None), (None, 2, "a"), (None, None, None), ("c", 3, "b"), ("c", 4, "a")]
    spark.createDataFrame(rows, "k string, y int, v string").write.parquet(f"{path}/t")
    spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "pk string").write.parquet(f"{path}/p")
    return spark.read.parquet(f"{path}/t"), spark.read.parquet(f"{path}/p")


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_table_is_scanned_twice_at_most(spark, scratch, monkeypatch, broadcast):
    t, parent = _table(spark, scratch)
    if not broadcast:
        monkeypatch.setattr(quality, "DIMENSION_BROADCAST_MAX_BYTES", -1)
    report = quality.quality_report(t, _many_checks(), "t", parents={"p": parent})
    got = [(r.check, r.column, r.measured) for r in report.collect()]
    assert sorted(got) == sorted([
        ("row_count", "", 8.0), ("not_null", "k", 2.0), ("unique", "k", 2.0), ("unique", "v", 2.0), ("unique_combination", "k,y", 1.0), ("unique_combination", "y,k", 1.0),
        ("duplicate_count", "y", 2.0), ("relationships", "k", 2.0), ("relationships", "v", 3.0),
    ])
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in plan.split("\n") if "FileScan" in line and f"{scratch}/t" in line]
    assert len(scans) == 2, plan


def test_key_counts_equal_a_scan_per_key(spark, scratch):
    t, _ = _table(spark, scratch)
    for keys in (["k"], ["y"], ["k", "y"], ["v", "k", "y"]):
        plain = quality.duplicate_keys(t, keys).count()
        others = [Check("unique", ("v",)), Check("unique_combination", tuple(keys))]
        got = [r.measured for r in quality.quality_report(t, others, "t").collect() if r.check == "unique_combination"]
        assert got == [float(plain)]
