"""V1-V12 on the FIXTURES F3 cases."""

import pytest
from pyspark.sql import functions as F

from atlaspanel.operators import rules
from atlaspanel.plans.pipeline import SourceConfig, point_rules, validate_points

RAW = "country_code string, country_name string, year string, indicator string, value string, ingest_seq long"


def _errors(spark, rows, cfg):
    df = spark.createDataFrame(rows, RAW)
    valid, rejects = validate_points(df, cfg)
    errs = {r.ingest_seq: list(r.errors) for r in rejects.collect()}
    return valid, errs


def test_code_length_and_year_rules(spark):
    a = SourceConfig("wb", (), year_lo=2000, year_hi=2025, year_is_text=True)
    b = SourceConfig("hdr", (), year_lo=1990, year_hi=2025, year_is_text=True)
    rows = [
        ("A", "n", "2001", "x", "1", 1),  # code of 1 character
        ("ABCD", "n", "2001", "x", "1", 2),  # code of 4 characters
        ("AAA", "n", "1999", "x", "1", 3),  # below WB floor, fine for HDR
        ("AAA", "n", "2030", "x", "1", 4),  # beyond the upper bound
        ("AAA", "n", "20x1", "x", "1", 5),  # year text
        ("AAA", "n", "2001", "x", "abc", 6),  # non-numeric value
        ("AAA", "n", "2001", "x", None, 7),  # missing value: valid, NULL
        ("AAA", "n", "2001", "x", "NaN", 8),  # NaN: valid, NULL
    ]
    valid_a, ea = _errors(spark, rows, a)
    assert ea[1] == ["code_length"] and ea[2] == ["code_length"]
    assert ea[3] == ["year_range"] and ea[4] == ["year_range"]
    assert ea[5] == ["year_text"] and ea[6] == ["value_text"]
    assert 7 not in ea and 8 not in ea
    vals = {r.ingest_seq: r.value for r in valid_a.collect()}
    assert vals[7] is None and vals[8] is None
    _valid_b, eb = _errors(spark, rows, b)
    assert 3 not in eb  # 1990-1999 valid for the HDR-like source (T13)


def test_aggregate_codes_both_rules_fire(spark):
    cfg = SourceConfig("fdi", (), year_lo=2000, year_hi=2025, check_aggregates=True, year_is_text=True)
    _v, errs = _errors(spark, [("1C_080", "n", "2001", "x", "1", 1), ("XALLC", "n", "2001", "x", "1", 2)], cfg)
    assert errs[1] == ["code_length", "aggregate"]
    assert errs[2] == ["code_length", "aggregate"]


def test_valid_plus_rejects_is_input(spark):
    cfg = SourceConfig("wb", (), year_lo=2000, year_hi=2025, year_is_text=True)
    rows = [("AAA", "n", str(2000 + i % 40), "x", "1" if i % 3 else "bad", i) for i in range(200)]
    df = spark.createDataFrame(rows, RAW)
    valid, rejects = rules.split_valid_rejects(df, point_rules(cfg))
    assert valid.count() + rejects.count() == 200


def test_required_fields(spark):
    df = spark.createDataFrame([(None, "x"), ("n", None), ("n", "x")], "Country string, indicator string")
    out = [r.e for r in df.select(rules.check_required("Country", "indicator").alias("e")).collect()]
    assert out == ["missing_Country", "missing_indicator", None]


def test_window_is_half_open(spark):
    df = spark.createDataFrame([(y,) for y in (1999, 2000, 2025, 2026)], "year int")
    assert [r.year for r in rules.filter_year_window(df, 2000, 2026).collect()] == [2000, 2025]


def test_drop_null_values(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "k int, value double")
    assert rules.drop_null_values(df).count() == 1


def test_reject_summary_and_sample(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "k int, errors array<string>")
    summary = {(r.error, r.rejects) for r in rules.reject_summary(df, source="s").collect()}
    assert summary == {("a", 2), ("b", 1)}
    assert [r.k for r in rules.reject_sample(df, ["k"], 1).collect()] == [1]


def test_load_profile(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "x")], "country_code string, indicator string")
    r = rules.load_profile(df).collect()[0]
    assert (r.indicators, r.countries, r.points) == (2, 2, 3)


def test_require_rows_raises_on_empty(spark):
    empty = spark.createDataFrame([], "x int")
    with pytest.raises(rules.EmptySourceError):
        rules.require_rows(empty, "fdi")
    assert rules.require_rows(spark.range(1), "ok") is not None


def test_cast_year_ansi_raises_on_text(spark):
    # Staging casts with ANSI semantics; validation uses try_cast instead
    from atlaspanel.operators.conform import cast_year

    df = spark.createDataFrame([("20x1",)], "year string")
    assert df.select(rules.coerce_year_text("year").alias("y")).collect()[0].y is None
    with pytest.raises(Exception):
        cast_year(df).collect()
    assert F is not None


def test_counted_rejects_expand_in_bounded_steps(spark):
    rows = [("AAAA", 1.5, ["code_length"]), ("B", None, ["code_length", "missing"]), ("AAAA", 1.5, ["code_length"])]
    rejects = spark.createDataFrame(rows, "country_code string, value double, errors array<string>")
    counted = rules.count_rejects(rejects)
    assert sorted(r.occurrences for r in counted.collect()) == [1, 2]
    key = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert key(rules.expand_rejects(counted)) == key(rejects)
    for n in (1, 65_535, 65_536, 65_537, 10_000_000):
        many = counted.limit(1).withColumn("occurrences", F.lit(n).cast("long"))
        assert rules.expand_rejects(many).count() == n
    counted.createOrReplaceTempView("counted_rejects")
    assert key(spark.sql(rules.expand_rejects_sql("counted_rejects", rejects.columns, step=2))) == key(rejects)


def test_a_reject_of_three_billion(spark):
    n = 3_000_000_000
    counted = spark.createDataFrame([("AAAA", ["code_length", "year_range"], n), ("B", ["code_length"], 2)], "country_code string, errors array<string>, occurrences long")
    summary = {r.error: r.rejects for r in rules.reject_summary(counted, "a", count_col="occurrences").collect()}
    assert summary == {"code_length": n + 2, "year_range": n}
    # the expansion's first step makes one small row per 65,536; every second step is that long at most
    assert rules.expand_rejects(counted).limit(100_000).count() == 100_000


def test_counted_and_repeated_rejects_have_one_summary(spark):
    rejects = spark.createDataFrame([("A", ["x", "y"]), ("A", ["x", "y"]), ("B", ["y"])], "code string, errors array<string>")
    plain = {(r.error, r.rejects) for r in rules.reject_summary(rejects, "s").collect()}
    counted = {(r.error, r.rejects) for r in rules.reject_summary(rules.count_rejects(rejects), "s", count_col="occurrences").collect()}
    assert plain == counted == {("x", 2), ("y", 3)}
