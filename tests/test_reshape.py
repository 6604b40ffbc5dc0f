"""R1-R6 on tiny literal frames (FIXTURES F2, F3)."""

import math

from pyspark.sql import functions as F

from atlaspanel.operators import reshape

POINT_SCHEMA = "country_code string, country_name string, year int, indicator string, value double, ingest_seq long"


def test_pivot_first_non_null_by_order(spark):
    # same cell NULL at seq 1, 5.0 at seq 2, 7.0 at seq 3 -> 5.0 (T5)
    pts = spark.createDataFrame(
        [
            ("AAA", "A", 2001, "x", None, 1),
            ("AAA", "A", 2001, "x", 7.0, 3),
            ("AAA", "A", 2001, "x", 5.0, 2),
            ("AAA", "A", 2001, "y", 1.5, 9),
        ],
        POINT_SCHEMA,
    )
    out = reshape.pivot_indicators(pts, ["country_code", "country_name", "year"], ["x", "y", "z"]).collect()
    assert len(out) == 1
    assert out[0]["x"] == 5.0 and out[0]["y"] == 1.5 and out[0]["z"] is None


def test_pivot_drops_all_null_key_and_nan(spark):
    # a country-year with only NULL/NaN values is absent after the pivot
    pts = spark.createDataFrame(
        [
            ("AAA", "A", 2001, "x", None, 1),
            ("AAA", "A", 2001, "y", float("nan"), 2),
            ("BBB", "B", 2001, "x", 2.0, 3),
        ],
        POINT_SCHEMA,
    )
    out = reshape.pivot_indicators(pts, ["country_code", "country_name", "year"], ["x", "y"]).collect()
    assert [r.country_code for r in out] == ["BBB"]


def test_pivot_unknown_indicator_keeps_key(spark):
    pts = spark.createDataFrame([("AAA", "A", 2001, "unknown", 3.0, 1)], POINT_SCHEMA)
    out = reshape.pivot_indicators(pts, ["country_code", "country_name", "year"], ["x"]).collect()
    assert len(out) == 1 and out[0]["x"] is None


def test_pivot_ties_resolve_to_smallest_value(spark):
    pts = spark.createDataFrame(
        [("AAA", "A", 2001, "x", 9.0, 1), ("AAA", "A", 2001, "x", 4.0, 1), ("AAA", "A", 2001, "x", 1.0, 2)],
        POINT_SCHEMA,
    )
    out = reshape.pivot_indicators(pts, ["country_code", "year"], ["x"], order_unique=False).collect()
    assert out[0]["x"] == 4.0


def test_unpivot_keeps_nulls_and_casts_year(spark):
    # wide year frame with a NULL year cell
    wide = spark.createDataFrame(
        [("AAA", "GDP", "Aland", 1.0, None), ("BBB", "GDP", "Bland", 2.0, 3.0)],
        "country_code string, indicator string, Country string, `2000` double, `2001` double",
    )
    long = reshape.unpivot_years(wide, ["country_code", "Country", "indicator"])
    rows = sorted(long.collect())
    assert len(rows) == 4
    assert dict(long.dtypes)["year"] == "int"
    assert any(r.value is None for r in rows)


def test_unpivot_then_pivot_roundtrip(spark):
    # invariant: unpivot . pivot = the non-null cells
    wide = spark.createDataFrame(
        [("AAA", "A", 2001, 1.0, None), ("BBB", "B", 2001, None, 2.0)],
        "country_code string, country_name string, year int, x double, y double",
    )
    long = wide.unpivot(["country_code", "country_name", "year"], ["x", "y"], "indicator", "value").withColumn(
        "ingest_seq", F.lit(1).cast("long")
    )
    back = reshape.pivot_indicators(long, ["country_code", "country_name", "year"], ["x", "y"])
    assert sorted(back.collect()) == sorted(wide.collect())


def test_concat_chunks_differing_columns(spark):
    a = spark.createDataFrame([("AAA", 1.0)], "economy string, `2000` double")
    b = spark.createDataFrame([("BBB", 2.0)], "economy string, `2001` double")
    out = reshape.concat_chunks([a, b])
    assert set(out.columns) == {"economy", "2000", "2001"}
    assert out.count() == 2


def test_label_mapping_and_unmapped_report(spark):
    # T4: a label not in the dictionary yields NULL and shows up in the report
    mapping = {"GDP (constant 2015 US$)": "NY_GDP_MKTP_KD"}
    codes = ["NY_GDP_MKTP_KD", "SP_POP_TOTL"]
    df = spark.createDataFrame(
        [("GDP (constant 2015 US$)",), ("SP_POP_TOTL",), ("Poverty at $3.00",), ("Poverty at $3.00",)],
        "indicator string",
    )
    mapped = [r.indicator for r in reshape.map_labels_to_codes(df, mapping, codes).collect()]
    assert mapped == ["NY_GDP_MKTP_KD", "SP_POP_TOTL", None, None]
    rep = reshape.unmapped_indicators(df, mapping, codes).collect()
    assert [(r.label, r.points) for r in rep] == [("Poverty at $3.00", 2)]


def test_conform_columns(spark):
    df = spark.createDataFrame([("AAA", 2001, 1.0, 2.0)], "country_code string, year int, a double, extra double")
    out = reshape.conform_columns(df, ["country_code", "year"], ["b", "a"])
    assert out.columns == ["country_code", "year", "b", "a"]
    r = out.collect()[0]
    assert r.b is None and r.a == 1.0
    assert not any(math.isnan(x) for x in [r.a])
