"""A1-A5, G3-G8, O1-O2, P5-P8 on tiny frames."""

import pytest
from pyspark.sql import functions as F

from atlaspanel.operators import analytics as A

FACT = "country_code string, country_name string, year int, gdp double, pc double, hdi double"


def _fact(spark):
    return spark.createDataFrame(
        [
            ("AAA", "Aland", 2025, 3e12, 10.0, 0.9),
            ("BBB", "Bland", 2025, None, 20.0, 0.8),
            ("CCC", "Cland", 2025, 1e12, None, None),
            ("AAA", "Aland", 2024, 2e12, 9.0, 0.85),
        ],
        FACT,
    )


def _dim(spark):
    return spark.createDataFrame(
        [("AAA", "Europe", 1), ("BBB", "Asia", 0), ("CCC", "Asia", 1)],
        "country_code string, continent string, is_brics int",
    )


def test_top_economies_nulls_excluded_and_scaled(spark):
    rows = A.top_economies(_fact(spark), 2025, "gdp", "pc", "hdi", n=10).collect()
    assert [(r.country_name, r.gdp_trillions_usd) for r in rows] == [("Aland", 3.0), ("Cland", 1.0)]


def test_top_n_puts_nulls_last(spark):
    # Descending order with NULLs last, unique tie-break
    rows = A.top_n(_fact(spark), "pc", 3, ["country_code", "year"]).collect()
    assert [r.pc for r in rows] == [20.0, 10.0, 9.0]
    asc = A.order_by(_fact(spark), [("pc", False)]).collect()
    assert asc[-1].pc is None


def test_member_trend_int_flag(spark):
    # Flags are 0/1 integers compared with = 1
    rows = A.member_trend(_fact(spark), _dim(spark), "is_brics", 2024, "hdi", "pc").collect()
    assert [(r.country_name, r.year) for r in rows] == [("Aland", 2024), ("Aland", 2025)]


def test_inequality_by_continent_latest_year(spark):
    rows = A.inequality_by_continent(_fact(spark), _dim(spark), "pc", "hdi").collect()
    assert [(r.continent, r.avg_gini, r.country_count) for r in rows] == [("Asia", 20.0, 1), ("Europe", 10.0, 1)]


def test_inequality_may_be_empty(spark):
    f = _fact(spark).filter("year = 2025").withColumn("pc", F.lit(None).cast("double"))
    assert A.inequality_by_continent(f, _dim(spark), "pc", "hdi").count() == 0


def test_schooling_listing_and_correlation(spark):
    rows = A.schooling_gdp_listing(_fact(spark), 2025, "hdi", "pc", "gdp", n=20).collect()
    assert [r.country_name for r in rows] == ["Aland", "Bland"]
    c = A.measure_correlation(_fact(spark), "gdp", "hdi").collect()[0]
    assert c.pairs == 2 and c.correlation == pytest.approx(1.0, abs=1e-12)


def test_aggregates(spark):
    f, d = _fact(spark), _dim(spark)
    assert A.sum_flags(d, ["is_brics"]).collect()[0].is_brics_members == 2
    j = A.fact_inner_dim(f, d, ["continent"])
    avg = {r.continent: r.avg_pc for r in A.group_avg(j, ["continent"], {"avg_pc": "pc"}).collect()}
    assert avg == {"Europe": 9.5, "Asia": 20.0}
    cnt = {r.continent: r.n for r in A.count_distinct(j, ["continent"], "country_code", "n").collect()}
    assert cnt == {"Europe": 1, "Asia": 2}
    assert A.scalar_max_filter(f, "year").count() == 3
    assert A.row_count(f).collect()[0].row_count == 4
    assert A.min_measure(f, "year", "m").collect()[0].m == 2024


def test_filters_and_expressions(spark):
    f = _fact(spark)
    assert A.not_null_filter(f, "gdp", "pc").count() == 2
    assert A.compare_filter(f, "year", ">=", 2025).count() == 3
    assert A.compare_filter(f, "country_name", "=", "Aland").count() == 2
    assert A.scale_column(f, "gdp", 1e12, "t").filter("t = 3.0").count() == 1
    rows = A.case_non_null_column(f, "gdp", "year", "y").collect()
    assert sorted((r.country_code, r.y) for r in rows if r.year == 2025) == [("AAA", 2025), ("BBB", None), ("CCC", 2025)]


def test_averages_are_not_rounded(spark):
    df = spark.createDataFrame([("a", 0.123456789), ("a", 0.123456788)], "g string, v double")
    assert A.group_avg(df, ["g"], {"v": "v"}).first().v == pytest.approx(0.1234567885, abs=1e-12)


def test_distinct_counts_as_bits(spark):
    rows = [(f"g{i % 3}", f"c{i % n}" if i % 7 else None) for n in (5, 130) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, c string").repartition(4)
    dictionary = A.code_dictionary(df, "c")
    want = {r.g: r.n for r in A.count_distinct(df, ["g"], "c", "n").collect()}
    bits = A.count_distinct(df, ["g"], "c", "n", dictionary=dictionary)
    assert {r.g: r.n for r in bits.collect()} == want
    plan = bits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(g#") == 1 and "Expand" not in plan
    with pytest.raises(Exception, match="more than 64 entries"):
        A.count_distinct(df, ["g"], "c", "n", dictionary=dictionary, codes=64).collect()
    with pytest.raises(Exception, match="not in the dictionary"):
        A.count_distinct(df, ["g"], "c", "n", dictionary=dictionary.filter("__code < 3")).collect()
    assert [r.n for r in A.count_distinct(df.filter("c IS NULL"), ["g"], "c", "n", dictionary=dictionary).collect()] == [0, 0, 0]
