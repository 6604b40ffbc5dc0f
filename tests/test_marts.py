"""G1/G2/J5 on FIXTURES F6, spine/fact invariants (U*, J3, J4)."""

from pyspark.sql import functions as F

from atlaspanel.operators import conform, marts, spine

FACT = "country_code string, country_name string, year int, x double"


def _f6(spark):
    dim = spark.createDataFrame([("AAA", "Aland"), ("BBB", "Bland")], "country_code string, country_name string")
    fact = spark.createDataFrame(
        [("AAA", "Aland", 2001, 9.0), ("AAA", "Aland", 2003, 4.0), ("AAA", "Aland", 2004, None)], FACT
    )
    return dim, fact


def test_peak_and_last_year_is_not_latest(spark):
    # value = MAX(value), year = MAX(year with a value), independently
    dim, fact = _f6(spark)
    rows = {r.country_code: r for r in marts.peak_and_last_year(dim, fact, ["x"]).collect()}
    assert (rows["AAA"].x, rows["AAA"].x_year) == (9.0, 2003)
    assert (rows["BBB"].x, rows["BBB"].x_year) == (None, None)


def test_latest_value_is_value_at_latest_year(spark):
    dim, fact = _f6(spark)
    rows = {r.country_code: r for r in marts.latest_value(dim, fact, ["x"]).collect()}
    assert (rows["AAA"].x, rows["AAA"].x_year) == (4.0, 2003)
    assert (rows["BBB"].x, rows["BBB"].x_year) == (None, None)


def test_dim_left_fact_keeps_countries_without_facts(spark):
    dim, fact = _f6(spark)
    out = marts.dim_left_fact(dim, fact, ["x"]).collect()
    assert len(out) == 4 and any(r.country_code == "BBB" and r.year is None for r in out)


def test_mart_rows_equal_dimension_rows(spark):
    dim, fact = _f6(spark)
    assert marts.peak_and_last_year(dim, fact, ["x"]).count() == dim.count()


def _sources(spark):
    a = spark.createDataFrame([("AAA", 2001, 1.0), ("BBB", 2002, 2.0)], "country_code string, year int, a double")
    b = spark.createDataFrame([("AAA", 2001, 3.0), ("CCC", 2003, 4.0)], "country_code string, year int, b double")
    return a, b


def test_spine_unique_and_fact_rows_equal_spine_rows(spark):
    a, b = _sources(spark)
    dim = spark.createDataFrame(
        [("AAA", "Aland"), ("BBB", "Bland"), ("CCC", "Cland")], "country_code string, country_name string"
    )
    sp = spine.spine_distinct([a, b])
    assert sp.count() == sp.distinct().count() == 3
    fact = spine.fact_panel(sp, dim, [a, b], ["a", "b"])
    assert fact.count() == 3
    assert fact.columns == ["country_code", "country_name", "year", "a", "b"]


def test_outer_merge_equals_spine_left_joins_even_with_duplicates(spark):
    a, b = _sources(spark)
    b = b.unionByName(spark.createDataFrame([("AAA", 2001, 5.0)], "country_code string, year int, b double"))
    sp = spine.spine_distinct([a, b])
    left = spine.merge_sources_on_spine(sp, [a, b]).select("country_code", "year", "a", "b")
    outer = spine.outer_merge([a, b]).select("country_code", "year", "a", "b")
    assert sorted(left.collect()) == sorted(outer.collect())
    assert left.count() == 4


def test_union_ops(spark):
    a, b = _sources(spark)
    assert spine.union_all([a, b]).count() == 4
    assert spine.union_distinct(a, a, ["country_code", "year"]).count() == 2
    assert spine.distinct_pairs(a.unionByName(a), ["country_code"]).count() == 2


def test_iso2_join_translates_and_keeps_na(spark):
    # ISO2 'NA' is a real code
    seed = spark.createDataFrame(
        [("Namibia", "NAM", "NA"), ("Tanzania", "TZA", "TZ")], "country_name string, iso3 string, iso2 string"
    )
    fdi = spark.createDataFrame([("NA", 2001, 0.2), ("XX", 2001, 0.3)], "country_code string, year int, v double")
    out = conform.join_dim_iso2(fdi, seed).collect()
    assert [(r.country_code, r.country_name, r.v) for r in out] == [("NAM", "Namibia", 0.2)]


def test_iso3_join_drops_non_members(spark):
    seed = spark.createDataFrame([("Aland", "AAA", "AA")], "country_name string, iso3 string, iso2 string")
    raw = spark.createDataFrame([("AAA", 1), ("ZZZ", 2)], "country_code string, k int")
    assert [r.country_code for r in conform.join_dim_iso3(raw, seed).collect()] == ["AAA"]


def test_conform_dimension_renames_flags(spark):
    seed = spark.createDataFrame(
        [("Aland", "AAA", "AA", "Europe", "R", "High income", 1, 0, 0, 0, 1, 0)],
        "country_name string, iso3 string, iso2 string, continent string, region string, income_group string, "
        "EU int, OECD int, ASEAN int, BRICS int, G20 int, FCS int",
    )
    dim = conform.dim_country(conform.conform_dimension(seed))
    assert dim.columns[:2] == ["country_code", "country_name"]
    assert dim.filter(F.col("is_eu") == 1).count() == 1
