"""Registered queries: one per operator of the inventory, on the test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. The stand-in inputs follow
SURVEY §7.2; fault injections (bad codes, bad year text, non-numeric values)
are defined here, next to the query that exercises them. Queries that round
-trip a source or sink write under the shared checkpoint folder
(``spark.checkpoint.dir``) and read the files back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.dictionary import codes
from atlaspanel.functions import exprs as X
from atlaspanel.operators import analytics as A
from atlaspanel.operators import conform, marts, quality, reshape, rules, spine
from atlaspanel.operators.quality import AT_LEAST, POSITIVE, THRESHOLD, Check
from atlaspanel.plans import panel as PN
from atlaspanel.plans import pipeline as P
from atlaspanel.plans import standins as S
from atlaspanel.session import configure, scratch_path
from atlaspanel.sources import readers, sinks

# Stand-in parameters of the analyst questions (columns of the stand-in fact).
TOP_YEAR = 2001
GDP, GDP_PC, HDI, SCHOOLING = "a_urgent", "a_high", "b_a_f", "b_r_o"
GINI, INEQ = "c_click", "c_error"
MEMBER_FLAG, MEMBER_SINCE = "is_brics", 1998
NON_MEMBER_FROM = 20  # J1/J2: the dimension restricted to nation keys below this


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Six places, for the comparison with the oracle only: sums of doubles depend on their order."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _panel(spark: SparkSession, sf_dir: str) -> PN.StandinPanel:
    return PN.StandinPanel(configure(spark), sf_dir)


# ---------------------------------------------------------------- sources ----


def read_country_seed(spark, sf_dir):
    """The seed (nation x region) landed as CSV with a literal 'NA' code,
    an empty code and a quoted comma, read back."""
    p = _panel(spark, sf_dir)
    seed = S.country_seed(p.t).withColumn("__k", F.substring("iso3", 2, 2).cast("int"))
    landed = seed.select(
        F.when(F.col("__k") == 3, F.concat(F.col("country_name"), F.lit(", Republic of"))).otherwise(F.col("country_name")).alias("country_name"),
        "iso3",
        F.when(F.col("__k") == 7, F.lit("NA")).when(F.col("__k") == 11, F.lit("")).otherwise(F.col("iso2")).alias("iso2"),
        "continent", "region", "income_group", "EU", "OECD", "ASEAN", "BRICS", "G20", "FCS",
    )
    path = sinks.land_csv(landed, scratch_path(spark, "seed_csv"))
    return readers.read_country_seed(spark, path)


# The API frame has one column per year of the extraction window.
WIDE_YEARS = [str(y) for y in range(*S.WINDOW)]
# Its two chunks overlap by two years, as chunked requests may.
CHUNK_YEARS = (WIDE_YEARS[: len(WIDE_YEARS) // 2 + 1], WIDE_YEARS[len(WIDE_YEARS) // 2 - 1 :])
# The year whose cells carry unreadable text in the landed JSON payloads.
BAD_YEAR = "2000"


def _wide_years_frame(p: PN.StandinPanel) -> DataFrame:
    """The WB-like API frame: (economy, Series, Country) + one column per year."""
    pts = p.points_a.withColumn("__y", F.col("year").cast("string"))
    years = WIDE_YEARS
    wide = reshape.pivot_indicators(
        pts, ["country_code", "indicator", "country_name"], years, indicator_col="__y"
    )
    return wide.select(
        F.col("country_code").alias("economy"),
        F.col("indicator").alias("Series"),
        F.col("country_name").alias("Country"),
        *years,
    )


def _chunks(p: PN.StandinPanel) -> list[DataFrame]:
    """The API frame as two requests of overlapping years; every cell is in one of them at least."""
    wide = _wide_years_frame(p)
    return [wide.select("economy", "Series", "Country", *years) for years in CHUNK_YEARS]


def read_wide_years(spark, sf_dir):
    """The wide year frame landed as two chunks of parquet with different years, read back with renames."""
    p = _panel(spark, sf_dir)
    path = scratch_path(spark, "wide_years")
    for i, chunk in enumerate(_chunks(p)):
        sinks.land_parquet(chunk, f"{path}/chunk{i}")
    return readers.read_wide_years(spark, path).select("country_code", "indicator", "Country", *WIDE_YEARS)


def read_point_records(spark, sf_dir):
    """S3: source B landed as JSON arrays of point records, read back."""
    p = _panel(spark, sf_dir)
    rec = p.points_b.select(
        F.col("country_code").alias("countryIsoCode"),
        F.col("country_name").alias("country"),
        F.col("year").cast("string").alias("year"),
        F.col("indicator").alias("indicatorCode"),
        F.col("value").cast("string").alias("value"),
    )
    # Each landed line is a JSON array of records; one record per array keeps
    # every document bounded (a whole-source array would be one unsplittable task).
    docs = rec.select(F.to_json(F.array(F.struct(*rec.columns))).alias("doc"))
    path = sinks.land_json_lines(docs, scratch_path(spark, "point_records"))
    out = readers.read_point_records(spark, path)
    return out.select(
        "countryIsoCode", "country", F.col("year").cast("int").alias("year"), "indicatorCode",
        F.col("value").cast("double").alias("value"),
    )


def _first_cells(points: DataFrame, keys: list[str]) -> DataFrame:
    """First non-null value per cell (min_by on the ingest order), long form."""
    return (
        points.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*keys)
        .agg(F.min_by("value", "ingest_seq").alias("value"))
    )


def _landed_text():
    return F.when(F.col("year").cast("string") == BAD_YEAR, F.lit("n/a")).otherwise(F.col("value").cast("string"))


def _parsed_value():
    return rules.coerce_value("value").alias("value"), rules.check_value_text("value").alias("error")


def read_nested_map(spark, sf_dir):
    """Source C1 landed as nested-map JSON documents (one per indicator and
    country, so a document holds at most one map entry per year), read back. One
    cell of a document ('n/a' in one year) is bad; the others are not lost."""
    p = _panel(spark, sf_dir)
    cells = _first_cells(p.points_c1, ["indicator", "country_code", "year"])
    per_country = cells.groupBy("indicator", "country_code").agg(
        F.map_from_entries(F.collect_list(F.struct("year", _landed_text().alias("value")))).alias("years")
    )
    docs = per_country.select(
        F.to_json(
            F.struct(F.create_map(F.col("indicator"), F.create_map(F.col("country_code"), F.col("years"))).alias("values"))
        ).alias("doc")
    )
    path = sinks.land_json_lines(docs, scratch_path(spark, "nested_map"))
    return readers.read_nested_map(spark, path).select("country_code", "indicator", "year", *_parsed_value())


def read_parallel_arrays(spark, sf_dir):
    """Source C2 landed as parallel period/value arrays per code, read back,
    with one bad value per array ('n/a' in one year)."""
    p = _panel(spark, sf_dir)
    cells = _first_cells(p.points_c2, ["country_code", "year"])
    per_code = cells.groupBy("country_code").agg(F.array_sort(F.collect_list(F.struct("year", _landed_text().alias("value")))).alias("pv"))
    doc = F.struct(
        F.struct(F.col("country_code").alias("REF_AREA")).alias("dimensions"),
        F.transform("pv", lambda x: x["year"].cast("string")).alias("period"),
        F.transform("pv", lambda x: x["value"]).alias("value"),
    )
    docs = per_code.select(F.to_json(F.struct(F.struct(F.array(doc).alias("docs")).alias("series"))).alias("doc"))
    path = sinks.land_json_lines(docs, scratch_path(spark, "parallel_arrays"))
    return readers.read_parallel_arrays(spark, path).select(
        "country_code", F.col("year").cast("int").alias("year"), *_parsed_value()
    )


def read_layer_table(spark, sf_dir):
    """The staged dimension published to a layer database and scanned by name."""
    p = _panel(spark, sf_dir)
    layer = _layer(spark, "atlaspanel_raw")
    sinks.replace_table(p.seed, layer, "country_metadata")
    return readers.read_layer_table(spark, layer, "country_metadata")


def head_sample(spark, sf_dir):
    """First five nations by key."""
    p = _panel(spark, sf_dir)
    return readers.head_sample(p.t.nation, ["n_nationkey", "n_name", "n_regionkey"], ["n_nationkey"], 5)


def _layer(spark, name: str) -> str:
    """A database of this run alone: sessions that share a metastore do not meet in it."""
    path = scratch_path(spark, f"db_{name}")
    return sinks.ensure_layer(spark, f"{name}_{path.rsplit('-', 1)[-1]}", path)


# ------------------------------------------------------------------ sinks ----


def replace_table(spark, sf_dir):
    """K1: write the seed twice over, then replace it by the seed; the table
    holds exactly the last write."""
    p = _panel(spark, sf_dir)
    layer = _layer(spark, "atlaspanel_raw")
    sinks.replace_table(p.seed.unionByName(p.seed), layer, "seed_replace")
    sinks.replace_table(p.seed, layer, "seed_replace")
    return readers.read_layer_table(spark, layer, "seed_replace")


def export_csv_backup(spark, sf_dir):
    """K3: staged source A exported as header CSV, read back with its schema."""
    p = _panel(spark, sf_dir)
    staged = p.staged_a
    path = sinks.export_csv_backup(staged, scratch_path(spark, sinks.backup_name("a", *S.WINDOW)))
    return (
        spark.read.schema(staged.schema).option("header", True).option("nullValue", "").csv(path)
    )


def publish_view(spark, sf_dir):
    """K4: staged source B published as a view and read through it."""
    p = _panel(spark, sf_dir)
    name = sinks.publish_view(p.staged_b, "stg_b_indicators")
    return spark.table(name)


def publish_table(spark, sf_dir):
    """K5: the fact materialised as a mart table (partitioned by year) and read back."""
    p = _panel(spark, sf_dir)
    layer = _layer(spark, "atlaspanel_marts")
    sinks.publish_table(p.fact, layer, "fact_indicators", partition_by=["year"])
    return readers.read_layer_table(spark, layer, "fact_indicators").select(*p.fact.columns)


def load_row_count(spark, sf_dir):
    """K6: row count of every loaded test table."""
    p = _panel(spark, sf_dir)
    parts = [sinks.load_row_count(getattr(p.t, t), t) for t in S.TABLES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---------------------------------------------------------------- reshape ----


def unpivot_years(spark, sf_dir):
    """The wide year frame back to long; NULL cells kept."""
    p = _panel(spark, sf_dir)
    wide = _wide_years_frame(p).withColumnsRenamed({"economy": "country_code", "Series": "indicator"})
    return reshape.unpivot_years(wide, ["country_code", "Country", "indicator"])


def pivot_indicators(spark, sf_dir):
    """R2: source A (labels mapped) pivoted to the raw wide table."""
    return _panel(spark, sf_dir).raw("a")


def concat_chunks(spark, sf_dir):
    """Two chunks of the wide year frame with different year columns."""
    return reshape.concat_chunks(_chunks(_panel(spark, sf_dir)))


def map_labels_to_codes(spark, sf_dir):
    """Source A labels replaced by dictionary codes."""
    p = _panel(spark, sf_dir)
    mapping = {i.label: i.code for i in S.STANDIN_A}
    return reshape.map_labels_to_codes(p.points_a, mapping, codes(S.STANDIN_A), keep_label_as="label").select(
        "country_code", "year", "label", "indicator", "value", "ingest_seq"
    )


def unmapped_indicators(spark, sf_dir):
    """Labels unknown to a dictionary that lacks one priority."""
    p = _panel(spark, sf_dir)
    partial = [i for i in S.STANDIN_A if i.label != "4-NOT SPECIFIED"]
    return reshape.unmapped_indicators(p.points_a, {i.label: i.code for i in partial}, codes(partial))


def conform_columns(spark, sf_dir):
    """Raw A conformed to a schema with an absent code (NULL) and a dropped one."""
    raw = _panel(spark, sf_dir).raw("a")
    return reshape.conform_columns(raw, ["country_code", "country_name", "year"], ["P5", "P1", "P3", "P9"])


# ------------------------------------------------------------- validation ----


def check_code_length(spark, sf_dir):
    """V1: code 'N' || c_custkey (lengths 2-6)."""
    c = _panel(spark, sf_dir).t.customer
    code = F.concat(F.lit("N"), F.col("c_custkey").cast("string"))
    return c.select("c_custkey", code.alias("code"), rules.check_code_length(code).alias("error"))


def check_year_range(spark, sf_dir):
    """V2: ship year within [1996, 2000]."""
    li = _panel(spark, sf_dir).t.lineitem
    y = F.year("l_shipdate")
    return li.select("l_orderkey", "l_linenumber", y.alias("year"), rules.check_year_range(y, 1996, 2000).alias("error"))


def _year_text(o: DataFrame):
    return F.when(F.col("o_orderkey") % 7 == 0, F.lit("20x1")).otherwise(F.year("o_orderdate").cast("string"))


def coerce_year_text(spark, sf_dir):
    """V3: order year as text, '20x1' when o_orderkey % 7 = 0."""
    o = _panel(spark, sf_dir).t.orders
    t = _year_text(o)
    return o.select(
        "o_orderkey", t.alias("year_text"), rules.coerce_year_text(t).alias("year"), rules.check_year_text(t).alias("error")
    )


def check_required(spark, sf_dir):
    """V4: market segment missing when c_custkey % 11 = 0."""
    c = _panel(spark, sf_dir).t.customer
    seg = F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment"))
    d = c.select("c_custkey", seg.alias("segment"), "c_name")
    return d.select("c_custkey", "segment", rules.check_required("c_name", "segment").alias("error"))


def _quantity_text():
    return (
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
        .when(F.col("l_linenumber") == 6, F.lit("NaN"))
        .otherwise(F.col("l_quantity").cast("string"))
    )


def coerce_value(spark, sf_dir):
    """V5: quantity as text, 'n/a' on line 7 (reject), 'NaN' on line 6 (NULL)."""
    li = _panel(spark, sf_dir).t.lineitem
    t = _quantity_text()
    return li.select(
        "l_orderkey", "l_linenumber", rules.coerce_value(t).alias("value"), rules.check_value_text(t).alias("error")
    )


def reject_aggregates(spark, sf_dir):
    """V6: part code '1C_<key>' when key % 10 = 0, 'XALLC<key>' when % 10 = 1."""
    pt = _panel(spark, sf_dir).t.part
    k = F.col("p_partkey")
    code = (
        F.when(k % 10 == 0, F.concat(F.lit("1C_"), k.cast("string")))
        .when(k % 10 == 1, F.concat(F.lit("XALLC"), k.cast("string")))
        .otherwise(F.concat(F.lit("P"), k.cast("string")))
    )
    return pt.select("p_partkey", code.alias("code"), rules.reject_aggregates(code).alias("error"))


def filter_year_window(spark, sf_dir):
    """V7: orders with 1996 <= year < 2000."""
    o = _panel(spark, sf_dir).t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    return rules.filter_year_window(o, 1996, 2000)


def drop_null_values(spark, sf_dir):
    """V8: events whose value is NULL when event_id % 5 = 0 are skipped."""
    e = _panel(spark, sf_dir).t.events
    v = e.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    return rules.drop_null_values(v)


def _faulty_points_a(p: PN.StandinPanel) -> DataFrame:
    """Source A with V1/V3/V5 faults injected together (keyed on o_orderkey)."""
    pts = p.points_a
    k = F.col("ingest_seq")
    return pts.select(
        F.when(k % 13 == 0, F.concat(F.col("country_code"), F.lit("X"))).otherwise(F.col("country_code")).alias("country_code"),
        "country_name",
        F.when(k % 7 == 0, F.lit("20x1")).otherwise(F.col("year").cast("string")).alias("year"),
        "indicator",
        F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        "ingest_seq",
    )


# Narrower than the bounds of a valid year (S.YEAR_LO to S.YEAR_HI): points outside are skipped, not rejected.
FAULTY_WINDOW = (1996, 2000)


def _faulty_config() -> P.SourceConfig:
    return P.SourceConfig(
        name="a", dictionary=S.STANDIN_A, year_lo=S.YEAR_LO, year_hi=S.YEAR_HI, year_is_text=True,
        required=("country_name", "indicator"), window=FAULTY_WINDOW,
    )


def _faulty_rejects(p: PN.StandinPanel) -> DataFrame:
    return P.validate_points(_faulty_points_a(p), _faulty_config())[1]


def split_valid_rejects(spark, sf_dir):
    """V9: every point of the faulted source inside the window, with its status and error codes (one pass)."""
    cfg = _faulty_config()
    inside = _faulty_points_a(_panel(spark, sf_dir)).filter(~P.outside_window(cfg))
    return rules.checked(inside, P.point_rules(cfg)).select("ingest_seq", "status", F.array_join("errors", ",").alias("errors"))


def reject_summary(spark, sf_dir):
    """Reject counts per (source, error) of the faulted source."""
    return rules.reject_summary(_faulty_rejects(_panel(spark, sf_dir)), source="a")


def reject_sample(spark, sf_dir):
    """The first five rejects of the faulted source in ingest order (the log sample)."""
    sample = rules.reject_sample(_faulty_rejects(_panel(spark, sf_dir)), ["ingest_seq"], 5)
    return sample.select("ingest_seq", F.array_join("errors", ",").alias("errors"))


def load_profile(spark, sf_dir):
    """Distinct indicators, countries and rows of source A."""
    return rules.load_profile(_panel(spark, sf_dir).points_a)


# ------------------------------------------------------- projection/filter ----


def conform_dimension(spark, sf_dir):
    """P1."""
    return _panel(spark, sf_dir).staged_dim


def dim_country(spark, sf_dir):
    """P2."""
    return _panel(spark, sf_dir).dim


def rename_indicators(spark, sf_dir):
    """Raw A renamed to mart names."""
    return conform.rename_indicators(_panel(spark, sf_dir).raw("a"), S.STANDIN_A)


def cast_year(spark, sf_dir):
    """Raw C1 (text year) with the year cast to INTEGER."""
    return conform.cast_year(_panel(spark, sf_dir).raw("c1"))


def not_null_filter(spark, sf_dir):
    """P5: panel rows with a_low present."""
    f = _panel(spark, sf_dir).fact
    return A.not_null_filter(f, "a_low").select("country_code", "year", "a_low")


def compare_filter(spark, sf_dir):
    """Member flag = 1, continent equality, year >= c on the star join."""
    p = _panel(spark, sf_dir)
    fact = p.fact_where(F.col("year") >= 1998).select("country_code", "year", "a_urgent")
    j = A.fact_inner_dim(fact, p.dim, ["continent", "is_eu"])
    j = A.compare_filter(A.compare_filter(A.compare_filter(j, "is_eu", "=", 1), "continent", "=", "ASIA"), "year", ">=", 1998)
    return j.select("country_code", "year", "a_urgent")


def scale_value(spark, sf_dir):
    """a_urgent / 1e6."""
    f = _panel(spark, sf_dir).fact
    return A.scale_column(f, "a_urgent", 1e6, "a_urgent_millions").select("country_code", "year", "a_urgent_millions")


def case_non_null(spark, sf_dir):
    """CASE WHEN a_low IS NOT NULL THEN year END."""
    f = _panel(spark, sf_dir).fact
    return f.select("country_code", "year", X.case_non_null("a_low", "year").alias("a_low_year"))


# ------------------------------------------------------------------- joins ----


def _restricted_seed(p: PN.StandinPanel) -> DataFrame:
    """The dimension with the keys of nations from NON_MEMBER_FROM on altered, so that their rows find no partner."""
    gone = F.substring("iso3", 2, 2).cast("int") >= NON_MEMBER_FROM
    return p.seed.withColumns({c: F.when(gone, F.concat(F.lit("X"), F.col(c))).otherwise(F.col(c)) for c in ("iso3", "iso2")})


def join_dim_iso3(spark, sf_dir):
    """Raw A inner join a dimension in which nations 20-24 have other codes."""
    p = _panel(spark, sf_dir)
    return conform.join_dim_iso3(p.raw("a"), _restricted_seed(p))


def join_dim_iso2(spark, sf_dir):
    """Raw C2 (two-character codes) inner join the same dimension on ISO2."""
    p = _panel(spark, sf_dir)
    return conform.join_dim_iso2(p.raw("c2"), _restricted_seed(p))


def merge_sources_on_spine(spark, sf_dir):
    """Staged A and B merged on their common key spine."""
    p = _panel(spark, sf_dir)
    keys = ["country_code", "year"]
    a, b = p.stored(p.staged_a, "a"), p.stored(p.staged_b, "b")  # used twice, computed once
    sp = spine.spine_distinct([a, b], keys)
    return spine.merge_sources_on_spine(sp, [a.drop("country_name"), b.drop("country_name")], keys)


def fact_panel(spark, sf_dir):
    """Spine LEFT JOIN dimension and the three sources."""
    p = _panel(spark, sf_dir)
    staged = [p.stored(getattr(p, f"staged_{x}"), x) for x in "abc"]  # used twice, computed once
    return spine.fact_panel(spine.spine_distinct(staged), p.dim, staged, PN.FACT_COLUMNS)


def dim_left_fact(spark, sf_dir):
    """Dimension LEFT JOIN fact (rows of countries without facts kept)."""
    p = _panel(spark, sf_dir)
    # N24's facts take another key, so that one country has none
    code = F.when(F.col("country_code") == "N24", F.lit("N99")).otherwise(F.col("country_code"))
    fact = p.stored(p.fact.select(code.alias("country_code"), "year", "a_urgent"), "fact")
    return marts.dim_left_fact(p.dim, fact, ["a_urgent"])


def fact_inner_dim(spark, sf_dir):
    """Fact JOIN dimension."""
    p = _panel(spark, sf_dir)
    return A.fact_inner_dim(p.fact.select("country_code", "year", "a_urgent"), p.dim, ["continent", "income_group"])


# ---------------------------------------------------------------- set ops ----


def union_all(spark, sf_dir):
    """Keys of the three staged sources, with duplicates."""
    p = _panel(spark, sf_dir)
    return spine.union_all([p.staged_a, p.staged_b, p.staged_c])


def spine_distinct(spark, sf_dir):
    """Distinct (country, year) keys of the three sources."""
    p = _panel(spark, sf_dir)
    return spine.spine_distinct([p.staged_a, p.staged_b, p.staged_c])


def union_distinct(spark, sf_dir):
    """UNION of the key/name triples of the two parts of source C."""
    p = _panel(spark, sf_dir)
    weo = conform.attach_dim_name(conform.cast_year(p.raw("c1")), p.seed)
    fdi = conform.join_dim_iso2(p.raw("c2"), p.seed)
    return spine.union_distinct(weo, fdi, ["country_code", "country_name", "year"])


def distinct_pairs(spark, sf_dir):
    """U4: distinct (country_code, country_name) of the fact."""
    return spine.distinct_pairs(_panel(spark, sf_dir).fact, ["country_code", "country_name"])


# ------------------------------------------------------------ aggregation ----


def peak_and_last_year(spark, sf_dir):
    """G1: literal mart semantics."""
    return _panel(spark, sf_dir).peak_and_last_year()


def latest_value(spark, sf_dir):
    """Value at the latest year with a value."""
    return _panel(spark, sf_dir).latest_value()


def sum_flags(spark, sf_dir):
    """Member counts of the six flags."""
    return A.sum_flags(_panel(spark, sf_dir).dim, ["is_eu", "is_oecd", "is_asean", "is_brics", "is_g20", "is_fcs"])


def group_avg(spark, sf_dir):
    """Averages per continent over the star join."""
    p = _panel(spark, sf_dir)
    j = A.fact_inner_dim(p.fact, p.dim, ["continent"])
    return _rounded(A.group_avg(j, ["continent"], {"avg_a_urgent": "a_urgent", "avg_b_a_f": "b_a_f"}), "avg_a_urgent", "avg_b_a_f")


def count_distinct(spark, sf_dir):
    """Distinct countries with a_low per continent."""
    p = _panel(spark, sf_dir)
    j = A.not_null_filter(A.fact_inner_dim(p.fact, p.dim, ["continent"]), "a_low")
    return A.count_distinct(j, ["continent"], "country_code", "country_count", dictionary=A.code_dictionary(p.dim, "country_code"))


def scalar_max_filter(spark, sf_dir):
    """Panel rows of the latest year."""
    p = _panel(spark, sf_dir)
    f = p.stored(p.fact.select("country_code", "year", "c_click"), "fact")
    return A.scalar_max_filter(f, "year")


def row_count(spark, sf_dir):
    """Rows of the fact."""
    return A.row_count(_panel(spark, sf_dir).fact)


def min_measure(spark, sf_dir):
    """Earliest fact year."""
    return A.min_measure(_panel(spark, sf_dir).fact, "year", "min_year")


# ---------------------------------------------------------- sort / top-k ----


def order_by(spark, sf_dir):
    """O1: the latest-value mart ordered by name (descending a_urgent within)."""
    m = _panel(spark, sf_dir).latest_value()
    return A.order_by(m.select("country_code", "country_name", "a_urgent", "a_urgent_year"), [("country_name", False), ("a_urgent", True)])


def top_n(spark, sf_dir):
    """O2: ten highest b_a_f cells of the panel (tie-break code, year)."""
    f = _panel(spark, sf_dir).fact
    return A.top_n(f.select("country_code", "year", "b_a_f"), "b_a_f", 10, ["country_code", "year"])


# ------------------------------------------------------- analyst queries ----


def top_economies(spark, sf_dir):
    """A1."""
    return A.top_economies(_panel(spark, sf_dir).fact_where(F.col("year") == TOP_YEAR), TOP_YEAR, GDP, GDP_PC, HDI)


def member_trend(spark, sf_dir):
    """A2."""
    p = _panel(spark, sf_dir)
    return A.member_trend(p.fact_where(F.col("year") >= MEMBER_SINCE), p.dim, MEMBER_FLAG, MEMBER_SINCE, HDI, GDP_PC)


def inequality_by_continent(spark, sf_dir):
    """A3."""
    p = _panel(spark, sf_dir)
    return _rounded(A.inequality_by_continent(p.fact, p.dim, GINI, INEQ), "avg_gini", "avg_inequality_coef")


def schooling_gdp_listing(spark, sf_dir):
    """A4."""
    return A.schooling_gdp_listing(_panel(spark, sf_dir).fact_where(F.col("year") == TOP_YEAR), TOP_YEAR, SCHOOLING, GDP_PC, HDI)


def measure_correlation(spark, sf_dir):
    """A5 (ours)."""
    return _rounded(A.measure_correlation(_panel(spark, sf_dir).fact, GDP, HDI), "correlation")


# ---------------------------------------------------------------- quality ----


def _report(df, checks, dataset, parents=None):
    return quality.quality_report(df, checks, dataset, layer="test", parents=parents)


def test_not_null(spark, sf_dir):
    """Q1: NULL counts of every orders column."""
    o = _panel(spark, sf_dir).t.orders
    return _report(o, [Check("not_null", (c,)) for c in o.columns], "orders")


def test_unique(spark, sf_dir):
    """Q2: duplicated user ids in events."""
    return _report(_panel(spark, sf_dir).t.events, [Check("unique", ("user_id",))], "events")


def test_accepted_values(spark, sf_dir):
    """Q3: priorities outside four accepted labels."""
    o = _panel(spark, sf_dir).t.orders
    return _report(o, [Check("accepted_values", ("o_orderpriority",), values=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"))], "orders")


def test_relationships(spark, sf_dir):
    """Q4: orders whose customer key is altered in customer (c_custkey % 5 = 0)."""
    p = _panel(spark, sf_dir)
    # a fifth of the parent's keys is altered so that orphans exist (the test tables have none)
    key = F.when(F.col("c_custkey") % 5 == 0, -F.col("c_custkey") - 1).otherwise(F.col("c_custkey"))
    parent = p.t.customer.select(key.alias("c_custkey"))
    chk = Check("relationships", ("o_custkey",), parent="customer", parent_column="c_custkey")
    return _report(p.t.orders, [chk], "orders", parents={"customer": parent})


def test_unique_combination(spark, sf_dir):
    """Q5: duplicated (l_orderkey, l_linenumber)."""
    return _report(_panel(spark, sf_dir).t.lineitem, [Check("unique_combination", ("l_orderkey", "l_linenumber"))], "lineitem")


def check_row_count(spark, sf_dir):
    """Q6: row_count > 0 on every test table."""
    p = _panel(spark, sf_dir)
    parts = [_report(getattr(p.t, t), [Check("row_count", grade=POSITIVE)], t) for t in S.TABLES]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def check_missing_count(spark, sf_dir):
    """Q7: missing counts of events columns (value nulled when event_id % 5 = 0)."""
    e = _panel(spark, sf_dir).t.events
    e = e.withColumn("value", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    return _report(e, [Check("missing_count", (c,)) for c in ("event_id", "ts", "user_id", "event_type", "value")], "events")


def check_duplicate_count(spark, sf_dir):
    """Q8: single and composite duplicate counts."""
    li = _panel(spark, sf_dir).t.lineitem
    return _report(
        li,
        [Check("duplicate_count", ("l_orderkey",)), Check("duplicate_count", ("l_orderkey", "l_linenumber"))],
        "lineitem",
    )


def check_invalid_range(spark, sf_dir):
    """Q9: account balance >= 0 and quantity within [1, 50], graded warn/fail."""
    p = _panel(spark, sf_dir)
    c = _report(p.t.customer, [Check("invalid_range", ("c_acctbal",), lo=0, grade=THRESHOLD)], "customer")
    li = _report(p.t.lineitem, [Check("invalid_range", ("l_quantity",), lo=1, hi=49, grade=THRESHOLD)], "lineitem")
    return c.unionByName(li)


def check_invalid_values(spark, sf_dir):
    """Q10: order status outside ('F', 'O')."""
    o = _panel(spark, sf_dir).t.orders
    return _report(o, [Check("invalid_values", ("o_orderstatus",), values=("F", "O"))], "orders")


def check_min(spark, sf_dir):
    """Q11: min(order year) >= 2000."""
    o = _panel(spark, sf_dir).t.orders.select(F.year("o_orderdate").alias("year"))
    return _report(o, [Check("min", ("year",), bound=2000, grade=AT_LEAST)], "orders")


def check_required_columns(spark, sf_dir):
    """Q12: required columns present (one is absent)."""
    o = _panel(spark, sf_dir).t.orders
    return _report(o, [Check("required_columns", ("o_orderkey", "o_custkey", "o_comment"))], "orders")


def grade_outcome(spark, sf_dir):
    """Q13: the graded outcome of the account-balance range check."""
    c = _panel(spark, sf_dir).t.customer
    r = _report(c, [Check("invalid_range", ("c_acctbal",), lo=0, grade=THRESHOLD)], "customer")
    return r.select("check", "column", "measured", "outcome")


def quality_report(spark, sf_dir):
    """Q14: all check kinds over orders and customer in one report."""
    p = _panel(spark, sf_dir)
    o, c = p.t.orders, p.t.customer
    orders_checks = [
        Check("row_count", grade=POSITIVE),
        *[Check("missing_count", (x,)) for x in ("o_orderkey", "o_custkey", "o_orderdate")],
        Check("duplicate_count", ("o_orderkey",)),
        Check("invalid_values", ("o_orderstatus",), values=("F", "O", "P")),
        Check("invalid_range", ("o_totalprice",), lo=1000, hi=500000, grade=THRESHOLD),
        Check("relationships", ("o_custkey",), parent="customer", parent_column="c_custkey"),
        Check("required_columns", ("o_orderkey", "o_custkey", "o_orderstatus")),
    ]
    cust_checks = [
        Check("row_count", grade=POSITIVE),
        Check("unique", ("c_custkey",)),
        Check("not_null", ("c_name",)),
        Check("accepted_values", ("c_mktsegment",), values=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
        Check("invalid_range", ("c_acctbal",), lo=0, grade=THRESHOLD),
    ]
    return _report(o, orders_checks, "orders", parents={"customer": c}).unionByName(_report(c, cust_checks, "customer"))


# --------------------------------------------------------------- pipeline ----


def stage_source_a(spark, sf_dir):
    """L1: source A staged."""
    return _panel(spark, sf_dir).staged_a


def stage_source_b(spark, sf_dir):
    """L1: source B staged."""
    return _panel(spark, sf_dir).staged_b


def stage_source_c(spark, sf_dir):
    """L1: source C (two parts on their own spine) staged."""
    return _panel(spark, sf_dir).staged_c


def build_panel(spark, sf_dir):
    """L2: the fact (flagship)."""
    return _panel(spark, sf_dir).fact


QUERIES = {
    name: globals()[name]
    for name in [
        "read_country_seed", "read_wide_years", "read_point_records", "read_nested_map",
        "read_parallel_arrays", "read_layer_table", "head_sample",
        "replace_table", "export_csv_backup", "publish_view", "publish_table", "load_row_count",
        "unpivot_years", "pivot_indicators", "concat_chunks", "map_labels_to_codes",
        "unmapped_indicators", "conform_columns",
        "check_code_length", "check_year_range", "coerce_year_text", "check_required", "coerce_value",
        "reject_aggregates", "filter_year_window", "drop_null_values", "split_valid_rejects",
        "reject_summary", "reject_sample", "load_profile",
        "conform_dimension", "dim_country", "rename_indicators", "cast_year", "not_null_filter",
        "compare_filter", "scale_value", "case_non_null",
        "join_dim_iso3", "join_dim_iso2", "merge_sources_on_spine", "fact_panel", "dim_left_fact",
        "fact_inner_dim",
        "union_all", "spine_distinct", "union_distinct", "distinct_pairs",
        "peak_and_last_year", "latest_value", "sum_flags", "group_avg", "count_distinct",
        "scalar_max_filter", "row_count", "min_measure",
        "order_by", "top_n",
        "top_economies", "member_trend", "inequality_by_continent", "schooling_gdp_listing",
        "measure_correlation",
        "test_not_null", "test_unique", "test_accepted_values", "test_relationships",
        "test_unique_combination", "check_row_count", "check_missing_count", "check_duplicate_count",
        "check_invalid_range", "check_invalid_values", "check_min", "check_required_columns",
        "grade_outcome", "quality_report",
        "stage_source_a", "stage_source_b", "stage_source_c", "build_panel",
    ]
}
