"""Stand-in adapters: the driver's test tables -> the engine's source shapes.

The test tables hold no country data, so each reference source is played by a
join of test tables (SURVEY §7.2). The adapters only *shape* data; all the
engine's work (validation, pivot, conform, spine, marts, checks) runs on their
output exactly as it would on landed payloads.

Scale notes: ``nation``/``region`` are fixed-size TPC-H tables and are
broadcast behind a row-count check; ``customer``/``supplier`` grow with the
scale factor and are joined by shuffle (AQE may still pick broadcast at run
time from real sizes, and splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.dictionary import Indicator, ind
from atlaspanel.functions.exprs import iso2_of, iso3_of
from atlaspanel.operators.joins import bounded_broadcast

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Stand-in dictionary: source A (orders by priority, labels mapped to codes),
# B (lineitem quantity by return flag/line status), C1 (events by type, year as
# text), C2 (signup value keyed by the two-character code).
STANDIN_A = (
    ind("a", "a_urgent", "P1", "1-URGENT", 0, None),
    ind("a", "a_high", "P2", "2-HIGH", 0, None),
    ind("a", "a_medium", "P3", "3-MEDIUM", 0, None),
    ind("a", "a_not_specified", "P4", "4-NOT SPECIFIED", 0, None),
    ind("a", "a_low", "P5", "5-LOW", 0, None),
)
STANDIN_B = (
    ind("b", "b_a_f", "A_F", None, 0, 50),
    ind("b", "b_a_o", "A_O", None, 0, 50),
    ind("b", "b_n_f", "N_F", None, 0, 50),
    ind("b", "b_n_o", "N_O", None, 0, 50),
    ind("b", "b_r_f", "R_F", None, 0, 50),
    ind("b", "b_r_o", "R_O", None, 0, 50),
)
STANDIN_C1 = (
    ind("c1", "c_click", "click", None, 0, None),
    ind("c1", "c_error", "error", None, 0, None),
    ind("c1", "c_purchase", "purchase", None, 0, None),
    ind("c1", "c_signup", "signup", None, 0, None),
    ind("c1", "c_view", "view", None, 0, None),
)
STANDIN_C2 = (ind("c2", "c_signup_index", "FDX", None, 0, 100),)
STANDIN_DICTIONARY: tuple[Indicator, ...] = STANDIN_A + STANDIN_B + STANDIN_C1 + STANDIN_C2

# Stand-in validation parameters (the test years are 1995-2001 and 2024).
YEAR_LO = 1990
YEAR_HI = 2025  # inclusive "current year" bound, a parameter rather than the clock
WINDOW = (1990, 2026)  # half-open extraction window

INCOME_LABELS = ("Low income", "Lower middle income", "Upper middle income", "High income")


class Tables:
    """The test tables as lazy parquet scans, opened on first use.

    Catalyst prunes columns and pushes filters into each scan per query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._frames[name]


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _nations(t: Tables) -> DataFrame:
    return bounded_broadcast(t.nation.select("n_nationkey", "n_name"), bounded_by=t.nation)


def country_seed(t: Tables) -> DataFrame:
    """``country_metadata`` stand-in: nation JOIN region, 12 seed columns.

    iso3 = 'N' + two-digit key, iso2 = two-digit key, continent = region =
    r_name, four income labels by key % 4, flag k (k = 2..7) = key % k == 0.
    """
    n, r = t.nation, bounded_broadcast(t.region)
    k = F.col("n_nationkey")
    income = F.element_at(F.array(*[F.lit(x) for x in INCOME_LABELS]), (k % 4 + 1).cast("int"))
    flags = [((k % m) == 0).cast("int").alias(name) for m, name in zip(range(2, 8), ("EU", "OECD", "ASEAN", "BRICS", "G20", "FCS"))]
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_name").alias("country_name"),
        iso3_of(k).alias("iso3"),
        iso2_of(k).alias("iso2"),
        F.col("r_name").alias("continent"),
        F.col("r_name").alias("region"),
        income.alias("income_group"),
        *flags,
    )


def points_a(t: Tables) -> DataFrame:
    """Source A (WB-like) long points with descriptive labels.

    Injected gaps: value NULL when nationkey % 7 = 3 in even years (whole
    country-years vanish after the pivot), and for '5-LOW' in 2001 (the latest
    non-null year then differs from the latest year).
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    y = F.year("o_orderdate")
    gap = ((F.col("c_nationkey") % 7 == 3) & (y % 2 == 0)) | ((F.col("o_orderpriority") == "5-LOW") & (y == 2001))
    return (
        o.join(c, o.o_custkey == c.c_custkey, "inner")
        .join(_nations(t), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select(
            iso3_of("c_nationkey").alias("country_code"),
            F.col("n_name").alias("country_name"),
            y.alias("year"),
            F.col("o_orderpriority").alias("indicator"),
            F.when(~gap, F.col("o_totalprice")).alias("value"),
            F.col("o_orderkey").alias("ingest_seq"),
        )
    )


def points_b(t: Tables) -> DataFrame:
    """Source B (HDR-like) long points.

    The ingest order is (l_orderkey, l_linenumber, l_quantity) packed into one
    long: line numbers are 1..7 and quantities integers 1..50 (TPC-H), so
    ``(l_orderkey * 8 + l_linenumber) * 64 + l_quantity`` is order-preserving; a
    row outside these ranges fails the query instead of getting a wrong place.
    (l_orderkey, l_linenumber) repeats in the test data; with the quantity in
    the key, remaining ties carry identical values, so the pivot stays
    deterministic without a tie-breaking aggregate."""
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    s = t.supplier.select("s_suppkey", "s_nationkey")
    whole = F.col("l_quantity").cast("long")
    packs = F.col("l_linenumber").between(0, 7) & whole.between(0, 63) & (whole == F.col("l_quantity"))
    place = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 64 + whole
    return (
        li.join(s, li.l_suppkey == s.s_suppkey, "inner")
        .join(_nations(t), F.col("s_nationkey") == F.col("n_nationkey"), "inner")
        .select(
            iso3_of("s_nationkey").alias("country_code"),
            F.col("n_name").alias("country_name"),
            F.year("l_shipdate").alias("year"),
            F.concat_ws("_", "l_returnflag", "l_linestatus").alias("indicator"),
            F.col("l_quantity").alias("value"),
            F.when(packs, place).otherwise(F.raise_error(F.lit("line number or quantity outside the packed order key")).cast("long")).alias("ingest_seq"),
        )
    )


def _events_by_nation(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    c = t.customer.select("c_custkey", "c_nationkey")
    return e.join(c, e.user_id == c.c_custkey, "inner")


def points_c1(t: Tables) -> DataFrame:
    """Source C1 (WEO-like) long points; the year arrives as text."""
    return _events_by_nation(t).select(
        iso3_of("c_nationkey").alias("country_code"),
        F.year("ts").cast("string").alias("year"),
        F.col("event_type").alias("indicator"),
        F.col("value"),
        F.col("event_id").alias("ingest_seq"),
    )


def points_c2(t: Tables) -> DataFrame:
    """Source C2 (FDI-like) points keyed by the two-character code."""
    return (
        _events_by_nation(t)
        .filter(F.col("event_type") == "signup")
        .select(
            iso2_of("c_nationkey").alias("country_code"),
            F.year("ts").alias("year"),
            F.lit("FDX").alias("indicator"),
            F.col("value"),
            F.col("event_id").alias("ingest_seq"),
        )
    )
