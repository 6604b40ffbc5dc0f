"""The stand-in panel: the full pipeline wired over the driver's test tables.

``StandinPanel(spark, sf_dir)`` exposes every layer as a lazy DataFrame
(seed -> valid/rejects -> raw -> staging -> fact -> marts); the registered
queries and the benchmark pick the layer they need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from atlaspanel import dictionary as D
from atlaspanel.operators import conform, marts
from atlaspanel.plans import pipeline as P
from atlaspanel.plans import standins as S
from atlaspanel.plans.refresh import RefreshInputs
from atlaspanel.plans.suites import SuiteParams
from atlaspanel.session import configure, scratch_path

A_CFG = P.SourceConfig(
    name="a",
    dictionary=S.STANDIN_A,
    year_lo=S.YEAR_LO,
    year_hi=S.YEAR_HI,
    window=S.WINDOW,
    required=("country_name", "indicator"),
    map_labels=True,
)
B_CFG = P.SourceConfig(
    name="b",
    dictionary=S.STANDIN_B,
    year_lo=S.YEAR_LO,
    year_hi=S.YEAR_HI,
    window=S.WINDOW,
    required=("country_name", "indicator"),
)
C1_CFG = P.SourceConfig(
    name="c1",
    dictionary=S.STANDIN_C1,
    keys=("country_code", "year"),
    year_lo=S.YEAR_LO,
    year_hi=S.YEAR_HI,
    window=S.WINDOW,
    year_is_text=True,
)
C2_CFG = P.SourceConfig(
    name="c2",
    dictionary=S.STANDIN_C2,
    keys=("country_code", "year"),
    year_lo=S.YEAR_LO,
    year_hi=S.YEAR_HI,
    window=S.WINDOW,
    check_aggregates=True,
)

FACT_COLUMNS = D.marts(S.STANDIN_DICTIONARY)

# Check-suite parameters of the stand-in data: its own source names, year floor
# and dimension domain (region names play the continents).
STANDIN_SUITE = SuiteParams(
    sources=("a", "b", "c1", "c2"),
    source_ids=(),
    year_checked_sources=("a", "b"),
    raw_min_year=S.YEAR_LO,
    fact_min_year=S.YEAR_LO,
    continents=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    staged=("a", "b", "imf"),
    staged_with_name=("a", "b"),
)


class StandinPanel:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.t = S.load_tables(spark, sf_dir)

    # dimension
    @cached_property
    def seed(self) -> DataFrame:
        return S.country_seed(self.t)

    @cached_property
    def staged_dim(self) -> DataFrame:
        return conform.conform_dimension(self.seed)

    @cached_property
    def dim(self) -> DataFrame:
        return conform.dim_country(self.staged_dim)

    # long points
    @cached_property
    def points_a(self) -> DataFrame:
        return S.points_a(self.t)

    @cached_property
    def points_b(self) -> DataFrame:
        return S.points_b(self.t)

    @cached_property
    def points_c1(self) -> DataFrame:
        return S.points_c1(self.t)

    @cached_property
    def points_c2(self) -> DataFrame:
        return S.points_c2(self.t)

    # validation
    def validated(self, which: str):
        cfg, pts = self._source(which)
        return P.validate_points(pts, cfg)

    def _source(self, which: str):
        cfg = {"a": A_CFG, "b": B_CFG, "c1": C1_CFG, "c2": C2_CFG}[which]
        return cfg, getattr(self, f"points_{which}")

    # raw wide tables
    def raw(self, which: str) -> DataFrame:
        cfg, _ = self._source(which)
        valid, _rejects = self.validated(which)
        return P.raw_table(valid, cfg)

    # staging
    @cached_property
    def staged_a(self) -> DataFrame:
        return P.stage_named_source(self.raw("a"), self.seed, A_CFG)

    @cached_property
    def staged_b(self) -> DataFrame:
        return P.stage_named_source(self.raw("b"), self.seed, B_CFG)

    @cached_property
    def staged_c(self) -> DataFrame:
        return P.stage_two_part_source(self.raw("c1"), self.raw("c2"), self.seed, C1_CFG, C2_CFG)

    # marts
    @cached_property
    def fact(self) -> DataFrame:
        return P.build_panel([self.staged_a, self.staged_b, self.staged_c], self.dim, FACT_COLUMNS)

    def fact_where(self, where) -> DataFrame:
        """The fact's rows for a condition on ``country_code`` and ``year``, which reaches every source's scan."""
        parts = P.stage_two_part_source(self.raw("c1"), self.raw("c2"), self.seed, C1_CFG, C2_CFG, where=where)
        return P.build_panel([self.staged_a, self.staged_b, parts], self.dim, FACT_COLUMNS, where=where)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared scratch folder and read back: a plan that uses it twice computes it once."""
        path = scratch_path(self.spark, f"panel-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def peak_and_last_year(self, fact: DataFrame | None = None) -> DataFrame:
        return marts.peak_and_last_year(self.dim, fact if fact is not None else self.fact, FACT_COLUMNS)

    def latest_value(self, fact: DataFrame | None = None) -> DataFrame:
        return marts.latest_value(self.dim, fact if fact is not None else self.fact, FACT_COLUMNS)

    def refresh_inputs(self) -> RefreshInputs:
        return RefreshInputs(
            seed=self.seed,
            sources={
                "a": (self.points_a, A_CFG),
                "b": (self.points_b, B_CFG),
                "c1": (self.points_c1, C1_CFG),
                "c2": (self.points_c2, C2_CFG),
            },
            named=("a", "b"),
            two_part=("c1", "c2"),
            dictionary=S.STANDIN_DICTIONARY,
            params=STANDIN_SUITE,
            two_part_name="imf",
        )
