"""The analyst questions (A1-A5) on the published marts, with the real
indicator columns bound. Run after ``refresh_all``; each returns a lazy
DataFrame over ``<layer>.fact_macro_indicators`` / ``<layer>.dim_country``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atlaspanel.operators import analytics as A
from atlaspanel.plans.suites import DIM_TABLE, FACT_TABLE
from atlaspanel.sources import readers

GDP = "wb_gdp_constant_2015_usd"
GDP_PER_CAPITA = "wb_gdp_per_capita_ppp"
HDI = "hdr_human_development_index"
GINI = "wb_gini_index"
INEQUALITY = "hdr_inequality_coefficient"
SCHOOLING = "hdr_mean_years_schooling"


def _fact(spark: SparkSession, layer: str) -> DataFrame:
    return readers.read_layer_table(spark, layer, FACT_TABLE)


def _dim(spark: SparkSession, layer: str) -> DataFrame:
    return readers.read_layer_table(spark, layer, DIM_TABLE)


def top_economies(spark: SparkSession, year: int, layer: str = "marts", n: int = 10) -> DataFrame:
    """A1: top ``n`` by constant-price GDP in ``year``, in trillions."""
    return A.top_economies(_fact(spark, layer), year, GDP, GDP_PER_CAPITA, HDI, n=n)


def member_trend(spark: SparkSession, since: int, flag: str = "is_brics", layer: str = "marts") -> DataFrame:
    """A2: HDI trend of a member group (a 0/1 flag of the dimension) since ``since``."""
    return A.member_trend(_fact(spark, layer), _dim(spark, layer), flag, since, HDI, GDP_PER_CAPITA)


def inequality_by_continent(spark: SparkSession, layer: str = "marts") -> DataFrame:
    """A3: average Gini and inequality coefficient per continent in the latest year."""
    return A.inequality_by_continent(_fact(spark, layer), _dim(spark, layer), GINI, INEQUALITY)


def schooling_gdp_listing(spark: SparkSession, year: int, layer: str = "marts", n: int = 20) -> DataFrame:
    """A4: top ``n`` by mean years of schooling among rows with GDP per capita."""
    return A.schooling_gdp_listing(_fact(spark, layer), year, SCHOOLING, GDP_PER_CAPITA, HDI, n=n)


def measure_correlation(spark: SparkSession, layer: str = "marts") -> DataFrame:
    """A5 (ours): correlation of schooling and GDP per capita over all panel rows."""
    return A.measure_correlation(_fact(spark, layer), SCHOOLING, GDP_PER_CAPITA)
