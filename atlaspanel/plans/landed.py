"""The reference's four sources, from landed payload files to canonical points.

Each reader output becomes the canonical long point
``(country_code, country_name, year, indicator, value, ingest_seq)``; the
ingest order is the payload's row order (``readers.payload_order``: file rank,
then the row's position in its file, exact however files are split across
tasks), which is what "first value" means for a pivot over a payload.

``landed_refresh_inputs`` wires them with the 56-indicator dictionary into
``refresh_all``: WB and HDR are staged with their own names, WEO + FDI as the
two-part IMF source (FDI keyed by ISO2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel import dictionary as D
from atlaspanel.operators import reshape
from atlaspanel.plans.pipeline import SourceConfig
from atlaspanel.plans.refresh import RefreshInputs
from atlaspanel.plans.suites import RAW_TABLES, SuiteParams
from atlaspanel.sources import readers


def source_configs(start_year: int, end_year: int, current_year: int) -> dict[str, SourceConfig]:
    """Validation/pivot rules of the four sources (T2, T7, T13); ``end_year`` is exclusive."""
    window = (start_year, end_year)
    return {
        "wb": SourceConfig(
            "wb", D.for_source("wb"), year_lo=D.MIN_YEAR["wb"], year_hi=current_year, window=window,
            required=("country_name", "indicator"), map_labels=True, raw_names=(("country_name", "Country"),),
        ),
        "hdr": SourceConfig(
            "hdr", D.for_source("hdr"), year_lo=D.MIN_YEAR["hdr"], year_hi=current_year, window=window,
            year_is_text=True, raw_year_text=False, required=("country_name", "indicator"),
            raw_names=(("country_code", "countryIsoCode"), ("country_name", "country")),
        ),
        "weo": SourceConfig(
            "weo", D.for_source("weo"), keys=("country_code", "year"), year_lo=D.MIN_YEAR["weo"],
            year_hi=current_year, window=window, year_is_text=True, raw_year_text=True,
        ),
        "fdi": SourceConfig(
            "fdi", D.for_source("fdi"), keys=("country_code", "year"), year_lo=D.MIN_YEAR["fdi"],
            year_hi=current_year, window=window, year_is_text=True, raw_year_text=False,
            check_aggregates=True, order_unique=False,  # pairs of one document share its order
        ),
    }


def wb_points(wide: DataFrame) -> DataFrame:
    """WB wide year frame (already ordered and renamed) -> points; NULL cells kept for validation."""
    long = reshape.unpivot_years(wide, ["country_code", "Country", "indicator", "ingest_seq"])
    return long.select(
        "country_code", F.col("Country").alias("country_name"), "year", "indicator", "value", "ingest_seq"
    )


def hdr_points(records: DataFrame) -> DataFrame:
    """HDR point records -> points (year and value still text until validated)."""
    return records.select(
        F.col("countryIsoCode").alias("country_code"),
        F.col("country").alias("country_name"),
        F.col("year"),
        F.col("indicatorCode").alias("indicator"),
        F.col("value"),
        "ingest_seq",
    )


def weo_points(nested: DataFrame) -> DataFrame:
    """WEO nested-map rows -> points."""
    return nested.select("country_code", "year", "indicator", "value", "ingest_seq")


def fdi_points(pairs: DataFrame) -> DataFrame:
    """FDI (code, period, value) pairs -> points; points without a value are skipped (V8).
    An unreadable document is a point whose value is its text, and is rejected."""
    return pairs.filter(F.col("value").isNotNull()).select(
        "country_code", "year", F.lit("FD_FD_IX").alias("indicator"), "value", "ingest_seq"
    )


def landed_refresh_inputs(
    spark: SparkSession,
    seed_csv: str,
    wb_wide: str,
    hdr_json: str,
    weo_json: str,
    fdi_json: str,
    start_year: int,
    end_year: int,
    current_year: int,
    wb_format: str = "parquet",
    multi_line_json: bool = False,
) -> RefreshInputs:
    """``multi_line_json``: for payloads landed as one JSON document, over one or
    several lines: their records are found from byte ranges in parallel;
    line-delimited documents split as they are. The FDI source may be empty; the
    refresh then goes on with WEO alone."""
    cfg = source_configs(start_year, end_year, current_year)
    seed = readers.read_country_seed(spark, seed_csv)
    wb = readers.read_wide_years(spark, wb_wide, fmt=wb_format, ordered=True)
    hdr = readers.read_point_records(spark, hdr_json, ordered=True, by_ranges=multi_line_json)
    points = {
        "wb": wb_points(wb),
        "hdr": hdr_points(hdr),
        "weo": weo_points(readers.read_nested_map(spark, weo_json, ordered=True, by_ranges=multi_line_json)),
        "fdi": fdi_points(readers.read_parallel_arrays(spark, fdi_json, ordered=True, by_ranges=multi_line_json)),
    }
    return RefreshInputs(
        seed=seed,
        sources={RAW_TABLES[k]: (points[k], cfg[k]) for k in ("wb", "hdr", "weo", "fdi")},
        named=(RAW_TABLES["wb"], RAW_TABLES["hdr"]),
        two_part=(RAW_TABLES["weo"], RAW_TABLES["fdi"]),
        dictionary=D.INDICATORS,
        params=SuiteParams(),
        optional=(RAW_TABLES["fdi"],),
    )
