"""Check suites as data: the scan checks and model tests of every layer.

Generated from the indicator dictionary, so the same code yields the
reference's suites (72 scan checks, 56 model tests on the 56-indicator
dictionary) and the analogous suites of the test-table stand-ins.
"""

from __future__ import annotations

from dataclasses import dataclass

from atlaspanel import dictionary as D
from atlaspanel.operators.quality import AT_LEAST, POSITIVE, THRESHOLD, Check


# Published table names (the names analysts query), and below the
# checked columns, bounds and lists of every layer.
FACT_TABLE = "fact_macro_indicators"
MART_TABLE = "mart_country_indicators_wide"
DIM_TABLE = "dim_country"
SEED_TABLE = "country_metadata"

# Raw table of each dictionary source.
RAW_TABLES = {
    "wb": "wb_indicators",
    "hdr": "hdr_indicators",
    "weo": "imf_weo_indicators",
    "fdi": "imf_fdi_indicator",
}


@dataclass(frozen=True)
class SuiteParams:
    sources: tuple = tuple(RAW_TABLES.values())  # raw tables, one per source
    source_ids: tuple = tuple((v, k) for k, v in RAW_TABLES.items())  # raw table -> dictionary source
    year_checked_sources: tuple = (RAW_TABLES["wb"], RAW_TABLES["hdr"])  # raw invalid_count(year) with valid min
    raw_min_year: int = D.WINDOW_START_YEAR
    fact_min_year: int = D.FACT_MIN_YEAR
    continents: tuple = D.CONTINENTS
    income_groups: tuple = D.INCOME_GROUPS
    staged: tuple = ("wb_indicators", "hdr_indicators", "imf_indicators")  # staging views (named stg_<x>)
    staged_with_name: tuple = ("wb_indicators", "hdr_indicators")  # staging views whose country_name is tested

    def source_id(self, raw_table: str) -> str:
        return dict(self.source_ids).get(raw_table, raw_table)


def raw_scan_checks(dictionary, p: SuiteParams) -> dict[str, list[Check]]:
    """Raw-layer scans: row count, missing keys, year floor, value ranges (graded)."""
    out = {
        SEED_TABLE: [Check("row_count", grade=POSITIVE)]
        + [Check("missing_count", (c,)) for c in ("iso3", "country_name", "continent", "region", "income_group")]
    }
    for src in p.sources:
        checks = [Check("row_count", grade=POSITIVE), Check("missing_count", ("country_code",)), Check("missing_count", ("year",))]
        if src in p.year_checked_sources:
            checks.append(Check("invalid_range", ("year",), lo=p.raw_min_year, grade=THRESHOLD))
        for i in D.for_source(p.source_id(src), dictionary):
            if i.lo is not None or i.hi is not None:
                checks.append(Check("invalid_range", (i.code,), lo=i.lo, hi=i.hi, grade=THRESHOLD))
        out[src] = checks
    return out


def source_tests(p: SuiteParams) -> dict[str, list[Check]]:
    """Model tests on the raw tables."""
    out = {SEED_TABLE: [Check("unique", ("iso3",)), Check("not_null", ("iso3",)), Check("not_null", ("country_name",))]}
    for src in p.sources:
        out[src] = [
            Check("not_null", ("country_code",)),
            Check("not_null", ("year",)),
            Check("unique_combination", ("country_code", "year")),
        ]
    return out


def staging_tests(p: SuiteParams) -> dict[str, list[Check]]:
    """Model tests on the staging views."""
    dim = [
        Check("not_null", ("country_name",)),
        Check("unique", ("country_code",)),
        Check("not_null", ("country_code",)),
        Check("unique", ("iso2",)),
        Check("not_null", ("iso2",)),
        Check("not_null", ("continent",)),
        Check("not_null", ("region",)),
        Check("not_null", ("income_group",)),
    ] + [Check("accepted_values", (f,), values=D.FLAG_VALUES) for f in D.FLAG_RENAMES.values()]
    out = {"stg_country_metadata": dim}
    for s in p.staged:
        checks = [
            Check("not_null", ("country_code",)),
            Check("relationships", ("country_code",), parent="stg_country_metadata", parent_column="country_code"),
        ]
        if s in p.staged_with_name:
            checks.append(Check("not_null", ("country_name",)))
        checks += [Check("not_null", ("year",)), Check("unique_combination", ("country_code", "year"))]
        out[f"stg_{s}"] = checks
    return out


def mart_tests(p: SuiteParams) -> dict[str, list[Check]]:
    """Model tests on the marts."""
    return {
        DIM_TABLE: [
            Check("unique", ("country_code",)),
            Check("not_null", ("country_code",)),
            Check("not_null", ("country_name",)),
            Check("not_null", ("continent",)),
            Check("accepted_values", ("continent",), values=p.continents),
            Check("accepted_values", ("income_group",), values=p.income_groups),
        ],
        FACT_TABLE: [
            Check("not_null", ("country_code",)),
            Check("relationships", ("country_code",), parent=DIM_TABLE, parent_column="country_code"),
            Check("not_null", ("year",)),
            Check("unique_combination", ("country_code", "year")),
        ],
        MART_TABLE: [
            Check("unique", ("country_code",)),
            Check("not_null", ("country_code",)),
            Check("not_null", ("country_name",)),
        ],
    }


def mart_scan_checks(p: SuiteParams) -> dict[str, list[Check]]:
    """Mart-layer scans."""
    return {
        DIM_TABLE: [
            Check("row_count", grade=POSITIVE),
            Check("duplicate_count", ("country_code",)),
            *[Check("missing_count", (c,)) for c in ("country_code", "country_name", "continent")],
            Check("invalid_values", ("continent",), values=p.continents),
            Check("invalid_values", ("income_group",), values=p.income_groups),
            Check("required_columns", ("country_code", "country_name", "continent", "region", "income_group")),
        ],
        FACT_TABLE: [
            Check("row_count", grade=POSITIVE),
            *[Check("missing_count", (c,)) for c in ("country_code", "country_name", "year")],
            Check("min", ("year",), bound=p.fact_min_year, grade=AT_LEAST),
            Check("duplicate_count", ("country_code", "year")),
            Check("required_columns", ("country_code", "country_name", "year")),
        ],
        MART_TABLE: [
            Check("row_count", grade=POSITIVE),
            Check("duplicate_count", ("country_code",)),
            *[Check("missing_count", (c,)) for c in ("country_code", "country_name")],
            Check("required_columns", ("country_code", "country_name")),
        ],
    }


def count(suite: dict[str, list[Check]]) -> int:
    return sum(len(v) for v in suite.values())
