"""The indicator dictionary: the engine's configuration.

One entry per indicator drives the pivot list, the label->code map, the
code->mart rename, the fact/mart column order and the raw range checks. The
operators take a dictionary as a parameter, so the same code runs on the full
56-indicator panel and on the few indicators of the test-table stand-ins.
"""

from __future__ import annotations

from dataclasses import dataclass

INF = float("inf")


@dataclass(frozen=True)
class Indicator:
    source: str  # which raw table carries it: wb, hdr, weo, fdi (or a stand-in source)
    code: str  # raw column name / pivot key after label mapping
    mart: str  # column name in staging, fact and marts
    label: str | None = None  # descriptive label in the payload (pivot key before mapping)
    lo: float | None = None  # raw-layer valid range (None = unchecked side)
    hi: float | None = None


def ind(source, mart, code, label=None, lo=None, hi=None) -> Indicator:
    return Indicator(source=source, code=code, mart=mart, label=label, lo=lo, hi=hi)


# --- Fixed values (must equal the reference for identical tables) -----------
# Indicator dictionary in staging/fact/mart order:
# (source, mart column, raw column, payload label, valid min, valid max).
INDICATORS: tuple[Indicator, ...] = (
    ind("wb", "wb_gdp_constant_2015_usd", "NY_GDP_MKTP_KD", "GDP (constant 2015 US$)"),
    ind("wb", "wb_gdp_ppp_current_intl", "NY_GDP_MKTP_PP_CD", "GDP, PPP (current international $)", 20000000, 50000000000000),
    ind("wb", "wb_gdp_per_capita_ppp", "NY_GDP_PCAP_PP_CD", "GDP per capita, PPP (current international $)", 0, None),
    ind("wb", "wb_gdp_per_capita_current_usd", "NY_GDP_PCAP_CD", "GDP per capita (current US$)"),
    ind("wb", "wb_gdp_growth_pct", "NY_GDP_MKTP_KD_ZG", "GDP growth (annual %)"),
    ind("wb", "wb_inflation_consumer_pct", "FP_CPI_TOTL_ZG", "Inflation, consumer prices (annual %)"),
    ind("wb", "wb_real_interest_rate_pct", "FR_INR_RINR", "Real interest rate (%)"),
    ind("wb", "wb_gross_capital_formation_pct_gdp", "NE_GDI_TOTL_ZS", "Gross capital formation (% of GDP)"),
    ind("wb", "wb_agriculture_value_added_pct_gdp", "NV_AGR_TOTL_ZS", "Agriculture, forestry, and fishing, value added (% of GDP)", 0, 100),
    ind("wb", "wb_industry_value_added_pct_gdp", "NV_IND_TOTL_ZS", "Industry (including construction), value added (% of GDP)", 0, 100),
    ind("wb", "wb_services_value_added_pct_gdp", "NV_SRV_TOTL_ZS", "Services, value added (% of GDP)", 0, 100),
    ind("wb", "wb_exports_pct_gdp", "NE_EXP_GNFS_ZS", "Exports of goods and services (% of GDP)", 0, None),
    ind("wb", "wb_imports_pct_gdp", "NE_IMP_GNFS_ZS", "Imports of goods and services (% of GDP)", 0, None),
    ind("wb", "wb_current_account_balance_pct_gdp", "BN_CAB_XOKA_GD_ZS", "Current account balance (% of GDP)"),
    ind("wb", "wb_trade_pct_gdp", "NE_TRD_GNFS_ZS", "Trade (% of GDP)"),
    ind("wb", "wb_total_reserves_current_usd", "FI_RES_TOTL_CD", "Total reserves (includes gold, current US$)"),
    ind("wb", "wb_tax_revenue_pct_gdp", "GC_TAX_TOTL_GD_ZS", "Tax revenue (% of GDP)"),
    ind("wb", "wb_domestic_credit_private_pct_gdp", "FS_AST_PRVT_GD_ZS", "Domestic credit to private sector (% of GDP)"),
    ind("wb", "wb_population_total", "SP_POP_TOTL", "Population, total", 0, None),
    ind("wb", "wb_unemployment_pct", "SL_UEM_TOTL_ZS", "Unemployment, total (% of total labor force) (modeled ILO estimate)", 0, 100),
    ind("wb", "wb_gdp_per_person_employed", "SL_GDP_PCAP_EM_KD", "GDP per person employed (constant 2021 PPP $)"),
    ind("wb", "wb_labor_force_participation_pct", "SL_TLF_CACT_ZS", "Labor force participation rate, total (% of total population ages 15+) (modeled ILO estimate)", 0, 100),
    ind("wb", "wb_gini_index", "SI_POV_GINI", "Gini index", 0, 100),
    ind("wb", "wb_poverty_headcount_pct", "SI_POV_DDAY", "Poverty headcount ratio at $2.15 a day (2017 PPP) (% of population)"),
    ind("wb", "wb_school_enrollment_secondary_pct", "SE_SEC_ENRR", "School enrollment, secondary (% gross)"),
    ind("wb", "wb_education_expenditure_pct_gdp", "SE_XPD_TOTL_GD_ZS", "Government expenditure on education, total (% of GDP)", 0, 100),
    ind("wb", "wb_health_expenditure_current_pct_gdp", "SH_XPD_CHEX_GD_ZS", "Current health expenditure (% of GDP)", 0, 100),
    ind("wb", "wb_health_expenditure_govt_pct", "SH_XPD_GHED_CH_ZS", "Domestic general government health expenditure (% of current health expenditure)", 0, 100),
    ind("hdr", "hdr_human_development_index", "hdi", None, 0, 1),
    ind("hdr", "hdr_gender_inequality_index", "gii", None, 0, 1),
    ind("hdr", "hdr_gender_development_index", "gdi", None, 0, 2),
    ind("hdr", "hdr_multidimensional_poverty_index", "mpi_value", None, 0, 1),
    ind("hdr", "hdr_inequality_coefficient", "coef_ineq", None, 0, 100),
    ind("hdr", "hdr_inequality_income", "ineq_inc", None, 0, 100),
    ind("hdr", "hdr_inequality_education", "ineq_edu", None, 0, 100),
    ind("hdr", "hdr_inequality_life_expectancy", "ineq_le", None, 0, 100),
    ind("hdr", "hdr_mean_years_schooling", "mys", None, 0, None),
    ind("hdr", "hdr_expected_years_schooling", "eys", None, 0, None),
    ind("hdr", "hdr_life_expectancy_years", "le", None, 0, None),
    ind("hdr", "hdr_labor_force_male_pct", "lfpr_m", None, 0, 100),
    ind("hdr", "hdr_labor_force_female_pct", "lfpr_f", None, 0, 100),
    ind("hdr", "hdr_mpi_nutrition_pct", "nutrition"),
    ind("hdr", "hdr_mpi_child_mortality_pct", "child_mortality"),
    ind("hdr", "hdr_mpi_years_schooling_pct", "years_of_schooling"),
    ind("hdr", "hdr_mpi_school_attendance_pct", "school_attendance"),
    ind("hdr", "hdr_mpi_cooking_fuel_pct", "cooking_fuel"),
    ind("hdr", "hdr_mpi_sanitation_pct", "sanitation"),
    ind("hdr", "hdr_mpi_drinking_water_pct", "drinking_water"),
    ind("hdr", "hdr_mpi_electricity_pct", "electricity"),
    ind("hdr", "hdr_mpi_housing_pct", "housing"),
    ind("hdr", "hdr_mpi_assets_pct", "assets"),
    ind("weo", "imf_public_debt_pct_gdp", "GGXWDG_NGDP", None, 0, None),
    ind("weo", "imf_primary_balance_pct_gdp", "GGXCNL_NGDP", None, -100, 200),
    ind("weo", "imf_current_account_balance", "BCA", None, -2000, 1500),
    ind("weo", "imf_ppp_conversion_rate", "PPPEX", None, 0, None),
    ind("fdi", "imf_financial_development_index", "FD_FD_IX", None, 0, 1),
)

# Country dimension: seed columns, and the staged names of the six 0/1 flags.
SEED_TEXT_COLUMNS = ("country_name", "iso3", "iso2", "continent", "region", "income_group")
SEED_FLAG_COLUMNS = ("EU", "OECD", "ASEAN", "BRICS", "G20", "FCS")
FLAG_RENAMES = {
    "EU": "is_eu",
    "OECD": "is_oecd",
    "ASEAN": "is_asean",
    "BRICS": "is_brics",
    "G20": "is_g20",
    "FCS": "is_fcs",
}

# Accepted values of the dimension.
CONTINENTS = ("Africa", "Asia", "Europe", "North America", "South America", "Oceania", "Antarctica")
INCOME_GROUPS = ("Low income", "Lower middle income", "Upper middle income", "High income")
FLAG_VALUES = (0, 1)

# Validation rules of a data point.
CODE_MIN_LENGTH = 2
CODE_MAX_LENGTH = 3
AGGREGATE_CODE_PREFIX = "1C_"
AGGREGATE_CODE_MARKER = "ALLC"
MIN_YEAR = {"wb": 2000, "hdr": 1990, "weo": 2000, "fdi": 2000}
WINDOW_START_YEAR = 2000

# Scan-check grading: warn when the invalid count is > 0, fail when >= 150.
WARN_ABOVE = 0
FAIL_AT = 150
# Lowest year allowed in the fact table (mart scan).
FACT_MIN_YEAR = 2000
# --- end of fixed values ----------------------------------------------------


def for_source(source: str, dictionary=INDICATORS) -> tuple[Indicator, ...]:
    return tuple(i for i in dictionary if i.source == source)


def codes(dictionary) -> list[str]:
    return [i.code for i in dictionary]


def marts(dictionary) -> list[str]:
    return [i.mart for i in dictionary]


def label_map(dictionary) -> dict[str, str]:
    return {i.label: i.code for i in dictionary if i.label is not None}


def rename_map(dictionary) -> dict[str, str]:
    return {i.code: i.mart for i in dictionary}
