"""The real 56-indicator configuration on landed payload fixtures."""

import json
import os

from pyspark.sql import functions as F

from atlaspanel import dictionary as D
from atlaspanel.plans.landed import landed_refresh_inputs
from atlaspanel.plans.refresh import Layers, refresh_all

SEED = """country_name,iso3,iso2,continent,region,income_group,EU,OECD,ASEAN,BRICS,G20,FCS
Namibia,NAM,NA,Africa,Sub-Saharan Africa,Upper middle income,0,0,0,0,0,0
"Tanzania, United Republic of",TZA,TZ,Africa,Sub-Saharan Africa,Lower middle income,0,0,0,0,0,0
Germany,DEU,DE,Europe,Europe & Central Asia,High income,1,1,0,0,1,0
"""


def _land(spark, d):
    open(os.path.join(d, "seed.csv"), "w").write(SEED)
    wide = spark.createDataFrame(
        [
            ("NAM", "GDP (constant 2015 US$)", "Namibia", 1.0e10, None),
            ("NAM", "GDP (constant 2015 US$)", "Namibia", 9.0e10, 2.0e10),  # repeated (economy, Series)
            ("DEU", "Population, total", "Germany", 8.0e7, 8.1e7),
            ("DEU", "Poverty at $3.00 a day", "Germany", 0.1, 0.2),  # label missing from the dictionary
            ("ZZZ", "Population, total", "Nowhere", 5.0, 6.0),  # not in the dimension
        ],
        "economy string, Series string, Country string, `2020` double, `2021` double",
    )
    wide.coalesce(1).write.parquet(os.path.join(d, "wb", "1"))  # one landed payload file
    later = spark.createDataFrame([("DEU", "Population, total", "Germany", 7.0, 8.2e7)], "economy string, Series string, Country string, `2021` double, `2022` double")
    later.coalesce(1).write.parquet(os.path.join(d, "wb", "2"))  # a chunk with another year
    hdr = [
        {"countryIsoCode": "NAM", "country": "Namibia", "year": 2020, "indicatorCode": "hdi", "value": 0.61},
        {"countryIsoCode": "NAM", "country": "Namibia", "year": "20x1", "indicatorCode": "hdi", "value": 0.7},
        {"countryIsoCode": "TZA", "country": "Tanzania, United Republic of", "year": 2021, "indicatorCode": "mys", "value": 6.2},
    ]
    open(os.path.join(d, "hdr.json"), "w").write(json.dumps(hdr))
    weo = {"values": {"BCA": {"DEU": {"2020": 250.0, "2021": None}, "NAM": {"1999": 1.0}}}}
    open(os.path.join(d, "weo.json"), "w").write(json.dumps(weo))
    fdi = {
        "series": {
            "docs": [
                {"dimensions": {"REF_AREA": "NA"}, "period": ["2020", "2021"], "value": [0.3, None]},
                {"dimensions": {"REF_AREA": "1C_080"}, "period": ["2020"], "value": [0.9]},
            ]
        }
    }
    open(os.path.join(d, "fdi.json"), "w").write(json.dumps(fdi))


def test_landed_refresh_with_full_dictionary(spark, tmp_path):
    d = str(tmp_path)
    _land(spark, d)
    inputs = landed_refresh_inputs(
        spark, f"{d}/seed.csv", f"{d}/wb", f"{d}/hdr.json", f"{d}/weo.json", f"{d}/fdi.json",
        start_year=2000, end_year=2026, current_year=2025, multi_line_json=True,
    )
    report = refresh_all(spark, inputs, Layers("l_raw", "l_stg", "l_marts", "l_quality"), stop_on_fail=False, backup_dir=f"{d}/backup")
    rows = report.collect()
    assert len(rows) == 52 + 56 + 20
    fact = spark.table("l_marts.fact_macro_indicators")
    assert len(fact.columns) == 3 + 56
    got = {(r.country_code, r.year): r for r in fact.collect()}
    # first value in payload order wins for the repeated (economy, Series) row
    assert got[("NAM", 2020)].wb_gdp_constant_2015_usd == 1.0e10
    assert got[("NAM", 2021)].wb_gdp_constant_2015_usd == 2.0e10
    assert got[("NAM", 2020)].hdr_human_development_index == 0.61
    assert got[("NAM", 2020)].imf_financial_development_index == 0.3  # ISO2 'NA' -> NAM
    assert got[("DEU", 2020)].imf_current_account_balance == 250.0
    # the second chunk's year comes through; the year of both keeps the first chunk's value
    assert got[("DEU", 2022)].wb_population_total == 8.2e7
    assert got[("DEU", 2021)].wb_population_total == 8.1e7
    assert got[("TZA", 2021)].country_name == "Tanzania, United Republic of"
    assert ("ZZZ", 2020) not in got
    assert ("NAM", 1999) not in got  # outside the window and below the WEO floor
    mart = {r.country_code: r for r in spark.table("l_marts.mart_country_indicators_wide").collect()}
    assert len(spark.table("l_marts.mart_country_indicators_wide").columns) == 2 + 112
    assert (mart["NAM"].wb_gdp_constant_2015_usd, mart["NAM"].wb_gdp_constant_2015_usd_year) == (2.0e10, 2021)
    rejects = spark.table("l_raw.hdr_indicators_rejects").select(F.explode("errors").alias("e")).collect()
    assert [r.e for r in rejects] == ["year_text"]
    fdi_rej = spark.table("l_raw.imf_fdi_indicator_rejects").collect()
    assert len(fdi_rej) == 1 and "aggregate" in fdi_rej[0].errors
    assert len(D.INDICATORS) == 56
    # raw tables keep the payloads' own key names; another session reads the staging layer
    assert spark.table("l_raw.hdr_indicators").columns[:2] == ["countryIsoCode", "country"]
    assert "Country" in spark.table("l_raw.wb_indicators").columns
    assert spark.newSession().table("l_stg.stg_wb_indicators").count() > 0
    # what the load took in: the label without a dictionary entry, the rejects, the profile
    load = {(r.source, r.metric, r.detail): r.number for r in spark.table("l_quality.load_report").collect()}
    assert any(m == "unmapped_label" and s == "wb_indicators" for s, m, _ in load), load
    assert load["hdr_indicators", "reject", "year_text"] == 1
    assert load["hdr_indicators", "valued", None] == 2
    # a point outside the window is no fault
    assert ("imf_weo_indicators", "reject", "year_range") not in load

    # the seed is backed up, its first rows and member counts are reported
    assert spark.read.option("header", True).csv(f"{d}/backup/country_metadata").count() == 3
    seed = {(r.part, r["item"]): (r.detail, r.number) for r in spark.table("l_quality.seed_report").collect()}
    assert seed["members", "EU"][1] == 1 and seed["members", "G20"][1] == 1 and seed["members", "FCS"][1] == 0
    assert json.loads(seed["sample", "NAM"][0]) == {"country_name": "Namibia", "iso3": "NAM", "continent": "Africa", "income_group": "Upper middle income"}

    from atlaspanel.plans import questions as Q

    top = Q.top_economies(spark, 2021, layer="l_marts").collect()
    assert [(r.country_name, r.gdp_trillions_usd) for r in top] == [("Namibia", 0.02)]
    assert Q.member_trend(spark, 2000, flag="is_eu", layer="l_marts").count() == 0
    assert Q.inequality_by_continent(spark, layer="l_marts").count() == 0  # no Gini values landed
    assert [r.country_name for r in Q.schooling_gdp_listing(spark, 2021, layer="l_marts").collect()] == []
    assert Q.measure_correlation(spark, layer="l_marts").collect()[0].pairs == 0


def test_refresh_without_fdi(spark, tmp_path):
    """An empty FDI payload leaves an empty table behind, and the refresh goes on."""
    d = str(tmp_path)
    _land(spark, d)
    where = dict(start_year=2000, end_year=2026, current_year=2025, multi_line_json=True)
    layers = Layers("e_raw", "e_stg", "e_marts", "e_quality")
    paths = [f"{d}/seed.csv", f"{d}/wb", f"{d}/hdr.json", f"{d}/weo.json", f"{d}/fdi.json"]
    refresh_all(spark, landed_refresh_inputs(spark, *paths, **where), layers, stop_on_fail=False)
    assert spark.table("e_raw.imf_fdi_indicator").count() == 1
    open(f"{d}/fdi.json", "w").write(json.dumps({"series": {"docs": []}}))
    refresh_all(spark, landed_refresh_inputs(spark, *paths, **where), layers, stop_on_fail=False)
    assert spark.table("e_raw.imf_fdi_indicator").count() == 0
    assert spark.table("e_marts.fact_macro_indicators").filter("imf_financial_development_index is not null").count() == 0
