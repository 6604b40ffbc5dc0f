"""End to end on the driver's sf0.001 tables: entry, registry vs oracle, refresh."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from atlaspanel.operators.quality import QualityGateError
from atlaspanel.plans import panel as PN
from atlaspanel.plans.refresh import Layers, refresh_all
from atlaspanel.plans.suites import SuiteParams

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")

ORACLE_SAMPLE = [
    "build_panel",
    "fact_panel",
    "peak_and_last_year",
    "latest_value",
    "split_valid_rejects",
    "reject_summary",
    "read_nested_map",
    "read_parallel_arrays",
    "quality_report",
    "top_economies",
    "inequality_by_continent",
]


def _norm(v):
    return f"{v:.9g}" if isinstance(v, float) else ("NULL" if v is None else str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["country_code", "country_name", "year"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from atlaspanel.plans import catalog

    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(catalog.QUERIES) >= 80


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, cur.fetchall())


def test_refresh_all_runs_every_layer(spark, tmp_path):
    p = PN.StandinPanel(spark, SF)
    backups = str(tmp_path / "backup")
    report = refresh_all(spark, p.refresh_inputs(), Layers("r_raw", "r_stg", "r_marts", "r_quality"), backup_dir=backups)
    assert sorted(os.listdir(backups)) == ["a_1990_2026", "b_1990_2026", "c1_1990_2026", "c2_1990_2026", "country_metadata"]
    back = spark.read.option("header", True).csv(os.path.join(backups, "a_1990_2026"))
    assert back.count() == spark.table("r_raw.a").count()
    rows = report.collect()
    assert len(rows) == 113
    assert not [r for r in rows if r.outcome == "fail"]
    fact = spark.table("r_marts.fact_macro_indicators")
    assert fact.count() == fact.select("country_code", "year").distinct().count()
    assert spark.table("r_marts.mart_country_indicators_wide").count() == spark.table("r_marts.dim_country").count()


def test_refresh_all_stops_on_failing_gate(spark):
    p = PN.StandinPanel(spark, SF)
    inputs = p.refresh_inputs()
    inputs.params = SuiteParams(**{**PN.STANDIN_SUITE.__dict__, "continents": ("Africa",)})
    with pytest.raises(QualityGateError):
        refresh_all(spark, inputs, Layers("f_raw", "f_stg", "f_marts", "f_quality"))
