"""A refresh that dies goes on where it stopped; staging merges without an exchange."""

import os
import re

import pytest

from atlaspanel.operators import spine
from atlaspanel.plans import ledger
from atlaspanel.plans import panel as PN
from atlaspanel.plans import pipeline as P
from atlaspanel.plans import refresh
from atlaspanel.plans.refresh import Layers, refresh_all
from atlaspanel.sources import sinks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def bag(df):
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


def contents(spark, layers):
    out = {}
    for layer in (layers.raw, layers.staging, layers.marts):
        for t in [r.tableName for r in spark.sql(f"SHOW TABLES IN `{layer}`").collect() if r.namespace and not {"__v", "__i"} & {r.tableName[i : i + 3] for i in range(len(r.tableName))}]:
            out[layer.split("_", 1)[1], t] = bag(spark.table(f"{layer}.{t}"))
    return out


def killed(monkeypatch, module, name, message):
    def die(*_, **__):
        raise RuntimeError(message)

    monkeypatch.setattr(module, name, die)


def test_a_killed_refresh_goes_on(spark, monkeypatch):
    whole = Layers("u_raw", "u_stg", "u_marts", "u_quality")
    report = bag(refresh_all(spark, PN.StandinPanel(spark, SF).refresh_inputs(), whole, resume=False))
    layers = Layers("k_raw", "k_stg", "k_marts", "k_quality")
    with monkeypatch.context() as m:  # dies after staging
        killed(m, P, "build_panel", "killed")
        with pytest.raises(RuntimeError, match="killed"):
            refresh_all(spark, PN.StandinPanel(spark, SF).refresh_inputs(), layers)
    before = {t: sinks.versions(spark, "k_raw", t) for t in ("a", "b", "a_checked", "b_checked")}
    with monkeypatch.context() as m:  # nothing before the fact is done again
        for name in ("checked_points", "raw_from_checked", "stage_named_source", "stage_two_part_source", "load_report"):
            killed(m, P, name, f"{name} ran again")
        killed(m, refresh, "seed_report", "seed_report ran again")
        again = bag(refresh_all(spark, PN.StandinPanel(spark, SF).refresh_inputs(), layers))
    assert again == report
    assert {t: sinks.versions(spark, "k_raw", t) for t in before} == before
    assert contents(spark, layers) == contents(spark, whole)
    # a finished run is no unfinished one: the next refresh reads its inputs anew
    refresh_all(spark, PN.StandinPanel(spark, SF).refresh_inputs(), layers)
    assert len(sinks.versions(spark, "k_raw", "a")) == 2
    assert contents(spark, layers) == contents(spark, whole)


def test_steps_of_other_inputs_or_dropped_versions_are_done_again(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    first = ledger.run_digest(ledger.listing_digest([spark.read.parquet(path)]), "settings")
    assert first == ledger.run_digest(ledger.listing_digest([spark.read.parquet(path)]), "settings")
    assert first != ledger.run_digest(ledger.listing_digest([spark.read.parquet(path)]), "other settings")
    assert ledger.run_digest(ledger.listing_digest([spark.range(3)]), "settings") is None
    made = []

    def make():
        made.append(1)
        return [("g_x", "t", sinks.write_version(spark.read.parquet(path), "g_x", "t"))]

    assert ledger.Ledger(spark, "g_q", first).step("one", make)
    assert not ledger.Ledger(spark, "g_q", first).step("one", make) and len(made) == 1
    # another run switched the name: passing over the step switches it back
    sinks.replace_table(spark.range(9), "g_x", "t")
    ledger.Ledger(spark, "g_q", first).step("one", make)
    assert len(made) == 1 and spark.table("g_x.t").count() == 3
    spark.sql(f"DROP TABLE g_x.{sinks.versions(spark, 'g_x', 't')[0]}")
    assert ledger.Ledger(spark, "g_q", first).step("one", make) and len(made) == 2
    spark.range(2).write.mode("append").parquet(path)
    second = ledger.run_digest(ledger.listing_digest([spark.read.parquet(path)]), "settings")
    assert second != first and ledger.Ledger(spark, "g_q", second).step("one", make) and len(made) == 3
    assert ledger.Ledger(spark, "g_q", None).step("one", make) and len(made) == 4


def test_a_failing_gate_is_checked_again(spark):
    from atlaspanel.operators.quality import QualityGateError
    from atlaspanel.plans.suites import SuiteParams

    layers = Layers("h_raw", "h_stg", "h_marts", "h_quality")
    for _ in range(2):
        inputs = PN.StandinPanel(spark, SF).refresh_inputs()
        inputs.params = SuiteParams(**{**PN.STANDIN_SUITE.__dict__, "continents": ("Africa",)})
        with pytest.raises(QualityGateError):
            refresh_all(spark, inputs, layers)


def test_bucketed_staging_is_merged_without_an_exchange(spark):
    layers = Layers("x_raw", "x_stg", "x_marts", "x_quality")
    refresh_all(spark, PN.StandinPanel(spark, SF).refresh_inputs(), layers)
    staged = [spark.table(f"x_stg.{t}") for t in ("stg_a", "stg_b", "stg_imf")]
    dim = spark.table("x_marts.dim_country")
    columns = [c for s in staged for c in s.columns if c not in ("country_code", "country_name", "year")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as beyond the size that one side may have
    try:
        fact = P.build_panel(staged, dim, columns, co_located=True)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"(?<!Broadcast)Exchange", plan)) == 0, plan
        assert plan.count("SortMergeJoin") == 3 and plan.count("Bucketed: true") == 6
        assert "Exchange hashpartitioning" in P.build_panel(staged, dim, columns)._jdf.queryExecution().executedPlan().toString()
        assert bag(fact) == bag(P.build_panel(staged, dim, columns)) == bag(spark.table("x_marts.fact_macro_indicators").select(*fact.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_null_keys_give_the_spine_rows(spark):
    a = spark.createDataFrame([("A", None, 1.0), ("A", 2000, 2.0), (None, 2000, 3.0), (None, None, 4.0)], "country_code string, year int, a double")
    b = spark.createDataFrame([("A", None, 5.0), ("A", 2000, 6.0), ("B", 2001, 7.0)], "country_code string, year int, b double")
    c = spark.createDataFrame([(None, 2000, 8.0), ("B", 2001, 9.0)], "country_code string, year int, c double")
    plain = bag(spine.merge_sources_on_spine(spine.spine_distinct([a, b, c]), [a, b, c]))
    assert bag(spine.outer_merge([a, b, c])) == plain
    assert bag(spine.outer_merge([a, b, c], unique_null_keys=False)) == plain
    twice = a.unionByName(a)  # repeated null keys
    plain = bag(spine.merge_sources_on_spine(spine.spine_distinct([twice, b]), [twice, b]))
    assert bag(spine.outer_merge([twice, b], unique_null_keys=False)) == plain
    dim = spark.createDataFrame([("A", "Land A")], "country_code string, country_name string")
    by_spine = bag(spine.fact_panel(spine.spine_distinct([a, b]), dim, [a, b], ["a", "b"]))
    assert bag(spine.fact_panel(None, dim, [a, b], ["a", "b"])) == by_spine
