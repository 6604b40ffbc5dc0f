"""Plan shapes the scale design depends on (executed plans, after AQE).

* the fact reads every points table once (events twice: once per part of the
  IMF-like source), so no source is computed twice;
* refresh_all's single-pass load scans a source's points once;
* the heavy registered queries use hash aggregates and equi-joins only: no
  sort-based or object aggregate, no nested-loop or cartesian join, no Python.
"""

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as E
from atlaspanel.plans import panel as PN
from atlaspanel.plans import pipeline as P

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")

FORBIDDEN = (
    "SortAggregate",
    "ObjectHashAggregate",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "BatchEvalPython",
    "ArrowEvalPython",
)


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _tables_scanned(df) -> Counter:
    plan = df._jdf.queryExecution().executedPlan()
    out = Counter()
    for node in plan.toString().splitlines():
        m = re.search(r"Scan parquet\s*\[([^\]]*)\]", node)
        if m:
            cols = m.group(1)
            for prefix, table in (("l_", "lineitem"), ("o_", "orders"), ("event_id", "events"), ("ts#", "events")):
                if re.search(rf"\b{prefix}", cols):
                    out[table] += 1
                    break
    return out


def test_fact_reads_each_points_table_once(spark):
    p = PN.StandinPanel(spark, SF)
    fact = p.fact
    plan = _executed(fact)
    got = _tables_scanned(fact)
    assert got["lineitem"] == 1 and got["orders"] == 1, got
    assert got["events"] == 2, got  # WEO-like and FDI-like parts, once each
    assert not [f for f in FORBIDDEN if f in plan]


@pytest.mark.parametrize("name", ["inequality_by_continent", "scalar_max_filter", "fact_panel", "merge_sources_on_spine", "dim_left_fact", "split_valid_rejects"])
def test_no_points_table_is_read_twice(spark, name):
    df = E.queries()[name](spark, SF)
    _executed(df)
    got = _tables_scanned(df)
    assert got["lineitem"] <= 1 and got["orders"] <= 1 and got["events"] <= 2, got


def test_year_condition_reaches_the_scans(spark):
    """The year of A1 stands below the pivot of every source, not above the outer joins."""
    plan = E.queries()["top_economies"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "= 2001" in line]
    for column, times in (("o_orderdate", 1), ("l_shipdate", 1), ("cast(ts#", 2)):
        assert sum(column in line for line in filters) == times, plan


@pytest.mark.parametrize("which", ["a", "b", "c1", "c2"])
def test_single_pass_load_scans_points_once(spark, which):
    p = PN.StandinPanel(spark, SF)
    cfg, points = p._source(which)
    checked = P.checked_points(points, cfg)
    plan = _executed(checked)
    got = _tables_scanned(checked)
    assert sum(got.values()) == 1, got
    assert plan.count("Exchange hashpartitioning") == 1
    assert not [f for f in FORBIDDEN if f in plan]


@pytest.mark.parametrize(
    "name",
    [
        "build_panel",
        "peak_and_last_year",
        "latest_value",
        "dim_left_fact",
        "quality_report",
        "test_relationships",
        "inequality_by_continent",
        "load_profile",
        "reject_summary",
    ],
)
def test_heavy_queries_stay_hash_based(spark, name):
    df = E.queries()[name](spark, SF)
    plan = _executed(df)
    assert not [f for f in FORBIDDEN if f in plan], name
