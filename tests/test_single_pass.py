"""refresh_all's one-scan load (checked_points) equals the two-pass operators.

For every stand-in source, a fault-injected source (V1/V3/V5 together, with
label mapping) and a tie-prone order key, the raw table, the rejects and the
empty-source guard derived from ``checked_points`` equal ``raw_table`` over
``validate_points`` and its rejects, row for row (multisets, NULL-aware).
"""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from atlaspanel.plans import catalog as C
from atlaspanel.plans import panel as PN
from atlaspanel.plans import pipeline as P

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _bag(df):
    cols = sorted(df.columns)
    types = dict(df.dtypes)
    exprs = [F.array_join(c, ",") if types[c].startswith("array") else F.col(c).cast("string") for c in cols]
    return cols, sorted(tuple("NULL" if v is None else v for v in r) for r in df.select(*exprs).collect())


def _assert_same(points, cfg):
    valid, rejects = P.validate_points(points, cfg)
    checked = P.checked_points(points, cfg)
    assert _bag(P.raw_from_checked(checked, cfg)) == _bag(P.raw_table(valid, cfg))
    assert _bag(P.rejects_from_checked(checked, points.columns, cfg)) == _bag(rejects)
    assert P.has_valid_points(checked).isEmpty() == valid.isEmpty()


@pytest.mark.parametrize("which", ["a", "b", "c1", "c2"])
def test_single_pass_matches_two_pass(spark, which):
    p = PN.StandinPanel(spark, SF)
    cfg, points = p._source(which)
    _assert_same(points, cfg)


def test_single_pass_with_faults_labels_and_ties(spark):
    p = PN.StandinPanel(spark, SF)
    faulty = C._faulty_points_a(p)
    cfg = dataclasses.replace(PN.A_CFG, year_is_text=True)
    _assert_same(faulty, cfg)
    # every point twice: identical rejects must both survive, and order-key
    # ties must resolve to the smallest value
    doubled = faulty.unionByName(faulty.withColumn("value", F.concat(F.col("value"), F.lit("0"))))
    _assert_same(doubled, dataclasses.replace(cfg, order_unique=False))
    _assert_same(faulty.unionByName(faulty), dataclasses.replace(cfg, order_unique=False))


def test_single_pass_empty_source(spark):
    p = PN.StandinPanel(spark, SF)
    cfg, points = p._source("a")
    none_valid = points.withColumn("country_code", F.lit("X"))
    checked = P.checked_points(none_valid, cfg)
    assert P.has_valid_points(checked).isEmpty()
    assert P.rejects_from_checked(checked, points.columns, cfg).count() == points.count()


def test_single_pass_keeps_reject_values_bit_exact(spark):
    # floating grouping keys are normalised (-0.0 -> 0.0); reject values must not be
    rows = [("XXXX", "n", 2000, "P1", -0.0, 1), ("XXXX", "n", 2000, "P1", float("nan"), 2), ("N01", "n", 2000, "P1", 1.5, 3)]
    points = spark.createDataFrame(rows, "country_code string, country_name string, year int, indicator string, value double, ingest_seq long")
    cfg = PN.B_CFG
    checked = P.checked_points(points, cfg)
    got = sorted(str(r.value) for r in P.rejects_from_checked(checked, points.columns, cfg).collect())
    assert got == ["-0.0", "nan"]
    _assert_same(points, cfg)
