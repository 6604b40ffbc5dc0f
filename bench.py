"""Benchmark: the headline jobs on the stand-in panel at one scale factor.

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Timed steps (each ends in an action):
  build_panel            sources -> validation -> pivot -> staging -> fact, written
  peak_and_last_year     latest-value mart (literal semantics) on the written fact
  latest_value           value-at-latest-year mart on the written fact
  quality_report         mart model tests + scan checks (fact, dim, mart)
  top_economies ... measure_correlation   analyst queries on the written fact
  refresh_all            the whole refresh: raw load, checks, staging, marts, tests
  growing_panel          a raw table keyed by (customer, year): its keys grow with the scale
  landed_refresh         the refresh of landed payloads (JSON, 56 indicators), written by the
                         bench for as many countries as the scale has suppliers (1,296 codes at most)

The same steps run at the sibling sf0.01 first (reported under "small"), so
that one line shows how each step grows.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from atlaspanel import dictionary as D  # noqa: E402
from atlaspanel.operators import analytics as A  # noqa: E402
from atlaspanel.operators import quality  # noqa: E402
from atlaspanel.plans import catalog as C  # noqa: E402
from atlaspanel.plans import pipeline as P  # noqa: E402
from atlaspanel.plans import standins as S  # noqa: E402
from atlaspanel.plans import suites  # noqa: E402
from atlaspanel.plans.landed import landed_refresh_inputs  # noqa: E402
from atlaspanel.plans.panel import FACT_COLUMNS, STANDIN_SUITE, StandinPanel  # noqa: E402
from atlaspanel.plans.pipeline import SourceConfig  # noqa: E402
from atlaspanel.plans.refresh import Layers, refresh_all  # noqa: E402
from atlaspanel.operators import marts  # noqa: E402
from atlaspanel.session import build_session  # noqa: E402
from atlaspanel.sources import readers, sinks  # noqa: E402


def land_payloads(spark, t, folder: str) -> list[str]:
    """Landed payloads of all 56 indicators, one "country" per supplier, six years."""
    seed_columns = [f.name for f in readers.SEED_SCHEMA.fields]
    k = F.col("s_suppkey")
    code = F.concat(F.lit("S"), F.lpad(F.conv(k.cast("string"), 10, 36), 2, "0"))
    s = t.supplier.select(code.alias("code"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("v"), F.lpad(F.conv(k.cast("string"), 10, 36), 2, "0").alias("c2"))
    s = s.dropDuplicates(["code"]).filter(F.length("code") == 3)
    text = {"country_name": F.col("name"), "iso3": F.col("code"), "iso2": F.col("c2"), "continent": F.lit("Asia"), "region": F.lit("r"), "income_group": F.lit("High income")}
    sinks.land_csv(s.select(*[text.get(c, F.lit(0)).alias(c) for c in seed_columns]), f"{folder}/seed")
    years = [str(y) for y in range(2015, 2021)]
    labels = F.explode(F.array(*[F.lit(i.label) for i in D.for_source("wb")]))
    wide = s.select(F.col("code").alias("economy"), labels.alias("Series"), F.col("name").alias("Country"), *[(F.col("v") + int(y)).alias(y) for y in years])
    sinks.land_parquet(wide, f"{folder}/wb")
    year = F.explode(F.array(*[F.lit(y) for y in years]))
    hdr = s.select("code", "name", "v", F.explode(F.array(*[F.lit(i.code) for i in D.for_source("hdr")])).alias("i")).select("code", "name", "v", "i", year.alias("y"))
    record = F.struct(F.col("code").alias("countryIsoCode"), F.col("name").alias("country"), F.col("y").alias("year"), F.col("i").alias("indicatorCode"), F.lit(0.5).alias("value"))
    sinks.land_json_lines(hdr.select(F.to_json(record).alias("doc")), f"{folder}/hdr")
    by_year = F.create_map(*[x for y in years for x in (F.lit(y), F.col("v"))])
    weo = s.select(F.explode(F.array(*[F.lit(i.code) for i in D.for_source("weo")])).alias("i"), F.create_map("code", by_year).alias("m"))
    sinks.land_json_lines(weo.select(F.to_json(F.struct(F.create_map("i", "m").alias("values"))).alias("doc")), f"{folder}/weo")
    doc = F.struct(F.struct(F.col("c2").alias("REF_AREA")).alias("dimensions"), F.array(*[F.lit(y) for y in years]).alias("period"), F.array(*[F.lit(0.5)] * len(years)).alias("value"))
    sinks.land_json_lines(s.select(F.to_json(F.struct(F.struct(F.array(doc).alias("docs")).alias("series"))).alias("doc")), f"{folder}/fdi")
    return [f"{folder}/{x}" for x in ("seed", "wb", "hdr", "weo", "fdi")]


def run(spark, sf_dir: str, scratch: str, tag: str) -> dict[str, float]:
    """Seconds of every step at one scale."""
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    StandinPanel(spark, sf_dir).dim.collect()
    p = StandinPanel(spark, sf_dir)
    db = f"bench_{tag}"

    def build():
        sinks.publish_table(p.fact, db, "fact")
        return readers.read_layer_table(spark, db, "fact")

    fact = timed("build_panel", build)
    dim = p.dim
    sinks.publish_table(dim, db, "dim_country")
    dim = readers.read_layer_table(spark, db, "dim_country")

    timed("peak_and_last_year", lambda: marts.peak_and_last_year(dim, fact, FACT_COLUMNS).collect())
    mart = marts.latest_value(dim, fact, FACT_COLUMNS)
    timed("latest_value", lambda: mart.collect())

    def checks():
        frames = {
            suites.DIM_TABLE: dim,
            suites.FACT_TABLE: fact,
            suites.MART_TABLE: marts.peak_and_last_year(dim, fact, FACT_COLUMNS),
        }
        parts = []
        for suite in (suites.mart_tests(STANDIN_SUITE), suites.mart_scan_checks(STANDIN_SUITE)):
            for name, cks in suite.items():
                parts.append(quality.quality_report(frames[name], cks, name, "marts", parents=frames))
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out.collect()

    timed("quality_report", checks)
    timed("top_economies", lambda: A.top_economies(fact, C.TOP_YEAR, C.GDP, C.GDP_PC, C.HDI).collect())
    timed("member_trend", lambda: A.member_trend(fact, dim, C.MEMBER_FLAG, C.MEMBER_SINCE, C.HDI, C.GDP_PC).collect())
    timed("inequality_by_continent", lambda: A.inequality_by_continent(fact, dim, C.GINI, C.INEQ).collect())
    timed("schooling_gdp_listing", lambda: A.schooling_gdp_listing(fact, C.TOP_YEAR, C.SCHOOLING, C.GDP_PC, C.HDI).collect())
    timed("measure_correlation", lambda: A.measure_correlation(fact, C.GDP, C.HDI).collect())
    timed("refresh_all", lambda: refresh_all(spark, StandinPanel(spark, sf_dir).refresh_inputs(), Layers(f"{db}_raw", f"{db}_stg", f"{db}_marts", f"{db}_quality")).collect())

    by_customer = p.t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("country_code"), F.lit("x").alias("country_name"), F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("indicator"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("ingest_seq"),
    )
    cfg = SourceConfig("customers", S.STANDIN_A, map_labels=True)
    timed("growing_panel", lambda: sinks.replace_table(P.raw_table(by_customer, cfg), db, "growing"))
    paths = land_payloads(spark, p.t, os.path.join(scratch, f"landed-{tag}"))
    landed = Layers(f"{db}_l_raw", f"{db}_l_stg", f"{db}_l_marts", f"{db}_l_quality")
    inputs = lambda: landed_refresh_inputs(spark, *paths, start_year=2000, end_year=2026, current_year=2025)
    timed("landed_refresh", lambda: refresh_all(spark, inputs(), landed, stop_on_fail=False).collect())
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="atlaspanel-bench-")
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=cpus * 2,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    # The smaller sibling also warms up (JVM class loading, compilation), so the
    # timings of the scale asked for are steady-state throughput.
    small_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    small = run(spark, small_dir, scratch, "small") if os.path.isdir(small_dir) and small_dir != sf_dir.rstrip("/") else {}
    times = run(spark, sf_dir, scratch, "main")
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "small": {"sf": 0.01, "queries": small},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
