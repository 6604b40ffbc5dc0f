"""L3 ``refresh_all``: raw load -> raw checks -> staging -> marts -> model tests
-> mart checks, in a fixed order, stopping at the first failing gate.

Each layer is written as tables (full refresh) and the next layer reads the
tables back by name, which cuts lineage at every layer boundary: a lost
executor recomputes at most one layer, never the pipeline from the payloads.
The quality report of every gate is itself written as a table, so checks run
once even though the gate and the caller both read it. Finished steps are kept
in a ledger; a refresh that died goes on after the last of them.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.operators import analytics, conform, marts, quality, rules, spine
from atlaspanel.plans import ledger, suites
from atlaspanel.plans import pipeline as P
from atlaspanel.sources import readers, sinks


@dataclass
class RefreshInputs:
    """What one refresh consumes: the seed and, per source, points + config.

    ``sources`` maps a raw table name to (long points, SourceConfig).
    ``named`` lists the sources staged with their own country name (WB/HDR
    style); ``two_part`` is the (weo, fdi) pair staged on its own spine.
    """

    seed: DataFrame
    sources: dict
    named: tuple
    two_part: tuple | None
    dictionary: tuple
    params: suites.SuiteParams = field(default_factory=suites.SuiteParams)
    two_part_name: str = "imf_indicators"  # staged as stg_<two_part_name>
    optional: tuple = ()  # raw tables of sources that may be empty (the load goes on without them)


@dataclass(frozen=True)
class Layers:
    raw: str = "raw"
    staging: str = "staging"
    marts: str = "marts"
    quality: str = "quality"


def _run_suite(
    frames: dict[str, DataFrame], suite: dict, layer: str, parents: dict[str, DataFrame]
) -> DataFrame:
    parts = [
        quality.quality_report(frames[name], checks, name, layer=layer, parents=parents)
        for name, checks in suite.items()
        if name in frames
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


#: The dimension's membership flags, as the seed's columns name them.
MEMBERSHIPS = ("EU", "OECD", "ASEAN", "BRICS", "G20", "FCS")
SEED_SAMPLE = ["country_name", "iso3", "continent", "income_group"]


def seed_report(seed: DataFrame) -> DataFrame:
    """What the seed load shows: its first rows and the members of every group, as (part, item, detail, number)."""
    sample = readers.head_sample(seed, SEED_SAMPLE, ["iso3", "country_name"])
    first = sample.select(F.lit("sample").alias("part"), F.col("iso3").alias("item"), F.to_json(F.struct(*SEED_SAMPLE)).alias("detail"), F.lit(None).cast("long").alias("number"))
    flags = [c for c in MEMBERSHIPS if c in seed.columns]
    sums = analytics.sum_flags(seed, flags)
    members = sums.select(F.inline(F.array(*[F.struct(F.lit("members").alias("part"), F.lit(c).alias("item"), F.lit(None).cast("string").alias("detail"), F.col(f"{c}_members").alias("number")) for c in flags])))
    return first.unionByName(members)


def refresh_all(
    spark: SparkSession,
    inputs: RefreshInputs,
    layers: Layers = Layers(),
    stop_on_fail: bool = True,
    fact_partition_by: list[str] | None = ("year",),
    parallel_loads: int = 4,
    backup_dir: str | None = None,
    stage_buckets: int | None = None,
    resume: bool = True,
) -> DataFrame:
    """Run the whole refresh; returns the quality report of every step.

    ``backup_dir`` (a shared path) also exports the seed and every raw table as a
    header CSV, the latter named with its extraction window (K3), read from the
    written table. What each load took in, its unmapped labels and its rejects
    by error code are written as the table ``load_report`` of the quality layer,
    the seed's first rows and member counts as ``seed_report``. Rejects are
    stored counted (``<source>_rejects_counted``); ``<source>_rejects`` is a view
    that repeats them. Staging is written as tables of the staging layer, which
    later sessions read too, bucketed on the merge keys (``stage_buckets``, by
    default the shuffle partitions), so the fact is merged without an exchange;
    the wide mart is clustered by country (``readers.read_clustered``).

    Every table is published as a new version (``sinks``). ``resume``: steps that
    an unfinished refresh of the same input files and settings has done are
    passed over (``ledger``); inputs that are no files are always read anew.
    """
    p = inputs.params
    reports = []
    run = None
    if resume:
        frames = [inputs.seed, *(points for points, _ in inputs.sources.values())]
        decided = [(n, cfg) for n, (_, cfg) in inputs.sources.items()]
        run = ledger.run_digest(ledger.listing_digest(frames), decided, inputs.named, inputs.two_part, inputs.dictionary, p, layers, fact_partition_by, stage_buckets, stop_on_fail)
    book = ledger.Ledger(spark, layers.quality, run)

    def table(layer: str, name: str) -> DataFrame:
        return readers.read_layer_table(spark, layer, name)

    def put(df: DataFrame, layer: str, name: str, **how) -> tuple[str, str, str]:
        return layer, name, sinks.write_version(df, layer, name, **how)

    def one(step: str, df, layer: str, name: str, **how) -> bool:
        """A step that writes one table; ``df`` is a frame or makes one."""
        return book.step(step, lambda: [put(df() if callable(df) else df, layer, name, **how)])

    def gate(name: str, make) -> DataFrame:
        """A suite's report as a table; a step only counts as done once its gate is passed."""

        def checked():
            version = put(make(), layers.quality, name)
            sinks.point_to(spark, *version)
            if stop_on_fail:
                quality.gate(table(layers.quality, name))
            return [version]

        book.step(name, checked)
        return table(layers.quality, name)

    # 1. raw load (K1) with validation (V9) and the empty-source guard (V12),
    # one scan of each source's points (``pipeline.checked_points``).
    # The sources are independent, so their jobs are submitted concurrently
    # (as the reference ingests its sources in parallel); Spark interleaves
    # their stages on the free task slots.
    for layer in (layers.raw, layers.staging, layers.marts, layers.quality):
        sinks.ensure_layer(spark, layer)
    if one("seed", inputs.seed, layers.raw, suites.SEED_TABLE) and backup_dir:
        sinks.export_csv_backup(table(layers.raw, suites.SEED_TABLE), f"{backup_dir.rstrip('/')}/{suites.SEED_TABLE}")
    one("seed_report", lambda: seed_report(table(layers.raw, suites.SEED_TABLE)), layers.quality, "seed_report")

    def load(name: str) -> bool:
        # one scan of the points: classified and reduced to cells + rejects,
        # written once; raw table, rejects and the empty-source guard read it
        points, cfg = inputs.sources[name]
        one(f"check {name}", lambda: P.checked_points(points, cfg), layers.raw, f"{name}_checked")
        checked = table(layers.raw, f"{name}_checked")
        empty = P.has_valid_points(checked).isEmpty()
        if name not in inputs.optional:
            rules.require_rows(P.has_valid_points(checked), name)
        counted = f"{name}_rejects_counted"

        def raw_tables():
            return [
                put(P.to_raw_names(P.raw_from_checked(checked, cfg), cfg), layers.raw, name),
                put(P.counted_rejects(checked, points.columns, cfg), layers.raw, counted),
            ]

        ran = book.step(f"load {name}", raw_tables)
        repeated = rules.expand_rejects_sql(f"`{layers.raw}`.`{counted}`", [*points.columns, "errors", "source"])
        sinks.publish_sql_view(spark, layers.raw, f"{name}_rejects", repeated)
        if backup_dir and ran:
            start, end = cfg.window or (0, 1)
            sinks.export_csv_backup(table(layers.raw, name), f"{backup_dir.rstrip('/')}/{sinks.backup_name(name, start, end)}")
        return empty

    with ThreadPoolExecutor(max_workers=max(1, parallel_loads)) as pool:
        empty = dict(zip(inputs.sources, pool.map(load, list(inputs.sources))))

    def load_report():
        parts = [P.load_report(table(layers.raw, f"{n}_checked"), n, cfg) for n, (_, cfg) in inputs.sources.items()]
        return reduce(lambda a, b: a.unionByName(b), parts)

    one("load_report", load_report, layers.quality, "load_report")
    raw = {suites.SEED_TABLE: table(layers.raw, suites.SEED_TABLE)}
    raw |= {n: P.from_raw_names(table(layers.raw, n), cfg) for n, (_, cfg) in inputs.sources.items()}
    # an optional source without points has nothing to check
    checked_raw = {n: df for n, df in raw.items() if not empty.get(n)}

    # 2. raw scan checks
    reports.append(gate("raw_checks", lambda: _run_suite(checked_raw, suites.raw_scan_checks(inputs.dictionary, p), "raw", {})))

    # 3. staging (K4) over the raw tables: written once, read by the fact and by every test
    seed = raw[suites.SEED_TABLE]
    staged = {"stg_country_metadata": lambda: conform.conform_dimension(seed)}
    for name in inputs.named:
        staged[f"stg_{name}"] = lambda name=name: P.stage_named_source(raw[name], seed, inputs.sources[name][1])
    if inputs.two_part:
        weo, fdi = inputs.two_part
        staged[f"stg_{inputs.two_part_name}"] = lambda: P.stage_two_part_source(
            raw[weo], raw[fdi], seed, inputs.sources[weo][1], inputs.sources[fdi][1]
        )
    buckets = stage_buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    for view, make in staged.items():
        keyed = {} if view == "stg_country_metadata" else {"bucket_by": (buckets, spine.KEYS)}
        one(view, make, layers.staging, view, **keyed)
    staged = {view: table(layers.staging, view) for view in staged}
    for view, df in staged.items():
        sinks.publish_view(df, view)
    stg_dim = staged["stg_country_metadata"]

    # 4. marts (K5)
    columns = [i.mart for i in inputs.dictionary]
    one("dim", lambda: conform.dim_country(stg_dim), layers.marts, suites.DIM_TABLE)
    dim_t = table(layers.marts, suites.DIM_TABLE)
    stage_frames = [df for v, df in staged.items() if v != "stg_country_metadata"]
    one("fact", lambda: P.build_panel(stage_frames, dim_t, columns, co_located=True), layers.marts, suites.FACT_TABLE, partition_by=list(fact_partition_by or []))
    fact_t = table(layers.marts, suites.FACT_TABLE).select("country_code", "country_name", "year", *columns)
    mart_files = max(1, min(buckets, readers.SORTED_FILES))
    one("mart", lambda: marts.peak_and_last_year(dim_t, fact_t, columns), layers.marts, suites.MART_TABLE, cluster_by=(mart_files, ["country_code"]))
    mart_t = table(layers.marts, suites.MART_TABLE)
    mart_frames = {suites.DIM_TABLE: dim_t, suites.FACT_TABLE: fact_t, suites.MART_TABLE: mart_t}

    # 5. model tests on every layer
    def model_tests():
        tests = _run_suite(checked_raw, suites.source_tests(p), "raw", {})
        tests = tests.unionByName(_run_suite(staged, suites.staging_tests(p), "staging", staged))
        return tests.unionByName(_run_suite(mart_frames, suites.mart_tests(p), "marts", mart_frames))

    reports.append(gate("model_tests", model_tests))

    # 6. mart scan checks
    reports.append(gate("mart_checks", lambda: _run_suite(mart_frames, suites.mart_scan_checks(p), "marts", {})))
    book.finish()
    return reduce(lambda a, b: a.unionByName(b), reports)
