"""Mixing sources to target weights by entropy balancing.

Every document gets a rate exp(sum of its margins' multipliers). Among all
rates whose tokens meet the targets these stay nearest, in relative entropy
per token, to taking every document once. The multipliers solve the convex
dual by Newton steps: each step is one distributed aggregate over the cells
(documents with equal margins, their sizes summed). Rates are then rounded
into whole copies.

Defined results: a null text has size 0, a null source is a source of its own
and comes last; a source of size 0 gets target 0; repeated rows are documents
of their own, rows of one id and size beyond ``DOCS_PER_BUCKET`` are rounded in
several groups; equal sizes are told apart by a hash of the id; reruns give the
same copies; very long texts are counted whole; columns named like the
operator's own pass through (``keep_rows``) or are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import fresh, ranked, stored
from atlaspanel.operators.joins import bounded_broadcast

#: Documents of a source rounded together (one group of one task).
DOCS_PER_BUCKET = 5_000


def water_level(sources: DataFrame, total: float, cap: float) -> float:
    """Level t with sum of min(weight * t, cap * size) = total: the excess of capped sources goes to the rest."""
    level = -1.0
    while True:
        over = F.lit(level >= 0) & (F.col("weight") * level >= F.col("size") * cap)
        r = sources.agg(
            F.sum(F.when(over, F.col("size") * cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight").cast("double"))).alias("weight"),
        ).first()
        if not r["weight"]:
            return level
        up = (total - r["full"]) / r["weight"]
        if up <= level:
            return level
        level = up


def source_targets(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple = (5, 2, 1)) -> DataFrame:
    """(source, size, weight, target) of ``docs`` (source, size); sources by code point, null last."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    order = [F.col("source").isNull(), F.col("source")]
    sources = stored(
        ranked(sizes, order, "mix-sources").withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))),
        "mix-weights",
    )
    total = sources.agg(F.sum("size")).first()[0] or 0
    level = water_level(sources, share * total, cap) if total else 0.0
    target = F.least(F.col("weight") * F.lit(float(level)), F.col("size") * F.lit(cap))
    return sources.select("source", F.col("size").cast("long"), "weight", target.cast("double").alias("target"))


def entropy_balance(cells: DataFrame, margins: dict[str, DataFrame], tolerance: float = 1e-10, max_steps: int = 60) -> dict[str, DataFrame]:
    """Multipliers of the dual, one table (key, lambda) per margin.

    ``cells``: ``size`` and one column per margin; ``margins``: column ->
    (key, target) with targets above 0. Newton with the margin's own curvature:
    for a margin the Hessian of the dual is diagonal, so a step of all margins
    is one aggregate per margin. A step is held to 1 in the exponent, which
    keeps the iteration monotone from any start.
    """
    # two spellings of a key cannot meet: null has its own
    spell = lambda c: F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string")))
    cells = cells.select("size", *[spell(c).alias(c) for c in margins])
    duals = {
        c: stored(m.select(spell("key").alias("key"), F.col("target").cast("double").alias("target"), F.lit(0.0).alias("lambda")), f"mix-dual-{c}")
        for c, m in margins.items()
    }
    for _ in range(max_steps):
        worst = 0.0
        for c in margins:
            mass = F.col("size").cast("double")
            tilted = cells
            for other in margins:
                tilted = tilted.join(duals[other].select(F.col("key").alias(other), F.col("lambda").alias(f"l_{other}")), other)
                mass = mass * F.exp(F.col(f"l_{other}"))
            now = tilted.groupBy(F.col(c).alias("key")).agg(F.sum(mass).alias("mass"))
            step = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (F.col("target") - F.col("mass")) / F.col("mass")))
            gap = F.abs(F.col("mass") / F.col("target") - 1)
            moved = stored(
                duals[c].join(now, "key", "left").select("key", "target", (F.col("lambda") + F.coalesce(step, F.lit(0.0))).alias("lambda"), gap.alias("gap")),
                f"mix-dual-{c}",
            )
            worst = max(worst, moved.agg(F.max("gap")).first()[0] or 0.0)
            duals[c] = moved.drop("gap")
        if worst <= tolerance:
            break
    return {c: d.select(F.when(F.col("key") == "n", None).otherwise(F.expr("substring(key, 2)")).alias("key"), "lambda") for c, d in duals.items()}


def _copies(table: pa.Table) -> pa.Table:
    """Whole copies of one group: largest first, each the copies nearest to what the rates still owe."""
    table = table.sort_by([("size", "descending"), ("__h", "ascending"), ("__id", "ascending")])
    owed, out = 0.0, []
    for rate, size in zip(table["rate"].to_pylist(), table["size"].to_pylist()):
        n = math.floor(rate + 1e-9)
        owed += rate * size
        if rate - n > 1e-9 and owed - n * size > size / 2:
            n += 1
        owed -= n * size
        out.append(n)
    return table.select(["__id", "doc_id", "size", "source_size", "target", "rate"]).append_column("copies", pa.array(out, pa.int32()))


def mix_documents(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    share: float = 1.5, cap: float = 2.0, weights: tuple = (5, 2, 1), keep_rows: bool = False,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, rate, copies, taken.

    ``keep_rows``: instead ``docs`` itself, each row as often as the mix takes it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    row, held_size, copy = fresh(docs, "__id", "__size", "__copy")
    keys = docs.select(F.monotonically_increasing_id().alias("__id"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    rows = stored(docs.withColumns({row: F.monotonically_increasing_id(), held_size: size}) if keep_rows else keys, "mix-rows")
    small = rows.select(F.col(row).alias("__id"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(held_size).alias("size")) if keep_rows else rows
    targets = stored(source_targets(small, share, cap, weights), "mix-targets")
    cells = small.groupBy("source").agg(F.sum("size").alias("size"))
    dual = entropy_balance(cells, {"source": targets.filter("target > 0").select(F.col("source").alias("key"), "target")})["source"]
    counts = small.groupBy("source").agg(F.count("*").alias("n"))
    by_source = stored(
        targets.alias("t")
        .join(counts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")))
        .join(dual.alias("d"), F.col("t.source").eqNullSafe(F.col("d.key")), "left")
        .select(
            F.col("t.source").alias("source"), F.col("t.size").alias("source_size"), "target",
            F.least(F.round(F.coalesce(F.exp("lambda"), F.lit(0.0)), 9), F.lit(cap)).alias("rate"),
            F.greatest(F.ceil(F.col("n") / DOCS_PER_BUCKET), F.lit(1)).alias("buckets"),
        ),
        "mix-rates",
    )
    rated = (
        small.alias("r")
        .join(by_source.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        .select("__id", "doc_id", "size", F.col("s.source").alias("source"), "source_size", "target", "rate", "buckets")
        .withColumn("__h", F.xxhash64("doc_id", "size"))
    )
    # rows of one id and size beyond a bucket's share are told apart by their number and go to several buckets
    alike = ["source", "doc_id", "size"]
    many = small.groupBy(*alike).agg(F.count("*").alias("n")).filter(F.col("n") > DOCS_PER_BUCKET)
    many = stored(many.select(*[F.col(c).alias(f"__many_{c}") for c in alike], F.ceil(F.col("n") / DOCS_PER_BUCKET).alias("__salts")), "mix-alike")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__many_{c}")) for c in alike])
    salt = F.coalesce(F.pmod(F.col("__id"), F.col("__salts")), F.lit(0))
    rated = rated.join(bounded_broadcast(many), same, "left").withColumn("bucket", F.pmod(F.pmod("__h", F.col("buckets")) + salt, F.col("buckets")))
    rated = rated.drop("__salts", *[f"__many_{c}" for c in alike])
    schema = "__id long, doc_id long, size long, source_size long, target double, rate double, copies int"
    mixed = rated.groupBy("source", "bucket").applyInArrow(_copies, schema)
    if not keep_rows:
        return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")
    taken = mixed.filter("copies > 0").select(F.col("__id").alias(row), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(copy))
    return rows.join(taken, row).select(*docs.columns)
