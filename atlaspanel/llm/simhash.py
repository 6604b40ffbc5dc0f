"""SimHash near-duplicates through BK-trees.

A text's fingerprint takes, bit by bit, the majority over the XXH64 hashes of
its word shingles. Fingerprints within ``radius`` differing bits are linked;
groups are the connected components of links.

Of ``m`` blocks of a fingerprint, two within ``r`` bits agree on at least
``m - r``, so each value of each choice of ``m - r`` blocks is a shard: its
distinct fingerprints form a BK-tree, whose children are keyed by their integer
Hamming distance to the parent, and a search follows only the edges within the
radius of its own distance. More blocks make more shards and smaller ones; their
number follows from the counted sizes of the shards (``shards``), so that the
work stays near linear where the values of four 16-bit blocks are all held by
many. A shard that still has more than ``SHARD`` fingerprints is cut into parts;
each pair of parts is a task of its own, in which one part's tree is sent to the
other part's queries. A task returns a forest (each fingerprint with the root it
is joined to), so the number of links stays linear however large a group is.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; equal texts share a fingerprint; a null id is never a group's name
unless all its ids are null; repeated rows each get their row; an empty table
gives an empty result; very long texts are read whole.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import lower_words, stored, texts

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of a tree.
SHARD = 1_000
#: Comparisons in a tree that cost as much as sending a fingerprint to one more shard.
COMPARED = 10


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' hashes, as a signed 64-bit number."""
    w = lower_words(text)
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(w) < shingle:
        h = [digest(b" ".join(w), SEED)]
    else:
        h = [digest(b" ".join(s), SEED) for s in zip(*(w[k:] for k in range(shingle)))]
    bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
    major = bits.sum(axis=0, dtype=np.int64) * 2 > len(h)
    return int(np.packbits(major, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for b in batches:
            prints = [fingerprint(t, shingle) for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("__row"), b.column("doc_id"), pa.array(prints, pa.int64())], ["__row", "doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE, row_col: str | None = None) -> DataFrame:
    """(row, doc_id, fp) of every document, stored."""
    rows = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("__row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    return stored(rows.mapInArrow(_fingerprints(shingle), "__row long, doc_id long, fp long"), "simhash-fingerprints")


class BKTree:
    """Burkhard-Keller tree over 64-bit numbers under the Hamming distance."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    def add(self, x: int) -> None:
        if self.root is None:
            self.root = (x, {})
            return
        at = self.root
        while True:
            d = (x ^ at[0]).bit_count()
            child = at[1].get(d)
            if child is None:
                if d:
                    at[1][d] = (x, {})
                return
            at = child

    def within(self, x: int, radius: int) -> list[int]:
        out, todo = [], [self.root] if self.root else []
        while todo:
            value, children = todo.pop()
            d = (x ^ value).bit_count()
            if d <= radius:
                out.append(value)
            if children:
                low, high = d - radius, d + radius
                todo += [c for k, c in children.items() if low <= k <= high]
        return out


def forest(members: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """(fingerprint, root) of all links among ``members``, or of ``queries`` to ``members`` where there are queries."""
    parent: dict[int, int] = {}

    def find(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def join(x, near):
        for y in near:
            a, b = find(x), find(y)
            if a != b:
                a, b = min(a, b), max(a, b)
                parent[b] = a

    tree = BKTree()
    for x in members:
        if not queries:
            join(x, tree.within(x, radius))
        tree.add(x)
    for x in queries:
        join(x, tree.within(x, radius))
    return [(x, find(x)) for x in list(parent) if find(x) != x]


def _search(radius: int):
    """Rows come sorted by (shard, part pair), a pair's tree part marked; one pair is held at a time."""
    mask = (1 << 64) - 1

    def run(batches):
        at, members, queries = None, [], []

        def done():
            pairs = forest(members, queries, radius) if at is not None and len(members) + len(queries) > 1 and (at[1] == at[2] or queries) else []
            return pairs

        out: list[tuple[int, int]] = []
        for b in batches:
            for shard, low, high, part, fp in zip(*(b.column(c).to_pylist() for c in ("shard", "low", "high", "part", "fp"))):
                key = (shard, low, high)
                if key != at:
                    out += done()
                    at, members, queries = key, [], []
                (members if part == high else queries).append(fp & mask)
            if len(out) > 50_000:
                yield _edges(out)
                out = []
        out += done()
        yield _edges(out)

    return run


def _edges(pairs):
    signed = [(a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b) for a, b in pairs]
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in signed], pa.int64()), pa.array([p[1] for p in signed], pa.int64())], ["u", "v"])


def _masks(radius: int, blocks: int) -> list[int]:
    """Every choice of ``blocks - radius`` of the blocks, as the bits it covers."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    bits = [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:])]
    return [sum(choice) for choice in combinations(bits, blocks - radius)]


def _sharded(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(fp, shard): a fingerprint once per choice of blocks. Shards whose names collide are one; distances decide there as anywhere."""
    signed = (m - (1 << 64) if m >> 63 else m for m in _masks(radius, blocks))
    names = [F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)]
    return prints.select("fp", F.explode(F.array(*names)).alias("shard"))


def shards(prints: DataFrame, radius: int) -> int:
    """The number of blocks that costs least, by the counted sizes of the shards it makes.

    Sending costs one per row, searching the pairs of a shard over ``COMPARED``;
    more blocks are tried while they cost less, and as long as sending alone may.
    """
    total = prints.count()
    best, least = radius + 1, None
    for blocks in range(radius + 1, 65):
        if least is not None and comb(blocks, radius) * total >= least:
            break
        sizes = _sharded(prints, radius, blocks).groupBy("shard").agg(F.count("*").cast("double").alias("n"))
        sent, pairs = sizes.agg(F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()
        cost = (sent or 0) + (pairs or 0) / COMPARED
        if least is not None and cost >= least:
            break
        best, least = blocks, cost
    return best


def links(prints: DataFrame, radius: int = RADIUS, shard_size: int = SHARD, blocks: int | None = None) -> DataFrame:
    """Forest edges (u, v) over the distinct fingerprints ``prints`` (fp); ``blocks`` as counted (``shards``) unless given."""
    spark = prints.sparkSession
    sharded = _sharded(prints, radius, blocks or shards(prints, radius))
    large = sharded.groupBy("shard").count().filter(F.col("count") > shard_size).select("shard", F.ceil(F.col("count") / shard_size).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    pairs = (
        sharded.join(large, "shard", "left")
        .select("fp", "shard", own.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
        .select("fp", "shard", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    )
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = pairs.repartition(width, "shard", "low", "high").sortWithinPartitions("shard", "low", "high")
    return dealt.mapInArrow(_search(radius), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), root the smallest of its component.

    Alternating large-star and small-star steps: every node hands its smallest
    neighbour to the others, until only stars are left. A step is an aggregate
    and a join, each stored, so no node's neighbours are gathered in one place.
    """
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")

    def prepared(e, name):
        return stored(e.filter("u <> v").select(high, low).distinct(), name)

    def mark(e):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    e = prepared(edges, "simhash-edges")
    state = mark(e)
    while state[0]:
        both = e.union(e.select(F.col("v"), F.col("u")))
        # large-star: the larger neighbours of u go to the smallest of u and its neighbours
        best = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        e = prepared(both.filter("v > u").join(best, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "simhash-large")
        # small-star: u and its smaller neighbours go to the smallest of them
        best = e.groupBy("u").agg(F.min("v").alias("m"))
        e = prepared(e.join(best, "u").select("v", "m").union(best).toDF("u", "v"), "simhash-small")
        now = mark(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _groups(rows: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root, first) per distinct fingerprint and (root, first) per group; ``first``: the row that stands for it."""
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row")
    prints = stored(rows.groupBy("fp").agg(F.min(first).alias("first")), "simhash-prints")
    stars = components(links(prints.select("fp"), radius))
    rooted = stored(
        prints.join(stars, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "simhash-rooted"
    )
    return rooted, rooted.groupBy("root").agg(F.min("first").alias("first"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    rows = fingerprints(docs, id_col, text_col, shingle)
    rooted, groups = _groups(rows, radius)
    named = rooted.select("fp", "root").join(groups, "root").select("fp", F.col("first.doc_id").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE, radius: int = RADIUS, row_col: str | None = None) -> DataFrame:
    """(row) of the one document that stays of each group: the first by id, then by row."""
    _, groups = _groups(fingerprints(docs, id_col, text_col, shingle, row_col), radius)
    return groups.select(F.col("first.__row").alias("__row"))
