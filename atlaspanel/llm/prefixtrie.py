"""A trie of conversation prefixes in minimal-perfect-hash node tables.

A conversation is rebuilt from the first turns of its host and its own later
ones; every prefix of it is a node, named by a 127-bit digest. A shard takes
whole conversations. It enumerates its distinct digests, gives each a slot by a
minimal perfect hash (the digest kept in the slot is compared at every lookup),
scatters counts into flat arrays by slot and keeps every node's parent slot.

Counts of members, and of those that end there, add up over shards by digest;
so does the smallest member, and a node belongs to the shard that holds it. A
shard then takes the totals of its nodes, lets each node that it owns count
itself (as child, as leaf, with the tokens it saves), and adds the arrays up
into the parent slots from the deepest level to the root. The shards' partial
subtree sums add up by digest to those of the whole trie: every node counts in
one shard, and that shard holds all its ancestors.

A conversation longer than a shard is cut: its later stretches are shards of
their own, hung below a copy of the node before them, and their totals are
carried to that node in the shard before. Nothing but a stretch and one batch is
held in memory. The rows that are shuffled carry digests and counts, no texts.

Defined results: null role or text counts as empty; rows without a conversation
id belong to no conversation; turns are ordered by number (null first), equal
numbers by the digest of their role and text; repeated rows are turns each; ids
may be negative (the host of c is c - c % 20 with the remainder's sign of c);
empty and very long texts count like others; further columns are not read; an
empty table has no node.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlaspanel.llm.common import stored

BLOCK = 20
HEADS = 4
#: Turns of a shard.
SHARD = 100_000
#: Ids that are joined to one text before they are hashed.
ID_RUN = 20_000

# A prefix digest is a polynomial in the turns' digests modulo a prime.
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big")
ROOT = (1).to_bytes(16, "big")

NODES = "kind int, shard long, digest binary, parent binary, depth long, words long, members long, ends long, conv_id long"
PARTIAL = "digest binary, conv_id long, depth long, members long, ends long, parent_conv_id long, children long, leaves long, saved long"
#: Kinds of NODES rows: a node of a shard, a copy of the node that a stretch hangs below, a conversation's last node.
NODE, COPY, END = 0, 1, 2


def turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """(host, own, conv_id, turn, digest, words) of every turn; the text ends here."""
    conv, role, text = F.col(conv_col).cast("long"), F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    host = conv - conv % block
    return rows.filter(conv.isNotNull()).select(
        host.alias("host"), (conv != host).alias("own"), conv.alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def extended(prefix: int, turn: bytes) -> int:
    """The digest of a sequence with one more turn."""
    return (prefix * BASE + (int.from_bytes(turn, "big") >> 1) + 1) % PRIME


# ---- the node table of a shard -----------------------------------------------


def halves(digests: list[bytes]) -> np.ndarray:
    """Digests as rows of two unsigned 64-bit numbers."""
    return np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64)


def _mixed(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys[:, 0] ^ (keys[:, 1] + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ x >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


class NodeTable:
    """A minimal perfect hash of distinct digests: levels of bits, each for the keys that met another before.

    A key's slot is the number of bits set before its own over all levels, so n
    keys fill the slots 0 to n-1. ``held`` keeps the digest of every slot.
    """

    def __init__(self, keys: np.ndarray):
        self.bits: list[np.ndarray] = []
        left = keys
        while len(left):
            if len(self.bits) > 200:
                raise ValueError("equal digests have no slots of their own")
            at = _mixed(left, len(self.bits), len(left))
            alone = np.bincount(at, minlength=len(left)) == 1
            self.bits.append(alone)
            left = left[~alone[at]]
        self.before = np.cumsum([0, *(int(b.sum()) for b in self.bits)])
        self.ranks = [np.cumsum(b) - 1 for b in self.bits]
        self.held = np.zeros_like(keys)
        self.held[self._slots(keys)] = keys
        if (self.slots(keys) < 0).any():
            raise ValueError("two digests have one slot")

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            at = _mixed(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.before[level] + self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that is not held (its slot holds another digest, or none is left)."""
        out = self._slots(keys)
        found = out >= 0
        out[found] = np.where((self.held[out[found]] == keys[found]).all(1), out[found], -1)
        return out


def summed_up(parents: np.ndarray, depth: np.ndarray, *values: np.ndarray) -> None:
    """Add each array up into the parent slots, from the deepest level to the root."""
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        level = level[parents[level] >= 0]
        for v in values:
            np.add.at(v, parents[level], v[level])


# ---- first pass: conversations to shards of nodes ------------------------------


class Shard:
    """The prefixes of the conversations met so far, one entry per conversation and depth."""

    def __init__(self, number: int, below: tuple[int, int] | None = None):
        self.number, self.below = number, below  # below: (digest, depth) of the node that a stretch hangs below
        self.digest, self.parent, self.depth, self.words, self.conv, self.ends = [], [], [], [], [], []

    def add(self, conv: int, digest: int, parent: int, depth: int, words: int) -> None:
        self.digest.append(digest)
        self.parent.append(parent)
        self.depth.append(depth)
        self.words.append(words)
        self.conv.append(conv)

    def rows(self):
        """The shard's NODES rows: counts scattered into arrays by slot, and one row per conversation that ended."""
        digests = [d.to_bytes(16, "big") for d in self.digest]
        distinct = list(dict.fromkeys(digests))
        if distinct:
            table = NodeTable(halves(distinct))
            slot = table.slots(halves(digests))
            n = len(distinct)
            conv = np.array(self.conv, np.int64)
            members, ends, least = np.bincount(slot, minlength=n), np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(least, slot, conv)
            if self.ends:
                np.add.at(ends, table.slots(halves([d for _, d in self.ends])), 1)
            depth, words, one = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            depth[slot], words[slot], one[slot] = self.depth, self.words, np.arange(len(slot))
            name, parent = [digests[i] for i in one], [self.parent[i].to_bytes(16, "big") if self.depth[i] else None for i in one]
            yield self.batch(NODE, name, parent, depth, words, members, ends, least)
        if self.below:
            zero = np.zeros(1, np.int64)
            yield self.batch(COPY, [self.below[0].to_bytes(16, "big")], [None], zero + self.below[1], zero, zero, zero, zero + self.conv[0])
        if self.ends:
            zero = np.zeros(len(self.ends), np.int64)
            yield self.batch(END, [d for _, d in self.ends], [None] * len(zero), zero, zero, zero, zero, np.array([c for c, _ in self.ends], np.int64))

    def batch(self, kind, digest, parent, depth, words, members, ends, conv) -> pa.RecordBatch:
        n = len(digest)
        columns = [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, self.number)), pa.array(digest, pa.binary()), pa.array(parent, pa.binary()),
                   *(pa.array(np.asarray(a, np.int64)) for a in (depth, words, members, ends, conv))]
        return pa.RecordBatch.from_arrays(columns, ["kind", "shard", "digest", "parent", "depth", "words", "members", "ends", "conv_id"])


def _shards(size: int, heads: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        shard = Shard(part << 32)
        host, head = None, []  # the host's first turns
        conv, given, seen, skip, depth, at = None, 0, 0, 0, 0, 0

        def following(below=None) -> Shard:
            return Shard(shard.number + 1, below)

        def ended() -> None:
            shard.ends.append((conv, at.to_bytes(16, "big")))

        for b in batches:
            for h, own, c, turn, words in zip(*(b.column(i).to_pylist() for i in ("host", "own", "conv_id", "digest", "words"))):
                if c != conv:
                    if conv is not None:
                        ended()
                        if len(shard.digest) >= size or shard.below:
                            yield from shard.rows()
                            shard = following()
                    if h != host:
                        host, head = h, []
                    conv, seen, depth, at = c, 0, 0, 1
                    skip = zlib.crc32(str(c).encode()) % heads if own else 0
                    shard.add(c, at, 0, 0, 0)
                    for t, w in head[:skip]:
                        before, at, depth = at, extended(at, t), depth + 1
                        shard.add(c, at, before, depth, w)
                if not own and len(head) < heads - 1:
                    head.append((turn, words))
                if seen >= skip:
                    if len(shard.digest) >= 2 * size:  # one conversation longer than a shard
                        yield from shard.rows()
                        shard = following((at, depth))
                    before, at, depth = at, extended(at, turn), depth + 1
                    shard.add(c, at, before, depth, words)
                seen += 1
        if conv is not None:
            ended()
            yield from shard.rows()

    return run


# ---- second pass: subtree sums ---------------------------------------------------


def _subtrees(table: pa.Table) -> pa.Table:
    """A shard's partial sums from its nodes with the totals of the whole trie."""
    col = {n: table[n].combine_chunks() for n in table.column_names}
    number = lambda n: col[n].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    digests = col["digest"].to_pylist()
    # a copy stands apart from a node of the same digest: one only hangs what follows below it
    real = number("kind") == NODE
    nodes = NodeTable(halves([d for d, r in zip(digests, real) if r]))
    n, total = len(nodes.held), len(digests)
    slot = np.full(total, -1, np.int64)
    keys = halves(digests)
    slot[real] = nodes.slots(keys[real])
    slot[~real] = n + np.arange(total - n)

    def placed(values: np.ndarray) -> np.ndarray:
        out = np.zeros(total, np.int64)
        out[slot] = values
        return out

    parent_digests = [p or b"\0" * 16 for p in col["parent"].to_pylist()]
    up = nodes.slots(halves(parent_digests))
    depth_row = number("depth")
    if total > n:  # parents that are not among the nodes are the copied node
        copied = {digests[i]: slot[i] for i in np.flatnonzero(~real)}
        up = np.array([copied.get(p, -1) if u < 0 else u for u, p in zip(up.tolist(), parent_digests)], np.int64)
    up[depth_row == 0] = -1
    parents, depth = np.full(total, -1, np.int64), placed(depth_row)
    parents[slot] = np.where(real, up, -1)
    members, ends, conv = placed(number("all_members")), placed(number("all_ends")), placed(number("all_conv_id"))
    mine = placed((number("owner") == number("shard")) & real) > 0
    leaves = np.where(mine & (members == ends), 1, 0) + placed(number("more_leaves"))
    saved = np.where(mine, (members - 1) * placed(number("words")), 0) + placed(number("more_saved"))
    children = np.zeros(total, np.int64)
    counted = mine & (parents >= 0)
    np.add.at(children, parents[counted], 1)
    summed_up(parents, depth, leaves, saved)
    # what a copy has received is carried to the shard before by its own rows
    leaves[n:], saved[n:] = 0, 0
    row = {"conv_id": conv, "depth": depth, "members": members, "ends": ends, "children": children, "leaves": leaves, "saved": saved}
    above = pa.array(conv[parents], pa.int64(), mask=~counted)
    out = {"digest": col["digest"], **{k: pa.array(v[slot]) for k, v in row.items()}, "parent_conv_id": above.take(pa.array(slot))}
    return pa.table([out[c.split()[0]] for c in PARTIAL.split(", ")], names=[c.split()[0] for c in PARTIAL.split(", ")])


# ---- the ids that end at a node ----------------------------------------------------


def _id_runs(batches):
    """Sorted (digest, conv_id) to runs of ids of one digest, joined by commas."""
    digest, ids = None, []

    def row():
        return pa.RecordBatch.from_arrays([pa.array([digest], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["digest", "first", "text"])

    for b in batches:
        for d, c in zip(b.column("digest").to_pylist(), b.column("conv_id").to_pylist()):
            if d != digest or len(ids) == ID_RUN:
                if ids:
                    yield row()
                digest, ids = d, []
            ids.append(c)
    if ids:
        yield row()


def _hashed(batches):
    """Sorted runs to the SHA-256 of all ids of a digest, a run at a time."""
    digest, state, done = None, None, []

    def flush(some):
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in some], pa.binary()), pa.array([h for _, h in some], pa.string())], ["digest", "ends_sha256"])

    for b in batches:
        for d, text in zip(b.column("digest").to_pylist(), b.column("text").to_pylist()):
            if d != digest:
                if state is not None:
                    done.append((digest, state.hexdigest()))
                digest, state = d, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield flush(done)
            done = []
    if state is not None:
        yield flush([*done, (digest, state.hexdigest())])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of the ids that end at each node, ascending, joined by commas.

    A node's ids are joined in runs by the tasks of a range sort, which splits a
    node of very many ids; only the runs meet in the task that hashes them.
    """
    parts = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    runs = ends.repartitionByRange(parts, "digest", "conv_id").sortWithinPartitions("digest", "conv_id").mapInArrow(_id_runs, "digest binary, first long, text string")
    return runs.repartition(parts, "digest").sortWithinPartitions("digest", "first").mapInArrow(_hashed, "digest binary, ends_sha256 string")


def prefix_trie(
    spark: SparkSession, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    block: int = BLOCK, heads: int = HEADS, shard: int = SHARD,
) -> DataFrame:
    """(digest, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["host", "own", "conv_id", F.col("turn").asc_nulls_first(), "digest"]
    dealt = turns(rows, conv_col, turn_col, role_col, text_col, block).repartitionByRange(parts, "host").sortWithinPartitions(*order)
    found = stored(dealt.mapInArrow(_shards(shard, heads), NODES), "trie-nodes")
    local = found.filter(F.col("kind") != END)
    whole = stored(
        found.filter(F.col("kind") == NODE).groupBy("digest").agg(
            F.sum("members").alias("all_members"), F.sum("ends").alias("all_ends"), F.min("conv_id").alias("all_conv_id"),
            F.min_by("shard", "conv_id").alias("owner"), F.min("words").alias("all_words"),
        ),
        "trie-totals",
    )
    # what a stretch's nodes count, carried to the node that it hangs below, with all stretches after it
    copies = found.filter(F.col("kind") == COPY).select("shard", F.col("digest").alias("below"), "conv_id")
    counted = whole.join(F.broadcast(copies) if copies.count() <= 10_000 else copies, F.col("owner") == F.col("shard"))
    per_stretch = counted.groupBy("shard").agg(
        F.sum(F.when(F.col("all_members") == F.col("all_ends"), 1).otherwise(0)).alias("l"),
        F.sum((F.col("all_members") - 1) * F.col("all_words")).alias("s"),
    )
    later = Window.partitionBy("conv_id").orderBy(F.desc("shard")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = copies.join(per_stretch, "shard", "left").select(
        (F.col("shard") - 1).alias("to_shard"), F.col("below").alias("to_digest"),
        F.sum(F.coalesce("l", F.lit(0))).over(later).alias("more_leaves"), F.sum(F.coalesce("s", F.lit(0))).over(later).alias("more_saved"),
    )
    asked = local.join(whole.drop("all_words"), "digest").join(
        carried, (F.col("shard") == F.col("to_shard")) & (F.col("digest") == F.col("to_digest")) & (F.col("kind") == NODE), "left"
    ).select("shard", "kind", "digest", "parent", "depth", "words", "all_members", "all_ends", "all_conv_id", "owner", "more_leaves", "more_saved")
    partial = asked.groupBy("shard").applyInArrow(_subtrees, PARTIAL)
    nodes = partial.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.max("parent_conv_id").alias("parent_conv_id"), F.max("members").alias("n_convs"),
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    hashes = ends_hashes(found.filter(F.col("kind") == END).select("digest", "conv_id"))
    return nodes.join(hashes, "digest", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
