"""Codes of vectors: k-means codebooks per part, with norm-of-sum bounds.

A vector is cut into equal parts and every part is coded by the nearest entry of
its position's codebook. Rounds alternate: assign every part, then move every
entry to the mean of its parts. All codebooks so far are kept. Per part and
group of entries a vector carries a lower bound of its distance to the group's
entries other than its own, stamped with the round in which it was found. In a
later round the bound falls by the largest true net displacement of the group's
entries since that round (the norm of the sum of their moves, never more than
the sum of the norms). A group whose bound exceeds the distance to the own entry
cannot win and is skipped; the others are scanned exactly, which gives their
bound anew. All distances are whole numbers; a skip needs a margin above any
rounding, so codes and ties are those of a full scan.

Spark keeps vectors, codes and bounds in one table per round. The same pass adds
up its parts by entry, so only sums of tasks are shuffled; the driver holds the
codebooks (entries x components per round, a bound set by the parameters).

Defined results: vectors that are null or hold a null or non-finite component
take no part; other lengths than the longest, or than a multiple of the parts,
are filled up with zeros (an empty vector is all zeros); rows without an id are
coded but come last when the first codebook is chosen, repeated ids are ordered
by their vectors; repeated rows count as often as they occur; null labels share
a label; fewer rows than entries give fewer entries; an empty table gives an
empty result; a component of 2^26 or more after scaling is an error, since
distances must stay exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import stored
from atlaspanel.operators.joins import bounded_broadcast

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Entries that share a bound.
GROUP = 8
#: Vectors that are compared at once.
STEP = 2_000
LARGEST = 1 << 26
#: Above any rounding of a square root of a distance or of a displacement.
MARGIN = 1e-3

STATE = "id long, label string, v array<int>, code binary, low array<float>, stamp binary, part int, entry int, place int, total long"
CODED = "id long, label string, code binary, error long"


def kept_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label as text, v array<double>) of the vectors that take part."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.cast("array<double>").alias("v")
    )


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(vectors * scale)
    if out.size and np.abs(out).max() >= LARGEST:
        raise ValueError("a component is too large for exact distances")
    return out.astype(np.int64)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """List rows as a matrix, filled up with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), flat.dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows (n, d) to entries (k, d), exact."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += np.square(x[:, j, None] - entries[:, j])
    return out


def _down(d2: np.ndarray) -> np.ndarray:
    """Lower bounds of the roots, as float32."""
    return np.nextafter(np.sqrt(d2.astype(np.float64)).astype(np.float32), np.float32(-np.inf))


class Codebooks:
    """The codebooks of all rounds: ``history[round][part, entry, component]``."""

    def __init__(self, history: list[np.ndarray], group: int = GROUP):
        self.history, self.now = history, len(history) - 1
        self.parts, self.entries, self.size = history[0].shape
        self.groups = [slice(a, min(a + group, self.entries)) for a in range(0, self.entries, group)]
        # net displacement since each round, the largest of each group
        net = np.stack([np.sqrt(np.square(history[-1] - h).sum(2).astype(np.float64)) for h in history])
        self.moved = np.stack([net[:, :, g].max(2) for g in self.groups], 2)  # (round, part, group)
        self.group_of = np.arange(self.entries) // group
        self.scanned = self.possible = 0

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code, bounds, stamps, squared distance) of vectors (n, part, component) by a full scan."""
        n = len(x)
        code, low = np.zeros((n, self.parts), np.int64), np.zeros((n, self.parts, len(self.groups)), np.float32)
        error = np.zeros((n, self.parts), np.int64)
        for p in range(self.parts):
            d = distances(x[:, p], self.history[-1][p])
            code[:, p] = d.argmin(1)
            error[:, p] = d.min(1)
            d[np.arange(n), code[:, p]] = np.iinfo(np.int64).max
            for k, g in enumerate(self.groups):
                low[:, p, k] = _down(d[:, g].min(1))
        return code, low, np.full(low.shape, self.now, np.uint8), error

    def again(self, x: np.ndarray, code: np.ndarray, low: np.ndarray, stamp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same from the last round's code, bounds and stamps."""
        n, most = len(x), np.iinfo(np.int64).max
        code, low, stamp, error = code.copy(), low.copy(), stamp.copy(), np.zeros(code.shape, np.int64)
        rows = np.arange(n)
        for p in range(self.parts):
            book, old = self.history[-1][p], code[:, p]
            own = np.square(x[:, p] - book[old]).sum(1)
            reach = np.sqrt(own.astype(np.float64))
            groups = np.arange(len(self.groups))
            bound = low[:, p].astype(np.float64) - self.moved[stamp[:, p], p, groups]
            scan = bound <= reach[:, None] + MARGIN
            self.scanned += int(scan.sum())
            self.possible += scan.size
            best, nearest, seen = own.copy(), old.copy(), {}
            for k in np.flatnonzero(scan.any(0)):
                at = np.flatnonzero(scan[:, k])
                d = distances(x[at, p], book[self.groups[k]])
                first = d.argmin(1)
                least, entry = d[np.arange(len(at)), first], first + self.groups[k].start
                wins = (least < best[at]) | (least == best[at]) & (entry < nearest[at])
                best[at[wins]], nearest[at[wins]] = least[wins], entry[wins]
                seen[k] = at, d
            for k, (at, d) in seen.items():  # the bounds leave out the own entry
                mine = np.flatnonzero(self.group_of[nearest[at]] == k)
                d[mine, nearest[at[mine]] - self.groups[k].start] = most
                low[at, p, k], stamp[at, p, k] = _down(d.min(1)), self.now
            # an entry that is no longer the own one counts in its group again, scanned or not
            left = rows[(nearest != old) & ~scan[rows, self.group_of[old]]]
            low[left, p, self.group_of[old[left]]] = _down(own[left])
            stamp[left, p, self.group_of[old[left]]] = self.now
            code[:, p], error[:, p] = nearest, best
        return code, low, stamp, error


def _assign(history: list[np.ndarray], scale: int, last: bool):
    parts, entries, size = history[0].shape

    def run(batches):
        books = Codebooks(history)
        groups = len(books.groups)
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                some = b.slice(at, STEP)
                n = some.num_rows
                raw = matrix(some.column("v"), parts * size)
                if books.now == 0:
                    flat = whole(raw, scale)
                    code, low, stamp, error = books.first(flat.reshape(n, parts, size))
                else:
                    flat = raw.astype(np.int64)
                    code = np.frombuffer(b"".join(some.column("code").to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                    low = matrix(some.column("low"), parts * groups).reshape(n, parts, groups)
                    stamp = np.frombuffer(b"".join(some.column("stamp").to_pylist()), np.uint8).reshape(n, parts, groups)
                    code, low, stamp, error = books.again(flat.reshape(n, parts, size), code, low, stamp)
                codes = pa.array([r.tobytes() for r in code.astype(np.uint8)], pa.binary())
                if last:
                    yield pa.RecordBatch.from_arrays([some.column("id"), some.column("label"), codes, pa.array(error.sum(1))], ["id", "label", "code", "error"])
                    continue
                x = flat.reshape(n, parts, size)
                for p in range(parts):
                    counts[p] += np.bincount(code[:, p], minlength=entries)
                    np.add.at(sums[p], code[:, p], x[:, p])
                yield _rows(n, id=some.column("id"), label=some.column("label"), v=_lists(flat.astype(np.int32)), code=codes, low=_lists(low.reshape(n, -1)),
                            stamp=pa.array([r.tobytes() for r in stamp.reshape(n, -1)], pa.binary()))
        if not last and counts.any():  # place 0: how many; then the components' sums
            total = np.concatenate([counts[:, :, None], sums], 2)
            p, e, j = (a.ravel().astype(np.int32) for a in np.indices(total.shape))
            yield _rows(total.size, part=pa.array(p), entry=pa.array(e), place=pa.array(j), total=pa.array(total.ravel()))

    return run


_TYPES = [("id", pa.int64()), ("label", pa.string()), ("v", pa.list_(pa.int32())), ("code", pa.binary()), ("low", pa.list_(pa.float32())),
          ("stamp", pa.binary()), ("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.int64())]


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(c, None) if c in columns else pa.nulls(n, t) for c, t in _TYPES], [c for c, _ in _TYPES])


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))


def moved(book: np.ndarray, state: DataFrame) -> np.ndarray:
    """The codebook after a round: every entry the floored mean of its parts; entries without parts stay."""
    added = state.filter(F.col("part").isNotNull()).groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
    total = np.zeros((*book.shape[:2], book.shape[2] + 1), np.int64)
    for r in added.collect():  # parts x entries x (components + 1) rows
        total[r["part"], r["entry"], r["place"]] = r["total"]
    count = total[:, :, :1]
    return np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), book)


def compress(
    spark: SparkSession, rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """((id, label, code, error) per vector, codebooks of all rounds as [part, entry, component])."""
    if not 0 < entries <= 256:
        raise ValueError("a code is a byte")
    kept = kept_vectors(rows, id_col, vector_col, label_col)
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    size = max(1, -(-(longest or 0) // parts))
    start = [r["v"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()]
    if not start:
        return spark.createDataFrame([], CODED), [np.zeros((parts, 0, size), np.int64)]
    book = whole(np.array([v + [0.0] * (parts * size - len(v)) for v in start]), scale)
    history = [book.reshape(-1, parts, size).transpose(1, 0, 2).copy()]
    at = kept
    for r in range(rounds):
        state = stored(at.mapInArrow(_assign(history, scale, False), STATE), f"vector-codes-{r}")
        history.append(moved(history[-1], state))
        at = state.filter(F.col("part").isNull())
    return stored(at.mapInArrow(_assign(history, scale, True), CODED), "vector-codes"), history


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the sum of the errors of its label (nulls together)."""
    per_label = stored(coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "vector-labels")
    return coded.join(bounded_broadcast(per_label), F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def codebook_text(book: np.ndarray) -> str:
    """All entries' whole numbers by part, entry and component, joined by commas."""
    return ",".join(map(str, book.ravel().tolist()))
