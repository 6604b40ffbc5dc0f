"""Best-fit packing by a configuration linear program.

A configuration is a multiset of piece lengths that fits a sequence. The
program asks for the fewest configurations (fractions allowed) that cover the
length histogram; multiplicative weights hold a price per length, and a knapsack
dynamic program over the capacity prices the best configuration around each
length that lags behind. The solution is rounded down to whole configurations,
and the pieces left over are put best-fit, largest first. All of this works on
the histogram (at most ``capacity`` entries); Spark counts the lengths and
numbers the pieces of each length, which gives every piece its sequence.

Defined results: a null or empty text is the closing id alone; a text longer
than a sequence is cut into full pieces, its first piece takes the remainder;
repeated rows are packed as often as they occur; pieces of one length may stand
for each other (their order decides); an empty table gives an empty result; very
long texts are encoded whole, one at a time; further columns are not read,
whatever their names.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import ranked, stored, texts

CAPACITY = 2048
END_ID = 0
#: Rounds of multiplicative weights and the strength of the prices' reaction.
ROUNDS = 150
ETA = 2.0
#: Share of a sequence that a configuration may leave empty at first; it doubles whenever nothing fits so well.
WASTE = 0.002
#: Steps with new prices: their number, the part of the scarcest pieces that each covers, the strength of the reaction.
PRICINGS, STEP, STEP_ETA = 150, 0.05, 2.0
#: The same of the small steps among the configurations found.
FINE, FINE_STEP, FINE_ETA = 20_000, 0.005, 4.0
#: A program's plan is good enough this close to the fewest sequences that could hold all tokens.
NEAR = 0.001
#: Units remembered by one Python worker; beyond it the memory starts anew (speed only).
MEMORY_UNITS = 500_000

# What the library's pattern may see differently at a cut between words: the text is then encoded whole.
_BLANKS = re.compile(r"\s \s")
# Characters whose classes differ between pattern libraries: such a unit goes to the tokenizer itself.
_ODD = re.compile("[^\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ſ‐-‧‰-⁞€]")
_WORKER: dict = {}


class Encoder:
    """Ids of texts as the tokenizer file gives them, as little-endian unsigned 32-bit numbers.

    The pattern of a byte-level tokenizer always cuts before a single space that
    does not stand between blanks, so equal units between such cuts are encoded
    once. Plain units go through the same merges in ``tiktoken`` (built from this
    very file), all others, texts with special strings and texts with runs of
    blanks through ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.plain = self._same_merges()
        self.known: dict[str, bytes] = {}

    def _same_merges(self):
        """The byte-level merges as ranks, if they are those of the ids; else None."""
        import tiktoken
        from public_tokenizers import PATTERN

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in printable}
        shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        vocab = {t: i for t, i in self.tok.get_vocab().items() if t not in self.special}
        if not all(c in shown for t in vocab for c in t) or "ByteLevel" not in str(self.tok.pre_tokenizer) or self.tok.normalizer is not None:
            return None
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={bytes(shown[c] for c in t): i for t, i in vocab.items()}, special_tokens={})
        probe = "It's 12 cafés, naïve: don't (stop)!? x1y2 €5 … end."
        return enc if enc.encode_ordinary(probe) == self.tok.encode(probe, add_special_tokens=False).ids else None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        if self.plain is None or _ODD.search(unit):
            return self._whole(unit)
        return np.array(self.plain.encode_ordinary(unit), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if "  " in text or text[0] == " " or text[-1] == " " or _BLANKS.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        known = self.known
        if len(known) > MEMORY_UNITS:
            known.clear()
        first, *rest = text.split(" ")
        try:
            return self._unit(first) + b"".join(map(known.__getitem__, rest))
        except KeyError:
            for p in rest:
                if p not in known:
                    known[p] = self._unit(" " + p)
            return self._unit(first) + b"".join(map(known.__getitem__, rest))


def _encoder(path: str) -> Encoder:
    if _WORKER.get("path") != path:
        _WORKER.update(path=path, encoder=Encoder(path))
    return _WORKER["encoder"]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the remainder first, then full pieces."""
    head = n % capacity or capacity
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, end: bytes):
    def run(batches):
        for b in batches:
            encoder, rows = _encoder(path), []
            for doc, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                ids = encoder.encode(t) + end
                for k, (s, n) in enumerate(cuts(len(ids) // 4, capacity)):
                    rows.append((doc, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each room, and the length (index) that it takes first (-1: none)."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        k = fits[room]
        if k:
            value = best[room - lengths[:k]] + prices[:k]
            i = int(value.argmax())
            if value[i] > best[room]:
                best[room], take[room] = value[i], i
    return best, take


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS, eta: float = ETA, waste: float = WASTE, most: float = 1.0) -> dict[tuple, float]:
    """Configurations (tuple of (index, times)) with their amounts, by multiplicative weights.

    A length's price is its share of a sequence times a weight that falls
    exponentially with the part of its pieces already covered. Each round prices
    anew, then gives every uncovered length the dearest configuration around it,
    as far as the pieces last. Configurations may leave ``waste`` of a
    sequence empty; after 10 rounds without one that does not leave more, twice
    as much, up to ``most``. The prices' small fixed variation keeps equally dear
    configurations from always being the same.
    """
    need = counts.astype(float)
    rest, x, vary, idle = need.copy(), {}, np.random.default_rng(0), 0
    for _ in range(rounds):
        weight = np.exp(-eta * (1 - rest / need)) * (1 + 0.02 * vary.random(len(lengths)))
        prices = np.where(rest >= 1, lengths / capacity * weight, 0.0)
        if idle == 10 and waste < most:
            waste, idle = min(2 * waste, most), 0
        if not prices.any() or idle == 10:  # nothing is left, or nothing that still fits so well
            break
        idle += 1
        _, take = _knapsack(lengths, prices, capacity)
        for i in range(len(lengths) - 1, -1, -1):
            if rest[i] < 1:
                continue
            held, room = {i: 1}, capacity - int(lengths[i])
            while room > 0 and take[room] >= 0:
                j = int(take[room])
                held[j] = held.get(j, 0) + 1
                room -= int(lengths[j])
            step = min(rest[j] / a for j, a in held.items())
            if step < 1 or room > waste * capacity:
                continue
            key = tuple(sorted(held.items()))
            x[key] = x.get(key, 0.0) + step
            idle = 0
            for j, a in key:
                rest[j] -= a * step
    return x


def round_down(x: dict[tuple, float], counts: np.ndarray) -> tuple[list[tuple[tuple, int]], np.ndarray]:
    """Whole configurations that use no more pieces than there are, and the pieces left."""
    left, out = counts.astype(np.int64).copy(), []
    for key, v in sorted(x.items(), key=lambda kv: (-kv[1], kv[0])):
        n = min(int(v + 1e-9), *(int(left[j]) // a for j, a in key))
        if n > 0:
            out.append((key, n))
            for j, a in key:
                left[j] -= a * n
    return out, left


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best-fit, largest first, by counts: bins with equal contents are one entry."""
    by_room: dict[int, list[list]] = {}
    done: list[tuple[tuple, int]] = []
    rooms = np.zeros(capacity + 1, bool)
    for i in range(len(lengths) - 1, -1, -1):
        size, n = int(lengths[i]), int(left[i])
        while n > 0:
            open_rooms = np.flatnonzero(rooms[size:])
            if len(open_rooms):
                room = size + int(open_rooms[0])
                held, bins = by_room[room].pop()
                if not by_room[room]:
                    rooms[room] = False
                used = min(bins, n)
                if bins > used:
                    by_room.setdefault(room, []).append([held, bins - used])
                    rooms[room] = True
                new = {**held, i: held.get(i, 0) + 1}
            else:
                per = min(capacity // size, n)
                used, room, new = n // per, capacity - (per - 1) * size, {i: per}
                n -= used * (per - 1)
            n -= used
            rest = room - size
            by_room.setdefault(rest, []).append([new, used])
            rooms[rest] = rest > 0
    for entries in by_room.values():
        done += [(tuple(sorted(h.items())), b) for h, b in entries]
    return done


def cover(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> dict[tuple, float]:
    """Amounts that cover all lengths, by multiplicative weights.

    Steps with new prices find configurations, each the dearest filling of a
    sequence; small steps among these, and the fillings with one length, then
    give the amounts, which are scaled to cover every length once.
    """
    need, done = counts.astype(float), np.zeros(len(lengths))
    found = {((j, capacity // int(n)),) for j, n in enumerate(lengths)}
    for _ in range(PRICINGS):
        _, take = _knapsack(lengths, lengths * np.exp(-STEP_ETA * (done - done.min())), capacity)
        held, room = {}, capacity
        while room > 0 and take[room] >= 0:
            j = int(take[room])
            held[j] = held.get(j, 0) + 1
            room -= int(lengths[j])
        step = STEP * min(need[j] / a for j, a in held.items())
        found.add(tuple(sorted(held.items())))
        for j, a in held.items():
            done[j] += a * step / need[j]
    keys = sorted(found)
    part = np.zeros((len(keys), len(lengths)))  # of a length's pieces, in one sequence
    for k, key in enumerate(keys):
        for j, a in key:
            part[k, j] = a / need[j]
    step, x, done = FINE_STEP / part.max(1), np.zeros(len(keys)), np.zeros(len(lengths))
    lists = [[j for j, _ in key] for key in keys]
    for n in range(FINE):
        if n % 100 == 0:  # anew, before the differences' errors grow
            weight = np.exp(-FINE_ETA * (done - done.min()))
            value = part @ weight
        k = int(value.argmax())
        x[k] += step[k]
        at, gain = lists[k], part[k, lists[k]] * step[k]
        done[at] += gain
        less = weight[at] * np.exp(-FINE_ETA * gain)
        value += part[:, at] @ (less - weight[at])
        weight[at] = less
    # a length that no step reached leaves the scale to the others; best-fit takes its pieces
    x /= done[done > 0].min()
    return {key: float(v) for key, v in zip(keys, x) if v > 0}


def packed(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[tuple[tuple, int]], int]:
    """Configurations with their numbers, and how many sequences of these the program made.

    The program is solved first, always; its whole configurations are kept and
    what rounding leaves is put best-fit. While that is above the bound by more
    than ``NEAR``, the program is solved again with ever less well-filled
    configurations, then for whatever covers all lengths. Best-fit alone takes
    its place only where it needs fewer sequences.
    """
    if not len(lengths):
        return [], 0
    least = -(-int((lengths * counts).sum()) // capacity)
    total = lambda t: sum(n for _, n in t)
    best, made = None, 0
    programs = (lambda: solve(lengths, counts, capacity, most=WASTE), lambda: solve(lengths, counts, capacity), lambda: cover(lengths, counts, capacity))
    for program in programs:
        configs, left = round_down(program(), counts)
        found = configs + best_fit(lengths, left, capacity)
        if best is None or total(found) < total(best):
            best, made = found, total(configs)
        if total(best) <= least * (1 + NEAR):
            break
    alone = best_fit(lengths, counts, capacity)
    return (alone, 0) if total(alone) < total(best) else (best, made)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots of every length: from which rank on, in which sequences, at which offset, how many per sequence."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    configs, _ = packed(lengths, counts, capacity)
    rows, base, used = [], 0, np.zeros(len(lengths), np.int64)
    for key, n in sorted(configs):
        offset = 0
        for j, a in key:
            rows.append((int(lengths[j]), int(used[j]), base, offset, a))
            used[j] += a * n
            offset += a * int(lengths[j])
        base += n
    assert (used == counts).all()
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "offset", "times"), cols))


def _place(shared):
    def run(batches):
        p = shared.value
        # slots are sorted by (length, first rank): one search finds a piece's slot
        code = p["length"] << 44 | p["rank"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("nth").to_numpy()
            at = np.searchsorted(code, length << 44 | rank, side="right") - 1
            nth = rank - p["rank"][at]
            sequence = p["sequence"][at] + nth // p["times"][at]
            offset = p["offset"][at] + nth % p["times"][at] * length
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_documents(
    spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``docs``."""
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # stored, because the range-partitioned sort reads its input twice (once for the bounds)
    pieces = stored(rows.mapInArrow(_pieces(tokenizer_path, capacity, end), PIECES), "packing-encoded")
    # numbered in the order of their lengths; a length's first number is the count of shorter pieces
    order = ["length", F.xxhash64("doc_id", "piece", "ids_crc32"), "doc_id", "piece", "ids_crc32"]
    numbered = ranked(pieces, order, "packing-pieces")
    histogram = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}  # at most ``capacity`` rows
    shorter, total = [0] * (capacity + 1), 0
    for n in range(1, capacity + 1):
        shorter[n] = total
        total += histogram.get(n, 0)
    first = F.element_at(F.lit(shorter).cast("array<bigint>"), F.col("length").cast("int") + 1)
    slots = spark.sparkContext.broadcast(plan(histogram, capacity))
    schema = PIECES + ", sequence_id long, offset long"
    return numbered.withColumn("nth", F.col("rank") - first).drop("rank").mapInArrow(_place(slots), schema)
