"""Katz backoff scoring of texts under an n-gram model of the corpus.

Texts are cut into words and one end mark each, in blocks of documents stored
once as numbers. Level by level every block sends its distinct n-grams, counted,
to buckets of the model; a bucket adds the counts of all blocks, keeps the
merged n-grams as a partition of the model's table and answers each block with
the counts of its n-grams and the sums of their contexts. Discounts follow from
counts of counts (Good-Turing for counts up to ``K``), and a context's backoff
weight is exactly what its discounts free, shared over the words that were not
seen after it. A token's probability is its discounted share if the n-gram was
seen, else the backoff weight times its probability under the shorter context,
and so on down to single words, where all unknown words share one class.

A frequent context is spread over buckets in proportion to its share of the
corpus; its sums are added up again by the blocks that asked for it.

Defined results: a null or empty text is its end mark alone; repeated rows count
as often as they occur; without training tokens every token is unknown with
probability one; an empty table gives an empty result; a very long text is cut
into segments that carry their context along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import input_bytes, lower_words, scratch_path, stored, texts

#: Counts up to this are discounted.
K = 5
#: Tokens of a block, and of a bucket's share of the corpus.
BLOCK_TOKENS = 1_500_000
BUCKET_TOKENS = 4_000_000
#: Bytes of stored documents whose blocks one task reads.
PART_BYTES = 16 << 20
#: Tokens of a text's segment.
SEGMENT_TOKENS = 1_000_000

BLOCKS = "block long, row array<long>, doc_id array<long>, held_out array<boolean>, tokens array<int>, lead array<int>, vocab binary, text binary"
ASKS = "level int, bucket int, block long, data binary"
ANSWERS = "kind string, level int, bucket int, block long, data binary, n_r array<long>, grams long, total long"
SCORES = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


# ---- arrays as bytes -------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string: equal bytes of the numbers lie together."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        parts.append(a.dtype.str.encode() + len(a).to_bytes(8, "little") + planes)
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, n = np.dtype(raw[at : at + 3].decode()), int.from_bytes(raw[at + 3 : at + 11], "little")
        at += 11
        size = n * kind.itemsize
        out.append(np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T.copy().reshape(-1).view(kind))
        at += size
    return out


def _mix(a: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group starts): rows sorted by (a, b) and where a new pair begins."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    span = int(b.max()) - int(b.min()) + 1
    if (int(a.max()) + 2) * span < 1 << 62:
        code = a * span + (b - int(b.min()))
        order = np.argsort(code, kind="stable")
        new = np.r_[True, np.diff(code[order]) != 0]
    else:
        order = np.lexsort((b, a))
        new = np.r_[True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)]
    return order, np.flatnonzero(new)


# ---- the corpus in blocks --------------------------------------------------


def _block(number, segs, words, ids):
    """One row of the blocks table; words are numbered by frequency so that numbers are small."""
    ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    count = np.bincount(ids, minlength=len(words))
    order = np.argsort(-count, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    row, doc, held, n, lead = (list(c) for c in zip(*segs))
    words = list(words)
    vocab = zstandard.ZstdCompressor(level=3).compress(b"\n".join([words[i] for i in order]))
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in (
            (number, pa.int64()), (row, pa.list_(pa.int64())), (doc, pa.list_(pa.int64())), (held, pa.list_(pa.bool_())),
            (n, pa.list_(pa.int32())), (lead, pa.list_(pa.int32())), (vocab, pa.binary()), (pack(place[ids].astype(np.uint32)), pa.binary()),
        )],
        ["block", "row", "doc_id", "held_out", "tokens", "lead", "vocab", "text"],
    )


def _blocks(order: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        made, serial, segs, words, ids, held_tokens = 0, 0, [], {b"": 0}, [], 0
        for b in batches:
            for doc, held, t in zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), texts(b.column("text"))):
                found = lower_words(t) + [b""]
                for at in range(0, len(found), SEGMENT_TOKENS):
                    lead = min(at, order - 1)
                    piece = found[at - lead : at + SEGMENT_TOKENS]
                    number = words.setdefault
                    ids.append(np.array([number(w, len(words)) for w in piece], np.int64))
                    segs.append((part << 40 | serial, doc, held, len(piece), lead))
                    held_tokens += len(piece)
                    if held_tokens >= BLOCK_TOKENS:
                        yield _block(part << 40 | made, segs, words, ids)
                        made, segs, words, ids, held_tokens = made + 1, [], {b"": 0}, [], 0
                serial += 1
        if segs:
            yield _block(part << 40 | made, segs, words, ids)

    return run


class Block:
    """A block's arrays, and what the model's answers say about them level by level."""

    def __init__(self, row: dict, buckets: int):
        self.row, self.buckets, self.block = row, buckets, row["block"]
        self.words = zstandard.ZstdDecompressor().decompress(row["vocab"]).split(b"\n")
        self.ids = unpack(row["text"])[0].astype(np.int64)
        self.n, lead, held = (np.array(row[c] or [], np.int64) for c in ("tokens", "lead", "held_out"))
        self.start = np.cumsum(self.n) - self.n
        self.seg = np.repeat(np.arange(len(self.n)), self.n)
        at = np.arange(len(self.ids)) - self.start[self.seg]
        self.scored = at >= lead[self.seg]
        self.counted = self.scored & (held[self.seg] == 0)
        self.head = at == 0  # a context that begins before the text, or in the segment before

    # level 1: words
    def _plan_words(self) -> np.ndarray:
        bucket = np.array([xxhash.xxh64_intdigest(w) % self.buckets for w in self.words], np.int64)
        self.word_order = np.argsort(bucket, kind="stable")
        return bucket[self.word_order]

    def ask_words(self):
        count, b = np.bincount(self.ids[self.counted], minlength=len(self.words)), self._plan_words()
        for at, end in _runs(b):
            take = self.word_order[at:end]
            text = b"\n".join([self.words[i] for i in take])
            yield 1, int(b[at]), pack(np.frombuffer(text, np.uint8), count[take].astype(np.int64))

    def hear_words(self, answers: dict[int, bytes], model: dict):
        self._plan_words()
        bucket = sorted(answers)
        ids, count = (np.concatenate(x) for x in zip(*(unpack(answers[b]) for b in bucket)))
        self.word_id, self.word_count = np.empty(len(self.words), np.int64), np.empty(len(self.words), np.int64)
        self.word_id[self.word_order], self.word_count[self.word_order] = ids, count
        self.w, self.c = self.word_id[self.ids], self.word_count[self.ids]
        self.p = unigram(self.c, model[1])
        self.gram = self.w

    # levels above: (context, word) pairs
    def _contexts(self):
        ctx = np.empty(len(self.gram), np.int64)
        ctx[1:] = self.gram[:-1]
        ctx[self.head] = 0  # the place before the text
        return ctx

    def _plan_grams(self, level: int, model: dict):
        """Distinct (context, word) with their counts here and the word's probability under the shorter context, by bucket."""
        ctx = self._contexts()
        known = np.flatnonzero(ctx >= 0)
        order, first = distinct_pairs(ctx[known], self.w[known])
        rows = known[order]
        c, w = ctx[rows[first]], self.w[rows[first]]
        n = np.add.reduceat(self.counted[rows].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        # at level 2 the word's count says its probability, in fewer bytes
        q = self.c[rows[first]] if level == 2 else self.p[rows[first]]
        self.pair_of = np.full(len(ctx), -1, np.int64)
        self.pair_of[rows] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rows)]))
        # a context's share of the corpus says over how many buckets it is spread
        weight = np.empty(len(ctx), np.int64)
        weight[1:] = (self.c if level == 2 else self.gram_count)[:-1]
        weight[self.head] = model["texts"]
        weight = weight[rows[first]]
        spread = np.maximum(1, -(-weight * self.buckets // max(model[1]["total"], 1)))
        sub = (_mix(w + 2) % spread.astype(np.uint64)).astype(np.int64)
        # a spread context asks all its buckets, so that its sums can be added up
        wide = np.flatnonzero((spread > 1) & np.r_[True, np.diff(c) != 0]) if len(c) else np.zeros(0, np.int64)
        pc = np.repeat(c[wide], spread[wide])
        ps = np.concatenate([np.arange(s) for s in spread[wide]]) if len(wide) else np.zeros(0, np.int64)
        pair = np.r_[np.arange(len(c)), np.full(len(pc), -1)]
        c, sub = np.r_[c, pc], np.r_[sub, ps]
        w, n, q = np.r_[w, np.full(len(pc), -1)], np.r_[n, np.zeros(len(pc), np.int64)], np.r_[q, np.zeros(len(pc), q.dtype)]
        bucket = (_mix(c * 1_000_003 + sub) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((w, c, bucket))
        c, w, n, q, bucket = c[order], w[order], n[order], q[order], bucket[order]
        self.asked_pair, self.pairs = pair[order], len(first)
        # a bucket answers its contexts in order: each asked row's place among them, and their numbers
        new = np.r_[True, (np.diff(c) != 0) | (np.diff(bucket) != 0)] if len(c) else np.zeros(0, bool)
        self.asked_place, self.asked_contexts = np.cumsum(new) - 1, c[new]
        return c, w, n, q, bucket

    def ask_grams(self, level: int, model: dict):
        c, w, n, q, bucket = self._plan_grams(level, model)
        for at, end in _runs(bucket):
            s = slice(at, end)
            # only counted rows need the probability; it repeats, so its distinct values go once
            values, place = np.unique(q[s][n[s] > 0], return_inverse=True)
            values = np.diff(values, prepend=0) if level == 2 else values
            yield level, int(bucket[at]), pack(np.diff(c[s], prepend=0), w[s].astype(np.int64), n[s].astype(np.int32), place.astype(np.uint32), values)

    def hear_grams(self, level: int, answers: dict[int, bytes], model: dict):
        self._plan_grams(level, model)
        if not answers:
            self.gram, self.gram_count = np.full(len(self.ids), -1, np.int64), np.zeros(len(self.ids), np.int64)
            return
        parts = [unpack(answers[b]) for b in sorted(answers)]
        r, gram, total, seen = (np.concatenate([p[k] for p in parts]) for k in range(4))
        # the sums of a context over its buckets
        contexts, place = np.unique(self.asked_contexts, return_inverse=True)
        small = np.stack([np.concatenate([p[4 + k] for p in parts]) for k in range(K)])
        total, seen = (np.bincount(place, x, len(contexts)) for x in (total, seen))
        small = [np.bincount(place, small[k], len(contexts)) for k in range(K)]
        d = discounts(model[level]["n_r"])
        freed = sum((1 - d[k]) * (k + 1) * small[k] for k in range(K))
        none = freed <= 0
        whole = total + none  # nothing is freed: one more count makes room
        alpha = np.where(total > 0, np.where(none, 1.0, freed) / np.maximum(whole, 1) / np.maximum(1 - seen, 1e-300), 1.0)
        own = self.asked_pair >= 0
        count, number, where = np.zeros(self.pairs, np.int64), np.full(self.pairs, -1, np.int64), np.zeros(self.pairs, np.int64)
        count[self.asked_pair[own]] = r[own]
        if len(gram):  # the last level's n-grams are no contexts and have no numbers
            number[self.asked_pair[own]] = gram[own]
        where[self.asked_pair[own]] = place[self.asked_place[own]]
        at = np.flatnonzero(self.pair_of >= 0)
        k = self.pair_of[at]
        held = count[k]
        share = np.where(held <= K, np.array([0, *d])[np.minimum(held, K)], 1.0) * held / np.maximum(whole[where[k]], 1)
        p = self.p.copy()
        p[at] = np.where(held > 0, share, alpha[where[k]] * self.p[at])
        self.p = p
        self.gram, self.gram_count = np.full(len(self.ids), -1, np.int64), np.zeros(len(self.ids), np.int64)
        self.gram[at], self.gram_count[at] = number[k], held

    def scores(self, model: dict) -> pa.Table:
        m = model[1]
        base = np.log10((self.c + 1) / (m["total"] + m["grams"] + 1))
        s, width = self.seg, len(self.n)
        add = lambda x: np.bincount(s, np.where(self.scored, x, 0), width)
        r = self.row
        return pa.table(
            [pa.array(r["row"], pa.int64()), pa.array(r["doc_id"], pa.int64()), pa.array(r["held_out"], pa.bool_()), pa.array(add(1).astype(np.int64)),
             pa.array(add(self.c > 0).astype(np.int64)), pa.array(add(base)), pa.array(add(np.log10(np.maximum(self.p, 1e-300))))],
            names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )


def _runs(keys: np.ndarray):
    if len(keys):
        cut = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
        yield from zip(cut[:-1].tolist(), cut[1:].tolist())


def discounts(n_r: list[int]) -> list[float]:
    """Katz's discounts of counts 1 to K from the counts of counts 1 to K + 1.

    Where the counts of counts are too few or uneven for one between 0 and 1,
    half a count is taken off instead.
    """
    n = [0, *n_r]
    rest = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if n[r] and rest < 1 else 0.0
        out.append(d if 0 < d < 1 else 1 - 0.5 / r)
    return out


def unigram(count: np.ndarray, m: dict) -> np.ndarray:
    """P of words with these counts; all unknown words are one class that gets what the discounts free."""
    d = discounts(m["n_r"])
    freed = sum((1 - d[r - 1]) * r * m["n_r"][r - 1] for r in range(1, K + 1))
    whole = m["total"] + (freed <= 0)
    share = np.where(count <= K, np.array([0, *d])[np.minimum(count, K)], 1.0) * count / whole
    return np.where(count > 0, share, (freed if freed > 0 else 1.0) / whole)


# ---- buckets of the model --------------------------------------------------


def _merge(buckets: int, last: int, totals: dict):
    """One bucket of one level: the blocks' counts added up, the model's rows, and the answers."""

    def run(table: pa.Table) -> pa.Table:
        level, bucket = table["level"][0].as_py(), table["bucket"][0].as_py()
        blocks, data = table["block"].to_pylist(), [unpack(x) for x in table["data"].to_pylist()]
        rows = []
        answer = lambda b, *a: rows.append(("answer", level, bucket, b, pack(*a), None, None, None))
        if level == 1:
            total: dict[bytes, int] = {}
            words = [d[0].tobytes().split(b"\n") for d in data]
            for ws, (_, n) in zip(words, data):
                for w, k in zip(ws, n.tolist()):
                    total[w] = total.get(w, 0) + k
            # frequent words get the small numbers, which take the fewest bytes wherever they are sent
            seen = sorted((w for w, k in total.items() if k), key=lambda w: (-total[w], w))
            number = {w: i * buckets + bucket + 1 for i, w in enumerate(seen)}
            for b, ws in zip(blocks, words):
                answer(b, np.array([number.get(w, -1) for w in ws], np.int64), np.array([total[w] for w in ws], np.int64))
            count = np.array([total[w] for w in seen], np.int64)
            model = pack(np.frombuffer(b"\n".join(seen), np.uint8), count)
        else:
            c = np.concatenate([np.cumsum(d[0]) for d in data])
            w, n = (np.concatenate([d[k] for d in data]) for k in (1, 2))
            q = np.zeros(len(c))
            values = [np.cumsum(d[4]) if level == 2 else d[4] for d in data]
            q[n > 0] = np.concatenate([v[d[3]] for v, d in zip(values, data)])
            if level == 2:
                q[n > 0] = unigram(q[n > 0].astype(np.int64), totals[1])
            order, first = distinct_pairs(c, w)
            sums = np.add.reduceat(n[order].astype(np.int64), first)
            uc, uw, uq = c[order[first]], w[order[first]], np.maximum.reduceat(q[order], first)
            group = np.empty(len(c), np.int64)
            group[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
            seen = sums > 0
            number = np.where(seen, np.cumsum(seen) - 1, -1)
            number = np.where(seen, number * buckets + bucket + 1, -1)
            contexts, place = np.unique(uc, return_inverse=True)
            total = np.bincount(place, sums, len(contexts))
            mass = np.bincount(place, np.where(seen, uq, 0.0), len(contexts))
            small = [np.bincount(place, sums == k, len(contexts)) for k in range(1, K + 1)]
            at = 0
            for b, d in zip(blocks, data):
                g = group[at : at + len(d[1])]
                mine = c[at : at + len(d[1])]
                at += len(d[1])
                own = np.unique(mine)
                k = np.searchsorted(contexts, own)
                named = number[g] if level < last else number[:0]
                answer(b, sums[g].astype(np.int32), named, total[k].astype(np.int64), mass[k], *[s[k].astype(np.int32) for s in small])
            count = sums[seen].astype(np.int64)
            model = pack(np.diff(uc[seen], prepend=0), uw[seen], count)
        n_r = [int((count == r).sum()) for r in range(1, K + 2)]
        rows.append(("model", level, bucket, None, model, n_r, len(count), int(count.sum())))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
        names = ["kind", "level", "bucket", "block", "data", "n_r", "grams", "total"]
        return pa.table([pa.array(list(x), k) for x, k in zip(zip(*rows), kinds)], names=names)

    return run


def _ask_rows(asks, block):
    rows = [(level, bucket, block, data) for level, bucket, data in asks]
    cols = list(zip(*rows)) or [()] * 4
    return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["level", "bucket", "block", "data"])


def _heard(row: dict, answers: pa.Table, buckets: int, model: dict, upto: int) -> Block:
    """A block with the answers of levels 1 to ``upto`` taken in."""
    block = Block(row, buckets)
    by: dict[int, dict[int, bytes]] = {}
    for level, bucket, data in zip(answers["level"].to_pylist(), answers["bucket"].to_pylist(), answers["data"].to_pylist()):
        by.setdefault(level, {})[bucket] = data
    block.hear_words(by[1], model)
    for level in range(2, upto + 1):
        block.hear_grams(level, by.get(level, {}), model)
    return block


def _ask(level: int, buckets: int, model: dict):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        return _ask_rows(_heard(row, right, buckets, model, level - 1).ask_grams(level, model), row["block"])

    return run


def _finish(order: int, buckets: int, model: dict):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _heard(left.to_pylist()[0], right, buckets, model, order).scores(model)

    return run


def score_texts(
    spark: SparkSession, docs: DataFrame, held_out, order: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, dict, list[DataFrame]]:
    """Scores of all texts, learning from those that are not ``held_out`` (a column).

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score), the model's totals per level, and the model's tables, one per level,
    partitioned by kind and bucket.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    # as many parts as the input asks for: a bucketed table's are not cut further when it is read
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(rows) // PART_BYTES), 1)
    corpus = _bucketed(rows.mapInArrow(_blocks(order), BLOCKS), "katz-blocks", parts)
    size = corpus.select(
        F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"),
        F.size(F.filter(F.arrays_zip("held_out", "lead"), lambda x: ~x["held_out"] & (x["lead"] == 0))).alias("texts"),
    ).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("texts"), F.lit(0))).first()
    buckets = max(8, -(-size[0] // BUCKET_TOKENS))
    model: dict = {"texts": size[1]}

    def ask_words(batches):
        for b in batches:
            for row in b.to_pylist():
                yield from _ask_rows(Block(row, buckets).ask_words(), row["block"]).to_batches()

    tables: list[DataFrame] = []
    for level in range(1, order + 1):
        if level == 1:
            asks = corpus.mapInArrow(ask_words, ASKS)
        else:
            asks = _with_answers(corpus, tables).applyInArrow(_ask(level, buckets, dict(model)), ASKS)
        merged = asks.groupBy("bucket").applyInArrow(_merge(buckets, order, dict(model)), ANSWERS)
        t = stored(merged, f"katz-level-{level}", compression="uncompressed", partition_by="kind")
        m = t.filter("kind = 'model'").agg(*[F.sum(F.col("n_r")[k]) for k in range(K + 1)], F.sum("grams"), F.sum("total")).first()
        model[level] = {"n_r": [x or 0 for x in m[: K + 1]], "grams": m[K + 1] or 0, "total": m[K + 2] or 0}
        tables.append(t)

    scores = _with_answers(corpus, tables).applyInArrow(_finish(order, buckets, dict(model)), SCORES)
    scored = (
        scores.groupBy("row", "doc_id", "held_out")
        .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model[1]["total"]).cast("long").alias("train_tokens"), "base_score", "score")
    )
    return scored, model, tables


def _bucketed(df: DataFrame, name: str, parts: int) -> DataFrame:
    """``df`` as files bucketed by ``block`` in the shared folder: what meets it by block moves, the blocks stay."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    table = f"llm_{path.rsplit('/', 1)[-1].replace('-', '_')}"
    # binary columns are compressed already
    df.write.bucketBy(parts, "block").option("path", path).option("compression", "uncompressed").format("parquet").saveAsTable(table)
    kept = spark.table(table)
    # buckets need a catalog entry to be written and resolved; the files are external and stay when it goes
    spark.sql(f"DROP TABLE {table}")
    return kept


def _with_answers(corpus: DataFrame, tables: list[DataFrame]):
    answers = tables[0]
    for t in tables[1:]:
        answers = answers.union(t)
    answers = answers.filter("kind = 'answer'").select("block", "level", "bucket", "data")
    return corpus.groupBy("block").cogroup(answers.groupBy("block"))
