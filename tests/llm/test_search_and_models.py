"""Katz scoring, top-k, SimHash, WARC, toxicity and quality rules against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from atlaspanel.llm import katz, quality, simhash, topk, toxicity, warc
from atlaspanel.llm.common import input_bytes


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


# ---- Katz ------------------------------------------------------------------


def katz_brute(docs, order):
    """docs: (key, text, learned) -> key -> (tokens, known, base, score); checks that every context sums to one."""
    toks = [(k, (t or "").encode().lower().split() + [b""], learned) for k, t, learned in docs]

    def history(t, k, n):
        h = ([0] * order + t[:k])[order + k - n + 1 : order + k]
        while len(h) > 1 and h[0] == 0 and h[1] == 0:
            h = h[1:]
        return tuple(h)

    follow = [collections.defaultdict(collections.Counter) for _ in range(order)]
    for _, t, learned in toks:
        if learned:
            for n in range(1, order + 1):
                for k, w in enumerate(t):
                    follow[n - 1][history(t, k, n)][w] += 1
    words = follow[0][()]
    total, distinct = sum(words.values()), len(words)
    cut = []
    for f in follow:
        n_r = collections.Counter(c for x in f.values() for c in x.values())
        cut.append(katz.discounts([n_r[r] for r in range(1, katz.K + 2)]))
    d = lambda level, r: cut[level][r - 1] if r <= katz.K else 1.0
    memo = {}

    def backoff(level, h):
        if (level, h) not in memo:
            f = follow[level][h]
            freed, whole = sum((1 - d(level, r)) * r for r in f.values()), sum(f.values())
            if freed <= 0:
                freed, whole = 1, whole + 1
            seen = sum(p(level - 1, shorter(level, h), w) for w in f) if level else 0
            memo[level, h] = freed / whole / (1 - seen), whole
        return memo[level, h]

    def shorter(level, h):
        return h[1:] if len(h) >= level else h

    def p(level, h, w):
        f = follow[level].get(h)
        if level and not f:
            return p(level - 1, shorter(level, h), w)
        alpha, whole = backoff(level, h)
        r = (f or {}).get(w, 0)
        return d(level, r) * r / whole if r else alpha * (p(level - 1, shorter(level, h), w) if level else 1)

    for level in range(order):
        for h in list(follow[level])[:10]:
            assert sum(p(level, h, w) for w in [*words, b"\xffnever"]) == pytest.approx(1, abs=1e-9)
    out = {}
    for key, t, _ in toks:
        score = sum(math.log10(p(order - 1, history(t, k, order), w)) for k, w in enumerate(t))
        base = sum(math.log10((words.get(w, 0) + 1) / (total + distinct + 1)) for w in t)
        out[key] = (len(t), sum(w in words for w in t), base, score)
    return out, total


@pytest.mark.parametrize("order,block", [(2, None), (3, None), (2, 3000), (3, 3000)])
def test_katz_equals_brute_force(spark, sf, monkeypatch, order, block):
    if block:  # many blocks and buckets, texts in several segments, frequent contexts over several buckets
        monkeypatch.setattr(katz, "BLOCK_TOKENS", block)
        monkeypatch.setattr(katz, "BUCKET_TOKENS", block)  # (tasks are other processes: they keep the block size)
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 60").repartition(3)
    want, total = katz_brute([(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in docs.collect()], order)
    scored, model, tables = katz.score_texts(spark, docs, held_out(), order)
    got = {r.doc_id: r for r in scored.collect()}
    assert set(got) == set(want) and model[1]["total"] == total
    for k, (n, known, base, score) in want.items():
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    kept = tables[order - 1].filter("kind = 'model'")
    assert sum(len(katz.unpack(r.data)[-1 if order == 1 else 2]) for r in kept.collect()) == model[order]["grams"]


def test_katz_parts_follow_the_input_and_no_table_is_left(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = [t.name for t in spark.catalog.listTables()]
    want = collections.Counter(tuple(r) for r in katz.score_texts(spark, docs, held_out())[0].collect())
    made = []
    monkeypatch.setattr(katz, "PART_BYTES", 1 + input_bytes(docs) // 40)
    bucketed = katz._bucketed
    monkeypatch.setattr(katz, "_bucketed", lambda df, name, parts: made.append(parts) or bucketed(df, name, parts))
    scored = katz.score_texts(spark, docs, held_out())[0]
    assert collections.Counter(tuple(r) for r in scored.collect()) == want
    assert 30 <= made[0] <= 40
    assert [t.name for t in spark.catalog.listTables()] == before
    # rows that come from no file: their size is unknown, the cluster's width stands
    katz.score_texts(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), held_out())
    assert made[1] == max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def test_katz_segments_carry_their_context(spark):
    """Segments of 64 tokens (set in the tasks, which are other processes) score as the whole text does."""
    text = " ".join(f"w{i * i % 37}" for i in range(500))
    batch = __import__("pyarrow").RecordBatch.from_pylist([{"doc_id": 1, "held_out": False, "text": text}])
    import pyspark

    class Here:
        partitionId = staticmethod(lambda: 0)

    old, katz.SEGMENT_TOKENS = katz.SEGMENT_TOKENS, 64
    get, katz.TaskContext = katz.TaskContext, type("C", (), {"get": staticmethod(lambda: Here)})
    try:
        rows = next(iter(katz._blocks(3)([batch]))).to_pylist()
    finally:
        katz.SEGMENT_TOKENS, katz.TaskContext = old, get
    block = katz.Block(rows[0], 8)
    assert len(rows[0]["tokens"]) == 8 and int(block.scored.sum()) == 501
    assert [block.words[i] for i, s in zip(block.ids, block.scored) if s] == text.encode().split() + [b""]
    assert pyspark  # the engine itself runs in the tests above


def test_katz_odd_texts(spark, odd_docs, no_docs, clashing):
    got = [r for r in katz.score_texts(spark, clashing, held_out())[0].collect()]
    assert len(got) == odd_docs.count() and all(r.score <= 0 and r.n_tokens >= 1 for r in got)
    assert katz.score_texts(spark, no_docs, held_out())[0].count() == 0
    # nothing to learn from: every token is unknown, with probability one
    assert {r.score for r in katz.score_texts(spark, odd_docs, F.lit(True))[0].collect()} == {0.0}


# ---- top-k -----------------------------------------------------------------


def topk_brute(rows, k):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, np.floor(np.array(v, float) * 64).astype(int)) for i, v in fine]
    out = collections.Counter()
    for i, q in whole:
        if i % 20 == 0:
            s = sorted((-int(q @ v), j) for j, v in whole if j != i and len(v) == len(q))[:k]
            out.update((i, n + 1, j, -x) for n, (x, j) in enumerate(s))
    return out


@pytest.mark.parametrize("shard", [8192, 60])
def test_top_k_equals_brute_force(spark, sf, shard):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = topk.top_k(spark, e, e.filter("vec_id % 20 = 0"), shard=shard)
    assert collections.Counter(tuple(r) for r in got.collect()) == topk_brute([(r.vec_id, r.embedding) for r in e.collect()], 20)


def test_top_k_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (None, [1.0, 1.0]), (120, []), (140, [1.0, 2.0, 3.0])]
    rows += [(i, [0.5, -0.5]) for i in range(1, 15)] + [(15, [0.5, -0.5]), (15, [0.25, 0.25]), (160, [-1.0, 0.1])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("id", F.lit("y"))
    got = topk.top_k(spark, e, e.filter("vec_id % 20 = 0"), k=5, shard=4)
    assert collections.Counter(tuple(r) for r in got.collect()) == topk_brute(rows, 5)
    empty = e.limit(0)
    assert topk.top_k(spark, empty, empty).count() == 0


def test_repeated_queries_lose_no_neighbour(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(1, 60) if i % 20]
    queries = [(20, [1.0, 0.5])] * 3 + [(20, [-1.0, 0.5]), (40, [0.0, 1.0])]
    e = spark.createDataFrame(rows + queries, "vec_id long, embedding array<double>")
    got = topk.top_k(spark, e, e.filter("vec_id % 20 = 0"), k=20, shard=16).collect()
    # equal query rows are one query, other vectors of its id are queries of their own
    assert collections.Counter(r.query_id for r in got) == {20: 40, 40: 20}
    want = topk_brute(rows + queries[4:] + queries[2:3], 20) + topk_brute(rows + queries[4:] + queries[3:4], 20)
    assert collections.Counter(tuple(r) for r in got if r.query_id == 20) == collections.Counter({k: n for k, n in want.items() if k[0] == 20})


def test_share_of_scored_vectors(spark):
    """On the test vectors the bound falls last: the share that is scored is reported, not hidden."""
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    v = np.floor(np.array([r.embedding for r in e], float) * 64).astype(np.int64)
    lists, touched = topk.Lists(np.array([r.vec_id for r in e]), v), []
    whole = lists.v
    lists.v = type("V", (), {"__getitem__": lambda self, at: (touched.append(len(at)), whole[at])[1]})()
    for i in range(0, len(v), 20):
        lists.search(i, v[i], topk.TOP)
    share = sum(touched) / (len(range(0, len(v), 20)) * (len(v) - 1))
    print(f"scored {share:.0%} of the candidates")
    assert 0 < share <= 1


def test_threshold_stops_early():
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(5000, 4)) * 10).astype(np.int64)
    v[17] = [500, 500, 500, 500]
    lists, touched = topk.Lists(np.arange(5000), v), []
    lists.v = type("V", (), {"__getitem__": lambda self, rows: (touched.append(len(rows)), v.astype(float)[rows])[1]})()
    rows, score = lists.search(-1, np.array([3, 3, 3, 3]), 1)
    assert list(rows) == [17] and score[0] == 6000 and sum(touched) < 1000


# ---- SimHash ---------------------------------------------------------------


def fingerprint_brute(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    s = [b" ".join(w)] if len(w) < 3 else [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_brute(prints, radius=3):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = sorted(parent)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in known}


def test_fingerprints_and_groups(spark, sf, odd_docs, clashing):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), clashing):
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        root = groups_brute([fingerprint_brute(t) for _, t in texts])
        first = {}
        for i, t in texts:
            k = root[fingerprint_brute(t)]
            first[k] = min((x for x in (first.get(k), i) if x is not None), default=None)
        want = collections.Counter((i, f"{fingerprint_brute(t):016x}", first[root[fingerprint_brute(t)]]) for i, t in texts)
        assert collections.Counter(tuple(r) for r in simhash.near_duplicates(spark, docs).collect()) == want
        assert simhash.representatives(spark, docs).count() == len(set(root.values()))


@pytest.mark.parametrize(("shard", "blocks"), [(1000, None), (7, None), (1000, 5), (7, 6), (1000, 7)])
def test_links_find_every_group(spark, shard, blocks):
    """Chains, dense groups and near misses; with small shards every block value is cut into parts."""
    rng = np.random.default_rng(3)
    prints = set(int(x) for x in rng.integers(0, 1 << 63, 300))
    for x in list(prints)[:25]:
        for _ in range(12):
            bits = rng.choice(64, rng.integers(1, 6), replace=False)
            x ^= sum(1 << int(b) for b in bits)
            prints.add(x)
    want = groups_brute(prints)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(df, shard_size=shard, blocks=blocks)).collect()}
    by = collections.defaultdict(set)
    for x in prints:
        by[got.get(signed(x), signed(x))].add(x)
    parts = collections.defaultdict(set)
    for x, r in want.items():
        parts[r].add(x)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, parts.values()))


def test_blocks_follow_from_the_counted_shards(spark):
    """Few values of each 16-bit block held by many prints: more blocks; random prints or all in one place: four are enough."""
    rng = np.random.default_rng(11)
    varied = sum(1 << b for b in range(64) if b % 8 in (0, 3, 6))
    crowded = {int(x) & varied for x in rng.integers(0, 1 << 63, 4000)}
    free = {int(x) for x in rng.integers(0, 1 << 63, 4000)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    chosen = []
    for prints in (crowded, free):
        df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
        chosen.append(simhash.shards(df, 3))
    assert chosen[0] > 4 and chosen[1] == 4
    assert simhash.shards(spark.createDataFrame([], "fp long"), 3) == 4
    masks = simhash._masks(3, 6)
    assert len(masks) == 20 and all(m.bit_count() >= 30 for m in masks)


def test_bk_tree_equals_a_scan():
    rng = np.random.default_rng(5)
    values = [int(x) for x in rng.integers(0, 1 << 16, 400)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        for r in (0, 2, 3):
            assert sorted(set(tree.within(q, r))) == sorted({v for v in values if (v ^ q).bit_count() <= r})


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in simhash.components(e).collect()}
    assert {got[i] for i in range(1, 201)} == {0} and got[501] == 500


def test_simhash_of_nothing(spark, no_docs):
    assert simhash.near_duplicates(spark, no_docs).count() == 0
    assert simhash.representatives(spark, no_docs).count() == 0


# ---- WARC ------------------------------------------------------------------

LONG = "<html>" + "x" * 1200 + "</html>"
PAGES = [(1, "http://a/\r\nX: y", LONG), (2, "http://b", LONG), (9, "http://c", LONG), (9, "http://c", LONG), (3, None, None), (4, "u", ""), (5, "u", "é" * 499), (6, "u", "é" * 500), (7, "u", "é" * 500), (None, "n", "z" * 3000), (None, "n", "z" * 3000), (8, "n", "short"), (10, "n", "short"), (11, "big", "y" * 700_000)]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("size", F.lit(1))
    index = warc.write_archives(pages, str(tmp_path), frame_bytes=4000, bundle_bytes=1)
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, str(tmp_path), index).collect())
    want = collections.Counter()
    for i, _, html in PAGES:
        b = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "").encode() == b and j is not None]
        last = max(same, default=None) if len(b) >= 1000 else None
        revisit = last is not None and i != last
        want[i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", last if revisit else None] += 1
    assert got == want
    # one record is found through the index by its frame alone
    wanted = spark.createDataFrame([(warc.record_id(11),), (warc.record_id(2),)], "record_id string")
    records = {r.record_id: bytes(r.record) for r in warc.fetch_records(spark, str(tmp_path), index, wanted).collect()}
    assert len(records) == 2 and records[warc.record_id(11)].endswith(b"y" * 700_000 + b"\r\n\r\n") and b"WARC-Type: revisit" in records[warc.record_id(2)]
    # any Zstandard reader sees the records, the table is skipped
    import zstandard

    name = next(p for p in tmp_path.iterdir() if p.name.endswith(".zst"))
    plain = zstandard.ZstdDecompressor().stream_reader(name.read_bytes(), read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1\r\n")


def test_files_of_lost_attempts_are_passed_over(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    index = warc.write_archives(pages, str(tmp_path))
    (tmp_path / "bundle-lost-00000.warc.zst").write_bytes(b"half a bundle")
    assert warc.read_archives(spark, str(tmp_path), index).count() == 3


def test_a_damaged_payload_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 50), (2, "u", "y" * 50)], "page_id long, url string, html string")
    index = warc.write_archives(pages, f"file:{tmp_path}/bundles")
    records = warc.read_archives(spark, f"{tmp_path}/bundles", index)
    assert warc.verified(records).select("page_id").count() == 2
    wrong = records.withColumn("payload_ok", F.when(F.col("page_id") == 1, F.col("payload_ok")).otherwise(F.lit(False)))
    with pytest.raises(Exception, match="damaged payload: <urn:x-page:2>"):
        warc.verified(wrong).select("page_id").collect()


def test_no_pages(spark):
    assert warc.archive_pages(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---- toxicity --------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, toxicity.training_labels(labels).select("doc_id", "toxic"))
    scored = toxicity.score(spark, docs, model, {"doc_id": F.col("doc_id")}).join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    rows = [(r.score, r.toxic) for r in scored.collect()]
    assert all(0 <= s <= 1 for s, _ in rows)
    assert sum(s >= 0.7 for s, y in rows if not y) == 0
    assert sum(s >= 0.7 for s, y in rows if y) >= 0.7 * sum(y for _, y in rows)


def test_disguises_are_read(spark, sf):
    model = toxicity.char_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    r = toxicity.Restorer(model)
    for written, word in [("l0ser", b"loser"), ("tr@sh", b"trash"), ("m0r0n", b"moron"), ("w0rthl3ss", b"worthless"), ("l o s e r", b"loser"), ("s-t-u-p-i-d", b"stupid"), ("$cum", b"scum"), ("cloooown", b"clown")]:
        assert word in r.words(f"The {written.upper()} is here"), written
    assert toxicity.disguised("plain words, 1999 and rock'n'pop; end") == set()
    assert toxicity.disguised("rock'n'roll") == {"roll"}  # a doubled letter may be a disguise


@pytest.fixture(scope="module")
def restorer(spark):
    return toxicity.Restorer(toxicity.char_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


@pytest.mark.parametrize(
    "written, word",
    [
        ("tr@$#", "trash"), ("idi07", "idiot"), ("10ser", "loser"), ("10$3r", "loser"), ('"$cum"', "scum"), ("($cum)", "scum"),
        ("l 0 s e r", "loser"), ("l 0 $ 3 r!", "loser"), ("l  o  s  e  r", "loser"), ("a s s", "ass"), ("mo ron", "moron"), ("mo-ron", "moron"), ("lo  ser", "loser"),
        ("l0 ser", "loser"), ("tr@ sh", "trash"), ("idi07!!", "idiot"),
    ],
)
def test_disguises_are_marked(restorer, written, word):
    """Signs at the start and end of words, pieces set apart with signs or wide gaps, words parted once."""
    assert word.encode() in restorer.words(f"The {written.upper()} is here")


@pytest.mark.parametrize(
    "written, word",
    [
        ("l000ser", "loser"), ("m000r0n", "moron"), ("l0sser", "loser"), ("1d107", "idiot"), ("7r@$#", "trash"), ("7 r @ $ #", "trash"),
        ("l o o o s e r", "loser"), ("ll 0 s e r", "loser"), ("w0rthle55", "worthless"),
    ],
)
def test_disguises_combine(restorer, written, word):
    """Runs of signs and of two letters, signs and spacing, signs that end a word."""
    assert word.encode() in restorer.words(f"The {written.upper()} is here")


@pytest.mark.parametrize("before", ["the", "what a"])
@pytest.mark.parametrize(
    "word, written",
    [
        ("loser", "looser loosser l,o,s,e,r l/o/s/e/r l:o:s:e:r l~o~s~e~r l\u200bo\u200bs\u200be\u200br |0$3r"), ("scum", "sccum scuum"), ("idiot", "idiiot id!ot"),
        ("trash", "trassh traash"), ("moron", "morron mooron"), ("stupid", "stuupid"), ("clown", "cloown clowwn"),
    ],
)
def test_more_disguises_are_read(restorer, word, written, before):
    """Doubled letters, signs that are also marks, letters set apart by any separator."""
    for token in written.split():
        assert word.encode() in restorer.words(f"{before} {token.upper()} he is"), token


@pytest.mark.parametrize("before", ["the ", "what a ", "a ", "i "])
@pytest.mark.parametrize("written, word", [("s c u m", "scum"), ("i d i o t", "idiot"), ("s t u p i d", "stupid"), ("5 t u p 1 d", "stupid"), ("$ c u m", "scum"), ("t r @ s h", "trash"), ("l o s e r s", "losers")])
def test_words_set_apart_after_a_one_letter_word(restorer, before, written, word):
    assert word.encode() in restorer.words(f"{before}{written} he is")


def exhaustive(r, runs):
    """The likeliest readings of a lattice, by trying every path."""
    paths = [("", 0.0)]
    for i, (c, m) in enumerate(runs, 1):
        for slot in r._slots(c, m, False, False, False):
            paths = [(text + reading, cost + extra) for text, cost in paths for reading, extra in slot]
    best = {}
    for text, cost in paths:
        s = -cost
        a, b = toxicity.EDGE, toxicity.EDGE
        for ch in text + " ":
            k = toxicity.EDGE if ch == " " else ord(ch) - 97
            s += r.lp[a][b][k]
            a, b = b, k
        best[text] = max(best.get(text, -np.inf), s)
    return sorted(best, key=lambda t: (-best[t], t))[: toxicity.LIST]


@pytest.mark.parametrize("token", ["l0s3r", "a1l0", "t11n", "looser", "w0rr", "x(y", "iddio7", "m0r0nn", "b00kk"])
def test_viterbi_equals_an_exhaustive_decode(restorer, token):
    runs = restorer._runs(token, False)
    found = set()
    restorer._read(runs, False, False, found)
    assert set(exhaustive(restorer, runs)) <= found


def test_labels_of_a_hot_id_stay_bounded(spark):
    docs = spark.range(3000).select(F.when(F.col("id") < 2500, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("some plain words").alias("text"))
    labels = docs.select("doc_id").distinct().withColumn("toxic", F.pmod("doc_id", F.lit(2)).cast("int"))
    kept = []
    plain = toxicity.fit_logistic
    try:
        toxicity.fit_logistic = lambda rows, y, width, **how: (kept.append(len(rows)), plain(rows, y, width, **how))[1]
        toxicity.fit(docs, labels, max_labelled=600)
    finally:
        toxicity.fit_logistic = plain
    assert 0 < kept[0] <= 1200


def test_equal_cores_read_alike(restorer):
    """Letters away from a choice are left out of the decoding without changing it."""
    for token in ["w0rthless", "worthl3ss", "of that$$$", "tr@ shore", "bett3rment", "(xylophone!!", "the l0ser"]:
        whole = {w for r in restorer._decode(token, False) for w in r.split()}
        assert set(restorer.restore(token)) == whole, token


def words_by_loops(r, text):
    """Words of one text: marks found by patterns, every marked word decoded, gaps tried one by one."""
    low = text.lower()
    found = set(re.split("[\x00-@\\[-`{-\x7f" + toxicity._MARKS + "]+", low)) - {""}
    for token in toxicity.disguised(low):
        apart = toxicity._APART.fullmatch(token) is not None
        found |= {w for reading in r._decode(token, apart) for w in reading.split()}
    code = lambda c: ord(c) - 97 if "a" <= c <= "z" else toxicity.EDGE if c in " \t\n\v\f\r.-_*" else toxicity.OTHER
    row, end, padded = [], None, f"  {low}  "
    for m in re.finditer(r"(?<=[a-z])(([ \t\n\v\f\r.\-_*])\2*)(?=[a-z])", padded):
        i, j = m.span()
        if not r.joins[code(padded[i - 2]), code(padded[i - 1]), code(padded[j]), code(padded[j + 1])]:
            continue
        left, right = re.search("[a-z]+$", padded[:i]).group(), re.match("[a-z]+", padded[j:]).group()
        row = row + [right] if end == i - len(left) else [left, right]
        end = j
        found |= {"".join(row[-2:]), "".join(row[-3:])}
        after = re.compile(r"([ \t\n\v\f\r.\-_*])\1*(?=[a-z])").match(padded, j + len(right))
        k = after and after.end()
        if not after or not r.joins[code(padded[after.start() - 2]), code(padded[after.start() - 1]), code(padded[k]), code(padded[k + 1])]:
            found.add("".join(row))
    return {w.encode() for w in found}


def test_texts_looked_at_together_are_those_looked_at_alone(restorer):
    rng = random.Random(8)
    some = ["a", "b", "i", "the", "hit", "ee", "lll", "sS", "0", "1", "$", "!!", "*", "**", ".", "..", "-", "_", " ", "  ", "\n", "\0", "\u00e9", "\u20ac", "\u2026", "\u2019", "x y z", "i am", "(", "9"]
    batch = ["".join(rng.choice(some) for _ in range(rng.randrange(rng.choice([3, 12, 40])))) for _ in range(600)]
    assert [t for part in toxicity.parts_of(batch) for t in part] == batch
    for text, found in zip(batch, restorer.words_of(batch)):
        assert found == words_by_loops(restorer, text), text
        assert found == restorer.words(text)


def test_one_doubled_letter_needs_no_decoding(restorer, monkeypatch):
    """Of one run of two letters both readings are kept, whatever they score."""
    for token in ("roll", "aab", "baa", "ee", "xxq"):
        runs, found = restorer._runs(token, False), set()
        restorer._read(runs, False, False, found)
        assert found == set(exhaustive(restorer, runs)) and len(found) == 2
    asked = []
    monkeypatch.setattr(toxicity.Restorer, "_decode", lambda self, token, apart: asked.append(token) or ())
    fresh = toxicity.Restorer(restorer.dense)
    found = fresh.words("Rock'n'roll, aab \u00fcbell baa")
    assert asked == [] and {b"roll", b"rol", b"aab", b"ab", b"bell", b"bel", b"baa", b"ba"} <= found


def test_toxicity_odd_texts(spark, odd_docs, no_docs, clashing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (8, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(clashing, labels)
    got = toxicity.score(spark, clashing, model, {"doc_id": F.col("doc_id")}).collect()
    held = toxicity.score(spark, clashing, model, {"id": F.col("doc_id"), "body": F.col("text")}, text_key="body").collect()
    assert collections.Counter((r.id, r.score) for r in held) == collections.Counter(tuple(r) for r in got)
    assert collections.Counter(r.body for r in held) == collections.Counter(r.text for r in clashing.collect())
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = toxicity.fit(no_docs, labels.limit(0))
    assert toxicity.score(spark, no_docs, empty, {"doc_id": F.col("doc_id")}).count() == 0


def test_logistic_separates():
    rows = [[0], [0, 2], [1], [1, 2], [2], []] * 20
    y = np.array([1, 1, 0, 0, 0, 0] * 20, float)
    w, b = toxicity.fit_logistic(rows, y, 3)
    assert w[0] + b > 0 > w[1] + b and b < 0


# ---- quality rules ---------------------------------------------------------


def counts_brute(text):
    text = text or ""
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)]


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_base_counts(spark, odd_docs, sf, which):
    docs = odd_docs.filter("doc_id is null or doc_id <> 9") if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet")
    got = collections.Counter(tuple(r[c] for c in ["doc_id", *quality.COUNTS]) for r in quality.vectors(docs).collect())
    assert got == collections.Counter((r.doc_id, *counts_brute(r.text)) for r in docs.collect())


def test_estimate_resists_outliers(spark):
    """A fifth of far-off rows moves neither centre nor scatter, and all of them lie beyond the cut."""
    rng = np.random.default_rng(7)
    clean = rng.normal(size=(800, quality.P)) * 0.5 + 3
    far = rng.normal(size=(200, quality.P)) * 0.1 + 9
    rows = spark.createDataFrame([("g", r.tolist()) for r in np.r_[clean, far]], "fit string, x array<double>")
    p = quality.estimates(rows).first()
    assert np.allclose(p.mu, clean.mean(0), atol=0.15)
    root = np.array(p.root).reshape(quality.P, quality.P)
    d2 = lambda v: ((v - np.array(p.mu)) @ root.T) ** 2
    cut = quality.chi2_quantile(quality.CUT_Z, quality.P) * p.scale
    assert (d2(far).sum(1) > cut).all() and (d2(clean).sum(1) < cut).mean() > 0.999


def mcd_brute(x, steps=40):
    """Exact concentration steps on sorted distances, from medians and quartiles."""
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    mu, cov, h = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2), int(np.ceil(quality.H_SHARE * len(x)))
    far = lambda: (((x - mu) @ np.linalg.inv(np.linalg.cholesky(cov + np.diag(quality.FLOORS**2))).T) ** 2).sum(1)
    for _ in range(steps):
        near = x[np.argsort(far(), kind="stable")[:h]]
        mu, cov = near.mean(0), np.cov(near.T, bias=True)
    d = far()
    return mu, cov, d, max(np.median(d) / quality.chi2_quantile(0.0, quality.P), 1.0)


def fits_brute(rows, full):
    """rows: (lang, source, x) -> verdict per row: each group by its own estimate, shrunk for the rows it lacks."""
    fit = lambda chosen: (len(chosen), *(mcd_brute(np.array(chosen))[i] for i in (0, 1, 3)))
    by = collections.defaultdict(list)
    for lang, source, x in rows:
        for k in ((lang, source), lang, ""):
            by[k].append(x)
    fits = {k: fit(v) for k, v in by.items()}
    mix = lambda a, b, n: tuple(u ** (w := min(n / full, 1)) * v ** (1 - w) if i == 2 else min(n / full, 1) * u + (1 - min(n / full, 1)) * v for i, (u, v) in enumerate(zip(a, b)))
    out = []
    for lang, source, x in rows:
        n, *own = fits[lang, source]
        m, *pool = fits[lang]
        mu, cov, scale = mix(own, mix(pool, fits[""][1:], m), n)
        root = np.linalg.inv(np.linalg.cholesky(cov + np.diag(quality.FLOORS**2)))
        out.append((((x - mu) @ root.T) ** 2).sum() <= quality.chi2_quantile(quality.CUT_Z, quality.P) * scale)
    return out


def test_every_group_has_its_own_fit(spark):
    """Verdicts equal those of plain estimates; a row that is usual elsewhere is an outlier of its own source."""
    rng = np.random.default_rng(11)
    at = {("en", "a"): (0.0, 150), ("en", "b"): (4.0, 150), ("en", "c"): (0.0, 12), ("de", "a"): (-3.0, 100), (None, None): (0.0, 90)}
    rows = [(*k, (rng.normal(size=quality.P) * 0.4 + m).tolist()) for k, (m, n) in at.items() for _ in range(n)]
    rows += [("en", "a", [4.0] * quality.P), ("en", "b", [0.0] * quality.P), ("de", "a", [0.0] * quality.P), ("en", "c", [60.0] * quality.P)]
    df = spark.createDataFrame(rows, "lang string, source string, x array<double>")
    keyed = df.withColumns({"own": F.to_json(F.struct("lang", "source")), "pool": F.to_json(F.struct("lang"))})
    fits = quality.group_estimates(keyed.select("own", "pool", "x"))
    assert fits.count() == len(at)  # one for every language and source
    cut = F.lit(quality.chi2_quantile(quality.CUT_Z, quality.P)) * F.col("scale")
    got = {tuple(r.x): r.kept for r in keyed.join(fits, "own").select("x", (quality._distance() <= cut).alias("kept")).collect()}
    want = fits_brute(rows, quality.FULL)
    assert [got[tuple(x)] for _, _, x in rows] == want
    assert not any(want[-4:]) and sum(want) >= len(rows) - 8


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.assess(spark, spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    junk = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in junk) >= 0.9 * len(junk)


def test_quality_odd_texts(spark, odd_docs, no_docs, clashing):
    got = quality.assess(spark, clashing).collect()
    assert len(got) == odd_docs.count() and all(r.kept in (True, False) for r in got)
    assert not any(r.kept for r in got if r.n_words < 10)
    assert quality.assess(spark, no_docs).count() == 0


def test_features_are_added_up_in_parts(monkeypatch):
    """Sums that a worker lets go of early are the same in the end."""
    batch = pa.RecordBatch.from_arrays([pa.array([f"alpha beta w{'xyz'[i % 3]}q" for i in range(30)]), pa.array([i % 2 for i in range(30)], pa.int32())], ["text", "toxic"])
    lp = np.log(np.full((toxicity.SYMBOLS,) * 3, 1 / toxicity.SYMBOLS))
    found = []
    for bound in (50_000, 3):
        monkeypatch.setattr(toxicity, "FEATURES_HELD", bound)
        total = collections.Counter()
        parts = list(toxicity._sum_features(lp)([batch]))
        for p in parts:
            for f, clean, toxic in zip(*(c.to_pylist() for c in p.columns)):
                total[f, 0] += clean
                total[f, 1] += toxic
        found.append((len(parts), +total))
    assert found[0][0] == 1 < found[1][0] and found[0][1] == found[1][1]
