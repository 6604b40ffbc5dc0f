"""Token counts, packing, sharding, mixing: against the libraries and against the contracts' laws."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlaspanel.llm import mixing, packing, sharding, token_counts


def rows(df):
    return [r.asDict() for r in df.collect()]


# ---- token counts ----------------------------------------------------------


@pytest.fixture(scope="module")
def library(pieces):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces)


def test_counts_equal_the_library(spark, odd_docs, library, pieces):
    got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows(token_counts.count_tokens(spark, odd_docs, pieces)))
    want = Counter((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in odd_docs.collect())
    assert got == want


def test_counts_on_the_documents(spark, sf, library, pieces):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text)) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in rows(token_counts.count_tokens(spark, docs, pieces))} == want


def test_cache_encodes_only_distinct_misses(spark, odd_docs, pieces, tmp_path):
    path = str(tmp_path / "cache")
    token_counts.count_tokens(spark, odd_docs.filter("doc_id <= 6"), pieces, path).collect()
    read = lambda: spark.read.parquet(path)
    held = read().count()
    assert held == read().select("content").distinct().count() == 5
    token_counts.count_tokens(spark, odd_docs, pieces, path).collect()
    assert read().count() == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    # a cached count is used as it stands
    token_counts.count_tokens(spark, odd_docs, pieces, path).collect()
    assert read().count() == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_json_tokenizer_and_extra_columns(spark, clashing, bpe):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe)
    got = token_counts.count_tokens(spark, clashing, bpe)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows(got)) == Counter((r.doc_id, len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in clashing.collect())


def test_no_documents(spark, no_docs, pieces, bpe):
    assert token_counts.count_tokens(spark, no_docs, pieces).count() == 0
    assert packing.pack_documents(spark, no_docs, bpe).count() == 0
    assert sharding.shard_documents(spark, no_docs).count() == 0
    assert mixing.mix_documents(spark, no_docs).count() == 0
    assert mixing.mix_documents(spark, no_docs, keep_rows=True).count() == 0


# ---- packing ---------------------------------------------------------------


def check_packing(docs, packed, bpe, capacity=packing.CAPACITY):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe)
    want = Counter()
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k, (s, n) in enumerate(packing.cuts(len(ids), capacity)):
            want[r.doc_id, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
    got = rows(packed)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by), sum(r["length"] for r in got)


def test_packing_holds_every_piece_once(spark, odd_docs, bpe):
    check_packing(odd_docs, packing.pack_documents(spark, odd_docs, bpe), bpe)


def test_packing_is_close_to_the_bound(spark, sf, bpe):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sequences, tokens = check_packing(docs, packing.pack_documents(spark, docs, bpe), bpe)
    assert sequences <= 1.02 * tokens / packing.CAPACITY + 1


@pytest.mark.parametrize("histogram", [{}, {2048: 3}, {1: 5000}, {1025: 7}, {1: 1, 2047: 1, 1024: 2}, {683: 9, 682: 5, 700: 4}])
def test_plan_covers_the_histogram(histogram):
    p = packing.plan(histogram)
    used = Counter()
    for n, times in zip(p.get("length", []), p.get("times", [])):
        used[int(n)] += 0
    assert set(used) == set(histogram)


def test_program_reaches_the_optimum():
    # 3 + 3 + 4 and 5 + 5 fill a sequence of 10 exactly
    lengths, counts = np.array([3, 4, 5]), np.array([200, 100, 80])
    configs, left = packing.round_down(packing.solve(lengths, counts, 10), counts)
    total = sum(n for _, n in configs) + sum(n for _, n in packing.best_fit(lengths, left, 10))
    assert total == 140


@pytest.mark.parametrize("lengths, each, best", [((330, 700, 1000), 600, 600), ((400, 650, 900), 300, 305)])
def test_program_packs_wasteful_fillings(lengths, each, best):
    """Where the best filling of a sequence leaves more than a few tokens empty."""
    slots = packing.plan({n: each for n in lengths}, 2048)
    assert (slots["sequence"] >= 0).all()
    configs, _ = packing.packed(np.array(lengths), np.full(len(lengths), each), 2048)
    assert sum(n for _, n in configs) <= best


def test_knapsack_is_exact():
    lengths, prices = np.array([2, 3, 7]), np.array([0.3, 0.5, 1.3])
    best, take = packing._knapsack(lengths, prices, 12)
    brute = max(a * 0.3 + b * 0.5 + c * 1.3 for a in range(7) for b in range(5) for c in range(2) if 2 * a + 3 * b + 7 * c <= 12)
    assert best[12] == pytest.approx(brute)


def test_encoder_equals_the_tokenizer(bpe):
    e = packing.Encoder(bpe)
    assert e.plain is not None
    for s in ["a\n b", "a \n b", "  x", "a  b", "x ", "don't 's", "<|endoftext|> a", "日本 語 x", "a\x1c b", "½ x", "　 y", "f\n\n b", "a\t b", "' s", "é́ x", "x ²y", "_a b_c"]:
        assert e.encode(s) == np.array(e.tok.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), s


# ---- sharding --------------------------------------------------------------


def test_shards_by_bytes(spark, odd_docs):
    got = rows(sharding.shard_documents(spark, odd_docs, shards=3))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in odd_docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        if r["size"] > 16:
            shard_of[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())


def test_shards_are_level(spark, sf):
    got = rows(sharding.shard_documents(spark, spark.read.parquet(f"{sf}/documents.parquet"), shards=8))
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) < 0.05 * sum(load.values()) / 8


def test_longest_first():
    shard = sharding.longest_first([(7, "a"), (6, "b"), (5, "c"), (4, "d"), (3, "e")], 2)
    load = Counter()
    for n, k in [(7, "a"), (6, "b"), (5, "c"), (4, "d"), (3, "e")]:
        load[shard[k]] += n
    assert sorted(load.values()) == [11, 14]


# ---- mixing ----------------------------------------------------------------


def brute_targets(sizes: dict, share=1.5, cap=2.0, weights=(5, 2, 1)):
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full, target = share * sum(sizes.values()), set(), {}
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: cap * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in open_) for s in order}
        over = {s for s in open_ if target[s] >= cap * sizes[s]}
        if not over or not open_:
            return target
        full |= over
        if len(full) == len(order):
            return {s: cap * sizes[s] for s in order}


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_mixing_meets_the_targets(spark, odd_docs, sf, which):
    docs = odd_docs if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet")
    source_of = [(r.doc_id, len((r.text or "").encode().split()), r.source) for r in docs.collect()]
    sizes = Counter()
    for _, n, s in source_of:
        sizes[s] += n
    want = brute_targets(sizes)
    got = rows(mixing.mix_documents(spark, docs))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, n) for d, n, _ in source_of)
    assert sorted(round(r["target"], 6) for r in got) == sorted(round(want[s], 6) for _, _, s in source_of)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    if which == "sf":
        taken = Counter()
        for r in got:
            taken[r["source_size"], r["target"]] += r["taken"]
        largest = max(n for _, n, _ in source_of)
        assert all(abs(n - t) <= max(0.05 * t, largest) for (_, t), n in taken.items())
    again = rows(mixing.mix_documents(spark, docs.repartition(5)))
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixing_repeats_rows(spark, clashing):
    mixed = mixing.mix_documents(spark, clashing, keep_rows=True)
    assert mixed.columns == clashing.columns
    plan = Counter()
    for r in rows(mixing.mix_documents(spark, clashing)):
        plan[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in rows(mixed)) == +plan


def test_balance_of_two_margins(spark):
    cells = spark.createDataFrame([(10, "a", "x"), (30, "a", "y"), (20, "b", "x"), (40, "b", "y")], "size long, s string, l string")
    margins = {"s": spark.createDataFrame([("a", 50.0), ("b", 30.0)], "key string, target double"), "l": spark.createDataFrame([("x", 35.0), ("y", 45.0)], "key string, target double")}
    dual = {c: {r["key"]: r["lambda"] for r in d.collect()} for c, d in mixing.entropy_balance(cells, margins, tolerance=1e-8).items()}
    import math

    rate = {(r.s, r.l): r["size"] * math.exp(dual["s"][r.s] + dual["l"][r.l]) for r in cells.collect()}
    assert rate["a", "x"] + rate["a", "y"] == pytest.approx(50, rel=1e-6)
    assert rate["a", "y"] + rate["b", "y"] == pytest.approx(45, rel=1e-6)


def test_the_program_makes_most_sequences(spark, bpe):
    """On the test tables the program's whole configurations hold most pieces, in no more sequences than best-fit needs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    end = np.array([0], "<u4").tobytes()
    pieces = docs.select("doc_id", "text").mapInArrow(packing._pieces(bpe, packing.CAPACITY, end), packing.PIECES)
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[int(n)] for n in lengths])
    configs, made = packing.packed(lengths, counts, packing.CAPACITY)
    total = sum(n for _, n in configs)
    alone = sum(n for _, n in packing.best_fit(lengths, counts, packing.CAPACITY))
    assert total <= alone and made > total / 2, (total, made, alone)
    assert packing.packed(lengths[:0], counts[:0], packing.CAPACITY) == ([], 0)


def test_a_hot_id_is_rounded_in_many_groups(spark):
    """A third of all rows with one id (and a null id): bounded groups, targets still met."""
    n = 3 * mixing.DOCS_PER_BUCKET
    docs = spark.range(2 * n).select(
        F.when(F.col("id") < n, 7).when(F.col("id") < n + 7000, None).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit("one two three").alias("text"),
        F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"), F.lit(13).cast("long").alias("n_chars"),
    )
    got = rows(mixing.mix_documents(spark, docs))
    assert len(got) == 2 * n
    by = Counter()
    for r in got:
        by[r["source_size"], r["target"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    taken, target = sum(by.values()), 1.5 * 2 * n * 3
    assert abs(taken - target) < 0.001 * target


def test_packing_and_sharding_with_clashing_columns(spark, clashing, odd_docs, bpe):
    same = lambda a, b: sorted(map(str, map(tuple, a.collect()))) == sorted(map(str, map(tuple, b.collect())))
    assert same(packing.pack_documents(spark, clashing, bpe).select("doc_id", "piece", "start", "length", "ids_crc32"), packing.pack_documents(spark, odd_docs, bpe).select("doc_id", "piece", "start", "length", "ids_crc32"))
    assert same(sharding.shard_documents(spark, clashing).select("doc_id", "size", "text_crc32"), sharding.shard_documents(spark, odd_docs).select("doc_id", "size", "text_crc32"))
