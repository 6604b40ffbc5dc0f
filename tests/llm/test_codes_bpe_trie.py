"""Vector codes, BPE and the prefix trie against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from atlaspanel.llm import bpe, prefixtrie, vectorcodes
from atlaspanel.llm.queries import tokenizer_path

# ---- vector codes -----------------------------------------------------------------


def codes_brute(rows, parts, entries, rounds, scale):
    """rows: (id, vector) -> sorted (id, code, error) and the last codebook, by plain loops."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = max(1, -(-max((len(v) for _, v in kept), default=0) // parts))
    ints = [(i, [int(np.floor(scale * x)) for x in v] + [0] * (parts * size - len(v))) for i, v in kept]
    first = sorted(zip(kept, ints), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][1]))[:entries]
    cut = lambda v, p: v[p * size : (p + 1) * size]
    book = [[cut(v, p) for _, (_, v) in first] for p in range(parts)]

    def nearest(v):
        found = [min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(book[p])) for p in range(parts)]
        return [k for _, k in found], sum(d for d, _ in found)

    for _ in range(rounds):
        codes = [nearest(v)[0] for _, v in ints]
        for p in range(parts):
            for k in range(len(first)):
                mine = [cut(v, p) for (_, v), c in zip(ints, codes) if c[p] == k]
                if mine:
                    book[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted((-1 if i is None else i, tuple(nearest(v)[0]), nearest(v)[1]) for i, v in ints), np.array(book)


def codes(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, code int")
    coded, history = vectorcodes.compress(spark, df, **how)
    return vectorcodes.with_label_error(coded).collect(), history


def float32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, *_ in rows]


def test_codes_are_those_of_full_scans(spark):
    rng = np.random.default_rng(3)
    around = rng.normal(size=(12, 8))
    rows = [(int(i), [float(x) for x in around[i % 12] + rng.normal(scale=0.3, size=8)], int(i) % 3, "x", 1) for i in rng.permutation(400)]
    rows += [(1000 + i, [0.25] * 8, None, None, None) for i in range(150)]  # one very common vector
    got, history = codes(spark, rows, parts=4, entries=20, rounds=3, scale=64)
    want, book = codes_brute(float32(rows), 4, 20, 3, 64)
    assert sorted((r["id"], tuple(r["code"]), r["error"]) for r in got) == want
    assert len(history) == 4 and (history[-1] == book).all()
    per = collections.Counter()
    for r in got:
        per[r["label"]] += r["error"]
    assert all(r["label_error"] == per[r["label"]] for r in got) and len(per) == 4


def test_codes_of_odd_rows(spark):
    rows = [
        (1, None, 1, "a", 1), (2, [1.0, None, 0.5, 0.1], 1, "a", 1), (3, [float("nan"), 1.0, 1.0, 1.0], 1, "a", 1), (4, [float("inf"), 1.0, 1.0, 1.0], 1, "a", 1),
        (5, [], None, None, None), (6, [1.0, -2.5], 2, "a", 1), (7, [0.5, -0.5, 0.25, 3.0, 1.0], 2, "a", 1), (7, [0.5, -0.5, 0.25, 3.0, 1.0], 2, "a", 1),
        (7, [0.25, 0.5, 0.25, 3.0, 1.0], 2, "a", 1), (None, [9.0, 9.0, 9.0, 9.0], None, "a", 1), (8, [1.0, -2.5], 2, "a", 1),
    ]
    got, history = codes(spark, rows, parts=2, entries=4, rounds=2, scale=256)
    want, book = codes_brute(float32(rows), 2, 4, 2, 256)
    assert sorted((-1 if r["id"] is None else r["id"], tuple(r["code"]), r["error"]) for r in got) == want and (history[-1] == book).all()
    assert codes(spark, rows[:4], parts=2)[0] == []
    got, history = codes(spark, rows[5:7], parts=16)  # fewer rows than entries
    assert sorted(r["error"] for r in got) == [0, 0] and history[0].shape == (16, 2, 1)
    with pytest.raises(Exception, match="too large for exact distances"):
        codes(spark, [(1, [1e30] * 4, 1, "a", 1)], parts=2)


def test_bounds_skip_and_never_change_a_code():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(3000, 2, 4)) * 40).astype(np.int64)
    x[500:900] = x[3]  # ties between equal entries
    history = [x[:32].transpose(1, 0, 2).copy()]
    code, low, stamp, _ = vectorcodes.Codebooks(history).first(x)
    for r in range(4):
        book = history[-1].copy()
        for p in range(2):
            for e in range(32):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    book[p, e] = mine.sum(0) // len(mine)
        history.append(book)
        books = vectorcodes.Codebooks(history)
        code, low, stamp, error = books.again(x, code, low, stamp)
        full, _, _, full_error = vectorcodes.Codebooks(history).first(x)
        assert (code == full).all() and (error == full_error).all()
        assert books.scanned < 0.7 * books.possible
        # a bound is never above the true distance to the nearest other entry of its group
        for p in range(2):
            d = np.sqrt(vectorcodes.distances(x[:, p], book[p]).astype(float))
            d[np.arange(len(x)), code[:, p]] = np.inf
            fallen = low[:, p] - books.moved[stamp[:, p], p, np.arange(len(books.groups))]
            assert all((fallen[:, k] <= d[:, g].min(1) + 1e-4).all() for k, g in enumerate(books.groups))
    assert stamp.min() < 4  # some bounds are as old as an earlier round


# ---- BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    return path, bpe.Encoder(path), lambda t: library.encode(t, add_special_tokens=False).ids, lambda ids: library.decode(ids, skip_special_tokens=False)


PIECES = st.sampled_from(["the", "Ing", "'s", "'LL", "é", "é", "Σς", "ﬁ", "İ", "12", "½", "日本", "🙂", "!!", "--", " ", "\n", "\t", "\x1c", "\x85", " ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "a", "zz"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_ids_and_text_are_the_librarys(text):
    encoder, ids_of, text_of = _word_bpe()
    (packed,), (decoded,) = encoder.encode([text])
    ids = np.frombuffer(packed, np.int32).tolist()
    assert ids == ids_of(text) and decoded == text_of(ids) and encoder.decode(ids) == decoded


def _word_bpe(memory={}):  # noqa: B006 one per run
    if not memory:
        from tokenizers import Tokenizer

        path = tokenizer_path("word_bpe_49k.json")
        library = Tokenizer.from_file(path)
        memory["it"] = bpe.Encoder(path), lambda t: library.encode(t, add_special_tokens=False).ids, lambda ids: library.decode(ids, skip_special_tokens=False)
    return memory["it"]


def test_both_trees_merge_the_leftmost_lowest_rank():
    vocabulary = {t: i for i, t in enumerate(["a", "b", "aa", "ab", "aab", "ba", "aaaa"])}
    merges = bpe.Merges(vocabulary, ["a a", "a b", "aa b", "b a", "aa aa"])
    rng = random.Random(1)

    def plain(symbols):
        s = list(symbols)
        while found := [(merges.rank[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in merges.rank]:
            _, i = min(found)
            s[i : i + 2] = [merges.rank[s[i], s[i + 1]][1]]
        return s

    pieces = [[rng.randrange(2) for _ in range(n)] for n in range(1, 60) for _ in range(5)]
    want = [plain(p) for p in pieces]
    assert [bpe.merge_long(p, merges) for p in pieces] == want
    assert [ids.tolist() for ids in bpe.merge_together(pieces, merges)] == want


def test_bpe_documents(spark, odd_docs, no_docs, clashing, word_bpe, sf):
    path, _, ids_of, text_of = word_bpe
    for docs in (odd_docs, clashing.withColumns({"ids": F.lit(1), "decoded": F.lit("x")}), spark.read.parquet(f"{sf}/documents.parquet")):
        got = bpe.encode_documents(spark, docs, path)
        assert set(got.columns) == set(docs.columns) - {"text"} | {"ids", "decoded"}
        want = collections.Counter((r.doc_id, tuple(ids_of(r.text or "")), text_of(ids_of(r.text or ""))) for r in docs.select("doc_id", "text").collect())
        assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got.collect()) == want
    assert bpe.encode_documents(spark, no_docs, path).collect() == []


def test_long_units(word_bpe):
    _, encoder, ids_of, _ = word_bpe
    for t in ("a" * 20_000, "!?" * 5_000, "hello" * 4_000, "é" * 3_000, "x" * 65, "x" * 64):
        assert np.frombuffer(encoder.encode([t])[0][0], np.int32).tolist() == ids_of(t)


def test_latin_texts_are_cut_as_the_library_cuts_them(word_bpe, monkeypatch):
    _, encoder, ids_of, text_of = word_bpe
    units = []
    cut = bpe.Encoder.cut
    monkeypatch.setattr(bpe.Encoder, "cut", lambda self, unit: units.append(unit) or cut(self, unit))
    signs = ["'", "'s", "'LL", "''ve", ".'t", "'.", "'", " ", "7", "\x00", "\x1c", "\x0b", "\x7f"]
    latin = [chr(c) for c in range(0x180) if c < 0x80 or not bpe.ODD.match(chr(c))]
    batch = [f"A{c}b{s}{c}{c} {s}{c}s{c}" for c in latin for s in signs] + ["Don't STOP, stop. (Stop) über-Éa 42x"]
    packed, decoded = encoder.encode(batch)
    for t, x, y in zip(batch, packed, decoded):
        assert np.frombuffer(x, np.int32).tolist() == ids_of(t) and y == text_of(ids_of(t))
    assert units == []  # not unit by unit: case, signs and neighbours make no new work
    others = [f"a{chr(c)}'s .{chr(c)} E{chr(c)}" for c in (0x80, 0x85, 0xA0, 0xAA, 0xB2, 0xB5, 0xD7, 0xF7, 0x130, 0x180, 0x300, 0x301, 0x331, 0x2019, 0x212A, 0x4E00)]
    packed, decoded = encoder.encode(others)
    for t, x, y in zip(others, packed, decoded):
        assert np.frombuffer(x, np.int32).tolist() == ids_of(t) and y == text_of(ids_of(t))
    assert units


def test_worker_remembers_what_is_asked_for(word_bpe, monkeypatch):
    path, _, ids_of, _ = word_bpe
    monkeypatch.setattr(bpe, "MEMORY_PIECES", 200)
    encoder, learnt = bpe.Encoder(path), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda pieces: learnt.append(set(pieces)) or learn(pieces))
    letters = "abcdefghij"
    for k in range(20):
        t = "common word’s " + " ".join(f"q{letters[k // 10]}{letters[k % 10]}{a}{b}" for a in letters for b in letters) + " " + "z" * 500
        assert np.frombuffer(encoder.encode([t])[0][0], np.int32).tolist() == ids_of(t)
        held = encoder.memory.new.keys() | encoder.memory.old.keys()
        assert len(held) < 500 and "z" * 500 not in held
    assert sum("common" in new for new in learnt) == 1 and sum("z" * 500 in new for new in learnt) == 20


# ---- prefix trie --------------------------------------------------------------------


def turn_digest(role, text):
    r, t = role or "", text or ""
    return hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()[:16]


def trie_brute(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, turn_digest(role, text), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    host = lambda c: c - (c % 20 if c >= 0 else -(-c % 20))
    built = {c: own.get(host(c), [])[: (h := zlib.crc32(str(c).encode()) % 4)] + v[h:] for c, v in own.items()}
    members = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    out = []
    for k, cs in members.items():
        below = [m for m in members if m[: len(k)] == k]
        ends = sorted(c for c in cs if len(built[c]) == len(k))
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode().split()) for m in below if m)
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), children[k], sum(not children[m] for m in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, digest string, shard int")
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefixtrie.prefix_trie(spark, df, **how).collect()), key=str)


def random_rows(seed, n, turns, vocabulary):
    rng = random.Random(seed)
    return [(c, t, rng.choice("ua"), " ".join(rng.choices(vocabulary, k=rng.randrange(3)))) for c in rng.sample(range(-60, 300), n) for t in range(rng.randrange(turns + 1))]


@pytest.mark.parametrize("shard", [1, 7, 100_000])
def test_trie_is_the_plain_one(spark, shard):
    rows = random_rows(shard, 120, 6, ["a", "b"])
    assert trie(spark, rows, shard=shard) == trie_brute(rows)


def test_trie_of_odd_rows(spark):
    rows = [
        (None, 0, "u", "x"), (40, None, None, None), (40, 0, "", ""), (40, 1, "u", " \t\n"), (41, 5, None, "a b  c"), (41, 5, "u", "a b  c"), (41, 5, "u", "a b  c"),
        (42, 1, "u", "x"), (45, 0, "u", "y"), (47, 0, "u", "z " * 40_000), (-3, 0, "u", "n"), (-20, 0, "u", "m"), (-21, 2, "u", "m"), (63, 0, "u", "alone"),
    ]
    assert trie(spark, rows) == trie_brute(rows)
    assert trie(spark, []) == [] and trie(spark, rows[:1]) == []


def test_hot_conversation_and_hot_copies(spark):
    long = [(100, t, "u", f"w{t % 7} x") for t in range(180)] + [(121, t, "u", f"w{t % 7} x") for t in range(150)]
    same = [(c, t, "u", f"t{t}") for c in range(200, 320) for t in range(3)]
    rows = long + same
    want = trie_brute(rows)
    assert trie(spark, rows, shard=10) == want  # stretches of one conversation hang below each other
    assert trie(spark, rows) == want


def test_ids_of_a_node_are_hashed_in_runs(spark, monkeypatch):
    n = 50_000
    ends = spark.range(n).select(F.lit(b"1" * 16).alias("digest"), F.col("id").alias("conv_id"))
    (row,) = prefixtrie.ends_hashes(ends).collect()
    assert row.ends_sha256 == hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()


def test_node_table_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, (5000, 2), dtype=np.int64).astype(np.uint64), axis=0)
    table = prefixtrie.NodeTable(keys[:4000])
    assert sorted(table.slots(keys[:4000])) == list(range(4000))
    assert (table.slots(keys[4000:]) == -1).all()
    with pytest.raises(ValueError, match="equal digests"):
        prefixtrie.NodeTable(np.concatenate([keys[:5], keys[:5]]))


# ---- the registered queries' SQL -------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_prefix_trie"])
def test_new_queries_match_their_sql(spark, sf, name):
    import duckdb

    from atlaspanel.llm import queries

    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, found.fetchall()))
