"""run() against an independent version: planted junk, toxic texts, near and exact copies, and clean documents."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_search_and_models import counts_brute, fingerprint_brute, fits_brute, groups_brute
from test_text_operators import brute_targets

import corpus_pipeline
from atlaspanel.llm import packing, quality, toxicity
from atlaspanel.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    """(kind, doc_id, text, lang, source) and the labels of some of them."""
    rng = random.Random(17)
    vocabulary = ["".join(rng.choices("bcdfglmnprst", k=1) + rng.choices("aeiou", k=1)) + "".join(rng.choices(["ra", "ne", "ti", "lo", "mu"], k=rng.randrange(1, 4))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."
    rows, source = [], lambda i: "ab"[i % 2]
    for i in range(160):
        rows.append(("clean", i, text(rng.randrange(60, 160)), "en", source(i)))
    insults = ["loser", "idiot", "moron", "scum"]
    hide = [lambda w: w, lambda w: w.replace("o", "0"), lambda w: " ".join(w), lambda w: w.replace("i", "1").replace("s", "$")]
    for i in range(200, 260):
        words = text(80).split()
        for w in rng.sample(insults, 2):
            words.insert(rng.randrange(5, 70), rng.choice(hide)(w) if i % 2 else w)
        rows.append(("toxic", i, " ".join(words), "en", source(i)))
    whole = {r[1]: r for r in rows}
    for k, i in enumerate(range(0, 20, 2)):  # a later copy of clean texts: exact, or one word of a long text another
        of = whole[i]
        rows.append(("copy", 300 + k, of[2] if k % 2 else of[2] + " " + vocabulary[k], "en", of[4]))
    for i in range(400, 412):
        rows.append(("junk", i, ["too short", "same five words here again " * 20, "#### $$$$ %%%% " * 40, ""][i % 4], "en", source(i)))
    rows.append(("junk", None, None, None, None))
    labels = [(i, 1, int(kind == "toxic")) for kind, i, *_ in rows if i is not None and kind in ("clean", "toxic") and i % 5]
    return rows, labels


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    rows, labels = planted()
    path = str(tmp_path_factory.mktemp("planted"))
    docs = spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None) for _, i, t, lang, s in rows], SCHEMA)
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def survivors(rows):
    """What quality, toxicity and near-duplicate removal leave, by plain loops."""
    kept = []
    counted = [(r, counts_brute(r[2])) for r in rows]
    sound = [(r, c) for r, c in counted if not (c[0] < 10 or 100 * c[4] > 20 * c[0])]
    verdicts = fits_brute([(r[3], r[4], quality.measure(r[2])[1]) for r, _ in sound], quality.FULL)
    kept = [r for (r, _), ok in zip(sound, verdicts) if ok]
    clean = [r for r in kept if r[0] != "toxic"]
    root = groups_brute([fingerprint_brute(r[2]) for r in clean])
    first = {}
    for r in clean:
        k = root[fingerprint_brute(r[2])]
        first[k] = min(first.get(k, r[1]), r[1])
    return {r[1] for r in kept}, {r[1] for r in clean}, set(first.values())


def test_stages_against_plain_loops(spark, fixture):
    path, rows = fixture
    good, harmless, single = survivors(rows)
    kinds = {r[1]: r[0] for r in rows}
    assert Counter(kinds[i] for i in good)["junk"] == 0 and Counter(kinds[i] for i in single)["clean"] == 160
    assert Counter(kinds[i] for i in single)["copy"] <= 1  # a near copy may lie beyond the bits
    at = spark.read.parquet(f"{path}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, (good, harmless, single)):
        at = stored(stage(spark, at, path), "test-planted")
        got = Counter(r.doc_id for r in at.select("doc_id").collect())
        assert set(got) == want and max(got.values()) == 1, name


def test_run_against_plain_loops(spark, fixture, bpe):
    from tokenizers import Tokenizer

    path, rows = fixture
    _, _, single = survivors(rows)
    by_id = {r[1]: r for r in rows}
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, path).collect()]
    # mixing: every source near its target, no document more than twice, none that did not survive
    copies = Counter(p["doc_id"] for p in pieces if p["piece"] == 0)
    assert set(copies) <= single and max(copies.values()) <= 2
    size = lambda i: len(by_id[i][2].encode().split())
    sizes = Counter()
    for i in single:
        sizes[by_id[i][4]] += size(i)
    taken = Counter()
    for i, n in copies.items():
        taken[by_id[i][4]] += n * size(i)
    largest = max(map(size, single))
    assert all(abs(taken[s] - t) <= largest for s, t in brute_targets(sizes).items())
    # packing: the library's ids in whole pieces, gapless, and as few sequences as the tokens need at least
    library = Tokenizer.from_file(bpe)
    library.encode_special_tokens = False
    lengths = {i: len(library.encode(by_id[i][2], add_special_tokens=False).ids) + 1 for i in copies}
    assert Counter((p["doc_id"], p["start"], p["length"]) for p in pieces) == Counter({(i, 0, lengths[i]): n for i, n in copies.items()})
    rooms = defaultdict(list)
    for p in pieces:
        rooms[p["sequence_id"]].append((p["offset"], p["length"]))
    for held in rooms.values():
        ends = np.cumsum([n for _, n in sorted(held)])
        assert [o for o, _ in sorted(held)] == [0, *ends[:-1].tolist()] and ends[-1] <= packing.CAPACITY
    least = -(-sum(lengths[i] * n for i, n in copies.items()) // packing.CAPACITY)
    assert len(rooms) <= least * 1.02 + 1


def test_toxic_texts_score_above_clean_ones(spark, fixture):
    path, rows = fixture
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    model = toxicity.fit(docs, labels.filter("doc_id % 3 <> 1").select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in toxicity.score(spark, docs, model, {"doc_id": docs.doc_id}).collect()}
    unseen = [(got[i], kind) for kind, i, *_ in rows if kind in ("clean", "toxic") and i % 3 == 1]
    assert min(s for s, k in unseen if k == "toxic") > max(s for s, k in unseen if k == "clean")
