"""Quality rules: base counts and robust multivariate outliers.

Each text becomes a vector of transformed statistics. Per language and source
the minimum-covariance-determinant estimate is found by concentration steps: the
``h`` rows nearest to the present centre give the next centre and scatter. A
step is one distributed aggregate, since rows are binned by their distance and
each bin carries its moments; the bins that hold the nearest ``h`` rows are then
added up. A text is rejected when its Mahalanobis distance is beyond the cut.

Every language and source has its own estimate. A group with fewer than ``FULL``
sound rows has too few for eight statistics; its estimate is shrunk towards its
language's, and that one likewise towards the estimate of all rows, in
proportion to the rows that are missing. No count switches a group's judge.

Defined results: a null or empty text has no words and fails the base rule;
null languages and sources are groups of their own; repeated rows count as
often as they occur, and rows with equal distances are taken or left together;
an empty table gives an empty result; very long texts are read whole, one at a
time; further columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import stored, texts
from atlaspanel.operators.joins import bounded_broadcast

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Sound rows from which a group's estimate stands alone: ten for each statistic.
FULL = 80
#: Share of a group's rows that the estimate rests on.
H_SHARE = 0.75
#: Concentration steps (they converge in a few; each lowers the determinant).
STEPS = 6
#: Tail probability of a clean text beyond the cut, under the estimate, as a normal score.
CUT_Z = 7.0
#: Distance bins per factor of e in the squared distance.
BINS = 8
#: Least standard deviation of each statistic: below it differences carry no meaning.
FLOORS = np.array([0.10, 0.05, 0.08, 0.06, 0.08, 0.12, 0.08, 0.08])
NAMES = ["word_length", "symbols", "capitals", "digits", "dup_lines", "variety", "repeats", "echoes"]
P = len(NAMES)

_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_FIRST = (_BYTES & 0xC0) != 0x80
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(ids: np.ndarray, window: int = 5) -> int:
    """Words in windows of ``window`` words found twice or more (``ids``: a number per word)."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            h = (h ^ (h >> np.uint64(29))) * _MIX + ids[k : k + n]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: str) -> tuple[list[int], list[float]]:
    """The base counts of a text and its vector of transformed statistics."""
    raw = text.encode()
    found = raw.split()
    n = len(found)
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(by[_FIRST].sum() - by[_SPACE].sum())
    symbols = int(by[_SYMBOL].sum())
    seen: set[str] = set()
    dup = filled = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            filled += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    # equal words, equal numbers: the built-in hash of a word's bytes
    ids = np.fromiter(map(hash, found), np.int64, n).view(np.uint64)
    repeats = repeated_words(ids)
    distinct = len(set(found))
    # Shares are shrunk by a few pseudo-words so that short texts are not judged on one word.
    share = lambda k, of, prior: math.sqrt(k / (of + prior)) if of else 0.0
    expect = n / (1 + 0.35 * math.log1p(n / 30)) if n else 1.0
    x = [
        math.log((chars + 5 * 20) / (n + 20)),
        share(symbols, n, 20),
        share(int(by[_CAPITAL].sum()), chars, 60),
        share(int(by[_DIGIT].sum()), chars, 60),
        share(max(dup - 1, 0), filled, 8),
        math.log((distinct + 20) / (expect + 20)),
        share(repeats, n, 30),
        share(int((ids[1:] == ids[:-1]).sum()), n, 20),
    ]
    return [n, chars, symbols, dup, repeats], x


def _measure(batches):
    for b in batches:
        rows = [measure(t) for t in texts(b.column("text"))]
        counts = list(zip(*(r[0] for r in rows))) or [[]] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [b.column("__row"), b.column("doc_id"), b.column("lang"), b.column("source")]
            + [pa.array(c, pa.int64()) for c in counts]
            + [pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
            ["__row", "doc_id", "lang", "source", *COUNTS, "x"],
        )


def vectors(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source", row_col: str | None = None) -> DataFrame:
    """(row, doc_id, lang, source, counts, x) of every document, stored. ``row_col``: a number per row, if ``docs`` has one."""
    rows = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("__row"), F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"),
    )
    schema = "__row long, doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS) + ", x array<double>"
    return stored(rows.mapInArrow(_measure, schema), "quality-vectors")


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def chi2_quantile(z: float, p: int) -> float:
    """Chi-square quantile at the normal score ``z`` (Wilson and Hilferty's cube)."""
    a = 2 / (9 * p)
    return p * (1 - a + z * math.sqrt(a)) ** 3


def _whiten(cov: np.ndarray) -> tuple[np.ndarray, float]:
    cov = cov + np.diag(FLOORS**2)
    root = np.linalg.inv(np.linalg.cholesky(cov))
    return root, float(np.linalg.slogdet(cov)[1])


PARAMS = "fit string, n long, mu array<double>, cov array<double>, root array<double>, logdet double, scale double"


def _start(table: pa.Table) -> pa.Table:
    """Deterministic start: coordinate-wise medians and median absolute deviations."""
    r = table.to_pylist()[0]
    mid = np.array(r["mid"], float)
    dev = np.maximum(np.array(r["high"], float) - np.array(r["low"], float), 0) / 1.349
    return _params(r["fit"], r["n"], mid, np.diag(dev**2), 1.0)


def _params(fit: str, n: int, mu: np.ndarray, cov: np.ndarray, scale: float) -> pa.Table:
    root, logdet = _whiten(cov)
    row = {"fit": fit, "n": n, "mu": mu.tolist(), "cov": cov.ravel().tolist(), "root": root.ravel().tolist(), "logdet": logdet, "scale": scale}
    return pa.Table.from_pylist([row], schema=_params_schema())


def _params_schema():
    f = pa.list_(pa.float64())
    return pa.schema([("fit", pa.string()), ("n", pa.int64()), ("mu", f), ("cov", f), ("root", f), ("logdet", pa.float64()), ("scale", pa.float64())])


def _pairs():
    return [(i, j) for i in range(P) for j in range(i, P)]


def _concentrate(table: pa.Table) -> pa.Table:
    """Next centre and scatter from the bins that hold the nearest h rows (a few hundred bins)."""
    table = table.sort_by("bin")
    n = np.array(table["n"].to_pylist(), np.int64)
    total = int(n.sum())
    upto = np.cumsum(n)
    last = int(np.searchsorted(upto, math.ceil(H_SHARE * total)))
    take = slice(0, last + 1)
    m = int(upto[last])
    sums = np.array([np.sum(table[f"s{i}"].to_numpy()[take]) for i in range(P)])
    mu = sums / m
    cov = np.zeros((P, P))
    for i, j in _pairs():
        cov[i, j] = cov[j, i] = np.sum(table[f"q{i}_{j}"].to_numpy()[take]) / m - mu[i] * mu[j]
    # consistency: the median squared distance of a clean group is that of the chi-square
    middle = int(np.searchsorted(upto, total / 2))
    median = math.exp(table["bin"].to_pylist()[middle] / BINS)
    scale = max(median / chi2_quantile(0.0, P), 1.0)
    return _params(table["fit"][0].as_py(), total, mu, cov, scale)


def _distance():
    """Squared Mahalanobis distance of ``x`` under ``mu`` and ``root`` as one column expression."""
    y = [f"(x[{i}] - mu[{i}])" for i in range(P)]
    return F.expr(" + ".join(f"pow({' + '.join(f'root[{i * P + j}] * {y[j]}' for j in range(i + 1))}, 2)" for i in range(P)))


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimate (centre, whitening root, scale) of every ``fit`` group of ``rows`` (fit, x)."""
    quart = lambda q, name: F.array(*[F.percentile_approx(F.col("x")[i], q, 1000) for i in range(P)]).alias(name)
    first = rows.groupBy("fit").agg(F.count("*").alias("n"), quart(0.25, "low"), quart(0.5, "mid"), quart(0.75, "high"))
    params = stored(first.groupBy("fit").applyInArrow(_start, PARAMS), "quality-params")
    moments = [F.sum(F.expr(f"x[{i}]")).alias(f"s{i}") for i in range(P)] + [F.sum(F.expr(f"x[{i}] * x[{j}]")).alias(f"q{i}_{j}") for i, j in _pairs()]
    for _ in range(steps):
        d2 = rows.join(params.select("fit", "mu", "root"), "fit").withColumn("bin", F.floor(F.log(_distance() + 1e-6) * BINS).cast("int"))
        params = stored(d2.groupBy("fit", "bin").agg(F.count("*").alias("n"), *moments).groupBy("fit").applyInArrow(_concentrate, PARAMS), "quality-params")
    return params


def blend(own: tuple, wider: tuple, n: int, full: int) -> tuple:
    """(centre, scatter, scale) of ``n`` rows, shrunk towards a wider group's for the rows missing to ``full``."""
    w = min(n / full, 1.0)
    mu, cov = (w * a + (1 - w) * b for a, b in zip(own[:2], wider[:2]))
    return mu, cov, math.exp(w * math.log(own[2]) + (1 - w) * math.log(wider[2]))


def _shrink(full: int):
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                own, pool, every = ((np.array(r[f"{k}_mu"]), np.array(r[f"{k}_cov"]).reshape(P, P), r[f"{k}_scale"]) for k in ("own", "pool", "every"))
                mu, cov, scale = blend(own, blend(pool, every, r["pool_n"], full), r["own_n"], full)
                root, _ = _whiten(cov)
                out.append({"own": r["own"], "mu": mu.tolist(), "root": root.ravel().tolist(), "scale": scale})
            f = pa.list_(pa.float64())
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("own", pa.string()), ("mu", f), ("root", f), ("scale", pa.float64())]))

    return run


def group_estimates(sound: DataFrame, full: int = FULL) -> DataFrame:
    """(own, mu, root, scale) of every language and source among ``sound`` (own, pool, x)."""
    fits = F.explode(F.array("own", "pool", F.lit("every")))
    params = estimates(sound.select(fits.alias("fit"), "x"))
    named = lambda k: params.select(F.col("fit").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("n", "mu", "cov", "scale")])
    groups = sound.select("own", "pool").distinct().withColumn("every", F.lit("every"))
    wide = groups.join(named("own"), "own").join(named("pool"), "pool").join(named("every"), "every")  # a row per group
    return stored(wide.mapInArrow(_shrink(full), "own string, mu array<double>, root array<double>, scale double"), "quality-groups")


def assess(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source", row_col: str | None = None) -> DataFrame:
    """Per document: row, doc_id, counts, base_failed, distance, cut, kept."""
    v = vectors(docs, id_col, text_col, lang_col, source_col, row_col).withColumn("base_failed", base_failed())
    v = v.withColumn("own", F.to_json(F.struct("lang", "source"))).withColumn("pool", F.to_json(F.struct("lang")))
    params = group_estimates(v.filter(~F.col("base_failed")).select("own", "pool", "x"))
    # the estimates (a row per group) come to the rows: no verdict is joined back
    judged = v.join(bounded_broadcast(params), "own", "left")
    sound = ~F.col("base_failed")
    cut = F.when(sound, F.lit(chi2_quantile(CUT_Z, P)) * F.col("scale"))
    return judged.select(
        "__row", "doc_id", *COUNTS, "base_failed", F.when(sound, _distance()).alias("distance"), cut.alias("cut"),
    ).withColumn("kept", F.coalesce(~F.col("base_failed") & (F.col("distance") <= F.col("cut")), F.lit(False)))
