"""Token counts through a digest cache.

A document's count is a pure function of its normalised content and of the
tokenizer file, so both digests key a stored table. A run joins its documents
to that table, encodes each distinct missing content once, appends the new
counts and joins again.

Defined results: a null text counts as the empty text (0 tokens); repeated rows
each get their row; an empty table gives an empty result; extra columns, also
ones named like the operator's own, are kept apart by fresh internal names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import fresh, scratch_path, texts

#: Units remembered by one Python worker; beyond it the memory starts anew (speed only).
MEMORY_UNITS = 300_000
CACHE_SCHEMA = "content string, n_tokens long"
_UNIT = re.compile(r" +[^ ]*")
_WORKER: dict = {}


def tokenizer_digest(path: str) -> str:
    """The tokenizer's version: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Counter:
    """Counts tokens as the library does, without special tokens.

    A sentencepiece model whose pieces never hold a space mark after another
    character, and whose normaliser leaves text as it is, merges nothing across
    the start of a run of spaces. Then a text's count is the sum over the units
    that begin at such a run; equal units are encoded once.
    """

    def __init__(self, path: str):
        self.memory: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda batch: [len(x) for x in self.model.encode(batch, num_threads=1)]
            pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
            apart = not any("▁" in p.lstrip("▁") for p in pieces)
            probe = "a  b ﬁａ é "
            plain = self.model.decode(self.model.encode(probe)) == probe and self.encode([""]) == [0]
            self.by_units = apart and plain
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self.encode = lambda batch: [len(e.ids) for e in tok.encode_batch_fast(batch, add_special_tokens=False)]
            self.by_units = False

    def count(self, batch: list[str]) -> list[int]:
        if not self.by_units:
            return self.encode(batch)
        known = self.memory
        if len(known) > MEMORY_UNITS:
            known.clear()
        out, whole, cut = [0] * len(batch), [], []
        for i, t in enumerate(batch):
            if "▁" in t:  # the mark itself in a text counts as a space
                whole.append(i)
            elif t:
                # single spaces only: the pieces between them are the units (less their space)
                plain = "  " not in t and t[0] != " " and t[-1] != " "
                cut.append((i, t.split(" ") if plain else [u[1:] for u in _UNIT.findall(" " + t)]))
        missing = list({u for _, units in cut for u in units if u not in known})
        # a unit's first space is the one that the library puts before every text
        known.update(zip(missing, self.encode(missing)))
        known[""] = 1
        for i, units in cut:
            out[i] = sum(map(known.__getitem__, units))
        for i, n in zip(whole, self.encode([batch[i] for i in whole])):
            out[i] = n
        return out


def _counter(path: str) -> Counter:
    if _WORKER.get("path") != path:
        _WORKER.update(path=path, counter=Counter(path))
    return _WORKER["counter"]


def _encode(path: str, step: int = 200):
    def run(batches):
        seen: set[str] = set()
        for b in batches:
            counter = _counter(path)
            digests, all_texts = b.column("content").to_pylist(), b.column("text")
            new = [i for i, d in enumerate(digests) if not (d in seen or seen.add(d))]
            for at in range(0, len(new), step):
                rows = new[at : at + step]
                counts = counter.count(texts(all_texts.take(pa.array(rows, pa.int32()))))
                yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in rows], pa.string()), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return run


def count_tokens(
    spark: SparkSession, docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` and ``n_tokens``.

    ``cache_path`` names the cache table (a folder that every executor reaches);
    it grows by the contents not met before. Content is normalised as the
    models here need it for equal counts: null becomes the empty text, every
    other text stays as it is.
    """
    cache_path = f"{cache_path or scratch_path(spark, 'llm-token-cache')}/tokenizer={tokenizer_digest(tokenizer_path)}"
    content, length, key = fresh(docs, "__content", "__length", "__key")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(*[c for c in docs.columns if c != text_col], F.sha2(text, 256).alias(content), F.octet_length(text).cast("long").alias(length))

    # the folder must exist to be read; an empty append makes it
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    # one row stands for each missing content: that of the smallest id (few bytes; aggregated before the shuffle)
    stand = (
        keyed.select(F.col(content).alias("content"), F.col(id_col).alias("id"))
        .join(cache.select("content"), "content", "left_anti")
        .groupBy("content")
        .agg(F.min("id").alias("id"))
    )
    # content and id together spread a content held by very many rows over the partitions
    missing = (
        docs.select(F.sha2(text, 256).alias("content"), F.col(id_col).alias("id"), text.alias("text"))
        .alias("d")
        .join(stand.alias("s"), (F.col("d.content") == F.col("s.content")) & F.col("d.id").eqNullSafe(F.col("s.id")))
        .select(F.col("d.content").alias("content"), "text")
    )
    missing.mapInArrow(_encode(tokenizer_path), CACHE_SCHEMA).dropDuplicates(["content"]).write.mode("append").parquet(cache_path)

    spark.catalog.refreshByPath(cache_path)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).select(F.col("content").alias(key), "n_tokens")
    own = [c for c in keyed.columns if c not in (content, length)]
    if {"n_bytes", "n_tokens"} & {c.lower() for c in own}:
        own = [c for c in own if c.lower() not in ("n_bytes", "n_tokens")]
    return keyed.join(counts, F.col(content) == F.col(key)).select(
        *[keyed[c] for c in own], F.col(length).alias("n_bytes"), counts["n_tokens"].alias("n_tokens")
    )
