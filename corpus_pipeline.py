"""A training-corpus pipeline: quality rules, toxicity, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of the documents. A stage whose verdict takes other rows
numbers its rows first and joins the verdict back to exactly the row it was made
for: repeated rows, repeated ids and null ids keep verdicts of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm import mixing, packing, quality, simhash, toxicity
from atlaspanel.llm.common import fresh, numbered, read_table, stored
from atlaspanel.llm.queries import tokenizer_path
from atlaspanel.session import configure


def _only(held: DataFrame, row: str, chosen: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``held`` whose number is among ``chosen``, with the columns of the documents."""
    return held.join(chosen.select(F.col("__row").alias(row)), row, "left_semi").select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no outliers of their language and source."""
    held, row = numbered(docs, "pipeline-quality")
    return _only(held, row, quality.assess(spark, held, row_col=row).filter("kept"), docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the model learns from the labelled documents that are left."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, toxicity.training_labels(labels))
    # a score needs no other row: the documents pass through, and nothing is joined back
    (score,) = fresh(docs, "__score")
    scored = toxicity.score(spark, docs, model, {c: F.col(c) for c in docs.columns}, score_name=score, text_key="text")
    return scored.filter(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the first by id."""
    held, row = numbered(docs, "pipeline-simhash")
    return _only(held, row, simhash.representatives(spark, held, row_col=row), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix_documents(spark, docs, keep_rows=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack_documents(spark, docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Tokenizers, fitted models and fingerprints cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
