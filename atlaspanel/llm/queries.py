"""The registered queries of the operators: each runs its operator over its whole table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm import bpe, katz, mixing, packing, prefixtrie, quality, sharding, simhash, token_counts, topk, toxicity, vectorcodes, warc
from atlaspanel.llm.common import read_table
from atlaspanel.session import configure


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(configure(spark), sf_dir, "documents")


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz.score_texts(spark, _docs(spark, sf_dir), held_out)[0]


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, _docs(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(configure(spark), sf_dir, "embeddings")
    return topk.top_k(spark, rows, rows.filter(F.col("vec_id") % 20 == 0))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, _docs(spark, sf_dir))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(spark, read_table(configure(spark), sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _docs(spark, sf_dir), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, toxicity.training_labels(labels).select("doc_id", "toxic"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = toxicity.score(spark, docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})
    return scored.withColumn("predicted", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(spark, _docs(spark, sf_dir)).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(spark, _docs(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(spark, _docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, _docs(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, history = vectorcodes.compress(spark, read_table(configure(spark), sf_dir, "embeddings"))
    digest = hashlib.sha256(vectorcodes.codebook_text(history[-1]).encode()).hexdigest()
    return vectorcodes.with_label_error(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(spark, _docs(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(spark, read_table(configure(spark), sf_dir, "conversations")).drop("digest")


QUERIES = {
    f.__name__: f
    for f in (
        op1_katz_backoff, op2_best_fit_packing, op3_top_k, op4_simhash, op5_warc,
        op6_toxicity, op7_quality_rules, op8_token_counts, op9_mixing, op10_sharding,
        op11_vector_codes, op12_bpe, op13_prefix_trie,
    )
}

def _assigned(name: str, book: str) -> str:
    """A round's assignment of every part to its nearest entry, and the codebook that follows from it."""
    return f"""
        {name} AS (
          SELECT r, p, arg_min(e, {{'d': d, 'e': e}}) AS e, min(d) AS d
          FROM (SELECT x.r, x.p, b.e, CAST(list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) FOR i IN range(1, len(x.v) + 1)]) AS BIGINT) AS d
                FROM parts x JOIN {book} b ON b.p = x.p)
          GROUP BY r, p
        ),
        {name}_book AS (
          SELECT b.p, b.e, coalesce(m.v, b.v) AS v
          FROM {book} b LEFT JOIN (
            SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS v
            FROM (SELECT a.p, a.e, i, CAST(sum(x.v[i]) AS DOUBLE) AS s, count(*) AS n
                  FROM {name} a JOIN parts x ON x.r = a.r AND x.p = a.p, range(1, 1 + (SELECT any_value(len(v)) FROM parts)) g(i)
                  GROUP BY a.p, a.e, i)
            GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
        )"""


_VECTOR_CODES_SQL = f"""
        WITH kept AS (
          SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
                 [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
        ),
        parts AS (SELECT r, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS v FROM kept, range(16) t(p)),
        start AS (SELECT p, r AS e, v FROM parts WHERE r < 64),{_assigned("one", "start")},{_assigned("two", "one_book")},{_assigned("three", "two_book")},
        coded AS (
          SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM three GROUP BY r
        ),
        books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM two_book)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (r), books"""

# The CRC-32 of a decimal id, bit by bit: DuckDB has no such function.
_PREFIX_TRIE_SQL = r"""
        WITH t AS (
          SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p,
                 coalesce(role, '') AS r, coalesce(text, '') AS x
          FROM conversations WHERE conv_id IS NOT NULL
        ),
        conv AS (
          SELECT c, xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(ch) AS BIGINT) FOR ch IN string_split(CAST(c AS VARCHAR), '')],
            lambda a, b: list_reduce([xor(a, b)] || [CAST(0 AS BIGINT) FOR i IN range(8)],
              lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END))) % 4 AS h
          FROM (SELECT DISTINCT c FROM t)
        ),
        rebuilt AS (
          SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d, r, x
          FROM (SELECT v.c, 0 AS own, t.p, t.r, t.x FROM conv v JOIN t ON t.c = v.c - v.c % 20 AND t.p < v.h
                UNION ALL SELECT v.c, 1, t.p, t.r, t.x FROM conv v JOIN t ON t.c = v.c AND t.p >= v.h)
        ),
        prefix AS (
          SELECT c, d, array_to_string(list(sha256(len(r) || ':' || r || x)) OVER (PARTITION BY c ORDER BY d), ' ') AS k,
                 len(regexp_extract_all(x, '[^ 	-
]+')) AS words
          FROM rebuilt
          UNION ALL SELECT c, 0, '', 0 FROM conv
        ),
        node AS (
          SELECT p.k, min(p.c) AS conv_id, any_value(p.d) AS depth, any_value(words) AS words, count(*) AS n_convs, count(*) FILTER (p.d = l.d) AS n_ends,
                 sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (p.d = l.d), '')) AS ends_sha256
          FROM prefix p JOIN (SELECT c, max(d) AS d FROM prefix GROUP BY c) l ON l.c = p.c
          GROUP BY p.k
        ),
        pair AS (
          SELECT a.k, n.depth - a.d AS below, n.n_convs = n.n_ends AS leaf, (n.n_convs - 1) * n.words AS saved
          FROM node n JOIN prefix a ON a.c = n.conv_id AND a.d <= n.depth
        ),
        total AS (
          SELECT k, count(*) FILTER (below = 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM pair GROUP BY k
        ),
        parent AS (SELECT n.k, u.conv_id AS parent_conv_id FROM node n JOIN prefix a ON a.c = n.conv_id AND a.d = n.depth - 1 JOIN node u ON u.k = a.k)
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM node JOIN total USING (k) LEFT JOIN parent USING (k)"""

#: The same rows in DuckDB SQL, where SQL can state them.
ORACLE_SQL: dict[str, str] = {
    "op3_top_k": """
        WITH v AS (
          SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
        ),
        scored AS (
          SELECT q.vec_id AS query_id, q.v AS query, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 20 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 20""",
    "op5_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
        ),
        named AS (
          SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS response FROM p
        )
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN response IS NOT NULL AND response IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN response IS DISTINCT FROM page_id THEN response END AS refers_to
        FROM named""",
    "op11_vector_codes": _VECTOR_CODES_SQL,
    "op13_prefix_trie": _PREFIX_TRIE_SQL,
}
