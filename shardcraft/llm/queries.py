"""The registered queries of this package and, where SQL can express them,
their DuckDB SQL.  Each applies its operator with production parameters to the
whole intended table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontaminate, jaccard, licenses, minhash, packing, quality, sharding, spelling, substring,
               token_counts, topk, warc)
from .common import table

WORD_TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    whole = F.when(F.col("kind") == "record", True).otherwise(      # the query's own archives have no gaps
        F.raise_error(F.concat_ws(" ", F.lit("gap in"), "archive", "position", "reason")).cast("boolean"))
    return (back.where(whole)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_sentences", "n_removed", "n_words_removed", "text")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=2, num=80, den=100)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_licenses": op4_licenses,
    "op5_warc": op5_warc,
    "op6_token_counts": op6_token_counts,
    "op7_sharding": op7_sharding,
    "op8_jaccard": op8_jaccard,
    "op9_substring": op9_substring,
    "op10_topk": op10_topk,
    "op11_minhash": op11_minhash,
    "op12_spelling": op12_spelling,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS payload_digest FROM p),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM m""",
    "op10_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
           FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op13_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     k AS (SELECT unnest([1, 2, 3, 4]) AS k),
     i AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, k WHERE len(w) >= k),
     f AS (SELECT lang, k, w[i:i + k - 1] AS ws, count(*) AS f FROM i GROUP BY ALL),
     n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
     c AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
     j AS (SELECT *, unnest(range(1, k)) AS j FROM c),
     s AS (SELECT j.lang, j.ws, j.k, j.f AS a, l.f AS l, r.f AS r, j.j,
                  (CAST(2000000 AS HUGEINT) * j.f) // (l.f + r.f) AS score
           FROM j JOIN f l ON l.lang = j.lang AND l.k = j.j AND l.ws = j.ws[1:j.j]
                  JOIN f r ON r.lang = j.lang AND r.k = j.k - j.j AND r.ws = j.ws[j.j + 1:j.k]),
     b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) = 1),
     q AS (SELECT lang, ws, k, f, d, unnest(range(1, k - d + 2)) AS i
           FROM (SELECT *, unnest(range(2, k)) AS d FROM c WHERE k > 2)),
     gone AS (SELECT DISTINCT c.lang, c.ws FROM q JOIN c ON c.lang = q.lang AND c.k = q.d AND c.ws = q.ws[q.i:q.i + q.d - 1]
              WHERE 100 * q.f >= 80 * c.f),
     o AS (SELECT b.lang, array_to_string(b.ws, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score
           FROM b ANTI JOIN gone g ON g.lang = b.lang AND g.ws = b.ws),
     t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000""",
}
