"""The corpus pipeline: five stages, each written as Parquet and read again.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of ``documents``.

Null and empty texts pass every stage and pack into one piece with the end id alone;
rows without a doc_id pass, too, but are only held against equal rows; of repeated rows
(equal id and text) one stays; ties go to the smaller doc_id; very long texts are taken
whole; an empty table packs into no rows; other columns keep their values, whatever
their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardcraft.llm import decontaminate, jaccard, packing, quality, substring
from shardcraft.llm.common import discard, table, written
from shardcraft.llm.queries import WORD_TOKENIZER


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.keep_one(docs, n=5, num=80, den=100)


def without_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated sentences removed; ``n_chars`` follows the text."""
    out = substring.strip_repeats(docs)
    return out.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c)
                        for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", without_near_copies),
    ("substring dedup", without_repeated_spans),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        last, docs = docs, stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{i + 1}")
            if i:                     # the table that this stage has read
                discard(last)
    return docs


#: SQL can't express the stages; tests hold the pipeline against a plain version.
ORACLE_SQL = None
