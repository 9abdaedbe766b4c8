"""Full-text relevance (A13) as column expressions.

Tokens are lower-cased runs of letters and digits of at least three
characters.  A document's score for a term list is ``sum(tf * idf^2)`` with
``idf = log10(N / df)`` (the natural-language-mode weighting described in the
public MySQL manual); a term held by every document scores 0.

Per query term the term frequency is computed inside the row
(``size(filter(tokens, t -> t = term))``), so no token table is exploded or
shuffled.  The corpus statistics (N and df per term) are one partial
aggregate; the scores read them as an uncorrelated scalar subquery.

Averages per group need no score per row: a score depends on the row's term
frequencies alone, so one scan counts the rows of every (group, term
frequencies), and statistics, weights and averages come from those few rows.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}]{3,}"
_PY_TOKEN = re.compile(r"[^\W_]{3,}")


def tokens(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def term_hits(col, terms: list[str]) -> Column:
    """The occurrences of the given terms as whole tokens, in text order.
    A term matches where it is a maximal run of letters and digits, which is
    exactly where the tokeniser would emit it, so no full token array is built."""
    c = F.col(col) if isinstance(col, str) else col
    alt = "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True))
    pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{alt})(?![\p{{L}}\p{{N}}])"
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), 0)


def query_terms(query: str) -> list[str]:
    """The distinct tokens of a query string, in first-seen order."""
    seen = []
    for t in _PY_TOKEN.findall(query.lower()):
        if t not in seen:
            seen.append(t)
    return seen


def term_frequencies(df: DataFrame, text_col: str, terms: list[str], keep: list[str]) -> DataFrame:
    """Per row, the count of each query term.  The text is scanned once for
    the query terms only; the per-term counts then run over that short array
    (a separate projection, so the scan is not repeated per term)."""
    step = df.select(*keep, term_hits(text_col, terms).alias("__hits"))
    return step.select(*keep, F.array(*[F.size(F.filter("__hits", _equals(t))) for t in terms]).alias("__tf"))


def _equals(term: str):
    return lambda x: x == F.lit(term)


def relevance(df: DataFrame, id_col: str, text_col: str, query: str,
              keep: list[str] | None = None, materialize: bool = True) -> DataFrame:
    """``score`` per row for the query's terms (rows without any term score 0).
    ``materialize`` checkpoints the per-row term counts (to the shared
    checkpoint folder) so that the text is tokenised once for both passes."""
    terms = query_terms(query)
    if not terms:
        raise ValueError("query has no terms")
    keep = [id_col] + [k for k in (keep or []) if k != id_col]
    tf = term_frequencies(df, text_col, terms, keep)
    if materialize:
        from ..session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        tf = tf.checkpoint(eager=True)
    return tf.withColumn("__w", _weights(tf.withColumn("__n", F.lit(1)), len(terms))).select(
        *keep, _score(len(terms)).alias("score"))


def _weights(tf: DataFrame, k: int) -> Column:
    """The idf^2 weight of every term as one scalar subquery over rows that
    stand for ``__n`` texts with the term frequencies ``__tf``."""
    counts = tf.agg(F.sum("__n").alias("n"),
                    *[F.sum(F.when(F.col("__tf")[i] > 0, F.col("__n")).otherwise(0)).alias(f"df{i}")
                      for i in range(k)])
    idf = [F.when(F.col(f"df{i}") > 0, F.log10(F.col("n") / F.col(f"df{i}"))).otherwise(F.lit(0.0))
           for i in range(k)]
    return counts.select(F.array(*[x * x for x in idf])).scalar()


def _score(k: int) -> Column:
    return F.round(reduce(add, [F.col("__tf")[i] * F.col("__w")[i] for i in range(k)]), 6)


def relevance_by_group(df: DataFrame, id_col: str, group_col: str, text_col: str,
                       query: str, n: int = 100) -> DataFrame:
    """Per group: rows and average relevance, top ``n`` by average.  Both
    readers of the counted rows share one exchange, so the text is scanned once."""
    terms = query_terms(query)
    if not terms:
        raise ValueError("query has no terms")
    k = len(terms)
    like = (term_frequencies(df, text_col, terms, [group_col])
            .groupBy(group_col, "__tf").agg(F.count(F.lit(1)).alias("__n")))
    # a text that is NULL has no score; it counts as a row, but not in the average
    scored = like.withColumn("__w", _weights(like, k)).select(
        group_col, "__n", _score(k).cast("decimal(18,6)").alias("__score"))
    n_scored = F.sum(F.when(F.col("__score").isNotNull(), F.col("__n"))).cast("decimal(20,0)")
    total = F.sum(F.col("__score") * F.col("__n").cast("decimal(20,0)")).cast("decimal(38,12)")
    g = scored.groupBy(group_col).agg(
        F.sum("__n").alias("record_count"),
        F.round(total / n_scored, 4).cast("double").alias("avg_relevance"))
    return g.orderBy(F.col("avg_relevance").desc(), F.col(group_col)).limit(n)
