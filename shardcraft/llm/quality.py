"""Quality classifier by importance resampling over hashed n-grams.

Two generative bag-of-n-gram models are estimated over ``buckets`` hash
buckets: the *target* model from documents labelled good, the *raw* model from
every document of the corpus.  A document's importance weight is the ratio of
its probabilities under both.  Total weights follow a document's length, so the weight
drawn by is that of ``LENGTH`` n-grams at the document's mean log ratio: documents are
drawn without replacement, in proportion to it, by Gumbel top-k: the k largest of
``LENGTH * mean log ratio + Gumbel noise``.  k and the draw order documents alike.

N-grams (1 to 3) run over word *classes* (letter case, length, digits, repetition
of the previous word) and single punctuation characters rather than spellings,
so that a good text in rare words or another language isn't taken for junk.

k is the number of documents whose mean log ratio per n-gram reaches a cut that
is calibrated on labelled documents held out from the target model.  The
labelled rows used are bounded by ``max_labels`` (those with the smallest hashed
ids); all corpus statistics, weights, k and the sampling threshold come from
all documents.  The noise is a function of the document and a seed, so that a
lost executor recomputes the same sample.

Defined results: null and empty texts have no n-grams, weight 1 (log 0) and mean
0; without labels of both kinds everything is kept; rows with equal id and text
have equal noise and are kept or rejected together (also at the boundary, where
ties are kept); an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, let_go, mix, range_hashes, slices, split_by, text_bytes, written

SCORE = "doc_id long, text_hash long, n_grams long, log_weight double, mean_log_ratio double, gumbel_key double"

LENGTH = 1000

_KIND = np.zeros(256, np.uint8)          # 0 separator, 1 word, 2 punctuation
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[33:48] = _KIND[58:65] = _KIND[91:97] = _KIND[123:127] = 2
_KIND[10] = 2                            # a line end is a token
_UPPER = np.zeros(256, np.uint8)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.uint8)
_DIGIT[48:58] = 1
_REPEAT, _NUMBER, _CAPITALS, _TITLE, _LENGTH = 200, 201, 202, 203, 204


def token_classes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Class code and text index of every token."""
    buf = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    kind = _KIND[buf]
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = kind == 1
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    mark = np.flatnonzero(kind == 2)
    upper = np.concatenate([[0], np.cumsum(_UPPER[buf], dtype=np.int64)])
    digit = np.concatenate([[0], np.cumsum(_DIGIT[buf], dtype=np.int64)])
    size = end - start
    ups, digits = upper[end] - upper[start], digit[end] - digit[start]
    code = _LENGTH + np.minimum(size // 4, 4)
    code[_UPPER[buf[start]] == 1] = _TITLE
    code[(ups == size) & (size > 1)] = _CAPITALS
    code[digits == size] = _NUMBER
    where = np.concatenate([start, mark])
    order = np.argsort(where, kind="stable")
    code = np.concatenate([code, buf[mark].astype(np.int64)])[order]
    word = np.concatenate([range_hashes(buf, start, end), np.zeros(len(mark), U64)])[order]
    doc = np.searchsorted(ends, where[order], side="right")
    again = np.zeros(len(code), bool)
    again[1:] = (word[1:] == word[:-1]) & (word[1:] != 0) & (doc[1:] == doc[:-1])
    code[again] = _REPEAT
    return code, doc


def hashed_ngrams(code: np.ndarray, doc: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index of every n-gram, n from 1 to 3."""
    out, owner = [], []
    h = np.zeros(len(code), U64)
    for n in (1, 2, 3):
        m = len(code) - n + 1
        if m <= 0:
            break
        h = h[:m] * U64(1009) + code[n - 1:].astype(U64) + U64(1)
        same = doc[n - 1:] == doc[:m]
        out.append((mix(h[same] * U64(4) + U64(n)) % U64(buckets)).astype(np.int64))
        owner.append(doc[:m][same])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)


def _fold(doc_id: int) -> int:
    return int(mix(np.array([doc_id], np.int64).view(U64))[0] % U64(2))


def ngram_counts(docs: DataFrame, good: set[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts per bucket over all documents and over the good ones.
    Tasks add up their rows first; at most ``buckets`` rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), text_bytes(b.column(1))
            for s, e in slices(texts):
                gram, owner = hashed_ngrams(*token_classes(texts[s:e]), buckets)
                raw += np.bincount(gram, minlength=buckets)
                mine = np.fromiter((i in good for i in ids[s:e]), bool, e - s)
                if mine.any():
                    target += np.bincount(gram[mine[owner]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])],
                                         ["bucket", "raw", "target"])

    rows = (docs.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket")
            .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in rows:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray, prior: float = 1000.0) -> np.ndarray:
    """Log probability ratio per bucket.  The raw model is add-one smoothed; the
    target model has the raw one as prior, worth ``prior`` n-grams, so that what
    few target texts can't tell leaves the ratio near its average."""
    p = (raw + 1) / (raw.sum() + len(raw))
    return np.log((target + prior * p) / (target.sum() + prior)) - np.log(p)


def scores(docs: DataFrame, ratio: np.ndarray, seed: int) -> DataFrame:
    buckets = len(ratio)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            ids, texts, text_hash = b.column(0), text_bytes(b.column(1)), b.column(2)
            n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            noise = np.zeros(len(texts), U64)
            for s, e in slices(texts):
                gram, owner = hashed_ngrams(*token_classes(texts[s:e]), buckets)
                n[s:e] = np.bincount(owner, minlength=e - s)
                total[s:e] = np.bincount(owner, ratio[gram], e - s)
                size = np.fromiter(map(len, texts[s:e]), np.int64, e - s)
                end = np.cumsum(size)
                noise[s:e] = range_hashes(np.frombuffer(b"".join(texts[s:e]), np.uint8), end - size, end)
            own = ids.fill_null(-1).to_numpy(zero_copy_only=False).view(U64)
            u = ((mix(noise ^ mix(own + U64(seed))) >> U64(11)).astype(float) + 0.5) / 2.0 ** 53
            mean = total / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [ids, text_hash, pa.array(n), pa.array(total), pa.array(mean),
                 pa.array(LENGTH * mean - np.log(-np.log(u)))],
                ["doc_id", "text_hash", "n_grams", "log_weight", "mean_log_ratio", "gumbel_key"])

    return docs.mapInArrow(score, SCORE)


def best_cut(good: list[float], bad: list[float]) -> float:
    """The cut between neighbouring scores with the best balanced accuracy on the
    held-out labels; midway in its gap, and the lowest if several are best."""
    x = np.array(sorted({*good, *bad}))
    cuts = np.r_[x[0] - 1, (x[1:] + x[:-1]) / 2]
    g, w = np.sort(good), np.sort(bad)
    kept = 1 - np.searchsorted(g, cuts) / len(g)
    gone = np.searchsorted(w, cuts) / len(w)
    return float(cuts[int(np.argmax(kept + gone))])


def kth_largest(rows: DataFrame, col: str, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The k-th largest value, by narrowing histograms of ``bins`` bins: exact,
    and never more than ``few`` values on the driver."""
    lo, hi = rows.agg(F.min(col), F.max(col)).first()
    left = k
    part = rows.select(F.col(col).alias("v"))
    while True:
        if lo == hi:
            return lo
        width = (hi - lo) / bins
        inside = part.where((F.col("v") >= lo) & (F.col("v") <= hi))
        b = F.least(F.lit(bins - 1), F.floor((F.col("v") - lo) / width)).cast("int")
        hist = sorted(inside.groupBy(b.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"),
                                                       F.max("v").alias("hi")).collect(), key=lambda r: -r["b"])
        for r in hist:
            if left <= r["n"]:
                break
            left -= r["n"]
        lo, hi = r["lo"], r["hi"]
        if r["n"] <= few:
            values = inside.where((F.col("v") >= lo) & (F.col("v") <= hi)).orderBy(F.desc("v")).limit(left).collect()
            return values[-1]["v"]


def classify(documents: DataFrame, labels: DataFrame, buckets: int = 1 << 16, max_labels: int = 20_000,
             seed: int = 7) -> DataFrame:
    """One row per document: :data:`SCORE` and ``kept``."""
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    known = {r["doc_id"]: r["quality"] for r in
             labels.where("doc_id is not null and quality is not null").select("doc_id", "quality")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).collect()}
    train = {i for i, q in known.items() if q == 1 and _fold(i) == 0}
    judged = [i for i, q in known.items() if q != 1 or _fold(i) == 1]
    if not train or not any(known[i] != 1 for i in judged) or not any(known[i] == 1 for i in judged):
        return written(scores(docs, np.zeros(buckets), seed), "quality-scores").withColumn("kept", F.lit(True))
    ratio = log_ratio(*ngram_counts(docs, train, buckets))
    rows = written(scores(docs, ratio, seed), "quality-scores")
    sample = documents.sparkSession.createDataFrame([(i, int(known[i] == 1)) for i in judged], "doc_id long, good int")
    held = rows.join(F.broadcast(sample), "doc_id").select("good", "mean_log_ratio").collect()  # max_labels bounds it
    good, bad = ([r[1] for r in held if r[0] == g] for g in (1, 0))
    if not good or not bad:
        return rows.withColumn("kept", F.lit(True))
    cut = best_cut(good, bad)
    k = rows.where(F.col("mean_log_ratio") >= cut).count()
    if not k:
        return rows.withColumn("kept", F.lit(False))
    return rows.withColumn("kept", F.col("gumbel_key") >= F.lit(kth_largest(rows, "gumbel_key", k)))


def keep_good(documents: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The documents that :func:`classify` keeps, with all their columns."""
    gone = written(classify(documents, labels, **parameters).where(~F.col("kept"))
                   .select(F.col("doc_id").alias("gone_id"), "text_hash").distinct(), "quality-gone")
    maybe, kept = split_by(documents, F.xxhash64("doc_id", F.xxhash64("text")),
                           gone.select(F.xxhash64("gone_id", "text_hash")))
    return kept.unionAll(maybe.join(gone, maybe["doc_id"].eqNullSafe(gone["gone_id"])
                                    & (F.xxhash64(maybe["text"]) == gone["text_hash"]), "left_anti"))
