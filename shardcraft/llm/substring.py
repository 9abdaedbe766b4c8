"""Substring deduplication over sliding sentence spans.

A text is cut into sentences (at line ends and at ``.!?`` before white space), and
each sentence after the word with the least hash of every ``UNIT`` neighbouring words,
so that no piece has more than ``UNIT`` words and the cuts move with the text.  From
every piece the shortest run of whole pieces with ``min_words`` words is
hashed word by word (lower case, without punctuation), and all runs of the corpus meet
by hash.  The first place of a repeated run (smallest doc_id, then position) stays.

A word that is ``UNIT`` words or more from both ends of a repeated passage is a
cut at all its places or at none, and whole sentences are cut alike everywhere.  So any
passage of ``min_words + 4 * UNIT - 3`` words (49), wherever it starts or ends and
with or without punctuation, and any whole sentences of ``min_words`` words, hold a
common run.

Runs end at cuts, passages at any word.  Where removed runs begin or end in a text, that
place and the run's first place are compared again, by every window of ``min_words`` words
from ``BEFORE`` words before the run to ``AFTER`` words after its start; that reaches
the ends of the passage.  A place inside a passage takes no part, wherever else its run
is an end.  A later place loses the words of its repeated runs and
windows; where a passage overlaps its own first place, that stays whole.

Defined results: null texts stay null and empty ones empty; rows without a
doc_id pass unchanged; repeated rows (equal id and text) are one document and keep
or lose the same words; an empty table gives no rows; other input columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (NOT_WORD, U64, discard, let_go, range_hashes, repeated_keys, slices, split_by, text_bytes, words,
                     written)

UNIT = 8                      # words of a piece at most
BEFORE, AFTER = 2 * UNIT, 3 * UNIT
RUNS = "__substring_runs"     # helper column
COUNTS = ("n_sentences", "n_removed", "n_words_removed")
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True


class Spans:
    """Words, sentences and runs of some texts, in arrays.

    ``start``/``hash``/``sentence``: first byte (within its text), hash and sentence of
    each word; ``doc_word``/``doc_run``: each text's first word and run;
    ``key``/``run_doc``/``first``/``last``: hash, text and word range of each run, one
    for each piece of a text but the last ones."""

    def __init__(self, texts: list[bytes], min_words: int):
        buf, doc_start, ws, we, wdoc = words(texts, NOT_WORD)
        n = len(ws)
        self.hash = range_hashes(buf, ws, we)
        blank = np.r_[_BLANK[buf[1:]], True] if len(buf) else np.zeros(0, bool)
        ends = np.concatenate([[0], np.cumsum((buf == 10) | _STOP[buf] & blank)])
        stop = np.ones(n, bool)                   # the piece ends after this word
        if n:
            stop[:-1] = (ends[ws[1:]] > ends[we[:-1]]) | (wdoc[1:] != wdoc[:-1])
        self.sentence = np.cumsum(stop) - stop
        if n >= UNIT:
            least = UNIT - 1 - np.argmin(np.lib.stride_tricks.sliding_window_view(self.hash, UNIT)[:, ::-1], axis=1)
            whole = self.sentence[UNIT - 1:] == self.sentence[:n - UNIT + 1]
            stop[(np.arange(len(least)) + least)[whole]] = True
        edges = np.r_[0, np.flatnonzero(stop) + 1]
        begin = edges[:-1]
        self.doc_word = np.searchsorted(wdoc, np.arange(len(texts) + 1))
        self.start = ws - doc_start[wdoc]
        self.start[self.doc_word[:-1][np.diff(self.doc_word) > 0]] = 0
        doc = wdoc[begin]
        full = begin + min_words <= self.doc_word[doc + 1]
        self.first, self.run_doc = begin[full], doc[full]
        self.last = edges[np.searchsorted(edges, self.first + min_words)]
        self.key = range_hashes(self.hash, self.first, self.last)
        self.doc_run = np.searchsorted(self.run_doc, np.arange(len(texts) + 1))

    def covered(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which words lie in one of the word ranges."""
        step = np.bincount(starts, minlength=len(self.hash) + 1) - np.bincount(ends, minlength=len(self.hash) + 1)
        return np.cumsum(step[:-1]) > 0


def _listed(col: pa.Array, s: int, e: int) -> tuple[np.ndarray, pa.Array]:
    """The values in the lists of some rows, and the row of each, from 0."""
    part = col.slice(s, e - s)
    n = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(e - s), n), part.flatten()


def _emit_runs(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]):
        let_go()
        for b in batches:
            known = np.flatnonzero(b.column(0).is_valid().to_numpy(zero_copy_only=False))
            ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)[known]
            texts = text_bytes(b.column(1).take(pa.array(known)))
            for s, e in slices(texts):
                x = Spans(texts[s:e], min_words)
                yield 0, (x.key, ids[s:e][x.run_doc], np.arange(len(x.key)) - x.doc_run[x.run_doc])
    return run


def _emit_windows(min_words: int):
    """All windows about the runs with the listed numbers."""
    def run(batches: Iterator[pa.RecordBatch]):
        let_go()
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), text_bytes(b.column(1))
            for s, e in slices(texts):
                x = Spans(texts[s:e], min_words)
                d, near = _listed(b.column(2), s, e)
                at = x.doc_run[d] + near.to_numpy(zero_copy_only=False)
                own = at < x.doc_run[d + 1]       # another text may have the same doc_id
                d, at = d[own], x.first[at[own]]
                lo, hi = np.maximum(at - BEFORE, x.doc_word[d]), np.minimum(at + AFTER, x.doc_word[d + 1] - min_words)
                w = np.flatnonzero(x.covered(lo, hi + 1))
                d = np.searchsorted(x.doc_word, w, side="right") - 1
                yield 0, (range_hashes(x.hash, w, w + min_words), ids[s:e][d], w - x.doc_word[d])
    return run


def _gone(x: Spans, d: np.ndarray, found: pa.Array, min_words: int) -> np.ndarray:
    """The words in the listed runs and windows of texts ``d``."""
    whole, b, key, own = (found.field(i).to_numpy(zero_copy_only=False) for i in range(4))
    starts, ends = [], []
    for kind in (True, False):
        k = whole == kind
        e, want = d[k], key[k]
        base, n = (x.doc_run, len(x.key)) if kind else (x.doc_word, len(x.hash) - min_words + 1)

        def place(number):
            """Word range of a run or window, and whether this text has it: another may have the same doc_id."""
            at = base[e] + number
            same = (number >= 0) & (at < base[e + 1]) & (at < n)
            at = np.where(same, at, 0)
            if not same.any():
                return at, at, same
            have = x.key[at] if kind else range_hashes(x.hash, at, at + min_words)
            begin, end = (x.first[at], x.last[at]) if kind else (at, at + min_words)
            return begin, end, same & (have.view(np.int64) == want)

        begin, end, here = place(b[k])
        _, stays, inside = place(own[k])          # the first place is in this text, too
        starts.append(np.minimum(np.where(inside, np.maximum(begin, stays), begin), end)[here])
        ends.append(end[here])
    return x.covered(np.concatenate(starts), np.concatenate(ends))


def _strip(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            texts = text_bytes(b.column("text"))
            out, n, gone, lost = [], [], [], []
            for s, e in slices(texts):
                x = Spans(texts[s:e], min_words)
                hit = _gone(x, *_listed(b.column(RUNS), s, e), min_words)
                for d in range(e - s):
                    a, z = x.doc_word[d], x.doc_word[d + 1]
                    text, cut = texts[s + d], hit[a:z]
                    if cut.any():
                        turn = np.flatnonzero(np.diff(np.r_[True, cut, True]))   # kept and removed words take turns
                        at = np.r_[x.start[a:z], len(text)][turn].tolist()
                        text = b"".join(text[i:j] for i, j in zip(at[::2], at[1::2]))
                    out.append(text)
                    n.append(int(x.sentence[z - 1] - x.sentence[a]) + 1 if z > a else 0)
                    gone.append(len(np.unique(x.sentence[a:z][cut])))
                    lost.append(int(cut.sum()))
            valid = b.column("text").is_valid().to_pylist()
            text = pa.array([t.decode() if v else None for t, v in zip(out, valid)], pa.string())
            cols = [text if c == "text" else b.column(c) for c in b.schema.names if c != RUNS]
            yield pa.RecordBatch.from_arrays(
                [*cols, *(pa.array(v, pa.int64()) for v in (n, gone, lost))],
                [*(c for c in b.schema.names if c != RUNS), "n_sentences", "n_removed", "n_words_removed"])
    return run


def _placed(met: DataFrame, name: str) -> DataFrame:
    """Every place of a repeated key: whether it is a ``later`` one, where the ``first`` one
    is, and its number if it is in the same document (``own``, else -1)."""
    places = met.where("kind = 1").select("key", F.col("a").alias("doc_id"), "b")
    # written, so that the join deals out both sides anew and splits a run that very many documents hold
    first = written(places.groupBy("key").agg(F.min(F.struct("doc_id", "b")).alias("first")), name)
    return places.join(first, "key").select(
        "key", "doc_id", "b", (F.struct("doc_id", "b") != F.col("first")).alias("later"),
        F.when(F.col("first.doc_id") == F.col("doc_id"), F.col("first.b")).otherwise(-1).alias("own"), "first")


def remove_repeats(documents: DataFrame, min_words: int = 20) -> DataFrame:
    """The documents with repeated passages removed from ``text``, and columns
    n_sentences, n_removed (sentences that lost words), n_words_removed, which take the place of
    input columns of these names; :func:`strip_repeats` leaves every input column."""
    docs = documents.select("doc_id", "text")
    runs = written(_placed(repeated_keys(docs, _emit_runs(min_words), "substring-runs"), "substring-first"),
                   "substring-places")
    line = Window.partitionBy("doc_id").orderBy("b")
    inner = [(step("b", 1).over(line) == F.col("b") + by) & step("later", 1).over(line)
             for step, by in ((F.lag, -1), (F.lead, 1))]
    ends = runs.select("doc_id", "b", "first", "later", F.coalesce(inner[0] & inner[1], F.lit(False)).alias("inner"))
    ends = written(ends.where("later and not inner"), "substring-ends")
    near = ends.select("doc_id", "b").unionAll(ends.select("first.doc_id", "first.b")).distinct()
    near = written(near.groupBy("doc_id").agg(F.collect_list("b").alias("near")), "substring-near")
    about, _ = split_by(docs, F.xxhash64("doc_id"), near.select(F.xxhash64("doc_id")))
    windows = _placed(repeated_keys(about.join(near, "doc_id").select("doc_id", "text", "near"),
                                    _emit_windows(min_words), "substring-windows", splits=2),
                      "substring-first-windows")
    discard(ends, near)
    gone = (runs.drop("first").withColumn("whole", F.lit(True))
            .unionByName(windows.drop("first").withColumn("whole", F.lit(False))).where("later")
            .groupBy("doc_id").agg(F.collect_list(F.struct("whole", "b", "key", "own")).alias(RUNS)))
    names = [c for c in documents.columns if c not in COUNTS]
    gone = written(gone, "substring-gone")
    hit, rest = split_by(documents.select(*names), F.xxhash64("doc_id"), gone.select(F.xxhash64("doc_id")))
    none = F.lit(None).cast(gone.schema[RUNS].dataType).alias(RUNS)
    joined = hit.join(gone, "doc_id", "left").select(*names, RUNS).unionAll(rest.select(*names, none))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*names).schema)
    return joined.mapInArrow(_strip(min_words), f"{fields}, n_sentences long, n_removed long, n_words_removed long")


def strip_repeats(documents: DataFrame, min_words: int = 20) -> DataFrame:
    """The documents with repeated passages removed from ``text`` and all other columns as they are."""
    own = {c: f"__own_{c}" for c in COUNTS if c in documents.columns}
    out = remove_repeats(documents.withColumnsRenamed(own), min_words)
    return out.drop(*COUNTS).withColumnsRenamed({v: k for k, v in own.items()}).select(*documents.columns)
