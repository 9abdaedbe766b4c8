"""Spelling variants over a bidirectional FM-index of the vocabulary.

Words are counted in one scan; everything after that works on the vocabulary, which is
sorted and laid end to end, ``$w1$w2$...$``, in FM-indexes of bounded size.

A word with one error matches its first or its second half exactly, so there are two
search schemes: match the first half exactly from its left ``$`` and extend across the
second half to the right ``$``, allowing one error, and the same from the right.
:class:`BiIndex` extends the interval of a pattern on either side and keeps the
interval of the reversed pattern in step; the interval of ``$v$`` is one suffix, whose
rank among those that begin with ``$`` is v's rank in the sorted vocabulary.

**Distribution.**  The halves decide where a search can end: whatever the first scheme finds
begins with the word's first half.  Vocabulary words are dealt by their length and the
first characters that any searching word of a fitting length must match, once
more by their last characters, and a word is sent to the groups of its own length and
of one more and one less.  Groups are put together in indexes of about
``INDEX_CHARS`` characters; a larger group is cut into that many indexes, and its
searches go to each.  A task holds one index at a time.  Finds of the second scheme that
the first one makes as well (same first half) are left out, so that counts of
finds, which travel in place of pairs, add up.

Defined results: null and empty texts have no words; rows without a doc_id take part,
their id is the empty string where the run's checksum is formed; repeated rows count each
time; an empty table gives no rows; a tie for the form goes to the smaller word in
code-point order; very long texts and words are taken whole; other input columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffle_partitions, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HELD_WORDS = 100_000          # words counted in a task before they are passed on
INDEX_CHARS = 60_000          # characters of one index, about
HELD_SEARCHES = 20_000        # words searched at once


# ------------------------------------------------------------------- counting

def _words(shortest: int, deletion: int):
    """(word, n) of a task, counted over up to HELD_WORDS words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seed = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                for w, n in Counter(RUN.findall((text or "").translate(_LOWER))).items():
                    if len(w) >= shortest:
                        h = zlib.crc32(w.encode(), seed)
                        if not h % deletion:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < shortest:
                                continue
                        held[w] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


def vocabulary(documents: DataFrame, shortest: int = 6, least: int = 5, deletion: int = 199) -> DataFrame:
    """(word, n): the words of at least ``shortest`` characters and ``least`` occurrences."""
    counts = documents.select("doc_id", "text").mapInArrow(_words(shortest, deletion), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ------------------------------------------------------------------ the index

class _Side:
    """BWT of a text as a table of running counts: ``upto[i, c]`` symbols below c in bwt[:i]."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffixes(text)
        bwt = text[order - 1]
        self.upto = np.zeros((len(text) + 1, symbols + 1), np.int32)
        self.upto[np.arange(1, len(text) + 1), bwt + 1] = 1
        np.cumsum(self.upto, axis=0, out=self.upto)
        np.cumsum(self.upto, axis=1, out=self.upto)
        self.first = self.upto[-1]                     # suffixes that begin with a symbol below c


def suffixes(text: np.ndarray) -> np.ndarray:
    """The suffix array, by doubling; symbol 0 ends the text and occurs once."""
    n = len(text)
    rank, reach = text.astype(np.int64), 1
    while True:
        key = rank * (n + 1) + np.r_[rank[reach:] + 1, np.zeros(min(reach, n), np.int64)][:n]
        order = np.argsort(key, kind="stable")
        fresh = np.r_[False, np.diff(key[order]) != 0]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if fresh[1:].all():
            return order
        reach *= 2


class BiIndex:
    """A bidirectional FM-index over a delimited, sorted vocabulary.

    States are rows (lo, back, size): the pattern's interval among the suffixes of the
    text begins at ``lo``, that of the reversed pattern among those of the reversed
    text at ``back``; both hold ``size`` suffixes."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)                     # code points: Python's own order
        joined = "".join(f"\x00{w}" for w in self.words) + "\x00"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.alphabet, text = np.unique(points, return_inverse=True)
        text = text + 1                                # 1 is the delimiter, 0 the end of the text
        self.symbols = len(self.alphabet) + 1
        self.right_of = _Side(np.r_[text[::-1], 0], self.symbols)       # extends patterns to the right
        self.left_of = _Side(np.r_[text, 0], self.symbols)              # ... to the left
        self.start = np.array([[self.left_of.first[1], self.right_of.first[1], len(words) + 1]], np.int64)

    def coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words as rows of symbols, closed by a delimiter, and their lengths; -1: not in the alphabet."""
        size = np.array([len(w) for w in words])
        out = np.ones((len(words), int(size.max(initial=0)) + 1), np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        code = np.where(self.alphabet[at] == points, at + 1, -1)
        row = np.repeat(np.arange(len(words)), size)
        out[row, np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)] = code
        return out, size

    def extend(self, state: np.ndarray, symbol: np.ndarray, right: bool) -> np.ndarray:
        """The states of the patterns with a symbol more; size 0 where there are none."""
        side = self.right_of if right else self.left_of
        own, other = (1, 0) if right else (0, 1)
        c = np.maximum(symbol, 0)
        lo, hi = state[:, own], state[:, own] + state[:, 2]
        below, upto = side.upto[lo, c], side.upto[lo, c + 1]
        size = side.upto[hi, c + 1] - side.upto[hi, c] - (upto - below)
        out = np.empty_like(state)
        out[:, own] = side.first[c] + upto - below
        out[:, other] = state[:, other] + side.upto[hi, c] - below
        out[:, 2] = np.where(symbol < 0, 0, size)
        return out

    def branches(self, state: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Every letter that can follow: (row, symbol)."""
        side = self.right_of if right else self.left_of
        lo = state[:, 1 if right else 0]
        count = np.diff(side.upto[lo + state[:, 2]] - side.upto[lo], axis=1)
        row, symbol = np.nonzero(count[:, 2:])
        return row, symbol + 2

    def search(self, words: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word, vocabulary rank) pairs at one error whose first half (``right``) or second half matches."""
        code, size = self.coded(words if right else [w[::-1] for w in words])
        half = size // 2 if right else size - size // 2
        state = np.repeat(self.start, len(words), axis=0)
        own = np.arange(len(words))
        at = np.zeros(len(words), np.int64)
        waiting = []                                   # states with an error, by the place they go on from
        for step in range(code.shape[1]):
            free = step >= half[own]                   # in the other half, its end included
            if free.any():
                s, w = state[free], own[free]
                letter = step < size[w]
                waiting.append((s[letter], w[letter], np.full(letter.sum(), step + 1)))     # letter left out
                row, symbol = self.branches(s, right)
                more = self.extend(s[row], symbol, right)
                waiting.append((more, w[row], np.full(len(row), step)))                     # letter put in
                other = (step < size[w[row]]) & (symbol != code[w[row], step])
                waiting.append((more[other], w[row][other], np.full(other.sum(), step + 1)))  # letter replaced
            state = self.extend(state, code[own, step], right)
            alive = (state[:, 2] > 0) & (step < size[own])
            state, own = state[alive], own[alive]
        if not waiting:
            return own[:0], own[:0]
        state, own, at = (np.concatenate(x) for x in zip(*waiting))
        found = []
        while len(own):                                # the rest, exactly, and the closing delimiter
            state = self.extend(state, code[own, at], right)
            alive = state[:, 2] > 0
            state, own, at = state[alive], own[alive], at[alive]
            done = at == size[own]
            found.append((own[done], state[done, 0] - self.left_of.first[1] - 1))
            state, own, at = state[~done], own[~done], at[~done] + 1
        own, rank = (np.concatenate(x) for x in zip(*found))
        pairs = np.unique(own * len(self.words) + rank)
        return pairs // len(self.words), pairs % len(self.words)


# ---------------------------------------------------------------- distribution

SEARCHED = "word string, n_near long, form_n long, form string"


def _search(right: bool, index_chars: int):
    """Rows (place, kind, word, n) sorted by place and kind: a group's vocabulary, then the
    words to be searched in it.  Out comes one row per word and index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, seekers, chars, now, index = [], set(), 0, None, None

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal index
            if not books or not seekers:
                return
            if index is None:
                count = dict(books)
                index = BiIndex(list(count))
                index.n = np.array([count[w] for w in index.words], np.int64)
            words = sorted(seekers)
            own, rank = index.search(words, right)
            if not right:                              # the first scheme finds these as well
                keep = np.array([not index.words[r].startswith(words[i][:len(words[i]) // 2])
                                 for i, r in zip(own.tolist(), rank.tolist())], bool)
                own, rank = own[keep], rank[keep]
            if len(own):
                order = np.lexsort((rank, -index.n[rank], own))
                start = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0])
                best = rank[order][start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[i] for i in own[order][start].tolist()], pa.string()),
                     pa.array(np.diff(np.r_[start, len(own)])), pa.array(index.n[best]),
                     pa.array([index.words[r] for r in best.tolist()], pa.string())],
                    ["word", "n_near", "form_n", "form"])

        for b in batches:
            for place, kind, word, n in zip(*(c.to_pylist() for c in b.columns)):
                if place != now:
                    now = place
                    if chars >= index_chars:
                        yield from out()
                        books, seekers, chars, index = [], set(), 0, None
                if kind == 0:
                    books.append((word, n))
                    chars += len(word) + 1
                else:
                    seekers.add(word)
                    if len(seekers) >= HELD_SEARCHES and chars >= index_chars:
                        yield from out()               # this group is the index's last
                        seekers = set()
        yield from out()

    return run


def near_words(words: DataFrame, shortest: int = 6, index_chars: int = INDEX_CHARS) -> DataFrame:
    """(word, n_near, form_n, form) of (word, n): how many words are one error away, and
    the one of them with the largest n (ties: smallest); words without any are left out."""
    parts = shuffle_partitions(words.sparkSession)
    found = None
    for right in (True, False):
        side = F.substr if right else (lambda w, _, k: F.substr(w, F.char_length(w) - k + 1, k))
        size = F.char_length("word")
        # what any searching word of a fitting length must match: half of the shorter one
        floor = lambda m: F.greatest(m - 1, F.lit(shortest))
        reach = (lambda m: F.floor(floor(m) / 2)) if right else (lambda m: floor(m) - F.floor(floor(m) / 2))
        group = lambda m: F.concat_ws(":", m, side(F.col("word"), F.lit(1), reach(m).cast("int")))
        books = words.select(group(size).alias("grp"), "word", "n")
        groups = books.groupBy("grp").agg(F.ceil(F.sum(F.char_length("word") + 1) / index_chars).alias("indexes"))
        seekers = words.select(F.explode(F.array(size - 1, size, size + 1)).alias("m"), "word").where(
            F.col("m") >= shortest).select(group(F.col("m")).alias("grp"), "word")
        groups = written(groups, "spelling-groups")
        books = books.join(groups, "grp").select(
            F.concat_ws("/", "grp", F.pmod(F.xxhash64("word"), "indexes")).alias("place"), F.lit(0).alias("kind"),
            "word", "n")
        seekers = seekers.join(groups, "grp").select(
            "grp", "word", F.explode(F.sequence(F.lit(0), F.col("indexes") - 1)).alias("i")).select(
            F.concat_ws("/", "grp", "i").alias("place"), F.lit(1).alias("kind"), "word",
            F.lit(None).cast("long").alias("n"))
        got = (books.unionAll(seekers).repartition(parts, "place").sortWithinPartitions("place", "kind")
               .mapInArrow(_search(right, index_chars), SEARCHED))
        found = got if found is None else found.unionAll(got)
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.order")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), following forms to the last; the way doubles each round."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = written(at.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
        moved = not after.where("moved").isEmpty()
        discard(at)
        at = after.select("word", "root")
        at.written_at = after.written_at
        if not moved:
            return at


def spelling_groups(documents: DataFrame, shortest: int = 6, least: int = 5, ratio: int = 5, deletion: int = 199,
                    index_chars: int = INDEX_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word with its form, the near word
    of largest n if that is at least ``ratio`` times the word's own, else null."""
    words = written(vocabulary(documents, shortest, least, deletion), "spelling-words")
    near = written(words.join(near_words(words, shortest, index_chars), "word", "left"), "spelling-near")
    takes = F.col("form_n") >= F.col("n") * ratio
    named = near.select("word", F.when(takes, F.col("form")).alias("form"), "n",
                        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                        F.when(takes, F.col("form_n")).alias("form_n"))
    last = roots(named.where("form is not null").select("word", "form"))
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
