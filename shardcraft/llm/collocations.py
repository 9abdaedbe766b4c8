"""Phrase collocations from word-level FM-indexes, one per shard of the text.

1. **Shards.**  Every task turns its texts into shards of about ``SHARD_WORDS``
   words: word numbers (per language, local to the shard) with a break between
   pieces.  A shard is one compressed cell, its words with their counts are rows.
   Word counts are summed over shards; words below ``least`` can be in no candidate and
   become breaks.
2. **Depth by depth.**  Over a shard's words :class:`WordIndex` holds the sorted
   suffixes, their BWT and its inverse LF mapping.  An interval of n-grams is
   extended to the left through the BWT; the interval that comes out lies within
   that of its first n words, whose extension to the right it is.  So every
   longer n-gram is known by its two halves, the n-gram without its last and the one
   without its first word, and only if both are frequent in the *whole corpus* is
   it counted at all: no (n+1)-gram is frequent unless both are.
3. **Summed across shards.**  An interval's size is the n-gram's count in its
   shard.  (first part, last part, count) entries travel packed to the part's bucket, are
   summed there, and the frequent ones get a number.  A bucket answers each shard's entries in
   their own order, a bit each and the numbers of the frequent ones; the shard forms its entries again
   from its words, so they don't travel back, and drops the words that no frequent one covers.

Counts are exact: nothing is sampled and no local count is too small to travel.
Buckets grow in number with the words of the corpus, so a bucket, like a shard, is
of bounded size; an n-gram that stands everywhere brings one entry per shard.

Defined results: null texts are empty; a null language is ``und``; empty texts, and an
empty table, give no rows; repeated rows count each time; ties of score and count go by
the phrase's bytes; a very long text is cut into several shards between pieces
(one unbroken piece stays whole); other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, discard_part, let_go, shuffle_partitions, split_by, text_bytes, written

SHARD_WORDS = 1 << 20          # words and breaks of a shard, about
BUCKET_ENTRIES = 400_000       # n-gram entries of a bucket, about
PACKED_ROWS = 1 << 20          # entries that are packed at once, about
TEXT_BYTES = 1 << 20           # a longer text may be cut between pieces
BREAK = 0                      # symbol between pieces

#: lower-cased A-Z; ends of pieces as line feeds; tabs as spaces
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t",
                         b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


# ------------------------------------------------------------------- packing

def packed(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(cell: bytes, n: int, kind=np.int64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(cell, decompressed_size=n * size, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


# -------------------------------------------------------------------- shards

class _Words(dict):
    """Numbers of a language's words in a shard, in order of appearance."""

    def __init__(self, numbers: Iterator[int]):
        super().__init__()
        self[b"\n"], self[b""], self.numbers = BREAK, -1, numbers

    def __missing__(self, word: bytes) -> int:
        got = self[word] = next(self.numbers)
        return got


def _cuts(text: bytes) -> Iterator[bytes]:
    """A plain text, cut between pieces if it is very long."""
    start = 0
    while len(text) - start > TEXT_BYTES:
        end = text.find(b"\n", start + TEXT_BYTES) + 1
        if not end:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text


SHARD = "shard long, lang string, word string, number int, n long, size long, cell binary"


def _shards(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        part, turn = TaskContext.get().partitionId(), 0
        words: dict[str, _Words] = {}
        held, total = [], 0

        def numbers():
            yield from range(1, 1 << 31)

        fresh = numbers()

        def out() -> Iterator[pa.RecordBatch]:
            text = np.concatenate([np.zeros(1, np.int32), *held])
            shard = part << 24 | turn
            last = max((max(w.values()) for w in words.values()), default=0)
            count = np.bincount(text, minlength=last + 1)
            for lang, own in words.items():
                rows = [(w, k) for w, k in own.items() if k > 0]
                if not rows:
                    continue
                number = np.array([k for _, k in rows], np.int32)
                none = pa.nulls(len(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), shard)), pa.array([lang] * len(rows), pa.string()),
                     pa.array([w for w, _ in rows], pa.binary()).cast(pa.string()), pa.array(number),
                     pa.array(count[number]), none.cast(pa.int64()), none.cast(pa.binary())], names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()),
                 pa.nulls(1, pa.int64()), pa.array([len(text)]), pa.array([packed(text)], pa.binary())], names)

        names = ["shard", "lang", "word", "number", "n", "size", "cell"]
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                lang = "und" if lang is None else lang
                if lang not in words:
                    words[lang] = _Words(fresh)
                for cut in _cuts(text.translate(_PLAIN)):
                    tokens = cut.replace(b"\n", b" \n ").split(b" ")
                    ids = np.fromiter(map(words[lang].__getitem__, tokens), np.int32, len(tokens))
                    ids = np.r_[ids[ids >= 0], np.int32(BREAK)]
                    keep = ids != BREAK
                    keep[1:] |= ids[:-1] != BREAK
                    held.append(ids[keep])
                    total += len(held[-1])
                    if total >= shard_words:
                        yield from out()
                        turn, fresh, held, total = turn + 1, numbers(), [], 0
                        words = {lang: _Words(fresh)}
        if total:
            yield from out()

    return run


# ------------------------------------------------------------------ the index

class WordIndex:
    """FM-index of one shard, its suffixes sorted by their first words.

    ``rows[j]`` is the text position of sorted suffix j, ``bwt[j]`` the symbol before
    it, and suffix j without its first symbol is suffix ``rest[j]`` (the
    inverse LF mapping, from a stable sort of the BWT)."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, reach = text.astype(np.int64), 1
        while True:
            order = _sorted_pairs(rank, np.r_[rank[reach:], np.zeros(min(reach, n), np.int64)][:n])
            if reach * 2 >= depth:
                break
            follow = np.r_[rank[reach:], np.zeros(min(reach, n), np.int64)][:n][order]
            own = rank[order]
            fresh = np.r_[False, (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh)
            reach *= 2
        self.rows = order
        self.bwt = text[order - 1]                     # cyclic: the text begins with a break
        self.rest = _sorted_pairs(self.bwt.astype(np.int64), None)

    def intervals(self, first: np.ndarray, last: np.ndarray):
        """Extends intervals by one word.  ``first`` numbers, per sorted suffix, the
        n-gram it begins with, ``last`` that of the suffix at ``rest`` (-1: none).  Gives the
        first row and the size of every interval of longer n-grams that has both."""
        both = np.flatnonzero((first >= 0) & (last >= 0))
        f, s = first[both], last[both]
        start = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])]) if len(both) else both
        return both[start], np.diff(np.r_[start, len(both)])


def _sorted_pairs(a: np.ndarray, b: np.ndarray | None) -> np.ndarray:
    """Positions sorted by (a, b), then position; in one plain sort where all fits 63 bits."""
    n = len(a)
    bits = max(1, n.bit_length())
    high = int(a.max()).bit_length() if n else 0
    low = int(b.max()).bit_length() if b is not None and n else 0
    if high + low + bits > 63:
        return np.lexsort((a,) if b is None else (b, a))
    key = a << (low + bits)
    if b is not None:
        key |= b << bits
    key |= np.arange(n)
    key.sort()
    return key & ((1 << bits) - 1)


# ---------------------------------------------------------- one level deeper

class Shard:
    """A shard between levels: its words, which frequent n-gram begins at each of
    them, and the corpus-wide numbers of both."""

    def __init__(self, words: np.ndarray, grams: np.ndarray, numbers: np.ndarray):
        self.words, self.grams, self.numbers = words, grams, numbers

    def cell(self) -> bytes:
        plain = np.array_equal(self.grams, self.words - 1)         # single words are their own n-grams
        parts = [packed(self.words.astype(np.int32)), b"" if plain else packed(self.grams.astype(np.int32)),
                 packed(np.diff(self.numbers, prepend=0))]      # ascending
        head = np.array([len(self.words), len(self.numbers), *map(len, parts)], np.int64).tobytes()
        return head + b"".join(parts)

    @classmethod
    def of(cls, cell: bytes) -> Shard:
        n, m, a, b, c = (int(x) for x in np.frombuffer(cell, np.int64, 5))
        at = 40
        words = unpacked(cell[at:at + a], n, np.int32)
        return cls(words, unpacked(cell[at + a:at + a + b], n, np.int32) if b else words - 1,
                   np.cumsum(unpacked(cell[at + a + b:at + a + b + c], m)))

    @classmethod
    def first(cls, text: np.ndarray, local: np.ndarray, numbers: np.ndarray) -> Shard:
        """From a raw shard and its frequent words; others become breaks."""
        order = np.argsort(numbers)
        place = np.zeros(int(max(text.max(), local.max() if len(local) else 0)) + 1, np.int32)
        place[local[order]] = np.arange(1, len(local) + 1)
        words = place[text]
        return cls(words, words - 1, numbers[order]).shrunk(1)

    def deeper(self, answers: list[tuple[int, bytes]], buckets: int, depth: int) -> Shard:
        """With the frequent n-grams one word longer, from what buckets answered to :meth:`entries`."""
        have, n = self.numbers, max(len(self.numbers), 1)
        follow = np.r_[self.grams[1:], -1]
        at = np.flatnonzero((self.grams >= 0) & (follow >= 0))
        pairs, which = np.unique(self.grams[at].astype(np.int64) * n + follow[at], return_inverse=True)
        order, cut = _dealt(have[pairs // n], have[pairs % n], buckets)
        number = np.full(len(pairs), -1, np.int64)
        for size, cell in answers:
            bucket, many, numbers = _answered(size, cell)
            number[order[cut[bucket]:cut[bucket + 1]][many]] = numbers
        numbers = np.sort(number[number >= 0])
        local = np.where(number >= 0, np.searchsorted(numbers, number), -1)
        grams = np.full(len(self.words), -1, np.int32)
        grams[at] = local[which]
        return Shard(self.words, grams, numbers).shrunk(depth)

    def shrunk(self, depth: int) -> Shard:
        """Words that no frequent n-gram covers become breaks, and breaks in a row one."""
        n = len(self.words)
        step = np.zeros(n + depth + 1, np.int32)
        at = np.flatnonzero(self.grams >= 0)
        np.add.at(step, at, 1)
        np.add.at(step, at + depth, -1)
        words = np.where(np.cumsum(step)[:n] > 0, self.words, BREAK)
        keep = (words != BREAK) | np.r_[True, words[:-1] != BREAK]
        grams = self.grams[keep]
        return Shard(words[keep], grams, self.numbers)

    def entries(self, depth: int):
        """(first part, last part, count) of the n-grams of ``depth + 1`` words whose
        parts are both frequent."""
        if len(self.words) < 2:
            none = np.zeros(0, np.int64)
            return none, none, none
        index = WordIndex(self.words, depth + 1)
        grams = self.grams[index.rows]
        after = grams[index.rest]
        start, count = index.intervals(grams, after)
        return self.numbers[grams[start]], self.numbers[after[start]], count


def bucket_of(p: np.ndarray, s: np.ndarray, buckets: int) -> np.ndarray:
    m = 0x9E3779B97F4A7C15
    h = p.astype(np.uint64) * np.uint64(m) + s.astype(np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _dealt(p: np.ndarray, s: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of a shard's entries by bucket, first and last part, and where buckets begin."""
    bucket = bucket_of(p, s, buckets)
    order = np.lexsort((s, p, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


TOLD = "shard long, size long, cell binary"


def _answer(bucket: int, many: np.ndarray, numbers: np.ndarray) -> bytes:
    """Which of a shard's entries in a bucket are frequent, and their (ascending) numbers."""
    bits, steps = pa.compress(np.packbits(many).tobytes(), codec="zstd", asbytes=True), packed(np.diff(numbers, prepend=0))
    return np.array([bucket, len(bits), len(numbers)], np.int64).tobytes() + bits + steps


def _answered(size: int, cell: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    bucket, n, many = (int(x) for x in np.frombuffer(cell, np.int64, 3))
    bits = pa.decompress(cell[24:24 + n], decompressed_size=-(-size // 8), codec="zstd", asbytes=True)
    return (bucket, np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool),
            np.cumsum(unpacked(cell[24 + n:], many)))


def _told_cells(shard: np.ndarray, a: np.ndarray, b: np.ndarray, number: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(shard, size, cell): (a, b, number) entries packed per shard, in the given order."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else [0]
    out = []
    for s, e in zip(cut[:-1], cut[1:]):
        own = order[s:e]
        parts = [packed(np.diff(a[own], prepend=0)), packed(b[own]), packed(np.diff(number[own], prepend=0))]
        out.append((int(shard[s]), int(e - s), np.array([len(x) for x in parts], np.int64).tobytes() + b"".join(parts)))
    return out


def _told_entries(size: int, cell: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.r_[24, np.frombuffer(cell, np.int64, 3).cumsum() + 24]
    a, b, number = (unpacked(cell[s:e], size) for s, e in zip(at[:-1], at[1:]))
    return np.cumsum(a), b, np.cumsum(number)


def _pack_told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, a, number) rows packed per shard, some at a time."""
    held, n = [], 0

    def out() -> pa.RecordBatch:
        shard, a, number = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(a, kind="stable")
        cells = _told_cells(shard[order], a[order], np.zeros(len(a), np.int64), number[order])
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), t) for x, t in zip(zip(*cells), (pa.int64(), pa.int64(), pa.binary()))],
            ["shard", "size", "cell"])

    for b in batches:
        if b.num_rows:
            held.append(tuple(c.to_numpy() for c in b.columns))
            n += b.num_rows
        if n >= PACKED_ROWS:
            yield out()
            held, n = [], 0
    if held:
        yield out()


COUNTED = "shard long, bucket long, size long, cell binary"


def _count(buckets: int, depth: int):
    """Rows (shard, kind, size, cell) sorted by shard and kind: what the
    shard was told, then its cell.  Out come its entries per bucket, and the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for number, kind, size, cell in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "size", "cell"))):
                if number != now:
                    now, rows = number, []
                if kind == 0:
                    rows.append((size, cell))
                    continue
                if depth == 1:
                    told = [_told_entries(*r) for r in rows] or [[np.zeros(0, np.int64)] * 3]
                    local, _, numbers = (np.concatenate(x) for x in zip(*told))
                    shard = Shard.first(unpacked(cell, size, np.int32), local, numbers)
                else:
                    shard = Shard.of(cell).deeper(rows, buckets, depth)
                rows = []
                yield from out(number, shard)

    def out(number: int, shard: Shard) -> Iterator[pa.RecordBatch]:
        p, s, n = shard.entries(depth)
        order, cut = _dealt(p, s, buckets)
        p, s, n = p[order], s[order], n[order]
        rows = [(number, -1, 0, shard.cell())]
        for i in np.flatnonzero(np.diff(cut)):
            e = slice(cut[i], cut[i + 1])
            parts = [packed(np.diff(p[e], prepend=0)), packed(s[e]), packed(n[e].astype(np.uint32))]
            head = np.array([len(x) for x in parts], np.int64).tobytes()
            rows.append((number, int(i), int(cut[i + 1] - cut[i]), head + b"".join(parts)))
        for k in range(0, len(rows), 500):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), t) for x, t in zip(zip(*rows[k:k + 500]), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["shard", "bucket", "size", "cell"])

    return run


SUMMED = "shard long, a long, b long, number long, f long, size long, cell binary"


def _sum(least: int):
    """Entries sorted by bucket: frequent n-grams (``shard`` null, with their counts),
    and per shard the answer to its entries."""
    names = ["shard", "a", "b", "number", "f", "size", "cell"]
    types = [*[pa.int64()] * 6, pa.binary()]

    def merged(bucket: int, held: list) -> Iterator[pa.RecordBatch]:
        p, s, n = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
        order = np.lexsort((s, p))
        p, s, n = p[order], s[order], n[order]
        start = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (s[1:] != s[:-1])])
        f = np.add.reduceat(n.astype(np.int64), start)
        many = f >= least
        number = bucket << 32 | np.cumsum(many) - 1
        if not many.any():
            return
        each = np.empty(len(p), np.int64)               # an entry's number, -1: not frequent, as the shards sent them
        each[order] = np.repeat(np.where(many, number, -1), np.diff(np.r_[start, len(p)]))
        cells = []
        for h, own in zip(held, np.split(each, np.cumsum([len(h[1]) for h in held])[:-1])):
            if (own >= 0).any():
                cells.append((h[0], len(own), _answer(bucket, own >= 0, own[own >= 0])))
        for e in range(0, len(cells), 500):
            shards, size, cell = zip(*cells[e:e + 500])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards), *(pa.nulls(len(size), pa.int64()) for _ in range(4)), pa.array(size),
                 pa.array(cell, pa.binary())], schema=pa.schema(list(zip(names, types))))
        rows = start[many]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(rows), pa.int64()), pa.array(p[rows]), pa.array(s[rows]), pa.array(number[many]), pa.array(f[many]),
             pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.binary())], schema=pa.schema(list(zip(names, types))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for shard, bucket, size, cell in zip(*(b.column(c).to_pylist() for c in ("shard", "bucket", "size", "cell"))):
                if bucket != now:
                    if held:
                        yield from merged(now, held)
                    now, held = bucket, []
                lens = np.frombuffer(cell, np.int64, 3).cumsum() + 24
                held.append((shard, np.cumsum(unpacked(cell[24:lens[0]], size)), unpacked(cell[lens[0]:lens[1]], size),
                             unpacked(cell[lens[1]:lens[2]], size, np.uint32)))
        if held:
            yield from merged(now, held)

    return run


# ----------------------------------------------------------------- operators

def mine_phrases(documents: DataFrame, least: int = 30, longest: int = 4,
                 shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(phrases, totals)``.  Phrases of 1 to ``longest`` words with at least ``least``
    occurrences in their language: lang, words (count of words), phrase, f, heads and
    tails (counts of its first and last 1, 2, ... words), left_f and right_f (the largest count of a
    frequent phrase with one word more on that side, null if there is none).
    Totals: lang, n (all word occurrences)."""
    spark = documents.sparkSession
    parts = shuffle_partitions(spark)
    raw = written(documents.select("lang", "text").mapInArrow(_shards(shard_words), SHARD)
                  .withColumn("whole", F.col("cell").isNotNull()), "phrases-shards", by="whole")
    vocabulary = raw.where("not whole").drop("whole")
    totals = written(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    known = written(vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
                    .withColumn("number", F.monotonically_increasing_id()), "phrases-words")
    every = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(parts, -(-every // BUCKET_ENTRIES))
    level = known.select("number", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
                         F.array("f").alias("heads"), F.array("f").alias("tails"))
    frequent, _ = split_by(vocabulary, F.xxhash64("lang", "word"), known.select(F.xxhash64("lang", "word")))
    # written, so that the words and their join's shuffle files are gone before n-grams are counted
    told = written(frequent.select("shard", "lang", "word", F.col("number").alias("local"))
                   .join(known.select("lang", "word", "number"), ["lang", "word"])
                   .select("shard", F.col("local").cast("long").alias("a"), "number").mapInArrow(_pack_told, TOLD),
                   "phrases-told")
    discard(raw, part="whole=false")
    cells = raw.where("whole").select("shard", "size", "cell")
    levels, before = [], [raw, told]
    for depth in range(1, longest):
        rows = told.select("shard", F.lit(0).alias("kind"), "size", "cell").unionAll(
            cells.select("shard", F.lit(1).alias("kind"), "size", "cell"))
        counted = written(rows.repartition(parts, "shard").sortWithinPartitions("shard", "kind")
                          .mapInArrow(_count(buckets, depth), COUNTED).withColumn("whole", F.col("bucket") < 0),
                          f"phrases-counted-{depth + 1}", by="whole")
        discard(*before)
        before = [counted]
        summed = written(counted.where("not whole").drop("whole").repartition(parts, "bucket").sortWithinPartitions("bucket")
                         .mapInArrow(_sum(least), SUMMED), f"phrases-summed-{depth + 1}")
        discard_part(counted, "whole=false")               # only the shards are read again
        longer = summed.where("shard is null").select("a", "b", "number", "f")
        levels.append(_extended(level, longer))
        level = written(_joined(level, longer), f"phrases-level-{depth + 1}")
        told = summed.where("shard is not null").select("shard", "size", "cell")
        cells = counted.where("whole").select("shard", "size", "cell")
    levels.append(level.withColumns({"right_f": F.lit(None).cast("long"), "left_f": F.lit(None).cast("long")}))
    phrases = None
    for i, df in enumerate(levels):
        df = df.select("lang", F.lit(i + 1).alias("words"), "phrase", "f", "heads", "tails", "left_f", "right_f")
        phrases = df if phrases is None else phrases.unionAll(df)
    phrases = written(phrases, "phrases")
    discard(*before)
    return phrases, totals


def _joined(level: DataFrame, longer: DataFrame) -> DataFrame:
    """The phrases one word longer, from their first and last parts."""
    p = level.select(F.col("number").alias("a"), "lang", F.col("phrase").alias("head"), "heads")
    s = level.select(F.col("number").alias("b"), "last", "tails")
    return (longer.select("a", "b", "number", "f").join(p, "a").join(s, "b")
            .select("number", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f",
                    F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails")))


def _extended(level: DataFrame, longer: DataFrame) -> DataFrame:
    """With the largest count of an extension to the right and to the left."""
    right = longer.groupBy(F.col("a").alias("number")).agg(F.max("f").alias("right_f"))
    left = longer.groupBy(F.col("b").alias("number")).agg(F.max("f").alias("left_f"))
    return level.join(right, "number", "left").join(left, "number", "left")


def collocations(documents: DataFrame, least: int = 30, longest: int = 4, scale: int = 2_000_000,
                 within: int = 80, top: int = 2000, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two words or more in
    each language.  ``score`` is ``scale * a / (l + r)``, rounded down, at the cut
    where that is least (ties: first cut).  A phrase goes if a longer frequent one
    that holds it has at least ``within`` per cent of its occurrences; it's enough to look one
    word further, since counts fall with length."""
    phrases, totals = mine_phrases(documents, least, longest, shard_words)
    exact = lambda c: c.cast("decimal(20,0)")
    score = lambda l, r: F.expr(f"cast(f as decimal(20,0)) * cast({scale} as decimal(10,0))"  # noqa: E731
                                f" div (cast({l} as decimal(20,0)) + cast({r} as decimal(20,0)))")
    cuts = []
    for k in range(1, longest):
        l, r = f"get(heads, {k - 1})", f"get(tails, words - {k + 1})"
        cuts.append(F.when(F.col("words") > k, F.struct(score(l, r).alias("score"), F.lit(k).alias("cut"),
                                                        F.expr(l).alias("l"), F.expr(r).alias("r"))))
    longer = F.greatest("left_f", "right_f")
    kept = phrases.where("words > 1").where(longer.isNull() | (exact(longer) * 100 < exact(F.col("f")) * within))
    best = kept.select("lang", "phrase", F.col("f").alias("a"), F.array_min(F.array_compact(F.array(*cuts))).alias("c"))
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
                                              F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n",
                                              F.col("c.score").cast("long").alias("score"))
