"""Exact Jaccard join on word n-grams as a blocked sparse matrix product.

With A the document by n-gram incidence matrix, entry (i, j) of A * A^T is the
number of n-grams that documents i and j share.  Only entries that can reach the
size-derived bound are wanted:

* Equal rows are one row: documents with the same n-gram set form a class.
* Columns are cut by hash into blocks.  If ``|x & y| / |x | y| >= t`` and x is
  the smaller, at most ``|x| * (1 - t) / t`` n-grams differ, so of one block more
  than that at least one column block must agree completely; further blocks make
  up for empty ones and raise the number that must agree to ``need``, so that rows
  with fewer shared segments (a passage in common) are discarded unseen.  Rows are put into size levels, each with its own
  number of blocks, and a row also enters the lower level that it can still
  pair with.  Only rows that share such a block segment meet at all: that
  discards pairs below the bound without looking at frequent n-grams.
* For the pairs that meet, the product entry is accumulated in full and held
  against the bound.

Thousands of near copies of one text would meet in every pair, so pairs are
formed in two passes.  First each segment's rows meet its most central row only;
links found join rows into components.  Then the rows of segments that still
hold *different* components are dealt into row blocks, and of every two blocks
that share a segment the block product is accumulated in a task; only links that
join components leave it.  A pair that is never tested lies within one
component, so components are exact and no group is expanded into rows of pairs.

What is exchanged lies on disk until a step ends, and segments are several times the
texts.  So keys are dealt into ``ROUNDS`` by hash, each with a scan and an exchange of its
own, and products are formed in as many rounds as keep what one moves near the size of the
rows' own n-grams, however many meet.

Row identity and n-grams are 64-bit hashes.

Defined results: null and empty texts have an empty set, link with nothing and
are their own component; a text with fewer than n words is one n-gram; rows
without a doc_id take the component of equal rows (null if there is none) but
are not compared further; repeated rows are one class; an empty table gives no
rows; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, U64, discard, let_go, mix, range_hashes, repeated_keys, slices, split_by, text_bytes, words, written

GROWTH, SIZE_BITS = 1.35, 25
BLOCK_ROWS, BLOCK_GRAMS = 400, 250_000
ROUNDS = 3                     # exchanges that the segments are dealt into
EMPTY = U64(0x5851F42D4C957F2D)


def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of every text."""
    for s, e in slices(texts):
        buf, _, start, end, doc = words(texts[s:e], SPACE)
        h = range_hashes(buf, start, end)
        count = np.bincount(doc, minlength=e - s)
        first = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(max(0, len(h) - n + 1))
        grams = range_hashes(h, at, at + n)
        for i in range(e - s):
            a, b = first[i], first[i + 1]
            if b - a >= n:
                g = np.sort(grams[a:b - n + 1])
                yield g[np.r_[True, g[1:] != g[:-1]]]
            elif b > a:
                yield range_hashes(h[a:b], np.array([0]), np.array([b - a]))
            else:
                yield np.zeros(0, U64)


def set_id(g: np.ndarray) -> U64:
    """Hash of a set."""
    m = mix(g)
    both = np.array([np.add.reduce(m), np.add.reduce(mix(m ^ EMPTY)), len(g)]).astype(U64)
    return range_hashes(both, np.array([0]), np.array([3]))[0]


class Levels:
    """Size levels and their column blocks for the bound num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]
        while self.low[-1] < 1 << SIZE_BITS:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * GROWTH)))
        differ = [(b - 1) * (den - num) // num for b in self.low[1:]]
        self.need = [1 + d // 10 for d in differ]
        self.spare = [self._empty(low, d + n) for low, d, n in zip(self.low, differ, self.need)]
        self.blocks = [d + n + s if d else 0                                          # 0: only equal sets link
                       for d, n, s in zip(differ, self.need, self.spare)]

    @staticmethod
    def _empty(low: int, blocks: int) -> int:
        """Blocks that stay empty for the level's smallest sets, with a margin, when
        as many are added; about a third more blocks at most (a set with more empty
        ones matches them too)."""
        spare, most = 1, blocks * 35 // 100 + 2
        for _ in range(30):
            mean = (blocks + spare) * math.exp(-low / (blocks + spare))
            spare = min(most, math.ceil(mean + 4 * math.sqrt(mean)) + 1)
        return spare

    def of(self, size: int) -> list[int]:
        k = int(np.searchsorted(self.low, size, side="right")) - 1
        out = []
        while k >= 0 and (self.low[k + 1] - 1) * self.den >= self.num * size:
            out.append(k)
            k -= 1
        return [k for k in out if self.blocks[k]]

    def segments(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the set's segments in all its levels, and each one's level and
        the set's size in one number."""
        m, out, level = mix(g), [], []
        for k in self.of(len(g)):
            n = self.blocks[k]
            part = (g >> U64(32)) * U64(n) >> U64(32)
            start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            name = mix(part[start] + U64(k << 40))
            out.append(mix(np.add.reduceat(m, start) + name))
            if n - len(start) > self.spare[k]:
                bare = np.setdiff1d(np.arange(n, dtype=U64), part[start])
                out.append(mix(mix(bare + U64(k << 40)) ^ EMPTY))
            level += [np.full(len(x), k << SIZE_BITS | len(g), np.int32) for x in out[len(level):]]
        return (np.concatenate(out), np.concatenate(level)) if out else (np.zeros(0, U64), np.zeros(0, np.int32))


def _emit(n: int, num: int, den: int, turn: int = 0, rounds: int = 1):
    """Segments whose key belongs to the round ``turn``, and with the first one the rows."""
    def run(batches: Iterator[pa.RecordBatch]):
        let_go()
        levels = Levels(num, den)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), text_bytes(b.column(1))
            sets, sizes, held, total = [], [], [], 0
            for g in shingle_sets(texts, n):
                sid = set_id(g) if len(g) else U64(0)
                sets.append(sid)
                sizes.append(len(g))
                if len(g):
                    key, level = levels.segments(g)
                    if rounds > 1:             # by the low half of a key; its high half names the bucket
                        own = (key & U64(0xFFFFFFFF)) * U64(rounds) >> U64(32) == U64(turn)
                        key, level = key[own], level[own]
                    if len(key):
                        held.append((key, sid, level))
                        total += len(key)
                if total > 200_000:
                    yield 0, _entries(held)
                    held, total = [], 0
            if held:
                yield 0, _entries(held)
            if turn:
                continue
            sid, size = np.array(sets, U64), np.array(sizes, np.int32)
            known = np.array([i is not None for i in ids], bool)
            doc = np.array([i or 0 for i in ids], np.int64)
            for kind, own in ((2, known), (3, ~known)):
                yield kind, (sid[own].view(np.int64), doc[own], size[own])
    return run


def _entries(held):
    n = [len(k) for k, _, _ in held]
    return (np.concatenate([k for k, _, _ in held]),
            np.repeat(np.array([s for _, s, _ in held], U64).view(np.int64), n),
            np.concatenate([z for _, _, z in held]))


def _vectors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            for s in range(0, b.num_rows, 256):
                sets = [g for g in shingle_sets(text_bytes(b.column(1).slice(s, 256)), n) if len(g)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([set_id(g) for g in sets], U64).view(np.int64)),
                     pa.array([g.tobytes() for g in sets], pa.binary())], ["node", "grams"])
    return run


def _product(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            last, x = None, None
            for i, (p, q) in enumerate(zip(b.column("x"), b.column("y"))):
                if last is None or b.column("a")[i] != last:
                    last, x = b.column("a")[i], np.frombuffer(p.as_buffer(), U64)
                y = np.frombuffer(q.as_buffer(), U64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                overlap = int(np.count_nonzero(x[at] == y))
                keep[i] = den * overlap >= num * (len(x) + len(y) - overlap)
            own = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(own), b.column("b").filter(own)], ["a", "b"])
    return run


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The block product: n-grams shared by every row of x and of y, accumulated
    over blocks of the columns that two rows or more have."""
    owner = np.repeat(np.arange(len(x) + len(y)), [len(g) for g in (*x, *y)])
    _, column, count = np.unique(np.concatenate([*x, *y]), return_inverse=True, return_counts=True)
    name = np.cumsum(count > 1) - 1
    own = count[column] > 1
    column, owner = name[column[own]], owner[own]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(x), len(y)), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        s, e = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(x) + len(y), min(width, int(column[-1]) + 1 - start)), np.float32)
        part[owner[s:e], column[s:e] - start] = 1
        out += part[:len(x)] @ part[len(x):].T
    return out.astype(np.int64)


PACKED = "block long, nodes binary, comps binary, sizes binary, grams binary"
PACKED_COLUMNS = ("nodes", "comps", "sizes", "grams")


def _pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block to one row per block, in binary columns."""
    now, held = None, []

    def out() -> pa.RecordBatch:
        nodes, comps, grams = zip(*held)
        cells = (np.array(nodes, np.int64).tobytes(), np.array(comps, np.int64).tobytes(),
                 np.array([len(g) // 8 for g in grams], np.int64).tobytes(), b"".join(grams))
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), *(pa.array([c], pa.binary()) for c in cells)],
                                          ["block", *PACKED_COLUMNS])

    for rows in batches:
        for block, node, comp, grams in zip(*(c.to_pylist() for c in rows.columns)):
            if block != now and held:
                yield out()
                held = []
            now = block
            held.append((node, comp, grams))
    if held:
        yield out()


def _unpack(nodes: bytes, comps: bytes, sizes: bytes, grams: bytes):
    size = np.frombuffer(sizes, np.int64)
    return (np.frombuffer(nodes, np.int64), np.frombuffer(comps, np.int64), size,
            np.split(np.frombuffer(grams, U64), np.cumsum(size)[:-1]))


def joining_links(x, y, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Links between two unpacked blocks that join further components."""
    if len(np.unique(np.concatenate([x[1], y[1]]))) < 2:
        return
    shared = overlaps(x[3], y[3])
    hit = (den * shared >= num * (x[2][:, None] + y[2][None, :] - shared)) & (x[1][:, None] != y[1][None, :])
    root: dict[int, int] = {}

    def top(c):
        while root.setdefault(c, c) != c:
            c = root[c]
        return c

    for p, q in zip(*np.nonzero(hit)):
        s, t = top(int(x[1][p])), top(int(y[1][q]))
        if s != t:
            root[max(s, t)] = min(s, t)
            yield int(x[0][p]), int(y[0][q])


def _block_product(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for r in range(b.num_rows):
                x, y = (_unpack(*(b.column(f"{c}_{k}")[r].as_buffer() for c in PACKED_COLUMNS)) for k in ("i", "j"))
                found += joining_links(x, y, num, den)
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def linked(pairs: DataFrame, vectors: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose product entry reaches the bound.  A vector travels with every pair of it, so
    the written pairs are taken in rounds with about as many pairs as there are vectors."""
    rounds = -(-pairs.count() // max(1, vectors.count()))

    def one(part: Callable[[str], Column]) -> DataFrame:
        x = vectors.select(F.col("node").alias("a"), F.col("grams").alias("x")).where(part("a"))
        y = vectors.select(F.col("node").alias("b"), F.col("grams").alias("y"))
        both = pairs.where(part("a")).join(x, "a").join(y, "b")
        return both.select("a", "b", "x", "y").mapInArrow(_product(num, den), "a long, b long").distinct()

    return _in_rounds(one, rounds, "jaccard-links")


def _in_rounds(one: Callable[[Callable[[str], Column]], DataFrame], rounds: int, name: str) -> DataFrame:
    """The rows of ``one`` over all rounds, written.  ``one`` gets a test that holds for a column's
    values of its round; a round's shuffle files go before the next one begins."""
    made = [written(one(lambda c, r=r: F.pmod(F.xxhash64(c), F.lit(max(1, rounds))) == r), name)
            for r in range(max(1, rounds))]
    if len(made) == 1:
        return made[0]
    out = written(reduce(DataFrame.unionAll, made), name)
    discard(*made)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every linked node.

    Alternating large-star and small-star steps; each round's edges are written to
    the shared folder."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u > v").distinct(), "components")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        last = edges
        edges = written(small.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                       F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                                     .alias("e")).select("e.u", "e.v").where("u > v").distinct(), "components")
        discard(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def similarity_components(documents: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links
    ``den * |x & y| >= num * |x | y|``), one row per document."""
    docs = documents.select("doc_id", "text")
    met = [repeated_keys(docs, _emit(n, num, den, turn, ROUNDS), "jaccard-segments") for turn in range(ROUNDS)]
    rows = written(met[0].where("kind > 1").select(
        F.when(F.col("kind") == 2, F.col("a")).alias("doc_id"), F.col("key").alias("set_id"),
        F.col("b").alias("n_shingles")), "jaccard-sets")
    shared = reduce(DataFrame.unionAll, met).where("kind = 1").select(
        "key", F.col("a").alias("node"), F.shiftright("b", SIZE_BITS).alias("level"),
        F.col("b").bitwiseAND((1 << SIZE_BITS) - 1).alias("n"))
    shared = _dense(shared, "node", Levels(num, den).need)
    discard(*met)
    done = [rows, shared]
    if shared.isEmpty():
        comps = rows.sparkSession.createDataFrame([], "node long, comp long")
    else:
        comps = _components_of(docs, rows, shared, n, num, den)
        done.append(comps)
    # a class stands for its component; sets without n-grams stand for themselves
    named = (rows.join(comps.withColumnRenamed("node", "set_id"), "set_id", "left")
             .withColumn("comp", F.when(F.col("n_shingles") > 0, F.coalesce("comp", "set_id"))))
    named = written(named.select("doc_id", "n_shingles", "comp"), "jaccard-rows")
    discard(*done)
    # written, so that the join deals out both sides anew and splits a large component
    least = written(named.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least")),
                    "jaccard-least")
    return named.join(least, "comp", "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def _dense(shared: DataFrame, across: str, need: list[int], rounds: int = 2) -> DataFrame:
    """Without rows that can't link: a link of a level shares ``need`` segments of
    it at least, so a row with fewer segments shared over ``across`` has none, and
    a segment whose other rows went is shared no longer."""
    least = F.element_at(F.array(*map(F.lit, need)), F.col("level") + 1)
    for i in range(rounds):
        enough = shared.groupBy("node", "level").agg(F.count("*").alias("segments")).where(F.col("segments") >= least)
        left = shared.join(enough.select("node", "level"), ["node", "level"])
        keys = left.groupBy("key").agg(F.min(across).alias("lo"), F.max(across).alias("hi")).where("lo < hi")
        last, shared = shared, written(left.join(keys.select("key"), "key").select(*shared.columns), "jaccard-dense")
        if i:
            discard(last)
    return shared


def _components_of(docs, rows, shared, n, num, den) -> DataFrame:
    fits = lambda p, q: F.least(p, q) * den >= F.greatest(p, q) * num
    nodes = shared.groupBy("node").agg(F.count("*").alias("met"))
    wanted = written(rows.where("doc_id is not null and n_shingles > 0").groupBy("set_id")
                     .agg(F.min("doc_id").alias("doc_id")).join(nodes, F.col("set_id") == F.col("node"))
                     .select("doc_id").distinct(), "jaccard-wanted")
    about, _ = split_by(docs, F.xxhash64("doc_id"), wanted.select(F.xxhash64("doc_id")))
    vectors = written(about.join(wanted, "doc_id").select("doc_id", "text")
                      .mapInArrow(_vectors(n), "node long, grams binary"), "jaccard-vectors")
    # pass 1: each segment's rows against the one that meets others most often
    ranked = shared.join(nodes, "node")
    centre = ranked.groupBy("key").agg(F.max(F.struct("met", "node", "n")).alias("c"))
    first = written(ranked.join(centre, "key").where((F.col("node") != F.col("c.node")) & fits(F.col("n"), F.col("c.n")))
                    .select(F.col("node").alias("b"), F.col("c.node").alias("a")).distinct(), "jaccard-pairs")
    links = linked(first, vectors, num, den)
    discard(wanted, first)
    comps = written(components(links), "jaccard-comps")
    # pass 2: whatever shares a segment over components
    placed = shared.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    apart = written(placed.join(split.select("key"), "key").select("key", "comp", "node", "level", "n"), "jaccard-open")
    done = [vectors, links]
    if not apart.isEmpty():
        last, apart = apart, _dense(apart, "comp", Levels(num, den).need)
        discard(last)
    done.append(apart)
    if not apart.isEmpty():
        more = _open_links(apart, vectors, num, den)
        done.append(more)
        if not more.isEmpty():
            done.append(comps)
            comps = written(components(links.unionAll(more)), "jaccard-comps2")
    discard(*done)
    return comps


def _open_links(apart: DataFrame, vectors: DataFrame, num: int, den: int) -> DataFrame:
    """Links over components among rows that share a segment, by row blocks.

    A row's home is its most common open segment; a home's rows are dealt by hash
    into blocks of bounded size.  Blocks that share a segment anywhere meet once."""
    common = apart.groupBy("key").agg(F.count("*").alias("size"))
    homes = (apart.join(common, "key").groupBy("node")
             .agg(F.max(F.struct("size", "key")).alias("h"), F.max("comp").alias("comp"), F.max("n").alias("n"))
             .select("node", "comp", "n", F.col("h.key").alias("home")))
    cells = homes.groupBy("home").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_GRAMS)).alias("cells"))
    placed = written(homes.join(cells, "home").select(
        "node", "comp", "n", F.xxhash64("home", F.pmod(F.xxhash64("node"), "cells")).alias("block")), "jaccard-blocks")
    where = apart.join(placed.select("node", "block"), "node").select("key", "block").distinct()
    met = (where.withColumnRenamed("block", "i").join(where.withColumnRenamed("block", "j"), "key")
           .where("i <= j").select("i", "j").distinct())
    # of two blocks the lighter one travels to the other; those of a single component have nothing to join
    about = written(placed.groupBy("block").agg((F.sum("n") + 3 * F.count("*")).alias("weight"),
                                                F.min("comp").alias("lo"), F.max("comp").alias("hi")), "jaccard-weights")
    i, j = (about.select(F.col("block").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in ("weight", "lo", "hi")))
            for k in ("i", "j"))
    lighter = F.col("weight_i") <= F.col("weight_j")
    met = written(met.join(i, "i").join(j, "j")
                  .where(F.least("lo_i", "lo_j") < F.greatest("hi_i", "hi_j"))
                  .select(F.when(lighter, F.col("i")).otherwise(F.col("j")).alias("i"),
                          F.when(lighter, F.col("j")).otherwise(F.col("i")).alias("j"),
                          F.least("weight_i", "weight_j").alias("weight")), "jaccard-meetings")
    moved, held = (t.agg(F.sum("weight")).first()[0] or 0 for t in (met, about))
    packed = written(placed.join(vectors, "node").select("block", "node", "comp", "grams")
                     .repartition("block").sortWithinPartitions("block").mapInArrow(_pack_blocks, PACKED),
                     "jaccard-packed")
    sides = [packed.select(F.col("block").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in PACKED_COLUMNS))
             for k in ("i", "j")]

    def one(part: Callable[[str], Column]) -> DataFrame:
        both = met.where(part("j")).drop("weight").join(sides[0], "i").join(sides[1].where(part("j")), "j")
        return both.mapInArrow(_block_product(num, den), "a long, b long").distinct()

    out = _in_rounds(one, math.ceil(moved / max(1, held)), "jaccard-links2")
    discard(placed, packed, about, met)
    return out


def keep_one(documents: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents without near copies: of each component the row with its
    smallest doc_id stays (rows without one come last; of several texts with that doc_id
    the one with the smallest hash).  A row is known by its doc_id and text, so another
    text with the same doc_id is judged by itself; of equal rows one stays.  Rows without
    n-grams are only held against equal rows."""
    key = F.xxhash64("doc_id", "text")
    comps = similarity_components(documents.select(key.alias("doc_id"), "text"), n, num, den)
    ids = written(documents.select(key.alias("row"), "doc_id").groupBy("row")
                  .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "jaccard-ids")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), "row")
    named = written(comps.select(F.col("doc_id").alias("row"), F.col("component_id").alias("comp")).distinct()
                    .join(ids, "row").select("comp", "row", order.alias("place")), "jaccard-named")
    # written, so that the join deals out both sides anew and splits a large component
    least = written(named.groupBy("comp").agg(F.min("place").alias("least")), "jaccard-kept")
    gone = written(named.join(least, "comp").where(F.col("place") != F.col("least")).select("row"), "jaccard-gone")
    again = written(ids.where("n > 1").select("row").join(gone, "row", "left_anti"), "jaccard-again")
    out = written(gone.unionAll(again), "jaccard-out")
    maybe, kept = split_by(documents, key, out)
    # most that may be among them are: the others are told by their keys, and few whole texts travel
    back = written(maybe.select(key.alias("row")).join(out, "row", "left_anti").distinct(), "jaccard-back")
    maybe, _ = split_by(maybe, key, back)
    kept = kept.unionAll(maybe.join(out, key == F.col("row"), "left_anti"))
    if again.isEmpty():
        return kept
    more, _ = split_by(documents, key, again)
    return kept.unionAll(more.join(again, key == F.col("row"), "left_semi").dropDuplicates(["doc_id", "text"]))
