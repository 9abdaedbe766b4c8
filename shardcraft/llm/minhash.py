"""Near-duplicate components by MinHash bands, confirmed on full shingle sets.

1. **Signatures.**  A text's set of distinct word shingles gets ``BANDS * ROWS`` minima, each
   under its own multiply-add-shift function (universal on 32-bit keys).  Documents with
   equal sets (two independent 64-bit sums and the size) are one class, known by its smallest
   doc_id.
2. **Bands.**  ``ROWS`` minima together are a band's key.  Two sets at similarity s share
   no band with probability ``(1 - s**4) ** 32``: 5e-8 at 0.8.  Keys that two classes or
   more have are kept.
3. **Signature verification.**  A pair goes on if its signatures agree in a share of places no
   less than the bound minus ``MARGIN`` (over five standard deviations); every pair
   that goes on is confirmed by counting the intersection of the full sets.
4. **Components** by alternating large-star and small-star (:mod:`.stars`).

Pairs are formed in two rounds, so that thousands of near copies aren't expanded
into all their pairs.  First, every class meets the class of its key that is in most
keys.  Then only keys whose classes are still in *different* components are open: in each, the
classes outside the key's largest component meet all others in cells that carry
the signatures and the sets.  A pair of one component, or of two that the cell has joined by then,
needs no test, and only links that join components leave a cell.  So a pair that
shares a band and is never tested lies within one component, and what travels is
classes, never pairs.

A cell is a block of outer classes with a share of the others, which pass by one at a time:
a key that holds a third of all classes is cut into many cells of bounded size.

Defined results: null and empty texts and texts without a word have an empty set and
are their own component; a text of fewer words than a shingle is one shingle; rows without a doc_id
take the component of equal rows (null if there is none); rows that share a doc_id are judged
by their own text; repeated rows are one class; an empty table gives no rows; very
long texts count whole; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, discard, mix, repeated_keys, shuffle_partitions, text_bytes, written
from .stars import components

ROWS, BANDS = 4, 32
MARGIN = 0.2                   # of agreeing minima below the bound
CELL, CELL_GRAMS = 200, 1 << 20   # outer classes of a cell, and their shingles
SHARE = 4000                   # classes that they meet in one task
UNIT = 50_000                  # classes of a component whose open keys are taken together
GROUP = 500                    # pairs of one class that are confirmed in one go
WORDS_HELD = 200_000           # word hashes kept by a task

_RNG = np.random.default_rng(11)
_A = _RNG.integers(0, 1 << 64, (ROWS * BANDS, 1), U64) | U64(1)
_B = _RNG.integers(0, 1 << 64, (ROWS * BANDS, 1), U64)


# -------------------------------------------------------------------- sets

class Shingles:
    """Sorted distinct shingle hashes of texts; word hashes are remembered up to a bound."""

    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()                   # bytes: A-Z only, ASCII white space only
        if not words:
            return np.zeros(0, U64)
        known = self.known
        if len(known) > WORDS_HELD:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), U64, len(words))
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, U64(n))
        for k in range(n):
            out = mix(mix(out) + h[k:len(h) - n + 1 + k])
        return np.unique(out)


def set_sums(g: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set, as signed integers."""
    return tuple(int(np.add.reduce(mix(g ^ U64(c)) * U64(len(g) * 2 + 1)).astype(np.int64))
                 for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def signature(g: np.ndarray) -> np.ndarray:
    x, low = g >> U64(32), None
    for s in range(0, len(x), 4096):
        part = (_A * x[None, s:s + 4096] + _B).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return (low >> U64(32)).astype(np.uint32)


SETS = "doc_id long, n_shingles long, hi long, lo long, sig binary"


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingles(n)
        for b in batches:
            size, hi, lo, sig = [], [], [], []
            for t in text_bytes(b.column(1)):
                g = sets(t)
                p, q = set_sums(g) if len(g) else (0, 0)
                size.append(len(g))
                hi.append(p)
                lo.append(q)
                sig.append(signature(g).tobytes() if len(g) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                 pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "hi", "lo", "sig"])
    return run


def _vectors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingles(n)
        for b in batches:
            grams = [sets(t) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(g) for g in grams], pa.int64()),
                 pa.array([g.tobytes() for g in grams], pa.binary())], ["node", "size", "grams"])
    return run


def _bands(batches: Iterator[pa.RecordBatch]):
    """Band keys of every class, for :func:`.common.repeated_keys`."""
    for b in batches:
        node = b.column(0).to_numpy()
        if not len(node):
            continue
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(len(node), BANDS, ROWS).astype(U64)
        key = np.broadcast_to(mix(np.arange(BANDS, dtype=U64)), (len(node), BANDS))
        for k in range(ROWS):
            key = mix(key + sig[:, :, k])
        key = key.reshape(-1)
        yield 0, (key, np.repeat(node, BANDS), np.zeros(len(key), np.int32))


# -------------------------------------------------------------- verification

def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets reach the bound."""
    if min(len(x), len(y)) * den < num * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    both = int(np.count_nonzero(x[at] == y))
    return den * both >= num * (len(x) + len(y) - both)


def _agreeing(least: int):
    """Rows (a, b, x, y) whose signatures x and y agree in ``least`` places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in ("x", "y"))
            keep = pa.array((x == y).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])
    return run


def _confirm(num: int, den: int):
    """Rows (a, salt, b, grams) sorted by a, salt and b, where b is null for a's own set: the links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, []
        for batch in batches:
            found = []
            for a, salt, b, grams in zip(*(batch.column(i) for i in range(4))):
                a, b, g = (a.as_py(), salt.as_py()), b.as_py(), np.frombuffer(grams.as_buffer(), U64)
                if a != now:
                    now, own = a, []
                if b is None:
                    own.append(g)
                    continue
                found += [(a[0], b) for x in own if similar(x, g, num, den)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def confirmed(pairs: DataFrame, vectors: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are links, by their full sets.  A set travels once to each
    group of GROUP pairs that it is part of."""
    salts = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("salts")), "minhash-salts")
    groups = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").alias("salt"), "b")
    own = salts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    vectors = vectors.select("node", "grams")
    rows = (groups.join(vectors.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "grams")
            .unionAll(own.join(vectors.withColumnRenamed("node", "a"), "a")
                      .select("a", "salt", F.lit(None).cast("long").alias("b"), "grams")))
    return (rows.repartition(shuffle_partitions(pairs.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", "b")
            .mapInArrow(_confirm(num, den), "a long, b long").distinct())


def _join_open(num: int, den: int, least: int):
    """Rows (cell, other, node, comp, sig, grams) sorted by cell and ``other``: a cell's
    outer classes, then one by one the classes they meet.  Out come links that join components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, sigs, top = None, [], None, {}

        def root(c: int) -> int:
            while top.setdefault(c, c) != c:
                c = top[c]
            return c

        for batch in batches:
            found = []
            cells, others, nodes, comps, short = (batch.column(i).to_pylist() for i in range(5))
            for i, cell in enumerate(cells):
                if cell != now:
                    now, own, sigs, top = cell, [], None, {}
                node, comp, sig = nodes[i], comps[i], np.frombuffer(short[i], np.uint32)
                y = np.frombuffer(batch.column(5)[i].as_buffer(), U64)
                if not others[i]:
                    own.append((node, comp, y, sig))
                    continue
                if sigs is None:
                    sigs = np.stack([o[3] for o in own])
                for k in np.flatnonzero((sigs == sig).sum(axis=1) >= least):
                    a, c, x, _ = own[k]
                    p, q = root(c), root(comp)
                    if p != q and similar(x, y, num, den):
                        top[max(p, q)] = min(p, q)
                        found.append((a, node))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def open_links(entries: DataFrame, comps: DataFrame, sigs: DataFrame, vectors: DataFrame, num: int, den: int,
               least: int) -> DataFrame | None:
    """Links between classes that share a key and are in different components; None if no key is open.

    In an open key every class outside the key's largest component meets all of the key's
    classes.  Keys with the same largest component are taken together, so that a class
    travels once for all of them, as long as they have no more than ``UNIT`` classes."""
    placed = entries.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    opened = written(placed.join(split, "key").select("key", "node", "comp"), "minhash-open")
    if opened.isEmpty():
        return None
    sizes = opened.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = written(sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("c")).select("key", F.col("c.comp").alias("main")),
                   "minhash-main")
    rows = written(opened.join(main, "key").select("key", "main", "node", "comp"), "minhash-rows")
    large = written(rows.groupBy("main").agg(F.count("*").alias("n")).where(F.col("n") > UNIT * BANDS).select("main", "n"),
                    "minhash-large")
    rows = written(rows.join(large, "main", "left").select(
        F.when(F.col("n").isNull(), F.concat(F.lit("m"), "main")).otherwise(F.concat(F.lit("k"), "key")).alias("unit"),
        "node", "comp", (F.col("comp") != F.col("main")).alias("outer")).distinct()
        .join(vectors.select("node", "size"), "node"), "minhash-units")
    wide = F.greatest(F.col("n") / CELL, F.col("grams") / CELL_GRAMS)
    units = written(rows.groupBy("unit").agg(
        F.sum(F.col("outer").cast("long")).alias("n"), F.sum(F.when(F.col("outer"), F.col("size"))).alias("grams"),
        F.ceil(F.count("*") / SHARE).alias("shares")).select("unit", F.ceil(wide).alias("cells"), "shares"), "minhash-cells")
    rows = rows.join(units, "unit")
    until = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), n)
    own = rows.where("outer").select("unit", dealt("cells", 1).alias("i"), until("shares").alias("j"), "node", "comp",
                                     F.lit(0).alias("other"))
    met = rows.select("unit", until("cells").alias("i"), dealt("shares", 2).alias("j"), "node", "comp", F.lit(1).alias("other"))
    cells = own.unionAll(met).select(F.concat_ws(":", "unit", "i", "j").alias("cell"), "other", "node", "comp")
    out = (cells.join(sigs, "node").join(vectors.select("node", "grams"), "node")
           .select("cell", "other", "node", "comp", "sig", "grams")
           .repartition(shuffle_partitions(entries.sparkSession), "cell").sortWithinPartitions("cell", "other")
           .mapInArrow(_join_open(num, den, least), "a long, b long"))
    out = written(out, "minhash-links")
    discard(opened, main)
    return out


# ----------------------------------------------------------------- operator

def near_duplicates(documents: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links
    ``den * |x & y| >= num * |x | y|``), kept (doc_id = component_id), one row per document."""
    docs = documents.select("doc_id", "text")
    sets = written(docs.mapInArrow(_sign(n), SETS), "minhash-sets")
    classes = written(sets.where("n_shingles > 0").groupBy("hi", "lo", "n_shingles")
                      .agg(F.min("doc_id").alias("node")).where("node is not null"), "minhash-classes")
    reps = sets.select("hi", "lo", "n_shingles", F.col("doc_id").alias("node"), "sig").join(
        classes, ["hi", "lo", "n_shingles", "node"]).select("node", "sig").distinct()
    reps = written(reps, "minhash-signatures")
    entries = repeated_keys(reps, _bands, "minhash-bands").select("key", F.col("a").alias("node"))
    comps = _components_of(docs, entries, reps, n, num, den)
    named = (sets.select("doc_id", "n_shingles", "hi", "lo").join(classes, ["hi", "lo", "n_shingles"], "left")
             .join(comps, "node", "left"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("comp", "node"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"),
                        (F.col("doc_id") == component).alias("kept"))


def _components_of(docs: DataFrame, entries: DataFrame, sigs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    least = int(ROWS * BANDS * (num / den - MARGIN))
    none = entries.sparkSession.createDataFrame([], "node long, comp long")
    if entries.isEmpty():
        return none
    met = written(entries.groupBy("node").agg(F.count("*").alias("met")), "minhash-met")
    vectors = written(docs.withColumnRenamed("doc_id", "node").join(met.select("node"), "node")
                      .select("node", "text").distinct().mapInArrow(_vectors(n), "node long, size long, grams binary"), "minhash-vectors")
    # first round: every class and the class of its key that is in most keys
    ranked = entries.join(met, "node")
    centre = written(ranked.groupBy("key").agg(F.max(F.struct("met", "node")).alias("c")).select("key", "c.node")
                     .withColumnRenamed("node", "a"), "minhash-centres")
    pairs = entries.join(centre, "key").where("a != node").select("a", F.col("node").alias("b")).distinct()
    pairs = (pairs.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b")
             .join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a").select("a", "b", "x", "y"))
    pairs = written(pairs.mapInArrow(_agreeing(least), "a long, b long"), "minhash-pairs")
    links = written(confirmed(pairs, vectors, num, den), "minhash-links")
    discard(pairs, met, centre)
    comps = written(components(links), "minhash-components")
    # second round: what shares a key over components
    more = open_links(entries, comps, sigs, vectors, num, den, least)
    if more is None or more.isEmpty():
        return comps
    return written(components(links.unionAll(more)), "minhash-components")
