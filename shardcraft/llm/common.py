"""Helpers shared by the operators of this package.

* written intermediate tables in the shared checkpoint folder (lineage cuts
  that survive a lost executor);
* access to Arrow string columns as UTF-8 bytes, in slices of bounded size;
* vectorised word splitting and hashing;
* what a reused Python worker keeps between tasks, one operator's at a time;
* gap-free numbering of rows within a key without a single-task window;
* a bitmap of hashed keys, that tells most rows without a match apart before a join
  moves them;
* a global "which keys occur more than once" exchange that combines on the
  map side, so that no key ever gathers more than one entry per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardcraft.session import scratch_path

SLICE_BYTES = 1 << 19          # text bytes handled by one vectorised step
U64 = np.uint64


#: rows and bytes of one Arrow batch: whole texts, n-gram vectors and packed runs are
#: large rows, and a batch is held by the JVM and by Python, on both ends of a task
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
ROWS_SETTING, BYTES_SETTING = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))
#: removes the shuffle files of an execution when it ends
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.  The write's
    own shuffle files go when it has ended, since nothing reads them again.

    Arrow batches of the session are held at :data:`BATCH_ROWS` rows and
    :data:`BATCH_BYTES` bytes (a longer row is a batch of its own), which bounds
    what a task keeps in Python and in Arrow's buffers.  With ``by``, each value of that
    column has a folder of its own, for :func:`discard_part`."""
    conf = df.sparkSession.conf
    if int(conf.get(ROWS_SETTING)) > BATCH_ROWS:
        conf.set(ROWS_SETTING, str(BATCH_ROWS))
        conf.set(BYTES_SETTING, str(BATCH_BYTES))
    path = scratch_path(df.sparkSession, name)
    before = conf.get(CLEANUP_SETTING, "false")
    conf.set(CLEANUP_SETTING, "true")
    try:
        df.write.parquet(path, partitionBy=by)
    finally:
        conf.set(CLEANUP_SETTING, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame, part: str = "") -> None:
    """Delete tables made by :func:`written` that no later step reads, or of each only the
    folder ``part`` (``column=value``)."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{df.written_at}/{part}" if part else df.written_at)
        path.getFileSystem(conf).delete(path, True)


def discard_part(df: DataFrame, part: str) -> None:
    """Delete one folder (``column=value``) of a table written ``by`` that column."""
    discard(df, part=part)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every value; null is empty."""
    return [v or b"" for v in col.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` holding about :data:`SLICE_BYTES` each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=U64)


_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse (mod 2**64)."""
    if len(_POW.get("p", ())) < n:
        _POW["p"], _POW["q"] = _powers(_MULT, n), _powers(_INV, n)
    return _POW["p"][:n], _POW["q"][:n]


#: a Mersenne prime, a base of its field and the base's inverse
PRIME = U64((1 << 31) - 1)
_BASE = 1_220_703_125
_BASE_INV = pow(_BASE, -1, int(PRIME))
#: ranges longer than this are also hashed in the prime field
FIELD_FROM = 64
_FIELD: dict[str, np.ndarray] = {}


def _field_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, U64)
    while len(out) < n:
        out = np.concatenate([out, out * U64(pow(base, len(out), int(PRIME))) % PRIME])
    return out


def _field_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the ranges modulo :data:`PRIME`."""
    n = len(values) + 1
    if len(_FIELD.get("p", ())) < n:
        _FIELD["p"], _FIELD["q"] = _field_powers(_BASE, n), _field_powers(_BASE_INV, n)
    sums = np.zeros(n, U64)
    np.cumsum((values.astype(U64) % PRIME + U64(1)) * _FIELD["p"][:n - 1] % PRIME, out=sums[1:])
    return (sums[ends] - sums[starts]) % PRIME * _FIELD["q"][starts] % PRIME


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[s:e]`` for each range; equal contents hash
    equally wherever they stand (polynomial prefix sums, then mixed with the
    length).  Sums modulo 2**64 agree for some long regular sequences whatever
    their base, so ranges over :data:`FIELD_FROM` values carry a second sum,
    modulo a prime."""
    p, q = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * p[:-1], out=sums[1:])
    size = (ends - starts).astype(U64)
    own = (sums[ends] - sums[starts]) * q[starts] + mix(size)
    long = np.flatnonzero(size > FIELD_FROM)
    if len(long):
        own[long] += mix(_field_sums(values, starts[long], ends[long]) + size[long])
    return mix(own)


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: separators of words ``[^\x20\x09-\x0D]+``
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: separators of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
NOT_WORD = np.zeros(256, bool)
NOT_WORD[0x00:0x30] = NOT_WORD[0x3A:0x61] = NOT_WORD[0x7B:0x80] = True


def words(texts: list[bytes], separators: np.ndarray):
    """Lower-cased (A-Z) words of the texts laid end to end.

    Returns ``(buffer, doc_start, start, end, doc)``: the joined lower-cased
    bytes with one separator after each text, where each text starts, and per
    word its byte range in the buffer and its text's index.
    """
    sep = bytes([int(np.flatnonzero(separators)[0])])
    buf = ASCII_LOWER[np.frombuffer(sep.join(texts) + sep, np.uint8)]
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    doc_start = np.concatenate([[0], np.cumsum(lens)])
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~separators[buf]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(doc_start, start, side="right") - 1
    return buf, doc_start, start, end, doc


# -------------------------------------------- what a Python worker keeps

_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, kept by a reused Python worker from task to task: one thing at a time,
    until something else is asked for or another operator's task calls :func:`let_go`."""
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Drop what earlier tasks left in this Python worker.  Spark reuses workers over jobs, so the
    cache of one operator would lie beside the next one's data as long as the session lives."""
    for held in (_KEPT, _POW, _FIELD):
        held.clear()
    pa.default_memory_pool().release_unused()


# ---------------------------------------------------------------- numbering

def local_ranks(keys: np.ndarray, seen: dict[int, int]) -> np.ndarray:
    """Running rank of every row within its key, continued over batches by
    ``seen`` (rows counted so far per key)."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(k)])
    base = np.array([seen.get(int(x), 0) for x in k[first]], np.int64)
    for x, b, n in zip(k[first], base, size):
        seen[int(x)] = int(b + n)
    out = np.empty(len(k), np.int64)
    out[order] = np.arange(len(k)) - np.repeat(first - base, size)
    return out


def with_local_ranks(df: DataFrame, key: str) -> DataFrame:
    """Add ``part`` (task partition) and ``rank`` (running rank of the row
    within ``key`` in that partition).  ``key`` is an integer column.  Write the
    result before use, so that it is numbered once."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        part = TaskContext.get().partitionId()
        for b in batches:
            rank = local_ranks(b.column(key).to_numpy(zero_copy_only=False), seen)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(rank), part, np.int32)), pa.array(rank)],
                [*b.schema.names, "part", "rank"])

    return df.mapInArrow(number, f"{fields}, part int, rank long")


def rank_bases(ranked: DataFrame, key: str) -> DataFrame:
    """Per (``key``, ``part``): rows of the key in earlier partitions (``base``)
    and in this one (``n``).  The window runs over one row per partition."""
    counts = ranked.groupBy(key, "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))


# ------------------------------------------------------ rows that may match

BITS_A_KEY, MOST_BITS = 16, 1 << 26


def split_by(df: DataFrame, key: Column, keys: DataFrame, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``key`` (a hash, never null) may be in the only column of the written
    table ``keys``, and the rows that surely have no match there.

    The first part holds every match and a few rows more, so a join of it alone gives the matches and
    the second part needs none: whole texts are not shuffled to meet a few ids.  The keys
    are hashed into bitmaps of :data:`BITS_A_KEY` bits a key, ``most_bits`` (8 MB) at most,
    which is what is broadcast however many keys there are."""
    bits = 1 << 15
    while bits < min(most_bits, BITS_A_KEY * keys.count()):
        bits *= 2

    def spot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits)) + 1

    at = spot(F.col(keys.columns[0]))
    maps = keys.groupBy(F.bitmap_bucket_number(at).alias("__map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits"))
    place = F.bitmap_bit_position(spot(key))
    byte = F.conv(F.hex(F.expr("__bits").substr((F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    here = (F.bitmap_bucket_number(spot(key)) == F.col("__map")) & (
        F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1)
    return df.join(F.broadcast(maps), here, "left_semi"), df.join(F.broadcast(maps), here, "left_anti")


# ------------------------------------------------- keys that occur repeatedly

class _Outbox:
    """Collects (key, a, b) entries of a map task and packs them by key range."""

    def __init__(self, buckets: int, limit: int):
        self.buckets, self.limit, self.held, self.n, self.turn = buckets, limit, [], 0, 0

    def add(self, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, bytes]]:
        if len(key):
            self.held.append((key.astype(U64), a.astype(np.int64), b.astype(np.int32)))
            self.n += len(key)
        if self.n >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if not self.n:
            return
        key, a, b = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.n = [], 0
        key, a, b, first = distinct_entries(key, a, b)
        many = np.zeros(len(key), np.uint8)
        many[:-1] = ~first[1:]                     # a further entry of the same key follows
        bucket = bucket_of(key, self.buckets)
        cut = np.searchsorted(bucket[first], np.arange(self.buckets + 1))
        k, x, y, m = key[first], a[first], b[first], many[first]
        for i in np.flatnonzero(np.diff(cut)):
            s = slice(cut[i], cut[i + 1])
            yield int(i), pack(0, k[s], x[s], y[s], m[s])
        k, x, y = key[~first], a[~first], b[~first]  # already known to be repeated: spread evenly
        for s in range(0, len(k), 20_000):
            e = slice(s, s + 20_000)
            self.turn += 1
            to = (TaskContext.get().partitionId() * 7919 + self.turn * 104729) % self.buckets
            yield to, pack(1, k[e], x[e], y[e], np.ones(len(k[e]), np.uint8))


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def distinct_entries(key, a, b):
    """Entries sorted by key, then a and b, without repetitions; ``first`` marks
    the first entry of each key."""
    order = np.lexsort((b, a, key))
    key, a, b = key[order], a[order], b[order]
    if len(key):
        keep = np.r_[True, (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        key, a, b = key[keep], a[keep], b[keep]
    first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    return key, a, b, first


def pack(tag: int, key, a, b, m) -> bytes:
    return b"".join([bytes([tag]), key.astype(U64).tobytes(), a.astype(np.int64).tobytes(),
                     b.astype(np.int32).tobytes(), m.astype(np.uint8).tobytes()])


def unpack(blob: bytes):
    n = (len(blob) - 1) // 21
    at = 1
    out = []
    for kind, width in ((U64, 8), (np.int64, 8), (np.int32, 4), (np.uint8, 1)):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * width
    return blob[0], *out


Entries = tuple[np.ndarray, np.ndarray, np.ndarray]
ENTRY = "kind int, key long, a long, b int"


def repeated_keys(df: DataFrame, emit: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple[int, Entries]]],
                  name: str, limit: int = 400_000, splits: int = 8) -> DataFrame:
    """Find the keys that occur in at least two distinct entries anywhere.

    ``emit`` runs in the tasks of ``df`` and yields ``(kind, (key, a, b))`` arrays.
    Kind 0 are entries to be matched: the result holds, as kind 1, every
    distinct entry whose key has another one with a different (a, b).  Other
    kinds pass through unchanged (side results of the same scan).

    A task forwards one entry per key and flush (marked if it has more) to the
    key's bucket, packed in binary runs; its further entries of that key are
    known to be repeated and travel in evenly spread runs.  A key that holds a
    third of all entries therefore brings at most one entry per flush to its
    bucket.  Memory is bounded by ``limit`` entries on the map side and by
    one bucket, ``1 / splits`` of a shuffle partition, on the other.  A task sends
    a packed row to every bucket it has entries for, so few entries want few buckets.
    """
    parts = shuffle_partitions(df.sparkSession)
    buckets = parts * splits

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(buckets, limit)

        def rows(items):
            items = list(items)
            if items:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in items], pa.int32()), pa.array([x for _, x in items], pa.binary())],
                    ["bucket", "run"])

        for kind, (key, a, b) in emit(batches):
            if kind == 0:
                yield from rows(box.add(key, a, b))
            elif len(key):
                box.turn += 1
                to = (TaskContext.get().partitionId() * 7919 + box.turn * 104729) % buckets
                yield from rows([(to, pack(kind, key.view(U64), a, b, np.ones(len(key), np.uint8)))])
        yield from rows(box.flush())

    def out(kind: int, key, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)), pa.array(a), pa.array(b)],
            ["kind", "key", "a", "b"])

    def match(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        key, a, b, m = (np.concatenate(x) for x in zip(*held))
        marked = np.unique(key[m == 1])
        key, a, b, first = distinct_entries(key, a, b)
        start = np.flatnonzero(first)
        many = np.repeat(np.diff(np.r_[start, len(key)]), np.diff(np.r_[start, len(key)])) > 1
        if len(marked):
            at = np.minimum(np.searchsorted(marked, key), len(marked) - 1)
            many |= marked[at] == key
        if many.any():
            yield out(1, key[many], a[many], b[many])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != now:
                    yield from match(held)
                    now, held = bucket, []
                tag, key, a, b, m = unpack(run)
                if tag == 0:
                    held.append((key, a, b, m))
                else:
                    yield out(tag, key, a, b)
        yield from match(held)

    runs = df.mapInArrow(send, "bucket int, run binary")
    return written(runs.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, ENTRY), name)
