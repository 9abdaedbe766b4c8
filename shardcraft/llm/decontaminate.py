"""Benchmark decontamination with one Aho-Corasick automaton.

Every test item (question and answer text) is normalised to lower-cased words
joined by single spaces; its windows of ``width`` consecutive words become the
patterns of one automaton.  Each document is normalised the same way and
scanned once; a match is a run of words, and because normalising keeps the
UTF-8 byte positions, every word knows where it stands in the original text.

The automaton travels to the executors, so its size is bounded: items are
dealt into blocks of at most ``block_bytes`` pattern bytes and each block is
one scan.  Any number of items is handled; one block is the usual case.

Defined results: a null or empty text has no words and is not contaminated;
items without words match nothing; equal items share their windows; items
without an id mark words but are not listed; repeated document rows are judged
one by one; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, written

TABLE = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32)
              for c in range(256))
RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "spans array<struct<start:long,end:long>>, item_ids array<string>")


def normal_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return text.translate(TABLE).split()


def windows(text: bytes, width: int) -> set[str]:
    """The item's windows as patterns: words with a space around each; bytes
    are carried one per character (Latin-1)."""
    w = normal_words(text)
    if not w:
        return set()
    return {(b" " + b" ".join(w[i:i + width]) + b" ").decode("latin-1") for i in range(max(1, len(w) - width + 1))}


def automaton(items: list[tuple[object, bytes]], width: int) -> ahocorasick.Automaton:
    found: dict[str, tuple[int, set]] = {}
    for item, text in items:
        for p in windows(text, width):
            found.setdefault(p, (p.count(" ") - 1, set()))[1].add(item)
    a = ahocorasick.Automaton()
    for p, (n, ids) in found.items():
        a.add_word(p, (n, frozenset(x for x in ids if x is not None)))
    if found:
        a.make_automaton()
    return a


_BUILT: dict[tuple, ahocorasick.Automaton] = {}     # the last one, kept by a reused Python worker


def built(items: list[tuple[object, bytes]], width: int) -> ahocorasick.Automaton:
    key = (width, tuple(items))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = automaton(items, width)
    return _BUILT[key]


def scan(text: bytes, a: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged word ranges covered by matches, items matched."""
    w = normal_words(text)
    if not w or not len(a):
        return len(w), [], set()
    line = b" " + b" ".join(w) + b" "
    hits = list(a.iter(line.decode("latin-1")))
    if not hits:
        return len(w), [], set()
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    last = np.searchsorted(gaps, [end for end, _ in hits])      # index of the closing space = words up to it
    ranges = sorted((int(e - n), int(e)) for e, (_, (n, _)) in zip(last, hits))
    merged = [list(ranges[0])]
    for s, e in ranges[1:]:
        if s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return len(w), [tuple(x) for x in merged], set().union(*{ids for _, (_, ids) in hits})


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as character offsets of the original text."""
    inside = np.frombuffer(b" " + text.translate(TABLE) + b" ", np.uint8) != 32
    edge = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    at = lambda byte: int(chars[byte - 1]) if byte else 0
    return [{"start": at(int(starts[s])), "end": at(int(ends[e - 1]))} for s, e in ranges]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> list[list[tuple[object, bytes]]]:
    """The test items, in blocks of bounded size, read one at a time."""
    blocks, size = [[]], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        text = (r["text"] or "").encode()
        if size and size + len(text) > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((r["item_id"], text))
        size += len(text)
    return blocks


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 1 << 20) -> DataFrame:
    """One row per document, see :data:`RESULT`; ``spans`` are character ranges
    of the original text, ``item_ids`` the matched items as sorted strings."""
    docs = documents.select("doc_id", "text")
    blocks = item_blocks(benchmark, block_bytes)
    if len(blocks) == 1:
        return docs.mapInArrow(_finish(blocks[0], width), RESULT)
    # several automata: gather each block's matches per row, then merge them
    rows = written(docs.withColumn("row_id", F.monotonically_increasing_id()), "decontaminate-rows")
    parts = [rows.mapInArrow(_matches(b, width), "row_id long, ranges binary, items array<string>") for b in blocks]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    merged = found.groupBy("row_id").agg(F.collect_list("ranges").alias("ranges"),
                                         F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return rows.join(merged, "row_id", "left").mapInArrow(_merge, RESULT)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    key = F.xxhash64("doc_id", "text")
    named = documents.select(key.alias("doc_id"), "text")
    gone = written(contamination(named, benchmark, **parameters).where("contaminated").select("doc_id").distinct(),
                   "decontaminate-gone")
    return documents.join(gone.withColumnRenamed("doc_id", "gone_key"), key == F.col("gone_key"), "left_anti")


def _row(doc_id, text: bytes, n: int, ranges, items) -> tuple:
    names = sorted(str(x) for x in items)
    hit = sum(e - s for s, e in ranges)
    return (doc_id, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0,
            original_spans(text, ranges) if ranges else [], names)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), span, pa.list_(pa.string())]
    cols = list(zip(*rows)) if rows else [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                      ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                                       "spans", "item_ids"])


def _finish(items, width):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = built(items, width)
        for b in batches:
            yield _batch([_row(d, t, *scan(t, a)) for d, t in zip(b.column(0).to_pylist(), text_bytes(b.column(1)))])
    return run


def _matches(items, width):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = built(items, width)
        for b in batches:
            out = []
            for row, t in zip(b.column("row_id").to_pylist(), text_bytes(b.column("text"))):
                _, ranges, ids = scan(t, a)
                if ranges:
                    out.append((row, np.array(ranges, np.int64).tobytes(), [str(x) for x in ids]))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.list_(pa.string())))],
                ["row_id", "ranges", "items"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for d, t, blobs, items in zip(b.column("doc_id").to_pylist(), text_bytes(b.column("text")),
                                      b.column("ranges").to_pylist(), b.column("items").to_pylist()):
            n = len(normal_words(t))
            cover = np.zeros(n + 1, np.int8)
            for blob in blobs or []:
                for s, e in np.frombuffer(blob, np.int64).reshape(-1, 2):
                    cover[s:e] = 1
            edge = np.diff(np.r_[0, cover])
            ranges = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
            out.append(_row(d, t, n, ranges, items or []))
        yield _batch(out)
