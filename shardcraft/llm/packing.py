"""Sequence packing by minimum bin slack.

Documents are tokenised once; a document longer than the capacity is cut into
full windows and one remainder, so a piece has one of ``capacity`` lengths.
What has to be planned is therefore a histogram of at most ``capacity`` rows,
whatever the corpus' size: for the largest remaining length a bitset
subset-sum over the remaining lengths finds the multiset that fills the window
closest to capacity (back-tracked with counts), and the filling is repeated as
often as its counts allow.  Every filling leaves some length with less than one
more use, so there are at most sum(1 + capacity/length), under 20,000 for 2048,
different fillings: that bounds the plan that travels to the executors.

A piece finds its place by its number among the pieces of its length, which is
its number within its partition plus a prefix sum over partitions.

Defined results: null and empty texts are one piece with the end id alone;
repeated rows are packed one by one; an empty table gives no rows; other input
columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, local_ranks, rank_bases, written

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, rank long")
TEXT_CHARS = 1 << 19           # characters that are looked up at once, about
RESULT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")


# ---------------------------------------------------------------- tokenising

#: classes of UTF-8 bytes: white space, letters, digits, other signs, and what only the tokenizer splits
BLANK, LETTER, DIGIT, SIGN, ODD = range(5)
_CLASS = np.full(256, ODD, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = BLANK
_CLASS[0x21:0x7F] = SIGN
_CLASS[0x27] = ODD
_CLASS[0x30:0x3A] = DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = LETTER
_CLASS[0x80:0xC0] = _CLASS[0xC3] = LETTER       # À to ÿ; the first bytes of other characters are odd


def _pretokens(buf: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pre-tokens of a text in lower case, where each begins, and whether it is an odd chunk."""
    kind = _CLASS[buf]
    odd = kind == ODD
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    odd[lead[np.isin(buf[lead + 1], (0x97, 0xB7))]] = True         # multiplication and division signs
    odd[:-1] |= (buf[:-1] == 0x3C) & (buf[1:] == 0x7C)             # "<|" may begin a special token
    full = kind != BLANK
    edge = np.ones(len(buf), bool)
    edge[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    upper = (buf >= 0x41) & (buf <= 0x5A)
    upper[lead + 1] = buf[lead + 1] < 0x9F                         # À to Þ
    if odd.any():
        chunk = np.cumsum(~full, dtype=np.int32)
        whole = np.zeros(int(chunk[-1]) + 1, bool)
        whole[chunk[odd]] = True
        odd = whole[chunk]
        after = np.r_[True, ~full[:-1]]
        edge = np.where(odd, after, edge)
        upper &= ~odd
    edge &= full
    at = np.flatnonzero(edge)
    ends = np.r_[np.flatnonzero(edge[full]), np.count_nonzero(full)].astype(np.int32)
    data = (buf + (upper.view(np.uint8) << 5))[full]
    tokens = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data))
    return tokens, at, odd[at]


class WordCache:
    """Token ids of texts, from the tokenizer, kept per pre-token.

    The tokenizer drops white space and never joins over it, so a text's ids
    are the ids of its chunks in order.  Stretches of plain letters, digits and
    punctuation are split into pre-tokens here, some texts at a time; a chunk with anything
    else goes as it is, known by a leading space.  Each distinct pre-token is looked up once, and
    the unseen ones go to the tokenizer in one text.  Where the vocabulary ends words with a suffix, that
    tells their ids apart; else each is followed by a mark that has an id of its own.  Two
    generations of bounded size hold what was seen last.
    """

    MARK = "\x02"
    KEPT_WHOLE = re.compile("[\x1c-\x1f]")      # str.split() would cut here, the tokenizer doesn't
    OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    #: what the tokenizer does to a text before it looks for words; to plain pre-tokens this does nothing more
    NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.young, self.old = {}, {}
        self.mark = self.tokenizer.encode(f"a {self.MARK} a", add_special_tokens=False).ids[1:-1]
        ids = self.tokenizer.encode(f"a{self.MARK}", add_special_tokens=False).ids
        if len(self.mark) != 1 or ids[1:] != self.mark:
            self.mark = None                     # another vocabulary: pre-tokens go one by one
        self.plain, self.last = self._for_plain(path)

    def _for_plain(self, path: str):
        """The same model for pre-tokens parted by spaces, without the steps that pre-tokens have behind
        them, and which ids end a word; (None, None) if the tokenizer isn't known to work so."""
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps, model = (spec.get("pre_tokenizer") or {}).get("pretokenizers", []), spec["model"]
        suffix = model.get("end_of_word_suffix")
        if not (suffix and model["type"] == "BPE" and (spec.get("normalizer") or {}).get("normalizers") == self.NORMALIZER
                and len(steps) == 2 and steps[0].get("pattern") == {"Regex": self.SPLIT}
                and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
                and steps[1].get("type") == "ByteLevel" and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
                and not spec.get("truncation") and not spec.get("post_processor")):
            return None, None
        plain = Tokenizer.from_file(path)
        plain.normalizer = None
        plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        last = np.zeros(max(model["vocab"].values()) + 1, bool)
        last[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        return plain, last

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, unseen: list[str]) -> None:
        odd = [p for p in unseen if p[0] == " "]
        self.young.update(zip(odd, self._encoded([p[1:] for p in odd])))
        unseen = [p for p in unseen if p[0] != " "] if odd else unseen
        for s in range(0, len(unseen), 20_000):
            some = unseen[s:s + 20_000]
            raw, at, ends = self._together(some)
            if len(ends) == len(some):
                self.young.update((p, raw[i:j]) for p, i, j in zip(some, at, ends))
            else:                                # a pre-token that holds the mark, or no way to tell ids apart
                self.young.update(zip(some, self._encoded(some)))

    def _together(self, some: list[str]) -> tuple[bytes, list[int], list[int]]:
        """Ids of pre-tokens in one text, and where those of each begin and end; another number of
        ends if that can't be told."""
        if self.plain is not None:
            ids = self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ids = np.array(ids, np.uint32)
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) == len(some) and ends[-1] == 4 * len(ids):
                return ids.tobytes(), [0, *ends[:-1].tolist()], ends.tolist()
        if self.mark is None:
            return b"", [], []
        raw = self._encoded([f" {self.MARK} ".join(some)])[0]
        marks = np.flatnonzero(np.frombuffer(raw, np.uint32) == self.mark[0]) * 4
        return raw, [0, *(marks + 4).tolist()], [*marks.tolist(), len(raw)]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        if not texts:
            return []
        raw = [(t if t.isascii() else self.OTHER_SPACE.sub(" ", t)).encode() for t in texts]
        buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        whole = []
        if ((buf >= 0x1C) & (buf <= 0x1F)).any():
            whole = [i for i, t in enumerate(texts) if self.KEPT_WHOLE.search(t)]
            for i in whole:
                raw[i] = b""
            buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        tokens, at, odd = _pretokens(buf)
        tokens = tokens.dictionary_encode()
        known = tokens.dictionary.to_numpy(zero_copy_only=False).tolist()
        for i in np.unique(tokens.indices.to_numpy()[odd]).tolist():
            known[i] = " " + known[i]
        if len(self.young) >= self.limit:
            self.young, self.old = {}, self.young
        ids = list(map(self.young.get, known))
        wanted = [i for i, x in enumerate(ids) if x is None]
        again = {p: x for p in map(known.__getitem__, wanted) if (x := self.old.get(p)) is not None}
        self.young.update(again)
        if len(again) < len(wanted):
            self._learn([p for p in map(known.__getitem__, wanted) if p not in again])
        for i in wanted:
            ids[i] = self.young[known[i]]
        ids = pa.array(ids, pa.large_binary()).take(tokens.indices)
        _, offsets, data = ids.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(ids) + 1, 8 * ids.offset)
        doc_end = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        cut = [0, *offsets[np.searchsorted(at, doc_end)].tolist()]
        data = data.to_pybytes() if data is not None else b""
        out = [data[i:j] for i, j in zip(cut[:-1], cut[1:])]
        for i, got in zip(whole, self._encoded([texts[i] for i in whole])):
            out[i] = got
        return out

    def ids(self, text: str) -> bytes:
        return self.ids_of([text])[0]


def worker_cache(path: str) -> WordCache:
    """The worker's cache, kept from task to task; its size is bounded."""
    return kept((WordCache, path), lambda: WordCache(path))


def _ids(cache: WordCache, texts: pa.Array) -> Iterator[bytes]:
    """Ids of every text (null: empty), for some texts at a time."""
    some, size = [], 0
    for t in texts.to_pylist():
        some.append(t or "")
        size += len(some[-1])
        if size >= TEXT_CHARS:
            yield from cache.ids_of(some)
            some, size = [], 0
    if some:
        yield from cache.ids_of(some)


def _pieces(path: str, end_id: int, capacity: int):
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = worker_cache(path), {}
        part = TaskContext.get().partitionId()
        for b in batches:
            cols = [array("q") for _ in range(4)]
            docs = []
            for doc, ids in zip(b.column(0).to_pylist(), _ids(cache, b.column(1))):
                ids += tail
                n = len(ids) // 4
                for s in range(0, n, capacity):
                    piece = ids[4 * s:4 * (s + capacity)]
                    docs.append(doc)
                    for c, v in zip(cols, (s, len(piece) // 4, zlib.crc32(piece), n)):
                        c.append(v)
            start, length, crc, n = (np.frombuffer(c, np.int64) if len(c) else np.zeros(0, np.int64) for c in cols)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(start), pa.array(length), pa.array(crc), pa.array(n),
                 pa.array(np.full(len(docs), part, np.int32)), pa.array(local_ranks(length, seen))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"])

    return run


# ------------------------------------------------------------------ planning

def closest_fill(classes: list[tuple[int, int]], room: int) -> Counter:
    """The multiset of lengths, out of ``(length, count)`` classes, whose sum is
    closest to ``room`` from below.

    Bit ``s`` of ``reach`` tells that sum ``s`` can be made; counts enter as
    1, 2, 4, ... copies.  Walking the steps backwards recovers the counts.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, count in classes:
        left, copies = min(count, room // length), 1
        while left > 0 and not reach >> room & 1:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left -= take
            copies *= 2
        if reach >> room & 1:
            break
    total, picked = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            picked[length] += take
            total -= length * take
    return picked


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Fillings ``(lengths with counts, repetitions)`` that use up the histogram.
    Each is seeded with the largest length that is left."""
    left = {n: c for n, c in histogram.items() if c > 0}
    order = sorted(left, reverse=True)
    out = []
    while order:
        seed = order[0]
        filling = closest_fill([(n, left[n] - (n == seed)) for n in order if n <= capacity - seed], capacity - seed)
        filling[seed] += 1
        times = min(left[n] // c for n, c in filling.items())
        for n, c in filling.items():
            left[n] -= c * times
        order = [n for n in order if left[n]]
        out.append((filling, times))
    return out


def placement(fillings: list[tuple[Counter, int]]) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset),
    sorted; a piece takes the last row of its length whose first rank it reaches."""
    used, rows, sequence = Counter(), [], 0
    for filling, times in fillings:
        offset = 0
        for length, count in sorted(filling.items(), reverse=True):
            rows.append((length, used[length], count, sequence, offset))
            used[length] += count * times
            offset += count * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(plan: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.unique(plan[:, 0])
        first = np.searchsorted(plan[:, 0], lengths)
        last = np.searchsorted(plan[:, 0], lengths, side="right")
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("number").to_numpy()
            row = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                i = np.searchsorted(lengths, n)
                mine = length == n
                row[mine] = first[i] + np.searchsorted(plan[first[i]:last[i], 1], rank[mine], side="right") - 1
            _, lo, per, seq, off = plan[row].T if len(row) else np.zeros((5, 0), np.int64)
            j = rank - lo
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")),
                 pa.array(seq + j // per), pa.array(off + j % per * length)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack_documents(documents: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """One row per piece, see :data:`RESULT`."""
    pieces = written(documents.select("doc_id", "text").mapInArrow(_pieces(tokenizer_path, end_id, capacity), PIECE),
                     "packing-pieces")
    bases = written(rank_bases(pieces, "length"), "packing-bases")
    histogram = {r["length"]: r["n"] for r in          # at most `capacity` rows
                 bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = placement(minimum_bin_slack(histogram, capacity))
    return (pieces.join(bases.drop("n"), ["length", "part"])
            .withColumn("number", F.col("base") + F.col("rank"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "number")
            .mapInArrow(_place(plan), RESULT))
