"""Token counts under a unigram segmentation, by dynamic programming on a trie.

The pre-tokens (runs without white space, with a leading space marker) of a
task's documents are gathered once each and laid out as a trie, level by level: a
node is a distinct prefix.  The forward score of a node, the best
log-probability of segmenting its prefix into vocabulary pieces, depends on its
ancestors only, so it is computed once however many pre-tokens share the prefix.
At a pre-token's terminal node the number of pieces on the best path is its
count; documents add up the counts of their pre-tokens.

The vocabulary is a published one (ids in order of frequency): a piece of id r
has the Zipf probability 1 / (r + 2), a single byte outside it 1 / (4 * size).
Scores are integers (2**-32 nats), so sums don't depend on order; among equal
scores fewer pieces win.

Tries hold a bounded number of pre-token bytes and are dropped with their
batch; no exchange of data between tasks is needed.

Defined results: null and empty texts count 0; repeated rows count alike; an
empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import U64, mix, powers, slices, text_bytes

RESULT = "doc_id long, n_pretokens long, n_distinct long, n_tokens long"
SCALE = 1 << 32


class Vocabulary:
    """Pieces as hashes per length, with integer scores."""

    def __init__(self, pieces: list[bytes]):
        self.longest = max(map(len, pieces), default=1)
        self.unknown = round(-math.log(4 * max(1, len(pieces))) * SCALE)
        best: dict[bytes, int] = {}
        for rank, p in enumerate(pieces):
            best.setdefault(p, round(-math.log(rank + 2) * SCALE))
        self.scores = best
        self.by_length = {}
        for n in range(1, self.longest + 1):
            own = sorted((int(piece_hash(p)), s) for p, s in best.items() if len(p) == n)
            if own:
                self.by_length[n] = (np.array([h for h, _ in own], U64), np.array([s for _, s in own], np.int64))

    def score(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of strings of ``n`` bytes, and which are pieces."""
        h, s = self.by_length.get(n, (np.zeros(0, U64), np.zeros(0, np.int64)))
        if not len(h):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(h, hashes), len(h) - 1)
        return s[at], h[at] == hashes


def piece_hash(p: bytes) -> np.ndarray:
    v = np.frombuffer(p, np.uint8).astype(U64) + U64(1)
    return mix(np.add.reduce(v * powers(len(v))[0]) + mix(U64(len(v)) + np.zeros(1, U64)))[0]


def load_pieces(path: str) -> list[bytes]:
    """Pieces of a sentencepiece model in id order, without its special ids; the
    word marker becomes a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]


def counts_of(pretokens: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Pieces on the best path of each distinct pre-token."""
    size = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
    out = np.zeros(len(pretokens), np.int64)
    order = np.argsort(size, kind="stable")[::-1]           # longest first: live ones are a prefix
    start = np.concatenate([[0], np.cumsum(size[order])])[:-1]
    buf = np.frombuffer(b"".join(pretokens[i] for i in order), np.uint8).astype(U64) + U64(1)
    p, q = powers(int(size.max(initial=0)) + 1)
    within = np.arange(len(buf)) - np.repeat(start, size[order])
    sums = np.concatenate([[U64(0)], np.cumsum(buf * p[within])]).astype(U64)
    longest = vocabulary.longest
    best, used, node = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(len(pretokens), np.int64)]
    for depth in range(1, int(size.max(initial=0)) + 1):
        live = int(np.searchsorted(-size[order], -depth, side="right"))
        at = start[:live] + depth
        prefix = sums[at] - sums[start[:live]]
        _, first, mine = np.unique(prefix, return_index=True, return_inverse=True)   # this level's nodes
        top = np.full(len(first), np.iinfo(np.int64).min)
        few = np.zeros(len(first), np.int64)
        for n in range(1, min(depth, longest) + 1):
            tail = (sums[at[first]] - sums[at[first] - n]) * q[depth - n]
            score, known = vocabulary.score(n, mix(tail + mix(np.full(len(first), n, U64))))
            if n == 1:
                score, known = np.where(known, score, vocabulary.unknown), np.ones(len(first), bool)
            up = node[-n][first]
            total, pieces = best[-n][up] + score, used[-n][up] + 1
            take = known & ((total > top) | (total == top) & (pieces < few))
            top, few = np.where(take, total, top), np.where(take, pieces, few)
        best.append(top), used.append(few), node.append(mine)
        if len(best) > longest:
            best, used, node = best[-longest:], used[-longest:], node[-longest:]
        done = int(np.searchsorted(-size[order], -(depth + 1), side="right"))
        out[order[done:live]] = few[mine[done:live]]
    return out


_LOADED: dict[str, Vocabulary] = {}      # lives as long as the Python worker


def vocabulary_of(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(load_pieces(path))
    return _LOADED[path]


def count_tokens(documents: DataFrame, model_path: str) -> DataFrame:
    """One row per document, see :data:`RESULT`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model_path)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), text_bytes(b.column(1))
            for s, e in slices(texts):
                split = [t.split() for t in texts[s:e]]
                number: dict[bytes, int] = {}
                for ws in split:
                    for w in ws:
                        number.setdefault(w, len(number))
                count = counts_of([b" " + w for w in number], vocabulary)
                rows = [np.fromiter(map(number.__getitem__, ws), np.int64, len(ws)) for ws in split]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[s:e], pa.int64()), pa.array([len(r) for r in rows], pa.int64()),
                     pa.array([len(np.unique(r)) for r in rows], pa.int64()),
                     pa.array([int(count[r].sum()) for r in rows], pa.int64())],
                    ["doc_id", "n_pretokens", "n_distinct", "n_tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, RESULT)
