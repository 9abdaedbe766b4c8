"""Phrase collocations (13) against a plain count."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest

from shardcraft.llm import collocations, common

WITHIN, SCALE = 80, 2_000_000


def plain(rows, least, longest, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + k] for p, a in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                if 100 * a >= WITHIN * count[p[i:i + k]]}
        rows = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((SCALE * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def phrase_rows(rng, n=300):
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "é", "ß", " x", "\x1c", "Z9"]
    fixed = ["alpha Beta gamma delta", "new york city", "Of the"]
    out = []
    for i in range(n):
        words = [rng.choice(fixed) if rng.random() < .2 else rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " "]) for w in words)
        out.append((rng.choice(["en", "de", None, "und", ""]), text))
    out += [("en", None), (None, None), ("en", ""), ("fr", " .. \n\t"), ("es", "w1 " * 20000), ("es", "a,b." * 500)]
    return out + out[:20]


@pytest.mark.parametrize("shard_words, least, longest", [(1 << 20, 5, 4), (700, 5, 4), (64, 3, 3), (700, 8, 2)])
def test_collocations_equal_a_plain_count(spark, shard_words, least, longest):
    rows = phrase_rows(random.Random(shard_words))
    df = spark.createDataFrame([(a, b, 7, "x") for a, b in rows], "lang string, text string, shard int, word string")
    got = collocations.collocations(df.repartition(5), least, longest, top=60, shard_words=shard_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, least, longest, 60)


def test_extensions_are_the_largest_counts_one_word_further(spark):
    rows = [("en", "a b c")] * 6 + [("en", "a b d")] * 5 + [("en", "z a b")] * 5
    phrases, totals = collocations.mine_phrases(spark.createDataFrame(rows, "lang string, text string"), 5)
    got = {r["phrase"]: (r["f"], r["left_f"], r["right_f"]) for r in phrases.collect()}
    assert got["a b"] == (16, 5, 6) and got["a"] == (16, 5, 16) and got["a b c"] == (6, None, None)
    assert [tuple(r) for r in totals.collect()] == [("en", 48)]


def test_no_rows_for_an_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df).collect() == []


def test_long_texts_are_cut_between_pieces():
    text = b"one two\n" * 300_000 + b"tail" * 500_000
    cuts = list(collocations._cuts(text))
    assert b"".join(cuts) == text and len(cuts) > 2 and all(c.endswith(b"\n") for c in cuts[:-1])
    assert list(collocations._cuts(b"")) == [b""]


def test_what_shards_are_told_is_packed():
    rng = np.random.default_rng(5)
    n = 20_000
    shard, a, number = rng.integers(0, 3, n), np.sort(rng.integers(0, 1 << 40, n)), np.arange(n) + (7 << 32)
    b = rng.integers(0, 1 << 20, n)
    cells = collocations._told_cells(shard, a, b, number)
    assert [c[0] for c in cells] == [0, 1, 2] and sum(len(c[2]) for c in cells) < 11 * n    # rows took 29 bytes each
    for k, size, cell in cells:
        for got, want in zip(collocations._told_entries(size, cell), (a, b, number)):
            assert got.tolist() == want[shard == k].tolist()
    words = np.r_[0, rng.integers(0, 900, n)].astype(np.int32)
    first = collocations.Shard(words, words - 1, np.arange(900))
    deep = collocations.Shard(words, np.where(words > 800, words - 700, -1).astype(np.int32), np.arange(900))
    assert len(first.cell()) < 2 * n and len(first.cell()) < len(deep.cell())
    for x in (first, deep):
        y = collocations.Shard.of(x.cell())
        assert (x.words == y.words).all() and (x.grams == y.grams).all() and (x.numbers == y.numbers).all()


def test_buckets_answer_in_the_order_of_the_entries():
    rng = np.random.default_rng(6)
    n, buckets, base = 40_000, 7, 5 << 32
    words = np.r_[0, rng.integers(0, 300, n)].astype(np.int32)
    shard = collocations.Shard(words, words - 1, base + np.cumsum(rng.integers(1, 9, 300)))
    assert len(shard.cell()) < len(collocations.packed(words)) + 400           # numbers took up to 3 bytes each
    p, s, count = shard.entries(1)
    order, cut = collocations._dealt(p, s, buckets)
    answers, want, size = [], {}, 0
    for bucket in range(buckets):
        own = order[cut[bucket]:cut[bucket + 1]]
        many = count[own] > 1
        numbers = (bucket << 32) + np.cumsum(rng.integers(1, 3, int(many.sum())))
        want |= dict(zip(zip(p[own][many].tolist(), s[own][many].tolist()), numbers.tolist()))
        answers.append((len(own), collocations._answer(bucket, many, numbers)))
        size += len(answers[-1][1])
    assert want and size < len(p) / 2                                          # 6 bytes an n-gram before
    deep = collocations.Shard.of(shard.cell()).deeper(answers[::-1], buckets, 2)
    number = shard.numbers
    pairs = [(int(number[a - 1]), int(number[b - 1])) if a and b else None for a, b in zip(words, words[1:])]
    got = [int(deep.numbers[g]) for g in deep.grams if g >= 0]
    assert got == [want[x] for x in pairs if x in want] and (np.diff(deep.numbers) > 0).all()


def test_entries_go_when_they_are_summed(spark, monkeypatch):
    gone = []
    discard_part = collocations.discard_part
    monkeypatch.setattr(collocations, "discard_part", lambda df, part: gone.append(part) or discard_part(df, part))
    rows = [("en", "a b c d e")] * 40
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string")).collect()
    assert gone == ["whole=false"] * 3
    assert sorted(map(tuple, got)) == plain(rows, 30, 4, 2000)


def test_words_are_gone_before_n_grams_are_counted(spark, monkeypatch):
    there, tables = {}, {}

    def watched(df, name, by=None):
        there[name] = {n: sorted(f.name for f in Path(urlparse(t.written_at).path).glob("*=*")) for n, t in tables.items()}
        tables[name] = out = common.written(df, name, by)
        return out

    monkeypatch.setattr(collocations, "written", watched)
    df = spark.createDataFrame([("en", "a b c a b d. a b")] * 40, "lang string, text string")
    phrases, _ = collocations.mine_phrases(df, shard_words=50)
    assert {r.phrase: r.f for r in phrases.where("words = 2").collect()} == {"a b": 120, "b c": 40, "c a": 40, "b d": 40}
    assert there["phrases-words"]["phrases-shards"] == ["whole=false", "whole=true"]
    assert there["phrases-counted-2"]["phrases-shards"] == ["whole=true"]       # the words lay there beside the n-grams
    assert "phrases-told" in there["phrases-counted-2"] and there["phrases-summed-2"]["phrases-shards"] == []
