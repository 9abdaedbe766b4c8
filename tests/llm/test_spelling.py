"""Spelling variants (12) against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from shardcraft.llm import spelling


def plain_words(rows, shortest=6, least=5, deletion=199):
    count = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % deletion == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= shortest and n >= least}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(words, ratio=5):
    out, form = {}, {}
    for w, n in words.items():
        close = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(close, default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None
        out[w] = (n, len(close), -best[0] if form[w] else None)
    rows = []
    for w, (n, k, m) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, k, m))
    return sorted(rows)


def variants(rng, letters, n):
    """Words in families with one error between them, some chains, runs of one letter."""
    out = set()
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 13)))
        out.add(w)
        for _ in range(rng.randrange(4)):
            i, c = rng.randrange(len(w) + 1), rng.choice(letters)
            w = rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]])
            if len(w) >= 6:
                out.add(w)
    return sorted(out)


@pytest.mark.parametrize("letters, n", [("ab", 150), ("abcdeé", 400), ("aaaaaaaab", 60), ("abcdefghijklmnopqrstuvwxyzßÿ", 300)])
def test_index_finds_all_words_one_error_away(letters, n):
    words = variants(random.Random(n), letters, n)
    index = spelling.BiIndex(words)
    assert index.words == words
    seekers = words[::3] + ["zzzzzz", "abàaaa"]
    found = set()
    for right in (True, False):
        own, rank = index.search(seekers, right)
        pairs = {(seekers[i], words[r]) for i, r in zip(own.tolist(), rank.tolist())}
        for a, b in pairs:
            h = len(a) // 2
            assert near(a, b) and (b.startswith(a[:h]) if right else b.endswith(a[h:]))
        found |= pairs
    assert found == {(a, b) for a in seekers for b in words if near(a, b)}


@pytest.mark.parametrize("index_chars", [60_000, 300])
def test_spelling_groups_equal_a_plain_comparison(spark, index_chars):
    rng = random.Random(12)
    words = variants(rng, "abcdeÉé", 300)
    rows = [(i, " ".join(rng.choice(words[:1 + rng.randrange(len(words))]).title() + rng.choice(["", ",", "1", "×"])
                         for _ in range(rng.randrange(120)))) for i in range(250)]
    rows += [(i, "marken " * 200 + "markan " * 30 + "markaan " * 5) for i in (1001, 1002)]   # a chain of forms
    rows += [(None, " ".join(words[:40])), (7, None), (None, None), (8, ""), (9, "a" * 30_000 + " "), (9, "Chaîne " * 9)]
    rows += rows[:30]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, word string, n int")
    got = spelling.spelling_groups(df.repartition(5), index_chars=index_chars)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain(plain_words(rows))
    assert sorted(map(tuple, got.collect())) == want
    assert any(f and r != f for _, f, r, *_ in want)


def test_a_run_can_lose_a_letter(spark):
    rows = [(i, "planten planten") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(plain_words(rows, least=1))
    assert len(want) > 1
    assert sorted(map(tuple, spelling.spelling_groups(df, least=1).collect())) == want


def test_no_rows_for_an_empty_table(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
