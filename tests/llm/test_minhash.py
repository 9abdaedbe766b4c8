"""MinHash near-duplicates (11) against all pairs, and the components alone."""

import random
import re

import pytest

from llm_support import docs  # noqa: F401
from shardcraft.llm import minhash, stars


def plain_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def plain_components(rows, n, num, den):
    sets = [(i, plain_set(t, n)) for i, t in rows]
    top = {i: i for i, _ in rows}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and min(len(x), len(y)) * den >= num * max(len(x), len(y)) and i != j:
                both = len(x & y)
                if den * both >= num * (len(x) + len(y) - both):
                    p, q = sorted((root(i), root(j)))
                    top[q] = p
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def edited(rng, words, share):
    return " ".join(rng.choice(["x", "y", "zz"]) + w if rng.random() < share else w for w in words)


def family_rows(rng, families=12, size=14, long=120):
    rows = []
    for f in range(families):
        base = [f"f{f}w{rng.randrange(60)}" for _ in range(long)]
        rows += [edited(rng, base, rng.choice([0, .01, .03, .05, .08, .12])) for _ in range(size)]
    return rows


@pytest.mark.parametrize("n, num", [(2, 80), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, docs, n, num):  # noqa: F811
    rng = random.Random(n)
    texts = family_rows(rng) + [None, "", " \n", "one", "One", "two words", "TWO words", "two  words x", "\x1c odd", "é É", "É é"]
    texts += texts[:25] + [("long " + "word%d " * 1) % 3 + " ".join(f"v{i}" for i in range(60_000))] * 2
    rng.shuffle(texts)
    got = minhash.near_duplicates(docs(texts, 1000).repartition(4), n, num, 100)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == plain_components(list(enumerate(texts, 1000)), n, num, 100)


@pytest.mark.parametrize("unit", [50_000, 0])
def test_a_large_family_spread_about_the_bound(spark, docs, monkeypatch, unit):  # noqa: F811
    """Copies that miss the first centre are found in the second round, in several cells,
    with a component's keys together or each by itself."""
    monkeypatch.setattr(minhash, "UNIT", unit)
    rng = random.Random(5)
    texts = family_rows(rng, 1, 260, 90)
    monkeypatch.setattr(minhash, "CELL", 20)
    monkeypatch.setattr(minhash, "SHARE", 50)
    monkeypatch.setattr(minhash, "GROUP", 10)
    got = minhash.near_duplicates(docs(texts), 2, 80, 100).collect()
    assert sorted(map(tuple, got)) == plain_components(list(enumerate(texts)), 2, 80, 100)


def test_rows_without_id_and_empty_table(spark):
    rows = [(None, "a b c d"), (None, "a b c d e f g h"), (4, "a b c d"), (4, "a b c d"), (4, "other words here"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, map(tuple, minhash.near_duplicates(df, 2).collect())))
    assert got == sorted(map(str, [(None, 3, 4, None), (None, 7, None, None), (4, 3, 4, True), (4, 3, 4, True), (4, 2, 4, True),
                                   (2, 0, 2, True)]))
    assert minhash.near_duplicates(df.where("false"), 2).collect() == []


def test_signatures_estimate_similarity():
    sets = minhash.Shingles(1)
    for share in (.5, .8):
        both = [f"s{i}" for i in range(int(2000 * share))]
        x, y = ([*both, *(f"{k}{i}" for i in range((2000 - len(both)) // 2))] for k in "ab")
        got = (minhash.signature(sets(" ".join(x).encode())) == minhash.signature(sets(" ".join(y).encode()))).mean()
        assert abs(got - share) < .15


def test_structured_words_have_different_sets():
    """Words that agree in every sum of powers modulo 2**64."""
    a = b = ""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    sets = minhash.Shingles(2)
    assert sets(a.encode())[0] != sets(b.encode())[0]


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(8)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(900, 901), (901, 902), (902, 900)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(5, 5)]
    rng.shuffle(pairs)
    top = {x: x for p in pairs for x in p}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        p, q = sorted((root(a), root(b)))
        top[q] = p
    want = sorted((x, root(x)) for x in top if any(x in p and p[0] != p[1] for p in pairs))
    got = stars.components(spark.createDataFrame([rng.choice([p, p[::-1]]) for p in pairs], "a long, b long"))
    assert sorted(map(tuple, got.collect())) == want
