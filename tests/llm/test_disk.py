"""What the pipeline and its Jaccard stage keep on disk at one time."""

import os
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shardcraft.llm import common, jaccard


def _prose(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def _near(rng, base, changes):
    w = list(base)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_segments_are_dealt_into_rounds_of_like_size():
    rng = random.Random(1)
    texts = [" ".join(_prose(rng, rng.randrange(3, 600))) for _ in range(60)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array([*range(61), None], pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    def entries(*turn):
        out = list(jaccard._emit(5, 80, 100, *turn)(iter([batch])))
        return [np.concatenate(x).tolist() for x in zip(*(e for kind, e in out if kind == 0))], [e for kind, e in out if kind]

    whole, rows = entries()
    dealt = [entries(turn, 3) for turn in range(3)]
    assert sorted(zip(*whole)) == sorted(x for part, _ in dealt for x in zip(*part))
    assert max(len(part[0]) for part, _ in dealt) < 0.4 * len(whole[0])
    assert [len(r) for _, r in dealt] == [len(rows), 0, 0]          # the rows come once


def test_products_of_many_pairs_go_in_rounds(spark, monkeypatch):
    rng, names = random.Random(2), []
    base = _prose(rng, 60)
    sets = list(jaccard.shingle_sets([_near(rng, base, rng.randrange(3)).encode() for _ in range(16)], 5))
    vectors = common.written(spark.createDataFrame([(i, bytearray(g.tobytes())) for i, g in enumerate(sets)],
                                                   "node long, grams binary"), "vectors")
    pairs = [(i, j) for i in range(16) for j in range(i)]
    write = jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: names.append(name) or write(df, name))
    got = jaccard.linked(common.written(spark.createDataFrame(pairs, "a long, b long"), "pairs"), vectors, 80, 100)
    near = {(i, j) for i, j in pairs if len(np.intersect1d(sets[i], sets[j])) * 100 >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert {tuple(r) for r in got.collect()} == near and 0 < len(near) < len(pairs)
    assert len(names) == 8 + 1                                      # 120 pairs, 16 vectors, and all together


def test_blocks_that_meet_travel_in_rounds_and_the_lighter_one_to_the_other(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 2)
    rng, met, names = random.Random(3), [], []
    base = _prose(rng, 40)
    texts = [" ".join(base[:20] + _prose(rng, 14)) for _ in range(40)] + [_near(rng, base, k % 4) for k in range(30)]
    sets = [set(g.tolist()) for g in jaccard.shingle_sets([t.encode() for t in texts], 2)]
    ids = [int(jaccard.set_id(np.array(sorted(s), np.uint64)).view(np.int64)) for s in sets]
    vectors = common.written(spark.createDataFrame(
        [(i, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in zip(ids, sets)], "node long, grams binary"), "vectors")
    apart = common.written(spark.createDataFrame(
        [(key, node, node, 0, len(s)) for node, s in zip(ids, sets) for key in sorted(s)[:8]],
        "key long, comp long, node long, level int, n int"), "apart")
    write = jaccard.written

    def watched(df, name):
        names.append(name)
        out = write(df, name)
        if name == "jaccard-meetings":
            met.extend(out.collect())
        return out

    monkeypatch.setattr(jaccard, "written", watched)
    links = {tuple(sorted(r)) for r in jaccard._open_links(apart, vectors, 60, 100).collect()}
    weight = {}
    for r in met:
        weight[r["i"]] = min(weight.get(r["i"], r["weight"]), r["weight"])
    assert len(met) > len(weight) and all(r["weight"] == weight[r["i"]] for r in met)
    assert names.count("jaccard-links2") >= 3
    near = {(a, b) for a, s in zip(ids, sets) for b, t in zip(ids, sets)
            if a < b and len(s & t) * 100 >= 60 * len(s | t) and set(sorted(s)[:8]) & set(sorted(t)[:8])}
    comps = lambda pairs: spark.createDataFrame(sorted(pairs), "a long, b long")
    found, want = ({tuple(r) for r in jaccard.components(comps(p)).distinct().collect()} for p in (links, near))
    assert links and found == want


def test_pipeline_drops_a_stages_table_when_the_next_is_written(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    base = common.scratch_path(spark, "x").rpartition("/")[0].removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    spark.range(9).withColumn("stage", F.lit(0)).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [
        (str(i), lambda s, d, _, i=i: d.withColumn("stage", F.col("stage") + F.lit(10 ** i))) for i in range(5)])
    out = corpus_pipeline.run(spark, str(tmp_path))
    new = sorted(x.rpartition("-")[0] for x in set(os.listdir(base)) - before)
    assert new == ["pipeline-4"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(i, 11111) for i in range(9)]
