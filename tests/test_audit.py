"""Audits of copies by bitmaps and by digests of key ranges."""

import random

import pytest
from pyspark.sql import functions as F

from shardcraft.operators import audit
from support import plan_text, rows


def test_bitmap_presence_equals_presence(spark):
    rng = random.Random(6)
    keys = [None, None, -70000, -32768, -1, 0, 1, 32768, 32769, 65536, 5_000_000_000,
            *(rng.randrange(-40000, 90000) for _ in range(400))]
    node = [k for k in keys if rng.random() < 0.6] + [7, 7, 123456]
    other = [k for k in keys if k is not None and rng.random() < 0.6]
    frame = lambda ks: spark.createDataFrame([(k,) for k in ks], "k long")
    src, nodes = frame(keys + keys[:9]), {"b": frame(node), "a": frame(other)}
    got = audit.presence_bitmaps(src, nodes, "k")
    assert rows(got) == rows(audit.presence(src, nodes, "k"))
    absent = audit.missing(src, nodes["b"], "k").distinct()
    assert rows(got.where(~F.col("on_b")).select("k")) == rows(absent)
    plan = plan_text(got)      # one exchange, of bitmaps made before it
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan.split("Exchange")[1]


def test_bitmap_presence_of_empty_copies_and_other_keys(spark):
    none = spark.createDataFrame([], "k int")
    some = spark.createDataFrame([(3,)], "k int")
    assert rows(audit.presence_bitmaps(none, {"n": some}, "k")) == []
    assert rows(audit.presence_bitmaps(some, {"n": none}, "k")) == [(3, False, False)]
    with pytest.raises(ValueError, match="integer key"):
        audit.presence_bitmaps(spark.createDataFrame([("x",)], "k string"), {"n": some}, "k")


def _copies(spark, tmp, drift):
    src = spark.range(0, 64_000, 1, 4).select(
        F.col("id").alias("k"), (F.col("id") * 0.5).alias("x"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("y"))
    src = src.unionByName(spark.createDataFrame([(None, 1.0, "n"), (-5, -0.0, None)], "k long, x double, y string"))
    for name, df in (("s", src), ("d", drift(src))):
        df.repartitionByRange(16, "k").sortWithinPartitions("k").write.parquet(f"{tmp}/{name}")
    return spark.read.parquet(f"{tmp}/s"), spark.read.parquet(f"{tmp}/d")


def test_range_diff_equals_the_exact_diff(spark, tmp):
    def drift(src):
        out = (src.where((F.col("k") != 63_999) | F.col("k").isNull())
               .withColumn("x", F.when(F.col("k").isin(10, 30_001), F.lit(-1.0)).when(F.col("k") == -5, 0.0)
                           .otherwise(F.col("x")))
               .withColumn("y", F.when(F.col("k").isNull(), F.lit("other")).otherwise(F.col("y"))))
        return out.unionByName(spark.createDataFrame([(-5000, 1.0, "z")], "k long, x double, y string"))

    s, d = _copies(spark, tmp, drift)
    got = audit.diff_in_ranges(s, d, "k", bits=8)
    assert rows(got) == rows(audit.diff(s, d, "k")) == [
        (-5000, "only_replica"), (10, "changed"), (30_001, "changed"), (63_999, "only_source"), (None, "changed")]
    stored = [audit.range_digests(df, "k", bits=8) for df in (s, d)]
    assert rows(audit.diff_in_ranges(s, d, "k", bits=8, src_digests=stored[0], dst_digests=stored[1])) == rows(got)
    # one bit pattern of NULLs is told from another, and a level above is the digest of its range
    assert rows(audit.coarser(stored[0], 3)) == rows(audit.range_digests(s, "k", bits=11))
    assert rows(audit.differing_ranges(stored[0], stored[0])) == []


def test_range_diff_reads_few_rows_for_few_differences(spark, tmp):
    """Rows read grow with the number of differing ranges; the filter reaches the files."""
    def read(changed):
        path = f"{tmp}/{len(changed)}"
        s, d = _copies(spark, path, lambda src: src.withColumn(
            "x", F.when(F.col("k").isin(changed), F.lit(-1.0)).otherwise(F.col("x"))))
        ranges = audit.differing_ranges(*(audit.range_digests(df, "k", bits=8) for df in (s, d)))
        near = s.where(audit.in_ranges("k", ranges, 8))
        assert "GreaterThanOrEqual(k" in plan_text(near)
        assert sorted(r.k for r in audit.diff_in_ranges(s, d, "k", bits=8).collect()) == sorted(changed)
        return near.count()

    assert read([100]) == 256
    assert read([100, 40_000]) == 512
    assert read([100, 101, 102]) == 256


def test_range_diff_with_more_ranges_than_the_filter_holds(spark, tmp):
    s, d = _copies(spark, tmp, lambda src: src.withColumn(
        "x", F.when(F.col("k") % 300 == 7, F.lit(-1.0)).otherwise(F.col("x"))))
    got = audit.diff_in_ranges(s, d, "k", bits=4)
    assert rows(got) == rows(audit.diff(s, d, "k")) and got.count() == 214
