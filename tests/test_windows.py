"""Windows: the chunked forms equal plain windows; W1 equals sequential replay."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import plan_text, rows
from shardcraft.functions import generate
from shardcraft.operators import runs, windows


def _replay(transfers):
    """Sequential replay of the ledger rule: insert a 0-balance row, then
    subtract the debit from every row of the account."""
    table = []
    for tid, acct, typ, amt in transfers:
        table.append([tid, acct, typ, amt, Decimal("0.00")])
        if typ == "DEBIT":
            for r in table:
                if r[1] == acct:
                    r[4] -= amt
    return {r[0]: r[4] for r in table}


def test_ledger_balance_equals_replay(spark):
    led = generate.ledger(spark, 300, seed=7)
    # a hot account: a third of all transfers hit account 1
    hot = led.withColumn("account_id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("account_id")))
    got = {r.id: r.balance for r in windows.ledger_balance(hot, runs=16).collect()}
    src = sorted((r.id, r.account_id, r.transaction_type, r.amount) for r in hot.collect())
    assert got == _replay(src)


def test_suffix_sum_matches_plain_window(spark):
    df = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 3).alias("k"),
                                     (F.col("id") * 7 % 11).alias("v"))
    chunked = windows.suffix_sum(df, "k", "id", F.col("v"), "s", runs=37)
    plain = df.withColumn("s", F.sum("v").over(
        Window.partitionBy("k").orderBy("id").rowsBetween(0, Window.unboundedFollowing)))
    assert rows(chunked, ["id", "s"]) == rows(plain, ["id", "s"])


def test_balanced_lag_matches_plain_lag(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 2).alias("k"),
                                     (F.col("id") * 13 % 17).alias("v"))
    got = windows.balanced_lag(df, "k", "id", "v", "p", runs=9)
    ref = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("id")))
    assert rows(got, ["id", "p"]) == rows(ref, ["id", "p"])


def test_counter_deltas_reset(spark):
    s = spark.createDataFrame([
        ("n1", "2024-01-01 00:00:00", "c", 10), ("n1", "2024-01-01 01:00:00", "c", 15),
        ("n1", "2024-01-02 00:00:00", "c", 3), ("n1", "2024-01-02 05:00:00", "c", 8)],
        "node string, snapshot_ts string, variable_name string, value long") \
        .withColumn("snapshot_ts", F.col("snapshot_ts").cast("timestamp_ntz"))
    d = [r.delta for r in windows.counter_deltas(s).orderBy("snapshot_ts").collect()]
    assert d == [None, 5, 3, 5]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 5, "x")], "k int, pos int, v string")
    assert rows(windows.latest_per_key(df, "k", "pos")) == [(1, 3, "c"), (2, 5, "x")]


def test_last_n_uses_group_limit(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2).alias("s"), F.col("id").alias("ts"),
                                     (F.col("id") % 10).cast("double").alias("v"))
    out = windows.last_n(df, "s", "ts", 3, "v", avg_over=2)
    assert "WindowGroupLimit" in plan_text(out)
    r = {(x.s, x.recency): x for x in out.collect()}
    assert r[(1, 1)].ts == 4999 and r[(1, 1)].moving_avg == (9.0 + 7.0) / 2
    assert len(r) == 6


def test_a_hot_account_with_sparse_ids_is_spread_over_all_runs(spark):
    """A third of all rows on one account, ids 10**12 apart: every run gets its share, and
    the rows are exchanged once."""
    n, width = 3000, 12
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 10 ** 12).alias("id"), (F.col("id") % 11).alias("v"))
    dealt = runs.dealt(runs.in_runs(df, ["k"], "id", width), width)
    sizes = [r.n for r in dealt.where("k = -7").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == n // 3 and len(sizes) >= width // 3 and max(sizes) <= 2 * n // width
    out = windows.suffix_sum(df, "k", "id", F.col("v"), "s", runs=width)
    plain = df.withColumn("s", F.sum("v").over(
        Window.partitionBy("k").orderBy("id").rowsBetween(0, Window.unboundedFollowing)))
    assert rows(out, ["id", "s"]) == rows(plain, ["id", "s"])
    row_exchanges = [x for x in plan_text(out).split("\n") if "Exchange" in x and "passthrough" in x]
    assert len(row_exchanges) == 1


@pytest.mark.parametrize("kind", ["bigint", "string", "timestamp_ntz", "decimal(12,3)", "date"])
def test_runs_over_other_types_and_null_keys(spark, kind):
    rng = random.Random(kind)
    data = [(rng.choice([None, "a'b", "c\\d", "e"]), i, rng.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, id long, v long")
    axis = {"string": F.lpad(F.col("id").cast("string"), 5, "0"),
            "timestamp_ntz": F.timestamp_seconds("id").cast("timestamp_ntz"),
            "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))}.get(kind, F.col("id").cast(kind))
    df = df.withColumn("o", axis)
    w = Window.partitionBy("k").orderBy("o")
    got = windows.balanced_lag(df, "k", "o", "v", "p", runs=13)
    assert rows(got, ["id", "p"]) == rows(df.withColumn("p", F.lag("v").over(w)), ["id", "p"])
    got = windows.suffix_sum(df, "k", "o", F.col("v"), "s", inclusive=False, runs=13)
    plain = df.withColumn("s", F.coalesce(F.sum("v").over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
    assert rows(got, ["id", "s"]) == rows(plain, ["id", "s"])


def test_runs_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, id long, v long")
    assert windows.balanced_lag(df, "k", "id", "v", "p").collect() == []
