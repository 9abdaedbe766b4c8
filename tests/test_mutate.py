"""Mutation operators on literal fixtures."""

import json

from pyspark.sql import functions as F

from support import rows
from shardcraft.operators import mutate


def test_update_and_limit(spark):
    t = spark.createDataFrame([(i, 0, None) for i in range(1, 41)], "id int, counter int, data string")
    u = mutate.update(t, F.col("id") % 10 == 0, {"counter": F.col("counter") + 1,
                                                 "data": F.concat(F.coalesce("data", F.lit("")), F.lit("_u"))})
    assert rows(u.where("counter = 1"), ["id", "data"]) == [(10, "_u"), (20, "_u"), (30, "_u"), (40, "_u")]
    lim = mutate.update_limit(t, F.col("id") % 10 == 0, {"counter": F.col("counter") + 1}, 2, "id")
    assert sorted(r.id for r in lim.where("counter = 1").collect()) == [10, 20]


def test_update_batches(spark):
    t = spark.createDataFrame([(i, 0, "d", "new") for i in range(1, 351)], "id int, counter int, data string, status string")
    u = mutate.update_batches(t, "id", 100, 250)
    by = {r.id: r for r in u.collect()}
    assert by[1].status == "updated" and by[150].status == "active" and by[300].status == "updated" and by[301].status == "new"
    assert by[100].data == "d_batch_0_0" and by[101].data == "d_batch_1_0" and by[301].counter == 0 and by[300].counter == 1


def test_json_set_keeps_other_fields(spark):
    t = spark.createDataFrame([(1, '{"a": 1, "b": "x", "update_count": 2}'), (2, '{"a": [1,2]}')],
                              "id int, data string")
    u = mutate.json_set(t, "data", {"updated": F.lit(123)}, increments=("update_count",))
    got = {r.id: json.loads(r.data) for r in u.collect()}
    assert got[1] == {"a": 1, "b": "x", "update_count": 3, "updated": 123}
    assert got[2] == {"a": [1, 2], "update_count": 1, "updated": 123}


def test_upsert_reports_missing(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    ch = spark.createDataFrame([(2, "B"), (9, "Z")], "id int, name string")
    new, rep = mutate.upsert(t, ch, "id")
    assert rows(new) == [(1, "a"), (2, "B")]
    assert rows(rep) == [(2, True), (9, False)]
    new2, _ = mutate.upsert(t, ch, "id", insert_missing=True)
    assert rows(new2) == [(1, "a"), (2, "B"), (9, "Z")]


def test_expire(spark):
    s = spark.createDataFrame([(1, "2024-01-01", False), (2, "2024-01-01", True), (3, "2024-03-01", False),
                               (4, None, False)], "id int, expires_at string, is_active boolean") \
        .withColumn("expires_at", F.col("expires_at").cast("date"))
    kept, removed = mutate.expire(s, (F.col("expires_at") < F.lit("2024-02-01").cast("date")) & ~F.col("is_active"))
    assert sorted(r.id for r in kept.collect()) == [2, 3, 4]
    assert removed.first().removed == 1


def test_delete_cascade_and_set_null(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    orders = spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, None)], "oid int, user_id int")
    keys = spark.createDataFrame([(2,), (7,)], "id int")
    kept, after, missing = mutate.delete(users, orders, keys, "id", "user_id", "cascade")
    assert rows(kept) == [(1,), (3,)] and rows(missing) == [(7,)]
    assert sorted(r.oid for r in after.collect()) == [10, 13]
    _, after2, _ = mutate.delete(users, orders, keys, "id", "user_id", "set_null")
    assert {r.oid: r.user_id for r in after2.collect()} == {10: 1, 11: None, 12: None, 13: None}


def test_stamp_gap_free(spark):
    target = spark.createDataFrame([(5,), (42,)], "id long")
    new = spark.range(0, 500, 1, 7).select((F.col("id") * 3).alias("seq"), F.lit("x").alias("name"))
    s = mutate.stamp(new, target, "id", "seq", "2024-01-01 00:00:00")
    got = sorted((r.seq, r.id) for r in s.collect())
    assert [i for _, i in got] == list(range(43, 543))
    assert s.where(F.col("created_at").isNull()).count() == 0


def test_insert_ignore_first_wins(spark):
    target = spark.createDataFrame([(999, "existing")], "id long, username string")
    batch = spark.createDataFrame([(999, 1, "dup"), (1999, 3, "late"), (1999, 2, "first"), (2999, 4, "new")],
                                  "id long, seq int, username string")
    out = mutate.insert_ignore(target, batch, "id", "seq")
    assert rows(out) == [(999, "existing"), (1999, "first"), (2999, "new")]


def test_collated_key_matching(spark):
    target = spark.createDataFrame([("Alice", 1)], "username string, v int")
    batch = spark.createDataFrame([("ALICE", 1, 9), ("bob", 2, 8), ("Bob", 3, 7)], "username string, seq int, v int")
    plain = mutate.insert_ignore(target, batch, "username", "seq")
    assert sorted(r.username for r in plain.collect()) == ["ALICE", "Alice", "Bob", "bob"]
    ci = mutate.insert_ignore(target, batch, "username", "seq", collation="UNICODE_CI")
    assert sorted((r.username, r.v) for r in ci.collect()) == [("Alice", 1), ("bob", 8)]
    ch = spark.createDataFrame([("ALICE", 5), ("carol", 6)], "username string, v int")
    new, rep = mutate.upsert(target, ch, "username", collation="UNICODE_CI")
    assert [(r.username, r.v) for r in new.collect()] == [("Alice", 5)]
    assert sorted((r.username, r.matched) for r in rep.collect()) == [("ALICE", True), ("carol", False)]


def test_touch_sets_updated_at_on_changed_rows_only(spark):
    import datetime as dt
    t = spark.createDataFrame([(1, "a", dt.datetime(2020, 1, 1)), (2, "b", dt.datetime(2020, 1, 1))],
                              "id int, name string, updated_at timestamp_ntz")
    u = mutate.update(t, F.col("id") == 2, {"name": F.lit("B")}, touch=("updated_at", "2024-05-01 00:00:00"))
    got = {r.id: r.updated_at for r in u.collect()}
    assert got == {1: dt.datetime(2020, 1, 1), 2: dt.datetime(2024, 5, 1)}
    new, _ = mutate.upsert(t, spark.createDataFrame([(1, "A")], "id int, name string"), "id",
                           touch=("updated_at", "2024-06-01 00:00:00"))
    got = {r.id: (r.name, r.updated_at) for r in new.collect()}
    assert got == {1: ("A", dt.datetime(2024, 6, 1)), 2: ("b", dt.datetime(2020, 1, 1))}
