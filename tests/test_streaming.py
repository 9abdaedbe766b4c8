"""Streaming = batch: the change apply and the monitors, fed file by file."""

import os
import random

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL, plan_text, rows
from shardcraft import bindings as B
from shardcraft.streaming import changes as CH
from shardcraft.streaming import monitors as MON


def _write_changes(spark, df, folder, parts):
    """Split a change log into ``parts`` files by position order (one per trigger)."""
    n = df.count()
    cut = [i * n // parts for i in range(parts + 1)]
    ordered = df.orderBy("pos").collect()
    for i in range(parts):
        chunk = ordered[cut[i]:cut[i + 1]]
        spark.createDataFrame(chunk, CH.CHANGE_SCHEMA).coalesce(1).write.parquet(os.path.join(folder, f"f{i:03d}"))


def _expected(spark, target, changes, policy):
    t = target.withColumn("_pos", F.lit(-1).cast("long")).withColumn("_deleted", F.lit(False))
    eff = CH.effective_changes(changes, t, "pk", policy)
    return CH.merge(t, eff, "pk").where(~F.col("_deleted")).drop("_deleted")


def test_change_apply_stream_equals_batch_and_replay_is_noop(spark, tmp):
    changes = B.changes(spark, SF_SMALL)
    # fixture sequence: an insert, an update and a delete of new keys, plus a replayed change
    extra = spark.createDataFrame([
        (100000, None, "I", "users", 9001, '{"name": "test_user"}'),
        (100001, None, "I", "products", 9002, '{"price": 99.99}'),
        (100002, None, "U", "products", 9002, '{"price": 89.99}'),
        (100003, None, "D", "users", 9001, None)], CH.CHANGE_SCHEMA)
    allc = changes.unionByName(extra)
    src = os.path.join(tmp, "changes")
    _write_changes(spark, allc, src, 4)
    target = B.table(spark, SF_SMALL, "customer").select(F.col("c_custkey").alias("pk"),
                                                         F.col("c_name").alias("row"))
    path = os.path.join(tmp, "replica")
    CH.init_target(target, path, "pk", buckets=8)
    stream = CH.read_changes(spark, src, max_files_per_trigger=1, recursive=True)
    q = CH.apply_changes(stream, path, os.path.join(tmp, "ckpt"), "pk", "skip", buckets=8)
    q.awaitTermination(300)
    got = CH.read_target(spark, path)
    want = _expected(spark, target, allc, "skip")
    assert rows(got, ["pk", "row", "_pos"]) == rows(want, ["pk", "row", "_pos"])
    assert got.where("pk = 9002").first().row == '{"price": 89.99}'
    assert got.where("pk = 9001").count() == 0
    # replaying the whole log as a new batch changes nothing (positions are not newer)
    before = rows(got, ["pk", "row", "_pos"])
    CH.apply_batch(spark.read.option("recursiveFileLookup", "true").parquet(src), 10_000, path, "pk", "skip", buckets=8)
    assert rows(CH.read_target(spark, path), ["pk", "row", "_pos"]) == before
    # an already applied batch id is skipped
    assert CH.apply_batch(spark.read.option("recursiveFileLookup", "true").parquet(src), 0, path, "pk", "skip", 8)["skipped_batch"]


def test_skip_policy_keeps_existing_row(spark):
    t = spark.createDataFrame([(1, "old", -1, False)], "pk long, row string, _pos long, _deleted boolean")
    ch = spark.createDataFrame([(5, None, "I", "t", 1, "dup"), (6, None, "I", "t", 2, "new"),
                                (7, None, "D", "t", 2, None), (8, None, "I", "t", 2, "again")], CH.CHANGE_SCHEMA)
    skip = CH.merge(t, CH.effective_changes(ch, t, "pk", "skip"), "pk").where(~F.col("_deleted"))
    assert rows(skip, ["pk", "row"]) == [(1, "old"), (2, "again")]
    assert CH.effective_changes(ch, t, "pk", "skip", count_skips=True).where("pk = 1").first().skipped == 1
    up = CH.merge(t, CH.effective_changes(ch, t, "pk", "upsert"), "pk").where(~F.col("_deleted"))
    assert rows(up, ["pk", "row"]) == [(1, "dup"), (2, "again")]


def _stream_of(spark, df, folder, parts, schema=None):
    n = df.count()
    data = df.orderBy(df.columns[0]).collect()
    for i in range(parts):
        chunk = data[i * n // parts:(i + 1) * n // parts]
        spark.createDataFrame(chunk, schema or df.schema).coalesce(1).write.parquet(os.path.join(folder, f"f{i:03d}"))
    return (spark.readStream.schema(schema or df.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def test_service_metrics_stream_equals_batch(spark, tmp):
    log = B.query_log(spark, SF_SMALL).select("log_id", "ts", "node", "duration_ms", "ok")
    stream = _stream_of(spark, log, os.path.join(tmp, "log"), 3)
    q = (MON.service_metrics(stream, "1 hour", "30 minutes").writeStream.outputMode("complete")
         .format("memory").queryName("svc_metrics").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM svc_metrics")
    want = MON.service_metrics(log, "1 hour", "30 minutes")
    assert rows(got) == rows(want)


def test_slow_queries_and_sync_stream_equal_batch(spark, tmp):
    log = B.query_log(spark, SF_SMALL).select("log_id", "ts", "statement", "duration_ms")
    stream = _stream_of(spark, log, os.path.join(tmp, "slow"), 2)
    q = (MON.slow_queries(stream, 100.0, window="1 day").writeStream.outputMode("complete")
         .format("memory").queryName("slow_q").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert rows(spark.sql("SELECT * FROM slow_q")) == rows(MON.slow_queries(log, 100.0, window="1 day"))


def test_replication_lag_stream_join(spark, tmp):
    from shardcraft.plans.streams import REPLICAS, applied
    src = B.changes(spark, SF_SMALL).select("pos", "commit_ts")
    app = applied(spark, SF_SMALL)
    s_stream = _stream_of(spark, src, os.path.join(tmp, "src"), 2)
    a_stream = _stream_of(spark, app.select("pos", "replica", "apply_ts"), os.path.join(tmp, "app"), 2)
    q = (MON.replication_lag(s_stream, a_stream, REPLICAS, bound="2 minutes").writeStream.outputMode("append")
         .format("memory").queryName("lag_q").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM lag_q")
    want = MON.replication_lag(src, app, REPLICAS)
    # matched rows are emitted as they join; all of them must agree with the batch form
    assert rows(got.where("apply_ts IS NOT NULL")) == rows(want.where("apply_ts IS NOT NULL"))
    # unmatched changes are emitted only once the watermark has passed them
    assert got.where("apply_ts IS NULL").count() <= want.where("apply_ts IS NULL").count()


def test_sync_monitor_and_alerts_stream_equal_batch(spark, tmp):
    from shardcraft.plans.streams import applied
    src = B.changes(spark, SF_SMALL).select("pos", "commit_ts")
    app = applied(spark, SF_SMALL).select("pos", "replica", "apply_ts")
    s_stream = _stream_of(spark, src, os.path.join(tmp, "s"), 3)
    a_stream = _stream_of(spark, app, os.path.join(tmp, "a"), 3)
    q = (MON.sync_monitor(s_stream, a_stream, "5 minutes").writeStream.outputMode("complete")
         .format("memory").queryName("sync_q").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert rows(spark.sql("SELECT * FROM sync_q")) == rows(MON.sync_monitor(src, app, "5 minutes"))

    log = B.query_log(spark, SF_SMALL).select("log_id", "ts", "node", "duration_ms", "ok")
    l_stream = _stream_of(spark, log, os.path.join(tmp, "l"), 2)
    q2 = (MON.alerts(MON.service_metrics(l_stream, "1 hour")).writeStream.outputMode("complete")
          .format("memory").queryName("alert_q").trigger(availableNow=True).start())
    q2.awaitTermination(300)
    want = MON.alerts(MON.service_metrics(log, "1 hour"))
    assert want.count() > 0
    assert rows(spark.sql("SELECT * FROM alert_q")) == rows(want)


def test_change_source_reads_json(spark, tmp):
    import json
    folder = os.path.join(tmp, "json_changes")
    os.makedirs(folder)
    with open(os.path.join(folder, "c1.json"), "w") as f:
        for p, op, pk in [(1, "I", 7), (2, "U", 7), (3, "D", 8)]:
            f.write(json.dumps({"pos": p, "commit_ts": "2024-01-01T00:00:0%d" % p, "op": op,
                                "tbl": "users", "pk": pk, "row": "{}"}) + "\n")
    s = CH.read_changes(spark, folder, fmt="json")
    assert s.isStreaming
    q = s.writeStream.format("memory").queryName("json_changes_q").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.sql("SELECT pos, op, pk FROM json_changes_q")
    assert rows(got) == [(1, "I", 7), (2, "U", 7), (3, "D", 8)]


def test_sync_monitor_per_replica(spark):
    import datetime as dt
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    src = spark.createDataFrame([(1, t(1)), (2, t(2))], "pos long, commit_ts timestamp_ntz")
    app = spark.createDataFrame([("r1", 1, t(1)), ("r1", 2, t(3)), ("r2", 1, t(2))],
                                "replica string, pos long, apply_ts timestamp_ntz")
    r = MON.sync_monitor(src, app, "5 minutes", replicas=["r1", "r2"]).first()
    assert (r.source_changes, r.applied_r1, r.applied_r2) == (2, 2, 1)
    assert r.in_sync_r1 and not r.in_sync_r2


@pytest.mark.parametrize("step", ["before_write", "after_write"])
def test_change_apply_recovers_from_a_crash_mid_batch(spark, tmp, monkeypatch, step):
    """Lost before the new version is written, and between version and commit."""
    changes = B.changes(spark, SF_SMALL)
    src = os.path.join(tmp, "changes")
    _write_changes(spark, changes, src, 3)
    target = B.table(spark, SF_SMALL, "customer").select(F.col("c_custkey").alias("pk"),
                                                         F.col("c_name").alias("row"))
    path, ckpt = os.path.join(tmp, "replica"), os.path.join(tmp, "ckpt")
    CH.init_target(target, path, "pk", buckets=8)
    original = CH._commit

    def crashing(spark_, path_, df, key, rewritten, previous, base, batch_id, *a):
        if batch_id == 1:
            if step == "after_write":      # half of the buckets are out, the commit is not
                df.where("bucket < 4").write.mode("overwrite").partitionBy("bucket") \
                  .parquet(f"{path_}/state/v={previous[0].seq + 1}")
            raise RuntimeError("simulated driver crash")
        return original(spark_, path_, df, key, rewritten, previous, base, batch_id, *a)

    monkeypatch.setattr(CH, "_commit", crashing)
    q = CH.apply_changes(CH.read_changes(spark, src, max_files_per_trigger=1, recursive=True),
                         path, ckpt, "pk", "skip", buckets=8)
    try:
        q.awaitTermination(300)
    except Exception:  # noqa: BLE001 - the simulated crash surfaces as a query failure
        pass
    assert q.exception() is not None
    assert rows(CH.applied_batches(spark, path), ["batch_id"]) == [(0,)]
    monkeypatch.setattr(CH, "_commit", original)
    q2 = CH.apply_changes(CH.read_changes(spark, src, max_files_per_trigger=1, recursive=True),
                          path, ckpt, "pk", "skip", buckets=8)   # restart from the checkpoint
    q2.awaitTermination(300)
    got = CH.read_target(spark, path)
    want = _expected(spark, target, changes, "skip")
    assert rows(got, ["pk", "row", "_pos"]) == rows(want, ["pk", "row", "_pos"])


def test_reinitialised_target_holds_only_the_new_rows(spark, tmp):
    path = os.path.join(tmp, "t")
    snap = spark.range(100).select(F.col("id").alias("pk"), F.lit("a").alias("row"))
    CH.init_target(snap, path, "pk", buckets=8)
    CH.apply_batch(spark.createDataFrame([(1, None, "I", "t", 500, "x")], CH.CHANGE_SCHEMA), 0, path, "pk", "skip", 8)
    CH.init_target(snap, path, "pk", buckets=4)
    assert CH.read_target(spark, path).count() == 100
    # batch ids count from the new snapshot
    out = CH.apply_batch(spark.createDataFrame([(1, None, "I", "t", 500, "x")], CH.CHANGE_SCHEMA),
                         0, path, "pk", "skip", 4)
    assert "skipped_batch" not in out and CH.read_target(spark, path).count() == 101


def test_purge_may_empty_buckets_and_the_table(spark, tmp):
    path = os.path.join(tmp, "t")
    CH.init_target(spark.range(6).select(F.col("id").alias("pk"), F.lit("r").alias("row")), path, "pk", buckets=4)
    ch = spark.createDataFrame([(10 + k, None, "D", "t", k, None) for k in range(6)], CH.CHANGE_SCHEMA)
    CH.apply_batch(ch, 0, path, "pk", "skip", 4)
    assert CH.purge_tombstones(spark, path, before_pos=15) > 0
    assert rows(CH.read_target(spark, path, with_meta=True).select("pk")) == [(5,)]
    assert CH.purge_tombstones(spark, path, before_pos=100) == 1
    assert CH.read_target(spark, path, with_meta=True).count() == 0
    CH.apply_batch(spark.createDataFrame([(200, None, "I", "t", 9, "new")], CH.CHANGE_SCHEMA), 1, path, "pk", "skip", 4)
    assert rows(CH.read_target(spark, path).select("pk", "row")) == [(9, "new")]


def test_service_metrics_drops_rows_behind_the_watermark(spark, tmp):
    import datetime as dt
    schema = "log_id long, ts timestamp_ntz, node string, duration_ms double, ok boolean"
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    # lateness is judged against the watermark of the previous micro-batch, so
    # the 00:00 window is finalised one batch after the watermark passes 01:00
    files = [
        [(1, t(0, 5), "n0", 10.0, True), (2, t(0, 20), "n0", 20.0, True)],   # on time
        [(3, t(3, 0), "n0", 30.0, True)],                                      # watermark -> 02:59
        [(6, t(3, 5), "n0", 35.0, True)],                                      # 00:00 window emitted
        [(4, t(0, 10), "n0", 40.0, False)],                                    # late: its window is closed
        [(5, t(10, 0), "n0", 50.0, True)],                                     # closes the later windows
    ]
    folder = os.path.join(tmp, "late")
    import time
    for i, rows_ in enumerate(files):
        spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(os.path.join(folder, f"f{i}"))
        time.sleep(1.1)    # distinct modification times keep the file order
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(folder))
    q = (MON.service_metrics(stream, "1 hour", watermark="1 minute").writeStream.outputMode("append")
         .format("memory").queryName("late_q").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.window_start: (r.statements, r.errors) for r in spark.sql("SELECT * FROM late_q").collect()}
    assert got[t(0, 0)] == (2, 0)              # the late error row was dropped
    batch = MON.service_metrics(spark.createDataFrame([r for f in files for r in f], schema), "1 hour")
    assert {r.window_start: r.statements for r in batch.collect()}[t(0, 0)] == 3   # batch keeps it


def test_route_log_runs_on_a_stream(spark, tmp):
    from shardcraft.operators import shard
    log = B.query_log(spark, SF_SMALL).select("log_id", "ts", "statement")
    stream = _stream_of(spark, log, os.path.join(tmp, "qlog"), 2)
    ranges = shard.equal_ranges(150, 3)
    routed = shard.route_log(stream, shard.LAB_RULES, ranges, hostgroup_shard=shard.LAB_HOSTGROUP_SHARD)
    q = (shard.route_summary(routed).writeStream.outputMode("complete").format("memory")
         .queryName("route_q").trigger(availableNow=True).start())
    q.awaitTermination(300)
    want = shard.route_summary(shard.route_log(log, shard.LAB_RULES, ranges,
                                               hostgroup_shard=shard.LAB_HOSTGROUP_SHARD))
    assert rows(spark.sql("SELECT * FROM route_q")) == rows(want)


def test_purge_tombstones(spark, tmp):
    path = os.path.join(tmp, "t")
    target = spark.createDataFrame([(k, f"r{k}") for k in range(20)], "pk long, row string")
    CH.init_target(target, path, "pk", buckets=4)
    ch = spark.createDataFrame([(10 + k, None, "D", "t", k, None) for k in range(5)], CH.CHANGE_SCHEMA)
    CH.apply_batch(ch, 0, path, "pk", "skip", 4)
    meta = CH.read_target(spark, path, with_meta=True)
    assert meta.where("_deleted").count() == 5
    assert CH.purge_tombstones(spark, path, before_pos=13) > 0        # positions 10, 11, 12 go
    meta = CH.read_target(spark, path, with_meta=True)
    assert sorted(r.pk for r in meta.where("_deleted").collect()) == [3, 4]
    assert CH.read_target(spark, path).count() == 15                  # live rows unchanged
    assert CH.purge_tombstones(spark, path, before_pos=13) == 0


def test_apply_batch_counts_skipped_duplicates(spark, tmp):
    path = os.path.join(tmp, "t")
    CH.init_target(spark.createDataFrame([(1, "a"), (2, "b")], "pk long, row string"), path, "pk", buckets=4)
    ch = spark.createDataFrame([(1, None, "I", "t", 1, "dup"), (2, None, "I", "t", 3, "new"),
                                (3, None, "I", "t", 3, "dup2")], CH.CHANGE_SCHEMA)
    out = CH.apply_batch(ch, 0, path, "pk", "skip", 4, count_skips=True)
    assert out["skipped"] == 2
    assert CH.applied_batches(spark, path).where("batch_id = 0").first().skipped == 2
    assert rows(CH.read_target(spark, path).select("pk", "row")) == [(1, "a"), (2, "b"), (3, "new")]


def test_apply_from_snapshot_position(spark, tmp):
    path = os.path.join(tmp, "t")
    CH.init_target(spark.createDataFrame([(1, "snap")], "pk long, row string"), path, "pk", buckets=4, pos=100)
    ch = spark.createDataFrame([(50, None, "I", "t", 2, "before snapshot"), (60, None, "U", "t", 1, "old"),
                                (150, None, "I", "t", 3, "after")], CH.CHANGE_SCHEMA)
    CH.apply_batch(ch, 0, path, "pk", "skip", 4, start_pos=100)
    assert rows(CH.read_target(spark, path).select("pk", "row")) == [(1, "snap"), (3, "after")]


def test_lag_reports_the_replica_that_misses_a_change(spark):
    import datetime as dt
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    src = spark.createDataFrame([(1, t(1)), (2, t(2))], "pos long, commit_ts timestamp_ntz")
    app = spark.createDataFrame([("r1", 1, t(1)), ("r1", 2, t(9)), ("r2", 1, t(2))],
                                "replica string, pos long, apply_ts timestamp_ntz")
    lag = MON.replication_lag(src, app, ["r1", "r2"])
    assert [(r.pos, r.replica, r.lag_s, r.lagging) for r in lag.orderBy("pos", "replica").collect()] == [
        (1, "r1", 0.0, False), (1, "r2", 60.0, True), (2, "r1", 420.0, True), (2, "r2", None, True)]
    assert rows(MON.lag_summary(lag).select("replica", "missing_changes")) == [("r1", 0), ("r2", 1)]


def test_alerts_give_every_breached_rule(spark):
    m = spark.createDataFrame([(1, 0.2, 2000.0, 600.0), (2, 0.0, 1.0, 600.0), (3, None, None, None)],
                              "id long, error_rate double, avg_ms double, avg_connect_ms double")
    assert rows(MON.alerts(m).select("id", "alert")) == [
        (1, "connect_time"), (1, "error_rate"), (1, "query_time"), (2, "connect_time")]


def test_statement_shapes(spark):
    long_list = "IN (" + ", ".join(str(i) for i in range(20000)) + ")"
    cases = [(r"WHERE a = 'a\'b 9'", "WHERE a = ?"), ("WHERE a = 'it''s'", "WHERE a = ?"),
             ("WHERE a = ''  AND b=3", "WHERE a = ? AND b=?"), ("x IN (1,2 , 3)", "x IN (?)"),
             ("x in ('a')", "x IN (?)"), ("x " + long_list, "x IN (?)"),
             ("VALUES (1, 'a')", "VALUES (?, ?)"), ('a = "q\'s 7"', "a = ?"), (None, None),
             # comments, hex, exponents, names with digits, escapes outside quotes, open ends
             ("SELECT 1e5, 0xFF, .5, 3., 2.5E-3, x'0F', b'01'", "SELECT ?, ?, ?, ?, ?, ?, ?"),
             ("SELECT a -- it's 5\nFROM t /* 'x' 7 */ WHERE b=1 # tail 'q", "SELECT a FROM t WHERE b=?"),
             ("SELECT t1.c2, `9 o'clock`, 1st FROM db2.t$3", "SELECT t1.c2, `9 o'clock`, 1st FROM db2.t$3"),
             (r"a \. b = 'c:\\' AND d = 'e'", r"a \. b = ? AND d = ?"),
             ("a = 'open 5", "a = ?"), ("/* open 5", ""), ("a--1", "a--?"), ("", ""), ("é1 = 'ü''\n'", "é1 = ?"),
             ("a = '" + r"\'x''" * 50000 + "' AND b = 2", "a = ? AND b = ?"), ("x" * 200000 + " = 5", "x" * 200000 + " = ?")]
    d = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "id long, s string")
    got = [r.shape for r in d.select("id", MON.normalise("s").alias("shape")).orderBy("id").collect()]
    assert got == [c[1] for c in cases]


def test_another_bucket_count_does_not_repeat_keys(spark, tmp):
    """The table's own bucket count holds, whatever a batch is called with."""
    path = os.path.join(tmp, "replica")
    snap = spark.range(100).select(F.col("id").alias("pk"), F.lit("old").alias("row"))
    CH.init_target(snap, path, buckets=8)
    batch = spark.range(0, 100, 9).select(
        (F.col("id") + 1).alias("pos"), F.lit("U").alias("op"), F.col("id").alias("pk"), F.lit("new").alias("row"))
    CH.apply_batch(batch, 0, path, buckets=64)
    got = CH.read_target(spark, path)
    assert got.count() == got.select("pk").distinct().count() == 100
    assert got.where("row = 'new'").count() == 12
    CH.purge_tombstones(spark, path, 10 ** 6)
    assert CH._current(spark, path)[0].table_buckets == 8


@pytest.mark.parametrize("policy", ["skip", "upsert"])
@pytest.mark.parametrize("runs", [1, 7])
def test_fold_equals_sequential_replay(spark, policy, runs):
    """Random changes with a hot key, tombstones, stale and repeated positions."""
    rng = random.Random(runs)
    state = {k: (f"t{k}" if rng.random() < .7 else None, rng.choice([-1, 40, 200])) for k in range(40) if k % 3}
    log = [(p, rng.choice("IIUD"), rng.choice([1, 2, 2, 2, rng.randrange(60)]), f"r{p}") for p in range(400)]
    log += rng.sample(log, 50)
    want = {k: [row, pos, row is None] for k, (row, pos) in state.items()}
    for pos, op, k, row in sorted(set(log)):
        have = want.get(k, [None, -2, True])
        if pos <= have[1] or policy == "skip" and op == "I" and not have[2]:
            continue
        want[k] = [None if op == "D" else row, pos, op == "D"]
    target = spark.createDataFrame([(k, r, p, r is None) for k, (r, p) in state.items()],
                                   "pk long, row string, _pos long, _deleted boolean")
    df = spark.createDataFrame(log, "pos long, op string, pk long, row string").repartition(3)
    out = CH.fold_changes(target, df, on_duplicate=policy, runs=runs)
    assert rows(out, ["pk", "row", "_pos", "_deleted"]) == sorted((k, *v) for k, v in want.items())


def test_fold_exchanges_rows_once_and_summaries_once(spark):
    target = spark.range(50).select(F.col("id").alias("pk"), F.lit("t").alias("row"), F.lit(0).cast("long").alias("_pos"),
                                    F.lit(False).alias("_deleted"))
    changes = spark.range(1, 90).select(F.col("id").alias("pos"), F.lit("U").alias("op"), (F.col("id") % 60).alias("pk"),
                                        F.lit("c").alias("row"))
    plan = plan_text(CH.fold_changes(target, changes))
    assert plan.count("Exchange ") == 2 and "Join" not in plan


def test_sentinel_closes_the_last_window_and_stays_out(spark, tmp):
    from shardcraft.streaming import replay
    log = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:30' AS ts, 'n1' AS node, 5.0D AS duration_ms, true AS ok")
    stream = replay.as_stream(log, "ts", os.path.join(tmp, "log"))
    out = replay.run_to_end(MON.service_metrics(stream, "1 hour"), os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"))
    assert rows(out) == rows(MON.service_metrics(log, "1 hour")) and out.count() == 1


def test_unmatched_changes_come_out_of_the_stream_join(spark, tmp):
    from shardcraft.streaming import replay
    src = spark.sql("SELECT id AS pos, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id)) AS commit_ts FROM range(20)")
    app = src.where("pos % 4 != 1").select(F.lit("r").alias("replica"), "pos", (F.col("commit_ts") + F.expr("INTERVAL 3 SECONDS")).alias("apply_ts"))
    s = replay.as_stream(src, "commit_ts", os.path.join(tmp, "s"))
    a = replay.as_stream(app, "apply_ts", os.path.join(tmp, "a"))
    out = replay.run_to_end(MON.replication_lag(s, a, ["r"], bound="1 minute"), os.path.join(tmp, "o"), os.path.join(tmp, "c"))
    assert rows(out) == rows(MON.replication_lag(src, app, ["r"]))
    assert out.where("apply_ts IS NULL").count() == 5


def _lag_logs(spark, n):
    """``n`` changes in shuffled order, two a second, some of them missed by a replica, the last one, too."""
    src = spark.sql(f"SELECT nullif(id, -1) AS pos, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 2) AS commit_ts "
                    f"FROM range({n}) ORDER BY hash(id)")
    app = src.where(f"pos % 5 != 1 AND pos < {n - 9}").select(
        F.lit("r").alias("replica"), "pos", (F.col("commit_ts") + F.expr("make_dt_interval(0, 0, 0, pos % 7)")).alias("apply_ts"))
    return src, app


def test_joined_logs_come_in_batches_and_the_state_stays_small(spark, tmp):
    from shardcraft.streaming import replay
    src, app = _lag_logs(spark, 4000)
    s, a = replay.as_streams([(src, "commit_ts", {}), (app, "apply_ts", {"replica": "", "pos": -1})],
                             os.path.join(tmp, "logs"), file_rows=300, files_per_trigger=2)
    settings = ("spark.sql.shuffle.partitions", "spark.sql.streaming.minBatchesToRetain")
    before = [spark.conf.get(k) for k in settings]
    out = replay.run_to_end(MON.replication_lag(s, a, ["r"], bound="10 seconds"), os.path.join(tmp, "o"), os.path.join(tmp, "c"), 2)
    assert rows(out) == rows(MON.replication_lag(src, app, ["r"])) and out.count() == 4000
    assert out.where("apply_ts IS NULL AND pos >= 3991").count() == 9           # also those after the last applied one
    assert [spark.conf.get(k) for k in settings] == before
    assert max(int(f) for f in os.listdir(os.path.join(tmp, "c", "commits")) if f.isdigit()) >= 11
    state = os.path.join(tmp, "c", "state", "0")
    assert sorted(f for f in os.listdir(state) if f.isdigit()) == ["0", "1"]    # two state partitions


def test_joined_logs_of_one_time_without_rows_and_without_times(spark, tmp):
    from shardcraft.streaming import replay
    src, app = _lag_logs(spark, 400)
    once = src.withColumn("commit_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    for i, (x, y) in enumerate([(once, app), (src.where("false"), app.where("false")), (src, app.where("false")),
                                (src.where("pos % 50 = 3").withColumn("commit_ts", F.lit(None).cast("timestamp_ntz")).unionAll(src.where("pos % 50 != 3")), app)]):
        got = []
        for file_rows in (50, 10**6):
            at = os.path.join(tmp, f"{i}-{file_rows}")
            s, a = replay.as_streams([(x, "commit_ts", {}), (y, "apply_ts", {"replica": "", "pos": -1})],
                                     f"{at}/logs", file_rows=file_rows, files_per_trigger=1)
            got.append(rows(replay.run_to_end(MON.replication_lag(s, a, ["r"], bound="10 minutes"), f"{at}/o", f"{at}/c", 2)))
        assert got[0] == got[1]
        if i < 3:
            assert got[0] == rows(MON.replication_lag(x, y, ["r"], bound="10 minutes"))


def test_a_store_without_times_gives_the_log_at_once(spark, tmp, monkeypatch):
    from shardcraft.streaming import replay
    monkeypatch.setattr(replay, "_in_order", lambda *a: False)
    src, app = _lag_logs(spark, 400)
    s, a = replay.as_streams([(src, "commit_ts", {}), (app, "apply_ts", {"replica": "", "pos": -1})],
                             os.path.join(tmp, "logs"), file_rows=50, files_per_trigger=1)
    out = replay.run_to_end(MON.replication_lag(s, a, ["r"], bound="10 seconds"), os.path.join(tmp, "o"), os.path.join(tmp, "c"))
    assert rows(out) == rows(MON.replication_lag(src, app, ["r"]))
