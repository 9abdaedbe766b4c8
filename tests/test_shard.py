"""Sharding: literal cases of the sharding lab (FIXTURES.md §2) and plan checks."""

import pytest
from pyspark.sql import functions as F

from support import plan_text, rows
from shardcraft.operators import shard

LAB_RANGES = [shard.ShardRange(1, 1, 1000), shard.ShardRange(2, 1001, 2000), shard.ShardRange(3, 2001, 3000)]


def test_shard_mapping_boundaries(spark):
    cases = {1: 1, 500: 1, 1000: 1, 1001: 2, 1500: 2, 2000: 2, 2001: 3, 2500: 3, 3000: 3,
             0: None, 3001: None, -5: None}
    df = spark.createDataFrame([(k,) for k in cases], "id long")
    good, bad = shard.assign(df, "id", LAB_RANGES)
    got = dict(good.select("id", "shard_id").collect())
    assert got == {k: v for k, v in cases.items() if v is not None}
    assert sorted(r.id for r in bad.collect()) == [-5, 0, 3001]


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([(5,), (4000,)], "id long")
    with pytest.raises(Exception, match="outside every shard range"):
        shard.assign(df, "id", LAB_RANGES, on_miss="error").collect()


def test_equal_ranges():
    r = shard.equal_ranges(1500, 3)
    assert [(x.lo, x.hi) for x in r] == [(1, 500), (501, 1000), (1001, 1500)]
    r = shard.equal_ranges(10, 3)
    assert [(x.lo, x.hi) for x in r] == [(1, 3), (4, 6), (7, 10)]


def test_sharded_write_prunes_partitions(spark, tmp):
    users = spark.createDataFrame([(i, f"u{i}") for i in [1, 2, 3, 4, 5, 10, 50, 100, 250, 500, 750, 999,
                                                           1000, 1001, 1005, 2001, 2005]],
                                  "id long, username string")
    shard.write(users, tmp, "id", LAB_RANGES)
    df = spark.read.parquet(tmp)
    assert rows(df.groupBy("shard_id").count()) == [(1, 13), (2, 2), (3, 2)]
    hit = shard.lookup(df, "id", 1005, LAB_RANGES)
    assert rows(hit.select("id")) == [(1005,)]
    p = plan_text(hit)
    assert "PartitionFilters: [isnotnull(shard_id" in p and "(shard_id#" in p and "= 2)]" in p
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,1005)]" in p
    # each row in exactly one shard directory
    assert df.count() == users.count()


def test_guarded_union_folds_to_one_branch(spark):
    u = spark.createDataFrame([(i,) for i in range(1, 3001, 7)], "id long")
    logical = shard.union_guarded({1: u, 2: u, 3: u}, LAB_RANGES, "id")
    assert logical.count() == u.count()
    one = logical.where(F.col("id") == 1500)
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("Scan") <= 2
    assert "Union" not in plan


def test_cross_shard_join_needs_shard_key(spark):
    # the same local order id exists on two shards
    orders = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "shard_id int, id int, who string")
    items = spark.createDataFrame([(1, 1, 10), (2, 1, 20), (2, 1, 21)], "shard_id int, order_id int, item int")
    j = shard.cross_shard_join(orders, items, "id", "order_id")
    assert rows(j.select("who", "item")) == [("a", 10), ("b", 20), ("b", 21)]
    wrong = orders.join(items, orders.id == items.order_id)
    assert wrong.count() == 6


def test_route_log_first_match(spark):
    log = spark.createDataFrame([
        (1, "SELECT * FROM users WHERE id = 1500"),
        (2, "INSERT INTO users (id, username) VALUES (2500, 'x')"),
        (3, "update users set status = 'a' where id = 10"),
        (4, "DELETE FROM users WHERE id = 9999"),
        (5, "SHOW TABLES")], "log_id long, statement string")
    r = {x.log_id: x for x in shard.route_log(log, shard.LAB_RULES, LAB_RANGES,
                                              hostgroup_shard=shard.LAB_HOSTGROUP_SHARD).collect()}
    # rules 1-3 share one pattern: the first always wins (hostgroup 10), so id 1500 is misrouted
    assert (r[1].rule_id, r[1].hostgroup, r[1].intended_shard, r[1].misrouted) == (1, 10, 2, True)
    assert (r[2].rule_id, r[2].routed_key, r[2].intended_shard) == (4, 2500, 3)
    assert (r[3].rule_id, r[3].kind, r[3].misrouted) == (7, "write", False)
    assert r[4].intended_shard is None and r[4].misrouted
    assert r[5].rule_id is None and r[5].kind == "read"


def test_audit_flags_empty_and_misplaced(spark):
    df = spark.createDataFrame([(1, 5), (1, 999), (2, 1500), (2, 2500)], "shard_id int, id long")
    a = {r.shard_id: r for r in shard.audit(df, "id", LAB_RANGES).collect()}
    assert a[1].ok and not a[2].ok and not a[3].ok and a[3].rows == 0


def test_balance(spark):
    t = spark.createDataFrame([(1,), (1,), (2,), (3,)], "shard_id int")
    b = {r.shard_id: r for r in shard.balance({"users": t}, [1, 2, 3]).collect()}
    assert b[1].rows == 2 and b[1].share_pct == 50.0 and b[1].skew == pytest.approx(1.5)


def test_route_log_without_rules(spark):
    log = spark.createDataFrame([(1, "SELECT * FROM users WHERE id = 5")], "log_id long, statement string")
    r = shard.route_log(log, [], LAB_RANGES).first()
    assert r.rule_id is None and r.kind == "read" and r.intended_shard is None


def test_tag_filter_keeps_one_shard_scan(spark, tmp):
    import os
    paths = {}
    for sid, (lo, hi) in {1: (1, 1000), 2: (1001, 2000), 3: (2001, 3000)}.items():
        paths[sid] = os.path.join(tmp, f"shard{sid}")
        spark.range(lo, hi + 1).withColumnRenamed("id", "uid").write.parquet(paths[sid])
    logical = shard.read_shards(spark, paths)
    only2 = logical.where(F.col("shard_id") == 2)
    plan = plan_text(only2)
    assert plan.count("FileScan parquet") == 1 and "shard2" in plan
    assert only2.count() == 1000


def test_read_shards_rejects_schema_mismatch(spark, tmp):
    import os
    a, b = os.path.join(tmp, "a"), os.path.join(tmp, "b")
    spark.range(3).write.parquet(a)
    spark.range(3).selectExpr("CAST(id AS STRING) AS id").write.parquet(b)
    with pytest.raises(ValueError, match="schema"):
        shard.read_shards(spark, {1: a, 2: b})


def test_sharded_write_files_per_shard(spark, tmp):
    import os
    df = spark.range(1, 3001, 1, 12).withColumnRenamed("id", "uid")
    shard.write(df, tmp, "uid", LAB_RANGES, files_per_shard=2)
    for sid in (1, 2, 3):
        files = [f for f in os.listdir(os.path.join(tmp, f"shard_id={sid}")) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2
    assert spark.read.parquet(tmp).count() == 3000


def test_route_log_with_rules_as_table(spark):
    rules = spark.createDataFrame(
        [(r.rule_id, 1, r.match_pattern, r.destination_hostgroup, 1) for r in shard.LAB_RULES],
        "rule_id int, active int, match_pattern string, destination_hostgroup int, apply int")
    log = spark.createDataFrame([(1, "DELETE FROM users WHERE id = 2500")], "log_id long, statement string")
    r = shard.route_log(log, rules, LAB_RANGES, hostgroup_shard=shard.LAB_HOSTGROUP_SHARD).first()
    assert (r.rule_id, r.hostgroup, r.intended_shard, r.rule_shard, r.misrouted) == (10, 10, 3, 1, True)


def test_key_range_prunes_shard_directories(spark, tmp):
    users = spark.range(1, 3001).withColumnRenamed("id", "uid")
    shard.write(users, tmp, "uid", LAB_RANGES)
    q = shard.key_range(spark.read.parquet(tmp), "uid", 900, 1100, LAB_RANGES)
    p = plan_text(q)
    pf = p.split("PartitionFilters: [")[1].split("]")[0]
    assert pf.startswith("shard_id#") and pf.endswith("IN (1,2)")      # shard 3 is never listed
    assert q.count() == 201 and sorted(r.shard_id for r in q.select("shard_id").distinct().collect()) == [1, 2]


def test_any_number_of_ranges_and_undeclared_shards(spark):
    from shardcraft.operators import shard as S
    ranges = S.equal_ranges(5000, 500)
    d = spark.range(1, 5002).withColumn("s", S.shard_of("id", ranges))
    assert d.where("id <= 5000 AND s <> floor((id - 1) / 10) + 1").count() == 0
    assert d.where("s IS NULL").count() == 1
    with pytest.raises(ValueError):
        S.shard_of("id", [S.ShardRange(1, 1, 10), S.ShardRange(2, 10, 20)])
    rows_ = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id long, shard_id int")
    out = {r.shard_id: (r.rows, r.ok) for r in S.audit(rows_, "id", [S.ShardRange(1, 1, 5)]).collect()}
    assert out == {1: (1, True), 9: (1, False), None: (1, False)}


def test_many_ranges_equal_a_search_in_order(spark):
    """Uneven ranges with gaps, keys at every bound, outside and NULL; the plan has no CASE per range."""
    bounds, at = [], -500
    for i in range(300):
        bounds.append(shard.ShardRange(i * 7, at, at + i % 4))
        at += i % 4 + 1 + i % 3
    keys = [None, *range(-510, at + 10)]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    out = shard.assign(df, "id", bounds[::-1], on_miss="keep")
    want = [(k, next((r.shard_id for r in bounds if k is not None and r.lo <= k <= r.hi), None)) for k in keys]
    assert rows(out, ["id", "shard_id"]) == rows(spark.createDataFrame(want, "id long, shard_id int"))
    assert plan_text(out).count("CASE") <= 8


def test_stored_states_equal_the_unsharded_answer(spark, tmp):
    import random
    rng = random.Random(12)
    data = [(rng.choice(["a", "b", None]), i, rng.choice([None, round(rng.uniform(0, 99), 2)])) for i in range(1, 3001)]
    df = spark.createDataFrame(data, "g string, id long, x double").withColumn("x", F.col("x").cast("decimal(12,2)"))
    shards = {r.shard_id: df.where(F.col("id").between(r.lo, r.hi)) for r in LAB_RANGES}
    states = shard.States(("g",), sums=("x",), bounds=("id",), distinct=("id",), quantiles=("x",))
    shard.write_states(shards, tmp, states)
    merged = shard.read_states(spark, tmp, states)
    got = {r.g: r for r in states.results(merged, (0.5,)).collect()}
    for g in ("a", "b", None):
        mine = df.where(F.col("g").eqNullSafe(F.lit(g)))
        want = mine.agg(F.count("*").alias("rows"), F.sum("x").alias("s"), F.count("x").alias("n"), F.min("id").alias("lo"),
                        F.max("id").alias("hi"), F.percentile("x", 0.5).alias("p")).first()
        r = got[g]
        assert (r.rows, r.x_sum, r.x_n, r.id_min, r.id_max) == (want.rows, want.s, want.n, want.lo, want.hi)
        assert abs(r.id_distinct - want.rows) < 0.05 * want.rows        # HyperLogLog, exact below some hundreds
        assert abs(r.x_quantiles[0] - float(want.p)) < 4                # KLL: about 1.5 % of the ranks
    # one shard's rows change: its states alone are written again
    shard.write_states({2: shards[2].limit(0)}, tmp, states)
    assert shard.read_states(spark, tmp, states).agg(F.sum("rows")).first()[0] == 2000


def test_written_shards_are_read_once_and_ordered(spark, tmp):
    users = spark.range(1, 3001).selectExpr("id", "concat('u', id) AS username").repartition(5)
    shard.write(users, tmp, "id", LAB_RANGES)
    parts = {r.shard_id: spark.read.parquet(f"{tmp}/shard_id={r.shard_id}") for r in LAB_RANGES}
    union = shard.ordered(shard.union_guarded(parts, LAB_RANGES, "id"), "id")
    assert plan_text(union).count("FileScan") == 3 and len(union.inputFiles()) == len(set(union.inputFiles()))
    got = [(r.id, r.shard_id) for r in union.collect()]
    assert got == [(i, 1 + (i - 1) // 1000) for i in range(1, 3001)]
