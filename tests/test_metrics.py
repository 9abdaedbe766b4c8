"""Run comparison, node health, configuration diff, statistics."""

import pytest
from pyspark.sql import functions as F

from shardcraft.operators import aggregates, audit, metrics, mutate, shard
from support import rows


def test_compare_runs(spark):
    runs = spark.createDataFrame([
        ("default", "insert", "throughput", 5000.0), ("optimized", "insert", "throughput", 12500.0),
        ("default", "select", "time", 400.0), ("optimized", "select", "time", 100.0)],
        "run_id string, measure string, kind string, value double")
    out = {r.measure: r for r in metrics.compare_runs(runs, "default", "optimized").collect()}
    assert out["insert"].gain_pct == 150.0 and out["select"].gain_pct == 75.0
    assert out["overall"].gain_pct == 75.0          # missing update counted as 0
    assert out["overall"].verdict == "IMPROVED"
    out2 = {r.measure: r for r in metrics.compare_runs(runs, "default", "optimized", True).collect()}
    assert out2["overall"].gain_pct == 112.5


def test_node_health(spark):
    pairs = []
    for node, status in [("node1", "Primary"), ("node2", "Primary"), ("node3", "non-Primary")]:
        pairs += [(node, "2024-01-01 00:00:00", "wsrep_cluster_size", "3"),
                  (node, "2024-01-01 00:00:00", "wsrep_cluster_status", status),
                  (node, "2024-01-01 00:00:00", "wsrep_connected", "ON"),
                  (node, "2024-01-01 00:00:00", "wsrep_ready", "ON" if node != "node2" else "OFF")]
    st = spark.createDataFrame(pairs, "node string, snapshot_ts string, variable_name string, variable_value string")
    h = {r.node: r for r in audit.node_health(st, 3).collect()}
    assert h["node1"].healthy and not h["node2"].healthy and not h["node3"].healthy
    assert not h["node1"].cluster_agrees


def test_config_diff(spark):
    a = spark.createDataFrame([("innodb_buffer_pool_size", "134217728"), ("max_connections", "151"),
                               ("query_cache", "ON")], "variable_name string, variable_value string")
    b = spark.createDataFrame([("innodb_buffer_pool_size", "6442450944"), ("max_connections", "151"),
                               ("innodb_io_capacity", "2000")], "variable_name string, variable_value string")
    d = {r.variable_name: r for r in audit.config_diff({"default": a, "optimized": b}).collect()}
    assert d["innodb_buffer_pool_size"].status == "changed" and d["innodb_buffer_pool_size"].ratio == 48.0
    assert d["query_cache"].status == "removed" and d["innodb_io_capacity"].status == "added"
    assert "max_connections" not in d


def test_stats_empty_sample_is_zero(spark):
    a = spark.createDataFrame([("n1", 1.0), ("n1", 3.0)], "node string, v double")
    b = spark.createDataFrame([], "node string, v double")
    r = aggregates.stats_diff(a, b, "node").first()
    assert (r.a_avg, r.a_stddev, r.b_n, r.b_avg, r.diff_avg) == (2.0, 1.0, 0, 0, 2.0)


def test_throughput_and_error_rate(spark):
    log = spark.createDataFrame([
        ("r1", 1, "2024-01-01 00:00:00", "INSERT", 2.0, True),
        ("r1", 1, "2024-01-01 00:00:02", "SELECT", 4.0, True),
        ("r1", 2, "2024-01-01 00:00:04", "INSERT", 1500.0, False)],
        "run string, thread int, ts string, op string, ms double, ok boolean") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    t = {r.thread: r for r in metrics.throughput(log, "run", "thread", "ts", "op", "ms",
                                                 ["INSERT", "SELECT"]).collect()}
    assert t[1].total_ops == 2 and t[1].ops_per_sec == 1.0 and t[1].ops_per_sec_run == 0.5
    assert t[2].ops_per_sec is None and t[1].ops_INSERT == 1
    e = metrics.error_rate(log, "run", "ok", "ms").first()
    assert e.error_rate == pytest.approx(1 / 3, abs=1e-6) and e.error_breach and e.slow == 1


def test_error_rate_connect_threshold(spark):
    log = spark.createDataFrame([("n1", True, 10.0, 600.0), ("n1", True, 20.0, 700.0), ("n2", True, 5.0, 50.0)],
                                "node string, ok boolean, ms double, connect_ms double")
    r = {x.node: x for x in metrics.error_rate(log, "node", "ok", "ms", connect="connect_ms").collect()}
    assert r["n1"].avg_connect_ms == 650.0 and r["n1"].connect_breach and not r["n2"].connect_breach


def test_node_health_lists_a_silent_node(spark):
    st = spark.createDataFrame([("n1", "t1", v, x) for v, x in zip(audit.HEALTH_VARS, ["2", "Primary", "ON", "ON"])],
                               "node string, snapshot_ts string, variable_name string, variable_value string")
    h = {r.node: r for r in audit.node_health(st, 2, ["n1", "n2"]).collect()}
    assert h["n1"].healthy and not h["n2"].healthy and not h["n2"].cluster_agrees


def test_diff_keys_only_and_null_keys(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (None, "changed"), (4, "z")], "k long, v string")
    got = sorted((r.k or 0, r.status) for r in audit.diff(a, b, "k").collect())
    assert got == [(0, "changed"), (3, "only_source"), (4, "only_replica")]
    got = sorted((r.k, r.status) for r in audit.diff(a.select("k"), b.select("k"), "k").collect())
    assert got == [(3, "only_source"), (4, "only_replica")]
    seen = {r.k: r.all_present for r in audit.presence(a, {"b": b}, "k").collect()}
    assert seen == {1: True, None: True, 3: False}


def test_averages_keep_small_and_large_values(spark):
    df = spark.createDataFrame([("a", .004), ("a", .004), ("b", 1e30), ("b", 3e30), ("c", 1.0), ("c", None), ("d", None),
                                ("e", float("inf"))], "k string, price double")
    got = dict(rows(df.groupBy("k").agg(aggregates.avg_fixed("price").alias("avg")), ["k", "avg"]))
    assert got == {"a": .004, "b": 2e30, "c": 1.0, "d": None, "e": float("inf")}
    got = aggregates.status_summary(df.where("k = 'a'"), "k", qty_col=None).first()
    assert (got["avg_price"], got["min_price"]) == (.004, .004)


def test_stats_diff_of_rows_without_a_group(spark):
    a = spark.createDataFrame([(None, 1.0), ("x", 2.0)], "k string, v double")
    b = spark.createDataFrame([(None, 3.0), (None, 5.0)], "k string, v double")
    assert rows(aggregates.stats_diff(a, b, "k"), ["k", "a_n", "b_n", "diff_avg"]) == [("x", 1, 0, 2.0), (None, 1, 2, -3.0)]


def test_missing_and_presence_agree_on_null_keys(spark):
    src = spark.createDataFrame([(1, None), (None, "a"), (2, "b")], "i int, s string")
    node = spark.createDataFrame([(1, None), (None, "a")], "i int, s string")
    assert rows(audit.missing(src, node, ["i", "s"])) == [(2, "b")]
    assert rows(audit.presence(src, {"n": node}, ["i", "s"]).where("not on_n").select("i", "s")) == [(2, "b")]


def test_json_set_leaves_documents_with_repeated_fields(spark):
    df = spark.createDataFrame([('{"a":1,"a":2}',), ('{"a":1}',)], "j string")
    out = mutate.json_set(df, "j", {"u": F.lit(1)}, ("c",)).withColumn("ok", mutate.json_settable("j"))
    assert rows(out) == [('{"a":1,"a":2}', False), ('{"a":1,"u":1,"c":1}', True)]


@pytest.mark.parametrize("pattern, groups", [
    (r"^SELECT.*id = (\d+)", 1), (r"^SELECT (?<id>\d+)", 1), (r"^CALL [(]", 0), (r"\(x\)", 0), (r"(?:a|b)(?i)(?=c)(?<!d)(e)(f)", 2),
    (r"\Q(\E(a)", 1), (r"[^()]+[a&&[(]]", 0), ("", 0)])
def test_capture_groups(pattern, groups):
    assert shard.capture_groups(pattern) == groups


def test_routing_by_named_group_and_bracket(spark):
    log = spark.createDataFrame([("SELECT 42",), ("CALL (7)",)], "statement string")
    rules = [shard.Rule(1, r"^SELECT (?<id>\d+)", 10), shard.Rule(2, r"^CALL [(]", 20)]
    got = shard.route_log(log, rules, shard.equal_ranges(100, 2))
    assert rows(got, ["statement", "rule_id", "routed_key"]) == [("CALL (7)", 2, None), ("SELECT 42", 1, 42)]
