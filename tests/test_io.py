"""Sources and sinks: append, run documents,
compaction, inventory, parameterised SQL, validation."""

import json
import os

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL, rows
from shardcraft.operators import audit, metrics
from shardcraft.sources import io as sio
from shardcraft.sources import sqlapi
from shardcraft.sources.validate import Rules, validate



def test_append_accumulates(spark, tmp):
    a = spark.range(0, 10).withColumn("shard_id", F.col("id") % 3)
    sio.append(a, tmp, partition_by="shard_id")
    sio.append(a, tmp, partition_by="shard_id")
    assert spark.read.parquet(tmp).count() == 20


def test_z_order_lets_every_column_skip_files(spark, tmp):
    src = os.path.join(tmp, "src")
    df = spark.range(0, 30_000, 1, 4).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(5000)).alias("a"),
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("v"), F.lpad(F.pmod(F.hash("id"), F.lit(700)).cast("string"), 3, "0"))).alias("b"))
    df.write.parquet(src)
    size = sum(os.path.getsize(os.path.join(src, f)) for f in os.listdir(src) if f.endswith(".parquet"))
    touched = {}
    for name, how in (("range", {"cluster_by": ["a", "b"]}), ("z", {"z_order_by": ["a", "b"]})):
        out = os.path.join(tmp, name)
        n = sio.compact(spark, src, out, target_mb=size / 32 / (1 << 20), **how)
        kept = spark.read.parquet(out)
        assert n in (32, 33) and rows(kept) == rows(df)
        spans = kept.groupBy("_metadata.file_path").agg(
            F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"))
        touched[name] = (spans.where("a0 <= 120 AND a1 >= 100").count(), spans.where("b0 <= 'v120' AND b1 >= 'v100'").count())
    assert touched["range"][1] >= 30 and touched["z"][1] <= 16 and touched["z"][0] <= 16
    with pytest.raises(ValueError, match="either"):
        sio.compact(spark, src, os.path.join(tmp, "x"), cluster_by="a", z_order_by=["b"])


def test_z_order_of_an_empty_table_and_equal_values(spark):
    assert sio.z_order(spark.createDataFrame([], "a int, b string"), ["a", "b"]).count() == 0
    same = sio.z_order(spark.createDataFrame([(1, None)] * 5, "a int, b string"), ["a", "b"])
    assert same.select("__z").distinct().count() == 1


RUN = {"container": "mysql-default", "timestamp": "2024-01-01T00:00:00Z", "total_duration_ms": 10.0,
       "tests": {"insert": {"records_per_second": "5000"},
                 "select": {"total_duration_ms": 30.0,
                            "tests": [{"test_name": "Simple WHERE", "duration_ms": 12.5, "rows_returned": 1,
                                       "success": True},
                                      {"test_name": "Complex GROUP BY", "duration_ms": 17.5,
                                       "rows_returned": 100, "success": True}]}},
       "metrics": {"initial": {"status": {"Innodb_buffer_pool_reads": "100",
                                          "Innodb_buffer_pool_read_requests": "1000"},
                               "variables": {"max_connections": "151"}},
                   "final": {"status": {"Innodb_buffer_pool_reads": "150",
                                        "Innodb_buffer_pool_read_requests": "3000"},
                             "variables": {"max_connections": "151"}}}}


def test_run_documents_roundtrip(spark, tmp):
    path = os.path.join(tmp, "runs")
    os.makedirs(path)
    with open(os.path.join(path, "run1.json"), "w") as f:
        json.dump(RUN, f, indent=2)
    t = metrics.read_runs(spark, path, multi_line=True)
    assert rows(t, ["test_name", "duration_ms", "rows_returned"]) == [
        ("Complex GROUP BY", 17.5, 100), ("Simple WHERE", 12.5, 1)]
    out = os.path.join(tmp, "out")
    metrics.write_runs(spark.read.option("multiLine", True).json(path), out)
    assert metrics.read_runs(spark, out).count() == 2
    st = metrics.read_status_pairs(spark, path, multi_line=True)
    got = {(r.snapshot, r.variable_name): r.variable_value for r in st.collect()}
    assert got[("final", "Innodb_buffer_pool_read_requests")] == "3000" and len(got) == 4
    var = metrics.read_status_pairs(spark, path, "variables", multi_line=True)
    assert var.count() == 2


def test_compact_clusters_by_key(spark, tmp):
    src = os.path.join(tmp, "src")
    spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5000).repartition(50).write.parquet(src)
    out = os.path.join(tmp, "out")
    n = sio.compact(spark, src, out, target_mb=1, cluster_by="k")
    df = spark.read.parquet(out)
    assert n == 1 and df.count() == 5000
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == 1


def test_compact_bounds_a_tasks_memory_when_rows_compress_well(spark, tmp):
    src = os.path.join(tmp, "src")
    spark.range(0, 40_000, 1, 4).select(
        "id", F.pmod("id", F.lit(7)).alias("k"), F.lit("x" * 400).alias("s"), F.array(F.lit(1.5)).alias("odd name"),
        F.when(F.col("id") % 2 == 0, F.lit("y")).alias("t")).write.parquet(src)
    whole = spark.read.parquet(src)
    for name, how in (("range", {"cluster_by": ["k", "id"]}), ("z", {"z_order_by": ["k", "id"]})):
        out = os.path.join(tmp, name)
        n = sio.compact(spark, src, out, sort_mb=4, **how)
        files = [r[0] for r in spark.read.parquet(out).groupBy("_metadata.file_path").count().select("count").collect()]
        assert n >= 5 and len(files) >= 5 and max(files) * 500 < 8 << 20      # was one file, sorted in one task
        assert spark.read.parquet(out).exceptAll(whole).isEmpty() and spark.read.parquet(out).count() == 40_000
    assert sio.compact(spark, src, os.path.join(tmp, "plain"), sort_mb=4) == 1      # nothing is sorted
    spark.createDataFrame([], "k int, s string").write.parquet(os.path.join(tmp, "none"))
    assert sio.compact(spark, os.path.join(tmp, "none"), os.path.join(tmp, "still"), cluster_by="k") == 1


def test_table_inventory(spark):
    inv = audit.table_inventory({"customer": spark.read.parquet(f"{SF_SMALL}/customer.parquet")})
    r = inv.first()
    assert r.rows == 150 and r.bytes == os.path.getsize(f"{SF_SMALL}/customer.parquet") and r.files == 1


def test_sql_api_rejects_writes(spark, tmp):
    spark.range(5).createOrReplaceTempView("t_ids")
    assert sqlapi.run_query(spark, "SELECT id FROM t_ids WHERE id > ?", [2]).count() == 2
    assert sqlapi.run_query(spark, "SELECT ';' AS c").first().c == ";"
    assert sqlapi.run_query(spark, "SELECT id FROM t_ids WHERE id = :k", {"k": 2}).count() == 1
    assert sqlapi.run_query(spark, "SHOW TABLES").count() > 0
    for bad in ["WITH x AS (SELECT 1 AS id) INSERT INTO t_ids SELECT * FROM x",
                f"WITH x AS (SELECT 1 AS id) INSERT OVERWRITE DIRECTORY '{tmp}/d' USING parquet SELECT * FROM x",
                "FROM t_ids INSERT INTO t_a SELECT id INSERT INTO t_b SELECT id",
                "CREATE TABLE t_c AS SELECT 1 AS id", "DROP TABLE t_ids", "  insert into t_ids values (1)", "/* x */ DELETE FROM t_ids",
                "SELECT 1; DROP TABLE t_ids"]:
        with pytest.raises(sqlapi.WriteRejected):
            sqlapi.run_query(spark, bad)


def test_validate_quarantine(spark):
    df = spark.createDataFrame([
        ("1", "Alice", "alice@example.com", "active"),
        ("2", "Bob", None, "active"),                                    # missing email
        ("3", "'; DROP TABLE users; --", "x@example.com", "active"),     # text is data
        ("4", "L" * 10000, "l@example.com", "active"),                   # too long
        ("invalid_id", "Eve", "e@example.com", "gone")],                 # bad id and status
        "id string, username string, email string, status string")
    rules = Rules(required=["username", "email"], max_length={"username": 50}, types={"id": "int"},
                  domains={"status": ["active", "inactive", "suspended"]})
    good, bad = validate(df, rules)
    assert rows(good, ["id", "username"]) == [(1, "Alice"), (3, "'; DROP TABLE users; --")]
    reasons = {r.id: r.reason for r in bad.collect()}
    assert reasons["2"] == "email: required"
    assert reasons["4"] == "username: longer than 50"
    assert reasons["invalid_id"] == "id: not a valid int; status: not one of active,inactive,suspended"


def test_snapshot_copy_verifies(spark, tmp):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    r = sio.snapshot_copy(spark, {"customer": c}, os.path.join(tmp, "copy"), {"customer": "c_custkey"}).first()
    assert r.verified and r.rows_copy == r.rows_source == 150


def test_lab_views_run_statements_as_written(spark):
    names = sqlapi.register_lab_views(spark, SF_SMALL)
    assert {"users", "orders", "perf_test_select", "user_orders", "order_details"} <= set(names)
    one = sqlapi.run_query(spark, "SELECT * FROM users WHERE id = ?", [42])
    assert one.count() == 1
    cnt = sqlapi.run_query(spark, "SELECT COUNT(*) AS count FROM perf_test_select "
                                  "WHERE user_id BETWEEN ? AND ?", [10, 50]).first()["count"]
    assert cnt == spark.table("perf_test_select").where("user_id BETWEEN 10 AND 50").count()
    led = sqlapi.run_query(spark, """
        SELECT account_id,
               SUM(CASE WHEN transaction_type = 'CREDIT' THEN amount ELSE 0 END) AS total_credits,
               COUNT(*) AS transaction_count, MAX(transaction_date) AS last_transaction
        FROM stress_test_transactions GROUP BY account_id
        HAVING transaction_count > ? ORDER BY total_credits DESC, account_id LIMIT ?""", [1, 50])
    assert 0 < led.count() <= 50
    uo = sqlapi.run_query(spark, "SELECT user_id, COUNT(order_id) AS n FROM user_orders GROUP BY user_id")
    assert uo.count() == spark.table("users").count()
    assert sqlapi.run_query(spark, "SELECT COUNT(*) AS c FROM order_details").first()["c"] > 0


def test_write_version_never_overwrites(spark, tmp):
    base = os.path.join(tmp, "table")
    p1 = sio.write_version(spark.range(3), base, 1)
    p2 = sio.write_version(spark.range(5), base, 2)
    assert p1.endswith("v=00000001") and spark.read.parquet(p1).count() == 3
    assert spark.read.parquet(base).where("v = 2").count() == 5
    with pytest.raises(Exception):
        sio.write_version(spark.range(1), base, 1)      # an existing version is immutable
    assert spark.read.parquet(p2).count() == 5


@pytest.mark.parametrize("sql", [
    "SELECT a FROM t WHERE x IN (SELECT y FROM u) ORDER BY 1 LIMIT 3", "WITH c AS (SELECT 1 AS x) SELECT * FROM c",
    "SELECT count(*) AS c FROM t GROUP BY a HAVING c > 1", "SELECT sum(x) OVER (PARTITION BY a) FROM t",
    "SELECT * FROM VALUES (1), (2) AS v(a) UNION SELECT 1", "FROM t |> SELECT a", "TABLE t", "SELECT DISTINCT a FROM t OFFSET 3",
    "SELECT * FROM a JOIN b USING (x) LEFT JOIN c ON a.y = c.y", "SELECT * FROM t LATERAL VIEW explode(a) e",
    "SELECT 'java_method(1)' AS word", "show tables", " DESCRIBE t", "SHOW COLUMNS IN t", "EXPLAIN SELECT 1",
    "SELECT /*+ BROADCAST(t) */ * FROM t TABLESAMPLE (10 PERCENT)", "SELECT * FROM t WHERE a = ?"])
def test_reading_statements_pass(spark, sql):
    assert sqlapi.statement_kind(spark, sql) == "read"


@pytest.mark.parametrize("sql", [
    "EXECUTE IMMEDIATE \"INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT 1\"",
    "SELECT java_method('java.lang.System', 'setProperty', 'a', 'b')", "SELECT 1 WHERE `Reflect`('a', 'b') = 1",
    "SELECT * FROM (SELECT try_reflect('java.lang.System', 'exit'))", "WITH c AS (SELECT reflect('a', 'b') AS x) SELECT * FROM c",
    "SELECT (SELECT max(java_method('a', 'b')))", "SELECT IDENTIFIER('java_method')('a', 'b')",
    "FROM t INSERT INTO u SELECT * INSERT INTO v SELECT *", "WITH c AS (SELECT 1) INSERT INTO u SELECT * FROM c",
    "INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT 1", "CREATE TABLE u AS SELECT 1", "DROP VIEW t", "SET a = b",
    "CACHE TABLE t", "ADD JAR '/x.jar'", "DELETE FROM t", "CALL system.p()", "USE x", "TRUNCATE TABLE t", "REFRESH TABLE t",
    "SELECT TRANSFORM (a) USING 'sh' AS (b) FROM t", "SELECT 1; SELECT 2", "not a statement", ""])
def test_anything_else_is_rejected(spark, sql):
    with pytest.raises(sqlapi.WriteRejected):
        sqlapi.run_query(spark, sql)
