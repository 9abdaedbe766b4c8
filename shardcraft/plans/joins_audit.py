"""Joins, replica audits and set differences over the driver tables
(J1-J3, J5, J6, A1, U2, IO10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..operators import audit, joins, metrics
from ..session import scratch_path
from .registry import register

AS_OF = B.AS_OF_SQL


def _items(spark, sf):
    return B.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("total_price"))


def _products(spark, sf):
    return B.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"))


@register("j1_user_orders", f"""WITH u AS ({B.USERS_SQL}), o AS ({B.SHOP_ORDERS_SQL})
SELECT u.id AS user_id, u.username, o.id AS order_id, o.total_amount, o.status, o.created_at
FROM u LEFT JOIN o
  ON u.id = o.user_id""")
def j1_user_orders(spark, sf):
    return joins.user_orders(B.users(spark, sf), B.shop_orders(spark, sf))


@register("j2_order_details", f"""WITH o AS ({B.SHOP_ORDERS_SQL}), u AS ({B.USERS_SQL})
SELECT o.id AS order_id, u.username, p_name AS product_name,
       CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price, o.total_amount AS order_total,
       o.status, o.created_at
FROM o JOIN u ON o.user_id = u.id
       JOIN lineitem ON o.id = l_orderkey
       JOIN part ON l_partkey = p_partkey""")
def j2_order_details(spark, sf):
    return joins.order_details(B.shop_orders(spark, sf), B.users(spark, sf),
                               _items(spark, sf), _products(spark, sf))


@register("j3_customer_spend", f"""WITH u AS ({B.USERS_SQL}), o AS ({B.SHOP_ORDERS_SQL})
SELECT u.id AS user_id, u.username, count(o.id) AS order_count,
       CAST(coalesce(sum(o.total_amount), 0) AS DECIMAL(18,2)) AS total_spent
FROM u LEFT JOIN o
  ON u.id = o.user_id
WHERE u.segment = 'BUILDING'
GROUP BY u.id, u.username
HAVING CAST(coalesce(sum(o.total_amount), 0) AS DECIMAL(18,2)) > 300000
ORDER BY total_spent DESC, user_id LIMIT 100""")
def j3_customer_spend(spark, sf):
    return joins.customer_spend(B.users(spark, sf), B.shop_orders(spark, sf), 300000, 100,
                                user_filter=F.col("segment") == "BUILDING")


@register("j5_orphans", f"""WITH o AS ({B.SHOP_ORDERS_SQL}), u AS ({B.USERS_SQL})
SELECT o.id, o.user_id, o.total_amount, o.status, o.created_at FROM o
WHERE o.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM u WHERE u.nation_id <> 5 AND u.id = o.user_id)""")
def j5_orphans(spark, sf):
    parent = B.users(spark, sf).where(F.col("nation_id") != 5)
    return joins.orphans(B.shop_orders(spark, sf), parent, "user_id", "id")


def _replica2(spark, sf):
    return B.source_orders(spark, sf).where(F.col("o_orderkey") % 101 != 7)


@register("j6_presence", f"""WITH r1 AS ({B.REPLICA_ORDERS_SQL}),
r2 AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 101 <> 7),
s AS (SELECT DISTINCT o_orderkey FROM orders)
SELECT s.o_orderkey,
       EXISTS (SELECT 1 FROM r1 WHERE r1.o_orderkey = s.o_orderkey) AS on_replica1,
       EXISTS (SELECT 1 FROM r2 WHERE r2.o_orderkey = s.o_orderkey) AS on_replica2,
       (EXISTS (SELECT 1 FROM r1 WHERE r1.o_orderkey = s.o_orderkey)
        AND EXISTS (SELECT 1 FROM r2 WHERE r2.o_orderkey = s.o_orderkey)) AS all_present
FROM s""")
def j6_presence(spark, sf):
    return audit.presence(B.source_orders(spark, sf),
                          {"replica1": B.replica_orders(spark, sf), "replica2": _replica2(spark, sf)},
                          "o_orderkey")


@register("j6_presence_bitmaps", f"""WITH r1 AS ({B.REPLICA_ORDERS_SQL}),
r2 AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 101 <> 7)
SELECT DISTINCT o.o_orderkey, r1.o_orderkey IS NOT NULL AS on_replica1, r2.o_orderkey IS NOT NULL AS on_replica2,
       r1.o_orderkey IS NOT NULL AND r2.o_orderkey IS NOT NULL AS all_present
FROM orders o LEFT JOIN r1 ON r1.o_orderkey = o.o_orderkey LEFT JOIN r2 ON r2.o_orderkey = o.o_orderkey""")
def j6_presence_bitmaps(spark, sf):
    return audit.presence_bitmaps(B.source_orders(spark, sf),
                                  {"replica1": B.replica_orders(spark, sf), "replica2": _replica2(spark, sf)},
                                  "o_orderkey")


@register("j6_missing", f"""WITH r1 AS ({B.REPLICA_ORDERS_SQL})
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r1)""")
def j6_missing(spark, sf):
    return audit.missing(B.source_orders(spark, sf), B.replica_orders(spark, sf), "o_orderkey")


@register("a1_count_compare", f"""WITH r AS ({B.REPLICA_ORDERS_SQL}),
c AS (SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS rows_replica,
             (SELECT count(*) FROM customer) AS rows_source
      UNION ALL
      SELECT 'orders', (SELECT count(*) FROM r), (SELECT count(*) FROM orders))
SELECT table_name, rows_replica, rows_source, rows_replica = rows_source AS in_sync FROM c""")
def a1_count_compare(spark, sf):
    cust = B.table(spark, sf, "customer")
    return audit.count_compare({
        "source": {"orders": B.source_orders(spark, sf), "customer": cust},
        "replica": {"orders": B.replica_orders(spark, sf), "customer": cust}})


@register("u2_snapshot_diff", f"""WITH s AS ({B.SOURCE_ORDERS_SQL}), r AS ({B.REPLICA_ORDERS_SQL})
SELECT coalesce(s.o_orderkey, r.o_orderkey) AS o_orderkey,
       CASE WHEN r.o_orderkey IS NULL THEN 'only_source'
            WHEN s.o_orderkey IS NULL THEN 'only_replica'
            ELSE 'changed' END AS status
FROM s FULL JOIN r ON s.o_orderkey = r.o_orderkey
WHERE r.o_orderkey IS NULL OR s.o_orderkey IS NULL
   OR s.o_custkey IS DISTINCT FROM r.o_custkey OR s.o_orderstatus IS DISTINCT FROM r.o_orderstatus
   OR s.o_totalprice IS DISTINCT FROM r.o_totalprice OR s.o_orderdate IS DISTINCT FROM r.o_orderdate""")
def u2_snapshot_diff(spark, sf):
    return audit.diff(B.source_orders(spark, sf), B.replica_orders(spark, sf), "o_orderkey")


@register("u2_snapshot_diff_summary", f"""WITH s AS ({B.SOURCE_ORDERS_SQL}), r AS ({B.REPLICA_ORDERS_SQL}),
d AS (SELECT CASE WHEN r.o_orderkey IS NULL THEN 'only_source'
                  WHEN s.o_orderkey IS NULL THEN 'only_replica' ELSE 'changed' END AS status
      FROM s FULL JOIN r ON s.o_orderkey = r.o_orderkey
      WHERE r.o_orderkey IS NULL OR s.o_orderkey IS NULL
         OR s.o_custkey IS DISTINCT FROM r.o_custkey OR s.o_orderstatus IS DISTINCT FROM r.o_orderstatus
         OR s.o_totalprice IS DISTINCT FROM r.o_totalprice OR s.o_orderdate IS DISTINCT FROM r.o_orderdate)
SELECT status, count(*) AS rows FROM d GROUP BY status""")
def u2_snapshot_diff_summary(spark, sf):
    return audit.diff_summary(
        audit.diff(B.source_orders(spark, sf), B.replica_orders(spark, sf), "o_orderkey", exact=True))


_CHANGED = """s.o_custkey IS DISTINCT FROM r.o_custkey OR s.o_orderstatus IS DISTINCT FROM r.o_orderstatus
   OR s.o_totalprice IS DISTINCT FROM r.o_totalprice OR s.o_orderdate IS DISTINCT FROM r.o_orderdate
   OR s.o_orderpriority IS DISTINCT FROM r.o_orderpriority"""


@register("u2_differing_ranges", f"""WITH r AS ({B.REPLICA_ORDERS_SQL}),
b AS (SELECT coalesce(s.o_orderkey, r.o_orderkey) >> 6 AS bucket, s.o_orderkey IS NOT NULL AS in_s,
             r.o_orderkey IS NOT NULL AS in_r,
             s.o_orderkey IS NULL OR r.o_orderkey IS NULL OR {_CHANGED} AS differs
      FROM orders s FULL JOIN r ON s.o_orderkey = r.o_orderkey)
SELECT bucket, count(*) FILTER (in_s) AS rows_source, count(*) FILTER (in_r) AS rows_replica
FROM b GROUP BY bucket HAVING bool_or(differs)""")
def u2_differing_ranges(spark, sf):
    """Ranges of 64 keys whose stored digests differ."""
    copies = {"source": B.source_orders(spark, sf), "replica": B.replica_orders(spark, sf)}
    stored = {}
    for name, df in copies.items():
        path = scratch_path(spark, f"digests-{name}")
        audit.range_digests(df, "o_orderkey", bits=6).write.parquet(path)
        stored[name] = spark.read.parquet(path)
    return audit.differing_ranges(stored["source"], stored["replica"])


@register("u2_range_diff", f"""WITH r AS ({B.REPLICA_ORDERS_SQL})
SELECT coalesce(s.o_orderkey, r.o_orderkey) AS o_orderkey,
       CASE WHEN r.o_orderkey IS NULL THEN 'only_source' WHEN s.o_orderkey IS NULL THEN 'only_replica'
            ELSE 'changed' END AS status
FROM orders s FULL JOIN r ON s.o_orderkey = r.o_orderkey
WHERE r.o_orderkey IS NULL OR s.o_orderkey IS NULL OR {_CHANGED}""")
def u2_range_diff(spark, sf):
    return audit.diff_in_ranges(B.source_orders(spark, sf), B.replica_orders(spark, sf), "o_orderkey")


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# bytes and file counts depend on the files, not the rows: tests look at those
@register("io10_table_inventory", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES))
def io10_table_inventory(spark, sf):
    return audit.table_inventory({n: B.table(spark, sf, n) for n in TABLES}).select("table_name", "rows")


# Status pairs of the cluster nodes, from the hours of the query log: a node is
# connected in an hour in which it logged anything, ready if at most half of its
# statements failed, and Primary if it ran at least two; the size it sees is
# the number of nodes with statements.
_PAIRS_SQL = f"""q AS ({B.QUERY_LOG_SQL}),
h AS (SELECT node, date_trunc('hour', ts) AS snapshot_ts, count(*) AS n,
             count(*) FILTER (NOT ok) AS failed FROM q GROUP BY 1, 2),
z AS (SELECT snapshot_ts, count(*) AS size FROM h GROUP BY 1)"""


def _status_pairs(spark, sf):
    h = B.query_log(spark, sf).groupBy("node", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("snapshot_ts")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((~F.col("ok")).cast("long")).alias("failed"))
    j = h.join(h.groupBy("snapshot_ts").agg(F.count(F.lit(1)).alias("size")), "snapshot_ts")
    values = [F.col("size").cast("string"),
              F.when(F.col("n") >= 2, F.lit("Primary")).otherwise(F.lit("non-Primary")), F.lit("ON"),
              F.when(F.col("failed") * 2 <= F.col("n"), F.lit("ON")).otherwise(F.lit("OFF"))]
    pairs = F.array(*[F.struct(F.lit(name).alias("variable_name"), v.alias("variable_value"))
                      for name, v in zip(audit.HEALTH_VARS, values)])
    return j.select("node", "snapshot_ts", F.explode(pairs).alias("p")).select("node", "snapshot_ts", "p.*")


@register("c1_node_health", f"""WITH {_PAIRS_SQL},
l AS (SELECT snapshot_ts, 'node' || CAST(i AS VARCHAR) AS node FROM z, range({B.NODE_COUNT}) r(i)),
p AS (SELECT l.snapshot_ts, l.node,
             CASE WHEN h.n IS NOT NULL THEN CAST(z.size AS VARCHAR) END AS wsrep_cluster_size,
             CASE WHEN h.n >= 2 THEN 'Primary' WHEN h.n IS NOT NULL THEN 'non-Primary' END AS wsrep_cluster_status,
             CASE WHEN h.n IS NOT NULL THEN 'ON' END AS wsrep_connected,
             CASE WHEN h.failed * 2 <= h.n THEN 'ON' WHEN h.n IS NOT NULL THEN 'OFF' END AS wsrep_ready
      FROM l JOIN z ON l.snapshot_ts = z.snapshot_ts
      LEFT JOIN h ON l.snapshot_ts = h.snapshot_ts AND l.node = h.node)
SELECT *, coalesce(wsrep_cluster_size = '{B.NODE_COUNT}' AND wsrep_cluster_status = 'Primary'
                   AND wsrep_connected = 'ON' AND wsrep_ready = 'ON', false) AS healthy,
       min(coalesce(wsrep_cluster_status, '?')) OVER s = max(coalesce(wsrep_cluster_status, '?')) OVER s
         AS cluster_agrees
FROM p WINDOW s AS (PARTITION BY snapshot_ts)""")
def c1_node_health(spark, sf):
    return audit.node_health(_status_pairs(spark, sf), B.NODE_COUNT, [f"node{i}" for i in range(B.NODE_COUNT)])


# Two "instances": the users' statement counts before and from 2024-01-16.
_HALF = "2024-01-16"


@register("c2_config_diff", f"""WITH v AS (
SELECT 'user_' || CAST(user_id AS VARCHAR) AS variable_name,
       nullif(count(*) FILTER (ts < TIMESTAMP '{_HALF}'), 0) AS a,
       nullif(count(*) FILTER (ts >= TIMESTAMP '{_HALF}'), 0) AS b FROM events GROUP BY user_id)
SELECT 'later' AS instance, variable_name, CAST(a AS VARCHAR) AS base_value, CAST(b AS VARCHAR) AS value,
       CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' ELSE 'changed' END AS status,
       round(CAST(b AS DOUBLE) / a, 4) AS ratio
FROM v WHERE a IS DISTINCT FROM b""")
def c2_config_diff(spark, sf):
    e = B.events(spark, sf)

    def instance(rows):
        return rows.groupBy(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("variable_name")) \
                   .agg(F.count(F.lit(1)).cast("string").alias("variable_value"))
    half = F.lit(_HALF).cast("timestamp_ntz")
    return audit.config_diff({"earlier": instance(e.where(F.col("ts") < half)),
                              "later": instance(e.where(F.col("ts") >= half))})


# Two "runs": the same halves; rows per measure are its throughput, the longest
# read its time.
@register("a15_compare_runs", f"""WITH e AS (
SELECT ts >= TIMESTAMP '{_HALF}' AS late, value,
       CASE WHEN event_type IN ('signup', 'purchase') THEN 'insert' WHEN event_type = 'error' THEN 'update'
            ELSE 'select' END AS measure FROM events),
p AS (SELECT measure, CASE WHEN measure = 'select' THEN 'time' ELSE 'throughput' END AS kind,
             CASE WHEN measure = 'select' THEN max(value) FILTER (NOT late) ELSE count(*) FILTER (NOT late) END AS a,
             CASE WHEN measure = 'select' THEN max(value) FILTER (late) ELSE count(*) FILTER (late) END AS b
      FROM e GROUP BY measure),
g AS (SELECT measure, kind, a AS base_value, b AS other_value,
             round(CASE WHEN kind = 'time' THEN (a - b) / nullif(a, 0) * 100 ELSE (b - a) / nullif(a, 0) * 100 END, 2) AS gain_pct
      FROM p),
u AS (SELECT * FROM g UNION ALL
      SELECT 'overall', 'mixed', NULL, NULL, round(sum(coalesce(gain_pct, 0)) / 3, 2) FROM g)
SELECT *, CASE WHEN gain_pct > 0 THEN 'IMPROVED' WHEN gain_pct < 0 THEN 'DEGRADED' ELSE 'UNCHANGED' END AS verdict
FROM u""")
def a15_compare_runs(spark, sf):
    kind = F.col("event_type")
    e = B.events(spark, sf).select(
        F.when(F.col("ts") < F.lit(_HALF).cast("timestamp_ntz"), F.lit("earlier")).otherwise(F.lit("later")).alias("run_id"),
        F.when(kind.isin("signup", "purchase"), F.lit("insert")).when(kind == "error", F.lit("update"))
         .otherwise(F.lit("select")).alias("measure"), "value")
    g = e.groupBy("run_id", "measure").agg(F.count(F.lit(1)).cast("double").alias("n"), F.max("value").alias("longest"))
    time = F.col("measure") == "select"
    return metrics.compare_runs(g.select(
        "run_id", "measure", F.when(time, F.lit("time")).otherwise(F.lit("throughput")).alias("kind"),
        F.when(time, F.col("longest")).otherwise(F.col("n")).alias("value")), "earlier", "later")
