"""Mutation, ingest and generation jobs over the driver tables
(M1-M3, M5-M8, IO4, IO6, IO8, IO11, G1-G4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import generate
from ..operators import metrics, mutate, shard, windows
from ..session import scratch_path
from ..sources import io as sio
from ..sources import sqlapi
from ..sources.validate import Rules, validate
from .registry import register

UPDATE_TARGET_SQL = """
SELECT o_orderkey AS id, CAST(o_orderkey % 1000 AS INTEGER) AS counter,
       o_orderpriority AS data, o_orderstatus AS status, o_orderdate AS last_updated
FROM orders"""

STAMP = "996624000"   # unix seconds of the bindings' as-of date


def update_target(spark, sf):
    return B.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 1000).cast("int").alias("counter"),
        F.col("o_orderpriority").alias("data"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("last_updated"))


_M1_SET = f"""counter + 1 AS counter, coalesce(data, '') || '_updated_{STAMP}' AS data, status,
       TIMESTAMP '2001-08-01 00:00:00' AS last_updated"""


@register("m1_predicate_update", f"""WITH t AS ({UPDATE_TARGET_SQL})
SELECT id, {_M1_SET} FROM t WHERE id % 10 = 0
UNION ALL SELECT * FROM t WHERE NOT (id % 10 = 0)""")
def m1_predicate_update(spark, sf):
    t = update_target(spark, sf)
    return mutate.update(t, F.col("id") % 10 == 0, {
        "counter": F.col("counter") + 1,
        "data": F.concat(F.coalesce("data", F.lit("")), F.lit(f"_updated_{STAMP}")),
        "last_updated": F.lit(B.AS_OF).cast("timestamp_ntz")})


@register("m2_bounded_update", f"""WITH t AS ({UPDATE_TARGET_SQL}),
k AS (SELECT id FROM t WHERE id % 10 = 0 ORDER BY id LIMIT 500)
SELECT id, {_M1_SET} FROM t WHERE id IN (SELECT id FROM k)
UNION ALL SELECT * FROM t WHERE id NOT IN (SELECT id FROM k)""")
def m2_bounded_update(spark, sf):
    t = update_target(spark, sf)
    return mutate.update_limit(t, F.col("id") % 10 == 0, {
        "counter": F.col("counter") + 1,
        "data": F.concat(F.coalesce("data", F.lit("")), F.lit(f"_updated_{STAMP}")),
        "last_updated": F.lit(B.AS_OF).cast("timestamp_ntz")}, 500, "id")


@register("m3_batched_update", f"""WITH t AS ({UPDATE_TARGET_SQL}),
b AS (SELECT *, CAST(floor((id - 1) / 100) AS BIGINT) AS batch FROM t)
SELECT id,
       CASE WHEN id >= 1 AND batch < 50 THEN counter + 1 ELSE counter END AS counter,
       CASE WHEN id >= 1 AND batch < 50 THEN coalesce(data, '') || '_batch_' || CAST(batch AS VARCHAR) || '_0'
            ELSE data END AS data,
       CASE WHEN id >= 1 AND batch < 50 THEN (CASE WHEN batch % 2 = 0 THEN 'updated' ELSE 'active' END)
            ELSE status END AS status,
       last_updated
FROM b""")
def m3_batched_update(spark, sf):
    return mutate.update_batches(update_target(spark, sf), "id", 100, 5000)


_LATEST_CHANGE_SQL = """
SELECT pk, segment FROM (
  SELECT user_id * 13 AS pk, 'k' || json_extract_string(props, '$.k') AS segment,
         row_number() OVER (PARTITION BY user_id * 13 ORDER BY event_id DESC) AS rn
  FROM events WHERE event_type IN ('view', 'click')) WHERE rn = 1"""


def _latest_changes(spark, sf):
    e = B.events(spark, sf).where(F.col("event_type").isin("view", "click"))
    ch = e.select((F.col("user_id") * 13).alias("id"), "event_id",
                  F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("segment"))
    return windows.latest_per_key(ch, "id", "event_id").drop("event_id")


@register("m5_upsert", f"""WITH u AS ({B.USERS_SQL}), c AS ({_LATEST_CHANGE_SQL})
SELECT u.id, u.username, u.nation_id, coalesce(c.segment, u.segment) AS segment
FROM u LEFT JOIN c ON u.id = c.pk""")
def m5_upsert(spark, sf):
    new, _ = mutate.upsert(B.users(spark, sf), _latest_changes(spark, sf), "id")
    return new


@register("m5_upsert_report", f"""WITH c AS ({_LATEST_CHANGE_SQL})
SELECT pk AS id, pk IN (SELECT c_custkey FROM customer) AS matched FROM c""")
def m5_upsert_report(spark, sf):
    _, report = mutate.upsert(B.users(spark, sf), _latest_changes(spark, sf), "id")
    return report


SESSIONS_SQL = """
SELECT event_id AS id, user_id, ts AS created_at, ts + INTERVAL 1 HOUR AS expires_at,
       event_type <> 'error' AS is_active FROM events"""
SESSIONS_AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"


def _sessions(spark, sf):
    return B.events(spark, sf).select(
        F.col("event_id").alias("id"), "user_id", F.col("ts").alias("created_at"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("expires_at"),
        (F.col("event_type") != "error").alias("is_active"))


def _expire(spark, sf):
    s = _sessions(spark, sf)
    cond = (F.col("expires_at") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")) & ~F.col("is_active")
    return mutate.expire(s, cond)


@register("m6_retention_kept", f"""WITH s AS ({SESSIONS_SQL})
SELECT * FROM s WHERE NOT coalesce(expires_at < {SESSIONS_AS_OF} AND is_active = false, false)""")
def m6_retention_kept(spark, sf):
    return _expire(spark, sf)[0]


@register("m6_retention_removed", f"""WITH s AS ({SESSIONS_SQL})
SELECT count(*) AS removed FROM s WHERE expires_at < {SESSIONS_AS_OF} AND is_active = false""")
def m6_retention_removed(spark, sf):
    return _expire(spark, sf)[1]


DEL_KEYS_SQL = """
SELECT c_custkey AS id FROM customer WHERE c_nationkey = 5
UNION ALL SELECT c_custkey + 100000 FROM customer WHERE c_nationkey = 7"""


def _delete(spark, sf, mode):
    c = B.table(spark, sf, "customer")
    keys = (c.where(F.col("c_nationkey") == 5).select(F.col("c_custkey").alias("id"))
             .unionByName(c.where(F.col("c_nationkey") == 7)
                           .select((F.col("c_custkey") + 100000).alias("id"))))
    return mutate.delete(B.users(spark, sf), B.shop_orders(spark, sf), keys, "id", "user_id", mode)


@register("m7_delete_cascade", f"""WITH o AS ({B.SHOP_ORDERS_SQL}), k AS ({DEL_KEYS_SQL})
SELECT * FROM o WHERE user_id NOT IN (SELECT id FROM k WHERE id IN (SELECT c_custkey FROM customer))""")
def m7_delete_cascade(spark, sf):
    return _delete(spark, sf, "cascade")[1]


@register("m7_delete_set_null", f"""WITH o AS ({B.SHOP_ORDERS_SQL}), k AS ({DEL_KEYS_SQL})
SELECT id, CASE WHEN user_id IN (SELECT id FROM k) THEN NULL ELSE user_id END AS user_id,
       total_amount, status, created_at FROM o""")
def m7_delete_set_null(spark, sf):
    return _delete(spark, sf, "set_null")[1]


@register("m7_delete_missing", f"""WITH k AS ({DEL_KEYS_SQL})
SELECT DISTINCT id FROM k WHERE id NOT IN (SELECT c_custkey FROM customer)""")
def m7_delete_missing(spark, sf):
    return _delete(spark, sf, "cascade")[2]


@register("m7_delete_parents_kept", f"""WITH u AS ({B.USERS_SQL}), k AS ({DEL_KEYS_SQL})
SELECT * FROM u WHERE id NOT IN (SELECT id FROM k)""")
def m7_delete_parents_kept(spark, sf):
    return _delete(spark, sf, "cascade")[0]


@register("m8_surrogate_keys", """
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY event_id) AS id,
       event_id, 'user_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id AS VARCHAR) AS username,
       TIMESTAMP '2024-01-31 00:00:00' AS created_at, TIMESTAMP '2024-01-31 00:00:00' AS updated_at
FROM events WHERE event_type = 'signup'""")
def m8_surrogate_keys(spark, sf):
    e = B.events(spark, sf).where(F.col("event_type") == "signup").select(
        "event_id", F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit("_"),
                             F.col("event_id").cast("string")).alias("username"))
    return mutate.stamp(e, B.users(spark, sf), "id", "event_id", B.EVENTS_AS_OF) \
        .select("id", "event_id", "username", "created_at", "updated_at")


@register("io4_insert_ignore", """
WITH b AS (SELECT user_id * 11 AS id, 'signup_' || CAST(event_id AS VARCHAR) AS username,
                  row_number() OVER (PARTITION BY user_id * 11 ORDER BY event_id) AS rn
           FROM events WHERE event_type = 'signup')
SELECT c_custkey AS id, c_name AS username FROM customer
UNION ALL
SELECT id, username FROM b WHERE rn = 1 AND id NOT IN (SELECT c_custkey FROM customer)""")
def io4_insert_ignore(spark, sf):
    target = B.users(spark, sf).select("id", "username")
    batch = B.events(spark, sf).where(F.col("event_type") == "signup").select(
        (F.col("user_id") * 11).alias("id"), "event_id",
        F.concat(F.lit("signup_"), F.col("event_id").cast("string")).alias("username"))
    return mutate.insert_ignore(target, batch, "id", "event_id")


@register("io6_snapshot_copy", f"""WITH r AS (SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS n
           UNION ALL SELECT 'orders', (SELECT count(*) FROM orders))
SELECT table_name, n AS rows_copy, n AS rows_source, true AS in_sync, CAST(0 AS BIGINT) AS diff_rows,
       true AS verified FROM r""")
def io6_snapshot_copy(spark, sf):
    tables = {"customer": B.table(spark, sf, "customer"), "orders": B.source_orders(spark, sf)}
    return sio.snapshot_copy(spark, tables, scratch_path(spark, "snapshot"),
                             {"customer": "c_custkey", "orders": "o_orderkey"})


DOC_RULES = Rules(required=["source"], max_length={"text": 10000}, types={"n_chars": "int"},
                  domains={"lang": ["en", "de", "fr"]})

_DOC_REASONS = """concat_ws('; ',
    CASE WHEN source IS NULL OR trim(CAST(source AS VARCHAR)) = '' THEN 'source: required' END,
    CASE WHEN length(text) > 10000 THEN 'text: longer than 10000' END,
    CASE WHEN n_chars IS NOT NULL AND TRY_CAST(n_chars AS INTEGER) IS NULL THEN 'n_chars: not a valid int' END,
    CASE WHEN lang IS NOT NULL AND lang NOT IN ('en', 'de', 'fr') THEN 'lang: not one of en,de,fr' END)"""


@register("io8_validate_good", f"""
SELECT doc_id, lang, CAST(n_chars AS INTEGER) AS n_chars FROM documents WHERE {_DOC_REASONS} = ''""")
def io8_validate_good(spark, sf):
    d = B.table(spark, sf, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    good, _ = validate(d, DOC_RULES)
    return good.select("doc_id", "lang", "n_chars")


@register("io8_validate_bad", f"""
SELECT doc_id, {_DOC_REASONS} AS reason FROM documents WHERE {_DOC_REASONS} <> ''""")
def io8_validate_bad(spark, sf):
    d = B.table(spark, sf, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    _, bad = validate(d, DOC_RULES)
    return bad.select("doc_id", "reason")


@register("io11_param_sql", """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_custkey BETWEEN 100 AND 600 AND c_mktsegment = 'BUILDING'""")
def io11_param_sql(spark, sf):
    sqlapi.register_views(spark, {"customer": B.table(spark, sf, "customer")})
    return sqlapi.run_query(spark, "SELECT c_custkey, c_name, c_acctbal FROM customer "
                                   "WHERE c_custkey BETWEEN ? AND ? AND c_mktsegment = ?",
                            [100, 600, "BUILDING"])


# ---------------------------------------------------------------- generation
# Row counts are taken from the driver tables, so the generated volume grows with them.

def _count(spark, sf, name):
    return B.table(spark, sf, name).agg(F.count(F.lit(1))).first()[0]


@register("g1_numbers", "SELECT unnest(range((SELECT count(*) FROM customer))) AS n")
def g1_numbers(spark, sf):
    return generate.numbers(spark, _count(spark, sf, "customer"))


@register("g2_people", """
SELECT n, 'User_' || CAST(n AS VARCHAR) AS name, 'user_' || CAST(n AS VARCHAR) || '@example.com' AS email,
       CAST(18 + n % 50 AS INTEGER) AS age,
       CASE n % 5 WHEN 0 THEN 'New York' WHEN 1 THEN 'Los Angeles' WHEN 2 THEN 'Chicago'
                  WHEN 3 THEN 'Houston' ELSE 'Phoenix' END AS city
FROM (SELECT unnest(range((SELECT count(*) FROM customer))) AS n)""")
def g2_people(spark, sf):
    return generate.people(spark, _count(spark, sf, "customer"))


@register("g3_sales_formula", f"""
SELECT i, 1 + i * 1000 AS user_id, 1 + i * 10 AS product_id, CAST(1 + i % 10 AS INTEGER) AS quantity,
       CAST(10 + i * 0.1 AS DECIMAL(12,2)) AS price,
       CAST({B.AS_OF_SQL} - CAST(floor(i * 0.365) AS INTEGER) AS DATE) AS order_date,
       CASE i % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'shipped' ELSE 'delivered' END AS status
FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS i)""")
def g3_sales_formula(spark, sf):
    return generate.sales(spark, _count(spark, sf, "orders"), B.AS_OF)


@register("g4_update_rows", """
SELECT n + 1 AS id, CAST(n AS INTEGER) AS counter,
       'test_data_' || CAST(n AS VARCHAR) || '_' || repeat('x', CAST(n % 100 AS INTEGER)) AS data
FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS n)""")
def g4_update_rows(spark, sf):
    return generate.update_rows(spark, _count(spark, sf, "orders"))


# ---------------------------------------------------------------- lab statements, unchanged

_LAB_CTES = f"""WITH perf_test_select AS ({B.SALES_SQL}),
users AS ({B.USERS_SQL}), orders AS ({B.SHOP_ORDERS_SQL}),
products AS (SELECT p_partkey AS id, p_name AS name, p_type AS category,
                    CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part),
order_items AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
                       CAST(l_quantity AS INTEGER) AS quantity,
                       CAST(l_extendedprice AS DECIMAL(10,2)) AS total_price FROM lineitem)"""

STATUS_BY_MONTH = """
SELECT trunc(order_date, 'MM') AS month, status, count(DISTINCT user_id) AS buyers,
       max(price) AS dearest, sum(price * quantity) AS turnover
FROM perf_test_select
WHERE order_date BETWEEN :first AND :last AND quantity >= :pieces
GROUP BY trunc(order_date, 'MM'), status
HAVING count(DISTINCT user_id) >= :buyers"""


@register("io11_lab_complex_group_by", f"""{_LAB_CTES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, status, count(DISTINCT user_id) AS buyers,
       max(price) AS dearest, CAST(sum(price * quantity) AS DECIMAL(33,2)) AS turnover
FROM perf_test_select WHERE order_date >= DATE '1999-01-01' AND order_date <= DATE '2001-07-31' AND quantity >= 10
GROUP BY ALL HAVING count(DISTINCT user_id) >= 2""")
def io11_lab_complex_group_by(spark, sf):
    """A parameterised GROUP BY with a distinct count, by month and status."""
    import datetime as _dt
    sqlapi.register_lab_views(spark, sf)
    return sqlapi.run_query(spark, STATUS_BY_MONTH,
                            {"first": _dt.date(1999, 1, 1), "last": _dt.date(2001, 7, 31), "pieces": 10, "buyers": 2})


@register("io11_lab_order_details_view", f"""{_LAB_CTES},
order_details AS (SELECT o.id AS order_id, u.username, p.name AS product_name, oi.quantity,
                         oi.total_price, o.total_amount AS order_total, o.status, o.created_at
                  FROM orders o JOIN users u ON o.user_id = u.id
                                JOIN order_items oi ON o.id = oi.order_id
                                JOIN products p ON oi.product_id = p.id)
SELECT order_id, username, product_name, quantity, total_price, order_total, status
FROM order_details WHERE order_total > 400000 AND status = 'F'""")
def io11_lab_order_details_view(spark, sf):
    """A read of the lab's ``order_details`` view with parameters."""
    sqlapi.register_lab_views(spark, sf)
    return sqlapi.run_query(spark, "SELECT order_id, username, product_name, quantity, total_price, "
                                   "order_total, status FROM order_details "
                                   "WHERE order_total > ? AND status = ?", [400000, "F"])


# ---------------------------------------------------------------- sinks and maintenance on driver data

@register("io3_append_twice", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def io3_append_twice(spark, sf):
    """Two batch appends of the customer table into one (nation-partitioned) path."""
    path = scratch_path(spark, "append")
    c = B.table(spark, sf, "customer")
    for _ in range(2):
        sio.append(c, path, partition_by="c_nationkey")
    return spark.read.schema(c.schema).parquet(path).select(*c.columns)


@register("io9_compact_events", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def io9_compact_events(spark, sf):
    """The events table rewritten as ~256 MB files clustered by user and time."""
    out = scratch_path(spark, "compact")
    sio.compact(spark, f"{sf.rstrip('/')}/events.parquet", out, cluster_by=["user_id", "ts"])
    return spark.read.parquet(out)


@register("io9_compact_z_order", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem""")
def io9_compact_z_order(spark, sf):
    """Line items rewritten so that filters on the part, the supplier or the date skip files."""
    out = scratch_path(spark, "z-order")
    sio.compact(spark, f"{sf.rstrip('/')}/lineitem.parquet", out, z_order_by=["l_partkey", "l_suppkey", "l_shipdate"])
    return spark.read.parquet(out).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_shipdate", "l_extendedprice")


@register("io5_run_documents", """
SELECT 'day ' || CAST(CAST(ts AS DATE) AS VARCHAR) AS container, CAST(max(ts) AS VARCHAR) AS timestamp,
       event_type AS test_name, max(value) AS duration_ms, count(*) AS rows_returned,
       NOT event_type = 'error' AS success
FROM events GROUP BY CAST(ts AS DATE), event_type""".replace(
    "CAST(max(ts) AS VARCHAR)", "CAST(CAST(ts AS DATE) AS VARCHAR)"))
def io5_run_documents(spark, sf):
    """One run document per event day, with a select test per event type,
    written as JSON and read back."""
    day = F.to_date("ts").cast("string")
    per_type = B.events(spark, sf).groupBy(day.alias("timestamp"), "event_type").agg(
        F.max("value").alias("duration_ms"), F.count(F.lit(1)).alias("rows_returned"))
    test = F.struct(F.col("event_type").alias("test_name"), "duration_ms", "rows_returned",
                    (F.col("event_type") != "error").alias("success"))
    docs = per_type.groupBy("timestamp").agg(F.collect_list(test).alias("tests")).select(
        F.concat(F.lit("day "), "timestamp").alias("container"), "timestamp",
        F.struct(F.struct("tests").alias("select")).alias("tests"))     # five event types a day
    path = scratch_path(spark, "runs")
    metrics.write_runs(docs, path)
    return metrics.read_runs(spark, path)


@register("s2_reshard", "SELECT * FROM customer")
def s2_reshard(spark, sf):
    """The customer table written in three shards, then over the same path in one."""
    c = B.table(spark, sf, "customer")
    keys = c.agg(F.max("c_custkey")).first()[0] or 1
    path = scratch_path(spark, "shards")
    for n in (3, 1):
        shard.write(c, path, "c_custkey", shard.equal_ranges(keys + 1, n, start=0))
    return spark.read.schema(c.schema).parquet(path).select(*c.columns)


@register("m4_json_set", """
SELECT event_id,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'click' THEN event_id * 10 END AS updated,
       CASE WHEN event_type = 'click' THEN 1 END AS update_count
FROM events""")
def m4_json_set(spark, sf):
    """JSON field update on the click events: ``$.updated`` set, ``$.update_count``
    incremented from 0, other fields kept; checked through the field values."""
    e = B.events(spark, sf).select("event_id", "event_type", "props")
    u = mutate.json_set(e, "props", {"updated": F.col("event_id") * 10}, increments=("update_count",),
                        cond=F.col("event_type") == "click")
    return u.select("event_id",
                    F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                    F.get_json_object("props", "$.updated").cast("bigint").alias("updated"),
                    F.get_json_object("props", "$.update_count").cast("int").alias("update_count"))
