"""Sharding jobs over the driver tables (S1-S3, F1, IO1, U1, K4, A10-A12, J4).

Users (``customer``) are range-sharded by id into three inclusive ranges of
n/3 ids starting at 1, n taken from the table; id 0 lies outside every range.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..operators import shard
from ..session import scratch_path
from .registry import register
from .sqlfrag import ratio_sql


def _ranges(spark, sf):
    n = B.table(spark, sf, "customer").agg(F.count(F.lit(1))).first()[0]
    return shard.equal_ranges(n, 3)


# SQL mirror of equal_ranges(count(customer), 3)
RANGES_CTE = """r AS (SELECT count(*) // 3 AS w, count(*) AS n FROM customer)"""


def shard_case(col: str) -> str:
    return (f"CASE WHEN {col} BETWEEN 1 AND r.w THEN 1 "
            f"WHEN {col} BETWEEN r.w + 1 AND 2 * r.w THEN 2 "
            f"WHEN {col} BETWEEN 2 * r.w + 1 AND r.n THEN 3 END")


@register("s1_shard_assign", f"""WITH {RANGES_CTE}
SELECT c_custkey AS id, c_name AS username, {shard_case('c_custkey')} AS shard_id
FROM customer, r WHERE {shard_case('c_custkey')} IS NOT NULL""")
def s1_shard_assign(spark, sf):
    u = B.users(spark, sf).select("id", "username")
    good, _ = shard.assign(u, "id", _ranges(spark, sf))
    return good


@register("s1_shard_quarantine", f"""WITH {RANGES_CTE}
SELECT c_custkey AS id, c_name AS username, CAST(NULL AS INTEGER) AS shard_id,
       'key outside every shard range' AS reason
FROM customer, r WHERE {shard_case('c_custkey')} IS NULL""")
def s1_shard_quarantine(spark, sf):
    u = B.users(spark, sf).select("id", "username")
    _, bad = shard.assign(u, "id", _ranges(spark, sf))
    return bad


@register("s1_many_ranges", """
SELECT c_custkey AS id, c_name AS username,
       CAST(CASE WHEN c_custkey BETWEEN 0 AND 299999 AND c_custkey % 3 < 2 THEN c_custkey // 3 + 1 END AS INTEGER) AS shard_id
FROM customer""")
def s1_many_ranges(spark, sf):
    """100,000 declared ranges of two keys each, with a gap of one key between them."""
    ranges = [shard.ShardRange(i + 1, 3 * i, 3 * i + 1) for i in range(100_000)]
    return shard.assign(B.users(spark, sf).select("id", "username"), "id", ranges, on_miss="keep")


def _written_shards(spark, sf):
    """Write the in-range users as one directory per shard."""
    ranges = _ranges(spark, sf)
    u = B.users(spark, sf).select("id", "username")
    good, _ = shard.assign(u, "id", ranges)
    path = scratch_path(spark, "users_sharded")
    shard.write(good.drop("shard_id"), path, "id", ranges)
    return path, ranges


def _read_each(spark, path, ranges):
    """Every written shard as a table of its own."""
    return {r.shard_id: spark.read.parquet(f"{path}/shard_id={r.shard_id}") for r in ranges}


@register("io1_read_shards", f"""WITH {RANGES_CTE}
SELECT c_custkey AS id, c_name AS username, {shard_case('c_custkey')} AS shard_id,
       'shard' || CAST({shard_case('c_custkey')} AS VARCHAR) AS shard_name
FROM customer, r WHERE {shard_case('c_custkey')} IS NOT NULL""")
def io1_read_shards(spark, sf):
    path, ranges = _written_shards(spark, sf)
    return shard.read_shards(spark, {r.shard_id: f"{path}/shard_id={r.shard_id}" for r in ranges})


@register("f1_shard_lookup", f"""WITH {RANGES_CTE}
SELECT c_custkey AS id, c_name AS username, {shard_case('c_custkey')} AS shard_id
FROM customer, r WHERE c_custkey = 700""")
def f1_shard_lookup(spark, sf):
    path, ranges = _written_shards(spark, sf)
    df = spark.read.parquet(path)
    return shard.lookup(df, "id", 700, ranges).select("id", "username", "shard_id")


@register("u1_union_guarded", f"""WITH {RANGES_CTE}
SELECT c_custkey AS id, c_name AS username, {shard_case('c_custkey')} AS shard_id
FROM customer, r WHERE {shard_case('c_custkey')} IS NOT NULL""")
def u1_union_guarded(spark, sf):
    path, ranges = _written_shards(spark, sf)
    return shard.union_guarded(_read_each(spark, path, ranges), ranges, "id")


@register("k4_ordered_union", f"""WITH {RANGES_CTE}
SELECT c_custkey AS id, c_name AS username, {shard_case('c_custkey')} AS shard_id
FROM customer, r WHERE {shard_case('c_custkey')} IS NOT NULL ORDER BY id""")
def k4_ordered_union(spark, sf):
    path, ranges = _written_shards(spark, sf)
    return shard.ordered(shard.union_guarded(_read_each(spark, path, ranges), ranges, "id"), "id")


_AUDIT_SQL = """WITH {ranges},
g AS (SELECT {shard_expr} AS shard_id, count(*) AS rows, min(c_custkey) AS min_key,
             max(c_custkey) AS max_key FROM customer, r {where} GROUP BY 1),
d AS (SELECT 1 AS shard_id, 1 AS range_lo, r.w AS range_hi FROM r
      UNION ALL SELECT 2, r.w + 1, 2 * r.w FROM r
      UNION ALL SELECT 3, 2 * r.w + 1, r.n FROM r)
SELECT d.shard_id, 'shard' || CAST(d.shard_id AS VARCHAR) AS shard_name,
       CAST(d.range_lo AS BIGINT) AS range_lo, CAST(d.range_hi AS BIGINT) AS range_hi,
       coalesce(g.rows, 0) AS rows, g.min_key, g.max_key,
       coalesce(g.rows, 0) > 0 AND coalesce(g.min_key >= d.range_lo AND g.max_key <= d.range_hi, false) AS ok
FROM d LEFT JOIN g ON d.shard_id = g.shard_id"""


@register("a10_shard_audit", _AUDIT_SQL.format(
    ranges=RANGES_CTE, shard_expr=shard_case("c_custkey"),
    where=f"WHERE {shard_case('c_custkey')} IS NOT NULL"))
def a10_shard_audit(spark, sf):
    ranges = _ranges(spark, sf)
    good, _ = shard.assign(B.users(spark, sf).select("id"), "id", ranges)
    return shard.audit(good, "id", ranges)


@register("a10_shard_audit_misplaced", _AUDIT_SQL.format(
    ranges=RANGES_CTE, shard_expr="c_nationkey % 3 + 1", where=""))
def a10_shard_audit_misplaced(spark, sf):
    u = B.users(spark, sf).select("id", (F.col("nation_id") % 3 + 1).alias("shard_id"))
    return shard.audit(u, "id", _ranges(spark, sf))


@register("a11_shard_balance", f"""WITH {RANGES_CTE},
s AS ({B.SALES_SQL}),
c AS (SELECT 'users' AS table_name, {shard_case('c_custkey')} AS shard_id, count(*) AS rows
      FROM customer, r GROUP BY 2
      UNION ALL SELECT 'orders', {shard_case('o_custkey')}, count(*) FROM orders, r GROUP BY 2
      UNION ALL SELECT 'sales', {shard_case('user_id')}, count(*) FROM s, r GROUP BY 2),
t AS (SELECT table_name, sum(rows) AS table_rows,
             sum(rows) FILTER (shard_id IS NOT NULL) AS placed_rows,
             max(rows) FILTER (shard_id IS NOT NULL) AS max_rows
      FROM c GROUP BY table_name)
SELECT c.table_name, c.shard_id, c.rows, {ratio_sql("c.rows * 100", "t.table_rows", 4)} AS share_pct,
       {ratio_sql("t.max_rows * 3", "t.placed_rows", 4)} AS skew
FROM c JOIN t ON c.table_name = t.table_name""")
def a11_shard_balance(spark, sf):
    ranges = _ranges(spark, sf)
    tables = {
        "users": B.users(spark, sf).select(shard.shard_of("id", ranges).alias("shard_id")),
        "orders": B.shop_orders(spark, sf).select(shard.shard_of("user_id", ranges).alias("shard_id")),
        # line items counted per order before the join (eager aggregation)
        "sales": B.table(spark, sf, "lineitem").groupBy("l_orderkey")
                  .agg(F.count(F.lit(1)).alias("rows_weight"))
                  .join(B.table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                        F.col("l_orderkey") == F.col("o_orderkey"))
                  .select(shard.shard_of("o_custkey", ranges).alias("shard_id"), "rows_weight"),
    }
    return shard.balance(tables, [1, 2, 3])


@register("a12_cross_shard_aggregate", f"""WITH {RANGES_CTE}, o AS ({B.SHOP_ORDERS_SQL})
SELECT status, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_amount
FROM o, r WHERE {shard_case('o.user_id')} IS NOT NULL GROUP BY status""")
def a12_cross_shard_aggregate(spark, sf):
    path, ranges = _written_orders(spark, sf)
    logical = shard.union_guarded(_read_each(spark, path, ranges), ranges, "user_id")
    return shard.aggregate(logical, "status", [
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").cast("decimal(22,2)").alias("total_amount")])


def _written_orders(spark, sf):
    """Write the orders of in-range users as one directory per shard."""
    ranges = _ranges(spark, sf)
    good, _ = shard.assign(B.shop_orders(spark, sf), "user_id", ranges)
    path = scratch_path(spark, "orders_sharded")
    shard.write(good.drop("shard_id"), path, "user_id", ranges)
    return path, ranges


ORDER_STATES = shard.States(("status",), sums=("total_amount",), bounds=("user_id", "created_at"))


@register("a12_stored_states", f"""WITH {RANGES_CTE}, o AS ({B.SHOP_ORDERS_SQL})
SELECT status, count(*) AS rows, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_amount_sum,
       count(total_amount) AS total_amount_n, min(user_id) AS user_id_min, max(user_id) AS user_id_max,
       min(created_at) AS created_at_min, max(created_at) AS created_at_max
FROM o, r WHERE {shard_case('o.user_id')} IS NOT NULL GROUP BY status""")
def a12_stored_states(spark, sf):
    """The aggregate from states stored per shard: the shards' rows aren't read again."""
    path, ranges = _written_orders(spark, sf)
    stored = scratch_path(spark, "order_states")
    shard.write_states(_read_each(spark, path, ranges), stored, ORDER_STATES)
    merged = shard.read_states(spark, stored, ORDER_STATES)
    return merged.withColumn("total_amount_sum", F.col("total_amount_sum").cast("decimal(22,2)"))


@register("j4_cross_shard_join", """
SELECT o_orderkey // 3 AS local_id, o_orderkey % 3 + 1 AS shard_id, o_custkey, l_linenumber, l_partkey
FROM orders JOIN lineitem ON l_orderkey // 3 = o_orderkey // 3 AND l_orderkey % 3 = o_orderkey % 3""")
def j4_cross_shard_join(spark, sf):
    o = B.table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 3 + 1).alias("shard_id"),
        F.floor(F.col("o_orderkey") / 3).cast("bigint").alias("local_id"), "o_custkey")
    li = B.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 3 + 1).alias("shard_id"),
        F.floor(F.col("l_orderkey") / 3).cast("bigint").alias("order_local_id"),
        "l_linenumber", "l_partkey")
    j = shard.cross_shard_join(o, li, "local_id", "order_local_id")
    return j.select("local_id", "shard_id", "o_custkey", "l_linenumber", "l_partkey")


_ROUTE_COLS = "log_id, stmt_type, kind, rule_id, hostgroup, routed_key, intended_shard, rule_shard, misrouted"


def _rule_case(value) -> str:
    parts = [f"WHEN regexp_matches(statement, '(?i){r.match_pattern}') THEN {value(r)}"
             for r in shard.LAB_RULES]
    return "CASE " + " ".join(parts) + " END"


_ROUTE_SQL = f"""WITH {RANGES_CTE}, q AS ({B.QUERY_LOG_SQL}),
x AS (SELECT log_id, upper(regexp_extract(statement, '^\\s*([A-Za-z]+)', 1)) AS stmt_type,
             {_rule_case(lambda r: r.rule_id)} AS rule_id,
             {_rule_case(lambda r: r.destination_hostgroup)} AS hostgroup,
             TRY_CAST(nullif({_rule_case(lambda r: "regexp_extract(statement, '(?i)" + r.match_pattern + "', 1)")}, '')
                      AS BIGINT) AS routed_key
      FROM q),
y AS (SELECT x.*, CASE WHEN stmt_type IN ('SELECT', 'SHOW', 'DESCRIBE', 'EXPLAIN') THEN 'read' ELSE 'write' END AS kind,
             {shard_case('routed_key')} AS intended_shard,
             CASE hostgroup WHEN 10 THEN 1 WHEN 20 THEN 2 WHEN 30 THEN 3 END AS rule_shard
      FROM x, r)
SELECT log_id, stmt_type, kind, rule_id, hostgroup, routed_key, intended_shard, rule_shard,
       NOT coalesce(rule_shard = intended_shard, false) AS misrouted FROM y"""


def _routed(spark, sf):
    q = B.query_log(spark, sf).select("log_id", "statement")
    return shard.route_log(q, shard.LAB_RULES, _ranges(spark, sf),
                           hostgroup_shard=shard.LAB_HOSTGROUP_SHARD)


@register("s3_route_log", _ROUTE_SQL)
def s3_route_log(spark, sf):
    return _routed(spark, sf).select(*[c.strip() for c in _ROUTE_COLS.split(",")])


@register("s3_route_summary", f"""WITH z AS ({_ROUTE_SQL})
SELECT stmt_type, kind, hostgroup, intended_shard, count(*) AS statements,
       CAST(sum(CAST(misrouted AS INTEGER)) AS BIGINT) AS misrouted
FROM z GROUP BY stmt_type, kind, hostgroup, intended_shard""")
def s3_route_summary(spark, sf):
    return shard.route_summary(_routed(spark, sf))


def _first_rule(value) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(statement, '(?i){r.match_pattern}') THEN {value(r)}"
                              for r in shard.CLUSTER_RULES) + " END"


@register("s3_cluster_rules", f"""WITH q AS ({B.QUERY_LOG_SQL}),
x AS (SELECT log_id, upper(regexp_extract(statement, '^\\s*([A-Za-z]+)', 1)) AS stmt_type,
             {_first_rule(lambda r: r.rule_id)} AS rule_id,
             {_first_rule(lambda r: r.destination_hostgroup)} AS hostgroup FROM q)
SELECT log_id, stmt_type, CASE WHEN stmt_type IN ('SELECT', 'SHOW', 'DESCRIBE', 'EXPLAIN') THEN 'read' ELSE 'write' END AS kind,
       rule_id, hostgroup FROM x""")
def s3_cluster_rules(spark, sf):
    """The log under the cluster's rules: every statement type goes to one hostgroup, by
    rules without a key."""
    q = B.query_log(spark, sf).select("log_id", "statement")
    return (shard.route_log(q, shard.CLUSTER_RULES, _ranges(spark, sf))
            .select("log_id", "stmt_type", "kind", "rule_id", "hostgroup"))


@register("f2_shard_key_range", f"""WITH {RANGES_CTE}
SELECT c_custkey AS id, c_name AS username, {shard_case('c_custkey')} AS shard_id
FROM customer, r WHERE c_custkey BETWEEN 20 AND r.w + 5""")
def f2_shard_key_range(spark, sf):
    """F2 on shard-partitioned files: the id range also becomes a shard
    predicate, so only the directories of the shards it overlaps are listed."""
    path, ranges = _written_shards(spark, sf)
    hi = ranges[0].hi + 5           # a range crossing from shard 1 into shard 2
    return shard.key_range(spark.read.parquet(path), "id", 20, hi, ranges).select("id", "username", "shard_id")
