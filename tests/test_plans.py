"""Plan shape: pushdown, pruning, top-k, no Python in the hot path."""

import __spark_entry__ as E
from support import SF_SMALL, plan_text


def _plan(spark, name):
    return plan_text(E.queries()[name](spark, SF_SMALL))


def _scans(plan):
    return [line for line in plan.splitlines() if "FileScan parquet" in line]


def test_filters_reach_the_scan(spark):
    scans = _scans(_plan(spark, "f3_date_band"))
    orders = [s for s in scans if "o_orderdate" in s][0]
    assert "GreaterThanOrEqual(o_orderdate," in orders and "LessThan(o_orderdate," in orders
    lineitem = [s for s in scans if "l_orderkey" in s][0]
    assert "ReadSchema: struct<l_orderkey:bigint>" in lineitem      # only the join key is read


def test_columns_pruned(spark):
    scans = _scans(_plan(spark, "a2_top_users"))
    assert any("ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in s
               for s in scans)
    assert any("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in s
               for s in scans)


def test_topk_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "k1_top_price")


def test_no_python_udfs_anywhere(spark):
    for name in E.queries():
        if name in ("io1_read_shards", "f1_shard_lookup", "io6_snapshot_copy", "m8_surrogate_keys"):
            continue
        p = _plan(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_two_level_topk_equals_single_level(spark):
    from pyspark.sql import functions as F
    from shardcraft.operators import topk
    df = spark.range(0, 20000, 1, 37).select("id", ((F.col("id") * 7919) % 1000).alias("v"))
    one = topk.by(df, ["-v"], 300, ["id"], fan_in=0)
    two = topk.by(df, ["-v"], 300, ["id"], fan_in=4)
    assert "WindowGroupLimit" in plan_text(two) and "WindowGroupLimit" not in plan_text(one)
    assert [tuple(r) for r in one.collect()] == [tuple(r) for r in two.collect()]


def test_eager_status_summary_equals_row_level(spark):
    from shardcraft import bindings as B
    from pyspark.sql import functions as F
    from shardcraft.operators import aggregates
    for kind in ("decimal(12,2)", "double"):       # the price as the sales table has it, and as it is stored
        items = B.table(spark, SF_SMALL, "lineitem").withColumn("l_extendedprice", F.col("l_extendedprice").cast(kind))
        orders = B.table(spark, SF_SMALL, "orders")
        sales = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_orderstatus").alias("status"), F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").cast("int").alias("quantity"))
        row_level = aggregates.status_summary(sales if kind == "double" else B.sales(spark, SF_SMALL))
        eager = aggregates.status_summary_by_order(
            items, orders, "l_orderkey", "o_orderkey", "o_orderstatus", "l_extendedprice", "l_quantity")
        assert sorted(map(tuple, row_level.collect())) == sorted(map(tuple, eager.select(*row_level.columns).collect()))


def test_user_orders_rewrite_equals_left_join(spark):
    from pyspark.sql import functions as F
    from shardcraft.operators import joins
    users = spark.range(0, 50).select(F.col("id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("username"))
    # user 7 holds most orders; users 40..49 have none
    orders = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 4 != 0, F.lit(7)).otherwise(F.col("id") % 40).alias("user_id"),
        F.col("id").cast("decimal(12,2)").alias("total_amount"), F.lit("O").alias("status"),
        F.lit("2024-01-01").cast("date").alias("created_at"))
    got = joins.user_orders(users, orders)
    u, o = users.alias("u"), orders.alias("o")
    want = u.join(o, F.col("u.id") == F.col("o.user_id"), "left").select(
        F.col("u.id").alias("user_id"), "u.username", F.col("o.id").alias("order_id"),
        "o.total_amount", "o.status", "o.created_at")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
