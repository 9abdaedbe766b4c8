"""Property checks on random inputs (hypothesis), each against a plain
Python model of the semantics."""

import datetime as dt
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import rows
from shardcraft.functions import generate
from shardcraft.operators import audit, shard, windows
from shardcraft.streaming import changes as CH

FAST = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@FAST
@given(n=st.integers(3, 5000), k=st.integers(1, 7),
       keys=st.lists(st.integers(-20, 5100), min_size=1, max_size=60))
def test_every_key_in_exactly_one_shard(spark, n, k, keys):
    if n < k:
        return
    ranges = shard.equal_ranges(n, k)
    df = spark.createDataFrame([(x,) for x in keys], "id long")
    good, bad = shard.assign(df, "id", ranges)
    got = dict(good.select("id", "shard_id").distinct().collect())
    for x in set(keys):
        owners = [r.shard_id for r in ranges if r.lo <= x <= r.hi]
        assert len(owners) <= 1
        assert got.get(x) == (owners[0] if owners else None)
    assert good.count() + bad.count() == len(keys)


@FAST
@given(data=st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.integers(-5, 5)),
                               st.one_of(st.none(), st.text(max_size=3))),
                     min_size=1, max_size=40, unique_by=lambda t: t[0]),
       changed=st.sets(st.integers(0, 50), max_size=5), dropped=st.sets(st.integers(0, 50), max_size=5))
def test_diff_finds_exactly_the_drift(spark, data, changed, dropped):
    schema = "id int, a int, b string"
    src = spark.createDataFrame(data, schema)
    assert audit.diff(src, src, "id").count() == 0            # U2(x, x) is empty
    rep = [(i, (a or 0) + 1 if i in changed else a, b) for i, a, b in data if i not in dropped]
    dst = spark.createDataFrame(rep, schema)
    got = {r.id: r.status for r in audit.diff(src, dst, "id").collect()}
    ids = {i for i, _, _ in data}
    want = {i: "only_source" for i in dropped & ids}
    want.update({i: "changed" for i in (changed & ids) - dropped})
    assert got == want
    assert {r.id: r.status for r in audit.diff(src, dst, "id", exact=True).collect()} == want


@FAST
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.integers(-100, 100)), min_size=1, max_size=80),
       width=st.integers(1, 20))
def test_chunked_suffix_sum_equals_window(spark, vals, width):
    data = [(i, k, v) for i, (k, v) in enumerate(vals)]
    df = spark.createDataFrame(data, "id long, k int, v long")
    got = windows.suffix_sum(df, "k", "id", F.col("v"), "s", runs=width)
    want = df.withColumn("s", F.sum("v").over(
        Window.partitionBy("k").orderBy("id").rowsBetween(0, Window.unboundedFollowing)))
    assert rows(got, ["id", "s"]) == rows(want, ["id", "s"])


def test_sales_formula_closed_form(spark):
    as_of = dt.date(2001, 8, 1)
    got = {r.i: r for r in generate.sales(spark, 2000, as_of).where(F.col("i") % 97 == 0).collect()}
    statuses = ["pending", "processing", "shipped", "delivered"]
    for i, r in got.items():
        assert r.user_id == 1 + 1000 * i and r.product_id == 1 + 10 * i
        assert r.quantity == 1 + i % 10 and r.price == Decimal(10) + Decimal(i) / 10
        assert r.order_date == as_of - dt.timedelta(days=math.floor(i * 365 / 1000))
        assert r.status == statuses[i % 4]


def _replay(start, changes, policy):
    """Sequential model of a replica applying ordered changes."""
    state = dict(start)                       # pk -> (row, pos)
    for pos, op, pk, row in sorted(changes):
        if pk in state and state[pk][1] is not None and pos <= state[pk][1]:
            continue                          # not newer than what is applied
        exists = pk in state and state[pk][0] is not None
        if op == "D":
            state[pk] = (None, pos)
        elif op == "I" and exists and policy == "skip":
            continue
        else:
            state[pk] = (row, pos)
    return {k: v for k, v in state.items() if v[0] is not None}


@FAST
@given(ops=st.lists(st.tuples(st.sampled_from("IUD"), st.integers(0, 4)), min_size=1, max_size=40),
       existing=st.dictionaries(st.integers(0, 4), st.tuples(st.booleans(), st.sampled_from([-1, 3, 12])),
                                max_size=4),
       policy=st.sampled_from(["skip", "upsert"]))
def test_change_apply_equals_sequential_replay(spark, ops, existing, policy):
    """Targets may hold live rows or delete tombstones, with stored positions
    that make some changes stale."""
    changes = [(p, op, pk, f"r{p}") for p, (op, pk) in enumerate(ops)]
    start = {pk: (None if dead else f"init{pk}", pos) for pk, (dead, pos) in existing.items()}
    t = spark.createDataFrame([(pk, row, pos, row is None) for pk, (row, pos) in start.items()],
                              "pk long, row string, _pos long, _deleted boolean")
    ch = spark.createDataFrame([(p, None, op, "t", pk, row) for p, op, pk, row in changes], CH.CHANGE_SCHEMA)
    eff = CH.effective_changes(ch, t, "pk", policy)
    got = {r.pk: (r.row, r._pos) for r in CH.merge(t, eff, "pk").where(~F.col("_deleted")).collect()}
    assert got == _replay(start, [(p, op, pk, row) for p, op, pk, row in changes], policy)


def test_diff_sees_values_moving_between_null_columns(spark):
    src = spark.createDataFrame([(1, "x", None), (2, None, None)], "id int, a string, b string")
    dst = spark.createDataFrame([(1, None, "x"), (2, None, None)], "id int, a string, b string")
    assert [(r.id, r.status) for r in audit.diff(src, dst, "id").collect()] == [(1, "changed")]


def test_change_apply_hot_key_equals_replay(spark):
    """One key receives most of the changes, so the salted join spreads its
    inserts over all salts; the result must still equal sequential replay."""
    import random
    rnd = random.Random(3)
    changes = []
    for p in range(4000):
        pk = 1 if rnd.random() < 0.8 else rnd.randint(2, 30)
        op = rnd.choice("IIIUD") if pk == 1 else rnd.choice("IUD")
        changes.append((p, op, pk, f"r{p}"))
    start = {1: ("init1", -1), 2: (None, -1), 3: ("init3", 100)}
    t = spark.createDataFrame([(pk, row, pos, row is None) for pk, (row, pos) in start.items()],
                              "pk long, row string, _pos long, _deleted boolean")
    ch = spark.createDataFrame([(p, None, op, "t", pk, row) for p, op, pk, row in changes], CH.CHANGE_SCHEMA)
    for policy in ("skip", "upsert"):
        eff = CH.effective_changes(ch, t, "pk", policy)
        got = {r.pk: (r.row, r._pos) for r in CH.merge(t, eff, "pk").where(~F.col("_deleted")).collect()}
        assert got == _replay(start, changes, policy), policy
