"""Table mutation as copy-on-write (M1-M8): every operator maps an old
DataFrame to a new one; the caller writes it to a new path (see
``sources.io.write_version``).  No operator collects rows to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _match_keys(df: DataFrame, keys: list[str], collation: str | None):
    """Columns to match keys on: the keys themselves, or for string keys their
    collated form (e.g. ``UNICODE_CI`` for case-insensitive matching as the
    source databases do); the stored key values are never changed."""
    if not collation:
        return df, keys
    names = []
    for i, k in enumerate(keys):
        if type(df.schema[k].dataType).__name__ == "StringType":
            df = df.withColumn(f"__mk{i}", F.collate(F.col(k), collation))
            names.append(f"__mk{i}")
        else:
            names.append(k)
    return df, names


def _ts(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")


def update(df: DataFrame, cond: Column, assignments: dict, flag: str | None = None,
           touch: tuple | None = None) -> DataFrame:
    """M1: ``UPDATE ... SET col = expr WHERE cond`` (NULL cond = no match).
    ``flag`` names an optional boolean column marking the updated rows;
    ``touch=(column, as_of)`` sets that audit column on updated rows (M8)."""
    hit = F.coalesce(cond, F.lit(False))
    out = df.withColumn("__hit", hit)
    assignments = dict(assignments)
    if touch:
        assignments[touch[0]] = _ts(touch[1])
    for c, e in assignments.items():
        out = out.withColumn(c, F.when(F.col("__hit"), e).otherwise(F.col(c)))
    return out.withColumnRenamed("__hit", flag) if flag else out.drop("__hit")


def update_limit(df: DataFrame, cond: Column, assignments: dict, n: int, key: str,
                 flag: str | None = None) -> DataFrame:
    """M2: ``UPDATE ... WHERE cond LIMIT n`` with the n rows defined as the
    first n matching rows by ``key`` (unique).  The n-th key is found with a
    top-k and read as a scalar subquery, so no join is needed."""
    hit = F.coalesce(cond, F.lit(False))
    nth = df.where(hit).select(key).orderBy(F.col(key).asc()).limit(n) \
            .agg(F.max(key)).scalar()
    return update(df, hit & (F.col(key) <= nth), assignments, flag)


def update_batches(df: DataFrame, key: str, size: int, max_rows: int, counter: str = "counter",
                   data: str = "data", status: str = "status", stamp: Column | None = None) -> DataFrame:
    """M3: batch i updates ids ``size*i+1 .. size*(i+1)`` for the first
    ``max_rows`` rows: counter + 1, data suffixed with ``_batch_<i>_<stamp>``,
    status ``updated`` for even batches and ``active`` for odd ones.  One pass."""
    batch = F.floor((F.col(key) - 1) / F.lit(size)).cast("long")
    n_batches = -(-max_rows // size)
    sfx = F.concat(F.lit("_batch_"), batch.cast("string"),
                   F.lit("_"), (stamp if stamp is not None else F.lit("0")).cast("string"))
    cond = (F.col(key) >= 1) & (batch < n_batches)
    return update(df, cond, {
        counter: F.col(counter) + 1,
        data: F.concat(F.coalesce(F.col(data), F.lit("")), sfx),
        status: F.when(batch % 2 == 0, F.lit("updated")).otherwise(F.lit("active")),
    })


def _json_fields(col: str) -> Column:
    """The fields of a JSON object; NULL for anything else and for repeated fields."""
    return F.try_variant_get(F.try_parse_json(F.col(col)), "$", "map<string,variant>")


def json_settable(col: str) -> Column:
    """Whether :func:`json_set` can change the document."""
    return _json_fields(col).isNotNull()


def json_set(df: DataFrame, col: str, values: dict, increments: tuple = (),
             cond: Column | None = None) -> DataFrame:
    """M4: set top-level JSON fields (``values``: field -> Column) and add 1
    to the counters in ``increments`` (a missing counter counts as 0); other
    fields keep their JSON values.  NULL, malformed and non-object documents and
    documents that name a field twice stay as they are (:func:`json_settable` tells
    them).  ``cond`` limits the rows touched."""
    m = _json_fields(col)
    touched = list(values) + list(increments)
    kept = F.map_filter(m, lambda k, v: ~k.isin(touched))
    pairs = []
    for f, e in values.items():
        pairs += [F.lit(f), F.parse_json(F.to_json(F.array(e)).substr(F.lit(2), F.length(F.to_json(F.array(e))) - 2))]
    for f in increments:
        old = F.coalesce(F.try_variant_get(m[f], "$", "bigint"), F.lit(0))
        pairs += [F.lit(f), F.parse_json((old + 1).cast("string"))]
    new = F.to_json(F.map_concat(F.coalesce(kept, F.create_map().cast("map<string,variant>")),
                                 F.create_map(*pairs)))
    new = F.when(m.isNotNull(), new).otherwise(F.col(col))     # only objects are changed
    if cond is not None:
        new = F.when(F.coalesce(cond, F.lit(False)), new).otherwise(F.col(col))
    return df.withColumn(col, new)


def upsert(target: DataFrame, changes: DataFrame, keys, insert_missing: bool = False,
           collation: str | None = None, touch: tuple | None = None):
    """M5: replace the changed columns of matching keys.  Returns
    ``(new_table, report)`` where ``report`` lists every change key with
    ``matched`` true/false (the 404 case).  Changes must be one row per key
    (see ``windows.latest_per_key``).  ``collation`` matches string keys under
    that collation (the target keeps its stored key values).
    ``touch=(column, as_of)`` sets that audit column on every changed or
    inserted row (M8)."""
    keys = _list(keys)
    if touch:
        changes = changes.withColumn(touch[0], _ts(touch[1]))
    if collation:
        return _upsert_collated(target, changes, keys, insert_missing, collation)
    cols = [c for c in changes.columns if c not in keys]
    ch = changes.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in cols]).withColumn("__c", F.lit(True))
    t = target.withColumn("__t", F.lit(True))
    how = "full" if insert_missing else "left"
    j = t.join(ch, keys, how)
    present = F.col("__c").isNotNull()
    out = [F.col(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        if c in cols:
            out.append(F.when(present, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    new_table = j.select(*out).select(*target.columns)
    report = ch.select(*keys).join(target.select(*keys).withColumn("__m", F.lit(True)), keys, "left") \
               .select(*keys, F.coalesce(F.col("__m"), F.lit(False)).alias("matched"))
    return new_table, report


def _upsert_collated(target, changes, keys, insert_missing, collation):
    cols = [c for c in changes.columns if c not in keys]
    t, tk = _match_keys(target.withColumn("__t", F.lit(True)), keys, collation)
    ch = changes.select(*[F.col(k).alias(f"__ck_{k}") for k in keys],
                        *[F.col(c).alias(f"__new_{c}") for c in cols]).withColumn("__c", F.lit(True))
    ch, ck = _match_keys(ch, [f"__ck_{k}" for k in keys], collation)
    ck = [f"__c{n}" if n.startswith("__mk") else n for n in ck]
    ch = ch.select(*[F.col(c).alias(f"__c{c}") if c.startswith("__mk") else F.col(c) for c in ch.columns])
    cond = None
    for a, b in zip(tk, ck):
        e = F.col(a) == F.col(b)
        cond = e if cond is None else cond & e
    j = t.join(ch, cond, "full" if insert_missing else "left")
    present = F.col("__c").isNotNull()
    out = [F.coalesce(F.col(k), F.col(f"__ck_{k}")).alias(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        out.append(F.when(present, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c))
    new_table = j.select(*out).select(*target.columns)
    # report from the change side: every change key, matched or not
    tkeys = t.select(*tk, "__t")
    report = ch.join(tkeys, cond, "left").select(*[F.col(f"__ck_{k}").alias(k) for k in keys],
                                                 F.col("__t").isNotNull().alias("matched"))
    return new_table, report


def expire(df: DataFrame, cond: Column):
    """M6: retention delete.  Returns ``(kept, removed_count_df)``; rows where
    the condition is NULL are kept."""
    hit = F.coalesce(cond, F.lit(False))
    kept = df.where(~hit)
    removed = df.where(hit).agg(F.count(F.lit(1)).alias("removed"))
    return kept, removed


def delete(parents: DataFrame, children: DataFrame, del_keys: DataFrame, pk, fk,
           mode: str = "cascade"):
    """M7: delete parents by key; children follow by ``cascade`` (removed) or
    ``set_null`` (foreign key set to NULL).  Returns
    ``(parents_kept, children_after, missing_keys)``."""
    pk, fk = _list(pk), _list(fk)
    dk = del_keys.select(*pk).distinct()
    kept = parents.join(dk, pk, "left_anti")
    missing = dk.join(parents.select(*pk), pk, "left_anti")
    # keys that really were deleted, renamed to the child's fk names
    gone = dk.join(parents.select(*pk), pk, "left_semi") \
             .select(*[F.col(p).alias(f) for p, f in zip(pk, fk)])
    if mode == "cascade":
        after = children.join(gone, fk, "left_anti")
    elif mode == "set_null":
        tagged = children.join(gone.withColumn("__gone", F.lit(True)), fk, "left")
        after = tagged
        for f in fk:
            after = after.withColumn(f, F.when(F.col("__gone"), F.lit(None).cast(children.schema[f].dataType))
                                       .otherwise(F.col(f)))
        after = after.select(*children.columns)
    else:
        raise ValueError(mode)
    return kept, after, missing


def stamp(new_rows: DataFrame, target: DataFrame, key: str, order, as_of,
          created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """M8: gap-free surrogate ids after the target's current max, assigned in
    ``order``, plus audit timestamps.  Rows are range-sorted, checkpointed (so
    recomputation after a lost executor sees the same partitions), counted per
    partition, and offset by a prefix sum over the partition counts — no
    single-partition window over the data."""
    from ..session import checkpoint_dir
    spark = new_rows.sparkSession
    checkpoint_dir(spark)
    order = _list(order)
    sorted_rows = new_rows.orderBy(*order).checkpoint(eager=True)
    with_pos = sorted_rows.select("*", F.spark_partition_id().alias("__pid"),
                                  F.monotonically_increasing_id().alias("__mid"))
    counts = with_pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # partition count is bounded by the job's partitioning, so this window is tiny
    offsets = counts.withColumn("__off", F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).drop("__n")
    base = target.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).scalar()
    j = with_pos.join(F.broadcast(offsets), "__pid")
    within = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    ts = _ts(as_of)
    return (j.withColumn(key, base + F.coalesce(F.col("__off"), F.lit(0)) + within + 1)
             .withColumn(created, ts).withColumn(updated, ts)
             .drop("__pid", "__mid", "__off"))


def insert_ignore(target: DataFrame, batch: DataFrame, keys, order,
                  collation: str | None = None) -> DataFrame:
    """IO4: append only batch rows whose key is new; inside the batch the first
    row per key (by ``order``) wins.  The in-batch dedupe is a partial ``min``
    over a struct, so a repeated key is reduced map-side.  ``collation``
    compares string keys under that collation (e.g. ``UNICODE_CI``)."""
    keys, order = _list(keys), _list(order)
    rest = [c for c in batch.columns if c not in keys and c not in order]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyless, batch = batch.where(~whole), batch.where(whole)     # a unique key admits any number of NULLs
    b, bk = _match_keys(batch, keys, collation)
    first = b.groupBy(*bk).agg(F.min(F.struct(*order, *keys, *rest)).alias("__f")) \
             .select(*[F.col("__f")[c].alias(c) for c in keys + order + rest])
    if collation:
        f2, fk = _match_keys(first, keys, collation)
        t2, tk = _match_keys(target.select(*keys), keys, collation)
        t2 = t2.select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(tk)])
        cond = None
        for i, a in enumerate(fk):
            e = F.col(a) == F.col(f"__t{i}")
            cond = e if cond is None else cond & e
        new = f2.join(t2, cond, "left_anti").select(*first.columns)
    else:
        new = first.join(target.select(*keys), keys, "left_anti")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [target, *(d.select(*[c for c in target.columns if c in d.columns]) for d in (new, keyless))])
