"""Change-log source (IO7) and change apply into a replica table.

The replica table is a parquet table in buckets (a hash of the key).  It
keeps, per key, the log position ``_pos`` of the last applied change and a
``_deleted`` tombstone, which makes apply idempotent: a change is applied only
if its position is greater than the stored one, so replaying a micro-batch
(after a failure, or a duplicated file) changes nothing.

Files are never replaced.  ``state/v=<n>/bucket=<b>`` holds the buckets that
commit ``n`` rewrote, and ``_commits/v=<n>`` is one small file that says, for
every bucket with rows, which version is current.  Each micro-batch:
1. the batch is persisted and the touched buckets are found,
2. these are read through the newest commit and folded with the changes in one pass,
3. the merged buckets are written as a new version,
4. the commit file is written last; it is one file, renamed into place.

A driver lost before step 4 leaves an unreferenced version, which the retry
overwrites; the table still reads as before.  A batch id found in a commit since
the table was initialised is skipped.  One writer at a time is assumed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..operators import windows
from ..operators.runs import RUN, dealt, in_runs

CHANGE_SCHEMA = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("commit_ts", T.TimestampNTZType()),
    T.StructField("op", T.StringType()),
    T.StructField("tbl", T.StringType()),
    T.StructField("pk", T.LongType()),
    T.StructField("row", T.StringType()),
])

DEFAULT_BUCKETS = 64
FILES_PER_BUCKET = 4


def read_changes(spark: SparkSession, path: str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """IO7: a streaming DataFrame of row changes (``pos, commit_ts, op, tbl, pk, row``)."""
    r = spark.readStream.format(fmt).schema(CHANGE_SCHEMA)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def bucket_of(key_col: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key_col)), F.lit(buckets)).cast("int")


def _by_bucket_files(df: DataFrame, key: str, files_per_bucket: int) -> DataFrame:
    """Rows grouped so that each bucket directory receives at most
    ``files_per_bucket`` files (without it every write task would put a small
    file into every bucket it touches).  Keys are unique in the table, so the
    groups are balanced."""
    return df.repartition(F.col("bucket"), F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(files_per_bucket)))


COMMIT_SCHEMA = ("seq long, base long, batch_id long, buckets int, skipped long, "
                 "bucket int, version long, table_schema string, table_buckets int")


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    """All commits, None before the first.  Other read errors surface."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true") \
                    .parquet(f"{path}/_commits")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _current(spark: SparkSession, path: str) -> list:
    """Rows of the newest commit: one per non-empty bucket (or one with a NULL
    bucket), so their number is bounded by the table's bucket count."""
    c = _commits(spark, path)
    if c is None:
        return []
    newest = c.select(F.max("seq").alias("seq")).first().seq
    return [] if newest is None else c.where(F.col("seq") == newest).collect()


def _read_buckets(spark: SparkSession, path: str, commit: list, buckets=None) -> DataFrame:
    """The listed buckets (all by default) as the commit names them."""
    schema = T.StructType.fromJson(json.loads(commit[0].table_schema))
    wanted = None if buckets is None else set(buckets)
    dirs = [f"{path}/state/v={r.version}/bucket={r.bucket}" for r in commit
            if r.bucket is not None and (wanted is None or r.bucket in wanted)]
    if not dirs:
        return spark.createDataFrame([], schema)
    full = T.StructType(schema.fields + [T.StructField("v", T.LongType())])
    return spark.read.schema(full).option("basePath", f"{path}/state").parquet(*dirs).select(*schema.names)


def _commit(spark: SparkSession, path: str, df: DataFrame, key: str, rewritten, previous: list,
            base: int | None, batch_id: int | None, skipped: int, files_per_bucket: int,
            table_buckets: int) -> None:
    """Write ``df`` as the new version of the ``rewritten`` buckets (None: the
    whole table), then the commit file, which keeps the table's bucket count."""
    seq = previous[0].seq + 1 if previous else 0
    out = f"{path}/state/v={seq}"
    _by_bucket_files(df, key, files_per_bucket).write.mode("overwrite").partitionBy("bucket").parquet(out)
    schema = T.StructType([f for f in df.schema.fields if f.name != "bucket"]
                          + [T.StructField("bucket", T.IntegerType())])
    # a bucket with no row left has no directory and is left out of the commit
    filled = [r.bucket for r in spark.read.schema(schema).parquet(out).select("bucket").distinct().collect()]
    touched = set(filled) if rewritten is None else set(rewritten)
    kept = [] if rewritten is None else [(r.bucket, r.version) for r in previous
                                         if r.bucket is not None and r.bucket not in touched]
    current = kept + [(b, seq) for b in filled] or [(None, None)]
    head = (seq, seq if base is None else base, batch_id, len(touched), int(skipped))
    spark.createDataFrame([(*head, b, v, schema.json(), table_buckets) for b, v in current], COMMIT_SCHEMA) \
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/_commits/v={seq}")


def init_target(df: DataFrame, path: str, key: str = "pk", buckets: int = DEFAULT_BUCKETS,
                pos: int = -1, files_per_bucket: int = FILES_PER_BUCKET) -> None:
    """Write the initial replica table (a snapshot taken at log position
    ``pos``).  On an existing table it replaces every row and starts a new
    count of batch ids; the bucket count may change."""
    if buckets <= 0:
        raise ValueError("bucket count must be positive")
    t = (df.withColumn("_pos", F.lit(pos).cast("long"))
           .withColumn("_deleted", F.lit(False))
           .withColumn("bucket", bucket_of(key, buckets)))
    _commit(df.sparkSession, path, t, key, None, _current(df.sparkSession, path),
            None, None, 0, files_per_bucket, buckets)


def read_target(spark: SparkSession, path: str, with_meta: bool = False) -> DataFrame:
    commit = _current(spark, path)
    if not commit:
        raise ValueError(f"no replica table at {path}")
    df = _read_buckets(spark, path, commit)
    if with_meta:
        return df
    return df.where(~F.col("_deleted")).drop("_deleted", "bucket")


def applied_batches(spark: SparkSession, path: str) -> DataFrame:
    """The batch log since the table was initialised: ``batch_id``, rewritten
    ``buckets`` and ``skipped`` duplicate inserts."""
    base = _current(spark, path)[0].base
    return (_commits(spark, path).where((F.col("base") == base) & F.col("batch_id").isNotNull())
            .select("batch_id", "buckets", "skipped").distinct())


def effective_changes(changes: DataFrame, target: DataFrame | None, key: str = "pk",
                      on_duplicate: str = "skip", payload: str = "row",
                      count_skips: bool = False) -> DataFrame:
    """The last effective change per key, among changes newer than the
    target's ``_pos``.  With ``on_duplicate='skip'`` an insert on a key that
    exists just before it is not effective (the replica keeps its row, as a
    replica that skips duplicate-key errors does) and is counted in
    ``skipped``.  Existence before a change follows from the previous change
    of the key (anything but a delete leaves the key present) or, for the
    first new change, from the target.  ``count_skips`` adds the number of
    skipped duplicate inserts per key (one more aggregate and join)."""
    c = changes.select(F.col(key), "pos", "op", F.col(payload))
    if target is not None:
        t = target.select(F.col(key), F.col("_pos").alias("__tpos"),
                          (~F.col("_deleted")).alias("__texists"))
        c = c.join(t, key, "left").where(F.col("pos") > F.coalesce(F.col("__tpos"), F.lit(-(1 << 62))))
    else:
        c = c.withColumn("__texists", F.lit(False))
    if on_duplicate == "skip" and not count_skips:
        return _last_effective_skip(c, key, payload)
    if on_duplicate == "skip":
        c = windows.balanced_lag(c, key, "pos", "op", "__prev_op")
        existed = F.when(F.col("__prev_op").isNull(), F.coalesce(F.col("__texists"), F.lit(False))) \
                   .otherwise(F.col("__prev_op") != "D")
        c = c.withColumn("__effective", ~((F.col("op") == "I") & existed))
    elif on_duplicate == "upsert":
        c = c.withColumn("__effective", F.lit(True))
    else:
        raise ValueError(on_duplicate)
    latest = windows.latest_per_key(
        c.where("__effective").select(key, "pos", "op", payload), key, "pos")
    if not count_skips:
        return latest
    skipped = c.where(~F.col("__effective")).groupBy(key).agg(F.count(F.lit(1)).alias("skipped"))
    return latest.join(skipped, key, "full").select(
        key, "pos", "op", payload, F.coalesce("skipped", F.lit(0)).alias("skipped"))


SALTS = 16
_NEG = -(1 << 62)


def _last_effective_skip(c: DataFrame, key: str, payload: str) -> DataFrame:
    """Last effective change per key under the skip policy, without ordering
    the changes of a key.  An insert is skipped exactly when the key exists
    just before it, so: if the last update/delete is an update, it is the
    answer (later inserts are duplicates); if it is a delete, the first
    insert after it wins, else the delete; with no update or delete, the
    first insert wins unless the target already holds the key.  Two partial
    aggregates and one join; the join of the inserts with the per-key
    threshold is salted, so one key with very many inserts is spread over
    ``SALTS`` tasks (the per-key table is replicated ``SALTS`` times)."""
    agg1 = c.groupBy(key).agg(
        F.max(F.when(F.col("op") != "I", F.struct("pos", "op", payload))).alias("__x"),
        F.max(F.coalesce(F.col("__texists"), F.lit(False))).alias("__tex"))
    need = (agg1.where(F.col("__x").isNull() | (F.col("__x.op") == "D"))
                .select(key, F.coalesce(F.col("__x.pos"), F.lit(_NEG)).alias("__after"))
                .withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    ins = (c.where(F.col("op") == "I").select(key, "pos", payload)
            .withColumn("__s", F.pmod(F.xxhash64("pos"), F.lit(SALTS)).cast("int")))
    first = (ins.join(need, [key, "__s"]).where(F.col("pos") > F.col("__after"))
                .groupBy(key).agg(F.min(F.struct("pos", payload)).alias("__f")))
    j = agg1.join(first, key, "left")
    x, f, tex = F.col("__x"), F.col("__f"), F.col("__tex")
    is_u = x.isNotNull() & (x["op"] == "U")
    is_d = x.isNotNull() & (x["op"] == "D")
    pos = F.when(is_u, x["pos"]).when(is_d, F.coalesce(f["pos"], x["pos"])).when(~tex, f["pos"])
    op = (F.when(is_u, F.lit("U"))
           .when(is_d, F.when(f.isNotNull(), F.lit("I")).otherwise(F.lit("D")))
           .when(~tex & f.isNotNull(), F.lit("I")))
    row = (F.when(is_u, x[payload]).when(is_d & f.isNotNull(), f[payload])
            .when(x.isNull() & ~tex, f[payload]))
    return j.select(key, pos.alias("pos"), op.alias("op"), row.alias(payload)) \
            .where(F.col("pos").isNotNull())


def merge(target: DataFrame, eff: DataFrame, key: str = "pk", payload: str = "row") -> DataFrame:
    """Target rows updated by the effective changes (tombstones for deletes)."""
    e = eff.where(F.col("pos").isNotNull()).select(
        key, F.col("pos").alias("__pos"), F.col("op").alias("__op"), F.col(payload).alias("__row"))
    j = target.join(e, key, "full")
    hit = F.col("__pos").isNotNull()
    return j.select(
        key,
        F.when(hit & (F.col("__op") == "D"), F.lit(None).cast("string"))
         .when(hit, F.col("__row")).otherwise(F.col(payload)).alias(payload),
        F.when(hit, F.col("__pos")).otherwise(F.col("_pos")).alias("_pos"),
        F.when(hit, F.col("__op") == "D").otherwise(F.col("_deleted")).alias("_deleted"))


def fold_changes(target: DataFrame, changes: DataFrame, key: str = "pk", on_duplicate: str = "skip",
                 payload: str = "row", runs: int | None = None) -> DataFrame:
    """The target after the changes (key, payload, ``_pos``, ``_deleted``), in one pass over both.

    The target's row is one more event of its key, at its ``_pos`` and after the changes
    up to there, which it replaces.  What a stretch of a key's events does is
    told by its last event that is no insert and the first insert after that, and two
    stretches in a row fold into one: the later last event counts, else the earlier first
    insert.  The events are exchanged once, into balanced runs of (key, position), so a key with
    very many changes is spread; one summary for each run and key is exchanged by key."""
    if on_duplicate not in ("skip", "upsert"):
        raise ValueError(on_duplicate)
    c = changes.select(key, (F.col("pos") * 2).alias("__at"), "pos", "op", payload)
    if on_duplicate == "upsert":
        c = c.withColumn("op", F.when(F.col("op") == "I", F.lit("U")).otherwise(F.col("op")))
    held = F.when(F.col("_deleted"), F.lit("gone")).otherwise(F.lit("kept"))
    t = target.select(key, (F.col("_pos") * 2 + 1).alias("__at"), F.col("_pos").alias("pos"), held.alias("op"), payload)
    event = F.struct("__at", "op", "pos", payload)
    insert = F.col("op") == "I"
    in_run = Window.partitionBy(RUN, key)
    d = dealt(in_runs(c.unionAll(t), [key], "__at", runs), runs).withColumn(
        "__last", F.max(F.when(~insert, event)).over(in_run))
    after = insert & (F.col("__last").isNull() | (F.col("__at") > F.col("__last.__at")))
    parts = d.groupBy(RUN, key).agg(F.max("__last").alias("last"), F.min(F.when(after, event)).alias("first"))
    none = F.lit(None).cast(parts.schema["last"].dataType)
    folded = parts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(RUN, "last", "first"))).alias("parts")).select(
        key, F.aggregate("parts", F.struct(none.alias("last"), none.alias("first")), lambda have, part: F.struct(
            F.coalesce(part["last"], have["last"]).alias("last"),
            F.when(part["last"].isNotNull(), part["first"]).otherwise(F.coalesce(have["first"], part["first"])).alias("first"),
        )).alias("s"))           # at most one part for each run
    last, first = F.col("s.last"), F.col("s.first")
    absent = last.isNull() | last["op"].isin("D", "gone")
    wins = F.when(absent & first.isNotNull(), first).otherwise(last)
    return folded.select(key, wins.alias("w")).select(
        key, F.when(F.col("w.op") != "D", F.col(f"w.{payload}")).alias(payload), F.col("w.pos").alias("_pos"),
        F.col("w.op").isin("D", "gone").alias("_deleted"))


def apply_batch(batch: DataFrame, batch_id: int, path: str, key: str = "pk",
                on_duplicate: str = "skip", buckets: int = DEFAULT_BUCKETS,
                count_skips: bool = False, start_pos: int | None = None) -> dict:
    """T1 micro-batch: apply one batch of changes to the table at ``path``.
    ``count_skips`` records in the batch's commit how many inserts were
    skipped as duplicates (drift that a skipping replica would hide); it
    costs one more aggregation over the batch.  ``start_pos`` is the log
    position of the snapshot the table was initialised from: changes at or
    before it are already in the snapshot and are ignored, also for keys it
    does not hold.  The table's own bucket count holds; ``buckets`` is only asked for
    tables whose commits don't name one."""
    spark = batch.sparkSession
    commit = _current(spark, path)
    if not commit:
        raise ValueError(f"no replica table at {path}")
    base = commit[0].base
    buckets = commit[0].table_buckets or buckets     # as the table was made, whatever the caller says
    if _commits(spark, path).where((F.col("base") == base) & (F.col("batch_id") == batch_id)).limit(1).count():
        return {"batch_id": batch_id, "skipped_batch": True}
    if start_pos is not None:
        batch = batch.where(F.col("pos") > F.lit(start_pos))
    b = batch.withColumn("bucket", bucket_of(key, buckets)).persist()
    try:
        touched = [r[0] for r in b.select("bucket").distinct().collect()]   # at most `buckets` values
        state = _read_buckets(spark, path, commit, touched)
        skipped = 0
        if touched and count_skips and on_duplicate == "skip":
            skipped = effective_changes(b, state, key, on_duplicate, count_skips=True) \
                .agg(F.coalesce(F.sum("skipped"), F.lit(0))).first()[0]
        merged = fold_changes(state, b, key, on_duplicate).withColumn("bucket", bucket_of(key, buckets))
        _commit(spark, path, merged, key, touched, commit, base, batch_id, skipped, FILES_PER_BUCKET, buckets)
    finally:
        b.unpersist()
    return {"batch_id": batch_id, "buckets": len(touched), "skipped": int(skipped)}


def apply_changes(changes: DataFrame, target_path: str, checkpoint: str, key: str = "pk",
                  on_duplicate: str = "skip", buckets: int = DEFAULT_BUCKETS,
                  trigger: dict | None = None, count_skips: bool = False,
                  start_pos: int | None = None):
    """Start the streaming apply; returns the ``StreamingQuery``."""
    def run(df, batch_id):
        apply_batch(df, batch_id, target_path, key, on_duplicate, buckets,
                    count_skips=count_skips, start_pos=start_pos)
    w = changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def purge_tombstones(spark: SparkSession, path: str, before_pos: int, key: str = "pk") -> int:
    """Compaction of the replica table: drop delete tombstones whose position
    is older than ``before_pos``.  Tombstones let a late change for a deleted
    key be recognised as stale; past the horizon that protection is given up.
    Only buckets holding such tombstones are rewritten; one that keeps no row
    leaves the table.  Returns the number of buckets rewritten."""
    commit = _current(spark, path)
    if not commit:
        raise ValueError(f"no replica table at {path}")
    state = _read_buckets(spark, path, commit)
    old = (F.col("_deleted") & (F.col("_pos") < F.lit(before_pos)))
    buckets = [r[0] for r in state.where(old).select("bucket").distinct().collect()]  # bounded by bucket count
    if not buckets:
        return 0
    kept = _read_buckets(spark, path, commit, buckets).where(~old)
    _commit(spark, path, kept, key, buckets, commit, commit[0].base, None, 0, FILES_PER_BUCKET,
            commit[0].table_buckets or DEFAULT_BUCKETS)
    return len(buckets)
