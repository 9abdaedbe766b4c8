"""Replica and table audits (A1, J6, U2, C1, C2, IO10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_compare(copies: dict) -> DataFrame:
    """A1: rows per table per copy (one column per copy) and an in-sync flag.
    ``copies`` is ``{copy: {table: df}}``; each count is a one-row aggregate."""
    names = sorted(copies)
    counts = reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.count(F.lit(1)).alias("rows"))
          .withColumn("copy", F.lit(c)).withColumn("table_name", F.lit(t))
        for c in names for t, df in sorted(copies[c].items())])
    p = counts.groupBy("table_name").pivot("copy", names).agg(F.first("rows"))
    cols = [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in names]
    return p.select("table_name", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"rows_{c}")
                                    for c in names],
                    (F.greatest(*cols) == F.least(*cols) if len(cols) > 1 else F.lit(True))
                    .alias("in_sync"))


def presence(source: DataFrame, nodes: dict, keys) -> DataFrame:
    """For every source key, whether each node holds it.  The key sets of
    all nodes are tagged and unioned, then reduced per key with a partial
    aggregate (one shuffle), then left-joined to the source keys."""
    keys = _keys(keys)
    names = sorted(nodes)
    tagged = reduce(lambda a, b: a.unionByName(b), [
        nodes[n].select(*keys).withColumn("__node", F.lit(i)) for i, n in enumerate(names)])
    held = tagged.groupBy(*keys).agg(*[
        F.max((F.col("__node") == i).cast("int")).alias(f"__on{i}") for i in range(len(names))])
    src = source.select(*keys).distinct()
    for k in keys:
        held = held.withColumnRenamed(k, f"__k_{k}")
    j = src.join(held, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]), "left")
    flags = [F.coalesce(F.col(f"__on{i}") == 1, F.lit(False)) for i in range(len(names))]
    return j.select(*keys, *[f.alias(f"on_{n}") for f, n in zip(flags, names)],
                    reduce(lambda a, b: a & b, flags).alias("all_present"))


BITS = 32768            # keys covered by one bitmap


def key_bitmaps(copies: dict, key: str) -> DataFrame:
    """Per bucket of :data:`BITS` consecutive integer keys one bitmap per copy (column of
    the copy's name): what is shuffled is at most 4 KiB a bucket, copy and task, not the keys.
    Rows with a NULL key are counted in a bucket NULL, whose bitmap has bit 0 set."""
    k = F.col("__k")
    tagged = reduce(lambda a, b: a.unionByName(b), [
        df.select(F.col(key).cast("long").alias("__k"), F.lit(i).alias("__copy"))
        for i, (_, df) in enumerate(sorted(copies.items()))])
    at = F.coalesce(F.bitmap_bit_position(k), F.lit(0).cast("long"))
    return tagged.groupBy(F.bitmap_bucket_number(k).alias("bucket")).agg(*[
        F.bitmap_construct_agg(F.when(F.col("__copy") == i, at)).alias(n)
        for i, n in enumerate(sorted(copies))])


def _bit(bitmap: Column, at: Column) -> Column:
    """Whether bit ``at`` of a bitmap is set."""
    byte = F.ascii(F.decode(F.substring(bitmap, F.shiftright(at, 3) + 1, F.lit(1)), "ISO-8859-1"))
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), at.bitwiseAND(F.lit(7)) + 1)) != 0


def presence_bitmaps(source: DataFrame, nodes: dict, key: str) -> DataFrame:
    """J6 for one dense integer key: the same rows as :func:`presence`, from bitmaps. The copies
    meet as one bitmap a bucket; keys come into being again only as result rows.
    For keys that are sparse in their range (fewer than some 500 in 32,768) or not
    integers :func:`presence` is the better form."""
    names = sorted(nodes)
    if source.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"bitmaps need an integer key, {key} is {source.schema[key].dataType.simpleString()}")
    maps = key_bitmaps({"s": source, **{f"n{i}": nodes[n] for i, n in enumerate(names)}}, key)
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: _bit(F.col("s"), i)))
    held = maps.withColumn("__at", bit)
    # buckets count from 1 for positive keys, and downwards from 0 for the others
    value = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * BITS + F.col("__at") + 1) \
             .otherwise(F.col("bucket") * BITS - F.col("__at"))
    flags = [_bit(F.col(f"n{i}"), F.col("__at")) for i in range(len(names))]
    return held.select(value.cast(source.schema[key].dataType).alias(key),
                       *[f.alias(f"on_{n}") for f, n in zip(flags, names)],
                       reduce(lambda a, b: a & b, flags).alias("all_present"))


def missing(source: DataFrame, node: DataFrame, keys) -> DataFrame:
    """Source keys absent from one node.  NULL keys match each other, as in :func:`presence`."""
    keys = _keys(keys)
    held = node.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return source.select(*keys).join(held, same, "left_anti")


def row_digest(cols: list[str]) -> Column:
    """Two independent 64/32-bit hashes of the listed columns.  Spark's hashes
    skip NULL values, so ``(NULL, 'x')`` and ``('x', NULL)`` would hash alike;
    a NULL bitmap is hashed along with the values to tell them apart."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    vals = [F.col(c) for c in cols] + [nulls]
    return F.struct(F.xxhash64(*vals).alias("h1"), F.hash(*vals).alias("h2"))


def diff(src: DataFrame, dst: DataFrame, keys, compare: list[str] | None = None,
         exact: bool = True) -> DataFrame:
    """Keys only in the source, only in the replica, or with changed
    content.  Columns are compared with NULL-safe equality, keys too, so a row
    with a NULL key meets its counterpart.  ``exact=False`` shuffles only the
    keys and a 96-bit digest of the other columns, which may miss a change."""
    keys = _keys(keys)
    compare = compare or [c for c in src.columns if c not in keys]
    if exact or not compare:
        a = src.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in compare]).withColumn("__a", F.lit(1))
        b = dst.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in compare]).withColumn("__b", F.lit(1))
        same = reduce(lambda x, y: x & y,
                      [F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}")) for c in compare], F.lit(True))
    else:
        a = src.select(*keys, row_digest(compare).alias("__da")).withColumn("__a", F.lit(1))
        b = dst.select(*keys, row_digest(compare).alias("__db")).withColumn("__b", F.lit(1))
        same = F.col("__da") == F.col("__db")
    for k in keys:
        b = b.withColumnRenamed(k, f"__k_{k}")
    j = a.join(b, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]), "full")
    j = j.select(*[F.coalesce(k, f"__k_{k}").alias(k) for k in keys],
                 *[c for c in j.columns if c not in keys and not c.startswith("__k_")])
    status = (F.when(F.col("__b").isNull(), F.lit("only_source"))
               .when(F.col("__a").isNull(), F.lit("only_replica"))
               .when(~same, F.lit("changed")))
    return j.select(*keys, status.alias("status")).where(F.col("status").isNotNull())


RANGE_BITS = 12         # a range of the digest tree's leaves spans 2**12 keys
_INTEGERS = ("byte", "short", "integer", "long")


def range_digests(df: DataFrame, key: str, bits: int = RANGE_BITS, columns: list[str] | None = None) -> DataFrame:
    """Per range of ``2**bits`` integer keys (``bucket = key >> bits``) the rows and four
    sums of hash halves, 128 bits in all, over the key and the columns.  Sums
    add up, so the digest of a wider range is the sum of its parts: a table of digests stored beside
    a copy is the leaf level of a digest tree, and :func:`coarser` gives any level above.
    Rows with a NULL key form the bucket NULL."""
    if df.schema[key].dataType.typeName() not in _INTEGERS:
        raise ValueError(f"key ranges need an integer key, {key} is {df.schema[key].dataType.simpleString()}")
    cols = [key] + sorted(c for c in (columns or df.columns) if c != key)
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    low = F.lit(0xFFFFFFFF)
    hashed = df.select(F.shiftright(F.col(key).cast("long"), bits).alias("bucket"),
                       *[F.xxhash64(F.lit(seed), *[F.col(c) for c in cols], nulls).alias(f"h{seed}") for seed in (1, 2)])
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(half).alias(f"d{seed}{name}") for seed in (1, 2)
          for name, half in (("l", F.col(f"h{seed}").bitwiseAND(low)),
                             ("h", F.shiftrightunsigned(F.col(f"h{seed}"), 32)))])


def coarser(digests: DataFrame, levels: int) -> DataFrame:
    """The digests of ranges ``2**levels`` times as wide."""
    sums = [c for c in digests.columns if c != "bucket"]
    return (digests.withColumn("bucket", F.shiftright("bucket", levels)).groupBy("bucket")
            .agg(*[F.sum(c).alias(c) for c in sums]))


def differing_ranges(src: DataFrame, dst: DataFrame) -> DataFrame:
    """The buckets whose digests differ, with both row counts (0: no row there)."""
    sums = [c for c in src.columns if c != "bucket"]
    b = dst.select(*[F.col(c).alias(f"__{c}") for c in dst.columns])
    j = src.join(b, F.col("bucket").eqNullSafe(F.col("__bucket")), "full")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in sums])
    return j.where(~same).select(F.coalesce("bucket", "__bucket").alias("bucket"),
                                 F.coalesce("rows", F.lit(0)).alias("rows_source"),
                                 F.coalesce("__rows", F.lit(0)).alias("rows_replica"))


def in_ranges(key: str, ranges: DataFrame, bits: int, most: int = 128) -> Column:
    """A filter on ``key`` that holds for every listed range.  With over ``most`` ranges the
    tree is climbed until that many are left: the filter gets wider, never
    narrower.  It consists of plain comparisons, so it reaches the files' statistics."""
    level = 0
    while True:
        at = ranges.select(F.shiftright("bucket", level).alias("b")).distinct().limit(most + 2).collect()
        if sum(r.b is not None for r in at) <= most:
            break
        level += 3
    width = 1 << (bits + level)
    spans: list[list[int]] = []
    for b in sorted(r.b for r in at if r.b is not None):
        if spans and spans[-1][1] == b * width - 1:
            spans[-1][1] = (b + 1) * width - 1
        else:
            spans.append([b * width, (b + 1) * width - 1])
    tests = [F.col(key).between(F.lit(lo), F.lit(hi)) for lo, hi in spans]
    if any(r.b is None for r in at):
        tests.append(F.col(key).isNull())
    return reduce(lambda x, y: x | y, tests, F.lit(False))


def diff_in_ranges(src: DataFrame, dst: DataFrame, key: str, compare: list[str] | None = None,
                   bits: int = RANGE_BITS, src_digests: DataFrame | None = None,
                   dst_digests: DataFrame | None = None) -> DataFrame:
    """:func:`diff` for copies that differ in few places.  Digests per key range (stored
    ones, if given, which saves reading the copy) say which ranges differ, and only these are read and
    compared exactly; a change goes unseen only if all 128 bits of its range's digest agree."""
    from ..session import checkpoint_dir
    checkpoint_dir(src.sparkSession)
    columns = [key, *(compare or [c for c in src.columns if c != key])]
    a, b = (given if given is not None else range_digests(df, key, bits, columns)
            for df, given in ((src, src_digests), (dst, dst_digests)))
    ranges = differing_ranges(a, b).select("bucket").checkpoint()
    near = in_ranges(key, ranges, bits)
    return diff(src.where(near), dst.where(near), key, compare)


def diff_summary(d: DataFrame) -> DataFrame:
    return d.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


# --------------------------------------------------------------------------
# status and configuration tables
# --------------------------------------------------------------------------

# The status variables that describe a healthy multi-writer node.
HEALTH_VARS = ["wsrep_cluster_size", "wsrep_cluster_status", "wsrep_connected", "wsrep_ready"]


def node_health(status: DataFrame, expected_size: int, nodes: list[str] | None = None) -> DataFrame:
    """With ``nodes`` every listed node has a row per snapshot, unhealthy
    where it reported nothing; of repeated values the largest counts.  Status pairs pivoted to one row per (node, snapshot); healthy iff
    size as expected, status Primary, connected ON and ready ON; ``cluster_agrees``
    is false when the nodes of one snapshot report different cluster status."""
    p = (status.where(F.col("variable_name").isin(HEALTH_VARS))
               .groupBy("node", "snapshot_ts").pivot("variable_name", HEALTH_VARS)
               .agg(F.max("variable_value")))
    if nodes:
        listed = status.select("snapshot_ts").distinct().withColumn(
            "node", F.explode(F.array(*[F.lit(n) for n in nodes])))
        p = listed.join(p, ["node", "snapshot_ts"], "left")
    healthy = (F.coalesce(F.col("wsrep_cluster_size").try_cast("int") == expected_size, F.lit(False))
               & F.coalesce(F.col("wsrep_cluster_status") == "Primary", F.lit(False))
               & F.coalesce(F.upper("wsrep_connected") == "ON", F.lit(False))
               & F.coalesce(F.upper("wsrep_ready") == "ON", F.lit(False)))
    per_snap = p.groupBy("snapshot_ts").agg(
        F.count_distinct(F.coalesce("wsrep_cluster_status", F.lit("?"))).alias("n_status"))
    return (p.withColumn("healthy", healthy)
             .join(per_snap, "snapshot_ts")
             .withColumn("cluster_agrees", F.col("n_status") == 1).drop("n_status"))


def config_diff(instances: dict) -> DataFrame:
    """Variables added / removed / changed between instances.  The first
    instance (sorted by name) is the base; numeric values get a ratio."""
    names = sorted(instances)
    if len(names) < 2:
        raise ValueError("config_diff needs at least two instances")
    base = names[0]
    long = reduce(lambda a, b: a.unionByName(b), [
        instances[n].select("variable_name", F.col("variable_value").cast("string").alias("value"))
                    .withColumn("instance", F.lit(n)) for n in names])
    # one row per variable with a column per instance, then one row per
    # (variable, other instance) by exploding a fixed-size array
    p = long.groupBy("variable_name").pivot("instance", names).agg(F.max("value"))
    pairs = F.array(*[F.struct(F.lit(n).alias("instance"), F.col(f"`{n}`").alias("value"))
                      for n in names[1:]])
    j = (p.select("variable_name", F.col(f"`{base}`").alias("base_value"), F.explode(pairs).alias("o"))
          .select("o.instance", "variable_name", "base_value", "o.value"))
    status = (F.when(F.col("base_value").isNull() & F.col("value").isNull(), F.lit(None))
               .when(F.col("base_value").isNull(), F.lit("added"))
               .when(F.col("value").isNull(), F.lit("removed"))
               .when(F.col("base_value") != F.col("value"), F.lit("changed")))
    ratio = F.try_divide(F.col("value").try_cast("double"), F.col("base_value").try_cast("double"))
    return (j.select("instance", "variable_name", "base_value", "value",
                     status.alias("status"), F.round(ratio, 4).alias("ratio"))
             .where(F.col("status").isNotNull()))


def table_inventory(tables: dict) -> DataFrame:
    """IO10: rows and on-disk bytes per table, largest first.  Bytes are the
    sum over the distinct files the scan reads (``_metadata``)."""
    parts = []
    for name, df in sorted(tables.items()):
        files = df.select(F.col("_metadata.file_path").alias("f"),
                          F.col("_metadata.file_size").alias("s"))
        per_file = files.groupBy("f").agg(F.max("s").alias("s"), F.count(F.lit(1)).alias("n"))
        parts.append(per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                                  F.coalesce(F.sum("s"), F.lit(0)).alias("bytes"),
                                  F.count(F.lit(1)).alias("files"))
                     .withColumn("table_name", F.lit(name)))
    return (reduce(lambda a, b: a.unionByName(b), parts).select("table_name", "rows", "bytes", "files")
            .orderBy(F.col("bytes").desc(), F.col("table_name")))
