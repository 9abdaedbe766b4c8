"""Range sharding as table jobs (S1-S3, A10-A12, U1, K4, F1, J4, IO1).

Shard ranges and routing rules are configuration.  They become ``CASE WHEN``
blocks of fixed width folded with ``coalesce`` (no join, no shuffle), so one
plan serves any number of them and no generated method grows with it.
"""

from __future__ import annotations

from dataclasses import dataclass
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runs import lower_slot

CASE_WIDTH = 64     # branches per CASE block


@dataclass(frozen=True)
class ShardRange:
    shard_id: int
    lo: int
    hi: int

    @property
    def name(self) -> str:
        return f"shard{self.shard_id}"


def equal_ranges(n: int, k: int = 3, start: int = 1) -> list[ShardRange]:
    """``k`` inclusive ranges of ``n // k`` keys starting at ``start``; the last
    range ends at ``start + n - 1``."""
    width = n // k
    out = []
    for i in range(k):
        lo = start + i * width
        hi = start + (i + 1) * width - 1 if i < k - 1 else start + n - 1
        out.append(ShardRange(i + 1, lo, hi))
    return out


def _check(ranges) -> list[ShardRange]:
    ranges = sorted(ranges, key=lambda r: (r.lo, r.hi))
    if not ranges:
        raise ValueError("no shard range")
    for a, b in zip(ranges, ranges[1:]):
        if b.lo <= a.hi:
            raise ValueError(f"ranges of {a.name} and {b.name} overlap")
    return ranges


def first_match(branches) -> Column:
    """The value of the first branch ``(condition, value)`` that holds, else
    NULL: one CASE per ``CASE_WIDTH`` branches, folded with coalesce.  Values
    must not be NULL, or a later block would be asked."""
    blocks = []
    for i, (cond, value) in enumerate(branches):
        if i % CASE_WIDTH:
            blocks[-1] = blocks[-1].when(cond, value)
        else:
            blocks.append(F.when(cond, value))
    return blocks[0] if len(blocks) == 1 else F.coalesce(*blocks)


def _longs(values) -> Column:
    """A constant array, folded by the optimizer from one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def shard_of(key: Column | str, ranges) -> Column:
    """The shard id whose inclusive range holds ``key``; NULL if none does.  A few ranges
    are a CASE; more are found by binary search in their sorted bounds, so that neither the plan nor
    the work per row grows with their number."""
    k = F.col(key) if isinstance(key, str) else key
    ranges = _check(ranges)
    if len(ranges) <= CASE_WIDTH:
        return first_match((k.between(F.lit(r.lo), F.lit(r.hi)), F.lit(r.shard_id)) for r in ranges)
    at = lower_slot(k, _longs(r.lo for r in ranges), len(ranges)) - 1
    return F.when(k <= F.get(_longs(r.hi for r in ranges), at),
                  F.get(_longs(r.shard_id for r in ranges), at)).cast("int")


def assign(df: DataFrame, key: str, ranges, on_miss: str = "quarantine",
           shard_col: str = "shard_id"):
    """Add ``shard_col``.  ``on_miss``: ``"quarantine"`` returns
    ``(assigned, rejected)``; ``"error"`` fails the job on the first key that
    no range holds; ``"keep"`` keeps such rows with a NULL shard."""
    s = shard_of(key, ranges)
    if on_miss == "error":
        s = F.coalesce(s, F.raise_error(F.concat(
            F.lit("key outside every shard range: "), F.col(key).cast("string"))).cast("int"))
        return df.withColumn(shard_col, s)
    tagged = df.withColumn(shard_col, s)
    if on_miss == "keep":
        return tagged
    if on_miss != "quarantine":
        raise ValueError(on_miss)
    return tagged.where(F.col(shard_col).isNotNull()), \
        tagged.where(F.col(shard_col).isNull()).withColumn(
            "reason", F.lit("key outside every shard range"))


def lookup(df: DataFrame, key: str, value, ranges=None, shard_col: str = "shard_id") -> DataFrame:
    """``key = value``; on shard-partitioned data also ``shard_col = f(value)``
    so that only one shard directory is listed and read."""
    cond = F.col(key) == F.lit(value)
    if ranges is not None and shard_col in df.columns:
        sid = next((r.shard_id for r in _check(ranges) if r.lo <= value <= r.hi), None)
        cond = cond & (F.col(shard_col) == F.lit(sid)) if sid is not None else F.lit(False)
    return df.where(cond)


def key_range(df: DataFrame, key: str, lo, hi, ranges=None, shard_col: str = "shard_id") -> DataFrame:
    """F2 on sharded data: the range predicate plus the shards it can touch."""
    cond = F.col(key).between(F.lit(lo), F.lit(hi))
    if ranges is not None and shard_col in df.columns:
        ids = [r.shard_id for r in _check(ranges) if r.lo <= hi and lo <= r.hi]
        cond = cond & F.col(shard_col).isin(ids)
    return df.where(cond)


def write(df: DataFrame, path: str, key: str, ranges, mode: str = "overwrite",
          shard_col: str = "shard_id", files_per_shard: int | None = None) -> DataFrame:
    """One directory per shard, every row in exactly one.  Keys outside all
    ranges fail the job.  By default there is no shuffle: each task writes its
    rows into the shard directories, sorted by shard and key so that one file
    is open at a time and files carry tight min/max statistics for the key
    (right for a few shards: each task's file per shard is large).  With many
    shards, ``files_per_shard`` groups rows by (shard, key hash) first, which
    bounds the files per shard directory; a hot shard is still written by
    ``files_per_shard`` tasks, not one."""
    tagged = assign(df, key, ranges, on_miss="error", shard_col=shard_col)
    if files_per_shard:
        tagged = tagged.repartition(F.col(shard_col),
                                    F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_shard)))
    (tagged.sortWithinPartitions(shard_col, key)
           .write.mode(mode).partitionBy(shard_col).parquet(path))
    return tagged


def read_shards(spark: SparkSession, shards: dict, fmt: str = "parquet",
                shard_col: str = "shard_id", name_col: str = "shard_name") -> DataFrame:
    """IO1: physical shards of one table read as one logical table.
    ``shards`` maps shard id to a path (or a DataFrame, e.g. a JDBC read).
    All shards must have the same schema."""
    parts = []
    schema = None
    for sid, src in sorted(shards.items()):
        d = src if isinstance(src, DataFrame) else spark.read.format(fmt).load(src)
        if schema is None:
            schema = d.schema
        elif [(f.name, f.dataType) for f in d.schema] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"shard {sid} schema {d.schema.simpleString()} differs from "
                             f"{schema.simpleString()}")
        parts.append(d.withColumn(shard_col, F.lit(sid)).withColumn(name_col, F.lit(f"shard{sid}")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_guarded(shards: dict, ranges, key: str, shard_col: str = "shard_id") -> DataFrame:
    """Tagged UNION ALL in which each shard contributes only rows inside its
    declared range.  A later ``key = const`` folds all other branches away."""
    by_id = {r.shard_id: r for r in _check(ranges)}
    parts = [d.where(F.col(key).between(F.lit(by_id[s].lo), F.lit(by_id[s].hi)))
              .withColumn(shard_col, F.lit(s))
             for s, d in sorted(shards.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)


def ranges_df(spark: SparkSession, ranges) -> DataFrame:
    rows = [(r.shard_id, r.name, r.lo, r.hi) for r in _check(ranges)]
    return spark.createDataFrame(rows, "shard_id int, shard_name string, range_lo long, range_hi long")


def audit(df: DataFrame, key: str, ranges, shard_col: str = "shard_id") -> DataFrame:
    """A10: rows, min and max key per shard, ``ok`` when the shard is declared,
    non-empty and its keys lie inside the declared range.  Rows in an undeclared
    shard, or in none, form a row without a name and range, not ``ok``."""
    spark = df.sparkSession
    g = df.groupBy(shard_col).agg(F.count(F.lit(1)).alias("rows"),
                                  F.min(key).alias("min_key"), F.max(key).alias("max_key"))
    r = ranges_df(spark, ranges).withColumnRenamed("shard_id", "__declared")
    j = r.join(g, F.col("__declared") == F.col(shard_col), "full")     # both sides have a row per shard
    return j.select(
        F.coalesce("__declared", shard_col).alias(shard_col), "shard_name", "range_lo", "range_hi",
        F.coalesce(F.col("rows"), F.lit(0)).alias("rows"), "min_key", "max_key",
        ((F.coalesce(F.col("rows"), F.lit(0)) > 0) & F.coalesce(
            (F.col("min_key") >= F.col("range_lo")) & (F.col("max_key") <= F.col("range_hi")),
            F.lit(False))).alias("ok"))


def balance(tables: dict, shard_ids: list, shard_col: str = "shard_id",
            weight_col: str = "rows_weight") -> DataFrame:
    """Rows per shard per table, share of the table, and the table's
    max/mean skew over the declared ``shard_ids`` (an empty one counts as 0
    rows; rows without a shard are reported but don't enter the skew).  A table given with a ``weight_col`` column is taken as
    pre-counted rows (e.g. line items counted per order before the join that
    finds their shard).  The per-table totals are computed on the already
    aggregated (tables x shards) rows."""
    def _count(d):
        if weight_col in d.columns:
            return F.sum(weight_col).cast("long").alias("rows")
        return F.count(F.lit(1)).alias("rows")
    counts = reduce(lambda a, b: a.unionByName(b), [
        d.groupBy(shard_col).agg(_count(d)).withColumn("table_name", F.lit(t))
        for t, d in sorted(tables.items())])
    from .aggregates import ratio_fixed
    spark = counts.sparkSession
    declared = spark.createDataFrame([(t, s, 0) for t in sorted(tables) for s in shard_ids],
                                     f"table_name string, {shard_col} int, rows long")
    counts = counts.unionByName(declared).groupBy("table_name", shard_col).agg(F.sum("rows").alias("rows"))
    placed = F.col(shard_col).isNotNull()
    per_table = counts.groupBy("table_name").agg(
        F.sum("rows").alias("table_rows"), F.sum(F.when(placed, F.col("rows"))).alias("placed_rows"),
        F.max(F.when(placed, F.col("rows"))).alias("max_rows"))
    return (counts.join(per_table, "table_name")
            .select("table_name", shard_col, "rows",
                    ratio_fixed(F.col("rows") * 100, "table_rows", 4).alias("share_pct"),
                    # max / mean = max * shards / total
                    ratio_fixed(F.col("max_rows") * F.lit(len(shard_ids)), "placed_rows", 4).alias("skew")))


def aggregate(df: DataFrame, group, aggs) -> DataFrame:
    """A cross-shard aggregate is an ordinary aggregate over the logical
    table; Spark's partial/final aggregation is the per-shard/merge split."""
    group = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*group).agg(*aggs)


@dataclass(frozen=True)
class States:
    """What a shard stores of its rows, so that an aggregate over all shards needs
    the shards' states only.  Per column: ``sums`` (exact decimal sum and count of values), ``bounds`` (least and
    greatest value), ``distinct`` (a HyperLogLog sketch; for exact distinct counts
    use :func:`aggregate` over the rows) and ``quantiles`` (a KLL sketch of doubles)."""
    group: tuple[str, ...]
    sums: tuple[str, ...] = ()
    bounds: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()
    quantiles: tuple[str, ...] = ()

    def of(self, df: DataFrame) -> DataFrame:
        """One row per group: the states of ``df``'s rows.  Sums of doubles depend on
        the order of addition; give them as decimals."""
        aggs = [F.count(F.lit(1)).alias("rows")]
        for c in self.sums:
            aggs += [F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
        for c in self.bounds:
            aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
        aggs += [F.hll_sketch_agg(c).alias(f"{c}_hll") for c in self.distinct]
        aggs += [F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"{c}_kll") for c in self.quantiles]
        return df.groupBy(*self.group).agg(*aggs)

    def merged(self, states: DataFrame) -> DataFrame:
        """The states of all shards' rows from the states of each."""
        aggs = [F.sum("rows").alias("rows")]
        for c in self.sums:
            kind = states.schema[f"{c}_sum"].dataType
            aggs += [F.sum(f"{c}_sum").cast(kind).alias(f"{c}_sum"), F.sum(f"{c}_n").alias(f"{c}_n")]
        for c in self.bounds:
            aggs += [F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max")]
        aggs += [F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in self.distinct]
        aggs += [F.kll_merge_agg_double(f"{c}_kll").alias(f"{c}_kll") for c in self.quantiles]
        return states.groupBy(*self.group).agg(*aggs)

    def results(self, states: DataFrame, at: tuple[float, ...] = (0.5,)) -> DataFrame:
        """Sums, counts, averages, bounds, estimated distinct counts and quantiles (array, at ``at``)."""
        cols = [F.col(c) for c in self.group] + [F.col("rows")]
        for c in self.sums:
            cols += [F.col(f"{c}_sum"), F.col(f"{c}_n"),
                     (F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0))).alias(f"{c}_avg")]
        for c in self.bounds:
            cols += [F.col(f"{c}_min"), F.col(f"{c}_max")]
        cols += [F.hll_sketch_estimate(f"{c}_hll").alias(f"{c}_distinct") for c in self.distinct]
        cols += [F.when(F.kll_sketch_get_n_double(f"{c}_kll") > 0, F.kll_sketch_get_quantile_double(
            f"{c}_kll", F.array(*[F.lit(float(q)) for q in at]))).alias(f"{c}_quantiles") for c in self.quantiles]
        return states.select(*cols)


def write_states(shards: dict, path: str, states: States, shard_col: str = "shard_id") -> None:
    """The states of every shard under ``path/shard_id=<id>``; a shard whose rows
    changed is written again alone, the others' states stay."""
    for sid, df in sorted(shards.items()):
        states.of(df).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{shard_col}={sid}")


def read_states(spark: SparkSession, path: str, states: States) -> DataFrame:
    """The merged states of all shards written under ``path``."""
    return states.merged(spark.read.parquet(path))


def ordered(df: DataFrame, key: str) -> DataFrame:
    """K4: globally ordered union (range-partitioned sort)."""
    return df.orderBy(F.col(key).asc_nulls_last(), F.col("shard_id").asc_nulls_last())


def cross_shard_join(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None,
                     shard_col: str = "shard_id", how: str = "inner") -> DataFrame:
    """Join on the global key ``(shard, local id)``; local ids repeat
    across shards, so the shard column is part of every join key."""
    rk = right_key or key
    cond = (left[shard_col] == right[shard_col]) & (left[key] == right[rk])
    joined = left.join(right, cond, how)
    if how not in ("full", "right", "outer", "fullouter", "full_outer", "rightouter", "right_outer"):
        return joined.drop(right[shard_col])
    both = F.coalesce(left[shard_col], right[shard_col])      # right-only rows keep their shard
    return (joined.withColumn("__shard", both).drop(left[shard_col]).drop(right[shard_col])
            .withColumnRenamed("__shard", shard_col))


# --------------------------------------------------------------------------
# S3: query-log routing
# --------------------------------------------------------------------------

def capture_groups(pattern: str) -> int:
    """How many capture groups a (Java) pattern has, named ones included; brackets in
    character classes, escapes and quoted parts don't count."""
    n, i, depth = 0, 0, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two == r"\Q":
            end = pattern.find(r"\E", i + 2)
            i = len(pattern) if end < 0 else end + 2
            continue
        if two[0] == "\\":
            i += 2
            continue
        if two[0] == "[":
            depth += 1
        elif two[0] == "]" and depth:
            depth -= 1
        elif two[0] == "(" and not depth:
            n += two != "(?" or bool(re.match(r"\(\?<[A-Za-z]", pattern[i:]))
        i += 1
    return n


def _capture(st, pat: str):
    """The first capture group, NULL for a rule without one."""
    return F.regexp_extract(st, pat, 1) if capture_groups(pat) else F.lit(None).cast("string")


def _can_start(first_kw, rule) -> Column:
    """False where the statement's first keyword rules the pattern out without
    running it: a pattern ``^WORD...`` with neither alternatives nor a
    quantifier on the word needs that word in front."""
    m = re.match(r"\^([A-Za-z]+)(?![A-Za-z?*{])", rule.match_pattern)
    if not m or "|" in rule.match_pattern:
        return F.lit(True)
    return first_kw.startswith(m.group(1).upper())


READ_KEYWORDS = ("SELECT", "SHOW", "DESCRIBE", "EXPLAIN")


@dataclass(frozen=True)
class Rule:
    rule_id: int
    match_pattern: str
    destination_hostgroup: int
    apply: int = 1
    active: int = 1
    caseless: bool = True


def _rules(rules) -> list[Rule]:
    if isinstance(rules, DataFrame):
        optional = [c for c in ("apply", "active", "caseless") if c in rules.columns]
        rules = [Rule(r["rule_id"], r["match_pattern"], r["destination_hostgroup"],
                      **{c: r[c] for c in optional if r[c] is not None})
                 for r in rules.collect()]          # configuration rows, not data
    return sorted((r for r in rules if r.active), key=lambda r: r.rule_id)


def route_log(log: DataFrame, rules, ranges, statement: str = "statement",
              hostgroup_shard: dict | None = None) -> DataFrame:
    """S3: per logged statement: read/write class by its first keyword, the
    statement type, the first rule (lowest ``rule_id``) whose pattern matches,
    that rule's hostgroup and captured id, the shard the id belongs to, and
    whether the rule sends it there."""
    rules = _rules(rules)
    # a rule whose pattern repeats an earlier (lower rule_id) rule's pattern can
    # never be the first match, so it is left out of the CASE chain
    seen, first_of_pattern = set(), []
    for r in rules:
        if (r.match_pattern, r.caseless) not in seen:
            seen.add((r.match_pattern, r.caseless))
            first_of_pattern.append(r)
    rules = first_of_pattern
    st = F.col(statement)
    first_kw = F.upper(F.regexp_extract(st, r"^\s*([A-Za-z]+)", 1))
    pats = [("(?i)" if r.caseless else "") + r.match_pattern for r in rules]
    # the index of the first matching rule is found once per statement; the
    # rule's id and hostgroup are then looked up by index, and only that
    # rule's pattern is run again to capture the id
    if not rules:     # no active rule: nothing matches
        out = log.withColumn("__ri", F.lit(None).cast("int"))
        rid, hg, cap = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("string")
    else:
        out = log.withColumn("__ri", first_match((_can_start(first_kw, r) & st.rlike(pat), F.lit(i))
                                                 for i, (r, pat) in enumerate(zip(rules, pats))))
        ri = F.col("__ri")                    # integer comparisons; one capture regex per row
        rid = first_match((ri == i, F.lit(r.rule_id)) for i, r in enumerate(rules))
        hg = first_match((ri == i, F.lit(r.destination_hostgroup)) for i, r in enumerate(rules))
        cap = first_match((ri == i, _capture(st, pat)) for i, pat in enumerate(pats))
    key = F.nullif(cap, F.lit("")).try_cast("bigint")
    hgs = hostgroup_shard or {}
    rule_shard = None
    for h, s_ in sorted(hgs.items()):
        cond = F.col("hostgroup") == h
        rule_shard = F.when(cond, F.lit(s_)) if rule_shard is None else rule_shard.when(cond, F.lit(s_))
    out = (out.withColumn("stmt_type", first_kw)
              .withColumn("kind", F.when(first_kw.isin(*READ_KEYWORDS), F.lit("read"))
                                   .otherwise(F.lit("write")))
              .withColumn("rule_id", rid)
              .withColumn("hostgroup", hg)
              .withColumn("routed_key", key)
              .withColumn("intended_shard", shard_of(F.col("routed_key"), ranges))
              .drop("__ri"))
    if rule_shard is not None:
        out = (out.withColumn("rule_shard", rule_shard)
                  .withColumn("misrouted", ~F.coalesce(F.col("rule_shard") == F.col("intended_shard"),
                                                       F.lit(False))))
    return out


def route_summary(routed: DataFrame) -> DataFrame:
    """S3: statements per type, rule target and intended shard."""
    cols = ["stmt_type", "kind", "hostgroup", "intended_shard"]
    aggs = [F.count(F.lit(1)).alias("statements")]
    if "misrouted" in routed.columns:
        aggs.append(F.sum(F.col("misrouted").cast("int")).cast("bigint").alias("misrouted"))
    return routed.groupBy(*cols).agg(*aggs)


# The sharding lab's routing rules (rule id, pattern, hostgroup)
# and its hostgroup-to-shard map.  Patterns are matched case-insensitively.
LAB_RULES = [
    Rule(1, r"^SELECT.*WHERE.*id\s*=\s*(\d+)", 10),
    Rule(2, r"^SELECT.*WHERE.*id\s*=\s*(\d+)", 20),
    Rule(3, r"^SELECT.*WHERE.*id\s*=\s*(\d+)", 30),
    Rule(4, r"^INSERT.*VALUES.*\((\d+)", 10),
    Rule(5, r"^INSERT.*VALUES.*\((\d+)", 20),
    Rule(6, r"^INSERT.*VALUES.*\((\d+)", 30),
    Rule(7, r"^UPDATE.*WHERE.*id\s*=\s*(\d+)", 10),
    Rule(8, r"^UPDATE.*WHERE.*id\s*=\s*(\d+)", 20),
    Rule(9, r"^UPDATE.*WHERE.*id\s*=\s*(\d+)", 30),
    Rule(10, r"^DELETE.*WHERE.*id\s*=\s*(\d+)", 10),
    Rule(11, r"^DELETE.*WHERE.*id\s*=\s*(\d+)", 20),
    Rule(12, r"^DELETE.*WHERE.*id\s*=\s*(\d+)", 30),
]
LAB_HOSTGROUP_SHARD = {10: 1, 20: 2, 30: 3}

# The cluster lab's routing rules (rule id, pattern, hostgroup).
CLUSTER_RULES = [
    Rule(1, r"^SELECT .* FOR UPDATE", 10),
    Rule(2, r"^SELECT", 10),
    Rule(3, r"^INSERT", 10),
    Rule(4, r"^UPDATE", 10),
    Rule(5, r"^DELETE", 10),
]
