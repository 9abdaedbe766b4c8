"""The operators under the names of the blueprint's inventory:
``from shardcraft.api import io, shard, audit, ...``.  Each name refers to
the implementation in ``operators``, ``functions``, ``sources`` or
``streaming``; nothing here adds behaviour."""

from __future__ import annotations

from types import SimpleNamespace

from .functions import filters as _filters
from .functions import generate as _generate
from .functions import text as _text
from .operators import aggregates as _agg
from .operators import audit as _audit
from .operators import joins as _joins
from .operators import metrics as _metrics
from .operators import mutate as _mutate
from .operators import shard as _shard
from .operators import topk as _topk
from .operators import windows as _windows
from .sources import io as _io
from .sources import jdbc as _jdbc
from .sources import sqlapi as _sqlapi
from .sources import validate as _validate
from .streaming import changes as _changes
from .streaming import monitors as _monitors

io = SimpleNamespace(
    read_shards=_shard.read_shards,            # IO1
    read_jdbc=_jdbc.read_jdbc,                 # IO2
    write_jdbc=_jdbc.write_jdbc,               # IO2
    append=_io.append,                         # IO3
    insert_ignore=_mutate.insert_ignore,       # IO4
    snapshot_copy=_io.snapshot_copy,           # IO6
    validate=_validate.validate,               # IO8
    compact=_io.compact,                       # IO9
)
generate = SimpleNamespace(
    numbers=_generate.numbers, users=_generate.people, accounts=_generate.accounts,
    sales=_generate.sales, wide=_generate.wide, update_rows=_generate.update_rows,
    ledger=_generate.ledger)                   # G1-G5
filters = SimpleNamespace(
    key_range=_filters.key_range, date_band=_filters.date_band, recent=_filters.recent,
    multi_filter=_filters.multi_filter, like_ci=_filters.like_ci,
    mod_sample=_filters.mod_sample)            # F2-F7
joins = SimpleNamespace(
    user_orders=_joins.user_orders, order_details=_joins.order_details,
    customer_spend=_joins.customer_spend, cross_shard=_shard.cross_shard_join)   # J1-J4
audit = SimpleNamespace(
    orphans=_joins.orphans, presence=_audit.presence, presence_bitmaps=_audit.presence_bitmaps,
    missing=_audit.missing, count_compare=_audit.count_compare, diff=_audit.diff,
    diff_summary=_audit.diff_summary, range_digests=_audit.range_digests, coarser=_audit.coarser,
    differing_ranges=_audit.differing_ranges, diff_in_ranges=_audit.diff_in_ranges,
    node_health=_audit.node_health, config_diff=_audit.config_diff,
    table_inventory=_audit.table_inventory)    # J5, J6, A1, U2, C1, C2, IO10
aggregates = SimpleNamespace(
    top_users=_agg.top_users, status_summary=_agg.status_summary,
    status_summary_by_order=_agg.status_summary_by_order, json_avg=_agg.json_avg,
    ledger_summary=_agg.ledger_summary, text_profile=_agg.text_profile,
    distribution=_agg.distribution, stats=_agg.stats, stats_diff=_agg.stats_diff)   # A2-A9
text = SimpleNamespace(relevance=_text.relevance, relevance_by_group=_text.relevance_by_group)  # A13
metrics = SimpleNamespace(
    throughput=_metrics.throughput, compare_runs=_metrics.compare_runs,
    error_rate=_metrics.error_rate, counter_deltas=_windows.counter_deltas,
    hit_ratio=_windows.hit_ratio, write_runs=_metrics.write_runs,
    read_status_pairs=_metrics.read_status_pairs,
    read_runs=_metrics.read_runs)              # A14-A16, W4, IO5
windows = SimpleNamespace(
    ledger_balance=_windows.ledger_balance, latest_per_key=_windows.latest_per_key,
    last_n=_windows.last_n)                    # W1-W3
topk = SimpleNamespace(by=_topk.by, latest=_topk.latest)   # K1-K3
mutate = SimpleNamespace(
    update=_mutate.update, update_limit=_mutate.update_limit, update_batches=_mutate.update_batches,
    json_set=_mutate.json_set, upsert=_mutate.upsert, expire=_mutate.expire,
    delete=_mutate.delete, stamp=_mutate.stamp)   # M1-M8
shard = SimpleNamespace(
    lookup=_shard.lookup, key_range=_shard.key_range, assign=_shard.assign, write=_shard.write,
    route_log=_shard.route_log, route_summary=_shard.route_summary, audit=_shard.audit,
    balance=_shard.balance, aggregate=_shard.aggregate, ordered=_shard.ordered,
    union_guarded=_shard.union_guarded, equal_ranges=_shard.equal_ranges)   # F1, S1-S3, A10-A12, K4, U1
stream = SimpleNamespace(
    read_changes=_changes.read_changes, init_target=_changes.init_target,
    apply_changes=_changes.apply_changes, apply_batch=_changes.apply_batch,
    read_target=_changes.read_target, purge_tombstones=_changes.purge_tombstones,
    replication_lag=_monitors.replication_lag, sync_monitor=_monitors.sync_monitor,
    service_metrics=_monitors.service_metrics, alerts=_monitors.alerts,
    slow_queries=_monitors.slow_queries, lag_summary=_monitors.lag_summary)   # IO7, T1-T6
sqlapi = SimpleNamespace(run_query=_sqlapi.run_query, register_views=_sqlapi.register_views,
                         register_lab_views=_sqlapi.register_lab_views)   # IO11
