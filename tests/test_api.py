"""Every operator of the inventory is reachable under its blueprint name."""

from shardcraft import api

INVENTORY = {
    "io": ["read_shards", "read_jdbc", "write_jdbc", "append", "insert_ignore", "snapshot_copy",
           "validate", "compact"],
    "generate": ["numbers", "users", "sales", "wide", "update_rows", "ledger"],
    "filters": ["key_range", "date_band", "recent", "like_ci", "mod_sample"],
    "joins": ["user_orders", "order_details", "customer_spend", "cross_shard"],
    "audit": ["orphans", "presence", "count_compare", "diff", "node_health", "config_diff",
              "table_inventory"],
    "aggregates": ["top_users", "status_summary", "json_avg", "ledger_summary", "text_profile",
                   "distribution", "stats", "stats_diff"],
    "text": ["relevance", "relevance_by_group"],
    "metrics": ["throughput", "compare_runs", "error_rate", "counter_deltas", "write_runs", "read_runs"],
    "windows": ["ledger_balance", "latest_per_key", "last_n"],
    "topk": ["by", "latest"],
    "mutate": ["update", "update_limit", "update_batches", "json_set", "upsert", "expire", "delete", "stamp"],
    "shard": ["lookup", "assign", "write", "route_log", "route_summary", "audit", "balance", "aggregate",
              "ordered", "union_guarded"],
    "stream": ["read_changes", "apply_changes", "replication_lag", "sync_monitor", "service_metrics",
               "alerts", "slow_queries"],
    "sqlapi": ["run_query"],
}


def test_inventory_names_resolve():
    for ns, names in INVENTORY.items():
        space = getattr(api, ns)
        for n in names:
            assert callable(getattr(space, n)), f"{ns}.{n}"


def test_session_profiles_name_real_sql_settings(spark):
    """A misspelt key would be silently ignored; Spark only reports a known
    SQL setting as modifiable at runtime."""
    from shardcraft.session import CLUSTER_DEFAULTS, LARGE_CLUSTER
    for key in list(CLUSTER_DEFAULTS) + list(LARGE_CLUSTER):
        if key.startswith("spark.sql."):
            assert spark.conf.isModifiable(key), key
