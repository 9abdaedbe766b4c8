"""shardcraft: DataFrame jobs for sharded and replicated relational data."""

__version__ = "0.1.0"
