"""Every operator and model as a named query over the given tables, with the SQL it must equal."""

from stratum.registry.oracle import oracle_sql
from stratum.registry.spark_queries import entry, queries

__all__ = ["entry", "oracle_sql", "queries"]
