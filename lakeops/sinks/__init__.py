"""Sinks: CSV/Parquet writes, catalog tables, per-group reports, SQL scripts."""

from lakeops.sinks.writers import (  # noqa: F401
    write_csv, write_parquet, write_partitioned, create_table, drop_table,
    append, overwrite_table, set_table_location, split_statements, run_sql_script,
)
