"""Connector option builders.

No JDBC driver or catalog jar ships with this build, so these return the
option dictionaries a user passes to ``spark.read.format("jdbc")`` or to
the session builder; they are tested as dictionaries.
"""

from __future__ import annotations


def jdbc_options(url: str, table: str, user: str | None = None,
                 password: str | None = None, *, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 batch_size: int = 10_000, driver: str | None = None) -> dict[str, str]:
    """Options for a parallel JDBC read/write.

    ``table`` may be a sub-query in parentheses with an alias, which pushes
    a key filter to the database.  A partition column with bounds splits the
    read into ``num_partitions`` range queries instead of one task.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size),
            "batchsize": str(batch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def catalog_conf(name: str, catalog_class: str, *, host: str, port: int,
                 user: str | None = None, password: str | None = None,
                 database: str = "default", protocol: str = "http",
                 extra: dict[str, str] | None = None) -> dict[str, str]:
    """``spark.sql.catalog.<name>.*`` settings for a V2 catalog."""
    p = f"spark.sql.catalog.{name}"
    conf = {p: catalog_class, f"{p}.host": host, f"{p}.port": str(port),
            f"{p}.protocol": protocol, f"{p}.database": database}
    if user is not None:
        conf[f"{p}.user"] = user
    if password is not None:
        conf[f"{p}.password"] = password
    for k, v in (extra or {}).items():
        conf[f"{p}.{k}"] = v
    return conf
