"""Relational database extracts over JDBC.

Connection details come from the caller or from Spark conf
(``tenure.jdbc.url``, ``tenure.jdbc.user``, ``tenure.jdbc.password``); none are
kept in code. A table with a numeric key is read by ``numPartitions`` parallel
range queries on that key instead of one connection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    spark: SparkSession,
    *,
    table: str | None = None,
    query: str | None = None,
    url: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a whole table (``dbtable``) or a caller's SQL (``query``)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    url = url or spark.conf.get("tenure.jdbc.url", None)
    if not url:
        raise ValueError("no JDBC url: pass url= or set tenure.jdbc.url")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    user = user or spark.conf.get("tenure.jdbc.user", None)
    password = password or spark.conf.get("tenure.jdbc.password", None)
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    if partition_column is not None:
        if query is not None:
            raise ValueError("partitioned reads need a table, not a query")
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    opts.update(extra or {})
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """Extract a table or query (see ``jdbc_options``)."""
    return spark.read.format("jdbc").options(**jdbc_options(spark, **kwargs)).load()


def read_jdbc_partitioned(
    spark: SparkSession,
    table: str,
    column: str,
    num_partitions: int,
    **conn,
) -> DataFrame:
    """Read ``table`` in ``num_partitions`` parallel range queries on ``column``.

    The key's bounds come from one aggregate query run by the database (a
    single row comes back); rows outside the bounds would still be read,
    since Spark's first and last ranges are open-ended. An empty table is
    read with one query.
    """
    bounds = read_jdbc(
        spark, query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}", **conn
    ).first()
    if bounds is None or bounds["lo"] is None:
        return read_jdbc(spark, table=table, **conn)
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    return read_jdbc(
        spark,
        table=table,
        partition_column=column,
        lower_bound=lo,
        upper_bound=hi + 1,
        num_partitions=max(1, min(num_partitions, hi - lo + 1)),
        **conn,
    )
