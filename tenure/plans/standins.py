"""Employee and position history derived from the supplied TPC-H-style tables.

The supplied test tables carry no HR data, so customers and suppliers stand in
for employees and orders for positions: a position starts on the order date
and ends on the last ship date of its lines. Suppliers place no orders: they
are the employees without history. The same mapping is given as
SQL for the DuckDB oracle. Both are derived from whole tables, so the work
grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMPLOYEE_SQL = """
select cast(c_custkey as int) as Id, cast(c_custkey as varchar) as EmployeeId,
       c_name as FullName, c_mktsegment as Address
from customer
union all
select cast(-s_suppkey as int), concat('S', cast(s_suppkey as varchar)), s_name, cast(s_nationkey as varchar)
from supplier
"""

HISTORY_SQL = """
select o_orderkey as Id, o_orderpriority as PosTitle,
       cast(o_custkey as varchar) as EmployeeId,
       cast(o_orderdate as date) as StartDate, cast(s.EndTs as date) as EndDate
from orders left join (select l_orderkey, max(l_shipdate) as EndTs
                       from lineitem group by l_orderkey) s
  on o_orderkey = l_orderkey
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def employee_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    s = read_table(spark, sf_dir, "supplier")
    customers = c.select(
        F.col("c_custkey").cast("int").alias("Id"),
        F.col("c_custkey").cast("string").alias("EmployeeId"),
        F.col("c_name").alias("FullName"),
        F.col("c_mktsegment").alias("Address"),
    )
    suppliers = s.select(
        (-F.col("s_suppkey")).cast("int").alias("Id"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("EmployeeId"),
        F.col("s_name").alias("FullName"),
        F.col("s_nationkey").cast("string").alias("Address"),
    )
    return customers.unionAll(suppliers)


def history_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as positions; end = last ship date of the order's lines.

    The line aggregate runs with a partial step per task; the join to orders
    is on the aggregate's grouping key, so the aggregate side is not
    shuffled again.
    """
    orders = read_table(spark, sf_dir, "orders")
    ends = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("EndTs"))
    )
    joined = orders.join(ends, orders["o_orderkey"] == ends["l_orderkey"], "left")
    return joined.select(
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderpriority").alias("PosTitle"),
        F.col("o_custkey").cast("string").alias("EmployeeId"),
        F.col("o_orderdate").cast("date").alias("StartDate"),
        F.col("EndTs").cast("date").alias("EndDate"),
    )


def oracle_with(body: str) -> str:
    """Prefix SQL ``body`` with the two stand-ins as named subqueries."""
    return f"with employee as ({EMPLOYEE_SQL}), position_history as ({HISTORY_SQL})\n{body}"
