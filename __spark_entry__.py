"""

``entry(spark)`` runs the flagship query on sf0.001. ``queries()`` maps each
implemented operator or query to a callable ``(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` gives the same answer as DuckDB SQL over the supplied tables.
Employees are customers and suppliers, positions are orders (see
``tenure.plans.standins``); every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure import schemas as S
from tenure.functions.text import CASE_INSENSITIVE
from tenure.operators.bins import open_binned, store_binned
from tenure.operators.checks import duplicate_keys, length_violations, null_counts
from tenure.plans import queries as Q
from tenure.plans.job import load_dim_employee, run_etl
from tenure.plans.standins import employee_standin, history_standin, oracle_with, read_table
from tenure.session import new_run_folder
from tenure.sinks.export import CSV_OPTIONS
from tenure.sinks.identity import IdentityMark, load_identity
from tenure.sinks.replace import replace_table
from tenure.sources.catalog import copy_tables, tables_named
from tenure.sources.sheets import read_sheet
from tenure.sources.tables import create_tables, register_sheet_table

try:  # the operators for text corpora can be left out as a whole
    from tenure.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("tenure.llm"):
        raise
    text_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed value: the day for point-in-time checks (inside the supplied dates).
AS_OF = "1998-06-15"
# Days and a range of days for the lookups by bins, the rows from
# which an employee counts as hot, and two forms of one key.
DAYS = ["1993-01-01", "1995-12-31", "1998-06-15", "2050-01-01"]
RANGE = ("1997-11-20", "1998-02-10")
HOT_ROWS = 500
FOLDED = ("Stra\u00dfe \u039f\u0394\u039f\u03a3 K", "STRASSE \u03bf\u03b4\u03bf\u03c2 \u212a")


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return employee_standin(spark, sf_dir), history_standin(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the training fact (first position and its days) on sf0.001."""
    emp, hist = _inputs(spark, SMOKE_DIR)
    return Q.training_fact(emp, hist)


def _current_position(spark, sf_dir):
    return Q.current_position(*_inputs(spark, sf_dir), AS_OF)


def _current_position_ci(spark, sf_dir):
    # Keys matched as the source database collation does (case, trailing blanks).
    return Q.current_position(*_inputs(spark, sf_dir), AS_OF, key_mode=CASE_INSENSITIVE)


def _latest_position(spark, sf_dir):
    return Q.latest_position(*_inputs(spark, sf_dir))


def _latest_position_literal(spark, sf_dir):
    return Q.latest_position(*_inputs(spark, sf_dir), literal=True)


def _training_history(spark, sf_dir):
    return Q.training_history(*_inputs(spark, sf_dir))


def _training_history_golden(spark, sf_dir):
    return Q.training_history(*_inputs(spark, sf_dir), golden=True)


def _training_fact(spark, sf_dir):
    return Q.training_fact(*_inputs(spark, sf_dir))


def _training_periods(spark, sf_dir):
    return Q.training_periods(*_inputs(spark, sf_dir))


def _csv_row_index(spark, sf_dir):
    return Q.training_history(*_inputs(spark, sf_dir), row_index=True)


def _dim_employee_text(spark, sf_dir):
    return Q.dim_employee(employee_standin(spark, sf_dir), as_text=True)


def _check_unique(spark, sf_dir):
    # (l_orderkey, l_linenumber) repeats in the supplied lineitem: a failing case.
    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _check_primary_key(spark, sf_dir):
    return duplicate_keys(history_standin(spark, sf_dir), S.PRIMARY_KEYS[S.HISTORY_TABLE])


def _check_not_null(spark, sf_dir):
    emp, hist = _inputs(spark, sf_dir)
    parts = []
    for table, df, schema in ((S.EMPLOYEE_TABLE, emp, S.EMPLOYEE), (S.HISTORY_TABLE, hist, S.POSITION_HISTORY)):
        parts.append(null_counts(df, S.present(S.not_null_columns(schema), df.columns), table))
    return parts[0].unionByName(parts[1])


def _check_length(spark, sf_dir):
    emp, hist = _inputs(spark, sf_dir)
    e = length_violations(emp, S.VARCHAR_LIMITS[S.EMPLOYEE_TABLE], S.EMPLOYEE_TABLE)
    h = length_violations(hist, S.VARCHAR_LIMITS[S.HISTORY_TABLE], S.HISTORY_TABLE)
    return e.unionByName(h)


def _validate_sources(spark, sf_dir):
    return Q.validate_sources(*_inputs(spark, sf_dir))


COPIED_TABLES = ["customer", "orders"]


def _copy_tables(spark, sf_dir):
    """Pick the source tables from the catalog by name, then copy each one."""
    root = new_run_folder(spark, "copies")
    for name in COPIED_TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    names = tables_named(spark, COPIED_TABLES)
    return copy_tables(spark, sorted(names), spark.table, root)


def _own_database(spark, label) -> tuple[str, str]:
    """A folder and a database for this call alone, so runs never touch each other's tables."""
    root = new_run_folder(spark, label)
    database = f"{label}_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return root, database


def _dim_employee_landed(spark, sf_dir):
    """The dimension replaced by one of another layout, verified, and read back through its pointer."""
    root, database = _own_database(spark, "dim")
    table = f"{database}.{S.DIM_EMPLOYEE_TABLE}"
    emp = employee_standin(spark, sf_dir)
    load_dim_employee(emp, root, table=table, as_text=True, pointer=True)
    load_dim_employee(emp, root, table=table, buckets=8, pointer=True, verify=True)
    return spark.table(table)


def _binned_history(spark, sf_dir):
    root, database = _own_database(spark, "bins")
    table = f"{database}.HistoryByDay"
    store_binned(history_standin(spark, sf_dir), table, root)
    return open_binned(spark, table)


def _current_position_binned(spark, sf_dir):
    """The position on one day from a history stored by day bins: one partition is read."""
    binned, bins = _binned_history(spark, sf_dir)
    return Q.positions_held(employee_standin(spark, sf_dir), bins.on(binned, AS_OF))


def _positions_on_days(spark, sf_dir):
    """The positions held on each day of a list, joined by bin."""
    binned, bins = _binned_history(spark, sf_dir)
    days = spark.createDataFrame([(d,) for d in DAYS], "day string")
    return Q.positions_held(employee_standin(spark, sf_dir), bins.on_days(binned, days), extra=["day"])


def _positions_overlapping(spark, sf_dir):
    """Positions that touch a range of days, each once though it lies in several bins."""
    binned, bins = _binned_history(spark, sf_dir)
    return bins.overlapping(binned, *RANGE).select("Id", "EmployeeId", "StartDate", "EndDate")


def _identity_loads(spark, sf_dir):
    """Loads with ids from one mark: those with debts come last, leave, and come again; no id is given twice."""
    root = new_run_folder(spark, "identity")
    mark = IdentityMark(spark, f"{root}/ids")

    def load(people, name):
        with_ids = load_identity(people.select(F.lit(None).cast("bigint").alias("Id"), "FullName", "Debt"), "Id", ["Debt", "FullName"], mark)
        return replace_table(with_ids, name, root, register=False).path_frame(spark)

    customers = read_table(spark, sf_dir, "customer").select(F.col("c_name").alias("FullName"), (-F.col("c_acctbal")).alias("Debt"))
    suppliers = read_table(spark, sf_dir, "supplier").select(F.col("s_name").alias("FullName"), (-F.col("s_acctbal")).alias("Debt"))
    first = load(customers, "first")
    second = load(suppliers, "second")
    again = load(first.filter("Debt > 0"), "again")
    return first.filter("Debt <= 0").unionByName(second).unionByName(again)


def _current_position_folded(spark, sf_dir):
    """Keys that differ only by full case folding and trailing blanks still meet."""
    emp, hist = _inputs(spark, sf_dir)
    emp = emp.withColumn("EmployeeId", F.concat(F.lit(FOLDED[0]), "EmployeeId"))
    hist = hist.withColumn("EmployeeId", F.concat(F.lit(FOLDED[1]), "EmployeeId", F.lit("  ")))
    return Q.current_position(emp, hist, AS_OF, key_mode=CASE_INSENSITIVE)


def _sheet_line_breaks(spark, sf_dir):
    """Employees with addresses of several quoted lines, written as a sheet and read by records."""
    root = new_run_folder(spark, "sheet")
    emp = employee_standin(spark, sf_dir)
    emp = emp.withColumn("Address", F.concat("Address", F.lit(' "north"\n'), "FullName", F.lit(",\n\nend")))
    sheet = replace_table(emp, "employee_sheet", root, fmt="csv", options=CSV_OPTIONS, register=False)
    return read_sheet(spark, sheet.path, emp.schema)


def _typed_insert(spark, sf_dir):
    """Declared tables created and filled; whole numbers given for text columns become text."""
    root, database = _own_database(spark, "typed")
    employee, history = create_tables(spark, database, root)
    read_table(spark, sf_dir, "customer").createOrReplaceTempView("typed_customer")
    read_table(spark, sf_dir, "orders").createOrReplaceTempView("typed_orders")
    spark.sql(f"""INSERT INTO {employee} SELECT cast(c_custkey as int), c_custkey, c_name,
                  date_add(date'1950-01-01', cast(c_custkey % 10000 as int)), c_mktsegment FROM typed_customer""")
    spark.sql(f"""INSERT INTO {history} SELECT cast(o_orderkey as int), cast(o_orderkey % 100 as int), o_orderpriority,
                  cast(o_custkey as int), cast(o_orderdate as date), cast(o_orderdate as date) FROM typed_orders""")
    e, h = spark.table(employee), spark.table(history).drop("Id")
    return e.join(h, "EmployeeId").select("Id", "EmployeeId", "FullName", "BirthDate", "Address", "PosId", "PosTitle", "StartDate", "EndDate")


def _training_fact_text_dates(spark, sf_dir):
    """The fact from a history whose dates come as text."""
    emp, hist = _inputs(spark, sf_dir)
    text = hist.withColumns({c: F.col(c).cast("string") for c in ("StartDate", "EndDate")})
    return Q.training_fact(emp, text)


def _training_history_hot(spark, sf_dir):
    """The wide history with every third order on one employee, whose rows are numbered by ranges."""
    emp, hist = _inputs(spark, sf_dir)
    moved = hist.withColumn("EmployeeId", F.when(F.col("Id") % 3 == 0, F.lit("1")).otherwise(F.col("EmployeeId")))
    return Q.training_history(emp, moved, min_hot_rows=HOT_ROWS)


def _etl(spark, sf_dir):
    """The whole batch job, with the history read through a sheet-backed CSV table
    and landed as parquet once; tables are verified and served through pointers.
    """
    root, database = _own_database(spark, "dwh")
    emp, hist = _inputs(spark, sf_dir)
    sheet = replace_table(hist, "position_history_sheet", root, fmt="csv", options={"header": "true"}, register=False)
    sheet_hist = register_sheet_table(spark, f"{database}.{S.DIM_HISTORY_TABLE}", sheet.path, hist.schema)
    return run_etl(emp, sheet_hist, root, database=database, land_history=True, pointer=True, verify=True)


def _etl_fact_table(spark, sf_dir):
    return spark.table(_etl(spark, sf_dir).fact.table)


HISTORY_CSV_SCHEMA = T.StructType(
    [
        T.StructField("row_index", T.LongType()),
        T.StructField("Id_Employee", T.IntegerType()),
        T.StructField("EmployeeId", T.StringType()),
        T.StructField("FullName", T.StringType()),
        T.StructField("Address", T.StringType()),
        T.StructField("Id_PositionHistory", T.LongType()),
        T.StructField("PosTitle", T.StringType()),
        T.StructField("StartDate", T.DateType()),
        T.StructField("EndDate", T.DateType()),
        T.StructField("training_day_duration", T.IntegerType()),
        T.StructField("rn", T.LongType()),
    ]
)


def _etl_history_csv(spark, sf_dir):
    return _etl(spark, sf_dir).history_csv.path_frame(spark, HISTORY_CSV_SCHEMA)


def _etl_audit(spark, sf_dir):
    return _etl(spark, sf_dir).audit.frame().select("step", "status", "rows")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | (text_queries.queries() if text_queries else {})


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "current_position": _current_position,
        "current_position_ci": _current_position_ci,
        "latest_position": _latest_position,
        "latest_position_literal": _latest_position_literal,
        "training_history": _training_history,
        "training_history_golden": _training_history_golden,
        "training_fact": _training_fact,
        "training_periods": _training_periods,
        "csv_row_index": _csv_row_index,
        "dim_employee_text": _dim_employee_text,
        "check_unique": _check_unique,
        "check_primary_key": _check_primary_key,
        "check_not_null": _check_not_null,
        "check_length": _check_length,
        "validate_sources": _validate_sources,
        "copy_tables": _copy_tables,
        "dim_employee_landed": _dim_employee_landed,
        "current_position_binned": _current_position_binned,
        "positions_on_days": _positions_on_days,
        "positions_overlapping": _positions_overlapping,
        "identity_loads": _identity_loads,
        "current_position_folded": _current_position_folded,
        "sheet_line_breaks": _sheet_line_breaks,
        "typed_insert": _typed_insert,
        "training_fact_text_dates": _training_fact_text_dates,
        "training_history_hot": _training_history_hot,
        "etl_fact_table": _etl_fact_table,
        "etl_history_csv": _etl_history_csv,
        "etl_audit": _etl_audit,
    }


_CURRENT = f"""
select e.EmployeeId, e.FullName, e.Address, h.PosTitle, h.EmployeeId as PhEmployeeId,
       h.StartDate, h.EndDate
from employee e join position_history h on e.EmployeeId = h.EmployeeId
where date '{AS_OF}' between h.StartDate and h.EndDate
"""

_CURRENT_CI = f"""
select e.EmployeeId, e.FullName, e.Address, h.PosTitle, h.EmployeeId as PhEmployeeId,
       h.StartDate, h.EndDate
from employee e join position_history h on lower(rtrim(e.EmployeeId)) = lower(rtrim(h.EmployeeId))
where date '{AS_OF}' between h.StartDate and h.EndDate
"""

_LATEST = """
, ranked as (
  select *, row_number() over (partition by EmployeeId
                               order by StartDate desc nulls last, Id desc) as rn
  from position_history where EmployeeId is not null)
select e.EmployeeId, e.FullName, e.Address, r.PosTitle, r.EmployeeId as PhEmployeeId,
       r.StartDate, r.EndDate
from employee e left join ranked r on e.EmployeeId = r.EmployeeId and r.rn = 1
"""

_LATEST_LITERAL = """
select EmployeeId, FullName, Address, PosTitle, PhEmployeeId, StartDate, EndDate
from (select e.EmployeeId, e.FullName, e.Address, h.PosTitle, h.EmployeeId as PhEmployeeId,
             h.StartDate, h.EndDate,
             row_number() over (partition by h.EmployeeId
                                order by h.StartDate desc nulls last, h.Id desc nulls last,
                                         e.Id asc nulls last, e.EmployeeId asc nulls last) as rn
      from employee e left join position_history h on e.EmployeeId = h.EmployeeId) t
where rn = 1
"""

_NUMBERED = """
, numbered as (
  select Id as Id_PositionHistory, PosTitle, EmployeeId, StartDate, EndDate,
         cast(date_diff('day', StartDate, EndDate) as integer) as training_day_duration,
         cast(row_number() over (partition by EmployeeId
                                 order by StartDate asc nulls last, Id asc) as bigint) as rn
  from position_history where EmployeeId is not null)
"""

_TRAINING_HISTORY = f"""
{_NUMBERED}
select e.Id as Id_Employee, e.EmployeeId, e.FullName, e.Address, n.Id_PositionHistory,
       n.PosTitle, n.StartDate, n.EndDate, n.training_day_duration, n.rn
from employee e left join numbered n on e.EmployeeId = n.EmployeeId
"""

_TRAINING_HISTORY_GOLDEN = f"""
{_NUMBERED}
select e.Id as Id_Employee, e.EmployeeId, e.FullName, e.Address, n.Id_PositionHistory,
       n.PosTitle, n.StartDate, n.EndDate, cast(n.training_day_duration as double) as training_day_duration,
       cast(n.rn as double) as rn
from employee e left join numbered n on e.EmployeeId = n.EmployeeId
"""

_TRAINING_FACT = f"""
{_NUMBERED}
select e.Id as Id_Employee, n.Id_PositionHistory, n.training_day_duration
from employee e join numbered n on e.EmployeeId = n.EmployeeId
where n.rn = 1
"""

_TRAINING_PERIODS = f"""
{_NUMBERED}
select e.EmployeeId, n.StartDate, n.EndDate, n.training_day_duration
from employee e join numbered n on e.EmployeeId = n.EmployeeId
where n.rn = 1
"""


_CSV_ROW_INDEX = f"""
{_NUMBERED}
, wide as (
  select e.Id as Id_Employee, e.EmployeeId, e.FullName, e.Address, n.Id_PositionHistory,
         n.PosTitle, n.StartDate, n.EndDate, n.training_day_duration, n.rn
  from employee e left join numbered n on e.EmployeeId = n.EmployeeId)
select cast(row_number() over (order by Id_Employee asc nulls last, EmployeeId asc nulls last,
                                        rn asc nulls last, Id_PositionHistory asc nulls last) - 1
            as bigint) as row_index, *
from wide
"""

_DIM_EMPLOYEE_TEXT = """
select cast(Id as varchar) as Id, EmployeeId, FullName, Address from employee
"""

_CHECK_UNIQUE = """
select l_orderkey, l_linenumber, count(*) as n_rows
from lineitem group by l_orderkey, l_linenumber
having count(*) > 1 or l_orderkey is null or l_linenumber is null
"""

_CHECK_PRIMARY_KEY = """
select Id, count(*) as n_rows from position_history group by Id
having count(*) > 1 or Id is null
"""

_CHECK_NOT_NULL = """
select 'Employee' as table_name, 'Id' as column_name, cast(count_if(Id is null) as bigint) as null_rows from employee
union all select 'Employee', 'EmployeeId', cast(count_if(EmployeeId is null) as bigint) from employee
union all select 'Employee', 'FullName', cast(count_if(FullName is null) as bigint) from employee
union all select 'PositionHistory', 'Id', cast(count_if(Id is null) as bigint) from position_history
union all select 'PositionHistory', 'PosTitle', cast(count_if(PosTitle is null) as bigint) from position_history
union all select 'PositionHistory', 'EmployeeId', cast(count_if(EmployeeId is null) as bigint) from position_history
union all select 'PositionHistory', 'StartDate', cast(count_if(StartDate is null) as bigint) from position_history
union all select 'PositionHistory', 'EndDate', cast(count_if(EndDate is null) as bigint) from position_history
"""

_CHECK_LENGTH = """
select 'Employee' as table_name, 'EmployeeId' as column_name,
       cast(max(length(EmployeeId)) as integer) as max_length, 10 as length_limit,
       cast(count_if(length(EmployeeId) > 10) as bigint) as too_long from employee
union all select 'Employee', 'FullName', cast(max(length(FullName)) as integer), 100,
       cast(count_if(length(FullName) > 100) as bigint) from employee
union all select 'Employee', 'Address', cast(max(length(Address)) as integer), 500,
       cast(count_if(length(Address) > 500) as bigint) from employee
union all select 'PositionHistory', 'PosTitle', cast(max(length(PosTitle)) as integer), 100,
       cast(count_if(length(PosTitle) > 100) as bigint) from position_history
union all select 'PositionHistory', 'EmployeeId', cast(max(length(EmployeeId)) as integer), 10,
       cast(count_if(length(EmployeeId) > 10) as bigint) from position_history
"""

_VALIDATE_SOURCES = """
select 'Employee' as table_name, 'primary_key' as check_name, 'Id' as column_name,
       cast(count(*) as bigint) as violations
from (select Id from employee group by Id having count(*) > 1 or Id is null)
union all select 'Employee', 'unique', 'EmployeeId', cast(count(*) as bigint)
from (select EmployeeId from employee group by EmployeeId having count(*) > 1)
union all select 'Employee', 'not_null', 'Id', cast(count_if(Id is null) as bigint) from employee
union all select 'Employee', 'not_null', 'EmployeeId', cast(count_if(EmployeeId is null) as bigint) from employee
union all select 'Employee', 'not_null', 'FullName', cast(count_if(FullName is null) as bigint) from employee
union all select 'Employee', 'max_length', 'EmployeeId', cast(count_if(length(EmployeeId) > 10) as bigint) from employee
union all select 'Employee', 'max_length', 'FullName', cast(count_if(length(FullName) > 100) as bigint) from employee
union all select 'Employee', 'max_length', 'Address', cast(count_if(length(Address) > 500) as bigint) from employee
union all select 'PositionHistory', 'primary_key', 'Id', cast(count(*) as bigint)
from (select Id from position_history group by Id having count(*) > 1 or Id is null)
union all select 'PositionHistory', 'not_null', 'Id', cast(count_if(Id is null) as bigint) from position_history
union all select 'PositionHistory', 'not_null', 'PosTitle', cast(count_if(PosTitle is null) as bigint) from position_history
union all select 'PositionHistory', 'not_null', 'EmployeeId', cast(count_if(EmployeeId is null) as bigint) from position_history
union all select 'PositionHistory', 'not_null', 'StartDate', cast(count_if(StartDate is null) as bigint) from position_history
union all select 'PositionHistory', 'not_null', 'EndDate', cast(count_if(EndDate is null) as bigint) from position_history
union all select 'PositionHistory', 'max_length', 'PosTitle', cast(count_if(length(PosTitle) > 100) as bigint) from position_history
union all select 'PositionHistory', 'max_length', 'EmployeeId', cast(count_if(length(EmployeeId) > 10) as bigint)
from position_history
"""



def _oracle_digest(table: str, columns: list[str]) -> str:
    """The content digest of a table, as ``tenure.operators.digest`` defines it."""
    values = " || ".join(f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), 'n')" for c in sorted(columns))
    halves = ", ".join(f"cast('0x' || substr(m, {at}, 15) as bigint) as h{k}" for k, at in ((1, 1), (2, 16)))
    return f"""(select cast(sum(cast(h1 as hugeint)) as varchar) || '-' || cast(bit_xor(h2) as varchar)
                from (select {halves} from (select md5({values}) as m from {table})))"""


_CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

_COPY_TABLES = f"""
select table_name, target, rows_copied,
       cast(sum(rows_copied) over (order by table_name) as bigint) as running_total, digest
from (select 'customer' as table_name, 'src_customer' as target, count(*) as rows_copied,
             {_oracle_digest("customer", _CUSTOMER_COLUMNS)} as digest from customer
      union all select 'orders', 'src_orders', count(*), {_oracle_digest("orders", _ORDER_COLUMNS)} from orders)
"""

_DIM_EMPLOYEE_LANDED = "select * from employee"

_POSITIONS_ON_DAYS = f"""
select d.day, e.EmployeeId, e.FullName, e.Address, h.PosTitle, h.EmployeeId as PhEmployeeId, h.StartDate, h.EndDate
from (select unnest([{", ".join(f"date '{d}'" for d in DAYS)}]) as day) d
join position_history h on d.day between h.StartDate and h.EndDate join employee e on e.EmployeeId = h.EmployeeId
"""

_POSITIONS_OVERLAPPING = f"""
select Id, EmployeeId, StartDate, EndDate from position_history
where StartDate <= EndDate and StartDate <= date '{RANGE[1]}' and EndDate >= date '{RANGE[0]}'
"""

_IDENTITY_LOADS = """
with first_load as (select row_number() over (order by -c_acctbal, c_name) - 1 as Id, c_name as FullName, -c_acctbal as Debt from customer),
second_load as (select row_number() over (order by -s_acctbal, s_name) - 1 + (select count(*) from customer) as Id, s_name as FullName, -s_acctbal as Debt
                from supplier),
again as (select row_number() over (order by Debt, FullName) - 1 + (select count(*) from customer) + (select count(*) from supplier) as Id, FullName, Debt
          from first_load where Debt > 0)
select * from first_load where Debt <= 0 union all select * from second_load union all select * from again
"""

_CURRENT_FOLDED = f"""
select '{FOLDED[0]}' || e.EmployeeId as EmployeeId, e.FullName, e.Address, h.PosTitle,
       '{FOLDED[1]}' || h.EmployeeId || '  ' as PhEmployeeId, h.StartDate, h.EndDate
from employee e join position_history h on e.EmployeeId = h.EmployeeId
where date '{AS_OF}' between h.StartDate and h.EndDate
"""

_SHEET_LINE_BREAKS = """
select Id, EmployeeId, FullName, Address || ' "north"' || chr(10) || FullName || ',' || chr(10) || chr(10) || 'end' as Address
from employee
"""

_TYPED_INSERT = """
select cast(c_custkey as integer) as Id, cast(c_custkey as varchar) as EmployeeId, c_name as FullName,
       cast(date '1950-01-01' + cast(c_custkey % 10000 as integer) as date) as BirthDate, c_mktsegment as Address,
       cast(o_orderkey % 100 as varchar) as PosId, o_orderpriority as PosTitle,
       cast(o_orderdate as date) as StartDate, cast(o_orderdate as date) as EndDate
from customer join orders on c_custkey = o_custkey
"""

_TRAINING_HISTORY_HOT = f"""
, moved as (select Id, PosTitle, case when Id % 3 = 0 then '1' else EmployeeId end as EmployeeId, StartDate, EndDate from position_history)
{_TRAINING_HISTORY.replace("from position_history", "from moved")}
"""

_ETL_AUDIT = f"""
{_NUMBERED}
select 'land_position_history' as step, 'ok' as status, count(*) as "rows" from position_history
union all
select 'load_dim_employee', 'ok', count(*) from employee
union all
select 'write_training_history_csv', 'ok', count(*)
from employee e left join numbered n on e.EmployeeId = n.EmployeeId
union all
select 'load_fact_training_days', 'ok', count(*)
from employee e join numbered n on e.EmployeeId = n.EmployeeId where n.rn = 1
"""


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | (text_queries.oracle_sql() if text_queries else {})


def core_oracle_sql() -> dict[str, str]:
    return {
        "current_position": oracle_with(_CURRENT),
        "current_position_ci": oracle_with(_CURRENT_CI),
        "latest_position": oracle_with(_LATEST),
        "latest_position_literal": oracle_with(_LATEST_LITERAL),
        "training_history": oracle_with(_TRAINING_HISTORY),
        "training_history_golden": oracle_with(_TRAINING_HISTORY_GOLDEN),
        "training_fact": oracle_with(_TRAINING_FACT),
        "training_periods": oracle_with(_TRAINING_PERIODS),
        "csv_row_index": oracle_with(_CSV_ROW_INDEX),
        "dim_employee_text": oracle_with(_DIM_EMPLOYEE_TEXT),
        "check_unique": _CHECK_UNIQUE,
        "check_primary_key": oracle_with(_CHECK_PRIMARY_KEY),
        "check_not_null": oracle_with(_CHECK_NOT_NULL),
        "check_length": oracle_with(_CHECK_LENGTH),
        "validate_sources": oracle_with(_VALIDATE_SOURCES),
        "copy_tables": _COPY_TABLES,
        "dim_employee_landed": oracle_with(_DIM_EMPLOYEE_LANDED),
        "current_position_binned": oracle_with(_CURRENT),
        "positions_on_days": oracle_with(_POSITIONS_ON_DAYS),
        "positions_overlapping": oracle_with(_POSITIONS_OVERLAPPING),
        "identity_loads": _IDENTITY_LOADS,
        "current_position_folded": oracle_with(_CURRENT_FOLDED),
        "sheet_line_breaks": oracle_with(_SHEET_LINE_BREAKS),
        "typed_insert": _TYPED_INSERT,
        "training_fact_text_dates": oracle_with(_TRAINING_FACT),
        "training_history_hot": oracle_with(_TRAINING_HISTORY_HOT),
        "etl_fact_table": oracle_with(_TRAINING_FACT),
        "etl_history_csv": oracle_with(_CSV_ROW_INDEX),
        "etl_audit": oracle_with(_ETL_AUDIT),
    }
