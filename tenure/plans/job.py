"""The batch job: dimension, wide history CSV, training fact, with an audit row per step.

Order and failure rules:

1. the employee extract is written as the dimension (staged full replace),
   and, as an independent job running at the same time, the wide training
   history is written as CSV with a row index;
2. only when both have succeeded is the training fact written (staged full
   replace).

Any step that fails is recorded as failed and the run raises, so a run never
ends "successful" with a new dimension beside an old fact unnoticed, and a
failure is never turned into an empty table. Each step is one Spark job;
row counts are observed during the writes.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tenure.functions.text import EXACT, stringify
from tenure.plans.queries import dim_employee, training_fact, training_history, validate_sources
from tenure.schemas import DIM_EMPLOYEE_TABLE, FACT_TABLE, KEY
from tenure.session import scratch_scope
from tenure.sinks.audit import Audit
from tenure.sinks.export import export_csv
from tenure.sinks.replace import Written, new_run_id, replace_table, verify_landed

# Fixed value: the name of the exported wide history, as users of the job expect it.
HISTORY_CSV = "historical_training_data"
RAW_HISTORY_TABLE = "RawPositionHistory"


@dataclass
class EtlRun:
    run_id: str
    dim: Written
    history_csv: Written
    fact: Written
    audit: Audit


def load_dim_employee(
    employee: DataFrame,
    root: str,
    *,
    as_text: bool = False,
    run_id: str | None = None,
    table: str = DIM_EMPLOYEE_TABLE,
    buckets: int | None = None,
    pointer: bool = False,
    verify: bool = False,
) -> Written:
    """Replace the employee dimension with the current extract.

    ``buckets`` stores it bucketed by ``EmployeeId``, so queries joining it to
    a history bucketed alike run without a shuffle. ``pointer=True`` serves it
    through a view, so readers never miss it, whatever changes. ``verify=True``
    reads the landed rows back and raises unless they are those that were written.
    """
    bucket_by = (buckets, [KEY]) if buckets else None
    dim = dim_employee(employee, as_text=as_text)
    # landed first, served only once it is verified
    written = replace_table(dim, table, root, run_id=run_id, bucket_by=bucket_by, pointer=pointer, digest=verify, check=verify_landed if verify else None)
    return written


def run_etl(
    employee: DataFrame,
    history: DataFrame,
    root: str,
    *,
    key_mode: str = EXACT,
    as_text: bool = False,
    golden: bool = False,
    run_id: str | None = None,
    audit_path: str | None = None,
    database: str | None = None,
    buckets: int | None = None,
    csv_index: bool = True,
    validate: bool = False,
    strict: bool = False,
    land_history: bool = False,
    pointer: bool = False,
    verify: bool = False,
) -> EtlRun:
    """Run the whole job once. ``root`` is the shared warehouse folder.

    ``buckets`` stores the dimension bucketed by ``EmployeeId`` and the fact by
    ``Id_Employee`` (for shuffle-free joins downstream). ``csv_index=False``
    leaves the row index out of the CSV. With unique employee keys the index
    comes from employee-level offsets; otherwise it costs one extra write of
    the wide history. ``golden=True``
    reproduces the source job's number types: day counts, ordinals and the
    fact's history Id as doubles (with ``as_text``, the text ``58.0``).
    ``validate=True`` first checks the declared constraints of both inputs and
    audits the violations (one pass per check; the key checks shuffle the
    keys). With ``strict=True`` repeated or null keys stop the run, since
    they change the results; other violations are only recorded.
    ``land_history=True`` first writes the history as the parquet table
    ``RawPositionHistory`` (bucketed by key when ``buckets`` is given) and runs
    the later steps from it: a sheet-backed CSV source is then parsed once
    instead of once per step, and the lineage is cut.
    ``pointer=True`` serves all tables through views that are switched in one
    step, so a reader never finds one missing, also when layouts change.
    ``verify=True`` reads every landed table back before it is served and fails
    the step unless it holds exactly the rows that were written.
    """
    spark = employee.sparkSession
    run_id = run_id or new_run_id()
    audit = Audit(spark, audit_path or f"{root.rstrip('/')}/etl_audit", run_id)
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    safely = {"pointer": pointer, "digest": verify, "check": verify_landed if verify else None}

    if land_history:
        with audit.step("land_position_history") as step:
            landed = replace_table(
                history, prefix + RAW_HISTORY_TABLE, root, run_id=run_id,
                bucket_by=(buckets, [KEY]) if buckets else None, **safely,
            )
            step.rows = landed.rows
        history = spark.table(prefix + RAW_HISTORY_TABLE)

    if validate:
        with audit.step("validate_sources") as step:
            report = validate_sources(employee, history).filter("violations > 0").collect()  # a few rows
            step.rows = sum(r.violations for r in report)
            step.detail = "; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in report)
            keys = [r for r in report if r.check_name in ("primary_key", "unique")]
            if strict and keys:
                raise ValueError(f"key constraints violated: {step.detail}")

    def dim_step() -> Written:
        with audit.step("load_dim_employee") as step:
            dim = load_dim_employee(
                employee, root, as_text=as_text, run_id=run_id, table=prefix + DIM_EMPLOYEE_TABLE, buckets=buckets,
                pointer=pointer, verify=verify,
            )
            step.rows = dim.rows
        return dim

    def csv_step() -> Written:
        with audit.step("write_training_history_csv") as step, scratch_scope(spark):
            wide = training_history(employee, history, key_mode=key_mode, golden=golden, row_index=csv_index)
            csv = export_csv(wide, HISTORY_CSV, root, run_id=run_id, index_order=None)
            step.rows = csv.rows
        return csv

    # Independent Spark jobs: run them side by side, then fail if either failed.
    with ThreadPoolExecutor(max_workers=2) as pool:
        futures = [pool.submit(dim_step), pool.submit(csv_step)]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]
    dim, csv = (f.result() for f in futures)

    with audit.step("load_fact_training_days") as step:
        fact_df = training_fact(employee, history, key_mode=key_mode, golden=golden)
        if as_text:
            fact_df = stringify(fact_df)
        fact_buckets = (buckets, ["Id_Employee"]) if buckets else None
        fact = replace_table(fact_df, prefix + FACT_TABLE, root, run_id=run_id, bucket_by=fact_buckets, **safely)
        step.rows = fact.rows

    return EtlRun(run_id, dim, csv, fact, audit)


def _read_source(spark, ref: str):
    """A table name, a parquet folder, or ``jdbc:<table>`` (connection from Spark conf)."""
    from tenure.session import conf_int
    from tenure.sources.jdbc import read_jdbc_partitioned
    from tenure.sources.tables import read_warehouse_table

    if ref.startswith("jdbc:") and "//" not in ref:
        # Parallel range reads on the declared integer key.
        return read_jdbc_partitioned(spark, ref.removeprefix("jdbc:"), "Id", conf_int(spark, "tenure.jdbc.partitions", 16))
    return read_warehouse_table(spark, ref)


def main(argv: list[str] | None = None) -> EtlRun:
    """``spark-submit --py-files tenure.zip tenure/plans/job.py --employee ... --history ... --root ...``"""
    import argparse

    from tenure.schemas import POSITION_HISTORY
    from tenure.session import build_session
    from tenure.sources.tables import register_sheet_table

    p = argparse.ArgumentParser(prog="tenure.plans.job", description="Run the position-history batch job once.")
    p.add_argument("--employee", required=True, help="table, parquet folder, or jdbc:<table>")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--history", help="table, parquet folder, or jdbc:<table>")
    src.add_argument("--history-sheet", help="folder of CSV files with a header (a sheet export)")
    p.add_argument("--root", required=True, help="shared warehouse folder for the outputs")
    p.add_argument("--database")
    p.add_argument("--key-mode", default=EXACT, choices=["exact", "ci_rtrim"])
    p.add_argument("--as-text", action="store_true")
    p.add_argument("--golden", action="store_true")
    p.add_argument("--buckets", type=int)
    p.add_argument("--no-csv-index", action="store_true")
    p.add_argument("--validate", action="store_true", help="check the declared constraints of both inputs first")
    p.add_argument("--strict", action="store_true", help="with --validate: stop on repeated or null keys")
    p.add_argument("--land-history", action="store_true", help="write the history as parquet once, then use it")
    p.add_argument("--pointer", action="store_true", help="serve the tables through views switched in one step")
    p.add_argument("--verify", action="store_true", help="read landed tables back and compare them with what was written")
    args = p.parse_args(argv)

    spark = build_session(app_name="tenure-job")
    employee = _read_source(spark, args.employee)
    if args.history_sheet:
        name = f"{args.database}.{HISTORY_SHEET_TABLE}" if args.database else HISTORY_SHEET_TABLE
        if args.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
        history = register_sheet_table(spark, name, args.history_sheet, POSITION_HISTORY)
    else:
        history = _read_source(spark, args.history)
    run = run_etl(
        employee, history, args.root, key_mode=args.key_mode, as_text=args.as_text, golden=args.golden,
        database=args.database, buckets=args.buckets, csv_index=not args.no_csv_index,
        validate=args.validate, strict=args.strict, land_history=args.land_history,
        pointer=args.pointer, verify=args.verify,
    )
    print(f"run {run.run_id}: dimension {run.dim.rows} rows, history CSV {run.history_csv.rows} rows, "
          f"fact {run.fact.rows} rows")
    return run


HISTORY_SHEET_TABLE = "DimPositionHistory"

if __name__ == "__main__":
    main()
