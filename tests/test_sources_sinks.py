"""Readers and writers: sheet table, JDBC options, catalog lists, copies, staged replace, audit, job."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tenure import schemas as S
from tenure.plans.job import run_etl
from tenure.sinks.audit import Audit
from tenure.sinks.replace import replace_table
from tenure.sources.catalog import copy_tables, tables_named
from tenure.sources.jdbc import jdbc_options
from tenure.sources.tables import read_warehouse_table, register_sheet_table


def test_sheet_table_is_reread_with_declared_schema(spark, sheet_history, work_dir):
    path = f"{work_dir}/sheet"
    sheet_history.write.mode("overwrite").option("header", True).csv(path)
    t = register_sheet_table(spark, "sheet_history", path, S.POSITION_HISTORY)
    assert t.schema.simpleString() == S.POSITION_HISTORY.simpleString().replace("false", "true") or t.count() == 6
    assert rows(t, "Id", "StartDate") == rows(sheet_history, "Id", "StartDate")
    # The table is the files: new content shows up without re-registering.
    sheet_history.limit(2).write.mode("overwrite").option("header", True).csv(path)
    spark.sql("REFRESH TABLE sheet_history")
    assert spark.table("sheet_history").count() == 2


def test_jdbc_options(spark):
    opts = jdbc_options(spark, table="dbo.Employee", url="jdbc:sqlserver://db:1433", user="u",
                        partition_column="Id", lower_bound=0, upper_bound=1000, num_partitions=8)
    assert opts["dbtable"] == "dbo.Employee" and opts["numPartitions"] == "8" and opts["partitionColumn"] == "Id"
    q = jdbc_options(spark, query="select * from dbo.Employee", url="jdbc:x")
    assert q["query"].startswith("select") and "dbtable" not in q
    with pytest.raises(ValueError):
        jdbc_options(spark, table="t", query="q", url="jdbc:x")
    with pytest.raises(ValueError):
        jdbc_options(spark, query="q", url="jdbc:x", partition_column="Id", lower_bound=0, upper_bound=1, num_partitions=2)
    spark.conf.set("tenure.jdbc.url", "jdbc:from-conf")
    try:
        assert jdbc_options(spark, table="t")["url"] == "jdbc:from-conf"
    finally:
        spark.conf.unset("tenure.jdbc.url")


def test_catalog_lists_and_copies(spark, employee, script_history, work_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS src_db")
    employee.write.mode("overwrite").saveAsTable("src_db.employee")
    script_history.write.mode("overwrite").saveAsTable("src_db.positionhistory")
    names = tables_named(spark, ["Employee", "PositionHistory", "Missing"], "src_db")
    assert sorted(names) == ["employee", "positionhistory"]
    out = copy_tables(spark, names, lambda n: spark.table(f"src_db.{n}"), f"{work_dir}/copies")
    assert rows(out, "table_name", "rows_copied") == [("employee", 4), ("positionhistory", 6)]
    assert spark.table("src_employee").count() == 4


def test_staged_replace_keeps_old_version_until_switch(spark, employee, work_dir):
    root = f"{work_dir}/staged"
    first = replace_table(employee, "DimStaged", root, run_id="20240101T000000-a")
    reader = spark.table("DimStaged")
    assert first.rows == 4 and reader.count() == 4
    second = replace_table(employee.limit(2), "DimStaged", root, run_id="20240102T000000-b")
    assert second.rows == 2 and spark.table("DimStaged").count() == 2
    replace_table(employee.limit(3), "DimStaged", root, run_id="20240103T000000-c")
    kept = sorted(os.listdir(f"{root}/DimStaged"))
    assert kept == ["version-20240102T000000-b", "version-20240103T000000-c"]
    # A new shape replaces the catalog entry too.
    replace_table(employee.select("Id"), "DimStaged", root, run_id="20240104T000000-d")
    assert spark.table("DimStaged").columns == ["Id"]


def test_failed_step_is_recorded_and_raised(spark, work_dir):
    audit = Audit(spark, f"{work_dir}/audit", "run-x")
    with audit.step("fine") as s:
        s.rows = 3
    with pytest.raises(ZeroDivisionError):
        with audit.step("broken"):
            1 / 0
    got = {r.step: (r.status, r.rows) for r in audit.frame().collect()}
    assert got == {"fine": ("ok", 3), "broken": ("failed", None)}
    assert "ZeroDivisionError" in audit.frame().filter("step = 'broken'").first().detail


def test_run_etl_writes_dimension_csv_and_fact(spark, employee, sheet_history, work_dir):
    root = f"{work_dir}/dwh"
    run = run_etl(employee, sheet_history, root, as_text=True)
    dim = spark.table(S.DIM_EMPLOYEE_TABLE)
    assert dict(dim.dtypes) == {c: "string" for c in dim.columns} and dim.count() == 4
    fact = spark.table(S.FACT_TABLE)
    assert rows(fact) == [("1", "1", "58"), ("2", "3", "58"), ("3", "5", "58")]
    assert run.history_csv.rows == 7
    steps = [(r.step, r.status, r.rows) for r in run.audit.frame().orderBy("seq").collect()]
    # The dimension and the CSV run side by side; the fact comes only after both.
    assert sorted(steps[:2]) == [("load_dim_employee", "ok", 4), ("write_training_history_csv", "ok", 7)]
    assert steps[2] == ("load_fact_training_days", "ok", 3)


def test_run_etl_fails_fast_and_keeps_old_fact(spark, employee, sheet_history, work_dir):
    root = f"{work_dir}/dwh-fail"
    run_etl(employee, sheet_history, root, database=None)
    before = rows(spark.table(S.FACT_TABLE))
    broken = sheet_history.withColumn("StartDate", F.lit("not a date"))
    audit_path = f"{root}/audit-fail"
    with pytest.raises(Exception):
        run_etl(employee, broken, root, audit_path=audit_path, run_id="fail-run")
    statuses = {r.step: r.status for r in Audit(spark, audit_path, "fail-run").frame().collect()}
    assert statuses == {"load_dim_employee": "ok", "write_training_history_csv": "failed"}
    assert rows(spark.table(S.FACT_TABLE)) == before


def test_read_warehouse_table_by_name_and_path(spark, employee, work_dir):
    path = f"{work_dir}/wh-emp"
    employee.write.mode("overwrite").parquet(path)
    assert read_warehouse_table(spark, path, S.EMPLOYEE).count() == 4
    employee.write.mode("overwrite").saveAsTable("wh_emp")
    assert read_warehouse_table(spark, "wh_emp").count() == 4


def test_scratch_scope_removes_only_its_intermediates(spark, work_dir):
    from tenure.session import materialize, scratch_scope

    from tenure.session import keep

    outside = materialize(spark.range(10), "outside")
    with scratch_scope(spark) as made:
        inside = materialize(spark.range(5), "inside")
        kept = keep(spark.range(3))
        assert inside.count() == 5 and kept.count() == 3 and kept.is_cached
    assert len(made) == 2 and not os.path.exists(made[0].removeprefix("file:"))
    assert not kept.is_cached
    assert outside.count() == 10


def test_run_etl_bucketed_outputs(spark, employee, sheet_history, work_dir):
    run_etl(employee, sheet_history, f"{work_dir}/dwh-b", database="bucketed_dwh", buckets=4)
    for table, col in (("bucketed_dwh.DimEmployee", "EmployeeId"), ("bucketed_dwh.FactTrainingDays", "Id_Employee")):
        info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        assert info["Num Buckets"] == "4" and col in info["Bucket Columns"]
    assert rows(spark.table("bucketed_dwh.FactTrainingDays")) == [(1, 1, 58), (2, 3, 58), (3, 5, 58)]


def test_sized_conf():
    from tenure.session import sized_conf

    big = sized_conf(100 * 2**40)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    small = sized_conf(10 * 2**20, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(small["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 << 20


def test_run_etl_without_csv_index(spark, employee, sheet_history, work_dir):
    run = run_etl(employee, sheet_history, f"{work_dir}/dwh-noindex", csv_index=False)
    header = spark.read.text(run.history_csv.path).first().value
    assert header.startswith("Id_Employee,") and run.history_csv.rows == 7


def test_run_etl_golden_text_outputs(spark, employee, sheet_history, work_dir):
    run = run_etl(employee, sheet_history, f"{work_dir}/dwh-golden", as_text=True, golden=True,
                  database="golden_dwh")
    assert rows(spark.table("golden_dwh.FactTrainingDays")) == [
        ("1", "1.0", "58.0"), ("2", "3.0", "58.0"), ("3", "5.0", "58.0"),
    ]
    assert rows(spark.table("golden_dwh.DimEmployee"), "Id", "BirthDate", "Address")[0] == ("1", "1982-08-19", "Jakarta Utara")
    lines = [r.value for r in spark.read.text(run.history_csv.path).collect()]
    assert "0,1,10105001,Ali Anton,1982-08-19,Jakarta Utara,1,5000,IT Manager,2022-01-01,2022-02-28,58.0,1.0" in lines


def test_sheet_table_never_replaces_a_real_table(spark, employee, work_dir):
    employee.write.mode("overwrite").saveAsTable("real_employee")
    with pytest.raises(ValueError, match="not an external CSV table"):
        register_sheet_table(spark, "real_employee", f"{work_dir}/nowhere", S.EMPLOYEE)
    assert spark.table("real_employee").count() == 4


def test_job_command_line(spark, employee, sheet_history, work_dir):
    from tenure.plans.job import main

    employee.write.mode("overwrite").parquet(f"{work_dir}/cli/employee")
    sheet_history.write.mode("overwrite").option("header", True).csv(f"{work_dir}/cli/sheet")
    run = main(["--employee", f"{work_dir}/cli/employee", "--history-sheet", f"{work_dir}/cli/sheet",
                "--root", f"{work_dir}/cli/dwh", "--database", "cli_dwh", "--validate", "--strict"])
    assert (run.dim.rows, run.history_csv.rows, run.fact.rows) == (4, 7, 3)
    assert rows(spark.table("cli_dwh.FactTrainingDays")) == [(1, 1, 58), (2, 3, 58), (3, 5, 58)]


def test_read_jdbc_partitioned_asks_for_bounds_then_ranges(spark, monkeypatch):
    import tenure.sources.jdbc as J

    calls = []

    def fake_read(spark_, **kwargs):
        calls.append(J.jdbc_options(spark_, url="jdbc:test", **kwargs))
        if "query" in kwargs:
            return spark_.createDataFrame([(3, 1002)], "lo long, hi long")
        return spark_.range(1)

    monkeypatch.setattr(J, "read_jdbc", fake_read)
    J.read_jdbc_partitioned(spark, "dbo.Employee", "Id", 8)
    assert "MIN(Id)" in calls[0]["query"]
    assert {k: calls[1][k] for k in ("dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "dbtable": "dbo.Employee", "partitionColumn": "Id", "lowerBound": "3", "upperBound": "1003", "numPartitions": "8",
    }


def test_run_etl_validates_sources(spark, employee, sheet_history, work_dir):
    run = run_etl(employee, sheet_history, f"{work_dir}/dwh-valid", validate=True, database="valid_dwh")
    steps = {r.step: (r.status, r.rows) for r in run.audit.frame().collect()}
    assert steps["validate_sources"] == ("ok", 0)

    dup = employee.unionByName(employee.limit(1))
    audit_path = f"{work_dir}/dwh-valid/audit-strict"
    with pytest.raises(ValueError, match="key constraints violated"):
        run_etl(dup, sheet_history, f"{work_dir}/dwh-valid", validate=True, strict=True,
                audit_path=audit_path, run_id="strict-run", database="valid_dwh")
    got = [(r.step, r.status, r.rows) for r in Audit(spark, audit_path, "strict-run").frame().collect()]
    # Two offending keys (Id 1 and EmployeeId 10105001); nothing was loaded after the check.
    assert got == [("validate_sources", "failed", 2)]


def test_bucketed_copies_in_parallel(spark, employee, script_history, work_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS copy_src")
    employee.write.mode("overwrite").saveAsTable("copy_src.emp")
    script_history.write.mode("overwrite").saveAsTable("copy_src.hist")
    spec = {"emp": (4, ["EmployeeId"]), "hist": (4, ["EmployeeId"])}
    for _ in range(2):  # second round repoints the bucketed copies
        out = copy_tables(spark, ["emp", "hist"], lambda n: spark.table(f"copy_src.{n}"), f"{work_dir}/bcopies",
                          prefix="b_", bucket_by=spec, parallel=2)
        assert rows(out, "table_name", "rows_copied") == [("emp", 4), ("hist", 6)]
    for t in ("b_emp", "b_hist"):
        info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t}").collect()}
        assert info["Num Buckets"] == "4"
    assert [n for n in spark.catalog.listTables() if "__staging_" in n.name] == []


def test_run_etl_lands_history_once(spark, employee, sheet_history, work_dir):
    path = f"{work_dir}/land-sheet"
    sheet_history.write.mode("overwrite").option("header", True).csv(path)
    spark.sql("CREATE DATABASE IF NOT EXISTS land_dwh")
    sheet = register_sheet_table(spark, "land_dwh.sheet_history", path, S.POSITION_HISTORY)
    run = run_etl(employee, sheet, f"{work_dir}/dwh-land", database="land_dwh", land_history=True, buckets=4)
    steps = {r.step: (r.status, r.rows) for r in run.audit.frame().collect()}
    assert steps["land_position_history"] == ("ok", 6)
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED land_dwh.RawPositionHistory").collect()}
    assert info["Num Buckets"] == "4"
    assert rows(spark.table("land_dwh.FactTrainingDays")) == [(1, 1, 58), (2, 3, 58), (3, 5, 58)]


def test_replace_keeps_what_the_catalog_serves(spark, work_dir):
    df = spark.range(3)
    for run in ("20240102-b", "20240103-c", "20240101-a"):
        replace_table(df, "served_rows", f"{work_dir}/served", run_id=run)
    assert spark.table("served_rows").count() == 3


def test_replace_refuses_a_managed_table(spark, work_dir):
    spark.range(2).write.saveAsTable("managed_rows")
    with pytest.raises(ValueError, match="not an external table"):
        replace_table(spark.range(3), "managed_rows", f"{work_dir}/managed")
    assert spark.table("managed_rows").count() == 2
