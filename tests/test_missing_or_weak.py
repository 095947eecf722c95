"""Pointers, content digests, day bins, one-pass checks, packed orders, leased ids, folded keys, sheet records, daily audits."""

from __future__ import annotations

import collections
import datetime as dt
import os
import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from test_plans import plan_text
from tenure import schemas as S
from tenure.functions.text import CASE_INSENSITIVE, key_column
from tenure.operators import ranking
from tenure.operators.bins import BIN, DayBins, measured_bins, open_binned, store_binned
from tenure.operators.checks import constraint_entries, declared_constraints, declared_violations, duplicate_keys
from tenure.operators.digest import content_digest
from tenure.operators.packing import code_of, packing_of
from tenure.plans import queries as Q
from tenure.plans.job import load_dim_employee, run_etl
from tenure.plans.standins import employee_standin, history_standin
from tenure.sinks.audit import Audit, audit_rows, compact
from tenure.sinks.identity import IdentityMark, load_identity
from tenure.sinks.replace import kept_versions, pointer_properties, replace_table, serve_version, verify_landed
from tenure.sources.catalog import copy_tables
from tenure.sources.sheets import numbered_lines, read_sheet, records

SF = "/root/testdata/sf0.001"


# --- replace through a pointer ---------------------------------------------------------------


def test_a_reader_never_misses_a_pointed_table(spark, work_dir):
    """A reader that loops through changes of schema, format and bucketing finds one whole version each time."""
    root, table = f"{work_dir}/pointed", "pointed_rows"
    shapes = [
        lambda k: (spark.range(100 + k).withColumn("v", F.lit(k)), {}),
        lambda k: (spark.range(100 + k).select(F.col("id").cast("string").alias("id"), F.lit(k).alias("v"), F.lit("x").alias("more")), {}),
        lambda k: (spark.range(100 + k).withColumn("v", F.lit(k)), {"bucket_by": (4, ["id"])}),
        lambda k: (spark.range(100 + k).withColumn("v", F.lit(k)), {"fmt": "orc"}),
        lambda k: (spark.range(100 + k).withColumn("v", F.lit(k)), {"partition_by": ["v"]}),
    ]

    def write(k):
        df, how = shapes[k % len(shapes)](k)
        replace_table(df, table, root, pointer=True, keep=4, **how)

    write(0)
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                r = spark.table(table).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
                seen.append((r.n, r.lo, r.hi))
            except Exception as e:  # noqa: BLE001
                errors.append(repr(e)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 11):
        write(k)
    stop.set()
    reader.join()
    assert errors == []
    assert len({n for n, *_ in seen}) > 3 and all(lo == hi and n == 100 + lo for n, lo, hi in seen)


def test_pointer_names_its_version_and_goes_back(spark, work_dir):
    root, table = f"{work_dir}/back", "back_rows"
    for k, run in enumerate(("20240101T000000-a", "20240102T000000-b", "20240103T000000-c")):
        replace_table(spark.range(k + 1), table, root, run_id=run, pointer=True, digest=True, check=verify_landed, properties={"made.by": "it's \\ me"})
    notes = pointer_properties(spark, table)
    assert (notes["version"], notes["rows"], notes["made.by"]) == ("20240103T000000-c", "3", "it's \\ me")
    assert notes["digest"] == content_digest(spark.range(3))[1]
    assert kept_versions(spark, table) == ["back_rows__v_20240102t000000_b", "back_rows__v_20240103t000000_c"]
    assert sorted(os.listdir(f"{root}/back_rows")) == ["version-20240102T000000-b", "version-20240103T000000-c"]
    serve_version(spark, table, "20240102T000000-b")
    assert spark.table(table).count() == 2 and pointer_properties(spark, table)["version"] == "20240102T000000-b"
    with pytest.raises(ValueError, match="keeps no version"):
        serve_version(spark, table, "20240101T000000-a")
    # the served version stays, however old, when new ones come and go
    replace_table(spark.range(9), table, root, run_id="20240104T000000-d", pointer=True, keep=1)
    assert spark.table(table).count() == 9


def test_a_table_from_before_becomes_a_pointer(spark, work_dir):
    replace_table(spark.range(2), "older_rows", f"{work_dir}/older")
    replace_table(spark.range(3).withColumn("more", F.lit(1)), "older_rows", f"{work_dir}/older", pointer=True)
    assert spark.table("older_rows").count() == 3
    spark.range(2).write.saveAsTable("managed_pointed")
    with pytest.raises(ValueError, match="not an external table"):
        replace_table(spark.range(3), "managed_pointed", f"{work_dir}/older", pointer=True)
    assert spark.table("managed_pointed").count() == 2


def test_pointed_buckets_still_save_the_shuffle(spark, work_dir):
    emp, hist = employee_standin(spark, SF), history_standin(spark, SF)
    replace_table(emp, "emp_p", f"{work_dir}/pb", bucket_by=(8, ["EmployeeId"]), pointer=True)
    replace_table(hist, "hist_p", f"{work_dir}/pb", bucket_by=(8, ["EmployeeId"]), pointer=True)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan_text(Q.training_fact(spark.table("emp_p"), spark.table("hist_p")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_job_serves_through_pointers(spark, employee, sheet_history, work_dir):
    root = f"{work_dir}/dwh-pointed"
    for as_text, buckets in ((False, None), (True, 4)):
        run = run_etl(employee, sheet_history, root, database="pointed_dwh", pointer=True, verify=True, as_text=as_text, buckets=buckets, land_history=True)
        assert run.fact.digest == content_digest(spark.table("pointed_dwh.FactTrainingDays"))[1]
        assert {r.status for r in run.audit.frame().collect()} == {"ok"}
    assert rows(spark.table("pointed_dwh.FactTrainingDays")) == [("1", "1", "58"), ("2", "3", "58"), ("3", "5", "58")]


# --- content digest ---------------------------------------------------------------------------


def test_digest_knows_content_not_order(spark):
    df = spark.createDataFrame([(1, "a", 2.5, None), (2, None, -0.0, dt.date(2020, 1, 1)), (2, None, -0.0, dt.date(2020, 1, 1))], "i int, s string, d double, t date")
    n, digest = content_digest(df)
    assert n == 3
    assert content_digest(df.repartition(3).select("t", "d", "s", "i"))[1] == digest
    changed = [df.withColumn("s", F.when(F.col("i") == 1, "b").otherwise(F.col("s"))), df.distinct(), df.withColumn("d", F.col("d") + 0.0), df.withColumn("s", F.coalesce("s", F.lit("")))]
    assert len({digest, *(content_digest(c)[1] for c in changed)}) == 5
    two = [spark.createDataFrame([r], "a string, b string") for r in (("1:x", ""), ("", "1:x"), ("x", None), (None, "x"), ("ab", "c"), ("a", "bc"))]
    assert len({content_digest(t)[1] for t in two}) == 6
    odd = spark.createDataFrame([(b"\xff", [1, None], {"a": 1}, (1, "x"))], "b binary, l array<int>, m map<string,int>, s struct<a:int,b:string>")
    assert content_digest(odd)[1] != content_digest(odd.withColumn("b", F.lit(b"\xfe")))[1]
    assert content_digest(df.limit(0)) == (0, "0-0")


def test_a_copy_with_one_altered_value_fails(spark, work_dir, monkeypatch):
    from tenure.sinks.replace import Written

    spark.range(1000).withColumn("v", F.col("id") * 2).createOrReplaceTempView("copied_numbers")
    out = copy_tables(spark, ["copied_numbers"], spark.table, f"{work_dir}/dcopies").first()
    assert (out.rows_copied, out.digest) == content_digest(spark.table("copied_numbers"))
    plain = Written.path_frame
    monkeypatch.setattr(Written, "path_frame", lambda self, s, schema=None: plain(self, s, schema).withColumn("v", F.when(F.col("id") == 417, -1).otherwise(F.col("v"))))
    before = spark.table("src_copied_numbers").count()
    with pytest.raises(ValueError, match="differ from those written"):
        copy_tables(spark, ["copied_numbers"], spark.table, f"{work_dir}/dcopies")
    monkeypatch.setattr(Written, "path_frame", lambda self, s, schema=None: plain(self, s, schema).limit(999))
    with pytest.raises(ValueError, match="1000 rows written, 999 landed"):
        load_dim_employee(spark.table("copied_numbers"), f"{work_dir}/ddim", table="dim_numbers", verify=True, pointer=True)
    assert not spark.catalog.tableExists("dim_numbers") and kept_versions(spark, "dim_numbers") == []
    assert spark.table("src_copied_numbers").count() == before


# --- day bins -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def intervals(spark):
    rng = random.Random(11)
    day = dt.date(2000, 1, 1)
    data = []
    for k in range(400):
        a = day + dt.timedelta(rng.randint(0, 3000))
        b = rng.choice([a, a + dt.timedelta(rng.randint(-50, 900)), dt.date(9999, 12, 31), None])
        data.append((k, f"e{k % 37}", rng.choice([a, a, a, None]), b))
    data += [(400, "e1", day, day), (401, None, day, dt.date(9999, 12, 31)), (402, "e2", dt.date(9999, 12, 31), dt.date(9999, 12, 31))]
    return spark.createDataFrame(data, "Id int, EmployeeId string, StartDate date, EndDate date"), data


@pytest.mark.parametrize("width", [None, 1, 90, 5000])
def test_bins_answer_as_the_whole_history(spark, intervals, work_dir, width):
    df, data = intervals
    table = f"binned_{width or 0}"
    if width == 1:  # bins of a day would run to the year 9999 with the one start there
        df, data = df.filter("Id < 402"), data[:402]
    written, _ = store_binned(df, table, f"{work_dir}/bins", width=width)
    binned, bins = open_binned(spark, table)
    live = [r for r in data if r[2] and r[3] and r[2] <= r[3]]
    for day in (dt.date(1990, 1, 1), dt.date(2000, 1, 1), dt.date(2004, 6, 15), dt.date(2008, 3, 1), dt.date(2100, 1, 1), dt.date(9999, 12, 31)):
        got = sorted(tuple(r) for r in bins.on(binned, day).select("Id", "StartDate", "EndDate").collect())
        assert got == sorted((r[0], r[2], r[3]) for r in live if r[2] <= day <= r[3])
    days = [dt.date(2004, 6, 15), dt.date(2004, 6, 15), dt.date(2004, 6, 16), dt.date(2050, 1, 1), None]
    got = collections.Counter((r.day, r.Id) for r in bins.on_days(binned, spark.createDataFrame([(d,) for d in days], "day date")).collect())
    assert got == collections.Counter((d, r[0]) for d in {d for d in days if d} for r in live if r[2] <= d <= r[3])
    for a, b in ((dt.date(2001, 1, 1), dt.date(2003, 1, 1)), (dt.date(1980, 1, 1), dt.date(9999, 12, 31)), (dt.date(2005, 5, 5), dt.date(2005, 5, 5)), (dt.date(2006, 1, 1), dt.date(2005, 1, 1))):
        got = sorted(r.Id for r in bins.overlapping(binned, a, b).collect())
        assert got == sorted(r[0] for r in live if a <= b and r[2] <= b and r[3] >= a)
    assert written.rows == bins.spread(df).count()


def test_one_day_reads_one_partition(spark, work_dir):
    history = history_standin(spark, SF)
    store_binned(history, "binned_orders", f"{work_dir}/bins")
    binned, bins = open_binned(spark, "binned_orders")
    found = bins.on(binned, "1998-06-15")
    plan = plan_text(found, "formatted")
    number = (dt.date(1998, 6, 15) - dt.date(1970, 1, 1)).days // bins.width
    assert f"({BIN}#" in plan.split("PartitionFilters")[1].split("\n")[0] and f"= {number})" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert {f.split(f"{BIN}=")[1].split("/")[0] for f in found.inputFiles()} >= {str(number)}
    scanned = found.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split(f"{BIN}=")[1].split("/")[0] for r in scanned} == {str(number)}
    assert "PushedFilters: [" in plan and "LessThanOrEqual(StartDate,1998-06-15)" in plan
    today = plan_text(bins.on(binned), "formatted")  # today is a literal by the time partitions are chosen
    assert f"= {bins.last})" in today.split("PartitionFilters")[1].split("\n")[0]


def test_bins_of_an_empty_history(spark, work_dir):
    empty = spark.createDataFrame([], "Id int, StartDate date, EndDate date")
    store_binned(empty, "binned_none", f"{work_dir}/bins")
    binned, bins = open_binned(spark, "binned_none")
    assert bins == DayBins(7, 0, 0) and bins.on(binned, "2020-01-01").count() == 0
    assert measured_bins(spark.createDataFrame([(1, None, None)], "Id int, StartDate date, EndDate date")) == DayBins(7, 0, 0)
    with pytest.raises(ValueError, match="not stored by day bins"):
        replace_table(spark.range(1), "not_binned", f"{work_dir}/bins", pointer=True)
        open_binned(spark, "not_binned")


# --- all constraints in one pass -----------------------------------------------------------------


def test_constraints_in_one_pass_equal_single_checks(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, *range(40)]), rng.choice([None, "a", "bb", "ccc"]), rng.choice([None, "x" * rng.randint(0, 9)]), rng.randint(0, 3)) for _ in range(120)]
    df = spark.createDataFrame(data, "Id int, EmployeeId string, Name string, n int")
    got = {(r.check_name, r.column_name): r.violations for r in declared_violations(
        df, "t", primary_key=["Id"], unique=[["EmployeeId"], ["Id", "n"], ["gone"]], not_null=["Id", "Name", "gone"], lengths={"Name": 4, "EmployeeId": 10}).collect()}
    want = {("primary_key", "Id"): duplicate_keys(df, ["Id"]).count(), ("unique", "EmployeeId"): duplicate_keys(df, ["EmployeeId"], allow_null=True).count(),
            ("unique", "Id,n"): duplicate_keys(df, ["Id", "n"], allow_null=True).count(), ("not_null", "Id"): sum(r[0] is None for r in data),
            ("not_null", "Name"): sum(r[2] is None for r in data), ("max_length", "Name"): sum(len(r[2] or "") > 4 for r in data), ("max_length", "EmployeeId"): 0}
    assert got == want
    assert {r.violations for r in declared_violations(df.limit(0), "t", primary_key=["Id"], not_null=["Id"]).collect()} == {0}
    assert declared_violations(df, "t", primary_key=["gone"]).count() == 0


def test_constraints_take_one_scan_and_one_shuffle(spark):
    hist = history_standin(spark, SF).sparkSession.read.parquet(f"{SF}/orders.parquet")
    entries = constraint_entries(hist, declared_constraints(hist.columns, primary_key=["o_orderkey"], unique=[["o_orderkey", "o_custkey"]], not_null=["o_custkey"], lengths={"o_orderpriority": 5}))
    plan = plan_text(entries)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def test_equal_hashes_of_different_keys_are_no_violation(spark, monkeypatch):
    from tenure.operators import checks

    monkeypatch.setattr(checks, "_key_hash", lambda columns, seed: F.lit(1).cast("bigint"))
    got = declared_violations(spark.range(50), "t", primary_key=["id"]).first()
    assert got.violations == 0
    assert declared_violations(spark.range(50).withColumn("id", F.col("id") % 20), "t", primary_key=["id"]).first().violations == 20


# --- first row by packed numbers -----------------------------------------------------------------


@pytest.mark.parametrize("kinds", ["date, int, date, bigint", "date, bigint, date, int", "timestamp, bigint, int, smallint", "timestamp_ntz, int, timestamp, tinyint", "bigint, int, bigint, int"])
@pytest.mark.parametrize("descending", [False, True])
def test_packed_first_rows_equal_the_struct_form(spark, monkeypatch, kinds, descending):
    rng = random.Random(9)
    kind = dict(zip("abcd", kinds.split(", "), strict=True))
    values = {
        "date": [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(2020, 2, 29), dt.date(9999, 12, 31)],
        "timestamp": [dt.datetime(1900, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2020, 2, 29, 1, 2, 3, 4)],
        "tinyint": [-128, 0, 127], "smallint": [-32768, 0, 32767], "int": [-(1 << 31), -1, 0, 1, (1 << 31) - 1], "bigint": [-(1 << 63), -1, 0, 7, (1 << 63) - 1],
    }
    values["timestamp_ntz"] = values["timestamp"]
    seen, data = set(), []
    for _ in range(600):
        a, b = (rng.choice([None, *values[kind[c]]]) for c in "ab")
        k = rng.randint(0, 60)
        if (k, a, b) not in seen:  # ties of the whole order have no defined winner
            seen.add((k, a, b))
            data.append((k, a, b, *(rng.choice([None, *values[kind[c]]]) for c in "cd")))
    df = spark.createDataFrame(data, "k int, " + ", ".join(f"{c} {t}" for c, t in kind.items()))
    how = dict(descending=descending, carry=["b", "c", "d"])
    if sum(code_of(df.schema[c].dataType).digits for c in "bcd") > 38:
        how["carry"] = ["b", "d"]
    packed = ranking.first_per_group(df, ["k"], ["a", "b"], **how)
    plan = plan_text(packed)
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    monkeypatch.setattr(ranking, "packing_of", lambda *a, **k: None)
    plain = ranking.first_per_group(df, ["k"], ["a", "b"], **how)
    assert "SortAggregate" in plan_text(plain)
    assert packed.schema == plain.schema and sorted(packed.collect(), key=str) == sorted(plain.collect(), key=str)


def test_training_fact_is_hashed_and_text_is_not_packed(spark, employee, script_history):
    plan = plan_text(Q.training_fact(employee, script_history))
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    assert "SortAggregate" not in plan_text(Q.training_periods(employee, script_history))
    assert packing_of(script_history, ["PosTitle"]) is None and packing_of(script_history, ["Id"] * 4) is None
    early = spark.sql("select 1 as k, date_sub(date'0001-01-01', 1) as a, 1 as b")
    with pytest.raises(Exception, match="outside the years 1 to 9999"):
        ranking.first_per_group(early, ["k"], ["a"], carry=["b"]).collect()


# --- identity across loads -------------------------------------------------------------------------


def test_ids_are_never_given_twice(spark, work_dir):
    mark = IdentityMark(spark, f"{work_dir}/ids-a", seed=5)
    none = F.lit(None).cast("int").alias("Id")
    first = load_identity(spark.range(10).select(none, F.col("id").alias("v")), "Id", ["v"], mark)
    assert sorted(r.Id for r in first.collect()) == list(range(5, 15))
    again = load_identity(spark.range(3).select(none, F.col("id").alias("v")), "Id", ["v"], mark)  # everything deleted meanwhile: the mark stays
    assert sorted(r.Id for r in again.collect()) == [15, 16, 17] and mark.next_free() == 18
    explicit = spark.createDataFrame([(100, 1), (None, 2), (7, 3)], "Id int, v int")
    assert sorted((r.v, r.Id) for r in load_identity(explicit, "Id", ["v"], mark).collect()) == [(1, 100), (2, 101), (3, 7)]
    assert load_identity(explicit.limit(0), "Id", ["v"], mark).count() == 0 and mark.next_free() == 102
    with pytest.raises(ValueError):
        mark.lease(-1)


def test_concurrent_leases_do_not_overlap(spark, work_dir):
    taken, lock = [], threading.Lock()

    def load(k):
        mark = IdentityMark(spark, f"{work_dir}/ids-b")
        for _ in range(5):
            first = mark.lease(k + 1)
            with lock:
                taken.extend(range(first, first + k + 1))

    threads = [threading.Thread(target=load, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(taken) == list(range(50))


# --- folded keys -----------------------------------------------------------------------------------


def test_folded_keys_match_as_the_collation_does(spark):
    forms = ["Straße", "STRASSE", "strasse", "STRAẞE", "ΟΔΟΣ", "οδος", "οδοσ", "ODOS", "İx", "i̇x", "ix", "Ix", "ıx", "K1", "k1", "ſ", "S", "ﬁ", "FI", "é", "É", "e", "AbC ", "aBc", " abc", "abc\t", "Ω", "Ω"]
    df = spark.createDataFrame([(f,) for f in forms], "a string")
    pairs = df.crossJoin(df.withColumnRenamed("a", "b"))  # a fixture of a few letters
    ours = key_column("a", CASE_INSENSITIVE) == key_column("b", CASE_INSENSITIVE)
    theirs = F.collate("a", "UNICODE_CI_RTRIM") == F.collate("b", "UNICODE_CI_RTRIM")
    differ = pairs.select("a", "b", ours.alias("x"), theirs.alias("y")).filter("x != y").collect()
    # full case folding makes a sharp s two and a long s one plain s; the collation calls them variants
    assert {frozenset((r.a, r.b)) for r in differ if r.x} == {frozenset(p) for p in (("Straße", "STRASSE"), ("Straße", "strasse"), ("STRAẞE", "STRASSE"), ("STRAẞE", "strasse"), ("ſ", "S"))}
    assert [r for r in differ if not r.x] == []


def test_folded_join_stays_a_hash_join(spark):
    plan = plan_text(Q.current_position(employee_standin(spark, SF), history_standin(spark, SF), "1998-06-15", key_mode=CASE_INSENSITIVE))
    assert "BroadcastHashJoin" in plan


# --- sheets with line breaks -------------------------------------------------------------------------


def sheet_text(rows_, newline):
    def cell(v):
        return "" if v is None else '"' + str(v).replace('"', '""') + '"' if any(c in str(v) for c in '",\n\r') or v == "" else str(v)

    return newline.join(["id,name,day", *(",".join(cell(c) for c in r) for r in rows_)]) + newline


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [None, 64, 1000])
def test_sheet_values_with_line_breaks_round_trip(spark, work_dir, newline, split):
    rng = random.Random(3)
    folder = f"{work_dir}/broken-sheet-{len(newline)}-{split}"
    os.makedirs(folder)
    want = []
    for part in range(3):
        made = []
        for k in range(60):
            name = rng.choice(["plain", 'say "hi"', "two\nlines", "\n\nafter", "ends\n", "win\r\ndows", '"', ",", "a" * 200, 'x"\n"y', " blanks ", None, "é\n€"])
            made.append((part * 100 + k, name, rng.choice([None, dt.date(2020, 1, 1 + k % 28)])))
        want += made
        with open(f"{folder}/p{part}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(sheet_text(made, newline))
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:  # records torn between splits and tasks
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_sheet(spark, folder, schema)
        assert sorted(map(tuple, got.collect())) == sorted(want) if all(r[1] for r in want) else sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_sheet_without_rows_and_with_wrong_ones(spark, work_dir):
    folder = f"{work_dir}/odd-sheet"
    os.makedirs(folder)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    with open(f"{folder}/a.csv", "w") as f:
        f.write("id,name\n\n\n1,x\n\n")
    with open(f"{folder}/b.csv", "w") as f:
        f.write("")
    assert [tuple(r) for r in read_sheet(spark, folder, schema).collect()] == [(1, "x")]
    with open(f"{folder}/c.csv", "w") as f:
        f.write('id,name\nnot a number,x\n')
    with pytest.raises(Exception):
        read_sheet(spark, folder, schema).collect()
    bare = f"{work_dir}/bare-sheet"
    os.makedirs(bare)
    with open(f"{bare}/a.csv", "w") as f:
        f.write('1,"a\nb"\n2,c')
    assert sorted(map(tuple, read_sheet(spark, bare, schema, header=False).collect())) == [(1, "a\nb"), (2, "c")]


def test_only_lines_of_torn_records_are_grouped(spark, work_dir):
    folder = f"{work_dir}/torn-sheet"
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write("".join(f"{k},x\n" for k in range(50)) + '50,"a\nb"\n')
    lines = numbered_lines(spark, folder)
    got = records(lines)
    assert lines.count() == 52 and got.count() == 51
    assert got.filter(F.col("record").contains("\n")).first().record == '50,"a\nb"'


# --- audit by day ------------------------------------------------------------------------------------


def test_one_run_reads_one_partition_of_the_audit(spark, work_dir):
    path = f"{work_dir}/audit-days"
    for day in range(1, 29):
        audit = Audit(spark, path, f"202402{day:02d}T101500000000-aaaaaa")
        with audit.step("one") as s:
            s.rows = day
        if day % 7 == 0:
            with audit.step("two"):
                pass
    mine = Audit(spark, path, "20240214T101500000000-aaaaaa").frame()
    assert [(r.step, r.rows) for r in mine.orderBy("seq").collect()] == [("one", 14), ("two", None)]
    plan = plan_text(mine, "formatted")
    assert "PartitionFilters: [isnotnull(run_date" in plan and "2024-02-14" in plan
    files = spark.read.parquet(f"{path}/days").filter("run_date = date'2024-02-14'").select(F.input_file_name().alias("f")).distinct().count()
    before = sorted(map(str, audit_rows(spark, path).collect()))
    assert files == 2 and len(before) == 32
    assert compact(spark, path, dt.date(2024, 2, 20)) == [dt.date(2024, 2, 7), dt.date(2024, 2, 14)]
    assert compact(spark, path, dt.date(2024, 2, 20)) == []
    assert sorted(map(str, audit_rows(spark, path).collect())) == before
    assert len([f for f in os.listdir(f"{path}/days/run_date=2024-02-14") if f.endswith(".parquet")]) == 1
    assert [f for f in os.listdir(path) if f.startswith("staged-")] == []
    assert Audit(spark, path, "20240214T101500000000-aaaaaa").frame().count() == 2


def test_runs_with_names_of_their_own_are_found_on_any_day(spark, work_dir):
    path = f"{work_dir}/audit-named"
    with Audit(spark, path, "nightly", dt.date(2023, 3, 4)).step("one"):
        pass
    with Audit(spark, path, "nightly-2").step("one"):
        pass
    assert Audit(spark, path, "nightly").frame().count() == 1 and Audit(spark, path, "nightly", dt.date(2023, 3, 4)).frame().count() == 1
    assert Audit(spark, path, "nightly", dt.date(2023, 3, 5)).frame().count() == 0
    assert audit_rows(spark, path).count() == 2 and S.FACT_TABLE == "FactTrainingDays"
