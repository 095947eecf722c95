"""Hot groups are numbered by ranges; the answers equal the plain window."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenure.operators.ranking import first_per_group, number_by_ranges, number_within, split_hot_groups
from tenure.plans import queries as Q
from tenure.plans.standins import employee_standin, history_standin

SF = "/root/testdata/sf0.001"


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(60)}"
        start = None if rnd.random() < 0.05 else rnd.randrange(20)  # many ties on start
        data.append((key, start, i))
    return spark.createDataFrame(data, "key string, start int, id long")


def _pandas_rn(pdf, keys, order):
    pdf = pdf.sort_values(keys + order, na_position="last", kind="mergesort")
    return pdf.assign(rn=pdf.groupby(keys, dropna=False).cumcount() + 1)


def test_number_within_hot_equals_window(spark):
    df = _skewed(spark)
    hot = number_within(df, ["key"], ["start", "id"], min_hot_rows=200)
    plain = df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("key").orderBy(F.col("start").asc_nulls_last(), "id"))
    )
    assert hot.exceptAll(plain).count() == 0 and plain.exceptAll(hot).count() == 0
    want = _pandas_rn(df.toPandas(), ["key"], ["start", "id"])
    got = hot.toPandas().sort_values("id").reset_index(drop=True)
    assert (got["rn"].to_numpy() == want.sort_values("id")["rn"].to_numpy()).all()


def test_number_within_descending(spark):
    df = _skewed(spark, seed=3)
    hot = number_within(df, ["key"], ["start", "id"], descending=True, min_hot_rows=100)
    plain = df.withColumn(
        "rn",
        F.row_number().over(Window.partitionBy("key").orderBy(F.col("start").desc_nulls_last(), F.col("id").desc())),
    )
    assert hot.exceptAll(plain).count() == 0 and plain.exceptAll(hot).count() == 0


def test_split_finds_only_hot_keys(spark):
    df = _skewed(spark)
    split = split_hot_groups(df, ["key"], 500)
    assert [r.key for r in split.hot_keys.collect()] == ["hot"]
    assert split.normal.count() + split.hot.count() == df.count()


def test_global_index_equals_row_number(spark):
    df = _skewed(spark, seed=11)
    got = number_by_ranges(df, [], ["key", "start", "id"], name="ix", start=0, num_partitions=7)
    want = df.withColumn(
        "ix", F.row_number().over(Window.orderBy("key", F.col("start").asc_nulls_last(), "id")) - 1
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    ix = sorted(r.ix for r in got.select("ix").collect())
    assert ix == list(range(df.count()))


def test_training_history_with_hot_keys_equals_plain(spark):
    emp, hist = employee_standin(spark, SF), history_standin(spark, SF)
    plain = Q.training_history(emp, hist)
    hot = Q.training_history(emp, hist, min_hot_rows=2)
    assert hot.count() == plain.count()
    assert hot.exceptAll(plain).count() == 0 and plain.exceptAll(hot).count() == 0


def test_first_per_group_equals_rn_one(spark):
    df = _skewed(spark, seed=5)
    got = first_per_group(df, ["key"], ["start", "id"]).toPandas()
    want = _pandas_rn(df.toPandas(), ["key"], ["start", "id"])
    want = want[want.rn == 1].drop(columns="rn")
    merged = pd.merge(got, want, on=["key"], suffixes=("", "_w"))
    assert len(merged) == len(want) == len(got)
    assert (merged["id"] == merged["id_w"]).all()


def test_assign_identity_keeps_explicit_ids(spark):
    from tenure.operators.numbering import assign_identity

    df = spark.createDataFrame(
        [(5, "a"), (None, "c"), (2, "b"), (None, "a"), (None, None)], "Id int, name string"
    )
    got = sorted((r.name, r.Id) for r in assign_identity(df, "Id", ["name"]).collect() if r.name)
    assert got == [("a", 5), ("a", 6), ("b", 2), ("c", 7)]
    nulls = [r.Id for r in assign_identity(df, "Id", ["name"]).collect() if r.name is None]
    assert nulls == [8]
    fresh = spark.createDataFrame([(None, "x"), (None, "y")], "Id int, name string")
    assert sorted((r.name, r.Id) for r in assign_identity(fresh, "Id", ["name"]).collect()) == [("x", 0), ("y", 1)]


def test_number_by_ranges_with_many_keys_and_no_broadcast(spark):
    df = _skewed(spark, seed=13)
    spark.conf.set("tenure.maxBroadcastRows", "5")
    try:
        got = number_by_ranges(df, ["key"], ["start", "id"], num_partitions=5)
    finally:
        spark.conf.unset("tenure.maxBroadcastRows")
    want = df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("key").orderBy(F.col("start").asc_nulls_last(), "id"))
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_prefix_by_ranges_equals_running_sum(spark):
    from tenure.operators.ranking import prefix_by_ranges

    df = spark.createDataFrame([(i % 37, i, (i * 7) % 5 + 1) for i in range(400)], "a int, b int, w int")
    got = prefix_by_ranges(df, ["a", "b"], "w")
    want = df.withColumn(
        "_before",
        F.coalesce(F.sum("w").over(Window.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_indexed_history_equals_general_index(spark):
    emp, hist = employee_standin(spark, SF), history_standin(spark, SF)
    general = Q.with_row_index(Q.training_history(emp, hist))
    for df in (Q.training_history(emp, hist, row_index=True),
               Q.training_history(emp, hist, row_index=True, min_hot_rows=2)):
        assert df.columns == general.columns
        assert df.exceptAll(general).count() == 0 and general.exceptAll(df).count() == 0
    # Repeated employee keys: the offsets do not apply; the general numbering is used.
    dup = emp.unionByName(emp.limit(2))
    got = Q.training_history(dup, hist, row_index=True)
    assert sorted(r.row_index for r in got.collect()) == list(range(got.count()))
