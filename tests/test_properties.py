"""Property tests: random small tables, Spark answers equal DuckDB brute force."""

from __future__ import annotations

import datetime as dt

import duckdb
import pandas as pd
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tenure import schemas as S
from tenure.plans import queries as Q

HISTORY = T.StructType(
    [
        T.StructField("Id", T.IntegerType()),
        T.StructField("PosId", T.StringType()),
        T.StructField("PosTitle", T.StringType()),
        T.StructField("EmployeeId", T.StringType()),
        T.StructField("StartDate", T.DateType()),
        T.StructField("EndDate", T.DateType()),
    ]
)
KEYS = ["e1", "e2", "e3", "e4", "x9"]  # x9 has history but no employee
DAY0 = dt.date(2022, 1, 1)

days = st.one_of(st.none(), st.integers(0, 40).map(lambda d: DAY0 + dt.timedelta(days=d)))
hist_rows = st.lists(
    st.tuples(st.one_of(st.none(), st.sampled_from(KEYS)), days, days), min_size=0, max_size=25
)
emp_keys = st.lists(st.sampled_from(KEYS[:4] + ["e5", "e6"]), min_size=1, max_size=6, unique=True)


def _frames(spark, keys, hist):
    emp = [(i + 1, k, f"name {k}", DAY0, None) for i, k in enumerate(keys)]
    his = [(i + 1, f"P{i}", f"title {i}", k, s, e) for i, (k, s, e) in enumerate(hist)]
    return (
        spark.createDataFrame(emp, S.EMPLOYEE),
        spark.createDataFrame(his, HISTORY),
        pd.DataFrame(emp, columns=[f.name for f in S.EMPLOYEE.fields], dtype=object),
        pd.DataFrame(his, columns=[f.name for f in HISTORY.fields], dtype=object),
    )


def _canon(rows):
    return sorted(tuple("<null>" if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else str(v) for v in r) for r in rows)


def _duck(pe, ph, sql):
    con = duckdb.connect()
    con.execute("create table employee (Id int, EmployeeId varchar, FullName varchar, BirthDate date, Address varchar)")
    con.execute("create table position_history (Id int, PosId varchar, PosTitle varchar, EmployeeId varchar, "
                "StartDate date, EndDate date)")
    for name, frame in (("employee", pe), ("position_history", ph)):
        rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
        if rows:
            con.executemany(f"insert into {name} values ({', '.join('?' * len(frame.columns))})", rows)
    return con.execute(sql).fetchall()


WIDE_SQL = """
with numbered as (
  select Id as Id_PositionHistory, PosId, PosTitle, EmployeeId, StartDate as s, EndDate as e,
         date_diff('day', StartDate, EndDate) as d,
         row_number() over (partition by EmployeeId order by StartDate asc nulls last, Id asc) as rn
  from position_history where EmployeeId is not null)
select emp.Id, emp.EmployeeId, n.Id_PositionHistory, n.s, n.e, n.d, n.rn
from employee emp left join numbered n on emp.EmployeeId = n.EmployeeId
"""

LATEST_SQL = """
with ranked as (
  select *, row_number() over (partition by EmployeeId order by StartDate desc nulls last, Id desc) as rn
  from position_history where EmployeeId is not null)
select emp.EmployeeId, r.Id from employee emp left join ranked r on emp.EmployeeId = r.EmployeeId and r.rn = 1
"""

LITERAL_SQL = """
select EmployeeId, hid from (
  select emp.EmployeeId, h.Id as hid,
         row_number() over (partition by h.EmployeeId order by h.StartDate desc nulls last,
                            h.Id desc nulls last, emp.Id) as rn
  from employee emp left join position_history h on emp.EmployeeId = h.EmployeeId) t
where rn = 1
"""

CURRENT_SQL = """
select emp.EmployeeId, h.Id from employee emp join position_history h on emp.EmployeeId = h.EmployeeId
where date '2022-01-15' between h.StartDate and h.EndDate
"""


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(keys=emp_keys, hist=hist_rows)
def test_queries_equal_brute_force(spark, keys, hist):
    emp, his, pe, ph = _frames(spark, keys, hist)

    wide = Q.training_history(emp, his)
    got = wide.select("Id_Employee", "EmployeeId", "Id_PositionHistory", "StartDate", "EndDate",
                      "training_day_duration", "rn").collect()
    assert _canon(got) == _canon(_duck(pe, ph, WIDE_SQL))
    hot = Q.training_history(emp, his, min_hot_rows=2)
    assert _canon(hot.collect()) == _canon(wide.collect())

    latest = Q.latest_position(emp, his)
    assert latest.count() == len(keys)  # one row per employee
    ids = {r.Id: r for r in his.collect()}
    lat = [(r.EmployeeId, _hid(ids, r)) for r in latest.collect()]
    assert _canon(lat) == _canon(_duck(pe, ph, LATEST_SQL))

    literal = Q.latest_position(emp, his, literal=True)
    lit = [(r.EmployeeId, _hid(ids, r)) for r in literal.collect()]
    assert _canon(lit) == _canon(_duck(pe, ph, LITERAL_SQL))

    fact = Q.training_fact(emp, his)
    matched = {k for k in keys if any(h[0] == k for h in hist)}
    assert fact.count() == len(matched)  # one row per matched employee
    first = wide.filter("rn = 1").select("Id_Employee", "Id_PositionHistory", "training_day_duration")
    assert _canon(fact.collect()) == _canon(first.collect())

    cur = Q.current_position(emp, his, "2022-01-15")
    cur_rows = [(r.EmployeeId, _hid(ids, r)) for r in cur.collect()]
    assert _canon(cur_rows) == _canon(_duck(pe, ph, CURRENT_SQL))


def _hid(ids, r):
    """History Id of an output row, found by its position attributes (null when none)."""
    if r.PosId is None:
        return None
    return int(r.PosId[1:]) + 1
