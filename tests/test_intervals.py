import datetime as dt
import random

from rollcall.operators.intervals import merge_intervals, periods_and_gaps
from rollcall.operators.tenures import office_periods

TERMS = "pid string, term_start string, term_end string, sitting int, kind string, s string"


def brute(rows):
    out = set()
    for k in {r[0] for r in rows}:
        days = sorted((s, e) for kk, s, e in rows if kk == k and k is not None and s is not None and e is not None and e >= s)
        merged = []
        for s, e in days:
            if merged and s <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out |= {(k, "period", s, e) for s, e in merged}
        out |= {(k, "gap", a[1] + 1, b[0] - 1) for a, b in zip(merged, merged[1:])}
    return out


def test_against_brute_force(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", "c", None]), r.choice([None, *range(-20, 400)]), r.choice([None, *range(-20, 420)])) for _ in range(400)]
    rows += [("hot", s, s + r.randint(0, 2)) for s in range(0, 20000, 3)] + rows[:30]
    df = spark.createDataFrame(rows, "k string, s int, e int")
    got = periods_and_gaps(merge_intervals(df, "k", "s", "e", block_days=64, fan_in=4), "k").collect()
    assert len(got) == len(set(got)) and {tuple(x) for x in got} == brute(rows)


def test_office_periods(spark):
    rows = [
        ("a", "2001-01-01", "31/12/2001", 0, "x", "y"), ("a", "1.1.2002", "2002-06-30", 0, None, None), ("a", "2003-01-01", "9999-12-31", 1, None, None),
        ("b", "2001-01-01", "till date", 0, None, None), ("b", "unknown", "2002-01-01", 0, None, None), ("b", "2005-01-01", "2004-01-01", 1, None, None),
        ("c", "2001-01-01", None, 1, None, None), ("c", "2001-01-01", "2001-02-01", 1, None, None), (None, "2001-01-01", "2001-02-01", 1, None, None),
        ("d", "2001-01-01", "2001-02-30", None, None, None), ("e", "2001-01-01", "2001-01-31", 1, None, None), ("e", "2001-01-01", "2001-01-31", 1, None, None),
    ]
    got = {tuple(r) for r in office_periods(spark.createDataFrame(rows, TERMS)).collect()}
    assert got == {
        ("a", "period", "2001-01-01", "2002-06-30"), ("a", "gap", "2002-07-01", "2002-12-31"), ("a", "period", "2003-01-01", "open"),
        ("c", "period", "2001-01-01", "open"), ("e", "period", "2001-01-01", "2001-01-31"),
    }


def test_empty_table(spark):
    assert office_periods(spark.createDataFrame([], TERMS)).collect() == []


def test_days_before_the_epoch(spark):
    d = (dt.date(1955, 3, 1) - dt.date(1970, 1, 1)).days
    df = spark.createDataFrame([("a", d, d), ("a", d + 1, d + 1)], "k string, s int, e int")
    assert [tuple(r) for r in periods_and_gaps(merge_intervals(df, "k", "s", "e"), "k").collect()] == [("a", "period", d, d + 1)]
