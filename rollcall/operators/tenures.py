"""Continuous periods of office and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import parse_day
from rollcall.operators.intervals import OPEN_DAY, merge_intervals, periods_and_gaps


def office_periods(tenures: DataFrame, pid: str = "pid", start: str = "term_start", end: str = "term_end", sitting: str = "sitting", open_from_year: int = 2090) -> DataFrame:
    """Rows (pid, kind, start_day, end_day) of every period of office and every gap.

    An end that is missing, unreadable or a day from open_from_year on is no end: it
    is open where sitting = 1, else the row is not used (a null sitting counts as 0).
    Rows without a readable start, with an end before the start or with a null pid are
    not used. Repeated rows change nothing; an empty table gives no rows; other columns
    are ignored.
    """
    first, last = parse_day(F.col(start)), parse_day(F.col(end))
    real_end = F.when(F.year(last) < open_from_year, F.unix_date(last))
    days = tenures.select(
        F.col(pid).alias("pid"),
        F.unix_date(first).alias("s"),
        F.coalesce(real_end, F.when(F.col(sitting) == 1, F.lit(OPEN_DAY))).alias("e"),
    )
    out = periods_and_gaps(merge_intervals(days, "pid", "s", "e"), "pid")
    return out.select(
        "pid",
        "kind",
        F.date_format(F.date_from_unix_date("s"), "yyyy-MM-dd").alias("start_day"),
        F.when(F.col("e") == OPEN_DAY, F.lit("open")).otherwise(F.date_format(F.date_from_unix_date("e"), "yyyy-MM-dd")).alias("end_day"),
    )
