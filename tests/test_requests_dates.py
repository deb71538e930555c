"""Request validation and date handling (FIXTURES.md section 2)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from runlens.functions.dates import default_range, range_bounds, rendered_dates, request_error

CASES = [
    ("week_range", "2024-12-20", "2024-12-25", None),
    ("single_day", "2024-12-25", "2024-12-25", None),
    ("month_range", "2024-12-01", "2024-12-31", None),
    ("recent_week", "2024-12-15", "2024-12-22", None),
    ("missing_start", None, "2024-12-25", "start_required"),
    ("missing_end", "2024-12-20", None, "end_required"),
    ("no_dates", None, None, "start_required"),
    ("extra_fields", "2024-12-20", "2024-12-25", None),
    ("reversed", "2024-12-25", "2024-12-20", "start_after_end"),
    ("no_such_day", "2024-02-30", "2024-03-01", "start_invalid"),
    ("not_padded", "2024-1-05", "2024-01-09", "start_invalid"),
    ("empty_text", "", "2024-01-09", "start_required"),
    ("bad_end", "2024-01-01", "2024/01/09", "end_invalid"),
    ("leap_day", "2024-02-29", "2024-03-01", None),
    ("year_zero", "0000-01-01", "2024-03-01", "start_invalid"),
]


def test_request_errors(spark):
    df = spark.createDataFrame([(c[0], c[1], c[2]) for c in CASES], "case string, start_date string, end_date string")
    got = {r["case"]: r["error"] for r in
           df.select("case", request_error(F.col("start_date"), F.col("end_date")).alias("error")).collect()}
    assert got == {c[0]: c[3] for c in CASES}


def test_range_bounds_utc():
    assert range_bounds("2024-12-20", "2024-12-25") == (1734652800, 1735171199)
    assert range_bounds("2024-12-25", "2024-12-25") == (1735084800, 1735171199)


def test_range_bounds_other_zone():
    lo, hi = range_bounds("2024-12-20", "2024-12-20", "America/Sao_Paulo")
    assert (lo, hi) == (1734652800 + 3 * 3600, 1734652800 + 3 * 3600 + 86399)


@pytest.mark.parametrize("as_of,expected", [
    (dt.date(1998, 3, 31), ("1998-02-28", "1998-03-30")),
    (dt.date(2024, 3, 31), ("2024-02-29", "2024-03-30")),
    (dt.date(2025, 1, 15), ("2024-12-15", "2025-01-14")),
    (dt.date(2025, 3, 1), ("2025-02-01", "2025-02-28")),
])
def test_default_range(spark, as_of, expected):
    assert default_range(as_of) == expected
    from runlens.functions.dates import default_range_columns
    s, e = default_range_columns(F.lit(as_of))
    row = spark.range(1).select(s.cast("string"), e.cast("string")).first()
    assert tuple(row) == expected


def test_rendered_dates(spark):
    df = spark.createDataFrame([(1734652800 + 3661,), (0,), (None,)], "created_at long")
    d, t = rendered_dates(F.col("created_at"))
    rows = df.select(d.alias("d"), t.alias("t")).collect()
    assert (rows[0]["d"], rows[0]["t"]) == ("2024-12-20", "2024-12-20T01:01:01")
    assert rows[1]["d"] is None and rows[2]["t"] is None


@pytest.mark.parametrize("name", ["format_timestamps", "date_range_filter", "validate_requests", "document_features"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    import __spark_entry__ as E
    from helpers import SF_SMALL
    q = E.queries()[name]
    utc = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        tokyo = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == tokyo and len(utc) > 0
