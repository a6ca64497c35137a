"""Service calendars against a plain overlay, day by day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from railgrain.operators.schedule import calendar_dates, schedules_on, service_calendar

BASE = dt.date(1998, 1, 1)
SCHEMA = "train_uid string, date_runs_from date, date_runs_to date, days_run array<boolean>, stp_indicator string"


def rows(seed, n=300):
    r = random.Random(seed)
    day = lambda: BASE + dt.timedelta(days=r.randint(-200, 600))
    return [(f"T{r.randint(0, 20)}", day(), day(), [r.random() < 0.6 for _ in range(7)], r.choice(" CNOP"))
            for _ in range(n)] + [
        ("N", None, BASE, [True] * 7, "P"), ("N", BASE, None, [True] * 7, "P"), ("N", BASE, BASE, [None] * 7, "P"),
        ("N", BASE, BASE, None, "P"), (None, BASE, BASE, [True] * 7, "P")]


def overlay(table, days):
    out = []
    for d in days:
        on = [r for r in table if r[0] and r[1] and r[2] and r[3] and r[1] <= d <= r[2] and r[3][d.weekday()]]
        for r in on:
            if r[4] == min(x[4] for x in on if x[0] == r[0]):
                out.append((d, r[0], r[1], r[4]))
    return sorted(out)


def spread(first, n, step=1):
    return [BASE + dt.timedelta(days=first + i * step) for i in range(n)]


@pytest.mark.parametrize("days", [
    spread(0, 1), spread(0, 64), spread(0, 65), spread(5, 366), spread(-30, 20, 31), [BASE, BASE + dt.timedelta(days=2000)],
    spread(63, 1) + spread(0, 1), spread(0, 3) * 2], ids=str)
def test_equals_overlay(spark, days):
    table = rows(len(days))
    df = spark.createDataFrame(table, SCHEMA)
    want = overlay(table, sorted(set(days)))
    on = F.explode(calendar_dates("days", days))
    assert sorted(tuple(r) for r in service_calendar(df, days).select(on, "train_uid", "date_runs_from", "stp_indicator").collect()) == want
    assert sorted(tuple(r) for r in schedules_on(df, days).collect()) == want


def test_one_row_a_schedule_and_no_dates(spark):
    table = rows(7)
    df = spark.createDataFrame(table, SCHEMA)
    days = spread(0, 366)
    calendar = service_calendar(df, days)
    assert calendar.count() <= len(table)
    assert all(len(r.days) == 6 for r in calendar.collect())
    count = F.aggregate("days", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))
    assert calendar.where(count != F.size(calendar_dates("days", days))).count() == 0
    assert calendar.where(count == 0).count() == 0
    assert service_calendar(df, []).count() == 0
