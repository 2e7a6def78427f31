import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.caltime import business_calendar, calendar_from_intervals, format_hms, int_div, with_business_seconds
from ledgerline.params import BusinessHours

HOURS = BusinessHours(first_day=dt.date(2024, 1, 1), last_day=dt.date(2024, 12, 31), yearly_holidays=((1, 1),))


def secs(spark, a, b, hours=HOURS):
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    cal = business_calendar(spark, hours)
    return with_business_seconds(df, "a", "b", "s", cal).collect()[0].s


def test_after_close_to_before_open_is_zero(spark):
    # Friday 18:00 to Monday 08:00
    assert secs(spark, dt.datetime(2024, 3, 8, 18), dt.datetime(2024, 3, 11, 8)) == 0


def test_span_over_weekend(spark):
    assert secs(spark, dt.datetime(2024, 3, 8, 16), dt.datetime(2024, 3, 11, 10)) == 7200


def test_span_over_weekend_and_holiday(spark):
    hours = BusinessHours(first_day=dt.date(2024, 1, 1), last_day=dt.date(2024, 12, 31), holidays=(dt.date(2024, 3, 11),))
    assert secs(spark, dt.datetime(2024, 3, 8, 16), dt.datetime(2024, 3, 12, 10), hours) == 3600 + 3600


def test_same_day_and_yearly_holiday(spark):
    assert secs(spark, dt.datetime(2024, 3, 12, 10, 0, 5), dt.datetime(2024, 3, 12, 10, 0, 10)) == 5
    assert secs(spark, dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 12)) == 0


def test_reversed_and_null_and_out_of_range(spark):
    assert secs(spark, dt.datetime(2024, 3, 12, 12), dt.datetime(2024, 3, 12, 10)) == 0
    assert secs(spark, dt.datetime(2024, 3, 12, 12), None) is None
    assert secs(spark, dt.datetime(2023, 3, 12, 12), dt.datetime(2024, 3, 12, 12)) is None


def test_additive_over_split_point(spark):
    a, m, b = dt.datetime(2024, 2, 27, 11, 13), dt.datetime(2024, 3, 5, 16, 59, 1), dt.datetime(2024, 4, 2, 9, 30)
    assert secs(spark, a, m) + secs(spark, m, b) == secs(spark, a, b)
    assert secs(spark, a, b) <= (b - a).total_seconds()


def test_format_hms(spark):
    df = spark.createDataFrame([(360000,), (None,), (59,), (100000,)], "s long")
    got = [r.f for r in df.select(format_hms(F.col("s")).alias("f")).collect()]
    assert got == ["100:00:00", None, "00:00:59", "27:46:40"]


def test_integer_average_truncates(spark):
    df = spark.createDataFrame([(1,), (2,)], "d long")
    assert df.select(int_div(F.sum("d"), F.count("d")).alias("a")).collect()[0].a == 1


def test_epoch_seconds_ignores_session_zone(spark):
    from ledgerline.functions.caltime import epoch_seconds

    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),), (dt.datetime(2024, 3, 10, 3, 10),)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r.s for r in df.select(epoch_seconds(df, "t").alias("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1710037800, 1710040200]  # wall clock, monotone across the DST gap


def test_integer_average_of_only_nulls_is_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "d long")
    assert df.select(int_div(F.sum("d"), F.count("d")).alias("a")).collect()[0].a is None


FIRST = dt.datetime(2024, 3, 4)  # a Monday
SMALL = BusinessHours(first_day=FIRST.date(), last_day=FIRST.date() + dt.timedelta(days=13))


def second_by_second(is_open, a, b):
    """Open seconds of [a, b) counted one by one."""
    return sum(is_open(a + dt.timedelta(seconds=k)) for k in range(max(0, int((b - a).total_seconds()))))


def durations(spark, cal, pairs):
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a timestamp_ntz, b timestamp_ntz")
    return [r.s for r in with_business_seconds(df, "a", "b", "s", cal).orderBy("k").collect()]


moments = st.integers(0, 14 * 86_400 - 1).map(lambda s: FIRST + dt.timedelta(seconds=s))
near = st.tuples(moments, st.integers(-600, 40_000)).map(lambda p: (p[0], min(max(p[0] + dt.timedelta(seconds=p[1]), FIRST), FIRST + dt.timedelta(seconds=14 * 86_400 - 1))))
slots = st.tuples(st.integers(0, 6), st.integers(0, 86_400), st.integers(0, 86_400)).map(lambda s: (s[0], min(s[1:]), max(s[1:])))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(weekly=st.lists(slots, min_size=1, max_size=12), special=slots, pairs=st.lists(near, min_size=1, max_size=5))
def test_several_intervals_a_day_against_a_loop(spark, weekly, special, pairs):
    day = FIRST.date() + dt.timedelta(days=7 + special[0])
    hours = BusinessHours(SMALL.first_day, SMALL.last_day, weekly=tuple(weekly), special=((day, *special[1:]),), holidays=(FIRST.date(),))

    def is_open(t):
        s = t.hour * 3600 + t.minute * 60 + t.second
        if t.date() == day:
            return special[1] <= s < special[2]
        return t.date() != FIRST.date() and any(w == t.weekday() and a <= s < z for w, a, z in weekly)

    assert durations(spark, business_calendar(spark, hours), pairs) == [second_by_second(is_open, a, b) for a, b in pairs]


spans = st.tuples(st.integers(-90_000, 15 * 86_400), st.integers(-100, 3 * 86_400)).map(lambda p: (FIRST + dt.timedelta(seconds=p[0]), FIRST + dt.timedelta(seconds=p[0] + p[1])))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(spans, max_size=12), pairs=st.lists(near, min_size=1, max_size=5))
def test_a_table_of_intervals_against_a_loop(spark, rows, pairs):
    """Overlaps, repeats, nights, intervals beyond the calendar's days, reversed and null ones."""
    table = spark.createDataFrame([*rows, *rows[:1], (None, FIRST), (FIRST, None)], "a timestamp_ntz, z timestamp_ntz")
    cal = calendar_from_intervals(table, "a", "z", SMALL)
    assert cal.count() == 14
    is_open = lambda t: any(a <= t < z for a, z in rows)
    assert durations(spark, cal, pairs) == [second_by_second(is_open, a, b) for a, b in pairs]


def test_hours_outside_a_day_raise(spark):
    with pytest.raises(ValueError):
        business_calendar(spark, BusinessHours(SMALL.first_day, SMALL.last_day, weekly=((0, 79_200, 93_600),)))


def test_too_many_intervals_raise(spark, monkeypatch):
    monkeypatch.setattr("ledgerline.functions.caltime.MAX_CALENDAR_INTERVALS", 2)
    table = spark.createDataFrame([(FIRST, FIRST + dt.timedelta(hours=1))] * 3, "a timestamp_ntz, z timestamp_ntz")
    with pytest.raises(ValueError):
        calendar_from_intervals(table, "a", "z", SMALL)
