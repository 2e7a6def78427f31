"""Business-time arithmetic as joins to a generated calendar.

``business_seconds(a, b)`` = seconds of opening hours inside ``[a, b]``.
Opening hours are disjoint intervals, several a day if need be, numbered in time with prefix sums: ``passed``
is the open time before an interval starts. With the last interval that starts at or before ``t``,
``F(t) = passed + min(t - opens, closes - opens)``, and ``business_seconds(a, b) = F(b) - F(a)``.
The calendar holds one row per day with that day's intervals as arrays. Each day begins with an empty interval
at midnight, so the as-of lookup never leaves the day of the event: two broadcast equi-joins and column
arithmetic, no Python, no per-day loop, no range join.

Intervals come from ``BusinessHours`` (by weekday, with holidays and special days) or from a table
(``calendar_from_intervals``). The calendar is broadcast: its days are held to ``MAX_CALENDAR_DAYS`` and a
table's intervals are counted and held to ``MAX_CALENDAR_INTERVALS``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.params import DAY_SECONDS, BusinessHours

MAX_CALENDAR_DAYS = 200 * 366
MAX_CALENDAR_INTERVALS = 500_000


def _days(spark: SparkSession, hours: BusinessHours) -> DataFrame:
    n = hours.n_days()
    if n > MAX_CALENDAR_DAYS:
        raise ValueError(f"calendar of {n} days is larger than {MAX_CALENDAR_DAYS}")
    return spark.range(n).select(F.date_add(F.lit(hours.first_day), F.col("id").cast("int")).alias("cal_day"))


def _slots(intervals: Sequence[tuple[int, int]]) -> Column:
    made = [F.struct(F.lit(a).alias("opens"), F.lit(b).alias("closes")) for a, b in intervals]
    return F.array(*made) if made else F.expr("cast(array() as array<struct<opens: int, closes: int>>)")


def _calendar(days: DataFrame, slots: DataFrame) -> DataFrame:
    """One row per day from disjoint ``slots`` (cal_day, opens, closes)."""
    midnight = days.select("cal_day", F.lit(0).alias("opens"), F.lit(0).alias("closes"))
    every = midnight.unionByName(slots.select("cal_day", "opens", "closes"))
    # a running total over a table of bounded size (MAX_CALENDAR_DAYS, MAX_CALENDAR_INTERVALS)
    before = Window.orderBy("cal_day", "opens", "closes").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("passed", F.coalesce(F.sum(F.col("closes") - F.col("opens")).over(before), F.lit(0)).cast("bigint"))
    slot = F.sort_array(F.collect_list(F.struct("opens", "closes", "passed")))
    return every.groupBy("cal_day").agg(slot.alias("slots")).select("cal_day", "slots.opens", "slots.closes", "slots.passed")


def business_calendar(spark: SparkSession, hours: BusinessHours) -> DataFrame:
    """Columns: ``cal_day DATE, opens ARRAY<INT>, closes ARRAY<INT>, passed ARRAY<BIGINT>``."""
    days = _days(spark, hours)
    closed = F.lit(False)
    if hours.yearly_holidays:
        md = F.month("cal_day") * 100 + F.dayofmonth("cal_day")
        closed = closed | md.isin([m * 100 + d for m, d in hours.yearly_holidays])
    if hours.holidays:
        closed = closed | F.col("cal_day").isin(list(hours.holidays))
    slots = F.when(closed, _slots([]))
    for weekday, intervals in hours.week().items():
        slots = slots.when(F.weekday("cal_day") == weekday, _slots(intervals))
    slots = slots.otherwise(_slots([]))
    for day, intervals in hours.special_days().items():
        slots = F.when(F.col("cal_day") == F.lit(day), _slots(intervals)).otherwise(slots)
    return _calendar(days, days.select("cal_day", F.inline(slots)))


def calendar_from_intervals(intervals: DataFrame, starts: str, ends: str, hours: BusinessHours) -> DataFrame:
    """The calendar of a table of opening intervals, for the days of ``hours`` (whose other fields are not
    used). Intervals may overlap, repeat and run over midnight; rows with a null side or without length count
    for nothing, and days without an interval are closed."""
    first, end = F.lit(hours.first_day), F.lit(hours.last_day + dt.timedelta(days=1))
    rows = intervals.select(F.col(starts).cast("timestamp_ntz").alias("a"), F.col(ends).cast("timestamp_ntz").alias("z"))
    rows = rows.select(F.greatest("a", first.cast("timestamp_ntz")).alias("a"), F.least("z", end.cast("timestamp_ntz")).alias("z"), (F.col("a") < F.col("z")).alias("long"))
    rows = rows.where(F.col("long") & (F.col("a") < F.col("z")))
    n = rows.count()
    if n > MAX_CALENDAR_INTERVALS:
        raise ValueError(f"calendar of {n} intervals is larger than {MAX_CALENDAR_INTERVALS}")
    last = F.to_date(F.col("z") - F.expr("interval 1 microsecond"))
    parts = rows.withColumn("cal_day", F.explode(F.sequence(F.to_date("a"), last)))
    parts = parts.select(
        "cal_day",
        F.when(F.to_date("a") < F.col("cal_day"), 0).otherwise(_secs_of_day(F.col("a"))).alias("opens"),
        F.when(F.to_date("z") > F.col("cal_day"), DAY_SECONDS).otherwise(_secs_of_day(F.col("z"))).alias("closes"),
    )
    # overlapping intervals of a day become one: a new one begins where all before have closed
    order = Window.partitionBy("cal_day").orderBy("opens", "closes")
    reach = F.max("closes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("new", F.coalesce((F.col("opens") > reach).cast("int"), F.lit(1)))
    parts = parts.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = parts.groupBy("cal_day", "part").agg(F.min("opens").alias("opens"), F.max("closes").alias("closes"))
    return _calendar(_days(intervals.sparkSession, hours), merged)


class CalendarRangeError(ValueError):
    pass


def assert_calendar_covers(df: DataFrame, columns: Sequence[str], hours: BusinessHours) -> DataFrame:
    """Raise if a time in ``columns`` falls outside the calendar (its duration would be NULL);
    return ``df`` unchanged otherwise. One aggregate job, two values per column."""
    ends = [f(F.to_date(F.col(c))).alias(f"{n}_{k}") for k, c in enumerate(columns) for n, f in (("a", F.min), ("z", F.max))]
    got = df.agg(*ends).first()
    for k, c in enumerate(columns):
        a, z = got[f"a_{k}"], got[f"z_{k}"]
        if a is not None and (a < hours.first_day or z > hours.last_day):
            raise CalendarRangeError(f"{c} runs from {a} to {z}; the calendar covers {hours.first_day} to {hours.last_day}")
    return df


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Seconds since 1970-01-01 00:00:00, independent of the session time zone.

    ``TIMESTAMP_NTZ`` is a wall-clock value, so it is counted from its own date and
    time-of-day fields (casting it to a zoned timestamp would make the result depend
    on the session zone and break monotonicity at daylight-saving gaps). A zoned
    ``TIMESTAMP`` is an instant and uses ``unix_seconds``.
    """
    dtype = df.schema[ts].dataType.typeName()
    if dtype == "timestamp_ntz":
        days = F.datediff(F.to_date(F.col(ts)), F.lit("1970-01-01").cast("date")).cast("bigint")
        return days * 86_400 + _secs_of_day(F.col(ts))
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _secs_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _position(prefix: str, ts: str) -> Column:
    """F(t): business seconds from the calendar start up to ``ts``."""
    secs = _secs_of_day(F.col(ts))
    opens, closes, passed = (F.col(f"{prefix}{c}") for c in ("opens", "closes", "passed"))
    k = F.size(F.filter(opens, lambda o: o <= secs)) - 1
    return F.get(passed, k) + F.least(secs - F.get(opens, k), F.get(closes, k) - F.get(opens, k))


def with_business_seconds(df: DataFrame, start: str, end: str, out: str, calendar: DataFrame) -> DataFrame:
    """Add ``out`` = business seconds between ``start`` and ``end`` (BIGINT).

    NULL when either side is NULL or falls outside the calendar; 0 when ``end`` is
    before ``start``.
    """
    # days and intervals are held to MAX_CALENDAR_DAYS and MAX_CALENDAR_INTERVALS where the calendar is made
    cal = F.broadcast(calendar)
    a = cal.select(*[F.col(c).alias(f"_a_{c}") for c in calendar.columns])
    b = cal.select(*[F.col(c).alias(f"_b_{c}") for c in calendar.columns])
    joined = df.join(a, F.to_date(F.col(start)) == F.col("_a_cal_day"), "left").join(
        b, F.to_date(F.col(end)) == F.col("_b_cal_day"), "left"
    )
    # an interval that ends before it starts holds no business time
    value = F.greatest(_position("_b_", end) - _position("_a_", start), F.lit(0))
    known = F.col("_a_cal_day").isNotNull() & F.col("_b_cal_day").isNotNull()
    joined = joined.withColumn(out, F.when(known, value).cast("bigint"))
    return joined.drop(*[c for c in joined.columns if c.startswith("_a_") or c.startswith("_b_")])


def format_hms(seconds: Column) -> Column:
    """``HH:MM:SS`` with hours not wrapped (360000 -> ``100:00:00``); NULL stays NULL."""
    s = seconds.cast("bigint")
    text = F.format_string(
        "%02d:%02d:%02d", int_div(s, 3600), int_div(s, 60) % 60, s % 60
    )
    return F.when(s.isNull(), F.lit(None).cast("string")).otherwise(text)


def int_div(num: Column, den) -> Column:
    """Integer division truncating toward zero (SQL ``div``), exact for every BIGINT."""
    n = num.cast("bigint")
    d = (den if isinstance(den, Column) else F.lit(den)).cast("bigint")
    # a zero divisor (e.g. an average over only NULL durations) gives NULL, as AVG does
    return F.call_function("div", n, F.nullif(d, F.lit(0).cast("bigint")))


def yyyymm(ts: Column) -> Column:
    """Year-month as an integer, ``year * 100 + month``."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")
