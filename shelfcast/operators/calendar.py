"""Date dimension: holidays, seasons, distance to the next event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.domain import inline_table
from shelfcast.functions.columns import is_weekend, season, weekday


def day_range(bounds: DataFrame, extra_days: int = 0) -> DataFrame:
    """One row per day between the ``lo`` and ``hi`` of a one-row frame."""
    return bounds.select(F.explode(F.sequence("lo", F.date_add("hi", extra_days))).alias("day"))


def holiday_dates(spark: SparkSession, bounds: DataFrame, rules, ahead: int = 30) -> DataFrame:
    """Dates of yearly (month, day, name) rules inside the range plus ``ahead`` days."""
    fixed = inline_table(spark, rules, ["h_month", "h_day", "holiday_name"])
    days = day_range(bounds, ahead)
    return days.join(
        F.broadcast(fixed), (F.month("day") == F.col("h_month")) & (F.dayofmonth("day") == F.col("h_day"))
    ).select(F.col("day").alias("holiday_date"), "holiday_name")


def best_holiday(candidates: DataFrame) -> DataFrame:
    """One name per date: lowest priority number first, then arrival order."""
    return candidates.groupBy("holiday_date").agg(
        F.min_by("holiday_name", F.struct("priority", "position", "holiday_name")).alias("holiday_name")
    )


def next_event_days(days: DataFrame, events: DataFrame, horizon: int = 30) -> DataFrame:
    """Days until the next event strictly after each day, 0 if none within the horizon.

    Every event is spread over the days before it, which turns the range
    condition into an equality join.
    """
    reach = events.select(F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("ahead"), "holiday_date").select(
        F.date_sub("holiday_date", F.col("ahead")).alias("day"), "ahead"
    )
    nearest = reach.groupBy("day").agg(F.min("ahead").alias("ahead"))
    return days.join(nearest, "day", "left").select(
        "day", F.coalesce("ahead", F.lit(0)).cast("bigint").alias("event_nearby_days")
    )


def calendar_table(bounds: DataFrame, holidays: DataFrame) -> DataFrame:
    """The date dimension. Its size depends on the period only, never on the sales."""
    days = day_range(bounds)
    near = next_event_days(days, holidays)
    return near.join(holidays.withColumnRenamed("holiday_date", "day"), "day", "left").select(
        "day",
        F.col("holiday_name").isNotNull().alias("is_holiday"),
        F.coalesce("holiday_name", F.lit("")).alias("holiday_name"),
        season(F.month("day")).alias("season"),
        weekday("day").alias("day_of_week"),
        is_weekend("day").alias("is_weekend"),
        F.month("day").cast("bigint").alias("month"),
        "event_nearby_days",
    )


def expand_yearly_events(years: DataFrame, rules) -> DataFrame:
    """Yearly (type, month, first day, days) rules for every year, as start and end dates.

    The rules are a fixed handful, carried along each year as a literal array.
    """
    names = ["event_type", "month", "day", "days"]
    rule = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rules])
    return (
        years.select("year", F.explode(rule).alias("r"))
        .withColumn("start_date", F.make_date(F.col("year"), F.col("r.month"), F.col("r.day")))
        .select(
            F.concat_ws("-", "r.event_type", F.date_format("start_date", "yyyyMMdd")).alias("event_id"),
            "r.event_type",
            "start_date",
            F.date_add("start_date", F.col("r.days") - 1).alias("end_date"),
        )
    )


def parse_compact_date(c):
    """``yyyymmdd`` text into a date, NULL when it is not one."""
    return F.when(F.col(c).rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(F.col(c), F.lit("yyyyMMdd"))))
