"""Exploration reports over the raw entities (timestamps repaired first).

Day counts here are whole elapsed 24-hour periods, unlike the calendar days of the cleaned
tables. A "reading" is one non-missing sensor value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plantwatch.functions.statfns import percent
from plantwatch.functions.timefns import elapsed_days, elapsed_hours, repair_ts
from plantwatch.operators.correlate import with_ordinal_codes
from plantwatch.operators.profile import pooled_by, readings_by, readings_in_row
from plantwatch.params import SENSORS


def device_clocks(device_master: DataFrame, now: Column) -> DataFrame:
    """Devices with age, days since and days to maintenance at the instant ``now``."""
    return device_master.withColumns({
        "device_age_days": elapsed_days(now, repair_ts("installation_date")),
        "days_since_maintenance": elapsed_days(now, repair_ts("last_maintenance")),
        "days_to_next_maintenance": elapsed_days(repair_ts("next_scheduled_maintenance"), now),
    })


def timed(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumn("timestamp", repair_ts("timestamp"))


def telemetry_extent(telemetry: DataFrame) -> DataFrame:
    """Readings, devices, sensors in use, first and last time, whole days between (one row)."""
    t = timed(telemetry).withColumn("_n", readings_in_row())
    used = reduce(lambda a, b: a + b, [(F.count(c) > 0).cast("int") for c in SENSORS])
    seen = F.col("_n") > 0
    first, last = F.min(F.when(seen, F.col("timestamp"))), F.max(F.when(seen, F.col("timestamp")))
    return t.agg(
        F.sum("_n").alias("readings"),
        F.count_distinct(F.when(seen, F.col("device_id"))).alias("devices"),
        used.alias("reading_types"),
        first.alias("first_time"),
        last.alias("last_time"),
    ).withColumn("days", elapsed_days(F.col("last_time"), F.col("first_time")))


def readings_per_device(telemetry: DataFrame) -> DataFrame:
    return (
        telemetry.groupBy("device_id")
        .agg(F.sum(readings_in_row()).alias("readings"))
        .filter(F.col("device_id").isNotNull() & (F.col("readings") > 0))
    )


def readings_by_hour(telemetry: DataFrame) -> DataFrame:
    return readings_by(timed(telemetry), F.hour("timestamp"), "hour")


def readings_by_weekday(telemetry: DataFrame) -> DataFrame:
    """Monday is 0."""
    return readings_by(timed(telemetry), F.weekday("timestamp"), "weekday")


def readings_by_date(telemetry: DataFrame) -> DataFrame:
    return readings_by(timed(telemetry), F.to_date("timestamp"), "date")


def peak_and_low_hour(telemetry: DataFrame) -> DataFrame:
    """Busiest and quietest hour of the day; the earlier hour wins a tie (one row)."""
    by_hour = readings_by_hour(telemetry)
    return by_hour.agg(
        F.max_by("hour", F.struct("readings", -F.col("hour"))).alias("peak_hour"),
        F.max("readings").alias("peak_readings"),
        F.min_by("hour", F.struct("readings", "hour")).alias("low_hour"),
        F.min("readings").alias("low_readings"),
    )


def device_time_points(telemetry: DataFrame) -> DataFrame:
    """Readings and distinct times per device.

    Grouped by device and time first, so one busy device is spread over many reducers.
    """
    points = (
        timed(telemetry)
        .groupBy("device_id", "timestamp")
        .agg(F.sum(readings_in_row()).alias("_n"))
        .filter("_n > 0")
    )
    return (
        points.groupBy("device_id")
        .agg(F.sum("_n").alias("readings"), F.count("timestamp").alias("time_points"))
        .filter("device_id IS NOT NULL")
    )


def failure_totals(failures: DataFrame) -> DataFrame:
    """Failures, affected devices, percentage resolved (one row)."""
    return failures.agg(
        F.count(F.lit(1)).alias("failures"),
        F.count_distinct("device_id").alias("devices"),
        percent(F.count(repair_ts("repair_timestamp")), F.count(F.lit(1))).alias("resolution_rate_pct"),
    )


def failures_by_facility(failures: DataFrame, device_master: DataFrame) -> DataFrame:
    """Failures per facility, most first; failures are counted per device before the join."""
    per_device = failures.groupBy("device_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = per_device.join(device_master.select("device_id", "facility"), "device_id")
    return (
        joined.groupBy("facility").agg(F.sum("_n").alias("failures"))
        .filter("facility IS NOT NULL")
        .orderBy(F.desc("failures"), "facility")
    )


def resolution_times(failures: DataFrame) -> DataFrame:
    """Hours from failure to repair of each resolved failure."""
    hours = elapsed_hours(repair_ts("repair_timestamp"), repair_ts("failure_timestamp"))
    return failures.select("failure_id", hours.alias("resolution_hours")).filter(
        "resolution_hours IS NOT NULL"
    )


def maintenance_totals(maintenance: DataFrame) -> DataFrame:
    return maintenance.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("device_id").alias("devices"),
        F.avg("cost").alias("avg_cost"),
        F.sum("cost").alias("total_cost"),
    )


def cost_by_type(maintenance: DataFrame) -> DataFrame:
    return maintenance.groupBy("maintenance_type").agg(
        F.avg("cost").alias("avg_cost"),
        F.sum("cost").alias("total_cost"),
        F.count("cost").alias("records"),
    )


def schedule_adherence(maintenance: DataFrame) -> DataFrame:
    """On-time, early and late events and the mean variance in elapsed days (one row)."""
    days = elapsed_days(repair_ts("maintenance_date"), repair_ts("scheduled_date"))
    v = maintenance.select(days.alias("v"))
    return v.agg(
        F.count(F.when(F.col("v") == 0, 1)).alias("on_time"),
        F.count(F.when(F.col("v") < 0, 1)).alias("early"),
        F.count(F.when(F.col("v") > 0, 1)).alias("late"),
        F.avg("v").alias("avg_delay_days"),
    )


def with_duration_hours(maintenance: DataFrame) -> DataFrame:
    return maintenance.withColumn("duration_hours", F.col("duration_minutes") / F.lit(60.0))


SUMMARY_CATEGORIES = ("device_type", "facility", "manufacturer", "status")
SUMMARY_NUMBERS = (
    "device_age_days",
    "days_since_maintenance",
    "avg_reading",
    "reading_std",
    "reading_count",
    "poor_quality_ratio",
    "failure_count",
    "high_severity_count",
    "unresolved_count",
    "total_maintenance_cost",
    "maintenance_count",
    "avg_maintenance_cost",
    "total_maintenance_hours",
)
SUMMARY_CODES = tuple(f"{c}_encoded" for c in SUMMARY_CATEGORIES)


def device_summary(
    device_master: DataFrame,
    telemetry: DataFrame,
    failures: DataFrame,
    maintenance: DataFrame,
    now: Column,
    high_severity: str = "critical",
) -> DataFrame:
    """One row per device: clocks, telemetry, failure and maintenance figures, category codes.

    Every event table shrinks to one row per device before it is joined, and all sides are
    then partitioned by the device, so the joins add no exchange of event rows. Gaps become 0,
    missing categories "Unknown".
    """
    devices = device_clocks(device_master, now).select(
        "device_id",
        *[F.coalesce(c, F.lit("Unknown")).alias(c) for c in SUMMARY_CATEGORIES],
        "device_age_days",
        "days_since_maintenance",
    )
    readings = pooled_by(telemetry, "device_id", poor=F.col("quality") == "poor")
    readings = readings.select(
        "device_id",
        "reading_count",
        *[F.round(c, 4).alias(c) for c in ("avg_reading", "reading_std", "poor_quality_ratio")],
    )
    failed = failures.groupBy("device_id").agg(
        F.count("failure_id").alias("failure_count"),
        F.count(F.when(F.col("severity") == high_severity, 1)).alias("high_severity_count"),
        F.count(F.when(F.col("repair_timestamp").isNull(), 1)).alias("unresolved_count"),
    )
    kept = with_duration_hours(maintenance).groupBy("device_id").agg(
        F.sum("cost").alias("total_maintenance_cost"),
        F.count("cost").alias("maintenance_count"),
        F.avg("cost").alias("avg_maintenance_cost"),
        F.sum("duration_hours").alias("total_maintenance_hours"),
    )
    joined = with_ordinal_codes(devices, list(SUMMARY_CATEGORIES))
    for side in (readings, failed, kept):
        joined = joined.join(side, "device_id", "left")
    joined = joined.fillna(0, list(SUMMARY_NUMBERS))
    return joined.select("device_id", *SUMMARY_CATEGORIES, *SUMMARY_NUMBERS, *SUMMARY_CODES)


def headline_kpis(
    device_master: DataFrame, telemetry: DataFrame, failures: DataFrame, maintenance: DataFrame
) -> DataFrame:
    """Headline figures as (metric, value) rows, one aggregate per entity."""

    def rows(df: DataFrame, **metrics: Column) -> DataFrame:
        one = df.agg(*[v.cast("double").alias(k) for k, v in metrics.items()])
        return one.select(F.inline(F.array(*[
            F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in metrics
        ])))

    n = F.count(F.lit(1))
    readings = F.sum(readings_in_row())
    poor = F.sum(F.when(F.col("quality") == "poor", readings_in_row()).otherwise(0))
    seen = F.count_distinct(F.when(readings_in_row() > 0, F.col("device_id")))
    device_total = device_master.agg(n.alias("n")).scalar()
    parts = [
        rows(
            device_master,
            devices=n,
            active_devices=F.count(F.when(F.col("status") == "active", 1)),
            active_pct=percent(F.count(F.when(F.col("status") == "active", 1)), n),
        ),
        rows(
            telemetry,
            readings=readings,
            poor_quality_pct=percent(poor, readings),
            readings_per_device=readings / seen,
        ),
        rows(
            failures,
            failures=n,
            resolution_rate_pct=percent(F.count(repair_ts("repair_timestamp")), n),
            failures_per_device=n / device_total,
        ),
        rows(
            maintenance,
            maintenance_records=n,
            avg_maintenance_cost=F.avg("cost"),
            total_maintenance_cost=F.sum("cost"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
