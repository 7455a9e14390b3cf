"""Cleaned tables and per-reading health indicators.

Every function takes raw or cleaned frames and works on batch frames and streams alike: all
of them are projections, except the device lookup of ``telemetry_clean``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from plantwatch.functions.bands import flag, outside, score, trend
from plantwatch.functions.timefns import calendar_days, hour_of, repair_ts, whole_second_hours
from plantwatch.operators.lookup import lookup_join
from plantwatch.params import ACTIVE_STATUSES, SENSORS, HealthBands


def _tidy(name: str) -> Column:
    return F.trim(F.lower(name))


# Devices are few beside their readings and have one row each: no sort of the readings for them.
device_join = partial(lookup_join, shuffled="shuffle_hash")


def telemetry_clean(
    telemetry: DataFrame, device_master: DataFrame, dim_bytes: int | None = None,
    join: Callable[..., DataFrame] = device_join,
) -> DataFrame:
    """Readings of active devices with repaired time, device attributes and day counts.

    Location and facility come from the device master, never from the reading. The status is
    compared as written: a status with stray case or blanks does not count as active.
    ``join``: how devices are looked up, ``split_lookup_join`` in micro-batches with busy devices.
    """
    devices = device_master.filter(F.col("status").isin(*ACTIVE_STATUSES)).select(
        "device_id",
        "device_type",
        "location",
        "facility",
        "manufacturer",
        "model",
        # Days, so that they are found once a device and not once a reading.
        F.to_date(repair_ts("installation_date")).alias("_installed"),
        F.to_date(repair_ts("last_maintenance")).alias("_maintained"),
        F.to_date(repair_ts("next_scheduled_maintenance")).alias("_next"),
    )
    readings = telemetry.select(
        "device_id", repair_ts("timestamp").alias("timestamp"), *SENSORS, "ingestion_time"
    )
    ts, day = F.col("timestamp"), F.to_date("timestamp")
    return join(readings, devices, "device_id", "inner", dim_bytes).select(
        "device_id",
        "timestamp",
        hour_of(ts).alias("reading_hour"),
        day.alias("reading_date"),
        F.hour(ts).alias("hour_of_day"),
        F.dayofweek(day).alias("day_of_week"),
        "device_type",
        "location",
        "facility",
        "manufacturer",
        "model",
        *SENSORS,
        calendar_days(day, F.col("_installed")).alias("days_since_installation"),
        calendar_days(day, F.col("_maintained")).alias("days_since_last_maintenance"),
        calendar_days(F.col("_next"), day).alias("days_to_next_maintenance"),
        "ingestion_time",
    )


def device_master_clean(device_master: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Typed, tidied devices with their age and maintenance clocks on the day ``as_of``."""
    today = F.current_date() if as_of is None else as_of
    installed = repair_ts("installation_date")
    maintained = repair_ts("last_maintenance")
    upcoming = repair_ts("next_scheduled_maintenance")
    return device_master.select(
        "device_id",
        _tidy("device_type").alias("device_type"),
        F.trim("location").alias("location"),
        F.trim("facility").alias("facility"),
        installed.alias("installation_date"),
        "firmware_version",
        "model",
        "manufacturer",
        _tidy("status").alias("status"),
        maintained.alias("last_maintenance"),
        upcoming.alias("next_scheduled_maintenance"),
        calendar_days(today, installed).alias("device_age_days"),
        calendar_days(today, maintained).alias("days_since_last_maintenance"),
        calendar_days(upcoming, today).alias("days_to_next_maintenance"),
        flag(calendar_days(upcoming, today) < 0).alias("maintenance_overdue"),
        "ingestion_time",
    )


def maintenance_clean(maintenance: DataFrame) -> DataFrame:
    """Typed maintenance events with duration in hours and lateness."""
    done, planned = repair_ts("maintenance_date"), repair_ts("scheduled_date")
    return maintenance.select(
        "device_id",
        "maintenance_id",
        _tidy("maintenance_type").alias("maintenance_type"),
        done.alias("maintenance_date"),
        planned.alias("scheduled_date"),
        "duration_minutes",
        (F.col("duration_minutes") / F.lit(60.0)).alias("duration_hours"),
        flag(done > planned).alias("maintenance_overdue"),
        calendar_days(done, planned).alias("delay_days"),
        F.trim("technician").alias("technician"),
        "description",
        "parts_replaced",
        "cost",
        "ingestion_time",
    )


# Score per severity.
SEVERITY_SCORES = {"critical": 3, "major": 2, "minor": 1}


def failures_clean(failures: DataFrame, normalise_first: bool = False) -> DataFrame:
    """Typed failures with downtime, severity score and time parts.

    The score reads the severity as written, so `` Critical `` scores 0 although it is listed
    as ``critical``; ``normalise_first`` scores the tidied text instead.
    """
    failed, repaired = repair_ts("failure_timestamp"), repair_ts("repair_timestamp")
    severity = _tidy("severity")
    scored = severity if normalise_first else F.col("severity")
    points = F.lit(0)
    for name, value in SEVERITY_SCORES.items():
        points = F.when(scored == name, F.lit(value)).otherwise(points)
    return failures.select(
        "device_id",
        "failure_id",
        failed.alias("failure_timestamp"),
        repaired.alias("repair_timestamp"),
        _tidy("failure_type").alias("failure_type"),
        severity.alias("severity"),
        points.alias("failure_severity_score"),
        whole_second_hours(repaired, failed).alias("downtime_hours"),
        F.hour(failed).alias("failure_hour"),
        F.dayofweek(failed).alias("failure_day_of_week"),
        "root_cause",
        "repair_action",
        "cost",
        "ingestion_time",
    )


def device_health_metrics(clean: DataFrame, bands: HealthBands = HealthBands()) -> DataFrame:
    """Per-reading trend and anomaly indicators from fixed bands."""
    temperature, vibration = F.col("temperature"), F.col("vibration")
    pressure, power = F.col("pressure"), F.col("power_consumption")
    return clean.select(
        "device_id",
        "timestamp",
        "device_type",
        "location",
        "facility",
        "temperature",
        "pressure",
        "vibration",
        "power_consumption",
        trend(temperature, bands.temp_1h).alias("temp_1h_trend"),
        trend(temperature, bands.temp_short, 2.0).alias("temp_short_trend"),
        trend(vibration, bands.vibration).alias("vibration_trend"),
        trend(pressure, bands.pressure).alias("pressure_trend"),
        trend(power, bands.power).alias("power_trend"),
        score(outside(temperature, bands.temp_anomaly)).alias("temp_anomaly_score"),
        score(vibration > bands.vibration_anomaly_above).alias("vibration_anomaly_score"),
        score(outside(pressure, bands.pressure_anomaly)).alias("pressure_anomaly_score"),
        "days_since_last_maintenance",
        "days_to_next_maintenance",
    )
