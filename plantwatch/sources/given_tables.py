"""The four raw entities, derived from the given tables.

customer ⋈ nation ⋈ region gives the devices, events give telemetry (a one-hour burst of
twelve readings each) and, where they are errors, failures; orders give maintenance. All
timestamps are encoded as raw text, so timestamp repair is really exercised, and the rules
below plant the irregularities that the quality rules look for.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantwatch.functions.timefns import raw_text
from plantwatch.operators.lookup import frame_bytes

# Vocabularies of the entities.
DEVICE_TYPES = (
    "temperature_sensor",
    "humidity_sensor",
    "pressure_sensor",
    "vibration_sensor",
    "flow_meter",
    "power_meter",
    "smart_valve",
    "motor_controller",
)
FAILURE_TYPES = (
    "sensor_malfunction",
    "communication_failure",
    "power_failure",
    "mechanical_failure",
    "software_error",
    "calibration_drift",
)
MAINTENANCE_TYPES = ("preventive", "corrective", "predictive", "emergency")
PART_NAMES = ("sensor", "cable", "filter")
READINGS_PER_EVENT = 12
HOUR_FORMAT = "yyyy-MM-dd'T'HH:"
ROWS_PER_TASK = 1_000_000
ARRIVAL = "2024-02-01 00:00:00"


def _id8(key: Column) -> Column:
    return F.concat(F.lit("DEV_"), F.lpad(key.cast("string"), 6, "0"))


def _pick(words: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (index + 1).cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


class Entities:
    """Lazy frames over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.arrival = _ts(ARRIVAL)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _read_spread(self, name: str, key: str, rows_each: int = 1) -> DataFrame:
        """A table dealt out to all cores in ranges of its key, each in order.

        A file is read by one task per row group, which may be a million rows: as it lies, a table that
        grows to ``rows_each`` times its rows would keep a few cores busy only. A task makes about
        ``ROWS_PER_TASK`` rows. Neighbours stay together and in order, so averages over a few
        neighbouring rows add up in the same order at any size.
        """
        df = self._read(name)
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-df.count() * rows_each // ROWS_PER_TASK))
        return df.repartitionByRange(tasks, key).sortWithinPartitions(key)

    @cached_property
    def device_bytes(self) -> int:
        """Measured for each run; decides whether lookups may broadcast the devices."""
        return frame_bytes(self.device_master)

    @cached_property
    def device_master(self) -> DataFrame:
        # nation and region have 25 and 5 rows at every scale.
        c = (
            self._read("customer")
            .join(F.broadcast(self._read("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(self._read("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        k = F.col("c_custkey")
        kind = _pick(DEVICE_TYPES, k % 8)
        blank = F.when(k % 43 == 0, F.lit(" ")).otherwise(F.lit(""))
        status = (
            F.when(k % 53 == 0, " Active ")
            .when(k % 20 <= 15, "active")
            .when(k % 20 <= 17, "inactive")
            .when(k % 20 == 18, "maintenance")
            .otherwise("failed")
        )
        installed = F.when(k % 71 == 0, _ts("2024-01-20")).otherwise(
            _ts("2021-01-01") + _days(k * 7919 % 1000)
        )
        maintained = F.when(k % 50 == 0, _ts("2022-06-01")).otherwise(
            _ts("2023-06-01") + _days(k * 13 % 240) + _hours(k % 24)
        )
        return c.select(
            _id8(k).alias("device_id"),
            F.when(k % 37 == 0, F.concat(F.lit("  "), F.upper(kind), F.lit(" ")))
            .otherwise(kind).alias("device_type"),
            F.concat("n_name", blank).alias("location"),
            F.concat("r_name", blank).alias("facility"),
            raw_text(installed).alias("installation_date"),
            F.concat((k % 5 + 1).cast("string"), F.lit("."), (k % 10).cast("string"), F.lit(".0"))
            .alias("firmware_version"),
            F.concat(F.lit("MODEL-"), (k % 900 + 100).cast("string")).alias("model"),
            F.when(k % 211 != 0, F.concat(F.lit("MFR_"), (k % 5).cast("string"))).alias("manufacturer"),
            status.alias("status"),
            F.when(k % 41 != 0, raw_text(maintained)).alias("last_maintenance"),
            raw_text(_ts("2024-01-10") + _days(k * 7 % 60)).alias("next_scheduled_maintenance"),
            self.arrival.alias("ingestion_time"),
        )

    @cached_property
    def telemetry(self) -> DataFrame:
        ts, text = F.col("ts").cast("timestamp"), F.col("text")
        # An event's time becomes text twice; its readings, within an hour from it, differ in hour and minute only.
        # (The offset of a time zone changes on the hour.)
        events = self._read_spread("events", "event_id", READINGS_PER_EVENT).select(
            F.col("event_id").alias("e"), "user_id", "value", F.minute(ts).alias("minute"), raw_text(ts).alias("text"),
            F.date_format(ts + _hours(F.lit(1)), HOUR_FORMAT).alias("next_hour"),
        ).select("*", F.explode(F.sequence(F.lit(0), F.lit(READINGS_PER_EVENT - 1))).alias("r"))
        e, r = F.col("e"), F.col("r")
        minute = F.col("minute") + r * 5
        hour = F.when(minute < 60, F.substring(text, 1, 14)).otherwise(F.col("next_hour"))
        # After the minute: seconds and fraction, or seconds alone.
        rest = F.when(e % 500 == 0, F.substring(text, 17, 3)).otherwise(F.substring(text, 17, 17))
        timestamp = F.concat(hour, F.lpad((minute % 60).cast("string"), 2, "0"), rest)
        temperature = F.when(e % 997 == 0, F.lit(200.0)).otherwise(
            F.lit(45.0) + F.least(F.col("value"), F.lit(45.0)) + r % 3
        )
        return events.select(
            F.when(e % 2003 == 0, "").when(e % 1009 == 0, "DEV_UNKNOWN").otherwise(_id8(F.col("user_id")))
            .alias("device_id"),
            timestamp.alias("timestamp"),
            F.when((e + r) % 20 != 0, temperature).alias("temperature"),
            (500 + e * 37 % 1000 + r).cast("double").alias("pressure"),
            F.when(e % 991 == 0, F.lit(-1.0)).otherwise((e * 11 % 130).cast("double") / 10).alias("vibration"),
            (e * 17 % 104).cast("double").alias("humidity"),
            F.when(e % 983 == 0, F.lit(-5.0)).otherwise((50 + e * 29 % 550).cast("double"))
            .alias("power_consumption"),
            (10 + e * 3 % 40).cast("double").alias("flow_rate"),
            (e % 101).cast("double").alias("valve_position"),
            (1000 + e * 53 % 2000).cast("double").alias("motor_speed"),
            F.lit("STALE").alias("location"),
            F.lit("STALE").alias("facility"),
            F.when(e % 50 == 0, "poor").when(e % 50 <= 4, "fair").otherwise("good").alias("quality"),
            self.arrival.alias("ingestion_time"),
        )

    @cached_property
    def failures(self) -> DataFrame:
        events = self._read_spread("events", "event_id").filter("event_type = 'error'")
        e, ts = F.col("event_id"), F.col("ts").cast("timestamp")
        kind = _pick(FAILURE_TYPES, e % 6)
        severity = (
            F.when(e % 97 == 0, "unknown")
            .when(e % 31 == 0, " Critical ")
            .when(e % 10 <= 3, "minor")
            .when(e % 10 <= 7, "major")
            .otherwise("critical")
        )
        repaired = ts + _hours(e % 72 + 1) + _minutes(e % 60)
        return events.select(
            _id8(F.col("user_id")).alias("device_id"),
            F.concat(F.lit("FAIL_"), e.cast("string")).alias("failure_id"),
            raw_text(ts).alias("failure_timestamp"),
            F.when(e % 7 != 0, raw_text(repaired)).alias("repair_timestamp"),
            F.when(e % 29 == 0, F.upper(kind)).otherwise(kind).alias("failure_type"),
            severity.alias("severity"),
            F.concat(F.lit("cause_"), (e % 7).cast("string")).alias("root_cause"),
            F.concat(F.lit("action_"), (e % 6).cast("string")).alias("repair_action"),
            (F.col("value") * 30).alias("cost"),
            self.arrival.alias("ingestion_time"),
        )

    @cached_property
    def maintenance(self) -> DataFrame:
        orders = self._read_spread("orders", "o_orderkey")
        o, planned = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
        kind = F.when(o % 33 == 0, " Preventive ").otherwise(_pick(MAINTENANCE_TYPES, o % 4))
        minutes = F.when(o % 503 == 0, F.lit(-30)).otherwise((60 + o % 421).cast("int"))
        parts = F.array_join(
            F.slice(F.array(*map(F.lit, PART_NAMES)), F.lit(1), (o % 4).cast("int")), ", "
        )
        return orders.select(
            F.when(o % 1511 != 0, _id8(F.col("o_custkey"))).alias("device_id"),
            F.concat(F.lit("MAINT_"), o.cast("string")).alias("maintenance_id"),
            kind.alias("maintenance_type"),
            raw_text(planned + _hours(o % 73 - 24)).alias("maintenance_date"),
            raw_text(planned).alias("scheduled_date"),
            F.when(o % 19 != 0, minutes).alias("duration_minutes"),
            F.concat(F.lit(" TECH_"), (1001 + o % 50).cast("string")).alias("technician"),
            F.lit("note").alias("description"),
            parts.alias("parts_replaced"),
            (F.col("o_totalprice") / 100).alias("cost"),
            self.arrival.alias("ingestion_time"),
        )

    def raw(self) -> dict[str, DataFrame]:
        return {
            "device_master": self.device_master,
            "telemetry": self.telemetry,
            "maintenance": self.maintenance,
            "failures": self.failures,
        }
