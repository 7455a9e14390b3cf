"""Hand-made edge rows for the cleaned tables and thresholds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plantwatch.functions.timefns import calendar_days, elapsed_days, repair_ts
from plantwatch.operators.rules import (
    DEVICE_RULES, FAILURE_RULES, MAINTENANCE_RULES, TELEMETRY_RULES, rule_metrics,
)
from plantwatch.plans import gold, silver
from plantwatch.schemas import DEVICE_MASTER_DDL, FAILURES_DDL, TELEMETRY_DDL, columns_of


def test_timestamp_repair(spark):
    texts = [
        ("2025-10-16T16:32:31.590002.000000", "2025-10-16 16:32:31.590002"),
        ("2025-10-16T16:32:31.000000", "2025-10-16 16:32:31"),
        ("2025-10-16T16:32:31", None),
        ("", None),
        ("garbage", None),
        (None, None),
    ]
    df = spark.createDataFrame(texts, "raw string, expected string")
    for row in df.select(repair_ts("raw").cast("string").alias("got"), "expected").collect():
        assert row.got == row.expected


def test_two_ways_of_counting_days(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 00:01:00' AS b, timestamp'2024-01-01 23:59:00' AS a")
    row = df.select(
        calendar_days(F.col("b"), F.col("a")).alias("calendar"),
        elapsed_days(F.col("b"), F.col("a")).alias("elapsed"),
        elapsed_days(F.col("a"), F.col("b")).alias("early"),
    ).first()
    assert (row.calendar, row.elapsed, row.early) == (1, 0, -1)


@pytest.mark.parametrize(
    "column,value,expected",
    [
        ("temperature", 75.0, {"temp_1h_trend": 0.0}),
        ("temperature", 75.1, {"temp_1h_trend": 1.0, "temp_short_trend": 0.0}),
        ("temperature", 65.0, {"temp_1h_trend": 0.0}),
        ("temperature", 64.9, {"temp_1h_trend": -1.0}),
        ("temperature", 80.1, {"temp_short_trend": 2.0}),
        ("temperature", 59.9, {"temp_short_trend": -2.0, "temp_anomaly_score": 0.0}),
        ("temperature", 85.0, {"temp_anomaly_score": 0.0}),
        ("temperature", 85.1, {"temp_anomaly_score": 1.0}),
        ("temperature", 54.9, {"temp_anomaly_score": 1.0}),
        ("temperature", None, {"temp_1h_trend": 0.0, "temp_short_trend": 0.0, "temp_anomaly_score": 0.0}),
        ("vibration", 8.0, {"vibration_trend": 0.0}),
        ("vibration", 8.1, {"vibration_trend": 1.0, "vibration_anomaly_score": 0.0}),
        ("vibration", 1.9, {"vibration_trend": -1.0}),
        ("vibration", 10.1, {"vibration_anomaly_score": 1.0}),
        ("pressure", 1200.1, {"pressure_trend": 1.0, "pressure_anomaly_score": 0.0}),
        ("pressure", 799.9, {"pressure_trend": -1.0}),
        ("pressure", 1400.1, {"pressure_anomaly_score": 1.0}),
        ("pressure", 599.9, {"pressure_anomaly_score": 1.0}),
        ("power_consumption", 500.1, {"power_trend": 1.0}),
        ("power_consumption", 99.9, {"power_trend": -1.0}),
        ("power_consumption", 100.0, {"power_trend": 0.0}),
    ],
)
def test_health_bands(spark, column, value, expected):
    base = dict.fromkeys(("temperature", "pressure", "vibration", "power_consumption"))
    base[column] = value
    df = spark.createDataFrame([tuple(base.values())], ", ".join(f"{c} double" for c in base)).withColumns({
        **{c: F.lit("x") for c in ("device_id", "device_type", "location", "facility")},
        "timestamp": F.lit("2024-01-01").cast("timestamp"),
        "days_since_last_maintenance": F.lit(1),
        "days_to_next_maintenance": F.lit(1),
    })
    row = silver.device_health_metrics(df).first()
    assert {k: row[k] for k in expected} == expected


def _failures(spark, severities):
    rows = [("D", f"F{i}", "2024-01-01T10:00:00.500000.000000", "2024-01-01T12:30:00.400000.000000",
             " Power_Failure", s, None, None, 1.0) for i, s in enumerate(severities)]
    return spark.createDataFrame(rows, FAILURES_DDL).withColumn("ingestion_time", F.current_timestamp())


def test_severity_score_reads_text_as_written(spark):
    df = _failures(spark, ["critical", " Critical ", "MAJOR", "major", "minor", "low", None])
    rows = silver.failures_clean(df).orderBy("failure_id").collect()
    assert [r.failure_severity_score for r in rows] == [3, 0, 0, 2, 1, 0, 0]
    assert [r.severity for r in rows] == ["critical", "critical", "major", "major", "minor", "low", None]
    assert {r.failure_type for r in rows} == {"power_failure"}
    assert rows[0].downtime_hours == 2.5  # whole seconds
    tidy = silver.failures_clean(df, normalise_first=True).orderBy("failure_id").collect()
    assert [r.failure_severity_score for r in tidy] == [3, 3, 2, 2, 1, 0, 0]


def test_labels(spark):
    df = silver.failures_clean(_failures(spark, ["minor", "unknown"]))
    rows = gold.failure_labels(df).orderBy("hours_before_failure").collect()
    assert [r.hours_before_failure for r in rows] == list(range(6, 169, 6))
    assert str(rows[0].prediction_hour) == "2024-01-01 04:00:00"
    assert [r.days_before_failure for r in rows[:4]] == [0.3, 0.5, 0.8, 1.0]
    assert {r.will_fail for r in rows} == {1}


def test_label_fan_out_and_nearest(spark):
    features = spark.sql("""
        SELECT 'D' device_id, timestamp'2024-01-01 04:00:00' hour_bucket, 't' device_type, 'l' location,
               12L reading_count, 1D avg_temperature, 1D avg_vibration, 1D avg_pressure, 1D avg_power,
               0 high_temperature, 0 high_vibration, 0 needs_maintenance_soon, 1D health_score, 5 days_since_maintenance
        UNION ALL SELECT 'E', timestamp'2024-01-01 04:00:00', 't', 'l', 9L, 1D, 1D, 1D, 1D, 0, 0, 0, 1D, 5""")
    failures = spark.sql("""
        SELECT 'D' device_id, timestamp'2024-01-01 10:00:00' failure_timestamp, 'a' failure_type, 'minor' severity
        UNION ALL SELECT 'D', timestamp'2024-01-01 16:10:00', 'b', 'major'""")
    labels = gold.failure_labels(failures)
    rows = gold.ml_features(features, labels).collect()
    d = [r for r in rows if r.device_id == "D"]
    assert sorted(r.failure_type for r in d) == ["a", "b"]
    (e,) = [r for r in rows if r.device_id == "E"]
    assert (e.will_fail, e.failure_type, e.severity, e.days_before_failure) == (0, "Normal", "Normal", 0.0)
    assert (d[0].has_sufficient_data, e.has_sufficient_data) == (1, 0)
    nearest = gold.ml_features(features, labels, dedup="nearest").collect()
    assert [r.failure_type for r in nearest if r.device_id == "D"] == ["a"]


def _raw(spark, ddl, **values):
    names = columns_of(ddl)
    types = {p.split()[0]: p.split()[1] for p in ddl.replace("\n", " ").split(",")}
    row = tuple(values.get(n) for n in names)
    df = spark.createDataFrame([row], ", ".join(f"{n} {types[n]}" for n in names))
    return df.withColumn("ingestion_time", F.current_timestamp())


def test_device_lookup_uses_raw_status_and_master_location(spark):
    stamp = "2024-01-01T00:00:00.000000"
    readings = _raw(spark, TELEMETRY_DDL, device_id="D", timestamp="2024-01-05T10:30:00.000000", temperature=1.0, location="old")
    device = dict(device_id="D", device_type="t", location="new", facility="f", installation_date=stamp,
                  last_maintenance=None, next_scheduled_maintenance="2024-01-09T00:00:00.000000")
    kept = silver.telemetry_clean(readings, _raw(spark, DEVICE_MASTER_DDL, **device, status="maintenance")).first()
    assert (kept.location, kept.days_since_installation, kept.days_since_last_maintenance, kept.days_to_next_maintenance) == ("new", 4, None, 4)
    assert (kept.hour_of_day, kept.day_of_week) == (10, 6)  # a Friday, Sunday is 1
    for status in (" Active ", "inactive", None):
        assert silver.telemetry_clean(readings, _raw(spark, DEVICE_MASTER_DDL, **device, status=status)).count() == 0


def test_every_rule_has_a_passing_and_a_failing_row(spark):
    def metrics(df, rules):
        return {r.rule: (r.passed, r.failed) for r in rule_metrics(df, rules).collect()}

    sensors = "temperature double, pressure double, vibration double, humidity double, power_consumption double, flow_rate double, motor_speed double"
    good, bad = ("D", "2024", 20.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0), ("", None, 151.0, -1.0, 101.0, -1.0, -1.0, -1.0, -1.0)
    empty = (None,) * 9
    got = metrics(spark.createDataFrame([good, bad, empty], f"device_id string, timestamp string, {sensors}"), TELEMETRY_RULES)
    assert got["valid_device_id"] == (1, 2) and got["valid_timestamp"] == (1, 2)
    assert all(v == (2, 1) for k, v in got.items() if k.startswith("reasonable"))

    fields = "device_id string, device_type string, status string, facility string, manufacturer string, installation_date string"
    got = metrics(spark.createDataFrame([("D", "t", "active", "f", "m", "d"), ("", None, None, None, None, None)], fields), DEVICE_RULES)
    assert all(v == (1, 1) for v in got.values())

    fields = "device_id string, maintenance_id string, maintenance_date string, duration_minutes int"
    got = metrics(spark.createDataFrame([("D", "m", "d", None), (None, None, None, 0)], fields), MAINTENANCE_RULES)
    assert all(v == (1, 1) for v in got.values())

    fields = "device_id string, failure_id string, failure_timestamp string, severity string"
    got = metrics(spark.createDataFrame([("D", "f", "d", "minor"), (None, None, None, None)], fields), FAILURE_RULES)
    assert all(v == (1, 1) for v in got.values())


def test_dashboard_status_and_costs(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (1D, 0, 0, 0), (0D, 1, 0, 1), (0D, 0, 0, 1), (0D, 0, 0, 0)
          AS t(health_score, high_temperature, high_vibration, needs_maintenance_soon)""")
    for c in ("device_id", "device_type", "location", "hour_bucket", "avg_temperature", "avg_vibration", "avg_pressure",
              "days_since_maintenance", "reading_count"):
        df = df.withColumn(c, F.lit(1))
    assert sorted(r.status for r in gold.health_dashboard(df).collect()) == ["Healthy", "Maintenance Due", "Unknown", "Warning"]
    m = spark.sql("""SELECT 'd' device_id, 'm' maintenance_id, 't' maintenance_type, timestamp'2024-03-17 10:00:00' maintenance_date,
                     1D duration_hours, c cost, 'x' technician FROM VALUES (1000D), (1000.01D), (NULL) AS v(c)""")
    rows = gold.maintenance_analytics(m).collect()
    assert [r.is_expensive for r in rows] == [0, 1, 0]
    assert {str(r.maintenance_month) for r in rows} == {"2024-03-01 00:00:00"}


def test_usual_timestamps_are_cast_and_odd_ones_read_by_the_format(spark):
    odd = [
        "2024-02-30T00:00:00.123456", "2024-01-01T24:00:00.000000", "2024-01-01T00:00:00.12345Z", "0000-01-01T00:00:00.123456",
        "2024-01-01T00:00:00.123456\n", " 2024-01-01T00:00:00.123456", "2024-01-01T00:00:00.12345", "2024-02-29T00:00:00.123456.000000",
    ]
    df = spark.createDataFrame([(t,) for t in odd], "raw string")
    by_format = F.try_to_timestamp(F.regexp_replace("raw", r"\.(\d{6})\.000000$", ".$1"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    assert df.filter(~repair_ts("raw").eqNullSafe(by_format)).count() == 0
    assert "cast(substring(raw" in str(repair_ts("raw")).lower()


def test_readings_write_their_time_by_hour_and_minute(spark, small):
    """An event's twelve texts from two formats, over hours, days and a change of the clocks."""
    from plantwatch.functions.timefns import raw_text
    from plantwatch.sources.given_tables import Entities

    zone = spark.conf.get("spark.sql.session.timeZone")
    times = ["2024-01-05 10:00:00", "2023-12-31 23:07:59.123456", "2024-03-31 00:59:30.5", "2024-10-27 00:31:01", "2024-10-27 01:31:01", None]
    rows = [(int(e), t, 7, 1.0) for k in (1, 500) for e, t in zip(range(k, k + len(times)), times)]
    try:
        for used in ("UTC", "Europe/Paris", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", used)
            events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, value double").withColumn(
                "ts", F.col("ts").cast("timestamp"))
            made = Entities(spark, small)
            made._read_spread = lambda *args: events
            ts = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("r") * 5)
            wanted = events.select("event_id", "ts", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("r")).select(
                F.when(F.col("event_id") % 500 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(raw_text(ts)).alias("timestamp"))
            found = made.telemetry.select("timestamp")
            assert found.count() == 12 * len(rows)
            assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert "date_format" not in plan[:plan.index("Generate")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_whole_numbers_are_rounded_without_decimals(spark):
    from plantwatch.catalog.queries import rounded

    values = [0.0, -0.0, 1.0, -3.0, 0.1, 0.000000005, -0.000000005, 2.123456785, 1e300, -1e17, 5e-324,
              float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = df.select(rounded(F.col("v"), 8).cast("string").alias("a"), F.round("v", 8).cast("string").alias("b")).collect()
    assert [r.a for r in out] == [r.b for r in out]
