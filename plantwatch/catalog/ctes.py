"""SQL text shared by the oracle queries: the entities and every derived table as CTEs.

Written independently of the Spark side from the same definitions. Here the entities carry
typed timestamps directly, so agreement also shows that timestamp repair lost nothing.
"""

from __future__ import annotations

SENSORS = (
    "temperature", "pressure", "vibration", "humidity",
    "power_consumption", "flow_rate", "valve_position", "motor_speed",
)

ENTITIES = """
device_master AS (
  SELECT 'DEV_' || lpad(CAST(k AS VARCHAR), 6, '0') AS device_id,
         CASE WHEN k % 37 = 0 THEN '  ' || upper(kind) || ' ' ELSE kind END AS device_type,
         n_name || blank AS location, r_name || blank AS facility,
         CASE WHEN k % 71 = 0 THEN TIMESTAMP '2024-01-20'
              ELSE TIMESTAMP '2021-01-01' + to_days(CAST(k * 7919 % 1000 AS INTEGER)) END AS installation_date,
         CAST(k % 5 + 1 AS VARCHAR) || '.' || CAST(k % 10 AS VARCHAR) || '.0' AS firmware_version,
         'MODEL-' || CAST(100 + k % 900 AS VARCHAR) AS model,
         CASE WHEN k % 211 = 0 THEN NULL ELSE 'MFR_' || CAST(k % 5 AS VARCHAR) END AS manufacturer,
         CASE WHEN k % 53 = 0 THEN ' Active ' WHEN k % 20 <= 15 THEN 'active'
              WHEN k % 20 <= 17 THEN 'inactive' WHEN k % 20 = 18 THEN 'maintenance' ELSE 'failed' END AS status,
         CASE WHEN k % 41 = 0 THEN NULL WHEN k % 50 = 0 THEN TIMESTAMP '2022-06-01'
              ELSE TIMESTAMP '2023-06-01' + to_days(CAST(k * 13 % 240 AS INTEGER)) + to_hours(k % 24) END AS last_maintenance,
         TIMESTAMP '2024-01-10' + to_days(CAST(k * 7 % 60 AS INTEGER)) AS next_scheduled_maintenance
  FROM (SELECT c_custkey AS k, n_name, r_name,
               CASE WHEN c_custkey % 43 = 0 THEN ' ' ELSE '' END AS blank,
               ['temperature_sensor', 'humidity_sensor', 'pressure_sensor', 'vibration_sensor',
                'flow_meter', 'power_meter', 'smart_valve', 'motor_controller'][c_custkey % 8 + 1] AS kind
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
),
telemetry AS (
  SELECT CASE WHEN e % 2003 = 0 THEN '' WHEN e % 1009 = 0 THEN 'DEV_UNKNOWN'
              ELSE 'DEV_' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS device_id,
         CASE WHEN e % 500 = 0 THEN NULL ELSE ts + to_minutes(5 * r) END AS "timestamp",
         e, ts + to_minutes(5 * r) AS spoken,
         CASE WHEN (e + r) % 20 = 0 THEN NULL WHEN e % 997 = 0 THEN 200.0::DOUBLE
              ELSE 45.0::DOUBLE + least(value, 45.0::DOUBLE) + r % 3 END AS temperature,
         CAST(500 + e * 37 % 1000 + r AS DOUBLE) AS pressure,
         CASE WHEN e % 991 = 0 THEN -1.0::DOUBLE ELSE CAST(e * 11 % 130 AS DOUBLE) / 10 END AS vibration,
         CAST(e * 17 % 104 AS DOUBLE) AS humidity,
         CASE WHEN e % 983 = 0 THEN -5.0::DOUBLE ELSE CAST(50 + e * 29 % 550 AS DOUBLE) END AS power_consumption,
         CAST(10 + e * 3 % 40 AS DOUBLE) AS flow_rate,
         CAST(e % 101 AS DOUBLE) AS valve_position,
         CAST(1000 + e * 53 % 2000 AS DOUBLE) AS motor_speed,
         CASE WHEN e % 50 = 0 THEN 'poor' WHEN e % 50 <= 4 THEN 'fair' ELSE 'good' END AS quality
  FROM (SELECT event_id AS e, ts, user_id, value, unnest(range(0, 12)) AS r FROM events)
),
failures AS (
  SELECT 'DEV_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS device_id,
         'FAIL_' || CAST(event_id AS VARCHAR) AS failure_id,
         ts AS failure_timestamp,
         CASE WHEN event_id % 7 = 0 THEN NULL
              ELSE ts + to_hours(event_id % 72 + 1) + to_minutes(event_id % 60) END AS repair_timestamp,
         CASE WHEN event_id % 29 = 0 THEN upper(kind) ELSE kind END AS failure_type,
         CASE WHEN event_id % 97 = 0 THEN 'unknown' WHEN event_id % 31 = 0 THEN ' Critical '
              WHEN event_id % 10 <= 3 THEN 'minor' WHEN event_id % 10 <= 7 THEN 'major' ELSE 'critical' END AS severity,
         'cause_' || CAST(event_id % 7 AS VARCHAR) AS root_cause,
         'action_' || CAST(event_id % 6 AS VARCHAR) AS repair_action,
         value * 30 AS cost
  FROM (SELECT *, ['sensor_malfunction', 'communication_failure', 'power_failure', 'mechanical_failure',
                   'software_error', 'calibration_drift'][event_id % 6 + 1] AS kind
        FROM events WHERE event_type = 'error')
),
maintenance AS (
  SELECT CASE WHEN o_orderkey % 1511 = 0 THEN NULL
              ELSE 'DEV_' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS device_id,
         'MAINT_' || CAST(o_orderkey AS VARCHAR) AS maintenance_id,
         CASE WHEN o_orderkey % 33 = 0 THEN ' Preventive '
              ELSE ['preventive', 'corrective', 'predictive', 'emergency'][o_orderkey % 4 + 1] END AS maintenance_type,
         o_orderdate + to_hours(o_orderkey % 73 - 24) AS maintenance_date,
         CAST(o_orderdate AS TIMESTAMP) AS scheduled_date,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 503 = 0 THEN -30
              ELSE 60 + o_orderkey % 421 END AS duration_minutes,
         ' TECH_' || CAST(1001 + o_orderkey % 50 AS VARCHAR) AS technician,
         'note' AS description,
         ['', 'sensor', 'sensor, cable', 'sensor, cable, filter'][o_orderkey % 4 + 1] AS parts_replaced,
         o_totalprice / 100 AS cost
  FROM orders
)"""

SILVER = """
telemetry_clean AS (
  SELECT t.device_id, t."timestamp", date_trunc('hour', t."timestamp") AS reading_hour,
         CAST(t."timestamp" AS DATE) AS reading_date, hour(t."timestamp") AS hour_of_day,
         dayofweek(t."timestamp") + 1 AS day_of_week,
         d.device_type, d.location, d.facility, d.manufacturer, d.model,
         t.temperature, t.pressure, t.vibration, t.humidity, t.power_consumption, t.flow_rate,
         t.valve_position, t.motor_speed,
         date_diff('day', CAST(d.installation_date AS DATE), CAST(t."timestamp" AS DATE)) AS days_since_installation,
         date_diff('day', CAST(d.last_maintenance AS DATE), CAST(t."timestamp" AS DATE)) AS days_since_last_maintenance,
         date_diff('day', CAST(t."timestamp" AS DATE), CAST(d.next_scheduled_maintenance AS DATE)) AS days_to_next_maintenance
  FROM telemetry t JOIN device_master d ON t.device_id = d.device_id
  WHERE d.status IN ('active', 'maintenance')
),
device_master_clean AS (
  SELECT device_id, trim(lower(device_type)) AS device_type, trim(location) AS location, trim(facility) AS facility,
         installation_date, firmware_version, model, manufacturer, trim(lower(status)) AS status,
         last_maintenance, next_scheduled_maintenance,
         date_diff('day', CAST(installation_date AS DATE), DATE '2024-02-01') AS device_age_days,
         date_diff('day', CAST(last_maintenance AS DATE), DATE '2024-02-01') AS days_since_last_maintenance,
         date_diff('day', DATE '2024-02-01', CAST(next_scheduled_maintenance AS DATE)) AS days_to_next_maintenance,
         CASE WHEN CAST(next_scheduled_maintenance AS DATE) < DATE '2024-02-01' THEN 1 ELSE 0 END AS maintenance_overdue
  FROM device_master
),
maintenance_clean AS (
  SELECT device_id, maintenance_id, trim(lower(maintenance_type)) AS maintenance_type, maintenance_date, scheduled_date,
         duration_minutes, duration_minutes / 60.0::DOUBLE AS duration_hours,
         CASE WHEN maintenance_date > scheduled_date THEN 1 ELSE 0 END AS maintenance_overdue,
         date_diff('day', CAST(scheduled_date AS DATE), CAST(maintenance_date AS DATE)) AS delay_days,
         trim(technician) AS technician, description, parts_replaced, cost
  FROM maintenance
),
failures_clean AS (
  SELECT device_id, failure_id, failure_timestamp, repair_timestamp, trim(lower(failure_type)) AS failure_type,
         trim(lower(severity)) AS severity,
         CASE severity WHEN 'critical' THEN 3 WHEN 'major' THEN 2 WHEN 'minor' THEN 1 ELSE 0 END AS failure_severity_score,
         (floor(epoch(repair_timestamp)) - floor(epoch(failure_timestamp))) / 3600 AS downtime_hours,
         hour(failure_timestamp) AS failure_hour, dayofweek(failure_timestamp) + 1 AS failure_day_of_week,
         root_cause, repair_action, cost
  FROM failures
),
health AS (
  SELECT device_id, "timestamp", device_type, location, facility, temperature, pressure, vibration, power_consumption,
         CASE WHEN temperature > 75 THEN 1.0 WHEN temperature < 65 THEN -1.0 ELSE 0.0 END AS temp_1h_trend,
         CASE WHEN temperature > 80 THEN 2.0 WHEN temperature < 60 THEN -2.0 ELSE 0.0 END AS temp_short_trend,
         CASE WHEN vibration > 8 THEN 1.0 WHEN vibration < 2 THEN -1.0 ELSE 0.0 END AS vibration_trend,
         CASE WHEN pressure > 1200 THEN 1.0 WHEN pressure < 800 THEN -1.0 ELSE 0.0 END AS pressure_trend,
         CASE WHEN power_consumption > 500 THEN 1.0 WHEN power_consumption < 100 THEN -1.0 ELSE 0.0 END AS power_trend,
         CASE WHEN temperature > 85 OR temperature < 55 THEN 1.0 ELSE 0.0 END AS temp_anomaly_score,
         CASE WHEN vibration > 10 THEN 1.0 ELSE 0.0 END AS vibration_anomaly_score,
         CASE WHEN pressure > 1400 OR pressure < 600 THEN 1.0 ELSE 0.0 END AS pressure_anomaly_score,
         days_since_last_maintenance, days_to_next_maintenance
  FROM telemetry_clean
)"""

GOLD = """
hourly AS (
  SELECT *, CASE WHEN high_temperature + high_vibration + needs_maintenance_soon = 0 THEN 1.0 ELSE 0.0 END AS health_score
  FROM (
    SELECT *, CASE WHEN round(avg_temperature, 9) > 75 THEN 1 ELSE 0 END AS high_temperature,
           CASE WHEN round(avg_vibration, 9) > 8 THEN 1 ELSE 0 END AS high_vibration,
           CASE WHEN days_since_maintenance > 60 THEN 1 ELSE 0 END AS needs_maintenance_soon
    FROM (
      SELECT device_id, date_trunc('hour', "timestamp") AS hour_bucket, device_type, location,
             count(*) AS reading_count, avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
             avg(pressure) AS avg_pressure, avg(power_consumption) AS avg_power,
             max(days_since_last_maintenance) AS days_since_maintenance
      FROM health GROUP BY 1, 2, 3, 4))
),
labels_hourly AS (
  SELECT device_id, date_trunc('hour', failure_timestamp - to_hours(h)) AS prediction_hour, 1 AS will_fail,
         failure_type, severity, round(h / 24.0::DOUBLE, 1) AS days_before_failure, h AS hours_before_failure
  FROM (SELECT *, unnest(range(6, 169, 6)) AS h FROM failures_clean WHERE severity IN ('minor', 'major', 'critical'))
),
ml_table AS (
  SELECT f.device_id, f.hour_bucket, f.device_type, f.location, f.avg_temperature, f.avg_vibration, f.avg_pressure,
         f.avg_power, f.high_temperature, f.high_vibration, f.needs_maintenance_soon, f.health_score,
         f.days_since_maintenance, coalesce(l.will_fail, 0) AS will_fail, coalesce(l.failure_type, 'Normal') AS failure_type,
         coalesce(l.severity, 'Normal') AS severity, coalesce(l.days_before_failure, 0.0) AS days_before_failure,
         f.reading_count, CASE WHEN f.reading_count >= 10 THEN 1 ELSE 0 END AS has_sufficient_data
  FROM hourly f LEFT JOIN labels_hourly l ON f.device_id = l.device_id AND f.hour_bucket = l.prediction_hour
),
training_rows AS (SELECT * FROM ml_table WHERE has_sufficient_data = 1)"""

_COUNT_READINGS = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in SENSORS)

EXPLORE = f"""
readings AS (SELECT *, {_COUNT_READINGS} AS n FROM telemetry),
long_readings AS (
  {" UNION ALL ".join(
      f"SELECT device_id, \"timestamp\", quality, '{c}' AS reading_type, {c} AS value FROM telemetry WHERE {c} IS NOT NULL"
      for c in SENSORS)}
),
clocks AS (
  SELECT *, CAST(floor(epoch(TIMESTAMP '2024-02-01' - installation_date) / 86400) AS BIGINT) AS device_age_days,
         CAST(floor(epoch(TIMESTAMP '2024-02-01' - last_maintenance) / 86400) AS BIGINT) AS days_since_maintenance,
         CAST(floor(epoch(next_scheduled_maintenance - TIMESTAMP '2024-02-01') / 86400) AS BIGINT) AS days_to_next_maintenance
  FROM device_master
),
per_device AS (
  SELECT device_id, sum(n) AS readings FROM readings WHERE device_id IS NOT NULL GROUP BY 1 HAVING sum(n) > 0
),
resolution AS (
  SELECT failure_id, (epoch_us(repair_timestamp) - epoch_us(failure_timestamp)) / 3600000000.0::DOUBLE AS resolution_hours
  FROM failures WHERE repair_timestamp IS NOT NULL
),
reading_moments AS (
  SELECT r.reading_type, count(*) AS n, any_value(m) AS mean, stddev_samp(value) AS std, min(value) AS lo, max(value) AS hi,
         avg(pow(value - m, 3)) / pow(avg(pow(value - m, 2)), 1.5) AS skewness,
         avg(pow(value - m, 4)) / pow(avg(pow(value - m, 2)), 2) - 3 AS kurtosis
  FROM long_readings r JOIN (SELECT reading_type, avg(value) AS m FROM long_readings GROUP BY 1) a
    ON r.reading_type = a.reading_type
  GROUP BY 1
),
summary_base AS (
  SELECT c.device_id, coalesce(device_type, 'Unknown') AS device_type, coalesce(facility, 'Unknown') AS facility,
         coalesce(manufacturer, 'Unknown') AS manufacturer, coalesce(status, 'Unknown') AS status,
         coalesce(device_age_days, 0) AS device_age_days, coalesce(days_since_maintenance, 0) AS days_since_maintenance,
         coalesce(avg_reading, 0) AS avg_reading, coalesce(reading_std, 0) AS reading_std,
         coalesce(reading_count, 0) AS reading_count, coalesce(poor_quality_ratio, 0) AS poor_quality_ratio,
         coalesce(failure_count, 0) AS failure_count, coalesce(high_severity_count, 0) AS high_severity_count,
         coalesce(unresolved_count, 0) AS unresolved_count, coalesce(total_maintenance_cost, 0) AS total_maintenance_cost,
         coalesce(maintenance_count, 0) AS maintenance_count, coalesce(avg_maintenance_cost, 0) AS avg_maintenance_cost,
         coalesce(total_maintenance_hours, 0) AS total_maintenance_hours
  FROM clocks c
  LEFT JOIN (SELECT device_id, round(avg(value), 4) AS avg_reading, round(stddev_samp(value), 4) AS reading_std,
                    count(*) AS reading_count,
                    round(count(*) FILTER (WHERE quality = 'poor') / count(*), 4) AS poor_quality_ratio
             FROM long_readings GROUP BY 1) t ON c.device_id = t.device_id
  LEFT JOIN (SELECT device_id, count(failure_id) AS failure_count,
                    count(*) FILTER (WHERE severity = 'critical') AS high_severity_count,
                    count(*) FILTER (WHERE repair_timestamp IS NULL) AS unresolved_count
             FROM failures GROUP BY 1) f ON c.device_id = f.device_id
  LEFT JOIN (SELECT device_id, sum(cost) AS total_maintenance_cost, count(cost) AS maintenance_count,
                    avg(cost) AS avg_maintenance_cost, sum(duration_minutes / 60.0::DOUBLE) AS total_maintenance_hours
             FROM maintenance GROUP BY 1) m ON c.device_id = m.device_id
),
summary AS (
  SELECT *, dense_rank() OVER (ORDER BY device_type) - 1 AS device_type_encoded,
         dense_rank() OVER (ORDER BY facility) - 1 AS facility_encoded,
         dense_rank() OVER (ORDER BY manufacturer) - 1 AS manufacturer_encoded,
         dense_rank() OVER (ORDER BY status) - 1 AS status_encoded
  FROM summary_base
)"""

# ---- learned preparation: medians, codes, derived columns, bounds, scales ----------------

_TIMED_NUMBERS = (
    "avg_temperature", "avg_vibration", "avg_pressure", "avg_power", "high_temperature", "high_vibration",
    "needs_maintenance_soon", "health_score", "days_since_maintenance", "reading_count", "has_sufficient_data",
    "hour_of_day", "day_of_week", "month",
)
DEVICE_TYPES = (
    "temperature_sensor", "humidity_sensor", "pressure_sensor", "vibration_sensor",
    "flow_meter", "power_meter", "smart_valve", "motor_controller",
)
# Raw device types also occur upper-cased and padded; each spelling is a class of its own.
TYPE_CLASSES = DEVICE_TYPES + tuple(f"  {t.upper()} " for t in DEVICE_TYPES)

DERIVED_NUMBERS = (
    "temp_deviation", "temp_risk", "vibration_risk", "vibration_squared", "maintenance_overdue",
    "maintenance_urgent", "log_days_maintenance", "total_risk_factors", "any_risk_factor", "power_efficiency",
    "high_power_consumption", "data_quality_score", "low_data_quality", "device_type_encoded", "location_encoded",
)
FEATURES = _TIMED_NUMBERS + DERIVED_NUMBERS
KEY = ("device_id", "hour_bucket", "failure_type", "severity", "days_before_failure", "will_fail")


def _median_filled() -> str:
    cols = ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM ml_timed)) AS {c}"
        for c in _TIMED_NUMBERS
    )
    return f"ml_filled AS (SELECT {', '.join(KEY)}, device_type, location, {cols} FROM ml_timed)"


def _bounds() -> str:
    parts = []
    for c in FEATURES:
        parts.append(
            f"SELECT '{c}' AS c, quantile_cont({c}, 0.25) AS q1, median({c}) AS q2, quantile_cont({c}, 0.75) AS q3, "
            f"count(DISTINCT {c}) AS d FROM ml_derived"
        )
    return (
        "ml_bounds AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, "
        f"d > 10 AND q3 > q1 AS clips FROM ({' UNION ALL '.join(parts)}))"
    )


def _clipped() -> str:
    cols = ", ".join(
        f"CASE WHEN (SELECT clips FROM ml_bounds WHERE c = '{c}') "
        f"THEN greatest(least(coalesce({c}, (SELECT q2 FROM ml_bounds WHERE c = '{c}')), (SELECT hi FROM ml_bounds WHERE c = '{c}')), "
        f"(SELECT lo FROM ml_bounds WHERE c = '{c}')) "
        f"ELSE {c} END AS {c}"
        for c in FEATURES
    )
    return f"ml_clipped AS (SELECT {', '.join(KEY)}, device_type, {cols} FROM ml_derived)"


LEARNING = f"""
ml_timed AS (
  SELECT *, hour(hour_bucket) AS hour_of_day, isodow(hour_bucket) - 1 AS day_of_week, month(hour_bucket) AS month
  FROM training_rows
),
{_median_filled()},
ml_derived AS (
  SELECT *, abs(avg_temperature - 70) AS temp_deviation,
         CAST(coalesce(round(avg_temperature, 9) > 75 OR round(avg_temperature, 9) < 65, FALSE) AS DOUBLE) AS temp_risk,
         CAST(coalesce(round(avg_vibration, 9) > 8, FALSE) AS DOUBLE) AS vibration_risk,
         avg_vibration * avg_vibration AS vibration_squared,
         CAST(days_since_maintenance > 180 AS DOUBLE) AS maintenance_overdue,
         CAST(days_since_maintenance > 365 AS DOUBLE) AS maintenance_urgent,
         CASE WHEN days_since_maintenance > -1 THEN ln(1 + days_since_maintenance) WHEN days_since_maintenance = -1 THEN '-inf'::DOUBLE END AS log_days_maintenance,
         high_temperature + high_vibration + needs_maintenance_soon AS total_risk_factors,
         CAST(high_temperature + high_vibration + needs_maintenance_soon > 0 AS DOUBLE) AS any_risk_factor,
         avg_power / CASE WHEN avg_temperature = 0 THEN 1 ELSE avg_temperature END AS power_efficiency,
         CAST(round(avg_power, 9) > (SELECT round(quantile_cont(avg_power, 0.75), 9) FROM ml_filled) AS DOUBLE) AS high_power_consumption,
         least(reading_count / 50, 1.0::DOUBLE) AS data_quality_score,
         CAST(reading_count < 20 AS DOUBLE) AS low_data_quality,
         CAST(dense_rank() OVER (ORDER BY device_type) - 1 AS DOUBLE) AS device_type_encoded,
         CAST(dense_rank() OVER (ORDER BY location) - 1 AS DOUBLE) AS location_encoded
  FROM ml_filled
),
{_bounds()},
{_clipped()},
split AS (
  SELECT *, CAST(rank() OVER (PARTITION BY will_fail ORDER BY hash) <=
                 round(0.2::DOUBLE * count(*) OVER (PARTITION BY will_fail)) AS INTEGER) AS is_test
  FROM (SELECT *, md5(concat_ws('|', '42', coalesce(device_id, '~'), coalesce(CAST(epoch_us(hour_bucket) AS VARCHAR), '~'), coalesce(failure_type, '~'), coalesce(severity, '~'))) AS hash
        FROM training_rows)
),
scored AS (
  SELECT *, high_temperature + high_vibration + needs_maintenance_soon AS risk,
         CASE WHEN high_temperature + high_vibration + needs_maintenance_soon >= 2 THEN 1 ELSE 0 END AS predicted
  FROM training_rows
)"""

LAYERS = (ENTITIES, SILVER, GOLD, EXPLORE, LEARNING)


def sql(body: str) -> str:
    """A complete query: all CTEs, then the body (unused CTEs are not evaluated)."""
    return "WITH " + ",".join(layer.strip("\n") for layer in LAYERS) + "\n" + body.strip()
