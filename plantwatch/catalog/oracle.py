"""The SQL text each named query must agree with.

Doubles are rounded alike on both sides (8 digits, money sums 4), integers widened to BIGINT,
dates given as text.
"""

from __future__ import annotations

from plantwatch.catalog.ctes import FEATURES, SENSORS, TYPE_CLASSES, sql


def _select(source: str, plain: str = "", ints: str = "", nums: str = "", dates: str = "", digits: int = 8) -> str:
    def quote(c: str) -> str:
        return f'"{c}"'

    items = [quote(c) for c in plain.split()]
    items += [f"CAST({quote(c)} AS BIGINT) AS {quote(c)}" for c in ints.split()]
    items += [f"round(CAST({quote(c)} AS DOUBLE), {digits}) AS {quote(c)}" for c in nums.split()]
    items += [f"strftime({quote(c)}, '%Y-%m-%d') AS {quote(c)}" for c in dates.split()]
    return sql(f"SELECT {', '.join(items)} FROM {source}")


_SENSORS = " ".join(SENSORS)
_HOURLY_NUMS = "avg_temperature avg_vibration avg_pressure avg_power health_score"
_ML_PLAIN = "device_id hour_bucket device_type location failure_type severity"
_ML_INTS = "high_temperature high_vibration needs_maintenance_soon days_since_maintenance will_fail reading_count has_sufficient_data"
_ML_NUMS = "avg_temperature avg_vibration avg_pressure avg_power health_score days_before_failure"

TABLES = {
    "telemetry_clean": _select(
        "telemetry_clean",
        "device_id timestamp reading_hour device_type location facility manufacturer model",
        "hour_of_day day_of_week days_since_installation days_since_last_maintenance days_to_next_maintenance",
        _SENSORS,
        "reading_date",
    ),
    "device_master_clean": _select(
        "device_master_clean",
        "device_id device_type location facility installation_date firmware_version model manufacturer status "
        "last_maintenance next_scheduled_maintenance",
        "device_age_days days_since_last_maintenance days_to_next_maintenance maintenance_overdue",
    ),
    "maintenance_clean": _select(
        "maintenance_clean",
        "device_id maintenance_id maintenance_type maintenance_date scheduled_date technician description parts_replaced",
        "duration_minutes maintenance_overdue delay_days",
        "duration_hours cost",
    ),
    "failures_clean": _select(
        "failures_clean",
        "device_id failure_id failure_timestamp repair_timestamp failure_type severity root_cause repair_action",
        "failure_severity_score failure_hour failure_day_of_week",
        "downtime_hours cost",
    ),
    "device_health_metrics": _select(
        "health",
        "device_id timestamp device_type location facility",
        "days_since_last_maintenance days_to_next_maintenance",
        "temperature pressure vibration power_consumption temp_1h_trend temp_short_trend vibration_trend pressure_trend "
        "power_trend temp_anomaly_score vibration_anomaly_score pressure_anomaly_score",
    ),
    "device_features_hourly": _select(
        "hourly",
        "device_id hour_bucket device_type location",
        "reading_count high_temperature high_vibration needs_maintenance_soon days_since_maintenance",
        _HOURLY_NUMS,
    ),
    "failure_labels": _select(
        "labels_hourly",
        "device_id prediction_hour failure_type severity",
        "will_fail hours_before_failure",
        "days_before_failure",
    ),
    "predictive_maintenance_features": _select("ml_table", _ML_PLAIN, _ML_INTS, _ML_NUMS),
    "predictive_maintenance_features_nearest": _select(
        """(SELECT f.* EXCLUDE (health_score), f.health_score, coalesce(l.will_fail, 0) AS will_fail,
                   coalesce(l.failure_type, 'Normal') AS failure_type, coalesce(l.severity, 'Normal') AS severity,
                   coalesce(l.days_before_failure, 0.0) AS days_before_failure,
                   CASE WHEN f.reading_count >= 10 THEN 1 ELSE 0 END AS has_sufficient_data
            FROM hourly f LEFT JOIN (
              SELECT * FROM labels_hourly QUALIFY row_number() OVER (
                PARTITION BY device_id, prediction_hour ORDER BY hours_before_failure, failure_type, severity) = 1) l
            ON f.device_id = l.device_id AND f.hour_bucket = l.prediction_hour)""",
        _ML_PLAIN, _ML_INTS, _ML_NUMS,
    ),
    "device_health_dashboard": _select(
        """(SELECT *, CASE WHEN health_score = 1 THEN 'Healthy'
                           WHEN high_temperature = 1 OR high_vibration = 1 THEN 'Warning'
                           WHEN needs_maintenance_soon = 1 THEN 'Maintenance Due' ELSE 'Unknown' END AS status,
                    TIMESTAMP '2024-02-01 00:00:00' AS last_updated
            FROM hourly)""",
        "device_id device_type location hour_bucket status last_updated",
        "days_since_maintenance reading_count",
        "health_score avg_temperature avg_vibration avg_pressure",
    ),
    "maintenance_analytics": _select(
        """(SELECT *, date_trunc('month', maintenance_date) AS maintenance_month,
                   CASE WHEN cost > 1000 THEN 1 ELSE 0 END AS is_expensive FROM maintenance_clean)""",
        "device_id maintenance_id maintenance_type maintenance_date maintenance_month technician",
        "is_expensive",
        "duration_hours cost",
    ),
}

_RULES = {
    "telemetry": ("telemetry_clean", {
        "valid_device_id": "device_id <> ''",
        "valid_timestamp": '"timestamp" IS NOT NULL',
        "reasonable_temperature": "coalesce(temperature >= -50 AND temperature <= 150, TRUE)",
        "reasonable_pressure": "coalesce(pressure >= 0 AND pressure <= 2000, TRUE)",
        "reasonable_vibration": "coalesce(vibration >= 0 AND vibration <= 100, TRUE)",
        "reasonable_humidity": "coalesce(humidity >= 0 AND humidity <= 100, TRUE)",
        "reasonable_power": "coalesce(power_consumption >= 0, TRUE)",
        "reasonable_flow_rate": "coalesce(flow_rate >= 0, TRUE)",
        "reasonable_motor_speed": "coalesce(motor_speed >= 0, TRUE)",
    }),
    "devices": ("device_master_clean", {
        "valid_device_id": "device_id <> ''",
        "valid_device_type": "device_type IS NOT NULL",
        "valid_status": "status = 'active' OR status = 'inactive' OR status = 'maintenance' OR status = 'failed'",
        "valid_facility": "facility IS NOT NULL",
        "valid_manufacturer": "manufacturer IS NOT NULL",
        "valid_installation_date": "installation_date IS NOT NULL",
    }),
    "maintenance": ("maintenance_clean", {
        "valid_device_id": "device_id IS NOT NULL",
        "valid_maintenance_id": "maintenance_id IS NOT NULL",
        "valid_maintenance_date": "maintenance_date IS NOT NULL",
        "valid_duration": "coalesce(duration_minutes > 0, TRUE)",
    }),
    "failures": ("failures_clean", {
        "valid_device_id": "device_id IS NOT NULL",
        "valid_failure_id": "failure_id IS NOT NULL",
        "valid_failure_timestamp": "failure_timestamp IS NOT NULL",
        "valid_severity": "severity = 'minor' OR severity = 'major' OR severity = 'critical'",
    }),
}


def _rules(table: str, rules: dict[str, str]) -> str:
    return sql(" UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {p}) AS passed, "
        f"count(*) - count(*) FILTER (WHERE {p}) AS failed FROM {table}"
        for name, p in rules.items()
    ))


def _orphans(table: str) -> str:
    return sql(
        f"SELECT DISTINCT device_id FROM {table} t "
        "WHERE NOT EXISTS (SELECT 1 FROM device_master d WHERE d.device_id = t.device_id)"
    )


_COLUMNS = {
    "device_master": "device_id device_type location facility installation_date firmware_version model manufacturer "
                     "status last_maintenance next_scheduled_maintenance",
    "telemetry": f"device_id timestamp {_SENSORS} location facility",
    "maintenance": "device_id maintenance_id maintenance_type maintenance_date scheduled_date duration_minutes technician "
                   "description parts_replaced cost",
    "failures": "device_id failure_id failure_timestamp repair_timestamp failure_type severity root_cause repair_action cost",
}


def _without_value(table: str, column: str) -> str:
    if table == "telemetry" and column in ("location", "facility", "timestamp"):
        return "0"  # raw texts, always filled
    return f'count(*) - count("{column}")'


_MISSING = [
    f"SELECT '{c}' AS column_name, {_without_value('telemetry', c)} + 0 * count(*) AS missing FROM telemetry"
    for c in (_COLUMNS["telemetry"] + " quality").split()
] + ["SELECT 'ingestion_time' AS column_name, 0 AS missing"]

CHECKS = {
    **{f"expect_{name}": _rules(table, rules) for name, (table, rules) in _RULES.items()},
    **{f"orphans_{t}": _orphans(t) for t in ("telemetry", "failures", "maintenance")},
    "gold_pk_violations": sql(
        "SELECT device_id, hour_bucket, count(*) AS copies FROM ml_table GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "dataset_overview": sql(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS records, count(DISTINCT device_id) AS devices FROM {t}"
        for t in _COLUMNS
    )),
    "timestamp_format_errors": sql(
        """SELECT 'telemetry' AS table_name, 'timestamp' AS column_name, count(*) - count("timestamp") AS bad_values FROM telemetry
           UNION ALL SELECT t, c, 0 FROM (VALUES ('device_master', 'installation_date'), ('device_master', 'last_maintenance'),
             ('device_master', 'next_scheduled_maintenance'), ('maintenance', 'maintenance_date'), ('maintenance', 'scheduled_date'),
             ('failures', 'failure_timestamp'), ('failures', 'repair_timestamp')) v(t, c)"""
    ),
    "required_fields": sql(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS field, 1::BIGINT AS present, {_without_value(t, c)} + 0 * count(*) AS rows_without_value FROM {t}"
        for t, columns in _COLUMNS.items() for c in columns.split()
    )),
    "failures_before_install": sql(
        "SELECT count(*) AS failures_before_install FROM failures f JOIN device_master d ON f.device_id = d.device_id "
        "WHERE f.failure_timestamp < d.installation_date"
    ),
    "severity_readiness": sql(
        """SELECT severity, failures, round(pct, 8) AS major_critical_pct, CAST(pct >= 50 AS BIGINT) AS ready
           FROM (SELECT severity, count(*) AS failures FROM failures GROUP BY 1),
                (SELECT 100.0::DOUBLE * count(*) FILTER (WHERE severity IN ('major', 'critical')) / count(*) AS pct FROM failures)"""
    ),
    "device_coverage": sql(
        """SELECT count(*) AS devices,
                  round(100.0::DOUBLE * count(*) FILTER (WHERE device_id IN (SELECT device_id FROM telemetry)) / count(*), 8) AS with_telemetry_pct,
                  round(100.0::DOUBLE * count(*) FILTER (WHERE device_id IN (SELECT device_id FROM failures)) / count(*), 8) AS with_failures_pct
           FROM device_master"""
    ),
    "missing_values": sql(
        "SELECT column_name, CAST(missing AS BIGINT) AS missing FROM (" + " UNION ALL ".join(_MISSING) + ")"
        " UNION ALL SELECT '(total)', CAST(sum(missing) AS BIGINT) FROM (" + " UNION ALL ".join(_MISSING) + ")"
    ),
    "missing_values_ml": sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM training_rows"
            for c in f"{_ML_PLAIN} {_ML_INTS} {_ML_NUMS}".split()
        ) + " UNION ALL SELECT '(total)', CAST(sum(m) AS BIGINT) FROM ("
        + " UNION ALL ".join(
            f"SELECT count(*) - count({c}) AS m FROM training_rows" for c in f"{_ML_PLAIN} {_ML_INTS} {_ML_NUMS}".split()
        ) + ")"
    ),
    "duplicate_rows": sql(
        "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ml_table)) AS BIGINT) AS duplicates FROM ml_table"
    ),
}


def _frequency(table: str, column: str, weight: str = "count(*)") -> str:
    return sql(
        f"""SELECT {column} AS value, CAST(c AS BIGINT) AS count, round(100.0::DOUBLE * c / total, 8) AS percentage
            FROM (SELECT {column}, c, sum(c) OVER () AS total FROM (SELECT {column}, {weight} AS c FROM {table} GROUP BY 1))
            WHERE {column} IS NOT NULL"""
    )


def _plain_frequency(table: str, column: str) -> str:
    return sql(f"SELECT {column} AS value, count(*) AS count FROM {table} WHERE {column} IS NOT NULL GROUP BY 1")


def _describe(table: str, column: str) -> str:
    c = f"CAST({column} AS DOUBLE)"
    return sql(
        f"""SELECT count({c}) AS count, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS std, round(min({c}), 8) AS min,
                   round(quantile_cont({c}, 0.25), 8) AS p25, round(quantile_cont({c}, 0.5), 8) AS p50,
                   round(quantile_cont({c}, 0.75), 8) AS p75, round(max({c}), 8) AS max FROM {table}"""
    )


def _histogram(table: str, column: str, bins: int, group: str) -> str:
    return sql(
        f"""SELECT g AS reading_type, CAST(b AS BIGINT) AS bin, round(lo + b * w, 8) AS bin_low, round(lo + (b + 1) * w, 8) AS bin_high,
                   coalesce(c, 0) AS count, round(coalesce(c, 0) / (n * w), 8) AS density
            FROM (SELECT *, (hi - lo) / {bins}.0::DOUBLE AS w, unnest(range(0, {bins})) AS b
                  FROM (SELECT {group} AS g, CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi, count({column}) AS n
                        FROM {table} GROUP BY 1)) e
            LEFT JOIN (SELECT {group} AS g2, least(CAST(floor(({column} - lo) * {bins}.0::DOUBLE / (hi - lo)) AS BIGINT), {bins - 1}) AS b2, count(*) AS c
                       FROM {table} t JOIN (SELECT {group} AS g3, CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi
                                            FROM {table} GROUP BY 1) m ON {group.replace("reading_type", "t.reading_type")} = m.g3
                       WHERE {column} IS NOT NULL GROUP BY 1, 2) h ON e.g = h.g2 AND e.b = h.b2"""
    )


SUMMARY_NUMBERS = (
    "device_age_days", "days_since_maintenance", "avg_reading", "reading_std", "reading_count", "poor_quality_ratio",
    "failure_count", "high_severity_count", "unresolved_count", "total_maintenance_cost", "maintenance_count",
    "avg_maintenance_cost", "total_maintenance_hours",
    "device_type_encoded", "facility_encoded", "manufacturer_encoded", "status_encoded",
)
_PAIRS = [(a, b) for i, a in enumerate(SUMMARY_NUMBERS) for b in SUMMARY_NUMBERS[i + 1:]]


def _correlations(where: str = "") -> str:
    cells = ", ".join(
        f"{{'feature1': '{a}', 'feature2': '{b}', 'r': CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 "
        f"THEN corr({a}, {b}) END}}"
        for a, b in _PAIRS
    )
    return sql(
        f"SELECT p.feature1 AS feature1, p.feature2 AS feature2, round(p.r, 8) AS correlation "
        f"FROM (SELECT unnest([{cells}]) AS p FROM summary) {where}"
    )


_NAMED = [
    ("device_age_days", "maintenance_count"),
    ("failure_count", "total_maintenance_cost"),
    ("failure_count", "poor_quality_ratio"),
]

_K2 = """
SELECT reading_type, n AS n_samples, round(k2, 3) AS k2, round(exp(-k2 / 2), 8) AS p_value,
       CASE WHEN k2 IS NOT NULL THEN CAST(exp(-k2 / 2) > 0.05 AS BIGINT) END AS is_normal
FROM (
  SELECT reading_type, n,
         pow(delta * asinh(y / alpha), 2)
         + pow((1 - 2 / (9 * a) - sign(d) * pow((1 - 2 / a) / abs(d), 1.0::DOUBLE / 3)) / sqrt(2 / (9 * a)), 2) AS k2
  FROM (
    SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2 / (w2 - 1)) AS alpha, 1 + x * sqrt(2 / (a - 4)) AS d
    FROM (
      SELECT *, sqrt(2 * (beta - 1)) - 1 AS w2, 6 + (8 / s) * (2 / s + sqrt(1 + 4 / (s * s))) AS a
      FROM (
        SELECT reading_type, n,
               skewness * sqrt((q + 1) * (q + 3) / (6 * (q - 2))) AS y,
               3 * (q * q + 27 * q - 70) * (q + 1) * (q + 3) / ((q - 2) * (q + 5) * (q + 7) * (q + 9)) AS beta,
               (kurtosis + 3 - 3 * (q - 1) / (q + 1)) / sqrt(24 * q * (q - 2) * (q - 3) / ((q + 1) * (q + 1) * (q + 3) * (q + 5))) AS x,
               6 * (q * q - 5 * q + 2) / ((q + 7) * (q + 9)) * sqrt(6 * (q + 3) * (q + 5) / (q * (q - 2) * (q - 3))) AS s
        FROM (SELECT *, CAST(n AS DOUBLE) AS q FROM reading_moments WHERE n >= 8)))))"""

EXPLORE = {
    "freq_device_type": _frequency("device_master", "device_type"),
    "freq_status": _frequency("device_master", "status"),
    "freq_facility": _plain_frequency("device_master", "facility"),
    "freq_manufacturer": _plain_frequency("device_master", "manufacturer"),
    "freq_quality": _frequency("readings", "quality", "sum(n)"),
    "freq_reading_type": _plain_frequency("long_readings", "reading_type"),
    "freq_failure_type": _frequency("failures", "failure_type"),
    "freq_severity": _frequency("failures", "severity"),
    "freq_maintenance_type": _frequency("maintenance", "maintenance_type"),
    "describe_device_age": _describe("clocks", "device_age_days"),
    "describe_value": _describe("long_readings", "value"),
    "describe_readings_per_device": _describe("per_device", "readings"),
    "describe_resolution_hours": _describe("resolution", "resolution_hours"),
    "describe_duration_hours": _describe("(SELECT duration_minutes / 60.0::DOUBLE AS h FROM maintenance)", "h"),
    "long_readings": _select("long_readings", "device_id timestamp reading_type quality", "", "value"),
    "device_clocks": _select("clocks", "device_id", "device_age_days days_since_maintenance days_to_next_maintenance"),
    "telemetry_extent": sql(
        """SELECT CAST(sum(n) AS BIGINT) AS readings, count(DISTINCT device_id) AS devices,
                  (SELECT count(DISTINCT reading_type) FROM long_readings) AS reading_types,
                  min("timestamp") AS first_time, max("timestamp") AS last_time,
                  CAST(floor(epoch(max("timestamp") - min("timestamp")) / 86400) AS BIGINT) AS days
           FROM readings WHERE n > 0"""
    ),
    "readings_per_device": _select("per_device", "device_id", "readings"),
    "reading_type_moments": sql(
        """SELECT reading_type, n AS count, round(mean, 8) AS mean, round(std, 8) AS std, round(lo, 8) AS min, round(hi, 8) AS max,
                  round(skewness, 8) AS skewness, round(kurtosis, 8) AS kurtosis,
                  round(CASE WHEN mean = 0 THEN 0 ELSE std / mean END, 8) AS cv FROM reading_moments"""
    ),
    "readings_by_hour": sql(
        """SELECT CAST(hour("timestamp") AS BIGINT) AS hour, CAST(sum(n) AS BIGINT) AS readings
           FROM readings WHERE "timestamp" IS NOT NULL GROUP BY 1"""
    ),
    "readings_by_weekday": sql(
        """SELECT CAST(isodow("timestamp") - 1 AS BIGINT) AS weekday, CAST(sum(n) AS BIGINT) AS readings
           FROM readings WHERE "timestamp" IS NOT NULL GROUP BY 1"""
    ),
    "readings_by_date": sql(
        """SELECT strftime("timestamp", '%Y-%m-%d') AS date, CAST(sum(n) AS BIGINT) AS readings
           FROM readings WHERE "timestamp" IS NOT NULL GROUP BY 1"""
    ),
    "peak_low_hour": sql(
        """, by_hour AS (SELECT CAST(hour("timestamp") AS BIGINT) AS h, CAST(sum(n) AS BIGINT) AS r
                         FROM readings WHERE "timestamp" IS NOT NULL GROUP BY 1)
           SELECT (SELECT h FROM by_hour ORDER BY r DESC, h LIMIT 1) AS peak_hour, (SELECT max(r) FROM by_hour) AS peak_readings,
                  (SELECT h FROM by_hour ORDER BY r, h LIMIT 1) AS low_hour, (SELECT min(r) FROM by_hour) AS low_readings"""
    ),
    "device_time_points": sql(
        """SELECT device_id, CAST(sum(n) AS BIGINT) AS readings, count(DISTINCT "timestamp") AS time_points
           FROM readings WHERE n > 0 GROUP BY 1"""
    ),
    "failure_totals": sql(
        """SELECT count(*) AS failures, count(DISTINCT device_id) AS devices,
                  round(100.0::DOUBLE * count(repair_timestamp) / count(*), 8) AS resolution_rate_pct FROM failures"""
    ),
    "failures_by_facility": sql(
        "SELECT facility, count(*) AS failures FROM failures f JOIN device_master d ON f.device_id = d.device_id GROUP BY 1"
    ),
    "maintenance_totals": sql(
        """SELECT count(*) AS records, count(DISTINCT device_id) AS devices, round(avg(cost), 8) AS avg_cost,
                  round(sum(cost), 4) AS total_cost FROM maintenance"""
    ),
    "cost_by_type": sql(
        """SELECT maintenance_type, round(avg(cost), 8) AS avg_cost, round(sum(cost), 4) AS total_cost, count(cost) AS records
           FROM maintenance GROUP BY 1"""
    ),
    "schedule_adherence": sql(
        """SELECT count(*) FILTER (WHERE v = 0) AS on_time, count(*) FILTER (WHERE v < 0) AS early,
                  count(*) FILTER (WHERE v > 0) AS late, round(avg(v), 8) AS avg_delay_days
           FROM (SELECT floor(epoch(maintenance_date - scheduled_date) / 86400) AS v FROM maintenance)"""
    ),
    "device_summary": sql(
        """SELECT device_id, device_type, facility, manufacturer, status,
                  CAST(device_age_days AS BIGINT) AS device_age_days, CAST(days_since_maintenance AS BIGINT) AS days_since_maintenance,
                  avg_reading, reading_std, CAST(reading_count AS BIGINT) AS reading_count, poor_quality_ratio,
                  failure_count, high_severity_count, unresolved_count, round(total_maintenance_cost, 4) AS total_maintenance_cost,
                  maintenance_count, round(avg_maintenance_cost, 8) AS avg_maintenance_cost,
                  round(total_maintenance_hours, 6) AS total_maintenance_hours,
                  device_type_encoded, facility_encoded, manufacturer_encoded, status_encoded FROM summary"""
    ),
    "correlation_pairs": _correlations(),
    "strong_correlations": _correlations("WHERE abs(p.r) >= 0.3"),
    "named_correlations": sql(" UNION ALL ".join(
        f"SELECT '{a}' AS feature1, '{b}' AS feature2, round(corr({a}, {b}), 8) AS correlation FROM summary" for a, b in _NAMED
    )),
    "normality_k2": sql(_K2),
    "hist_device_age": _histogram("clocks", "device_age_days", 30, "'device_age_days'"),
    "hist_days_since_maintenance": _histogram("clocks", "days_since_maintenance", 30, "'days_since_maintenance'"),
    "hist_readings_per_device": _histogram("per_device", "readings", 30, "'readings'"),
    "hist_resolution_hours": _histogram("resolution", "resolution_hours", 20, "'resolution_hours'"),
    "hist_value_by_type": _histogram("long_readings", "value", 50, "reading_type"),
    "headline_kpis": sql(
        """SELECT metric, round(CAST(value AS DOUBLE), 4) AS value FROM (
             SELECT 'devices' AS metric, CAST(count(*) AS DOUBLE) AS value FROM device_master
             UNION ALL SELECT 'active_devices', count(*) FROM device_master WHERE status = 'active'
             UNION ALL SELECT 'active_pct', 100.0::DOUBLE * count(*) FILTER (WHERE status = 'active') / count(*) FROM device_master
             UNION ALL SELECT 'readings', count(*) FROM long_readings
             UNION ALL SELECT 'poor_quality_pct', 100.0::DOUBLE * count(*) FILTER (WHERE quality = 'poor') / count(*) FROM long_readings
             UNION ALL SELECT 'readings_per_device', CAST(count(*) AS DOUBLE) / count(DISTINCT device_id) FROM long_readings
             UNION ALL SELECT 'failures', count(*) FROM failures
             UNION ALL SELECT 'resolution_rate_pct', 100.0::DOUBLE * count(repair_timestamp) / count(*) FROM failures
             UNION ALL SELECT 'failures_per_device', CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM device_master) FROM failures
             UNION ALL SELECT 'maintenance_records', count(*) FROM maintenance
             UNION ALL SELECT 'avg_maintenance_cost', avg(cost) FROM maintenance
             UNION ALL SELECT 'total_maintenance_cost', sum(cost) FROM maintenance)"""
    ),
}

def _features(source: str, digits: int = 8) -> str:
    cols = ", ".join(f"round({c}, {digits}) AS {c}" for c in FEATURES)
    return sql(f"SELECT device_id, hour_bucket, failure_type, severity, round(days_before_failure, 8) AS days_before_failure, {cols} FROM {source}")


def _scaled() -> str:
    cols = []
    for c in FEATURES:
        spread = f"(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM ml_clipped)"
        cols.append(
            f"round(({c} - (SELECT median({c}) FROM ml_clipped)) / CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END, 8) AS {c}"
        )
    return sql(
        "SELECT device_id, hour_bucket, failure_type, severity, round(days_before_failure, 8) AS days_before_failure, "
        + ", ".join(cols) + " FROM ml_clipped"
    )


def _selective(kind: str) -> str:
    cols = []
    for c in FEATURES:
        if kind == "robust":
            centre = f"(SELECT median({c}) FROM ml_clipped)"
            spread = f"(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM ml_clipped)"
        else:
            centre = f"(SELECT avg({c}) FROM ml_clipped)"
            spread = f"(SELECT stddev_pop({c}) FROM ml_clipped)"
        cols.append(
            f"round(CASE WHEN (SELECT count(DISTINCT {c}) FROM ml_clipped) <= 2 THEN {c} "
            f"ELSE ({c} - {centre}) / CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END END, 8) AS {c}"
        )
    return sql(
        "SELECT device_id, hour_bucket, failure_type, severity, round(days_before_failure, 8) AS days_before_failure, "
        + ", ".join(cols) + " FROM ml_clipped"
    )


_METRICS = """
SELECT n AS "rows", round(hits / n, 8) AS accuracy, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 8) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 8) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 8) AS f1
FROM (SELECT count(*) AS n, CAST(count(*) FILTER (WHERE predicted = will_fail) AS DOUBLE) AS hits,
             CAST(count(*) FILTER (WHERE predicted = 1 AND will_fail = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE predicted = 1 AND will_fail = 0) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE predicted = 0 AND will_fail = 1) AS DOUBLE) AS fn FROM scored)"""

_REPORT = """
SELECT "class", round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM (
  SELECT "class", precision, recall, f1, support FROM per_class
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)"""
_PER_CLASS = """, per_class AS (
  SELECT CAST(c AS VARCHAR) AS "class", tp, support, CASE WHEN called = 0 THEN 0 ELSE tp / called END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
         CASE WHEN support + called = 0 THEN 0 ELSE 2 * tp / (support + called) END AS f1
  FROM (SELECT c, CAST(count(*) FILTER (WHERE will_fail = c AND predicted = c) AS DOUBLE) AS tp,
               count(*) FILTER (WHERE will_fail = c) AS support, CAST(count(*) FILTER (WHERE predicted = c) AS DOUBLE) AS called
        FROM scored, (VALUES (0), (1)) v(c) GROUP BY c))"""

_INDICATOR_ROWS = """, indicator_rows AS (
  SELECT r.device_id, hour_bucket, failure_type, severity, days_before_failure, 'is_' || t.device_type AS indicator,
         CAST(r.device_type = t.device_type AS DOUBLE) AS value
  FROM ml_clipped r, (SELECT DISTINCT device_type FROM ml_clipped) t)
"""

LEARNING = {
    "training_input": _select("training_rows", _ML_PLAIN, _ML_INTS, _ML_NUMS),
    "ml_imputed": sql(
        "SELECT device_id, failure_type, severity, round(days_before_failure, 8) AS days_before_failure, "
        + ", ".join(f"round({c}, 8) AS {c}" for c in FEATURES[:14]) + " FROM ml_filled"
    ),
    "ml_encoded": sql(
        "SELECT device_id, hour_bucket, CAST(device_type_encoded AS BIGINT) AS device_type_encoded, "
        "CAST(location_encoded AS BIGINT) AS location_encoded, "
        "CAST(dense_rank() OVER (ORDER BY failure_type) - 1 AS BIGINT) AS failure_type_encoded, "
        "CAST(dense_rank() OVER (ORDER BY severity) - 1 AS BIGINT) AS severity_encoded, "
        + ", ".join(f"CAST(device_type = '{t}' AS BIGINT) AS \"is_{t}\"" for t in TYPE_CLASSES[:8])
        + " FROM ml_derived"
    ),
    "ml_derived": _features("ml_derived"),
    "ml_clipped": _features("ml_clipped"),
    "ml_robust_scaled": _scaled(),
    "ml_selective_robust": _selective("robust"),
    "ml_selective_standard": _selective("standard"),
    "ml_validation": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {int(c == 'will_fail')}::BIGINT AS is_label, 0::BIGINT AS non_numeric, "
        f"count(*) - count({c}) AS missing, count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS infinite, "
        f"CAST(count(DISTINCT {c}) <= 1 AS BIGINT) AS constant FROM ml_clipped"
        for c in FEATURES + ("will_fail",)
    ) + """ UNION ALL SELECT 'is_' || device_type, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT,
                             CAST(count(*) = (SELECT count(*) FROM ml_clipped) AS BIGINT) FROM ml_clipped GROUP BY device_type"""),
    "ml_indicators": sql(_INDICATOR_ROWS + "SELECT device_id, hour_bucket, failure_type, severity, round(days_before_failure, 8) AS days_before_failure, indicator, value FROM indicator_rows"),
    "ml_indicators_scaled": sql(
        _INDICATOR_ROWS + """SELECT device_id, hour_bucket, failure_type, severity, round(days_before_failure, 8) AS days_before_failure,
                                    indicator, round((value - q2) / CASE WHEN q3 = q1 THEN 1 ELSE q3 - q1 END, 8) AS value
        FROM indicator_rows JOIN (SELECT indicator, quantile_cont(value, 0.25) AS q1, median(value) AS q2, quantile_cont(value, 0.75) AS q3
                                  FROM indicator_rows GROUP BY 1) USING (indicator)"""
    ),
    "stratified_split": sql(
        "SELECT device_id, hour_bucket, failure_type, severity, round(days_before_failure, 8) AS days_before_failure, "
        "CAST(will_fail AS BIGINT) AS will_fail, CAST(is_test AS BIGINT) AS is_test FROM split"
    ),
    "class_weights": sql(
        """SELECT CAST(will_fail AS BIGINT) AS will_fail, count(*) AS "rows",
                  round((SELECT count(*) FROM split WHERE is_test = 0) / ((SELECT count(DISTINCT will_fail) FROM split WHERE is_test = 0) * CAST(count(*) AS DOUBLE)), 8) AS weight
           FROM split WHERE is_test = 0 GROUP BY 1"""
    ),
    "class_balance": sql(
        """SELECT count(*) FILTER (WHERE will_fail = 0) AS negatives, count(*) FILTER (WHERE will_fail = 1) AS positives,
                  round(count(*) FILTER (WHERE will_fail = 0) / count(*) FILTER (WHERE will_fail = 1), 8) AS imbalance_ratio FROM training_rows"""
    ),
    "training_cutoff": sql("SELECT max(hour_bucket) AS cutoff FROM training_rows"),
    "scoring_input": _select(
        "(SELECT * FROM ml_table WHERE hour_bucket > TIMESTAMP '2024-01-20 00:00:00')",
        _ML_PLAIN, _ML_INTS.replace("will_fail ", ""), _ML_NUMS,
    ),
    "classification_metrics": sql(_METRICS),
    "confusion_matrix": sql(
        "SELECT CAST(will_fail AS BIGINT) AS actual, CAST(predicted AS BIGINT) AS predicted, count(*) AS \"rows\" FROM scored GROUP BY 1, 2"
    ),
    "classification_report": sql(_PER_CLASS + "\n" + _REPORT),
    "roc_auc": sql(
        """SELECT round((sum(rk) FILTER (WHERE will_fail = 1) - np * (np + 1) / 2) / (np * nn), 8) AS roc_auc, CAST(0 AS BIGINT) AS unscored
           FROM (SELECT will_fail, rank() OVER (ORDER BY risk) + (count(*) OVER (PARTITION BY risk) - 1) / 2 AS rk FROM scored),
                (SELECT CAST(count(*) FILTER (WHERE will_fail = 1) AS DOUBLE) AS np, CAST(count(*) FILTER (WHERE will_fail = 0) AS DOUBLE) AS nn FROM scored)
           GROUP BY np, nn"""
    ),
    "roc_auc_temperature": sql(
        """SELECT round((sum(rk) FILTER (WHERE will_fail = 1) - np * (np + 1) / 2) / (np * nn), 8) AS roc_auc, CAST(0 AS BIGINT) AS unscored
           FROM (SELECT will_fail, rank() OVER (ORDER BY t) + (count(*) OVER (PARTITION BY t) - 1) / 2 AS rk
                 FROM (SELECT will_fail, round(avg_temperature, 6) AS t FROM training_rows WHERE avg_temperature IS NOT NULL)),
                (SELECT CAST(count(*) FILTER (WHERE will_fail = 1) AS DOUBLE) AS np, CAST(count(*) FILTER (WHERE will_fail = 0) AS DOUBLE) AS nn
                 FROM training_rows WHERE avg_temperature IS NOT NULL)
           GROUP BY np, nn"""
    ),
    "roc_auc_gaps": sql(
        """SELECT round((sum(rk) FILTER (WHERE will_fail = 1) - np * (np + 1) / 2) / (np * nn), 8) AS roc_auc, missing AS unscored
           FROM (SELECT will_fail, rank() OVER (ORDER BY t) + (count(*) OVER (PARTITION BY t) - 1) / 2 AS rk
                 FROM (SELECT will_fail, round(avg_temperature, 6) AS t FROM training_rows WHERE avg_temperature IS NOT NULL AND reading_count % 7 <> 0)),
                (SELECT CAST(count(*) FILTER (WHERE will_fail = 1) AS DOUBLE) AS np, CAST(count(*) FILTER (WHERE will_fail = 0) AS DOUBLE) AS nn
                 FROM training_rows WHERE avg_temperature IS NOT NULL AND reading_count % 7 <> 0),
                (SELECT count(*) AS missing FROM training_rows WHERE avg_temperature IS NULL OR reading_count % 7 = 0)
           GROUP BY np, nn, missing"""
    ),
}

_CUT = """, cut_rows AS (
  SELECT *, md5(concat_ws('|', '42', coalesce(device_id, '~'), coalesce(CAST(epoch_us(hour_bucket) AS VARCHAR), '~'), coalesce(failure_type, '~'), coalesce(severity, '~'))) AS hash,
         md5(concat_ws('|', '43', coalesce(device_id, '~'), coalesce(CAST(epoch_us(hour_bucket) AS VARCHAR), '~'), coalesce(failure_type, '~'), coalesce(severity, '~'))) AS fold_hash
  FROM training_rows WHERE hour_bucket <= TIMESTAMP '2024-01-20 00:00:00'),
cut_split AS (
  SELECT *, CAST(rank() OVER (PARTITION BY will_fail ORDER BY hash) <=
                 floor(0.2::DOUBLE * count(*) OVER (PARTITION BY will_fail) + 0.5) AS BIGINT) AS is_test,
         CAST('0x' || substr(fold_hash, 1, 8) AS BIGINT) % 3 AS fold
  FROM cut_rows)
"""
_GRID = ", ".join(
    f"({8 * a + 4 * b + 2 * c + d}, {t}, {x}, {r}::DOUBLE, {m})"
    for a, t in enumerate((50, 100)) for b, x in enumerate((3, 5)) for c, r in enumerate((0.1, 0.2)) for d, m in enumerate((5, 10))
)
_NEW_ROWS = "(SELECT *, {extra} FROM ml_table WHERE hour_bucket > TIMESTAMP '2024-01-20 00:00:00')"

# What of the trained models does not depend on how their trees came out.
MODELS = {
    "gbt_cv_folds": sql(
        _CUT + """SELECT device_id, hour_bucket, failure_type, severity, CAST(will_fail AS BIGINT) AS will_fail, fold
                  FROM cut_split WHERE is_test = 0"""
    ),
    "gbt_grid_check": sql(
        _CUT + f"""SELECT candidate::BIGINT AS candidate, trees::BIGINT AS trees, depth::BIGINT AS depth, learning_rate,
                          min_split_rows::BIGINT AS min_split_rows, (SELECT count(DISTINCT fold) FROM cut_split WHERE is_test = 0) AS fold_areas,
                          (SELECT count(*) FROM cut_split WHERE is_test = 0) AS scored_rows, 1::BIGINT AS same_area
                   FROM (VALUES {_GRID}) g(candidate, trees, depth, learning_rate, min_split_rows)"""
    ),
    "gbt_metrics_check": sql(
        _CUT + """SELECT is_test, count(*) AS "rows", CAST(sum(will_fail) AS BIGINT) AS positives, 1::BIGINT AS same_metrics
                  FROM cut_split GROUP BY is_test"""
    ),
    "gbt_predictions_check": _select(
        _NEW_ROWS.format(extra="1::BIGINT AS sound"), "device_id hour_bucket failure_type severity", "sound", "days_before_failure"
    ),
    # Scoring starts after the latest hour the model has seen, which may lie before the cutoff.
    "gbt_score_new": sql(
        _CUT + """SELECT device_id, hour_bucket, failure_type, severity, round(CAST(days_before_failure AS DOUBLE), 8) AS days_before_failure,
                         2::BIGINT AS batches
                  FROM ml_table WHERE hour_bucket > (SELECT max(hour_bucket) FROM cut_rows)"""
    ),
}

STREAMS = {
    "bronze_device_master": _select(
        """(SELECT device_id, device_type, location, facility, strftime(installation_date, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS installation_date,
                   firmware_version, model, manufacturer, status,
                   strftime(last_maintenance, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS last_maintenance,
                   strftime(next_scheduled_maintenance, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS next_scheduled_maintenance,
                   1 AS has_lineage FROM device_master)""",
        _COLUMNS["device_master"], "has_lineage",
    ),
    "bronze_telemetry": _select(
        """(SELECT device_id, temperature, pressure, vibration, humidity, power_consumption, flow_rate, valve_position, motor_speed,
                   CASE WHEN e % 500 = 0 THEN strftime(spoken, '%Y-%m-%dT%H:%M:%S')
                        ELSE strftime(spoken, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' END AS "timestamp",
                   'STALE' AS location, 'STALE' AS facility, 1 AS has_lineage FROM telemetry)""",
        "device_id timestamp location facility", "has_lineage", _SENSORS,
    ),
    "bronze_maintenance": _select(
        """(SELECT * REPLACE (strftime(maintenance_date, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS maintenance_date,
                              strftime(scheduled_date, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS scheduled_date),
                   1 AS has_lineage FROM maintenance)""",
        "device_id maintenance_id maintenance_type maintenance_date scheduled_date technician description parts_replaced",
        "duration_minutes has_lineage", "cost",
    ),
    "bronze_maintenance_arrays": _select(
        """(SELECT * REPLACE (strftime(maintenance_date, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS maintenance_date,
                              strftime(scheduled_date, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS scheduled_date),
                   3 AS batches FROM maintenance)""",
        "device_id maintenance_id maintenance_type maintenance_date scheduled_date technician description parts_replaced",
        "duration_minutes batches", "cost",
    ),
    "bronze_failures": _select(
        """(SELECT * REPLACE (strftime(failure_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS failure_timestamp,
                              strftime(repair_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '.000000' AS repair_timestamp),
                   1 AS has_lineage FROM failures)""",
        "device_id failure_id failure_timestamp repair_timestamp failure_type severity root_cause repair_action",
        "has_lineage", "cost",
    ),
    "stream_telemetry_clean": TABLES["telemetry_clean"],
    "stream_telemetry_clean_split": TABLES["telemetry_clean"],
    "stream_device_master_clean": TABLES["device_master_clean"],
    "stream_maintenance_analytics": TABLES["maintenance_analytics"],
    "stream_failure_labels": TABLES["failure_labels"],
    "stream_hourly_features": TABLES["device_features_hourly"],
    # The watermark of the one data batch is an hour before the last reading: hours that end by then are closed by it.
    "stream_hourly_features_ways": sql(
        """SELECT count(*) FILTER (WHERE hour_bucket + INTERVAL 1 HOUR <= (SELECT max("timestamp") - INTERVAL 1 HOUR FROM telemetry_clean)) AS closed,
                  count(*) FILTER (WHERE hour_bucket + INTERVAL 1 HOUR > (SELECT max("timestamp") - INTERVAL 1 HOUR FROM telemetry_clean)) AS drained,
                  count(*) FILTER (WHERE hour_bucket IS NULL) AS timeless FROM hourly"""
    ),
    "stream_ml_features": TABLES["predictive_maintenance_features"],
}


def _all_hold() -> str:
    return " AND ".join(f"coalesce({p}, FALSE)" for p in _RULES["telemetry"][1].values())


def _broken() -> str:
    return ", ".join(f"CASE WHEN NOT coalesce({p}, FALSE) THEN '{name}' END" for name, p in _RULES["telemetry"][1].items())


SAME = {
    "stream_expect_telemetry": CHECKS["expect_telemetry"],
    "expect_telemetry_dropped": _select(
        f"(SELECT * FROM telemetry_clean WHERE {_all_hold()})",
        "device_id timestamp reading_hour device_type location facility manufacturer model",
        "hour_of_day day_of_week days_since_installation days_since_last_maintenance days_to_next_maintenance",
        _SENSORS,
        "reading_date",
    ),
    "expect_telemetry_quarantined": _select(
        f"""(SELECT device_id, "timestamp", pressure, concat_ws(',', {_broken()}) AS broken_rules
             FROM telemetry_clean WHERE NOT ({_all_hold()}))""",
        "device_id timestamp broken_rules", "", "pressure",
    ),
    "telemetry_clean_shuffled": TABLES["telemetry_clean"],
    "telemetry_clean_latest": TABLES["telemetry_clean"],
}


def _declared() -> str:
    """(table, rows from, quality, key, comment, rules) as the tables declare them."""
    rows = [
        *((f"bronze_{n}", n, "bronze", "", f"{n} rows as they arrived", None) for n in ("telemetry", "device_master", "maintenance", "failures")),
        ("telemetry_clean", "telemetry_clean", "silver", "", "Readings of active devices with repaired times", "telemetry"),
        ("device_master_clean", "device_master_clean", "silver", "device_id", "Devices with their clocks", "devices"),
        ("maintenance_clean", "maintenance_clean", "silver", "maintenance_id", "Maintenance with delays", "maintenance"),
        ("failures_clean", "failures_clean", "silver", "failure_id", "Failures with severity scores and downtime", "failures"),
        ("device_health_metrics", "health", "silver", "", "Readings with trends and anomaly scores", None),
        ("device_features", "hourly", "gold", "", "Hourly features", None),
        ("failure_labels", "labels_hourly", "gold", "", "Hours before a failure", None),
        ("ml_features", "ml_table", "gold", "device_id,hour_bucket", "The learning table", None),
        ("health_dashboard", "hourly", "gold", "", "Device status", None),
        ("maintenance_analytics", "maintenance_clean", "gold", "", "Maintenance by month", None),
    ]
    parts = []
    for name, source, quality, key, comment, rules in rows:
        broken = "0" if not key else (
            f"(SELECT count(*) FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1))")
        failed = "0" if rules is None else (
            "(SELECT " + " + ".join(f"count(*) FILTER (WHERE NOT coalesce({p}, FALSE))" for p in _RULES[rules][1].values())
            + f" FROM {source})")
        parts.append(
            f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {source}) AS \"rows\", CAST({broken} AS BIGINT) AS broken_keys, "
            f"CAST({failed} AS BIGINT) AS failed, '{quality}' AS quality, '{key}' AS \"key\", '{comment}' AS comment")
    return sql(" UNION ALL ".join(parts))


DECLARED = {
    "declared_tables": _declared(),
    "declared_learning_table": TABLES["predictive_maintenance_features"],
    "declared_labels_followed": TABLES["failure_labels"],
}


def oracle_sql() -> dict[str, str]:
    return {**SAME, **TABLES, **CHECKS, **EXPLORE, **LEARNING, **MODELS, **STREAMS, **DECLARED}
