"""Declared schemas: four raw entities and the machine-learning table.

Field names and types are fixed values: landing files carry exactly these. Raw
timestamps stay text until repaired. File sources ignore declared nullability, so
required fields are checked by quality rules instead.
"""

from __future__ import annotations


DEVICE_MASTER_DDL = """
    device_id STRING, device_type STRING, location STRING, facility STRING,
    installation_date STRING, firmware_version STRING, model STRING, manufacturer STRING,
    status STRING, last_maintenance STRING, next_scheduled_maintenance STRING
"""

TELEMETRY_DDL = """
    device_id STRING, timestamp STRING,
    temperature DOUBLE, pressure DOUBLE, vibration DOUBLE, humidity DOUBLE,
    power_consumption DOUBLE, flow_rate DOUBLE, valve_position DOUBLE, motor_speed DOUBLE,
    location STRING, facility STRING
"""

MAINTENANCE_DDL = """
    device_id STRING, maintenance_id STRING, maintenance_type STRING,
    maintenance_date STRING, scheduled_date STRING, duration_minutes INT,
    technician STRING, description STRING, parts_replaced STRING, cost DOUBLE
"""

FAILURES_DDL = """
    device_id STRING, failure_id STRING, failure_timestamp STRING, repair_timestamp STRING,
    failure_type STRING, severity STRING, root_cause STRING, repair_action STRING, cost DOUBLE
"""

ML_FEATURES_DDL = """
    device_id STRING, hour_bucket TIMESTAMP, device_type STRING, location STRING,
    avg_temperature DOUBLE, avg_vibration DOUBLE, avg_pressure DOUBLE, avg_power DOUBLE,
    high_temperature INT, high_vibration INT, needs_maintenance_soon INT, health_score DOUBLE,
    days_since_maintenance INT, will_fail INT, failure_type STRING, severity STRING,
    days_before_failure DOUBLE, reading_count BIGINT, has_sufficient_data INT
"""

ML_FEATURES_KEY = ("device_id", "hour_bucket")

RAW_DDL = {
    "device_master": DEVICE_MASTER_DDL,
    "telemetry": TELEMETRY_DDL,
    "maintenance": MAINTENANCE_DDL,
    "failures": FAILURES_DDL,
}


def columns_of(ddl: str) -> list[str]:
    """Column names of a flat DDL text, in order."""
    return [part.split()[0] for part in ddl.replace("\n", " ").split(",")]
