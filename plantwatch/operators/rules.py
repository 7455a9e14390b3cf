"""Declarative row-quality rules: keep every row, count what each rule rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rule names and predicates per cleaned table.
TELEMETRY_RULES = {
    "valid_device_id": "device_id IS NOT NULL AND device_id != ''",
    "valid_timestamp": "timestamp IS NOT NULL",
    "reasonable_temperature": "temperature IS NULL OR (temperature BETWEEN -50 AND 150)",
    "reasonable_pressure": "pressure IS NULL OR (pressure BETWEEN 0 AND 2000)",
    "reasonable_vibration": "vibration IS NULL OR (vibration BETWEEN 0 AND 100)",
    "reasonable_humidity": "humidity IS NULL OR (humidity BETWEEN 0 AND 100)",
    "reasonable_power": "power_consumption IS NULL OR (power_consumption >= 0)",
    "reasonable_flow_rate": "flow_rate IS NULL OR (flow_rate >= 0)",
    "reasonable_motor_speed": "motor_speed IS NULL OR (motor_speed >= 0)",
}
DEVICE_RULES = {
    "valid_device_id": "device_id IS NOT NULL AND device_id != ''",
    "valid_device_type": "device_type IS NOT NULL",
    "valid_status": "status IN ('active', 'inactive', 'maintenance', 'failed')",
    "valid_facility": "facility IS NOT NULL",
    "valid_manufacturer": "manufacturer IS NOT NULL",
    "valid_installation_date": "installation_date IS NOT NULL",
}
MAINTENANCE_RULES = {
    "valid_device_id": "device_id IS NOT NULL",
    "valid_maintenance_id": "maintenance_id IS NOT NULL",
    "valid_maintenance_date": "maintenance_date IS NOT NULL",
    "valid_duration": "duration_minutes IS NULL OR duration_minutes > 0",
}
FAILURE_RULES = {
    "valid_device_id": "device_id IS NOT NULL",
    "valid_failure_id": "failure_id IS NOT NULL",
    "valid_failure_timestamp": "failure_timestamp IS NOT NULL",
    "valid_severity": "severity IN ('minor', 'major', 'critical')",
}


def _failures(rules: dict[str, str]) -> list[Column]:
    # An unknown predicate result counts as a failure.
    return [
        F.count(F.when(~F.coalesce(F.expr(predicate), F.lit(False)), 1)).alias(name)
        for name, predicate in rules.items()
    ]


def rule_metrics(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule with its passed and failed counts, all rules in a single pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *_failures(rules))
    per_rule = [
        F.struct(
            F.lit(name).alias("rule"),
            (F.col("_rows") - F.col(name)).alias("passed"),
            F.col(name).alias("failed"),
        )
        for name in rules
    ]
    return counts.select(F.inline(F.array(*per_rule)))


def expect_all(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The unchanged frame and its rule metrics."""
    return df, rule_metrics(df, rules)


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def drop_failing(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Only the rows that keep every rule; on streams too."""
    for predicate in rules.values():
        df = df.where(_holds(predicate))
    return df


def quarantine(df: DataFrame, rules: dict[str, str], column: str = "broken_rules") -> DataFrame:
    """Only the rows that break a rule, with the names of those they break, in the rules' order."""
    broken = [F.when(~_holds(predicate), F.lit(name)) for name, predicate in rules.items()]
    return df.withColumn(column, F.concat_ws(",", *broken)).where(F.col(column) != "")


def observe_rules(df: DataFrame, name: str, rules: dict[str, str]) -> DataFrame:
    """The same counts as side metrics of whatever query runs ``df``, streaming included.

    Read them from ``StreamingQueryProgress.observedMetrics[name]``.
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *_failures(rules))
