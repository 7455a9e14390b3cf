"""Tunable parameters. Defaults are the values the results are defined by."""

from __future__ import annotations

from dataclasses import dataclass


# Sensor bands, horizons and limits that results must agree with.
@dataclass(frozen=True)
class Band:
    """Open band: above ``high`` and below ``low`` are signalled, the limits are not."""

    low: float
    high: float


@dataclass(frozen=True)
class HealthBands:
    temp_1h: Band = Band(65.0, 75.0)
    temp_short: Band = Band(60.0, 80.0)
    vibration: Band = Band(2.0, 8.0)
    pressure: Band = Band(800.0, 1200.0)
    power: Band = Band(100.0, 500.0)
    temp_anomaly: Band = Band(55.0, 85.0)
    vibration_anomaly_above: float = 10.0
    pressure_anomaly: Band = Band(600.0, 1400.0)


@dataclass(frozen=True)
class HourlyLimits:
    hot_above: float = 75.0
    vibrating_above: float = 8.0
    maintenance_after_days: int = 60


@dataclass(frozen=True)
class LabelHorizon:
    step_hours: int = 6
    horizon_hours: int = 168


@dataclass(frozen=True)
class FeatureLimits:
    ideal_temperature: float = 70.0
    temp_band: Band = Band(65.0, 75.0)
    vibration_above: float = 8.0
    overdue_days: int = 180
    urgent_days: int = 365
    power_quantile: float = 0.75
    full_quality_readings: int = 50
    low_quality_readings: int = 20
    clip_iqr_factor: float = 1.5
    clip_min_distinct: int = 10


MIN_READINGS = 10
EXPENSIVE_ABOVE = 1000.0
ACTIVE_STATUSES = ("active", "maintenance")
LABELLED_SEVERITIES = ("minor", "major", "critical")
SENSORS = (
    "temperature",
    "pressure",
    "vibration",
    "humidity",
    "power_consumption",
    "flow_rate",
    "valve_position",
    "motor_speed",
)
