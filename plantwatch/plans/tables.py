"""The declared tables: what each is made from, its comment, properties, key and rules.

``build_tables`` makes them in the order of what they read. Every table is written before the next
one starts and read back as a snapshot by those that need it, so a table is computed once however
many follow it, and a run that broke off can resume behind the tables it has written.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantwatch.operators.coherence import key_violations
from plantwatch.operators.rules import DEVICE_RULES, FAILURE_RULES, MAINTENANCE_RULES, TELEMETRY_RULES, expect_all
from plantwatch.plans import gold, silver
from plantwatch.schemas import ML_FEATURES_KEY
from plantwatch.session import side_by_side
from plantwatch.sources.tables import save_table, snapshot

Inputs = dict[str, DataFrame]


@dataclass(frozen=True)
class Table:
    name: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    comment: str
    layer: str
    key: tuple[str, ...] = ()
    rules: dict[str, str] = field(default_factory=dict)

    @property
    def properties(self) -> dict[str, str]:
        facts = {"quality": self.layer, "declared.reads": ",".join(self.reads)}
        if self.key:
            facts["declared.key"] = ",".join(self.key)
        if self.rules:
            facts["declared.rules"] = json.dumps(sorted(self.rules))
        return facts


def declared(as_of_day: Column, as_of: Column) -> tuple[Table, ...]:
    """All tables from the four landed entities on."""
    raw = tuple(
        Table(f"bronze_{name}", (name,), lambda rows: rows, f"{name} rows as they arrived", "bronze")
        for name in ("telemetry", "device_master", "maintenance", "failures")
    )
    return (
        *raw,
        Table("telemetry_clean", ("bronze_telemetry", "bronze_device_master"), silver.telemetry_clean,
              "Readings of active devices with repaired times", "silver", rules=TELEMETRY_RULES),
        Table("device_master_clean", ("bronze_device_master",), lambda d: silver.device_master_clean(d, as_of_day),
              "Devices with their clocks", "silver", ("device_id",), DEVICE_RULES),
        Table("maintenance_clean", ("bronze_maintenance",), silver.maintenance_clean,
              "Maintenance with delays", "silver", ("maintenance_id",), MAINTENANCE_RULES),
        Table("failures_clean", ("bronze_failures",), silver.failures_clean,
              "Failures with severity scores and downtime", "silver", ("failure_id",), FAILURE_RULES),
        Table("device_health_metrics", ("telemetry_clean",), silver.device_health_metrics,
              "Readings with trends and anomaly scores", "silver"),
        Table("device_features", ("device_health_metrics",), gold.device_features, "Hourly features", "gold"),
        Table("failure_labels", ("failures_clean",), gold.failure_labels, "Hours before a failure", "gold"),
        Table("ml_features", ("device_features", "failure_labels"), gold.ml_features, "The learning table", "gold", ML_FEATURES_KEY),
        Table("health_dashboard", ("device_features",), lambda f: gold.health_dashboard(f, as_of=as_of), "Device status", "gold"),
        Table("maintenance_analytics", ("maintenance_clean",), gold.maintenance_analytics, "Maintenance by month", "gold"),
    )


def build_tables(
    spark: SparkSession, tables: tuple[Table, ...], sources: Inputs, database: str, location: str,
    done: frozenset[str] = frozenset(),
) -> list[str]:
    """Write all tables to a database, sources first; the names in the order they were made.

    Tables that do not wait for each other are made at the same time, since none keeps all cores busy to its end.
    ``done`` names tables of an earlier run that are kept as they are.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    known = {t.name: t for t in tables}

    def make(name: str) -> None:
        table = known[name]
        inputs = [snapshot(spark, f"{database}.{r}") if r in known else sources[r] for r in table.reads]
        save_table(table.build(*inputs), f"{database}.{name}", table.comment, table.properties)

    order, waiting = [], TopologicalSorter({t.name: t.reads for t in tables})
    waiting.prepare()
    while waiting.is_active():
        ready = waiting.get_ready()
        side_by_side(spark, make, [n for n in ready if n in known and n not in done])
        order += [n for n in ready if n in known]
        waiting.done(*ready)
    return order


def inspect_tables(spark: SparkSession, tables: tuple[Table, ...], database: str) -> DataFrame:
    """Per table its rows, broken keys and rule failures, and what the catalog says of it."""
    out = None
    for table in tables:
        name, rows = f"{database}.{table.name}", snapshot(spark, f"{database}.{table.name}")
        facts = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        comment = spark.catalog.getTable(name).description
        broken = key_violations(rows, table.key).agg(F.count("*")).scalar() if table.key else F.lit(0)
        failed = expect_all(rows, table.rules)[1].agg(F.sum("failed")).scalar() if table.rules else F.lit(0)
        one = rows.agg(F.count("*").alias("rows")).select(
            F.lit(table.name).alias("table_name"), "rows", broken.cast("long").alias("broken_keys"),
            failed.cast("long").alias("failed"), F.lit(facts.get("quality")).alias("quality"),
            F.lit(facts.get("declared.key", "")).alias("key"), F.lit(comment).alias("comment"))
        out = one if out is None else out.unionByName(one)
    return out
