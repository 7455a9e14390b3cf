"""Named queries against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# A quick cross-section; the complete set is compared by the driver at a larger scale.
CHECKED = [
    "telemetry_clean", "device_master_clean", "maintenance_clean", "failures_clean", "device_health_dashboard",
    "predictive_maintenance_features", "expect_telemetry", "orphans_telemetry", "severity_readiness", "device_coverage",
    "freq_quality", "reading_type_moments", "device_summary", "normality_k2", "hist_value_by_type", "headline_kpis",
    "stratified_split", "roc_auc", "classification_report", "ml_clipped", "ml_selective_robust",
    "telemetry_clean_shuffled", "telemetry_clean_latest", "roc_auc_gaps", "expect_telemetry_dropped",
    "expect_telemetry_quarantined", "stream_ml_features", "stream_hourly_features_ways", "bronze_maintenance_arrays",
    "stream_expect_telemetry", "declared_tables", "ml_indicators_scaled", "ml_validation",
]


@pytest.fixture(scope="module")
def sql(small):
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return connection


def _plain(rows):
    def value(v):
        return v + 0.0 if isinstance(v, float) else v

    return sorted((tuple(value(v) for v in r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, small, sql, name):
    result = contract.queries()[name](spark, small)
    columns = sorted(result.columns)
    cursor = sql.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert _plain(result.select(*columns).collect()) == _plain(expected)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).limit(1).count() == 1
