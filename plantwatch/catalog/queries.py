"""Named queries: each takes (spark, folder of given tables) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import timedelta
from functools import lru_cache, partial

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from plantwatch.functions.bands import flag
from plantwatch.functions.timefns import repair_ts
from plantwatch.ml import evaluate, features as prep, split, train as learn
from plantwatch.ml.score import ScoredTable, score, scoring_input
from plantwatch.operators import coherence, profile
from plantwatch.operators.correlate import correlation_pairs, strong_pairs
from plantwatch.operators.lookup import BROADCAST_BYTES, latest_snapshot, orphan_keys, split_lookup_join
from plantwatch.operators.rules import (
    DEVICE_RULES, FAILURE_RULES, MAINTENANCE_RULES, TELEMETRY_RULES, drop_failing, expect_all, quarantine,
)
from plantwatch.params import ACTIVE_STATUSES
from plantwatch.plans import explore, gold, silver, tables
from plantwatch.schemas import ML_FEATURES_KEY, RAW_DDL, columns_of
from plantwatch.session import fresh_path, materialise, shuffles_end_with_jobs
from plantwatch.sources.given_tables import ARRIVAL, Entities
from plantwatch.sources.landing import ingest, land, land_arrays
from plantwatch.sources.tables import follow, snapshot
from plantwatch.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
FRAMES: dict[str, Callable[[Entities], DataFrame]] = {}

AS_OF_DAY = "2024-02-01"
CUTOFF = "2024-01-20T00:00:00"


def query(name: str):
    def register(fn: Callable[[Entities], DataFrame]):
        FRAMES[name] = fn
        return fn

    return register


def queries() -> dict[str, Query]:
    """Every query with its result made comparable across engines."""
    return {
        name: lambda spark, folder, fn=fn: comparable(fn(entities(spark, folder)))
        for name, fn in FRAMES.items()
    }


def plain_queries() -> dict[str, Query]:
    """The same queries as the operators give them: unrounded, with their own types."""
    return {
        name: lambda spark, folder, fn=fn: fn(entities(spark, folder)) for name, fn in FRAMES.items()
    }


def entities(spark: SparkSession, folder: str) -> Entities:
    """The entities of a folder; frames are lazy and the device size is measured anew each time."""
    return Entities(spark, folder)


def rounded(c: Column, digits: int) -> Column:
    """What ``F.round`` gives, which goes by decimals; whole numbers, as most sensors give, need none. Zero has no sign."""
    return F.when(c == F.rint(c), c + F.lit(0.0)).otherwise(F.round(c, digits))


def comparable(df: DataFrame, digits: int = 8) -> DataFrame:
    """Plain types and rounded doubles, so results can be compared across engines."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = rounded(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _now():
    return F.lit(ARRIVAL).cast("timestamp")


# ---- cleaned tables, features, labels, reports -------------------------------------------


def _clean(e: Entities) -> DataFrame:
    return silver.telemetry_clean(e.telemetry, e.device_master, e.device_bytes)


def _devices_clean(e: Entities) -> DataFrame:
    return silver.device_master_clean(e.device_master, F.lit(AS_OF_DAY).cast("date"))


def _health(e: Entities) -> DataFrame:
    return silver.device_health_metrics(_clean(e))


def _hourly(e: Entities) -> DataFrame:
    return gold.device_features(_health(e))


def _labels(e: Entities) -> DataFrame:
    return gold.failure_labels(silver.failures_clean(e.failures))


def _ml_table(e: Entities) -> DataFrame:
    return gold.ml_features(_hourly(e), _labels(e))


@query("telemetry_clean")
def _(e):
    return _clean(e).drop("ingestion_time")


@query("telemetry_clean_shuffled")
def _(e):
    """Devices too many to broadcast: the same rows by a shuffle."""
    return silver.telemetry_clean(e.telemetry, e.device_master, dim_bytes=BROADCAST_BYTES + 1).drop("ingestion_time")


@query("telemetry_clean_latest")
def _(e):
    """Snapshots of the device master pile up; the latest of each device counts."""
    old = e.device_master.withColumns({
        "ingestion_time": F.col("ingestion_time") - F.expr("INTERVAL 1 DAY"),
        "status": F.lit("failed"), "location": F.lit("elsewhere"),
    })
    devices = latest_snapshot(old.unionByName(e.device_master))
    return silver.telemetry_clean(e.telemetry, devices, e.device_bytes).drop("ingestion_time")


@query("device_master_clean")
def _(e):
    return _devices_clean(e).drop("ingestion_time")


@query("maintenance_clean")
def _(e):
    return silver.maintenance_clean(e.maintenance).drop("ingestion_time")


@query("failures_clean")
def _(e):
    return silver.failures_clean(e.failures).drop("ingestion_time")


@query("device_health_metrics")
def _(e):
    return _health(e)


@query("device_features_hourly")
def _(e):
    return _hourly(e)


@query("failure_labels")
def _(e):
    return _labels(e)


@query("predictive_maintenance_features")
def _(e):
    return _ml_table(e)


@query("predictive_maintenance_features_nearest")
def _(e):
    return gold.ml_features(_hourly(e), _labels(e), dedup="nearest")


@query("device_health_dashboard")
def _(e):
    return gold.health_dashboard(_hourly(e), as_of=_now())


@query("maintenance_analytics")
def _(e):
    return gold.maintenance_analytics(silver.maintenance_clean(e.maintenance))


# ---- rules and dataset checks -------------------------------------------------------------


@query("expect_telemetry")
def _(e):
    return expect_all(_clean(e), TELEMETRY_RULES)[1]


@query("expect_telemetry_dropped")
def _(e):
    return drop_failing(_clean(e), TELEMETRY_RULES).drop("ingestion_time")


@query("expect_telemetry_quarantined")
def _(e):
    return quarantine(_clean(e), TELEMETRY_RULES).select("device_id", "timestamp", "pressure", "broken_rules")


@query("expect_devices")
def _(e):
    return expect_all(_devices_clean(e), DEVICE_RULES)[1]


@query("expect_maintenance")
def _(e):
    return expect_all(silver.maintenance_clean(e.maintenance), MAINTENANCE_RULES)[1]


@query("expect_failures")
def _(e):
    return expect_all(silver.failures_clean(e.failures), FAILURE_RULES)[1]


@query("orphans_telemetry")
def _(e):
    return orphan_keys(e.telemetry, e.device_master)


@query("orphans_failures")
def _(e):
    return orphan_keys(e.failures, e.device_master)


@query("orphans_maintenance")
def _(e):
    return orphan_keys(e.maintenance, e.device_master)


@query("gold_pk_violations")
def _(e):
    return coherence.key_violations(_ml_table(e), ML_FEATURES_KEY)


@query("dataset_overview")
def _(e):
    return coherence.dataset_overview(e.raw())


@query("timestamp_format_errors")
def _(e):
    return coherence.timestamp_format_errors(e.raw())


@query("required_fields")
def _(e):
    return coherence.required_fields(e.raw())


@query("failures_before_install")
def _(e):
    return coherence.failures_before_install(e.failures, e.device_master, e.device_bytes)


@query("severity_readiness")
def _(e):
    return coherence.severity_readiness(e.failures)


@query("device_coverage")
def _(e):
    return coherence.device_coverage(e.device_master, e.telemetry, e.failures)


@query("missing_values")
def _(e):
    return coherence.missing_values(e.telemetry)


@query("missing_values_ml")
def _(e):
    return coherence.missing_values(prep.training_input(_ml_table(e)))


@query("duplicate_rows")
def _(e):
    return coherence.duplicate_rows(_ml_table(e))


# ---- exploration --------------------------------------------------------------------------

for _name, _entity, _column in (
    ("freq_device_type", "device_master", "device_type"),
    ("freq_status", "device_master", "status"),
    ("freq_failure_type", "failures", "failure_type"),
    ("freq_severity", "failures", "severity"),
    ("freq_maintenance_type", "maintenance", "maintenance_type"),
):
    query(_name)(lambda e, t=_entity, c=_column: profile.frequency(getattr(e, t), c))

for _name, _column in (("freq_facility", "facility"), ("freq_manufacturer", "manufacturer")):
    query(_name)(lambda e, c=_column: profile.frequency(e.device_master, c).drop("percentage"))


@query("freq_quality")
def _(e):
    return profile.reading_frequency(e.telemetry, "quality")


@query("freq_reading_type")
def _(e):
    return profile.reading_type_counts(e.telemetry)


@query("long_readings")
def _(e):
    return profile.long_readings(explore.timed(e.telemetry), ["device_id", "timestamp", "quality"])


@query("device_clocks")
def _(e):
    return explore.device_clocks(e.device_master, _now()).select(
        "device_id", "device_age_days", "days_since_maintenance", "days_to_next_maintenance"
    )


@query("describe_device_age")
def _(e):
    return profile.describe(explore.device_clocks(e.device_master, _now()), "device_age_days")


@query("describe_value")
def _(e):
    return profile.describe(profile.long_readings(e.telemetry, []), "value")


@query("describe_readings_per_device")
def _(e):
    return profile.describe(materialise(explore.readings_per_device(e.telemetry), "per-device"), "readings")


@query("describe_resolution_hours")
def _(e):
    return profile.describe(explore.resolution_times(e.failures), "resolution_hours")


@query("describe_duration_hours")
def _(e):
    return profile.describe(explore.with_duration_hours(e.maintenance), "duration_hours")


@query("telemetry_extent")
def _(e):
    return explore.telemetry_extent(e.telemetry)


@query("readings_per_device")
def _(e):
    return explore.readings_per_device(e.telemetry)


@query("reading_type_moments")
def _(e):
    return profile.moments(e.telemetry)


@query("readings_by_hour")
def _(e):
    return explore.readings_by_hour(e.telemetry)


@query("readings_by_weekday")
def _(e):
    return explore.readings_by_weekday(e.telemetry)


@query("readings_by_date")
def _(e):
    return explore.readings_by_date(e.telemetry)


@query("peak_low_hour")
def _(e):
    return explore.peak_and_low_hour(e.telemetry)


@query("device_time_points")
def _(e):
    return explore.device_time_points(e.telemetry)


@query("failure_totals")
def _(e):
    return explore.failure_totals(e.failures)


@query("failures_by_facility")
def _(e):
    return explore.failures_by_facility(e.failures, e.device_master)


def _money(df: DataFrame) -> DataFrame:
    # Large sums have no meaningful eighth decimal; averages keep all eight, as they may end in
    # a half at fewer.
    digits = {"total_cost": 4, "total_maintenance_cost": 4, "total_maintenance_hours": 6}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})


@query("maintenance_totals")
def _(e):
    return _money(explore.maintenance_totals(e.maintenance))


@query("cost_by_type")
def _(e):
    return _money(explore.cost_by_type(e.maintenance))


@query("schedule_adherence")
def _(e):
    return explore.schedule_adherence(e.maintenance)


def _summary(e: Entities) -> DataFrame:
    return explore.device_summary(e.device_master, e.telemetry, e.failures, e.maintenance, _now())


@query("device_summary")
def _(e):
    return _money(_summary(e))


def _pairs(e: Entities) -> DataFrame:
    return correlation_pairs(_summary(e), list(explore.SUMMARY_NUMBERS + explore.SUMMARY_CODES))


@query("correlation_pairs")
def _(e):
    return _pairs(e)


@query("strong_correlations")
def _(e):
    return strong_pairs(_pairs(e), 0.3)


NAMED_PAIRS = (
    ("device_age_days", "maintenance_count"),
    ("failure_count", "total_maintenance_cost"),
    ("failure_count", "poor_quality_ratio"),
)


@query("named_correlations")
def _(e):
    one = _summary(e).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in NAMED_PAIRS])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"), F.col(f"{a}|{b}").alias("correlation"))
        for a, b in NAMED_PAIRS
    ])))


@query("normality_k2")
def _(e):
    return profile.normality(e.telemetry).withColumn("k2", F.round("k2", 3))


@query("hist_device_age")
def _(e):
    return profile.histogram(explore.device_clocks(e.device_master, _now()), ["device_age_days"], 30)


@query("hist_days_since_maintenance")
def _(e):
    return profile.histogram(explore.device_clocks(e.device_master, _now()), ["days_since_maintenance"], 30)


@query("hist_readings_per_device")
def _(e):
    return profile.histogram(materialise(explore.readings_per_device(e.telemetry), "per-device"), ["readings"], 30)


@query("hist_resolution_hours")
def _(e):
    return profile.histogram(explore.resolution_times(e.failures), ["resolution_hours"], 20)


@query("hist_value_by_type")
def _(e):
    return profile.histogram(e.telemetry, list(profile.SENSORS), 50)


@query("headline_kpis")
def _(e):
    return explore.headline_kpis(e.device_master, e.telemetry, e.failures, e.maintenance).withColumn(
        "value", F.round("value", 4)
    )


# ---- learning -----------------------------------------------------------------------------


def _training(e: Entities) -> DataFrame:
    return prep.training_input(_ml_table(e))


def _stored_training(e: Entities) -> DataFrame:
    return materialise(_training(e), "training")


ROW_KEY = ("device_id", "hour_bucket", "failure_type", "severity", "days_before_failure")


def _by_key(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(f"{prep.ROW}.{k}").alias(k) for k in ROW_KEY], *columns)


def _base_features(model) -> list[str]:
    return [c for c in model.features if not c.startswith("is_")]


@query("training_input")
def _(e):
    return _training(e)


@query("ml_imputed")
def _(e):
    rows = _stored_training(e)
    model = prep.FeaturePrep().fit(rows)
    filled = prep.fill_medians(prep.time_parts(rows), model.learned()["medians"])
    numbers = [c for c in prep.numeric_columns(filled, ("will_fail", "days_before_failure"))]
    return filled.select(
        "device_id", "failure_type", "severity", "days_before_failure",
        *[F.col(c).cast("double").alias(c) for c in numbers],
    )


@query("ml_encoded")
def _(e):
    rows = _stored_training(e)
    model = prep.FeaturePrep().fit(rows)
    types = model.learned()["types"]
    encoded = prep.encode_categories(rows, model.dictionary, types)
    present = [c for c in encoded.columns if c.endswith("_encoded")]
    plain = [f"is_{t}" for t in types if t == t.strip().lower()]  # the others differ from table to table
    return encoded.select("device_id", "hour_bucket", *present, *plain)


def _indicator_rows(df: DataFrame, types: list[str]) -> DataFrame:
    """One row per learning row and device type, whatever types the tables hold."""
    values = F.array(*[
        F.struct(F.lit(f"is_{t}").alias("indicator"), F.col(f"`is_{t}`").cast("double").alias("value")) for t in types
    ])
    return _by_key(df, F.inline(values))


@query("ml_indicators")
def _(e):
    model, prepared = _prepared(e)
    return _indicator_rows(prepared, model.learned()["types"])


@query("ml_indicators_scaled")
def _(e):
    model, prepared = _prepared(e)
    types = model.learned()["types"]
    stored = materialise(prepared, "prepared")
    scaler = prep.ColumnScaler(kind="robust", inputCols=[f"is_{t}" for t in types]).fit(stored)
    return _indicator_rows(scaler.transform(stored), types)


@query("ml_derived")
def _(e):
    rows = _stored_training(e)
    model = prep.FeaturePrep().fit(rows)
    s = model.learned()
    filled = prep.fill_medians(prep.time_parts(prep.with_row(rows)), s["medians"])
    derived = prep.derive(prep.encode_categories(filled, model.dictionary, s["types"]), s["power_threshold"])
    return _by_key(derived, *[F.col(c).cast("double").alias(c) for c in _base_features(model)])


def _prepared(e: Entities):
    rows = _stored_training(e)
    model = prep.FeaturePrep().fit(rows)
    return model, model.transform(prep.with_row(rows))


@query("ml_clipped")
def _(e):
    model, prepared = _prepared(e)
    return _by_key(prepared, *_base_features(model))


def _scaled(e: Entities, kind: str, skip_binary: bool) -> DataFrame:
    model, prepared = _prepared(e)
    stored = materialise(prepared, "prepared")
    scaler = prep.ColumnScaler(kind=kind, skipBinary=skip_binary, inputCols=model.features).fit(stored)
    return _by_key(scaler.transform(stored), *_base_features(model))


@query("ml_robust_scaled")
def _(e):
    return _scaled(e, "robust", False)


@query("ml_selective_robust")
def _(e):
    return _scaled(e, "robust", True)


@query("ml_selective_standard")
def _(e):
    return _scaled(e, "standard", True)


@query("ml_validation")
def _(e):
    model, prepared = _prepared(e)
    return prep.validate_matrix(prepared.select(*[F.col(f"`{c}`") for c in model.features], prep.LABEL))


@query("stratified_split")
def _(e):
    return split.stratified_split(_stored_training(e), prep.LABEL).select(*ROW_KEY, prep.LABEL, "is_test")


@query("class_weights")
def _(e):
    rows = split.stratified_split(_stored_training(e), prep.LABEL).filter("is_test = 0")
    return split.class_weights(rows, prep.LABEL)


@query("class_balance")
def _(e):
    return split.class_balance(_training(e), prep.LABEL)


@query("training_cutoff")
def _(e):
    return learn.training_cutoff(_training(e))


@query("scoring_input")
def _(e):
    return scoring_input(_ml_table(e), CUTOFF)


def _risk_scored(e: Entities) -> DataFrame:
    risk = F.col("high_temperature") + F.col("high_vibration") + F.col("needs_maintenance_soon")
    return _training(e).select(prep.LABEL, risk.alias("score"), flag(risk >= 2).alias("prediction"))


@query("classification_metrics")
def _(e):
    return evaluate.classification_metrics(_risk_scored(e))


@query("confusion_matrix")
def _(e):
    return evaluate.confusion_matrix(_risk_scored(e))


@query("classification_report")
def _(e):
    return evaluate.classification_report(_risk_scored(e))


@query("roc_auc")
def _(e):
    return evaluate.roc_auc(_risk_scored(e))


@query("roc_auc_temperature")
def _(e):
    rows = _training(e).filter("avg_temperature IS NOT NULL")
    return evaluate.roc_auc(rows.withColumn("score", F.round("avg_temperature", 6)))


@query("roc_auc_gaps")
def _(e):
    """Scores with gaps: missing and NaN ones have no rank."""
    gap = F.when(F.col("reading_count") % 7 == 0, F.lit(float("nan")))
    return evaluate.roc_auc(_training(e).withColumn("score", F.coalesce(gap, F.round("avg_temperature", 6))))


def _until_cutoff(ml_table: DataFrame) -> DataFrame:
    """The learning table as it stood when the model was trained."""
    return prep.training_input(ml_table).filter(F.col("hour_bucket") <= F.lit(CUTOFF).cast("timestamp"))


def _stored_table(e: Entities) -> DataFrame:
    """The learning table, for queries that train on some of its rows and score others."""
    return materialise(_ml_table(e), "ml-table")


@dataclass(frozen=True)
class _Stored:
    """Stored training rows; equal if their content is, wherever they lie."""

    application: str
    folder: str
    rows: int
    content: str
    frame: DataFrame = field(compare=False)


@lru_cache(maxsize=2)
def _trained(stored: _Stored) -> tuple[learn.Trained, str]:
    """The full search over one folder's rows, saved; shared by the queries that look at it, which fail if it does."""
    spark = SparkSession.active()
    trained = learn.train(stored.frame, candidates=learn.expand_grid(), fallback=False)
    path = fresh_path(spark, "model")
    trained.save(path)
    return trained, path


def _model(e: Entities, ml_table: DataFrame | None = None) -> tuple[learn.Trained, str]:
    # The digest of all rows tells whether the tables are still those the model was trained on.
    rows = materialise(_until_cutoff(_ml_table(e) if ml_table is None else ml_table), "training")
    digest = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).cast("string")
    seen = rows.agg(F.count("*").alias("n"), digest.alias("content")).first()
    return _trained(_Stored(e.spark.sparkContext.applicationId, e.folder, seen["n"], seen["content"], rows))


@query("gbt_metrics")
def _(e):
    return _model(e)[0].metrics_table(e.spark)


@query("gbt_importances")
def _(e):
    return _model(e)[0].importance_table(e.spark, top=10)


@query("gbt_predictions")
def _(e):
    table = _stored_table(e)
    return score(_model(e, table)[0].model, scoring_input(table, CUTOFF))


@query("gbt_predictions_check")
def _(e):
    """Every row after the cutoff has a probability, and the class that follows from it."""
    p = F.col("will_fail_probability")
    sound = p.between(0, 1) & (F.col("will_fail_prediction") == (p >= 0.5).cast("int"))
    table = _stored_table(e)
    scored = score(_model(e, table)[0].model, scoring_input(table, CUTOFF))
    return scored.select(*ROW_KEY, flag(sound).alias("sound"))


@query("gbt_score_new")
def _(e):
    """The job runs, is repeated, runs over more hours and is repeated: two batches, each row once."""
    rows = _stored_table(e)
    table, (_, path) = ScoredTable(e.spark, fresh_path(e.spark, "scored")), _model(e, rows)
    first = F.col("hour_bucket") <= F.lit(CUTOFF).cast("timestamp") + F.expr("INTERVAL 4 DAYS")
    runs = [table.append(part, path) for part in (rows.filter(first), rows.filter(first), rows, rows)]
    added = F.lit(sum(n > 0 for n in runs))
    return table.read().select(*ROW_KEY, added.alias("batches"))


@query("gbt_grid_cv")
def _(e):
    """All candidates over all folds, best first."""
    columns = ("candidate", "trees", "depth", "learning_rate", "min_split_rows", "folds", "auc")
    return e.spark.createDataFrame(
        [tuple(r[c] for c in columns) for r in _model(e)[0].fitted.ranking],
        "candidate int, trees int, depth int, learning_rate double, min_split_rows int, folds int, auc double",
    )


@query("gbt_grid_check")
def _(e):
    """The grid, with what its stored held-out scores say: rows, folds, and the mean area again."""
    fitted = _model(e)[0].fitted
    per_fold = evaluate.roc_auc_by(fitted.scores, ["candidate", "fold"], "label")
    again = per_fold.groupBy("candidate").agg(F.avg("roc_auc").alias("again"), F.count("*").alias("fold_areas"))
    rows = fitted.scores.groupBy("candidate").agg(F.count("*").alias("scored_rows"))
    ranked = e.spark.createDataFrame(
        [(r["candidate"], r["trees"], r["depth"], r["learning_rate"], r["min_split_rows"], r["auc"]) for r in fitted.ranking],
        "candidate int, trees int, depth int, learning_rate double, min_split_rows int, auc double",
    )
    same = F.abs(F.col("auc") - F.col("again")) < 1e-9
    return ranked.join(again, "candidate").join(rows, "candidate").select(
        "candidate", "trees", "depth", "learning_rate", "min_split_rows", "fold_areas", "scored_rows",
        flag(same).alias("same_area"),
    )


@query("gbt_cv_folds")
def _(e):
    """The held-out fold of every training row, as stored with the scores of the first candidate."""
    scores = _model(e)[0].fitted.scores.filter("candidate = 0")
    return scores.select("device_id", "hour_bucket", "failure_type", "severity", F.col("label").alias("will_fail"), "fold")


@query("gbt_metrics_check")
def _(e):
    """Both sides' rows and positives, and whether their stored predictions give the metrics again."""
    trained = _model(e)[0]
    y, p = F.col(prep.LABEL), F.col("prediction")
    tp, called, actual = F.sum(y * p), F.sum(p), F.sum(y)
    again = trained.predictions.groupBy("is_test").agg(
        F.count("*").alias("rows"), actual.alias("positives"),
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.coalesce(tp / F.when(called != 0, called), F.lit(0.0)).alias("precision"),
        F.coalesce(tp / F.when(actual != 0, actual), F.lit(0.0)).alias("recall"),
    )
    same = F.lit(True)
    for name in ("accuracy", "precision", "recall"):
        kept = F.when(F.col("is_test") == 1, trained.metrics[f"test_{name}"]).otherwise(trained.metrics[f"train_{name}"])
        same = same & (F.abs(F.col(name) - kept) < 1e-9)
    return again.select("is_test", "rows", "positives", flag(same).alias("same_metrics"))


# ---- landing files and streams ------------------------------------------------------------

def _landing(e: Entities, entity: str) -> str:
    return land(e.raw()[entity], fresh_path(e.spark, f"landing-{entity}"), entity)


def _arriving(e: Entities, entity: str, **options) -> DataFrame:
    return ingest(e.spark, _landing(e, entity), entity, streaming=True, multi_line=False, **options)


def _run(df: DataFrame, label: str) -> DataFrame:
    return jobs.run_available_now(df, label=label)[0]


def _bronze(e: Entities, entity: str) -> DataFrame:
    written = _run(_arriving(e, entity), f"bronze-{entity}")
    has_lineage = F.col("ingestion_time").isNotNull() & F.col("source_file").rlike(r"\.json(\.gz)?$")
    return written.withColumn("has_lineage", flag(has_lineage)).drop("ingestion_time", "source_file")


for _entity in ("device_master", "maintenance", "failures"):
    query(f"bronze_{_entity}")(lambda e, t=_entity: _bronze(e, t))


@query("bronze_telemetry")
def _(e):
    return _bronze(e, "telemetry")


@query("bronze_maintenance_arrays")
def _(e):
    """Array files, a third of them per trigger: every row once, in the batch its file came in."""
    path = fresh_path(e.spark, "landing-arrays")
    files = land_arrays(e.maintenance, path, "maintenance", multiple_of=3)
    arriving = ingest(e.spark, path, "maintenance", streaming=True, max_files=files // 3).drop("file")
    written = jobs.run_in_batches(arriving, "bronze-arrays")
    batches = F.lit(written.select("batch").distinct().count()).cast("long")
    return written.select(*columns_of(RAW_DDL["maintenance"]), batches.alias("batches"))


@query("stream_expect_telemetry")
def _(e):
    """Rules counted in each micro-batch of the written stream, added up over all batches."""
    path = _landing(e, "telemetry")
    files = len(e.spark.read.text(path).inputFiles())
    stream = silver.telemetry_clean(
        ingest(e.spark, path, "telemetry", streaming=True, multi_line=False, max_files=max(1, -(-files // 3))), e.device_master)
    counts = jobs.run_in_batches(stream, "rule-counts", batch_table=lambda b: expect_all(b, TELEMETRY_RULES)[1])
    return counts.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query("stream_telemetry_clean")
def _(e):
    stream = silver.telemetry_clean(_arriving(e, "telemetry"), e.device_master, e.device_bytes)
    return _run(stream, "telemetry-clean").drop("ingestion_time")


@query("stream_telemetry_clean_split")
def _(e):
    """Devices too many to broadcast: busy ones are found and split off in every micro-batch."""
    split_join = partial(split_lookup_join, shuffled="shuffle_hash")
    batch = lambda rows: silver.telemetry_clean(rows, e.device_master, BROADCAST_BYTES + 1, split_join)
    # Not kept: the sketch reads one column, and what is kept would have all of them.
    written = jobs.run_in_batches(_arriving(e, "telemetry"), "telemetry-split", batch_table=batch)
    return written.drop("ingestion_time", "batch")


@query("stream_device_master_clean")
def _(e):
    stream = silver.device_master_clean(_arriving(e, "device_master"), F.lit(AS_OF_DAY).cast("date"))
    return _run(stream, "device-clean").drop("ingestion_time")


@query("stream_maintenance_analytics")
def _(e):
    stream = gold.maintenance_analytics(silver.maintenance_clean(_arriving(e, "maintenance")))
    return _run(stream, "maintenance-analytics")


@query("stream_failure_labels")
def _(e):
    return _run(gold.failure_labels(silver.failures_clean(_arriving(e, "failures"))), "labels")


def _health_stream(e: Entities, folder: str) -> DataFrame:
    readings = ingest(e.spark, folder, "telemetry", streaming=True, multi_line=False)
    return silver.device_health_metrics(silver.telemetry_clean(readings, e.device_master, e.device_bytes))


def _last_reading(e: Entities) -> Row:
    """The latest time ``t`` of a clean reading and a device ``d`` that has it: one row a device meets the devices."""
    latest = e.telemetry.groupBy("device_id").agg(F.max(repair_ts("timestamp")).alias("t"))
    active = e.device_master.filter(F.col("status").isin(*ACTIVE_STATUSES)).select("device_id")
    with shuffles_end_with_jobs(e.spark):
        return latest.join(active, "device_id", "left_semi").agg(F.max("t").alias("t"), F.max_by("device_id", "t").alias("d")).first()


def _streamed_hours(e: Entities) -> tuple[DataFrame, DataFrame, int]:
    """Hours the stream closed, hours of readings it wrote aside for want of a time, closed at first."""
    folder = _landing(e, "telemetry")

    def drain() -> None:
        last = _last_reading(e)
        if last["t"] is None:
            return
        later = (last["t"] + timedelta(hours=4)).isoformat()
        row = e.spark.createDataFrame([(last["d"], later)], "device_id string, timestamp string")
        empty = e.telemetry.limit(0)
        land(empty.drop("device_id", "timestamp").unionByName(row, allowMissingColumns=True), folder, "telemetry")

    written, closed = jobs.run_and_drain(
        lambda: jobs.hourly_features_stream(_health_stream(e, folder)), drain, "hourly")
    aside = jobs.timeless(_health_stream(e, folder), "timestamp")
    return written, gold.device_features(aside), closed


@query("stream_hourly_features")
def _(e):
    written, aside, _ = _streamed_hours(e)
    return written.unionByName(aside.select(*written.columns))


@query("stream_hourly_features_ways")
def _(e):
    """How many hours came each way: closed while data arrived, closed by the drain, without a time."""
    written, aside, closed = _streamed_hours(e)
    return written.agg(
        F.lit(closed).cast("long").alias("closed"), (F.count("*") - closed).alias("drained"),
        aside.agg(F.count("*")).scalar().alias("timeless"))


@query("stream_ml_features")
def _(e):
    """The stream join over stored feature and label tables, as the tables follow each other."""
    with shuffles_end_with_jobs(e.spark):
        hourly, labels = materialise(_hourly(e), "hourly"), _labels(e)
    paths = [fresh_path(e.spark, f"{name}-table") for name in ("hourly", "label")]
    hourly.filter("hour_bucket IS NOT NULL").write.parquet(paths[0])
    labels.filter("prediction_hour IS NOT NULL").write.parquet(paths[1])

    def stream() -> DataFrame:
        sides = [e.spark.readStream.schema(df.schema).parquet(p) for df, p in zip((hourly, labels), paths)]
        return jobs.ml_features_stream(*sides)

    def drain() -> None:
        spark = e.spark
        ends = [spark.read.parquet(p).agg(F.max(c)).first()[0] for p, c in zip(paths, ("hour_bucket", "prediction_hour"))]
        if not any(ends):
            return
        beyond = max(t for t in ends if t) + 3 * timedelta(hours=jobs.LABEL_HOURS)
        for df, path, column in zip((hourly, labels), paths, ("hour_bucket", "prediction_hour")):
            # Devices of their own, so that the two rows do not meet.
            row = spark.createDataFrame([(f"drain {column}", beyond)], f"device_id string, {column} timestamp")
            empty = spark.createDataFrame([], df.schema).drop("device_id", column)
            empty.unionByName(row, allowMissingColumns=True).select(*df.columns).write.mode("append").parquet(path)

    written, _ = jobs.run_and_drain(stream, drain, "ml-features", jobs.ONE_PASS)
    # Hours without a time meet no label and need no state.
    aside = gold.ml_features(hourly.filter("hour_bucket IS NULL"), labels.limit(0))
    return written.unionByName(aside.select(*written.columns))


def _declared(e: Entities) -> tuple[tuple[tables.Table, ...], str]:
    """All declared tables, made from the raw entities in a database of their own."""
    plan = tables.declared(F.lit(AS_OF_DAY).cast("date"), _now())
    location = fresh_path(e.spark, "database")
    database = f"plantwatch_{location[-12:]}"
    tables.build_tables(e.spark, plan, e.raw(), database, location)
    return plan, database


@query("declared_tables")
def _(e):
    """Every table read back: rows, broken keys, rule failures, and its entry in the catalog."""
    plan, database = _declared(e)
    return tables.inspect_tables(e.spark, plan, database)


@query("declared_learning_table")
def _(e):
    """The learning table at the end of the run, read back as a snapshot."""
    return snapshot(e.spark, f"{_declared(e)[1]}.ml_features")


@query("declared_labels_followed")
def _(e):
    """A written table followed as a stream."""
    return _run(follow(e.spark, f"{_declared(e)[1]}.failure_labels"), "labels-followed")
