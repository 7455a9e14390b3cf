"""Feature preparation as Spark ML stages.

All statistics (medians, bounds, vocabularies, percentiles, scales) are learned at fit and
stored in the model, so scoring never depends on which rows are scored together. The order of
steps is fixed: time parts, median fill, category codes, derived columns, clipping, residual
fill, removal of identifiers and columns that leak the label.
"""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plantwatch.functions.bands import flag, outside, settled
from plantwatch.operators.dictionary import Dictionary, build_dictionary
from plantwatch.operators.quantiles import ColumnStats, column_stats, exact_quantiles
from plantwatch.params import MIN_READINGS, FeatureLimits
from plantwatch.session import materialise

# Column roles of the learning table.
LABEL = "will_fail"
TIME = "hour_bucket"
CATEGORIES = ("device_type", "location", "failure_type", "severity")
RISK_FLAGS = ("high_temperature", "high_vibration", "needs_maintenance_soon")
IDENTIFIERS = ("device_id",)
LEAKS = ("failure_type_encoded", "severity_encoded", "days_before_failure")
UNKNOWN = "Unknown"

# A struct column of this name travels through all stages untouched.
ROW = "_row"

# Columns with at most two values by construction: never clipped, no need to count values.
BINARY_DERIVED = (
    "temp_risk",
    "vibration_risk",
    "maintenance_overdue",
    "maintenance_urgent",
    "any_risk_factor",
    "high_power_consumption",
    "low_data_quality",
)
# One indicator column per device type: beyond this no schema can hold them (indicators=False).
MAX_INDICATORS = 2_000
CERTAINLY_MANY = 100


def training_input(ml_table: DataFrame, min_readings: int = MIN_READINGS) -> DataFrame:
    """Feature hours with enough readings to learn from."""
    return ml_table.filter((F.col("has_sufficient_data") == 1) & (F.col("reading_count") >= min_readings))


def with_row(df: DataFrame) -> DataFrame:
    """Carry the original columns along, to be unpacked after the last stage."""
    return df.withColumn(ROW, F.struct(*df.columns))


def time_parts(df: DataFrame) -> DataFrame:
    """Replace the hour by hour of day, weekday (Monday 0) and month."""
    if TIME not in df.columns:
        return df
    return df.withColumns({
        "hour_of_day": F.hour(TIME).cast("double"),
        "day_of_week": F.weekday(TIME).cast("double"),
        "month": F.month(TIME).cast("double"),
    }).drop(TIME)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def fill_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items() if c in df.columns
    })


def encode_categories(
    df: DataFrame, dictionary: Dictionary, types: list[str], keep_unseen: bool = False
) -> DataFrame:
    """Codes for every category and one indicator per device type; the texts are dropped.

    The code is the place of the text in its column's dictionary; an unseen text fails or gets the
    code after the last.
    """
    present = [c for c in CATEGORIES if c in df.columns and c in dictionary.words]
    kept = [c for c in df.columns if c not in present]
    known = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in present})
    for c in present:
        known = dictionary.encode(known, c, f"_{c}")
    codes = []
    for c in present:
        code = F.col(f"_{c}").cast("int")
        if keep_unseen:
            code = F.coalesce(code, F.lit(dictionary.words[c]))
        else:
            unseen = F.concat(F.lit(f"unseen value in {c}: "), F.col(c))
            code = F.coalesce(code, F.raise_error(unseen).cast("int"))
        codes.append(code.alias(f"{c}_encoded"))
    indicators = [flag(F.col("device_type") == t).alias(f"is_{t}") for t in types if "device_type" in present]
    return known.select(*[F.col(f"`{c}`") for c in kept], *codes, *indicators)


def derive(df: DataFrame, power_threshold: float | None, limits: FeatureLimits = FeatureLimits()) -> DataFrame:
    """Risk, maintenance, efficiency and data-quality columns. Unknown readings never signal."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    if "avg_temperature" in have:
        t = F.col("avg_temperature")
        new["temp_deviation"] = F.abs(t - limits.ideal_temperature)
        new["temp_risk"] = flag(outside(settled(t), limits.temp_band))
    if "avg_vibration" in have:
        v = F.col("avg_vibration")
        new["vibration_risk"] = flag(settled(v) > limits.vibration_above)
        new["vibration_squared"] = v * v
    if "days_since_maintenance" in have:
        d = F.col("days_since_maintenance")
        new["maintenance_overdue"] = flag(d > limits.overdue_days)
        new["maintenance_urgent"] = flag(d > limits.urgent_days)
        days = F.coalesce(d.cast("double"), F.lit(0.0))
        # One day before maintenance has the limit value, earlier days have none.
        new["log_days_maintenance"] = F.when(days == -1, F.lit(float("-inf"))).otherwise(F.log1p(days))
    if have.issuperset(RISK_FLAGS):
        flags = [F.coalesce(F.col(c), F.lit(0)) for c in RISK_FLAGS]
        total = reduce(lambda a, b: a + b, flags)
        new.update(dict(zip(RISK_FLAGS, flags)))
        new["total_risk_factors"] = total
        new["any_risk_factor"] = flag(total > 0)
    if have.issuperset(("avg_power", "avg_temperature")):
        t = F.col("avg_temperature")
        new["power_efficiency"] = F.col("avg_power") / F.when(t == 0, F.lit(1.0)).otherwise(t)
        new["high_power_consumption"] = (
            F.lit(0) if power_threshold is None
            else flag(settled(F.col("avg_power")) > F.lit(round(power_threshold, 9)))
        )
    if "reading_count" in have:
        n = F.col("reading_count")
        new["data_quality_score"] = F.least(n / limits.full_quality_readings, F.lit(1.0))
        new["low_data_quality"] = flag(n < limits.low_quality_readings)
    return df.withColumns(new)


def clip(df: DataFrame, bounds: dict[str, list[float]], medians: dict[str, float]) -> DataFrame:
    """Pull outliers to the learned bounds; a gap in a clipped column becomes its median first."""

    def clipped(c: str, low: float, high: float) -> Column:
        value = F.coalesce(F.col(c).cast("double"), F.lit(medians[c]))
        return F.greatest(F.least(value, F.lit(high)), F.lit(low))

    return df.withColumns({c: clipped(c, *b) for c, b in bounds.items() if c in df.columns})


def columns_with_many_values(
    df: DataFrame, columns: list[str], more_than: int, stats: dict[str, ColumnStats]
) -> list[str]:
    """Columns with more than ``more_than`` distinct non-missing values.

    The sketched counts settle the clear cases; only columns with few values are counted
    exactly, which then needs memory for those few values only.
    """
    many = {c for c in columns if stats[c].distinct >= CERTAINLY_MANY}
    unclear = [c for c in columns if c not in many]
    if unclear:
        exact = df.agg(*[F.size(F.collect_set(c)).alias(c) for c in unclear]).first()
        many.update(c for c in unclear if exact[c] > more_than)
    return [c for c in columns if c in many]


class _State(Params):
    state = Param(Params._dummy(), "state", "learned values as JSON text", TypeConverters.toString)
    handleInvalid = Param(Params._dummy(), "handleInvalid", "unseen category: error or keep", TypeConverters.toString)

    def learned(self) -> dict:
        return json.loads(self.getOrDefault("state"))


class FeaturePrep(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the preparation of the learning table."""

    indicators = Param(Params._dummy(), "indicators", "one column per device type", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, handleInvalid: str = "error", indicators: bool = True):
        super().__init__()
        self._setDefault(handleInvalid="error", indicators=True)
        self._set(handleInvalid=handleInvalid, indicators=indicators)

    def _types(self, dictionary: Dictionary, dataset: DataFrame) -> list[str]:
        """The device types, whose names the indicator columns need; not asked for otherwise."""
        if not self.getOrDefault("indicators") or "device_type" not in dictionary.words:
            return []
        if dictionary.words["device_type"] > MAX_INDICATORS:
            raise ValueError(f"more than {MAX_INDICATORS} device types: use indicators=False, their code stays")
        return dictionary.head(dataset.sparkSession, "device_type", MAX_INDICATORS)

    def _fit(self, dataset: DataFrame) -> "FeaturePrepModel":
        limits = FeatureLimits()
        base = time_parts(dataset)
        numbers = numeric_columns(base, exclude=(LABEL,))
        stats = column_stats(base, numbers)
        rows = base.count()
        gappy = [c for c in numbers if stats[c].n < rows]
        medians = {
            c: q[0] for c, q in exact_quantiles(base, gappy, [0.5], stats=stats).items() if q[0] is not None
        }
        words = base.select(*[
            F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in CATEGORIES if c in base.columns
        ])
        dictionary = build_dictionary(words, words.columns)
        types = self._types(dictionary, dataset)
        filled = fill_medians(base, medians)
        threshold = None
        if "avg_power" in filled.columns:
            threshold = exact_quantiles(filled, ["avg_power"], [limits.power_quantile])["avg_power"][0]
        # Stored once: the passes below each read only their columns of it.
        derived = materialise(derive(encode_categories(filled, dictionary, types), threshold), "derived")
        indicators = tuple(f"is_{t}" for t in types)
        candidates = numeric_columns(derived, exclude=(LABEL, *LEAKS, *BINARY_DERIVED, *indicators))
        stats = column_stats(derived, candidates)
        wide = columns_with_many_values(derived, candidates, limits.clip_min_distinct, stats)
        bounds, fills = {}, {}
        for c, (q1, q2, q3) in exact_quantiles(derived, wide, [0.25, 0.5, 0.75], stats=stats).items():
            fills[c] = q2
            if q3 > q1:
                reach = limits.clip_iqr_factor * (q3 - q1)
                bounds[c] = [q1 - reach, q3 + reach]
        clipped = clip(derived, bounds, fills)
        outputs = numeric_columns(clipped, exclude=(LABEL, *LEAKS, *IDENTIFIERS))
        averages = clipped.agg(*[F.avg(c).alias(c) for c in outputs]).first()
        state = {
            "medians": medians,
            "dictionary": asdict(dictionary),
            "types": types,
            "power_threshold": threshold,
            "bounds": bounds,
            "clip_medians": fills,
            "means": {c: averages[c] or 0.0 for c in outputs},
            "features": outputs,
        }
        model = FeaturePrepModel()
        model._set(state=json.dumps(state), handleInvalid=self.getOrDefault("handleInvalid"))
        return model


class FeaturePrepModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Produces the feature columns; the label and the ``_row`` column pass through."""

    def __init__(self):
        super().__init__()
        self._setDefault(handleInvalid="error")

    @property
    def features(self) -> list[str]:
        return self.learned()["features"]

    @property
    def dictionary(self) -> Dictionary:
        return Dictionary(**self.learned()["dictionary"])

    def with_dictionary(self, path: str) -> "FeaturePrepModel":
        """The same model with its dictionary copied to ``path``, to be stored with it."""
        kept = self.dictionary.copied(SparkSession.active(), path)
        return self.copy({self.state: json.dumps({**self.learned(), "dictionary": asdict(kept)})})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.learned()
        df = fill_medians(time_parts(dataset), s["medians"])
        df = encode_categories(df, self.dictionary, s["types"], self.getOrDefault("handleInvalid") == "keep")
        df = clip(derive(df, s["power_threshold"]), s["bounds"], s["clip_medians"])
        features = [
            F.coalesce(F.col(c).try_cast("double"), F.lit(s["means"].get(c, 0.0))).alias(c)
            for c in s["features"]
        ]
        aside = [c for c in (ROW, LABEL) if c in df.columns]
        return df.select(*features, *aside)


class ColumnScaler(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Robust (median, interquartile range) or standard scaling of columns in place.

    ``skipBinary`` leaves columns with at most two distinct values as they are.
    """

    kind = Param(Params._dummy(), "kind", "robust or standard", TypeConverters.toString)
    skipBinary = Param(Params._dummy(), "skipBinary", "leave two-valued columns", TypeConverters.toBoolean)
    inputCols = Param(Params._dummy(), "inputCols", "columns, default all numbers", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, kind: str = "robust", skipBinary: bool = False, inputCols: list[str] | None = None):
        super().__init__()
        self._setDefault(kind="robust", skipBinary=False, inputCols=[])
        self._set(kind=kind, skipBinary=skipBinary, inputCols=inputCols or [])

    def _fit(self, dataset: DataFrame) -> "ColumnScalerModel":
        columns = self.getOrDefault("inputCols") or numeric_columns(dataset, exclude=(LABEL,))
        stats = column_stats(dataset, columns)
        if self.getOrDefault("skipBinary"):
            columns = columns_with_many_values(dataset, columns, 2, stats)
        if self.getOrDefault("kind") == "robust":
            quartiles = exact_quantiles(dataset, columns, [0.25, 0.5, 0.75], stats=stats)
            scale = {c: [q2, q3 - q1, q2] for c, (q1, q2, q3) in quartiles.items() if q2 is not None}
        elif self.getOrDefault("kind") == "standard":
            medians = exact_quantiles(dataset, columns, [0.5], stats=stats)
            filled = dataset.select(*[
                F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0])).alias(c) for c in columns
            ])
            row = filled.agg(*[
                F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns
            ]).first()
            scale = {c: [row[c]["m"], row[c]["s"], medians[c][0]] for c in columns if row[c]["m"] is not None}
        else:
            raise ValueError(f"unknown scaling: {self.getOrDefault('kind')}")
        model = ColumnScalerModel()
        model._set(state=json.dumps(scale))
        return model


class ColumnScalerModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Applies learned centres and scales; a zero scale counts as one."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({
            c: (F.coalesce(F.col(c).cast("double"), F.lit(fill)) - F.lit(centre)) / F.lit(spread or 1.0)
            for c, (centre, spread, fill) in self.learned().items()
        })


def validate_matrix(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Per column: missing, infinite, non-numeric and constant findings, from one pass."""
    inf = float("inf")
    aggs, numeric = [], set(numeric_columns(df))
    for c in df.columns:
        infinite = (
            F.count(F.when(F.col(c).cast("double").isin(inf, -inf), 1)) if c in numeric else F.lit(0).cast("long")
        )
        missing = F.count(F.when(F.col(c).isNull() | (F.isnan(c) if c in numeric else F.lit(False)), 1))
        aggs.append(F.struct(
            missing.alias("missing"),
            infinite.alias("infinite"),
            # Two different values exist exactly when the extremes differ.
            flag(F.coalesce(F.min(c) == F.max(c), F.lit(True))).alias("constant"),
        ).alias(c))
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(int(c == label)).alias("is_label"),
            F.lit(int(c not in numeric)).alias("non_numeric"),
            F.col(f"{c}.missing").alias("missing"),
            F.col(f"{c}.infinite").alias("infinite"),
            F.col(f"{c}.constant").alias("constant"),
        )
        for c in df.columns
    ])))
