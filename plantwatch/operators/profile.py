"""Descriptive statistics. A "reading" is one non-missing sensor value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plantwatch.functions.bands import flag
from plantwatch.functions.statfns import k_squared, k_squared_p_value, percent
from plantwatch.operators.quantiles import column_stats, exact_quantiles
from plantwatch.params import SENSORS


def _plus(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Count and share of all rows for every non-missing value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return (
        counts.withColumn("percentage", percent(F.col("count"), total))
        .filter(F.col(column).isNotNull())
        .withColumnRenamed(column, "value")
    )


def long_readings(df: DataFrame, keep: list[str], sensors=SENSORS) -> DataFrame:
    """One row per non-missing sensor value: ``keep`` columns, reading_type, value."""
    return df.unpivot(keep, list(sensors), "reading_type", "value").filter("value IS NOT NULL")


def readings_in_row(sensors=SENSORS) -> Column:
    """How many readings one wide row holds."""
    return _plus([F.col(c).isNotNull().cast("int") for c in sensors])


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles (one row), from two passes."""
    stats = column_stats(df, [column], moments=True)
    p25, p50, p75 = exact_quantiles(df, [column], [0.25, 0.5, 0.75], stats)[column]
    s = stats[column]
    return df.sparkSession.createDataFrame(
        [(s.n, s.mean, s.std, s.low, p25, p50, p75, s.high)],
        "count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double",
    )


def moments(df: DataFrame, columns=SENSORS) -> DataFrame:
    """Per column: count, mean, deviation, extremes, population skewness and excess kurtosis, cv.

    One pass over the long view: a grouped aggregate of few buffers stays in compiled code,
    and every task sends one row per column on.
    """
    long = long_readings(df, [], columns)
    rows = long.groupBy("reading_type").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.skewness("value").alias("skewness"),
        F.kurtosis("value").alias("kurtosis"),
    )
    return rows.withColumn(
        "cv", F.when(F.col("mean") != 0, F.col("std") / F.col("mean")).otherwise(F.lit(0.0))
    )


def normality(df: DataFrame, columns=SENSORS, min_samples: int = 8, alpha: float = 0.05) -> DataFrame:
    """K-squared normality test per column, from one pass of moments.

    A column without any spread has no statistic and is reported with NULLs.
    """
    m = moments(df, columns).filter(F.col("count") >= min_samples)
    tested = m.select(
        "reading_type",
        F.col("count").alias("n_samples"),
        F.when(F.col("std") > 0, k_squared(F.col("count"), F.col("skewness"), F.col("kurtosis")))
        .alias("k2"),
    )
    p = k_squared_p_value(F.col("k2"))
    return tested.withColumn("p_value", p).withColumn(
        "is_normal", F.when(p.isNotNull(), flag(p > alpha))
    )


def reading_type_counts(df: DataFrame, sensors=SENSORS) -> DataFrame:
    """Readings per sensor."""
    wide = df.agg(*[F.count(c).alias(c) for c in sensors])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("value"), F.col(c).alias("count")) for c in sensors
    ]))).filter("count > 0")


def reading_frequency(df: DataFrame, column: str, sensors=SENSORS) -> DataFrame:
    """Like :func:`frequency`, counting readings instead of rows."""
    counts = df.groupBy(column).agg(F.sum(readings_in_row(sensors)).alias("count")).filter("count > 0")
    total = counts.agg(F.sum("count")).scalar()
    return (
        counts.withColumn("percentage", percent(F.col("count"), total))
        .filter(F.col(column).isNotNull())
        .withColumnRenamed(column, "value")
    )


def readings_by(df: DataFrame, part: Column, name: str, sensors=SENSORS) -> DataFrame:
    """Readings per value of an expression, unknown values left out."""
    counts = df.groupBy(part.alias(name)).agg(F.sum(readings_in_row(sensors)).alias("readings"))
    return counts.filter(F.col(name).isNotNull() & (F.col("readings") > 0))


def pooled_by(df: DataFrame, key: str, sensors=SENSORS, poor: Column | None = None) -> DataFrame:
    """Mean, sample deviation, count and share of poor readings over all sensors, per key.

    Combines per-sensor counts, means and variances, which is stable for any magnitude and
    needs no row per reading.
    """
    aggs = []
    for c in sensors:
        aggs += [F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"), F.var_pop(c).alias(f"v_{c}")]
    if poor is not None:
        aggs.append(F.sum(F.when(poor, readings_in_row(sensors)).otherwise(0)).alias("poor"))
    g = df.groupBy(key).agg(*aggs)
    n = [F.col(f"n_{c}") for c in sensors]
    m = [F.coalesce(F.col(f"m_{c}"), F.lit(0.0)) for c in sensors]
    v = [F.coalesce(F.col(f"v_{c}"), F.lit(0.0)) for c in sensors]
    g = g.withColumn("reading_count", _plus(n)).filter("reading_count > 0")
    g = g.withColumn("avg_reading", _plus([a * b for a, b in zip(n, m)]) / F.col("reading_count"))
    spread = _plus([a * (c + F.pow(b - F.col("avg_reading"), 2)) for a, b, c in zip(n, m, v)])
    g = g.withColumn(
        "reading_std",
        F.when(F.col("reading_count") > 1, F.sqrt(spread / (F.col("reading_count") - 1))),
    )
    out = [key, "avg_reading", "reading_std", "reading_count"]
    if poor is not None:
        g = g.withColumn("poor_quality_ratio", F.col("poor") / F.col("reading_count"))
        out.append("poor_quality_ratio")
    return g.select(*out)


def _bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin; the last bin includes its upper edge. No value, no bin."""
    raw = F.floor((value - F.lit(low)) * F.lit(float(bins)) / F.lit(high - low))
    return F.when(raw.isNotNull(), F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Equal-width histogram per column: every bin with its edges, count and density.

    The bounds (two numbers per column) come from a first aggregate; a column with a single
    value gets a range of width one around it.
    """
    spark = df.sparkSession
    bounds = df.agg(*[
        F.struct(
            F.min(F.col(c).cast("double")).alias("lo"),
            F.max(F.col(c).cast("double")).alias("hi"),
            F.count(c).alias("n"),
        ).alias(c)
        for c in columns
    ]).first()
    ranges = {}
    for c in columns:
        lo, hi, n = bounds[c]
        if n:
            ranges[c] = (lo - 0.5, hi + 0.5, n) if lo == hi else (lo, hi, n)
    if not ranges:
        return spark.createDataFrame(
            [], "reading_type string, bin int, bin_low double, bin_high double, count long, density double"
        )
    binned = df.select(*[
        _bin_of(F.col(c).cast("double"), lo, hi, bins).alias(c) for c, (lo, hi, _) in ranges.items()
    ])
    counts = (
        binned.unpivot([], list(ranges), "reading_type", "bin")
        .filter("bin IS NOT NULL")
        .groupBy("reading_type", "bin")
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    edges = spark.createDataFrame(
        [(c, lo, hi, n) for c, (lo, hi, n) in ranges.items()],
        "reading_type string, lo double, hi double, n long",
    ).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    count = F.coalesce(F.col("_count"), F.lit(0))
    return edges.join(counts, ["reading_type", "bin"], "left").select(
        "reading_type",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_high"),
        count.alias("count"),
        (count / (F.col("n") * width)).alias("density"),
    )
