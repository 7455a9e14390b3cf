"""Quality of predictions, each figure from aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plantwatch.functions.statfns import safe_ratio
from plantwatch.operators.ranks import exclusive_running_sum
from plantwatch.session import materialise


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def classification_metrics(df: DataFrame, label: str = "will_fail", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class (one row); 0 where undefined."""
    y, p = F.col(label), F.col(prediction)
    c = df.agg(
        F.count(F.lit(1)).alias("rows"),
        _count((y == 1) & (p == 1)).alias("tp"),
        _count((y == 0) & (p == 1)).alias("fp"),
        _count((y == 1) & (p == 0)).alias("fn"),
        _count(y == p).alias("hits"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        "rows",
        safe_ratio(F.col("hits"), F.col("rows")).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str = "will_fail", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("rows"))


def classification_report(df: DataFrame, label: str = "will_fail", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    cells = confusion_matrix(df, label, prediction)
    actual = cells.select(F.col("actual").alias("cls"), "rows", (F.col("actual") == F.col("predicted")).alias("hit"), F.lit(True).alias("is_actual"))
    predicted = cells.select(F.col("predicted").alias("cls"), "rows", F.lit(False).alias("hit"), F.lit(False).alias("is_actual"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))

    per_class = actual.unionByName(predicted).groupBy("cls").agg(
        total(F.col("hit")).alias("tp"),
        total(F.col("is_actual")).alias("support"),
        total(~F.col("is_actual")).alias("called"),
    )
    tp, support, called = F.col("tp"), F.col("support"), F.col("called")
    scored = per_class.select(
        F.col("cls").cast("string").alias("class"),
        safe_ratio(tp, called).alias("precision"),
        safe_ratio(tp, support).alias("recall"),
        safe_ratio(2 * tp, support + called).alias("f1"),
        "support",
        "tp",
    )
    n = F.sum("support")

    def average(name: str, precision: Column, recall: Column, f1: Column) -> DataFrame:
        return scored.agg(
            precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), n.alias("support")
        ).select(F.lit(name).alias("class"), "precision", "recall", "f1", "support")

    accuracy = safe_ratio(F.sum("tp"), n)
    weighted = [safe_ratio(F.sum(F.col(m) * F.col("support")), n) for m in ("precision", "recall", "f1")]
    return (
        scored.drop("tp")
        .unionByName(average("accuracy", accuracy, accuracy, accuracy))
        .unionByName(average("macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1")))
        .unionByName(average("weighted avg", *weighted))
    )


def roc_auc(df: DataFrame, label: str = "will_fail", score: str = "score") -> DataFrame:
    """Area under the ROC curve as the rank statistic, ties counting half (one row).

    Rows shrink to one per distinct score before anything is ordered; that table is stored. Rows
    whose score or label is missing or NaN have no rank: they are left out and counted in
    ``unscored``.
    """
    return roc_auc_by(df, [], label, score)


def roc_auc_by(df: DataFrame, groups: list[str], label: str = "will_fail", score: str = "score") -> DataFrame:
    """``roc_auc`` of every group, all in one go; groups must have no gaps."""
    known = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull()
    usable = F.coalesce(known, F.lit(False))
    counts = materialise(df.groupBy(*groups, F.when(usable, F.col(score).cast("double")).alias("score")).agg(
        _count(usable & (F.col(label) == 1)).alias("pos"), _count(usable & (F.col(label) == 0)).alias("neg"),
        _count(~usable).alias("unscored"),
    ), "scores")
    ranked = exclusive_running_sum(counts.filter("score IS NOT NULL"), "score", "neg", "neg_below", tuple(groups))
    gaps = counts.filter("score IS NULL").withColumn("neg_below", F.lit(0).cast("long"))
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.unionByName(gaps).groupBy(*groups).agg(
        (wins / F.when(pairs != 0, pairs)).alias("roc_auc"),
        F.coalesce(F.sum("unscored"), F.lit(0)).cast("long").alias("unscored"),
    )
