"""Training a boosted-tree classifier that predicts failure within the horizon."""

from __future__ import annotations

import itertools
import json
import logging
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantwatch.ml import boost
from plantwatch.ml.evaluate import classification_metrics, roc_auc, roc_auc_by
from plantwatch.ml.features import LABEL, ROW, TIME, FeaturePrep, FeaturePrepModel, with_row
from plantwatch.ml.split import KEYS, class_weights, stratified_folds, stratified_split
from plantwatch.session import materialise, side_by_side

log = logging.getLogger(__name__)


# Classifier defaults and search grid.
@dataclass(frozen=True)
class BoostParams:
    trees: int = 100
    depth: int = 3
    learning_rate: float = 0.1
    min_split_rows: int = 2


GRID = {
    "trees": (50, 100),
    "depth": (3, 5),
    "learning_rate": (0.1, 0.2),
    "min_split_rows": (5, 10),
}


def expand_grid(grid: dict[str, tuple] = GRID) -> list[BoostParams]:
    return [BoostParams(**dict(zip(grid, values))) for values in itertools.product(*grid.values())]


@dataclass
class Fitted:
    """Models grown side by side: candidates on every fold, and each once on all rows."""

    ensemble: boost.Ensemble
    preps: list[FeaturePrepModel]
    edges: list[list[list[float]]]
    growths: list[boost.Growth]
    scores: DataFrame | None
    ranking: list[dict]

    def model(self, params: BoostParams) -> tuple[PipelineModel, list[tuple[str, float]]]:
        """The pipeline of one candidate, fitted to all rows, and its feature importances."""
        view = len(self.preps) - 1
        m = self.growths.index(_growth(params, view, None))
        names = self.preps[view].features
        trees = boost.BoostedTreesModel.of(self.ensemble, m, params.trees, names, self.edges[view])
        return PipelineModel([self.preps[view], trees]), boost.importances(self.ensemble, m, params.trees, names)


def _growth(p: BoostParams, view: int, without: int | None) -> boost.Growth:
    return boost.Growth(view, without, p.depth, p.learning_rate, p.min_split_rows)


def _views(rows: DataFrame, preps: list[FeaturePrepModel]) -> DataFrame:
    """The rows with one array column per preparation, its features in order."""
    columns = list(rows.columns)
    for v, prep in enumerate(preps):
        features = F.array(*[F.col(c) for c in prep.features]).alias(f"view{v}")
        rows = prep.transform(with_row(rows)).select(features, f"{ROW}.*").select(*columns, f"view{v}")
        columns.append(f"view{v}")
    return rows


def fit_candidates(
    train: DataFrame, candidates: list[BoostParams], folds: int = 3, keys: tuple[str, ...] = KEYS
) -> Fitted:
    """Fit every candidate to all rows, and for ``folds`` > 0 to all folds but one.

    Preparation is fitted anew for each fold, never on the fold's held-out rows; a category seen
    there only gets a code of its own. Held-out scores of every candidate are stored, and the
    candidates ranked by their mean area under the curve over the folds.
    """
    spark = train.sparkSession
    folded = materialise(stratified_folds(train, LABEL, keys, folds) if folds else train.withColumn("fold", F.lit(0)), "folds")
    held = [folded.filter(F.col("fold") != k).drop("fold") for k in range(folds)]
    preps = side_by_side(spark, FeaturePrep(handleInvalid="keep").fit, [*held, folded.drop("fold")])
    views = [f"view{v}" for v in range(len(preps))]
    wide = materialise(_views(folded, preps), "views")

    def edges_of(v: int) -> list[list[float]]:
        fit = wide.filter(F.col("fold") != v) if v < folds else wide
        named = fit.select(*[F.col(f"view{v}")[j].alias(str(j)) for j in range(len(preps[v].features))])
        return boost.bin_edges(named, named.columns)

    edges = side_by_side(spark, edges_of, range(len(preps)))
    last = len(preps) - 1
    growths = list(dict.fromkeys(
        _growth(c, view, view if view < last else None) for view in range(len(preps)) for c in candidates
    ))
    counts = {(r["fold"], int(r[LABEL])): r["count"] for r in folded.groupBy("fold", LABEL).count().collect()}
    most = max(c.trees for c in candidates)
    ensemble = boost.Ensemble(
        growths, [len(p.features) for p in preps], most, boost.start_margins(counts, growths),
        sizes=[[len(cuts) + 1 for cuts in own] for own in edges])
    blocks = materialise(boost.pack(wide, LABEL, "fold", views, edges, list(keys)), "blocks")
    lengths = tuple(sorted({c.trees for c in candidates})) if folds else ()
    grow = boost.grow_held if sum(counts.values()) <= boost.HELD_ROWS else boost.grow_all
    stored = grow(blocks, ensemble, most, lengths)
    if not folds:
        return Fitted(ensemble, preps, edges, growths, None, [])

    wanted = [
        (n, m, growths.index(m), c.trees) for n, c in enumerate(candidates) for k in range(folds)
        for m in [_growth(c, k, k)]
    ]
    names = spark.createDataFrame([(n, m, t) for n, _, m, t in wanted], "candidate int, model int, trees int")
    scored = None
    for trees, frame in stored.items():
        part = boost.held_out_scores(frame, ensemble, trees)
        scored = part if scored is None else scored.unionByName(part)
    # One row per candidate and fold.
    scores = materialise(scored.join(F.broadcast(names), ["model", "trees"]).select(
        "keys.*", "candidate", "fold", "label", "score"), "cv-scores")
    areas = roc_auc_by(scores, ["candidate", "fold"], "label").collect()
    if all(r["roc_auc"] is None for r in areas):
        raise ValueError("no fold has rows of both classes to rank the candidates by")
    ranking = []
    for n, c in enumerate(candidates):
        own = [r["roc_auc"] for r in areas if r["candidate"] == n and r["roc_auc"] is not None]
        ranking.append({"candidate": n, **asdict(c), "folds": len(own), "auc": sum(own) / len(own) if own else 0.0})
    return Fitted(ensemble, preps, edges, growths, scores, sorted(ranking, key=lambda r: (-r["auc"], r["candidate"])))


@dataclass
class Trained:
    model: PipelineModel
    params: BoostParams
    tuning: str
    cutoff: str | None
    metrics: dict[str, float]
    weights: dict[str, float]
    importances: list[tuple[str, float]] = field(default_factory=list)
    fitted: Fitted | None = None
    predictions: DataFrame | None = None
    search_error: str | None = None  # why the search asked for is not what was fitted

    def importance_table(self, spark: SparkSession, top: int | None = None) -> DataFrame:
        """Features by importance, largest first; one row per feature column."""
        rows = [(i + 1, n, v) for i, (n, v) in enumerate(self.importances)][:top]
        return spark.createDataFrame(rows, "position int, feature string, importance double")

    def metrics_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.metrics.items()), "metric string, value double")

    def save(self, path: str) -> None:
        """The fitted stages, with cutoff, parameters and metrics beside them."""
        prep, *rest = self.model.stages
        kept = PipelineModel([prep.with_dictionary(f"{path}/dictionary"), *rest])
        kept.write().overwrite().save(f"{path}/stages")
        spark = SparkSession.active()
        facts = json.dumps({
            "model_id": uuid.uuid4().hex,
            "params": asdict(self.params),
            "tuning": self.tuning,
            "search_error": self.search_error,
            "latest_training_hour_bucket": self.cutoff,
            "metrics": self.metrics,
            "class_weights": self.weights,
        })
        spark.createDataFrame([(facts,)], "value string").write.mode("overwrite").text(f"{path}/facts")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """A saved model and its facts."""
    facts = json.loads(spark.read.text(f"{path}/facts").first()["value"])
    return PipelineModel.load(f"{path}/stages"), facts


def train(
    rows: DataFrame,
    params: BoostParams = BoostParams(),
    candidates: list[BoostParams] | None = None,
    keys: tuple[str, ...] = KEYS,
    fallback: bool = True,
) -> Trained:
    """Split, optionally search, fit on the training side and evaluate on both sides.

    If the search fails the given parameters are fitted instead, and the failure is recorded as
    ``search_error``; without ``fallback`` it is raised, for callers whose results are those of the search.
    """
    split = materialise(stratified_split(rows, LABEL, keys), "split")
    train_rows = split.filter("is_test = 0").drop("is_test")
    test_rows = split.filter("is_test = 1").drop("is_test")
    weights = {str(r[LABEL]): r["weight"] for r in class_weights(train_rows, LABEL).collect()}
    cutoff = training_cutoff(rows).first()["cutoff"]

    fitted, tuning, metrics, failed = None, "default_params", {}, None
    if candidates:
        try:
            fitted = fit_candidates(train_rows, candidates, keys=keys)
            best = fitted.ranking[0]
            metrics["cv_auc"] = best["auc"]
            params, tuning = candidates[best["candidate"]], "grid_search"
        except (PySparkException, Py4JError, ValueError) as error:
            if not fallback:
                raise
            log.exception("search failed, fitting %s", params)
            fitted, failed = None, f"{type(error).__name__}: {error}"
    if fitted is None:
        fitted = fit_candidates(train_rows, [params], folds=0, keys=keys)
    model, ranked = fitted.model(params)

    predictions = None
    for side, data in (("train", train_rows), ("test", test_rows)):
        predicted = materialise(predict(model, data), "predicted")
        row = classification_metrics(predicted).first()
        metrics.update({f"{side}_{m}": float(row[m]) for m in ("accuracy", "precision", "recall", "f1")})
        if side == "test":
            value = roc_auc(predicted).first()["roc_auc"]
            if value is not None:
                metrics["test_auc"] = value
        tagged = predicted.withColumn("is_test", F.lit(int(side == "test")))
        predictions = tagged if predictions is None else predictions.unionByName(tagged)
    return Trained(
        model, params, tuning, cutoff.isoformat() if cutoff else None, metrics, weights, ranked, fitted, predictions, failed,
    )


def training_cutoff(rows: DataFrame) -> DataFrame:
    """Latest hour the model has seen (one row)."""
    return rows.agg(F.max(TIME).alias("cutoff"))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Original columns with ``prediction`` and the positive-class ``score``."""
    return model.transform(with_row(rows)).select(f"{ROW}.*", "prediction", "score")
