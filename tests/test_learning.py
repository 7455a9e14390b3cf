"""Preparation, split, evaluation, training and scoring."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plantwatch.catalog import queries as catalog
from plantwatch.ml import boost, evaluate, features as prep, split, train as learn
from plantwatch.ml.score import ScoredTable, score_new, scoring_input
from plantwatch.operators.ranks import exclusive_running_sum
from plantwatch.schemas import ML_FEATURES_DDL


@pytest.fixture(scope="module")
def rows(spark, small):
    return catalog._stored_training(catalog.entities(spark, small))


@pytest.fixture(scope="module")
def prepared(rows):
    return prep.FeaturePrep().fit(rows)


def test_features_carry_no_identifier_or_leak(rows, prepared):
    names = prepared.features
    assert not {"device_id", "failure_type", "severity", "days_before_failure", "will_fail"} & set(names)
    assert not [n for n in names if n.endswith("_encoded") and n.startswith(("failure", "severity"))]
    out = prepared.transform(rows)
    findings = {r.column_name: r for r in prep.validate_matrix(out).collect()}
    assert all(f.missing == 0 and f.infinite == 0 and f.non_numeric == 0 for f in findings.values())
    assert out.count() == rows.count()
    # 30 columns that do not depend on the device types, and one per type
    assert len(names) == 29 + len(prepared.learned()["types"])


def test_scoring_one_row_equals_scoring_all(rows, prepared):
    key = rows.orderBy("device_id", "hour_bucket").first()
    one = rows.filter((F.col("device_id") == key.device_id) & (F.col("hour_bucket") == key.hour_bucket))
    alone = prepared.transform(prep.with_row(one)).collect()
    together = prepared.transform(prep.with_row(rows)).filter(
        (F.col("_row.device_id") == key.device_id) & (F.col("_row.hour_bucket") == key.hour_bucket)
    ).collect()
    assert sorted(map(str, alone)) == sorted(map(str, together))


def test_unseen_category(spark, rows, prepared):
    odd = rows.limit(1).withColumn("location", F.lit("nowhere"))
    with pytest.raises(Exception, match="unseen value in location"):
        prepared.transform(odd).collect()
    kept = prepared.copy({prepared.handleInvalid: "keep"}).transform(odd).first()
    bounds = prepared.learned()["bounds"].get("location_encoded", [0, math.inf])
    assert kept.location_encoded == min(prepared.learned()["dictionary"]["words"]["location"], bounds[1])


def _table(spark, **columns):
    n = len(next(iter(columns.values())))
    data = [tuple(float(v[i]) if v[i] is not None else None for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(data, ", ".join(f"{c} double" for c in columns))


def test_clipping_needs_more_than_ten_values_and_a_spread(spark):
    ten = [float(i % 10) for i in range(79)] + [9.0]
    eleven = [float(i % 10) for i in range(79)] + [1000.0]
    flat = [5.0] * 65 + [float(i) for i in range(100, 115)]  # 16 values, both quartiles 5
    df = _table(spark, ten=ten, eleven=eleven, flat=flat, empty=[None] * 80)
    s = prep.FeaturePrep().fit(df).learned()
    assert set(s["bounds"]) == {"eleven"}
    q1, q3 = np.quantile(eleven, [0.25, 0.75])
    assert np.allclose(s["bounds"]["eleven"], [q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)])
    out = prep.FeaturePrep().fit(df).transform(df)
    assert out.agg(F.max("eleven")).first()[0] == s["bounds"]["eleven"][1]
    assert out.agg(F.max("empty")).first()[0] == 0.0


def test_scalers(spark):
    values, flags = [1.0, 2.0, 3.0, 4.0, 100.0], [0.0, 1.0, 0.0, 1.0, 1.0]
    df = _table(spark, v=values, b=flags)
    robust = prep.ColumnScaler(kind="robust", skipBinary=True).fit(df).transform(df).collect()
    assert [r.v for r in robust] == [(x - 3) / 2 for x in values] and [r.b for r in robust] == flags
    standard = prep.ColumnScaler(kind="standard").fit(df).transform(df).collect()
    assert np.allclose([r.v for r in standard], (np.array(values) - np.mean(values)) / np.std(values))


def test_derived_edges(spark):
    df = spark.createDataFrame(
        [(0.0, 8.0, 10.0, 180.0, 20.0), (None, None, None, -1.0, 50.0), (75.5, 8.5, 4.0, 366.0, 19.0)],
        "avg_temperature double, avg_vibration double, avg_power double, days_since_maintenance double, reading_count double",
    )
    a, b, c = prep.derive(df, 5.0).collect()
    assert (a.power_efficiency, a.temp_risk, a.vibration_risk, a.maintenance_overdue, a.low_data_quality) == (10.0, 1, 0, 0, 0)
    assert (b.temp_risk, b.vibration_risk, b.data_quality_score, b.log_days_maintenance) == (0, 0, 1.0, -math.inf)
    assert (c.temp_risk, c.vibration_risk, c.maintenance_overdue, c.maintenance_urgent, c.low_data_quality) == (1, 1, 1, 1, 1)
    assert (a.high_power_consumption, c.high_power_consumption) == (1, 0)


def test_split_is_exact_stratified_and_stable(spark):
    df = spark.range(2000).select(
        F.concat(F.lit("d"), F.col("id")).alias("device_id"), (F.col("id") % 3 == 0).cast("int").alias("will_fail")
    )
    first = split.stratified_split(df, "will_fail", ("device_id",))
    counts = {r.will_fail: r.t for r in first.groupBy("will_fail").agg(F.sum("is_test").alias("t")).collect()}
    assert counts == {0: round(0.2 * 1333), 1: round(0.2 * 667)}
    again = split.stratified_split(df.repartition(7), "will_fail", ("device_id",))
    assert first.exceptAll(again).count() == 0
    folds = split.stratified_folds(df, "will_fail", ("device_id",))
    assert {r.fold for r in folds.select("fold").distinct().collect()} == {0, 1, 2}


def test_split_keeps_copies_together(spark):
    df = spark.range(900).select(
        F.when(F.col("id") < 300, "copy").otherwise(F.col("id").cast("string")).alias("device_id"), F.lit(0).alias("will_fail")
    )
    sides = split.stratified_split(df, "will_fail", ("device_id",)).filter("device_id = 'copy'").select("is_test").distinct()
    assert sides.count() == 1


def _scored(spark, rows):
    return spark.createDataFrame(rows, "will_fail int, prediction int, score double")


def test_metrics(spark):
    perfect = evaluate.classification_metrics(_scored(spark, [(1, 1, 0.9), (0, 0, 0.1)])).first()
    assert (perfect.accuracy, perfect.precision, perfect.recall, perfect.f1) == (1, 1, 1, 1)
    negative = evaluate.classification_metrics(_scored(spark, [(1, 0, 0.1), (0, 0, 0.1)])).first()
    assert (negative.precision, negative.recall, negative.f1) == (0, 0, 0)
    report = {r["class"]: r for r in evaluate.classification_report(
        _scored(spark, [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.1), (0, 0, 0.2)])).collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].support) == (1.0, 0.5, 2)
    assert report["accuracy"].f1 == 0.75 and math.isclose(report["macro avg"].recall, 0.75)


def test_auc_counts_ties_half_and_matches_the_built_in(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 1500)
    s = np.round(rng.normal(size=1500) + y, 1) + 0.0  # one zero, not two
    df = _scored(spark, [(int(a), 0, float(b)) for a, b in zip(y, s)])
    got = evaluate.roc_auc(df).first().roc_auc
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert math.isclose(got, brute, rel_tol=1e-12)
    built_in = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="will_fail", numBins=0)
    assert math.isclose(got, built_in.evaluate(df), rel_tol=1e-9)
    assert evaluate.roc_auc(_scored(spark, [(1, 1, 0.5)])).first().roc_auc is None


def test_train_save_score(spark, rows, tmp_path):
    trained = learn.train(rows, learn.BoostParams(trees=3))
    assert trained.tuning == "default_params" and 0 <= trained.metrics["test_auc"] <= 1
    assert math.isclose(sum(v for _, v in trained.importances), 1.0, rel_tol=1e-6)
    path = str(tmp_path / "model")
    trained.save(path)
    model, facts = learn.load(spark, path)
    assert isinstance(model, PipelineModel) and facts["latest_training_hour_bucket"] == trained.cutoff
    same = learn.predict(model, rows).select("score").exceptAll(learn.predict(trained.model, rows).select("score"))
    assert same.count() == 0
    first = rows.agg(F.min("hour_bucket").alias("m")).first().m
    later = rows.withColumn("hour_bucket", F.col("hour_bucket") + F.expr("INTERVAL 40 DAYS"))
    fresh = score_new(later, path)
    assert fresh.count() == rows.filter(F.col("hour_bucket").isNotNull()).filter(
        F.col("hour_bucket") + F.expr("INTERVAL 40 DAYS") > F.lit(trained.cutoff).cast("timestamp")).count()
    assert "will_fail" not in fresh.columns and "will_fail_prediction" in fresh.columns
    assert {c for c in ML_FEATURES_DDL.replace("\n", " ").split() if c == "device_id"} <= set(fresh.columns)
    assert score_new(later, path, scored=fresh).count() == 0
    assert scoring_input(rows, first.isoformat()).filter(F.col("hour_bucket") <= F.lit(first)).count() == 0
    score_new(later, path, output="predictions_log")
    score_new(later, path, output="predictions_log", scored=spark.read.table("predictions_log"))
    assert spark.read.table("predictions_log").count() == fresh.count()

    # The ledger: half a batch is written over, a repeated job adds nothing, late rows are found.
    table = ScoredTable(spark, str(tmp_path / "scored"))
    assert table.read() is None
    wanted = scoring_input(later, facts["latest_training_hour_bucket"])
    keys = wanted.select("device_id", "hour_bucket").distinct().orderBy("hour_bucket", "device_id").collect()
    late, middle = keys[0], keys[len(keys) // 2].hour_bucket
    is_late = (F.col("device_id") == late.device_id) & (F.col("hour_bucket") == late.hour_bucket)
    early = later.filter((F.col("hour_bucket") <= F.lit(middle)) & ~is_late)
    n = table.append(early, path)
    assert n == wanted.filter((F.col("hour_bucket") <= F.lit(middle)) & ~is_late).count()
    fresh.limit(3).write.parquet(str(tmp_path / "scored" / "batches" / "broken"))
    assert table.append(early, path) == 0 and table.read().count() == n
    assert n + table.append(later, path) == fresh.count()
    assert table.append(later, path) == 0 and table.ledger().count() == 2
    assert table.read().select("device_id", "hour_bucket").exceptAll(fresh.select("device_id", "hour_bucket")).count() == 0


def test_a_failed_search_falls_back(rows, monkeypatch):
    def broken(*args, **kwargs):
        raise ValueError("no areas today")

    monkeypatch.setattr(learn, "roc_auc_by", broken)
    trained = learn.train(rows, learn.BoostParams(trees=2, depth=2), candidates=[learn.BoostParams(trees=1)])
    assert trained.tuning == "default_params" and trained.params == learn.BoostParams(trees=2, depth=2)
    assert "cv_auc" not in trained.metrics and trained.fitted.scores is None


def test_a_failed_search_is_not_shown_as_a_result(spark, small, rows, monkeypatch):
    search, areas = learn.fit_candidates, learn.roc_auc_by

    def broken(train, candidates, folds=3, **options):
        if folds:
            raise ValueError("no areas today")
        return search(train, candidates, folds, **options)

    catalog._trained.cache_clear()
    monkeypatch.setattr(learn, "fit_candidates", broken)
    for name in ("gbt_grid_cv", "gbt_importances", "gbt_metrics"):
        with pytest.raises(ValueError, match="no areas today"):
            catalog.queries()[name](spark, small)
    fallen = learn.train(rows, learn.BoostParams(trees=1, depth=1), candidates=[learn.BoostParams(trees=1)])
    assert fallen.search_error == "ValueError: no areas today"
    # Candidates that no fold can rank are not ranked.
    monkeypatch.setattr(learn, "roc_auc_by", lambda *args: areas(*args).withColumn("roc_auc", F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="both classes"):
        search(rows, [learn.BoostParams(trees=1, depth=1)])


def test_grid():
    grid = learn.expand_grid()
    assert len(grid) == 16 and len(set(grid)) == 16


def _plain_boosting(bins, y, trees, depth, rate, least):
    """Boosted trees over binned columns, one row and one split at a time."""
    start = math.log(y.sum() / (len(y) - y.sum()))
    margin = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        step = np.zeros(len(y))

        def grow(rows, level):
            step[rows] = g[rows].sum() / h[rows].sum()
            best = (1e-12, None, None)
            if level == depth or len(rows) < least:
                return
            for f in range(bins.shape[1]):
                for cut in range(bins[rows, f].max()):
                    low = bins[rows, f] <= cut
                    n = low.sum()
                    if n and n < len(rows):
                        a, b = g[rows[low]].mean(), g[rows[~low]].mean()
                        gain = round(n * (len(rows) - n) / len(rows) * (a - b) ** 2, 9)
                        if gain > best[0]:
                            best = (gain, f, cut)
            if best[1] is not None:
                low = bins[rows, best[1]] <= best[2]
                grow(rows[low], level + 1)
                grow(rows[~low], level + 1)

        grow(np.arange(len(y)), 0)
        margin += rate * step
    return margin


def test_boosting_side_by_side_equals_each_model_alone(spark, monkeypatch):
    monkeypatch.setattr(boost, "CHECKPOINT", 2)
    rng = np.random.default_rng(3)
    n = 300
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0) ^ (rng.random(n) < 0.1)).astype(int)
    fold = rng.integers(0, 2, n)
    df = spark.createDataFrame(
        [(int(i), int(a), int(f), [float(c) for c in r]) for i, (a, f, r) in enumerate(zip(y, fold, x))],
        "id int, y int, fold int, x array<double>",
    ).repartition(3)
    edges = boost.bin_edges(df.select(*[F.col("x")[j].alias(str(j)) for j in range(3)]), ["0", "1", "2"], bins=8)
    growths = [boost.Growth(0, 0, 3, 0.3, 5), boost.Growth(0, 1, 2, 0.1, 20), boost.Growth(0, None, 4, 0.2, 2)]
    counts = {(k, c): int(((fold == k) & (y == c)).sum()) for k in (0, 1) for c in (0, 1)}
    ensemble = boost.Ensemble(growths, [3], 5, boost.start_margins(counts, growths))
    from plantwatch.session import materialise

    blocks = materialise(boost.pack(df, "y", "fold", ["x"], [edges], ["id"]), "blocks")
    kept = boost.grow_all(blocks, ensemble, 5, (3, 5))
    bins = boost.binned(x, edges)
    for trees, frame in kept.items():
        scores = {(r.model, r["keys"].id): r.score for r in boost.held_out_scores(frame, ensemble, trees).collect()}
        for m, k in ((0, 0), (1, 1)):
            g = growths[m]
            fit = fold != k
            # Rows left out take the trees' values, so grow on the fitted and read off the others' bins.
            alone = boost.Ensemble([boost.Growth(0, None, g.depth, g.learning_rate, g.min_split_rows)], [3], trees,
                                   [ensemble.starts[m]])
            alone.trees = [ensemble.trees[m]]
            margins = alone.margins({"label": y, "margins": None, "bins": [bins]}, trees)[0]
            assert np.allclose(margins[fit], _plain_boosting(bins[fit], y[fit], trees, g.depth, g.learning_rate, g.min_split_rows))
            assert all(math.isclose(scores[m, i], 1 / (1 + math.exp(-margins[i]))) for i in np.flatnonzero(~fit))
    whole = ensemble.margins({"label": y, "margins": None, "bins": [bins]}, 0)  # trees are stored, starts only
    assert np.allclose(whole[2], ensemble.starts[2])


def test_running_sums_over_a_tree_of_bits(spark):
    rng = np.random.default_rng(2)
    values = sorted({*rng.normal(size=300), *(-1e300, -5e-324, 0.0, 5e-324, 1e300, float("inf"), float("-inf"), 1.0)})
    df = spark.createDataFrame([(g, float(v), i) for g in (1, 2) for i, v in enumerate(values[:: g])], "g int, v double, n long")
    got = {(r.g, r.v): r.below for r in exclusive_running_sum(df, "v", "n", "below", ("g",)).collect()}
    for g in (1, 2):
        total = 0
        for i, v in enumerate(values[::g]):
            assert got[g, v] == total
            total += i


def test_auc_of_many_groups(spark):
    rng = np.random.default_rng(6)
    rows = [(int(g), int(rng.integers(0, 2)), 0, float(np.round(rng.normal(), 1))) for g in rng.integers(0, 4, 400)]
    df = spark.createDataFrame(rows, "g int, will_fail int, prediction int, score double")
    areas = {r.g: r.roc_auc for r in evaluate.roc_auc_by(df, ["g"]).collect()}
    for g in range(4):
        assert math.isclose(areas[g], evaluate.roc_auc(df.filter(F.col("g") == g)).first().roc_auc, rel_tol=1e-12)
    empty = evaluate.roc_auc(df.limit(0)).first()
    assert empty.roc_auc is None and empty.unscored == 0


def test_models_that_are_the_same_so_far_are_added_up_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 200
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(int)
    df = spark.createDataFrame([(i, int(a), 0, [float(c) for c in r]) for i, (a, r) in enumerate(zip(y, x))],
                               "id int, y int, fold int, x array<double>")
    edges = boost.bin_edges(df.select(*[F.col("x")[j].alias(str(j)) for j in range(2)]), ["0", "1"], bins=8)
    counts = {(0, c): int((y == c).sum()) for c in (0, 1)}
    from plantwatch.session import materialise

    blocks = materialise(boost.pack(df, "y", "fold", ["x"], [edges], ["id"]), "blocks")
    asked, added, adaptive = boost.Ensemble._best, [], spark.conf.get("spark.sql.adaptive.enabled")
    monkeypatch.setattr(boost.Ensemble, "_best", lambda self, b, t, level, nodes: added.append(set(nodes)) or asked(self, b, t, level, nodes))
    least = (2, 60, 3)

    def grown(*models):
        ensemble = boost.Ensemble([boost.Growth(0, None, 3, 0.3, m) for m in models], [2], 3, boost.start_margins(
            counts, [boost.Growth(0, None, 3, 0.3, m) for m in models]))
        boost.grow_all(blocks, ensemble, 3)
        return ensemble.trees

    together = grown(*least)
    assert added[0] == {0} and any(1 in models for models in added)
    for trees, m in zip(together, least):
        alone = grown(m)[0]
        assert all((getattr(trees, a) == getattr(alone, a)).all() for a in ("feature", "bin", "value"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive


def test_columns_of_few_bins_share_a_histogram():
    rng = np.random.default_rng(9)
    sizes, bins, n, nodes = [2, 8, 3, 2, 1, 2, 5], 8, 500, 2
    columns = np.stack([rng.integers(0, k, n) for k in sizes]).astype(np.uint8)
    groups = boost.bundles(sizes, bins)
    assert sorted(j for g in groups for j in g) == list(range(len(sizes))) and len(groups) < len(sizes)
    assert all(math.prod(sizes[j] for j in g) <= bins for g in groups)
    weights = rng.integers(0, 9, n).astype(float)
    cells = boost.joint(columns, sizes, groups)
    hist = np.stack([[np.bincount(c, w, bins) for c in cells] for w in (weights, None)])
    alone = np.stack([[np.bincount(c, w, bins) for c in columns] for w in (weights, None)])
    assert (boost.unbundled(hist, sizes, groups) == np.moveaxis(alone, 0, -1)).all()


def test_trees_do_not_depend_on_blocks_or_shared_histograms(spark, monkeypatch):
    from plantwatch.session import materialise

    rng = np.random.default_rng(5)
    n = 600
    x = np.stack([rng.integers(0, 2, n), np.round(rng.normal(size=n), 1), rng.integers(0, 2, n), rng.integers(0, 3, n)], axis=1)
    y = ((x[:, 1] > 0) ^ (x[:, 0] * x[:, 3] > 0) ^ (rng.random(n) < 0.1)).astype(int)
    df = spark.createDataFrame([(i, int(a), i % 3, [float(c) for c in r]) for i, (a, r) in enumerate(zip(y, x))],
                               "id int, y int, fold int, x array<double>").repartition(2)
    edges = boost.bin_edges(df.select(*[F.col("x")[j].alias(str(j)) for j in range(4)]), list("0123"), bins=32)
    growths = [boost.Growth(0, 1, 3, 0.3, 5), boost.Growth(0, None, 4, 0.2, 2)]
    counts = {(k, c): int(((np.arange(n) % 3 == k) & (y == c)).sum()) for k in range(3) for c in (0, 1)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    grown = []
    try:
        for rows, sizes in ((1, None), (120, [[len(c) + 1 for c in edges]])):
            monkeypatch.setattr(boost, "BLOCK_ROWS", rows)
            blocks = materialise(boost.pack(df, "y", "fold", ["x"], [edges], ["id"]), "blocks")
            held = [len(r["label"]) for r in blocks.select("label").collect()]
            assert sum(held) == n and (len(held) > 4) == (rows == 1)
            ensemble = boost.Ensemble(growths, [4], 4, boost.start_margins(counts, growths), sizes=sizes)
            boost.grow_all(blocks, ensemble, 4)
            grown.append(ensemble)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(grown[1].bundles[0]) < 4
    for a, b in zip(grown[0].trees, grown[1].trees):
        assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and np.allclose(a.value, b.value)


def test_few_rows_grow_the_same_trees_in_one_job(spark):
    from plantwatch.session import materialise

    rng = np.random.default_rng(7)
    n = 900
    x = np.stack([rng.integers(0, 2, n), np.round(rng.normal(size=n), 1), np.round(rng.normal(size=n), 1)], axis=1)
    y = ((x[:, 1] > 0) ^ (x[:, 0] * x[:, 2] > 0) ^ (rng.random(n) < 0.1)).astype(int)
    df = spark.createDataFrame([(i, int(a), i % 2, [float(c) for c in r]) for i, (a, r) in enumerate(zip(y, x))],
                               "id int, y int, fold int, x array<double>").repartition(3)
    edges = boost.bin_edges(df.select(*[F.col("x")[j].alias(str(j)) for j in range(3)]), list("012"), bins=8)
    growths = [boost.Growth(0, without, depth, 0.3, least) for without in (0, 1, None) for depth in (2, 4) for least in (2, 40, 3)]
    counts = {(k, c): int(((np.arange(n) % 2 == k) & (y == c)).sum()) for k in range(2) for c in (0, 1)}
    sizes = [[len(c) + 1 for c in edges]]
    blocks = materialise(boost.pack(df, "y", "fold", ["x"], [edges], ["id"]), "blocks")
    grown = []
    for grow in (boost.grow_all, boost.grow_held):
        ensemble = boost.Ensemble(growths, [3], 5, boost.start_margins(counts, growths), 8, sizes)
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(grow.__name__, grow.__name__)
        kept = grow(blocks, ensemble, 5, (2, 5))
        grown.append((ensemble, {
            (t, r.model, r["keys"].id): r.score for t in kept for r in boost.held_out_scores(kept[t], ensemble, t).collect()
        }, len(jobs.getJobIdsForGroup(grow.__name__))))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    (one, scores, many), (other, same, few) = grown
    assert few < 10 < many  # no job per level
    for a, b in zip(one.trees, other.trees):
        assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and np.allclose(a.value, b.value)
    assert all(np.allclose(a, b) for a, b in zip(one.gains, other.gains))
    assert scores.keys() == same.keys() and np.allclose([scores[k] for k in scores], [same[k] for k in scores])


def test_histograms_are_added_up_from_a_byte_a_group_in_parts_of_the_rows(monkeypatch):
    rng = np.random.default_rng(4)
    sizes, bins, n, nodes = [32, 2, 5, 3], 32, 1000, 3
    columns = np.stack([rng.integers(0, k, n) for k in sizes]).astype(np.uint8)
    cells = boost.joint(columns, sizes, boost.bundles(sizes, bins))
    assert cells.itemsize == 1
    local, weights = rng.integers(0, nodes, n), rng.normal(size=(2, n))
    whole = boost._added(cells, local, *weights, nodes, bins)
    monkeypatch.setattr(boost, "ADDED_ROWS", 64)
    assert np.allclose(boost._added(cells, local, *weights, nodes, bins), whole, atol=1e-12)
    for k, own in enumerate((*weights, None)):
        for j, column in enumerate(cells):
            assert np.allclose(whole[k, :, j].ravel(), np.bincount(local * bins + column, own, nodes * bins))


def test_the_learning_table_is_derived_once_to_train_and_to_score(spark, small, monkeypatch):
    trained, scored = [], []
    monkeypatch.setattr(catalog, "_trained", lambda stored: trained.append(stored.frame) or (learn.Trained(None, None, "", None, {}, {}), ""))
    monkeypatch.setattr(catalog, "score", lambda model, rows: scored.append(rows) or rows.selectExpr(
        "*", "0.5 will_fail_probability", "1 will_fail_prediction"))
    monkeypatch.setattr(ScoredTable, "append", lambda self, rows, path: scored.append(rows) or 0)
    monkeypatch.setattr(ScoredTable, "read", lambda self: scored[-1])
    made, asked = catalog._ml_table, []
    monkeypatch.setattr(catalog, "_ml_table", lambda e: asked.append(e) or made(e))
    for name in ("gbt_predictions", "gbt_predictions_check", "gbt_score_new"):
        asked.clear()
        catalog.queries()[name](spark, small)
        assert len(asked) == 1
    assert len(trained) == 3 and len(scored) == 6
    # What is scored is read from the stored table, not from the given ones once more.
    assert not [f for rows in scored for f in rows.inputFiles() if small in f]


def test_rows_beyond_what_a_task_holds_are_shared(rows, monkeypatch):
    asked = []
    for name in ("grow_all", "grow_held"):
        monkeypatch.setattr(boost, name, lambda *args, name=name, own=getattr(boost, name): asked.append(name) or own(*args))
    n = rows.count()
    for held in (n, n - 1):
        monkeypatch.setattr(boost, "HELD_ROWS", held)
        learn.fit_candidates(rows, [learn.BoostParams(trees=1, depth=1)], folds=0)
    assert asked == ["grow_held", "grow_all"]
