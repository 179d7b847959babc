"""Oversampling, training, search and persistence."""

import functools

import numpy as np
import pytest
from pyspark.sql import functions as F

from odolytics.operators import models, oversample, prepare, scoring
from odolytics.plans import queries_models

FEATURES = ["a", "b"]


def clouds(spark, n=240, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(i % 4 == 0)
        rows.append((i, float(rng.normal(1.2 * y, 1)), float(rng.normal(-0.7 * y, 2)), y))
    return spark.createDataFrame(rows, "bookingID long, a double, b double, label int")


def neighbours_by_hand(ids, x, k):
    out = {}
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[int(ids[i])] = [int(ids[j]) for j in order]
    return out


@pytest.mark.parametrize("block_rows", [4096, 25])
@pytest.mark.parametrize("copies", [0, 120])
def test_neighbours_are_exact(spark, block_rows, copies):
    """Also when the points are cut into many blocks and a crowd of copies fills one cell."""
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(180, 3)), np.repeat([[0.5, 0.5, 0.5]], copies, axis=0)])
    ids = np.arange(len(x)) * 3
    df = spark.createDataFrame([(int(i), list(map(float, v))) for i, v in zip(ids, x)], "id long, v array<double>")
    found = {r["id"]: r["neighbours"] for r in oversample.nearest_neighbours(df, 5, block_rows).collect()}
    assert found == neighbours_by_hand(ids, x, 5)


def test_popular_blocks_are_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(oversample, "VISITORS_PER_TASK", 10)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 2))
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id long, v array<double>")
    found = {r["id"]: r["neighbours"] for r in oversample.nearest_neighbours(df, 4, 20).collect()}
    assert found == neighbours_by_hand(np.arange(150), x, 4)


def test_a_share_of_a_popular_block_may_have_no_visitor(spark, monkeypatch):
    """As many shares as visitors: hashing leaves some of them without one."""
    monkeypatch.setattr(oversample, "VISITORS_PER_TASK", 1)
    x = np.random.default_rng(7).normal(size=(60, 2))
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id long, v array<double>")
    found = {r["id"]: r["neighbours"] for r in oversample.nearest_neighbours(df, 4, 20).collect()}
    assert found == neighbours_by_hand(np.arange(60), x, 4)


def test_smote_balances_and_interpolates(spark):
    df = clouds(spark)
    out = oversample.smote(df, FEATURES)
    rows = out.collect()
    assert sum(r["label"] for r in rows) * 2 == len(rows) == 360
    made, real = [r for r in rows if r["synthetic"]], {r["bookingID"]: r for r in rows if not r["synthetic"]}
    assert len(made) == 120 and len(real) == 240
    minority = np.array([(r["a"], r["b"]) for r in real.values() if r["label"] == 1])
    ids = np.array([r["bookingID"] for r in real.values() if r["label"] == 1])
    near = neighbours_by_hand(ids, minority, 5)
    at = dict(zip(map(int, ids), minority))
    for r in made:
        p, start = np.array([r["a"], r["b"]]), at[r["bookingID"]]
        gaps = []
        for other in near[r["bookingID"]]:
            way = at[other] - start
            u = float(np.clip((p - start) @ way / (way @ way), 0, 1))
            gaps.append(np.abs(start + u * way - p).max())
        assert min(gaps) < 1e-9
    again = oversample.smote(df.repartition(6), FEATURES)
    assert out.exceptAll(again).isEmpty()


def test_smote_of_a_single_minority_row(spark):
    df = spark.createDataFrame([(i, float(i), 0.0, int(i == 0)) for i in range(4)], "bookingID long, a double, b double, label int")
    made = oversample.smote(df, FEATURES).where("synthetic").collect()
    assert [(r["a"], r["b"]) for r in made] == [(0.0, 0.0)] * 2


def newton_logistic(x, y, w, c):
    """Minimises penalty/2 * |coef|^2 + c * sum of weighted losses."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x1 @ beta))
        step = np.linalg.solve(c * (x1 * (w * p * (1 - p))[:, None]).T @ x1 + ridge, c * x1.T @ (w * (p - y)) + ridge @ beta)
        beta -= step
    return beta


@pytest.mark.parametrize("weighted", [False, True])
def test_logistic_reaches_the_penalised_optimum(spark, weighted):
    df = clouds(spark)
    if weighted:
        df = prepare.add_class_weights(df)
    model = models.train_logistic(df, FEATURES, c=0.1, weight="weight" if weighted else None)
    rows = df.orderBy("bookingID").collect()
    x = np.array([(r["a"], r["b"]) for r in rows])
    y = np.array([r["label"] for r in rows])
    w = np.array([r["weight"] for r in rows]) if weighted else np.ones(len(y))
    want = newton_logistic((x - x.mean(0)) / x.std(0), y, w, 0.1)
    linear = model.linear()
    assert list(linear.weights.values()) == pytest.approx(want[:2], abs=1e-4)
    assert linear.intercept == pytest.approx(want[2], abs=1e-4)


def test_written_out_model_scores_like_the_pipeline(spark):
    df = clouds(spark)
    model = models.train_logistic(df, FEATURES)
    a = {r["bookingID"]: r for r in model.score(df, 0.3).collect()}
    b = {r["bookingID"]: r for r in scoring.score_batch(df, model.linear(), 0.3).collect()}
    assert set(a) == set(b)
    for k in a:
        assert a[k]["probability_dangerous"] == pytest.approx(b[k]["probability_dangerous"], abs=1e-9)
        assert (a[k]["prediction"], a[k]["prediction_label"]) == (b[k]["prediction"], b[k]["prediction_label"])


def test_model_keeps_threshold_features_and_scaler(spark, tmp_path):
    df = clouds(spark)
    model = models.train_logistic(df, FEATURES)
    model.threshold = 0.23
    model.save(str(tmp_path / "m"))
    back = models.SafetyModel.load(spark, str(tmp_path / "m"))
    assert (back.threshold, back.features, back.scaler) == (0.23, FEATURES, model.scaler)
    assert model.score(df).exceptAll(back.score(df)).isEmpty()


def test_missing_feature_is_an_error(spark):
    with pytest.raises(ValueError, match="missing required features: b"):
        scoring.score_batch(clouds(spark).drop("b"), scoring.LinearModel({"a": 1.0, "b": 1.0}, 0.0))


def test_threshold_is_inclusive_and_empty_class_is_zero(spark):
    df = spark.createDataFrame([(1, 0.0)], "bookingID long, a double")
    r = scoring.score_batch(df, scoring.LinearModel({"a": 1.0}, 0.0, threshold=0.5))
    assert r.first()["prediction_label"] == "DANGEROUS"
    s = scoring.batch_summary(r).first()
    assert (s["total_trips"], s["safe_count"], s["avg_confidence_safe"], s["avg_confidence_dangerous"]) == (1, 0, 0.0, 0.5)


def test_experiment_matrix_runs_every_pair(spark):
    table = prepare.stratified_split(clouds(spark))
    trainers = {n: models.TRAINERS[n] for n in ("Logistic Regression", "Random Forest", "Gradient Boosting")}
    small = {"Random Forest": {"trees": 5, "depth": 3}, "Gradient Boosting": {"rounds": 2, "depth": 2}}
    runs = models.experiment_matrix(
        table.where("split = 'train'"), table.where("split = 'val'"), FEATURES, trainers, small
    ).collect()
    assert {(r["model"], r["technique"]) for r in runs} == {(m, t) for m in trainers for t in models.TECHNIQUES}
    assert all(r["threshold"] == 0.5 for r in runs if r["technique"] != "Threshold Tuning")


def test_the_registered_matrix_runs_the_full_settings(spark, folder, monkeypatch):
    """Every family is trained with its own defaults: no round or tree is left out."""
    seen = {}

    def trainer(name):
        def train(data, features, label, **given):
            seen.setdefault(name, []).append(set(given) - {"weight", "scaler"})
            return models.train_logistic(data, features, label)
        return train

    monkeypatch.setattr(models, "experiment_matrix", functools.partial(models.experiment_matrix, trainers={n: trainer(n) for n in models.TRAINERS}))
    assert queries_models.experiment_matrix(spark, folder).count() == 15
    assert seen == {n: [set()] * 3 for n in models.TRAINERS}


def test_searches_score_every_configuration(spark):
    df = clouds(spark)
    grid = models.grid_search(df, FEATURES, c_values=[0.1, 1.0], elastic_c=[1.0], mixes=[0.5], max_iter=50)
    assert grid.count() == 5 and grid.where("score < 0 OR score > 1").isEmpty()
    found = models.random_search(df, FEATURES, "boosting", 2, space={"maxIter": [1, 2], "maxDepth": [1, 2]})
    assert found.count() == 2
    for family in ("boosting, sampled columns", "boosting, by leaves"):
        found = models.random_search(df, FEATURES, family, 2, space={"rounds": [1, 2], "depth": [2, None], "balanced": [False, True]})
        assert found.count() == 2 and found.where("score < 0.5 OR score > 1").isEmpty()


def test_side_by_side_keeps_order_and_raises(spark):
    assert models.side_by_side(spark, [lambda n=n: spark.range(n).count() for n in range(6)], 3) == list(range(6))
    with pytest.raises(ZeroDivisionError):
        models.side_by_side(spark, [lambda: 1 / 0, lambda: 1], 2)


def test_folds_are_stratified(spark):
    folds = prepare.stratified_folds(clouds(spark), 3).groupBy("label", "fold").count().collect()
    assert {(r["label"], r["count"]) for r in folds} == {(0, 60), (1, 20)}


def test_importance_is_ranked(spark):
    model = models.train_logistic(clouds(spark), FEATURES)
    assert [r["feature"] for r in models.coefficient_importance(model).collect()] == ["a", "b"]
    forest = models.train_random_forest(clouds(spark), FEATURES, trees=5, depth=3)
    assert models.tree_importance(forest).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(2):
        models.log_run(spark, path, f"run {i}", {"c": 1.0}, {"recall": 0.5})
    assert spark.read.parquet(path).groupBy("run_id").count().count() == 2
