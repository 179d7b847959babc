"""Training, comparing and keeping classifiers with spark.ml."""

from __future__ import annotations

import datetime as dt
import math
import random
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from odolytics.operators import evaluation, oversample, prepare
from odolytics.operators.boosting import BoostedModel, train_boosted
from odolytics.operators.scoring import LinearModel, decide
from odolytics.session import cut_lineage, shared_folder

DEEPEST = 30    # the deepest tree spark.ml grows

# Search spaces (fixed values).
L1_L2_C = [0.001, 0.005, 0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 3.0, 5.0, 10.0, 20.0, 50.0]
ELASTIC_C = [0.001, 0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0]
ELASTIC_MIX = [0.1, 0.3, 0.5, 0.7, 0.9]
FOREST_SPACE = {
    "numTrees": [100, 200, 300, 500],
    "maxDepth": [5, 10, 15, 20, 30],
    "minInstancesPerNode": [1, 2, 4, 8],
    "featureSubsetStrategy": ["sqrt", "log2", "0.5", "0.7"],
}
LOGISTIC_SPACE = {
    "c": [0.001, 0.005, 0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 3.0, 5.0, 10.0, 20.0, 50.0, 100.0],
    "l1_ratio": [0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0],
    "balanced": [False, True],
}
# Settings of second-order boosting (see ``boosting.Settings``), by depth and by leaves; no depth is any depth.
SAMPLED_BOOSTING_SPACE = {
    "rounds": [100, 200, 300, 500],
    "depth": [3, 5, 7, 10, 15],
    "rate": [0.01, 0.05, 0.1, 0.2, 0.3],
    "rows": [0.6, 0.7, 0.8, 0.9, 1.0],
    "columns": [0.6, 0.7, 0.8, 0.9, 1.0],
    "least_weight": [1, 3, 5, 7],
    "least_gain": [0, 0.1, 0.2, 0.3],
    "balanced": [False, True],
}
LEAF_BOOSTING_SPACE = {
    "rounds": [100, 200, 300, 500],
    "depth": [3, 5, 7, 10, 15, None],
    "rate": [0.01, 0.05, 0.1, 0.2, 0.3],
    "leaves": [15, 31, 50, 70, 100],
    "rows": [0.6, 0.7, 0.8, 0.9, 1.0],
    "columns": [0.6, 0.7, 0.8, 0.9, 1.0],
    "least_rows": [5, 10, 20, 30],
    "l1": [0, 0.01, 0.1, 1],
    "l2": [0, 0.01, 0.1, 1],
    "balanced": [False, True],
}
BOOSTING_SPACE = {
    "maxIter": [100, 200, 300, 500],
    "maxDepth": [3, 5, 7, 10, 15],
    "stepSize": [0.01, 0.05, 0.1, 0.2, 0.3],
    "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9", "all"],
    "minInstancesPerNode": [1, 3, 5, 7],
    "minInfoGain": [0.0, 0.1, 0.2, 0.3],
}
LEAF_BOOSTING_SPACE = {
    "maxIter": [100, 200, 300, 500],
    "maxDepth": [3, 5, 7, 10, 15, DEEPEST],
    "stepSize": [0.01, 0.05, 0.1, 0.2, 0.3],
    "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9", "all"],
    "minInstancesPerNode": [5, 10, 20, 30],
}
BOOSTING_SPACE = {
    "maxIter": [100, 200, 300, 500],
    "maxDepth": [3, 5, 7, 10],
    "stepSize": [0.01, 0.05, 0.1, 0.2, 0.3],
    "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "minInstancesPerNode": [1, 2, 4, 8],
    "featureSubsetStrategy": ["sqrt", "log2", "0.5", "0.7"],
}


def _vector(features: Sequence[str]) -> list:
    """Missing values read as 0, then one vector column."""
    filled = ", ".join(f"coalesce(CAST(`{f}` AS DOUBLE), 0D) AS `__{f}`" for f in features)
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__{f}" for f in features], outputCol="features"),
    ]


def _scaled_vector(features: Sequence[str], scaler: Mapping[str, tuple[float, float]]) -> list:
    scaled = ", ".join(
        f"(coalesce(CAST(`{f}` AS DOUBLE), 0D) - ({scaler[f][0]!r}D)) / ({scaler[f][1]!r}D) AS `__{f}`" for f in features
    )
    return [
        SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__{f}" for f in features], outputCol="features"),
    ]


@dataclass
class SafetyModel:
    """A fitted pipeline together with what scoring needs: features, scaler, threshold."""

    pipeline: PipelineModel
    features: list[str]
    threshold: float = 0.5
    scaler: dict[str, tuple[float, float]] | None = None

    @property
    def classifier(self):
        return self.pipeline.stages[-1]

    def probability(self, df: DataFrame) -> DataFrame:
        """Add ``probability_dangerous``."""
        made = [f"__{f}" for f in self.features] + ["features", "rawPrediction", "probability", "prediction"]
        return self.pipeline.transform(df.drop("prediction")).withColumn(
            "probability_dangerous", vector_to_array("probability")[1]
        ).drop(*made)

    def score(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        return decide(self.probability(df), self.threshold if threshold is None else threshold)

    def linear(self) -> LinearModel:
        """A logistic model as a plain expression: no vectors, all in generated code."""
        weights = self.classifier.coefficients.toArray().tolist()
        return LinearModel(
            dict(zip(self.features, weights)), float(self.classifier.intercept), dict(self.scaler or {}), self.threshold
        )

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        rows = [(i, f, *(self.scaler or {}).get(f, (None, None)), self.threshold) for i, f in enumerate(self.features)]
        spark.createDataFrame(
            rows, "position int, feature string, mean double, deviation double, threshold double"
        ).coalesce(1).write.mode("overwrite").json(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SafetyModel:
        schema = "position int, feature string, mean double, deviation double, threshold double"
        rows = spark.read.schema(schema).json(f"{path}/features").orderBy("position").collect()   # one per feature
        scaler = {r["feature"]: (r["mean"], r["deviation"]) for r in rows if r["deviation"] is not None}
        return cls(PipelineModel.load(f"{path}/pipeline"), [r["feature"] for r in rows], rows[0]["threshold"], scaler or None)


def train_logistic(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    c: float = 1.0,
    l1_ratio: float = 0.0,
    weight: str | None = None,
    max_iter: int = 1000,
    scaler: dict[str, tuple[float, float]] | None = None,
) -> SafetyModel:
    """Penalised logistic regression on z-scores.

    ``c`` weighs the summed loss against the penalty, so over the mean loss the penalty is 1 / (c * n). A
    ``scaler`` fitted on other rows (those before resampling) is used as it is.
    """
    features = list(features)
    filled = train.na.fill(0, features)
    size = train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    scaler = scaler or prepare.scaling(filled, features)
    stage = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, regParam=1.0 / (c * float(size)),
        elasticNetParam=l1_ratio, standardization=False,
    )
    if weight:
        stage = stage.setWeightCol(weight)
    model = Pipeline(stages=[*_scaled_vector(features, scaler), stage]).fit(train)
    return SafetyModel(model, features, 0.5, scaler)


def train_random_forest(
    train: DataFrame, features: Sequence[str], label: str = "label", trees: int = 200, depth: int = DEEPEST,
    weight: str | None = None, seed: int = prepare.SEED, **settings,
) -> SafetyModel:
    stage = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=min(depth, DEEPEST), seed=seed, **settings
    )
    return _fit_trees(train, features, stage, weight)


def train_gradient_boosting(
    train: DataFrame, features: Sequence[str], label: str = "label", rounds: int = 200, depth: int = 8,
    rate: float = 0.05, rows: float = 0.8, columns: str = "all", weight: str | None = None,
    seed: int = prepare.SEED, **settings,
) -> SafetyModel:
    """Boosted trees with row (``rows``) and column (``columns``) subsampling."""
    stage = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=rows, featureSubsetStrategy=columns, seed=seed, **settings,
    )
    return _fit_trees(train, features, stage, weight)


def _fit_trees(train: DataFrame, features: Sequence[str], stage, weight: str | None) -> SafetyModel:
    """Node numbers are cached per row and checkpointed, so deep trees are not walked again from the root
    and a lost executor does not replay every round."""
    shared_folder(train.sparkSession)
    stage = stage.setCacheNodeIds(True).setCheckpointInterval(10)
    if weight:
        stage = stage.setWeightCol(weight)
    return SafetyModel(Pipeline(stages=[*_vector(features), stage]).fit(train), list(features))


Trainer = Callable[..., SafetyModel | BoostedModel]

# Two second-order families: whole levels to a depth, and best leaf first.
BY_DEPTH = {"rounds": 200, "depth": 10, "rate": 0.05, "rows": 0.8, "columns": 0.8}
BY_LEAVES = {**BY_DEPTH, "leaves": 100, "l2": 0.0, "least_rows": 20, "least_weight": 1e-3, "from_average": True}

TRAINERS: dict[str, Trainer] = {
    "Logistic Regression": train_logistic,
    "Random Forest": train_random_forest,
    "Boosting, depth 10, sampled columns": lambda d, f, **k: train_boosted(d, f, **{**BY_DEPTH, **k}),
    "Boosting, 100 leaves, sampled columns": lambda d, f, **k: train_boosted(d, f, **{**BY_LEAVES, **k}),
    "Gradient Boosting": train_gradient_boosting,
}
TECHNIQUES = ["SMOTE", "Class Weights", "Threshold Tuning"]


def side_by_side(spark: SparkSession, jobs: Sequence[Callable], at_once: int) -> list:
    """Results of independent fits in the order given, ``at_once`` of them running, each in a scheduler pool of its own.

    Fits are driver loops over small jobs: while one waits for its driver the others' tasks use the executors. Pools
    share fairly where ``spark.scheduler.mode`` is FAIR. The first error ends the run.
    """

    def run(job: Callable, number: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{number % at_once}")
        return job()

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(run), job, n) for n, job in enumerate(jobs)]
        return [s.result() for s in started]


def experiment_matrix(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    trainers: Mapping[str, Trainer] = TRAINERS,
    settings: Mapping[str, dict] | None = None,
    label: str = "label",
    at_once: int = 4,
) -> DataFrame:
    """Every model family with every imbalance technique: one row of validation metrics per run.

    Each technique's table is written once; the runs over them go side by side.
    """
    spark = train.sparkSession
    train, val = cut_lineage(train), cut_lineage(val)
    smote = cut_lineage(oversample.smote(train, features, label))
    tables = {"SMOTE": (smote, {}), "Class Weights": (cut_lineage(prepare.add_class_weights(train, label)), {"weight": "weight"}), "Threshold Tuning": (train, {})}
    # The logistic model sees z-scores, so its rows are resampled among z-scores, with the scaler of the real rows.
    scaled, scaler = None, None
    if train_logistic in trainers.values():
        scaled = cut_lineage(oversample.smote(train, features, label, scaled=True))
        scaler = prepare.scaling(train.na.fill(0, list(features)), features)

    def run(technique: str, name: str) -> tuple:
        started = time.time()
        data, extra = tables[technique]
        given = {**extra, **(settings or {}).get(name, {})}
        if trainers[name] is train_logistic and technique == "SMOTE":
            data, given["scaler"] = scaled, scaler
        model = trainers[name](data, features, label=label, **given)
        seconds = time.time() - started
        scored = cut_lineage(model.probability(val).select(label, "probability_dangerous"))
        threshold = 0.5
        if technique == "Threshold Tuning":
            sweep = evaluation.threshold_sweep(scored, evaluation.MODEL_GRID, label, "probability_dangerous")
            picked = evaluation.threshold_select(sweep).where("policy = 'accuracy_with_recall_60'").first()
            threshold = picked["threshold"]
        m = evaluation.classification_metrics(scored, label, "probability_dangerous", threshold).first()
        return (name, technique, float(threshold), m["accuracy"], m["precision"], m["recall"], m["f1"], m["roc_auc"], seconds)

    wanted = [(technique, name) for technique in TECHNIQUES for name in trainers]
    # Families are listed from the quickest on; the longest fits start first, so that none is left to the end.
    place = {name: n for n, name in enumerate(trainers)}
    started = sorted(wanted, key=lambda w: -place[w[1]])
    found = dict(zip(started, side_by_side(spark, [partial(run, *w) for w in started], at_once)))
    rows = [found[w] for w in wanted]
    return spark.createDataFrame(
        rows,
        "model string, technique string, threshold double, accuracy double, precision double, recall double, "
        "f1 double, roc_auc double, training_seconds double",
    )


class BalancedF1(Evaluator):
    """Cross-validation score: F1 with a light penalty for low recall."""

    def __init__(self, label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        cells = evaluation.rates(evaluation.confusion(dataset, self.label, self.prediction))
        return float(cells.select(evaluation.balanced_f1(F.col("f1"), F.col("recall"))).first()[0])

    def isLargerBetter(self) -> bool:
        return True


def _cross_validate(data: DataFrame, stage, maps, evaluator, folds: int, label: str, parallelism: int, key: str):
    folded = cut_lineage(prepare.stratified_folds(data, folds, key, label))
    search = CrossValidator(
        estimator=stage, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol="fold",
        parallelism=parallelism,
    )
    return search.fit(folded)


def _results(spark: SparkSession, maps, scores) -> DataFrame:
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name)), float(s))
        for i, (m, s) in enumerate(zip(maps, scores))
    ]
    return spark.createDataFrame(rows, "config int, settings string, score double")


def grid_search(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    key: str = "bookingID",
    c_values: Sequence[float] = tuple(L1_L2_C),
    elastic_c: Sequence[float] = tuple(ELASTIC_C),
    mixes: Sequence[float] = tuple(ELASTIC_MIX),
    folds: int = 3,
    parallelism: int = 4,
    max_iter: int = 1000,
) -> DataFrame:
    """Stratified cross-validation over penalty strength and mix; one row per configuration.

    Solvers that reach the same optimum are one configuration here.
    """
    data = Pipeline(stages=_scaled_vector(features, prepare.scaling(train.na.fill(0, list(features)), features))).fit(train).transform(train)
    n = train.count() * (folds - 1) / folds
    stage = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, standardization=False)
    wanted = [(c, mix) for mix in (1.0, 0.0) for c in c_values] + [(c, mix) for c in elastic_c for mix in mixes]
    maps = [{stage.regParam: 1.0 / (c * n), stage.elasticNetParam: mix} for c, mix in wanted]
    fitted = _cross_validate(data.select(key, label, "features"), stage, maps, BalancedF1(label), folds, label, parallelism, key)
    rows = [(i, c, mix, float(s)) for i, ((c, mix), s) in enumerate(zip(wanted, fitted.avgMetrics))]
    return train.sparkSession.createDataFrame(rows, "config int, c double, l1_ratio double, score double")


def random_search(
    train: DataFrame,
    features: Sequence[str],
    family: str = "forest",
    n_configs: int = 100,
    label: str = "label",
    key: str = "bookingID",
    space: Mapping[str, Sequence] | None = None,
    folds: int = 3,
    parallelism: int = 4,
    seed: int = prepare.SEED,
) -> DataFrame:
    """Cross-validated accuracy of configurations drawn without repetition from a search space."""
    if family == "logistic":
        return _random_logistic(train, features, n_configs, label, key, space or LOGISTIC_SPACE, folds, parallelism, seed)
    boosted = {"boosting, sampled columns": (BY_DEPTH, SAMPLED_BOOSTING_SPACE), "boosting, by leaves": (BY_LEAVES, LEAF_BOOSTING_SPACE)}
    if family in boosted:
        given, default = boosted[family]
        return _random_boosted(train, features, given, n_configs, label, key, space or default, folds, parallelism, seed)
    makers = {"forest": (RandomForestClassifier, FOREST_SPACE), "boosting": (GBTClassifier, BOOSTING_SPACE)}
    maker, default = makers[family]
    stage = maker(featuresCol="features", labelCol=label, seed=seed)
    options = dict(space or default)
    maps = [{stage.getParam(n): v for n, v in zip(options, values)} for values in _draw(options, n_configs, seed)]
    data = Pipeline(stages=_vector(features)).fit(train).transform(train).select(key, label, "features")
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")
    fitted = _cross_validate(data, stage, maps, evaluator, folds, label, parallelism, key)
    return _results(train.sparkSession, maps, fitted.avgMetrics)


def _draw(options: Mapping[str, Sequence], n_configs: int, seed: int) -> list[tuple]:
    """Configurations drawn without repetition, in a fixed order."""
    drawn, chooser = set(), random.Random(seed)
    total = math.prod(len(v) for v in options.values())
    while len(drawn) < min(n_configs, total):
        drawn.add(tuple(chooser.choice(list(v)) for v in options.values()))
    return sorted(drawn, key=str)


def _random_logistic(train, features, n_configs, label, key, space, folds, parallelism, seed) -> DataFrame:
    """Penalty strength, mix and class weights; weighted and plain runs are two searches over the same folds."""
    scaler = prepare.scaling(train.na.fill(0, list(features)), features)
    weighted = prepare.add_class_weights(train, label)
    data = Pipeline(stages=_scaled_vector(features, scaler)).fit(weighted).transform(weighted)
    data = cut_lineage(data.select(key, label, "features", "weight"))
    n = data.count() * (folds - 1) / folds
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")
    drawn = _draw(space, n_configs, seed)
    scores: dict[tuple, float] = {}
    for balanced in (False, True):
        chosen = [d for d in drawn if bool(dict(zip(space, d)).get("balanced", False)) == balanced]
        if not chosen:
            continue
        stage = LogisticRegression(featuresCol="features", labelCol=label, maxIter=2000, standardization=False)
        stage = stage.setWeightCol("weight") if balanced else stage
        maps = [
            {stage.regParam: 1.0 / (dict(zip(space, d))["c"] * n), stage.elasticNetParam: dict(zip(space, d))["l1_ratio"]} for d in chosen
        ]
        fitted = _cross_validate(data, stage, maps, evaluator, folds, label, parallelism, key)
        scores |= dict(zip(chosen, fitted.avgMetrics))
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in sorted(zip(space, d))), float(scores[d])) for i, d in enumerate(drawn)
    ]
    return train.sparkSession.createDataFrame(rows, "config int, settings string, score double")


def _random_boosted(train, features, given, n_configs, label, key, space, folds, parallelism, seed) -> DataFrame:
    """Second-order boosting: every draw on every fold, side by side; ``balanced`` weighs the classes."""
    spark = train.sparkSession
    folded = cut_lineage(prepare.add_class_weights(prepare.stratified_folds(train.select(key, label, *features), folds, key, label), label))
    drawn = _draw(space, n_configs, seed)

    def accuracy(values: tuple, fold: int) -> float:
        chosen = {**given, **dict(zip(space, values))}
        weight = "weight" if chosen.pop("balanced", False) else None
        model = train_boosted(folded.where(F.col("fold") != fold), features, label, weight, **{**chosen, "seed": seed})
        held = model.probability(folded.where(F.col("fold") == fold))
        return held.agg(F.avg(((F.col("probability_dangerous") >= 0.5).cast("int") == F.col(label)).cast("int"))).first()[0] or 0.0

    scores = side_by_side(spark, [partial(accuracy, values, fold) for values in drawn for fold in range(folds)], parallelism)
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in sorted(zip(space, d))), sum(scores[i * folds : (i + 1) * folds]) / folds) for i, d in enumerate(drawn)
    ]
    return spark.createDataFrame(rows, "config int, settings string, score double")


def coefficient_importance(model: SafetyModel, top: int | None = None) -> DataFrame:
    """Features by absolute coefficient."""
    weights = model.classifier.coefficients.toArray().tolist()
    return _ranked([(f, w, abs(w)) for f, w in zip(model.features, weights)], "coefficient", top)


def tree_importance(model: SafetyModel | BoostedModel, top: int | None = 10) -> DataFrame:
    """Features by their share of impurity taken away, or of gain for second-order boosting."""
    if isinstance(model, BoostedModel):
        weights = list(model.importance().values())
    else:
        weights = model.classifier.featureImportances.toArray().tolist()
    return _ranked([(f, w, w) for f, w in zip(model.features, weights)], "impurity_share", top)


def _ranked(rows, column: str, top: int | None) -> DataFrame:
    spark = SparkSession.getActiveSession()
    table = spark.createDataFrame(rows, f"feature string, {column} double, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return table if top is None else table.limit(top)


def run_rows(spark: SparkSession, run_name: str, params: Mapping, metrics: Mapping, run_id: str | None = None) -> DataFrame:
    """A run as (run_id, run_name, logged_at, kind, key, value) rows."""
    run = run_id or uuid.uuid4().hex
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    rows = [(run, run_name, now, "param", k, str(v)) for k, v in params.items()]
    rows += [(run, run_name, now, "metric", k, repr(float(v))) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "run_id string, run_name string, logged_at string, kind string, key string, value string")


def log_run(spark: SparkSession, path: str, run_name: str, params: Mapping, metrics: Mapping, run_id: str | None = None) -> None:
    run_rows(spark, run_name, params, metrics, run_id).coalesce(1).write.mode("append").parquet(path)
