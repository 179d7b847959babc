"""Classifier evaluation on scored rows (true class, probability)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics.functions import ordered
from odolytics.functions.columns import broadcast_if_small, count_true, ratio, ratio_or_zero

# Threshold grids, built from whole hundredths so that no step drifts.
COARSE_GRID = [i / 100 for i in range(50, 9, -5)]
MODEL_GRID = [i / 100 for i in range(40, 9, -5)]
FINE_GRID = [i / 100 for i in range(10, 46)]
ACCURACY_GRID = [i / 100 for i in range(20, 60)]

MIN_RECALL, RECALL_PENALTY = 0.65, 0.3
METRICS = ["accuracy", "precision", "recall", "f1"]

def predicted(score: str, threshold: float) -> Column:
    return (F.col(score) >= F.lit(threshold)).cast("int")


def confusion(df: DataFrame, label: str, prediction: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp from one partial aggregate."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    y = F.col(label)
    cells = {"tn": (y == 0) & (p == 0), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0), "tp": (y == 1) & (p == 1)}
    grouped = df.groupBy(*by)
    return grouped.agg(*[F.coalesce(count_true(c), F.lit(0)).cast("long").alias(n) for n, c in cells.items()])


def rates(cells: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1 (0 where undefined) to confusion counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cells.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def balanced_f1(f1: Column, recall: Column) -> Column:
    """F1 less a light penalty for recall under the wanted one, never below 0."""
    short = F.greatest(F.lit(0.0), F.lit(MIN_RECALL) - recall)
    return F.greatest(f1 - F.lit(RECALL_PENALTY) * short, F.lit(0.0))


def _by_score(df: DataFrame, label: str, score: str, by: Sequence[str], rows_per_task: int) -> DataFrame:
    """Counts per distinct score with running totals from the highest score down.

    Equal scores are merged before the shuffle. A few scores are one window; many are cut into ranges,
    so no task orders the whole set.
    """
    y = F.col(label)
    groups = (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
        .withColumn("descending", -F.col("score"))
    )
    running = ordered.whole_order(groups, ["descending"], by, rows_per_task).running(
        sums={"cum_tp": F.col("pos"), "cum_fp": F.col("neg")}
    )
    return running.rows().drop("descending")


def _with_totals(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the number of positives and negatives of the row's set."""
    totals = points.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    if by:
        return points.join(broadcast_if_small(totals), list(by))
    return points.withColumns({c: totals.select(c).scalar() for c in ("all_pos", "all_neg")})


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "p", by: Sequence[str] = (), rows_per_task: int = ordered.HOT_ROWS
) -> DataFrame:
    """(threshold, fpr, tpr) at each distinct score, plus the starting point (0, 0) with no threshold."""
    points = _by_score(df, label, score, by, rows_per_task)
    curve = _with_totals(points, by).select(
        *by, F.col("score").alias("threshold"),
        ratio(F.col("cum_fp"), F.col("all_neg")).alias("fpr"), ratio(F.col("cum_tp"), F.col("all_pos")).alias("tpr"),
    )
    return curve.unionByName(_end_point(points, by, {"fpr": 0.0, "tpr": 0.0}))


def _end_point(points: DataFrame, by: Sequence[str], values: dict[str, float]) -> DataFrame:
    """One row per set, without a threshold."""
    sets = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    return sets.select(
        *by, F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(n) for n, v in values.items()]
    )


def _area_under_roc():
    """Ties count half: each negative beats the positives above it and half of those beside it."""
    area = F.sum(F.col("neg") * (F.col("cum_tp") - F.col("pos") / 2.0))
    return ratio(area, F.sum("pos").cast("double") * F.sum("neg"))


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "p", by: Sequence[str] = (), rows_per_task: int = ordered.HOT_ROWS
) -> DataFrame:
    """Area under the ROC curve."""
    points = _by_score(df, label, score, by, rows_per_task)
    return points.groupBy(*by).agg(_area_under_roc().alias("roc_auc"))


def _precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def pr_curve(
    df: DataFrame, label: str = "label", score: str = "p", by: Sequence[str] = (), rows_per_task: int = ordered.HOT_ROWS
) -> DataFrame:
    """(threshold, precision, recall) at each distinct score, plus (precision 1, recall 0)."""
    points = _by_score(df, label, score, by, rows_per_task)
    curve = _with_totals(points, by).select(
        *by, F.col("score").alias("threshold"),
        _precision(F.col("cum_tp"), F.col("cum_fp")).alias("precision"),
        ratio(F.col("cum_tp"), F.col("all_pos")).alias("recall"),
    )
    return curve.unionByName(_end_point(points, by, {"precision": 1.0, "recall": 0.0}))


def pr_auc(
    df: DataFrame, label: str = "label", score: str = "p", by: Sequence[str] = (), rows_per_task: int = ordered.HOT_ROWS
) -> DataFrame:
    """Area under the precision-recall points by the trapezoid rule."""
    points = _by_score(df, label, score, by, rows_per_task)
    here = _precision(F.col("cum_tp"), F.col("cum_fp"))
    before = _precision(F.col("cum_tp") - F.col("pos"), F.col("cum_fp") - F.col("neg"))
    slab = F.sum(F.col("pos") * (here + F.coalesce(before, F.lit(1.0))) / 2.0)
    return points.groupBy(*by).agg(ratio(slab, F.sum("pos")).alias("pr_auc"))


def classification_metrics(
    df: DataFrame, label: str = "label", score: str = "p", threshold: float = 0.5, by: Sequence[str] = (),
    rows_per_task: int = ordered.HOT_ROWS,
) -> DataFrame:
    """Accuracy, precision, recall, F1 and ROC-AUC, per split if asked, all from the counts per score."""
    points = _by_score(df, label, score, by, rows_per_task)
    hit = F.col("score") >= F.lit(threshold)

    def cell(column: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(column))), F.lit(0)).cast("long")

    cells = points.groupBy(*by).agg(
        cell("neg", ~hit).alias("tn"), cell("neg", hit).alias("fp"),
        cell("pos", ~hit).alias("fn"), cell("pos", hit).alias("tp"), _area_under_roc().alias("roc_auc"),
    )
    return rates(cells)


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "p"
) -> DataFrame:
    """Metrics with "positive" meaning score >= t, for every t, from one scan.

    Each row is counted once, under the number of thresholds it reaches; running totals over those few
    counts then give every threshold's table.
    """
    grid = sorted(set(thresholds))
    reached = Bucketizer(splits=[-math.inf, *grid, math.inf], inputCol="score", outputCol="reached")    # binary search
    y = F.col(label)
    counts = (
        reached.transform(df.where(F.col(score).isNotNull()).select(F.col(score).alias("score"), F.col(label).alias(label)))
        .groupBy(F.col("reached").cast("int").alias("reached"))
        .agg(count_true(y == 1).alias("pos"), count_true(y == 0).alias("neg"))
    )
    levels = df.sparkSession.createDataFrame(
        [(i + 1, t) for i, t in enumerate(grid)] + [(0, None)], "reached int, threshold double"
    )
    table = levels.join(counts, "reached", "left").na.fill(0, ["pos", "neg"])
    down = Window.partitionBy(F.lit(1)).orderBy(F.desc("reached"))      # one row per threshold
    every = Window.partitionBy(F.lit(1))
    cells = table.select(
        "threshold",
        F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(every).alias("all_pos"), F.sum("neg").over(every).alias("all_neg"),
    ).where(F.col("threshold").isNotNull())
    full = cells.select(
        "threshold",
        (F.col("all_neg") - F.col("fp")).alias("tn"), "fp", (F.col("all_pos") - F.col("tp")).alias("fn"), "tp",
    )
    return rates(full)


# policy -> (rows allowed, metric to maximise, which threshold wins a tie)
POLICIES = {
    "accuracy_with_recall_60": (lambda: F.col("recall") >= 0.60, "accuracy", "high"),
    "best_f1": (lambda: F.lit(True), "f1", "low"),
    "f1_with_recall_70": (lambda: F.col("recall") >= 0.70, "f1", "low"),
    "recall_with_precision_40": (lambda: F.col("precision") >= 0.40, "recall", "low"),
    "best_accuracy": (lambda: F.lit(True), "accuracy", "low"),
}


# The thresholds each policy is meant to choose from.
POLICY_GRIDS = {
    "accuracy_with_recall_60": COARSE_GRID,
    "best_f1": FINE_GRID,
    "f1_with_recall_70": FINE_GRID,
    "recall_with_precision_40": FINE_GRID,
    "best_accuracy": ACCURACY_GRID,
}


def every_grid(grids: Mapping[str, Sequence[float]] = POLICY_GRIDS) -> list[float]:
    """All thresholds that some policy looks at, for one sweep."""
    return sorted({t for grid in grids.values() for t in grid})


def threshold_select(sweep: DataFrame, grids: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """The threshold each policy picks; the first policy falls back to the highest recall.

    With ``grids`` a policy looks at the thresholds of its own grid only, otherwise at the whole sweep.
    """
    row = F.struct("threshold", *METRICS)

    def best(name: str, allowed: Column, metric: str, tie: str) -> Column:
        t = F.col("threshold") if tie == "high" else -F.col("threshold")
        own = F.lit(True) if grids is None else F.col("threshold").isin([float(x) for x in grids[name]])
        return F.max_by(row, F.when(own & allowed, F.struct(F.col(metric), t.alias("t"))))

    picks = {name: best(name, allowed(), metric, tie) for name, (allowed, metric, tie) in POLICIES.items()}
    first = "accuracy_with_recall_60"
    picks[first] = F.coalesce(picks[first], best(first, F.lit(True), "recall", "high"))
    wide = sweep.agg(*[c.alias(n) for n, c in picks.items()])
    structs = [F.struct(F.lit(n).alias("policy"), F.col(n).alias("pick")) for n in picks]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.policy", "s.pick.*")


def overfit_gap(metrics: DataFrame, split: str = "split", train: str = "train", val: str = "val") -> DataFrame:
    wide = metrics.agg(
        F.max(F.when(F.col(split) == train, F.col("accuracy"))).alias("train_accuracy"),
        F.max(F.when(F.col(split) == val, F.col("accuracy"))).alias("val_accuracy"),
    )
    gap = F.col("train_accuracy") - F.col("val_accuracy")
    verdict = F.when(gap < 0.02, F.lit("good")).when(gap < 0.05, F.lit("slight")).otherwise(F.lit("significant"))
    return wide.select("train_accuracy", "val_accuracy", gap.alias("accuracy_gap"), verdict.alias("verdict"))


def model_comparison(first: DataFrame, second: DataFrame, names: Sequence[str] = (*METRICS, "roc_auc")) -> DataFrame:
    """Two one-row metric tables side by side."""

    def tall(df: DataFrame, name: str) -> DataFrame:
        return df.select(*names).unpivot([], list(names), "metric", name)

    both = tall(first, "first_run").join(tall(second, "second_run"), "metric")
    diff = F.col("second_run") - F.col("first_run")
    return both.select("metric", "first_run", "second_run", diff.alias("difference"), (ratio(diff, F.col("first_run")) * 100).alias("pct_change"))


def adoption_decision(comparison: DataFrame, first_seconds: float, second_seconds: float) -> DataFrame:
    """Adopt the second run for clearly better recall or a fifth less time, unless F1 drops clearly."""

    def change(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("difference")))

    saved = (first_seconds - second_seconds) / first_seconds * 100
    wide = comparison.agg(change("recall").alias("recall_change"), change("f1").alias("f1_change"))
    better = (F.col("recall_change") > 0.02) | F.lit(saved > 20)
    return wide.select(
        "recall_change", "f1_change", F.lit(float(saved)).alias("time_saved_pct"),
        (better & (F.col("f1_change") >= -0.05)).alias("adopt"),
    )


def cost_benefit(cells: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        tp.alias("caught"), fn.alias("missed"), fp.alias("false_alarms"),
        (ratio(tp, tp + fn) * 100).alias("caught_pct"),
        (ratio(fp, fp + tn) * 100).alias("false_alarm_pct"),
        ratio(fp, tp).alias("alarms_per_catch"),
    )


def leaderboard(runs: DataFrame, metric: str, k: int, ties: Sequence[str]) -> DataFrame:
    return runs.orderBy(F.desc(metric), *ties).limit(k)


def best_per_group(runs: DataFrame, group: str, pick: str, metric: str) -> DataFrame:
    """The run with the highest metric in each group; the smaller name wins a tie."""
    best = F.min_by(F.struct(pick, metric), F.struct(-F.col(metric), F.col(pick)))
    return runs.groupBy(group).agg(best.alias("best")).select(group, "best.*")
