"""Scoring trips, summarising a scoring run, and the history of runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions.columns import count_true, ratio

PREDICTION_COLUMNS = [
    S.KEY, "prediction", "prediction_label", "probability_safe", "probability_dangerous", "confidence",
]


@dataclass(frozen=True)
class LinearModel:
    """A logistic model written out: z-scored features times weights."""

    weights: Mapping[str, float]
    intercept: float
    scaler: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    threshold: float = 0.5

    def probability(self) -> Column:
        z = F.lit(float(self.intercept))
        for name, weight in self.weights.items():
            mean, deviation = self.scaler.get(name, (0.0, 1.0))
            x = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
            z = z + (x - F.lit(float(mean))) / F.lit(float(deviation)) * F.lit(float(weight))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def decide(df: DataFrame, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    """Turn ``probability_dangerous`` into the six result columns, after those to keep."""
    danger = F.col("probability_dangerous")
    prediction = (danger >= F.lit(threshold)).cast("int")
    safe = F.lit(1.0) - danger
    label = F.when(danger >= F.lit(threshold), F.lit(S.PREDICTION_LABELS[1])).otherwise(F.lit(S.PREDICTION_LABELS[0]))
    return df.select(
        S.KEY, prediction.alias("prediction"), label.alias("prediction_label"), safe.alias("probability_safe"),
        danger, F.when(danger >= F.lit(threshold), danger).otherwise(safe).alias("confidence"), *keep,
    )


def require_features(df: DataFrame, names) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required features: {', '.join(missing)}")


def score_batch(
    features: DataFrame, model: LinearModel, threshold: float | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Score every trip with plain column expressions; nothing leaves generated code."""
    require_features(features, model.weights)
    return decide(
        features.withColumn("probability_dangerous", model.probability()),
        model.threshold if threshold is None else threshold, keep,
    )


def batch_summary(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Totals, shares and mean confidence per class of a scoring run (0 for an empty class)."""
    dangerous = F.col("prediction") == 1
    wide = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.coalesce(count_true(dangerous), F.lit(0)).cast("long").alias("dangerous_count"),
        F.coalesce(F.avg(F.when(dangerous, F.col("confidence"))), F.lit(0.0)).alias("avg_confidence_dangerous"),
        F.coalesce(F.avg(F.when(~dangerous, F.col("confidence"))), F.lit(0.0)).alias("avg_confidence_safe"),
    )
    pct = F.coalesce(ratio(F.col("dangerous_count"), F.col("total_trips")) * 100, F.lit(0.0))
    return wide.select(
        *by, "total_trips", "dangerous_count",
        (F.col("total_trips") - F.col("dangerous_count")).alias("safe_count"),
        pct.alias("dangerous_pct"), (F.lit(100.0) - pct).alias("safe_pct"),
        "avg_confidence_dangerous", "avg_confidence_safe",
    )


def history_entry(summary: DataFrame, mode: str, source: str) -> DataFrame:
    return summary.select(
        F.lit(mode).alias("mode"), F.element_at(F.split(F.lit(source), "/"), -1).alias("file"),
        F.lit(source).alias("file_path"), "*", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )


def trip_entry(result: DataFrame, mode: str = "single") -> DataFrame:
    """History entries of trips scored one by one."""
    return result.select(
        F.lit(mode).alias("mode"), S.KEY, "prediction", "prediction_label", "confidence",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )


def prediction_history(runs: DataFrame, size: int = S.HISTORY_SIZE, newest: str = "timestamp") -> DataFrame:
    """The last ``size`` runs, newest first."""
    return runs.orderBy(F.desc(newest)).limit(size)
