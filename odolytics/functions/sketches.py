"""Quantiles of growing data from mergeable sketches, one per load, so that no load is read twice.

``add_load`` leaves one row per load: the number of rows and a KLL sketch per column, a few dozen kilobytes whatever the
load holds. Quantiles, outlier limits and quartile fences over any set of loads come from merging those rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odolytics.functions.columns import nan_to_null

K = 4096


def rank_error(k: int = K) -> float:
    """How far the rank of an estimated quantile may be off, as a share of all rows: 99 of 100 sketches keep to it."""
    return 2.296 / k ** 0.9021


def sketched(df: DataFrame, columns: Mapping[str, Column], k: int = K) -> DataFrame:
    """One row: ``n_rows`` and a sketch per column (NULL where the column has no value). NULL and NaN are left out."""
    values = {c: nan_to_null(v.cast("double")) for c, v in columns.items()}
    return df.select(*[v.alias(c) for c, v in values.items()]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.when(F.count(c) > 0, F.kll_sketch_agg_double(c, F.lit(k))).alias(c) for c in values],
    )


def add_load(df: DataFrame, columns: Mapping[str, Column], path: str, load: str, k: int = K) -> None:
    """Sketch a load and keep it under its name; a load that is repeated replaces its own row."""
    sketched(df, columns, k).coalesce(1).write.mode("overwrite").parquet(f"{path}/load={load}")


def merged(spark: SparkSession, path: str, columns: Sequence[str], loads: Sequence[str] | None = None) -> DataFrame:
    """``feature, sketch`` over the loads named (all: None); one row per column that has a value."""
    schema = "n_rows long, " + ", ".join(f"`{c}` binary" for c in columns) + ", load string"
    rows = spark.read.schema(schema).parquet(path)
    rows = rows if loads is None else rows.where(F.col("load").isin(list(loads)))
    wide = rows.agg(*[F.when(F.count(c) > 0, F.kll_merge_agg_double(c)).alias(c) for c in columns])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("sketch")) for c in columns])).alias("s"))
    return long.select("s.*").where("sketch IS NOT NULL")


def estimated(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``feature, probability, value`` of merged sketches."""
    each = [F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probabilities]
    return sketches.select("feature", F.explode(F.array(*each)).alias("s")).select("feature", "s.*")


def limits(sketches: DataFrame, q: float = 0.999) -> DataFrame:
    """Outlier limits from sketches of absolute values, as ``cleaning.derive_limits`` finds them by scanning all rows."""
    return estimated(sketches, [q]).select("feature", F.col("value").alias("limit_value"))


def fences(sketches: DataFrame, reach: float = 1.5) -> DataFrame:
    """``feature, q1, q3, lower_bound, upper_bound`` by quartiles."""
    wide = estimated(sketches, [0.25, 0.75]).groupBy("feature").agg(
        F.max(F.when(F.col("probability") == 0.25, F.col("value"))).alias("q1"), F.max(F.when(F.col("probability") == 0.75, F.col("value"))).alias("q3")
    )
    gap = F.lit(reach) * (F.col("q3") - F.col("q1"))
    return wide.select("feature", "q1", "q3", (F.col("q1") - gap).alias("lower_bound"), (F.col("q3") + gap).alias("upper_bound"))


def rank_bounds(df: DataFrame, estimates: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``estimates`` with the true share of rows below (``below``) and not above (``upto``) each value, in one scan."""
    asked = estimates.select("feature", "probability", "value").collect()      # features x probabilities
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    counts = []
    for i, r in enumerate(asked):
        c = F.col(r["feature"])
        n = F.nullif(F.count(c).cast("double"), F.lit(0.0))
        counts.append(F.struct(
            F.lit(r["feature"]).alias("feature"), F.lit(r["probability"]).alias("probability"), F.lit(r["value"]).alias("value"),
            (F.count_if(c < F.lit(r["value"])) / n).alias("below"), (F.count_if(c <= F.lit(r["value"])) / n).alias("upto"),
        ))
    return values.agg(F.array(*counts).alias("all")).select(F.explode("all").alias("s")).select("s.*")
