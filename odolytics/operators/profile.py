"""Column profiles: one scan per table, never one per column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics.functions.columns import broadcast_if_small, count_true, ratio, rows_from_structs
from odolytics.functions.counts import bin_counts
from odolytics.functions.quantiles import quantile_values
from odolytics.session import cut_lineage

IMBALANCED_OVER = 3.0
STRONG_CORRELATION, SOME_CORRELATION = 0.15, 0.10
HIGH_CORRELATION = 0.8
SCALE_RATIO = 100.0


def class_balance(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Rows and share per class, and the safe : dangerous ratio."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n_rows"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))   # one row per class
    safe = F.sum(F.when(F.col(label) == 0, F.col("n_rows"))).over(group)
    dangerous = F.sum(F.when(F.col(label) == 1, F.col("n_rows"))).over(group)
    return counts.select(
        *by,
        F.col(label).alias("label"),
        "n_rows",
        (ratio(F.col("n_rows"), F.sum("n_rows").over(group)) * 100).alias("pct"),
        ratio(safe, dangerous).alias("safe_to_dangerous"),
        (ratio(safe, dangerous) > F.lit(IMBALANCED_OVER)).alias("imbalanced"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    names = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("n"), *[count_true(F.col(c).isNull()).alias(f"m_{c}") for c in names]
    )
    rows = rows_from_structs(
        wide,
        {
            c: {
                "missing_count": F.coalesce(F.col(f"m_{c}"), F.lit(0)).cast("long"),
                "missing_pct": ratio(F.col(f"m_{c}"), F.col("n")) * 100,
            }
            for c in names
        },
    )
    return rows.orderBy(F.desc("missing_count"), "feature")


def describe(df: DataFrame, columns: Sequence[str], places: int = 3) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    q = quantile_values(df, columns, [0.25, 0.5, 0.75])
    wide = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )

    def rounded(c: Column) -> Column:
        return F.round(c, places)

    return rows_from_structs(
        wide,
        {
            c: {
                "n": F.col(c)["n"],
                "mean": rounded(F.col(c)["mean"]),
                "std": rounded(F.col(c)["std"]),
                "min": rounded(F.col(c)["min"]),
                "p25": rounded(F.lit(q[c, 0.25]).cast("double")),
                "p50": rounded(F.lit(q[c, 0.5]).cast("double")),
                "p75": rounded(F.lit(q[c, 0.75]).cast("double")),
                "max": rounded(F.col(c)["max"]),
            }
            for c in columns
        },
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Rows strictly outside the quartiles by more than ``reach`` times their distance."""
    q = quantile_values(df, columns, [0.25, 0.75])
    bounds = {}
    for c in columns:
        low, high = q[c, 0.25], q[c, 0.75]
        if low is not None:
            bounds[c] = (low, high, low - reach * (high - low), high + reach * (high - low))
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.coalesce(count_true((F.col(c) < F.lit(b[2])) | (F.col(c) > F.lit(b[3]))), F.lit(0)).alias(f"o_{c}")
            for c, b in bounds.items()
        ],
    )
    return rows_from_structs(
        wide,
        {
            c: {
                "q1": F.lit(b[0]), "q3": F.lit(b[1]), "lower_bound": F.lit(b[2]), "upper_bound": F.lit(b[3]),
                "outliers": F.col(f"o_{c}"), "outlier_pct": ratio(F.col(f"o_{c}"), F.col("n")) * 100,
            }
            for c, b in bounds.items()
        },
    )


def class_histogram(df: DataFrame, columns: Sequence[str], label: str = "label", bins: int = 30) -> DataFrame:
    """Equal-width bins between each class's own smallest and largest value, empty bins included.

    One scan finds the spans, one counts: bin numbers of all columns stand side by side in a row.
    """
    spans = long_span(df, columns, label)
    same = F.col("low") == F.col("high")
    spans = cut_lineage(spans.select(
        F.col(label).alias("label"), "feature",
        F.when(same, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(same, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    ).where("label IS NOT NULL"))
    # One row per class, with the span of every column: small whatever the table holds.
    wide = spans.groupBy("label").agg(
        *[F.max(F.when(F.col("feature") == c, F.struct("low", "high"))).alias(f"span_{i}") for i, c in enumerate(columns)]
    )
    values = df.select(F.col(label).alias("label"), *[F.col(c).cast("double").alias(f"v_{i}") for i, c in enumerate(columns)])
    placed = values.join(broadcast_if_small(wide), "label")

    def position(i: int):
        low, high = F.col(f"span_{i}.low"), F.col(f"span_{i}.high")
        place = F.floor((F.col(f"v_{i}") - low) / (high - low) * F.lit(bins))
        return F.when(place.isNotNull(), F.least(place, F.lit(bins - 1)).cast("int"))

    counts = bin_counts(placed.select("label", *[position(i).alias(c) for i, c in enumerate(columns)]), "label", columns)
    grid = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("high") - F.col("low")) / F.lit(bins)
    return grid.join(counts, ["label", "feature", "bin"], "left").select(
        "label", "feature", "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"),
    )


def long_span(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Smallest and largest value per class and feature, from one grouped scan."""
    wide = df.groupBy(label).agg(
        *[F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c) for c in columns]
    )
    structs = [F.struct(F.lit(c).alias("feature"), F.col(c)["low"].alias("low"), F.col(c)["high"].alias("high")) for c in columns]
    return wide.select(label, F.explode(F.array(*structs)).alias("s")).select(label, "s.*").where("low IS NOT NULL")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, from one scan; each pair uses the rows that hold both."""
    numbered = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    wide = df.agg(*[F.corr(columns[i], columns[j]).alias(f"r_{i}_{j}") for i, j in numbered])
    structs = []
    for i, j in numbered:
        for a, b in {(i, j), (j, i)}:
            structs.append(
                F.struct(
                    F.lit(columns[a]).alias("feature_a"), F.lit(columns[b]).alias("feature_b"),
                    F.col(f"r_{i}_{j}").alias("r"),
                )
            )
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def target_correlation(df: DataFrame, columns: Sequence[str], label: str = "label", k: int = 10) -> DataFrame:
    wide = df.agg(*[F.abs(F.corr(c, label)).alias(c) for c in columns])
    rows = rows_from_structs(wide, {c: {"abs_r": F.col(c)} for c in columns})
    band = (
        F.when(F.col("abs_r") > STRONG_CORRELATION, F.lit("strong"))
        .when(F.col("abs_r") > SOME_CORRELATION, F.lit("some"))
        .otherwise(F.lit("weak"))
    )
    return rows.withColumn("band", band).orderBy(F.desc_nulls_last("abs_r"), "feature").limit(k)


def high_corr_pairs(df: DataFrame, columns: Sequence[str], threshold: float = HIGH_CORRELATION) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[F.abs(F.corr(a, b)).alias(f"r{n}") for n, (a, b) in enumerate(pairs)])
    structs = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"r{n}").alias("abs_r"))
        for n, (a, b) in enumerate(pairs)
    ]
    rows = wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
    return rows.where(F.col("abs_r") > threshold).orderBy(F.desc("abs_r"), "feature_a", "feature_b")


def skew_kurtosis(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.struct(F.skewness(c).alias("s"), F.kurtosis(c).alias("k")).alias(c) for c in columns])
    rows = rows_from_structs(wide, {c: {"skew": F.col(c)["s"], "kurtosis": F.col(c)["k"]} for c in columns})
    size = F.abs("skew")
    shape = (
        F.when(size < 0.5, F.lit("Normal"))
        .when(F.col("skew") > 1, F.lit("Right-skewed"))
        .when(F.col("skew") < -1, F.lit("Left-skewed"))
        .otherwise(F.lit("Moderate skew"))
    )
    return rows.withColumn("distribution", shape).orderBy(F.desc_nulls_last(size), "feature")


def skewed_features(df: DataFrame, columns: Sequence[str], over: float = 1.0) -> list[str]:
    """Names of the columns with |skew| above the limit (at most one per column)."""
    found = df.agg(*[F.skewness(c).alias(c) for c in columns]).first()
    return [c for c in columns if found[c] is not None and abs(found[c]) > over]


def log1p_skewed(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``<feature>_log`` for the features that are skewed in the fitting rows."""
    names = skewed_features(df if fit_on is None else fit_on, columns)
    return df.withColumns({f"{c}_log": F.log1p(F.col(c)) for c in names})


def scale_analysis(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(
        *[
            F.struct(
                F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
                F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            ).alias(c)
            for c in columns
        ]
    )
    spans = {c: F.col(c)["max"] - F.col(c)["min"] for c in columns}
    smallest = reduce(F.least, spans.values()) if len(columns) > 1 else next(iter(spans.values()))
    rows = rows_from_structs(
        wide,
        {
            c: {
                "min": F.col(c)["min"], "max": F.col(c)["max"], "mean": F.col(c)["mean"], "std": F.col(c)["std"],
                "value_range": spans[c], "scale_ratio": ratio(spans[c], smallest),
            }
            for c in columns
        },
    )
    return rows.withColumn("needs_scaling", F.col("scale_ratio") > SCALE_RATIO).orderBy(
        F.desc_nulls_last("scale_ratio"), "feature"
    )
