"""How well features tell the classes apart, and which to keep."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odolytics.functions.columns import broadcast_if_small, count_true, ratio_or_zero, rows_from_structs
from odolytics.functions.counts import bin_counts
from odolytics.functions.quantiles import quantile_values
from odolytics.operators.profile import high_corr_pairs
from odolytics.session import cut_lineage

VIF_LIMIT = 10.0
DEPENDENT = 1e-13       # share of length below which a direction counts as none
STACKED = 32            # triangular factors merged in one task
NORMAL_FROM = 1e7       # degrees of freedom from which the normal distribution is used
SIGNIFICANT = 0.05


def gram_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums of products of every column pair in one scan, missing values read as 0."""
    data = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = data.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"g{n}") for n, (a, b) in enumerate(pairs)])
    structs = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"g{n}").alias("g"))
        for n, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of the QR factors, with as many rows as columns."""
    k = rows.shape[1]
    r = np.linalg.qr(rows, mode="r") if len(rows) else np.zeros((0, k))
    return np.vstack([r, np.zeros((k - len(r), k))]) if len(r) < k else r


def triangular_factor(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """R of the QR factors of a tall table, missing values read as 0; one scan.

    Every task reduces its rows to a k x k triangle, batch by batch; triangles are stacked and reduced again in a tree of
    two levels, and at most ``STACKED`` of them reach the driver. Unlike sums of products this does not square
    the condition of the columns: a dependence of one part in 10^8 is still told from a full one.
    """
    k = len(columns)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, k))
        for batch in batches:
            r = _triangle(np.vstack([r, np.column_stack([c.to_numpy() for c in batch.columns])]))
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def of_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        stacked = np.vstack([np.frombuffer(r).reshape(-1, k) for r in table.column("r").to_pylist()])
        return pa.table({"r": pa.array([_triangle(stacked).tobytes()], pa.binary()), "part": pa.array([key[0].as_py()], pa.int32())})

    data = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    parts = data.mapInArrow(of_task, "r binary").withColumn("part", F.spark_partition_id())
    for groups in (STACKED * STACKED, STACKED):
        parts = parts.groupBy(F.pmod("part", F.lit(groups)).alias("of")).applyInArrow(of_group, "r binary, part int")
    factors = [np.frombuffer(row["r"]).reshape(-1, k) for row in parts.select("r").collect()]
    return _triangle(np.vstack(factors)) if factors else np.zeros((k, k))


def vif(df: DataFrame, columns: Sequence[str], limit: float = VIF_LIMIT) -> DataFrame:
    """Variance inflation without an intercept: squared length of a column times that of its row in the inverse of R.

    A column that is a linear combination of others has no inverse to speak of: its inflation is infinite. Only
    k x k numbers reach the driver.
    """
    r = triangular_factor(df, columns)
    length = np.sqrt((r ** 2).sum(axis=0))
    unit = r / np.where(length > 0, length, 1.0)
    _, sizes, vectors = np.linalg.svd(unit)
    kept = sizes > DEPENDENT * max(1.0, sizes.max(initial=0.0))
    # A column with a part in a direction of no length depends on the other columns in it.
    dependent = (vectors[~kept] ** 2).sum(axis=0) > DEPENDENT
    inverse = ((vectors[kept] / sizes[kept, None]) ** 2).sum(axis=0)
    values = np.where(dependent, math.inf, inverse)
    rows = [(c, float(v), bool(v > limit)) for c, v in zip(columns, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, vif double, too_high boolean")
    return table.orderBy(F.desc("vif"), "feature")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in count(1):      # about the square root of the larger argument
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def student_p_value(t: float | None, dof: float) -> float | None:
    """Two-sided p-value of a t statistic."""
    if t is None or dof <= 0 or math.isnan(t):
        return None
    if dof > NORMAL_FROM:
        z = abs(t) * (1 - 1 / (4 * dof)) / math.sqrt(1 + t * t / (2 * dof))
        return math.erfc(z / math.sqrt(2))
    a, b, x = dof / 2.0, 0.5, dof / (dof + t * t)
    if x >= 1.0:
        return 1.0
    if x <= 0.0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def class_separation(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Class means, their difference, Cohen's d and the equal-variance t statistic, in one scan."""
    wide = df.agg(
        *[
            F.struct(
                *[
                    expr.alias(f"{name}{k}")
                    for k in (0, 1)
                    for name, expr in (
                        ("n", F.count(F.when(F.col(label) == k, F.col(c)))),
                        ("m", F.avg(F.when(F.col(label) == k, F.col(c)))),
                        ("v", F.var_samp(F.when(F.col(label) == k, F.col(c)))),
                    )
                ]
            ).alias(c)
            for c in columns
        ]
    )

    def measures(c: str) -> dict:
        s = F.col(c)
        diff = s["m1"] - s["m0"]
        pooled = F.sqrt((s["v0"] + s["v1"]) / 2.0)
        dof = (s["n0"] + s["n1"] - 2).cast("double")
        shared = ((s["n0"] - 1) * s["v0"] + (s["n1"] - 1) * s["v1"]) / F.nullif(dof, F.lit(0.0))
        spread = F.sqrt(shared * (1.0 / F.nullif(s["n0"], F.lit(0)) + 1.0 / F.nullif(s["n1"], F.lit(0))))
        return {
            "safe_mean": s["m0"], "dangerous_mean": s["m1"], "mean_diff": diff,
            "mean_diff_pct": ratio_or_zero(diff, s["m0"]) * 100,
            "cohens_d": ratio_or_zero(diff, pooled),
            "t_stat": -diff / F.nullif(spread, F.lit(0.0)),
            "dof": dof,
        }

    return rows_from_structs(wide, {c: measures(c) for c in columns})


def class_separation_report(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """The same with p-values, strongest first; one row per feature passes the driver."""
    rows = class_separation(df, columns, label).collect()
    out = []
    for r in rows:
        p = student_p_value(r["t_stat"], r["dof"])
        out.append((*r, p, "Yes" if p is not None and p < SIGNIFICANT else "No", abs(r["cohens_d"])))
    table = df.sparkSession.createDataFrame(
        out,
        "feature string, safe_mean double, dangerous_mean double, mean_diff double, mean_diff_pct double, "
        "cohens_d double, t_stat double, dof double, p_value double, significant string, abs_cohens_d double",
    )
    return table.orderBy(F.desc("abs_cohens_d"), "feature")


def effect_size(column: str = "cohens_d"):
    size = F.abs(column)
    return (
        F.when(size > 0.8, F.lit("very large"))
        .when(size > 0.5, F.lit("large"))
        .when(size > 0.2, F.lit("medium"))
        .otherwise(F.lit("small"))
    )


def effect_size_buckets(separation: DataFrame) -> DataFrame:
    """Features per effect size; one row per feature goes in."""
    return (
        separation.groupBy(effect_size().alias("effect"))
        .agg(F.count(F.lit(1)).alias("n_features"), F.sort_array(F.collect_list("feature")).alias("names"))
        .select("effect", "n_features", F.concat_ws(", ", "names").alias("features"))
    )


def mutual_information(df: DataFrame, columns: Sequence[str], label: str = "label", bins: int = 10) -> DataFrame:
    """Feature-class mutual information (nats) over quantile bins, missing values read as 0."""
    filled = df.select(label, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    q = quantile_values(filled, columns, [i / bins for i in range(1, bins)])
    # Binary search over the negated edges puts x in the bin of the edges below it.
    edges = {c: sorted({-q[c, i / bins] for i in range(1, bins)}) for c in columns}
    binned = Bucketizer(
        splitsArray=[[-math.inf, *edges[c], math.inf] for c in columns],
        inputCols=[f"neg_{c}" for c in columns], outputCols=list(columns),
    ).transform(filled.select(label, *[(-F.col(c)).alias(f"neg_{c}") for c in columns]))
    joint = bin_counts(binned, label, columns)
    # From here on there are at most (features x bins x classes) rows.
    n = F.col("n").cast("double")
    by_bin = F.sum("n").over(Window.partitionBy("feature", "bin"))
    by_class = F.sum("n").over(Window.partitionBy("feature", "label"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    terms = joint.withColumn("term", n / total * F.log(n * total / (by_bin.cast("double") * by_class)))
    return terms.groupBy("feature").agg(F.sum("term").alias("mi")).orderBy(F.desc("mi"), "feature")


def feature_keep_drop(
    df: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    weak_below: float = 0.09,
    high_corr: float = 0.8,
    vif_limit: float = VIF_LIMIT,
) -> DataFrame:
    """Keep or drop each feature, with the reason.

    Weak: |d| below the limit. Redundant: highly correlated with a feature of larger |d|. A feature
    with high VIF is dropped when its effect is only small.
    """
    ranked = class_separation(df, columns, label).select("feature", "cohens_d", F.abs("cohens_d").alias("abs_d"))
    pairs = high_corr_pairs(df, columns, high_corr)
    both = pairs.select(F.col("feature_a").alias("feature"), F.col("feature_b").alias("other"), "abs_r").unionByName(
        pairs.select(F.col("feature_b").alias("feature"), F.col("feature_a").alias("other"), "abs_r")
    )
    rival = ranked.select(F.col("feature").alias("other"), F.col("abs_d").alias("other_d"))
    beaten = (
        both.join(ranked, "feature").join(rival, "other")
        .where((F.col("other_d") > F.col("abs_d")) | ((F.col("other_d") == F.col("abs_d")) & (F.col("other") < F.col("feature"))))
        .groupBy("feature").agg(F.max_by("other", F.struct("abs_r", "other")).alias("redundant_with"))
    )
    inflation = vif(df, columns, vif_limit).select("feature", "vif")
    joined = ranked.join(inflation, "feature", "left").join(beaten, "feature", "left")
    reason = (
        F.when(F.col("redundant_with").isNotNull(), F.lit("redundant"))
        .when(F.col("abs_d") < weak_below, F.lit("weak"))
        .when((F.col("vif") > vif_limit) & (F.col("abs_d") <= 0.2), F.lit("collinear and small"))
    )
    return joined.select(
        "feature", "cohens_d", "vif", "redundant_with",
        F.when(reason.isNull(), F.lit("keep")).otherwise(F.lit("drop")).alias("decision"),
        F.coalesce(reason, F.lit("")).alias("reason"),
    )


def caught_and_missed(df: DataFrame, columns: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Among the truly dangerous: mean of each feature where the model caught them and where it did not."""
    dangerous = F.col(label) == 1
    caught, missed = dangerous & (F.col(prediction) == 1), dangerous & (F.col(prediction) == 0)
    wide = df.agg(
        count_true(caught).alias("n_caught"), count_true(missed).alias("n_missed"),
        *[
            F.struct(F.avg(F.when(caught, F.col(c))).alias("c"), F.avg(F.when(missed, F.col(c))).alias("m")).alias(c)
            for c in columns
        ],
    )
    return rows_from_structs(
        wide,
        {
            c: {
                "caught_mean": F.col(c)["c"], "missed_mean": F.col(c)["m"],
                "diff_pct": (F.col(c)["m"] - F.col(c)["c"]) / F.nullif(F.col(c)["c"], F.lit(0.0)) * 100,
                "n_caught": F.col("n_caught"), "n_missed": F.col("n_missed"),
            }
            for c in columns
        },
    )


NODES = 128             # nodes of the density's fine grid in one bandwidth
REACH = 9.0             # bandwidths beyond which a kernel of double precision is nothing


def _density_data(df: DataFrame, column: str, group: str, points: int, cut: float) -> tuple[DataFrame, DataFrame]:
    """Rows with a value and a group; and one row per group with its bandwidth and the grid its density is told on."""
    data = df.select(group, F.col(column).cast("double").alias("x")).where(
        F.col("x").isNotNull() & F.col(group).isNotNull()
    )
    spans = data.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_all"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("low"), F.max("x").alias("high"),
    ).withColumn("bandwidth", F.col("sd") * F.pow(F.col("n_all").cast("double"), F.lit(-0.2))).where(F.col("bandwidth") > 0)
    reach = F.lit(cut) * F.col("bandwidth")
    start = F.col("low") - reach
    step = (F.col("high") + reach - start) / F.lit(points - 1)
    grid = spans.select(group, "n_all", "bandwidth", "low", start.alias("start"), step.alias("step"))
    return data, broadcast_if_small(cut_lineage(grid))       # one row per group


def _density(grid: DataFrame, sums: DataFrame, group: str, points: int) -> DataFrame:
    """Sums of kernels ``k`` per group and point -> densities at every point."""
    every = grid.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("start") + F.col("point") * F.col("step")
    scale = F.col("n_all") * F.col("bandwidth") * F.lit(math.sqrt(2.0 * math.pi))
    return every.join(sums, [group, "point"], "left").select(
        F.col(group).alias("group_name"), "point", at.alias("x"), (F.coalesce("k", F.lit(0.0)) / scale).alias("density")
    )


def class_density(df: DataFrame, column: str, group: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of a column per group on a grid reaching ``cut`` bandwidths past the data.

    Every value has its own kernel at every point. Equal values are counted first; the kernels of the different ones are
    added up inside every task, so a shuffle carries one sum per task, group and point.
    """
    data, grid = _density_data(df, column, group, points, cut)
    weighted = data.groupBy(group, "x").agg(F.count(F.lit(1)).alias("w"))
    laid = weighted.join(grid, group).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    z = (F.col("start") + F.col("point") * F.col("step") - F.col("x")) / F.col("bandwidth")
    sums = laid.groupBy(group, "point").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("k"))
    return _density(grid, sums, group, points)


def binned_class_density(df: DataFrame, column: str, group: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """``class_density`` to a stated error, for columns of very many different values.

    Each value's weight is split between the two nodes around it on a fine grid, linearly, and the nodes are summed up
    before any shuffle; kernels are then laid over nodes, not rows, and only over the points they reach. The density is
    off by at most 1 / (8 * NODES^2 * sqrt(2 pi) * bandwidth), less than a hundred-thousandth of the kernel's own height.
    """
    data, grid = _density_data(df, column, group, points, cut)
    place = (F.col("x") - F.col("low")) / (F.col("bandwidth") / F.lit(NODES))
    split = data.join(grid, group).select(group, F.floor(place).alias("node"), (place - F.floor(place)).alias("part"))
    cells = split.groupBy(group, "node").agg(F.sum(1.0 - F.col("part")).alias("near"), F.sum("part").alias("far"))
    nodes = cells.select(group, "node", F.col("near").alias("w")).union(cells.select(group, F.col("node") + 1, "far"))
    nodes = nodes.where("w > 0").groupBy(group, "node").agg(F.sum("w").alias("w")).join(grid, group)
    at_node = F.col("low") + F.col("node") * (F.col("bandwidth") / F.lit(NODES))
    first = F.greatest(F.ceil((at_node - F.lit(REACH) * F.col("bandwidth") - F.col("start")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((at_node + F.lit(REACH) * F.col("bandwidth") - F.col("start")) / F.col("step")), F.lit(points - 1))
    laid = nodes.withColumns({"at_node": at_node, "first": first.cast("int"), "last": last.cast("int")}).where("first <= last")
    laid = laid.withColumn("point", F.explode(F.sequence("first", "last")))
    at = F.col("start") + F.col("point") * F.col("step")
    z = (at - F.col("at_node")) / F.col("bandwidth")
    sums = laid.groupBy(group, "point").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("k"))
    return _density(grid, sums, group, points)
