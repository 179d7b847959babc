"""Mutual information of features and classes by the distances to nearest neighbours of the same class.

For each row: r is the distance to its k-th nearest row of the same class in one feature, m the number of rows of
any class nearer than r. Where k rows or more share its value, r is 0 and m counts the rows of that value. The score
compares digamma sums of k, m and the class sizes. No noise is added, so results repeat.

Rows are counted per distinct value first. Both searches are range-partitioned: neighbours within a range come from a
window, those beyond its cuts from the k values on either side that ranges hand to each other; counts within a distance
are differences of running totals, looked up by merging the bounds into the sorted values.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolytics.functions import ordered
from odolytics.functions.columns import broadcast_if_small, long_form, nan_to_null
from odolytics.session import cut_lineage

NEIGHBOURS = 5
SHIFT = 10              # digamma arguments are raised by this much before the series


def digamma(n: Column) -> Column:
    """Digamma of a positive whole number, to about eleven places."""
    x = n.cast("double")
    z = x + F.lit(float(SHIFT))
    inverse = F.lit(1.0) / (z * z)
    series = F.log(z) - F.lit(0.5) / z - inverse * (
        F.lit(1.0 / 12) - inverse * (F.lit(1.0 / 120) - inverse * (F.lit(1.0 / 252) - inverse * F.lit(1.0 / 240)))
    )
    for j in range(SHIFT):
        series = series - F.lit(1.0) / (x + F.lit(float(j)))
    return series


def _neighbour_values(points: DataFrame, k: int, pieces: int) -> DataFrame:
    """``feature, label, value, n, size, distances``: sorted distances of each distinct value to the k rows on either
    side of one of its rows, in its own class."""
    group = ["feature", "label"]
    # More than k + 1 copies of a value change nothing: its rows are at distance 0 of k others.
    copies = points.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k + 1)).cast("int"))))
    cut = ordered.cut_ranges(copies, group, ["value", "copy"], pieces)
    rows, chunk = cut.df, ordered.CHUNK
    window = cut.window
    numbered = rows.withColumn("from_start", F.row_number().over(window)).withColumn(
        "from_end", F.count(F.lit(1)).over(Window.partitionBy(chunk, *group)) - F.col("from_start") + 1
    ).withColumn("from_end", F.col("from_end").cast("int"))
    by_value = F.sort_array(F.collect_list(F.when(F.col("from_end") <= k, F.col("value"))))
    by_start = F.sort_array(F.collect_list(F.when(F.col("from_start") <= k, F.col("value"))))
    edges = numbered.where((F.col("from_end") <= k) | (F.col("from_start") <= k)).groupBy(chunk, *group).agg(
        by_value.alias("last"), by_start.alias("first")
    )
    # Each range holds a row of the group at least, so k ranges away there are k values.
    across = Window.partitionBy(*group).orderBy(chunk)
    carried = edges.select(
        chunk, *group,
        F.flatten(F.collect_list("last").over(across.rowsBetween(-k, -1))).alias("before"),
        F.flatten(F.collect_list("first").over(across.rowsBetween(1, k))).alias("after"),
    )
    found = numbered.join(carried, [chunk, *group])

    def neighbour(inside: Column, place: Column, j: int, outside: Column) -> Column:
        return F.when(place > j, inside).otherwise(outside)

    distances = []
    for j in range(1, k + 1):
        lower = neighbour(F.lag("value", j).over(window), F.col("from_start"), j, F.get("before", F.size("before") - (F.lit(j + 1) - F.col("from_start"))))
        upper = neighbour(F.lead("value", j).over(window), F.col("from_end"), j, F.get("after", F.lit(j) - F.col("from_end")))
        distances += [F.col("value") - lower, upper - F.col("value")]
    near = found.withColumn("distances", F.array_sort(F.array_compact(F.array(*distances)))).where("copy = 1")
    return near.select(*points.columns, "distances")


_SIGN = np.int64(0x7FFFFFFFFFFFFFFF)


def _ranks(x: np.ndarray) -> np.ndarray:
    """Places of numbers among all doubles in order."""
    bits = np.ascontiguousarray(x, np.float64).view(np.int64)
    return np.where(bits >= 0, bits, -(bits & _SIGN))


def _numbers(ranks: np.ndarray) -> np.ndarray:
    return np.where(ranks >= 0, 1.0, -1.0) * np.abs(ranks).view(np.float64)


def _bound(x: np.ndarray, r: np.ndarray, side: float) -> np.ndarray:
    """The number nearest to x, on one side of it, whose distance from x is r or more. Distances are rounded
    differences, so x + r can miss it; the search halves the numbers between x and infinity."""
    near, far = _ranks(x), _ranks(np.full(len(x), side * np.inf))
    for _ in range(64):
        middle = (near >> 1) + (far >> 1) + (near & far & 1)
        if side < 0:
            middle = np.where(middle == far, near, middle)
        with np.errstate(over="ignore"):
            reached = (side * (_numbers(middle) - x) >= r) & (middle != near)
        near, far = np.where(reached, near, middle), np.where(reached, middle, far)
    return _numbers(far)


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least value at distance r or more above x and the largest below; next to x itself where r is 0."""
    for batch in batches:
        x, r = (batch.column(c).to_numpy() for c in ("value", "radius"))
        columns = [pa.array(_bound(x, r, side)) for side in (1.0, -1.0)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "above", "below"])


def mutual_information_neighbours(
    df: DataFrame, columns: Sequence[str], label: str = "label", k: int = NEIGHBOURS, pieces: int | None = None
) -> DataFrame:
    """``feature, mi`` (nats, 0 at least), largest first. Missing and undefined values read as 0, infinite ones as the
    largest numbers; rows without a class, and classes of one row, are left out."""
    spark = df.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def finite(c: str) -> Column:
        known = F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(0.0))
        return F.greatest(F.least(known, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))

    read = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), *[finite(c).alias(c) for c in columns])
    sizes = read.groupBy("label").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = cut_lineage(sizes)
    counted = long_form(read, ["label"], columns).groupBy("feature", "label", (F.col("value") + F.lit(0.0)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    points = cut_lineage(counted.join(broadcast_if_small(sizes), "label").select("feature", "label", "value", "n", "size"))

    near = _neighbour_values(points, k, pieces)
    own_k = F.least(F.lit(k).cast("long"), F.col("size") - 1)
    near = near.select(*points.columns, own_k.alias("k"), F.element_at("distances", own_k.cast("int")).alias("radius"))
    bounded = T.StructType([*near.schema.fields, T.StructField("above", T.DoubleType()), T.StructField("below", T.DoubleType())])
    near = cut_lineage(near.mapInArrow(_bounds, bounded))

    # Values and bounds in one order: a bound from above comes before equal values, one from below after them.
    key = ["feature", "label", "value"]
    none = F.lit(0).cast("long")
    values = points.select("feature", F.col("value").alias("v"), F.lit(1).alias("kind"), "n", F.col("label"), "value", none.alias("sign"))
    tops = near.select("feature", F.col("above").alias("v"), F.lit(0).alias("kind"), none.alias("n"), "label", "value", F.lit(1).cast("long").alias("sign"))
    bottoms = near.select("feature", F.col("below").alias("v"), F.lit(2).alias("kind"), none.alias("n"), "label", "value", F.lit(-1).cast("long").alias("sign"))
    merged = ordered.cut_ranges(values.union(tops).union(bottoms), ["feature"], ["v", "kind"], pieces)
    upto = merged.running({"total": F.col("n")}).rows().where("sign <> 0")
    within = upto.groupBy(*key).agg(F.sum(F.col("sign") * F.col("total")).alias("m"))

    terms = near.join(within, key).groupBy("feature").agg(
        F.sum("n").alias("rows"),
        F.sum(F.col("n") * (digamma(F.col("k")) - digamma(F.col("size")) - digamma(F.col("m")))).alias("total"),
    )
    mi = digamma(F.col("rows")) + F.col("total") / F.col("rows")
    return terms.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi")).orderBy(F.desc("mi"), "feature")
