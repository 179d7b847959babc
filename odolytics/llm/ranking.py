"""Places of rows in the order of their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odolytics.session import work_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: no lost executor repeats what came before."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, group: str, order: Sequence[str], name: str = "ranked") -> DataFrame:
    """``rows`` with ``at``, the place of each row (from 0) in its group by ``order``; no group is one task.

    Rows are range-partitioned by (group, order) and numbered within each range; a group that goes on from one range
    to the next gets the count of what came before. Rows equal in group and order are dealt out by a running
    number, so copies of one row fill several ranges as well; which copy comes first is arbitrary but settled once.
    """
    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sort = [group, *order, "__copy"]
    ranged = rows.withColumn("__copy", F.monotonically_increasing_id()).repartitionByRange(parts, *sort)
    ranged = written(ranged.withColumn("__range", F.spark_partition_id()), name)
    runs = ranged.groupBy("__range", group).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first group of a range can have begun before it, so there is one row per range at most.
    begun = runs.select("__range", group, F.sum("n").over(earlier).alias("before")).where("before > 0")
    here = F.row_number().over(Window.partitionBy("__range", group).orderBy(*sort[1:])) - 1
    numbered = ranged.withColumn("here", here).join(F.broadcast(begun), ["__range", group], "left")
    at = (F.col("here") + F.coalesce("before", F.lit(0))).cast("long")
    return numbered.select(*rows.columns, at.alias("at"))
