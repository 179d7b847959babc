"""Key checks, incremental selection and the joins of trips, labels and drivers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.operators.cleaning import clean_drivers, clean_labels


def duplicate_keys(df: DataFrame, keys: Sequence[str] = (S.KEY, S.TIME)) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def _missing_parents(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count; rows are counted before the shuffle, so a
    key holding many rows costs the join one row."""
    counts = child.groupBy(F.col(key).alias("orphan_key")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(parent, counts["orphan_key"] == parent[parent_key], "left_anti")


def orphan_count(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return _missing_parents(child, key, parent, parent_key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphan_rows")
    )


def orphan_sample(child: DataFrame, key: str, parent: DataFrame, parent_key: str, size: int = 10) -> DataFrame:
    return _missing_parents(child, key, parent, parent_key).select("orphan_key").orderBy("orphan_key").limit(size)


def new_trips(sensor: DataFrame, done: DataFrame | None) -> DataFrame:
    """Trip ids in the source that have no features yet; all of them when nothing is done."""
    ids = sensor.select(S.KEY).distinct()
    return ids if done is None else ids.join(done, S.KEY, "left_anti")


def read_trips(sensor: DataFrame, ids: DataFrame) -> DataFrame:
    """Sensor rows of the given trips, as one semi join; a hot trip's side is split by adaptive execution."""
    return sensor.join(ids, S.KEY, "left_semi")


def with_features(labels: DataFrame, features: DataFrame) -> DataFrame:
    return labels.join(features, S.KEY, "left")


def with_drivers(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    """Add driver columns; both ``driver_id`` and ``id`` stay. Spark broadcasts the drivers when their
    measured size allows it and sorts and merges otherwise."""
    return trips.join(drivers, trips["driver_id"] == drivers["id"], "left")


def with_longest_smooth(features: DataFrame, longest: DataFrame) -> DataFrame:
    """Add a separately kept longest-smooth column; trips without one get 0."""
    column = "longest_smooth_segment_sec"
    return features.join(longest, S.KEY, "left").withColumn(column, F.coalesce(column, F.lit(0.0)))


def master_table(
    labels: DataFrame, features: DataFrame, drivers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Labels with trip features and cleaned drivers: the table reports read."""
    return clean_labels(labels).transform(with_features, features).transform(with_drivers, clean_drivers(drivers, as_of))
