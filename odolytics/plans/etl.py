"""The two end-to-end jobs: incremental features with the report table, and batch scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from odolytics import schema as S
from odolytics.functions.columns import broadcast_if_small
from odolytics.operators import keys, scoring, trips
from odolytics.operators.cleaning import select_trip
from odolytics.session import cut_lineage
from odolytics.sources import readers, writers


def features_from_any_stage(df: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Raw sensor rows are cleaned and summarised; ready features pass through."""
    stage = readers.detect_stage(df.columns)
    if stage == readers.RAW_SENSOR:
        return trips.trip_features_serving(readers.standardize_columns(df), tiebreak)
    if stage == readers.FEATURES_READY:
        return readers.standardize_columns(df)
    raise ValueError("expected raw sensor rows or ready trip features")


NEW_IDS_TO_BROADCAST = 1_000_000     # 8 MB of keys


def update_features(sensor: DataFrame, features_path: str, tiebreak: Sequence[str] = ()) -> None:
    """Append the features of trips that have none yet.

    The new ids come from the key column alone and are written down. When they are few, as in most runs,
    they filter the sensor scan, so only the rows of new trips are shuffled.
    """
    have = writers.stored(sensor.sparkSession, features_path)
    rows = sensor
    if have is not None:
        todo = cut_lineage(keys.new_trips(sensor, have.select(S.KEY)))
        rows = keys.read_trips(sensor, broadcast_if_small(todo, NEW_IDS_TO_BROADCAST))
    trips.trip_features(rows, tiebreak=tiebreak).write.mode("append").parquet(features_path)


def refresh_master(
    labels: DataFrame, drivers: DataFrame, features_path: str, master_path: str, csv_path: str | None = None,
    as_of: dt.date | None = None,
) -> None:
    """Rebuild the report table; always run, since labels and drivers may have changed."""
    features = writers.stored(labels.sparkSession, features_path)
    if features is None:
        return
    writers.replace(keys.master_table(labels, features, drivers, as_of), master_path)
    if csv_path:
        writers.write_csv(labels.sparkSession.read.parquet(master_path), csv_path)


def run_etl(
    sensor: DataFrame, labels: DataFrame, drivers: DataFrame, features_path: str, master_path: str,
    csv_path: str | None = None, tiebreak: Sequence[str] = (), as_of: dt.date | None = None,
) -> None:
    update_features(sensor, features_path, tiebreak)
    refresh_master(labels, drivers, features_path, master_path, csv_path, as_of)


def score_input(df: DataFrame, model: scoring.LinearModel, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Validate, bring to features, score."""
    return scoring.score_batch(features_from_any_stage(df, tiebreak), model)


def record_run(results: DataFrame, source: str, history_path: str, mode: str = "batch") -> None:
    """Append a scoring run's totals to the history table."""
    entry = scoring.history_entry(scoring.batch_summary(results), mode, source)
    entry.write.mode("append").parquet(history_path)


def record_trip(result: DataFrame, history_path: str) -> None:
    """Append a single trip's prediction to the history table, with the time it was made."""
    scoring.trip_entry(result).write.mode("append").parquet(history_path)


def score_trip(sensor: DataFrame, booking_id, model: scoring.LinearModel, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One trip through the same job; an unknown trip is an error."""
    rows = select_trip(readers.standardize_columns(sensor), booking_id)
    if rows.isEmpty():
        raise ValueError(f"no data found for booking ID: {booking_id}")
    return score_input(rows, model, tiebreak)
