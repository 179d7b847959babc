"""Trip fragments: folded apart and combined they are the trip folded at once."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.operators import fragments, trips
from odolytics.sources import fixtures as X
from odolytics.streaming import jobs


def plain(df):
    return {r[S.KEY]: {c: r[c] for c in S.TRIP_FEATURES} for r in df.collect()}


@pytest.mark.parametrize("width,hot", [(1, None), (50, 3)])
def test_combined_fragments_equal_the_batch_features(spark, folder, width, hot):
    sensor = X.sensor(spark, folder)
    parts = fragments.fold(sensor, fragments.slot_of(width), X.TIEBREAK, hot_rows=hot)
    found = fragments.features(fragments.combine(parts, [S.KEY]))
    brute.same(plain(found), plain(trips.trip_features(sensor, tiebreak=X.TIEBREAK)), 8)


def test_combining_in_two_steps_changes_nothing(spark, folder):
    sensor = X.sensor(spark, folder)
    parts = fragments.fold(sensor, fragments.slot_of(3), X.TIEBREAK).withColumn("part", F.floor(F.col(fragments.SLOT) / 11))
    twice = fragments.combine(fragments.combine(parts, [S.KEY, "part"]), [S.KEY])
    brute.same(plain(fragments.features(twice)), plain(trips.trip_features(sensor, tiebreak=X.TIEBREAK)), 8)


def rows_of(spark, seconds, seed=1):
    dice = random.Random(seed)
    smooth = [dice.random() < 0.6 for _ in seconds]
    rows = [
        (1 + i % 2, i, s, 1.0, dice.choice([None, 30 * dice.random()]), *[0.1 * dice.random() if calm else 4 * dice.gauss(0, 1) for _ in S.CHANNELS])
        for i, (s, calm) in enumerate(zip(seconds, smooth))
    ]
    return spark.createDataFrame(rows, "bookingID long, event_id long, second long, accuracy double, speed double, " + ", ".join(f"{c} double" for c in S.CHANNELS))


@pytest.mark.parametrize("order", ["shuffled", "copies"])
def test_sink_over_many_small_batches(spark, tmp_path, order):
    seconds = sorted(random.Random(3).randrange(120) for _ in range(90))
    table = rows_of(spark, seconds)
    rows = table.collect()
    if order == "shuffled":
        random.Random(5).shuffle(rows)
    else:
        rows = rows[:40] + rows[30:60] + rows[55:]
    body = jobs.upsert_trips(str(tmp_path / "rows"), str(tmp_path / "features"), X.TIEBREAK, slot=25)
    for n, at in enumerate(range(0, len(rows), 40)):
        for _ in range(1 + n % 2):          # some batches are tried twice
            body(spark.createDataFrame(rows[at : at + 40], table.schema), n)
    whole = spark.createDataFrame(rows, table.schema)
    brute.same(plain(jobs.latest_trips(spark, str(tmp_path / "features"))), plain(trips.trip_features(whole, tiebreak=X.TIEBREAK)), 8)


def test_rows_in_order_are_not_read_again(spark, tmp_path):
    table = rows_of(spark, list(range(60)))
    rows, path = table.collect(), str(tmp_path / "rows")
    body = jobs.upsert_trips(path, str(tmp_path / "features"), X.TIEBREAK, slot=25)
    body(spark.createDataFrame(rows[:30], table.schema), 0)
    spark.createDataFrame([], table.schema).withColumn("slot", F.lit(0).cast("long")).write.mode("overwrite").partitionBy("slot").parquet(f"{path}/batch=0")    # the history is gone
    body(spark.createDataFrame(rows[30:], table.schema), 1)
    brute.same(plain(jobs.latest_trips(spark, str(tmp_path / "features"))), plain(trips.trip_features(table, tiebreak=X.TIEBREAK)), 8)
