"""Trip features on hand-made trips and on hot trips, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from odolytics import schema as S
from odolytics.operators import cleaning, kinematics, trips

SCHEMA = "bookingID long, event_id long, second long, accuracy double, speed double, " + ", ".join(
    f"{c} double" for c in S.CHANNELS
)
CALM = dict(accuracy=5.0, speed=10.0, acceleration_x=0.1, acceleration_y=0.2, acceleration_z=0.3, gyro_x=0.01, gyro_y=0.02, gyro_z=0.03)
ROUGH = {**CALM, "acceleration_y": 15.0, "gyro_y": 1.4}


def rows_of(trip, *steps):
    return [{"bookingID": trip, "event_id": 1000 * trip + i, **base, "second": second} for i, (second, base) in enumerate(steps)]


EDGES = {
    "one row": rows_of(1, (5, CALM)),
    "no speed": rows_of(2, *[(i, {**CALM, "speed": None}) for i in range(4)]),
    "missing axis in the middle": rows_of(3, (0, CALM), (1, {**CALM, "acceleration_y": None, "gyro_y": None}), (2, ROUGH)),
    "missing axis first": rows_of(4, (0, {**CALM, "acceleration_x": None}), (1, ROUGH), (2, CALM)),
    "same second": rows_of(5, (3, CALM), (3, ROUGH), (3, {**ROUGH, "gyro_y": -1.4}), (4, CALM)),
    "long gap": rows_of(6, (0, CALM), (11, {**CALM, "speed": 200.0}), (21, {**CALM, "speed": 20.0}), (22, {**CALM, "speed": 5.0})),
    "speed on the edges": rows_of(7, (0, {**CALM, "speed": 8.33}), (1, {**CALM, "speed": 16.67}), (2, {**CALM, "speed": 22.2}), (3, {**CALM, "speed": -0.1})),
    "readings at the limits": rows_of(8, (0, {**CALM, **S.CHANNEL_LIMITS}), (1, {**CALM, **{c: -v - 1e-9 for c, v in S.CHANNEL_LIMITS.items()}})),
    "dead band": rows_of(9, (0, {**CALM, "gyro_y": 0.5}), (1, {**CALM, "gyro_y": -0.5}), (2, {**CALM, "gyro_y": 0.6}), (3, {**CALM, "gyro_y": -0.6}), (9, {**CALM, "gyro_y": 0.6})),
    "smooth at both ends": rows_of(10, (0, CALM), (4, CALM), (5, ROUGH), (9, ROUGH), (30, CALM), (31, CALM)),
    "filtered out": rows_of(11, (21601, CALM), (5, {**CALM, "accuracy": 50.1})),
    "no key": [{**CALM, "bookingID": None, "event_id": 1, "second": 1}, {**CALM, "bookingID": 12, "event_id": 2, "second": None}],
    "negative seconds": rows_of(13, (-5, CALM), (-3, ROUGH), (0, CALM)),
}


def frame(spark, rows):
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], SCHEMA)


def collected(df):
    return {r["bookingID"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 1, 3])
def test_edge_trips(spark, hot_rows):
    rows = [r for case in EDGES.values() for r in case]
    found = trips.trip_features(frame(spark, rows), tiebreak=["event_id"], hot_rows=hot_rows)
    assert found.columns == ["bookingID", *S.TRIP_FEATURES]
    brute.same(collected(found), brute.features(rows, "event_id"))


def random_rows(n, seed, hot_share=0.0, copies=0):
    chance = random.Random(seed)
    out = []
    for i in range(n):
        hot = chance.random() < hot_share
        out.append(
            {
                "bookingID": 1 if hot else chance.randrange(2, 12), "event_id": i, "second": chance.randrange(-20, 120),
                "accuracy": chance.choice([None, 5.0, 60.0]), "speed": chance.choice([None, -1.0, chance.uniform(0, 30)]),
                **{c: chance.choice([None, 0.01, chance.gauss(0, limit / 2)]) for c, limit in S.CHANNEL_LIMITS.items()},
            }
        )
    return out + [{**out[0], "bookingID": 1, "event_id": n + i, "accuracy": 1.0, "second": 50} for i in range(copies)]


def test_hot_trip_and_copies_are_cut_and_stay_exact(spark):
    """A third of the rows in one trip and a third of them copies of one row."""
    rows = random_rows(600, 3, hot_share=0.4, copies=300)
    found = trips.trip_features(frame(spark, rows), tiebreak=["event_id"], hot_rows=60)
    brute.same(collected(found), brute.features(rows, "event_id"))


@pytest.mark.parametrize("profile", [S.TRAINING, S.SERVING])
def test_cut_rows_equal_whole_rows(spark, profile):
    data = frame(spark, random_rows(500, 5, hot_share=0.5, copies=100))
    whole = kinematics.kinematics(data, profile, ["event_id"], hot_rows=None)
    cut = kinematics.kinematics(data, profile, ["event_id"], hot_rows=25)
    assert whole.count() == cut.count()
    assert whole.exceptAll(cut.select(*whole.columns)).isEmpty()


def test_forward_fill_across_cuts(spark):
    data = frame(spark, random_rows(400, 7, hot_share=0.6))
    whole = cleaning.fill_forward(data, ["event_id"], hot_rows=None)
    cut = cleaning.fill_forward(data, ["event_id"], hot_rows=20)
    assert whole.exceptAll(cut.select(*whole.columns)).isEmpty() and whole.count() == cut.count() == 400


def test_without_tiebreak_the_result_does_not_depend_on_input_order(spark):
    rows = random_rows(300, 11, copies=50)
    once = trips.trip_features(frame(spark, rows).drop("event_id"))
    again = trips.trip_features(frame(spark, rows[::-1]).drop("event_id").repartition(7), hot_rows=40)
    a, b = collected(once), collected(again)
    brute.same(a, b)


def test_serving_features_keep_missing_axes_missing(spark):
    rows = rows_of(1, (0, {**CALM, "gyro_x": None}), (2, CALM), (3, {**ROUGH, "gyro_x": None}))
    r = trips.trip_features_serving(frame(spark, rows), ["event_id"]).first()
    assert r["n_points"] == 3 and r["gyro_mag_std"] is not None
    row = kinematics.kinematics(frame(spark, rows), S.SERVING, ["event_id"]).orderBy("event_id").collect()
    assert row[0]["gyro_mag"] is None and row[0]["delta_t"] == 1.0
    assert row[2]["gyro_x"] == CALM["gyro_x"]


def test_strict_smooth_counts_smooth_rows_only(spark):
    rows = EDGES["smooth at both ends"]
    loose = trips.trip_features(frame(spark, rows), tiebreak=["event_id"]).first()
    strict = trips.trip_features(frame(spark, rows), tiebreak=["event_id"], strict_smooth=True).first()
    assert loose["longest_smooth_segment_sec"] == 22.0 and strict["longest_smooth_segment_sec"] == 22.0
    longer = rows_of(1, (0, CALM), (4, CALM), (5, ROUGH), (90, ROUGH))
    assert trips.trip_features(frame(spark, longer), tiebreak=["event_id"]).first()["longest_smooth_segment_sec"] == 90.0
    assert trips.trip_features(frame(spark, longer), tiebreak=["event_id"], strict_smooth=True).first()["longest_smooth_segment_sec"] == 4.0


def test_limits_quantile_and_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), 2.0), (2, 1.0, None)], "id long, a double, b double")
    assert [tuple(r) for r in cleaning.nulls_normalize(df).orderBy("id").collect()] == [(1, None, 2.0), (2, 1.0, None)]


def test_bins(spark):
    df = spark.createDataFrame([(1.0, -1), (2.5, 0), (2.6, 3), (5.1, 60), (5.2, 61)], "rating double, no_of_years_driving_exp int")
    found = [tuple(r) for r in df.select(cleaning.rating_bin(), cleaning.experience_bin()).collect()]
    assert found == [(None, None), ("Very Low", "<3"), ("Low", "<3"), ("High", "20+"), (None, None)]


def test_sensor_second_must_be_known(spark):
    df = frame(spark, EDGES["no key"])
    assert cleaning.filter_rows(df).where(F.col("second").isNull()).isEmpty()
    assert cleaning.drop_null_keys(df).isEmpty()
