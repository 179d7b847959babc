"""Streams fed in several files, and the table jobs around them."""

import types

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute
from odolytics import schema as S
from odolytics import session
from odolytics.operators import keys, trips
from odolytics.plans import etl, queries_streams
from odolytics.sources import fixtures as X
from odolytics.sources import readers, writers
from odolytics.streaming import jobs, trip_state


@pytest.fixture(scope="module")
def split_events(spark, folder, tmp_path_factory):
    """The events in five files, oldest first, so that every trigger brings more rows of every trip."""
    path = str(tmp_path_factory.mktemp("events"))
    events = X.table(spark, folder, "events")
    bounds = [r[0] for r in events.select(F.percentile_approx("event_id", [0.2, 0.4, 0.6, 0.8])).collect()][0]
    edges = [-1, *bounds, 10**12]
    for low, high in zip(edges, edges[1:]):
        events.where((F.col("event_id") > low) & (F.col("event_id") <= high)).coalesce(1).write.mode("append").parquet(path)
    return path, events.schema


def stream(spark, split_events):
    path, schema = split_events
    events = jobs.read_files(spark, path, schema, files_per_trigger=1)
    return jobs.clean(X.sensor_from_events(events).withColumn(jobs.EVENT_TIME, F.col("ts").cast("timestamp")).drop("ts"))


def plain(features):
    return {r["bookingID"]: r.asDict() for r in features.collect()}


def test_trip_state_over_many_triggers_equals_batch(spark, folder, split_events):
    versions = jobs.run_to_table(
        trip_state.trip_features_stream(stream(spark, split_events), "event_id", "1 hour", idle_ms=10**10), "versions"
    )
    assert versions.count() > versions.select("bookingID").distinct().count()      # several versions per trip
    latest = trip_state.latest(versions)
    # Rows moved 30000 time units ahead are filtered, so within a trip event order is time order.
    brute.same(plain(latest), plain(trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK)), 8)
    assert versions.where("n_late > 0").isEmpty()


def trickle(spark, path, seconds, delay):
    """One file, hence one trigger, per given second of one trip."""
    base = {**{c: 0.1 for c in S.CHANNELS}, "speed": 1.0, "accuracy": 1.0, "bookingID": 1}
    schema = "bookingID long, event_id long, second long, accuracy double, speed double, " + ", ".join(
        f"{c} double" for c in S.CHANNELS
    )
    names = [c.split()[0] for c in schema.split(", ")]
    for n, second in enumerate(seconds):
        row = {**base, "event_id": n, "second": second, "speed": float(second)}
        df = spark.createDataFrame([tuple(row[c] for c in names)], schema).withColumn(
            "event_time", F.timestamp_seconds(F.col("second") + 1_700_000_000)
        )
        df.coalesce(1).write.mode("append").parquet(path)
    source = jobs.read_files(spark, path, spark.read.parquet(path).schema, 1)
    versions = jobs.run_to_table(trip_state.trip_features_stream(source, "event_id", delay, idle_ms=10**10), "late")
    return versions.orderBy(F.desc("n_points"), F.desc("n_late")).first(), spark.read.parquet(path)


def test_rows_out_of_order_within_the_delay_are_put_in_order(spark, tmp_path):
    last, rows = trickle(spark, str(tmp_path / "in"), [10, 5, 20, 15, 30, 12], "1 hour")
    assert (last["n_points"], last["n_late"]) == (6, 0)
    brute.same({1: last.asDict()}, plain(trips.trip_features(rows.drop("event_time"), tiebreak=X.TIEBREAK)))


def test_trip_state_in_a_session_with_the_heap_store(spark, tmp_path):
    before = spark.conf.get(session.STATE_STORE)
    spark.conf.set(session.STATE_STORE, session.HEAP_STORE)
    try:
        last, rows = trickle(spark, str(tmp_path / "in"), [10, 5, 20], "1 hour")
        assert spark.conf.get(session.STATE_STORE) == session.HEAP_STORE
    finally:
        spark.conf.set(session.STATE_STORE, before)
    brute.same({1: last.asDict()}, plain(trips.trip_features(rows.drop("event_time"), tiebreak=X.TIEBREAK)))


def test_rows_after_the_watermark_are_left_out(spark, tmp_path):
    last, _ = trickle(spark, str(tmp_path / "in"), [10, 100, 200, 5, 300], "1 second")
    assert (last["n_points"], last["n_late"], last["trip_duration_sec"]) == (4, 0, 290)


def test_silent_trips_close(spark, split_events):
    versions = jobs.run_to_table(
        trip_state.trip_features_stream(stream(spark, split_events), "event_id", "1 hour", idle_ms=1), "closing"
    )
    assert not versions.where("closed").isEmpty()


@pytest.mark.parametrize("salts", [1, 4])
def test_dedup_keeps_one_row_per_key(spark, split_events, salts):
    source = stream(spark, split_events)
    doubled = source.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = jobs.run_to_table(jobs.deduplicate(doubled, "2 hours", salts=salts).select("bookingID", "second"), "dedup")
    assert once.count() == once.distinct().count() > 0


def test_a_restarted_stream_goes_on_where_it_stopped(spark, split_events, tmp_path):
    where = {"path": str(tmp_path / "out"), "progress": str(tmp_path / "progress")}
    first = jobs.run_to_table(stream(spark, split_events), "clean", **where).count()
    assert first > 0 and jobs.run_to_table(stream(spark, split_events), "clean", **where).count() == first


def test_sink_adds_each_trip_once(spark, folder, tmp_path):
    path, rows = str(tmp_path / "features"), X.sensor(spark, folder)
    done = X.processed_trips(spark, folder)
    etl.update_features(keys.read_trips(rows, done), path, X.TIEBREAK)
    first = spark.read.parquet(path).count()
    for _ in range(2):
        etl.update_features(rows, path, X.TIEBREAK)
    both = spark.read.parquet(path)
    assert first < both.count() == both.select("bookingID").distinct().count() == rows.select("bookingID").distinct().count()


def test_master_needs_features_first(spark, folder, tmp_path):
    etl.refresh_master(
        X.safety_label(spark, folder), X.driver(spark, folder), str(tmp_path / "none"), str(tmp_path / "master")
    )
    assert writers.stored(spark, str(tmp_path / "master")) is None


def test_append_new_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "bookingID long, x string")
    writers.append_new(df, path)
    writers.append_new(df.unionByName(spark.createDataFrame([(3, "c")], df.schema)), path)
    assert sorted(r["bookingID"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_prediction_export_keeps_other_runs(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame(
        [(1, 0, "SAFE", 0.9, 0.1, 0.9)],
        "bookingID long, prediction int, prediction_label string, probability_safe double, probability_dangerous double, confidence double",
    )
    writers.export_predictions(rows, path, "one")
    writers.export_predictions(rows, path, "two")
    writers.export_predictions(rows, path, "two")
    assert spark.read.option("header", True).csv(path).groupBy("run_id").count().orderBy("run_id").collect()[1]["count"] == 1
    assert spark.read.option("header", True).csv(path).count() == 2


def test_headers_types_and_union(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    writers.write_csv(spark.createDataFrame([(1, 2, 3.5)], "booking_id long, second long, Speed double"), a)
    writers.write_csv(spark.createDataFrame([(4, 5, 0.5)], "bookingID long, second long, gyro_x double"), b)
    both = readers.read_csv_union(spark, [a, b])
    assert dict(both.dtypes) == {"bookingID": "bigint", "second": "bigint", "speed": "double", "gyro_x": "double"}
    assert sorted(tuple(r) for r in both.select("bookingID", "speed", "gyro_x").collect()) == [(1, 3.5, None), (4, None, 0.5)]


def test_stage_and_validation(spark, folder):
    sensor = X.sensor(spark, folder)
    assert readers.detect_stage(sensor.columns) == readers.RAW_SENSOR
    assert readers.detect_stage([" BOOKING_ID", *[c.upper() for c in S.REQUIRED_COLUMNS[1:]]]) == readers.RAW_SENSOR
    assert readers.detect_stage(["bookingID", *S.SERVING_FEATURES]) == readers.FEATURES_READY
    assert readers.detect_stage(["x"]) == readers.UNKNOWN
    assert readers.validate_input(sensor) == (True, "")
    assert readers.validate_input(sensor.drop("speed", "gyro_x")) == (False, "Missing required columns: speed, gyro_x")
    with pytest.raises(ValueError):
        etl.features_from_any_stage(sensor.select("bookingID"))


def test_unknown_trip_is_an_error(spark, folder):
    from odolytics.operators.scoring import LinearModel

    with pytest.raises(ValueError, match="no data found"):
        etl.score_trip(X.sensor(spark, folder), -1, LinearModel({"speed_mean": 1.0}, 0.0))


def test_text_sensor_columns_are_typed(spark):
    df = spark.createDataFrame([("7", "3", "x", "n/a"), ("8", "4.0", "y", "1.5")], "bookingID string, second string, note string, speed string")
    found = readers.cast_sensor(df)
    assert dict(found.dtypes) == {"bookingID": "bigint", "second": "bigint", "note": "string", "speed": "double"}
    assert [tuple(r) for r in found.collect()][0] == (7, 3, "x", None)


@pytest.mark.parametrize("forget", [None, 1])
def test_a_trip_that_resumes_goes_on_from_its_sums(spark, tmp_path, forget):
    """Rows, a long pause in which other trips arrive and the trip is closed, and more rows."""
    path, base = str(tmp_path / "in"), {**{c: 0.1 for c in S.CHANNELS}, "accuracy": 1.0}
    schema = "bookingID long, event_id long, second long, accuracy double, speed double, " + ", ".join(f"{c} double" for c in S.CHANNELS)
    names = [c.split()[0] for c in schema.split(", ")]
    seconds = [(1, 10), (1, 15), (1, 20), (2, 5000), (3, 7000), (3, 8000), (1, 9100), (1, 9110), (2, 20000)]
    for n, (trip, second) in enumerate(seconds):
        row = {**base, "bookingID": trip, "event_id": n, "second": second, "speed": float(n)}
        spark.createDataFrame([tuple(row[c] for c in names)], schema).withColumn(
            "event_time", F.timestamp_seconds(F.col("second") + 1_700_000_000)
        ).coalesce(1).write.mode("append").parquet(path)
    written = spark.read.parquet(path)
    versions = jobs.run_to_table(
        trip_state.trip_features_stream(
            jobs.read_files(spark, path, written.schema, 1), "event_id", "1 second", idle_ms=60_000, forget_ms=forget
        ), "resumed",
    )
    assert not versions.where("bookingID = 1 AND closed").isEmpty()
    last = plain(trip_state.latest(versions))
    whole = plain(trips.trip_features(written.drop("event_time"), tiebreak=X.TIEBREAK))
    if forget is None:
        brute.same(last, whole, 8)
    else:
        assert last[1]["n_points"] == 3 < whole[1]["n_points"]


def test_windows_open_at_the_end_come_out(spark, tmp_path):
    rows = spark.createDataFrame([(7, 1), (7, 2), (7, 100)], "bookingID long, n long").withColumns(
        {**{c: F.lit(0.1) for c in S.CHANNELS}, "speed": F.lit(1.0), "event_time": F.timestamp_seconds(F.col("n") + 1_700_000_000)}
    )
    path = str(tmp_path / "in")
    rows.coalesce(1).write.mode("append").parquet(path)
    jobs.end_of_input(rows, "bookingID", "event_time").coalesce(1).write.mode("append").parquet(path)
    source = jobs.read_files(spark, path, rows.schema, 1)
    found = jobs.without_end(jobs.run_to_table(jobs.window_features(source, delay="1 hour"), "open-windows"))
    assert sorted(r["n_points"] for r in found.collect()) == [1, 2]


def test_sink_keeps_trips_spread_over_batches_complete(spark, folder, split_events, tmp_path):
    path, schema = split_events
    rows, features = str(tmp_path / "rows"), str(tmp_path / "features")
    for _ in range(2):      # the second reading repeats every batch
        events = jobs.read_files(spark, path, schema, files_per_trigger=1)
        jobs.run_each_batch(
            X.sensor_from_events(events).drop("ts"), "sink", jobs.upsert_trips(rows, features, X.TIEBREAK)
        )
    assert spark.read.parquet(features).select("batch").distinct().count() > 1
    brute.same(
        plain(jobs.latest_trips(spark, features)), plain(trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK)), 8
    )


def test_triggers_follow_the_pieces_not_the_tasks_that_wrote_them(spark, folder, tmp_path):
    """A table of many files: every piece is written by several tasks, and still read by one trigger."""
    events = X.table(spark, folder, "events")
    events.repartition(8).write.parquet(str(tmp_path / "events.parquet"))
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        source = queries_streams._stream(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    files, batches = [], []

    def body(batch, number):
        batches.append(batch.count())
        files.append(len(batch.select(F.input_file_name()).distinct().collect()))

    jobs.run_each_batch(source, "pieces", body)
    assert max(files) > 1 and len(batches) <= 5
    assert sum(batches) == events.count() + 1


def test_state_rows_follow_the_buckets_and_partitions_are_given(spark, folder, split_events, tmp_path):
    versions = trip_state.trip_features_stream(stream(spark, split_events), "event_id", "1 hour", idle_ms=10**10, buckets=2)
    query = jobs.start(versions, str(tmp_path / "out"), str(tmp_path / "progress"), parts=3)
    query.awaitTermination()
    operator = query.lastProgress["stateOperators"][0]
    n_trips = X.sensor(spark, folder).select("bookingID").distinct().count()
    assert operator["numRowsTotal"] <= 3 * 2 < n_trips      # trips, list and timer of a bucket, however many trips it has
    assert operator["numStateStoreInstances"] % 3 == 0 and spark.conf.get(session.PARTS) == "4"
    latest = trip_state.latest(spark.read.schema(versions.schema).parquet(str(tmp_path / "out")))
    brute.same(plain(latest), plain(trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK)), 8)


class Store:
    """State variables of one bucket in memory."""

    def __init__(self):
        self.value, self.rows, self.entries, self.timers = None, [], {}, set()

    def getValueState(self, *_):
        return types.SimpleNamespace(exists=lambda: self.value is not None, get=lambda: self.value, update=lambda v: setattr(self, "value", v))

    def getListState(self, *_):
        return types.SimpleNamespace(get=lambda: iter(list(self.rows)), appendValue=self.rows.append, clear=self.rows.clear)

    def getMapState(self, *_):
        e = self.entries
        return types.SimpleNamespace(containsKey=e.__contains__, getValue=e.get, updateValue=e.__setitem__, removeKey=e.pop)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_a_bucket_of_trips_that_close_rest_and_resume(monkeypatch):
    """Rows of twenty trips out of order; closed ones are put away and come back. Every trip ends as if folded at once."""
    monkeypatch.setattr(trip_state, "MOST_CLOSED", 2)
    monkeypatch.setattr(trip_state, "BLOCK_ROWS", 3)
    dice = np.random.default_rng(11)
    store, processor = Store(), trip_state.TripProcessor(1000, S.Thresholds(), None)
    processor.init(store)
    every, shown, was_away, watermark = [], {}, 0, 0
    for batch in range(60):
        n = int(dice.integers(1, 8))
        second = batch * 10 + dice.integers(0, 15, n)
        frame = pd.DataFrame({S.KEY: (dice.integers(0, 3, n) + 3 * (batch // 9)) % 20 + 2**60, "second": second.astype(float), "tie": batch * 100.0 + np.arange(n)})
        for c in ["speed", *S.CHANNELS]:
            frame[c] = np.where(dice.random(n) < 0.2, np.nan, dice.normal(0, 3, n))
        frame["event_time"] = pd.to_datetime(frame["second"] * 100, unit="ms")
        every.append(frame)
        clock = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        out = list(processor.handleInputRows((0,), iter([frame.iloc[: n // 2], frame.iloc[n // 2 :]]), clock))
        for at in sorted(t for t in store.timers if t < watermark):
            out += processor.handleExpiredTimer((0,), clock, types.SimpleNamespace(getExpiryTimeInMs=lambda: at))
            store.timers.discard(at)
        for row in pd.concat(out).to_dict("records"):
            shown[row[S.KEY]] = row
        was_away = max(was_away, len(store.entries))
        watermark = max(watermark, int(second.max()) * 100 - 1500)
    assert was_away > 2 and not any(r["n_late"] for r in shown.values())
    rows = pd.concat(every)
    ids, trip = np.unique(rows[S.KEY], return_inverse=True)
    wide = np.column_stack([*[rows[c] for c in trip_state.LAST], np.zeros(len(rows)), np.arange(len(rows))])
    whole = trip_state._start(len(ids), 0)
    for one in range(len(ids)):         # one trip at a time
        trip_state._fold(whole, *trip_state._sorted(wide[trip == one], trip[trip == one]), S.Thresholds())
    want = {r[S.KEY]: r for r in trip_state._features(ids, whole, False, S.Thresholds()).to_dict("records")}
    assert set(shown) == set(want)
    for key, row in want.items():
        for c in S.TRIP_FEATURES:
            assert (pd.isna(row[c]) and pd.isna(shown[key][c])) or shown[key][c] == pytest.approx(row[c], abs=1e-9)
