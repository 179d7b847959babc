"""The shape of the plans: exchanges, scans, joins."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from odolytics.operators import cleaning, keys, profile, separation, trips
from odolytics.session import sized_for
from odolytics.sources import fixtures as X
from odolytics.sources import writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def count(df, what):
    return len(re.findall(rf"\b{what}\b", plan(df)))


def test_features_need_one_exchange_and_one_sort(spark, folder):
    df = trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK)
    assert count(df, "Exchange hashpartitioning") == 1
    assert len(re.findall(r"Sort \[", plan(df))) == 1


def test_features_read_only_the_columns_they_need(spark, folder):
    text = plan(trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "props" not in read


def test_serving_features_skip_unused_work(spark, folder):
    df = trips.trip_features_serving(X.sensor(spark, folder), X.TIEBREAK)
    assert count(df, "Exchange hashpartitioning") == 1
    assert "is_zigzag" not in plan(df)


def test_labels_join_reuses_the_trip_partitioning(spark, folder):
    features = trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = keys.with_features(X.safety_label(spark, folder), features)
        assert count(df, "Exchange hashpartitioning") == 2      # sensor rows and labels, once each
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_bucketed_sensor_table_needs_no_exchange(spark, folder, tmp_path):
    spark.sql("DROP TABLE IF EXISTS sensor_by_trip")
    writers.write_bucketed(X.sensor(spark, folder), "sensor_by_trip", 4, order=["second", "event_id"], path=str(tmp_path / "t"))
    df = trips.trip_features(spark.table("sensor_by_trip"), tiebreak=X.TIEBREAK)
    assert count(df, "Exchange") == 0
    want = trips.trip_features(X.sensor(spark, folder), tiebreak=X.TIEBREAK)
    assert df.count() == want.count()
    spark.sql("DROP TABLE sensor_by_trip")


@pytest.mark.parametrize(
    "make",
    [
        lambda df: profile.missing_profile(df),
        lambda df: profile.corr_matrix(df, X.WIDE),
        lambda df: profile.skew_kurtosis(df, X.WIDE),
        lambda df: profile.scale_analysis(df, X.WIDE),
        lambda df: profile.high_corr_pairs(df, X.WIDE),
        lambda df: separation.class_separation(df, X.WIDE),
        lambda df: separation.gram_matrix(df, X.WIDE),
    ],
)
def test_profiles_scan_once(spark, folder, make):
    assert count(make(X.wide(spark, folder)), "FileScan") == 1


def test_orphans_are_counted_before_a_shuffled_join(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(keys.orphan_count(X.sensor(spark, folder), "bookingID", X.processed_trips(spark, folder), "bookingID"))
        assert text.index("LeftAnti") < text.rindex("partial_count")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SLOW = {"train_logistic", "train_random_forest", "train_gradient_boosting", "experiment_matrix", "grid_search",
        "random_search", "coef_importance", "tree_importance", "model_persist", "run_log"}


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in SLOW and not n.startswith(("stream", "sink"))))
def test_no_query_uses_a_cross_join(spark, folder, name):
    text = plan(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_cleaning_is_pushed_to_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "sensor")
    X.sensor(spark, folder).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(cleaning.filter_rows(spark.read.parquet(path)))
    assert "LessThanOrEqual(second,21600)" in text and "LessThanOrEqual(accuracy,50.0)" in text
    picked = plan(cleaning.select_trip(spark.read.parquet(path), 7))
    assert "EqualTo(bookingID,7)" in picked


def test_partition_settings_grow_with_the_input():
    small, large = sized_for(10**9, 8), sized_for(100 * 10**12, 4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 8
    assert int(large["spark.sql.shuffle.partitions"]) == 50_000


def test_incremental_ids_never_reach_the_driver(spark, folder):
    df = keys.new_trips(X.sensor(spark, folder), X.processed_trips(spark, folder))
    assert df.select(F.col("bookingID")).columns == ["bookingID"] and "LeftAnti" in plan(df)
