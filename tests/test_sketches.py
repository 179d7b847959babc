"""Stored quantile sketches: merging loads, limits and fences, and their rank error."""

import math
import random

import pytest
from pyspark.sql import functions as F

from odolytics.functions import sketches
from odolytics.operators import cleaning, profile


@pytest.fixture(scope="module")
def rows(spark):
    dice = random.Random(2)
    made = [(i, dice.gauss(0, 1), 7.0 if i % 3 else dice.random(), None if i % 5 else float(i % 11), math.nan if i % 2 else 1.0) for i in range(20_000)]
    return spark.createDataFrame(made, "id long, smooth double, tied double, holes double, strange double")


COLUMNS = ["smooth", "tied", "holes", "strange"]


def test_merged_loads_keep_the_rank_error(spark, rows, tmp_path):
    path, k = str(tmp_path / "s"), 400
    for n in range(5):
        sketches.add_load(rows.where(F.col("id") % 5 == n), {c: F.col(c) for c in COLUMNS}, path, f"{n}", k)
    estimates = sketches.estimated(sketches.merged(spark, path, COLUMNS), [0.0, 0.1, 0.5, 0.9, 0.999, 1.0])
    room = 2 * sketches.rank_error(k)
    for r in sketches.rank_bounds(rows, estimates, COLUMNS).collect():
        assert r["below"] - room <= r["probability"] <= r["upto"] + room, r


def test_a_new_load_changes_the_limits_without_the_old_rows(spark, rows, tmp_path):
    path, columns = str(tmp_path / "s"), {"smooth": F.abs("smooth")}
    sketches.add_load(rows, columns, path, "first")
    before = sketches.limits(sketches.merged(spark, path, ["smooth"])).first()["limit_value"]
    exact = cleaning.derive_limits(rows, ["smooth"]).first()["limit_value"]
    assert before == pytest.approx(exact, rel=0.1)
    more = rows.withColumn("smooth", F.col("smooth") * 10)
    sketches.add_load(more, columns, path, "second")
    after = sketches.limits(sketches.merged(spark, path, ["smooth"])).first()["limit_value"]
    both = cleaning.derive_limits(rows.union(more), ["smooth"]).first()["limit_value"]
    assert after == pytest.approx(both, rel=0.1) and after > 3 * before
    assert sketches.limits(sketches.merged(spark, path, ["smooth"], ["first"])).first()["limit_value"] == before
    sketches.add_load(more, columns, path, "second")        # repeated
    assert spark.read.parquet(path).agg(F.sum("n_rows")).first()[0] == 40_000


def test_fences_are_those_of_the_scan(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    sketches.add_load(rows, {"smooth": F.col("smooth")}, path, "all")
    got = sketches.fences(sketches.merged(spark, path, ["smooth"])).first()
    want = profile.iqr_outliers(rows, ["smooth"]).first()
    for name in ("q1", "q3", "lower_bound", "upper_bound"):
        assert got[name] == pytest.approx(want[name], abs=0.05)


def test_empty_loads_and_columns_without_values(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    sketches.add_load(rows.where("false"), {c: F.col(c) for c in COLUMNS}, path, "none")
    assert sketches.merged(spark, path, COLUMNS).count() == 0
    sketches.add_load(rows.withColumn("holes", F.lit(None).cast("double")), {c: F.col(c) for c in COLUMNS}, path, "some")
    assert {r["feature"] for r in sketches.merged(spark, path, COLUMNS).collect()} == {"smooth", "tied", "strange"}
