"""Nearest-neighbour mutual information against the formula row by row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from odolytics.operators import neighbours


def psi(n):
    return -0.57721566490153286 + sum(1.0 / i for i in range(1, int(n)))


def plain(x, y, k):
    x, y = np.array(x, float), np.array(y)
    sizes = {c: int((y == c).sum()) for c in set(y.tolist())}
    keep = np.array([sizes[c] > 1 for c in y.tolist()], bool)
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        own = sizes[y[i].item()]
        near = min(k, own - 1)
        r = np.sort(np.abs(np.delete(x, i)[np.delete(y, i) == y[i]] - x[i]))[near - 1]
        m = int((np.abs(x - x[i]) < r).sum()) if r > 0 else int((x == x[i]).sum())
        total += psi(near) - psi(own) - psi(m)
    return max(0.0, psi(len(x)) + total / len(x)) if len(x) else None


def columns(n, seed):
    dice = random.Random(seed)
    label = [dice.choice([0, 0, 1, 2]) for _ in range(n)]
    return label, {
        "smooth": [dice.gauss(c, 1) for c in label],
        "grid": [dice.randrange(40) * 0.1 + 0.3 * c for c in label],
        "few": [float(dice.randrange(3)) for _ in label],
        "third": [7.0 if i % 3 == 0 else dice.gauss(7, 2) for i in range(n)],
        "one": [1.5] * n,
        "far": [1e300 if i == 5 else dice.random() * 1e-9 for i in range(n)],
    }


@pytest.mark.parametrize("k,pieces", [(5, 1), (5, 23), (1, 4), (3, 60)])
def test_scores_equal_the_formula(spark, k, pieces):
    label, data = columns(400, k)
    df = spark.createDataFrame(list(zip(label, *data.values())), "label int, " + ", ".join(f"{c} double" for c in data))
    found = {r["feature"]: r["mi"] for r in neighbours.mutual_information_neighbours(df, list(data), k=k, pieces=pieces).collect()}
    for name, x in data.items():
        assert found[name] == pytest.approx(plain(x, label, k), abs=1e-9), name


def test_small_classes_missing_values_and_labels(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, 1.0), (0, None), (0, nan), (0, 0.0), (0, -0.0), (1, 2.0), (1, 2.5), (2, 9.0), (None, 4.0), (0, 1.0 + 2e-16), (3, inf), (3, -inf), (3, 1.0)]
    df = spark.createDataFrame(rows, "label int, x double")
    big = np.finfo(float).max
    x = [0.0 if v is None or v != v else max(-big, min(big, v)) for c, v in rows if c is not None]
    with np.errstate(over="ignore"):
        want = plain(x, [c for c, _ in rows if c is not None], 5)
    assert neighbours.mutual_information_neighbours(df, ["x"], pieces=3).first()["mi"] == pytest.approx(want, abs=1e-9)


def test_nothing_gives_nothing(spark):
    df = spark.createDataFrame([], "label int, x double")
    assert neighbours.mutual_information_neighbours(df, ["x"]).count() == 0
    assert neighbours.mutual_information_neighbours(spark.createDataFrame([(0, 1.0), (1, 2.0)], "label int, x double"), ["x"]).count() == 0


def test_many_copies_of_one_row_stay_a_few_rows(spark):
    df = spark.range(200_000).select((F.col("id") % 2).cast("int").alias("label"), F.lit(3.0).alias("x"))
    found = neighbours.mutual_information_neighbours(df, ["x"]).first()["mi"]
    assert found == pytest.approx(0.0, abs=1e-4)


def test_digamma(spark):
    for n in (1, 2, 3, 10, 1000):
        got = spark.range(1).select(neighbours.digamma(F.lit(n))).first()[0]
        assert got == pytest.approx(psi(n), abs=1e-10)
