"""Second-order boosting against a plain greedy one, and its exported trees in SQL."""

import math
import random
import re

import duckdb
import numpy as np
import pytest

from odolytics.operators import boosting
from odolytics.operators.boosting import Settings, train_boosted

FEATURES = ["a", "b", "c"]


def made(n, seed=1):
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = dice.gauss(0, 1), float(dice.randrange(7)), dice.choice([None, dice.random()])
        rows.append((i, int(a + 0.3 * b + dice.gauss(0, 0.7) > 1), a, b, c, 1.0 + (i % 3)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, label int, a double, b double, c double, w double")


def plain(rows, s: Settings, weight=False):
    """Margins of a best-first greedy booster that looks at every threshold, one leaf at a time."""
    x = np.array([[v or 0.0 for v in r[2:5]] for r in rows])
    y = np.array([float(r[1]) for r in rows])
    w = np.array([r[5] if weight else 1.0 for r in rows]) * np.where(y > 0, s.positive_scale, 1.0)
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), math.log(share / (1 - share)) if s.from_average else 0.0)

    def shrunk(v):
        return math.copysign(max(abs(v) - s.l1, 0.0), v)

    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def best(rows_in):
            found = (-math.inf, None, None)
            for j in range(x.shape[1]):
                for t in np.unique(x[rows_in, j])[:-1]:
                    left = rows_in & (x[:, j] <= t)
                    right = rows_in & ~left
                    if min(left.sum(), right.sum()) < max(1, s.least_rows) or min(h[left].sum(), h[right].sum()) < s.least_weight:
                        continue
                    gain = 0.5 * (sum(shrunk(g[m].sum()) ** 2 / (h[m].sum() + s.l2) for m in (left, right)) - shrunk(g[rows_in].sum()) ** 2 / (h[rows_in].sum() + s.l2))
                    if gain > found[0] + 1e-9:
                        found = (gain, left, right)
            return found

        everything = np.ones(len(y), bool)
        leaves = [(everything, 0, best(everything))]
        while s.leaves is None or len(leaves) < s.leaves:
            open_leaves = [i for i, (_, d, f) in enumerate(leaves) if f[0] > max(s.least_gain, 1e-12) and (s.depth is None or d < s.depth)]
            if not open_leaves:
                break
            i = max(open_leaves, key=lambda k: leaves[k][2][0])
            _, d, (_, left, right) = leaves.pop(i)
            leaves += [(m, d + 1, best(m)) for m in (left, right)]
        for m, _, _ in leaves:
            margin[m] += -s.rate * shrunk(g[m].sum()) / (h[m].sum() + s.l2)
    return margin


@pytest.mark.parametrize("given", [
    {"depth": 3, "leaves": None}, {"depth": None, "leaves": 6, "least_weight": 0.5, "least_rows": 5, "from_average": True},
    {"depth": 4, "leaves": 9, "l1": 0.4, "l2": 0.3, "least_gain": 0.2, "positive_scale": 2.5, "refresh": 1},
])
def test_margins_equal_plain_greedy_boosting(spark, given):
    rows = made(150)
    s = Settings(rounds=4, rate=0.3, rows=1.0, columns=1.0, **given)
    model = train_boosted(frame(spark, rows).repartition(5), FEATURES, weight="w", settings=s)
    scored = {r["id"]: r["probability_dangerous"] for r in model.probability(frame(spark, rows)).collect()}
    for r, m in zip(rows, plain(rows, s, weight=True)):
        assert scored[r[0]] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-9)
    assert max(len([f for f in t.feature if f < 0]) for t in model.trees) <= (s.leaves or math.inf)
    assert max(max(t.depth) for t in model.trees) <= (s.depth if s.depth is not None else math.inf)


def test_exported_expression_gives_the_same_scores(spark):
    rows = made(120, 3)
    model = train_boosted(frame(spark, rows), FEATURES, rounds=3, leaves=8)
    scored = {r["id"]: r["probability_dangerous"] for r in model.probability(frame(spark, rows)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, label INT, a DOUBLE, b DOUBLE, c DOUBLE, w DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", rows)
    for i, p in con.execute(f"SELECT id, 1 / (1 + exp(-({model.sql()}))) FROM t").fetchall():
        assert scored[i] == pytest.approx(p, abs=1e-12)
    splits = model.splits(spark).collect()
    assert {(r["tree"], r["node"]) for r in splits} == {(t, n) for t, tree in enumerate(model.trees) for n in range(len(tree.feature))}
    assert all((r["feature"] is None) == (r["left"] is None) for r in splits)
    assert sum(model.importance().values()) == pytest.approx(1.0)


def test_passes_and_refreshes_do_not_change_the_model(spark, monkeypatch):
    rows = frame(spark, made(100, 5)).coalesce(2)
    one = train_boosted(rows, FEATURES, rounds=5, leaves=7, refresh=50)
    monkeypatch.setattr(boosting, "PASS_BYTES", 1)
    two = train_boosted(rows, FEATURES, rounds=5, leaves=7, refresh=2)
    assert [t.feature for t in one.trees] == [t.feature for t in two.trees]
    np.testing.assert_allclose(np.concatenate([t.value for t in one.trees]), np.concatenate([t.value for t in two.trees]), atol=1e-12)


def test_one_class_no_rows_and_missing_labels(spark):
    rows = [(i, 1, float(i), 0.0, None, 1.0) for i in range(5)]
    assert train_boosted(frame(spark, rows), FEATURES, rounds=2).trees == []
    empty = train_boosted(frame(spark, []), FEATURES, rounds=2)
    assert [r["probability_dangerous"] for r in empty.probability(frame(spark, rows)).collect()] == [0.5] * 5
    mixed = made(60, 6)
    model = train_boosted(frame(spark, mixed + [(99, None, 50.0, 0.0, 0.0, 1.0)]), FEATURES, rounds=1, rows=1.0)
    assert model.trees[0].rows[0] == 60


def test_a_pass_is_shuffled_into_as_many_parts_as_its_sums_need(spark, monkeypatch):
    """One part for few sums, more for many, up to the session's; the same sums however they are dealt."""
    rng = np.random.default_rng(3)
    rows = [(i, float(i % 2), 1.0, 0.0, bytearray(rng.integers(0, 16, 3, dtype=np.uint8).tobytes())) for i in range(400)]
    table = spark.createDataFrame(rows, boosting._TABLE).repartition(3)
    work = boosting._Pass([], boosting.Tree(), [0], 3, Settings(bins=16, rows=1.0), 0)
    found = []
    for most, parts in ((boosting.SUM_ROWS, 1), (100, 2), (1, 4)):
        monkeypatch.setattr(boosting, "SUM_ROWS", most)
        sums = boosting._added_up(table, work)
        plan = sums._jdf.queryExecution().executedPlan().toString()
        # The other exchange deals the table itself.
        assert plan.count("Exchange") == 2
        assert "Exchange SinglePartition" in plan if parts == 1 else re.search(rf"hashpartitioning\(cell#\d+L?, {parts}\)", plan)
        found.append(next(boosting._sums(table, work)))
    bins = np.array([list(r[4]) for r in rows])
    want = np.array([np.bincount(bins[:, j], minlength=16) for j in range(3)])
    for each in found:
        np.testing.assert_array_equal(each[2], want)
        np.testing.assert_allclose(each[0], found[0][0], atol=1e-9)


@pytest.mark.parametrize("given", [{"depth": 3}, {"depth": None, "leaves": 6, "least_rows": 5, "from_average": True}])
def test_a_table_held_by_one_task_gives_the_trees_of_a_table_passed_over_by_all(spark, monkeypatch, given):
    rows, s = made(150, 8), Settings(rounds=5, rate=0.3, rows=0.7, columns=0.7, refresh=2, **given)
    jobs = spark.sparkContext.statusTracker()

    def fit(name):
        spark.sparkContext.setJobGroup(name, name)
        try:
            return train_boosted(frame(spark, rows).repartition(5), FEATURES, weight="w", settings=s), len(jobs.getJobIdsForGroup(name))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    held, few = fit("held")
    monkeypatch.setattr(boosting, "HELD_BYTES", 0)
    monkeypatch.setattr(boosting, "PASS_BYTES", 1)
    spread, many = fit("spread")
    assert few + 2 * s.rounds < many      # its jobs do not follow the trees and their depth
    for one, other in zip(held.trees, spread.trees, strict=True):
        assert (one.feature, one.cut, one.left, one.depth) == (other.feature, other.cut, other.left, other.depth)
        np.testing.assert_allclose(one.value, other.value, atol=1e-12)
        np.testing.assert_array_equal(one.rows, other.rows)


def test_margins_of_a_table_passed_over_by_all_equal_plain_greedy_boosting(spark, monkeypatch):
    monkeypatch.setattr(boosting, "HELD_BYTES", 0)
    rows = made(150)
    s = Settings(rounds=3, rate=0.3, rows=1.0, columns=1.0, depth=4, leaves=9, l1=0.4, least_gain=0.2, positive_scale=2.5, refresh=1)
    model = train_boosted(frame(spark, rows).repartition(5), FEATURES, weight="w", settings=s)
    scored = {r["id"]: r["probability_dangerous"] for r in model.probability(frame(spark, rows)).collect()}
    for r, m in zip(rows, plain(rows, s, weight=True)):
        assert scored[r[0]] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-9)
