"""Quantiles, evaluation and statistics against brute force, with the large-data way forced."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odolytics.functions import quantiles
from odolytics.functions.counts import bin_counts
from odolytics.functions.quantiles import quantile_values
from odolytics.operators import evaluation, prepare, profile, separation
from odolytics.sources import fixtures as X

PROBABILITIES = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]


def column_of(kind, n=3000, seed=1):
    r = random.Random(seed)
    return {
        "smooth": [r.gauss(0, 1) for _ in range(n)],
        "third equal": [7.0 if i % 3 == 0 else r.gauss(7, 2) for i in range(n)],
        "few values": [float(r.randrange(4)) for _ in range(n)],
        "one value": [3.5] * n,
        "outlier": [r.random() for _ in range(n - 1)] + [1e12],
        "holes": [None if i % 5 == 0 else r.random() for i in range(n)],
    }[kind]


KINDS = ["smooth", "third equal", "few values", "one value", "outlier", "holes"]


@pytest.mark.parametrize("values_per_task", [2_000_000, 300])
def test_quantiles_are_exact(spark, values_per_task):
    data = {k: column_of(k) for k in KINDS}
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"`{k}` double" for k in KINDS))
    df = df.toDF(*[k.replace(" ", "_") for k in KINDS])
    names = [k.replace(" ", "_") for k in KINDS]
    found = quantile_values(df, names, PROBABILITIES, values_per_task=values_per_task)
    for kind, name in zip(KINDS, names):
        known = np.array([v for v in data[kind] if v is not None])
        for p in PROBABILITIES:
            want = float(np.quantile(known, p))
            assert abs(found[name, p] - want) <= 1e-9 * max(1.0, abs(want)), (kind, p, found[name, p], want)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert quantile_values(df, ["a", "b"], [0.5]) == {("a", 0.5): None, ("b", 0.5): 1.0}


def scored(spark, n=400, seed=2, distinct=37):
    r = random.Random(seed)
    rows = [(i, r.randrange(distinct) / distinct, int(r.random() < 0.3), "a" if i % 3 else "b") for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, p double, label int, part string")


def pair_auc(rows):
    pos, neg = [p for _, p, y, _ in rows if y], [p for _, p, y, _ in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_task", [1_000_000, 5])
def test_auc_equals_pair_counting(spark, rows_per_task):
    rows, df = scored(spark)
    assert evaluation.roc_auc(df, rows_per_task=rows_per_task).first()["roc_auc"] == pytest.approx(pair_auc(rows))
    by = {r["part"]: r["roc_auc"] for r in evaluation.roc_auc(df, by=["part"], rows_per_task=rows_per_task).collect()}
    for part in "ab":
        assert by[part] == pytest.approx(pair_auc([r for r in rows if r[3] == part]))


def test_curves_are_the_same_when_cut(spark):
    _, df = scored(spark)
    for curve in (evaluation.roc_curve, evaluation.pr_curve):
        whole, cut = curve(df, by=["part"]), curve(df, by=["part"], rows_per_task=4)
        assert whole.exceptAll(cut).isEmpty() and whole.count() == cut.count()
    assert evaluation.pr_auc(df).first()[0] == pytest.approx(evaluation.pr_auc(df, rows_per_task=4).first()[0])


def test_metrics_without_positives_are_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, label int")
    m = evaluation.classification_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"], m["roc_auc"]) == (1.0, 0.0, 0.0, 0.0, None)


def test_threshold_policies_fall_back_and_break_ties(spark):
    sweep = spark.createDataFrame(
        [(0.1, 0.5, 0.1, 0.55, 0.2), (0.2, 0.7, 0.1, 0.55, 0.2), (0.3, 0.7, 0.3, 0.1, 0.2)],
        "threshold double, accuracy double, precision double, recall double, f1 double",
    )
    found = {r["policy"]: r["threshold"] for r in evaluation.threshold_select(sweep).where("policy IS NOT NULL").collect()}
    assert found["accuracy_with_recall_60"] == 0.2      # none reaches the recall: highest recall, higher threshold
    assert found["best_f1"] == 0.1 and found["best_accuracy"] == 0.2
    assert found["f1_with_recall_70"] is None and found["recall_with_precision_40"] is None


def test_sweep_counts_a_score_on_the_threshold_as_positive(spark):
    df = spark.createDataFrame([(0.25, 1), (0.2499999, 0), (None, 1)], "p double, label int")
    row = evaluation.threshold_sweep(df, [0.25, 0.5]).orderBy("threshold").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 0, 1)


def test_balanced_f1_penalty(spark):
    df = spark.createDataFrame([(0.5, 0.65), (0.5, 0.45), (0.01, 0.0)], "f1 double, recall double")
    found = [r[0] for r in df.select(evaluation.balanced_f1(F.col("f1"), F.col("recall"))).collect()]
    assert found == [0.5, pytest.approx(0.44), 0.0]


def test_student_p_values():
    """Tabulated two-sided critical values."""
    for t, dof, p in [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.960, 10**7, 0.05), (0.0, 5, 1.0)]:
        assert separation.student_p_value(t, dof) == pytest.approx(p, abs=2e-4)


def test_vif_equals_regression(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(2, 1, (200, 3))
    x[:, 2] = x[:, 0] + 0.1 * rng.normal(size=200)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    found = {r["feature"]: r["vif"] for r in separation.vif(df, ["a", "b", "c"]).collect()}
    for i, name in enumerate("abc"):
        others = np.delete(x, i, axis=1)
        left = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert found[name] == pytest.approx((x[:, i] ** 2).sum() / (left ** 2).sum(), rel=1e-8)


def test_constant_feature(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 0), (1.0, 1)], "a double, label int")
    r = separation.class_separation(df, ["a"]).first()
    assert r["cohens_d"] == 0.0 and r["t_stat"] is None
    assert [r["n_rows"] for r in profile.class_histogram(df, ["a"]).where("n_rows > 0").collect()] == [2, 2]
    assert profile.scale_analysis(df, ["a"]).first()["scale_ratio"] is None


@pytest.mark.parametrize("bits", [15, 2])
def test_split_is_exact_and_whole(spark, bits, monkeypatch):
    monkeypatch.setattr(prepare, "BUCKET_BITS", bits)
    df = spark.createDataFrame([(i * 1_700_000_001, int(i % 4 == 0)) for i in range(400)], "bookingID long, label int")
    out = prepare.stratified_split(df)
    assert out.select("bookingID").distinct().count() == out.count() == 400
    sizes = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert sizes == {(0, "train"): 180, (0, "val"): 60, (0, "test"): 60, (1, "train"): 60, (1, "val"): 20, (1, "test"): 20}


def test_split_does_not_depend_on_the_way(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(200)], "bookingID long, label int")
    a = prepare.stratified_split(df)
    b = prepare.stratified_split(df.repartition(5))
    assert a.exceptAll(b.select(*a.columns)).isEmpty()


def test_median_and_scaling_use_the_fitting_rows(spark):
    df = spark.createDataFrame([(1.0, "t"), (3.0, "t"), (None, "t"), (100.0, "v"), (None, "v")], "a double, s string")
    fit = df.where("s = 't'")
    assert sorted(r["a"] for r in prepare.impute_median(df, ["a"], fit).collect()) == [1.0, 2.0, 2.0, 3.0, 100.0]
    assert prepare.scaling(fit, ["a"])["a"] == (2.0, 1.0)
    assert prepare.scaling(df.where("a = 100"), ["a"])["a"] == (100.0, 1.0)


def test_a_seed_changes_about_half_of_what_it_can(spark):
    ids = spark.range(20_000).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    splits = {s: {r["id"]: r["split"] for r in prepare.stratified_split(ids, "id", seed=s).collect()} for s in (42, 43, 7)}
    for a, b in ((42, 43), (42, 7)):
        moved = sum(splits[a][i] != splits[b][i] for i in splits[a]) / 20_000
        assert 0.5 < moved < 0.62        # 1 - (0.6**2 + 0.2**2 + 0.2**2) = 0.56


def test_slices_are_even_for_regular_ids(spark):
    for step in (1, 4, 4096, 2**31):
        for slices in (2, 4, 8):
            ids = spark.range(8_000).select((F.col("id") * step).alias("id"))
            counts = [r["count"] for r in ids.groupBy(prepare.slice_of("id", F.lit(slices))).count().collect()]
            assert len(counts) == slices and max(counts) < 1.2 * 8_000 / slices


def test_brackets_that_samples_do_not_narrow_are_halved(spark, monkeypatch):
    """Samples that always propose the whole bracket: halving alone must get there, within the limit."""
    percentile = quantiles.F.percentile

    def nowhere(df, targets, again):
        for t in targets:
            t.slack *= 100

    monkeypatch.setattr(quantiles, "_narrow", nowhere)
    rows = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") - 2_500) * 1e-5 * F.pow(F.lit(10.0), F.col("id") % 7)).alias("x")
    )
    wanted = [0.001, 0.25, 0.5, 0.9, 0.999]
    found = quantiles.quantile_values(rows, ["x"], wanted, values_per_task=20)
    exact = rows.agg(percentile("x", F.array(*map(F.lit, wanted)))).first()[0]
    assert [found["x", p] for p in wanted] == pytest.approx(exact, rel=1e-12)


def test_inflation_of_dependent_columns_is_infinite(spark, folder):
    rows = X.wide(spark, folder).withColumn("mix", F.col("l_quantity") + 3 * F.col("l_tax"))
    found = {r["feature"]: r for r in separation.vif(rows, ["l_quantity", "l_tax", "mix", "l_discount"]).collect()}
    assert all(math.isinf(found[c]["vif"]) and found[c]["too_high"] for c in ("l_quantity", "l_tax", "mix"))
    assert 1 <= found["l_discount"]["vif"] < 10
    alike = X.wide(spark, folder).select("l_quantity", F.col("l_quantity").alias("again"))
    assert all(math.isinf(r["vif"]) for r in separation.vif(alike, ["l_quantity", "again"]).collect())


def test_p_values_of_very_many_rows():
    assert separation.student_p_value(1.959963984540054, 1e11) == pytest.approx(0.05, rel=1e-9)
    for dof in (5e6, 2e7):     # both sides of the switch, against the normal value with its first correction
        z = 2.0 * (1 - 1 / (4 * dof)) / math.sqrt(1 + 4 / (2 * dof))
        assert separation.student_p_value(2.0, dof) == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-8)


def test_nearly_dependent_columns_keep_their_finite_inflation(spark):
    """One part in 10^8: its square is lost in sums of products."""
    dice = random.Random(8)
    rows = [(a, a + 1e-8 * e, b) for a, e, b in ((dice.gauss(0, 1), dice.gauss(0, 1), dice.gauss(0, 1)) for _ in range(4000))]
    df = spark.createDataFrame(rows, "a double, near double, b double").repartition(40)
    found = {r["feature"]: r["vif"] for r in separation.vif(df, ["a", "near", "b"]).collect()}
    x = np.array(rows)
    apart = (x[:, 1] - x[:, 0]) - ((x[:, 1] - x[:, 0]) @ x[:, 0]) / (x[:, 0] @ x[:, 0]) * x[:, 0]
    assert found["near"] == pytest.approx((x[:, 1] @ x[:, 1]) / (apart @ apart), rel=0.02) and found["near"] > 1e15
    assert found["b"] == pytest.approx(1.0, abs=0.01)


def test_factor_is_the_same_for_any_cut_of_the_rows(spark):
    dice = random.Random(9)
    rows = [tuple(dice.gauss(0, 1) for _ in range(4)) for _ in range(500)]
    want = np.array(rows).T @ np.array(rows)
    for parts in (1, 3, 70):
        r = separation.triangular_factor(spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(parts), list("abcd"))
        np.testing.assert_allclose(r.T @ r, want, rtol=1e-9)
    assert [v["vif"] for v in separation.vif(spark.createDataFrame([], "a double, b double"), ["a", "b"]).collect()] == [math.inf] * 2


def test_binned_density_keeps_its_stated_error(spark):
    dice = random.Random(10)
    values = [("wide", dice.gauss(0, 1)) for _ in range(900)] + [("far", dice.random() + (1e5 if i == 0 else 0)) for i in range(300)] + [("one", 2.0)]
    df = spark.createDataFrame(values + [("wide", None), (None, 1.0)], "g string, x double")
    found = separation.class_density(df, "x", "g").collect()
    assert sorted({r["group_name"] for r in found}) == ["far", "wide"] and len(found) == 400
    for name in ("wide", "far"):
        x = np.array([v for g, v in values if g == name])
        h = x.std(ddof=1) * len(x) ** -0.2
        room = 1 / (8 * separation.NODES ** 2 * math.sqrt(2 * math.pi) * h) + 1e-15
        for r in (r for r in found if r["group_name"] == name):
            exact = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
            assert abs(r["density"] - exact) <= room


def test_density_has_a_kernel_for_every_value(spark):
    """Equal to brute force to the last places, with equal, missing and far values; the binned form to its stated error."""
    dice = random.Random(11)
    values = [("wide", dice.gauss(0, 1)) for _ in range(500)] + [("wide", 0.25)] * 40 + [("far", dice.random() + (50 if i == 0 else 0)) for i in range(90)]
    df = spark.createDataFrame(values + [("wide", None), (None, 1.0), ("one", 2.0)], "g string, x double").repartition(5)
    exact, binned = separation.class_density(df, "x", "g").collect(), separation.binned_class_density(df, "x", "g").collect()
    assert len(exact) == len(binned) == 400
    for rows, off in ((exact, 1e-14), (binned, None)):
        for name in ("wide", "far"):
            x = np.array([v for g, v in values if g == name])
            h = x.std(ddof=1) * len(x) ** -0.2
            room = off or 1 / (8 * separation.NODES ** 2 * math.sqrt(2 * math.pi) * h) + 1e-15
            for r in (r for r in rows if r["group_name"] == name):
                want = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
                assert abs(r["density"] - want) <= room


def test_bin_counts_in_one_scan(spark):
    """Missing bins and classes, and many batches; the same counts as one group-by per column."""
    dice = random.Random(4)
    rows = [(dice.choice([None, "a", "b"]), dice.choice([None, 0, 1, 7]), dice.randrange(40)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "c string, x int, y int").repartition(7)
    found = {(r["label"], r["feature"], r["bin"]): r["n"] for r in bin_counts(df, "c", ["x", "y"]).collect()}
    want = Counter((c, n, v) for c, x, y in rows for n, v in (("x", x), ("y", y)) if v is not None)
    assert found == want
    assert bin_counts(df.where("false"), "c", ["x", "y"]).count() == 0


def test_histogram_leaves_missing_values_out(spark):
    df = spark.createDataFrame([(0, 1.0, None), (0, None, None), (0, 3.0, None), (1, 5.0, 2.0), (None, 9.0, 9.0)], "label int, a double, b double")
    found = {(r["label"], r["feature"]): r["n"] for r in profile.class_histogram(df, ["a", "b"], bins=4).groupBy("label", "feature").agg(F.sum("n_rows").alias("n")).collect()}
    assert found == {(0, "a"): 2, (1, "a"): 1, (1, "b"): 1}
