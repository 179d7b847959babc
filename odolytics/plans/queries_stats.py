"""Profiles, statistics, and classifier evaluation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from odolytics import schema as S
from odolytics.functions import sketches
from odolytics.operators import cleaning, evaluation, neighbours, prepare, profile, scoring, separation
from odolytics.plans import oracle_parts as P
from odolytics.plans.registry import query, rounded
from odolytics.plans.queries_ingest import sensor
from odolytics.session import cut_lineage, work_path
from odolytics.sources import fixtures as X

FEATURES = X.WIDE
WIDE = f"WITH {P.WIDE}"
SCORED = f"WITH {P.SCORED}"


def _each(columns, select, source="wide", prefix=WIDE):
    return f"{prefix} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, {select(c)} FROM {source}" for c in columns)


# Profiles ------------------------------------------------------------------------

@query(
    "class_balance",
    f"""{SCORED}, c AS (SELECT l_linestatus, label, count(*) AS n_rows FROM scored GROUP BY 1, 2),
    t AS (SELECT l_linestatus, sum(n_rows) AS n, sum(n_rows) FILTER (label = 0) AS n0, sum(n_rows) FILTER (label = 1) AS n1
          FROM c GROUP BY 1)
    SELECT c.l_linestatus, label, n_rows, {P.r("n_rows::DOUBLE / n * 100", name="pct")},
      {P.r("n0::DOUBLE / n1", name="safe_to_dangerous")}, n0::DOUBLE / n1 > 3 AS imbalanced
    FROM c JOIN t USING (l_linestatus)""",
)
def class_balance(spark, folder):
    return rounded(profile.class_balance(X.scored(spark, folder), by=["l_linestatus"]))


MISSING = ["bookingID", "event_id", "second", "accuracy", "speed", *S.CHANNELS]


@query(
    "missing_profile",
    _each(
        MISSING,
        lambda c: f'count(*) - count("{c}") AS missing_count, '
        + P.r(f'(count(*) - count("{c}"))::DOUBLE / count(*) * 100', name="missing_pct"),
        "clean", f"WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN}",
    ),
)
def missing_profile(spark, folder):
    return rounded(profile.missing_profile(cleaning.clean_sensor(sensor(spark, folder))))


@query(
    "describe_features",
    _each(
        FEATURES,
        lambda c: f"count({c}) AS n, " + ", ".join(
            P.r(e, 3, n) for n, e in {
                "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})",
                "p25": f"quantile_cont({c}, 0.25)", "p50": f"quantile_cont({c}, 0.5)", "p75": f"quantile_cont({c}, 0.75)",
                "max": f"max({c})",
            }.items()
        ),
    ),
)
def describe_features(spark, folder):
    return rounded(profile.describe(X.wide(spark, folder), FEATURES), 3)


@query(
    "iqr_outliers",
    "WITH " + P.WIDE + ", events_value AS (SELECT value, event_id::DOUBLE AS event_id FROM events) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {P.rounded(["q1", "q3"], 4)}, {P.r("q1 - 1.5 * (q3 - q1)", 4, "lower_bound")},
        {P.r("q3 + 1.5 * (q3 - q1)", 4, "upper_bound")},
        count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers,
        {P.r(f"count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))::DOUBLE / count(*) * 100", 4, "outlier_pct")}
        FROM events_value, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM events_value) GROUP BY q1, q3"""
        for c in ["value", "event_id"]
    ),
)
def iqr_outliers(spark, folder):
    return rounded(profile.iqr_outliers(X.table(spark, folder, "events"), ["value", "event_id"]), 4)


@query(
    "class_histogram",
    f"""{WIDE}, long AS ({" UNION ALL ".join(f"SELECT label, '{c}' AS feature, {c}::DOUBLE AS value FROM wide" for c in FEATURES)}),
    span AS (SELECT label, feature, min(value) AS low, max(value) AS high FROM long GROUP BY 1, 2),
    counted AS (SELECT label, feature, least(floor((value - low) / (high - low) * 30), 29)::INT AS bin, count(*) AS n
      FROM long JOIN span USING (label, feature) GROUP BY 1, 2, 3),
    grid AS (SELECT label, feature, low, high, unnest(range(30))::INT AS bin FROM span)
    SELECT label, feature, bin, {P.r("low + bin * ((high - low) / 30)", 4, "bin_start")}, coalesce(n, 0) AS n_rows
    FROM grid LEFT JOIN counted USING (label, feature, bin)""",
)
def class_histogram(spark, folder):
    return rounded(profile.class_histogram(X.wide(spark, folder), FEATURES), 4)


CORR_COLUMNS = [*FEATURES, "label"]


@query(
    "corr_matrix",
    f"{WIDE} " + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {P.r(f'corr({a}, {b})', name='r')} FROM wide"
        for a in CORR_COLUMNS for b in CORR_COLUMNS
    ),
)
def corr_matrix(spark, folder):
    return rounded(profile.corr_matrix(X.wide(spark, folder), CORR_COLUMNS))


@query(
    "target_corr_topk",
    f"{WIDE}, c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, label)) AS abs_r FROM wide" for c in FEATURES)
    + f""") SELECT feature, {P.r("abs_r")}, CASE WHEN abs_r > 0.15 THEN 'strong' WHEN abs_r > 0.10 THEN 'some' ELSE 'weak' END AS band
    FROM c ORDER BY abs_r DESC, feature LIMIT 10""",
)
def target_corr_topk(spark, folder):
    return rounded(profile.target_correlation(X.wide(spark, folder), FEATURES))


PAIRED = ["speed_max", "speed_mean", "speed_std", "accel_mag_mean", "accel_mag_max", "gyro_mag_mean", "gyro_mag_std",
          "pct_time_high_gyro", "pct_time_high_accel", "pct_time_smooth", "n_points", "n_hard_turns"]


@query(
    "high_corr_pairs",
    f"WITH {P.FEATURES}, c AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, abs(corr({a}, {b})) AS abs_r FROM features"
        for a, b in combinations(PAIRED, 2)
    ) + f") SELECT feature_a, feature_b, {P.r('abs_r')} FROM c WHERE abs_r > 0.8",
)
def high_corr_pairs(spark, folder):
    return rounded(profile.high_corr_pairs(X.trip_table(spark, folder), PAIRED))


def _moments(c, source):
    return f"""SELECT '{c}' AS feature, avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) AS skew,
      avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3 AS kurtosis
      FROM {source}, (SELECT avg({c}) AS m FROM {source})"""


@query(
    "skew_kurtosis",
    f"{WIDE}, c AS (" + " UNION ALL ".join([*(_moments(c, "wide") for c in FEATURES)])
    + f""") SELECT feature, {P.rounded(["skew", "kurtosis"])}, CASE WHEN abs(skew) < 0.5 THEN 'Normal' WHEN skew > 1 THEN 'Right-skewed'
      WHEN skew < -1 THEN 'Left-skewed' ELSE 'Moderate skew' END AS distribution FROM c""",
)
def skew_kurtosis(spark, folder):
    return rounded(profile.skew_kurtosis(X.wide(spark, folder), FEATURES))


@query("log1p_skewed", f"SELECT event_id, {P.r('value')}, {P.r('ln(1 + value)', name='value_log')} FROM events")
def log1p_skewed(spark, folder):
    events = X.table(spark, folder, "events").select("event_id", "value")
    return rounded(profile.log1p_skewed(events, ["event_id", "value"]))


@query(
    "scale_analysis",
    f"{WIDE}, c AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c}) AS lo, max({c}) AS hi, avg({c}) AS mean, stddev_samp({c}) AS std FROM wide" for c in FEATURES
    ) + f"""), x AS (SELECT *, hi - lo AS value_range, (hi - lo) / (SELECT min(hi - lo) FROM c) AS scale_ratio FROM c)
    SELECT feature, {P.r("lo", 4, "min")}, {P.r("hi", 4, "max")}, {P.rounded(["mean", "std", "value_range", "scale_ratio"], 4)},
      scale_ratio > 100 AS needs_scaling FROM x""",
)
def scale_analysis(spark, folder):
    return rounded(profile.scale_analysis(X.wide(spark, folder), FEATURES), 4)


# Statistics ------------------------------------------------------------------------

def _determinant(rows, columns):
    """Cofactor expansion over named Gram entries."""
    if not rows:
        return "1.0::DOUBLE"
    first, rest = rows[0], rows[1:]
    terms = []
    for i, c in enumerate(columns):
        a, b = sorted((first, c))
        terms.append(f"{'-' if i % 2 else '+'} g{a}{b} * ({_determinant(rest, columns[:i] + columns[i + 1:])})")
    return " ".join(terms)


def _vif_sql(columns, source):
    k = list(range(len(columns)))
    unit = {i: f"({c} / (SELECT sqrt(sum({c} * {c})) FROM {source}))" for i, c in enumerate(columns)}
    gram = ", ".join(f"sum({unit[i]} * {unit[j]}) AS g{i}{j}" for i in k for j in k if i <= j)
    values = " UNION ALL ".join(
        f"SELECT '{columns[i]}' AS feature, g{i}{i} * ({_determinant([x for x in k if x != i], [x for x in k if x != i])})"
        f" / ({_determinant(k, k)}) AS vif FROM gram"
        for i in k
    )
    return f"gram AS (SELECT {gram} FROM {source}), vifs AS ({values})"


@query("vif", f"{WIDE}, {_vif_sql(FEATURES, 'wide')} SELECT feature, {P.r('vif', 5)}, vif > 10 AS too_high FROM vifs")
def vif(spark, folder):
    return rounded(separation.vif(X.wide(spark, folder), FEATURES), 5)


WITHOUT = ["l_extendedprice", "l_discount"]
VIF_DEPENDENT = f"""{WIDE}, {_vif_sql([*WITHOUT, "l_quantity", "l_tax"], 'wide')}
SELECT feature, {P.r('vif', 4)}, vif > 10 AS too_high FROM vifs WHERE feature IN ('l_extendedprice', 'l_discount')
UNION ALL SELECT unnest(['l_quantity', 'l_tax', 'mix']), 'inf'::DOUBLE, true"""


@query("vif_dependent", VIF_DEPENDENT)
def vif_dependent(spark, folder):
    """One column is a sum of two others: all three are infinite, the rest is as it was without it."""
    rows = X.wide(spark, folder).withColumn("mix", F.col("l_quantity") + 3 * F.col("l_tax"))
    return rounded(separation.vif(rows, [*WITHOUT, "l_quantity", "l_tax", "mix"]), 4)


def _separation_sql(columns, source="wide"):
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, avg({c}) FILTER (label = 0) AS m0, avg({c}) FILTER (label = 1) AS m1,
        var_samp({c}) FILTER (label = 0) AS v0, var_samp({c}) FILTER (label = 1) AS v1,
        count({c}) FILTER (label = 0) AS n0, count({c}) FILTER (label = 1) AS n1 FROM {source}"""
        for c in columns
    )
    return f"""stats AS ({parts}),
    separated AS (SELECT feature, m0 AS safe_mean, m1 AS dangerous_mean, m1 - m0 AS mean_diff,
      coalesce((m1 - m0) / nullif(m0, 0), 0) * 100 AS mean_diff_pct,
      coalesce((m1 - m0) / nullif(sqrt((v0 + v1) / 2), 0), 0) AS cohens_d,
      (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0::DOUBLE / n0 + 1.0::DOUBLE / n1)) AS t_stat,
      (n0 + n1 - 2)::DOUBLE AS dof FROM stats)"""


SEPARATION = ["safe_mean", "dangerous_mean", "mean_diff", "mean_diff_pct", "cohens_d", "t_stat", "dof"]


@query("class_separation", f"{WIDE}, {_separation_sql(FEATURES)} SELECT feature, {P.rounded(SEPARATION, 5)} FROM separated")
def class_separation(spark, folder):
    return rounded(separation.class_separation(X.wide(spark, folder), FEATURES), 5)


# The two-sided p-value by Simpson's rule over the t density, with t = u / (1 - u) beyond |t|.
P_VALUE = """
points AS (SELECT feature, t_stat, dof, unnest(range(2001)) AS i FROM separated),
mapped AS (SELECT feature, dof, i, i / 2000.0::DOUBLE * 0.9999999::DOUBLE AS u, abs(t_stat) AS t0 FROM points),
dens AS (SELECT feature, CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi())
      - (dof + 1) / 2 * ln(1 + pow(t0 + u / (1 - u), 2) / dof)) / pow(1 - u, 2) AS y FROM mapped),
p AS (SELECT feature, least(1.0, 2 * sum(y) * 0.9999999::DOUBLE / 2000 / 3) AS p_value FROM dens GROUP BY 1)"""


@query(
    "class_separation_report",
    f"""{WIDE}, {_separation_sql(FEATURES)}, {P_VALUE}
    SELECT feature, {P.rounded(SEPARATION, 5)}, {P.r("p_value", 5)}, CASE WHEN p_value < 0.05 THEN 'Yes' ELSE 'No' END AS significant,
    {P.r("abs(cohens_d)", 5, "abs_cohens_d")} FROM separated JOIN p USING (feature)""",
)
def class_separation_report(spark, folder):
    return rounded(separation.class_separation_report(X.wide(spark, folder), FEATURES), 5)


EFFECT = [*S.TRIP_FEATURES]


@query(
    "effect_size_buckets",
    f"""WITH {P.TRIP_TABLE}, {_separation_sql(EFFECT, "trip_table")},
    e AS (SELECT feature, CASE WHEN abs(cohens_d) > 0.8 THEN 'very large' WHEN abs(cohens_d) > 0.5 THEN 'large'
      WHEN abs(cohens_d) > 0.2 THEN 'medium' ELSE 'small' END AS effect FROM separated)
    SELECT effect, count(*) AS n_features, string_agg(feature, ', ' ORDER BY feature) AS features FROM e GROUP BY 1""",
)
def effect_size_buckets(spark, folder):
    return separation.effect_size_buckets(separation.class_separation(X.trip_table(spark, folder), EFFECT))


def _mi_sql(c):
    cuts = " + ".join(f"(coalesce({c}, 0) > q[{i}])::INT" for i in range(1, 10))
    probs = ", ".join(str(i / 10) for i in range(1, 10))
    return f"""SELECT '{c}' AS feature, sum(n / t * ln(n * t / (b * l))) AS mi FROM (
      SELECT n::DOUBLE AS n, sum(n) OVER ()::DOUBLE AS t, sum(n) OVER (PARTITION BY bin)::DOUBLE AS b,
        sum(n) OVER (PARTITION BY label)::DOUBLE AS l
      FROM (SELECT {cuts} AS bin, label, count(*) AS n
        FROM wide, (SELECT quantile_cont(coalesce({c}, 0), [{probs}]) AS q FROM wide) GROUP BY 1, 2))"""


@query(
    "mutual_information",
    f"{WIDE} SELECT feature, {P.r('mi')} FROM (" + " UNION ALL ".join(_mi_sql(c) for c in FEATURES) + ")",
)
def mutual_information(spark, folder):
    return rounded(separation.mutual_information(X.wide(spark, folder), FEATURES))


SHARES = [0.01, 0.25, 0.5, 0.75, 0.95, 0.999]


@query(
    "sketched_quantiles",
    "SELECT feature, probability, true AS within_bound FROM (SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURES) + "]) AS feature), "
    "(SELECT unnest([" + ", ".join(f"{p}::DOUBLE" for p in SHARES) + "]) AS probability)",
)
def sketched_quantiles(spark, folder):
    """Quantiles merged from four loads' sketches, and whether their true ranks are off by twice the stated error at
    most, which fewer than one sketch in a million misses."""
    rows, path = X.wide(spark, folder).withColumn("load", F.pmod(F.xxhash64(*FEATURES), F.lit(4))), work_path(spark, "sketches")
    for n in range(4):
        sketches.add_load(rows.where(F.col("load") == n), {c: F.col(c) for c in FEATURES}, path, f"{n}")
    found = sketches.rank_bounds(rows, sketches.estimated(sketches.merged(spark, path, FEATURES), SHARES), FEATURES)
    room = F.lit(2 * sketches.rank_error())
    inside = (F.col("probability") >= F.col("below") - room) & (F.col("probability") <= F.col("upto") + room)
    return found.select("feature", "probability", inside.alias("within_bound"))


def _digamma_sql(n):
    z = f"({n} + {neighbours.SHIFT}.0::DOUBLE)"
    series = f"ln({z}) - 0.5::DOUBLE / {z} - 1 / (12.0::DOUBLE * {z} ** 2) + 1 / (120.0::DOUBLE * {z} ** 4) - 1 / (252.0::DOUBLE * {z} ** 6) + 1 / (240.0::DOUBLE * {z} ** 8)"
    return "(" + series + "".join(f" - 1 / ({n} + {j}.0::DOUBLE)" for j in range(neighbours.SHIFT)) + ")"


def _neighbours_sql(column, k=neighbours.NEIGHBOURS):
    """Distances to the k rows on either side within the class; then the rows of any class nearer than the k-th.
    The join's bounds are a little wider than the distance, which is then compared as it is."""
    beside = ", ".join(f"x - lag(x, {j}) OVER w, lead(x, {j}) OVER w - x" for j in range(1, k + 1))
    return f"""SELECT '{column}' AS feature, greatest(0, {_digamma_sql("max(total)")} + sum(own * ({_digamma_sql("least(" + str(k) + ", size - 1)")}
      - {_digamma_sql("size")} - {_digamma_sql("m")})) / max(total)) AS mi
    FROM (
      SELECT a.label, a.x, any_value(a.own) AS own, any_value(a.size) AS size, any_value(a.total) AS total, sum(b.n) AS m
      FROM (
        SELECT label, x, count(*) AS own, any_value(size) AS size, any_value(total) AS total, min(list_sort(list_filter(near, lambda d: d IS NOT NULL))[least({k}, size - 1)]) AS r
        FROM (SELECT *, [{beside}] AS near FROM (
          SELECT label, coalesce({column}::DOUBLE, 0) AS x, count(*) OVER (PARTITION BY label) AS size, count(*) OVER () AS total FROM wide) WINDOW w AS (PARTITION BY label ORDER BY x))
        GROUP BY label, x) a
      JOIN (SELECT coalesce({column}::DOUBLE, 0) AS x, count(*) AS n FROM wide GROUP BY 1) b
        ON b.x >= a.x - a.r * 1.001 AND b.x <= a.x + a.r * 1.001
      WHERE abs(b.x - a.x) < a.r OR b.x = a.x GROUP BY 1, 2)"""


@query(
    "mutual_information_neighbours",
    f"{WIDE} SELECT feature, {P.r('mi')} FROM (" + " UNION ALL ".join(_neighbours_sql(c) for c in FEATURES) + ")",
)
def mutual_information_neighbours(spark, folder):
    return rounded(neighbours.mutual_information_neighbours(X.wide(spark, folder), FEATURES))


KEEP = ["speed_max", "speed_mean", "speed_std", "accel_mag_mean", "gyro_mag_mean"]
KEEP_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature, '{b}' AS other, abs(corr({a}, {b})) AS abs_r FROM trip_table"
    for a in KEEP for b in KEEP if a != b
)


@query(
    "feature_keep_drop",
    f"""WITH {P.TRIP_TABLE}, {_separation_sql(KEEP, "trip_table")}, {_vif_sql(KEEP, "trip_table")},
    pairs AS ({KEEP_PAIRS}),
    beaten AS (SELECT p.feature, arg_max(p.other, p.abs_r) AS redundant_with FROM pairs p
      JOIN separated a ON a.feature = p.feature JOIN separated b ON b.feature = p.other
      WHERE p.abs_r > 0.8 AND (abs(b.cohens_d) > abs(a.cohens_d)
        OR (abs(b.cohens_d) = abs(a.cohens_d) AND p.other < p.feature)) GROUP BY 1),
    judged AS (SELECT feature, cohens_d, vif, redundant_with, CASE WHEN redundant_with IS NOT NULL THEN 'redundant'
      WHEN abs(cohens_d) < 0.09 THEN 'weak' WHEN vif > 10 AND abs(cohens_d) <= 0.2 THEN 'collinear and small' ELSE '' END AS reason
      FROM separated LEFT JOIN vifs USING (feature) LEFT JOIN beaten USING (feature))
    SELECT feature, {P.rounded(["cohens_d", "vif"], 4)}, redundant_with,
      CASE WHEN reason = '' THEN 'keep' ELSE 'drop' END AS decision, reason FROM judged""",
)
def feature_keep_drop(spark, folder):
    trips_once = cut_lineage(X.trip_table(spark, folder).select("label", *KEEP))    # read by three passes
    return rounded(separation.feature_keep_drop(trips_once, KEEP), 4)


def _flagged(spark, folder):
    return X.scored(spark, folder).withColumn("prediction", evaluation.predicted("p", 0.4))


@query(
    "missed_vs_caught_profile",
    f"{SCORED} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {P.r("c", 4, "caught_mean")}, {P.r("m", 4, "missed_mean")}, {P.r("(m - c) / c * 100", 4, "diff_pct")},
        n_caught, n_missed FROM (SELECT avg({c}) FILTER (p >= 0.4) AS c, avg({c}) FILTER (p < 0.4) AS m,
        count(*) FILTER (p >= 0.4) AS n_caught, count(*) FILTER (p < 0.4) AS n_missed FROM scored WHERE label = 1)"""
        for c in FEATURES
    ),
)
def missed_vs_caught_profile(spark, folder):
    return rounded(separation.caught_and_missed(_flagged(spark, folder), FEATURES), 4)


@query(
    "class_density",
    f"""{SCORED}, d AS (SELECT CASE WHEN p >= 0.4 THEN 'caught' ELSE 'missed' END AS group_name, l_quantity AS x FROM scored WHERE label = 1),
    s AS (SELECT group_name, count(*) AS n, stddev_samp(x) * pow(count(*)::DOUBLE, -0.2) AS h, min(x) AS lo, max(x) AS hi FROM d GROUP BY 1),
    g AS (SELECT *, unnest(range(200)) AS point FROM s),
    a AS (SELECT *, lo - 3 * h + point * ((hi + 3 * h - (lo - 3 * h)) / 199) AS gx FROM g),
    w AS (SELECT group_name, x, count(*) AS w FROM d GROUP BY 1, 2)
    SELECT group_name, point::INT AS point, {P.r("gx", name="x")},
      {P.r("sum(w * exp(-0.5::DOUBLE * pow((gx - w.x) / h, 2))) / (n * h * sqrt(2 * pi()))", name="density")}
    FROM a JOIN w USING (group_name) GROUP BY group_name, point, gx, n, h""",
)
def class_density(spark, folder):
    rows = _flagged(spark, folder).where("label = 1").withColumn(
        "outcome", F.when(F.col("prediction") == 1, F.lit("caught")).otherwise(F.lit("missed"))
    )
    return rounded(separation.class_density(rows, "l_quantity", "outcome"))


# Evaluation ------------------------------------------------------------------------

CELLS = """count(*) FILTER (label = 0 AND NOT hit) AS tn, count(*) FILTER (label = 0 AND hit) AS fp,
  count(*) FILTER (label = 1 AND NOT hit) AS fn, count(*) FILTER (label = 1 AND hit) AS tp"""
RATES = """coalesce((tp + tn)::DOUBLE / nullif(tp + tn + fp + fn, 0), 0) AS accuracy,
  coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1"""
RATE_NAMES = ["accuracy", "precision", "recall", "f1"]


def _auc_sql(score="p", by="l_linestatus", source="scored"):
    """Mann-Whitney: each positive against the negatives below it and half of those beside it."""
    return f"""SELECT {by}, sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS roc_auc FROM (
      SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY {score}) - neg AS below FROM (
        SELECT {by}, {score}, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM {source} GROUP BY 1, 2))
      GROUP BY 1"""


@query("confusion_matrix", f"{SCORED} SELECT {CELLS} FROM (SELECT label, p >= 0.5 AS hit FROM scored)")
def confusion_matrix(spark, folder):
    return evaluation.confusion(X.scored(spark, folder), "label", evaluation.predicted("p", 0.5))


METRICS_SQL = f"""cells AS (SELECT l_linestatus, {CELLS} FROM (SELECT l_linestatus, label, p >= 0.5 AS hit FROM scored) GROUP BY 1),
  auc AS ({_auc_sql()}), metrics AS (SELECT *, {RATES} FROM cells JOIN auc USING (l_linestatus))"""


@query(
    "classification_metrics",
    f"{SCORED}, {METRICS_SQL} SELECT l_linestatus, tn, fp, fn, tp, {P.rounded([*RATE_NAMES, 'roc_auc'])} FROM metrics",
)
def classification_metrics(spark, folder):
    return rounded(evaluation.classification_metrics(X.scored(spark, folder), by=["l_linestatus"]))


CURVE = """pts AS (SELECT p, sum(label)::BIGINT AS pos, (count(*) - sum(label))::BIGINT AS neg FROM scored GROUP BY 1),
  cum AS (SELECT p, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
    FROM pts WINDOW w AS (ORDER BY p DESC))"""


@query(
    "roc_curve",
    f"""{SCORED}, {CURVE} SELECT p AS threshold, {P.r("fp::DOUBLE / nn", name="fpr")}, {P.r("tp::DOUBLE / np", name="tpr")} FROM cum
    UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
)
def roc_curve(spark, folder):
    return rounded(evaluation.roc_curve(X.scored(spark, folder)))


@query("roc_auc", f"{SCORED}, a AS ({_auc_sql()}) SELECT l_linestatus, {P.r('roc_auc')} FROM a")
def roc_auc(spark, folder):
    return rounded(evaluation.roc_auc(X.scored(spark, folder), by=["l_linestatus"]))


@query(
    "pr_curve",
    f"""{SCORED}, {CURVE} SELECT p AS threshold, {P.r("tp::DOUBLE / (tp + fp)", name="precision")},
    {P.r("tp::DOUBLE / np", name="recall")} FROM cum UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE""",
)
def pr_curve(spark, folder):
    return rounded(evaluation.pr_curve(X.scored(spark, folder)))


@query(
    "pr_auc",
    f"""{SCORED}, {CURVE}, q AS (SELECT p, tp::DOUBLE / (tp + fp) AS pr, tp::DOUBLE / np AS re FROM cum),
    l AS (SELECT *, lag(pr, 1, 1.0::DOUBLE) OVER (ORDER BY p DESC) AS pr0, lag(re, 1, 0.0::DOUBLE) OVER (ORDER BY p DESC) AS re0 FROM q)
    SELECT {P.r("sum((re - re0) * (pr + pr0) / 2)", name="pr_auc")} FROM l""",
)
def pr_auc(spark, folder):
    return rounded(evaluation.pr_auc(X.scored(spark, folder)))


def _sweep_sql(grid):
    levels = ", ".join(f"({t!r}::DOUBLE)" for t in grid)
    return f"""grid AS (SELECT * FROM (VALUES {levels}) g(threshold)),
    hits AS (SELECT threshold, label, p >= threshold AS hit FROM scored, grid),
    sweep AS (SELECT *, {RATES} FROM (SELECT threshold, {CELLS} FROM hits GROUP BY 1))"""


GRIDS = {
    "threshold_sweep": evaluation.FINE_GRID,
    "threshold_sweep_coarse": evaluation.COARSE_GRID,
    "threshold_sweep_model": evaluation.MODEL_GRID,
    "threshold_sweep_accuracy": evaluation.ACCURACY_GRID,
}


def _register_sweep(name, grid):
    @query(name, f"{SCORED}, {_sweep_sql(grid)} SELECT threshold, tn, fp, fn, tp, {P.rounded(RATE_NAMES)} FROM sweep")
    def run(spark, folder):
        return rounded(evaluation.threshold_sweep(X.scored(spark, folder), grid))


for _name, _grid in GRIDS.items():
    _register_sweep(_name, _grid)


def _policy(name, where, order):
    return f"SELECT * FROM (SELECT '{name}' AS policy, threshold, {P.rounded(RATE_NAMES)} FROM sweep {where} ORDER BY {order} LIMIT 1)"


def _own(policy):
    """Thresholds of a policy's own grid, in whole hundredths."""
    return f"round(threshold * 100)::INT IN ({', '.join(str(round(t * 100)) for t in evaluation.POLICY_GRIDS[policy])})"


@query(
    "threshold_select",
    f"{SCORED}, {_sweep_sql(evaluation.every_grid())} " + " UNION ALL ".join([
        """SELECT * FROM (SELECT 'accuracy_with_recall_60' AS policy, threshold, """ + P.rounded(RATE_NAMES)
        + f" FROM sweep WHERE {_own('accuracy_with_recall_60')}" + """
        ORDER BY CASE WHEN sweep.recall >= 0.60 THEN 0 ELSE 1 END,
          CASE WHEN sweep.recall >= 0.60 THEN sweep.accuracy ELSE sweep.recall END DESC, threshold DESC LIMIT 1)""",
        _policy("best_f1", f"WHERE {_own('best_f1')}", "sweep.f1 DESC, threshold"),
        _policy("f1_with_recall_70", f"WHERE {_own('f1_with_recall_70')} AND sweep.recall >= 0.70", "sweep.f1 DESC, threshold"),
        "SELECT 'recall_with_precision_40', " + ", ".join(
            f"max_by({c}, (sweep.recall, -threshold))" if c == "threshold" else
            f"round(max_by(sweep.{c}, (sweep.recall, -threshold)), 6)" for c in ["threshold", *RATE_NAMES]
        ) + f" FROM sweep WHERE {_own('recall_with_precision_40')} AND sweep.precision >= 0.40",
        _policy("best_accuracy", f"WHERE {_own('best_accuracy')}", "sweep.accuracy DESC, threshold"),
    ]),
)
def threshold_select(spark, folder):
    """Each policy on its own grid, from one sweep over all of them."""
    sweep = evaluation.threshold_sweep(X.scored(spark, folder), evaluation.every_grid())
    return rounded(evaluation.threshold_select(sweep, evaluation.POLICY_GRIDS))


@query(
    "balanced_f1_score",
    f"""{SCORED}, {METRICS_SQL} SELECT l_linestatus, {P.rounded(["f1", "recall"])},
    {P.r("greatest(metrics.f1 - 0.3::DOUBLE * greatest(0.0::DOUBLE, 0.65::DOUBLE - metrics.recall), 0.0::DOUBLE)", name="balanced_f1")}
    FROM metrics""",
)
def balanced_f1_score(spark, folder):
    cells = evaluation.confusion(X.scored(spark, folder), "label", evaluation.predicted("p", 0.5), ["l_linestatus"])
    score = evaluation.balanced_f1(F.col("f1"), F.col("recall")).alias("balanced_f1")
    return rounded(evaluation.rates(cells).select("l_linestatus", "f1", "recall", score))


@query(
    "overfit_gap",
    f"""{SCORED}, {METRICS_SQL}, w AS (SELECT max(accuracy) FILTER (l_linestatus = 'O') AS a, max(accuracy) FILTER (l_linestatus = 'F') AS b FROM metrics)
    SELECT {P.r("a", name="train_accuracy")}, {P.r("b", name="val_accuracy")}, {P.r("a - b", name="accuracy_gap")},
    CASE WHEN a - b < 0.02 THEN 'good' WHEN a - b < 0.05 THEN 'slight' ELSE 'significant' END AS verdict FROM w""",
)
def overfit_gap(spark, folder):
    metrics = evaluation.classification_metrics(X.scored(spark, folder), by=["l_linestatus"])
    return rounded(evaluation.overfit_gap(metrics, "l_linestatus", "O", "F"))


def _run_sql(name, score, threshold):
    return f"""{name}_c AS (SELECT 1 AS one, {CELLS} FROM (SELECT label, {score} >= {threshold} AS hit FROM scored)),
    {name}_a AS ({_auc_sql(score, "one", "(SELECT *, 1 AS one FROM scored)")}),
    {name} AS (SELECT *, {RATES} FROM {name}_c JOIN {name}_a USING (one))"""


COMPARED = [*RATE_NAMES, "roc_auc"]
COMPARISON = (
    f"{SCORED}, {_run_sql('run_a', 'p', 0.5)}, {_run_sql('run_b', 'p_other', 0.45)}, compared AS ("
    + " UNION ALL ".join(f"SELECT '{m}' AS metric, a.{m} AS first_run, b.{m} AS second_run FROM run_a a, run_b b" for m in COMPARED)
    + ")"
)


def _two_runs(spark, folder):
    rows = X.scored(spark, folder)
    return evaluation.model_comparison(
        evaluation.classification_metrics(rows, score="p", threshold=0.5),
        evaluation.classification_metrics(rows, score="p_other", threshold=0.45),
    )


@query(
    "model_comparison",
    f"""{COMPARISON} SELECT metric, {P.rounded(["first_run", "second_run"])}, {P.r("second_run - first_run", name="difference")},
    {P.r("(second_run - first_run) / first_run * 100", name="pct_change")} FROM compared""",
)
def model_comparison(spark, folder):
    return rounded(_two_runs(spark, folder))


@query(
    "adoption_decision",
    f"""{COMPARISON}, d AS (SELECT max(second_run - first_run) FILTER (metric = 'recall') AS rc,
      max(second_run - first_run) FILTER (metric = 'f1') AS fc FROM compared)
    SELECT {P.r("rc", name="recall_change")}, {P.r("fc", name="f1_change")}, 15.0::DOUBLE AS time_saved_pct,
    rc > 0.02 AND fc >= -0.05 AS adopt FROM d""",
)
def adoption_decision(spark, folder):
    return rounded(evaluation.adoption_decision(_two_runs(spark, folder), 2.0, 1.7))


@query(
    "cost_benefit",
    f"""{SCORED}, c AS (SELECT {CELLS} FROM (SELECT label, p >= 0.5 AS hit FROM scored))
    SELECT tp AS caught, fn AS missed, fp AS false_alarms, {P.r("tp::DOUBLE / (tp + fn) * 100", name="caught_pct")},
    {P.r("fp::DOUBLE / (fp + tn) * 100", name="false_alarm_pct")}, {P.r("fp::DOUBLE / tp", name="alarms_per_catch")} FROM c""",
)
def cost_benefit(spark, folder):
    cells = evaluation.confusion(X.scored(spark, folder), "label", evaluation.predicted("p", 0.5))
    return rounded(evaluation.cost_benefit(cells))


# A run per (line status, line number), standing for (model, technique).
RUNS = f"""runs AS (SELECT model, technique, {RATES} FROM (SELECT l_linestatus AS model, 'T' || line_number AS technique, {CELLS}
  FROM (SELECT l_linestatus, line_number, label, p >= 0.5 AS hit FROM scored) GROUP BY 1, 2))"""


def _runs(spark, folder):
    rows = X.scored(spark, folder).select(
        F.col("l_linestatus").alias("model"), F.concat(F.lit("T"), F.col("line_number")).alias("technique"), "label", "p"
    )
    cells = evaluation.confusion(rows, "label", evaluation.predicted("p", 0.5), ["model", "technique"])
    return evaluation.rates(cells).select("model", "technique", *RATE_NAMES)


@query(
    "leaderboard",
    f"{SCORED}, {RUNS} SELECT model, technique, {P.rounded(RATE_NAMES)} FROM runs ORDER BY runs.recall DESC, model, technique LIMIT 10",
)
def leaderboard(spark, folder):
    return rounded(evaluation.leaderboard(_runs(spark, folder), "recall", 10, ["model", "technique"]))


@query(
    "best_per_group",
    f"""{SCORED}, {RUNS} SELECT model, technique, {P.r("recall")} FROM (
      SELECT model, technique, recall, row_number() OVER (PARTITION BY model ORDER BY recall DESC, technique) AS rn FROM runs) WHERE rn = 1""",
)
def best_per_group(spark, folder):
    return rounded(evaluation.best_per_group(_runs(spark, folder), "model", "technique", "recall"))


@query(
    "best_per_technique",
    f"""{SCORED}, {RUNS} SELECT model, technique, {P.r("recall")} FROM (
      SELECT model, technique, recall, row_number() OVER (PARTITION BY technique ORDER BY recall DESC, model) AS rn FROM runs) WHERE rn = 1""",
)
def best_per_technique(spark, folder):
    return rounded(evaluation.best_per_group(_runs(spark, folder), "technique", "model", "recall"))


HISTORY = """decided AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS "timestamp", p >= 0.4 AS hit,
  CASE WHEN p >= 0.4 THEN p ELSE 1 - p END AS confidence FROM scored)"""
SUMMARY = f"""count(*) AS total_trips, count(*) FILTER (hit) AS dangerous_count, count(*) FILTER (NOT hit) AS safe_count,
  {P.r("count(*) FILTER (hit)::DOUBLE / count(*) * 100", name="dangerous_pct")},
  {P.r("100 - count(*) FILTER (hit)::DOUBLE / count(*) * 100", name="safe_pct")},
  {P.r("coalesce(avg(confidence) FILTER (hit), 0)", name="avg_confidence_dangerous")},
  {P.r("coalesce(avg(confidence) FILTER (NOT hit), 0)", name="avg_confidence_safe")}"""


@query(
    "prediction_history",
    f"""{SCORED}, {HISTORY} SELECT "timestamp", {SUMMARY} FROM decided GROUP BY 1 ORDER BY 1 DESC LIMIT 50""",
)
def prediction_history(spark, folder):
    """One scoring run per ship date; the newest 50 are kept."""
    hit = F.col("p") >= F.lit(0.4)
    results = X.scored(spark, folder).select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("timestamp"), hit.cast("int").alias("prediction"),
        F.when(hit, F.col("p")).otherwise(F.lit(1.0) - F.col("p")).alias("confidence"),
    )
    return rounded(scoring.prediction_history(scoring.batch_summary(results, ("timestamp",))))


# Preparation -----------------------------------------------------------------------

SHUFFLE = P.row_hash('"bookingID"', 42)


@query(
    "stratified_split",
    f"""WITH {P.LABEL}, x AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {SHUFFLE}, "bookingID") AS pos,
      count(*) OVER (PARTITION BY label) AS n FROM safety_label)
    SELECT "bookingID", driver_id, label, CASE WHEN pos * 10 <= n * 6 THEN 'train' WHEN pos * 10 <= n * 8 THEN 'val' ELSE 'test' END AS split
    FROM x""",
)
def stratified_split(spark, folder):
    return prepare.stratified_split(X.safety_label(spark, folder))


IMPUTED = ["speed", "acceleration_x", "gyro_x"]


@query(
    "impute_median",
    f"""WITH {P.SENSOR}, {P.FILTERED}, {P.CLEAN}, fit AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in IMPUTED)}
      FROM clean WHERE second < 432)
    SELECT "bookingID", event_id, {", ".join(P.r(f"coalesce({c}, m_{c})", name=c) for c in IMPUTED)} FROM clean, fit""",
)
def impute_median(spark, folder):
    rows = cleaning.clean_sensor(sensor(spark, folder))
    filled = prepare.impute_median(rows, IMPUTED, rows.where("second < 432"))
    return rounded(filled.select("bookingID", "event_id", *IMPUTED))


@query(
    "standard_scale",
    f"""{SCORED}, fit AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES)} FROM scored
      WHERE l_linestatus = 'O')
    SELECT order_key, line_number, {", ".join(P.r(f"({c} - m_{c}) / s_{c}", name=c) for c in FEATURES)} FROM scored, fit""",
)
def standard_scale(spark, folder):
    rows = X.scored(spark, folder)
    scaled = prepare.standard_scale(rows, FEATURES, rows.where("l_linestatus = 'O'"))
    return rounded(scaled.select("order_key", "line_number", *FEATURES))


@query(
    "class_weights",
    f"""{WIDE}, c AS (SELECT label, count(*) AS n_rows FROM wide GROUP BY 1),
    t AS (SELECT sum(n_rows)::DOUBLE AS n, count(*) AS k, max(n_rows) FILTER (label = 0)::DOUBLE AS n0, max(n_rows) FILTER (label = 1) AS n1 FROM c)
    SELECT label, n_rows, {P.r("n / (k * n_rows)", name="balanced_weight")}, {P.r("n0 / n1", name="positive_scale")} FROM c, t""",
)
def class_weights(spark, folder):
    return rounded(prepare.class_weights(X.wide(spark, folder)))
