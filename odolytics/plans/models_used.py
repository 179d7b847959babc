"""The written-out model the scoring queries use, and its SQL form."""

from __future__ import annotations

from odolytics import schema as S
from odolytics.operators import prepare
from odolytics.operators.scoring import LinearModel
from odolytics.plans import oracle_parts as P

# z-score weights of the serving features, for the scoring queries.
WEIGHTS = dict(zip(S.SERVING_FEATURES, [0.8, -0.15, 0.1, 0.3, 0.12, 0.2, -0.05, 0.07, 0.02, 0.25]))
INTERCEPT, THRESHOLD = -0.4, 0.45


def linear_model(features) -> LinearModel:
    """Scaled on the trips at hand."""
    filled = features.na.fill(0, S.SERVING_FEATURES)
    return LinearModel(WEIGHTS, INTERCEPT, prepare.scaling(filled, S.SERVING_FEATURES), THRESHOLD)


def scored_sql(source: str, ctes: str) -> str:
    fit = ", ".join(
        f"avg(coalesce({f}, 0)) AS m_{f}, coalesce(nullif(stddev_pop(coalesce({f}, 0)), 0), 1) AS s_{f}" for f in WEIGHTS
    )
    z = " + ".join(f"(coalesce({f}, 0) - m_{f}) / s_{f} * {w!r}::DOUBLE" for f, w in WEIGHTS.items())
    return f"""WITH {ctes}, fit AS (SELECT {fit} FROM {source}),
odds AS (SELECT "bookingID", 1.0::DOUBLE / (1.0::DOUBLE + exp(-({INTERCEPT!r}::DOUBLE + {z}))) AS probability_dangerous
  FROM {source}, fit),
decided AS (SELECT "bookingID", CASE WHEN probability_dangerous >= {THRESHOLD} THEN 1 ELSE 0 END AS prediction,
  CASE WHEN probability_dangerous >= {THRESHOLD} THEN 'DANGEROUS' ELSE 'SAFE' END AS prediction_label,
  1.0::DOUBLE - probability_dangerous AS probability_safe, probability_dangerous,
  CASE WHEN probability_dangerous >= {THRESHOLD} THEN probability_dangerous ELSE 1.0::DOUBLE - probability_dangerous END AS confidence
  FROM odds)
"""


SCORED_TRIPS = scored_sql("features", P.FEATURES)
SCORED_SERVING = scored_sql("sfeatures", P.SERVING_FEATURES)
