"""Registered queries and, where SQL can say the same, their check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(body: Query) -> Query:
        QUERIES[name] = body
        if sql:
            ORACLES[name] = sql
        return body

    return register


# Quotients of hundredths are decimals that can end in a 5 just behind the last kept place, where engines
# round differently. With these places that takes a divisor that is a multiple of 512.
MORE_PLACES = {"speed_mean": 10, "speed_rate": 12, "delta_speed": 12}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(
        *[
            (F.round(F.col(f"`{n}`"), MORE_PLACES.get(n, places)) + F.lit(0.0)).alias(n)
            if t in ("double", "float") else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def sql_rounded(column: str, places: int = 6, source: str = "") -> str:
    return f"round({source}{column}, {MORE_PLACES.get(column, places)}) + 0.0::DOUBLE AS {column}"
