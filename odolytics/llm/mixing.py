"""Mixing sources to target weights with hash-threshold histograms.

Every document gets a hash of its id. A source takes whole copies of all its documents, and one copy more
of those whose hash is under the source's threshold, so a larger budget always takes a superset. The
threshold is found without sorting: sizes are summed by source and hash bucket, the bucket in which the
budget runs out is cut into finer buckets, and so on until it is one hash value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics.functions.columns import broadcast_if_small
from odolytics.session import cut_lineage

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
HASH_DIGITS = 15            # hexadecimal digits of the hash: 60 bits
LEVEL_DIGITS = 3            # digits read per round: 4,096 buckets
MOST_SOURCES = 50_000       # one row each is sent to every task; a table of more sources is shuffled


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(doc_id: Column) -> Column:
    """Sixty bits of md5 of the id in text form, as hexadecimal digits (their order is the numbers' order)."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS)


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source with its weight and target, from rows of (source, source_size).

    Targets share the total by weight, but stop at three times the source's size; the rest is shared again.
    That is ``min(3 * size, weight * level)`` for one common level: with sources in order of
    ``3 * size / weight``, a source is stopped while its ratio is at most what is left over the weight left.
    """
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), place + 1)
    # One row per source from here on: counts of documents are already summed.
    sources = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(MOST_COPIES)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = sources.withColumn("level", level)
    free = F.col("cap") > F.col("weight") * F.col("level")
    levels = levels.withColumn("level", F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), "level"))).over(whole)["level"])
    target = F.when(
        F.col("level").isNull(), F.col("cap")
    ).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("level")))
    return levels.select("source", "source_size", F.round(target, 4).alias("target"))


def thresholds(units: DataFrame, budgets: DataFrame) -> DataFrame:
    """The smallest hash left out of each source, from (source, h, size) and (source, budget).

    A budget runs out inside one bucket; only rows of that bucket are summed again by their next digits.
    The last bucket holds one hash value; it is taken if that brings the sum nearer to the budget.
    Sources whose budget is zero are given the smallest hash. Gives (source, threshold).
    """
    state = budgets.select("source", F.lit("").alias("prefix"), F.col("budget").cast("double").alias("left"))
    upto = Window.partitionBy("source").orderBy("bucket")
    for digits in range(LEVEL_DIGITS, HASH_DIGITS + 1, LEVEL_DIGITS):
        inside = units.alias("u").join(
            broadcast_if_small(state, MOST_SOURCES).alias("s"),
            F.expr(f"u.source <=> s.source AND left(u.h, {digits - LEVEL_DIGITS}) = s.prefix") if digits > LEVEL_DIGITS
            else F.expr("u.source <=> s.source"),
        )
        histogram = inside.groupBy(
            F.col("u.source").alias("source"), F.substring("h", 1, digits).alias("bucket")
        ).agg(F.sum("size").alias("words"), F.first("left").alias("left"))
        running = histogram.withColumn("upto", F.sum("words").over(upto))
        # The first bucket at which the running sum reaches the budget; at most 4,096 buckets per source.
        crossing = running.where(F.col("upto") >= F.col("left")).groupBy("source").agg(
            F.min(F.struct("bucket", "words", "upto", "left")).alias("at")
        )
        state = cut_lineage(
            crossing.select(
                "source", F.col("at.bucket").alias("prefix"), (F.col("at.left") - F.col("at.upto") + F.col("at.words")).alias("left"),
                F.col("at.words").alias("words"),
            )
        )
    nearer = F.col("left") > F.col("words") - F.col("left")
    return state.select("source", F.when(nearer, F.concat("prefix", F.lit("~"))).otherwise(F.col("prefix")).alias("threshold"))


def mix_sources(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Words taken from each document: ``doc_id, size, source_size, target, taken`` and the source.

    Size is the number of words of the text; NULL or empty text has none, and none is taken from it. A NULL
    source is a source of its own, last in order. Rows with one id (also NULL) share a hash, so they are
    taken or left together; repeated rows count as often as they stand there. An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    units = cut_lineage(
        docs.select(
            F.col(id_column).alias("doc_id"), F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"), unit_hash(F.col(id_column)).alias("h"),
        )
    )
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = cut_lineage(targets(sizes))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budgets = plan.withColumn("whole", whole.cast("long")).withColumn(
        "budget", F.col("target") - F.col("whole") * F.col("source_size")
    )
    cut = thresholds(units.where("size > 0"), budgets.where("budget > 0").select("source", "budget"))
    decided = budgets.alias("b").join(cut.alias("t"), F.expr("b.source <=> t.source"), "left").select(
        "b.source", "b.source_size", "b.target", "b.whole", F.coalesce("t.threshold", F.lit("")).alias("threshold")
    )
    copies = F.col("d.whole") + (F.col("u.h") < F.col("d.threshold")).cast("long")
    decided = broadcast_if_small(cut_lineage(decided), MOST_SOURCES)
    return units.alias("u").join(decided.alias("d"), F.expr("u.source <=> d.source")).select(
        "u.doc_id", "u.size", "d.source_size", "d.target", (F.col("u.size") * copies).alias("taken"), "u.source",
    )


ORACLE = f"""
WITH u AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    left(md5(coalesce(doc_id::VARCHAR, '')), {HASH_DIGITS}) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size) AS cap,
    [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM u GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW w AS (ORDER BY cap / weight, encode(source) NULLS LAST)),
m AS (SELECT min_by(level, cap / weight) AS level FROM l WHERE cap > weight * level),
t AS (
  SELECT source, source_size, round(CASE WHEN m.level IS NULL THEN cap ELSE least(cap, weight * m.level) END, 4) AS target
  FROM s LEFT JOIN m ON true),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
    target - whole * source_size AS budget FROM t),
h AS (
  SELECT u.source, h, sum(size) AS words, any_value(budget) AS budget
  FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source WHERE size > 0 AND budget > 0 GROUP BY u.source, h),
r AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM h),
k AS (SELECT source, h, upto <= budget OR budget - (upto - words) > upto - budget AS extra FROM r WHERE upto - words < budget)
SELECT u.doc_id, u.size, b.source_size, b.target, (u.size * (b.whole + coalesce(k.extra, false)::BIGINT))::BIGINT AS taken, u.source
FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source
LEFT JOIN k ON u.source IS NOT DISTINCT FROM k.source AND u.h = k.h
"""
