"""Document fingerprints: threshold-scaled sketches of five-word shingles, in DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range. A set of up to ``FULL`` shingles is kept
whole instead and says so, which is the same with a threshold at the top of the range. Two sketches are compared below
the lower of their thresholds, where both hold every hash there is: the share of common hashes estimates similarity and
containment for any two sizes, and is exact between two whole sets. A sketch depends on the set alone, and ``merged``
gives the sketch of the union. A short set may have no hash below the threshold of a long one; then its containment
in it is unknown (NULL), not 0.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 8                # one hash in this many is kept
FULL = 64                   # sets of up to so many shingles are kept whole
BUCKETS_PER_TASK = 8
SPACE = r"[\x20\x09-\x0D]+"

_BOTTOM = -(1 << 63)
_CUT = _BOTTOM + (1 << 64) // FRACTION


def sketch(text: Column) -> Column:
    """``whole, hashes`` of a text; no hashes for NULL or a text without words."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")
    hashed_words = F.transform(words, lambda w: F.xxhash64(w))

    def of(hashed: Column) -> Column:
        n = F.size(hashed)
        runs = F.transform(
            F.sequence(F.lit(0), n - SHINGLE),
            lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(SHINGLE)]),
        )
        # Fewer words than a shingle has: the whole sequence is the one shingle.
        return F.when(n >= SHINGLE, runs).when(n > 0, F.array(F.xxhash64(hashed))).otherwise(F.array().cast("array<bigint>"))

    return _once(_once(hashed_words, of), lambda hashes: _kept(F.array_distinct(hashes)))


def _below(hashes: Column) -> Column:
    return F.filter(hashes, lambda h: h < F.lit(_CUT))


def _kept(distinct: Column) -> Column:
    """A sketch of a set: whether it is whole, and its hashes in order."""

    def of(hashes: Column) -> Column:
        whole = F.size(hashes) <= FULL
        return F.struct(whole.alias("whole"), F.array_sort(F.when(whole, hashes).otherwise(_below(hashes))).alias("hashes"))

    return _once(distinct, of)


def merged(a: Column, b: Column) -> Column:
    """The sketch of two sets together, from their sketches."""

    def of(pair: Column) -> Column:
        return F.when(a["whole"] & b["whole"], _kept(pair)).otherwise(
            F.struct(F.lit(False).alias("whole"), F.array_sort(_below(pair)).alias("hashes"))
        )

    return _once(F.array_union(a["hashes"], b["hashes"]), of)


def _comparable(a: Column, b: Column) -> Column:
    """The hashes of two sketches below the lower of their thresholds."""
    both = a["whole"] & b["whole"]
    return F.when(both, F.struct(a["hashes"].alias("a"), b["hashes"].alias("b"))).otherwise(
        F.struct(_below(a["hashes"]).alias("a"), _below(b["hashes"]).alias("b"))
    )


def _once(value: Column, use) -> Column:
    """Use a value several times but work it out once, as the variable of a one-element transform."""
    return F.transform(F.array(value), use)[0]


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two texts from their sketches, 0 to 1. Where there is no hash to compare (two empty sets, or
    a short set and a longer one without a hash below the threshold) it is 1 for equal sketches and else 0."""

    def of(pair: Column) -> Column:
        common = F.size(F.array_intersect(pair["a"], pair["b"]))
        either = F.size(pair["a"]) + F.size(pair["b"]) - common
        return F.when(either == 0, (a == b).cast("double")).otherwise(common / either).cast("double")

    return _once(_comparable(a, b), of)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has; 0 for an empty first text, and NULL where
    the first is so short that none of its hashes lies below the second one's threshold."""

    def of(pair: Column) -> Column:
        n = F.nullif(F.size(pair["a"]), F.lit(0))
        return F.when(F.size(a["hashes"]) == 0, F.lit(0.0)).otherwise((F.size(F.array_intersect(pair["a"], pair["b"])) / n).cast("double"))

    return _once(_comparable(a, b), of)


def as_string(a: Column) -> Column:
    """A sketch as text: = for a whole set or < for a threshold, then its hashes."""
    hashes = a["hashes"]
    return F.concat(F.when(a["whole"], F.lit("=")).otherwise(F.lit("<")), F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ""))


def _ranges(docs: DataFrame, tasks: int) -> tuple[DataFrame, list]:
    """Rows with the number of their range of ids, cut at quantiles, and the largest (id, tie-break) of each range."""
    ids = docs.select("doc_id")
    buckets = tasks * BUCKETS_PER_TASK
    cuts = sorted(set(ids.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.25 / buckets)))
    found = F.lit(0)
    if cuts:
        number = docs.withColumn("id_number", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))
        docs = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="id_number", outputCol="place").transform(number)   # binary search
        found = F.col("place").cast("int")
    # NULL ids come last in descending order: they are the lowest range of all.
    order = F.struct(F.col("doc_id"), F.col("tie"))
    ranged = docs.select("doc_id", "text", "tie", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(found).alias("bucket"))
    heads = ranged.select("bucket", "doc_id", "tie").groupBy("bucket").agg(F.max(order).alias("head")).collect()   # one row per range
    return ranged, sorted(heads, key=lambda r: r["bucket"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row.

    The edited text has its last third replaced by as many first characters of the next document by descending
    id (after the last: the first; a lone document is its own next). NULL text counts as empty. Rows of one id
    follow each other by a hash of their text, and rows that are equal in both are taken as they come (their
    results are the same, except for which one is followed by another text). Rows without an id come last.
    Other columns are not read; no rows, no result.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    read = read.withColumn("tie", F.xxhash64("text"))
    ranged, heads = _ranges(read, tasks)
    if not heads:
        return _result(ranged.withColumn("sketch", sketch(F.col("text"))).withColumn("next", F.struct("text", "sketch")))
    return _result(_followed(ranged, heads))


def _followed(ranged: DataFrame, heads: list) -> DataFrame:
    """Each row with its next row by descending id (after the last: the first) as ``next``.

    A range is one window, to which the first row of the range after it is added as a guest.
    """
    rows = ranged.withColumn("sketch", sketch(F.col("text"))).withColumn("guest", F.lit(False))
    # The head of each range is a guest at the end of the range above it; the topmost head ends the lowest range.
    hosts = [heads[(i + 1) % len(heads)]["bucket"] for i in range(len(heads))]
    tops = ranged.sparkSession.createDataFrame(
        [(h["bucket"], h["head"]["doc_id"], h["head"]["tie"], host) for h, host in zip(heads, hosts)],
        "of int, top_id long, top_tie long, host int",
    )
    is_top = (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("tie") == F.col("top_tie"))
    guests = (
        ranged.join(F.broadcast(tops), is_top)      # one row per range
        .dropDuplicates(["bucket"])
        .select("doc_id", "text", "tie", F.col("host").alias("bucket"))
        .withColumn("sketch", sketch(F.col("text"))).withColumn("guest", F.lit(True))
    )
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    following = F.lead(F.struct("text", "sketch")).over(order)
    return rows.union(guests).withColumn("next", following).where("NOT guest")


def _result(rows: DataFrame) -> DataFrame:
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next.text"), F.lit(1), third))
    out = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", F.col("next.sketch").alias("next_sketch")
    ).withColumn("edited_sketch", sketch(F.col("edited")))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"), as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
