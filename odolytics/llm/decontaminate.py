"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

A document matters only through the shingles it shares with some item, so a scan first reduces every
document to those; clean text goes at once. The reduced sets are put into partitions by size (powers of
two). In a partition with sets of at most u shingles, an item of q shingles contained by the fraction t
has Jaccard similarity of at least t*q / (u + (1-t)*q); the number of single-minimum bands is chosen from
that bound so that a match is missed with probability MISS. Candidates are confirmed by exact shingle counts.

Bands are chosen for each pair of a partition and an item's size. Where an item is so small beside the sets of a
partition that it would take more than MOST_BANDS of them, it is looked up exactly instead: a set that holds the
fraction t of it holds one of any (1-t)*q + 1 of its shingles, and those that fewest items have are indexed. So the work
on a document grows with its set, not with the square of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolytics.llm.batches import bounded
from odolytics.llm import tokens
from odolytics.session import cut_lineage

CONTAINMENT = (80, 100)     # shared * 100 >= item size * 80
MISS = 1e-9
MOST_BANDS = 512
MOST_ITEM_SHINGLES = 4_000_000      # 32 MB of hashes sent to every task; more are joined instead

_U = np.uint64


def bands_for(size_class: int, item_size: int, containment: tuple[int, int] = CONTAINMENT) -> int:
    """Hash functions needed for one item in the partition of sets of 2**(c-1) < n <= 2**c shingles."""
    t = containment[0] / containment[1]
    upper = 2.0**size_class
    low = min(1.0, t * item_size / (upper + (1 - t) * item_size)) if upper > t * item_size else t
    return max(1, math.ceil(math.log(MISS) / math.log1p(-min(low, 1 - 1e-12))))


def _minima(shingles: np.ndarray, hashes: int) -> np.ndarray:
    out = np.empty(hashes, dtype=_U)
    for at in range(0, hashes, 64):
        seeds = tokens.mix(np.arange(at + 1, min(hashes, at + 64) + 1, dtype=_U))
        low = np.full(len(seeds), np.iinfo(np.uint64).max, dtype=_U)
        for part in range(0, len(shingles), 4096):
            values = tokens.mix(shingles[None, part : part + 4096] ^ seeds[:, None])
            np.minimum(low, values.min(axis=1), out=low)
        out[at : at + len(seeds)] = low
    return out


def _keys(shingles: np.ndarray, hashes: int, size_class: int) -> np.ndarray:
    """One key per hash function: the function, the partition and the minimum."""
    low = _minima(shingles, hashes)
    return tokens.mix(low ^ tokens.mix(np.arange(hashes, dtype=_U) * _U(256) + _U(size_class + 1)))


def _classes(n: int) -> int:
    return max(0, math.ceil(math.log2(n))) if n else 0


def _set_rows(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [tokens.shingle_set(r) for r in tokens.word_rows(batch.column("text"))]
            full = np.array([len(s) > 0 for s in sets], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).filter(pa.array(full)),
                    pa.array([s.view(np.int64) for s in sets if len(s)], pa.list_(pa.int64())),
                ],
                names=[key, "shingles"],
            )

    return run


def _reduced_rows(wanted):
    """Shingles of each document that occur in some item; documents with none are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        table = np.zeros(1 << 22, dtype=bool)
        table[known >> _U(42)] = True
        for batch in batches:
            ids, sets = [], []
            for doc_id, row in zip(batch.column("doc_id"), tokens.word_rows(batch.column("text"))):
                all_of = tokens.shingle_hashes(row)
                maybe = all_of[table[all_of >> _U(42)]]
                if len(maybe):
                    maybe = np.unique(maybe)
                    place = np.minimum(np.searchsorted(known, maybe), len(known) - 1)
                    maybe = maybe[known[place] == maybe]
                if len(maybe):
                    ids.append(doc_id.as_py())
                    sets.append(maybe.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"]
            )

    return run


def reduced_sets(docs: DataFrame, item_shingles: DataFrame) -> DataFrame:
    """``doc_id, shingles``: the item shingles each document holds.

    Few item shingles (counted first) go to every task as one sorted array. More of them are joined with the
    documents' shingles instead. Both give the same rows.
    """
    spark = docs.sparkSession
    unique = item_shingles.distinct()
    source = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    n = unique.count()
    if n == 0:
        return spark.createDataFrame([], "doc_id long, shingles array<long>")
    if n <= MOST_ITEM_SHINGLES:
        values = np.sort(unique.toArrow().column(0).to_numpy().view(_U))
        return source.mapInArrow(_reduced_rows(spark.sparkContext.broadcast(values)), "doc_id long, shingles array<long>")
    exploded = source.mapInArrow(_set_rows("doc_id"), "doc_id long, shingles array<long>").select(
        "doc_id", F.explode("shingles").alias("s")
    )
    return exploded.join(unique.withColumnRenamed(unique.columns[0], "s"), "s", "left_semi").groupBy("doc_id").agg(
        F.collect_set("s").alias("shingles")
    )


def _doc_keys(hashes_of_class: dict[int, int], exact: set[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets, keys = [], [], []
            for doc_id, number, row in zip(batch.column("doc_id"), batch.column("doc_set"), batch.column("shingles")):
                shingles = np.array(row.as_py(), dtype=np.int64).view(_U)
                c = _classes(len(shingles))
                ids.append(doc_id.as_py())
                sets.append(number.as_py())
                found = _keys(shingles, hashes_of_class[c], c)
                found = np.concatenate((found, tokens.mix(shingles.copy()))) if c in exact else found
                keys.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "doc_set", "keys"]
            )

    return run


def _item_keys(classes: list[int], containment: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets, keys = [], [], []
            for item_id, number, row, rare in zip(*(batch.column(c) for c in ("item_id", "item_set", "shingles", "rare"))):
                shingles = np.array(row.as_py(), dtype=np.int64).view(_U)
                # Sets of a partition may be too small to hold enough of the item.
                bands = {c: bands_for(c, len(shingles), containment) for c in classes if 2**c * containment[1] >= containment[0] * len(shingles)}
                found = [_keys(shingles, n, c) for c, n in bands.items() if n <= MOST_BANDS]
                if any(n > MOST_BANDS for n in bands.values()):
                    found.append(tokens.mix(np.array(rare.as_py(), dtype=np.int64).view(_U)))
                if found:
                    ids.append(item_id.as_py())
                    sets.append(number.as_py())
                    keys.append(np.concatenate(found).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["item_id", "item_set", "keys"]
            )

    return run


def _with_rare(item_sets: DataFrame, containment: tuple[int, int]) -> DataFrame:
    """Items with the shingles that fewest items have, as many as no set can lack that holds enough of the item."""
    each = item_sets.select("item_id", "item_set", F.explode("shingles").alias("s"))
    shared = each.groupBy("s").agg(F.count("*").alias("n_items"))
    ordered = each.join(shared, "s").groupBy("item_id", "item_set").agg(F.array_sort(F.collect_list(F.struct("n_items", "s"))).alias("ordered"))
    size = F.size("ordered")
    needed = F.ceil(size * F.lit(containment[0]) / F.lit(containment[1])).cast("int")
    rare = ordered.select("item_id", "item_set", F.transform(F.slice("ordered", F.lit(1), size - needed + 1), lambda o: o["s"]).alias("rare"))
    return item_sets.join(rare, ["item_id", "item_set"])


def contained_items(docs: DataFrame, items: DataFrame, containment: tuple[int, int] = CONTAINMENT) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` for every item that a document holds.

    An item counts as held when at least 80 of 100 of its distinct five-word shingles (its whole word sequence,
    if it has fewer words) occur anywhere in the document. NULL or empty texts hold nothing and are held by
    nothing. Rows that repeat an id give one result each pair. Rows without an id are left out. An empty table
    gives no rows. Only doc_id, item_id and text are read.
    """
    item_sets = cut_lineage(
        bounded(items).where("item_id IS NOT NULL").select("item_id", "text")
        .mapInArrow(_set_rows("item_id"), "item_id long, shingles array<long>").dropDuplicates(["item_id", "shingles"])
        .withColumn("item_set", F.xxhash64("shingles"))
    )
    reduced = reduced_sets(docs, item_sets.select(F.explode("shingles").alias("s"))).dropDuplicates(["doc_id", "shingles"])
    reduced = cut_lineage(reduced.withColumn("doc_set", F.xxhash64("shingles")))
    size_class = F.ceil(F.log2(F.size("shingles").cast("double"))).cast("int")
    classes = sorted(r[0] for r in reduced.select(size_class.alias("c")).distinct().collect())   # at most 31
    smallest, largest = item_sets.agg(F.min(F.size("shingles")), F.max(F.size("shingles"))).first()
    if smallest is None or not classes:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item long, n_shared long, containment double")
    # The smallest item needs the most hash functions; the larger items use the first few of the same ones.
    hashes_of_class = {
        c: min(bands_for(c, smallest, containment), MOST_BANDS) if bands_for(c, largest, containment) <= MOST_BANDS else 0 for c in classes
    }
    exact = {c for c in classes if bands_for(c, smallest, containment) > MOST_BANDS}
    doc_keys = reduced.mapInArrow(_doc_keys(hashes_of_class, exact), "doc_id long, doc_set long, keys array<long>").select(
        "doc_id", "doc_set", F.explode("keys").alias("key")
    )
    item_keys = _with_rare(item_sets, containment).mapInArrow(
        _item_keys(classes, containment), "item_id long, item_set long, keys array<long>"
    ).select("item_id", "item_set", F.explode("keys").alias("key"))
    pair = ["doc_id", "doc_set", "item_id", "item_set"]
    candidates = doc_keys.join(item_keys, "key").select(*pair).distinct()
    # Shingle by shingle: a large set is not copied for every item it may hold.
    asked = candidates.join(item_sets.select("item_id", "item_set", F.size("shingles").cast("long").alias("n_item"), F.explode("shingles").alias("s")), ["item_id", "item_set"])
    held = reduced.select("doc_id", "doc_set", F.explode("shingles").alias("s"))
    counted = asked.join(held, ["doc_id", "doc_set", "s"]).groupBy(*pair).agg(F.first("n_item").alias("n_item"), F.count("*").alias("n_shared"))
    return (
        counted.where(F.col("n_shared") * containment[1] >= F.col("n_item") * containment[0])
        .groupBy("doc_id", "item_id").agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))
        .withColumn("containment", F.round(F.col("n_shared") / F.col("n_item"), 6))
    )


ORACLE = r"""
WITH sh AS (
  SELECT side, id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(generate_series(1, len(w) - 4),
      lambda i: array_to_string(w[i:i + 4], ' '))) ELSE [array_to_string(w, ' ')] END AS s
  FROM (SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        UNION ALL
        SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark)
  WHERE len(w) > 0),
i AS (SELECT id, len(s)::BIGINT AS n_item, unnest(s) AS h FROM sh WHERE side = 'i'),
d AS (SELECT id, unnest(s) AS h FROM sh WHERE side = 'd')
SELECT d.id AS doc_id, i.id AS item_id, n_item, count(*)::BIGINT AS n_shared, round(count(*) / n_item::DOUBLE, 6) AS containment
FROM d JOIN i USING (h) GROUP BY d.id, i.id, n_item HAVING count(*) * 100 >= n_item * 80
"""
