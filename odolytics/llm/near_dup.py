"""Near-duplicate documents by b-bit MinHash.

Each distinct word sequence gets 128 minima over its five-word shingles. Four full minima make one of 32
band keys, so a pair of similarity 0.85 shares no key with probability (1 - 0.85**4)**32 = 6e-11. Of each
minimum two bits are kept, packed into four 64-bit words. Members of a bucket are compared with the bucket's
least document first; equal bits are counted, the count is corrected for chance collisions, and pairs well
below the threshold (five standard deviations) are ruled out. What is left is confirmed on the full sets.

Links are needed only to know components, so a bucket whose members are all in one component after that is
finished. The others are gathered under the least component in them; such a group is cut into blocks, and each
pair of blocks is compared in a task of its own: pairs of different components by their signatures, then on
the full sets, passing over pairs that links found before have already joined. A task gives back only links
that join something, so its result is never longer than its input. No pair of different components that
shares a bucket is left untested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolytics.llm.batches import bounded
from odolytics.functions.columns import broadcast_if_small
from odolytics.llm import tokens
from odolytics.llm.graph import components
from odolytics.session import cut_lineage

BANDS, ROWS, BITS = 32, 4, 2
HASHES = BANDS * ROWS
SLOTS = 64 // BITS                      # minima in one packed word
PACKED = HASHES // SLOTS
LIKENESS = (85, 100)                    # intersection * 100 >= union * 85
BLOCK = 512                             # members of a group compared with each other in one task
NODES_TO_BROADCAST = 1_000_000          # 8 MB of ids; more of them are joined by a shuffle
CHUNK = 2048                            # shingles hashed at once

_U = np.uint64
_MULTIPLY = tokens.mix(np.arange(1, HASHES + 1, dtype=_U)) | _U(1)
_ADD = tokens.mix(np.arange(HASHES + 1, 2 * HASHES + 1, dtype=_U))
_BAND_SALT = tokens.mix(np.arange(3 * HASHES, 3 * HASHES + BANDS, dtype=_U))


def lowest_estimate(threshold: float) -> float:
    """The estimate that a pair at the threshold exceeds but for one case in three million."""
    p = threshold + (1 - threshold) / 2**BITS
    return threshold - 5 * math.sqrt(p * (1 - p) / HASHES) / (1 - 0.5**BITS)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set, as 32-bit numbers."""
    low = np.full(HASHES, np.iinfo(np.uint32).max, dtype=_U)
    for at in range(0, len(shingles), CHUNK):
        part = shingles[None, at : at + CHUNK] * _MULTIPLY[:, None]
        part += _ADD[:, None]
        part >>= _U(32)
        np.minimum(low, part.min(axis=1), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    bits = (tokens.mix(low) & _U(2**BITS - 1)).reshape(PACKED, SLOTS)
    return np.bitwise_or.reduce(bits << (np.arange(SLOTS, dtype=_U) * _U(BITS)), axis=1)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS)
    out = _BAND_SALT.copy()
    for k in range(ROWS):
        out = tokens.mix(out ^ rows[:, k])
    return out


def same_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minima of packed signatures agree, for arrays whose last axis holds the packed words."""
    differ = a ^ b
    folded = differ
    for k in range(1, BITS):
        folded = folded | (differ >> _U(k))
    ones = int(sum(1 << (BITS * i) for i in range(SLOTS)))
    return HASHES - np.bitwise_count(folded & _U(ones)).sum(axis=-1).astype(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected similarity of two packed signatures (arrays of longs)."""
    ones = sum(1 << (BITS * i) for i in range(SLOTS))
    ones -= 1 << 64 if ones >= 1 << 63 else 0
    equal = F.lit(HASHES)
    for i in range(PACKED):
        differ = a[i].bitwiseXOR(b[i])
        folded = differ
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(differ, k))
        equal = equal - F.bit_count(folded.bitwiseAND(F.lit(ones)))
    return (equal / F.lit(float(HASHES)) - 0.5**BITS) / (1 - 0.5**BITS)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        size, seq, sigs, bands = [], [], [], []
        for row in tokens.word_rows(batch.column("text")):
            shingles = tokens.shingle_set(row)
            low = minima(shingles)
            size.append(len(shingles))
            seq.append(hashlib.blake2b(row.tobytes(), digest_size=16).digest())
            sigs.append(packed(low).view(np.int64))
            bands.append(band_keys(low).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(seq, pa.binary()),
                pa.array([list(x) for x in sigs], pa.list_(pa.int64())), pa.array([list(x) for x in bands], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "seq", "sig", "bands"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sign, "doc_id long, n_shingles long, seq binary, sig array<long>, bands array<long>"
    )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [tokens.shingle_set(row).tobytes() for row in tokens.word_rows(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["node", "shingles"])


def _alike(a: np.ndarray, b: np.ndarray, likeness: tuple[int, int]) -> bool:
    """Whether two sets (sorted) are similar enough."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or likeness[1] * len(a) < likeness[0] * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return likeness[1] * both >= likeness[0] * (len(a) + len(b) - both)


def _confirm(likeness: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([
                _alike(np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U), likeness)
                for x, y in zip(batch.column("x"), batch.column("y"))
            ], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Whole shingle sets of the named documents."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        broadcast_if_small(nodes.withColumnRenamed("node", "doc_id"), NODES_TO_BROADCAST), "doc_id", "left_semi"
    )
    return wanted.mapInArrow(_set_rows, "node long, shingles binary")


def confirmed(pairs: DataFrame, docs: DataFrame, likeness: tuple[int, int] = LIKENESS) -> DataFrame:
    """The pairs ``(a, b)`` whose whole shingle sets are similar enough."""
    pairs = cut_lineage(pairs)
    nodes = cut_lineage(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
    sets = cut_lineage(shingle_sets(docs, nodes))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(_confirm(likeness), "a long, b long")


def _block_links(lowest: float, likeness: tuple[int, int]):
    """Links between different components in two blocks of a group that join something new."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        own = table.column("block").to_numpy()
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        sig = np.array(table.column("sig").to_pylist(), dtype=np.int64).reshape(-1, PACKED).view(_U)
        sets = [np.frombuffer(x.as_buffer(), _U) for x in table.column("shingles").combine_chunks()]
        top = {int(x): int(x) for x in label}

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = x = top[top[x]]
            return x

        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        size = np.array([len(x) for x in sets])
        found = []
        for x in left:
            like = (same_bits(sig[x][None, :], sig[right]) / HASHES - 0.5**BITS) / (1 - 0.5**BITS)
            small, large = np.minimum(size[x], size[right]), np.maximum(size[x], size[right])
            near = right[(like >= lowest) & (label[right] != label[x]) & (small * likeness[1] >= large * likeness[0])]
            for y in near[near > x] if i == j else near:
                a, b = root(int(label[x])), root(int(label[y]))
                if a != b and _alike(sets[x], sets[y], likeness):
                    top[max(a, b)] = min(a, b)
                    found.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([max(p) for p in found], pa.int64()), "b": pa.array([min(p) for p in found], pa.int64())})

    return run


def links(docs: DataFrame, signed: DataFrame, likeness: tuple[int, int] = LIKENESS) -> DataFrame:
    """Components ``(node, label)`` among the representatives in ``signed`` (one row per distinct sequence)."""
    lowest = lowest_estimate(likeness[0] / likeness[1])
    sigs = signed.select(F.col("doc_id").alias("node"), "sig")
    banded = signed.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members")).where("members > 1")
    shared = cut_lineage(banded.join(buckets.select("key", "hub"), "key"))

    def near(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a").join(
            sigs.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b"
        )
        return both.where(estimate(F.col("x"), F.col("y")) >= lowest).select("a", "b")

    stars = shared.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    edges = cut_lineage(confirmed(near(stars), docs, likeness))
    labels = components(edges)

    at = shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    unfinished = at.groupBy("key").agg(F.min("label").alias("group"), F.max("label").alias("hi")).where("group != hi")
    left = cut_lineage(at.join(unfinished.select("key", "group"), "key").select("group", "node", "label").distinct())
    sizes = left.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sets = shingle_sets(docs, cut_lineage(left.select("node").distinct()))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        left.join(sizes, "group").join(sigs, "node").join(sets, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", other)
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    )
    across = dealt.select("group", "i", "j", "block", "node", "label", "sig", "shingles").groupBy("group", "i", "j").applyInArrow(
        _block_links(lowest, likeness), "a long, b long"
    )
    return components(edges.union(across))


def near_duplicates(docs: DataFrame, likeness: tuple[int, int] = LIKENESS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (columns doc_id, text; others unread).

    The set of a text is its five-word shingles, or its whole word sequence if that is shorter. NULL and empty
    texts have an empty set and are linked with nothing. Equal word sequences are one node, named by their least
    id, so thousands of copies cost one row each. Rows that repeat an id are one document: they share a
    component. A row without an id cannot be named; it comes back with a NULL component, kept. No rows, no result.
    """
    signed = cut_lineage(signatures(bounded(docs)))
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = named.groupBy("seq").agg(F.min("doc_id").alias("first"))
    nodes = cut_lineage(
        named.alias("s").join(firsts.alias("f"), F.expr("s.seq = f.seq AND s.doc_id = f.first"))
        .select("s.doc_id", "s.seq", "s.sig", "s.bands").dropDuplicates(["seq"])
    )
    labels = links(docs, nodes, likeness)
    of_copy = named.select("doc_id", "seq").join(firsts, "seq").select("doc_id", "first").distinct()
    found = of_copy.join(labels.select(F.col("node").alias("first"), "label"), "first", "left").select(
        "doc_id", F.coalesce("label", "first").alias("component_id")
    ).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    own = F.coalesce("component_id", "doc_id")
    return signed.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(generate_series(1, len(w) - 4),
    lambda i: array_to_string(w[i:i + 4], ' '))) ELSE [array_to_string(w, ' ')] END) AS h FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 85 * (x.n + y.n - common)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
