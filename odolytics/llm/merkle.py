"""Merkle manifest of a dataset: one tree of document digests per source, and one tree over the sources.

A level is a table of nodes with their index in the tree. Each node finds its run's other members by an equijoin with
the indices worked out from its own (slot + 1 and slot + 2, modulo the run); then the nodes at slot zero emit their
parents. Proofs come down the same tables: a node's path is its own siblings and then the path of its parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolytics.llm.ranking import ranked, written

SLOTS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    said = value.cast("string")
    return F.when(said.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said))


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of a row: each field as its number of bytes, a colon and the value; a dash where it is missing."""
    return digest(*[_field(values[f]) for f in FIELDS])


def levels_of(nodes: int) -> int:
    """Levels of runs below the root of a tree with so many leaves."""
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // SLOTS), height + 1
    return height


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with the digests of their run's members before (``left``) and after them (``right``)."""
    others = nodes.select("key", F.col("at").alias("sibling"), F.col("hash").alias("found"))
    out = nodes
    for shift in range(1, SLOTS):
        index = F.col("at") - F.col("at") % SLOTS + (F.col("at") + shift) % SLOTS
        out = out.withColumn("sibling", index).join(others, ["key", "sibling"], "left")
        out = out.withColumn(f"other{shift}", F.coalesce("found", F.lit(""))).drop("sibling", "found")

    def joined(slots: range, slot: int) -> Column:
        parts = [F.col(f"other{(s - slot) % SLOTS}") for s in slots]
        return F.concat(*parts) if parts else F.lit("")

    left = right = None
    for slot in range(SLOTS):
        here = F.col("at") % SLOTS == slot
        before, after = joined(range(slot), slot), joined(range(slot + 1, SLOTS), slot)
        left = F.when(here, before) if left is None else left.when(here, before)
        right = F.when(here, after) if right is None else right.when(here, after)
    return out.select(*nodes.columns, left.alias("left"), right.alias("right"))


def build(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees of ``key, at, n, hash`` leaves (``n``: leaves of the tree), and their roots.

    Every level is written with the siblings of its nodes, and read for its parents and later for the proofs.
    ``key, hash, height`` of the roots: one row per tree.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], []
    for level in range(levels_of(most)):
        roots.append(nodes.where("n = 1").select("key", "hash", F.lit(level).alias("height")))
        levels.append(written(_with_siblings(nodes.where("n > 1")), f"{name}-{level}"))
        heads = levels[-1].where(F.col("at") % SLOTS == 0)
        nodes = heads.select(
            "key", F.expr(f"at div {SLOTS}").alias("at"), F.expr(f"(n + {SLOTS - 1}) div {SLOTS}").alias("n"), digest(F.col("hash"), F.col("right")).alias("hash")
        )
    out = nodes.select("key", "hash", F.lit(len(levels)).alias("height"))
    for some in roots:
        out = out.union(some)
    return levels, written(out, f"{name}-roots")


def paths(levels: list[DataFrame], tops: DataFrame, leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``steps``, their siblings level by level up to what ``tops`` say, and the other columns of ``tops``.

    ``tops`` has ``key, height, steps`` and further columns, one row per tree.
    """
    carried = [c for c in tops.columns if c not in ("key", "height")]
    above = None
    for level in range(len(levels), -1, -1):
        ends = tops.where(F.col("height") == level).select("key", F.lit(0).cast("long").alias("at"), *carried)
        if level == len(levels):
            above = ends
            continue
        under = levels[level].select("key", F.col("at").alias("own"), "left", "right", F.expr(f"at div {SLOTS}").alias("at"))
        step = F.array(F.struct("left", "right"))
        rest = [F.concat(step, "steps").alias("steps") if c == "steps" else F.col(c) for c in carried]
        above = under.join(above, ["key", "at"]).select("key", F.col("own").alias("at"), *rest).union(ends)
    return leaves.join(above, ["key", "at"])


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, n_levels`` for every row of ``docs``.

    Leaves of a source ascend by (doc_id, digest), an id that is missing first; rows equal in both are copies of one
    leaf, each with a place of its own. Sources ascend by their bytes, the missing one first. ``folded_root`` is worked
    out again from the row as it is read now: where 2 divides the CRC of the id, that row has lost its line breaks
    (a row without an id is as it was). ``n_levels`` counts the levels from leaf to root. Columns other than the five
    of a leaf are not read; no rows, no result.
    """
    own = {f: F.col(f) for f in FIELDS}
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    now = own | {"text": F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    key = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source")))
    leaves = docs.select(key.alias("key"), "doc_id", leaf_digest(own).alias("hash"), leaf_digest(now).alias("now"))
    placed = written(ranked(leaves, "key", ["doc_id", "hash"], "merkle-leaves"), "merkle-placed")
    sizes = placed.groupBy("key").agg(F.count("*").alias("n"))
    nodes = placed.select("key", "at", "hash").join(sizes, "key").select("key", "at", "n", "hash")
    levels, subroots = build(nodes, "merkle-source")

    # The tree over sources is the same with one key.
    named = subroots.select(F.lit("").alias("key"), F.col("key").alias("source"), "hash", F.lit(subroots.count()).cast("long").alias("n"))
    tree = written(ranked(named, "key", ["source"], "merkle-sources"), "merkle-sources-placed")
    top_levels, root = build(tree.select("key", "at", "n", "hash"), "merkle-top")
    top = root.select("key", "height", F.array().cast(_STEPS).alias("steps"), F.col("hash").alias("root"))
    sources = paths(top_levels, top, tree.select("key", "at", "source", F.col("hash").alias("subroot")))
    tops = sources.select(F.col("source").alias("key"), "steps", "root", "subroot").join(subroots.select("key", "height"), "key")
    tops = written(tops, "merkle-tops")

    found = paths(levels, tops, placed.select("key", "at", "doc_id", F.col("hash").alias("leaf"), "now"))
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("steps", F.col("now"), lambda h, s: digest(s["left"], h, s["right"]))
    out = found.select("doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), folded.alias("folded_root"), F.size("steps").cast("long").alias("n_levels"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "n_levels")


_SQL_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"

ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, r: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
d AS (
  SELECT *, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295) % 2 = 1 AS tampered FROM documents, crc),
l AS (
  SELECT doc_id, coalesce('1' || source, '0') AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
    sha256({" || ".join(_SQL_FIELD.format(f) for f in FIELDS)}) AS leaf,
    sha256({" || ".join(_SQL_FIELD.format(f if f != "text" else "(CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END)") for f in FIELDS)}) AS now
  FROM d),
s AS (
  SELECT k, 0 AS level, list(leaf ORDER BY pos) AS h FROM l GROUP BY k
  UNION ALL
  SELECT k, level + 1, list_transform(range(0, (len(h) + {SLOTS - 1}) // {SLOTS}), lambda i: sha256(array_to_string(h[{SLOTS} * i + 1 : {SLOTS} * i + {SLOTS}], '')))
  FROM s WHERE len(h) > 1),
u AS (
  SELECT 0 AS level, list(h[1] ORDER BY k) AS h FROM s WHERE len(h) = 1
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(h) + {SLOTS - 1}) // {SLOTS}), lambda i: sha256(array_to_string(h[{SLOTS} * i + 1 : {SLOTS} * i + {SLOTS}], '')))
  FROM u WHERE len(h) > 1),
roots AS (SELECT k, h[1] AS subroot, row_number() OVER (ORDER BY k) - 1 AS place FROM s WHERE len(h) = 1),
n AS (
  SELECT l.*, s.level, pos // ({SLOTS} ** s.level)::BIGINT AS here, h FROM l JOIN s USING (k) WHERE len(h) > 1
  UNION ALL
  SELECT l.*, 1000 + u.level, place // ({SLOTS} ** u.level)::BIGINT, h FROM l JOIN roots USING (k), u WHERE len(h) > 1),
steps AS (
  SELECT doc_id, k, list(array_to_string(h[here - here % {SLOTS} + 1 : here], '') || '|' ||
    array_to_string(h[here + 2 : here - here % {SLOTS} + {SLOTS}], '') ORDER BY level) AS steps
  FROM n GROUP BY doc_id, k)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(coalesce(steps, []), ''), '|', '')) AS proof_sha256,
  list_reduce(coalesce(steps, []), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), now) AS folded_root,
  folded_root = root AS verified, len(coalesce(steps, []))::BIGINT AS n_levels
FROM l JOIN roots USING (k) LEFT JOIN steps USING (doc_id, k), (SELECT h[1] AS root FROM u WHERE len(h) = 1)
"""
