"""Trie of conversation prefixes, from fingerprints that are put together without rebuilding a text.

A rebuilt conversation is the head of a base conversation followed by the rest of its own turns. The fingerprint of a
sequence is the sum over its places i of (digest of turn i) * B^i modulo a prime, for several B: sequences of this kind
form a monoid in which a stretch of own turns is a difference of running sums, moved to its new place by one
multiplication. So every prefix of every rebuilt conversation gets its fingerprint from running sums over the table's own
turns; rows name turns by (conversation, place) and their digest, never by text.

Prefixes of equal fingerprint are one node. Their equality is verified from the stored turns: all members of a node have
one last turn and one parent. A collision found there starts again with other bases.

Sums over subtrees need no walk through the trie. A node is owned by its smallest member, which is also a member of every
node above, so the sum over the subtree of v is a sum over the members of v of what each has, or owns, from that depth on.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolytics.llm.batches import bounded
from odolytics.llm.ranking import ranked, written

PRIME = (1 << 31) - 1
LANES = 4                   # fingerprints have 4 x 31 bits
GROUP = 5                   # conversations c - c % 5 lend their head
MOST_HEAD = 8               # turns in a head at most
BLOCK = 4096                # places per block of running sums
CHUNK_BYTES = 1 << 16       # ids joined into one piece of a list before it is hashed
_EMPTY = hashlib.sha256(b"").hexdigest()


def bases(attempt: int) -> list[int]:
    return [random.Random(f"{attempt}-{k}").randrange(1 << 20, PRIME - 1) for k in range(LANES)]


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo the prime, by repeated squaring."""
    out, square, left = np.ones(len(exponents), np.int64), base, exponents.copy()
    while left.any():
        out = np.where(left & 1, out * square % PRIME, out)
        square, left = square * square % PRIME, left >> 1
    return out


def _terms(lanes: list[int]):
    """Adds each turn's terms, one per lane: a part of its digest times a power of the base for its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            raw = np.frombuffer(b"".join(bytes.fromhex(s) for s in batch.column("turn_sha").to_pylist()), ">u8").reshape(-1, 4)
            columns = [pa.array(((raw[:, k] % PRIME).astype(np.int64) * _power(b, place)) % PRIME) for k, b in enumerate(lanes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *[f"t{k}" for k in range(LANES)]])

    return run


def _lanes(make) -> list[Column]:
    return [make(k).alias(f"s{k}") for k in range(LANES)]


def _running(rows: DataFrame, values: dict[str, Column], backwards: bool = False) -> DataFrame:
    """Running sums along the places of a conversation (from its end if ``backwards``), as columns of those names.

    Sums run within blocks of places, and each block gets what the blocks before it add up to, so a conversation
    that holds a third of all rows is many window partitions.
    """
    step = (lambda c: F.col(c).desc()) if backwards else F.col
    rows = rows.withColumn("block", F.expr(f"place div {BLOCK}")).withColumns({f"__{n}": v for n, v in values.items()})
    totals = rows.groupBy("conv", "block").agg(*[F.sum(f"__{n}").alias(n) for n in values])
    earlier = Window.partitionBy("conv").orderBy(step("block")).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv", "block", *[F.sum(n).over(earlier).alias(f"before_{n}") for n in values])
    along = Window.partitionBy("conv", "block").orderBy(step("place")).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({n: F.sum(f"__{n}").over(along) for n in values})
    out = inside.join(before, ["conv", "block"])
    kept = [c for c in rows.columns if not c.startswith("__")]
    return out.select(*kept, *[(F.col(n) + F.coalesce(f"before_{n}", F.lit(0))).alias(n) for n in values])


def rebuilt_plan(conversations: DataFrame) -> DataFrame:
    """``conv, base, head`` of each conversation: whose first turns it takes, and how many."""
    c = F.col("conv")
    return conversations.select("conv", (c - c % GROUP).alias("base"), (F.crc32(c.cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("long").alias("head"))


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv, place, turn_sha, bytes`` of every turn, places from 1 in the order of turn, role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), sha.alias("turn_sha"), F.octet_length(text).cast("long").alias("bytes")
    )
    placed = ranked(rows, "conv", ["turn", "turn_sha"], "trie-turns")
    return written(placed.select("conv", (F.col("at") + 1).alias("place"), "turn_sha", "bytes"), "trie-placed")


def _key(lanes: list[Column]) -> list[Column]:
    """Two numbers out of four lanes."""
    return [(F.shiftleft(F.pmod(a, F.lit(PRIME)), 31) + F.pmod(b, F.lit(PRIME))) for a, b in zip(lanes[::2], lanes[1::2])]


def _members(turns: DataFrame, lanes: list[int]) -> DataFrame:
    """One row per rebuilt conversation and depth: ``conv, place, f1, f2`` and the parent's ``p1, p2``, the stored
    turn (``ref, ref_place, turn_sha, bytes``) and whether the conversation ends there."""
    schema = turns.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    terms = turns.mapInArrow(_terms(lanes), ", ".join([schema, *[f"t{k} long" for k in range(LANES)]]))
    sums = written(_running(terms, {f"s{k}": F.col(f"t{k}") for k in range(LANES)}), "trie-sums")

    # The first turns of each conversation, at most eight, and its length.
    first = F.array_sort(F.collect_list(F.when(F.col("place") <= MOST_HEAD, F.struct("place", "turn_sha", "bytes", *[f"s{k}" for k in range(LANES)], *[f"t{k}" for k in range(LANES)]))))
    convs = sums.groupBy("conv").agg(F.max("place").alias("n"), first.alias("first"))
    plan = rebuilt_plan(convs.select("conv")).join(convs, "conv")
    lent = convs.where(F.col("conv") % GROUP == 0).select(F.col("conv").alias("base"), F.col("first").alias("lent"))
    lent = plan.join(lent, "base", "left").withColumn("lent", F.slice(F.coalesce("lent", F.array().cast(convs.schema["first"].dataType)), F.lit(1), F.col("head").cast("int")))
    taken = F.size("lent").cast("long")
    left_out = F.least("head", "n").cast("int")         # own turns that the head replaces
    at_end = F.when(taken > 0, F.element_at("lent", F.nullif(taken.cast("int"), F.lit(0))))
    own_at = F.when(left_out > 0, F.element_at("first", F.nullif(left_out, F.lit(0))))
    inverse = {k: [pow(pow(b, j, PRIME), -1, PRIME) for j in range(MOST_HEAD + 1)] for k, b in enumerate(lanes)}
    plan = lent.select(
        "conv", "base", "head", "lent", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length"),
        *[F.coalesce(at_end[f"s{k}"], F.lit(0)).alias(f"lent_s{k}") for k in range(LANES)],
        *[F.coalesce(own_at[f"s{k}"], F.lit(0)).alias(f"own_s{k}") for k in range(LANES)],
        *[F.element_at(F.array(*[F.lit(v) for v in inverse[k]]), (F.col("head") - taken + 1).cast("int")).alias(f"move{k}") for k in range(LANES)],
    )
    plan = written(plan, "trie-plan")

    # Own turns behind the head: the plan goes along by block, so no conversation is one join key.
    blocks = sums.select("conv", "block").distinct().join(plan.drop("lent", "base"), "conv")
    behind = sums.where(F.col("place") > 0).join(blocks, ["conv", "block"]).where("place > head")

    def moved(k: int) -> Column:
        return F.col(f"lent_s{k}") + F.pmod(F.col(f"s{k}") - F.col(f"own_s{k}"), F.lit(PRIME)) * F.col(f"move{k}") % PRIME

    def term(k: int) -> Column:
        return F.col(f"t{k}") * F.col(f"move{k}") % PRIME

    depth = F.col("place") - F.col("head") + F.col("taken")
    own = behind.select(
        "conv", depth.alias("place"), *_named(_key([moved(k) for k in range(LANES)]), _key([moved(k) - term(k) for k in range(LANES)])),
        F.col("conv").alias("ref"), F.col("place").alias("ref_place"), "turn_sha", "bytes", (depth == F.col("length")).alias("ends"),
    )
    head = plan.select("conv", "base", "length", F.explode("lent").alias("l")).select(
        "conv", F.col("l.place").alias("place"),
        *_named(_key([F.col(f"l.s{k}") for k in range(LANES)]), _key([F.col(f"l.s{k}") - F.col(f"l.t{k}") for k in range(LANES)])),
        F.col("base").alias("ref"), F.col("l.place").alias("ref_place"), F.col("l.turn_sha").alias("turn_sha"), F.col("l.bytes").alias("bytes"),
        (F.col("l.place") == F.col("length")).alias("ends"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = plan.select(
        "conv", zero.alias("place"), *_named([zero, zero], [none, none]), none.alias("ref"), none.alias("ref_place"),
        F.lit("").alias("turn_sha"), zero.alias("bytes"), (F.col("length") == 0).alias("ends"),
    )
    return written(own.union(head).union(root), "trie-members")


def _named(key: list[Column], parent: list[Column]) -> list[Column]:
    return [key[0].alias("f1"), key[1].alias("f2"), parent[0].alias("p1"), parent[1].alias("p2")]


NODE = ["place", "f1", "f2"]


def _nodes(members: DataFrame) -> DataFrame:
    """One row per fingerprint and depth, with the smallest and largest stored turn and parent among its members."""
    parent = F.struct("p1", "p2")
    return written(
        members.groupBy(*NODE).agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.count_if("ends").alias("n_ends"),
            F.min_by(F.struct("ref", "ref_place"), "conv").alias("turn"),
            F.min("turn_sha").alias("turn_sha"), F.max("turn_sha").alias("other_sha"), F.min(parent).alias("parent"), F.max(parent).alias("other_parent"),
        ),
        "trie-nodes",
    )


def _ends(members: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node, in ascending order.

    Ids are sorted over all tasks and joined into pieces of 64 KB; the last task of a node only runs the hash
    over its pieces as they come, so its memory does not grow with the node.
    """
    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = written(members.where("ends").select(*NODE, "conv"), "trie-ends")
    sorted_ends = ends.repartitionByRange(parts, *NODE, "conv").sortWithinPartitions(*NODE, "conv")
    pieces = sorted_ends.mapInArrow(_pieces, "place long, f1 long, f2 long, conv long, ids string")
    by_node = bounded(pieces).repartition(*NODE).sortWithinPartitions(*NODE, "conv")
    return by_node.mapInArrow(_hashed, "place long, f1 long, f2 long, ends_sha256 string")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive ids of one node as comma-joined strings, named by their first id."""
    node, first, said, size = None, None, [], 0
    out = []

    def close():
        if said:
            out.append((*node, first, ",".join(said)))

    def flush():
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string()])], names=[*NODE, "conv", "ids"])
        out.clear()
        return made

    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv"))):
            if key != node or size > CHUNK_BYTES:
                close()
                node, first, said, size = key, conv, [], 0
            said.append(str(conv))
            size += len(said[-1]) + 1
        if len(out) >= 10_000 or sum(len(o[-1]) for o in out) > (1 << 22):
            yield flush()
    close()
    if out:
        yield flush()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state, out = None, None, []
    types = [pa.int64()] * 3 + [pa.string()]
    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if key != node:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[*NODE, "ends_sha256"])
            out = []
    if node:
        out.append((*node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[*NODE, "ends_sha256"])


def prefix_trie(conversations: DataFrame, attempts: int = 3) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_ends, turn_conv, turn_place``
    per node.

    A node is a distinct sequence of the first ``depth`` turns of the rebuilt conversations, named by its smallest member
    and its depth. ``turn_conv, turn_place`` say where its last turn is stored: the conversation that the row belongs to
    and its place there, from 1 (missing for the root). ``n_ends`` conversations end at the node. Turns of one number are ordered by a digest of role and text; repeated rows are turns of
    their own. A missing role or text is empty. Rows without a conversation id belong to none and are left out. Other
    columns are not read; without a conversation there is no root and no result.
    """
    turns = _turns(conversations)
    for attempt in range(attempts):
        members = _members(turns, bases(attempt))
        nodes = _nodes(members)
        if nodes.where("turn_sha <> other_sha OR NOT (parent <=> other_parent)").isEmpty():
            break
    else:
        raise RuntimeError(f"fingerprints collided for {attempts} sets of bases")

    children = nodes.where("place > 0").groupBy((F.col("place") - 1).alias("place"), F.col("parent.p1").alias("f1"), F.col("parent.p2").alias("f2"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = written(counted, "trie-counted")
    above = nodes.select((F.col("place") + 1).alias("place"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv").alias("parent_conv"))
    with_parent = counted.withColumn("p1", F.col("parent.p1")).withColumn("p2", F.col("parent.p2")).join(above, ["place", "p1", "p2"], "left")

    # What each member has, and what it owns, from every depth on.
    owned = counted.select("conv", "place", (F.col("n_children") == 0).alias("leaf"))
    along = members.select("conv", *NODE, "bytes").join(owned, ["conv", "place"], "left")
    spare = F.when(F.col("leaf").isNull(), F.col("bytes")).otherwise(F.lit(0))
    below = _running(along, {"saved": spare, "leaves": F.coalesce(F.col("leaf"), F.lit(False)).cast("long")}, backwards=True)
    sums = below.groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    out = with_parent.join(sums, NODE).join(_ends(members), NODE, "left")
    return out.select(
        F.col("conv").alias("conv_id"), F.col("place").alias("depth"), F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"), "n_ends",
        F.col("turn.ref").alias("turn_conv"), F.col("turn.ref_place").alias("turn_place"),
    )


ORACLE = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, r: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'role': role, 'text': text, 'conv': conv_id, 'place': place}} ORDER BY place) AS own FROM o GROUP BY conv_id),
h AS (
  SELECT conv_id, own, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % {MOST_HEAD + 1} AS head FROM c, crc),
r AS (
  SELECT h.conv_id, list_concat(coalesce(c.own, [])[1:head], h.own[head + 1:]) AS turns
  FROM h LEFT JOIN c ON c.conv_id = h.conv_id - h.conv_id % {GROUP}),
s AS (SELECT conv_id, turns, list_transform(turns, lambda x: {{'role': x.role, 'text': x.text}}) AS said FROM r),
p AS (SELECT conv_id, turns, said, unnest(range(0, len(said) + 1)) AS depth FROM s),
n AS (
  SELECT depth, said[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs, arg_min(turns[depth], conv_id) AS turn,
    count(*) FILTER (WHERE depth = len(said)) AS n_ends,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len(said)), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
k AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
v AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(path[depth].text) ELSE 0 END AS saved
  FROM n LEFT JOIN k USING (depth, path)),
w AS (
  SELECT up, path[1:up] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM v) GROUP BY 1, 2)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256, v.n_ends,
  v.turn.conv AS turn_conv, v.turn.place AS turn_place
FROM v JOIN w ON w.up = v.depth AND w.path = v.path LEFT JOIN n q ON q.depth = v.depth - 1 AND q.path = v.path[1:v.depth - 1]
"""
