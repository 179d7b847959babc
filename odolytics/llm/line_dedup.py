"""Substring dedup by units: lines, and the sentences inside a line, keep their first occurrence in the whole corpus.

Units are compared after lowering A-Z and joining their words by single spaces. A digest table (one row per
unit, 128 bits of hash) is grouped; the least (rank, place) of a digest stays, all others go. Grouping is
combined before the shuffle, so a line that a third of all documents share costs one row per task.

Every line with a word is a unit. A line of several sentences is searched within as well, so that a passage copied
into the middle of a line is found: its sentences are units of their own if they are ``SENTENCE_CHARS`` long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolytics.functions.columns import broadcast_under
from odolytics.llm import tokens
from odolytics.llm.batches import bounded
from odolytics.session import work_path

SENTENCE_CHARS = 40         # characters of a sentence, its words joined by single spaces, that make it a unit inside its line

_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True
UNITS = "doc_id long, version long, unit int, d1 long, d2 long"


@dataclass
class Units:
    """Units of a batch of texts, in order: a line, then its sentences."""

    row: np.ndarray         # which text
    place: np.ndarray       # which unit of it
    line: np.ndarray        # which line of the batch
    start: np.ndarray       # bytes of the batch
    end: np.ndarray
    whole: np.ndarray       # a line, not a sentence of one
    digests: tuple[np.ndarray, np.ndarray]


def _units(raw: np.ndarray, offsets: np.ndarray, sentence_chars: int | None) -> Units:
    breaks = np.flatnonzero(raw == 10)
    begins = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    begins = begins[begins < len(raw)]
    # A line ends at its line break, or where the next text begins.
    ends = np.append(begins[1:], len(raw))
    ends = ends - ((raw[ends - 1] == 10) if len(ends) else 0)
    hashes, at, to = tokens.words_at(raw, np.append(begins, len(raw)) if len(begins) else np.zeros(1, np.int64))
    line_of_word = np.searchsorted(begins, at, "right") - 1
    first = np.searchsorted(line_of_word, np.arange(len(begins)))
    last = np.searchsorted(line_of_word, np.arange(len(begins)), "right")
    held = np.flatnonzero(last > first)
    lines = (held, first[held], last[held], begins[held], ends[held])
    if sentence_chars is None or not len(at):
        inner = tuple(np.zeros(0, np.int64) for _ in range(5))
    else:
        opens = np.ones(len(at), dtype=bool)
        opens[1:] = (line_of_word[1:] != line_of_word[:-1]) | _STOP[raw[to[:-1] - 1]]
        lead = np.flatnonzero(opens)
        stop = np.append(lead[1:], len(at))
        line = line_of_word[lead]
        same_before = np.append(False, line[1:] == line[:-1])
        same_after = np.append(line[1:] == line[:-1], False)
        start = np.where(same_before, at[lead], begins[line])
        end = np.where(same_after, np.append(at[lead[1:]], 0), ends[line])
        chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        word_chars = np.append(0, np.cumsum(chars[to] - chars[at]))
        long = word_chars[stop] - word_chars[lead] + (stop - lead - 1)
        kept = np.flatnonzero((same_before | same_after) & (long >= sentence_chars))
        inner = (line[kept], lead[kept], stop[kept], start[kept], end[kept])
    merged = [np.concatenate(parts) for parts in zip(lines, inner)]
    whole = np.arange(len(merged[0])) < len(held)
    order = np.lexsort((merged[1], ~whole, merged[0]))
    line, word, word_end, start, end = (m[order] for m in merged)
    row = np.searchsorted(offsets, start, "right") - 1
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return Units(row, place, line, start, end, whole[order], tokens.sequence_digests(hashes, word, word_end))


def _digests(sentence_chars: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in tokens.parts(whole, "text")):
            units = _units(*tokens.text_bytes(batch.column("text")), sentence_chars)
            for at in range(0, len(units.row), 100_000):
                cut = slice(at, at + 100_000)
                of = pa.array(units.row[cut])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(of), batch.column("version").take(of), pa.array(units.place[cut].astype(np.int32)),
                     *[pa.array(d[cut].view(np.int64)) for d in units.digests]],
                    names=["doc_id", "version", "unit", "d1", "d2"],
                )

    return run


def _rebuild(sentence_chars: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in tokens.parts(whole, "text")):
            raw, offsets = tokens.text_bytes(batch.column("text"))
            units = _units(raw, offsets, sentence_chars)
            chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
            heads = np.searchsorted(units.row, np.arange(len(offsets)))
            n_units, n_removed, removed_chars, digest, kept, spans = [], [], [], [], [], []
            lists = batch.column("gone").to_pylist()
            missing = batch.column("text").is_null().to_pylist()
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                text = raw[a:b].tobytes()
                places = np.sort(np.array(lists[k] or [], np.int64)) + heads[k]
                # A sentence of a line that goes whole is not removed once more.
                gone_lines = units.line[places[units.whole[places]]]
                places = places[units.whole[places] | ~np.isin(units.line[places], gone_lines)]
                cut = list(zip((units.start[places] - a).tolist(), (units.end[places] - a).tolist()))
                stays = _cut_out(text, cut) if cut else text
                said = [{"a": int(chars[a + s] - chars[a]), "b": int(chars[a + e] - chars[a])} for s, e in cut]
                n_units.append(text.count(b"\n") + 1 if text else 0)
                n_removed.append(len(cut))
                removed_chars.append(sum(c["b"] - c["a"] for c in said))
                digest.append(hashlib.md5(stays).hexdigest())
                kept.append(None if missing[k] else stays.decode())
                spans.append(said)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_units, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(removed_chars, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                names=["doc_id", "n_units", "n_removed", "removed_chars", "kept_md5", "kept_text", "removed"],
            )

    return run


def _cut_out(text: bytes, cut: list[tuple[int, int]]) -> bytes:
    """A text without the given spans, in one pass; a line with a span and nothing left goes with its line break."""
    out, at, i = [], 0, 0
    for line in text.split(b"\n"):
        end, stays, here, touched = at + len(line), [], at, False
        while i < len(cut) and cut[i][1] <= end:
            stays.append(text[here : cut[i][0]])
            here, touched, i = cut[i][1], True, i + 1
        left = b"".join(stays) + text[here:end]
        if left or not touched:
            out.append(left)
        at = end + 1
    return b"\n".join(out)


def line_dedup(docs: DataFrame, sentence_chars: int | None = SENTENCE_CHARS) -> DataFrame:
    """``doc_id, n_units, n_removed, removed_chars, kept_md5, kept_text, removed`` for every row of ``docs``.

    The earliest occurrence, by (doc_id, place in the text), of each unit stays: of every line with a word, and of every
    sentence of ``sentence_chars`` characters inside a line of several (``None``: lines only). A sentence ends at a word
    ending in . ! or ?. ``n_units`` counts lines; ``removed`` holds the (start, end) character offsets in the original
    text of the lines and sentences taken out, a sentence with the white space behind it; a line that loses all its
    sentences goes with its line break, as one that goes whole does. NULL and empty texts have no units. Rows that are
    equal in id and text lose the same units. Rows of one id with different texts are ranked by a hash of the text. A row
    without an id is ranked last. Other columns are not read; no rows, no result.
    """
    spark = bounded(docs).sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("version"))
    path = work_path(spark, "units")
    read.mapInArrow(_digests(sentence_chars), UNITS).write.parquet(path)
    units = spark.read.schema(UNITS).parquet(path)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version", "unit")
    first = units.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = units.join(first.select("d1", "d2", "first"), ["d1", "d2"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.expr("version = first.version AND unit = first.unit"))
    )
    per_doc = gone.groupBy("doc_id", "version").agg(F.collect_set("unit").alias("gone"))
    path = work_path(spark, "units-gone")
    per_doc.write.parquet(path)
    per_doc = spark.read.schema("doc_id long, version long, gone array<int>").parquet(path)
    per_doc = broadcast_under(per_doc.withColumnsRenamed({"doc_id": "id", "version": "v"}), F.size("gone") * 8 + 40)
    both = read.join(per_doc, read.doc_id.eqNullSafe(per_doc.id) & (read.version == per_doc.v), "left")
    return both.select("doc_id", "text", "gone").mapInArrow(
        _rebuild(sentence_chars),
        "doc_id long, n_units long, n_removed long, removed_chars long, kept_md5 string, kept_text string, "
        "removed array<struct<a:bigint,b:bigint>>",
    )


def _oracle(sentence_chars: int) -> str:
    return rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, unnest(generate_series(1, len(string_split(text, chr(10))))) AS line
  FROM documents WHERE text <> ''),
c AS (
  SELECT *, list_filter(regexp_extract_all(unit, '.*?(?:[.!?][ 	-
]+|$)'), lambda x: x <> '') AS cuts FROM l),
u AS (
  SELECT doc_id, line, 0 AS piece, 0 AS least, unit FROM c
  UNION ALL SELECT doc_id, line, unnest(generate_series(1, len(cuts))), {sentence_chars}, unnest(cuts) FROM c WHERE len(cuts) > 1),
w AS (
  SELECT *, array_to_string(regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+'), ' ') AS said FROM u),
r AS (
  SELECT doc_id, unit, line, piece, said <> '' AND length(said) >= least
    AND row_number() OVER (PARTITION BY said, length(said) >= least ORDER BY doc_id, line, piece) > 1 AS repeated FROM w),
g AS (SELECT *, max(CASE WHEN piece = 0 THEN repeated END) OVER (PARTITION BY doc_id, line) AS whole FROM r),
k AS (
  SELECT doc_id, line, any_value(whole) AS whole, count(*) FILTER (WHERE repeated AND (piece = 0 OR NOT whole)) AS n_removed,
    coalesce(sum(length(unit)) FILTER (WHERE repeated AND (piece = 0 OR NOT whole)), 0) AS removed_chars,
    any_value(unit) FILTER (WHERE piece = 0) AS unit, count(*) AS n,
    coalesce(string_agg(unit, '' ORDER BY piece) FILTER (WHERE piece > 0 AND NOT repeated), '') AS stays
  FROM g GROUP BY doc_id, line),
d AS (
  SELECT doc_id, count(*) AS n_units, sum(n_removed) AS n_removed, sum(removed_chars) AS removed_chars,
    md5(coalesce(string_agg(CASE WHEN n > 1 THEN stays ELSE unit END, chr(10) ORDER BY line) FILTER (WHERE NOT whole AND (n = 1 OR stays <> '')), '')) AS kept_md5
  FROM k GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(removed_chars, 0)::BIGINT AS removed_chars, coalesce(kept_md5, md5('')) AS kept_md5
FROM documents LEFT JOIN d USING (doc_id)
"""


ORACLE = _oracle(SENTENCE_CHARS)

# The same over lines alone: no text has a sentence of a billion characters.
ORACLE_EVERY_LINE = _oracle(1_000_000_000)
