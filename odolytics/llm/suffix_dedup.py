"""Removal of byte strings that repeat across documents, by a collection suffix order.

1. *Runs.* Each 50-byte window has a key, the least hash of the 20-byte grams in it. Equal windows have equal
   keys. Neighbouring windows with one key form a run; a run of m windows is a string of m + 49 bytes.
2. *Equal runs.* Runs are dealt out by key, as a key and a hash of the string. A run whose very string a
   smaller id has goes as a whole. The first holder of a string stays, unless its key has another string that
   agrees with it to the left or to the right of the gram: then they may share windows, and it is still open. Equal runs within one group
   of documents are settled there, so a very common passage sends one entry per group.
3. *Suffix order.* Open strings are dealt out by key. A task builds the Burrows-Wheeler transform and the common
   prefixes of its strings some columns at a time (see ``bwt``). Suffixes whose common prefix is at least 50 share
   a window; the least id over such a stretch is the window's first document.
4. *Spans.* Whole runs and stretches of windows first seen under a smaller id are joined up per document.

The key decides which strings can share a window, so each collection is complete in itself, and strings are
at most MOST_WINDOWS + 49 bytes long, which bounds the rounds. Open strings of a very common key are taken
window by window instead, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolytics.llm.batches import bounded
from odolytics.functions.columns import broadcast_if_small, broadcast_under
from odolytics.llm import tokens
from odolytics.llm.bwt import collection_bwt
from odolytics.session import work_path

WINDOW = 50
GRAM = 20
MOST_WINDOWS = WINDOW - GRAM + 1    # as many windows as one gram can lie in
SHARD_BYTES = 8 << 20       # text per shard
GROUP_BYTES = 4 << 20       # text whose equal runs are settled together
SIDE = (WINDOW - GRAM) // 2         # 50 bytes around a 20-byte gram hold 15 on one side of it or on the other
NO_SIDE, ANY_SIDE = 0, 255
RUNS_AT_ONCE = 16384        # runs whose strings are cut out together
TOGETHER_BYTES = 256 << 10  # short texts looked at together
COLLECTION_BYTES = 32 << 10 # text ordered at once, if keys allow
HOT_STRINGS = 50_000        # open runs of one key that are ordered in one task
NO_ID = np.iinfo(np.int64).max

_U = np.uint64


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _pieces(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that add up to so many bytes at most; a longer text is a range of its own."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def _runs_of(raw: np.ndarray, offsets: np.ndarray, with_gram: bool = False) -> tuple[np.ndarray, ...]:
    """Text, key, first window and number of windows of each run of many texts, first windows counted from the
    text's start; if asked for also a hash of its string and the sides of its gram (see ``_sides``)."""
    found = []
    for low, high in _pieces(offsets, min(TOGETHER_BYTES, tokens.PIECE_BYTES)):
        bounds = offsets[low : high + 1] - offsets[low]
        part = raw[offsets[low] : offsets[high]]
        prefix = tokens.prefix_hashes(part) if with_gram else None
        for at in range(0, len(part) - WINDOW + 1, tokens.PIECE_BYTES):
            row, key, first, size, gram = _piece_runs(part, bounds, at, prefix, with_gram)
            out = [row + low, key, first - bounds[row], size]
            if with_gram:
                out += [tokens.stretch_hashes(prefix, first, first + size + WINDOW - 1), _sides(prefix, gram, bounds[row], bounds[row + 1])]
            found.append(out)
    if not found:
        none = np.zeros(0, np.int64)
        return none, none.view(_U), none, none, *([none.view(_U), np.zeros((2, 0), np.uint8)] if with_gram else [])
    return tuple(np.concatenate(x, axis=-1) for x in zip(*found))


def _piece_runs(part: np.ndarray, bounds: np.ndarray, at: int, prefix: np.ndarray | None, with_gram: bool) -> tuple[np.ndarray, ...]:
    """Text, key, first window, number of windows and place of the gram of each run that begins in one piece."""
    piece = part[at : at + tokens.PIECE_BYTES + WINDOW - 1]
    whole = prefix is not None and len(piece) == len(part)
    hashes = tokens.gram_hashes(prefix if whole else tokens.prefix_hashes(piece), GRAM)
    least = _smallest(hashes, MOST_WINDOWS)
    # A text's windows stop 49 bytes before it does. Only a text on its own is longer than a piece.
    starts = np.maximum(bounds[:-1] - at, 0)
    stops = np.maximum(np.minimum(bounds[1:] - at, len(piece)) - WINDOW + 1, starts)
    head = np.concatenate(([True], least[1:] != least[:-1]))
    head[starts[starts < len(least)]] = True
    head[stops[stops < len(least)]] = True
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(least)))
    row = np.searchsorted(starts, first, "right") - 1
    real = first < stops[row]
    first, size, row = first[real], size[real], row[real]
    pieces = -(-size // MOST_WINDOWS)
    if len(pieces) and pieces.max() > 1:
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + inner * MOST_WINDOWS
        size = np.minimum(np.repeat(size, pieces) - inner * MOST_WINDOWS, MOST_WINDOWS)
        row = np.repeat(row, pieces)
    key = least[first]
    gram = _only_places(hashes, least, key, first, size, at) if with_gram else first
    return row, key, first + at, size, gram


def _runs(raw: np.ndarray, with_gram: bool = False) -> tuple[np.ndarray, ...]:
    """Key, first window and number of windows of each run of one text; if asked for also where its gram stands
    (-1: in several places, be they in all of its windows or in some only)."""
    bounds = np.array([0, len(raw)])
    found = [_piece_runs(raw, bounds, at, None, with_gram)[1:] for at in range(0, len(raw) - WINDOW + 1, tokens.PIECE_BYTES)]
    if not found:
        return np.zeros(0, _U), *[np.zeros(0, np.int64)] * (3 if with_gram else 2)
    return tuple(np.concatenate(x) for x in list(zip(*found))[: 4 if with_gram else 3])


def _only_places(hashes: np.ndarray, least: np.ndarray, key: np.ndarray, first: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
    """Where in the windows of each run its gram stands, plus ``at``; -1 if any window may hold it twice.

    All grams of all windows count: of two places one may lie outside of some windows, and another text that has
    only those windows then knows a different place.
    """
    if not len(first):
        return first
    # Only a gram that is the least of some window it is in can be a run's.
    beyond = np.full(MOST_WINDOWS - 1, ~_U(0))
    places = np.flatnonzero(~_smallest(np.concatenate((beyond, ~least, beyond)), MOST_WINDOWS) == hashes)
    low, high = np.searchsorted(places, first), np.searchsorted(places, first + size + MOST_WINDOWS - 1)
    count = high - low
    begin = np.cumsum(count) - count
    place = places[np.arange(count.sum()) + np.repeat(low - begin, count)]
    hit = hashes[place] == np.repeat(key, count)
    return np.where(np.add.reduceat(hit.astype(np.int64), begin) == 1, np.add.reduceat(place * hit, begin) + at, -1)


def _sides(prefix: np.ndarray, gram: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A byte each for the SIDE bytes before and behind a run's gram, in a text that reaches from ``low`` to ``high``.

    Strings that share a gram share a window only if they agree on one of the sides. A side the text is too
    short for agrees with nothing (NO_SIDE); a gram in several places may agree with everything (ANY_SIDE).
    """
    out = np.full((2, len(gram)), ANY_SIDE, dtype=np.uint8)
    for side, start in enumerate((gram - SIDE, gram + GRAM)):
        fits = (gram >= 0) & (start >= low) & (start + SIDE <= high)
        value = tokens.stretch_hashes(prefix, start[fits], start[fits] + SIDE) % _U(254)
        out[side, gram >= 0] = NO_SIDE
        out[side, fits] = value.astype(np.uint8) + 1
    return out


def _together(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after another, and where each starts."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts) if len(texts) > 1 else texts[0], np.uint8), offsets


def _cut(values: np.ndarray, count: np.ndarray, where: np.ndarray | None = None) -> pa.Array:
    """The bytes of so many values a row, one row after another; NULL where not ``where``."""
    offsets = np.zeros(len(count) + 1, dtype=np.int32)
    np.cumsum(count * values.itemsize, out=offsets[1:])
    valid = None if where is None else pa.py_buffer(np.packbits(where, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(count), [valid, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that small numbers leave long runs of zeros to the compressor."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_planes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(dtype)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    raw, offsets = tokens.text_bytes(batch.column("text"))
    ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
    version = batch.column("version").to_numpy(zero_copy_only=False)
    for i in range(len(ids)):
        yield int(ids[i]), int(version[i]), raw[offsets[i] : offsets[i + 1]]


RUN_FIELDS = ("keys", "contents", "sides", "docs", "versions", "counts", "steps")
RUN_SCHEMA = "shard int, " + ", ".join(f"{n} binary" for n in RUN_FIELDS)
FOUND_SCHEMA = "doc_id long, version long, open boolean, runs binary"


def _pack(which: np.ndarray, row: np.ndarray, number: np.ndarray, docs: np.ndarray, versions: np.ndarray) -> list[bytes]:
    """Documents, entries per document, and run numbers as steps from one to the next."""
    used, start, count = np.unique(row[which], return_index=True, return_counts=True)
    steps = np.diff(number[which], prepend=np.uint32(0))
    steps[start] = number[which][start]
    return [_planes(v) for v in (docs[used], versions[used], count.astype(np.uint32), steps.astype(np.uint32))]


def _unpack(docs: bytes, versions: bytes, counts: bytes, steps: bytes) -> tuple[np.ndarray, ...]:
    """Document, version and run number of each entry."""
    count, step = _from_planes(counts, np.uint32).astype(np.int64), _from_planes(steps, np.uint32).astype(np.int64)
    total = np.cumsum(step)
    start = np.cumsum(count) - count
    number = total - np.repeat(total[start] - step[start], count)
    return np.repeat(_from_planes(docs, np.int64), count), np.repeat(_from_planes(versions, np.int64), count), number


def _deal_runs(shards: int):
    """Packed runs for each shard, from groups of documents of a few megabytes."""

    def pack(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        docs, versions = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64)
        row, key, _, _, content, side = _runs_of(*_together([r[2] for r in rows]), with_gram=True)
        number = (np.arange(len(row)) - np.searchsorted(row, np.arange(len(rows)))[row]).astype(np.uint32)
        # Equal strings in this group of documents: only the least id's go on, the others are settled.
        order = np.lexsort((docs[row], content, key))
        k, c, d = key[order], content[order], docs[row][order]
        head = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))
        least = d[np.flatnonzero(head)][np.cumsum(head) - 1]
        settled = np.zeros(len(key), dtype=bool)
        settled[order] = d > least
        columns: list[list] = [[] for _ in range(1 + len(RUN_FIELDS))]

        def add(*values) -> None:
            for column, value in zip(columns, values):
                column.append(value)

        shard = (key % _U(shards)).astype(np.int64)
        short = ((key // _U(shards)) & _U(0xFFFFFFFF)).astype(np.uint32)
        send = np.flatnonzero(~settled)
        send = send[np.argsort(shard[send], kind="stable")]
        for part in np.split(send, np.flatnonzero(np.diff(shard[send])) + 1):
            if len(part):
                add(int(shard[part[0]]), _planes(short[part]), _planes(content[part]), side[:, part].tobytes(), *_pack(part, row, number, docs, versions))
        done = np.flatnonzero(settled)
        if len(done):
            # Settled runs pass through any one group.
            add(-1 - int(tokens.mix(key[:1])[0] % _U(shards)), b"", b"", b"", *_pack(done, row, number, docs, versions))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]], names=["shard", *RUN_FIELDS]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in _rows(batch):
                if len(row[2]) >= WINDOW:
                    rows.append((row[0], row[1], row[2].copy()))
                    size += len(row[2])
                if size >= GROUP_BYTES:
                    yield pack(rows)
                    rows, size = [], 0
        if rows:
            yield pack(rows)

    return run


def _equal_runs(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Runs that go as a whole, and first holders that are open, per document."""
    entries = [_unpack(*(row[n] for n in RUN_FIELDS[3:])) for row in table.select(RUN_FIELDS[3:]).to_pylist()]
    doc, version, number = (np.concatenate(x) for x in zip(*entries))
    if group[0].as_py() < 0:
        whole, unsettled = np.ones(len(doc), dtype=bool), np.zeros(len(doc), dtype=bool)
    else:
        key = np.concatenate([_from_planes(v, np.uint32) for v in table.column("keys").to_pylist()])
        content = np.concatenate([_from_planes(v, _U) for v in table.column("contents").to_pylist()])
        order = np.lexsort((doc, content, key))
        k, c, d = key[order], content[order], doc[order]
        head = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))
        string = np.cumsum(head) - 1
        later = d > d[np.flatnonzero(head)][string]
        # One entry per different string of a key: it is open if another one agrees with it on a side.
        side = np.concatenate([np.frombuffer(v, np.uint8).reshape(2, -1) for v in table.column("sides").to_pylist()], axis=1)[:, order]
        at = np.flatnonzero(head)
        key_of = np.unique(k[at], return_inverse=True)[1]
        wild = np.bincount(key_of, weights=(side[:, at] == ANY_SIDE).any(axis=0)) > 0
        agrees = wild[key_of] & (np.bincount(key_of)[key_of] > 1)
        for one in side[:, at]:
            _, group, size = np.unique(key_of * 256 + one, return_inverse=True, return_counts=True)
            agrees |= (size[group] > 1) & (one != NO_SIDE)
        whole, unsettled = np.zeros(len(doc), dtype=bool), np.zeros(len(doc), dtype=bool)
        whole[order], unsettled[order] = later, ~later & agrees[string]
    parts = []
    for is_open, which in ((False, np.flatnonzero(whole)), (True, np.flatnonzero(unsettled))):
        which = which[np.lexsort((number[which], version[which], doc[which]))]
        d, v = doc[which], version[which]
        head = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])))[: len(which)])
        runs = _cut(number[which].astype(np.uint32), np.diff(np.append(head, len(which))))
        parts.append(pa.table({"doc_id": d[head], "version": v[head], "open": np.full(len(head), is_open), "runs": runs}))
    return pa.concat_tables(parts)


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of a document: whole ones as ranges of numbers, open ones as numbers."""
    for batch in batches:
        found, n = batch.column("found"), len(batch)
        parts = found.flatten()
        data, ends = _bytes_of(parts.field("runs"))
        values = data.view(np.uint32)
        row = np.repeat(np.arange(n), pa.compute.list_value_length(found).to_numpy())
        is_open = parts.field("open").to_numpy(zero_copy_only=False)
        # Row, open or not, and number as one value, each once and in order.
        value = np.unique(np.repeat((row * 2 + is_open) << 32, np.diff(ends) // 4) + values)
        left = value[value >> 32 & 1 == 1]
        value = value[value >> 32 & 1 == 0]
        head = np.flatnonzero(np.concatenate(([True], np.diff(value) > 1))[: len(value)])
        tail = np.append(head[1:], len(value))[: len(head)] - 1
        ranges = np.stack((value[head], value[tail]), axis=1).astype(np.uint32)
        count = np.bincount(left >> 33, minlength=n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("version"), _cut(ranges, 2 * np.bincount(value[head] >> 33, minlength=n)),
             _cut(left.astype(np.uint32), count, count > 0)],
            names=["doc_id", "version", "ranges", "open_runs"],
        )


STRING_SCHEMA = "shard int, key long, doc_id long, version long, first int, string binary"


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        body = [press.compress(raw.tobytes()) for _, _, raw in _rows(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").fill_null(NO_ID), batch.column("version"), pa.array(body, pa.binary())], names=["doc_id", "version", "body"]
        )


def _strings(shards: int):
    """The strings of open runs."""

    def cut_out(rows: list[tuple[int, int, bytes, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        docs, versions = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64)
        raw, offsets = _together([r[2] for r in rows])
        found = _runs_of(raw, offsets)
        begin = np.searchsorted(found[0], np.arange(len(rows)))
        which = np.concatenate([r[3] + b for r, b in zip(rows, begin)])
        for top in range(0, len(which), RUNS_AT_ONCE):
            row, key, first, windows = (x[which[top : top + RUNS_AT_ONCE]] for x in found)
            size = windows + WINDOW - 1
            place = np.arange(size.sum()) + np.repeat(offsets[row] + first - np.cumsum(size) + size, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array((key % _U(shards)).astype(np.int32)), pa.array(key.view(np.int64)), pa.array(docs[row]),
                 pa.array(versions[row]), pa.array(first.astype(np.int32)), _cut(raw[place], size)],
                names=["shard", "key", "doc_id", "version", "first", "string"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, size = [], 0
            for doc_id, version, body, runs in zip(*(batch.column(n) for n in ("doc_id", "version", "body", "open_runs"))):
                rows.append((doc_id.as_py(), version.as_py(), expand.decompress(body.as_py()), np.frombuffer(runs.as_py(), np.uint32)))
                size += len(rows[-1][2])
                if size >= GROUP_BYTES:
                    yield from cut_out(rows)
                    rows, size = [], 0
            if rows:
                yield from cut_out(rows)

    return run


def first_seen(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, holders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of every string the least holder: (string, offset, least), from the suffix order."""
    which, offset, common = collection_bwt(text, starts, ends, WINDOW, shortest=WINDOW)
    if not len(which):
        return which, offset, holders[:0]
    head = np.flatnonzero(common < WINDOW)
    least = np.minimum.reduceat(holders[which], head)
    return which, offset, np.repeat(least, np.diff(np.append(head, len(which))))


def _bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column one after another, and where each row starts."""
    column = column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


SPAN_SCHEMA = "doc_id long, version long, a int, b int"


def _order_shard(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Spans of windows that a smaller id has, from the suffix order of a shard's strings."""
    table = table.sort_by("key")
    doc, first, key = (table.column(c).to_numpy() for c in ("doc_id", "first", "key"))
    text, bounds = _bytes_of(table.column("string"))
    # Strings of different keys share no window: small collections stay in the processor's cache.
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    block = bounds[head] // COLLECTION_BYTES
    cuts = head[1:][block[1:] != block[:-1]]
    parts = []
    for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
        low, high = bounds[at], bounds[to]
        which, offset, least = first_seen(text[low:high], bounds[at:to] - low, bounds[at + 1 : to + 1] - low, doc[at:to])
        parts.append((which + at, offset, least))
    which, offset, least = (np.concatenate(x) for x in zip(*parts))
    gone = least < doc[which]
    which, offset = which[gone], offset[gone]
    order = np.lexsort((offset, which))
    which, offset = which[order], offset[order]
    new = np.concatenate(([True], (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1))) if len(which) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(which)))
    string, start = which[head], first[which[head]] + offset[head]
    return pa.table({
        "doc_id": doc[string], "version": table.column("version").to_numpy()[string],
        "a": start.astype(np.int32), "b": (start + size + WINDOW - 1).astype(np.int32),
    })


def _written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read from there."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, version, ranges, spans`` of the documents that lose bytes: ranges of run numbers that go as a
    whole, and (a, b) byte spans, not yet joined up. ``docs`` has doc_id, version (a hash of the text) and text.
    """
    spark = bounded(docs).sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SHARD_BYTES))
    found = docs.mapInArrow(_deal_runs(shards), RUN_SCHEMA).groupBy("shard").applyInArrow(_equal_runs, FOUND_SCHEMA)
    per_doc = _written(
        found.groupBy("doc_id", "version").agg(F.collect_list(F.struct("open", "runs")).alias("found"))
        .mapInArrow(_per_document, "doc_id long, version long, ranges binary, open_runs binary"),
        "suffix-runs",
    )
    texts = docs.mapInArrow(_packed_texts, "doc_id long, version long, body binary")
    still_open = per_doc.where("open_runs IS NOT NULL").select("doc_id", "version", "open_runs")
    strings = _written(
        texts.join(still_open, ["doc_id", "version"]).mapInArrow(_strings(shards), STRING_SCHEMA), "suffix-strings"
    )
    hot = strings.groupBy("key").count().where(F.col("count") > HOT_STRINGS).select("key", F.lit(True).alias("hot"))
    marked = strings.join(broadcast_if_small(hot, 10_000), "key", "left")
    ordered = marked.where("hot IS NULL").drop("hot").groupBy("shard").applyInArrow(_order_shard, SPAN_SCHEMA)
    windows = marked.where("hot").withColumn("start", F.explode(F.expr(f"sequence(0, length(string) - {WINDOW})")))
    windows = windows.withColumn("window", F.expr(f"substring(string, start + 1, {WINDOW})"))
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    single = windows.join(least, "window").where("least < doc_id").select(
        "doc_id", "version", (F.col("first") + F.col("start")).alias("a"), (F.col("first") + F.col("start") + WINDOW).alias("b")
    )
    span = F.struct("a", "b")
    spans = ordered.union(single).select("doc_id", "version", F.lit(None).cast("binary").alias("ranges"), span.alias("span"))
    whole = per_doc.where("length(ranges) > 0").select("doc_id", "version", "ranges", F.lit(None).cast("struct<a:int,b:int>").alias("span"))
    return whole.union(spans).groupBy("doc_id", "version").agg(
        F.max("ranges").alias("ranges"), F.collect_set("span").alias("spans")
    )


def joined_up(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans as one, in order."""
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    head = np.concatenate(([True], a[1:] > reach[:-1]))
    at = np.flatnonzero(head)
    return a[at], reach[np.append(at[1:], len(a)) - 1]


def _whole_runs(raw: np.ndarray, offsets: np.ndarray, ranges: pa.Array) -> dict[int, np.ndarray]:
    """Begins and ends of the ranges of runs that go as a whole, for each text that has some."""
    out = {}
    size = pa.compute.binary_length(ranges).fill_null(0).to_numpy(zero_copy_only=False)
    some = np.flatnonzero(size)
    if len(some):
        row, _, first, windows = _runs_of(*_together([raw[offsets[i] : offsets[i + 1]] for i in some]))
        begin = np.searchsorted(row, np.arange(len(some)))
        for i, b in zip(some.tolist(), begin.tolist()):
            low, high = np.frombuffer(ranges[i].as_py(), np.uint32).reshape(-1, 2).T.astype(np.int64) + b
            out[i] = np.stack((first[low], first[high] + windows[high] + WINDOW - 1))
    return out


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = tokens.text_bytes(batch.column("text"))
        size, removed, count, digest, kept_text, spans_out = [], [], [], [], [], []
        whole = _whole_runs(raw, offsets, batch.column("ranges"))
        for i, spans in enumerate(batch.column("spans")):
            body = raw[offsets[i] : offsets[i + 1]]
            keep, merged = body, []
            found = []
            if spans.is_valid and len(spans):
                found.append(np.stack([spans.values.field(n).to_numpy().astype(np.int64) for n in ("a", "b")]))
            if i in whole:
                found.append(whole[i])
            if found:
                a, b = joined_up(*np.concatenate(found, axis=1))
                edge = np.zeros(len(body) + 1, dtype=np.int8)
                edge[a] += 1
                edge[b] -= 1
                keep = body[np.cumsum(edge[:-1]) == 0]
                merged = [{"a": int(x), "b": int(y)} for x, y in zip(a, b)]
            out = keep.tobytes()
            size.append(len(body))
            removed.append(len(body) - len(keep))
            count.append(len(merged))
            digest.append(hashlib.sha256(out).hexdigest())
            # A cut inside a character leaves bytes that are no text; they are left out of the text form.
            kept_text.append(out.decode("utf-8", "ignore") if batch.column("text")[i].is_valid else None)
            spans_out.append(merged)
        names = ["doc_id", "row"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names]
            + [pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest),
               pa.array(kept_text, pa.string()), pa.array(spans_out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
            names=names + ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed"],
        )


def suffix_dedup(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, row, n_bytes, n_removed, n_spans, kept_sha256, kept_text, removed`` for every row of ``docs``.

    A byte goes if a 50-byte string over it also starts in a document with a smaller id; all is judged on the
    texts as they came, and matches end with the document. NULL and empty texts, and those under 50 bytes, stay
    as they are. Rows with one id never remove each other's bytes. A row without an id counts as last: it can
    lose bytes but removes none of others. ``kept_text`` leaves out the rest of a character that was cut through.
    The columns named in ``carry`` come back in the struct ``row``; others are not read. No rows, no result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(None).cast("string").alias("nothing")])
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row.alias("row"))
    # Texts are told apart by their id; where several rows have one id, or none has, by a hash of the text as well.
    repeated = read.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    content = F.xxhash64("text")
    read = read.withColumn("version", F.when(F.col("doc_id").isNull(), content).otherwise(F.lit(0).cast("long")) if repeated.isEmpty() else content)
    spans = _written(repeated_spans(read.select("doc_id", "text", "version")), "suffix-spans")
    spans = broadcast_under(spans.withColumnRenamed("doc_id", "id_or_last"), F.coalesce(F.length("ranges"), F.lit(0)) + F.size("spans") * 24 + 64)
    with_spans = read.alias("r").join(
        spans.alias("s"), (F.coalesce("r.doc_id", F.lit(int(NO_ID))) == F.col("s.id_or_last")) & F.expr("r.version = s.version"), "left"
    ).select("r.*", "s.ranges", "s.spans")
    made = T.StructType.fromDDL(
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, removed array<struct<a:int,b:int>>"
    )
    schema = T.StructType([read.schema["doc_id"], read.schema["row"], *made.fields])
    return with_spans.select("doc_id", "text", "row", "ranges", "spans").mapInArrow(_apply, schema)


ORACLE = f"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
c AS (
  SELECT doc_id, n, 500 * k AS base, substr(h, 1000 * k + 1, {1000 + 2 * WINDOW}) AS h
  FROM (SELECT doc_id, n, h, unnest(generate_series(0, (n - {WINDOW}) // 500)) AS k FROM b WHERE n >= {WINDOW})),
w AS (
  SELECT doc_id, base + o AS pos, substr(h, 2 * o + 1, {2 * WINDOW}) AS s
  FROM (SELECT doc_id, base, h, unnest(generate_series(0, least(499, n - {WINDOW} - base))) AS o FROM c)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, pos, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS step FROM w JOIN f USING (s) WHERE first < doc_id),
i AS (SELECT doc_id, pos, count(*) FILTER (step IS NULL OR step > {WINDOW}) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM g),
p AS (SELECT doc_id, run, min(pos) AS a, max(pos) + {WINDOW} AS z FROM i GROUP BY 1, 2),
k AS (
  SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS kept
  FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p) JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM b LEFT JOIN k USING (doc_id)
"""
