"""Words and shingles of whole texts as 64-bit hashes, worked out on the bytes of an Arrow batch.

Words are the runs of bytes between ASCII white space, after lowering A-Z. UTF-8 never uses those bytes
inside a character, so bytes and characters give the same words. A text is read in pieces of about a
megabyte cut at white space, so memory follows the number of words, not the length of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

PIECE_BYTES = 1 << 20
SHINGLE = 5

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=_U) * _BASE)
_FACTOR = mix(np.arange(1, SHINGLE + 1, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when a longer piece comes."""

    def __init__(self) -> None:
        self.n, self.up, self.down = 0, None, None

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, PIECE_BYTES + (PIECE_BYTES >> 2))
            self.up = _powers(int(_BASE), self.n)
            self.down = _powers(pow(int(_BASE), -1, 1 << 64), self.n)
        return self.up, self.down


_POWERS = _Powers()


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums; a stretch [s, e) has (P[e] - P[s]) * base**-s as its hash."""
    up, _ = _POWERS.of(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(_VALUE[values] * up[: len(values)], out=out[1:])
    return out


def stretch_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _POWERS.of(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(_U))


def gram_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """``stretch_hashes`` of all stretches of one width, without gathering."""
    n = len(prefix) - width
    _, down = _POWERS.of(len(prefix))
    out = prefix[width:] - prefix[:n]
    out *= down[:n]
    out += _U(width)
    return mix(out)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after another, and where each row starts; NULL counts as empty."""
    pa.default_memory_pool().release_unused()       # what earlier batches left behind
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, column: str, most_bytes: int = 2 * PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts add up to a few megabytes; a longer text is a slice of its own."""
    sizes = pa.compute.binary_length(batch.column(column).fill_null("")).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = int(upto[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(upto, before + most_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


def _pieces(raw: np.ndarray, offsets: np.ndarray, gap_bytes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about a piece each, cut at row starts or between words."""
    at, end = 0, int(offsets[-1])
    while at < end:
        to = min(end, at + PIECE_BYTES)
        if to < end:
            row = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if row > at:
                to = row
            else:
                while to < end and not gap_bytes[raw[to]]:
                    gap = np.flatnonzero(gap_bytes[raw[to : to + 4096]])
                    to = to + int(gap[0]) if len(gap) else min(end, to + 4096)
                after = int(offsets[np.searchsorted(offsets, at, "right")])
                to = min(to, after)
        yield at, to
        at = to


def words(raw: np.ndarray, offsets: np.ndarray, gap_bytes: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, row after row, and the first word of each row (one entry more than rows).

    ``gap_bytes`` says for each of the 256 bytes whether it stands between words.
    """
    hashes, starts, _ = words_at(raw, offsets, gap_bytes)
    return hashes, np.searchsorted(starts, offsets)


def words_at(raw: np.ndarray, offsets: np.ndarray, gap_bytes: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, row after row, and the bytes at which each begins and ends."""
    hashes, starts_all, ends_all = [], [], []
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    for at, to in _pieces(raw, offsets, gap_bytes):
        part = raw[at:to]
        inside = ~gap_bytes[part]
        head = first[at:to]
        before = np.concatenate(([False], inside[:-1]))
        starts = np.flatnonzero(inside & (~before | head))
        ends = np.flatnonzero(np.concatenate((before & (~inside | head), inside[-1:])))
        hashes.append(stretch_hashes(prefix_hashes(_LOWER[part]), starts, ends))
        starts_all.append(starts + at)
        ends_all.append(ends + at)
    if not hashes:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts_all), np.concatenate(ends_all)


def sequence_digests(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each stretch [start, end) of a sequence of word hashes."""
    up, down = _POWERS.of(len(hashes) + 1)
    out = []
    for salt in (_U(0x8CB92BA72F3D8DD7), _U(0xABD6F1E3C95A4E17)):
        prefix = np.zeros(len(hashes) + 1, dtype=_U)
        np.cumsum(mix(hashes ^ salt) * up[: len(hashes)], out=prefix[1:])
        out.append(mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(_U)))
    return out[0], out[1]


def shingle_hashes(words_of_row: np.ndarray) -> np.ndarray:
    """Hash of each run of five words; of the whole sequence if there are one to four words."""
    n = len(words_of_row)
    width = min(n, SHINGLE)
    if not width:
        return words_of_row
    out = np.full(n - width + 1, _U(width), dtype=_U)
    for k in range(width):
        out += words_of_row[k : n - width + 1 + k] * _FACTOR[k]
    return mix(out)


def shingle_set(words_of_row: np.ndarray) -> np.ndarray:
    return np.unique(shingle_hashes(words_of_row))


def word_hash(word: str) -> int:
    """The hash that ``words`` gives to this word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(words(raw, np.array([0, len(raw)]), np.zeros(256, dtype=bool))[0][0])


def word_rows(column: pa.Array, gap_bytes: np.ndarray = SPACE) -> Iterator[np.ndarray]:
    """The word hashes of each row of a string column, worked out for a few megabytes of rows at a time."""
    raw, offsets = text_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 4 * PIECE_BYTES, "right")) - 1)
        hashes, first = words(raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], gap_bytes)
        for a, b in zip(first[:-1], first[1:]):
            yield hashes[a:b]
        at = to
