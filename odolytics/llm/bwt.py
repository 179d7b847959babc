"""Burrows-Wheeler transform and common prefixes of a collection of strings, built some columns at a time.

All strings are aligned at their ends. As many symbols as fit into one word are a column. The pile starts with
the suffixes shorter than a column; a round puts a column before every suffix that has one in its string. The
place of ``column + suffix`` follows from the column and the place of ``suffix``, so a round sorts the pile by
the columns before it (its transform) and leaves the order among equal ones. Rounds are as many as columns in
the longest string.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_LOW = _U(0xFFFFFFFF)


def _columns(symbols: np.ndarray, width: int, bits: int) -> np.ndarray:
    """The ``width`` symbols from each place on, as one number that sorts as they do."""
    n = len(symbols) - width + 1
    out = symbols[:n].astype(_U)
    for k in range(1, width):
        out <<= _U(bits)
        out |= symbols[k : n + k]
    return out


def _alike(word: np.ndarray, left: np.ndarray, order: np.ndarray, width: int, bits: int, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before, column by column up to the first that differs."""
    least = np.minimum(np.minimum(left[order[1:]], left[order[:-1]]), most)
    common = np.concatenate((np.zeros(1, least.dtype), least))
    a, b = order[:-1], order[1:]
    which, done = np.arange(len(least)), 0
    while len(which):
        other = word[a + done] ^ word[b + done]
        differs = np.flatnonzero(other)
        other = other[differs]
        # The highest bit that differs; without the bit below it the conversion cannot round up.
        top = np.frexp((other & ~(other >> _U(1))).astype(np.float64))[1]
        at = which[differs]
        common[at + 1] = np.minimum(least[at], done + width - -(-top // bits))
        done += width
        go_on = least[which] > done
        go_on[differs] = False
        which, a, b = which[go_on], a[go_on], b[go_on]
    return common[: len(order)].astype(np.uint8)


def collection_bwt(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int, shortest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted suffixes of all strings ``text[s:e]``: string, offset in it, and common prefix with the one before.

    Ends of strings sort before every byte and among each other by string number, so no common prefix runs
    over an end. Common prefixes are counted up to ``most`` (at most 255). Suffixes of less than ``shortest``
    bytes are sorted with the others but left out at last, as the ``$`` suffixes are.
    """
    n = len(starts)
    lengths = (ends - starts).astype(np.int64)
    if n == 0 or not lengths.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    # Symbols are the ranks of the bytes that occur, from one; zero is the end of a string.
    used = np.flatnonzero(np.bincount(text, minlength=256))
    rank = np.zeros(256, dtype=np.uint8 if len(used) < 256 else np.uint16)
    rank[used] = np.arange(1, len(used) + 1)
    bits = len(used).bit_length()
    width = 63 // bits
    # Every string with ends behind it to fill a column.
    room = lengths + width
    begin = np.cumsum(room) - room
    string = np.repeat(np.arange(n, dtype=np.int32), room)
    offset = (np.arange(len(string)) - np.repeat(begin, room)).astype(np.int32)
    left = lengths.astype(np.int32)[string] - offset
    symbols = np.zeros(len(string) + width - 1, dtype=rank.dtype)
    inside = np.flatnonzero(left > 0)
    symbols[inside] = rank[text[starts[string[inside]] + offset[inside]]]
    word = _columns(symbols, width, bits)
    column = np.unique(word, return_inverse=True)[1].astype(_U) << _U(32)

    def in_order(suffixes: np.ndarray) -> np.ndarray:
        """Suffixes by their first column; equal ones as they stand."""
        by = column[suffixes]
        by |= np.arange(len(suffixes), dtype=_U)
        by.sort()
        by &= _LOW
        return suffixes[by.view(np.int64)]

    # Suffixes shorter than a column stand apart from all others, and equal ones of them by string number.
    short = in_order(np.flatnonzero((left >= 0) & (left < width)))
    order = short
    for _ in range(int(lengths.max()) // width):
        order = in_order(np.concatenate((short, order[offset[order] >= width] - width)))
    order = order[left[order] >= max(shortest, 1)]
    return string[order].astype(np.int64), offset[order].astype(np.int64), _alike(word, left, order, width, bits, most)
