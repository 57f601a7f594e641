"""Words of whole texts as arrays of 64-bit hashes.

A word is a maximal run of bytes that are not white space (0x20, 0x09-0x0D), read with A-Z lower-cased.
Texts are hashed piece by piece with array operations, so a long text costs memory in proportion to its
own length and nothing is looked up word by word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Finalise hashes so that every bit depends on every bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def seeds(count: int, seed: int) -> np.ndarray:
    """`count` fixed 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed))


_BYTE_VALUE = seeds(256, 11)
_BYTE_VALUE[ord("A") : ord("Z") + 1] = _BYTE_VALUE[ord("a") : ord("z") + 1]
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < length:
        size = max(length, PIECE_BYTES + 1)
        powers, inverses = (np.full(size, base, dtype=np.uint64) for base in (_BASE, _BASE_INVERSE))
        powers[0], inverses[0] = 1, 1
        powers, inverses = np.cumprod(powers), np.cumprod(inverses)
        if size > 16 * PIECE_BYTES:  # for one very long text; not kept
            return powers, inverses
        _powers, _inverses = powers, inverses
    return _powers, _inverses


def hash_words(
    data: np.ndarray, bounds: np.ndarray, outside: np.ndarray = _WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts data[bounds[i]:bounds[i+1]]: hashes, first bytes, ends, and each text's bounds in them.

    `outside` marks the bytes that are not part of words.
    """
    size = len(data)
    if size == 0:
        empty = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), empty, empty, np.zeros(len(bounds), dtype=np.int64)
    word = ~outside[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    filled = bounds[:-1] < bounds[1:]
    heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
    first[heads] = word[heads]
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hasher(data)(starts, ends), starts, ends, np.searchsorted(starts, bounds)


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hashes of data[starts[i]:ends[i]] with A-Z lower-cased, as differences of one running polynomial."""
    powers, inverses = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers[: len(data)], out=sums[1:])

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * _GOLDEN)

    return hashes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and each text's bounds in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_pieces(column: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about `piece_bytes` (a longer text alone): first row, word hashes, each text's bounds in them."""
    data, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + piece_bytes, side="right")) - 1)
        part = bounds[row : end + 1]
        hashes, _, _, words = hash_words(data[part[0] : part[-1]], part - part[0])
        yield row, hashes, words
        row = end


def all_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of every text of a column, one after the other, and each text's bounds in them."""
    hashes, bounds, total = [np.zeros(0, dtype=np.uint64)], [np.zeros(1, dtype=np.int64)], 0
    for _, part, words in word_pieces(column):
        hashes.append(part)
        bounds.append(words[1:] + total)
        total += len(part)
    return np.concatenate(hashes), np.concatenate(bounds)


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return values.view(np.int64)
