"""Words and shingles of many texts at once: numpy over the bytes of an Arrow batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE_BYTES
# Letters, digits and everything outside ASCII.
ALNUM_BYTES = np.zeros(256, bool)
ALNUM_BYTES[0x30:0x3A] = ALNUM_BYTES[0x41:0x5B] = ALNUM_BYTES[0x61:0x7B] = ALNUM_BYTES[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

# Texts are taken in slices of about this many bytes, which bounds the arrays beside the batch.
SLICE_BYTES = 1 << 19

_STEP = np.uint64(0xD6E8FEB86659FD93)
# The low bytes of a lane that belong to a word, by their number.
_LANE_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
# Words of more bytes are hashed one by one.
LONG_WORD = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), bounds


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes, or of one row."""
    a, n = 0, len(bounds) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def word_bounds(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of member bytes within a row, and per row the first word's index.

    ``bounds`` starts at 0 and ends at len(data).
    """
    inside = member[data]
    before = np.empty_like(inside)
    before[1:], before[:1] = inside[:-1], False
    first = bounds[:-1][bounds[:-1] < len(data)]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1], after[-1:] = inside[1:], False
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: equal words, equal hashes, wherever they stand.

    Eight bytes at a time go through ``mix`` together with the hash so far, which starts with the length.
    """
    lanes, left = _lanes(data), (ends - starts).astype(np.int64)
    found = mix(left.astype(np.uint64) * _STEP)
    rest = np.flatnonzero(left <= LONG_WORD)
    at, left = starts[rest], left[rest]
    while len(rest):
        lane = lanes[at] & _LANE_MASKS[np.minimum(left, 8)]
        found[rest] = mix((found[rest] ^ lane) * _STEP + np.uint64(0x9E3779B97F4A7C15))
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        found[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return found


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray) -> bool:
    """Whether every word has the bytes of the word that begins at ``others``; lengths are known to be equal."""
    lanes, left, at, other = _lanes(data), (ends - starts).astype(np.int64), starts, others
    while len(left):
        if ((lanes[at] ^ lanes[other]) & _LANE_MASKS[np.minimum(left, 8)]).any():
            return False
        more = left > 8
        at, other, left = at[more] + 8, other[more] + 8, left[more] - 8
    return True


def chunks(data: np.ndarray, member: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``limit`` bytes, cut where no word is: bounds the arrays of a single row."""
    at = 0
    while len(data) - at > limit:
        cut = at + limit
        while cut < len(data):  # on to the next byte outside words
            gap = np.flatnonzero(~member[data[cut : cut + 4096]])
            if len(gap):
                cut += int(gap[0])
                break
            cut += 4096
        cut = min(cut, len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def hashed_words(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice of rows, and per row the first word's index."""
    if len(bounds) == 2 and len(data) > 2 * SLICE_BYTES:
        found = []
        for part in chunks(data, member):
            starts, ends, _ = word_bounds(part, np.array([0, len(part)]), member)
            found.append(word_hashes(part, starts, ends))
        return np.concatenate(found), np.array([0, sum(map(len, found))])
    starts, ends, firsts = word_bounds(data, bounds, member)
    return word_hashes(data, starts, ends), firsts


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct 64-bit hashes of its word shingles, A-Z lower-cased.

    A row with fewer words than ``width`` has one shingle, its whole sequence; without words, none.
    """
    words, firsts = hashed_words(LOWER[data], bounds, NOT_SPACE)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for j in range(width):
        rolled = rolled * _STEP + words[j : j + len(rolled)]
    rolled = mix(rolled)
    found = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= width:
            run = np.sort(rolled[a : b - width + 1])
            found.append(run[np.flatnonzero(np.diff(run, prepend=~run[:1]))])
        elif b > a:
            whole = np.uint64(b - a)
            for word in words[a:b]:
                whole = whole * _STEP + word
            found.append(mix(np.array([whole ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def sets_of_batch(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The shingle set of each row of a text column, slice by slice."""
    data, bounds = text_bytes(column)
    with np.errstate(over="ignore"):
        for a, b in slices(bounds):
            yield from shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], width)
