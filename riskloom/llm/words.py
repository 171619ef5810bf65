"""Words of many UTF-8 texts at once, as 64-bit hashes, with numpy.

A word is a longest run of bytes other than space and the control characters 9 to 13. A hash is a
polynomial over random byte codes, taken from running sums so that no loop over words is needed,
and then mixed. Equal words have equal hashes in every process; for unequal ones to meet among a
billion words has a chance of a few in a hundred, and among the words of one text none to speak of.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudorandom 64-bit values that do not depend on library versions."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
CODES = stream(1, 256)
BASE = 0x9E3779B97F4A7C15 | 5
ROOM: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""
    if len(ROOM.get("up", ())) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            ROOM[name] = np.cumprod(steps)
    return ROOM["up"][:n], ROOM["down"][:n]


def span_hashes(raw: np.ndarray, first: np.ndarray, last: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of raw[first:last], which have the same value wherever they stand."""
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(codes[raw] * up[:-1], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 borders of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, borders, data = column.buffers()
    bounds = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text[bounds[0] : bounds[-1]], bounds - bounds[0]


def parts(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most `size` bytes of text after the first, since the work on a slice takes many times its size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        place = np.maximum(np.cumsum(sizes, dtype=np.int64) // size, np.arange(len(sizes)) // 1000)
        borders = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
        for low, high in itertools.pairwise(borders):
            yield batch.slice(low, high - low)


@dataclass
class Words:
    start: np.ndarray  # byte positions
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray  # row of the word's text

    def borders(self, docs: int) -> np.ndarray:
        """Positions in these arrays at which each text's words begin, and the end."""
        return np.searchsorted(self.doc, np.arange(docs + 1))


def words(data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = SPACE) -> Words:
    """All words, in order, A-Z as a-z. Memory beyond the result is that of a window or the longest word.

    `blank` tells for each byte whether it stands between words.
    """
    codes = CODES[LOWER]
    heads = np.zeros(len(data) + 1, dtype=bool)
    heads[bounds] = True
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(data):
        to = min(at + WINDOW, len(data))
        while to < len(data) and not (blank[data[to]] or heads[to]):
            stop = min(to + 4096, len(data))
            free = np.flatnonzero(blank[data[to:stop]] | heads[to:stop])
            to = to + int(free[0]) if len(free) else stop
        raw = data[at:to]
        space, head = blank[raw], heads[at : to + 1].copy()
        head[0] = True
        solid = np.concatenate([[False], ~space, [False]])
        first = np.flatnonzero(solid[1:-1] & (head[:-1] | ~solid[:-2]))
        head[-1] = True
        last = np.flatnonzero(solid[1:-1] & (head[1:] | ~solid[2:])) + 1
        hashes.append(span_hashes(raw, first, last, codes))
        starts.append(first + at)
        ends.append(last + at)
        at = to
    empty = np.zeros(0, np.int64)
    start = np.concatenate([empty, *starts])
    doc = np.searchsorted(bounds, start, side="right") - 1
    return Words(start, np.concatenate([empty, *ends]), np.concatenate([empty.astype(np.uint64), *hashes]), doc)


def runs(found: Words, docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` neighbouring words and the borders of each text's; repeats stay.

    A text with fewer words has its whole sequence as its one run, a text without words has none.
    """
    borders = found.borders(docs)
    counts = np.diff(borders)
    weights = stream(size, size)
    n = len(found.hash)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):  # a word beyond the text's end is left out
        other = np.zeros(n, dtype=np.uint64)
        inside = np.arange(n - k)
        inside = inside[found.doc[k:] == found.doc[: n - k]] if k else inside
        other[inside] = mix(found.hash[inside + k] + weights[k])
        total += other * np.uint64(2 * k + 1)
    full = np.minimum(counts, np.maximum(counts - size + 1, 1))  # runs of each text
    keep = np.arange(n) - borders[found.doc] < full[found.doc] if n else np.zeros(0, bool)
    short = counts[found.doc] < size if n else np.zeros(0, bool)
    total = mix(total + np.where(short, counts[found.doc] if n else 0, size).astype(np.uint64))
    return total[keep], np.concatenate([[0], np.cumsum(full)])


def sequence_ids(found: Words, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit values of each text's whole word sequence."""
    borders = found.borders(docs)
    place = np.arange(len(found.hash)) - borders[found.doc] if len(found.hash) else np.zeros(0, np.int64)
    out = []
    for seed in (3, 4):
        value = mix(found.hash + mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(seed << 40)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        out.append(mix(sums[borders[1:]] - sums[borders[:-1]] + np.diff(borders).astype(np.uint64)))
    return out[0], out[1]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values
