"""Token ids of whole texts by a public tokenizer, for use inside Spark tasks.

A byte-level vocabulary whose splitting pattern keeps a blank with the word after it never looks
across a blank that follows a non-blank character. Texts are cut there; the library encodes each
distinct piece once and its ids are remembered, which gives the ids of the whole text exactly.
Where the vocabulary splits words as byte-level ones do, texts are also cut between a Latin letter and a mark after it and
on both sides of a single line feed, and a piece of Latin letters is one word for certain, so it goes to the
library's model at once and not through its splitting.

Pieces are cut, told apart by 64-bit hashes of their bytes and put together for a whole batch of texts at once, with
numpy. That two different pieces a worker remembers have one hash is left to chance (about 10**-8).
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from riskloom.llm import words as W

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
REMEMBERED = 1_500_000  # pieces a worker keeps between batches
REMEMBERED_IDS = 10_000_000  # and their ids
WINDOW = 1 << 20  # bytes hashed at once, but for a longer piece
BLANK = 0x20
#: ASCII white space, after which a blank does not begin a piece: then it can belong to what stands before it.
WHITE = np.zeros(256, bool)
WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: Last bytes of other white space.
WIDE = np.zeros(256, bool)
WIDE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
MARK = np.zeros(256, bool)
MARK[[*b".,;:!?"]] = True
#: Latin letters with the blank before them, or marks, are words of their own.
PLAIN = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[.,;:!?]+")
#: How byte-level vocabularies write a byte: printable ones as themselves, the others as characters from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
WRITTEN = {b: chr(b) for b in PRINTABLE}
WRITTEN |= {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Where the installed vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to unsigned 32-bit ids, without special tokens added."""

    _ready: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._model = self._library.model if _splits_by_bytes(self._library) else None
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder; later tasks of the same worker find its pieces known."""
        if path not in cls._ready:
            cls._ready[path] = cls(path)
        return cls._ready[path]

    def _forget(self) -> None:
        self._seen = _Numbers()
        self._ids = np.zeros(1, np.uint32)  # of all remembered pieces; first the id 0 by itself
        self._at = np.array([0, 1])  # where each piece's begin, and the end

    def ids(self, column: pa.Array | pa.ChunkedArray, end: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order and the borders of each text's; null counts as empty.

        With `end` each text has id 0 after its own.
        """
        if len(self._at) > REMEMBERED or len(self._ids) > REMEMBERED_IDS:
            self._forget()
        data, bounds = W.utf8(column)
        starts = cuts(data, bounds, self._model is not None)
        number = self._numbers(data, starts) + 1
        pieces = np.searchsorted(starts, bounds)
        if end:
            with_end = np.zeros(len(number) + len(bounds) - 1, np.int64)
            text = np.repeat(np.arange(len(bounds) - 1), np.diff(pieces))
            with_end[np.arange(len(number)) + text] = number
            number, pieces = with_end, pieces + np.arange(len(bounds))
        lengths = self._at[number + 1] - self._at[number]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(upto[-1]) + np.repeat(self._at[number] - upto[:-1], lengths)
        return self._ids[place], upto[pieces]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian bytes."""
        ids, borders = self.ids(pa.array(texts, pa.string()))
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(borders[:-1], borders[1:], strict=True)]

    def _numbers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of each piece, in the order in which they were first seen; new ones are encoded."""
        ends = np.append(starts[1:], len(data)).astype(np.int64)
        hashes = _hashes(data, starts, ends)
        found = self._seen.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            first = missing[first]
            texts = [data[a:b].tobytes().decode() for a, b in zip(starts[first], ends[first], strict=True)]
            ids = self._encoded(texts)
            found[missing] = self._seen.add(new) + which
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for some in ids for i in some), np.uint32, int(lengths.sum()))
            self._ids = np.concatenate([self._ids, flat])
            self._at = np.concatenate([self._at, self._at[-1] + np.cumsum(lengths)])
        return found

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(texts)
        mixed = []
        for k, text in enumerate(texts):
            if self._model and PLAIN.fullmatch(text):
                out[k] = [t.id for t in self._model.tokenize(text.encode().decode("latin-1").translate(WRITTEN))]
            else:
                mixed.append(k)
        found = self._library.encode_batch_fast([texts[k] for k in mixed], add_special_tokens=False)
        for k, ids in zip(mixed, found, strict=True):
            out[k] = ids.ids
        return out


class _Numbers:
    """Hashes numbered in the order they are added: a table with open addressing, for whole arrays at once."""

    def __init__(self, slots: int = 1 << 16):
        self._known = np.zeros(0, np.uint64)
        self._open(slots)

    def _open(self, slots: int) -> None:
        self._keys, self._values = np.zeros(slots, np.uint64), np.full(slots, -1, np.int32)
        self._shift = np.uint64(64 - slots.bit_length() + 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Their numbers, -1 where unknown."""
        out = np.full(len(hashes), -1)
        left, slot = np.arange(len(hashes)), (hashes >> self._shift).astype(np.int64)
        while len(left):
            value = self._values[slot]
            same = (self._keys[slot] == hashes[left]) & (value >= 0)
            out[left[same]] = value[same]
            more = ~same & (value >= 0)
            left, slot = left[more], (slot[more] + 1) % len(self._keys)
        return out

    def add(self, new: np.ndarray) -> int:
        """Number distinct unknown hashes and return the first number."""
        first = len(self._known)
        self._known = np.concatenate([self._known, new])
        if 2 * len(self._known) > len(self._keys):
            self._open(1 << (3 * len(self._known)).bit_length())
            self._put(self._known, 0)
        else:
            self._put(new, first)
        return first

    def _put(self, hashes: np.ndarray, first: int) -> None:
        left, slot = np.arange(len(hashes)), (hashes >> self._shift).astype(np.int64)
        while len(left):
            free = self._values[slot] < 0
            self._values[slot[free]] = first + left[free]  # of several for one slot the last is in
            placed = self._values[slot] == first + left
            self._keys[slot[placed]] = hashes[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) % len(self._keys)


def cuts(data: np.ndarray, bounds: np.ndarray, fine: bool) -> np.ndarray:
    """Where pieces begin: at the texts' first bytes and at blanks that follow anything but white space.

    With `fine`, also at marks that follow a Latin letter, and at and after line feeds between other than white space.
    """
    blank = np.flatnonzero(data[1:] == BLANK) + 1
    last = data[blank - 1]
    solid = ~WHITE[last]
    wide = np.flatnonzero(WIDE[last])
    third, second, last = data[blank[wide] - 3], data[blank[wide] - 2], last[wide]
    white = (second == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (third == 0xE1) & (second == 0x9A) & (last == 0x80)
    white |= (third == 0xE2) & (second == 0x80) & ((last <= 0x8A) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    white |= (third == 0xE2) & (second == 0x81) & (last == 0x9F) | (third == 0xE3) & (second == 0x80) & (last == 0x80)
    solid[wide[white]] = False
    begins = np.zeros(len(data) + 1, bool)
    begins[blank[solid]] = True
    if fine and len(data) > 2:
        mark = np.flatnonzero(MARK[data[1:]]) + 1
        last, second = data[mark - 1], data[mark - 2]
        # Two-byte characters from U+00C0 on, but for the signs of multiplication and division.
        wide = (second == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7) & (mark > 1)
        begins[mark[LETTER[last] | wide]] = True
        # Only ASCII neighbours, which tell at once that they are no white space.
        line = np.flatnonzero(data[1:-1] == 0x0A) + 1
        solid = (data[line - 1] < 0x80) & (data[line + 1] < 0x80) & ~WHITE[data[line - 1]] & ~WHITE[data[line + 1]]
        begins[line[solid]] = True
        begins[line[solid] + 1] = True
    begins[bounds] = True
    return np.flatnonzero(begins[:-1])


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the pieces' bytes, from running sums over a window."""
    out = [np.zeros(0, np.uint64)]
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + WINDOW, "right")))
        begin, end = starts[low], ends[high - 1]
        out.append(W.span_hashes(data[begin:end], starts[low:high] - begin, ends[low:high] - begin, W.CODES))
        low = high
    return np.concatenate(out)


def _splits_by_bytes(library) -> bool:
    """Whether the library does nothing to text but split it byte-level, and no added token is cut or plain."""
    from tokenizers.pre_tokenizers import ByteLevel

    pre = library.pre_tokenizer
    split = isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space
    added = [t.content for t in library.get_added_tokens_decoder().values()]
    whole = all(len(cuts(*W.utf8(pa.array([t])), True)) < 2 and not PLAIN.fullmatch(t) for t in added)
    return split and library.normalizer is None and whole
