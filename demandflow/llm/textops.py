"""Words and word windows of Arrow text columns, hashed with numpy inside tasks.

A word is a maximal run of bytes of an alphabet in the UTF-8 text. Both
alphabets used here are closed under UTF-8: white space and ASCII punctuation
are single bytes, every byte of a non-ASCII character is a word byte. Word and
window hashes are 64-bit polynomial (Rabin-Karp) hashes: prefix sums make the
hash of any run one subtraction and one multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93 | 1)


def _alphabet(separators: bytes) -> np.ndarray:
    is_word = np.ones(256, dtype=bool)
    is_word[list(separators)] = False
    return is_word


#: ``[^\x20\x09-\x0D]+``
SPACED = _alphabet(bytes([0x20, *range(0x09, 0x0E)]))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, for lower-cased text
ALNUM = _alphabet(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer (splitmix64's finaliser) over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """base^i and base^-i modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            steps = np.full(size, self.base, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = self.inverse
            self.down = np.cumprod(steps)
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its rows (null: empty)."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = texts.buffers()[2] if n else None
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words(texts: pa.Array, is_word: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its byte start, its byte end, index of each row's first word with the total appended).

    Works through the bytes in segments that end between words, so memory
    beyond the text is bounded by a segment (or one longer word) plus 24 bytes a word.
    """
    raw, offsets = text_buffer(texts)
    is_word = is_word[_LOWER] if lower else is_word
    hashes, starts, ends = [], [], []
    at, total = 0, len(raw)
    row_starts = np.unique(offsets)
    while at < total:
        stop = min(at + SEGMENT, total)
        if stop < total:
            stop = _cut(raw, row_starts, at, stop, is_word)
        inside = is_word[raw[at:stop]]
        b = _LOWER[raw[at:stop]] if lower else raw[at:stop]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        own = row_starts[np.searchsorted(row_starts, at):np.searchsorted(row_starts, stop)] - at
        begins[own] = inside[own]
        finishes = inside.copy()
        finishes[:-1] &= ~inside[1:] | begins[1:]
        s, e = np.flatnonzero(begins), np.flatnonzero(finishes)
        up, down = _BYTE_POWERS.get(len(b))
        prefix = np.cumsum(_BYTE_VALUE[b] * up)
        before = prefix[s] - _BYTE_VALUE[b[s]] * up[s]
        value = (prefix[e] - before) * down[s]
        hashes.append(mix(value + (e - s + 1).astype(np.uint64)))
        starts.append(s + at)
        ends.append(e + at + 1)
        at = stop
    none = np.zeros(0, np.int64)
    s = np.concatenate(starts) if starts else none
    return (np.concatenate(hashes) if hashes else none.astype(np.uint64), s,
            np.concatenate(ends) if ends else none, np.searchsorted(s, offsets))


def _cut(raw: np.ndarray, row_starts: np.ndarray, at: int, stop: int, is_word: np.ndarray) -> int:
    """A place near ``stop`` that splits no word: a row start, else after a separator, else the next such place."""
    row = int(row_starts[np.searchsorted(row_starts, stop, "right") - 1])
    if row > at:
        return row
    for lo in (max(at, stop - 4096), at):
        found = np.flatnonzero(~is_word[raw[lo:stop]])
        if len(found):
            return lo + int(found[-1]) + 1
    end = int(row_starts[np.searchsorted(row_starts, stop, "right")]) if row_starts[-1] > stop else len(raw)
    for lo in range(stop, end, SEGMENT):
        found = np.flatnonzero(~is_word[raw[lo:min(lo + SEGMENT, end)]])
        if len(found):
            return lo + int(found[0]) + 1
    return end


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``size`` words, by first word; runs over row ends included."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORD_POWERS.get(len(hashes))
    prefix = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, out=prefix[1:])
    return (prefix[size:] - prefix[:n]) * down[:n]


def starts_inside(first: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie in one row, given the rows' first words (total appended)."""
    total = int(first[-1])
    ok = np.ones(max(total - size + 1, 0), dtype=bool)
    for back in range(1, size):
        late = first[1:] - back
        ok[late[(late >= 0) & (late < len(ok))]] = False
    if size > 1 and len(ok):
        counts = np.diff(first)
        short = np.flatnonzero((counts > 0) & (counts < size))
        for r in short:
            ok[first[r]:min(first[r + 1], len(ok))] = False
    return ok


def row_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.Table]:
    """Consecutive rows regrouped so that each group's text reaches ``max_bytes`` (the last may not).

    The grouping depends on the order of rows alone, not on Arrow's batches.
    """
    held, size = [], 0
    for batch in batches:
        _, offsets = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[at] + max_bytes - size, "left"))
            if stop > batch.num_rows:
                held.append(batch.slice(at))
                size += int(offsets[-1] - offsets[at])
                break
            stop = max(stop, at + 1)
            yield pa.Table.from_batches([*held, batch.slice(at, stop - at)]).combine_chunks()
            held, size, at = [], 0, stop
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def column(table: pa.Table, name: str) -> pa.Array:
    """One contiguous array."""
    chunks = table.column(name)
    return chunks.chunk(0) if chunks.num_chunks == 1 else (pa.concat_arrays(chunks.chunks) if chunks.num_chunks else pa.array([], chunks.type))
