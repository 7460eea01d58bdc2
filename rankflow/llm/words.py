"""Words and word shingles of whole Arrow batches, hashed with numpy.

Words are the maximal runs of characters other than ASCII white space in the lower-cased text. For shingles, each character
of a script written without blanks (Chinese, Japanese, Thai, Lao, Khmer, Burmese) is a word, and so is each character of a run
of over ``LONG_WORD`` bytes: such texts have as many shingles as characters, not one. A
shingle is ``width`` words in a row; a text with fewer words has one shingle of all its words, a
text without words has none. Hashes are 63 bits, so that they order alike as ``bigint``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
#: Bytes of texts that are cut into words together, and bytes of words that are hashed together.
BLOCK_BYTES, HASH_BYTES = 1 << 21, 1 << 18
LONG_WORD = 1000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _POWERS = np.cumprod(up), np.cumprod(down)
    return _POWERS


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text starts (one more entry for the end)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words before each text."""
    inside = ~_SPACE[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts], after[cuts - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _unspaced(data: np.ndarray) -> np.ndarray:
    """Whether a character of a script without blanks begins at each byte."""
    after = np.zeros_like(data)
    after[:-1] = data[1:]

    def within(low: int, high: int) -> np.ndarray:
        return (after >= low) & (after <= high)

    found = (data >= 0xE3) & (data <= 0xE9)  # U+3000 to U+9FFF
    found |= (data == 0xE0) & within(0xB8, 0xBB)  # Thai, Lao
    found |= (data == 0xE1) & (within(0x80, 0x82) | within(0x9E, 0x9F))  # Burmese, Khmer
    found |= (data == 0xEF) & within(0xA4, 0xAB)  # compatibility ideographs
    return found | ((data == 0xF0) & within(0xA0, 0xBF))  # further ideographs


def split_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words cut into characters where the script has no blanks, and where they are very long."""
    long = ends - starts > LONG_WORD
    if not len(starts) or (not long.any() and data.max() < 0xE0):
        return starts, ends
    begins = np.append(data & 0xC0 != 0x80, True)
    first = _unspaced(data)
    alone = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(alone, starts[long], 1)
    np.add.at(alone, ends[long], -1)
    first |= begins[:-1] & (np.cumsum(alone[:-1]) > 0)
    places = np.flatnonzero(first)
    if not len(places):
        return starts, ends
    characters = np.flatnonzero(begins)
    following = characters[np.searchsorted(characters, places, side="right")]
    word = np.searchsorted(starts, places, side="right") - 1
    cuts = np.unique(np.concatenate([starts, places, following[following < ends[word]]]))
    own = np.searchsorted(starts, cuts, side="right") - 1
    return cuts, np.minimum(np.append(cuts[1:], len(data)), ends[own])


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span of bytes, block by block; spans don't overlap."""
    out, first = np.zeros(len(starts), dtype=np.uint64), 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + HASH_BYTES, side="right")))
        block = data[base : ends[last - 1]].astype(np.uint64) + np.uint64(1)
        up, down = _powers(len(block))
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(block * up[: len(block)], out=sums[1:])
        begin, end = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[end] - sums[begin]) * down[begin]
        first = last
    return mix(out)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of shingles (as written, not lower-cased), and the number of words before each text."""
    data, offsets = text_bytes(texts)
    starts, ends, _ = word_spans(data, offsets)
    starts, ends = split_spans(data, starts, ends)
    return hash_spans(data, starts, ends), np.searchsorted(starts, offsets)


def hashed_shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles with repeats, and the number of shingles before each text."""
    words, bounds = hashed_words(pc.utf8_lower(pc.fill_null(texts, "")))
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    starts = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(made, out=starts[1:])
    total = int(starts[-1])
    first = np.arange(total) - np.repeat(starts[:-1], made) + np.repeat(bounds[:-1], made)
    stop = np.repeat(bounds[1:], made)
    padded = np.concatenate([words, np.zeros(width, dtype=np.uint64)])
    out = np.zeros(total, dtype=np.uint64)
    for k in range(width):
        there = first + k
        out = out * _BASE + np.where(there < stop, padded[there], np.uint64(k + 1))
    return mix(out) >> np.uint64(1), starts


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``size`` bytes, at least one text each."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield texts.slice(first, last - first)
        first = last


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for block in blocks(texts):
        hashes, starts = hashed_shingles(block, width)
        for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield np.unique(hashes[begin:end])
