"""Simple-8b: as many equally wide numbers as fit share a 64-bit word, with the choice in its four top bits.

Numbers are cut into blocks that each begin a new word, so any block can be read alone. Coding walks along all
blocks at once, and decoding takes all words of a selector at once. A number too wide for 60 bits is an escape: its
word holds the place of the number in a list beside the words.
"""

from __future__ import annotations

import struct

import numpy as np

from wearline.llm.common import spans

BLOCK = 1024
ESCAPE, ZEROS = 0, 1
# Numbers per word and bits of each, by selector. 60 payload bits divided evenly, and a run of zeros.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
ALONE = len(COUNTS) - 1
_HEAD = struct.Struct("<4sIIII")
_MAGIC = b"S8B1"
# Selectors tried at every place; those with more numbers only where the last of these fits its width.
_EVERYWHERE = [14, 13, 12, 11, 10]


def _selectors(padded: np.ndarray) -> np.ndarray:
    """The selector holding most numbers from each place on; blocks are ended by a number that fits none."""
    n = len(padded)
    best = np.full(n, ALONE, dtype=np.int8)
    best[padded >= np.uint64(1 << 60) if padded.dtype == np.uint64 else np.zeros(n, bool)] = ESCAPE
    most, width = padded, 1
    for s in _EVERYWHERE:
        # The largest of COUNTS[s] numbers, each step one number longer.
        most = np.maximum(most[:-1], padded[width : width + len(most) - 1])
        width += 1
        best[: len(most)][most < (1 << int(WIDTHS[s]))] = s
    places = np.flatnonzero(most < (1 << int(WIDTHS[_EVERYWHERE[-1]])))
    largest = most[places]
    for s in range(_EVERYWHERE[-1] - 1, 0, -1):
        while width < COUNTS[s]:
            inside = places + width < n
            places, largest = places[inside], largest[inside]
            largest = np.maximum(largest, padded[places + width])
            width += 1
            if width & 7 == 0:
                fits = largest < (1 << int(WIDTHS[s]))
                places, largest = places[fits], largest[fits]
        fits = largest < (1 << int(WIDTHS[s]))
        places, largest = places[fits], largest[fits]
        best[places] = s
    return best


def encode(numbers: np.ndarray) -> bytes:
    """Coded numbers (unsigned, at most 64 bits) with a header and the word at which each block begins."""
    n = len(numbers)
    blocks = -(-n // BLOCK)
    kind = np.uint64 if n and int(numbers.max()) >= (1 << 32) - 1 else np.uint32
    sentinel = np.iinfo(kind).max
    if not n:
        return _HEAD.pack(_MAGIC, 0, 0, 0, 0)
    padded = np.full((blocks, BLOCK + 1), sentinel, dtype=kind)
    flat = np.full(blocks * BLOCK, sentinel, dtype=kind)
    flat[:n] = numbers
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    padded = padded.ravel()
    best = _selectors(padded)
    steps = COUNTS[best]
    # All blocks are walked at once, a word at a time.
    at = np.arange(blocks) * (BLOCK + 1)
    ends = at + np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    begins = np.zeros(len(padded), dtype=bool)
    while len(at):
        begins[at] = True
        at = at + steps[at]
        going = at < ends
        at, ends = at[going], ends[going]
    places = np.flatnonzero(begins)
    chosen = best[places].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    for s in range(2, len(COUNTS)):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            value = words[mine]
            for k in range(int(COUNTS[s])):
                value |= padded[places[mine] + k].astype(np.uint64) << np.uint64(k * int(WIDTHS[s]))
            words[mine] = value
    starts = np.searchsorted(places, np.arange(blocks) * (BLOCK + 1)).astype("<u4")
    head = _HEAD.pack(_MAGIC, n, blocks, len(words), len(escaped))
    return b"".join(
        [head, starts.tobytes(), words.astype("<u8").tobytes(), padded[places[escaped]].astype("<u8").tobytes()]
    )


def decode(data: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The numbers of the blocks from ``first_block`` up to, not including, ``last_block`` (all by default)."""
    magic, _, blocks, n_words, n_escaped = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a Simple-8b block list")
    last_block = blocks if last_block is None else min(last_block, blocks)
    if first_block >= last_block:
        return np.zeros(0, dtype=np.uint64)
    starts = np.frombuffer(data, "<u4", blocks, _HEAD.size)
    words_at = _HEAD.size + 4 * blocks
    low, high = int(starts[first_block]), int(starts[last_block]) if last_block < blocks else n_words
    words = np.frombuffer(data, "<u8", high - low, words_at + 8 * low)
    escaped = np.frombuffer(data, "<u8", n_escaped, words_at + 8 * n_words)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    payload = words & np.uint64((1 << 60) - 1)
    counts = COUNTS[selectors]
    places = spans(counts)
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for s in np.unique(selectors).tolist():
        mine = np.flatnonzero(selectors == s)
        if s == ESCAPE:
            out[places[mine]] = escaped[payload[mine].astype(np.int64)]
        elif s != ZEROS:
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            value, where = payload[mine], places[mine]
            for k in range(int(COUNTS[s])):
                out[where + k] = (value >> np.uint64(k * int(WIDTHS[s]))) & mask
    return out
