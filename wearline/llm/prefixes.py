"""How often words begin with each prefix, bit by bit, over all words of a corpus.

Words are bytes with a space behind them, so that none begins another, in ascending order. Those that share a prefix are then
neighbours, and its occurrences are the sum over a run of them. Spark sorts the words by ranges, and each task cuts its range (a part) into
pieces of some words. A prefix of words on both sides of a border is one of the word before it and of the word behind it. So a
piece carries, for its first word, how many occurrences before it share how many bits with that word, and for its last
word the same of those behind. With that a piece gives the counts of all prefixes of its words by itself, wherever it is read.

Shares of bits pass from border to border: what shares s bits with one word, which itself shares t bits with another, shares the smaller number
with that one, as all lie in order. The driver does so for one row per part, tasks for the pieces of their part. Every word takes part,
however rare or long; nothing is hashed. Memory is that of a part's words and, for the counts, of some pieces or the longest word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import Batches, by_task, gather, spans

# Words and bytes of a piece, and bytes of the pieces whose counts are made at once (one piece or word may have more).
PIECE_WORDS = 128
PIECE_BYTES = 1 << 12
BLOCK_BYTES = 1 << 15
END = 32
# How many bits two bytes begin with alike, by the bits they differ in.
_LEADING = np.array([8 - int(x).bit_length() for x in range(256)])

# Bits shared and occurrences that share so many, as two rows.
Shares = np.ndarray
NONE = np.zeros((2, 0), dtype=np.int64)

SCHEMA = (
    "part long, words binary, n binary, before binary, behind binary, to_first long, to_last long, holds_end boolean, "
    "total long, distinct long, once long, first binary, last binary, through long, at_first binary, at_last binary"
)


def shared_bits(a: bytes, b: bytes) -> int:
    """How many bits two words begin with alike."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return 8 * i + int(_LEADING[x ^ y])
    return 8 * min(len(a), len(b))


def _merged(shares: Shares, most: int | None = None) -> Shares:
    """Shares with each number of bits once, none above ``most``."""
    bits, n = shares
    if most is not None:
        bits = np.minimum(bits, most)
    bits, place = np.unique(bits, return_inverse=True)
    out = np.zeros((2, len(bits)), dtype=np.int64)
    out[0] = bits
    np.add.at(out[1], place, n)
    return out


@dataclass
class Stretch:
    """Neighbouring words: what they share with the first and the last of them, and the first with the last."""

    first: bytes
    last: bytes
    through: int
    at_first: Shares
    at_last: Shares


def _and(own: Shares, beyond: Shares, through: int) -> Shares:
    """Own shares of one end and those of the words beyond the other end."""
    beyond = beyond.copy()
    np.minimum(beyond[0], through, out=beyond[0])
    return np.concatenate([own, beyond], axis=1)


def around(stretches: Sequence[Stretch]) -> tuple[list[Shares], list[Shares]]:
    """Of each stretch, what the words before all of it share with its first word, and those behind with its last."""
    gaps = [shared_bits(a.last, b.first) for a, b in zip(stretches, stretches[1:])]
    before, behind = [NONE], [NONE]
    for s, gap in zip(stretches, gaps):
        before.append(_merged(_and(s.at_last, before[-1], s.through), gap))
    for s, gap in zip(stretches[:0:-1], gaps[::-1]):
        behind.append(_merged(_and(s.at_first, behind[-1], s.through), gap))
    return before, behind[::-1]


@dataclass
class Words:
    """Words one after the other, each with its end."""

    text: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    owner: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, text: bytes) -> Words:
        flat = np.frombuffer(text, dtype=np.uint8)
        lengths = np.diff(np.flatnonzero(flat == END), prepend=-1)
        starts, owner = spans(lengths), np.repeat(np.arange(len(lengths)), lengths)
        return cls(flat, lengths, starts, owner, np.arange(len(flat)) - starts[owner])

    def shared(self) -> np.ndarray:
        """How many bits each word shares with the one before; -1 for the first."""
        out = 8 * self.lengths
        differ = self.text ^ self.text[self.starts[np.maximum(self.owner - 1, 0)] + self.place]
        where = np.flatnonzero(differ)
        where = where[np.diff(self.owner[where], prepend=-1) > 0]
        out[self.owner[where]] = 8 * self.place[where] + _LEADING[differ[where]]
        out[:1] = -1
        return out


def _stretch(text: bytes, n: np.ndarray, shared: np.ndarray) -> Stretch:
    """``shared`` is that of :meth:`Words.shared`; the first is not looked at."""
    first, last = text[: text.index(b" ") + 1], text[text.rfind(b" ", 0, -1) + 1 :]
    least = np.minimum.accumulate
    with_first = np.append(8 * len(first), least(shared[1:]))
    with_last = np.append(least(shared[:0:-1])[::-1], 8 * len(last))
    seen = n > 0
    at_first, at_last = (_merged(np.stack([w[seen], n[seen]])) for w in (with_first, with_last))
    return Stretch(first, last, int(with_first[-1]), at_first, at_last)


def _cut(lengths: np.ndarray) -> Iterator[slice]:
    """Slices of words that make pieces."""
    ends, first = np.cumsum(lengths), 0
    while first < len(lengths):
        begin = ends[first] - lengths[first]
        last = int(np.searchsorted(ends, begin + PIECE_BYTES, side="right"))
        last = min(max(last, first + 1), first + PIECE_WORDS)
        yield slice(first, last)
        first = last


def _pieces(batches: Batches) -> Batches:
    """The pieces of a part, whose words come in order."""
    part = TaskContext.get().partitionId()
    texts, counts, stretches = [], [], []
    for batch in batches:
        text, n = b"".join(batch.column("word").cast(pa.binary()).to_pylist()), batch.column("n").to_numpy().astype(np.int64)
        words = Words.of(text)
        shared = words.shared()
        for some in _cut(words.lengths):
            begin = words.starts[some.start]
            texts.append(text[begin : begin + words.lengths[some].sum()])
            counts.append(n[some])
            stretches.append(_stretch(texts[-1], counts[-1], shared[some]))
    if not texts:
        return
    before, behind = around(stretches)
    gaps = [shared_bits(a.last, b.first) for a, b in zip(stretches, stretches[1:])]
    # How far the first word of the part goes along with the first of each piece, and the last with the last.
    inner = [s.through for s in stretches]
    to_first = np.minimum.accumulate([8 * len(stretches[0].first), *np.minimum(inner[:-1], gaps)])
    to_last = np.minimum.accumulate([8 * len(stretches[-1].last), *np.minimum(inner[1:], gaps)[::-1]])[::-1]
    whole = Stretch(
        stretches[0].first,
        stretches[-1].last,
        int(min(to_first[-1], inner[-1])),
        _merged(_and(stretches[0].at_first, behind[0], inner[0])),
        _merged(_and(stretches[-1].at_last, before[-1], inner[-1])),
    )
    for a in range(0, len(texts), 1024):
        some = range(a, min(a + 1024, len(texts)))
        ends = [texts[i].startswith(b" ") or b"  " in texts[i] for i in some]
        only = [i == 0 for i in some]
        # The end is counted like a word, yet is none that was seen once.
        once = [int((counts[i] == 1).sum()) - int(e and counts[i][_place_of_end(texts[i])] == 1) for i, e in zip(some, ends)]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part] * len(some), pa.int64()),
                "words": pa.array([texts[i] for i in some], pa.binary()),
                "n": pa.array([counts[i].tobytes() for i in some], pa.binary()),
                "before": pa.array([before[i].tobytes() for i in some], pa.binary()),
                "behind": pa.array([behind[i].tobytes() for i in some], pa.binary()),
                "to_first": pa.array(to_first[some.start : some.stop], pa.int64()),
                "to_last": pa.array(to_last[some.start : some.stop], pa.int64()),
                "holds_end": pa.array(ends, pa.bool_()),
                "total": pa.array([int(counts[i].sum()) for i in some], pa.int64()),
                "distinct": pa.array([int((counts[i] > 0).sum()) for i in some], pa.int64()),
                "once": pa.array(once, pa.int64()),
                "first": pa.array([whole.first if o else None for o in only], pa.binary()),
                "last": pa.array([whole.last if o else None for o in only], pa.binary()),
                "through": pa.array([whole.through if o else None for o in only], pa.int64()),
                "at_first": pa.array([whole.at_first.tobytes() if o else None for o in only], pa.binary()),
                "at_last": pa.array([whole.at_last.tobytes() if o else None for o in only], pa.binary()),
            }
        )


def _place_of_end(text: bytes) -> int:
    """Which word of a piece is the empty one."""
    return 0 if text.startswith(b" ") else text[: text.index(b"  ")].count(b" ") + 1


def pieces(counts: DataFrame) -> DataFrame:
    """Pieces of all words of ``counts`` (word, n), each word once; the end is the empty word."""
    ended = counts.select(F.concat("word", F.lit(chr(END))).alias("word"), "n")
    # As many parts as shuffles have: merged to fewer by their bytes, which are few, they would not keep the cores busy.
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ended.repartitionByRange(parts, "word").sortWithinPartitions("word").mapInArrow(by_task(_pieces), SCHEMA)


def _shares(data: bytes) -> Shares:
    return np.frombuffer(data, dtype=np.int64).reshape(2, -1)


def borders(stored: DataFrame) -> dict[int, tuple[Shares, Shares]]:
    """By part of :func:`pieces`, stored: what the words before it share with its first word, and those behind with its last."""
    rows = stored.where(F.col("first").isNotNull()).select("part", "first", "last", "through", "at_first", "at_last").collect()
    rows.sort(key=lambda r: bytes(r["first"]))
    stretches = [Stretch(bytes(r[1]), bytes(r[2]), r[3], _shares(r[4]), _shares(r[5])) for r in rows]
    return dict(zip([r["part"] for r in rows], zip(*around(stretches)))) if rows else {}


@dataclass
class Block:
    """Some words with their occurrences and, by bit and byte of each, how often a 0 and a 1 followed the word so far."""

    words: list[bytes]
    n: np.ndarray
    followed: np.ndarray

    def picked(self, which: np.ndarray) -> Block:
        """The words of these numbers, in this order."""
        lengths = np.array([len(w) + 1 for w in self.words], dtype=np.int64)
        at = gather(np.arange(self.followed.shape[2]), spans(lengths)[which], lengths[which])
        return Block([self.words[i] for i in which], self.n[which], self.followed[:, :, at])


def _groups(batch: pa.RecordBatch) -> Iterator[list[dict]]:
    """Pieces of a batch, up to ``BLOCK_BYTES`` together."""
    group, held = [], 0
    for row in batch.to_pylist():
        if group and held + len(row["words"]) > BLOCK_BYTES:
            yield group
            group, held = [], 0
        group.append(row)
        held += len(row["words"])
    if group:
        yield group


def plain(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words that occur, and how often, of pieces (words, n)."""
    for group in _groups(batch):
        n = np.frombuffer(b"".join(p["n"] for p in group), dtype=np.int64)
        words = b"".join(p["words"] for p in group).split(b" ")[:-1]
        if n.any():
            yield [words[i] for i in np.flatnonzero(n)], n[n > 0]


def blocks(batch: pa.RecordBatch, borders: Broadcast) -> Iterator[Block]:
    """Words of pieces with the counts of all their prefixes."""
    for group in _groups(batch):
        text = b"".join(p["words"] for p in group)
        n = np.frombuffer(b"".join(p["n"] for p in group), dtype=np.int64)
        before, behind = [], []
        for p in group:
            left, right = borders.value[p["part"]]
            before.append(_and(_shares(p["before"]), left, p["to_first"]))
            behind.append(_and(_shares(p["behind"]), right, p["to_last"]))
        yield Block(text.split(b" ")[:-1], n, followed(text, n, [len(p["n"]) // 8 for p in group], before, behind))


def followed(text: bytes, n: np.ndarray, sizes: list[int], before: list[Shares], behind: list[Shares]) -> np.ndarray:
    """How often 0 and 1 followed each prefix of the words of pieces of ``sizes`` words, by bit of the byte and byte."""
    words = Words.of(text)
    total = len(words.text)
    firsts = spans(np.array(sizes))
    shared = words.shared()
    # Pieces need not be neighbours.
    shared[firsts] = -1
    short = total < 1 << 15
    order = np.argsort(words.place.astype(np.int16) if short else words.place, kind="stable")
    rank = np.empty(total, dtype=np.int64)
    rank[order] = np.arange(total)
    # By place in the word and then word, the bytes behind one prefix lie side by side.
    owner = words.owner[order]
    alike, depth, times = shared[owner], 8 * words.place[order], n[owner]
    beyond = _beyond(words, rank, [*firsts, *(firsts + np.array(sizes) - 1)], [*before, *behind])

    def occurrences(bit: int) -> np.ndarray:
        starts = np.flatnonzero(alike < depth + bit)
        sums = np.add.reduceat(times, starts)
        at, extra = beyond[bit]
        np.add.at(sums, np.searchsorted(starts, at, side="right") - 1, extra)
        out = np.empty(total, dtype=np.int64)
        out[order] = np.repeat(sums, np.diff(starts, append=total))
        return out

    out = np.empty((2, 8, total), dtype=np.float32)
    here = occurrences(0)
    at_end = np.append(here[1:], 0)
    at_end[words.starts + words.lengths - 1] = n
    for bit in range(8):
        after = occurrences(bit + 1) if bit < 7 else at_end
        one = (words.text >> (7 - bit) & 1).astype(bool)
        out[0, bit], out[1, bit] = np.where(one, here - after, after), np.where(one, after, here - after)
        here = after
    return out


def _beyond(words: Words, rank: np.ndarray, of: list[int], shares: list[Shares]) -> list[tuple[np.ndarray, np.ndarray]]:
    """By bit: ranks of bytes of the words ``of``, and the occurrences beyond their pieces that share the prefix before that bit."""
    places, depths, extra = [], [], []
    for word, (bits, n) in zip(of, shares):
        if len(bits):
            # As many as share these bits or more.
            depth = np.arange(min(int(bits.max()) + 1, 8 * int(words.lengths[word])))
            most = np.zeros(len(depth), dtype=np.int64)
            np.add.at(most, np.minimum(bits, len(depth) - 1), n)
            places.append(rank[words.starts[word] + depth // 8])
            depths.append(depth % 8)
            extra.append(np.cumsum(most[::-1])[::-1])
    if not places:
        return [(np.zeros(0, dtype=np.int64),) * 2] * 8
    places, depths, extra = (np.concatenate(x) for x in (places, depths, extra))
    return [(places[depths == bit], extra[depths == bit]) for bit in range(8)]
