"""Bit predictors over hashed contexts and their mixing, for words spelled byte by byte.

A word is its bytes and a space behind them. Each bit is predicted from the bits of its byte so far together with,
in turn, the last one to four bytes, and all of the word so far. A predictor is two counts, in a table of
fixed size found by a hash; those of the word so far are given beside the words, exact for every word (see ``prefixes``). Only short lists of words may
do without: then a table for the word so far belongs to the first words, its slots hold a check
of their owner, and a context that finds another's check predicts nothing. Predictions are added in the logistic domain with weights that depend on how sure the long
contexts are (the gate) and learn online, with a step after each bit; the sum is refined by a table of what really followed such sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

# Slots of each predictor, whatever the corpus; the first is not hashed.
SLOTS = (1 << 16, 1 << 18, 1 << 20, 1 << 22, 1 << 22)
FIRST = np.cumsum((0, *SLOTS[:-1])).tolist()
ALL_SLOTS = sum(SLOTS)
PREDICTORS = len(SLOTS)
PRIOR = 0.1
WORD, FOUR = 4, 3
HASHED_SLOTS = FIRST[WORD]
# How sure a context is by what it has seen, for all of the word so far and for four bytes.
WORD_LEVELS = np.array([1, 4, 32, 512])
FOUR_LEVELS = np.array([1, 4, 32])
CONFIDENCES = (len(WORD_LEVELS) + 1) * (len(FOUR_LEVELS) + 1)
GATES = CONFIDENCES * 8
BUCKETS = 33
# Bytes predicted at a time; the working memory is up to 3 kB for each.
AT_ONCE = 1 << 13
# Bytes learned one after the other, and how far one bit moves the weights.
RUN = 256
RATE = 0.02
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_STEP_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_BITS = np.arange(8, dtype=np.int64)[:, None]


def stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + PRIOR) / (n0 + PRIOR)).astype(np.float32)


def squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def _mixed(context: np.ndarray, partial: np.ndarray) -> np.ndarray:
    mixed = (context[None, :] * np.uint64(257) + partial.astype(np.uint64)) * _SPREAD
    mixed ^= mixed >> np.uint64(29)
    return mixed * _SPREAD


def _slot(mixed: np.ndarray, predictor: int) -> np.ndarray:
    """Where a context with the bits so far is kept."""
    return FIRST[predictor] + (mixed >> np.uint64(64 - (SLOTS[predictor].bit_length() - 1))).astype(np.int64)


def owners(words: list[bytes]) -> np.ndarray:
    """Checks of the slots for the word so far, for words in descending order of frequency; 0 where none owns one."""
    checks = np.zeros(SLOTS[WORD], dtype=np.uint8)
    for first in range(len(words) - 1, -1, -4096):
        for _, _, slots, check in spelled(words[max(0, first - 4095) : first + 1][::-1]):
            # Positions run from rare to frequent, so the last assignment is that of the most frequent word.
            checks[(slots[WORD] - FIRST[WORD]).T.ravel()] = check.T.ravel()
    return checks


def spelled(words: list[bytes], owned: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray | None]]:
    """For some bytes at a time: the word of each, its bits, each predictor's slots, and the check (8 rows each).

    Unless ``owned``, there are no slots and no check for the word so far.
    """
    text = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(text)) - starts[owner]
    if owned:
        back = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text + 1) * _powers(_STEP_BACK, len(text)))])
        begin = starts[owner]
        whole = (back[:-1] - back[begin]) * _powers(_STEP, len(text))[begin]
    before = [np.where(place >= k, np.roll(text, k), 0).astype(np.uint64) for k in (1, 2, 3, 4)]
    two = before[0] | before[1] << np.uint64(8)
    three = two | before[2] << np.uint64(16)
    four = three | before[3] << np.uint64(24)
    for a in range(0, len(text), AT_ONCE):
        some = slice(a, a + AT_ONCE)
        byte = text[some].astype(np.int64)
        partial = (1 << _BITS) | (byte >> (8 - _BITS))
        bits = (byte >> (7 - _BITS)) & 1
        slots = [
            (before[0][some].astype(np.int64) << 8) + partial,
            _slot(_mixed(two[some], partial), 1),
            _slot(_mixed(three[some], partial), 2),
            _slot(_mixed(four[some], partial), FOUR),
        ]
        check = None
        if owned:
            mixed = _mixed(whole[some], partial)
            slots.append(_slot(mixed, WORD))
            check = (mixed & np.uint64(0xFF)).astype(np.uint8) | np.uint8(1)
        yield owner[some], bits, slots, check


def _spelled_with(
    words: list[bytes], whole: np.ndarray | None
) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray | None, np.ndarray | None]]:
    """:func:`spelled` with the counts of the word so far (0 and 1, by bit and byte of ``words``), if there are any."""
    for i, part in enumerate(spelled(words, whole is None)):
        yield *part, None if whole is None else whole[:, :, i * AT_ONCE : (i + 1) * AT_ONCE]


def _side_by_side(values: np.ndarray, runs: int) -> np.ndarray:
    """By bit and byte (and more) as by step, and run and bit; a run ends with zeros if the bytes don't fill it."""
    n = values.shape[1]
    steps = -(-n // runs)
    out = np.zeros((8, runs * steps, *values.shape[2:]), dtype=values.dtype)
    out[:, :n] = values
    out = np.moveaxis(out.reshape(8, runs, steps, *values.shape[2:]), (2, 1, 0), (0, 1, 2))
    return np.ascontiguousarray(out).reshape(steps, runs * 8, *values.shape[2:])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def gates(seen_word: np.ndarray, seen_four: np.ndarray) -> np.ndarray:
    """Confidence of the contexts by how much they have seen."""
    high = np.searchsorted(WORD_LEVELS, seen_word, side="right")
    return high * (len(FOUR_LEVELS) + 1) + np.searchsorted(FOUR_LEVELS, seen_four, side="right")


class BitCounter:
    """Counts of all slots: ``counts[slot, bit]``; without checks there are none for the word so far."""

    def __init__(self, checks: np.ndarray | None) -> None:
        self.checks = checks
        self.counts = np.zeros((HASHED_SLOTS if checks is None else ALL_SLOTS, 2))

    def add(self, words: list[bytes], times: np.ndarray) -> None:
        """Count the bits of words that occur so many times."""
        flat = self.counts.reshape(-1)
        for owner, bits, slots, check in spelled(words, self.checks is not None):
            weight = np.broadcast_to(times[owner].astype(np.float64), bits.shape)
            for k, s in enumerate(slots):
                keys, mass = s * 2 + bits, weight
                if k == WORD:
                    mine = self.checks[s - FIRST[k]] == check
                    keys, mass = keys[mine], mass[mine]
                np.add.at(flat, keys.ravel(), mass.ravel())


@dataclass
class Sums:
    """What learning gathers: mass by gate, and what followed by bit, confidence and bucket."""

    mass: np.ndarray = field(default_factory=lambda: np.zeros(GATES))
    followed: np.ndarray = field(default_factory=lambda: np.zeros((2, CONFIDENCES, BUCKETS)))


@dataclass
class Model:
    """Counts of all slots (None once prepared), checks, mixing weights by gate and predictor, and the refining table.

    Without checks, the counts of the word so far (``whole``) must be given with all words.
    """

    counts: np.ndarray | None
    checks: np.ndarray | None
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, PREDICTORS), 0.3, dtype=np.float32))
    refine: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.counts = np.ascontiguousarray(self.counts, dtype=np.float32)

    def _without_self(
        self, bits: np.ndarray, slots: list[np.ndarray], check: np.ndarray | None, whole: np.ndarray | None = None
    ):
        """Predictions and gates as they would be had the word occurred once less: training sees what scoring will."""
        predictions, seen = np.empty((PREDICTORS, *bits.shape), dtype=np.float32), {}
        own = bits.astype(np.float32)
        # Both counts of a slot are fetched as one number.
        slots_of = self.counts.view(np.int64).ravel()
        for k in range(PREDICTORS):
            if k == WORD and whole is not None:
                n0, n1 = whole
            else:
                counts = slots_of.take(slots[k]).view(np.float32).reshape(*bits.shape, 2)
                n0, n1 = counts[..., 0], counts[..., 1]
            n0, n1 = np.maximum(n0 - (1 - own), 0), np.maximum(n1 - own, 0)
            if k == WORD and whole is None:
                mine = self.checks[slots[k] - FIRST[k]] == check
                n0, n1 = n0 * mine, n1 * mine
            predictions[k] = stretch(n0, n1)
            if k in (WORD, FOUR):
                seen[k] = n0 + n1
        return predictions, gates(seen[WORD], seen[FOUR])

    def learn(self, words: list[bytes], times: np.ndarray, sums: Sums, whole: np.ndarray | None = None) -> None:
        """One online step of the weights per bit: down the slope of what its prediction cost, by ``RATE``.

        Each word that occurs is learned once, as when it is new: seen words are predicted by their shares. Runs of bytes are learned side by side, each
        bit by bit, beginning with the weights before them; the mean of theirs, by bits at each gate, are the weights behind them. The bits of
        a byte differ in their gates, so none sees the step of another, and they step together.
        What follows the mixed predictions is counted for the refining table before each step.
        """
        for owner, bits, slots, check, part in _spelled_with(words, whole):
            x, confidence = self._without_self(bits, slots, check, part)
            weight = np.broadcast_to(times[owner] > 0, bits.shape).astype(np.float32)
            gate = confidence * 8 + _BITS
            runs = -(-bits.shape[1] // RUN)
            x = _side_by_side(np.moveaxis(x, 0, -1), runs)
            here, bit, weight = (_side_by_side(a, runs) for a in (gate, bits, weight))
            at = here + np.repeat(np.arange(runs) * GATES, 8)
            # Steps are no longer than the curvature of the cost allows, however sure the predictions.
            step = x * (weight * np.float32(RATE) / (1 + np.float32(RATE / 4) * np.einsum("tij,tij->ti", x, x)))[..., None]
            wanted = bit.astype(np.float32) - np.float32(0.5)
            weights, z = np.tile(self.weights, (runs, 1)), np.empty_like(wanted)
            for t in range(len(z)):
                w = weights.take(at[t], axis=0)
                np.einsum("ij,ij->i", w, x[t], out=z[t])
                error = wanted[t] - np.tanh(z[t] / 2) / 2
                weights[at[t]] = w + error[:, None] * step[t]
            keys = (bit * CONFIDENCES + here // 8) * BUCKETS + bucket(z)
            sums.followed += np.bincount(keys.ravel(), weights=weight.ravel(), minlength=sums.followed.size).reshape(sums.followed.shape)
            mass = np.bincount(at.ravel(), weights=weight.ravel(), minlength=runs * GATES).reshape(runs, GATES)
            moved = np.einsum("rg,rgk->gk", mass, weights.reshape(runs, GATES, PREDICTORS) - self.weights)
            mass = mass.sum(axis=0)
            self.weights += (moved / np.maximum(mass, 1)[:, None]).astype(np.float32)
            sums.mass += mass

    def _mix(self, x: list[np.ndarray], confidence: np.ndarray) -> np.ndarray:
        gate = confidence * 8 + _BITS
        return np.clip(sum(self.weights[:, k][gate] * x[k] for k in range(PREDICTORS)), -12, 12)

    def prepared(self) -> Model:
        """Tables that scoring looks up instead of computing: predictions, and the gates' parts."""
        seen = self.counts.sum(axis=1)
        self.predictions = stretch(self.counts[:, 0], self.counts[:, 1])
        word, four = (seen[FIRST[k] : FIRST[k] + SLOTS[k]] for k in (WORD, FOUR))
        self.word_part = gates(word, np.zeros(1)).astype(np.int8)
        self.four_part = np.searchsorted(FOUR_LEVELS, four, side="right").astype(np.int8)
        self.counts = None
        return self

    def log2(self, words: list[bytes], whole: np.ndarray | None = None) -> np.ndarray:
        """The log2 probability of each word."""
        out = np.zeros(len(words))
        for owner, bits, slots, check, part in _spelled_with(words, whole):
            x = [self.predictions.take(s) for s in slots]
            if part is None:
                mine = self.checks[slots[WORD] - FIRST[WORD]] == check
                word_part = self.word_part[slots[WORD] - FIRST[WORD]] * mine
                x[WORD] *= mine
            else:
                word_part = gates(part[0] + part[1], np.zeros(1))
                x.append(stretch(*part))
            confidence = (word_part + self.four_part[slots[FOUR] - FIRST[FOUR]]).astype(np.int64)
            z = self._mix(x, confidence)
            p = squash(z)
            if self.refine is not None:
                p = 0.5 * (p + self.refine[confidence, bucket(z)])
            followed = np.where(bits == 1, p, 1 - p)
            out += np.bincount(owner, weights=np.log2(followed).sum(axis=0), minlength=len(words))
        return out


def bucket(z: np.ndarray) -> np.ndarray:
    """Which of the refining table's columns a mixed prediction falls into."""
    return np.clip(np.rint(z * 2) + BUCKETS // 2, 0, BUCKETS - 1).astype(np.int64)


def refining(tallies: np.ndarray) -> np.ndarray:
    """Probabilities of a set bit by confidence and bucket; little evidence leaves the bucket's own."""
    own = squash((np.arange(BUCKETS) - BUCKETS // 2) / 2.0)[None, :]
    return np.clip((tallies[1] + 8 * own) / (tallies.sum(axis=0) + 8), 1e-6, 1 - 1e-6).astype(np.float32)
