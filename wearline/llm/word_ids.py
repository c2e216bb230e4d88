"""Fast ids of whole texts for the lower-casing word-level BPE tokenizer files.

Such a tokenizer drops white space and never joins characters across it, so the ids of a text are those of its
space-separated words one after the other, and each distinct word need be encoded only once. What the library does is
asked of the library: words of letters go to its BPE model, all others through the whole tokenizer, and texts with
characters beyond Latin (where case or normal forms depend on more than one character) or with what may be a special
token are encoded whole. A stop after letters is a token run of its own.
"""

from __future__ import annotations

import functools
import json
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from wearline.llm.common import gather

# Words remembered at a time; about 200 bytes each. Beyond, an encoder starts afresh.
REMEMBERED = 250_000

# Texts that can't be taken word by word.
BY_WORD_NOT = r"[^\x{0}-\x{24f}]|İ|<\|"
_STOPS = ".,;:!?"


def read_tokenizer(path: str) -> str:
    """The tokenizer file's content; read on the driver, so that executors need no such file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


@functools.cache
def _latin_letters() -> dict[str, str]:
    """What the library's byte-level alphabet writes for each Latin letter."""
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x250)) if c.isalpha()}


class WordEncoder:
    """Encodes columns of texts; remembers the ids of words."""

    def __init__(self, source: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        # Only the normalizer's settings: the whole file takes up many times its size once parsed.
        normalizer = self.tokenizer.normalizer
        settings = json.loads(normalizer.__getstate__()) if normalizer else {}
        kinds = [n["type"] for n in settings.get("normalizers", [])]
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"]
        self.letters = _latin_letters()
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.marks: dict[str, list[int]] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.lengths = np.zeros(0, dtype=np.int64)

    def _word(self, word: str) -> list[int]:
        letters = word.rstrip(_STOPS)
        if not letters.isalpha():
            return self._whole(word)
        mapped = letters if letters.isascii() else "".join([self.letters[c] for c in letters])
        ids = [t.id for t in self.model.tokenize(mapped)]
        return ids + self._stops(word[len(letters) :]) if len(letters) < len(word) else ids

    def _stops(self, marks: str) -> list[int]:
        if marks not in self.marks:
            self.marks[marks] = self._whole(marks)
        return self.marks[marks]

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids if text else []

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has; NULL counts as empty."""
        if len(self.codes) > self.remembered:
            self._forget()
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = pc.match_substring_regex(texts, BY_WORD_NOT if self.by_word else "")
        lowered = pc.replace_substring(pc.utf8_lower(pc.if_else(whole, "", texts)), "\n", " ")
        words = pc.split_pattern(lowered, " ")
        bounds = words.offsets.to_numpy()
        distinct = words.flatten().dictionary_encode()
        code_of = self._codes(distinct.dictionary.to_pylist())
        every = code_of[distinct.indices.to_numpy()]
        starts = np.cumsum(self.lengths) - self.lengths
        taken = self.lengths[every]
        out = gather(self.flat, starts[every], taken)
        ends = np.concatenate([[0], np.cumsum(taken)])
        counts = ends[bounds[1:] - bounds[0]] - ends[bounds[:-1] - bounds[0]]
        rest = np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist()
        if not rest:
            return out, counts
        parts = np.split(out, np.cumsum(counts)[:-1])
        for i in rest:
            parts[i] = np.array(self._whole(texts[i].as_py()), dtype=np.int32)
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)

    def _codes(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; those not seen before are encoded."""
        known = len(self.codes)
        number = self.codes.setdefault
        codes = np.fromiter((number(w, len(self.codes)) for w in words), dtype=np.int64, count=len(words))
        if len(self.codes) > known:
            ids = [self._word(w) for w in islice(self.codes, known, None)]
            more = np.fromiter(chain.from_iterable(ids), dtype=np.int32)
            self.flat = np.concatenate([self.flat, more])
            self.lengths = np.concatenate([self.lengths, np.array([len(w) for w in ids], dtype=np.int64)])
        return codes
