"""Words and character classes of a column of texts, counted by column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PUNCTUATION = ".,;:!?\"'()[]{}«»|"
CLASSES = ["upper", "lower", "digit", "space", "line", "stop", "symbol", "beyond"]
_CLASS_OF = np.full(256, CLASSES.index("symbol"), dtype=np.int64)
_CLASS_OF[65:91] = CLASSES.index("upper")
_CLASS_OF[97:123] = CLASSES.index("lower")
_CLASS_OF[48:58] = CLASSES.index("digit")
_CLASS_OF[[9, 11, 12, 13, 32]] = CLASSES.index("space")
_CLASS_OF[10] = CLASSES.index("line")
_CLASS_OF[[ord(c) for c in ".,;:!?'\"-()"]] = CLASSES.index("stop")
_CLASS_OF[128:] = CLASSES.index("beyond")


def filled(texts: pa.Array) -> pa.Array:
    """Texts with NULL as empty."""
    return texts.cast(pa.large_string()).fill_null("")


def words(texts: pa.Array, *, ascii_only: bool = False) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each text's words begin (one more than texts), the words by number, and the distinct lower-case words.

    Words are what ASCII white space separates. The empty word stands between two separators. With ``ascii_only``
    no other letters than A-Z are lower-cased.
    """
    lowered = (pc.ascii_lower if ascii_only else pc.utf8_lower)(filled(texts))
    parts = pc.split_pattern(pc.replace_substring_regex(lowered, r"[\t\n\x0b\f\r]", " "), " ")
    bounds = parts.offsets.to_numpy()
    distinct = parts.flatten().dictionary_encode()
    return bounds - bounds[0], distinct.indices.to_numpy().astype(np.int64), distinct.dictionary.to_pylist()


def character_classes(texts: pa.Array) -> np.ndarray:
    """How many bytes of each class each text has."""
    column = filled(texts)
    out = np.zeros((len(column), len(CLASSES)), dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) and offsets[-1] > offsets[0]:
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
        # A few texts at a time, as the working memory is a multiple of their size.
        for first in range(0, len(column), 128):
            some = offsets[first : first + 129]
            owner = np.repeat(np.arange(len(some) - 1), np.diff(some))
            keys = owner * len(CLASSES) + _CLASS_OF[data[some[0] : some[-1]]]
            out[first : first + len(some) - 1] = np.bincount(
                keys, minlength=(len(some) - 1) * len(CLASSES)
            ).reshape(-1, len(CLASSES))
    return out
