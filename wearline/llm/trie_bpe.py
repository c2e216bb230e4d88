"""Byte-level BPE of distinct words by one depth-first walk over their trie, and decoding.

A prefix of a word has one last token, and the encoding of a word is read back from the last tokens of its prefixes.
The last token of a prefix is the token ending there that may follow the last token of what stands before it. So all
that a node of the trie needs is that token, and words that share a prefix share the work for it. The words in
sorted order are the trie in depth-first order: from one word to the next, the path down to their common prefix stays.

Whether a token may follow another is decided by the merges alone: merges work on both tokens independently, and
the pair breaks up if at some point the last part of the left one and the first part of the right one would merge.

Texts are cut by the tokenizer's own rule; NULL text counts as empty and has no ids. Repeated rows and NULL ids stay rows. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import by_column, gather, load, ready, spans
from wearline.llm.word_ids import read_tokenizer

# Fixed value: how byte-level BPE files cut text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Texts that can't be cut at each space: a space is followed by white space or by the end.
SPACES = r" ([\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"
# Words and token pairs remembered by one Python worker. Beyond, it starts afresh.
REMEMBERED = 600_000
NEVER = 1 << 30


@functools.cache
def alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes have the characters from 256 on.
    """
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and which token may follow which."""

    def __init__(self, source: str) -> None:
        settings = json.loads(source)
        model = settings["model"]
        plain = model["type"] == "BPE" and not settings["normalizer"] and not model.get("end_of_word_suffix")
        level = settings["pre_tokenizer"]
        if not (plain and level["type"] == "ByteLevel" and level["use_regex"] and not level["add_prefix_space"]):
            raise ValueError("not a plain byte-level BPE file")
        table = alphabet()
        self.special = {}
        for t in settings["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError("added tokens with conditions are not supported")
            self.special[t["content"]] = t["id"]
        self.ids = {bytes(table[c] for c in token): i for token, i in model["vocab"].items()}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in self.ids.items():
            self.bytes[i] = token
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.starts = spans(self.lengths)
        self._read_merges(model)

    def _read_merges(self, model: dict) -> None:
        vocab = model["vocab"]
        self.merges: dict[int, int] = {}
        # The parts at a token's right and left edge, with the rank at which each is merged away.
        self.right = [[(i, NEVER)] for i in range(len(self.bytes))]
        self.left = [[(i, NEVER)] for i in range(len(self.bytes))]
        made = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merges[left << 20 | right] = rank
            self.right[whole] += [(right, rank), *self.right[right][1:]]
            self.left[whole] += [(left, rank), *self.left[left][1:]]
            made.append((left, right, whole, rank))
        # A token that the merges never reach from its own bytes can't occur.
        reached = {i for b, i in self.ids.items() if len(b) == 1}
        for left, right, whole, rank in made:
            if left in reached and right in reached and not self._meets(left, right, rank):
                reached.add(whole)
        self.tokens = {b: i for b, i in self.ids.items() if i in reached}
        self.longest = max(map(len, self.tokens), default=1)

    def _meets(self, left: int, right: int, before: int) -> bool:
        """Whether parts of both merge with each other at a rank below ``before``."""
        merges = self.merges
        for x, gone in self.right[left]:
            for y, taken in self.left[right]:
                rank = merges.get(x << 20 | y)
                # At equal ranks the merge further left goes first.
                if rank is not None and rank < gone and rank <= taken and rank < before:
                    return True
        return False

    def follows(self, left: int, right: int) -> bool:
        return not self._meets(left, right, NEVER)


class Lists:
    """Numbered keys with a list of numbers each, in flat arrays."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.lengths = np.zeros(0, dtype=np.int64)

    def number(self, keys: list[str]) -> tuple[np.ndarray, list[str]]:
        """The keys' numbers, and the keys that are new; :meth:`add` must follow with their lists."""
        known, codes = len(self.codes), self.codes
        numbers = np.fromiter((codes.setdefault(k, len(codes)) for k in keys), dtype=np.int64, count=len(keys))
        return numbers, list(islice(codes, known, None)) if len(codes) > known else []

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat])
        self.lengths = np.concatenate([self.lengths, lengths])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All lists in order, and the length of each."""
        lengths = self.lengths[numbers]
        return gather(self.flat, (np.cumsum(self.lengths) - self.lengths)[numbers], lengths), lengths


class TrieEncoder:
    """Encodes columns of texts; remembers parts of texts as lists of words, and words as lists of ids."""

    def __init__(self, source: str) -> None:
        self.vocabulary = Vocabulary(source)
        self.cut = regex.compile(PATTERN).findall
        self.allowed: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.parts, self.known = Lists(), Lists()

    def words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words, by a depth-first walk over their trie."""
        token_of, longest = self.vocabulary.tokens.get, self.vocabulary.longest
        may_follow, out = self._may_follow, {}
        # Along the path: the last token of each prefix, and where it begins.
        last, where = [-1], [0]
        previous = b""
        for word in sorted(words):
            shared = 0
            for a, b in zip(previous, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], where[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                # Only one token fits; most often it begins where the one before did, or later.
                first = max(0, end - longest)
                likely = max(first, where[end - 1])
                for start in range(likely, end):
                    token = token_of(word[start:end])
                    if token is not None and (not start or may_follow(last[start], token)):
                        break
                else:
                    for start in range(likely - 1, first - 1, -1):
                        token = token_of(word[start:end])
                        if token is not None and (not start or may_follow(last[start], token)):
                            break
                    else:
                        raise ValueError("a byte is not in the vocabulary")
                last.append(token)
                where.append(start)
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end = where[end]
            ids.reverse()
            out[word] = ids
            previous = word
        if len(self.allowed) > REMEMBERED:
            self.allowed.clear()
        return out

    def _may_follow(self, left: int, right: int) -> bool:
        pair = left << 20 | right
        may = self.allowed.get(pair)
        if may is None:
            may = self.allowed[pair] = self.vocabulary.follows(left, right)
        return may

    def _part_numbers(self, parts: list[str]) -> np.ndarray:
        """Numbers of parts of texts; the words of new ones are encoded."""
        numbers, new = self.parts.number(parts)
        if new:
            cuts = [self.cut(p) for p in new]
            words, fresh = self.known.number(list(chain.from_iterable(cuts)))
            if fresh:
                data = [w.encode() for w in fresh]
                found = self.words(data)
                ids = [found[w] for w in data]
                lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                self.known.add(np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=lengths.sum()), lengths)
            self.parts.add(words.astype(np.int32), np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts)))
        return numbers

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text with special tokens or runs of spaces."""
        pieces, ids = [text], []
        for special in self.vocabulary.special:
            pieces = [x for p in pieces for x in _around(p, special)]
        for piece in pieces:
            if piece in self.vocabulary.special:
                ids.append(np.array([self.vocabulary.special[piece]], dtype=np.int32))
            elif piece:
                cuts = [w.encode() for w in self.cut(piece)]
                found = self.words(list(set(cuts)))
                ids.append(np.fromiter((t for w in cuts for t in found[w]), dtype=np.int32))
        return np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        if max(len(self.parts.codes), len(self.known.codes)) > REMEMBERED:
            self._forget()
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = pc.match_substring_regex(texts, SPACES)
        for special in self.vocabulary.special:
            whole = pc.or_(whole, pc.match_substring(texts, special))
        # Each space begins a new part.
        parts = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        bounds = parts.offsets.to_numpy()
        distinct = parts.flatten().dictionary_encode()
        pieces = distinct.dictionary.to_pylist()
        every = self._part_numbers([" " + p for p in pieces])[distinct.indices.to_numpy()]
        first = bounds[:-1] - bounds[0]
        every[first] = self._part_numbers([pieces[i] for i in distinct.indices.to_numpy()[first].tolist()])
        words, each = self.parts.take(every)
        out, taken = self.known.take(words)
        # From ids per word to ids per part to ids per text.
        word_ends = np.concatenate([[0], np.cumsum(taken)])
        part_ends = word_ends[np.concatenate([[0], np.cumsum(each)])]
        counts = part_ends[bounds[1:] - bounds[0]] - part_ends[first]
        rest = np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist()
        if not rest:
            return out, counts
        separate = np.split(out, np.cumsum(counts)[:-1])
        for i in rest:
            separate[i] = self._whole(texts[i].as_py())
        return np.concatenate(separate), np.array([len(e) for e in separate], dtype=np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        v = self.vocabulary
        return gather(v.flat, v.starts[ids], v.lengths[ids]).tobytes()


def _around(text: str, special: str) -> Iterator[str]:
    """Parts of a text around each special token, and the tokens between them."""
    for i, part in enumerate(text.split(special)):
        if i:
            yield special
        yield part


@functools.lru_cache(maxsize=2)
def encoder(source: str) -> TrieEncoder:
    """One encoder per Python worker, which keeps its words over tasks."""
    return TrieEncoder(source)


def encoded(text: Column, tokenizer: str) -> Column:
    """The ids of a text as little-endian 32-bit integers; ``tokenizer`` as in ``read_tokenizer``."""

    def compute(column: pa.Array) -> pa.Array:
        ids, counts = encoder(tokenizer).encode(column)
        raw = ids.astype("<u4").tobytes()
        starts = spans(counts)
        return pa.array(
            [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), (starts + counts).tolist(), strict=True)], pa.binary()
        )

    return by_column(compute, "binary")(text)


def decoded(ids: Column, tokenizer: str) -> Column:
    """The text of ids written by :func:`encoded`; bytes that are no UTF-8 become replacement characters."""

    def compute(column: pa.Array) -> pa.Array:
        decode = encoder(tokenizer).decode
        return pa.array([decode(np.frombuffer(x, "<u4")).decode("utf-8", "replace") for x in column.to_pylist()])

    return by_column(compute, "string")(ids)


def op10_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table ``documents`` encoded and decoded again."""
    import public_tokenizers

    ready(spark, times=2)
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    ids = load(spark, sf_dir, "documents").select("doc_id", encoded(F.col("text"), tokenizer).alias("ids"))
    both = ids.withColumn("decoded", decoded(F.col("ids"), tokenizer))
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
