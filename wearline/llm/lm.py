"""Language-model scoring by online logistic context mixing.

A text is its words (A-Z lower-cased, cut at ASCII white space) and an end. Each token's probability is mixed in two
stages. Spelling it, bits are predicted by all of the word so far (see ``prefixes``) and by several hashed contexts, whose counts come from all training texts, added with gated
weights learned online by a step per bit, and refined by what followed (see ``bit_mixing``). Then three opinions on the token are mixed with weights that move slowly
along each text: its spelling, its share of the training tokens, and its share of the text so far. All stages are proper distributions over byte strings, so the score is a log probability; bits per byte follow from it.

Texts are cut into words once. A batch of texts becomes the list of its distinct words, whose rows are counted over all training texts, spelled
once per distinct word and joined back to the batches, and the texts as numbers into that list. As a batch names a word once, no word has
more than a small part of the rows, however frequent it is. Only the tables of bit counts, of fixed size, and a row per part of the sorted
words are sent to tasks.

NULL text counts as empty: its one token is the end. Without training texts nothing is known and the base is 0. A NULL id counts as
empty text in the choice of training texts. Repeated rows are scored each. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm import bit_mixing as bits
from wearline.llm import prefixes
from wearline.llm.columns import words as words_of
from wearline.llm.common import by_task, give_back, held_out, load, materialised, ready, spans

# Tasks that count and learn, each with tables of fixed size.
LEARNERS = 64
BLOCK = 1 << 16
# How far each token moves the weights of a text's mixing, and the part of the text so far in what they begin with.
RATE = 0.02
SO_FAR = 0.1
MODULUS = 5
# What a task needs of a piece of words for the counts of their prefixes.
PIECE = ("part", "words", "n", "before", "behind", "to_first", "to_last")


def word_lists(docs: DataFrame, scored: Column, learned: Column) -> DataFrame:
    """Batches of texts of ``docs`` (doc_id, text) as numbers, and the distinct words of each batch.

    Rows with a ``word`` say how often (``n``) the learned texts of the batch hold the word with that ``code``. The others hold the scored texts of
    a batch: their ids, bytes, numbers of words and codes, and as ``n`` how many texts are learned.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"batch long, code int, word string, n long, doc_ids array<{kind}>, n_bytes array<long>, n_words array<long>, codes binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            scored, learned = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("scored", "learned"))
            bounds, codes, distinct = words_of(texts, ascii_only=True)
            real = np.array([bool(w) for w in distinct], dtype=bool)
            # Codes without the empty word.
            codes = np.where(real, np.cumsum(real) - 1, -1)[codes] if len(distinct) else codes
            words = [w for w in distinct if w]
            rows = np.repeat(np.arange(len(texts)), np.diff(bounds))[codes >= 0]
            codes = codes[codes >= 0]
            times = np.bincount(codes[learned[rows]], minlength=len(words))
            n = len(words)
            yield _record(batch=np.full(n, number), code=np.arange(n, dtype=np.int32), word=words, n=times, schema=(ids.type, n))
            bytes_of = np.array([len(t) if t else 0 for t in texts.cast(pa.binary()).to_pylist()], dtype=np.int64)
            per_text = np.bincount(rows, minlength=len(texts))
            blob = pa.compress(codes[scored[rows]].astype(np.int32).tobytes(), "zstd", asbytes=True)
            yield _record(
                batch=np.array([number]),
                n=np.array([learned.sum()]),
                doc_ids=[ids.filter(pa.array(scored)).to_pylist()],
                n_bytes=[bytes_of[scored]],
                n_words=[per_text[scored]],
                codes=[blob],
                schema=(ids.type, 1),
            )
            number += 1

    rows = docs.select("doc_id", "text", scored.alias("scored"), learned.alias("learned"))
    return rows.mapInArrow(by_task(run), schema)


def _record(schema: tuple[pa.DataType, int], **columns) -> pa.RecordBatch:
    """A batch of :func:`word_lists`; columns not given are NULL."""
    id_type, n = schema
    kinds = {
        "batch": pa.int64(),
        "code": pa.int32(),
        "word": pa.string(),
        "n": pa.int64(),
        "doc_ids": pa.list_(id_type),
        "n_bytes": pa.list_(pa.int64()),
        "n_words": pa.list_(pa.int64()),
        "codes": pa.binary(),
    }
    return pa.RecordBatch.from_pydict(
        {name: pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in kinds.items()}
    )


@dataclass
class Vocabulary:
    """Totals over the training texts."""

    texts: int
    tokens: int
    distinct: int
    once: int


def vocabulary(words: DataFrame, texts: int) -> Vocabulary:
    """``words`` holds pieces of all words and the end, which counts as a token and never as one seen once."""
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct", "once")]).first()
    return Vocabulary(texts, *sums)


def train_bits(words: DataFrame, borders: Broadcast) -> bits.Model:
    """Bit counts over all words of the pieces ``words``, mixing weights and the refining table.

    Counts are those that a pass over all texts leaves. The weights learn online, a step per bit of each word, in tasks that begin
    alike; what they end with is averaged.
    """
    spark = words.sparkSession
    few = words.coalesce(LEARNERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = bits.BitCounter(None)
        for batch in batches:
            for seen, times in prefixes.plain(batch):
                counter.add(seen, times)
        for b in range(-(-bits.HASHED_SLOTS // BLOCK)):
            part = counter.counts[b * BLOCK : (b + 1) * BLOCK]
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "counts": [part.astype(np.float32).tobytes()]})

    def add(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.float32) for x in group["counts"].to_pylist()]
        return pa.table({"block": group["block"][:1], "counts": [np.sum(parts, axis=0, dtype=np.float32).tobytes()]})

    schema = "block int, counts binary"
    counted = few.select("words", "n").mapInArrow(by_task(count), schema).groupBy("block").applyInArrow(add, schema).toArrow()
    total = np.zeros((bits.HASHED_SLOTS, 2), dtype=np.float32)
    for batch in counted.to_batches(max_chunksize=1):
        b, data = batch["block"][0].as_py(), batch["counts"][0].as_buffer()
        total[b * BLOCK : (b + 1) * BLOCK] = np.frombuffer(data, np.float32).reshape(-1, 2)
    del counted
    model = bits.Model(total, None)
    everything = spark.sparkContext.broadcast(total)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = bits.Model(everything.value, None), bits.Sums()
        for batch in batches:
            for block in prefixes.blocks(batch, borders):
                seen = np.flatnonzero(block.n)
                if len(seen):
                    # Pieces are in the order of the alphabet.
                    block = block.picked(np.random.default_rng(len(seen)).permutation(seen))
                    own.learn(block.words, block.n, sums, block.followed)
        weighted = own.weights * sums.mass[:, None]
        numbers = np.concatenate([weighted.ravel(), sums.mass, sums.followed.ravel()])
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array(np.arange(len(numbers)), pa.int32()), "number": pa.array(numbers)}
        )

    # In an order that doesn't follow how the rows were spread, and is none of the alphabet.
    ordered = few.select(*PIECE).sortWithinPartitions(F.xxhash64("words"), "words")
    learned = ordered.mapInArrow(by_task(learn), "place int, number double").groupBy("place").agg(F.sum("number").alias("number"))
    numbers = np.zeros(model.weights.size + bits.GATES + 2 * bits.CONFIDENCES * bits.BUCKETS)
    for place, number in learned.collect():
        numbers[place] = number
    weighted, mass, followed = np.split(numbers, [model.weights.size, model.weights.size + bits.GATES])
    seen = mass > 0
    model.weights[seen] = (weighted.reshape(model.weights.shape)[seen] / mass[seen][:, None]).astype(np.float32)
    model.refine = bits.refining(followed.reshape(2, bits.CONFIDENCES, bits.BUCKETS))
    everything.destroy()
    return model.prepared()


def spellings(words: DataFrame, borders: Broadcast, model: bits.Model) -> DataFrame:
    """The words (word, n) of the pieces ``words`` with the log2 probability of spelling each."""
    sent = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in prefixes.blocks(batch, borders):
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(block.words, pa.binary()).cast(pa.string()),
                        "n": pa.array(block.n),
                        "spelled": pa.array(sent.value.log2(block.words, block.followed)),
                    }
                )

    return words.select(*PIECE).mapInArrow(by_task(run), "word string, n long, spelled double")


@dataclass
class Scorer:
    """What scoring needs besides the words of a batch."""

    texts: int
    tokens: int
    distinct: int
    once: int
    spelled_end: float

    @property
    def start(self) -> np.ndarray:
        """Weights that a text begins with: words are new as often as training tokens are words seen once."""
        new = self.once / self.tokens if self.once else 1 / 3
        return np.array([[new], [(1 - new) * (1 - SO_FAR)], [(1 - new) * SO_FAR]])

    def score(self, n_words: np.ndarray, codes: np.ndarray, counts: np.ndarray, spelled: np.ndarray):
        """Per text: tokens, log10 probability, that of the base, known tokens.

        ``codes`` are the texts' words one after the other, ``counts`` and ``spelled`` what is known of them by code.
        """
        n = len(n_words)
        rows = np.repeat(np.arange(n, dtype=np.int32), n_words)
        # The end of each text comes behind its words, with a number of its own.
        end, behind = len(counts), np.cumsum(n_words)
        codes, rows = np.insert(codes, behind, end), np.insert(rows, behind, np.arange(n))
        counts, spelled = np.append(counts, self.texts), np.append(spelled, self.spelled_end)
        per_text = np.bincount(rows, minlength=n)
        base = np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))
        base = np.bincount(rows, weights=base[codes], minlength=n)
        held = np.bincount(rows, weights=(counts > 0)[codes], minlength=n)
        return per_text, self._mix(rows, codes, spelled, counts / max(self.tokens, 1), per_text), base, held

    def _mix(self, rows, codes, spelled, share, per_text) -> np.ndarray:
        """log10 probability of each text, mixing the three opinions token by token, all texts at once."""
        n, starts = len(per_text), spans(per_text)
        place = np.arange(len(rows), dtype=np.int32) - starts[rows].astype(np.int32)
        # How often the token was in the text before.
        keys = rows.astype(np.int64) * (len(spelled) + 1) + codes
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        before = np.empty(len(keys), dtype=np.int32)
        before[order] = np.arange(len(keys)) - np.repeat(begins, np.diff(np.append(begins, len(keys))))
        del order, keys
        opinions = np.empty((3, len(rows)), dtype=np.float32)
        with np.errstate(divide="ignore"):
            opinions[0], opinions[1] = spelled[codes], np.log2(share)[codes]
            np.log2(before / np.maximum(place, 1), out=opinions[2], casting="unsafe")
        top = opinions.max(axis=0)
        opinions -= top
        np.exp2(opinions, out=opinions)
        longest_first = np.argsort(-per_text, kind="stable")
        lengths, firsts = per_text[longest_first], starts[longest_first]
        weights, total = np.repeat(self.start, n, axis=1), np.zeros(n)
        active = n
        for t in range(int(lengths[0]) if n else 0):
            while lengths[active - 1] <= t:
                active -= 1
            at = firsts[:active] + t
            parts = weights[:, :active] * opinions[:, at]
            p = parts.sum(axis=0)
            total[:active] += np.log2(p) + top[at]
            # A step towards what each opinion had to do with this token: a new word says little about the next one.
            weights[:, :active] *= 1 - RATE
            weights[:, :active] += RATE * parts / p
        out = np.zeros(n)
        out[longest_first] = total * np.log10(2)
        return out


def scored(docs: DataFrame, training: DataFrame | Column) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) by a model of the texts of ``training``, or of the rows of ``docs`` where it is true.

    Returns doc_id, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.
    """
    spark = docs.sparkSession
    ready(spark, times=2)
    kind = docs.schema["doc_id"].dataType.simpleString()
    flags = [F.lit(True), F.coalesce(training, F.lit(False)) if isinstance(training, Column) else F.lit(False)]
    rows = docs.select("doc_id", "text", *[f.alias(c) for f, c in zip(flags, ("scored", "learned"), strict=True)])
    if isinstance(training, DataFrame):
        rows = rows.union(training.select(F.lit(None).cast(kind), "text", F.lit(False), F.lit(True)))
    lists = materialised(word_lists(rows, F.col("scored"), F.col("learned")), "lm-lists", "zstd")
    words, texts = lists.where(F.col("word").isNotNull()), lists.where(F.col("word").isNull())
    n_texts = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    end = spark.range(1).select(F.lit("").alias("word"), F.lit(n_texts).cast("long").alias("n"))
    counts = words.groupBy("word").agg(F.sum("n").alias("n")).union(end)
    pieces = materialised(prefixes.pieces(counts), "lm-words", "zstd")
    known = vocabulary(pieces, n_texts)
    borders = spark.sparkContext.broadcast(prefixes.borders(pieces))
    model = train_bits(pieces, borders)
    spelled_end = spellings(pieces.where("holds_end"), borders, model).where("word = ''").first()["spelled"]
    scorer = Scorer(known.texts, known.tokens, known.distinct, known.once, spelled_end)
    spelled = spellings(pieces, borders, model)
    values = words.select("word", "batch", "code").join(spelled, "word").select(F.col("batch").alias("of"), "code", "n", "spelled")

    def run(batch: pa.Table, known_words: pa.Table) -> pa.Table:
        code = known_words["code"].to_numpy()
        counts, spelled = np.zeros(len(code), dtype=np.int64), np.zeros(len(code))
        counts[code], spelled[code] = known_words["n"].to_numpy(), known_words["spelled"].to_numpy()
        n_words = batch["n_words"].combine_chunks().flatten().to_numpy()
        # A batch of training texts alone has words and no texts to score.
        blob = batch["codes"].to_pylist()
        codes = pa.decompress(blob[0], 4 * int(n_words.sum()), "zstd", asbytes=True) if blob else b""
        per_text, score, base, held = scorer.score(n_words, np.frombuffer(codes, np.int32), counts, spelled)
        out = {
            "doc_id": batch["doc_ids"].combine_chunks().flatten(),
            "n_tokens": pa.array(per_text, pa.int64()),
            "n_bytes": batch["n_bytes"].combine_chunks().flatten(),
            "score": pa.array(score, pa.float64()),
            "base": pa.array(base, pa.float64()),
            "known": pa.array(held.astype(np.int64)),
        }
        give_back()
        return pa.table(out)

    both = (
        texts.where(F.size("doc_ids") > 0)
        .select("batch", "doc_ids", "n_bytes", "n_words", "codes")
        .groupBy("batch")
        .cogroup(values.groupBy("of"))
        .applyInArrow(run, f"doc_id {kind}, n_tokens long, n_bytes long, score double, base double, known long")
    )
    return both.select(
        "doc_id",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        (-F.col("score") / float(np.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the whole table ``documents`` by a model of four fifths of its ids."""
    docs = load(spark, sf_dir, "documents")
    apart = held_out(F.col("doc_id"), MODULUS)
    return scored(docs, ~apart).select(
        "doc_id",
        apart.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "bits_per_byte",
    )
