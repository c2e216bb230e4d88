"""SimHash near-duplicates found with the general pigeonhole principle.

A text's fingerprint has the majority of each bit over the XXH64 hashes of its word shingles. Two fingerprints within
``max_bits`` of each other must, in at least one of ``m`` groups of bits, differ by at most that group's threshold,
as long as the thresholds sum to ``max_bits - m + 1`` (a threshold of -1 leaves the group out). Bits that go together
are put in one group, so a group's candidates can be estimated; a dynamic programme then gives each group the
threshold that makes the estimated number of probes and candidates smallest, and the best number of groups is taken.
Every candidate is verified. All counts are over all distinct fingerprints.

NULL text counts as empty; texts without words have fingerprint zero, linked like any other. Equal fingerprints are
one node, so copies are never paired. A NULL doc_id is larger than all others, and a group without any other has a
NULL component_id. Repeated rows stay rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import by_column, by_task, load, materialised, only, ready, row_key, utf8
from wearline.llm.graph import components
from wearline.session import broadcast_if_small

BITS = 64
SEED = 42
# Shingles whose bits are counted at a time.
AT_ONCE = 1 << 16
# A probe row passes through a shuffle, a candidate only through a join.
PROBE_COST = 4.0


def shingle_hashes(text: bytes, words_each: int) -> list[int]:
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    digest, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= words_each:
        return [digest(b" ".join(words), seed)] if words else []
    return [digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(words_each)), strict=False)]


def fingerprint(text: bytes, words_each: int) -> int:
    """As a signed 64-bit integer."""
    hashes = np.array(shingle_hashes(text, words_each), dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), AT_ONCE):
        octets = hashes[i : i + AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, words_each: int) -> Column:
    def compute(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, words_each) for t in utf8(column)], pa.int64())

    return by_column(compute, "long")(text)


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits in how many both are set."""

    def partial(batches):
        total = np.zeros((BITS, BITS))
        rows = 0
        for batch in batches:
            prints = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype="<i8")
            octets = prints.view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(octets, axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
            rows += len(prints)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array([-1, *i.tolist()], pa.int32()),
                "j": pa.array([-1, *j.tolist()], pa.int32()),
                "n": pa.array([rows, *total[i, j].astype(np.int64).tolist()], pa.int64()),
            }
        )

    # At most 64 x 64 + 1 rows reach the driver.
    rows = nodes.select("fp").mapInArrow(by_task(partial), "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    counts, n = np.zeros((BITS, BITS)), 0
    for i, j, k in rows.collect():
        if i < 0:
            n = k
        else:
            counts[i, j] = k
    return n, counts


def group_bits(n: int, counts: np.ndarray, groups: int) -> list[list[int]]:
    """Bits in groups of nearly equal size, each grown by the bit that goes best with those it holds."""
    p = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    strength = np.abs((counts / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, out = set(range(BITS)), []
    for left in range(groups, 0, -1):
        size = len(free) // left
        members = [max(sorted(free), key=lambda b: strength[b, sorted(free)].max())]
        free.remove(members[0])
        while len(members) < size:
            best = max(sorted(free), key=lambda b: strength[b, members].sum())
            members.append(best)
            free.remove(best)
        out.append(sorted(members))
    return out


def within(rates: np.ndarray, most: int) -> np.ndarray:
    """P(at most e of the bits differ) for e = 0..most, if bits differ independently at these rates."""
    exact = np.zeros(len(rates) + 1)
    exact[0] = 1
    for r in rates:
        exact[1:] = exact[1:] * (1 - r) + exact[:-1] * r
        exact[0] *= 1 - r
    return np.cumsum(exact)[: most + 1]


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds >= -1 with this sum and the least cost; ``costs[i][e]`` is that of threshold e in group i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for e in range(-1, len(options)):
                offer = (cost + (options[e] if e >= 0 else 0.0), [*chosen, e])
                if done + e not in following or offer < following[done + e]:
                    following[done + e] = offer
        best = following
    return best[total]


def signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def plan(nodes: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, those of -1 left out."""
    n, counts = bit_counts(nodes)
    layouts = {m: group_bits(n, counts, m) for m in range(min(2, max_bits + 1), max_bits + 2)}
    masks = {signed(bits): bits for groups in layouts.values() for bits in groups}
    # How often two fingerprints agree on a whole group, counted for every group.
    values = F.array(*[F.struct(F.lit(m).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for m in masks])
    shared = (
        nodes.select(F.inline(values))
        .groupBy("mask", "value")
        .count()
        .groupBy("mask")
        .agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs"))
        .collect()
    )
    agreeing = {r["mask"]: r["pairs"] for r in shared}
    p = np.diag(counts) / max(n, 1)
    rates = 2 * p * (1 - p)
    choices = []
    for groups in layouts.values():
        costs = []
        for bits in groups:
            chance = within(rates[bits], max_bits)
            pairs = agreeing.get(signed(bits), 0.0) * chance / max(chance[0], 1e-300)
            probes = np.cumsum([math.comb(len(bits), e) for e in range(max_bits + 1)]) * float(n)
            costs.append((pairs + PROBE_COST * probes).tolist())
        cost, thresholds = allocate(costs, max_bits - len(groups) + 1)
        choices.append((cost, [(b, t) for b, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(choices)[1]


def _probes(group: int, value: Column, flips: list[int]) -> Column:
    """All values to look up in a group: its own with each choice of flipped bits."""
    wanted = F.array(*[F.lit(x) for x in flips])
    return F.transform(wanted, lambda x: F.struct(F.lit(group).alias("g"), value.bitwiseXOR(x).alias("value")))


def links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints in ``nodes`` that differ by at most ``max_bits`` bits."""
    groups = plan(nodes, max_bits)
    fp = F.col("fp")
    indexed, probes, found_before = [], [], []
    for g, (bits, threshold) in enumerate(groups):
        mask = F.lit(signed(bits))
        flips = [signed(list(c)) for e in range(threshold + 1) for c in itertools.combinations(bits, e)]
        indexed.append(F.struct(F.lit(g).alias("g"), fp.bitwiseAND(mask).alias("value")))
        probes.append(_probes(g, fp.bitwiseAND(mask), flips))
    index = nodes.select(fp.alias("b"), F.inline(F.array(*indexed)))
    probing = nodes.select(fp.alias("a"), F.inline(F.concat(*probes)))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= max_bits)
    for g, (bits, threshold) in enumerate(groups):
        # A pair that an earlier group finds is not given again.
        earlier = F.bit_count(differ.bitwiseAND(F.lit(signed(bits)))) <= threshold
        found_before.append((F.col("g") > g) & earlier)
    again = F.lit(False)
    for condition in found_before:
        again = again | condition
    return probing.join(index, ["g", "value"]).where(near & ~again).select("a", "b")


def near_groups(docs: DataFrame, *, words_each: int = 3, max_bits: int = 3) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its group of linked fingerprints.

    Returns doc_id, fingerprint (hex), component_id, stays (true for one row of a group) and _key (see ``row_key``).
    """
    ready(docs.sparkSession)
    marks = materialised(
        docs.select("doc_id", fingerprint_column(F.col("text"), words_each).alias("fp"), row_key().alias("_key")),
        "simhash-marks",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_key")))
    nodes = materialised(marks.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialised(rooted.select("fp", F.coalesce("root", "fp").alias("root"), "first"), "simhash-roots")
    lowest = materialised(rooted.groupBy("root").agg(F.min("first").alias("lowest")), "simhash-lowest")
    groups = materialised(rooted.join(lowest, "root").select("fp", "lowest"), "simhash-groups")
    return marks.join(broadcast_if_small(groups), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("lowest.doc_id").alias("component_id"),
        (F.col("_key") == F.col("lowest._key")).alias("stays"),
        "_key",
    )


def kept_documents(docs: DataFrame, **options: int) -> DataFrame:
    """One document of each group, the one with the smallest id; columns as given."""
    return only(docs, near_groups(docs, **options).where("stays"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicates over the whole table ``documents``."""
    return near_groups(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
