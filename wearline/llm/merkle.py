"""Merkle trees over the paragraphs and sections of documents, in SQL functions only.

A paragraph is a run of text up to and including its stops and line ends, at most ``PARAGRAPH`` characters before
them; paragraphs give back the text when put together. A paragraph whose hash begins with a zero ends a section, so
sections move along with their text when something is inserted before them. A section's hash is that of its
paragraphs' hashes, and the root is the hash of the sections' hashes: equal texts have equal roots. Two trees are
compared from the top: what lies under equal hashes is equal, and the rest locates the edits. Their likeness is the
Dice coefficient of their distinct paragraphs, 1 for two empty texts.

NULL text counts as empty: no paragraphs, no sections. A NULL doc_id comes before all others in the order of
documents; documents with the same id follow each other by text. Ids are numbers: their order is cut at percentiles. Repeated rows stay rows. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import load

PARAGRAPH = 240
# Rows per range of ids that is put in order together, and the most ranges there are.
ORDERED = 2048
RANGES = 65_536
HASH = 32


def _hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, HASH)


def paragraphs(text: Column) -> Column:
    """Hashes of the paragraphs of a text, in order."""
    cut = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^\n.]{{1,{PARAGRAPH}}}[.\n]*|[.\n]+"), F.lit(0))
    return F.transform(cut, _hash)


def sections(leaves: Column) -> Column:
    """The paragraph hashes of each section as one string, in order."""
    marked = F.transform(leaves, lambda h: F.when(h.startswith("0"), F.concat(h, F.lit("\n"))).otherwise(h))
    return F.filter(F.split(F.array_join(marked, ""), "\n"), lambda s: s != "")


def root(leaves: Column) -> Column:
    """The root's hash."""
    return F.sha2(F.array_join(F.transform(sections(leaves), _hash), ""), 256)


def likeness(left: Column, right: Column) -> Column:
    """Of two texts by the hashes of their paragraphs."""
    shared = F.size(F.array_intersect(left, right))
    both = F.size(F.array_distinct(left)) + F.size(F.array_distinct(right))
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * shared / both)


def trees(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (the root), sections (hash and number of paragraphs) and paragraphs (hashes)."""
    leaves = docs.select("doc_id", paragraphs(F.col("text")).alias("paragraphs"))
    held = F.transform(
        sections(F.col("paragraphs")),
        lambda s: F.struct(_hash(s).alias("hash"), (F.length(s) / HASH).cast("int").alias("paragraphs")),
    )
    return leaves.select("doc_id", root(F.col("paragraphs")).alias("fingerprint"), held.alias("sections"), "paragraphs")


def edits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Where documents of ``old`` and ``new`` (see :func:`trees`) with the same id differ.

    Returns doc_id, section and paragraph (both from 0) of each paragraph of ``new`` that lies in a section the old
    tree does not have and that the old tree does not have either. Documents with equal roots end at the root.
    """
    pairs = new.alias("n").join(old.alias("o"), F.col("n.doc_id").eqNullSafe(F.col("o.doc_id")))
    differing = pairs.where(F.col("n.fingerprint") != F.col("o.fingerprint"))
    number = F.struct(F.lit(0).alias("first"), F.array().cast("array<struct<section:int,first:int,n:int,hash:string>>").alias("all"))
    placed = F.aggregate(
        F.col("n.sections"),
        number,
        lambda acc, s: F.struct(
            (acc["first"] + s["paragraphs"]).alias("first"),
            F.concat(
                acc["all"],
                F.array(
                    F.struct(
                        F.size(acc["all"]).alias("section"),
                        acc["first"].alias("first"),
                        s["paragraphs"].alias("n"),
                        s["hash"].alias("hash"),
                    )
                ),
            ).alias("all"),
        ),
        lambda acc: acc["all"],
    )
    new_sections = differing.select(
        F.col("n.doc_id").alias("doc_id"),
        F.col("n.paragraphs").alias("_new"),
        F.col("o.paragraphs").alias("_old"),
        F.transform("o.sections", lambda s: s["hash"]).alias("_old_sections"),
        F.explode(placed).alias("_s"),
    ).where(~F.array_contains("_old_sections", F.col("_s.hash")))
    inside = F.sequence(F.col("_s.first"), F.col("_s.first") + F.col("_s.n") - 1)
    return (
        new_sections.select("doc_id", "_new", "_old", F.col("_s.section").alias("section"), F.explode(inside).alias("paragraph"))
        .where(~F.array_contains("_old", F.element_at("_new", F.col("paragraph") + 1)))
        .select("doc_id", "section", "paragraph")
    )


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, paragraphs, and text and paragraphs of the next document by ascending id; the first follows the last.

    Documents are cut into ranges of ids of bounded size, each ordered by itself. The first documents of a range are
    also sent to the range before it, which is all that a range has to know of the others.
    """
    n, nulls = docs.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull())).first()
    ranges = max(1, min(RANGES, n // ORDERED))
    shares = [i / ranges for i in range(ranges)]
    # Values of the column itself, one per range.
    found = docs.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0] or []
    lowest = docs.agg(F.min("doc_id")).first()[0]
    bounds = sorted({lowest, *found} - {None})
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    ident = F.col("doc_id")

    def literal(values: list) -> Column:
        return F.array(*[F.lit(v) for v in values])

    if bounds:
        upper = F.size(F.filter(literal([g[0] for g in groups]), lambda b: b <= ident))
        inside = F.element_at(F.array(*[literal(g) for g in groups]), F.greatest(upper, F.lit(1)))
        place = (upper - 1) * width + F.size(F.filter(inside, lambda b: b <= ident)) - 1
        mine = F.when(ident.isNull(), 0).otherwise(place)
        starts = F.coalesce(F.array_contains(inside, ident), F.lit(False))
    else:
        mine, starts = F.lit(0), F.lit(False)
    last = max(len(bounds), 1) - 1
    # The very first rows follow the last ones.
    very_first = ident.isNull() if nulls else ident == F.lit(lowest)
    guest = F.when(very_first, F.lit(last)).when(starts & (F.col("_range") > 0), F.col("_range") - 1)
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_range", mine.cast("int"))
        .withColumn("_guest", guest.cast("int"))
    )
    own = F.struct(F.col("_range").alias("_at"), F.lit(False).alias("_is_guest"))
    other = F.struct(F.col("_guest").alias("_at"), F.lit(True).alias("_is_guest"))
    sent = F.when(F.col("_guest").isNull(), F.array(own)).otherwise(F.array(own, other))
    ordered = Window.partitionBy("_at").orderBy("_is_guest", F.asc_nulls_first("doc_id"), "text")
    return (
        rows.select("doc_id", "text", F.inline(sent))
        .repartition("_at")
        .withColumn("paragraphs", paragraphs(F.col("text")))
        .withColumn("next_text", F.lead("text").over(ordered))
        .withColumn("next_paragraphs", F.lead("paragraphs").over(ordered))
        .where(~F.col("_is_guest"))
        .select("doc_id", "text", "paragraphs", "next_text", "next_paragraphs")
    )


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the whole table ``documents``, of its edited texts, and how alike they are."""
    chars, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), chars - half), F.substring(F.col("next_text"), F.lit(1), half))
    return (
        with_next(load(spark, sf_dir, "documents"))
        .withColumn("edited", edited)
        .withColumn("edited_paragraphs", paragraphs(F.col("edited")))
        .select(
            "doc_id",
            chars.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            root(F.col("paragraphs")).alias("fingerprint"),
            root(F.col("edited_paragraphs")).alias("edited_fingerprint"),
            likeness(F.col("paragraphs"), F.col("edited_paragraphs")).alias("near_edited"),
            likeness(F.col("paragraphs"), F.col("next_paragraphs")).alias("near_next"),
        )
    )


OP8_SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text
  FROM documents
  WINDOW w AS (ORDER BY doc_id)
), edited AS (
  SELECT *, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited FROM texts
), leaves AS (
  SELECT doc_id, text, edited,
         [left(sha256(p), {HASH}) FOR p IN regexp_extract_all(text, '[^\n.]{{1,{PARAGRAPH}}}[.\n]*|[.\n]+')] AS own,
         [left(sha256(p), {HASH}) FOR p IN regexp_extract_all(edited, '[^\n.]{{1,{PARAGRAPH}}}[.\n]*|[.\n]+')] AS changed,
         [left(sha256(p), {HASH}) FOR p IN regexp_extract_all(next_text, '[^\n.]{{1,{PARAGRAPH}}}[.\n]*|[.\n]+')] AS following
  FROM edited
), cut AS (
  SELECT *,
         string_split(array_to_string([CASE WHEN starts_with(h, '0') THEN h || chr(10) ELSE h END FOR h IN own], ''), chr(10)) AS a,
         string_split(array_to_string([CASE WHEN starts_with(h, '0') THEN h || chr(10) ELSE h END FOR h IN changed], ''), chr(10)) AS b
  FROM leaves
)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
       sha256(array_to_string([left(sha256(s), {HASH}) FOR s IN a IF s <> ''], '')) AS fingerprint,
       sha256(array_to_string([left(sha256(s), {HASH}) FOR s IN b IF s <> ''], '')) AS edited_fingerprint,
       CASE WHEN len(own) + len(changed) = 0 THEN 1.0::DOUBLE
            ELSE 2::DOUBLE * len(list_intersect(own, changed)) / (len(list_distinct(own)) + len(list_distinct(changed)))
       END AS near_edited,
       CASE WHEN len(own) + len(following) = 0 THEN 1.0::DOUBLE
            ELSE 2::DOUBLE * len(list_intersect(own, following)) / (len(list_distinct(own)) + len(list_distinct(following)))
       END AS near_next
FROM cut
"""
