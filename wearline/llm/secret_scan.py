"""Secret scans with a random forest against false positives, in DataFrame functions only.

Candidates are private key blocks, web tokens, keys in a provider's format, user:password@host of an address, whatever is
assigned to a sensitive name or follows Bearer or Basic, and other runs of key characters with a digit among them, the
first of these that begins at a place. Each is described by its length, its changes between
kinds of characters, how much of it is made of words that the corpus uses, the path it is assigned to (the name before
``=`` or ``:`` and quotes) and the words next to it. A random forest, trained on labelled findings, says which
candidates are secrets. Labels come with the caller; without them, formats and assignments that are secret or
harmless beyond doubt are taken as labels, and the forest alone judges the others. What has a provider's format is a
secret whatever the forest says. The dictionary counts the words of all documents; the forest is fitted on a bounded
sample of findings, in which rules and labels that are rare have as many rows as frequent ones, as far as there are.

NULL text counts as empty and has no findings. Where labels are all of one kind there is nothing to train, and the label
rules themselves decide; what they leave open is then no secret. Repeated rows have their findings each; a NULL id stays NULL. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import fresh, load, materialised, row_key

BEFORE, AFTER = 48, 32
REDACTED = "[SECRET]"
# Words that this many places of the corpus hold are dictionary words.
WORD_USES = 20
SAMPLE = 20_000
TREES, DEPTH, SEED = 40, 8, 7
# Formats that providers give their keys. Fixed values.
PROVIDERS = r"(?:A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{36,}|AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])|sk_live_[0-9A-Za-z]{24,}|xox[abprs]-[0-9A-Za-z-]{10,})"
BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\\\s:,-]{0,65536}?-----END [A-Z ]{0,40}PRIVATE KEY-----"
FORMATS = rf"^(?:{PROVIDERS}|{BLOCK})$"
SENSITIVE = r"(?i)(pass|pwd|secret|token|key|auth|cred|private)"
HARMLESS = r"(?i)(example|sample|dummy|test|placeholder|sha1|sha256|md5|commit|digest|checksum|uuid)"
# What stands before an assigned value: the name, perhaps quotes, = or :, perhaps quotes or a scheme of authorization.
_NAME = r"(?i:pass|pwd|secret|token|key|auth|cred|private)[A-Za-z0-9_.-]{0,24}[\"']?[ \t]{0,3}[=:][ \t]{0,3}"
_SCHEME = r"(?i:bearer|basic)[ \t]"
CANDIDATE = "|".join(
    [
        BLOCK,
        r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}(?:\.[A-Za-z0-9_-]*)?",
        # The short tests of what stands before spare the long ones at most places.
        rf"(?<=[\"'])(?<=[=:][ \t]{{0,3}}[\"'])(?<={_NAME}[\"'])(?!{_SCHEME})[^\"'\r\n]+(?=[\"'])",
        rf"(?<=[=: \t])(?<=[=:][ \t]{{0,3}})(?<={_NAME})(?!{_SCHEME})[^\s\"',;]+",
        rf"(?<=[ \t])(?<={_SCHEME})(?=[^\s\"',;]*[0-9])[^\s\"',;]+",
        r"(?<=://)[^\s:/@\"']*:[^\s@\"']+@[A-Za-z0-9._-]+",
        rf"(?<![A-Za-z0-9]){PROVIDERS}",
        # A run ends where a provider's key begins, and may begin behind one.
        r"(?:(?<![A-Za-z0-9+/_-])|\G)(?=[A-Za-z+/_-]*[0-9])(?!//[^\s:/@\"']*:[^\s@\"']+@)"
        rf"(?![A-Za-z0-9+/_-]{{0,11}}(?<![A-Za-z0-9]){PROVIDERS})"
        rf"[A-Za-z0-9+/_-]{{12,}}?(?=(?<![A-Za-z0-9]){PROVIDERS}|(?![A-Za-z0-9+/_-]))",
    ]
)
# Rules whose findings are secrets; those of all others are harmless.
SECRET_RULES = ("format", "assigned")
# Share of a candidate that dictionary words make up beyond which it is harmless.
DICTIONARY = 0.8


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate of ``docs`` (doc_id, text).

    Returns doc_id, number, start and length (in characters), candidate, the text before and after it, and _key.
    """
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
        .withColumn("_found", F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0)))
        .where(F.size("_found") > 0)
        .select(
            "doc_id",
            "_found",
            # What stands before, between and after the candidates: always one more than those.
            F.split("_text", CANDIDATE, -1).alias("_around"),
            row_key("doc_id", "_text").alias("_key"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    each = F.transform(
        "_found",
        lambda c, i: F.struct(
            i.alias("number"),
            c.alias("candidate"),
            F.right(F.get("_around", i), F.lit(BEFORE)).alias("before"),
            F.left(F.get("_around", i + 1), F.lit(AFTER)).alias("after"),
            (F.char_length(F.get("_around", i)) + F.char_length(c)).alias("_upto"),
        ),
    )
    ordered = Window.partitionBy("_row").orderBy("number")
    length = F.char_length("candidate")
    return rows.select("doc_id", "_key", "_row", F.inline(each)).select(
        "doc_id",
        "number",
        (F.sum("_upto").over(ordered) - length).alias("start"),
        length.alias("length"),
        "candidate",
        "before",
        "after",
        "_key",
    )


def dictionary(docs: DataFrame) -> DataFrame:
    """Words of three letters or more (a-z) that the documents use often."""
    runs = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    counts = docs.select(F.explode(runs).alias("word")).groupBy("word").count()
    return counts.where(F.col("count") >= WORD_USES).select("word")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` (see :func:`candidates`) with the path of each candidate and one column ``f_...`` per feature."""
    found = materialised(found.withColumn("_id", F.monotonically_increasing_id()), "secret-candidates")
    runs = F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), F.lit(0))
    covered = (
        found.select("_id", F.explode(runs).alias("word"))
        .join(words, "word")
        .groupBy("_id")
        .agg(F.sum(F.char_length("word")).alias("_covered"))
    )
    c, path, length = F.col("candidate"), F.col("path"), F.col("length")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    near = F.concat_ws(" ", "before", "after")

    def share(others: str) -> Column:
        return F.char_length(F.regexp_replace(c, others, "")) / length

    def changes(pattern: str) -> Column:
        return F.size(F.regexp_extract_all("_kinds", F.lit(pattern), F.lit(0))) / length

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    assigned = r"([A-Za-z_][A-Za-z0-9_.-]*)[\"']?\s*[=:]\s*[\"']?(?:(?i:bearer|basic)\s)?$"
    return (
        found.join(covered, "_id", "left")
        .withColumn("path", F.regexp_extract("before", assigned, 1))
        .withColumn("_kinds", kinds)
        .withColumns(
            {
                "f_length": length.cast("double"),
                "f_runs": F.char_length(F.regexp_replace("_kinds", r"(.)\1+", "$1")) / length,
                "f_to_digit": changes("[Aa](?=0)"),
                "f_to_letter": changes("0(?=[Aa])"),
                "f_to_lower": changes("A(?=a)"),
                "f_upper": share("[^A-Z]"),
                "f_digits": share("[^0-9]"),
                "f_hex": share("[^0-9a-f]"),
                "f_marks": share("[A-Za-z0-9]"),
                "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / length,
                "f_dictionary": F.coalesce("_covered", F.lit(0)) / length,
                "f_format": flag(c.rlike(FORMATS)),
                "f_path": flag(path != ""),
                "f_path_sensitive": flag(path.rlike(SENSITIVE)),
                "f_path_harmless": flag(path.rlike(HARMLESS)),
                "f_quoted": flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")),
                "f_near_sensitive": flag(near.rlike(SENSITIVE)),
                "f_near_harmless": flag(near.rlike(HARMLESS)),
                "f_near_digits": flag(near.rlike("[0-9]{3}")),
            }
        )
        .drop("_kinds", "_covered")
    )


def rule() -> Column:
    """What settles a finding (see :func:`features`) beyond doubt, or NULL: the first that holds, by name."""
    path, c = F.col("path"), F.col("candidate")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]") & ~c.rlike(HARMLESS)
    holds = {
        "format": c.rlike(FORMATS),
        "harmless path": path.rlike(HARMLESS),
        "digits": c.rlike("^[0-9]+$"),
        "assigned": path.rlike(SENSITIVE) & mixed,
        "harmless word": c.rlike(HARMLESS) & ~path.rlike(SENSITIVE),
        "dictionary": (F.col("f_dictionary") >= DICTIONARY) & ~path.rlike(SENSITIVE),
    }
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in holds.items()])


def rule_label() -> Column:
    """1 for findings that are secret beyond doubt, 0 for harmless ones, NULL for all others."""
    return F.when(rule().isNotNull(), rule().isin(*SECRET_RULES).cast("int"))


def stratified(marked: DataFrame, size: int) -> DataFrame:
    """About ``size`` rows of ``marked``, chosen by a hash, as evenly from each rule and label as their numbers allow."""
    strata = marked.groupBy("label", "_rule").count().orderBy("count", "label", "_rule").collect()
    share, left = F.lit(0.0), size
    for i, s in enumerate(strata):
        taken = min(s["count"], left // (len(strata) - i))
        left -= taken
        here = F.col("label").eqNullSafe(s["label"]) & F.col("_rule").eqNullSafe(s["_rule"])
        share = F.when(here, F.lit(taken / s["count"])).otherwise(share)
    chosen = F.xxhash64("_key", "number")
    # The limit only matters where one row is repeated very often.
    return marked.where(F.pmod(chosen, F.lit(1 << 30)) < share * (1 << 30)).orderBy(chosen, "_key", "number").limit(2 * size)


def scan(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Every candidate of ``docs`` with its probability of being a secret, and the verdict.

    ``labels`` holds labelled findings (doc_id, start, label 0/1). Returns the columns of :func:`candidates`, path,
    probability and is_secret.
    """
    # Stored: the features are read for the sample, the training and the scores.
    described = materialised(features(candidates(docs), dictionary(docs)), "secret-features")
    if labels is None:
        marked = described.withColumn("label", rule_label())
    else:
        marked = described.join(labels.select("doc_id", "start", F.col("label").cast("int")), ["doc_id", "start"])
    marked = marked.where(F.col("label").isNotNull()).withColumn("_rule", rule())
    names = [c for c in described.columns if c.startswith("f_")]
    sample = materialised(stratified(marked, SAMPLE).select("label", *names), "secret-sample")
    kept = ["doc_id", "number", "start", "length", "candidate", "before", "after", "path", "_key"]
    if sample.select("label").distinct().count() < 2:
        settled = F.coalesce(rule_label(), F.lit(0))
        return described.select(*kept, settled.cast("double").alias("probability"), (settled > 0).alias("is_secret"))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="_vector", probabilityCol="_p", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="_vector"), forest]).fit(sample.coalesce(1))
    judged = F.when(F.col("f_format") > 0, 1.0).otherwise(vector_to_array("_p")[1])
    scores = model.transform(described).withColumn("probability", judged)
    return scores.select(*kept, "probability", (F.col("probability") >= 0.5).alias("is_secret"))


def redacted(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``docs`` with each secret replaced by a mark; rows and other columns as given."""
    key, found, secrets = fresh(docs, "_key", "_verdicts", "_replaced")
    verdicts = scan(docs, labels).groupBy(F.col("_key").alias(key)).agg(
        F.max("is_secret").alias("_any"), F.array_sort(F.collect_set(F.struct("number", "is_secret"))).alias(found)
    )
    text = F.col("text")
    replaced = F.transform(
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
        lambda c, i: F.when(F.get(found, i)["is_secret"], F.lit(REDACTED)).otherwise(c),
    )
    between = F.split(text, CANDIDATE, -1)
    whole = F.array_join(F.flatten(F.transform(between, lambda b, i: F.array(b, F.get(secrets, i)))), "")
    return (
        docs.withColumn(key, row_key())
        .join(verdicts.where("_any").drop("_any"), key, "left")
        .withColumn(secrets, F.when(F.col(found).isNotNull(), replaced))
        .withColumn("text", F.when(F.col(found).isNotNull(), whole).otherwise(text))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings in the whole table ``documents`` with their verdicts; the findings themselves as hashes."""
    found = scan(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "start", "length", "path", F.sha2("candidate", 256).alias("sha256"), "probability", "is_secret"
    )
