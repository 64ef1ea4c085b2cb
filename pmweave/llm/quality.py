"""Quality rules with cross-document line frequency, in column expressions only.

Lines are normalised and hashed, the distinct documents of a host (source) that hold each are
counted, lines of too many documents are removed, and a document that loses most of its words is
rejected. Every text is read once: its figures and line hashes are staged, and what is counted,
joined and summed afterwards are hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.session import stage

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_SHARE = 0.5
MAX_DOCUMENTS = 20


def _covered(hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more, from the windows' hashes in order."""
    at = F.filter(F.transform("sorted", lambda x, i: F.when(
        (x["hash"] == F.get("sorted", i - 1)["hash"]) | (x["hash"] == F.get("sorted", i + 1)["hash"]), x["at"])), lambda p: p.isNotNull())
    return at


def text_figures(docs: DataFrame) -> DataFrame:
    """``docs`` (one of its columns ``text``) with the base figures of the whole text; null is no words."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    windows = F.when(F.col("n_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).otherwise(F.array().cast("array<long>"))
    rows = rows.withColumn("windows", windows)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.when(repeats, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))))
    rows = rows.withColumn("sorted", ordered)
    rows = rows.withColumn("at", F.sort_array(_covered(F.col("sorted"))))
    steps = F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - p, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    rows = rows.withColumns({"n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"), "lines": lines})
    return rows.withColumns({
        "word_chars": F.length(F.regexp_replace(text, BLANKS, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    }).drop("words", "windows", "sorted", "at")


def _line_hash(line: Column) -> Column:
    """Of the line in lower case with single blanks."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, BLANKS, " "))))


def judge(docs: DataFrame, min_documents: int = MAX_DOCUMENTS, max_lost: float = MAX_LOST_SHARE) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, the base figures, ``n_removed_words`` and ``kept``.

    A line is normalised to lower case with single blanks. It is over the limit of its host if more
    than ``min_documents`` of the host's documents hold it, however large the host. Documents with the
    same text count as one, and the document of the least id that holds a line keeps it, so a
    group of copies never vanishes as a whole. A document is kept if its base figures pass and lines
    over the limit hold at most ``max_lost`` of its words. Null and empty texts have no words and fail;
    a null source is a host of its own, a null id never keeps a line; rows that repeat are judged alike.
    """
    return _judged(docs, min_documents, max_lost).drop("removed")


def _judged(docs: DataFrame, min_documents: int = MAX_DOCUMENTS, max_lost: float = MAX_LOST_SHARE) -> DataFrame:
    """``judge`` with ``removed``, the hashes of the lines that a document loses; null where it loses none."""
    hashed = F.transform("lines", lambda line: F.struct(_line_hash(line).alias("hash"), F.regexp_count(line, F.lit(WORD)).alias("words")))
    figures = text_figures(docs.select("doc_id", "source", "text"))
    columns = ["doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = stage(figures.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("text_hash"), hashed.alias("lines"), *columns), "figures")
    texts = rows.groupBy("source", "text_hash").agg(F.min("doc_id").alias("doc_id"), F.first("lines").alias("lines"))
    held = texts.select("source", "doc_id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    counted = held.groupBy("source", "hash").agg(F.count("*").alias("holders"), F.min("doc_id").alias("keeper")).where(F.col("holders") > min_documents)
    over = stage(counted.select("source", "hash", "keeper"), "frequent")
    lines = rows.select("row", "source", "doc_id", F.explode("lines").alias("line")).select("row", "source", "doc_id", "line.hash", "line.words")
    lost = lines.alias("l").join(over.alias("o"), F.expr("l.source <=> o.source and l.hash = o.hash and not (l.doc_id <=> o.keeper)"))
    lost = lost.groupBy("row").agg(F.sum("words").cast("long").alias("n_removed_words"), F.collect_set("l.hash").alias("removed"))
    found = rows.join(lost, "row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
    kept = ~F.col("base_failed") & (F.col("n_removed_words") <= max_lost * F.col("n_words"))
    return found.select("doc_id", "source", "text_hash", *columns[2:], "n_removed_words", kept.alias("kept"), "removed")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, their ``text`` without the lines over the limit.

    A document that keeps a line for all keeps it here too. Blank lines and the order stay, and ``n_chars``, where
    ``docs`` has it, follows the text. What loses no line comes back as it was.
    """
    changed = _judged(docs, **options).where("not kept or removed is not null").groupBy("doc_id", "source", "text_hash")
    changed = changed.agg(F.min("kept").alias("kept"), F.first("removed", ignorenulls=True).alias("removed")).alias("r")
    same = F.expr("d.doc_id <=> r.doc_id and d.source <=> r.source and xxhash64(d.text) = r.text_hash")
    found = docs.alias("d").join(changed, same, "left").where(F.coalesce("r.kept", F.lit(True)))
    lines = F.filter(F.split("d.text", "\n", -1), lambda line: ~F.array_contains("r.removed", _line_hash(line)))
    text = F.when(F.col("r.removed").isNull(), F.col("d.text")).otherwise(F.array_join(lines, "\n"))
    shorter = "_" * (1 + max(map(len, docs.columns)))  # longer than any name, so it clashes with none
    found = found.select(*[(text if c == "text" else F.col(f"d.`{c}`")).alias(c) for c in docs.columns], F.col("r.removed").isNotNull().alias(shorter))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(shorter), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", n_chars)
    return found.select(*docs.columns)
