"""Quality rules with the frequency of lines across documents.

Lines are normalised and hashed; a line that so many documents of a host share is
boilerplate there and is taken out; a document of which too little is left is rejected.  Rules on
the text alone come first: too few words, or too many words in runs that the text repeats.  All
of it is made of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.shared import SPACES, staged, words

SYMBOLS = "#*$%&|<>"
RUN = 5
LEAST_WORDS = 10
REPEATED_PERCENT = 20
#: A line of a host is boilerplate if at least so many of its documents have it, however many others the host has.
LINE_DOCUMENTS = 20
#: A document is depleted if less than this share of its words remains.
REMAINING = 0.3
HAS_WORD = r"[^\x20\x09-\x0D]"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _covered(starts: Column, run: int) -> Column:
    """How many places the runs from these sorted starts cover."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        starts, none, lambda a, p: F.struct((p + run).alias("end"), (a["n"] + p + run - F.greatest(p, a["end"])).alias("n")), lambda a: a["n"]
    )


def _repeated_starts(runs: Column) -> Column:
    """Sorted places of the values that occur more than once: equal values are neighbours once sorted."""
    ordered = F.array_sort(F.transform(runs, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    return F.transform(
        F.array(ordered),
        lambda s: F.array_sort(F.filter(
            F.transform(s, lambda e, i: F.when(((i > 0) & (F.get(s, i - 1)["x"] == e["x"])) | (F.get(s, i + 1)["x"] == e["x"]), e["i"])),
            lambda p: p.isNotNull(),
        )),
    )[0]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, the counts, and hash and number of words of each line with a word."""
    step = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    step = step.withColumn("lines", F.filter(F.split("text", "\n"), lambda l: l.rlike(HAS_WORD)))
    step = step.withColumn("in_lines", F.transform("lines", words))
    step = step.withColumn("hashes", F.transform(F.flatten("in_lines"), lambda w: F.xxhash64(w)))
    step = step.withColumn("n_words", F.size("hashes"))
    run = F.transform(F.sequence(F.lit(0), F.col("n_words") - RUN), lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + j) for j in range(RUN)]))
    step = step.withColumn("runs", F.when(F.col("n_words") >= RUN, run).otherwise(F.array().cast("array<bigint>")))
    repeats = F.when(F.size(F.array_distinct("runs")) < F.size("runs"), _covered(_repeated_starts(F.col("runs")), RUN)).otherwise(0)
    return step.select(
        "doc_id", "source", F.col("n_words").cast("bigint").alias("n_words"),
        F.length(_without(F.col("text"), SPACES)).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeats.cast("bigint").alias("n_repeat_words"),
        F.transform("in_lines", lambda w: F.struct(F.xxhash64(F.lower(F.array_join(w, " "))).alias("line"), F.size(w).alias("size"))).alias("lines"),
    )


def judged(docs: DataFrame, line_documents: int = LINE_DOCUMENTS, line_share: float = 0.0, remaining: float = REMAINING) -> DataFrame:
    """doc_id, counts, base_failed, n_removed (words in boilerplate lines) and kept of every document row.

    NULL and empty texts have no words and fail.  Documents without source are a host of their own.
    Each row counts as a document, so repeated rows make their lines frequent like other copies.
    A line that a document repeats counts once for its frequency and each time for what is removed.
    A caller may ask for a share of the host's documents besides; the query doesn't.
    Other columns are ignored.
    """
    rows = staged(measured(docs).withColumn("row", F.monotonically_increasing_id()).withColumn("host", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), "measured")
    in_doc = rows.select("row", "host", F.inline("lines")).groupBy("row", "host", "line").agg(F.sum("size").alias("size"))
    in_doc = staged(in_doc, "lines")
    common = in_doc.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= line_documents)
    if line_share > 0:
        sizes = rows.groupBy("host").agg(F.count("*").alias("documents"))
        common = common.join(sizes, "host").where(F.col("n") >= line_share * F.col("documents"))
    common = common.select("host", "line")
    removed = in_doc.join(common, ["host", "line"], "left_semi").groupBy("row").agg(F.sum("size").alias("n_removed"))
    n_removed = F.coalesce("n_removed", F.lit(0).cast("bigint"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return rows.join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), n_removed.alias("n_removed"),
        (~failed & (F.col("n_words") - n_removed >= remaining * F.col("n_words"))).alias("kept"),
    )
