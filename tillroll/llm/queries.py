"""The registered queries of this subpackage: each applies its operator to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import (
    cover_search, covering_simhash, entropy_mix, fuzzy_lines, line_frequency, periodic_runs, perspectives, pu_quality, token_alignment, token_files,
    toxicity_gru, url_templates, winnowing,
)
from tillroll.llm.shared import table, words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(program: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = program
        if sql:
            ORACLE[name] = sql
        return program

    return register


@query("op1_url_templates")
def op1(spark: SparkSession, directory: str) -> DataFrame:
    return url_templates.judge(table(spark, directory, "pages"))


@query("op2_entropy_mix")
def op2(spark: SparkSession, directory: str) -> DataFrame:
    mixed = entropy_mix.mixed(table(spark, directory, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP3_SQL = """
WITH turns AS (
  SELECT conv_id, role AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS nth
  FROM conversations
), seen AS (
  SELECT t.conv_id, p.perspective, nth // 200 AS piece, nth, speaker IS NOT DISTINCT FROM p.perspective AS mine, text || '<|im_end|>' AS body,
    '<|im_start|>' || CASE WHEN speaker IS NOT DISTINCT FROM p.perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
      ELSE 'user name=' || coalesce(replace(speaker, '<|', '< |'), 'unknown') END || chr(10) AS head
  FROM turns t JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system') p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, piece ORDER BY nth) - length(body) - 1 AS start FROM seen
)
SELECT conv_id, perspective, CAST(piece AS BIGINT) AS piece, count(*) AS n_turns, count(*) FILTER (mine) AS n_own,
  sha256(string_agg(head || body || chr(10), '' ORDER BY nth)) AS rendered_sha256,
  coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(body) AS BIGINT), ',' ORDER BY nth) FILTER (mine), '') AS spans
FROM placed GROUP BY conv_id, perspective, piece
"""


@query("op3_perspectives", OP3_SQL)
def op3(spark: SparkSession, directory: str) -> DataFrame:
    shown = perspectives.perspectives(table(spark, directory, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return shown.select("conv_id", "perspective", "piece", "n_turns", "n_own", F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"), spans.alias("spans"))


@query("op4_pu_quality")
def op4(spark: SparkSession, directory: str) -> DataFrame:
    scored = pu_quality.quality(table(spark, directory, "documents"), table(spark, directory, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= pu_quality.THRESHOLD).cast("int").alias("predicted"))


@query("op5_covering_simhash")
def op5(spark: SparkSession, directory: str) -> DataFrame:
    found = covering_simhash.near_duplicates(table(spark, directory, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP6_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (SELECT r, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d
), runs AS (SELECT r, i, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
), twice AS (SELECT r, i FROM runs JOIN (SELECT r, s FROM runs GROUP BY r, s HAVING count(*) > 1) USING (r, s)
), repeated AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), lines AS (
  SELECT r, host, l, regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+') AS w FROM (SELECT r, host, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')
), dups AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY r
), in_doc AS (SELECT r, host, lower(array_to_string(w, ' ')) AS line, sum(len(w)) AS size FROM lines GROUP BY ALL
), common AS (
  SELECT host, line FROM in_doc GROUP BY ALL HAVING count(*) >= 20
), removed AS (SELECT r, sum(size) AS n_removed FROM in_doc JOIN common USING (host, line) GROUP BY r
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
  FROM d JOIN w USING (r) LEFT JOIN dups USING (r) LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_removed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_removed >= 0.3 * n_words AS kept
FROM counts
"""


@query("op6_line_frequency", OP6_SQL)
def op6(spark: SparkSession, directory: str) -> DataFrame:
    return line_frequency.judged(table(spark, directory, "documents"))


@query("op7_fuzzy_lines")
def op7(spark: SparkSession, directory: str) -> DataFrame:
    return fuzzy_lines.fuzzy(table(spark, directory, "documents"), meet=fuzzy_lines.by_words)


OP8_SQL = """
WITH doc_words AS (
  SELECT rowid AS r, doc_id, w, len(w) AS n FROM (
    SELECT row_number() OVER () AS rowid, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents)
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS span FROM (
    SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item_words WHERE len(w) > 0)
), places AS (
  SELECT r, size, i, array_to_string(w[i : i + size - 1], ' ') AS span FROM (
    SELECT r, w, size, unnest(range(1, n - size + 2)) AS i FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE n >= size)
), hits AS (
  SELECT r, item_id, p.size, i FROM places p JOIN windows w ON p.size = w.size AND p.span = w.span
), covered AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= n AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


@query("op8_winnowing", OP8_SQL)
def op8(spark: SparkSession, directory: str) -> DataFrame:
    found = winnowing.contamination(table(spark, directory, "documents"), table(spark, directory, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query("op9_toxicity_gru")
def op9(spark: SparkSession, directory: str) -> DataFrame:
    scored = toxicity_gru.toxicity(table(spark, directory, "documents"), table(spark, directory, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity_gru.THRESHOLD).cast("int").alias("predicted"))


@query("op10_token_files")
def op10(spark: SparkSession, directory: str) -> DataFrame:
    return token_files.token_digests(table(spark, directory, "documents"), token_files.default_tokenizer(spark))


def _with_planted_run(docs: DataFrame) -> DataFrame:
    """doc_id and text; one document in ten, by the checksum of its id, repeats its words from a place on with a period."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    base = docs.select("doc_id", "text", checksum.alias("h"), F.when(checksum % 10 == 0, words(F.col("text"))).alias("w"))
    sized = base.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    placed = sized.withColumn("a", F.expr("IF(n > 0, CAST(g % n AS INT), 0)"))
    placed = placed.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    repeated = F.expr(
        "array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a)), ' ')"
    )
    return placed.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), repeated).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, directory: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_planted_run(table(spark, directory, "documents")))
    more = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]  # noqa: E731  which of two runs has more periods
    order = lambda a, b: (
        F.when(more(a, b) != 0, -F.signum(more(a, b))).when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
        .otherwise(F.signum(a["period"] - b["period"])).cast("int")
    )
    first = F.get(F.array_sort("runs", order), 0)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(listed, "\n"), F.lit("\n"))).otherwise("")
    digests = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), first.alias("best"), text.alias("runs_text"), "collapsed")
    return digests.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("runs_text").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op12_cover_search", OP12_SQL)
def op12(spark: SparkSession, directory: str) -> DataFrame:
    return cover_search.top_k(table(spark, directory, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op13_token_alignment")
def op13(spark: SparkSession, directory: str) -> DataFrame:
    vocabularies = token_alignment.default_vocabularies(spark)
    found = token_alignment.aligned(table(spark, directory, "documents"), *vocabularies)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return token_alignment.with_counts(found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links"), *vocabularies)


@query("pipeline")
def pipeline(spark: SparkSession, directory: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, directory)
