"""Chat formatting by rotating perspectives.

For every participant of a dialogue the whole dialogue is rendered with that speaker as the
assistant and all others as named users; system turns stay what they are.  The spans to learn are
the assistant's words with their end mark.  A dialogue is rendered in pieces of at most `PIECE`
turns, so that one with very many turns is spread over tasks; joined in order the pieces are the
whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.shared import numbered

PIECE = 200
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
UNKNOWN = "unknown"


def perspectives(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per dialogue, participant and piece: conv_id, perspective, piece, n_turns, n_own, rendered, spans.

    turns: conv_id, turn, role (the speaker) and text.  Turns are in order of turn, NULL last, and
    equal ones in order of role and text; repeated rows are turns of their own.  A NULL text is
    empty.  A turn without role belongs to a user named "unknown", who has no perspective, and
    a dialogue of such and system turns only gives no row.  NULL is a conv_id like any other.
    Marks inside texts and names are broken up.  spans: array of (begin, end), in characters of
    `rendered`.  Other columns are ignored.
    """
    def plain(c):
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    turns = turns.select("conv_id", "turn", F.col("role").alias("speaker"), plain(F.coalesce("text", F.lit(""))).alias("text"))
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "speaker", "text")]
    placed = numbered(turns, order, "turns")
    first = placed.groupBy("conv_id").agg(F.min("position").alias("first")).withColumnRenamed("conv_id", "_conv")
    placed = placed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    placed = placed.withColumn("nth", F.col("position") - F.col("first")).withColumn("piece", F.floor(F.col("nth") / piece))
    own = placed.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = placed.join(own, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    mine = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    name = F.coalesce(plain(F.col("speaker")), F.lit(UNKNOWN))
    role = F.when(mine, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), name))
    seen = seen.withColumn("mine", mine).withColumn("head", F.concat(F.lit(OPEN), role, F.lit("\n"))).withColumn("body", F.concat("text", F.lit(CLOSE)))
    within = Window.partitionBy("conv_id", "perspective", "piece").orderBy("nth")
    length = F.length("head") + F.length("body") + 1
    begin = F.sum(length).over(within) - F.length("body") - 1
    seen = seen.withColumn("begin", begin)
    turn = F.struct("nth", "mine", F.concat("head", "body", F.lit("\n")).alias("shown"), "begin", (F.col("begin") + F.length("body")).alias("end"))
    whole = seen.groupBy("conv_id", "perspective", "piece").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["mine"]), lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end")))
    return whole.select(
        "conv_id", "perspective", "piece", F.size("t").cast("bigint").alias("n_turns"), F.size(F.filter("t", lambda x: x["mine"])).cast("bigint").alias("n_own"),
        F.array_join(F.transform("t", lambda x: x["shown"]), "").alias("rendered"), spans.alias("spans"),
    )
