"""Multi-party perspective rotation of dialogues, in column expressions only.

For every participant the dialogue is rendered once with that speaker as ``assistant`` and the
others as named users; the mask covers what the assistant says. Turns are numbered by one global
sort instead of a window per conversation, and a dialogue is cut into parts of a fixed number of
turns, so a conversation that holds a third of all rows is worked on by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pmweave.session import stage

TURNS_PER_PART = 256
CONTEXT_ROLES = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
UNNAMED = "unnamed"


def number_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with ``rank``: 0, 1, ... within each conversation by turn, speaker and text.

    The rows are sorted across partitions and written once; a partition's first rank in a
    conversation is the number of rows that earlier partitions hold of it.
    """
    order = ["conv_id", "turn", "speaker", "text"]
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = turns.withColumn("tie", F.monotonically_increasing_id())  # spreads identical rows
    placed = tied.repartitionByRange(n, *order, "tie").sortWithinPartitions(*order, "tie")
    placed = placed.drop("tie").withColumn("place", F.monotonically_increasing_id())
    placed = stage(placed.withColumn("chunk", F.shiftright("place", 33)), "turns")
    chunks = placed.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    chunks = chunks.withColumn("before", F.coalesce(before, F.lit(0))).alias("c")
    same = F.expr("t.conv_id <=> c.conv_id and t.chunk = c.chunk")
    return placed.alias("t").join(chunks, same).select("t.conv_id", "t.speaker", "t.text", F.expr("t.place - c.first + c.before").alias("rank"))


def _safe(text: Column) -> Column:
    """Control strings inside a text are broken up, so that no text can forge a turn."""
    return F.regexp_replace(text, r"<\|(im_start|im_end)\|>", "<| $1 |>")


def rotate(turns: DataFrame, turns_per_part: int = TURNS_PER_PART, context_roles: tuple[str, ...] = CONTEXT_ROLES) -> DataFrame:
    """``(conv_id, speaker, part, n_turns, text, masks)``: one row per conversation, participant and part.

    Participants are the distinct roles other than ``context_roles``, whose turns are rendered under
    their own role in every perspective. ``masks`` is an array of ``(start, end)`` in code points of
    ``text``: each covers an assistant's words and the closing mark. A null text is empty, a null
    role is the participant ``unnamed``; a null conv_id is a conversation like any other; rows
    that repeat are turns of their own, ties in ``turn`` (null first) go by role and text. A
    conversation of context turns alone has no perspective. No rows give no rows.
    """
    speaker = F.coalesce("role", F.lit(UNNAMED))
    ranked = stage(number_turns(turns.select("conv_id", "turn", speaker.alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))), "ranked")
    people = ranked.where(~F.col("speaker").isin(*context_roles)).select("conv_id", "speaker").distinct()
    seen = ranked.alias("t").join(people.alias("p"), F.expr("t.conv_id <=> p.conv_id"))
    mine = F.col("t.speaker") == F.col("p.speaker")
    name = F.when(mine, "assistant").when(F.col("t.speaker").isin(*context_roles), F.col("t.speaker")).otherwise(
        F.concat(F.lit("user name="), _safe(F.col("t.speaker"))))
    head = F.concat(F.lit(OPEN), name, F.lit("\n"))
    body = F.concat(_safe(F.col("t.text")), F.lit(CLOSE))
    pieces = seen.select("t.conv_id", "p.speaker", F.expr(f"t.rank div {turns_per_part}").alias("part"), "t.rank", mine.alias("mine"),
                         F.length(head).alias("head"), F.length(body).alias("body"), F.concat(head, body, F.lit("\n")).alias("piece"))
    dialogue = Window.partitionBy("conv_id", "speaker", "part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("head") + F.col("body") + 1).over(dialogue), F.lit(0)) + F.col("head")
    spans = pieces.withColumn("start", start)
    turn = F.struct("rank", "piece")
    mask = F.when(F.col("mine"), F.struct("start", (F.col("start") + F.col("body")).alias("end")))
    parts = spans.groupBy("conv_id", "speaker", "part").agg(
        F.count("*").alias("n_turns"), F.sort_array(F.collect_list(turn)).alias("turns"), F.sort_array(F.collect_list(mask)).alias("masks"))
    text = F.array_join(F.transform("turns", lambda t: t["piece"]), "")
    return parts.select("conv_id", "speaker", "part", "n_turns", text.alias("text"), "masks")
