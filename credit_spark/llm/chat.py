"""Chat formatting by multi-party perspective rotation; DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and the others as named users. Masks tell the
character spans that a model learns from: the assistant's own messages.

Dialogues come in parts of at most ``part_turns`` messages (concatenated in
order they are the whole dialogue), so that no row grows with a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked

PART_TURNS = 64
# Speakers that are no participants: they keep their role from every perspective.
SETTINGS = ("system",)
UNKNOWN = "unknown"

BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def rotate(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", part_turns: int = PART_TURNS, settings: tuple[str, ...] = SETTINGS) -> DataFrame:
    """Dialogues from the perspective of each participant.

    Result, a row for each conversation, participant and part:
    ``conv_id``, ``perspective``, ``part`` (from 0), ``n_turns``, ``text``
    and ``masks`` (array of (start, end): code points of ``text``, end
    exclusive; own messages with their end mark).

    Messages are ordered by turn (nulls last), speaker and text.

    - null or blank speaker: the participant "unknown"; null text: empty
    - null conversation id: one conversation of its own
    - tied turns: in the order above; repeated rows: rendered as often
    - a conversation without participants: one rendering, with a null
      perspective and no masks
    - empty table: no rows
    - a conversation or an opening message that a third of all rows hold:
      ranks come from range partitions that split any group, parts are
      bounded, and in the joins the other side has one row for each
      conversation, or for each of its speakers
    """
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.nullif(F.trim(F.col(speaker_col).cast("string")), F.lit("")), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("speaker"), F.col("text")]
    placed = ranked(turns, order, "rank", "turns")
    starts = placed.groupBy("conv_id").agg(F.min("rank").alias("start")).withColumnRenamed("conv_id", "c")
    speakers = (placed.where(~F.col("speaker").isin(*settings)).select(F.col("conv_id").alias("c"),
                                                                       F.col("speaker").alias("perspective")).distinct())
    parts = (placed.join(starts, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
             .withColumn("part", F.floor((F.col("rank") - F.col("start")) / part_turns).cast("int"))
             .groupBy("conv_id", "part")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "speaker", "text"))).alias("messages")))
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")

    def render(m):
        mine = F.coalesce(m["speaker"] == F.col("perspective"), F.lit(False))
        header = (F.when(mine, "assistant").when(m["speaker"].isin(*settings), m["speaker"])
                  .otherwise(F.concat(F.lit("user name="), m["speaker"])))
        return F.struct(F.concat(F.lit(BEGIN), header, F.lit("\n")).alias("header"),
                        F.concat(m["text"], F.lit(END)).alias("body"), mine.alias("mine"))

    def extend(acc, s):
        start = acc["at"] + F.char_length(s["header"])
        end = start + F.char_length(s["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(s["mine"], F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    return (seen.withColumn("pieces", F.transform("messages", render))
            .select("conv_id", "perspective", "part", F.size("messages").alias("n_turns"),
                    F.array_join(F.transform("pieces", lambda s: F.concat(s["header"], s["body"])), "").alias("text"),
                    F.aggregate("pieces", none, extend, lambda acc: acc["spans"]).alias("masks")))
