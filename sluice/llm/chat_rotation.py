"""Multi-party perspective rotation of dialogues, with DataFrame functions only.

For every speaker of a conversation the dialogue is rendered with that speaker as the assistant and the others as named users, with
a mask over what the assistant says.  The rendering comes as one row a turn with its character range, so that a
conversation of any length is no single row; its text is the rows' ``rendered`` in the order of ``start``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 256
NOT_SPEAKERS = ("system",)


def perspectives(conversations: DataFrame, not_speakers: tuple[str, ...] = NOT_SPEAKERS, block: int = BLOCK) -> DataFrame:
    """(conv_id, perspective, turn, speaker, rendered, start, mask_start, mask_end) of conversations (conv_id, turn, role, text).

    perspective: the role that speaks as the assistant, every role of the conversation but those in not_speakers, which are rendered
    under their own name.  start is the character offset of the turn in that rendering; [mask_start, mask_end) is what to
    learn: the text and end mark of the assistant's turns, empty (mask_start = mask_end) in other turns.

    A null role is the speaker ``unknown``, a null text is empty, rows without conv_id are left out, a null turn comes
    first.  Turns of equal number stand in the order of role and text; repeated rows stay.  A conversation without a speaker
    gives no rows; an empty table gives none; other columns are ignored.  Offsets are summed in blocks of ``block`` turns,
    so that a very long conversation is dealt over many tasks.
    """
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text")
    )
    who = turns.select("conv_id", F.col("speaker").alias("perspective")).where(~F.col("perspective").isin(*not_speakers)).distinct()
    own = F.col("speaker") == F.col("perspective")
    head = F.when(own, F.lit("<|assistant|>\n")).when(F.col("speaker").isin(*not_speakers), F.concat(F.lit("<|"), "speaker", F.lit("|>\n"))).otherwise(F.concat(F.lit("<|user:"), "speaker", F.lit("|>\n")))
    tail = F.lit("<|end|>\n")
    rows = (
        turns.join(who, "conv_id")
        .withColumns({"rendered": F.concat(head, "text", tail), "head": F.length(head), "block": F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62)))})
        .withColumn("size", F.length("rendered").cast("long"))
        .drop("text")
    )
    key = ("conv_id", "perspective", "block")
    inside = Window.partitionBy(*key).orderBy(F.col("turn").asc_nulls_first(), "speaker", "rendered").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = rows.groupBy(*key).agg(F.sum("size").alias("all"))
    before = sizes.select(*key, (F.sum("all").over(Window.partitionBy("conv_id", "perspective").orderBy("block")) - F.col("all")).alias("before"))
    rows = rows.withColumn("upto", F.sum("size").over(inside)).join(before, list(key)).withColumn("start", F.col("before") + F.col("upto") - F.col("size"))
    begin = F.when(own, F.col("start") + F.col("head")).otherwise(F.col("start"))
    end = F.when(own, F.col("start") + F.col("size")).otherwise(F.col("start"))
    return rows.select("conv_id", "perspective", "turn", "speaker", "rendered", "start", begin.alias("mask_start"), end.alias("mask_end"))


SQL = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker NOT IN ({", ".join(f"'{x}'" for x in NOT_SPEAKERS)})),
seg AS (
  SELECT t.*, w.perspective, CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker IN ({", ".join(f"'{x}'" for x in NOT_SPEAKERS)}) THEN '<|' || speaker || '|>' ELSE '<|user:' || speaker || '|>' END || chr(10) AS head
  FROM turns t JOIN who w USING (conv_id)),
r AS (SELECT *, head || text || '<|end|>' || chr(10) AS rendered FROM seg),
s AS (SELECT *, CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, rendered ROWS UNBOUNDED PRECEDING) - length(rendered) AS BIGINT) AS start FROM r)
SELECT conv_id, perspective, turn, speaker, rendered, start, start + CASE WHEN speaker = perspective THEN length(head) ELSE 0 END AS mask_start, start + CASE WHEN speaker = perspective THEN length(rendered) ELSE 0 END AS mask_end FROM s
"""
