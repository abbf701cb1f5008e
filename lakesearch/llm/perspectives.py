"""Multi-party perspective rotation for chat data.

A dialogue is rendered once for each of its participants: their turns as assistant,
everybody else's as a user of that name, system turns as they are. Only what the
assistant says is learnt. Each turn of each perspective is a row, so a dialogue of any
length spreads over tasks; the rows of one perspective, in the order of turns, are the
rendered dialogue. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import table

SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>\n"


def _quoted(text: Column) -> Column:
    """Text that cannot be taken for a marker; null is empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotated(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", system: str = SYSTEM) -> DataFrame:
    """``conversation, speaker, turn, role, name, rendered, mask_from, mask_to`` for each turn seen by each participant.

    ``speaker`` is the participant whose perspective a row belongs to. ``name`` is set for
    users only. ``rendered`` is ``<|im_start|>role name=...\\n`` + text + ``<|im_end|>\\n``; its
    code points from ``mask_from`` up to, not including, ``mask_to`` are learnt (0 and 0:
    none), that is an assistant's text and end marker. ``<|`` in a text or name becomes
    ``< |``. A null speaker is a nameless user and no participant, a null text empty. A
    null conversation is a conversation of its own. Without a participant other than the
    system a conversation has no perspective and gives no row. Equal turns and repeated
    rows are each rendered. Extra columns are not carried.
    """
    turns = df.select(
        F.col(conversation).alias("_conversation"), F.col(turn).alias("_turn"), F.col(speaker).alias("_by"), F.col(text).alias("_text")
    )
    people = turns.where(F.col("_by").isNotNull() & (F.col("_by") != system)).select(F.col("_conversation").alias("_c"), F.col("_by").alias("_speaker")).distinct()
    seen = turns.join(people, F.col("_conversation").eqNullSafe(F.col("_c")))
    mine = F.coalesce(F.col("_by") == F.col("_speaker"), F.lit(False))
    role = F.when(mine, "assistant").when(F.col("_by") == system, system).otherwise("user")
    name = F.when(~mine & F.col("_by").isNotNull() & (F.col("_by") != system), _quoted(F.col("_by")))
    head = F.concat(F.lit(START), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    rendered = F.concat(head, _quoted(F.col("_text")), F.lit(END))
    return seen.select(
        F.col("_conversation").alias(conversation),
        F.col("_speaker").alias("speaker"),
        F.col("_turn").alias(turn),
        role.alias("role"),
        name.alias("name"),
        rendered.alias("rendered"),
        F.when(mine, F.length(head)).otherwise(0).alias("mask_from"),
        F.when(mine, F.length(rendered)).otherwise(0).alias("mask_to"),
    )


def perspectives(spark, folder: str) -> DataFrame:
    """op8: every conversation from the perspective of each participant."""
    return rotated(table(spark, folder, "conversations"))


PERSPECTIVES_SQL = """
WITH people AS (
  SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> 'system'
), seen AS (
  SELECT c.conv_id, p.speaker, c.turn, COALESCE(c.role = p.speaker, FALSE) AS mine, c.role AS by_role,
    replace(COALESCE(c.text, ''), '<|', '< |') AS body
  FROM conversations c JOIN people p ON c.conv_id IS NOT DISTINCT FROM p.conv_id
), named AS (
  SELECT *, CASE WHEN mine THEN 'assistant' WHEN by_role = 'system' THEN 'system' ELSE 'user' END AS role,
    CASE WHEN NOT mine AND by_role IS NOT NULL AND by_role <> 'system' THEN replace(by_role, '<|', '< |') END AS name
  FROM seen
), headed AS (
  SELECT *, '<|im_start|>' || role || COALESCE(' name=' || name, '') || chr(10) AS head FROM named
)
SELECT conv_id, speaker, turn, role, name, head || body || '<|im_end|>' || chr(10) AS rendered,
  CASE WHEN mine THEN length(head) ELSE 0 END::INTEGER AS mask_from,
  CASE WHEN mine THEN length(head || body || '<|im_end|>' || chr(10)) ELSE 0 END::INTEGER AS mask_to
FROM headed
"""
