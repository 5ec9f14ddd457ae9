"""Multi-party dialogues from the perspective of each participant.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant, all others as users with their names, and spans
that mark what the assistant says, which is what a model learns from.
System turns are shown to everyone and are nobody's perspective.

Native: DataFrame functions only.  A long conversation is rendered in pieces
of a bounded number of turns, each with its place in the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm.columns import require

PIECE = 128                   # turn numbers in a piece
SYSTEM = ("system",)
#: The markers of a turn.
START, END = "<|im_start|>", "<|im_end|>\n"


def _segment(turn: Column, perspective: Column, system: tuple[str, ...]) -> Column:
    name = F.coalesce(turn["role"], F.lit("unknown"))
    shown = (F.when(turn["role"].isin(*system), F.lit("system"))
             .when(turn["role"].eqNullSafe(perspective), F.lit("assistant"))
             .otherwise(F.concat(F.lit("user name="), name)))
    head = F.concat(F.lit(START), shown, F.lit("\n"))
    return F.struct(head.alias("head"), F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END)).alias("body"),
                    (shown == "assistant").alias("learned"))


def rotate(turns: DataFrame, system: tuple[str, ...] = SYSTEM, piece: int = PIECE) -> DataFrame:
    """(conv_id, perspective, piece, n_turns, dialogue, spans) for each
    participant and piece: ``spans`` are the code points, from ``begin`` to
    before ``end``, of the perspective's own turns with their end markers.

    Turns are ordered by number, null numbers first, those with one number by
    role and text; repeated rows stay.  A null role speaks as the user
    ``unknown`` and is no perspective, a null text is empty, null conversation
    ids are one conversation.  A conversation of system turns alone has no
    participant and no row.  Other columns are not read."""
    require(turns, "conv_id", "turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text")
    speakers = (rows.where(F.col("role").isNotNull() & ~F.col("role").isin(*system))
                .select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct())
    pieces = rows.groupBy("conv_id", F.coalesce(F.floor(F.col("turn") / piece), F.lit(0)).cast("long").alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    both = pieces.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    segments = both.withColumn("segments", F.transform("turns", lambda t: _segment(t, F.col("perspective"), system)))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans"))

    def step(done: Column, s: Column) -> Column:
        begin = done["at"] + F.length(s["head"])
        end = begin + F.length(s["body"])
        span = F.struct(begin.cast("long").alias("begin"), end.cast("long").alias("end"))
        return F.struct(end.cast("long").alias("at"), F.when(s["learned"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    return segments.select(
        "conv_id", "perspective", "piece", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "").alias("dialogue"),
        F.aggregate("segments", start, step, lambda done: done["spans"]).alias("spans"))


ORACLE = f"""
WITH speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
segments AS (
  SELECT t.conv_id, s.perspective, coalesce(floor(t.turn / {PIECE}.0), 0)::BIGINT AS piece, t.turn, t.role, t.text,
         '{START}' || CASE WHEN t.role = 'system' THEN 'system' WHEN t.role = s.perspective THEN 'assistant'
                       ELSE 'user name=' || coalesce(t.role, 'unknown') END || chr(10) AS head,
         coalesce(t.text, '') || '{END.strip()}' || chr(10) AS body, coalesce(t.role = s.perspective, false) AS learned
  FROM conversations t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER w AS stop FROM segments
  WINDOW w AS (PARTITION BY conv_id, perspective, piece ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, piece, count(*) AS n_turns, string_agg(head || body, '' ORDER BY stop) AS dialogue,
       coalesce(string_agg(CASE WHEN learned THEN (stop - length(body))::BIGINT || ':' || stop::BIGINT END, ' ' ORDER BY stop), '') AS mask
FROM placed GROUP BY conv_id, perspective, piece
"""
