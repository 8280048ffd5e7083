"""Chat formatting by perspective rotation: each speaker of a dialogue once as the assistant.

Roles other than ``system`` are participants. For every participant the dialogue is rendered with that speaker's turns
as the assistant's, the others' as those of users with their names, system turns as they are; the mask holds the spans
(code points, end exclusive) of what the assistant says, on which a model is trained.

A turn becomes ``<|user name=NAME|>TEXT<|end|>`` and a line end; system and assistant turns have no name. Turns are
numbered within their dialogue and cut into windows of ``WINDOW``, whatever their turn column says, so a dialogue of any
length is spread over many rows and tasks and nothing of it is left out. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.llm.common import stored

#: Turns of a window.
WINDOW = 64


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``number``, from 0 within each conv_id, by turn, role and text; equal rows get numbers of their own.

    One range sort, whose partitions hand over how many turns of each dialogue they hold: no task sorts a dialogue whole,
    and equal rows can be split as well, by where they lie in the input.
    """
    order = ["conv_id", "turn", "role", "text", "_place"]
    placed = turns.withColumn("_place", F.monotonically_increasing_id())
    rows = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()).drop("_place")
    rows = stored(rows.withColumn("_part", F.shiftright("_row", 33)), "turns")
    held = rows.groupBy("conv_id", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return rows.join(held, ["conv_id", "_part"]).withColumn("number", F.col("_row") - F.col("_first") + F.col("_before")).drop("_row", "_part", "_first", "_before")


def rotate(turns: DataFrame, window: int = WINDOW, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, speaker, part (window, from 0), n_turns, n_trained (turns of the speaker in it), rendered, mask (start:end, comma-joined).

    Order is by turn, then role, then text. A null turn counts as 0, a null role as ``unknown`` (a participant), null
    text as empty; rows without a conv_id are left out. Rows that agree in all four are a turn each. A participant who is
    silent in a window gets it with an empty mask. A dialogue of system turns only has no participant and gives no row,
    nor does an empty table. Other columns are not read.
    """
    said = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    said = numbered(said)
    part = F.floor(F.col("number") / F.lit(window)).cast("long")
    parts = said.withColumn("part", part).groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("number", "role", "text"))).alias("turns"))
    speakers = said.where("role != 'system'").select("conv_id", F.col("role").alias("speaker")).distinct()
    each = parts.join(speakers, "conv_id")
    head = F.expr("""transform(turns, t -> CASE WHEN t.role = 'system' THEN '<|system|>' WHEN t.role = speaker THEN '<|assistant|>' ELSE concat('<|user name=', t.role, '|>') END)""")
    each = each.withColumn("heads", head)
    pieces = F.expr("transform(turns, (t, i) -> concat(heads[i], t.text, '<|end|>\n'))")
    each = each.withColumn("pieces", pieces)
    # places where turns begin: running sums over the turns of one window
    begins = F.expr("aggregate(pieces, array(0L), (a, p) -> concat(a, array(element_at(a, -1) + length(p))))")
    each = each.withColumn("begins", begins)
    spans = F.expr("""
        array_compact(transform(turns, (t, i) -> CASE WHEN t.role = speaker THEN
            concat(begins[i] + length(heads[i]), ':', begins[i] + length(heads[i]) + length(t.text)) END))""")
    each = each.withColumn("spans", spans)
    return each.select(
        "conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), F.size("spans").cast("long").alias("n_trained"),
        F.array_join("pieces", "").alias("rendered"), F.array_join("spans", ",").alias("mask"),
    )
