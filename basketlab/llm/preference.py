"""Preference formatting: chosen and rejected conversations of a pair.

The turns that both conversations begin with are rendered once, as the
prompt; what follows on either side is its completion. A completion's mask
lists the spans to train on: an assistant turn's text with its end marker.
Everything is DataFrame expressions. A pair is one row of the result, so a
pair's turns meet in one group, and nothing larger does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .secrets import running

# The markers around a turn.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def _marked(text: Column) -> Column:
    """A text can't hold a marker: its ``<|`` gets a space."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), t["text"], F.lit(END + "\n"))), "")


def mask(turns: Column) -> Column:
    """(start, end) of the trained spans in ``render(turns)``, in code points."""
    before = running(F.transform(turns, lambda t: F.length(_header(t)) + F.length(t["text"]) + len(END) + 1),
                     lambda at, x: at + x)

    def span(t: Column, at: Column) -> Column:
        start = at + F.length(_header(t))
        return F.struct((t["role"] == TRAINED_ROLE).alias("trained"), start.alias("start"),
                        (start + F.length(t["text"]) + len(END)).alias("end"))

    spans = F.filter(F.zip_with(turns, before, span), lambda x: x["trained"])
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def pairs(turns: DataFrame) -> DataFrame:
    """From rows (pair_id, side, turn, role, text), side ``chosen`` or
    ``rejected``: per pair pair_id, n_prompt_turns, prompt, chosen, rejected,
    chosen_mask, rejected_mask.

    Turns are in the order of ``turn`` (null first), ties by role and text.
    Null roles and texts are empty, and an empty role isn't trained on. A pair
    with one side only has no prompt and an empty other completion; equal
    sides leave both completions empty. Rows with a null pair id or another
    side belong to no pair. Repeated rows are turns each, an empty table gives
    no rows, other columns play no part. A conversation of very many turns, or
    very long ones, is read in whole, in time that grows with its length.
    """
    turn = F.struct(F.col("turn"), _marked(F.col("role")).alias("role"), _marked(F.col("text")).alias("text"))
    sides = turns.filter("pair_id IS NOT NULL AND side IN ('chosen', 'rejected')").groupBy("pair_id").agg(
        *(F.sort_array(F.collect_list(F.when(F.col("side") == s, turn))).alias(s) for s in ("chosen", "rejected")))
    same = F.zip_with("chosen", "rejected",
                      lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]) & a.isNotNull() & b.isNotNull())
    differs = F.array_position(F.transform(same, lambda x: F.coalesce(x, F.lit(False))), False)
    n = F.when(differs > 0, differs - 1).otherwise(F.size("chosen")).cast("int")
    rows = sides.withColumn("n", n).select(
        "pair_id", "n", F.slice("chosen", F.lit(1), F.col("n")).alias("prompt"),
        *(F.slice(s, F.col("n") + 1, F.greatest(F.size(s), F.lit(1))).alias(s) for s in ("chosen", "rejected")))
    return rows.select("pair_id", F.col("n").alias("n_prompt_turns"), render(F.col("prompt")).alias("prompt"),
                       render(F.col("chosen")).alias("chosen"), render(F.col("rejected")).alias("rejected"),
                       mask(F.col("chosen")).alias("chosen_mask"), mask(F.col("rejected")).alias("rejected_mask"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["start"], x["end"])), ",")


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Preference rows from plain conversations: the conversation is chosen;
    rejected is the same with the last assistant turn's text taken from the
    conversation of the next id (empty if that has none). Conversations
    without an assistant turn give no pair."""
    answer = (conversations.filter((F.col("role") == TRAINED_ROLE) & F.col("conv_id").isNotNull())
              .groupBy("conv_id").agg(F.max("turn").alias("last"), F.max_by("text", F.struct("turn", "text")).alias("answer")))
    other = answer.select((F.col("conv_id") - 1).alias("conv_id"), F.col("answer").alias("other"))
    rows = conversations.join(answer.select("conv_id", "last").join(other, "conv_id", "left"), "conv_id")
    is_last = (F.col("role") == TRAINED_ROLE) & F.col("turn").eqNullSafe(F.col("last"))
    side = F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side")
    both = rows.select(F.col("conv_id").alias("pair_id"), side, "turn", "role", "text", "other", is_last.alias("is_last"))
    return both.select("pair_id", "side", "turn", "role", F.when(
        (F.col("side") == "rejected") & F.col("is_last"), F.col("other")).otherwise(F.col("text")).alias("text"))


#: DuckDB, turn by turn with windows.
ORACLE_SQL = """
WITH answers AS (
  SELECT conv_id, max(turn) AS last FROM conversations
  WHERE role = 'assistant' AND conv_id IS NOT NULL GROUP BY conv_id),
last_text AS (
  SELECT a.conv_id, max(c.text) AS answer FROM answers a
  JOIN conversations c ON c.conv_id = a.conv_id AND c.turn = a.last AND c.role = 'assistant' GROUP BY a.conv_id),
sides AS (
  SELECT c.conv_id AS pair_id, 'chosen' AS side, c.turn, c.role, c.text
  FROM conversations c JOIN answers a ON a.conv_id = c.conv_id
  UNION ALL
  SELECT c.conv_id, 'rejected', c.turn, c.role,
         CASE WHEN c.role = 'assistant' AND c.turn = a.last THEN o.answer ELSE c.text END
  FROM conversations c JOIN answers a ON a.conv_id = c.conv_id LEFT JOIN last_text o ON o.conv_id = c.conv_id + 1),
turns AS (
  SELECT pair_id, side, replace(coalesce(role, ''), '<|', '< |') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text, turn FROM sides),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS place FROM turns),
sizes AS (
  SELECT pair_id, count(*) FILTER (side = 'chosen') AS nc, count(*) FILTER (side = 'rejected') AS nr
  FROM placed GROUP BY pair_id),
differing AS (
  SELECT c.pair_id, min(c.place) AS first FROM placed c
  JOIN placed r ON r.pair_id = c.pair_id AND r.place = c.place AND c.side = 'chosen' AND r.side = 'rejected'
  WHERE c.role <> r.role OR c.text <> r.text GROUP BY c.pair_id),
prefix AS (
  SELECT s.pair_id, coalesce(d.first - 1, least(s.nc, s.nr)) AS n
  FROM sizes s LEFT JOIN differing d ON d.pair_id = s.pair_id),
rendered AS (
  SELECT p.*, x.n, '<|im_start|>' || role || chr(10) AS header,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS turn_text
  FROM placed p JOIN prefix x ON x.pair_id = p.pair_id),
spans AS (
  SELECT *, CAST(coalesce(sum(length(turn_text)) OVER (PARTITION BY pair_id, side ORDER BY place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(header) AS BIGINT) AS start
  FROM rendered WHERE place > n)
SELECT x.pair_id, CAST(x.n AS INTEGER) AS n_prompt_turns,
  coalesce((SELECT string_agg(turn_text, '' ORDER BY place) FROM rendered r
            WHERE r.pair_id = x.pair_id AND side = 'chosen' AND place <= r.n), '') AS prompt,
  coalesce((SELECT string_agg(turn_text, '' ORDER BY place) FROM spans r
            WHERE r.pair_id = x.pair_id AND side = 'chosen'), '') AS chosen,
  coalesce((SELECT string_agg(turn_text, '' ORDER BY place) FROM spans r
            WHERE r.pair_id = x.pair_id AND side = 'rejected'), '') AS rejected,
  coalesce((SELECT string_agg(start || ':' || (start + length(text) + 10), ',' ORDER BY place) FROM spans r
            WHERE r.pair_id = x.pair_id AND side = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
  coalesce((SELECT string_agg(start || ':' || (start + length(text) + 10), ',' ORDER BY place) FROM spans r
            WHERE r.pair_id = x.pair_id AND side = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM prefix x
"""
