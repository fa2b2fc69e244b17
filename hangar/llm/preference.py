"""Chat formatting of preference pairs (operator 3).

Method: the longest common turn prefix of the chosen and the rejected
conversation is rendered once as the prompt; what follows on either side is
rendered as a completion with the spans of its assistant turns, the only
characters that count in training.  DataFrame functions only: a conversation
is one training example, so its turns make one row.

Defined cases: rows without conv_id belong to no conversation; a null role or
text is empty; turns are ordered by turn (null last), then role and text;
repeated identical rows are one turn; equal sides have an empty completion
each; control marks inside a text are broken up, so a text cannot forge a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangar.llm.common import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and turns (array of role, text) of a table conv_id, turn, role, text."""
    row = F.struct(F.col("turn").isNull().alias("late"), F.col("turn"),
                   F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    return (turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id")
            .agg(F.sort_array(F.collect_set(row)).alias("rows"))
            .select("conv_id", F.transform("rows", lambda r: F.struct(r["role"], r["text"]))
                    .alias("turns")))


def stale_answer_pairs(convs: DataFrame, role: str = "assistant") -> DataFrame:
    """pair_id, chosen, rejected: a conversation up to its last answer, against
    the same with the answer before that one repeated (or none, if there is
    none).  Conversations without an answer give no pair."""
    n = F.size("turns")
    at = F.transform(F.filter(F.sequence(F.lit(1), n),
                              lambda i: F.element_at("turns", i)["role"] == role), lambda i: i)
    found = convs.where(n > 0).withColumn("_at", at).where(F.size("_at") > 0)
    last = F.element_at("_at", -1)
    before = F.when(F.size("_at") > 1,
                    F.element_at("turns", F.element_at("_at", F.size("_at") - 1))["text"])
    stale = F.when(before.isNull(), F.array().cast(TURNS)).otherwise(
        F.array(F.struct(F.lit(role).alias("role"), before.alias("text"))))
    return found.select(F.col("conv_id").alias("pair_id"),
                        F.slice("turns", F.lit(1), last).alias("chosen"),
                        F.concat(F.slice("turns", F.lit(1), last - 1), stale).alias("rejected"))


def _piece(turn: Column) -> Column:
    text = F.replace(turn["text"], F.lit("<|"), F.lit("< |"))
    role = F.replace(turn["role"], F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE + "\n"))


def _mask(turns: Column, role: str) -> Column:
    """Spans (code points, end exclusive) of the answers and their end marks."""
    def step(s, t):
        size = F.length(_piece(t))
        head = F.length(F.lit(OPEN)) + F.length(t["role"]) + 1
        span = F.struct((s["at"] + head).alias("start"), (s["at"] + size - 1).alias("end"))
        return F.struct((s["at"] + size).alias("at"), F.when(
            t["role"] == role, F.concat(s["spans"], F.array(span))).otherwise(s["spans"])
            .alias("spans"))

    return F.aggregate(turns, F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        step, lambda s: s["spans"])


def format_pairs(pairs: DataFrame, role: str = "assistant") -> DataFrame:
    """pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask."""
    differs = F.zip_with("chosen", "rejected", lambda a, b: ~a.eqNullSafe(b))
    first = F.array_position(differs, True).cast("int")
    split = pairs.withColumn("n_common", F.when(first == 0, F.size("chosen")).otherwise(first - 1))
    rest = lambda c: F.slice(c, F.col("n_common") + 1,
                             F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    text = lambda t: F.array_join(F.transform(t, _piece), "")
    return split.select(
        "pair_id", "n_common", text(F.slice("chosen", F.lit(1), F.col("n_common"))).alias("prompt"),
        text(rest("chosen")).alias("chosen"), text(rest("rejected")).alias("rejected"),
        _mask(rest("chosen"), role).alias("chosen_mask"),
        _mask(rest("rejected"), role).alias("rejected_mask"))


def op3_preference_format(spark, sf_dir):
    """All conversations as preference pairs; masks as start-end, joined by commas."""
    out = format_pairs(stale_answer_pairs(conversations(table(spark, sf_dir, "conversations"))))
    mask = lambda c: F.concat_ws(",", F.transform(c, lambda m: F.concat_ws(
        "-", m["start"].cast("string"), m["end"].cast("string"))))
    return out.withColumns({c: mask(c) for c in ("chosen_mask", "rejected_mask")})


ORACLE = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS i
  FROM t),
a AS (
  SELECT conv_id, i, text, role,
         row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back
  FROM n WHERE role = 'assistant'),
p AS (
  SELECT l.conv_id, l.i AS last, l.text AS good, b.text AS bad
  FROM a l LEFT JOIN a b ON l.conv_id = b.conv_id AND b.back = 2 WHERE l.back = 1),
r AS (
  SELECT n.conv_id, n.i, '<|im_start|>' || replace(n.role, '<|', '< |') || chr(10)
         || replace(n.text, '<|', '< |') || '<|im_end|>' || chr(10) AS piece FROM n),
f AS (
  SELECT p.conv_id, p.last, p.good, p.bad, p.good IS NOT DISTINCT FROM p.bad AS same,
         coalesce(string_agg(r.piece, '' ORDER BY r.i), '') AS prompt
  FROM p LEFT JOIN r ON r.conv_id = p.conv_id
       AND (r.i < p.last OR r.i = p.last AND p.good IS NOT DISTINCT FROM p.bad)
  GROUP BY ALL),
g AS (
  SELECT *, '<|im_start|>assistant' || chr(10) AS head, '<|im_end|>' || chr(10) AS tail,
         replace(good, '<|', '< |') AS g2, replace(bad, '<|', '< |') AS b2 FROM f)
SELECT conv_id AS pair_id, CAST(CASE WHEN same THEN last ELSE last - 1 END AS INTEGER) AS n_common,
       prompt, CASE WHEN same THEN '' ELSE head || g2 || tail END AS chosen,
       CASE WHEN same OR bad IS NULL THEN '' ELSE head || b2 || tail END AS rejected,
       CASE WHEN same THEN '' ELSE '22-' || (22 + length(g2) + 10) END AS chosen_mask,
       CASE WHEN same OR bad IS NULL THEN '' ELSE '22-' || (22 + length(b2) + 10) END
         AS rejected_mask
FROM g
"""
