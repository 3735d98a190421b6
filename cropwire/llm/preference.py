"""Preference formatting: the common turn prefix of two conversations once as prompt, then both completions, masked.

Work is per turn: a turn that both conversations of a pair hold is one row with
both sides' marks, the first turn with a row of one side only ends the prefix.
No conversation is gathered, so none is too long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropwire.llm.common import read_table

CHOSEN, REJECTED = 1, 2
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def header(role: Column) -> Column:
    return F.concat(F.lit(TURN_START), F.coalesce(role, F.lit("")), F.lit("\n"))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Segments of every pair: pair_id, part, turn, role, segment, train_from.

    Both inputs have pair_id, turn, role and text; other columns are ignored.
    ``part`` is ``prompt`` (the turns before the first in which the two differ,
    once for both), ``chosen`` or ``rejected``; a pair's text is its segments
    in order of turn (then role and text). ``train_from`` is the character of the
    segment from which on the loss counts: after the header of an assistant's turn
    in a completion, null elsewhere.

    Turns are compared as sets of (role, text) under one turn number: repeated
    rows count once, a null text equals a null text and is rendered empty, as is a null role. Rows with a null
    pair_id or turn, and pairs of which one side has no rows, are left out.
    Conversations that are equal give a prompt only.
    """
    def side(rows: DataFrame, mark: int) -> DataFrame:
        return rows.select("pair_id", "turn", "role", "text", F.lit(mark).alias("side")).filter("pair_id IS NOT NULL AND turn IS NOT NULL")

    both = side(chosen, CHOSEN).unionByName(side(rejected, REJECTED))
    turns = both.groupBy("pair_id", "turn", "role", "text").agg(F.bit_or("side").alias("sides"))
    ends = (turns.groupBy(F.col("pair_id").alias("of"))
            .agg(F.min(F.when(F.col("sides") != CHOSEN + REJECTED, F.col("turn"))).alias("differs"), F.bit_or("sides").alias("all"))
            .filter(F.col("all") == CHOSEN + REJECTED))
    shared = F.col("differs").isNull() | (F.col("turn") < F.col("differs"))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(F.filter(
        F.array(F.when(F.col("sides").bitwiseAND(CHOSEN) > 0, F.lit("chosen")), F.when(F.col("sides").bitwiseAND(REJECTED) > 0, F.lit("rejected"))),
        lambda x: x.isNotNull()))
    trained = (F.col("part") != "prompt") & F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))
    return (turns.join(ends, F.col("pair_id") == F.col("of")).withColumn("part", F.explode(parts))
            .select("pair_id", "part", "turn", "role",
                    F.concat(header(F.col("role")), F.coalesce("text", F.lit("")), F.lit(TURN_END)).alias("segment"),
                    F.when(trained, F.length(header(F.col("role")))).alias("train_from")))


def corrupted_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations: (chosen, rejected) with pair_id = conv_id.

    Chosen is the conversation up to its last assistant turn, rejected the same
    with that turn's text taken from the last assistant turn of the
    conversation whose id differs in the lowest bit. Conversations without such a
    turn, or without such a partner, give no pair; of several assistant texts under the last turn the greatest counts.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    # A null text is an empty one here, so that the answer is never skipped.
    last = (rows.filter(F.col("role") == TRAINED_ROLE).groupBy("conv_id")
            .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last")))
    answers = last.select(F.col("conv_id").alias("pair_id"), F.col("last.turn").alias("end"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("answer"))
    pairs = answers.join(other, "pair_id")
    kept = (rows.withColumnRenamed("conv_id", "pair_id").join(pairs, "pair_id").filter(F.col("turn") <= F.col("end")))
    chosen = kept.select("pair_id", "turn", "role", "text")
    replaced = (F.col("turn") == F.col("end")) & (F.col("role") == TRAINED_ROLE)
    rejected = kept.select("pair_id", "turn", "role", F.when(F.coalesce(replaced, F.lit(False)), F.col("answer")).otherwise(F.col("text")).alias("text"))
    return chosen, rejected


def op3_preference_formatting(spark, sf_dir: str) -> DataFrame:
    return format_preferences(*corrupted_pairs(read_table(spark, sf_dir, "conversations")))


OP3_SQL = """WITH r AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, turn AS e, coalesce(text, '') AS a FROM r WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, coalesce(text, '') DESC) = 1),
k AS (SELECT r.conv_id AS pair_id, r.turn, r.role, r.text, (r.turn = l.e AND r.role IS NOT DISTINCT FROM 'assistant') AS x, o.a
  FROM r JOIN l ON r.conv_id = l.conv_id JOIN l o ON o.conv_id = xor(r.conv_id, 1) WHERE r.turn <= l.e),
c AS (SELECT DISTINCT pair_id, turn, role, text FROM k), j AS (SELECT DISTINCT pair_id, turn, role, CASE WHEN x THEN a ELSE text END AS text FROM k),
u AS (SELECT *, 1 AS s FROM c UNION ALL SELECT *, 2 FROM j),
t AS (SELECT pair_id, turn, role, text, sum(s) AS s FROM u GROUP BY ALL),
d AS (SELECT pair_id, min(turn) FILTER (WHERE s <> 3) AS d FROM t GROUP BY pair_id),
p AS (SELECT t.*, 'prompt' AS part FROM t JOIN d USING (pair_id) WHERE d IS NULL OR turn < d
  UNION ALL SELECT t.*, 'chosen' FROM t JOIN d USING (pair_id) WHERE turn >= d AND s IN (1, 3)
  UNION ALL SELECT t.*, 'rejected' FROM t JOIN d USING (pair_id) WHERE turn >= d AND s IN (2, 3))
SELECT pair_id, part, turn, role, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS segment,
  CASE WHEN part <> 'prompt' AND role = 'assistant' THEN CAST(length('<|im_start|>' || role || chr(10)) AS INT) END AS train_from FROM p"""
