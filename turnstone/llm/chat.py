"""Chat formatting: snapshots of growing conversations collapse to the longest, which are then rendered.

DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefixes(conversations: DataFrame) -> DataFrame:
    """Every turn of every conversation with the turn-prefix it ends: conv_id, k (turns so far), n (all turns), role,
    text, a, b (rolling hashes of the prefix).

    A prefix's hash is the running XOR of its turns' hashes, each keyed by the turn's place, so it names the
    sequence. Texts are shuffled by conversation here, once; what is made from this reads the same exchange.
    """
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.withColumn("k", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))
    rolled = [F.bit_xor(F.xxhash64(F.lit(seed), "k", "role", "text")).over(so_far).alias(c) for seed, c in ((1, "a"), (2, "b"))]
    return placed.select("conv_id", "k", "n", "role", "text", *rolled)


def maximal(found: DataFrame) -> DataFrame:
    """conv_id of the conversations (of prefixes) that are no proper prefix of another; of equal ones the smallest id."""
    name = ["k", "a", "b"]
    full = found.where("k = n").groupBy(*name).agg(F.min("conv_id").alias("conv_id"))
    inner = found.where("k < n").select(*name).distinct()
    return full.join(inner, name, "left_anti").select("conv_id")


def render(found: DataFrame) -> DataFrame:
    """conv_id, n_turns and chat: each conversation's turns (of prefixes) as one text in the chat template."""
    turn = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    listed = F.array_sort(F.collect_list(F.struct("k", turn.alias("turn"))))
    return found.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.array_join(F.transform(listed, lambda t: t["turn"]), "").alias("chat"))


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    """Maximal conversations in the chat template, one row each: conv_id, n_turns, chat.

    A conversation whose turns (role and text, in order) begin another, longer one is a snapshot of it and goes;
    of conversations equal throughout, the smallest conv_id stays. Only those that stay are rendered. Turns are
    ordered by turn, then by content. A conversation is a row of the result, so one task holds its turns: any number of
    them, up to what a row can hold. Equal conversations, prefixes and turns are aggregated partially, however many.

    Rows with a null conv_id are left out; a null turn comes first, a null role or text counts as empty; repeated
    rows are repeated turns; texts of any length are whole; an empty table gives no rows; other columns are ignored.
    """
    found = prefixes(conversations)
    return render(found.join(maximal(found), "conv_id", "left_semi"))


ORACLE_SQL = """
WITH base AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
pre AS (
  SELECT conv_id, k, n, string_agg(len(role) || ':' || role || len(text) || ':' || text, '')
         OVER (PARTITION BY conv_id ORDER BY k) AS p
  FROM base),
uniq AS (SELECT p, min(conv_id) AS conv_id, min(n) AS n FROM pre WHERE k = n GROUP BY p),
kept AS (SELECT conv_id, n FROM uniq WHERE p NOT IN (SELECT p FROM pre WHERE k < n))
SELECT b.conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       string_agg('<|im_start|>' || b.role || chr(10) || b.text || '<|im_end|>' || chr(10), '' ORDER BY b.k) AS chat
FROM base b JOIN kept ON kept.conv_id = b.conv_id GROUP BY b.conv_id
"""
