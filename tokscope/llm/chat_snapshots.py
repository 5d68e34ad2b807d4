"""Chat formatting after collapsing cumulative snapshots.

A log often holds a conversation again and again, each time longer. Every turn gets a rolling hash of the conversation up to
it: the sum, over its turns, of two 64-bit hashes of (position, role, text), as decimals, so sums never overflow and a
conversation can be summed in parts. A conversation whose last hash is found at the same position inside a longer one is a
prefix of it; an anti-join of last hashes against proper-prefix hashes keeps the maximal ones, and of equal conversations the
one with the smallest conv_id. What stays is rendered, up to ``PART`` turns a row.

Turns of a conversation are split into chunks of ``PART`` turn numbers; positions and sums are taken within a chunk and
shifted by the totals of earlier chunks, so the longest conversation spreads over many tasks. Prefix hashes are made distinct
before they are joined, so a first turn that all conversations share is one row.

Defined cases: rows with null conv_id are dropped, repeated rows (same conv_id, turn, role and text) count once; a null turn comes
first; null role or text is an empty string; several texts in one turn are ordered by role, then text; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tokscope.llm.common import settle

PART = 256
#: The markup around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LOWEST = -(1 << 62)     # stands for a null turn


def positions(conversations: DataFrame) -> DataFrame:
    """conv_id, chunk, pos (0, 1, ...), role, text of the distinct turns."""
    turn = F.coalesce(F.col("turn").cast("bigint"), F.lit(LOWEST))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"), F.floor(turn / PART).cast("bigint").alias("chunk"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    before = _before(rows.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n")), n="first")
    at = F.row_number().over(W.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")) - 1
    return rows.withColumn("at", at).join(before, ["conv_id", "chunk"]).select(
        "conv_id", "chunk", (F.col("first") + F.col("at")).alias("pos"), "role", "text")


def _before(totals: DataFrame, **names: str) -> DataFrame:
    """conv_id, chunk and, for each total, the sum over earlier chunks of the conversation: one row per chunk."""
    w = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("conv_id", "chunk", *(F.coalesce(F.sum(c).over(w), F.lit(0)).alias(a) for c, a in names.items()))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, n, h1, h2: hashes of the first n turns, for every turn."""
    parts = [F.xxhash64(F.lit(seed), "pos", "role", "text").cast("decimal(20,0)").alias(f"t{seed}") for seed in (1, 2)]
    t = turns.select("conv_id", "chunk", "pos", *parts)
    before = _before(t.groupBy("conv_id", "chunk").agg(F.sum("t1").alias("t1"), F.sum("t2").alias("t2")), t1="b1", t2="b2")
    w = W.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    run = t.select("conv_id", "chunk", "pos", F.sum("t1").over(w).alias("s1"), F.sum("t2").over(w).alias("s2"))
    return run.join(before, ["conv_id", "chunk"]).select(
        "conv_id", (F.col("pos") + 1).alias("n"), *((F.col(f"s{i}") + F.col(f"b{i}")).cast("decimal(38,0)").alias(f"h{i}") for i in (1, 2)))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id of the conversations that are no proper prefix of another, one of each set of equal ones."""
    h = settle(prefix_hashes(turns))
    length = settle(h.groupBy("conv_id").agg(F.max("n").alias("length")))
    marked = h.join(length, "conv_id")
    inner = settle(marked.filter("n < length").select("n", "h1", "h2").distinct())
    ends = settle(marked.filter("n = length").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id")))
    return ends.join(inner, ["n", "h1", "h2"], "left_anti").select("conv_id")


def op6_chat(conversations: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, text: maximal conversations, rendered ``PART`` turns a row."""
    turns = settle(positions(conversations))
    kept = turns.join(settle(maximal(turns)), "conv_id", "left_semi")
    said = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(CLOSE))
    part = F.floor(F.col("pos") / PART).cast("bigint").alias("part")
    rows = kept.select("conv_id", part, F.struct("pos", said.alias("said")).alias("t")).groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", "part", F.size("t").cast("bigint").alias("n_turns"), F.array_join(F.col("t.said"), "").alias("text"))


ORACLE_SQL = f"""WITH t AS (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id, coalesce(turn, {LOWEST}) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos FROM t),
f AS (SELECT conv_id, pos + 1 AS n, string_agg(md5(role || chr(31) || text), ',') OVER (PARTITION BY conv_id ORDER BY pos) AS pre FROM p),
l AS (SELECT conv_id, max(n) AS length FROM f GROUP BY 1),
e AS (SELECT f.pre, min(conv_id) AS conv_id FROM f JOIN l USING (conv_id) WHERE n = length GROUP BY 1),
i AS (SELECT DISTINCT pre FROM f JOIN l USING (conv_id) WHERE n < length),
k AS (SELECT conv_id FROM e WHERE pre NOT IN (SELECT pre FROM i))
SELECT conv_id, CAST(floor(pos / {PART}) AS BIGINT) AS part, count(*) AS n_turns,
  string_agg('{OPEN}' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM p JOIN k USING (conv_id) GROUP BY ALL"""
