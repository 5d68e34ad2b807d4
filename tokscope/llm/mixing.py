"""Mixing sources to target weights: iterative proportional fitting over (source, language, topic) cells, then Poisson
sampling of documents with calibrated probabilities. DataFrame functions only.

Flow. One scan gives each document its token count and topic; the narrow rows are checkpointed and summed to cells (combined
before the shuffle). Each of ``ROUNDS`` rounds scales the cell weights to the source, language and topic targets in turn.
A cell's inclusion probability is min(1, c * weight / tokens), with c such that the expected tokens are ``budget`` of all:
c is raised until the cells at probability 1 no longer change. A document is kept if a number from the md5 of its id is below
the probability of its cell, so decisions need no random state.

The default target of a value is proportional to a power of its share of the tokens (``POWERS``); others are given as mappings.
A topic is the first pattern of ``TOPICS`` that a text holds.

Defined cases: null source or language is a value of its own; null or empty text has 0 tokens and topic ``general``; such
documents keep probability 1 if their cell has no tokens; rows without id are decided by their text; repeated rows are
decided alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokscope.llm.common import fresh, settle, written

DIMS = ("source", "lang", "topic")
POWERS = {"source": 0.7, "lang": 0.5, "topic": 0.5}
ROUNDS = 8
BUDGET = 0.5
TOKEN = r"[^\x20\x09-\x0D]+"
#: Topics and the patterns that mark them, first match first.
TOPICS = (("legal", r"[Ll]icen[sc]e|[Cc]opyright"), ("contact", r"[0-9A-Za-z]@[0-9A-Za-z]|https?://"), ("table", r" \| "))
OTHER_TOPIC = "general"


def topic_of(text: Column) -> Column:
    c = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS):
        c = F.when(text.rlike(pattern), F.lit(name)).otherwise(c)
    return c


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)).cast("bigint"), F.lit(0).cast("bigint"))


def _key(c: str) -> Column:
    """A text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def described(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, tokens, draw (0 to 1) of every row, checkpointed."""
    text = F.col("text")
    said = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), text), F.lit(""))
    draw = F.conv(F.substring(F.md5(said.cast("binary")), 1, 13), 16, 10).cast("double") / float(16 ** 13)
    return settle(docs.select("doc_id", "source", "lang", topic_of(text).alias("topic"), tokens_of(text).alias("tokens"), draw.alias("draw")))


def targets(cells: DataFrame, dim: str, given: Mapping[str, float] | None) -> DataFrame:
    """<dim>_key, goal: tokens that the weights of each value of ``dim`` must sum to."""
    per = cells.groupBy(f"{dim}_key").agg(F.sum("tokens").cast("double").alias("t"))
    if given is None:
        raw = F.pow(F.col("t"), F.lit(POWERS[dim]))
    else:
        known = F.create_map(*[F.lit(x) for v, s in given.items() for x in (f"={v}", float(s))]) if given else F.create_map()
        raw = F.coalesce(known[F.col(f"{dim}_key")], F.lit(0.0)) if given else F.lit(0.0)
    rows = per.select(f"{dim}_key", "t", F.when(F.col("t") > 0, raw).otherwise(0.0).alias("raw"))
    sums = rows.agg(F.sum("t").alias("all_t"), F.sum("raw").alias("all_raw")).first()
    scale = sums.all_t / sums.all_raw if sums.all_raw else 0.0
    return settle(rows.select(f"{dim}_key", (F.col("raw") * scale).alias("goal")))


def rake(cells: DataFrame, goals: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with a weight (tokens after fitting): each round meets the goals of every dimension in turn."""
    state = cells.withColumn("weight", F.col("tokens").cast("double"))
    named = {dim: f"goal_{dim}" for dim in goals}
    for dim, goal in goals.items():             # carried along, so that a step has one join
        state = state.join(goal.withColumnRenamed("goal", named[dim]), f"{dim}_key")
    state = written(state, "rake")
    for _ in range(rounds):
        for dim in goals:
            now = state.groupBy(f"{dim}_key").agg(F.sum("weight").alias("now"))
            factor = F.when(F.col("now") > 0, F.col(named[dim]) / F.col("now")).otherwise(0.0)
            state = state.join(now, f"{dim}_key").withColumn("weight", F.col("weight") * factor).drop("now")
        state = written(state, "rake")      # a table: a checkpoint would carry ever longer constraints from round to round
    return state.drop(*named.values())


def calibrate(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``cells`` with prob = min(1, c * weight / tokens) such that the expected tokens are ``budget`` of all (or all that have weight)."""
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    c, full = 0.0, -1
    while True:
        at_one = ratio * c >= 1 if c else F.lit(False)
        s = cells.agg(F.sum("tokens").alias("t"), F.sum(F.when(at_one, F.col("tokens")).otherwise(0)).alias("at_one"), F.count(F.when(at_one, 1)).alias("n"),
                      F.sum(F.when(at_one, 0.0).otherwise(F.col("weight"))).alias("rest")).first()
        if not s.t or s.n == full or not s.rest:
            break
        full, c = s.n, max(c, (budget * s.t - s.at_one) / s.rest)
    return cells.withColumn("prob", F.coalesce(F.least(F.lit(1.0), ratio * c), F.lit(1.0)))


def mixed(docs: DataFrame, goals: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """source_key, lang_key, topic_key, tokens, weight, prob of every cell of ``described`` rows."""
    keyed = docs.select(*(_key(d).alias(f"{d}_key") for d in DIMS), "tokens")
    cells = settle(keyed.groupBy(*(f"{d}_key" for d in DIMS)).agg(F.sum("tokens").alias("tokens")))
    wanted = {d: targets(cells, d, (goals or {}).get(d)) for d in DIMS}
    return settle(calibrate(rake(cells, wanted, rounds), budget))


def op3_mixing(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight (per token), prob, sampled for every row of ``docs``."""
    rows = described(docs)
    cells = mixed(rows)
    keyed = rows.select("*", *(_key(d).alias(f"{d}_key") for d in DIMS))
    out = keyed.join(cells.withColumnRenamed("tokens", "cell_tokens"), [f"{d}_key" for d in DIMS])
    per = F.when(F.col("cell_tokens") > 0, F.col("weight") / F.col("cell_tokens")).otherwise(0.0)
    return out.select("doc_id", "source", "lang", "topic", "tokens", F.round(per, 6).alias("weight"), F.round("prob", 6).alias("prob"),
                      (F.col("draw") < F.col("prob")).alias("sampled"))


def sample(docs: DataFrame, goals: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """The rows of ``docs`` (same columns) drawn with the calibrated probabilities."""
    rows = described(docs)
    cells = mixed(rows, goals, budget)
    sk, lk, tk, d = fresh(docs, "sk", "lk", "tk", "draw")
    a, b, c, p = fresh(docs, "a", "b", "c", "p")
    said = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.col("text")), F.lit(""))
    draw = F.conv(F.substring(F.md5(said.cast("binary")), 1, 13), 16, 10).cast("double") / float(16 ** 13)
    keyed = docs.withColumns({sk: _key("source"), lk: _key("lang"), tk: F.concat(F.lit("="), topic_of(F.col("text"))), d: draw})
    probs = cells.select(F.col("source_key").alias(a), F.col("lang_key").alias(b), F.col("topic_key").alias(c), F.col("prob").alias(p))
    on = (F.col(sk) == F.col(a)) & (F.col(lk) == F.col(b)) & (F.col(tk) == F.col(c))
    return keyed.join(probs, on).filter(F.col(d) < F.col(p)).select(*docs.columns)


def _sql() -> str:
    """DuckDB SQL of ``op3_mixing``: the rounds are unrolled, the budget is met by the order of weights per token."""
    topic = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)
    keys = ", ".join(f"{d}_key" for d in DIMS)
    out = [f"""WITH d AS (SELECT doc_id, source, lang, CASE {topic} ELSE '{OTHER_TOPIC}' END AS topic,
  CAST(coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) AS BIGINT) AS tokens,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 't' || text, '')), 1, 13)) AS BIGINT) / CAST({16 ** 13} AS DOUBLE) AS draw FROM documents),
k AS (SELECT *, {', '.join(f"coalesce('=' || {d}, '') AS {d}_key" for d in DIMS)} FROM d),
c AS (SELECT {keys}, CAST(sum(tokens) AS BIGINT) AS tokens FROM k GROUP BY ALL)"""]
    for d in DIMS:
        out.append(f"""p_{d} AS (SELECT {d}_key, CAST(sum(tokens) AS DOUBLE) AS t FROM c GROUP BY 1),
q_{d} AS (SELECT *, CASE WHEN t > 0 THEN pow(t, {POWERS[d]}) ELSE 0 END AS raw FROM p_{d}),
g_{d} AS (SELECT {d}_key, raw * (SELECT sum(t) / sum(raw) FROM q_{d}) AS goal FROM q_{d})""")
    out.append(f"w0 AS (SELECT {keys}, tokens, CAST(tokens AS DOUBLE) AS weight FROM c)")
    n = 0
    for _ in range(ROUNDS):
        for d in DIMS:
            out.append(f"""w{n + 1} AS MATERIALIZED (SELECT {keys}, tokens, CASE WHEN sum(weight) OVER (PARTITION BY {d}_key) > 0
  THEN weight * goal / sum(weight) OVER (PARTITION BY {d}_key) ELSE 0 END AS weight FROM w{n} JOIN g_{d} USING ({d}_key))""")
            n += 1
    out.append(f"""r AS (SELECT *, weight / nullif(tokens, 0) AS ratio FROM w{n}),
o AS (SELECT ratio, (SELECT {BUDGET} * sum(tokens) FROM c) AS b, coalesce(sum(tokens) OVER h, 0) AS before, sum(weight) OVER () - coalesce(sum(weight) OVER h, 0) AS rest
  FROM r WHERE ratio IS NOT NULL WINDOW h AS (ORDER BY ratio DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)),
s AS (SELECT max((b - before) / rest) AS c FROM o WHERE (b - before) / rest * ratio < 1),
f AS (SELECT r.*, coalesce(least(1.0, ratio * s.c), 1.0) AS prob FROM r, s)
SELECT k.doc_id, k.source, k.lang, k.topic, k.tokens, round(CASE WHEN f.tokens > 0 THEN f.weight / f.tokens ELSE 0 END, 6) AS weight,
  round(f.prob, 6) AS prob, k.draw < f.prob AS sampled FROM k JOIN f USING ({keys})""")
    return ",\n".join(out)


ORACLE_SQL = _sql()
