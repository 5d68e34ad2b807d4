"""Vocabulary queries: vocabularies derived from the corpus, set algebra, QA,
coverage and examples.

Base vocabulary = script pre-tokens of English (count >= 5); new vocabulary =
script pre-tokens of all other languages (count >= 5) plus the
four special tokens at ids 0-3; a second "new" vocabulary of whitespace words
from the mixed-script view carries mixed-script tokens for the QA query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.functions import text
from tokscope.operators import metrics, vocab
from tokscope.operators.tokenizers import TOKENIZERS
from tokscope.plans.catalog import register
from tokscope.plans.oracle import (ORACLE, PRETOK, WORD, assigned_cp_sql, clean_sql, div,
                                   lang_meta_values, q)
from tokscope.sources import corpus

MIN_COUNT = 5  # fixed value: minimum frequency of a vocabulary token
SPECIALS = text.SPECIAL_TOKENS


def _lang_tokens(spark: SparkSession, sf_dir: str, lang: str | None, model: str = "script",
                 mixed: bool = False) -> DataFrame:
    src = corpus.mixed_documents(spark, sf_dir) if mixed else corpus.documents(spark, sf_dir, indic=True)
    own = F.col("lang") == lang if lang == "eng" else F.col("lang") != "eng"
    docs = corpus.sample_eval(src.where(own))
    return docs.select(F.explode(TOKENIZERS[model].tokens(F.col("text"))).alias("token"))


def base_vocab(spark, sf_dir):
    return vocab.vocab_from_frequencies(vocab.token_frequencies(_lang_tokens(spark, sf_dir, "eng")), MIN_COUNT)


def new_vocab(spark, sf_dir):
    return vocab.vocab_from_frequencies(vocab.token_frequencies(_lang_tokens(spark, sf_dir, None)),
                                        MIN_COUNT, specials=SPECIALS)


def mixed_vocab(spark, sf_dir):
    f = vocab.token_frequencies(_lang_tokens(spark, sf_dir, None, "whitespace", mixed=True))
    return vocab.vocab_from_frequencies(f, MIN_COUNT)


def _freq_sql(lang: str | None, tok_expr: str, mixed: bool = False) -> str:
    return (f"SELECT token, count(*) AS freq FROM (SELECT unnest({tok_expr}) AS token FROM "
            f"({clean_sql(indic=not mixed, mixed=mixed)}) WHERE lang {'= ' + q(lang) if lang else '<> ' + q('eng')}) GROUP BY token")


BASE_SQL = f"SELECT token FROM ({_freq_sql('eng', f'regexp_extract_all(text, {q(PRETOK)})')}) WHERE freq >= {MIN_COUNT}"
NEW_BODY_SQL = f"SELECT token FROM ({_freq_sql(None, f'regexp_extract_all(text, {q(PRETOK)})')}) WHERE freq >= {MIN_COUNT}"
SPECIALS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({q(t)}, {i})" for i, t in enumerate(SPECIALS)) + ") AS s(token, id)"
MIXED_SQL = f"SELECT token FROM ({_freq_sql(None, f'regexp_extract_all(text, {q(WORD)})', mixed=True)}) WHERE freq >= {MIN_COUNT}"


@register("vocab_base")
def q_vocab_base(spark, sf_dir):
    """Vocabulary of a corpus slice: tokens with count >= 5, dense ids in
    code-point order (distributed numbering)."""
    return base_vocab(spark, sf_dir).select("token", "id")


ORACLE["vocab_base"] = f"""
SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS BIGINT) AS id FROM ({BASE_SQL})
"""


@register("vocab_novel")
def q_vocab_novel(spark, sf_dir):
    """new - specials - base, sorted (with its position)."""
    nov = vocab.novel_tokens(new_vocab(spark, sf_dir), base_vocab(spark, sf_dir))
    return vocab.dense_ids(nov, "token", "position")


ORACLE["vocab_novel"] = f"""
SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS BIGINT) AS position
FROM (SELECT token FROM ({NEW_BODY_SQL}) EXCEPT SELECT token FROM ({BASE_SQL}))
"""


@register("vocab_novel_keep_specials")
def q_vocab_novel_keep_specials(spark, sf_dir):
    """Merge-style difference: new - base with the special tokens kept."""
    return vocab.novel_tokens(new_vocab(spark, sf_dir), base_vocab(spark, sf_dir), drop_specials=False)


ORACLE["vocab_novel_keep_specials"] = f"""
SELECT token FROM (SELECT token FROM ({NEW_BODY_SQL}) UNION SELECT token FROM ({SPECIALS_SQL}))
EXCEPT SELECT token FROM ({BASE_SQL})
"""


@register("vocab_overlap")
def q_vocab_overlap(spark, sf_dir):
    return vocab.overlap_stats(new_vocab(spark, sf_dir), base_vocab(spark, sf_dir))


ORACLE["vocab_overlap"] = f"""
WITH b AS ({BASE_SQL}), n AS ({NEW_BODY_SQL}),
o AS (SELECT count(*) AS k FROM n JOIN b USING (token))
SELECT CAST((SELECT count(*) FROM b) AS BIGINT) AS base_size, CAST((SELECT count(*) FROM n) AS BIGINT) AS new_size,
       CAST((SELECT k FROM o) AS BIGINT) AS overlap,
       CAST((SELECT count(*) FROM n) - (SELECT k FROM o) AS BIGINT) AS novel,
       coalesce((SELECT array_to_string(list_sort(list(token)), ' ') FROM b WHERE token IN (SELECT token FROM ({SPECIALS_SQL}))), '') AS specials_in_base,
       (SELECT array_to_string(list_sort(list(token)), ' ') FROM ({SPECIALS_SQL})) AS specials_in_new
"""


@register("vocab_extend")
def q_vocab_extend(spark, sf_dir):
    """Base vocabulary with the novel tokens appended after its last id."""
    base = base_vocab(spark, sf_dir)
    return vocab.extend_vocab(base.select("token", "id"), vocab.novel_tokens(new_vocab(spark, sf_dir), base))


ORACLE["vocab_extend"] = f"""
WITH b AS (SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS BIGINT) AS id FROM ({BASE_SQL})),
nv AS (SELECT token FROM ({NEW_BODY_SQL}) EXCEPT SELECT token FROM b)
SELECT token, id FROM b
UNION ALL
SELECT token, CAST((SELECT coalesce(max(id), -1) FROM b) + row_number() OVER (ORDER BY token) AS BIGINT) AS id FROM nv
"""


@register("novel_qa")
def q_novel_qa(spark, sf_dir):
    nov = vocab.novel_tokens(new_vocab(spark, sf_dir), base_vocab(spark, sf_dir))
    return vocab.length_bucket_qa(nov)


ORACLE["novel_qa"] = f"""
WITH nv AS (SELECT token FROM ({NEW_BODY_SQL}) EXCEPT SELECT token FROM ({BASE_SQL})),
b AS (SELECT token, CASE WHEN length(token) <= 2 THEN 'short' WHEN length(token) <= 6 THEN 'medium' ELSE 'long' END AS bucket FROM nv)
SELECT bucket, CAST(count(*) AS BIGINT) AS n_tokens, array_to_string(list_slice(list_sort(list(token)), 1, 10), ' ') AS samples
FROM b GROUP BY bucket
"""


@register("mixed_script_tokens")
def q_mixed_script(spark, sf_dir):
    """Every mixed-script vocabulary token, with their total."""
    return vocab.mixed_script_tokens(mixed_vocab(spark, sf_dir))


ORACLE["mixed_script_tokens"] = f"""
WITH m AS (SELECT token FROM ({MIXED_SQL}) WHERE regexp_matches(token, '\\p{{Latin}}') AND regexp_matches(token, '[\\x{{0900}}-\\x{{0D7F}}]'))
SELECT token, CAST((SELECT count(*) FROM m) AS BIGINT) AS n_mixed FROM m
"""


@register("vocab_coverage")
def q_vocab_coverage(spark, sf_dir):
    """Per language: share of assigned script code points that start a token
    of the new vocabulary."""
    return vocab.vocab_coverage(spark, new_vocab(spark, sf_dir))


ORACLE["vocab_coverage"] = f"""
WITH v AS (SELECT token FROM ({NEW_BODY_SQL}) UNION ALL SELECT token FROM ({SPECIALS_SQL})),
fc AS (SELECT DISTINCT substring(ltrim(token, {q(text.COVERAGE_MARKERS)}), 1, 1) AS ch FROM v
       WHERE length(ltrim(token, {q(text.COVERAGE_MARKERS)})) > 0),
lm AS (SELECT * FROM {lang_meta_values()}),
cps AS ({assigned_cp_sql()}),
lcp AS (SELECT lm.lang_code, cps.ch FROM lm JOIN cps ON lm.cp_lo = cps.cp_lo AND lm.cp_hi = cps.cp_hi)
SELECT lang_code, {div('count(fc.ch)', 'count(*)')} AS vocab_coverage
FROM lcp LEFT JOIN fc ON lcp.ch = fc.ch GROUP BY lang_code
"""


@register("examples")
def q_examples(spark, sf_dir):
    """First two documents per language: example sentence (120 chars, newlines
    as spaces), script-token preview (30 tokens, `` | ``), first 20 tokens,
    counts and local fertility."""
    s = corpus.sample_eval(corpus.documents(spark, sf_dir, indic=True), n=None, max_chars=None)
    return metrics.examples(spark, s, "script")


def _examples_sql() -> str:
    toks = f"regexp_extract_all(sentence, {q(PRETOK)})"
    return f"""
WITH s AS (SELECT doc_id, lang, replace(substring(text, 1, 120), chr(10), ' ') AS sentence,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM ({clean_sql(indic=True)})),
t AS (SELECT doc_id, lang, sentence, {toks} AS toks FROM s WHERE rn <= 2)
SELECT 'script' AS model, lang AS lang_code, doc_id, sentence,
       CASE WHEN len(toks) > 30 THEN array_to_string(list_slice(toks, 1, 30), ' | ') || ' ... (+' || CAST(len(toks) - 30 AS VARCHAR) || ' more)'
            ELSE array_to_string(toks, ' | ') END AS preview,
       array_to_string(list_slice(toks, 1, 20), ' ') AS tokens20,
       CAST(len(toks) AS BIGINT) AS n_tokens,
       CAST(len(regexp_extract_all(sentence, {q(WORD)})) AS BIGINT) AS n_words,
       CAST(len(toks) AS DOUBLE) / greatest(1, len(regexp_extract_all(sentence, {q(WORD)}))) AS local_fertility
FROM t"""


ORACLE["examples"] = _examples_sql()
