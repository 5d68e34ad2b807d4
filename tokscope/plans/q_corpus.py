"""Queries over the corpus: samples, ingest counts, pre-tokens, summaries, examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.functions import langmeta, pretok, text
from tokscope.operators import metrics, vocab
from tokscope.plans.catalog import register
from tokscope.plans.oracle import (NON_WS, ORACLE, PRETOK, WORD, clean_sql, docs_sql,
                                   grade_train_sql, q, strip_sql)
from tokscope.sources import corpus


from tokscope.plans.oracle import evaluate_sql  # noqa: E402

ORACLE["evaluate_reference_sample"] = evaluate_sql(indic=True, n=1000, max_chars=2000, cont_docs=200)


# ---------------------------------------------------------------- samples ---
@register("sample_eval")
def q_sample_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation sampler with the reference parameters (its feature: first
    1000 kept docs per language, each cut to 2000 code points)."""
    s = corpus.sample_eval(corpus.documents(spark, sf_dir), n=corpus.SAMPLES_PER_LANG, max_chars=corpus.MAX_CHARS_PER_DOC)
    return s.select("doc_id", "lang", text.n_chars("text").alias("n_chars"),
                    text.n_bytes("text").alias("n_bytes"), F.md5("text").alias("text_md5"))


ORACLE["sample_eval"] = f"""
SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS n_chars, CAST(strlen(text) AS BIGINT) AS n_bytes,
       md5(text) AS text_md5
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
      FROM ({clean_sql(max_chars=2000)})) WHERE rn <= 1000
"""


@register("sample_fertility")
def q_sample_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = corpus.sample_fertility(corpus.documents(spark, sf_dir), n=corpus.MAX_TEST_DOCS)
    return s.select("doc_id", "lang", text.n_chars("text").alias("n_chars"))


ORACLE["sample_fertility"] = f"""
SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS n_chars
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
      FROM ({clean_sql(min_chars=20)})) WHERE rn <= 5000
"""


@register("ingest_counts")
def q_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept docs per language: cap-before-filter (training) vs cap-after-filter
    (add-on), both with the reference cap of 200 000."""
    docs = corpus.documents(spark, sf_dir)
    a = corpus.kept_counts(corpus.ingest_cap_before_filter(docs, cap=corpus.MAX_TRAIN_DOCS)).withColumnRenamed("kept", "kept_train")
    b = corpus.kept_counts(corpus.ingest_cap_after_filter(docs, cap=corpus.MAX_TRAIN_DOCS)).withColumnRenamed("kept", "kept_addon")
    return a.join(b, "lang", "full").select(
        "lang", F.coalesce("kept_train", F.lit(0)).cast("bigint").alias("kept_train"),
        F.coalesce("kept_addon", F.lit(0)).cast("bigint").alias("kept_addon"))


ORACLE["ingest_counts"] = f"""
WITH raw AS (SELECT doc_id, lang, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
             FROM documents),
tr AS (SELECT lang, count(*) AS k FROM (SELECT lang, {strip_sql('text')} AS t FROM raw WHERE rn <= 200000)
       WHERE length(t) > 20 GROUP BY lang),
ad AS (SELECT lang, count(*) AS k FROM (
         SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn2
         FROM (SELECT doc_id, lang, {strip_sql('text')} AS t FROM documents) WHERE length(t) > 20)
       WHERE rn2 <= 200000 GROUP BY lang)
SELECT coalesce(tr.lang, ad.lang) AS lang, CAST(coalesce(tr.k, 0) AS BIGINT) AS kept_train,
       CAST(coalesce(ad.k, 0) AS BIGINT) AS kept_addon
FROM tr FULL OUTER JOIN ad ON tr.lang = ad.lang
"""


@register("language_report")
def q_language_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known language with its document count in the Indic view;
    requested-but-absent languages are reported with present = false."""
    docs = corpus.documents(spark, sf_dir, indic=True)
    return corpus.language_report(spark, docs)


ORACLE["language_report"] = f"""
WITH lm AS (SELECT * FROM (VALUES {", ".join(f"({q(c)}, {q(n)})" for c, n, *_ in langmeta.all_lang_meta())})
            AS t(lang_code, lang_name)),
c AS (SELECT lang, count(*) AS n FROM ({docs_sql(indic=True)}) GROUP BY lang)
SELECT lm.lang_code, lm.lang_name, CAST(coalesce(c.n, 0) AS BIGINT) AS n_docs, c.n IS NOT NULL AS present
FROM lm LEFT JOIN c ON lm.lang_code = c.lang
"""


REQUESTED = ["hin", "xyz", "ben", "zzz", "eng"]


@register("language_requested")
def q_language_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given list of languages, absent and unknown ones too (those have no name)."""
    return corpus.language_report(spark, corpus.documents(spark, sf_dir, indic=True), requested=REQUESTED)


ORACLE["language_requested"] = f"""
WITH r AS (SELECT unnest([{", ".join(map(q, REQUESTED))}]) AS lang_code),
lm AS (SELECT * FROM (VALUES {", ".join(f"({q(c)}, {q(n)})" for c, n, *_ in langmeta.all_lang_meta())}) AS t(lang_code, lang_name)),
c AS (SELECT lang, count(*) AS n FROM ({docs_sql(indic=True)}) GROUP BY lang)
SELECT r.lang_code, lm.lang_name, CAST(coalesce(c.n, 0) AS BIGINT) AS n_docs, c.n IS NOT NULL AS present
FROM r LEFT JOIN lm USING (lang_code) LEFT JOIN c ON r.lang_code = c.lang
"""


@register("subset_counts")
def q_subset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the smaller language subset only (semi join on lang)."""
    docs = corpus.select_subset(spark, corpus.documents(spark, sf_dir, indic=True), "unverified")
    return docs.groupBy("lang").agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"))


ORACLE["subset_counts"] = f"""
SELECT lang, CAST(count(*) AS BIGINT) AS n_docs FROM ({docs_sql(indic=True)})
WHERE lang IN ({", ".join(q(c) for c in langmeta.UNVERIFIED_CODES)}) GROUP BY lang
"""


# ------------------------------------------------------------- pre-tokens ---
@register("pretoken_classes")
def q_pretoken_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-token counts per language and script class on the mixed-script view."""
    docs = corpus.sample_eval(corpus.mixed_documents(spark, sf_dir), n=None, max_chars=None)
    toks = docs.select("lang", F.explode(pretok.pretokens("text")).alias("tok"))
    return (toks.select("lang", pretok.script_class("tok").alias("script_class"),
                        F.length("tok").alias("n"))
            .groupBy("lang", "script_class")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_tokens"),
                 F.sum("n").cast("bigint").alias("n_chars")))


def _script_class_sql(col: str) -> str:
    parts = [f"WHEN regexp_matches({col}, {q('^[' + cls + ']')}) THEN {q(name)}"
             for name, cls in pretok.SCRIPT_BLOCKS]
    return "CASE " + " ".join(parts) + f" WHEN regexp_matches({col}, '^[0-9]') THEN 'Digits' ELSE 'Other' END"


ORACLE["pretoken_classes"] = f"""
WITH t AS (SELECT lang, unnest(regexp_extract_all(text, {q(PRETOK)})) AS tok
           FROM ({clean_sql(mixed=True)}))
SELECT lang, {_script_class_sql('tok')} AS script_class, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(sum(length(tok)) AS BIGINT) AS n_chars
FROM t GROUP BY ALL
"""


@register("pretoken_freq")
def q_pretoken_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-token frequency table over the whole corpus (Indic view)."""
    docs = corpus.sample_eval(corpus.documents(spark, sf_dir, indic=True), n=None, max_chars=None)
    return vocab.pretoken_frequencies(docs)


ORACLE["pretoken_freq"] = f"""
SELECT token, CAST(count(*) AS BIGINT) AS freq FROM
  (SELECT unnest(regexp_extract_all(text, {q(PRETOK)})) AS token FROM ({clean_sql(indic=True)}))
GROUP BY token
"""


@register("pretoken_spans")
def q_pretoken_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens with code-point spans (start inclusive, end exclusive) on the
    mixed-script view; offsets are relative to the stripped text."""
    docs = corpus.sample_eval(corpus.mixed_documents(spark, sf_dir), n=None, max_chars=None)
    return pretok.pretoken_spans(docs)


ORACLE["pretoken_spans"] = f"""
WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, {q(pretok.PRETOKEN_SPAN_RE)})) AS tok,
                  unnest(generate_series(1, len(regexp_extract_all(text, {q(pretok.PRETOKEN_SPAN_RE)})))) AS i
           FROM ({clean_sql(mixed=True)})),
o AS (SELECT doc_id, i, tok, sum(length(tok)) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM m)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS BIGINT) AS pos, tok AS token,
       CAST(e - length(tok) AS BIGINT) AS span_start, CAST(e AS BIGINT) AS span_end
FROM o WHERE regexp_matches(tok, {q(NON_WS)})
"""


@register("processed_lines")
def q_processed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-file lines (one per line of each stripped doc, universal
    newlines, stripped, empties dropped) rewritten as space-joined pre-tokens."""
    docs = corpus.ingest_cap_before_filter(corpus.documents(spark, sf_dir, indic=True), cap=None)
    lines = corpus.text_lines(docs)
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"),
                        pretok.pretokenized_text("line").alias("processed"))


ORACLE["processed_lines"] = f"""
WITH d AS (SELECT doc_id, {strip_sql('text')} AS t FROM ({docs_sql(indic=True)})),
k AS (SELECT doc_id, t FROM d WHERE length(t) > 20),
l AS (SELECT doc_id, unnest(regexp_split_to_array(t, '\\r\\n|\\r|\\n')) AS line,
             unnest(generate_series(0, len(regexp_split_to_array(t, '\\r\\n|\\r|\\n')) - 1)) AS line_no FROM k),
s AS (SELECT doc_id, line_no, {strip_sql('line')} AS line FROM l)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no,
       array_to_string(regexp_extract_all(line, {q(PRETOK)}), ' ') AS processed
FROM s WHERE length(line) > 0
"""


# --------------------------------------------------- fertility record (MET2)
def _fertility_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language over all documents of at least 20 characters: the
    text is pre-tokenized, space-joined and encoded (script model here)."""
    s = corpus.sample_fertility(corpus.documents(spark, sf_dir, indic=True))
    per_doc = s.select("lang", text.n_words("text").alias("n_words"),
                       F.size(pretok.pretokens(pretok.pretokenized_text("text"))).cast("bigint").alias("n_tok"))
    return metrics.fertility_pretok(per_doc)


@register("fertility_record")
def q_fertility_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fertility_record(spark, sf_dir)


_FERT_SQL = f"""
SELECT lang, round(CAST(tt AS DOUBLE) / CAST(tw AS DOUBLE), 3) AS fertility, tw AS total_words,
       tt AS total_tokens, docs,
       {grade_train_sql('round(CAST(tt AS DOUBLE) / CAST(tw AS DOUBLE), 3)')} AS rating
FROM (SELECT lang, CAST(sum(len(regexp_extract_all(text, {q(WORD)}))) AS BIGINT) AS tw,
             CAST(sum(len(regexp_extract_all(array_to_string(regexp_extract_all(text, {q(PRETOK)}), ' '), {q(PRETOK)}))) AS BIGINT) AS tt,
             CAST(count(*) AS BIGINT) AS docs
      FROM ({clean_sql(indic=True, min_chars=20)}) GROUP BY lang)
WHERE tw > 0
"""
ORACLE["fertility_record"] = _FERT_SQL


@register("macro_fertility")
def q_macro_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.macro_fertility(_fertility_record(spark, sf_dir))


ORACLE["macro_fertility"] = f"""
SELECT round(CAST(coalesce(avg(fertility), 0.0) AS DOUBLE), 6) AS macro_fertility, CAST(count(*) AS BIGINT) AS n_langs
FROM ({_FERT_SQL})
"""
