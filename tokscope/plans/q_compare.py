"""Queries over the results table: summaries, grades, model comparison.

The results table is produced the way the reference produces it: the
evaluation writes one CSV per model (rounded columns) and the comparison
reads them back by file glob. Both steps are Spark jobs; the written table
lives under the session's checkpoint directory and is reused by every
comparison query of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.operators import compare, metrics
from tokscope.plans import evaluation
from tokscope.plans.catalog import register
from tokscope.plans.oracle import ORACLE, evaluate_sql, q
from tokscope.session import input_key, scratch_path
from tokscope.sinks import files
from tokscope.sources import corpus, results as rsrc

_WRITTEN: dict[tuple, str] = {}


def results_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = input_key(spark, f"{sf_dir}/documents.parquet")
    if key not in _WRITTEN:
        res = evaluation.evaluate(spark, corpus.documents(spark, sf_dir), n=None, max_chars=None,
                                  cont_docs=None)
        path = scratch_path(spark, "results")
        files.write_results_csv(res, path)
        _WRITTEN[key] = path
    return rsrc.load_results(spark, _WRITTEN[key])


R_SQL = f"""SELECT lang_code, lang_name, script, n_docs, n_words, n_tokens,
  round(fertility, 4) AS fertility, round(continuation_rate, 4) AS continuation_rate,
  round(bytes_per_token, 4) AS bytes_per_token, round(unk_rate, 6) AS unk_rate,
  round(vocab_coverage, 4) AS vocab_coverage, round(nsl, 4) AS nsl,
  round(avg_token_len, 4) AS avg_token_len, grade, model FROM ({evaluate_sql()})"""
MODELS = ["byte", "char", "script", "whitespace"]


@register("results_roundtrip")
def q_results_roundtrip(spark, sf_dir):
    """Evaluation -> results CSV per model -> glob read with file-derived model."""
    return results_table(spark, sf_dir)


ORACLE["results_roundtrip"] = R_SQL


@register("eval_summary")
def q_eval_summary(spark, sf_dir):
    return metrics.fertility_summary(results_table(spark, sf_dir)).select(
        "model", "best_fertility", "best_lang", "worst_fertility", "worst_lang",
        F.round("mean_fertility", 6).alias("mean_fertility"), "median_fertility", "n_langs")


ORACLE["eval_summary"] = f"""
SELECT model, min(fertility) AS best_fertility, first(lang_code ORDER BY fertility, lang_code) AS best_lang,
       max(fertility) AS worst_fertility, first(lang_code ORDER BY fertility DESC, lang_code) AS worst_lang,
       round(avg(fertility), 6) AS mean_fertility,
       list_sort(list(fertility))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median_fertility,
       CAST(count(*) AS BIGINT) AS n_langs
FROM ({R_SQL}) GROUP BY model
"""


@register("grade_distribution")
def q_grade_distribution(spark, sf_dir):
    return metrics.grade_distribution(results_table(spark, sf_dir))


ORACLE["grade_distribution"] = f"""
SELECT model, grade, array_to_string(list_sort(list(lang_name)), ', ') AS languages,
       CAST(count(*) AS BIGINT) AS n_langs FROM ({R_SQL}) GROUP BY model, grade
"""


@register("cmp_pivot_fertility")
def q_cmp_pivot(spark, sf_dir):
    return compare.pivot_metric(results_table(spark, sf_dir), "fertility", MODELS)


ORACLE["cmp_pivot_fertility"] = f"""
SELECT lang_code, lang_name, {", ".join(f"avg(CASE WHEN model = {q(m)} THEN fertility END) AS {m}" for m in MODELS)}
FROM ({R_SQL}) GROUP BY lang_code, lang_name
"""


@register("cmp_best")
def q_cmp_best(spark, sf_dir):
    return compare.best_per_language(results_table(spark, sf_dir))


def _best_sql() -> str:
    parts = []
    for m, lib in compare.BEST_METRICS:
        agg = "min" if lib else "max"
        parts.append(f"""SELECT {q(m)} AS metric, lang_code, lang_name, model, round(v, 3) AS value,
          abs(v - {agg}(v) OVER (PARTITION BY lang_code, lang_name)) < 1e-9 AS is_best,
          {'true' if lib else 'false'} AS lower_is_better
        FROM (SELECT lang_code, lang_name, model, avg({m}) AS v FROM ({R_SQL}) GROUP BY ALL)""")
    return "\nUNION ALL\n".join(parts)


ORACLE["cmp_best"] = _best_sql()


@register("cmp_summary")
def q_cmp_summary(spark, sf_dir):
    return compare.model_summary(results_table(spark, sf_dir))


ORACLE["cmp_summary"] = f"""
SELECT *, CAST(row_number() OVER (ORDER BY avg_fertility, model) AS BIGINT) AS rank FROM (
SELECT model, round(avg(fertility), 3) AS avg_fertility, round(avg(bytes_per_token), 3) AS avg_bytes_per_token,
       round(avg(vocab_coverage), 3) AS avg_vocab_coverage, round(avg(nsl), 3) AS avg_nsl,
       round(avg(continuation_rate), 3) AS avg_continuation_rate,
       CAST(count_if(fertility < 2.5) AS BIGINT) AS langs_good, CAST(count(*) AS BIGINT) AS n_langs
FROM ({R_SQL}) GROUP BY model)
"""


@register("cmp_counts")
def q_cmp_counts(spark, sf_dir):
    return compare.distinct_counts(results_table(spark, sf_dir))


ORACLE["cmp_counts"] = f"""
SELECT CAST(count(DISTINCT model) AS BIGINT) AS n_models, CAST(count(DISTINCT lang_code) AS BIGINT) AS n_langs
FROM ({R_SQL})
"""


@register("cmp_fertility_bars")
def q_cmp_bars(spark, sf_dir):
    return compare.fertility_bars(results_table(spark, sf_dir))


ORACLE["cmp_fertility_bars"] = f"""
SELECT lang_code, lang_name, model, round(f, 4) AS fertility, f > 1.0 AS show_label,
       CAST(CASE WHEN f < 1.5 THEN 0 WHEN f < 2.5 THEN 1 WHEN f < 4.0 THEN 2 ELSE 3 END AS INTEGER) AS band
FROM (SELECT lang_code, lang_name, model, avg(fertility) AS f FROM ({R_SQL}) GROUP BY ALL)
"""


@register("cmp_heatmap")
def q_cmp_heatmap(spark, sf_dir):
    return compare.heatmap(results_table(spark, sf_dir))


ORACLE["cmp_heatmap"] = f"""
SELECT model, lang_code, round(f, 4) AS fertility, round(least(greatest(f, 1.0), 8.0), 4) AS color_value
FROM (SELECT model, lang_code, avg(fertility) AS f FROM ({R_SQL}) GROUP BY ALL)
"""


@register("cmp_radar")
def q_cmp_radar(spark, sf_dir):
    return compare.radar(results_table(spark, sf_dir))


def _radar_sql() -> str:
    parts = []
    for m, inv, scale in compare.RADAR_AXES:
        norm = f"least(avg({m}) / {scale}, 1.0)"
        v = f"1.0 - {norm}" if inv else norm
        parts.append(f"SELECT model, {q(m)} AS axis, round(CAST({v} AS DOUBLE), 6) AS score "
                     f"FROM ({R_SQL}) GROUP BY model")
    return "\nUNION ALL\n".join(parts)


ORACLE["cmp_radar"] = _radar_sql()


@register("cmp_boxplot")
def q_cmp_boxplot(spark, sf_dir):
    return compare.boxplot(results_table(spark, sf_dir))


ORACLE["cmp_boxplot"] = f"""
WITH r AS ({R_SQL}),
qs AS (SELECT model, quantile_cont(fertility, 0.25) AS q1, quantile_cont(fertility, 0.5) AS median,
              quantile_cont(fertility, 0.75) AS q3 FROM r GROUP BY model),
j AS (SELECT r.model, r.fertility, qs.q1, qs.median, qs.q3,
             r.fertility >= qs.q1 - 1.5 * (qs.q3 - qs.q1) AND r.fertility <= qs.q3 + 1.5 * (qs.q3 - qs.q1) AS inside
      FROM r JOIN qs USING (model))
SELECT model, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN inside THEN fertility END), 6) AS whisker_lo,
       round(max(CASE WHEN inside THEN fertility END), 6) AS whisker_hi,
       CAST(count_if(NOT inside) AS BIGINT) AS n_outliers
FROM j GROUP BY model, q1, median, q3
"""


@register("cmp_trend")
def q_cmp_trend(spark, sf_dir):
    return compare.trend(results_table(spark, sf_dir))


ORACLE["cmp_trend"] = f"""
SELECT model, round(CASE WHEN isnan(regr_slope(fertility, vocab_coverage)) THEN NULL
                         ELSE regr_slope(fertility, vocab_coverage) END, 6) AS slope,
       round(regr_intercept(fertility, vocab_coverage), 6) AS intercept,
       CAST(count(*) AS BIGINT) AS n_points, min(vocab_coverage) AS x_min, max(vocab_coverage) AS x_max
FROM ({R_SQL}) WHERE fertility IS NOT NULL AND vocab_coverage IS NOT NULL
GROUP BY model HAVING count(*) > 2
"""


@register("cmp_grades")
def q_cmp_grades(spark, sf_dir):
    return compare.grade_counts(results_table(spark, sf_dir))


ORACLE["cmp_grades"] = f"""
SELECT model, CAST(count_if(fertility < 1.5) AS BIGINT) AS excellent,
       CAST(count_if(fertility >= 1.5 AND fertility < 2.5) AS BIGINT) AS good,
       CAST(count_if(fertility >= 2.5 AND fertility < 4.0) AS BIGINT) AS marginal,
       CAST(count_if(fertility >= 4.0 OR fertility IS NULL) AS BIGINT) AS poor
FROM ({R_SQL}) GROUP BY model
"""


@register("cmp_nsl")
def q_cmp_nsl(spark, sf_dir):
    return compare.nsl_lines(results_table(spark, sf_dir))


ORACLE["cmp_nsl"] = f"""
SELECT lang_code, lang_name, model, round(v, 4) AS nsl, v < 1.0 AS better_than_ref
FROM (SELECT lang_code, lang_name, model, avg(nsl) AS v FROM ({R_SQL}) GROUP BY ALL)
"""


@register("cmp_normalised")
def q_cmp_normalised(spark, sf_dir):
    return compare.normalised_scores(results_table(spark, sf_dir))


def _norm_sql() -> str:
    parts = []
    for m, inv in compare.NORMALISED_METRICS:
        norm = f"(avg({m}) - (SELECT min({m}) FROM r)) / ((SELECT max({m}) FROM r) - (SELECT min({m}) FROM r) + 1e-9)"
        v = f"1.0 - {norm}" if inv else norm
        parts.append(f"SELECT model, {q(m)} AS metric, round(CAST({v} AS DOUBLE), 6) AS score FROM r GROUP BY model")
    return f"WITH r AS ({R_SQL})\n" + "\nUNION ALL\n".join(parts)


ORACLE["cmp_normalised"] = _norm_sql()


@register("cmp_sorted")
def q_cmp_sorted(spark, sf_dir):
    return compare.sorted_results(results_table(spark, sf_dir))


ORACLE["cmp_sorted"] = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY fertility, lang_code) AS BIGINT) AS position
FROM ({R_SQL})
"""
