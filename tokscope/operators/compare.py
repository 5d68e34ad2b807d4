"""Comparison of several tokenizers' result tables.

Input: the combined ``results`` table (one row per model x language). All
operators are aggregates over it; the few post-aggregation windows run over
per-model or per-language rows, whose number is bounded by models x languages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokscope.functions.text import GRADE_B_LABELS, grade_train_label

# --- fixed values ------------------------------------------------------------
# (metric, lower is better) for the per-language best-of tables
BEST_METRICS = [("fertility", True), ("bytes_per_token", False), ("vocab_coverage", False),
                ("nsl", True)]
# radar axes: (metric, inverted, scale)
RADAR_AXES = [("fertility", True, 10.0), ("bytes_per_token", False, 12.0),
              ("vocab_coverage", False, 1.0), ("nsl", True, 5.0), ("continuation_rate", True, 1.0)]
# normalised summary: (metric, inverted)
NORMALISED_METRICS = [("fertility", True), ("bytes_per_token", False), ("vocab_coverage", False),
                      ("continuation_rate", True), ("nsl", True)]
FERTILITY_BANDS = [1.5, 2.5, 4.0]
HEATMAP_RANGE = (1.0, 8.0)
BEST_EPS = 1e-9
GOOD_FERTILITY = 2.5
# -----------------------------------------------------------------------------


def combine(*frames: DataFrame) -> DataFrame:
    """Row concatenation of several result tables (by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def pivot_metric(results: DataFrame, metric: str, models: list[str] | None = None) -> DataFrame:
    """(lang_code, lang_name) x model, mean of ``metric``; NULL where missing.
    Pass ``models`` to skip the distinct-values job."""
    g = results.groupBy("lang_code", "lang_name")
    p = g.pivot("model", models) if models is not None else g.pivot("model")
    return p.agg(F.avg(metric))


def long_metrics(results: DataFrame, metrics: list[str]) -> DataFrame:
    """model, lang_code, lang_name, metric, value (unpivot)."""
    return results.unpivot(["model", "lang_code", "lang_name"], metrics, "metric", "value")


def best_per_language(results: DataFrame, spec=BEST_METRICS, dp: int = 3) -> DataFrame:
    """For each metric and language: every model's mean value (3 dp) and
    whether it is the best (min or max across models ignoring NULLs, ties
    within 1e-9 all marked)."""
    lower = F.create_map(*[x for m, lib in spec for x in (F.lit(m), F.lit(lib))])
    means = (long_metrics(results, [m for m, _ in spec])
             .groupBy("metric", "lang_code", "lang_name", "model").agg(F.avg("value").alias("value")))
    w = Window.partitionBy("metric", "lang_code", "lang_name")
    lib = lower[F.col("metric")]
    best = F.when(lib, F.min("value").over(w)).otherwise(F.max("value").over(w))
    return means.select("metric", "lang_code", "lang_name", "model",
                        F.round("value", dp).alias("value"),
                        (F.abs(F.col("value") - best) < BEST_EPS).alias("is_best"),
                        lib.alias("lower_is_better"))


def model_summary(results: DataFrame) -> DataFrame:
    """Per model: mean fertility, bytes/token, coverage, NSL, continuation;
    languages with fertility < 2.5 out of n; ``rank`` by the 3-dp mean
    fertility, ties in model-name order (the file order of the inputs)."""
    agg = results.groupBy("model").agg(
        F.avg("fertility").alias("avg_fertility"), F.avg("bytes_per_token").alias("avg_bytes_per_token"),
        F.avg("vocab_coverage").alias("avg_vocab_coverage"), F.avg("nsl").alias("avg_nsl"),
        F.avg("continuation_rate").alias("avg_continuation_rate"),
        F.count_if(F.col("fertility") < GOOD_FERTILITY).cast("bigint").alias("langs_good"),
        F.count(F.lit(1)).cast("bigint").alias("n_langs"))
    rounded = agg.select("model", *[F.round(c, 3).alias(c) for c in agg.columns if c.startswith("avg_")],
                         "langs_good", "n_langs")
    # bounded window: one row per model
    w = Window.orderBy(F.col("avg_fertility"), F.col("model"))
    return rounded.withColumn("rank", F.row_number().over(w).cast("bigint"))


def distinct_counts(results: DataFrame) -> DataFrame:
    return results.agg(F.countDistinct("model").cast("bigint").alias("n_models"),
                       F.countDistinct("lang_code").cast("bigint").alias("n_langs"))


def fertility_bars(results: DataFrame) -> DataFrame:
    """Long bar data: value label shown when > 1.0, band index by 1.5/2.5/4.0."""
    f = F.col("fertility")
    band = F.when(f < FERTILITY_BANDS[0], 0).when(f < FERTILITY_BANDS[1], 1).when(
        f < FERTILITY_BANDS[2], 2).otherwise(3)
    return (results.groupBy("lang_code", "lang_name", "model").agg(F.avg("fertility").alias("fertility"))
            .select("lang_code", "lang_name", "model", F.round("fertility", 4).alias("fertility"),
                    (F.col("fertility") > 1.0).alias("show_label"), band.cast("int").alias("band")))


def heatmap(results: DataFrame) -> DataFrame:
    """Model x language fertility with the colour value clipped to [1, 8]."""
    lo, hi = HEATMAP_RANGE
    m = results.groupBy("model", "lang_code").agg(F.avg("fertility").alias("fertility"))
    return m.select("model", "lang_code", F.round("fertility", 4).alias("fertility"),
                    F.round(F.least(F.greatest("fertility", F.lit(lo)), F.lit(hi)), 4).alias("color_value"))


def radar(results: DataFrame) -> DataFrame:
    """Per model and axis: min(mean / scale, 1), inverted (1 - x) where lower is better."""
    aggs = [F.avg(m).alias(m) for m, _, _ in RADAR_AXES]
    per = results.groupBy("model").agg(*aggs)
    rows = []
    for m, inv, scale in RADAR_AXES:
        norm = F.least(F.col(m) / F.lit(scale), F.lit(1.0))
        v = (F.lit(1.0) - norm) if inv else norm
        rows.append(F.struct(F.lit(m).alias("axis"), F.round(v, 6).alias("score")))
    return per.select("model", F.explode(F.array(*rows)).alias("r")).select("model", "r.axis", "r.score")


def boxplot(results: DataFrame) -> DataFrame:
    """Per model: quartiles (linear interpolation) and whiskers = most extreme
    values inside 1.5 IQR fences."""
    q = results.groupBy("model").agg(
        F.percentile("fertility", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    q = q.select("model", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    j = results.select("model", "fertility").join(q, "model")
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("fertility") >= F.col("q1") - 1.5 * iqr) & (F.col("fertility") <= F.col("q3") + 1.5 * iqr)
    w = j.groupBy("model", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("fertility"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("fertility"))).alias("whisker_hi"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"))
    return w.select("model", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                    "n_outliers")


def trend(results: DataFrame) -> DataFrame:
    """Per model: least-squares line fertility ~ coverage over non-null
    points, only when more than 2 points; x range for drawing. A constant x
    gives a NULL slope."""
    ok = results.where(F.col("fertility").isNotNull() & F.col("vocab_coverage").isNotNull() &
                       ~F.isnan("fertility") & ~F.isnan("vocab_coverage"))
    agg = ok.groupBy("model").agg(
        F.regr_slope("fertility", "vocab_coverage").alias("slope"),
        F.regr_intercept("fertility", "vocab_coverage").alias("intercept"),
        F.count(F.lit(1)).cast("bigint").alias("n_points"),
        F.min("vocab_coverage").alias("x_min"), F.max("vocab_coverage").alias("x_max"))
    return agg.where(F.col("n_points") > 2).select(
        "model", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"),
        "n_points", "x_min", "x_max")


def grade_counts(results: DataFrame) -> DataFrame:
    """Per model: number of languages per training-style grade band,
    zero-filled, fixed column order."""
    g = results.withColumn("band", grade_train_label("fertility"))
    p = g.groupBy("model").pivot("band", GRADE_B_LABELS).count().na.fill(0)
    names = ["excellent", "good", "marginal", "poor"]
    return p.select("model", *[F.col(f"`{lab}`").cast("bigint").alias(n) for lab, n in zip(GRADE_B_LABELS, names)])


def nsl_lines(results: DataFrame) -> DataFrame:
    """Per language and model: NSL and whether it beats the reference (< 1)."""
    m = results.groupBy("lang_code", "lang_name", "model").agg(F.avg("nsl").alias("nsl"))
    return m.select("lang_code", "lang_name", "model", F.round("nsl", 4).alias("nsl"),
                    (F.col("nsl") < 1.0).alias("better_than_ref"))


def normalised_scores(results: DataFrame) -> DataFrame:
    """(mean_model - min_all) / (max_all - min_all + 1e-9), inverted where
    lower is better; min/max over ALL rows. The global min/max is a one-row
    aggregate joined to the per-model means (no cross product of rows)."""
    metrics = [m for m, _ in NORMALISED_METRICS]
    per = long_metrics(results, metrics).groupBy("model", "metric").agg(F.avg("value").alias("avg"))
    glob = long_metrics(results, metrics).groupBy("metric").agg(F.min("value").alias("lo"),
                                                                F.max("value").alias("hi"))
    inv = F.create_map(*[x for m, i in NORMALISED_METRICS for x in (F.lit(m), F.lit(i))])
    norm = (F.col("avg") - F.col("lo")) / (F.col("hi") - F.col("lo") + F.lit(1e-9))
    return (per.join(F.broadcast(glob), "metric")
            .select("model", "metric", F.round(F.when(inv[F.col("metric")], 1.0 - norm).otherwise(norm), 6)
                    .alias("score")))


def sorted_results(results: DataFrame) -> DataFrame:
    """Result rows with their position when sorted by fertility within a model."""
    w = Window.partitionBy("model").orderBy("fertility", "lang_code")
    return results.withColumn("position", F.row_number().over(w).cast("bigint"))
