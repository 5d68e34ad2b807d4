"""Evaluation plan: sample -> per-(model, doc) counts -> per-(model, lang) results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.operators import encode, metrics, store, vocab
from tokscope.operators.tokenizers import SQL_MODELS, TOKENIZERS
from tokscope.session import materialised
from tokscope.sources import corpus


def evaluate(spark: SparkSession, docs: DataFrame, models: list[str] | None = None,
             ref_model: str = "script", n: int | None = None,
             max_chars: int | None = None, cont_docs: int | None = None, rounded: bool = False) -> DataFrame:
    """Result rows (one per model x language) for the SQL tokenizers.

    Whole tables and whole texts unless ``n``, ``max_chars`` or ``cont_docs`` ask for a sample.
    """
    models = models or SQL_MODELS
    sample = corpus.sample_eval(docs, n=n, max_chars=max_chars)
    if cont_docs is not None:
        sample = materialised(sample, "sample")     # read twice: for the first documents of a language, and for the words
    # one scan and one word split; counts, document totals and first characters all come from this table
    wc = materialised(metrics.word_counts(sample, cont_docs=cont_docs), "words")
    agg = metrics.with_ratios(metrics.model_sums(wc, models, ref_model), metrics.doc_level(wc))
    cov = metrics.coverage_from_first_chars(spark, metrics.first_chars(wc, models))
    return metrics.results_rows(spark, agg, cov, rounded=rounded)


def compared(spark: SparkSession, docs: DataFrame, models: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(counts per model and language, coverage) for any tokenizers. ``models``: name -> a SQL tokenizer's name, or the path of a
    saved one, which is loaded and not trained. The text is scanned and split once for all."""
    wc = materialised(metrics.word_counts(corpus.sample_eval(docs, n=None, max_chars=None)), "words")
    sql = {n: m for n, m in models.items() if m in TOKENIZERS}
    parts, cover = [], []
    if sql:
        parts.append(metrics.model_sums(wc, sql))
        cover.append(metrics.coverage_from_first_chars(spark, metrics.first_chars(wc, sql)))
    for name, path in models.items():
        if name not in sql:
            model = store.load(spark, path)
            parts.append(metrics.word_sums(encode.bpe_word_stats(wc, model, F.lit(0).cast("bigint"), name=name)))
            cover.append(vocab.vocab_coverage(spark, model.vocab).select(F.lit(name).alias("model"), "lang_code", "vocab_coverage"))
    agg = metrics.with_ratios(reduce(DataFrame.unionByName, parts), metrics.doc_level(wc))
    return materialised(agg, "counts"), reduce(DataFrame.unionByName, cover)


def evaluate_models(spark: SparkSession, docs: DataFrame, models: dict[str, str], ref_model: str) -> DataFrame:
    """Result rows of any tokenizers, with the sequence length against ``ref_model``, any one of them."""
    if ref_model not in models:
        raise ValueError(f"the reference {ref_model} is not among the models")
    agg, cover = compared(spark, docs, models)
    return metrics.results_rows(spark, metrics.against(agg, ref_model), cover)
