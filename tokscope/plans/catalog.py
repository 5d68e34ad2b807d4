"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (whole tables, whole texts) or data
Spark derives from them. Column names and types match :mod:`oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.functions import pretok, text
from tokscope.operators import metrics
from tokscope.operators.tokenizers import SQL_MODELS
from tokscope.plans import evaluation
from tokscope.sources import corpus

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _whole_clean(spark: SparkSession, sf_dir: str, indic: bool = False) -> DataFrame:
    """Stripped documents with length >= 10, whole texts, no cap."""
    return corpus.sample_eval(corpus.documents(spark, sf_dir, indic=indic), n=None, max_chars=None)


# --------------------------------------------------------------------------
# minimum slice: per-language words/tokens/bytes/chars and fertility
# --------------------------------------------------------------------------
@register("fertility_by_lang")
def q_fertility_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _whole_clean(spark, sf_dir)
    per_doc = s.select(
        "lang", text.n_words_stripped("text").alias("w"),
        F.size(pretok.pretokens("text")).cast("bigint").alias("t"),
        text.n_bytes("text").alias("b"), text.n_chars("text").alias("c"))
    agg = per_doc.groupBy("lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("docs"),
        F.sum("w").cast("bigint").alias("words"), F.sum("t").cast("bigint").alias("tokens"),
        F.sum("b").cast("bigint").alias("bytes"), F.sum("c").cast("bigint").alias("chars"))
    return agg.select("*", text.safe_div("tokens", "words").alias("fertility"),
                      text.safe_div("bytes", "tokens").alias("bytes_per_token"),
                      text.grade_eval(text.safe_div("tokens", "words")).alias("grade"))


# --------------------------------------------------------------------------
# full evaluation over the four SQL tokenizers (whole tables)
# --------------------------------------------------------------------------
def _evaluate(spark: SparkSession, sf_dir: str, indic: bool = False) -> DataFrame:
    docs = corpus.documents(spark, sf_dir, indic=indic)
    return evaluation.evaluate(spark, docs, SQL_MODELS, ref_model="script",
                               n=None, max_chars=None, cont_docs=None)


@register("evaluate")
def q_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluate(spark, sf_dir)


@register("evaluate_indic")
def q_evaluate_indic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluate(spark, sf_dir, indic=True)


@register("evaluate_reference_sample")
def q_evaluate_reference_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's evaluation setup (its sampling feature): the first
    1000 kept documents per language, each cut to 2000 code points, and the
    continuation rate over the first 200 of them; Indic view."""
    docs = corpus.documents(spark, sf_dir, indic=True)
    return evaluation.evaluate(spark, docs, SQL_MODELS, ref_model="script", n=corpus.SAMPLES_PER_LANG,
                               max_chars=corpus.MAX_CHARS_PER_DOC, cont_docs=metrics.CONT_DOCS)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# query groups register themselves on import
from tokscope.plans import q_corpus, q_compare, q_vocab, q_chat, q_bpe, q_stream, q_io  # noqa: E402,F401
