"""Per-language tokenizer quality metrics as one aggregate plan.

Shape of the plan:

1. words of every document are counted as distinct ``(lang, word)`` pairs
   (partial aggregation combines hot words map-side, so a language or word
   holding a third of the corpus never lands on one reducer in full);
2. each tokenizer runs once per distinct word (tokens never cross
   whitespace, so every count is a weighted sum over distinct words);
3. one ``groupBy(model, lang)`` of integer sums; ratios are formed once
   from integer sums (bit-identical across engines);
4. small dimension joins (language metadata, code points) are broadcast:
   both are bounded by the fixed language table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.functions import langmeta
from tokscope.functions.text import (WS, example_sentence, grade_eval, grade_train, n_bytes, n_words,
                                     safe_div, token_preview, words)
from tokscope.operators.tokenizers import TOKENIZERS
from tokscope.sources.corpus import first_n_per_group

CONT_DOCS = 200        # fixed value: continuation rate uses the first 200 docs
EXAMPLES_PER_LANG = 2  # fixed value

COUNT_COLS = ["n_tok", "n_ref_tok", "len_sum", "len_n", "n_unk", "cont_split", "cont_words"]


def continuation_flags(sample: DataFrame, cont_docs: int | None = None) -> DataFrame:
    """doc_id, in_cont: the first ``cont_docs`` documents of each language
    (None: every document). Only keys move; bounded by cont_docs x languages.
    """
    if cont_docs is None:
        return sample.select("doc_id", F.lit(True).alias("in_cont"))
    keys = first_n_per_group(sample.select("lang", "doc_id"), cont_docs, "lang", "doc_id")
    return keys.select("doc_id", F.lit(True).alias("in_cont"))


def _zero():
    return F.lit(0).cast("bigint")


def word_counts(sample: DataFrame, cont_docs: int | None = None) -> DataFrame:
    """lang, in_cont, word, cnt, n_bytes: distinct whitespace words with counts.

    Every tokenizer here keeps its tokens inside whitespace words, so all
    per-language token metrics are sums over distinct words weighted by their
    counts. Partial aggregation combines hot words map-side; tokenizers then
    run once per distinct word instead of once per occurrence.

    Each document also contributes one row with ``word`` NULL carrying its
    UTF-8 byte length, so document and byte totals come out of the same
    single scan and aggregation (``cnt`` of the NULL row = documents).
    """
    if cont_docs is None:
        flagged = sample.withColumn("in_cont", F.lit(True))
    else:
        flagged = (sample.join(continuation_flags(sample, cont_docs), "doc_id", "left")
                   .withColumn("in_cont", F.coalesce("in_cont", F.lit(False))))
    parts = F.split(F.col("text"), f"{WS}+")
    items = F.concat(F.array(F.lit(None).cast("string")), parts)
    exploded = flagged.select("lang", "in_cont", n_bytes("text").alias("doc_bytes"),
                              F.posexplode(items).alias("i", "word"))
    return (exploded.where((F.col("i") == 0) | (F.col("word") != ""))
            .select("lang", "in_cont", "word",
                    F.when(F.col("i") == 0, F.col("doc_bytes")).otherwise(_zero()).alias("b"))
            .groupBy("lang", "in_cont", "word")
            .agg(F.count(F.lit(1)).cast("bigint").alias("cnt"), F.sum("b").cast("bigint").alias("n_bytes")))


def doc_level(wc: DataFrame) -> DataFrame:
    """lang, n_docs, n_bytes (UTF-8 bytes include whitespace) from the NULL rows."""
    return (wc.where(F.col("word").isNull()).groupBy("lang")
            .agg(F.sum("cnt").cast("bigint").alias("n_docs"), F.sum("n_bytes").cast("bigint").alias("n_bytes")))


def _sums(pieces: str, ref_pieces: str, len_sum: str, n_unk) -> list:
    """The sums of one model's words that every ratio is formed from; all but the number of words, which is the same for every model."""
    c, cont, z = F.col("cnt"), F.col("in_cont"), _zero()
    return [F.sum(c * F.col(pieces)).cast("bigint").alias("n_tokens"),
            F.sum(c * F.col(ref_pieces)).cast("bigint").alias("n_ref_tokens"),
            F.sum(c * F.col(len_sum)).cast("bigint").alias("len_sum"),
            # token lengths skip unknown tokens entirely (numerator and count)
            F.sum(c * (F.col(pieces) - n_unk)).cast("bigint").alias("len_n"),
            F.sum(c * n_unk).cast("bigint").alias("n_unk"),
            F.sum(F.when(cont & (F.col(pieces) > 1), c).otherwise(z)).cast("bigint").alias("cont_split")]


def _word_sums() -> list:
    return [F.sum("cnt").cast("bigint").alias("n_words"),
            F.sum(F.when(F.col("in_cont"), F.col("cnt")).otherwise(_zero())).cast("bigint").alias("cont_words")]


SUM_COLS = ["model", "lang", "n_words", "n_tokens", "n_ref_tokens", "len_sum", "len_n", "n_unk", "cont_split", "cont_words"]


def model_sums(wc: DataFrame, models: list[str] | dict[str, str], ref_model: str = "script") -> DataFrame:
    """Per (model, lang): the sums over the weighted distinct words. Every tokenizer's closed forms run once per distinct word, side by
    side in one row, and each language's sums are taken in one aggregate; only these are dealt out to one row per model.
    ``models``: names of SQL tokenizers, or name in the result -> SQL tokenizer."""
    named = models if isinstance(models, dict) else {m: m for m in models}
    w, used = F.col("word"), sorted(set(named.values()))
    forms = [f(w).cast("bigint").alias(f"{m}_{k}") for m in used for k, f in (("pieces", TOKENIZERS[m].pieces), ("len", TOKENIZERS[m].word_len_sum))]
    forms.append(TOKENIZERS[ref_model].pieces(w).cast("bigint").alias("ref_pieces"))
    words_ = wc.where(F.col("word").isNotNull()).select("lang", "in_cont", "cnt", *forms)
    sums = words_.groupBy("lang").agg(*_word_sums(), *[x.alias(f"{m}_{i}") for m in used for i, x in enumerate(_sums(f"{m}_pieces", "ref_pieces", f"{m}_len", _zero()))])
    cols = ["n_tokens", "n_ref_tokens", "len_sum", "len_n", "n_unk", "cont_split"]
    per_model = F.array(*[F.struct(F.lit(n).alias("model"), *[F.col(f"{m}_{i}").alias(c) for i, c in enumerate(cols)]) for n, m in named.items()])
    return sums.select("lang", "n_words", "cont_words", F.inline(per_model)).select(*SUM_COLS)


def word_sums(stats: DataFrame) -> DataFrame:
    """Per (model, lang): the same sums from a table of weighted distinct words per model."""
    return (stats.groupBy("model", "lang").agg(*_word_sums(), *_sums("pieces", "ref_pieces", "len_sum", F.col("n_unk"))).select(*SUM_COLS))


def with_ratios(sums: DataFrame, docs: DataFrame) -> DataFrame:
    """The sums per (model, lang) with the languages' documents, and the ratios."""
    return sums.join(docs, "lang").select(
        "model", "lang", "n_docs", "n_words", "n_tokens", "n_bytes", "n_ref_tokens",
        "len_sum", "len_n", "n_unk", "cont_split", "cont_words",
        safe_div("n_tokens", "n_words").alias("fertility"),
        safe_div("cont_split", "cont_words").alias("continuation_rate"),
        safe_div("n_bytes", "n_tokens").alias("bytes_per_token"),
        safe_div("n_unk", "n_tokens").alias("unk_rate"),
        safe_div("n_tokens", "n_ref_tokens").alias("nsl"),
        safe_div("len_sum", "len_n").alias("avg_token_len"))


def aggregate_word_stats(stats: DataFrame, docs: DataFrame) -> DataFrame:
    """Per (model, lang) sums from weighted distinct-word stats, plus ratios."""
    return with_ratios(word_sums(stats), docs)


def nsl_matrix(agg: DataFrame) -> DataFrame:
    """model, ref_model, lang, n_tokens, n_ref_tokens, nsl: every model against every model, from the counts per model and language
    (a self-join of that small table; the text isn't read again)."""
    a = agg.select("model", "lang", "n_tokens")
    b = agg.select(F.col("model").alias("ref_model"), "lang", F.col("n_tokens").alias("n_ref_tokens"))
    return a.join(b, "lang").select("model", "ref_model", "lang", "n_tokens", "n_ref_tokens", safe_div("n_tokens", "n_ref_tokens").alias("nsl"))


def against(agg: DataFrame, ref_model: str) -> DataFrame:
    """``agg`` with its sequence lengths taken against ``ref_model``."""
    ref = nsl_matrix(agg).where(F.col("ref_model") == ref_model).select("model", "lang", "n_ref_tokens", "nsl")
    return agg.drop("n_ref_tokens", "nsl").join(ref, ["model", "lang"])


def first_chars(wc: DataFrame, models: list[str] | dict[str, str]) -> DataFrame:
    """model, ch: distinct token first characters over the corpus, from its distinct words. ``models``: as in :func:`model_sums`."""
    named = models if isinstance(models, dict) else {m: m for m in models}
    w = wc.where(F.col("word").isNotNull()).select("word")
    each = [w.select(F.lit(n).alias("model"), F.explode(TOKENIZERS[m].word_first_chars(F.col("word"))).alias("ch")) for n, m in named.items()]
    return reduce(DataFrame.unionByName, each).distinct()


def coverage_from_first_chars(spark: SparkSession, first_chars: DataFrame) -> DataFrame:
    """model, lang_code, vocab_coverage = covered / assigned code points of the
    language's script range (assigned = category not Cn, Python tables).

    The code-point table is a bounded dimension (< 2 000 rows per language
    set): broadcast, equi-joined on the character. Languages a model does not
    cover at all get no row here (coverage 0 after the left join in
    :func:`results_rows`).
    """
    meta = langmeta.lang_meta_df(spark).select("lang_code", "cp_lo", "cp_hi")
    cps = langmeta.assigned_codepoints_df(spark)
    lang_cps = meta.join(F.broadcast(cps), ["cp_lo", "cp_hi"]).select("lang_code", "ch")
    assigned = lang_cps.groupBy("lang_code").agg(F.count(F.lit(1)).alias("n_assigned"))
    covered = (first_chars.join(F.broadcast(lang_cps), "ch")
               .groupBy("model", "lang_code").agg(F.count(F.lit(1)).alias("n_covered")))
    return (covered.join(F.broadcast(assigned), "lang_code")
            .select("model", "lang_code", safe_div("n_covered", "n_assigned").alias("vocab_coverage")))


def with_lang_meta(spark: SparkSession, df: DataFrame, lang_col: str = "lang") -> DataFrame:
    meta = langmeta.lang_meta_df(spark).select(
        F.col("lang_code").alias(lang_col), "lang_name", "script")
    return (df.join(F.broadcast(meta), lang_col, "left")
            .withColumn("lang_name", F.coalesce("lang_name", F.col(lang_col)))
            .withColumn("script", F.coalesce("script", F.lit("Unknown"))))


def results_rows(spark: SparkSession, agg: DataFrame, coverage: DataFrame,
                 rounded: bool = False) -> DataFrame:
    """The per-(model, language) result row (reference column order)."""
    cov = coverage.withColumnRenamed("lang_code", "lang")
    out = with_lang_meta(spark, agg.join(F.broadcast(cov), ["model", "lang"], "left"))
    cols = {
        "fertility": 4, "continuation_rate": 4, "bytes_per_token": 4, "unk_rate": 6,
        "vocab_coverage": 4, "nsl": 4, "avg_token_len": 4}
    metric_cols = [
        (F.round(F.coalesce(F.col(c), F.lit(0.0)), d) if rounded
         else F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c, d in cols.items()]
    return out.select(
        F.col("lang").alias("lang_code"), "lang_name", "script", "n_docs", "n_words", "n_tokens",
        *metric_cols, grade_eval("fertility").alias("grade"), "model")


def fertility_pretok(counts_df: DataFrame) -> DataFrame:
    """Training-script fertility record: lang, fertility (3 dp), total_words,
    total_tokens, docs; only languages with words > 0."""
    agg = counts_df.groupBy("lang").agg(
        F.sum("n_words").cast("bigint").alias("total_words"),
        F.sum("n_tok").cast("bigint").alias("total_tokens"),
        F.count(F.lit(1)).cast("bigint").alias("docs"))
    return (agg.where(F.col("total_words") > 0)
            .select("lang", F.round(F.col("total_tokens") / F.col("total_words"), 3).alias("fertility"),
                    "total_words", "total_tokens", "docs",
                    grade_train(F.round(F.col("total_tokens") / F.col("total_words"), 3)).alias("rating")))


def macro_fertility(fert: DataFrame) -> DataFrame:
    """Unweighted mean over languages of the rounded fertilities (0 if none),
    reported at 6 dp (the inputs carry 3)."""
    return fert.agg(F.round(F.coalesce(F.avg("fertility"), F.lit(0.0)), 6).alias("macro_fertility"),
                    F.count(F.lit(1)).cast("bigint").alias("n_langs"))


def fertility_summary(results: DataFrame) -> DataFrame:
    """Per model: best/worst language (ties -> first language code), mean and
    upper median ``sorted[n // 2]`` of fertility."""
    srt = F.array_sort(F.collect_list("fertility"))
    return results.groupBy("model").agg(
        F.min("fertility").alias("best_fertility"),
        F.min_by("lang_code", F.struct(F.col("fertility"), F.col("lang_code"))).alias("best_lang"),
        F.max("fertility").alias("worst_fertility"),
        F.min_by("lang_code", F.struct((-F.col("fertility")), F.col("lang_code"))).alias("worst_lang"),
        F.avg("fertility").alias("mean_fertility"),
        F.element_at(srt, (F.floor(F.size(srt) / 2) + 1).cast("int")).alias("median_fertility"),
        F.count(F.lit(1)).cast("bigint").alias("n_langs"))


def grade_distribution(results: DataFrame) -> DataFrame:
    """model, grade, languages (names sorted, comma-joined), n_langs; empty
    bands are simply absent."""
    return results.groupBy("model", "grade").agg(
        F.array_join(F.array_sort(F.collect_list("lang_name")), ", ").alias("languages"),
        F.count(F.lit(1)).cast("bigint").alias("n_langs"))


def examples(spark: SparkSession, sample: DataFrame, model: str = "script",
             n: int = EXAMPLES_PER_LANG) -> DataFrame:
    """First ``n`` documents per language: example sentence, its tokens
    (preview joined with `` | ``), counts and local fertility."""
    # the sentence is all that is used of a text, so it is all that is shuffled
    firsts = first_n_per_group(sample.select("lang", "doc_id", example_sentence(F.col("text")).alias("sentence")), n, "lang", "doc_id")
    sent = F.col("sentence")
    toks = TOKENIZERS[model].tokens(sent)
    return firsts.select(
        F.lit(model).alias("model"), F.col("lang").alias("lang_code"), "doc_id",
        "sentence", token_preview(toks).alias("preview"),
        F.array_join(F.slice(toks, 1, 20), " ").alias("tokens20"),
        F.size(toks).cast("bigint").alias("n_tokens"),
        n_words(sent).alias("n_words"),
        (F.size(toks) / F.greatest(F.lit(1), F.size(words(sent)))).alias("local_fertility"))
