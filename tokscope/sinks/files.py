"""Sinks: results CSV/JSON, fertility and novel-token JSON, training text,
vocabulary and merge tables. All are distributed DataFrame writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["lang_code", "lang_name", "script", "n_docs", "n_words", "n_tokens", "fertility",
                  "continuation_rate", "bytes_per_token", "unk_rate", "vocab_coverage", "nsl",
                  "avg_token_len", "grade", "model"]
ROUND_DP = {"fertility": 4, "continuation_rate": 4, "bytes_per_token": 4, "unk_rate": 6,
            "vocab_coverage": 4, "nsl": 4, "avg_token_len": 4}


def model_file_stem(model: Column) -> Column:
    """``results_`` + the whole model id with ``/`` and ``-`` -> ``_``, lower-cased (never cut: two long ids stay two files)."""
    return F.concat(F.lit("results_"), F.lower(F.translate(model, "/-", "__")))


def rounded_results(results: DataFrame) -> DataFrame:
    return results.select(*[F.round(c, ROUND_DP[c]).alias(c) if c in ROUND_DP else F.col(c)
                            for c in RESULT_COLUMNS])


def write_results_csv(results: DataFrame, out_dir: str, mode: str = "overwrite") -> None:
    """One CSV directory per model file stem under ``out_dir`` (header on)."""
    (rounded_results(results).withColumn("file", model_file_stem(F.col("model")))
     .write.mode(mode).partitionBy("file").option("header", True).csv(out_dir))


def write_results_json(results: DataFrame, examples: DataFrame, out_dir: str) -> None:
    """Result rows with their examples (tokens cut to the first 20).

    ``examples``: model, lang_code, doc_id, sentence, tokens ARRAY<STRING>.
    """
    ex = (examples.groupBy("model", "lang_code")
          .agg(F.array_sort(F.collect_list(F.struct("doc_id", F.col("sentence").alias("text"),
                                                     F.slice("tokens", 1, 20).alias("tokens"))))
               .alias("ex")))
    out = (rounded_results(results).join(ex, ["model", "lang_code"], "left")
           .withColumn("examples", F.transform(F.coalesce("ex", F.array()),
                                               lambda e: F.struct(e["text"].alias("text"),
                                                                  e["tokens"].alias("tokens"))))
           .drop("ex"))
    out.write.mode("overwrite").json(out_dir)


def write_fertility_json(fert: DataFrame, out_dir: str) -> None:
    """One JSON object per language: lang, fertility, total_words, total_tokens, docs."""
    fert.select("lang", "fertility", "total_words", "total_tokens", "docs").write.mode("overwrite").json(out_dir)


def write_token_list_json(tokens: DataFrame, out_dir: str, col: str = "token") -> None:
    """Sorted token list (code-point order) as JSON lines."""
    tokens.select(col).orderBy(col).write.mode("overwrite").json(out_dir)


def write_text_lines(df: DataFrame, out_dir: str, col: str = "text", mode: str = "overwrite",
                     partition_by: str | None = "lang") -> None:
    """One document per line (text sink); ``mode='append'`` adds to a corpus."""
    w = df.select(col, *([partition_by] if partition_by else [])).write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(out_dir)


def write_table(df: DataFrame, out_dir: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(out_dir)
