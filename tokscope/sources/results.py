"""Sources for saved artefacts: results CSV glob, vocab tables, token-list
JSON, text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULTS_SCHEMA = T.StructType([
    T.StructField("lang_code", T.StringType()), T.StructField("lang_name", T.StringType()),
    T.StructField("script", T.StringType()), T.StructField("n_docs", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("fertility", T.DoubleType()), T.StructField("continuation_rate", T.DoubleType()),
    T.StructField("bytes_per_token", T.DoubleType()), T.StructField("unk_rate", T.DoubleType()),
    T.StructField("vocab_coverage", T.DoubleType()), T.StructField("nsl", T.DoubleType()),
    T.StructField("avg_token_len", T.DoubleType()), T.StructField("grade", T.StringType()),
    T.StructField("model", T.StringType()),
])


def load_results(spark: SparkSession, results_dir: str) -> DataFrame:
    """Every ``results_*`` CSV under ``results_dir``, plain files as well as folders of part files (also those that our sink
    writes as ``file=results_*``), with an explicit schema. ``model`` is always the last path element that starts with
    ``results_``, without ``.csv`` and without any ``results_`` (overriding the column in the file). Other files are not read;
    Spark raises PATH_NOT_FOUND if nothing matches."""
    df = spark.read.schema(RESULTS_SCHEMA).option("header", True).csv(f"{results_dir.rstrip('/')}/{{results_*,file=results_*}}")
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"^.*/(?:file=)?(results_[^/]*)", 1)
    model = F.replace(F.regexp_replace(stem, r"\.csv$", ""), F.lit("results_"), F.lit(""))
    return df.withColumn("model", model).select(*[f.name for f in RESULTS_SCHEMA.fields])


def read_token_list_json(spark: SparkSession, path: str, col: str = "token") -> DataFrame:
    """A token list: one JSON array of strings per file (however it is laid out over lines), or one object per line. The first
    character tells which; files of one list have one form."""
    first = spark.read.text(path).where(F.trim("value") != "").first()
    if first is not None and first[0].strip().startswith("["):
        whole = spark.read.text(path, wholetext=True)
        return whole.select(F.explode(F.from_json("value", "array<string>")).alias(col))
    return spark.read.schema(T.StructType([T.StructField(col, T.StringType())])).json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text sink; stripped, empty ones dropped by the caller."""
    return spark.read.text(path).withColumnRenamed("value", "line")
