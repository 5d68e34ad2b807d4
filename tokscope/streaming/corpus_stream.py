"""Structured Streaming: incremental corpus ingest and running statistics.

Documents arriving as files are cleaned and pre-tokenized by stateless
projections (append to a table); per-language running totals (documents,
words, pre-tokens, bytes) are integer sums held in the streaming state store
(checkpointed under the query's checkpoint location, so a lost executor or a
restarted driver resumes where it stopped). Ratios are derived from the sums,
so the streamed result equals the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokscope.functions import pretok, text
from tokscope.sources.corpus import TRAIN_MIN_EXCLUSIVE

DOCUMENTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def read_documents_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                          spread: int | None = None) -> DataFrame:
    """File stream of documents. ``spread``: round-robin the rows of each
    micro-batch over that many tasks -- for sources whose files are few and
    large (one task per file otherwise); with many files per trigger leave
    it None (no extra shuffle)."""
    r = spark.readStream.schema(DOCUMENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    return df.repartition(spread) if spread else df


def cleaned_stream(stream: DataFrame, min_exclusive: int = TRAIN_MIN_EXCLUSIVE) -> DataFrame:
    """doc_id, lang, text, processed: strip, keep length > 20, pre-tokenize."""
    s = stream.select("doc_id", "lang", text.strip("text").alias("text"))
    return (s.where(F.length("text") > min_exclusive)
            .withColumn("processed", pretok.pretokenized_text("text")))


def running_stats(stream: DataFrame) -> DataFrame:
    """Per-language running sums over a (cleaned) document stream."""
    per_doc = stream.select("lang", text.n_words_stripped("text").alias("w"),
                            F.size(pretok.pretokens("text")).cast("bigint").alias("t"),
                            text.n_bytes("text").alias("b"))
    return per_doc.groupBy("lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("docs"), F.sum("w").cast("bigint").alias("words"),
        F.sum("t").cast("bigint").alias("tokens"), F.sum("b").cast("bigint").alias("bytes"))


def with_ratios(stats: DataFrame) -> DataFrame:
    return stats.select("*", text.safe_div("tokens", "words").alias("fertility"),
                        text.safe_div("bytes", "tokens").alias("bytes_per_token"))


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append mode into a parquet table; runs all available input, then stops."""
    q = (stream.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def complete_to_table(agg: DataFrame, path: str, checkpoint: str) -> None:
    """Complete-mode aggregate; every micro-batch writes the whole result to a folder of its own (a batch that runs again
    rewrites its own folder), so a reader or a crash in between never sees a half table. State lives in the checkpoint
    location. Read it with :func:`latest_table`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_table(spark: SparkSession, path: str) -> DataFrame:
    """The result of the last finished micro-batch of :func:`complete_to_table`."""
    every = spark.read.parquet(path)
    last = every.agg(F.max("batch")).first()[0]
    return every.where(F.col("batch") == last).drop("batch")
