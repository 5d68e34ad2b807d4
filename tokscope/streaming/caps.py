"""A cap of documents per language over a stream.

Two steps, because the first ``cap`` documents of a language need one order, and a language may hold a third of the stream:

1. keyed state per (language, shard of the document id), in the state store under the query's checkpoint: a shard that has let
   ``cap`` documents through in earlier micro-batches lets none through any more. A hot language spreads over its shards, no
   group is sorted or held, and once a language is full almost nothing of it goes on.
2. per micro-batch, the exact cut: what each language may still take is ``cap`` less what the batches before have taken, a table of one
   row a language written with every batch. The first documents by id go first. A batch that runs again reads the table of the
   batch before and rewrites its own folders, so a restart changes nothing.

Within a micro-batch documents go by id, between micro-batches by arrival; for input that arrives in the order of ids the result is
the batch cap's. Ids are unique within a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokscope.functions.text import strip
from tokscope.session import committed
from tokscope.sources.corpus import TRAIN_MIN_EXCLUSIVE, first_n_per_group

SHARDS = 32


def until_full(stream: DataFrame, cap: int, shards: int = SHARDS) -> DataFrame:
    """doc_id, lang, text of ``stream`` without the shards that had ``cap`` documents before this micro-batch."""
    def run(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        if n >= cap:
            return
        for rows in frames:
            n += len(rows)
            yield rows[["doc_id", "lang", "text"]]
        state.update((n,))

    keyed = stream.select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"))
    return keyed.groupBy("lang", "shard").applyInPandasWithState(run, "doc_id bigint, lang string, text string", "n bigint", "append", "NoTimeout")


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(p.rsplit("=", 1)[1]) for p in committed(spark, path))


def take_batch(batch: DataFrame, batch_id: int, path: str, cap: int) -> None:
    """Write what the languages may still take of one micro-batch to ``path``/rows, and what they have taken to ``path``/taken."""
    spark = batch.sparkSession
    before = [b for b in _batches(spark, f"{path}/taken") if b < batch_id]
    taken = (spark.read.parquet(f"{path}/taken/batch={before[-1]}") if before else spark.createDataFrame([], "lang string, n bigint"))
    rows = batch.select("doc_id", "lang", "text").persist()
    first = first_n_per_group(rows.select("lang", "doc_id"), cap, "lang", "doc_id")          # at most cap a language from here on
    place = F.row_number().over(Window.partitionBy("lang").orderBy("doc_id"))
    past = taken.select(F.col("lang").alias("_lang"), F.col("n").alias("_n"))
    fits = (first.withColumn("place", place).join(past, F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .where(F.col("place") <= cap - F.coalesce("_n", F.lit(0))).select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id")))
    kept = rows.join(fits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    kept.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
    now = spark.read.schema("doc_id bigint, lang string, text string").parquet(f"{path}/rows/batch={batch_id}").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = taken.unionByName(now).groupBy("lang").agg(F.sum("n").alias("n"))
    total.coalesce(1).write.mode("overwrite").parquet(f"{path}/taken/batch={batch_id}")
    rows.unpersist()


def ingest_capped(stream: DataFrame, path: str, checkpoint: str, cap: int, after_filter: bool = False, shards: int = SHARDS,
                  min_exclusive: int = TRAIN_MIN_EXCLUSIVE) -> None:
    """Run all available input through the cap. ``after_filter``: texts are stripped and short ones dropped before they are counted
    (otherwise :func:`kept` does that afterwards, so that fewer than ``cap`` may stay)."""
    s = stream.select("doc_id", "lang", "text")
    if after_filter:
        s = s.withColumn("text", strip("text")).where(F.length("text") > min_exclusive)
    q = (until_full(s, cap, shards).writeStream.outputMode("append").foreachBatch(lambda batch, i: take_batch(batch, i, path, cap))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def kept(spark: SparkSession, path: str, min_exclusive: int = TRAIN_MIN_EXCLUSIVE) -> DataFrame:
    """doc_id, lang, text (stripped, long enough) of all finished batches."""
    done = [f"{path}/rows/batch={b}" for b in _batches(spark, f"{path}/taken")]
    rows = spark.read.schema("doc_id bigint, lang string, text string").parquet(*done) if done else spark.createDataFrame([], "doc_id bigint, lang string, text string")
    return rows.select("doc_id", "lang", strip("text").alias("text")).where(F.length("text") > min_exclusive)
