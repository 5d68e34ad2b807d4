"""A pre-token frequency table that a stream keeps up to date.

Every micro-batch writes its own signed counts (documents with sign -1 are taken back) under its batch id, so a batch that runs again
replaces its counts and never adds them twice. Every ``MERGE_EVERY`` batches the counts so far are merged into one table, dealt by
the token's hash; readers take the last finished merge and the batches after it. Training can start from the table at any time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.functions.pretok import pretokens
from tokscope.session import committed

MERGE_EVERY = 16
COUNTS = "token string, freq bigint"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(p.rsplit("=", 1)[1]) for p in committed(spark, path))


def _sum(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("token").agg(F.sum("freq").cast("bigint").alias("freq")).where("freq <> 0")


def changes(docs: DataFrame) -> DataFrame:
    """token, freq: signed counts of the pre-tokens of ``docs`` (text, and a column ``sign`` if some are to be taken back)."""
    sign = F.col("sign").cast("bigint") if "sign" in docs.columns else F.lit(1).cast("bigint")
    return _sum([docs.select(F.explode(pretokens("text")).alias("token"), sign.alias("freq"))])


def add_batch(docs: DataFrame, batch_id: int, path: str, merge_every: int = MERGE_EVERY) -> None:
    """Count one micro-batch, and merge if it is its turn. Running it again changes nothing."""
    spark = docs.sparkSession
    if batch_id <= max(_numbers(spark, f"{path}/merged"), default=-1):
        return                                              # already in a finished merge
    changes(docs).write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
    if (batch_id + 1) % merge_every == 0:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table(spark, path).repartition(parts, "token").write.mode("overwrite").parquet(f"{path}/merged/upto={batch_id}")


def table(spark: SparkSession, path: str) -> DataFrame:
    """token, freq over all finished batches."""
    merged = max(_numbers(spark, f"{path}/merged"), default=-1)
    parts = [f"{path}/merged/upto={merged}"] if merged >= 0 else []
    parts += [f"{path}/changes/batch={b}" for b in _numbers(spark, f"{path}/changes") if b > merged]
    return _sum([spark.read.schema(COUNTS).parquet(p) for p in parts]) if parts else spark.createDataFrame([], COUNTS)


def keep_up_to_date(stream: DataFrame, path: str, checkpoint: str, merge_every: int = MERGE_EVERY) -> None:
    """Run all available documents of ``stream`` (text, maybe sign) into the table at ``path``."""
    q = (stream.writeStream.foreachBatch(lambda batch, i: add_batch(batch, i, path, merge_every))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
