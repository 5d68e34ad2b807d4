"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.session import ensure_checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column | str, m: int) -> Column:
    """crc32 of the id written as text, mod ``m``; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % m


def is_fold(doc_id: Column | str, m: int, r: int) -> Column:
    """True where crc32(id) mod m = r; false for a null id."""
    return F.coalesce(crc_mod(doc_id, m) == r, F.lit(False))


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage: reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with no column of ``df``."""
    tag = uuid.uuid4().hex[:8]
    return [f"_{n}_{tag}" for n in names]


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rows' places 1, 2, ... in ``order``: a range-partitioned sort, written once, and one offset a partition."""
    part, at, first = fresh(df, "part", "at", "first")
    place = F.monotonically_increasing_id()                   # partition in the upper bits, row within it in the lower 33
    rows = settle(df.orderBy(*order).withColumn(part, F.shiftright(place, 33).cast("int")).withColumn(at, place.bitwiseAND((1 << 33) - 1)))
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(part).count().collect())      # one row a partition
    before, offsets = 0, []
    for p, n in sizes:
        offsets.append((p, before))
        before += n
    starts = df.sparkSession.createDataFrame(offsets, f"{part} int, {first} bigint")
    return rows.join(F.broadcast(starts), part).withColumn(name, F.col(first) + F.col(at) + 1).drop(part, at, first)


def batch(schema: pa.Schema, cols: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


TEXT_ROWS = 128     # texts of an Arrow batch that are Python strings at a time


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator:
    """The values of a column one by one, a few of them as Python objects at a time."""
    for i in range(0, len(column), TEXT_ROWS):
        yield from column.slice(i, TEXT_ROWS).to_pylist()


class Memo:
    """A memo of two generations with at most ``size`` entries each: what is asked for again outlives the rest."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        v = self.young.get(key)
        if v is None:
            v = self.old.get(key)
            if v is not None:
                self.put(key, v)
        return v

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def chunks(n: int, size: int) -> Iterator[slice]:
    for i in range(0, n, size):
        yield slice(i, min(n, i + size))
