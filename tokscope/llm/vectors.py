"""Vector search in blocks: a stated query set against all rows.

Valid rows are dealt to shards of about ``SHARD`` rows by the hash of their id, queries to blocks of about ``QUERIES``; every
(shard, block) pair is one group of a co-grouped pandas function, so each task holds one shard and one block whatever the
table's size. A group returns its nearest k per query, and a window with a limit below the shuffle merges them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SHARD = 8_192
QUERIES = 32_768

#: kernel(vectors, ids, queries, query_ids) -> (query ids, vec ids, scores) of each query's nearest k in the shard
Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def valid(rows: DataFrame) -> DataFrame:
    """vec_id, embedding of rows with an id and a non-empty vector of finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding")).filter(ok)


def by_id(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """ids and vectors (double), ids ascending, vectors of one id in component order."""
    ids = pdf["vec_id"].to_numpy(np.int64)
    x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, 1))
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    if len(ids) > 1 and (ids[1:] == ids[:-1]).any():
        order = np.lexsort([*x.T[::-1], ids])
        ids, x = ids[order], x[order]
    return ids, x


def one_per_id(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`by_id`, but of rows with one id the largest vector alone: an id is one query."""
    ids, x = by_id(pdf)
    last = np.append(ids[1:] != ids[:-1], True) if len(ids) else np.zeros(0, bool)
    return ids[last], x[last]


def search(rows: DataFrame, is_query: Column, k: int, kernel: Kernel, score_type: str, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score. ``rows``: valid rows; vectors meet only vectors of their own length. All rows with other ids
    than the query's are candidates, repeated ids too; of rows with a query's id the largest vector is the query."""
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    n_shards, n_blocks = max(1, math.ceil(n.n / shard)), max(1, math.ceil(n.q / queries))
    dim, h = F.size("embedding").alias("dim"), F.xxhash64("vec_id")
    data = rows.select("vec_id", "embedding", dim, F.pmod(h, F.lit(n_shards)).cast("int").alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    asked = rows.filter(is_query).select("vec_id", "embedding", dim, F.pmod(h, F.lit(n_blocks)).cast("int").alias("block"),
                                         F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids, x = by_id(a)
        qids, q = one_per_id(b)
        if not len(ids) or not len(qids):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        out = kernel(x, ids, q, qids)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), out)))

    key = ["dim", "shard", "block"]
    found = data.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(run, f"query_id bigint, vec_id bigint, score {score_type}")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id, in order."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at] if scores.dtype.kind == "f" else np.negative(scores[at])))][:k]
