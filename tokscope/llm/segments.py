"""Exact top-k search by multi-resolution segment statistics.

Components are turned into the integers floor(256 x). A vector is cut into segments; for each, its mean and deviation are kept.
For vectors q and x a segment of n components adds at least n * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2) to their squared
distance, so |q|^2 + |x|^2 minus that bound, halved, is an upper bound of their inner product. Bounds go from ``LEVELS[0]``
segments to ever finer ones; at each level the vectors whose bound is below the k-th exact score so far are dropped, and
the best-looking of the rest are scored exactly to raise that score. What remains after the finest level is scored exactly.

Exactness: where a product sum can reach 2^53 it is taken in 64-bit integers, and beyond 2^63 in Python integers that are cut
to the range of a long. Defined cases: rows with null id, null or empty vector, or null or non-finite components take no
part; vectors of different lengths never meet; rows with the same id are all
candidates (of other ids' queries), and one of them is the query; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokscope.llm.vectors import best, search, valid

LEVELS = (4, 16, 32)
K = 5


def summary(x: np.ndarray, parts: int) -> np.ndarray:
    """Segment means and deviations, each times the root of the segment's length: a dot product of two rows bounds their inner product."""
    cuts = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
    n = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / n
    centred = x - np.repeat(mean, n, axis=1)
    dev = np.sqrt(np.add.reduceat(centred * centred, cuts[:-1], axis=1) / n)
    return np.hstack([mean, dev]) * np.sqrt(np.concatenate([n, n]))


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``x`` (whole numbers as doubles) with ``q``."""
    if not len(x):
        return np.zeros(0, np.int64)
    most = np.abs(x).max() * np.abs(q).max() * x.shape[1]
    if most < 2 ** 53:
        return (x @ q).astype(np.int64)
    if most < 2 ** 62:
        return x.astype(np.int64) @ q.astype(np.int64)
    whole = [int(v) for v in q]
    sums = [sum(int(a) * b for a, b in zip(row, whole)) for row in x]
    return np.array([max(-2 ** 63, min(2 ** 63 - 1, s)) for s in sums], np.int64)


def kernel(k: int):
    def search_shard(x, ids, q, qids):
        x, q = (np.clip(np.floor(256.0 * np.clip(v, -1e150, 1e150)), -1e150, 1e150) for v in (x, q))
        out = []
        norm_x, norm_q = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        levels = [(summary(x, s), summary(q, s)) for s in LEVELS]
        step = max(1, 4_000_000 // len(x))
        for a in range(0, len(q), step):
            coarse = levels[0][1][a:a + step] @ levels[0][0].T
            for i, row in enumerate(coarse, start=a):
                slack = 1e-9 * norm_q[i] * norm_x + 1e-6
                left = np.flatnonzero(ids != qids[i])
                bound = row[left] + slack[left]
                done = np.zeros(0, int)
                scores = np.zeros(0, np.int64)
                for level in range(len(LEVELS) + 1):
                    if level == len(LEVELS):
                        look = left
                    else:
                        look = left[np.argpartition(-bound, min(2 * k, len(left) - 1))[:2 * k]] if len(left) else left
                    look = look[~np.isin(look, done)] if len(done) else look
                    done, scores = np.append(done, look), np.append(scores, exact(x[look], q[i]))
                    if level == len(LEVELS) or not len(left):
                        break
                    if len(scores) >= k:
                        left = left[bound >= np.partition(scores, len(scores) - k)[len(scores) - k]]
                    if level + 1 < len(LEVELS):
                        fine_x, fine_q = levels[level + 1]
                        bound = fine_x[left] @ fine_q[i] + slack[left]
                        if len(scores) >= k:
                            keep = bound >= np.partition(scores, len(scores) - k)[len(scores) - k]
                            left, bound = left[keep], bound[keep]
                b = best(scores, ids[done], k)
                out.append((np.full(len(b), qids[i]), ids[done[b]], scores[b]))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else ([], [], [])

    return search_shard


def op10_topk(rows: DataFrame, k: int = K, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products, exact."""
    return search(valid(rows), F.col("vec_id") % every == 0, k, kernel(k), "bigint")


ORACLE_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id, len(e) ORDER BY e DESC) = 1) AS q
  JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
