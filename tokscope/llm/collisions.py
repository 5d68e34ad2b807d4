"""Approximate nearest neighbours by collision counting over single projections.

Largest inner product becomes smallest distance: vectors of a shard get one more component that brings them to the shard's
largest norm, queries are scaled to that norm. A shard's index is one sorted array per projection (random orthonormal
directions). A query opens a window around its own value in every array; a vector that falls into at least ``threshold`` of
the windows is verified with its exact inner product on the original vectors. Virtual rehashing widens the windows by the
factors ``LEVELS``; a query stops at a level whose radius holds its k-th verified vector, and after the last
level it verifies the whole shard, so no query ends with fewer than it could have.

Widths and thresholds come from the shard itself: up to ``PILOTS`` of its vectors act as queries, their exact neighbours give the
median k-th distance, and the threshold is the ``MISS`` quantile of the collisions that true neighbours have.

Defined cases: rows with null id, null or empty vector, a zero vector, or null or non-finite components take no part; vectors of
different lengths never meet; rows with the same id are all
candidates (of other ids' queries), and one of them is the query; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokscope.llm.vectors import best, search, valid

PROJECTIONS = 128
LEVELS = (0.4, 1.0, 1.25)
PILOTS = 64
MISS = 0.03
K = 20


def directions(d: int, m: int, seed: int = 3) -> np.ndarray:
    """m unit vectors in blocks of orthonormal ones."""
    rng = np.random.default_rng(seed)
    parts = [np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(-(-m // d))]
    return np.concatenate(parts)[:m]


class Index:
    """Sorted arrays of the projections of one shard."""

    def __init__(self, x: np.ndarray, k: int):
        self.x, self.want, self.k = x, k, min(k, len(x) - 1)
        norm = np.sqrt((x * x).sum(axis=1))
        self.top = norm.max()
        self.lifted = np.hstack([x, np.sqrt(np.maximum(self.top ** 2 - norm ** 2, 0))[:, None]])
        self.a = directions(self.lifted.shape[1], PROJECTIONS).T
        p = self.lifted @ self.a
        order = np.argsort(p, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(p, order, axis=0).T)
        kind = np.uint16 if len(x) < 65_536 else np.uint32
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(len(x))[:, None], axis=0)
        self.rank = np.ascontiguousarray(rank.T.astype(kind))
        self.calibrate()

    def scaled(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q * (self.top / np.sqrt((q * q).sum(axis=1)))[:, None], np.zeros((len(q), 1))])

    def distance(self, q: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """Lifted distance for inner products with the unscaled query."""
        return np.sqrt(np.maximum(2 * self.top ** 2 - 2 * inner * (self.top / np.sqrt((q * q).sum())), 0))

    def windows(self, projected: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        lo = np.stack([np.searchsorted(s, v - half, "left") for s, v in zip(self.sorted, projected.T)], axis=1)
        hi = np.stack([np.searchsorted(s, v + half, "right") for s, v in zip(self.sorted, projected.T)], axis=1)
        return lo, hi - lo

    def collisions(self, lo: np.ndarray, width: np.ndarray) -> np.ndarray:
        """In how many windows each vector falls: rank - lo < width, wrapping below zero."""
        t = self.rank.dtype
        inside = np.subtract(self.rank, lo.astype(t)[:, None]) < np.minimum(width, np.iinfo(t).max).astype(t)[:, None]
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)

    def calibrate(self) -> None:
        n = len(self.x)
        self.radius, self.threshold = 0.0, [0] * len(LEVELS)
        if self.k < 1:
            return
        at = np.unique(np.linspace(0, n - 1, min(PILOTS, n)).astype(int))
        near, far = [], []
        for i in at:
            s = self.x @ self.x[i]
            s[i] = -np.inf
            j = np.argpartition(-s, self.k - 1)[:self.k]
            near.append((j, self.distance(self.x[i], s[j])))
            far.append(near[-1][1].max())
        self.radius = float(np.median(far))
        p = self.scaled(self.x[at]) @ self.a
        for level, r in enumerate(LEVELS):
            lo, width = self.windows(p, self.half(r))
            got = [self.collisions(lo[i], width[i])[j[d <= r * self.radius]] for i, (j, d) in enumerate(near)]
            got = np.concatenate(got)
            self.threshold[level] = int(np.quantile(got, MISS)) if len(got) else PROJECTIONS

    def half(self, r: float) -> float:
        return r * self.radius / np.sqrt(self.lifted.shape[1])

    def nearest(self, q: np.ndarray, own: np.ndarray, ids: np.ndarray):
        """(query position, row positions, inner products) of every query; ``own``: first and last + 1 position of rows with its id."""
        p = self.scaled(q) @ self.a
        left = np.arange(len(q))
        for level, r in [*enumerate(LEVELS), (None, None)]:
            if level is not None:
                lo, width = self.windows(p[left], self.half(r))
            again = []
            for at, i in enumerate(left):
                if level is None:
                    cand = np.arange(len(self.x))
                else:
                    cand = np.flatnonzero(self.collisions(lo[at], width[at]) >= self.threshold[level])
                cand = cand[(cand < own[i, 0]) | (cand >= own[i, 1])]
                want = min(self.want, len(self.x) - int(own[i, 1] - own[i, 0]))
                s = self.x[cand] @ q[i]
                b = best(s, ids[cand], want)
                if level is not None and (len(b) < want or want and self.distance(q[i], s[b[-1:]])[0] > r * self.radius):
                    again.append(i)
                    continue
                yield i, cand[b], s[b]
            left = np.array(again, int)
            if not len(left):
                return


def kernel(k: int):
    def run(x, ids, q, qids):
        own = np.stack([np.searchsorted(ids, qids, "left"), np.searchsorted(ids, qids, "right")], axis=1)
        out = [(np.full(len(c), qids[i]), ids[c], s) for i, c, s in Index(x, k).nearest(q, own, ids)]
        return tuple(np.concatenate(c) for c in zip(*out)) if out else ([], [], [])

    return run


def op4_ann(rows: DataFrame, k: int = K, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found by inner product."""
    some = valid(rows).filter(F.exists("embedding", lambda x: x != 0))
    return search(some, F.col("vec_id") % every == 0, k, kernel(k), "double")
