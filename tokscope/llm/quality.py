"""Quality classifier: random Fourier features over document statistics, ridge regression from partition-summed
normal equations, isotonic calibration.

Flow. One pass computes ``N_STATS`` statistics of every whole text. The labelled rows (joined on the narrow statistics, never
on the text) are checkpointed; each task then sums ``z z'`` and ``z y`` of its rows, and only those D x D sums are
merged, in two levels. The D x D system is solved on the driver. Raw ridge scores are counted in fixed-width bins, and
pool-adjacent-violators over the bins gives the calibration. All labelled training rows are used; there is no sample.

Defined cases: null or empty text has the statistics of an empty text and gets a score like any other; rows without a label
(or with a null label or null doc_id) only get scores; a doc_id labelled twice counts twice; repeated documents give
repeated rows; with no labelled row every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokscope.llm.common import batch, fresh, is_fold, settle, texts

D_FEATURES = 192       # random Fourier features
RIDGE = 1e-3           # ridge weight per training row
BIN = 1 / 1024         # width of a calibration bin of raw scores
RAW_LO, RAW_HI = -2.0, 3.0
KEEP_AT = 0.3

# byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 newline, 6 sentence marks, 7 '!', 8 '|', 9 '#$%&*', 10 non-ASCII
_CLASS = np.zeros(256, np.uint8)
for _c, _s in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"), (4, b" \t\r\x0b\x0c"),
               (5, b"\n"), (6, b".,;:?'\"-()"), (7, b"!"), (8, b"|"), (9, b"#$%&*")):
    _CLASS[list(_s)] = _c
_CLASS[128:] = 10
N_CLASS = 11
N_STATS = N_CLASS + N_CLASS + 9


def text_stats(text: str | None) -> np.ndarray:
    """Shares of byte classes, classes at word ends, word lengths, repetition, and byte entropy of one text."""
    out = np.zeros(N_STATS, np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    a = np.frombuffer(raw, np.uint8)
    h = np.bincount(a, minlength=256)
    out[:N_CLASS] = np.bincount(_CLASS, weights=h, minlength=N_CLASS) / len(a)
    cls = _CLASS[a]
    blank = (cls == 4) | (cls == 5)
    ends = np.flatnonzero(blank[1:] & ~blank[:-1])
    if not blank[-1]:
        ends = np.append(ends, len(a) - 1)
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if not blank[0]:
        starts = np.append(0, starts)
    k = N_CLASS
    if len(ends):
        out[k:k + N_CLASS] = np.bincount(cls[ends], minlength=N_CLASS) / len(ends)
        ln = ends - starts + 1
        words = raw.split()
        count = Counter(words)
        out[2 * k:2 * k + 6] = (np.log1p(ln.mean()), np.log1p(ln.std()), len(count) / len(words), np.log1p(len(words)) / 12,
                                max(count.values()) / len(words), sum(map(eq, words, islice(words, 1, None))) / len(words))
    lines = raw.split(b"\n")
    p = h[h > 0] / len(a)
    out[2 * N_CLASS + 6:] = (np.log1p(len(a)) / 16, len(set(lines)) / len(lines), -(p * np.log2(p)).sum() / 8)
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray       # N_STATS x D
    phase: np.ndarray
    coef: np.ndarray       # D + 1, the last is the intercept
    cal_x: np.ndarray      # raw score -> calibrated probability, non-decreasing
    cal_y: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.cos(((stats - self.mean) / self.scale) @ self.freq + self.phase) * np.sqrt(2 / self.freq.shape[1])
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.coef, RAW_LO, RAW_HI)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.cal_x, self.cal_y), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators of means ``y`` with weights ``w`` in the order of ``x``: block centres and block means."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, y, w):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    m = np.array(blocks)
    return m[:, 0] / m[:, 2], m[:, 1] / m[:, 2]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stats (array of float) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float32()))])

    def run(batches):
        for b in batches:
            yield batch(schema, (b.column(0), [text_stats(t) for t in texts(b.column(1))]))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, stats array<float>")


def _matrix(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)


def normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sum over all rows of ``z z'`` and ``z y``: one matrix per task, merged in two levels."""
    d = model.freq.shape[1] + 1

    def local(batches):
        acc = np.zeros((d, d + 1))
        for b in batches:
            if b.num_rows:
                z = model.features(_matrix(b, "stats"))
                acc += z.T @ np.hstack([z, b.column("y").to_numpy(zero_copy_only=False).astype(np.float64)[:, None]])
        from pyspark import TaskContext
        part = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_pydict({"part": [part] * d, "i": list(range(d)), "v": list(acc)},
                                         schema=pa.schema([("part", pa.int32()), ("i", pa.int32()), ("v", pa.list_(pa.float64()))]))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [0], "i": [pdf["i"].iloc[0]], "v": [np.sum(np.stack(pdf["v"].to_numpy()), axis=0)]})

    schema = "part int, i int, v array<double>"
    sums = train.mapInArrow(local, schema).groupBy("part", "i").applyInPandas(merge, schema).groupBy("i").applyInPandas(merge, schema)
    rows = {r.i: np.array(r.v) for r in sums.collect()}        # D rows of D + 1 numbers
    acc = np.stack([rows[i] for i in range(d)]) if rows else np.zeros((d, d + 1))
    return acc[:, :d], acc[:, d]


def fit(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model | None:
    """Learn from ``labels`` (doc_id, quality); None without a labelled document."""
    lab = labels.select(F.col("doc_id").cast("bigint").alias("lab_id"), F.col("quality").cast("double").alias("y")).dropna()
    train = settle(statistics(docs).join(lab, F.col("doc_id") == F.col("lab_id")).select("stats", "y"))
    n, *moments = train.select(
        F.count(F.lit(1)), *(f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(N_STATS))).first()
    if not n:
        return None
    mean, std = np.array(moments[:N_STATS]), np.array(moments[N_STATS:])
    rng = np.random.default_rng(seed)
    scale = np.where(std > 1e-6, std, 1.0) * np.sqrt(N_STATS)       # kernel width: the root of the dimension
    start = Model(mean, scale, rng.normal(size=(N_STATS, D_FEATURES)) * 1.5, rng.uniform(0, 2 * np.pi, D_FEATURES),
                  np.zeros(D_FEATURES + 1), np.array([0.0]), np.array([0.5]))
    a, b = normal_equations(train, start)
    coef = np.linalg.solve(a + RIDGE * n * np.eye(len(a)), b)
    ridge = Model(start.mean, start.scale, start.freq, start.phase, coef, start.cal_x, start.cal_y)

    def raw(batches):
        schema = pa.schema([("bin", pa.int32()), ("raw", pa.float64()), ("y", pa.float64())])
        for x in batches:
            if x.num_rows:
                r = ridge.raw(_matrix(x, "stats"))
                yield batch(schema, (np.floor(r / BIN).astype(np.int32), r, x.column("y")))

    bins = (train.mapInArrow(raw, "bin int, raw double, y double").groupBy("bin")
            .agg(F.avg("raw").alias("x"), F.avg("y").alias("m"), F.count(F.lit(1)).alias("w")).orderBy("bin").toPandas())
    x, y = isotonic(*(bins[c].to_numpy(np.float64) for c in ("x", "m", "w")))
    return Model(ridge.mean, ridge.scale, ridge.freq, ridge.phase, coef, x, y)


def score_column(model: Model | None, text):
    """Column: the calibrated score of a text."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(t: pa.Array) -> pa.Array:
        return pa.array(model.score(np.stack([text_stats(x) for x in texts(t)]).astype(np.float64)) if len(t) else [], pa.float64())

    return score(text)


def op9_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; learns from rows that are not held out."""
    train = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~is_fold("doc_id", 5, 0))
    model = fit(train, labels)
    s = docs.select("doc_id", is_fold("doc_id", 5, 0).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` (same columns) that the classifier accepts."""
    model = fit(docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~is_fold("doc_id", 5, 0)), labels)
    (s,) = fresh(docs, "score")
    return docs.withColumn(s, score_column(model, F.col("text"))).filter(F.col(s) >= KEEP_AT).drop(s)
