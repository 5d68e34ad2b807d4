"""Importance resampling towards a target set: an untrained ``tokenizers`` splitter, hashed n-gram histograms, summed gains.

Flow. A pre-tokeniser of the ``tokenizers`` library (a regular-expression ``Split``; nothing is trained) returns the words of
the ASCII-lowered text with their offsets. A feature is a window of ``lo`` to ``hi`` consecutive words, found from the offset
pairs of its first and last word; its bucket is a CRC of its bytes. The one pass over the texts writes every row's buckets
as packed bytes (two a feature). From that table each task adds up one histogram; the histograms of source and target, one
number a bucket, give the gains. A second pass over the packed buckets sums each row's gains. Rows of at least
``min_words`` words then take part in a draw without replacement: weight plus Gumbel noise from a hash of the id, the highest
scores first. The rank is a range-partitioned sort with an offset a partition, so no task sees all rows.

Defined cases: null or empty text has no features and weight 0; a null doc_id is hashed like an empty one and loses ties;
repeated rows are drawn one by one, in any order among themselves; empty tables give no rows, an empty target gives gains
against zero counts; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokscope.llm.common import batch, ranked, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000           # at most 65,536: a bucket is kept in two bytes
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000               # gains and scores are whole thousandths
MEMO_BYTES = 16 << 20      # of words that a task remembers with their buckets, about

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PIECE = 1 << 20           # code points handed to the pre-tokeniser at a time
_BREAK = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]")


def splitter():
    """The pre-tokeniser: words with their offsets, everything between them removed."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    return Split(Regex(WORD), behavior="removed", invert=True)


def _pieces(text: str) -> Iterator[str]:
    """A whole text in pieces that end between two words, so that a very long one needs bounded memory."""
    at = 0
    while len(text) - at > _PIECE:
        found = _BREAK.search(text, at + _PIECE)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


class Buckets:
    """Buckets of the windows of ``lo`` to ``hi`` consecutive words of a text."""

    def __init__(self, lo: int = 1, hi: int = 1, buckets: int = BUCKETS):
        self.lo, self.hi, self.buckets = lo, hi, buckets
        self.split = splitter().pre_tokenize_str
        self.memo: dict[str, int] = {}
        self.used = 0

    def _bucket(self, feature: str) -> int:
        b = self.memo.get(feature)
        if b is None:
            raw = feature.encode("utf-8", "surrogatepass")
            b = zlib.crc32(raw) % self.buckets
            if len(raw) <= 64:
                self.used += 160 + len(raw)
                if self.used > MEMO_BYTES:
                    self.memo, self.used = {}, 0
                self.memo[feature] = b
        return b

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """(number of words, buckets of all windows); offsets of a later piece continue those of the one before."""
        lowered = (text or "").translate(_UPPER)
        if self.hi == 1:
            one = [self._bucket(w) for piece in _pieces(lowered) for w, _ in self.split(piece)]
            return len(one), np.array(one if self.lo <= 1 else [], "<u2")
        spans, at = [], 0
        for piece in _pieces(lowered):
            spans += [(a + at, b + at) for _, (a, b) in self.split(piece)]
            at += len(piece)
        out: list[int] = []
        for n in range(max(1, self.lo), self.hi + 1):
            for i in range(len(spans) - n + 1):
                window = spans[i:i + n]                       # words joined by one space, whatever stood between them
                out.append(self._bucket(" ".join([lowered[a:b] for a, b in window])))
        return len(spans), np.array(out, "<u2")


def features(texts: DataFrame, key: Column, lo: int = 1, hi: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """key, n_words, n_features, packed (the buckets, two bytes each) of every row."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be between 1 and 65,536")
    schema = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("packed", pa.binary())])

    def run(batches):
        find = Buckets(lo, hi, buckets)
        for b in batches:
            for i in range(0, b.num_rows, 256):               # rows whose buckets are held at a time
                part = b.slice(i, 256)
                found = [find.of(t.as_py()) for t in part.column(1)]
                yield batch(schema, (part.column(0), [n for n, _ in found], [len(f) for _, f in found], [f.tobytes() for _, f in found]))

    rows = texts.select(key.cast("bigint").alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "key bigint, n_words bigint, n_features bigint, packed binary")


def histogram(packed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features a bucket over all rows: one histogram a task, added up by Spark; ``buckets`` numbers reach the driver."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def local(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=buckets)
        at = np.flatnonzero(total)
        yield batch(schema, (at.astype(np.int32), total[at]))

    out = np.zeros(buckets, np.int64)
    sums = packed.select("packed").mapInArrow(local, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """What a feature of each bucket adds: the scaled log ratio of its smoothed shares in target and source, rounded down."""
    k, big_s, big_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log(float(t + 1) * float(big_s + k) / (float(s + 1) * float(big_t + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(packed: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the mean gain of a row's features, rounded down."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches):
        for b in batches:
            w = []
            for x in b.column("packed"):
                f = np.frombuffer(x.as_buffer(), "<u2")
                w.append(int(gain[f].sum()) // len(f) if len(f) else 0)
            yield batch(schema, (b.column("key"), b.column("n_words"), b.column("n_features"), w))

    return packed.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column | str, seed: int = SEED, scale: int = SCALE) -> Column:
    """Scaled Gumbel noise from the first 32 bits of sha256(seed:doc_id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def scored(docs: DataFrame, target: DataFrame, lo: int = 1, hi: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of ``docs`` (doc_id, text); ``target`` has a text."""
    packed = written(features(docs, F.col("doc_id"), lo, hi, buckets), "features")
    wanted = features(target, F.lit(None), lo, hi, buckets)
    gain = gains(histogram(packed, buckets), histogram(wanted, buckets))
    return weights(packed, gain).withColumn("score", F.col("weight") + noise("doc_id"))


def draw(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``rows`` with a rank (1, 2, ...) for the drawn: floor(percent * N / 100) highest scores of the N rows long enough."""
    rows = written(rows, "scored")
    long_enough = F.col("n_words") >= min_words
    k = rows.filter(long_enough).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    place = ranked(rows.filter(long_enough), order, "rank")
    taken = place.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return taken.unionByName(rows.filter(~long_enough).withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, **kw) -> DataFrame:
    """The drawn rows, best first by ``rank``: doc_id, weight, score, rank."""
    return draw(scored(docs, target), **kw).filter("rank IS NOT NULL").select("doc_id", "weight", "score", "rank")


def op12_resampling(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) of every row of ``docs``."""
    return draw(scored(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


_CRC_STEP = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
_WORDS_SQL = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + WORD + "'))"

#: crc32 by its table, a byte at a time, over the distinct words; the rest is grouping.
ORACLE_SQL = f"""
WITH RECURSIVE crc_bits(i, k, c) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, {_CRC_STEP} FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_bits WHERE k = 8),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
dw AS MATERIALIZED (SELECT rid, w, count(*) AS n FROM (SELECT rid, {_WORDS_SQL} AS w FROM d) GROUP BY ALL),
bw AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT {_WORDS_SQL} AS w FROM benchmark) GROUP BY ALL),
v AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
bytes AS (SELECT w, [CAST(4294967295 AS BIGINT)] || list_transform(range(length(x) // 2), lambda i : CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT)) AS b FROM v),
vb AS MATERIALIZED (SELECT w, xor(list_reduce(b, lambda c, y : xor(c >> 8, tab[CAST((xor(c, y) & 255) + 1 AS INT)])), 4294967295) % {BUCKETS} AS bucket FROM bytes, crc_table),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS n FROM dw JOIN vb USING (w) GROUP BY bucket),
t AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS n FROM bw JOIN vb USING (w) GROUP BY bucket),
tot AS (SELECT CAST(coalesce((SELECT sum(n) FROM s), 0) AS DOUBLE) AS big_s, CAST(coalesce((SELECT sum(n) FROM t), 0) AS DOUBLE) AS big_t),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (big_s + {BUCKETS}) / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * (big_t + {BUCKETS})))) AS BIGINT) AS gain
      FROM s FULL JOIN t USING (bucket), tot),
f AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * gain) AS BIGINT) AS total FROM dw JOIN vb USING (w) JOIN g USING (bucket) GROUP BY rid),
r AS (SELECT rid, doc_id, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
        CAST(('0x' || sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8]) AS BIGINT) AS h FROM d LEFT JOIN f USING (rid)),
sc AS (SELECT rid, doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
p AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER () AS all_n FROM sc WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, score, CASE WHEN place <= {PERCENT} * all_n // 100 THEN place END AS rank FROM sc LEFT JOIN p USING (rid)
"""
