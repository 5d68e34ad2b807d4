"""SimHash near-duplicates: 64-bit fingerprints of word shingles, exact pairs by vantage-point trees.

Flow. Tasks compute fingerprints of whole texts; equal fingerprints are merged first, so copies never meet as pairs. A tree of
vantage points, fitted on a bounded sample of the distinct fingerprints, deals all of them to shards: at a node with vantage
point v and radius m, those with distance <= m go inside, the others outside, and an inner one with distance > m - r also goes
outside. By the triangle inequality every pair within r bits shares a leaf (inner-inner inside, all others outside). A shard
that is too large is split again by a tree of its own sample; trees grow in tasks and are joined to their shards' chunks. A shard in
which no tree makes headway is dealt by hash, and pairs of parts are compared in tasks of their own. Within a shard the task goes
on splitting and compares the leaves in blocks. A leaf returns the links of a spanning forest, at most one per
fingerprint, never all pairs; components over all leaves then follow by Spark joins.

Defined cases: null or empty text has fingerprint 0 and links like any other; a null doc_id never becomes a component_id
unless a whole component has no id; repeated rows are returned repeatedly; extra columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tokscope.llm.common import batch, fresh, settle, texts
from tokscope.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SAMPLE = 32_768        # fingerprints sampled for the tree in the first round of splitting
PER_SHARD = 256        # of each shard that is split again, at least
MAX_SHARD = 8_192      # fingerprints of a shard
CHUNK = 262_144        # fingerprints dealt by a group
LEAF = 1_024           # fingerprints compared directly
BLOCK = 4_000_000      # pairs compared at a time


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint: a bit is 1 if set in over half the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()     # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    starts, ends = (starts[:len(words) - k + 1], ends[k - 1:]) if len(words) >= k else (starts[:1], ends[-1:])
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 16_384):
        ones += np.unpackbits(h[i:i + 16_384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed), th (hash of the text) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            f = np.array([fingerprint(t, k) for t in texts(b.column(2))], np.uint64).view(np.int64)
            yield batch(schema, (b.column(0), b.column(1), f))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(run, "doc_id bigint, th bigint, fp bigint")


# -- vantage-point trees ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Node:
    vantage: int
    radius: int
    inside: Node | str
    outside: Node | str


def distances(points: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(vantage)).astype(np.int16)


def choose(points: np.ndarray, r: int, rng: np.random.Generator) -> tuple[int, int] | None:
    """The vantage point and radius with the smallest larger side; None if no split shrinks that to 0.85 of all."""
    best, found = 0.85 * len(points), None
    for v in rng.choice(points, min(8, len(points)), replace=False):
        within = np.cumsum(np.bincount(distances(points, v), minlength=65))
        for m in range(64):
            overlap = within[m] - (within[m - r] if m >= r else 0)
            larger = max(within[m], len(points) - within[m] + overlap) + 0.25 * overlap
            if 0 < within[m] < len(points) and larger < best:
                best, found = larger, (int(v), m)
    return found


def split(points: np.ndarray, node: tuple[int, int], r: int) -> tuple[np.ndarray, np.ndarray]:
    d = distances(points, node[0])
    return points[d <= node[1]], points[d > node[1] - r]


def grow(points: np.ndarray, size: float, name: str, r: int, rng: np.random.Generator) -> Node | str:
    """Tree over a sample that stands for ``size`` points; leaves are shard names, ending in '!' where no split helps."""
    if size <= MAX_SHARD or len(points) < 16:
        return name
    found = choose(points, r, rng)
    if found is None:
        return name + "!"
    i, o = split(points, found, r)
    per = size / len(points)
    return Node(*found, grow(i, len(i) * per, name + "0", r, rng), grow(o, len(o) * per, name + "1", r, rng))


def deal(tree: Node | str, points: np.ndarray, r: int):
    """Yield (shard name, points) of every leaf that gets points."""
    if not len(points):
        return
    if isinstance(tree, str):
        yield tree, points
        return
    i, o = split(points, (tree.vantage, tree.radius), r)
    yield from deal(tree.inside, i, r)
    yield from deal(tree.outside, o, r)


def shards(fps: DataFrame, r: int, max_shard: int | None = None) -> DataFrame:
    """fp, shard: every pair within ``r`` bits meets in a shard; shards hold ``max_shard`` fingerprints where trees can split them,
    otherwise twice as many (see :func:`paired`). Shards that are too large are sampled, grown and dealt in tasks, in chunks of
    about ``CHUNK`` fingerprints; two numbers a round reach the driver."""
    size = max_shard or MAX_SHARD
    state = settle(fps.select("fp", F.lit("s").alias("shard")))

    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        pts = np.sort(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
        s = pdf["shard"].iloc[0]
        tree = grow(pts, float(pdf["n"].iloc[0]) * MAX_SHARD / size, s, r, np.random.default_rng(11))
        return pd.DataFrame({"shard": [s], "tree": [pickle.dumps(s + "!" if tree == s else tree)]})

    def dealt(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a):
            return pd.DataFrame({"fp": [], "shard": []})
        s = a["shard"].iloc[0]
        tree = pickle.loads(b["tree"].iloc[0]) if len(b) else s + "!"       # no sample: final
        found = list(deal(tree, a["fp"].to_numpy(np.int64).view(np.uint64), r))
        return pd.DataFrame({"fp": np.concatenate([q for _, q in found]).view(np.int64), "shard": np.repeat([x for x, _ in found], [len(q) for _, q in found])})

    while True:
        sizes = settle(state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > size) & ~F.col("shard").endswith("!")))
        big = sizes.agg(F.count(F.lit(1)).alias("shards"), F.max("n").alias("n")).first()
        if not big.shards:
            return paired(state, size)
        salts, share = math.ceil(big.n / CHUNK), max(PER_SHARD, SAMPLE // big.shards)
        each = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
        salted = state.withColumn("salt", F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(salts)).cast("int"))
        large = salted.join(sizes.select("shard", "n", each), ["shard", "salt"], "left")
        u = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) / float(1 << 30)
        trees = settle(large.filter(u < F.lit(float(share)) / F.col("n")).select("shard", "n", "fp").groupBy("shard").applyInPandas(grown, "shard string, tree binary"))
        moved = (large.filter("n IS NOT NULL").select("shard", "salt", "fp").groupBy("shard", "salt")
                 .cogroup(trees.select("shard", "tree", each).groupBy("shard", "salt")).applyInPandas(dealt, "fp bigint, shard string"))
        state = settle(large.filter("n IS NULL").select("fp", "shard").unionByName(moved))


def paired(state: DataFrame, size: int) -> DataFrame:
    """``state`` with the shards that no tree can split, and that are larger than ``size``, dealt by hash into parts of that size;
    every pair of parts is a shard of its own, so that no task compares more than two parts."""
    final = state.filter(F.col("shard").endswith("!")).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size)
    parts = settle(final.select(F.col("shard").alias("s"), F.ceil(F.col("n") / size).cast("int").alias("p")))
    rows = state.join(parts, F.col("shard") == F.col("s"), "left")
    own = F.pmod(F.xxhash64("fp", F.lit(2)), F.col("p")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("p") - 1))
    both = rows.filter("s IS NOT NULL").select("fp", "s", own.alias("i"), other.alias("j")).select(
        "fp", F.concat_ws("-", "s", F.least("i", "j").cast("string"), F.greatest("i", "j").cast("string")).alias("shard"))
    return rows.filter("s IS NULL").select("fp", "shard").unionByName(both)


# -- within a shard --------------------------------------------------------------------------------------------------
def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of n nodes."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        np.minimum.at(new, label[i], m)
        np.minimum.at(new, label[j], m)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def leaf_links(p: np.ndarray, r: int) -> list[np.ndarray]:
    """Links of a spanning forest of ``p`` under distance <= r, comparing blocks of rows with all later rows."""
    n, label = len(p), np.arange(len(p))
    step = max(1, BLOCK // max(n, 1))
    for a in range(0, n, step):
        i, j = np.nonzero(np.bitwise_count(p[a:a + step, None] ^ p[None, a:]) <= r)
        i, j = i + a, j + a
        up = i < j
        if up.any():
            label = forest(n, np.concatenate([i[up], np.arange(n)]), np.concatenate([j[up], label]))
    low = np.flatnonzero(label != np.arange(n))
    return [np.stack([p[low], p[label[low]]], axis=1)] if len(low) else []


def shard_links(p: np.ndarray, r: int, rng: np.random.Generator) -> list[np.ndarray]:
    if len(p) <= LEAF or (found := choose(p if len(p) <= 4 * LEAF else rng.choice(p, 4 * LEAF, replace=False), r, rng)) is None:
        return leaf_links(p, r)
    i, o = split(p, found, r)
    if max(len(i), len(o)) >= len(p):
        return leaf_links(p, r)
    return shard_links(i, r, rng) + shard_links(o, r, rng)


def links(fps: DataFrame, r: int = MAX_BITS, max_shard: int | None = None) -> DataFrame:
    """a, b: a spanning set of the links (distance <= r) between the distinct fingerprints ``fps`` (column fp)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = np.sort(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
        found = shard_links(p, r, np.random.default_rng(5))
        e = np.unique(np.concatenate(found), axis=0).view(np.int64) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})

    return shards(fps, r, max_shard).groupBy("shard").applyInPandas(run, "a bigint, b bigint")


def groups(docs: DataFrame, k: int = SHINGLE, r: int = MAX_BITS, max_shard: int | None = None) -> DataFrame:
    """doc_id, th, fp, root (a fingerprint of the group), component_id (its smallest doc_id) for every row of ``docs``."""
    rows = settle(fingerprints(docs, k))
    merged = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = components(links(merged.select("fp"), r, max_shard))
    rooted = settle(merged.join(comp, F.col("fp") == F.col("node"), "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "top")
    named = settle(rooted.join(least, F.col("root") == F.col("top")).select(F.col("fp").alias("key"), "root", "component_id"))
    return rows.join(named, F.col("fp") == F.col("key")).drop("key")


def op7_simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    g = groups(docs)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, k: int = SHINGLE, r: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` (same columns) of each group: that with the smallest doc_id (rows without id last; then the smallest
    text hash). Of rows with equal id and text one stays."""
    g = groups(docs, k, r)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("s")
    i, t, a, b, n = fresh(docs, "i", "t", "a", "b", "n")
    kept = settle(g.groupBy("root").agg(first).select(F.col("s.doc_id").alias(i), F.col("s.th").alias(t)).distinct())
    rows = docs.withColumn(a, F.col("doc_id").cast("bigint")).withColumn(b, F.xxhash64("text"))
    one = rows.join(kept, F.col(a).eqNullSafe(F.col(i)) & (F.col(b) == F.col(t)), "left_semi")
    return one.withColumn(n, F.row_number().over(W.partitionBy(a, b).orderBy(a))).filter(F.col(n) == 1).drop(a, b, n)
