"""Similarity join on sets of word n-grams: rare-first prefix filtering with length, positional and suffix filters.

Flow. One pass over the texts turns every row into its set of distinct n-gram hashes (56 bits). A task packs rows into blocks; rows
of a block with the same set send it once. A block's distinct n-grams go, packed, to buckets by their upper bits, where
document frequencies are counted; back to the block go only those that some other row has too. There every set is put in one global order, rarest
first: a set of n n-grams can only have a partner if one of its first n - ceil(t n) + 1 is shared, and those shared ones are its
entries (n-gram, place, and the numbers of later n-grams by class). Rows without entries are done.

Entries are joined on the n-gram. A pair passes if its sizes allow the similarity (length filter), if enough n-grams are left
after its places (positional filter), and if the class counts after the places don't differ by more than the pair's allowance
(suffix filter, with fixed classes of the hash as its partition). Passing pairs are made distinct and verified once on their
whole shared n-grams. Equal sets are one class all along. So that a family of m near-copies doesn't cost m^2 pairs, the join has two rounds: the
first pairs each entry with the leaders of its n-gram, one per band of sizes in two overlapping systems of bands (the leader
is the set with the least share of n-grams of its own, as an original has). The second pairs, per n-gram, every two members
that the first round has left in different components; an n-gram whose members are all in one component has nothing left to say.
The links of both rounds connect exactly what all links would.

Defined cases: a text without words (or null) has an empty set and is linked with nothing; fewer words than an n-gram make one
n-gram of all of them; a null doc_id is never a component_id unless a whole component has no id; repeated rows are returned
repeatedly; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokscope.llm.common import batch, settle, written
from tokscope.llm.components import components

WORDS = 5
PERCENT = 80
BITS = 56                    # of an n-gram hash
BUCKET_GRAMS = 1_500_000     # n-grams counted by a group, about
BLOCK_GRAMS = 2_000_000      # n-grams of a block, unless one text has more
BLOCK_DOCS = 32_768
CLASSES = 8                  # of the suffix filter
SALT = 4_096                 # members of an n-gram that meet in one group of the second round

_SEVERAL = 0xFFFF            # instead of a row's place in the block: several rows have the n-gram
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def grams(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of the ASCII-lowered text; of the whole sequence if it has fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()        # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    x = np.full(n, k, np.uint64)
    for j in range(k):
        x = (x ^ h[j:j + n]) * _MUL[j % 5]
        x ^= x >> np.uint64(29)
    x *= _MUL[2]
    return np.unique((x ^ (x >> np.uint64(32))) >> np.uint64(64 - BITS))


def needed(n, percent: int = PERCENT):
    """The least number of n-grams that a set of ``n`` shares with any partner."""
    return -(-percent * n // 100)


# -- packed n-grams ----------------------------------------------------------------------------------------------------
def pack(g: np.ndarray, width: int) -> bytes:
    """The lower ``width`` bytes of every number."""
    return g.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").reshape(-1)


#: kind 0: (to bucket or back) n-grams with the place of their row and count; 1: n-grams that several rows of the block have, with the
#: rows' places; 2: the rows: doc_id, size, null or not, and 128-bit signature
_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("g", pa.binary()), ("at", pa.binary()), ("n", pa.binary())])
_SENT_SQL = "bucket int, block bigint, kind int, g binary, at binary, n binary"


def _block(block: int, ids: list, sets: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Everything that a block of rows sends."""
    width = -(-(BITS - bits) // 8)
    sign = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
    seen: dict[bytes, int] = {}
    first = np.array([seen.setdefault(s, i) == i for i, s in enumerate(sign)], bool)
    size = np.array([len(s) for s in sets], np.int64)
    null = np.array([d is None for d in ids], np.uint8)
    about = np.array([0 if d is None else d for d in ids], np.int64).tobytes() + size.tobytes() + null.tobytes()
    yield batch(_SENT, ([-1], [block], [2], [about], [b"".join(sign)], [None]))
    keep = np.flatnonzero(first & (size > 0))
    if not len(keep):
        return
    g = np.concatenate([sets[i] for i in keep])
    at = np.repeat(keep, size[keep]).astype(np.uint16)
    order = np.argsort(g, kind="stable")
    g, at = g[order], at[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    count = np.diff(np.r_[start, len(g)])
    many = np.repeat(count > 1, count)
    if many.any():
        yield batch(_SENT, ([-1], [block], [1], [pack(g[many], 7)], [at[many].tobytes()], [None]))
    g, at = g[start], np.where(count > 1, _SEVERAL, at[start]).astype(np.uint16)
    bucket = (g >> np.uint64(BITS - bits)).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[cut[1:], len(g)]
    for i in range(0, len(cut), 64):
        part = list(zip(cut[i:i + 64].tolist(), ends[i:i + 64].tolist()))
        yield batch(_SENT, ([int(bucket[a]) for a, _ in part], [block] * len(part), [0] * len(part), [pack(g[a:b], width) for a, b in part],
                            [at[a:b].tobytes() for a, b in part], [count[a:b].astype("<u4").tobytes() for a, b in part]))


def _blocks(docs: DataFrame, k: int, bits: int) -> DataFrame:
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, sets, total = [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                ids.append(doc_id.as_py())
                sets.append(grams(text.as_py(), k))
                total += len(sets[-1])
                if total >= BLOCK_GRAMS or len(ids) >= BLOCK_DOCS:
                    yield from _block(part << 24 | number, ids, sets, bits)
                    number, ids, sets, total = number + 1, [], [], 0
        if ids:
            yield from _block(part << 24 | number, ids, sets, bits)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _SENT_SQL)


def _shared(bits: int):
    """A bucket's answer to each block: its n-grams that more than one row has, with their document frequencies."""
    width = -(-(BITS - bits) // 8)

    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        if bucket < 0:
            return t
        blocks = t.column("block").to_pylist()
        raw = t.column("g").to_pylist()
        sizes = np.array([len(r) // width for r in raw])
        g = unpack(b"".join(raw), width)
        at = np.frombuffer(b"".join(t.column("at").to_pylist()), np.uint16)
        n = np.frombuffer(b"".join(t.column("n").to_pylist()), "<u4").astype(np.int64)
        order = np.argsort(g, kind="stable")
        start = np.flatnonzero(np.r_[True, g[order][1:] != g[order][:-1]])
        df = np.empty(len(g), np.int64)
        df[order] = np.repeat(np.add.reduceat(n[order], start), np.diff(np.r_[start, len(g)]))
        rows = []
        for block, a, b in zip(blocks, np.r_[0, np.cumsum(sizes)[:-1]].tolist(), np.cumsum(sizes).tolist()):
            keep = np.flatnonzero(df[a:b] > 1) + a
            if len(keep):
                whole = g[keep] | np.uint64(bucket) << np.uint64(BITS - bits)
                rows.append((bucket, block, 0, pack(whole, 7), at[keep].tobytes(), np.minimum(df[keep], 0xFFFFFFFF).astype("<u4").tobytes()))
        return pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, _SENT)], schema=_SENT)

    return run


# -- entries -----------------------------------------------------------------------------------------------------------
#: kind 0: a row (row, doc_id, size, signature); 1: an entry (gram, row, size, place, own: n-grams that nobody else has, tail:
#: later n-grams by class); 2: a set (row, size, its shared n-grams)
_OUT = pa.schema([("kind", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()), ("sign", pa.binary()), ("gram", pa.int64()),
                  ("place", pa.int64()), ("own", pa.int64()), ("tail", pa.list_(pa.int32())), ("grams", pa.binary())])
_OUT_SQL = ("kind int, row bigint, doc_id bigint, size bigint, sign binary, gram bigint, place bigint, own bigint, tail array<int>, grams binary")


def _table(rows: int, **cols) -> pa.Table:
    return pa.table([pa.array(cols[f.name], type=f.type) if f.name in cols else pa.nulls(rows, f.type) for f in _OUT], schema=_OUT)


def _prefixes(percent: int):
    """A block's rows, entries and sets, from its rows and the answers of the buckets."""
    def run(t: pa.Table) -> pa.Table:
        base = t.column("block")[0].as_py() << 16
        kind = t.column("kind").to_numpy()
        g, at, n = (t.column(c).to_pylist() for c in ("g", "at", "n"))
        (r,) = np.flatnonzero(kind == 2)
        docs = len(at[r]) // 16
        size = np.frombuffer(g[r], np.int64, docs, 8 * docs)
        null = np.frombuffer(g[r], np.uint8, docs, 16 * docs) == 1
        out = [_table(docs, kind=[0] * docs, row=base + np.arange(docs), doc_id=pa.array(np.frombuffer(g[r], np.int64, docs), mask=null), size=size,
                      sign=[at[r][i:i + 16] for i in range(0, 16 * docs, 16)])]
        back = np.flatnonzero(kind == 0)
        whole = unpack(b"".join([g[i] for i in back]), 7)
        doc = np.frombuffer(b"".join([at[i] for i in back]), np.uint16).astype(np.int64)
        df = np.frombuffer(b"".join([n[i] for i in back]), "<u4").astype(np.int64)
        one = doc != _SEVERAL
        for i in np.flatnonzero(kind == 1):
            order = np.argsort(whole[~one], kind="stable")
            known, freq = whole[~one][order], df[~one][order]
            many = unpack(g[i], 7)
            whole, df = np.r_[whole[one], many], np.r_[df[one], freq[np.searchsorted(known, many)]]
            doc = np.r_[doc[one], np.frombuffer(at[i], np.uint16)]
        shared = np.bincount(doc, minlength=docs)
        fits = (shared >= needed(size, percent)) & (shared > 0)
        keep = fits[doc]
        whole, doc, df = whole[keep], doc[keep], df[keep]
        order = np.lexsort((whole, df, doc))                                        # each set rarest first
        whole, doc = whole[order], doc[order]
        for a, b in zip(*(x.tolist() for x in _runs(doc))):
            i, s = int(doc[a]), whole[a:b]
            m, own = int(size[i]), int(size[i]) - (b - a)
            take = m - needed(m, percent) + 1 - own                                  # entries: the shared ones of the prefix
            tail = np.zeros((b - a + 1, CLASSES), np.int32)
            tail[np.arange(b - a), (s % np.uint64(CLASSES)).astype(int)] = 1
            tail = np.cumsum(tail[::-1], axis=0)[::-1][1:take + 1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, CLASSES * take + 1, CLASSES), pa.int32()), pa.array(tail.reshape(-1), pa.int32()))
            row = base + i
            out.append(_table(take, kind=[1] * take, row=[row] * take, size=[m] * take, gram=s[:take].astype(np.int64), place=own + np.arange(take),
                              own=[own] * take, tail=lists))
            out.append(_table(1, kind=[2], row=[row], size=[m], grams=[pack(np.sort(s), 8)]))
        return pa.concat_tables(out).combine_chunks()

    return run


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal numbers."""
    start = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return start, np.r_[start[1:], len(x)] if len(x) else start


def prepared(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows, entries and sets of all ``docs`` (see ``_OUT``), written once."""
    chars = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    bits = min(24, max(8, math.ceil(math.log2(max(chars / 6 / BUCKET_GRAMS, 1)))))
    sent = _blocks(docs, k, bits)
    rest = F.when(F.col("bucket") < 0, F.col("block"))                              # what goes to the block is only passed on
    back = sent.groupBy("bucket", rest.alias("own_block")).applyInArrow(_shared(bits), _SENT_SQL)
    return written(back.groupBy("block").applyInArrow(_prefixes(percent), _OUT_SQL), "entries")


# -- joins -------------------------------------------------------------------------------------------------------------
def _passes(a: str, b: str, percent: int) -> Column:
    """Length, positional and suffix filter for two entries of one n-gram."""
    def c(side, name):
        return F.col(f"{side}.{name}")

    both = c(a, "size") + c(b, "size")
    least = F.ceil((F.lit(percent) * both) / F.lit(100 + percent))                  # n-grams that a similar pair shares
    length = F.lit(100) * F.least(c(a, "size"), c(b, "size")) >= F.lit(percent) * F.greatest(c(a, "size"), c(b, "size"))
    places = F.least(c(a, "size") - c(a, "place"), c(b, "size") - c(b, "place")) >= least
    apart = sum((F.abs(c(a, "tail")[i] - c(b, "tail")[i]) for i in range(CLASSES)), F.lit(0))
    return length & places & (apart <= both - 2 * least - c(a, "place") - c(b, "place"))


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("a.row", "b.row").alias("a"), F.greatest("a.row", "b.row").alias("b")).distinct()


def with_leaders(entries: DataFrame, percent: int) -> DataFrame:
    """a, b: distinct passing pairs of every entry with its n-gram's leaders."""
    band = F.log("size") / math.log(100 / percent)
    keyed = entries.withColumn("band", F.explode(F.array(2 * F.floor(band), 2 * F.floor(band + 0.5) + 1)))
    best = F.min(F.struct((F.col("own") / F.col("size")).alias("share"), "row", "size", "place", "tail")).alias("best")
    lead = (keyed.groupBy("gram", "band").agg(best, F.count(F.lit(1)).alias("m")).filter("m > 1")
            .select("gram", "band", "best.row", "best.size", "best.place", "best.tail"))
    x, y = keyed.alias("a"), lead.alias("b")
    same = (F.col("a.gram") == F.col("b.gram")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.row") != F.col("b.row"))
    return _pairs(x.join(y, same & _passes("a", "b", percent)))


def across(entries: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """a, b: distinct passing pairs of members of an n-gram in different components, ``comp`` (node, root)."""
    named = settle(entries.join(comp, F.col("row") == F.col("node"), "left").select(
        "gram", "row", "size", "place", "tail", F.coalesce("root", "row").alias("root")))
    per = named.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("m"))
    top = per.groupBy("gram").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("all"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    live = named.join(top.select("gram", F.col("top.root").alias("main"), F.ceil(F.col("all") / SALT).cast("int").alias("parts")), "gram")
    few = live.filter("root <> main").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    every = live.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    x, y = few.alias("a"), every.alias("b")
    same = (F.col("a.gram") == F.col("b.gram")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.root") != F.col("b.root"))
    return _pairs(x.join(y, same & _passes("a", "b", percent)))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b of the ``pairs`` that are as similar as required, counted on their whole sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in batches:
            keep = np.zeros(t.num_rows, bool)
            cols = (t.column(c) for c in ("na", "nb", "ga", "gb"))
            for i, (na, nb, ga, gb) in enumerate(zip(*cols)):
                x, y = np.frombuffer(ga.as_buffer(), "<u8"), np.frombuffer(gb.as_buffer(), "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * common >= percent * (na.as_py() + nb.as_py() - common)
            yield batch(schema, (t.column("a").filter(pa.array(keep)), t.column("b").filter(pa.array(keep))))

    one = sets.select(F.col("row").alias("a"), F.col("size").alias("na"), F.col("grams").alias("ga"))
    two = sets.select(F.col("row").alias("b"), F.col("size").alias("nb"), F.col("grams").alias("gb"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a bigint, b bigint")


def linked(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows, links). rows: row, doc_id, size, class (a row with the same set; its own for an empty one). links: a, b: a spanning
    part of the links between classes, which connects exactly what all links would."""
    out = prepared(docs, k, percent)
    rows = out.filter("kind = 0").select("row", "doc_id", "size", "sign")
    classes = settle(rows.filter("size > 0").groupBy("size", "sign").agg(F.min("row").alias("class")))
    reps = classes.select(F.col("class").alias("row"))
    entries = settle(out.filter("kind = 1").select("gram", "row", "size", "place", "own", "tail").join(reps, "row", "left_semi"))
    sets = settle(out.filter("kind = 2").select("row", "size", "grams").join(reps, "row", "left_semi"))
    tried = settle(with_leaders(entries, percent))
    links = settle(verified(tried, sets, percent))
    more = across(entries, components(links), percent).join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(settle(verified(more, sets, percent)))
    one = rows.filter("size > 0").join(classes, ["size", "sign"]).select("row", "doc_id", "size", "class")
    return one.unionByName(rows.filter("size = 0").select("row", "doc_id", "size", F.col("row").alias("class"))), links


def op11_ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    rows, links = linked(docs)
    rows = settle(rows)
    comp = components(links)
    rooted = settle(rows.groupBy("class").agg(F.min("doc_id").alias("least")).join(comp, F.col("class") == F.col("node"), "left")
                    .select("class", "least", F.coalesce("root", "class").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(rooted.join(least, "root").select(F.col("class").alias("key"), "component_id"))
    return rows.join(named, F.col("class") == F.col("key")).select("doc_id", F.col("size").alias("n_shingles"), "component_id")


#: All pairs that share a shingle, and what they reach: for tables of a few thousand rows.
ORACLE_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS sh FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid),
c AS (SELECT x.rid AS a, y.rid AS b, count(*) AS m FROM s x JOIN s y USING (sh) WHERE x.rid <> y.rid GROUP BY ALL),
p AS MATERIALIZED (SELECT a, b FROM c JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * m >= 80 * (na.n + nb.n - m)),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (rid) JOIN (SELECT a AS rid, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = b GROUP BY a) r USING (rid)
"""
