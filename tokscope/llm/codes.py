"""Vector code compression: product codes by Lloyd's rounds whose members stay with the owner of their codebook entry.

Flow. Every vector is cut into ``parts`` equal parts of whole numbers. A member is one part of one row. Members live in partitions
by (position, entry, salt): the salt, from the row's number, deals an entry's members to half of all partitions, so that a hot
entry weighs on many. In a round a task assigns the members that reside in its partition; those that keep their entry stay
where they are, and only those that change it go through the shuffle to the new owner (the union of stayers and arrivals is
co-partitioned, so stayers are never sent). Owners then sum their residents, and one sum an entry reaches the driver, which
divides and sends out the next codebooks: ``parts * entries`` vectors of a part's width, whatever the table's size. All sums
and distances are whole numbers, so the result doesn't depend on any order. Members are packed arrays, one block a task and
target partition. Each round's members are persisted and, every ``CUT`` rounds, checkpointed in the shared folder; a lost
executor's share comes back from those or from the shuffle files before.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped, and so are vectors whose
length is not that of the row with the smallest vec_id or cannot be cut evenly, and those with a component beyond 2^16 in
size (its squares would leave a long); rows without vec_id come last and may be coded; repeated vec_ids are rows of their
own, ordered by their vectors where that matters; with fewer rows than entries the codebooks are smaller; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokscope.llm.common import batch, written
from tokscope.session import ensure_checkpoint_dir

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
TASK_MEMBERS = 1 << 18      # members a partition holds, about
LARGEST = 1 << 16           # components at or beyond this size take no part
CUT = 8                     # rounds between checkpoints
BLOCK = 2_000_000           # distances formed at a time

#: (owner: position * entries + entry, row number, part) of some members, row by row
Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def whole_parts(vectors: np.ndarray, parts: int, scale: int) -> np.ndarray:
    """rows x parts x width whole numbers."""
    return np.floor(vectors * scale).astype(np.int64).reshape(len(vectors), parts, -1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest row of ``book`` for every row of ``x``, ties to the lower index."""
    entry, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)), 1)
    kind = np.float64 if 4 * top * top * x.shape[1] < 1 << 53 else np.int64          # doubles are exact below 2^53
    b = book.astype(kind)
    norm, step = (b * b).sum(axis=1), max(1, BLOCK // max(len(book), 1))
    for i in range(0, len(x), step):
        y = x[i:i + step].astype(kind)
        d = norm - 2 * (y @ b.T)
        at = d.argmin(axis=1)
        entry[i:i + step] = at
        error[i:i + step] = d[np.arange(len(at)), at] + (y * y).sum(axis=1)
    return entry, error


def _partition(owner: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Partition of a member: its owner's first one, and the salt of its row."""
    salts = max(1, (n + 1) // 2)
    return ((owner.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) + row.astype(np.uint64) % np.uint64(salts)).astype(np.int64) % n


def _same(p: int) -> int:
    """The partition of a key that is one; a single function, so that all RDDs dealt by it are co-partitioned."""
    return p


def _merged(blocks: Iterable[Block]) -> Block | None:
    found = [b for b in blocks if len(b[0])]
    return tuple(np.concatenate(c) for c in zip(*found)) if found else None


def _dealt(block: Block, n: int) -> Iterator[tuple[int, Block]]:
    """The block's members by target partition."""
    p = _partition(block[0], block[1], n)
    order = np.argsort(p, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(p[order])) + 1):
        if len(at):
            yield int(p[at[0]]), tuple(c[at] for c in block)


def _assigned(block: Block, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner after assignment to the nearest entries, and squared distance, of every member."""
    owner, _, x = block
    entries = books.shape[1]
    new, error = owner.copy(), np.zeros(len(owner), np.int64)
    for pos in np.unique(owner // entries):
        at = np.flatnonzero(owner // entries == pos)
        e, error[at] = nearest(x[at], books[pos])
        new[at] = pos * entries + e
    return new, error


def _sums(block: Block) -> Iterator[tuple[int, np.ndarray]]:
    """owner, (sum of its resident members, their number)."""
    order = np.argsort(block[0], kind="stable")
    owner = block[0][order]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    total = np.add.reduceat(block[2][order].astype(np.int64), first, axis=0)
    for o, s, n in zip(owner[first].tolist(), total, np.diff(np.r_[first, len(owner)])):
        yield o, np.append(s, n)


class Members:
    """All members, resident in the partitions of their owners."""

    def __init__(self, rdd: RDD, n: int, books: np.ndarray):
        self.rdd, self.n, self.books, self.held = rdd, n, books, None
        self.round = 0

    @classmethod
    def start(cls, kept: DataFrame, books: np.ndarray, n: int, scale: int) -> Members:
        """Members of all rows of ``kept`` (row, embedding), each sent to the owner of its nearest first entry."""
        parts, entries, width = books.shape
        sent = kept.sparkSession.sparkContext.broadcast(books)

        schema = pa.schema([("p", pa.int32()), ("o", pa.binary()), ("r", pa.binary()), ("v", pa.binary())])

        def run(batches):
            for b in batches:
                for i in range(0, b.num_rows, 4096):
                    s = b.slice(i, 4096)
                    row = s.column(0).to_numpy()
                    x = whole_parts(s.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(row), -1), parts, scale)
                    blocks = (np.repeat(np.arange(parts, dtype=np.int64) * entries, len(row)), np.tile(row, parts),
                              x.transpose(1, 0, 2).reshape(-1, width).astype(np.int32))
                    new, _ = _assigned(blocks, sent.value)
                    for p, (o, r, v) in _dealt((new, blocks[1], blocks[2]), n):
                        yield batch(schema, ([p], [o.tobytes()], [r.tobytes()], [v.tobytes()]))

        def unpacked(it):
            for p, o, r, v in it:
                yield p, (np.frombuffer(o, np.int64), np.frombuffer(r, np.int64), np.frombuffer(v, np.int32).reshape(-1, width))

        blocks = kept.select("row", "embedding").mapInArrow(run, "p int, o binary, r binary, v binary").rdd.mapPartitions(unpacked)
        return cls(blocks.partitionBy(n, _same), n, books)

    def update(self) -> None:
        """The next codebooks: rounded-down means of the residents; entries without members stay."""
        entries = self.books.shape[1]

        def local(it):
            block = _merged(b for _, b in it)
            if block is not None:
                yield from _sums(block)

        total = self.rdd.mapPartitions(local).reduceByKey(lambda a, b: a + b, min(self.n, 64)).collect()      # parts * entries rows at most
        books = self.books.copy()
        for o, s in total:
            books[o // entries, o % entries] = s[:-1] // s[-1]
        self.books = books

    def assign(self) -> None:
        """Assign all residents anew; only those whose entry changes move, in one shuffle."""
        sent, n = self.rdd.context.broadcast(self.books), self.n

        def run(it):
            block = _merged(b for _, b in it)
            if block is None:
                return
            new, _ = _assigned(block, sent.value)
            stays = new == block[0]
            moved = (new[~stays], block[1][~stays], block[2][~stays])
            yield True, (None, tuple(c[stays] for c in block))
            for p, b in _dealt(moved, n):
                yield False, (p, b)

        tagged = self.rdd.mapPartitions(run, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        self.round += 1
        if self.round % CUT == 0:
            tagged.checkpoint()
        stayed = tagged.filter(itemgetter(0)).mapPartitions(_second, preservesPartitioning=True)
        arrived = tagged.filter(_moves).mapPartitions(_second).partitionBy(n, _same)
        before, self.held = self.held, tagged
        self.rdd = stayed.union(arrived.mapPartitions(_as_is, preservesPartitioning=True))
        if before is not None:
            tagged.count()                       # held now: the round before can go
            before.unpersist()

    def codes(self, spark) -> DataFrame:
        """row, pos, code, error of every member after a last assignment, which nobody needs to move for."""
        sent = self.rdd.context.broadcast(self.books)

        def run(it):
            block = _merged(b for _, b in it)
            if block is not None:
                new, error = _assigned(block, sent.value)
                yield new.tobytes(), block[1].tobytes(), error.tobytes()

        entries = self.books.shape[1]
        schema = pa.schema([("row", pa.int64()), ("pos", pa.int32()), ("code", pa.int64()), ("error", pa.int64())])

        def unpacked(batches):
            for b in batches:
                for o, r, e in zip(*(b.column(i).to_pylist() for i in range(3))):
                    o, r, e = (np.frombuffer(x, np.int64) for x in (o, r, e))
                    for i in range(0, len(o), 65_536):
                        at = slice(i, i + 65_536)
                        yield batch(schema, (r[at], (o[at] // entries).astype(np.int32), o[at] % entries, e[at]))

        packed = spark.createDataFrame(self.rdd.mapPartitions(run), "o binary, r binary, e binary", verifySchema=False)
        return packed.mapInArrow(unpacked, "row bigint, pos int, code bigint, error bigint")


def _second(it):
    return (x for _, x in it)


def _moves(x) -> bool:
    return not x[0]


def _as_is(it):
    return it


def usable(rows: DataFrame, parts: int) -> DataFrame:
    """vec_id, label, embedding of rows whose vector can be coded; all of one length."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(LARGEST)))
    ok = (F.size("embedding") > 0) & (F.size("embedding") % parts == 0) & F.coalesce(fine, F.lit(False))
    some = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding").filter(ok)
    first = some.select("vec_id", "embedding", F.size("embedding").alias("n")).orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(1).collect()
    return some.filter(F.size("embedding") == (first[0].n if first else 0))


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             task_members: int = TASK_MEMBERS) -> tuple[DataFrame, np.ndarray]:
    """(coded rows, codebooks). Coded rows: vec_id, label, codes (array<bigint>, one a part), error. Codebooks: parts x entries x
    width whole numbers."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    kept = written(usable(rows, parts).withColumn("row", F.monotonically_increasing_id()), "vectors")
    first = kept.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    if not first:
        return kept.select("vec_id", "label", F.array().cast("array<bigint>").alias("codes"), F.lit(0).cast("bigint").alias("error")), np.zeros((parts, 0, 0), np.int64)
    books = np.ascontiguousarray(whole_parts(np.array([r.embedding for r in first], np.float64), parts, scale).transpose(1, 0, 2))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(parts * kept.count() / task_members))
    members = Members.start(kept, books, n, scale)
    for r in range(rounds):
        if r:                                    # the first assignment is the members' way to their owners
            members.assign()
        members.update()
    found = members.codes(spark).groupBy("row").agg(
        F.sum("error").alias("error"), *(F.max(F.when(F.col("pos") == p, F.col("code"))).alias(f"c{p}") for p in range(parts)))
    narrow = kept.select("row", "vec_id", "label")
    coded = written(narrow.join(found, "row").select("vec_id", "label", F.array(*(f"c{p}" for p in range(parts))).alias("codes"), "error"), "codes")
    if members.held is not None:
        members.held.unpersist()
    return coded, members.books


def digest(books: np.ndarray) -> str:
    """sha256 of all components, comma-joined, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op13_codes(rows: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that can be coded."""
    coded, books = compress(rows)
    code = F.concat(*(F.lower(F.lpad(F.hex(F.get("codes", F.lit(p))), 2, "0")) for p in range(PARTS)))
    per = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "same")
    return (coded.join(per, F.col("label").eqNullSafe(F.col("same")))
            .select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    ctes = [f"""k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x : floor({SCALE} * CAST(x AS DOUBLE))) AS v
      FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""m AS MATERIALIZED (SELECT rid, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM k, range({parts}) r(p))""",
            f"""b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
      FROM m JOIN (SELECT rid, vec_id FROM k ORDER BY vec_id LIMIT {entries}) USING (rid))"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT rid, p, any_value(x) AS x, arg_min(e, (list_inner_product(c, c) - 2 * list_inner_product(x, c)) * {entries} + e) AS e
      FROM m JOIN b{r} USING (p) GROUP BY rid, p)""")
        if r < rounds:
            ctes.append(f"""u{r} AS (SELECT p, e, j, floor(sum(y) / count(*)) AS y FROM (SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS j FROM a{r}) GROUP BY ALL)""")
            ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(n, c) AS c FROM b{r} LEFT JOIN (SELECT p, e, list(y ORDER BY j) AS n FROM u{r} GROUP BY ALL) USING (p, e))""")
    last = f"""f AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
      CAST(sum(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)) AS BIGINT) AS error FROM a{rounds} JOIN b{rounds} USING (p, e) GROUP BY rid),
    h AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256
      FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS j FROM b{rounds}))"""
    return "WITH " + ",\n".join([*ctes, last]) + """
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN f USING (rid), h"""


#: Four unrolled rounds; sums and products of whole numbers below 2^53 are exact in doubles.
ORACLE_SQL = _oracle()
