"""Packing by vector bin packing: the dot-product heuristic under limits on tokens, segments and loss-bearing tokens.

A sequence takes, again and again, the open example whose demands (tokens, one segment, loss-bearing tokens, each as a share of
its limit) have the largest dot product with what the sequence has left, among those that fit in every limit.

``pack_examples`` places whole examples (instruction data). ``pack_documents`` also may cut: a long document first gives full
sequences; when nothing open fits, the longest open piece is cut to fill the sequence; a sequence that ends short gives
tokens back until its length is a power of two, so no sequence needs padding. A task packs its rows in blocks of
``BLOCK`` open pieces as it reads them, without a shuffle; sequence ids hold the task's number, so they never clash and a task
that runs again gives the same ids.

Defined cases: null or empty text is the end id alone; repeated rows are packed each on its own; an example over a limit gets a
sequence of its own (``pack_examples``); null demands count as 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokscope.llm.common import batch
from tokscope.llm.subwords import WordIds

END_ID = 1
BLOCK = 4_096


@dataclass(frozen=True)
class Limits:
    tokens: int = 2_048
    segments: int = 128
    loss: int = 2_048


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pack(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, start, length). With ``cut`` an item may be cut anywhere; each piece of n tokens then bears
    n - 1 loss-bearing tokens (its first has nothing before it)."""
    item = np.arange(len(tokens))
    size, gain, begin = tokens.astype(np.int64), loss.astype(np.int64), np.zeros(len(tokens), np.int64)
    alive = np.ones(len(tokens), bool)
    while alive.any():
        if alive.sum() * 2 < len(alive):
            item, size, gain, begin, alive = item[alive], size[alive], gain[alive], begin[alive], alive[alive]
        t, s, g = limits.tokens, limits.segments, limits.loss
        placed: list[list[int]] = []        # [index, start, length]
        while t > 0 and s > 0:
            fits = alive & (size <= t) & (gain <= g)
            dot = np.where(fits, size * (t / limits.tokens ** 2) + s / limits.segments ** 2 + gain * (g / limits.loss ** 2), -1.0)
            i = int(dot.argmax())
            if dot[i] < 0:
                if not cut and not placed:      # over a limit: on its own
                    i = int(alive.argmax())
                    alive[i] = False
                    placed.append([i, int(begin[i]), int(size[i])])
                if not cut or not alive.any():
                    break
                i = int(np.where(alive, size, -1).argmax())
                n = min(t, g + 1, int(size[i]))
                if n <= 0:
                    break
                placed.append([i, int(begin[i]), n])
                begin[i] += n
                size[i] -= n
                gain[i] = max(0, size[i] - 1)
                alive[i] = size[i] > 0
                t, s, g = t - n, s - 1, g - max(0, n - 1)
                continue
            placed.append([i, int(begin[i]), int(size[i])])
            alive[i] = False
            t, s, g = t - int(size[i]), s - 1, g - int(gain[i])
        used = sum(p[2] for p in placed)
        over = used - (1 << (used.bit_length() - 1)) if cut and used < limits.tokens else 0
        while over:                             # give back what is beyond a power of two
            i, b, n = placed[-1]
            k = min(over, n)
            begin[i], size[i] = b + n - k, size[i] + k if alive[i] else k
            gain[i], alive[i] = max(0, size[i] - 1), True
            placed[-1][2] -= k
            over -= k
            if not placed[-1][2]:
                placed.pop()
        yield [(int(item[i]), b, n) for i, b, n in placed]


def pack_examples(rows: DataFrame, limits: Limits = Limits(), tokens: str = "tokens", loss: str = "loss_tokens",
                  key: str = "example_id") -> DataFrame:
    """key, sequence_id, offset, length for whole examples with demands in columns ``tokens`` and ``loss``."""
    schema = pa.schema([(key, pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches):
        seq = TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                ids, t, g = (part.column(i).to_pylist() for i in range(3))
                out = []
                for placed in pack(np.array(t, np.int64), np.array(g, np.int64), limits, cut=False):
                    o = 0
                    for i, _, n in placed:
                        out.append((ids[i], seq, o, n))
                        o += n
                    seq += 1
                yield batch(schema, zip(*out) if out else [[]] * 4)

    cols = [F.col(key).cast("bigint"), *(F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")) for c in (tokens, loss))]
    return rows.select(*cols).mapInArrow(run, f"`{key}` bigint, sequence_id bigint, offset bigint, length bigint")


def pack_documents(docs: DataFrame, limits: Limits = Limits(), path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = path or tokenizer_path()
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def run(batches):
        words = WordIds(path)
        seq = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        wait: list[tuple] = []                  # doc_id, doc_tokens, start, ids

        def piece(doc_id, total, start, ids, offset):
            out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, seq, offset))

        def settle_block():
            nonlocal seq
            size = np.array([len(w[3]) for w in wait], np.int64)
            for placed in pack(size, np.maximum(size - 1, 0), limits, cut=True):
                offset = 0
                for i, b, n in placed:
                    doc_id, total, start, ids = wait[i]
                    piece(doc_id, total, start + b, ids[b:b + n], offset)
                    offset += n
                seq += 1
            wait.clear()

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), words.arrays(b.column(1), END_ID)):
                full = len(ids) - len(ids) % limits.tokens if limits.loss >= limits.tokens - 1 else 0
                for at in range(0, full, limits.tokens):
                    piece(doc_id, len(ids), at, ids[at:at + limits.tokens], 0)
                    seq += 1
                if full < len(ids):
                    wait.append((doc_id, len(ids), full, ids[full:].copy()))
                if len(wait) >= BLOCK:
                    settle_block()
                if len(out) >= 10_000:
                    yield batch(schema, zip(*out))
                    out.clear()
        settle_block()
        yield batch(schema, zip(*out) if out else [[]] * 7)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ", ".join(f"{f.name} bigint" for f in schema))


def op5_packing(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
