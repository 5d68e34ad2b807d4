"""Vector searches and chat collapse against brute force; the pipeline; the registered queries."""

import numpy as np
import pytest
from conftest import SF, clashing

from tokscope.llm import chat_snapshots, collisions, segments
from tokscope.llm.vectors import search, valid
from pyspark.sql import functions as F

VEC = "vec_id bigint, embedding array<float>, label int"


def vectors(spark, n=600, d=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.uniform(0.5, 2, (n, 1))
    x[100:140] = x[100] + rng.normal(size=(40, d)) * 0.01
    x[200:230] = x[200]                                 # ties
    r = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    r += [(9000, None, 0), (9100, [], 0), (9200, [0.0] * d, 0), (9300, [nan] + [1.0] * (d - 1), 0), (9400, [inf] + [1.0] * (d - 1), 0),
          (9500, [None] + [1.0] * (d - 1), 0), (None, [1.0] * d, 0), (9600, [1.0, 2.0], 0), (9650, [3.0, 1.0], 0), (0, r[0][1], 0)]
    return spark.createDataFrame(r, VEC).repartition(3), {i: np.array(v, np.float64) for i, v, _ in r[:n]}


def nearest(x, q, k, score):
    s = [(-score(x[q], v), i) for i, v in [*x.items(), (0, x[0])] if i != q]         # the table holds row 0 twice
    return [(i, -a) for a, i in sorted(s)[:k]]


def test_topk_equals_brute_force(spark):
    df, x = vectors(spark)
    score = lambda a, b: int(np.floor(256 * a).astype(np.int64) @ np.floor(256 * b).astype(np.int64))
    x[9200] = np.zeros(24)
    for shard in (8192, 90):
        got = search(valid(df), F.col("vec_id") % 50 == 0, 5, segments.kernel(5), "bigint", shard=shard).collect()
        by = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            by.setdefault(r.query_id, []).append((r.vec_id, r.score))
        for q in [i for i in x if i % 50 == 0]:
            assert by[q] == nearest(x, q, 5, score), q
        assert by[9600] == [(9650, 3 * 256 * 256 + 2 * 256 * 256)] and set(by) == {i for i in x if i % 50 == 0} | {9600, 9650}


def test_topk_of_repeated_ids_equals_its_sql(spark, tmp_path):
    """Rows that share an id are candidates each; of a repeated query id the largest vector asks."""
    import duckdb
    rng = np.random.default_rng(3)
    rows = [(int(i), v.astype(np.float32).tolist(), 0) for i, v in zip(rng.integers(0, 120, 400), rng.normal(size=(400, 8)))]
    rows += [(7, rows[0][1], 1), (7, rows[0][1], 2), (50, [2.0] * 8, 0), (50, [1.0] * 8, 0)]
    df = spark.createDataFrame(rows, VEC)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(segments.ORACLE_SQL).fetchall()
    got = [tuple(r) for r in segments.op10_topk(df).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == sorted(want) and len(got) == 15
    ann = {}
    for r in collisions.op4_ann(df).collect():
        ann.setdefault(r.query_id, []).append(r.vec_id)
    assert all(len(v) == 20 and q not in v for q, v in ann.items()) and any(len(set(v)) < 20 for v in ann.values())


def test_topk_of_huge_numbers(spark):
    df = spark.createDataFrame([(0, [1e18, 1.0]), (1, [1e18, 2.0]), (2, [3e38, 1.0])], "vec_id bigint, embedding array<float>")
    assert [r.vec_id for r in segments.op10_topk(df).orderBy("rank").collect()] == [1, 2]


def test_ann_recall(spark):
    df, x = vectors(spark, n=1500)
    hit = total = 0
    got = {}
    for r in collisions.op4_ann(clashing_vectors(df)).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r)
    for q in [i for i in x if i % 20 == 0]:
        want = nearest(x, q, 20, lambda a, b: a @ b)
        assert [r["rank"] for r in got[q]] == list(range(1, 21))
        assert all(abs(r.score - x[q] @ x[r.vec_id]) < 1e-9 for r in got[q])
        hit += len({i for i, _ in want} & {r.vec_id for r in got[q]})
        total += 20
    assert hit / total > 0.95
    assert 9200 not in got and 9600 not in got


def clashing_vectors(df):
    return df.filter("vec_id <> 9650 OR vec_id IS NULL").select("*", *(F.lit(1).alias(c) for c in ("dim", "shard", "block", "score", "query_id", "rank")))


def test_ann_recall_on_the_test_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = {r.vec_id: np.array(r.embedding, np.float64) for r in rows.collect()}
    ids, m = np.array(list(x)), np.stack(list(x.values()))
    hit = total = 0
    got = {}
    for r in collisions.op4_ann(rows).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q in ids[ids % 20 == 0]:
        s = m @ x[q]
        s[ids == q] = -np.inf
        want = set(ids[np.argsort(-s)[:20]])
        hit, total = hit + len(want & got[q]), total + 20
    assert hit / total >= 0.9


def test_empty_vectors(spark):
    df = spark.createDataFrame([], VEC)
    assert collisions.op4_ann(df).collect() == [] and segments.op10_topk(df).collect() == []


TALK = "conv_id bigint, turn bigint, role string, text string"


def collapse(rows):
    convs = {}
    for c, t, r, x in {(c, t, r or "", x or "") for c, t, r, x in rows if c is not None}:
        convs.setdefault(c, []).append((-(1 << 62) if t is None else t, r, x))
    convs = {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in convs.items()}
    kept = {c: v for c, v in convs.items() if not any(w[:len(v)] == v and (len(w) > len(v) or d < c) for d, w in convs.items() if d != c)}
    return {c: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in v) for c, v in kept.items()}


def test_chat_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(60):                                 # snapshots: prefixes of few logs, with gaps in turn numbers
        log = c % 5
        rows += [(c, 3 * t + log, "user" if t % 2 else "assistant", f"{log} {t}") for t in range(rng.integers(1, 9))]
    rows += [(900, t, "user", f"long {t}") for t in range(1500)] + [(901, t, "user", f"long {t}") for t in range(700)]
    rows += [(902, None, None, None), (902, 1, "user", None), (None, 1, "user", "x"), (903, 1, "user", "a"), (903, 1, "user", "a"), (903, 1, "user", "b"),
             (904, -5, "user", "neg"), (905, -5, "user", "neg"), (905, 7, "user", "more")]
    df = spark.createDataFrame(rows, TALK).select("*", F.lit(1).alias("pos"), F.lit(1).alias("chunk"), F.lit(1).alias("n"))
    got = {}
    for r in chat_snapshots.op6_chat(df).orderBy("conv_id", "part").collect():
        assert r.n_turns <= chat_snapshots.PART
        got[r.conv_id] = got.get(r.conv_id, "") + r.text
    assert got == collapse(rows)
    assert chat_snapshots.op6_chat(spark.createDataFrame([], TALK)).collect() == []


def test_queries_match_their_sql(spark):
    import os
    import sys
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import oracle_harness
    from tokscope.llm import catalog
    assert {f"op{i}" for i in range(1, 11)} | {"pipeline"} == {k.split("_")[0] for k in catalog.queries()}
    res = oracle_harness.run(SF, names=list(catalog.oracle_sql()), spark=spark, verbose=False)
    assert len(res) == len(catalog.oracle_sql()) and all(r["hash_ok"] and r["cols_ok"] for r in res.values()), res


def test_pipeline_stages(spark):
    import corpus_pipeline
    from tokscope.llm.common import written
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = clashing(docs)
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = written(stage(spark, docs, SF), "test")
        if name != corpus_pipeline.STAGES[-1][0]:
            after = {r.doc_id for r in docs.select("doc_id").collect()}
            assert after <= before and docs.columns[:5] == cols
            if name in ("quality classifier", "language ID"):
                good = {d for d in before if labels.get(d) == 1}
                assert len(good & after) >= 0.99 * len(good)
    assert {r.doc_id for r in docs.select("doc_id").collect()} == after
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_pipeline_of_an_empty_table(spark, none):
    import corpus_pipeline
    from tokscope.llm.common import written
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test")
    assert docs.count() == 0
