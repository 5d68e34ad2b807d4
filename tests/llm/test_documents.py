"""Operators on documents against brute force: planted odd rows, an empty table, clashing columns, the small test tables."""

import os
import re
from functools import partial

import brute
import numpy as np
import pytest
from conftest import DOC, LONG, ODD, clashing

from tokscope.llm import langid, licenses, lm, mixing, packing, quality, simhash


def rows(df):
    return [tuple(r) for r in df.collect()]


def sort(x):
    return sorted(x, key=str)


def test_simhash_equals_brute_force(odd, documents):
    for docs in (odd, documents):
        src = rows(docs.select("doc_id", "text"))
        fps = [(d, brute.fingerprint(t)) for d, t in src]
        want = [(d, f"{f:016x}", c) for (d, f), c in zip(fps, brute.linked(fps))]
        assert sort(rows(simhash.op7_simhash(clashing(docs)))) == sort(want)


def test_simhash_shards_find_every_link(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 1500, dtype=np.uint64)
    near = base[:600] ^ (np.uint64(1) << rng.integers(0, 64, 600, dtype=np.uint64))
    nearer = near[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    tight = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    p = np.unique(np.concatenate([base, near, nearer, tight]))
    df = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp bigint")
    dealt = simhash.shards(df, 2, max_shard=150).groupBy("shard").count().collect()
    assert len(dealt) > 8
    edges = simhash.links(df, 2, max_shard=150)
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    got = [root.get(int(x), int(x)) for x in p.view(np.int64)]
    want = brute.linked([(i, int(x)) for i, x in enumerate(p)])
    assert len({*zip(got, want)}) == len(set(got)) == len(set(want))


def test_a_shard_that_cannot_be_split(spark):
    """A family within a few bits of one fingerprint: no vantage point shrinks it, so pairs of its parts are compared apart."""
    rng = np.random.default_rng(1)
    p = np.full(900, 2 ** 40 + 12345, np.uint64)
    for _ in range(4):
        p ^= np.uint64(1) << rng.integers(0, 40, 900).astype(np.uint64)
    p = np.unique(p)
    df = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp bigint")
    sizes = {r["shard"]: r["count"] for r in simhash.shards(df, 2, max_shard=60).groupBy("shard").count().collect()}
    assert any("!-" in s for s in sizes) and max(sizes.values()) < 4 * 60
    root = {r.node: r.root for r in simhash.components(simhash.links(df, 2, max_shard=60)).collect()}
    got = [root.get(int(x), int(x)) for x in p.view(np.int64)]
    want = brute.linked([(i, int(x)) for i, x in enumerate(p)])
    assert len({*zip(got, want)}) == len(set(got)) == len(set(want))


def test_forest_needs_no_sample_of_pairs():
    p = np.arange(3000, dtype=np.uint64)                # a chain: all reachable, hundreds of thousands of pairs
    e = simhash.leaf_links(p, 1)[0]
    assert len(e) == 2999 and (e[:, 1] == 0).all()


def test_keep_one(odd):
    kept = rows(simhash.keep_one(clashing(odd)))
    fps = [(r[0], brute.fingerprint(r[1])) for r in ODD]
    assert len(kept) == len({f if c is None else c for (_, f), c in zip(fps, brute.linked(fps))})
    assert len([r for r in kept if r[1] == ODD[5][1]]) == 1 and 4 in {r[0] for r in kept}


def test_base_scores_equal_brute_force(odd, documents, monkeypatch):
    monkeypatch.setattr(lm.att, "train", partial(lm.att.train, steps=30))       # the base does not depend on the model
    for docs in (odd, documents):
        src = rows(docs.select("doc_id", "text"))
        want = {}
        for (d, t), b in zip(src, brute.base_scores(src)):
            want.setdefault((d, b[0]), []).append(b)
        got = rows(lm.op2_lm(clashing(docs)))
        assert len(got) == len(src)
        for d, held, n, known, total, base, score in got:
            b = want[(d, n)][0]
            assert held == (brute.crc(d, 7) == 2) and (n, known, total) == b[:3]
            assert base == pytest.approx(b[3], rel=1e-9) and score < 0 and np.isfinite(score)


def test_lm_beats_the_base_on_held_out_texts(spark):
    larger = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(larger):
        pytest.skip("no test data")
    r = [x for x in lm.op2_lm(spark.read.parquet(larger)).collect() if x.held_out]
    assert sum(x.score for x in r) > sum(x.base_score for x in r)


def test_langid(odd, documents):
    src = {r.doc_id: r for r in documents.collect()}
    got = langid.op1_langid(clashing(documents)).collect()
    assert all(r.held_out == (brute.crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == src[r.doc_id].lang for r in held]) > 0.95
    got = rows(langid.op1_langid(odd).select("doc_id", "lang_pred", "score"))
    assert len(got) == len(ODD)
    for (d, p, s), text in ((g, t) for g in got for x, t in [(r[0], r[1]) for r in ODD] if x == g[0] and x is not None):
        assert (p == "und") == (not any(c.isalpha() for c in text or "")), (d, p)


def test_quality(spark, odd, documents):
    from conftest import SF
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    y = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.op9_quality(clashing(documents), labels).collect()
    assert all(r.held_out == (brute.crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == y[r.doc_id] for r in got if r.doc_id in y]) > 0.9
    odd_labels = spark.createDataFrame([(1, None, 0), (4, 1, 0), (4, 0, 0), (5, 0, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert len(rows(quality.op9_quality(odd, odd_labels))) == len(ODD)
    assert {r.score for r in quality.op9_quality(odd, odd_labels.limit(0)).collect()} == {0.5}


def test_isotonic_is_the_least_squares_fit():
    x, y = quality.isotonic(np.arange(6.0), np.array([0, 1, 0, 1, 1, 0.0]), np.ones(6))
    assert (np.diff(y) > 0).all() and y[0] == 0 and y[-1] == pytest.approx(2 / 3)


def test_normal_equations_are_sums_over_all_partitions(spark):
    rng = np.random.default_rng(0)
    s, y = rng.normal(size=(50, quality.N_STATS)).astype(np.float32), rng.integers(0, 2, 50)
    m = quality.Model(np.zeros(quality.N_STATS), np.ones(quality.N_STATS), rng.normal(size=(quality.N_STATS, 7)), rng.normal(size=7),
                      np.zeros(8), np.zeros(1), np.zeros(1))
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(s, y)], "stats array<float>, y double").repartition(5)
    a, b = quality.normal_equations(df, m)
    z = m.features(s.astype(np.float64))
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ y)


def test_base_phrases_equal_brute_force(odd, documents):
    for docs in (odd, documents):
        src = {r.doc_id: r.text for r in docs.collect()}
        for r in licenses.op8_licenses(clashing(docs)).collect():
            if r.doc_id is not None:
                assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.phrase_places(src[r.doc_id]), r
            assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
            assert 0 <= r.score <= 1


def test_templates_survive_edits(spark):
    text = licenses.TEMPLATES[0][1].split()
    cut = text[:20] + ["really", "new"] + text[20:40] + text[42:]
    d = spark.createDataFrame([(1, "x " * 300 + " ".join(cut)), (2, " ".join(text[:9])), (3, " ".join(reversed(text)))], "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, r.n_base) for r in licenses.op8_licenses(d).collect()}
    assert got == {1: ("mit", 0), 2: ("", 0), 3: ("", 0)}


def test_licenses_stay_native(documents):
    for df in (licenses.op8_licenses(documents), mixing.sample(documents)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def whole_tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_path())


def test_packing_round_trip(odd, documents, whole_tokenizer):
    import zlib
    for docs in (odd, documents):
        src = docs.select("doc_id", "text").collect()
        ids = {r.doc_id: whole_tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in src}
        got = packing.op5_packing(clashing(docs)).collect()
        seqs, starts, copies = {}, {}, {}
        for r in src:
            copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        for p in got:
            if copies[p.doc_id] == 1:
                part = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4")
                assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
                starts.setdefault(p.doc_id, []).append((p.start, p.length))
            seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
        for d, s in starts.items():
            at = 0
            for b, n in sorted(s):
                assert b == at
                at += n
            assert at == len(ids[d])
        assert set(starts) == {d for d, n in copies.items() if n == 1}
        for s in seqs.values():
            at = 0
            for o, n in sorted(s):
                assert o == at
                at += n
            assert at <= 2048 and (at & (at - 1)) == 0 and len(s) <= packing.Limits().segments     # no padding


def test_vector_packing_keeps_every_limit(spark):
    rng = np.random.default_rng(2)
    ex = [(i, int(rng.integers(1, 900)), int(rng.integers(0, 300))) for i in range(500)] + [(500, 5000, 1), (501, None, None)]
    lim = packing.Limits(1024, 4, 400)
    got = packing.pack_examples(spark.createDataFrame(ex, "example_id bigint, tokens bigint, loss_tokens bigint").coalesce(1), lim).collect()
    assert sorted(r.example_id for r in got) == list(range(502))
    loss = {i: g or 0 for i, _, g in ex}
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        if [r.example_id for r in s] != [500]:
            assert sum(r.length for r in s) <= 1024 and len(s) <= 4 and sum(loss[r.example_id] for r in s) <= 400
    assert len(seqs) < 1.25 * max(sum(t or 0 for _, t, _ in ex[:500]) / 1024, 500 / 4, sum(loss.values()) / 400) + 2


def test_raking_meets_every_target_and_the_budget(documents):
    cells = mixing.mixed(mixing.described(documents), {"lang": {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}}).toPandas()
    got = cells.groupby("lang_key").weight.sum() / cells.weight.sum()
    assert got["=en"] == pytest.approx(0.4, abs=0.02) and got["=es"] == pytest.approx(0.1, abs=0.02)
    assert (cells.tokens * cells.prob).sum() == pytest.approx(0.5 * cells.tokens.sum(), rel=1e-6)
    assert cells.prob.between(0, 1).all()


def test_sample_agrees_with_the_query(documents, odd):
    for docs in (documents, odd):
        kept = sort(r[0] for r in rows(mixing.sample(clashing(docs))))
        assert kept == sort(r.doc_id for r in mixing.op3_mixing(docs).collect() if r.sampled)


@pytest.mark.parametrize("run", [simhash.op7_simhash, simhash.keep_one, lm.op2_lm, langid.op1_langid, langid.keep_identified, licenses.op8_licenses,
                                 packing.op5_packing, mixing.op3_mixing, mixing.sample], ids=lambda f: f.__name__)
def test_empty_tables(none, run):
    assert run(none).collect() == []


def test_word_ids_equal_the_whole_tokenizer(whole_tokenizer):
    from tokscope.llm.subwords import WordIds
    w = WordIds(packing.tokenizer_path())
    for t in ["don't DO'S x2 ²½ ÀÉß µm y\x85z áb ΣΑΣ İK 日本 😀😀 <|endoftext|>a <|startoftext|>", "\x1ca\x1fb c d", LONG[:500], "it's 'tis we'LL 10,000.5 --- ..."]:
        assert w.ids(t) == whole_tokenizer.encode(t, add_special_tokens=False).ids, t


def test_word_ids_of_a_column_equal_the_whole_tokenizer(whole_tokenizer, monkeypatch):
    import random

    import pyarrow as pa
    from tokscope.llm import subwords
    signs = ["a", "B", "é", "É", "ß", "'s", "'", "’", "1", "²", ".", ",", "»", "ł", "İ", "K", "Σ", "<|", "|>", "<|ENDOFTEXT|>", "<|endoftext|>", " ", "\t", "\x0b", "\x85",
             "\xa0", "中", "E\u0301", "\x1c", "😀", "\xad", "µ"]
    rnd = random.Random(5)
    xs = ["".join(rnd.choices(signs, k=rnd.randint(0, 14))) for _ in range(3000)] + [None, "", "It's a Long, long text. " * 50]
    want = [whole_tokenizer.encode(x or "", add_special_tokens=False).ids + [1] for x in xs]
    for size in (4_000_000, 40):                # 40: most texts are cut at white space
        monkeypatch.setattr(subwords, "SLICE", size)
        words = subwords.WordIds(packing.tokenizer_path())
        column = pa.chunked_array([pa.array(["x"] + xs[:1000])[1:], pa.array(xs[1000:]), pa.array([], pa.string())])
        assert [a.tolist() for a in words.arrays(column, 1)] == want


def test_attention_scores_are_those_of_one_window_at_a_time():
    from tokscope.llm import attention as att
    rng = np.random.default_rng(3)
    w = {k: v + rng.normal(size=v.shape).astype(np.float32) * 0.3 for k, v in att.initial(rng).items()}
    m = att.Model(np.zeros(1), np.zeros(1), w).ready()
    lengths = np.array([1, 5, 16, 17, 40, 100, 2])
    t = rng.integers(0, att.CLASSES * att.PER_CLASS, lengths.sum())
    x = np.append(att.END, t[:-1])
    got, begin = att.score(m, x, t, lengths, batch=3)
    starts, scored = att.window_plan(lengths)
    assert scored.sum() == lengths.sum()
    for s0, n in zip(np.cumsum(lengths) - lengths, lengths):
        for i in range(n):
            k = 0 if i < att.WINDOW else -(-(i + 1 - att.WINDOW) // att.STRIDE)
            first = s0 if k == 0 else s0 + min(k * att.STRIDE + att.WINDOW, n) - att.WINDOW
            ctx = x[first:s0 + i + 1]
            e = w["E"][ctx].astype(float)
            q, key, v = e[-1] @ w["Q"] / np.sqrt(att.DIM), e @ w["K"], e @ w["V"] @ w["M"]
            a = np.exp(key @ q + w["B"][np.arange(len(ctx))[::-1]])
            h = e[-1] + a @ v / a.sum()
            zc = np.exp(h @ w["C"].T + w["c"])
            c = t[s0 + i] // att.PER_CLASS
            part = slice(c * att.PER_CLASS, (c + 1) * att.PER_CLASS)
            zo = np.exp(h @ w["O"][part].T + w["o"][part])
            want = np.log(zc[c] / zc.sum() * zo[t[s0 + i] % att.PER_CLASS] / zo.sum())
            assert got[s0 + i] == pytest.approx(want, abs=2e-3)
            assert begin[s0 + i] == pytest.approx(np.log(zc[:att.CLASSES // 2].sum() / zc.sum()), abs=2e-3)


def test_attention_gradient_is_the_slope_of_the_loss():
    from tokscope.llm import attention as att
    rng = np.random.default_rng(4)
    w = {k: v.astype(np.float64) for k, v in att.initial(rng).items()}
    rows_ = rng.integers(0, 1024, (3, att.WINDOW + 1))
    rows_[0, 9:] = -1
    x, y = np.maximum(rows_[:, :-1], 0), rows_[:, 1:]

    def loss():
        m = att.Model(np.zeros(1), np.zeros(1), w).ready()
        out = [att.score(m, x[i], np.maximum(y[i], 0), np.array([att.WINDOW]))[0][y[i] >= 0] for i in range(3)]
        return -np.concatenate(out).mean()

    g = att.gradient(w, x, y)
    for k in w:
        at = np.unravel_index(np.abs(g[k]).argmax(), w[k].shape)
        w[k][at] += 1e-2
        up = loss()
        w[k][at] -= 2e-2
        down = loss()
        w[k][at] += 1e-2
        assert (up - down) / 2e-2 == pytest.approx(g[k][at], rel=0.05, abs=1e-4), k


def test_a_long_word_costs_the_sum_of_its_positions():
    from tokscope.llm import attention as att
    sub = lm.Subwords(lm.tokenizer_path())
    rng = np.random.default_rng(6)
    text = "".join(chr(c) for c in rng.integers(97, 123, 10_000))
    ids, _ = sub.of([text.encode()])
    w = {k: v + rng.normal(size=v.shape).astype(np.float32) * 0.3 for k, v in att.initial(rng).items()}
    slot, escape = att.vocabulary(np.bincount(ids[:len(ids) // 2], minlength=len(sub.begins)), sub.begins)
    m = att.Model(slot, escape, w).ready()
    row = {"words": lm._packed(text.encode()), "places": lm._packed(np.zeros(1, np.uint32).tobytes()), "lengths": [1]}
    t = np.append(slot[ids], att.END)
    x = np.append(att.END, t[:-1])
    log_p, log_b = att.score(m, x, t, np.array([len(t)]))
    word = log_p[:-1].astype(float).sum() + escape[ids].sum() - log_b[0] + log_b[-1]
    end = log_p[-1].astype(float) - log_b[-1]
    assert word < -10_000
    for total, mix in ((0, 1.0), (7, lm.MIX)):
        _, _, _, score = lm.block_scores(m, sub, row, np.zeros(1, np.int64), total, 3, 0)[:, 0]
        assert score == pytest.approx((word + end + 2 * np.log(mix)) / np.log(10), rel=1e-6)


def test_attention_learns_from_documents_outside_the_start_sample(spark, monkeypatch):
    monkeypatch.setattr(lm, "SAMPLE_DOCS", 0)           # the start sees no document: all that is known comes from the whole table
    docs = spark.createDataFrame([(i, "uno dos tres cuatro cinco seis siete ocho nueve diez " * 40) for i in range(400)], "doc_id bigint, text string")
    path = lm.tokenizer_path()
    made = lm.written(lm.blocks(docs.repartition(3)), "lm-test-blocks").cache()
    sub = lm.Subwords(path)
    train = [r for r in docs.collect() if brute.crc(r.doc_id, 7) != 2]
    want = np.zeros(len(sub.begins), np.int64)
    for r in train:
        np.add.at(want, sub.of(lm.words_of(r.text))[0], 1)
    assert (lm.subword_counts(made, path, len(want)) == want).all()
    slot = np.arange(len(want) + 1)
    size = sum(sum((p[:, 1:] >= 0).sum() for p in lm.block_windows(slot, sub, b.asDict(), t)) for b in made.collect() for t in range(lm.PASSES))
    assert size == want.sum() + len(train)              # every position once
    m = lm.fit(docs, made, path)
    ids, _ = sub.of(lm.words_of(train[0].text))
    assert (m.slot[ids] != lm.att.BEGIN).all() and (m.slot[ids] != lm.att.GO_ON).all()
    t = np.append(m.slot[ids], lm.att.END)
    known = lm.att.score(m, np.append(lm.att.END, t[:-1]), t, np.array([len(t)]))[0].mean()
    start = lm.att.Model(m.slot, m.escape_log, lm.att.initial(np.random.default_rng(1))).ready()
    assert known > lm.att.score(start, np.append(lm.att.END, t[:-1]), t, np.array([len(t)]))[0].mean() + 1


def test_attention_step_handles_large_exponents_and_keeps_its_arrays():
    from tokscope.llm import attention as att
    rng = np.random.default_rng(7)
    w = {k: v.astype(np.float64) * (40 if k in ("E", "O", "C") else 1) for k, v in att.initial(rng).items()}    # exponents far above what float32 holds
    x, y = rng.integers(0, 2048, (2, 4, att.WINDOW))
    y[2, 5:] = -1
    h = att.Model(np.zeros(1), np.zeros(1), w).ready().w["E"][x].reshape(-1, att.DIM)
    assert np.abs(h @ w["O"].T).max() > 100
    room, want = att.Room(), att.gradient(w, x, y)
    other = att.gradient(w, x[:2], y[:2], room)
    held = dict(room.held)
    got = att.gradient({k: v.astype(np.float32) for k, v in w.items()}, x, y)
    again = att.gradient(w, x, y, room)
    att.gradient(w, x[:2], y[:2], room, other)
    assert held.keys() == room.held.keys()
    for k in w:
        assert np.isfinite(got[k]).all() and np.array_equal(again[k], want[k]), k
    assert np.allclose(got["O"], want["O"], atol=1e-3 * np.abs(want["O"]).max())
    steps = att._adam({k: v.astype(np.float32) for k, v in att.initial(np.random.default_rng(1)).items()}, [(np.hstack([x, y[:, -1:]]), 0.01)])
    first = att.initial(np.random.default_rng(1))
    slope = att.gradient(first, x, np.hstack([x, y[:, -1:]])[:, 1:])
    for k in first:                                     # Adam's first step is the rate, against the slope
        far = np.abs(slope[k]) > 1e-4
        assert np.allclose((steps[k] - first[k])[far], -0.01 * np.sign(slope[k][far]), atol=1e-4), k


def test_lm_blocks_keep_their_subword_ids(spark, odd, monkeypatch):
    path = lm.tokenizer_path()
    sub, made = lm.Subwords(path), [r.asDict() for r in lm.blocks(odd).collect()]
    for row in made:
        ids, size = lm.block_ids(row)
        want = sub.of(lm._unpacked(row["words"]).split(b" ") if row["words"] else [])
        assert ids.tolist() == want[0].tolist() and size.tolist() == want[1].tolist() and len(size) == row["n_words"]
    monkeypatch.setattr(lm.Subwords, "of", None)        # neither windows nor scores encode a word again
    slot = np.arange(len(sub.begins) + 1) % (att_slots := lm.att.CLASSES * lm.att.PER_CLASS)
    model = lm.att.Model(slot, np.zeros(len(slot)), lm.att.initial(np.random.default_rng(1))).ready()
    assert sum(len(p) for row in made for t in range(lm.PASSES) for p in lm.block_windows(slot, None, row, t)) > 0 and att_slots == lm.att.SLOTS
    assert all(lm.block_scores(model, None, row, np.zeros(row["n_words"], np.int64), 1, 1, 1).shape == (4, len(row["lengths"])) for row in made)
