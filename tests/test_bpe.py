import random

import numpy as np
from pyspark.sql import functions as F

from reference_impl import bpe_train_sequential
from tokscope.operators import bpe
from tokscope.operators.encode import encode_word


def _train(spark, words, n, min_frequency=1):
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    return bpe.train(df, vocab_size=10_000, min_frequency=min_frequency, specials=[], max_merges=n, head_size=64)


def test_published_example(spark):
    words = {"low": 5, "lower": 2, "newest": 6, "widest": 3}
    st = bpe.initial_state(spark.createDataFrame(list(words.items()), "word string, freq bigint"))
    counts = {(r["l"], r["r"]): r["cnt"] for r in bpe.pair_counts(st).collect()}
    assert counts[("e", "s")] == 9 and counts[("s", "t")] == 9 and counts[("w", "e")] == 8
    m = _train(spark, words, 2)
    assert m.merge_list == [("e", "s"), ("es", "t")]


def test_batched_equals_sequential(spark):
    rnd = random.Random(11)
    for trial in range(4):
        words = {}
        for _ in range(rnd.randint(5, 25)):
            w = "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 7)))
            words[w] = words.get(w, 0) + rnd.randint(1, 9)
        words["aaa"] = 4
        n = 15
        exp_merges, exp_segs = bpe_train_sequential(words, n)
        m = _train(spark, words, n)
        assert [(a, b) for a, b, _ in exp_merges] == m.merge_list, trial
        got = {r["word"]: list(r["syms"]) for r in m.segmentation.collect()}
        assert got == exp_segs, trial
        ranks = {p: i for i, p in enumerate(m.merge_list)}
        alphabet = set("".join(words))
        for w in words:  # encode-by-rank reproduces the training segmentation
            assert encode_word(w, ranks, alphabet) == exp_segs[w], w


def _waiting(word, head, last=0):
    table = bpe.PairTable([(l, r, c) for (l, r), c in head.items()])
    return {table.pairs[i][:2] for i in bpe.waiting([word, "q q q"], table, last)}


def _waiting_one_by_one(syms, head, last):
    """The rule of the trainer's text for one word, pair by pair."""
    found, pairs = set(), list(zip(syms, syms[1:]))
    for i, p in enumerate(pairs):
        c = head.get(p, 0)
        floor = last if c == last else 0
        after = max(head.get(pairs[i + 1], 0), floor) if i + 1 < len(pairs) else 0
        before = max(head.get(pairs[i - 1], 0), floor) if i else 0
        if not c:
            continue
        if p[0] == p[1]:
            bad = (after >= c and pairs[i + 1] != p) or (before >= c and pairs[i - 1] != p)
        else:
            runs = ["".join(syms[j:i]) for j in range(i)]
            bad = after > c or before > c or (after == c and p[0] > p[1]) or (before == c and not all(p[0] < x for x in runs))
        if bad:
            found.add(p)
    return found


def test_which_pairs_wait():
    head = {("a", "b"): 9, ("b", "c"): 7, ("c", "d"): 7, ("d", "d"): 7}
    assert _waiting("a b c", head) == {("b", "c")}                          # the rarer of two that touch
    assert _waiting("a b x c d", head) == set()                             # these don't touch
    assert _waiting("b c d", head) == {("c", "d")}                          # as frequent: b before c
    assert _waiting("z b c d", head) == {("c", "d")}
    assert _waiting("c d", {("c", "d"): 7}) == set()
    assert _waiting("a c b d", {("c", "b"): 5, ("b", "d"): 5, ("a", "c"): 5}) == {("c", "b"), ("b", "d")}
    assert _waiting("d d d", {("d", "d"): 7}) == set()                      # equal symbols touch themselves
    assert _waiting("c d d", head) == {("d", "d")}                          # ... and ask for rarer neighbours
    assert _waiting("c d e", {("c", "d"): 7}, last=7) == set()              # an unknown neighbour may be as frequent as the last known
    assert _waiting("e d c", {("e", "d"): 7}, last=7) == {("e", "d")}


def test_batches_of_words_follow_the_rule():
    rnd = random.Random(2)
    for _ in range(300):
        words = [[rnd.choice(["a", "b", "c", "ab", "ba", "aa"]) for _ in range(rnd.randint(1, 9))] for _ in range(rnd.randint(1, 12))]
        pairs = sorted({p for w in words for p in zip(w, w[1:])} | {("a", "z")})
        head = {p: rnd.choice([3, 3, 4, 5]) for p in pairs if rnd.random() < 0.7 or p == pairs[0]}
        last, table = rnd.choice([0, 3]), bpe.PairTable([(l, r, c) for (l, r), c in head.items()])
        segs = [" ".join(w) for w in words]
        assert {table.pairs[i][:2] for i in bpe.waiting(segs, table, last)} == set().union(*(_waiting_one_by_one(w, head, last) for w in words))
        one = bpe.PairTable([(*rnd.choice(pairs), 1)])
        got = bpe.merged(segs, one)
        want = {i: " ".join(_merge(w, {one.pairs[0][:2]})) for i, w in enumerate(words)}
        assert got == {i: x for i, x in want.items() if x != segs[i]}


def _merge(syms, pairs):
    out, i = [], 0
    while i < len(syms):
        two = tuple(syms[i:i + 2]) in pairs
        out.append("".join(syms[i:i + 1 + two]))
        i += 1 + two
    return out


def test_order_is_restored():
    assert bpe.in_order([("ab", "c", 5), ("x", "y", 9), ("a", "b", 5), ("b", "a", 5)]) == [("x", "y", 9), ("a", "b", 5), ("ab", "c", 5), ("b", "a", 5)]


def test_unknown_symbols_become_unk():
    assert encode_word("aqb", {("a", "q"): 0}, {"a", "b"}) == ["aq", "b"]
    assert encode_word("zq", {}, {"q"}) == ["[UNK]", "q"]


def test_vocab_layout(spark):
    df = spark.createDataFrame([("abab", 10), ("ba", 3)], "word string, freq bigint")
    m = bpe.train(df, min_frequency=2, max_merges=2)
    v = {r["token"]: r["id"] for r in m.vocab.collect()}
    assert [v[t] for t in ["[UNK]", "[PAD]", "[BOS]", "[EOS]"]] == [0, 1, 2, 3]
    assert v["a"] == 4 and v["b"] == 5 and v["ab"] == 6


def test_encode_documents_brute_force(spark):
    from reference_impl import model_split, pretokenize
    from tokscope.operators.encode import encode_documents
    docs = [(1, "eng", "the cat sat on the mat, the end"), (2, "eng", "that hat... then these"),
            (3, "eng", "zebra quiz")]
    words = {}
    for _, _, t in docs[:2]:
        for p in model_split(" ".join(pretokenize(t))):
            words[p] = words.get(p, 0) + 1
    m = bpe.train(spark.createDataFrame(list(words.items()), "word string, freq bigint"),
                  min_frequency=2, max_merges=6)
    ranks = {p: i for i, p in enumerate(m.merge_list)}
    alphabet = set("".join(words))
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    got = {r["doc_id"]: (r["n_tokens"], r["n_unk"], r["n_words"]) for r in encode_documents(df, m).collect()}
    for did, _, t in docs:
        toks = [x for p in model_split(" ".join(pretokenize(t))) for x in encode_word(p, ranks, alphabet)]
        assert got[did] == (len(toks), toks.count("[UNK]"), len(t.split())), did


def test_bpe_metric_rows_brute_force(spark):
    from pyspark.sql import functions as F
    from reference_impl import model_split, pretokenize
    from tokscope.operators import encode, metrics
    from tokscope.operators.tokenizers import TOKENIZERS
    docs = [(1, "eng", "the cat sat on the mat, the end."), (2, "eng", "that hat... then these zebras"),
            (3, "hin", "नमस्ते दुनिया, नमस्ते।")]
    words = {}
    for _, _, t in docs[:2]:  # Devanagari stays outside the alphabet -> [UNK]
        for p in model_split(" ".join(pretokenize(t))):
            words[p] = words.get(p, 0) + 1
    m = bpe.train(spark.createDataFrame(list(words.items()), "word string, freq bigint"),
                  min_frequency=2, max_merges=8)
    ranks = {p: i for i, p in enumerate(m.merge_list)}
    alphabet = set("".join(words))
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    wc = metrics.word_counts(df, cont_docs=None)
    stats = encode.bpe_word_stats(wc, m, TOKENIZERS["script"].pieces(F.col("word")).cast("bigint"))
    got = {r["lang"]: r for r in metrics.aggregate_word_stats(stats, metrics.doc_level(wc)).collect()}
    for lang in ("eng", "hin"):
        texts = [t for _, l, t in docs if l == lang]
        toks = [x for t in texts for p in model_split(t) for x in encode_word(p, ranks, alphabet)]
        split = sum(1 for t in texts for w in t.split()
                    if sum(len(encode_word(p, ranks, alphabet)) for p in model_split(w)) > 1)
        r = got[lang]
        assert r["n_tokens"] == len(toks)
        assert r["n_unk"] == toks.count("[UNK]")
        assert r["cont_split"] == split
        kept = [len(x.lstrip("▁Ġ#Ċ<>[]")) for x in toks if x != "[UNK]"]
        assert r["len_sum"] == sum(kept)
        assert r["avg_token_len"] == (sum(kept) / len(kept) if kept else 0.0)


def _rounds(words, budget, floor, head_size):
    """The trainer's rounds in plain Python."""
    state, merges, rounds = [(list(w), f) for w, f in words.items()], [], 0
    while True:
        c = {}
        for s, f in state:
            for p in zip(s, s[1:]):
                c[p] = c.get(p, 0) + f
        top = sorted(((l, r, n) for (l, r), n in c.items() if n >= floor), key=lambda x: (-x[2], x[0], x[1]))
        left = budget - sum(1 for m in merges if top and m[2] > top[0][2])
        if not top or left <= 0:
            return bpe.in_order(merges)[:budget], rounds
        head = top[:min(head_size, left)]
        segs = [" ".join(s) for s, _ in state]
        wait = set(bpe.waiting(segs, bpe.PairTable(head), 0 if len(head) == len(top) else head[-1][2]).tolist())
        now = head[:1] + [p for i, p in enumerate(head[1:], 1) if i not in wait]
        merges += now
        new = bpe.merged(segs, bpe.PairTable(now))
        state = [(new.get(i, segs[i]).split(" "), f) for i, (_, f) in enumerate(state)]
        rounds += 1


def test_rounds_equal_one_at_a_time_on_many_corpora():
    """The rule for merging many pairs at once on 400 random corpora with many ties and runs of equal symbols, whole and cut heads."""
    rounds = merges = 0
    for seed in range(400):
        rnd = random.Random(seed)
        words = {}
        letters = "abcde"[:rnd.randint(1, 5)]
        for _ in range(rnd.randint(2, 40)):
            words["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9 + 5 * (seed % 2))))] = rnd.randint(1, 9)
        floor, budget, head = rnd.choice([1, 2, 3]), rnd.choice([3, 10, 10_000]), rnd.choice([1, 3, 8, 1000])
        exp, _ = bpe_train_sequential(words, budget)
        got, n = _rounds(words, budget, floor, head)
        assert got == [(l, r, c) for l, r, c in exp if c >= floor], seed
        rounds += n
        merges += len(got)
    assert rounds < 0.6 * merges


def _corpus(seed, n=60):
    rnd = random.Random(seed)
    return {"".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 10))): rnd.randint(1, 9) for _ in range(n)}


def test_index_and_retired_words(spark):
    """The pair index kept by signed changes equals a recount in every snapshot; words leave the loop and come back at the end."""
    words = _corpus(5)
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    exp, segs = bpe_train_sequential(words, 10_000)
    exp = [(l, r) for l, r, c in exp if c >= 3]
    m = bpe.train(df, min_frequency=3, specials=[], snapshot_every=2)
    assert m.merge_list == exp
    left = [n for _, n in m.scanned]
    assert len(left) > 2 and left == sorted(left, reverse=True) and left[-1] < len(words)
    want = {w: list(w) for w in words}
    for l, r in exp:
        want = {w: _merge(s, {(l, r)}) for w, s in want.items()}
    assert {r["word"]: r["syms"] for r in m.segmentation.collect()} == want


def test_index_equals_a_recount(spark, tmp_path):
    words = _corpus(6)
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    bpe.train(df, min_frequency=2, specials=[], snapshot_every=1, folder=str(tmp_path / "run"), max_rounds=4)
    for n in (1, 2, 3, 4):
        at = f"{tmp_path}/run"
        state = spark.read.parquet(f"{at}/state/round-{n:06d}").select("word", "freq", "seg")
        counts = {(r.l, r.r): r.cnt for r in bpe.pair_counts(state).collect() if r.cnt >= 2}
        assert counts == {(r.l, r.r): r.cnt for r in spark.read.parquet(f"{at}/pairs/round-{n:06d}").collect()}


def test_changes_alone_are_shuffled(spark):
    """The pair index keeps its partitions: adding a round's changes to it has one exchange, that of the changes."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    st = own.createDataFrame([("abc", 3, "a b c", None), ("abd", 2, "a b d", None)], bpe.STATE)
    pairs = bpe.pair_counts(st).persist()
    pairs.count()
    new = pairs.unionByName(bpe.count_changes(bpe.rewrite(st, [("a", "b", 5)]))).groupBy("l", "r").agg(F.sum("cnt").alias("cnt")).where("cnt > 0")
    plan = new._jdf.queryExecution().executedPlan().toString()
    outside = plan.split("InMemoryRelation")[0].count("Exchange")
    assert outside == 0 and {(r.l, r.r): r.cnt for r in new.collect()} == {("ab", "c"): 3, ("ab", "d"): 2}
    pairs.unpersist()


def test_training_is_taken_up_again(spark, tmp_path):
    """A run that stops after round 5 (snapshots every 2, so one round is in the journal alone) ends like one that never stopped."""
    words = _corpus(7)
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    whole = bpe.train(df, min_frequency=2, specials=[])
    at = str(tmp_path / "run")
    part = bpe.train(df, min_frequency=2, specials=[], snapshot_every=2, folder=at, max_rounds=5)
    assert 0 < len(part.merge_list) < len(whole.merge_list) and part.merge_list == whole.merge_list[:len(part.merge_list)]
    again = bpe.train(df, min_frequency=2, specials=[], snapshot_every=2, folder=at)
    assert again.merge_list == whole.merge_list and again.rounds == whole.rounds
    assert sorted(map(str, again.segmentation.collect())) == sorted(map(str, whole.segmentation.collect()))


def test_more_merges_than_the_vocabulary_takes(spark):
    words = _corpus(8)
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    exp, segs = bpe_train_sequential(words, 7)
    m = bpe.train(df, min_frequency=1, specials=[], max_merges=7)
    assert m.merge_list == [(l, r) for l, r, _ in exp]
    assert {r["word"]: list(r["syms"]) for r in m.segmentation.collect()} == segs


def test_queries_train_to_the_frequency_floor(spark, tmp_path):
    from tokscope.plans import training
    words = [a + b for a in "abcdefghijklmABCDEFGHIJKLM" for b in "nopqrstuvwxyzNOPQRSTUVWXYZ"]     # no two pairs chain
    rows = [(i, " ".join(words), "en", "s", 3 * len(words)) for i in range(bpe.MIN_FREQUENCY)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert len(training.trained_model(spark, str(tmp_path)).merge_list) == len(words)


def test_packed_blocks_follow_the_plain_form():
    """Words as arrays of symbol numbers wait, merge and count like words as texts, ties and runs of equal symbols included."""
    import numpy as np
    rnd = random.Random(9)

    def counts(segs, freq):
        c = {}
        for s, f in zip(segs, freq):
            for p in zip(s.split(" "), s.split(" ")[1:]):
                c[p] = c.get(p, 0) + int(f)
        return c

    for _ in range(300):
        segs = [" ".join(rnd.choice(["a", "b", "c", "ab", "ba", "aa"]) for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(1, 12))]
        freq = np.array([rnd.choice([1, 2, 1 << 60]) for _ in segs], np.int64) if rnd.random() < 0.1 and len(segs) == 1 else np.array([rnd.randint(1, 9) for _ in segs], np.int64)
        syms = bpe.Symbols(["c", "b", "a"], [("b", "a", 1), ("a", "b", 1), ("a", "a", 1)])
        ids = np.array([x for s in segs for x in [*(syms.number[t] for t in s.split(" ")), -1]][:-1], np.int32)
        named = lambda code, cnt: {(syms.names[c // bpe.CODE], syms.names[c % bpe.CODE]): n for c, n in zip(code.tolist(), cnt.tolist())}  # noqa: E731, B023
        assert named(*bpe.block_counts(ids, freq)) == counts(segs, freq)
        pairs = sorted({p for s in segs for p in zip(s.split(" "), s.split(" ")[1:])} | {("a", "c")})
        head = [(*p, rnd.choice([3, 3, 4, 5])) for p in pairs if rnd.random() < 0.7 or p == pairs[0]]
        code = np.array([syms.number[l] * bpe.CODE + syms.number[r] for l, r, _ in head], np.int64)
        cnt, last = np.array([c for *_, c in head], np.int64), rnd.choice([0, 3])
        table = bpe.CodeTable(code, cnt, syms.order(), syms.names)
        at, within = table.find(ids)
        got = bpe.waits(at, within, table, last, lambda i: syms.names[ids[i]] if ids[i] >= 0 else None)  # noqa: B023
        assert sorted(got.tolist()) == sorted(bpe.waiting(segs, bpe.PairTable(head), last).tolist())
        one = rnd.randrange(len(head))
        made = np.array([syms.add(head[one][0] + head[one][1])], np.int32)
        new, code, cnt = bpe.block_merged(ids, freq, bpe.CodeTable(code[[one]], cnt[[one]], syms.order(), made=made))
        after = [bpe.merged(segs, bpe.PairTable([head[one]])).get(i, s) for i, s in enumerate(segs)]
        assert " ".join(syms.names[i] if i >= 0 else "|" for i in new.tolist()).split(" | ") == after
        was, now = counts(segs, freq), counts(after, freq)
        assert named(code, cnt) == {p: n for p in was | now if (n := now.get(p, 0) - was.get(p, 0))}


def test_small_trainings_have_few_tasks(spark, tmp_path):
    """A round's tasks follow the words, not the session's shuffle partitions (200 where nobody sets them)."""
    df = spark.createDataFrame(list(_corpus(10).items()), "word string, freq bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        bpe.train(df, min_frequency=2, specials=[], snapshot_every=1, folder=str(tmp_path / "run"), max_rounds=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(list((tmp_path / "run/pairs/round-000001").glob("part-*"))) == 1


def test_pairs_whose_hash_is_taken_are_found():
    rng = np.random.default_rng(7)
    pairs = rng.integers(0, 300, (20_000, 2))
    code = np.unique(pairs[:, 0] * bpe.CODE + pairs[:, 1])[::2]
    table = bpe.CodeTable(rng.permutation(code), np.ones(len(code), np.int64), np.arange(300))
    ids = rng.integers(-1, 300, 200_000).astype(np.int32)
    at, within = table.find(ids)
    there, same = bpe.codes(ids)
    assert len(table.lookup[2]) and (within == same).all()
    assert ((at >= 0) == (same & np.isin(there, code))).all() and (table.code[at[at >= 0]] == there[at >= 0]).all()
    assert not len(table.find(ids[:1])[0])


def test_a_round_sums_its_changes_without_python(spark):
    """Only the rewriting of words is a Python task: every other one costs each round its start."""
    words = spark.createDataFrame([("abab", 7), ("aab", 5), ("ba", 6)], "word string, freq bigint")
    syms = bpe.Symbols("ab")
    blocks = bpe.packed(bpe.initial_state(words).coalesce(1), syms)
    made = np.array([syms.add("ab")], np.int32)
    new = bpe.rewritten(blocks, bpe.CodeTable(np.array([1], np.int64), np.array([19], np.int64), np.arange(2), made=made))
    path = bpe.scratch_path(spark, "blocks")
    new.write.parquet(path)
    changes = bpe.block_pairs(spark.read.parquet(path))
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "Python" not in plan
    got = {(r.code // bpe.CODE, r.code % bpe.CODE): r.cnt for r in changes.collect()}
    assert got == {(0, 1): -19, (1, 0): -7, (2, 2): 7, (0, 0): -5, (0, 2): 5}


def test_the_last_rounds_equal_one_at_a_time(spark):
    """Once the vocabulary is full, one task makes the rounds that are left for the words that can still matter, in few more jobs."""
    for seed, budget in ((8, 7), (12, 25), (13, 40)):
        words = _corpus(seed)
        df = spark.createDataFrame(list(words.items()), "word string, freq bigint").repartition(3)
        exp, segs = bpe_train_sequential(words, budget)
        jobs = []
        for last in (0, 1 << 21):
            spark.sparkContext.setJobGroup(f"last {seed} {last}", "")
            m = bpe.train(df, min_frequency=1, specials=[], max_merges=budget, last_symbols=last)
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"last {seed} {last}")))
            assert [(r.left, r.right, r.cnt) for r in m.merges.orderBy("rank").collect()] == exp
            assert {r["word"]: list(r["syms"]) for r in m.segmentation.collect()} == segs
        spark.sparkContext.setJobGroup("", "")
        assert jobs[1] <= jobs[0], jobs
    assert jobs[1] < jobs[0], jobs


def test_words_without_a_pair_are_left_out():
    ids = np.array([0, 1, -1, 2, -1, 1, 0, 1], np.int32)
    assert bpe.holding(ids, np.array([0, -1, -1, -1, -1, -1, -1])).tolist() == [True, False, False]
    for keep, want in (([1, 0, 1], [0, 1, -1, 1, 0, 1]), ([1, 1, 0], [0, 1, -1, 2]), ([0, 1, 0], [2]), ([0, 0, 0], []), ([1, 1, 1], ids.tolist())):
        assert bpe.of_words(ids, np.array(keep, bool)).tolist() == want


def test_own_rounds_equal_one_at_a_time(spark, tmp_path):
    """Where few words hold all pairs down to some count, one task makes the rounds down to it: the same merges in fewer jobs, in the journal too."""
    words = {w.translate({97 + i: 97 + 6 * k + i for i in range(6)}): f * (2 if k else 50) + k for k in range(4) for w, f in _corpus(21 + 100 * k, 12).items()}
    words |= {"aaaa": 90, "aaaaa": 31}
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint").repartition(3)
    exp, _ = bpe_train_sequential(words, 10_000)
    want = {w: list(w) for w in words}
    for l, r in (kept := [(l, r) for l, r, c in exp if c >= 9]):
        want = {w: _merge(s, {(l, r)}) for w, s in want.items()}
    jobs, calls, real = [], [], bpe.own_rounds
    for many in (1 << 30, 1):
        bpe.own_rounds = lambda *a: calls.append(many) or real(*a)  # noqa: B023
        spark.sparkContext.setJobGroup(f"own {many}", "")
        try:
            m = bpe.train(df, min_frequency=9, specials=[], many=many, folder=str(tmp_path / f"run-{many}"))
        finally:
            bpe.own_rounds = real
            spark.sparkContext.setJobGroup("", "")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"own {many}")))
        assert m.merge_list == kept
        assert {r["word"]: list(r["syms"]) for r in m.segmentation.collect()} == want
    assert calls and set(calls) == {1} and jobs[1] < jobs[0], (calls, jobs)
    again = bpe.train(df, min_frequency=9, specials=[], many=1, folder=str(tmp_path / "run-1"))
    assert again.merge_list == kept and {r["word"]: list(r["syms"]) for r in again.segmentation.collect()} == want


def test_rounds_in_turn_equal_one_after_the_other(spark):
    """Several rounds' merges in one job give the symbols and the changes of as many jobs, words that no round changes included."""
    rnd = random.Random(3)
    words = spark.createDataFrame([(w, f) for w, f in _corpus(23).items()] + [("z", 3)], "word string, freq bigint")
    syms = bpe.Symbols("abcdefz")
    blocks = bpe.packed(bpe.initial_state(words).coalesce(2), syms).persist()
    turns, left = [], ["a", "b", "c"]
    for _ in range(3):
        l, r = (rnd.choice(left) for _ in range(2))
        left.append(l + r)
        number = syms.add(l + r)
        turns.append((syms.number[l] * bpe.CODE + syms.number[r], number))
    place = syms.order()
    turns = [bpe.CodeTable(np.array([c], np.int64), np.array([9], np.int64), place, made=np.array([n], np.int32)) for c, n in turns]
    head = bpe.CodeTable(np.array([a * bpe.CODE + b for a in range(3) for b in range(3)], np.int64), np.full(9, 9, np.int64), place)
    state = lambda df: sorted((r.word, r.freq, r.seg) for r in bpe.plain(df, syms, None).collect())
    index = lambda dfs: {k: n for k, n in _added(r for df in dfs for r in bpe.block_pairs(df).collect()).items() if n}
    one, steps = blocks, []
    for t in turns:
        one = bpe.rewritten(one, t)
        steps.append(one)
    got = bpe.rewritten_in_turn(blocks, head, turns)
    assert state(got) == state(one) and state(got) != state(blocks) and index([got]) == index(steps)
    blocks.unpersist()


def _added(rows):
    out = {}
    for r in rows:
        out[r.code] = out.get(r.code, 0) + r.cnt
    return out


def test_words_by_their_most_frequent_pair():
    ids = np.array([0, 1, 2, -1, 2, -1, 1, 0], np.int32)
    top, size = bpe.most_frequent(ids, np.array([5, 7, 0, 0, 0, 0, 3]))
    assert top.tolist() == [7, 0, 3] and size.tolist() == [4, 2, 3]
    assert [x.tolist() for x in bpe.most_frequent(ids[:1], np.zeros(0, np.int64))] == [[0], [2]]
    assert (np.diff(bpe.LEVELS) > 0).all() and bpe.LEVELS[0] == 1


def test_documents_are_encoded_together_as_one_by_one(spark, monkeypatch):
    from tokscope.functions.text import UNK_TOKEN
    from tokscope.operators import encode
    monkeypatch.setattr(encode, "TOGETHER", 7)          # several slices of a batch, and documents with more pieces than one holds
    words = {"abab": 9, "abc": 7, "cab": 5, "a": 3, "bc": 4}
    m = bpe.train(spark.createDataFrame(list(words.items()), "word string, freq bigint"), vocab_size=60, min_frequency=1, specials=["[PAD]", UNK_TOKEN], max_merges=4)
    texts = ["abab cab", None, "", " \t ", "abc abab x!? abc", "abc " * 50, "zz", "abab cab", "\x1fbc\n"]
    rows = [(None if i == 4 else i % 7, "en", t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").coalesce(1)
    ids = {r.token: r.id for r in m.vocab.collect()}
    ranks, alphabet = {p: i for i, p in enumerate(m.merge_list)}, {t for t in ids if len(t) == 1}
    want = []
    for doc_id, _, t in rows:
        pieces = [p for w in (t or "").split() for p in (["x", "!?"] if w == "x!?" else [w])]
        tokens = [x for p in pieces for x in encode_word(p, ranks, alphabet, UNK_TOKEN)]
        want.append((doc_id, None if t is None else len(t.split()), len(tokens), tokens.count(UNK_TOKEN), [ids[x] for x in tokens], " ".join(tokens)))
    enc = encode.encoded_documents(docs, m, pretokenize=False)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_tokens, r.n_unk, r.ids) for r in enc.collect()))) == sorted(str(w[:5]) for w in want)
    assert sorted(map(str, map(tuple, encode.decoded_documents(enc, m).collect()))) == sorted(str((w[0], w[5])) for w in want)
    counts = encode.encode_documents(docs, m, pretokenize=False)
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_tokens, r.n_unk) for r in counts.collect()))) == sorted(str(w[:4]) for w in want)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ids" not in plan                   # what is only counted is not sent back


def test_token_ids_encode_the_texts_once(spark, monkeypatch):
    from tokscope.plans import q_bpe
    from tokscope.functions.text import SPECIAL_TOKENS
    words = {"the": 9, "and": 7, "ing": 5}
    m = bpe.train(spark.createDataFrame(list(words.items()), "word string, freq bigint"), vocab_size=60, min_frequency=1, specials=SPECIAL_TOKENS, max_merges=4)
    monkeypatch.setattr(q_bpe.training, "trained_model", lambda spark, sf_dir: m)
    monkeypatch.setattr(q_bpe.corpus, "documents", lambda spark, sf_dir, indic: spark.createDataFrame(
        [(1, "en", "the and the thing"), (2, "de", "and again and again"), (2, "de", "and the same number"), (None, "en", "the nameless thing"), (3, "en", None)],
        "doc_id bigint, lang string, text string"))
    got = q_bpe.q_bpe_token_ids(spark, "")
    assert "regexp_extract_all" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = [(r.doc_id, r.n_tokens, len(r.ids.split()), len(r.tokens.split())) for r in got.collect()]
    assert sorted(r[0] for r in rows) == [1, 2, 2, 2, 2] and all(r[1] == r[2] for r in rows)      # rows of one number meet each other, as before
