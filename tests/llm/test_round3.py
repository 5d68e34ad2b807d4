"""The n-gram join, importance resampling and code compression against brute force: odd rows, families of copies, empty tables."""

import hashlib
import math
import random
import re
import zlib

import brute
import numpy as np
import pytest
from conftest import DOC, clashing

from tokscope.llm import codes, ngram_join, resampling


def rows(df):
    return [tuple(r) for r in df.collect()]


def sort(x):
    return sorted(x, key=str)


# -- n-gram join -------------------------------------------------------------------------------------------------------
def shingles(text):
    w = brute.words(text)
    return frozenset(" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def join_by_force(src):
    sets = [shingles(t) for _, t in src]
    root = list(range(len(src)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(src):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(src, sets))]


def family(rng, n=120, size=70, words=60):
    """Edited copies of one text (many pairs link only through others), boilerplate shared by unlike texts, exact copies."""
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(size):
        t = list(base)
        for _ in range(rng.choice((0, 1, 1, 1, 2, 3))):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(t[:rng.randrange(words - 8, words + 1)]))
    common = " ".join(f"b{i}" for i in range(50))
    for i in range(n):
        own = " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.choice((4, 8, 12, 60))))
        out.append(f"{own} {common}" if i % 2 else f"{common}\n{own}")
    return out + out[:10]


def test_join_equals_brute_force(odd, documents):
    for docs in (odd, documents):
        assert sort(rows(ngram_join.op11_ngram_join(clashing(docs)))) == sort(join_by_force(rows(docs.select("doc_id", "text"))))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_of_families_in_small_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 16)
    monkeypatch.setattr(ngram_join, "SALT", 8)
    src = list(enumerate(family(random.Random(seed))))
    random.Random(seed).shuffle(src)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in src], DOC).repartition(3)
    want = join_by_force(src)
    assert len({c for *_, c in want}) < len(src) - 20
    assert sort(rows(ngram_join.op11_ngram_join(docs))) == sort(want)


def test_second_round_finds_links_that_leaders_miss(spark):
    """Chain: neighbours link, ends don't; the leader of a common n-gram is not similar to all."""
    w = [f"c{i}" for i in range(140)]
    src = [(i, " ".join(w[5 * i:5 * i + 64])) for i in range(14)] + [(50, "a b c"), (51, "a b c"), (52, "a b")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in src], DOC)
    assert sort(rows(ngram_join.op11_ngram_join(docs))) == sort(join_by_force(src))


def test_packed_numbers_come_back():
    g = np.array([0, 1, 255, 2 ** 40 + 7, 2 ** 48 - 1], np.uint64)
    assert (ngram_join.unpack(ngram_join.pack(g, 6), 6) == g).all() and len(ngram_join.pack(g, 6)) == 30


def test_a_family_makes_few_pairs(spark):
    """Hundreds of copies with one edit each: pairs grow with the family, not with its square."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    src = []
    for i in range(300):
        t = list(base)
        t[rng.randrange(80)] = f"x{i}"
        src.append((i, " ".join(t), "en", "s", 1))
    src.append((300, " ".join(base), "en", "s", 1))
    out = ngram_join.prepared(spark.createDataFrame(src, DOC))
    entries = out.filter("kind = 1").select("gram", "row", "size", "place", "own", "tail")
    sets = out.filter("kind = 2").select("row", "size", "grams")
    tried = ngram_join.with_leaders(entries, 80).persist()
    assert tried.count() < 301 * 8
    links = ngram_join.verified(tried, sets, 80)
    assert ngram_join.across(entries, ngram_join.components(links), 80).count() == 0
    tried.unpersist()


# -- resampling --------------------------------------------------------------------------------------------------------
def resampled_by_force(src, target, lo=1, hi=1, buckets=10_000):
    def find(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(brute.UPPER))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]

    own, wanted = [find(t) for _, t in src], [find(t)[1] for t in target]
    s = np.bincount([b for _, f in own for b in f], minlength=buckets)
    t = np.bincount([b for f in wanted for b in f], minlength=buckets)
    gain = [math.floor(1000 * math.log((int(y) + 1) * (int(s.sum()) + buckets) / ((int(x) + 1) * (int(t.sum()) + buckets)))) for x, y in zip(s, t)]
    out = []
    for (d, _), (n, f) in zip(src, own):
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f) // len(f) if f else 0
        out.append((d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((i for i, r in enumerate(out) if r[1] >= 20), key=lambda i: (-out[i][4], out[i][0] is None, out[i][0] or 0, out[i][2], out[i][3]))
    place = {i: p + 1 for p, i in enumerate(order[:10 * len(order) // 100])}
    return [(d, f, w, x, place.get(i)) for i, (d, _, f, w, x) in enumerate(out)]


def test_resampling_equals_brute_force(spark, odd, documents):
    target = ["The cat and the DOG sat there", "one café 1 two", None, "die Katze und der Hund"] * 3
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    for docs in (odd, documents):
        assert sort(rows(resampling.op12_resampling(clashing(docs), clashing(bench)))) == sort(resampled_by_force(rows(docs.select("doc_id", "text")), target))


def test_windows_of_offsets_and_pieces(monkeypatch):
    text = "One two, THREE-four café5six seven " * 30
    want = resampled_by_force([(1, text)], [], 1, 3)[0]
    n, found = resampling.Buckets(1, 3).of(text)
    monkeypatch.setattr(resampling, "_PIECE", 10)                      # a text handed over in many pieces gives the same
    assert (n, found.tolist()) == (resampling.Buckets(1, 3).of(text)[0], resampling.Buckets(1, 3).of(text)[1].tolist())
    assert len(found) == want[1] and found.max() < 10_000
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(brute.UPPER))
    assert found[n] == zlib.crc32(" ".join(w[:2]).encode()) % 10_000


def test_resampling_moves_towards_the_target(spark):
    rng = random.Random(0)
    src = [(i, " ".join(rng.choice(("sea ship wave", "corn field plough")[i % 2].split()) for _ in range(40)), "en", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(src, DOC)
    bench = spark.createDataFrame([(0, "sea ship wave " * 50)], "item_id bigint, text string")
    drawn = [r.doc_id % 2 for r in resampling.resample(docs, bench).collect()]
    assert len(drawn) == 40 and sum(drawn) < 10


# -- codes -------------------------------------------------------------------------------------------------------------
VEC = "vec_id bigint, embedding array<float>, label int"


def coded_by_force(src, parts=4, entries=256, rounds=4):
    """src: (vec_id, vector, label) of usable rows."""
    kept = sorted(src, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[[math.floor(1024 * x) for x in v[p * len(v) // parts:(p + 1) * len(v) // parts]] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[i][p] for i in range(min(entries, len(kept)))] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            d = [min((sum((a - b) ** 2 for a, b in zip(c[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)]
            out.append(d)
        return out

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, d in zip(cut, got) if d[p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assign()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = [sum(x for x, _ in d) for d in got]
    by = {}
    for (_, _, label), e in zip(kept, error):
        by[label] = by.get(label, 0) + e
    return [(v, "".join(f"{i:02x}" for _, i in d), e, by[label], sha) for (v, _, label), d, e in zip(kept, got, error)]


def vectors(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[n // 2:n // 2 + n // 3] = x[0]                                    # a vector that a third of the rows share
    return [(int(i), [float(v) for v in r], None if i % 7 == 0 else int(i % 3)) for i, r in enumerate(x)]


def test_codes_equal_brute_force(spark):
    src = vectors(0, 600)
    bad = [(9001, None, 1), (9002, [], 1), (9003, [1.0, None] * 8, 1), (9004, [float("nan")] * 16, 1), (9005, [float("inf")] * 16, 2), (9006, [1.0] * 12, 0),
           (9007, [1e30] * 16, 0)]
    twice = [(5, [0.5] * 16, 1), (5, [0.25] * 16, 1), (None, [0.75] * 16, None)]
    df = spark.createDataFrame(src + bad + twice, VEC).repartition(5)
    from pyspark.sql import functions as F
    names = ("row", "pos", "code", "error", "same", "codes")
    got = rows(codes.op13_codes(df.select("*", *(F.lit("no").alias(c) for c in names))))
    assert sort(got) == sort(coded_by_force(src + twice))


def test_codes_of_few_rows_and_of_none(spark):
    src = vectors(1, 30, 8)
    assert sort(rows(codes.op13_codes(spark.createDataFrame(src, VEC)))) == sort(coded_by_force(src))
    assert rows(codes.op13_codes(spark.createDataFrame([], VEC))) == []


def test_more_rounds_than_a_checkpoint(spark, monkeypatch):
    monkeypatch.setattr(codes, "CUT", 2)
    src = vectors(2, 200, 8)
    coded, books = codes.compress(spark.createDataFrame(src, VEC), entries=16, rounds=7)
    want = coded_by_force(src, entries=16, rounds=7)
    assert codes.digest(books) == want[0][4]
    assert sort((r.vec_id, r.error) for r in coded.collect()) == sort((w[0], w[2]) for w in want)


def test_large_whole_numbers_stay_exact():
    x = np.array([[2 ** 26, -2 ** 26], [2 ** 26 - 1, 3]], np.int64)
    e, d = codes.nearest(x, np.array([[0, 0], [2 ** 26 - 2, 4]], np.int64))
    assert e.tolist() == [1, 1] and d.tolist() == [4 + (2 ** 26 + 4) ** 2, 2]


def test_only_changed_members_move(spark):
    """Stayers and arrivals share one partitioner, so the union has the owners' partitions and stayers aren't shuffled."""
    df = codes.written(codes.usable(spark.createDataFrame(vectors(3, 400, 8), VEC), 4).selectExpr("*", "vec_id AS row"), "t")
    first = df.orderBy("vec_id").limit(16).collect()
    books = np.ascontiguousarray(codes.whole_parts(np.array([r.embedding for r in first], float), 4, 1024).transpose(1, 0, 2))
    m = codes.Members.start(df, books, 8, 1024)
    m.update()
    m.assign()
    assert m.rdd.getNumPartitions() == 8
    moved = sum(len(x[1][0]) for tag, x in m.held.collect() if not tag)
    stayed = sum(len(x[1][0]) for tag, x in m.held.collect() if tag)
    assert 0 < moved < stayed and moved + stayed == 1600
