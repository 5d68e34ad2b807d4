"""Language identification against a plain-Python form of its backoff."""

import math
import re
from collections import Counter

import brute
import pytest
from conftest import DOC

from tokscope.llm import langid


def predicted_by_force(src, lang_grams):
    """src: (doc_id, text, lang) -> doc_id, lang, score, per row."""
    def words(t):
        return [w for w in re.findall(r"[^\W\d_]+", (t or "").lower()) if any(c.isalpha() for c in w)]

    def parts(w, n):
        m = w if n == 1 else f"^{w}$"
        return [m[i:i + n] for i in range(len(m) - n + 1)]

    count, langs = {}, sorted({x for d, t, x in src if x and brute.crc(d, 3) != 1 and words(t)})
    for d, t, x in src:
        if x and brute.crc(d, 3) != 1:
            count.setdefault(x, Counter()).update(words(t))
    known = {w for x in langs for w in count[x]}
    total = {x: sum(count[x].values()) for x in langs}
    gram = {n: {x: Counter(g for w in count[x] for g in parts(w, n)) for x in langs} for n in range(1, 6)}
    kept = {n: {g for x in langs for g, _ in sorted(gram[n][x].items(), key=lambda i: (-i[1], i[0]))[:lang_grams]} for n in gram}

    def log(c, t, n):
        return math.log((c + 0.5) / (t + 0.5 * (n + 1)))

    def score(w):
        if w in known:
            return [log(count[x][w], total[x], len(known)) for x in langs]
        for n in range(5, 0, -1):
            at = [g for g in parts(w, n) if g in kept[n]]
            if at:
                return [sum(log(gram[n][x][g], sum(gram[n][x].values()), len(kept[n])) for g in at) / len(at) for x in langs]
        return None

    out = []
    for d, t, _ in src:
        found = [v for w in words(t) if (v := score(w)) is not None]
        if not found:
            out.append((d, "und", 0.0))
            continue
        s = [sum(x) for x in zip(*found)]
        best = max(s)
        out.append((d, langs[s.index(best)], 1 / sum(math.exp(x - best) for x in s)))
    return out


def compare(spark, monkeypatch, src, sent, grams):
    monkeypatch.setattr(langid, "SENT_WORDS", sent)
    monkeypatch.setattr(langid, "LANG_GRAMS", grams)
    docs = spark.createDataFrame([(d, t, x, "s", 1) for d, t, x in src], DOC).repartition(3)
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.op1_langid(docs).collect()), key=str)
    want = sorted(predicted_by_force(src, grams), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-4, abs=1e-6)


TEXTS = {"en": ["the cat sat on the mat", "a dog and the cat", "where is the mat 42"], "de": ["der hund und die katze", "wo ist die matte", "der kater"],
         "fr": ["le chat est sur le tapis", "un chien et le chat", "ou est le tapis"]}


@pytest.mark.parametrize("sent", [3, 1000])
def test_backoff_equals_brute_force(spark, monkeypatch, sent):
    src = [(i, t, x) for i, (x, t) in enumerate((x, t) for _ in range(4) for x in TEXTS for t in TEXTS[x])]
    src += [(100, "die katzen und hunde", None), (101, "chats tapis unknownword", "en"), (102, "123 !!!", "en"), (103, None, "de"), (104, "\u00b2\u00b3", "de"),
            (105, "zzz", None), (106, "\u4f60\u597d", None), (None, "the cat", "en"), (107, "The CAT the dog", "en")]
    compare(spark, monkeypatch, src, sent, 12)


def test_small_language_beside_a_large_one(spark, monkeypatch):
    """A language whose words are all rarer than thousands of the large one's keeps every word that it has."""
    large = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(60)) + " and so on", "en") for i in range(120)]
    small = [(1000 + i, f"moja rijec nova{chr(97 + i)}", "hr") for i in range(12)]
    src = large * 2 + small
    compare(spark, monkeypatch, src, 20, 15)
    docs = spark.createDataFrame([(d, t, x, "s", 1) for d, t, x in src], DOC)
    assert {r.lang_pred for r in langid.op1_langid(docs).filter("doc_id >= 1000").collect()} == {"hr"}
