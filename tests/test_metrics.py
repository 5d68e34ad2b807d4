"""Evaluation plan vs. a brute-force computation of the documented formulas."""

from tokscope.functions import langmeta
from tokscope.operators.tokenizers import SQL_MODELS
from tokscope.plans import evaluation

from reference_impl import pretokenize

DOCS = [(1, "eng", "Hello world, 1,234.5 times!  "), (2, "eng", "  ▁ab ##cd [UNK] x"),
        (3, "hin", "नमस्ते दुनिया। abc"), (4, "hin", "क ख ग"), (5, "eng", "short")]


def _tokens(model, s):
    if model == "whitespace":
        return s.split()
    if model == "char":
        return [c for c in s if not c.isspace()]
    if model == "byte":
        return ["<0x%02X>" % b for b in "".join(s.split()).encode("utf-8")]
    return pretokenize(s)


def test_evaluate_matches_brute_force(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, lang string, text string")
    res = {(r["model"], r["lang_code"]): r for r in
           evaluation.evaluate(spark, df, SQL_MODELS, n=None, max_chars=None, cont_docs=None).collect()}
    vocab_chars = {}
    for m in SQL_MODELS:
        chars = set()
        for _, _, t in DOCS:
            if len(t.strip()) < 10:  # the evaluated sample keeps length >= 10
                continue
            for tok in _tokens(m, t.strip()):
                c = tok.lstrip("▁Ġ#Ċ")
                if c:
                    chars.add(c[0])
        vocab_chars[m] = chars
    meta = {c: (lo, hi) for c, _, _, lo, hi in langmeta.all_lang_meta()}
    for m in SQL_MODELS:
        for lang in ("eng", "hin"):
            texts = [t.strip() for _, l, t in DOCS if l == lang and len(t.strip()) >= 10]
            toks = [_tokens(m, t) for t in texts]
            words = sum(len(t.split()) for t in texts)
            ntok = sum(len(x) for x in toks)
            nref = sum(len(pretokenize(t)) for t in texts)
            split = sum(1 for t in texts for w in t.split() if len(_tokens(m, w)) > 1)
            lens = [len(x.lstrip("▁Ġ#Ċ<>[]")) for tt in toks for x in tt]
            lo, hi = meta[lang]
            assigned = [chr(c) for c in range(lo, hi + 1) if __import__("unicodedata").category(chr(c)) != "Cn"]
            r = res[(m, lang)]
            assert r["n_docs"] == len(texts) and r["n_words"] == words and r["n_tokens"] == ntok
            assert r["fertility"] == ntok / words
            assert r["bytes_per_token"] == sum(len(t.encode()) for t in texts) / ntok
            assert r["nsl"] == ntok / nref
            assert r["continuation_rate"] == split / words
            assert abs(r["avg_token_len"] - sum(lens) / len(lens)) < 1e-12
            assert abs(r["vocab_coverage"] - sum(c in vocab_chars[m] for c in assigned) / len(assigned)) < 1e-12


def test_evaluation_splits_the_text_once(spark, tmp_path):
    """The text is scanned and split for the word table only; everything in the result's plan reads that table."""
    from tokscope.operators import metrics
    from tokscope.operators.tokenizers import SQL_MODELS
    from tokscope.plans import evaluation
    from tokscope.sources import corpus
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(1, "eng", "some longer text"), (2, "hin", "more words in here")], "doc_id long, lang string, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    words = metrics.word_counts(corpus.sample_eval(docs))._jdf.queryExecution().executedPlan().toString()
    assert words.count("FileScan") == 1 and words.count("posexplode") == 1
    plan = evaluation.evaluate(spark, docs, SQL_MODELS)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and path not in plan


def test_words_are_not_dealt_out_per_model(spark):
    """Every tokenizer's sums are taken side by side, one row a word; the closed forms agree with the tokens."""
    from tokscope.functions.text import COVERAGE_MARKERS, LENGTH_MARKERS
    from tokscope.operators import metrics
    from tokscope.operators.tokenizers import SQL_MODELS, TOKENIZERS
    words = ["ab", "#a#b[1]<", "▁Ġ#Ċ", "\U0001d4cd\U0001d4cdé", "नमस्ते,x", "12.5!!", "[", "Ċa", "क\u200dख"]
    rows = [(lang, i % 2 == 0, w, i + 1, 0) for i, w in enumerate(words) for lang in ("x", "y")[:1 + i % 2]] + [("x", True, None, 3, 40), ("y", True, None, 2, 9)]
    wc = spark.createDataFrame(rows, "lang string, in_cont boolean, word string, cnt long, n_bytes long")
    sums = metrics.model_sums(wc, {"c": "char", "again": "char"} | {m: m for m in SQL_MODELS})
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan[plan.index("Aggregate"):]
    got = {(r["model"], r["lang"]): r for r in sums.collect()}
    first = {}
    for r in metrics.first_chars(wc, {"c": "char"} | {m: m for m in SQL_MODELS}).collect():
        assert r["ch"] not in first.setdefault(r["model"], set())
        first[r["model"]].add(r["ch"])
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for m in SQL_MODELS:
        toks = {r["w"]: list(r["t"]) for r in df.select("w", TOKENIZERS[m].tokens(df.w).alias("t")).collect()}
        for lang in ("x", "y"):
            mine = [(toks[w], n, cont) for x, cont, w, n, _ in rows if x == lang and w is not None]
            r = got[(m, lang)]
            assert (r["n_words"], r["cont_words"]) == (sum(n for _, n, _ in mine), sum(n for _, n, c in mine if c))
            assert r["n_tokens"] == r["len_n"] == sum(len(t) * n for t, n, _ in mine) and r["n_unk"] == 0
            assert r["len_sum"] == sum(len(x.lstrip(LENGTH_MARKERS)) * n for t, n, _ in mine for x in t)
            assert r["cont_split"] == sum(n for t, n, c in mine if c and len(t) > 1)
            assert r["n_ref_tokens"] == got[("script", lang)]["n_tokens"]
        assert first[m] == {y[0] for t in toks.values() for x in t if (y := x.lstrip(COVERAGE_MARKERS))}
    assert first["c"] == first["char"] and got[("c", "x")][2:] == got[("char", "x")][2:] == got[("again", "x")][2:]
