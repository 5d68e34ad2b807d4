import random

from pyspark.sql import functions as F

from tokscope.functions import text as T

SAMPLES = ["  hello world  ", "\n  x y\tz  \n", "a b", "\u001ca", "  line  ", "　x　",
           "", "   ", "a​b", "tab\there", "x\u0085y", " narrow ", "\u000bvt\u000c"]


def _rand_strings(n=200, seed=7):
    rnd = random.Random(seed)
    alphabet = "ab \t\n \u001c 　​.é।नक\u0085\u000b"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def test_strip_and_words_match_python(spark):
    data = SAMPLES + _rand_strings()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    rows = df.select("i", T.strip("s").alias("st"), T.words("s").alias("w"),
                     T.n_words_stripped(T.strip("s")).alias("n")).collect()
    for r in rows:
        s = data[r["i"]]
        assert r["st"] == s.strip(), repr(s)
        assert list(r["w"]) == s.split(), repr(s)
        assert r["n"] == len(s.split()), repr(s)


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(T.strip("s")).first()[0] == ""


def test_grades(spark):
    vals = [0.9, 1.0, 1.4999, 1.5, 2.5, 4.0, 999.0]
    df = spark.createDataFrame([(v,) for v in vals], "f double")
    a = [r[0] for r in df.select(T.grade_eval("f")).collect()]
    b = [r[0] for r in df.select(T.grade_train("f")).collect()]
    assert a == ["Poor", "Excellent", "Excellent", "Good", "Marginal", "Poor", "Poor"]
    assert b == ["Excellent", "Excellent", "Excellent", "Good", "Marginal", "Poor", "Poor"]


def test_marker_strip(spark):
    toks = ["▁ab", "##ing", "Ġ", "[UNK]", "#Ġ▁x"]
    df = spark.createDataFrame([(t,) for t in toks], "t string")
    cov = [r[0] for r in df.select(T.strip_coverage_markers("t")).collect()]
    ln = [r[0] for r in df.select(T.strip_length_markers("t")).collect()]
    assert cov == [t.lstrip("▁Ġ#Ċ") for t in toks]
    assert ln == [t.lstrip("▁Ġ#Ċ<>[]") for t in toks]
    assert ln[3] == "UNK]"
    fc = [r[0] for r in df.select(T.first_char("t")).collect()]
    assert fc == ["a", "i", None, "[", "x"]


def test_length_bucket_and_mixed(spark):
    df = spark.createDataFrame([("ab",), ("abc",), ("abcdefg",), ("नab",), ("नम",)], "t string")
    assert [r[0] for r in df.select(T.length_bucket("t")).collect()] == ["short", "medium", "long", "medium", "short"]
    assert [r[0] for r in df.select(T.is_mixed_script("t")).collect()] == [False, False, False, True, False]


def test_example_preview(spark):
    toks = [str(i) for i in range(35)]
    df = spark.createDataFrame([(toks, "a\nb\r\nc")], "t array<string>, s string")
    r = df.select(T.token_preview("t").alias("p"), T.example_sentence("s").alias("e")).first()
    assert r["p"] == " | ".join(toks[:30]) + " ... (+5 more)"
    assert r["e"] == "a b\r c"
