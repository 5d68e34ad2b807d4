import random

from pyspark.sql import functions as F

from reference_impl import model_split, pretokenize, pretokenize_spans
from tokscope.functions import pretok

FIXTURES = [
    ("réaile 1,234.5.", ["r", "é", "aile", "1,234.5", "."]),
    ("नमस्ते।ab", ["नमस्ते।", "ab"]),
    ("বাংলা।", ["বাংলা", "।"]),
    ("क‍ख", ["क", "‍", "ख"]),
    ("ꯀꯁ", ["ꯀ", "ꯁ"]),
    ("a b", ["a", "b"]),
    ("\u001ca", ["a"]),
    ("", []),
    ("  \n\t ", []),
    ("a_b--c", ["a", "_", "b", "-", "-", "c"]),
]


def test_fixture_rows(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(FIXTURES)], "i int, s string")
    got = {r["i"]: list(r["p"]) for r in df.select("i", pretok.pretokens("s").alias("p")).collect()}
    for i, (s, exp) in enumerate(FIXTURES):
        assert got[i] == exp, s
        assert pretokenize(s) == exp, s


def test_random_text_matches_python(spark):
    rnd = random.Random(3)
    pool = "abcXYZ019.,-_ \n\t éनमক্টতమಕഅᱚابپ।॥!?‍ "
    data = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    rows = df.select("i", pretok.pretokens("s").alias("p"), pretok.model_split(pretok.pretokenized_text("s")).alias("m")).collect()
    for r in rows:
        s = data[r["i"]]
        assert list(r["p"]) == pretokenize(s), repr(s)
        assert list(r["m"]) == model_split(" ".join(pretokenize(s))), repr(s)
    sp = pretok.pretoken_spans(df.withColumnRenamed("i", "doc_id").withColumnRenamed("s", "text")).collect()
    by = {}
    for r in sp:
        by.setdefault(r["doc_id"], []).append((r["pos"], r["token"], r["span_start"], r["span_end"]))
    for i, s in enumerate(data):
        exp = pretokenize_spans(s)
        got = [(t, a, b) for _, t, a, b in sorted(by.get(i, []))]
        assert got == exp, repr(s)
        for t, a, b in got:
            assert s[a:b] == t


def test_script_classes_partition_tokens(spark):
    df = spark.createDataFrame([("नमस्ते ab 12 বাংলা ! ᱚᱛ",)], "s string")
    r = df.select(F.transform(pretok.pretokens("s"), pretok.script_class).alias("c")).first()["c"]
    assert list(r) == ["Devanagari", "Latin", "Digits", "Bengali", "Other", "Ol Chiki"]


def test_spans_in_segments(spark):
    """Chunks of four matches: carries over a text's chunks; repeated rows and rows without id keep their own sums; no Python node."""
    texts = ["ab cd,ef  gh!! 12.5x y " * 5, "नमस्ते ab\n\n c", None, "", "ab cd,ef  gh!! 12.5x y " * 5]
    df = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (3, texts[2]), (None, texts[3]), (1, texts[4]), (None, "a b")], "doc_id long, text string")
    out = pretok.pretoken_spans(df, chunk=4)
    want = sorted([(d, k, t, a, b) for d, x in [(r[0], r[1]) for r in df.collect()] for k, (t, a, b) in enumerate(pretokenize_spans(x or ""))], key=str)
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_spans_stay_where_the_text_is_read(spark):
    """No shuffle, sort or window; texts of more tokens than the largest block, with white space at both ends."""
    texts = ["\u3000ab 12,5.x!!  \U0001d4cdé\u00a0\n" * 150, " " * 30_000 + "a" + " " * 30_000, "-" * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = pretok.pretoken_spans(df, chunk=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Sort", "Window", "FileScan"))
    want = [(d, k, t, a, b) for d, x in enumerate(texts) for k, (t, a, b) in enumerate(pretokenize_spans(x))]
    assert sorted(map(tuple, out.collect())) == want and len(want) > 64 * 8
