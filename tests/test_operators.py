from pyspark.sql import Window
from pyspark.sql import functions as F

from tokscope.operators import vocab
from tokscope.sources.corpus import first_n_per_group


def test_first_n_per_group_skewed(spark):
    # one hot group with most rows, spread over many partitions
    df = spark.range(0, 20000, numPartitions=13).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        (F.col("id") * 7919 % 20011).alias("k"))
    got = {(r["g"], r["k"]) for r in first_n_per_group(df, 37, "g", "k", fanout=4).collect()}
    w = Window.partitionBy("g").orderBy("k")
    exp = {(r["g"], r["k"]) for r in df.withColumn("rn", F.row_number().over(w)).where("rn <= 37").collect()}
    assert got == exp


def test_dense_ids_contiguous(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 100003).cast("string").alias("t"))
    out = vocab.dense_ids(df, "t", start=10).collect()
    ids = sorted(r["id"] for r in out)
    assert ids == list(range(10, 5010))
    by_id = sorted(out, key=lambda r: r["id"])
    toks = [r["t"] for r in by_id]
    assert toks == sorted(toks)


def test_vocab_algebra(spark):
    new = spark.createDataFrame([("[UNK]",), ("b",), ("c",), ("d",)], "token string")
    base = spark.createDataFrame([("a",), ("b",)], "token string")
    assert [r[0] for r in vocab.novel_tokens(new, base).collect()] == ["c", "d"]
    assert sorted(r[0] for r in vocab.novel_tokens(new, base, drop_specials=False).collect()) == ["[UNK]", "c", "d"]
    st = vocab.overlap_stats(new, base).first()
    assert (st["base_size"], st["new_size"], st["overlap"], st["novel"]) == (2, 3, 1, 2)
    assert st["specials_in_new"] == "[UNK]" and st["specials_in_base"] == ""
    ext = {r["token"]: r["id"] for r in vocab.extend_vocab(
        spark.createDataFrame([("a", 0), ("b", 1)], "token string, id bigint"),
        vocab.novel_tokens(new, base)).collect()}
    assert ext == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_salted_join_equals_plain_join(spark):
    from tokscope.operators.joins import salted_join
    big = spark.range(0, 5000, numPartitions=6).select(
        F.col("id").alias("doc"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", 1)] + [(str(i), i) for i in range(40)], "k string, v int")
    exp = sorted(tuple(r) for r in big.join(small, "k").select("doc", "k", "v").collect())
    got = sorted(tuple(r) for r in salted_join(big, small, ["k"], F.col("doc"), buckets=7).select("doc", "k", "v").collect())
    assert got == exp
    left = sorted(tuple(r) for r in salted_join(big, small, ["k"], F.col("doc"), how="left").select("doc", "k", "v").collect())
    assert left == sorted(tuple(r) for r in big.join(small, "k", "left").select("doc", "k", "v").collect())
