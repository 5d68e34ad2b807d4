"""Vocabulary tables and their set algebra.

A vocabulary is a DataFrame ``(token STRING, id BIGINT[, is_special BOOLEAN])``.
Set operations are joins on ``token`` (shuffle-hash / sort-merge on the token
key, or broadcast when the optimizer's size estimate allows); nothing is
collected. Dense id assignment is a sort plus per-partition offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokscope.functions import langmeta
from tokscope.functions.text import SPECIAL_TOKENS, first_char, is_mixed_script, length_bucket, safe_div
from tokscope.session import ensure_checkpoint_dir
from tokscope.sources.corpus import first_n_per_group

QA_SAMPLES = 10      # fixed value: samples per length bucket


def dense_ids(df: DataFrame, order_col: str, id_col: str = "id", start: int = 0) -> DataFrame:
    """Add ``id_col`` = start + 0-based position in ``order_col`` order.

    Distributed: a range-partitioned sort, then each row's id is the offset
    of its partition (sum of earlier partition sizes, a table with one row
    per partition -- bounded by the partition count, broadcast) plus its
    index inside the partition. The sorted table is checkpointed first so
    both passes see the same partitioning.
    """
    ensure_checkpoint_dir(df.sparkSession)
    srt = (df.orderBy(order_col)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id())
           .checkpoint(eager=True))
    counts = srt.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (srt.join(F.broadcast(offsets), "_pid")
            .withColumn(id_col, (F.lit(start) + F.col("_off") + local).cast("bigint"))
            .drop("_pid", "_mid", "_off"))


def pretoken_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """token, freq: script pre-token frequencies of a corpus.

    Pre-tokens never cross whitespace, so whitespace words are counted first
    (partial aggregation combines hot words map-side) and only the distinct
    words are pre-tokenized; their counts are then summed per pre-token.
    """
    from tokscope.functions.pretok import pretokens
    from tokscope.functions.text import WS
    w = (docs.select(F.explode(F.split(F.col(text_col), f"{WS}+")).alias("w")).where(F.col("w") != "")
         .groupBy("w").agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    return (w.select(F.explode(pretokens("w")).alias("token"), "n")
            .groupBy("token").agg(F.sum("n").cast("bigint").alias("freq")))


def token_frequencies(tokens: DataFrame, col: str = "token") -> DataFrame:
    """token, freq: partial aggregation combines hot tokens map-side."""
    return tokens.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("freq"))


def vocab_from_frequencies(freq: DataFrame, min_count: int = 5,
                           specials: list[str] | None = None) -> DataFrame:
    """token, id, is_special: specials first (ids 0..k-1 in the given order),
    then tokens with freq >= min_count by code-point order."""
    spark = freq.sparkSession
    specials = specials or []
    kept = freq.where(F.col("freq") >= min_count).select("token")
    if specials:
        sp = spark.createDataFrame([(t,) for t in specials], "token string")
        kept = kept.join(sp, "token", "left_anti")
    body = dense_ids(kept, "token", start=len(specials)).withColumn("is_special", F.lit(False))
    if not specials:
        return body
    sp_rows = spark.createDataFrame([(t, i, True) for i, t in enumerate(specials)],
                                    "token string, id bigint, is_special boolean")
    return sp_rows.unionByName(body)


def remove_specials(vocab: DataFrame, specials: list[str] = SPECIAL_TOKENS) -> DataFrame:
    spark = vocab.sparkSession
    sp = spark.createDataFrame([(t,) for t in specials], "token string")
    return vocab.join(F.broadcast(sp), "token", "left_anti")


def novel_tokens(new: DataFrame, base: DataFrame, drop_specials: bool = True) -> DataFrame:
    """token: new - (specials) - base, in code-point order."""
    n = remove_specials(new) if drop_specials else new
    return (n.select("token").distinct().join(base.select("token"), "token", "left_anti")
            .orderBy("token"))


def overlap_stats(new: DataFrame, base: DataFrame, specials: list[str] = SPECIAL_TOKENS) -> DataFrame:
    """One row: base_size, new_size (specials removed), overlap, novel,
    specials_in_base, specials_in_new -- one union, one groupBy(token), one
    global aggregate (no cross products)."""
    spark = new.sparkSession
    sp = F.broadcast(spark.createDataFrame([(t, True) for t in specials], "token string, special boolean"))
    rows = (base.select("token", F.lit(1).alias("b"), F.lit(0).alias("n"))
            .unionByName(new.select("token", F.lit(0).alias("b"), F.lit(1).alias("n"))))
    per = (rows.groupBy("token").agg(F.max("b").alias("b"), F.max("n").alias("n"))
           .join(sp, "token", "left").withColumn("special", F.coalesce("special", F.lit(False))))
    ns = (F.col("n") == 1) & ~F.col("special")
    agg = per.agg(
        F.sum("b").cast("bigint").alias("base_size"),
        F.count_if(ns).cast("bigint").alias("new_size"),
        F.count_if(ns & (F.col("b") == 1)).cast("bigint").alias("overlap"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("special") & (F.col("b") == 1), F.col("token")))),
                     " ").alias("specials_in_base"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("special") & (F.col("n") == 1), F.col("token")))),
                     " ").alias("specials_in_new"))
    return agg.select("base_size", "new_size", "overlap",
                      (F.col("new_size") - F.col("overlap")).alias("novel"),
                      "specials_in_base", "specials_in_new")


def extend_vocab(base: DataFrame, novel: DataFrame) -> DataFrame:
    """token, id: base ids kept; novel tokens appended after max(base.id) in
    code-point order."""
    nxt = base.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("m")).first()["m"] + 1
    add = dense_ids(novel.select("token"), "token", start=int(nxt))
    return base.select("token", F.col("id").cast("bigint").alias("id")).unionByName(add)


def length_bucket_qa(tokens: DataFrame, k: int = QA_SAMPLES) -> DataFrame:
    """bucket, n_tokens, samples: counts per length bucket and the first k
    tokens (code-point order) of each, space-joined. Only the k-row head of
    each bucket is ever gathered (skew-safe top-k)."""
    b = tokens.select("token", length_bucket("token").alias("bucket"))
    counts = b.groupBy("bucket").agg(F.count(F.lit(1)).cast("bigint").alias("n_tokens"))
    heads = (first_n_per_group(b, k, "bucket", "token").groupBy("bucket")
             .agg(F.array_join(F.array_sort(F.collect_list("token")), " ").alias("samples")))
    return counts.join(heads, "bucket")


def mixed_script_tokens(tokens: DataFrame) -> DataFrame:
    """Every mixed-script token (Latin letter + U+0900..U+0D7F), with the total count of such tokens on every row
    (a single scalar, computed by one aggregate job)."""
    mixed = tokens.where(is_mixed_script("token")).select("token")
    return mixed.withColumn("n_mixed", F.lit(mixed.count()).cast("bigint"))


def vocab_coverage(spark: SparkSession, vocab: DataFrame) -> DataFrame:
    """lang_code, vocab_coverage: share of the language's assigned code points
    that are the first character of some (marker-cleaned) vocabulary token."""
    fc = vocab.select(first_char("token").alias("ch")).where(F.col("ch").isNotNull()).distinct()
    meta = langmeta.lang_meta_df(spark).select("lang_code", "cp_lo", "cp_hi")
    lang_cps = meta.join(F.broadcast(langmeta.assigned_codepoints_df(spark)), ["cp_lo", "cp_hi"])
    hit = lang_cps.join(fc.withColumn("hit", F.lit(1)), "ch", "left")
    return hit.groupBy("lang_code").agg(safe_div(F.count("hit"), F.count(F.lit(1))).alias("vocab_coverage"))
