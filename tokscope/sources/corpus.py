"""Corpus sources: table scans, cleaning and per-language capped samples.

The reference pulls "the first N documents" of a language from a lazily
streamed split. Here "first" is defined by the ``doc_id`` order key, and the
cap is an exact distributed top-N (see :func:`first_n_per_group`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokscope.functions import langmeta
from tokscope.functions.text import strip, truncate

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# --- fixed values: thresholds and caps of the reference --------------------
MAX_TRAIN_DOCS = 200_000      # per language, training ingest
MAX_TEST_DOCS = 5_000         # per language, fertility sample
SAMPLES_PER_LANG = 1_000      # per language, evaluation sample
MAX_CHARS_PER_DOC = 2_000     # evaluation truncation
TRAIN_MIN_EXCLUSIVE = 20      # training ingest keeps length > 20
FERT_MIN_INCLUSIVE = 20       # fertility sample keeps length >= 20
EVAL_MIN_INCLUSIVE = 10       # evaluation sample keeps length >= 10
# ---------------------------------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def balanced(df: DataFrame) -> DataFrame:
    """Deal a scan to ``spark.tokscope.scan.partitions`` tasks where the session sets that (local sessions do: their test
    files are one row group each). Unset, the default, the scan keeps its own splits and nothing is shuffled."""
    n = df.sparkSession.conf.get("spark.tokscope.scan.partitions", None)
    return df.repartition(int(n)) if n else df


def documents(spark: SparkSession, sf_dir: str, indic: bool = False) -> DataFrame:
    """doc_id, lang, text (pruned scan). ``indic=True`` gives the derived
    Indic-script view (de->Bengali, es->Tamil, fr->Devanagari, en unchanged)."""
    df = balanced(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    if indic:
        df = df.select("doc_id", langmeta.indic_lang(F.col("lang")).alias("lang"),
                       langmeta.indic_text(F.col("text"), F.col("lang")).alias("text"))
    return df


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only a..m translated: words mix Latin and an Indic script."""
    df = balanced(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    expr = None
    for src, (_, start) in langmeta.INDIC_VIEW_LANGS.items():
        if start is None:
            continue
        t = F.translate(F.lower("text"), langmeta.LATIN_LOWER[:13],
                        langmeta.script_alphabet(start)[:13])
        expr = F.when(F.col("lang") == src, t) if expr is None else expr.when(F.col("lang") == src, t)
    return df.select("doc_id", langmeta.indic_lang(F.col("lang")).alias("lang"),
                     expr.otherwise(F.col("text")).alias("text"))


def first_n_per_group(df: DataFrame, n: int, group: list[str] | str, order: list[str] | str, fanout: int | None = None) -> DataFrame:
    """Exact first-``n`` rows per group by ``order`` (unique within a group, e.g. ``doc_id``).

    Only key columns are shuffled: a group is dealt to ``fanout`` parts by the hash of its order key (as many as there are
    shuffle partitions, unless given), each part keeps its first n, and the parts are merged sixteen at a time, so a
    hot group spreads over many tasks whatever n is. One cutoff per group, its n-th key, then filters the rows; it is joined per
    part, so there too a hot group's rows spread.
    """
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, str) else list(order)
    parts = fanout or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, deal = F.pmod(F.xxhash64(*order), F.lit(parts)), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))
    keys = df.select(*group, *order, part.alias("_part"))
    while True:
        w = Window.partitionBy(*group, "_part").orderBy(*order)
        keys = keys.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
        if parts == 1:
            break
        parts = -(-parts // 16)
        keys = keys.withColumn("_part", F.pmod("_part", F.lit(parts)))
    key = F.struct(*[F.col(c) for c in order])
    cut = keys.groupBy(*group).agg(F.max(key).alias("_cut")).withColumn("_part", deal)
    on = F.col("d._part") == F.col("c._part")
    for c in group:
        on = on & F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}"))
    last = F.struct(*[F.col(f"d.{c}") for c in order])
    return df.withColumn("_part", part).alias("d").join(cut.alias("c"), on).where(last <= F.col("c._cut")).select("d.*").drop("_part")


def sample_eval(df: DataFrame, n: int | None = None,
                max_chars: int | None = None,
                min_chars: int = EVAL_MIN_INCLUSIVE, fanout: int | None = None) -> DataFrame:
    """Evaluation sample: strip, keep length >= min_chars (tested before the
    cut), truncate to ``max_chars``, first ``n`` kept per language (None: whole texts, all documents)."""
    t = strip("text")
    out = (df.select("doc_id", "lang", t.alias("text"))
           .where(F.length("text") >= min_chars)
           .withColumn("text", truncate("text", max_chars)))
    if n is not None:
        out = first_n_per_group(out, n, "lang", "doc_id", fanout)
    return out


def sample_fertility(df: DataFrame, n: int | None = None,
                     min_chars: int = FERT_MIN_INCLUSIVE, fanout: int | None = None) -> DataFrame:
    """Fertility sample: strip, keep length >= 20, first n kept, no truncation."""
    return sample_eval(df, n=n, max_chars=None, min_chars=min_chars, fanout=fanout)


def ingest_cap_before_filter(df: DataFrame, cap: int | None = None,
                             min_exclusive: int = TRAIN_MIN_EXCLUSIVE,
                             fanout: int | None = None) -> DataFrame:
    """Training ingest: take the first ``cap`` *raw* rows per language, then
    strip and keep length > 20 (so kept <= cap)."""
    raw = df.select("doc_id", "lang", "text")
    if cap is not None:
        raw = first_n_per_group(raw, cap, "lang", "doc_id", fanout)
    return (raw.select("doc_id", "lang", strip("text").alias("text"))
            .where(F.length("text") > min_exclusive))


def ingest_cap_after_filter(df: DataFrame, cap: int | None = None,
                            min_exclusive: int = TRAIN_MIN_EXCLUSIVE,
                            fanout: int | None = None) -> DataFrame:
    """Add-on ingest: strip, keep length > 20, stop after ``cap`` *kept* rows."""
    out = (df.select("doc_id", "lang", strip("text").alias("text"))
           .where(F.length("text") > min_exclusive))
    if cap is not None:
        out = first_n_per_group(out, cap, "lang", "doc_id", fanout)
    return out


def kept_counts(df: DataFrame) -> DataFrame:
    """lang, kept (BIGINT): per-language kept-document counts."""
    return df.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))


def language_report(spark: SparkSession, df: DataFrame,
                    requested: list[str] | None = None) -> DataFrame:
    """Requested languages with their document counts; absent ones get 0 and
    ``present = false`` (the reference skips them with a warning)."""
    meta = langmeta.lang_meta_df(spark)
    if requested is not None:
        req = spark.createDataFrame([(c,) for c in requested], "lang_code string")
        meta = req.join(F.broadcast(meta), "lang_code", "left")
    counts = df.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    return (meta.join(counts, meta.lang_code == counts.lang, "left")
            .select("lang_code", "lang_name",
                    F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs"),
                    F.col("n_docs").isNotNull().alias("present")))


def select_subset(spark: SparkSession, df: DataFrame, subset: str = "verified") -> DataFrame:
    """Keep documents whose language is in the chosen subset (semi join to the
    broadcast language table: "verified" = all, "unverified" = 14 codes)."""
    meta = langmeta.lang_meta_df(spark).where(F.col(subset)).select(F.col("lang_code").alias("lang"))
    return df.join(F.broadcast(meta), "lang", "left_semi")


def text_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per line of each text (documents with newlines become several
    lines, as in a one-document-per-line file read with universal newlines);
    stripped, empty lines dropped."""
    return (df.select("doc_id", "lang",
                      F.posexplode(F.split(F.col(text_col), "\r\n|\r|\n")).alias("line_no", "line"))
            .select("doc_id", "lang", "line_no", strip("line").alias("line"))
            .where(F.length("line") > 0))
