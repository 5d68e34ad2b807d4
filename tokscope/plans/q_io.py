"""Sink/source round trips: what is written is read back by the matching
source and must equal the SQL of the source table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokscope.functions import text
from tokscope.operators import metrics, vocab
from tokscope.operators.tokenizers import SQL_MODELS
from tokscope.plans import q_corpus, q_vocab
from tokscope.plans.catalog import register
from tokscope.plans.oracle import ORACLE, clean_sql, docs_sql, model_sql, q, strip_sql
from tokscope.plans.q_compare import R_SQL, results_table
from tokscope.session import scratch_path
from tokscope.sinks import files
from tokscope.sources import corpus, results as rsrc


@register("train_text_roundtrip")
def q_train_text(spark, sf_dir):
    """Training file: capped ingest of the non-English languages written one
    document per line, the English add-on appended; read back as lines
    (stripped, empties dropped) and counted per language."""
    docs = corpus.documents(spark, sf_dir, indic=True)
    path = scratch_path(spark, "train-text")
    files.write_text_lines(corpus.ingest_cap_before_filter(docs.where(F.col("lang") != "eng")), path)
    files.write_text_lines(corpus.ingest_cap_after_filter(docs.where(F.col("lang") == "eng")), path, mode="append")
    lines = rsrc.read_text_lines(spark, path).select("lang", text.strip("line").alias("line"))
    return (lines.where(F.length("line") > 0).groupBy("lang")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_lines"),
                 F.sum(F.length("line")).cast("bigint").alias("n_chars")))


ORACLE["train_text_roundtrip"] = f"""
WITH d AS (SELECT doc_id, lang, {strip_sql('text')} AS t FROM ({docs_sql(indic=True)})),
k AS (SELECT lang, t FROM d WHERE length(t) > 20),
l AS (SELECT lang, {strip_sql('unnest(regexp_split_to_array(t, ' + q(chr(13) + chr(10) + '|' + chr(13) + '|' + chr(10)) + '))')} AS line FROM k)
SELECT lang, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM l WHERE length(line) > 0 GROUP BY lang
"""


@register("fertility_json_roundtrip")
def q_fertility_json(spark, sf_dir):
    path = scratch_path(spark, "fertility-json")
    files.write_fertility_json(q_corpus._fertility_record(spark, sf_dir), path)
    back = spark.read.schema("lang string, fertility double, total_words long, total_tokens long, docs long").json(path)
    return back.withColumn("rating", text.grade_train("fertility"))


ORACLE["fertility_json_roundtrip"] = q_corpus._FERT_SQL


@register("novel_json_roundtrip")
def q_novel_json(spark, sf_dir):
    nov = vocab.novel_tokens(q_vocab.new_vocab(spark, sf_dir), q_vocab.base_vocab(spark, sf_dir))
    path = scratch_path(spark, "novel-json")
    files.write_token_list_json(nov, path)
    return rsrc.read_token_list_json(spark, path)


ORACLE["novel_json_roundtrip"] = f"""
SELECT token FROM ({q_vocab.NEW_BODY_SQL}) EXCEPT SELECT token FROM ({q_vocab.BASE_SQL})
"""


@register("vocab_table_roundtrip")
def q_vocab_table(spark, sf_dir):
    """Extended vocabulary saved as a table and read back."""
    base = q_vocab.base_vocab(spark, sf_dir)
    ext = vocab.extend_vocab(base.select("token", "id"), vocab.novel_tokens(q_vocab.new_vocab(spark, sf_dir), base))
    path = scratch_path(spark, "vocab-table")
    files.write_table(ext, path)
    return spark.read.parquet(path)


@register("results_json_roundtrip")
def q_results_json(spark, sf_dir):
    """Result rows with two examples per language (tokens cut to 20), written
    as JSON and read back."""
    res = results_table(spark, sf_dir)
    s = corpus.sample_eval(corpus.documents(spark, sf_dir), n=None, max_chars=None)
    ex = None
    for m in SQL_MODELS:
        e = _examples_tokens(spark, s, m)
        ex = e if ex is None else ex.unionByName(e)
    path = scratch_path(spark, "results-json")
    files.write_results_json(res, ex, path)
    back = spark.read.json(path)
    first = F.element_at("examples", 1)
    return back.select("model", "lang_code", "fertility", F.size("examples").cast("bigint").alias("n_examples"),
                       first["text"].alias("example_text"),
                       F.array_join(first["tokens"], " ").alias("example_tokens"))


def _examples_tokens(spark, sample, model):
    from tokscope.operators.tokenizers import TOKENIZERS
    firsts = corpus.first_n_per_group(sample, metrics.EXAMPLES_PER_LANG, "lang", "doc_id")
    sent = text.example_sentence(F.col("text"))
    return firsts.select(F.lit(model).alias("model"), F.col("lang").alias("lang_code"), "doc_id",
                         sent.alias("sentence"), TOKENIZERS[model].tokens(sent).alias("tokens"))


def _results_json_sql() -> str:
    branches = []
    for m, (tok, _) in model_sql().items():
        branches.append(f"SELECT {q(m)} AS model, lang AS lang_code, doc_id, sentence, "
                        f"{tok.replace('text', 'sentence')} AS toks FROM e")
    return f"""
WITH e AS (SELECT doc_id, lang, replace(substring(text, 1, 120), chr(10), ' ') AS sentence
           FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM ({clean_sql()}))
           WHERE rn <= 2),
x AS ({" UNION ALL ".join(branches)}),
f AS (SELECT model, lang_code, count(*) AS n, arg_min(sentence, doc_id) AS s, arg_min(toks, doc_id) AS t
      FROM x GROUP BY model, lang_code),
r AS ({R_SQL})
SELECT r.model, r.lang_code, r.fertility, CAST(coalesce(f.n, 0) AS BIGINT) AS n_examples, f.s AS example_text,
       array_to_string(list_slice(f.t, 1, 20), ' ') AS example_tokens
FROM r LEFT JOIN f ON r.model = f.model AND r.lang_code = f.lang_code
"""


ORACLE["results_json_roundtrip"] = _results_json_sql()
ORACLE["vocab_table_roundtrip"] = ORACLE["vocab_extend"]


@register("merged_results_csv")
def q_merged_results(spark, sf_dir):
    """All models' result rows written as one merged CSV table and read back."""
    path = scratch_path(spark, "merged-results")
    results_table(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return spark.read.schema(rsrc.RESULTS_SCHEMA).option("header", True).csv(path)


ORACLE["merged_results_csv"] = R_SQL


@register("processed_text_roundtrip")
def q_processed_text(spark, sf_dir):
    """Pre-tokenized training lines written as a text file and read back."""
    from tokscope.plans.q_corpus import q_processed_lines
    path = scratch_path(spark, "processed-text")
    files.write_text_lines(q_processed_lines(spark, sf_dir), path, col="processed", partition_by=None)
    back = rsrc.read_text_lines(spark, path)
    return back.groupBy(F.col("line").alias("processed")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


ORACLE["processed_text_roundtrip"] = (
    "SELECT processed, CAST(count(*) AS BIGINT) AS n FROM (" + __import__("tokscope.plans.oracle", fromlist=["ORACLE"]).ORACLE["processed_lines"]
    + ") GROUP BY processed")
