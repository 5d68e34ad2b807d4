"""Streaming queries: run the stream over the given documents to completion
(available-now trigger) and return the sink table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokscope.plans.catalog import register
from tokscope.plans.oracle import ORACLE, PRETOK, WORD, div, q, strip_sql
from tokscope.session import scratch_path
from tokscope.streaming import caps, frequencies
from tokscope.streaming import corpus_stream as cs


def _src(sf_dir: str) -> str:
    """The documents file as a glob (a file stream source watches a directory;
    the glob selects the table's file(s) inside the data directory)."""
    return f"{sf_dir.rstrip('/')}/documents.parquet*"


def _spread(spark) -> int:
    # the given table is one file: spread each micro-batch over the cores
    return spark.sparkContext.defaultParallelism


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Incremental ingest: cleaned, pre-tokenized documents appended to a table."""
    out, ck = scratch_path(spark, "stream-ingest"), scratch_path(spark, "stream-ingest-ck")
    cs.append_to_table(cs.cleaned_stream(cs.read_documents_stream(spark, _src(sf_dir), spread=_spread(spark))), out, ck)
    return spark.read.parquet(out).select("doc_id", "lang", F.md5("text").alias("text_md5"), "processed")


ORACLE["stream_ingest"] = f"""
SELECT doc_id, lang, md5(t) AS text_md5, array_to_string(regexp_extract_all(t, {q(PRETOK)}), ' ') AS processed
FROM (SELECT doc_id, lang, {strip_sql('text')} AS t FROM documents) WHERE length(t) > 20
"""


@register("stream_running_stats")
def q_stream_running_stats(spark, sf_dir):
    """Running per-language docs/words/tokens/bytes with derived fertility."""
    out, ck = scratch_path(spark, "stream-stats"), scratch_path(spark, "stream-stats-ck")
    stream = cs.cleaned_stream(cs.read_documents_stream(spark, _src(sf_dir), max_files_per_trigger=1,
                                              spread=_spread(spark)))
    cs.complete_to_table(cs.running_stats(stream), out, ck)
    return cs.with_ratios(cs.latest_table(spark, out))


ORACLE["stream_running_stats"] = f"""
SELECT *, {div('tokens', 'words')} AS fertility, {div('bytes', 'tokens')} AS bytes_per_token FROM (
SELECT lang, CAST(count(*) AS BIGINT) AS docs,
       CAST(sum(len(regexp_extract_all(t, {q(WORD)}))) AS BIGINT) AS words,
       CAST(sum(len(regexp_extract_all(t, {q(PRETOK)}))) AS BIGINT) AS tokens,
       CAST(sum(strlen(t)) AS BIGINT) AS bytes
FROM (SELECT lang, {strip_sql('text')} AS t FROM documents) WHERE length(t) > 20 GROUP BY lang)
"""


STREAM_CAP = 100        # the cap is the feature: documents a language


@register("stream_capped")
def q_stream_capped(spark, sf_dir):
    """Training ingest with a cap per language on a stream: the first documents by id, then stripped and long enough."""
    out, ck = scratch_path(spark, "stream-capped"), scratch_path(spark, "stream-capped-ck")
    caps.ingest_capped(cs.read_documents_stream(spark, _src(sf_dir)), out, ck, STREAM_CAP)
    return caps.kept(spark, out).select("doc_id", "lang", F.md5("text").alias("text_md5"))


ORACLE["stream_capped"] = f"""
SELECT doc_id, lang, md5(t) AS text_md5 FROM (SELECT doc_id, lang, {strip_sql('text')} AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)
WHERE rn <= {STREAM_CAP} AND length(t) > 20
"""


@register("stream_pretoken_freq")
def q_stream_pretoken_freq(spark, sf_dir):
    """The frequency table that a stream of cleaned documents keeps up to date."""
    out, ck = scratch_path(spark, "stream-freq"), scratch_path(spark, "stream-freq-ck")
    frequencies.keep_up_to_date(cs.cleaned_stream(cs.read_documents_stream(spark, _src(sf_dir), spread=_spread(spark))).select("text"), out, ck)
    return frequencies.table(spark, out)


ORACLE["stream_pretoken_freq"] = f"""
SELECT token, CAST(count(*) AS BIGINT) AS freq FROM (SELECT unnest(regexp_extract_all(t, {q(PRETOK)})) AS token
  FROM (SELECT {strip_sql('text')} AS t FROM documents) WHERE length(t) > 20) GROUP BY token
"""
