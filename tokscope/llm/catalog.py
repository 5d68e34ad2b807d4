"""Registered queries of the operators: thin wrappers over whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tokscope.llm import chat_snapshots, codes, collisions, langid, licenses, lm, mixing, ngram_join, packing, quality, resampling, segments, simhash
from tokscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    def on(fn, *names: str) -> Query:
        return lambda spark, sf_dir: fn(*(table(spark, sf_dir, n) for n in names))

    return {
        "op1_langid": on(langid.op1_langid, "documents"),
        "op2_lm": on(lm.op2_lm, "documents"),
        "op3_mixing": on(mixing.op3_mixing, "documents"),
        "op4_ann": on(collisions.op4_ann, "embeddings"),
        "op5_packing": on(packing.op5_packing, "documents"),
        "op6_chat": on(chat_snapshots.op6_chat, "conversations"),
        "op7_simhash": on(simhash.op7_simhash, "documents"),
        "op8_licenses": on(licenses.op8_licenses, "documents"),
        "op9_quality": on(quality.op9_quality, "documents", "labels"),
        "op10_topk": on(segments.op10_topk, "embeddings"),
        "op11_ngram_join": on(ngram_join.op11_ngram_join, "documents"),
        "op12_resampling": on(resampling.op12_resampling, "documents", "benchmark"),
        "op13_codes": on(codes.op13_codes, "embeddings"),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    out = {"op3_mixing": mixing.ORACLE_SQL, "op6_chat": chat_snapshots.ORACLE_SQL, "op10_topk": segments.ORACLE_SQL,
           "op11_ngram_join": ngram_join.ORACLE_SQL, "op12_resampling": resampling.ORACLE_SQL, "op13_codes": codes.ORACLE_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: v for k, v in out.items() if v}
