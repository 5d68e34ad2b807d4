"""Tokenizer registry for corpus jobs.

SQL tokenizers (pure built-in expressions):

* ``whitespace`` -- whitespace words
* ``char``       -- every non-whitespace code point
* ``byte``       -- every UTF-8 byte of the non-whitespace text, as ``<0xHH>``
* ``script``     -- script-aware pre-tokens

None of them produces a token across whitespace, so the metric plan applies
them to distinct words only (see :mod:`tokscope.operators.metrics`).

The trained BPE model is applied through :mod:`tokscope.operators.encode`
(distinct words encoded once, joined back) and enters the same metric plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokscope.functions.pretok import PRETOKEN_RE, pretokens
from tokscope.functions.text import (COVERAGE_MARKERS, LENGTH_MARKERS, NON_WS, WS, WS_CHARS, WS_STRING,
                                     first_char, strip_length_markers, words)

def _rx_all(c: Column, pattern: str, idx: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(idx))


def _byte_tokens(c: Column) -> Column:
    packed = F.regexp_replace(c, f"{WS}+", "")
    hexed = F.hex(F.encode(packed, "UTF-8"))
    return F.transform(_rx_all(hexed, ".."), lambda x: F.concat(F.lit("<0x"), x, F.lit(">")))


@dataclass(frozen=True)
class SqlTokenizer:
    """``tokens`` works on any text; the ``word_*`` closed forms take ONE
    whitespace word and give what the metric plan needs without per-token
    lambdas (interpreted in Spark): number of tokens, summed marker-stripped
    token length, distinct first characters of the marker-cleaned tokens."""
    name: str
    tokens: Callable[[Column], Column]           # text -> ARRAY<STRING>
    pieces: Callable[[Column], Column]           # word -> BIGINT
    word_len_sum: Callable[[Column], Column]     # word -> BIGINT
    word_first_chars: Callable[[Column], Column]  # word -> ARRAY<STRING>


def _one(c: Column) -> Column:
    return F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))


def _len(c: Column) -> Column:
    return F.length(c).cast("bigint")


TOKENIZERS: dict[str, SqlTokenizer] = {
    "whitespace": SqlTokenizer(
        "whitespace", words, lambda w: F.lit(1).cast("bigint"),
        lambda w: _len(strip_length_markers(w)),
        lambda w: _one(first_char(w))),
    "char": SqlTokenizer(
        "char", lambda c: _rx_all(c, NON_WS), lambda w: _len(w),
        # a marker character is a whole token and strips to ''
        lambda w: _len(F.translate(w, LENGTH_MARKERS, "")),
        lambda w: F.array_remove(F.array_distinct(F.split(F.translate(w, WS_STRING + COVERAGE_MARKERS, ""), "")), "")),
    "byte": SqlTokenizer(
        "byte", _byte_tokens, lambda w: F.octet_length(w).cast("bigint"),
        # "<0xHH>" without its leading "<" has 5 characters
        lambda w: F.octet_length(w).cast("bigint") * 5,
        lambda w: _one(F.when(F.length(w) > 0, F.lit("<")))),
    "script": SqlTokenizer(
        "script", pretokens, lambda w: F.size(_rx_all(w, PRETOKEN_RE)).cast("bigint"),
        # marker characters are always single-character pre-tokens
        lambda w: _len(F.translate(w, LENGTH_MARKERS, "")),
        # first character of every pre-token that does not clean to ''
        lambda w: F.array_distinct(_rx_all(w, f"(?=([^{WS_CHARS}{COVERAGE_MARKERS}]))(?:{PRETOKEN_RE})", 1))),
}

SQL_MODELS = list(TOKENIZERS)


def tokens(model: str, text: Column) -> Column:
    return TOKENIZERS[model].tokens(text)
