"""Script-aware pre-tokenization (ordered alternation, first match wins).

Semantics: scan left to right; at each position try the alternatives in order
and take the first that matches; pure-whitespace matches are dropped. The
Spark form drops the whitespace alternative and replaces the final "any
character" branch by "any non-whitespace character": matching then skips
whitespace positions by itself, which yields exactly the same tokens (a
whitespace character can only ever be consumed by the whitespace branch) and
needs no filter. Tokens never span whitespace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokscope.functions.text import NON_WS, WS, WS_CHARS, WS_STRING

# --- fixed values: script blocks in match order (name, character class) -----
SCRIPT_BLOCKS = [
    ("Devanagari", r"\x{0900}-\x{097F}\x{1CD0}-\x{1CFF}\x{A8E0}-\x{A8FF}"),
    ("Bengali", r"\x{0980}-\x{09FF}"),
    ("Gurmukhi", r"\x{0A00}-\x{0A7F}"),
    ("Gujarati", r"\x{0A80}-\x{0AFF}"),
    ("Odia", r"\x{0B00}-\x{0B7F}"),
    ("Tamil", r"\x{0B80}-\x{0BFF}"),
    ("Telugu", r"\x{0C00}-\x{0C7F}"),
    ("Kannada", r"\x{0C80}-\x{0CFF}"),
    ("Malayalam", r"\x{0D00}-\x{0D7F}"),
    ("Ol Chiki", r"\x{1C50}-\x{1C7F}"),
    ("Arabic", r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}"),
    ("Latin", r"a-zA-Z"),
]
NUMBER_RE = r"[0-9]+(?:[.,][0-9]+)*"
# ---------------------------------------------------------------------------

_SCRIPT_ALTS = [f"[{cls}]+" for _, cls in SCRIPT_BLOCKS]

#: pattern producing the kept (non-whitespace) pre-tokens directly
PRETOKEN_RE = "|".join(_SCRIPT_ALTS + [NUMBER_RE, NON_WS])
#: full pattern including the whitespace alternative (for spans)
PRETOKEN_SPAN_RE = "|".join(_SCRIPT_ALTS + [NUMBER_RE, f"{WS}+", "(?s:.)"])

#: second split applied inside the BPE model on the space-joined pre-tokens:
#: runs of letters/marks/numbers/connectors, or runs of other non-space chars
WORD_CLASS = r"\p{L}\p{M}\p{N}\p{Pc}"
MODEL_SPLIT_RE = f"[{WORD_CLASS}]+|[^{WORD_CLASS}{WS_CHARS}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pretokens(c) -> Column:
    """ARRAY<STRING> of script-aware pre-tokens."""
    return F.regexp_extract_all(_c(c), F.lit(PRETOKEN_RE), F.lit(0))


def pretokenized_text(c) -> Column:
    """Pre-tokens joined by one space (the processed training line)."""
    return F.array_join(pretokens(c), " ")


def model_split(c) -> Column:
    """Second whitespace-style split of a (space-joined) pre-tokenized text."""
    return F.regexp_extract_all(_c(c), F.lit(MODEL_SPLIT_RE), F.lit(0))


def script_class(c) -> Column:
    """Which alternative produced a pre-token: a script name, Digits or Other."""
    tok = _c(c)
    expr = None
    for name, cls in SCRIPT_BLOCKS:
        cond = tok.rlike(f"^[{cls}]")
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.when(tok.rlike("^[0-9]"), "Digits").otherwise("Other")


SPAN_CHUNK = 1_024      # tokens of a text that are cut further together


def _blocks(df: DataFrame, id_col: str, size: int) -> DataFrame:
    """Rows (id, pos, before, parts) cut into rows of ``size`` parts at most: ``pos`` and ``before``, the parts and code points before
    them in the text, are carried on by the totals of the blocks."""
    n = F.floor(F.greatest(F.size("parts") - 1, F.lit(0)) / size).cast("int")
    cut = df.select(id_col, "pos", "before", F.transform(F.sequence(F.lit(0), n), lambda k: F.slice("parts", k * size + 1, F.lit(size))).alias("blocks"))
    cut = cut.select("*", F.transform("blocks", lambda x: F.length(F.array_join(x, "")).cast("bigint")).alias("lengths"))
    placed = F.transform("blocks", lambda x, k: F.struct((F.col("pos") + k * size).alias("pos"), _sum_of_first(F.col("lengths"), k, F.col("before")).alias("before"), x.alias("parts")))
    return cut.select(id_col, F.inline(placed))


def _sum_of_first(lengths: Column, k: Column, start: Column) -> Column:
    return F.aggregate(F.slice(lengths, F.lit(1), k), start, lambda a, x: a + x)


def pretoken_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int | None = None) -> DataFrame:
    """doc_id, pos, token, span_start, span_end (code points, end exclusive).

    Tokens with the white space before them tile a text, so a token ends where the lengths up to it end. That running sum is taken by
    column expressions where the text is read: a text's tokens are cut into blocks three times (64 ``chunk``, ``chunk``, 1/64 ``chunk``), each
    block starts where the totals of those before it end, and only the smallest blocks are summed token by token. So the cost of a
    token does not grow with its text, and nothing is written, shuffled, sorted or leaves the JVM.
    """
    chunk = chunk or SPAN_CHUNK
    text = F.rtrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(WS_STRING))      # white space at the end belongs to no token
    zero = F.lit(0).cast("bigint")
    rows = df.select(F.col(id_col).cast("bigint").alias(id_col), zero.alias("pos"), zero.alias("before"),
                     F.regexp_extract_all(text, F.lit(f"{WS}*+(?:{PRETOKEN_RE})"), F.lit(0)).alias("parts"))
    for size in (64 * chunk, chunk, max(1, chunk // 64)):
        rows = _blocks(rows, id_col, size)
    rows = rows.select("*", F.transform("parts", lambda x: F.length(x).cast("bigint")).alias("lengths"))
    placed = F.transform("parts", lambda x, i: F.struct((F.col("pos") + i).alias("pos"), F.ltrim(x, F.lit(WS_STRING)).alias("token"),
                                                        _sum_of_first(F.col("lengths"), i + 1, F.col("before")).alias("span_end")))
    out = rows.select(id_col, F.inline(placed))
    return out.select(id_col, "pos", "token", (F.col("span_end") - F.length("token")).alias("span_start"), "span_end")
