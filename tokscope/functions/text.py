"""Scalar text functions (Column -> Column), all JVM-side built-ins.

Regex strings are written once and used verbatim by Spark (Java regex) and by
the DuckDB oracle (RE2): only the ``\\x{hhhh}`` escape form and explicit
classes are used, because ``\\s`` and ``\\w`` differ between the two engines
and from Python's ``str.split``/``str.strip``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Unicode whitespace as Python's str.split()/str.strip() see it:
# TAB LF VT FF CR, FS GS RS US, SPACE, NEL, NBSP, OGHAM SPACE MARK,
# EN QUAD .. HAIR SPACE, LINE SEPARATOR, PARAGRAPH SEPARATOR,
# NARROW NBSP, MEDIUM MATHEMATICAL SPACE, IDEOGRAPHIC SPACE.
WS_CHARS = (r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{WS_CHARS}]"
# the same set as a plain string of characters (for trim)
WS_STRING = "".join(chr(c) for lo, hi in [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0),
                                          (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
                                          (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
                    for c in range(lo, hi + 1))
NON_WS = f"[^{WS_CHARS}]"
STRIP_RE = f"^{WS}+|{WS}+$"
WORD_RE = f"{NON_WS}+"

# Marker characters stripped from the left of vocabulary tokens.
COVERAGE_MARKERS = "▁Ġ#Ċ"          # for the first-character coverage test
LENGTH_MARKERS = "▁Ġ#Ċ<>[]"        # for the average token length
SPECIAL_TOKENS = ["[UNK]", "[PAD]", "[BOS]", "[EOS]"]
UNK_TOKEN = "[UNK]"

# Fertility bands.
GRADE_EXCELLENT, GRADE_GOOD, GRADE_MARGINAL, GRADE_POOR = (
    "Excellent", "Good", "Marginal", "Poor")
# Grade labels used by the per-model grade counts (comparison report).
GRADE_B_LABELS = ["Excellent (<1.5)", "Good (1.5-2.5)", "Marginal (2.5-4.0)", "Poor (>4.0)"]

EXAMPLE_MAX_CHARS = 120
PREVIEW_TOKENS = 30
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Unicode strip on both ends; null -> ''. Plain ``trim`` only removes
    U+0020, so the whitespace set is passed explicitly (codegen'd, no regex)."""
    return F.trim(F.coalesce(_c(c), F.lit("")), F.lit(WS_STRING))


def words(c) -> Column:
    """Whitespace words, empties dropped: ARRAY<STRING>."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_RE), F.lit(0))


def n_words(c) -> Column:
    return F.size(words(c)).cast("bigint")


def n_words_stripped(c) -> Column:
    """Word count of a text already stripped (no leading/trailing whitespace):
    a split on whitespace runs then yields exactly the words (no empties),
    about twice as cheap as extracting them; '' has none."""
    t = _c(c)
    return F.when(F.length(t) == 0, F.lit(0).cast("bigint")).otherwise(
        F.size(F.split(t, f"{WS}+")).cast("bigint"))


def n_bytes(c) -> Column:
    """UTF-8 byte length."""
    return F.octet_length(_c(c)).cast("bigint")


def n_chars(c) -> Column:
    """Code-point length."""
    return F.length(_c(c)).cast("bigint")


def truncate(c, max_chars: int | None) -> Column:
    """First ``max_chars`` code points (no-op for None)."""
    return _c(c) if max_chars is None else F.substring(_c(c), 1, max_chars)


def strip_coverage_markers(c) -> Column:
    """Left-strip any of the characters ``▁ Ġ # Ċ`` (a set, not prefixes)."""
    return F.ltrim(_c(c), F.lit(COVERAGE_MARKERS))


def strip_length_markers(c) -> Column:
    """Left-strip ``▁ Ġ # Ċ < > [ ]`` (so ``[UNK]`` -> ``UNK]``)."""
    return F.ltrim(_c(c), F.lit(LENGTH_MARKERS))


def first_char(c) -> Column:
    """First code point of the coverage-cleaned token; NULL when it cleans to ''."""
    cleaned = strip_coverage_markers(c)
    return F.when(F.length(cleaned) > 0, F.substring(cleaned, 1, 1))


def grade_eval(c) -> Column:
    """Evaluation bands [1,1.5) [1.5,2.5) [2.5,4) [4,999); everything else Poor."""
    f = _c(c)
    return (F.when((f >= 1.0) & (f < 1.5), GRADE_EXCELLENT)
            .when((f >= 1.5) & (f < 2.5), GRADE_GOOD)
            .when((f >= 2.5) & (f < 4.0), GRADE_MARGINAL)
            .otherwise(GRADE_POOR))


def grade_train(c) -> Column:
    """Training/comparison bands: <1.5 Excellent (also <1), <2.5, <4, else Poor."""
    f = _c(c)
    return (F.when(f < 1.5, GRADE_EXCELLENT).when(f < 2.5, GRADE_GOOD)
            .when(f < 4.0, GRADE_MARGINAL).otherwise(GRADE_POOR))


def grade_train_label(c) -> Column:
    """Grade B with the band labels of the comparison report."""
    f = _c(c)
    e, g, m, p = GRADE_B_LABELS
    return F.when(f < 1.5, e).when(f < 2.5, g).when(f < 4.0, m).otherwise(p)


def length_bucket(c) -> Column:
    """<=2 short, 3..6 medium, >6 long (code points)."""
    n = F.length(_c(c))
    return F.when(n <= 2, "short").when(n <= 6, "medium").otherwise("long")


def is_mixed_script(c) -> Column:
    """Contains a Latin-script letter and a code point in U+0900..U+0D7F."""
    return _c(c).rlike(r"\p{IsLatin}") & _c(c).rlike(r"[\x{0900}-\x{0D7F}]")


def example_sentence(c, max_chars: int = EXAMPLE_MAX_CHARS) -> Column:
    """First ``max_chars`` code points with only ``\\n`` replaced by a space."""
    return F.replace(F.substring(_c(c), 1, max_chars), F.lit("\n"), F.lit(" "))


def token_preview(tokens, k: int = PREVIEW_TOKENS) -> Column:
    """First k tokens joined by `` | `` plus `` ... (+n more)`` when cut."""
    t = _c(tokens)
    head = F.array_join(F.slice(t, 1, k), " | ")
    more = F.concat(F.lit(" ... (+"), (F.size(t) - k).cast("string"), F.lit(" more)"))
    return F.when(F.size(t) > k, F.concat(head, more)).otherwise(head)


def safe_div(num, den) -> Column:
    """num/den as DOUBLE, 0.0 when den is 0 or NULL."""
    n, d = _c(num), _c(den)
    return F.when(F.coalesce(d, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        n.cast("double") / d.cast("double"))
