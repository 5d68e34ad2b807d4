"""Language dimension tables: metadata, code-point ranges, derived-view alphabets.

All tables here are tiny and size-bounded (tens of rows, a few thousand code
points), built on the driver from fixed values or a rule, and broadcast.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: evaluated languages (code, name, script, lo, hi) ----------
LANG_META = [
    ("asm", "Assamese", "Assamese", 0x0980, 0x09FF),
    ("ben", "Bengali", "Bengali", 0x0980, 0x09FF),
    ("brx", "Bodo", "Devanagari", 0x0900, 0x097F),
    ("doi", "Dogri", "Devanagari", 0x0900, 0x097F),
    ("eng", "English", "Latin", 0x0041, 0x007A),
    ("gom", "Konkani", "Devanagari", 0x0900, 0x097F),
    ("guj", "Gujarati", "Gujarati", 0x0A80, 0x0AFF),
    ("hin", "Hindi", "Devanagari", 0x0900, 0x097F),
    ("kan", "Kannada", "Kannada", 0x0C80, 0x0CFF),
    ("kas", "Kashmiri", "Perso-Arabic", 0x0600, 0x06FF),
    ("mai", "Maithili", "Devanagari", 0x0900, 0x097F),
    ("mal", "Malayalam", "Malayalam", 0x0D00, 0x0D7F),
    ("mar", "Marathi", "Devanagari", 0x0900, 0x097F),
    ("mni", "Manipuri", "Bengali", 0x0980, 0x09FF),
    ("nep", "Nepali", "Devanagari", 0x0900, 0x097F),
    ("ori", "Odia", "Odia", 0x0B00, 0x0B7F),
    ("pan", "Punjabi", "Gurmukhi", 0x0A00, 0x0A7F),
    ("san", "Sanskrit", "Devanagari", 0x0900, 0x097F),
    ("sat", "Santali", "Ol Chiki", 0x1C50, 0x1C7F),
    ("snd", "Sindhi", "Perso-Arabic", 0x0600, 0x06FF),
    ("tam", "Tamil", "Tamil", 0x0B80, 0x0BFF),
    ("tel", "Telugu", "Telugu", 0x0C00, 0x0C7F),
    ("urd", "Urdu", "Perso-Arabic", 0x0600, 0x06FF),
]
# languages of the smaller ("unverified") subset
UNVERIFIED_CODES = ["asm", "ben", "guj", "hin", "kan", "mal", "mar", "nep",
                    "ori", "pan", "san", "tam", "tel", "urd"]
# ---------------------------------------------------------------------------

# Extra rows for the languages present in the driver's test corpus
# (ISO 639-1 codes, Latin script, same Latin range as English).
CORPUS_LANG_META = [
    ("en", "English", "Latin", 0x0041, 0x007A),
    ("de", "German", "Latin", 0x0041, 0x007A),
    ("es", "Spanish", "Latin", 0x0041, 0x007A),
    ("fr", "French", "Latin", 0x0041, 0x007A),
]

# Derived Indic view of the test corpus: lower-cased a..z mapped onto 26
# letters of a script block; the view relabels the language accordingly.
INDIC_VIEW_LANGS = {"de": ("ben", 0x0980), "es": ("tam", 0x0B80),
                    "fr": ("hin", 0x0900), "en": ("eng", None)}
LATIN_LOWER = "abcdefghijklmnopqrstuvwxyz"


def script_alphabet(block_start: int, n: int = 26) -> str:
    """Rule: the first ``n`` code points of category Lo in the 128-char block."""
    out = [chr(cp) for cp in range(block_start, block_start + 0x80)
           if unicodedata.category(chr(cp)) == "Lo"]
    return "".join(out[:n])


def all_lang_meta() -> list[tuple]:
    return LANG_META + CORPUS_LANG_META


def lang_meta_df(spark: SparkSession) -> DataFrame:
    """lang_code, lang_name, script, cp_lo, cp_hi, verified, unverified."""
    unv = set(UNVERIFIED_CODES)
    rows = [(c, n, s, lo, hi, True, c in unv) for c, n, s, lo, hi in all_lang_meta()]
    return spark.createDataFrame(
        rows, "lang_code string, lang_name string, script string, cp_lo int, cp_hi int, "
              "verified boolean, unverified boolean")


def assigned_intervals(lo: int, hi: int) -> list[tuple[int, int]]:
    """Rule: maximal runs of code points in [lo, hi] whose category is not Cn.

    Uses Python's ``unicodedata`` (not the JVM's older tables).
    """
    out: list[list[int]] = []
    for cp in range(lo, hi + 1):
        if unicodedata.category(chr(cp)) == "Cn":
            continue
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return [(a, b) for a, b in out]


def script_ranges() -> list[tuple[int, int]]:
    return sorted({(lo, hi) for _, _, _, lo, hi in all_lang_meta()})


def assigned_codepoints_df(spark: SparkSession) -> DataFrame:
    """cp_lo, cp_hi, cp INT, ch STRING for every assigned code point of every range.

    Bounded: at most the sum of the distinct range widths (< 2 000 rows).
    """
    rows = []
    for lo, hi in script_ranges():
        for a, b in assigned_intervals(lo, hi):
            for cp in range(a, b + 1):
                rows.append((lo, hi, cp, chr(cp)))
    return spark.createDataFrame(rows, "cp_lo int, cp_hi int, cp int, ch string")


def indic_text(c, lang_col):
    """translate(lower(text), a..z, <26 letters>) per language (en unchanged)."""
    expr = None
    for src, (_, start) in INDIC_VIEW_LANGS.items():
        if start is None:
            continue
        t = F.translate(F.lower(c), LATIN_LOWER, script_alphabet(start))
        cond = lang_col == src
        expr = F.when(cond, t) if expr is None else expr.when(cond, t)
    return expr.otherwise(c)


def indic_lang(lang_col):
    expr = None
    for src, (dst, _) in INDIC_VIEW_LANGS.items():
        cond = lang_col == src
        expr = F.when(cond, dst) if expr is None else expr.when(cond, dst)
    return expr.otherwise(lang_col)
