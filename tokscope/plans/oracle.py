"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans (plain SQL over the pre-registered
views), sharing only the fixed values (regex strings, language table,
code-point rule). DuckDB lambdas use the ``lambda x: ...`` form; DuckDB's
``ltrim(str, chars)`` takes its arguments in the opposite order to Spark's.
"""

from __future__ import annotations

from tokscope.functions import langmeta, pretok, text

ORACLE: dict[str, str] = {}

WS = text.WS
NON_WS = text.NON_WS
STRIP = text.STRIP_RE
WORD = text.WORD_RE
PRETOK = pretok.PRETOKEN_RE
LEN_MARKERS = text.LENGTH_MARKERS
COV_MARKERS = text.COVERAGE_MARKERS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def grade_eval_sql(f: str) -> str:
    return (f"CASE WHEN {f} >= 1.0 AND {f} < 1.5 THEN 'Excellent' "
            f"WHEN {f} >= 1.5 AND {f} < 2.5 THEN 'Good' "
            f"WHEN {f} >= 2.5 AND {f} < 4.0 THEN 'Marginal' ELSE 'Poor' END")


def grade_train_sql(f: str) -> str:
    return (f"CASE WHEN {f} < 1.5 THEN 'Excellent' WHEN {f} < 2.5 THEN 'Good' "
            f"WHEN {f} < 4.0 THEN 'Marginal' ELSE 'Poor' END")


def div(a: str, b: str) -> str:
    return f"CASE WHEN coalesce({b}, 0) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def strip_sql(col: str) -> str:
    return f"regexp_replace(coalesce({col}, ''), {q(STRIP)}, '', 'g')"


def translate_sql(col: str, lang_col: str, n: int = 26) -> str:
    parts = []
    for src, (_, start) in langmeta.INDIC_VIEW_LANGS.items():
        if start is None:
            continue
        parts.append(f"WHEN {lang_col} = {q(src)} THEN translate(lower({col}), "
                     f"{q(langmeta.LATIN_LOWER[:n])}, {q(langmeta.script_alphabet(start)[:n])})")
    return "CASE " + " ".join(parts) + f" ELSE {col} END"


def indic_lang_sql(lang_col: str) -> str:
    parts = [f"WHEN {lang_col} = {q(src)} THEN {q(dst)}"
             for src, (dst, _) in langmeta.INDIC_VIEW_LANGS.items()]
    return "CASE " + " ".join(parts) + f" ELSE {lang_col} END"


def docs_sql(indic: bool = False, mixed: bool = False) -> str:
    if indic or mixed:
        n = 13 if mixed else 26
        return (f"SELECT doc_id, {indic_lang_sql('lang')} AS lang, "
                f"{translate_sql('text', 'lang', n)} AS text FROM documents")
    return "SELECT doc_id, lang, text FROM documents"


def clean_sql(indic: bool = False, min_chars: int = 10, max_chars: int | None = None,
              mixed: bool = False) -> str:
    t = "text" if max_chars is None else f"substring(text, 1, {max_chars})"
    return (f"SELECT doc_id, lang, {t} AS text FROM (SELECT doc_id, lang, {strip_sql('text')} AS text "
            f"FROM ({docs_sql(indic, mixed)})) WHERE length(text) >= {min_chars}")


def lang_meta_values() -> str:
    rows = ", ".join(f"({q(c)}, {q(n)}, {q(s)}, {lo}, {hi})"
                     for c, n, s, lo, hi in langmeta.all_lang_meta())
    return f"(VALUES {rows}) AS lm(lang_code, lang_name, script, cp_lo, cp_hi)"


def assigned_cp_sql() -> str:
    """(cp_lo, cp_hi, ch) for every assigned code point of every range."""
    rows = []
    for lo, hi in langmeta.script_ranges():
        for a, b in langmeta.assigned_intervals(lo, hi):
            rows.append(f"({lo}, {hi}, {a}, {b})")
    return (f"SELECT r.cp_lo, r.cp_hi, chr(CAST(g.cp AS INTEGER)) AS ch FROM (VALUES {', '.join(rows)}) "
            f"AS r(cp_lo, cp_hi, a, b), LATERAL (SELECT unnest(range(r.a, r.b + 1)) AS cp) g")


# ---------------------------------------------------------------------------
ORACLE["fertility_by_lang"] = f"""
WITH s AS ({clean_sql()}),
d AS (SELECT lang,
        CAST(len(regexp_extract_all(text, {q(WORD)})) AS BIGINT) AS w,
        CAST(len(regexp_extract_all(text, {q(PRETOK)})) AS BIGINT) AS t,
        CAST(strlen(text) AS BIGINT) AS b, CAST(length(text) AS BIGINT) AS c FROM s),
a AS (SELECT lang, CAST(count(*) AS BIGINT) AS docs, CAST(sum(w) AS BIGINT) AS words,
        CAST(sum(t) AS BIGINT) AS tokens, CAST(sum(b) AS BIGINT) AS bytes,
        CAST(sum(c) AS BIGINT) AS chars FROM d GROUP BY lang)
SELECT *, {div('tokens', 'words')} AS fertility, {div('bytes', 'tokens')} AS bytes_per_token,
       {grade_eval_sql(div('tokens', 'words'))} AS grade FROM a
"""


# --- SQL tokenizers: (tokens expression over `text`, pieces over `w`) -------
def model_sql() -> dict[str, tuple[str, str]]:
    return {
        "whitespace": (f"regexp_extract_all(text, {q(WORD)})", "1"),
        "char": (f"regexp_extract_all(text, {q(NON_WS)})", "length(w)"),
        "byte": (f"list_transform(regexp_extract_all(hex(regexp_replace(text, {q(WS + '+')}, '', 'g')), '..'), "
                 f"lambda x: '<0x' || x || '>')", "strlen(w)"),
        "script": (f"regexp_extract_all(text, {q(PRETOK)})",
                   f"len(regexp_extract_all(w, {q(PRETOK)}))"),
    }


def evaluate_sql(indic: bool = False, ref: str = "script", n: int | None = None,
                 max_chars: int | None = None, cont_docs: int | None = None) -> str:
    models = model_sql()
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn "
              f"FROM ({clean_sql(indic, max_chars=max_chars)})")
    sample = ranked if n is None else f"SELECT * FROM ({ranked}) WHERE rn <= {n}"
    in_cont = "true" if cont_docs is None else f"rn <= {cont_docs}"
    branches = []
    for m, (tok, pieces) in models.items():
        branches.append(f"""SELECT {q(m)} AS model, doc_id, lang, n_words, n_bytes, n_ref_tok, toks,
              CASE WHEN in_cont THEN CAST(len(list_filter(ws, lambda w: {pieces} > 1)) AS BIGINT) ELSE 0 END AS cont_split,
              CASE WHEN in_cont THEN n_words ELSE 0 END AS cont_words
            FROM (SELECT *, {tok} AS toks FROM d)""")
    union = "\nUNION ALL\n".join(branches)
    return f"""
WITH s AS ({sample}),
d AS (SELECT doc_id, lang, text, {in_cont} AS in_cont, regexp_extract_all(text, {q(WORD)}) AS ws,
        CAST(len(regexp_extract_all(text, {q(WORD)})) AS BIGINT) AS n_words,
        CAST(strlen(text) AS BIGINT) AS n_bytes,
        CAST(len({models[ref][0]}) AS BIGINT) AS n_ref_tok FROM s),
m AS ({union}),
c AS (SELECT model, lang, n_words, n_bytes, n_ref_tok, cont_split, cont_words,
        CAST(len(toks) AS BIGINT) AS n_tok,
        CAST(coalesce(list_sum(list_transform(toks, lambda x: length(ltrim(x, {q(LEN_MARKERS)})))), 0) AS BIGINT) AS len_sum
      FROM m),
a AS (SELECT model, lang, CAST(count(*) AS BIGINT) AS n_docs,
        CAST(sum(n_words) AS BIGINT) AS n_words, CAST(sum(n_tok) AS BIGINT) AS n_tokens,
        CAST(sum(n_bytes) AS BIGINT) AS n_bytes, CAST(sum(n_ref_tok) AS BIGINT) AS n_ref,
        CAST(sum(len_sum) AS BIGINT) AS len_sum, CAST(sum(cont_split) AS BIGINT) AS cont_split,
        CAST(sum(cont_words) AS BIGINT) AS cont_words
      FROM c GROUP BY model, lang),
fc AS (SELECT DISTINCT model, substring(ltrim(tok, {q(COV_MARKERS)}), 1, 1) AS ch
       FROM (SELECT model, unnest(toks) AS tok FROM m) WHERE length(ltrim(tok, {q(COV_MARKERS)})) > 0),
lm AS (SELECT * FROM {lang_meta_values()}),
cps AS ({assigned_cp_sql()}),
lcp AS (SELECT lm.lang_code, cps.ch FROM lm JOIN cps ON lm.cp_lo = cps.cp_lo AND lm.cp_hi = cps.cp_hi),
asg AS (SELECT lang_code, count(*) AS n_assigned FROM lcp GROUP BY lang_code),
cov AS (SELECT fc.model, lcp.lang_code, count(*) AS n_covered FROM fc JOIN lcp ON fc.ch = lcp.ch
        GROUP BY fc.model, lcp.lang_code),
covr AS (SELECT cov.model, cov.lang_code, {div('n_covered', 'n_assigned')} AS vocab_coverage
         FROM cov JOIN asg USING (lang_code))
SELECT a.lang AS lang_code, coalesce(lm.lang_name, a.lang) AS lang_name,
       coalesce(lm.script, 'Unknown') AS script, a.n_docs, a.n_words, a.n_tokens,
       {div('a.n_tokens', 'a.n_words')} AS fertility,
       {div('a.cont_split', 'a.cont_words')} AS continuation_rate,
       {div('a.n_bytes', 'a.n_tokens')} AS bytes_per_token,
       CAST(0.0 AS DOUBLE) AS unk_rate,
       CAST(coalesce(covr.vocab_coverage, 0.0) AS DOUBLE) AS vocab_coverage,
       {div('a.n_tokens', 'a.n_ref')} AS nsl,
       {div('a.len_sum', 'a.n_tokens')} AS avg_token_len,
       {grade_eval_sql(div('a.n_tokens', 'a.n_words'))} AS grade,
       a.model
FROM a LEFT JOIN lm ON a.lang = lm.lang_code
LEFT JOIN covr ON covr.model = a.model AND covr.lang_code = a.lang
"""


ORACLE["evaluate"] = evaluate_sql()
ORACLE["evaluate_indic"] = evaluate_sql(indic=True)


def oracle_sql() -> dict[str, str]:
    import tokscope.plans.catalog  # noqa: F401  (registers every query group)
    return {k: v for k, v in ORACLE.items() if v}
