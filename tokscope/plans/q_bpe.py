"""BPE queries: the trainer's word table, first-round pair counts (SQL
oracle), and the trained model's merges, vocabulary, encodings and metrics
(iterative: no SQL oracle; checked against one-at-a-time Python BPE in
tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokscope.functions import pretok, text
from tokscope.operators import bpe, encode, metrics, store, vocab
from tokscope.operators.tokenizers import SQL_MODELS, TOKENIZERS
from tokscope.plans import evaluation, training
from tokscope.session import materialised
from tokscope.plans.catalog import register
from tokscope.plans.oracle import COV_MARKERS, LEN_MARKERS, ORACLE, PRETOK, div, docs_sql, evaluate_sql, grade_eval_sql, q, strip_sql
from tokscope.plans.q_vocab import base_vocab
from tokscope.sources import corpus


@register("bpe_words")
def q_bpe_words(spark, sf_dir):
    """Trainer input: pre-tokens split into model words, with frequencies."""
    return training.training_words(spark, sf_dir)


_WORDS_SQL = f"""
WITH d AS (SELECT {strip_sql('text')} AS t FROM ({docs_sql(indic=True)})),
p AS (SELECT unnest(regexp_extract_all(t, {q(PRETOK)})) AS pt FROM d WHERE length(t) > 20)
SELECT word, CAST(count(*) AS BIGINT) AS freq
FROM (SELECT unnest(regexp_extract_all(pt, {q(pretok.MODEL_SPLIT_RE)})) AS word FROM p) GROUP BY word
"""
ORACLE["bpe_words"] = _WORDS_SQL


@register("bpe_pair_counts")
def q_bpe_pair_counts(spark, sf_dir):
    """First training round: adjacent code-point pairs weighted by word
    frequency, pairs reaching the minimum frequency."""
    st = bpe.initial_state(training.training_words(spark, sf_dir))
    return bpe.pair_counts(st).where(F.col("cnt") >= bpe.MIN_FREQUENCY)


ORACLE["bpe_pair_counts"] = f"""
WITH w AS ({_WORDS_SQL}),
s AS (SELECT freq, regexp_extract_all(word, '(?s).') AS syms FROM w),
p AS (SELECT freq, syms[i] AS l, syms[i + 1] AS r
      FROM (SELECT freq, syms, unnest(generate_series(1, len(syms) - 1)) AS i FROM s WHERE len(syms) > 1))
SELECT l, r, CAST(sum(freq) AS BIGINT) AS cnt FROM p GROUP BY l, r HAVING sum(freq) >= {bpe.MIN_FREQUENCY}
"""


@register("bpe_merges")
def q_bpe_merges(spark, sf_dir):
    """Merge table (rank, left, right, merged, count) of the trained model."""
    return training.trained_model(spark, sf_dir).merges


@register("bpe_vocab")
def q_bpe_vocab(spark, sf_dir):
    return training.trained_model(spark, sf_dir).vocab


@register("bpe_encode_docs")
def q_bpe_encode_docs(spark, sf_dir):
    """Per document: words, BPE tokens of the pre-tokenized text, unknowns."""
    m = training.trained_model(spark, sf_dir)
    docs = corpus.sample_eval(corpus.documents(spark, sf_dir, indic=True), n=None, max_chars=None)
    return encode.encode_documents(docs, m, pretokenize=True)


@register("bpe_fertility")
def q_bpe_fertility(spark, sf_dir):
    """Fertility record of the trained model on its fertility sample
    (documents of at least 20 characters, pre-tokenized input)."""
    m = training.trained_model(spark, sf_dir)
    s = corpus.sample_fertility(corpus.documents(spark, sf_dir, indic=True))
    return metrics.fertility_pretok(encode.encode_documents(s, m, pretokenize=True).withColumnRenamed("n_tokens", "n_tok"))


@register("bpe_evaluate")
def q_bpe_evaluate(spark, sf_dir):
    """Result rows of the trained model (raw text, the model's own split),
    NSL against the script tokenizer, coverage from its vocabulary."""
    m = training.trained_model(spark, sf_dir)
    docs = corpus.sample_eval(corpus.documents(spark, sf_dir, indic=True), n=None, max_chars=None)
    wc = materialised(metrics.word_counts(docs), "words")
    stats = encode.bpe_word_stats(wc, m, TOKENIZERS["script"].pieces(F.col("word")).cast("bigint"))
    agg = metrics.aggregate_word_stats(stats, metrics.doc_level(wc))
    cov = vocab.vocab_coverage(spark, m.vocab).withColumn("model", F.lit("bpe"))
    return metrics.results_rows(spark, agg, cov)


@register("bpe_novel")
def q_bpe_novel(spark, sf_dir):
    """Trained vocabulary minus specials minus the English base vocabulary."""
    m = training.trained_model(spark, sf_dir)
    return vocab.novel_tokens(m.vocab, base_vocab(spark, sf_dir))


@register("bpe_token_ids")
def q_bpe_token_ids(spark, sf_dir):
    """Token ids of every document, and the tokens that the ids map back to, joined with spaces."""
    m = training.trained_model(spark, sf_dir)
    docs = corpus.sample_eval(corpus.documents(spark, sf_dir, indic=True))
    enc = materialised(encode.encoded_documents(docs, m).select("doc_id", "lang", "n_tokens", "ids"), "encoded")     # read by both sides
    back = encode.decoded_documents(enc, m).withColumnRenamed("doc_id", "back_id")
    ids = enc.select("doc_id", "lang", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"), "n_tokens")
    return ids.join(back, F.col("doc_id") == F.col("back_id")).drop("back_id")


@register("bpe_round_trip")
def q_bpe_round_trip(spark, sf_dir):
    """What encoding must keep, per document: the code points of its pieces (a token outside the alphabet stands for one)."""
    m = training.trained_model(spark, sf_dir)
    docs = corpus.sample_eval(corpus.documents(spark, sf_dir, indic=True))
    enc = encode.encoded_documents(docs, m)
    back = encode.decoded_documents(enc, m)
    unk = text.UNK_TOKEN
    plain = F.replace(F.replace("tokens", F.lit(unk), F.lit("?")), F.lit(" "), F.lit(""))
    return back.select("doc_id", F.length(plain).cast("bigint").alias("n_chars"), F.md5(plain).alias("chars_md5"))


ORACLE["bpe_round_trip"] = f"""
WITH d AS (SELECT doc_id, {strip_sql('text')} AS t FROM ({docs_sql(indic=True)})),
p AS (SELECT doc_id, array_to_string(regexp_extract_all(array_to_string(regexp_extract_all(t, {q(PRETOK)}), ' '), {q(pretok.MODEL_SPLIT_RE)}), '') AS c
      FROM d WHERE length(t) >= 10)
SELECT doc_id, CAST(length(c) AS BIGINT) AS n_chars, md5(c) AS chars_md5 FROM p
"""


@register("bpe_invariants")
def q_bpe_invariants(spark, sf_dir):
    """What SQL can say about the trained vocabulary: the alphabet's size, and the first merge."""
    m = training.trained_model(spark, sf_dir)
    first = m.merges.where("rank = 0").select("left", "right", "cnt")
    alphabet = m.vocab.where(~F.col("is_special") & (F.length("token") == 1)).agg(F.count(F.lit(1)).cast("bigint").alias("n_alphabet"))
    sizes = m.vocab.agg(F.count(F.lit(1)).alias("v")).first()["v"] - m.merges.count() - len(text.SPECIAL_TOKENS)
    return first.withColumn("n_alphabet", F.lit(alphabet.first()[0]).cast("bigint")).withColumn(
        "n_not_merged", F.lit(sizes).cast("bigint"))


ORACLE["bpe_invariants"] = f"""
WITH w AS ({_WORDS_SQL}), s AS (SELECT freq, regexp_extract_all(word, '(?s).') AS syms FROM w),
p AS (SELECT freq, syms[i] AS l, syms[i + 1] AS r
      FROM (SELECT freq, syms, unnest(generate_series(1, len(syms) - 1)) AS i FROM s WHERE len(syms) > 1)),
c AS (SELECT l, r, CAST(sum(freq) AS BIGINT) AS cnt FROM p GROUP BY l, r),
a AS (SELECT count(DISTINCT c) AS n FROM (SELECT unnest(syms) AS c FROM s))
SELECT l AS "left", r AS "right", cnt, CAST((SELECT n FROM a) AS BIGINT) AS n_alphabet, CAST((SELECT n FROM a) AS BIGINT) AS n_not_merged
FROM c ORDER BY cnt DESC, l, r LIMIT 1
"""


# ------------------------------------------------------- saved tokenizers ---
SHORT = 16      # merges of the short tokenizer, whose training SQL can follow step by step


def _models(spark, sf_dir) -> dict[str, str]:
    """The four SQL tokenizers and the saved short one, by name."""
    return {m: m for m in SQL_MODELS} | {"bpe_short": training.saved_tokenizer(spark, sf_dir, max_merges=SHORT)}


@register("bpe_short_merges")
def q_bpe_short_merges(spark, sf_dir):
    """The first merges of the training, as a saved tokenizer of its own."""
    return store.load(spark, training.saved_tokenizer(spark, sf_dir, max_merges=SHORT)).merges


@register("evaluate_models")
def q_evaluate_models(spark, sf_dir):
    """Five models, one of them a saved tokenizer that is also the reference of the sequence lengths."""
    docs = corpus.documents(spark, sf_dir, indic=True)
    return evaluation.evaluate_models(spark, docs, _models(spark, sf_dir), ref_model="bpe_short")


@register("nsl_matrix")
def q_nsl_matrix(spark, sf_dir):
    """Sequence lengths of every model against every model, per language."""
    agg, _ = evaluation.compared(spark, corpus.documents(spark, sf_dir, indic=True), _models(spark, sf_dir))
    return metrics.nsl_matrix(agg)


@register("evaluate_saved")
def q_evaluate_saved(spark, sf_dir):
    """Result rows of six models: the SQL tokenizers, and two saved ones of a short and of the whole training, which is the reference."""
    models = _models(spark, sf_dir) | {"bpe": training.saved_tokenizer(spark, sf_dir)}
    return evaluation.evaluate_models(spark, corpus.documents(spark, sf_dir, indic=True), models, ref_model="bpe")


@register("tokenizer_registry")
def q_tokenizer_registry(spark, sf_dir):
    """What the store says of the short tokenizer of this table: its sizes, and the settings that it was trained with."""
    path = training.saved_tokenizer(spark, sf_dir, max_merges=SHORT)
    row = store.registry(spark, training.store_dir(spark)).where(F.col("tokenizer_id") == path.rsplit("/", 1)[1])
    return row.select("n_tokens", "n_merges", F.get_json_object("settings", "$.max_merges").cast("bigint").alias("max_merges"))


# SQL: a symbol is chr(1) || text || chr(2), so one replace() is one merge, from left to right and without overlap
_SYMBOLS = "chr(1) || array_to_string(regexp_extract_all({0}, '(?s).'), chr(2) || chr(1)) || chr(2)"
_LIST = "string_split(substr({0}, 2, length({0}) - 2), chr(2) || chr(1))"


def _short_sql() -> str:
    """CTEs: w (words), s0.. (their symbols after each merge), m1.. (the merges), merges."""
    out = [f"w AS MATERIALIZED ({_WORDS_SQL})", f"s0 AS MATERIALIZED (SELECT word, freq, {_SYMBOLS.format('word')} AS seg FROM w)"]
    for i in range(1, SHORT + 1):
        out.append(f"""m{i} AS MATERIALIZED (SELECT l, r, CAST(sum(freq) AS BIGINT) AS cnt FROM
  (SELECT freq, x[i] AS l, x[i + 1] AS r FROM (SELECT freq, x, unnest(generate_series(1, len(x) - 1)) AS i FROM (SELECT freq, {_LIST.format('seg')} AS x FROM s{i - 1})))
  GROUP BY l, r HAVING sum(freq) >= {bpe.MIN_FREQUENCY} ORDER BY cnt DESC, l, r LIMIT 1)""")
        out.append(f"s{i} AS MATERIALIZED (SELECT word, freq, replace(seg, chr(1) || l || chr(2) || chr(1) || r || chr(2), chr(1) || l || r || chr(2)) AS seg FROM s{i - 1}, m{i})")
    rows = " UNION ALL ".join(f"SELECT {i - 1} AS rank, l, r, l || r AS merged, cnt FROM m{i}" for i in range(1, SHORT + 1))
    return ",\n".join([*out, f"merges AS MATERIALIZED ({rows})"])


ORACLE["bpe_short_merges"] = f'WITH {_short_sql()} SELECT rank, l AS "left", r AS "right", merged, cnt FROM merges'
ORACLE["tokenizer_registry"] = f"""WITH {_short_sql()}
SELECT (SELECT count(DISTINCT c) FROM (SELECT unnest(regexp_extract_all(word, '(?s).')) AS c FROM w)) + (SELECT count(*) FROM merges) + {len(text.SPECIAL_TOKENS)} AS n_tokens,
  (SELECT count(*) FROM merges) AS n_merges, CAST({SHORT} AS BIGINT) AS max_merges"""


def _compared_sql() -> str:
    """CTEs: a (counts per model and language), cov (coverage), lm (languages) for the four SQL tokenizers and the short one."""
    sql = evaluate_sql(indic=True)
    head, tail = sql[:sql.index("a AS (SELECT model, lang")], sql[sql.index("lm AS (SELECT * FROM"):sql.index("SELECT a.lang AS lang_code")]
    steps = [f"e0 AS MATERIALIZED (SELECT DISTINCT piece, {_SYMBOLS.format('piece')} AS seg FROM pw)"]
    for i in range(1, SHORT + 1):
        steps.append(f"e{i} AS MATERIALIZED (SELECT piece, replace(seg, chr(1) || l || chr(2) || chr(1) || r || chr(2), chr(1) || l || r || chr(2)) AS seg FROM e{i - 1}, m{i})")
    strip = f"length(ltrim(x, {q(LEN_MARKERS)}))"
    return head.replace("WITH s AS", f"WITH {_short_sql()},\ns AS", 1) + f"""
alphabet AS MATERIALIZED (SELECT DISTINCT unnest(regexp_extract_all(word, '(?s).')) AS c FROM w),
dw AS MATERIALIZED (SELECT lang, word, count(*) AS cnt FROM (SELECT lang, unnest(ws) AS word FROM d) GROUP BY ALL),
pw AS MATERIALIZED (SELECT word, piece, row_number() OVER () AS at FROM (SELECT word, unnest(regexp_extract_all(word, {q(pretok.MODEL_SPLIT_RE)})) AS piece FROM (SELECT DISTINCT word FROM dw))),
{", ".join(steps)},
et AS MATERIALIZED (SELECT piece, x, length(x) = 1 AND x NOT IN (SELECT c FROM alphabet) AS unk FROM (SELECT piece, unnest({_LIST.format('seg')}) AS x FROM e{SHORT})),
ep AS (SELECT piece, count(*) AS n, sum(CASE WHEN unk THEN 1 ELSE 0 END) AS n_unk, sum(CASE WHEN unk THEN 0 ELSE {strip} END) AS len_sum FROM et GROUP BY piece),
ew AS MATERIALIZED (SELECT word, sum(n) AS n, sum(n_unk) AS n_unk, sum(len_sum) AS len_sum FROM pw JOIN ep USING (piece) GROUP BY word),
dl AS (SELECT lang, count(*) AS n_docs, sum(n_bytes) AS n_bytes FROM d GROUP BY lang),
a AS (SELECT model, lang, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n_words) AS BIGINT) AS n_words, CAST(sum(n_tok) AS BIGINT) AS n_tokens, CAST(sum(n_bytes) AS BIGINT) AS n_bytes,
        CAST(sum(len_sum) AS BIGINT) AS len_sum, CAST(sum(n_tok) AS BIGINT) AS len_n, CAST(0 AS BIGINT) AS n_unk, CAST(sum(cont_split) AS BIGINT) AS cont_split FROM c GROUP BY model, lang
      UNION ALL
      SELECT 'bpe_short', lang, CAST(any_value(dl.n_docs) AS BIGINT), CAST(sum(cnt) AS BIGINT), CAST(sum(cnt * coalesce(n, 0)) AS BIGINT), CAST(any_value(dl.n_bytes) AS BIGINT),
        CAST(sum(cnt * coalesce(len_sum, 0)) AS BIGINT), CAST(sum(cnt * coalesce(n - n_unk, 0)) AS BIGINT), CAST(sum(cnt * coalesce(n_unk, 0)) AS BIGINT),
        CAST(sum(CASE WHEN n > 1 THEN cnt ELSE 0 END) AS BIGINT) FROM dw LEFT JOIN ew USING (word) JOIN dl USING (lang) GROUP BY lang),
fc AS (SELECT DISTINCT model, substring(ltrim(tok, {q(COV_MARKERS)}), 1, 1) AS ch
       FROM (SELECT model, unnest(toks) AS tok FROM m UNION ALL SELECT 'bpe_short', c FROM alphabet UNION ALL SELECT 'bpe_short', merged FROM merges
             UNION ALL SELECT 'bpe_short', unnest([{", ".join(q(t) for t in text.SPECIAL_TOKENS)}])) WHERE length(ltrim(tok, {q(COV_MARKERS)})) > 0),
""" + tail


ORACLE["nsl_matrix"] = _compared_sql() + f"""
SELECT x.model, y.model AS ref_model, x.lang, x.n_tokens, y.n_tokens AS n_ref_tokens, {div('x.n_tokens', 'y.n_tokens')} AS nsl FROM a x JOIN a y USING (lang)
"""
ORACLE["evaluate_models"] = _compared_sql() + f"""
SELECT a.lang AS lang_code, coalesce(lm.lang_name, a.lang) AS lang_name, coalesce(lm.script, 'Unknown') AS script, a.n_docs, a.n_words, a.n_tokens,
       {div('a.n_tokens', 'a.n_words')} AS fertility, {div('a.cont_split', 'a.n_words')} AS continuation_rate, {div('a.n_bytes', 'a.n_tokens')} AS bytes_per_token,
       {div('a.n_unk', 'a.n_tokens')} AS unk_rate, CAST(coalesce(covr.vocab_coverage, 0.0) AS DOUBLE) AS vocab_coverage,
       {div('a.n_tokens', 'ref.n_tokens')} AS nsl, {div('a.len_sum', 'a.len_n')} AS avg_token_len, {grade_eval_sql(div('a.n_tokens', 'a.n_words'))} AS grade, a.model
FROM a JOIN (SELECT lang, n_tokens FROM a WHERE model = 'bpe_short') ref ON ref.lang = a.lang LEFT JOIN lm ON a.lang = lm.lang_code
LEFT JOIN covr ON covr.model = a.model AND covr.lang_code = a.lang
"""
