"""Language identification by word-first backoff.

A word that the training rows know is scored by its log frequency in each language. An unknown word falls back to its
character 5-grams (with word-boundary marks), then to 4-, 3-, 2- and 1-grams: the longest order of which any gram is known gives
the mean log frequency of its known grams. A text's score is the posterior over languages of the sum over its words.

Counts cover all training rows and all their words: tasks count (language, word) locally with a bounded table, Spark sums them.
Texts are read once for scoring. A task scores the most frequent words, ``SENT_WORDS`` at most, from a table that is sent to it and
keeps a text's other words with their counts; those meet the whole count table in a join, whatever their
language's size, and only what the table doesn't hold is scored by grams. The gram model keeps the ``LANG_GRAMS`` most frequent grams of
each order in each language, so that a small language has as large a share of it as a large one.

Words are runs of letters and digits without decimal digits, lower-cased; those without a letter are ignored.
Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text if there is no training
row, or if no word, gram or letter of it is known; ties go to the language first in order; rows with null text or lang
are not learnt from; repeated rows count as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tokscope.llm.common import Memo, batch, fresh, is_fold, settle, texts, written

SENT_WORDS = 60_000     # most frequent words at most, scored where the text is read
LANG_GRAMS = 5_000      # grams of each order and language in the model for unseen words
ORDERS = (5, 4, 3, 2, 1)
FLUSH = 150_000         # entries of a task's local table
MEMO = 30_000           # unseen words of each of a task's two generations
MIN_SCORE = 0.5
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def has_letter(word: str) -> bool:
    return word.isalpha() or any(c.isalpha() for c in word)


def grams_of(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    w = f"^{word}$"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


@dataclass(frozen=True)
class Grams:
    """Log frequencies of the known grams, for words that no training row has."""
    index: dict[int, dict[str, int]]       # by order
    logs: dict[int, np.ndarray]            # grams x languages

    def unseen(self, word: str) -> np.ndarray | None:
        """Mean log frequencies of the known grams of the longest order that has any; None if no letter is known."""
        if not has_letter(word):
            return None
        for n in ORDERS:
            at = [i for g in grams_of(word, n) if (i := self.index[n].get(g)) is not None]
            if at:
                return self.logs[n][at].mean(axis=0, dtype=np.float64)
        return None


@dataclass(frozen=True)
class Model:
    langs: list[str]
    totals: list[float]                    # training words of each language
    words: DataFrame                       # word, n0, n1, ...: the counts of every training word, a column a language
    distinct: int
    sent: dict[str, int]                   # the most frequent words ...
    sent_logs: np.ndarray                  # ... and their log frequencies
    grams: Grams


class _Index(dict):
    def __missing__(self, key):
        return -1


def _counted(rows, schema: pa.Schema):
    """Yield bounded local counts of ``(*key)`` tuples as record batches whose last column is the count."""
    local: Counter = Counter()

    def out():
        return batch(schema, (*zip(*local), list(local.values())))

    for group in rows:
        local.update(group)
        if len(local) >= FLUSH:
            yield out()
            local.clear()
    if local:
        yield out()


def word_counts(train: DataFrame) -> DataFrame:
    """lang, word, n over all rows with text and lang."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        tables: dict[str, Counter] = {}

        def flush():
            for lang, c in tables.items():
                kept = [(w, n) for w, n in c.items() if has_letter(w)]
                yield batch(schema, ([lang] * len(kept), [w for w, _ in kept], [n for _, n in kept]))
            tables.clear()

        for b in batches:
            for text, lang in zip(texts(b.column(0)), b.column(1).to_pylist()):
                c = tables.get(lang)
                if c is None:
                    c = tables[lang] = Counter()
                c.update(words_of(text))
            if sum(map(len, tables.values())) >= FLUSH:
                yield from flush()
        yield from flush()

    return (train.select("text", "lang").dropna().mapInArrow(run, "lang string, word string, n bigint")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def gram_counts(words: DataFrame) -> DataFrame:
    """lang, k, gram, n: grams of the distinct words of each language."""
    schema = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])

    def run(batches):
        def rows():
            for b in batches:
                for lang, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if has_letter(w):
                        yield [(lang, n, g) for n in ORDERS for g in grams_of(w, n)]
        yield from _counted(rows(), schema)

    return (words.select("lang", "word").mapInArrow(run, "lang string, k int, gram string, n bigint")
            .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")))


def _by_language(counts: DataFrame, key: str, langs: list[str]) -> DataFrame:
    """key, n0, n1, ...: one row a key, one column a language."""
    return counts.groupBy(key).agg(*(F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(langs)))


def _logs(counts: np.ndarray, totals: list[float], distinct: int) -> np.ndarray:
    return np.log((counts + 0.5) / (np.array(totals) + 0.5 * (distinct + 1)))


def _gram_model(words: DataFrame, langs: list[str]) -> Grams:
    grams = settle(gram_counts(words))
    totals = {(r.k, r.lang): float(r.t) for r in grams.groupBy("k", "lang").agg(F.sum("n").alias("t")).collect()}
    best = F.row_number().over(W.partitionBy("k", "lang").orderBy(F.desc("n"), "gram"))
    top = grams.withColumn("rank", best).filter(F.col("rank") <= LANG_GRAMS).select("k", "gram").distinct()
    found = _by_language(grams.join(top, ["k", "gram"]).withColumn("key", F.struct("k", "gram")), "key", langs).select("key.*", *(f"n{i}" for i in range(len(langs))))
    pdf = found.orderBy("k", "gram").toPandas()            # orders x languages x LANG_GRAMS rows at most
    index, logs = {}, {}
    for n in ORDERS:
        part = pdf[pdf["k"] == n]
        index[n] = {g: i for i, g in enumerate(part["gram"])}
        counts = part[[f"n{i}" for i in range(len(langs))]].to_numpy(np.float64)
        logs[n] = _logs(counts, [totals.get((n, x), 0.0) for x in langs], len(part)).astype(np.float32)
    return Grams(index, logs)


def fit(train: DataFrame) -> Model | None:
    """Learn from all rows of ``train`` (text, lang); None without any word."""
    words = settle(word_counts(train))
    totals = {r.lang: float(r.t) for r in words.groupBy("lang").agg(F.sum("n").alias("t")).collect()}
    if not totals:
        return None
    langs = sorted(totals)
    cols = [f"n{i}" for i in range(len(langs))]
    table = written(_by_language(words, "word", langs), "words")
    total = sum((F.col(c) for c in cols), F.lit(0))
    often = F.floor(F.log2(total) * 8)                      # a few hundred classes; as many of the highest as SENT_WORDS has room for
    sizes = sorted(((r.c, r.n) for r in table.groupBy(often.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, room = None, SENT_WORDS
    for c, n in sizes:
        room -= n
        if room < 0:
            break
        least = c
    best = table.filter(often >= least) if least is not None else table.limit(0)
    sent = best.toArrow()
    counts, distinct = [totals[x] for x in langs], sum(n for _, n in sizes)
    found = np.stack([sent.column(c).to_numpy().astype(np.float64) for c in cols], axis=1)
    return Model(langs, counts, table, distinct, {w: i for i, w in enumerate(sent.column("word").to_pylist())}, _logs(found, counts, distinct),
                 _gram_model(words, langs))


def _read(docs: DataFrame, model: Model) -> DataFrame:
    """row, doc_id, th, known, base, words, counts of every row: the score of its frequent words, how many there are, and its
    other words. ``th``: hash of the text."""
    sent = docs.sparkSession.sparkContext.broadcast((_Index(model.sent), model.sent_logs))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("known", pa.int64()), ("base", pa.list_(pa.float64())),
                        ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def run(batches):
        index, logs = sent.value
        place, row = index.__getitem__, TaskContext.get().partitionId() << 40
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part, out = b.slice(i, 1024), []
                for text in texts(part.column(2)):
                    c = Counter(words_of(text))
                    at = np.fromiter(map(place, c), np.int64, len(c))
                    times = np.fromiter(c.values(), np.float64, len(c))
                    rest = at < 0
                    base = times[~rest] @ logs[at[~rest]]
                    other = [(w, n) for (w, n), new in zip(c.items(), rest.tolist()) if new and has_letter(w)] if rest.any() else []
                    out.append((row, int((~rest).sum()), base, [w for w, _ in other], [n for _, n in other]))
                    row += 1
                r, known, base, words, counts = zip(*out)
                yield batch(schema, (r, part.column(0), part.column(1), known, base, words, counts))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(run, "row bigint, doc_id bigint, th bigint, known bigint, base array<double>, words array<string>, counts array<bigint>")


def _others(read: DataFrame, model: Model) -> DataFrame:
    """row, more, s0, s1, ...: number and score of the words that were not sent, from the whole count table or else by grams."""
    size = len(model.langs)
    sent = read.sparkSession.sparkContext.broadcast((model.grams, model.totals, model.distinct))
    schema = pa.schema([("row", pa.int64()), ("more", pa.int64()), *((f"s{i}", pa.float64()) for i in range(size))])

    def run(batches):
        grams, totals, distinct = sent.value
        memo = Memo(MEMO)
        for b in batches:
            times = b.column("n").to_numpy(zero_copy_only=False).astype(np.float64)
            counts = np.stack([b.column(f"n{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(size)], axis=1)
            score, more = _logs(counts, totals, distinct), np.ones(len(times), np.int64)
            for i in np.flatnonzero(np.isnan(counts[:, 0])).tolist():
                word = b.column("word")[i].as_py()
                v = memo.get(word)
                if v is None:
                    v = grams.unseen(word)
                    v = () if v is None else v
                    memo.put(word, v)
                score[i] = v if len(v) else 0.0
                more[i] = len(v) > 0
            yield batch(schema, (b.column("row"), more, *(score * times[:, None]).T))

    words = read.select("row", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))).alias("w")).select("row", "w.word", "w.n")
    found = words.join(model.words, "word", "left").mapInArrow(run, "row bigint, more bigint, " + ", ".join(f"s{i} double" for i in range(size)))
    return found.groupBy("row").agg(F.sum("more").alias("more"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(size)))


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, th, lang_pred, score of every row of ``docs``."""
    if model is None:
        return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    read = written(_read(docs, model), "read")
    others = _others(read, model).withColumnRenamed("row", "other")
    one = read.drop("words", "counts").join(others, F.col("row") == F.col("other"), "left")
    total = F.array(*(F.col("base")[i] + F.coalesce(F.col(f"s{i}"), F.lit(0.0)) for i in range(len(model.langs))))
    none = (F.col("known") == 0) & (F.coalesce("more", F.lit(0)) == 0)
    best = F.array_max("total")
    share = 1.0 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    lang = F.element_at(F.array(*(F.lit(x) for x in model.langs)), F.array_position("total", F.col("best")).cast("int"))
    return (one.select("doc_id", "th", total.alias("total"), none.alias("none")).withColumn("best", best)
            .select("doc_id", "th", F.when(F.col("none"), "und").otherwise(lang).alias("lang_pred"), F.when(F.col("none"), 0.0).otherwise(share).alias("score")))


def op1_langid(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    model = fit(docs.filter(~is_fold("doc_id", 3, 1)))
    return predicted(docs, model).select("doc_id", is_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of ``docs`` (same columns) whose language is found with a posterior of at least ``min_score``."""
    a, b, i, t = fresh(docs, "a", "b", "i", "t")
    found = predicted(docs, fit(docs.filter(~is_fold("doc_id", 3, 1)))).filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
    kept = settle(found.select(F.col("doc_id").alias(i), F.col("th").alias(t)).distinct())
    rows = docs.withColumn(a, F.col("doc_id").cast("bigint")).withColumn(b, F.xxhash64("text"))
    return rows.join(kept, F.col(a).eqNullSafe(F.col(i)) & (F.col(b) == F.col(t)), "left_semi").drop(a, b)
