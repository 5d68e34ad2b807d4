"""Byte-pair-encoding training as an iterative Spark job that makes many merges a round and equals one-at-a-time training.

State, kept between rounds as tables: ``words(word, freq, seg)``, the distinct training words (script pre-tokens, split again into
letter runs / symbol runs) with their corpus frequency and current symbols joined by spaces (words never contain
whitespace), and the pair index ``pairs(l, r, cnt)``, the counts of adjacent pairs that reach the minimum frequency. Within the
loop both are packed: a row holds a block of words as arrays of symbol numbers and frequencies (:func:`packed`), and a pair is one
number (``code``), so a round neither splits texts nor groups by them. Snapshots have the plain form.

One round:
  1. the head of the pair order (count desc, left asc, right asc), a bounded number of pairs that is sent to the tasks;
  2. every word reports the head's pairs that must wait in it (:func:`waiting`); a pair that waits nowhere is merged now;
  3. words that hold a merged pair are rewritten where they are, without a join or a shuffle;
  4. only the rewritten words send signed count changes; they are added to the pair index, which is hash-partitioned by pair
     and stays where it is (the union of index and changes is co-partitioned, so the index is never shuffled).
Every ``SNAPSHOT_EVERY`` rounds both tables are written to the shared folder, which cuts the lineage. Words that hold no pair of the
index any more can never change again (counts only fall); they leave the loop there and come back at the end.

Why this equals one merge at a time. Call pair p=(l, r) earlier than q if its count is higher, or equal and (l, r) comes first. In
one-at-a-time training a merge acts on all its occurrences at once, so two occurrences of a string that becomes a symbol develop
alike inside, as long as no merge crosses their ends: every symbol has one decomposition and all its occurrences appear in one
step. Hence (a) the count of a pair never rises once its symbols exist; (b) if l's left neighbour x is replaced by a longer symbol X,
every occurrence of (X, l) was one of (x, l), so (X, l) is never more frequent, and the same holds on the right. Now let p stand
in a word as ... x l r y ... If (r, y) is rarer than p, no later form (r, Y) can come before p. If it is as frequent, the left
symbol r decides, and p comes first if l < r. If (x, l) is rarer than p, no later form (X, l) comes before p. If it is as frequent, X
may be any run of symbols that ends in x, and p comes first if l < X for all of them. A pair of equal symbols asks for rarer
neighbours. If this holds at every occurrence, no earlier merge touches p, its count is final, and merging it now gives the
same words as merging it at its turn. Pairs that touch each other can't both pass, so all that pass are merged together; the first
pair of the order always passes. A pair beyond the head counts as its last. The order of the merges is restored at the end
(:func:`in_order`): counts fall, and among equal counts the smallest pair whose symbols exist comes next.

The end. Once more merges were made than the vocabulary takes, only pairs that are as frequent as the last that it would take now
can still be in it. All occurrences of these pairs, and so of every pair that comes out of them, are in the words that hold one of them,
which get fewer from round to round. When these words have ``LAST_SYMBOLS`` symbols at most, whatever the corpus has, they are sent
to one task that makes the rounds that are left (:func:`own_rounds`), most of which make a few merges each.

Before that, the same holds for any count: all occurrences of the pairs that reach it, and of every pair that comes out of them and
reaches it too, are in the words that hold one of them, for a later pair is never more frequent than the one whose place it takes. So
where the words that hold a pair of some count or more have ``LAST_SYMBOLS`` symbols at most, and a quarter of all words' symbols at
most, one task makes all rounds down to that count, and one job makes their merges in all words (:func:`rewritten_in_turn`). The
count is the smallest for which that holds; it is used where ``MANY`` pairs reach it, and twice as many as a plain round merges.

Pair counts use adjacent positions (``a a a`` counts (a, a) twice); merging replaces non-overlapping occurrences from left to right.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable
from copy import deepcopy
from dataclasses import dataclass, field
from functools import cached_property
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokscope.functions.pretok import model_split, pretokens
from tokscope.functions.text import SPECIAL_TOKENS
from tokscope.session import committed, ensure_checkpoint_dir, files_in, scratch_path, write_small

# --- fixed values: trainer settings of the reference ------------------------
VOCAB_SIZE = 32_000
MIN_FREQUENCY = 5
# -----------------------------------------------------------------------------
HEAD = 1 << 17          # pairs sent to the tasks in a round, at most
SNAPSHOT_EVERY = 16     # rounds between written tables
WORDS = 8_192           # words looked at together in a task
TASK_WORDS = 1 << 18    # words of a task, where there are enough for all cores
LAST_SYMBOLS = 1 << 21  # symbols of the words that one task makes rounds of its own for, at most
MANY = 256              # pairs for which that is worth a job, at least
LEVELS = np.unique((2 ** (np.arange(62 * 8) / 8)).astype(np.int64))     # counts, about eight for each power of two

CODE_POINT_RE = "(?s)."
STATE = "word string, freq bigint, seg string, was string"
BLOCKS = "ids binary, freq binary, code array<bigint>, cnt array<bigint>"
CODE = 1 << 31          # a pair's number is its left symbol's times this, plus its right symbol's


def word_frequencies(docs: DataFrame, text_col: str = "text", pretokenize: bool = True) -> DataFrame:
    """word, freq: the trainer's input words.

    Training lines are script pre-tokens joined by spaces; the model then
    splits them again into letter/mark/number runs and other-symbol runs.
    Counting pre-tokens first (partial aggregation) and splitting only the
    distinct ones gives the same table with far fewer regex calls.
    """
    if pretokenize:
        from tokscope.operators.vocab import pretoken_frequencies
        pt = pretoken_frequencies(docs, text_col).select(F.col("token").alias("pt"), F.col("freq").alias("n"))
    else:
        from tokscope.functions.text import WS
        pt = (docs.select(F.explode(F.split(F.col(text_col), f"{WS}+")).alias("pt")).where(F.col("pt") != "")
              .groupBy("pt").agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    return words_of_pretokens(pt.select(F.col("pt").alias("token"), F.col("n").alias("freq")))


def words_of_pretokens(table: DataFrame) -> DataFrame:
    """word, freq from a frequency table (token, freq) of pre-tokens, such as a stream keeps."""
    return (table.select(F.explode(model_split("token")).alias("word"), "freq")
            .groupBy("word").agg(F.sum("freq").cast("bigint").alias("freq")))


def initial_state(words: DataFrame) -> DataFrame:
    return words.select("word", "freq", F.array_join(
        F.regexp_extract_all("word", F.lit(CODE_POINT_RE), F.lit(0)), " ").alias("seg"))


def symbols(seg: Column) -> Column:
    return F.split(seg, " ")


def _pairs_sql() -> str:
    left, right = (f"slice(split(seg, ' '), {i}, size(split(seg, ' ')) - 1)" for i in (1, 2))
    return f"inline(arrays_zip({left}, {right})) AS (l, r)"


PAIRS_SQL = _pairs_sql()


def pair_counts(state: DataFrame) -> DataFrame:
    """l, r, cnt: adjacent symbol pairs weighted by word frequency."""
    return state.where("contains(seg, ' ')").selectExpr("freq", PAIRS_SQL).groupBy("l", "r").agg(F.expr("CAST(sum(freq) AS BIGINT) AS cnt"))


def count_changes(state: DataFrame) -> DataFrame:
    """l, r, cnt: what the words that were rewritten in this round add to the counts and take from them."""
    both = state.where("was IS NOT NULL").selectExpr("inline(array(struct(freq AS f, seg AS s), struct(-freq AS f, was AS s))) AS (freq, seg)")
    return pair_counts(both).where("cnt <> 0")


# -- within words, a batch at a time ------------------------------------------------------------------------------------
_BETWEEN = "\n"         # a token that stands between words; no symbol has white space


class PairTable:
    """Pairs with their counts, for finding them in many words at once: symbols become numbers, pairs become codes."""

    def __init__(self, pairs: list[tuple[str, str, int]]):
        self.pairs = pairs
        names = sorted({x for l, r, _ in pairs for x in (l, r)})
        self.number = {x: i for i, x in enumerate(names)}
        l, r = (np.array([self.number[p[k]] for p in pairs], np.int64) for k in (0, 1))
        code = l * len(names) + r
        self.order = np.argsort(code)
        self.code = code[self.order]
        self.count = np.array([c for *_, c in pairs], np.int64)[self.order]
        self.forward, self.same = (l < r)[self.order], (l == r)[self.order]      # names are in order, so numbers compare like symbols

    def find(self, segs: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(tokens of all words with ``_BETWEEN`` between them, for each position the place of the pair that begins there or -1,
        whether a pair of one word begins there)."""
        tokens = f" {_BETWEEN} ".join(segs).split(" ")
        get = self.number.get
        ids = np.fromiter((get(t, -2 if t == _BETWEEN else -1) for t in tokens), np.int64, len(tokens))
        within = (ids[:-1] != -2) & (ids[1:] != -2)
        code = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.number) + ids[1:], -1)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return tokens, np.where(self.code[at] == code, at, -1), within


def waiting(segs: list[str], head: PairTable, last: int) -> np.ndarray:
    """Places in ``head.pairs`` of the pairs that another pair may come before in one of the words. ``last``: the count that a pair
    outside the head may have (0 if the head holds all)."""
    tokens, at, within = head.find(segs)
    return waits(at, within, head, last, lambda i: None if tokens[i] == _BETWEEN else tokens[i])


def waits(at: np.ndarray, within: np.ndarray, head: PairTable | CodeTable, last: int, token: Callable[[int], str | None]) -> np.ndarray:
    """:func:`waiting` for words whose pairs are found. ``token``: the symbol at a position, None between words."""
    known = at >= 0
    c = np.where(known, head.count[at], 0)
    floor = np.where(c == last, last, 0)
    after, before = np.zeros_like(c), np.zeros_like(c)
    after[:-1] = np.where(within[1:], np.maximum(c[1:], floor[:-1]), 0)
    before[1:] = np.where(within[:-1], np.maximum(c[:-1], floor[1:]), 0)
    unlike_after, unlike_before = np.ones(len(c), bool), np.ones(len(c), bool)
    unlike_after[:-1] = at[:-1] != at[1:]
    unlike_before[1:] = at[:-1] != at[1:]
    same = head.same[at]
    wait = np.where(same, ((after >= c) & unlike_after) | ((before >= c) & unlike_before), (after > c) | (before > c) | ((after == c) & ~head.forward[at])) & known
    found = np.zeros(len(head.code), bool)
    found[at[wait]] = True
    tie = known & ~same & (before == c) & ~found[at]
    for i in np.flatnonzero(tie).tolist():          # as frequent as the pair on the left: compare with every run that ends there
        if found[at[i]]:
            continue
        right, x, j = token(i), "", i - 1
        while j >= 0 and (left := token(j)) is not None:
            x = left + x
            if not right < x:
                found[at[i]] = True
                break
            j -= 1
    return head.order[found]


def left_to_right(hit: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The occurrences ``hit`` that are replaced, from left to right. Only a pair of equal symbols can overlap itself."""
    first = np.r_[True, (np.diff(hit) > 1) | (at[hit[1:]] != at[hit[:-1]])]        # of a run of neighbouring occurrences
    start = hit[first][np.cumsum(first) - 1]
    return hit[(hit - start) % 2 == 0]


def merged(segs: list[str], pairs: PairTable) -> dict[int, str]:
    """The words that hold one of ``pairs``, by place, with all occurrences replaced from left to right."""
    tokens, at, _ = pairs.find(segs)
    hit = np.flatnonzero(at >= 0)
    if not len(hit):
        return {}
    hit = left_to_right(hit, at)
    ends = np.flatnonzero(np.array([t == _BETWEEN for t in tokens]))
    begins, ends = np.r_[0, ends + 1], np.r_[ends, len(tokens)]
    word = np.searchsorted(begins, hit, "right") - 1
    for i in hit.tolist():
        tokens[i] += tokens[i + 1]
        tokens[i + 1] = ""
    return {w: " ".join([t for t in tokens[begins[w]:ends[w]] if t]) for w in np.unique(word).tolist()}


# -- words as numbers ---------------------------------------------------------------------------------------------------
class Symbols:
    """The symbols of a run by number, in the order in which they came up."""

    def __init__(self, alphabet: Iterable[str], merges: Iterable[tuple[str, str, int]] = ()):
        self.names = sorted(alphabet)
        self.number = {x: i for i, x in enumerate(self.names)}
        for l, r, _ in merges:
            self.add(l + r)

    def add(self, name: str) -> int:
        if name not in self.number:
            self.number[name] = len(self.names)
            self.names.append(name)
        return self.number[name]

    def order(self) -> np.ndarray:
        """The place of every symbol among all, by code points."""
        place = np.empty(len(self.names), np.int64)
        place[sorted(range(len(self.names)), key=self.names.__getitem__)] = np.arange(len(self.names))
        return place


class CodeTable:
    """Pairs of symbol numbers, for finding them in blocks of words. ``made``: the symbols that they become, where that is known."""

    def __init__(self, code: np.ndarray, count: np.ndarray, place: np.ndarray, names: list[str] = (), made: np.ndarray | None = None):
        l, r = np.divmod(code, CODE)
        self.order = np.argsort(code)
        self.code, self.count = code[self.order], count[self.order]
        self.forward, self.same = (place[l] < place[r])[self.order], (l == r)[self.order]
        self.names, self.made = names, None if made is None else made[self.order]

    @staticmethod
    def slots(code: np.ndarray, shift: int) -> np.ndarray:
        return ((code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).view(np.int64)

    @cached_property
    def lookup(self) -> tuple[int, np.ndarray, np.ndarray]:
        """A hash table of the pairs, built by the task that asks: (shift of the hash, slot -> place or -1, places that found theirs taken)."""
        bits = (8 * len(self.code)).bit_length()
        own, places = self.slots(self.code, 64 - bits), np.arange(len(self.code), dtype=np.int32)
        table = np.full(1 << bits, -1, np.int32)
        table[own] = places
        return 64 - bits, table, np.flatnonzero(table[own] != places)

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(for each position but the last the place of the pair that begins there or -1, whether a pair of one word begins there)."""
        code, within = codes(ids)
        if not len(code):
            return np.full(0, -1, np.int64), within
        shift, table, late = self.lookup
        at = table[self.slots(code, shift)].astype(np.int64)
        at[~within] = -1
        other = np.flatnonzero((at >= 0) & (self.code[at] != code))
        at[other] = -1
        if len(other) and len(late):
            sought, keys = code[other], self.code[late]
            i = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
            at[other] = np.where(keys[i] == sought, late[i], -1)
        return at, within


def codes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[:-1].astype(np.int64) * CODE + ids[1:], (ids[:-1] >= 0) & (ids[1:] >= 0)


def summed(code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal codes added up, those that come to nothing dropped."""
    if not len(code):
        return code, count
    by = np.argsort(code)
    code, count = code[by], count[by]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    total = np.add.reduceat(count, first)
    return code[first][total != 0], total[total != 0]


def block_counts(ids: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a block's words with their counts."""
    code, within = codes(ids)
    return summed(code[within], freq[np.cumsum(ids < 0)[:-1]][within])


def block_merged(ids: np.ndarray, freq: np.ndarray, merges: CodeTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a block's symbols after the merges, pairs whose counts change by that, the changes)."""
    at, _ = merges.find(ids)
    hit = np.flatnonzero(at >= 0)
    if not len(hit):
        return ids, np.zeros(0, np.int64), np.zeros(0, np.int64)
    hit = left_to_right(hit, at)
    kept, part = np.ones(len(ids), bool), np.zeros(len(ids), bool)
    kept[hit + 1] = False
    part[hit] = part[hit + 1] = True
    new = ids.copy()
    new[hit] = merges.made[at[hit]]
    new, word, changes = new[kept], np.cumsum(ids < 0), []
    for x, w, there, sign in ((ids, word, part, -1), (new, word[kept], part[kept], 1)):    # a pair without a merged symbol stays as it is
        i = np.flatnonzero((there[:-1] | there[1:]) & (x[:-1] >= 0) & (x[1:] >= 0))
        changes.append((x[i].astype(np.int64) * CODE + x[i + 1], sign * freq[w[i]]))
    return new, *summed(*(np.concatenate(x) for x in zip(*changes)))


def in_order(merges: Iterable[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """Merges (left, right, count) in the order of one-at-a-time training."""
    out = []
    for _, same in groupby(sorted(merges, key=lambda m: -m[2]), key=lambda m: m[2]):
        level = list(same)
        made = {l + r for l, r, _ in level}
        needs = {m: len({m[0], m[1]} & made) for m in level}
        then = defaultdict(list)
        for m in level:
            for s in {m[0], m[1]} & made:
                then[s].append(m)
        ready = [m for m in level if not needs[m]]
        heapq.heapify(ready)
        while ready:
            m = heapq.heappop(ready)
            out.append(m)
            for x in then[m[0] + m[1]]:
                needs[x] -= 1
                if not needs[x]:
                    heapq.heappush(ready, x)
    return out


# -- rounds ------------------------------------------------------------------------------------------------------------
def _block(ids: np.ndarray, freq: np.ndarray, *pairs: np.ndarray) -> pa.RecordBatch:
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in pairs]
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (ids, freq)] + lists, names=["ids", "freq", "code", "cnt"])


def _arrays(batches) -> Iterable[list[np.ndarray]]:
    """The blocks of Arrow batches with the columns of ``BLOCKS`` or the first two."""
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            yield [np.frombuffer(x, t) for x, t in zip(row, (np.int32, np.int64))]


def packed(words: DataFrame, syms: Symbols) -> DataFrame:
    """Blocks of ``words(freq, seg)``: ``ids``, the symbols of all words with -1 between two words, and ``freq``, one number a word;
    ``code`` and ``cnt``, the pairs in them with their counts."""
    sent = words.sparkSession.sparkContext.broadcast(syms.number | {_BETWEEN: -1})

    def run(batches):
        number = sent.value
        for b in batches:
            if b.num_rows:
                tokens = f" {_BETWEEN} ".join(b.column(1).to_pylist()).split(" ")
                ids = np.fromiter((number[t] for t in tokens), np.int32, len(tokens))
                freq = b.column(0).to_numpy().astype(np.int64)
                yield _block(ids, freq, *block_counts(ids, freq))

    return words.select("freq", "seg").mapInArrow(run, BLOCKS)


def plain(blocks: DataFrame, syms: Symbols, index: np.ndarray | None) -> DataFrame:
    """word, freq, seg, live of packed words: whether a word can still change. ``index``: all pairs of the index, or None if they are too many
    to send; then only words of one symbol are known to be finished."""
    sent = blocks.sparkSession.sparkContext.broadcast((syms.names, index))
    schema = pa.schema([("word", pa.string()), ("freq", pa.int64()), ("seg", pa.string()), ("live", pa.bool_())])

    def run(batches):
        names, index = sent.value
        for ids, freq in _arrays(batches):
            code, more = codes(ids)
            if index is not None:
                more = more & np.isin(code, index)
            live = np.zeros(len(freq), bool)
            live[np.cumsum(ids < 0)[:-1][more]] = True
            segs = " ".join([names[i] if i >= 0 else _BETWEEN for i in ids.tolist()]).split(f" {_BETWEEN} ")
            yield pa.RecordBatch.from_arrays([pa.array([x.replace(" ", "") for x in segs], pa.string()), pa.array(freq), pa.array(segs, pa.string()), pa.array(live)], schema=schema)

    return blocks.select("ids", "freq").mapInArrow(run, "word string, freq bigint, seg string, live boolean")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """code, cnt: what the blocks' words add to the pair counts, hash-partitioned by pair."""
    rows = blocks.selectExpr("inline(arrays_zip(code, cnt))")
    return rows.groupBy("code").agg(F.expr("CAST(sum(cnt) AS BIGINT) AS cnt")).where("cnt <> 0")


def holding(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each of a block's words, whether a pair was found in it. ``at``: as :meth:`CodeTable.find` gives it."""
    out = np.zeros(1 + int((ids < 0).sum()), bool)
    out[np.cumsum(ids < 0)[:-1][at >= 0]] = True
    return out


def of_words(ids: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """A block's symbols without the words that are not kept."""
    end = ids < 0
    out = ids[keep[np.cumsum(end) - end]]
    return out[:-1] if len(out) and out[-1] < 0 else out


def mergeable(blocks: DataFrame, head: CodeTable, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(which pairs of the head wait in no word, for each of ``LEVELS`` the symbols of the words whose most frequent pair of the head is of
    that level); one pass, of which one bit a pair and one number a level and task come back."""
    sent = blocks.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        head, held = sent.value, np.zeros(len(LEVELS), np.int64)
        found = np.zeros(len(head.code), bool)
        for ids, _ in _arrays(batches):
            at, within = head.find(ids)
            found[waits(at, within, head, last, lambda i: head.names[ids[i]] if ids[i] >= 0 else None)] = True
            top, size = most_frequent(ids, np.where(at >= 0, head.count[at], 0))
            held += np.bincount(np.searchsorted(LEVELS, top[top > 0], "right") - 1, size[top > 0], len(LEVELS)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (np.packbits(found), held)], names=["found", "held"])

    wait, held = np.zeros(len(head.code), bool), np.zeros(len(LEVELS), np.int64)
    for x in blocks.select("ids", "freq").mapInArrow(run, "found binary, held binary").collect():
        wait |= np.unpackbits(np.frombuffer(x.found, np.uint8), count=len(wait)).astype(bool)
        held += np.frombuffer(x.held, np.int64)
    sent.unpersist()
    wait[0] = False         # the first pair of the order always passes
    return ~wait, held


def most_frequent(ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of a block's words, its highest count and its symbols. ``count``: of the pair at each position but the last."""
    begins = np.r_[0, np.flatnonzero(ids < 0) + 1]
    return np.maximum.reduceat(np.append(count, 0), begins), np.diff(np.append(begins, len(ids) + 1))


def own_rounds(blocks: DataFrame, head: CodeTable, syms: Symbols, made: list[int], budget: int, floor: int) -> list[list[tuple[str, str, int]]]:
    """The merges of the rounds that are left down to the count ``floor``, round by round; ``head`` has all pairs that reach it. The words that
    hold one of them go to one task. ``made``: the counts of the merges so far; where these are ``budget`` or more, no pair that is rarer
    than the last that the vocabulary takes is merged."""
    sent = blocks.sparkSession.sparkContext.broadcast((head, syms, sorted(made, reverse=True)))

    def kept(batches):
        head = sent.value[0]
        for ids, freq in _arrays(batches):
            keep = holding(ids, head.find(ids)[0])
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (of_words(ids, keep), freq[keep])], names=["ids", "freq"])

    def run(batches):
        syms, made = deepcopy(sent.value[1:])       # a worker keeps the value for its next task
        parts = list(_arrays(batches))
        if not parts:
            return
        between = np.full(1, -1, np.int32)
        ids = np.concatenate([x for i, _ in parts for x in (i, between)])[:-1]
        freq = np.concatenate([f for _, f in parts])
        code, cnt = block_counts(ids, freq)
        number = 0
        while len(code):
            made.sort(reverse=True)
            least = max(floor, made[budget - 1]) if len(made) >= budget else floor
            code, cnt = (x[cnt >= least] for x in (code, cnt))
            if not len(code) or budget <= bisect_left(made, -int(cnt.max()), key=lambda c: -c):
                break
            number, place = number + 1, syms.order()
            l, r = np.divmod(code, CODE)
            by = np.lexsort((place[r], place[l], -cnt))
            code, cnt = code[by], cnt[by]
            table = CodeTable(code, cnt, place)
            at, within = table.find(ids)
            passed = np.ones(len(code), bool)
            passed[waits(at, within, table, 0, lambda i: syms.names[ids[i]] if ids[i] >= 0 else None)] = False  # noqa: B023
            passed[0] = True
            keep = holding(ids, at)
            ids, freq = of_words(ids, keep), freq[keep]
            pairs = [(syms.names[c // CODE], syms.names[c % CODE]) for c in code[passed].tolist()]
            symbol = np.array([syms.add(a + b) for a, b in pairs], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([number] * len(pairs), pa.int32()), pa.array([a for a, _ in pairs], pa.string()),
                                              pa.array([b for _, b in pairs], pa.string()), pa.array(cnt[passed], pa.int64())], names=["round", "l", "r", "cnt"])
            made += cnt[passed].tolist()
            ids, changed, by_how_much = block_merged(ids, freq, CodeTable(code[passed], cnt[passed], place, made=symbol))
            code, cnt = summed(np.concatenate([code, changed]), np.concatenate([cnt, by_how_much]))

    words = blocks.select("ids", "freq").mapInArrow(kept, "ids binary, freq binary").repartition(1)
    rows = words.mapInArrow(run, "round int, l string, r string, cnt bigint").collect()     # fewer merges than the pairs of the head and their symbols
    sent.unpersist()
    return [[(x.l, x.r, x.cnt) for x in same] for _, same in groupby(rows, key=lambda x: x["round"])]


def rewritten(blocks: DataFrame, merges: CodeTable) -> DataFrame:
    """One round's merges in every block; ``code`` and ``cnt`` are the changes of the pair counts."""
    sent = blocks.sparkSession.sparkContext.broadcast(merges)

    def run(batches):
        for ids, freq in _arrays(batches):
            new, code, cnt = block_merged(ids, freq, sent.value)
            yield _block(new, freq, code, cnt)

    return blocks.select("ids", "freq").mapInArrow(run, BLOCKS)


def rewritten_in_turn(blocks: DataFrame, head: CodeTable, turns: list[CodeTable]) -> DataFrame:
    """:func:`rewritten` for several rounds, one after the other; the words that none of them changes hold no pair of ``head``."""
    sent = blocks.sparkSession.sparkContext.broadcast((head, turns))

    def run(batches):
        head, turns = sent.value
        for ids, freq in _arrays(batches):
            keep = holding(ids, head.find(ids)[0])
            new, own, changes = of_words(ids, keep), freq[keep], [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for merges in turns:
                new, *changed = block_merged(new, own, merges)
                changes.append(changed)
            both = [x for x in (new, of_words(ids, ~keep)) if len(x)]
            ids = np.insert(np.concatenate(both), len(both[0]), -1) if len(both) > 1 else both[0]
            yield _block(ids.astype(np.int32), np.concatenate([own, freq[~keep]]), *summed(*(np.concatenate(x) for x in zip(*changes))))

    return blocks.select("ids", "freq").mapInArrow(run, BLOCKS)


def head_of(pairs: DataFrame, least: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the pairs that reach ``least``, in the pair order."""
    t = pairs.where(f"cnt >= {int(least)}").toArrow()
    code, cnt = (t.column(x).to_numpy() for x in ("code", "cnt"))
    l, r = np.divmod(code, CODE)
    by = np.lexsort((place[r], place[l], -cnt))
    return code[by], cnt[by]


def named(pairs: DataFrame, syms: Symbols) -> DataFrame:
    """l, r, cnt of a pair index (code, cnt)."""
    sent = pairs.sparkSession.sparkContext.broadcast(syms.names)

    @F.pandas_udf("string")
    def name(number: pd.Series) -> pd.Series:
        return number.map(sent.value.__getitem__)

    return pairs.select(name(F.expr(f"code div {CODE}")).alias("l"), name(F.expr(f"code % {CODE}")).alias("r"), "cnt")


def least_count(pairs: DataFrame, min_frequency: int, size: int) -> int:
    """A count that at most ``size`` pairs reach (unless more share the highest counts), from a histogram of a few hundred classes:
    no task sends a top list to the driver, whose length would grow with the number of tasks."""
    classes = pairs.groupBy(F.floor(F.log2("cnt") * 8)).agg(F.min("cnt").alias("least"), F.count(F.lit(1)).alias("n")).collect()
    least, total = None, 0
    for x in sorted(classes, key=lambda x: -x.least):
        total += x.n
        if least is not None and total > size:
            return least
        least = x.least
    return min_frequency


def rewrite(state: DataFrame, merges: Iterable[tuple[str, str, int]]) -> DataFrame:
    """One round's merges in every word; ``was`` keeps the symbols of words that change."""
    sent = state.sparkSession.sparkContext.broadcast(PairTable(list(merges)))
    schema = pa.schema([("word", pa.string()), ("freq", pa.int64()), ("seg", pa.string()), ("was", pa.string())])

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, WORDS):
                part = b.slice(i, WORDS)
                seg = part.column(2).to_pylist()
                was: list[str | None] = [None] * len(seg)
                for w, new in merged(seg, sent.value).items():
                    was[w], seg[w] = seg[w], new
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(seg, pa.string()), pa.array(was, pa.string())], schema=schema)

    return state.select("word", "freq", "seg").mapInArrow(run, STATE)


@dataclass
class BpeModel:
    vocab: DataFrame          # token, id, is_special
    merges: DataFrame         # rank, left, right, merged, cnt
    segmentation: DataFrame   # word, freq, syms ARRAY (training words after all merges)
    merge_list: list[tuple[str, str]]  # bounded by vocab_size, for encoding tasks
    rounds: int
    scanned: list[tuple[int, int]] = field(default_factory=list)   # (round, words still in the loop) at each snapshot


class _Run:
    """The tables of a training run under one folder: snapshots of both states, and, if ``journal``, every round's merges.

    A snapshot is valid once its marker, written last, is there; a journal entry once its own write is committed. A run that starts on
    a folder with snapshots takes up the last valid one, repeats the journal's rounds after it, and goes on."""

    def __init__(self, spark: SparkSession, folder: str, journal: bool):
        self.spark, self.folder, self.journal = spark, folder, journal

    def at(self, name: str, number: int | None = None) -> str:
        return f"{self.folder}/{name}" + ("" if number is None else f"/round-{number:06d}")

    def numbers(self, name: str) -> list[int]:
        return sorted(int(p.rsplit("-", 1)[1]) for p in committed(self.spark, self.at(name)))

    def write(self, df: DataFrame, name: str, number: int) -> DataFrame:
        path = self.at(name, number)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str, number: int) -> DataFrame:
        return self.spark.read.parquet(self.at(name, number))

    def record(self, number: int, merges: list[tuple[str, str, int]]) -> None:
        """One line a merge, in a file that is there as a whole or not at all."""
        rows = [json.dumps({"round": number, "l": l, "r": r, "cnt": c}) for l, r, c in merges]
        write_small(self.spark, f"{self.at('journal')}/round-{number:06d}.json", "\n".join(rows) + "\n")

    def recorded(self) -> dict[int, list[tuple[str, str, int]]]:
        out = defaultdict(list)
        if self.journal and files_in(self.spark, self.at("journal")):
            for x in self.spark.read.schema("round int, l string, r string, cnt bigint").json(self.at("journal")).collect():     # one row a merge
                out[x["round"]].append((x.l, x.r, x.cnt))
        return out


def train(words: DataFrame, vocab_size: int = VOCAB_SIZE, min_frequency: int = MIN_FREQUENCY,
          specials: list[str] = SPECIAL_TOKENS, max_merges: int | None = None,
          head_size: int = HEAD, snapshot_every: int = SNAPSHOT_EVERY, folder: str | None = None, max_rounds: int | None = None,
          last_symbols: int = LAST_SYMBOLS, many: int = MANY) -> BpeModel:
    """Train BPE on ``words(word, freq)``.

    Vocabulary: specials (ids 0..), then the alphabet in code-point order, then merged tokens in merge order. Stops when the
    vocabulary is full, when ``max_merges`` merges were made, or when the best pair count is below ``min_frequency``.
    With a ``folder`` (shared by all executors) the run can be taken up again by a later call with the same arguments, in this or
    another session. ``max_rounds`` stops early, for tests of just that; the model then has the merges that are final by then.
    ``last_symbols``, ``many``: see the module's text, "The end"; the rounds after the vocabulary is full are not in the journal, a run that
    is taken up makes them again.
    """
    spark = words.sparkSession
    ensure_checkpoint_dir(spark)
    # Each round is two small jobs; adaptive re-planning per stage costs more than it saves here (measured ~25 % per round). The
    # loop has a session of its own, so nobody else's queries see the setting.
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    run = _Run(own, folder or scratch_path(spark, "bpe"), folder is not None)
    start = run.at("words")
    if not run.numbers("done"):
        initial_state(words).write.mode("overwrite").parquet(start)
        own.read.parquet(start).select(F.explode(symbols(F.col("seg"))).alias("token")).distinct().write.mode("overwrite").parquet(run.at("alphabet"))
        run.write(own.createDataFrame([(0,)], "round int"), "done", 0)
    first = own.read.parquet(start)
    alphabet = spark.read.parquet(run.at("alphabet"))
    letters = [x.token for x in alphabet.collect()]           # distinct code points
    n_alpha = len(letters)
    budget = vocab_size - len(specials) - n_alpha
    if max_merges is not None:
        budget = min(budget, max_merges)

    def tasks(n: int) -> int:
        """For ``n`` words: as many as the session's shuffles have, but no more than cores while a task's words are few."""
        return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + n // 4096, max(own.sparkContext.defaultParallelism, n // TASK_WORDS)))

    size = first.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("word") + 1).alias("symbols")).first()
    parts, some = tasks(size.n), min(last_symbols, (size.symbols or 0) // 4)
    own.conf.set("spark.sql.shuffle.partitions", str(parts))
    journal = run.recorded()
    number = max((n for n in run.numbers("done") if n in journal or n == 0), default=0)
    merges = [m for n in sorted(journal) if n <= number for m in journal[n]]
    syms = Symbols(letters, merges)

    def index_of(table: DataFrame) -> DataFrame:
        sent = own.sparkContext.broadcast(syms.number)

        @F.pandas_udf("bigint")
        def code(l: pd.Series, r: pd.Series) -> pd.Series:
            return l.map(sent.value) * CODE + r.map(sent.value)

        return table.select(code("l", "r").alias("code"), "cnt").repartition(parts, "code").persist()

    if number:
        state = packed(run.read("state", number).repartition(parts), syms).persist()
        pairs = index_of(run.read("pairs", number))
    else:
        state = packed(first.repartition(parts), syms).persist()
        pairs = block_pairs(state).where(F.col("cnt") >= min_frequency).persist()
    retired = [n for n in run.numbers("retired") if n <= number]
    scanned, old, ended, jobs = [], [], False, 0
    least = least_count(pairs, min_frequency, head_size)
    place = syms.order()
    while max_rounds is None or number < max_rounds:
        if number + 1 not in journal:
            code, cnt = head_of(pairs, least, place)
            for x in old:                                     # both tables are held now; those before can go
                x.unpersist()
            old = []
            if least > min_frequency and (len(code) < budget // 4 or len(code) > head_size):
                least = least_count(pairs, min_frequency, head_size)
                code, cnt = head_of(pairs, least, place)
            if not len(code):
                break
            made = sorted((m[2] for m in merges), reverse=True)
            final = budget - bisect_left(made, -int(cnt[0]), key=lambda c: -c)
            if final <= 0:
                break
            # a pair that is rarer than so many merges as the vocabulary takes will not be in it
            enough = int(np.searchsorted(-cnt, -made[budget - 1], "right")) if len(made) >= budget else len(code)
            take = min(head_size, final, enough)
            complete = least <= min_frequency and len(code) <= take
            code, cnt = code[:take], cnt[:take]
            head = CodeTable(code, cnt, place, syms.names)
            last = 0 if complete else int(cnt[-1])
            passed, held = mergeable(state, head, last)
            if max_rounds is None and len(made) >= budget and take == enough and held.sum() <= last_symbols:
                rest = own_rounds(state, head, syms, made, budget, min_frequency)
                merges, number = merges + [m for now in rest for m in now], number + len(rest)
                ended = True
                break
            names = [(syms.names[c // CODE], syms.names[c % CODE], n) for c, n in zip(code[passed].tolist(), cnt[passed].tolist())]
            turns = [names]
            if max_rounds is None:
                reach = np.append(np.cumsum(held[::-1])[::-1], 0)       # symbols of the words that hold a pair of a level or more
                floor = max(int(np.append(LEVELS, cnt[0] + 1)[np.argmax(reach <= some)]), last + 1, min_frequency)
                above = cnt >= floor
                if above.sum() >= max(many, 2 * len(names)):
                    head = CodeTable(code[above], cnt[above], place)
                    turns = own_rounds(state, head, syms, made, budget, floor)
        else:
            turns = [journal[number + 1]]
        tables = []
        for now in turns:
            number += 1
            if run.journal and number not in journal:
                run.record(number, now)
            merges += now
            code = np.array([syms.number[l] * CODE + syms.number[r] for l, r, _ in now], np.int64)
            tables.append((code, np.array([c for *_, c in now], np.int64), np.array([syms.add(l + r) for l, r, _ in now], np.int32)))
        place = syms.order()
        tables = [CodeTable(code, cnt, place, made=made_of) for code, cnt, made_of in tables]
        old += [state, pairs]
        state = (rewritten(state, tables[0]) if len(tables) == 1 else rewritten_in_turn(state, head, tables)).persist()
        pairs = (pairs.union(block_pairs(state)).groupBy("code").agg(F.expr("CAST(sum(cnt) AS BIGINT) AS cnt"))
                 .where(f"cnt >= {int(min_frequency)}").persist())
        jobs += 1
        if jobs % snapshot_every == 0:
            known = pairs.select("code").toArrow().column("code").to_numpy() if pairs.count() <= head_size else None
            split = plain(state, syms, known).persist()
            left, gone = split.where("live"), split.where("NOT live")
            live = left.count()
            scanned.append((number, live))
            run.write(gone.select("word", "freq", "seg"), "retired", number)
            retired.append(number)
            kept = run.write(left.select("word", "freq", "seg"), "state", number)
            index = run.write(named(pairs, syms), "pairs", number)
            run.write(own.createDataFrame([(number,)], "round int"), "done", number)
            for x in (*old, state, pairs, split):
                x.unpersist()
            state, pairs, old = packed(kept.repartition(tasks(live)), syms).persist(), index_of(index), []
    ordered = in_order(merges)
    if max_rounds is not None and number >= max_rounds:
        best = pairs.agg(F.max("cnt")).first()[0] or 0
        ordered = [m for m in ordered if m[2] > best]         # what no remaining pair can come before
    merges = ordered[:max(0, budget)]
    finished = [own.read.parquet(run.at("retired", n)) for n in retired]
    end = plain(state, syms, None).select("word", "freq", "seg")
    for x in finished:
        end = end.unionByName(x.select("word", "freq", "seg"))
    end = segmented(first, merges) if len(merges) < len(ordered) or max_rounds is not None or ended else end
    end.write.mode("overwrite").parquet(run.at("segmentation"))
    for x in (state, pairs, *old):
        x.unpersist()
    merges_df = spark.createDataFrame(
        [(i, l, r, l + r, c) for i, (l, r, c) in enumerate(merges)],
        "rank int, left string, right string, merged string, cnt bigint")
    model = model_of(spark, specials, alphabet, n_alpha, merges_df, [(l, r) for l, r, _ in merges],
                     spark.read.schema("word string, freq bigint, seg string").parquet(run.at("segmentation")))
    model.rounds, model.scanned = number, scanned
    return model


def segmented(words: DataFrame, merges: list[tuple[str, str, int]]) -> DataFrame:
    """word, freq, seg after ``merges`` alone, where more were made than the vocabulary takes: each word on its own, by rank."""
    from tokscope.operators.encode import encode_word
    sent = words.sparkSession.sparkContext.broadcast({(l, r): i for i, (l, r, _) in enumerate(merges)})

    @F.pandas_udf("string")
    def seg(word: pd.Series) -> pd.Series:
        ranks = sent.value
        return word.map(lambda w: " ".join(encode_word(w, ranks, set(w))))

    return words.select("word", "freq", seg("word").alias("seg"))


def model_of(spark: SparkSession, specials: list[str], alphabet: DataFrame, n_alpha: int, merges: DataFrame,
             merge_list: list[tuple[str, str]], segmentation: DataFrame) -> BpeModel:
    from tokscope.operators.vocab import dense_ids
    sp = spark.createDataFrame([(t, i, True) for i, t in enumerate(specials)],
                               "token string, id bigint, is_special boolean")
    alpha = dense_ids(alphabet, "token", start=len(specials)).withColumn("is_special", F.lit(False))
    merged_tokens = merges.select(F.col("merged").alias("token"),
                                  (F.col("rank") + len(specials) + n_alpha).cast("bigint").alias("id"),
                                  F.lit(False).alias("is_special"))
    return BpeModel(vocab=sp.unionByName(alpha).unionByName(merged_tokens), merges=merges,
                    segmentation=segmentation.select("word", "freq", symbols(F.col("seg")).alias("syms")), merge_list=merge_list, rounds=0)
