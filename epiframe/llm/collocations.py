"""Phrases whose words stand together more often than apart, counted by FM-indexes over word ids.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into words at
space and tab. A phrase has 2 to ``MOST`` words of one piece and is a candidate if its language
has it ``LEAST`` times or more. All counts are per language.

* A batch of documents is a shard. First its words are counted over all shards; a rarer one than
  ``LEAST`` can be in no candidate and becomes a break, like the ends of pieces.
* The shard's sequence of word numbers gets an FM-index in both directions: its Burrows-Wheeler
  transform and that of its reversal, with ranks, sorted to the depth of the longest phrase.
  An n-gram is a pair of intervals. All intervals are extended at once: the words in
  the reversed transform within an interval are the n-gram's right extensions with their counts, those in
  the other one its left extensions, and each extension has its two intervals again.
* Shards' counts are summed, two words first; longer n-grams are enumerated, by extension to the left, only
  below bigrams that are frequent over all shards, and only if all their bigrams are.
  Nothing that could reach ``LEAST`` is skipped, however few a single shard has.

Cutting a candidate after k words gives l and r, the counts of its parts, and a score of
a * a / (l * r) in millionths, floored; the lowest counts, then the smallest k. A candidate
goes if a longer one that holds its words has at least half its count. Every
language's best are ranked by score, count, and phrase (by bytes).

Defined results: a null language is ``und``; null, empty and blank texts have no words; repeated
rows count each; an empty table gives no rows; other columns are ignored. Counts are exact up to
5 * 10^15 words a language.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiframe.llm import tallies
from epiframe.llm.tables import store
from epiframe.llm.words import chained

LEAST, MOST, RANKED, COVERED = 10, 3, 2000, 50
UNKNOWN = "und"
#: Characters that end a piece. A word of one of them stands for a break.
ENDS, BREAK = r"[.,;:!?\x0A-\x0D]", "."
SALTS = 64
#: ``words`` is 0 in a row for all words of a language.
COUNTED = "lang string, words int, phrase string, n long"


class Side:
    """The Burrows-Wheeler transform of a cyclic sequence of numbers, sorted to a limited depth, with ranks."""

    def __init__(self, ids: np.ndarray, size: int, depth: int):
        n = len(ids)
        columns = [np.roll(ids, -k) for k in range(depth)]
        if size**depth < 1 << 62:
            key = columns[0]
            for column in columns[1:]:
                key = key * size + column
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort(columns[::-1])
        self.bwt, self.n = ids[order - 1], n
        self.first = np.append(0, np.cumsum(np.bincount(ids, minlength=size)))
        self.ranks = np.sort(self.bwt * n + np.arange(n))

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is in the transform before ``row``."""
        return np.searchsorted(self.ranks, symbol * self.n + row) - self.first[symbol]


@dataclass
class Intervals:
    """N-grams (a row of symbols each): the first rows of their intervals in both directions, and their counts."""

    grams: np.ndarray
    low: np.ndarray
    back: np.ndarray
    count: np.ndarray

    def __getitem__(self, some: np.ndarray) -> "Intervals":
        return Intervals(self.grams[some], self.low[some], self.back[some], self.count[some])


class Index:
    """FM-index in both directions over numbers from 1 on; 0 is a break and belongs to no n-gram."""

    def __init__(self, ids: np.ndarray, depth: int = MOST):
        ids = np.append(ids, 0).astype(np.int64)
        self.size = int(ids.max()) + 1
        self.ahead, self.reverse = Side(ids, self.size, depth), Side(ids[::-1].copy(), self.size, depth)

    def words(self) -> Intervals:
        symbol = np.arange(1, self.size)
        low = self.ahead.first[symbol]
        count = self.ahead.first[symbol + 1] - low
        return Intervals(symbol[:, None], low, self.reverse.first[symbol], count)[count > 0]

    def _extensions(self, side: Side, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per interval and symbol that extends it: the interval, the symbol, its count, its row, and how many rows smaller symbols take."""
        begin = np.cumsum(count) - count
        rows = np.repeat(low - begin, count) + np.arange(count.sum())
        pair, many = np.unique(np.repeat(np.arange(len(low)), count) * self.size + side.bwt[rows], return_counts=True)
        parent, symbol = pair // self.size, pair % self.size
        smaller = np.cumsum(many) - many - begin[parent]
        real = symbol > 0
        parent, symbol = parent[real], symbol[real]
        return parent, symbol, many[real], side.first[symbol] + side.rank(symbol, low[parent]), smaller[real]

    def right(self, of: Intervals) -> Intervals:
        parent, symbol, count, row, smaller = self._extensions(self.reverse, of.back, of.count)
        return Intervals(np.column_stack([of.grams[parent], symbol]), of.low[parent] + smaller, row, count)

    def left(self, of: Intervals) -> Intervals:
        parent, symbol, count, row, smaller = self._extensions(self.ahead, of.low, of.count)
        return Intervals(np.column_stack([symbol, of.grams[parent]]), row, of.back[parent] + smaller, count)


class Shard:
    """The words of a batch with their languages; word keys tell languages apart."""

    def __init__(self, docs: pa.Table):
        text = pc.replace_substring_regex(pc.ascii_lower(docs["text"].combine_chunks()), ENDS, f" {BREAK} ")
        found = tallies.words(text)
        langs = docs["lang"].combine_chunks().dictionary_encode()
        self.langs, lang = langs.dictionary, langs.indices.to_numpy()[found.row].astype(np.int64)
        end = pc.index(found.distinct, pa.scalar(BREAK, found.distinct.type)).as_py()
        word = found.number != end
        self.row, self.word = found.row, word
        # one number for every word of a language
        pair, number = np.unique(lang[word] * len(found.distinct) + found.number[word], return_inverse=True)
        self.lang, self.text = pair // max(1, len(found.distinct)), found.distinct.take(pa.array(pair % max(1, len(found.distinct))))
        self.number = number.ravel()
        salt = np.fromiter((xxhash.xxh3_64_intdigest(x or "") for x in self.langs.to_pylist()), np.uint64, len(self.langs))
        self.keys = chained(salt[self.lang], found.hashes()[pair % max(1, len(found.distinct))])
        self.checks = tallies.second(self.keys)

    def index(self, known: np.ndarray, depth: int) -> tuple[Index, np.ndarray]:
        """The index, to ``depth``, over the words that ``known`` marks, and the number that each of its symbols from 1 on stands for."""
        kept = np.flatnonzero(known)
        symbol = np.zeros(len(known) + 1, np.int64)
        symbol[kept] = np.arange(1, len(kept) + 1)
        ids = np.zeros(len(self.row), np.int64)
        ids[self.word] = symbol[self.number]
        # a break before every text but the first; breaks in a row are one
        ids = np.insert(ids, np.flatnonzero(np.diff(self.row)) + 1, 0)
        ids = ids[(ids != 0) | np.append(True, ids[:-1] != 0)[: len(ids)]]
        return Index(ids, depth), kept

    def gram_keys(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key and check of n-grams, a row of word numbers each."""
        key, check = self.keys[numbers[:, 0]], self.checks[numbers[:, 0]]
        for column in numbers.T[1:]:
            key, check = chained(key, self.keys[column]), tallies.check(check, self.checks[column])
        return key, (check >> np.uint64(32)).astype(np.uint32)

    def rows(self, numbers: np.ndarray, counts: np.ndarray) -> pa.Table:
        """N-grams as text."""
        texts = [self.text.take(pa.array(column)) for column in numbers.T]
        phrase = pc.binary_join_element_wise(*texts, pa.scalar(" ", pa.large_string())).cast(pa.string())
        lang = self.langs.take(pa.array(self.lang[numbers[:, 0]])).cast(pa.string())
        return pa.table({"lang": lang, "words": pa.array(np.full(len(counts), numbers.shape[1], np.int32)), "phrase": phrase, "n": pa.array(counts, pa.int64())})


def _words(shards: int):
    def ask(table: pa.Table) -> pa.Table:
        shard = Shard(table)
        counts = np.bincount(shard.number, minlength=len(shard.keys))
        return tallies.requests(table["batch"][0].as_py(), shards, shard.keys, (shard.checks >> np.uint64(32)).astype(np.uint32), counts)

    return ask


def _bigrams(shards: int):
    def ask(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(docs)
        index, symbols = shard.index(tallies.told(answers, shard.keys).of(shard.keys) > 0, 2)
        pairs = index.right(index.words())
        keys, checks = shard.gram_keys(symbols[pairs.grams - 1])
        return tallies.requests(key[0].as_py(), shards, keys, checks, pairs.count)

    return ask


def _counts(most: int):
    def count(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        """Frequent words and bigrams whose first batch this is with their totals, and all counts here of longer n-grams that may be frequent."""
        shard = Shard(docs)
        words = tallies.told(answers.filter(pc.equal(answers["step"], 0)), shard.keys)
        index, symbols = shard.index(words.of(shard.keys) > 0, most)
        pairs = index.right(index.words())
        keys, _ = shard.gram_keys(symbols[pairs.grams - 1])
        bigrams = tallies.told(answers.filter(pc.equal(answers["step"], 1)), keys)
        every = np.bincount(shard.lang[shard.number], minlength=len(shard.langs))
        out = [pa.table({"lang": shard.langs.cast(pa.string()), "words": pa.array(np.zeros(len(every), np.int32)), "phrase": pa.nulls(len(every), pa.string()), "n": pa.array(every, pa.int64())})]
        mine = np.flatnonzero(words.first[words.place(shard.keys)])
        out.append(shard.rows(mine[:, None], words.of(shard.keys)[mine]))
        totals = bigrams.of(keys)
        mine = np.flatnonzero(bigrams.first[bigrams.place(keys)] & (totals > 0))
        out.append(shard.rows(symbols[pairs.grams[mine] - 1], totals[mine]))
        now = pairs[totals > 0]
        frequent = np.sort(now.grams[:, 0] * index.size + now.grams[:, 1])
        for _ in range(most - 2):
            now = index.left(now)
            # the first two words of an extension must be a frequent bigram too
            head = now.grams[:, 0] * index.size + now.grams[:, 1]
            place = np.minimum(np.searchsorted(frequent, head), max(0, len(frequent) - 1))
            now = now[frequent[place] == head] if len(frequent) else now
            out.append(shard.rows(symbols[now.grams - 1], now.count))
        return pa.concat_tables(out)

    return count


def counts(docs: DataFrame, least: int = LEAST, most: int = MOST, batch_bytes: int = tallies.BATCH_BYTES, shard_words: int = tallies.SHARD_WORDS) -> DataFrame:
    """lang, words, phrase, n of all words and phrases of up to ``most`` words that a language has ``least`` times.

    A row with 0 words and no phrase counts all words of a language.
    """
    if most < 2 or least < 1:
        raise ValueError("phrases have two words at least, and occur")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    source = docs.select("doc_id", lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = tallies.deal(source, batch_bytes, shard_words)
    by_batch = dealt.docs.groupBy("batch")
    words = tallies.answers(by_batch.applyInArrow(_words(dealt.shards), tallies.REQUEST), least)
    asked = by_batch.cogroup(words.groupBy("batch")).applyInArrow(_bigrams(dealt.shards), tallies.REQUEST)
    told = words.selectExpr("0 AS step", "*").unionByName(tallies.answers(asked, least).selectExpr("1 AS step", "*"))
    found = by_batch.cogroup(told.groupBy("batch")).applyInArrow(_counts(most), COUNTED)
    return found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter((F.col("words") == 0) & (F.col("n") > 0) | (F.col("n") >= least))


def scored(counted: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every candidate among ``counts``, at its lowest-scoring cut."""
    parts = F.split("phrase", " ")
    some = counted.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), parts.alias("w"))
    cuts = some.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumn("head", F.expr("array_join(slice(w, 1, k), ' ')")).withColumn("tail", F.expr("array_join(slice(w, k + 1, words), ' ')")).drop("w")
    # counts have one row per language and phrase
    known = counted.filter("words > 0").select("lang", "phrase", "n")
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    # a * a * 10^6 takes 38 digits at most, and the score is 10^6 at most
    wide = "cast({} AS decimal(16, 0))".format
    top = f"cast({wide('a')} * {wide('a')} AS decimal(32, 0)) * 1000000"
    cuts = cuts.withColumn("score", F.expr(f"cast({top} AS decimal(38, 0)) div ({wide('l')} * {wide('r')})"))
    lowest = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return lowest.select("lang", "phrase", "words", "a", "m.l", "m.r", "m.score")


def uncovered(candidates: DataFrame, percent: int = COVERED) -> DataFrame:
    """``candidates`` without those of which a longer one has ``percent`` hundredths of the occurrences or more."""
    w = F.split("phrase", " ").alias("w")
    inner = candidates.filter("words > 2").select("lang", "a", "words", w)
    inner = inner.withColumn("m", F.explode(F.expr("sequence(2, words - 1)"))).withColumn("at", F.explode(F.expr("sequence(1, words - m + 1)")))
    longest = inner.select("lang", F.expr("array_join(slice(w, at, m), ' ')").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    gone = F.coalesce(100 * F.col("longer") >= percent * F.col("a"), F.lit(False))
    return candidates.join(longest, ["lang", "phrase"], "left").filter(~gone).drop("longer")


def mined(docs: DataFrame, least: int = LEAST, most: int = MOST, limit: int = RANKED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``limit`` phrases of every language of ``docs`` (doc_id, text, lang)."""
    counted = store(counts(docs, least, most))
    return ranked(uncovered(store(scored(counted))), counted.filter("words = 0"), limit)


def ranked(phrases: DataFrame, totals: DataFrame, limit: int = RANKED) -> DataFrame:
    """The first ``limit`` of every language, with its number of words n."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of every slice of a language, then the first of those
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= limit)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= limit)
    # one row per language
    return best.join(totals.select("lang", "n"), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
