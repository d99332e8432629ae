"""Language identification by known words first, then by shorter and shorter character n-grams.

Method: word-first backoff. A word seen in training scores, per language, its smoothed log
frequency there. A word never seen is looked up by its longest known character n-grams: all
5-grams of the marked word; if none of them is known, the 4-grams, and so on down to single
characters. A document's evidence is the mean over its words; the score is the probability
of the best language when the evidence counts for at most ``EVIDENCE`` words.

The model is fitted on all labelled documents (at most ``FIT_DOCUMENTS`` of a language, those
with the lowest hash of their text, if that is set), and every text is scored. Words are counted first;
the n-grams of a word are counted once, with the word's count.

Defined results: ``und`` with score 0.0 for a null text, one without letters, or when
nothing could be learned; ties go to the language that is first in the alphabet; repeated
rows are scored once each; an empty table gives no rows; other columns are ignored.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from epiframe.llm.tables import few_at_once, lowest_hashes, store
from epiframe.llm.words import fold, letter_words, slices

UNKNOWN = "und"
#: Labelled documents of a language to learn from; None for all.
FIT_DOCUMENTS: int | None = None
#: Distinct words whose n-grams are summed before they are sent.
WORDS_AT_ONCE = 50_000
#: Parts of a language's words, or n-grams of a length, that are ranked apart before all of them.
PARTS = 64
#: Most frequent words kept of each language, and n-grams of each length and language.
KEPT_WORDS, KEPT_GRAMS = 20_000, 8000
LONGEST = 5
EVIDENCE = 12


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Per key (a word, or an n-gram by its length) the log frequency in every language."""

    def __init__(self, counts: dict[tuple[int, str], dict[str, int]]):
        self.languages = sorted({lang for by in counts.values() for lang in by})
        column = {lang: k for k, lang in enumerate(self.languages)}
        totals = defaultdict(lambda: np.zeros(len(column)))
        for (n, _), by in counts.items():
            for lang, c in by.items():
                totals[n][column[lang]] += c
        sizes = Counter(n for n, _ in counts)
        self.tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        self.values = np.zeros((len(counts), len(column)))
        for row, ((n, key), by) in enumerate(sorted(counts.items())):
            self.tables[n][key] = row
            seen = np.zeros(len(column))
            for lang, c in by.items():
                seen[column[lang]] = c
            self.values[row] = np.log((seen + 0.5) / (totals[n] + 0.5 * sizes[n]))
        # only differences between languages matter
        self.values -= self.values.mean(1, keepdims=True)

    def word(self, word: str) -> np.ndarray:
        """Evidence for every language."""
        row = self.tables[0].get(word)
        if row is not None:
            return self.values[row]
        for n in range(LONGEST, 0, -1):
            rows = [r for r in map(self.tables[n].get, grams(word, n)) if r is not None]
            if rows:
                return self.values[rows].mean(0)
        return np.zeros(len(self.languages))

    def words(self, words: list[str]) -> np.ndarray:
        """``word`` for many words: known ones by one lookup each, the others level by level."""
        out = np.zeros((len(words), len(self.languages)))
        rows = np.fromiter((self.tables[0].get(w, -1) for w in words), np.int64, len(words))
        out[rows >= 0] = self.values[rows[rows >= 0]]
        left = np.flatnonzero(rows < 0)
        for n in range(LONGEST, 0, -1):
            get, owner, found = self.tables[n].get, [], []
            for w in left.tolist():
                got = [r for r in map(get, grams(words[w], n)) if r is not None]
                found += got
                owner += [w] * len(got)
            if owner:
                share = np.bincount(owner, minlength=len(words))
                for k in range(out.shape[1]):
                    total = np.bincount(owner, self.values[found, k], len(words))
                    out[:, k] += np.divide(total, share, out=np.zeros(len(words)), where=share > 0)
                left = left[share[left] == 0]
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, number, row = letter_words(texts)
        n = np.bincount(row, minlength=len(texts))
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        values = self.words(words)
        sums = np.stack([np.bincount(row, values[number, k], len(texts)) for k in range(values.shape[1])], 1)
        evidence = sums * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
        best = evidence.argmax(1)
        score = 1 / np.exp(evidence - evidence.max(1, keepdims=True)).sum(1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n)], np.where(n > 0, score, 0.0)


def fit(docs: DataFrame, per_language: int | None = FIT_DOCUMENTS) -> Model:
    """Learn from the rows of ``docs`` (lang, text) with both set; from ``per_language`` of each language at most, if that is set."""
    chosen = few_at_once(docs).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).dropna()
    if per_language is not None:
        chosen = lowest_hashes(chosen, ["lang"], F.xxhash64("text"), per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, number, row = letter_words(batch["text"])
            langs = batch["lang"].dictionary_encode()
            pairs, counts = np.unique(langs.indices.to_numpy()[row] * len(words) + number, return_counts=True)
            size = max(1, len(words))
            lang, word = langs.dictionary.take(pa.array(pairs // size)), pa.array(words, pa.string()).take(pa.array(pairs % size))
            yield pa.RecordBatch.from_arrays([lang, word, pa.array(counts, pa.int64())], names=["lang", "word", "c"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: dict) -> pa.RecordBatch:
            langs, sizes, keys = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(keys, pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "n", "gram", "c"])

        found, words = defaultdict(int), 0
        for batch in batches:
            for lang, word, c in zip(*(column.to_pylist() for column in batch.columns)):
                for n in range(1, LONGEST + 1):
                    for gram in grams(word, n):
                        found[lang, n, gram] += c
            words += batch.num_rows
            if words >= WORDS_AT_ONCE:
                yield out(found)
                found, words = defaultdict(int), 0
        yield out(found)

    counted = store(chosen.select("lang", "text").mapInArrow(count, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("c")))
    parts = counted.mapInArrow(expand, "lang string, n int, gram string, c long").groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    counted = counted.select("lang", F.lit(0).alias("n"), F.col("word").alias("gram"), "c").union(parts)
    # the most frequent of every part first, so what meets in one task is bounded
    limit = F.when(F.col("n") == 0, KEPT_WORDS).otherwise(KEPT_GRAMS)
    kept = counted.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(PARTS)))
    for groups in (["lang", "n", "part"], ["lang", "n"]):
        top = Window.partitionBy(*groups).orderBy(F.desc("c"), "gram")
        kept = kept.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= limit)
    counts: dict = defaultdict(dict)
    for lang, n, gram, c in zip(*(column.to_pylist() for column in kept.select("lang", "n", "gram", "c").toArrow().columns)):
        counts[n, gram][lang] = c
    return Model(counts)


def predict(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of every row, the predicted language of its text (lang_pred), and the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the kept words and n-grams of every language
    source = docs.select(*columns, F.col("text").cast("string").alias("_text"))
    schema = StructType([*source.schema.fields[:-1], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            langs, score = shared.value.predict(batch["_text"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(score)], names=schema.names)

    return source.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text is in a known language with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs, score = shared.value.predict(batch["text"])
            yield batch.filter(pa.array((np.array(langs, object) != UNKNOWN) & (score >= least), pa.bool_()))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents that are not held out."""
    return docs.filter(fold("doc_id", 5) != 0)
