"""Toxicity by a factorization machine over hashed terms.

Terms are a text's lower-cased words and the first letters of its longer words, hashed to
``BUCKETS``; all of them enter. Besides a weight, every term has a vector; the inner products of the vectors of
the terms that occur together let a pair of terms say more than the sum of the two, also where
neither says anything alone. The pairs of a text of more than ``PAIR_TERMS`` terms count in proportion less, as there are so many
of them. Weights are learned by the follow-the-regularised-leader rule, which leaves those at zero that the
labels do not call for, vectors by adaptive steps; both together, none is chosen beforehand.

The model is fitted on at most ``FIT_ROWS`` labelled rows of each class, those with the
lowest hash, in one task, which gets the numbers of their terms, not their texts. Rows weigh what their class is sampled at, so
a score does not depend on how many rows were left out; the rarer class weighs more by the square root of the odds.
The model has at most ``BUCKETS`` terms. Every text is scored.

Defined results: a null or empty text gets the score of no terms, like any text without
known terms; without labels of both classes every score is the share of label 1 (0.0 if
there are none); repeated rows are scored once each; an empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.tables import few_at_once, lowest_hashes
from epiframe.llm.words import fold, letter_words, slices

FIT_ROWS = 8000
BUCKETS = 1 << 20
START_LETTERS = 4
PAIR_TERMS = 30
FACTORS, EPOCHS, BATCH = 4, 15, 64
#: Steps of weights and vectors, what a weight must be called for before it leaves zero, and the decay of vectors.
RATE, VECTOR_RATE, LEAST_CALL, DECAY = 3.0, 0.03, 8.0, 1e-4
START = 0.05
THRESHOLD = 0.7
#: Characters whose terms a task holds at once.
SLICE_CHARS = 2_000_000


def word_terms(word: str) -> list[int]:
    """Hashed terms of a word."""
    found = [xxhash.xxh32_intdigest(word) % BUCKETS]
    if len(word) > START_LETTERS:
        found.append(xxhash.xxh32_intdigest("^" + word[:START_LETTERS]) % BUCKETS)
    return found


def presence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed term of every distinct term of every text."""
    words, number, row = letter_words(texts)
    terms = [word_terms(w) for w in words]
    first = np.array([t[0] for t in terms], np.int64)[number] if words else np.zeros(0, np.int64)
    second = np.array([t[-1] for t in terms], np.int64)[number] if words else np.zeros(0, np.int64)
    keys = np.unique(np.concatenate([row * BUCKETS + first, row * BUCKETS + second]))
    return keys // BUCKETS, keys % BUCKETS


class Machine:
    """score(x) = logistic(bias + sum of weights + scaled sum over pairs of inner products)."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, vectors: np.ndarray, bias: float):
        self.terms, self.weights, self.vectors, self.bias = terms, weights, vectors, bias

    def score(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        if not len(self.terms):
            return np.full(n, 1 / (1 + np.exp(-self.bias)))
        sizes = np.bincount(rows, minlength=n)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        rows, at = rows[known], at[known]
        total, pairs = np.full(n, self.bias) + np.bincount(rows, self.weights[at], n), np.zeros(n)
        for k in range(self.vectors.shape[1]):
            v = self.vectors[at, k].astype(np.float64)
            pairs += 0.5 * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return 1 / (1 + np.exp(-np.clip(total + pairs * pair_scale(sizes), -30, 30)))


def pair_scale(terms: np.ndarray) -> np.ndarray:
    """What the pairs of a text with so many terms count."""
    return np.minimum(1.0, PAIR_TERMS / np.maximum(terms, 1))


def train(rows: np.ndarray, terms: np.ndarray, labels: np.ndarray, shares: tuple[float, float] = (1.0, 1.0), seed: int = 7) -> Machine:
    """Learn from the terms of texts (as ``presence`` gives them) and their labels; ``shares`` are the sampling rates of labels 0 and 1."""
    n, toxic = len(labels), float(labels.sum())
    if not 0 < toxic < n:
        return Machine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS), np.float32), 30.0 if n and toxic else -30.0)
    odds = ((n - toxic) / shares[0]) / (toxic / shares[1])
    # the weight of a row with label 1, beside rows with label 0
    heavy = shares[0] / shares[1] * max(1.0, odds**0.5)
    kept, at = np.unique(terms, return_inverse=True)
    at, bounds = at.ravel(), np.searchsorted(rows, np.arange(n + 1))
    scale = pair_scale(np.diff(bounds))
    rng = np.random.default_rng(seed)
    weights, called, gw = np.zeros(len(kept)), np.zeros(len(kept)), np.ones(len(kept))
    vectors, gv = rng.normal(0, START, (len(kept), FACTORS)), np.ones(len(kept))
    bias, gb = float(np.log(heavy * toxic / (n - toxic))), 1.0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            lengths = bounds[batch + 1] - bounds[batch]
            place = np.repeat(bounds[batch], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            owner = np.repeat(np.arange(len(batch)), lengths)
            used, term = np.unique(at[place], return_inverse=True)
            term = term.ravel()
            v = vectors[used][term]
            sums = np.stack([np.bincount(owner, v[:, k], len(batch)) for k in range(FACTORS)], 1)
            squares = np.bincount(owner, (v * v).sum(1), len(batch))
            total = bias + np.bincount(owner, weights[used][term], len(batch)) + 0.5 * ((sums**2).sum(1) - squares) * scale[batch]
            error = (1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels[batch]) * np.where(labels[batch] > 0, heavy, 1.0)
            slope = np.bincount(term, error[owner], len(used))
            grown = gw[used] + slope**2
            called[used] += slope - (np.sqrt(grown) - np.sqrt(gw[used])) / RATE * weights[used]
            gw[used], now = grown, called[used]
            weights[used] = -np.sign(now) * np.maximum(np.abs(now) - LEAST_CALL, 0) * RATE / np.sqrt(grown)
            pull = (error * scale[batch])[owner, None] * (sums[owner] - v)
            slopes = np.stack([np.bincount(term, pull[:, k], len(used)) for k in range(FACTORS)], 1) + DECAY * vectors[used]
            gv[used] += (slopes**2).sum(1)
            vectors[used] -= VECTOR_RATE * slopes / np.sqrt(gv[used])[:, None]
            gb += error.sum() ** 2
            bias -= VECTOR_RATE * error.sum() / np.sqrt(gb)
    return Machine(kept.astype(np.int64), weights, vectors.astype(np.float32), float(bias))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = FIT_ROWS) -> Machine:
    """Learn from the texts of ``docs`` whose doc_id has a label (doc_id, toxic) of 0 or 1.

    An id with both labels counts as 1; of ids that repeat in ``docs`` every row counts.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    # choose by id first: only the chosen rows carry their texts
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    present = marks.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    chosen = lowest_hashes(present, ["toxic"], F.xxhash64("doc_id"), per_class)
    # two rows
    there = {r["toxic"]: r["count"] for r in present.groupBy("toxic").count().collect()}
    shares = tuple(min(1.0, per_class / there.get(label, 1)) for label in (0, 1))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_CHARS):
            owner, terms = presence(batch["text"])
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            held = [terms[a:b].astype(np.int32).tobytes() for a, b in zip(ends, ends[1:])]
            keys = [xxhash.xxh64_intdigest(t or "") >> 1 for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(keys, pa.int64()), pa.array(held, pa.binary())], names=["toxic", "h", "terms"])

    texts = few_at_once(source.join(F.broadcast(chosen), "doc_id").select("text", "toxic"))
    rows = texts.mapInArrow(numbered, "toxic int, h long, terms binary").withColumn("one", F.lit(1))

    def learn(table: pa.Table) -> pa.Table:
        # the order of rows decides the order of the descent
        table = table.sort_by([("h", "ascending"), ("toxic", "ascending")])
        terms = [np.frombuffer(t, np.int32) for t in table["terms"].to_pylist()]
        owner = np.repeat(np.arange(len(terms), dtype=np.int32), [len(t) for t in terms])
        machine = train(owner, np.concatenate(terms), table["toxic"].to_numpy().astype(float), shares)
        return pa.table({"term": np.append(machine.terms, -1), "weight": np.append(machine.weights, machine.bias), "vector": pa.array([v.tobytes() for v in machine.vectors] + [b""], pa.binary())})

    model = rows.groupBy("one").applyInArrow(learn, "term long, weight double, vector binary").toArrow().sort_by("term")
    if not model.num_rows:
        return train(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    weights = model["weight"].to_numpy()
    return Machine(model["term"].to_numpy()[1:], weights[1:], np.frombuffer(b"".join(model["vector"].to_pylist()), np.float32).reshape(-1, FACTORS), float(weights[0]))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and the score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_CHARS):
            rows, terms = presence(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(shared.value.score(rows, terms, batch.num_rows))], names=["doc_id", "score"])

    source = few_at_once(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, score double")


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that are not held out."""
    return labels.filter(fold("doc_id", 3) != 1)
