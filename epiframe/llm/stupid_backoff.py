"""Stupid-backoff scores of every document under the n-gram counts of all the others.

Documents are dealt to batches by hash. A batch explodes its texts into n-grams, sums equal
ones, and sends each distinct n-gram once, with its count, to the shard of its hash: the
count tables. The shards answer with the corpus counts, joined back to the n-grams of the
batch, and scores are summed by document. A common n-gram is one row per batch, however often
it occurs, so none is hot; n-grams travel as sorted arrays of hashes, one row per batch and shard.

A word scores c(n-gram) / c(context) at the highest order at which other documents have the n-gram,
times ``ALPHA`` for every order passed over; a word that no other document has scores
ALPHA ** order / words of the others. A document's own counts are taken off first, else every
text would know itself. ``order`` is a parameter; the default keeps the shuffle below three
times the input.

Defined results: a null, empty or blank text has 0 words, a score of 0.0 and a null mean;
words are cut at white space, A-Z folded; rows that repeat a document count as other documents; a
corpus of one row has no others, which count as one word; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.tables import texts
from epiframe.llm.words import chained, word_hashes

ORDER, ALPHA = 2, 0.4
#: Text bytes of a batch, and distinct n-grams of a shard, on average.
BATCH_BYTES, SHARD_GRAMS = 6_000_000, 1_500_000
SCORES = "doc_id long, n_words long, log_score double"


def exploded(batch: list[str | None], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order the hash of the n-gram that ends at every word (0 where the text is too short), and every word's row."""
    words = [word_hashes(t, lower=True) for t in batch]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.concatenate([*words, np.zeros(0, np.uint64)])
    row = np.repeat(np.arange(len(words)), counts)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = []
    for k in range(order):
        gram = np.full(len(flat), k + 1, np.uint64)
        for back in range(k, -1, -1):
            gram = chained(gram, np.concatenate([flat[:back], flat[: max(0, len(flat) - back)]]) if back else flat)
        out.append(np.where(place >= k, gram | np.uint64(1), np.uint64(0)))
    return out, row


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, which is also the order of their shards; the shards that have any, and where each begins."""
    keys = np.unique(keys)
    keys = keys[keys != 0]
    there, first = np.unique((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), return_index=True)
    return keys, there.astype(np.int64), first


def packed(values: np.ndarray) -> bytes:
    """64-bit values byte by byte, all first bytes first: the high ones of small values shrink to nothing in the shuffle."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _requests(order: int, shards: int):
    def request(table: pa.Table) -> pa.Table:
        grams, _ = exploded(table["text"].to_pylist(), order)
        every = np.concatenate(grams)
        keys, there, first = _by_shard(every, shards)
        found, counts = np.unique(every, return_counts=True)
        count = counts[np.searchsorted(found, keys)].astype(np.int64)
        ends = [*first[1:].tolist(), len(keys)]
        batch = table["batch"][0].as_py()
        return pa.table({
            "batch": pa.array([batch] * len(there), pa.int64()), "shard": pa.array(there, pa.int64()),
            "keys": pa.array([packed(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in zip(first, ends)], pa.binary()),
            "counts": pa.array([packed(count[a:b]) for a, b in zip(first, ends)], pa.binary()),
        })

    return request


def _answer(table: pa.Table) -> pa.Table:
    """The corpus counts of the n-grams of one shard, to every batch that has them."""
    keys = [np.cumsum(unpacked(k, np.uint64), dtype=np.uint64) for k in table["keys"].to_pylist()]
    counts = [unpacked(c, np.int64) for c in table["counts"].to_pylist()]
    _, number = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(number.ravel(), np.concatenate(counts)).astype(np.int64)[number.ravel()]
    ends = np.cumsum([len(k) for k in keys])
    answers = [packed(x) for x in np.split(total, ends[:-1])]
    return pa.table({"batch": table["batch"], "shard": table["shard"], "totals": pa.array(answers, pa.binary())})


def _scores(order: int, shards: int, words: int):
    def score(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams, row = exploded(docs["text"].to_pylist(), order)
        n = np.bincount(row, minlength=docs.num_rows)
        others = np.maximum(1, words - n)[row].astype(np.float64)
        sums = np.zeros(docs.num_rows)
        if len(row):
            keys, _, _ = _by_shard(np.concatenate(grams), shards)
            answers = answers.sort_by("shard")
            totals = np.concatenate([unpacked(t, np.int64) for t in answers["totals"].to_pylist()])
            # words without an n-gram of an order share a place of their own behind all keys
            totals = np.append(totals, 0)
            log_score = order * np.log(ALPHA) - np.log(others)
            context = others
            for k, gram in enumerate(grams):
                real = gram != 0
                place = np.where(real, np.searchsorted(keys, gram), len(keys))
                pair, inverse, own = np.unique(row * (len(keys) + 1) + place, return_inverse=True, return_counts=True)
                rest = np.where(real, totals[place] - own[inverse.ravel()], 0)
                # the context of a word at the next order is the n-gram that ends at the word before it
                seen = real & (rest > 0) & (context > 0)
                ratio = np.log(np.maximum(rest, 1)) - np.log(np.maximum(context, 1))
                log_score = np.where(seen, ratio + (order - 1 - k) * np.log(ALPHA), log_score)
                context = np.concatenate([[0], rest[:-1]])
            sums = np.bincount(row, log_score, docs.num_rows)
        return pa.table({"doc_id": docs["doc_id"], "n_words": pa.array(n.astype(np.int64)), "log_score": pa.array(sums)})

    return score


def scored(docs: DataFrame, order: int = ORDER, batch_bytes: int = BATCH_BYTES, shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """doc_id, n_words, log_score (the sum over its words) and mean_log_score of every row."""
    source = texts(docs)

    def count(batches):
        for batch in batches:
            data = [(t or "").encode() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, data))], pa.int64()), pa.array([sum(len(d.split()) for d in data)], pa.int64())], names=["bytes", "words"])

    size, words = source.select("text").mapInArrow(count, "bytes long, words long").agg(F.sum("bytes"), F.sum("words")).first()
    batches, shards = max(1, -(-(size or 0) // batch_bytes)), max(1, -(-(words or 0) * order // shard_grams))
    dealt = source.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))).repartition(batches, "batch")
    requests = dealt.groupBy("batch").applyInArrow(_requests(order, shards), "batch long, shard long, keys binary, counts binary")
    answers = requests.groupBy("shard").applyInArrow(_answer, "batch long, shard long, totals binary")
    found = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_scores(order, shards, words or 0), SCORES)
    return found.withColumn("mean_log_score", F.expr("log_score / nullif(n_words, 0)"))
