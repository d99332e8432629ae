"""Quality by the perplexity of an interpolated modified Kneser-Ney trigram model.

The model is trained on all trusted text: the documents with quality label 1 in seven of ten folds
(at most ``FIT_DOCUMENTS`` of a language, those with the lowest hash of their id, if that is set). Tasks
count the trigrams of slices of text and send them as sorted arrays to the shard of their last two words;
a shard sums them and knows every continuation count of its bigrams. An n-gram seen once leaves
the shard as part of a sum alone: what a context's frequent n-grams leave of its total is the number seen once.
Trigrams and bigrams seen once, and words
seen once, are left out of the tables once the weights are known. What they had goes to the
lower order: the weight of a context is the share its kept n-grams leave, over the share that the lower
order gives to all other words. What the kept words leave is divided evenly among the words
left out and one more that stands for any unseen word. So the probabilities of all words of the training text and an unseen
one sum to one after every context.

A table holds what a kept n-gram adds to the log probability that the lower orders give, so a text's log probability
is a plain sum over its n-grams. The ``LOCAL_ROWS`` n-grams used most go to every task, with a bitmap that tells most others
of no table; n-grams are looked up where the texts are. What may be a rarer one is asked of the tables' shards, with
the number of its text, and a shard answers with what it adds to each text. Texts are known by 64-bit hashes and do not travel.

A document's mean log probability is drawn to its language's mean as if it had
``PRIOR_WORDS`` more words, so that a few rare words do not condemn a short text. It is kept
when its perplexity is at most its language's threshold: the quantile ``QUANTILE`` over all trusted
documents of the three other folds, times exp(``MARGIN`` + ``FEW`` / their number): the fewer there are, the less
they say about what a good text of the language reads like. Without any, every text with words is kept. The mean of a language is
that of its held-out words and of ``FEW`` documents like those of all languages. Rows without a language count as one.

Defined results: a null, empty or blank text has no words, a null perplexity, and is not
kept; without any trusted text every text with words is kept; words are cut at white space
and told apart by case; repeated rows are scored once each; other columns are ignored, or
carried along by ``filtered``.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.llm.tables import few_at_once, lowest_hashes, store
from epiframe.llm.tallies import bytewise, whole
from epiframe.llm.words import chained, fold, slices, word_hashes

#: Trusted documents of a language to train on; None for all.
FIT_DOCUMENTS: int | None = None
QUANTILE, MARGIN, FEW = 0.995, 0.05, 10
PRIOR_WORDS = 20
#: Rows of the tables that go to every task: those used most.
LOCAL_ROWS = 1_500_000
#: Bits of the bitmap that tells most n-grams of no table, and a number of uses beyond which they are not told apart.
FILTER_BITS, MOST_USES = 1 << 30, 4095
#: Ids of trusted documents, or hashes of dropped texts, that may be broadcast.
BROADCAST_ROWS = 1_000_000
#: Characters whose n-grams a task holds at once, and n-grams of texts that ask the shards together.
SLICE_CHARS, ASK_ROWS = 2_000_000, 1_000_000
#: Text bytes whose n-grams are counted together, and text bytes of a shard, on average.
COUNT_BYTES, COUNT_SHARD = 4_000_000, 6_000_000
#: Rows that leave a task together: more would stand in the memory of both sides.
ROWS_OUT = 50_000
START = np.uint64(xxhash.xxh3_64_intdigest(b"<s>"))
#: Names of added columns, beside which documents may have columns of any usual name.
WORDS, LOGP, LOSS, LIMIT, KEEP, ROW, LANG = (f"_kn_{n}" for n in ("words", "logp", "loss", "limit", "keep", "row", "lang"))
#: Rows of the counted n-grams: bigrams (key, first word, last word, continuation count, how often a word follows), trigrams
#: (key, first bigram, last bigram, count), words (key, bigrams' continuation counts after it, bigrams that end in it), and sums.
BIGRAM, TRIGRAM, WORD, SUM = range(4)
COUNTED = "kind int, key long, a long, b long, c long, t long"


@dataclass
class Laid:
    """The hashes of the words of some texts one after the other, two starts before each text; ``at`` is where words are.

    ``last`` says which words end a text, and so are no context; ``counts`` is how many words each text has.
    """

    flat: np.ndarray
    at: np.ndarray
    last: np.ndarray
    counts: np.ndarray


def laid(texts: list[str | None]) -> Laid:
    words = [word_hashes(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    pad = np.full(2, START, np.uint64)
    flat = np.concatenate([x for w in words for x in (pad, w)] or [pad])
    real = np.ones(len(flat), bool)
    starts = np.cumsum(counts + 2) - counts - 2
    real[np.concatenate([starts, starts + 1])] = False
    at = np.flatnonzero(real)
    last = np.zeros(len(at), bool)
    last[np.cumsum(counts)[counts > 0] - 1] = True
    return Laid(flat, at, last, counts)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every key; shards follow each other as sorted keys do."""
    return (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    fresh = np.zeros(len(columns[0]), bool)
    fresh[:1] = True
    for x in columns:
        fresh[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(fresh)


def _packed(values: np.ndarray) -> bytes:
    """Compressed, with the length before: numbers of a small range shrink to what they say."""
    return len(values).to_bytes(8, "little") + bytes(pa.compress(bytewise(values), "zstd")) if len(values) else b""


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    size = int.from_bytes(data[:8], "little") * np.dtype(kind).itemsize
    return whole(pa.decompress(memoryview(data)[8:], size, "zstd", asbytes=True), kind)


def _sent(texts: list[str | None], shards: int) -> pa.RecordBatch:
    """The distinct trigrams of some texts with their counts, a row per shard of their last two words.

    They are sorted by middle, last and first word, which are numbers into the shard's distinct words;
    those at the end of a text are apart, with ``ends`` set.
    """
    lie = laid(texts)
    words, number = np.unique(lie.flat, return_inverse=True)
    number = number.ravel().astype(np.uint64)
    u, v, w = (number[lie.at - k] for k in (2, 1, 0))
    if len(words) < 1 << 21:
        keys, count = np.unique(v << np.uint64(43) | w << np.uint64(22) | u << np.uint64(1) | lie.last, return_counts=True)
        low = np.uint64((1 << 21) - 1)
        v, w, u, ends = keys >> np.uint64(43), keys >> np.uint64(22) & low, keys >> np.uint64(1) & low, keys & np.uint64(1)
    else:
        order = np.lexsort((lie.last, u, w, v))
        v, w, u, ends = v[order], w[order], u[order], lie.last[order]
        at = _starts(v, w, u, ends)
        v, w, u, ends, count = v[at], w[at], u[at], ends[at], np.diff(np.append(at, len(order)))
    home = _shard(chained(words[v], words[w]), shards).astype(np.int32)
    order = np.argsort(home, kind="stable")
    home = home[order]
    bounds = [*_starts(home).tolist(), len(home)]
    columns = {n: [] for n in ("words", "u", "v", "w", "counts", "ends")}
    for x, y in zip(bounds, bounds[1:]):
        rows = order[x:y]
        own = {"u": u[rows], "v": v[rows], "w": w[rows]}
        there = np.zeros(len(words), bool)
        for number in own.values():
            there[number] = True
        place = np.cumsum(there, dtype=np.int32) - np.int32(1)
        columns["words"].append(_packed(np.diff(words[there], prepend=np.uint64(0))))
        columns["v"].append(_packed(np.diff(place[own["v"]], prepend=np.int32(0))))
        columns["w"].append(_packed(place[own["w"]]))
        columns["u"].append(_packed(place[own["u"]]))
        columns["counts"].append(_packed(count[rows].astype(np.int64)))
        columns["ends"].append(_packed(ends[rows].astype(np.uint8)))
    return pa.RecordBatch.from_arrays([pa.array(home[bounds[:-1]].astype(np.int64)), *(pa.array(c, pa.binary()) for c in columns.values())], names=["shard", *columns])


def _summed(table: pa.Table) -> pa.Table:
    """What the trigrams of a shard say, n-grams seen once as sums alone."""
    words = [np.cumsum(_unpacked(x.as_py(), np.uint64), dtype=np.uint64) for x in table["words"]]
    read = {"u": lambda x: x, "v": lambda x: np.cumsum(x, dtype=np.int32), "w": lambda x: x}
    u, v, w = (np.concatenate([d[read[g](_unpacked(x.as_py(), np.int32))] for d, x in zip(words, table[g])]) for g in "uvw")
    count = np.concatenate([_unpacked(x.as_py(), np.int64) for x in table["counts"]])
    ends = count * np.concatenate([_unpacked(x.as_py(), np.uint8) for x in table["ends"]])
    del words
    vw, uv = chained(v, w), chained(u, v)
    uvw = chained(uv, w)
    del u
    order = np.lexsort((uvw, vw))
    at = _starts(vw[order], uvw[order])
    one = order[at]
    c3, ends = np.add.reduceat(count[order], at), np.add.reduceat(ends[order], at)
    vw, uv, uvw, v, w = (x[one] for x in (vw, uv, uvw, v, w))
    del count, order, one
    at = _starts(vw)
    c2, n, after = np.diff(np.append(at, len(vw))), np.add.reduceat(c3, at), np.add.reduceat(c3 - ends, at)
    v, w, keys = v[at], w[at], vw[at]
    again, twice = c3 > 1, n > 1
    known, place = np.unique(np.concatenate([v, w]), return_inverse=True)
    before, behind = np.split(place.ravel(), 2)
    follow, end = np.bincount(before, c2, len(known)).astype(np.int64), np.bincount(behind, minlength=len(known)).astype(np.int64)
    of = [(10 * size + k, (c == k).sum()) for size, c in ((2, c2), (3, c3)) for k in (1, 2, 3, 4)] + [(0, n[v == START].sum())]
    parts = [
        (BIGRAM, keys[twice], v[twice], w[twice], c2[twice], after[twice]),
        (TRIGRAM, uvw[again], uv[again], vw[again], c3[again], None),
        (WORD, known, None, None, follow, end),
        (SUM, np.array([k for k, _ in of], np.uint64), None, None, np.array([c for _, c in of], np.int64), None),
    ]
    names = ["kind", "key", "a", "b", "c", "t"]
    nothing = lambda x, n: pa.nulls(n, pa.int64()) if x is None else _signed(x)
    tables = [pa.table([pa.array(np.full(len(key), kind, np.int32)), *(nothing(x, len(key)) for x in (key, *rest))], names=names) for kind, key, *rest in parts]
    return pa.Table.from_batches(pa.concat_tables(tables).to_batches(max_chunksize=ROWS_OUT), tables[0].schema)


def _counted(docs: DataFrame, shards: int) -> DataFrame:
    """The n-grams of the texts that are seen twice or more, words, and sums over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, held = [], 0
        for batch in slices(batches, "text", COUNT_BYTES):
            texts += batch["text"].to_pylist()
            held += batch["text"].nbytes
            if held >= COUNT_BYTES:
                yield _sent(texts, shards)
                texts, held = [], 0
        yield _sent(texts, shards)

    sent = docs.select("text").mapInArrow(run, "shard long, words binary, u binary, v binary, w binary, counts binary, ends binary")
    return sent.groupBy("shard").applyInArrow(_summed, COUNTED)


def discounts(n: list[int]) -> list[float]:
    """The three discounts of modified Kneser-Ney smoothing, from how many n-grams have a count of 1, 2, 3 and 4."""
    n = [0, *n]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    return [min(float(k), max(0.0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.0 for k in (1, 2, 3)]


def _discount(c: str, d: list[float]) -> Column:
    return F.expr(f"case {c} when 1 then {d[0]!r} when 2 then {d[1]!r} else {d[2]!r} end").cast("double")


def _contexts(totals: DataFrame, kept: DataFrame, context: str, d: list[float], how: str) -> DataFrame:
    """The weight of the lower order after contexts, from their totals (``context``, total) and their n-grams ``kept``, seen more than once.

    What the kept ones leave of a total is the number of n-grams seen once.
    """
    own = kept.groupBy(context).agg(F.sum("c").alias("_sum"), F.sum(_discount("c", d)).alias("_free"))
    once = F.col("total") - F.coalesce("_sum", F.lit(0))
    free = F.coalesce("_free", F.lit(0.0)) + once * F.lit(d[0])
    return totals.join(own, context, how).select(context, "total", (free / F.col("total")).alias("back"))


@dataclass
class Model:
    """The kept n-grams of all orders, a row of sorted arrays per shard: key, gain, bow, and how often it was met (``uses``).

    A gain is what an n-gram adds to the log probability of its last word by the lower orders, a bow what is added after it as a context.
    Keys are hashes: those of different orders do not meet. ``unknown`` is the log probability of an unknown word,
    ``start`` what the contexts before a text's first word add to it.
    """

    tables: DataFrame
    shards: int
    unknown: float
    start: float


def train(docs: DataFrame) -> Model | None:
    """A model of the texts of ``docs``; none without words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // COUNT_SHARD))
    counted = store(_counted(docs, shards))
    words = store(counted.filter(F.col("kind") == WORD).groupBy("key").agg(F.sum("c").alias("total"), F.sum("t").alias("c")))
    c1 = words.filter("c > 0").select(F.col("key").alias("w"), "c")
    known, total, *ones = c1.agg(F.count("*"), F.sum("c"), *(F.count(F.when(F.col("c") == k, 1)) for k in (1, 2, 3, 4))).first()
    if not known:
        return None
    # nine rows
    sums = {r["key"]: r["c"] for r in counted.filter(F.col("kind") == SUM).groupBy("key").agg(F.sum("c").alias("c")).collect()}
    d1, d2, d3 = discounts(ones), *(discounts([sums[10 * size + k] for k in (1, 2, 3, 4)]) for size in (2, 3))
    # bigrams that are kept themselves or end a trigram that is; continuation counts: how many different words stand before
    asked = counted.filter(F.col("kind") == BIGRAM).select(F.col("key").alias("vw"), F.col("a").alias("v"), F.col("b").alias("w"), "c", F.col("t").alias("total"))
    c3 = counted.filter(F.col("kind") == TRIGRAM).select(F.col("key").alias("uvw"), F.col("a").alias("uv"), F.col("b").alias("vw"), "c")
    free = c1.agg(F.sum(_discount("c", d1))).first()[0] / total
    p1 = c1.select("w", "c", ((F.col("c") - _discount("c", d1)) / total + free / (known + 1)).alias("p1"))
    back2 = _contexts(words.filter("total > 0").select(F.col("key").alias("v"), "total"), asked.filter("c > 1"), "v", d2, "left")
    # every text has the context of two starts, which ends no trigram
    start = int(chained(START[None], START[None]).view(np.int64)[0])
    totals = asked.select(F.col("vw").alias("uv"), "total").union(docs.sparkSession.range(1).select(F.lit(start).alias("uv"), F.lit(sums[0]).cast("long").alias("total")))
    back3 = _contexts(totals, c3, "uv", d3, "inner")
    kept, share = p1.filter("c > 1").agg(F.count("*"), F.coalesce(F.sum("p1"), F.lit(0.0))).first()
    unknown = max(1.0 - share, 1e-9) / (known - kept + 1)
    q1 = p1.withColumn("q1", F.when(F.col("c") > 1, F.col("p1")).otherwise(unknown)).select("w", "p1", "q1")
    p2 = (F.col("c") - _discount("c", d2)) / F.col("total") + F.col("back") * F.col("p1")
    two = store(asked.drop("total").join(back2, "v").join(q1, "w").select("vw", "v", "c", p2.alias("p2"), "q1"))
    bow2 = store(_left(two.filter("c > 1"), "v", "p2", "q1"))
    low = F.coalesce("bow", F.lit(1.0)) * F.col("q1")
    lower = two.join(bow2, "v", "left").select("vw", "c", "p2", low.alias("q1")).withColumn("q2", F.when(F.col("c") > 1, F.col("p2")).otherwise(F.col("q1")))
    p3 = (F.col("c") - _discount("c", d3)) / F.col("total") + F.col("back") * F.col("p2")
    three = store(c3.join(back3, "uv").join(lower.drop("c"), "vw").select("uvw", "uv", "c", p3.alias("p3"), "q2"))
    bow3 = store(_left(three, "uv", "p3", "q2"))

    def table(rows: DataFrame, key: str, gain: Column, c: str) -> DataFrame:
        return rows.select(F.col(key).alias("key"), gain.alias("gain"), F.col(c).alias("uses"))

    def weights(rows: DataFrame, key: str) -> DataFrame:
        return rows.select(F.col(key).alias("key"), F.log("bow").alias("bow"))

    one_of = table(p1.filter("c > 1"), "w", F.log("p1") - float(np.log(unknown)), "c").join(weights(bow2, "v"), "key", "full")
    two_of = table(lower.filter("c > 1"), "vw", F.log("p2") - F.log("q1"), "c").join(weights(bow3, "uv"), "key", "full")
    three_of = table(three.join(bow3, "uv"), "uvw", F.log("p3") - F.log("q2") - F.log("bow"), "c").withColumn("bow", F.lit(None).cast("double"))
    home = F.shiftright(F.shiftrightunsigned("key", 32) * F.lit(shards).cast("long"), 32)
    rows = one_of.unionByName(two_of).unionByName(three_of).withColumn("shard", home)
    tables = store(rows.groupBy("shard").applyInArrow(_table, TABLE))
    begins = np.array([START, chained(START[None], START[None])[0]])

    def found(t: Table) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([float(t.bow[np.isin(t.keys, begins)].sum())])], names=["bow"])

    return Model(tables, shards, float(np.log(unknown)), _of_tables(tables, found, "bow double").agg(F.sum("bow")).first()[0] or 0.0)


def _left(kept: DataFrame, context: str, p: str, lower: str) -> DataFrame:
    """Per context the weight of the lower order for the words of which no n-gram is kept."""
    rest = lambda c: F.greatest(1 - F.sum(c), F.lit(1e-12))
    return kept.groupBy(context).agg((rest(p) / rest(lower)).alias("bow"))


TABLE = "shard long, keys binary, gain binary, bow binary, uses binary"


def _table(rows: pa.Table) -> pa.Table:
    """The rows of a shard as one row of arrays in the order of their keys."""
    keys = rows["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    values = [np.nan_to_num(rows[c].to_numpy().astype(np.float64))[order] for c in ("gain", "bow")]
    uses = np.minimum(np.nan_to_num(rows["uses"].to_numpy().astype(np.float64))[order], MOST_USES).astype(np.int32)
    columns = [np.diff(keys[order], prepend=np.uint64(0)), *values, uses]
    return pa.table({"shard": rows["shard"][:1], **{n: pa.array([_packed(x)], pa.binary()) for n, x in zip(("keys", "gain", "bow", "uses"), columns)}})


class Table:
    """Rows of a shard, or of all, as arrays sorted by key."""

    def __init__(self, keys: np.ndarray, gain: np.ndarray, bow: np.ndarray, uses: np.ndarray):
        self.keys, self.gain, self.bow, self.uses = keys, gain, bow, uses
        # keys are hashes, so their first bits say about where they stand
        self.shift = np.uint64(64 - max(1, len(keys).bit_length()))
        self.begins = np.searchsorted(keys, np.arange(1 << 64 - int(self.shift), dtype=np.uint64) << self.shift).astype(np.int32)

    @staticmethod
    def of(row: dict[str, bytes]) -> "Table":
        keys = np.cumsum(_unpacked(row["keys"], np.uint64), dtype=np.uint64)
        return Table(keys, _unpacked(row["gain"], np.float64), _unpacked(row["bow"], np.float64), _unpacked(row["uses"], np.int32))

    def filter(self, rows: np.ndarray) -> "Table":
        return Table(self.keys[rows], self.gain[rows], self.bow[rows], self.uses[rows])

    def values(self, keys: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What every n-gram adds, the ``last`` of a text without bow, and whether it is there at all."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        at, end = self.begins[keys >> self.shift], len(self.keys) - 1
        np.minimum(at, end, out=at)
        behind = np.flatnonzero((self.keys[at] < keys) & (at < end))
        while len(behind):
            at[behind] += 1
            behind = behind[(self.keys[at[behind]] < keys[behind]) & (at[behind] < end)]
        there = self.keys[at] == keys
        return np.where(there, self.gain[at] + np.where(last, 0.0, self.bow[at]), 0.0), there


def _of_tables(tables: DataFrame, what, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield what(Table.of({n: batch[n][k].as_py() for n in ("keys", "gain", "bow", "uses")}))

    return tables.mapInArrow(run, schema)


def _head(model: Model, local_rows: int) -> tuple[int, Table, np.ndarray]:
    """The n-grams that go to every task, those used ``least`` times and more, and a bitmap with the first bits of all keys.

    ``least`` is chosen so that they are at most ``local_rows``; it is 0 if all are. The bitmap says of most others that they are in no table;
    it has at most ``FILTER_BITS`` bits.
    """

    def used(t: Table) -> pa.RecordBatch:
        uses, n = np.unique(t.uses, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(uses.astype(np.int64)), pa.array(n.astype(np.int64))], names=["uses", "n"])

    # at most MOST_USES rows
    found = sorted((r["uses"], r["n"]) for r in _of_tables(model.tables, used, "uses long, n long").groupBy("uses").agg(F.sum("n").alias("n")).collect())
    rows = sum(n for _, n in found)
    least, left = 0, rows
    for uses, n in found:
        if left <= local_rows:
            break
        least, left = uses + 1, left - n

    def often(t: Table) -> pa.RecordBatch:
        t = t.filter(t.uses >= least)
        return pa.RecordBatch.from_arrays([_signed(t.keys), pa.array(t.gain), pa.array(t.bow)], names=["key", "gain", "bow"])

    # at most local_rows rows
    head = _of_tables(model.tables, often, "key long, gain double, bow double").toArrow()
    keys = head["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shift = 64 - int(min(FILTER_BITS, max(1 << 10, 16 * rows)).bit_length() - 1)

    def bits(t: Table) -> pa.RecordBatch:
        at = t.keys >> np.uint64(shift)
        first = int(at[0]) >> 3 if len(at) else 0
        flags = np.zeros((int(at[-1]) >> 3) - first + 1 << 3 if len(at) else 0, np.uint8)
        flags[at - np.uint64(8 * first)] = 1
        return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["first", "bits"])

    bitmap = np.zeros(1 << 61 - shift, np.uint8)
    for first, piece in zip(*(c.to_pylist() for c in _of_tables(model.tables, bits, "first long, bits binary").toArrow().columns)):
        bitmap[first : first + len(piece)] |= np.frombuffer(piece, np.uint8)
    return least, Table(keys[order], *(head[c].to_numpy()[order] for c in ("gain", "bow")), np.zeros(0, np.int32)), bitmap


def _met(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in a table: places in ``keys``."""
    at = keys >> np.uint64(61 - (len(bitmap).bit_length() - 1))
    return np.flatnonzero(bitmap[at >> np.uint64(3)] & (np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8)))


def _grouped(asked: list[tuple], rows: list, counts: list, sums: list, shards: int) -> pa.RecordBatch:
    """What texts ask of the shards, a row for each, and one with the texts themselves, what is known of them so far."""
    rows, counts, sums = np.concatenate(rows), np.concatenate(counts), np.concatenate(sums)
    keys, docs = (np.concatenate(x) for x in zip(*asked))
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order].astype(np.int32)
    home = _shard(keys, shards)
    bounds = [*_starts(home).tolist(), len(home)]
    group = int(np.uint64(xxhash.xxh3_64_intdigest(rows.tobytes())).view(np.int64))
    parts = [(int(home[a]), False, _packed(np.diff(keys[a:b], prepend=np.uint64(0))), _packed(docs[a:b]), b"") for a, b in zip(bounds, bounds[1:])]
    parts.append((group % shards, True, rows.tobytes(), counts.tobytes(), sums.tobytes()))
    kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*parts), kinds)]
    return pa.RecordBatch.from_arrays([pa.array([group] * len(parts), pa.int64()), *columns], names=["group", "shard", "own", "keys", "docs", "sums"])


ASKED = "group long, shard long, own boolean, keys binary, docs binary, sums binary"


def _answered(least: int):
    def answer(asked: pa.Table, tables: pa.Table) -> pa.Table:
        """For every group what the shard's rows add to its texts; texts pass as they are."""
        held = [Table.of({n: tables[n][k].as_py() for n in ("keys", "gain", "bow", "uses")}) for k in range(tables.num_rows)]
        rare = [t.filter(t.uses < least) for t in held]
        out = []
        for k in range(asked.num_rows):
            group, shard, own, keys, docs, sums = (asked[n][k].as_py() for n in ("group", "shard", "own", "keys", "docs", "sums"))
            if own:
                out.append((group, shard, own, keys, docs, sums))
                continue
            keys, docs = np.cumsum(_unpacked(keys, np.uint64), dtype=np.uint64), _unpacked(docs, np.int32)
            for t in rare:
                value, there = t.values(keys, docs & 1 > 0)
                number, place = np.unique(docs[there] >> 1, return_inverse=True)
                if len(number):
                    out.append((group, shard, own, b"", _packed(number), np.bincount(place.ravel(), value[there]).tobytes()))
        return pa.Table.from_pylist([dict(zip(("group", "shard", "own", "keys", "docs", "sums"), x)) for x in out], schema=_ASKED)

    return answer


_ASKED = pa.schema([("group", pa.int64()), ("shard", pa.int64()), ("own", pa.bool_()), ("keys", pa.binary()), ("docs", pa.binary()), ("sums", pa.binary())])


def _told(table: pa.Table) -> pa.Table:
    """The texts of a group with all their sums; a group that comes twice, as its texts do, counts once."""
    table = table.sort_by([("own", "descending"), ("shard", "ascending")])
    rows, counts, sums = (np.frombuffer(table[n][0].as_py(), k) for n, k in (("keys", np.int64), ("docs", np.int64), ("sums", np.float64)))
    sums = sums.copy()
    done = None
    for k in range(table.num_rows):
        shard, own = table["shard"][k].as_py(), table["own"][k].as_py()
        if not own and shard != done:
            sums[_unpacked(table["docs"][k].as_py(), np.int32)] += np.frombuffer(table["sums"][k].as_py(), np.float64)
            done = shard
    return pa.table({ROW: pa.array(rows), WORDS: pa.array(counts), LOGP: pa.array(sums)})


def _row(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def text_sums(docs: DataFrame, model: Model, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """``ROW`` (the hash of a text), ``WORDS`` and ``LOGP``, the sum of their log probabilities, of every different text of ``docs``."""
    least, head, bitmap = _head(model, local_rows)
    shared, unknown, start, shards = docs.sparkSession.sparkContext.broadcast((head, bitmap)), model.unknown, model.start, model.shards
    summed = f"{ROW} long, {WORDS} long, {LOGP} double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, bitmap = shared.value
        kept, held, texts = ([], [], [], []), 0, 0
        for batch in slices(batches, "text", SLICE_CHARS):
            lie = laid(batch["text"].to_pylist())
            n, row = len(lie.at), np.repeat(np.arange(len(lie.counts)), lie.counts)
            pairs = chained(lie.flat[:-1], lie.flat[1:])
            keys = np.concatenate([lie.flat[lie.at], pairs[lie.at - 1], chained(pairs[lie.at - 2], lie.flat[lie.at])])
            met = _met(bitmap, keys)
            keys, word = keys[met], met % max(n, 1)
            value, there = head.values(keys, lie.last[word])
            sums = lie.counts * unknown + (lie.counts > 0) * start + np.bincount(row[word], value, len(lie.counts))
            if not least:
                yield pa.RecordBatch.from_arrays([batch[ROW], pa.array(lie.counts), pa.array(sums)], names=[ROW, WORDS, LOGP])
                continue
            word = word[~there]
            ask = keys[~there], (texts + row[word]) * 2 + lie.last[word]
            for parts, x in zip(kept, (ask, batch[ROW].to_numpy(), lie.counts, sums)):
                parts.append(x)
            held, texts = held + len(word), texts + batch.num_rows
            if held >= ASK_ROWS:
                yield _grouped(*kept, shards)
                kept, held, texts = ([], [], [], []), 0, 0
        if texts:
            yield _grouped(*kept, shards)

    rows = docs.select(_row().alias(ROW), "text")
    if not least:
        return rows.mapInArrow(run, summed).dropDuplicates([ROW])
    asked = rows.mapInArrow(run, ASKED)
    answers = asked.groupBy("shard").cogroup(model.tables.groupBy("shard")).applyInArrow(_answered(least), ASKED)
    return answers.groupBy("group").applyInArrow(_told, summed).dropDuplicates([ROW])


def log_probabilities(docs: DataFrame, model: Model, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """``docs`` (with a column text) and two more: ``WORDS``, and ``LOGP``, the sum of their log probabilities."""
    return docs.withColumn(ROW, _row()).join(store(text_sums(docs, model, local_rows)), ROW).drop(ROW)


def trusted(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts to train on and texts to set thresholds by: id, language and text of documents with quality 1."""
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").join(good, "doc_id").withColumn("fold", fold("doc_id", 10))
    parts = ids.withColumn("part", (F.col("fold") < 7).cast("int"))
    chosen = parts.filter("part = 1")
    if FIT_DOCUMENTS is not None:
        chosen = lowest_hashes(chosen, ["lang"], F.xxhash64("doc_id"), FIT_DOCUMENTS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")

    def texts(part: DataFrame) -> DataFrame:
        listed = store(part.select("doc_id").distinct())
        return rows.join(F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed, "doc_id")

    return texts(chosen), texts(parts.filter("part = 0"))


def _judged(docs: DataFrame, labels: DataFrame, local_rows: int) -> DataFrame:
    """``ROW`` and all columns but text of ``docs`` with ``WORDS``, ``LOSS`` (the logarithm of the perplexity), ``LIMIT`` and ``KEEP``."""
    base = few_at_once(docs).withColumn("lang", F.col("lang").cast("string")).withColumn("text", F.col("text").cast("string"))
    fit_on, set_by = trusted(base, labels)
    model = train(fit_on)
    # texts stay where they are: their hashes are joined
    narrow = base.withColumn(ROW, _row()).drop("text")
    if model is None:
        words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t-\r]+"), lambda w: w != "")).cast("long")
        unknown = F.lit(None).cast("double")
        return base.withColumns({ROW: _row(), WORDS: words, LOSS: unknown, LIMIT: unknown}).withColumn(KEEP, F.col(WORDS) > 0).drop("text")
    sums = store(text_sums(base, model, local_rows))
    sample = store(set_by.select("lang", _row().alias(ROW)).join(sums, ROW).filter(F.col(WORDS) > 0).select("lang", WORDS, LOGP))
    average = F.sum(LOGP) / F.sum(WORDS)
    means = sample.groupBy("lang").agg(F.count("*").alias("n"), average.alias("mean")).collect()
    pooled = sample.agg(average).first()[0] or model.unknown
    # one entry per language: the mean that short texts are drawn to
    number = {r["lang"]: r["n"] for r in means}
    mean = {r["lang"]: (r["n"] * r["mean"] + FEW * pooled) / (r["n"] + FEW) for r in means}
    loss = -(F.col(LOGP) + PRIOR_WORDS * _by_language(mean, pooled)) / (F.col(WORDS) + PRIOR_WORDS)
    cut = F.percentile_approx(LOSS, QUANTILE, 10_000)
    limits = {lang: q + MARGIN + FEW / number[lang] for lang, q in sample.withColumn(LOSS, loss).groupBy("lang").agg(cut).collect()}
    limit = _by_language(limits, float("inf"))
    out = narrow.join(sums, ROW).withColumns({LOSS: F.when(F.col(WORDS) > 0, loss), LIMIT: limit})
    return out.withColumn(KEEP, F.coalesce(F.col(LOSS) <= F.col(LIMIT), F.lit(False)))


def scored(docs: DataFrame, labels: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """doc_id, words, perplexity, threshold and keep of every row of ``docs`` (doc_id, text, lang)."""
    judged = _judged(docs.select("doc_id", "text", "lang"), labels, local_rows)
    return judged.select("doc_id", F.col(WORDS).alias("words"), F.exp(LOSS).alias("perplexity"), F.exp(LIMIT).alias("threshold"), F.col(KEEP).alias("keep"))


def _by_language(values: dict[str, float], other: float) -> Column:
    out = F.lit(other)
    for lang, value in sorted(values.items(), key=str):
        out = F.when(F.col("lang").eqNullSafe(lang), value).otherwise(out)
    return out


def filtered(docs: DataFrame, labels: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    judged = _judged(docs.select("doc_id", "text", "lang"), labels, local_rows)
    dropped = store(judged.filter(~F.col(KEEP)).select(ROW, F.col("lang").alias(LANG)).distinct())
    listed = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    same = (_row() == F.col(ROW)) & F.col("lang").cast("string").eqNullSafe(F.col(LANG))
    return docs.join(listed, same, "left_anti")
