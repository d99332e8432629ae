"""Jaccard self-join of documents on word n-grams, heavy and light sets apart.

A document is the set of its distinct ``NGRAM``-word shingles as 64-bit hashes. Equal sets
are one class. Two classes link when their intersection is at least ``SIMILARITY`` of their
union (in hundredths, in integers).

* Light sets are small: a similar pair must share one of its subsets that lacks at most a
  tenth of the set. All these fixed-size subsets are enumerated; in a group that shares a
  subset of size c, sets of sizes a and b link when 100 c >= t (a + b - c), and linking all to
  the smallest loses nothing.
* Heavy sets scan inverted lists. Shingles are ordered by hash. With i common shingles, a set
  of a lacks at most a/10 of them, so of its first a/10 + m shingles a similar one has m; these
  are its postings. A set whose postings do not meet enough others is out. In short lists
  pairs are counted; a list that is long links its sets only if so many of their postings
  are in long lists that the short ones could miss a pair. This gives candidate groups.
* The sets of a candidate group meet in a task, which scans the group's own inverted lists,
  rarest shingles first, and compares exactly; it emits a spanning forest. A group that is too
  large is dealt into blocks; what has not joined the group's largest component by then meets
  every other block.

The boundary is the largest size at which enumerating subsets costs no more than scanning
``LIST_COST`` entries for every posting. Sizes whose partners may be on its other side are in both.

Defined results: a null, empty or blank text has no shingles and its own doc_id as component;
rows with the same doc_id are one document; a null doc_id links with nothing and has a null
component; repeated rows stay; an empty table gives no rows; other columns are ignored.
"""

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.llm.components import components
from epiframe.llm.tables import few_at_once, store, texts
from epiframe.llm.words import ODD, chained, mixed, slices, word_hashes

NGRAM, SIMILARITY = 3, 90
LIST_COST = 4
#: Longest inverted list whose pairs are counted one by one.
SHORT_LIST = 32
#: Shingles of a candidate group that meet in one task.
GROUP_SHINGLES = 2_000_000
#: Rows of three numbers that may be broadcast.
BROADCAST_ROWS = 1_000_000


def shingles(text: str | None, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of the whole sequence if it is shorter."""
    values = word_hashes(text, lower=True)
    if not len(values):
        return values
    size = min(n, len(values))
    out = np.full(len(values) - size + 1, size, np.uint64)
    for k in range(size):
        out = chained(out, values[k : len(values) - size + 1 + k])
    return np.unique(out)


def spare(n: int, t: int = SIMILARITY) -> int:
    """Shingles a set of n may lack in common with a similar one."""
    return n * (100 - t) // 100


def certain(n: int) -> int:
    """Postings of a set of n beyond the spare ones; never falls with n."""
    return min(n // 2, 16 + n // 25)


def postings(n: int, t: int = SIMILARITY) -> int:
    return min(n, spare(n, t) + certain(n))


def needed(n: int, t: int = SIMILARITY) -> int:
    """Postings of a set of n that any similar set has among its own."""
    return max(1, certain(-(-n * t // 100)))


def subsets(n: int, t: int = SIMILARITY) -> int:
    return sum(comb(n, k) for k in range(spare(n, t) + 1))


def boundary(t: int = SIMILARITY) -> int:
    """The largest size of a light set."""
    n = 1
    while subsets(n + 1, t) <= LIST_COST * postings(n + 1, t) or spare(n + 1, t) == 0:
        n += 1
    return n


SETS = "doc_id long, n long, d1 long, d2 long, lists array<long>, subs array<struct<c:int,s:long>>"


def sets(docs: DataFrame, n: int = NGRAM, t: int = SIMILARITY) -> DataFrame:
    """Per row: size, a 128-bit digest of the set, its postings if heavy, its subsets if light."""
    light, heavy = boundary(t), -(-(boundary(t) + 1) * t // 100)

    def enumerate_subsets(values: np.ndarray) -> list[dict]:
        parts = mixed(values * ODD[0]).tolist()
        whole, size = sum(parts), len(values)
        found = []
        for k in range(spare(size, t) + 1):
            for lost in combinations(range(size), k):
                found.append({"c": size - k, "s": (whole - sum(parts[x] for x in lost)) % (1 << 64) - (1 << 63)})
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, digests, lists, subs = [], [], [], []
            for text in batch["text"].to_pylist():
                values = shingles(text, n)
                size = len(values)
                sizes.append(size)
                digests.append(xxhash.xxh3_128_intdigest(values.tobytes()))
                lists.append(values[: postings(size, t)].view(np.int64) if size >= heavy else None)
                # a set that may lack nothing itself can be the whole of a larger one's subset
                subs.append(enumerate_subsets(values) if size <= light and 100 * size // t > size else None)
            half = [(d >> 64, d & (1 << 64) - 1) for d in digests]
            d1, d2 = (pa.array(np.array([h[k] for h in half], np.uint64).view(np.int64)) for k in (0, 1))
            kinds = pa.list_(pa.struct([("c", pa.int32()), ("s", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), d1, d2, pa.array(lists, pa.list_(pa.int64())), pa.array(subs, kinds)], names=["doc_id", "n", "d1", "d2", "lists", "subs"])

    return few_at_once(texts(docs)).mapInArrow(run, SETS)


def _needed(size: str, t: int) -> Column:
    """``needed`` as a column."""
    least = f"(({size} * {t} + 99) div 100)"
    return F.expr(f"greatest(1, least({least} div 2, 16 + {least} div 25))")


def _light_links(classes: DataFrame, t: int) -> DataFrame:
    rows = classes.filter("subs is not null").select("doc_id", "n", F.explode("subs").alias("x")).select("doc_id", "n", "x.c", "x.s")
    first = rows.groupBy("c", "s").agg(F.min(F.struct("n", "doc_id")).alias("m"), F.count("*").alias("k")).filter("k > 1").select("c", "s", "m")
    near = F.expr(f"100 * c >= {t} * (n + m.n - c)") & (F.col("doc_id") != F.col("m.doc_id"))
    return rows.join(first, ["c", "s"]).filter(near).select(F.col("doc_id").alias("a"), F.col("m.doc_id").alias("b")).distinct()


def _candidates(classes: DataFrame, t: int) -> DataFrame:
    """Pairs that join every two similar heavy sets, directly or by way of others."""
    rows = classes.filter("lists is not null").select("doc_id", "n", F.explode("lists").alias("h"))
    rows = rows.select("h", "doc_id", _needed("n", t).alias("need"))
    for _ in range(2):
        shared = rows.groupBy("h").agg(F.count("*").alias("met")).filter("met > 1")
        rows = store(rows.drop("met").join(shared, "h"))
        enough = rows.groupBy("doc_id").agg(F.count("*").alias("k"), F.max("need").alias("need")).filter("k >= need").select("doc_id")
        rows = rows.join(enough, "doc_id", "left_semi")
    rows = store(rows)
    long_ones = rows.filter(F.col("met") > SHORT_LIST)
    in_long = long_ones.groupBy("doc_id").agg(F.count("*").alias("x"))
    short = rows.filter(F.col("met") <= SHORT_LIST).join(in_long, "doc_id", "left").select("h", "doc_id", F.expr("need - coalesce(x, 0)").alias("rest"))
    left, right = (short.select("h", F.col("doc_id").alias(x), F.col("rest").alias(f"rest_{x}")) for x in "ab")
    pairs = left.join(right, "h").filter("a > b").groupBy("a", "b").agg(F.count("*").alias("k"), F.max(F.greatest("rest_a", "rest_b")).alias("rest"))
    bound = long_ones.join(in_long, "doc_id").filter("x >= need").select("h", "doc_id")
    first = bound.groupBy("h").agg(F.min("doc_id").alias("b"))
    stars = bound.join(first, "h").filter("doc_id != b").select(F.col("doc_id").alias("a"), "b").distinct()
    return pairs.filter("k >= rest").select("a", "b").unionByName(stars)


def similar(a: int, b: int, common: np.ndarray, t: int) -> np.ndarray:
    return 100 * common >= t * (a + b - common)


class Group:
    """Inverted lists over the sets of one task."""

    def __init__(self, members: list[np.ndarray], t: int):
        self.t, self.sizes = t, np.array([len(m) for m in members], np.int64)
        flat = np.concatenate([*members, np.zeros(0, np.uint64)])
        _, self.number, self.df = np.unique(flat, return_inverse=True, return_counts=True)
        self.number = self.number.ravel()
        owner = np.repeat(np.arange(len(members)), self.sizes)
        self.lists = owner[np.argsort(self.number, kind="stable")]
        self.start = np.cumsum(self.df) - self.df
        self.ends = np.cumsum(self.sizes)

    def linked(self, x: int, among: np.ndarray) -> np.ndarray:
        """Those of ``among`` (a mask over the members) that are similar to x."""
        size = self.sizes[x]
        allowed = among & (100 * self.sizes >= self.t * size) & (self.t * self.sizes <= 100 * size)
        if not allowed.any():
            return np.zeros(0, np.int64)
        mine = self.number[self.ends[x] - size : self.ends[x]]
        mine = mine[np.argsort(self.df[mine], kind="stable")]
        # some shingle of a similar set is among the first spare + 1, the rarest
        near = np.zeros(len(self.sizes), bool)
        for k in mine[: spare(int(size), self.t) + 1]:
            near[self.lists[self.start[k] : self.start[k] + self.df[k]]] = True
        near = np.flatnonzero(near & allowed)
        if not len(near):
            return near
        marked = np.zeros(len(self.df), bool)
        marked[mine] = True
        common = np.array([np.count_nonzero(marked[self.number[self.ends[y] - self.sizes[y] : self.ends[y]]]) for y in near])
        return near[similar(size, self.sizes[near], common, self.t)]

    def forest(self) -> list[tuple[int, int]]:
        """Edges that join all members that similar pairs join."""
        open_, edges = np.ones(len(self.sizes), bool), []
        for start in range(len(self.sizes)):
            queue = [start] if open_[start] else []
            open_[start] = False
            while queue:
                x = queue.pop()
                for y in self.linked(x, open_).tolist():
                    open_[y] = False
                    edges.append((x, y))
                    queue.append(y)
        return edges


def _verify(n: int, t: int):
    def verify(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows["doc_id"].to_numpy()
        edges = Group([shingles(x, n) for x in rows["text"].to_pylist()], t).forest()
        return pa.table({"a": pa.array([int(ids[x]) for x, _ in edges], pa.int64()), "b": pa.array([int(ids[y]) for _, y in edges], pa.int64())})

    return verify


def _verify_across(n: int, t: int):
    def verify(key: tuple, rows: pa.Table) -> pa.Table:
        """Rows marked ``late`` against all others that they are not joined with yet."""
        ids, late, joined = rows["doc_id"].to_numpy(), rows["late"].to_numpy(zero_copy_only=False), rows["joined"].to_numpy()
        group, edges = Group([shingles(x, n) for x in rows["text"].to_pylist()], t), []
        for x in np.flatnonzero(late).tolist():
            edges += [(x, y) for y in group.linked(x, joined != joined[x]).tolist()]
        return pa.table({"a": pa.array([int(ids[x]) for x, _ in edges], pa.int64()), "b": pa.array([int(ids[y]) for _, y in edges], pa.int64())})

    return verify


def _verified(docs: DataFrame, classes: DataFrame, groups: DataFrame, n: int, t: int) -> DataFrame:
    """Edges between similar sets of one candidate group."""
    members = groups.select(F.col("node").alias("doc_id"), "root").unionByName(groups.select(F.col("root").alias("doc_id"), "root").distinct())
    members = members.join(classes.groupBy("doc_id").agg(F.max("n").alias("n")), "doc_id")
    weight = members.groupBy("root").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).alias("blocks"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    held = store(members.join(weight, "root").select("doc_id", "root", "blocks", block.alias("block")))
    few = held.count() <= BROADCAST_ROWS
    body = texts(docs).join(F.broadcast(held) if few else held, "doc_id").select("doc_id", "root", "block", "text")
    edges = store(body.groupBy("root", "block").applyInArrow(_verify(n, t), "a long, b long"))
    large = held.filter("blocks > 1")
    if large.isEmpty():
        return edges
    # groups of several blocks: what is outside the largest component so far meets all blocks
    labels = large.join(components(edges).withColumnRenamed("node", "doc_id").withColumnRenamed("root", "joined"), "doc_id", "left").withColumn("joined", F.coalesce("joined", "doc_id"))
    sizes = labels.groupBy("root", "joined").agg(F.count("*").alias("k"))
    largest = sizes.groupBy("root").agg(F.max(F.struct("k", "joined")).alias("m")).select("root", F.col("m.joined").alias("most"))
    labels = store(labels.join(largest, "root").withColumn("late", F.col("joined") != F.col("most")).drop("most"))
    text = texts(docs).join(labels, "doc_id")
    late_blocks = labels.filter("late").select("root", F.col("block").alias("with")).distinct()
    as_late = text.filter("late").withColumn("with", F.col("block")).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    as_any = text.withColumn("late", F.lit(False)).withColumnRenamed("block", "other").join(late_blocks, "root")
    columns = ["root", "with", "other", "doc_id", "text", "late", "joined"]
    # a late row in its own block is there once, as a late one
    every = as_late.select(columns).unionByName(as_any.select(columns))
    once = every.groupBy("root", "with", "other")
    return edges.unionByName(store(once.applyInArrow(_verify_across(n, t), "a long, b long")))


def join(docs: DataFrame, n: int = NGRAM, t: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the components of similar documents."""
    found = store(sets(docs, n, t))
    some = found.filter("n > 0 and doc_id is not null")
    same = some.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("first"))
    classes = store(some.join(same.select(F.col("first").alias("doc_id")), "doc_id", "left_semi"))
    links = _light_links(classes, t)
    groups = components(_candidates(classes, t))
    links = links.unionByName(_verified(docs, classes, groups, n, t))
    copies = some.join(same, ["n", "d1", "d2"]).filter("doc_id != first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    roots = components(links.unionByName(copies))
    return found.select("doc_id", F.col("n").alias("n_shingles")).join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = NGRAM, t: int = SIMILARITY) -> DataFrame:
    """``docs`` without the near copies of a document with a smaller doc_id, and without rows that repeat one."""
    found = store(join(docs, n, t).select("doc_id", "component_id"))
    gone = found.filter("doc_id != component_id").select("doc_id").distinct()
    few = gone.count() <= BROADCAST_ROWS
    kept = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti")
    if found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return kept
    return kept.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.filter("doc_id is null"))
