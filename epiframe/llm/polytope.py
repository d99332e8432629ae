"""Near-duplicate vectors by cross-polytope hashing.

A hash of a vector is the signed axis nearest to it after a pseudo-random rotation, which
is three rounds of random signs and a fast Hadamard transform. ``AXES`` hashes make a key,
``TABLES`` keys a vector's places; it also probes the keys that the next nearest axes would
have made. All vectors in or probing a bucket meet in a task, which compares them with a
matrix product in double precision. A pair that meets in several buckets counts in the first table where
it can meet, which both rows' keys tell; so only counts of links and a spanning forest leave
a task, never the pairs. Buckets of more than ``BLOCK`` rows are compared block by block.

Defined results: equal vectors are hashed once and always link; vectors that are null, zero,
empty or hold null or non-finite components link with nothing; vectors of different lengths
do not link; repeated ids are separate rows that link like other equal vectors and share
one result; a null id is kept with the id null; an empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm import vectors
from epiframe.llm.components import components
from epiframe.llm.tables import store

TABLES, AXES, PROBES = 8, 2, 2
SIMILARITY = 0.9
BLOCK = 4096
#: Rows of a matrix product at once.
STRIPE = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix, in place; their length is a power of two."""
    h = 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        a, b = y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]
        y[:, :, 0], y[:, :, 1] = a, b
        h *= 2
    return x


def keys(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """Per row and table the key, followed by the keys it probes: shape (rows, TABLES, 1 + PROBES)."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), size))
    padded[:, : x.shape[1]] = x
    rng = np.random.default_rng([seed, x.shape[1]])
    out = np.zeros((len(x), TABLES, 1 + PROBES), np.int64)
    rows = np.arange(len(x))
    for table in range(TABLES):
        best, gaps, others = [], [], []
        for _ in range(AXES):
            y = padded.copy()
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size)) / np.sqrt(size)
            order = np.argpartition(-np.abs(y), min(2, size - 1), 1)[:, :3]
            values = np.take_along_axis(y, order, 1)
            rank = np.argsort(-np.abs(values), 1, kind="stable")
            order, values = np.take_along_axis(order, rank, 1), np.take_along_axis(values, rank, 1)
            code = 2 * order + (values < 0)
            best.append(code[:, 0])
            for alternative in range(1, code.shape[1]):
                gaps.append(np.abs(values[:, 0]) - np.abs(values[:, alternative]))
                others.append((len(best) - 1, code[:, alternative]))
        power = [(2 * size) ** a for a in range(AXES)]
        base = sum(b * p for b, p in zip(best, power))
        out[:, table, 0] = base
        # the probes change the one axis whose runner-up is closest, then the next
        order = np.argsort(np.stack(gaps, 1), 1, kind="stable")
        changed = np.stack([base + (code - best[a]) * power[a] for a, code in others], 1)
        for probe in range(PROBES):
            out[:, table, 1 + probe] = changed[rows, order[:, min(probe, order.shape[1] - 1)]]
    return out


def _meet(a: np.ndarray, b: np.ndarray, table: int, bucket: int) -> np.ndarray:
    """For keys of paired rows, whether this bucket of ``table`` is the first where they meet."""
    base_a, base_b = a[:, : table + 1, 0], b[:, : table + 1, 0]
    in_b, in_a = (b[:, : table + 1] == base_a[:, :, None]).any(2), (a[:, : table + 1] == base_b[:, :, None]).any(2)
    before = (in_a | in_b)[:, :table].any(1)
    places = np.stack([np.where(i[:, table], x[:, table], np.iinfo(np.int64).max) for i, x in ((in_b, base_a), (in_a, base_b))])
    return ~before & (places.min(0) == bucket)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Every node that has an edge but is not the first of its component, and that first node."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    node = np.flatnonzero(root != np.arange(n))
    return node, root[node]


def _compare(least: float):
    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        table, bucket, side = key[1].as_py(), key[2].as_py(), rows["side"].to_numpy()
        ids, counts = rows["id"].to_numpy(), rows["copies"].to_numpy()
        x = vectors.matrix(rows["v"])
        x /= np.sqrt((x * x).sum(1))[:, None]
        codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.int64).reshape(len(x), TABLES, 1 + PROBES)
        home = rows["home"].to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
        links, first, second = np.zeros(len(x), np.int64), [], []
        for start in range(0, len(left), STRIPE):
            part = left[start : start + STRIPE]
            i, j = np.nonzero(x[part] @ x[right].T >= least - 1e-9)
            i, j = part[i], right[j]
            # within one block every pair once; between two blocks a row stands on one side
            once = np.where((side[i] == 0) & (side[j] == 0), ids[i] < ids[j], True) & (home[i] | home[j])
            i, j = i[once], j[once]
            near = (x[i] * x[j]).sum(1) >= least
            i, j = i[near], j[near]
            mine = _meet(codes[i], codes[j], table, bucket)
            i, j = i[mine], j[mine]
            np.add.at(links, i, counts[j])
            np.add.at(links, j, counts[i])
            first.append(i)
            second.append(j)
        node, root = _forest(np.concatenate([*first, np.zeros(0, np.int64)]), np.concatenate([*second, np.zeros(0, np.int64)]), len(x))
        to = np.arange(len(x))
        to[node] = root
        some = np.flatnonzero(links)
        return pa.table({"id": ids[some], "links": links[some], "to": ids[to[some]]})

    return compare


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim in np.unique(batch["dim"].to_numpy()):
            some = batch.filter(pa.array(batch["dim"].to_numpy() == dim))
            codes = keys(vectors.matrix(some["v"]))
            n, spread = len(codes), TABLES * (1 + PROBES)
            take = pa.array(np.repeat(np.arange(n), spread))
            columns = [some["id"].take(take), some["copies"].take(take), some["v"].take(take)]
            columns += [pa.array(np.full(n * spread, dim, np.int32)), pa.array(np.tile(np.repeat(np.arange(TABLES, dtype=np.int32), 1 + PROBES), n)), pa.array(codes.ravel())]
            columns += [pa.array(np.tile(np.arange(1 + PROBES) == 0, n * TABLES)), pa.array([c.tobytes() for c in codes], pa.binary()).take(take)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "copies", "v", "dim", "part", "bucket", "home", "codes"])


def near_duplicates(df: DataFrame, least: float = SIMILARITY, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    source = vectors.rows(df, vec_id, vector).withColumn("good", vectors.usable("v"))
    good = source.filter("good and vec_id is not null")
    distinct = store(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")).withColumn("dim", F.size("v")))
    kind = dict(distinct.dtypes)["v"]
    schema = f"id long, copies long, v {kind}, dim int, part int, bucket long, home boolean, codes binary"
    at = ["dim", "part", "bucket"]
    placed = distinct.select("id", "copies", "v", "dim").mapInArrow(_places, schema).dropDuplicates([*at, "id"])
    # only narrow columns are counted; a bucket counts if two rows meet there and one lives there
    sizes = placed.groupBy(*at).agg(F.count("*").alias("n"), F.max("home").alias("lived")).filter("n > 1 and lived").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    held = placed.join(sizes.select(*at, "blocks"), at)
    block = F.pmod(F.xxhash64("id", "part"), F.col("blocks"))
    # every row goes to the pairs of blocks that its own is in: side 0 both, 1 and 2 one of them
    own = held.withColumn("own", block).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    dealt = own.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).withColumn("side", F.expr("case when own = other then 0 when own < other then 1 else 2 end"))
    found = store(dealt.groupBy("dim", "part", "bucket", "low", "high").applyInArrow(_compare(least), "id long, links long, to long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    classes = distinct.select("id", "v", "copies").join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    classes = classes.select("v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    linked = good.select("vec_id", "v").join(classes, "v").drop("v")
    alone = source.filter("not good or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
