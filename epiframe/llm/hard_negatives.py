"""Hard negatives: rows of another label that score almost as high with an anchor as its positives.

Vectors become integers, floor(``SCALE`` * x), and a score is an integer inner product. An anchor's
positives are its best rows of the same label; a row of another label is a negative of a
positive if its score is between ``LOW`` and ``HIGH`` hundredths of the positive's.

Method: BOND, a vertical scan. Rows are dealt to blocks by hash, and a block is stored by dimension:
one column for each, with the least and the greatest value in it. For each anchor the
columns are read in order of the anchor's magnitudes, the largest first. After ``STEP`` columns the score of
a row lies between what it has and the least or the most that the other columns can add; a row
that cannot be among the best, or in any positive's window, leaves the bitmap of candidates,
and the columns that follow are read for what is left in it. At the last column scores are exact. Positives are
sought first, in all blocks, and merged; their scores are the windows of a second scan.

Anchors meet the blocks in chunks, so a task holds one block and one chunk.

Defined results: rows with a null id, a null label, a null or empty vector or a null or non-finite
component take no part, nor do those whose components are so large that a score might pass 64 bits
(about a million at 64 dimensions); rows that repeat an id count as one, that with the smallest label
and vector; vectors of another length are not compared; ties go to the smaller id; an anchor without positives,
or whose windows are empty, gives no rows, as does an empty table; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiframe.llm.tables import store

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
#: Bytes of a block of columns, and of a chunk of anchors.
BLOCK_BYTES, CHUNK_BYTES = 4_000_000, 4_000_000
#: Columns read between two looks at the bitmap.
STEP = 4
BLOCKS = "dim int, block long, ids binary, labels array<string>, label_of binary, columns binary, least binary, most binary"
FOUND = "anchor_id long, vec_id long, score long"
MINED = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _integers(df: DataFrame, vec_id: str, label: str, vector: str) -> DataFrame:
    """vec_id, label (as text), dim and the integer vector q of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter((F.size("v") > 0) & finite)
    # the square of a component, times the dimensions, stays below 2 ** 63
    small = F.forall("v", lambda x: F.abs(x) * SCALE + 1 < F.sqrt(F.lit(2.0**62) / F.size("v")))
    q = F.transform("v", lambda x: F.floor(x * SCALE).cast("long"))
    rows = rows.filter(small).select("vec_id", F.struct("label", q.alias("q")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q", F.size("row.q").alias("dim"))


def _vertical(key: tuple, rows: pa.Table) -> pa.Table:
    """A block by dimension."""
    rows = rows.sort_by("vec_id").combine_chunks()
    x = rows["q"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    columns = np.ascontiguousarray(x.T)
    names = rows["label"].combine_chunks().dictionary_encode()
    cells = {
        "dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()), "ids": [rows["vec_id"].to_numpy().astype(np.int64).tobytes()],
        "labels": pa.array([names.dictionary.to_pylist()], pa.list_(pa.string())), "label_of": [names.indices.to_numpy().astype(np.int32).tobytes()], "columns": [columns.tobytes()],
        "least": [columns.min(1).tobytes()], "most": [columns.max(1).tobytes()],
    }
    return pa.table({k: v if isinstance(v, pa.Array) else pa.array(v, pa.binary()) for k, v in cells.items()})


class Block:
    """The columns of a block, and the scan over them."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels, self.label_of = row["labels"], np.frombuffer(row["label_of"], np.int32)
        self.columns = np.frombuffer(row["columns"], np.int64).reshape(-1, len(self.ids))
        self.least, self.most = (np.frombuffer(row[k], np.int64) for k in ("least", "most"))

    def labelled(self, label: str) -> np.ndarray:
        return self.label_of == (self.labels.index(label) if label in self.labels else -1)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` that ``keep(lower, upper)`` never gave up, and their exact scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.least, anchor * self.most])[:, order]
        # what the columns behind each can still add
        after = [np.append(np.cumsum(x[::-1])[::-1], 0) for x in (ends.min(0), ends.max(0))]
        score = np.zeros(len(rows), np.int64)
        for k in range(0, len(order), STEP):
            for d in order[k : k + STEP].tolist():
                if anchor[d]:
                    score += anchor[d] * self.columns[d][rows]
            done = min(k + STEP, len(order))
            alive = keep(score + after[0][done], score + after[1][done])
            if not alive.all():
                rows, score = rows[alive], score[alive]
            if not len(rows):
                break
        return rows, score


def best(k: int):
    """Keeps rows that may be among the ``k`` of the highest scores."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else np.ones(len(lower), bool)

    return keep


def in_windows(windows: list[tuple[int, int]], k: int):
    """Keeps rows that may be among the ``k`` of the highest scores within one of the windows."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        alive = np.zeros(len(lower), bool)
        for low, high in windows:
            sure = lower[(lower >= low) & (upper <= high)]
            least = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) > k else low
            alive |= (upper >= least) & (lower <= high)
        return alive

    return keep


def first(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` highest scores, ties by smaller id."""
    return np.lexsort((ids, -score))[:k]


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _positives(k: int):
    def search(key: tuple, blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[int]] = [[], [], []]
        for row in blocks.to_pylist():
            block = Block(row)
            for anchor in anchors.to_pylist():
                rows = np.flatnonzero(block.labelled(anchor["label"]) & (block.ids != anchor["vec_id"]))
                rows, score = block.scan(np.array(anchor["q"], np.int64), rows, best(k))
                top = first(block.ids[rows], score, k)
                for column, values in zip(out, ([anchor["vec_id"]] * len(top), block.ids[rows[top]].tolist(), score[top].tolist())):
                    column += values
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor_id", "vec_id", "score"), out)})

    return search


def _negatives(k: int, low: int, high: int):
    def search(key: tuple, blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[int]] = [[], [], [], [], []]
        for row in blocks.to_pylist():
            block = Block(row)
            for anchor in anchors.to_pylist():
                windows = [window(p["score"], low, high) for p in anchor["positives"]]
                rows, score = block.scan(np.array(anchor["q"], np.int64), np.flatnonzero(~block.labelled(anchor["label"])), in_windows(windows, k))
                for positive, (least, most) in zip(anchor["positives"], windows):
                    inside = np.flatnonzero((score >= least) & (score <= most))
                    top = inside[first(block.ids[rows[inside]], score[inside], k)]
                    values = [[x] * len(top) for x in (anchor["vec_id"], positive["vec_id"], positive["score"])]
                    for column, some in zip(out, (*values, block.ids[rows[top]].tolist(), score[top].tolist())):
                        column += some
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, out)})

    return search


def _met(vertical: DataFrame, anchors: DataFrame, chunks: DataFrame, search, schema: str) -> DataFrame:
    """``search`` over every block and chunk of anchors of one length."""
    at = ["dim", "block", "chunk"]
    blocks = vertical.join(F.broadcast(chunks.select("dim", "chunks")), "dim").withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)")))
    dealt = anchors.join(F.broadcast(chunks.select("dim", "blocks")), "dim").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    return blocks.drop("chunks").groupBy(*at).cogroup(dealt.drop("blocks").groupBy(*at)).applyInArrow(search, schema)


def _top(found: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(
    df: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows where ``anchors`` (of the column vec_id) holds.
    """
    rows = store(_integers(df, vec_id, label, vector))
    some = rows.filter(anchors)
    # one row per length of vectors
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(anchors, 1)).alias("m"))
    sizes = sizes.selectExpr("dim", "ceil(n * dim * 8 / {}) AS blocks".format(BLOCK_BYTES), "greatest(1, ceil(m * dim * 8 / {})) AS chunks".format(CHUNK_BYTES))
    sizes = store(sizes.filter("chunks > 0"))
    placed = rows.join(F.broadcast(sizes.select("dim", "blocks")), "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    vertical = store(placed.select("dim", "block", "vec_id", "label", "q").groupBy("dim", "block").applyInArrow(_vertical, BLOCKS))
    chunked = some.join(F.broadcast(sizes.select("dim", "chunks")), "dim").withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), "chunks")).drop("chunks")
    found = _met(vertical, chunked, sizes, _positives(positives), FOUND)
    chosen = _top(found, ["anchor_id"], "score", "vec_id", positives)
    chosen = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    ready = store(chunked.join(chosen.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))
    windows = _met(vertical, ready, sizes, _negatives(negatives, low, high), MINED)
    return _top(windows, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
