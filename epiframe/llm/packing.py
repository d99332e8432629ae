"""Best-fit packing of token pieces into fixed-size sequences.

Method: hierarchical residual packing. Every partition packs its own pieces best-fit
decreasing and emits the sequences that are nearly full. What the underfull ones hold goes up a
tree of merges: a merge takes the items of ``FAN_IN`` nodes, packs them best-fit decreasing, emits what is
nearly full and hands the rest up; the last merge emits everything. Items go up apart, not as
the underfull sequence they were in: glued together they fit less well (5 % more sequences where a partition has few pieces).

A merge sees classes of items, not items: how many of every size each of its nodes has, at most
``FAN_IN`` times ``size`` rows, however many pieces there are. It answers with ranges of ranks within a class: where
they are placed, or which ranks they have one level up. Ranges are then followed from the root back
to the partitions, where every item finds its sequence by its rank. The driver learns the
number of partitions and nothing else. Pieces are rows of numbers, ids travel nowhere.

Defined results: a null or empty text is one piece holding the end id; a text longer than a
sequence is cut so that all its pieces but the first are whole sequences; repeated rows are
packed once each; an empty table gives no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm import byte_bpe
from epiframe.llm.tables import few_at_once, store, texts
from epiframe.llm.words import slices
from epiframe.storage import scratch_dir

SEQUENCE = 1024
#: Characters that a task encodes at once.
SLICE_CHARS = 2_500_000
#: Words that a worker remembers from one task to the next.
IDLE_WORDS = 100_000
#: A sequence this full is emitted at once.
NEARLY_FULL = 0.995
#: Nodes that meet in one merge.
FAN_IN = 32

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: ``rank`` is that of a piece among its partition's of the same length that are in underfull sequences.
PLACED = f"{PIECES}, node int, sequence_id long, offset long, done boolean, rank long"
#: ``n`` items of one size of a node, from rank ``first`` on: their sequences from ``sequence`` on and the offset in
#: these, or their first rank among the items of ``parent`` where they go ``up``.
RANGES = "parent int, node int, size int, first long, n long, sequence long, shift long, up long"
#: Ranks from ``rank`` on go to the sequences from ``base`` on, at ``offset``.
Run = tuple[int, int, int]


def cut(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``size`` ids of every text; its ids with ``keep_ids``."""
    path = tokenizer or byte_bpe.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_CHARS):
            rows: list[list] = [[], [], [], [], [], []]
            source = batch.column(0).to_pylist()
            for doc_id, ids in zip(source, byte_bpe.encode_texts(batch.column(1).to_pylist(), path)):
                ids = byte_bpe.with_end(ids)
                first = (len(ids) - 1) % size + 1
                bounds = [0, *range(first, len(ids) + 1, size)]
                for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    for column, value in zip(rows, (doc_id, n, a, b - a, byte_bpe.ids_crc32(ids[a:b]))):
                        column.append(value)
                    if keep_ids:
                        rows[5].append(ids[a:b])
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: 5 + keep_ids]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)
        byte_bpe.trim(path, IDLE_WORDS)

    return few_at_once(texts(docs)).mapInArrow(run, PIECES + (", ids array<int>" if keep_ids else ""))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of every item, items taken by falling size, each into the fullest bin it fits."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            chosen = room[left].pop()
            if not room[left]:
                rooms &= ~(1 << left)
        else:
            left, chosen, bins = capacity, bins, bins + 1
        where[item], offset[item] = chosen, capacity - left
        left -= size
        room[left].append(chosen)
        rooms |= 1 << left
    return where, offset


def plan_of(counts: dict[int, int], capacity: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``best_fit`` of so many items of every size: per size the first rank, first bin and offset of runs of items."""
    rooms: dict[int, list[tuple[int, int]]] = {}
    bins = 0
    plan = {}
    for size in sorted(counts, reverse=True):
        runs: list[Run] = []
        rank, left = 0, counts[size]
        while left:
            room = min((r for r in rooms if r >= size), default=None)
            if room is None:
                room, many = capacity, -(-left // (capacity // size))
                rooms[room], bins = [(bins, many)], bins + many
            first, many = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
            each = min(room // size, left)
            used = min(many, left // each)
            for k in range(each):
                runs.append((rank, first, capacity - room + k * size))
                rank += used
            left -= each * used
            for at, start, n in ((room - each * size, first, used), (room, first + used, many - used)):
                if n and at:
                    rooms.setdefault(at, []).append((start, n))
        plan[size] = tuple(np.array(c, np.int64) for c in zip(*runs)) if runs else (np.zeros(0, np.int64),) * 3
    return plan


def placed(runs: tuple[np.ndarray, np.ndarray, np.ndarray], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of the items of one size, by their ranks."""
    firsts, bins, offsets = runs
    at = np.searchsorted(firsts, rank, side="right") - 1
    return bins[at] + rank - firsts[at], offsets[at]


def _fills(plan: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the fill of the planned bins changes, and what it is from there on."""
    starts = np.concatenate([bins for _, bins, _ in plan.values()])
    lengths = np.concatenate([np.diff(firsts, append=counts[size]) for size, (firsts, _, _) in plan.items()])
    sizes = np.repeat(list(plan), [len(bins) for _, bins, _ in plan.values()])
    edges = np.unique(np.concatenate([starts, starts + lengths]))
    change = np.zeros(len(edges), np.int64)
    np.add.at(change, np.searchsorted(edges, starts), sizes)
    np.add.at(change, np.searchsorted(edges, starts + lengths), -sizes)
    return edges, np.cumsum(change)


def merged(classes: list[tuple[int, int, int]], capacity: int, last: bool) -> list[tuple[int, int, int, int, int | None, int, int | None]]:
    """Best-fit the items of some nodes, given as (node, size, number) by node.

    Gives ranges (node, size, first rank, number, bin, offset, None) of what is placed and
    (node, size, first rank, number, None, 0, rank) of what goes on under a new rank. Only bins that are
    nearly full are kept, all of them in the ``last`` merge.
    """
    counts: dict[int, int] = {}
    held: dict[int, list[tuple[int, int, int]]] = {}
    for node, size, n in classes:
        held.setdefault(size, []).append((node, counts.get(size, 0), n))
        counts[size] = counts.get(size, 0) + n
    plan = plan_of(counts, capacity)
    edges, fills = _fills(plan, counts)
    kept = (fills >= NEARLY_FULL * capacity) | last
    out = []
    for size, (firsts, bins, offsets) in plan.items():
        # pieces of runs that are kept or not as a whole
        parts, up = [], 0
        for rank, start, shift, n in zip(firsts.tolist(), bins.tolist(), offsets.tolist(), np.diff(firsts, append=counts[size]).tolist()):
            low, high = np.searchsorted(edges, (start, start + n))
            a = start
            for k in range(low, high):
                if k + 1 < high and kept[k + 1] == kept[k]:
                    continue
                b = int(edges[k + 1])
                if kept[k]:
                    parts.append((rank + a - start, b - a, a, shift, None))
                else:
                    parts.append((rank + a - start, b - a, None, 0, up))
                    up += b - a
                a = b
        begins = np.array([p[0] for p in parts])
        for node, base, n in held[size]:
            at = int(np.searchsorted(begins, base, side="right")) - 1
            while at < len(parts) and parts[at][0] < base + n:
                first, many, start, shift, rank = parts[at]
                a, b = max(first, base), min(first + many, base + n)
                moved = a - first
                out.append((node, size, a - base, b - a, None if start is None else start + moved, shift, None if rank is None else rank + moved))
                at += 1
    return out


def _first(rows: pa.Table, node: int, size: int) -> pa.Table:
    """Best-fit the pieces of a partition and say which of them are done, and the ranks of the others."""
    lengths = rows["length"].to_numpy()
    where, offset = best_fit(lengths, size)
    done = (np.bincount(where, lengths) >= NEARLY_FULL * size)[where]
    # by length, those that are done behind the others
    order = np.lexsort((done, lengths))
    ordered = lengths[order]
    rank = np.zeros(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered)
    columns = {"node": np.full(len(lengths), node, np.int32), "sequence_id": (node << 28) + where, "offset": offset, "done": done, "rank": rank}
    for name, values in columns.items():
        rows = rows.append_column(name, pa.array(values))
    return rows


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """The sequence and the place in it of every piece: ``pieces`` plus sequence_id and offset.

    ``pieces`` has the columns of ``cut``. Every sequence is gapless from offset 0 and no
    longer than ``size``; a piece longer than that raises.
    """
    spark = pieces.sparkSession
    base = scratch_dir(spark)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        lengths = table["length"].to_numpy()
        if len(lengths) and (lengths.max() > size or lengths.min() < 1):
            raise ValueError(f"pieces must have 1 to {size} ids")
        if len(lengths):
            yield from _first(table, TaskContext.get().partitionId(), size).to_batches()

    pieces = pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
    rows = store(pieces.mapInArrow(first, PLACED), f"{base}/0")
    left = rows.filter("not done").select(*pieces.columns, "node", "rank")
    ranges = _tree(left.groupBy("node", F.col("length").cast("int").alias("size")).agg((F.max("rank") + 1).alias("n")), size, base)
    kept = pieces.columns
    columns = [*kept, "sequence_id", "offset"]

    def second(items: pa.Table, ranges: pa.Table) -> pa.Table:
        key, rank = items["length"].to_numpy(), items["rank"].to_numpy()
        order = np.lexsort((ranges["first"].to_numpy(), ranges["size"].to_numpy()))
        ranges = ranges.take(pa.array(order))
        firsts, sizes = ranges["first"].to_numpy(), ranges["size"].to_numpy().astype(np.int64)
        # ranks and sizes as one number
        width = int(max(rank.max(initial=0), firsts.max(initial=0))) + 1
        at = np.searchsorted(sizes * width + firsts, key * width + rank, side="right") - 1
        sequence = ranges["sequence"].to_numpy()[at] + rank - firsts[at]
        return pa.table([*(items[c] for c in kept), pa.array(sequence), pa.array(ranges["shift"].to_numpy()[at])], names=columns)

    # the underfull pieces of one partition, and what the tree says about them
    placed = left.groupBy("node").cogroup(ranges.groupBy("node")).applyInArrow(second, f"{PIECES}, sequence_id long, offset long")
    return rows.filter("done").select(columns).unionByName(placed)


def _tree(classes: DataFrame, size: int, base: str) -> DataFrame:
    """Merge classes (node, size, n) of items up to one root; the ranges of every first node: node, size, first, sequence, shift."""
    nodes = (classes.agg(F.max("node")).first()[0] or 0) + 1
    levels: list[DataFrame] = []
    while not levels or nodes > 1:
        nodes = -(-nodes // FAN_IN)
        levels.append(store(_merges(classes, size, len(levels) + 1, nodes == 1), f"{base}/{len(levels) + 1}"))
        classes = levels[-1].filter("up IS NOT NULL").groupBy(F.col("parent").alias("node"), "size").agg(F.sum("n").alias("n"))
    found = None
    for level in reversed(levels):
        placed = level.filter("up IS NULL").select("node", "size", "first", "n", "sequence", "shift")
        if found is not None:
            above = found.select(F.col("node").alias("parent"), "size", *(F.col(c).alias(f"_{c}") for c in ("first", "n", "sequence", "shift")))
            met = level.filter("up IS NOT NULL").select("parent", "node", "size", "first", "n", "up").join(above, ["parent", "size"])
            met = met.filter("_first < up + n AND up < _first + _n").withColumn("a", F.greatest("up", "_first")).withColumn("b", F.least(F.expr("up + n"), F.expr("_first + _n")))
            placed = placed.unionByName(met.selectExpr("node", "size", "first + a - up AS first", "b - a AS n", "_sequence + a - _first AS sequence", "_shift AS shift"))
        found = placed
    return found.select("node", "size", "first", "sequence", "shift")


def _merges(classes: DataFrame, size: int, level: int, last: bool) -> DataFrame:
    """One round of merges: the ``RANGES`` of the classes of all nodes."""
    fan_in = FAN_IN

    def run(rows: pa.Table) -> pa.Table:
        parent = rows["parent"][0].as_py()
        ordered = sorted(zip(*(rows[c].to_pylist() for c in ("node", "size", "n"))))
        node, length, first, n, bins, shift, up = zip(*merged(ordered, size, last))
        sequence = [None if b is None else (level << 56) + (parent << 32) + b for b in bins]
        columns = ([parent] * len(node), node, length, first, n, sequence, shift, up)
        kinds = (pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 5)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in RANGES.split(", ")])

    return classes.withColumn("parent", (F.col("node") / fan_in).cast("int")).groupBy("parent").applyInArrow(run, RANGES)
