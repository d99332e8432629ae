"""Token-id files: texts as ids, in shards of compressed blocks.

A range shuffle puts documents in ascending order of doc_id (repeated ids by text). Every
task is a shard: it encodes its texts, gathers whole documents into blocks of about
``block_ids`` ids, and codes each block on its own with ``id_coder``. Blocks are stored as
Parquet rows, so any store that Spark writes to will do, and a task that is run again
leaves no second copy. A block is read without its neighbours.

Defined results: a null or empty text has the end id alone; rows with a null doc_id come
first; repeated rows are kept; an empty table gives no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.llm import byte_bpe, id_coder
from epiframe.llm.tables import texts

BLOCK_IDS = 1 << 19
#: A block as stored: its shard and place there, the ids of the shard before it, its documents, its bytes.
BLOCKS = "shard int, block int, ids_before long, n_ids long, doc_ids array<long>, data binary"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = byte_bpe.END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of every whole text, each document followed by ``end_id``, to ``path``."""
    vocabulary = tokenizer or byte_bpe.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            data = id_coder.encode_block(np.array([len(x) for x in held]), np.concatenate(held))
            columns = [[shard], [block], [before], [size], [names], [data]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "block", "ids_before", "n_ids", "doc_ids", "data"])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), byte_bpe.encode_texts(batch.column(1).to_pylist(), vocabulary)):
                ids = byte_bpe.with_end(ids, end_id)
                if held and size + len(ids) > block_ids:
                    yield flush()
                    block, before, names, held, size = block + 1, before + size, [], [], 0
                names.append(doc_id)
                held.append(ids)
                size += len(ids)
        if held:
            yield flush()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The stored blocks with ``start``, the ids of all documents before each."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # one row per shard, that is per task of the writing job
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = shards.selectExpr("shard", "coalesce(sum(ids) over (order by shard rows between unbounded preceding and 1 preceding), 0) as shard_start")
    return blocks.join(before, "shard").withColumn("start", F.col("shard_start") + F.col("ids_before"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (array) of every document in the files."""
    return _decoded(spark, path, True)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the decoded blocks."""
    return _decoded(spark, path, False)


def _decoded(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, names, data in zip(*(c.to_pylist() for c in batch.columns)):
                lengths, ids = id_coder.decode_block(data)
                starts = np.cumsum(lengths) - lengths
                columns = [pa.array(names, pa.int64()), pa.array(start + starts)]
                if whole:
                    offsets = pa.array(np.append(starts, len(ids)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                else:
                    crc = [byte_bpe.ids_crc32(ids[a : a + n]) for a, n in zip(starts, lengths)]
                    columns += [pa.array(lengths), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=kept)

    schema = "doc_id long, start long, ids array<int>" if whole else DOCUMENTS
    kept = ["doc_id", "start", "ids"] if whole else ["doc_id", "start", "n_tokens", "ids_crc32"]
    return _placed(spark, path).select("start", "doc_ids", "data").mapInArrow(run, schema)
