"""Words of a batch of texts as numbers into the batch's distinct words, and row digests."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that are looked at together.
SLICE_CHARS = 8_000_000


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def slices(batches: Iterator[pa.RecordBatch], column: str, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has about ``chars`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // chars
        bounds = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows] if batch.num_rows else [0, 0]
        for a, b in zip(bounds, bounds[1:]):
            yield batch.slice(a, b - a)
    # the worker may be idle next, while the executor needs the memory
    pa.default_memory_pool().release_unused()


def letter_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-cased runs of letters; for every run its number in them, and its row."""
    only = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\PL+", " ")
    cut = pc.split_pattern(pc.utf8_trim(only, " "), " ")
    words = cut.flatten().dictionary_encode()
    row = pc.list_parent_indices(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    number = words.indices.to_numpy(zero_copy_only=False)
    distinct = words.dictionary.to_pylist()
    if "" in (empty := {w: n for n, w in enumerate(distinct) if not w}):
        row, number = row[number != empty[""]], number[number != empty[""]]
    return distinct, number.astype(np.int64), row


#: Words whose hashes a Python worker remembers.
REMEMBERED = 100_000
#: Odd multipliers of well-known 64-bit mixing functions.
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words of a text, cut at space and tab to carriage return; ``lower`` folds A-Z."""
    # bytes.lower and bytes.split know ASCII alone
    data = (text or "").encode()
    words = (data.lower() if lower else data).split()
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * ODD[1]
    x = (x ^ (x >> np.uint64(27))) * ODD[2]
    return x ^ (x >> np.uint64(31))


def chained(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of sequences from those of their heads and of their last words."""
    return mixed(x * ODD[0] + y)
