"""Substring dedup: words inside passages that the corpus has more than once, found with repeated-phrase automata.

A window is ``window`` consecutive words of a document. A word goes if a window that covers
it starts anywhere else too, in the same document or another.

* Candidates. Every window has a seed: the ``SEED``-word phrase in it with the smallest hash. Equal
  windows have equal seeds, and only some 7 % of all phrases are the seed of any window, so
  seeds are counted first; a window whose seed is there once cannot recur.
* Confirmed passages. The windows left are counted over all batches by 96 bits of hash. In
  each batch, runs of confirmed windows that stand there for the first time are its passages.
* Automata. A batch is a shard: phrases of ``SEED`` words are taken from its passages, so close that every
  window holds one, and go into an Aho-Corasick automaton as numbered words. A passage can stand only
  where its windows were counted, so the automaton of a batch holds all that its documents can match,
  and no document meets another's. All documents stream through; from each place of a phrase the
  match is extended word by word, and where it covers a window of words, those words go.
  Matching is on the words themselves, not on hashes.

Defined results: a null, empty or blank text has no words; texts shorter than a window lose
nothing; rows that repeat a document count as documents; rows without a doc_id too; an empty
table gives no rows; other columns are ignored.
"""

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from epiframe.llm import tallies
from epiframe.llm.tables import texts
from epiframe.llm.words import chained

WINDOW, SEED = 35, 8
#: Places of phrases that are extended at once.
AT_ONCE = 1_000_000
#: A word number is so many digits to the automaton: a node looks through its children one by one.
BASE = 64
CLEANED = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,length:long>>, text string"


class Batch:
    """The words of a batch of texts, end to end, and the windows in them."""

    def __init__(self, column: pa.ChunkedArray, window: int):
        self.words, self.window = tallies.words(column), window
        self.row, self.size = self.words.row, min(SEED, window)
        n = len(self.row)
        # windows that lie within one text, by their first word
        self.starts = np.flatnonzero(self.row[: max(0, n - window + 1)] == self.row[window - 1 :])
        self.hashes = self.words.hashes()[self.words.number]

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the phrase at every word, and the seed of every window."""
        if not len(self.starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        phrases = tallies.doubled(self.hashes, self.size, chained)
        return phrases, tallies.doubled(phrases, self.window - self.size + 1, np.minimum)[self.starts]

    def asked_seeds(self) -> np.ndarray:
        """The phrases that are the seed of a window that holds them, once for every place."""
        phrases, seeds = self.seeds()
        if not len(seeds):
            return seeds
        reach = self.window - self.size + 1
        # a phrase is a seed if no smaller one shares all of its windows
        most = np.zeros(len(phrases) + reach - 1, np.uint64)
        most[self.starts + reach - 1] = seeds
        return phrases[(tallies.doubled(most, reach, np.maximum) == phrases) & (phrases > 0)]

    def asked_windows(self, seeds: tallies.Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, hashes and checks of the windows whose seed recurs."""
        _, mine = self.seeds()
        starts = self.starts[seeds.of(mine) > 0]
        if not len(starts):
            return starts, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        keys = tallies.doubled(self.hashes, self.window, chained)[starts]
        checks = tallies.doubled(tallies.second(self.hashes), self.window, tallies.check)[starts]
        return starts, keys, (checks >> np.uint64(32)).astype(np.uint32)


def _seeds(window: int, shards: int):
    def ask(table: pa.Table) -> pa.Table:
        return tallies.requests(table["batch"][0].as_py(), shards, Batch(table["text"], window).asked_seeds())

    return ask


def _windows(window: int, shards: int):
    def ask(key: tuple, docs: pa.Table, seeds: pa.Table) -> pa.Table:
        batch = Batch(docs["text"], window)
        _, keys, checks = batch.asked_windows(tallies.told(seeds, batch.asked_seeds()))
        return tallies.requests(key[0].as_py(), shards, keys, checks)

    return ask


def passages(starts: np.ndarray, row: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of runs of windows, by the ascending starts of these."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero((np.diff(starts) > 1) | (np.diff(row[starts]) != 0)) + 1
    return starts[np.append(0, cut)], starts[np.append(cut - 1, len(starts) - 1)] + window


class Automaton:
    """Phrases of the passages, so many that every window of these holds one."""

    def __init__(self, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int):
        """``ids``: words as numbers; passages lie in them from ``begins`` to ``ends``."""
        self.size, self.window = min(SEED, window), window
        self.begins, self.ends = begins, ends
        gap = window - self.size + 1
        many = (ends - begins - self.size) // gap + 1
        self.passage = np.repeat(np.arange(len(begins)), many)
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        self.place = begins[self.passage] + step * gap
        self.digits = 1
        while BASE**self.digits <= ids.max(initial=0):
            self.digits += 1
        phrases = self._symbols(ids[self.place[:, None] + np.arange(self.size)]).reshape(-1, self.size * self.digits)
        numbers: dict[tuple, int] = {}
        number = np.array([numbers.setdefault(phrase, len(numbers)) for phrase in map(tuple, phrases.tolist())], np.int64)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for phrase, k in numbers.items():
            self.found.add_word(phrase, k)
        order = np.argsort(number, kind="stable")
        self.place, self.passage = self.place[order], self.passage[order]
        self.first = np.searchsorted(number[order], np.arange(len(numbers) + 1))
        self.found.make_automaton()

    def _symbols(self, ids: np.ndarray) -> np.ndarray:
        """The digits of each number, told apart by their places."""
        return np.stack([ids // BASE**k % BASE + k * BASE for k in range(self.digits)], -1).ravel()

    def covered(self, ids: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Which words lie in a window of some passage."""
        mark = np.zeros(len(ids) + 1, np.int64)
        if not len(self.place):
            return mark[:-1] > 0
        hits = np.fromiter((x for hit in self.found.iter(tuple(self._symbols(ids).tolist())) for x in hit), np.int64).reshape(-1, 2)
        last, number = hits[:, 0] // self.digits, hits[:, 1]
        at = last - self.size + 1
        whole = row[at] == row[last]
        at, number = at[whole], number[whole]
        many = self.first[number + 1] - self.first[number]
        part = np.cumsum(many) // AT_ONCE
        for k in np.unique(part).tolist():
            some = part == k
            self._extend(mark, ids, row, at[some], number[some], many[some])
        return np.cumsum(mark)[:-1] > 0

    def _extend(self, mark: np.ndarray, ids: np.ndarray, row: np.ndarray, at: np.ndarray, number: np.ndarray, many: np.ndarray) -> None:
        here = np.repeat(at, many)
        k = np.repeat(self.first[number] - np.cumsum(many) + many, many) + np.arange(many.sum())
        there, begin, end = self.place[k], self.begins[self.passage[k]], self.ends[self.passage[k]]
        left, right = np.zeros(len(here), np.int64), np.full(len(here), self.size, np.int64)
        for reach, step, limit in ((left, -1, begin), (right, 1, end)):
            alive = np.arange(len(here))
            # no window that holds the phrase reaches further
            for _ in range(self.window - self.size):
                offset = -(reach[alive] + 1) if step < 0 else reach[alive]
                x, y = here[alive] + offset, there[alive] + offset
                inside = (x >= 0) & (x < len(ids)) & ((y >= limit[alive]) if step < 0 else (y < limit[alive]))
                alive, x, y = alive[inside], x[inside], y[inside]
                same = (ids[x] == ids[y]) & (row[x] == row[here[alive]])
                alive = alive[same]
                reach[alive] += 1
                if not len(alive):
                    break
        enough = left + right >= self.window
        np.add.at(mark, here[enough] - left[enough], 1)
        np.add.at(mark, here[enough] + right[enough], -1)


def _clean(window: int):
    def clean(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        batch = Batch(docs["text"], window)
        seeds, windows = (answers.filter(pc.equal(answers["step"], k)) for k in (0, 1))
        starts, keys, _ = batch.asked_windows(tallies.told(seeds, batch.asked_seeds()))
        _, first = np.unique(keys, return_index=True)
        confirmed = np.sort(starts[first[tallies.told(windows, keys).totals > 0]])
        begins, ends = passages(confirmed, batch.row, window)
        gone = Automaton(batch.words.number, begins, ends, window).covered(batch.words.number, batch.row)
        return _rows(docs, batch, gone)

    return clean


def _rows(docs: pa.Table, batch: Batch, gone: np.ndarray) -> pa.Table:
    """One row per document: its words, those removed, where these were, and the words that are left."""
    n, total = docs.num_rows, np.bincount(batch.row, minlength=docs.num_rows)
    removed = np.bincount(batch.row[gone], minlength=n)
    begin = np.cumsum(total) - total
    # runs of removed words within a document
    edge = gone & np.append(True, ~gone[:-1] | (batch.row[1:] != batch.row[:-1]))[: len(gone)]
    at = np.flatnonzero(edge)
    run = np.cumsum(edge)[gone] - 1
    spans = pa.StructArray.from_arrays([pa.array(at - begin[batch.row[at]], pa.int64()), pa.array(np.bincount(run, minlength=len(at)), pa.int64())], names=["start", "length"])
    per_row = np.bincount(batch.row[at], minlength=n)
    spans = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_row)), pa.int32()), spans)
    kept = batch.words.number[~gone]
    offsets = np.append(0, np.cumsum(total - removed))
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), batch.words.distinct.take(pa.array(kept)))
    left = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pa.table({"doc_id": docs["doc_id"], "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": spans, "text": left})


def cleaned(docs: DataFrame, window: int = WINDOW, batch_bytes: int = tallies.BATCH_BYTES, shard_words: int = tallies.SHARD_WORDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) without its repeated passages.

    ``n_words`` and ``n_removed`` count its words and those removed, ``spans`` says where these
    were (in words), and ``text`` is what is left, joined by one space.
    """
    dealt = tallies.deal(texts(docs), batch_bytes, shard_words)
    by_batch = dealt.docs.groupBy("batch")
    seeds = tallies.answers(by_batch.applyInArrow(_seeds(window, dealt.shards), tallies.REQUEST), 2)
    asked = by_batch.cogroup(seeds.groupBy("batch")).applyInArrow(_windows(window, dealt.shards), tallies.REQUEST)
    windows = tallies.answers(asked, 2)
    told = seeds.selectExpr("0 AS step", "*").unionByName(windows.selectExpr("1 AS step", "*"))
    return by_batch.cogroup(told.groupBy("batch")).applyInArrow(_clean(window), CLEANED)


