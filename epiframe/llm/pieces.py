"""SentencePiece encoding and decoding with the forward pass shared between words.

A text is marked as the library does it (a blank becomes the mark, one is put in front) and
cut before every run of marks, across which no piece reaches. The distinct marked words of a
slice of texts are sorted, which is the depth-first order of their trie: the forward states
of a word's prefix are those of the word before it as far as the two agree, and only the
rest is computed. Every Python worker remembers the words it has seen.

For a unigram model the state of a prefix is the best sum of scores and the last piece of
the best path (Viterbi). A model of byte pairs has no path scores: the merges leave one
path per prefix, whose last piece is the one that stays apart from the piece before it when the
two are merged on their own; the state holds that piece. Either way the states come
from shorter prefixes alone, and the ids equal the library's. Characters without a piece are their bytes.

Defined results: a null or empty text has no pieces; decoding gives the text back, except
that the mark itself, if it is in a text, comes back as a blank, as with the library;
repeated rows are encoded once each; an empty table gives no rows; other columns are ignored.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from epiframe.llm import byte_bpe
from epiframe.llm.byte_bpe import HEAD, WordMemory, spans
from epiframe.llm.tables import texts
from epiframe.llm.words import slices

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
UNIGRAM, PAIRS = 1, 2
#: Verdicts on pairs of pieces that a worker remembers.
REMEMBERED_PAIRS = 2_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str) -> tuple[int, list[tuple[str, float, int]]]:
    """Kind of a model and its pieces: text, score, and type (1 normal, 2 unknown, 3 control, 6 byte)."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    if model.trainer_spec.model_type not in (UNIGRAM, PAIRS) or model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces or not model.normalizer_spec.add_dummy_prefix:
        raise ValueError("only unigram and byte-pair models that keep texts as they are can be used")
    return model.trainer_spec.model_type, [(p.piece, p.score, p.type) for p in model.pieces]


class PieceIds(WordMemory):
    """Ids of marked words."""

    first = ""

    def __init__(self, path: str | None = None, kind: int | None = None, pieces: list[tuple[str, float, int]] | None = None):
        super().__init__()
        if pieces is None:
            kind, pieces = load(path)
        self.kind = kind
        self.number = {p: n for n, (p, _, t) in enumerate(pieces) if t == 1}
        self.score = np.array([s for _, s, _ in pieces]).tolist()
        self.bytes = {int(p[3:5], 16): n for n, (p, _, t) in enumerate(pieces) if t == 6}
        self.unknown = next((n for n, (_, _, t) in enumerate(pieces) if t == 2), 0)
        self.longest = max(map(len, self.number), default=1)
        self.penalty = min(self.score[n] for n in self.number.values()) - 10 if self.number else 0.0
        self.apart: dict[tuple[str, str], bool] = {}

    def easy(self, text: str) -> bool:
        return bool(text) and MARK not in text and byte_bpe.plain(text)

    def parts(self, text: str) -> list[str]:
        return WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def merged(self, text: str) -> list[str]:
        """Pieces left when the best pair of neighbours is merged until none is a piece."""
        left = list(text)
        while True:
            pairs = [(-self.score[n], k) for k in range(len(left) - 1) if (n := self.number.get(left[k] + left[k + 1])) is not None]
            if not pairs:
                return left
            k = min(pairs)[1]
            left[k : k + 2] = [left[k] + left[k + 1]]

    def stay_apart(self, a: str, b: str) -> bool:
        key = (a, b)
        if key not in self.apart:
            if len(self.apart) > REMEMBERED_PAIRS:
                self.apart.clear()
            self.apart[key] = self.merged(a + b) == [a, b]
        return self.apart[key]

    def extend(self, word: str, end: int, last: list[str], best: list[float]) -> None:
        """The state of the prefix of ``end`` characters, from those of shorter ones."""
        char = word[end - 1]
        if self.kind == PAIRS:
            number, apart = self.number, self.apart
            for start in range(max(0, end - self.longest), end - 1):
                piece = word[start:end]
                if piece in number:
                    if not start:
                        break
                    alone = apart.get((last[start], piece))
                    if alone if alone is not None else self.stay_apart(last[start], piece):
                        break
            else:
                # a path always exists, so the last character alone is what is left
                piece = char
            last.append(piece)
            best.append(0.0)
            return
        choice, top = char, best[end - 1] + (self.score[self.number[char]] if char in self.number else self.penalty)
        for start in range(max(0, end - self.longest), end - 1):
            n = self.number.get(word[start:end])
            if n is not None and best[start] + self.score[n] > top:
                choice, top = word[start:end], best[start] + self.score[n]
        last.append(choice)
        best.append(top)

    def encoded(self) -> list[list[int]]:
        words = [w[1:] if w[:1] == HEAD else MARK + w for w in self.fresh]
        found: list[list[int]] = [[]] * len(words)
        before, last, best = "", [""], [0.0]
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1 :], best[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                self.extend(word, end, last, best)
            before, end, path = word, len(word), []
            while end:
                path.append(last[end])
                end -= len(last[end])
            found[k] = [n for piece in reversed(path) for n in self.ids_of(piece)]
        return found

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.number:
            return [self.number[piece]]
        return [self.bytes.get(b, self.unknown) for b in piece.encode()] if self.bytes else [self.unknown]


class Decoder:
    """Texts from ids."""

    def __init__(self, path: str | None = None, pieces: list[tuple[str, float, int]] | None = None):
        pieces = pieces or load(path)[1]
        plain = [bytes([int(p[3:5], 16)]) if t == 6 else b"" if t == 3 else " ⁇ ".encode() if t == 2 else p.replace(MARK, " ").encode() for p, _, t in pieces]
        self.lengths = np.array([len(p) for p in plain])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(plain), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """One text for every count of ids."""
        lengths = self.lengths[ids]
        data = self.data[spans(self.starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        out = [data[a:b].decode(errors="replace") for a, b in zip(ends, ends[1:])]
        return [t[1:] if t[:1] == " " else t for t in out]


_words: dict[str, PieceIds] = {}


def encode_texts(source: list[str | None], path: str) -> Iterator[np.ndarray]:
    if path not in _words:
        _words[path] = PieceIds(path)
    yield from byte_bpe.encode_slices(source, _words[path])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text and ids (array) of every row."""
    model = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [x.astype(np.int32) for x in encode_texts(batch["text"].to_pylist(), model)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "text", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and decoded text of rows with doc_id and ids; null ids give a null text."""
    model = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            found = batch["ids"].to_pylist()
            counts = np.array([len(x or []) for x in found], np.int64)
            flat = np.concatenate([np.array(x or [], np.int64) for x in found] or [np.zeros(0, np.int64)])
            out = [t if x is not None else None for t, x in zip(decoder.decode(flat, counts), found)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def round_trips(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row doc_id, n_pieces, ids_crc32 and whether decoding the ids gives the text back."""
    model = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in slices(batches, "text", byte_bpe.SLICE_CHARS):
            source = batch["text"].to_pylist()
            counts, crc, same = [], [], []
            for text, ids in zip(source, encode_texts(source, model)):
                counts.append(len(ids))
                crc.append(byte_bpe.ids_crc32(ids))
                same.append(decoder.decode(ids, np.array([len(ids)]))[0] == (text or "").replace(MARK, " "))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return texts(docs).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")
