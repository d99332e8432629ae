"""Byte-level BPE ids of whole texts, encoded a distinct word at a time.

The vocabulary's splitting pattern never joins a white-space character to what stands
before it, unless that is white space too. A text may therefore be cut before every run of
white space and the parts encoded on their own. Natural text repeats its words, so each
Python worker encodes a word once and keeps its ids.
"""

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
#: Words that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 500_000
#: Characters that are encoded together.
SLICE_CHARS = 10_000_000
#: The characters with Unicode's White_Space property.
SPACES = " \t\n\x0b\x0c\r\x85\xa0  -     　"
WORD = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
#: White space that keeps a text from being cut at blanks and line feeds alone.
RARE = ["  ", " \n", "\n ", "\n\n", *(c for c in SPACES if c not in " \n")]
#: Before a part that is encoded as it stands; other words follow a blank.
HEAD = "\n"
RARE_ASCII = [x for x in RARE if x.isascii()]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def words_of(text: str) -> list[str]:
    """The text cut before runs of white space; the parts joined are the text."""
    return WORD.findall(text)


def plain(text: str) -> bool:
    """Whether blanks and line feeds stand alone, so that cutting at them will do."""
    if text[:1] == " " or text[-1:] == " ":
        return False
    return text.isascii() and not any(x in text for x in RARE_ASCII) or not any(x in text for x in RARE)


class WordMemory(dict):
    """Numbers of words; ``ids``, cut by ``starts`` and ``lengths``, has the ids of each.

    A key is a word without the blank before it, or, after ``HEAD``, a part as it stands.
    """

    #: What stands before the first word of a text.
    first = HEAD

    def __init__(self):
        super().__init__()
        self.starts, self.lengths, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)
        self.fresh: list[str] = []

    def easy(self, text: str) -> bool:
        return plain(text)

    def parts(self, text: str) -> list[str]:
        return words_of(text)

    def encoded(self) -> list[list[int]]:
        """The ids of the fresh words."""
        raise NotImplementedError

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number

    def forget(self, left: int | None = None) -> None:
        """Keep the half, or the ``left`` words, that were used most."""
        keep = np.sort(np.argsort(-self.used, kind="stable")[: REMEMBERED // 2 if left is None else left])
        words = list(self)
        self.clear()
        self.update((words[k], n) for n, k in enumerate(keep))
        self.ids = self.ids[spans(self.starts[keep], self.lengths[keep])]
        self.lengths, self.used = self.lengths[keep], self.used[keep] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths

    def learn(self) -> None:
        found = self.encoded()
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used = np.concatenate([self.used, np.zeros(len(found), np.int64)])
        self.ids = np.concatenate([self.ids, flat])
        self.fresh = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and how many each text has."""
        if len(self) > REMEMBERED:
            self.forget()
        easy = np.fromiter(map(self.easy, texts), bool, len(texts))
        lines = pc.replace_substring(pa.array([t for t, e in zip(texts, easy) if e], pa.string()), "\n", f" {HEAD}\n {HEAD}")
        cut = pc.split_pattern(pc.binary_join_element_wise(self.first, lines, "") if self.first else lines, " ")
        hard = [[HEAD + w for w in self.parts(t)] for t, e in zip(texts, easy) if not e]
        keys = pa.concat_arrays([cut.flatten(), pa.array(list(chain.from_iterable(hard)), pa.string())]).dictionary_encode()
        known = np.fromiter(map(self.__getitem__, keys.dictionary.to_pylist()), np.int64, len(keys.dictionary))
        if self.fresh:
            self.learn()
        numbers = known[keys.indices.to_numpy()]
        self.used += np.bincount(numbers, minlength=len(self.used))
        # the parts of the easy texts come first: put all texts back in order
        counts = np.concatenate([pc.list_value_length(cut).to_numpy().astype(np.int64), np.fromiter(map(len, hard), np.int64, len(hard))])
        order = np.argsort(np.concatenate([np.flatnonzero(easy), np.flatnonzero(~easy)]))
        if len(hard):
            numbers = numbers[spans((np.cumsum(counts) - counts)[order], counts[order])]
        counts = counts[order]
        lengths = self.lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[spans(self.starts[numbers], lengths)], np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

class WordIds(WordMemory):
    """Byte-pair ids of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.encoder = Tokenizer.from_file(path)
        # texts are cut at these before they are cut into words
        self.added = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        self.model = self.encoder.model
        alphabet = sorted(ByteLevel.alphabet())
        own = [c for c in alphabet if ord(c) < 256]
        rest = iter(c for c in alphabet if ord(c) >= 256)
        self.letters = {b: chr(b) if chr(b) in own else next(rest) for b in range(256)}
        self.signs: dict[str, list[int]] = {"": []}

    def merged(self, part: str) -> list[int]:
        """Ids of one part that the splitting pattern leaves whole."""
        return [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(self.letters))]

    def ids_of(self, key: str) -> list[int]:
        """Letters, with or without signs after them, go straight to the merges."""
        before, word = ("", key[1:]) if key[:1] == HEAD else (" ", key)
        if any(a in word for a in self.added):
            return self.encoder.encode(before + word, add_special_tokens=False).ids
        if key.isalpha() and key.isascii():
            return [t.id for t in self.model.tokenize(self.letters[32] + key)]
        end = len(word)
        while end and not word[end - 1].isalnum():
            end -= 1
        body, tail = word[:end], word[end:]
        if tail not in self.signs and tail.isascii() and tail.isprintable() and " " not in tail:
            self.signs[tail] = self.merged(tail)
        if not body.isalpha() or tail not in self.signs:
            return self.encoder.encode(before + word, add_special_tokens=False).ids
        return self.merged(before + body) + self.signs[tail]

    def encoded(self) -> list[list[int]]:
        if len(self.signs) > 1000:
            self.signs = {"": []}
        return [self.ids_of(w) for w in self.fresh]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every span, one span after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(starts.max(initial=0))) < 1 << 30 else np.int64
    out = np.repeat((starts - ends + lengths).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


_words: dict[str, WordIds] = {}


def encode_slices(texts: list[str | None], words: WordMemory) -> Iterator[np.ndarray]:
    """The ids of each text; null is as empty."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= SLICE_CHARS):
            size += len(texts[end] or "")
            end += 1
        ids, lengths = words.encode([t or "" for t in texts[at:end]])
        yield from np.split(ids, np.cumsum(lengths)[:-1])
        at = end


def trim(path: str, left: int) -> None:
    """Let an idle worker keep the ids of its ``left`` most used words."""
    if len(_words.get(path, ())) > left:
        _words[path].forget(left)


def encode_texts(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """The ids of each text, without an end id."""
    if path not in _words:
        _words[path] = WordIds(path)
    yield from encode_slices(texts, _words[path])


def with_end(ids: np.ndarray, end_id: int = END_ID) -> np.ndarray:
    return np.append(ids, np.uint32(end_id))


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
