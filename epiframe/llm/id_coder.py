"""Adaptive context-mixing range coder for blocks of token ids.

A block is cut into lanes of consecutive ids. All lanes take one step at a time: each codes
its next id with a range coder of its own, under one model that they share and that is
brought up to date after every step, in the coder and the decoder alike. The model mixes
three predictions of the next id: the one last seen after the two ids before (order 2), the
one last seen after the id before (order 1), and the frequencies of all ids (order 0). The
weights of the mixture are the shares with which each came true before, kept for every
state of the two contexts (how often each was right in a row, and whether they agree).

Layout of a block, little-endian: magic ``TIDB``, version u8, 3 bytes 0, documents u32, ids
u64, lanes u32, vocabulary u32, crc32 of the ids as u32, crc32 of all else u32; then the document lengths
as u32, the digits of each lane as u32, and the lanes' base-65536 digits as u16.
"""

import struct
import zlib

import numpy as np

HEADER, SUM = struct.Struct("<4sB3xIQIII"), struct.Struct("<I")
MAGIC, VERSION = b"TIDB", 1
LANES, IDS_PER_LANE = 8192, 64
HASH_BITS = 20
#: What an id gains in the order-0 counts each time it is seen; every id starts at 1.
GAIN = 24
STEADY = 7
CHOICES = 1 << 12
LOW, BASE = np.uint64(1 << 32), np.uint64(16)
MASK32, MASK16 = np.uint64((1 << 32) - 1), np.uint64((1 << 16) - 1)


class Mixture:
    """Predictions of orders 0 to 2 and the weights to mix them."""

    def __init__(self, vocabulary: int, lanes: int):
        self.vocabulary = vocabulary
        self.counts = np.ones(vocabulary, np.int64)
        # an entry is the id last seen after its context, times 8, plus how often that was right in a row
        self.after1, self.after2 = np.zeros(vocabulary + 1, np.int32), np.zeros(1 << HASH_BITS, np.int32)
        states = 2 * (STEADY + 1) ** 2
        self.right = np.full((states, 3), 2, np.int64)
        self.before1 = np.full(lanes, vocabulary, np.int32)
        self.before2 = np.full(lanes, vocabulary, np.int32)
        self.weigh()

    def weigh(self) -> None:
        """Integer weights and running sums from the counts so far."""
        total = self.right.sum(1, keepdims=True)
        share = 1 + self.right * (CHOICES - 3) // total
        share[:, 2] = CHOICES - share[:, 0] - share[:, 1]
        self.share = share.astype(np.uint64)
        self.starts = np.cumsum(self.share, axis=1) - self.share
        self.below = np.zeros(self.vocabulary + 1, np.uint32)
        np.cumsum(self.counts, out=self.below[1:], dtype=np.uint32)
        self.total = np.uint64(self.below[-1])

    def predict(self, active: int) -> None:
        self.one = self.before1[:active].copy()
        two = self.before2[:active].astype(np.uint32) * np.uint32(40503) + self.one.astype(np.uint32) * np.uint32(2654435761)
        self.two = two >> np.uint32(32 - HASH_BITS)
        self.seen2, self.seen1 = self.after2[self.two], self.after1[self.one]
        self.guess2, self.guess1 = self.seen2 >> 3, self.seen1 >> 3
        self.state = ((self.seen2 & 7) * 8 + (self.seen1 & 7)) * 2 + (self.guess1 == self.guess2)

    def choice(self, ids: np.ndarray) -> np.ndarray:
        """Which prediction names the id: 0 order 2, 1 order 1, 2 the counts."""
        return np.where(ids == self.guess2, 0, 2 - (ids == self.guess1))

    def learn(self, ids: np.ndarray, choice: np.ndarray) -> None:
        self.right += np.bincount(self.state * 3 + choice, minlength=self.right.size).reshape(self.right.shape)
        self.counts += GAIN * np.bincount(ids, minlength=self.vocabulary)
        fresh = ids << 3
        for table, place, seen, guess in ((self.after2, self.two, self.seen2, self.guess2), (self.after1, self.one, self.seen1, self.guess1)):
            sure = seen & 7
            table[place] = np.where(guess == ids, seen + (sure < STEADY), np.where(sure == 0, fresh, seen - 1))
        self.before2[: len(ids)] = self.one
        self.before1[: len(ids)] = ids
        self.weigh()


def _lanes(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // IDS_PER_LANE))
    return lanes, -(-n // lanes) if n else 0


class Encoder:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 1 << 48, np.uint64)
        self.lanes: list[np.ndarray] = []
        self.digits: list[np.ndarray] = []

    def put(self, lane: np.ndarray, start: np.ndarray, size: np.ndarray, total) -> None:
        """Narrow the lanes to [start, start + size) of total; ``lane`` is ascending."""
        low, unit = self.low[lane], self.range[lane] // total
        low += unit * start
        wide = unit * size
        while True:
            due = np.flatnonzero(wide < LOW)
            if not len(due):
                break
            self.lanes.append(lane[due])
            self.digits.append(low[due] >> np.uint64(32))
            low[due] = (low[due] & MASK32) << BASE
            wide[due] <<= BASE
        self.low[lane], self.range[lane] = low, wide

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Digits of all lanes, lane by lane, and how many each has."""
        n = len(self.low)
        lanes = np.concatenate([*self.lanes, np.arange(n)])
        digits = np.concatenate([*self.digits, (self.low + MASK32) >> np.uint64(32)])
        order = np.argsort(lanes, kind="stable")
        digits = digits[order]
        # a digit of 65536 or more carries into the one before it, which is of the same lane
        while len(over := np.flatnonzero(digits > MASK16)):
            digits[over] &= MASK16
            digits[over - 1] += np.uint64(1)
        return digits.astype("<u2"), np.bincount(lanes, minlength=n).astype("<u4")


def encode_block(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a block: documents of these lengths, with these ids one after the other."""
    n = len(ids)
    lanes, steps = _lanes(n)
    vocabulary = int(ids.max()) + 1 if n else 1
    values, places = ids.astype(np.int32), np.arange(lanes) * steps
    mixture, coder = Mixture(vocabulary, lanes), Encoder(lanes)
    for step in range(steps):
        active = min(lanes, -(-(n - step) // steps))
        now = values[places[:active] + step]
        mixture.predict(active)
        choice = mixture.choice(now)
        case = mixture.state * 3 + choice
        coder.put(np.arange(active), mixture.starts.take(case), mixture.share.take(case), np.uint64(CHOICES))
        rest = np.flatnonzero(choice == 2)
        plain = now[rest]
        coder.put(rest, mixture.below[plain].astype(np.uint64), mixture.counts[plain].astype(np.uint64), mixture.total)
        mixture.learn(now, choice)
    digits, per_lane = coder.finish()
    body = np.asarray(lengths).astype("<u4").tobytes() + per_lane.tobytes() + digits.tobytes()
    check = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
    header = HEADER.pack(MAGIC, VERSION, len(lengths), n, lanes, vocabulary, check)
    return header + SUM.pack(zlib.crc32(body, zlib.crc32(header))) + body


class Decoder:
    def __init__(self, digits: np.ndarray, per_lane: np.ndarray):
        self.end = np.cumsum(per_lane, dtype=np.int64)
        self.at = self.end - per_lane
        self.digits = np.append(digits, 0).astype(np.uint64)
        self.range = np.full(len(per_lane), 1 << 48, np.uint64)
        self.code = np.zeros(len(per_lane), np.uint64)
        for _ in range(3):
            self.code = self.code << BASE | self.take(np.arange(len(per_lane)))

    def take(self, lane: np.ndarray) -> np.ndarray:
        """The next digit of each lane; past a lane's end all are 0."""
        at = self.at[lane]
        self.at[lane] = at + 1
        return self.digits[np.where(at < self.end[lane], at, -1)]

    def value(self, lane: np.ndarray, total) -> np.ndarray:
        self.unit = self.range[lane] // total
        return np.minimum(self.code[lane] // self.unit, total - np.uint64(1))

    def narrow(self, lane: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        code, wide = self.code[lane] - self.unit * start, self.unit * size
        while True:
            due = np.flatnonzero(wide < LOW)
            if not len(due):
                break
            code[due] = code[due] << BASE | self.take(lane[due])
            wide[due] <<= BASE
        self.code[lane], self.range[lane] = code, wide


def decode_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Document lengths and ids of a block; raises where a checksum does not hold."""
    at = HEADER.size + SUM.size
    if len(data) < at or data[:4] != MAGIC or zlib.crc32(data[at:], zlib.crc32(data[: HEADER.size])) != SUM.unpack_from(data, HEADER.size)[0]:
        raise ValueError("this is no whole block of token ids")
    _, version, documents, n, lanes, vocabulary, check = HEADER.unpack_from(data)
    if version != VERSION:
        raise ValueError(f"blocks of version {version} are not known")
    lengths = np.frombuffer(data, "<u4", documents, at).astype(np.int64)
    per_lane = np.frombuffer(data, "<u4", lanes, at + 4 * documents)
    digits = np.frombuffer(data, "<u2", -1, at + 4 * (documents + lanes))
    mixture, coder = Mixture(vocabulary, lanes), Decoder(digits, per_lane)
    _, steps = _lanes(n)
    out, places = np.zeros(n, np.uint32), np.arange(lanes) * steps
    for step in range(steps):
        active = min(lanes, -(-(n - step) // steps))
        mixture.predict(active)
        row = np.arange(active)
        value = coder.value(row, np.uint64(CHOICES))
        first = mixture.state * 3
        choice = (value >= mixture.starts.take(first + 1)).astype(np.int64) + (value >= mixture.starts.take(first + 2))
        coder.narrow(row, mixture.starts.take(first + choice), mixture.share.take(first + choice))
        now = np.where(choice == 0, mixture.guess2, mixture.guess1)
        rest = np.flatnonzero(choice == 2)
        value = coder.value(rest, mixture.total)
        now[rest] = found = np.searchsorted(mixture.below, value.astype(np.uint32), side="right") - 1
        coder.narrow(rest, mixture.below[found].astype(np.uint64), mixture.counts[found].astype(np.uint64))
        out[places[:active] + step] = now
        mixture.learn(now, choice)
    if zlib.crc32(out.astype("<u4", copy=False)) != check:
        raise ValueError("the ids of a block do not match their checksum")
    return lengths, out
