"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block starts from nothing and can be decoded alone.  Each id is coded as

* one decision: is it the predicted id?  The order-2 context (two ids before) predicts the
  id that followed it last, else the order-1 context does.  How likely a hit is comes from
  three adaptive estimates (order-2 confidence, order-1 confidence, recent hits as order
  0) mixed in the logistic domain with weights that learn;
* after a miss, the id itself in four-bit digits, each under an adaptive order-0
  distribution that depends on the digits before it and learns fast at first.

Decisions go into a carry-less range coder with 64-bit state and 32-bit words.

All arithmetic is on integers, so every machine decodes what another encoded.  Blocks are
independent, so they run side by side, one array element for each; a step of all blocks is
a few array operations.

Layout of an encoded block, little-endian: ids, words, digits, CRC-32 of the ids as 32-bit
words, CRC-32 of the coded words, all unsigned 32-bit; then the coded words.
"""

from __future__ import annotations

import struct
from zlib import crc32

import numpy as np

BLOCK = 8192
#: Blocks that run side by side.
LANES = 1024

HEADER = struct.Struct("<5I")
#: Contexts of order 1 and 2 that a block tells apart, and its chances.
ORDER1, ORDER2 = 1024, 2048
SLOTS, INPUTS = ORDER1 + ORDER2, 36
#: Largest weight of an estimate, in 1/65536.
MOST = 131_071
MASK32 = np.uint64(0xFFFFFFFF)
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

# Fixed values of the model: precision, floor of a digit's share, and shifts of a
# distribution after 0, 1, ... sightings, the last one for all that follow.
BITS = 15
WHOLE = 1 << BITS
FLOOR = 32
SHIFTS = np.array([1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 4, 4, 4, 4, 5], np.int16)
#: Most distributions of a digit.
NODES = 1024


def _squash_table() -> np.ndarray:
    """Logistic function on -2047..2047, in 1/4096 steps, by integer interpolation."""
    # 4096 / (1 + exp(-x)) at x = -16, -15, ..., 16 half-steps of 128 / 256.
    knots = [1, 2, 3, 6, 10, 16, 27, 45, 73, 120, 194, 310, 488, 747, 1101, 1546, 2047,
             2549, 2994, 3348, 3607, 3785, 3901, 3975, 4024, 4050, 4068, 4079, 4085, 4089,
             4092, 4093, 4094]
    x = np.arange(-2048, 2048)
    cell, part = (x + 2048) >> 7, (x + 2048) & 127
    k = np.array(knots)
    return ((k[cell] * (128 - part) + k[cell + 1] * part + 64) >> 7).clip(1, 4095).astype(np.int64)


SQUASH = _squash_table()
#: Inverse of the squash: the first x whose value is at least p.
STRETCH = np.searchsorted(SQUASH, np.arange(4096)).clip(0, 4095).astype(np.int64) - 2048

#: Where a digit's distribution is heading after seeing each digit.
_at, _seen = np.arange(16)[None, :], np.arange(16)[:, None]
TARGET = np.where(_at <= _seen, _at * FLOOR, WHOLE - (16 - _at) * FLOOR).astype(np.int16)


class Model:
    """State of all blocks; ``k`` blocks are still running, the longest first."""

    def __init__(self, lanes: int, digits: int):
        self.lanes, self.digits = lanes, digits
        #: Nodes of each digit: by all digits before it, from the fourth on by their hash.
        sizes = [min(16**d, NODES) for d in range(digits)]
        self.bases = np.cumsum([0, *sizes[:-1]])
        self.nodes = sum(sizes)
        #: How far a distribution has come: it learns fast at first.
        self.seen = np.zeros(lanes * self.nodes, np.int8)
        self.cdf = np.tile((np.arange(16) * (WHOLE // 16)).astype(np.int16), (lanes * self.nodes, 1))
        #: Last id after each order-2 and each order-1 context, above three bits of how
        #: often in a row.
        self.followed = np.zeros(lanes * SLOTS, np.int64)
        #: Chances in 1/65536 by order-2 confidence, order-1 confidence and recent hits.
        self.chances = np.full(lanes * INPUTS, 1 << 14, np.int64)
        self.weights = np.full((3, lanes), 26_000, np.int64)
        self.hits = np.zeros(lanes, np.int64)
        self.last = np.zeros(lanes, np.int64)
        self.last2 = np.zeros(lanes, np.int64)
        self.slots = np.arange(lanes) * SLOTS + np.array([[0], [ORDER2]])
        self.inputs = np.arange(lanes) * INPUTS + np.array([[0], [16], [32]])

    def predict(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Predicted ids and the chance of a hit in 1/4096."""
        last, last2 = self.last[:k], self.last2[:k]
        at = np.empty((2, k), np.int64)
        np.bitwise_and(last * 0x2F35 + last2 * 0x61D, ORDER2 - 1, out=at[0])
        np.bitwise_and(last * 0x9E5, ORDER1 - 1, out=at[1])
        at += self.slots[:, :k]
        followed = self.followed.take(at)
        guesses, conf = followed >> 3, followed & 7
        guess = np.where(conf[0] > 0, guesses[0], guesses[1])
        seen = np.empty((3, k), np.int64)
        np.add(conf * 2, guesses[0] == guesses[1], out=seen[:2])
        seen[2] = self.hits[:k]
        seen += self.inputs[:, :k]
        chances = self.chances.take(seen)
        x = STRETCH.take(chances >> 4)
        dot = (self.weights[:, :k] * x).sum(axis=0) >> 16
        chance = SQUASH.take(dot + 2048, mode="clip")
        self.state = at, followed, guesses, conf, seen, chances, x, chance
        return guess, chance

    def learn(self, k: int, ids: np.ndarray, hit: np.ndarray) -> None:
        at, followed, guesses, conf, seen, chances, x, chance = self.state
        bit = hit.astype(np.int64)
        error = ((bit << 12) - chance) * 6
        w = self.weights[:, :k] + ((x * error + 0x2000) >> 14)
        self.weights[:, :k] = np.minimum(np.maximum(w, -MOST), MOST)
        self.chances[seen] = chances + ((bit * 65_535 - chances) >> 5)
        self.hits[:k] = ((self.hits[:k] << 1) | bit) & 3
        lower = conf >> 1
        kept = np.where(lower > 0, followed - conf + lower, (ids << 3) + 1)
        self.followed[at] = np.where(guesses == ids, followed + (conf < 7), kept)
        self.last2[:k] = self.last[:k]
        self.last[:k] = ids

    def node(self, d: int, lanes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Rows of the distributions for digit ``d``; ``before`` holds the digits so far."""
        if d > 2:
            before = (before * 0x9E5) & (NODES - 1)
        return lanes * self.nodes + self.bases[d] + before

    def see(self, d, lanes, before, digit) -> tuple[np.ndarray, np.ndarray]:
        """A digit's interval, start and width; its distribution learns it."""
        at = self.node(d, lanes, before)
        rows = self.cdf.take(at, axis=0)
        return self._learn(at, rows, digit)

    def find(self, d, lanes, before, asked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The digit whose interval holds a value, and that interval."""
        at = self.node(d, lanes, before)
        rows = self.cdf.take(at, axis=0)
        digit = np.count_nonzero(rows <= asked.astype(np.int16)[:, None], axis=1) - 1
        return digit, *self._learn(at, rows, digit)

    def _learn(self, at, rows, digit):
        flat = rows.reshape(-1)
        pick = PICK[: len(at)] + digit
        cum = flat.take(pick).astype(np.int64)
        # A row's end is the next row's start, which is not its bound.
        top = np.where(digit == 15, np.int64(WHOLE), flat.take(pick + 1, mode="clip"))
        seen = self.seen.take(at)
        rows += (TARGET.take(digit, axis=0) - rows) >> SHIFTS.take(seen)[:, None]
        self.cdf[at] = rows
        self.seen[at] = np.minimum(seen + 1, len(SHIFTS) - 1)
        return cum, top - cum


#: Where each lane's row starts.
PICK = np.arange(LANES, dtype=np.int64) * 16


def _digits(largest: int) -> int:
    """Four-bit digits that hold an id, an even number of them."""
    return max(2, 2 * -(-int(largest).bit_length() // 8))


def _narrow(low, size, cum, freq, bits):
    step = size >> np.uint64(bits)
    return low + step * cum.view(np.uint64), step * freq.view(np.uint64)


def _settle(low, size):
    """Lanes whose interval became too small, after cutting it at a word's edge."""
    small = np.flatnonzero(size <= MASK32)
    if len(small):
        l, s = low[small], size[small]
        crosses = (l >> np.uint64(32)) != ((l + s - np.uint64(1)) >> np.uint64(32))
        size[small] = np.where(crosses, (MASK32 ^ (l & MASK32)) + np.uint64(1), s)
    return small


class Writer:
    def __init__(self, lanes: int, room: int):
        self.low = np.zeros(lanes, np.uint64)
        self.size = np.full(lanes, FULL)
        self.out = np.zeros((lanes, room), np.uint32)
        self.used = np.zeros(lanes, np.int64)

    def put(self, lanes, cum, freq, bits) -> None:
        low, size = _narrow(self.low[lanes], self.size[lanes], cum, freq, bits)
        small = _settle(low, size)
        if len(small):
            where = small if isinstance(lanes, slice) else lanes[small]
            if self.used.max() + 1 >= self.out.shape[1]:
                self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
            self.out[where, self.used[where]] = (low[small] >> np.uint64(32)).astype(np.uint32)
            self.used[where] += 1
            low[small] = (low[small] & MASK32) << np.uint64(32)
            size[small] = size[small] << np.uint64(32)
        self.low[lanes], self.size[lanes] = low, size

    def words(self, lane: int) -> bytes:
        low = int(self.low[lane])
        tail = struct.pack("<2I", low >> 32, low & 0xFFFFFFFF)
        return self.out[lane, : self.used[lane]].astype("<u4").tobytes() + tail


class Reader:
    def __init__(self, blocks: list[bytes]):
        longest = max(len(b) // 4 for b in blocks) + 2
        self.words = np.zeros((len(blocks), longest), np.uint64)
        for i, b in enumerate(blocks):
            self.words[i, : len(b) // 4] = np.frombuffer(b, "<u4")
        self.code = (self.words[:, 0] << np.uint64(32)) | self.words[:, 1]
        self.used = np.full(len(blocks), 2)
        self.low = np.zeros(len(blocks), np.uint64)
        self.size = np.full(len(blocks), FULL)

    def ask(self, lanes, bits) -> np.ndarray:
        step = self.size[lanes] >> np.uint64(bits)
        return np.minimum((self.code[lanes] - self.low[lanes]) // step, np.uint64((1 << bits) - 1)).astype(np.int64)

    def take(self, lanes, cum, freq, bits) -> None:
        low, size = _narrow(self.low[lanes], self.size[lanes], cum, freq, bits)
        small = _settle(low, size)
        if len(small):
            where = small if isinstance(lanes, slice) else lanes[small]
            self.code[where] = ((self.code[where] & MASK32) << np.uint64(32)) | self.words[where, self.used[where]]
            self.used[where] += 1
            low[small] = (low[small] & MASK32) << np.uint64(32)
            size[small] = size[small] << np.uint64(32)
        self.low[lanes], self.size[lanes] = low, size


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Encoded blocks of ids (0 to 2**32 - 1), in the order given."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    for at in range(0, len(order), LANES):
        some = order[at : at + LANES]
        for i, block in zip(some, _encode([blocks[i] for i in some])):
            out[i] = block
    return out


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    sizes = np.array([len(b) for b in blocks])
    steps = int(sizes[0])
    ids = np.zeros((steps, len(blocks)), np.int64)
    for i, b in enumerate(blocks):
        ids[: len(b), i] = b
    digits = _digits(ids.max() if steps else 0)
    model, writer = Model(len(blocks), digits), Writer(len(blocks), steps + 16)
    running = np.searchsorted(-sizes, -np.arange(steps), side="left")
    for t in range(steps):
        k = int(running[t])
        now, lanes = ids[t, :k], slice(0, k)
        guess, chance = model.predict(k)
        hit = guess == now
        writer.put(lanes, np.where(hit, 0, chance), np.where(hit, chance, 4096 - chance), 12)
        missed = np.flatnonzero(~hit)
        if len(missed):
            value, before = now[missed], np.zeros(len(missed), np.int64)
            for d in range(0, digits, 2):
                # Two digits share a step of the coder: their intervals are nested.
                digit = (value >> (4 * (digits - 1 - d))) & 15
                cum, freq = model.see(d, missed, before, digit)
                before = (before << 4) | digit
                digit = (value >> (4 * (digits - 2 - d))) & 15
                cum2, freq2 = model.see(d + 1, missed, before, digit)
                before = (before << 4) | digit
                writer.put(missed, (cum << BITS) + freq * cum2, freq * freq2, 2 * BITS)
        model.learn(k, now, hit)
    out = []
    for i, b in enumerate(blocks):
        words = writer.words(i)
        raw = np.asarray(b).astype("<u4").tobytes()
        out.append(HEADER.pack(len(b), len(words) // 4, digits, crc32(raw), crc32(words)) + words)
    return out


def split(data: bytes) -> list[tuple[int, int, int, bytes]]:
    """(ids, digits, checksum of the ids, coded words) of each block of a payload."""
    out, at = [], 0
    while at < len(data):
        n, words, digits, of_ids, of_words = HEADER.unpack_from(data, at)
        at += HEADER.size
        body = data[at : at + 4 * words]
        at += 4 * words
        if len(body) != 4 * words or crc32(body) != of_words:
            raise ValueError("damaged block: the coded words do not match their checksum")
        out.append((n, digits, of_ids, body))
    return out


def decode(blocks: list[tuple[int, int, int, bytes]]) -> list[np.ndarray]:
    """Ids of blocks as :func:`split` gives them."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: (blocks[i][1], -blocks[i][0]))
    at = 0
    while at < len(order):
        digits = blocks[order[at]][1]
        some = [i for i in order[at : at + LANES] if blocks[i][1] == digits]
        at += len(some)
        for i, ids in zip(some, _decode([blocks[i] for i in some], digits)):
            if crc32(ids.astype("<u4").tobytes()) != blocks[i][2]:
                raise ValueError("damaged block: the ids do not match their checksum")
            out[i] = ids
    return out


def _decode(blocks: list[tuple[int, int, int, bytes]], digits: int) -> list[np.ndarray]:
    sizes = np.array([b[0] for b in blocks])
    steps = int(sizes[0])
    ids = np.zeros((steps, len(blocks)), np.int64)
    model, reader = Model(len(blocks), digits), Reader([b[3] for b in blocks])
    running = np.searchsorted(-sizes, -np.arange(steps), side="left")
    for t in range(steps):
        k = int(running[t])
        lanes = slice(0, k)
        guess, chance = model.predict(k)
        hit = reader.ask(lanes, 12) < chance
        reader.take(lanes, np.where(hit, 0, chance), np.where(hit, chance, 4096 - chance), 12)
        now = guess.copy()
        missed = np.flatnonzero(~hit)
        if len(missed):
            before = np.zeros(len(missed), np.int64)
            for d in range(0, digits, 2):
                asked = reader.ask(missed, 2 * BITS)
                digit, cum, freq = model.find(d, missed, before, asked >> BITS)
                before = (before << 4) | digit
                digit, cum2, freq2 = model.find(d + 1, missed, before, (asked - (cum << BITS)) // freq)
                before = (before << 4) | digit
                reader.take(missed, (cum << BITS) + freq * cum2, freq * freq2, 2 * BITS)
            now[missed] = before
        ids[t, :k] = now
        model.learn(k, now, hit)
    return [ids[:n, i].copy() for i, n in enumerate(sizes.tolist())]
