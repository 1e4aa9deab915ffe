"""Elias-Fano sequences in numpy: non-decreasing numbers in about 2 + log2(range / length) bits each."""

from __future__ import annotations

import json
import mmap

import numpy as np

U64 = np.uint64


def _byte_selects() -> np.ndarray:
    """Row b, column r: the place of the r-th one of byte b."""
    table = np.zeros((256, 8), np.int64)
    for byte in range(256):
        places = [i for i in range(8) if byte >> i & 1]
        table[byte, : len(places)] = places
    return table


SELECTS = _byte_selects()
EACH, TOPS = U64(0x0101010101010101), U64(0x8080808080808080)
FIVES, THREES, FIFTEENS = U64(0x5555555555555555), U64(0x3333333333333333), U64(0x0F0F0F0F0F0F0F0F)


def select_in_word(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The place of the r-th one of each word: ones are added up by byte, in all bytes of a word at once."""
    sums = words - (words >> U64(1) & FIVES)
    sums = (sums & THREES) + (sums >> U64(2) & THREES)
    sums = ((sums + (sums >> U64(4))) & FIFTEENS) * EACH  # ones up to and with each byte
    wanted = r.astype(U64)
    shift = np.bitwise_count((wanted * EACH | TOPS) - sums & TOPS).astype(U64) << U64(3)  # bytes whose ones do not suffice
    before = sums << U64(8) >> shift & U64(255)
    return shift.astype(np.int64) + SELECTS[(words >> shift & U64(255)).astype(np.int64), (wanted - before).astype(np.int64)]


class Sequence:
    """Numbers by place, and places by number, for whole arrays at a time."""

    PARTS = ("shape", "low", "high", "ones", "zeros")

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        self.n, self.width = (int(x) for x in parts["shape"])
        self.low, self.high, self.ones, self.zeros = (parts[x] for x in self.PARTS[1:])

    @classmethod
    def build(cls, values: np.ndarray) -> Sequence:
        values = np.asarray(values, np.int64)
        n = len(values)
        most = int(values[-1]) + 1 if n else 1
        width = max(0, (most // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * width // 64 + 2, U64)
        if width:
            rest = (values & ((1 << width) - 1)).astype(U64)
            bit = np.arange(n, dtype=np.int64) * width
            word, shift = bit >> 6, (bit & 63).astype(U64)
            np.bitwise_or.at(low, word, rest << shift)
            over = shift + U64(width) > U64(64)
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (U64(64) - shift[over]))
        bits = np.zeros(((n + (most >> width) + 1) // 64 + 1) * 64, np.uint8)
        bits[(values >> width) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(U64)
        ones = np.append(0, np.cumsum(np.bitwise_count(high), dtype=np.int64))[:-1]
        zeros = np.arange(len(high), dtype=np.int64) * 64 - ones
        return cls({"shape": np.array([n, width], np.int64), "low": low, "high": high, "ones": ones.astype(np.uint32), "zeros": zeros.astype(np.uint32)})

    def _select(self, directory: np.ndarray, words: np.ndarray, flip: bool, i: np.ndarray) -> np.ndarray:
        at = np.searchsorted(directory, i, side="right") - 1
        found = words[at]
        return at * 64 + select_in_word(~found if flip else found, i - directory[at])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        bit = i * self.width
        word, shift = bit >> 6, (bit & 63).astype(U64)
        value = self.low[word] >> shift
        value |= np.where(shift > 0, self.low[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
        return (value & U64((1 << self.width) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return (self._select(self.ones, self.high, False, i) - i) << self.width | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """A place of each number, or -1; the numbers must not exceed the largest one."""
        x = np.asarray(x, np.int64)
        bucket = x >> self.width
        begin = np.zeros(len(x), np.int64)  # of the bucket's ones, after the zero of the bucket before
        later = np.flatnonzero(bucket > 0)
        begin[later] = self._select(self.zeros, self.high, True, bucket[later] - 1) + 1
        shift = (begin & 63).astype(U64)
        ahead = self.high[begin >> 6] >> shift
        run = np.bitwise_count(ahead ^ (ahead + U64(1))).astype(np.int64) - 1  # ones ahead in the word
        start = begin - bucket
        stop = start + run
        far = np.flatnonzero(run + (begin & 63) >= 63)  # they may go on in the next word
        stop[far] = self._select(self.zeros, self.high, True, bucket[far]) - bucket[far]
        wanted, end = x & ((1 << self.width) - 1), stop.copy()
        active = np.flatnonzero(start < stop)
        while active.size:
            middle = (start[active] + stop[active]) >> 1
            less = self._low(middle) < wanted[active]
            start[active[less]] = middle[less] + 1
            stop[active[~less]] = middle[~less]
            active = active[start[active] < stop[active]]
        out = np.full(len(x), -1, np.int64)
        inside = np.flatnonzero(start < end)
        hit = inside[self._low(start[inside]) == wanted[inside]]
        out[hit] = start[hit]
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays in one block, each aligned, behind a header of their places."""
    head, blocks, at = {}, [], 0
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array).tobytes()
        raw += b"\0" * (-len(raw) % 8)
        head[name] = (str(array.dtype), len(array), at)
        blocks.append(raw)
        at += len(raw)
    header = json.dumps(head).encode()
    header += b" " * (-len(header) % 8)
    return len(header).to_bytes(8, "little") + header + b"".join(blocks)


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, as views of the mapped memory."""
    with open(path, "rb") as file:
        block = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(block[:8], "little")
    head = json.loads(block[8 : 8 + size])
    return {
        name: np.frombuffer(block, np.dtype(kind), count, 8 + size + at) for name, (kind, count, at) in head.items()
    }
