"""Words of text batches as arrays.

A word is a run of bytes other than space and the controls 09 to 0D, which is what
``bytes.split`` cuts at. Batches are cut into pieces of bounded size, so that the
arrays of one piece stay small whatever the length of the batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19
"""Bytes of text handled at a time; a longer text makes a piece of its own."""

PORTION_BYTES = 2 << 20
"""Bytes of text taken from a batch at a time."""

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
"""Translation of A-Z to a-z; all other bytes stay."""

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _table(seed: int, size: int) -> np.ndarray:
    draw = np.random.Generator(np.random.PCG64(seed))
    return draw.integers(0, 2**64, size, dtype=np.uint64, endpoint=False)


_BYTES = _table(11, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def portions(batches: Iterable[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches, cut so that column ``at`` (text or bytes) has about
    PORTION_BYTES in each; a longer text has one of its own. Nothing is copied."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size.astype(np.int64) + 64)
        begin = 0
        while begin < len(batch):
            done = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, done + PORTION_BYTES, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def pieces_of(texts: Iterable[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) of at most PIECE_BYTES or one text each."""
    held, size, first, k = [], 0, 0, -1
    for k, text in enumerate(texts):
        if held and size + len(text) > PIECE_BYTES:
            yield first, held
            held, size, first = [], 0, k
        held.append(text)
        size += len(text)
    if held:
        yield first, held


class Words:
    """The words of some texts: ``buffer[starts[i]:ends[i]]`` is word i;
    ``first[d]:first[d + 1]`` are the words of text d."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts) + b"\n"
        self.buffer = joined.translate(LOWER) if lower else joined
        data = np.frombuffer(self.buffer, dtype=np.uint8)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1))
        self.starts, self.ends = edge[::2], edge[1::2]
        if len(self.ends) < len(self.starts):
            self.ends = np.append(self.ends, len(data))
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.starts, begin)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self):
            return np.zeros(0, np.uint64)
        data = np.frombuffer(self.buffer, dtype=np.uint8)
        length = self.ends - self.starts
        total = int(length.sum())
        # positions of the words' bytes, and each byte's place in its word
        offset = np.cumsum(length) - length
        place = np.arange(total) - np.repeat(offset, length)
        value = _BYTES[data[place + np.repeat(self.starts, length)]]
        value *= _powers(_BASE, int(length.max()))[place]
        return mix(np.add.reduceat(value, offset) + length.astype(np.uint64))

    def text(self, a: int, b: int) -> bytes:
        """Words a to b - 1, joined by one space."""
        return b" ".join(self.buffer[self.starts[a] : self.ends[b - 1]].split()) if b > a else b""


_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    power = np.full(n, base, np.uint64)
    power[:1] = 1
    return np.multiply.accumulate(power, out=power)


def runs_hash(word: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive word hashes, crossing text ends too."""
    count = len(word) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * _powers(_INVERSE, len(word)), out=total[1:])
    return mix((total[n:] - total[:count]) * _powers(_BASE, count))
