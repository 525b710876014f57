"""Importance resampling of documents towards the distribution of target texts.

Features are runs of 1 to ``words`` consecutive words, hashed (crc32) to buckets. What a
bucket is worth is the log ratio of its share in the target to its share in the corpus,
smoothed by one; a document weighs the sum over its features. A Gumbel number made from
its id is added, and the documents with the highest sums are the draw, without
replacement, by their weights.

Inside a task the features of a piece of text are interned in an open-addressed table of
NumPy arrays: xxhash64 is the key, the bytes are compared before two count as one, and
each slot holds its feature's bucket and count. The bucket is worked out once a slot; a
document's weight gathers the gains by its features' slots.

The corpus is read twice, to count buckets and to weigh; between the two only the buckets'
sums (``buckets`` rows) pass through the driver. Ranks come from a sort by ranges of the
scores and the sizes of these ranges.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spoor.llm.tables import written
from spoor.llm.words import LOWER, pieces_of, portions

WORDS = 1
BUCKETS = 10_000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
BLOCK = 1 << 17
"""Features interned at a time."""

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

# The five primes of xxhash64: fixed values.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)
_SHORT = 32
"""Longer features are hashed one by one, by the library."""


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def hashes(lanes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of strings below 32 bytes: row j of lanes has bytes 8j to 8j + 7 of
    each, little-endian, zero beyond the end."""
    h = length.astype(np.uint64) + _P5
    for j in range(3):
        whole = length >= 8 * (j + 1)
        h = np.where(whole, _turned(h ^ (_turned(lanes[j] * _P2, 31) * _P1), 27) * _P1 + _P4, h)
    tail = np.take_along_axis(lanes, (length // 8)[None], 0)[0]
    rest = length % 8
    half = rest >= 4
    h = np.where(half, _turned(h ^ ((tail & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3, h)
    tail = np.where(half, tail >> np.uint64(32), tail)
    rest = rest % 4
    for j in range(3):
        byte = (tail >> np.uint64(8 * j)) & np.uint64(0xFF)
        h = np.where(rest > j, _turned(h ^ (byte * _P5), 11) * _P1, h)
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


class Features:
    """The runs of 1 to ``words`` words of some texts: ``first`` counts the words before
    each text; run (n, k) is the n words from word k, if they lie in one text."""

    def __init__(self, texts: list[bytes], words: int = WORDS):
        data = np.frombuffer(b"\n".join(texts).translate(LOWER) + b"\n", np.uint8)
        inside = _WORD[data]
        after = np.append(False, inside[:-1])
        # Words joined by one space: word bytes, and the first byte behind each word.
        stays = inside | after
        starts = np.flatnonzero(inside & ~after)
        ends = np.flatnonzero(after & ~inside)
        moved = np.cumsum(stays)
        self.first = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
        self.starts, self.ends = moved[starts] - 1, moved[ends] - 1
        plain = np.where(inside, data, 32)[stays].astype(np.uint8).tobytes()
        self.plain = plain + bytes(_SHORT)
        self.words = words

    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def counts(self) -> np.ndarray:
        """Features of each text."""
        return sum(np.maximum(self.n_words() - n + 1, 0) for n in range(1, self.words + 1))

    def blocks(self, size: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, start, length) of the features, in blocks; texts in order in each."""
        text = np.repeat(np.arange(len(self.first) - 1), self.n_words())
        for n in range(1, self.words + 1):
            for a in range(0, len(self.starts) - n + 1, size):
                k = np.arange(a, min(a + size, len(self.starts) - n + 1))
                k = k[text[k] == text[k + n - 1]]
                if len(k):
                    yield text[k], self.starts[k], self.ends[k + n - 1] - self.starts[k]


class Interned:
    """Strings ``plain[start:start + length]`` in an open-addressed table.

    slot: the slot of each; used: the slots in use; bucket, count: of each slot.
    """

    def __init__(self, plain: bytes, start: np.ndarray, length: np.ndarray, buckets: int):
        n = len(start)
        lanes = np.zeros((4, n), np.uint64)
        read = np.ndarray(len(plain) - 7, "<u8", plain, strides=(1,))
        short = length < _SHORT
        for j in range(4):
            here = np.flatnonzero(short & (length > 8 * j))
            more = np.minimum(length[here] - 8 * j, 8).astype(np.uint64)
            lanes[j, here] = read[start[here] + 8 * j] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * more))
        key = hashes(lanes, np.where(short, length, 0))
        for k in np.flatnonzero(~short).tolist():
            key[k] = xxhash.xxh64_intdigest(plain[start[k] : start[k] + length[k]])

        size = 1 << (2 * n).bit_length()
        owner = np.full(size, -1, np.int64)
        self.slot = (key & np.uint64(size - 1)).astype(np.int64)
        rest = np.arange(n)
        while len(rest):
            at = self.slot[rest]
            free = owner[at] < 0
            owner[at[free][::-1]] = rest[free][::-1]  # the first of equals claims the slot
            own = owner[at]
            same = (key[own] == key[rest]) & (length[own] == length[rest])
            same &= (lanes[:, own] == lanes[:, rest]).all(axis=0)
            for k in np.flatnonzero(same & (length[rest] >= _SHORT)).tolist():
                a, b, size_k = start[own[k]], start[rest[k]], length[own[k]]
                same[k] = plain[a : a + size_k] == plain[b : b + size_k]
            rest = rest[~same]
            self.slot[rest] = (self.slot[rest] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.bucket = np.zeros(size, np.int64)
        held = zip(start[owner[self.used]].tolist(), length[owner[self.used]].tolist())
        self.bucket[self.used] = [zlib.crc32(plain[a : a + m]) % buckets for a, m in held]
        self.count = np.bincount(self.slot, minlength=size)


def _counted(words: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in portions(batches, 0):
            for _, piece in pieces_of(t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()):
                features = Features(piece, words)
                for _, start, length in features.blocks():
                    table = Interned(features.plain, start, length, buckets)
                    np.add.at(totals, table.bucket[table.used], table.count[table.used])
        met = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(totals[met])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds."""
    found = (
        texts.select("text")
        .mapInArrow(_counted(words, buckets), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most ``buckets`` rows
    )
    totals = np.zeros(buckets, np.int64)
    totals[[r["bucket"] for r in found]] = [r["n"] for r in found]
    return totals


def gains(docs: DataFrame, target: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight, in thousandths."""
    own, wanted = (bucket_counts(t, words, buckets).tolist() for t in (docs, target))
    of_own, of_wanted = float(sum(own) + buckets), float(sum(wanted) + buckets)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * of_own / ((s + 1.0) * of_wanted))) for s, t in zip(own, wanted)],
        np.int64,
    )


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """A Gumbel number in thousandths, made from the id (``null`` for none)."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gain: np.ndarray, words: int = WORDS, seed: str = SEED, keep: list[str] | None = None
) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight, score): docs' columns in ``row``.

    gain: of gains(). keep: the columns of docs that row takes along; all, if not given.
    docs: doc_id, text and any other columns. A null or empty text and one without words
    has no features and weight 0; a null doc_id counts as the text ``null`` in the noise.
    Rows are weighed alone, so repeated ones get equal results. An empty table gives an
    empty one.
    """
    keep = docs.columns if keep is None else keep
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1):
            whole = pa.StructArray.from_arrays(batch.columns[2:], keep)
            ids = batch.column(0)
            texts = (t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist())
            for first, piece in pieces_of(texts):
                features = Features(piece, words)
                weight = np.zeros(len(piece), np.int64)
                for text, start, length in features.blocks():
                    table = Interned(features.plain, start, length, buckets)
                    worth = gain[table.bucket][table.slot]
                    begin = np.flatnonzero(np.diff(text, prepend=-1))
                    weight[text[begin]] += np.add.reduceat(worth, begin)
                own = ids.slice(first, len(piece))
                chance = np.array([noise(i, seed) for i in own.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        whole.slice(first, len(piece)),
                        own,
                        pa.array(features.n_words().astype(np.int64)),
                        pa.array(features.counts().astype(np.int64)),
                        pa.array(weight),
                        pa.array(weight + chance),
                    ],
                    ["row", "doc_id", "n_words", "n_features", "weight", "score"],
                )

    taken = [F.col("doc_id").cast("long").alias("own_id"), F.col("text").alias("own_text")]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    return docs.select(*taken, *[F.col(f"`{c}`") for c in keep]).mapInArrow(
        run,
        f"row {kept.schema.simpleString()}, doc_id long, n_words long, n_features long, weight long, score long",
    )


def ranked(found: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``found``, a result of scored(), with rank: 1, 2, 3 ... of the rows drawn, else null.

    Of the rows with least_words or more, percent of a hundred (rounded down) are drawn,
    by descending score; of ties the smaller doc_id goes first, nulls last. Rows that tie
    in both go in some order, one rank each, so that as many are drawn as without ties.
    """
    columns = found.columns
    # Written down, so that sampling the ranges does not weigh the texts once more. The
    # row's number lets a range end between rows that tie.
    kept = written(
        found.withColumn("able", F.col("n_words") >= least_words).withColumn("number", F.monotonically_increasing_id())
    )
    order = [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("number").asc()]
    # The place of a row: its partition, and below 2^33 its number there.
    placed = written(
        kept.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("part", F.expr("place div 8589934592"))
    # One row for each partition.
    parts = placed.filter("able").groupBy("part").agg(F.count("*").alias("n"))
    before = parts.select(
        "part",
        F.sum("n").over(Window.orderBy("part")).alias("until") - F.col("n"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).alias("all"),
    ).toDF("part", "before", "all")
    rank = F.col("before") + F.expr("place % 8589934592") + 1
    drawn = F.col("able") & (rank <= F.expr(f"all * {percent} div 100"))
    return placed.join(before, "part", "left").select(*columns, F.when(drawn, rank).cast("long").alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, words: int = WORDS, buckets: int = BUCKETS, **how) -> DataFrame:
    """The rows of docs that are drawn, with all their columns.

    target: text. docs, how: as in scored() and ranked(). Empty tables count as no
    features: with an empty target the draw favours rare features.
    """
    found = scored(docs, gains(docs, target, words, buckets), words)
    return ranked(found, **how).filter("rank IS NOT NULL").select("row.*")
