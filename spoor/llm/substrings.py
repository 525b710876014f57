"""Removing word sequences that stand elsewhere too, by super-k-mer partitioning.

A window is 35 consecutive words of one document. Its minimiser is the least hash of
the 5-word runs in it. Consecutive windows with the same minimiser occurrence travel as
one packed string (a super-k-mer) to the minimiser's bucket, so that equal windows meet
there; the bucket sorts its windows and compares equal hashes word for word.

Sizes: buckets are as many as the text needs at BUCKET_BYTES each. A first pass over all
texts adds up what each bucket would get; windows of a bucket beyond HOT times that are
dealt to buckets of their own by a second run, at a fixed distance from the minimiser.
Equal strings of a task go out once, with a mark, so a passage that a third of all
documents share costs its bucket one string for each task. The ranges that such a mark
settles are merged and dealt over all buckets by row, whatever the text.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.tables import text_key
from spoor.llm.words import Words, mix, pieces_of, portions, runs_hash

WINDOW = 35
RUN = 5
SPAN = WINDOW - RUN + 1
ASIDE = SPAN // 2
BUCKET_BYTES = 8 << 20
HOT = 4
FLUSH_BYTES = 32 << 20
EXPANSION = 3.2
"""Packed bytes for each byte of text: a super-k-mer has 16 windows on average, and
34 words more."""
_PLACE = np.uint64((1 << 28) - 1)


def _squeezed(text: bytes | None) -> bytes:
    return b" ".join((text or b"").split())


class Buckets:
    """Which bucket a window goes to. hot: the buckets that are dealt on, each with its
    first further bucket and how many it has."""

    def __init__(self, count: int, hot: dict[int, tuple[int, int]]):
        self.count = count
        self.total = count + sum(n for _, n in hot.values())
        self.names = np.array(sorted(hot), np.int64)
        self.parts = np.array([hot[k] for k in sorted(hot)], np.int64).reshape(-1, 2)

    def of(self, runs: np.ndarray, place: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Of the windows that begin at word ``window`` and have their minimiser at ``place``."""
        bucket = (runs[place] % np.uint64(self.count)).astype(np.int64)
        if len(self.names):
            found = np.searchsorted(self.names, bucket).clip(max=len(self.names) - 1)
            hot = np.flatnonzero(self.names[found] == bucket)
            first, parts = self.parts[found[hot]].T
            at = place[hot]
            aside = np.where(at - window[hot] + ASIDE < SPAN, at + ASIDE, at - ASIDE)
            bucket[hot] = first + (mix(runs[at] ^ mix(runs[aside])) % parts.astype(np.uint64)).astype(np.int64)
        return bucket

    def of_rows(self, docs: list[int], keys: list[int], rows: list[int]) -> list[int]:
        """Of the settled ranges of rows; copies of a text, with or without doc_id, part."""
        parts = (np.array(x, np.int64).view(np.uint64) for x in (docs, keys, rows))
        total = np.zeros(len(docs), np.uint64)
        for part in parts:
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + part)
        return (total % np.uint64(self.count)).tolist()


def super_kmers(words: Words, buckets: Buckets) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, bucket) of each; windows by their first word."""
    single = words.hashes()
    runs = runs_hash(single, RUN)
    count = len(words) - WINDOW + 1
    if count <= 0:
        return (np.zeros(0, np.int64),) * 4
    low = (runs & ~_PLACE) | np.arange(len(runs), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (SPAN - width)], low[SPAN - width :])
    place = (low & _PLACE).astype(np.int64)
    text = np.searchsorted(words.first, np.arange(count), side="right") - 1
    window = np.flatnonzero(np.arange(count) + WINDOW <= words.first[text + 1])
    if not len(window):
        return (np.zeros(0, np.int64),) * 4
    place, text = place[window], text[window]
    bucket = buckets.of(runs, place, window)
    begin = np.ones(len(window), bool)
    begin[1:] = (np.diff(window) > 1) | (np.diff(place) != 0) | (np.diff(bucket) != 0) | (np.diff(text) != 0)
    first = np.flatnonzero(begin)
    last = np.append(first[1:], len(window)) - 1
    return text[first], window[first], window[last], bucket[first]


class _Parcel:
    """What a task has for one bucket: strings with their owners, and settled ranges."""

    def __init__(self) -> None:
        self.strings: dict[bytes, int] = {}
        self.owners: list[tuple] = []
        self.often: list[bool] = []
        self.ranges: list[tuple] = []

    def packed(self) -> bytes:
        text = b"\n".join(self.strings)
        parts = [
            _rows(self.owners, 4),
            np.array(self.often, np.int8).tobytes(),
            _rows(self.ranges, 5),
            text,
        ]
        head = struct.pack("<4q", *map(len, parts))
        return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def _rows(rows: list[tuple], width: int) -> bytes:
    return np.array(rows, np.int64).reshape(-1, width).tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    parts, at = [], 32
    for size in struct.unpack("<4q", data[:32]):
        parts.append(data[at : at + size])
        at += size
    owners, often, ranges, text = parts
    return (
        np.frombuffer(owners, np.int64).reshape(-1, 4),
        np.frombuffer(often, np.int8).astype(bool),
        np.frombuffer(ranges, np.int64).reshape(-1, 5),
        text.split(b"\n") if text else [],
    )


def _deal(buckets: Buckets):
    """(doc_id, text_key, text) -> (bucket, blob)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels: dict[int, _Parcel] = {}
        held = seen = 0

        def flush() -> pa.RecordBatch:
            names = list(parcels)
            blobs = [parcels.pop(k).packed() for k in names]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"]
            )

        for batch in portions(batches, 2):
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = (_squeezed(t) for t in batch.column(2).cast(pa.binary()).to_pylist())
            for base, piece in pieces_of(texts):
                words = Words(piece)
                settled: list[list[int]] = []  # row in the batch, begin, end
                for t, a, b, bucket in zip(*(x.tolist() for x in super_kmers(words, buckets))):
                    string = words.buffer[words.starts[a] : words.ends[b + WINDOW - 1]]
                    doc, key, at = ids[base + t], keys[base + t], a - int(words.first[t])
                    parcel = parcels.setdefault(bucket, _Parcel())
                    known = parcel.strings.setdefault(string, len(parcel.owners))
                    if known == len(parcel.owners):
                        parcel.owners.append((doc is None, doc or 0, key, at))
                        parcel.often.append(False)
                        held += len(string) + 48
                        continue
                    parcel.often[known] = True
                    end = at + b - a + WINDOW
                    if settled and settled[-1][0] == base + t and at <= settled[-1][2]:
                        settled[-1][2] = end
                    else:
                        settled.append([base + t, at, end])
                rows = [r for r, _, _ in settled]
                dealt = buckets.of_rows([ids[r] or 0 for r in rows], [keys[r] for r in rows], [seen + r for r in rows])
                for (r, begin, end), bucket in zip(settled, dealt):
                    mine = parcels.setdefault(bucket, _Parcel())
                    mine.ranges.append((ids[r] is None, ids[r] or 0, keys[r], begin, end))
                held += 48 * len(settled)
                if held > FLUSH_BYTES:
                    yield flush()
                    held = 0
            seen += len(batch)
        if parcels:
            yield flush()

    return run


def _measure(buckets: Buckets):
    """text -> (bucket, size): the packed bytes that each bucket would get."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[int, int] = {}
        for batch in portions(batches, 0):
            texts = (_squeezed(t) for t in batch.column(0).cast(pa.binary()).to_pylist())
            for _, piece in pieces_of(texts):
                words = Words(piece)
                _, a, b, bucket = super_kmers(words, buckets)
                size = words.ends[b + WINDOW - 1] - words.starts[a]
                names, place = np.unique(bucket, return_inverse=True)
                for name, more in zip(names.tolist(), np.bincount(place, size, len(names)).tolist()):
                    sizes[name] = sizes.get(name, 0) + int(more)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sizes.keys(), pa.int64()), pa.array(sizes.values(), pa.int64())], ["bucket", "size"]
        )

    return run


def repeated_windows(strings: list[bytes], often: np.ndarray) -> list[tuple[int, int, int]]:
    """(string, first, last): runs of windows in it that stand elsewhere too; windows of
    strings marked ``often`` do in any case. Sorts the hashes of all windows, then
    compares the words of equal ones."""
    hashes, owner, offset, begin, end = [], [], [], [], []
    base = 0
    for first, piece in pieces_of(strings):
        words = Words(piece)
        runs = runs_hash(words.hashes(), WINDOW)
        string = np.searchsorted(words.first, np.arange(len(runs)), side="right") - 1
        here = np.flatnonzero(np.arange(len(runs)) + WINDOW <= words.first[string + 1])
        hashes.append(runs[here])
        owner.append((string[here] + first).astype(np.int32))
        offset.append((here - words.first[string[here]]).astype(np.int32))
        begin.append(words.starts[here] + base)
        end.append(words.ends[here + WINDOW - 1] + base)
        base += len(words.buffer)
    if not hashes:
        return []
    text = b"".join(s + b"\n" for s in strings)
    value, owner, offset = np.concatenate(hashes), np.concatenate(owner), np.concatenate(offset)
    begin, end = np.concatenate(begin), np.concatenate(end)
    twice = often[owner]
    order = np.argsort(value, kind="stable")
    same = np.flatnonzero(value[order[1:]] == value[order[:-1]])
    odd = set()
    for x, y in zip(order[same].tolist(), order[same + 1].tolist()):
        if text[begin[x] : end[x]] == text[begin[y] : end[y]]:
            twice[x] = twice[y] = True
        else:
            odd.add(int(value[x]))
    for hashed in odd:
        seen: dict[bytes, int] = {}
        for x in np.flatnonzero(value == np.uint64(hashed)).tolist():
            known = seen.setdefault(text[begin[x] : end[x]], x)
            if known != x:
                twice[x] = twice[known] = True
    hit = np.flatnonzero(twice)
    if not len(hit):
        return []
    cut = np.flatnonzero((np.diff(hit) > 1) | (np.diff(owner[hit]) != 0))
    first, last = hit[np.append(0, cut + 1)], hit[np.append(cut, len(hit) - 1)]
    return list(zip(owner[first].tolist(), offset[first].tolist(), offset[last].tolist()))


def _count(group: pd.DataFrame) -> pd.DataFrame:
    strings, owners, often, settled = [], [], [], []
    for blob in group["blob"]:
        o, m, r, s = _unpacked(blob)
        owners.append(o)
        often.append(m)
        settled.append(r)
        strings += s
    owner = np.concatenate(owners)
    rows = [np.concatenate(settled)]
    found = repeated_windows(strings, np.concatenate(often)) if strings else []
    if found:
        string, first, last = np.array(found, np.int64).T
        own = owner[string]
        rows.append(np.column_stack([own[:, :3], own[:, 3] + first, own[:, 3] + last + WINDOW]))
    none, doc, key, begin, end = np.concatenate(rows).T
    ids = pd.array(doc, dtype="Int64")
    ids[none.astype(bool)] = pd.NA
    return pd.DataFrame({"doc_id": ids, "text_key": key, "begin": begin, "end": end})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rest, text, ranges) -> (rest, counts, kept)"""
    for batch in portions(batches, 1):
        kept, total, removed = [], [], []
        for text, ranges in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
            words = (text or b"").split()
            total.append(len(words))
            if ranges:
                gone = np.zeros(len(words) + 1, np.int64)
                for r in ranges:
                    gone[r["begin"]] += 1
                    gone[r["end"]] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                words = [w for w, s in zip(words, stay.tolist()) if s]
            removed.append(total[-1] - len(words))
            kept.append(None if text is None else b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([hashlib.sha256(k or b"").hexdigest() for k in kept]),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["rest", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def _buckets(docs: DataFrame) -> Buckets:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    plain = Buckets(max(1, int(size * EXPANSION / BUCKET_BYTES)), {})
    large = (
        docs.select("text")
        .mapInArrow(_measure(plain), "bucket long, size long")
        .groupBy("bucket")
        .agg(F.sum("size").alias("size"))
        .filter(F.col("size") > HOT * BUCKET_BYTES)
    )
    # Fewer than a HOT-th of the buckets can be that large.
    hot, total = {}, plain.count
    for bucket, bytes_ in large.collect():
        parts = -(-bytes_ // BUCKET_BYTES)
        hot[bucket] = (total, parts)
        total += parts
    return Buckets(plain.count, hot)


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, ranges): the word ranges to remove, for documents that have some."""
    dealt = docs.mapInArrow(_deal(_buckets(docs)), "bucket long, blob binary")
    ranges = dealt.groupBy("bucket").applyInPandas(
        _count, "doc_id long, text_key long, begin long, end long"
    )
    return ranges.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """(rest, n_words, n_removed, kept_sha256, kept) for each row of docs; ``rest`` has
    all its columns but text.

    docs: doc_id, text, and any other columns. A null text has no words; kept is null
    then, and kept_sha256 that of an empty text. Rows may repeat and doc_id may be null:
    each row counts as a document, and equal rows get equal results. Texts under 35
    words lose nothing. An empty table gives an empty one.
    """
    rest = [docs[f"`{c}`"] for c in docs.columns if c != "text"]
    source = docs.select(
        F.struct(*rest).alias("rest"),
        docs["doc_id"].cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        docs["text"].alias("text"),
    )
    ranges = removed_ranges(source.select("doc_id", "text_key", "text")).toDF("r_id", "r_key", "ranges")
    joined = source.join(
        ranges, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key")), "left"
    ).select("rest", "text", "ranges")
    kind = source.schema["rest"].dataType.simpleString()
    return joined.mapInArrow(
        _cut, f"rest {kind}, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """docs with the words that stay as text, joined by one space; n_chars, where docs
    have it, is counted anew. A null text stays null, and no row goes."""
    found = without_repeats(docs)
    columns = []
    for name in docs.columns:
        if name == "text":
            value = F.col("kept")
        elif name == "n_chars":
            value = F.when(F.col("kept").isNull(), F.col(f"rest.`{name}`")).otherwise(
                F.length("kept").cast(docs.schema[name].dataType)
            )
        else:
            value = F.col(f"rest.`{name}`")
        columns.append(value.alias(name))
    return found.select(*columns)
