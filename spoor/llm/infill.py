"""Fill-in-middle transformation of texts kept as seekable compressed frames.

A text is cut in units (a run of letters A-Z, a-z, or one other character) and, by two
hashes of its id, in prefix, middle and suffix, which are put in another order with a mark
before each: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm), or suffix first (spm). Some
documents stay plain, and all that are empty or hold a mark.

Texts and outputs are held as independent zstandard frames of at most FRAME_BYTES, with the counts
of units, characters and bytes before each. A cut decompresses the one frame that its unit
begins in; digests and outputs stream the frames in order. So a task holds, beside the row
itself, compressed frames and one frame in the clear.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.words import portions

SEED = "1"
PLAIN_FROM = 90
"""Documents whose third number is this or more, of 100, stay plain."""
SPM_BELOW = 20
"""Of the others, those whose fourth number is below this, of 100, have the suffix first."""
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FRAME_BYTES = 1 << 16
OUT_ROWS = 500

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_FIRST = np.ones(256, dtype=bool)
_FIRST[0x80:0xC0] = False


class Frames:
    """Text in independent compressed frames, cut between characters.

    data: the frames; units, chars, size: how many units begin, characters and bytes lie,
    before each, and at last in the whole text.
    """

    def __init__(self, pieces: Iterable[bytes] = (), frame_bytes: int = FRAME_BYTES):
        self.data: list[bytes] = []
        self.units, self.chars, self.size = [0], [0], [0]
        self._held: tuple[int, bytes] = (-1, b"")
        press, letter, rest = zstandard.ZstdCompressor(level=1), False, b""
        for piece in pieces:
            rest = rest + piece if rest else piece
            begin = 0
            while len(rest) - begin > frame_bytes:
                end = begin + frame_bytes
                while 0x80 <= rest[end] < 0xC0:
                    end -= 1
                letter = self._add(press, rest[begin:end], letter)
                begin = end
            rest = rest[begin:]
        if rest:
            self._add(press, rest, letter)

    def _add(self, press, part: bytes, letter: bool) -> bool:
        codes = np.frombuffer(part, np.uint8)
        self.units.append(self.units[-1] + int(np.count_nonzero(_begins(codes, letter))))
        self.chars.append(self.chars[-1] + int(np.count_nonzero(_FIRST[codes])))
        self.size.append(self.size[-1] + len(part))
        self.data.append(press.compress(part))
        return bool(_LETTER[codes[-1]])

    def part(self, k: int) -> bytes:
        """Frame k in the clear; the last one asked for is kept."""
        if self._held[0] != k:
            self._held = (k, zstandard.ZstdDecompressor().decompress(self.data[k]))
        return self._held[1]

    def cut(self, unit: int) -> tuple[int, int]:
        """(bytes, characters) before a unit, from 0; of the whole text behind the last."""
        if unit >= self.units[-1]:
            return self.size[-1], self.chars[-1]
        k = int(np.searchsorted(self.units, unit, side="right")) - 1
        codes = np.frombuffer(self.part(k), np.uint8)
        letter = k > 0 and self._ends_in_letter(k - 1)
        at = int(np.flatnonzero(_begins(codes, letter))[unit - self.units[k]])
        return self.size[k] + at, self.chars[k] + int(np.count_nonzero(_FIRST[codes[:at]]))

    def _ends_in_letter(self, k: int) -> bool:
        held = self._held
        last = self.part(k)[-1]
        self._held = held
        return bool(_LETTER[last])

    def read(self, begin: int, end: int) -> Iterator[bytes]:
        """The bytes from begin to end, frame by frame."""
        k = max(int(np.searchsorted(self.size, begin, side="right")) - 1, 0)
        while begin < end:
            part = self.part(k)
            yield part[begin - self.size[k] : end - self.size[k]]
            begin = self.size[k + 1]
            k += 1

    def find(self, mark: bytes, begin: int) -> int:
        """Where mark first stands from begin on."""
        before, at = b"", begin
        for part in self.read(begin, self.size[-1]):
            window = before + part
            place = window.find(mark)
            if place >= 0:
                return at - len(before) + place
            at += len(part)
            before = window[-(len(mark) - 1) :]
        raise ValueError(f"no {mark!r}")


def _begins(codes: np.ndarray, letter: bool) -> np.ndarray:
    """Whether a unit begins at each byte; letter: the byte before is one."""
    letters = _LETTER[codes]
    after = np.append(letter, letters[:-1])
    return _FIRST[codes] & ~(letters & after)


def numbers(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four numbers below 2^32 made from the id (``null`` for none)."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def infilled(text: Frames, form: str, first: int, second: int) -> Iterator[bytes]:
    """The output of a form, with cuts before bytes first and second."""
    prefix, middle, suffix = text.read(0, first), text.read(first, second), text.read(second, text.size[-1])
    if form == "plain":
        yield from text.read(0, text.size[-1])
        return
    early, late = ((PREFIX, prefix), (SUFFIX, suffix)) if form == "psm" else ((SUFFIX, suffix), (PREFIX, prefix))
    for mark, part in (early, late, (MIDDLE, middle)):
        yield mark
        yield from part


def rebuilt(output: Frames, form: str) -> Iterator[bytes]:
    """The text that an output of a form was made from."""
    end = output.size[-1]
    if form == "plain":
        yield from output.read(0, end)
        return
    early, late = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one = output.find(early, 0)
    two = output.find(late, one + len(early))
    three = output.find(MIDDLE, two + len(late))
    parts = {early: (one + len(early), two), late: (two + len(late), three), MIDDLE: (three + len(MIDDLE), end)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.read(*parts[mark])


def _digest(parts: Iterable[bytes]) -> str:
    whole = hashlib.sha256()
    for part in parts:
        whole.update(part)
    return whole.hexdigest()


def _transformed(doc_id: int | None, text: bytes, seed: str, with_output: bool, frame_bytes: int) -> tuple:
    store = Frames([text], frame_bytes)
    n = store.units[-1]
    one, two, three, four = numbers(doc_id, seed)
    low, high = sorted((one % (n + 1), two % (n + 1)))
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or three % 100 >= PLAIN_FROM:
        form, first, second, chars = "plain", 0, 0, (None, None)
    else:
        form = "spm" if four % 100 < SPM_BELOW else "psm"
        (first, before), (second, until) = store.cut(low), store.cut(high)
        chars = (before, until - before)
    output = Frames(infilled(store, form, first, second), frame_bytes)
    whole = b"".join(output.read(0, output.size[-1])) if with_output else None
    return n, form, *chars, whole, _digest(output.read(0, output.size[-1])), _digest(rebuilt(output, form))


_KINDS = {
    "n": pa.int64(),
    "form": pa.string(),
    "prefix_chars": pa.int64(),
    "middle_chars": pa.int64(),
    "output": pa.string(),
    "output_sha256": pa.string(),
    "restored_sha256": pa.string(),
}


def transformed(
    docs: DataFrame,
    seed: str = SEED,
    keep: list[str] | None = None,
    with_output: bool = True,
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """(row, doc_id, n, form, prefix_chars, middle_chars, output, output_sha256,
    restored_sha256): docs' columns in ``row``; n counts units, the digests are of output
    and of the text rebuilt from it.

    keep: the columns of docs that row takes along; all, if not given. with_output: false
    leaves output null where only its digest is wanted.
    docs: doc_id, text and any other columns. A null text counts as empty and stays plain;
    a null doc_id counts as the text ``null`` in the hashes. Rows are handled alone, so
    repeated ones get equal results. An empty table gives an empty one.
    """
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1):
            for a in range(0, len(batch), OUT_ROWS):
                part = batch.slice(a, OUT_ROWS)
                ids, texts = part.column(0).to_pylist(), part.column(1).cast(pa.binary())
                made = [_transformed(i, t.as_py() or b"", seed, with_output, frame_bytes) for i, t in zip(ids, texts)]
                columns = [
                    pa.array(values, pa.binary()).cast(kind) if name == "output" else pa.array(values, kind)
                    for values, (name, kind) in zip(zip(*made), _KINDS.items())
                ]
                whole = pa.StructArray.from_arrays(part.columns[2:], keep)
                yield pa.RecordBatch.from_arrays([whole, part.column(0), *columns], ["row", "doc_id", *_KINDS])

    kept = [F.col(f"`{c}`") for c in keep]
    taken = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.col("text").alias("own_text"), *kept)
    return taken.mapInArrow(
        run,
        f"row {docs.select(*kept).schema.simpleString()}, doc_id long, n long, form string, prefix_chars long,"
        " middle_chars long, output string, output_sha256 string, restored_sha256 string",
    )


def restored(outputs: DataFrame) -> DataFrame:
    """outputs (form, output and any other columns but ``text``) with the text they were
    made from. A null form or output gives a null text."""
    names = outputs.columns
    at = names.index("output")

    def back(row: dict) -> bytes | None:
        if row["form"] is None or row["output"] is None:
            return None
        return b"".join(rebuilt(Frames([row["output"].encode()]), row["form"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, at):
            found = [back(r) for r in batch.select(["form", "output"]).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary()).cast(pa.string())], [*names, "text"]
            )

    fields = outputs.schema.simpleString()[len("struct<") : -1]
    return outputs.mapInArrow(run, f"struct<{fields}{',' if fields else ''}text:string>")


def framed(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """docs with ``frames`` in place of text, to be stored: array of (data, units, chars,
    bytes), a compressed frame and the counts before it. A null or empty text has none."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64())])
        )
        for batch in portions(batches, 0):
            found = []
            for text in batch.column(0).cast(pa.binary()):
                store = Frames([text.as_py() or b""], frame_bytes)
                rows = zip(store.data, store.units, store.chars, store.size)
                found.append([dict(zip(("data", "units", "chars", "bytes"), r)) for r in rows])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, kind)], [*others, "frames"])

    rest = docs.select("text", *[F.col(f"`{c}`") for c in others])
    fields = docs.select(*[F.col(f"`{c}`") for c in others]).schema.simpleString()[len("struct<") : -1]
    return rest.mapInArrow(
        run,
        f"struct<{fields}{',' if fields else ''}frames:array<struct<data:binary,units:bigint,chars:bigint,bytes:bigint>>>",
    )
