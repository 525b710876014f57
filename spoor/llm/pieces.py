"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut where no piece can lie across, so mostly before spaces and punctuation.
A batch's distinct units stand in one text; its
suffixes are sorted once, and two binary searches per vocabulary piece give the range of
all its occurrences. The occurrences are edges between text positions. Sorted by where
they begin in their unit, they are relaxed wave by wave: an edge holds if it goes on from
a position that is reached, with a piece that the merges leave next to the one before.
That keeps exactly one piece ending at each position, the one which byte-pair merging
of the text up to there ends with, so following them back gives the encoding.

Models are SentencePiece files of byte-pair pieces with byte fallback, a dummy space in
front and no other normalisation; others are refused. Nothing here trains a tokenizer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁".encode()
CACHE_UNITS = 150_000
"""Encodings a worker remembers between batches."""
PART_BYTES = 1 << 20
"""Bytes of texts cut into units at a time; a longer text is a part of its own."""
BATCH_BYTES = 1 << 17
"""Bytes of distinct units sorted at a time; a longer unit is a batch of its own."""
_UNKNOWN = -1
_TABLE_BITS = 21
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a model, and the encodings of units seen so far."""

    def __init__(self, model: bytes):
        import sentencepiece

        made = sentencepiece.SentencePieceProcessor(model_proto=model)
        count = made.get_piece_size()
        self.text: list[bytes] = [b""] * count
        self.rank: dict[bytes, float] = {}
        self.ids: dict[bytes, int] = {}
        self.bytes = [-1] * 256
        for k in range(count):
            name = made.id_to_piece(k)
            if made.is_byte(k):
                self.bytes[int(name[1:-1], 16)] = k
                self.text[k] = bytes([int(name[1:-1], 16)])
            elif made.is_unknown(k):
                self.text[k] = " ⁇ ".encode()
            elif not made.is_control(k) and not made.is_unused(k):
                piece = name.encode().replace(SPACE, b" ")
                self.text[k] = piece
                self.rank[piece] = made.get_score(k)
                self.ids[piece] = k
        if -1 in self.bytes or made.encode("a  b ", out_type=str)[:1] != ["▁a"]:
            raise ValueError("not a byte-pair model with byte fallback and a dummy space")
        # Spaces stand alone at a unit's start; runs of them are merged by themselves.
        inner = sorted(p for p in self.ids if not p.startswith(b"  "))
        self.width = max(map(len, inner)) + 1
        # Byte pairs that stand in no piece: texts can be cut there.
        within = np.zeros(1 << 16, bool)
        for piece in self.ids:
            pair = np.frombuffer(piece, np.uint8).astype(np.int64)
            within[pair[:-1] * 256 + pair[1:]] = True
        for lead in range(0xC0, 0x100):  # nor inside a character
            within[lead * 256 : lead * 256 + 256] = True
        for byte in range(0x80, 0xC0):
            within[np.arange(256) * 256 + byte] = True
        self.border = ~within
        self.needles = np.array(inner, f"S{self.width}")
        self.above = np.array([p + b"\xff" for p in inner], f"S{self.width}")
        self.needle_ids = np.array([self.ids[p] for p in inner], np.int64)
        self.needle_size = np.array([len(p) for p in inner], np.int64)
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.pair = np.full(1 << _TABLE_BITS, -1, np.int64)
        self.answer = np.zeros(1 << _TABLE_BITS, bool)
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        self.edges_of: dict[tuple, list[tuple]] = {}
        self.runs: dict[int, list[int]] = {}
        self.units: dict[bytes, bytes] = {}

    # -- merging, for pairs of pieces and runs of spaces --------------------------------

    def merged(self, symbols: list[bytes]) -> list[bytes]:
        """Byte-pair merging: the best pair first, of equal ones the leftmost."""
        text, after = list(symbols), list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple] = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < len(text):
                both = text[k] + text[after[k]]
                if both in self.rank:
                    heapq.heappush(heap, (-self.rank[both], k, both))

        for k in range(len(text)):
            offer(k)
        while heap:
            _, k, both = heapq.heappop(heap)
            if text[k] and after[k] < len(text) and text[k] + text[after[k]] == both:
                gone = after[k]
                self.parts[both] = (text[k], text[gone])
                text[k], text[gone] = both, b""
                after[k] = after[gone]
                if after[gone] < len(text):
                    before[after[gone]] = k
                offer(before[k])
                offer(k)
        return [t for t in text if t]

    def edge(self, piece: bytes, side: int) -> list[tuple]:
        """What stands at the piece's left (0) or right (1) end while it is merged:
        (text, score of the merge that ends it), the whole first."""
        known = self.edges_of.get((piece, side))
        if known is None:
            known, ends, at = [], float("-inf"), piece
            while True:
                known.append((at, ends))
                if at not in self.parts:
                    symbols = _characters(at)
                    if len(symbols) == 1 or self.merged(symbols) != [at]:
                        break
                ends, at = self.rank[at], self.parts[at][side]
            self.edges_of[piece, side] = known
        return known

    def stays(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' text gives the two pieces; left -2: nothing
        stands before; _UNKNOWN: a character without a piece, which never merges.

        Merges go from the best score down, so a merge across the border happens exactly
        if its two sides stand there before better merges end them. Of equal merges the
        left one goes first."""
        if right == _UNKNOWN:
            return True
        if left < 0:
            symbols = _characters(self.text[right])
            return len(symbols) == 1 or self.merged(symbols) == [self.text[right]]
        for a, a_ends in self.edge(self.text[left], 1):
            for b, b_ends in self.edge(self.text[right], 0):
                score = self.rank.get(a + b)
                if score is not None and score > a_ends and score >= b_ends:
                    return False
        return True

    def all_stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """stays() for arrays. Answers are remembered in a table by hash of the pair."""
        code = (left + 2) * (1 << 32) + right + 2
        slot = ((code.astype(np.uint64) * _SPREAD) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        answers = self.answer[slot]
        miss = np.flatnonzero(self.pair[slot] != code)
        if len(miss):
            fresh, at, place = np.unique(code[miss], return_index=True, return_inverse=True)
            made = np.array([self.stays((c >> 32) - 2, (c & 0xFFFFFFFF) - 2) for c in fresh.tolist()], bool)
            answers[miss] = made[place]
            self.pair[slot[miss[at]]] = fresh
            # where two fresh pairs share a slot, the one whose code stands there counts
            mine = self.pair[slot[miss[at]]] == fresh
            self.answer[slot[miss[at[mine]]]] = made[mine]
        return answers

    def spaces(self, count: int) -> list[int]:
        if count not in self.runs:
            self.runs[count] = [self.ids[p] for p in self.merged([b" "] * count)]
        return self.runs[count]

    # -- matching -----------------------------------------------------------------------

    def edges(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, id, size) of every occurrence of every piece."""
        padded = np.frombuffer(text + bytes(self.width + 8), np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(padded, self.width)[: len(text)]
        order = _suffix_order(padded, len(text), self.width)
        ranked = view[order].view(f"S{self.width}").ravel()
        low = np.searchsorted(ranked, self.needles)
        high = np.searchsorted(ranked, self.above)
        found = high - low
        total = int(found.sum())
        place = np.arange(total) - np.repeat(np.cumsum(found) - found, found) + np.repeat(low, found)
        return order[place], np.repeat(self.needle_ids, found), np.repeat(self.needle_size, found)

    def matched(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of units that have one space at most, in front, and where each unit's
        begin; _UNKNOWN for characters without a piece."""
        text = b"\x00".join(units) + b"\x00"
        sizes = np.array([len(u) for u in units], np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        begin, piece, size = self.edges(text)
        data = np.frombuffer(text, np.uint8)
        # characters that no piece of their own covers
        starts = np.flatnonzero(((data & 0xC0) != 0x80) & (data != 0))
        length = np.diff(np.append(starts, len(data)))
        follows = np.flatnonzero(data == 0)
        length = np.minimum(length, follows[np.searchsorted(follows, starts)] - starts)
        have = np.zeros(len(data), bool)
        per = np.zeros(len(data), np.int64)
        per[starts] = length
        have[begin[per[begin] == size]] = True
        lone = ~have[starts]
        begin = np.concatenate([begin, starts[lone]])
        piece = np.concatenate([piece, np.full(int(lone.sum()), _UNKNOWN)])
        size = np.concatenate([size, length[lone]])
        depth = begin - first[np.searchsorted(first, begin, side="right") - 1]
        order = np.argsort(depth.astype(np.uint16) if sizes.max() < 1 << 16 else depth, kind="stable")
        begin, piece, size, depth = begin[order], piece[order], size[order], depth[order]
        nothing = -3
        last = np.full(len(data) + 1, nothing, np.int64)
        span = np.zeros(len(data) + 1, np.int64)
        wave = np.flatnonzero(np.diff(depth, prepend=-1))
        for a, b in zip(wave.tolist(), [*wave[1:].tolist(), len(depth)]):
            if depth[a] == 0:
                left, reached = np.full(b - a, -2), np.ones(b - a, bool)
            else:
                left = last[begin[a:b]]
                reached = left != nothing
            go = np.flatnonzero(reached)
            go = go[self.all_stay(left[go], piece[a:b][go])] + a
            last[begin[go] + size[go]] = piece[go]
            span[begin[go] + size[go]] = size[go]
        at, live = first + sizes, np.arange(len(units))
        back_unit, back_piece = [], []
        while len(live):
            ended = last[at[live]]
            if (ended == nothing).any():
                raise ValueError(f"no encoding: {units[live[int(np.argmax(ended == nothing))]][:80]!r}")
            back_unit.append(live)
            back_piece.append(ended)
            at[live] -= span[at[live]]
            live = live[at[live] > first[live]]
        unit, piece = np.concatenate(back_unit[::-1]), np.concatenate(back_piece[::-1])
        order = np.argsort(unit, kind="stable")
        counts = np.bincount(unit, minlength=len(units))
        return piece[order].astype(np.int32), np.append(0, np.cumsum(counts))

    def learn(self, units: list[bytes]) -> None:
        """Encodes units (as cut() has them) into self.units."""
        held: list[bytes] = []
        size = 0
        for unit in units:
            held.append(unit)
            size += len(unit) + 1
            if size > BATCH_BYTES:
                self._learn(held)
                held, size = [], 0
        if held:
            self._learn(held)

    def _learn(self, units: list[bytes]) -> None:
        space = self.ids.get(b" ", _UNKNOWN)
        plain = []
        for unit in units:
            word = unit.lstrip(b" ")
            if word:
                plain.append(unit if len(unit) - len(word) < 2 else b" " + word)
            else:
                self.units[unit] = np.array(self.spaces(len(unit)), np.int32).tobytes()
        if not plain:
            return
        flat, begin = self.matched(plain)
        odd = set((np.searchsorted(begin, np.flatnonzero(flat == _UNKNOWN), side="right") - 1).tolist())
        known, ends = flat.tobytes(), (begin * 4).tolist()
        first = flat[begin[:-1]].tolist()
        place = 0
        for unit in units:
            if unit in self.units:
                continue
            mine, alone = plain[place], first[place] == space
            ids = known[ends[place] : ends[place + 1]]
            if place in odd:
                ids = self._with_bytes(mine, np.frombuffer(ids, np.int32).tolist())
            more = len(unit) - len(mine)
            if more:  # the rest of a run of spaces, and a space that stayed alone
                run = np.array(self.spaces(more + 1 if alone else more), np.int32).tobytes()
                ids = run + (ids[4:] if alone else ids)
            self.units[unit] = ids
            place += 1

    def _with_bytes(self, text: bytes, pieces: list[int]) -> bytes:
        ids: list[int] = []
        at = 0
        for piece in pieces:
            if piece == _UNKNOWN:
                character = _first(text, at)
                ids += [self.bytes[b] for b in character]
                at += len(character)
            else:
                ids.append(piece)
                at += len(self.text[piece])
        return np.array(ids, np.int32).tobytes()

    def cut(self, text: bytes | None) -> list[bytes]:
        """A text with its dummy space, cut where no piece can lie across."""
        if not text:
            return []
        marked = b" " + text.replace(SPACE, b" ")
        data = np.frombuffer(marked, np.uint8).astype(np.int32)
        border = np.flatnonzero(self.border[data[:-1] * 256 + data[1:]]) + 1
        ends = [*border.tolist(), len(marked)]
        return [marked[a:b] for a, b in zip([0, *ends], ends)]

    # -- texts --------------------------------------------------------------------------

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text as 32-bit numbers; none for an empty or null text."""
        cut = [self.cut(text) for text in texts]
        done = 0
        result: list[bytes] = []
        while done < len(cut):
            fresh: dict[bytes, None] = {}
            upto = done
            while upto < len(cut) and len(fresh) < CACHE_UNITS // 4:
                fresh.update((u, None) for u in cut[upto] if u not in self.units)
                upto += 1
            if len(self.units) + len(fresh) > CACHE_UNITS:
                self.units.clear()
                fresh = dict.fromkeys(u for k in range(done, upto) for u in cut[k])
            self.learn(list(fresh))
            for k in range(done, upto):
                result.append(b"".join(map(self.units.__getitem__, cut[k])))
            done = upto
        return result

    def plain(self, ids: list[int]) -> bytes:
        """The bytes of ids, without the dummy space."""
        return b"".join(map(self.text.__getitem__, ids)).removeprefix(b" ")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return self.plain(ids).decode(errors="replace")


def _suffix_order(padded: np.ndarray, count: int, width: int) -> np.ndarray:
    """The suffixes of padded[:count] in order of their first ``width`` bytes or more,
    by doubling the sorted prefixes."""
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[:count]
    key = np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64)
    known = 8
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(count, np.uint64)
        rank[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1])).astype(np.uint64)
        if known >= width:
            return order
        after = np.zeros(count, np.uint64)
        after[: max(count - known, 0)] = rank[known:] + np.uint64(1)
        key = rank * np.uint64(count + 1) + after
        known *= 2


def _characters(text: bytes) -> list[bytes]:
    return [c.encode() for c in text.decode()]


def _first(text: bytes, at: int) -> bytes:
    """The character of UTF-8 ``text`` that begins at byte ``at``."""
    lead = text[at]
    return text[at : at + (1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)]


_MADE: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    """One Pieces for each worker and model."""
    key = hash(model)
    if key not in _MADE:
        _MADE[key] = Pieces(model)
    return _MADE[key]


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, read by Spark; it is some hundred KB."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(row, ids, n_pieces, round_trip): docs' columns in ``row``, the ids as array<int>,
    and whether decoding them gives the text back.

    docs: text and any other columns. A null or empty text has no ids; round_trip is
    false for a null one, which decoding cannot tell from an empty one. U+2581 in a text
    counts as a space, as the model has it. Rows are encoded one by one, so repeated rows
    get equal ids. An empty table gives an empty one.
    """
    content = model_bytes(docs.sparkSession, model)

    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _pieces(content)
        for batch in batches:
            whole = pa.StructArray.from_arrays(batch.columns, names)
            for a, count in _parts(batch.column(at)):
                part = batch.column(at).slice(a, count).cast(pa.binary()).to_pylist()
                ids = made.encode(part)
                offsets = np.cumsum([0] + [len(i) // 4 for i in ids])
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                back = [
                    t is not None and made.plain(np.frombuffer(i, np.int32).tolist()) == t.replace(SPACE, b" ")
                    for t, i in zip(part, ids)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        whole.slice(a, count),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(back, pa.bool_()),
                    ],
                    ["row", "ids", "n_pieces", "round_trip"],
                )

    kinds = docs.schema.simpleString()
    return docs.mapInArrow(run, f"row {kinds}, ids array<int>, n_pieces long, round_trip boolean")


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, count) of texts that hold PART_BYTES or are one text."""
    begin, size = 0, 0
    for k, more in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + (more or 0) > PART_BYTES:
            yield begin, k - begin
            begin, size = k, 0
        size += more or 0
    if begin < len(texts):
        yield begin, len(texts) - begin


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """rows (ids and any other columns) with text_decoded; null ids give null."""
    content = model_bytes(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _pieces(content)
        at = names.index("ids")
        for batch in batches:
            texts = [None if i is None else made.decode(i) for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "text_decoded"])

    names = rows.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, text_decoded string")
