"""Document fingerprints: Merkle trees over sections and paragraphs.

A section begins at the text's start, after a blank line and at a line starting with
'#'; its paragraphs are its lines. Leaves are pieces of paragraphs: sentences, long ones
cut where their own words say so, so that an edit changes the pieces it touches only.
A node's digest is that of its children's digests; equal roots mean equal texts. The
tree keeps its digests, so two trees are compared from the top, and only branches that
differ are followed down.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 200
"""Characters beyond which a sentence is cut further."""
RANGE_BYTES = 4 << 20
MOST_RANGES = 20_000
"""Ranges of doc_id at most; they are streamed, so a range may be of any size."""
_SENTENCE = re.compile(r"[^.!?]*[.!?]+\s*|[^.!?]+")
_LINE = re.compile(r"[^\n]*\n|[^\n]+")


class Tree(NamedTuple):
    root: str
    sections: list
    """(digest, characters, paragraphs); a paragraph is (digest, characters, leaves), a
    leaf (digest, characters)."""


def _leaves(paragraph: str) -> list[tuple]:
    found = []
    for sentence in _SENTENCE.findall(paragraph):
        for part in _cut(sentence) if len(sentence) > LONG else (sentence,):
            found.append((xxhash.xxh3_128_digest(part), len(part)))
    return found


def _cut(sentence: str) -> list[str]:
    """Pieces ending after words whose length is a multiple of four."""
    parts, at = [], 0
    for word in re.finditer(r"\S+\s*", sentence):
        if len(word[0].rstrip()) % 4 == 0:
            parts.append(sentence[at : word.end()])
            at = word.end()
    return [*parts, sentence[at:]] if at < len(sentence) else parts


def _above(children: list[tuple]) -> tuple:
    digest = xxhash.xxh3_128_digest(b"".join(c[0] for c in children) + len(children).to_bytes(8, "big"))
    return digest, sum(c[1] for c in children), children


def tree(text: str | None) -> Tree:
    """The tree of a text; null counts as empty."""
    sections: list[list[tuple]] = [[]]
    blank = False
    for line in _LINE.findall(text or ""):
        if sections[-1] and (line.startswith("#") or blank):
            sections.append([])
        blank = not line.strip()
        sections[-1].append(_above(_leaves(line)))
    nodes = [_above(s) for s in sections]
    root = hashlib.blake2b(b"".join(n[0] for n in nodes) + len(nodes).to_bytes(8, "big"), digest_size=16)
    return Tree(root.hexdigest(), nodes)


def _unmatched(a: list[tuple], b: list[tuple]) -> tuple[list, list, int]:
    """The nodes of a and b that have no equal on the other side, and the characters of those that do."""
    counts = Counter(n[0] for n in b)
    only_a, shared = [], 0
    for node in a:
        if counts[node[0]] > 0:
            counts[node[0]] -= 1
            shared += node[1]
        else:
            only_a.append(node)
    only_b = []
    for node in reversed(b):
        if counts[node[0]] > 0:
            counts[node[0]] -= 1
            only_b.append(node)
    return only_a, only_b[::-1], shared


def likeness(a: Tree, b: Tree) -> float:
    """The share of characters below equal branches, 1 for equal trees."""
    if a.root == b.root:
        return 1.0
    total = sum(n[1] for n in a.sections) + sum(n[1] for n in b.sections)
    left, right, shared = _unmatched(a.sections, b.sections)
    for _ in ("paragraphs", "leaves"):
        left = [child for node in left for child in node[2]]
        right = [child for node in right for child in node[2]]
        left, right, more = _unmatched(left, right)
        shared += more
    return 2 * shared / total if total else 0.0


def differing(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """(begin, end) of the characters of a's text in leaves that b lacks."""
    lacking = {id(n) for n in _lacking(a, b)}
    spans, at = [], 0
    for section in a.sections:
        for paragraph in section[2]:
            for leaf in paragraph[2]:
                if id(leaf) in lacking:
                    if spans and spans[-1][1] == at:
                        spans[-1] = (spans[-1][0], at + leaf[1])
                    else:
                        spans.append((at, at + leaf[1]))
                at += leaf[1]
    return spans


def _lacking(a: Tree, b: Tree) -> list[tuple]:
    left, right, _ = _unmatched(a.sections, b.sections)
    for _ in ("paragraphs", "leaves"):
        left = [child for node in left for child in node[2]]
        right = [child for node in right for child in node[2]]
        left, right, _ = _unmatched(left, right)
    return left


def edited(text: str, following: str) -> str:
    """The last half of the characters, rounded down, replaced by the first of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (range, own before the look-ahead row); each own row is compared with
    the row after it."""
    before = None
    for batch in batches:
        rows = []
        for place, own, doc, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
            text = text or ""
            now = (place, own, doc, text, tree(text))
            if before and before[1] and before[0] == place:
                rows.append(_compared(before, now))
            before = now
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _compared(now: tuple, following: tuple) -> tuple:
    text = edited(now[3], following[3])
    other = tree(text)
    return (
        now[2],
        len(now[3]),
        hashlib.sha256(text.encode()).hexdigest(),
        now[4].root,
        other.root,
        likeness(now[4], other),
        likeness(now[4], following[4]),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each text and of its edited text, and how alike they are.

    docs: doc_id, text, and any other columns, which are ignored. The next document is
    the one with the next smaller doc_id; null doc_ids come last, rows with one doc_id
    in order of text (null first), and after the last comes the first again. A null text
    counts as empty. One row alone is its own next. An empty table gives an empty one.

    Rows are dealt to ranges of doc_id, each of which gets a copy of the first row of
    the next range; tasks stream their sorted rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size, highest = source.agg(F.sum(F.octet_length("text")), F.max("doc_id")).first()
    count = min(MOST_RANGES, int((size or 0) / RANGE_BYTES) + 1)
    # Ranges begin at doc_ids that exist: the highest, and the quantiles below it.
    cuts = [k / count for k in range(1, count)]
    marks = source.agg(F.percentile_approx("doc_id", cuts, 10_000)).first()[0] if cuts else []
    heads = sorted({highest, *(marks or [])} - {None})
    low = np.array(heads, np.int64)

    @F.pandas_udf("long")
    def range_of(ids: pd.Series) -> pd.Series:
        """0 for doc_ids up to the least head, 1 up to the next, ...; -1 for null."""
        known = ids.fillna(0).to_numpy(np.int64)
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(low, known)))

    placed = source.withColumn("place", range_of("doc_id"))
    last = len(heads)
    is_head = F.col("doc_id").isNotNull() if not heads else F.col("doc_id").isin([int(h) for h in heads])
    ahead = F.when(F.col("place") == max(last - 1, 0), 0).otherwise(F.col("place") + 1)
    if not heads:  # no doc_id at all: one range, whose first row comes after its last
        looked = placed.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
    else:
        looked = placed.withColumn(
            "own", F.explode(F.when(is_head, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))
        ).withColumn("place", F.when(F.col("own"), F.col("place")).otherwise(ahead))
    return (
        looked.select("place", "own", "doc_id", "text")
        .repartition(max(count, 1), "place")
        .sortWithinPartitions("place", F.desc("own"), F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
        .mapInArrow(_walk, _RESULT)
    )
