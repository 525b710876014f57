"""Quality rules, lines first: lines that fail a rule go, then documents that lose too much.

Line rules (a line without words passes):
- punctuation: symbols are more than a tenth of the line's visible bytes, or exclamation
  marks as many as half its words, or it has under 10 words and no closing mark;
- navigation: a third of its words, and two at least, are separators standing alone;
- boilerplate: it holds one of BOILERPLATE.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MOST_REPEATED = 50
"""Percent of words in repeated 3-word windows."""
MOST_LOST = 0.5
"""A document goes when the failing lines hold a larger share of its words."""
SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset("| » › « · • / > - –".encode().split())
BOILERPLATE = (
    "all rights reserved", "accept cookies", "uses cookies", "cookie policy", "privacy policy",
    "terms of service", "terms of use", "click here", "sign up", "log in", "subscribe to our newsletter",
    "enable javascript", "share this", "read more", "back to top", "skip to content",
)
CLOSING = tuple(m.encode() for m in (".", "!", "?", '"', "'", ")", ":", ";", "…", "”", "»", "。", "！", "？"))
_BOILERPLATE = re.compile("|".join(BOILERPLATE).encode(), re.IGNORECASE)
_UNSEEN = b" \t\n\x0b\x0c\r"
_NOT_STARTS = _UNSEEN + bytes(range(0x80, 0xC0))


def failing_rule(line: bytes, words: list[bytes]) -> str | None:
    """The first rule that a line with these words fails."""
    seen = len(line.translate(None, _UNSEEN))
    lone = sum(w in SEPARATORS for w in words)
    if lone >= 2 and 3 * lone >= len(words):
        return "navigation"
    if 10 * (seen - len(line.translate(None, _UNSEEN + SYMBOLS))) > seen:
        return "punctuation"
    if 2 * line.count(b"!") >= len(words):
        return "punctuation"
    if len(words) < 10 and not words[-1].endswith(CLOSING):
        return "punctuation"
    if _BOILERPLATE.search(line):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more, first ones included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, until = 0, 0
    for k, window in enumerate(windows):
        if counts[window] > 1:
            total += k + 3 - max(k, until)
            until = k + 3
    return total


def judged(text: bytes | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned)"""
    text = text or b""
    words = text.split()
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    duplicates, lost, stay = 0, 0, []
    for line in lines:
        own = line.split()
        if not own:
            stay.append(line)
            continue
        duplicates += line in seen
        seen.add(line)
        if failing_rule(line, own):
            lost += len(own)
        else:
            stay.append(line)
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    kept = not failed and lost <= MOST_LOST * len(words)
    return (
        len(words),
        len(text.translate(None, _NOT_STARTS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicates,
        repeated,
        failed,
        kept,
        b"\n".join(stay),
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
    for batch in batches:
        rows = [judged(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        columns = list(zip(*rows)) or [()] * 8
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds)),
             pa.array(columns[7], pa.binary()).cast(pa.string())],
            ["doc_id", *COLUMNS, "cleaned"],
        )


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and cleaned: the text without failing lines.

    docs: doc_id, text, and any other columns, which are ignored. A null text counts as
    empty: no words, base_failed, cleaned ''. Each row is judged alone, so repeated rows
    and null doc_ids get a result each. An empty table gives an empty one.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _judge,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_repeat_words long, base_failed boolean, kept boolean, cleaned string",
    )
