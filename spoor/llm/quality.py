"""Quality by co-training: a text view and a page view teach each other.

The text view sees what the words look like; the page view sees the record around the
text: language, source, size and layout. Each starts from half of the labelled sample
(a third half is held out), then in every round marks the unlabelled documents it is
surest of, and the other view trains on them. Both are calibrated on the held-out rows,
and the mean of their calibrated log-odds, weighted by a last small model, scores every
document.

Training uses bounded samples: LABELLED labelled and UNLABELLED other documents, the
first by hash. All documents are scored, on whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.linear import Model, Rows, fit, folds, probability
from spoor.llm.tables import text_key, written

LABELLED = 10_000
UNLABELLED = 20_000
ROUNDS = 4
SHARE = 0.1
"""Part of the unlabelled sample that a view may mark in a round."""
SURE = 0.9
"""Probability from which a view is sure."""
THRESHOLD = 0.5
NAMED = 64
"""Names of languages and sources that get a column, the most frequent of the sample."""
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>~^=_{}\\]")
_ENDS = (".", "!", "?", '"', ")", "…")
TEXT_COLUMNS = 10


def text_view(text: str | None) -> list[float]:
    """What the words of a text look like, each figure between 0 and 1 or so."""
    text = text or ""
    words = _WORD.findall(text)
    if not words:
        return [0.0] * TEXT_COLUMNS
    n, letters = len(words), sum(map(str.isalpha, text)) or 1
    windows = len(set(zip(words, words[1:], words[2:])))
    return [
        min(1.0, len(_SYMBOLS.findall(text)) / n),
        min(1.0, text.count("!") / n),
        sum(map(str.isupper, text)) / letters,
        min(1.0, text.count("|") / n),
        sum(map(str.isdigit, text)) / len(text),
        min(2.0, sum(map(len, words)) / n / 10),
        len(set(words)) / n,
        1 - windows / (n - 2) if n > 2 else 0.0,
        sum(w.endswith(_ENDS) for w in words) / n,
        float(words[-1].endswith(_ENDS)),
    ]


def page_view(text: str | None, lang: str | None, source: str | None, chars: int | None, names: list[tuple]) -> list[float]:
    """The record around a text: its size and lines, and whose it is."""
    lines = (text or "").split("\n")
    sizes = [len(x) for x in lines]
    size = chars if chars is not None else len(text or "")
    return [
        np.log1p(max(size, 0)) / 10,
        np.log1p(len(lines)) / 5,
        np.log1p(max(sizes)) / 10,
        np.log1p(sum(sizes) / len(sizes)) / 10,
        len(set(lines)) / len(lines),
        len((text or "").encode()) / max(len(text or ""), 1) - 1,
        *(float((kind == "lang" and name == lang) or (kind == "source" and name == source)) for kind, name in names),
    ]


class CoTrained(NamedTuple):
    names: list[tuple]
    views: list[Model]
    calibrations: list[tuple]
    """(slope, bias) for the log-odds of each view."""
    mixed: Model

    def calibrated(self, columns: list[np.ndarray]) -> np.ndarray:
        return np.column_stack(
            [a * m.score(_dense(x)) + b for m, x, (a, b) in zip(self.views, columns, self.calibrations)]
        )

    def score(self, columns: list[np.ndarray]) -> np.ndarray:
        """The probability that a document is good; columns: the text and the page view."""
        return probability(self.mixed.score(_dense(self.calibrated(columns))))


def _dense(columns: np.ndarray) -> Rows:
    none = np.zeros(0, np.int64)
    return Rows(np.zeros(len(columns) + 1, np.int64), none, none.astype(float), columns)


def _fitted(columns: np.ndarray, truth: np.ndarray) -> Model:
    return fit(_dense(columns), truth, 0, penalty=0.01, steps=800)


def co_train(labelled: list[np.ndarray], truth: np.ndarray, other: list[np.ndarray], keys: np.ndarray, names: list[tuple]) -> CoTrained:
    """labelled, other: the text and the page view of each row; keys tell copies apart."""
    fold = folds(keys, 3)
    held = np.flatnonzero(fold == 2)
    seen = [[x[np.flatnonzero(fold != 2)]] for x in labelled]
    marks = [[truth[np.flatnonzero(fold != 2)]] for _ in labelled]
    free = np.arange(len(other[0]))
    most = max(1, int(SHARE * len(other[0])))
    views = [_fitted(np.concatenate(s), np.concatenate(m)) for s, m in zip(seen, marks)]
    for _ in range(ROUNDS):
        taken: set[int] = set()
        for view in (0, 1):
            sure = probability(views[view].score(_dense(other[view][free])))
            for good in (True, False):
                strength = sure if good else 1 - sure
                best = np.argsort(-strength, kind="stable")
                # as many of each class as the view takes to be there
                part = max(1, int(most * (sure.mean() if good else 1 - sure.mean()))) if len(free) else 0
                best = best[strength[best] >= SURE][:part]
                pick = np.array([free[k] for k in best if int(free[k]) not in taken], np.int64)
                taken.update(pick.tolist())
                seen[1 - view].append(other[1 - view][pick])
                marks[1 - view].append(np.full(len(pick), float(good)))
        free = np.array([k for k in free if int(k) not in taken], np.int64)
        views = [_fitted(np.concatenate(s), np.concatenate(m)) for s, m in zip(seen, marks)]
    calibrations = []
    for view, columns in zip(views, labelled):
        line = _fitted(view.score(_dense(columns[held]))[:, None], truth[held])
        calibrations.append((float(line.dense[0]), line.bias))
    made = CoTrained(names, views, calibrations, Model(np.zeros(0), np.array([0.5, 0.5]), 0.0))
    both = made.calibrated([x[held] for x in labelled])
    mixed = _fitted(both, truth[held])
    against = np.flatnonzero(mixed.dense < 0)
    if len(against):  # a view never counts against what it says itself
        both[:, against] = 0
        mixed = _fitted(both, truth[held])
        mixed.dense[against] = 0
    return made._replace(mixed=mixed)


_INPUT = ("text", "lang", "source", "n_chars")


def _viewed(rows: list, names: list[tuple]) -> list[np.ndarray]:
    text = np.array([text_view(r[0]) for r in rows], float).reshape(len(rows), TEXT_COLUMNS)
    page = np.array([page_view(*r[:4], names) for r in rows], float).reshape(len(rows), 6 + len(names))
    return [text, page]


def train(docs: DataFrame, labels: DataFrame) -> CoTrained:
    """Co-trained views of docs (doc_id, text, lang, source, n_chars) and labels (doc_id,
    quality 0 or 1; others are left out). Without labels all documents get one score."""
    marks = labels.filter("quality IN (0, 1)").groupBy("doc_id").agg(F.round(F.avg("quality")).alias("mark")).toDF("l_id", "mark")
    all_docs = docs.select("doc_id", *_INPUT, text_key().alias("key"))
    order = F.xxhash64(F.lit(5), F.col("key"))
    ids = all_docs.select("doc_id", "key").join(marks, F.col("doc_id") == F.col("l_id"), "left")
    picked = written(
        ids.filter("mark IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("p_id"), F.round(F.avg("mark")).alias("mark"))
        .orderBy(order, "key").limit(LABELLED)
        .unionByName(
            ids.groupBy("key").agg(F.min("doc_id").alias("p_id"), F.max("mark").alias("mark"))
            .filter("mark IS NULL AND p_id IS NOT NULL").orderBy(order, "key").limit(UNLABELLED)
        ).withColumnRenamed("key", "p_key")
    )
    sample = written(
        all_docs.join(F.broadcast(picked), (F.col("doc_id") == F.col("p_id")) & (F.col("key") == F.col("p_key")))
        .dropDuplicates(["key"]).select(*_INPUT, "key", "mark")
    )
    names = []
    for kind in ("lang", "source"):
        top = sample.filter(F.col(kind).isNotNull()).groupBy(kind).count().orderBy(F.desc("count"), kind).limit(NAMED)
        names += [(kind, r[0]) for r in top.collect()]

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, page = _viewed(list(zip(*(c.to_pylist() for c in batch.columns[:4]))), names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(4), batch.column(5), pa.array(list(text), pa.list_(pa.float64())), pa.array(list(page), pa.list_(pa.float64()))],
                ["key", "mark", "text_view", "page_view"],
            )

    rows = sample.mapInArrow(views, "key long, mark double, text_view array<double>, page_view array<double>").orderBy("key").collect()

    def columns(some: list) -> list[np.ndarray]:
        return [np.array([r[k] for r in some], float).reshape(len(some), w) for k, w in ((2, TEXT_COLUMNS), (3, 6 + len(names)))]

    known, other = [r for r in rows if r["mark"] is not None], [r for r in rows if r["mark"] is None]
    truth = np.array([r["mark"] for r in known], float)
    return co_train(columns(known), truth, columns(other), np.array([r["key"] for r in known], np.int64), names)


def scored(docs: DataFrame, model: CoTrained) -> DataFrame:
    """(doc_id, p_text, p_page, score, kept) of each row of docs.

    docs: doc_id, text, lang, source, n_chars; other columns are ignored. A null text
    counts as empty; null lang, source and n_chars are a record without them. Repeated
    rows get equal results, an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _viewed(list(zip(*(c.to_pylist() for c in batch.columns[1:]))), model.names)
            parts = probability(model.calibrated(columns))
            total = model.score(columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(parts[:, 0]), pa.array(parts[:, 1]), pa.array(total), pa.array(total >= THRESHOLD)],
                ["doc_id", "p_text", "p_page", "score", "kept"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_INPUT).mapInArrow(
        run, "doc_id long, p_text double, p_page double, score double, kept boolean"
    )
