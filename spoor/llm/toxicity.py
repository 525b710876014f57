"""Toxicity by a classifier chain.

Categories are predicted one after the other: each linear model sees the words that tell
some category apart, and the probabilities of all earlier categories. It is trained with
out-of-fold probabilities, so that it meets inputs as uncertain as those it will score;
the model that scores is fitted on the whole sample afterwards.

Training rows are a bounded sample: SAMPLE distinct labelled texts, the first by hash.
The words are picked over that sample in Spark. All documents are scored, whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.linear import Model, Rows, fit, folds, probability
from spoor.llm.tables import text_key, written

SAMPLE = 20_000
VOCABULARY = 2_000
"""Words for each category at most."""
LEAST_TEXTS = 5
CLEAR = 5.0
"""Standard deviations by which a word's share of a category must exceed the whole's."""
MOST_COUNT = 3
"""A word counts so many times in one text at most."""
FOLDS = 3
THRESHOLD = 0.5
SCORED_ROWS = 500
"""Rows scored and handed on at a time."""
STEMS = (4, 5, 6)
"""Lengths of the beginnings of longer words that count as words too."""
_WORD = re.compile(r"\w+")

CATEGORIES = {
    "low_quality": "quality = 0",
    "toxic": "toxic = 1",
    "toxic_low_quality": "toxic = 1 AND quality = 0",
}
"""The categories that the table of labels can tell, in the order of the chain, as SQL."""


class Chain(NamedTuple):
    categories: list[str]
    words: dict[str, int]
    models: list[Model]

    def probabilities(self, rows: Rows) -> np.ndarray:
        """One column for each category, each from the words and the columns before it."""
        found: list[np.ndarray] = []
        for model in self.models:
            found.append(probability(model.score(rows)))
            rows = rows.beside(found[-1])
        return np.column_stack(found) if found else np.zeros((len(rows), 0))


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case, and the stems (``stem*``) of longer ones."""
    words = _WORD.findall((text or "").lower())
    found = list(words)
    for size in STEMS:
        found += [w[:size] + "*" for w in words if len(w) > size]
    return found


def counted(texts: list[str | None], words: dict[str, int]) -> Rows:
    """How often each known word stands in each text, up to MOST_COUNT."""
    first, index, value = [0], [], []
    get = words.get
    for text in texts:
        counts = Counter(k for k in map(get, words_of(text)) if k is not None)
        index += counts.keys()
        value += [min(v, MOST_COUNT) for v in counts.values()]
        first.append(len(index))
    return Rows(
        np.array(first), np.array(index, np.int64), np.array(value, float), np.zeros((len(texts), 0))
    )


def fit_chain(categories: list[str], words: list[str], rows: Rows, truth: np.ndarray, keys: np.ndarray) -> Chain:
    """The chain for the counts of a sample; truth has a column for each category, keys
    tell copies apart."""
    known = {w: k for k, w in enumerate(words)}
    fold = folds(keys, FOLDS)
    models = []
    for c in range(len(categories)):
        models.append(fit(rows, truth[:, c], len(known)))
        ahead = np.zeros(len(rows))
        for k in range(FOLDS):
            held, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
            if len(held):
                model = fit(rows.take(rest), truth[rest, c], len(known))
                ahead[held] = probability(model.score(rows.take(held)))
        rows = rows.beside(ahead)
    return Chain(categories, known, models)


def sample_of(docs: DataFrame, labels: DataFrame, categories: dict[str, str]) -> DataFrame:
    """(key, text, one 0/1 column for each category): SAMPLE distinct labelled texts at most."""
    marks = labels.select(
        F.col("doc_id").alias("l_id"), *[F.expr(c).cast("double").alias(f"c_{k}") for k, c in enumerate(categories.values())]
    ).dropna()
    joined = docs.filter("text IS NOT NULL").select("doc_id", text_key().alias("key")).join(
        marks, F.col("doc_id") == F.col("l_id")
    )
    means = [F.round(F.avg(f"c_{k}")).alias(f"c_{k}") for k in range(len(categories))]
    order = F.xxhash64(F.lit(7), F.col("key"))
    picked = (
        joined.groupBy("key").agg(F.min("doc_id").alias("doc_id"), *means).orderBy(order, "key").limit(SAMPLE)
    )
    # SAMPLE rows of a few numbers at most
    return F.broadcast(picked).join(
        docs.select(F.col("doc_id").alias("t_id"), "text", text_key().alias("t_key")),
        (F.col("doc_id") == F.col("t_id")) & (F.col("key") == F.col("t_key")),
    ).dropDuplicates(["key"]).select("key", "text", *[f"c_{k}" for k in range(len(categories))])


def telling_words(sample: DataFrame, count: int) -> list[str]:
    """The words whose texts are of some category far more often than texts are at all."""
    marks = [f"c_{k}" for k in range(count)]
    total = sample.agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in marks]).first()
    if not total["n"]:
        return []

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([list(set(words_of(t))) for t in batch.column(0).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([found, *batch.columns[1:]], ["words", *marks])

    kinds = ", ".join(f"{m} double" for m in marks)
    own = sample.select("text", *marks).mapInArrow(words, f"words array<string>, {kinds}").select(
        F.explode("words").alias("word"), *marks
    )
    counts = own.groupBy("word").agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in marks]).filter(
        F.col("n") >= LEAST_TEXTS
    )
    found: dict[str, None] = {}
    for m in marks:
        rate = total[m] / total["n"]
        if 0 < rate < 1:
            clear = (F.col(m) - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
            best = counts.select("word", clear.alias("z")).filter(F.col("z") >= CLEAR)
            found.update((r["word"], None) for r in best.orderBy(F.desc("z"), "word").limit(VOCABULARY).collect())
    return list(found)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES) -> Chain:
    """The chain for labelled documents. Labels with nulls are left out; without labels
    every category gets probability one half or so, from the bias alone."""
    sample = written(sample_of(docs, labels, categories))
    words = telling_words(sample, len(categories))
    known = {w: k for k, w in enumerate(words)}

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts as the counts of known words: what the driver gets stays small."""
        for batch in batches:
            rows = counted(batch.column(1).to_pylist(), known)
            offsets = pa.array(rows.first, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(offsets, pa.array(rows.index)),
                    pa.ListArray.from_arrays(offsets, pa.array(rows.value)),
                    *batch.columns[2:],
                ],
                ["key", "index", "value", *batch.schema.names[2:]],
            )

    kinds = ", ".join(f"c_{k} double" for k in range(len(categories)))
    rows = (
        sample.mapInArrow(reduce, f"key long, index array<long>, value array<double>, {kinds}").orderBy("key").collect()
    )
    counts = Rows(
        np.append(0, np.cumsum([len(r["index"]) for r in rows])).astype(np.int64),
        np.array([k for r in rows for k in r["index"]], np.int64),
        np.array([v for r in rows for v in r["value"]], float),
        np.zeros((len(rows), 0)),
    )
    truth = np.array([list(r)[3:] for r in rows], float).reshape(len(rows), len(categories))
    return fit_chain(list(categories), words, counts, truth, np.array([r["key"] for r in rows], np.int64))


def scored(docs: DataFrame, chain: Chain, decision: str = "toxic") -> DataFrame:
    """(row, p_<category> ..., rejected): docs' columns in ``row``.

    docs: text and any other columns. A null or empty text has no words and gets the
    probabilities of the biases; it is not rejected. Rows are judged alone, so repeated
    ones get equal results. An empty table gives an empty one.
    """
    names = [f"p_{c}" for c in chain.categories]
    which = chain.categories.index(decision)

    columns = docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), SCORED_ROWS):
                part = batch.slice(k, SCORED_ROWS)
                rows = counted(part.column(at).to_pylist(), chain.words)
                found = chain.probabilities(rows)
                words = np.diff(rows.first) > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.StructArray.from_arrays(part.columns, columns),
                        *(pa.array(c) for c in found.T),
                        pa.array((found[:, which] > THRESHOLD) & words),
                    ],
                    ["row", *names, "rejected"],
                )

    kinds = ", ".join(f"{n} double" for n in names)
    return docs.mapInArrow(run, f"row {docs.schema.simpleString()}, {kinds}, rejected boolean")


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of docs that are not rejected, with all their columns."""
    return scored(docs, chain).filter("NOT rejected").select("row.*")
