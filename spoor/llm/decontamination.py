"""Benchmark passages in documents, by a prefix-filtered set join.

A record is what is looked for: ``window`` consecutive words of an item, or all words of
a shorter one. Its set are its runs of ``shingle`` words, each with its place. A passage
of a document, as long as the record, holds the record when it has at least ``percent``
of these shingles at their places (100: the same words).

Shingles are ordered by rarity: by their number in all documents, rare ones first. A
passage that holds o of a record's m shingles holds one of its first m - o + 1, so that
only those (one, at 100 percent) are joined with the documents' shingles. The places of
the two say where the passage would begin; it must lie within the document. What is
left is compared shingle by shingle with the document's words.

The documents' shingles are met twice, to count and to join, and neither kept nor
shuffled while the benchmark's are few (BROADCAST_KEYS); texts are shuffled once, to meet
their candidates. Beyond, both are shuffled, on the shingle. Only built-in functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.tables import text_key, written

WINDOW = 10
SHINGLE = 3
PERCENT = 100
BROADCAST_KEYS = 1_000_000
"""Up to so many shingle hashes, 8 bytes each, go to every task; else the join shuffles."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A text with A-Z lower-cased, and no other letter (null: empty)."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def words(text: Column) -> Column:
    """Words of a text, cased as it is (null: none): of a lowered() one these are the words
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def _shingles(rows: DataFrame, size: int, keep: list[str]) -> DataFrame:
    """(keep, at, token): the hash of each run of ``size`` of a row's words.

    lower() of single words is cheaper than lowered() texts: it maps more letters, alike on
    both sides of the join, and what is met by that alone does not pass the comparison.
    """
    runs = F.arrays_zip(*[F.slice("words", k + 1, F.size("words")) for k in range(size)])
    # The outer form: Spark would add a filter that works out the words once more.
    return (
        rows.select(*keep, F.posexplode_outer(runs).alias("at", "run"))
        .filter(F.col("run")[str(size - 1)].isNotNull())
        .select(*keep, "at", F.xxhash64(*[F.lower(F.col("run")[str(k)]) for k in range(size)]).alias("token"))
    )


def _few(keys: DataFrame) -> DataFrame:
    """Keys to join with, as a broadcast where their number is within the bound."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def records(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(record, item): each window of an item as words joined by a space, once for an item."""
    cut = items.select(F.col("item_id").cast("string").alias("item"), words(lowered(F.col("text"))).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, F.lit(window)), " "))
    return cut.select("item", F.explode_outer(runs).alias("record")).filter("record <> ''").distinct()


def _prefixes(shingles: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """(token, at, record): of each record the shingles that a passage can't do without."""
    ranked = (
        shingles.join(counts, "token", "left")
        .groupBy("record")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at"))).alias("all"))
    )
    needed = F.ceil(F.size("all") * percent / 100)
    first = F.slice("all", F.lit(1), (F.size("all") - needed + 1).cast("int"))
    return ranked.select("record", F.explode(first).alias("x")).select("x.token", "x.at", "record")


def _held(shingle: int, percent: int) -> str:
    """SQL: whether the passage of ``words`` at x.start holds x.record."""
    return (
        "exists(array(split(x.record, ' ')), r -> exists(array("
        f"least(size(r), {shingle})), k -> 100 * size(filter(sequence(0, size(r) - k),"
        " j -> slice(words, x.start + j + 1, k) = slice(r, j + 1, k)))"
        f" >= {percent} * (size(r) - k + 1)))"
    )


def found(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, text_key, n_words, passages, n_hit, items) for each row of docs.

    passages: array of (start, record), where what is found begins, in words from 0;
    n_hit: words within a passage; items: the ids of the items found, as sorted strings.
    docs: doc_id, text; items: item_id, text; other columns are ignored. A null or empty
    text and one without words holds nothing and is not looked for. Rows of docs may
    repeat: each gives a row. Rows of items may share an id (one item with the records of
    all) or records (all these items are found). An item with a null id counts in
    passages and n_hit, but not in items. An empty table of items finds nothing, one of
    docs gives an empty one.
    """
    if not 1 <= shingle <= window or not 0 < percent <= 100:
        raise ValueError(f"no such windows: {window} words, shingles of {shingle}, {percent} percent")
    owners = written(records(items, window))
    wanted = owners.select("record").distinct().withColumn("words", F.split("record", " "))
    # A record shorter than a shingle is one itself.
    sizes = [(k, F.size("words") == k) for k in range(1, shingle)] + [(shingle, F.size("words") >= shingle)]
    parts = []
    for size, fits in sizes:
        # few: the shingles of items alone
        own = written(_shingles(wanted.filter(fits), size, ["record"]))
        if not own.isEmpty():
            parts.append((size, own))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    cut = source.select("doc_id", "text_key", words(F.col("text")).alias("words"))
    met = []
    for size, own in parts:
        tokens = _few(own.select("token").distinct())
        counts = _shingles(cut, size, []).join(tokens, "token").groupBy("token").agg(F.count("*").alias("n"))
        prefixes = written(_prefixes(own, counts, percent))
        hits = _shingles(
            cut.withColumn("n_words", F.size("words")), size, ["doc_id", "text_key", "n_words"]
        ).join(_few(prefixes.select("token").distinct()), "token")
        met.append(
            hits.withColumnRenamed("at", "place")
            .join(prefixes, "token")
            .withColumn("start", F.col("place") - F.col("at"))
            .filter("start >= 0 AND start + size(split(record, ' ')) <= n_words")
            .select("doc_id", "text_key", "start", "record")
        )
    spot = "array<struct<start:int,record:string>>"
    if met:
        candidates = (
            reduce(DataFrame.unionByName, met)
            .groupBy("doc_id", "text_key")
            .agg(F.collect_set(F.struct("start", "record")).alias("candidates"))
        )
        joined = source.join(
            candidates.withColumnsRenamed({"doc_id": "c_id", "text_key": "c_key"}),
            F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")),
            "left",
        )
    else:
        joined = source.withColumn("candidates", F.lit(None).cast(spot))
    verified = written(
        joined.select(
            "doc_id",
            "text_key",
            words(F.when(F.col("candidates").isNull(), F.col("text")).otherwise(lowered(F.col("text")))).alias("words"),
            "candidates",
        ).select(
            "doc_id",
            "text_key",
            F.size("words").cast("long").alias("n_words"),
            F.expr(
                f"array_sort(filter(coalesce(candidates, cast(array() AS {spot})), x -> {_held(shingle, percent)}))"
            ).alias("passages"),
        )
    )
    hit = F.expr(
        "size(array_distinct(flatten(transform(passages,"
        " x -> sequence(x.start, x.start + size(split(x.record, ' ')) - 1)))))"
    )
    named = (
        verified.filter("size(passages) > 0")
        .select("doc_id", "text_key", F.explode(F.expr("array_distinct(passages.record)")).alias("record"))
        .distinct()
        .join(owners.filter("item IS NOT NULL"), "record")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumnsRenamed({"doc_id": "c_id", "text_key": "c_key"})
    )
    return verified.join(
        named, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")), "left"
    ).select(
        "doc_id", "text_key", "n_words", "passages", hit.cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of docs without a passage of an item, all columns as they are.

    how: as in found(). Rows that are equal in doc_id and text stay or go together.
    """
    bad = found(docs, items, **how).filter("size(passages) > 0").select(
        F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")
    ).distinct()
    keyed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("k_id"),
        text_key().alias("k_text"),
    )
    return keyed.join(
        bad, F.col("k_id").eqNullSafe(F.col("c_id")) & (F.col("k_text") == F.col("c_key")), "left_anti"
    ).select("row.*")
