"""The set join against a plain search."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from spoor.llm import decontamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, items, window=10, shingle=3, percent=100):
    """For each document (n_words, {(start, record)}, n_hit, items)."""
    owners = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1) if w else ():
            owners.setdefault(tuple(w[i : i + window]), set()).add(item)
    result = []
    for text in docs:
        w, found = words(text), set()
        if percent == 100:
            sizes = {len(record) for record in owners}
            spots = {(s, tuple(w[s : s + n])) for n in sizes for s in range(len(w) - n + 1)}
            found = {(s, " ".join(record)) for s, record in spots if record in owners}
        for record in owners if percent < 100 else ():
            k = min(shingle, len(record))
            for s in range(len(w) - len(record) + 1):
                same = [a == b for a, b in zip(w[s : s + len(record)], record)]
                total = len(record) - k + 1
                if 100 * sum(all(same[j : j + k]) for j in range(total)) >= percent * total:
                    found.add((s, " ".join(record)))
        hit = {p for s, r in found for p in range(s, s + len(r.split()))}
        named = {str(i) for _, r in found for i in owners[tuple(r.split())] if i is not None}
        result.append((len(w), found, len(hit), sorted(named)))
    return result


def rows(found):
    return [
        (r.n_words, {(p.start, p.record) for p in r.passages}, r.n_hit, list(r["items"])) for r in found.collect()
    ]


ITEMS = [
    (1, "One, TWO three four five six seven eight nine ten eleven twelve!"),
    (1, "a second text of this id"),
    (2, "two three four five six seven eight nine ten eleven"),
    (3, "Ümläut É1 x2"),
    (4, "short"),
    (4, "short"),
    (5, ""),
    (6, None),
    (None, "no id has this"),
    (10, "the the the the the the the the the the the the"),
    (9, "ΑΣ'x ΑΣ"),
]
TEXTS = [
    "zero one two three four five six seven eight nine ten eleven twelve thirteen",
    "ONE two-three four five six seven eight nine ten ... eleven twelve",
    "one two three four five six seven eight nine eleven ten twelve",
    "ümläut é1 x2, Ümläut É1 X2 short",
    "ÜMLÄUT É1 x2",
    "the " * 40,
    "no id has this and a second text of this id",
    "short",
    "",
    " .,\n",
    None,
    "ασ x ΑΣ ΑΣ x ΑΣ",
    "short " * 3000 + "one two three four five six seven eight nine ten",
    "one two three four five six seven BLANK nine ten eleven twelve",
]


@pytest.mark.parametrize("percent", [100, 60])
@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_found_equals_plain_search(spark, monkeypatch, percent, broadcast):
    monkeypatch.setattr(decontamination, "BROADCAST_KEYS", broadcast)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = rows(decontamination.found(docs, items, percent=percent).orderBy("doc_id"))
    assert found == plain(TEXTS, ITEMS, percent=percent)


def test_longer_shingles_and_windows(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for window, shingle in ((4, 1), (6, 6), (1, 1)):
        found = rows(decontamination.found(docs, items, window, shingle).orderBy("doc_id"))
        assert found == plain(TEXTS, ITEMS, window, shingle)


def test_the_query_equals_plain_search(spark, small_dir):
    tables = [spark.read.parquet(f"{small_dir}/{t}.parquet").collect() for t in ("documents", "benchmark")]
    docs, items = tables
    want = plain([r.text for r in docs], [(r.item_id, r.text) for r in items])
    found = {r.doc_id: r for r in queries.QUERIES["op11_decontamination"](spark, small_dir).collect()}
    assert len(found) == len(docs) and any(w[2] for w in want)
    for r, (n, _, hit, named) in zip(docs, want):
        got = found[r.doc_id]
        assert (got.n_words, got.n_hit, got.n_items, got.contaminated) == (n, hit, len(named), hit > 0)
        assert got.items_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "s0 s1 s2 s3", "x"), (2, "one TWO", "y")], "item_id long, text string, `row` string")
    found = decontamination.found(odd, items)
    assert found.count() == odd.count()
    hit = {(r.doc_id, r.n_hit) for r in found.filter("n_hit > 0").collect()}
    assert hit == {(1, 8), (None, 8), (6, 2)}
    clean = decontamination.decontaminated(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 4
    empty = items.filter(F.lit(False))
    assert decontamination.found(odd, empty).filter("n_hit > 0").count() == 0
    assert decontamination.decontaminated(odd, empty).count() == odd.count()
    assert decontamination.found(none, items).count() == 0 and decontamination.decontaminated(none, items).count() == 0
