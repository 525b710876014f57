"""Importance resampling against plain loops."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from spoor.llm import queries, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, most=1):
    words = WORD.findall((text or "").translate(UPPER))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def plain(docs, target, most=1, buckets=10_000, least=20, percent=10):
    """[(doc_id, n_features, weight, score, rank)] of (doc_id, text) rows."""
    own = collections.Counter(bucket(f, buckets) for _, t in docs for f in features(t, most)[1])
    want = collections.Counter(bucket(f, buckets) for t in target for f in features(t, most)[1])
    s_all, t_all = sum(own.values()) + buckets, sum(want.values()) + buckets
    rows = []
    for doc_id, text in docs:
        words, runs = features(text, most)
        weight = 0
        for f in runs:
            s, t = own[bucket(f, buckets)], want[bucket(f, buckets)]
            weight += math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
        name = "null" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(runs), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def test_the_query_equals_plain_loops(spark, small_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    found = queries.QUERIES["op12_resampling"](spark, small_dir)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain(docs, target), key=str)


def test_longer_runs_and_few_buckets(spark, documents):
    docs = [(r.doc_id, r.text[:2000]) for r in documents.select("doc_id", "text").limit(40).collect()]
    target = ["The and of, une des les. " * 3, None, "aller"]
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    gain = resampling.gains(texts, spark.createDataFrame([(t,) for t in target], "text string"), words=3, buckets=50)
    found = resampling.ranked(resampling.scored(texts, gain, words=3).select("doc_id", "n_words", "n_features", "weight", "score"), 5, 33)
    got = sorted((r.doc_id, r.n_features, r.weight, r.score, r.rank or 0) for r in found.collect())
    want = plain(docs, target, 3, 50, 5, 33)
    assert got == sorted((*r[:4], r[4] or 0) for r in want)


def test_odd_rows(spark, odd, none):
    target = spark.createDataFrame([("s1 s2 one two", 1)], "text string, `row` int")
    gain = resampling.gains(odd, target)
    found = resampling.ranked(resampling.scored(odd, gain), percent=50)
    rows = [(r.row.doc_id, r.row.text) for r in found.collect()]
    assert len(rows) == odd.count()
    want = plain(rows, ["s1 s2 one two"], percent=50)
    got = [(r.doc_id, r.n_features, r.weight, r.score) for r in found.collect()]
    assert sorted(got, key=str) == sorted((w[:4] for w in want), key=str)
    ranks = sorted(r["rank"] for r in found.collect() if r["rank"])
    assert ranks == sorted(w[4] for w in want if w[4]) and len(ranks) == 2
    drawn = resampling.resampled(odd, target, percent=50)
    assert drawn.columns == odd.columns and drawn.count() == 2
    assert resampling.resampled(none, target).count() == 0
    assert resampling.resampled(odd, target.filter(F.lit(False)), percent=100).count() == 5


def test_rows_that_tie_get_one_rank_each(spark):
    same = " ".join(f"w{k}" for k in range(25))
    docs = spark.range(1000).select(F.lit(7).alias("doc_id"), F.lit(same).alias("text")).repartition(5)
    found = resampling.ranked(resampling.scored(docs, resampling.gains(docs, docs)), percent=30)
    assert sorted(r["rank"] for r in found.filter("rank IS NOT NULL").collect()) == list(range(1, 301))


@pytest.mark.parametrize("block", [1, 7, 1 << 17])
def test_features_by_blocks(block):
    texts = ["One two, three four", "", "...", "five", "Ünd six-seven 8"]
    made = resampling.Features([t.encode() for t in texts], 3)
    found = [[] for _ in texts]
    for text, start, length in made.blocks(block):
        for t, a, n in zip(text.tolist(), start.tolist(), length.tolist()):
            found[t].append(made.plain[a : a + n].decode())
    assert found == [features(t, 3)[1] for t in texts]
    assert made.counts().tolist() == [len(f) for f in found]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab1é", min_size=1, max_size=70), min_size=1, max_size=40))
def test_interning_tells_strings_apart(words):
    """Keys are the library's hashes; equal strings share a slot, others never."""
    made = resampling.Features([" ".join(words).encode()])
    for _, start, length in made.blocks():
        table = resampling.Interned(made.plain, start, length, 10_000)
        strings = [made.plain[a : a + n] for a, n in zip(start.tolist(), length.tolist())]
        assert strings == [w.encode() for w in words]
        slots = dict(zip(strings, table.slot.tolist()))
        assert [slots[s] for s in strings] == table.slot.tolist() and len(set(slots.values())) == len(slots)
        for s, n in collections.Counter(strings).items():
            assert table.count[slots[s]] == n and table.bucket[slots[s]] == zlib.crc32(s) % 10_000


def test_hashes_equal_the_library():
    strings = [bytes(range(1, n + 1)) for n in range(32)]
    lanes = np.array([list(np.frombuffer(s.ljust(32, b"\0"), "<u8")) for s in strings], np.uint64).T
    found = resampling.hashes(lanes, np.array([len(s) for s in strings]))
    assert found.tolist() == [xxhash.xxh64_intdigest(s) for s in strings]


def test_colliding_keys_are_kept_apart(monkeypatch):
    monkeypatch.setattr(resampling, "hashes", lambda lanes, length: np.zeros(len(length), np.uint64))
    made = resampling.Features([b"a b a c b a"])
    for _, start, length in made.blocks():
        table = resampling.Interned(made.plain, start, length, 10_000)
        assert len(table.used) == 3 and sorted(table.count[table.used]) == [1, 2, 3]
