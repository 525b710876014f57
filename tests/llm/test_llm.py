"""The training-data operators against plain loops, and on odd rows."""

import collections
import hashlib
import json

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from spoor.llm import chat, licenses, merkle, mixing, near, pieces, quality, rules, substrings, toxicity


def words(text):
    return (text or "").encode().split()


# -- toxicity -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def chain(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.train(docs, labels)


def test_toxic_words_are_found_and_clean_documents_stay(spark, sf_dir, chain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = {"scum", "idiot", "loser", "moron", "clown", "pathetic", "trash", "worthless", "stupid", "disgusting"}
    found = toxicity.scored(docs, chain).select("row.text", "rejected").collect()
    many = [r.rejected for r in found if sum(w in known for w in toxicity.words_of(r.text)) >= 3]
    no_word = [r.rejected for r in found if not any(w in known for w in toxicity.words_of(r.text))]
    assert many and np.mean(many) > 0.95
    assert np.mean(no_word) < 0.01


def test_chain_feeds_earlier_probabilities(chain):
    rows = toxicity.counted(["idiot clown moron", "the and of"], chain.words)
    found = chain.probabilities(rows)
    for k in range(found.shape[1]):
        model = chain.models[k]
        for i, text in enumerate(("idiot clown moron", "the and of")):
            counts = collections.Counter(w for w in toxicity.words_of(text) if w in chain.words)
            score = model.bias + sum(model.sparse[chain.words[w]] * min(n, 3) for w, n in counts.items())
            score += sum(model.dense[j] * found[i, j] for j in range(k))
            assert found[i, k] == pytest.approx(1 / (1 + np.exp(-score)))


def test_toxicity_of_odd_rows(odd, none, chain):
    assert toxicity.without_toxic(odd, chain).count() == odd.count()
    assert toxicity.without_toxic(none, chain).columns == odd.columns
    assert toxicity.scored(none, chain).count() == 0


# -- mixing -------------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = {s: weight[s] * rest / sum(weight[x] for x in order if x not in full) for s in order if s not in full}
        over = {s for s, t in share.items() if t > 3 * sizes[s]}
        if not over:
            return {**{s: 3.0 * sizes[s] for s in full}, **share}
        full |= over


def test_mix_meets_its_targets(documents):
    rows = mixing.mixed(documents).select("row.*", "size", "source_size", "target", "taken", "draws").collect()
    sizes = collections.Counter()
    taken = collections.Counter()
    for r in rows:
        assert r.size == len(words(r.text)) and r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = plain_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_tree_deals_every_block_once_by_the_law(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 13), (2, 0), (3, 7)], "number int, blocks long")
    dealt = mixing.shard_quotas(quotas, 4).collect()
    per_source, per_shard = collections.Counter(), collections.Counter()
    for r in dealt:
        per_source[r.number] += r.blocks
        per_shard[r.shard] += r.blocks
    assert per_source == {0: 40, 1: 13, 2: 0, 3: 7} and set(per_shard.values()) == {15}
    nodes = spark.range(4000).select(F.col("id").alias("node"), F.expr("array(12L, 8L)").alias("counts"))
    left = [r.counts[0] for r in mixing.split(nodes).filter("node % 2 = 0").collect()]
    assert np.mean(left) == pytest.approx(6, abs=0.1)
    assert np.var(left) == pytest.approx(10 * 0.6 * 0.4 * 10 / 19, rel=0.1)


def test_mix_of_odd_rows(odd, none):
    found = mixing.mixture(odd)
    assert found.columns == odd.columns
    assert sum(len(words(r.text)) for r in found.collect()) == pytest.approx(
        sum(len(words(r.text)) for r in odd.collect()), abs=5
    )
    assert mixing.mixture(none).count() == 0 and mixing.mixed(none).count() == 0


# -- licenses -----------------------------------------------------------------------


def test_licenses_equal_plain_search(spark, documents, odd, none):
    known = {k: [w.decode() for w in words(v.lower())] for k, v in licenses.TEMPLATES.items()}

    def shingles(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = {}
    for r in documents.select("doc_id", "text").collect():
        w = [x.decode() for x in words((r.text or "").lower())]
        if not any("licen" in x or "software" in x for x in w):
            continue
        for name, t in known.items():
            best = max(((len(shingles(w[i : i + len(t)]) & shingles(t)), -i) for i in range(len(w))), default=(0, 0))
            if best[0] * 100 >= 80 * len(shingles(t)):
                want[r.doc_id, name] = (best[0] / len(shingles(t)), -best[1])
    found = licenses.licenses(documents).collect()
    assert {(r.doc_id, r.license): (r.containment, r.first_word) for r in found} == want
    assert licenses.licenses(odd).count() == 0 and licenses.licenses(none).count() == 0


def test_an_edited_license_is_found(spark):
    edited = licenses.TEMPLATES["GPL"].replace("program", "work").upper()
    (row,) = licenses.licenses(spark.createDataFrame([(1, "So then. " + edited)], "doc_id long, text string")).collect()
    assert row.license == "GPL" and 0.8 <= row.containment < 1


# Written apart from licenses.TEMPLATES: a notice, and the beginning of the names of its licenses.
NOTICES = [
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ("This work is licensed under CC BY-ND 4.0. To view a copy of this license, visit", "CC-BY-ND-4.0"),
    (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "CC-BY-NC-SA-4.0",
    ),
    (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or"
        " (at your option) any later version.",
        "LGPL-2.1",
    ),
    (
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published"
        " by the Free Software Foundation, either version 3 of the License",
        "AGPL",
    ),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "ISC",
    ),
    (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "MPL-2.0",
    ),
]


def test_common_notices_are_found(spark):
    rows = [(k, f"some words before it {text} and words after it") for k, (text, _) in enumerate(NOTICES)]
    found = collections.defaultdict(set)
    for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r.doc_id].add(r.license)
    for k, (_, name) in enumerate(NOTICES):
        assert any(x == name or x.startswith(f"{name} ") for x in found[k]), (name, found[k])


def test_every_notice_of_the_documents_is_found(spark, documents):
    held = documents.filter("text LIKE '%Licensed under CC BY-NC 4.0.%'").select("doc_id").distinct()
    found = licenses.licenses(documents).filter("license = 'CC-BY-NC-4.0 notice'").select("doc_id")
    assert held.count() > 0 and held.exceptAll(found).count() == 0


def test_words_put_into_a_license_do_not_hide_it(spark):
    rows, want = [], {}
    for name in ("MIT", "GPL", "Apache-2.0", "BSD"):
        w = licenses.TEMPLATES[name].split()
        total = len(set(zip(*(w[k:] for k in range(5)))))
        for at in range(len(w)):
            for many in (1, 3, 20, licenses.MARGIN):
                put = [f"put{k}" for k in range(many)]
                text = ["so", "it", "is"] + w[:at] + put + w[at:] + ["end"] * 3
                shared = set(zip(*(text[k:] for k in range(5)))) & set(zip(*(w[k:] for k in range(5))))
                if at:  # all shingles but those across the cut
                    assert len(shared) == total - min(4, at, len(w) - at, total)
                if len(shared) * 100 >= 80 * total:
                    want[len(rows), name] = len(shared) / total
                rows.append((len(rows), " ".join(text)))
    found = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    held = {(r.doc_id, r.license): r.containment for r in found if r.license in ("MIT", "GPL", "Apache-2.0", "BSD")}
    assert any(share < 1 for share in want.values()) and held == want


# -- repeats ------------------------------------------------------------------------


def plain_repeats(texts):
    listed = [words(t) for t in texts]
    counts = collections.Counter(tuple(w[k : k + 35]) for w in listed for k in range(len(w) - 34))
    for w in listed:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if counts[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        yield len(w), sum(gone), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("size", [substrings.BUCKET_BYTES, 1 << 15])
def test_repeats_equal_plain_counting(documents, odd, none, monkeypatch, size):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", size)  # the small one has hot buckets
    for table in (documents, odd):
        rows = [r.text for r in table.select("text").collect()]
        found = substrings.without_repeats(table).collect()
        assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in found) == sorted(plain_repeats(rows))
    assert substrings.cleaned(none).columns == none.columns and substrings.cleaned(none).count() == 0


def test_copies_of_one_text_are_settled_in_all_buckets(spark, monkeypatch):
    text = " ".join(f"c{k}" for k in range(600))
    rows = [(k if k % 2 else None, 7, text) for k in range(800)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("doc_id", "text_key", "text"), r)) for r in rows])
    share = collections.Counter()
    for out in substrings._deal(substrings.Buckets(64, {}))(iter([batch])):
        for bucket, blob in zip(*(c.to_pylist() for c in out.columns)):
            share[bucket] += len(substrings._unpacked(blob)[2])
    assert sum(share.values()) == 799  # one whole range for each copy after the first
    assert max(share.values()) < 799 / 8
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 1 << 14)
    table = spark.createDataFrame(
        [(doc, f"{text} z{k} {text[:700] if k % 3 else ''}") for k, (doc, _, _) in enumerate(rows)], "doc_id long, text string"
    )
    found = substrings.without_repeats(table).collect()
    want = sorted(plain_repeats([r.text for r in table.collect()]))
    assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in found) == want


# -- quality ------------------------------------------------------------------------


def test_quality_holds_out_of_sample(spark, sf_dir, odd, none):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.filter("doc_id % 2 = 0"))
    held = quality.scored(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in held]) > 0.9
    assert quality.scored(odd, model).count() == odd.count() and quality.scored(none, model).count() == 0
    bare = quality.train(none, labels.filter("false"))
    assert quality.scored(odd, bare).select("score").distinct().count() == 1


# -- fingerprints -------------------------------------------------------------------


def test_fingerprints_equal_plain_loop(documents, odd, none):
    for table in (documents, odd):
        rows = table.select("doc_id", "text").collect()
        rows.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.text is not None, (r.text or "").encode()))
        want = []
        for row, after in zip(rows, rows[1:] + rows[:1]):
            text, following = row.text or "", after.text or ""
            other = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
            a, b, c = merkle.tree(text), merkle.tree(other), merkle.tree(following)
            want.append((row.doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), a.root, b.root, merkle.likeness(a, b), merkle.likeness(a, c)))
        assert sorted(map(str, map(tuple, merkle.fingerprints(table).collect()))) == sorted(map(str, want))
    assert merkle.fingerprints(none).count() == 0


def test_differing_branches_locate_an_edit():
    text = "One here. Two here.\nThree here.\n\nFour here. Five here."
    a, b = merkle.tree(text), merkle.tree(text.replace("Two", "Ten"))
    assert [text[x:y].strip() for x, y in merkle.differing(a, b)] == ["Two here."]
    assert merkle.likeness(a, a) == 1 and 0.6 < merkle.likeness(a, b) < 1


# -- pieces -------------------------------------------------------------------------


def test_pieces_equal_the_library(documents, odd, none):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for table in (documents, odd):
        for r in pieces.encoded(table).select("row.text", "ids", "n_pieces", "round_trip").collect():
            assert list(r.ids) == library.encode(r.text or "") and r.n_pieces == len(r.ids)
            assert r.round_trip == (r.text is not None)
    assert pieces.encoded(none).count() == 0


@pytest.mark.parametrize("text", ["a  b", "   ", "\n\n x", "é☃\t😀", "▁▁ z", "x" * 400, "日本語 東京", "a" + " " * 70 + "b"])
def test_pieces_of_odd_texts(text):
    made = pieces.Pieces(open(pieces.MODEL, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    ids = np.frombuffer(made.encode([text.encode()])[0], np.int32).tolist()
    assert ids == library.encode(text) and made.decode(ids) == library.decode(ids)


# -- rules --------------------------------------------------------------------------


def test_rules_count_like_plain_loops(documents, odd, none):
    for table in (documents, odd):
        for r, text in zip(rules.quality_rules(table.coalesce(1)).collect(), table.coalesce(1).select("text").collect()):
            t = text.text or ""
            w = t.encode().split()
            lines = [x for x in t.split("\n") if x.encode().split()]
            tri = collections.Counter(zip(w, w[1:], w[2:]))
            marked = {k + j for k in range(len(w) - 2) if tri[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
            assert (r.n_words, r.word_chars) == (len(w), sum(len(x.decode()) for x in w))
            assert r.n_symbols == sum(t.count(s) for s in "#*$%&|<>")
            assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == len(marked)
            assert r.base_failed == (len(w) < 50 or 100 * len(marked) > 50 * len(w))
            assert not (r.kept and r.base_failed)
    assert rules.quality_rules(none).count() == 0


def test_failing_lines():
    def rule(line):
        return rules.failing_rule(line.encode(), line.encode().split())

    assert rule("Home | News | About") == "navigation"
    assert rule("of%%% the*** that$$$ was&&&.") == "punctuation"
    assert rule("All rights reserved by the owner of this very fine page.") == "boilerplate"
    assert rule("This is a plain sentence.") is None


# -- chat ---------------------------------------------------------------------------


def test_calls_meet_results_in_order(spark):
    calls = spark.createDataFrame(
        [
            (1, 1, "a", "t", '{"q": "x", "n": 1}', None), (1, 2, "b", "t", '{"n":2,"q":"é"}', "a"),
            (1, 3, "c", "t", '{"q": 5}', "b"), (1, 4, "d", "no", "{}", "zz"), (1, 5, "e", "t", "{", "f"),
            (1, 6, "f", "t", '{"q":"x"}', "e"), (1, 7, None, "t", '{"q":"x"}', None), (1, 8, "a", "t", '{"q":"y"}', None),
            (None, None, "g", None, None, "c"),
        ],
        "thread long, place long, call_id string, name string, arguments string, after string",
    )
    results = spark.createDataFrame(
        [("a", 2, "ra"), ("a", 3, "again"), ("c", 4, None), ("x", 1, "r"), (None, 1, "r")],
        "call_id string, place long, content string",
    )
    schemas = {"t": {"properties": {"q": {"type": "string"}, "n": {"type": "integer"}}, "required": ["q"]}}
    found = {r.call_id: r for r in chat.linked(calls, results, schemas).collect()}
    assert {k: (r.depth, r.status) for k, r in found.items()} == {
        "a": (0, "ok"), "b": (1, "unanswered"), "c": (2, "invalid"), "d": (0, "unknown predecessor"),
        "e": (None, "cycle"), "f": (None, "cycle"), None: (0, "missing id"), "g": (3, "invalid"), "x": (None, "orphan"),
    }
    assert found["a"].message == '{"arguments":{"n":1,"q":"x"},"id":"a","name":"t","result":"ra"}'
    assert (found["a"].calls, found["a"].results, found["c"].errors) == (2, 2, ["q: no string"])
    assert json.loads(found["b"].message)["arguments"]["q"] == "é"
    assert chat.linked(calls.filter("false"), results.filter("false"), schemas).count() == 0


# -- near duplicates ----------------------------------------------------------------


def plain_components(rows):
    sets = {}
    for k, (_, text) in enumerate(rows):
        w = (text or "").encode().translate(near_lower).split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= 85 * large:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    parent[root(a)] = root(b)
    low = collections.defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(k)].append(doc)
    return [
        (doc, len(sets[k]), doc if not sets[k] else min(low[root(k)], default=None)) for k, (doc, _) in enumerate(rows)
    ]


near_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


GROUP_BYTES = near.GROUP_BYTES


@pytest.mark.parametrize("block", [GROUP_BYTES, 1 << 16])
def test_near_duplicates_equal_all_pairs(documents, odd, none, monkeypatch, block):
    monkeypatch.setattr(near, "GROUP_BYTES", block)  # the small one cuts groups in blocks
    for table in (documents, odd) if block == GROUP_BYTES else (documents,):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        found = near.near_duplicates(table).collect()
        assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in found))) == sorted(
            map(str, plain_components(rows))
        )
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    if block == GROUP_BYTES:
        assert near.near_duplicates(none).count() == 0


def test_case_and_space_variants_link_their_near_duplicates(spark):
    rows = []
    for g in range(12):
        plain = [f"g{g}w{k}" for k in range(80)]
        variants = [" ".join(plain), "\n".join(plain), " ".join(plain).upper(), "  ".join(plain).title()]
        close = [" ".join([*plain, f"tail{t}"]) for t in range(2)]
        # in turn: the least doc_id is that of each variant, of a close text, or null
        texts = (variants + close)[g % 6 :] + (variants + close)[: g % 6]
        rows += [(None if g > 9 and k < 3 else 10 * g + k, text) for k, text in enumerate(texts)]
    rows += [(None, "\t".join(f"n{k}" for k in range(30))), (None, " ".join(f"N{k}" for k in range(30)))]
    rows += [(None, " ".join(f"n{k}" for k in range(31)))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = near.near_duplicates(table).collect()
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in found))) == sorted(
        map(str, plain_components(rows))
    )
    assert near.without_near_duplicates(table).count() == 13


def test_the_similarity_is_a_parameter(spark):
    rows = []
    for g in range(20):
        # 96 shingles each; how many of all are shared
        base = [f"g{g}w{k}" for k in range(100)]
        rows.append((10 * g, " ".join(base)))
        rows.append((10 * g + 1, " ".join(base[:90] + [f"g{g}x{k}" for k in range(10)])))  # 86 of 106
        rows.append((10 * g + 2, " ".join([f"g{g}y{k}" for k in range(15)] + base[15:])))  # 81 of 111
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert near.near_duplicates(table).filter("kept").count() == 60
    kept = near.without_near_duplicates(table, 80)
    assert sorted(r.doc_id % 10 for r in kept.collect()) == [0] * 20 + [2] * 20


def test_bands_follow_the_similarity():
    assert [near.bands_for(p) for p in (85, 80)] == [24, 35]
    assert near.sure_for(85) <= 0.65 * 120 and near.sure_for(80) < near.sure_for(85) / 120 * 175


def test_one_of_each_group_stays(odd):
    kept = near.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "1", "2", "3", "4", "6", "None"]


# -- pipeline -----------------------------------------------------------------------


def test_pipeline_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]
    for k, stage in enumerate(stages):
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, small_dir))
        if k < 4:
            assert docs.columns == columns
        if k == 1:
            assert docs.count() == near.near_duplicates(before, corpus_pipeline.NEAR_PERCENT).filter("kept").count()
        if k == 2:
            want = sorted(x[2] for x in plain_repeats([r.text for r in before.collect()]))
            assert sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in docs.collect()) == want
    assert docs.count() > 0 and docs.filter("NOT round_trip").count() == 0
