"""Envelope, sizes, splitting, versions and lists."""

import base64
import gzip
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from spoor import constants as c
from spoor.functions import versions
from spoor.operators import messages
from spoor.plans.harvest import messages_of

LIMIT = 300


def noise(seed, size):
    return base64.b64encode(random.Random(seed).randbytes(size)).decode()


TEXTS = [
    "",
    "x" * 70,
    "x" * 300,
    "é" * 150,
    "é" * 151,
    "\U0001f600" * 75,
    "\U0001f600" * 76,
    "x" * 301,
    "x" * 5000,
    noise(1, 225),
    noise(2, 226),
    noise(3, 2000),
    "line\nbreak\r\n\t\"quoted\" \\ " * 40,
]


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(k, f"key{k}", text) for k, text in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "msg_seq long, msg_key string, msg_json string")
    return messages.with_message_id(frame, "run")


@pytest.mark.parametrize("compress", [True, False])
def test_split_then_reassemble(plain, compress):
    sent = messages.split_large(plain, LIMIT, compress).cache()
    rows = sent.collect()
    large = [k for k, text in enumerate(TEXTS) if len(text.encode()) > LIMIT]
    for row in rows:
        if row.msg_seq not in large:
            assert (row.value, row.msg_id, row.split_count) == (TEXTS[row.msg_seq], None, 1)
            continue
        part = json.loads(row.value)
        assert len(part["message"]) <= LIMIT
        assert part["msgId"] == f"run_{row.msg_seq}"
        assert part["msgCompressionKind"] == ("GZIP" if compress else "NONE")
        assert part["version"] == {"version": "1.0.0", "versionParts": [1]}
        assert part["msgSplitCount"] == row.split_count
    for seq in large:
        parts = [r for r in rows if r.msg_seq == seq]
        index = sorted(r.split_idx for r in parts)
        alone = compress and len(parts) == 1
        assert index == ([1] if alone else list(range(len(parts))))
        assert all(r.split_count == len(parts) for r in parts)
    back = messages.reassemble(messages.read_parts(sent.filter("msg_id IS NOT NULL")))
    found = {r.msg_id: r.msg_json for r in back.collect()}
    assert found == {f"run_{k}": TEXTS[k] for k in large}


def test_compression_can_be_read_by_any_gzip(plain):
    row = messages.compress_large(plain, LIMIT).filter("msg_seq = 8").first()
    part = json.loads(row.value)
    assert (part["msgSplitIdx"], part["msgSplitCount"]) == (1, 1)
    assert gzip.decompress(base64.b64decode(part["message"])).decode() == TEXTS[8]


def test_size_classes(plain):
    rows = messages.with_size_class(plain, LIMIT).collect()
    for row in rows:
        text = TEXTS[row.msg_seq]
        units = len(text.encode("utf-16-be")) // 2
        size = len(text.encode())
        expected = (
            "fits_by_chars" if units * 4 <= LIMIT else "fits_by_bytes" if size <= LIMIT else "oversize"
        )
        assert (row.n_bytes, row.size_class) == (size, expected)


def test_default_limit():
    assert c.MAX_MESSAGE_BYTES == 999488


def test_missing_and_corrupt_parts(spark):
    def part(msg_id, index, count, body, kind="GZIP"):
        return (
            json.dumps(
                {
                    "msgId": msg_id,
                    "msgCompressionKind": kind,
                    "msgSplitIdx": index,
                    "msgSplitCount": count,
                    "message": body,
                }
            ),
        )

    good = base64.b64encode(gzip.compress(b"hello")).decode()
    sent = spark.createDataFrame(
        [
            part("a", 0, 2, good[:10]),
            part("a", 1, 2, good[10:]),
            part("a", 1, 2, good[10:]),
            part("b", 0, 2, good[:10]),
            part("c", 1, 1, base64.b64encode(b"not gzip").decode()),
            part("d", 1, 1, "***"),
            part("e", 1, 1, base64.b64encode(b"\xff\xfe").decode(), "NONE"),
        ],
        "value string",
    )
    parts = messages.read_parts(sent)
    back = {r.msg_id: r.msg_json for r in messages.reassemble(parts).collect()}
    assert back == {"a": "hello", "c": None, "d": None, "e": None}
    rejected = {r.msg_id: r.reason for r in messages.rejected_messages(parts).collect()}
    assert rejected == {"b": "missing_parts", "c": "corrupt", "d": "corrupt", "e": "corrupt"}


def test_envelope_of_a_struct_is_nested_json(spark):
    asked = spark.sql("SELECT 1L AS msg_seq, 'k' AS msg_key, named_struct('a', 1, 'b', null) AS message")
    row = messages_of(asked, "run", "1.2.3.4", "me", 5).first()
    assert json.loads(row.value) == {
        "version": {"version": "1.0.0", "versionParts": [1]},
        "msgCompressionKind": "NONE",
        "msgSplitIdx": 1,
        "msgSplitCount": 1,
        "msgSourceIP": "1.2.3.4",
        "msgCreatedBy": "me",
        "msgCreationTime": 5,
        "message": {"a": 1},
    }
    assert (row.msg_id, row.split_idx, row.split_count) == (None, 1, 1)


def test_ids_do_not_change_on_a_second_run(plain):
    first = messages.split_large(plain, LIMIT).select("value").collect()
    assert first == messages.split_large(plain, LIMIT).select("value").collect()


VERSIONS = {
    "0": [],
    "1": [1],
    "1.0.0": [1],
    "1.0.1": [1, 0, 1],
    "1.10": [1, 10],
    "0.9.9": [0, 9, 9],
    "1.": [1],
    "1.0..": [1],
    ".": [],
    "-1": [-1],
    "1.-1": [1, -1],
    "+2": [2],
    "": None,
    "1.x": None,
    "1..2": None,
    " 1": None,
    "99999999999": None,
}


def test_version_parts(spark):
    frame = spark.createDataFrame([(v,) for v in VERSIONS], "version string")
    rows = messages.with_version_parts(frame).collect()
    assert {r.version: r.version_parts for r in rows} == VERSIONS


def sign(left, right):
    size = max(len(left), len(right))
    a = left + [0] * (size - len(left))
    b = right + [0] * (size - len(right))
    return (a > b) - (a < b)


def test_version_order(spark):
    frame = spark.createDataFrame([(v,) for v in VERSIONS], "version string")
    pairs = frame.alias("a").crossJoin(frame.alias("b"))
    a, b = (versions.version_parts(F.col(f"{side}.version")) for side in "ab")
    rows = pairs.select(
        F.col("a.version").alias("a"),
        F.col("b.version").alias("b"),
        versions.compare_parts(a, b).alias("sign"),
    ).collect()
    for row in rows:
        left, right = VERSIONS[row.a], VERSIONS[row.b]
        expected = None if left is None or right is None else sign(left, right)
        assert row.sign == expected, row


def test_compatible(spark):
    frame = spark.createDataFrame([(v,) for v in VERSIONS], "version string")
    kept = {r.version for r in messages.compatible(frame, "1.0").collect()}
    assert kept == {"0", "1", "1.0.0", "0.9.9", "1.", "1.0..", ".", "-1", "1.-1"}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" \t\x00\x1fab,;é ", max_size=20), min_size=1, max_size=20))
def test_clean_list(spark, texts):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, csv string")
    blank = "".join(map(chr, range(33)))
    for row in messages.clean_list(frame, "csv").collect():
        expected = [p.strip(blank) for p in texts[row.k].split(",")]
        assert row.entries == [p for p in expected if p]


def test_clean_list_of_null(spark):
    frame = spark.createDataFrame([(None,)], "csv string")
    assert messages.clean_list(frame, "csv").first().entries == []


def test_whole_messages_that_came_once_are_not_shuffled(spark):
    def part(msg_id, index, count, text):
        body = base64.b64encode(text.encode()).decode()
        return F.to_json(
            F.struct(
                msg_id.alias("msgId"),
                F.lit("NONE").alias("msgCompressionKind"),
                F.lit(index).alias("msgSplitIdx"),
                F.lit(count).alias("msgSplitCount"),
                F.lit(body).alias("message"),
            )
        )

    name = F.concat(F.lit("m"), F.col("id"))
    asked = [
        ("id < 40", part(name, 1, 1, "alone")),
        ("id < 3", part(F.concat(F.lit("twice"), "id"), 1, 1, "again")),
        ("id < 3", part(F.concat(F.lit("twice"), "id"), 1, 1, "again")),
        ("id < 3", part(F.concat(F.lit("other"), "id"), 1, 1, "one")),
        ("id < 3", part(F.concat(F.lit("other"), "id"), 1, 1, "two")),
        ("id < 3", part(F.concat(F.lit("split"), "id"), 0, 2, "first,")),
        ("id < 3", part(F.concat(F.lit("split"), "id"), 1, 2, "second")),
        ("id < 3", part(F.concat(F.lit("half"), "id"), 0, 2, "first")),
    ]
    values = F.filter(F.array(*[F.when(F.expr(given), value) for given, value in asked]), lambda x: x.isNotNull())
    sent = spark.range(0, 40, 1, 4).withColumn("task", F.spark_partition_id())
    parts = messages.read_parts(sent.select("task", F.explode(values).alias("value")))
    back = messages.reassemble(parts, ["task"]).withColumn("now", F.spark_partition_id()).collect()
    expected = {f"m{k}": "alone" for k in range(40)}
    expected |= {f"twice{k}": "again" for k in range(3)} | {f"split{k}": "first,second" for k in range(3)}
    assert sorted((r.msg_id, r.msg_json) for r in back) == sorted(expected.items())
    # Where they were read, but for those whose hash one of the others has.
    assert sum(r.now == r.task for r in back if r.msg_id.startswith("m")) >= 38
