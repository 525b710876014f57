"""The fill-in-middle transformation against plain string work."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from spoor.llm import infill, queries

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"1:{'null' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return len(units), form, len(p), len(m), output


def check(rows):
    for r in rows:
        n, form, prefix, middle, output = plain(r.doc_id, r.row.text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output, r.output_sha256, r.restored_sha256) == (output, sha(output), sha(r.row.text or ""))


@pytest.mark.parametrize("frame", [5, 1 << 16])
def test_transformed_equals_plain_work(documents, odd, none, frame):
    small = odd.union(odd.sparkSession.createDataFrame([(k, t, *[None] * 6) for k, t in enumerate(MARKED)], odd.schema))
    rows = infill.transformed(small.withColumn("text", F.left("text", F.lit(5000))), frame_bytes=frame).collect()
    assert len(rows) == small.count() and {r.form for r in rows} == {"plain", "psm", "spm"}
    check(rows)
    if frame > 5:
        check(infill.transformed(documents).collect() + infill.transformed(odd).collect())
    assert infill.transformed(none).count() == 0


MARKED = ["<P>", "a <S> b", "x<M", ">", "<P<S>", "<<P", "é" * 11, "日本語 text\nand\r\nmore", "😀a😀", "a", "\0", "abc" * 20] + [
    f"<{k} words, of no { 'long ' * (k % 7)}text P> S> M> <P <S <M" for k in range(60)
]


def test_the_query_equals_plain_work(spark, small_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    found = queries.QUERIES["op13_infill"](spark, small_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        n, form, prefix, middle, output = plain(r.doc_id, texts[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, prefix, middle, sha(output), sha(texts[r.doc_id]))


def test_outputs_are_restored(documents, odd, none):
    for docs in (documents, odd, none):
        made = infill.transformed(docs).select("row", "form", "output")
        back = infill.restored(made)
        assert back.count() == docs.count()
        assert back.filter("text <> coalesce(row.text, '') OR text IS NULL").count() == 0
    lost = odd.sparkSession.createDataFrame([(None, "x"), ("psm", None)], "form string, output string")
    assert [r.text for r in infill.restored(lost).collect()] == [None, None]


def test_frames_are_independent_and_counted(odd, none):
    found = infill.framed(odd, 1000)
    assert found.columns == [c for c in odd.columns if c != "text"] + ["frames"] and infill.framed(none).count() == 0
    rows = {r.doc_id: r.frames for r in found.filter("doc_id IN (2, 4)").collect()}
    assert rows[2] == []
    text = odd.filter("doc_id = 4").first().text
    last = rows[4][-2]
    begin = text.encode()[: last["bytes"]].decode()
    part = infill.zstandard.ZstdDecompressor().decompress(last["data"])
    assert text.encode()[last["bytes"] :].startswith(part) and len(part) == 1000
    assert last["units"] == len(UNIT.findall(begin)) and last["chars"] == len(begin)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab <PSM>é日😀\n", max_size=60), st.integers(4, 9), st.data())
def test_cuts_and_reads(text, size, data):
    units = UNIT.findall(text)
    store = infill.Frames([text.encode()], size)
    assert b"".join(store.part(k) for k in range(len(store.data))) == text.encode()
    assert (store.units[-1], store.chars[-1]) == (len(units), len(text))
    unit = data.draw(st.integers(0, len(units)))
    before = "".join(units[:unit])
    assert store.cut(unit) == (len(before.encode()), len(before))
    begin = data.draw(st.integers(0, len(text.encode())))
    assert b"".join(store.read(begin, len(text.encode()))) == text.encode()[begin:]
    for mark in (b"<P>", b"<S>", b"aa"):
        place = text.encode().find(mark, begin)
        if place >= 0:
            assert store.find(mark, begin) == place
        else:
            with pytest.raises(ValueError, match="no b"):
                store.find(mark, begin)
