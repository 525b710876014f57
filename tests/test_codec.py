"""What a task holds while it packs and unpacks a batch."""

import gzip
import tracemalloc

import pyarrow as pa
from spoor.functions import codec


def test_unpacking_holds_the_result_once():
    text = bytes(range(256)) * 400
    batch = pa.array([gzip.compress(text), None, b"no gzip", gzip.compress(b"")] * 100, pa.binary())
    each = codec._each(lambda raw: gzip.decompress(raw) if bytes(raw[:1]) == b"\x1f" else None)
    tracemalloc.start()
    found = each(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.slice(0, 4).to_pylist() == [text, None, None, b""] and found.null_count == 200
    assert peak < 1.6 * 100 * len(text)
