"""gzip and gunzip over Arrow batches; Spark has no built-in for either.

Values are taken from the batch and put into the result one by one, so that a task holds
its batch and its result once. The functions are made inside functions, so tasks need only
the standard library, numpy and pyarrow, not this package.
"""

import gzip
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _each(convert):
    """An Arrow function that applies ``convert`` to every value; what is null stays or
    becomes null."""

    def apply(batch):
        data, ends, known = bytearray(), [0], []
        for value in batch:
            made = convert(value.as_buffer()) if value.is_valid else None
            known.append(made is not None)
            data += made or b""
            ends.append(len(data))
        # 32-bit offsets, as Spark's batches have them.
        if ends[-1] >= 1 << 31:
            raise ValueError("a batch of 2 GB: lower spark.sql.execution.arrow.maxRecordsPerBatch")
        bits = pa.py_buffer(np.packbits(np.array(known, bool), bitorder="little").tobytes())
        offsets = pa.py_buffer(np.array(ends, np.int32).tobytes())
        return pa.Array.from_buffers(pa.binary(), len(known), [bits, offsets, pa.py_buffer(data)])

    return apply


def gzip_bytes(data: Column) -> Column:
    """Nulls stay null."""
    each = _each(lambda raw: gzip.compress(raw, 6, mtime=0))  # a fixed time stamp: bytes the same when run again

    def pack(batch: pa.Array) -> pa.Array:
        return each(batch)

    return F.arrow_udf(pack, T.BinaryType())(data)


def gunzip_bytes(data: Column) -> Column:
    """Nulls stay null; corrupt input becomes null."""

    def unpack_one(raw):
        try:
            return gzip.decompress(raw)
        except (OSError, EOFError, zlib.error):
            return None

    each = _each(unpack_one)

    def unpack(batch: pa.Array) -> pa.Array:
        return each(batch)

    return F.arrow_udf(unpack, T.BinaryType())(data)
