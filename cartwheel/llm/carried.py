"""Columns that travel beside a block of texts, as Arrow writes them."""

from __future__ import annotations

import pyarrow as pa


def pack_columns(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as writer:
        for batch in batches:
            writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_columns(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()
