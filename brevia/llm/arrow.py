"""Bounded batches for functions that run inside ``mapInArrow``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Row slices with about a megabyte of text each; a longer text is its own slice."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_pylist()
        begin = size = 0
        for i, n in enumerate(sizes):
            if i > begin and size + (n or 0) > SLICE_BYTES:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n or 0
        if begin < len(sizes):
            yield batch.slice(begin)


def raw(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]
