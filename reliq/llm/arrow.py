"""Helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once: batches are cut to it, so memory does not follow the batch size.
PIECE_BYTES = 4 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of a text column; one row is never cut."""
    for batch in batches:
        texts = batch.column(column)
        start, size = 0, 0
        for i, length in enumerate(pc.binary_length(texts).to_pylist()):
            if i > start and size + (length or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def with_columns(batch: pa.RecordBatch, drop: list[str], added: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without some columns and with others after them."""
    kept = [name for name in batch.schema.names if name not in drop]
    return pa.RecordBatch.from_arrays([batch.column(name) for name in kept] + list(added.values()), kept + list(added))
