"""Small helpers around ``mapInArrow``."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  makes pa.compute available

from credmill.llm import words

# Text that is turned into arrays at once, so little that they stay in the processor's
# cache.  One text may be longer.
SLICE_BYTES = 1 << 19


def give_back() -> None:
    """Return memory that is free in this worker to the system.

    Workers live on from stage to stage.  What one stage has freed would count beside what the
    next one takes.
    """
    words.forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES, *, within: str | None = None
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or one row.

    ``within`` names a struct column that holds the text.
    """
    for batch in batches:
        lengths = pa.compute.struct_field(batch.column(within), text) if within else batch.column(text)
        sizes = pa.compute.fill_null(pa.compute.binary_length(lengths), 0).to_numpy(False)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
        batch = lengths = sizes = None  # before the next one is read
    give_back()


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8; NULL is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def one_task_batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Gather tuples into record batches of ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
