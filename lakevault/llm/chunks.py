"""Documents gathered in chunks inside a task, so that a word is sent once for many of them."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext

from lakevault.llm.packing import pack


def chunks(batches, size: int):
    """Tables that end with the row that brings their texts to ``size`` characters, wherever the
    Arrow batches end."""
    held, chars = [], 0
    for batch in batches:
        first = 0
        lengths = pc.utf8_length(batch.column(batch.num_columns - 1)).fill_null(0).to_pylist()
        for row, length in enumerate(lengths, 1):
            chars += length
            if chars >= size:
                yield pa.Table.from_batches([*held, batch.slice(first, row - first)])
                held, chars, first = [], 0, row
                pa.default_memory_pool().release_unused()
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held)


def named(distinct: list[bytes], number: int) -> bytes:
    """The name of a task's chunk of this running number, by partition, number and words: chunks of
    the same words have names of their own, and one whose words changed is not found."""
    context = TaskContext.get()
    h = xxhash.xxh3_128(pack([context.partitionId() if context else 0, number, len(distinct)]))
    h.update(pack([len(w) for w in distinct]))
    h.update(b"".join(distinct))
    return h.digest()
