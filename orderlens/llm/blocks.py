"""Blocks of documents that share a dictionary.

A task deals its documents to blocks of bounded size.  The distinct keys of a block (words, pairs)
travel once for the block, not once for each document: they go to where corpus-wide values are
summed, and the values come back to the block's documents.  Block names come from the task's place,
so tables with blocks are written before they are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext


class BlockNames:
    """Names of the blocks of a task, different from those of all other tasks of its job."""

    def __init__(self):
        context = TaskContext.get()
        self.first = (context.partitionId() if context else 0) << 32
        self.made = 0

    def __call__(self) -> int:
        self.made += 1
        return self.first + self.made


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Rows that come sorted by (block, kind), as parts of one block and kind: block, whether the part
    is the first of its block, and the part."""
    now = None
    for batch in batches:
        blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        at = 0
        while at < len(batch):
            end = at + int((blocks[at:] == blocks[at]).argmin() or len(batch) - at)
            end = at + int((kinds[at:end] == kinds[at]).argmin() or end - at)
            yield int(blocks[at]), now != blocks[at], batch.slice(at, end - at)
            now, at = blocks[at], end
