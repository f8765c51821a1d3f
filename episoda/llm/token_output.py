"""Token-id output: packed id matrices with cumulative segment lengths and position resets.

Each task packs its own documents, block by block, so nothing is shuffled: documents become ids, overlong ones are split without loss, and
the segments go best-fit-decreasing into rows of `capacity` ids; a segment tree over free capacities finds the fullest row that still fits.
Only the last rows of a block are part empty. A block holds at most `block_ids` ids, whatever the size of the input.

Defined results: null or empty text is one segment, the end id alone; a null id is kept; an empty table gives no rows; further columns are
ignored; equal rows are written as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from episoda.llm import common, tokens

CAPACITY, END_ID, PAD_ID = 2048, 0, 0
BLOCK_IDS = 2_000_000

SCHEMA = (
    "sequence_id long, n_ids int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, pieces array<int>, starts array<long>"
)


class FreeSpace:
    """Rows by free capacity: a segment tree over capacities 0..top counts the rows at each leaf; best fit is the first non-empty leaf from the right size on."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(top + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        i = free + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (free capacity, row) of the fullest row with room for `need`."""
        count, i = self.count, need + self.leaves
        while not count[i]:
            while i & 1:  # climb until a right sibling exists
                i >>= 1
            if i <= 1:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        free = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of `lengths` by row, each row at most `capacity` in sum."""
    space, rows = FreeSpace(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = space.take(lengths[i])
        free, row = found or (capacity, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(i)
        space.add(free - lengths[i], row)
    return rows


def _block(segments: list[tuple], capacity: int, first: int) -> pa.RecordBatch:
    rows = best_fit_decreasing([len(s[3]) // 4 for s in segments], capacity)
    pad = np.full(capacity, PAD_ID, "<u4").tobytes()
    out: list[list] = [[] for _ in range(8)]
    for k, row in enumerate(rows):
        own = [segments[i] for i in row]
        raw = b"".join(s[3] for s in own)
        edges = np.concatenate([[0], np.cumsum([len(s[3]) // 4 for s in own])]).astype(np.int32)
        for column, v in zip(out, (first + k, len(raw) // 4, raw + pad[len(raw) :], edges, edges[:-1], [s[0] for s in own], [s[1] for s in own], [s[2] for s in own]), strict=True):
            column.append(v)
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = (pa.int64(), pa.int32(), pa.binary(), ints, ints, longs, ints, longs)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])


def _write(batches: Iterator[pa.RecordBatch], path: str, capacity: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    encoder, end, width = tokens.word_encoder(path), np.array([END_ID], "<u4").tobytes(), 4 * capacity
    first = TaskContext.get().partitionId() << 36
    segments, held = [], 0
    for batch in common.slices(batches, "text"):
        for doc, text in zip(batch.column("doc_id").to_pylist(), common.texts(batch), strict=True):
            raw = encoder.encode(text) + end
            segments += [(doc, k, at // 4, raw[at : at + width]) for k, at in enumerate(range(0, len(raw), width))]
            held += len(raw) // 4
        if held >= block_ids:
            yield (block := _block(segments, capacity, first))
            first, segments, held = first + block.num_rows, [], 0
    if segments:
        yield _block(segments, capacity, first)


def token_matrices(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per packed sequence: `ids` is a row of the id matrix (little-endian uint32, padded to `capacity`), `cu_seqlens` the cumulative
    segment lengths from 0, `position_resets` where positions begin again at 0, and doc_ids, pieces, starts name the segments in order."""
    path = tokenizer or tokens.default_path("word_bpe_49k.json")
    return docs.select("doc_id", "text").mapInArrow(partial(_write, path=path, capacity=capacity, block_ids=block_ids), SCHEMA)


def positions(cu_seqlens: np.ndarray, capacity: int) -> np.ndarray:
    """Position ids of one row: 0, 1, ... within each segment; the padding counts on as a segment of its own."""
    edges = np.asarray(cu_seqlens)
    out = np.arange(capacity)
    owner = np.searchsorted(edges, out, side="right") - 1
    return (out - edges[owner]).astype(np.int32)


def write_token_shards(docs: DataFrame, path: str, tokenizer: str | None = None, capacity: int = CAPACITY) -> None:
    """Write the matrices as Parquet shards; every task writes its own rows, to any store that Spark reaches."""
    token_matrices(docs, tokenizer, capacity).write.parquet(path)
