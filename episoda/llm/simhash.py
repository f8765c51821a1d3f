"""SimHash near-duplicate groups: fingerprints of word shingles, compared bit-sliced, linked within a radius.

A fingerprint is 64 bits, cut into 4 blocks of 16; two fingerprints within 2 bits agree on at least 2 blocks, so every link lies in one of
6 tables keyed by two blocks (32 bits). Within buckets of every size the bits are stored as vertical planes, 64 fingerprints of a bucket to a
machine word; distances to a query grow in carry-save counters plane by plane, and a word is abandoned once all of its counters exceed the
radius. Buckets return a spanning set of their links, not their pairs. Buckets over `bucket_rows` are split into pairs of chunks that meet in
separate tasks, so a group of any size is compared whole and by many tasks.

Defined results: null or empty text and text of white space only have fingerprint zero, linked like any other; repeated rows and ids stay rows
of their own (equal text, equal group); a bit that exactly half of the shingles set is 0; null ids are kept and do not name a group unless it
has no other; a text of any length is read whole, with memory in proportion to it; an empty table gives no rows; further columns are ignored.

`near_text` compares texts by the Jaccard similarity of their shingles and uses the same planes and counters inside its buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episoda.llm import common
from episoda.llm.components import components

BITS, RADIUS, BLOCKS, SEED = 64, 2, 4, 42
BUCKET_ROWS = 4096
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, words_a_shingle: int = 3) -> int:
    """64-bit majority of the shingles' XXH64, as an unsigned integer."""
    words = text.lower().split()  # bytes: A-Z only, and white space is exactly [\x20\x09-\x0D]
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= words_a_shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_digest
    total = np.zeros(BITS, np.int64)
    m = n - words_a_shingle + 1
    spans = list(zip(starts[:m].tolist(), ends[words_a_shingle - 1 :].tolist(), strict=True))
    for at in range(0, m, 65536):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in spans[at : at + 65536]])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8), axis=1)
        total += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > m).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], words_a_shingle: int) -> Iterator[pa.RecordBatch]:
    common.forget_tables()
    for batch in common.slices(batches, "text"):
        fps = np.array([fingerprint(t, words_a_shingle) for t in common.raw_texts(batch)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, words_a_shingle: int = 3) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(partial(_fingerprints, words_a_shingle=words_a_shingle), "doc_id long, fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of uint64 fingerprints: row b holds bit b of all of them, 64 to a word (little-endian; the last word is padded with zeros)."""
    n = -(-len(fps) // 64) * 64
    rows = np.unpackbits(np.concatenate([fps, np.zeros(n - len(fps), np.uint64)]).astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(rows.T), axis=1, bitorder="little").view("<u8")


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Bits of the fingerprints whose counted distance is above the radius; `over` marks those that the counters cannot hold."""
    above, equal = over.copy(), np.full_like(over, _FULL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def near_pairs(fps: np.ndarray, starts: np.ndarray, radius: int = RADIUS, jobs: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions (a < b) of uint64 fingerprints within the radius (below 64) of each other, where both lie in one group.

    Groups are fps[starts[k]:starts[k + 1]]. Each has words of its own in shared bit planes, 64 of its fingerprints to a word; a job is a
    fingerprint and a word of its group. Distances of many jobs grow plane by plane in carry-save counters, and a job is abandoned once all
    of its word's counters are beyond the radius.
    """
    sizes = np.diff(starts)
    words = -(-sizes // 64)
    first = np.concatenate([[0], np.cumsum(words)])
    group = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(fps)) - starts[group]
    slot = first[group] * 64 + place
    padded = np.zeros(int(first[-1]) * 64, np.uint64)
    padded[slot] = fps
    owner = np.zeros(len(padded), np.int64)
    owner[slot] = np.arange(len(fps))
    plane = planes(padded)
    used = np.zeros(len(padded), np.uint8)
    used[slot] = 1
    used = np.packbits(used, bitorder="little").view("<u8")
    own = slot // 64
    todo = first[group + 1] - own  # words from its own on: later fingerprints of the group are there
    todo[starts[1:][sizes > 0] - 1] = 0  # the last of a group has none
    ends = np.cumsum(todo)
    width = max(1, radius.bit_length())
    for at in range(0, int(ends[-1]) if len(ends) else 0, jobs):
        number = np.arange(at, min(at + jobs, int(ends[-1])))
        job = np.searchsorted(ends, number, "right")
        word = own[job] + number - (ends - todo)[job]
        query = fps[job]
        counters, over = [np.zeros(len(job), np.uint64) for _ in range(width)], np.zeros(len(job), np.uint64)
        for b in range(BITS):
            carry = plane[b][word] ^ (np.uint64(0) - (query >> np.uint64(b) & np.uint64(1)))
            for k in range(width):
                carry, counters[k] = counters[k] & carry, counters[k] ^ carry
            over |= carry
            if b % 8 == 7:
                near = used[word] & ~_beyond(counters, over, radius)
                live = np.flatnonzero(near)
                if len(live) < len(job):
                    job, word, query, over, near = job[live], word[live], query[live], over[live], near[live]
                    counters = [c[live] for c in counters]
                    if not len(job):
                        break
        if len(job):
            rows, bits = np.nonzero(np.unpackbits(near.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            a, b = job[rows], owner[word[rows] * 64 + bits]
            yield a[a < b], b[a < b]


class Forest:
    """Union-find over positions; links() is a spanning set."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def spanning_links(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links within each group, as two arrays of positions."""
    forest = Forest(len(fps))
    for a, b in near_pairs(fps, starts, radius):
        up = np.array(forest.up)
        while (up[up] != up).any():
            up = up[up]
        ends = np.unique(np.stack([up[a], up[b]])[:, up[a] != up[b]], axis=1)
        for x, y in ends.T.tolist():
            forest.join(x, y)
    root = np.array([forest.find(i) for i in range(len(fps))], np.int64)
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return moved, root[moved]


def _buckets(batches: Iterator[pa.RecordBatch], radius: int, together: int = 8192) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; a bucket may span batches. Whole buckets are compared together once they hold `together` fingerprints."""
    rest: list[list[np.ndarray]] = [[] for _ in range(4)]

    def done(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort([columns[3].view(np.uint64), *columns[2::-1]])
        columns = [c[order] for c in columns]
        new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)])
        keep = new | np.concatenate([[True], columns[3][1:] != columns[3][:-1]])
        fps, new = columns[3][keep].view(np.uint64), new[keep]
        a, b = spanning_links(fps, np.append(np.flatnonzero(new), len(fps)), radius)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], ["u", "v"])

    for batch in batches:
        for column, name in zip(rest, ("band", "bucket", "chunk", "fp"), strict=True):
            column.append(batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64))
        if sum(map(len, rest[3])) >= together:
            columns = [np.concatenate(c) for c in rest]
            last = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0))
            if len(last):
                cut = int(last[-1]) + 1
                yield from done([c[:cut] for c in columns])
                columns = [c[cut:] for c in columns]
            rest = [[c] for c in columns]
    if sum(map(len, rest[3])):
        yield from done([np.concatenate(c) for c in rest])


def links(distinct_fps: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(u, v) over bigint fingerprints `fp`, each once: links that connect all fingerprints within `radius` (at most 2) of each other."""
    if not 0 <= radius <= 2:
        raise ValueError("the band tables cover a radius of at most 2")
    width = BITS // BLOCKS
    block = lambda i: F.shiftrightunsigned("fp", width * i).bitwiseAND((1 << width) - 1)
    bands = [F.struct(F.lit(k).alias("band"), (block(i) * (1 << width) + block(j)).alias("bucket")) for k, (i, j) in enumerate(combinations(range(BLOCKS), 2))]
    rows = distinct_fps.select("fp", F.explode(F.array(*bands)).alias("x")).select("x.band", "x.bucket", "fp")
    hot = rows.groupBy("band", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows)
    hot = hot.select("band", "bucket", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts"))
    dealt = rows.join(hot, ["band", "bucket"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.when(F.col("parts") > 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))
    dealt = dealt.select("band", "bucket", "fp", own.alias("mine"), F.explode(other).alias("yours"))
    dealt = dealt.select("band", "bucket", (F.least("mine", "yours") * 100_000 + F.greatest("mine", "yours")).cast("long").alias("chunk"), "fp")
    sorted_rows = dealt.repartition("band", "bucket", "chunk").sortWithinPartitions("band", "bucket", "chunk")
    return sorted_rows.mapInArrow(partial(_buckets, radius=radius), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, words_a_shingle: int = 3, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp (bigint bits), component_id (smallest doc_id that links reach) for every row of docs(doc_id, text)."""
    prints = common.materialise(fingerprints(docs, words_a_shingle), "prints")
    first = common.materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    found = components(links(first.select("fp"), radius, bucket_rows))
    if found is None:
        owner = first.select("fp", F.col("first_id").alias("component_id"))
    else:
        rooted = first.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        rooted = common.materialise(rooted, "rooted")
        owner = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(common.materialise(owner, "owners"), "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: str = "fp") -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
