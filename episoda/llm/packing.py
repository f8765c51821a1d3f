"""Best-fit packing of a corpus into fixed-length sequences.

Documents become token pieces on the executors; only the histogram of piece lengths (at most `capacity` numbers) reaches the driver. There
a configuration linear program over that histogram is solved by multiplicative weights: each round prices a pattern of lengths by a
knapsack dynamic program over the current weights. The fractional plan is rounded to whole copies of patterns, and the plan, a list of
(length, rank range, sequence, offset) of bounded size, places the r-th piece of each length. Ranks come from counts by partition.

Defined results: null or empty text is one piece, the end id alone; a null id is kept; an empty table gives no rows; further columns
of the input are ignored; equal rows are packed as often as they occur; pieces of equal length are alike to the plan and take its places in
the order of their partitions; a text of any length is cut into pieces, with memory in proportion to it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episoda.llm import common, tokens

CAPACITY = 2048
END_ID = 0

_PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder, part = tokens.word_encoder(path), TaskContext.get().partitionId()
    end, width = np.array([END_ID], "<u4").tobytes(), 4 * capacity
    seen = np.zeros(capacity + 1, np.int64)
    for batch in common.slices(batches, "text"):
        rows: list[list] = [[] for _ in range(7)]
        for doc, text in zip(batch.column("doc_id").to_pylist(), common.texts(batch), strict=True):
            raw = encoder.encode(text) + end
            for k, at in enumerate(range(0, len(raw), width)):
                ids = raw[at : at + width]
                n = len(ids) // 4
                for column, v in zip(rows, (doc, k, at // 4, n, zlib.crc32(ids), ids if keep_ids else None, seen[n]), strict=True):
                    column.append(v)
                seen[n] += 1
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
        cols = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
        cols.insert(6, pa.array(np.full(len(rows[0]), part, np.int32)))
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "nth"])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """One row per piece of at most `capacity` ids; only documents longer than that are cut. `nth` counts equal lengths within `part`."""
    return docs.select("doc_id", "text").mapInArrow(partial(_cut, path=tokenizer, capacity=capacity, keep_ids=keep_ids), _PIECE_SCHEMA)


def price(worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best worth of each capacity, and the length last added (0: none). worth[s] is -inf where s does not occur."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        got = best[c - 1 :: -1][:c] + worth[1 : c + 1]
        j = int(got.argmax())
        if got[j] > best[c - 1]:
            best[c], last[c] = got[j], j + 1
        else:
            best[c] = best[c - 1]
    return best, last


def _pattern(last: np.ndarray, c: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while c > 0:
        s = int(last[c])
        if s == 0:
            c -= 1
        else:
            out[s] = out.get(s, 0) + 1
            c -= s
    return out


def configuration_lp(counts: np.ndarray, capacity: int, epsilon: float = 0.1, eta: float = 0.25, per_round: int = 24, rounds: int = 400) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Fractional cover of counts[length] by patterns, and a lower bound on the sequences of any packing.

    A length weighs its share of a sequence (the optimal dual wherever exact fills exist), times a factor that falls exponentially with the
    share of it already covered. One dynamic program a round prices, for each length, the best pattern that holds it; the best few that
    still are within 2 % of the best price gain as much as covers `epsilon` of their scarcest length. The rounds end when the patterns
    hold as many sequences as the bound, the best dual value met: sum(counts * weight) / price of the best pattern.
    """
    sizes = np.flatnonzero(counts)
    if not len(sizes):
        return [], 0.0
    n = counts[sizes].astype(float)
    cover, total, bound = np.zeros(len(sizes)), 0.0, float((n * sizes).sum() / capacity)
    at = np.zeros(capacity + 1, np.int64)
    at[sizes] = np.arange(len(sizes))
    chosen: dict[tuple, float] = {}
    for _ in range(rounds):
        if total >= bound:
            break
        weight = (sizes / capacity) * np.exp(-eta * (cover - cover.min()))
        worth = np.full(capacity + 1, -np.inf)
        worth[sizes] = weight
        best, last = price(worth, capacity)
        bound = max(bound, float((n * weight).sum() / best[capacity]))
        value = weight + best[capacity - sizes]
        order = np.lexsort((-sizes, cover, value < 0.98 * best[capacity]))[:per_round]
        for i in order[value[order] >= 0.98 * best[capacity]]:
            s = int(sizes[i])
            p = _pattern(last, capacity - s)
            p[s] = p.get(s, 0) + 1
            rows, uses = at[list(p)], np.array(list(p.values()), float)
            step = float((n[rows] / uses).min()) * epsilon
            cover[rows] += step * uses / n[rows]
            total += step
            key = tuple(sorted(p.items()))
            chosen[key] = chosen.get(key, 0.0) + step
    return [(dict(k), x) for k, x in chosen.items()], bound


def _fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """One sequence from what is left: the longest piece, then always the longest that still fits."""
    room, out = capacity, {}
    while room > 0:
        fits = np.flatnonzero(left[1 : room + 1])
        if not len(fits):
            break
        s = int(fits[-1]) + 1
        k = int(min(left[s] - out.get(s, 0), room // s))
        if k <= 0:
            break
        out[s] = k
        left[s] -= k
        room -= k * s
    for s, k in out.items():
        left[s] += k
    return out


def make_plan(counts: np.ndarray, capacity: int, levels: int = 3) -> list[tuple[dict[int, int], int]]:
    """Whole copies of patterns that use every piece exactly once.

    The linear program's cover is scaled to the sequences that the pieces would fill (single lengths are covered more than once), whole
    parts are taken, and the program is solved again for what is left; on the last level exact fills with a large fraction are taken once.
    The remainder is filled best-fit decreasing. A fill is repeated while its pieces last, so patterns are few however many pieces there are.
    """
    left, plan = counts.astype(np.int64).copy(), []
    mass = np.arange(capacity + 1)

    def take(p: dict[int, int], most: int) -> int:
        k = min([most, *(int(left[s]) // m for s, m in p.items())])
        if k > 0:
            for s, m in p.items():
                left[s] -= k * m
            plan.append((p, k))
        return max(k, 0)

    for level in range(levels):
        cover, _ = configuration_lp(left, capacity)
        over = max(1.0, sum(x for _, x in cover) * capacity / max(1, int((left * mass).sum())))
        cover = sorted(((p, x / over) for p, x in cover), key=lambda y: (-sum(s * m for s, m in y[0].items()), -y[1], sorted(y[0].items())))
        taken = sum(take(p, int(x)) for p, x in cover)
        if not taken or level == levels - 1:
            for p, x in sorted(cover, key=lambda y: -(y[1] % 1)):
                if x % 1 >= 0.3 and sum(s * m for s, m in p.items()) == capacity:
                    take(p, 1)
            break
    while left.any():
        p = _fill(left, capacity)
        take(p, int(left.max()))
    return plan


def place_table(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan as sorted arrays: which (length, first rank) goes to which first sequence, how many of it a sequence has, and where they start."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for p, k in plan:
        offset = 0
        for s in sorted(p, reverse=True):
            rows.append((s, used.get(s, 0), sequence, p[s], offset))
            used[s] = used.get(s, 0) + k * p[s]
            offset += s * p[s]
        sequence += k
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return {"key": (a[:, 0] << 44) | a[:, 1], "rank": a[:, 1], "sequence": a[:, 2], "each": a[:, 3], "offset": a[:, 4]}


def _place(batches: Iterator[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    t = plan.value
    for batch in batches:
        if not batch.num_rows:
            continue
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        i = np.searchsorted(t["key"], (length << 44) | rank, side="right") - 1
        k = rank - t["rank"][i]
        keep = [c for c in batch.schema.names if c != "rank"]
        cols = [batch.column(c) for c in keep] + [pa.array(t["sequence"][i] + k // t["each"][i]), pa.array(t["offset"][i] + (k % t["each"][i]) * length)]
        yield pa.RecordBatch.from_arrays(cols, [*keep, "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Pack documents(doc_id, text): doc_id, piece, start, length, ids_crc32, ids (null unless keep_ids), sequence_id, offset."""
    spark = docs.sparkSession
    cut = common.materialise(pieces(docs, tokenizer or tokens.default_path("word_bpe_49k.json"), capacity, keep_ids), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    by_part = by_part.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n"))
    by_part = common.materialise(by_part, "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for s, n in by_part.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        counts[s] = n
    full = [({capacity: 1}, int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    plan = full + make_plan(counts, capacity)
    shared = spark.sparkContext.broadcast(place_table(plan))
    # the counts grow with the input and compress well on disk, so their file size must not lead to a broadcast
    ranked = cut.join(by_part.select("part", "length", "before").hint("merge"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(partial(_place, plan=shared), "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long")
