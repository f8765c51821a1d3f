"""Clean synthetic episodes and one injected fault for each: golden labels for the detector."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episoda.functions import png
from episoda.operators.images import STREAMS

SCHEMA = (
    "dataset string, episode_index bigint, row bigint, episode_index_value bigint, timestamp float, frame_index bigint, index bigint, task_index bigint, state array<float>, actions array<float>, "
    + ", ".join(f"{s} struct<bytes:binary,path:string>" for s in STREAMS)
)


def _image(seed: int, step: int, size: int) -> np.ndarray:
    rng = np.random.default_rng(seed * 100_003 + step)
    y, x = np.mgrid[:size, :size]
    base = 110 + 60 * np.sin((x + 2 * step) / 5.0) + 30 * np.cos((y + seed) / 4.0)
    return np.clip(base[:, :, None] + rng.normal(0, 14, (size, size, 3)) + np.array([8, 0, -8]), 0, 255).astype(np.uint8)


def clean(episode: int, n: int, size: int) -> dict[str, list]:
    t = np.arange(n)
    phase = episode * 0.37 + np.arange(6) * 0.9
    vectors = np.zeros((n + 1, 20), np.float32)
    ahead = 0.45 * np.sin(np.arange(n + 1)[:, None] * 0.12 + phase)
    vectors[:, [0, 1, 2, 10, 11, 12]] = ahead
    for at in (3, 13):
        vectors[:, at], vectors[:, at + 4] = 1.0, 1.0
    vectors[:, [9, 19]] = 0.5
    pictures = {s: [{"bytes": png.encode(_image(episode * 3 + k, i, size), 1), "path": f"frame_{i:06d}.png"} for i in range(n)] for k, s in enumerate(STREAMS)}
    return {
        "timestamp": (t * 0.1).astype(np.float32), "frame_index": t.copy(), "index": t + episode * 1000, "task_index": np.full(n, episode % 2), "episode_index_value": np.full(n, episode),
        "state": list(vectors[:n]), "actions": list(vectors[1:]), **pictures,
    }


@dataclass(frozen=True)
class Fault:
    """One way to damage an episode. `change(e, rows, size)` damages the given rows in place; `seen` says where a frame-wise check can see it:
    in the changed rows themselves, or in every row whose step from the row before changed. None: only the episode as a whole shows it."""

    name: str
    category: str
    reach: int  # rows from the site on; 0: to the end; -1: the whole episode
    seen: str | None
    change: Callable[[dict, range, int], None]


def _clock(shift: Callable[[np.ndarray, range, float], np.ndarray]):
    def change(e: dict, rows: range, size: int) -> None:
        t = e["timestamp"].astype(np.float64)
        t[rows.start : rows.stop] = shift(t, rows, float(np.median(np.diff(t))))
        e["timestamp"][:] = t

    return change


def _column(name: str, value: Callable[[np.ndarray], np.ndarray]):
    def change(e: dict, rows: range, size: int) -> None:
        own = slice(rows.start, rows.stop)
        e[name][own] = value(e[name][own])

    return change


def _vector(name: str, places: list[int], value: Callable[[np.ndarray], np.ndarray]):
    def change(e: dict, rows: range, size: int) -> None:
        for i in rows:
            e[name][i] = e[name][i].copy()
            e[name][i][places] = value(e[name][i][places])

    return change


def _picture(streams: tuple[str, ...], part: str, value: Callable[[dict, int], object]):
    """value(e's list of pictures, row) is the new bytes or path."""

    def change(e: dict, rows: range, size: int) -> None:
        for s in streams:
            new = [value(e[s], i) for i in rows]
            for i, x in zip(rows, new, strict=True):
                e[s][i] = {**e[s][i], **x} if part == "both" else {**e[s][i], part: x}

    return change


def _flat(level: int):
    return lambda pictures, i: png.encode(np.full_like(png.decode(pictures[i]["bytes"]), level))


#: The catalogue. Names and categories are fixed values, which reports use; sizes of the damage are this module's own.
FAULTS: tuple[Fault, ...] = (
    Fault("timestamp_jitter", "temporal", 1, "step", _clock(lambda t, r, step: t[r.start : r.stop] + 0.4 * step)),
    Fault("timestamp_rollback", "temporal", 1, "step", _clock(lambda t, r, step: t[r.start : r.stop] - 1.7 * step)),
    Fault("timestamp_rate_drift", "temporal", -1, "step", _clock(lambda t, r, step: t[0] + 1.25 * (t - t[0]))),
    Fault("timestamp_duplicate", "temporal", 1, "step", _clock(lambda t, r, step: t[r.start - 1 : r.stop - 1])),
    Fault("timestamp_gap", "temporal", 0, "step", _clock(lambda t, r, step: t[r.start :] + 3.5 * step)),
    Fault("task_index_invalid", "synchronisation", 1, "row", _column("task_index", lambda v: v + 7)),
    Fault("task_switch", "synchronisation", 0, None, _column("task_index", lambda v: (v + 1) % 2)),
    Fault("single_path_mismatch", "synchronisation", 1, "row", _picture(STREAMS[:1], "path", lambda p, i: f"frame_{len(p) + i:06d}.png")),
    Fault("stream_path_offset", "synchronisation", -1, "row", _picture(STREAMS[1:2], "path", lambda p, i: f"frame_{i + 2:06d}.png")),
    Fault("episode_index_mismatch", "synchronisation", 1, None, _column("episode_index_value", lambda v: v + 40)),
    Fault("black_frames", "content", 4, "row", _picture(STREAMS, "bytes", _flat(0))),
    Fault("bright_frames", "content", 4, "row", _picture(STREAMS, "bytes", _flat(252))),
    Fault("image_shape", "content", 1, "row", _picture(STREAMS[:1], "bytes", lambda p, i: png.encode(np.ascontiguousarray(png.decode(p[i]["bytes"])[:, 4:])))),
    Fault("exact_duplicate", "content", 1, "row", _picture(STREAMS, "both", lambda p, i: p[i - 1])),
    Fault("corrupt_payload", "content", 1, "row", _picture(STREAMS[:1], "bytes", lambda p, i: p[i]["bytes"][: len(p[i]["bytes"]) // 2])),
    Fault("state_nan", "value", 1, "row", _vector("state", [11], lambda v: v * np.nan)),
    Fault("position_spike", "value", 1, "step", _vector("state", [12], lambda v: v * 0 + 2.4)),
    Fault("rotation_invalid", "value", 1, "step", _vector("state", list(range(13, 19)), lambda v: v * 0)),
    Fault("gripper_out_of_range", "value", 1, "step", _vector("actions", [19], lambda v: v + 0.9)),
    Fault("action_jump", "value", 1, "step", _vector("actions", [10], lambda v: v + np.where(v < 0, 0.85, -0.85))),
)


def site(n: int, fault: int) -> int:
    """Where the damage begins: in the third quarter of an episode, other faults at other rows."""
    return n // 2 + 5 * fault % max(1, n // 4)


def inject(e: dict[str, list], fault: int, size: int) -> list[int]:
    """Change one episode in place; the rows in which a frame-wise check can see it."""
    own, n = FAULTS[fault], len(e["timestamp"])
    at = site(n, fault)
    rows = range(n) if own.reach < 0 else range(at, n if own.reach == 0 else min(n, at + own.reach))
    before = {c: v.copy() for c, v in e.items()}
    own.change(e, rows, size)
    return [i for i in range(n) if _changed(before, e, i, own.seen == "step")]


def _changed(before: dict[str, list], after: dict[str, list], i: int, by_step: bool) -> bool:
    """Whether row i (or, of numbers, its step from the row before) is another than it was."""
    for c, was in before.items():
        now = after[c]
        if isinstance(now[i], dict):
            if now[i] != was[i]:
                return True
        elif by_step:
            if i and not np.allclose(np.subtract(now[i], now[i - 1]), np.subtract(was[i], was[i - 1]), atol=1e-4):
                return True
        elif not np.array_equal(now[i], was[i]):
            return True
    return False


def frames(spark: SparkSession, episodes: int = 20, n: int = 60, size: int = 32, faulty: bool = True, base: int = 1000) -> DataFrame:
    """`episodes` clean reference episodes and, as dataset `test`, their copies with fault i in episode base + i, made on the executors."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in b["id"]:
                i = int(i)
                source, is_test = i % episodes, i >= episodes
                e = clean(source, n, size)
                own = base + source if is_test else source
                if is_test:
                    e["episode_index_value"] = np.full(n, own)
                    inject(e, source % len(FAULTS), size)
                yield pd.DataFrame({"dataset": "test" if is_test else "reference", "episode_index": own, "row": np.arange(n), **e})[[x.split()[0] for x in SCHEMA.split(", ")]]

    total = episodes * (2 if faulty else 1)
    return spark.range(0, total, 1, min(total, 16)).mapInPandas(make, SCHEMA)


def labels(spark: SparkSession, episodes: int = 20, n: int = 60, base: int = 1000) -> DataFrame:
    """dataset, episode_index, fault, categories, rows, frame_evaluable of the injected faults; rows are those that differ from the clean episode."""
    rows = [("test", base + i, f.name, [f.category], inject(clean(i, n, 16), i, 16), f.seen is not None) for i, f in enumerate(FAULTS[:episodes])]
    return spark.createDataFrame(rows, "dataset string, episode_index bigint, fault string, categories array<string>, rows array<bigint>, frame_evaluable boolean")


def file_table(raw: DataFrame) -> DataFrame:
    """The inventory of frames that come from no file: every episode sound."""
    return raw.groupBy("dataset", "episode_index").agg(F.count("*").alias("footer_rows")).select("dataset", "episode_index", F.format_string("synthetic/episode_%06d.parquet", "episode_index").alias("source_file"), F.lit(None).cast("bigint").alias("length"), "footer_rows", F.lit(None).cast("string").alias("defect"))


def metadata(raw: DataFrame) -> DataFrame:
    """dataset, episode_index, length, tasks as the recorder would have written them."""
    g = raw.groupBy("dataset", "episode_index").agg(F.count("*").alias("length"), F.min_by("task_index", "row").alias("t"))
    return g.select("dataset", "episode_index", "length", F.array(F.concat(F.lit("task "), F.col("t").cast("string"))).alias("tasks"))
