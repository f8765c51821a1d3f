"""Live monitoring of frames as they arrive: an extension beside the batch engine, with thresholds from its calibration.

Windowed counts use watermarks; the state of the gap monitor is the last frame of each open episode, dropped when the episode goes quiet.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(frames: DataFrame, time: str, keys: list[str], late: str = "10 minutes", window: str = "5 minutes", **counts: F.Column) -> DataFrame:
    """Frames, and frames for which each condition holds, per key and tumbling window; data later than `late` is dropped."""
    return frames.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("frames"), *[F.count_if(c).alias(n) for n, c in counts.items()]).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "frames", *counts)


def sessions(frames: DataFrame, time: str, keys: list[str], gap: str = "30 seconds", late: str = "10 minutes") -> DataFrame:
    """Recording sessions: frames of a key without a pause longer than `gap`."""
    w = F.session_window(time, gap)
    return frames.withWatermark(time, late).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("frames")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "frames")


GAPS = "key string, at timestamp, previous timestamp, dt double, code string"


def gaps(frames: DataFrame, key: str, time: str, nominal: float, factor: float = 1.5, quiet: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """An alert for every frame that comes more than factor * nominal seconds after its predecessor, or not after it at all.

    Within a batch, frames of a key are put in time order; across batches the last frame is remembered.
    """
    quiet_ms = int(pd.Timedelta(quiet).total_seconds() * 1000)

    def update(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = pd.Timestamp(state.get[0]) if state.exists else None
        times = pd.concat(list(batches))["at"].sort_values()
        rows = []
        for t in times:
            if last is not None:
                dt = (t - last).total_seconds()
                if dt <= 0 or dt > factor * nominal:
                    rows.append((k[0], t, last, dt, "T_TIMESTAMP_NON_MONOTONIC" if dt <= 0 else "T_TIMESTAMP_GAP"))
            last = t if last is None or t > last else last
        state.update((last.to_pydatetime(),))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(last.timestamp() * 1000)) + quiet_ms)
        if rows:
            yield pd.DataFrame(rows, columns=["key", "at", "previous", "dt", "code"])

    stream = frames.select(F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias("at")).withWatermark("at", late)
    return stream.groupBy("key").applyInPandasWithState(update, GAPS, "last timestamp", "append", "EventTimeTimeout")
