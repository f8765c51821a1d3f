"""Thresholds calibrated on clean reference episodes: quantile times margin, with a floor. One row, or one row per stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episoda.operators.images import STREAMS, prefix
from episoda.operators.statistics import quantile

#: Constants of the rules.
CONSTANTS = {
    "nominal_dt": 0.1, "timestamp_gap": 0.15, "timestamp_jitter_abs": 0.01, "timestamp_median_tolerance": 0.002, "timestamp_mad_tolerance": 0.001,
    "low_motion_state_path": 0.50, "low_motion_action_path": 1.00, "bad_ratio_sparse": 0.10,
}
#: Fixed values: (value column, threshold, floor, margin) over reference frames at quantile 0.999.
UPPER = (
    ("state_action_aligned_rmse", "state_action_rmse", 0.15, 1.25),
    ("state_action_aligned_max_abs", "state_action_max_abs", 0.40, 1.25),
    ("state_step_l2", "state_step_l2", 0.50, 1.5),
    ("action_step_l2", "action_step_l2", 0.50, 1.5),
)
#: Fixed values: (image measure, threshold, margin on episode medians at quantile 0.10, margin on frames at quantile 0.002).
LOWER = (("laplacian_var", "lap", 0.65, 0.50), ("gradient_energy", "grad", 0.75, 0.65), ("byte_size", "byte", 0.75, 0.50))


def with_floor(value, floor: float, margin: float):
    return F.greatest(F.lit(floor), F.coalesce(value * margin, F.lit(floor)))


def thresholds(ref_value_frames: DataFrame, ref_image_episodes: DataFrame, ref_image_frames: DataFrame) -> DataFrame:
    """One row with every threshold. The inputs hold reference episodes only."""
    upper = ref_value_frames.agg(*[with_floor(quantile(F.col(c), 0.999), floor, margin).alias(t) for c, t, floor, margin in UPPER])
    wide = ref_image_episodes.agg(*[F.coalesce(quantile(F.col(f"{prefix(s)}_{m}_median"), 0.10) * margin, F.lit(0.0)).alias(f"{prefix(s)}_{t}_min") for s in STREAMS for m, t, margin, _ in LOWER])
    frame_low = ref_image_frames.groupBy().agg(*[(quantile(F.when(F.col("stream") == s, F.col(m).cast("double")), 0.002) * margin).alias(f"_{prefix(s)}_{t}") for s in STREAMS for m, t, _, margin in LOWER])
    row = upper.crossJoin(F.broadcast(wide)).crossJoin(F.broadcast(frame_low))  # one row each
    row = row.withColumns({f"{prefix(s)}_{t}_frame_min": F.coalesce(f"_{prefix(s)}_{t}", f"{prefix(s)}_{t}_min") for s in STREAMS for _, t, _, _ in LOWER})
    row = row.drop(*[f"_{prefix(s)}_{t}" for s in STREAMS for _, t, _, _ in LOWER])
    return row.withColumns({k: F.lit(v) for k, v in CONSTANTS.items()})


def by_stream(row: DataFrame) -> DataFrame:
    """The frame thresholds as one row per stream: stream, lap_min, grad_min, byte_min."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stream"), *[F.col(f"{prefix(s)}_{t}_frame_min").alias(f"{t}_min") for _, t, _, _ in LOWER]) for s in STREAMS])).alias("x")).select("x.*")
