"""Value profile: physical envelopes, alignment of states and actions, steps, by frame and by episode.

Here an infinite or NaN element makes residuals and steps infinite, which summaries then leave out; the structural profile has them null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episoda.functions import vectors
from episoda.functions.scalars import finite
from episoda.operators.sequence import frame_window
from episoda.operators.statistics import quantile, smallest_mode
from episoda.operators.structural import KEYS

FLAGS = ("shape_ok", "finite_ok", "hard_range_bad", "rotation_bad", "gripper_bad", "position_bad", "abs_max", "position_abs_max", "rotation_norm_dev", "rotation_orth_dev", "gripper_min", "gripper_max")


def _or_infinite(delta: Column, measure: Column) -> Column:
    return F.when(vectors.all_finite(delta), measure).when(delta.isNotNull(), F.lit(float("inf")))


def frames(raw: DataFrame, limits: vectors.Limits = vectors.Limits()) -> DataFrame:
    """Per-frame measures of raw(dataset, episode_index, row, state, actions)."""
    w = frame_window(KEYS)
    df = raw.select(*KEYS, "row", vectors.doubles(F.col("state")).alias("s"), vectors.doubles(F.col("actions")).alias("a"))
    df = df.withColumns({"s0": F.lag("s").over(w), "s1": F.lead("s").over(w), "a0": F.lag("a").over(w)})
    action = F.when(F.size("a") == vectors.SIZE, F.col("a"))
    delta, ds, da = (vectors.difference(F.col(x), F.col(y)) for x, y in (("a", "s"), ("s", "s0"), ("a", "a0")))
    out = df.select(
        *KEYS, "row",
        _or_infinite(delta, vectors.rmse(delta)).alias("state_action_rmse"), _or_infinite(delta, vectors.max_abs(delta)).alias("state_action_max_abs"),
        vectors.best_alignment(action, {-1: F.col("s0"), 0: F.col("s"), 1: F.col("s1")}).alias("_best"),
        _or_infinite(ds, vectors.norm(ds)).alias("state_step_l2"), _or_infinite(da, vectors.norm(da)).alias("action_step_l2"),
        vectors.physical_flags(F.col("s"), limits).alias("_s"), vectors.physical_flags(F.col("a"), limits).alias("_a"),
    )
    return out.select(
        *KEYS, "row", "state_action_rmse", "state_action_max_abs",
        F.col("_best.rmse").alias("state_action_aligned_rmse"), F.col("_best.max_abs").alias("state_action_aligned_max_abs"), F.col("_best.lag").alias("state_action_best_lag"),
        "state_step_l2", "action_step_l2",
        *[F.col(f"_s.{f}").alias(f"state_{f}") for f in FLAGS], *[F.col(f"_a.{f}").alias(f"action_{f}") for f in FLAGS],
    )


def episodes(frame_table: DataFrame) -> DataFrame:
    bad = [F.count_if(~F.col(f"{v}_finite_ok")).alias(f"{v}_finite_bad_count") for v in ("state", "action")]
    bad += [F.count_if(F.col(f"{v}_{k}_bad")).alias(f"{v}_{k}_bad_count") for k in ("hard_range", "position", "rotation", "gripper") for v in ("state", "action")]
    top = lambda c, name: F.max(finite(F.col(c))).alias(name)
    p99 = lambda c, name: quantile(F.col(c), 0.99).alias(name)
    measures = [top(f"{v}_{m}", f"{v}_{m}") for m in ("abs_max", "position_abs_max") for v in ("state", "action")]
    residuals = [
        p99("state_action_rmse", "state_action_rmse_p99"), top("state_action_rmse", "state_action_rmse_max"),
        p99("state_action_max_abs", "state_action_max_p99"), top("state_action_max_abs", "state_action_max_abs_max"),
        p99("state_action_aligned_rmse", "state_action_aligned_rmse_p99"), top("state_action_aligned_rmse", "state_action_aligned_rmse_max"),
        top("state_action_aligned_max_abs", "state_action_aligned_max_abs_max"),
        smallest_mode(F.col("state_action_best_lag")).alias("state_action_best_lag_mode"),
    ]
    steps = [f(f"{v}_step_l2", f"{v}_step_{n}") for v in ("state", "action") for f, n in ((p99, "p99"), (top, "max"))]
    return frame_table.groupBy(*KEYS).agg(F.count("*").alias("rows"), *bad, *measures, *residuals, *steps)
