"""Structural profile: time stamps, indexes, tasks and vector continuity, by frame and by episode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episoda.functions import vectors
from episoda.functions.scalars import finite, number
from episoda.operators.sequence import frame_window
from episoda.operators.statistics import quantile, robust

KEYS = ["dataset", "episode_index"]
NOMINAL_DT = 0.1
MOTION = 1e-4


def frames(raw: DataFrame) -> DataFrame:
    """Per-frame measures of raw(dataset, episode_index, row, timestamp, frame_index, episode_index_value, index, task_index, state, actions).

    `row` is the physical place in the file. Every lag shares one window; null stands for what cannot be computed.
    """
    w = frame_window(KEYS)
    num = lambda c: finite(number(F.col(c)))
    step = lambda v: vectors.norm(vectors.difference(F.col(v), F.lag(v).over(w)))
    df = raw.select(
        *KEYS, "row",
        num("timestamp").alias("timestamp"), num("frame_index").alias("frame_index"), num("index").alias("global_index"),
        num("episode_index_value").alias("episode_index_value"), num("task_index").alias("task_index"),
        vectors.doubles(F.col("state")).alias("state"), vectors.doubles(F.col("actions")).alias("actions"),
    )
    delta = vectors.difference(F.col("actions"), F.col("state"))
    diff = lambda c: F.col(c) - F.lag(c).over(w)
    return df.withColumns(
        {
            "dt": diff("timestamp"),
            "frame_diff": diff("frame_index"),
            "global_index_diff": diff("global_index"),
            "shape_ok": F.coalesce((F.size("state") == vectors.SIZE) & (F.size("actions") == vectors.SIZE), F.lit(False)),
            "finite_ok": vectors.all_finite(F.col("state")) & vectors.all_finite(F.col("actions")),
            "state_norm": finite(vectors.norm(F.col("state"))),
            "action_norm": finite(vectors.norm(F.col("actions"))),
            "state_action_rmse": finite(vectors.rmse(delta)),
            "state_action_max_abs": finite(vectors.max_abs(delta)),
            "state_step_l2": finite(step("state")),
            "action_step_l2": finite(step("actions")),
        }
    ).withColumns(
        {
            "state_abs_max": vectors.max_abs(vectors.finite_parts(F.col("state"))),
            "action_abs_max": vectors.max_abs(vectors.finite_parts(F.col("actions"))),
        }
    ).drop("state", "actions")


def _moving(step: str) -> Column:
    return F.coalesce(F.avg(F.when(F.col("row") > 0, F.when(F.col(step) > MOTION, 1.0).otherwise(0.0))), F.lit(0.0))


def episodes(frame_table: DataFrame, meta: DataFrame | None, nominal_dt: float = NOMINAL_DT) -> DataFrame:
    """One row per episode; meta(dataset, episode_index, length) supplies the expected rows."""
    dt, later = F.col("dt"), F.col("row") > 0
    unit = lambda d: F.count_if(F.col(d) != 1)
    missing = lambda c: F.count_if(F.col(c).isNull())
    at_first = lambda c: F.min_by(c, "row")
    at_last = lambda c: F.max_by(c, "row")
    main = frame_table.groupBy(*KEYS).agg(
        F.count("*").alias("rows"),
        at_first("timestamp").alias("timestamp_first"), at_last("timestamp").alias("timestamp_last"), (at_last("timestamp") - at_first("timestamp")).alias("timestamp_span"),
        F.min("dt").alias("dt_min"), F.max("dt").alias("dt_max"),
        F.count_if(later & dt.isNull()).alias("dt_nonfinite_count"), F.count_if(dt <= 0).alias("dt_nonpositive_count"),
        F.count_if(dt > 1.5 * nominal_dt).alias("dt_gap_gt_1_5x_count"),
        F.count_if(F.abs(dt - nominal_dt) > 0.002).alias("dt_abs_err_gt_2ms_count"), F.count_if(F.abs(dt - nominal_dt) > 0.01).alias("dt_abs_err_gt_10ms_count"),
        at_first("frame_index").alias("frame_start"), at_last("frame_index").alias("frame_end"), missing("frame_index").alias("frame_nonfinite_count"),
        unit("frame_diff").alias("frame_nonunit_diff_count"), F.count_if(F.col("frame_diff") <= 0).alias("frame_nonpositive_diff_count"),
        missing("global_index").alias("index_nonfinite_count"), unit("global_index_diff").alias("index_nonunit_diff_count"),
        F.count_if(F.col("episode_index_value") != F.col("episode_index")).alias("episode_index_mismatch_count"),
        F.count_distinct("task_index").alias("task_unique_count"), missing("task_index").alias("task_nonfinite_count"),
        F.count_if(~F.col("shape_ok")).alias("shape_bad_count"), F.count_if(~F.col("finite_ok")).alias("finite_bad_count"),
        F.max("state_abs_max").alias("state_abs_max"), F.max("action_abs_max").alias("action_abs_max"),
        quantile(F.col("state_action_rmse"), 0.5).alias("state_action_rmse_median"), quantile(F.col("state_action_rmse"), 0.99).alias("state_action_rmse_p99"),
        quantile(F.col("state_action_max_abs"), 0.99).alias("state_action_max_p99"),
        quantile(F.col("state_step_l2"), 0.99).alias("state_step_p99"), quantile(F.col("action_step_l2"), 0.99).alias("action_step_p99"),
        F.sum(F.coalesce("state_step_l2", F.lit(0.0))).alias("state_path_length"), F.sum(F.coalesce("action_step_l2", F.lit(0.0))).alias("action_path_length"),
        _moving("state_step_l2").alias("state_motion_fraction"), _moving("action_step_l2").alias("action_motion_fraction"),
        at_first("task_index").alias("task_index_first"), at_last("task_index").alias("task_index_last"),
    )
    spread = robust(frame_table, KEYS, "dt", "dt").drop("dt_n")
    out = main.join(spread, KEYS)
    if meta is None:
        return out.withColumns({"expected_rows": F.lit(None).cast("bigint"), "length_delta": F.lit(None).cast("bigint")})
    expected = meta.select(*KEYS, F.col("length").cast("bigint").alias("expected_rows"))
    return out.join(expected, KEYS, "left").withColumn("length_delta", F.col("rows") - F.col("expected_rows"))
