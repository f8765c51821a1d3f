"""The rule catalogue: frame and episode defects as ordered lists of (code, predicate)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episoda.functions.scalars import categories, codes, finite_or
from episoda.operators.images import BRIGHT, DARK, FLAT, SIZE, STREAMS, prefix
from episoda.operators.structural import KEYS
from episoda.operators import calibrate

#: Codes by how sure their evidence is, and the ranks of those tiers.
TIERS = {
    "deterministic": (
        "C_PARQUET_CORRUPT", "C_SCHEMA_MISSING_IMAGE_COLUMN", "C_FILE_READ_ERROR", "C_IMAGE_READ_ERROR", "C_VALUE_READ_ERROR", "C_IMAGE_DECODE", "C_IMAGE_SHAPE", "C_IMAGE_DUPLICATE",
        "T_TIMESTAMP_NON_MONOTONIC", "T_FRAME_ORDER_ERROR", "T_FRAME_INDEX_DISCONTINUITY", "T_GLOBAL_INDEX_DISCONTINUITY", "T_METADATA_LENGTH_MISMATCH", "T_TIMESTAMP_UNIT_MISMATCH",
        "S_TASK_INDEX_INVALID", "S_TASK_INDEX_MISSING", "S_TASK_SWITCH_WITHIN_EPISODE", "S_EPISODE_INDEX_MISMATCH", "V_NONFINITE",
    ),
    "high": ("C_IMAGE_SCREEN", "V_PHYSICAL_RANGE", "S_IMAGE_PATH_MISMATCH", "S_MODALITY_INDEX_ALIGNMENT", "S_MODALITY_COVERAGE_GAP", "S_VISUAL_FREEZE_UNDER_MOTION"),
    "threshold": (
        "T_TIMESTAMP_JITTER", "T_TIMESTAMP_JITTER_OR_DRIFT", "T_TIMESTAMP_GAP", "T_DROPPED_OR_GAPPED_FRAMES", "C_IMAGE_BLUR", "V_STATE_ACTION_MISMATCH", "V_SPIKE_JUMP",
        "V_STATE_FREEZE", "V_ACTION_FREEZE", "V_LOW_INFORMATION_TRAJECTORY",
    ),
}
RANKS = {"deterministic": 3, "high": 2, "threshold": 1}


def image_quality(frames: DataFrame, stream_thresholds: DataFrame, size: tuple[int, int, int] = SIZE) -> DataFrame:
    """Flags of each (frame, stream) row. A missing path counts as a mismatch here; shape, screen, blur and duplicate need a decoded image."""
    f = frames.join(F.broadcast(stream_thresholds), "stream", "left")  # one row per camera stream
    ok = F.col("decode_ok")
    sure = lambda c: F.coalesce(c, F.lit(False))
    low = lambda m, t, k=1.0: F.col(m) < k * F.col(t)
    w, h, c = size
    blur = (low("laplacian_var", "lap_min") & low("gradient_energy", "grad_min")) | low("laplacian_var", "lap_min", 0.25) | low("byte_size", "byte_min", 0.2)
    flags = {
        "path_mismatch": (F.trim(F.coalesce("path", F.lit(""))) == "") | (F.coalesce("path_delta", F.lit(0)) != 0),
        "payload_missing": ~F.col("payload_present"),
        "decode_bad": ~ok,
        "decode_corrupt": F.col("payload_present") & ~ok,
        "shape_bad": ok & F.coalesce((F.col("width") != w) | (F.col("height") != h) | (F.col("channels") != c), F.lit(True)),
        "screen_bad": ok & sure((F.col("dark_fraction") >= DARK) | (F.col("bright_fraction") >= BRIGHT) | (F.col("std_luma") <= FLAT)),
        "duplicate_bad": ok & F.col("adjacent_exact_duplicate"),
        "blur_bad": ok & sure(blur),
    }
    f = f.withColumns(flags)
    return f.withColumn("image_problem", F.col("payload_missing") | F.col("decode_corrupt") | F.col("shape_bad") | F.col("screen_bad") | F.col("blur_bad") | F.col("duplicate_bad") | F.col("path_mismatch"))


IMAGE_FLAGS = ("decode_bad", "payload_missing", "decode_corrupt", "shape_bad", "screen_bad", "blur_bad", "duplicate_bad", "path_mismatch")


def image_counts(flagged: DataFrame) -> DataFrame:
    """Streams with each flag, per frame."""
    return flagged.groupBy(*KEYS, "row").agg(*[F.count_if(f).alias(f"image_{f}") for f in IMAGE_FLAGS], F.count_if("image_problem").alias("image_problem_streams"))


def frame_rules(t, valid_tasks: tuple[int, ...] = (0, 1)) -> list[tuple[str, Column]]:
    """Rules over a frame row; t(name) is a threshold column. Gap, non-monotonic and jitter exclude each other."""
    dt, sure = F.col("dt"), lambda c: F.coalesce(c, F.lit(False))
    irregular = (dt <= 0) | (dt > t("timestamp_gap"))
    out_of_range = F.lit(False)
    for v in ("state", "action"):
        for k in ("hard_range", "position", "rotation", "gripper"):
            out_of_range = out_of_range | sure(F.col(f"{v}_{k}_bad"))
    residual = lambda a, b: finite_or(F.col(a), finite_or(F.col(b), 0.0))
    return [
        ("T_TIMESTAMP_NON_MONOTONIC", dt <= 0),
        ("T_TIMESTAMP_GAP", dt > t("timestamp_gap")),
        ("T_TIMESTAMP_JITTER", ~irregular & (F.abs(dt - t("nominal_dt")) > t("timestamp_jitter_abs"))),
        ("T_FRAME_INDEX_DISCONTINUITY", F.col("frame_diff") != 1),
        ("T_GLOBAL_INDEX_DISCONTINUITY", F.col("global_index_diff") != 1),
        ("S_TASK_INDEX_INVALID", ~F.col("task_index").isin(*valid_tasks)),
        ("S_IMAGE_PATH_MISMATCH", F.col("image_path_mismatch") > 0),
        ("S_MODALITY_COVERAGE_GAP", F.col("image_payload_missing") > 0),
        ("C_IMAGE_DECODE", F.col("image_decode_corrupt") > 0),
        ("C_IMAGE_SHAPE", F.col("image_shape_bad") > 0),
        ("C_IMAGE_SCREEN", F.col("image_screen_bad") > 0),
        ("C_IMAGE_BLUR", F.col("image_blur_bad") > 0),
        ("C_IMAGE_DUPLICATE", F.col("image_duplicate_bad") > 0),
        ("V_NONFINITE", ~F.coalesce("state_finite_ok", F.lit(True)) | ~F.coalesce("action_finite_ok", F.lit(True))),
        ("V_PHYSICAL_RANGE", out_of_range),
        ("V_STATE_ACTION_MISMATCH", (residual("state_action_aligned_rmse", "state_action_rmse") > t("state_action_rmse")) | (residual("state_action_aligned_max_abs", "state_action_max_abs") > t("state_action_max_abs"))),
        ("V_SPIKE_JUMP", (finite_or(F.col("state_step_l2"), 0.0) > t("state_step_l2")) | (finite_or(F.col("action_step_l2"), 0.0) > t("action_step_l2"))),
    ]


def frame_flags(structural: DataFrame, value_frames: DataFrame, flagged_images: DataFrame, thresholds: DataFrame, valid_tasks: tuple[int, ...] = (0, 1)) -> DataFrame:
    """dataset, episode_index, row, timestamp, frame_index, issue_codes, issue_categories, image_problem_streams.

    Steps and raw residuals are the structural ones (null where not finite); flags and aligned residuals are the value profile's.
    """
    same = ("state_action_rmse", "state_action_max_abs", "state_step_l2", "action_step_l2")
    counts = image_counts(flagged_images)
    merged = structural.join(value_frames.drop(*same), [*KEYS, "row"], "left").join(counts, [*KEYS, "row"], "left")
    merged = merged.fillna(0, [c for c in counts.columns if c.startswith("image_")])
    limits = thresholds.select(F.struct("*").alias("t"))
    merged = merged.crossJoin(F.broadcast(limits))  # one row
    found = codes(*frame_rules(lambda n: F.col(f"t.{n}"), valid_tasks))
    return merged.select(*KEYS, "row", "timestamp", "frame_index", found.alias("issue_codes"), "image_problem_streams").withColumn("issue_categories", categories(F.col("issue_codes")))


def frame_evidence(flags: DataFrame) -> DataFrame:
    """Per episode: frames with each category of code, and which codes occur at all."""
    any_code = lambda p: F.exists("issue_codes", lambda c: c.startswith(p))
    seen = lambda c: F.array_contains("issue_codes", c)
    return flags.groupBy(*KEYS).agg(
        *[F.count_if(any_code(p)).alias(f"{n}_frames") for p, n in (("T_", "temporal"), ("S_", "sync"), ("C_", "content"), ("V_", "value"))],
        *[F.bool_or(seen(c)).alias(f"seen_{c}") for c in ("C_IMAGE_BLUR", "C_IMAGE_SHAPE", "V_STATE_ACTION_MISMATCH", "V_SPIKE_JUMP")],
    )


def unit_mismatch() -> Column:
    """Contiguous, increasing time stamps whose median step is within 5 % of 10, 100 or 1000 nominal ones."""
    ratio = F.coalesce("dt_median", F.lit(calibrate.CONSTANTS["nominal_dt"])) / calibrate.CONSTANTS["nominal_dt"]
    near = F.lit(False)
    for scale in (10.0, 100.0, 1000.0):
        near = near | (F.abs(ratio - scale) / scale < 0.05)
    count = lambda c: F.coalesce(c, F.lit(0))
    return (count("frame_nonunit_diff_count") == 0) & (count("dt_nonpositive_count") == 0) & near


def episode_rules(t, valid_tasks: tuple[int, ...] = (0, 1)) -> list[tuple[str, Column]]:
    """Rules over the joined episode row (structural, image, value, frame evidence, read state); t(name) is a threshold column."""
    n = lambda c, d=0.0: finite_or(F.col(c).cast("double"), d)
    yes = lambda c, d=False: F.coalesce(c, F.lit(d))
    k = calibrate.CONSTANTS
    unit, values_read = F.col("_unit"), F.col("value_read_ok")
    drift = (n("dt_abs_err_gt_2ms_count") > 0) | (F.abs(n("dt_median", k["nominal_dt"]) - k["nominal_dt"]) > k["timestamp_median_tolerance"]) | (n("dt_mad") > k["timestamp_mad_tolerance"])
    mismatches = [n(f"{prefix(s)}_path_mismatch_count") > 0 for s in STREAMS]
    blur = F.lit(False)
    for s in map(prefix, STREAMS):
        lap, grad, size = (F.col(f"{s}_{m}_median") for m in ("laplacian_var", "gradient_energy", "byte_size"))
        blur = blur | yes((lap < 0.8 * t(f"{s}_lap_min")) & (grad < 0.95 * t(f"{s}_grad_min"))) | yes(lap < 0.3 * t(f"{s}_lap_min")) | yes(size < 0.2 * t(f"{s}_byte_min"))
    physical, numeric = F.col("physical_bad"), F.col("numeric_bad")
    aligned = lambda a, b: finite_or(F.col(a), n(b))
    mismatch = (aligned("state_action_aligned_rmse_p99", "v_state_action_rmse_p99") > t("state_action_rmse")) | (aligned("state_action_aligned_rmse_max", "state_action_rmse_max") > t("state_action_rmse")) | (aligned("state_action_aligned_max_abs_max", "state_action_max_abs_max") > t("state_action_max_abs"))
    spike = F.lit(False)
    for v in ("state", "action"):
        for m in ("p99", "max"):
            spike = spike | (n(f"v_{v}_step_{m}") > t(f"{v}_step_l2"))
    still_state, still_action = n("state_path_length") < k["low_motion_state_path"], n("action_path_length") < k["low_motion_action_path"]
    corrupt = lambda part: ~F.col(f"{part}_read_ok") & (F.col(f"{part}_defect") == "corrupt")
    return [
        ("C_PARQUET_CORRUPT", corrupt("structural") | corrupt("image")),
        ("C_FILE_READ_ERROR", ~F.col("structural_read_ok") & ~corrupt("structural")),
        ("C_SCHEMA_MISSING_IMAGE_COLUMN", ~F.col("image_read_ok") & (F.col("image_defect") == "missing_column")),
        ("C_IMAGE_READ_ERROR", ~F.col("image_read_ok") & ~F.col("image_defect").isin("missing_column", "corrupt")),
        ("C_VALUE_READ_ERROR", ~values_read & F.col("structural_read_ok")),
        ("T_METADATA_LENGTH_MISMATCH", F.abs(n("length_delta")) > 0),
        ("T_TIMESTAMP_UNIT_MISMATCH", unit),
        ("T_TIMESTAMP_NON_MONOTONIC", n("dt_nonpositive_count") > 0),
        ("T_DROPPED_OR_GAPPED_FRAMES", ((n("dt_gap_gt_1_5x_count") > 0) & ~unit) | (n("frame_nonunit_diff_count") > 0)),
        ("T_TIMESTAMP_JITTER_OR_DRIFT", ~unit & drift),
        ("T_FRAME_ORDER_ERROR", (n("frame_nonpositive_diff_count") > 0) | (n("frame_nonunit_diff_count") > 0)),
        ("T_GLOBAL_INDEX_DISCONTINUITY", n("index_nonunit_diff_count") > 0),
        ("S_EPISODE_INDEX_MISMATCH", n("episode_index_mismatch_count") > 0),
        ("S_TASK_INDEX_MISSING", n("task_nonfinite_count") > 0),
        ("S_TASK_SWITCH_WITHIN_EPISODE", n("task_unique_count", 1.0) > 1),
        ("S_TASK_INDEX_INVALID", ~n("task_index_first").isin(*[float(x) for x in valid_tasks])),
        ("S_IMAGE_PATH_MISMATCH", mismatches[0] | mismatches[1] | mismatches[2]),
        ("S_MODALITY_INDEX_ALIGNMENT", n("any_path_mismatch_count") > 0),
        ("S_MODALITY_COVERAGE_GAP", n("any_missing_count") > 0),
        ("C_IMAGE_DECODE", n("any_decode_corrupt_count") > 0),
        ("C_IMAGE_SHAPE", (n("any_shape_bad_count") > 0)),
        ("C_IMAGE_SCREEN", (n("any_dark_frame_count") > 0) | (n("any_bright_frame_count") > 0) | (n("any_low_contrast_count") > 0)),
        ("C_IMAGE_BLUR", blur | yes("seen_C_IMAGE_BLUR")),
        ("C_IMAGE_DUPLICATE", n("any_exact_duplicate_adjacent_count") > 0),
        ("C_IMAGE_SHAPE", yes("seen_C_IMAGE_SHAPE")),
        ("V_NONFINITE", values_read & (numeric > 0)),
        ("V_PHYSICAL_RANGE", values_read & (physical > 0)),
        ("V_STATE_ACTION_MISMATCH", values_read & (mismatch | yes("seen_V_STATE_ACTION_MISMATCH"))),
        ("V_SPIKE_JUMP", values_read & (spike | yes("seen_V_SPIKE_JUMP"))),
        ("V_STATE_FREEZE", values_read & still_state & ~still_action),
        ("V_ACTION_FREEZE", values_read & ~still_state & still_action),
        ("V_LOW_INFORMATION_TRAJECTORY", values_read & still_state & still_action),
    ]


def tier_rank(code: Column) -> Column:
    """Rank of a code's confidence tier; codes that no tier names rest on thresholds."""
    out = F.lit(RANKS["threshold"])
    for tier in ("high", "deterministic"):
        out = F.when(code.isin(*TIERS[tier]), F.lit(RANKS[tier])).otherwise(out)
    return out


def confidence(code_list: Column) -> Column:
    """The surest tier among the codes; empty for none."""
    top = F.array_max(F.transform(code_list, tier_rank))
    out = F.lit("")
    for tier, rank in RANKS.items():
        out = F.when(top == rank, F.lit(tier)).otherwise(out)
    return out
