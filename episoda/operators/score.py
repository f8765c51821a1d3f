"""Episode report: issue codes, five dimension scores with hard gates, severity and repair mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episoda.functions.scalars import categories, codes, finite_or, has, safe_ratio
from episoda.operators import calibrate, rules
from episoda.operators.structural import KEYS

#: Weights of the dimensions, and the score that a report with an unreadable modality cannot exceed.
WEIGHTS = {"structural": 0.25, "temporal": 0.20, "sync": 0.20, "content": 0.20, "value": 0.15}
GATE = 25.0


def score(penalty: Column, factor: float = 1.0) -> Column:
    return 100.0 * F.greatest(F.lit(0.0), 1.0 - F.least(F.lit(1.0), penalty * factor))


def overall(weights: dict[str, float] = WEIGHTS) -> Column:
    out = F.lit(0.0)
    for k, w in weights.items():
        out = out + w * F.col(f"{k}_score")
    return out


def severity(code_list: Column, total: Column, readable: Column | None = None) -> Column:
    broken = F.lit(False) if readable is None else ~readable
    return F.when(F.size(code_list) == 0, "pass").when(broken | (total < 40), "severe").when(total < 65, "high").when(total < 85, "medium").otherwise("low")


#: Codes by what can be done about them.
RETIME = ("T_TIMESTAMP_JITTER_OR_DRIFT", "T_TIMESTAMP_UNIT_MISMATCH")
UNTIMED = ("T_DROPPED_OR_GAPPED_FRAMES", "T_TIMESTAMP_NON_MONOTONIC")
TASKS = ("S_TASK_INDEX_INVALID", "S_TASK_SWITCH_WITHIN_EPISODE")
PATHS = ("S_IMAGE_PATH_MISMATCH", "S_MODALITY_INDEX_ALIGNMENT")
SPARSE_VALUES = ("V_NONFINITE", "V_PHYSICAL_RANGE", "V_STATE_ACTION_MISMATCH", "V_SPIKE_JUMP")
SPARSE_IMAGES = ("C_IMAGE_DECODE", "C_IMAGE_SCREEN", "C_IMAGE_BLUR", "C_IMAGE_DUPLICATE")
HOPELESS = (
    "V_STATE_FREEZE", "V_ACTION_FREEZE", "V_LOW_INFORMATION_TRAJECTORY", "C_IMAGE_SHAPE", "C_PARQUET_CORRUPT", "C_SCHEMA_MISSING_IMAGE_COLUMN", "C_FILE_READ_ERROR", "C_IMAGE_READ_ERROR", "C_VALUE_READ_ERROR",
    "T_FRAME_ORDER_ERROR", *UNTIMED,
)


def _some(code_list: Column, names: tuple[str, ...], when: Column | None = None) -> Column:
    kept = F.array_intersect(F.array(*[F.lit(n) for n in names]), code_list)
    return kept if when is None else F.when(when, kept).otherwise(F.array().cast("array<string>"))


def repair_lists(code_list: Column, length_delta: Column, value_rate: Column, image_rate: Column, sparse: float = calibrate.CONSTANTS["bad_ratio_sparse"]) -> tuple[Column, Column]:
    """(repairable, unrecoverable) codes. A code in neither list, alone, leads to isolation."""
    little, few_values, few_images = F.abs(length_delta) <= 2, value_rate <= sparse, image_rate <= sparse
    repairable = F.concat(
        _some(code_list, RETIME, ~has(code_list, *UNTIMED)), _some(code_list, TASKS), _some(code_list, ("T_METADATA_LENGTH_MISMATCH",), little), _some(code_list, PATHS),
        _some(code_list, SPARSE_VALUES, few_values), _some(code_list, SPARSE_IMAGES, few_images),
    )
    lost = F.concat(_some(code_list, ("T_METADATA_LENGTH_MISMATCH",), ~little), _some(code_list, SPARSE_VALUES, ~few_values), _some(code_list, SPARSE_IMAGES, ~few_images), _some(code_list, HOPELESS))
    return repairable, lost


def repair_mode(code_list: Column, repairable: Column, unrecoverable: Column) -> Column:
    some, lost = F.size(repairable) > 0, F.size(unrecoverable) > 0
    return F.when(F.size(code_list) == 0, "none").when(some & ~lost, "auto_repair").when(some, "mark_and_recollect").otherwise("isolate")


#: What is done about each group of codes.
ACTIONS = (
    (RETIME, "rebuild timestamps from frame index and rate, keeping the originals"),
    (TASKS, "rewrite the task index where metadata names one task, with a per-frame audit"),
    (("T_METADATA_LENGTH_MISMATCH",), "correct the recorded length, or check the recording for lost frames"),
    (UNTIMED + ("T_FRAME_ORDER_ERROR",), "recollect or reorder; never overwrite the original silently"),
    (PATHS, "rewrite image paths by frame index and verify content hashes"),
    (SPARSE_VALUES, "interpolate sparse outliers from neighbours, or isolate the channel"),
    (("V_STATE_FREEZE", "V_ACTION_FREEZE", "V_LOW_INFORMATION_TRAJECTORY"), "recollect: a frozen sensor cannot be recovered"),
    (SPARSE_IMAGES, "mask the frames in every modality, or isolate the stream"),
    (("C_IMAGE_SHAPE",), "keep the original and check the capture configuration"),
    (("C_PARQUET_CORRUPT", "C_SCHEMA_MISSING_IMAGE_COLUMN", "C_FILE_READ_ERROR", "C_IMAGE_READ_ERROR", "C_VALUE_READ_ERROR"), "isolate the file and export it again"),
)


def actions(code_list: Column) -> Column:
    return codes(*[(text, has(code_list, *names)) for names, text in ACTIONS])


def report(structural: DataFrame, image: DataFrame, value: DataFrame, flags: DataFrame, files: DataFrame, thresholds: DataFrame, valid_tasks: tuple[int, ...] = (0, 1)) -> DataFrame:
    """One row per episode of files(dataset, episode_index, source_file, footer_rows, defect).

    Episodes missing from a profile count as unreadable there when the inventory names a defect: `corrupt` for the whole file,
    `missing_column:<part>` (structural, image or value) for one modality, `unreadable` otherwise, or when a file has rows but none was read.
    """
    values = value.withColumnRenamed("rows", "v_rows").withColumnsRenamed({c: f"v_{c}" for c in ("state_abs_max", "action_abs_max", "state_action_rmse_p99", "state_action_max_p99", "state_step_p99", "state_step_max", "action_step_p99", "action_step_max")})
    joined = files.join(structural, KEYS, "full").join(image.withColumnRenamed("rows", "i_rows"), KEYS, "full").join(values, KEYS, "full").join(rules.frame_evidence(flags), KEYS, "left")
    unread = F.coalesce(F.col("footer_rows") > 0, F.lit(False)) & F.col("rows").isNull() & F.col("defect").isNull()
    joined = joined.withColumn("defect", F.when(unread, "unreadable").otherwise(F.col("defect")))
    whole = F.col("defect").isNotNull() & ~F.coalesce(F.col("defect").startswith("missing_column"), F.lit(False))
    part = lambda p: F.coalesce(F.col("defect") == f"missing_column:{p}", F.lit(False))
    joined = joined.withColumns({f"{p}_read_ok": ~(F.coalesce(whole, F.lit(False)) | part(p)) for p in ("structural", "image", "value")})
    joined = joined.withColumns({f"{p}_defect": F.when(part(p), "missing_column").otherwise(F.coalesce("defect", F.lit(""))) for p in ("structural", "image", "value")})
    n = lambda c, d=0.0: finite_or(F.col(c).cast("double"), d)
    readable = F.col("value_read_ok")
    numeric, physical = F.lit(0.0), F.lit(0.0)
    for v in ("state", "action"):
        numeric = numeric + n(f"{v}_finite_bad_count")
        for k in ("hard_range", "position", "rotation", "gripper"):
            physical = physical + n(f"{v}_{k}_bad_count")
    joined = joined.withColumns({"numeric_bad": F.when(readable, numeric).otherwise(0.0), "physical_bad": F.when(readable, physical).otherwise(0.0), "_unit": rules.unit_mismatch()})
    joined = joined.crossJoin(F.broadcast(thresholds.select(F.struct("*").alias("t"))))  # one row
    t = lambda name: F.col(f"t.{name}")
    joined = joined.withColumn("issue_codes", F.array_distinct(codes(*rules.episode_rules(t, valid_tasks))))
    rows, found = n("rows"), F.col("issue_codes")
    one = F.greatest(rows, F.lit(1.0))
    odd_task = (n("task_unique_count", 1.0) > 1) | ~n("task_index_first").isin(*[float(x) for x in valid_tasks])
    aligned = lambda a, b: finite_or(F.col(a), n(b))
    residual = F.greatest(aligned("state_action_aligned_rmse_p99", "v_state_action_rmse_p99"), aligned("state_action_aligned_rmse_max", "state_action_rmse_max"))
    step = F.greatest(*[n(f"v_{v}_step_{m}") for v in ("state", "action") for m in ("p99", "max")])
    stuck = has(found, "V_STATE_FREEZE", "V_ACTION_FREEZE", "V_LOW_INFORMATION_TRAJECTORY")
    one_of = lambda c: F.least(F.lit(1.0), c)
    penalty = {
        "structural": 1.5 * (safe_ratio(n("shape_bad_count"), one) + safe_ratio(F.abs(n("length_delta")), F.greatest(n("expected_rows"), one))),
        "temporal": 1.5 * safe_ratio(n("temporal_frames"), rows) + safe_ratio(n("dt_nonpositive_count") + n("dt_gap_gt_1_5x_count") + n("dt_abs_err_gt_2ms_count"), one),
        "sync": 2.0 * (safe_ratio(n("any_path_mismatch_count") + n("any_missing_count"), F.greatest(3 * rows, F.lit(1.0))) + F.when(odd_task, 0.25).otherwise(0.0)),
        "content": 1.5 * safe_ratio(n("content_frames"), rows),
        "value": 1.25 * safe_ratio(n("value_frames"), rows) + 0.15 * one_of(residual / F.greatest(2.0 * t("state_action_rmse"), F.lit(1e-6))) + 0.10 * one_of(step / 2.0) + F.when(stuck, 0.35).otherwise(0.0),
    }
    s_ok, i_ok, v_ok = (F.col(f"{p}_read_ok") for p in ("structural", "image", "value"))
    readable_for = {"structural": s_ok & i_ok & v_ok, "temporal": s_ok, "sync": s_ok & i_ok, "content": i_ok, "value": v_ok}
    scored = joined.withColumns({f"{k}_score": F.when(readable_for[k], score(p)).otherwise(0.0) for k, p in penalty.items()})
    total = F.when(~s_ok, 0.0).when(~i_ok | ~v_ok, F.least(overall(), F.lit(GATE))).otherwise(overall())
    scored = scored.withColumn("overall_quality_score", total)
    value_rate = safe_ratio(F.col("numeric_bad") + F.col("physical_bad"), one)
    repairable, lost = repair_lists(found, n("length_delta"), value_rate, safe_ratio(n("any_image_bad_frame_count"), one))
    scored = scored.withColumns({"repairable_codes": F.array_distinct(repairable), "unrecoverable_codes": F.array_distinct(lost)})
    gate = F.when(~s_ok, "core file unreadable").when(~i_ok | ~v_ok, "required modality unreadable").otherwise("")
    return scored.select(
        *KEYS, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.when(F.size(found) == 0, "pass").otherwise("review").alias("status"), severity(found, F.col("overall_quality_score"), s_ok & i_ok & v_ok).alias("severity"),
        found, categories(found).alias("issue_categories"), *[f"{k}_score" for k in WEIGHTS], "overall_quality_score", gate.alias("score_gate_reason"),
        repair_mode(found, F.col("repairable_codes"), F.col("unrecoverable_codes")).alias("repair_mode"), "repairable_codes", "unrecoverable_codes", actions(found).alias("repair_actions"), "source_file",
    )
