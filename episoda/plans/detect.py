"""The whole flow as one lazy plan per stage: profile, calibrate, flag, score, enrich, repair, recheck, govern."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episoda.operators import anomaly, calibrate, crossmodal, governance, images, repair, rules, score, structural, training_value, values
from episoda.operators.sequence import issue_intervals
from episoda.sources import episodes, sinks

KEYS = ["dataset", "episode_index"]


@dataclass
class Profile:
    files: DataFrame
    meta: DataFrame
    raw: DataFrame
    structural_frames: DataFrame
    structural_episodes: DataFrame
    value_frames: DataFrame
    value_episodes: DataFrame
    image_frames: DataFrame
    image_episodes: DataFrame


@dataclass
class Config:
    size: tuple[int, int, int] = images.SIZE
    valid_tasks: tuple[int, ...] = (0, 1)
    nominal_dt: float = structural.NOMINAL_DT


def read(spark: SparkSession, roots: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, metadata, frames) of {dataset: root}, all datasets in one table each."""
    parts = [(episodes.files(spark, r, d), episodes.metadata(spark, r, d), episodes.frames(spark, r, d)) for d, r in roots.items()]
    out = parts[0]
    for p in parts[1:]:
        out = tuple(a.unionByName(b) for a, b in zip(out, p, strict=True))
    return out


def profile(files: DataFrame, meta: DataFrame, raw: DataFrame, work: str, config: Config = Config()) -> Profile:
    """Stage tables of the three profiles. Pixels are decoded once and persisted; structure and values share one shuffle of narrow columns.

    Episodes whose defect hides a modality have no rows in that modality's tables.
    """
    spoiled = lambda part: F.broadcast(files.where(F.col("defect") == f"missing_column:{part}").select(*KEYS)) if part else None
    sound = raw.join(spoiled("structural"), KEYS, "left_anti")
    narrow = sound.select(*KEYS, "row", "timestamp", "frame_index", "episode_index_value", "index", "task_index", "state", "actions").repartition(*KEYS)
    sf = sinks.stage(structural.frames(narrow), work, "structural_frames")
    vf = sinks.stage(values.frames(narrow), work, "value_frames")
    seen = raw.join(files.where(F.col("defect").startswith("missing_column")).select(*KEYS), KEYS, "left_anti")
    im = sinks.stage(images.frames(seen), work, "image_frames")
    return Profile(files, meta, raw, sf, structural.episodes(sf, meta, config.nominal_dt), vf, values.episodes(vf), im, images.episodes(im, config.size))


def reference_of(p: Profile) -> DataFrame:
    ref = F.col("dataset") == "reference"
    return calibrate.thresholds(p.value_frames.where(ref), p.image_episodes.where(ref), p.image_frames.where(ref))


def detect(p: Profile, thresholds: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(frame flags, episode report) of all datasets."""
    flagged = rules.image_quality(p.image_frames, calibrate.by_stream(thresholds), config.size)
    flags = rules.frame_flags(p.structural_frames, p.value_frames, flagged, thresholds, config.valid_tasks)
    report = score.report(p.structural_episodes, p.image_episodes, p.value_episodes, flags, p.files.select(*KEYS, "source_file", "footer_rows", "defect"), thresholds, config.valid_tasks)
    return flags, report


FEATURES = {
    "dt_mad": "dt_mad", "length_delta_abs": "abs(length_delta)", "dt_nonpositive_rate": "try_divide(dt_nonpositive_count, rows)", "dt_gap_rate": "try_divide(dt_gap_gt_1_5x_count, rows)",
    "frame_nonunit_rate": "try_divide(frame_nonunit_diff_count, rows)", "missing_rate": "try_divide(any_missing_count, i_rows)", "dark_rate": "try_divide(any_dark_frame_count, i_rows)",
    "low_contrast_rate": "try_divide(any_low_contrast_count, i_rows)", "duplicate_rate": "try_divide(any_exact_duplicate_adjacent_count, i_rows)", "std_luma_median": "image_std_luma_median",
    "laplacian_median": "image_laplacian_var_median", "gradient_median": "image_gradient_energy_median", "state_finite_rate": "try_divide(state_finite_bad_count, v_rows)",
    "step_p99": "v_state_step_p99", "action_p99": "v_action_step_p99", "aligned_p99": "state_action_aligned_rmse_p99", "motion_median": "motion_median", "noise_median": "noise_median", "chroma_median": "chroma_median",
}


def episode_features(p: Profile) -> DataFrame:
    """One row of numbers per episode for the unsupervised channel."""
    med = lambda c: F.percentile(F.col(c), F.lit(0.5))
    extra = p.image_frames.groupBy(*KEYS).agg(med("motion_mad_prev").alias("motion_median"), med("noise_residual").alias("noise_median"), med("chroma_spread").alias("chroma_median"))
    v = p.value_episodes.select(*KEYS, F.col("rows").alias("v_rows"), "state_finite_bad_count", F.col("state_step_p99").alias("v_state_step_p99"), F.col("action_step_p99").alias("v_action_step_p99"), "state_action_aligned_rmse_p99")
    joined = p.structural_episodes.join(p.image_episodes.withColumnRenamed("rows", "i_rows"), KEYS, "left").join(v, KEYS, "left").join(extra, KEYS, "left")
    return joined.select(*KEYS, *[F.expr(f"cast({e} as double)").alias(n) for n, e in FEATURES.items()])


def unsupervised(p: Profile, trees: int = 200) -> DataFrame:
    return anomaly.isolation_scores(episode_features(p), list(FEATURES), trees)


def freeze(p: Profile) -> tuple[DataFrame, DataFrame | None]:
    """(calibration grid, intervals of frozen vision under motion in every dataset), the latter None if no grid point keeps the reference clean."""
    series = crossmodal.motion_series(p.image_frames, p.value_frames)
    grid = crossmodal.freeze_grid(series.where(F.col("dataset") == "reference"), KEYS, "motion", "state_step_l2")
    point = crossmodal.choose_freeze(grid).first()
    if point is None:
        return grid, None
    return grid, crossmodal.freeze_intervals(series, KEYS, "motion", "state_step_l2", point.frozen_thr, point.moving_q, point.run_len)


def overlay(report: DataFrame, intervals: DataFrame | None) -> DataFrame:
    """The report with the freeze code; refuses to flag an episode that passed."""
    if intervals is None:
        return report
    new = crossmodal.newly_flagged(report, intervals).limit(5).collect()
    if new:
        raise ValueError(f"the freeze overlay would newly flag episodes, {[tuple(r) for r in new]} among them")
    return crossmodal.append_freeze_code(report, intervals)


def training_worth(p: Profile, flags: DataFrame) -> DataFrame:
    """Value-coverage features and score of every test episode against the reference's cuts."""
    ref = F.col("dataset") == "reference"
    cut = training_value.cuts(p.value_frames.where(ref))
    bad = flags.where(F.size("issue_codes") > 0)
    f = training_value.features(p.value_frames, cut, bad, KEYS).join(training_value.diversity(p.image_frames, KEYS, "stream", "ahash"), KEYS, "left")
    q = lambda c, x: F.percentile(F.col(c), F.lit(x))
    limits = f.where(ref).agg(q("idle_fraction", 0.95).alias("_idle"), q("interaction_rate", 0.05).alias("_act"), q("visual_diversity", 0.05).alias("_div"))
    f = f.crossJoin(F.broadcast(limits))  # one row
    flagged = {"high_idle_flag": F.col("idle_fraction") > F.col("_idle"), "high_value_missing_flag": F.col("interaction_rate") < F.col("_act"), "scene_coverage_low_flag": F.coalesce(F.col("visual_diversity") < F.col("_div"), F.lit(False))}
    f = f.withColumns(flagged).drop("_idle", "_act", "_div")
    return f.withColumn("value_coverage_score", training_value.coverage_score(*[F.col(c) for c in flagged]))


def repair_all(p: Profile, report: DataFrame, tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired frames, audit masks) of test episodes whose findings name a reversible repair.

    Targets come from the findings. Each kind of repair takes its own episodes; an episode takes the first kind that applies.
    """
    mode = report.where((F.col("dataset") != "reference") & (F.size("repairable_codes") > 0)).select(*KEYS, "repairable_codes")
    kind = F.coalesce(*[F.when(F.arrays_overlap("repairable_codes", F.array(*[F.lit(c) for c in repair.TARGETS[k]])), k) for k in ("timestamp", "task_index", "paths", "sparse_nonfinite", "position_spike")])
    chosen = mode.select(*KEYS, kind.alias("kind")).where("kind IS NOT NULL")
    frames = p.raw.join(chosen, KEYS)
    of = lambda k: frames.where(F.col("kind") == k).drop("kind")
    base, audit = p.raw.columns, list(repair.MASK)
    parts = []
    t = repair.rebuilt_timestamp(of("timestamp"), KEYS, "timestamp", "frame_index").where("accepted")
    old, new = F.col("timestamp").cast("string"), F.col("rebuilt").cast("float").cast("string")
    on = lambda c: F.when(F.col("changed"), c).otherwise("")
    t = t.withColumns({"repair_applied": F.col("changed"), "repair_code": on(F.lit("T_TIMESTAMP_JITTER_OR_DRIFT")), "field": on(F.lit("timestamp")), "original_value": on(old), "repaired_value": on(new), "quality_mask": ~F.col("changed")})
    parts.append(t.withColumn("timestamp", F.col("rebuilt").cast("float")).select(*base, *audit, F.lit("timestamp").alias("kind")))
    expected = repair.expected_tasks(p.meta, tasks)
    parts.append(repair.rewritten_task(of("task_index").join(expected, KEYS), "task_index", "expected_task", "S_TASK_INDEX_INVALID").select(*base, *audit, F.lit("task_index").alias("kind")))
    parts.append(repair.repaired_paths(of("paths")).where("accepted").select(*base, *audit, F.lit("paths").alias("kind")))
    for k in ("sparse_nonfinite", "position_spike"):
        fixed = repair.repaired_values(of(k), k).where("accepted").withColumnRenamed("state", "_state")
        joined = of(k).join(fixed, [*KEYS, "row"]).withColumn("state", F.col("_state"))
        parts.append(joined.select(*base, *audit, F.lit(k).alias("kind")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    masks = out.where("repair_applied").select(*KEYS, "row", "frame_index", "kind", *audit)
    return out, masks


def recheck(p: Profile, repaired: DataFrame, thresholds: DataFrame, before: DataFrame, work: str, config: Config = Config()) -> DataFrame:
    """The same detector over the copies, against the thresholds and reports of the sources."""
    copies = repaired.select(*p.raw.columns)
    own = repaired.select(*KEYS, "kind").distinct()
    files = p.files.join(own.select(*KEYS), KEYS, "left_semi")
    again = profile(files, p.meta.join(own.select(*KEYS), KEYS, "left_semi"), copies, work, config)
    _, after = detect(again, thresholds, config)
    return repair.recheck(before, after, own)


def govern(report: DataFrame, flags: DataFrame, rechecked: DataFrame | None = None) -> dict[str, DataFrame]:
    """Queue, intervals, work orders, masks, clips, policy and summary of the test episodes."""
    test = F.col("dataset") != "reference"
    report, flags = report.where(test), flags.where(test)
    intervals = issue_intervals(flags, KEYS)
    masks = governance.source_masks(flags, report)
    clips = governance.usable_clips(masks)
    summary = governance.mask_summary(masks)
    fixed = None if rechecked is None else rechecked.where("targeted_codes_removed").select(*KEYS, F.col("passed_full_recheck").alias("fully"))
    policy = governance.train_policy(report, summary, governance.clip_statistics(clips), fixed)
    tiers = governance.tier_histogram(report)
    return {
        "repair_queue": governance.repair_queue(report), "issue_intervals": intervals, "work_orders": governance.work_orders(intervals, report), "masks": masks,
        "mask_summary": summary, "clips": clips, "train_policy": policy, "confidence_tiers": tiers,
        "release_summary": policy.groupBy("train_policy").agg(F.count("*").alias("episodes"), F.sum("clip_frames").alias("clip_frames"), F.sum("keep_rows").alias("keep_rows")),
    }
