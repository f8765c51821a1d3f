"""From findings to use: repair queue, masks, clips, work orders, training policy, sensitivity of the verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episoda.functions.scalars import has, spearman_rank
from episoda.operators import rules, score
from episoda.operators.sequence import clips as clip_runs
from episoda.operators.sequence import longest_run

MIN_CLIP, LONG_CLIP, FPS = 30, 50, 10.0
KEYS = ["dataset", "episode_index"]


def priority(severity: Column) -> Column:
    """0 for the most severe; 5 for an unknown severity."""
    out = F.lit(5)
    for rank, name in reversed(list(enumerate(("severe", "high", "medium", "low", "pass")))):
        out = F.when(severity == name, rank).otherwise(out)
    return out


def repair_queue(report: DataFrame, recheck: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """The report by urgency: priority, then score, then episode; what a recheck measured is added where there is one."""
    queue = report.withColumn("priority", priority(F.col("severity")))
    if recheck is not None:
        queue = queue.join(recheck, keys, "left")
    return queue.orderBy("priority", "overall_quality_score", *keys)


def source_masks(flags: DataFrame, report: DataFrame) -> DataFrame:
    """Per frame: train_keep is true for frames without a code and for every frame of a passed episode."""
    joined = flags.join(report.select(*KEYS, "status", "repair_mode"), KEYS)
    keep = (F.col("status") == "pass") | (F.size("issue_codes") == 0)
    return joined.select(*KEYS, "row", F.coalesce(F.col("frame_index").cast("bigint"), F.col("row").cast("bigint")).alias("frame_index"), "issue_codes", F.lit(False).alias("repair_applied"), F.lit("").alias("repair_code"), keep.alias("quality_mask"), keep.alias("train_keep"), "status", "repair_mode")


def mask_summary(masks: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    sums = masks.groupBy(*keys).agg(F.count("*").alias("mask_rows"), F.count_if("train_keep").alias("keep_rows"), F.count_if(~F.col("train_keep")).alias("drop_rows"))
    longest = longest_run(masks, keys, F.col("train_keep"), positional=True).select(*keys, F.col("longest_run").alias("longest_keep_run"))
    return sums.join(longest, keys, "left").withColumn("longest_keep_run", F.coalesce("longest_keep_run", F.lit(0)))


def usable_clips(masks: DataFrame, least: int = MIN_CLIP) -> DataFrame:
    found = clip_runs(masks, KEYS, F.col("train_keep"), least, start_frame_index=F.min_by("frame_index", "row"), end_frame_index=F.max_by("frame_index", "row"), source_status=F.first("status"), source_repair_mode=F.first("repair_mode"))
    name = F.format_string("ep%03d_%06d_%06d", "episode_index", "start_row", "end_row")
    return found.withColumns({"clip_id": name, "duration_s": F.round(F.col("frame_count") / FPS, 2)})


def clip_statistics(clips: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return clips.groupBy(*keys).agg(F.count("*").alias("clip_count"), F.sum("frame_count").alias("clip_frames"), F.max("frame_count").alias("longest_clip"))


def work_orders(intervals: DataFrame, report: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Issue intervals of flagged episodes with the kind of work and its urgency by length."""
    flagged = report.where(F.col("status") != "pass").select(*keys, "repair_mode")
    kind = F.when(F.col("repair_mode") == "isolate", "isolate_and_recollect").when(F.col("repair_mode") == "mark_and_recollect", "cut_and_recollect").otherwise("review_mask")
    urgency = F.when(F.col("frame_count") >= 50, "high").when(F.col("frame_count") >= 10, "medium").otherwise("low")
    return intervals.join(flagged, keys).withColumns({"work_order_type": kind, "priority": urgency})


def train_policy(report: DataFrame, summary: DataFrame, clip_stats: DataFrame, repaired: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """First match of an ordered cascade. repaired(keys, fully boolean) names episodes with rechecked copies."""
    joined = report.join(summary, keys, "left").join(clip_stats, keys, "left").fillna(0, ["mask_rows", "keep_rows", "drop_rows", "longest_keep_run", "clip_count", "clip_frames", "longest_clip"])
    if repaired is None:
        joined = joined.withColumn("fully", F.lit(None).cast("boolean"))
    else:
        joined = joined.join(repaired, keys, "left")
    total = F.when(F.col("mask_rows") > 0, F.col("mask_rows")).otherwise(F.col("rows"))
    longest, kept = F.col("longest_clip"), F.col("keep_rows") / F.greatest(total, F.lit(1))
    unusable = has(F.col("issue_codes"), "C_PARQUET_CORRUPT", "C_SCHEMA_MISSING_IMAGE_COLUMN", "C_FILE_READ_ERROR")
    frozen = has(F.col("issue_codes"), "V_STATE_FREEZE", "V_ACTION_FREEZE", "V_LOW_INFORMATION_TRAJECTORY")
    cascade = [
        (unusable, "file_unusable", "isolate", "core file damaged or a required column missing"),
        (F.col("status") == "pass", "use_whole", "none", "passed"),
        (F.col("fully"), "use_repaired_copy", "rewrite", "reversible rewrite passed the same checks"),
        (~F.col("fully") & (longest >= MIN_CLIP), "use_clips", "partial_rewrite_and_cut", "rewritten; clean runs are used"),
        (~F.col("fully"), "use_masked", "partial_rewrite_and_mask", "rewritten; flagged rows are dropped"),
        ((longest >= LONG_CLIP) & (kept >= 0.25), "use_clips", "cut", "long clean run"),
        ((total > 0) & ((total - F.col("keep_rows")) / total <= 0.10) & (longest >= MIN_CLIP), "use_masked", "mask", "at most a tenth of the rows is flagged"),
        (longest >= MIN_CLIP, "use_clips", "cut", "clean runs can be cut out"),
        (frozen, "downweight", "downweight", "low information cannot be recovered from the same episode"),
    ]
    pick = F.struct(F.lit("isolate_and_recollect").alias("train_policy"), F.lit("isolate").alias("governance_layer"), F.lit("no safe rewrite and no clean run").alias("policy_reason"))
    for test, policy, layer, why in reversed(cascade):
        pick = F.when(test, F.struct(F.lit(policy).alias("train_policy"), F.lit(layer).alias("governance_layer"), F.lit(why).alias("policy_reason"))).otherwise(pick)
    out = joined.withColumn("_p", pick).withColumn("keep_rate", F.coalesce(F.round(F.try_divide(F.col("keep_rows").cast("double"), total), 4), F.lit(0.0)))
    carried = [c for c in ("status", "repair_mode", "issue_codes", "overall_quality_score", "rows") if c in report.columns]
    return out.select(*keys, *carried, "keep_rows", "drop_rows", "keep_rate", "longest_keep_run", "clip_count", "clip_frames", "longest_clip", "_p.*")


def tier_histogram(report: DataFrame) -> DataFrame:
    """Flagged episodes by confidence tier, with their share."""
    counts = report.where(F.size("issue_codes") > 0).groupBy(rules.confidence(F.col("issue_codes")).alias("tier")).agg(F.count("*").alias("episodes"))
    return counts.withColumn("share", F.col("episodes") / F.sum("episodes").over(Window.partitionBy(F.lit(0))))  # three rows at most


def scenarios(weights: dict[str, float] = score.WEIGHTS, delta: float = 0.05) -> list[tuple[str, dict[str, float]]]:
    """Every weight moved down and up by delta and renormalised, and equal weights."""
    out = []
    for k in weights:
        for d in (-delta, delta):
            w = {n: max(0.01, x + (d if n == k else 0)) for n, x in weights.items()}
            s = sum(w.values())
            out.append((f"{k}{d:+.2f}", {n: x / s for n, x in w.items()}))
    return [*out, ("equal", dict.fromkeys(weights, 1 / len(weights)))]


def weight_sensitivity(report: DataFrame, weights: dict[str, float], episode: str, threshold: float = 85.0, bottom: int = 10, moved: list[tuple[str, dict[str, float]]] | None = None) -> DataFrame:
    """scenario, spearman, flagged_jaccard, bottom_jaccard of each set of weights against the given ones. Score columns are {name}_score."""
    moved = moved or scenarios(weights)
    sums = lambda w: sum((F.lit(float(x)) * F.col(f"{n}_score") for n, x in w.items()), F.lit(0.0))
    base = report.select(episode, F.round(sums(weights), 9).alias("base"), *[F.round(sums(w), 9).alias(f"_q{i}") for i, (_, w) in enumerate(moved)])
    long = base.select(episode, "base", F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.col(f"_q{i}").alias("q")) for i, (n, _) in enumerate(moved)])).alias("x")).select(episode, "base", "x.*")
    by = Window.partitionBy("scenario")
    low = lambda c: F.row_number().over(by.orderBy(c, episode)) <= bottom
    ranked = long.withColumns({"_rb": spearman_rank(["scenario"], "base"), "_rq": spearman_rank(["scenario"], "q"), "_lb": low("base"), "_lq": low("q")})
    jaccard = lambda a, b: F.count_if(a & b) / F.greatest(F.count_if(a | b), F.lit(1))
    return ranked.groupBy("scenario").agg(
        F.corr("_rb", "_rq").alias("spearman"),
        jaccard(F.col("base") < threshold, F.col("q") < threshold).alias("flagged_jaccard"),
        jaccard(F.col("_lb"), F.col("_lq")).alias("bottom_jaccard"),
    )


#: The cumulative stages of the ablation and the code prefixes that each adds.
STAGES = (("file_gate", ("C_PARQUET", "C_FILE", "C_SCHEMA", "T_METADATA")), ("timing_and_values", ("T_", "V_")), ("all_modalities", ("S_", "C_")))


def ablation(report: DataFrame, flags: DataFrame) -> DataFrame:
    """Episodes and frames that each cumulative stage flags, and the gain over the stage before."""
    from episoda.functions.scalars import has_prefix

    parts, known = [], ()
    for i, (name, prefixes) in enumerate(STAGES):
        known += prefixes
        share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
        hit = has_prefix(F.col("issue_codes"), *known)
        ref = F.col("dataset") == "reference"
        r = report.agg(F.avg(F.when(ref, F.when(hit, 1.0).otherwise(0.0))).alias("reference_false_positive_rate"), F.count_if(hit & ~ref).alias("flagged_episodes"), F.avg(F.when(~ref, F.when(hit, 1.0).otherwise(0.0))).alias("flagged_episode_rate"))
        f = flags.where(~ref).agg(F.count_if(hit).alias("flagged_frames"), share(hit).alias("flagged_frame_rate"))
        parts.append(r.crossJoin(f).withColumns({"stage": F.lit(name), "stage_order": F.lit(i)}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy(F.lit(0)).orderBy("stage_order")  # three rows
    gain = lambda c: F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0))
    return out.withColumns({"episode_gain": gain("flagged_episodes"), "frame_gain": gain("flagged_frames")})
