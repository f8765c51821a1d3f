"""Registered queries: each applies engine operators to the supplied tables through their surrogate episodes.

Computed doubles are rounded to 6 decimals, so that the order of additions does not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episoda.functions import scalars, vectors
from episoda.operators import crossmodal, governance, rules, sequence, statistics, training_value
from episoda.plans import surrogates as s
from episoda.sources import inventory

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def r6(c: str | Column, name: str | None = None) -> Column:
    out = F.round(F.col(c) if isinstance(c, str) else c, 6)
    return out.alias(name or c) if name or isinstance(c, str) else out


USER = ["user_id"]
#: Means of microseconds end in an exact half of the sixth decimal; this keeps both engines on the same side of it.
NUDGE = 1e-9


@query
def frame_intervals(spark, sf):
    return s.events(spark, sf).select("user_id", "event_id", "row", r6("dt", "dt_s"))


@query
def interval_robust_stats(spark, sf):
    st = statistics.robust(s.events(spark, sf), USER, "dt", "dt")
    return st.select("user_id", "dt_n", *[r6(F.col(f"dt_{k}") + NUDGE, f"dt_{k}") for k in ("median", "mad", "p01", "p99")])


@query
def gap_runs(spark, sf):
    ev = s.events(spark, sf)
    ev = ev.withColumn("m", F.percentile("dt", F.lit(0.5)).over(Window.partitionBy(*USER)))
    ev = ev.withColumn("gap", F.coalesce(F.col("dt") > 1.5 * F.col("m"), F.lit(False)))
    base = ev.groupBy(*USER).agg(r6(F.first("m") + NUDGE, "dt_median"), r6(statistics.quantile(F.col("dt"), 0.99) + NUDGE, "dt_p99"), F.count_if("gap").alias("gap_frames"))
    runs = sequence.runs(ev, USER, F.col("gap")).groupBy(*USER).agg(F.count("*").alias("gap_runs"), F.max("frame_count").alias("longest_gap_run"))
    return base.join(runs, USER, "left").fillna(0, ["gap_runs", "longest_gap_run"])


@query
def longest_run_first_tie(spark, sf):
    return sequence.longest_run(s.events(spark, sf), USER, F.col("value") < 70)


@query
def usable_clips(spark, sf):
    found = sequence.clips(s.events(spark, sf), USER, F.col("value") < 70, 5)
    return found.select("user_id", "start_row", "end_row", "frame_count", F.format_string("ep%03d_%06d_%06d", "user_id", "start_row", "end_row").alias("clip_id"), F.round(F.col("frame_count") / 10.0, 2).alias("duration_s"))


@query
def issue_intervals(spark, sf):
    found = sequence.issue_intervals(s.flagged_events(spark, sf), ["episode_index"], detail="event_type")
    return found.select("episode_index", "start_row", "end_row", "frame_count", s.joined("issue_codes"), "detail_examples")


@query
def frame_discontinuity(spark, sf):
    li = s.lines(spark, sf)
    return li.groupBy("l_orderkey").agg(F.count("*").alias("rows"), F.count_if(F.col("frame_diff") != 1).alias("nonunit"), F.count_if(F.col("frame_diff") <= 0).alias("nonpositive"))


@query
def turn_continuity(spark, sf):
    cv = s.table(spark, sf, "conversations")
    d = cv.withColumn("d", F.col("turn") - F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn")))
    return d.groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if(F.col("d") != 1).alias("breaks"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.min_by("role", "turn").alias("first_role"))


@query
def episode_profile(spark, sf):
    w = Window.partitionBy("l_orderkey").orderBy("row")
    li = s.lines(spark, sf).withColumn("step", F.abs(F.col("l_quantity") - F.lag("l_quantity").over(w)))
    return li.groupBy("l_orderkey").agg(
        F.count("*").alias("rows"), F.min_by("l_quantity", "row").alias("first_quantity"), F.max_by("l_quantity", "row").alias("last_quantity"),
        F.max("l_extendedprice").alias("price_max"), r6(statistics.quantile(F.col("l_extendedprice"), 0.99), "price_p99"),
        F.sum(F.coalesce("step", F.lit(0.0))).alias("path_length"), r6(F.coalesce(F.avg(F.when(F.col("row") > 0, F.when(F.col("step") > 1e-4, 1.0).otherwise(0.0))), F.lit(0.0)), "motion_fraction"),
        F.count_distinct("l_suppkey").alias("suppliers"), statistics.smallest_mode(F.col("l_linenumber")).alias("line_mode"),
    )


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query
def stream_profile_pivot(spark, sf):
    ev = s.table(spark, sf, "events")
    return ev.groupBy("user_id").pivot("event_type", list(EVENT_TYPES)).agg(F.count(F.lit(1)).alias("n"), r6(F.percentile("value", F.lit(0.5)), "median"), F.max("value").alias("top")).fillna(0, [f"{t}_n" for t in EVENT_TYPES])


@query
def any_stream_bad(spark, sf):
    ev = s.table(spark, sf, "events").withColumn("bucket", F.date_trunc("day", "ts"))
    frames = ev.groupBy("user_id", "bucket").agg(F.bool_or(F.col("value") > 100).alias("bad"), F.count_if(F.col("value") > 100).alias("streams"))
    return frames.groupBy("user_id").agg(F.count("*").alias("frames"), F.count_if("bad").alias("bad_frames"), F.sum("streams").alias("bad_streams"))


def _line_thresholds(spark, sf):
    ref = s.table(spark, sf, "lineitem").where(F.col("l_orderkey") % 2 == 0)
    return ref.groupBy("l_returnflag").agg(
        F.greatest(F.lit(1000.0), statistics.quantile(F.col("l_extendedprice"), 0.999) * 1.25).alias("price_high"),
        (statistics.quantile(F.col("l_extendedprice"), 0.10) * 0.65).alias("price_low"),
        (statistics.quantile(F.col("l_quantity"), 0.002) * 0.5).alias("quantity_low"),
    )


@query
def reference_thresholds(spark, sf):
    return _line_thresholds(spark, sf).select("l_returnflag", r6("price_high"), r6("price_low"), r6("quantity_low"))


@query
def calibrated_flags(spark, sf):
    li = s.table(spark, sf, "lineitem").where(F.col("l_orderkey") % 2 == 1)
    j = li.join(_line_thresholds(spark, sf), "l_returnflag")
    return j.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("l_extendedprice") > 0.7 * F.col("price_high")).alias("high"), F.count_if(F.col("l_extendedprice") < F.col("price_low")).alias("low"))


@query
def frame_codes(spark, sf):
    li = s.lines(spark, sf)
    found = scalars.codes(("T_FRAME_INDEX_DISCONTINUITY", F.col("frame_diff") != 1), ("S_TASK_INDEX_INVALID", (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "R")), ("C_IMAGE_BLUR", F.col("l_discount") >= 0.09), ("V_SPIKE_JUMP", F.col("l_extendedprice") > 80_000))
    li = li.select("l_orderkey", found.alias("c")).withColumn("k", scalars.categories(F.col("c")))
    return li.groupBy(s.joined("c", "issue_codes"), s.joined("k", "issue_categories")).agg(F.count("*").alias("frames"), F.count_distinct("l_orderkey").alias("episodes"))


@query
def episode_codes(spark, sf):
    o = s.order_report(spark, sf)
    return o.select("episode", "rows", s.joined("issue_codes"), F.array_join(scalars.categories(F.col("issue_codes")), ";").alias("issue_categories"), rules.confidence(F.col("issue_codes")).alias("tier"))


@query
def code_prefix_filter(spark, sf):
    o = s.order_report(spark, sf)
    parts, known = [], ()
    for name, prefixes in governance.STAGES:
        known += prefixes
        parts.append(F.struct(F.lit(name).alias("stage"), scalars.has_prefix(F.col("issue_codes"), *known).alias("hit")))
    return o.select(F.explode(F.array(*parts)).alias("x")).groupBy("x.stage").agg(F.count_if("x.hit").alias("flagged"), F.count("*").alias("episodes"))


@query
def dimension_scores(spark, sf):
    o = s.order_report(spark, sf)
    return o.select("episode", *[r6(f"{k}_score") for k in ("structural", "temporal", "sync", "content", "value")], "overall_quality_score", "severity")


@query
def repair_mode(spark, sf):
    o = s.order_report(spark, sf)
    return o.select("episode", "repair_mode", F.array_join(F.array_sort("repairable_codes"), ";").alias("repairable_codes"), F.array_join(F.array_sort("unrecoverable_codes"), ";").alias("unrecoverable_codes"))


@query
def confidence_tier(spark, sf):
    h = governance.tier_histogram(s.order_report(spark, sf))
    return h.select("tier", "episodes", r6("share"))


@query
def repair_queue(spark, sf):
    q = governance.repair_queue(s.order_report(spark, sf), keys=["episode"])
    return q.where("priority < 4").select("priority", "overall_quality_score", "episode", "severity", "repair_mode")


@query
def work_orders(spark, sf):
    intervals = sequence.issue_intervals(s.flagged_events(spark, sf), ["dataset", "episode_index"])
    w = governance.work_orders(intervals, s.event_report(spark, sf))
    return w.select("episode_index", "start_row", "end_row", "frame_count", s.joined("issue_codes"), "work_order_type", "priority")


@query
def train_policy(spark, sf):
    report = s.event_report(spark, sf)
    masks = governance.source_masks(s.flagged_events(spark, sf), report)
    stats = governance.clip_statistics(governance.usable_clips(masks))
    p = governance.train_policy(report, governance.mask_summary(masks), stats)
    return p.select("episode_index", "status", "rows", "keep_rows", "drop_rows", "keep_rate", "longest_keep_run", "clip_count", "clip_frames", "longest_clip", "train_policy", "governance_layer")


@query
def vector_norms(spark, sf):
    v = s.vectors(spark, sf)
    return v.select("vec_id", vectors.well_formed(F.col("state")).alias("state_ok"), r6(vectors.norm(F.col("state")), "state_norm"), r6(vectors.norm(F.col("action")), "action_norm"))


@query
def vector_steps(spark, sf):
    w = Window.partitionBy("label").orderBy("vec_id")
    v = s.vectors(spark, sf).withColumn("step", vectors.norm(vectors.difference(F.col("state"), F.lag("state").over(w))))
    return v.select("label", "vec_id", r6("step"), r6(F.sum(F.coalesce("step", F.lit(0.0))).over(w), "path"))


@query
def state_action_residual(spark, sf):
    d = vectors.difference(F.col("action"), F.col("state"))
    return s.vectors(spark, sf).select("vec_id", r6(vectors.rmse(d), "rmse"), r6(vectors.max_abs(d), "max_abs"))


@query
def best_lag_alignment(spark, sf):
    w = Window.partitionBy("label").orderBy("vec_id")
    v = s.vectors(spark, sf).withColumns({"before": F.lag("state").over(w), "after": F.lead("state").over(w)})
    best = vectors.best_alignment(F.col("action"), {-1: F.col("before"), 0: F.col("state"), 1: F.col("after")})
    return v.select("label", "vec_id", best.alias("b")).select("label", "vec_id", F.col("b.lag").alias("best_lag"), r6(F.col("b.rmse"), "aligned_rmse"), r6(F.col("b.max_abs"), "aligned_max_abs"))


SCALED = vectors.Limits(0.25, 0.35, 0.28, 0.4, 0.85, 0.05, -0.12, 0.15, 0.25)


@query
def physical_flags(spark, sf):
    f = s.vectors(spark, sf).select("vec_id", vectors.physical_flags(F.col("state"), SCALED).alias("f")).select("vec_id", "f.*")
    flags = ["shape_ok", "finite_ok", "hard_range_bad", "rotation_bad", "gripper_bad", "position_bad"]
    return f.select("vec_id", *flags, *[r6(c) for c in ("abs_max", "position_abs_max", "rotation_norm_dev", "rotation_orth_dev", "gripper_min", "gripper_max")])


@query
def adjacent_duplicate(spark, sf):
    d = sequence.number_rows(s.table(spark, sf, "documents").select("doc_id", "source", "text"), ["source"], ["text", "doc_id"])
    d = d.withColumn("h", F.when(F.col("doc_id") % 7 != 0, F.sha1("text")).otherwise(""))
    gap = F.when(F.col("h") != "", F.col("h"))
    return d.select("doc_id", sequence.adjacent_duplicate("h", ["source"]).alias("duplicate"), F.coalesce((sequence.carried(gap, ["source"]) == F.col("h")) & (F.col("h") != ""), F.lit(False)).alias("duplicate_carried"))


@query
def path_index_regex(spark, sf):
    p = s.table(spark, sf, "pages")
    n = F.regexp_extract("url", r"/(\d+)", 1)
    n = F.when(n != "", n.cast("bigint"))
    return p.select("page_id", n.alias("path_index"), (n - F.col("page_id")).alias("path_delta"), F.sha1("html").alias("sha1"), scalars.last_parts(F.col("url"), 2).alias("tail"))


@query
def visual_diversity(spark, sf):
    d = s.table(spark, sf, "documents").withColumn("h", F.substring(F.sha1("text"), 1, 2))
    return training_value.diversity(d, ["source"], "lang", "h").select("source", r6("visual_diversity"))


def _moves(spark, sf):
    w = Window.partitionBy("user_id").orderBy("row")
    return s.events(spark, sf).withColumns({"state_step_l2": F.abs(F.col("value") - F.lag("value").over(w)), "action_step_l2": F.col("dt")})


@query
def idle_interaction(spark, sf):
    ev = _moves(spark, sf)
    cut = training_value.cuts(ev.where(F.col("user_id") % 2 == 0))
    bad = ev.where(F.col("value") > 120)
    f = training_value.features(ev, cut, bad, USER)
    score = training_value.coverage_score(F.col("idle_fraction") > 0.02, F.col("interaction_rate") < 0.7, F.col("usable_interaction_rate") < 0.62)
    return f.select("user_id", "rows", r6("idle_fraction"), "longest_idle_run", r6("interaction_rate"), r6("usable_interaction_rate"), score.alias("value_coverage_score"))


@query
def task_balance_entropy(spark, sf):
    counts = s.table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return statistics.normalised_entropy(counts).select(r6("balance"), r6("entropy"))


@query
def motion_join_moving_cut(spark, sf):
    ev = s.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    per = lambda kind, name: ev.where(F.col("event_type") == kind).groupBy("user_id", "day").agg(F.sum("value").alias(name))
    m = per("click", "motion").join(per("view", "step"), ["user_id", "day"])
    m = crossmodal.moving(m, "step", USER, 0.6)
    return m.groupBy("user_id").agg(F.count("*").alias("days"), F.count_if("moving").alias("moving_days"), r6(F.avg("motion"), "motion_mean"))


@query
def freeze_grid(spark, sf):
    series = _moves(spark, sf).withColumn("motion", F.col("value") / 40)
    g = crossmodal.freeze_grid(series, USER, "motion", "state_step_l2")
    return g.select("user_id", "frozen_thr", "moving_q", "frozen_frames", "both_frames", "max_run")


@query
def freeze_choice(spark, sf):
    series = _moves(spark, sf).withColumn("motion", F.col("value") / 40)
    return crossmodal.choose_freeze(crossmodal.freeze_grid(series, USER, "motion", "state_step_l2")).select("frozen_thr", "moving_q", "observed", "run_len")


@query
def lag_correlation(spark, sf):
    c = crossmodal.lag_correlation(_moves(spark, sf), USER, "value", "dt")
    return c.select("user_id", "n", "best_lag", r6("peak_corr"), r6("zero_corr"))


@query
def robust_glitch(spark, sf):
    li = s.table(spark, sf, "lineitem").withColumns({"level": F.col("l_quantity") * 5, "spread": (F.col("l_suppkey") % 50).cast("double")})
    g = crossmodal.robust_glitches(li, ["l_returnflag", "l_linestatus"], "l_extendedprice", "l_tax", "level", "spread")
    return g.select("l_returnflag", "l_linestatus", "n", *[r6(c) for c in ("sharpness_median", "sharpness_p99", "sharpness_max", "edges_median")], "glitch_candidates")


@query
def calib_quantiles(spark, sf):
    b = crossmodal.glitch_bounds(s.table(spark, sf, "lineitem"), "l_returnflag", ("l_extendedprice", "l_quantity"))
    return b.select("l_returnflag", *[r6(c) for c in b.columns[1:]])


@query
def classification_metrics(spark, sf):
    d = s.table(spark, sf, "documents").join(s.table(spark, sf, "labels"), "doc_id")
    m = statistics.binary_metrics(d, F.col("quality") == 1, F.col("n_chars") >= 1500, ["lang"])
    return m.select("lang", "tp", "fp", "fn", r6("precision"), r6("recall"), r6("f1"))


@query
def loeo_thresholds(spark, sf):
    from episoda.operators import validate

    v = s.vectors(spark, sf).select("label", "vec_id", vectors.norm(F.col("state")).alias("x"))
    out = validate.leave_one_out(v, "label", "x", 0.999, 0.1, 1.0)
    return out.select("label", "n", r6("threshold"), "flagged")


@query
def weight_sensitivity(spark, sf):
    sup = s.table(spark, sf, "supplier")
    k, a = F.col("s_suppkey"), F.col("s_acctbal")
    part = lambda n, m: 60 + F.pmod(k * n, F.lit(m)) * 40.0 / m
    sup = sup.select("s_suppkey", F.least(F.lit(100.0), F.greatest(F.lit(0.0), 80 + a / 500)).alias("structural_score"), part(7, 41).alias("temporal_score"), part(11, 37).alias("sync_score"), part(5, 29).alias("content_score"), part(3, 23).alias("value_score"))
    w = {"structural": 0.25, "temporal": 0.20, "sync": 0.20, "content": 0.20, "value": 0.15}
    out = governance.weight_sensitivity(sup, w, "s_suppkey", 82.0)
    return out.select("scenario", r6("spearman"), r6("flagged_jaccard"), r6("bottom_jaccard"))


@query
def hampel_flags(spark, sf):
    ev = s.events(spark, sf).withColumn("bad", sequence.hampel("value", USER, F.lit(100.0)))
    ev = ev.withColumn("clean", sequence.interpolated("value", F.col("bad"), USER))
    return ev.select("user_id", "row", "bad", r6("clean"))


@query
def timestamp_rebuild(spark, sf):
    from episoda.operators import repair

    ev = s.events(spark, sf).withColumn("t", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)") / 1e6)
    out = repair.rebuilt_timestamp(ev, USER, "t", "row", 0.0001)
    return out.select("user_id", "row", r6("rebuilt"), "accepted", "changed")


@query
def task_rewrite_mask(spark, sf):
    o = s.table(spark, sf, "orders").join(s.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    names = spark.createDataFrame([("AUTOMOBILE", 1), ("BUILDING", 2), ("FURNITURE", 3), ("HOUSEHOLD", 4), ("MACHINERY", 5)], "c_mktsegment string, expected int")
    from episoda.operators import repair

    found = F.substring("o_orderpriority", 1, 1).cast("int")
    m = repair.rewritten_task(o.join(F.broadcast(names), "c_mktsegment").withColumn("task", found), "task", "expected", "S_TASK_INDEX_INVALID")
    return m.select("o_orderkey", "task", "repair_applied", "quality_mask", "original_value", "repaired_value")


@query
def union_align(spark, sf):
    c = s.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), "c_mktsegment")
    p = s.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    both = c.unionByName(p, allowMissingColumns=True)
    only = c.where(F.col("balance") > 9000).select("nation").distinct().join(p.where(F.col("balance") > 9000).select("nation").distinct(), "nation", "left_anti").withColumn("only_customers", F.lit(True))
    g = both.groupBy("nation").agg(F.count("*").alias("n"), F.count("c_mktsegment").alias("with_segment"), F.max("balance").alias("top"))
    return g.join(only, "nation", "left").withColumn("only_customers", F.coalesce("only_customers", F.lit(False)))


@query
def zscore_impute(spark, sf):
    c = s.table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 != 3, F.col("c_acctbal")).alias("a"), F.col("c_nationkey").cast("double").alias("b"))
    z = statistics.impute_and_standardise(c, ["a", "b"], F.col("c_custkey") % 2 == 0)
    return z.select("c_custkey", r6("a"), r6("a_z"), r6("b_z"))


@query
def lenient_parse(spark, sf):
    ev = s.table(spark, sf, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.get_json_object("props", "$.k")).when(F.col("event_id") % 3 == 1, F.col("event_type"))
    yes = F.when(F.col("event_id") % 4 == 0, " TRUE ").when(F.col("event_id") % 4 == 1, "no").when(F.col("event_id") % 4 == 2, "1")
    n = scalars.number(text)
    return ev.select("event_id", n.alias("parsed"), scalars.finite_or(n, -1.0).alias("with_default"), scalars.truth(yes).alias("truth"), r6(scalars.safe_ratio(F.col("value"), n - 50), "ratio"), r6(scalars.safe_rate(F.col("value"), F.col("event_id") % 2), "rate"))


@query
def case_rows(spark, sf):
    ev = s.events(spark, sf)
    top = F.max_by(F.struct("row", "value"), F.struct("value", -F.col("row")))
    med = ev.withColumn("m", F.percentile("value", F.lit(0.5)).over(Window.partitionBy(*USER)))
    near = F.min_by(F.struct("row", "value"), F.struct(F.round(F.abs(F.col("value") - F.col("m")), 9), F.col("row")))
    return med.groupBy("user_id").agg(top.alias("t"), near.alias("n")).select("user_id", F.col("t.row").alias("top_row"), F.col("t.value").alias("top_value"), F.col("n.row").alias("median_row"), F.col("n.value").alias("median_value"))


@query
def worst_episodes(spark, sf):
    return s.order_report(spark, sf).orderBy("overall_quality_score", "episode").limit(20).select("episode", "overall_quality_score", "severity")


@query
def release_summary(spark, sf):
    o = s.order_report(spark, sf)
    g = o.groupBy("repair_mode").agg(F.count("*").alias("episodes"), r6(F.avg("overall_quality_score"), "mean_score"), r6(F.percentile("overall_quality_score", F.lit(0.5)), "median_score"), F.min("overall_quality_score").alias("lowest"), F.max("overall_quality_score").alias("highest"))
    return g


@query
def metric_table(spark, sf):
    o = s.order_report(spark, sf).agg(F.count("*").cast("double").alias("episodes"), F.count_if(F.size("issue_codes") > 0).cast("double").alias("flagged"), r6(F.avg("overall_quality_score"), "mean_score"))
    return o.unpivot([], ["episodes", "flagged", "mean_score"], "metric", "value")


@query
def hash_hamming(spark, sf):
    d = s.table(spark, sf, "documents").withColumn("h", F.lpad(F.conv(F.substring(F.sha1("text"), 1, 8), 16, 2), 32, "0"))
    w = Window.partitionBy("source").orderBy("doc_id")
    return d.select("doc_id", vectors.hamming(F.when(F.col("doc_id") % 11 != 0, F.col("h")).otherwise(""), F.lag("h").over(w)).alias("distance"))


@query
def candidate_disposition(spark, sf):
    """Auto-repair candidates with what was decided for their confidence tier; unknown tiers are left to a person."""
    dim = spark.createDataFrame([("deterministic", "repair"), ("high", "review")], "tier string, disposition string")
    o = s.order_report(spark, sf).where(F.col("repair_mode").isin("auto_repair", "mark_and_recollect")).withColumn("tier", rules.confidence(F.col("issue_codes")))
    named = o.join(F.broadcast(dim.where("tier = 'deterministic'")), "tier", "left")  # one row per tier
    return named.select("episode", "tier", F.coalesce("disposition", F.lit("decide by hand")).alias("disposition"))


@query
def ablation_stages(spark, sf):
    half = F.when(F.col("episode_index") % 2 == 0, "reference").otherwise("test")
    a = governance.ablation(s.event_report(spark, sf).withColumn("dataset", half), s.flagged_events(spark, sf).withColumn("dataset", half))
    return a.select("stage", r6("reference_false_positive_rate"), "flagged_episodes", r6("flagged_episode_rate"), "flagged_frames", r6("flagged_frame_rate"), "episode_gain", "frame_gain")


@query
def bootstrap_interval(spark, sf):
    from episoda.operators import validate

    d = s.table(spark, sf, "documents").join(s.table(spark, sf, "labels"), "doc_id").select((F.col("quality") == 1).alias("t"), (F.col("n_chars") >= 1500).alias("p"))
    return validate.bootstrap(d, "t", "p")


@query
def isolation_scores(spark, sf):
    from episoda.operators import anomaly

    v = s.vectors(spark, sf).select(F.when(F.col("label") < 5, "reference").otherwise("test").alias("dataset"), F.col("vec_id").alias("episode_index"), *[F.get("state", F.lit(i)).alias(f"x{i}") for i in range(6)])
    return anomaly.isolation_scores(v, [f"x{i}" for i in range(6)])


@query
def sparse_value_repair(spark, sf):
    """Position spikes put into every 50th vector of a label are pulled back to their neighbours' mean."""
    from episoda.operators import repair

    v = sequence.number_rows(s.vectors(spark, sf), ["label"], ["vec_id"])
    n = F.count(F.lit(1)).over(Window.partitionBy("label"))
    hit = F.col("row") == 10
    frames = v.select(F.lit("test").alias("dataset"), F.col("label").cast("bigint").alias("episode_index"), "row", F.when(hit, F.concat(F.array(F.lit(3.0)), F.slice("state", 2, 19))).otherwise(F.col("state")).cast("array<float>").alias("state"), n.alias("n"))
    return repair.repaired_values(frames, "position_spike").select("episode_index", "row", r6(F.get("state", F.lit(0)).cast("double"), "first"), "accepted", "repair_applied", "field")


def _faults(spark):
    """Synthetic episodes with one fault each, run through the whole detector; stage tables go to the shared folder."""
    import re
    import tempfile
    import uuid

    from episoda.operators import synthetic
    from episoda.plans import detect
    from episoda.sources import sinks

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        shared = "file://" + tempfile.mkdtemp(prefix="stages-")
    work = f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}/faults-{uuid.uuid4().hex}"
    config = detect.Config(size=(32, 32, 3))
    raw = sinks.stage(synthetic.frames(spark, n=40), work, "raw")
    p = detect.profile(synthetic.file_table(raw), synthetic.metadata(raw), raw, work, config)
    thresholds = sinks.stage(detect.reference_of(p), work, "thresholds")
    flags, report = detect.detect(p, thresholds, config)
    return work, config, p, thresholds, sinks.stage(flags, work, "flags"), sinks.stage(report, work, "report")


@query
def injected_faults(spark, sf):
    """Episode-level precision, recall and F1 over 20 clean and 20 faulty synthetic episodes, overall and by category."""
    from episoda.operators import synthetic, validate

    *_, report = _faults(spark)
    return validate.fault_metrics(report, synthetic.labels(spark, n=40))


@query
def repair_recheck(spark, sf):
    """What the repairs of the synthetic faults achieve, measured by the detector that found them."""
    from episoda.plans import detect

    work, config, p, thresholds, _, report = _faults(spark)
    tasks = spark.createDataFrame([("task 0", 0), ("task 1", 1)], "task string, task_index bigint")
    fixed, _ = detect.repair_all(p, report, tasks)
    fixed = detect.sinks.stage(fixed, work, "fixed")
    r = detect.recheck(p, fixed, thresholds, report, f"{work}/again", config)
    return r.select("episode_index", "kind", s.joined("issue_codes_before"), s.joined("issue_codes_after"), r6("score_gain_measured"), "targeted_codes_removed", "passed_full_recheck")


@query
def file_inventory(spark, sf):
    return inventory.files(spark, sf, "*.parquet").select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length")
