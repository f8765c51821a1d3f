"""Vision against motion: lagged correlation, glitches, and cameras that stand still while the robot moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episoda.functions.scalars import finite
from episoda.operators.sequence import frame_window, longest_run, runs
from episoda.operators.statistics import population_z, quantile, with_quantiles

#: The grid of the freeze calibration.
FROZEN_GRID, MOVING_GRID, RUN_GRID = (0.3, 0.5, 0.8, 1.2), (0.60, 0.70, 0.80), (20, 30, 45, 60)
KEYS = ["dataset", "episode_index"]


def motion_series(image_frames: DataFrame, value_frames: DataFrame) -> DataFrame:
    """Mean visual motion over decoded streams beside the frame's steps: dataset, episode_index, row, motion, state_step_l2, action_step_l2."""
    seen = image_frames.where("decode_ok").groupBy(*KEYS, "row").agg(F.avg(finite(F.col("motion_mad_prev"))).alias("motion"))
    return seen.join(value_frames.select(*KEYS, "row", finite(F.col("state_step_l2")).alias("state_step_l2"), finite(F.col("action_step_l2")).alias("action_step_l2")), [*KEYS, "row"])


def lag_correlation(series: DataFrame, keys: list[str], a: str, b: str, row: str = "row", most: int = 6, least_pairs: int = 15, least_values: int = 10, forward: bool = True) -> DataFrame:
    """keys, n, best_lag, peak_corr, zero_corr: mean product of z-scores at each lag; the largest absolute value wins, of equals the smallest lag.

    With `forward`, b is a difference to the row before and is first moved back one row. All lags are leads over one window.
    """
    w = frame_window(keys, row)
    shifted = series.withColumn("_b", F.lead(b).over(w) if forward else F.col(b))
    z = shifted.withColumns({"_za": population_z(a, keys, least_values), "_zb": population_z("_b", keys, least_values)})
    lags = list(range(-most, most + 1))
    paired = z.withColumns({f"_l{i}": F.col("_za") * (F.lead("_zb", k) if k >= 0 else F.lag("_zb", -k)).over(w) for i, k in enumerate(lags)})
    sums = paired.groupBy(*keys).agg(F.count("*").alias("n"), *[F.when(F.count(f"_l{i}") >= least_pairs, F.avg(f"_l{i}")).alias(f"_l{i}") for i in range(len(lags))])
    tried = F.array_compact(F.array(*[F.when(F.col(f"_l{i}").isNotNull(), F.struct(F.round(F.abs(f"_l{i}"), 12).alias("size"), F.lit(-k).alias("order"), F.col(f"_l{i}").alias("corr"))) for i, k in enumerate(lags)]))
    best = sums.withColumn("_best", F.array_max(tried))
    return best.select(*keys, "n", F.coalesce(-F.col("_best.order"), F.lit(0)).alias("best_lag"), F.coalesce("_best.corr", F.lit(0.0)).alias("peak_corr"), F.coalesce(f"_l{most}", F.lit(0.0)).alias("zero_corr"))


def moving(df: DataFrame, step: str, keys: list[str], q: float, name: str = "moving") -> DataFrame:
    """df with a column that tells whether a step is above the episode's own quantile."""
    cut = with_quantiles(df, keys, step, {"_cut": q})
    return cut.withColumn(name, F.coalesce(F.col(step) > F.col("_cut"), F.lit(False))).drop("_cut")


def freeze_grid(series: DataFrame, keys: list[str], motion: str, step: str, row: str = "row", frozen: Sequence[float] = FROZEN_GRID, quantiles: Sequence[float] = MOVING_GRID) -> DataFrame:
    """keys, frozen_thr, moving_q, frozen_frames, both_frames, max_run for every grid point.

    The moving cut is computed once per quantile, the run length of a grid is compared with max_run afterwards: 12 evaluations serve 48 points.
    """
    spark = series.sparkSession
    grid = spark.createDataFrame([(float(f), float(q)) for f in frozen for q in quantiles], "frozen_thr double, moving_q double")
    base = with_quantiles(series, keys, step, {f"_cut{i}": q for i, q in enumerate(quantiles)})
    crossed = base.crossJoin(F.broadcast(grid))  # 12 rows on the right
    cut = F.coalesce(*[F.when(F.col("moving_q") == q, F.col(f"_cut{i}")) for i, q in enumerate(quantiles)])
    still = F.coalesce(F.col(motion) < F.col("frozen_thr"), F.lit(False))
    crossed = crossed.withColumns({"_frozen": still, "_both": still & F.coalesce(F.col(step) > cut, F.lit(False))})
    own = [*keys, "frozen_thr", "moving_q"]
    counts = crossed.groupBy(*own).agg(F.count_if("_frozen").alias("frozen_frames"), F.count_if("_both").alias("both_frames"))
    longest = longest_run(crossed, own, F.col("_both"), row, positional=True).select(*own, F.col("longest_run").alias("max_run"))
    return counts.join(longest, own, "left").withColumn("max_run", F.coalesce("max_run", F.lit(0)))


def choose_freeze(grid: DataFrame, run_lengths: Sequence[int] = RUN_GRID) -> DataFrame:
    """The most sensitive point (largest frozen threshold, shortest run, lowest quantile) that flags no reference episode and whose run length is
    at least 20 and three times the longest reference run. One row, or none."""
    by_point = grid.groupBy("frozen_thr", "moving_q").agg(F.max("max_run").alias("observed"))
    points = by_point.withColumn("run_len", F.explode(F.array(*[F.lit(n) for n in run_lengths])))
    clean = points.where((F.col("observed") < F.col("run_len")) & (F.col("run_len") >= F.greatest(F.lit(20), 3 * F.col("observed"))))
    return clean.orderBy(F.desc("frozen_thr"), "run_len", "moving_q").limit(1)


def freeze_intervals(series: DataFrame, keys: list[str], motion: str, step: str, frozen_thr: float, moving_q: float, run_len: int, row: str = "row") -> DataFrame:
    """Runs of at least run_len rows that stand still under motion; rows missing from the series are bridged."""
    both = moving(series, step, keys, moving_q, "_moving").withColumn("_both", F.coalesce(F.col(motion) < frozen_thr, F.lit(False)) & F.col("_moving"))
    return runs(both, keys, F.col("_both"), row, positional=True).where(F.col("frame_count") >= run_len)


def append_freeze_code(report: DataFrame, frozen: DataFrame, code: str = "S_VISUAL_FREEZE_UNDER_MOTION") -> DataFrame:
    """Add the code to episodes that are frozen and already flagged; status, severity and scores stay. Adding twice changes nothing."""
    marked = report.join(frozen.select(*KEYS).distinct().withColumn("_frozen", F.lit(True)), KEYS, "left")
    add = F.col("_frozen").isNotNull() & (F.col("status") != "pass")
    return marked.withColumn("issue_codes", F.when(add, F.array_union("issue_codes", F.array(F.lit(code)))).otherwise(F.col("issue_codes"))).drop("_frozen")


def newly_flagged(report: DataFrame, frozen: DataFrame) -> DataFrame:
    """Frozen episodes that the report passes: an overlay must not have any."""
    return frozen.select(*KEYS).distinct().join(report.where(F.col("status") != "pass").select(*KEYS), KEYS, "left_anti")


def robust_glitches(frames: DataFrame, keys: list[str], sharpness: str, edges: str, level: str, spread: str) -> DataFrame:
    """Per group: frames of ordinary brightness whose sharpness is over 6 robust deviations, or whose edges are over 4 medians plus 5."""
    w = Window.partitionBy(*keys)
    x = finite(F.col(sharpness))
    med = frames.withColumns({"_m": F.percentile(x, F.lit(0.5)).over(w), "_e": F.percentile(finite(F.col(edges)), F.lit(0.5)).over(w)})
    dev = med.withColumn("_mad", F.percentile(F.abs(x - F.col("_m")), F.lit(0.5)).over(w))
    z = F.when(F.col("_mad") > 1e-6, (x - F.col("_m")) / (1.4826 * F.col("_mad"))).otherwise(0.0)
    odd = F.col(level).between(25, 235) & (F.col(spread) > 8) & ((z > 6) | (F.col(edges) > 4 * F.col("_e") + 5))
    return dev.groupBy(*keys).agg(
        F.count("*").alias("n"), F.first("_m").alias("sharpness_median"), quantile(F.col(sharpness), 0.99).alias("sharpness_p99"), F.max(x).alias("sharpness_max"),
        F.first("_e").alias("edges_median"), F.count_if(F.coalesce(odd, F.lit(False))).alias("glitch_candidates"),
    )


def glitch_bounds(reference: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Per stream: q99, q995, q999 and max of each measure."""
    made = []
    for m in measures:
        x = finite(F.col(m))
        made += [quantile(F.col(m), q).alias(f"{m}_{n}") for q, n in ((0.99, "q99"), (0.995, "q995"), (0.999, "q999"))] + [F.max(x).alias(f"{m}_max")]
    return reference.groupBy(key).agg(*made)


def glitches(frames: DataFrame, bounds: DataFrame, keys: list[str], stream: str = "stream") -> DataFrame:
    """Per (episode, stream): frames noisier than the reference ever was, with an outlying colour cast, at ordinary brightness. Unknown streams are left out."""
    joined = frames.join(bounds, stream)
    over = (F.col("noise_residual") > F.col("noise_residual_max")) & (F.col("chroma_spread") > F.col("chroma_spread_q999")) & F.col("mean_luma").between(20, 240)
    return joined.groupBy(*keys, stream).agg(F.count("*").alias("n"), F.count_if(F.coalesce(over, F.lit(False))).alias("glitch_frames"))
