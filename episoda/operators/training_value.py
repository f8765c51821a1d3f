"""What an episode is worth for training: idle time, interaction, visual diversity, task balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episoda.functions.scalars import finite
from episoda.operators.sequence import longest_run
from episoda.operators.statistics import quantile


def cuts(reference: DataFrame, state: str = "state_step_l2", action: str = "action_step_l2") -> DataFrame:
    """One row: interaction cuts (median) and idle cuts (tenth percentile, at least 1e-4) of the reference's steps."""
    low = lambda c: F.greatest(F.lit(1e-4), F.coalesce(quantile(F.col(c), 0.10), F.lit(0.0)))
    return reference.agg(quantile(F.col(state), 0.5).alias("state_cut"), quantile(F.col(action), 0.5).alias("action_cut"), low(state).alias("state_idle_cut"), low(action).alias("action_idle_cut"))


def features(frames: DataFrame, cut: DataFrame, bad_rows: DataFrame | None, keys: list[str], row: str = "row", state: str = "state_step_l2", action: str = "action_step_l2") -> DataFrame:
    """Per episode: rows, idle_fraction, longest_idle_run, interaction_rate, usable_interaction_rate. A missing step counts as none."""
    df = frames.crossJoin(F.broadcast(cut))  # one row
    if bad_rows is not None:
        df = df.join(bad_rows.select(*keys, row).distinct().withColumn("_bad", F.lit(True)), [*keys, row], "left")
    else:
        df = df.withColumn("_bad", F.lit(None).cast("boolean"))
    s, a = F.coalesce(finite(F.col(state)), F.lit(0.0)), F.coalesce(finite(F.col(action)), F.lit(0.0))
    df = df.withColumns({"_idle": (s <= F.col("state_idle_cut")) & (a <= F.col("action_idle_cut")), "_act": (s >= F.col("state_cut")) | (a >= F.col("action_cut"))})
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    sums = df.groupBy(*keys).agg(F.count("*").alias("rows"), share(F.col("_idle")).alias("idle_fraction"), share(F.col("_act")).alias("interaction_rate"), share(F.col("_act") & F.col("_bad").isNull()).alias("usable_interaction_rate"))
    idle = longest_run(df, keys, F.col("_idle"), row).select(*keys, F.col("longest_run").alias("longest_idle_run"))
    return sums.join(idle, keys, "left").withColumn("longest_idle_run", F.coalesce("longest_idle_run", F.lit(0)))


def diversity(images: DataFrame, keys: list[str], stream: str, digest: str) -> DataFrame:
    """Mean over streams of distinct over non-empty hashes."""
    by_stream = images.where(F.length(digest) > 0).groupBy(*keys, stream).agg((F.count_distinct(digest) / F.count(digest)).alias("share"))
    return by_stream.groupBy(*keys).agg(F.avg("share").alias("visual_diversity"))


def coverage_score(idle: Column, missing: Column, uniform: Column) -> Column:
    """100 less 35, 40 and 25 for each flag."""
    points = lambda flag, n: F.when(F.coalesce(flag, F.lit(False)), n).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), 100 - points(idle, 35) - points(missing, 40) - points(uniform, 25)))
