"""Is the detector right? Leave-one-out thresholds, fault-injection metrics, bootstrap intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episoda.functions.scalars import finite
from episoda.operators.statistics import binary_metrics


def leave_one_out(df: DataFrame, key: str, value: str, q: float, floor: float, margin: float) -> DataFrame:
    """Per held-out key: n rows, the threshold from all other keys, and how many of its own rows are over it.

    A quantile that leaves a key out needs no join of every key with every other: the place j from the top among the others is the place j
    plus the number of own rows above it in the order of all, and an own row is above it if fewer than j others are above that row. So each
    key is joined with its own rows among the top ranks and then with the rows at the two places that its quantile lies between.
    """
    x = df.select(key, finite(F.col(value)).alias("x")).where("x IS NOT NULL")
    sizes = x.groupBy(key).agg(F.count("*").alias("own"))
    total = sizes.agg(F.sum("own").alias("total"), F.max("own").alias("most"))  # one row
    # place of the quantile among total-own values, counted from the top: at most (1-q)*total + 1 others, plus most of the held-out key
    reach = F.ceil((1 - q) * F.col("total")) + F.col("most") + 2
    n_top = total.select(reach.cast("int").alias("r")).first()
    if n_top is None or n_top.r is None:
        return sizes.select(key, F.col("own").alias("n"), F.lit(float(floor)).alias("threshold"), F.lit(0).cast("bigint").alias("flagged"))
    top = x.orderBy(F.desc("x"), key).limit(n_top.r)  # distributed top-k
    top = top.withColumn("_k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("x"), key)))  # n_top rows: the largest key and the tail
    others = F.col("total") - F.col("own")
    place = (others - 1) * (1 - q)  # from the top, counted from 0
    low, high = F.floor(place + 1e-9), F.ceil(place - 1e-9)
    wanted = sizes.crossJoin(F.broadcast(total)).select(key, (low + 1).alias("_low"), (high + 1).alias("_high"), (place - low).alias("f"))
    above = F.col("_k") - F.row_number().over(Window.partitionBy(key).orderBy("_k"))  # rows of other keys above a row
    near = wanted.join(top.select(key, above.alias("_above")), key, "left")
    places = near.groupBy(key, "_low", "_high", "f").agg(F.count_if(F.col("_above") < F.col("_low")).alias("_l"), F.count_if(F.col("_above") < F.col("_high")).alias("_h"))
    places = places.select(key, "f", (F.col("_low") + F.col("_l")).alias("_low"), (F.col("_high") + F.col("_h")).alias("_high"))
    cut = places.join(top.select(F.col("_k").alias("_low"), F.col("x").alias("a")), "_low", "left").join(top.select(F.col("_k").alias("_high"), F.col("x").alias("b")), "_high", "left")
    limits = cut.select(key, F.greatest(F.lit(float(floor)), margin * (F.col("a") + (F.col("b") - F.col("a")) * F.col("f"))).alias("threshold"))
    limits = sizes.join(limits, key, "left").withColumn("threshold", F.coalesce("threshold", F.lit(float(floor))))
    return x.join(limits, key).groupBy(key).agg(F.count("*").alias("n"), F.first("threshold").alias("threshold"), F.count_if(F.col("x") > F.col("threshold")).alias("flagged"))


CATEGORIES = ("temporal", "synchronisation", "content", "value")


def judged(report: DataFrame, truth: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """A row (episode_index, scope, truth, predicted) of each episode overall and by category. truth(episode_index, categories array) names the faults."""
    joined = report.select("episode_index", "issue_categories").join(truth.select("episode_index", F.col("categories").alias("true_categories")), "episode_index", "left")
    joined = joined.withColumn("true_categories", F.coalesce("true_categories", F.array().cast("array<string>")))
    parts = [F.struct(F.lit("overall").alias("scope"), (F.size("true_categories") > 0).alias("truth"), (F.size("issue_categories") > 0).alias("predicted"))]
    parts += [F.struct(F.lit(c).alias("scope"), F.array_contains("true_categories", c).alias("truth"), F.array_contains("issue_categories", c).alias("predicted")) for c in categories]
    return joined.select("episode_index", F.explode(F.array(*parts)).alias("x")).select("episode_index", "x.*")


def fault_metrics(report: DataFrame, truth: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """Precision, recall and F1 of flagged episodes, overall and by category."""
    return binary_metrics(judged(report, truth, categories), F.col("truth"), F.col("predicted"), ["scope"])


def fault_intervals(report: DataFrame, truth: DataFrame, categories: tuple[str, ...] = CATEGORIES, draws: int = 2000) -> DataFrame:
    """95 % intervals of what `fault_metrics` gives, overall and by category."""
    return bootstrap(judged(report, truth, categories), "truth", "predicted", draws, by="scope")


def frame_metrics(flags: DataFrame, truth_rows: DataFrame, evaluable: DataFrame) -> DataFrame:
    """Frame-level metrics over the episodes whose rows are labelled. truth_rows(episode_index, row), evaluable(episode_index)."""
    own = flags.join(evaluable.select("episode_index").distinct(), "episode_index", "left_semi")
    joined = own.join(truth_rows.select("episode_index", "row").distinct().withColumn("_t", F.lit(True)), ["episode_index", "row"], "left")
    return binary_metrics(joined, F.col("_t").isNotNull(), F.size("issue_codes") > 0)


def bootstrap(df: DataFrame, truth: str, predicted: str, draws: int = 2000, seed: int = 20260827, by: str | None = None) -> DataFrame:
    """metric, low, high, draws: 95 % percentile interval of precision, recall and F1 over resampled rows; of each value of `by`, if one is named.

    The metrics depend on the four cell counts only, and resampling n rows draws those counts from a multinomial: the counts (four numbers
    of each value of `by`, which is to be a short catalogue) are all that is gathered, and the draws are split over tasks by seed. Draws
    without both classes in the truth are skipped.
    """
    t, p = F.col(truth), F.col(predicted)
    cells = df.groupBy(*([F.col(by).cast("string").alias("scope")] if by else [F.lit("").alias("scope")]))
    cells = cells.agg(F.count_if(t & p), F.count_if(~t & p), F.count_if(t & ~p), F.count_if(~t & ~p)).collect()
    counts = sorted(((r[0], np.array(r[1:], float)) for r in cells if sum(r[1:])), key=lambda x: (x[0] is not None, x[0] or ""))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ratio = lambda a, c: a / c if c else 0.0
        for b in batches:
            rows = []
            for i in b["id"]:
                rng = np.random.default_rng(seed + int(i))
                for scope, own in counts:
                    tp, fp, fn, tn = rng.multinomial(int(own.sum()), own / own.sum())
                    if tp + fn and fp + tn:
                        rows.append((scope, ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn)))
            yield pd.DataFrame(rows, columns=["scope", "precision", "recall", "f1"])

    drawn = df.sparkSession.range(draws).mapInPandas(draw, "scope string, precision double, recall double, f1 double")
    long = drawn.unpivot(["scope"], ["precision", "recall", "f1"], "metric", "v")
    out = long.groupBy("scope", "metric").agg(F.percentile("v", F.lit(0.025)).alias("low"), F.percentile("v", F.lit(0.975)).alias("high"), F.count("*").alias("draws"))
    return out.withColumnRenamed("scope", by) if by else out.drop("scope")
