"""Isolation forest over episode features: a supplementary, unsupervised channel that never changes a verdict.

The feature table has one row per episode. Medians, means and deviations come from all reference episodes, and each tree draws its rows from all
of them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _harmonic(n: float) -> float:
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, rng: np.random.Generator, depth: int, limit: int) -> tuple:
    spread = np.flatnonzero(x.max(0) > x.min(0)) if len(x) else []
    if depth >= limit or len(x) <= 1 or not len(spread):
        return (len(x),)
    c = int(rng.choice(spread))
    cut = rng.uniform(x[:, c].min(), x[:, c].max())
    return (c, cut, grow(x[x[:, c] < cut], rng, depth + 1, limit), grow(x[x[:, c] >= cut], rng, depth + 1, limit))


def depth_of(tree: tuple, x: np.ndarray) -> np.ndarray:
    """Depth of every row, all rows of a node together."""
    out, left = np.zeros(len(x)), [(tree, np.arange(len(x)), 0)]
    while left:
        node, own, d = left.pop()
        if len(node) == 1:
            out[own] = d + _harmonic(node[0])
        elif len(own):
            low = x[own, node[0]] < node[1]
            left += [(node[2], own[low], d + 1), (node[3], own[~low], d + 1)]
    return out


def _standardised(batch: pd.DataFrame, columns: list[str], med: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Gaps filled with the reference's median (0 where it has none), then its mean and population deviation."""
    x = batch[columns].to_numpy(float)
    return (np.where(np.isfinite(x), x, med) - mean) / sd


def isolation_scores(features: DataFrame, columns: list[str], trees: int = 200, size: int = 256, seed: int = 0) -> DataFrame:
    """dataset, episode_index, score, threshold, flagged. The threshold is the largest score of a reference episode by the trees that were grown without it.

    An episode whose draw is in every tree counts as 0 for the threshold.
    """
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    rows = features.select("dataset", "episode_index", *numbers)
    ref = rows.where(F.col("dataset") == "reference")
    known = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))
    medians = ref.agg(F.count("*").alias("n"), *[F.coalesce(F.median(known(c)), F.lit(0.0)).alias(c) for c in columns]).first()
    if not medians.n:
        return features.select("dataset", "episode_index", F.lit(None).cast("double").alias("score"), F.lit(None).cast("double").alias("threshold"), F.lit(False).alias("flagged"))
    filled = [F.coalesce(known(c), F.lit(medians[c])) for c in columns]
    moments = ref.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)], *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)]).first()
    med = np.array([medians[c] for c in columns])
    mean = np.array([moments[f"m{i}"] for i in range(len(columns))])
    sd = np.array([moments[f"s{i}"] for i in range(len(columns))])
    sd[sd < 1e-9] = 1.0

    # each tree's rows are those with the smallest hashes of (tree, row), out of all reference rows; a task keeps its own smallest only.
    # half of a small reference is left out of each tree, so that every row has trees that do not know it
    m = min(size, max(1, medians.n // 2))
    values = [F.col(c) for c in columns]

    def key(t) -> F.Column:
        return F.xxhash64(F.lit(seed), t, F.col("episode_index"), *values)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[pd.DataFrame] = [pd.DataFrame()] * trees
        for b in batches:
            hashes = np.stack(b["_keys"].to_numpy())
            for t in range(trees):
                own = b.drop(columns="_keys").assign(_tree=t, _key=hashes[:, t])
                best[t] = pd.concat([best[t], own.nsmallest(m, "_key")]).nsmallest(m, "_key") if len(best[t]) else own.nsmallest(m, "_key")
        yield from (x for x in best if len(x))

    named = ", ".join(f"`{c}` double" for c in columns)
    keyed = ref.select("episode_index", *columns, F.array(*[key(F.lit(t)) for t in range(trees)]).alias("_keys"))
    drawn = keyed.mapInPandas(draw, f"episode_index bigint, {named}, _tree int, _key bigint")

    def one_tree(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("_key", kind="stable").head(m)
        t = int(b["_tree"].iloc[0])
        x = _standardised(b, columns, med, mean, sd)
        tree = grow(x, np.random.default_rng([seed, t]), 0, int(np.ceil(np.log2(max(2, m)))))
        return pd.DataFrame({"t": [t], "tree": [pickle.dumps(tree)], "last": [int(b["_key"].iloc[-1])]})

    grown = drawn.groupBy("_tree").applyInPandas(one_tree, "t int, tree binary, last bigint").orderBy("t").collect()  # one row a tree
    model = [pickle.loads(bytes(r.tree)) for r in grown]
    last = np.array([r.last for r in grown])
    spark = features.sparkSession
    shared = spark.sparkContext.broadcast(model)
    norm = max(_harmonic(m), 1e-9)

    def depths(x: np.ndarray) -> np.ndarray:
        return np.stack([depth_of(t, x) for t in shared.value], axis=1)

    def held_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = depths(_standardised(b, columns, med, mean, sd))
            without = np.stack(b["_keys"].to_numpy()) > last if len(b) else np.zeros((0, len(last)), bool)
            n = without.sum(1)
            yield pd.DataFrame({"s": np.where(n > 0, 2 ** (-(d * without).sum(1) / np.maximum(n, 1) / norm), 0.0)})

    threshold = keyed.mapInPandas(held_out, "s double").agg(F.max("s").alias("s")).first().s

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["dataset", "episode_index"]].assign(score=2 ** (-depths(_standardised(b, columns, med, mean, sd)).mean(1) / norm))

    scored = rows.mapInPandas(score, "dataset string, episode_index bigint, score double")
    return scored.withColumns({"threshold": F.lit(threshold), "flagged": F.col("score") > threshold})
