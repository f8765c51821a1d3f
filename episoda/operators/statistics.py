"""Exact robust statistics over non-finite-safe columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episoda.functions.scalars import finite


def quantile(value: Column, q: float) -> Column:
    """Exact linear-interpolated quantile of the finite values."""
    return F.percentile(finite(value), F.lit(q))


def with_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """df with a column for each name: that exact linear-interpolated quantile of the finite values within keys, null without any.

    Between its neighbours a and b a quantile is fma(1 - t, a, t * b), rounded as DuckDB's quantile_cont rounds it: steps that differ in their
    last bit only are then on the same side of it. `percentile` rounds the two products apart. All windows share the keys' shuffle.
    """
    x, w = finite(F.col(value)), Window.partitionBy(*keys)
    ranked = df.withColumns({"_rank": F.row_number().over(w.orderBy(x.asc_nulls_last())) - 1, "_last": F.count(x).over(w) - 1})
    place = {n: F.lit(float(q)) * F.col("_last") for n, q in quantiles.items()}
    at = lambda p: F.max(F.when(F.col("_rank") == p, x)).over(w)
    near = ranked.withColumns({f"_{side}_{n}": at(f(p)) for n, p in place.items() for side, f in (("a", F.floor), ("b", F.ceil))})
    fused = {n: _fma(1 - (p - F.floor(p)), F.col(f"_a_{n}"), (p - F.floor(p)) * F.col(f"_b_{n}")) for n, p in place.items()}
    return near.withColumns(fused).drop("_rank", "_last", *[f"_{side}_{n}" for n in quantiles for side in "ab"])


def _fma(a: Column, b: Column, c: Column) -> Column:
    """a * b + c rounded once; null where b is. Catalyst has no such expression; a double's text is read back as the same double."""
    none = F.lit(0.0)
    return F.when(b.isNotNull(), F.reflect(F.lit("java.lang.Math"), F.lit("fma"), *[F.coalesce(v.cast("double"), none) for v in (a, b, c)]).cast("double"))


def robust(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """keys with {name}_n, _median, _mad, _p01, _p99 of the finite values. The deviation needs the median first: one shuffle serves both passes."""
    x = finite(F.col(value))
    centred = df.select(*keys, x.alias("_x"), F.percentile(x, F.lit(0.5)).over(Window.partitionBy(*keys)).alias("_m"))
    return centred.groupBy(*keys).agg(
        F.count("_x").alias(f"{name}_n"),
        F.first("_m").alias(f"{name}_median"),
        F.percentile(F.abs(F.col("_x") - F.col("_m")), F.lit(0.5)).alias(f"{name}_mad"),
        F.percentile("_x", F.lit(0.01)).alias(f"{name}_p01"),
        F.percentile("_x", F.lit(0.99)).alias(f"{name}_p99"),
    )


def smallest_mode(value: Column) -> Column:
    """Most frequent value, of equals the smallest."""
    return F.mode(value, True)


def normalised_entropy(counts: DataFrame, n: str = "n") -> DataFrame:
    """balance (least over most frequent) and base-2 entropy over its maximum, of one row per kind; entropy is 0 for a single kind."""
    total = counts.agg(F.sum(n).alias("total"), F.count("*").alias("kinds"), F.min(n).alias("least"), F.max(n).alias("most"))
    p = F.col(n) / F.col("total")
    joined = counts.crossJoin(F.broadcast(total))  # one row on the right
    return joined.agg(F.first(F.col("least") / F.col("most")).alias("balance"), F.coalesce(F.try_divide(F.sum(-p * F.log2(p)), F.first(F.log2(F.col("kinds").cast("double")))), F.lit(0.0)).alias("entropy"))


def binary_metrics(df: DataFrame, truth: Column, predicted: Column, keys: list[str] = ()) -> DataFrame:
    """tp, fp, fn, precision, recall, f1; a measure without denominator is 0."""
    tp, fp, fn = F.count_if(truth & predicted), F.count_if(~truth & predicted), F.count_if(truth & ~predicted)
    counts = df.groupBy(*keys).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    c = {n: F.col(n) for n in ("tp", "fp", "fn")}
    return counts.withColumns({"precision": ratio(c["tp"], c["tp"] + c["fp"]), "recall": ratio(c["tp"], c["tp"] + c["fn"]), "f1": ratio(2 * c["tp"], 2 * c["tp"] + c["fp"] + c["fn"])})


def population_z(value: str, keys: list[str], least: int = 5) -> Column:
    """Population z-score within keys, 0 for what is not finite; all 0 with fewer than `least` finite values or no spread."""
    w = Window.partitionBy(*keys)
    x = finite(F.col(value))
    sd, mean, n = F.stddev_pop(x).over(w), F.avg(x).over(w), F.count(x).over(w)
    return F.when((n < least) | (sd < 1e-9), 0.0).otherwise(F.coalesce(F.try_divide(x - mean, sd), F.lit(0.0)))


def impute_and_standardise(df: DataFrame, columns: list[str], is_reference: Column) -> DataFrame:
    """Each column with gaps filled by the reference's median and scaled by the reference's mean and population deviation (1 where that is nil)."""
    ref = df.where(is_reference)
    med = ref.agg(*[F.percentile(finite(F.col(c)), F.lit(0.5)).alias(f"_m_{c}") for c in columns])
    filled = df.crossJoin(F.broadcast(med)).withColumns({c: F.coalesce(finite(F.col(c)), F.col(f"_m_{c}"), F.lit(0.0)) for c in columns}).drop(*[f"_m_{c}" for c in columns])
    moments = filled.where(is_reference).agg(*[F.avg(c).alias(f"_a_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    scaled = filled.crossJoin(F.broadcast(moments))
    scale = lambda c: (F.col(c) - F.col(f"_a_{c}")) / F.when(F.col(f"_s_{c}") < 1e-9, 1.0).otherwise(F.col(f"_s_{c}"))
    return scaled.withColumns({f"{c}_z": scale(c) for c in columns}).drop(*[f"_{k}_{c}" for c in columns for k in "as"])
