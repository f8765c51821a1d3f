"""Runs, intervals and row positions within episodes: one gaps-and-islands helper serves them all.

All windows are partitioned by the episode's keys, so one shuffle on those keys serves several of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frame_window(keys: list[str], row: str = "row"):
    return Window.partitionBy(*keys).orderBy(row)


def number_rows(df: DataFrame, keys: list[str], order: list[str | Column], row: str = "row") -> DataFrame:
    """Positions from 0 within each episode, for sources that have no physical row number of their own."""
    return df.withColumn(row, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint"))


def runs(df: DataFrame, keys: list[str], flag: Column, row: str = "row", positional: bool = False, **more: Column) -> DataFrame:
    """One row per contiguous run of flagged rows: keys, start_row, end_row, frame_count, and aggregates `more` over the run's rows.

    A run breaks where row numbers do; with `positional` it breaks only at unflagged rows, so it may bridge rows that are missing.
    """
    w = frame_window(keys, row)
    place = F.row_number().over(w) if positional else F.col(row)
    flagged = df.withColumn("_place", place).where(flag) if positional else df.where(flag).withColumn("_place", place)
    islands = flagged.withColumn("_island", F.col("_place") - F.row_number().over(w))
    return islands.groupBy(*keys, "_island").agg(F.min(row).alias("start_row"), F.max(row).alias("end_row"), F.count("*").alias("frame_count"), *[c.alias(n) for n, c in more.items()]).drop("_island")


def longest_run(df: DataFrame, keys: list[str], flag: Column, row: str = "row", positional: bool = False) -> DataFrame:
    """keys, longest_run, start_row and end_row of the longest run, of equals the first; only episodes that have one."""
    found = runs(df, keys, flag, row, positional)
    best = F.max_by(F.struct("frame_count", "start_row", "end_row"), F.struct("frame_count", -F.col("start_row"))).alias("b")
    return found.groupBy(*keys).agg(best).select(*keys, F.col("b.frame_count").alias("longest_run"), F.col("b.start_row").alias("start_row"), F.col("b.end_row").alias("end_row"))


def clips(df: DataFrame, keys: list[str], usable: Column, least: int = 30, row: str = "row", **more: Column) -> DataFrame:
    """Runs of at least `least` usable frames."""
    return runs(df, keys, usable, row, **more).where(F.col("frame_count") >= least)


def issue_intervals(df: DataFrame, keys: list[str], code_list: str = "issue_codes", row: str = "row", detail: str | None = None, examples: int = 3) -> DataFrame:
    """Contiguous flagged rows with the sorted union of their codes and the first details."""
    more = {code_list: F.array_sort(F.array_distinct(F.flatten(F.collect_list(code_list))))}
    if detail:
        ordered = F.array_sort(F.collect_list(F.when(F.length(detail) > 0, F.struct(row, detail))))
        more["detail_examples"] = F.array_join(F.slice(F.array_distinct(F.transform(ordered, lambda x: x[detail])), 1, examples), " | ")
    return runs(df, keys, F.size(code_list) > 0, row, **more)


def carried(value: Column, keys: list[str], row: str = "row") -> Column:
    """The last value before this row that was not null: gaps are bridged."""
    return F.last_value(value, ignoreNulls=True).over(frame_window(keys, row).rowsBetween(Window.unboundedPreceding, -1))


def adjacent_duplicate(value: str, keys: list[str], row: str = "row") -> Column:
    """Whether the previous row has the same non-empty value; a missing value breaks the comparison."""
    before = F.lag(value).over(frame_window(keys, row))
    return F.coalesce((before == F.col(value)) & (before != ""), F.lit(False))


def hampel(value: str, keys: list[str], threshold: Column, row: str = "row", half: int = 2) -> Column:
    """Whether a value is further from the median of its 2*half+1 neighbourhood than the threshold."""
    around = F.collect_list(value).over(frame_window(keys, row).rowsBetween(-half, half))
    return F.abs(F.col(value) - array_median(around)) > threshold


def array_median(values: Column) -> Column:
    s = F.array_sort(values)
    n = F.size(s)
    upper, lower = F.get(s, F.floor(n / 2).cast("int")), F.get(s, (F.floor((n + 1) / 2) - 1).cast("int"))
    return F.when(n > 0, (upper + lower) / 2)


def interpolated(value: str, bad: Column, keys: list[str], row: str = "row") -> Column:
    """value with bad rows replaced by linear interpolation between the nearest good ones, flat beyond the ends."""
    w = frame_window(keys, row)
    good = F.when(~bad, F.struct(F.col(row).alias("r"), F.col(value).alias("v")))
    before = F.last_value(good, ignoreNulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first_value(good, ignoreNulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    slope = F.try_divide(after["v"] - before["v"], (after["r"] - before["r"]).cast("double"))
    between = before["v"] + F.coalesce(slope, F.lit(0.0)) * (F.col(row) - before["r"])
    return F.when(~bad, F.col(value)).otherwise(F.coalesce(between, before["v"], after["v"]))
