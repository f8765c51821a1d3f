"""File inventory: which files a dataset has and which of them are damaged, without failing on any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, root: str, pattern: str = "episode_*.parquet") -> DataFrame:
    """path, length of every matching file below root; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root).select("path", "length")


def count(spark: SparkSession, root: str, pattern: str = "episode_*.parquet") -> int:
    return files(spark, root, pattern).count()


def episode_of(path: str = "path") -> F.Column:
    return F.regexp_extract(path, r"episode_(\d+)\.parquet$", 1).try_cast("bigint")
