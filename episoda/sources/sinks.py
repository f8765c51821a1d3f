"""Writers: stage tables, repaired copies with masks and manifest, JSON lines, small exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["dataset", "episode_index"]


def stage(df: DataFrame, root: str, name: str, version: str = "v1") -> DataFrame:
    """Write a stage under its own version and read it back. A stage is never rewritten from itself: the next version is another path."""
    path = f"{root}/{name}/{version}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repaired_copies(frames: DataFrame, root: str) -> None:
    """One directory per episode; rows keep their order within the single file of an episode."""
    ordered = frames.repartition(*KEYS).sortWithinPartitions(*KEYS, "row")
    ordered.write.mode("overwrite").partitionBy(*KEYS).parquet(root)


def masks(mask_table: DataFrame, root: str) -> None:
    """Sidecar masks as CSV, one directory per episode."""
    flat = mask_table.select(*[F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in mask_table.dtypes])
    flat.repartition(*KEYS).sortWithinPartitions(*KEYS, "row").write.mode("overwrite").partitionBy(*KEYS).option("header", True).csv(root)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def summary_document(df: DataFrame) -> str:
    """A one-row table as a JSON document."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).first().j


def csv_export(df: DataFrame, path: str) -> None:
    """A small result as one CSV file with a header that begins with a byte-order mark, for spreadsheets."""
    flat = df.select(*[F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    flat = flat.withColumnRenamed(flat.columns[0], "\ufeff" + flat.columns[0])
    flat.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def markdown(df: DataFrame, limit: int = 200) -> str:
    """The first rows of a report as a Markdown table."""
    rows = df.limit(limit).collect()
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *[line(r) for r in rows]])


def digests(spark: SparkSession, root: str, dataset: str | None = None, pattern: str = "*.parquet") -> DataFrame:
    """dataset, path, sha256 of files, for the manifest of sources and copies; without a name the dataset is read from a folder dataset=NAME of the path."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    named = F.lit(dataset) if dataset is not None else F.nullif(F.regexp_extract("path", r"dataset=([^/]+)/", 1), F.lit(""))
    return raw.select(named.alias("dataset"), "path", F.sha2("content", 256).alias("sha256"))


def manifest(repaired: DataFrame, source_digests: DataFrame, copy_digests: DataFrame, version: str) -> DataFrame:
    """Per repaired episode of a dataset: what was changed, by which version and when, with the digests of its own source and copy."""
    number = lambda c: F.coalesce(F.regexp_extract(c, r"episode_(\d+)\.parquet", 1).try_cast("bigint"), F.regexp_extract(c, r"episode_index=(\d+)/", 1).try_cast("bigint"))
    src = source_digests.select("dataset", number("path").alias("episode_index"), F.col("path").alias("source_file"), F.col("sha256").alias("source_sha256"))
    dst = copy_digests.select("dataset", number("path").alias("episode_index"), F.col("path").alias("repaired_file"), F.col("sha256").alias("repaired_sha256"))
    joined = repaired.join(src, KEYS, "left").join(dst, KEYS, "left")
    return joined.withColumns({"version": F.lit(version), "created_utc": F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")})


def copy_unchanged(spark: SparkSession, source: str, target: str) -> None:
    """Byte copy for repairs that touch metadata only, through the store's own file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    a, b = path(source), path(target)
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf):
        raise OSError(f"{source} was not copied")
