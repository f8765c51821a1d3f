"""Episode datasets: Parquet files of frames with metadata beside them, read without failing on damaged ones."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episoda.operators.images import STREAMS
from episoda.sources import inventory

_IMAGE = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])
SCHEMA = T.StructType(
    [T.StructField("timestamp", T.FloatType()), *[T.StructField(n, T.LongType()) for n in ("frame_index", "episode_index", "index", "task_index")]]
    + [T.StructField(n, T.ArrayType(T.FloatType())) for n in ("state", "actions")]
    + [T.StructField(s, _IMAGE) for s in STREAMS]
)
STRUCTURAL = ("timestamp", "frame_index", "episode_index", "index", "task_index", "state", "actions")
#: Types that the schema above reads; a file with others would be skipped silently.
_KINDS = {"timestamp": {"float"}, **{c: {"int32", "int64"} for c in ("frame_index", "episode_index", "index", "task_index")}, **{c: {"list<item: float>", "list<element: float>", "fixed_size_list<item: float>[20]", "fixed_size_list<element: float>[20]"} for c in ("state", "actions")}}
_DEFECT = "path string, length bigint, rows bigint, defect string"


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Why a file cannot be read, from its own bytes: whole file corrupt, or a column missing."""
    import pyarrow.parquet as pq

    for batch in batches:
        rows: list = []
        for content in batch.column("content").to_pylist():
            try:
                f = pq.ParquetFile(pa.BufferReader(content))
            except (pa.ArrowException, OSError, ValueError):
                rows.append((None, "corrupt"))
                continue
            have = set(f.schema_arrow.names)
            part = "image" if any(s not in have for s in STREAMS) else None
            part = "structural" if any(c not in have for c in STRUCTURAL) else part
            other = any(str(f.schema_arrow.field(c).type) not in kinds for c, kinds in _KINDS.items() if c in have)
            rows.append((f.metadata.num_rows, f"missing_column:{part}" if part else "unreadable" if other else None))
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["path", "length", "rows", "defect"])


def files(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """dataset, episode_index, source_file, length, footer_rows, defect (null if sound) of every episode file, by number.

    An explicit schema reads a missing column as null and damaged files can be skipped silently, so both are looked for here. An episode
    file is small by design (hundreds of frames); it has to fit in a row.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "episode_*.parquet").option("recursiveFileLookup", True).load(root)
    known = raw.select("path", "length", "content").mapInArrow(_footers, _DEFECT)
    return known.select(F.lit(dataset).alias("dataset"), inventory.episode_of().alias("episode_index"), F.col("path").alias("source_file"), "length", F.col("rows").alias("footer_rows"), "defect")


def frames(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """All readable frames: dataset, episode_index (of the file), row (physical place), episode_index_value (of the column) and the columns.

    The place in the file is taken before any shuffle; it is not the frame index, whose faults are to be found. Columns are pruned by
    whoever reads only some.
    """
    raw = spark.read.schema(SCHEMA).option("pathGlobFilter", "episode_*.parquet").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).parquet(root)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"episode_(\d+)", 1).cast("bigint")
    own = [c for c in SCHEMA.names if c != "episode_index"]
    return raw.select(F.lit(dataset).alias("dataset"), number.alias("episode_index"), F.col("_metadata.row_index").alias("row"), F.col("episode_index").alias("episode_index_value"), *own)


def metadata(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """dataset, episode_index, length, tasks of meta/episodes.jsonl; blank and malformed lines are skipped, of repeated ids the last line wins."""
    from pyspark.sql import Window

    text = spark.read.text(f"{root}/meta/episodes.jsonl")
    row = F.from_json("value", "episode_index bigint, length bigint, tasks array<string>, broken string", {"columnNameOfCorruptRecord": "broken"})
    lines = text.where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("line"), row.alias("r")).where("r IS NOT NULL AND r.broken IS NULL")
    last = Window.partitionBy("episode_index").orderBy(F.desc("line"))
    rows = lines.select("line", F.coalesce("r.episode_index", F.lit(-1)).alias("episode_index"), "r.length", "r.tasks")
    return rows.withColumn("k", F.row_number().over(last)).where("k = 1").select(F.lit(dataset).alias("dataset"), "episode_index", "length", "tasks")


def tasks(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("task string, task_index bigint").json(f"{root}/meta/tasks.jsonl")


def info(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("total_episodes bigint, total_frames bigint, splits map<string,string>").option("multiLine", True).json(f"{root}/meta/info.json")


def check_count(file_table: DataFrame, expected: int) -> None:
    """Fail loudly when a dataset has not the episodes it should have."""
    found = file_table.count()
    if found != expected:
        raise ValueError(f"{found} episode files, expected {expected}")
