"""Plumbing that the corpus operators share: tables, scratch tables and Arrow batch helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. The cluster names it; only a session in one process (a test) gets a local one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        if context.applicationId not in _OWN:
            own = tempfile.mkdtemp(prefix="scratch-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _OWN[context.applicationId] = "file://" + own
        named = _OWN[context.applicationId]
    return named.rstrip("/")


def remove_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application, once nothing that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and a lost executor costs no recomputation of it.

    Tables stay below the application's id until `remove_scratch` is called. A written table also gives later joins a plain shuffle under each side, which adaptive execution can split by skew.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20, most_rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that no slice holds much more than most_bytes of the text column: memory stays bounded however long the texts are."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i in range(n):
            held += int(sizes[i])
            if held >= most_bytes or i - start + 1 >= most_rows:
                yield batch.slice(start, i - start + 1)
                start, held = i + 1, 0
        if start < n:
            yield batch.slice(start)


def free_name(df: DataFrame, hint: str) -> str:
    """A column name that df does not have, whatever names it has (Spark compares names without case)."""
    taken, name = {c.lower() for c in df.columns}, f"_own_{hint}"
    while name in taken:
        name += "_"
    return name


def forget_tables() -> None:
    """Drop the word tables that an earlier operator left in this Python worker; workers are used again and again."""
    for module, name in (("episoda.llm.tokens", "word_encoder"), ("episoda.llm.bpe_automaton", "codec")):
        if module in sys.modules:
            getattr(sys.modules[module], name).cache_clear()


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def bucket_of(doc_id: str = "doc_id", mod: int = 5) -> F.Column:
    """crc32 of doc_id as text, modulo mod. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: F.Column, limit: int) -> DataFrame:
    """At most `limit` labelled training documents as (doc_id, y, text), chosen by a hash of the id.

    Ids that are null, held out, or labelled with both or with other values than 0 and 1 are left out. The id list has at most `limit` rows,
    so it is broadcast; of rows that repeat an id the smallest text counts, so the result has at most `limit` rows too.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("most"))
        .where("y = most AND y IN (0, 1)")
        .select("doc_id", "y")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
