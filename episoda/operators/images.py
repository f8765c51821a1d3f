"""Image profile: three camera streams unpivoted to rows, decoded once, compared with their neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episoda.functions import pixels, vectors
from episoda.operators.sequence import adjacent_duplicate, frame_window
from episoda.operators.statistics import quantile
from episoda.operators.structural import KEYS

STREAMS = ("image", "left_wrist_image", "right_wrist_image")
STREAM_KEYS = [*KEYS, "stream"]
SIZE = (224, 224, 3)
DARK, BRIGHT, FLAT = 0.95, 0.95, 5.0


def prefix(stream: str) -> str:
    return stream.replace("_image", "")


def frames(raw: DataFrame) -> DataFrame:
    """One row per (episode, row, stream) of raw with the three image structs. Pixels are decoded before any shuffle, and only measures and a
    64x64 thumbnail go through it; the thumbnail ends at the neighbour comparison."""
    streams = F.array(*[F.struct(F.lit(s).alias("stream"), F.col(f"{s}.bytes").alias("payload"), F.col(f"{s}.path").alias("path")) for s in STREAMS])
    rows = raw.select(*KEYS, "row", "timestamp", F.col("frame_index").try_cast("bigint").alias("frame_index"), F.explode(streams).alias("x")).select(*KEYS, "row", "timestamp", "frame_index", "x.*")
    keys = [*KEYS, "row", "timestamp", "frame_index", "stream", "path"]
    schema = T.StructType([rows.schema[k] for k in keys] + T._parse_datatype_string(pixels.DECODED).fields)
    decoded = rows.mapInArrow(pixels.decode_rows(keys), schema)
    w = frame_window(STREAM_KEYS)
    place = F.regexp_extract(F.coalesce("path", F.lit("")), r"frame_(\d+)\.png", 1)
    decoded = decoded.withColumns(
        {
            "adjacent_exact_duplicate": adjacent_duplicate("sha1", STREAM_KEYS),
            "adjacent_ahash_distance": vectors.hamming(F.col("ahash"), F.lag("ahash").over(w)),
            "path_frame_index": F.when(place != "", place.cast("bigint")),
            "before": F.lag("thumb").over(w),
        }
    ).withColumn("path_delta", F.col("path_frame_index") - F.col("frame_index"))
    out = T.StructType([f for f in decoded.schema.fields if f.name not in ("thumb", "before")] + [T.StructField("motion_mad_prev", T.DoubleType())])
    return decoded.mapInArrow(pixels.motion_rows, out)


def _size_differs(size: tuple[int, int, int]) -> Column:
    w, h, c = size
    return F.coalesce((F.col("width") != w) | (F.col("height") != h) | (F.col("channels") != c), F.lit(True))


def episodes(frame_table: DataFrame, size: tuple[int, int, int] = SIZE) -> DataFrame:
    """Measures of each stream side by side, and totals over the streams."""
    ok, wrong = F.col("decode_ok"), _size_differs(size)
    median = lambda c: quantile(F.col(c).cast("double"), 0.5)
    measures = {
        "decode_bad_count": F.count_if(~ok), "shape_bad_count": F.count_if(wrong), "missing_count": F.count_if(~F.col("payload_present")),
        "dark_frame_count": F.count_if(F.col("dark_fraction") >= DARK), "bright_frame_count": F.count_if(F.col("bright_fraction") >= BRIGHT),
        "low_contrast_count": F.count_if(F.col("std_luma") <= FLAT), "exact_duplicate_adjacent_count": F.count_if("adjacent_exact_duplicate"),
        "path_mismatch_count": F.count_if(F.coalesce("path_delta", F.lit(0)) != 0),
        "ahash_distance_p01": quantile(F.col("adjacent_ahash_distance").cast("double"), 0.01), "ahash_distance_median": median("adjacent_ahash_distance"),
        "ahash_distance_p99": quantile(F.col("adjacent_ahash_distance").cast("double"), 0.99),
        "byte_size_median": median("byte_size"), "std_luma_median": median("std_luma"), "gradient_energy_median": median("gradient_energy"), "laplacian_var_median": median("laplacian_var"),
    }
    by_stream = frame_table.groupBy(*STREAM_KEYS).agg(*[c.alias(n) for n, c in measures.items()])
    wide = by_stream.withColumn("stream", F.regexp_replace("stream", "_image", "")).groupBy(*KEYS).pivot("stream", [prefix(s) for s in STREAMS]).agg(*[F.first(n).alias(n) for n in measures])
    summed = ("decode_bad_count", "missing_count", "shape_bad_count", "dark_frame_count", "bright_frame_count", "low_contrast_count", "exact_duplicate_adjacent_count", "path_mismatch_count")
    totals = by_stream.groupBy(*KEYS).agg(*[F.sum(n).alias(f"any_{n}") for n in summed], F.sum(F.greatest(F.lit(0), F.col("decode_bad_count") - F.col("missing_count"))).alias("any_decode_corrupt_count"))
    screen = (F.col("dark_fraction") >= DARK) | (F.col("bright_fraction") >= BRIGHT) | (F.col("std_luma") <= FLAT)
    by_frame = frame_table.groupBy(*KEYS, "row").agg(F.bool_or(~ok | wrong | F.coalesce(screen, F.lit(False))).alias("bad"))
    rows = by_frame.groupBy(*KEYS).agg(F.count("*").alias("rows"), F.count_if("bad").alias("any_image_bad_frame_count"))
    return rows.join(wide, KEYS).join(totals, KEYS)
