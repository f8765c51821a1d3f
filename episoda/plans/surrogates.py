"""The supplied tables seen as episodes: users' events, orders' lines, labels' vectors stand in for robot frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episoda.functions.scalars import categories, codes
from episoda.operators.sequence import number_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Events as frames of their user: row in time order, dt in seconds to the event before."""
    df = table(spark, sf_dir, "events").drop("props")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    df = number_rows(df, ["user_id"], ["ts", "event_id"])
    df = df.withColumn("_before", F.lag("ts").over(w)).withColumn("dt", F.expr("timestampdiff(MICROSECOND, _before, ts)") / 1e6).drop("_before")
    if "episode_index" in keys:
        df = df.withColumns({"dataset": F.lit("test"), "episode_index": F.col("user_id"), "frame_index": F.col("row")})
    return df


def flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with issue codes, as governed frames."""
    df = events(spark, sf_dir, ("dataset", "episode_index"))
    found = codes(("T_TIMESTAMP_GAP", F.col("dt") > 150_000), ("C_IMAGE_DECODE", (F.col("event_type") == "error") & (F.col("value") > 100)), ("V_SPIKE_JUMP", F.col("value") >= 150))
    df = df.withColumn("issue_codes", found)
    return df.withColumn("issue_categories", categories(F.col("issue_codes")))


def event_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: status, the union of codes and a repair mode by their number."""
    flags = flagged_events(spark, sf_dir)
    all_codes = F.array_sort(F.array_distinct(F.flatten(F.collect_list("issue_codes"))))
    r = flags.groupBy("dataset", "episode_index").agg(F.count("*").alias("rows"), all_codes.alias("issue_codes"), F.count_if(F.size("issue_codes") > 0).alias("bad"))
    status = F.when(F.col("bad") <= 1, "pass").otherwise("review")
    mode = F.when(F.size("issue_codes") >= 3, "isolate").when(F.size("issue_codes") == 2, "mark_and_recollect").when(F.size("issue_codes") == 1, "auto_repair").otherwise("none")
    return r.withColumns({"status": status, "repair_mode": mode, "overall_quality_score": F.round(100 * (1 - F.col("bad") / F.col("rows")), 6)})


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as frames of their order, in shipping order; the line number is the frame index."""
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    df = number_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order)
    w = Window.partitionBy("l_orderkey").orderBy("row")
    return df.withColumn("frame_diff", F.col("l_linenumber") - F.lag("l_linenumber").over(w))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frames of their label: elements 1-20 are the state, 21-40 the action."""
    df = table(spark, sf_dir, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    return df.select("label", "vec_id", F.slice("v", 1, 20).alias("state"), F.slice("v", 21, 20).alias("action"))


def order_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the evidence of their lines as episode reports: codes, scores, severity, repair mode."""
    from episoda.functions.scalars import safe_ratio
    from episoda.operators import score

    li = lines(spark, sf_dir).groupBy("l_orderkey").agg(
        F.count("*").alias("rows"), F.count_if(F.col("frame_diff") != 1).alias("breaks"), F.count_if(F.col("l_discount") >= 0.1).alias("dim"),
        F.count_if(F.col("l_extendedprice") > 90_000).alias("over"), F.count_distinct("l_linestatus").alias("states"), F.max("l_linenumber").alias("expected"),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "full")
    o = o.withColumn("episode", F.coalesce("o_orderkey", "l_orderkey")).fillna(0, ["rows", "breaks", "dim", "over", "states", "expected"])
    delta = F.col("rows") - F.col("expected")
    found = codes(
        ("C_FILE_READ_ERROR", F.col("l_orderkey").isNull()), ("T_METADATA_LENGTH_MISMATCH", F.abs(delta) > 1), ("T_FRAME_ORDER_ERROR", F.col("breaks") > 4),
        ("S_TASK_SWITCH_WITHIN_EPISODE", (F.col("states") > 1) & (F.col("o_orderstatus") == "P")), ("C_IMAGE_SCREEN", F.col("dim") > 1), ("V_PHYSICAL_RANGE", F.col("over") > 0),
    )
    o = o.withColumns({"issue_codes": found, "length_delta": delta})
    rows = F.col("rows")
    o = o.withColumns(
        {
            "structural_score": score.score(safe_ratio(F.abs(delta), rows), 1.5),
            "temporal_score": score.score(safe_ratio(F.col("breaks"), rows), 0.5),
            "sync_score": score.score(F.when(F.col("states") > 1, 0.25).otherwise(0.0), 2.0),
            "content_score": score.score(safe_ratio(F.col("dim"), rows), 1.5),
            "value_score": score.score(safe_ratio(F.col("over"), rows), 1.25),
        }
    )
    total = F.when(rows == 0, 0.0).otherwise(score.overall())
    o = o.withColumn("overall_quality_score", F.round(total, 6)).withColumn("severity", score.severity(F.col("issue_codes"), F.col("overall_quality_score"), rows > 0))
    repairable, lost = score.repair_lists(F.col("issue_codes"), delta.cast("double"), safe_ratio(F.col("over"), rows), safe_ratio(F.col("dim"), rows))
    o = o.withColumns({"repairable_codes": repairable, "unrecoverable_codes": lost})
    return o.withColumn("repair_mode", score.repair_mode(F.col("issue_codes"), F.col("repairable_codes"), F.col("unrecoverable_codes")))


def joined(code_list: str, name: str | None = None):
    return F.array_join(code_list, ";").alias(name or code_list)
