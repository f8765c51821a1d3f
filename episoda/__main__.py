"""Command line: check inputs, detect, enrich, govern.

python -m episoda check  --reference DIR --test DIR [--expect-reference N] [--expect-test N]
python -m episoda detect --reference DIR --test DIR --out DIR [--size W H] [--fps F]
python -m episoda enrich --out DIR          (freeze overlay, confidence, sensitivity, unsupervised scores, training worth)
python -m episoda govern --out DIR          (queue, work orders, masks, clips, policies)

Every stage is a Parquet table below --out under its own name and version; later verbs read what earlier ones wrote.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episoda.operators import governance, rules, score
from episoda.plans import detect
from episoda.sources import episodes, sinks

PROFILE = ("structural_frames", "structural_episodes", "value_frames", "value_episodes", "image_frames", "image_episodes")


def session() -> SparkSession:
    return SparkSession.builder.appName("episoda").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def saved(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{name}/v1")


def load_profile(spark: SparkSession, out: str) -> detect.Profile:
    tables = {n: saved(spark, out, n) for n in (*PROFILE, "files", "metadata")}
    return detect.Profile(tables["files"], tables["metadata"], None, tables["structural_frames"], tables["structural_episodes"], tables["value_frames"], tables["value_episodes"], tables["image_frames"], tables["image_episodes"])


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, root, expected in (("reference", args.reference, args.expect_reference), ("test", args.test, args.expect_test)):
        table = episodes.files(spark, root, name)
        if expected is not None:
            episodes.check_count(table, expected)
        table.groupBy(F.coalesce("defect", F.lit("sound")).alias("state")).agg(F.count("*").alias("files"), F.sum("footer_rows").alias("frames")).show()


def run_detect(spark: SparkSession, args: argparse.Namespace) -> None:
    config = detect.Config(size=(*args.size, 3), nominal_dt=1.0 / args.fps)
    files, meta, raw = detect.read(spark, {"reference": args.reference, "test": args.test})
    files, meta = sinks.stage(files, args.out, "files"), sinks.stage(meta, args.out, "metadata")
    p = detect.profile(files, meta, raw, args.out, config)
    for name in ("structural_episodes", "value_episodes", "image_episodes"):
        setattr(p, name, sinks.stage(getattr(p, name), args.out, name))
    thresholds = sinks.stage(detect.reference_of(p), args.out, "thresholds")
    flags, report = detect.detect(p, thresholds, config)
    sinks.stage(flags, args.out, "frame_flags")
    report = sinks.stage(report, args.out, "quality_report")
    report.groupBy("dataset", "severity").count().orderBy("dataset", "severity").show()


def enrich(spark: SparkSession, args: argparse.Namespace) -> None:
    p, report, flags = load_profile(spark, args.out), saved(spark, args.out, "quality_report"), saved(spark, args.out, "frame_flags")
    grid, intervals = detect.freeze(p)
    sinks.stage(grid, args.out, "freeze_grid")
    if intervals is not None:
        intervals = sinks.stage(intervals, args.out, "freeze_intervals")
    enriched = detect.overlay(report, intervals).withColumn("confidence", rules.confidence(F.col("issue_codes")))
    enriched = sinks.stage(enriched, args.out, "quality_report_enriched")
    sinks.stage(governance.tier_histogram(enriched.where("dataset <> 'reference'")), args.out, "confidence_tiers")
    sinks.stage(governance.weight_sensitivity(enriched.where("dataset <> 'reference'"), score.WEIGHTS, "episode_index"), args.out, "weight_sensitivity")
    sinks.stage(detect.unsupervised(p), args.out, "unsupervised")
    sinks.stage(detect.training_worth(p, flags), args.out, "training_worth")
    sinks.stage(governance.ablation(enriched, flags), args.out, "ablation")


def govern(spark: SparkSession, args: argparse.Namespace) -> None:
    try:
        report = saved(spark, args.out, "quality_report_enriched")
    except Exception:  # not enriched yet
        report = saved(spark, args.out, "quality_report")
    for name, table in detect.govern(report, saved(spark, args.out, "frame_flags")).items():
        sinks.stage(table, args.out, name)
    saved(spark, args.out, "release_summary").show(truncate=False)


def main() -> None:
    parser = argparse.ArgumentParser(prog="episoda", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("verb", choices=("check", "detect", "enrich", "govern"))
    parser.add_argument("--reference")
    parser.add_argument("--test")
    parser.add_argument("--out")
    parser.add_argument("--size", type=int, nargs=2, default=(224, 224))
    parser.add_argument("--fps", type=float, default=10.0)
    parser.add_argument("--expect-reference", type=int)
    parser.add_argument("--expect-test", type=int)
    args = parser.parse_args()
    {"check": check, "detect": run_detect, "enrich": enrich, "govern": govern}[args.verb](session(), args)


if __name__ == "__main__":
    main()
