import datetime as dt

from pyspark.sql import functions as F

from episoda.streaming import monitor

T0 = dt.datetime(2024, 1, 1)


def run(spark, stream, name, mode="append"):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name).collect()


def test_gap_monitor_and_windows(spark, tmp_path):
    times = [0.0, 0.1, 0.2, 0.9, 1.0, 1.0]
    rows = [("a", T0 + dt.timedelta(seconds=t), i) for i, t in enumerate(times)] + [("b", T0 + dt.timedelta(seconds=t), i) for i, t in enumerate((0.0, 0.1))]
    df = spark.createDataFrame(rows, "key string, ts timestamp, v bigint")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    alerts = run(spark, monitor.gaps(stream, "key", "ts", 0.1), "gaps_out")
    assert sorted((r.key, r.code, round(r.dt, 3)) for r in alerts) == [("a", "T_TIMESTAMP_GAP", 0.7), ("a", "T_TIMESTAMP_NON_MONOTONIC", 0.0)]
    counts = run(spark, monitor.windowed_counts(stream, "ts", ["key"], high=F.col("v") > 2), "counts_out", "complete")
    assert sorted((r.key, r.frames, r.high) for r in counts) == [("a", 6, 3), ("b", 2, 0)]
    batch = monitor.sessions(df, "ts", ["key"], "0.5 seconds").collect()
    assert sorted((r.key, r.frames) for r in batch) == [("a", 3), ("a", 3), ("b", 2)]
