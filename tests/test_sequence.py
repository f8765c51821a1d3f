import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from episoda.operators import crossmodal, governance, repair, sequence, statistics, validate

K = ["e"]


def frames(spark, flags, start=0):
    return spark.createDataFrame([(1, start + i, bool(f)) for i, f in enumerate(flags)], "e bigint, row bigint, f boolean")


def runs_by_hand(flags):
    out, at = [], None
    for i, f in enumerate([*flags, False]):
        if f and at is None:
            at = i
        if not f and at is not None:
            out.append((at, i - 1, i - at))
            at = None
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_and_longest(spark, seed):
    rng = random.Random(seed)
    flags = [rng.random() < 0.6 for _ in range(60)]
    df = frames(spark, flags).repartition(5)
    got = sorted(tuple(r)[1:] for r in sequence.runs(df, K, F.col("f")).collect())
    assert got == runs_by_hand(flags)
    best = max(runs_by_hand(flags), key=lambda r: (r[2], -r[0]))
    r = sequence.longest_run(df, K, F.col("f")).first()
    assert (r.start_row, r.end_row, r.longest_run) == best
    assert sorted(r.frame_count for r in sequence.clips(df, K, F.col("f"), 4).collect()) == sorted(n for *_, n in runs_by_hand(flags) if n >= 4)


def test_positional_runs_bridge_missing_rows(spark):
    df = spark.createDataFrame([(1, r, True) for r in (0, 1, 5, 6)], "e bigint, row bigint, f boolean")
    assert [r.frame_count for r in sequence.runs(df, K, F.col("f"), positional=True).collect()] == [4]
    assert sorted(r.frame_count for r in sequence.runs(df, K, F.col("f")).collect()) == [2, 2]
    assert sequence.longest_run(frames(spark, [0, 0]), K, F.col("f")).count() == 0


def test_interpolation_is_flat_beyond_the_ends(spark):
    df = spark.createDataFrame([(1, i, v, b) for i, (v, b) in enumerate([(9.0, True), (1.0, False), (9.0, True), (9.0, True), (4.0, False), (9.0, True)])], "e bigint, row bigint, v double, b boolean")
    got = [r.x for r in df.withColumn("x", sequence.interpolated("v", F.col("b"), K)).orderBy("row").collect()]
    assert got == [1, 1, 2, 3, 4, 4]


def test_duplicates_reset_or_carry_over_gaps(spark):
    df = spark.createDataFrame([(1, i, h) for i, h in enumerate(["a", "a", "", "a", "b"])], "e bigint, row bigint, h string")
    gap = F.when(F.col("h") != "", F.col("h"))
    r = df.select("row", sequence.adjacent_duplicate("h", K).alias("d"), (sequence.carried(gap, K) == F.col("h")).alias("c")).orderBy("row").collect()
    assert [x.d for x in r] == [False, True, False, False, False]
    assert [bool(x.c) for x in r] == [False, True, False, True, False]


def test_robust_statistics_leave_out_what_is_not_finite(spark):
    df = spark.createDataFrame([(1, x) for x in (1.0, 2.0, 3.0, 4.0, float("nan"), float("inf"), None)], "e bigint, v double")
    r = statistics.robust(df, K, "v", "v").first()
    assert (r.v_n, r.v_median, r.v_mad, r.v_p01, r.v_p99) == (4, 2.5, 1.0, pytest.approx(1.03), pytest.approx(3.97))


def test_binary_metrics_without_positives(spark):
    df = spark.createDataFrame([(False, False)], "t boolean, p boolean")
    r = statistics.binary_metrics(df, F.col("t"), F.col("p")).first()
    assert (r.precision, r.recall, r.f1) == (0, 0, 0)


def test_leave_one_out_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 6, 400), rng.gamma(2, 1, 400))]
    df = spark.createDataFrame(rows, "k bigint, v double")
    got = {r.k: (r.n, r.threshold, r.flagged) for r in validate.leave_one_out(df, "k", "v", 0.97, 0.5, 1.1).collect()}
    for k in range(6):
        own, rest = [v for a, v in rows if a == k], [v for a, v in rows if a != k]
        t = max(0.5, 1.1 * np.quantile(rest, 0.97))
        assert got[k][0] == len(own) and got[k][1] == pytest.approx(t) and got[k][2] == sum(v > t for v in own)


def test_bootstrap_interval_contains_the_measure(spark):
    df = spark.createDataFrame([(i % 2 == 0, i % 2 == 0 or i % 10 == 1) for i in range(200)], "t boolean, p boolean")
    got = {r.metric: (r.low, r.high) for r in validate.bootstrap(df, "t", "p", 400).collect()}
    assert got["precision"][0] < 100 / 120 < got["precision"][1] and got["recall"] == (1.0, 1.0)


def test_bootstrap_by_category_equals_resampled_rows(spark):
    """Against a bootstrap that draws the rows themselves; a category without both classes has no interval."""
    import numpy as np

    rng = np.random.default_rng(4)
    report, truth = [], []
    for i in range(120):
        faulty, found = rng.random() < 0.4, rng.random()
        truth.append((i, ["value"] if faulty else []))
        report.append((i, ["value"] if found < (0.8 if faulty else 0.2) else []))
    kind = "episode_index bigint, {} array<string>"
    r, t = spark.createDataFrame(report, kind.format("issue_categories")), spark.createDataFrame(truth[:110], kind.format("categories"))
    got = {(x.scope, x.metric): (x.low, x.high, x.draws) for x in validate.fault_intervals(r, t, ("value", "content"), 1500).collect()}
    assert {k[0] for k in got} == {"overall", "value"} and len(got) == 6
    y = np.array([bool(c) and i < 110 for i, c in truth])
    p = np.array([bool(c) for _, c in report])
    drawn = []
    for _ in range(3000):
        k = rng.integers(0, 120, 120)
        tp, fp, fn = (y[k] & p[k]).sum(), (~y[k] & p[k]).sum(), (y[k] & ~p[k]).sum()
        drawn.append((tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn)))
    for m, want in zip(("precision", "recall", "f1"), np.percentile(drawn, [2.5, 97.5], axis=0).T, strict=True):
        for scope in ("overall", "value"):
            assert np.allclose(got[scope, m][:2], want, atol=0.04) and got[scope, m][2] == 1500
    none = spark.createDataFrame([], "t boolean, p boolean, s string")
    assert validate.bootstrap(none, "t", "p", 10, by="s").columns == ["s", "metric", "low", "high", "draws"] and validate.bootstrap(none, "t", "p", 10, by="s").count() == 0


def test_lag_correlation_finds_a_shift(spark):
    import numpy as np

    x = np.random.default_rng(0).normal(size=80)
    rows = [(1, i, float(x[i]), float(x[i - 3]) if i >= 3 else 0.0) for i in range(80)]
    df = spark.createDataFrame(rows, "e bigint, row bigint, a double, b double")
    r = crossmodal.lag_correlation(df, K, "a", "b", forward=False).first()
    assert r.best_lag == 3 and r.peak_corr > 0.9


def test_freeze_choice_needs_a_margin(spark):
    g = spark.createDataFrame([(1, 0.3, 0.6, 4), (1, 0.5, 0.6, 7), (1, 0.8, 0.7, 12), (1, 1.2, 0.8, 25)], "e bigint, frozen_thr double, moving_q double, max_run int")
    r = crossmodal.choose_freeze(g).first()
    assert (r.frozen_thr, r.run_len) == (0.8, 45)
    assert crossmodal.choose_freeze(g.where("max_run > 20")).count() == 0


def test_moving_cut_is_rounded_as_in_sql(spark):
    """Two steps that differ in their last bit beside the cut, as those of user 363 at sf0.1; and random steps against quantile_cont, a user without any among them."""
    steps = [0.01 * i for i in range(32)] + [32.15, 32.150000000000006] + [33.05 + i for i in range(21)]
    df = spark.createDataFrame([(1, i, 0.0, v) for i, v in enumerate(steps)], "e bigint, row bigint, motion double, step double")
    grid = {r.moving_q: r for r in crossmodal.freeze_grid(df, ["e"], "motion", "step").where("frozen_thr = 0.3").collect()}
    assert (grid[0.6].both_frames, grid[0.6].max_run) == (22, 22)
    assert crossmodal.moving(df, "step", ["e"], 0.6).where("moving").count() == 22
    assert crossmodal.freeze_intervals(df, ["e"], "motion", "step", 0.3, 0.6, 22).count() == 1

    rng = random.Random(5)
    rows = [(e, abs(rng.randrange(9000) / 100 - rng.randrange(9000) / 100)) for e in range(60) for _ in range(1 + 3 * e)] + [(60, None), (61, None), (61, 0.3)]
    want = duckdb.connect()
    want.execute("CREATE TABLE t (e BIGINT, x DOUBLE)")
    want.executemany("INSERT INTO t VALUES (?, ?)", rows)
    qs = {f"q{i}": q for i, q in enumerate((0.5, 0.6, 0.7, 0.8, 0.01, 0.999))}
    got = statistics.with_quantiles(spark.createDataFrame(rows, "e bigint, x double"), ["e"], "x", qs)
    assert got.columns == ["e", "x", *qs] and got.count() == len(rows)
    assert sorted(map(tuple, got.drop("x").distinct().collect())) == sorted(want.execute("SELECT e, " + ", ".join(f"quantile_cont(x, {q})" for q in qs.values()) + " FROM t GROUP BY e").fetchall())


def test_freeze_code_is_appended_once_and_only_to_flagged(spark):
    rep = spark.createDataFrame([("t", 1, "review", ["X"]), ("t", 2, "pass", [])], "dataset string, episode_index bigint, status string, issue_codes array<string>")
    fr = rep.select("dataset", "episode_index")
    once = crossmodal.append_freeze_code(rep, fr)
    twice = crossmodal.append_freeze_code(once, fr)
    assert {r.episode_index: r.issue_codes for r in twice.collect()} == {1: ["X", "S_VISUAL_FREEZE_UNDER_MOTION"], 2: []}
    assert [r.episode_index for r in crossmodal.newly_flagged(rep, fr).collect()] == [2]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=40))
def test_masks_partition_the_rows(spark, flags):
    df = frames(spark, flags).select(F.lit("t").alias("dataset"), F.col("e").alias("episode_index"), "row", F.col("f").alias("train_keep"))
    m = governance.mask_summary(df).first()
    assert m.keep_rows + m.drop_rows == m.mask_rows == len(flags)
    assert m.longest_keep_run == max((n for *_, n in runs_by_hand(flags)), default=0)


def states(spark, change):
    rows = []
    for i in range(120):
        v = [0.005 * i] * 3 + [0.0] * 17
        rows.append(["t", 1, i, change.get(i, v)])
    return spark.createDataFrame(rows, "dataset string, episode_index bigint, row bigint, state array<float>")


def test_sparse_repairs(spark):
    nan = [float("nan")] + [0.2] * 2 + [0.0] * 17
    out = repair.repaired_values(states(spark, {20: nan, 21: nan}), "sparse_nonfinite").orderBy("row").collect()
    assert out[20].accepted and out[20].state[0] == pytest.approx(0.1, abs=1e-5) and out[21].state[0] == pytest.approx(0.105, abs=1e-5) and out[20].field.startswith("state[0]")
    assert sum(r.repair_applied for r in out) == 2
    wide = repair.repaired_values(states(spark, {20: nan, 21: nan, 22: nan}), "sparse_nonfinite").first()
    assert not wide.accepted and "wider" in wide.refusal
    spike = repair.repaired_values(states(spark, {50: [5.0] * 3 + [0.0] * 17}), "position_spike").orderBy("row").collect()
    assert spike[50].state[0] == pytest.approx(0.25, abs=1e-5) and spike[50].original_value.startswith("5")
    again = repair.repaired_values(spark.createDataFrame([(r.dataset, r.episode_index, r.row, r.state) for r in spike], "dataset string, episode_index bigint, row bigint, state array<float>"), "position_spike").first()
    assert not again.accepted  # nothing left to repair
    assert not repair.repaired_values(states(spark, {0: [5.0] * 20}), "position_spike").first().accepted


def test_timestamp_repair_refuses_broken_sequences(spark):
    def run(ts, fi):
        df = spark.createDataFrame([(1, i, t, f) for i, (t, f) in enumerate(zip(ts, fi))], "e bigint, row bigint, t double, f bigint")
        return repair.rebuilt_timestamp(df, K, "t", "f").orderBy("row").collect()

    ok = run([5.0, 5.13, 5.2], [7, 8, 9])
    assert [r.accepted for r in ok] == [True] * 3 and [r.changed for r in ok] == [False, True, False] and ok[1].rebuilt == pytest.approx(5.1)
    for ts, fi in (([5.0, 4.9, 5.2], [7, 8, 9]), ([5.0, 5.1, 5.2], [7, 9, 10]), ([5.0, None, 5.2], [7, 8, 9])):
        assert not any(r.accepted or r.changed for r in run(ts, fi))
