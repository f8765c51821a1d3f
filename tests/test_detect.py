import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from episoda.operators import synthetic, validate
from episoda.plans import detect
from episoda.sources import episodes, inventory, sinks

CONFIG = detect.Config(size=(32, 32, 3))


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("flow"))
    raw = sinks.stage(synthetic.frames(spark), work, "raw")
    p = detect.profile(synthetic.file_table(raw), synthetic.metadata(raw), raw, work, CONFIG)
    thresholds = sinks.stage(detect.reference_of(p), work, "thresholds")
    flags, report = detect.detect(p, thresholds, CONFIG)
    return work, p, thresholds, sinks.stage(flags, work, "flags"), sinks.stage(report, work, "report")


def test_every_fault_is_found_and_no_clean_episode_flagged(spark, flow):
    *_, report = flow
    truth = synthetic.labels(spark)
    got = {r.scope: (r.tp, r.fp, r.fn) for r in validate.fault_metrics(report, truth).collect()}
    assert got["overall"] == (20, 0, 0)
    assert all(got[c][2] == 0 for c in ("temporal", "synchronisation", "content", "value"))


def test_frame_flags_match_the_labelled_rows(spark, flow):
    *_, flags, _ = flow
    truth = synthetic.labels(spark).where("frame_evaluable")
    rows = truth.select("episode_index", F.explode("rows").alias("row"))
    m = validate.frame_metrics(flags.where("dataset = 'test'"), rows, truth).first()
    assert m.precision > 0.95 and m.recall > 0.95


def test_flags_do_not_depend_on_partitions(spark, flow):
    work, p, thresholds, flags, _ = flow
    mixed = detect.Profile(p.files, p.meta, p.raw, p.structural_frames.repartition(7, "row"), p.structural_episodes, p.value_frames.repartition(3), p.value_episodes, p.image_frames.repartition(5, "row"), p.image_episodes)
    again, _ = detect.detect(mixed, thresholds, CONFIG)
    assert again.exceptAll(flags).count() == 0 == flags.exceptAll(again).count()


def test_repairs_pass_the_same_detector_and_are_audited(spark, flow, tmp_path):
    _, p, thresholds, _, report = flow
    tasks = spark.createDataFrame([("task 0", 0), ("task 1", 1)], "task string, task_index bigint")
    fixed, masks = detect.repair_all(p, report, tasks)
    fixed = sinks.stage(fixed, str(tmp_path), "fixed")
    r = detect.recheck(p, fixed, thresholds, report, str(tmp_path / "again"), CONFIG).collect()
    assert {x.kind for x in r} == {"timestamp", "task_index", "paths", "sparse_nonfinite", "position_spike"}
    assert all(x.targeted_codes_removed and x.passed_full_recheck and x.score_gain_measured > 0 for x in r)
    assert masks.where("NOT repair_applied OR quality_mask").count() == 0
    out = detect.govern(report, flow[3], spark.createDataFrame([(x.dataset, x.episode_index, x.targeted_codes_removed, x.passed_full_recheck) for x in r], "dataset string, episode_index bigint, targeted_codes_removed boolean, passed_full_recheck boolean"))
    policies = {x.episode_index: x.train_policy for x in out["train_policy"].collect()}
    assert len(policies) == 20 and all(policies[x.episode_index] == "use_repaired_copy" for x in r)
    sinks.repaired_copies(fixed, str(tmp_path / "copies"))
    sinks.masks(masks, str(tmp_path / "masks"))
    back = spark.read.parquet(str(tmp_path / "copies"))
    assert back.count() == fixed.count()


def test_enrichment_runs_and_reference_stays_clean(spark, flow):
    _, p, _, flags, report = flow
    grid, intervals = detect.freeze(p)
    assert grid.count() == 12 * 20
    assert detect.overlay(report, intervals).count() == report.count()
    scores = detect.unsupervised(p, 30)
    assert scores.count() == 40 and scores.where("dataset = 'reference' AND score > 1").count() == 0
    worth = detect.training_worth(p, flags)
    assert worth.where("value_coverage_score NOT BETWEEN 0 AND 100").count() == 0 and worth.count() == 40


def write_episode(rows, path, drop=(), narrow=True):
    kinds = {"timestamp": pa.float32(), "state": pa.list_(pa.float32()), "actions": pa.list_(pa.float32())}
    t = pa.Table.from_pylist([{k: v for k, v in r.items() if k not in drop} for r in rows])
    for k in kinds if narrow else ():
        t = t.set_column(t.schema.get_field_index(k), k, t[k].cast(kinds[k]))
    pq.write_table(t, path)


def test_files_damaged_in_every_way_are_read_and_classified(spark, tmp_path):
    n = 30
    folder = tmp_path / "data/chunk-000"
    folder.mkdir(parents=True)
    (tmp_path / "meta").mkdir()
    lines = []
    for ep in range(4):
        e = synthetic.clean(ep, n, 32)
        rows = [{"timestamp": float(e["timestamp"][i]), "frame_index": int(i), "episode_index": ep, "index": int(e["index"][i]), "task_index": int(e["task_index"][i]), "state": e["state"][i].tolist(), "actions": e["actions"][i].tolist(), **{s: e[s][i] for s in ("image", "left_wrist_image", "right_wrist_image")}} for i in range(n)]
        if ep == 2:
            rows[4]["state"] = rows[4]["state"][:18]
            rows[5]["state"][0] = float("inf")
            rows[6]["timestamp"] = None
            rows[7]["image"] = {"bytes": None, "path": None}
        write_episode(rows, folder / f"episode_{ep:06d}.parquet", ("image",) if ep == 3 else ())
        if ep == 0:
            write_episode(rows, folder / "episode_000008.parquet", narrow=False)  # doubles where floats belong
        lines.append(json.dumps({"episode_index": ep, "length": n + (47 if ep == 1 else 0), "tasks": [f"task {ep % 2}"]}))
    (folder / "episode_000009.parquet").write_bytes(b"PAR1garbage")
    (tmp_path / "meta/episodes.jsonl").write_text("\n".join([json.dumps({"episode_index": 0, "length": 1, "tasks": []}), "", *lines, "{broken"]) + "\n")
    files = episodes.files(spark, str(tmp_path), "test").cache()
    assert inventory.count(spark, str(tmp_path)) == 6
    assert {r.episode_index: r.defect for r in files.collect()} == {0: None, 1: None, 2: None, 3: "missing_column:image", 8: "unreadable", 9: "corrupt"}
    with pytest.raises(ValueError):
        episodes.check_count(files, 7)
    meta = episodes.metadata(spark, str(tmp_path), "test")
    assert {r.episode_index: r.length for r in meta.collect()} == {0: n, 1: n + 47, 2: n, 3: n}
    raw = episodes.frames(spark, str(tmp_path), "test")
    p = detect.profile(files, meta, raw, str(tmp_path / "work"), CONFIG)
    ref = synthetic.frames(spark, 3, n, 32, faulty=False)
    q = detect.profile(synthetic.file_table(ref), synthetic.metadata(ref), ref, str(tmp_path / "ref"), CONFIG)
    flags, report = detect.detect(p, detect.reference_of(q), CONFIG)
    got = {r.episode_index: r for r in report.collect()}
    assert got[0].issue_codes == [] and got[0].overall_quality_score > 99
    assert got[1].issue_codes == ["T_METADATA_LENGTH_MISMATCH"] and got[1].unrecoverable_codes == ["T_METADATA_LENGTH_MISMATCH"]
    assert {"V_NONFINITE", "V_PHYSICAL_RANGE", "S_MODALITY_COVERAGE_GAP", "C_IMAGE_SHAPE"} <= set(got[2].issue_codes) and "V_SPIKE_JUMP" not in got[2].issue_codes
    assert got[3].issue_codes == ["C_SCHEMA_MISSING_IMAGE_COLUMN"] and got[3].overall_quality_score <= 25 and got[3].severity == "severe"
    assert got[8].issue_codes == ["C_FILE_READ_ERROR", "C_IMAGE_READ_ERROR"]
    assert got[9].issue_codes[0] == "C_PARQUET_CORRUPT" and got[9].overall_quality_score == 0 and got[9].repair_mode == "isolate"
    row = {r.row: r.issue_codes for r in flags.where("episode_index = 2").collect()}
    assert "V_NONFINITE" in row[4] and "V_NONFINITE" in row[5] and "S_MODALITY_COVERAGE_GAP" in row[7] and row[0] == []


def test_summary_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], None)], "k string, codes array<string>, n bigint")
    assert json.loads(sinks.summary_document(df)) == {"k": "a", "codes": ["x", "y"], "n": None}
    assert sinks.markdown(df).splitlines()[0] == "| k | codes | n |"
    sinks.csv_export(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().codes == "x;y"
    sinks.json_lines(df, str(tmp_path / "j"))
    sinks.copy_unchanged(spark, str(tmp_path / "j"), str(tmp_path / "k"))
    assert spark.read.json(str(tmp_path / "k")).count() == 1


def test_manifest_keeps_datasets_apart(spark, tmp_path):
    for name, text in (("reference", b"one"), ("test", b"two")):
        folder = tmp_path / name / "chunk-000"
        folder.mkdir(parents=True)
        (folder / "episode_000005.parquet").write_bytes(text)
        copy = tmp_path / "copies" / f"dataset={name}" / "episode_index=5"
        copy.mkdir(parents=True)
        (copy / "part-0.parquet").write_bytes(text * 2)
    sources = sinks.digests(spark, str(tmp_path / "reference"), "reference").union(sinks.digests(spark, str(tmp_path / "test"), "test"))
    repaired = spark.createDataFrame([("reference", 5, "a"), ("test", 5, "b"), ("test", 6, "c")], "dataset string, episode_index bigint, kind string")
    got = {(r.dataset, r.episode_index): (r.source_sha256, r.repaired_sha256) for r in sinks.manifest(repaired, sources, sinks.digests(spark, str(tmp_path / "copies")), "v1").collect()}
    assert len(got) == 3 and got["test", 6] == (None, None) and len({x for pair in got.values() for x in pair if x}) == 4


def test_ambiguous_task_names_determine_nothing(spark):
    from episoda.operators import repair

    meta = spark.createDataFrame([("d", 1, ["a"]), ("d", 2, ["b"]), ("d", 3, ["a", "b"]), ("d", 4, None)], "dataset string, episode_index bigint, tasks array<string>")
    tasks = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2), ("b", 2)], "task string, task_index bigint")
    assert [(r.episode_index, r.expected_task) for r in repair.expected_tasks(meta, tasks).collect()] == [(2, 2)]
