import argparse
import json

import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry
from episoda import __main__ as cli
from episoda.operators import synthetic
from episoda.operators.images import STREAMS


def test_contract(spark):
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(oracles) >= 50
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["user_id", "dt_median", "dt_p99", "gap_frames", "gap_runs", "longest_gap_run"]


def write_dataset(root, episodes, n=40):
    folder = root / "data/chunk-000"
    folder.mkdir(parents=True)
    (root / "meta").mkdir()
    lines = []
    for ep, fault in episodes:
        e = synthetic.clean(ep, n, 32)
        if fault is not None:
            synthetic.inject(e, fault, 32)
        t = pa.table(
            {
                "timestamp": pa.array(e["timestamp"], pa.float32()), "frame_index": pa.array(e["frame_index"]), "episode_index": pa.array(e["episode_index_value"]), "index": pa.array(e["index"]), "task_index": pa.array(e["task_index"]),
                **{c: pa.array([x.tolist() for x in e[c]], pa.list_(pa.float32())) for c in ("state", "actions")},
                **{s: pa.array(e[s], pa.struct([("bytes", pa.binary()), ("path", pa.string())])) for s in STREAMS},
            }
        )
        pq.write_table(t, folder / f"episode_{ep:06d}.parquet")
        lines.append(json.dumps({"episode_index": ep, "length": n, "tasks": [f"task {ep % 2}"]}))
    (root / "meta/episodes.jsonl").write_text("\n".join(lines))


def test_command_line_flow(spark, tmp_path, monkeypatch):
    write_dataset(tmp_path / "ref", [(i, None) for i in range(5)])
    write_dataset(tmp_path / "test", [(0, 0), (1, 14), (2, None), (3, 16)])
    monkeypatch.setattr(cli, "session", lambda: spark)
    args = argparse.Namespace(reference=str(tmp_path / "ref"), test=str(tmp_path / "test"), out=str(tmp_path / "out"), size=(32, 32), fps=10.0, expect_reference=5, expect_test=4)
    for verb in (cli.check, cli.run_detect, cli.enrich, cli.govern):
        verb(spark, args)
    report = {(r.dataset, r.episode_index): r for r in cli.saved(spark, args.out, "quality_report_enriched").collect()}
    assert all(r.status == "pass" for (d, _), r in report.items() if d == "reference") and report["test", 2].status == "pass"
    assert report["test", 0].issue_codes == ["T_TIMESTAMP_JITTER_OR_DRIFT"] and report["test", 0].confidence == "threshold"
    assert "C_IMAGE_DECODE" in report["test", 1].issue_codes and report["test", 1].confidence == "deterministic"
    policy = {r.episode_index: r.train_policy for r in cli.saved(spark, args.out, "train_policy").collect()}
    assert policy[2] == "use_whole" and set(policy) == {0, 1, 2, 3}
    assert cli.saved(spark, args.out, "unsupervised").count() == 9 and cli.saved(spark, args.out, "weight_sensitivity").count() == 11
