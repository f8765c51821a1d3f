"""Repairs that the evidence determines uniquely. Sources stay as they are; copies come with a per-frame audit mask.

Native expressions where rows do not depend on earlier repairs; grouped pandas per episode where they do.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episoda.operators.images import STREAMS
from episoda.operators.sequence import carried, frame_window

KEYS = ["dataset", "episode_index"]
FPS = 10.0
MASK = ("repair_applied", "repair_code", "field", "original_value", "repaired_value", "quality_mask")

#: Repair labels and the detector codes that each of them is to remove.
TARGETS = {
    "timestamp": ("T_TIMESTAMP_JITTER_OR_DRIFT", "T_TIMESTAMP_UNIT_MISMATCH"),
    "task_index": ("S_TASK_INDEX_INVALID", "S_TASK_SWITCH_WITHIN_EPISODE"),
    "length": ("T_METADATA_LENGTH_MISMATCH",),
    "paths": ("S_IMAGE_PATH_MISMATCH", "S_MODALITY_INDEX_ALIGNMENT"),
    "sparse_nonfinite": ("V_NONFINITE",),
    "position_spike": ("V_PHYSICAL_RANGE",),
}


def empty_mask() -> dict[str, Column]:
    """Columns of the audit mask before anything is repaired."""
    return {"repair_applied": F.lit(False), "repair_code": F.lit(""), "field": F.lit(""), "original_value": F.lit(""), "repaired_value": F.lit(""), "quality_mask": F.lit(True)}


def rebuilt_timestamp(frames: DataFrame, keys: list[str], timestamp: str, frame: str, fps: float = FPS, row: str = "row", tolerance: float = 1e-6) -> DataFrame:
    """frames with rebuilt (t0 + frames since the first / fps), accepted and changed.

    Accepted are episodes whose frame indexes are complete and rise by one and whose time stamps are finite and rise; the others keep theirs.
    """
    w, whole = frame_window(keys, row), Window.partitionBy(*keys)
    f, t = F.col(frame).cast("double"), F.col(timestamp).cast("double")
    broken = f.isNull() | F.isnan(f) | t.isNull() | F.isnan(t) | (F.abs(t) == float("inf")) | F.coalesce(f - F.lag(f).over(w) != 1, F.lit(False)) | F.coalesce(t - F.lag(t).over(w) <= 0, F.lit(False))
    df = frames.withColumn("_broken", F.coalesce(broken, F.lit(True)))
    df = df.withColumns({"accepted": ~F.bool_or("_broken").over(whole), "_t0": F.first(t).over(w), "_f0": F.first(f).over(w)})
    rebuilt = F.when(F.col("accepted"), F.col("_t0") + (f - F.col("_f0")) / fps).otherwise(t)
    df = df.withColumn("rebuilt", rebuilt)
    return df.withColumn("changed", F.col("accepted") & (F.abs(F.col("rebuilt") - t) > tolerance)).drop("_broken", "_t0", "_f0")


def rewritten_task(frames: DataFrame, task: str, expected: str, code: str) -> DataFrame:
    """task replaced by the expected one where they differ, with the audit columns."""
    t, e = F.col(task), F.col(expected)
    changed = F.coalesce(t != e, F.lit(True)) & e.isNotNull()
    text = lambda c: F.when(changed, F.coalesce(c.cast("string"), F.lit(""))).otherwise("")
    audit = {
        "repair_applied": changed, "repair_code": F.when(changed, code).otherwise(""), "field": F.when(changed, task).otherwise(""),
        "original_value": text(t), "repaired_value": text(e), "quality_mask": ~changed,
    }
    return frames.withColumns(audit).withColumn(task, F.when(changed, e.cast(frames.schema[task].dataType)).otherwise(t))


def expected_tasks(meta: DataFrame, tasks: DataFrame) -> DataFrame:
    """The task index that metadata determines: episodes with one task name that stands for one index. meta(dataset, episode_index, tasks),
    tasks(task, task_index). A name with several indexes determines nothing."""
    one = meta.where(F.size("tasks") == 1).select(*KEYS, F.get("tasks", F.lit(0)).alias("task"))
    known = tasks.groupBy("task").agg(F.min("task_index").alias("expected_task"), F.max("task_index").alias("most")).where("expected_task = most").drop("most")
    return one.join(known, "task").drop("task")


def repaired_paths(frames: DataFrame) -> DataFrame:
    """Image paths rewritten to the frame index; an episode with any adjacent exact duplicate in a stream, or with nothing to rewrite, is refused.

    Duplicates are looked for over gaps: the last payload that was there counts, unlike in the profile.
    """
    hashed = frames.withColumns({f"_h_{s}": F.when(F.octet_length(F.col(f"{s}.bytes")) > 0, F.sha1(F.col(f"{s}.bytes"))) for s in STREAMS})
    again = F.lit(False)
    for s in STREAMS:
        again = again | F.coalesce(F.col(f"_h_{s}") == carried(F.col(f"_h_{s}"), KEYS), F.lit(False))
    wanted = F.format_string("frame_%06d.png", F.col("frame_index").cast("bigint"))
    wrong = {s: F.col(f"_h_{s}").isNotNull() & (F.coalesce(F.col(f"{s}.path"), F.lit("")) != wanted) for s in STREAMS}
    anything = wrong[STREAMS[0]] | wrong[STREAMS[1]] | wrong[STREAMS[2]]
    whole = Window.partitionBy(*KEYS)
    judged = hashed.withColumns({"_again": again, "_any": anything}).withColumn("accepted", ~F.bool_or("_again").over(whole) & F.bool_or("_any").over(whole))
    change = {s: F.col("accepted") & wrong[s] for s in STREAMS}
    listed = lambda of: F.array_join(F.array_compact(F.array(*[F.when(change[s], of(s)) for s in STREAMS])), ";")
    touched = F.col("accepted") & F.col("_any")
    out = judged.withColumns(
        {
            "repair_applied": touched, "repair_code": F.when(touched, "S_IMAGE_PATH_MISMATCH").otherwise(""), "field": listed(lambda s: F.lit(f"{s}.path")),
            "original_value": listed(lambda s: F.coalesce(F.col(f"{s}.path"), F.lit(""))), "repaired_value": listed(lambda s: wanted), "quality_mask": ~touched,
        }
    ).withColumns({s: F.when(change[s], F.struct(F.col(f"{s}.bytes").alias("bytes"), wanted.alias("path"))).otherwise(F.col(s)) for s in STREAMS})
    return out.drop("_again", "_any", *[f"_h_{s}" for s in STREAMS])


def _fill_holes(m: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Rows with a non-finite element, in order, interpolated between finite neighbours at most three rows apart; repaired rows become neighbours."""
    sound = np.isfinite(m).all(1)
    bad = np.flatnonzero(~sound)
    if not len(bad) or len(bad) > 0.10 * len(m):
        raise ValueError("non-finite rows are not sparse")
    done = []
    for i in bad:
        before, after = np.flatnonzero(sound[:i]), np.flatnonzero(sound[i + 1 :])
        if not len(before) or not len(after):
            raise ValueError("a hole lacks a finite neighbour")
        a, b = int(before[-1]), int(after[0]) + int(i) + 1
        if b - a > 3:
            raise ValueError("a hole is wider than two rows")
        was = m[i].copy()
        m[i] = m[a] + (m[b] - m[a]) * ((i - a) / (b - a))
        sound[i] = True
        done.append((int(i), was))
    return done


def _pull_spikes(m: np.ndarray, positions: tuple[int, ...] = (0, 1, 2, 10, 11, 12), limit: float = 1.0) -> list[tuple[int, np.ndarray]]:
    """Sparse position components over the limit, replaced by the mean of both neighbours, which must be within it; later rows see earlier repairs."""
    bad = np.argwhere(np.abs(m[:, positions]) > limit)
    if not len(bad) or len(set(bad[:, 0])) > max(1, int(0.01 * len(m))):
        raise ValueError("spikes are not sparse")
    originals: dict[int, np.ndarray] = {}
    for i, k in bad:
        c = positions[k]
        if i == 0 or i == len(m) - 1:
            raise ValueError("a spike lacks a neighbour")
        value = (m[i - 1, c] + m[i + 1, c]) / 2
        if not abs(value) <= limit:
            raise ValueError("the neighbours are beyond the limit")
        originals.setdefault(int(i), m[i].copy())
        m[i, c] = value
    return list(originals.items())


_VALUE_SCHEMA = "dataset string, episode_index bigint, row bigint, state array<float>, accepted boolean, refusal string, repair_applied boolean, repair_code string, field string, original_value string, repaired_value string, quality_mask boolean"


def repaired_values(frames: DataFrame, kind: str) -> DataFrame:
    """States of each episode after `sparse_nonfinite` or `position_spike` repair, with audit columns; a refused episode keeps its states and says why.

    Repairs within an episode build on each other, so an episode (hundreds of frames of 20 numbers) is one pandas group.
    """
    fix = {"sparse_nonfinite": _fill_holes, "position_spike": _pull_spikes}[kind]
    code = TARGETS[kind][0]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row").reset_index(drop=True)
        out = pdf[["dataset", "episode_index", "row", "state"]].copy()
        out = out.assign(accepted=True, refusal="", repair_applied=False, repair_code="", field="", original_value="", repaired_value="", quality_mask=True)
        try:
            if any(s is None or len(s) != 20 for s in pdf["state"]):
                raise ValueError("a state does not have 20 elements")
            m = np.array([[np.nan if x is None else x for x in s] for s in pdf["state"]], float)
            changes = fix(m)
        except ValueError as e:
            return out.assign(accepted=False, refusal=str(e))
        show = lambda x: "nan" if not np.isfinite(x) else f"{x:.9g}"
        for i, was in changes:
            moved = [c for c in range(20) if not (was[c] == m[i, c])]
            out.at[i, "state"] = m[i].astype(np.float32)
            out.loc[i, ["repair_applied", "repair_code", "quality_mask"]] = [True, code, False]
            out.loc[i, "field"] = ";".join(f"state[{c}]" for c in moved)
            out.loc[i, "original_value"] = ";".join(show(was[c]) for c in moved)
            out.loc[i, "repaired_value"] = ";".join(show(m[i, c]) for c in moved)
        return out

    return frames.select(*KEYS, "row", "state").groupBy(*KEYS).applyInPandas(run, _VALUE_SCHEMA)


def recheck(before: DataFrame, after: DataFrame, repaired: DataFrame) -> DataFrame:
    """What a repair achieved, measured by the same detector on source and copy. repaired(dataset, episode_index, kind)."""
    targets = F.coalesce(*[F.when(F.col("kind") == k, F.array(*[F.lit(c) for c in v])) for k, v in TARGETS.items()], F.array().cast("array<string>"))
    short = lambda df, end: df.select(*KEYS, F.col("issue_codes").alias(f"issue_codes_{end}"), F.col("overall_quality_score").alias(f"overall_quality_score_{end}"))
    joined = short(before, "before").join(short(after, "after"), KEYS).join(repaired, KEYS).withColumn("target_codes", targets)
    gain = F.col("overall_quality_score_after") - F.col("overall_quality_score_before")
    left = F.arrays_overlap("issue_codes_after", "target_codes")
    had = F.arrays_overlap("issue_codes_before", "target_codes")
    return joined.withColumns({"score_gain_measured": gain, "targeted_codes_removed": had & ~left, "passed_full_recheck": F.size("issue_codes_after") == 0})
