"""Equivalent SQL for the registered queries, in DuckDB's dialect over the raw tables."""

from __future__ import annotations

_EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, row_number() OVER w - 1 AS row, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 AS dt
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""

_FL = (
    _EV
    + """, fl AS (
  SELECT *, list_filter([CASE WHEN dt > 150000 THEN 'T_TIMESTAMP_GAP' END, CASE WHEN event_type = 'error' AND value > 100 THEN 'C_IMAGE_DECODE' END,
                         CASE WHEN value >= 150 THEN 'V_SPIKE_JUMP' END], lambda x: x IS NOT NULL) AS codes FROM ev)"""
)

_REPORT = (
    _FL
    + """, rp0 AS (SELECT user_id, count(*) AS rows, list_sort(list_distinct(flatten(list(codes)))) AS codes, count_if(len(codes) > 0) AS bad FROM fl GROUP BY 1),
rp AS (SELECT user_id, rows, codes, CASE WHEN bad <= 1 THEN 'pass' ELSE 'review' END AS status,
  CASE WHEN len(codes) >= 3 THEN 'isolate' WHEN len(codes) = 2 THEN 'mark_and_recollect' WHEN len(codes) = 1 THEN 'auto_repair' ELSE 'none' END AS repair_mode FROM rp0)"""
)

_ISL = """isl AS (SELECT user_id, min(row) AS start_row, max(row) AS end_row, count(*) AS frame_count, list_sort(list_distinct(flatten(list(codes)))) AS codes,
  list(event_type ORDER BY row, event_type) AS types FROM (SELECT *, row - row_number() OVER (PARTITION BY user_id ORDER BY row) AS g FROM fl WHERE len(codes) > 0) GROUP BY user_id, g)"""

_LI = """li AS (
  SELECT *, row_number() OVER w - 1 AS row, l_linenumber - lag(l_linenumber) OVER w AS frame_diff FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_extendedprice))"""

_EM = """em AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[])[1:20] AS state, CAST(embedding AS DOUBLE[])[21:40] AS action FROM embeddings)"""

_MV = _EV + ", mv AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY row)) AS step FROM ev)"

_OR = (
    _LI
    + """, l AS (
  SELECT l_orderkey, count(*) AS rows, count_if(frame_diff <> 1) AS breaks, count_if(l_discount >= 0.1) AS dim, count_if(l_extendedprice > 90000) AS over,
         count(DISTINCT l_linestatus) AS states, max(l_linenumber) AS expected FROM li GROUP BY 1),
o0 AS (
  SELECT coalesce(o_orderkey, l_orderkey) AS episode, o_orderstatus, l_orderkey, coalesce(rows, 0) AS rows, coalesce(breaks, 0) AS breaks, coalesce(dim, 0) AS dim,
         coalesce(over, 0) AS over, coalesce(states, 0) AS states, coalesce(expected, 0) AS expected
  FROM orders FULL JOIN l ON o_orderkey = l_orderkey),
o1 AS (
  SELECT *, rows - expected AS delta,
    list_filter([CASE WHEN l_orderkey IS NULL THEN 'C_FILE_READ_ERROR' END, CASE WHEN abs(rows - expected) > 1 THEN 'T_METADATA_LENGTH_MISMATCH' END,
      CASE WHEN breaks > 4 THEN 'T_FRAME_ORDER_ERROR' END, CASE WHEN states > 1 AND o_orderstatus = 'P' THEN 'S_TASK_SWITCH_WITHIN_EPISODE' END,
      CASE WHEN dim > 1 THEN 'C_IMAGE_SCREEN' END, CASE WHEN over > 0 THEN 'V_PHYSICAL_RANGE' END], lambda x: x IS NOT NULL) AS codes FROM o0),
o2 AS (
  SELECT *,
    100 * greatest(0, 1 - least(1, 1.5 * CASE WHEN rows > 0 THEN least(1, abs(delta) / rows) WHEN abs(delta) > 0 THEN 1 ELSE 0 END)) AS s1,
    100 * greatest(0, 1 - least(1, 0.5 * CASE WHEN rows > 0 THEN least(1, breaks / rows) WHEN breaks > 0 THEN 1 ELSE 0 END)) AS s2,
    100 * greatest(0, 1 - least(1, 2.0 * CASE WHEN states > 1 THEN 0.25 ELSE 0 END)) AS s3,
    100 * greatest(0, 1 - least(1, 1.5 * CASE WHEN rows > 0 THEN least(1, dim / rows) WHEN dim > 0 THEN 1 ELSE 0 END)) AS s4,
    100 * greatest(0, 1 - least(1, 1.25 * CASE WHEN rows > 0 THEN least(1, over / rows) WHEN over > 0 THEN 1 ELSE 0 END)) AS s5 FROM o1),
o3 AS (SELECT *, CASE WHEN rows = 0 THEN 0.0 ELSE round(CAST(0.25 * s1 + 0.20 * s2 + 0.20 * s3 + 0.20 * s4 + 0.15 * s5 AS DOUBLE), 6) END AS total FROM o2),
o4 AS (SELECT *,
  CASE WHEN len(codes) = 0 THEN 'pass' WHEN rows = 0 OR total < 40 THEN 'severe' WHEN total < 65 THEN 'high' WHEN total < 85 THEN 'medium' ELSE 'low' END AS severity,
  list_filter(codes, lambda c: (c = 'S_TASK_SWITCH_WITHIN_EPISODE') OR (c = 'T_METADATA_LENGTH_MISMATCH' AND abs(delta) <= 2) OR (c = 'V_PHYSICAL_RANGE' AND over <= 0.1 * rows) OR (c = 'C_IMAGE_SCREEN' AND dim <= 0.1 * rows)) AS fix,
  list_filter(codes, lambda c: c IN ('T_FRAME_ORDER_ERROR', 'C_FILE_READ_ERROR') OR (c = 'T_METADATA_LENGTH_MISMATCH' AND abs(delta) > 2) OR (c = 'V_PHYSICAL_RANGE' AND over > 0.1 * rows) OR (c = 'C_IMAGE_SCREEN' AND dim > 0.1 * rows)) AS lost FROM o3),
orp AS (SELECT *, CASE WHEN len(codes) = 0 THEN 'none' WHEN len(fix) > 0 AND len(lost) = 0 THEN 'auto_repair' WHEN len(fix) > 0 THEN 'mark_and_recollect' ELSE 'isolate' END AS repair_mode FROM o4)"""
)

_CATS = "list_transform({c}, lambda x: CASE left(x, 2) WHEN 'T_' THEN 'temporal' WHEN 'S_' THEN 'synchronisation' WHEN 'C_' THEN 'content' ELSE 'value' END)"


def _distinct_in_order(x: str) -> str:
    return f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"


_TIER = "CASE WHEN len(codes) = 0 THEN '' WHEN list_has_any(codes, ['C_FILE_READ_ERROR', 'T_METADATA_LENGTH_MISMATCH', 'T_FRAME_ORDER_ERROR', 'S_TASK_SWITCH_WITHIN_EPISODE']) THEN 'deterministic' ELSE 'high' END"

_RUNS_BELOW_70 = """r AS (SELECT user_id, min(row) AS start_row, max(row) AS end_row, count(*) AS frame_count
  FROM (SELECT *, row - row_number() OVER (PARTITION BY user_id ORDER BY row) AS g FROM ev WHERE value < 70) GROUP BY user_id, g)"""

_LIMITS = """th AS (SELECT l_returnflag, greatest(1000.0, 1.25 * quantile_cont(l_extendedprice, 0.999)) AS price_high, 0.65 * quantile_cont(l_extendedprice, 0.10) AS price_low,
  0.5 * quantile_cont(l_quantity, 0.002) AS quantity_low FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1)"""

_GRID = (
    _MV
    + """, cut AS (SELECT user_id, 0.6 AS q, quantile_cont(step, 0.6) AS c FROM mv GROUP BY 1 UNION ALL SELECT user_id, 0.7, quantile_cont(step, 0.7) FROM mv GROUP BY 1 UNION ALL SELECT user_id, 0.8, quantile_cont(step, 0.8) FROM mv GROUP BY 1),
fz AS (SELECT mv.user_id, row, CAST(f AS DOUBLE) AS frozen_thr, CAST(cut.q AS DOUBLE) AS moving_q, value / 40 < f AS frozen, value / 40 < f AND coalesce(step > c, false) AS both_
  FROM mv JOIN cut USING (user_id), (VALUES (0.3), (0.5), (0.8), (1.2)) g(f)),
ln AS (SELECT user_id, frozen_thr, moving_q, max(n) AS longest FROM (
  SELECT user_id, frozen_thr, moving_q, count(*) AS n FROM (SELECT *, row - row_number() OVER (PARTITION BY user_id, frozen_thr, moving_q ORDER BY row) AS g FROM fz WHERE both_) GROUP BY user_id, frozen_thr, moving_q, g) GROUP BY 1, 2, 3),
gd AS (SELECT fz.user_id, fz.frozen_thr, fz.moving_q, count_if(frozen) AS frozen_frames, count_if(both_) AS both_frames, coalesce(any_value(longest), 0) AS max_run
  FROM fz LEFT JOIN ln USING (user_id, frozen_thr, moving_q) GROUP BY 1, 2, 3)"""
)

_TYPES = ("click", "error", "purchase", "signup", "view")

_PHYS = """p AS (SELECT vec_id, state, list_concat(state[1:3], state[11:13]) AS pos, list_concat(state[4:9], state[14:19]) AS rot, [state[10], state[20]] AS grip,
  greatest(abs(sqrt(list_sum(list_transform(state[4:6], lambda x: x * x))) - 1), abs(sqrt(list_sum(list_transform(state[7:9], lambda x: x * x))) - 1),
           abs(sqrt(list_sum(list_transform(state[14:16], lambda x: x * x))) - 1), abs(sqrt(list_sum(list_transform(state[17:19], lambda x: x * x))) - 1)) AS nd,
  greatest(abs(list_dot_product(state[4:6], state[7:9])), abs(list_dot_product(state[14:16], state[17:19]))) AS od FROM em)"""


def _biggest(x: str) -> str:
    return f"list_max(list_transform({x}, lambda x: abs(x)))"


def _lags() -> str:
    parts = []
    for k in range(-6, 7):
        other = f"lead(zb, {k})" if k >= 0 else f"lag(zb, {-k})"
        parts.append(f"SELECT user_id, {k} AS k, za * {other} OVER (PARTITION BY user_id ORDER BY row) AS p FROM z")
    return " UNION ALL ".join(parts)


_SCENARIOS = {"structural": 0.25, "temporal": 0.20, "sync": 0.20, "content": 0.20, "value": 0.15}


def _weights() -> str:
    rows = []
    for k in _SCENARIOS:
        for d in (-0.05, 0.05):
            w = {n: max(0.01, x + (d if n == k else 0)) for n, x in _SCENARIOS.items()}
            t = sum(w.values())
            rows.append(f"('{k}{d:+.2f}', " + ", ".join(f"{w[n] / t!r}::DOUBLE" for n in _SCENARIOS) + ")")
    rows.append("('equal', 0.2::DOUBLE, 0.2::DOUBLE, 0.2::DOUBLE, 0.2::DOUBLE, 0.2::DOUBLE)")
    return ", ".join(rows)


ORACLE_SQL: dict[str, str] = {
    "frame_intervals": f"WITH {_EV} SELECT user_id, event_id, row, round(dt, 6) AS dt_s FROM ev",
    "interval_robust_stats": f"""WITH {_EV}, m AS (SELECT user_id, quantile_cont(dt, 0.5) AS m FROM ev GROUP BY 1)
SELECT user_id, count(dt) AS dt_n, round(any_value(m) + 1e-9, 6) AS dt_median, round(quantile_cont(abs(dt - m), 0.5) + 1e-9, 6) AS dt_mad, round(quantile_cont(dt, 0.01) + 1e-9, 6) AS dt_p01, round(quantile_cont(dt, 0.99) + 1e-9, 6) AS dt_p99
FROM ev JOIN m USING (user_id) GROUP BY 1""",
    "gap_runs": f"""WITH {_EV}, m AS (SELECT user_id, quantile_cont(dt, 0.5) AS m, quantile_cont(dt, 0.99) AS p FROM ev GROUP BY 1),
g AS (SELECT user_id, row, m, p, coalesce(dt > 1.5 * m, false) AS gap FROM ev JOIN m USING (user_id)),
r AS (SELECT user_id, count(*) AS n FROM (SELECT user_id, row - row_number() OVER (PARTITION BY user_id ORDER BY row) AS i FROM g WHERE gap) GROUP BY user_id, i),
rr AS (SELECT user_id, count(*) AS gap_runs, max(n) AS longest_gap_run FROM r GROUP BY 1)
SELECT user_id, round(any_value(m) + 1e-9, 6) AS dt_median, round(any_value(p) + 1e-9, 6) AS dt_p99, count_if(gap) AS gap_frames, coalesce(any_value(gap_runs), 0) AS gap_runs, coalesce(any_value(longest_gap_run), 0) AS longest_gap_run
FROM g LEFT JOIN rr USING (user_id) GROUP BY 1""",
    "longest_run_first_tie": f"""WITH {_EV}, {_RUNS_BELOW_70}, k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY frame_count DESC, start_row) AS k FROM r)
SELECT user_id, frame_count AS longest_run, start_row, end_row FROM k WHERE k = 1""",
    "usable_clips": f"""WITH {_EV}, {_RUNS_BELOW_70}
SELECT user_id, start_row, end_row, frame_count, printf('ep%03d_%06d_%06d', user_id, start_row, end_row) AS clip_id, round(frame_count / 10.0, 2)::DOUBLE AS duration_s FROM r WHERE frame_count >= 5""",
    "issue_intervals": f"""WITH {_FL}, {_ISL}
SELECT user_id AS episode_index, start_row, end_row, frame_count, array_to_string(codes, ';') AS issue_codes,
  array_to_string({_distinct_in_order("types")}[1:3], ' | ') AS detail_examples FROM isl""",
    "frame_discontinuity": f"WITH {_LI} SELECT l_orderkey, count(*) AS rows, count(*) FILTER (frame_diff <> 1) AS nonunit, count(*) FILTER (frame_diff <= 0) AS nonpositive FROM li GROUP BY 1",
    "turn_continuity": """WITH d AS (SELECT *, turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS d FROM conversations)
SELECT conv_id, count(*) AS turns, count_if(d <> 1) AS breaks, min(turn) AS first_turn, max(turn) AS last_turn, arg_min(role, turn) AS first_role FROM d GROUP BY 1""",
    "episode_profile": f"""WITH {_LI}, s AS (SELECT *, abs(l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY row)) AS step FROM li),
m AS (SELECT l_orderkey, arg_min(l_linenumber, (-n) * 1000 + l_linenumber) AS line_mode FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM li GROUP BY 1, 2) GROUP BY 1)
SELECT l_orderkey, count(*) AS rows, arg_min(l_quantity, row) AS first_quantity, arg_max(l_quantity, row) AS last_quantity, max(l_extendedprice) AS price_max,
  round(quantile_cont(l_extendedprice, 0.99), 6) AS price_p99, coalesce(sum(step), 0.0)::DOUBLE AS path_length,
  round(coalesce(avg(CASE WHEN row > 0 THEN CASE WHEN step > 1e-4 THEN 1.0::DOUBLE ELSE 0.0 END END), 0.0), 6) AS motion_fraction, count(DISTINCT l_suppkey) AS suppliers, any_value(line_mode) AS line_mode
FROM s JOIN m USING (l_orderkey) GROUP BY 1""",
    "stream_profile_pivot": "SELECT user_id, "
    + ", ".join(f"count_if(event_type = '{t}') AS {t}_n, round(quantile_cont(value, 0.5) FILTER (event_type = '{t}'), 6) AS {t}_median, max(value) FILTER (event_type = '{t}') AS {t}_top" for t in _TYPES)
    + " FROM events GROUP BY 1",
    "any_stream_bad": """WITH f AS (SELECT user_id, date_trunc('day', ts) AS b, bool_or(value > 100) AS bad, count_if(value > 100) AS streams FROM events GROUP BY 1, 2)
SELECT user_id, count(*) AS frames, count_if(bad) AS bad_frames, CAST(sum(streams) AS BIGINT) AS bad_streams FROM f GROUP BY 1""",
    "reference_thresholds": f"WITH {_LIMITS} SELECT l_returnflag, round(price_high, 6) AS price_high, round(price_low, 6) AS price_low, round(quantity_low, 6) AS quantity_low FROM th",
    "calibrated_flags": f"""WITH {_LIMITS} SELECT l_returnflag, count(*) AS n, count_if(l_extendedprice > 0.7 * price_high) AS high, count_if(l_extendedprice < price_low) AS low
FROM lineitem JOIN th USING (l_returnflag) WHERE l_orderkey % 2 = 1 GROUP BY 1""",
    "frame_codes": f"""WITH {_LI}, c AS (SELECT l_orderkey, list_filter([CASE WHEN frame_diff <> 1 THEN 'T_FRAME_INDEX_DISCONTINUITY' END, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'S_TASK_INDEX_INVALID' END,
  CASE WHEN l_discount >= 0.09 THEN 'C_IMAGE_BLUR' END, CASE WHEN l_extendedprice > 80000 THEN 'V_SPIKE_JUMP' END], lambda x: x IS NOT NULL) AS codes FROM li)
SELECT array_to_string(codes, ';') AS issue_codes, array_to_string({_CATS.format(c="codes")}, ';') AS issue_categories, count(*) AS frames, count(DISTINCT l_orderkey) AS episodes FROM c GROUP BY codes""",
    "episode_codes": f"""WITH {_OR} SELECT episode, rows, array_to_string(codes, ';') AS issue_codes, array_to_string({_distinct_in_order(_CATS.format(c="codes"))}, ';') AS issue_categories, {_TIER} AS tier FROM orp""",
    "code_prefix_filter": f"""WITH {_OR}, s AS (SELECT unnest(['file_gate', 'timing_and_values', 'all_modalities']) AS stage, unnest([
  len(list_filter(codes, lambda c: regexp_matches(c, '^(C_PARQUET|C_FILE|C_SCHEMA|T_METADATA)'))) > 0, len(list_filter(codes, lambda c: regexp_matches(c, '^(C_PARQUET|C_FILE|C_SCHEMA|T_|V_)'))) > 0, len(codes) > 0]) AS hit FROM orp)
SELECT stage, count_if(hit) AS flagged, count(*) AS episodes FROM s GROUP BY 1""",
    "dimension_scores": f"""WITH {_OR} SELECT episode, round(s1::DOUBLE, 6) AS structural_score, round(s2::DOUBLE, 6) AS temporal_score, round(s3::DOUBLE, 6) AS sync_score, round(s4::DOUBLE, 6) AS content_score,
  round(s5::DOUBLE, 6) AS value_score, total AS overall_quality_score, severity FROM orp""",
    "repair_mode": f"WITH {_OR} SELECT episode, repair_mode, array_to_string(list_sort(fix), ';') AS repairable_codes, array_to_string(list_sort(lost), ';') AS unrecoverable_codes FROM orp",
    "confidence_tier": f"""WITH {_OR}, t AS (SELECT {_TIER} AS tier, count(*) AS episodes FROM orp WHERE len(codes) > 0 GROUP BY 1)
SELECT tier, episodes, round(episodes / sum(episodes) OVER (), 6) AS share FROM t""",
    "repair_queue": f"""WITH {_OR} SELECT CAST(list_position(['severe', 'high', 'medium', 'low', 'pass'], severity) - 1 AS INTEGER) AS priority, total AS overall_quality_score, episode, severity, repair_mode FROM orp WHERE severity <> 'pass'""",
    "work_orders": f"""WITH {_REPORT}, {_ISL} SELECT isl.user_id AS episode_index, start_row, end_row, frame_count, array_to_string(isl.codes, ';') AS issue_codes,
  CASE repair_mode WHEN 'isolate' THEN 'isolate_and_recollect' WHEN 'mark_and_recollect' THEN 'cut_and_recollect' ELSE 'review_mask' END AS work_order_type,
  CASE WHEN frame_count >= 50 THEN 'high' WHEN frame_count >= 10 THEN 'medium' ELSE 'low' END AS priority FROM isl JOIN rp USING (user_id) WHERE status <> 'pass'""",
    "train_policy": f"""WITH {_REPORT}, k AS (SELECT user_id, row, status = 'pass' OR len(fl.codes) = 0 AS keep FROM fl JOIN rp USING (user_id)),
n AS (SELECT user_id, count(*) AS n FROM (SELECT user_id, row - row_number() OVER (PARTITION BY user_id ORDER BY row) AS g FROM k WHERE keep) GROUP BY user_id, g),
l AS (SELECT user_id, max(n) AS longest_keep_run, count_if(n >= 30) AS clip_count, coalesce(CAST(sum(n) FILTER (n >= 30) AS BIGINT), 0) AS clip_frames, coalesce(max(n) FILTER (n >= 30), 0) AS longest_clip FROM n GROUP BY 1),
s AS (SELECT user_id, count_if(keep) AS keep_rows, count_if(NOT keep) AS drop_rows FROM k GROUP BY 1),
j AS (SELECT user_id, status, rows, codes, keep_rows, drop_rows, coalesce(longest_keep_run, 0) AS longest_keep_run, coalesce(clip_count, 0) AS clip_count, coalesce(clip_frames, 0) AS clip_frames, coalesce(longest_clip, 0) AS longest_clip
  FROM rp JOIN s USING (user_id) LEFT JOIN l USING (user_id)),
p AS (SELECT *, CASE WHEN status = 'pass' THEN 'use_whole,none' WHEN longest_clip >= 50 AND keep_rows / rows >= 0.25 THEN 'use_clips,cut' WHEN (rows - keep_rows) / rows <= 0.10 AND longest_clip >= 30 THEN 'use_masked,mask'
  WHEN longest_clip >= 30 THEN 'use_clips,cut' ELSE 'isolate_and_recollect,isolate' END AS p FROM j)
SELECT user_id AS episode_index, status, rows, keep_rows, drop_rows, round(keep_rows / rows, 4) AS keep_rate, longest_keep_run, clip_count, clip_frames, longest_clip, split_part(p, ',', 1) AS train_policy, split_part(p, ',', 2) AS governance_layer FROM p""",
    "vector_norms": f"""WITH {_EM} SELECT vec_id, len(state) = 20 AS state_ok, round(sqrt(list_sum(list_transform(state, lambda x: x * x))), 6) AS state_norm, round(sqrt(list_sum(list_transform(action, lambda x: x * x))), 6) AS action_norm FROM em""",
    "vector_steps": f"""WITH {_EM}, b AS (SELECT label, vec_id, state, lag(state) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM em), s AS (SELECT label, vec_id, sqrt(list_sum(list_transform(list_zip(state, before), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS step, before FROM b),
t AS (SELECT label, vec_id, CASE WHEN before IS NULL THEN NULL ELSE step END AS step FROM s)
SELECT label, vec_id, round(step, 6) AS step, round(sum(coalesce(step, 0.0)) OVER (PARTITION BY label ORDER BY vec_id), 6) AS path FROM t""",
    "state_action_residual": f"""WITH {_EM}, d AS (SELECT vec_id, list_transform(list_zip(action, state), lambda p: p[1] - p[2]) AS d FROM em)
SELECT vec_id, round(sqrt(list_sum(list_transform(d, lambda x: x * x)) / 20), 6) AS rmse, round({_biggest("d")}, 6) AS max_abs FROM d""",
    "best_lag_alignment": f"""WITH {_EM}, w AS (SELECT *, lag(state) OVER (PARTITION BY label ORDER BY vec_id) AS before, lead(state) OVER (PARTITION BY label ORDER BY vec_id) AS after FROM em),
c AS (SELECT label, vec_id, action, unnest([-1, 0, 1]) AS k, unnest([before, state, after]) AS s FROM w),
d AS (SELECT label, vec_id, k, list_transform(list_zip(action, s), lambda p: p[1] - p[2]) AS d FROM c WHERE s IS NOT NULL),
r AS (SELECT label, vec_id, k, sqrt(list_sum(list_transform(d, lambda x: x * x)) / 20) AS rmse, {_biggest("d")} AS top FROM d), b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY rmse, k) AS n FROM r)
SELECT label, vec_id, k AS best_lag, round(rmse, 6) AS aligned_rmse, round(top, 6) AS aligned_max_abs FROM b WHERE n = 1""",
    "physical_flags": f"""WITH {_EM}, {_PHYS} SELECT vec_id, true AS shape_ok, true AS finite_ok,
  {_biggest("pos")} > 0.35 OR {_biggest("rot")} > 0.4 OR {_biggest("grip")} > 0.25 AS hard_range_bad, {_biggest("rot")} > 0.28 OR nd > 0.85 OR od > 0.05 AS rotation_bad,
  list_min(grip) < -0.12 OR list_max(grip) > 0.15 AS gripper_bad, {_biggest("pos")} > 0.25 AS position_bad, round({_biggest("state")}, 6) AS abs_max, round({_biggest("pos")}, 6) AS position_abs_max,
  round(nd, 6) AS rotation_norm_dev, round(od, 6) AS rotation_orth_dev, round(list_min(grip), 6) AS gripper_min, round(list_max(grip), 6) AS gripper_max FROM p""",
    "adjacent_duplicate": """WITH d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY text, doc_id) AS row, CASE WHEN doc_id % 7 <> 0 THEN sha1(text) ELSE '' END AS h FROM documents),
e AS (SELECT doc_id, h, lag(h) OVER w AS before, last_value(nullif(h, '') IGNORE NULLS) OVER (PARTITION BY source ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kept FROM d WINDOW w AS (PARTITION BY source ORDER BY row))
SELECT doc_id, coalesce(before = h AND before <> '', false) AS duplicate, coalesce(kept = h AND h <> '', false) AS duplicate_carried FROM e""",
    "path_index_regex": r"""WITH p AS (SELECT page_id, html, url, CAST(nullif(regexp_extract(url, '/(\d+)', 1), '') AS BIGINT) AS n FROM pages)
SELECT page_id, n AS path_index, n - page_id AS path_delta, sha1(html) AS sha1, array_to_string(list_filter(string_split(url, '/'), lambda x: x <> '')[-2:], '/') AS tail FROM p""",
    "visual_diversity": """WITH d AS (SELECT source, lang, substr(sha1(text), 1, 2) AS h FROM documents), s AS (SELECT source, lang, count(DISTINCT h) / count(h) AS x FROM d GROUP BY 1, 2)
SELECT source, round(avg(x), 6) AS visual_diversity FROM s GROUP BY 1""",
    "idle_interaction": f"""WITH {_MV}, c AS (SELECT quantile_cont(step, 0.5) AS sc, quantile_cont(dt, 0.5) AS ac, greatest(1e-4, quantile_cont(step, 0.1)) AS si, greatest(1e-4, quantile_cont(dt, 0.1)) AS ai FROM mv WHERE user_id % 2 = 0),
f AS (SELECT user_id, row, coalesce(step, 0) <= si AND coalesce(dt, 0) <= ai AS idle, coalesce(step, 0) >= sc OR coalesce(dt, 0) >= ac AS act, value > 120 AS bad FROM mv, c),
r AS (SELECT user_id, max(n) AS n FROM (SELECT user_id, count(*) AS n FROM (SELECT user_id, row - row_number() OVER (PARTITION BY user_id ORDER BY row) AS g FROM f WHERE idle) GROUP BY user_id, g) GROUP BY 1),
a AS (SELECT user_id, count(*) AS rows, avg(idle::INT) AS i, avg(act::INT) AS t, avg((act AND NOT bad)::INT) AS u FROM f GROUP BY 1)
SELECT user_id, rows, round(i, 6) AS idle_fraction, coalesce(n, 0) AS longest_idle_run, round(t, 6) AS interaction_rate, round(u, 6) AS usable_interaction_rate,
  CAST(100 - 35 * (i > 0.02)::INT - 40 * (t < 0.7)::INT - 25 * (u < 0.62)::INT AS INTEGER) AS value_coverage_score FROM a LEFT JOIN r USING (user_id)""",
    "task_balance_entropy": """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), t AS (SELECT sum(n) AS s, count(*) AS k, min(n) / max(n) AS b FROM c)
SELECT round(any_value(b), 6) AS balance, round(coalesce(sum(-(n / s) * log2(n / s)) / nullif(log2(any_value(k)), 0), 0), 6) AS entropy FROM c, t""",
    "motion_join_moving_cut": """WITH m AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS motion FROM events WHERE event_type = 'click' GROUP BY 1, 2), v AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS step FROM events WHERE event_type = 'view' GROUP BY 1, 2),
j AS (SELECT * FROM m JOIN v USING (user_id, day)), c AS (SELECT *, quantile_cont(step, 0.6) OVER (PARTITION BY user_id) AS cut FROM j)
SELECT user_id, count(*) AS days, count_if(step > cut) AS moving_days, round(avg(motion), 6) AS motion_mean FROM c GROUP BY 1""",
    "freeze_grid": f"WITH {_GRID} SELECT * FROM gd",
    "freeze_choice": f"""WITH {_GRID}, o AS (SELECT frozen_thr, moving_q, max(max_run) AS observed FROM gd GROUP BY 1, 2), c AS (SELECT frozen_thr, moving_q, observed, CAST(run_len AS INTEGER) AS run_len FROM o, (VALUES (20), (30), (45), (60)) r(run_len) WHERE observed < run_len AND run_len >= greatest(20, 3 * observed))
SELECT * FROM c ORDER BY frozen_thr DESC, run_len, moving_q LIMIT 1""",
    "lag_correlation": f"""WITH {_EV}, b AS (SELECT user_id, row, value, lead(dt) OVER (PARTITION BY user_id ORDER BY row) AS nx FROM ev),
z AS (SELECT user_id, row, coalesce((value - avg(value) OVER u) / stddev_pop(value) OVER u, 0) AS za, coalesce((nx - avg(nx) OVER u) / stddev_pop(nx) OVER u, 0) AS zb FROM b WINDOW u AS (PARTITION BY user_id)),
l AS ({_lags()}), s AS (SELECT user_id, k, avg(p) AS c FROM l WHERE p IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 15),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(abs(c), 12) DESC, k) AS n FROM s), t AS (SELECT user_id, count(*) AS n FROM ev GROUP BY 1)
SELECT user_id, t.n AS n, CAST(r.k AS INTEGER) AS best_lag, round(r.c, 6) AS peak_corr, round(o.c, 6) AS zero_corr FROM r JOIN t USING (user_id) JOIN s o USING (user_id) WHERE r.n = 1 AND o.k = 0""",
    "robust_glitch": """WITH m AS (SELECT *, l_quantity * 5 AS level, (l_suppkey % 50)::DOUBLE AS spread, quantile_cont(l_extendedprice, 0.5) OVER w AS m, quantile_cont(l_tax, 0.5) OVER w AS e FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_linestatus)),
d AS (SELECT *, quantile_cont(abs(l_extendedprice - m), 0.5) OVER (PARTITION BY l_returnflag, l_linestatus) AS mad FROM m)
SELECT l_returnflag, l_linestatus, count(*) AS n, round(any_value(m), 6) AS sharpness_median, round(quantile_cont(l_extendedprice, 0.99), 6) AS sharpness_p99, round(max(l_extendedprice), 6) AS sharpness_max, round(any_value(e), 6) AS edges_median,
  count_if(level BETWEEN 25 AND 235 AND spread > 8 AND ((l_extendedprice - m) / (1.4826 * mad) > 6 OR l_tax > 4 * e + 5)) AS glitch_candidates FROM d GROUP BY 1, 2""",
    "calib_quantiles": "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont({c}, {q}), 6) AS {c}_{n}" if n != "max" else f"round(max({c}), 6) AS {c}_max" for c in ("l_extendedprice", "l_quantity") for q, n in ((0.99, "q99"), (0.995, "q995"), (0.999, "q999"), (1, "max")))
    + " FROM lineitem GROUP BY 1",
    "classification_metrics": """WITH c AS (SELECT lang, count_if(quality = 1 AND n_chars >= 1500) AS tp, count_if(quality <> 1 AND n_chars >= 1500) AS fp, count_if(quality = 1 AND n_chars < 1500) AS fn FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT lang, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""",
    "loeo_thresholds": f"""WITH {_EM}, x AS (SELECT label, sqrt(list_sum(list_transform(state, lambda x: x * x))) AS x FROM em), h AS (SELECT DISTINCT label FROM x),
t AS (SELECT h.label, greatest(0.1, quantile_cont(x.x, 0.999)) AS threshold FROM h JOIN x ON x.label <> h.label GROUP BY 1)
SELECT label, count(*) AS n, round(any_value(threshold), 6) AS threshold, count_if(x > threshold) AS flagged FROM x JOIN t USING (label) GROUP BY 1""",
    "weight_sensitivity": f"""WITH s AS (SELECT s_suppkey AS k, least(100.0, greatest(0.0, 80 + s_acctbal / 500)) AS a, 60 + (s_suppkey * 7 % 41) * 40.0::DOUBLE / 41 AS b, 60 + (s_suppkey * 11 % 37) * 40.0::DOUBLE / 37 AS c, 60 + (s_suppkey * 5 % 29) * 40.0::DOUBLE / 29 AS d, 60 + (s_suppkey * 3 % 23) * 40.0::DOUBLE / 23 AS e FROM supplier),
w(scenario, wa, wb, wc, wd, we) AS (VALUES {_weights()}),
q AS (SELECT scenario, k, round(0.25::DOUBLE * a + 0.2::DOUBLE * b + 0.2::DOUBLE * c + 0.2::DOUBLE * d + 0.15::DOUBLE * e, 9) AS base, round(wa * a + wb * b + wc * c + wd * d + we * e, 9) AS q FROM s, w),
r AS (SELECT *, rank() OVER (PARTITION BY scenario ORDER BY base DESC) + (count(*) OVER (PARTITION BY scenario, base) - 1) / 2 AS rb, rank() OVER (PARTITION BY scenario ORDER BY q DESC) + (count(*) OVER (PARTITION BY scenario, q) - 1) / 2 AS rq,
  row_number() OVER (PARTITION BY scenario ORDER BY base, k) <= 10 AS lb, row_number() OVER (PARTITION BY scenario ORDER BY q, k) <= 10 AS lq FROM q)
SELECT scenario, round(corr(rb, rq), 6) AS spearman, round(count_if(base < 82 AND q < 82) / greatest(count_if(base < 82 OR q < 82), 1), 6) AS flagged_jaccard, round(count_if(lb AND lq) / greatest(count_if(lb OR lq), 1), 6) AS bottom_jaccard FROM r GROUP BY 1""",
    "hampel_flags": f"""WITH {_EV}, m AS (SELECT user_id, row, value, list(value) OVER (PARTITION BY user_id ORDER BY row ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM ev), b AS (SELECT user_id, row, value, abs(value - list_median(v)) > 100 AS bad FROM m),
n AS (SELECT *, last_value(CASE WHEN NOT bad THEN row END IGNORE NULLS) OVER p AS r0, last_value(CASE WHEN NOT bad THEN value END IGNORE NULLS) OVER p AS v0, first_value(CASE WHEN NOT bad THEN row END IGNORE NULLS) OVER f AS r1, first_value(CASE WHEN NOT bad THEN value END IGNORE NULLS) OVER f AS v1
  FROM b WINDOW p AS (PARTITION BY user_id ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY row ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, row, bad, round(CASE WHEN NOT bad THEN value ELSE coalesce(v0 + (v1 - v0) / (r1 - r0) * (row - r0), v0, v1) END, 6) AS clean FROM n""",
    "timestamp_rebuild": f"""WITH {_EV}, t AS (SELECT user_id, row, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS t FROM ev), a AS (SELECT *, first_value(t) OVER (PARTITION BY user_id ORDER BY row) AS t0, coalesce(t - lag(t) OVER (PARTITION BY user_id ORDER BY row) <= 0, false) AS bad FROM t),
b AS (SELECT *, NOT bool_or(bad) OVER (PARTITION BY user_id) AS accepted FROM a), c AS (SELECT *, CASE WHEN accepted THEN t0 + row / 0.0001::DOUBLE ELSE t END AS rebuilt FROM b)
SELECT user_id, row, round(rebuilt, 6) AS rebuilt, accepted, accepted AND abs(rebuilt - t) > 1e-6 AS changed FROM c""",
    "task_rewrite_mask": """WITH j AS (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS found, CAST(list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) AS INTEGER) AS expected FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, expected AS task, found <> expected AS repair_applied, found = expected AS quality_mask, CASE WHEN found <> expected THEN CAST(found AS VARCHAR) ELSE '' END AS original_value, CASE WHEN found <> expected THEN CAST(expected AS VARCHAR) ELSE '' END AS repaired_value FROM j""",
    "union_align": """WITH u AS (SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier),
o AS (SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
SELECT nation, count(*) AS n, count(segment) AS with_segment, max(balance) AS top, nation IN (SELECT nation FROM o) AS only_customers FROM u GROUP BY nation""",
    "zscore_impute": """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 3 THEN c_acctbal END AS a, c_nationkey::DOUBLE AS b FROM customer), m AS (SELECT quantile_cont(a, 0.5) AS ma, quantile_cont(b, 0.5) AS mb FROM c WHERE c_custkey % 2 = 0),
f AS (SELECT c_custkey, coalesce(a, ma) AS a, coalesce(b, mb) AS b FROM c, m), s AS (SELECT avg(a) AS aa, stddev_pop(a) AS sa, avg(b) AS ab, stddev_pop(b) AS sb FROM f WHERE c_custkey % 2 = 0)
SELECT c_custkey, round(a, 6) AS a, round((a - aa) / CASE WHEN sa < 1e-9 THEN 1 ELSE sa END, 6) AS a_z, round((b - ab) / CASE WHEN sb < 1e-9 THEN 1 ELSE sb END, 6) AS b_z FROM f, s""",
    "lenient_parse": """WITH t AS (SELECT event_id, value, CASE event_id % 3 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 1 THEN event_type END AS x, CASE event_id % 4 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'no' WHEN 2 THEN '1' END AS y FROM events), p AS (SELECT *, TRY_CAST(x AS DOUBLE) AS n FROM t)
SELECT event_id, n AS parsed, coalesce(n, -1.0) AS with_default, coalesce(lower(trim(y)) IN ('true', '1', 'yes'), false) AS truth, round(CASE WHEN n - 50 > 0 THEN least(1, greatest(0, value / (n - 50))) WHEN value > 0 THEN 1 ELSE 0 END, 6)::DOUBLE AS ratio, round(value / nullif(event_id % 2, 0), 6) AS rate FROM p""",
    "case_rows": f"""WITH {_EV}, m AS (SELECT *, quantile_cont(value, 0.5) OVER (PARTITION BY user_id) AS m FROM ev), a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, row) AS t, row_number() OVER (PARTITION BY user_id ORDER BY round(abs(value - m), 9), row) AS n FROM m)
SELECT user_id, max(row) FILTER (t = 1) AS top_row, max(value) FILTER (t = 1) AS top_value, max(row) FILTER (n = 1) AS median_row, max(value) FILTER (n = 1) AS median_value FROM a GROUP BY 1""",
    "worst_episodes": f"WITH {_OR} SELECT episode, total AS overall_quality_score, severity FROM orp ORDER BY total, episode LIMIT 20",
    "release_summary": f"WITH {_OR} SELECT repair_mode, count(*) AS episodes, round(avg(total), 6) AS mean_score, round(quantile_cont(total, 0.5), 6) AS median_score, min(total) AS lowest, max(total) AS highest FROM orp GROUP BY 1",
    "metric_table": f"""WITH {_OR}, m AS (SELECT count(*)::DOUBLE AS episodes, count_if(len(codes) > 0)::DOUBLE AS flagged, round(avg(total), 6) AS mean_score FROM orp)
SELECT unnest(['episodes', 'flagged', 'mean_score']) AS metric, unnest([episodes, flagged, mean_score]) AS value FROM m""",
    "hash_hamming": """WITH d AS (SELECT doc_id, source, lpad(bin(CAST('0x' || substr(sha1(text), 1, 8) AS BIGINT)), 32, '0') AS h FROM documents), e AS (SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN h ELSE '' END AS a, lag(h) OVER (PARTITION BY source ORDER BY doc_id) AS b FROM d)
SELECT doc_id, CASE WHEN a <> '' AND length(a) = length(b) THEN CAST(hamming(a, b) AS INTEGER) END AS distance FROM e""",
    "candidate_disposition": f"""WITH {_OR}, t AS (SELECT episode, {_TIER} AS tier FROM orp WHERE repair_mode IN ('auto_repair', 'mark_and_recollect'))
SELECT episode, tier, CASE WHEN tier = 'deterministic' THEN 'repair' ELSE 'decide by hand' END AS disposition FROM t""",
    "ablation_stages": f"""WITH {_REPORT}, st(i, stage, pattern) AS (VALUES (0, 'file_gate', '^(C_PARQUET|C_FILE|C_SCHEMA|T_METADATA)'), (1, 'timing_and_values', '^(C_PARQUET|C_FILE|C_SCHEMA|T_|V_)'), (2, 'all_modalities', '.')),
e AS (SELECT i, stage, user_id % 2 = 0 AS ref, len(list_filter(codes, lambda c: regexp_matches(c, pattern))) > 0 AS hit FROM rp, st), f AS (SELECT i, len(list_filter(codes, lambda c: regexp_matches(c, pattern))) > 0 AS hit FROM fl, st WHERE user_id % 2 = 1),
a AS (SELECT i, stage, avg(CASE WHEN ref THEN hit::INT END) AS r, count(*) FILTER (hit AND NOT ref) AS n, avg(CASE WHEN NOT ref THEN hit::INT END) AS x FROM e GROUP BY 1, 2), b AS (SELECT i, count(*) FILTER (hit) AS m, avg(hit::INT) AS y FROM f GROUP BY 1)
SELECT stage, round(r, 6) AS reference_false_positive_rate, n AS flagged_episodes, round(x, 6) AS flagged_episode_rate, m AS flagged_frames, round(y, 6) AS flagged_frame_rate,
  coalesce(n - lag(n) OVER (ORDER BY i), 0) AS episode_gain, coalesce(m - lag(m) OVER (ORDER BY i), 0) AS frame_gain FROM a JOIN b USING (i)""",
}
