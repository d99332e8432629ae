"""The same queries as SQL, for a second engine."""

from epiframe.registry.episode_sql import FRAMES, STEPS, WINDOW_FACTS, WINDOWS
from epiframe.registry.episode_sql import SQL as EPISODE_SQL

LINES = """lines AS (
  SELECT user_id AS run_id, event_id AS line_no, event_type || '=' || value || '  # step=' || event_id AS line FROM events)"""

ARCH = "CASE {run} % 5 WHEN 0 THEN 'smolvla' WHEN 1 THEN 'act' WHEN 2 THEN 'diffusion' WHEN 3 THEN 'dreamerv3' ELSE 'le_world_model' END"
METRIC = "CASE WHEN {run} % 5 < 3 THEN 'pc_success' WHEN {run} % 5 = 3 THEN 'recon_loss' ELSE 'pred_loss' END"

PRIMARY = f"""primary_metrics AS (
  SELECT user_id AS run_id, event_id AS line_no, {METRIC.format(run='user_id')} AS name, value,
         event_type = CASE WHEN user_id % 5 < 3 THEN 'click' WHEN user_id % 5 = 3 THEN 'view' ELSE 'error' END AS hit
  FROM events)"""

PIXELS = """pixels AS (
  SELECT vec_id AS row_index, label, i AS pos, embedding[i % 64 + 1] AS x,
         CAST(trunc(greatest(0::FLOAT, least(255::FLOAT, embedding[i % 64 + 1] * 255::FLOAT))) AS BIGINT) AS q
  FROM embeddings, (SELECT unnest(range(192)) AS i))"""

HEX = "string_agg(printf('%02X', q), '' ORDER BY {order}) AS pixels"

FLAT = """flat AS (
  SELECT vec_id, embedding, CASE label % 5 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 6 WHEN 3 THEN 18 ELSE 25 END AS n FROM embeddings)"""


def _dequantized(x: str) -> str:
    return f"round(CAST({x}::FLOAT / 255::FLOAT AS DOUBLE), 6)"


SQL = {
    "format_metric": """SELECT event_id, 'eval_' || event_type || '=' || format('{:.6g}', value * 1000 / 7) || '  # step=' || event_id AS line FROM events""",
    "format_metric_unstepped": "SELECT o_orderkey, 'total_price=' || format('{:.6g}', o_totalprice) AS line FROM orders",
    "metric_names": r"""SELECT p_partkey, name, regexp_full_match(name, '[A-Za-z0-9_]+') AND regexp_matches(name, '[A-Za-z0-9]') AS valid
FROM (SELECT p_partkey, unnest([p_name, p_brand, p_type, replace(p_name, ' ', '_'), '___', '']) AS name FROM part)""",
    "parse_metric": f"""WITH {LINES} SELECT run_id, line_no, regexp_extract(line, '(\\w+)[=:\\s]+([0-9.eE+-]+)', 1) AS name,
  TRY_CAST(regexp_extract(line, '(\\w+)[=:\\s]+([0-9.eE+-]+)', 2) AS DOUBLE) AS value FROM lines""",
    "parse_metric_prose": r"""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
found AS (
  SELECT doc_id, line_no, regexp_extract(line, '([\pL\pN_]+)[=:\s]+([0-9.eE+-]+)', 1) AS name,
         TRY_CAST(regexp_extract(line, '([\pL\pN_]+)[=:\s]+([0-9.eE+-]+)', 2) AS DOUBLE) AS value FROM lines)
SELECT doc_id, line_no, name, value FROM found WHERE value IS NOT NULL""",
    "parse_arch_metric": f"""WITH {PRIMARY} SELECT run_id, line_no, CASE WHEN hit THEN name END AS name, CASE WHEN hit THEN value END AS value FROM primary_metrics""",
    "parse_step": f"""WITH {LINES} SELECT run_id, line_no, CAST(regexp_extract(line, 'step=(\\d+)', 1) AS BIGINT) AS step FROM lines""",
    "thin_log": """SELECT user_id AS run_id, event_id AS step FROM events
WHERE event_id = 1 OR event_id % 50 = 0 OR (user_id, event_id) IN (SELECT user_id, max(event_id) FROM events GROUP BY 1)""",
    "attach_primary_metric": f"""SELECT c_custkey AS run_id, {ARCH.format(run='c_custkey')} AS target_arch, {METRIC.format(run='c_custkey')} AS metric,
  CASE WHEN c_custkey % 5 < 3 THEN 'max' ELSE 'min' END AS direction FROM customer""",
    "last_metric": f"""WITH {PRIMARY}
SELECT c_custkey AS run_id, {ARCH.format(run='c_custkey')} AS target_arch, coalesce(last_value, 0.0) AS value
FROM customer LEFT JOIN (SELECT run_id, arg_max(value, line_no) AS last_value FROM primary_metrics WHERE hit GROUP BY 1) ON run_id = c_custkey""",
    "best_metric": f"""WITH {PRIMARY}
SELECT c_custkey AS run_id, {METRIC.format(run='c_custkey')} AS metric, CASE WHEN c_custkey % 5 < 3 THEN hi ELSE lo END AS best
FROM customer LEFT JOIN (SELECT run_id, min(value) AS lo, max(value) AS hi FROM primary_metrics WHERE hit GROUP BY 1) ON run_id = c_custkey""",
    "distinct_metrics": "SELECT user_id AS run_id, event_id AS step, event_type AS name, value FROM events",
    "write_metric_lines": "SELECT event_type || '=' || format('{:.6g}', value) || '  # step=' || event_id AS line FROM events",
    "read_train_log": """WITH written AS (SELECT event_id AS step, row_number() OVER (ORDER BY event_id) AS place FROM events)
SELECT step, step = min(step) OVER () + place - 1 AS in_order FROM written""",
    "stream_metrics": "SELECT event_type AS name, CAST(format('{:.6g}', value) AS DOUBLE) AS value, event_id AS step FROM events",
    "stream_run_table": f"""WITH {PRIMARY}
SELECT c_custkey AS run_id, {ARCH.format(run='c_custkey')} AS target_arch, {METRIC.format(run='c_custkey')} AS metric, coalesce(last_value, 0.0) AS value,
  CASE WHEN c_custkey % 5 < 3 THEN hi ELSE lo END AS best, coalesce(n, 0) AS n_values
FROM customer LEFT JOIN (
  SELECT run_id, arg_max(value, line_no) AS last_value, min(value) AS lo, max(value) AS hi, count(*) AS n FROM primary_metrics WHERE hit GROUP BY 1) ON run_id = c_custkey""",
    "write_read_frames": f"WITH {FRAMES} SELECT episode_index, frame_index, event_id, round(value, 6) AS a0 FROM frames",
    "dataset_meta": """SELECT count(DISTINCT user_id) AS total_episodes, count(*) AS total_frames, CAST(30 AS DOUBLE) AS fps,
  round(greatest(max(value), max(length(event_type))), 4) AS largest_action FROM events""",
    "read_windows": f"WITH {WINDOWS} {WINDOW_FACTS} FROM win GROUP BY 1, 2",
    "read_windows_from_frames": EPISODE_SQL["head_truncate"],
    "stream_ingest_frames": "SELECT event_id, user_id, event_type, value FROM events",
    "stream_stuck_actions": EPISODE_SQL["stuck_actions"],
    "quantize_u8": f"WITH {PIXELS} SELECT row_index, {HEX.format(order='pos')} FROM pixels GROUP BY 1",
    "quantize_array": f"WITH {PIXELS} SELECT row_index, pos, q FROM pixels",
    "dequantize_u8": f"WITH {PIXELS} SELECT row_index, pos, {_dequantized('q')} AS x FROM pixels",
    "hwc_to_chw": f"WITH {PIXELS} SELECT row_index, (pos % 3) * 64 + pos // 3 AS pos, round(CAST(x AS DOUBLE), 6) AS x FROM pixels",
    "hwc_to_chw_bytes": f"WITH {PIXELS} SELECT row_index, {HEX.format(order='pos % 3, pos // 3')} FROM pixels GROUP BY 1",
    "resize_images": f"""WITH {PIXELS} SELECT row_index, {HEX.format(order='pos')} FROM pixels
WHERE (pos // 24) % 2 = 0 AND (pos // 3) % 8 % 2 = 0 GROUP BY 1""",
    "coerce_image": f"""WITH {PIXELS}
SELECT row_index, CASE WHEN any_value(label) % 5 IN (0, 2) THEN string_agg(printf('%02X', q), '' ORDER BY pos % 3, pos // 3)
  WHEN any_value(label) % 5 = 1 THEN string_agg(printf('%02X', q), '' ORDER BY pos) ELSE repeat('00', 192) END AS pixels FROM pixels GROUP BY 1""",
    "row_bytes": f"WITH {PIXELS} SELECT row_index, CAST(4 * count(x) + count(q) AS BIGINT) AS n_bytes FROM pixels GROUP BY 1",
    "cached_frames": f"""WITH {PIXELS} SELECT row_index, any_value(label) AS label, CAST(8 * count(*) AS BIGINT) AS n_values,
  CAST(8 * sum(q) AS DOUBLE) AS total FROM pixels GROUP BY 1""",
    "image_columns": """SELECT 'image' AS column_name, 3 * max(len(embedding)) AS n_values, 3 * max(len(embedding)) > 1024 AS is_image FROM embeddings
UNION ALL SELECT 'front_rgb', 48 * max(len(embedding)), 48 * max(len(embedding)) > 1024 FROM embeddings""",
    "normalized_columns": f"""WITH {PIXELS}
SELECT 'image' AS column_name, round(CAST(max(x) AS DOUBLE), 4) AS max_value, max(x) <= 1.5 AS is_normalized FROM pixels
UNION ALL SELECT 'bright', round(CAST(max(x * 255::FLOAT) AS DOUBLE), 4), max(x * 255::FLOAT) <= 1.5 FROM pixels""",
    "size_budget": """WITH running AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS place, sum(4 * 192) OVER (ORDER BY vec_id) AS so_far FROM embeddings)
SELECT count(*) AS n_rows, CAST(max(so_far) AS BIGINT) AS total_bytes, CAST(64000 AS BIGINT) AS limit_bytes, max(so_far) > 64000 AS over_budget,
       min(place) FILTER (so_far > 64000) AS first_over_sample, CAST(min(so_far) FILTER (so_far > 64000) AS BIGINT) AS bytes_at_sample FROM running""",
    "split_state": f"""WITH {FLAT}
SELECT vec_id, i - 1 AS pos, CASE WHEN n >= 6 THEN round(CAST(embedding[i] AS DOUBLE), 6) ELSE 0.0::DOUBLE END AS x
FROM flat, (SELECT unnest(range(1, 7)) AS i)""",
    "split_state_with_pose": f"""WITH {FLAT}
SELECT vec_id, i - 1 AS pos, CASE WHEN n < 6 THEN 0.0::DOUBLE WHEN i <= 6 THEN round(CAST(embedding[i] AS DOUBLE), 6)
  WHEN n >= 25 THEN round(CAST(embedding[i + 12] AS DOUBLE), 6) ELSE 0.0::DOUBLE END AS x
FROM flat, (SELECT unnest(range(1, 14)) AS i)""",
    "assemble_state_terms": """SELECT vec_id, i - 1 AS pos, CASE WHEN i <= 6 THEN CASE WHEN label = 0 THEN 0.0 ELSE round(CAST(embedding[i] AS DOUBLE), 6) END
  WHEN label = 1 THEN 0.0 ELSE round(CAST(embedding[i + 12] AS DOUBLE), 6) END::DOUBLE AS x
FROM embeddings, (SELECT unnest(range(1, 14)) AS i)""",
    "object_pose": """SELECT vec_id, i AS pos, round(CAST(embedding[CASE WHEN i < 4 THEN 22 + i ELSE 15 + i END] AS DOUBLE), 6) AS x
FROM embeddings, (SELECT unnest(range(7)) AS i)""",
    "motors_to_state": """SELECT l_orderkey, l_linenumber, round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 2) AS s0,
  round(CAST(CAST(l_discount AS FLOAT) AS DOUBLE), 2) AS s1, round(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE), 2) AS s2 FROM lineitem""",
    "action_to_columns": f"WITH {FRAMES} SELECT episode_index, frame_index, value AS wrist, len AS elbow FROM frames",
    "rename_image_columns": f"""WITH {PIXELS} SELECT row_index, {HEX.format(order='pos').replace('AS pixels', 'AS observation_images_wrist')},
  CAST(any_value(label) AS DOUBLE) AS elbow_pos FROM pixels GROUP BY 1""",
    "signature": """SELECT source, sha1('local/' || source || '|/data|' || count(*) || '|' || string_agg(DISTINCT lang, ',' ORDER BY lang) || '|1') AS signature
FROM documents GROUP BY 1""",
    "dataset_id": """SELECT page_id, CASE WHEN url LIKE 'https%' THEN array_to_string(list_slice(string_split(rtrim(url, '/'), '/'), -2, -1), '/') ELSE url END AS dataset_id FROM pages""",
    "recording_id": "SELECT p_partkey, 'local/' || replace(lower(p_type || '-' || p_brand), '-', '_') || '_dr' AS recording_id FROM part",
    "select_rows": """WITH listed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM labels)
SELECT 2 * i + j AS pos, doc_id AS row_index, n_chars FROM listed JOIN documents USING (doc_id), (SELECT unnest([0, 1]) AS j)""",
    "select_indexed": """WITH listed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM labels)
SELECT 2 * i + j AS pos, doc_id AS row_index, n_chars FROM listed JOIN documents USING (doc_id), (SELECT unnest([0, 1]) AS j)""",
    "restored_order": "SELECT doc_id AS row_index, n_chars FROM documents ORDER BY doc_id",
    "merge_sources": f"""WITH {FRAMES} SELECT 'real' AS source, episode_index, frame_index, round(value, 4) AS value FROM frames
UNION ALL SELECT 'dr', episode_index, frame_index, round(value * 2, 4) FROM frames""",
    "renumber_episodes": f"""WITH {FRAMES}, merged AS (
  SELECT 'real' AS source, episode_index, frame_index FROM frames UNION ALL SELECT 'dr', conv_id, turn FROM conversations)
SELECT source, episode_index, frame_index, dense_rank() OVER (ORDER BY source, episode_index) - 1 AS merged_index FROM merged""",
    "record_dataset": f"""WITH {STEPS}
SELECT dense_rank() OVER (ORDER BY stream_id, episode_index) - 1 AS episode_index, frame_index,
       round(CAST(CAST(frame_index / 30.0 AS FLOAT) AS DOUBLE), 5) AS timestamp,
       round(coalesce(lag(value) OVER (PARTITION BY stream_id, episode_index ORDER BY frame_index), -1.0), 3) AS s0, len AS a0
FROM recorded""",
    "stream_rate_audit": f"""WITH {FRAMES}
SELECT episode_index, count(*) AS n_overruns, max(gap) AS max_gap_us
FROM (SELECT episode_index, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY episode_index ORDER BY frame_index)) AS gap FROM frames)
WHERE gap > 1000000 / 30.0 GROUP BY 1""",
    "stream_recording": f"""WITH {STEPS}
SELECT stream_id, seq, episode_index, frame_index, round(CAST(CAST(frame_index / 30.0 AS FLOAT) AS DOUBLE), 5) AS timestamp,
       round(coalesce(lag(value) OVER (PARTITION BY stream_id, episode_index ORDER BY frame_index), -1.0), 3) AS s0, len AS a0
FROM recorded
QUALIFY bool_or(done) OVER (PARTITION BY stream_id, episode_index)""",
    "image_stats": """WITH px AS (
  SELECT (i - 1) % 2 AS c, CAST(floor(abs(CAST(embedding[i] AS DOUBLE)) * 100) AS INT) AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i))
SELECT 'image' AS feature, CAST(c AS INTEGER) AS channel, count(*) AS count, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std,
       quantile_disc(v, 0.01) AS q01, quantile_disc(v, 0.5) AS q50, quantile_disc(v, 0.99) AS q99 FROM px GROUP BY c""",
    "filtered_dataset_meta": """WITH kept AS (SELECT user_id AS episode_index, count(*) AS length FROM events GROUP BY 1 HAVING count(*) >= 60)
SELECT episode_index, length, (SELECT count(*) FROM kept) AS total_episodes, (SELECT CAST(sum(length) AS BIGINT) FROM kept) AS total_frames, CAST(4 AS BIGINT) AS n_stats FROM kept""",
    "shape_report": """SELECT 'whole' AS column_name, CAST(64 AS BIGINT) AS expected, count(*) AS n_rows, count(*) FILTER (len(embedding) <> 64) AS n_wrong FROM embeddings
UNION ALL SELECT 'cut', 64, count(*), count(*) FILTER (label = 3) FROM embeddings""",
    "snapshot_by_file": "SELECT event_id, user_id, round(value * 2, 4) AS value FROM events",
    "snapshot_windows": f"WITH {WINDOWS} {WINDOW_FACTS} FROM win GROUP BY 1, 2",
    "persisted_frames": "SELECT user_id AS episode_index, count(*) - 1 AS last_frame, round(sum(value), 3) AS sum_value FROM events GROUP BY 1",
    "converted_windows": f"""WITH {WINDOWS}, lim AS (SELECT min(value) AS v0, max(value) AS v1 FROM frames)
SELECT episode_index, start, t, round(CAST(CAST(2 * (value - v0) / (v1 - v0) - 1 AS FLOAT) AS DOUBLE), 5) AS a0 FROM win, lim""",
}
