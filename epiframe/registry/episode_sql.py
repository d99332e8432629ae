"""The same queries as SQL, for a second engine."""

FRAMES = """frames AS (
  SELECT user_id AS episode_index,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index,
         ts, event_id, event_type, value, CAST(length(event_type) AS DOUBLE) AS len
  FROM events)"""

WINDOWS = FRAMES + """, starts AS (
  SELECT f.*, s.start FROM frames f
  JOIN (SELECT DISTINCT frame_index AS start FROM frames WHERE frame_index % 8 = 0) s
    ON f.frame_index >= s.start AND f.frame_index < s.start + 16),
full_starts AS (SELECT episode_index, start FROM starts GROUP BY 1, 2 HAVING count(*) = 16),
win AS (SELECT s.*, s.frame_index - s.start AS t FROM starts s JOIN full_starts USING (episode_index, start)),
win_ids AS (
  SELECT episode_index, start, row_number() OVER (ORDER BY episode_index, start) - 1 AS window_id FROM full_starts)"""

WINDOW_FACTS = """SELECT episode_index, start, count(*) AS n_steps, arg_min(event_id, frame_index) AS first_event,
  arg_max(event_id, frame_index) AS last_event, round(sum(value), 4) AS sum_value"""

# Episodes cut from step logs: a new one after each error or purchase.
STEPS = """steps AS (
  SELECT user_id AS stream_id, event_id AS seq, value, CAST(length(event_type) AS DOUBLE) AS len,
         event_type IN ('error', 'purchase') AS done FROM events),
numbered AS (
  SELECT *, coalesce(sum(CAST(done AS INT)) OVER (
    PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS episode_index
  FROM steps),
recorded AS (
  SELECT *, row_number() OVER (PARTITION BY stream_id, episode_index ORDER BY seq) - 1 AS frame_index FROM numbered)"""


def scores(source: str) -> str:
    """CTEs sal_scores and ted_scores by direct sums over the frames of ``source``."""
    return f"""
moves AS (
  SELECT episode_index, frame_index AS n, sqrt(pow(nv - value, 2) + pow(nl - len, 2)) AS speed FROM (
    SELECT *, lead(value) OVER w AS nv, lead(len) OVER w AS nl FROM {source}
    WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)) WHERE nv IS NOT NULL),
sizes AS (
  SELECT episode_index, sum(speed) AS total, pow(2, ceil(log2(count(*))) + 4) AS m
  FROM moves GROUP BY 1 HAVING count(*) >= 2 AND sum(speed) > 0),
spectrum AS (
  SELECT s.episode_index, k, sqrt(pow(sum(speed * cos(2 * pi() * k * n / m)), 2)
                                + pow(sum(speed * sin(2 * pi() * k * n / m)), 2)) / any_value(total) AS mag
  FROM sizes s JOIN moves USING (episode_index), LATERAL (SELECT unnest(range(CAST(floor(10.0 * m / 30.0) AS BIGINT) + 1)) AS k)
  GROUP BY 1, 2),
edges AS (SELECT episode_index, max(k) AS edge FROM spectrum WHERE mag >= 0.05 GROUP BY 1),
arcs AS (
  SELECT episode_index, -sum(sqrt(pow(1.0 / edge, 2) + pow(step, 2))) AS sal FROM (
    SELECT episode_index, k, mag - lag(mag) OVER (PARTITION BY episode_index ORDER BY k) AS step FROM spectrum)
  JOIN edges USING (episode_index) WHERE k >= 1 AND k <= edge GROUP BY 1),
sal_scores AS (
  SELECT episode_index, coalesce(sal, 0.0) AS sal FROM (SELECT DISTINCT episode_index FROM {source}) LEFT JOIN arcs USING (episode_index)),
cohort AS (
  SELECT frame_index, avg(value) AS m0, stddev_pop(value) AS s0, avg(len) AS m1, stddev_pop(len) AS s1 FROM {source} GROUP BY 1),
ted_scores AS (
  SELECT episode_index, avg(sqrt((CASE WHEN s0 > 0 THEN pow((value - m0) / s0, 2) ELSE 0 END
                                + CASE WHEN s1 > 0 THEN pow((len - m1) / s1, 2) ELSE 0 END) / 2)) AS ted
  FROM {source} JOIN cohort USING (frame_index) GROUP BY 1)"""


JUDGED = FRAMES + """, lengths AS (SELECT episode_index, count(*) AS length FROM frames GROUP BY 1 HAVING count(*) >= 50),
long_enough AS (SELECT f.* FROM frames f JOIN lengths USING (episode_index)),""" + scores("long_enough") + """,
ranked AS (
  SELECT episode_index, length, sal, ted,
         (percent_rank() OVER (ORDER BY -round(sal, 9)) + percent_rank() OVER (ORDER BY round(ted, 9))) / 2 AS badness
  FROM lengths JOIN sal_scores USING (episode_index) JOIN ted_scores USING (episode_index)),
judged AS (
  SELECT *, ted <= {guard} AND badness <= (SELECT quantile_cont(badness, 0.8) FROM ranked) AS kept FROM ranked)"""


# The value of every 997th event is missing: its episode is not scored, its other values count for the cohort.
NAN_JUDGED = (
    JUDGED.format(guard="1.0")
    .replace("HAVING count(*) >= 50)", "HAVING count(*) >= 50 AND count(*) FILTER (event_id % 997 = 0) = 0)", 1)
    .replace("avg(value) AS m0, stddev_pop(value) AS s0", "avg(whole) AS m0, stddev_pop(whole) AS s0", 1)
    .replace(
        "stddev_pop(len) AS s1 FROM long_enough",
        """stddev_pop(len) AS s1 FROM (
    SELECT *, CASE WHEN event_id % 997 <> 0 THEN value END AS whole FROM frames
    WHERE episode_index IN (SELECT episode_index FROM frames GROUP BY 1 HAVING count(*) >= 50))""",
        1,
    )
)

LATE_WINDOWS = FRAMES + """, late AS (
  SELECT f.*, s.start FROM frames f JOIN (SELECT DISTINCT frame_index AS start FROM frames WHERE frame_index % 4 = 0 AND frame_index >= 16) s
    ON f.frame_index >= s.start AND f.frame_index < s.start + 16
  QUALIFY count(*) OVER (PARTITION BY episode_index, s.start) = 16),
late_ids AS (
  SELECT episode_index, start, row_number() OVER (ORDER BY episode_index, start) - 1 AS window_id
  FROM (SELECT DISTINCT episode_index, start FROM late))"""


def _hex_int(text: str, digits: int) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


def _uniform(dim: int) -> str:
    text = f"concat_ws('|', '7', episode_index, frame_index, {dim})"
    return f"round({_hex_int(text, 8)} / 4294967296.0 * 2.0 + -1.0, 6)"


SQL = {
    "windows_per_episode": f"""WITH {WINDOWS}, kept AS (SELECT episode_index FROM frames GROUP BY 1 HAVING count(*) >= 50)
SELECT episode_index, count(*) AS n_windows, max(start) AS last_start FROM full_starts JOIN kept USING (episode_index) GROUP BY 1""",
    "episode_summary": f"""WITH {FRAMES}
SELECT episode_index, count(*) AS length, min(frame_index) AS first_frame, max(frame_index) AS last_frame,
       round(CAST(max(CAST(frame_index / 30.0 AS FLOAT)) AS DOUBLE), 5) AS duration_s FROM frames GROUP BY 1""",
    "filter_min_length": f"""WITH {FRAMES}
SELECT episode_index, frame_index, event_id FROM frames
WHERE episode_index IN (SELECT episode_index FROM frames GROUP BY 1 HAVING count(*) >= 50)""",
    "sliding_windows": f"WITH {WINDOWS} {WINDOW_FACTS} FROM win GROUP BY 1, 2",
    "head_truncate": f"""WITH {FRAMES}, lim AS (
  SELECT least(min(n), 16) AS n FROM (SELECT count(*) AS n FROM frames GROUP BY episode_index)),
win AS (SELECT f.*, CAST(0 AS BIGINT) AS start FROM frames f WHERE frame_index < (SELECT n FROM lim))
{WINDOW_FACTS} FROM win GROUP BY 1, 2""",
    "cap_windows": f"WITH {WINDOWS} {WINDOW_FACTS} FROM win GROUP BY 1, 2 ORDER BY episode_index, start LIMIT 100",
    "window_shapes": f"""WITH {WINDOWS}
SELECT count(*) AS n_windows, min(n) AS min_len, max(n) AS max_len, CAST(2 AS BIGINT) AS min_action_dim, CAST(2 AS BIGINT) AS max_action_dim
FROM (SELECT count(*) AS n FROM win GROUP BY episode_index, start)""",
    "transitions": f"""WITH {FRAMES}
SELECT episode_index, frame_index, len AS s0, round(value, 6) AS s1, round(value, 6) AS a0, len AS a1, nl AS n0, round(nv, 6) AS n1
FROM (SELECT *, lead(value) OVER w AS nv, lead(len) OVER w AS nl FROM frames WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index))
WHERE nv IS NOT NULL""",
    "window_transitions": f"""WITH {WINDOWS}
SELECT episode_index, start, t, len AS s0, round(value, 6) AS s1, round(value, 6) AS a0, len AS a1, nl AS n0, round(nv, 6) AS n1
FROM (SELECT *, lead(value) OVER w AS nv, lead(len) OVER w AS nl FROM win WINDOW w AS (PARTITION BY episode_index, start ORDER BY t))
WHERE nv IS NOT NULL""",
    "transition_mse": f"""WITH {FRAMES}
SELECT round(sum(pow(nv - value, 2) + pow(nl - len, 2)) / (2 * count(*)), 4) AS mse, 2 * count(*) AS n_values
FROM (SELECT *, lead(value) OVER w AS nv, lead(len) OVER w AS nl FROM frames WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index))
WHERE nv IS NOT NULL""",
    "replay_steps": f"""WITH {WINDOWS}
SELECT episode_index, start, t, round(value, 6) AS s0, len AS s1, CAST(0 AS DOUBLE) AS reward, t >= 15 AS terminated, false AS truncated FROM win""",
    "normalize_actions": f"""WITH {FRAMES}, lim AS (SELECT min(value) AS v0, max(value) AS v1, min(len) AS l0, max(len) AS l1 FROM frames)
SELECT episode_index, frame_index, round(CAST(CAST(2 * (value - v0) / (v1 - v0) - 1 AS FLOAT) AS DOUBLE), 5) AS a0,
       round(CAST(CAST(2 * (len - l0) / (l1 - l0) - 1 AS FLOAT) AS DOUBLE), 5) AS a1 FROM frames, lim""",
    "feature_stats": f"""WITH {FRAMES}, long_form AS (
  SELECT 'action' AS feature, 0 AS dim, value AS x FROM frames UNION ALL SELECT 'action', 1, len FROM frames
  UNION ALL SELECT 'state', 0, len FROM frames UNION ALL SELECT 'state', 1, value FROM frames)
SELECT feature, CAST(dim AS BIGINT) AS dim, count(*) AS count, round(min(x), 5) AS min, round(max(x), 5) AS max,
       round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std, count(*) FILTER (NOT isfinite(x)) AS non_finite FROM long_form GROUP BY 1, 2""",
    "feature_stats_nan": f"""WITH {FRAMES}, long_form AS (
  SELECT 'action' AS feature, 0 AS dim, CASE WHEN event_id % 997 <> 0 THEN value END AS x FROM frames UNION ALL SELECT 'action', 1, len FROM frames
  UNION ALL SELECT 'state', 0, len FROM frames UNION ALL SELECT 'state', 1, value FROM frames)
SELECT feature, CAST(dim AS BIGINT) AS dim, count(x) AS count, round(min(x), 5) AS min, round(max(x), 5) AS max,
       round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std, count(*) - count(x) AS non_finite FROM long_form GROUP BY 1, 2""",
    "normalize_actions_nan": f"""WITH {FRAMES}, lim AS (SELECT min(value) AS v0, max(value) AS v1 FROM frames WHERE event_id % 997 <> 0)
SELECT episode_index, frame_index, event_id % 997 = 0 AS broken,
       CASE WHEN event_id % 997 <> 0 THEN round(CAST(CAST(2 * (value - v0) / (v1 - v0) - 1 AS FLOAT) AS DOUBLE), 5) END AS a0 FROM frames, lim""",
    "quality_filter_nan": f"""WITH {NAN_JUDGED}
SELECT episode_index, frame_index, event_id FROM frames WHERE episode_index IN (SELECT episode_index FROM judged WHERE kept)""",
    "cap_windows_filtered": f"WITH {LATE_WINDOWS} {WINDOW_FACTS} FROM late JOIN late_ids USING (episode_index, start) WHERE window_id < 100 GROUP BY 1, 2",
    "number_windows_stride4": f"WITH {LATE_WINDOWS} SELECT window_id, episode_index, start FROM late_ids",
    "recorded_images": """WITH numbered AS (
  SELECT label AS stream_id, vec_id AS seq, embedding, coalesce(sum(CAST(vec_id % 13 = 0 AS INT)) OVER (
    PARTITION BY label ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS episode_index FROM embeddings)
SELECT stream_id, episode_index, row_number() OVER (PARTITION BY stream_id, episode_index ORDER BY seq) - 1 AS frame_index,
       array_to_string(list_transform(embedding, lambda x: printf('%02X', CAST(floor(abs(CAST(x AS DOUBLE)) * 100) AS INT))), '') || '0000' AS pixels
FROM numbered""",
    "rate_audit_dropped": f"""WITH {FRAMES}
SELECT episode_index, count(gap) AS n_gaps, count(*) FILTER (gap > 1000000 / 30.0) AS n_overruns, max(gap) AS max_gap_us
FROM (SELECT episode_index, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY episode_index ORDER BY frame_index)) AS gap FROM frames WHERE event_id % 7 <> 0)
GROUP BY 1""",
    "score_policy_images": """SELECT label AS episode_index, vec_id AS frame_index,
  CAST(list_sum(list_transform(embedding[1:62], lambda x: floor(abs(CAST(x AS DOUBLE)) * 100))) + 1 AS DOUBLE) AS a0,
  CAST(1 AS DOUBLE) AS a1, CAST(64 AS DOUBLE) AS a2 FROM embeddings""",
    "add_timestamp": f"""WITH {FRAMES}
SELECT episode_index, frame_index, round(CAST(CAST(frame_index / 30.0 AS FLOAT) AS DOUBLE), 5) AS timestamp FROM frames""",
    "episode_flags": f"""WITH {FRAMES}
SELECT episode_index, frame_index, frame_index + 1 AS step_count, event_type = 'error' AS terminated,
       event_type = 'purchase' OR frame_index + 1 >= 60 AS truncated,
       event_type = 'error' OR event_type = 'purchase' OR frame_index + 1 >= 60 AS done FROM frames""",
    "assign_episode_ids": f"WITH {STEPS} SELECT stream_id, seq, episode_index, frame_index FROM recorded",
    "align_obs_action": f"""WITH {FRAMES}
SELECT episode_index, frame_index,
       round(coalesce(lag(value) OVER (PARTITION BY episode_index ORDER BY frame_index), -1.0), 6) AS o0,
       round(value, 6) AS a0, len AS a1 FROM frames""",
    "recorded_frames": f"""WITH {STEPS}
SELECT stream_id, episode_index, frame_index, round(CAST(CAST(frame_index / 30.0 AS FLOAT) AS DOUBLE), 5) AS timestamp,
       round(coalesce(lag(value) OVER (PARTITION BY stream_id, episode_index ORDER BY frame_index), -1.0), 3) AS s0, len AS a0
FROM recorded""",
    "rate_audit": f"""WITH {FRAMES}
SELECT episode_index, count(gap) AS n_gaps, count(*) FILTER (gap > 1000000 / 30.0) AS n_overruns, max(gap) AS max_gap_us
FROM (SELECT episode_index, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY episode_index ORDER BY frame_index)) AS gap FROM frames)
GROUP BY 1""",
    "stuck_actions": f"""WITH {FRAMES}, kinds AS (SELECT *, ascii(event_type) AS code FROM frames),
marked AS (
  SELECT *, coalesce(len = lag(len) OVER w AND code = lag(code) OVER w, false) AS same FROM kinds
  WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
islands AS (
  SELECT *, sum(CAST(NOT same AS INT)) OVER (PARTITION BY episode_index ORDER BY frame_index) AS island FROM marked),
counted AS (SELECT *, row_number() OVER (PARTITION BY episode_index, island ORDER BY frame_index) - 1 AS repeat_count FROM islands)
SELECT episode_index, frame_index, repeat_count, len AS a0, CAST(code AS DOUBLE) AS a1 FROM counted WHERE repeat_count = 2""",
    "nan_actions": "SELECT user_id AS episode_index, count(*) FILTER (event_type = 'error') AS nan_frames FROM events GROUP BY 1",
    "relative_target_check": f"""WITH {FRAMES}
SELECT episode_index, frame_index, CAST(CASE WHEN abs(value - len) > 5 THEN 2 ELSE 0 END AS BIGINT) AS n_over,
       round(greatest(len - 5, least(len + 5, value)), 6) AS c0, round(greatest(value - 5, least(value + 5, len)), 6) AS c1 FROM frames""",
    "random_actions": f"WITH {FRAMES} SELECT episode_index, frame_index, {_uniform(0)} AS a0, {_uniform(1)} AS a1 FROM frames",
    "score_policy": f"""WITH {FRAMES}
SELECT episode_index, frame_index, round(0.5 * len + 2.0 * value + 1.0, 4) AS a0, round(-len + value + 1.0, 4) AS a1,
       round(0.25 * len + 1.0, 4) AS a2 FROM frames""",
    "map_rows": f"WITH {FRAMES} SELECT episode_index, frame_index, round(value * 2 + frame_index, 4) AS value FROM frames",
    "sal": f"WITH {FRAMES}, {scores('frames')} SELECT episode_index, round(sal, 5) AS sal FROM sal_scores",
    "ted": f"WITH {FRAMES}, {scores('frames')} SELECT episode_index, round(ted, 5) AS ted FROM ted_scores",
    "episode_quality": f"""WITH {JUDGED.format(guard='1.0')}
SELECT episode_index, length, round(sal, 5) AS sal, round(ted, 5) AS ted, round(badness, 8) AS badness, kept FROM judged""",
    "quality_filter_frames": f"""WITH {JUDGED.format(guard='1.0')}
SELECT episode_index, frame_index, event_id FROM frames WHERE episode_index IN (SELECT episode_index FROM judged WHERE kept)""",
    "quality_filter_report": f"""WITH {JUDGED.format(guard='2.0')}
SELECT count(*) AS kept, (SELECT count(DISTINCT episode_index) FROM frames) - count(*) AS removed FROM judged WHERE kept""",
    "number_windows": f"WITH {WINDOWS} SELECT window_id, episode_index, start FROM win_ids",
    "epoch_batches": f"""WITH {WINDOWS}, hashed AS (
  SELECT epoch, episode_index, start, {_hex_int("concat_ws('|', '42', epoch, episode_index, start)", 15)} AS h
  FROM full_starts, (SELECT unnest([0, 1]) AS epoch)),
placed AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY h, episode_index, start) - 1 AS p FROM hashed)
SELECT epoch, p // 32 AS batch_id, p % 32 AS slot, episode_index, start FROM placed""",
    "batch_payload": f"""WITH {WINDOWS}, hashed AS (
  SELECT epoch, episode_index, start, {_hex_int("concat_ws('|', '42', epoch, episode_index, start)", 15)} AS h
  FROM full_starts, (SELECT unnest([0, 1]) AS epoch)),
placed AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY h, episode_index, start) - 1 AS p FROM hashed),
facts AS ({WINDOW_FACTS} FROM win GROUP BY 1, 2)
SELECT epoch, p // 32 AS batch_id, p % 32 AS slot, episode_index, start, n_steps, first_event, last_event, sum_value
FROM placed JOIN facts USING (episode_index, start)""",
    "stored_order_batches": f"""WITH {WINDOWS}
SELECT epoch, window_id // 32 AS batch_id, window_id % 32 AS slot, episode_index, start
FROM win_ids, (SELECT unnest([0, 1]) AS epoch)""",
    "sample_windows": f"""WITH {WINDOWS}, draws AS (
  SELECT i AS draw, {_hex_int("concat_ws('|', '5', i)", 15)} % (SELECT count(*) FROM win_ids) AS window_id
  FROM (SELECT unnest(range((SELECT count(*) FROM events))) AS i))
SELECT draw, window_id, episode_index, start FROM draws JOIN win_ids USING (window_id)""",
}
