"""The same results in plain SQL over the given tables, for checking by value.

Written relationally (one row per cell, self-joins, windows, recursion) and without
any of the library's code, so that agreement means something.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

P = 2147483647


def r(x: str, places: int = 6) -> str:
    """Rounded, without negative zero."""
    return f"(round(CAST({x} AS DOUBLE), {places}) + CAST(0 AS DOUBLE))"


def u(id_: str, draw: str | int, seed: str | int) -> str:
    """Hashed uniform in [0, 1)."""
    x1 = f"((({id_}) * 48271 + ({draw}) * 69621 + ({seed}) * 16807 + 12345) % {P})"
    x2 = f"(({x1} * {x1} + ({draw}) * 7919 + 1) % {P})"
    x3 = f"(({x2} * 48271 + {x1}) % {P})"
    return f"((({x3} * {x3} + {x3} + ({draw})) % {P}) / CAST({P} AS DOUBLE))"


def hashed(id_: str, draw: str | int, seed: str | int) -> str:
    return f"CAST(round({u(id_, draw, seed)} * {P}) AS BIGINT)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


# --- shared inputs -----------------------------------------------------------------


def scores(band: str = "CAST(0 AS BIGINT)") -> str:
    return f"""scores AS (
  SELECT {band} AS band, event_id % 6 AS obs, event_id // 6 AS start_index, value / 100 AS p FROM events)"""


SCORES, BAND_SCORES = scores(), scores("user_id % 4")

GROUPS = """groups AS (
  SELECT band, start_index,
    CAST(sum(CASE WHEN obs % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_hits,
    CAST(sum(CASE WHEN obs % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS off_hits,
    avg(p) AS confidence,
    '[' || string_agg(CAST(obs AS VARCHAR), ', ' ORDER BY obs) || ']' AS pattern
  FROM scores WHERE p > 0.5 GROUP BY band, start_index)"""


def detections(scores_cte: str, channel: str = "2.7939677238464355 * 4") -> str:
    return with_(scores_cte, GROUPS, f"""found AS (
  SELECT band,
    ((1100 + band * 50) * 1e6 + start_index * CAST({channel} AS DOUBLE)) / 1e6 AS frequency_MHz,
    confidence,
    CASE WHEN on_hits >= 2 AND off_hits = 0 THEN 'ETI_candidate' ELSE 'RFI_likely' END AS classification,
    pattern AS observation_pattern, start_index AS frequency_index
  FROM groups WHERE (on_hits >= 2 AND off_hits = 0) OR (on_hits > 0 AND off_hits > 0))""")


REPORT = f"""{r('frequency_MHz')} AS frequency_MHz, {r('confidence')} AS confidence, classification,
  observation_pattern, frequency_index"""

CELLS = """cells AS (
  SELECT vec_id // 6 AS cadence_id, vec_id % 6 AS obs,
    'file_' || ((vec_id // 6) % 3) AS source_file, vec_id // 6 // 3 AS row_idx, i - 1 AS i,
    CASE WHEN (vec_id // 6) % 10 = 7 AND vec_id % 6 = 2 THEN CAST('NaN' AS DOUBLE)
         WHEN (vec_id // 6) % 11 = 3 AND vec_id % 6 = 4 THEN CAST('Infinity' AS DOUBLE)
         WHEN (vec_id // 6) % 13 = 5 THEN CAST(0 AS DOUBLE)
         ELSE abs(CAST(x AS DOUBLE)) END AS v
  FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings))"""

VALID = """valid AS (
  SELECT cadence_id, min(source_file) AS source_file, min(row_idx) AS row_idx FROM cells GROUP BY cadence_id
  HAVING count(DISTINCT obs) = 6 AND NOT bool_or(isnan(v)) AND NOT bool_or(isinf(v)) AND max(v) > 0)"""

GOOD = "good AS (SELECT c.* FROM cells c WHERE cadence_id IN (SELECT cadence_id FROM valid))"

NORMED = """normed AS (
  SELECT cadence_id, obs, i, CASE WHEN hi > lo THEN (l - lo) / (hi - lo) ELSE 0 END AS v FROM (
    SELECT cadence_id, obs, i, ln(v + 1e-10) AS l,
      min(ln(v + 1e-10)) OVER (PARTITION BY cadence_id, obs) AS lo,
      max(ln(v + 1e-10)) OVER (PARTITION BY cadence_id, obs) AS hi FROM good))"""

DIGEST = f"""count(*) AS n_cells, {r('min(v)')} AS lo, {r('max(v)')} AS hi, {r('sum(v)')} AS total,
  {r('sum(i * v)')} AS weighted"""

LATENTS = """z AS (
  SELECT vec_id // 6 AS cadence_id, vec_id % 6 AS obs, label, d,
    CAST(embedding[d + 1] AS DOUBLE) AS m, CAST(embedding[64 - d] AS DOUBLE) AS lv,
    CAST(embedding[(d + 32) % 64 + 1] AS DOUBLE) AS e
  FROM embeddings, (SELECT CAST(range AS BIGINT) AS d FROM range(64)))""", """whole AS (
  SELECT cadence_id, max(CASE WHEN obs = 0 THEN label END) < 5 AS is_true FROM z
  GROUP BY cadence_id HAVING count(DISTINCT obs) = 6)""", """pairs AS (
  SELECT a.cadence_id, a.obs AS obs_a, b.obs AS obs_b, any_value(w.is_true) AS is_true,
    sum((a.m - b.m) * (a.m - b.m)) AS distance
  FROM z a JOIN z b ON a.cadence_id = b.cadence_id AND a.d = b.d AND a.obs < b.obs
    JOIN whole w ON w.cadence_id = a.cadence_id
  GROUP BY a.cadence_id, a.obs, b.obs)"""

TELEMETRY = """telemetry AS (
  SELECT event_id AS id, ts, epoch_us(ts) / 1e6 AS ts_unix,
    CASE WHEN event_type = 'view' THEN 'gpu' ELSE event_type END AS resource_type,
    CASE WHEN event_type = 'view'
      THEN 'DEV_A:' || (user_id % 2) || '_' || CASE WHEN event_id % 2 = 0 THEN 'utilization' ELSE 'memory' END
      ELSE 'user_' || (user_id % 5) END AS resource_name,
    value, 'percent' AS unit, 'run_' || (user_id % 3) AS tag, props AS metadata
  FROM events)"""

ARTIFACTS = """artifacts AS (
  SELECT 'family_' || user_id AS family,
    CASE WHEN event_type IN ('view', 'click') THEN 'encoder'
         WHEN event_type IN ('error', 'signup') THEN 'decoder' END AS kind,
    CASE k // 10
      WHEN 0 THEN 'final_v' || (k % 10) WHEN 1 THEN 'round_0' || (k % 10) WHEN 2 THEN 'round_1' || (k % 10)
      WHEN 3 THEN '2024010' || (k % 10) || '_120000' WHEN 4 THEN '2024990' || (k % 10) || '_120000'
      WHEN 5 THEN 'test_v' || (k % 10) WHEN 6 THEN 'test_x' || (k % 10)
      WHEN 7 THEN 'final_x' || (k % 10) WHEN 8 THEN 'round_x' || (k % 10)
      ELSE 'misc' || (k % 10) END AS tag
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
  WHERE event_type <> 'purchase')"""

TAG_PAIRS = """tag_pairs AS (
  SELECT DISTINCT e.family, e.tag FROM artifacts e JOIN artifacts d ON e.family = d.family AND e.tag = d.tag
  WHERE e.kind = 'encoder' AND d.kind = 'decoder')"""


def ranked(source: str, carry: str) -> str:
    return f"""versions AS (
  SELECT {carry}, tag,
    CASE WHEN starts_with(tag, 'final_') THEN 0 WHEN starts_with(tag, 'round_') THEN 2
         WHEN regexp_matches(tag, '^[0-9]{{8}}_[0-9]{{6}}') THEN 4
         WHEN starts_with(tag, 'test_') THEN 6 ELSE 99 END AS family_rank,
    CASE WHEN starts_with(tag, 'final_') OR starts_with(tag, 'test_') THEN TRY_CAST(split_part(tag, '_v', 2) AS BIGINT)
         WHEN starts_with(tag, 'round_') THEN TRY_CAST(split_part(tag, '_', 2) AS BIGINT)
         WHEN regexp_matches(tag, '^[0-9]{{8}}_[0-9]{{6}}')
           THEN CAST(epoch(try_strptime(tag, '%Y%m%d_%H%M%S')) AS BIGINT) END AS version
  FROM {source}),
ranked AS (
  SELECT {carry}, tag, version,
    CAST(CASE WHEN family_rank = 99 OR version IS NOT NULL THEN family_rank ELSE family_rank + 1 END AS BIGINT) AS rank
  FROM versions)"""


# --- scans, sources, sinks -----------------------------------------------------------

ORACLES["scan_observations"] = with_(CELLS, """flagged AS (
  SELECT *, bool_or(isnan(v) OR isinf(v)) OVER (PARTITION BY cadence_id, obs) AS bad FROM cells)""") + f"""
SELECT source_file, count(*) // 64 AS observations, count(*) AS cells,
  count(*) FILTER (WHERE bad) // 64 AS bad_observations, {r('sum(v) FILTER (WHERE NOT bad)')} AS total
FROM flagged GROUP BY source_file"""

ORACLES["scan_npy"] = f"""
SELECT printf('part_%05d.npy', vec_id // 120) AS source_file, vec_id % 120 AS row_idx, '[4, 16]' AS shape,
  'float32' AS dtype, {DIGEST}
FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
GROUP BY vec_id"""

ORACLES["scan_missing_ok"] = """
SELECT CAST(label AS BIGINT) AS label, count(*) AS vectors FROM embeddings GROUP BY label"""

_OBS = """o AS (
  SELECT 'file_' || ((vec_id // 6) % 3) AS source_file, vec_id // 6 // 3 AS row_idx, vec_id // 6 AS cadence_id,
    vec_id % 6 AS obs FROM embeddings)"""

ORACLES["scan_row_subset"] = with_(_OBS) + """
SELECT * FROM o WHERE (source_file = 'file_0' AND row_idx >= 5 AND row_idx < 20)
  OR (source_file = 'file_1' AND row_idx < 15) OR (source_file = 'file_2' AND row_idx >= 10)"""

ORACLES["scan_file_cap"] = with_(_OBS, """sub AS (
  SELECT * FROM o WHERE (source_file = 'file_0' AND row_idx >= 5 AND row_idx < 20)
    OR (source_file = 'file_1' AND row_idx < 15) OR (source_file = 'file_2' AND row_idx >= 10))""") + """
SELECT source_file, row_idx, cadence_id, obs FROM (
  SELECT *, dense_rank() OVER (PARTITION BY source_file ORDER BY row_idx) AS n FROM sub) WHERE n <= (SELECT count(DISTINCT cadence_id) // 7 FROM o)"""

ORACLES["complete_cadences"] = """
SELECT printf('/cadences/cadence_%04d_obs_%d.npy', vec_id // 6, vec_id % 6) AS path,
  vec_id // 6 AS cadence_id, vec_id % 6 AS obs
FROM embeddings WHERE vec_id // 6 IN (SELECT vec_id // 6 FROM embeddings GROUP BY 1 HAVING count(DISTINCT vec_id % 6) = 6)"""

ORACLES["detections_csv_roundtrip"] = detections(BAND_SCORES) + f" SELECT {REPORT} FROM found"
ORACLES["high_confidence"] = detections(SCORES) + f" SELECT band, {REPORT} FROM found WHERE confidence > 0.9"

ORACLES["high_confidence_sink"] = detections(SCORES) + f" SELECT {REPORT} FROM found WHERE confidence > 0.9"

ORACLES["telemetry_route"] = ORACLES["stream_route"] = f"""
WITH q AS (
  SELECT CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) >= 95 THEN '_rejects'
      WHEN event_type = 'click' THEN 'background_stats' WHEN event_type = 'signup' THEN 'injection_stats'
      WHEN event_type = 'purchase' THEN 'training_losses' ELSE 'system_resources' END AS "table",
    epoch_us(ts) / 1e6 AS t, value FROM events)
SELECT "table", count(*) AS rows, {r('sum(value)')} AS total, {r('min(t)')} AS first_ts, {r('max(t)')} AS last_ts,
  count(*) FILTER (WHERE "table" IN ('system_resources', '_rejects')) AS resource_names,
  count(*) FILTER (WHERE "table" IN ('training_losses', '_rejects')) AS epoch_numbers,
  count(*) FILTER (WHERE "table" IN ('background_stats', '_rejects')) AS filenames,
  count(*) FILTER (WHERE "table" IN ('injection_stats', 'training_losses', '_rejects')) AS round_numbers
FROM q GROUP BY "table\""""

# --- projections and filters ---------------------------------------------------------

ORACLES["valid_cadences"] = with_(CELLS, VALID, GOOD) + f"""
SELECT cadence_id, obs, {DIGEST} FROM good GROUP BY cadence_id, obs"""

ORACLES["guard_backgrounds"] = with_(CELLS) + """
SELECT count(*) AS rows, count(*) FILTER (WHERE n) AS nan_rows, count(*) FILTER (WHERE f) AS inf_rows,
  count(*) FILTER (WHERE c <> 64) AS wrong_width_rows
FROM (SELECT bool_or(isnan(v)) AS n, bool_or(isinf(v)) AS f, count(*) AS c FROM cells GROUP BY cadence_id, obs)"""

ORACLES["telemetry_range"] = with_(TELEMETRY) + f"""
SELECT id, {r('ts_unix')} AS ts_unix, resource_type, resource_name, value, tag FROM telemetry
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-19 23:59:59.999999'"""

ORACLES["telemetry_range_stored"] = ORACLES["telemetry_range"]

ORACLES["store_size"] = f"""
SELECT CAST(sum(strlen(props) + 1) AS BIGINT) AS size_bytes, {r('sum(strlen(props) + 1) / 1048576.0')} AS size_mb FROM events"""

ORACLES["threshold_predict"] = with_(SCORES) + """
SELECT start_index, obs, CAST(p > 0.5 AS BIGINT) AS prediction FROM scores"""

ORACLES["predict_confidence"] = with_(SCORES) + f"""
SELECT start_index, obs, CAST(p > 0.5 AS BIGINT) AS prediction,
  {r('CASE WHEN p > 0.5 THEN least(p, 1) ELSE 1 - p END')} AS confidence FROM scores"""

ORACLES["detection_frequency"] = detections(BAND_SCORES) + f"""
SELECT band, frequency_index, {r('frequency_MHz')} AS frequency_MHz FROM found"""

_KINDS = {"loss": "view", "reconstruction_loss": "click", "kl_loss": "signup", "true_loss": "purchase", "false_loss": "error"}
ORACLES["history_long"] = "\nUNION ALL ".join(
    f"SELECT event_id // 40 AS epoch, '{prefix}{name}' AS series, "
    + r(f"{fn}(value) FILTER (WHERE event_type = '{kind}')")
    + " AS value FROM events GROUP BY 1"
    for prefix, fn in (("", "avg"), ("val_", "max"))
    for name, kind in _KINDS.items()
) + f"""
UNION ALL SELECT event_id // 40 AS epoch, 'learning_rate' AS series, {r('min(value) / 1000')} AS value FROM events GROUP BY 1"""

ORACLES["utilisation_pct"] = f"""
SELECT event_id AS id, {r('CASE WHEN event_id % 3 > 0 THEN value / ((event_id % 3) * 500) * 100 ELSE 0 END')} AS percent
FROM events"""

# --- joins ---------------------------------------------------------------------------

ORACLES["score_join"] = f"""
SELECT CAST(0 AS BIGINT) AS band, event_id % 6 AS obs, event_id // 6 AS start_index, {r('o_totalprice')} AS p
FROM events JOIN orders ON event_id = o_orderkey"""

ORACLES["artifact_pairs"] = with_(ARTIFACTS, TAG_PAIRS) + " SELECT family, tag FROM tag_pairs"

ORACLES["latent_pairs"] = with_(*LATENTS) + f"""
SELECT cadence_id, obs_a, obs_b, CASE WHEN (obs_a + obs_b) % 2 = 0 THEN 'same' ELSE 'cross' END AS kind,
  CAST(CASE WHEN (obs_a + obs_b) % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS weight, {r('distance')} AS distance
FROM pairs"""

# --- aggregations --------------------------------------------------------------------

ORACLES["downsample_mean"] = with_(CELLS, VALID, GOOD) + f"""
SELECT cadence_id, obs, i // 16 AS t, (i % 16) // 4 AS f, {r('avg(v)')} AS v FROM good GROUP BY 1, 2, 3, 4"""

ORACLES["background_summary"] = with_(CELLS, VALID, GOOD, """means AS (
  SELECT cadence_id, obs, i // 4 AS b, avg(v) AS v FROM good GROUP BY 1, 2, 3)""") + f"""
SELECT count(DISTINCT cadence_id) AS cadences, {r('min(v)')} AS min_value, {r('max(v)')} AS max_value,
  {r('avg(v)')} AS mean_value FROM means"""

ORACLES["cadence_pattern"] = with_(SCORES, GROUPS) + f"""
SELECT band, start_index, on_hits, off_hits, {r('confidence')} AS confidence, pattern FROM groups"""

ORACLES["detections"] = detections(SCORES) + f" SELECT band, {REPORT} FROM found"
ORACLES["detection_counts"] = detections(SCORES) + """
SELECT classification, count(*) AS detections FROM found GROUP BY classification"""

ORACLES["pair_distance"] = with_(*LATENTS) + f"""
SELECT obs_a, obs_b, {r('avg(distance)')} AS mean_distance FROM pairs GROUP BY obs_a, obs_b"""
ORACLES["pair_inverse_distance"] = with_(*LATENTS) + f"""
SELECT obs_a, obs_b, {r('avg(1 / (distance + 1e-8))')} AS mean_inverse_distance FROM pairs GROUP BY obs_a, obs_b"""


def _separation(cross: str) -> str:
    return f"""
SELECT is_true, sum(CASE WHEN (obs_a + obs_b) % 2 = 0 THEN 2 * d ELSE {cross} END) AS separation FROM (
  SELECT is_true, obs_a, obs_b, avg(distance) AS d, avg(1 / (distance + 1e-8)) AS inv
  FROM pairs GROUP BY is_true, obs_a, obs_b) GROUP BY is_true"""


ORACLES["separation_true"] = with_(*LATENTS) + f" SELECT is_true, {r('separation')} AS separation FROM ({_separation('inv')})"
ORACLES["separation_false"] = with_(*LATENTS) + f" SELECT is_true, {r('separation')} AS separation FROM ({_separation('d')})"

_KL = "SELECT avg(k) AS kl FROM (SELECT cadence_id, obs, sum(-0.5 * (1 + lv - m * m - exp(lv))) AS k FROM z GROUP BY 1, 2)"
ORACLES["kl_divergence"] = with_(LATENTS[0]) + f" SELECT {r('kl')} AS kl FROM ({_KL})"

_BCE = """SELECT avg(e) AS reconstruction FROM (
  SELECT cadence_id, sum(row_mean) AS e FROM (
    SELECT cadence_id, obs, i // 16 AS t, avg(-(v * ln(p) + (1 - v) * ln(1 - p))) AS row_mean FROM (
      SELECT *, greatest(1e-7, least(1 - 1e-7, 0.1 + 0.8 * v)) AS p FROM normed)
    GROUP BY 1, 2, 3) GROUP BY cadence_id)"""
ORACLES["reconstruction_bce"] = with_(CELLS, VALID, GOOD, NORMED) + f"""
SELECT {r('reconstruction')} AS reconstruction FROM ({_BCE})"""

ORACLES["total_loss"] = with_(CELLS, VALID, GOOD, NORMED, *LATENTS, f"""parts AS (
  SELECT ({_BCE}) AS reconstruction, ({_KL}) AS kl,
    (SELECT separation FROM ({_separation('inv')}) WHERE is_true) AS true_loss,
    (SELECT separation FROM ({_separation('d')}) WHERE NOT is_true) AS false_loss)""") + f"""
SELECT {r('reconstruction')} AS reconstruction, {r('kl')} AS kl, {r('true_loss')} AS true_loss,
  {r('false_loss')} AS false_loss, {r('reconstruction + 1.5 * kl + 10 * (true_loss + false_loss)')} AS total FROM parts"""

ORACLES["epoch_losses"] = f"""
SELECT epoch, count(*) AS steps, {r('avg(l)', 9)} AS loss FROM (
  SELECT event_id // 40 AS epoch, user_id % 10 AS step, avg(value) AS l FROM events GROUP BY 1, 2) GROUP BY epoch"""

ORACLES["eval_metrics"] = f"""
SELECT {r('avg(CASE WHEN quality = 1 THEN toxic END)')} AS tpr, {r('avg(CASE WHEN quality = 0 THEN toxic END)')} AS fpr,
  {r('avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END)')} AS accuracy FROM labels"""

ORACLES["table_stats"] = f"""
SELECT (SELECT count(*) FROM events) AS system_resources_row_count,
  (SELECT count(*) FROM documents) AS background_stats_row_count,
  (SELECT count(*) FROM labels) AS injection_stats_row_count,
  (SELECT count(*) FROM events) AS training_losses_row_count,
  (SELECT {r('min(epoch_us(ts)) / 1e6')} FROM events) AS min_timestamp,
  (SELECT {r('max(epoch_us(ts)) / 1e6')} FROM events) AS max_timestamp"""

_PROFILE = ("""cells AS (
  SELECT lang AS file, CAST(coalesce(length(text), 0) AS DOUBLE) AS a, CAST(coalesce(strlen(text), 0) AS DOUBLE) AS b,
    CAST(n_chars AS DOUBLE) AS c, CAST(doc_id AS DOUBLE) AS d FROM documents)""", """profiles AS (
  SELECT file, count(*) AS n_rows, CASE WHEN file = 'fr' THEN '[6, 16, 512]' ELSE '[6, 16, 4096]' END AS shape,
    CASE WHEN file = 'es' THEN 'float64' ELSE 'float32' END AS dtype, count(*) AS sampled_rows,
    min(least(a, b, c, d)) AS sample_min, max(greatest(a, b, c, d)) AS sample_max, avg((a + b + c + d) / 4) AS sample_mean,
    CAST(count(*) * 96 * CASE WHEN file = 'fr' THEN 512 ELSE 4096 END * CASE WHEN file = 'es' THEN 8 ELSE 4 END
      AS BIGINT) AS expected_bytes
  FROM cells GROUP BY file)""")
ORACLES["file_profile"] = with_(*_PROFILE) + f"""
SELECT file, n_rows, shape, dtype, sampled_rows, {r('sample_min')} AS sample_min, {r('sample_max')} AS sample_max,
  {r('sample_mean')} AS sample_mean, expected_bytes FROM profiles"""
ORACLES["profile_consistency"] = with_(*_PROFILE) + """
SELECT count(*) AS files, count(DISTINCT shape) AS shapes, count(DISTINCT dtype) AS dtypes,
  CAST(sum(n_rows) AS BIGINT) AS total_rows, CAST(sum(expected_bytes) AS BIGINT) AS total_bytes FROM profiles"""

ORACLES["weight_drift"] = f"""
WITH w AS (
  SELECT label, stddev_pop(CAST(x AS DOUBLE)) AS actual FROM (SELECT label, unnest(embedding) AS x FROM embeddings) GROUP BY label),
e AS (SELECT label, actual, sqrt(CAST(2 AS DOUBLE) / CASE WHEN label % 2 = 0 THEN 100 + 10 * label ELSE 100 + 20 * label END) AS expected FROM w)
SELECT 'layer_' || label AS layer, {r('actual')} AS actual_std, {r('expected')} AS expected_std,
  {r('abs(actual - expected) / expected')} AS relative_deviation, abs(actual - expected) / expected > 0.1 AS drifted FROM e"""

ORACLES["process_rollup"] = f"""
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS tick, {r('sum(value) / 8')} AS cpu_percent,
  {r('sum(value * 1e6) / 64e9 * 100', 10)} AS ram_percent, {r('sum(value * 1e6)', 3)} AS ram_bytes,
  {r('sum(value * 1e6) / 1e9')} AS ram_gb FROM events GROUP BY 1"""

# --- ordered operators ---------------------------------------------------------------

ORACLES["log_norm"] = with_(CELLS, VALID, GOOD, NORMED) + f"""
SELECT cadence_id, obs, i // 16 AS t, i % 16 AS f, {r('v')} AS v FROM normed"""


def snippets(size: int, step: int) -> str:
    return f"""snippets AS (
  SELECT cadence_id, obs, s AS start_index, (i // 16) * {size} + (i % 16) - s AS i, v
  FROM good, (SELECT CAST(range AS BIGINT) AS s FROM range(0, 16 - {size} + 1, {step}))
  WHERE i % 16 >= s AND i % 16 < s + {size})"""


ORACLES["overlap_snippets"] = with_(CELLS, VALID, GOOD, snippets(6, 3)) + f"""
SELECT cadence_id, obs, start_index, i AS cell, {r('v')} AS v FROM snippets"""
ORACLES["cadence_snippets"] = with_(CELLS, VALID, GOOD, snippets(8, 4)) + f"""
SELECT cadence_id, obs, start_index, {DIGEST} FROM snippets GROUP BY cadence_id, obs, start_index"""

_EVENT_INDEX = "e AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events)"
ORACLES["split_trim"] = with_(_EVENT_INDEX, "s AS (SELECT count(*) AS n, CAST(floor(count(*) * 0.8) AS BIGINT) AS t FROM events)") + """
SELECT event_id, idx, CASE WHEN idx < t THEN 'train' ELSE 'val' END AS part FROM e, s
WHERE idx < t // 128 * 128 OR (idx >= t AND idx < t + (n - t) // 96 * 96)"""
ORACLES["batch_assign"] = with_(_EVENT_INDEX) + """
SELECT event_id, idx, idx // 2048 AS step, (idx % 2048) // 128 AS micro_step FROM e"""

ORACLES["epoch_shuffle"] = f"""
SELECT event_id, row_number() OVER (ORDER BY {hashed('event_id', 3, 11)}, {hashed('event_id', 3, 12)}, event_id) - 1 AS shuffle_pos FROM events"""

_PROGRESS = "((event_id % 20) / CAST(19 AS DOUBLE))"
ORACLES["difficulty_schedule"] = f"""
SELECT event_id AS sample_idx, event_id % 20 AS round_idx, CAST(10 AS BIGINT) AS snr_base,
  CAST(trunc(40 - {_PROGRESS} * 30) AS BIGINT) AS linear_range,
  CAST(trunc(10 + 30 * ((exp(-3 * {_PROGRESS}) - exp(-3)) / (1 - exp(-3)))) AS BIGINT) AS exponential_range,
  CAST(CASE WHEN event_id % 20 < 5 THEN 40 ELSE 10 END AS BIGINT) AS step_range FROM events"""

ORACLES["lr_plateau"] = ORACLES["stream_plateau"] = f"""
WITH RECURSIVE l AS (
  SELECT event_id // 50 AS round, event_id % 50 AS epoch, value,
    row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) AS n FROM events),
s AS (
  SELECT DISTINCT round, CAST(0 AS BIGINT) AS n, CAST('Infinity' AS DOUBLE) AS best, CAST(0 AS BIGINT) AS misses,
    CAST(0.001 AS DOUBLE) AS lr, CAST(NULL AS BIGINT) AS epoch, CAST(NULL AS DOUBLE) AS val_loss FROM l
  UNION ALL
  SELECT round, n,
    CASE WHEN NOT frozen AND better THEN value ELSE best END,
    CASE WHEN frozen THEN misses WHEN better THEN 0 WHEN misses + 1 >= 3 THEN 0 ELSE misses + 1 END,
    CASE WHEN NOT frozen AND NOT better AND misses + 1 >= 3
      THEN greatest(lr * CAST(0.8 AS DOUBLE), CAST(0.000001 AS DOUBLE)) ELSE lr END,
    epoch, value
  FROM (SELECT l.round, l.n, l.epoch, l.value, s.best, s.misses, s.lr, s.lr <= 0.000001 AS frozen,
      l.value < s.best * CAST(0.999 AS DOUBLE) AS better
    FROM s JOIN l ON l.round = s.round AND l.n = s.n + 1))
SELECT 'run' AS tag, round, epoch, val_loss, misses, {r('lr', 12)} AS lr FROM s WHERE n > 0"""

ORACLES["latest_tag"] = with_(ARTIFACTS, TAG_PAIRS, ranked("tag_pairs", "family")) + """
SELECT family, tag, rank, coalesce(version, -1) AS version FROM (
  SELECT *, row_number() OVER (PARTITION BY family ORDER BY rank, coalesce(version, 0) DESC, tag DESC) AS n
  FROM ranked WHERE rank < 99) WHERE n = 1"""

ORACLES["telemetry_series"] = with_(TELEMETRY) + """
SELECT resource_type || '_' || resource_name AS series, (ts_unix - CAST(1704067200 AS DOUBLE)) / 60 AS minutes, value, id
FROM telemetry"""

ORACLES["device_metric_pivot"] = f"""
SELECT 'DEV_A:' || (user_id % 2) AS device,
  CAST(floor((epoch_us(ts) / 1e6 - 1704067200) / 60 / 360) * 360 AS BIGINT) AS minutes,
  {r('avg(value) FILTER (WHERE event_id % 2 = 0)', 10)} AS utilization,
  {r('avg(value) FILTER (WHERE event_id % 2 = 1)', 10)} AS memory
FROM events WHERE event_type = 'view' GROUP BY 1, 2"""

# --- sorts, limits, set operations ---------------------------------------------------

ORACLES["detections_ranked"] = ORACLES["combine_bands"] = (
    detections(BAND_SCORES) + f" SELECT band, {REPORT} FROM found ORDER BY confidence DESC"
)

ORACLES["target_limit"] = with_(CELLS, VALID, _OBS) + """
SELECT cadence_id, obs, source_file, row_idx FROM o
WHERE cadence_id IN (SELECT cadence_id FROM valid ORDER BY source_file, row_idx LIMIT (SELECT count(DISTINCT cadence_id) // 2 FROM o))"""

ORACLES["labelled_union"] = with_(*LATENTS[:2]) + f"""
SELECT cadence_id, CASE WHEN is_true THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, {r('sum(m)')} AS total
FROM z JOIN whole USING (cadence_id) GROUP BY cadence_id, is_true"""

ORACLES["merge_stores"] = with_(TELEMETRY) + f"""
SELECT {r('ts_unix')} AS ts_unix, resource_type, resource_name, tag, 'host' AS host, min(value) AS value,
  min(unit) AS unit, arg_min(metadata, value) AS metadata
FROM telemetry GROUP BY ts_unix, resource_type, resource_name, tag"""

# --- training-set generation ---------------------------------------------------------

PLAN = """plan AS (
  SELECT split_set, vec_id AS sample_idx, vec_id // 1000 AS chunk,
    CASE split_set WHEN 'concatenated' THEN 21 WHEN 'true' THEN 22 ELSE 23 END AS seed,
    CASE WHEN split_set = 'concatenated' THEN
        CASE (vec_id % 1000) // (size // 4) WHEN 0 THEN 'false_no_signal' WHEN 1 THEN 'false_with_rfi'
          WHEN 2 THEN 'true_single' ELSE 'true_double' END
      WHEN split_set = 'false' THEN
        CASE (vec_id % 1000) // (size // 2) WHEN 0 THEN 'false_no_signal' ELSE 'false_with_rfi' END
      ELSE CASE (vec_id % 1000) // (size // 2) WHEN 0 THEN 'true_single' ELSE 'true_double' END END AS class
  FROM (SELECT vec_id, least(1000, (SELECT count(*) FROM embeddings) - vec_id // 1000 * 1000) AS size FROM embeddings),
    (VALUES ('concatenated'), ('true'), ('false')) AS sets(split_set))"""

ORACLES["class_plan"] = with_(PLAN) + " SELECT split_set, sample_idx, chunk, class FROM plan"
ORACLES["class_mix"] = with_(PLAN) + """
SELECT split_set, chunk, class, count(*) AS samples FROM plan GROUP BY split_set, chunk, class"""


def plan_of(*classes: str) -> str:
    values = ", ".join(f"('{c}')" for c in classes)
    return f"""plan AS (
  SELECT 'concatenated' AS split_set, vec_id AS sample_idx, 21 AS seed, class
  FROM embeddings, (VALUES {values}) AS kinds(class))"""


DT_DF = "(CAST(18.25361108 AS DOUBLE) / CAST(2.7939677238464355 AS DOUBLE))"


def track(j: int, draw: str, id_: str = "sample_idx", seed: str = "seed") -> list[str]:
    """Three column lists, each built on the one before."""
    at = lambda k: u(id_, f"{draw} + {k}", seed)
    return [
        f"CAST(floor({at(0)} * 15) + 1 AS BIGINT) AS start{j}, CASE WHEN {at(1)} < 0.5 THEN -1 ELSE 1 END AS dir{j}, "
        f"{at(2)} * 3 AS noise{j}, {at(3)} * 50 AS base{j}",
        f"CAST(24 AS DOUBLE) / CASE WHEN dir{j} > 0 THEN start{j} ELSE start{j} - 16 END AS slope{j}",
        f"-1 / (slope{j} * {DT_DF} + dir{j} * noise{j}) AS drift{j}, 24 - slope{j} * start{j} AS icept{j}",
    ]


def tracks(source: str, candidates: int) -> str:
    """First pair without a crossing on target per double sample, one track for the others."""
    one, two = track(1, "10 + k * 10"), track(2, "15 + k * 10")
    return f"""cand0 AS (
  SELECT p.*, k, {one[0]}, {two[0]} FROM {source} p, (SELECT CAST(range AS BIGINT) AS k FROM range({candidates}))
  WHERE class = 'true_double' OR k = 0),
cand1 AS (SELECT *, {one[1]}, {two[1]} FROM cand0),
cand2 AS (SELECT *, {one[2]}, {two[2]} FROM cand1),
cand3 AS (
  SELECT *, base1 + abs(drift1) * 18 AS width1, base2 + abs(drift2) * 18 AS width2,
    CASE WHEN slope1 <> slope2 THEN 24 - (slope1 * ((icept2 - icept1) / (slope1 - slope2)) + icept1) END AS cross_row
  FROM cand2),
tracks AS (
  SELECT * FROM cand3 WHERE class <> 'true_double' OR (cross_row IS NOT NULL
    AND NOT (cross_row BETWEEN 0 AND 4) AND NOT (cross_row BETWEEN 8 AND 12) AND NOT (cross_row BETWEEN 16 AND 20))
  QUALIFY row_number() OVER (PARTITION BY split_set, class, sample_idx ORDER BY k) = 1)"""


_EVENT_PLAN = """plan AS (
  SELECT 'concatenated' AS split_set, event_id AS sample_idx, {seed} AS seed, '{kind}' AS class FROM events)"""

ORACLES["track_nonintersect"] = with_(_EVENT_PLAN.format(seed=7, kind="true_double"), tracks("plan", 64)) + f"""
SELECT sample_idx, k AS draw_no, start1 AS rfi_start, start2 AS eti_start, {r('slope1')} AS rfi_slope,
  {r('slope2')} AS eti_slope FROM tracks"""

ORACLES["injection_params"] = with_(_EVENT_PLAN.format(seed=21, kind="true_single"), tracks("plan", 1)) + f"""
SELECT sample_idx, {r(u('sample_idx', 0, 'seed'))} AS background_u, {r(u('sample_idx', 1, 'seed') + ' * 40 + 10')} AS snr,
  start1 AS start_bin, CAST(dir1 AS BIGINT) AS direction, {r('slope1')} AS slope_pixel, {r('drift1')} AS drift_hz_s,
  {r('width1')} AS width_hz, {r('icept1')} AS intercept FROM tracks"""

BACKGROUNDS = """bg AS (
  SELECT cadence_id, row_number() OVER (ORDER BY source_file, row_idx) - 1 AS background_idx FROM valid)"""

PICKED = f"""picked AS (
  SELECT p.*, b.background_idx, b.cadence_id FROM (
    SELECT *, {u('sample_idx', 1, 'seed')} * 40 + 10 AS snr,
      CAST(floor((SELECT count(*) FROM bg) * {u('sample_idx', 0, 'seed')}) AS BIGINT) AS pick FROM tracks) p
  JOIN bg b ON b.background_idx = p.pick)"""

ORACLES["sample_backgrounds"] = with_(CELLS, VALID, BACKGROUNDS, plan_of("false_no_signal"), tracks("plan", 1), PICKED) + """
SELECT sample_idx, background_idx, cadence_id FROM picked"""


def profile(j: int, stacked: str = "i") -> str:
    sigma = f"(width{j} / (2 * sqrt(2 * ln(CAST(2 AS DOUBLE))) * CAST(2.7939677238464355 AS DOUBLE)))"
    centre = f"(start{j} + drift{j} * {DT_DF} * ({stacked} // 16))"
    return f"exp(-pow({stacked} % 16 - {centre}, 2) / (2 * {sigma} * {sigma}))"


GENERATED = f"""stacked AS (
  SELECT p.*, g.obs, g.i AS cell, g.obs * 64 + g.i AS i, g.v,
    stddev_pop(g.v) OVER (PARTITION BY split_set, class, sample_idx) AS s0
  FROM picked p JOIN good g ON g.cadence_id = p.cadence_id),
once AS (
  SELECT *, CASE WHEN class = 'false_no_signal' THEN v ELSE v + snr * s0 / sqrt(24) * {profile(1)} END AS v1 FROM stacked),
spread AS (SELECT *, stddev_pop(v1) OVER (PARTITION BY split_set, class, sample_idx) AS s1 FROM once),
twice AS (
  SELECT *, CASE WHEN class = 'true_double' THEN v1 + snr * s1 / sqrt(24) * {profile(2)} ELSE v1 END AS v2 FROM spread),
spliced AS (
  SELECT split_set, class, sample_idx, background_idx, obs, cell,
    ln(CASE WHEN obs % 2 = 0 THEN v2 WHEN class = 'true_single' THEN v ELSE v1 END + 1e-10) AS l FROM twice),
bounded AS (
  SELECT *, min(l) OVER w AS lo, max(l) OVER w AS hi FROM spliced
  WINDOW w AS (PARTITION BY split_set, class, sample_idx, obs)),
generated AS (
  SELECT split_set, class, sample_idx, background_idx, obs, cell AS i,
    CASE WHEN hi > lo THEN (l - lo) / (hi - lo) ELSE 0 END AS v FROM bounded)"""


def generated(plan: str) -> str:
    return with_(CELLS, VALID, GOOD, BACKGROUNDS, plan, tracks("plan", 64), PICKED, GENERATED)


def _gen(*classes: str) -> str:
    return generated(plan_of(*classes)) + f"""
SELECT class, sample_idx, background_idx, obs, {DIGEST} FROM generated GROUP BY class, sample_idx, background_idx, obs"""


ORACLES["gen_false"] = _gen("false_no_signal", "false_with_rfi")
ORACLES["gen_true_single"] = _gen("true_single")
ORACLES["gen_true_double"] = _gen("true_double")
ORACLES["generate_batch"] = generated(PLAN) + f"""
SELECT split_set, class, sample_idx, background_idx, obs, {DIGEST} FROM generated
GROUP BY split_set, class, sample_idx, background_idx, obs"""

SETS = """sets AS (
  SELECT 'concatenated' AS split_set, cadence_id AS sample_idx, obs, v FROM normed
  UNION ALL SELECT 'true', cadence_id, obs, v * v FROM normed
  UNION ALL SELECT 'false', cadence_id, obs, 1 - v FROM normed)"""

ORACLES["norm_range_check"] = with_(CELLS, VALID, GOOD, NORMED, SETS) + f"""
SELECT split_set, count(*) // 64 AS rows, CAST(0 AS BIGINT) + count(*) FILTER (WHERE isnan(v)) AS nan_rows,
  count(*) FILTER (WHERE isinf(v)) AS inf_rows, {r('min(v)')} AS min_value, {r('max(v)')} AS max_value,
  {r('avg(v)')} AS mean_value, bool_and(v >= 0 AND v <= 1) AS in_range FROM sets GROUP BY split_set"""

ORACLES["aligned_triples"] = with_(CELLS, VALID, GOOD, NORMED) + f"""
SELECT cadence_id AS sample_idx, obs, {r('sum(v)')} AS main_total, {r('sum(v * v)')} AS true_total,
  {r('sum(1 - v)')} AS false_total, {r('sum(v)')} AS target_total
FROM normed GROUP BY cadence_id, obs"""

ORACLES["onoff_splice"] = with_(CELLS, VALID, GOOD, NORMED, """spliced AS (
  SELECT cadence_id, obs, i, v FROM normed WHERE obs IN (0, 2, 4)
  UNION ALL SELECT cadence_id, obs, i, v FROM good WHERE obs IN (1, 3, 5))""") + f"""
SELECT cadence_id, obs, {DIGEST} FROM spliced GROUP BY cadence_id, obs"""

ORACLES["generate_plugged"] = with_(CELLS, VALID, GOOD, BACKGROUNDS, PLAN, """chosen AS (
  SELECT class, sample_idx, sample_idx % (SELECT count(*) FROM bg) AS background_idx,
    row_number() OVER (PARTITION BY class, chunk ORDER BY sample_idx) AS seen FROM plan WHERE split_set = 'true'),
made AS (
  SELECT class, sample_idx, background_idx, obs, i, v * CASE WHEN class LIKE 'true%' AND obs % 2 = 0 THEN 2 ELSE 1 END + seen AS v
  FROM chosen JOIN bg USING (background_idx) JOIN good USING (cadence_id))""") + f"""
SELECT class, sample_idx, background_idx, obs, {DIGEST} FROM made GROUP BY class, sample_idx, background_idx, obs"""

_CADENCE_TRACK = track(1, "10", "cadence_id", "7")
ORACLES["augment_tracks"] = with_(CELLS, VALID, GOOD, f"""t0 AS (
  SELECT cadence_id, {u('cadence_id', 1, 7)} * 40 + 10 AS snr, {_CADENCE_TRACK[0]} FROM valid),
t1 AS (SELECT *, {_CADENCE_TRACK[1]} FROM t0),
t2 AS (SELECT *, {_CADENCE_TRACK[2]} FROM t1),
t3 AS (SELECT *, base1 + abs(drift1) * 18 AS width1 FROM t2),
c AS (
  SELECT cadence_id, obs * 64 + i AS i, v, stddev_pop(v) OVER (PARTITION BY cadence_id) AS s FROM good)""") + f"""
SELECT cadence_id, i AS cell, {r(f'v + snr * s / sqrt(24) * {profile(1)}')} AS v FROM c JOIN t3 USING (cadence_id)"""

# --- features, models, scoring -------------------------------------------------------

ORACLES["cadence_features"] = with_(*LATENTS[:2]) + f"""
SELECT cadence_id, obs * 64 + d AS feature, {r('m')} AS v FROM z WHERE cadence_id IN (SELECT cadence_id FROM whole)"""

ORACLES["batch_score"] = f"""
SELECT vec_id, {r('sum(CAST(x AS DOUBLE) * i) / 64')} AS p FROM (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY vec_id"""

ORACLES["band_scan"] = with_(CELLS, VALID, GOOD, snippets(8, 4)) + ", " + detections("""scores AS (
  SELECT cadence_id AS band, obs, start_index, avg(v) * 5 AS p FROM snippets
  GROUP BY cadence_id, obs, start_index)""", "2.7939677238464355")[len("WITH "):] + f"""
SELECT band, {REPORT} FROM found"""

ORACLES["reparam_sample"] = with_(LATENTS[0]) + f"""
SELECT cadence_id, obs, d AS dim, {r('m + exp(lv / 2) * e')} AS v FROM z"""

# The trees are grown from hashed draws: SQL can't state what comes of them, only how one splits and how trees are walked.
_TENTHS = """cell AS (
  SELECT vec_id, CASE WHEN label < 5 THEN 1 ELSE 0 END AS y, generate_subscripts(embedding, 1) - 1 AS feature,
    floor(CAST(unnest(embedding) AS DOUBLE) * 10) AS v FROM embeddings),
per_value AS (SELECT feature, v, count(*) AS n, sum(y) AS ones FROM cell GROUP BY feature, v),
cut AS (
  SELECT feature, (v + lead(v) OVER f) / 2 AS threshold, sum(n) OVER f AS ln, sum(ones) OVER f AS l1,
    sum(n) OVER (PARTITION BY feature) AS n, sum(ones) OVER (PARTITION BY feature) AS n1
  FROM per_value WINDOW f AS (PARTITION BY feature ORDER BY v)),
best AS (
  SELECT *, 2.0 * n1 * (n - n1) / n - 2.0 * l1 * (ln - l1) / ln - 2.0 * (n1 - l1) * (n - ln - n1 + l1) / (n - ln) AS gain
  FROM cut WHERE threshold IS NOT NULL ORDER BY gain DESC, feature, threshold LIMIT 1)"""
ORACLES["forest_split"] = with_(_TENTHS) + f"""
SELECT 0 AS node, CAST(feature AS INTEGER) AS feature, threshold, {r('n1 / CAST(n AS DOUBLE)')} AS p, CAST(n AS DOUBLE) AS weight, {r('gain')} AS gain FROM best
UNION ALL SELECT 1, -1, 0, {r('l1 / CAST(ln AS DOUBLE)')}, ln, 0 FROM best
UNION ALL SELECT 2, -1, 0, {r('(n1 - l1) / CAST(n - ln AS DOUBLE)')}, n - ln, 0 FROM best"""

ORACLES["forest_walk"] = f"""
WITH RECURSIVE nodes AS (
  SELECT vec_id // 15 AS tree, vec_id % 15 AS node, vec_id * 7 % 64 AS cell, embedding[vec_id * 7 % 64 + 1] AS threshold, label / CAST(10 AS DOUBLE) AS p
  FROM embeddings WHERE vec_id // 15 < (SELECT count(*) FROM embeddings WHERE vec_id % 15 = 14)),
walk AS (
  SELECT vec_id, embedding, tree, CAST(0 AS BIGINT) AS node FROM embeddings, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT vec_id, embedding, walk.tree, 2 * walk.node + CASE WHEN embedding[cell + 1] <= threshold THEN 1 ELSE 2 END
  FROM walk JOIN nodes USING (tree, node) WHERE walk.node < 7)
SELECT vec_id, {r('avg(p)')} AS p FROM walk JOIN nodes USING (tree, node) WHERE node >= 7 GROUP BY vec_id"""


def principal(k: int, d: int, squarings: int = 18) -> list[str]:
    """Directions ``v1..vk`` of the largest variance of ``x(cells)``: columns of a high power of the covariance, deflated one by one."""
    out = [
        f"mean AS (SELECT [{', '.join(f'avg(cells[{i}])' for i in range(1, d + 1))}] AS m FROM x)",
        "centred AS (SELECT list_transform(list_zip(cells, m), lambda p: p[1] - p[2]) AS c FROM x, mean)",
        "c1 AS (SELECT ["
        + ", ".join("[" + ", ".join(f"sum(c[{i}] * c[{j}])" for j in range(1, d + 1)) + "]" for i in range(1, d + 1))
        + "] AS c FROM centred)",
    ]
    for n in range(1, k + 1):
        # a symmetric matrix times itself: the products of its rows
        times = "list_transform(c, lambda a: list_transform(c, lambda b: list_dot_product(a, b)))"
        size = "list_max(list_transform(c, lambda a: sqrt(list_dot_product(a, a))))"
        scaled = f"list_transform(c, lambda a: list_transform(a, lambda e: e / {size}))"
        out += [
            f"s{n}(step, c) AS (SELECT 0, {scaled} FROM c{n} UNION ALL SELECT step + 1, {scaled} FROM (SELECT step, {times} AS c FROM s{n} WHERE step < {squarings}))",
            f"""r{n} AS (SELECT list_transform(c, lambda a: {{'n': list_dot_product(a, a), 'a': a}}) AS rows FROM s{n} WHERE step = {squarings}),
u{n} AS (SELECT list_transform(row.a, lambda e: e / sqrt(row.n)) AS v FROM (SELECT unnest(rows) AS row FROM r{n}) ORDER BY row.n DESC LIMIT 1),
v{n} AS (SELECT list_transform(v, lambda e: e * sign(v[list_position(list_transform(v, lambda e: abs(e)), list_max(list_transform(v, lambda e: abs(e))))])) AS v FROM u{n}),
l{n} AS (SELECT v, list_dot_product(v, list_transform(c, lambda a: list_dot_product(a, v))) AS l FROM v{n}, c{n}),
c{n + 1} AS (SELECT list_transform(range(1, {d} + 1), lambda i: list_transform(range(1, {d} + 1), lambda j: c[i][j] - l * v[i] * v[j])) AS c FROM c{n}, l{n})""",
        ]
    return out


_BLOCK_MEANS = """x AS (
  SELECT cadence_id, obs, list(v ORDER BY j) AS cells FROM (
    SELECT cadence_id, obs, i // 4 AS j, avg(v) AS v FROM good GROUP BY cadence_id, obs, i // 4) GROUP BY cadence_id, obs)"""
ORACLES["embed_observations"] = with_(CELLS, VALID, GOOD, _BLOCK_MEANS, *principal(3, 16)).replace("WITH", "WITH RECURSIVE", 1) + f"""
SELECT cadence_id, obs, {", ".join(f"{r(f'list_dot_product(cells, v{n}.v)', 5)} AS z{n}" for n in (1, 2, 3))} FROM x, v1, v2, v3"""

# --- text ----------------------------------------------------------------------------

ORACLES["metadata_json"] = """
SELECT event_id AS id, '{"ip_address":"10.0.0.' || (user_id % 256) || '","machine_name":"' || event_type
  || '","user_name":"user_' || user_id || '"}' AS metadata,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""

ORACLES["pattern_string"] = with_(BAND_SCORES, GROUPS) + """
SELECT band, start_index, pattern AS observation_pattern FROM groups"""

ORACLES["tag_parse"] = with_(ARTIFACTS, ranked("artifacts", "family, kind")) + """
SELECT tag, rank, coalesce(version, -1) AS version, count(*) AS files FROM ranked GROUP BY tag, rank, version"""

# --- streams -------------------------------------------------------------------------

ORACLES["stream_ingest"] = with_(TELEMETRY) + f"""
SELECT id, {r('ts_unix')} AS ts_unix, resource_type, resource_name, value, unit, tag, metadata FROM telemetry"""

ORACLES["stream_ingest_flush"] = f"""
SELECT flush, count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id, {r('sum(value)')} AS total FROM (
  SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // CAST(ceil(count(*) OVER () / 8.0) AS BIGINT) AS flush FROM events) GROUP BY flush"""

ORACLES["stream_series"] = with_(TELEMETRY) + f"""
SELECT CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS window_start, resource_type, resource_name,
  {r('avg(value)')} AS mean_value, {r('max(value)')} AS max_value, count(*) AS samples FROM telemetry GROUP BY 1, 2, 3"""

ORACLES["stream_dedup"] = with_(TELEMETRY) + f"""
SELECT id, {r('ts_unix')} AS ts_unix, resource_type, resource_name, value, tag FROM telemetry"""
