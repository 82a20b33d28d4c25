"""DuckDB SQL of the session tables, written from their definitions; shared by the queries' oracles."""

from __future__ import annotations

LOCAL_END = "coalesce(end_local, start_local + to_seconds(CAST(round(coalesce(charging_minutes, 0) * 60) AS BIGINT)))"
SHOWN = "strftime({0}, '%Y-%m-%d') AS {0}"
#: What the publishers write: H:MM:SS, alpha's two forms of an instant, gamma's two forms of a date.
HMS = "({0} // 3600 || ':' || lpad(CAST({0} % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({0} % 60 AS VARCHAR), 2, '0'))"
MIXED = "CASE WHEN event_id % 2 = 0 THEN strftime({0}, '%Y-%m-%d %H:%M:%S') ELSE strftime({0}, '%-m/%-d/%Y %-H:%M') END"
DATE = "CASE WHEN family = 'rapids_anomalies' THEN strftime({0}, '%d/%m/%Y') ELSE strftime({0}, '%Y-%m-%d') END"
ENERGY = "CAST(energy AS VARCHAR)"


def row_hash(source: str, *texts: str) -> str:
    """SHA-256 over the source and the published texts: rows are equal if all their texts are; a blank row has none."""
    own = ", ".join(f"coalesce(CASE WHEN NOT blank THEN {t} END, chr(0))" for t in texts)
    return f"sha256(concat_ws(chr(31), '{source}', {own})) AS row_hash"


ALPHA_HASH = row_hash(
    "alpha", "'Plaza ' || (user_id % 25)", "event_type", f"CASE WHEN event_id % 59 = 0 THEN 'n/a' ELSE {MIXED.format('started')} END", MIXED.format("ended"), HMS.format("charged_s"), HMS.format("plug_s"), ENERGY
)
BETA_HASH = row_hash(
    "beta", "'Garage ' || (user_id % 25)", "event_type", "strftime(started, '%Y-%m-%dT%H:%M:%S') || '+00:00'", f"CASE WHEN event_id % 244 = 0 THEN '7 min' ELSE {HMS.format('charged_s')} END", ENERGY
)
#: Plug-in hours in thousandths, exact halves up: a double's rounding leaves halves to its last bit.
THOUSANDTHS = "((plug_s * 1000 + 1800) // 3600)"
GAMMA_HASH = row_hash(
    "gamma", "CASE WHEN event_id % 17 = 0 THEN 'NA' ELSE 'CP' || (user_id % 25) END", "'Site  ' || event_type || ' '", "(k % 3) || ' - Type 2'", DATE.format("started"), "strftime(started, '%H:%M:%S')",
    f"CASE WHEN event_id % 29 = 0 THEN 'NA' WHEN event_id % 31 = 0 THEN {DATE.format("TIMESTAMP '1970-01-01'")} ELSE {DATE.format('ended')} END", "CASE WHEN event_id % 29 = 0 THEN 'NA' ELSE strftime(ended, '%H:%M:%S') END",
    f"CASE family WHEN 'rapids' THEN CAST(plug_s // 60 AS VARCHAR) WHEN 'rapids_anomalies' THEN 'NA' ELSE {THOUSANDTHS} // 1000 || '.' || lpad(CAST({THOUSANDTHS} % 1000 AS VARCHAR), 3, '0') END", ENERGY,
)

#: Levels of concurrency of which days are counted: those of the published port counts, and every one.
PUBLISHED_LEVELS = "(SELECT unnest(range(1, 9)) AS k)"
EVERY_LEVEL = "(SELECT unnest(range(1, (SELECT CAST(max(level) AS BIGINT) + 1 FROM day_max))) AS k)"

TYPED = f"""timed AS (
  SELECT event_id, user_id, event_type, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k, c.copy, event_id + 1000000000 * c.copy AS object_id, event_id % 211 = 7 AS blank,
    CASE WHEN event_id % 79 = 5 THEN CASE WHEN event_id % 3 = 2 THEN TIMESTAMP '2024-10-27 01:00:00' ELSE TIMESTAMP '2024-11-03 01:00:00' END + to_seconds(event_id * 7 % 3600)
      WHEN event_id % 73 = 11 THEN date_trunc('second', ts) + to_days(CAST(61 + 40 * (event_id % 5) AS INTEGER)) ELSE date_trunc('second', ts) + INTERVAL 61 DAY END AS started,
    CAST(round(value * 60) AS BIGINT) + CASE WHEN event_id % 83 = 13 THEN 90000 ELSE 0 END AS charge_s, CAST(round(value * 75) AS BIGINT) + CASE WHEN event_id % 83 = 13 THEN 90000 ELSE 0 END AS plug_s,
    CASE WHEN event_id % 103 = 0 THEN -2000.0 WHEN event_id % 101 = 0 THEN -1.5 WHEN event_id % 11 = 0 THEN 0.0 WHEN event_id % 89 = 17 THEN round(value * 2.4, 3) ELSE round(value * 0.12, 3) END AS energy
  FROM events, (VALUES (0), (1)) c(copy) WHERE c.copy = 0 OR event_id % 97 = event_id % 3),
alpha_timed AS (
  SELECT *, started + to_seconds(CASE WHEN event_id % 53 = 0 THEN -600 ELSE plug_s END) AS ended, CASE WHEN event_id % 47 = 0 THEN plug_s + 120 ELSE charge_s END AS charged_s,
    CASE WHEN NOT blank THEN object_id END AS file_row, CASE WHEN blank THEN NULL WHEN copy = 1 THEN event_id // 291 ELSE event_id // 3 % 1000 END AS delivery_row
  FROM timed WHERE event_id % 3 = 0),
alpha AS (
  SELECT object_id, 'alpha' AS source, 'alpha' AS family, 'America/Denver' AS zone,
    sum(CASE WHEN delivery_row = 0 THEN 1 ELSE 0 END) OVER (ORDER BY file_row NULLS LAST, delivery_row ROWS UNBOUNDED PRECEDING) - 1 AS delivery_block, file_row,
    CASE WHEN NOT blank THEN 'Plaza ' || (user_id % 25) END AS unit, CASE WHEN NOT blank THEN event_type END AS site_key, CAST(NULL AS VARCHAR) AS port_id,
    CASE WHEN blank OR event_id % 59 = 0 THEN NULL WHEN event_id % 2 = 0 THEN started ELSE date_trunc('minute', started) END AS start_local,
    CASE WHEN blank THEN NULL WHEN event_id % 2 = 0 THEN ended ELSE date_trunc('minute', ended) END AS end_local, TRUE AS has_end, FALSE AS is_end_sentinel,
    CASE WHEN event_id % 2 = 0 AND event_id % 59 <> 0 AND NOT blank THEN 1 ELSE 60 END AS precision_seconds,
    CASE WHEN NOT blank THEN charged_s // 3600 * 60.0 + charged_s % 3600 // 60 + (charged_s % 60) / 60.0 END AS charging_minutes,
    CASE WHEN NOT blank THEN plug_s // 3600 * 60.0 + plug_s % 3600 // 60 + (plug_s % 60) / 60.0 END AS reported_minutes, CASE WHEN NOT blank THEN energy END AS energy_kwh, event_id, blank, CAST(NULL AS TIMESTAMP) AS given, {ALPHA_HASH}
  FROM alpha_timed),
beta_timed AS (
  SELECT *, CASE WHEN copy = 0 THEN charge_s WHEN event_id % 2 = 0 THEN charge_s + 60 ELSE greatest(charge_s - 60, 0) END AS charged_s FROM timed WHERE event_id % 3 = 1),
beta AS (
  SELECT object_id, 'beta' AS source, 'beta' AS family, 'America/New_York' AS zone, NULL AS delivery_block, NULL AS file_row,
    CASE WHEN NOT blank THEN 'Garage ' || (user_id % 25) END AS unit, CASE WHEN NOT blank THEN event_type END AS site_key, CAST(NULL AS VARCHAR) AS port_id,
    CASE WHEN NOT blank THEN timezone('America/New_York', timezone('UTC', started)) END AS start_local, CAST(NULL AS TIMESTAMP) AS end_local, FALSE AS has_end, FALSE AS is_end_sentinel, 1 AS precision_seconds,
    CASE WHEN blank OR event_id % 244 = 0 THEN NULL ELSE charged_s // 3600 * 60.0 + charged_s % 3600 // 60 + (charged_s % 60) / 60.0 END AS charging_minutes,
    CAST(NULL AS DOUBLE) AS reported_minutes, CASE WHEN NOT blank THEN energy END AS energy_kwh, event_id, blank, CASE WHEN NOT blank THEN started END AS given, {BETA_HASH}
  FROM beta_timed),
gamma_timed AS (
  SELECT *, started + to_seconds(plug_s) AS ended, ['rapids', 'rapids_anomalies', 'fasts', 'fasts_anomalies'][CASE WHEN copy = 0 THEN event_id % 4 + 1 WHEN event_id % 4 = 0 THEN 2 WHEN event_id % 4 = 1 THEN 1 WHEN event_id % 4 = 2 THEN 4 ELSE 3 END] AS family
  FROM timed WHERE event_id % 3 = 2),
gamma AS (
  SELECT object_id, 'gamma' AS source, family, 'Europe/London' AS zone, NULL AS delivery_block, NULL AS file_row,
    CASE WHEN blank OR event_id % 17 = 0 THEN NULL ELSE 'CP' || (user_id % 25) END AS unit, CASE WHEN NOT blank THEN 'Site ' || event_type END AS site_key, CASE WHEN NOT blank THEN CAST(k % 3 AS VARCHAR) END AS port_id,
    CASE WHEN NOT blank THEN started END AS start_local,
    CASE WHEN blank OR event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN TIMESTAMP '1970-01-01' + (ended - date_trunc('day', ended)) ELSE ended END AS end_local, TRUE AS has_end,
    CASE WHEN blank OR event_id % 29 = 0 THEN NULL ELSE event_id % 31 = 0 END AS is_end_sentinel, 1 AS precision_seconds, CAST(NULL AS DOUBLE) AS charging_minutes,
    CASE WHEN blank OR family = 'rapids_anomalies' THEN NULL WHEN family = 'rapids' THEN CAST(plug_s // 60 AS DOUBLE) ELSE {THOUSANDTHS} / 1000.0 * 60.0 END AS reported_minutes,
    CASE WHEN NOT blank THEN energy END AS energy_kwh, event_id, blank, CAST(NULL AS TIMESTAMP) AS given, {GAMMA_HASH}
  FROM gamma_timed),
typed AS (SELECT * FROM alpha UNION ALL SELECT * FROM beta UNION ALL SELECT * FROM gamma),
clocked AS (
  SELECT *, source || '/' || CASE WHEN source = 'gamma' THEN coalesce(unit, 'unknown/' || coalesce(site_key, '<null>')) ELSE unit END AS station_key,
    coalesce(given, timezone('UTC', timezone(zone, start_local))) AS start_utc, timezone('UTC', timezone(zone, end_local)) AS end_utc,
    given IS NULL AND start_local IS NOT NULL AND timezone(zone, timezone(zone, start_local)) = start_local
      AND timezone(zone, start_local) - timezone(zone, start_local - INTERVAL 1 HOUR) = INTERVAL 2 HOUR AS is_ambiguous FROM typed),
measured AS (
  SELECT *, (epoch_us(end_utc) - epoch_us(start_utc)) / 6e7 AS connected_minutes,
    source <> 'beta' AND (coalesce(timezone(zone, timezone(zone, start_local)) <> start_local, FALSE) OR coalesce(timezone(zone, timezone(zone, end_local)) <> end_local, FALSE)) AS is_nonexistent
  FROM clocked),
powered AS (
  SELECT *, CASE WHEN source = 'gamma' AND connected_minutes > 0 THEN energy_kwh / (connected_minutes / 60.0) WHEN source <> 'gamma' AND charging_minutes > 0 THEN energy_kwh / (charging_minutes / 60.0) END AS implied_kw,
    source = 'gamma' AND (coalesce(energy_kwh = 0, FALSE) OR coalesce(coalesce(reported_minutes, connected_minutes) <= 3, FALSE)) AS publisher_excluded,
    CASE WHEN source = 'beta' THEN start_utc ELSE date_trunc('minute', start_local) END AS key_start,
    CASE WHEN source <> 'beta' THEN date_trunc('minute', end_local) END AS key_end, CASE WHEN source <> 'beta' THEN energy_kwh END AS key_kwh,
    CASE source WHEN 'alpha' THEN -delivery_block WHEN 'beta' THEN -charging_minutes ELSE CASE WHEN family IN ('rapids', 'fasts') THEN 0 ELSE 1 END END AS order_1 FROM measured),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source, row_hash ORDER BY order_1 NULLS LAST, -file_row NULLS LAST, family, object_id) AS exact_rank,
    row_number() OVER (PARTITION BY source, unit, port_id, key_start, key_end, key_kwh ORDER BY order_1 NULLS LAST, -file_row NULLS LAST, family, row_hash, object_id) AS key_rank
  FROM powered),
judged AS (
  SELECT *,
    list_filter([
      CASE WHEN blank THEN 'blank_row' END,
      CASE WHEN start_local IS NULL OR (has_end AND end_local IS NULL AND NOT is_end_sentinel) THEN 'unparseable_timestamp' END,
      CASE WHEN is_nonexistent THEN 'nonexistent_local_time' END, CASE WHEN exact_rank > 1 THEN 'exact_duplicate' END,
      CASE WHEN key_rank > 1 THEN 'natural_key_duplicate' END, CASE WHEN is_end_sentinel THEN 'end_sentinel_1970' END,
      CASE WHEN connected_minutes < 0 THEN 'end_before_start' END, CASE WHEN energy_kwh < 0 THEN 'negative_energy' END,
      CASE WHEN energy_kwh < -1000 THEN 'energy_sentinel' END,
      CASE WHEN charging_minutes > connected_minutes + precision_seconds / 60.0 THEN 'charging_exceeds_connected' END,
      CASE WHEN implied_kw > CASE WHEN source <> 'gamma' THEN 20.0 WHEN family LIKE 'rapids%' THEN 55.0 ELSE 30.0 END THEN 'implied_kw_over_ceiling' END
    ], lambda x: x IS NOT NULL) AS reasons,
    list_filter([
      CASE WHEN energy_kwh = 0 THEN 'zero_energy' END,
      CASE WHEN charging_minutes > connected_minutes AND charging_minutes <= connected_minutes + precision_seconds / 60.0 THEN 'charging_exceeds_connected_within_precision' END,
      CASE WHEN coalesce(connected_minutes, charging_minutes) > 1440 THEN 'over_24h' END,
      CASE WHEN abs(connected_minutes - reported_minutes) > 2 THEN 'duration_disagrees' END, CASE WHEN is_ambiguous THEN 'dst_ambiguous' END,
      CASE WHEN publisher_excluded THEN 'publisher_excluded_rule' END, CASE WHEN contains(station_key, '/unknown/') THEN 'unknown_station' END
    ], lambda x: x IS NOT NULL) AS flags,
    coalesce(energy_kwh > 0, FALSE) AND coalesce(coalesce(connected_minutes, charging_minutes) > 3, FALSE) AS is_non_trivial,
    CASE WHEN source = 'alpha' THEN greatest(connected_minutes - charging_minutes, 0.0) END AS idle_minutes
  FROM ranked),
sessions AS (SELECT *, CASE WHEN source = 'gamma' THEN 'gamma/' || coalesce(site_key, '<null>') ELSE source END AS operator_key FROM judged WHERE len(reasons) = 0),
all_line AS (
  SELECT *, epoch(start_utc) AS s, CASE WHEN end_utc IS NOT NULL THEN epoch(end_utc) ELSE epoch(start_utc) + round(coalesce(charging_minutes, 0) * 60) END AS e,
    CAST(start_local AS DATE) AS start_day, CAST({LOCAL_END} AS DATE) AS end_day FROM sessions WHERE NOT contains(station_key, '/unknown/')),
timeline AS (SELECT * FROM all_line WHERE is_non_trivial),
moves AS (
  SELECT station_key, object_id, s AS t, 1 AS d, start_day AS day FROM timeline UNION ALL SELECT station_key, object_id, e AS t, -1 AS d, NULL AS day FROM timeline),
sweep AS (SELECT *, sum(d) OVER (PARTITION BY station_key ORDER BY t, d, object_id ROWS UNBOUNDED PRECEDING) AS level FROM moves),
day_max AS (SELECT station_key, day, max(level) AS level FROM sweep WHERE d = 1 GROUP BY 1, 2),
at_level AS (SELECT station_key, lv.k AS level, count(*) AS days FROM day_max, {PUBLISHED_LEVELS} lv WHERE day_max.level >= lv.k GROUP BY 1, 2),
ports AS (
  SELECT station_key, max(CASE WHEN days >= 5 THEN level END) AS robust_max, max(level) AS plain_max FROM at_level GROUP BY 1),
gaps AS (
  SELECT station_key, source, end_day AS d, e, lead(s) OVER w AS next_s, lead(start_day) OVER w AS next_d FROM timeline WINDOW w AS (PARTITION BY station_key ORDER BY s, e, object_id)),
long_gaps AS (
  SELECT station_key, source, d AS gap_after, next_d AS gap_before, (next_s - e) / 86400.0 AS gap_days, greatest(next_d - d - 1, 0) AS excluded_days
  FROM gaps WHERE (next_s - e) / 86400.0 > CASE source WHEN 'gamma' THEN 90 ELSE 30 END),
picks AS (
  SELECT DISTINCT station_key, first_value(site_key) OVER (PARTITION BY station_key ORDER BY n DESC, site_key) AS site_key
  FROM (SELECT station_key, site_key, count(*) AS n FROM timeline WHERE site_key IS NOT NULL GROUP BY 1, 2)),
stations AS (
  SELECT station_key, min(source) AS source, min(zone) AS zone, min(unit) AS unit, count(*) AS sessions, count(DISTINCT start_day) AS active_days, min(start_day) AS active_from, max(end_day) AS active_to,
    count(DISTINCT port_id) AS connector_ids, count(DISTINCT site_key) AS sites, count(DISTINCT operator_key) AS operators FROM timeline GROUP BY 1),
dim AS (
  SELECT s.*, k.site_key, CASE WHEN s.source = 'gamma' THEN 'gamma/' || coalesce(k.site_key, '<null>') ELSE s.source END AS operator_key, p.robust_max, p.plain_max, greatest(connector_ids, coalesce(robust_max, 0), 1) AS ports,
    CASE WHEN greatest(connector_ids, coalesce(robust_max, 0)) < 1 THEN 'floor' WHEN connector_ids >= coalesce(robust_max, 0) THEN 'connector_ids' ELSE 'observed_concurrency' END AS ports_source,
    coalesce(g.excluded_days, 0) AS excluded_days, coalesce(g.excluded_gaps, 0) AS excluded_gaps
  FROM stations s LEFT JOIN ports p USING (station_key) LEFT JOIN picks k USING (station_key)
  LEFT JOIN (SELECT station_key, CAST(sum(excluded_days) AS BIGINT) AS excluded_days, count(*) AS excluded_gaps FROM long_gaps GROUP BY 1) g USING (station_key)),
spine AS (
  SELECT station_key, source, operator_key, ports, zone, CAST(unnest(generate_series(active_from, active_to, INTERVAL 1 DAY)) AS DATE) AS day FROM dim),
excluded AS (SELECT DISTINCT sp.station_key, sp.day FROM spine sp JOIN long_gaps g ON sp.station_key = g.station_key AND sp.day > g.gap_after AND sp.day < g.gap_before),
spine_days AS (
  SELECT s.*, (epoch(timezone(zone, CAST(s.day + INTERVAL 1 DAY AS TIMESTAMP))) - epoch(timezone(zone, CAST(s.day AS TIMESTAMP)))) / 60.0 AS day_minutes, x.station_key IS NOT NULL AS is_excluded
  FROM spine s LEFT JOIN excluded x ON s.station_key = x.station_key AND s.day = x.day),
usable AS (
  SELECT *, epoch(start_utc) AS s, epoch(end_utc) AS plug_e, epoch(start_utc) + round(charging_minutes * 60) AS charge_e, CAST(start_local AS DATE) AS start_day, CAST({LOCAL_END} AS DATE) AS last_day FROM sessions),
piece_days AS (SELECT *, CAST(unnest(generate_series(start_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM usable),
bounded AS (
  SELECT *, epoch(timezone(zone, CAST(day AS TIMESTAMP))) AS d0, epoch(timezone(zone, CAST(day + INTERVAL 1 DAY AS TIMESTAMP))) AS d1 FROM piece_days),
pieces AS (
  SELECT *, CASE WHEN plug_e IS NOT NULL THEN greatest(least(plug_e, d1) - greatest(s, d0), 0) / 60.0 END AS connected_piece,
    CASE WHEN charge_e IS NOT NULL THEN greatest(least(charge_e, d1) - greatest(s, d0), 0) / 60.0 END AS charging_piece FROM bounded),
allocated AS (
  SELECT *, CASE WHEN charging_minutes IS NOT NULL AND charging_minutes > 0 THEN energy_kwh * charging_piece / charging_minutes
    WHEN charging_minutes IS NULL AND connected_minutes IS NOT NULL AND connected_minutes > 0 THEN energy_kwh * connected_piece / connected_minutes
    WHEN day = start_day THEN energy_kwh ELSE 0.0 END AS energy_piece FROM pieces),
usage AS (
  SELECT station_key, day, count(*) FILTER (WHERE day = start_day AND is_non_trivial) AS sessions, count(*) FILTER (WHERE day = start_day AND NOT is_non_trivial) AS trivial_sessions,
    sum(energy_piece) FILTER (WHERE is_non_trivial) AS energy_kwh, sum(charging_piece) FILTER (WHERE is_non_trivial) AS charging_minutes, sum(connected_piece) FILTER (WHERE is_non_trivial) AS connected_minutes,
    count(charging_piece) FILTER (WHERE is_non_trivial) AS charging_pieces, count(connected_piece) FILTER (WHERE is_non_trivial) AS connected_pieces
  FROM allocated GROUP BY 1, 2),
station_day AS (
  SELECT d.station_key, d.day, d.source, d.operator_key, d.ports, d.is_excluded, d.day_minutes, CASE WHEN d.is_excluded THEN 0.0 ELSE d.day_minutes * d.ports END AS available_minutes,
    coalesce(u.sessions, 0) AS sessions, coalesce(u.trivial_sessions, 0) AS trivial_sessions, u.energy_kwh, u.charging_minutes, u.connected_minutes, coalesce(u.charging_pieces, 0) AS charging_pieces,
    coalesce(u.connected_pieces, 0) AS connected_pieces,
    CASE WHEN u.charging_minutes IS NOT NULL AND u.connected_minutes IS NOT NULL THEN greatest(u.connected_minutes - u.charging_minutes, 0.0) END AS idle_minutes
  FROM spine_days d LEFT JOIN usage u USING (station_key, day))"""


def with_tables(select: str, levels: str = PUBLISHED_LEVELS) -> str:
    """``select`` over the session tables above."""
    return "WITH " + TYPED.replace(PUBLISHED_LEVELS, levels) + "\n" + select
