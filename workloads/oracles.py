"""The same results in plain SQL, written independently of the library."""

from __future__ import annotations

# Shared table expressions, chained in front of each query.
CELLS = """
cells AS (
  SELECT 'S' || l_suppkey AS source,
    CASE l_linenumber WHEN 1 THEN 'RWTC' WHEN 2 THEN 'RBRTE' WHEN 3 THEN 'RCLC1' WHEN 4 THEN 'RCLC2'
      WHEN 5 THEN 'RCLC3' WHEN 6 THEN 'RCLC4' WHEN 7 THEN 'RWTC' END AS series_id,
    CAST(l_shipdate AS DATE) AS observation_date,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2))
      * (CAST(0.095 AS DECIMAL(4,3)) - CAST(l_discount AS DECIMAL(4,3))) AS DECIMAL(18,6)) AS price,
    l_shipdate + to_hours(CAST(l_quantity AS INTEGER)) AS seen, l_linestatus
  FROM lineitem),
obs AS (
  SELECT source, series_id, observation_date, max(price) AS price, max(seen) AS retrieved_at
  FROM cells GROUP BY ALL),
gold AS (
  SELECT source, series_id, observation_date, max(price) AS price, min(seen) AS retrieved_at,
    max(seen) AS last_seen_at
  FROM cells WHERE l_linestatus = 'F' GROUP BY ALL)
"""
PAIRS = CELLS + """,
pairs AS (
  SELECT f.source, f.observation_date, 'C' || right(f.series_id, 1) AS position,
    f.price AS future, s.price AS spot, month(f.observation_date) AS month
  FROM obs f JOIN obs s ON s.source = f.source AND s.observation_date = f.observation_date
  WHERE s.series_id = 'RWTC' AND f.series_id LIKE 'RCLC%'),
gold_pairs AS (
  SELECT f.source, 'C' || right(f.series_id, 1) AS position, f.price AS future, s.price AS spot,
    month(f.observation_date) AS month
  FROM gold f JOIN gold s ON s.source = f.source AND s.observation_date = f.observation_date
  WHERE s.series_id = 'RWTC' AND f.series_id LIKE 'RCLC%'),
stats AS (
  SELECT position, month, median(ln(CAST(future AS DOUBLE) / CAST(spot AS DOUBLE))) AS s,
    count(*) AS n_obs
  FROM pairs WHERE spot > 0 AND future > 0 GROUP BY ALL),
gold_stats AS (
  SELECT position, month, median(ln(CAST(future AS DOUBLE) / CAST(spot AS DOUBLE))) AS s,
    count(*) AS n_obs
  FROM gold_pairs WHERE spot > 0 AND future > 0 GROUP BY ALL),
grid AS (
  SELECT 'C' || k AS position, m AS month FROM range(1, 5) a(k), range(1, 13) b(m))
"""
CURVES = CELLS + """,
factors AS (
  SELECT 'C' || k AS position, m AS month, exp(0.002 * k * (13 - 2 * m)) AS factor
  FROM range(1, 5) a(k), range(1, 13) b(m)
  UNION ALL SELECT 'Spot', m, 1.0 FROM range(1, 13) b(m)),
anchored AS (
  SELECT DISTINCT source, observation_date FROM obs WHERE series_id IN ('RWTC', 'RBRTE')),
config AS (
  SELECT * FROM (VALUES ('WTI', 'RWTC', 'WTI futures C1-C4 (RCLC1-RCLC4)'),
    ('BRENT', 'RBRTE', 'WTI futures C1-C4 (borrowed; no Brent futures in EIA)'))
    c(curve_id, anchor, shape_source)),
outrights AS (
  SELECT a.source, c.curve_id, 'outright' AS kind, a.observation_date AS as_of_date, f.position,
    CASE WHEN o.price > 0 THEN CASE WHEN f.position = 'Spot' THEN round_even(o.price, 4)
      ELSE CAST(round(CAST(o.price AS DOUBLE) * f.factor, 4) AS DECIMAL(18,4)) END END AS price,
    CASE WHEN o.price IS NULL THEN 'no ' || c.anchor || ' spot on ' || a.observation_date
      WHEN o.price <= 0 THEN 'non-positive ' || c.anchor || ' spot (' || o.price
        || '); shape undefined' END AS gap_reason,
    c.shape_source
  FROM anchored a CROSS JOIN config c
  JOIN factors f ON f.month = month(a.observation_date)
  LEFT JOIN obs o ON o.source = a.source AND o.observation_date = a.observation_date
    AND o.series_id = c.anchor),
curves AS (
  SELECT *, CASE WHEN price IS NULL THEN 'gap' ELSE 'ok' END AS status FROM (
    SELECT * FROM outrights
    UNION ALL
    SELECT l.source, 'BRENT_WTI', 'spread', l.as_of_date, l.position, l.price - s.price,
      CASE WHEN l.gap_reason IS NOT NULL OR s.gap_reason IS NOT NULL
        THEN concat_ws('; ', l.gap_reason, s.gap_reason) END, 'BRENT minus WTI'
    FROM outrights l JOIN outrights s ON s.source = l.source AND s.as_of_date = l.as_of_date
      AND s.position = l.position AND s.curve_id = 'WTI'
    WHERE l.curve_id = 'BRENT'))
"""
MERGE = CELLS + """,
merged AS (
  SELECT coalesce(n.source, o.source) AS source, coalesce(n.series_id, o.series_id) AS series_id,
    coalesce(n.observation_date, o.observation_date) AS observation_date,
    n.price AS new_price, o.price AS old_price, n.retrieved_at AS new_at,
    o.retrieved_at AS old_at, o.last_seen_at,
    CASE WHEN n.price IS NULL THEN 'kept' WHEN o.price IS NULL THEN 'inserted'
      WHEN n.retrieved_at > o.last_seen_at AND n.price <> o.price THEN 'revised'
      WHEN n.retrieved_at > o.last_seen_at THEN 'seen'
      WHEN n.price <> o.price THEN 'stale' ELSE 'unchanged' END AS kind
  FROM obs n FULL JOIN gold o ON o.source = n.source AND o.series_id = n.series_id
    AND o.observation_date = n.observation_date)
"""
EVENTS = """
keyed AS (
  SELECT event_id, ts, user_id, event_type, value, props,
    CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS txt, strftime(ts, '%Y-%m-%d') AS day
  FROM events)
"""
PAGES = EVENTS + """,
raw_rows AS (
  SELECT event_id, ts, 'U' || user_id AS source,
    '{"period":"' || CASE WHEN k = 13 THEN '2024-13-01' WHEN k = 14 THEN replace(day, '-', '')
      WHEN k = 15 THEN left(day, 7) ELSE day END
    || '","series":"' || CASE WHEN k = 12 THEN 'XXXX' ELSE CASE event_type WHEN 'view' THEN 'RWTC'
      WHEN 'click' THEN 'RBRTE' WHEN 'purchase' THEN 'RCLC1' WHEN 'signup' THEN 'RCLC2'
      ELSE 'RCLC3' END END
    || '","units":"' || CASE WHEN k = 11 THEN '$/GAL' ELSE '$/BBL' END
    || '","value":' || CASE k WHEN 0 THEN 'null' WHEN 1 THEN 'true' WHEN 2 THEN txt || '5'
      WHEN 3 THEN '"NA"' WHEN 4 THEN '"1e3"' WHEN 5 THEN '"' || txt || '00001"'
      WHEN 6 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) WHEN 7 THEN '"1234567890123.5"'
      WHEN 8 THEN '[1]' WHEN 9 THEN '{"v":1}' WHEN 10 THEN '" ' || txt || '"'
      ELSE '"' || txt || '"' END || '}' AS row_json
  FROM keyed),
laid AS (
  SELECT source, CAST(event_id // 500 AS INTEGER) AS page_no, max(ts) AS retrieved_at,
    '{"request":{"params":{"api_key":"k-0000"}},"response":{"data":['
      || string_agg(row_json, ',' ORDER BY event_id) || '],"total":"' || count(*) || '"}}' AS body,
    count(*) AS total
  FROM raw_rows GROUP BY ALL),
page_rows AS (
  SELECT r.source, l.page_no, l.retrieved_at, r.row_json,
    r.source || '/page-' || lpad(CAST(l.page_no AS VARCHAR), 4, '0') || '.json' AS raw_artifact_key,
    row_number() OVER (PARTITION BY r.source, l.page_no ORDER BY r.event_id) - 1 AS row_no,
    json_extract_string(row_json, '$.series') AS series,
    json_extract_string(row_json, '$.units') AS units,
    json_extract_string(row_json, '$.period') AS period,
    json_extract_string(row_json, '$.value') AS value, json_type(row_json, '$.value') AS kind
  FROM raw_rows r JOIN laid l ON l.source = r.source AND l.page_no = r.event_id // 500),
parsed AS (
  SELECT *, CASE WHEN regexp_full_match(period, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
      THEN try_cast(period AS DATE)
      WHEN regexp_full_match(period, '[0-9]{8}')
      THEN try_cast(left(period, 4) || '-' || substr(period, 5, 2) || '-' || right(period, 2) AS DATE)
      END AS day,
    CASE WHEN series NOT IN ('RWTC','RBRTE','RCLC1','RCLC2','RCLC3','RCLC4')
        THEN 'unknown series ''' || series || ''''
      WHEN units <> '$/BBL' THEN 'unit ''' || units || ''', expected ''$/BBL'''
      WHEN period = '2024-13-01' OR length(period) = 7 THEN 'unparseable period ''' || period || ''''
      WHEN length(period) <> 10 THEN 'period is not a daily date: ''' || period || ''''
      WHEN kind IS NULL OR kind IN ('NULL', 'BOOLEAN') THEN 'missing or non-numeric value'
      WHEN kind = 'ARRAY' THEN 'unsupported value type list'
      WHEN kind = 'OBJECT' THEN 'unsupported value type dict'
      WHEN kind = 'DOUBLE' THEN 'unsupported value type float'
      WHEN NOT regexp_full_match(value, '-?(0|[1-9][0-9]*)([.][0-9]+)?')
        THEN 'malformed numeric string ''' || value || ''''
      WHEN length(split_part(value, '.', 2)) > 6 THEN 'more than 6 decimal places: ''' || value || ''''
      WHEN length(split_part(value, '.', 1)) > 12 THEN '''' || value || ''' exceeds Decimal(18, 6)'
      END AS reason
  FROM page_rows),
good AS (
  SELECT source, series AS series_id, day AS observation_date, CAST(value AS DECIMAL(18,6)) AS price,
    retrieved_at, raw_artifact_key, page_no, row_no FROM parsed WHERE reason IS NULL),
clean AS (
  SELECT source, series_id, observation_date FROM good GROUP BY ALL
  HAVING count(DISTINCT price) = 1),
silver AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT g.*, row_number() OVER (PARTITION BY g.source, g.series_id, g.observation_date
      ORDER BY page_no, row_no) AS nth
    FROM good g JOIN clean USING (source, series_id, observation_date)) WHERE nth = 1),
rejected AS (
  SELECT source, raw_artifact_key, reason, row_json AS row FROM parsed WHERE reason IS NOT NULL
  UNION ALL
  SELECT source, raw_artifact_key, 'conflicting duplicate in batch',
    series_id || ' ' || observation_date
  FROM good g ANTI JOIN clean USING (source, series_id, observation_date)),
requests AS (
  SELECT 'U' || user_id AS source, min(CAST(day AS DATE)) AS start_, max(CAST(day AS DATE)) AS end_
  FROM keyed GROUP BY ALL),
wanted AS (
  SELECT r.*, s.series_id,
    CASE WHEN s.series_id = 'RCLC3' THEN least(end_, DATE '2024-01-15')
      WHEN s.series_id LIKE 'RCLC%' THEN least(end_, DATE '2024-04-05') ELSE end_ END AS until_
  FROM requests r, (VALUES ('RWTC'), ('RBRTE'), ('RCLC1'), ('RCLC2'), ('RCLC3')) s(series_id)),
in_window AS (
  SELECT w.source, w.series_id, o.observation_date FROM wanted w JOIN silver o
    ON o.source = w.source AND o.series_id = w.series_id
    AND o.observation_date BETWEEN w.start_ AND w.end_),
evidence AS (
  SELECT DISTINCT w.source, w.series_id, o.observation_date FROM wanted w JOIN in_window o
    ON o.source = w.source AND o.series_id <> w.series_id AND o.observation_date <= w.until_),
judged AS (
  SELECT w.source, w.series_id,
    (SELECT count(*) FROM in_window i WHERE i.source = w.source AND i.series_id = w.series_id)
      AS own_days,
    (SELECT count(*) FROM evidence e WHERE e.source = w.source AND e.series_id = w.series_id)
      AS evidence,
    (SELECT count(*) FROM evidence e ANTI JOIN in_window i USING (source, series_id, observation_date)
      WHERE e.source = w.source AND e.series_id = w.series_id) AS missing
  FROM wanted w)
"""
ALERTS = EVENTS + """,
monitored AS (
  SELECT event_id AS dataset_version, 'U' || user_id AS curve_id,
    CASE event_type WHEN 'view' THEN 'Spot' WHEN 'click' THEN 'C1' WHEN 'purchase' THEN 'C2'
      WHEN 'signup' THEN 'C3' ELSE 'C4' END AS position, CAST(ts AS DATE) AS as_of_date,
    CASE WHEN k >= 10 THEN CAST(txt AS DECIMAL(18,4)) END AS price,
    CASE WHEN k >= 10 THEN 'ok' ELSE 'gap' END AS status
  FROM keyed),
per_key AS (
  SELECT user_id, event_type, min(CAST(txt AS DECIMAL(18,4))) AS low,
    max(CAST(txt AS DECIMAL(18,4))) AS high, min(event_id) AS first_, min(ts) AS created_at
  FROM keyed GROUP BY ALL),
rules AS (
  SELECT user_id || '-' || event_type || '-half' AS rule_id, 'U' || user_id AS curve_id,
    CASE event_type WHEN 'view' THEN 'Spot' WHEN 'click' THEN 'C1' WHEN 'purchase' THEN 'C2'
      WHEN 'signup' THEN 'C3' ELSE 'C4' END AS position,
    CAST((low + high) * 0.5 AS DECIMAL(18,4)) AS threshold, first_ AS baseline_version, created_at
  FROM per_key
  UNION ALL
  SELECT user_id || '-' || event_type || '-quarter', 'U' || user_id,
    CASE event_type WHEN 'view' THEN 'Spot' WHEN 'click' THEN 'C1' WHEN 'purchase' THEN 'C2'
      WHEN 'signup' THEN 'C3' ELSE 'C4' END,
    CAST((low * 3 + high) * 0.25 AS DECIMAL(18,4)), 0, created_at
  FROM per_key),
stepped AS (
  SELECT r.rule_id, r.threshold, r.created_at, r.baseline_version, m.*,
    last_value(m.price IGNORE NULLS) OVER (PARTITION BY r.rule_id ORDER BY m.dataset_version
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_price
  FROM rules r JOIN monitored m ON m.curve_id = r.curve_id AND m.position = r.position
    AND m.dataset_version >= r.baseline_version),
digests AS (
  SELECT rule_id, dataset_version, curve_id, position, as_of_date AS as_of, price, previous_price,
    threshold, created_at,
    sha1(unhex('0b6f3f1e9c2d4a518e7b3d2a6c1f5e90') || encode(rule_id || ':' || dataset_version)) AS h
  FROM stepped
  WHERE price > threshold AND previous_price <= threshold AND dataset_version > baseline_version),
fired AS (
  SELECT *, left(h, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
      || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3)
      || '-' || substr(h, 21, 12) AS alert_id
  FROM digests),
log AS (
  SELECT *, row_number() OVER (ORDER BY dataset_version, created_at, rule_id) AS seq FROM fired)
"""
RUNS = """
attempts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS attempt_id, 'in-' || o_custkey AS logical_input_id,
    CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'published' ELSE 'quarantined' END
      AS status, o_orderkey AS dataset_version,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS error, o_orderdate AS finished_at
  FROM orders),
outbox AS (
  SELECT 'ev-' || o_orderkey AS event_id, 'dataset_imported' AS event_type,
    o_orderkey AS dataset_version, CASE o_orderpriority WHEN '1-URGENT' THEN 'pending'
      WHEN '5-LOW' THEN 'dead' ELSE 'done' END AS status,
    CAST(left(o_orderpriority, 1) AS BIGINT) AS attempts, o_orderpriority AS last_error,
    o_orderdate AS processed_at
  FROM orders WHERE o_orderstatus <> 'P')
"""
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def day(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {name or column}"


def number(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column}"


def stamp(column: str, name: str | None = None) -> str:
    return f"strftime({column}, {STAMP}) AS {name or column}"


SEEN = day("observation_date")
ORACLES = {
    # --- seasonal shape
    "seasonal_shape": f"""WITH {PAIRS}
        SELECT position, month, round(s, 10) AS s, n_obs FROM stats""",
    "shape_exclusions": f"""WITH {PAIRS}
        SELECT source, {SEEN}, position, CASE WHEN spot <= 0 THEN 'non-positive spot'
          ELSE 'non-positive future' END AS reason FROM pairs WHERE spot <= 0 OR future <= 0""",
    "shape_thin_groups": f"""WITH {PAIRS}
        SELECT position, month, n_obs FROM stats WHERE n_obs < 60""",
    "shape_missing_groups": f"""WITH {PAIRS}
        SELECT position, month FROM grid
        ANTI JOIN (SELECT * FROM stats WHERE position = 'C4') USING (position, month)""",
    "verified_shape": f"""WITH {PAIRS}
        SELECT position, month, 's' AS problem FROM stats WHERE month = 7""",
    "shape_inputs_digest": f"""WITH {CELLS},
        used AS (SELECT source, series_id, strftime(observation_date, '%Y-%m') AS m, observation_date AS d,
            CAST(price AS DECIMAL(18,6)) AS p FROM obs WHERE series_id <> 'RBRTE'),
        months AS (SELECT source, series_id, m, count(*) AS n, sha256(string_agg(
            series_id || ',' || d || ',' || p || chr(10), '' ORDER BY d, p)) AS h FROM used GROUP BY ALL),
        series AS (SELECT source, series_id, sum(n)::BIGINT AS n, sha256(string_agg(
            m || ',' || n || ',' || h || chr(10), '' ORDER BY m)) AS h FROM months GROUP BY ALL),
        sources AS (SELECT source, sum(n)::BIGINT AS n, sha256(string_agg(
            series_id || ',' || n || ',' || h || chr(10), '' ORDER BY series_id)) AS h FROM series GROUP BY ALL)
        SELECT sum(n)::BIGINT AS rows, sha256(string_agg(
            source || ',' || n || ',' || h || chr(10), '' ORDER BY source)) AS digest FROM sources""",
    "compare_shapes": f"""WITH {PAIRS},
        both_ AS (SELECT position, month, a.s AS sa, b.s AS sb, a.n_obs AS na, b.n_obs AS nb
          FROM gold_stats a FULL JOIN stats b USING (position, month))
        SELECT position, month, 'parameter' AS problem FROM both_ WHERE na IS NULL OR nb IS NULL
        UNION ALL SELECT position, month, 'n_obs' FROM both_ WHERE na <> nb
        UNION ALL SELECT position, month, 's' FROM both_ WHERE abs(sa - sb) > 0.05""",
    # --- curves
    "curve_points": f"""WITH {CURVES}
        SELECT source, curve_id, kind, {day('as_of_date')}, position, {number('price')}, status,
          gap_reason, shape_source FROM curves""",
    "latest_complete_curve": f"""WITH {CURVES}
        SELECT source, curve_id, {day('as_of_date')}, position, {number('price')} FROM curves
        WHERE status = 'ok'
        QUALIFY as_of_date = max(as_of_date) OVER (PARTITION BY source, curve_id)""",
    "latest_points": f"""WITH {CURVES},
        newest AS (SELECT *, row_number() OVER (PARTITION BY source, curve_id, position
          ORDER BY as_of_date DESC) AS nth FROM curves)
        SELECT source, curve_id, position, {day('as_of_date')}, {number('price')}, status,
          date_diff('day', as_of_date, DATE '2002-01-01') AS data_age_days
        FROM newest WHERE nth = 1""",
    "latest_curves_grouped": f"""WITH {CURVES},
        newest AS (SELECT *, row_number() OVER (PARTITION BY source, curve_id, position
          ORDER BY as_of_date DESC) AS nth,
          CASE position WHEN 'Spot' THEN 0 ELSE CAST(right(position, 1) AS INTEGER) END AS place
          FROM curves)
        SELECT source, curve_id, kind, {day('max(as_of_date)', 'as_of')},
          date_diff('day', max(as_of_date), DATE '2002-01-01') AS data_age_days,
          string_agg(position || ':' || as_of_date || ':'
            || coalesce(CAST(CAST(price AS DECIMAL(18,4)) AS VARCHAR), 'gap'),
            '|' ORDER BY place) AS points
        FROM newest WHERE nth = 1 GROUP BY source, curve_id, kind""",
    "spread_by_position": f"""WITH {CURVES},
        legs AS (SELECT source, as_of_date, position, any_value(price) FILTER (curve_id = 'BRENT') AS up,
            any_value(price) FILTER (curve_id = 'WTI') AS down
          FROM curves WHERE status = 'ok' AND curve_id IN ('BRENT', 'WTI') GROUP BY ALL)
        SELECT source, {day('as_of_date')}, position, {number('up - down', 'spread')}
        FROM legs WHERE up IS NOT NULL AND down IS NOT NULL""",
    "contango_days": f"""WITH {CURVES},
        days AS (SELECT source, curve_id, as_of_date,
            any_value(price) FILTER (position = 'Spot' AND kind = 'outright') AS near,
            any_value(price) FILTER (position = 'C4') AS away
          FROM curves WHERE status = 'ok' GROUP BY ALL)
        SELECT source, curve_id, count_if(away > near)::BIGINT AS contango_days,
          count_if(away < near)::BIGINT AS backwardation_days
        FROM days WHERE near IS NOT NULL AND away IS NOT NULL GROUP BY ALL""",
    "contango_days_all_sources": f"""WITH {CURVES},
        days AS (SELECT source, curve_id, as_of_date,
            any_value(price) FILTER (position = 'Spot' AND kind = 'outright') AS near,
            any_value(price) FILTER (position = 'C4') AS away
          FROM curves WHERE status = 'ok' GROUP BY ALL)
        SELECT curve_id, count_if(away > near)::BIGINT AS contango_days,
          count_if(away < near)::BIGINT AS backwardation_days
        FROM days WHERE near IS NOT NULL AND away IS NOT NULL GROUP BY ALL""",
    "month_percent_rank": f"""WITH {CURVES}
        SELECT source, curve_id, position, {day('as_of_date')}, {number('price')},
          round(percent_rank() OVER (PARTITION BY source, curve_id, position,
            strftime(as_of_date, '%Y-%m') ORDER BY price), 9) AS month_percent_rank
        FROM curves WHERE curve_id = 'WTI' AND status = 'ok'""",
    "curve_history": f"""WITH {CURVES}
        SELECT source, {day('as_of_date', 'as_of')}, {number('price')}, status, gap_reason,
          'modelled' AS estimate_type
        FROM curves WHERE curve_id = 'BRENT_WTI' AND position = 'C2'
          AND as_of_date >= DATE '1996-01-01'""",
    "price_history": f"""WITH {CELLS}
        SELECT source, {day('observation_date', 'date')}, {number('price')}, '$/BBL' AS unit,
          {stamp('retrieved_at', 'last_seen_at')}
        FROM obs WHERE series_id = 'RBRTE' AND observation_date <= DATE '2000-12-31'""",
    "curve_rule_violations": f"""WITH {ALERTS}
        SELECT dataset_version, 'gap' AS status, {number('price')} FROM monitored
        WHERE price < 1 AND status = 'ok'""",
    "monitored_values": f"""WITH {CURVES},
        newest AS (SELECT *, row_number() OVER (PARTITION BY source, curve_id, position
          ORDER BY as_of_date DESC) AS nth FROM curves)
        SELECT source, CAST(7 AS BIGINT) AS dataset_version, curve_id, position,
          {day('as_of_date')}, {number('price')}, status FROM newest WHERE nth = 1""",
    # --- merge
    "merge_current": f"""WITH {MERGE}
        SELECT source, series_id, {SEEN},
          {number("CASE WHEN kind IN ('inserted','revised') THEN new_price ELSE old_price END", 'price')},
          CASE WHEN kind IN ('inserted','revised') THEN 'second' ELSE 'first' END AS logical_input_id,
          {stamp("CASE WHEN kind IN ('inserted','revised') THEN new_at ELSE old_at END", 'retrieved_at')},
          {stamp("CASE WHEN kind IN ('inserted','revised','seen') THEN new_at ELSE last_seen_at END",
                 'last_seen_at')}
        FROM merged""",
    "merge_superseded": f"""WITH {MERGE}
        SELECT source, series_id, {SEEN}, {number('old_price', 'price')}, {stamp('last_seen_at')},
          CAST(7 AS BIGINT) AS superseded_at_version, 'second' AS superseded_by_logical_input_id
        FROM merged WHERE kind = 'revised'""",
    "merge_stats": f"""WITH {MERGE}
        SELECT source, count(*) FILTER (kind = 'inserted') AS inserted,
          count(*) FILTER (kind = 'revised') AS revised,
          count(*) FILTER (kind = 'unchanged') AS unchanged,
          count(*) FILTER (kind = 'stale') AS stale, count(*) FILTER (kind = 'seen') AS seen,
          count(*) FILTER (kind IN ('inserted','revised')) AS price_changes,
          count(*) FILTER (kind IN ('inserted','revised','seen')) > 0 AS state_changed
        FROM merged GROUP BY source""",
    "stale_notes": f"""WITH {MERGE}
        SELECT source, series_id, {SEEN}, series_id || ' ' || observation_date || ': retrieval '
          || strftime(new_at, '%Y-%m-%d %H:%M:%S') || ' is not later than last seen '
          || strftime(last_seen_at, '%Y-%m-%d %H:%M:%S') || '; kept current value' AS note
        FROM merged WHERE kind = 'stale'""",
    "revisions_per_month": f"""WITH {MERGE}
        SELECT strftime(observation_date, '%Y-%m') AS month, series_id, count(*) AS revisions
        FROM merged WHERE kind = 'revised' GROUP BY ALL""",
    "legacy_gold_conformed": f"""WITH {CELLS}
        SELECT source, series_id, {SEEN}, {stamp('retrieved_at')},
          {stamp('retrieved_at', 'last_seen_at')} FROM gold""",
    # --- pages, parsing, quality
    "parsed_rows": f"""WITH {PAGES}
        SELECT source, CAST(page_no AS BIGINT) AS page_no, row_no, series AS series_id, {day('day', 'observation_date')},
          CASE WHEN reason IS NULL THEN CAST(value AS DOUBLE) END AS price, reason FROM parsed""",
    "silver_observations": f"""WITH {PAGES}
        SELECT source, series_id, {SEEN}, {number('price')}, '$/BBL' AS unit,
          price <= 0 AS non_positive, {stamp('retrieved_at')}, 'run-1' AS logical_input_id,
          raw_artifact_key FROM silver""",
    "silver_rejected": f"""WITH {PAGES}
        SELECT source, raw_artifact_key, reason, row FROM rejected""",
    "rejection_counts": f"""WITH {PAGES}
        SELECT reason, count(*) AS rows FROM rejected GROUP BY reason""",
    "completeness": f"""WITH {PAGES}
        SELECT source, source AS request_id, series_id, own_days, evidence, missing FROM judged""",
    "completeness_issues": f"""WITH {PAGES}
        SELECT source, source AS request_id, series_id || ': no rows on ' || missing || ' of '
          || evidence || ' dates with data from other requested series' AS message
        FROM judged WHERE evidence > 0 AND (missing > greatest(3, 0.1 * evidence)
          OR (own_days = 0 AND evidence >= 3))""",
    "last_observations": f"""WITH {PAGES},
        newest AS (SELECT source, series_id, max(observation_date) AS last FROM silver GROUP BY ALL),
        lagged AS (SELECT w.source, w.series_id, n.last, CASE WHEN n.last IS NOT NULL THEN
            (SELECT count(*) FROM range(0, 400) r(i) WHERE n.last + CAST(r.i + 1 AS INTEGER) <= w.until_
              AND isodow(n.last + CAST(r.i + 1 AS INTEGER)) < 6) END AS lag
          FROM wanted w LEFT JOIN newest n ON n.source = w.source AND n.series_id = w.series_id)
        SELECT source, series_id, {day('last')}, lag,
          CASE WHEN last IS NULL THEN series_id || ': no observations yet' WHEN lag > 5
            THEN series_id || ': last observation ' || last || ', ' || lag || ' business days old'
            END AS warning
        FROM lagged""",
    "page_reconciliation": f"""WITH {PAGES},
        sums AS (SELECT source, min(total) AS low, max(total) AS high, sum(total) AS rows
          FROM laid GROUP BY source)
        SELECT source AS request_id, 'total changed' AS kind, low || ' -> ' || high AS detail
        FROM sums WHERE low <> high
        UNION ALL
        SELECT source, 'row count', 'received ' || rows || ' rows, API reported ' || low
        FROM sums WHERE low = high AND rows <> low
        UNION ALL
        SELECT source, 'repeated row', series || ' ' || period || ' on pages ' || min(page_no)
          || ' and ' || max(page_no)
        FROM page_rows GROUP BY source, series, period HAVING count(*) > 1""",
    "page_shape_errors": """
        SELECT 'E' || event_id AS request_id, CAST(1 AS BIGINT) AS page_no,
          'response.total is not an integer' AS detail FROM events
        UNION ALL SELECT 'Q' || event_id, 1, 'response.data is not a list' FROM events
        UNION ALL SELECT 'P' || page_id, 1, 'the body is not JSON' FROM pages""",
    "redacted_page_hashes": f"""WITH {PAGES}
        SELECT source AS request_id, CAST(page_no AS BIGINT) AS page_no, sha256(replace(body, 'k-0000', 'REDACTED')) AS sha256
        FROM laid""",
    "staged_page_differences": f"""WITH {PAGES}
        SELECT source AS request_id, CAST(page_no AS BIGINT) AS page_no, sha256(body) AS staged_sha256,
          sha256(replace(body, 'k-0000', 'REDACTED')) AS actual_sha256 FROM laid""",
    # --- alerts
    "alert_crossings": f"""WITH {ALERTS}
        SELECT alert_id, rule_id, dataset_version, curve_id, position, {day('as_of')},
          {number('price')}, {number('previous_price')}, {number('threshold')} FROM fired""",
    "alert_log": f"""WITH {ALERTS}
        SELECT seq + 1000 AS seq, alert_id, rule_id, dataset_version, {number('price')},
          {number('previous_price')} FROM log""",
    "alerts_after_cursor": f"""WITH {ALERTS}
        SELECT seq, alert_id FROM log WHERE seq > 25 ORDER BY seq LIMIT 50""",
    "latest_alerts": f"""WITH {ALERTS}
        SELECT seq, alert_id FROM log ORDER BY seq DESC LIMIT 50""",
    "rule_baseline": f"""WITH {ALERTS},
        newest AS (SELECT *, row_number() OVER (PARTITION BY curve_id, position
          ORDER BY dataset_version DESC) AS nth FROM monitored)
        SELECT rule_id, CAST(7 AS BIGINT) AS baseline_version, n.price <= r.threshold AS armed,
          {number('n.price', 'last_value')},
          CASE WHEN n.price IS NOT NULL THEN CAST(n.as_of_date AS VARCHAR) END AS last_as_of,
          CASE WHEN n.price IS NOT NULL THEN CAST(7 AS BIGINT) END AS last_version
        FROM rules r LEFT JOIN newest n ON n.curve_id = r.curve_id AND n.position = r.position
          AND n.nth = 1""",
    "parsed_thresholds": """WITH written AS (
          SELECT l_orderkey, l_linenumber,
            CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS txt,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem)
        SELECT CAST(form AS BIGINT) AS form, count(*) AS texts, count(v) AS valid, CAST(min(v) AS DOUBLE) AS low,
          CAST(max(v) AS DOUBLE) AS high
        FROM (
          SELECT 0 AS form, v FROM written UNION ALL SELECT 1, -v FROM written
          UNION ALL SELECT 2, NULL FROM written UNION ALL SELECT 3, v FROM written
          UNION ALL SELECT 4, v FROM written UNION ALL SELECT 5, v * 100 FROM written
          UNION ALL SELECT 6, NULL FROM written UNION ALL SELECT 7, NULL FROM written
          UNION ALL SELECT 8, CAST(l_linenumber AS DECIMAL(18,4)) / 10 FROM written)
        GROUP BY form""",
    # --- run records and checks
    "attempt_status_counts": f"""WITH {RUNS}
        SELECT status, count(*) AS records FROM attempts GROUP BY status""",
    "outbox_status_counts": f"""WITH {RUNS}
        SELECT status, count(*) AS records FROM outbox GROUP BY status""",
    "problem_attempts": f"""WITH {RUNS}
        SELECT attempt_id, status, error, {stamp('finished_at')} FROM (SELECT * FROM attempts
          WHERE status IN ('failed', 'quarantined') ORDER BY finished_at DESC, attempt_id LIMIT 100)
        """,
    "dead_events": f"""WITH {RUNS}
        SELECT event_id, event_type, dataset_version, attempts, last_error, {stamp('processed_at')}
        FROM (SELECT * FROM outbox WHERE status = 'dead'
          ORDER BY dataset_version, event_id LIMIT 100)""",
    "health_page": f"""WITH {RUNS},
        bad AS (SELECT * FROM attempts WHERE status IN ('failed', 'quarantined')
          ORDER BY finished_at DESC, attempt_id LIMIT 100),
        gone AS (SELECT * FROM outbox WHERE status = 'dead' ORDER BY dataset_version, event_id LIMIT 100)
        SELECT 'versions' AS part, CAST(dataset_version AS VARCHAR) AS item, 'orders' AS value
        FROM attempts WHERE status = 'published'
        UNION ALL SELECT 'attempt_counts', status, CAST(count(*) AS VARCHAR) FROM attempts GROUP BY status
        UNION ALL SELECT 'problem_attempts', attempt_id, status FROM bad
        UNION ALL SELECT 'outbox_counts', status, CAST(count(*) AS VARCHAR) FROM outbox GROUP BY status
        UNION ALL SELECT 'dead_events', event_id, last_error FROM gone""",
    "current_version": f"""WITH {RUNS}
        SELECT dataset_version, logical_input_id, sha256(attempt_id) AS manifest_sha256,
          'orders' AS source, {stamp('finished_at', 'created_at')}
        FROM attempts WHERE status = 'published' ORDER BY dataset_version DESC LIMIT 1""",
    "unmatched_versions": f"""WITH {RUNS}
        SELECT dataset_version, 'version without event' AS problem FROM attempts
        WHERE status = 'published' AND dataset_version NOT IN (SELECT dataset_version FROM outbox)
        UNION ALL SELECT dataset_version, 'event without version' FROM outbox
        WHERE dataset_version NOT IN
          (SELECT dataset_version FROM attempts WHERE status = 'published')""",
    "staging_key_counts": """
        SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys
        FROM lineitem""",
    "staging_violations": """
        WITH c AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS d FROM lineitem)
        SELECT 'lineitem' AS "table", 'lineitem: staged ' || n || ' rows, manifest says 1' AS problem
        FROM c WHERE n <> 1
        UNION ALL SELECT 'lineitem', 'lineitem: ' || (n - d) || ' duplicate keys' FROM c WHERE n <> d""",
    "repeated_keys": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "unseen_attempts": f"""WITH {RUNS}
        SELECT attempt_id, status FROM attempts WHERE status = 'failed'""",
    # --- expressions
    "business_day_lags": """
        WITH spans AS (SELECT CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
        days AS (SELECT d, count(*) FILTER (isodow(d) < 6) OVER (ORDER BY d) AS n
          FROM (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2010-01-01',
            INTERVAL 1 DAY)) AS DATE) AS d))
        SELECT greatest(0, y.n - x.n) AS lag, count(*) AS lines
        FROM spans JOIN days x ON x.d = a JOIN days y ON y.d = b GROUP BY ALL""",
    "backoff_delays": f"""WITH {RUNS}
        SELECT attempts, least(900.0::DOUBLE, 5.0::DOUBLE * pow(2, greatest(0, attempts * 3 - 1))) AS delay_s,
          count(*) AS events FROM outbox GROUP BY ALL""",
    "half_even_prices": f"""WITH {CELLS}
        SELECT source, CAST(sum(round_even(price, 4)) AS DOUBLE) AS four,
          CAST(sum(round_even(price, 2)) AS DOUBLE) AS two FROM obs GROUP BY source""",
    "synthetic_prices": """
        WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
        noise AS (SELECT d, s AS series_id,
            CAST(('0x' || left(sha256(s || '|' || d), 16))::UBIGINT AS DOUBLE)
              / 9223372036854775808.0 - 1.0 AS u
          FROM days, (VALUES ('RWTC'),('RBRTE'),('RCLC1'),('RCLC2'),('RCLC3'),('RCLC4')) v(s)
          WHERE isodow(d) < 6),
        wti AS (SELECT d, 70 + 15 * sin(date_diff('day', DATE '2000-01-01', d) / 200.0)
            + 1.5 * u AS w FROM noise WHERE series_id = 'RWTC'),
        priced AS (SELECT n.d, n.series_id, CASE series_id
            WHEN 'RWTC' THEN w WHEN 'RBRTE' THEN w + 4 + 0.8 * u
            ELSE abs(w) * exp(0.004 * k + 0.003 * k * cos(2 * pi() * month(n.d) / 12))
              * (1 + 0.002 * u) END AS p
          FROM (SELECT *, try_cast(right(series_id, 1) AS INTEGER) AS k FROM noise) n
          JOIN wti ON wti.d = n.d)
        SELECT series_id, CAST(d AS VARCHAR) AS observation_date, round(p, 2) AS price FROM priced""",
    "params_digest": f"""WITH {CELLS},
        counted AS (SELECT series_id, count(*) AS n FROM obs GROUP BY series_id)
        SELECT count(*) AS rows,
          sha256(string_agg(series_id || ',' || n || chr(10), '' ORDER BY series_id)) AS digest
        FROM counted""",
}
ORACLES["synthetic_overrides"] = (
    ORACLES.pop("synthetic_prices").rsplit("SELECT series_id, CAST(d", 1)[0].rstrip()
    + """,
        per_day AS (SELECT CAST(o_orderdate AS DATE) AS d,
            max(CAST(o_totalprice AS DECIMAL(18,2))) AS top, min(o_orderstatus) AS status
          FROM orders GROUP BY ALL),
        merged AS (
          SELECT series_id, d, round(p, 2) AS price FROM priced WHERE series_id IN ('RWTC', 'RBRTE')
            AND NOT (series_id = 'RWTC' AND d IN (SELECT d FROM per_day WHERE top > 450000))
          UNION ALL SELECT 'RWTC', d, CAST(top AS DOUBLE) FROM per_day WHERE top > 450000)
        SELECT series_id, CAST(d AS VARCHAR) AS observation_date, price FROM merged
        WHERE NOT (series_id = 'RWTC' AND d IN (SELECT d FROM per_day WHERE status = 'P'))"""
)

STORE = CELLS + """,
fetched AS (
  SELECT l_linestatus, series_id, observation_date, max(price) AS price FROM cells GROUP BY ALL),
stored AS (
  SELECT coalesce(n.series_id, o.series_id) AS series_id,
    coalesce(n.observation_date, o.observation_date) AS observation_date,
    coalesce(n.price, o.price) AS price, o.price AS old_price, n.price AS new_price
  FROM (SELECT * FROM fetched WHERE l_linestatus = 'F') o
  FULL JOIN (SELECT * FROM fetched WHERE l_linestatus = 'O') n
    ON n.series_id = o.series_id AND n.observation_date = o.observation_date),
timed AS (
  SELECT *, CASE WHEN new_price IS NULL OR new_price = old_price THEN '2003-01-01'
      ELSE '2003-01-02' END || ' 00:00:00.000000' AS retrieved_at,
    CASE WHEN new_price IS NULL THEN '2003-01-01' ELSE '2003-01-02' END
      || ' 00:00:00.000000' AS last_seen_at
  FROM stored),
""" + CURVES[len(CELLS):].lstrip(",\n").replace(
    "FROM obs", "FROM tagged").replace("JOIN obs", "JOIN tagged").replace(
    "factors AS", """tagged AS (
  SELECT 'lineitem' AS source, series_id, observation_date, price FROM stored),
factors AS""", 1)
HISTORY = """
history AS (
  SELECT as_of_date, CAST(as_of_date AS VARCHAR) || ',' || coalesce(CAST(price AS VARCHAR), '')
    || ',' || status || ',' || CASE WHEN gap_reason IS NULL THEN '' ELSE gap_reason END AS line
  FROM curves WHERE curve_id = 'WTI' AND position = 'C1')
"""
RECORDS = """
judged AS (
  SELECT o_custkey, o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN 'is no JSON object'
    ELSE CASE left(o_orderpriority, 1) WHEN '1' THEN 'has a run_id that is not the name of its run'
      WHEN '2' THEN 'has a rows that is not 48' WHEN '3' THEN 'has a params_sha256 that is not a hash' END END AS problem
  FROM orders)
"""
ORACLES |= {
    "published_observations": f"""WITH {STORE}
        SELECT 'lineitem' AS source, series_id, {SEEN}, {number('price')}, '$/BBL' AS unit,
          price <= 0 AS non_positive, retrieved_at, last_seen_at FROM timed""",
    "published_first_version": f"""WITH {STORE}
        SELECT 'lineitem' AS source, series_id, {SEEN}, {number('price')} FROM fetched
        WHERE l_linestatus = 'F'""",
    "published_revisions": f"""WITH {STORE}
        SELECT 'lineitem' AS source, series_id, {SEEN}, {number('old_price', 'price')},
          CAST(2 AS BIGINT) AS superseded_at_version
        FROM stored WHERE new_price <> old_price""",
    "published_curves": f"""WITH {STORE}
        SELECT curve_id, kind, {day('as_of_date')}, position, {number('price')}, status, gap_reason
        FROM curves""",
    "published_versions": """
        SELECT CAST(dense_rank() OVER (ORDER BY l_linestatus) AS BIGINT) AS dataset_version
        FROM (SELECT DISTINCT l_linestatus FROM lineitem)""",
    "imported_versions": f"""WITH {STORE},
        first_anchors AS (SELECT DISTINCT observation_date FROM fetched
          WHERE l_linestatus = 'F' AND series_id IN ('RWTC', 'RBRTE')),
        anchors AS (SELECT DISTINCT observation_date FROM stored
          WHERE series_id IN ('RWTC', 'RBRTE'))
        SELECT CAST(1 AS BIGINT) AS dataset_version, 'lineitem' AS source,
          (SELECT count(*) FROM fetched WHERE l_linestatus = 'F') AS observations,
          CAST(0 AS BIGINT) AS revisions,
          (SELECT count(*) * 15 FROM first_anchors) AS curve_points,
          (SELECT count(*) FROM fetched WHERE l_linestatus = 'F') AS price_changes
        UNION ALL
        SELECT 2, 'lineitem', (SELECT count(*) FROM stored),
          (SELECT count(*) FROM stored WHERE new_price <> old_price),
          (SELECT count(*) * 15 FROM anchors),
          (SELECT count(*) FROM stored WHERE new_price IS NOT NULL
            AND (old_price IS NULL OR new_price <> old_price))""",
    "monitored_of_version": f"""WITH {STORE},
        newest AS (SELECT *, row_number() OVER (PARTITION BY curve_id, position
          ORDER BY as_of_date DESC) AS nth FROM curves)
        SELECT CAST(2 AS BIGINT) AS dataset_version, curve_id, position, {day('as_of_date')},
          {number('price')}, status FROM newest WHERE nth = 1""",
    "synced_attempts": """
        SELECT 'published' AS status, count(DISTINCT l_linestatus) AS records FROM lineitem""",
    "warehouse_load_log": f"""WITH {STORE},
        counts AS (
          SELECT 'shape_params' AS table_name, count(*) AS rows FROM factors WHERE position <> 'Spot'
          UNION ALL SELECT 'observations', count(*) FROM stored
          UNION ALL SELECT 'revisions', count(*) FROM stored WHERE new_price <> old_price
          UNION ALL SELECT 'curve_points', count(*) FROM curves)
        SELECT table_name, rows, rows AS row_count FROM counts""",
    "warehouse_spread_by_position": f"""WITH {STORE},
        legs AS (SELECT as_of_date, position, any_value(price) FILTER (curve_id = 'BRENT') AS up,
            any_value(price) FILTER (curve_id = 'WTI') AS down
          FROM curves WHERE status = 'ok' AND curve_id IN ('BRENT', 'WTI') GROUP BY ALL)
        SELECT {day('as_of_date')}, position, {number('up - down', 'spread')}
        FROM legs WHERE up IS NOT NULL AND down IS NOT NULL""",
    "named_latest_curve": f"""WITH {STORE},
        newest AS (SELECT curve_id, as_of_date, position, price FROM curves WHERE status = 'ok'
          QUALIFY as_of_date = max(as_of_date) OVER (PARTITION BY curve_id))
        SELECT curve_id, {day('as_of_date')}, position, {number('price')},
          row_number() OVER (ORDER BY curve_id, position) AS place FROM newest""",
    "named_spread": f"""WITH {STORE},
        legs AS (SELECT as_of_date, position, any_value(price) FILTER (curve_id = 'BRENT') AS up,
            any_value(price) FILTER (curve_id = 'WTI') AS down
          FROM curves WHERE status = 'ok' AND curve_id IN ('BRENT', 'WTI') GROUP BY ALL)
        SELECT {day('as_of_date')}, position, {number('up - down', 'spread')},
          row_number() OVER (ORDER BY as_of_date, position) AS place
        FROM legs WHERE up IS NOT NULL AND down IS NOT NULL""",
    "named_contango": f"""WITH {STORE},
        days AS (SELECT curve_id, as_of_date,
            any_value(price) FILTER (position = 'Spot' AND kind = 'outright') AS near,
            any_value(price) FILTER (position = 'C2') AS away
          FROM curves WHERE status = 'ok' GROUP BY ALL)
        SELECT curve_id, count_if(away > near)::BIGINT AS contango_days,
          count_if(away < near)::BIGINT AS backwardation_days,
          row_number() OVER (ORDER BY curve_id) AS place
        FROM days WHERE near IS NOT NULL AND away IS NOT NULL GROUP BY curve_id""",
    "named_revisions": f"""WITH {STORE},
        months AS (SELECT strftime(observation_date, '%Y-%m') AS month, series_id, count(*) AS revisions
          FROM stored WHERE old_price <> new_price GROUP BY ALL)
        SELECT *, row_number() OVER (ORDER BY month, series_id) AS place FROM months""",
    "named_percentile": f"""WITH {STORE}
        SELECT curve_id, position, {day('as_of_date')}, {number('price')},
          round(percent_rank() OVER (PARTITION BY curve_id, position, strftime(as_of_date, '%Y-%m')
            ORDER BY price), 9) AS month_percent_rank,
          row_number() OVER (ORDER BY curve_id, position, curves.as_of_date) AS place
        FROM curves WHERE curve_id = 'BRENT' AND status = 'ok'""",
    "exported_history": f"""WITH {STORE}, {HISTORY}
        SELECT '# Modelled estimate, not market quotes.' AS line
        UNION ALL SELECT '# dataset_version=2 source=lineitem dataset_created_at=2003-01-02'
        UNION ALL SELECT 'as_of,price,status,gap_reason'
        UNION ALL SELECT line FROM history""",
    "streamed_observations": f"""WITH {STORE}
        SELECT 'lineitem' AS source, series_id, {SEEN}, {number('price')}, retrieved_at,
          last_seen_at FROM timed""",
    "streamed_crossings": ORACLES["alert_crossings"],
    "newest_update": f"""WITH {RUNS}
        SELECT max(dataset_version) AS dataset_version FROM attempts WHERE status = 'published'""",
    "complete_runs": f"""WITH {RECORDS}
        SELECT problem, count(*) AS records FROM judged GROUP BY problem""",
    "newest_complete_run": f"""WITH {RECORDS}
        SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS run_id FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
            CAST(o_orderkey AS VARCHAR) DESC) AS nth FROM judged WHERE problem IS NULL)
        WHERE nth = 1""",
}
_ISSUES, _LASTS = ORACLES["completeness_issues"], ORACLES["last_observations"]
ORACLES["quality_report"] = f"""
    SELECT 'reason' AS kind, NULL AS subject, reason AS text, rows FROM ({ORACLES["rejection_counts"]})
    UNION ALL SELECT 'last observation', series_id, CAST(last AS VARCHAR), NULL FROM ({_LASTS}) WHERE last IS NOT NULL
    UNION ALL SELECT 'warning', series_id, warning, NULL FROM ({_LASTS}) WHERE warning IS NOT NULL
    UNION ALL SELECT 'incomplete', request_id, message, NULL FROM ({_ISSUES})"""
_PIECES = ", ".join(
    f"sum(CAST(('0x' || substr(h, {at}, {size})) AS UBIGINT)::HUGEINT)" for at, size in
    ((1, 15), (16, 15), (31, 15), (46, 15), (61, 4)))
_STAMP = "strftime(retrieved_at, '%Y-%m-%dT%H:%M:%S.%gZ')"
ORACLES["table_fingerprint"] = f"""WITH {CELLS},
    hashed AS (SELECT series_id, sha256('{{"source":"' || source || '","observation_date":"' || observation_date
      || '","price":' || price || ',"unit":"$/BBL","non_positive":' || (price <= 0) || ',"retrieved_at":"' || {_STAMP}
      || '","logical_input_id":"second","last_seen_at":"' || {_STAMP} || '"}}') AS h FROM obs)
    SELECT series_id, count(*) AS rows, sha256(concat_ws('|', count(*), {_PIECES})) AS digest
    FROM hashed GROUP BY series_id"""
ORACLES["cursor_places"] = """
    WITH back AS (SELECT event_id, CASE WHEN user_id % 5 = 0 OR (user_id % 7 = 0) OR event_id > 700
        THEN 'unknown_cursor' WHEN event_id < 200 THEN 'expired_cursor' END AS reset FROM events)
    SELECT event_id, CASE WHEN reset IS NULL THEN event_id ELSE 700 END AS after, reset FROM back"""
