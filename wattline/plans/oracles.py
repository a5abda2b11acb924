"""The catalogue's queries in plain SQL, for a second engine to check them against."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

EVENTS = """e AS (
  SELECT event_id, user_id, ts, event_type, value,
         CASE WHEN event_type <> 'signup' THEN value END AS reading,
         CASE event_type WHEN 'error' THEN 16 WHEN 'view' THEN 8 ELSE 0 END AS quality_flag,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fault_any
  FROM events)"""

SESSIONS = f"""{EVENTS}, s0 AS (
  SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM e
), s1 AS (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 14401000000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seq FROM s0
), s2 AS (
  SELECT *, count(*) OVER (PARTITION BY user_id, seq) AS n FROM s1
), s AS (
  SELECT * EXCLUDE (gap, n), CASE WHEN n >= 2 THEN printf('%d_%06d', user_id, seq::BIGINT) END AS trip_id FROM s2
)"""

BY_USER = "PARTITION BY user_id ORDER BY ts, event_id"

ORACLES["sessions"] = f"WITH {SESSIONS} SELECT event_id, user_id, trip_id FROM s"

ORACLES["session_summary"] = f"""WITH {SESSIONS}, t AS (
  SELECT user_id, trip_id, min(ts) AS trip_start_ts, max(ts) AS trip_end_ts, count(*) AS rows,
    first(reading ORDER BY ts, event_id) AS soc_start, last(reading ORDER BY ts, event_id) AS soc_end,
    sum(fault_any)::BIGINT AS fault_seconds, max(value) AS value_max, sum(coalesce(reading, 0)) / 3600 AS kwh
  FROM s WHERE trip_id IS NOT NULL GROUP BY user_id, trip_id HAVING count(*) >= 3)
SELECT user_id, trip_id, trip_start_ts, trip_end_ts, rows, round(soc_start, 6) AS soc_start,
  round(soc_end, 6) AS soc_end, fault_seconds, round(value_max, 6) AS value_max, round(kwh, 6) AS energy_kwh_proxy,
  (epoch_us(trip_end_ts) - epoch_us(trip_start_ts)) // 1000000 AS duration_s,
  round(soc_end - soc_start, 6) AS soc_delta FROM t"""

ORACLES["session_totals"] = f"""WITH {SESSIONS}
SELECT user_id, count(DISTINCT trip_id) AS trips, count(DISTINCT value) AS "values" FROM s GROUP BY user_id"""

FILES = f"""{EVENTS}, h AS (
  SELECT strftime(ts, '%Y-%m-%d') AS dt, user_id::VARCHAR AS vehicle_id, date_trunc('hour', ts)::TIMESTAMP AS hour,
    bit_or(quality_flag) AS flag, avg(fault_any) AS fault_share, avg(reading) AS reading
  FROM e GROUP BY ALL
), g AS (
  SELECT dt, vehicle_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
  FROM (SELECT dt, vehicle_id, min(hour) AS lo, max(hour) AS hi FROM h GROUP BY ALL)
), j AS (
  SELECT g.dt, g.vehicle_id, g.ts, h.hour IS NOT NULL AS present, h.flag, h.fault_share, h.reading FROM g
  LEFT JOIN h ON g.dt = h.dt AND g.vehicle_id = h.vehicle_id AND g.ts = h.hour
), p AS (
  SELECT *, max(CASE WHEN present THEN ts END) OVER (PARTITION BY dt, vehicle_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM j
), q AS (
  SELECT *, sum(CASE WHEN present AND (prev IS NULL OR ts - prev >= INTERVAL 5 HOUR) THEN 1 ELSE 0 END)
    OVER (PARTITION BY dt, vehicle_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM p
), r AS (
  SELECT *, CASE WHEN present OR ts - prev <= INTERVAL 3 HOUR THEN run END AS seq FROM q
), ses AS (
  SELECT dt, vehicle_id, seq, count(*) >= 2 AS open FROM r WHERE seq IS NOT NULL GROUP BY ALL
), fil AS (
  SELECT dt, vehicle_id, max(seq) AS n, arg_max(open, seq) AS last_open FROM ses GROUP BY ALL
), fil2 AS (
  SELECT *, CASE WHEN coalesce(lag(last_open) OVER (PARTITION BY vehicle_id ORDER BY dt), false) THEN 1 ELSE 0 END
    AS cont FROM fil
), fil3 AS (
  SELECT *, coalesce(sum(n - cont) OVER (PARTITION BY vehicle_id ORDER BY dt
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - cont AS base FROM fil2
), silver AS (
  SELECT r.dt, r.vehicle_id, r.ts, r.present, r.reading, r.fault_share, r.seq + f.base AS number, s.open,
    CASE WHEN s.open THEN printf('%s_%06d', r.vehicle_id, (r.seq + f.base)::BIGINT) END AS trip_id, r.flag
  FROM r JOIN fil3 f ON r.dt = f.dt AND r.vehicle_id = f.vehicle_id
  LEFT JOIN ses s ON r.dt = s.dt AND r.vehicle_id = s.vehicle_id AND r.seq = s.seq
)"""

ORACLES["trips_across_files"] = f"""WITH {FILES}
SELECT dt, vehicle_id, ts AS "timestamp", trip_id FROM silver"""

ORACLES["trip_state"] = f"""WITH {FILES}, starts AS (
  SELECT vehicle_id, number, min(ts) AS start FROM silver WHERE number IS NOT NULL GROUP BY ALL
), lasts AS (
  SELECT vehicle_id, max(dt) AS dt, arg_max(base + n, dt) AS seq, arg_max(last_open, dt) AS open FROM fil3 GROUP BY vehicle_id
), ends AS (SELECT vehicle_id, max(ts) AS last_ts FROM silver WHERE number IS NOT NULL GROUP BY vehicle_id)
SELECT l.vehicle_id, l.seq::BIGINT AS trip_seq,
  CASE WHEN l.open THEN printf('%s_%06d', l.vehicle_id, l.seq::BIGINT) END AS open_trip_id,
  CASE WHEN l.open THEN s.start END AS open_trip_start_ts, ends.last_ts, l.dt
FROM lasts l JOIN starts s ON l.vehicle_id = s.vehicle_id AND l.seq = s.number
JOIN ends ON ends.vehicle_id = l.vehicle_id"""

ORACLES["trip_state_by_day"] = f"""WITH {FILES}, starts AS (
  SELECT vehicle_id, number, min(ts) AS start FROM silver WHERE number IS NOT NULL GROUP BY ALL
), ends AS (SELECT dt, vehicle_id, max(ts) AS last_ts FROM silver GROUP BY ALL)
SELECT f.vehicle_id, (f.base + f.n)::BIGINT AS trip_seq,
  CASE WHEN f.last_open THEN printf('%s_%06d', f.vehicle_id, (f.base + f.n)::BIGINT) END AS open_trip_id,
  CASE WHEN f.last_open THEN s.start END AS open_trip_start_ts, e.last_ts, f.dt, f.dt AS as_of
FROM fil3 f JOIN starts s ON f.vehicle_id = s.vehicle_id AND f.base + f.n = s.number
JOIN ends e ON e.vehicle_id = f.vehicle_id AND e.dt = f.dt"""


def _spans(source: str, gap_us: int, having: str) -> str:
    return f"""a AS (
  SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER ({BY_USER}) AS gap FROM {source}
), b AS (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap > {gap_us} THEN 1 ELSE 0 END)
    OVER ({BY_USER} ROWS UNBOUNDED PRECEDING) AS span FROM a
) SELECT user_id, span::BIGINT AS span, min(ts) AS span_start, max(ts) AS span_end, count(*) AS rows
FROM b GROUP BY user_id, span {having}"""


ORACLES["span_cluster"] = f"WITH {EVENTS}, f AS (SELECT * FROM e WHERE fault_any = 1), " + _spans("f", 86400000000, "")
ORACLES["rising_spans"] = (
    f"WITH {EVENTS}, u AS (SELECT *, value - lag(value) OVER ({BY_USER}) AS rise FROM e), "
    "f AS (SELECT * FROM u WHERE rise > 0.05), " + _spans("f", 86400000000, "HAVING count(*) >= 2")
)


def _rolling(signal: str, widths, enough: int | None, digits: int = 6) -> str:
    out = []
    calls = {"mean": "avg", "std": "stddev_pop", "min": "min", "max": "max"}
    for w in widths:
        frame = f"OVER ({BY_USER} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for agg, f in calls.items():
            out.append(
                f"CASE WHEN count({signal}) {frame} >= {enough or w} THEN round({f}({signal}) {frame}, {digits}) END"
                f" AS {signal}_roll_{agg}_{w}s"
            )
    return ",\n  ".join(out)


ORACLES["rolling_stats"] = f"WITH {EVENTS} SELECT event_id,\n  {_rolling('value', (3, 10, 60), None)} FROM e"
ORACLES["rolling_skewed"] = f"""WITH e AS (
  SELECT event_id, CASE WHEN event_id % 50 = 0 THEN user_id ELSE 0 END AS user_id,
    CASE WHEN event_id = 7 THEN TIMESTAMP '2099-01-01' ELSE ts END AS ts, value FROM events)
SELECT event_id, {_rolling('value', (3, 10, 60), None)} FROM e"""
ORACLES["rolling_sparse"] = f"WITH {EVENTS} SELECT event_id,\n  {_rolling('reading', (20, 60), 5, 8)} FROM e"

ORACLES["lags"] = (
    f"WITH {EVENTS} SELECT event_id, "
    + ", ".join(f"lag({s}, {n}) OVER ({BY_USER}) AS {s}_lag_{n}s" for n in (1, 5, 20) for s in ("value", "reading"))
    + " FROM e"
)

ORACLES["future_label"] = f"""WITH {EVENTS}, a AS (
  SELECT event_id, reading, lead(reading, 5) OVER ({BY_USER}) AS label FROM e)
SELECT event_id, reading, label, CASE WHEN label IS NULL THEN 0 ELSE 1 END AS label_available FROM a
WHERE abs(label - reading) <= 100 OR label IS NULL OR reading IS NULL"""

ORACLES["position"] = f"""SELECT event_id, p AS position FROM (
  SELECT event_id, row_number() OVER ({BY_USER}) - 1 AS p FROM events) WHERE p >= 3"""

ORACLES["rate_of_change"] = f"""WITH a AS (
  SELECT event_id, value - lag(value) OVER ({BY_USER}) AS dv,
    (epoch_us(ts) - lag(epoch_us(ts)) OVER ({BY_USER})) / 1e6 AS dt FROM events)
SELECT event_id, CASE WHEN dt <> 0 THEN round(dv / dt * 60, 6) END AS rate FROM a"""

ORACLES["elapsed"] = """SELECT event_id,
  round((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1e6, 6) AS elapsed_s FROM events"""

ORACLES["error_band"] = f"""WITH {EVENTS}, a AS (
  SELECT event_id, value, count(reading - 100) OVER w AS n, stddev_samp(reading - 100) OVER w AS sd FROM e
  WINDOW w AS ({BY_USER} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)
), b AS (SELECT *, CASE WHEN n >= 5 THEN sd ELSE 0.2 END AS es FROM a)
SELECT event_id, round(es, 6) AS err_std, round(value + 1.5 * es, 6) AS band_upper,
  round(value - 1.5 * es, 6) AS band_lower FROM b"""

_trip = "PARTITION BY trip_id ORDER BY ts, event_id"
_feature_columns = ",\n  ".join(
    [f"lag(value, {n}) OVER ({_trip}) AS value_lag_{n}s" for n in (1, 2)]
    + [
        f"CASE WHEN count(value) OVER w{w} >= {w} THEN round({f}(value) OVER w{w}, 6) END AS value_roll_{a}_{w}s"
        for w in (2, 4)
        for a, f in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"))
    ]
)
ORACLES["window_features"] = f"""WITH {SESSIONS}, k AS (
  SELECT * FROM s WHERE trip_id IS NOT NULL AND (quality_flag & 48) = 0
), f AS (
  SELECT event_id, trip_id, value, {_feature_columns}, lead(value) OVER ({_trip}) AS label FROM k
  WINDOW w2 AS ({_trip} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW),
         w4 AS ({_trip} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
) SELECT * EXCLUDE (value), CASE WHEN label IS NULL THEN 0 ELSE 1 END AS label_available FROM f
WHERE label IS NULL OR abs(label - value) <= 200"""

HOURS = f"""{EVENTS}, h AS (
  SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS hour, avg(reading) AS reading,
    last(event_type ORDER BY ts, event_id) AS event_type, bit_or(quality_flag) AS quality_flag
  FROM e GROUP BY ALL)"""
GRID = f"""{HOURS}, g AS (
  SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
  FROM (SELECT user_id, min(hour) AS lo, max(hour) AS hi FROM h GROUP BY user_id)
), j AS (
  SELECT g.user_id, g.ts, h.reading, h.event_type, coalesce(h.quality_flag, 4) AS flag FROM g
  LEFT JOIN h ON g.user_id = h.user_id AND g.ts = h.hour
), k AS (
  SELECT *, max(CASE WHEN reading IS NOT NULL THEN ts END) OVER up AS pt, last_value(reading IGNORE NULLS) OVER up AS pv,
    min(CASE WHEN reading IS NOT NULL THEN ts END) OVER dn AS nt, first_value(reading IGNORE NULLS) OVER dn AS nv,
    max(CASE WHEN event_type IS NOT NULL THEN ts END) OVER up AS et, last_value(event_type IGNORE NULLS) OVER up AS ev
  FROM j WINDOW up AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    dn AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

ORACLES["collapse_duplicates"] = f"""WITH {HOURS}
SELECT user_id, hour, event_type, round(reading, 6) AS reading, quality_flag FROM h"""
ORACLES["resample_grid"] = f"""WITH {GRID}
SELECT user_id, ts, round(reading, 6) AS reading, event_type, flag AS quality_flag FROM j"""
ORACLES["fill_linear"] = f"""WITH {GRID}, c AS (
  SELECT *, coalesce(reading IS NULL AND ts - pt <= INTERVAL 5 HOUR AND nt - ts <= INTERVAL 5 HOUR, false) AS can FROM k)
SELECT user_id, ts,
  round(CASE WHEN can THEN pv + (nv - pv) / date_diff('hour', pt, nt) * date_diff('hour', pt, ts) ELSE reading END, 6) AS reading,
  flag | CASE WHEN can THEN 1 ELSE 0 END AS quality_flag FROM c"""
ORACLES["fill_forward"] = f"""WITH {GRID}, c AS (
  SELECT *, coalesce(reading IS NULL AND ts - pt <= INTERVAL 24 HOUR, false) AS can_r,
    coalesce(event_type IS NULL AND ts - et <= INTERVAL 48 HOUR, false) AS can_e FROM k)
SELECT user_id, ts, round(CASE WHEN can_r THEN pv ELSE reading END, 6) AS reading,
  CASE WHEN can_e THEN ev ELSE event_type END AS event_type,
  flag | CASE WHEN can_r OR can_e THEN 2 ELSE 0 END AS quality_flag FROM c"""

ORACLES["fill_counter"] = f"""WITH {GRID}, c AS (
  SELECT *, coalesce(reading IS NULL AND ts - pt <= INTERVAL 24 HOUR, false) AS can FROM k)
SELECT user_id, ts, round(CASE WHEN can THEN pv ELSE reading END, 6) AS reading,
  flag | CASE WHEN can THEN 2 ELSE 0 END AS quality_flag FROM c"""

FAULTS = f"""{EVENTS}, flt AS (
  SELECT user_id, event_id AS fault_id, ts AS activated_at, event_type AS code,
    CASE WHEN NOT (event_type = 'purchase' AND value > 300) THEN ts + INTERVAL 2 HOUR END AS fixed_at
  FROM e WHERE event_type IN ('error', 'purchase'))"""

_covered = """EXISTS (SELECT 1 FROM flt f WHERE f.user_id = e.user_id AND f.code = '{}' AND e.ts >= f.activated_at
    AND (f.fixed_at IS NULL OR e.ts <= f.fixed_at))"""
ORACLES["fault_flags"] = f"""WITH {FAULTS}, c AS (
  SELECT event_id, CASE WHEN {_covered.format('error')} THEN 1 ELSE 0 END AS fault_error,
    CASE WHEN {_covered.format('purchase')} THEN 1 ELSE 0 END AS fault_purchase FROM e)
SELECT *, greatest(fault_error, fault_purchase) AS fault_any FROM c"""

CLEAN = "regexp_replace(regexp_replace(lower(trim({})), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"
KNOWN = (
    "busbar_undervoltage_fault bus_overvoltage_fault hardware_overvoltage_fault total_hardware_failure "
    "ac_hall_failure module_over_temperature_warning temperature_difference_failure "
    "low_voltage_undervoltage_fault software_overcurrent_fault"
).split()
ORACLES["fault_code_universe"] = (
    f"SELECT {CLEAN.format('p_brand')} AS code FROM part UNION SELECT unnest([{', '.join(repr(k) for k in KNOWN)}]) AS code"
)

PRE = f"""{FAULTS}, pre AS (
  SELECT f.user_id, f.fault_id, count(*) AS pre_rows, avg(e.value) AS value_pre_mean, avg(e.reading) AS reading_pre_mean
  FROM flt f JOIN e ON e.user_id = f.user_id AND e.ts >= f.activated_at - INTERVAL 24 HOUR AND e.ts < f.activated_at
  WHERE f.fixed_at IS NOT NULL GROUP BY ALL HAVING count(*) >= 2)"""
ORACLES["pre_event_stats"] = f"""WITH {PRE}
SELECT user_id, fault_id, pre_rows, round(value_pre_mean, 6) AS value_pre_mean,
  round(reading_pre_mean, 6) AS reading_pre_mean FROM pre"""
ORACLES["pre_event_zscores"] = f"""WITH {PRE}, m AS (
  SELECT avg(value) AS mv, stddev_samp(value) AS dv, avg(reading) AS mr, stddev_samp(reading) AS dr FROM e)
SELECT fault_id, round((value_pre_mean - mv) / dv, 6) AS value_z, round((reading_pre_mean - mr) / dr, 6) AS reading_z
FROM pre, m"""
ORACLES["event_segments"] = f"""WITH {FAULTS}
SELECT e.event_id, f.fault_id AS segment_event FROM e JOIN flt f ON e.user_id = f.user_id
  AND e.ts BETWEEN f.activated_at - INTERVAL 1 HOUR AND f.fixed_at + INTERVAL 30 MINUTE"""
ORACLES["day_slice"] = """SELECT event_id, user_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'"""

CHECKED = """c AS (
  SELECT l_orderkey, l_linenumber, l_tax,
    CASE WHEN l_quantity BETWEEN 2 AND 49 THEN l_quantity END AS l_quantity, l_extendedprice,
    CASE WHEN l_discount BETWEEN 0.01 AND 0.09 THEN l_discount END AS l_discount,
    (CASE WHEN l_quantity NOT BETWEEN 5 AND 45 OR l_extendedprice NOT BETWEEN 2000 AND 90000 THEN 8 ELSE 0 END
     + CASE WHEN l_quantity NOT BETWEEN 2 AND 49 OR l_discount NOT BETWEEN 0.01 AND 0.09 THEN 16 ELSE 0 END) AS quality_flag
  FROM lineitem)"""
ORACLES["range_check"] = f"""WITH {CHECKED}
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, quality_flag FROM c"""
ORACLES["bitmask_filter"] = f"WITH {CHECKED} SELECT l_orderkey, l_linenumber, quality_flag FROM c WHERE (quality_flag & 48) = 0"
ORACLES["breach_counts"] = f"""WITH {CHECKED}
SELECT count(*) AS rows, count(*) FILTER (quality_flag & 8 <> 0) AS soft, count(*) FILTER (quality_flag & 16 <> 0) AS hard FROM c"""
ORACLES["null_rates"] = f"WITH {CHECKED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate FROM c"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)
ORACLES["code_sanitise"] = f"""SELECT p_partkey,
  {CLEAN.format("'  ' || p_name || '--' || p_type || '! '")} AS code FROM part"""
ORACLES["parse_durations"] = """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'N' THEN (l_partkey * 3600 + l_linenumber * 60 + 5)::DOUBLE END AS seconds FROM lineitem"""
ORACLES["category_map"] = """SELECT event_id,
  CASE WHEN event_type IN ('click', 'purchase') THEN 1 WHEN event_type = 'view' THEN 0 END AS state FROM events"""
ORACLES["parse_times"] = """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN date_trunc('second', o_orderdate)::TIMESTAMP END AS parsed FROM orders"""

ORDER_FILES = """o AS (
  SELECT o_orderkey, o_orderpriority AS vehicle_id, o_totalprice / 1000 - 50 AS soc_pct,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS ts FROM orders
), o2 AS (
  SELECT *, coalesce(ts < lag(ts) OVER (PARTITION BY vehicle_id ORDER BY o_orderkey), false) AS rev FROM o)"""
ORACLES["time_reversals"] = f"""WITH {ORDER_FILES}
SELECT o_orderkey, CASE WHEN ts IS NULL OR rev THEN 32 ELSE 0 END AS quality_flag FROM o2"""
ORACLES["validation_report"] = f"""WITH {ORDER_FILES}
SELECT vehicle_id, count(ts) AS row_count_after_validation,
  count(*) - count(DISTINCT ts) - max(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS duplicate_timestamps,
  count(*) - count(ts) AS bad_timestamps, count(*) FILTER (rev) AS time_reversal_rows,
  count(*) FILTER (ts IS NOT NULL AND (soc_pct < 0 OR soc_pct > 100)) AS soft_range_breaches,
  count(*) FILTER (ts IS NOT NULL AND (soc_pct < -1 OR soc_pct > 101)) AS hard_range_breaches,
  round(avg(CASE WHEN ts IS NULL THEN NULL WHEN soc_pct < -1 OR soc_pct > 101 THEN 1.0 ELSE 0.0 END), 6) AS null_rate_soc_pct
FROM o2 GROUP BY vehicle_id"""

SIGNALS = """x AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_extendedprice / 100 AS volt, l_quantity - 25 AS amp,
    l_extendedprice / 100 * (l_quantity - 20) / 1000 AS power, l_quantity * 20 - 400 AS rpm, l_discount * 1000 AS nm,
    l_discount + 3.5::DOUBLE AS cmax, l_tax + 3.4::DOUBLE AS cmin, l_discount * 40 AS cavg, l_quantity - 10 AS tavg,
    l_quantity + 30 AS tmot, l_quantity + 20 AS tmcu, l_tax * 500 AS trad, l_quantity * 2 AS vin,
    l_discount * 100 AS ain, l_quantity AS aout FROM lineitem
), y AS (
  SELECT *, volt * amp / 1000 AS elec, nm * (rpm * (2 * pi() / 60)) / 1000 AS mech, vin * ain / 1000 AS kin,
    12.0::DOUBLE * aout / 1000 AS kout FROM x)"""


def _ratio(num: str, den: str, least_den: float) -> str:
    return f"CASE WHEN abs({den}) >= {least_den} THEN greatest(least(({num}) / abs({den}), 10), -10) END"


ORACLES["physics_columns"] = f"""WITH {SIGNALS}
SELECT l_orderkey, l_linenumber, round(elec, 9) AS elec_power_kw_proxy, round(power - elec, 9) AS power_proxy_error_kw,
  round({_ratio('power', 'elec', 0.5)}, 9) AS power_proxy_ratio, round(cmax - cmin, 9) AS cell_voltage_delta_v,
  round({_ratio('cmax - cmin', 'cavg', 0.001)}, 9) AS cell_voltage_delta_norm,
  2.0::DOUBLE AS battery_temp_delta_c, round({_ratio('2.0::DOUBLE', 'tavg', 0.001)}, 9) AS battery_temp_delta_norm,
  round(mech, 9) AS mech_power_kw_proxy, round({_ratio('mech', 'elec', 0.5)}, 9) AS eff_proxy,
  round(tmot - trad, 9) AS motor_minus_radiator_temp_c, round(tmcu - trad, 9) AS mcu_minus_radiator_temp_c,
  round(kin, 9) AS dcdc_input_kw_proxy, round(kout, 9) AS dcdc_output_kw_proxy,
  round({_ratio('kout', 'kin', 0.1)}, 9) AS dcdc_eff_proxy FROM y"""
ORACLES["safe_ratio"] = f"""SELECT l_orderkey, l_linenumber,
  round({_ratio('l_quantity - 25', '(l_discount - 0.05::DOUBLE)', 0.02)}, 6) AS ratio FROM lineitem"""
ORACLES["charging_flags"] = f"""WITH {SIGNALS}
SELECT l_orderkey, l_linenumber, CASE WHEN amp > 0 THEN 1 ELSE 0 END AS is_charging_current,
  CASE WHEN amp > 5 AND abs(rpm) < 50 THEN 1 ELSE 0 END AS is_parked_charging,
  CASE WHEN abs(rpm) < 50 AND abs(power) < 0.2 AND abs(amp) < 1 THEN 1 ELSE 0 END AS is_physics_quiet FROM y"""
ORACLES["align_columns"] = f"""WITH {EVENTS}
SELECT event_id::DOUBLE AS event_key, coalesce(reading, 0)::DOUBLE AS reading, 0::DOUBLE AS absent_signal FROM e"""

SCORED = """v0 AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_shipdate,
    CASE WHEN l_linestatus = 'O' THEN 'val' ELSE 'train' END AS split, l_quantity * 2 AS y,
    l_quantity * 2 + l_tax * 50 - l_discount * 40 AS raw,
    l_quantity * 2 + round((l_discount - 0.05::DOUBLE) * 100) AS now FROM lineitem
), v1 AS (SELECT *, greatest(least(raw, 100), 0) AS pred FROM v0
), v AS (SELECT *, pred - y AS error, abs(pred - y) AS abs_error FROM v1)"""
MAE = "round(avg(abs(pred - y)), 6)"
RMSE = "round(sqrt(avg((pred - y) * (pred - y))), 6)"
MAPE = "round(avg(abs(pred - y) / greatest(abs(y), 1)) * 100, 6)"
METRICS = f"count(*) AS rows, {MAE} AS mae, {RMSE} AS rmse, {MAPE} AS mape"
DIST = """round(avg(error), 6) AS mean, round(stddev_samp(error), 6) AS std,
  round(quantile_cont(error, 0.05), 6) AS p5, round(quantile_cont(error, 0.25), 6) AS p25,
  round(quantile_cont(error, 0.5), 6) AS p50, round(quantile_cont(error, 0.75), 6) AS p75,
  round(quantile_cont(error, 0.95), 6) AS p95, round(max(abs(error)), 6) AS max_abs"""

ORACLES["scored_rows"] = f"""WITH {SCORED}
SELECT l_orderkey, l_linenumber, y, round(pred, 6) AS pred, round(error, 6) AS error, round(abs_error, 6) AS abs_error FROM v"""
ORACLES["regression_metrics"] = f"WITH {SCORED} SELECT {METRICS} FROM v"
ORACLES["finite_metrics"] = f"WITH {SCORED} SELECT count(*) AS rows, {MAE} AS mae, {RMSE} AS rmse FROM v WHERE l_returnflag <> 'N'"
ORACLES["group_metrics"] = f"WITH {SCORED} SELECT l_suppkey, {METRICS} FROM v GROUP BY l_suppkey ORDER BY mae DESC, l_suppkey"
ORACLES["bucket_metrics"] = f"""WITH {SCORED}
SELECT CASE WHEN now < 20 THEN '0–20%' WHEN now < 40 THEN '20–40%' WHEN now < 60 THEN '40–60%'
  WHEN now < 80 THEN '60–80%' ELSE '80–100%' END AS soc_bucket, {METRICS}
FROM v WHERE now >= 0 AND now < 100 GROUP BY 1"""
ORACLES["actual_bucket_mae"] = f"""WITH {SCORED}
SELECT CASE WHEN y <= 20 THEN '(0, 20]' WHEN y <= 40 THEN '(20, 40]' WHEN y <= 60 THEN '(40, 60]'
  WHEN y <= 80 THEN '(60, 80]' ELSE '(80, 100]' END AS bucket, {MAE} AS mae FROM v WHERE y > 0 AND y <= 100 GROUP BY 1"""
ORACLES["error_distribution"] = f"WITH {SCORED} SELECT {DIST} FROM v"
ORACLES["error_distribution_by_supplier"] = f"WITH {SCORED} SELECT l_suppkey, {DIST} FROM v GROUP BY l_suppkey"
ORACLES["baseline_maes"] = f"""WITH {SCORED}
SELECT round(avg(abs(now - y)), 6) AS persistence_mae, {MAE} AS rolling_mae FROM v"""
ORACLES["slice_metrics"] = f"""WITH {SCORED}, n AS (
  SELECT unnest(['charging', 'discharging', 'flat']) AS slice
), d AS (SELECT *, CASE WHEN y > now THEN 'charging' WHEN y < now THEN 'discharging' ELSE 'flat' END AS slice FROM v)
SELECT n.slice, {MAE} AS mae, {RMSE} AS rmse, count(d.slice) AS n FROM n LEFT JOIN d ON n.slice = d.slice GROUP BY n.slice"""
ORACLES["worst_rows"] = f"""WITH {SCORED}
SELECT l_orderkey, l_linenumber, round(error, 6) AS error FROM v
ORDER BY round(abs_error, 6) DESC, l_orderkey, l_linenumber LIMIT 25"""
ORACLES["worst_row"] = f"""WITH {SCORED}
SELECT l_orderkey, l_linenumber, round(abs_error, 6) AS abs_error FROM v
ORDER BY round(abs_error, 6) DESC, l_orderkey, l_linenumber LIMIT 1"""
ORACLES["tail_shares"] = f"""WITH {SCORED}
SELECT t AS threshold, round(avg(CASE WHEN round(abs_error, 6) >= t THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct
FROM v, (SELECT unnest([0.5, 1.0, 2.0, 3.0, 4.0])::DOUBLE AS t) GROUP BY t"""
ORACLES["train_val_metrics"] = f"""WITH {SCORED}, tr AS (SELECT {METRICS} FROM v WHERE split = 'train'),
vl AS (SELECT {METRICS} FROM v WHERE split = 'val'), a AS (
  SELECT tr.rows AS train_rows, tr.mae AS train_mae, tr.rmse AS train_rmse, tr.mape AS train_mape,
    vl.rows AS val_rows, vl.mae AS val_mae, vl.rmse AS val_rmse, vl.mape AS val_mape,
    round(vl.mae - tr.mae, 3) AS train_val_gap FROM tr, vl)
SELECT *, CASE WHEN val_mae < 0.5 AND train_val_gap < 0.5 THEN 'EXCELLENT' WHEN val_mae < 1.5 THEN 'ACCEPTABLE'
  WHEN val_mae < 2.0 THEN 'INVESTIGATE' ELSE 'FAILING' END AS status FROM a"""
ORACLES["bias_and_drop"] = f"""WITH {SCORED}
SELECT l_suppkey, round(avg(error), 6) AS bias, round(avg(abs_error), 6) AS mae,
  round(first(y ORDER BY l_shipdate, l_orderkey, l_linenumber) - last(y ORDER BY l_shipdate, l_orderkey, l_linenumber), 6)
  AS level_drop FROM v GROUP BY l_suppkey"""
ORACLES["trip_error_summary"] = f"""WITH {SCORED}
SELECT l_suppkey, count(*) AS rows, round(avg(abs_error), 6) AS mae, round(quantile_cont(abs_error, 0.95), 6) AS p95,
  round(max(abs_error), 6) AS max_abs, min(y) AS soc_min, max(y) AS soc_max,
  round(min(y), 1)::VARCHAR || '–' || round(max(y), 1)::VARCHAR || '%' AS soc_range FROM v GROUP BY l_suppkey"""


def _histogram(source: str, value: str, bins: int, key: str = "") -> str:
    k, on = (f"{key}, ", f"{key}") if key else ("0 AS z, ", "z")
    shown = f"{key}, " if key else ""
    return f"""WITH r AS (SELECT {k}{value} AS v FROM {source}),
b AS (SELECT {on}, min(v) AS lo, max(v) AS hi FROM r GROUP BY {on}),
c AS (SELECT {on}, least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1})::INT AS bin, count(*) AS n
  FROM r JOIN b USING ({on}) GROUP BY ALL),
g AS (SELECT *, unnest(generate_series(0, {bins - 1}))::INT AS bin FROM b)
SELECT {shown}bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_start,
  round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS bin_end, coalesce(n, 0) AS rows FROM g LEFT JOIN c USING ({on}, bin)"""


ORACLES["histogram"] = _histogram("events", "value", 60)
ORACLES["histogram_by_split"] = _histogram("lineitem", "l_extendedprice", 80, "l_linestatus")
ORACLES["sample_rows"] = "SELECT event_id, value FROM events ORDER BY md5(event_id::VARCHAR || '|42'), event_id LIMIT 300"
ORACLES["quantiles"] = f"""WITH {EVENTS} SELECT event_type, """ + ", ".join(
    f"round(quantile_cont(reading, {p}), 6) AS p{int(p * 100)}" for p in (0.05, 0.25, 0.5, 0.75, 0.95)
) + " FROM e WHERE reading IS NOT NULL GROUP BY event_type"

ORACLES["training_rows"] = f"""WITH {SIGNALS}
SELECT l_orderkey, l_linenumber, round(volt, 9) AS stack_voltage_v, amp AS battery_current_a,
  CASE WHEN amp > 0 THEN 1 ELSE 0 END AS is_charging_current,
  CASE WHEN amp > 5 AND abs(rpm) < 50 THEN 1 ELSE 0 END AS is_parked_charging, round(power, 9) AS label
FROM y WHERE l_returnflag <> 'R' AND amp <= 23 AND amp <> 0"""

STARTS = "t AS (SELECT o_custkey, min(o_orderdate) AS start FROM orders GROUP BY o_custkey)"
ORACLES["split_dates"] = f"""WITH {STARTS}
SELECT o_orderkey, CASE WHEN start < TIMESTAMP '1995-07-01' THEN 'train' ELSE 'val' END AS split
FROM orders JOIN t USING (o_custkey) WHERE start >= TIMESTAMP '1995-01-01' AND start < TIMESTAMP '1996-01-01'"""
ORACLES["split_last_trips"] = f"""WITH {STARTS}, k AS (SELECT o_custkey FROM t ORDER BY start DESC, o_custkey DESC LIMIT 20)
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM k) THEN 'val' ELSE 'train' END AS split FROM orders"""
SHARE = f"""{STARTS}, k AS (
  SELECT *, row_number() OVER (ORDER BY start, o_custkey) AS rn, count(*) OVER () AS n FROM t
), sp AS (
  SELECT o_custkey, start, CASE WHEN rn > n - greatest(1, round_even(n * 0.2, 0)) THEN 'test' ELSE 'train' END AS split FROM k)"""
ORACLES["split_by_share"] = f"WITH {SHARE} SELECT o_orderkey, split FROM orders JOIN sp USING (o_custkey)"
ORACLES["split_shuffled"] = """WITH k AS (
  SELECT o_custkey, row_number() OVER (ORDER BY substr(md5(o_custkey::VARCHAR || '|42'), 1, 15), o_custkey) AS rn,
    count(*) OVER () AS n FROM (SELECT DISTINCT o_custkey FROM orders))
SELECT o_orderkey, CASE WHEN rn <= greatest(1, round_even(n * 0.2, 0)) THEN 'test' ELSE 'train' END AS split
FROM orders JOIN k USING (o_custkey)"""
ORACLES["split_summary"] = f"""WITH {SHARE}
SELECT split, count(*) AS rows, count(DISTINCT o_custkey) AS trips, min(start)::TIMESTAMP AS first_start,
  max(start)::TIMESTAMP AS last_start FROM orders JOIN sp USING (o_custkey) GROUP BY split"""
MICRO = """m AS (
  SELECT o_custkey, count(*) AS rows, max(o_totalprice) - min(o_totalprice) AS level_range FROM orders GROUP BY o_custkey)"""
ORACLES["micro_trip_filter"] = f"""WITH {MICRO} SELECT o_orderkey FROM orders JOIN m USING (o_custkey)
WHERE rows >= 8 AND level_range >= 300000"""
ORACLES["micro_trips_removed"] = f"""WITH {MICRO} SELECT o_custkey, rows, round(level_range, 6) AS level_range FROM m
WHERE rows < 8 OR level_range < 300000"""

_report = """SELECT '{0}' AS feature, CASE WHEN count({1}) = 0 THEN 'all_nan' ELSE 'ok' END AS status,
  CASE WHEN count({1}) > 0 THEN count(DISTINCT {1}) END AS n_unique, round(min({1}), 8) AS "min", round(max({1}), 8) AS "max",
  round(avg({1}), 8) AS mean, round(stddev_samp({1}), 8) AS std,
  CASE WHEN count({1}) = 0 THEN 1.0 ELSE round(avg(CASE WHEN {1} IS NULL THEN NULL WHEN {1} = 0 THEN 1.0 ELSE 0.0 END), 8) END::DOUBLE AS zero_pct,
  count(DISTINCT {1}) = 1 AS is_constant,
  coalesce(stddev_samp({1}), 0) < 1e-6 AND count(DISTINCT {1}) <= 2 AS is_near_constant FROM lineitem"""
ORACLES["constant_report"] = " UNION ALL ".join(
    _report.format(n, e)
    for n, e in [(c, f"{c}::DOUBLE") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")]
    + [("always_one", "1.0::DOUBLE"), ("never", "NULL::DOUBLE")]
)

GOLD = f"""{FILES}, held AS (
  SELECT *, max(CASE WHEN reading IS NOT NULL THEN ts END) OVER up AS pt, last_value(reading IGNORE NULLS) OVER up AS pv
  FROM silver WINDOW up AS (PARTITION BY dt, vehicle_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), sil AS (
  SELECT dt, vehicle_id, ts, trip_id, coalesce(flag, 0) AS flag,
    CASE WHEN ts - pt <= INTERVAL 24 HOUR THEN pv END AS reading FROM held
), kept AS (SELECT * FROM sil WHERE flag & 16 = 0 AND trip_id IS NOT NULL
), lab AS (
  SELECT *, lead(reading, 2) OVER (PARTITION BY dt, vehicle_id, trip_id ORDER BY ts) AS label FROM kept
), gold AS (SELECT * FROM lab WHERE label IS NULL OR reading IS NULL OR abs(label - reading) <= 50
), per AS (SELECT dt, vehicle_id, trip_id, count(*) AS n FROM gold GROUP BY ALL
), daily AS (
  SELECT s.dt, s.vehicle_id, s.silver_rows, s.aft AS rows_after_quality_filter, s.silver_rows - s.aft AS dropped_rows,
    round((s.silver_rows - s.aft) / s.silver_rows, 6) AS drop_pct, coalesce(w.n, 0)::BIGINT AS window_feature_rows,
    coalesce(w.big, 0)::BIGINT AS trip_count, CASE WHEN coalesce(w.n, 0) >= 5 THEN 1 ELSE 0 END AS has_enough_rows,
    coalesce(w.g, 0)::BIGINT AS trip_groups_processed, coalesce(w.g, 0)::BIGINT AS window_parts_written,
    (s.aft - coalesce(w.n, 0))::BIGINT AS dropped_unrealistic_target_rows,
    CASE WHEN s.aft = 0 THEN 'empty_after_quality_filter' ELSE 'success' END AS status
  FROM (SELECT dt, vehicle_id, count(*) AS silver_rows,
      count(*) FILTER (flag & 16 = 0 AND trip_id IS NOT NULL) AS aft FROM sil GROUP BY ALL) s
  LEFT JOIN (SELECT dt, vehicle_id, sum(n) AS n, count(*) AS g, count(*) FILTER (n >= 2) AS big FROM per GROUP BY ALL) w
    ON s.dt = w.dt AND s.vehicle_id = w.vehicle_id)"""
ORACLES["daily_stats"] = f"WITH {GOLD} SELECT * FROM daily"
ORACLES["gold_totals"] = f"""WITH {GOLD}
SELECT count(*) AS files, sum(silver_rows)::BIGINT AS silver_rows,
  sum(rows_after_quality_filter)::BIGINT AS rows_after_quality_filter, sum(window_feature_rows)::BIGINT AS window_feature_rows,
  sum(trip_count)::BIGINT AS trip_count, sum(dropped_unrealistic_target_rows)::BIGINT AS dropped_unrealistic_target_rows,
  count(*) FILTER (status <> 'success') AS empty_files FROM daily"""
ORACLES["ingest_manifest"] = f"""WITH {FILES}, raw AS (
  SELECT strftime(ts, '%Y-%m-%d') AS dt, user_id::VARCHAR AS vehicle_id, count(*) AS raw_rows, min(ts) AS data_start_ts,
    max(ts) AS data_end_ts, sum(fault_any)::BIGINT AS num_fault_events FROM e GROUP BY ALL)
SELECT raw.dt, raw.vehicle_id, raw_rows, data_start_ts, data_end_ts, silver_rows, 0::BIGINT AS silver_duplicate_timestamps,
  num_trips, fault_active_rows, num_fault_events
FROM raw JOIN (SELECT dt, vehicle_id, count(*) AS silver_rows, count(DISTINCT trip_id) AS num_trips,
    count(*) FILTER (fault_share > 0) AS fault_active_rows FROM silver GROUP BY ALL) s
  ON raw.dt = s.dt AND raw.vehicle_id = s.vehicle_id"""

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
DRIFT = f"""li AS (
  SELECT l_quantity, l_extendedprice, l_discount, CASE WHEN l_returnflag <> 'N' THEN l_tax END AS l_tax,
    l_shipdate < TIMESTAMP '1997-01-01' AS old FROM lineitem
), ref AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS v FROM li WHERE old" for c in FEATURES)}
), fresh AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c + ' * 1.2' if c == 'l_quantity' else c} AS v FROM li WHERE NOT old" for c in FEATURES)}
), base AS (
  SELECT feature, avg(v) AS mean, stddev_samp(v) AS std, quantile_cont(v, 0.10) AS p10, quantile_cont(v, 0.25) AS p25,
    quantile_cont(v, 0.50) AS p50, quantile_cont(v, 0.75) AS p75, quantile_cont(v, 0.90) AS p90,
    avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate, count(v) AS n FROM ref GROUP BY feature
), sketch AS (
  SELECT feature, CASE WHEN x <= 0.1 THEN p10 WHEN x <= 0.25 THEN p10 + (p25 - p10) / (0.25 - 0.1) * (x - 0.1)
    WHEN x <= 0.5 THEN p25 + (p50 - p25) / (0.5 - 0.25) * (x - 0.25)
    WHEN x <= 0.75 THEN p50 + (p75 - p50) / (0.75 - 0.5) * (x - 0.5)
    WHEN x <= 0.9 THEN p75 + (p90 - p75) / (0.9 - 0.75) * (x - 0.75) ELSE p90 END AS v
  FROM base, (SELECT i / 999.0::DOUBLE AS x FROM range(1000) AS r(i)))"""


def _psi(ref: str, open_ends: bool) -> str:
    cut = ", ".join(f"quantile_cont(v, {i / 10})" for i in range(11))
    slot = "least(greatest(len(list_filter(ed, lambda q: q <= v)), 1), len(ed) - 1)" if open_ends else "len(list_filter(ed, lambda q: q <= v))"
    return f"""ed AS (SELECT feature, list_sort(list_distinct([{cut}])) AS ed FROM {ref} WHERE v IS NOT NULL GROUP BY feature),
both_ AS (SELECT feature, v, 1 AS r, 0 AS a FROM {ref} WHERE v IS NOT NULL
  UNION ALL SELECT feature, v, 0, 1 FROM fresh WHERE v IS NOT NULL),
placed AS (SELECT feature, r, a, CASE WHEN v = ed[-1] THEN len(ed) - 1 ELSE {slot} END AS b, len(ed) AS k FROM both_ JOIN ed USING (feature)),
bins AS (SELECT feature, CASE WHEN b >= 1 AND b < k THEN b END AS b, sum(r) AS r, sum(a) AS a FROM placed GROUP BY ALL),
tot AS (SELECT feature, sum(r) AS tr, sum(a) AS ta FROM bins GROUP BY feature),
shares AS (SELECT feature, b, CASE WHEN r = 0 THEN 1e-6 ELSE r / (tr + 1e-6) END AS r,
  CASE WHEN a = 0 THEN 1e-6 ELSE a / (ta + 1e-6) END AS a FROM bins JOIN tot USING (feature)),
psi AS (SELECT feature, round(sum(CASE WHEN b IS NULL THEN 0 ELSE (a - r) * ln(a / r) END), 4) AS psi FROM shares GROUP BY feature)"""


KS = """pairs AS (SELECT feature, v, sum(r) AS r, sum(a) AS a FROM (
  SELECT feature, v, 1 AS r, 0 AS a FROM ref WHERE v IS NOT NULL
  UNION ALL SELECT feature, v, 0, 1 FROM fresh WHERE v IS NOT NULL) GROUP BY ALL),
cum AS (SELECT feature, sum(r) OVER w AS cr, sum(a) OVER w AS ca, sum(r) OVER f AS tr, sum(a) OVER f AS ta FROM pairs
  WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY feature)),
kd AS (SELECT feature, max(abs(cr / tr - ca / ta)) AS d, max(tr) AS tr, max(ta) AS ta FROM cum GROUP BY feature),
kx AS (SELECT *, sqrt(tr * ta / (tr + ta)) * d AS x FROM kd),
ks AS (SELECT feature, d AS ks_stat, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
  lambda k: CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * k * k * x * x))), 0), 1) END AS ks_pvalue FROM kx)"""

ORACLES["drift_baseline"] = f"WITH {DRIFT} SELECT feature, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in ("mean", "std", "p10", "p25", "p50", "p75", "p90", "null_rate")
) + ", n FROM base"
ORACLES["psi_sample"] = f"WITH {DRIFT}, {_psi('ref', True)} SELECT feature, psi FROM psi"
ORACLES["psi_sketch"] = f"WITH {DRIFT}, {_psi('sketch', False)} SELECT feature, psi FROM psi"
ORACLES["ks_test"] = f"WITH {DRIFT}, {KS} SELECT feature, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue FROM ks"
REPORT = f"""{DRIFT}, {_psi('ref', True)}, {KS}, cur AS (
  SELECT feature, avg(v) AS m, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS nr, count(v) AS n FROM fresh GROUP BY feature
), rep AS (
  SELECT base.feature, CASE WHEN cur.n < 10 THEN 'INSUFFICIENT_DATA'
      WHEN psi >= 0.2 OR ks_pvalue < 0.05 OR abs(m - mean) / (abs(mean) + 1e-6) * 100 > 10 THEN 'DRIFT'
      WHEN psi >= 0.1 THEN 'MONITOR' ELSE 'STABLE' END AS status,
    psi, round(ks_stat, 4) AS ks_stat, round(ks_pvalue, 4) AS ks_pvalue, round(mean, 4) AS mean_ref, round(m, 4) AS mean_new,
    round(abs(m - mean) / (abs(mean) + 1e-6) * 100, 2) AS mean_shift_pct, round(null_rate, 4) AS null_rate_ref,
    round(nr, 4) AS null_rate_new, round(nr - null_rate, 4) AS null_rate_change
  FROM base JOIN cur USING (feature) JOIN psi USING (feature) JOIN ks USING (feature))"""
ORACLES["drift_report"] = f"WITH {REPORT} SELECT * FROM rep"
ORACLES["drift_summary"] = f"""WITH {REPORT}, c AS (
  SELECT count(*) AS features_checked, count(*) FILTER (status = 'DRIFT') AS n_drift,
    count(*) FILTER (status = 'MONITOR') AS n_monitor, count(*) FILTER (status = 'STABLE') AS n_stable FROM rep)
SELECT *, CASE WHEN n_drift > 0 THEN 'DRIFT' WHEN n_monitor > 0 THEN 'MONITOR' ELSE 'STABLE' END AS overall_status FROM c"""

ORACLES["contradictions"] = f"""WITH {SIGNALS}
SELECT l_orderkey, l_linenumber FROM y WHERE rpm > 20 AND (abs(power) < 0.5 OR abs(amp) < 0.5)"""
ORACLES["level_jumps"] = f"""WITH a AS (SELECT event_id, lead(value, 2) OVER ({BY_USER}) - value AS d FROM events)
SELECT event_id, round(d, 6) AS level_change FROM a WHERE d > 150"""
ORACLES["trip_bands"] = """WITH t AS (
  SELECT o_custkey, min(o_orderdate)::TIMESTAMP AS band_start, max(o_orderdate)::TIMESTAMP AS band_end FROM orders GROUP BY o_custkey
), n AS (SELECT *, row_number() OVER (ORDER BY band_start, o_custkey) - 1 AS band FROM t)
SELECT *, (band % 2)::INT AS parity FROM n"""

ORACLES["numeric_features"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate FROM lineitem"
    for c in ("l_discount", "l_extendedprice", "l_quantity", "l_tax")
)
ORACLES["stored_days"] = """SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS vehicle_id, event_id FROM events
WHERE event_type IN ('error', 'view') AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'"""
ORACLES["streamed_trips"] = f"""WITH {SESSIONS}, t AS (
  SELECT user_id, seq, min(ts) AS trip_start_ts, max(ts) AS trip_end_ts, count(*) AS rows FROM s GROUP BY user_id, seq
), mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS m FROM events)
SELECT user_id, printf('%d_%06d', user_id, seq::BIGINT) AS trip_id, trip_start_ts, trip_end_ts, rows FROM t, mark
WHERE rows >= 2 AND epoch_us(trip_end_ts) + 14400999999 <= epoch_us(m)"""
ORACLES["trip_sets"] = f"""WITH {SESSIONS}
SELECT trip_id, count(*) AS errors, NULL::DOUBLE AS total FROM s WHERE trip_id IS NOT NULL AND fault_any = 1 GROUP BY trip_id
UNION ALL SELECT trip_id, NULL, round(sum(value), 6) FROM s WHERE trip_id IS NOT NULL AND fault_any = 0 GROUP BY trip_id"""

ORACLES["fit_stump"] = """WITH s AS (
  SELECT l_linenumber AS v, count(*) AS n, sum(l_quantity) AS t FROM lineitem GROUP BY 1
), c AS (
  SELECT v, sum(n) OVER (ORDER BY v) AS nl, sum(t) OVER (ORDER BY v) AS tl, sum(n) OVER () AS n, sum(t) OVER () AS t FROM s
), best AS (
  SELECT v, tl / nl AS lo, (t - tl) / (n - nl) AS hi FROM c WHERE nl < n
  ORDER BY tl * tl / nl + (t - tl) * (t - tl) / (n - nl) DESC LIMIT 1)
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_linenumber <= v THEN lo ELSE hi END, 6) AS pred FROM lineitem, best"""
ORACLES["replaced_days"] = """SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS vehicle_id, event_id,
  CASE WHEN strftime(ts, '%Y-%m-%d') IN ('2024-01-05', '2024-01-06') THEN value * 2 ELSE value END AS value FROM events
WHERE event_type = 'error' OR strftime(ts, '%Y-%m-%d') NOT IN ('2024-01-05', '2024-01-06')"""
ORACLES["cleaned_rows"] = """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
  CASE WHEN l_linenumber <> 2 AND l_tax <> 0 THEN l_tax END AS tax, l_returnflag = 'R' AS returned, 0 AS speed FROM lineitem"""


def boosted(rounds: int, depth: int, step: float, l1: float, l2: float, least: int) -> str:
    """Rounds of boosted trees in plain SQL: every value of every feature is tried as a split of every node."""
    score = "power(greatest(abs({0}) - %s, 0), 2) / ({1} + %s)" % (l1, l2)
    gain = f"({score.format('gl', 'hl')} + {score.format('g - gl', 'h - hl')} - {score.format('g', 'h')}) / 2"
    out = """WITH r0 AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS y, avg(l_extendedprice / 1000) OVER () AS pred,
    [l_linenumber::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE, l_quantity::DOUBLE] AS x FROM lineitem"""
    for r in range(rounds):
        out += f"\n), n{r}_0 AS (SELECT *, pred - y AS e, 1 AS node FROM r{r}"
        for d in range(depth):
            k = f"{r}_{d}"
            out += f"""\n), u{k} AS (SELECT node, e, unnest([0, 1, 2, 3]) AS f, unnest(x) AS v FROM n{k}
), h{k} AS (SELECT node, f, v, sum(e) AS s, count(*) AS c FROM u{k} GROUP BY ALL
), c{k} AS (
  SELECT node, f, v, sum(s) OVER w AS gl, sum(c) OVER w AS hl, sum(s) OVER p AS g, sum(c) OVER p AS h FROM h{k}
  WINDOW p AS (PARTITION BY node, f), w AS (PARTITION BY node, f ORDER BY v)
), t{k} AS (SELECT node, f, v, {gain} AS gain FROM c{k} WHERE hl >= {least} AND h - hl >= {least}
), s{k} AS (SELECT * FROM t{k} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(ln(gain), 9) DESC, f, v) = 1
), n{r}_{d + 1} AS (
  SELECT n.* EXCLUDE (node), CASE WHEN f IS NULL THEN n.node ELSE 2 * n.node + (x[f + 1] > v)::INT END AS node
  FROM n{k} n LEFT JOIN s{k} s ON s.node = n.node"""
        out += f"""\n), w{r} AS (SELECT node, -{step} * sign(sum(e)) * greatest(abs(sum(e)) - {l1}, 0) / (count(*) + {l2}) AS w FROM n{r}_{depth} GROUP BY node
), r{r + 1} AS (SELECT l_orderkey, l_linenumber, y, pred + w AS pred, x FROM n{r}_{depth} JOIN w{r} USING (node)"""
    return out + f")\nSELECT l_orderkey, l_linenumber, round(pred, 6) AS pred FROM r{rounds}"


ORACLES["fit_two_rounds"] = boosted(rounds=2, depth=2, step=0.5, l1=3.0, l2=2.0, least=20)

ORACLES["streamed_trip_states"] = """WITH m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS upto FROM events), s0 AS (
  SELECT user_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events, m WHERE ts <= upto
), s1 AS (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 14401000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS seq FROM s0
), t AS (SELECT user_id, seq, min(ts) AS trip_start_ts, max(ts) AS trip_end_ts, count(*) AS rows FROM s1 GROUP BY user_id, seq)
SELECT user_id, printf('%d_%06d', user_id, seq::BIGINT) AS trip_id, epoch_us(trip_end_ts) + 14400999999 <= epoch_us(upto) AS closed,
  trip_start_ts, trip_end_ts, rows FROM t, m WHERE rows >= 2"""

ORACLES["incremental_load"] = f"""WITH {FILES.replace("user_id::VARCHAR AS vehicle_id", "(user_id % 4)::VARCHAR AS vehicle_id")}, raw AS (
  SELECT strftime(ts, '%Y-%m-%d') AS dt, (user_id % 4)::VARCHAR AS vehicle_id, count(*) AS raw_rows,
    date_trunc('hour', min(ts)) AS data_start_ts, date_trunc('hour', max(ts)) AS data_end_ts FROM events GROUP BY ALL
), made AS (SELECT dt, vehicle_id, count(*) AS silver_rows, count(DISTINCT trip_id) AS num_trips FROM silver GROUP BY ALL)
SELECT dt, vehicle_id, raw_rows, data_start_ts, data_end_ts, silver_rows, num_trips FROM raw JOIN made USING (dt, vehicle_id)"""

ORACLES["many_code_flags"] = f"""WITH {EVENTS}, flt AS (
  SELECT user_id, 'c' || event_id % 5000 AS code, ts AS activated_at,
    CASE WHEN event_id % 53 <> 0 THEN ts + INTERVAL 1 HOUR * (event_id % 70 - 2) END AS fixed_at
  FROM e WHERE event_type IN ('error', 'view')
), c AS (
  SELECT DISTINCT e.event_id, f.code FROM e JOIN flt f ON e.user_id = f.user_id AND e.ts >= f.activated_at
  WHERE (f.fixed_at IS NULL OR f.fixed_at >= f.activated_at) AND (f.fixed_at IS NULL OR e.ts <= f.fixed_at)
), g AS (SELECT event_id, count(*) AS n, string_agg(code, ',' ORDER BY code) AS codes, bool_or(code = 'c53') AS a, bool_or(code = 'c59') AS b FROM c GROUP BY event_id)
SELECT e.event_id, coalesce(n, 0) AS n_open, coalesce(codes, '') AS codes, coalesce(a, false)::INT AS fault_c53, coalesce(b, false)::INT AS fault_c59
FROM e LEFT JOIN g ON g.event_id = e.event_id"""

ORACLES["long_event_segments"] = f"""WITH {FAULTS}, l AS (
  SELECT user_id, fault_id, activated_at, activated_at + INTERVAL 1 SECOND * (CASE WHEN fault_id % 10 = 0 THEN 3650 * 86400 ELSE fault_id % 86400 END) AS ended
  FROM flt)
SELECT e.event_id, f.fault_id AS segment_event FROM e JOIN l f ON e.user_id = f.user_id
  AND e.ts BETWEEN f.activated_at - INTERVAL 2 DAY AND f.ended + INTERVAL 10 MINUTE"""

ORACLES["ks_exact"] = """WITH RECURSIVE p AS (
  SELECT c_nationkey::VARCHAR AS feature, c_acctbal::DOUBLE AS v, (c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))::INT AS r FROM customer
), g AS (SELECT feature, v, sum(r) AS r, sum(1 - r) AS a FROM p GROUP BY ALL
), c AS (
  SELECT feature, sum(r) OVER w AS cr, sum(a) OVER w AS ca, sum(r) OVER f AS n, sum(a) OVER f AS m FROM g
  WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY feature)
), d AS (
  SELECT feature, max(n)::BIGINT AS n, max(m)::BIGINT AS m, max(abs(cr / n - ca / m)) AS d, round(max(abs(cr / n - ca / m)) * max(n) * max(m))::BIGINT AS h
  FROM c GROUP BY feature HAVING max(n) > 0 AND max(m) > 0
), w AS (
  SELECT feature, n, m, d, h, 0::BIGINT AS k, list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS w FROM d
  UNION ALL
  SELECT feature, n, m, d, h, k + 1, list_transform(range(0, n + 1), lambda i:
    CASE WHEN i > k + 1 OR k + 1 - i > m OR abs(i * m - (k + 1 - i) * n) >= h THEN 0.0::DOUBLE
    ELSE w[i + 1] * (k + 1 - i) / (k + 1) + CASE WHEN i > 0 THEN w[i] * i / (k + 1) ELSE 0.0::DOUBLE END END)
  FROM w WHERE k < n + m)
SELECT feature, round(d, 6) AS ks_stat, round(CASE WHEN h <= 0 THEN 1.0::DOUBLE ELSE least(greatest(1 - w[n + 1], 0), 1) END, 6) AS ks_pvalue, 'exact' AS ks_method
FROM w WHERE k = n + m"""

MONTHS = """u AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS dt, unnest(['l_quantity', 'l_extendedprice', 'l_tax']) AS feature,
    unnest([l_quantity::DOUBLE, l_extendedprice::DOUBLE, CASE WHEN l_returnflag <> 'N' THEN l_tax::DOUBLE END]) AS v FROM lineitem)"""
ORACLES["merged_baseline"] = f"""WITH {MONTHS}
SELECT feature, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate,
  count(v) AS n, true AS "within" FROM u WHERE dt BETWEEN '1994-01' AND '1996-12' GROUP BY feature"""
ORACLES["merged_drift"] = f"""WITH {MONTHS}, s AS (
  SELECT feature, dt >= '1997-01' AS late, avg(v) AS m, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS z FROM u GROUP BY ALL
), w AS (SELECT feature, v, dt >= '1997-01' AS late FROM u WHERE v IS NOT NULL
), ed AS (SELECT feature, list_sort(list_distinct([{", ".join(f"quantile_disc(v, {i / 10})" for i in range(11))}])) AS ed FROM w WHERE NOT late GROUP BY feature
), b AS (SELECT feature, late, least(greatest(len(list_filter(ed, lambda q: q <= v)), 1), len(ed) - 1) AS b, count(*) AS c FROM w JOIN ed USING (feature) GROUP BY ALL
), t AS (SELECT feature, b, sum(c) FILTER (late) / (sum(sum(c) FILTER (late)) OVER (PARTITION BY feature)) AS a,
    sum(c) FILTER (NOT late) / (sum(sum(c) FILTER (NOT late)) OVER (PARTITION BY feature)) AS r FROM b GROUP BY feature, b
), p AS (SELECT feature, sum((coalesce(a, 1e-6) - coalesce(r, 1e-6)) * ln(coalesce(a, 1e-6) / coalesce(r, 1e-6))) AS psi FROM t GROUP BY feature)
SELECT o.feature, round(o.m, 4) AS mean_ref, round(n.m, 4) AS mean_new, round(o.z, 4) AS null_rate_ref, round(n.z, 4) AS null_rate_new, psi < 0.05 AS alike
FROM s o JOIN s n ON o.feature = n.feature AND NOT o.late AND n.late JOIN p ON p.feature = o.feature"""

ORACLES["merged_distinct"] = """WITH e AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21')
SELECT event_type, 'user_id' AS "column", count(DISTINCT user_id) AS "values" FROM e GROUP BY event_type
UNION ALL SELECT event_type, 'value', count(DISTINCT value) FROM e GROUP BY event_type
UNION ALL SELECT event_type, 'ts', count(DISTINCT ts) FROM e GROUP BY event_type"""
