"""SQL text for DuckDB, one statement per registered query, written independently of the Spark plans."""

from __future__ import annotations

from checks.plant import PLANT_SQL
from foresight import schema as S

M = '"machineID"'
SENSORS, ERRORS, COMPS = S.SENSORS, S.ERROR_IDS, S.COMPONENTS
NUMERIC, CATEGORICAL = S.feature_columns()


def frame(hours: int) -> str:
    """(t - hours, t] as a closed frame of whole microseconds."""
    return (f"RANGE BETWEEN INTERVAL '{hours - 1} hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW")


def cleaned_sql(src: str = "telemetry", out: str = "cleaned") -> str:
    filled = ", ".join(
        f"last_value({s} IGNORE NULLS) OVER (w ROWS BETWEEN {S.FFILL_ROWS} PRECEDING AND CURRENT ROW) AS {s}"
        for s in SENSORS)
    limits = {s: S.SOFT_BOUNDS[s] for s in SENSORS}
    clipped = ", ".join(
        f"least(greatest(coalesce({s}, CAST({(lo + hi) / 2} AS DOUBLE)), CAST({lo} AS DOUBLE)), CAST({hi} AS DOUBLE)) AS {s}"
        for s, (lo, hi) in limits.items())
    return f"""
{out}_dedup AS (
  SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {M}, datetime ORDER BY seq DESC) = 1),
{out}_filled AS (
  SELECT {M}, datetime, {filled} FROM {out}_dedup WINDOW w AS (PARTITION BY {M} ORDER BY datetime)),
{out} AS (SELECT {M}, datetime, {clipped} FROM {out}_filled)"""


def features_sql(out: str = "features", telemetry: str = "telemetry", errors: str = "errors",
                 services: str = "SELECT datetime, \"machineID\", comp FROM maint UNION SELECT * FROM failures",
                 label: bool = True) -> str:
    """CTE chain ending in `out`: every feature row with full history (no hour grid), with the label."""
    p = out
    rolled = ", ".join(
        f"avg({s}) OVER (w {frame(h)}) AS {s}_mean_{h}h, "
        f"coalesce(stddev_samp({s}) OVER (w {frame(h)}), 0) AS {s}_std_{h}h"
        for h in S.WINDOW_HOURS for s in SENSORS)
    counted = ", ".join(f"CAST(sum(coalesce({e}, 0)) OVER (w {frame(24)}) AS DOUBLE) AS {e}_count_24h" for e in ERRORS)
    pivot = ", ".join(f"count(*) FILTER (\"errorID\" = '{e}') AS {e}" for e in ERRORS)
    asof = "\n".join(
        f"""ASOF LEFT JOIN (SELECT {M}, datetime FROM {p}_services WHERE comp = '{c}') s_{c}
   ON r.{M} = s_{c}.{M} AND r.datetime >= s_{c}.datetime""" for c in COMPS)
    days = ", ".join(
        f"coalesce(least((epoch_us(r.datetime) - epoch_us(s_{c}.datetime)) / CAST(86400000000 AS DOUBLE), 365), 365) "
        f"AS days_since_{c}" for c in COMPS)
    numeric = ", ".join(f"r.{c}" for c in NUMERIC[:21])
    lab = ", CASE WHEN f.datetime <= r.datetime + INTERVAL 24 HOUR THEN 1 ELSE 0 END AS will_fail_24h" if label else ""
    labjoin = (f"ASOF LEFT JOIN failures f ON r.{M} = f.{M} AND r.datetime < f.datetime" if label else "")
    return f"""{cleaned_sql(telemetry, p + '_clean')},
{p}_hourly AS (
  SELECT {M}, date_trunc('hour', datetime) AS datetime, {pivot} FROM {errors} GROUP BY 1, 2),
{p}_rolled AS (
  SELECT c.{M}, c.datetime, min(c.datetime) OVER (PARTITION BY c.{M}) AS first_seen, {rolled}, {counted}
  FROM {p}_clean c LEFT JOIN {p}_hourly h ON c.{M} = h.{M} AND c.datetime = h.datetime
  WINDOW w AS (PARTITION BY c.{M} ORDER BY c.datetime)),
{p}_services AS ({services}),
{out} AS (
  SELECT r.{M}, r.datetime, {numeric}, {days}, coalesce(CAST(m.age AS DOUBLE), 0) AS age, m.model{lab}
  FROM {p}_rolled r LEFT JOIN machines m ON r.{M} = m.{M}
  {asof}
  {labjoin}
  WHERE r.datetime >= r.first_seen + INTERVAL 23 HOUR)"""


def rounded(columns, digits: int = 6, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, {digits}) AS {c}" for c in columns)



RULE = "vibration_mean_24h"
GRID = f"features_grid AS (SELECT * FROM features WHERE hour(datetime) % 3 = 0)"
SCORED = f"""WITH {PLANT_SQL}, {features_sql()}, {GRID},
limits AS (SELECT min({RULE}) AS lo, max({RULE}) AS hi FROM features_grid),
scored AS (
  SELECT f.*, will_fail_24h AS y,
         round(least(greatest(({RULE} - lo) / greatest(hi - lo, 1e-9), 0), 1), 6) AS p
  FROM features_grid f, limits)"""
AS_OF = "TIMESTAMP '2024-01-20 06:00:00'"


def latest_features(as_of: str) -> str:
    """CTEs ending in `features`: rows of the 24-hour slice up to `as_of`."""
    start = f"{as_of} - INTERVAL 23 HOUR"
    slices = (f"tel_slice AS (SELECT * FROM telemetry WHERE datetime BETWEEN {start} AND {as_of}), "
              f"err_slice AS (SELECT * FROM errors WHERE datetime BETWEEN {start} AND {as_of})")
    services = (f'SELECT datetime, "machineID", comp FROM maint WHERE datetime <= {as_of} '
                f"UNION SELECT * FROM failures WHERE datetime <= {as_of}")
    return f"{slices}, {features_sql('features', 'tel_slice', 'err_slice', services, label=False)}"


def area_sql(src: str, by: str) -> str:
    """CTE `areas`: average precision and ROC area per group from distinct scores."""
    return f"""
{src}_s AS (SELECT {by} AS g, p, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY 1, 2),
{src}_c AS (
  SELECT *, sum(pos) OVER (PARTITION BY g ORDER BY p DESC) AS tp, sum(neg) OVER (PARTITION BY g ORDER BY p DESC) AS fp,
         sum(pos) OVER (PARTITION BY g) AS np, sum(neg) OVER (PARTITION BY g) AS nn FROM {src}_s),
areas AS (
  SELECT g, sum(pos / np * (tp / (tp + fp))) AS pr_auc, sum(neg * (tp - pos + pos / 2) / (np * nn)) AS roc_auc
  FROM {src}_c WHERE np > 0 AND nn > 0 GROUP BY g)"""


def metrics_sql(src: str, by: str) -> str:
    return f"""{area_sql(src, by)},
conf AS (
  SELECT {by} AS g, count(*) FILTER (y = 0 AND p < 0.5) AS tn, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
         count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 1 AND p >= 0.5) AS tp FROM {src} GROUP BY 1),
met AS (
  SELECT g, tn, fp, fn, tp, pr_auc, roc_auc,
         coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, CAST(fn * 50000 + fp * 5000 AS DOUBLE) AS cost,
         CAST((tp + fn) * 50000 - (fn * 50000 + fp * 5000) AS DOUBLE) AS saving_vs_no_model
  FROM conf LEFT JOIN areas USING (g))"""


METRIC_LIST = "tn, fp, fn, tp, " + rounded(
    ["pr_auc", "roc_auc", "recall", "precision", "f1", "cost", "saving_vs_no_model"])


def psi_numeric_sql(ref: str, cur: str, numeric, bins: int = 10) -> str:
    """UNION of (feature, psi) with bins at the reference's quantiles."""
    parts = []
    for c in numeric:
        probs = "[" + ", ".join(str(i / bins) for i in range(bins + 1)) + "]"
        parts.append(f"""
SELECT '{c}' AS feature, (
  WITH q AS (SELECT list_sort(list_distinct(quantile_cont({c}, {probs}))) AS e FROM {ref}),
  b AS (
    SELECT r, bin, count(*) AS n FROM (
      SELECT r, CASE WHEN len(e) < 2 THEN CAST(x <> e[1] AS INTEGER)
                     ELSE len(list_filter(e[2:len(e) - 1], lambda v: x >= v)) END AS bin
      FROM (SELECT 1 AS r, {c} AS x FROM {ref} WHERE {c} IS NOT NULL UNION ALL
            SELECT 0, {c} FROM {cur} WHERE {c} IS NOT NULL), q) GROUP BY 1, 2),
  s AS (
    SELECT bin, greatest(coalesce(sum(n) FILTER (r = 1), 0) / (SELECT sum(n) FROM b WHERE r = 1), 1e-4) AS rs,
           greatest(coalesce(sum(n) FILTER (r = 0), 0) / (SELECT sum(n) FROM b WHERE r = 0), 1e-4) AS cs
    FROM b GROUP BY bin)
  SELECT CASE WHEN (SELECT len(e) FROM q) < 2
    THEN (SELECT coalesce(sum(n) FILTER (bin = 1 AND r = 0), 0) / sum(n) FILTER (r = 0) FROM b) * ln(1e4)
    ELSE sum((cs - rs) * ln(cs / rs)) END FROM s) AS psi""")
    return "\nUNION ALL\n".join(parts)


def psi_categorical_sql(ref: str, cur: str, columns) -> str:
    return "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, (
  SELECT sum((cs - rs) * ln(cs / rs)) FROM (
    SELECT greatest(coalesce(r.n, 0) / (SELECT count({c}) FROM {ref}), 1e-4) AS rs,
           greatest(coalesce(k.n, 0) / (SELECT count({c}) FROM {cur}), 1e-4) AS cs
    FROM (SELECT {c} AS v, count(*) AS n FROM {ref} WHERE {c} IS NOT NULL GROUP BY 1) r
    FULL OUTER JOIN (SELECT {c} AS v, count(*) AS n FROM {cur} WHERE {c} IS NOT NULL GROUP BY 1) k USING (v))) AS psi"""
                                for c in columns)


def ks_sql(ref: str, cur: str, numeric) -> str:
    return "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, (
  SELECT max(abs(a / (SELECT count({c}) FROM {ref}) - b / (SELECT count({c}) FROM {cur}))) FROM (
    SELECT sum(sum(r)) OVER (ORDER BY x) AS a, sum(sum(1 - r)) OVER (ORDER BY x) AS b FROM (
      SELECT {c} AS x, 1 AS r FROM {ref} WHERE {c} IS NOT NULL UNION ALL
      SELECT {c}, 0 FROM {cur} WHERE {c} IS NOT NULL) GROUP BY x)) AS ks""" for c in numeric)


def ks_pvalue_sql(ref: str, cur: str, numeric) -> str:
    """(feature, p): asymptotic p-value of the largest distance."""
    sizes = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT count({c}) FROM {ref}) AS n, (SELECT count({c}) FROM {cur}) AS m" for c in numeric)
    return f"""
SELECT feature, CASE WHEN l < 0.03 THEN 1 ELSE greatest(least(list_sum(list_transform(range(1, 201),
         lambda j: CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END * exp(CAST(-2 * j * j AS DOUBLE) * l))), 1), 0) END AS p
FROM (SELECT feature, ks * ks * (CAST(n AS DOUBLE) * m / (n + m)) AS l FROM ({ks_sql(ref, cur, numeric)}) JOIN ({sizes}) USING (feature))"""


HALVES = """
lines AS (
  SELECT *, CAST(CAST(l_tax > 0.05 AS INTEGER) AS DOUBLE) AS late FROM lineitem),
ref AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1998-06-01'),
cur AS (
  SELECT * REPLACE (CASE WHEN l_quantity > 30 THEN l_extendedprice * 1.5::DOUBLE ELSE l_extendedprice END AS l_extendedprice)
  FROM lines WHERE l_shipdate >= TIMESTAMP '1998-06-01')"""
DRIFT_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "late"]
DRIFT_CATEGORICAL = ["l_returnflag", "l_linestatus"]

MONITORED = f"""WITH {PLANT_SQL}, {features_sql()}, {GRID},
flat AS (SELECT {M}, datetime, will_fail_24h, {rounded(NUMERIC)}, model FROM features_grid),
limits AS (SELECT min({RULE}) AS lo, max({RULE}) AS hi FROM flat),
ref AS (SELECT * FROM flat WHERE datetime < TIMESTAMP '2024-01-16'),
cur AS (
  SELECT *, CAST(p >= 0.5 AS INTEGER) AS prediction, will_fail_24h AS y FROM (
    SELECT f.*, round(least(greatest(({RULE} - lo) / greatest(hi - lo, 1e-9), 0), 1), 6) AS p FROM flat f, limits)
  WHERE datetime >= TIMESTAMP '2024-01-16')"""

REQUEST_LOG = """
log AS (
  SELECT event_id, ts, CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 404 ELSE 200 END AS status,
         value AS latency_ms, value / CAST(1000 AS DOUBLE) AS latency_s, CAST(event_type = 'purchase' AS INTEGER) AS flag,
         (event_id % 997) / CAST(997 AS DOUBLE) AS score
  FROM events)"""


def sliding(length_s: int, slide_s: int, ts: str = "ts") -> str:
    """Start of every window (in seconds) that holds the row, as an unnested list."""
    sec = f"CAST(floor(epoch_us({ts}) / 1000000) AS BIGINT)"
    return (f"unnest(range({sec} - {sec} % {slide_s} - {length_s} + {slide_s}, {sec} + 1, {slide_s}))")


def windowed(aggs: str, length_s: int, slide_s: int, src: str = "log", by: str = "") -> str:
    return f"""
w AS (SELECT *, {sliding(length_s, slide_s)} AS s FROM {src}),
win AS (
  SELECT make_timestamp(s * 1000000) AS window_start, make_timestamp((s + {length_s}) * 1000000) AS window_end{by}, {aggs}
  FROM w GROUP BY s{by})"""


def issues_sql(checks) -> str:
    """UNION of issue rows; a check is (table, column, name, relation, value, weight, predicate)."""
    parts = []
    for table, column, name, relation, value, predicate in checks:
        name = name.replace("'", "''")
        parts.append(f"""
SELECT '{table}' AS "table", '{column}' AS "column", '{name}' AS "check", CAST(sum(n) AS BIGINT) AS "count",
       coalesce(array_to_string(list_sort(list(v) FILTER (v IS NOT NULL AND rn <= 5)), ','), '') AS examples
FROM (SELECT v, n, row_number() OVER (ORDER BY v NULLS LAST) AS rn FROM (
  SELECT CAST({value} AS VARCHAR) AS v, count(*) AS n FROM {relation} WHERE {predicate} GROUP BY 1))
HAVING sum(n) > 0""")
    return "\nUNION ALL\n".join(parts)


def plant_issue_checks() -> list:
    out = []
    for table in ("telemetry", "errors", "maint", "failures", "machines"):
        out.append((table, "machineID", "in_range(1, 100)", table, M, f"{M} NOT BETWEEN 1 AND 100"))
    for s, (lo, hi) in S.HARD_BOUNDS.items():
        out.append(("telemetry", s, f"in_range({int(lo)}, {int(hi)})", "telemetry", s, f"{s} NOT BETWEEN {lo} AND {hi}"))
    ids = ", ".join(ERRORS)
    out.append(("errors", "errorID", f"isin({ids})", "errors", '"errorID"',
                f"""\"errorID\" NOT IN ({', '.join(f"'{e}'" for e in ERRORS)})"""))
    repeated = f"(SELECT *, count(*) OVER (PARTITION BY {M}, datetime) AS k FROM telemetry)"
    for column, value in (("machineID", M), ("datetime", "datetime")):
        out.append(("telemetry", column, "multiple_fields_uniqueness", repeated, value, "k > 1"))
    return out


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    plant = f"WITH {PLANT_SQL}"

    # features
    q["training_table"] = f"""{plant}, {features_sql()}
SELECT {M}, datetime, {rounded(NUMERIC)}, model, will_fail_24h FROM features WHERE hour(datetime) % 3 = 0"""
    q["refreshed_features"] = q["training_table"]
    q["serving_features"] = f"""{plant}, {features_sql(label=False)}
SELECT {M}, datetime, {rounded(NUMERIC)}, model FROM features"""
    q["clean_telemetry"] = f"""{plant}, {cleaned_sql()}
SELECT {M}, datetime, {', '.join(SENSORS)} FROM cleaned"""
    now = "(SELECT max(datetime) FROM telemetry)"
    q["machine_risk_ranking"] = f"""{plant}, {features_sql('all_features')},
limits AS (SELECT min({RULE}) AS lo, max({RULE}) AS hi FROM all_features WHERE hour(datetime) % 3 = 0),
{latest_features(now)}
SELECT {M}, datetime, failure_probability, CAST(failure_probability >= 0.5 AS INTEGER) AS will_fail_24h, model, age FROM (
  SELECT f.*, round(least(greatest(({RULE} - lo) / greatest(hi - lo, 1e-9), 0), 1), 6) AS failure_probability
  FROM features f, limits WHERE datetime = {now})
ORDER BY failure_probability DESC, {M} LIMIT 10"""
    q["maint_with_failures"] = f"""{plant}
SELECT datetime, {M}, comp FROM maint UNION SELECT * FROM failures"""

    # windows and as-of lookups
    stats = ", ".join(
        f"round(avg(value) OVER (w {frame(h)}), 6) AS value_mean_{h}h, "
        f"round(coalesce(stddev_samp(value) OVER (w {frame(h)}), 0), 6) AS value_std_{h}h, "
        f"round(sum(value) OVER (w {frame(h)}), 6) AS value_sum_{h}h, count(value) OVER (w {frame(h)}) AS value_count_{h}h"
        for h in (3, 24))
    q["rolling_stats"] = f"SELECT event_id, {stats} FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)"
    sparse = "(SELECT event_id, user_id, ts, CASE WHEN event_id % 5 < 2 THEN value END AS value FROM events)"
    for name, rows in (("ffill_limited", "3"), ("ffill_unlimited", "UNBOUNDED")):
        q[name] = f"""SELECT event_id, last_value(value IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW) AS value FROM {sparse}"""
    dedup = f"SELECT * FROM telemetry QUALIFY row_number() OVER (PARTITION BY {M}, datetime ORDER BY seq DESC) = 1"
    q["dedup_keep_last"] = f"{plant} {dedup}"
    q["latest_per_key"] = """SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
    q["first_seen"] = "SELECT user_id, min(ts) AS first_seen FROM events GROUP BY 1"
    q["full_history"] = """SELECT event_id, user_id, ts FROM events
QUALIFY ts >= min(ts) OVER (PARTITION BY user_id) + INTERVAL 23 HOUR"""
    q["gap_check"] = f"""{plant}, d AS ({dedup})
SELECT {M}, datetime, CAST(datetime - lag(datetime) OVER (PARTITION BY {M} ORDER BY datetime) <> INTERVAL 1 HOUR AS INTEGER) AS gap
FROM d"""
    q["time_cuts"] = """WITH t AS (SELECT DISTINCT ts FROM events),
r AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS n FROM t)
SELECT max(ts) FILTER (i = floor(n * 0.5)) AS cut0, max(ts) FILTER (i = floor(n * 0.75)) AS cut1 FROM r"""
    q["label_forward"] = """SELECT event_id, CAST(EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase'
  AND p.user_id = e.user_id AND p.ts > e.ts AND p.ts <= e.ts + INTERVAL 24 HOUR) AS INTEGER) AS label FROM events e"""
    since = ", ".join(
        f"""round(coalesce(least((epoch_us(e.ts) - epoch_us((SELECT max(p.ts) FROM events p WHERE p.event_type = '{c}'
  AND p.user_id = e.user_id AND p.ts <= e.ts))) / CAST(86400000000 AS DOUBLE), 7), 7), 6) AS days_since_{c}"""
        for c in ("signup", "purchase", "refund"))
    q["last_event_asof"] = f"SELECT event_id, {since} FROM events e"
    pivot = ", ".join(f"count(*) FILTER (\"errorID\" = '{e}') AS {e}" for e in ERRORS)
    q["pivot_counts"] = f"{plant} SELECT {M}, date_trunc('hour', datetime) AS datetime, {pivot} FROM errors GROUP BY 1, 2"
    counted = ", ".join(f"coalesce({e}, 0) AS {e}" for e in ERRORS)
    q["attach_hourly_counts"] = f"""{plant},
h AS (SELECT {M}, date_trunc('hour', datetime) AS datetime, {pivot} FROM errors GROUP BY 1, 2)
SELECT {M}, datetime, {counted} FROM (SELECT DISTINCT {M}, datetime FROM telemetry) LEFT JOIN h USING ({M}, datetime)"""
    q["attach_dimension"] = """SELECT o_orderkey, o_custkey AS c_custkey, c_mktsegment, c_nationkey
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
    q["unknown_keys"] = """SELECT DISTINCT k FROM (SELECT l_suppkey AS k FROM lineitem UNION ALL SELECT c_custkey FROM customer)
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = k)"""
    q["before_first"] = """SELECT l_orderkey, l_linenumber, l_shipdate AS ts FROM lineitem
WHERE l_shipdate < (SELECT min(ts) FROM events)"""

    # splits, slices, samples
    ranges = {"train": ("1995-01-01", "1998-01-01"), "val": ("1998-01-01", "1999-06-01"), "test": ("1999-06-01", "2003-01-01")}
    case = "CASE " + " ".join(
        f"WHEN o_orderdate >= TIMESTAMP '{a}' AND o_orderdate < TIMESTAMP '{b}' THEN '{n}'" for n, (a, b) in ranges.items()) + " END"
    q["split_summary"] = f"""WITH s AS (SELECT {case} AS split, o_orderdate AS t FROM orders),
g AS (SELECT split, count(*) AS n, min(t) AS first_ts, max(t) AS last_ts,
             list_position(['train', 'val', 'test'], split) AS place FROM s WHERE split IS NOT NULL GROUP BY 1)
SELECT split, n, first_ts, last_ts, place, CAST(coalesce(lag(last_ts) OVER (ORDER BY place) >= first_ts, false) AS INTEGER) AS overlap
FROM g"""
    q["split_parts"] = f"SELECT o_orderkey, o_orderdate, {case} AS split FROM orders WHERE {case} IS NOT NULL"
    near = f"datetime BETWEEN {AS_OF} - INTERVAL 23 HOUR AND {AS_OF}"
    q["history_slice"] = f"""{plant}
SELECT 'telemetry' AS kind, {M}, datetime FROM telemetry WHERE {near}
UNION ALL SELECT 'errors', {M}, datetime FROM errors WHERE {near}
UNION ALL SELECT 'maint', {M}, datetime FROM maint WHERE datetime <= {AS_OF}
UNION ALL SELECT 'failures', {M}, datetime FROM failures WHERE datetime <= {AS_OF}"""
    q["latest_readings"] = f"""{plant}
SELECT {M}, datetime, seq, {', '.join(SENSORS)} FROM telemetry WHERE datetime = (SELECT max(datetime) FROM telemetry)"""
    q["hour_grid"] = "SELECT event_id, ts FROM events WHERE hour(ts) % 3 = 0"
    q["seeded_sample"] = """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY md5(l_orderkey || '|' || l_linenumber || '|42'), l_orderkey, l_linenumber, l_quantity LIMIT 5000"""
    inside = "datetime >= TIMESTAMP '2024-01-15' AND datetime < TIMESTAMP '2024-01-20'"
    scaled = ", ".join(
        f"round(CASE WHEN {inside} THEN {c} * CAST({f} AS DOUBLE) ELSE {c} END, 6) AS {c}"
        for c, f in (("volt", 1.1), ("rotate", 1.0), ("pressure", 1.15), ("vibration", 1.2)))
    q["scaled_sensors"] = f"{plant} SELECT {M}, datetime, seq, {scaled} FROM telemetry"
    q["relabelled_lines"] = """WITH cut AS (
  SELECT quantile_cont(l_extendedprice, 0.93) AS c FROM lineitem WHERE l_returnflag IN ('A', 'R'))
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'R') AND l_extendedprice >= c THEN 1
  ELSE CAST(l_discount > 0.09 AS INTEGER) END AS label FROM lineitem, cut"""
    q["normalized_values"] = """WITH n AS (
  SELECT event_id, value, CASE WHEN event_id % 10 > 1 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS number
  FROM events)
SELECT event_id, number, least(greatest(coalesce(number, 50), 20), 80) AS clipped,
       CASE WHEN event_id % 7 = 0 THEN 0 ELSE value END AS finite, CAST(value >= 50 AS INTEGER) AS flag FROM n"""

    # validation
    missing_share = "\nUNION ALL\n".join(
        f"SELECT 'telemetry' AS \"table\", '{s}' AS \"column\", 'sensor null fraction > 5%' AS \"check\", CAST(1 AS BIGINT) AS \"count\", "
        f"'' AS examples FROM telemetry HAVING avg(CAST({s} IS NULL AS INTEGER)) > 0.05" for s in SENSORS)
    q["validate_plant"] = f"{plant}\n{issues_sql(plant_issue_checks())}\nUNION ALL\n{missing_share}"
    k = f"({M} * 7 + hour(datetime) + day(datetime) * 24)"
    corrupted = f"""{plant},
tel AS (
  SELECT CASE WHEN {k} % 233 <> 0 THEN datetime END AS datetime, CASE WHEN {k} % 229 = 0 THEN 999 ELSE {M} END AS {M},
         CASE WHEN {k} % 211 = 0 THEN 'sensor_error' ELSE CAST(volt AS VARCHAR) END AS volt, CASE WHEN {k} % 227 = 0 THEN 5000 ELSE rotate END AS rotate,
         CASE WHEN {k} % 9 <> 0 THEN pressure END AS pressure, CASE WHEN {k} % 223 = 0 THEN -5 ELSE vibration END AS vibration FROM telemetry),
mach AS (SELECT {M}, CASE WHEN {M} % 17 <> 0 THEN model END AS model, CASE WHEN {M} % 13 = 0 THEN 31 ELSE age END AS age FROM machines),
plants AS (SELECT * FROM mach UNION ALL SELECT * FROM mach WHERE {M} % 10 = 0)"""
    broken = [("telemetry", "machineID", "in_range(1, 100)", "tel", M, f"{M} NOT BETWEEN 1 AND 100"),
              ("telemetry", "datetime", "not_nullable", "tel", "datetime", "datetime IS NULL"),
              ("telemetry", "volt", "dtype('double')", "tel", "volt", "volt IS NOT NULL AND TRY_CAST(volt AS DOUBLE) IS NULL")]
    broken += [("telemetry", s, f"in_range({int(lo)}, {int(hi)})", "tel", s, f"TRY_CAST({s} AS DOUBLE) NOT BETWEEN {lo} AND {hi}") for s, (lo, hi) in S.HARD_BOUNDS.items()]
    twice = f"(SELECT *, count(*) OVER (PARTITION BY {M}, datetime) AS k FROM tel)"
    broken += [("telemetry", c, "multiple_fields_uniqueness", twice, v, "k > 1") for c, v in (("machineID", M), ("datetime", "datetime"))]
    broken += [c for c in plant_issue_checks() if c[0] == "errors"]
    broken += [("machines", "machineID", "in_range(1, 100)", "plants", M, f"{M} NOT BETWEEN 1 AND 100"), ("machines", "age", "in_range(0, 30)", "plants", "age", "age NOT BETWEEN 0 AND 30"),
               ("machines", "model", "not_nullable", "plants", "model", "model IS NULL"),
               ("machines", "machineID", "field_uniqueness", f"(SELECT *, count(*) OVER (PARTITION BY {M}) AS k FROM plants)", M, "k > 1"),
               ("telemetry", "machineID", "unknown machine (not in machines table)", f"(SELECT DISTINCT {M} FROM tel WHERE {M} NOT IN (SELECT {M} FROM plants))", M, "true")]
    shares = "\nUNION ALL\n".join(
        f"SELECT 'telemetry' AS \"table\", '{s}' AS \"column\", 'sensor null fraction > 5%' AS \"check\", CAST(1 AS BIGINT) AS \"count\", "
        f"'' AS examples FROM tel HAVING avg(CAST({s} IS NULL AS INTEGER)) > 0.05" for s in SENSORS)
    q["validate_corrupted"] = f"""{corrupted}
{issues_sql(broken)}
UNION ALL {shares}
UNION ALL SELECT 'maint', 'comp', 'column missing', 1, 'comp'
UNION ALL SELECT 'failures', NULL, 'table missing', 1, ''"""
    q["staged_validation"] = q["validate_corrupted"]
    q["validation_report"] = f'SELECT "table", "column", "check", "count" FROM ({q["validate_corrupted"]})'
    q["null_fractions"] = f"{plant}\n" + "\nUNION ALL\n".join(
        f"SELECT '{s}' AS \"column\", round(avg(CAST({s} IS NULL AS INTEGER)), 6) AS fraction FROM telemetry" for s in SENSORS)
    q["duplicate_groups"] = f"{plant} SELECT {M}, datetime, count(*) AS n FROM telemetry GROUP BY 1, 2 HAVING count(*) > 1"
    joined = f"(SELECT t.*, 'model' || (c_nationkey % 5 + 1) AS model FROM telemetry t LEFT JOIN customer ON {M} = c_custkey)"
    rules = [("features", s, "finite", joined, s, f"{s} IS NULL") for s in SENSORS]
    rules.append(("features", "model", f"isin({', '.join(S.MODELS)})", joined, "model", f"model IS NULL OR model NOT IN ({', '.join(repr(m) for m in S.MODELS)})"))
    q["validate_feature_values"] = f"{plant}\n{issues_sql(rules)}"

    # metrics
    q["classification_metrics"] = f"{SCORED}, {metrics_sql('scored', 'CAST(1 AS INTEGER)')} SELECT {METRIC_LIST} FROM met"
    q["metrics_by_model"] = f"{SCORED}, {metrics_sql('scored', 'model')} SELECT g AS model, {METRIC_LIST} FROM met"
    sweep = """sweep AS (
  SELECT {by}t AS threshold, count(*) FILTER (y = 0 AND p < t) AS tn, count(*) FILTER (y = 0 AND p >= t) AS fp,
         count(*) FILTER (y = 1 AND p < t) AS fn, count(*) FILTER (y = 1 AND p >= t) AS tp
  FROM scored, (SELECT unnest(range(2, 99)) / CAST(100 AS DOUBLE) AS t) GROUP BY ALL),
rated AS (
  SELECT *, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
         CAST(fn * 50000 + fp * 5000 AS DOUBLE) AS cost FROM sweep)"""
    q["threshold_sweep"] = f"""{SCORED}, {sweep.format(by='')}
SELECT threshold, tn, fp, fn, tp, {rounded(['recall', 'precision', 'cost'])} FROM rated"""
    q["choose_threshold"] = f"""{SCORED}, {sweep.format(by='model, ')}
SELECT model, threshold, {rounded(['cost', 'recall', 'precision'])}, CAST(recall >= 0.6 AND precision >= 0.01 AS INTEGER) AS meets_minimum
FROM rated QUALIFY row_number() OVER (PARTITION BY model
  ORDER BY CAST(recall >= 0.6 AND precision >= 0.01 AS INTEGER) DESC, cost, threshold) = 1"""
    q["gate_checks"] = f"""{SCORED}, {metrics_sql('scored', 'model')},
all_rows AS (SELECT 1 AS one, y, p FROM scored),
{area_sql('all_rows', 'one').replace('areas AS', 'champion AS')}
SELECT g AS model_version, c.name, round(c.value, 6) AS value, CAST(c.passed AS INTEGER) AS passed FROM (
  SELECT g, unnest([
    {{'name': 'recall', 'value': recall, 'passed': recall >= 0.3}},
    {{'name': 'precision', 'value': precision, 'passed': precision >= 0.05}},
    {{'name': 'p95_latency_ms', 'value': 12.0, 'passed': true}},
    {{'name': 'model_size_mb', 'value': 60.0, 'passed': false}},
    {{'name': 'pr_auc_vs_champion', 'value': pr_auc, 'passed': pr_auc >= (SELECT pr_auc FROM champion)}}]) AS c FROM met)"""
    q["positive_rate"] = f"""{SCORED}
SELECT model, count(*) AS n, round(avg(y), 6) AS positive_rate,
       round(count(*) FILTER (y = 0) / greatest(count(*) FILTER (y = 1), 1), 6) AS class_ratio FROM scored GROUP BY model"""
    q["value_range"] = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, min({c}) AS lo, max({c}) AS hi FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount"))
    q["exact_quantile_table"] = "\nUNION ALL\n".join(
        f"SELECT l_returnflag, '{c}' AS feature, "
        + ", ".join(f"round(quantile_cont({c}, {p}), 6) AS q{i}" for i, p in enumerate((0.05, 0.5, 0.93)))
        + " FROM lineitem GROUP BY 1" for c in ("l_quantity", "l_extendedprice"))
    q["slo_summary"] = f"""WITH {REQUEST_LOG},
a AS (SELECT count(*) AS requests, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS wall,
             quantile_cont(latency_ms, [0.5, 0.95, 0.99]) AS q, count(*) FILTER (status >= 500) AS e5,
             count(*) FILTER (status >= 400 AND status < 500) AS client_errors_4xx FROM log),
r AS (SELECT requests, round(wall, 2) AS wall_seconds, round(requests / wall, 1) AS throughput_rps, round(q[1], 2) AS p50_ms,
             round(q[2], 2) AS p95_ms, round(q[3], 2) AS p99_ms, round(e5 / requests, 4) AS error_rate, client_errors_4xx FROM a)
SELECT *, CAST(p95_ms < 100 AS INTEGER) AS latency_met, CAST(error_rate < 0.01 AS INTEGER) AS errors_met,
       CAST(p95_ms < 100 AND error_rate < 0.01 AS INTEGER) AS slo_met FROM r"""

    # drift and monitoring
    q["psi_numeric"] = f"WITH {HALVES} SELECT feature, round(psi, 6) AS psi FROM ({psi_numeric_sql('ref', 'cur', DRIFT_NUMERIC)})"
    q["psi_categorical"] = f"WITH {HALVES} SELECT feature, round(psi, 6) AS psi FROM ({psi_categorical_sql('ref', 'cur', DRIFT_CATEGORICAL)})"
    q["ks_distance"] = f"WITH {HALVES} SELECT feature, round(ks, 6) AS ks FROM ({ks_sql('ref', 'cur', DRIFT_NUMERIC)})"
    q["value_shares"] = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {c} AS value, round(count(*) / (SELECT count({c}) FROM lineitem), 6) AS share FROM lineitem GROUP BY 2"
        for c in DRIFT_CATEGORICAL)
    q["drift_summary"] = f"""WITH {HALVES},
t AS ({psi_numeric_sql('ref', 'cur', DRIFT_NUMERIC)} UNION ALL {psi_categorical_sql('ref', 'cur', DRIFT_CATEGORICAL)})
SELECT round(avg(CAST(psi > 0.02 AS INTEGER)), 3) AS drift_share, CAST(avg(CAST(psi > 0.02 AS INTEGER)) >= 0.1 AS INTEGER) AS data_drift,
       string_agg(feature, ',' ORDER BY round(psi, 4) DESC, feature) FILTER (psi > 0.02) AS drifted_features FROM t"""
    q["live_performance"] = f"""{SCORED}, {metrics_sql('scored', 'CAST(1 AS INTEGER)')}
SELECT tn + fp + fn + tp AS n_labelled, tp + fn AS positives, {rounded(['recall', 'precision', 'pr_auc'])} FROM met WHERE tp + fn > 0"""
    drift_union = f"{psi_numeric_sql('ref', 'cur', NUMERIC)} UNION ALL {psi_categorical_sql('ref', 'cur', ['model'])}"
    q["feature_drift"] = f"""{MONITORED}, i AS ({drift_union}), pv AS ({ks_pvalue_sql('ref', 'cur', NUMERIC)})
SELECT feature, round(psi, 4) AS psi, round(p, 4) AS ks_pvalue, CAST(psi > 0.2 AS INTEGER) AS drifted FROM i LEFT JOIN pv USING (feature)"""
    q["monitoring_report"] = f"""{MONITORED}, {metrics_sql('cur', 'CAST(1 AS INTEGER)')},
t AS ({drift_union}),
d AS (SELECT avg(CAST(psi > 0.2 AS INTEGER)) AS share FROM t)
SELECT 'plant' AS name, (SELECT count(*) FROM cur) AS rows, tn + fp + fn + tp AS n_labelled, tp + fn AS positives,
       CASE WHEN share >= 0.3 AND recall < 0.7 THEN 'data_and_concept_drift' WHEN recall < 0.7 THEN 'concept_drift'
            WHEN share >= 0.3 THEN 'data_drift' ELSE 'no_drift' END AS status,
       round(share, 3) AS drift_share, (SELECT round(avg(prediction), 4) FROM cur) AS predicted_positive_rate,
       {rounded(['recall', 'precision', 'pr_auc'])}, CAST(share >= 0.3 AS INTEGER) AS data_drift,
       CAST(recall < 0.7 AS INTEGER) AS concept_drift, CAST(share >= 0.3 OR recall < 0.7 AS INTEGER) AS retrain
FROM met, d"""
    q["retrain_splits"] = f"""{MONITORED},
t AS (SELECT datetime AS ts, row_number() OVER (ORDER BY datetime) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT datetime FROM cur)),
c AS (SELECT max(ts) FILTER (i = floor(n * 0.5)) AS c1, max(ts) FILTER (i = floor(n * 0.75)) AS c2 FROM t),
u AS (
  SELECT 'train' AS split, CAST(1 AS DOUBLE) AS sample_weight, datetime, will_fail_24h FROM ref WHERE datetime < (SELECT min(datetime) FROM cur)
  UNION ALL
  SELECT CASE WHEN datetime < c1 THEN 'train' WHEN datetime < c2 THEN 'val' ELSE 'test' END,
         CASE WHEN datetime < c1 THEN CAST(5 AS DOUBLE) END, datetime, will_fail_24h FROM cur, c)
SELECT split, sample_weight, count(*) AS n, min(datetime) AS first_ts, max(datetime) AS last_ts,
       CAST(sum(will_fail_24h) AS BIGINT) AS positives FROM u GROUP BY 1, 2"""
    day_value = """
e AS (SELECT list_sort(list_distinct(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM ref),
binned AS (
  SELECT 'value' AS feature, date_trunc('day', ts) AS d, ts < TIMESTAMP '2024-01-08' AS r,
         CAST(len(list_filter(e[2:len(e) - 1], lambda v: value >= v)) AS VARCHAR) AS bin FROM events, e
  UNION ALL SELECT 'event_type', date_trunc('day', ts), ts < TIMESTAMP '2024-01-08', event_type FROM events)"""
    q["drift_per_day"] = f"""WITH ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-08'), {day_value},
rs AS (SELECT feature, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS r FROM binned WHERE r GROUP BY 1, 2),
ds AS (SELECT feature, d, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature, d) AS c FROM binned GROUP BY 1, 2, 3),
cells AS (SELECT DISTINCT a.feature, a.d, b.bin FROM ds a JOIN (SELECT DISTINCT feature, bin FROM binned) b USING (feature)),
f AS (SELECT feature, d, greatest(coalesce(r, 0), 1e-4) AS r, greatest(coalesce(c, 0), 1e-4) AS c
      FROM cells LEFT JOIN rs USING (feature, bin) LEFT JOIN ds USING (feature, d, bin))
SELECT d AS window_start, feature, round(sum((c - r) * ln(c / r)), 6) AS psi FROM f GROUP BY 1, 2"""

    # requests and logs
    tel_slice = f"SELECT * FROM telemetry WHERE {near}"
    q["request_readings"] = f"{plant} SELECT {M}, datetime, {', '.join(SENSORS)} FROM ({tel_slice})"
    has_request = f"{M} IN (SELECT {M} FROM telemetry WHERE {near})"
    q["request_services"] = f"""{plant}, s AS (SELECT datetime, {M}, comp FROM maint UNION SELECT * FROM failures)
SELECT max(datetime) AS datetime, {M}, comp FROM s WHERE datetime <= {AS_OF} AND {has_request} GROUP BY 2, 3"""
    q["request_errors"] = f"{plant} SELECT datetime, {M}, \"errorID\" FROM errors WHERE {near} AND {has_request}"
    reasons = f"""
b AS (SELECT *, datetime - lag(datetime) OVER (PARTITION BY {M} ORDER BY datetime) <> INTERVAL 1 HOUR AS gap FROM ({tel_slice})),
g AS (SELECT {M}, count(*) AS n, bool_or(coalesce(gap, false)) AS gap,
        count(*) FILTER (volt IS NULL OR rotate IS NULL OR pressure IS NULL OR vibration IS NULL) AS e FROM b GROUP BY 1),
j AS (SELECT {M}, bool_or("errorID" = 'error6') AS code FROM errors WHERE {near} GROUP BY 1),
k AS (SELECT s.{M}, bool_or(s.datetime > t.last) AS future FROM (SELECT datetime, {M} FROM maint UNION SELECT datetime, {M} FROM failures) s
      JOIN (SELECT {M}, max(datetime) AS last FROM ({tel_slice}) GROUP BY 1) t USING ({M}) WHERE s.datetime <= {AS_OF} GROUP BY 1),
reasons AS (
  SELECT {M}, concat_ws(',', CASE WHEN n < 24 OR n > 168 THEN 'history_length' END,
    CASE WHEN gap THEN 'hourly_order' END, CASE WHEN e > n // 4 THEN 'missing_readings' END, CASE WHEN code THEN 'error_code' END,
    CASE WHEN future THEN 'service_in_future' END) AS reasons
  FROM g LEFT JOIN j USING ({M}) LEFT JOIN k USING ({M}))"""
    q["rejected_requests"] = f"{plant}, {reasons} SELECT {M}, reasons FROM reasons WHERE reasons <> ''"
    q["request_features"] = f"""{plant}, {reasons}, {latest_features(AS_OF)}
SELECT {M}, datetime, {rounded(NUMERIC)}, model FROM features
WHERE {M} IN (SELECT {M} FROM reasons WHERE reasons = '') QUALIFY row_number() OVER (PARTITION BY {M} ORDER BY datetime DESC) = 1"""
    score = f"least(greatest(({RULE} - 30) / 21, 0), 1)"
    q["score_all"] = f"""{plant}, {latest_features(now)}
SELECT {M}, datetime, round({score}, 6) AS failure_probability, CAST({score} >= 0.5 AS INTEGER) AS will_fail_24h,
       '7' AS model_version, model, age FROM features WHERE datetime = {now}"""
    q["prediction_log_window"] = f"""{plant}, {latest_features(now)}
SELECT {M} AS machine_id, datetime AS as_of, CAST({score} >= 0.5 AS INTEGER) AS prediction, round({score}, 4) AS probability,
       CASE WHEN {M} % 3 <> 0 THEN CAST({M} % 2 = 0 AS INTEGER) END AS will_fail_24h, {rounded(NUMERIC)}, model, '7' AS model_version
FROM features WHERE datetime = {now}"""
    columns = {"region": "r_regionkey,r_name",
               "nation": "n_nationkey,n_name,n_regionkey",
               "customer": "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment",
               "supplier": "s_suppkey,s_name,s_nationkey,s_acctbal",
               "part": "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice",
               "orders": "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority",
               "lineitem": "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate",
               "events": "event_id,ts,user_id,event_type,value,props",
               "documents": "doc_id,text,lang,source,n_chars",
               "embeddings": "vec_id,embedding,label",
               "pages": "page_id,url,html",
               "benchmark": "item_id,text",
               "labels": "doc_id,quality,toxic",
               "conversations": "conv_id,turn,role,text"}
    q["table_summary"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows, '{c}' AS columns FROM {t}" for t, c in columns.items())
    parts = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                        for c in sorted(columns["customer"].split(",")))
    q["table_version"] = f"""WITH h AS (SELECT CAST('0x' || substr(md5({parts}), 1, 15) AS BIGINT) AS h FROM customer)
SELECT count(*) AS n_rows, substr(md5('c_acctbal:double,c_custkey:bigint,c_mktsegment:string,c_name:string,c_nationkey:int' || '|' || count(*) || '|' || CAST(sum(h) AS VARCHAR) || '|' || CAST(bit_xor(h) AS VARCHAR)), 1, 12) AS version FROM h"""
    def answers(prefix: str) -> str:
        return f"""{plant}, {reasons}, {latest_features(AS_OF)},
newest AS (SELECT * FROM features WHERE {M} IN (SELECT {M} FROM reasons WHERE reasons = '') QUALIFY row_number() OVER (PARTITION BY {M} ORDER BY datetime DESC) = 1)
SELECT '{prefix}-' || r.{M} AS request_id, r.{M}, CASE WHEN n.{M} IS NOT NULL THEN round({score}, 6) END AS probability,
       CASE WHEN n.{M} IS NOT NULL THEN 'scored' ELSE 'refused' END AS state
FROM reasons r LEFT JOIN newest n ON r.{M} = n.{M}"""

    early = answers("early").replace("2024-01-20 06:00:00", "2024-01-20 00:00:00")
    q["score_requests"] = f"SELECT * FROM ({answers('late')}) UNION ALL SELECT * FROM ({early})"
    q["repeated_request_ids"] = f"""WITH named AS (
  SELECT a.*, r.reasons = '' AS valid, CASE WHEN a.{M} % 5 = 0 THEN 'shared-' || (a.{M} // 10) ELSE 'own-' || a.{M} END AS id
  FROM ({answers('late')}) a JOIN ({plant}, {reasons} SELECT {M}, reasons FROM reasons) r ON r.{M} = a.{M}),
clash AS (SELECT *, count(*) OVER (PARTITION BY id) > 1 AS shared FROM named)
SELECT id AS request_id, {M}, CASE WHEN NOT shared THEN probability END AS probability, CAST(shared AND valid AS INTEGER) AS ambiguous
FROM (SELECT * FROM clash UNION ALL SELECT * FROM clash WHERE {M} % 3 = 0)"""
    q["log_without_feedback"] = f"""{plant}, {latest_features(now)}
SELECT {M} AS machine_id, CAST({score} >= 0.5 AS INTEGER) AS prediction, round({score}, 4) AS probability,
       CAST(NULL AS INTEGER) AS will_fail_24h FROM features WHERE datetime = {now}"""
    q["grouped_areas"] = """WITH o AS (
  SELECT o_totalprice / 600000 AS p, CAST(o_orderkey % 3 = 0 AS INTEGER) AS y, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS a,
         CASE WHEN o_orderkey % 2 = 0 THEN 'x' END AS b FROM orders),
c AS (SELECT a, b, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM o GROUP BY 1, 2, 3),
r AS (SELECT *, sum(pos) OVER w AS pr, sum(neg) OVER w AS nr, sum(pos) OVER (PARTITION BY a, b) AS pa, sum(neg) OVER (PARTITION BY a, b) AS na
      FROM c WINDOW w AS (PARTITION BY a, b ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
s AS (SELECT a, b, sum(pos / pa * (pr / (pr + nr))) AS pr_auc, sum(neg * (pr - pos + pos / 2) / (pa * na)) AS roc_auc FROM r GROUP BY 1, 2),
t AS (SELECT a, b, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp FROM o GROUP BY 1, 2)
SELECT t.a, t.b, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc, tp, fp FROM t JOIN s ON t.a IS NOT DISTINCT FROM s.a AND t.b IS NOT DISTINCT FROM s.b"""

    # windowed service statistics
    q["request_rate"] = f"WITH {REQUEST_LOG}, {windowed('count(*) AS requests', 60, 60, by=', status')} SELECT * FROM win"
    q["latency_quantiles"] = f"""WITH {REQUEST_LOG},
{windowed('count(*) AS requests, quantile_disc(latency_s, 0.5) AS p50, quantile_disc(latency_s, 0.95) AS p95', 300, 15)}
SELECT *, CAST(p95 > 0.1 AS INTEGER) AS breach FROM win"""
    q["error_share"] = f"""WITH {REQUEST_LOG},
{windowed('count(*) AS requests, count(*) FILTER (status >= 500) AS errors', 300, 15)}
SELECT window_start, window_end, requests, errors, round(errors / requests, 6) AS share, CAST(errors / requests > 0.01 AS INTEGER) AS breach FROM win"""
    flags = windowed("count(*) AS predictions, count(*) FILTER (flag = 1) AS flagged", 3600, 60)
    q["flag_share"] = f"""WITH {REQUEST_LOG}, {flags}
SELECT window_start, window_end, predictions, flagged, round(flagged / predictions, 6) AS share,
       CAST(flagged / predictions > 0.3 AS INTEGER) AS breach FROM win"""
    q["held_breaches"] = f"""WITH {REQUEST_LOG}, {flags},
h AS (SELECT window_end, flagged / predictions AS share, count(*) FILTER (flagged / predictions > 0.3) OVER (
        ORDER BY window_end RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) AS k FROM win)
SELECT window_end, round(share, 6) AS share FROM h WHERE k = 11"""
    buckets = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
    b = ", ".join(f"count(*) FILTER (score <= CAST({v} AS DOUBLE)) AS b{i}" for i, v in enumerate(buckets))
    q["score_distribution"] = f"""WITH {REQUEST_LOG},
{windowed(f'count(score) AS n, round(quantile_disc(score, 0.5), 6) AS median, round(quantile_disc(score, 0.9), 6) AS p90, {b}', 3600, 3600)}
SELECT * EXCLUDE (window_end) FROM win"""
    q["late_feedback"] = """SELECT event_id AS request_id, CAST(event_type = 'purchase' AS INTEGER) AS flag,
  CASE WHEN event_id % 4 <> 0 AND event_id % 60 <= 48 THEN CAST(event_id % 2 = 0 AS INTEGER) END AS label FROM events"""
    q["stream_request_rate"] = """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status, count(*) AS requests FROM events
GROUP BY ALL"""
    for name in ("error_share", "latency_quantiles"):
        q[f"stream_{name}"] = q[name]
    q["stream_held_alerts"] = q["held_breaches"]
    q["stream_dedup"] = "SELECT event_id, user_id, event_type FROM events"
    q["stream_dedup_repeats"] = "SELECT DISTINCT user_id, date_trunc('hour', ts) AS hour FROM events"
    return q
