"""SQL counterparts of the queries, written for DuckDB on the same tables."""

PI = "CAST(3.14159 AS DOUBLE)"


def total(column):
    """Sum of a two-digit column, independent of the order of addition."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(column):
    return f"({total(column)} / count({column}))"


ORDER_READINGS = """(
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS profile_type,
           o_orderdate + to_hours(o_orderkey % 24) AS ts, o_totalprice AS load
    FROM orders)"""

EVENT_READINGS = """(
    SELECT event_id, CAST(user_id AS VARCHAR) AS customer_id, event_type AS profile_type,
           ts, value AS load
    FROM events)"""

HOURLY_READINGS = f"(SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM {EVENT_READINGS})"


def system(source):
    return f"""(
        SELECT CAST(ts AS TIMESTAMP) AS full_timestamp, {total('load')} AS total_system_load,
               {mean('load')} AS avg_system_load, max(load) AS max_system_load,
               min(load) AS min_system_load, count(customer_id) AS active_customers,
               strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INT) AS hour,
               CAST(month(ts) AS INT) AS month, CAST(year(ts) AS INT) AS year,
               CAST(dayofweek(ts) + 1 AS INT) AS dayofweek
        FROM {source} GROUP BY ts)"""


def daily_energy(source):
    return f"""(
        SELECT *, CAST(date AS TIMESTAMP) AS "timestamp",
               CAST(month(CAST(date AS DATE)) AS INT) AS month,
               CAST(year(CAST(date AS DATE)) AS INT) AS year,
               CAST(dayofweek(CAST(date AS DATE)) + 1 AS INT) AS dayofweek
        FROM (SELECT date, {total('total_system_load')} AS total_daily_energy,
                     {mean('total_system_load')} AS avg_daily_load,
                     max(total_system_load) AS peak_daily_load,
                     min(total_system_load) AS min_daily_load,
                     CAST(sum(active_customers) AS BIGINT) AS total_daily_customers,
                     CAST(sum(active_customers) AS DOUBLE) / count(*) AS avg_daily_customers
              FROM {system(source)} GROUP BY date))"""


def daily_readings(source, where="true"):
    return f"""(
        SELECT CAST(ts AS DATE) AS date, {total('load')} AS total_daily_energy,
               {mean('load')} AS avg_daily_load, max(load) AS peak_daily_load,
               count(DISTINCT customer_id) AS customer_count, count(*) AS record_count,
               CAST(year(CAST(ts AS DATE)) AS INT) AS year,
               CAST(month(CAST(ts AS DATE)) AS INT) AS month,
               strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_str
        FROM {source} WHERE {where} GROUP BY CAST(ts AS DATE))"""


def seasonal_daily(source, year, low, high):
    return f"""(
        SELECT CAST(ts AS DATE) AS date, {mean('load')} AS avg_load_percentage,
               min(load) AS min_load_percentage, max(load) AS max_load_percentage,
               count(*) AS record_count, CAST(month(CAST(ts AS DATE)) AS INT) AS month,
               CAST(day(CAST(ts AS DATE)) AS INT) AS day,
               CAST(dayofweek(CAST(ts AS DATE)) AS INT) AS day_of_week
        FROM {source} WHERE year(ts) = {year} AND month(ts) BETWEEN {low} AND {high}
        GROUP BY CAST(ts AS DATE))"""


def frame_mean(column, span):
    frame = f"(ORDER BY date ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW)"
    return (f"CAST(sum(CAST({column} AS DECIMAL(18,2))) OVER {frame} AS DOUBLE)"
            f" / count({column}) OVER {frame}")


def history(fallback):
    column = "total_daily_energy"
    lag = lambda k: f"lag({column}, {k}) OVER (ORDER BY date)"
    wrap = (lambda x: f"coalesce({x}, {column})") if fallback else (lambda x: x)
    week = "OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    parts = [f"{wrap(lag(k))} AS energy_lag_{k}" for k in (1, 2, 3, 7)]
    parts += [f"{frame_mean(column, k)} AS rolling_avg_{k}d" for k in (3, 7, 30)]
    parts += [f"max({column}) {week} AS rolling_max_7d", f"min({column}) {week} AS rolling_min_7d"]
    return ", ".join(parts)


CALENDAR = f"""
    round(sin(month * 2 * {PI} / 12), 10) AS month_sin,
    round(cos(month * 2 * {PI} / 12), 10) AS month_cos,
    round(sin(dayofweek * 2 * {PI} / 7), 10) AS dayofweek_sin,
    round(cos(dayofweek * 2 * {PI} / 7), 10) AS dayofweek_cos,
    CAST(dayofweek IN (1, 7) AS INT) AS is_weekend,
    CAST(month IN (12, 1, 2) AS INT) AS is_summer,
    CAST(month IN (6, 7, 8) AS INT) AS is_winter"""

FEATURES_ML = f"""(
    SELECT *, {CALENDAR}, peak_daily_load / nullif(avg_daily_load, 0) AS peak_to_avg_ratio,
           total_daily_energy - rolling_avg_3d AS energy_trend_3d,
           total_daily_energy - rolling_avg_7d AS energy_trend_7d
    FROM (SELECT *, {history(False)} FROM {daily_energy(ORDER_READINGS)})
    WHERE energy_lag_7 IS NOT NULL AND avg_daily_load <> 0)"""

CHRONO = f"""(
    SELECT *, CASE WHEN row_num <= train THEN 'train' WHEN row_num <= train + 15 THEN 'val'
                   ELSE 'test' END AS split
    FROM (SELECT *, n - CASE WHEN n < 90 THEN greatest(10, n // 4) ELSE 60 END - 15 AS train
          FROM (SELECT *, CAST(row_number() OVER (ORDER BY date) AS INT) AS row_num,
                       count(*) OVER () AS n
                FROM {FEATURES_ML})))"""

EVAL = f"""(
    SELECT split, row_count, sqrt(sse / row_count) AS rmse, sae / row_count AS mae,
           1.0::DOUBLE - sse / nullif(syy - sy * sy / row_count, 0) AS r2
    FROM (SELECT split, count(*) AS row_count,
                 CAST(sum((y - p) * (y - p)) AS DOUBLE) AS sse,
                 CAST(sum(abs(y - p)) AS DOUBLE) AS sae,
                 CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(y * y) AS DOUBLE) AS syy
          FROM (SELECT split, CAST(total_daily_energy AS DECIMAL(38,2)) AS y,
                       CAST(energy_lag_7 AS DECIMAL(38,2)) AS p
                FROM {CHRONO})
          GROUP BY split))"""

SEASON = """CASE WHEN month BETWEEN 1 AND 5 THEN 'spring' WHEN month BETWEEN 6 AND 9 THEN 'summer'
            WHEN month BETWEEN 10 AND 12 THEN 'autumn' ELSE 'general' END"""

WIDE_LINES = """(
    SELECT *, CASE event_type WHEN 'signup' THEN 'res_' || user_id || ',P,a,b'
                 WHEN 'error' THEN '# ' || body WHEN 'purchase' THEN ' ' || body ELSE body END AS line
    FROM (SELECT event_id, event_type, user_id, ts, CAST(dayofyear(ts) AS INT) AS day_num,
                 'res_' || user_id || ',' || CASE event_type WHEN 'view' THEN ' ' ELSE event_type END
                 || ',a,b,c,d,e,f,g,h,i,' || value || ',,' || event_id || ',NONE,' || user_id
                 || ',zz, , null, ' || value AS body
          FROM events))"""

WIDE_CELLS = f"""(
    SELECT * EXCLUDE (parts), parts[1] AS customer_id,
           CASE WHEN trim(parts[2]) <> '' THEN parts[2] END AS profile_type,
           [trim(x) FOR x IN parts[12:] IF trim(x) <> ''] AS cells
    FROM (SELECT *, string_split(line, ',') AS parts FROM {WIDE_LINES}
          WHERE starts_with(trim(line), 'res_'))
    WHERE len(parts) >= 12)"""

NUMERIC = r"'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"

# Records that the event envelopes carry: two per click, none per signup or error.
STREAM_ROWS = """
    SELECT CAST(user_id AS VARCHAR) AS customer_id, event_type AS profile_type,
           CAST(day(ts) AS INT) AS day_num, CAST(hour(ts) AS INT) AS hour,
           CAST(minute(ts) AS INT) AS minute, CAST(hour(ts) * 4 + step AS INT) AS interval_idx,
           value AS load_percentage,
           CASE WHEN event_type <> 'purchase' THEN ts END AS full_timestamp,
           'b' || event_id AS batch_id, ts AS processing_timestamp
    FROM events, (SELECT unnest([0, 1]) AS step)
    WHERE event_type NOT IN ('signup', 'error') AND (step = 0 OR event_type = 'click')"""

GATE = f"""(
    SELECT season, required, latest,
           (SELECT count(*) FROM {ORDER_READINGS}
            WHERE CAST(ts AS DATE) BETWEEN first_day AND required) AS season_rows,
           latest >= required AS available
    FROM (VALUES ('spring', DATE '2001-01-01', DATE '2001-05-31'),
                 ('summer', DATE '2001-06-01', DATE '2001-09-30'),
                 ('autumn', DATE '2001-10-01', DATE '2001-12-31')) v(season, first_day, required),
         (SELECT CAST(max(ts) AS DATE) AS latest FROM {ORDER_READINGS}))"""


def describe(column, source, by=None):
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    quantiles = ", ".join(
        f"round(quantile_cont({column}, {q}), 6) AS p{round(q * 100)}" for q in (0.25, 0.5, 0.75)
    )
    return f"""
        SELECT {keys}count({column}) AS count, {mean(column)} AS mean,
               round(stddev_samp({column}), 6) AS std, min({column}) AS min, {quantiles},
               max({column}) AS max
        FROM {source} {group}"""


DAMAGED = """(
    SELECT *, o_orderkey % 13 <> 0 AND o_orderkey % 11 = 0 AS nan,
           CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice WHEN o_orderkey % 11 = 0 THEN NULL
                WHEN o_orderkey % 7 = 0 THEN 1e13 ELSE o_totalprice END AS load
    FROM orders WHERE o_orderkey % 17 <> 0)"""
LATEST = "(SELECT max(o_orderdate) FROM orders)"
SERVING = " UNION ALL ".join(
    f"SELECT date, total_daily_energy, record_count, '{name}' AS layer, {rank} AS version"
    f" FROM {daily_readings(EVENT_READINGS, where)}"
    for rank, (name, where) in enumerate((
        ("batch", "ts < TIMESTAMP '2024-01-21'"), ("speed", "ts >= TIMESTAMP '2024-01-16'"),
    ))
)
SUBSET_EVENTS = "SELECT event_id, customer_id, profile_type, ts AS full_timestamp, load AS load_percentage"

DAY_FILE_READINGS = f"""
        SELECT customer_id, profile_type, 1 AS day_num, CAST(interval_idx AS INT) AS interval_idx,
               CAST(CAST(cell AS FLOAT) AS DOUBLE) AS load_percentage
        FROM (SELECT *, unnest(cells) AS cell, generate_subscripts(cells, 1) - 1 AS interval_idx
              FROM (SELECT *, count(*) OVER (PARTITION BY event_type, event_id // 10000) AS n
                    FROM {WIDE_CELLS}))
        WHERE regexp_matches(cell, {NUMERIC})
              AND (event_type = 'click' OR (event_type = 'purchase' AND n < 10))"""

ORACLES = {
    "wide_unpivot": f"""
        SELECT event_id, customer_id, profile_type, day_num,
               CAST(interval_idx // 4 AS INT) AS hour, CAST(interval_idx % 4 * 15 AS INT) AS minute,
               CAST(interval_idx AS INT) AS interval_idx,
               CAST(CAST(cell AS FLOAT) AS DOUBLE) AS load_percentage,
               TIMESTAMP '2016-01-01' + to_days(CAST(day_num - 1 AS INT))
                   + to_minutes(interval_idx * 15) AS full_timestamp
        FROM (SELECT *, unnest(cells) AS cell, generate_subscripts(cells, 1) - 1 AS interval_idx
              FROM {WIDE_CELLS})
        WHERE regexp_matches(cell, {NUMERIC})""",
    "file_ingest_report": f"""
        SELECT event_type, block, n + CAST(event_type <> 'view' AS INT) AS lines,
               CASE event_type WHEN 'error' THEN 0 ELSE n END AS row_lines,
               CASE WHEN event_type IN ('view', 'click', 'purchase') THEN readings ELSE 0 END
                   AS readings,
               early AS header_ok, event_type <> 'view' AS header_with_id,
               early AND event_type <> 'error' AS valid,
               early AND event_type IN ('click', 'purchase') AS loaded
        FROM (SELECT event_type, event_id // 10000 AS block, count(*) AS n,
                     4 * count(*) AS readings,
                     event_type <> 'view' AND (event_type <> 'purchase' OR count(*) < 10) AS early
              FROM {WIDE_LINES} GROUP BY event_type, event_id // 10000)""",
    "day_file_readings": DAY_FILE_READINGS,
    "ledger_ingest": DAY_FILE_READINGS,
    "discovered_files": """
        SELECT CAST(n AS INT) AS day_num, 'cyme_load_timeseries_day_' || n || '.txt' AS file_name,
               n IN (SELECT dayofyear(ts) FROM events) AS present
        FROM (SELECT unnest(generate_series(1, 60)) AS n)""",
    "written_table": """
        SELECT CAST(ts AS DATE) AS date, event_type AS profile_type,
               count(*) * copies AS record_count,
               CAST(sum(CAST(value AS DECIMAL(18,2))) * copies AS DOUBLE) AS load_sum
        FROM (SELECT *, CASE WHEN event_type = 'view' AND ts < TIMESTAMP '2024-01-29'
                             THEN 2 ELSE 1 END AS copies FROM events)
        GROUP BY 1, 2, copies""",
    "missing_days": """
        SELECT CAST(d AS DATE) AS date
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
              FROM orders)
        WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "csv_cast_filter": """
        SELECT CAST(user_id AS VARCHAR) AS customer_id, ts AS full_timestamp,
               value AS load_percentage
        FROM events WHERE event_type NOT IN ('signup', 'view', 'click')""",
    "table_count": "SELECT count(*) AS row_count FROM events",
    "kafka_batch_parse": """
        SELECT kafka_key, CASE WHEN ok THEN CAST(house_id AS DOUBLE) END AS house_id,
               CASE WHEN ok THEN p_retailprice END AS house_size,
               CASE WHEN ok THEN p_size / 10 END AS location_score,
               CASE WHEN ok THEN CAST(p_size * 1000 AS DOUBLE) END AS price,
               CASE WHEN ok THEN CASE p_type
                   WHEN 'ECONOMY' THEN strftime(moment, '%Y-%m-%d %H:%M:%S')
                   ELSE strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') END END AS house_timestamp,
               CASE WHEN ok AND p_type <> 'ECONOMY' THEN moment END AS "timestamp",
               moment AS kafka_timestamp
        FROM (SELECT *, CAST(p_partkey AS VARCHAR) AS kafka_key, CAST(p_partkey AS INT) AS house_id,
                     p_type <> 'PROMO' AS ok,
                     make_timestamp(1700000000000000 + p_partkey * 1234567) AS moment
              FROM part)""",
    "envelope_explode": STREAM_ROWS,
    "stream_bronze": STREAM_ROWS,
    "stream_compacted": STREAM_ROWS,
    "stream_sorted": f"""
        WITH turns AS (
            SELECT customer_id, ts, least(2, CAST(ts >= TIMESTAMP '2024-01-11' AS INT) + CAST(ts >= TIMESTAMP '2024-01-21' AS INT)
                                             + CAST(event_id % 10 = 0 AS INT)) AS turn
            FROM {HOURLY_READINGS}
        ),
        marks AS (SELECT turn, max(ts) AS newest FROM turns GROUP BY turn),
        placed AS (
            SELECT t.*, coalesce(ts < (SELECT max(newest) FROM marks m WHERE m.turn < t.turn) - INTERVAL 1 DAY, false) AS late
            FROM turns t
        ),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY customer_id, ts, late ORDER BY turn) AS copy FROM placed
        )
        SELECT CAST(ts AS DATE) AS date, count(*) FILTER (NOT late AND copy = 1) AS accepted,
               count(*) FILTER (NOT late AND copy > 1) AS duplicates, count(*) FILTER (late) AS late
        FROM numbered GROUP BY 1""",
    "rejected_messages": """
        SELECT event_id, event_type AS sensor FROM events WHERE event_type IN ('signup', 'error')""",
    "monthly_merge": f"""
        SELECT CAST(month(o_orderdate) AS INT) AS month_num,
               strftime(o_orderdate, '%B') AS month_name,
               {mean('load')} AS avg_load_percentage
        FROM {DAMAGED} GROUP BY 1, 2""",
    "fanout_detail": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS customer_id, strftime(o_orderdate, '%Y') AS year,
               CAST(month(o_orderdate) AS INT) AS month_num, strftime(o_orderdate, '%B') AS month_name,
               CAST(day(o_orderdate) AS INT) AS day,
               CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS date,
               CAST(hour(o_orderdate) AS INT) AS hour,
               CASE WHEN nan THEN CAST('NaN' AS DOUBLE) ELSE load END AS load_percentage
        FROM {DAMAGED}""",
    "fanout_raw": f"""
        SELECT 'raw' AS kind, 'line ' || o_orderkey AS text FROM {DAMAGED}
        UNION ALL SELECT 'rejected', '{{not json' FROM orders WHERE o_orderkey % 17 = 0""",
    "topic_route": """
        SELECT 'topic-' || event_type AS topic,
               CASE event_type WHEN 'error' THEN 'rejected' ELSE 'routed' END AS outcome,
               count(*) AS message_count
        FROM events WHERE event_type IN ('click', 'error', 'view') GROUP BY 1, 2""",
    "to_kafka_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key, o_custkey, o_totalprice, o_orderstatus
        FROM orders""",
    "decimal_result": """
        SELECT CAST(p_partkey AS INT) AS house_id,
               CAST(CAST(p_retailprice / 8 AS DECIMAL(10,2)) AS DOUBLE) AS house_size,
               CAST(CAST(p_size / 4 AS DECIMAL(3,1)) AS DOUBLE) AS location_score,
               p_size AS age_years, p_size AS rooms,
               CAST(round(p_retailprice, 0) AS INT) AS predicted_price,
               TIMESTAMP '2024-01-01' AS prediction_timestamp
        FROM part""",
    "serving_union": f"""
        SELECT date, version, total_daily_energy, record_count, layer
        FROM ({SERVING})
        QUALIFY row_number() OVER (PARTITION BY date ORDER BY version DESC) = 1""",
    "filter_gt": "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 3000",
    "expr_bonus": """
        SELECT s_suppkey, s_acctbal AS balance, s_acctbal * CAST(0.1 AS DOUBLE) AS bonus
        FROM supplier""",
    "season_filter": f"""
        SELECT date, total_daily_energy, customer_count, month
        FROM {daily_readings(ORDER_READINGS)} WHERE month IN (6, 7, 8, 9)""",
    "date_range_daily": f"""
        SELECT * FROM {daily_readings(
            ORDER_READINGS, "CAST(ts AS DATE) BETWEEN DATE '1997-10-01' AND DATE '1997-12-31'")}""",
    "latest_snapshot": f"""
        SELECT o_orderkey AS customer_id, o_orderdate AS full_timestamp,
               CAST(hour(o_orderdate) AS INT) AS hour, CAST(minute(o_orderdate) AS INT) AS minute,
               o_totalprice AS load_percentage
        FROM orders WHERE o_orderdate = {LATEST}
        ORDER BY hour DESC, minute DESC, customer_id LIMIT 5""",
    "freshness": """
        SELECT count(*) AS recent_rows, count(*) > 0 AS fresh FROM events
        WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 60 MINUTES""",
    "customer_profile": f"""
        SELECT event_id, customer_id, ts AS full_timestamp, load AS load_percentage
        FROM {EVENT_READINGS}
        WHERE customer_id = (SELECT arg_min(customer_id, event_id) FROM {EVENT_READINGS})""",
    "expected_load": f"""
        SELECT o_orderkey, round(e, 6) AS expected_load, round(load - e, 6) AS residual
        FROM (SELECT *, greatest(10.0, least(90.0, CAST(35 AS DOUBLE)
                  * CAST(CASE WHEN month(ts) IN (12, 1, 2) THEN 1.4
                              WHEN month(ts) IN (6, 7, 8) THEN 1.3 ELSE 0.9 END AS DOUBLE)
                  * CAST(CASE WHEN hour(ts) BETWEEN 6 AND 9 OR hour(ts) BETWEEN 17 AND 22 THEN 1.5
                              WHEN hour(ts) >= 23 OR hour(ts) <= 5 THEN 0.5 ELSE 1.0 END AS DOUBLE)
                  * CAST(CASE WHEN isodow(ts) >= 6 THEN 0.85 ELSE 1.0 END AS DOUBLE))) AS e
              FROM {ORDER_READINGS})""",
    "system_rollup": f"SELECT * FROM {system(HOURLY_READINGS)}",
    "daily_total_energy": f"SELECT * FROM {daily_energy(HOURLY_READINGS)}",
    "incremental_daily": f"SELECT * FROM {daily_energy(HOURLY_READINGS)}",
    "daily_silver": f"SELECT * FROM {daily_readings(EVENT_READINGS)}",
    "order_extremes": """
        SELECT min(CAST(o_orderdate AS DATE)) AS oldest, max(CAST(o_orderdate AS DATE)) AS newest, count(*) AS row_count FROM orders""",
    "season_from_footers": f"""
        SELECT season, last_day AS required, (SELECT max(last_day(ts)) FROM {ORDER_READINGS}) AS latest,
               (SELECT count(*) FROM {ORDER_READINGS} WHERE last_day(ts) BETWEEN first_day AND last_day) AS season_rows,
               (SELECT max(last_day(ts)) FROM {ORDER_READINGS}) >= last_day AS available,
               (SELECT count(*) FROM {ORDER_READINGS} WHERE last_day(ts) BETWEEN first_day AND last_day) >= 1 AS enough
        FROM (VALUES ('spring', DATE '1997-01-01', DATE '1997-05-31'), ('summer', DATE '1997-06-01', DATE '1997-09-30'),
                     ('autumn', DATE '1997-10-01', DATE '1997-12-31')) v(season, first_day, last_day)""",
    "two_key_table": f"""
        SELECT CAST(ts AS DATE) AS date, customer_id, count(*) AS record_count, {total('load')} AS load_sum
        FROM {EVENT_READINGS} GROUP BY 1, 2""",
    "monthly_customers": f"""
        SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT customer_id) AS customer_count, true AS within_bound
        FROM {ORDER_READINGS} GROUP BY 1""",
    "coverage_gaps": f"""
        WITH seasons AS (
            SELECT * FROM (VALUES ('spring', DATE '1996-01-01', DATE '1996-05-31'), ('summer', DATE '1996-06-01', DATE '1996-09-30'),
                                  ('autumn', DATE '1996-10-01', DATE '1996-12-31')) v(season, first_day, last_day)
        ),
        seen AS (
            SELECT DISTINCT season, customer_id, CAST(ts AS DATE) AS date, first_day, last_day
            FROM {ORDER_READINGS} JOIN seasons ON CAST(ts AS DATE) BETWEEN first_day AND last_day
        ),
        steps AS (
            SELECT *, date - coalesce(lag(date) OVER w, first_day - 1) - 1 AS gap, lag(date) OVER w IS DISTINCT FROM date - 1 AS starts
            FROM seen WINDOW w AS (PARTITION BY season, customer_id ORDER BY date)
        ),
        numbered AS (
            SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY season, customer_id ORDER BY date) AS run FROM steps
        ),
        runs AS (
            SELECT season, customer_id, run, last_day, count(*) AS n, max(gap) AS gap, max(date) AS run_end,
                   any_value(last_day - first_day + 1) AS days
            FROM numbered GROUP BY season, customer_id, run, last_day
        )
        SELECT season, customer_id, CAST(sum(n) AS BIGINT) AS days_present, CAST(any_value(days) - sum(n) AS BIGINT) AS missing_days,
               count(*) AS runs, max(n) AS longest_run, greatest(max(gap), last_day - max(run_end)) AS longest_gap
        FROM runs GROUP BY season, customer_id, last_day""",
    "sql_daily_by_season": f"SELECT * FROM {seasonal_daily(ORDER_READINGS, 1996, 1, 5)}",
    "monthly_average": f"""
        SELECT CAST(month(ts) AS INT) AS month, strftime(ts, '%B') AS month_name,
               {mean('load')} AS avg_load_percentage
        FROM {ORDER_READINGS} GROUP BY 1, 2""",
    "daily_energy_stats": f"""
        SELECT {mean('total_daily_energy')} AS avg_daily_energy,
               min(total_daily_energy) AS min_daily_energy,
               max(total_daily_energy) AS max_daily_energy
        FROM {daily_energy(HOURLY_READINGS)}""",
    "date_span": "SELECT min(ts) AS start_date, max(ts) AS end_date FROM events",
    "avg_by_group": f"""
        SELECT c_nationkey AS nation, {mean('c_acctbal')} AS avg_balance
        FROM customer GROUP BY c_nationkey""",
    "coverage_report": """
        SELECT CAST(ts AS DATE) AS data_date, count(*) AS record_count,
               CAST(max(hour(ts)) AS INT) AS last_hour, CAST(max(minute(ts)) AS INT) AS last_minute
        FROM events GROUP BY 1 ORDER BY data_date DESC LIMIT 10""",
    "describe_profile": describe("load", EVENT_READINGS, "customer_id"),
    "describe_table": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", * FROM ({describe(c, 'lineitem')})"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "describe_missing": describe("load", f"""(
        SELECT CASE WHEN profile_type <> 'signup' THEN customer_id END AS customer_id,
               CASE WHEN CAST(customer_id AS INT) % 5 <> 0 THEN load END AS load
        FROM {EVENT_READINGS})""", "customer_id"),
    "describe_columns": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count,
                   {f'round(avg({c}), 6)' if number else 'CAST(NULL AS DOUBLE)'} AS mean,
                   {f'round(stddev_samp({c}), 6)' if number else 'CAST(NULL AS DOUBLE)'} AS std,
                   CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM customer"""
        for c, number in (("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_mktsegment", False))
    ),
    "peak_interval_nan": f"""
        SELECT customer_id, load AS peak_load, ts AS peak_time, strftime(ts, '%H:%M') AS peak_clock
        FROM (SELECT * REPLACE (CASE WHEN profile_type <> 'error' THEN load END AS load) FROM {EVENT_READINGS})
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load DESC NULLS LAST, ts) = 1""",
    "tied_window": f"""
        SELECT event_id, lag(load, 1) OVER w AS lag_1, lag(load, 5) OVER w AS lag_5,
               max(load) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS max_7
        FROM {EVENT_READINGS} WINDOW w AS (ORDER BY date_trunc('hour', ts), event_id)""",
    "newest_run": """
        SELECT CAST(o_custkey AS VARCHAR) AS name, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id,
               'm/' || o_orderkey AS path
        FROM orders WHERE o_orderstatus = 'F'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "peak_interval": f"""
        SELECT customer_id, load AS peak_load, ts AS peak_time, strftime(ts, '%H:%M') AS peak_clock
        FROM {EVENT_READINGS}
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load DESC, ts) = 1""",
    "cardinality": f"""
        SELECT 'customer_id' AS "column", count(DISTINCT customer_id) AS distinct_values
        FROM {EVENT_READINGS}
        UNION ALL SELECT 'profile_type', count(DISTINCT profile_type) FROM {EVENT_READINGS}
        UNION ALL SELECT 'load_percentage', count(DISTINCT load) FROM {EVENT_READINGS}""",
    "prediction_report": f"""
        SELECT count(*) AS total_predictions, min(o_totalprice) AS min_price,
               max(o_totalprice) AS max_price, round({mean('o_totalprice')}, 0) AS avg_price,
               max(o_orderdate) AS last_prediction
        FROM orders""",
    "features_ml": f'SELECT * EXCLUDE ("timestamp") FROM {FEATURES_ML}',
    "features_silver": f"""
        SELECT month, dayofweek, year, energy_lag_1, energy_lag_2, energy_lag_3, energy_lag_7,
               rolling_avg_3d, rolling_avg_7d, rolling_avg_30d, rolling_max_7d, rolling_min_7d,
               {CALENDAR},
               CASE WHEN avg_daily_load > 0 THEN peak_daily_load / avg_daily_load
                    ELSE CAST(1 AS DOUBLE) END AS peak_to_avg_ratio,
               total_daily_energy - rolling_avg_3d AS energy_trend_3d,
               total_daily_energy - rolling_avg_7d AS energy_trend_7d,
               avg_daily_load, peak_daily_load, customer_count, total_daily_energy, date
        FROM (SELECT *, CAST(dayofweek(date) + 1 AS INT) AS dayofweek, {history(True)}
              FROM {daily_readings(ORDER_READINGS)})""",
    "long_window": f"""
        SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER frame AS DOUBLE) / count(*) OVER frame AS rolling_avg,
               max(l_extendedprice) OVER frame AS rolling_max, min(l_extendedprice) OVER frame AS rolling_min,
               count(*) OVER frame AS rolling_count
        FROM lineitem
        WINDOW frame AS (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice ROWS BETWEEN 49999 PRECEDING AND CURRENT ROW)""",
    "chunked_window": f"""
        SELECT full_timestamp, total_system_load,
               lag(total_system_load, 1) OVER w AS load_lag_1,
               lag(total_system_load, 7) OVER w AS load_lag_7,
               lag(total_system_load, 30) OVER w AS load_lag_30,
               CAST(sum(CAST(total_system_load AS DECIMAL(18,2))) OVER month AS DOUBLE)
                   / count(*) OVER month AS rolling_avg_30,
               max(total_system_load) OVER week AS rolling_max_7,
               min(total_system_load) OVER week AS rolling_min_7
        FROM {system(EVENT_READINGS)}
        WINDOW w AS (ORDER BY full_timestamp),
               week AS (ORDER BY full_timestamp ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               month AS (ORDER BY full_timestamp ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "shifted_window": f"""
        SELECT event_id, customer_id,
               CAST(sum(CAST(load AS DECIMAL(18,2))) OVER three AS DOUBLE)
                   / nullif(count(load) OVER three, 0) AS avg_before_3,
               max(load) OVER seven AS max_before_7
        FROM {EVENT_READINGS}
        WINDOW three AS (PARTITION BY customer_id ORDER BY ts, event_id
                         ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
               seven AS (PARTITION BY customer_id ORDER BY ts, event_id
                         ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "dense_series": f"""
        WITH daily AS (SELECT * FROM {daily_readings(ORDER_READINGS)}),
             days AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))
                                  AS DATE) AS date FROM daily)
        SELECT date, total_daily_energy, CAST(record_count AS DOUBLE) AS record_count
        FROM days LEFT JOIN daily USING (date)""",
    "chrono_split": f"SELECT date, row_num, split FROM {CHRONO}",
    "split_sizes": f"SELECT split, count(*) AS row_count FROM {CHRONO} GROUP BY split",
    "hash_split": """
        SELECT o_orderkey,
               CASE WHEN ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT % 10000 < 8000
                    THEN 'train' ELSE 'test' END AS split
        FROM orders""",
    "random_split": """
        SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS key_count, true AS near
        FROM orders""",
    "latest_predictions": """
        SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
        ORDER BY o_orderdate DESC, o_orderkey LIMIT 5""",
    "customer_comparison": f"""
        SELECT customer_id, event_id, CAST(hour(ts) * 4 + minute(ts) // 15 AS INT) AS interval_idx,
               load AS load_percentage
        FROM {EVENT_READINGS}
        WHERE customer_id IN (SELECT customer_id FROM {EVENT_READINGS}
                              GROUP BY customer_id ORDER BY min(event_id) LIMIT 5)""",
    "union_days": f"""
        {SUBSET_EVENTS} FROM {EVENT_READINGS} WHERE ts < TIMESTAMP '2024-01-16'
        UNION ALL
        {SUBSET_EVENTS} FROM {EVENT_READINGS} WHERE ts >= TIMESTAMP '2024-01-10'""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("orders", "events", "lineitem", "customer")
    ),
    "day_from_name": """
        SELECT o_orderkey, path,
               coalesce(TRY_CAST(regexp_extract(path, '_([^_./]*)[.][^/]*$', 1) AS INT), 1) AS day_num
        FROM (SELECT o_orderkey, '/data/load_2016/cyme_load_timeseries_day_'
                     || CASE o_orderstatus WHEN 'P' THEN 'x1' ELSE CAST(dayofyear(o_orderdate) AS VARCHAR)
                        END || '.txt' AS path
              FROM orders)""",
    "day_number_to_date": """
        SELECT o_orderkey, date, CAST(month(date) AS INT) AS month, strftime(date, '%B') AS month_name
        FROM (SELECT o_orderkey,
                     CAST(DATE '2016-01-01' + CAST(dayofyear(o_orderdate) - 1 AS INT) AS DATE) AS date
              FROM orders)""",
    "calendar_columns": f"""
        SELECT o_orderkey, strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INT) AS hour,
               CAST(month(ts) AS INT) AS month, CAST(year(ts) AS INT) AS year,
               CAST(dayofweek(ts) + 1 AS INT) AS dayofweek, CAST(day(ts) AS INT) AS day,
               CAST(dayofweek(ts) AS INT) AS dow, CAST(isodow(ts) - 1 AS INT) AS weekday,
               CAST(dayofweek(ts) IN (0, 6) AS INT) AS is_weekend,
               strftime(ts, '%H:%M') AS clock
        FROM {ORDER_READINGS}""",
    "parse_iso_ts": """
        SELECT event_id, CASE WHEN event_type <> 'click' THEN ts END AS strict,
               CASE WHEN event_type = 'click' THEN date_trunc('second', ts) ELSE ts END AS free,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS midnight
        FROM events""",
    "cyclic_features": f"""
        SELECT o_orderkey, month, dayofweek, {CALENDAR}
        FROM (SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS month,
                     CAST(dayofweek(o_orderdate) + 1 AS INT) AS dayofweek
              FROM orders)""",
    "seasonal_features": f"""
        SELECT date, avg_load_percentage, month, day, day_of_week,
               round(month * {PI} / 6, 10) AS month_sin, round(day * {PI} / 15, 10) AS day_sin,
               CAST(day_of_week IN (0, 6) AS INT) AS is_weekend
        FROM {seasonal_daily(ORDER_READINGS, 1998, 6, 9)}""",
    "rounding": """
        SELECT l_orderkey, l_partkey, l_linenumber,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 0) AS INT) AS whole,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS tenth,
               greatest(10.0, least(40.0, l_quantity)) AS clamped,
               CAST(l_orderkey // 7 AS INT) AS sevenths, l_orderkey % 7 AS rest
        FROM lineitem""",
    "json_props": "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events",
    "season_of_month": f"""
        SELECT {SEASON} AS season, count(*) AS order_count, CAST(min(month) AS INT) AS first_month
        FROM (SELECT month(o_orderdate) AS month FROM orders) GROUP BY 1""",
    "sample_days": f"""
        SELECT date, CAST(dayofyear(date) AS INT) AS day_num, record_count
        FROM {daily_readings(ORDER_READINGS)} WHERE day(date) IN (1, 5, 9, 13, 17, 21, 25, 29)""",
    "availability_gate": f"SELECT *, season_rows >= 30 AS enough FROM {GATE}",
    "minimum_rows": """
        SELECT count(DISTINCT CAST(ts AS DATE)) AS row_count,
               count(DISTINCT CAST(ts AS DATE)) >= 30 AS enough
        FROM events""",
    "pick_model": f"""
        SELECT month, season, CASE WHEN season IN (SELECT season FROM {GATE} WHERE available)
                                   THEN season || '_energy_model' ELSE 'general_energy_model' END AS model
        FROM (SELECT month, {SEASON} AS season
              FROM (SELECT DISTINCT CAST(month(o_orderdate) AS INT) AS month FROM orders))""",
    "pick_version": """
        SELECT CAST(o_custkey AS VARCHAR) AS name, o_orderkey AS version,
               CASE o_orderstatus WHEN 'P' THEN 'Production' ELSE 'None' END AS stage,
               'm/' || o_orderkey AS path
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderstatus = 'P' DESC, o_orderkey DESC) = 1""",
    "run_log_pivot": "SELECT CAST(user_id AS VARCHAR) AS run_id, " + ", ".join(
        f"arg_max(CAST(value AS VARCHAR), ts) FILTER (WHERE event_type = '{k}') AS {k}"
        for k in ("click", "error", "purchase", "signup", "view")
    ) + " FROM events GROUP BY 1",
    "standard_scale": """
        SELECT o_orderkey, round((o_totalprice - m) / s, 8) AS z
        FROM orders, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders)""",
    "ols_fit": """
        SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 4) AS estimate
        FROM lineitem
        UNION ALL
        SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""",
    "saved_model": """
        SELECT DISTINCT l_quantity, round(b + a * l_quantity, 4) AS prediction
        FROM lineitem,
             (SELECT regr_slope(l_extendedprice, l_quantity) AS a,
                     regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)""",
    "score_by_season": """
        SELECT o_orderkey, model, CAST(version AS INT) AS version,
               CASE WHEN model = 'spring_energy_model' AND version = 1 THEN 2 * x + 1
                    WHEN model = 'spring_energy_model' THEN 2 * x + 11
                    WHEN model = 'summer_energy_model' THEN 5 - 3 * x
                    WHEN model = 'general_energy_model' THEN x / 2 END AS predicted_load
        FROM (
            SELECT *, CASE WHEN model IS NULL THEN NULL
                           WHEN model = 'spring_energy_model' AND o_orderdate >= TIMESTAMP '1996-03-01' THEN 2 ELSE 1 END AS version
            FROM (
                SELECT o_orderkey, o_orderdate, CAST(o_custkey % 50 AS DOUBLE) AS x,
                       CASE WHEN month(o_orderdate) <= 5 AND o_orderdate >= TIMESTAMP '1993-01-01' THEN 'spring_energy_model'
                            WHEN month(o_orderdate) BETWEEN 6 AND 9 AND o_orderdate >= TIMESTAMP '1994-07-01' THEN 'summer_energy_model'
                            WHEN o_orderdate >= TIMESTAMP '1992-06-01' THEN 'general_energy_model' END AS model
                FROM orders
            )
        )""",
    "score_batch": """
        SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
               round(b + a * l_quantity, 0) AS predicted_price, newest AS prediction_timestamp
        FROM lineitem,
             (SELECT regr_slope(l_extendedprice, l_quantity) AS a,
                     regr_intercept(l_extendedprice, l_quantity) AS b,
                     max(l_shipdate) AS newest
              FROM lineitem)""",
    "eval_metrics": f"SELECT * FROM {EVAL}",
    "overfit_gap": f"""
        SELECT gap, gap > 0.1 AS overfit
        FROM (SELECT max(r2) FILTER (WHERE split = 'train') - max(r2) FILTER (WHERE split = 'test')
                     AS gap FROM {EVAL})""",
}
ORACLES["seasonal_sql_text"] = f"""
    SELECT * REPLACE (round(avg_load_percentage, 6) AS avg_load_percentage)
    FROM ({ORACLES["sql_daily_by_season"]})"""
