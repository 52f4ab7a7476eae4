"""The same queries in SQL, written apart from the DataFrame code, for an independent engine."""

STREAM_START = "TIMESTAMP '2024-01-25 00:00:00'"
EPOCH_CUT = "TIMESTAMP '2024-01-28 00:00:00'"

TX = """
tx0 AS (
  SELECT *, user_id % 25 AS home,
         CASE WHEN event_id % 8 = 0 THEN (user_id + 1 + event_id % 24) % 25 ELSE user_id % 25 END AS away
  FROM events
),
tx AS (
  SELECT event_id AS n, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
    CAST(event_id AS VARCHAR) AS _c0, CAST(event_id AS VARCHAR) AS trans_num,
    CAST(user_id AS VARCHAR) AS ssn, CAST(user_id AS VARCHAR) AS cc_num,
    'First' || user_id AS first, 'Last' || user_id AS last,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    'City' || home AS city, 'S' || (user_id % 5) AS state,
    CAST(10000 + user_id % 80000 AS DECIMAL(5,0)) AS zip,
    (1950 + user_id % 50) || '-01-01' AS dob, 'ACC' || user_id AS acct_num, user_id,
    CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS unix_time, event_type AS category,
    CAST(value * 10 AS DECIMAL(9,2)) AS amt, 'M' || (event_id % 50) AS merchant,
    CASE WHEN event_id % 8 = 0 AND value > 100 THEN 1 ELSE 0 END AS is_fraud,
    CAST(-60 + home * 5 AS DOUBLE) AS lat, CAST(-170 + home * 14 AS DOUBLE) AS long,
    CAST(CAST(-60 + away * 5 + CAST(event_id % 100 AS DOUBLE) / 100 AS DECIMAL(9,6)) AS DOUBLE) AS merch_lat,
    CAST(CAST(-170 + away * 14 + CAST(event_id % 37 AS DOUBLE) / 100 AS DECIMAL(9,6)) AS DOUBLE) AS merch_long
  FROM tx0
),
d0 AS (
  SELECT *, pow(sin(radians(merch_lat - lat) / 2), 2)
          + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin(radians(merch_long - long) / 2), 2) AS h
  FROM tx
),
d AS (
  SELECT *, 2 * 6371.0 * atan2(sqrt(h), sqrt(greatest(0.0, 1 - h))) AS distance,
    ln(CAST(amt AS DOUBLE) + 1) AS amount_log,
    CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
    CAST(hour(ts) AS INT) AS hour, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week,
    dayofweek(ts) IN (0, 6) AS is_weekend, hour(ts) BETWEEN 9 AND 17 AS is_business_hours
  FROM d0
),
hist AS (SELECT * FROM d WHERE ts < %(start)s),
live AS (SELECT * FROM d WHERE ts >= %(start)s),
off AS (
  SELECT *, CASE WHEN distance > 1500 AND amt > 500 THEN 'FRAUD' ELSE 'GENUINE' END AS final_fraud_status
  FROM d
),
bad AS (
  SELECT * REPLACE (
    CASE WHEN n %% 50 <> 0 THEN ssn END AS ssn,
    CASE WHEN n %% 70 <> 0 THEN cc_num END AS cc_num,
    CASE WHEN n %% 90 = 0 THEN 0 WHEN n %% 60 <> 0 THEN amt END AS amt,
    CASE WHEN n %% 80 <> 0 THEN lat END AS lat,
    CASE WHEN n %% 100 = 1 THEN CAST(n - 1 AS VARCHAR) WHEN n %% 500 <> 7 THEN trans_num END AS trans_num)
  FROM d
)
""".replace("%(start)s", STREAM_START).replace("%%", "%")

PROFILE = """
profile AS (
  SELECT cc_num, avg(CAST(amt AS DOUBLE)) AS avg_amount, stddev_samp(CAST(amt AS DOUBLE)) AS std_amount,
    count(*) AS total_transactions, max(amt) AS max_amount, min(amt) AS min_amount,
    avg(distance) AS avg_distance
  FROM hist GROUP BY cc_num
)
"""

LAST = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cc_num ORDER BY sec DESC, trans_num DESC) AS rn FROM hist
),
averages AS (
  SELECT cc_num, avg(CAST(amt AS DOUBLE)) AS avg_transaction_amt FROM ranked WHERE rn <= 10 GROUP BY cc_num
)
"""

CUSTOMERS = """
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ssn, CAST(c_custkey AS VARCHAR) AS cc_num, c_name AS first,
    c_mktsegment AS last, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    n_name AS city, r_name AS state, (1950 + c_custkey % 50) || '-01-01' AS dob,
    'ACC' || c_custkey AS acct_num, CASE WHEN c_acctbal < 0 THEN 'FRAUD' ELSE 'GENUINE' END AS status
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)
"""

BEHAVIOUR = """
behaviour AS (
  SELECT live.*, avg_amount, std_amount, total_transactions, max_amount, min_amount, avg_distance,
    (CAST(amt AS DOUBLE) - avg_amount) / NULLIF(std_amount, 0) AS amount_deviation
  FROM live LEFT JOIN profile USING (cc_num)
)
"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + select


def tx(select: str) -> str:
    return with_(TX, select=select)


def dbl(column: str, digits: int | None = None) -> str:
    value = f"CAST({column} AS DOUBLE)"
    return f"{value if digits is None else f'round({value}, {digits})'} AS {column}"


HISTORY_COLUMNS = (
    "trans_num, cc_num, state, unix_time, category, "
    + ", ".join(dbl(c) for c in ("zip", "lat", "long", "amt", "is_fraud", "merch_lat", "merch_long"))
)
FLAG_COLUMNS = f"trans_num, cc_num, {dbl('distance', 3)}, {dbl('avg_transaction_amt', 8)}"
AND_STATUS = (
    "CASE WHEN distance > 1500 AND CAST(amt AS DOUBLE) > avg_transaction_amt + 500"
    " THEN 'fraud' ELSE 'genuine' END AS status"
)
OR_STATUS = AND_STATUS.replace(" AND ", " OR ")
SCORED = f"""
SELECT trans_num, cc_num, year, month, hour, is_weekend, {dbl('amount_log', 6)}, {dbl('distance', 3)},
  {dbl('amount_deviation', 4)}, coalesce(abs(amount_deviation) > 2, false) AS is_unusual_amount,
  CAST(0.5 AS DOUBLE) AS ml_fraud_score, CAST(0.5 AS DOUBLE) AS anomaly_score,
  'LOW_RISK' AS risk_level, false AS alert_generated,
  CASE WHEN distance > 1500 AND amt > 500 THEN 'FRAUD' ELSE 'GENUINE' END AS final_fraud_status
FROM behaviour
"""
TIER = (
    "CASE WHEN distance > 1500 AND amt > 1000 THEN 'HIGH_RISK'"
    " WHEN distance > 1000 AND amt > 500 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END"
)
LEVEL = (
    "CASE WHEN s >= 0.8 THEN 'HIGH_RISK' WHEN s >= 0.6 THEN 'MEDIUM_RISK'"
    " WHEN s >= 0.4 THEN 'LOW_RISK' ELSE 'NO_RISK' END"
)
DAILY = """
daily AS (
  SELECT sec // 86400 * 86400 AS window_start, sec // 86400 * 86400 + 86400 AS window_end,
    count(*) AS n, count(*) FILTER (is_fraud = 1) AS frauds,
    count(*) FILTER (is_fraud = 1) / CAST(count(*) AS DOUBLE) AS fraud_rate
  FROM tx GROUP BY ALL
)
"""
REPORT = """
SELECT {by}, count(*) AS n, count(*) FILTER (final_fraud_status = 'FRAUD') AS frauds,
  round(CAST(coalesce(sum(amt) FILTER (final_fraud_status = 'FRAUD'), 0) AS DOUBLE), 2) AS fraud_amount,
  round(count(*) FILTER (final_fraud_status = 'FRAUD') / CAST(count(*) AS DOUBLE), 8) AS fraud_rate
FROM off GROUP BY {by}
"""
TOP = """
SELECT {by}, CAST(sum(amt) AS DOUBLE) AS fraud_amount, count(*) AS frauds
FROM off WHERE final_fraud_status = 'FRAUD' GROUP BY {by} ORDER BY fraud_amount DESC, {by} LIMIT 10
"""
CENTRES = ((2.0, 0.0, 1.0), (5.0, 0.1, 2.5), (4.0, 3.0, 1.5))
NEAR = (
    "sq AS (SELECT trans_num, "
    + ", ".join(
        f"pow(amount_log - {a}, 2) + pow(distance / 2000.0 - {b}, 2) + pow(hour / 7.0 - {c}, 2) AS s{i}"
        for i, (a, b, c) in enumerate(CENTRES)
    )
    + " FROM d), near AS (SELECT trans_num, least(s0, s1, s2) AS s,"
    " CAST(CASE WHEN s0 <= s1 AND s0 <= s2 THEN 0 WHEN s1 <= s2 THEN 1 ELSE 2 END AS INT) AS cluster FROM sq)"
)
CONFUSION = (
    "c AS (SELECT cc_num, is_fraud AS y, CASE WHEN " + TIER + " <> 'LOW_RISK' THEN 1 ELSE 0 END AS p FROM d)"
)
COUNTS = """
  count(*) AS n, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn
"""
FIELDS = (
    "_c0 string, ssn string, cc_num string, first string, last string, gender string, street string,"
    " city string, state string, zip decimal(5,0), lat decimal(9,6), long decimal(9,6), city_pop string,"
    " job string, dob string, acct_num string, profile string, trans_num string, trans_date string,"
    " trans_time string, unix_time string, category string, amt decimal(9,2), is_fraud decimal(9,0),"
    " merchant string, merch_lat decimal(9,6), merch_long decimal(9,6)"
)
SCHEMA_ROWS = ", ".join(
    "({}, '{}', '{}')".format(i, *f.split(" ")) for i, f in enumerate(FIELDS.split(", "))
)

ORACLE: dict[str, str] = {
    "src_history_typed": tx(f"SELECT {HISTORY_COLUMNS} FROM tx"),
    "src_history_stored": tx(f"SELECT {HISTORY_COLUMNS} FROM tx"),
    "src_history_untyped": tx(
        f"SELECT {HISTORY_COLUMNS}, _c0, CASE WHEN amt IS NULL THEN 1 ELSE 0 END AS cast_failures"
        " FROM bad"
    ),
    "schema_check": tx(
        f"""
        SELECT field, CAST(i AS INT) AS expected_place, CAST(i AS INT) AS actual_place, expected,
          'string' AS actual, expected = 'string' AS matches,
          CASE WHEN field = 'amt'
            THEN (SELECT count(*) FROM bad WHERE amt IS NULL) ELSE 0 END AS misfits
        FROM (VALUES {SCHEMA_ROWS}) AS v(i, field, expected)
        """
    ),
    "src_stream_files": tx(f"SELECT {HISTORY_COLUMNS} FROM tx"),
    "decode_json_payload": tx(
        """
        SELECT trans_num AS key, n % 97 = 0 AS is_corrupt,
          CASE WHEN n % 97 <> 0 THEN trans_num END AS trans_num,
          CASE WHEN n % 97 <> 0 THEN cc_num END AS cc_num,
          CASE WHEN n % 97 <> 0 THEN unix_time END AS unix_time,
          CASE WHEN n % 97 <> 0 THEN category END AS category,
          CASE WHEN n % 97 <> 0 THEN CAST(zip AS DOUBLE) END AS zip,
          CASE WHEN n % 97 <> 0 THEN lat END AS lat,
          CASE WHEN n % 97 <> 0 THEN CAST(amt AS DOUBLE) END AS amt,
          CASE WHEN n % 97 <> 0 THEN CAST(is_fraud AS DOUBLE) END AS is_fraud
        FROM tx
        """
    ),
    "src_customers": with_(CUSTOMERS, select="SELECT * FROM cust"),
    "project_customer": tx(
        "SELECT ssn, cc_num, first, last, gender, city, state, dob, acct_num,"
        " CAST(is_fraud AS VARCHAR) AS status FROM tx"
    ),
    "filter_labelled": tx(
        f"SELECT _c0, cc_num, {dbl('amt')}, {dbl('is_fraud')} FROM bad"
        " WHERE cc_num IS NOT NULL"
    ),
    "pii_masked": tx(
        """
        SELECT trans_num, sha256('demo-salt' || ssn) AS ssn, sha256('demo-salt' || cc_num) AS card_token,
          repeat('*', greatest(length(cc_num) - 4, 0)) || right(cc_num, 4) AS cc_num,
          repeat('*', greatest(length(acct_num) - 4, 0)) || right(acct_num, 4) AS acct_num,
          'Xxxxx' || repeat('n', length(cc_num)) AS first, 'Xxxx' || repeat('n', length(cc_num)) AS last
        FROM tx
        """
    ),
    "haversine_distance": tx(f"SELECT trans_num, {dbl('distance', 3)} FROM d"),
    "temporal_features": tx(
        """
        SELECT trans_num, year, month, day, hour, day_of_week, CAST(quarter(ts) AS INT) AS quarter,
          CAST(weekofyear(ts) AS INT) AS week_of_year, is_weekend, is_business_hours FROM d
        """
    ),
    "transaction_features": tx(
        f"""
        SELECT trans_num, {dbl('amount_log', 6)}, CAST(amt * amt AS DOUBLE) AS amount_squared,
          amt > 1000 AS is_high_value, amt < 10 AS is_low_value FROM d
        """
    ),
    "behavior_features": with_(
        TX, PROFILE, BEHAVIOUR,
        select=f"""
        SELECT trans_num, cc_num, {dbl('avg_amount', 8)}, {dbl('std_amount', 4)}, total_transactions,
          {dbl('max_amount')}, {dbl('min_amount')}, {dbl('avg_distance', 4)}, {dbl('amount_deviation', 4)},
          coalesce(abs(amount_deviation) > 2, false) AS is_unusual_amount FROM behaviour
        """,
    ),
    "prepare_features": tx(
        """
        SELECT _c0, round(coalesce(ln(CAST(amt AS DOUBLE) + 1), 0.0), 3) AS amount_log,
          round(CASE WHEN lat IS NULL THEN 0.0 ELSE distance END, 3) AS distance,
          CAST(hour AS DOUBLE) AS hour, CAST(day_of_week AS DOUBLE) AS day_of_week,
          CAST(is_weekend AS DOUBLE) AS is_weekend, CAST(is_business_hours AS DOUBLE) AS is_business_hours,
          CAST(0 AS DOUBLE) AS amount_deviation FROM bad
        """
    ),
    "velocity_features": tx(
        """
        SELECT trans_num, sec - lag(sec) OVER o AS secs_since_prev,
          round(CAST(amt AS DOUBLE) / NULLIF(CAST(lag(amt) OVER o AS DOUBLE), 0), 8) AS amt_ratio_prev,
          count(*) OVER h1 AS tx_count_1h, round(CAST(sum(amt) OVER h1 AS DOUBLE), 2) AS amt_sum_1h,
          count(*) OVER h24 AS tx_count_24h, round(CAST(sum(amt) OVER h24 AS DOUBLE), 2) AS amt_sum_24h
        FROM tx
        WINDOW o AS (PARTITION BY cc_num ORDER BY sec, trans_num),
          h1 AS (PARTITION BY cc_num ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
          h24 AS (PARTITION BY cc_num ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)
        """
    ),
    "customer_enrichment": with_(
        TX, CUSTOMERS,
        select="""
        SELECT trans_num, tx.ssn, cust.first AS customer_first, cust.city AS customer_city,
          cust.state AS customer_state, cust.status AS customer_status
        FROM tx LEFT JOIN cust ON tx.ssn = cust.ssn
        """,
    ),
    "card_profile": with_(
        TX, PROFILE,
        select=f"""
        SELECT cc_num, {dbl('avg_amount', 8)}, {dbl('std_amount', 4)}, total_transactions,
          {dbl('max_amount')}, {dbl('min_amount')}, {dbl('avg_distance', 4)} FROM profile
        """,
    ),
    "last_n_transactions": with_(
        TX, LAST,
        select=f"SELECT cc_num, trans_num, {dbl('amt')}, CAST(rn AS INT) AS row_num FROM ranked WHERE rn <= 10",
    ),
    "last10_avg": with_(TX, LAST, select=f"SELECT cc_num, {dbl('avg_transaction_amt', 8)} FROM averages"),
    "asof_profile": tx(
        """
        SELECT trans_num, count(*) OVER w AS prior_count,
          round(avg(CAST(amt AS DOUBLE)) OVER w, 8) AS prior_avg,
          round(stddev_samp(CAST(amt AS DOUBLE)) OVER w, 4) AS prior_std
        FROM tx
        WINDOW w AS (PARTITION BY cc_num ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        """
    ),
    "quality_report": tx(
        """
        , k AS (
          SELECT count(*) AS total_records, count(*) FILTER (ssn IS NULL) AS null_ssn_count,
            count(*) FILTER (cc_num IS NULL) AS null_cc_num_count,
            count(*) FILTER (amt IS NULL) AS null_amount_count,
            count(*) FILTER (amt <= 0) AS invalid_amount_count,
            count(*) FILTER (lat IS NULL OR long IS NULL) AS invalid_coordinates_count,
            count(*) FILTER (ssn IS NULL OR cc_num IS NULL OR amt IS NULL OR coalesce(amt <= 0, false)
              OR lat IS NULL OR long IS NULL) AS failed_rows
          FROM bad),
        g AS (SELECT count(*) AS duplicate_transactions, CAST(sum(c - 1) AS BIGINT) AS surplus_copies
          FROM (SELECT trans_num, count(*) AS c FROM bad GROUP BY trans_num HAVING count(*) > 1))
        SELECT k.*, g.*, round((total_records - null_ssn_count - null_cc_num_count - null_amount_count
            - invalid_amount_count - duplicate_transactions) / CAST(total_records AS DOUBLE) * 100, 8)
            AS data_quality_score,
          round((total_records - failed_rows) / CAST(total_records AS DOUBLE) * 100, 8) AS valid_row_pct
        FROM k, g
        """
    ),
    "duplicate_transactions": tx(
        "SELECT trans_num, count(*) AS copies FROM bad GROUP BY trans_num HAVING count(*) > 1"
    ),
    "rule_flag_inner": with_(
        TX, LAST, select=f"SELECT {FLAG_COLUMNS}, {AND_STATUS} FROM live JOIN averages USING (cc_num)"
    ),
    "flagged_stream": with_(
        TX, LAST, select=f"SELECT {FLAG_COLUMNS}, {AND_STATUS} FROM live JOIN averages USING (cc_num)"
    ),
    "rule_flag_left": with_(
        TX, LAST, select=f"SELECT {FLAG_COLUMNS}, {AND_STATUS} FROM live LEFT JOIN averages USING (cc_num)"
    ),
    "rule_flag_cascade": with_(
        TX, LAST, select=f"SELECT {FLAG_COLUMNS}, {OR_STATUS} FROM live LEFT JOIN averages USING (cc_num)"
    ),
    "rule_tiers": tx(f"SELECT trans_num, {dbl('amt')}, {TIER} AS rule_based_fraud FROM d"),
    "alerts": tx(
        f"""
        SELECT _c0, {LEVEL} AS risk_level, coalesce(s >= 0.6, false) AS alert_generated
        FROM (SELECT _c0, CAST(amt AS DOUBLE) / 1000 AS s FROM bad)
        """
    ),
    "alert_sink": tx(
        f"""
        SELECT trans_num, cc_num, round(s, 6) AS ml_fraud_score, {LEVEL} AS risk_level
        FROM (SELECT *, CAST(amt AS DOUBLE) / 1000 AS s FROM d) WHERE s >= 0.6
        """
    ),
    "final_status_models_off": tx(
        """
        SELECT trans_num, CAST(0.5 AS DOUBLE) AS ml_fraud_score, CAST(0.5 AS DOUBLE) AS anomaly_score,
          'UNKNOWN' AS risk_level,
          CASE WHEN distance > 1500 AND amt > 500 THEN 'FRAUD' ELSE 'GENUINE' END AS final_fraud_status
        FROM d
        """
    ),
    "classification_metrics": with_(
        TX, CONFUSION,
        select=f""", m AS (SELECT {COUNTS} FROM c)
        SELECT *, round((tp + tn) / CAST(n AS DOUBLE), 8) AS accuracy,
          round(tp / CAST(NULLIF(tp + fp, 0) AS DOUBLE), 8) AS precision,
          round(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 8) AS detection_rate,
          round(fp / CAST(NULLIF(fp + tn, 0) AS DOUBLE), 8) AS false_positive_rate FROM m
        """,
    ),
    "confusion_matrix": with_(
        TX, CONFUSION,
        select="SELECT CAST(y AS INT) AS label, CAST(p AS INT) AS predicted, count(*) AS n FROM c GROUP BY y, p",
    ),
    "ab_rule_metrics": tx(
        f"""
        , a AS (SELECT *, is_fraud AS y,
            CASE WHEN CAST('0x' || substr(md5(cc_num), 1, 8) AS BIGINT) % 100 < 50 THEN 'B' ELSE 'A' END AS arm
          FROM d),
        s AS (SELECT *, CASE WHEN distance > (CASE WHEN arm = 'B' THEN 1000 ELSE 1500 END) AND amt > 500
            THEN 1 ELSE 0 END AS p FROM a),
        m AS (SELECT arm, {COUNTS} FROM s GROUP BY arm)
        SELECT *, round(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 8) AS detection_rate,
          round(fp / CAST(NULLIF(fp + tn, 0) AS DOUBLE), 8) AS false_positive_rate FROM m
        """
    ),
    "fraud_rate_windows": with_(
        TX, DAILY, select="SELECT * REPLACE (round(fraud_rate, 8) AS fraud_rate) FROM daily"
    ),
    "stream_rate_windows": with_(
        TX, DAILY,
        select="""
        SELECT * REPLACE (round(fraud_rate, 8) AS fraud_rate) FROM daily
        WHERE window_end <= (SELECT max(sec) FROM tx) - 7200
        """,
    ),
    "fraud_spikes": with_(
        TX, DAILY,
        select="""
        , p AS (SELECT a.window_start, a.fraud_rate, b.fraud_rate AS previous_rate,
            (a.fraud_rate - b.fraud_rate) / NULLIF(b.fraud_rate, 0) AS increase
          FROM daily a LEFT JOIN daily b ON b.window_end = a.window_start)
        SELECT window_start, round(fraud_rate, 8) AS fraud_rate, round(previous_rate, 8) AS previous_rate,
          round(increase, 8) AS increase, coalesce(increase > 0.10, false) AS is_spike FROM p
        """,
    ),
    "error_rate_windows": tx(
        """
        , e AS (SELECT sec // 86400 * 86400 AS window_start, count(*) AS n,
            count(*) FILTER (n % 97 < 5) AS errors FROM tx GROUP BY 1)
        SELECT window_start, window_start + 86400 AS window_end, n, errors,
          round(errors / CAST(n AS DOUBLE), 8) AS error_rate, errors / CAST(n AS DOUBLE) > 0.05 AS over_limit
        FROM e
        """
    ),
    "stream_dedup": tx(f"SELECT trans_num, cc_num, {dbl('amt')} FROM tx"),
    "scored_batch": with_(TX, PROFILE, BEHAVIOUR, select=SCORED),
    "scored_stream": with_(TX, PROFILE, BEHAVIOUR, select=SCORED),
    "sink_scored_partitioned": tx(
        f"""
        SELECT trans_num, CAST(CASE WHEN ts < {EPOCH_CUT} THEN 0 ELSE 1 END AS INT) AS epoch_id, year, month,
          final_fraud_status, {dbl('amt')}, true AS is_stamped FROM off
        """
    ),
    "sink_compacted": tx(
        f"""
        SELECT trans_num, CAST(CASE WHEN ts < {EPOCH_CUT} THEN 0 ELSE 1 END AS INT) AS epoch_id, year, month,
          final_fraud_status, {dbl('amt')} FROM off
        """
    ),
    "sink_customers": tx(
        f"""
        , e AS (SELECT *, CAST(CASE WHEN ts < {EPOCH_CUT} THEN 0 ELSE 1 END AS INT) AS epoch_id FROM off),
        newest AS (SELECT ssn, max(epoch_id) AS epoch_id FROM e GROUP BY ssn)
        SELECT ssn, cc_num, first, city, dob,
          CASE WHEN bool_or(final_fraud_status = 'FRAUD') THEN 'FRAUD' ELSE 'GENUINE' END AS status, epoch_id
        FROM e JOIN newest USING (ssn, epoch_id) GROUP BY ssn, cc_num, first, city, dob, epoch_id
        """
    ),
    "sink_scored_deidentified": with_(
        TX, LAST,
        select=f"""
        SELECT CASE WHEN n % 97 <> 0 THEN trans_num END AS trans_num, CASE WHEN n % 97 <> 0 THEN ssn END AS ssn,
          CASE WHEN n % 97 <> 0 THEN city END AS city, CASE WHEN n % 97 <> 0 THEN CAST(amt AS DOUBLE) END AS amt,
          CASE WHEN n % 97 <> 0 AND distance > 1500 AND CAST(amt AS DOUBLE) > avg_transaction_amt + 500
            THEN 'fraud' ELSE 'genuine' END AS status, CAST(0 AS INT) AS pii_columns
        FROM live LEFT JOIN averages USING (cc_num)
        """,
    ),
    "publish_json_records": tx(
        """
        SELECT '{' || CASE WHEN n % 4 = 0 THEN '"key":"k' || n || '",' ELSE '' END
            || '"trans_num":"' || trans_num || '","cc_num":"' || cc_num || '","category":"' || category
            || '","amt":"' || CAST(amt AS VARCHAR) || '"}' AS value,
          CASE WHEN n % 4 = 0 THEN 'k' || n END AS own_key,
          CAST(CASE WHEN n % 4 <> 0 THEN 36 END AS INT) AS made_key_length
        FROM tx
        """
    ),
    "catalog_adhoc_table": tx(
        """
        SELECT category, final_fraud_status, count(*) AS n, CAST(sum(amt) AS DOUBLE) AS amount
        FROM off GROUP BY category, final_fraud_status
        """
    ),
    "schema_merge_read": tx(
        f"""
        SELECT trans_num, {dbl('amt')}, CASE WHEN ts >= {EPOCH_CUT}
            THEN CASE WHEN amt > 500 THEN 'branch' ELSE 'online' END END AS channel,
          CAST(CASE WHEN ts < {EPOCH_CUT} THEN 0 ELSE 1 END AS INT) AS part FROM tx
        """
    ),
    "fraud_by_category": tx(REPORT.format(by="category")),
    "fraud_by_hour": tx(REPORT.format(by="hour")),
    "fraud_by_state": tx(REPORT.format(by="state")),
    "fraud_by_month": tx(REPORT.format(by="year, month, day")),
    "top_cards_by_fraud_amount": tx(TOP.format(by="cc_num")),
    "top_merchants_by_fraud_amount": tx(TOP.format(by="merchant")),
    "scaled_features": tx(
        """
        , s AS (SELECT stddev_samp(amount_log) AS a, stddev_samp(distance) AS b,
            stddev_samp(CAST(hour AS DOUBLE)) AS c FROM d)
        SELECT trans_num, round(amount_log / a, 4) AS scaled_amount_log,
          round(distance / b, 4) AS scaled_distance, round(hour / c, 4) AS scaled_hour FROM d, s
        """
    ),
    "anomaly_by_cluster": with_(
        TX, NEAR,
        select="""
        SELECT trans_num, cluster, CAST(CASE cluster WHEN 0 THEN 0.1 WHEN 1 THEN 0.5 ELSE 0.9 END AS DOUBLE)
          AS anomaly_score FROM near
        """,
    ),
    "anomaly_by_distance": with_(
        TX, NEAR,
        select="""
        SELECT trans_num, cluster, round(sqrt(s), 4) AS centre_distance,
          round(least(sqrt(s) / (5.0 * 1.25), 1.0), 4) AS anomaly_score FROM near
        """,
    ),
}

# Branches for large data, taken at lowered limits, must give what the ordinary ones give.
ORACLE["velocity_features_heavy"] = ORACLE["velocity_features"]
ORACLE["asof_profile_heavy"] = ORACLE["asof_profile"]
ORACLE["rule_flag_sliced"] = ORACLE["rule_flag_inner"]
ORACLE["scored_batch_shuffled"] = ORACLE["scored_batch"]
ORACLE["scored_stream_large_profile"] = ORACLE["scored_stream"]
ORACLE["stream_dedup_late"] = ORACLE["stream_dedup"]

ORACLE["stream_bad_messages"] = tx(
    """
    SELECT 'scored' AS "table", trans_num AS what FROM tx WHERE n % 97 <> 0
    UNION ALL SELECT 'bad', substr('{"_c0":"' || _c0 || '","ssn":"' || ssn || '","cc_num":"' || cc_num || '"', 1, 25)
    FROM tx WHERE n % 97 = 0
    """
)
ORACLE["stream_quality"] = tx(
    """
    SELECT CAST(4 AS BIGINT) AS batches, count(*) AS total_records, CAST(0 AS BIGINT) AS null_ssn_count,
      CAST(0 AS BIGINT) AS null_amount_count, count(*) FILTER (amt <= 0) AS invalid_amount_count
    FROM tx WHERE n % 97 <> 0
    """
)
ORACLE["scored_stream_enriched"] = with_(
    TX, CUSTOMERS,
    select="""
    SELECT trans_num, cust.city AS customer_city, cust.status AS customer_status, final_fraud_status
    FROM off LEFT JOIN cust ON off.ssn = cust.ssn WHERE n % 97 <> 0
    """,
)
ORACLE["alert_sink_replayed"] = tx(
    f"""
    SELECT trans_num, {LEVEL} AS risk_level, CAST(0 AS INT) AS epoch_id
    FROM (SELECT *, CAST(amt AS DOUBLE) / 1000 AS s FROM d) WHERE s >= 0.6 AND n % 2 = 0
    """
)
ORACLE["publish_json_array"] = tx(
    """
    SELECT '{"trans_num":"' || trans_num || '","n":' || n || ',"even":' || (n % 2 = 0)
        || CASE WHEN n % 3 = 0 THEN ',"at":{"card":"' || cc_num || '"}' ELSE '' END || '}' AS value,
      CAST(36 AS INT) AS key_length FROM tx
    """
)

# What must hold row by row of models, whatever they have learned.
BUCKET = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) % 100"
HELD = f"SELECT count(*) AS n, count(*) FILTER (is_fraud = 1) AS positives FROM hist WHERE {BUCKET.format('trans_num')} < 20"
ORACLE["rf_score"] = tx(
    f"SELECT trans_num, {dbl('is_fraud')}, true AS score_in_range, true AS confidence_is_the_larger,"
    " true AS class_agrees FROM live"
)
ORACLE["kmeans_assign"] = tx("SELECT trans_num, true AS cluster_exists, true AS is_nearest FROM live")
ORACLE["final_status_models_on"] = tx(
    "SELECT trans_num, distance > 1500 AND amt > 500 AS by_rule, true AS status_follows_scores, true AS rule_is_kept,"
    " true AS alert_follows_level FROM live"
)
ORACLE["rf_holdout_metrics"] = tx(f"SELECT *, true AS counts_add_up FROM ({HELD})")
ORACLE["retrain_compare"] = tx(
    f"SELECT *, true AS counts_add_up, true AS one_promoted FROM ({HELD}), (VALUES ('current'), ('candidate')) AS m(model)"
)
ORACLE["ab_metrics"] = tx(
    f"""
    SELECT CASE WHEN {BUCKET.format('cc_num')} < 50 THEN 'B' ELSE 'A' END AS arm, count(*) AS n,
      count(*) FILTER (is_fraud = 1) AS positives, true AS counts_add_up FROM live GROUP BY 1
    """
)
ORACLE["model_roundtrip"] = tx("SELECT true AS same, count(*) AS n FROM live")
ORACLE["retrain_promote"] = (
    "SELECT CAST(v AS BIGINT) AS version, 'classifier,clusters' AS parts, true AS newest_is_promoted, true AS loads"
    " FROM range(1, 4) AS t(v)"
)

# Refreshing from stored parts must give what the whole history gives.
ORACLE["card_profile_refreshed"] = ORACLE["card_profile"]
ORACLE["last10_avg_refreshed"] = ORACLE["last10_avg"]

# Tables of epochs, and what is kept up to date in them.
ORACLE["stream_rate_windows_late"] = ORACLE["fraud_rate_windows"]
ORACLE["stream_rate_corrections"] = tx(
    """
    , w AS (
      SELECT CASE n % 4 WHEN 2 THEN 0 WHEN 0 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS k, sec // 86400 * 86400 AS s, count(*) AS n,
        count(*) FILTER (is_fraud = 1) AS f, max(sec) AS newest FROM tx GROUP BY 1, 2),
    seen AS (SELECT a.k, max(b.newest) AS newest FROM (SELECT DISTINCT k FROM w) a JOIN w b ON b.k < a.k GROUP BY a.k)
    SELECT CAST(w.k AS BIGINT) AS epoch_id, w.s AS window_start, w.s + 86400 AS window_end, CAST(sum(c.n) AS BIGINT) AS n,
      CAST(sum(c.f) AS BIGINT) AS frauds, round(CAST(sum(c.f) AS DOUBLE) / CAST(sum(c.n) AS DOUBLE), 8) AS fraud_rate
    FROM w JOIN seen ON seen.k = w.k JOIN w c ON c.s = w.s AND c.k <= w.k
    WHERE w.s + 86400 + 7200 <= seen.newest GROUP BY w.k, w.s
    """
)
ORACLE["stream_duplicates"] = ORACLE["duplicate_transactions"]
ORACLE["stream_surplus"] = tx(
    """
    SELECT count(*) AS n, count(*) - count(DISTINCT trans_num) - max(CASE WHEN trans_num IS NULL THEN 1 ELSE 0 END) AS surplus_copies,
      true AS estimate_is_close FROM bad
    """
)
ORACLE["sink_compacted_incremental"] = tx(
    f"SELECT trans_num, n % 6 AS epoch_id, year, month, final_fraud_status, {dbl('amt')} FROM off"
)
ORACLE["catalog_compacted_view"] = tx(
    """
    SELECT n % 6 AS epoch_id, category, final_fraud_status, count(*) AS n, CAST(sum(amt) AS DOUBLE) AS amount
    FROM off WHERE n % 6 < 4 GROUP BY 1, 2, 3
    """
)
ORACLE["scored_stream_compacted"] = tx(
    f"SELECT trans_num, year, month, {dbl('distance', 3)}, final_fraud_status FROM off WHERE n % 97 <> 0"
)
ORACLE["flagged_stream_bad_messages"] = with_(
    TX, LAST,
    select=f"""
    SELECT 'flagged' AS "table", trans_num AS what, {AND_STATUS} FROM d LEFT JOIN averages USING (cc_num) WHERE n % 97 <> 0
    UNION ALL
    SELECT 'bad', substr('{{"_c0":"' || _c0 || '","ssn":"' || ssn || '","cc_num":"' || cc_num || '"', 1, 25), NULL
    FROM tx WHERE n % 97 = 0
    """,
)
ORACLE["fraud_by_category_maintained"] = ORACLE["fraud_by_category"]
_CUBE = ("category", "state", "hour", "year", "month", "day")
_SETS = (("category",), ("state",), ("hour",), ("year", "month", "day"), ("category", "state"))
ORACLE["report_cube_refreshed"] = tx(
    ", c AS (SELECT *, final_fraud_status = 'FRAUD' AS f FROM off) "
    + " UNION ALL ".join(
        f"SELECT '{','.join(s)}' AS report, "
        + ", ".join(f"{c if c in s else 'NULL'} AS {c}" for c in _CUBE)
        + ", count(*) AS n, count(*) FILTER (f) AS frauds,"
        + " CAST(coalesce(sum(amt * 100) FILTER (f), 0) AS BIGINT) AS fraud_cents FROM c GROUP BY "
        + ", ".join(s)
        for s in _SETS
    )
)
ORACLE["stream_velocity"] = ORACLE["velocity_features"]
ORACLE["velocity_one_second"] = tx(
    """
    SELECT trans_num, CASE WHEN lag(sec) OVER o IS NOT NULL THEN CAST(0 AS BIGINT) END AS secs_since_prev,
      round(CAST(amt AS DOUBLE) / NULLIF(CAST(lag(amt) OVER o AS DOUBLE), 0), 8) AS amt_ratio_prev,
      count(*) OVER c AS tx_count_1h, round(CAST(sum(amt) OVER c AS DOUBLE), 2) AS amt_sum_1h,
      count(*) OVER c AS tx_count_24h, round(CAST(sum(amt) OVER c AS DOUBLE), 2) AS amt_sum_24h
    FROM tx WINDOW o AS (PARTITION BY cc_num ORDER BY trans_num), c AS (PARTITION BY cc_num)
    """
)
ORACLE["scored_stream_bucketed"] = ORACLE["scored_stream"]
ORACLE["schema_evolved"] = tx(
    """
    SELECT trans_num, CAST(floor(amt) AS BIGINT) * CASE WHEN n % 3 = 0 THEN 1 ELSE 10000000000 END AS amt, merchant AS shop,
      CASE WHEN n % 3 > 0 THEN CASE WHEN amt > 500 THEN 'branch' ELSE 'online' END END AS channel,
      CASE WHEN n % 3 = 2 AND n % 2 = 0 THEN 'os' || (n % 4) END AS device_os, CASE WHEN n % 3 = 2 AND n % 2 = 0 THEN n END AS device_n
    FROM tx
    """
)
ORACLE["ab_decision"] = tx(
    f"""
    , a AS (SELECT *, sec // 86400 AS day_number, CASE WHEN {BUCKET.format('cc_num')} < 50 THEN 'B' ELSE 'A' END AS arm FROM d WHERE is_fraud = 1),
    s AS (SELECT day_number, arm, CASE WHEN distance > (CASE WHEN arm = 'B' THEN 1000 ELSE 1500 END) AND amt > 500 THEN 1 ELSE 0 END AS hit FROM a),
    l AS (
      SELECT day_number, count(*) FILTER (arm = 'A') AS n_a, count(*) FILTER (arm = 'A' AND hit = 1) AS hits_a,
        count(*) FILTER (arm = 'B') AS n_b, count(*) FILTER (arm = 'B' AND hit = 1) AS hits_b FROM s GROUP BY day_number),
    c AS (
      SELECT day_number, CAST(sum(n_a) OVER w AS BIGINT) AS n_a, CAST(sum(hits_a) OVER w AS BIGINT) AS hits_a,
        CAST(sum(n_b) OVER w AS BIGINT) AS n_b, CAST(sum(hits_b) OVER w AS BIGINT) AS hits_b FROM l WINDOW w AS (ORDER BY day_number)),
    v AS (
      SELECT *, hits_b / CAST(NULLIF(n_b, 0) AS DOUBLE) - hits_a / CAST(NULLIF(n_a, 0) AS DOUBLE) AS gain,
        (hits_a + hits_b) / CAST(n_a + n_b AS DOUBLE) AS pooled FROM c),
    w AS (SELECT *, pooled * (1 - pooled) * (1.0 / NULLIF(n_a, 0) + 1.0 / NULLIF(n_b, 0)) AS spread FROM v),
    p AS (
      SELECT *, coalesce(CASE WHEN spread > 0 THEN least(1.0, sqrt((spread + 0.01) / spread)
        * exp(-least(gain * gain * 0.01 / (2 * spread * (spread + 0.01)), 700))) ELSE 1.0 END, 1.0) AS alone FROM w),
    q AS (SELECT *, min(alone) OVER (ORDER BY day_number) AS p_value FROM p)
    SELECT day_number, n_a, hits_a, n_b, hits_b, round(p_value, 6) AS p_value,
      CASE WHEN p_value <= 0.05 THEN CASE WHEN gain > 0 THEN 'B' WHEN gain < 0 THEN 'A' END END AS decision FROM q
    """
)
_DRIFT = " UNION ALL ".join(
    f"SELECT strftime(ts, '%Y-%m-%d') AS day, '{c}' AS \"column\", {c} AS x, ts < {STREAM_START} AS past FROM d"
    for c in ("amount_log", "distance")
)
ORACLE["drift_by_day"] = tx(
    f"""
    , x AS ({_DRIFT}),
    points AS (
      SELECT "column", unnest(quantile_disc(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS p, unnest(range(9)) AS i
      FROM x WHERE past GROUP BY "column"),
    wanted AS (
      SELECT "column", i, count(*) FILTER (x <= p) / CAST(count(*) AS DOUBLE) AS r FROM x JOIN points USING ("column")
      WHERE past GROUP BY "column", i),
    found AS (
      SELECT day, "column", i, count(*) AS n, count(*) FILTER (x <= p) / CAST(count(*) AS DOUBLE) AS r
      FROM x JOIN points USING ("column") WHERE NOT past GROUP BY day, "column", i)
    SELECT day, "column", max(n) AS n, round(max(abs(found.r - wanted.r)), 8) AS distance, true AS estimate_is_close
    FROM found JOIN wanted USING ("column", i) GROUP BY day, "column"
    """
)
ORACLE["model_quality"] = (
    "SELECT unnest(['finds_frauds', 'few_false_alarms', 'frauds_score_higher', 'clusters_explain']) AS \"check\", true AS holds"
)
ORACLE["stream_dedup_indexed"] = ORACLE["stream_dedup"]
