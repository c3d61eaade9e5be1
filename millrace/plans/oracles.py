"""The expected result of each registered query as SQL over the given tables."""

from __future__ import annotations

def _mean(value: str) -> str:
    """Mean to two decimals, half away from zero, in whole numbers: millionths over a count."""
    total = f"sum(CAST(round(({value}) * 1000000) AS HUGEINT))"
    n = f"count({value})"
    half_up = f"(2 * abs({total}) + 10000 * {n}) // (20000 * {n})"
    return f"CAST(sign({total}) * ({half_up}) AS DOUBLE) / 100"


TRIPS = f"""
lines AS (
  SELECT l.*, o_orderpriority, c_nationkey, s_nationkey,
    o_orderdate + to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60) AS pickup,
    l_partkey % 200 AS fault,
    CASE WHEN l_partkey % 200 = 23 THEN -30
      ELSE date_diff('day', o_orderdate, l_shipdate) % 180 END AS minutes,
    CASE WHEN l_partkey % 200 IN (15, 16, 17) THEN 1000 ELSE 0 END AS beyond,
    (l_orderkey * 1048576 + row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_shipdate, l_returnflag)) * 2 AS packed
  FROM lineitem l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
),
trips_raw AS (
  SELECT CASE WHEN fault <> 18 THEN CAST(l_suppkey AS INTEGER) END AS "VendorID",
    CASE WHEN fault <> 1 THEN pickup END AS tpep_pickup_datetime,
    CASE WHEN fault <> 2 THEN pickup + to_minutes(minutes) END AS tpep_dropoff_datetime,
    CASE WHEN fault = 5 THEN 9 WHEN l_quantity <> 50 THEN CAST(l_linenumber AS INTEGER)
      END AS passenger_count,
    l_quantity * 2 - 4 AS trip_distance,
    CAST(l_linenumber AS INTEGER) AS "RatecodeID",
    l_returnflag AS store_and_fwd_flag,
    CASE WHEN fault <> 3 THEN CAST(c_nationkey + beyond AS INTEGER) END AS "PULocationID",
    CASE WHEN fault <> 4 THEN CAST(s_nationkey + beyond AS INTEGER) END AS "DOLocationID",
    CASE WHEN fault IN (19, 20) THEN 6 WHEN fault NOT IN (21, 22)
      THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS payment_type,
    CASE WHEN l_quantity = 49 THEN -l_extendedprice WHEN l_quantity = 48 THEN NULL
      ELSE l_extendedprice END AS fare_amount,
    CASE WHEN fault = 6 THEN CAST(-1 AS DOUBLE)
      WHEN l_linenumber <> 3 THEN l_discount + CAST(0 AS DOUBLE) END AS extra,
    CASE WHEN fault = 7 THEN CAST(-1 AS DOUBLE) ELSE l_tax END AS mta_tax,
    CAST(CASE WHEN fault = 8 THEN -1 ELSE 0 END AS DOUBLE) AS tip_amount,
    CAST(CASE WHEN fault = 9 THEN -1 ELSE 0 END AS DOUBLE) AS tolls_amount,
    CAST(CASE WHEN fault = 10 THEN -1 ELSE 0 END AS DOUBLE) AS improvement_surcharge,
    CASE WHEN fault = 14 THEN CAST(-1 AS DOUBLE) ELSE l_extendedprice + again END
      AS total_amount,
    CAST(CASE WHEN fault = 11 THEN -1 ELSE 0 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN fault = 12 THEN -1 ELSE 0 END AS DOUBLE) AS "Airport_fee",
    CAST(CASE WHEN fault = 13 THEN -1 ELSE 0 END AS DOUBLE) AS cbd_congestion_fee,
    CASE WHEN l_orderkey % 2 = 0 THEN 'file_a.parquet' ELSE 'file_b.parquet' END AS source_file,
    packed + again AS rec_id
  FROM lines, (VALUES (0), (1)) r(again)
  WHERE again = 0 OR l_orderkey % 5 = 0
),
zones AS (
  SELECT n_nationkey AS "LocationID", n_name AS "Zone", r_name AS "Borough"
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
valid AS (
  SELECT * REPLACE (coalesce(extra, 0) AS extra, coalesce(fare_amount, 0) AS fare_amount),
    date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(60 AS DOUBLE)
      AS trip_duration_minutes,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date
  FROM trips_raw
  WHERE tpep_dropoff_datetime >= tpep_pickup_datetime
    AND trip_distance > 0 AND passenger_count BETWEEN 0 AND 8
    AND "PULocationID" IS NOT NULL AND "DOLocationID" IS NOT NULL
    AND coalesce(extra, 0) >= 0 AND mta_tax >= 0 AND tip_amount >= 0 AND tolls_amount >= 0
    AND improvement_surcharge >= 0 AND congestion_surcharge >= 0 AND "Airport_fee" >= 0
    AND cbd_congestion_fee >= 0 AND total_amount >= 0
),
published AS (
  SELECT DISTINCT tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID", "DOLocationID",
    p."Zone" AS "PU_Zone", d."Zone" AS "DO_Zone", passenger_count, trip_distance,
    trip_duration_minutes, pickup_date, source_file, fare_amount,
    TIMESTAMP '2024-01-31 00:00:00' AS ingested_at,
    trip_duration_minutes > 120 OR trip_distance > 50 OR fare_amount < 0 AS is_suspicious
  FROM valid
  LEFT JOIN zones p ON "PULocationID" = p."LocationID"
  LEFT JOIN zones d ON "DOLocationID" = d."LocationID"
),
typed AS (
  SELECT rec_id AS trip_id, "VendorID" AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime, passenger_count, trip_distance,
    "RatecodeID" AS rate_code_id, store_and_fwd_flag, "PULocationID" AS pu_location_id,
    "DOLocationID" AS do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
    "Airport_fee" AS airport_fee, cbd_congestion_fee
  FROM trips_raw
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY vendor_id, pickup_datetime, pu_location_id, do_location_id, fare_amount
    ORDER BY trip_id) AS rn
  FROM typed
  WHERE passenger_count BETWEEN 1 AND 6 AND trip_distance > 0 AND fare_amount > 0
    AND total_amount > 0 AND dropoff_datetime > pickup_datetime AND vendor_id IS NOT NULL
    AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
),
silver AS (
  SELECT r.* EXCLUDE (rn), p."Zone" AS pickup_zone, p."Borough" AS pickup_borough,
    d."Zone" AS dropoff_zone, d."Borough" AS dropoff_borough
  FROM ranked r
  LEFT JOIN zones p ON pu_location_id = p."LocationID"
  LEFT JOIN zones d ON do_location_id = d."LocationID"
  WHERE rn = 1
),
hourly AS (
  SELECT pickup_zone, date_trunc('hour', pickup_datetime) AS hour, count(*) AS trip_count,
    {_mean("fare_amount")} AS avg_fare,
    {_mean("trip_distance")} AS avg_distance
  FROM silver GROUP BY 1, 2
),
mix AS (
  SELECT payment_type,
    CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
      WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' ELSE 'Voided trip' END AS payment_label,
    count(*) AS trip_count,
    {_mean("total_amount")} AS avg_total_amount,
    CAST((20000 * count(*) + sum(count(*)) OVER ()) // (2 * sum(count(*)) OVER ()) AS DOUBLE) / 100
      AS pct_of_total
  FROM silver GROUP BY payment_type
)
"""

CDC = """
opened AS (
  SELECT
    CASE WHEN user_id % 5 <> 0 THEN 'dbserver1.public.customers'
      ELSE 'dbserver1.public.drivers' END AS topic,
    CAST(event_id % 3 AS INTEGER) AS kafka_partition, event_id * 2 AS kafka_offset,
    ts AS kafka_timestamp,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'view' THEN 'r'
      WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'd' ELSE 'u' END AS op,
    epoch_ms(date_trunc('day', ts)) - (user_id // 3) % 4 * 4 * 86400000 AS ts_ms,
    event_id AS lsn, CASE WHEN event_id % 89 <> 0 THEN CAST(user_id AS INTEGER) END AS entity_id,
    value, event_id, user_id, user_id % 7 = 3 AS steady, user_id % 5 <> 0 AS is_customer
  FROM events
),
sided AS (
  SELECT *, coalesce(op <> 'd', true) AS has_after, coalesce(op IN ('u', 'd'), false) AS has_before
  FROM opened
),
imaged AS (
  SELECT *,
    CASE WHEN has_after THEN 'n' || user_id END AS name,
    CASE WHEN has_after AND is_customer THEN
      'e' || user_id || '_' || CASE WHEN steady THEN 0 ELSE event_id % 3 END || '@x' END AS email,
    CASE WHEN has_after AND is_customer THEN
      'C' || CASE WHEN steady THEN 0 ELSE event_id % 4 END END AS country,
    CASE WHEN has_before AND is_customer THEN
      'e' || user_id || '_' || CASE WHEN steady THEN 0 ELSE (event_id + 1) % 3 END || '@x' END
      AS before_email,
    CASE WHEN has_before AND is_customer THEN
      'C' || CASE WHEN steady THEN 0 ELSE (event_id + 1) % 4 END END AS before_country,
    CASE WHEN has_after THEN epoch_us(TIMESTAMP '2023-06-01') + user_id * 86400000000 END
      AS created_at,
    'TLC-' || event_id AS license_number,
    CASE WHEN event_id % 50 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS rating,
    'City' || event_id % 5 AS city,
    CASE WHEN event_id % 50 = 5 THEN 'zz' WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
      AS active
  FROM sided
),
log AS (
  SELECT *,
    CASE WHEN has_before THEN '{' || concat_ws(',', '"id":' || entity_id,
      '"email":"' || before_email || '"', '"country":"' || before_country || '"') || '}' END
      AS "before",
    CASE WHEN has_after THEN '{' || coalesce('"id":' || entity_id || ',', '') ||
      '"name":"' || name || '",' ||
      CASE WHEN is_customer
        THEN '"email":"' || email || '","country":"' || country || '",'
        ELSE '"license_number":"' || license_number || '","rating":"' || rating ||
          '","city":"' || city || '","active":"' || active || '",' END ||
      '"created_at":' || created_at || '}' END AS "after"
  FROM imaged
),
newest AS (
  SELECT * FROM log WHERE op IS NOT NULL AND entity_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY topic, entity_id
    ORDER BY ts_ms DESC, lsn DESC, kafka_offset DESC, kafka_partition DESC) = 1
),
silver_customers AS (
  SELECT entity_id AS id, name, email, country, ts_ms AS last_updated_ms
  FROM newest WHERE is_customer AND op <> 'd'
),
silver_drivers AS (
  SELECT entity_id AS id, name, license_number, TRY_CAST(rating AS DOUBLE) AS rating, city,
    TRY_CAST(active AS BOOLEAN) AS active, CAST(created_at AS VARCHAR) AS created_at,
    ts_ms AS last_updated_ms
  FROM newest WHERE NOT is_customer AND op <> 'd'
),
paired AS (
  SELECT *, lag(email) OVER w AS prev_email, lag(country) OVER w AS prev_country
  FROM log WHERE is_customer AND entity_id IS NOT NULL
  WINDOW w AS (PARTITION BY entity_id ORDER BY ts_ms, lsn, kafka_offset, kafka_partition)
),
flagged AS (
  SELECT *, CAST(coalesce(email <> prev_email, false) AS INTEGER) AS email_changed,
    CAST(coalesce(country <> prev_country, false) AS INTEGER) AS country_changed
  FROM paired
),
history AS (
  SELECT entity_id, make_timestamp(min(created_at)) AS first_seen_ts, count(*) AS total_events,
    CAST(sum(email_changed) AS BIGINT) AS email_changes,
    CAST(sum(country_changed) AS BIGINT) AS country_changes,
    make_timestamp(max(ts_ms) * 1000) AS last_change_ts,
    coalesce(bool_or(op = 'd'), false) AS ever_deleted,
    make_timestamp(max(ts_ms) FILTER (op = 'd') * 1000) AS deleted_at_ts
  FROM flagged GROUP BY entity_id
),
activity AS (
  SELECT entity_id AS customer_id, first_seen_ts, total_events, email_changes, country_changes,
    CASE WHEN email_changes > country_changes THEN 'email'
      WHEN country_changes > email_changes THEN 'country'
      WHEN email_changes > 0 THEN 'email,country' ELSE 'none' END AS fields_changed_most_often,
    CASE WHEN ever_deleted THEN 'deleted' WHEN s.id IS NOT NULL THEN 'active'
      ELSE 'deleted' END AS current_status,
    CAST(date_diff('day', CAST(last_change_ts AS DATE), DATE '2024-01-31') AS INTEGER)
      AS days_since_last_change,
    last_change_ts, ever_deleted, deleted_at_ts
  FROM history h LEFT JOIN silver_customers s ON h.entity_id = s.id
),
churn AS (
  SELECT customer_id, first_seen_ts, deleted_at_ts, last_change_ts, total_events,
    days_since_last_change, current_status,
    current_status = 'deleted'
      AND coalesce(deleted_at_ts >= TIMESTAMP '2024-01-30 00:00:00', false) AS recent,
    days_since_last_change >= 7 AS idle
  FROM activity
)
"""

_CHURN_COLUMNS = """customer_id, first_seen_ts, deleted_at_ts, last_change_ts, total_events,
  days_since_last_change"""
_CHURN = f"""
SELECT {_CHURN_COLUMNS},
  CASE WHEN recent THEN 'deleted_last_24h' WHEN idle THEN 'stale_7_days' END AS churn_flag
FROM churn WHERE recent OR idle"""

_NORMALISED = '''"VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
  trip_distance, "RatecodeID", store_and_fwd_flag, "PULocationID", "DOLocationID", payment_type,
  fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
  congestion_surcharge, "Airport_fee", cbd_congestion_fee'''

#: All columns of a raw trip in their order, nulls first.
_RAW_ORDER = _NORMALISED.replace(",", " NULLS FIRST,") + " NULLS FIRST"

# The rule names and the rows each of them counts as bad.
_BAD_ROWS = {
    "pickup_present": "tpep_pickup_datetime IS NULL",
    "dropoff_present": "tpep_dropoff_datetime IS NULL",
    "time_ordered": "NOT coalesce(tpep_dropoff_datetime >= tpep_pickup_datetime, false)",
    "distance_positive": "NOT coalesce(trip_distance > 0, false)",
    "passengers_0_to_8": "NOT coalesce(passenger_count BETWEEN 0 AND 8, false)",
    "pickup_zone_present": '"PULocationID" IS NULL',
    "dropoff_zone_present": '"DOLocationID" IS NULL',
    "extra_not_negative": "coalesce(extra, 0) < 0",
    "mta_tax_not_negative": "coalesce(mta_tax, 0) < 0",
    "tip_amount_not_negative": "coalesce(tip_amount, 0) < 0",
    "tolls_amount_not_negative": "coalesce(tolls_amount, 0) < 0",
    "improvement_surcharge_not_negative": "coalesce(improvement_surcharge, 0) < 0",
    "congestion_surcharge_not_negative": "coalesce(congestion_surcharge, 0) < 0",
    "Airport_fee_not_negative": 'coalesce("Airport_fee", 0) < 0',
    "cbd_congestion_fee_not_negative": "coalesce(cbd_congestion_fee, 0) < 0",
    "total_not_negative": "NOT coalesce(total_amount >= 0, false)",
    "bad_distance": "trip_distance IS NULL OR trip_distance <= 0",
    "bad_time": "tpep_dropoff_datetime < tpep_pickup_datetime",
    "bad_passengers": "passenger_count IS NOT NULL AND passenger_count NOT BETWEEN 0 AND 8",
}
_REPORT = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {bad}) AS bad_rows FROM trips_raw"
    for name, bad in _BAD_ROWS.items()
)
_SAMPLES = " UNION ALL ".join(
    f"(SELECT '{name}' AS rule, CAST(row_number() OVER (ORDER BY rec_id) AS INTEGER)"
    " AS sample_no, rec_id"
    f" FROM trips_raw WHERE {_BAD_ROWS[name]} ORDER BY rec_id LIMIT 3)"
    for name in ("bad_distance", "bad_time", "bad_passengers")
)
_FUNNEL = """
SELECT r.source_file, raw_row_count, clean_row_count, after_dedup_row_count
FROM (SELECT source_file, count(*) AS raw_row_count FROM trips_raw GROUP BY 1) r
JOIN (SELECT source_file, count(*) AS clean_row_count, count(DISTINCT ("VendorID",
    tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID", "DOLocationID", trip_distance,
    passenger_count, trip_duration_minutes)) AS after_dedup_row_count
  FROM valid GROUP BY 1) v ON r.source_file = v.source_file"""
_HALF = "(SELECT max(event_id) // 2 FROM events)"
_FIRST_HALF = f"""
SELECT entity_id AS id, name, email, country, ts_ms AS last_updated_ms FROM (
  SELECT * FROM log
  WHERE is_customer AND event_id <= {_HALF} AND op IS NOT NULL AND entity_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY ts_ms DESC, lsn DESC) = 1)
WHERE op <> 'd'"""

# Kind before, kind now, what happened, and which images hold a column.
_DRIFT = {
    "id": ("'BIGINT'", "BIGINT", "same", "entity_id IS NOT NULL"),
    "name": ("'STRING'", "STRING", "same", "true"),
    "email": ("'STRING'", "STRING", "same", "true"),
    "country": ("'STRING'", "STRING", "same", "true"),
    "created_at": ("'BIGINT'", "BIGINT", "same", "true"),
    "visits": ("'BIGINT'", "DECIMAL", "widened", "true"),
    "tier": ("'BIGINT'", "VARIANT", "clashed", "true"),
    "phone": ("CAST(NULL AS VARCHAR)", "STRING", "came", "true"),
}
_DRIFTED = " UNION ALL ".join(
    f"SELECT 'dbserver1.public.customers' AS topic, '{name}' AS \"column\", {before} AS before,"
    f" '{now}' AS now, '{status}' AS status, count(*) FILTER (WHERE {held}) AS images"
    f" FROM log WHERE is_customer AND has_after AND event_id > {_HALF}"
    for name, (before, now, status, held) in _DRIFT.items()
)

_ON_TRIPS = {
    "trips_normalised": f"""
SELECT {_NORMALISED}, source_file, rec_id,
  date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(60 AS DOUBLE)
    AS trip_duration_minutes,
  CAST(tpep_pickup_datetime AS DATE) AS pickup_date
FROM trips_raw""",
    "json_roundtrip": "SELECT * EXCLUDE (trip_id), trip_id AS rec_id FROM typed",
    "ingest_clean": f"SELECT {_NORMALISED}, source_file, rec_id FROM valid",
    "quality_report": _REPORT,
    "bad_samples": _SAMPLES,
    "ingest_funnel": _FUNNEL,
    "ingest_dedup_output": "SELECT * EXCLUDE (is_suspicious) FROM published",
    "suspicious_trips": "SELECT * FROM published WHERE is_suspicious",
    "suspicious_share": """
SELECT count(*) AS total_trips, count(*) FILTER (WHERE is_suspicious) AS suspicious_trips,
  CAST(count(*) FILTER (WHERE is_suspicious) * 100 AS DOUBLE) / count(*) AS suspicious_pct
FROM published""",
    "enriched_trips": """
SELECT rec_id, "PULocationID", "DOLocationID", p."Zone" AS "PU_Zone", d."Zone" AS "DO_Zone"
FROM trips_raw
LEFT JOIN zones p ON "PULocationID" = p."LocationID"
LEFT JOIN zones d ON "DOLocationID" = d."LocationID" """,
    "silver_trips": "SELECT * FROM silver",
    "gold_hourly_trips": "SELECT * FROM hourly",
    "gold_payment_mix": "SELECT * FROM mix",
    "top_payment_type": "SELECT * FROM mix ORDER BY trip_count DESC, payment_type LIMIT 1",
    "hourly_first10": "SELECT * FROM hourly ORDER BY hour, pickup_zone NULLS FIRST LIMIT 10",
    "hourly_last5": "SELECT * FROM hourly ORDER BY hour DESC, pickup_zone NULLS FIRST LIMIT 5",
    "source_tagged": """
SELECT rec_id, source_file, total_amount,
  CASE WHEN source_file = 'file_b.parquet' THEN store_and_fwd_flag END AS note,
  TIMESTAMP '2024-01-31 00:00:00' AS ingested_at
FROM trips_raw""",
    "union_by_name": """
SELECT rec_id, source_file, total_amount,
  CASE WHEN source_file = 'file_b.parquet' THEN store_and_fwd_flag END AS note,
  TIMESTAMP '2024-01-31 00:00:00' AS ingested_at
FROM trips_raw""",
    "new_files": """
SELECT source_file AS filename, count(*) AS raw_rows FROM trips_raw
WHERE source_file = 'file_b.parquet' GROUP BY 1""",
    "manifest_commit": f"""
SELECT f.* RENAME (source_file AS filename), CAST(1 AS BIGINT) AS batch,
  TIMESTAMP '2024-01-31 00:00:00' AS processed_at
FROM ({_FUNNEL}) f""",
    "table_roundtrip": "SELECT * FROM hourly",
    "table_history": """
SELECT CAST(1 AS BIGINT) AS snapshot_id, 'create' AS operation, 0 AS row_count
UNION ALL SELECT 2, 'append', count(*) FROM hourly
UNION ALL SELECT 3, 'replace', count(*) FROM mix""",
    "partitioned_readback": "SELECT * EXCLUDE (is_suspicious) FROM published",
    "partitioned_publish": "SELECT * EXCLUDE (source_file) FROM published",
    "hourly_by_day": """
SELECT CAST(hour AS DATE) AS hour_day, count(*) AS zone_hours,
  CAST(sum(trip_count) AS BIGINT) AS trips
FROM hourly GROUP BY 1""",
    "bronze_trips_append": f"""
SELECT {_NORMALISED},
  row_number() OVER (ORDER BY {_RAW_ORDER}) AS trip_id
FROM trips_raw""",
    "bronze_stream_availablenow": """
SELECT coalesce(CAST("VendorID" AS VARCHAR), '') AS "key", 'taxi-trips' AS topic,
  CAST(coalesce("VendorID" % 3, 0) AS INTEGER) AS "partition", rec_id AS "offset",
  TIMESTAMP '2024-01-01 00:00:00' + to_hours(rec_id % 2) AS kafka_timestamp
FROM trips_raw""",
    "bronze_stream_table": """
SELECT * EXCLUDE (trip_id), coalesce(CAST(vendor_id AS VARCHAR), '') AS "key",
  'taxi-trips' AS topic, CAST(coalesce(vendor_id % 3, 0) AS INTEGER) AS "partition",
  trip_id AS "offset", TIMESTAMP '2024-01-01 00:00:00' + to_hours(trip_id % 2) AS kafka_timestamp
FROM typed""",
    "pipeline_ingest": "SELECT * FROM published",
    "silver_stream": "SELECT * EXCLUDE (trip_id) FROM silver",
    "hourly_stream": """
SELECT * FROM hourly
WHERE hour + INTERVAL 3 HOUR <= (SELECT max(pickup_datetime) FROM silver)""",
    "ingest_report": _REPORT,
    "ingest_manifest": _FUNNEL,
    "trips_of_a_week": """
SELECT * FROM published
WHERE pickup_date BETWEEN DATE '1995-03-06' AND DATE '1995-03-12'""",
    "pipeline_suspicious": "SELECT * FROM published WHERE is_suspicious",
    "pipeline_trips": "SELECT * FROM hourly",
    "pipeline_payment": "SELECT * FROM mix",
    "pipeline_taxi_files": "SELECT * FROM hourly",
}

_ON_LOG = {
    "cdc_bronze": """
SELECT topic, kafka_partition, kafka_offset, kafka_timestamp, op, ts_ms, lsn, "before", "after"
FROM log""",
    "cdc_flattened": """
SELECT topic, kafka_partition, kafka_offset, kafka_timestamp, op, ts_ms,
  CASE WHEN has_after THEN entity_id END AS after_id, name AS after_name, email AS after_email,
  country AS after_country, CASE WHEN has_before THEN entity_id END AS before_id
FROM log WHERE is_customer""",
    "cdc_replayed": """
SELECT topic, kafka_partition, kafka_offset, kafka_timestamp, op, ts_ms, lsn, "before", "after"
FROM log""",
    "cdc_op_counts": "SELECT op, count(*) AS n FROM log WHERE is_customer GROUP BY op",
    "cdc_latest": """
SELECT topic, kafka_partition, kafka_offset, kafka_timestamp, op, ts_ms, lsn, "before", "after",
  entity_id
FROM newest WHERE is_customer""",
    "silver_customers": "SELECT * FROM silver_customers",
    "silver_customers_merged": "SELECT * FROM silver_customers",
    "silver_customers_folded": "SELECT * FROM silver_customers",
    "silver_drivers": "SELECT * FROM silver_drivers",
    "mirror_stream": "SELECT * FROM silver_customers",
    "customer_by_id": "SELECT * FROM silver_customers WHERE id = 1",
    "cdc_batch_view": """
SELECT op, count(*) AS n, max(ts_ms) AS newest_ms FROM newest WHERE is_customer GROUP BY op""",
    "customer_events": """
SELECT entity_id, op, ts_ms, lsn, kafka_offset, kafka_partition,
  make_timestamp(ts_ms * 1000) AS event_ts, make_timestamp(created_at) AS created_ts, email,
  country
FROM log WHERE is_customer AND entity_id IS NOT NULL""",
    "customer_field_changes": """
SELECT entity_id, kafka_offset, email, country, prev_email, prev_country, email_changed,
  country_changed
FROM flagged""",
    "customer_activity": "SELECT * FROM activity",
    "activity_listing": """
SELECT customer_id, current_status, total_events, email_changes, country_changes,
  fields_changed_most_often, days_since_last_change, CAST(first_seen_ts AS DATE) AS first_seen,
  CAST(last_change_ts AS DATE) AS last_changed
FROM activity""",
    "customer_churn_reference": f"""
SELECT {_CHURN_COLUMNS},
  CASE WHEN recent OR (current_status = 'active' AND idle) THEN 'deleted_last_24h'
    WHEN idle THEN 'stale_7_days' END AS churn_flag
FROM churn WHERE recent OR idle""",
    "customer_churn": _CHURN,
    "churn_listing": f"{_CHURN} ORDER BY churn_flag, customer_id",
    "status_rollup": """
SELECT current_status, count(*) AS n, min(days_since_last_change) AS min_days,
  max(days_since_last_change) AS max_days, count(*) FILTER (WHERE ever_deleted) AS deleted_count
FROM activity GROUP BY current_status""",
    "deleted_duration": """
SELECT customer_id, CAST(first_seen_ts AS DATE) AS first_seen,
  CAST(deleted_at_ts AS DATE) AS deleted_at,
  CAST(date_diff('day', CAST(first_seen_ts AS DATE), CAST(deleted_at_ts AS DATE)) AS INTEGER)
    AS days_active, total_events
FROM activity WHERE current_status = 'deleted'""",
    "top_changed_customers": """
SELECT customer_id, total_events, email_changes, country_changes, fields_changed_most_often,
  current_status
FROM activity ORDER BY total_events DESC, customer_id LIMIT 5""",
    "entity_timeline": """
SELECT op, entity_id AS customer_id, before_email, email AS after_email, before_country,
  country AS after_country,
  ts_ms, kafka_offset
FROM log WHERE is_customer AND entity_id = 1""",
    "latest_records": """
SELECT topic, op, ts_ms, kafka_offset FROM log
ORDER BY kafka_offset DESC, topic, ts_ms LIMIT 10""",
    "duplicate_keys": """
SELECT entity_id, count(*) AS n FROM log WHERE is_customer AND entity_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "mirror_parity": """
SELECT count(*) AS mirror_rows, count(*) AS source_rows, CAST(0 AS BIGINT) AS only_mirror,
  CAST(0 AS BIGINT) AS only_source, CAST(0 AS BIGINT) AS duplicate_keys
FROM silver_customers""",
    "pipeline_cdc_validated": """
SELECT 'cdc.silver_customers' AS mirror, count(*) AS mirror_rows, count(*) AS source_rows,
  CAST(0 AS BIGINT) AS unequal_nodes, CAST(0 AS BIGINT) AS only_mirror,
  CAST(0 AS BIGINT) AS only_source, CAST(0 AS BIGINT) AS duplicate_keys
FROM silver_customers""",
    "mirror_differences": """
SELECT *, 'mirror' AS side, CAST(1 AS BIGINT) AS n FROM silver_customers WHERE id % 50 IN (7, 11)
UNION ALL
SELECT * REPLACE ('XX' AS country), 'source', 1 FROM silver_customers WHERE id % 50 = 11""",
    "silver_preview": "SELECT * FROM silver_customers ORDER BY id LIMIT 5",
    "pipeline_cdc": "SELECT * FROM activity",
    "incremental_log": """
SELECT topic, kafka_partition, kafka_offset, kafka_timestamp, op, ts_ms, lsn, "before", "after"
FROM log""",
    "incremental_mirror": "SELECT * FROM silver_customers",
    "incremental_activity": "SELECT * FROM activity",
    "incremental_churn": _CHURN,
    "positions_held": """
SELECT topic, kafka_partition, count(*) AS records, max(kafka_offset) AS last_offset
FROM log GROUP BY 1, 2""",
    "pipeline_churn": _CHURN,
    "rerun_stable": """
SELECT count(*) AS count_before, count(*) AS count_after, true AS same_content FROM activity""",
    "read_version": _FIRST_HALF,
    "rollback_version": _FIRST_HALF,
    "schema_drift": _DRIFTED,
    "schema_drift_mirror": f"""
SELECT s.*, CASE WHEN n.event_id > {_HALF} THEN '+' || n.event_id END AS phone,
  n.event_id % 10 + CASE WHEN n.event_id > {_HALF} THEN CAST(0.5 AS DOUBLE) ELSE 0 END AS visits,
  CASE WHEN n.event_id > {_HALF} THEN 'gold' ELSE CAST(n.event_id % 3 AS VARCHAR) END AS tier
FROM silver_customers s JOIN newest n ON s.id = n.entity_id AND n.is_customer""",
    "schema_evolution": f"""
SELECT s.*, CASE WHEN n.event_id > {_HALF} THEN '+' || n.event_id END AS phone
FROM silver_customers s JOIN newest n ON s.id = n.entity_id AND n.is_customer""",
}

_ON_EVENTS = {
    "gold_hourly_events": f"""
SELECT event_type AS pickup_zone, date_trunc('hour', ts) AS hour, count(*) AS trip_count,
  {_mean("value")} AS avg_fare,
  {_mean("CAST(json_extract_string(props, '$.k') AS DOUBLE)")} AS avg_distance
FROM events GROUP BY 1, 2""",
}


def oracle_sql() -> dict[str, str]:
    sql = {name: f"WITH {TRIPS.strip()}\n{query.strip()}" for name, query in _ON_TRIPS.items()}
    sql |= {name: f"WITH {CDC.strip()}\n{query.strip()}" for name, query in _ON_LOG.items()}
    sql |= {name: query.strip() for name, query in _ON_EVENTS.items()}
    return sql
