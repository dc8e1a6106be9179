"""Stand-in views: the tables the pipelines expect, derived from the shared parquet tables.

The text is valid in both engines, so both start from the same rows. Tokens: ``{name}`` another
view or table, ``JOB(x)`` the job of an event, ``EPOCH(x)`` seconds since 1970, ``TIMESTAMP_NTZ`` the zoneless type. Nothing is
sampled: every view is a projection or aggregate of whole tables, or the events of one type.
"""

VIEWS: dict[str, str] = {}

# --- staffing views over the event stream -----------------------------------------------------

VIEWS["shifts"] = """
SELECT user_id, JOB(event_id) AS job_id, event_id AS segment_id, ts AS shift_start,
       ts + hours * INTERVAL '1' HOUR AS shift_end, hours AS hours_worked,
       CAST(floor(value) AS DOUBLE) AS job_wage
FROM (SELECT *, CAST(floor(value) AS INT) % 12 + 1 AS hours FROM {events}) e
"""

VIEWS["worked_pairs"] = """
SELECT user_id, JOB(event_id) AS job_id FROM {events} WHERE event_type = 'purchase'
"""

VIEWS["segments"] = """
SELECT job_id, segment_index, EPOCH(start_at) AS start_time, start_time_offset, active, created_at
FROM (SELECT JOB(event_id) AS job_id, event_id AS segment_index, value >= 1 AS active, ts AS created_at,
             ts + (JOB(event_id) % 28) * INTERVAL '1' DAY AS start_at,
             CAST(JOB(event_id) % 5 * 90 AS INT) AS start_time_offset
      FROM {events}) s
"""

VIEWS["event_jobs"] = """
SELECT job_id, job_created_at, job_created_at + (job_id % 28) * INTERVAL '1' DAY AS job_start_date_time,
       job_id % 5 + 5 AS job_needed_original_count,
       CASE WHEN job_id % 4 = 0 THEN NULL ELSE job_id % 12 END AS invited_worker_count
FROM (SELECT JOB(event_id) AS job_id, min(ts) AS job_created_at FROM {events} GROUP BY 1) j
"""

VIEWS["applications"] = """
SELECT user_id, JOB(event_id) AS job_id,
       CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
                       WHEN 'signup' THEN 7 ELSE 8 END AS applied_status_enum,
       ts AS applied_status_start_date,
       coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                TIMESTAMP_NTZ '2099-01-01 00:00:00') AS end_date
FROM {events}
"""

VIEWS["needed_periods"] = """
SELECT JOB(event_id) AS job_id, CAST(floor(value) AS INT) % 10 + 1 AS needed, ts AS start_date,
       coalesce(lead(ts) OVER (PARTITION BY JOB(event_id) ORDER BY ts, event_id),
                TIMESTAMP_NTZ '2099-01-01 00:00:00') AS end_date
FROM {events} WHERE event_type = 'signup'
"""

VIEWS["requests"] = """
SELECT user_id, JOB(event_id) AS job_id, ts AS request_created_at,
       CASE WHEN value < 50 THEN ts + INTERVAL '6' HOUR END AS request_confirmed_at
FROM {events} WHERE event_type = 'signup'
"""

VIEWS["status"] = """
SELECT user_id, event_id, event_type AS status, ts AS start_date,
       coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                TIMESTAMP_NTZ '2099-01-01 00:00:00') AS end_date
FROM {events}
"""

VIEWS["job_views"] = """
SELECT JOB(event_id) AS job_id, CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) AS received_at
FROM {events} WHERE event_type = 'view'
"""

VIEWS["job_applies"] = """
SELECT JOB(event_id) AS job_id, CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) AS created_at
FROM {events} WHERE event_type = 'click'
"""

VIEWS["view_instants"] = """
SELECT JOB(event_id) AS job_id, CAST(ts AS TIMESTAMP_NTZ) AS received_at FROM {events} WHERE event_type = 'view'
"""

VIEWS["apply_instants"] = """
SELECT JOB(event_id) AS job_id, CAST(ts AS TIMESTAMP_NTZ) AS created_at FROM {events} WHERE event_type = 'click'
"""

VIEWS["ratings"] = """
SELECT event_id AS id, user_id, event_id % 5 + 1 AS rating,
       CAST(date_trunc('day', ts) AS TIMESTAMP_NTZ) AS created_at,
       CASE WHEN value < 30 THEN 'Not the Right Fit today' WHEN value < 90 THEN 'late' END AS reason
FROM {events} WHERE event_type = 'purchase'
"""

VIEWS["dont_send"] = """
SELECT event_id AS rating_id, ts AS created_at FROM {events} WHERE event_type = 'purchase' AND value < 20
"""

VIEWS["favorites"] = """
SELECT DISTINCT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP_NTZ) AS created_at
FROM {events} WHERE event_type = 'purchase' AND value > 60
"""

VIEWS["no_shows"] = """
SELECT user_id, event_id AS segment_id, ts AS no_show_shift_start_time_utc
FROM {events} WHERE event_type = 'signup'
"""

VIEWS["cancellations"] = """
SELECT user_id, event_id AS snc_index, ts AS cancel_timestamp_utc FROM {events} WHERE event_type = 'error'
"""

VIEWS["certifications"] = """
SELECT user_id, event_type AS cert_name, ts AS cert_completed_on, event_id % 2 AS cert_verified FROM {events}
"""

VIEWS["cancel_labels"] = """
SELECT event_id AS cancel_id, user_id AS cancel_user_id, JOB(event_id) AS cancel_job_id, ts AS cancel_created_at,
       25 + (user_id * 7919 % 2400) / 100.0 AS user_address_latitude,
       -120 + (user_id * 104729 % 5000) / 100.0 AS user_address_longitude,
       CASE WHEN value < 50 THEN 'Event Staff' ELSE 'Warehouse' END AS job_type
FROM {events} WHERE event_type = 'error'
"""

VIEWS["job_places"] = """
SELECT JOB(event_id) AS job_id, ts AS job_created_at,
       25 + (event_id * 7919 % 2400) / 100.0 AS job_address_latitude,
       -120 + (event_id * 104729 % 5000) / 100.0 AS job_address_longitude
FROM {events} WHERE event_type = 'view'
"""

VIEWS["funnel"] = """
SELECT s.user_id, s.ts AS user_signup_date, m.browsed_for_jobs_date, m.selected_first_job_date,
       m.eligible_date, m.first_shift_worked_date, s.ts AS etl_date
FROM {events} s
JOIN (SELECT user_id,
             min(CASE WHEN event_type = 'view' THEN ts END) AS browsed_for_jobs_date,
             min(CASE WHEN event_type = 'click' THEN ts END) AS selected_first_job_date,
             max(CASE WHEN event_type = 'error' THEN ts END) AS eligible_date,
             min(CASE WHEN event_type = 'purchase' AND value > 150 THEN ts END) AS first_shift_worked_date
      FROM {events} GROUP BY user_id) m ON m.user_id = s.user_id
WHERE s.event_type = 'signup'
"""

VIEWS["fiscal_periods"] = """
SELECT user_id % 13 + 1 AS period, min(CAST(ts AS DATE)) AS start_date, max(CAST(ts AS DATE)) AS end_date
FROM {events} GROUP BY 1
"""

# five days of each week with an event, so that days between the periods are missing
VIEWS["fiscal_weeks"] = """
SELECT CAST(date_trunc('week', ts) AS DATE) AS start_date, CAST(date_trunc('week', ts) AS DATE) + 4 AS end_date
FROM {events} GROUP BY 1, 2
"""

# --- change logs and market views over orders -------------------------------------------------

VIEWS["needed_edits"] = """
SELECT job_id, old_needed, new_needed, created_at, edit_id FROM (
  SELECT o_custkey AS job_id, o_orderkey AS edit_id, o_orderdate AS created_at,
         CAST(floor(o_totalprice) AS BIGINT) % 20 AS new_needed,
         lag(CAST(floor(o_totalprice) AS BIGINT) % 20) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
           AS old_needed
  FROM {orders}) e
WHERE old_needed IS NOT NULL
"""

VIEWS["needed_current"] = """
SELECT job_id, needed FROM (
  SELECT o_custkey AS job_id, CAST(floor(o_totalprice) AS BIGINT) % 20 AS needed,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM {orders}) c
WHERE n = 1
"""

VIEWS["overfill_edits"] = """
SELECT job_id, old_overfill, new_overfill, created_at, edit_id FROM (
  SELECT o_custkey AS job_id, o_orderkey AS edit_id, o_orderdate AS created_at,
         o_orderpriority AS new_overfill,
         lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS old_overfill
  FROM {orders}) e
WHERE old_overfill IS NOT NULL
"""

VIEWS["overfill_current"] = """
SELECT job_id, overfill FROM (
  SELECT o_custkey AS job_id, o_orderpriority AS overfill,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM {orders}) c
WHERE n = 1
"""

VIEWS["market_jobs"] = """
SELECT o_orderkey AS job_id, o_orderdate AS job_created_at,
       o_orderdate + (o_orderkey % 30) * INTERVAL '1' DAY + INTERVAL '6' HOUR AS job_start_date_time,
       o_orderpriority AS job_type, c_mktsegment AS job_title, CAST(floor(o_totalprice) AS DOUBLE) AS job_wage,
       CAST(c_nationkey AS VARCHAR(10)) AS job_zipcode,
       CASE o_orderkey % 8 WHEN 0 THEN '1st Shift' WHEN 1 THEN 'Second crew' WHEN 2 THEN '3RD'
            WHEN 3 THEN 'Early AM shift' WHEN 4 THEN 'Night' WHEN 5 THEN 'Mon - Fri' WHEN 6 THEN 'flexible' END
         AS schedule_name,
       o_orderkey % 7 + 1 AS job_needed_last_count, o_orderkey % 3 AS job_overfill,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 12 END AS invited_worker_count,
       25 + (o_orderkey * 7919 % 2400) / 100.0 AS job_address_latitude,
       -120 + (o_orderkey * 104729 % 5000) / 100.0 AS job_address_longitude
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

VIEWS["zip_counties"] = """
SELECT CAST(n_nationkey AS VARCHAR(10)) AS zip, n_name AS county FROM {nation}
"""

VIEWS["market_users"] = """
SELECT c_custkey AS user_id, CAST(c_nationkey AS VARCHAR(10)) AS user_zipcode,
       25 + (c_custkey * 7919 % 2400) / 100.0 AS user_address_latitude,
       -120 + (c_custkey * 104729 % 5000) / 100.0 AS user_address_longitude
FROM {customer}
"""

VIEWS["user_status"] = """
SELECT user_id, user_status_enum, start_date,
       coalesce(lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date),
                TIMESTAMP_NTZ '2099-01-01 00:00:00') AS end_date
FROM (SELECT o_custkey AS user_id, o_orderdate AS start_date,
             min(CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS user_status_enum
      FROM {orders} GROUP BY 1, 2) d
"""

VIEWS["ios_log"] = """
SELECT o_custkey AS internal_id, o_orderdate AS original_timestamp FROM {orders} WHERE o_orderstatus = 'O'
"""

VIEWS["android_log"] = """
SELECT o_custkey AS internal_id, o_orderdate AS original_timestamp FROM {orders} WHERE o_orderstatus <> 'O'
"""
