"""Independent DuckDB SQL for every registered query.

Written the straightforward way (full windows per user, brute-force pair
join, OR anti join, row-number first/last) over the driver's raw tables, with
the fixture mapping re-derived in SQL. The Spark side is checked against it.
"""

from __future__ import annotations

from citymarts.plans.catalog import EARLY_RUN, HISTORY_BEFORE, MIX_DEPTH, MIX_RUN, PARTITION_DAY, RUN_DATE
from citymarts.sources.fixture import REGION_TZ
from citymarts.sources.lake import period


def _hav(a_lat, a_lon, b_lat, b_lon) -> str:
    return (f"(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(({b_lat}) - ({a_lat})) / 2), 2)"
            f" + cos(radians({a_lat})) * cos(radians({b_lat}))"
            f" * pow(sin(radians(({b_lon}) - ({a_lon})) / 2), 2)))))")


def _local(ts, tz) -> str:
    return f"timezone({tz}, timezone('UTC', {ts}))"


_TZ_LIST = "[" + ", ".join(f"'{t}'" for t in REGION_TZ) + "]"

BASE = f"""
geo AS (
  SELECT CAST(n_nationkey AS INTEGER) AS zone_id, n_name AS city,
         CAST(-60 + 5 * n_nationkey AS DOUBLE) AS lat,
         CAST(-150 + 12 * n_nationkey AS DOUBLE) AS lon,
         {_TZ_LIST}[n_regionkey + 1] AS tz
  FROM nation),
raw AS (
  SELECT event_id, ts, user_id, props,
         CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'reaction'
              WHEN event_type = 'signup' THEN 'subscription' ELSE 'message' END AS etype,
         CASE WHEN user_id % 3 = 0 THEN user_id % 5
              ELSE (user_id + day(ts) // 10) % 25 END AS hz
  FROM events),
se AS (
  SELECT event_id, CAST(ts AS DATE) + CAST(event_id % 71 = 0 AS INTEGER) AS date, etype AS event_type,
         CASE WHEN event_id % 97 <> 0
              THEN CAST(-60 + 5 * hz + (event_id % 10) * 0.002 AS DOUBLE) END AS lat,
         CASE WHEN event_id % 97 <> 0 THEN CAST(-150 + 12 * hz AS DOUBLE) END AS lon,
         CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 10 < 3 THEN date_trunc('hour', ts)
              ELSE ts END AS message_ts,
         CASE WHEN etype = 'message' AND event_id % 53 <> 0 THEN user_id END AS message_from,
         CASE WHEN etype = 'message' THEN user_id + 15 * (1 + event_id % 2) END AS message_to,
         CASE WHEN etype = 'subscription'
              THEN CASE WHEN event_id % 4 = 1 THEN '0' ELSE '' END || user_id END AS "user",
         CASE WHEN etype = 'subscription'
              THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 END AS channel
  FROM raw),
near AS (
  SELECT event_id, zone_id, city, tz, clat, clon FROM (
    SELECT e.event_id, g.zone_id, g.city, g.tz, g.lat AS clat, g.lon AS clon,
           row_number() OVER (PARTITION BY e.event_id
                              ORDER BY {_hav('e.lat', 'e.lon', 'g.lat', 'g.lon')}, g.zone_id) AS rn
    FROM se e JOIN geo g
      ON e.lat IS NOT NULL AND e.lon IS NOT NULL AND NOT isnan(e.lat) AND NOT isnan(e.lon))
  WHERE rn = 1),
sez AS (
  SELECT se.*, near.zone_id, near.city, near.tz, near.clat, near.clon
  FROM se LEFT JOIN near USING (event_id))"""

USERS = """
msgs AS (
  SELECT message_from AS user_id, event_id, message_ts, CAST(message_ts AS DATE) AS day,
         city, tz
  FROM sez WHERE event_type = 'message'),
fl AS (
  SELECT *, lag(city) OVER (PARTITION BY user_id ORDER BY message_ts DESC, event_id DESC)
            AS next_city
  FROM msgs),
runs AS (
  SELECT *, CASE WHEN next_city IS NULL THEN 0 WHEN city <> next_city THEN 1 ELSE 0 END AS flag
  FROM fl),
lab AS (
  SELECT *, CAST(sum(flag) OVER (PARTITION BY user_id ORDER BY message_ts DESC, event_id DESC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
            AS seq_label
  FROM runs),
stays AS (
  SELECT user_id, city, seq_label, count(DISTINCT day) AS days_of_stay, max(message_ts) AS max_ts,
         max(event_id) AS max_id
  FROM lab GROUP BY user_id, city, seq_label),
home AS (
  SELECT user_id, city AS home_city FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY max_ts DESC, max_id DESC) AS rn
    FROM stays WHERE days_of_stay > 27 AND city IS NOT NULL)
  WHERE rn = 1),
trav AS (
  SELECT user_id, count(*) AS travel_count,
         string_agg(city, '|' ORDER BY message_ts NULLS FIRST, event_id) AS travel_array
  FROM lab WHERE flag = 1 GROUP BY user_id),
lastm AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY message_ts DESC, event_id DESC)
              AS rn
    FROM msgs)
  WHERE rn = 1)"""


def _w(*ctes: str) -> str:
    return "WITH " + ",".join((BASE,) + ctes) + "\n"


# The run after the last day of the data.
_AFTER_LAST = "(SELECT max(date) + 1 FROM se)"


def _run(run_date: str) -> str:
    """A run date as SQL: a literal, or an expression as it stands."""
    return run_date if run_date.startswith("(") else f"DATE '{run_date}'"


def _new_users_cte(name: str, run_date: str, depth: int) -> str:
    first, last = f"({_run(run_date)} - {depth})", f"({_run(run_date)} - 1)"
    return f"""
{name}_first AS (
  SELECT user_id, zone_id FROM (
    SELECT message_from AS user_id, zone_id,
           row_number() OVER (PARTITION BY message_from ORDER BY message_ts NULLS FIRST, event_id) AS rn
    FROM sez
    WHERE event_type = 'message' AND message_from IS NOT NULL
      AND date BETWEEN {first} AND {last})
  WHERE rn = 1),
{name}_hist AS (
  SELECT message_from AS user_id FROM se WHERE date < {first}
  UNION SELECT message_to FROM se WHERE date < {first}
  UNION SELECT TRY_CAST("user" AS BIGINT) FROM se WHERE date < {first}),
{name} AS (
  SELECT zone_id, count(user_id) AS n FROM {name}_first f
  WHERE NOT EXISTS (SELECT 1 FROM {name}_hist h WHERE h.user_id = f.user_id)
  GROUP BY zone_id)"""


def _counts_cte(name: str, run_date: str, depth: int, prefix: str) -> str:
    first, last = f"({_run(run_date)} - {depth})", f"({_run(run_date)} - 1)"
    cols = ",\n    ".join(
        f"count(*) FILTER (WHERE event_type = '{t}') AS {prefix}_{t}"
        for t in ("message", "reaction", "subscription"))
    return f"""
{name} AS (
  SELECT zone_id,
    {cols}
  FROM sez WHERE date BETWEEN {first} AND {last}
  GROUP BY zone_id)"""


def _events_mart(run_date: str) -> str:
    return _w(_counts_cte("c7", run_date, 7, "week"), _counts_cte("c30", run_date, 30, "month"),
              _new_users_cte("n7", run_date, 7), _new_users_cte("n30", run_date, 30)) + f"""
SELECT CAST(month({_run(run_date)}) AS INTEGER) AS month,
       CAST(weekofyear({_run(run_date)}) AS INTEGER) AS week, g.zone_id,
       coalesce(c7.week_message, 0) AS week_message,
       coalesce(c7.week_reaction, 0) AS week_reaction,
       coalesce(c7.week_subscription, 0) AS week_subscription,
       coalesce(n7.n, 0) AS week_user,
       coalesce(c30.month_message, 0) AS month_message,
       coalesce(c30.month_subscription, 0) AS month_subscription,
       coalesce(c30.month_reaction, 0) AS month_reaction,
       coalesce(n30.n, 0) AS month_user
FROM geo g
LEFT JOIN c7 ON c7.zone_id = g.zone_id LEFT JOIN n7 ON n7.zone_id = g.zone_id
LEFT JOIN c30 ON c30.zone_id = g.zone_id LEFT JOIN n30 ON n30.zone_id = g.zone_id"""


PROFILE = f"""
subs AS (
  SELECT *, TRY_CAST("user" AS BIGINT) AS uid FROM sez
  WHERE event_type = 'subscription' AND "user" IS NOT NULL),
lastsub AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY message_ts DESC, event_id DESC)
              AS rn
    FROM subs)
  WHERE rn = 1),
chans AS (
  SELECT uid, list_sort(list(DISTINCT channel) FILTER (WHERE channel IS NOT NULL)) AS ch
  FROM subs GROUP BY uid),
prof AS (
  SELECT c.uid AS user_id, c.ch, l.lat, l.lon, l.zone_id AS city_id,
         {_local('l.message_ts', 'l.tz')} AS local_time
  FROM chans c JOIN lastsub l ON l.uid = c.uid
  WHERE len(c.ch) > 0),
cand AS (
  SELECT a.user_id AS user_left, b.user_id AS user_right,
         {_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS distance_km,
         len(list_intersect(a.ch, b.ch)) > 0 AS shares_channel,
         a.city_id AS zone_id, a.local_time
  FROM prof a JOIN prof b ON a.user_id <> b.user_id
  WHERE a.lat IS NOT NULL AND a.lon IS NOT NULL AND b.lat IS NOT NULL AND b.lon IS NOT NULL
    AND NOT isnan(a.lat) AND NOT isnan(a.lon) AND NOT isnan(b.lat) AND NOT isnan(b.lon)),
pairs AS (SELECT * FROM cand WHERE distance_km < 1 AND shares_channel),
contacts AS (SELECT DISTINCT message_from, message_to FROM se WHERE event_type = 'message'),
kept AS (
  SELECT p.* FROM pairs p WHERE NOT EXISTS (
    SELECT 1 FROM contacts c
    WHERE (p.user_left = c.message_from AND p.user_right = c.message_to)
       OR (p.user_left = c.message_to AND p.user_right = c.message_from)))"""

_FLAT = ("message_from, message_to, message_ts, \"user\", "
         "channel AS subscription_channel")

_USERS_MART = _w(USERS) + f"""
SELECT l.user_id, l.city AS act_city, h.home_city, t.travel_count, t.travel_array,
       {_local('l.message_ts', 'l.tz')} AS local_time
FROM lastm l LEFT JOIN home h ON h.user_id = l.user_id LEFT JOIN trav t ON t.user_id = l.user_id"""

_MATCHES_AFTER_LAST = _w(PROFILE) + f"""
SELECT user_left, user_right, CAST({_AFTER_LAST} AS VARCHAR) AS processed_dttm, zone_id, local_time FROM kept"""


def _users_by(*columns: str) -> str:
    """The users mart where these columns order messages of equal times."""
    down = ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    users = (USERS.replace("         city, tz\n", f"         city, tz, {', '.join(columns)}\n")
             .replace("event_id DESC", down).replace("NULLS FIRST, event_id)", "NULLS FIRST, "
                                                     + ", ".join(f"{c} NULLS FIRST" for c in columns) + ")")
             .replace("max_ts DESC, max_id DESC", "max_ts DESC"))
    return _USERS_MART.replace(USERS, users)


_r_first, _r_last = period(RUN_DATE, 30)
_w_first, _w_last = period(RUN_DATE, 7)
_e_first, _e_last = period(EARLY_RUN, 7)

ORACLE: dict[str, str] = {
    "geo_handbook": _w() + "SELECT * FROM geo",
    "scan_events": _w() + f"SELECT event_id, date, event_type, lat, lon, {_FLAT} FROM se",
    "scan_date_partition": _w() + f"SELECT event_id, event_type, lat, lon, {_FLAT} FROM se "
                                  f"WHERE date = DATE '{PARTITION_DAY}'",
    "scan_date_range": _w() + "SELECT event_id, date, event_type FROM se "
                              f"WHERE date BETWEEN DATE '{_e_first}' AND DATE '{_e_last}'",
    "scan_message_range": _w() + "SELECT event_id, date, message_from, message_to FROM se "
                                 f"WHERE date BETWEEN DATE '{_e_first}' AND DATE '{_e_last}' "
                                 "AND event_type = 'message'",
    "filter_event_type": _w() + "SELECT event_id, date FROM se WHERE event_type = 'message'",
    "filter_history_before": _w() + "SELECT event_id, date, event_type FROM se "
                                    f"WHERE date < DATE '{HISTORY_BEFORE}'",
    "project_nested": _w() + "SELECT event_id, message_from AS user_id, message_to, message_ts, "
                             "lat, lon FROM se WHERE event_type = 'message'",
    "cast_user_ids": _w() + "SELECT event_id, TRY_CAST(\"user\" AS BIGINT) AS user_id FROM se "
                            "WHERE event_type = 'subscription'",
    "nearest_zone": _w() + "SELECT event_id, zone_id FROM sez",
    "nearest_city": _w() + "SELECT event_id, city FROM sez",
    "haversine_km": _w() + "SELECT event_id, zone_id, "
                           f"round({_hav('lat', 'lon', 'clat', 'clon')}, 6) AS distance_km "
                           "FROM sez WHERE zone_id IS NOT NULL",
    "messages_in_cities": _w(USERS) + "SELECT user_id, event_id, message_ts, city FROM msgs",
    "latest_message_per_user": _w(USERS) + "SELECT user_id, event_id, message_ts, city FROM lastm",
    "last_city": _w(USERS) + f"SELECT user_id, city AS act_city, "
                             f"{_local('message_ts', 'tz')} AS local_time FROM lastm",
    "local_time_of_last_message": _w(USERS) + f"SELECT user_id, city AS act_city, tz, message_ts, "
                                              f"{_local('message_ts', 'tz')} AS local_time "
                                              "FROM lastm",
    "city_change_flags": _w(USERS) + "SELECT user_id, event_id, city, next_city, flag FROM runs",
    "city_run_labels": _w(USERS) + "SELECT user_id, event_id, city, flag, seq_label FROM lab",
    "city_stays": _w(USERS) + "SELECT * EXCLUDE (max_id) FROM stays",
    "long_stays": _w(USERS) + "SELECT * EXCLUDE (max_id) FROM stays WHERE days_of_stay > 27",
    "home_city": _w(USERS) + "SELECT * FROM home",
    "travel_count": _w(USERS) + "SELECT user_id, travel_count FROM trav",
    "travel_array": _w(USERS) + "SELECT user_id, travel_array FROM trav",
    "users_in_cities": _USERS_MART,
    "mart_snapshot_roundtrip": _USERS_MART,
    "users_in_cities_incremental": _USERS_MART,
    "events_by_zone_type": _w() + "SELECT zone_id, event_type, count(*) AS n FROM sez "
                                  f"WHERE date BETWEEN DATE '{_r_first}' AND DATE '{_r_last}' "
                                  "GROUP BY zone_id, event_type",
    "events_pivot_by_zone": _w() + "SELECT zone_id, "
                                   "NULLIF(count(*) FILTER (WHERE event_type = 'message'), 0) "
                                   "AS message, "
                                   "NULLIF(count(*) FILTER (WHERE event_type = 'reaction'), 0) "
                                   "AS reaction, "
                                   "NULLIF(count(*) FILTER (WHERE event_type = 'subscription'), 0) "
                                   "AS subscription FROM sez "
                                   f"WHERE date BETWEEN DATE '{_w_first}' AND DATE '{_w_last}' "
                                   "GROUP BY zone_id",
    "event_stats_7d": _w(_counts_cte("c", RUN_DATE, 7, "week")) + "SELECT * FROM c",
    "event_stats_30d": _w(_counts_cte("c", RUN_DATE, 30, "month")) + "SELECT * FROM c",
    "zone_stats_zero_filled": _w(_counts_cte("c", RUN_DATE, 7, "week")) + """
SELECT g.zone_id, coalesce(c.week_message, 0) AS week_message,
       coalesce(c.week_reaction, 0) AS week_reaction,
       coalesce(c.week_subscription, 0) AS week_subscription
FROM geo g LEFT JOIN c ON c.zone_id = g.zone_id""",
    "first_message_in_period": _w() + f"""
SELECT user_id, event_id, message_ts, zone_id FROM (
  SELECT message_from AS user_id, event_id, message_ts, zone_id,
         row_number() OVER (PARTITION BY message_from ORDER BY message_ts NULLS FIRST, event_id) AS rn
  FROM sez WHERE event_type = 'message' AND message_from IS NOT NULL
    AND date BETWEEN DATE '{_e_first}' AND DATE '{_e_last}')
WHERE rn = 1""",
    "known_users_before": _w() + f"""
SELECT user_id FROM (
  SELECT message_from AS user_id FROM se WHERE date < DATE '{HISTORY_BEFORE}'
  UNION SELECT message_to FROM se WHERE date < DATE '{HISTORY_BEFORE}'
  UNION SELECT TRY_CAST("user" AS BIGINT) FROM se WHERE date < DATE '{HISTORY_BEFORE}')
WHERE user_id IS NOT NULL""",
    "new_users_by_zone": _w(_new_users_cte("nu", MIX_RUN, MIX_DEPTH))
    + "SELECT zone_id, n AS \"user\" FROM nu",
    "run_calendar": _w() + "SELECT DISTINCT date, CAST(month(date) AS INTEGER) AS month, "
                           "CAST(weekofyear(date) AS INTEGER) AS week FROM se",
    "events_in_cities": _events_mart(RUN_DATE),
    "events_in_cities_first_week": _events_mart(EARLY_RUN),
    "contact_pairs": _w() + "SELECT DISTINCT message_from, message_to FROM se "
                            "WHERE event_type = 'message'",
    "user_channels": _w(PROFILE) + "SELECT uid AS user_id, array_to_string(ch, ',') AS channels FROM chans "
                                   "WHERE len(ch) > 0",
    "subscriber_profile": _w(PROFILE) + "SELECT user_id, array_to_string(ch, ',') AS channels, "
                                        "city_id, lat AS last_message_lat, "
                                        "lon AS last_message_lon, local_time FROM prof",
    "subscriber_profile_by_message": _w(PROFILE) + f"""
SELECT c.user_id, array_to_string(c.ch, ',') AS channels, m.zone_id AS city_id,
       m.lat AS last_message_lat, m.lon AS last_message_lon,
       {_local('m.message_ts', 'm.tz')} AS local_time
FROM (SELECT uid AS user_id, ch FROM chans WHERE len(ch) > 0) c
LEFT JOIN (
  SELECT * FROM (
    SELECT message_from, lat, lon, message_ts, zone_id, tz,
           row_number() OVER (PARTITION BY message_from ORDER BY message_ts DESC, event_id DESC)
             AS rn
    FROM sez WHERE event_type = 'message' AND message_from IS NOT NULL)
  WHERE rn = 1) m ON m.message_from = c.user_id""",
    "shared_channel_pairs": _w(PROFILE) + "SELECT user_left AS a, user_right AS b "
                                          "FROM pairs WHERE user_left < user_right",
    "nearby_user_pairs": _w(PROFILE) + "SELECT user_left, user_right, "
                                       "round(distance_km, 6) AS distance_km, zone_id, "
                                       "local_time FROM pairs",
    "pairs_without_contact": _w(PROFILE) + "SELECT user_left, user_right FROM kept",
    "users_matches": _w(PROFILE) + f"SELECT user_left, user_right, '{RUN_DATE}' AS processed_dttm, "
                                   "zone_id, local_time FROM kept",
    "stg_to_ods_missing_day": _w() + "SELECT date, event_type, count(*) AS n, TRUE AS refused FROM se "
                                     f"WHERE date = DATE '{PARTITION_DAY}' GROUP BY ALL",
    "scan_events_string_ts": _w() + "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN message_ts END "
                                    "AS message_ts, CAST(channel AS VARCHAR) AS channel FROM se",
    "geo_handbook_from_csv": _w() + "SELECT * FROM geo",
    "nearest_city_rewritten_handbook": _w() + f"""
SELECT event_id, zone_id FROM (
  SELECT e.event_id, g.zone_id, row_number() OVER (
           PARTITION BY e.event_id ORDER BY {_hav('e.lat', 'e.lon', 'g.lat', 'g.lon')}, g.zone_id) AS rn
  FROM se e LEFT JOIN (SELECT zone_id, lat, lon FROM geo UNION ALL
                       SELECT zone_id + 100, lat + 0.5, lon + 3 FROM geo) g ON e.lat IS NOT NULL)
WHERE rn = 1""",
    "users_in_cities_other_order": _users_by("lat", "lon", "message_to"),
    "users_in_cities_other_order_incremental": _users_by("lat", "lon", "message_to"),
    "scan_events_drifting": _w() + """
SELECT event_id, date, event_type, CASE WHEN day(date) % 3 <> 2 THEN lat END AS lat,
       CASE WHEN day(date) % 3 <> 2 THEN lon END AS lon, message_from, message_to,
       CASE WHEN day(date) % 3 <> 1 OR event_id % 7 <> 0 THEN message_ts END AS message_ts, "user",
       CAST(channel AS VARCHAR) AS subscription_channel FROM se""",
    "run_daily_users": _USERS_MART,
    "run_daily_events": _events_mart(_AFTER_LAST),
    "run_daily_matches": _MATCHES_AFTER_LAST,
    "users_matches_incremental": _MATCHES_AFTER_LAST,
    "near_pairs_of_changed_users": _w(PROFILE) + """
SELECT user_left AS a, user_right AS b, round(distance_km, 6) AS distance_km FROM pairs
WHERE user_left < user_right AND EXISTS (
  SELECT 1 FROM subs WHERE uid IN (user_left, user_right) AND date = (SELECT max(date) FROM subs))""",
    "event_stats_30d_rollups": _w(_counts_cte("c", RUN_DATE, 30, "month")) + "SELECT * FROM c",
    "first_message_from_rollups": _w() + f"""
SELECT user_id, event_id, message_ts, zone_id FROM (
  SELECT message_from AS user_id, event_id, message_ts, zone_id,
         row_number() OVER (PARTITION BY message_from ORDER BY message_ts NULLS FIRST, event_id) AS rn
  FROM sez WHERE event_type = 'message' AND message_from IS NOT NULL
    AND date BETWEEN DATE '{_r_first}' AND DATE '{_r_last}')
WHERE rn = 1""",
    "stg_to_ods_roundtrip": _w() + f"SELECT event_id, date, event_type, lat, lon, {_FLAT} FROM se",
}
