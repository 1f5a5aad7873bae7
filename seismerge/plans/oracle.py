"""DuckDB statements of the registered queries (the correctness oracle).

They are written independently of the Spark code: the agency feeds come
straight from ``events`` with the fixture rule (no JSON round trip), time
sessions use a global ``lag`` instead of buckets, and the clustering walk is
a recursive CTE that carries each session's cluster list
(struct(tm, slat, slon, n, smag, nm)[]) one report per step.
"""

from __future__ import annotations

W_US = 90_000_000

REPORTS = """
ev AS (SELECT event_id AS eid, ts, user_id, event_type, value, unnest([0, 1, 2, 3]) AS k FROM events),
ev2 AS (
  SELECT *,
    ts + to_seconds(k * 4 + CASE WHEN eid % 23 = 0 AND k = 1 THEN 95 ELSE 0 END) AS t0
  FROM ev WHERE (k + eid) % 4 <= (eid // 4) % 4
),
ev3 AS (
  SELECT *,
    CASE WHEN k = 0 THEN t0 WHEN k = 1 THEN date_trunc('second', t0)
         ELSE date_trunc('millisecond', t0) END AS t,
    (3550 + (user_id * 37 + eid * 11) % 700 + k
       + CASE WHEN eid % 17 = 0 AND k = 3 THEN 100 ELSE 0 END) / 100e0 AS lat,
    (2550 + (user_id * 53 + eid * 29) % 1950 + k) / 100e0 AS lon,
    CASE WHEN eid % 41 = 0 THEN NULL
         ELSE (10 + eid % 50 + k + CASE WHEN eid % 19 = 0 AND k = 2 THEN 20 ELSE 0 END) / 10e0
    END AS mag
  FROM ev2
),
reports AS (
  SELECT
    ['AFAD', 'KOERI', 'EMSC', 'USGS'][k + 1] AS source,
    CASE k WHEN 0 THEN CAST(eid AS VARCHAR)
           WHEN 1 THEN 'KOERI-' || strftime(t + INTERVAL 3 HOUR, '%Y-%m-%d') || 'T'
                       || strftime(t + INTERVAL 3 HOUR, '%H:%M:%S') || '-'
                       || printf('%.3f', lat) || '-' || printf('%.3f', lon)
           WHEN 2 THEN 'emsc-' || CAST(eid AS VARCHAR)
           ELSE 'us' || lpad(CAST(eid AS VARCHAR), 8, '0') END AS event_id,
    t AS event_time, lat AS latitude, lon AS longitude,
    CASE WHEN k = 1 THEN CAST(printf('%.1f', value) AS DOUBLE) ELSE value END AS depth_km,
    mag AS magnitude,
    CASE k WHEN 0 THEN 'ML'
           WHEN 1 THEN CASE WHEN mag IS NULL THEN NULL WHEN eid % 3 = 0 THEN 'MW'
                            WHEN eid % 3 = 1 THEN 'ML' ELSE 'MD' END
           WHEN 2 THEN CASE WHEN eid % 2 = 0 THEN 'mb' ELSE 'ML' END
           ELSE CASE WHEN eid % 2 = 0 THEN 'mww' ELSE 'mb' END END AS mag_type,
    CASE WHEN k = 1 AND eid % 4 = 2
         THEN rpad('zone ' || CAST(user_id AS VARCHAR), 40, ' ') || ' İlksel'
         ELSE 'zone ' || CAST(user_id AS VARCHAR) END AS place,
    CASE WHEN k = 0 THEN event_type END AS province,
    CASE WHEN k = 0 THEN 'district ' || CAST(user_id % 7 AS VARCHAR) END AS district,
    k, eid,
    max(t) OVER (PARTITION BY k, eid // 256) AS blob_max_t,
    CAST(eid // 256 AS VARCHAR) AS blob,
    epoch_us(t) AS us,
    k AS prio
  FROM ev3
),
raw_meta AS (
  SELECT *,
    date_trunc('minute', blob_max_t) + INTERVAL 2 MINUTE AS received_at,
    's3a://archive/' || source || '/'
      || strftime(date_trunc('minute', blob_max_t) + INTERVAL 2 MINUTE, '%Y-%m-%d') || '/'
      || strftime(date_trunc('minute', blob_max_t) + INTERVAL 2 MINUTE, '%H%M%S') || '-'
      || substr(sha1(source || '|' || blob), 1, 8)
      || CASE WHEN source = 'KOERI' THEN '.html' ELSE '.json' END AS archive_uri
  FROM reports
)"""

SESSIONS = f"""
s1 AS (
  SELECT *, CASE WHEN lag(us) OVER o IS NULL OR us - lag(us) OVER o > {W_US} THEN 1 ELSE 0 END AS st
  FROM reports WINDOW o AS (ORDER BY us, prio, source, event_id)
),
s2 AS (SELECT *, sum(st) OVER (ORDER BY us, prio, source, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM s1),
s3 AS (SELECT *, row_number() OVER (PARTITION BY sess ORDER BY us, prio, source, event_id) AS ord FROM s2)"""


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))")


def clusters_cte(mode: str = "creation_break") -> str:
    """Recursive statement of the greedy walk; emits (sess, ord, cidx)."""
    brk = (f"coalesce(list_max(list_transform(cl, lambda x, j: CASE WHEN us - x.tm > {W_US} "
           f"THEN j ELSE 0 END)), 0)") if mode == "creation_break" else "0"
    dist = _hav("lat", "lon", "x.slat / x.n", "x.slon / x.n")
    cand = (f"list_filter(list_transform(cl, lambda x, j: {{'dt': us - x.tm, 'nj': -j, 'j': j, "
            f"'ok': j > br AND us - x.tm <= {W_US} AND {dist} <= 50.0 AND "
            f"(mag IS NULL OR x.nm = 0 OR abs(mag - x.smag / x.nm) <= 1.0)}}), lambda c: c.ok)")
    return f"""
rec(sess, i, cl, cidx) AS (
  SELECT sess, 0::BIGINT,
         CAST([] AS STRUCT(tm BIGINT, slat DOUBLE, slon DOUBLE, n BIGINT, smag DOUBLE, nm BIGINT)[]),
         NULL::BIGINT
  FROM (SELECT DISTINCT sess FROM s3)
  UNION ALL
  SELECT sess, i,
    CASE WHEN best IS NULL THEN list_append(cl, {{'tm': us, 'slat': lat, 'slon': lon, 'n': 1,
              'smag': coalesce(mag, 0.0), 'nm': CASE WHEN mag IS NULL THEN 0 ELSE 1 END}})
         ELSE list_transform(cl, lambda x, j: CASE WHEN j = best THEN
              {{'tm': greatest(x.tm, us), 'slat': x.slat + lat, 'slon': x.slon + lon, 'n': x.n + 1,
                'smag': x.smag + coalesce(mag, 0.0), 'nm': x.nm + CASE WHEN mag IS NULL THEN 0 ELSE 1 END}}
              ELSE x END) END,
    coalesce(best, len(cl) + 1)
  FROM (
    SELECT *, (list_sort({cand}))[1].j AS best
    FROM (
      SELECT rec.sess, rec.i + 1 AS i, rec.cl, s3.us, s3.latitude AS lat, s3.longitude AS lon,
             s3.magnitude AS mag,
             {brk.replace('cl,', 'rec.cl,').replace('us -', 's3.us -')} AS br
      FROM rec JOIN s3 ON s3.sess = rec.sess AND s3.ord = rec.i + 1
    )
  )
),
assigned AS (
  SELECT s3.*, rec.cidx FROM s3 JOIN rec ON rec.sess = s3.sess AND rec.i = s3.ord
),
members AS (
  SELECT *, first(source || ':' || event_id ORDER BY ord) OVER (PARTITION BY sess, cidx) AS cluster_head,
         count(*) OVER (PARTITION BY sess, cidx) AS cluster_size
  FROM assigned
)"""


def open_clusters_cte(mode: str = "creation_break") -> str:
    """The same walk for long sessions: the list holds only clusters that a
    later report can still reach, and each knows its number."""
    live = (f"list_filter(cl, lambda x: us - x.tm <= {W_US})" if mode == "window" else
            f"cl[coalesce(list_max(list_transform(cl, lambda x, j: CASE WHEN us - x.tm > {W_US} THEN j ELSE 0 END)), 0) + 1:]")
    dist = _hav("lat", "lon", "x.slat / x.n", "x.slon / x.n")
    cand = (f"list_filter(list_transform(live, lambda x, j: {{'dt': us - x.tm, 'nj': -j, 'j': j, 'ok': {dist} <= 50.0 AND "
            f"(mag IS NULL OR x.nm = 0 OR abs(mag - x.smag / x.nm) <= 1.0)}}), lambda c: c.ok)")
    return f"""
rec(sess, i, cl, made, cidx) AS (
  SELECT sess, 0::BIGINT,
         CAST([] AS STRUCT(id BIGINT, tm BIGINT, slat DOUBLE, slon DOUBLE, n BIGINT, smag DOUBLE, nm BIGINT)[]), 0::BIGINT, NULL::BIGINT
  FROM (SELECT DISTINCT sess FROM s3)
  UNION ALL
  SELECT sess, i,
    CASE WHEN best IS NULL THEN list_append(live, {{'id': made + 1, 'tm': us, 'slat': lat, 'slon': lon, 'n': 1,
              'smag': coalesce(mag, 0.0), 'nm': CASE WHEN mag IS NULL THEN 0 ELSE 1 END}})
         ELSE list_transform(live, lambda x, j: CASE WHEN j = best THEN
              {{'id': x.id, 'tm': greatest(x.tm, us), 'slat': x.slat + lat, 'slon': x.slon + lon, 'n': x.n + 1,
                'smag': x.smag + coalesce(mag, 0.0), 'nm': x.nm + CASE WHEN mag IS NULL THEN 0 ELSE 1 END}}
              ELSE x END) END,
    CASE WHEN best IS NULL THEN made + 1 ELSE made END,
    CASE WHEN best IS NULL THEN made + 1 ELSE live[best].id END
  FROM (SELECT *, (list_sort({cand}))[1].j AS best
    FROM (SELECT *, {live} AS live
      FROM (SELECT rec.sess, rec.i + 1 AS i, rec.cl, rec.made, s3.us, s3.latitude AS lat, s3.longitude AS lon, s3.magnitude AS mag
            FROM rec JOIN s3 ON s3.sess = rec.sess AND s3.ord = rec.i + 1)))
),
assigned AS (SELECT s3.*, rec.cidx FROM s3 JOIN rec ON rec.sess = s3.sess AND rec.i = s3.ord),
members AS (
  SELECT *, first(source || ':' || event_id ORDER BY ord) OVER (PARTITION BY sess, cidx) AS cluster_head,
         count(*) OVER (PARTITION BY sess, cidx) AS cluster_size
  FROM assigned
)"""


def iso_utc(col: str) -> str:
    return (f"(strftime({col}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({col}) % 1000000 <> 0 "
            f"THEN '.' || lpad(CAST(epoch_us({col}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END "
            f"|| '+00:00')")


FACTS = f"""
percl AS (
  SELECT sess, cidx,
    min(event_time) AS t_min,
    first(source ORDER BY prio, us, ord) AS p_source,
    first(latitude ORDER BY prio, us, ord) AS p_lat,
    first(longitude ORDER BY prio, us, ord) AS p_lon,
    first(depth_km ORDER BY prio, us, ord) AS p_depth,
    first(magnitude ORDER BY prio, us, ord) AS p_mag,
    first(mag_type ORDER BY prio, us, ord) AS p_mag_type,
    first(place ORDER BY prio, us, ord) AS p_place,
    first(province ORDER BY prio, us, ord) AS p_province,
    first(district ORDER BY prio, us, ord) AS p_district,
    list_sort(list_distinct(list(source))) AS srcs
  FROM members GROUP BY sess, cidx
),
facts_all AS (
  SELECT *,
    substr(sha1(CAST((epoch_us(t_min) - ((epoch_us(t_min) % {W_US} + {W_US}) % {W_US})) // {W_US} * 90 AS VARCHAR)
           || '|' || printf('%.2f', p_lat) || '|' || printf('%.2f', p_lon)), 1, 24) AS event_uid
  FROM percl
),
facts AS (
  SELECT * FROM facts_all
  QUALIFY row_number() OVER (PARTITION BY event_uid ORDER BY sess DESC, cidx DESC) = 1
)"""


def with_ctes(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(p.strip("\n") for p in parts) + "\n"


def fact_base(mode: str = "creation_break") -> str:
    return with_ctes(REPORTS, SESSIONS, clusters_cte(mode), FACTS)
