"""Geo, activity, path and tag marts on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.common import Tables, day, day_sql, query, stored, ts_sql
from martworks.functions import times
from martworks.functions.geo import cosine_distance
from martworks.functions.text import words
from martworks.operators.joins import as_of, within_distance, without_pairs
from martworks.operators.reference import nearest
from martworks.operators.windows import runs
from martworks.plans import activity, friends, geo, paths, tags

# Cities are the nations, at places computed from the key; events have places computed from their id.
CITY_SQL = "-43 + 1.3 * n_nationkey"
SQL_BASE = """
WITH c AS (
  SELECT n_nationkey AS id, n_name AS city, radians(-43 + CAST(1.3 AS DOUBLE) * n_nationkey) AS cla,
         radians(114 + CAST(1.6 AS DOUBLE) * ((7 * n_nationkey) % 25)) AS clo,
         CASE n_nationkey % 4 WHEN 0 THEN 600 WHEN 1 THEN 480 WHEN 2 THEN 570 END AS shift
  FROM nation),
e0 AS (
  SELECT event_id, ts, user_id, props,
         CASE WHEN event_type IN ('click', 'error') THEN 'message' WHEN event_type = 'view' THEN 'reaction'
              ELSE 'subscription' END AS event_type,
         CASE WHEN event_type IN ('click', 'error') THEN user_id + 1 + event_id % 7 END AS message_to,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS channel,
         -43 + ((37 * event_id) % 330) / CAST(10 AS DOUBLE) AS lat,
         114 + ((53 * event_id) % 400) / CAST(10 AS DOUBLE) AS lon
  FROM events),
d AS (
  SELECT e0.*, id, city, shift,
         2 * 6371 * asin(sqrt(least(1.0, pow(sin((cla - radians(lat)) / 2), 2)
             + cos(cla) * cos(radians(lat)) * pow(sin((clo - radians(lon)) / 2), 2)))) AS distance
  FROM e0, c),
l AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY distance, id) = 1)"""


def cities(t: Tables):
    key = F.col("n_nationkey")
    zone = F.element_at(F.array(F.lit("Australia/Brisbane"), F.lit("Australia/Perth"), F.lit("Australia/Darwin"),
                                F.lit(None).cast("string")), (key % 4 + 1).cast("int"))
    return t.nation.select(
        key.alias("id"), F.col("n_name").alias("city"), (F.lit(-43) + F.lit(1.3) * key).alias("lat_city"),
        (F.lit(114) + F.lit(1.6) * ((7 * key) % 25)).alias("lng_city"), zone.alias("tz"),
    )


def flat_events(t: Tables):
    kind, eid = F.col("event_type"), F.col("event_id")
    message = kind.isin("click", "error")
    return t.events.select(
        F.when(message, "message").when(kind == "view", "reaction").otherwise("subscription").alias("event_type"),
        "user_id", "event_id", F.when(message, F.col("user_id") + 1 + eid % 7).alias("message_to"),
        F.get_json_object("props", "$.k").cast("int").alias("channel"), "ts",
        (F.lit(-43) + ((37 * eid) % 330) / F.lit(10.0)).alias("lat"),
        (F.lit(114) + ((53 * eid) % 400) / F.lit(10.0)).alias("lon"),
    )


def located(t: Tables):
    return geo.locate(flat_events(t), cities(t))


def placed(t: Tables):
    """The located events as a layer of their own, for marts that use them more than once."""
    return stored(located(t), "located")


def nearest_city(t: Tables):
    return located(t).select("event_id", "id", "city", F.round("distance", 3).alias("distance"))


NEAREST_SQL = SQL_BASE + "SELECT event_id, id, city, round(distance, 3) AS distance FROM l"


def law_of_cosines(t: Tables):
    """Distance of every event to the first nation's place by the spherical law of cosines."""
    rows = flat_events(t).select("event_id", "lat", "lon")
    return rows.select("event_id", F.round(cosine_distance("lat", "lon", F.lit(-43.0), F.lit(114.0)), 3)
                       .alias("distance"), F.least(F.when(F.col("lat") < -30, 1).otherwise(0),
                                                   F.when(F.col("lon") < 130, 1).otherwise(0)).alias("flag"))


COSINES_SQL = SQL_BASE + """
SELECT event_id, round(6371 * acos(greatest(-1.0, least(1.0, sin(radians(lat)) * sin(radians(-43.0))
         + cos(radians(lat)) * cos(radians(-43.0)) * cos(radians(lon) - radians(114.0))))), 3) AS distance,
       least(CASE WHEN lat < -30 THEN 1 ELSE 0 END, CASE WHEN lon < 130 THEN 1 ELSE 0 END) AS flag
FROM e0"""


def events_near_cities(t: Tables):
    """Events at most 100 km from a city, by grid cells."""
    places = cities(t).select("id", F.col("lat_city").alias("ref_lat"), F.col("lng_city").alias("ref_lon"))
    met = within_distance(flat_events(t).select("event_id", "lat", "lon"), places, 100)
    return met.select("event_id", "id", F.round("distance", 3).alias("distance"))


NEAR_SQL = SQL_BASE + "SELECT event_id, id, round(distance, 3) AS distance FROM d WHERE distance <= 100"


def user_geo(t: Tables):
    return geo.user_geo(placed(t), min_days=1)


USER_GEO_SQL = SQL_BASE + f""",
m AS (SELECT *, lag(city) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
             lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_id FROM l),
n AS (SELECT *, sum(CASE WHEN prev_id IS NULL OR prev <> city THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM m),
s AS (SELECT user_id, run, any_value(city) AS city, max(ts) AS run_end,
             date_diff('day', date_trunc('day', min(ts)), date_trunc('day', max(ts))) AS days
      FROM n GROUP BY 1, 2),
h AS (SELECT user_id, arg_max(city, (run_end, run)) AS home_city FROM s WHERE days >= 1 GROUP BY 1),
v AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS dt, id, city FROM l),
a AS (SELECT user_id, count(*) AS travel_count, string_agg(city, ',' ORDER BY city) AS travel_array
      FROM v GROUP BY 1),
z AS (SELECT user_id, arg_max(city, (ts, event_id)) AS act_city, max(ts) AS ts,
             arg_max(coalesce(shift, -1), (ts, event_id)) AS shift FROM l GROUP BY 1)
SELECT user_id, act_city, home_city, travel_count, travel_array,
       CASE WHEN shift >= 0 THEN {ts_sql("ts + shift * INTERVAL 1 MINUTE")} END AS local_time
FROM z LEFT JOIN h USING (user_id) LEFT JOIN a USING (user_id)"""


def user_geo_moves(t: Tables):
    return geo.user_geo(placed(t), min_days=1, travel="moves").select("user_id", "part", "travel_count", "travel_array")


USER_MOVES_SQL = USER_GEO_SQL[:USER_GEO_SQL.index("h AS (")].rstrip().rstrip(",") + """
SELECT user_id, 0 AS part, count(*) AS travel_count, string_agg(city, ',' ORDER BY run) AS travel_array FROM s GROUP BY 1"""


def city_runs(t: Tables):
    """All stays of every user, with start, end, events and days."""
    return runs(placed(t), "user_id", "city", "ts", "event_id").withColumn("run_no", F.col("run_no").cast("bigint"))


CITY_RUNS_SQL = USER_GEO_SQL[:USER_GEO_SQL.index("s AS (")].rstrip().rstrip(",") + f"""
SELECT user_id, CAST(run AS BIGINT) AS run_no, any_value(city) AS city, {ts_sql('min(ts)')} AS run_start,
       {ts_sql('max(ts)')} AS run_end, count(*) AS events,
       date_diff('day', date_trunc('day', min(ts)), date_trunc('day', max(ts))) AS days
FROM n GROUP BY user_id, run"""


def zone_activity(t: Tables):
    return geo.zone_activity(placed(t))


ZONE_SQL = SQL_BASE + f""",
f AS (SELECT *, min(CASE WHEN event_type = 'message' THEN ts END) OVER (PARTITION BY user_id) AS first_ts FROM l),
x AS (SELECT {day_sql("date_trunc('month', ts)")} AS month, {day_sql("date_trunc('week', ts)")} AS week,
             id AS zone_id, event_type,
             CASE WHEN event_type = 'message' THEN CASE WHEN ts = first_ts THEN 1 ELSE 0 END END AS new FROM f),
w AS (SELECT month, week, zone_id, sum(CASE WHEN event_type = 'message' THEN 1 END) AS week_message,
             sum(CASE WHEN event_type = 'reaction' THEN 1 END) AS week_reaction,
             sum(CASE WHEN event_type = 'subscription' THEN 1 END) AS week_subscription, sum(new) AS week_user
      FROM x GROUP BY ALL),
m AS (SELECT month, zone_id, sum(CASE WHEN event_type = 'message' THEN 1 END) AS month_message,
             sum(CASE WHEN event_type = 'reaction' THEN 1 END) AS month_reaction,
             sum(CASE WHEN event_type = 'subscription' THEN 1 END) AS month_subscription, sum(new) AS month_user
      FROM x GROUP BY ALL)
SELECT month, week, zone_id, CAST(week_message AS BIGINT) AS week_message,
       CAST(week_reaction AS BIGINT) AS week_reaction, CAST(week_subscription AS BIGINT) AS week_subscription,
       CAST(week_user AS BIGINT) AS week_user, CAST(month_message AS BIGINT) AS month_message,
       CAST(month_reaction AS BIGINT) AS month_reaction, CAST(month_subscription AS BIGINT) AS month_subscription,
       CAST(month_user AS BIGINT) AS month_user
FROM w LEFT JOIN m USING (month, zone_id)"""


def friend_recs(t: Tables):
    """Recommended pairs at most 300 km apart (the places of the events lie far from each other)."""
    return friends.friend_recommendations(placed(t), now="2024-02-01 00:00:00", max_km=300)


FRIENDS_SQL = SQL_BASE + f""",
z AS (SELECT user_id, arg_max(id, (ts, event_id)) AS zone_id, arg_max(coalesce(shift, -1), (ts, event_id)) AS shift,
             arg_max(lat, (ts, event_id)) AS lat, arg_max(lon, (ts, event_id)) AS lon FROM l GROUP BY 1),
s AS (SELECT DISTINCT user_id, channel FROM l WHERE event_type = 'subscription'),
p AS (SELECT DISTINCT a.user_id AS user_left, b.user_id AS user_right
      FROM s a JOIN s b ON a.channel = b.channel AND a.user_id < b.user_id),
k AS (SELECT DISTINCT least(user_id, message_to) AS a, greatest(user_id, message_to) AS b
      FROM l WHERE event_type = 'message')
SELECT user_left, user_right, '2024-02-01 00:00:00' AS processed_dttm, y.zone_id,
       CASE WHEN y.shift >= 0 THEN {ts_sql("TIMESTAMP '2024-02-01' + y.shift * INTERVAL 1 MINUTE")} END AS local_time
FROM p JOIN z y ON y.user_id = user_left JOIN z x ON x.user_id = user_right
WHERE y.zone_id = x.zone_id AND 2 * 6371 * asin(sqrt(least(1.0, pow(sin((radians(x.lat) - radians(y.lat)) / 2), 2)
        + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin((radians(x.lon) - radians(y.lon)) / 2), 2)))) <= 300
  AND (user_left, user_right) NOT IN (SELECT (a, b) FROM k)"""


def pair_anti(t: Tables):
    """Unordered (user, channel) pairs of subscriptions that no message joined in either direction."""
    rows = flat_events(t)
    found = rows.where("event_type = 'subscription'").select(
        F.least("user_id", "channel").alias("a"), F.greatest("user_id", "channel").alias("b")).distinct()
    return without_pairs(found, rows.where("event_type = 'message'"), "a", "b", "user_id", "message_to")


PAIR_ANTI_SQL = SQL_BASE + """
SELECT DISTINCT least(user_id, channel) AS a, greatest(user_id, channel) AS b FROM e0
WHERE event_type = 'subscription' AND (least(user_id, channel), greatest(user_id, channel)) NOT IN (
  SELECT (least(user_id, message_to), greatest(user_id, message_to)) FROM e0 WHERE event_type = 'message')"""


def activity_windows(t: Tables):
    return activity.activity_windows(flat_events(t)).drop("lat", "lon", "message_to", "channel")


ACTIVITY_SQL = SQL_BASE + f""",
r AS (SELECT event_type, user_id, event_id, ts, date_trunc('month', ts) AS m, date_trunc('week', ts) AS w,
             CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS new
      FROM e0)
SELECT event_type, user_id, event_id, {ts_sql('ts')} AS ts, {day_sql('m')} AS month, {day_sql('w')} AS week,
       count(*) FILTER (event_type = 'message') OVER (PARTITION BY w) AS week_message,
       count(*) FILTER (event_type = 'reaction') OVER (PARTITION BY w) AS week_reaction,
       count(*) FILTER (event_type = 'subscription') OVER (PARTITION BY w) AS week_subscription,
       CAST(sum(new) OVER (PARTITION BY w) AS BIGINT) AS week_user,
       count(*) FILTER (event_type = 'message') OVER (PARTITION BY m) AS month_message,
       count(*) FILTER (event_type = 'reaction') OVER (PARTITION BY m) AS month_reaction,
       count(*) FILTER (event_type = 'subscription') OVER (PARTITION BY m) AS month_subscription,
       CAST(sum(new) OVER (PARTITION BY m) AS BIGINT) AS month_user
FROM r"""


def nearby_contacts(t: Tables):
    """Last five messages of every user to people last seen within 1,000 km."""
    rows = placed(t).where("event_type = 'message'").select(
        "event_id", "user_id", "message_to", "ts", "lat", "lon", "city", "tz")
    return activity.nearby_contacts(rows, max_km=1000).withColumn("distance", F.round("distance", 3))


NEARBY_SQL = SQL_BASE + f""",
m AS (SELECT *, count(*) OVER (PARTITION BY user_id, date_trunc('week', ts), message_to) AS cnt
      FROM l WHERE event_type = 'message'),
r AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5),
j AS (SELECT r.*, p.lat AS la, p.lon AS lo FROM r ASOF JOIN m p ON p.user_id = r.message_to AND r.ts >= p.ts),
k AS (SELECT *, 6371 * acos(greatest(-1.0, least(1.0, sin(radians(lat)) * sin(radians(la))
        + cos(radians(lat)) * cos(radians(la)) * cos(radians(lon) - radians(lo))))) AS dist FROM j)
SELECT event_id, user_id, message_to,
       string_agg(CAST(message_to AS VARCHAR), ',' ORDER BY message_to) OVER (PARTITION BY user_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS friends,
       cnt, round(dist, 3) AS distance, {day_sql("date_trunc('week', ts)")} AS week, city, {ts_sql('ts')} AS time_utc,
       CASE WHEN shift IS NOT NULL THEN {ts_sql("ts + shift * INTERVAL 1 MINUTE")} END AS local_time
FROM k WHERE dist <= 1000"""


def as_of_value(t: Tables):
    """Every purchase with the value of the user's last click up to that moment."""
    events = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    return as_of(bought, events.where("event_type = 'click'"), "user_id", "ts", ["value"], tiebreak="event_id")


AS_OF_SQL = f"""
SELECT p.event_id, p.user_id, {ts_sql('p.ts')} AS ts, p.value, c.value AS last_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON c.user_id = p.user_id AND p.ts >= c.ts"""


def _path_events(t: Tables):
    return t.events.select(F.col("user_id").alias("user_custom_id"), F.col("ts").alias("event_timestamp"),
                           F.col("event_type").alias("page_url_path"), "event_id")


def path_funnel(t: Tables):
    """view, then at once click, purchase and signup; paths of the first ten days are loaded already."""
    events, steps = _path_events(t), ("click", "purchase", "signup")
    start = F.col("page_url_path") == "view"
    everything = paths.purchase_paths(events, None, tiebreak="event_id", first=start, then=steps)
    loaded = everything.where(F.col("event_timestamp") < day("2024-01-11"))
    return paths.purchase_paths(events, loaded, tiebreak="event_id", first=start, then=steps)


FUNNEL_SQL = f"""
WITH x AS (
  SELECT user_id, ts, event_type, lead(event_type) OVER w AS n1, lead(event_type, 2) OVER w AS n2,
         lead(event_type, 3) OVER w AS n3
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id AS user_custom_id, {ts_sql('ts')} AS event_timestamp, event_type AS page_url_path FROM x
WHERE event_type = 'view' AND n1 = 'click' AND n2 = 'purchase' AND n3 = 'signup' AND ts >= TIMESTAMP '2024-01-11'"""


def event_hours(t: Tables):
    return paths.event_hours(t.events.withColumnRenamed("ts", "event_timestamp"))


EVENT_HOURS_SQL = f"SELECT event_type, {ts_sql('ts')} AS event_timestamp, hour(ts)::INTEGER AS hour FROM events"


def confirmed_payments(t: Tables):
    return paths.confirmed_payments(t.events, "event_type", "purchase").select("event_id", "user_id", "value")


CONFIRMED_SQL = "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'"


def tag_candidates(t: Tables):
    """Words used by at least 15 document sources that are not words of the benchmark items."""
    verified = t.benchmark.select(F.explode(words("text")).alias("tag")).distinct()
    return tags.tag_candidates(t.documents, verified, "source", words("text"), least=15)


TAGS_SQL = r"""
WITH w AS (SELECT DISTINCT source, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS tag FROM documents)
SELECT tag, count(*) AS suggested_count FROM w
WHERE tag <> '' AND tag NOT IN (
  SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) FROM benchmark)
GROUP BY tag HAVING count(*) >= 15"""


def keyword_counts(t: Tables):
    """Turns naming 'the' per conversation, kept for every order key that has no such conversation as null."""
    users = t.customer.select(F.col("c_custkey").alias("conv_id"))
    return tags.keyword_counts(users, t.conversations, "conv_id", F.col("text").like("%the%"), "cnt")


KEYWORD_SQL = """
SELECT c_custkey AS conv_id, cnt FROM customer LEFT JOIN (
  SELECT conv_id, count(*) FILTER (text LIKE '%the%') AS cnt FROM conversations GROUP BY 1) ON conv_id = c_custkey"""


def nearest_chunked(t: Tables):
    """The same nearest cities with small cubes, so that most hold no city."""
    points = flat_events(t).select("event_id", "lat", "lon")
    found = nearest(points, cities(t))
    return found.select("event_id", "id", "city", F.round("distance", 3).alias("distance"))


def local_time(t: Tables):
    return located(t).select("event_id", times.local_time("ts", "tz").alias("local_time"))


LOCAL_SQL = SQL_BASE + f"""
SELECT event_id, CASE WHEN shift IS NOT NULL THEN {ts_sql("ts + shift * INTERVAL 1 MINUTE")} END AS local_time
FROM l"""


QUERIES = {
    "nearest_city": (nearest_city, NEAREST_SQL),
    "nearest_chunked": (nearest_chunked, NEAREST_SQL),
    "law_of_cosines": (law_of_cosines, COSINES_SQL),
    "events_near_cities": (events_near_cities, NEAR_SQL),
    "user_geo": (user_geo, USER_GEO_SQL),
    "user_geo_moves": (user_geo_moves, USER_MOVES_SQL),
    "city_runs": (city_runs, CITY_RUNS_SQL),
    "zone_activity": (zone_activity, ZONE_SQL),
    "friend_recs": (friend_recs, FRIENDS_SQL),
    "pair_anti": (pair_anti, PAIR_ANTI_SQL),
    "activity_windows": (activity_windows, ACTIVITY_SQL),
    "nearby_contacts": (nearby_contacts, NEARBY_SQL),
    "as_of": (as_of_value, AS_OF_SQL),
    "local_time": (local_time, LOCAL_SQL),
    "path_funnel": (path_funnel, FUNNEL_SQL),
    "event_hours": (event_hours, EVENT_HOURS_SQL),
    "confirmed_payments": (confirmed_payments, CONFIRMED_SQL),
    "tag_candidates": (tag_candidates, TAGS_SQL),
    "keyword_counts": (keyword_counts, KEYWORD_SQL),
}
QUERIES = {name: (query(fn), sql) for name, (fn, sql) in QUERIES.items()}
