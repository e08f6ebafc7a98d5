"""Independent SQL (DuckDB dialect) for every query of the catalogue.

The SQL is written from the query definitions, not generated from the Spark
plans: the event-shape mapping is restated as a CTE over the raw tables, and
aggregates follow the original two-level form where the Spark plan takes a
shortcut (e.g. effectiveness sums per-customer counts).
"""

from __future__ import annotations

from ..sources.fixture import USER_AGENTS


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def rate(num: str, den: str) -> str:
    """Exact half-even percentage with 2 decimals; 0.0 for a zero or missing divisor."""
    n = f"(CAST(COALESCE({num}, 0) AS BIGINT) * 10000)"
    d = f"CAST(COALESCE({den}, 0) AS BIGINT)"
    q = f"({n} // NULLIF({d}, 0))"
    r = f"({n} - {q} * {d})"
    return (f"(CASE WHEN {d} = 0 THEN 0.0::DOUBLE ELSE CAST({q} + CASE WHEN 2 * {r} > {d} "
            f"OR (2 * {r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 100.0::DOUBLE END)")


def rate_nullable(num: str, den: str) -> str:
    """As ``rate`` but null when either side is null (pandas NaN)."""
    return f"(CASE WHEN {num} IS NULL OR {den} IS NULL THEN NULL ELSE {rate(num, den)} END)"


EV = f"""ev AS (
  SELECT e.event_id,
         e.user_id AS customer_id,
         'cmp-' || CAST(CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 20 AS VARCHAR) AS campaign_id,
         CASE e.event_type WHEN 'signup' THEN 'SENT' WHEN 'purchase' THEN 'DELIVERED'
              WHEN 'view' THEN 'OPENED' WHEN 'click' THEN 'CLICKED' ELSE 'SPAM' END AS type_event,
         e.ts AS event_date,
         CAST(NULL AS VARCHAR) AS gender,
         CAST(NULL AS VARCHAR) AS email,
         {_list(USER_AGENTS)}[e.event_id % 5 + 1] AS user_agent,
         r.r_name AS country, n.n_name AS city, c.c_mktsegment AS state,
         CASE WHEN e.event_type = 'click' THEN CAST(e.event_id % 50 AS INTEGER) END AS product_id
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CAMPAIGN = """campaign_dim AS (
  SELECT 'cmp-' || CAST(s_suppkey AS VARCHAR) AS uuid_campaign, s_name AS name FROM supplier)"""

PRODUCT = """product_dim AS (
  SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title, p_type AS category,
         CAST(NULL AS VARCHAR) AS image, CAST(p_retailprice AS FLOAT) AS price FROM part)"""

EVENT_COLS = ("customer_id, campaign_id, type_event, event_date, gender, email, user_agent, "
              "country, city, state, product_id")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CITY = _with(EV) + """SELECT campaign_id, city, COUNT(*) AS "count" FROM ev GROUP BY campaign_id, city"""

TYPES = _with(EV) + """SELECT campaign_id,
  CAST(SUM(CASE WHEN type_event IN ('DELIVERED', 'DELIVERED_EVENT') THEN 1 ELSE 0 END) AS BIGINT) AS DELIVERED,
  CAST(SUM(CASE WHEN type_event = 'CLICKED' THEN 1 ELSE 0 END) AS BIGINT) AS CLICKED,
  CAST(SUM(CASE WHEN type_event = 'SPAM' THEN 1 ELSE 0 END) AS BIGINT) AS SPAM,
  CAST(SUM(CASE WHEN type_event = 'OPENED' THEN 1 ELSE 0 END) AS BIGINT) AS OPENED,
  CAST(SUM(CASE WHEN type_event = 'SENT' THEN 1 ELSE 0 END) AS BIGINT) AS SENT
FROM ev GROUP BY campaign_id"""

ENGAGEMENT = _with(EV) + """SELECT campaign_id, customer_id, type_event, COUNT(type_event) AS total_events
FROM ev WHERE type_event IN ('CLICKED', 'OPENED') GROUP BY campaign_id, customer_id, type_event"""

_EFFECT_CTES = (EV, CAMPAIGN, """eng AS (
  SELECT campaign_id, customer_id, type_event, COUNT(type_event) AS total_events
  FROM ev WHERE type_event IN ('CLICKED', 'OPENED') GROUP BY 1, 2, 3)""", """per AS (
  SELECT campaign_id,
         CAST(SUM(CASE WHEN type_event = 'CLICKED' THEN total_events END) AS BIGINT) AS CLICKED,
         CAST(SUM(CASE WHEN type_event = 'OPENED' THEN total_events END) AS BIGINT) AS OPENED
  FROM eng GROUP BY campaign_id)""", f"""eff AS (
  SELECT *, {rate_nullable('CLICKED', 'OPENED')} AS effectiveness FROM per)""", """top AS (
  SELECT * FROM eff ORDER BY CLICKED DESC NULLS LAST, OPENED DESC NULLS LAST,
                             effectiveness DESC NULLS LAST, campaign_id LIMIT 10)""", """res AS (
  SELECT t.campaign_id, c.name, CAST(COALESCE(t.CLICKED, 0) AS BIGINT) AS CLICKED,
         CAST(COALESCE(t.OPENED, 0) AS BIGINT) AS OPENED,
         COALESCE(t.effectiveness, 0.0::DOUBLE) AS effectiveness
  FROM top t JOIN campaign_dim c ON c.uuid_campaign = t.campaign_id)""")

EFFECTIVENESS = _with(*_EFFECT_CTES) + "SELECT * FROM res"

CLICK_SHARE = _with(*_EFFECT_CTES) + """SELECT campaign_id, name, CLICKED,
  CASE WHEN SUM(CLICKED) OVER () = 0 THEN NULL
       ELSE CAST(CLICKED AS DOUBLE) / CAST(SUM(CLICKED) OVER () AS DOUBLE) END AS click_share
FROM res"""

CITY_TOP = _with(EV) + """SELECT city, COUNT(*) AS total_events FROM ev WHERE city IS NOT NULL
GROUP BY city ORDER BY total_events DESC, city LIMIT 10"""

_POP = """pop AS (
  WITH pc AS (SELECT product_id, COUNT(product_id) AS count_product FROM ev
              WHERE product_id IS NOT NULL GROUP BY product_id
              ORDER BY count_product DESC, product_id LIMIT 10)
  SELECT pc.product_id, p.title, p.category, p.image, pc.count_product,
         CAST(DENSE_RANK() OVER (ORDER BY pc.count_product DESC) AS INTEGER) AS rank
  FROM pc JOIN product_dim p ON pc.product_id = p.id)"""

POPULARITY = _with(EV, PRODUCT, _POP) + "SELECT * FROM pop"

BEST = _with(EV, PRODUCT, _POP) + "SELECT * FROM pop WHERE rank = 1 ORDER BY product_id LIMIT 1"

NAMES = _with(EV, CAMPAIGN) + """SELECT uuid_campaign, name FROM campaign_dim
WHERE uuid_campaign IN (SELECT campaign_id FROM ev)"""

ROUNDTRIP = _with(EV) + f"SELECT {EVENT_COLS} FROM ev"

# The damaged feed as messages: JSON text of the event's fields, nulls left out.
MESSAGES = """damaged AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 97 = 2 THEN rpad(COALESCE(city, ''), 31, '#') ELSE city END AS city,
    CASE WHEN event_id % 97 = 3 THEN NULL ELSE campaign_id END AS campaign_id,
    CASE WHEN event_id % 97 = 4 THEN CAST(event_id % 50 AS INTEGER) ELSE product_id END AS product_id)
  FROM ev),
messages AS (
  SELECT event_id, type_event, CAST(customer_id AS VARCHAR) AS key,
    CASE WHEN event_id % 97 = 0 THEN 'not json ' || CAST(customer_id AS VARCHAR) ELSE
      '{' || array_to_string(list_filter([
        '"customer_id":' || CAST(customer_id AS VARCHAR),
        '"campaign_id":"' || campaign_id || '"',
        '"type_event":"' || type_event || '"',
        '"event_date":"' || CASE WHEN event_id % 97 = 1 THEN 'bad'
                                 ELSE strftime(event_date, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END || '"',
        '"user_agent":"' || user_agent || '"',
        '"country":"' || country || '"',
        '"city":"' || city || '"',
        '"state":"' || state || '"',
        '"product_id":' || CAST(product_id AS VARCHAR)], lambda x: x IS NOT NULL), ',') || '}' END AS "value"
  FROM damaged)"""

QUARANTINE = _with(EV, MESSAGES) + """SELECT key, "value",
  CASE event_id % 97 WHEN 0 THEN 'customer_id,campaign_id,type_event,event_date'
       WHEN 1 THEN 'event_date' WHEN 2 THEN 'city' WHEN 3 THEN 'campaign_id' ELSE 'product_id' END AS reason
FROM messages WHERE event_id % 97 IN (0, 1, 2, 3) OR (event_id % 97 = 4 AND type_event <> 'CLICKED')"""

ROUTE = _with(EV, MESSAGES) + """SELECT
  CASE WHEN event_id % 97 IN (0, 1, 2, 3) OR (event_id % 97 = 4 AND type_event <> 'CLICKED') THEN 'quarantine'
       WHEN type_event IN ('OPENED', 'CLICKED', 'FORWARDED') THEN 'engagement'
       WHEN type_event IN ('SENT', 'DELIVERED', 'DELIVERED_EVENT') THEN 'delivery'
       WHEN type_event IN ('SPAM', 'HARD_BOUNCE') THEN 'error' ELSE 'unknown' END AS topic,
  key, "value",
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE type_event END AS type_event
FROM messages"""

ENRICHED = _with(EV, PRODUCT, CAMPAIGN) + f"""SELECT {', '.join('e.' + c for c in EVENT_COLS.split(', '))},
  p.title AS product_title, p.category AS product_category, p.price AS product_price,
  c.name AS campaign_name
FROM ev e LEFT JOIN product_dim p ON e.product_id = p.id
LEFT JOIN campaign_dim c ON e.campaign_id = c.uuid_campaign"""

TUMBLING = _with(EV) + """SELECT campaign_id, type_event,
  time_bucket(INTERVAL 1 DAY, event_date) AS window_start,
  time_bucket(INTERVAL 1 DAY, event_date) + INTERVAL 1 DAY AS window_end,
  COUNT(*) AS events
FROM ev WHERE event_date IS NOT NULL GROUP BY ALL"""

SLIDING = _with(EV) + """, w AS (
  SELECT campaign_id, type_event, time_bucket(INTERVAL 12 HOUR, event_date) AS window_start
  FROM ev WHERE event_date IS NOT NULL
  UNION ALL
  SELECT campaign_id, type_event, time_bucket(INTERVAL 12 HOUR, event_date) - INTERVAL 12 HOUR
  FROM ev WHERE event_date IS NOT NULL)
SELECT campaign_id, type_event, window_start, window_start + INTERVAL 1 DAY AS window_end,
       COUNT(*) AS events
FROM w GROUP BY ALL"""

SESSIONS = _with(EV) + """, l AS (
  SELECT customer_id, event_date,
         LAG(event_date) OVER (PARTITION BY customer_id ORDER BY event_date) AS prev
  FROM ev WHERE event_date IS NOT NULL),
m AS (
  SELECT *, SUM(CASE WHEN prev IS NULL OR event_date > prev + INTERVAL 12 HOUR THEN 1 ELSE 0 END)
            OVER (PARTITION BY customer_id ORDER BY event_date
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM l)
SELECT customer_id, MIN(event_date) AS session_start,
       MAX(event_date) + INTERVAL 12 HOUR AS session_end, COUNT(*) AS events
FROM m GROUP BY customer_id, sid"""

USER_CTR = _with(EV) + """, per AS (
  SELECT campaign_id,
         CAST(COUNT(DISTINCT CASE WHEN type_event = 'CLICKED' THEN customer_id END) AS BIGINT) AS clickers,
         CAST(COUNT(DISTINCT CASE WHEN type_event = 'OPENED' THEN customer_id END) AS BIGINT) AS openers
  FROM ev GROUP BY campaign_id)
SELECT campaign_id, clickers, openers, """ + rate("clickers", "openers") + " AS ctr FROM per"

REACH = USER_CTR.replace("SELECT campaign_id, clickers", """, every AS (SELECT * FROM per UNION ALL
  SELECT CAST(NULL AS VARCHAR), CAST(COUNT(DISTINCT CASE WHEN type_event = 'CLICKED' THEN customer_id END) AS BIGINT),
         CAST(COUNT(DISTINCT CASE WHEN type_event = 'OPENED' THEN customer_id END) AS BIGINT) FROM ev HAVING COUNT(*) > 0)
SELECT campaign_id, clickers""").split("clickers, openers, ")[0] + """clickers, openers, TRUE AS clickers_within,
  TRUE AS openers_within FROM every"""

# The delayed events meet the watermark of all others: their newest time less one minute.
LATE = _with(EV) + """, w AS (
  SELECT campaign_id, type_event, time_bucket(INTERVAL 1 DAY, event_date) AS window_start,
         time_bucket(INTERVAL 1 DAY, event_date) + INTERVAL 1 DAY AS window_end,
         customer_id % 7 = 0 AND time_bucket(INTERVAL 1 DAY, event_date) + INTERVAL 1 DAY <=
           (SELECT MAX(event_date) FROM ev WHERE customer_id % 7 <> 0) - INTERVAL 1 MINUTE AS behind
  FROM ev WHERE event_date IS NOT NULL)
SELECT campaign_id, type_event, window_start, window_end,
       CAST(SUM(CASE WHEN behind THEN 0 ELSE 1 END) AS BIGINT) AS events,
       CAST(SUM(CASE WHEN behind THEN 1 ELSE 0 END) AS BIGINT) AS late
FROM w GROUP BY ALL"""

_STAGES = ("sent", "delivered", "opened", "clicked", "forwarded")
FUNNEL = _with(EV) + """, f AS (
  SELECT campaign_id, customer_id,
         MAX(CASE WHEN type_event = 'SENT' THEN 1
                  WHEN type_event IN ('DELIVERED', 'DELIVERED_EVENT') THEN 2
                  WHEN type_event = 'OPENED' THEN 3 WHEN type_event = 'CLICKED' THEN 4
                  WHEN type_event = 'FORWARDED' THEN 5 END) AS furthest
  FROM ev GROUP BY campaign_id, customer_id),
p AS (SELECT campaign_id, """ + ", ".join(
    f"CAST(SUM(CASE WHEN furthest >= {i} THEN 1 ELSE 0 END) AS BIGINT) AS {s}"
    for i, s in enumerate(_STAGES, start=1)) + """ FROM f GROUP BY campaign_id)
SELECT campaign_id, """ + ", ".join(_STAGES) + ", " + ", ".join(
    f"{rate(_STAGES[i + 1], _STAGES[i])} AS {_STAGES[i + 1]}_rate" for i in range(4)) + " FROM p"

DELIVERABILITY = _with(EV) + """, p AS (
  SELECT campaign_id, COUNT(*) AS events,
         CAST(SUM(CASE WHEN type_event = 'SPAM' THEN 1 ELSE 0 END) AS BIGINT) AS spam,
         CAST(SUM(CASE WHEN type_event = 'HARD_BOUNCE' THEN 1 ELSE 0 END) AS BIGINT) AS hard_bounce
  FROM ev GROUP BY campaign_id)
SELECT campaign_id, events, spam, hard_bounce, """ + rate("spam", "events") + " AS spam_rate, " + \
    rate("hard_bounce", "events") + " AS bounce_rate FROM p"

REPEAT = _with(EV) + """, eng AS (
  SELECT campaign_id, customer_id, type_event, COUNT(type_event) AS total_events
  FROM ev WHERE type_event IN ('CLICKED', 'OPENED') GROUP BY 1, 2, 3)
SELECT type_event, total_events, COUNT(*) AS pairs FROM eng GROUP BY type_event, total_events"""

CLIENT_MIX = _with(EV) + """SELECT campaign_id,
  CASE WHEN user_agent IS NULL THEN 'None'
       WHEN regexp_matches(user_agent, 'MSIE|Trident') THEN 'IE'
       WHEN regexp_matches(user_agent, 'Edg') THEN 'Edge'
       WHEN regexp_matches(user_agent, 'OPR|Opera') THEN 'Opera'
       WHEN regexp_matches(user_agent, 'Firefox') THEN 'Firefox'
       WHEN regexp_matches(user_agent, 'Chrome|CriOS') THEN 'Chrome'
       WHEN regexp_matches(user_agent, 'Safari') THEN 'Safari' ELSE 'Other' END AS browser_name,
  CASE WHEN user_agent IS NULL THEN 'None'
       WHEN regexp_matches(user_agent, 'iPhone|iPad') THEN 'iOS'
       WHEN regexp_matches(user_agent, 'Android') THEN 'Android'
       WHEN regexp_matches(user_agent, 'Windows') THEN 'Windows'
       WHEN regexp_matches(user_agent, 'Mac OS X') THEN 'Mac OS X'
       WHEN regexp_matches(user_agent, 'Linux') THEN 'Linux' ELSE 'Other' END AS os_name,
  CASE WHEN user_agent IS NULL THEN 'None'
       WHEN regexp_matches(user_agent, 'iPhone') THEN 'iPhone'
       WHEN regexp_matches(user_agent, 'iPad') THEN 'iPad'
       WHEN regexp_matches(user_agent, 'Android') THEN 'Android device'
       WHEN regexp_matches(user_agent, 'Windows|Macintosh|Linux') THEN 'Desktop' ELSE 'Other' END
    AS device_family,
  COUNT(*) AS events
FROM ev GROUP BY ALL"""

AUDIENCE = _with(EV) + f""", u AS (
  SELECT c.c_custkey AS id,
         split_part(c.c_name, '#', 1) || '-' || CAST(c.c_custkey AS VARCHAR) || '@'
           || 'd' || CAST(c.c_custkey % 10 AS VARCHAR) || '.com.co' AS email,
         concat_ws(' ', split_part(c.c_name, '#', 1), split_part(c.c_name, '#', 2)) AS name_customer,
         concat_ws('/', r.r_name, n.n_name) AS description_customer,
         CAST(NULL AS VARCHAR) AS gender,
         r.r_name AS country, n.n_name AS city, c.c_mktsegment AS state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT u.id, p.campaign_id, u.email, u.name_customer, u.description_customer, u.gender,
       u.country, u.city, u.state
FROM (SELECT DISTINCT campaign_id, customer_id FROM ev) p JOIN u ON p.customer_id = u.id"""

HEADER = AUDIENCE.replace("SELECT u.id, p.campaign_id", ", people AS (SELECT u.id, p.campaign_id", 1) + """)
SELECT (SELECT COUNT(*) FROM ev) AS total_events, COUNT(*) AS total_customers,
  COUNT(DISTINCT id) AS distinct_customers FROM people"""

DIMS_QUARANTINE = """WITH product AS (
  SELECT p_partkey % 11 = 0 AS bad, '{' || array_to_string(list_filter([
    '"id":' || CAST(CAST(p_partkey AS INTEGER) AS VARCHAR), '"title":"' || p_name || '"',
    '"description":"' || p_brand || '"', '"category":"' || p_type || '"'], lambda x: x IS NOT NULL), ',') || '}' AS raw
  FROM part),
users AS (
  SELECT c_custkey % 7 = 0 AS bad, '{"name":{' || array_to_string(list_filter([
    '"first":"' || split_part(c_name, '#', 1) || '"',
    CASE WHEN contains(c_name, '#') THEN '"last":"' || split_part(c_name, '#', 2) || '"' END], lambda x: x IS NOT NULL), ',')
    || '},"email_number":' || CAST(c_custkey AS VARCHAR) || '}' AS raw
  FROM customer),
campaign AS (
  SELECT s_suppkey AS k, '{' || array_to_string(list_filter([
    '"uuid_campaign":"cmp-' || CAST(s_suppkey AS VARCHAR) || '"',
    CASE WHEN s_suppkey % 5 <> 0 THEN '"name":"' || s_name || '"' END,
    '"created_by":"' || s_name || '"',
    CASE WHEN s_suppkey % 5 <> 2 THEN '"product_id":' || CAST(s_suppkey % 21 + 1 AS VARCHAR) END],
    lambda x: x IS NOT NULL), ',') || '}' AS line
  FROM supplier)
SELECT 'product' AS table_name, raw, 'price' AS reason FROM product WHERE bad
UNION ALL SELECT 'users', raw, 'user_key' FROM users WHERE bad
UNION ALL SELECT 'campaign', CASE WHEN k % 5 = 1 THEN substr(line, 1, 20) ELSE line END,
  CASE WHEN k % 5 = 1 THEN 'record' ELSE 'name' END FROM campaign WHERE k % 5 IN (0, 1)
UNION ALL SELECT 'campaign_product_interactions', line, 'product_id' FROM campaign WHERE k % 5 = 2"""

PRICE_CLEAN = """SELECT id, title, category, COALESCE(TRY_CAST(txt AS FLOAT), CAST(0.0 AS FLOAT)) AS price
FROM (SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title, p_type AS category,
             CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '12,5'
                  ELSE CAST(p_retailprice AS VARCHAR) END AS txt FROM part)
WHERE txt IS NOT NULL"""

LINKS = """SELECT CAST(s_suppkey % 21 + 1 AS INTEGER) AS product_id,
  'cmp-' || CAST(s_suppkey AS VARCHAR) AS campaign_id, s_name AS linked_by FROM supplier"""

TAGS = """SELECT tag, COUNT(*) AS n
FROM (SELECT unnest(string_split(replace(p_name, ' ', ', '), ', ')) AS tag FROM part)
WHERE tag <> '' GROUP BY tag"""


BATCH_SQL = {
    "campaign_effectiveness": EFFECTIVENESS,
    "events_by_campaign_city": CITY,
    "events_by_campaign_type": TYPES,
    "engagement_by_customer": ENGAGEMENT,
    "city_top10": CITY_TOP,
    "header_counts": HEADER,
    "product_popularity": POPULARITY,
    "best_product": BEST,
    "campaign_names": NAMES,
    "json_roundtrip_events": ROUNDTRIP,
    "events_quarantine": QUARANTINE,
    "route_events": ROUTE,
    "enriched_events": ENRICHED,
    "activity_tumbling": TUMBLING,
    "activity_sliding": SLIDING,
    "customer_sessions": SESSIONS,
    "user_ctr": USER_CTR,
    "click_share": CLICK_SHARE,
    "funnel": FUNNEL,
    "deliverability": DELIVERABILITY,
    "repeat_engagement": REPEAT,
    "client_mix": CLIENT_MIX,
    "audience": AUDIENCE,
    "customers_table": AUDIENCE,
    "dims_quarantine": DIMS_QUARANTINE,
    "price_clean": PRICE_CLEAN,
    "campaign_links": LINKS,
    "tag_counts": TAGS,
}

# A streaming query's result, read back from its sink and compacted, must equal
# the batch query over the same events.
STREAM_EQUALS = {
    "stream_city": "events_by_campaign_city",
    "stream_types": "events_by_campaign_type",
    "stream_engagement": "engagement_by_customer",
    "changelog_latest": "engagement_by_customer",
    "stream_activity": "activity_tumbling",
    "stream_product_popularity": "product_popularity",
    "gold_city_from_silver": "city_top10",
    "topic_changelog_roundtrip": "events_by_campaign_city",
    "fanout_roundtrip": "json_roundtrip_events",
    "stream_enriched_events": "enriched_events",
    "stream_route_events": "route_events",
    "stream_customers": "customers_table",
    "stream_sessions": "customer_sessions",
    "topic_bookmarked_types": "events_by_campaign_type",
}

STREAM_SQL = {"stream_reach": REACH, "stream_late_activity": LATE}


def oracle_sql() -> dict[str, str]:
    out = dict(BATCH_SQL)
    out.update({k: BATCH_SQL[v] for k, v in STREAM_EQUALS.items()})
    out.update(STREAM_SQL)
    return out
