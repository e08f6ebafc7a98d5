"""DuckDB SQL of the corpus queries that SQL can state."""

from __future__ import annotations

_ROW_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_ROW_WORDS} AS w FROM benchmark),
 windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS width, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
 docs AS (SELECT row_number() OVER () AS rid, doc_id, {_ROW_WORDS} AS w FROM documents),
 places AS (
  SELECT rid, width, i, list_slice(w, i, i + width - 1) AS g
  FROM (SELECT rid, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM docs, (SELECT DISTINCT width FROM windows))),
 met AS (SELECT DISTINCT rid, i, width, item FROM places JOIN windows USING (width, g)),
 hits AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + width)) AS p FROM (SELECT DISTINCT rid, i, width FROM met)) GROUP BY rid),
 named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS list
  FROM (SELECT DISTINCT rid, item FROM met) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)
"""


# crc32 (reflected, polynomial 0xEDB88320) of a text of ASCII characters.
_CRC32 = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), "
          "lambda i: CAST(ascii(k[i]) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), "
          "[CAST(0 AS BIGINT) for j in range(8)]), lambda d, z: CASE WHEN d % 2 = 1 "
          "THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)), 4294967295)")


def _way(state: str, cost: str, label: str, line: str) -> str:
    """The way ``state`` (cost, audit, repaired lines) with one more edit; null stays null."""
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{label}', "
            f"'t': {state}.t || {line}}} END")


def _ways(*ways: str) -> str:
    return f"least({', '.join(ways)})"


_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
_OWN = "chr(10) || role || ':' || text"
# The cheapest way to each state after a row: 0 nothing put out, 1 system, 2 user, 3 assistant last.
_STEP = {
    0: _way("s0", "2", "D", "''"),
    1: _ways(_way("s1", "2", "D", "''"),
             f"CASE WHEN NOT must AND who = 's' THEN {_way('s0', 'more', 'K', _OWN)} END"),
    2: _ways(_way("s2", "2", "D", "''"),
             *[f"CASE WHEN NOT must AND who = 'u' THEN {_way(s, 'more', 'K', _OWN)} END" for s in ("s0", "s1", "s3")],
             *[f"CASE WHEN NOT must THEN {_way(s, '1 + more', 'R', _USER + ' || text')} END" for s in ("s0", "s1", "s3")]),
    3: _ways(_way("s3", "2", "D", "''"),
             f"CASE WHEN NOT must AND who = 'a' THEN {_way('s2', 'more', 'K', _OWN)} END",
             f"CASE WHEN NOT must THEN {_way('s2', '1 + more', 'R', _ASSISTANT + ' || text')} END"),
}
_INSERT_USER = _ways("s2", *[_way(s, "5", "I", _USER) for s in ("s0", "s1", "s3")])
_INSERT_ASSISTANT = _ways("s3", _way("s2", "5", "I", _ASSISTANT))

CONVERSATION_REPAIR = f"""
WITH RECURSIVE
 hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32} % 20 AS m
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
        FROM conversations)),
 damaged AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
   CASE m WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(2) AS twice(copies) WHERE m <> 0 AND (copies = 0 OR m = 3)),
 placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 64), text) AS i,
   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS who
  FROM damaged),
 seen AS (SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
   right(bare, 1) NOT IN ('.', '!', '?') AS cut, lag(who) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
 judged AS (SELECT *, blank OR again AS must, again AND NOT blank AS duplicate, cut AND NOT blank AND NOT again AS truncated,
   CASE WHEN cut THEN 5 ELSE 0 END AS more FROM seen),
 ways AS (
  SELECT conv_id, 0 AS i, s0, s1, u AS s2, {_INSERT_ASSISTANT.replace("s2", "u")} AS s3
  FROM (SELECT *, {_INSERT_USER} AS u
        FROM (SELECT DISTINCT conv_id, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0,
                CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s1,
                CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s2,
                CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s3 FROM conversations))
  UNION ALL
  SELECT conv_id, i, s0, s1, u AS s2, {_INSERT_ASSISTANT.replace("s2", "u")} AS s3
  FROM (SELECT *, {_INSERT_USER} AS u
        FROM (SELECT w.conv_id, j.i, {_STEP[0]} AS s0, {_STEP[1]} AS s1, {_STEP[2]} AS s2, {_STEP[3]} AS s3
              FROM ways w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1))),
 counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
   count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
   count(*) FILTER (before IS NOT NULL AND before || who NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT w.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
 CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
 CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, least(s0, s3).c AS cost, least(s0, s3).a AS audit,
 sha256(substr(least(s0, s3).t, 2)) AS repaired_sha256
FROM ways w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
WHERE w.i = coalesce(c.n, 0)
"""
