"""Client-mix classification of ``user_agent`` as ordered ``rlike`` rules.

Each family is one ``CASE WHEN`` chain (first match wins), so classification runs
inside whole-stage codegen instead of a per-row Python parser.  A null agent is
classified as the string ``'None'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classification rules, in priority order (pattern, label).
BROWSER_RULES = (
    ("MSIE|Trident", "IE"),
    ("Edg", "Edge"),
    ("OPR|Opera", "Opera"),
    ("Firefox", "Firefox"),
    ("Chrome|CriOS", "Chrome"),
    ("Safari", "Safari"),
)
OS_RULES = (
    ("iPhone|iPad", "iOS"),
    ("Android", "Android"),
    ("Windows", "Windows"),
    ("Mac OS X", "Mac OS X"),
    ("Linux", "Linux"),
)
DEVICE_RULES = (
    ("iPhone", "iPhone"),
    ("iPad", "iPad"),
    ("Android", "Android device"),
    ("Windows|Macintosh|Linux", "Desktop"),
)
OTHER = "Other"
MISSING = "None"

FAMILIES = {"browser_name": BROWSER_RULES, "os_name": OS_RULES, "device_family": DEVICE_RULES}


def classify(agent: Column, rules) -> Column:
    expr = F.when(agent.isNull(), F.lit(MISSING))
    for pattern, label in rules:
        expr = expr.when(agent.rlike(pattern), F.lit(label))
    return expr.otherwise(F.lit(OTHER))


def client_columns(agent: Column | str = "user_agent") -> list[Column]:
    agent = F.col(agent) if isinstance(agent, str) else agent
    return [classify(agent, rules).alias(name) for name, rules in FAMILIES.items()]
