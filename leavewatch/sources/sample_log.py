"""The event log that the sample ``events`` table stands for.

The table has events, values and a small JSON field, but no sessions, no
pages and no cancellations. Each column of the log is a plain expression
over one row, so the mapping adds no shuffle and is indifferent to hot users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leavewatch.schema import EVENT_SCHEMA

# The browser strings of users 0 to 3 modulo 5.
BROWSERS = [
    '"Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) '
    'Chrome/36.0.1985.143 Safari/537.36"',
    '"Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.77.4 '
    '(KHTML, like Gecko) Version/7.0.5 Safari/537.77.4"',
    "Mozilla/5.0 (Windows NT 6.1; WOW64; rv:31.0) Gecko/20100101 Firefox/31.0",
    '"Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 '
    '(KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53"',
]

# Page by event type; each step is (upper bound of k, page).
PAGE_STEPS = {
    "error": [(1, "Cancellation Confirmation"), (2, "Cancel"), (100, "Error")],
    "purchase": [(80, "NextSong"), (90, "Submit Upgrade"), (100, "Submit Downgrade")],
    "click": [(50, "NextSong"), (65, "Thumbs Up"), (75, "Thumbs Down"),
              (88, "Add to Playlist"), (100, "Add Friend")],
    "view": [(30, "Home"), (45, "Roll Advert"), (55, "Logout"), (65, "Downgrade"),
             (75, "Settings"), (82, "Help"), (90, "Upgrade"), (95, "About"),
             (100, "Save Settings")],
    "signup": [(34, "Login"), (67, "Register"), (100, "Submit Registration")],
}


# The steps of the mapping as SQL text: one parse per column is much cheaper
# to build than a tree of Column objects.
_MILLIS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000"

_INPUTS = [
    "user_id", "event_type", "value", "event_id % 50 AS slot",
    f"{_MILLIS} AS ms",
    "datediff(to_date(ts), DATE'2024-01-01') AS day",
    """try_cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS k""",
]


def _texts(values: list[str]) -> str:
    return "array({})".format(", ".join(f"'{v}'" for v in values))


def _page_sql() -> str:
    """Page by event type and k, each type being a constant table of 100 pages."""
    branches = ["WHEN user_id % 25 = 13 AND event_type IN ('purchase', 'click') THEN 'Home'"]
    for kind, steps in PAGE_STEPS.items():
        pages = [next(name for bound, name in steps if k < bound) for k in range(100)]
        branches.append(f"WHEN event_type = '{kind}' THEN get({_texts(pages)}, k)")
    return f"CASE {' '.join(branches)} END"


_COLUMNS = {
    "artist": "CASE WHEN page = 'NextSong' THEN concat('Beyoncé & #', k) END",
    "auth": "CASE WHEN page = 'Cancellation Confirmation' THEN 'Cancelled' "
            "WHEN slot >= 48 THEN 'Logged Out' ELSE 'Logged In' END",
    "firstName": "concat('f', user_id)",
    "gender": "CASE WHEN user_id % 10 = 3 THEN NULL WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END",
    # Minute of the day: like a real counter it never falls within a session.
    "itemInSession": "(ms div 60000) % 1440",
    "lastName": "concat('l', user_id)",
    "length": "CASE WHEN page = 'NextSong' THEN value END",
    "level": "if(k >= 40, 'paid', 'free')",
    "location": "concat('loc', user_id % 7)",
    "method": "if(event_type = 'view', 'GET', 'PUT')",
    "page": "page",
    "registration": "CASE WHEN user_id % 20 <> 7 "
                    "THEN 1704067200000 - (user_id % 60 + 1) * 86400000 END",
    "sessionId": "CASE WHEN slot = 47 THEN NULL "
                 "ELSE user_id * 1000 + if(user_id % 25 = 11, 0, day) END",
    "song": "CASE WHEN page = 'NextSong' THEN concat('song_', k) END",
    "status": "CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 307 ELSE 200 END",
    "ts": "ms",
    "userAgent": f"get({_texts(BROWSERS)}, int(user_id % 5))",
    "userId": "CASE WHEN slot = 49 THEN '' WHEN slot = 48 THEN NULL ELSE string(user_id) END",
}


def log_from_events(events: DataFrame) -> DataFrame:
    """Map the sample events to the columns of the event log."""
    return (events.selectExpr(*_INPUTS)
            .selectExpr("*", f"{_page_sql()} AS page")
            .selectExpr(*[f"CAST({_COLUMNS[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
                          for f in EVENT_SCHEMA]))


def read_sample_log(spark: SparkSession, folder: str) -> DataFrame:
    return log_from_events(spark.read.parquet(f"{folder}/events.parquet"))
