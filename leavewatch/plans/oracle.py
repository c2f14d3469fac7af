"""Answers to the registered queries in plain SQL, for DuckDB.

Written apart from the operators: nothing here is built from their tables or
expressions, so an agreement says something.
"""

from __future__ import annotations

_PARSED = """
parsed AS (
  SELECT event_id, user_id, event_type, value,
    event_id % 50 AS slot,
    epoch_us(ts) // 1000 AS ms,
    datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
paged AS (
  SELECT *,
    CASE
      WHEN user_id % 25 = 13 AND event_type IN ('purchase', 'click') THEN 'Home'
      WHEN event_type = 'error' THEN CASE
        WHEN k = 0 THEN 'Cancellation Confirmation' WHEN k = 1 THEN 'Cancel' ELSE 'Error' END
      WHEN event_type = 'purchase' THEN CASE
        WHEN k < 80 THEN 'NextSong' WHEN k < 90 THEN 'Submit Upgrade'
        ELSE 'Submit Downgrade' END
      WHEN event_type = 'click' THEN CASE
        WHEN k < 50 THEN 'NextSong' WHEN k < 65 THEN 'Thumbs Up' WHEN k < 75 THEN 'Thumbs Down'
        WHEN k < 88 THEN 'Add to Playlist' ELSE 'Add Friend' END
      WHEN event_type = 'view' THEN CASE
        WHEN k < 30 THEN 'Home' WHEN k < 45 THEN 'Roll Advert' WHEN k < 55 THEN 'Logout'
        WHEN k < 65 THEN 'Downgrade' WHEN k < 75 THEN 'Settings' WHEN k < 82 THEN 'Help'
        WHEN k < 90 THEN 'Upgrade' WHEN k < 95 THEN 'About' ELSE 'Save Settings' END
      WHEN event_type = 'signup' THEN CASE
        WHEN k < 34 THEN 'Login' WHEN k < 67 THEN 'Register' ELSE 'Submit Registration' END
    END AS page
  FROM parsed
),
raw_log AS (
  SELECT
    CASE WHEN page = 'NextSong' THEN 'Beyoncé & #' || k END AS artist,
    CASE WHEN page = 'Cancellation Confirmation' THEN 'Cancelled'
         WHEN slot >= 48 THEN 'Logged Out' ELSE 'Logged In' END AS auth,
    'f' || user_id AS "firstName",
    CASE WHEN user_id % 10 = 3 THEN NULL WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    (ms // 60000) % 1440 AS "itemInSession",
    'l' || user_id AS "lastName",
    CASE WHEN page = 'NextSong' THEN value END AS length,
    CASE WHEN k >= 40 THEN 'paid' ELSE 'free' END AS level,
    'loc' || (user_id % 7) AS location,
    CASE WHEN event_type = 'view' THEN 'GET' ELSE 'PUT' END AS method,
    page,
    CASE WHEN user_id % 20 <> 7
         THEN CAST(1704067200000 - (user_id % 60 + 1) * 86400000 AS BIGINT) END AS registration,
    CASE WHEN slot = 47 THEN NULL
         WHEN user_id % 25 = 11 THEN user_id * 1000
         ELSE user_id * 1000 + day END AS "sessionId",
    CASE WHEN page = 'NextSong' THEN 'song_' || k END AS song,
    CAST(CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 307 ELSE 200 END AS BIGINT)
      AS status,
    CAST(ms AS BIGINT) AS ts,
    CASE user_id % 5
      WHEN 0 THEN '"Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.143 Safari/537.36"'
      WHEN 1 THEN '"Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.77.4 (KHTML, like Gecko) Version/7.0.5 Safari/537.77.4"'
      WHEN 2 THEN 'Mozilla/5.0 (Windows NT 6.1; WOW64; rv:31.0) Gecko/20100101 Firefox/31.0'
      WHEN 3 THEN '"Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53"'
    END AS "userAgent",
    CASE WHEN slot = 49 THEN '' WHEN slot = 48 THEN NULL
         ELSE CAST(user_id AS VARCHAR) END AS "userId"
  FROM paged
)
"""


def _agent(column: str) -> str:
    return (rf"regexp_replace(trim(lower(regexp_replace(regexp_replace({column}, "
            rf"'[^a-zA-Z]', ' ', 'g'), '\s+', ' ', 'g'))), '\s[a-z]\s', ' ', 'g')")


_CLEAN = f"""
keyed AS (
  SELECT * FROM raw_log
  WHERE "userId" IS NOT NULL AND "sessionId" IS NOT NULL AND "userId" <> ''
),
clean AS (
  SELECT * EXCLUDE (auth, "firstName", "lastName") REPLACE (
    regexp_replace(artist, '[^0-9a-zA-Z]', ' ', 'g') AS artist,
    coalesce({_agent('"userAgent"')}, 'Unknown') AS "userAgent",
    coalesce(gender, 'Unknown') AS gender)
  FROM keyed
)
"""

_LABELS = """
labels_long AS (
  SELECT 'gender' AS "column", gender AS label FROM clean
  UNION ALL SELECT 'level', level FROM clean
  UNION ALL SELECT 'method', method FROM clean
  UNION ALL SELECT 'userAgent', "userAgent" FROM clean
  UNION ALL SELECT 'page', page FROM clean
  UNION ALL SELECT 'status', CAST(status AS VARCHAR) FROM clean
),
label_table AS (
  SELECT "column", label, count(*) AS n_events,
    row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, label) - 1 AS label_rank
  FROM labels_long GROUP BY "column", label
),
agents AS (SELECT label, label_rank FROM label_table WHERE "column" = 'userAgent')
"""

RAW = "WITH" + _PARSED
CLEAN = RAW + "," + _CLEAN
LABELLED = CLEAN + "," + _LABELS


def _sum(test: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


def _max(test: str, name: str) -> str:
    return f"max(CASE WHEN {test} THEN 1 ELSE 0 END) AS {name}"


_COUNTERS = [
    ("status = 200", "status_200"),
    ("status = 307", "status_307"),
    ("status = 404", "status_404"),
    ("level = 'paid'", "num_paid_interactions"),
    ("level = 'free'", "num_free_interactions"),
    ("method = 'PUT'", "num_put_interactions"),
    ("method = 'GET'", "num_get_interactions"),
    ("page = 'About'", "num_about_visits"),
    ("page = 'Add Friend'", "num_addfriend_clicks"),
    ("page = 'Add to Playlist'", "num_addtoplaylist_clicks"),
    ("page = 'Cancel'", "num_cancel_visits"),
    ("page = 'Downgrade'", "num_downgrade_visits"),
    ("page = 'Error'", "num_errors"),
    ("page = 'Help'", "num_help_visits"),
    ("page = 'Home'", "num_home_visits"),
    ("page = 'Login'", "num_login_visits"),
    ("page = 'Logout'", "num_logout_visits"),
    ("page = 'NextSong'", "num_nextsong_clicks"),
    ("page = 'Register'", "num_register_visits"),
    ("page = 'Roll Advert'", "num_rolladvert_visits"),
    ("page = 'Save Settings'", "num_savesettings_clicks"),
    ("page = 'Settings'", "num_settings_visits"),
    ("page = 'Submit Downgrade'", "num_downgrades"),
    ("page = 'Submit Registration'", "num_submitreg_clicks"),
    ("page = 'Submit Upgrade'", "num_upgrades"),
    ("page = 'Thumbs Down'", "num_thumbsdown_clicks"),
    ("page = 'Thumbs Up'", "num_thumbsup_clicks"),
    ("page = 'Upgrade'", "num_upgrade_visits"),
]
_SIGNUP = ["num_register_visits", "num_submitreg_clicks", "num_login_visits"]


def _session_cte(guards: bool = True, source: str = "clean", agents: int = 0) -> str:
    zero = "coalesce({}, 0)" if guards else "{}"
    counters = [_sum(test, name) for test, name in _COUNTERS]
    counters += [
        _sum(f'"userAgent" = (SELECT label FROM agents WHERE label_rank = {rank})',
             f'"num_userAgent_{rank}_interactions"')
        for rank in range(agents)
    ]
    return f"""
sess AS (
  SELECT "userId", "sessionId",
    max("itemInSession") AS num_items_in_session,
    {zero.format('max(length)')} AS longest_song_in_session,
    {zero.format('sum(length)')} AS session_listening_time,
    count(song) AS number_of_songs,
    min(ts) AS t0, max(ts) AS t1, max(ts) - min(ts) AS dt,
    {'coalesce(min(registration), min(ts))' if guards else 'min(registration)'} AS reg,
    {_max("page = 'Cancellation Confirmation'", "cancelled")},
    {_max("gender = 'F'", '"gender_F"')},
    {_max("gender = 'M'", '"gender_M"')},
    {_max("gender = 'Unknown'", '"gender_Unknown"')},
    {(',' + chr(10) + '    ').join(counters)}
  FROM {source} GROUP BY "userId", "sessionId"
)"""


_IDLE = "(max(t1) - min(t0) - CAST(sum(dt) AS BIGINT))"


def _user_columns(guards: bool = True, signup: bool = False, agents: int = 0,
                  places: int | None = 8, renamed: dict[str, str] | None = None) -> str:
    song_length = "sum(session_listening_time) / nullif(CAST(sum(number_of_songs) AS BIGINT), 0)"
    columns = {
        "avg_num_items_in_session": "avg(num_items_in_session)",
        "longest_song": "max(longest_song_in_session)",
        "longest_song_per_session": "avg(longest_song_in_session)",
        "listening_time_per_session": "sum(session_listening_time) / count(*)",
        "avg_number_of_songs_per_session": "CAST(sum(number_of_songs) AS BIGINT) / count(*)",
        "avg_song_length": f"coalesce({song_length}, 0)" if guards else song_length,
        "avg_session_length": "CAST(sum(dt) AS BIGINT) / count(*) / 1000",
        "time_since_joined": "(max(t1) - min(reg)) / 1000",
        "time_to_first_session": "(min(t0) - min(reg)) / 1000",
        "avg_time_between_sessions":
            f"CASE WHEN count(*) <= 1 THEN 0 ELSE {_IDLE} / nullif(count(*) - 1, 0) / 1000 END",
        "avg_gender_F": 'avg("gender_F")',
        "avg_gender_M": 'avg("gender_M")',
    }
    if guards:
        columns["avg_gender_Unknown"] = 'avg("gender_Unknown")'
    for _, name in _COUNTERS:
        if name != "num_cancel_visits" and (signup or name not in _SIGNUP):
            columns[f"avg_{name}"] = f"avg({name})"
    for rank in range(agents):
        columns[f"avg_userAgent_{rank}_interactions"] = f'avg("num_userAgent_{rank}_interactions")'
    names = renamed or {}
    parts = ['"userId"', "count(*) AS total_number_of_sessions", "max(cancelled) AS cancelled"]
    for name, value in columns.items():
        value = value if places is None else f"round(CAST({value} AS DOUBLE), {places})"
        parts.append(f'{value} AS "{names.get(name, name)}"')
    return ",\n  ".join(parts)


def _users(guards: bool = True, head: str = CLEAN, source: str = "clean", signup: bool = False,
           agents: int = 0, places: int | None = 8, renamed: dict[str, str] | None = None) -> str:
    """CTE list ending in ``users``."""
    return (f"{head},{_session_cte(guards, source, agents)},\nusers AS (\n  SELECT "
            f"{_user_columns(guards, signup, agents, places, renamed)}\n  FROM sess "
            'GROUP BY "userId"\n)\n')


USERS = _users()
EXACT_USERS = _users(places=None)

# The features whose columns are scaled, correlated and tested for zeros.
FEATURES = [
    "avg_num_items_in_session", "longest_song", "longest_song_per_session",
    "total_number_of_sessions", "listening_time_per_session",
    "avg_number_of_songs_per_session", "avg_song_length", "avg_session_length",
    "time_since_joined", "time_to_first_session", "avg_time_between_sessions",
    "avg_gender_F", "avg_gender_M", "avg_gender_Unknown",
    "avg_status_200", "avg_status_307", "avg_status_404",
    "avg_num_paid_interactions", "avg_num_free_interactions",
    "avg_num_put_interactions", "avg_num_get_interactions", "avg_num_nextsong_clicks",
    "avg_num_thumbsup_clicks", "avg_num_home_visits", "avg_num_addtoplaylist_clicks",
    "avg_num_addfriend_clicks", "avg_num_rolladvert_visits", "avg_num_logout_visits",
    "avg_num_thumbsdown_clicks", "avg_num_downgrade_visits", "avg_num_settings_visits",
    "avg_num_help_visits", "avg_num_upgrade_visits", "avg_num_about_visits",
    "avg_num_savesettings_clicks", "avg_num_errors", "avg_num_upgrades",
    "avg_num_downgrades",
]

_RAW_COLUMNS = ["artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length",
                "level", "location", "method", "page", "registration", "sessionId", "song",
                "status", "ts", "userAgent", "userId"]
_TEXT = {"artist", "auth", "firstName", "gender", "lastName", "level", "location", "method",
         "page", "song", "userAgent", "userId"}


def _missing(columns: list[str]) -> str:
    return ", ".join(
        f'count(*) FILTER (WHERE "{c}" IS NULL{f""" OR "{c}" = {chr(39) * 2}""" if c in _TEXT else ""}) AS "{c}"'
        for c in columns)


def _any_null() -> str:
    names = [f for f in FEATURES if f != "avg_gender_Unknown"] + ["userId", "cancelled"]
    return " OR ".join(f'"{name}" IS NULL' for name in names)


def _one_hot() -> str:
    plain = {
        "gender": ["F", "M", "Unknown"],
        "level": ["paid", "free"],
        "method": ["PUT", "GET"],
        "page": ["NextSong", "Thumbs Up", "Thumbs Down", "Add to Playlist", "Add Friend", "Home",
                 "Roll Advert", "Logout", "Downgrade", "Settings", "Help", "Upgrade", "About",
                 "Save Settings", "Error", "Submit Upgrade", "Submit Downgrade", "Cancel",
                 "Cancellation Confirmation", "Register", "Submit Registration", "Login"],
        "status": ["200", "307", "404"],
    }
    flags = []
    for column, labels in plain.items():
        for label in labels:
            name = "cancelled" if label == "Cancellation Confirmation" else f"{column}_{label}"
            flags.append(f"CAST(CAST({column} AS VARCHAR) = '{label}' AS DOUBLE) AS \"{name}\"")
    for rank in range(5):
        flags.append(f'CAST(label_rank = {rank} AS DOUBLE) AS "userAgent_{rank}"')
    return f"""{LABELLED}
SELECT artist, "itemInSession", length, location, registration / 1000 AS registration,
  "sessionId", song, ts / 1000 AS ts, "userId",
  {', '.join(flags)}
FROM clean JOIN agents ON clean."userAgent" = agents.label"""


_SUMMARY = f"""{CLEAN},{_session_cte(guards=False)},
summary AS (
  SELECT "userId",
    CASE WHEN count(*) <= 1 THEN 0
         ELSE {_IDLE} / nullif(count(*) - 1, 0) / 1000 END AS avg_time_between_sessions,
    CAST(sum(dt) AS BIGINT) / count(*) / 1000 AS avg_session_length,
    avg("gender_F") AS "avg_gender_F",
    sum(session_listening_time) / count(*) AS listening_time_per_session,
    count(*) AS total_number_of_sessions,
    avg(num_errors) AS avg_num_errors,
    avg(num_paid_interactions) AS avg_num_paid_interactions,
    max(cancelled) AS cancelled
  FROM sess GROUP BY "userId"
)
"""

_Z = "CAST(1.959963984540054 AS DOUBLE)"


def _t(v: str) -> str:
    z = _Z
    return f"""CASE {v}
    WHEN 0 THEN NULL WHEN 1 THEN 12.706204736432095 WHEN 2 THEN 4.302652729696142
    WHEN 3 THEN 3.182446305284263 WHEN 4 THEN 2.7764451051977987 WHEN 5 THEN 2.5705818366147395
    WHEN 6 THEN 2.446911848791681 WHEN 7 THEN 2.3646242510102993 WHEN 8 THEN 2.306004135033371
    WHEN 9 THEN 2.2621571627409915
    ELSE {z} + (pow({z}, 3) + {z}) / 4 / nullif({v}, 0)
      + (5 * pow({z}, 5) + 16 * pow({z}, 3) + 3 * {z}) / 96 / nullif(pow({v}, 2), 0)
      + (3 * pow({z}, 7) + 19 * pow({z}, 5) + 17 * pow({z}, 3) - 15 * {z}) / 384
        / nullif(pow({v}, 3), 0)
      + (79 * pow({z}, 9) + 776 * pow({z}, 7) + 1482 * pow({z}, 5) - 1920 * pow({z}, 3)
         - 945 * {z}) / 92160 / nullif(pow({v}, 4), 0) END"""


def _ci(targets: list[str], groups: list[str], v: str, per: int = 1) -> str:
    keys = ", ".join(f'"{g}"' for g in groups)
    shown = ", ".join(f'round("{g}", 8) AS "{g}"' if g.startswith("avg") else f'"{g}"'
                      for g in groups)
    return _SUMMARY + " UNION ALL ".join(
        f"""SELECT {shown}, count(*) AS n_rows, '{c}' AS target,
  round(avg("{c}") / {per}, 8) AS mean_value,
  round(stddev_samp("{c}") / sqrt(count(*)) * {_t(v)} / {per}, 8) AS half_width
FROM summary GROUP BY {keys}""" for c in targets)


def _hash(key: str, salt: str = "") -> str:
    text = f"'{salt}' || {key}" if salt else key
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def _unpivot(template: str, head: str = EXACT_USERS) -> str:
    return head + " UNION ALL ".join(template.format(c=c) for c in FEATURES + ["cancelled"])


def _correlations(names: list[str] = FEATURES + ["cancelled"], head: str = EXACT_USERS) -> str:
    """Each pair over the users who have both values."""
    values = ", ".join(f"{{'i': {i}, 'c': '{c}', 'v': CAST(\"{c}\" AS DOUBLE)}}"
                       for i, c in enumerate(names))
    return f"""{head},
long AS (SELECT "userId", unnest([{values}]) AS u FROM users),
cells AS (SELECT "userId", u.i AS i, u.c AS c, u.v AS v FROM long)
SELECT a.c AS feature_i, b.c AS feature_j,
  round(covar_samp(a.v, b.v) / nullif(stddev_samp(CASE WHEN b.v IS NOT NULL THEN a.v END)
    * stddev_samp(CASE WHEN a.v IS NOT NULL THEN b.v END), 0), 6) AS correlation
FROM cells a JOIN cells b ON a."userId" = b."userId" AND a.i > b.i
GROUP BY a.c, b.c"""


def _minmax(names: list[str] = FEATURES, head: str = EXACT_USERS) -> str:
    scaled = ", ".join(
        f'round(CASE WHEN "{c}" IS NULL THEN NULL WHEN max("{c}") OVER () = min("{c}") OVER () THEN 0.5 ELSE '
        f'("{c}" - min("{c}") OVER ()) / nullif(CAST(max("{c}") OVER () - min("{c}") OVER () AS DOUBLE), 0) '
        f'END, 8) AS "{c}"' for c in names)
    return f'{head} SELECT "userId", cancelled, {scaled} FROM users'


_SPLIT = EXACT_USERS + f""",
parts AS (
  SELECT *, CASE WHEN {_hash('"userId"')} % 100 < 25 THEN 'test' ELSE 'train' END AS split,
    CAST({_hash('"userId"', 'fold:')} % 3 AS INTEGER) AS fold
  FROM users
)
"""

_SLICES = """,
ids AS (SELECT DISTINCT "userId" FROM clean),
sliced AS (
  SELECT "userId",
    CAST((row_number() OVER (ORDER BY "userId") - 1)
         // (count(*) OVER () // 10 + 1) AS INTEGER) AS bucket
  FROM ids
)
"""

_HASHED = f"""CAST({_hash('"userId"')} % 10 AS INTEGER)"""

_METRICS = EXACT_USERS + """,
guess AS (SELECT cancelled AS l, CASE WHEN avg_num_errors > 0.4 THEN 1 ELSE 0 END AS p FROM users),
cell AS (
  SELECT count(*) AS n,
    CAST(count(*) FILTER (WHERE l = 1 AND p = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE l = 0 AND p = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE l = 1 AND p = 0) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (WHERE l = 0 AND p = 0) AS DOUBLE) AS tn
  FROM guess
)
SELECT n AS n_rows,
  round(((tp + fn) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)
       + (tn + fp) * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / n, 8) AS f1_weighted,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1_positive,
  round((tp + tn) / n, 8) AS accuracy,
  round(1 - (tp + tn) / n, 8) AS error
FROM cell
"""

_SESSION_OUTPUT = f"""{CLEAN},{_session_cte()}
SELECT * EXCLUDE (t0, t1, dt, reg) REPLACE (
    round(longest_song_in_session, 8) AS longest_song_in_session,
    round(session_listening_time, 8) AS session_listening_time),
  t0 / 1000 AS session_begin, t1 / 1000 AS session_end, dt / 1000 AS session_length,
  reg / 1000 AS registration
FROM sess
"""

_ALTERNATE = {
    "avg_num_rolladvert_visits": "avg_num_roll_advert_visits",
    "avg_num_downgrades": "avg_num_downgrade_clicks",
    "avg_num_upgrades": "avg_num_upgrade_clicks",
    "avg_number_of_songs_per_session": "avg_num_songs_per_session",
}

_FILLED = (CLEAN + ", filled AS (SELECT * REPLACE "
           "(coalesce(registration, ts) AS registration) FROM clean)")

_AGENT_FEATURES = CLEAN + """,
totals AS (SELECT "userId", count(DISTINCT "sessionId") AS s FROM clean GROUP BY "userId")
SELECT c."userId", c."userAgent", round(count(*) / any_value(s), 8) AS avg_interactions
FROM clean c JOIN totals USING ("userId") GROUP BY c."userId", c."userAgent"
"""

_WIDE = _users(head=LABELLED, agents=5) + "SELECT * FROM users"

_POINTS = _SUMMARY + """
SELECT cancelled, 'errors_gap' AS series, round(avg_num_errors, 8) AS x,
  round(avg_time_between_sessions / 3600, 8) AS y FROM summary
UNION ALL SELECT cancelled, 'errors_paid', round(avg_num_errors, 8),
  round(avg_num_paid_interactions, 8) FROM summary
UNION ALL SELECT cancelled, 'paid_gap', round(avg_num_paid_interactions, 8),
  round(avg_time_between_sessions / 3600, 8) FROM summary"""

_BARE = [f for f in FEATURES if f != "avg_gender_Unknown"]
_BARE_USERS = _users(guards=False, places=None)

_SMALL_POINTS = [(f"elasticNetParam=0, regParam={r}", r, 0) for r in (0.01, 0.1)]
_LARGE_POINTS = [(f"elasticNetParam={a}, regParam={r}", r, a) for a in (0, 0.33, 0.66, 1) for r in (0.001, 0.01, 0.1)]
_INVERSE_POINTS = [(f"C={c}, l1_ratio={a}", c, a)
                   for c in ("1e-06", "1e-05", "0.0001", "0.001", "0.01", "0.1", "1", "10", "100")
                   for a in (0, 0.25, 0.4, 0.5, 0.6, 0.75, 1)]


def _solved(points: list[tuple], folds: int, percent: int, whole_scale: bool = False,
            standardised: bool = True, inverse: bool = False, positive: bool = False) -> str:
    """CTEs that fit every penalty on every fold (-1: nobody held out) by accelerated proximal descent.

    ``solved`` has the coefficients, ``scores`` the held-out score by point and
    fold, ``best`` the chosen point's coefficients. A plain first-order method
    with restarts, on centred columns; steps end where nothing moves.
    """
    d = len(FEATURES)
    seen = "" if whole_scale else " FILTER (WHERE split = 'train')"
    scaled = ", ".join(
        f'CASE WHEN min("{c}"){seen} OVER () = max("{c}"){seen} OVER () THEN 0.5 ELSE ("{c}" - min("{c}"){seen} OVER ()) '
        f'/ CAST(max("{c}"){seen} OVER () - min("{c}"){seen} OVER () AS DOUBLE) END' for c in FEATURES)
    values = ", ".join(f"({i}, '{name}', CAST({strength} AS DOUBLE), CAST({ratio} AS DOUBLE))"
                       for i, (name, strength, ratio) in enumerate(points))
    weight = "1 / (strength * n)" if inverse else "strength"
    f1 = "2 * tp / greatest(2 * tp + fp + fn, 1)"
    score = f1 if positive else f"((tp + fn) * {f1} + (tn + fp) * 2 * tn / greatest(2 * tn + fp + fn, 1)) / (tp + fp + fn + tn)"
    zeros = f"list_transform(range({d + 1}), lambda j: 0.0::DOUBLE)"
    return EXACT_USERS.replace("WITH", "WITH RECURSIVE", 1) + f""",
parts AS (
  SELECT *, CASE WHEN {_hash('"userId"')} % 100 < {percent} THEN 'test' ELSE 'train' END AS split,
    CAST({_hash('"userId"', 'fold:')} % {folds} AS INTEGER) AS fold FROM users),
scaled AS (SELECT "userId", CAST(cancelled AS DOUBLE) AS y, split, fold, [{scaled}] AS x FROM parts),
points AS (SELECT * FROM (VALUES {values}) AS p(point, params, strength, ratio)),
members AS (
  SELECT held, "userId", y, x FROM scaled, range(-1, {folds}) AS h(held) WHERE split = 'train' AND fold <> held),
columns_of AS (
  SELECT held, j, avg(x[j]) AS m, stddev_samp(x[j]) AS s, sqrt(avg(x[j] * x[j])) AS size
  FROM members, range(1, {d + 1}) AS c(j) GROUP BY held, j),
frames AS (
  SELECT held, list(m ORDER BY j) AS means, list(CASE WHEN s > 1e-9 * size THEN {'s' if standardised else '1.0'} END ORDER BY j) AS units
  FROM columns_of GROUP BY held),
centred AS (
  SELECT held, "userId", y, [1.0] || list_transform(x, lambda v, j: coalesce((v - means[j]) / units[j], 0)) AS x
  FROM members JOIN frames USING (held)),
gathered AS (
  SELECT held, count(*) AS n, list(x ORDER BY "userId") AS xs, list(y ORDER BY "userId") AS ys,
    0.25 * sum(list_inner_product(x, x)) / count(*) AS steep FROM centred GROUP BY held),
jobs AS (
  SELECT point, held, n, xs, ys, steep, {weight} * ratio / steep AS lasso, 1 + {weight} * (1 - ratio) / steep AS ridge,
    list_transform(range(1, {d + 2}), lambda j: list_transform(xs, lambda r: r[j])) AS cols
  FROM points, gathered),
run(point, held, step, w, z, t, moved) USING KEY (point, held) AS (
  SELECT point, held, 0, {zeros}, {zeros}, 1.0::DOUBLE, 1.0::DOUBLE FROM jobs
  UNION
  SELECT point, held, step + 1, v,
    CASE WHEN back > 0 THEN v ELSE list_transform(v, lambda a, j: a + (t - 1) / t2 * (a - w[j])) END,
    CASE WHEN back > 0 THEN 1.0 ELSE t2 END, list_max(list_transform(v, lambda a, j: abs(a - w[j]) / (1 + abs(a))))
  FROM (
    SELECT *, list_inner_product(list_transform(z, lambda a, j: a - v[j]), list_transform(v, lambda a, j: a - w[j])) AS back
    FROM (
      SELECT *, (1 + sqrt(1 + 4 * t * t)) / 2 AS t2,
        list_transform(aim, lambda a, j: CASE WHEN j = 1 THEN a ELSE sign(a) * greatest(abs(a) - lasso, 0) / ridge END) AS v
      FROM (
        SELECT *, list_transform(cols, lambda c, j: z[j] - list_inner_product(c, away) / n / steep) AS aim
        FROM (
          SELECT r.*, n, cols, steep, lasso, ridge,
            list_transform(xs, lambda x, i: 1 / (1 + exp(-list_inner_product(x, z))) - ys[i]) AS away
          FROM run r JOIN jobs USING (point, held) WHERE step < 60000 AND moved > 1e-13)))) AS stepped
),
solved AS (
  SELECT point, held, coef, w[1] - list_inner_product(coef, means) AS intercept
  FROM (SELECT *, list_transform(w[2:], lambda a, j: coalesce(a / units[j], 0)) AS coef FROM run JOIN frames USING (held))),
guesses AS (
  SELECT point, held, y = 1 AS hit, intercept + list_inner_product(coef, x) > 0 AS said
  FROM solved JOIN scaled ON split = 'train' AND fold = held),
cells AS (
  SELECT point, held, count(*) FILTER (hit AND said) AS tp, count(*) FILTER (NOT hit AND said) AS fp,
    count(*) FILTER (hit AND NOT said) AS fn, count(*) FILTER (NOT hit AND NOT said) AS tn FROM guesses GROUP BY point, held),
scores AS (SELECT point, params, CAST(held AS INTEGER) AS fold, {score} AS score FROM cells JOIN points USING (point)),
means_of AS (
  SELECT point, params, count(*) AS n_folds, round(avg(score), 12) AS mean_score, stddev_samp(score) AS spread FROM scores GROUP BY ALL),
grid AS (SELECT *, CAST(rank() OVER (ORDER BY mean_score DESC) AS INTEGER) AS rank FROM means_of),
best AS (
  SELECT s.*, params, strength, ratio FROM solved s JOIN points USING (point)
  WHERE held = -1 AND point = (SELECT point FROM means_of ORDER BY mean_score DESC, point LIMIT 1)),
tested AS (
  SELECT "userId", CAST(y AS INTEGER) AS label, intercept + list_inner_product(coef, x) AS margin FROM scaled, best WHERE split = 'test'),
summary AS (
  SELECT params, (SELECT count(*) FROM scaled WHERE split = 'train') AS n_train, tp + fp + fn + tn AS n_test,
    round(((tp + fn) * {f1} + (tn + fp) * 2 * tn / greatest(2 * tn + fp + fn, 1)) / (tp + fp + fn + tn), 8) AS f1_weighted,
    round({f1}, 8) AS f1_positive, round((tp + tn) / (tp + fp + fn + tn), 8) AS accuracy,
    round(1 - (tp + tn) / (tp + fp + fn + tn), 8) AS error
  FROM best, (
    SELECT count(*) FILTER (label = 1 AND margin > 0) AS tp, count(*) FILTER (label = 0 AND margin > 0) AS fp,
      count(*) FILTER (label = 1 AND margin <= 0) AS fn, count(*) FILTER (label = 0 AND margin <= 0) AS tn FROM tested))
"""


def _six(value: str) -> str:
    """Rounded to six digits; no negative zero."""
    return f"CASE WHEN abs({value}) < 0.0000005 THEN 0.0 ELSE round({value}, 6) END"


_SMALL_FIT = _solved(_SMALL_POINTS, folds=2, percent=20, whole_scale=True)
_LARGE_FIT = _solved(_LARGE_POINTS, folds=3, percent=25)
_ELASTIC_FIT = _solved(_INVERSE_POINTS, folds=5, percent=25, standardised=False, inverse=True, positive=True)
_NAMES = "[" + ", ".join(f"'{c}'" for c in FEATURES) + "]"
_GRID = "'logistic' AS model, params, n_folds, round(mean_score, 8) AS mean_score, round(spread, 8) AS spread, rank"


def _coefficients(order: str) -> str:
    return _SMALL_FIT + f""", named AS (SELECT unnest({_NAMES}) AS feature, unnest(coef) AS coefficient FROM best)
SELECT CAST(row_number() OVER (ORDER BY round(abs(coefficient), 8) {order}, feature) - 1 AS INTEGER) AS place, feature,
  {_six('coefficient')} AS coefficient, {_six('abs(coefficient)')} AS abs_coefficient,
  CASE WHEN coefficient < 0 THEN 'red' ELSE 'blue' END AS colour FROM named"""


_CERTIFICATE = _LARGE_FIT + f""",
away AS (
  SELECT x, 1 / (1 + exp(-(intercept + list_inner_product(coef, x)))) - y AS r FROM scaled, best WHERE split = 'train'),
slopes AS (
  SELECT 0 AS j, avg(r) AS slope FROM away
  UNION ALL SELECT j, avg(x[j] * r) FROM away, range(1, {len(FEATURES) + 1}) AS c(j) GROUP BY j),
terms AS (
  SELECT j, CASE WHEN j = 0 THEN '(intercept)' ELSE ({_NAMES})[j] END AS feature,
    CASE WHEN j = 0 THEN intercept ELSE coef[j] END AS coefficient,
    CASE WHEN j = 0 THEN 0 ELSE strength * ratio * coalesce(units[j], 0) END AS lasso,
    slope + CASE WHEN j = 0 THEN 0 ELSE strength * (1 - ratio) * coalesce(units[j], 0) ** 2 * coef[j] END AS gradient
  FROM slopes, best JOIN frames USING (held))
SELECT feature, {_six('coefficient')} AS coefficient, {_six('gradient')} AS gradient, {_six('lasso')} AS lasso,
  CAST(CASE WHEN abs(coefficient) > 1e-9 THEN abs(gradient + lasso * sign(coefficient)) ELSE abs(gradient) - lasso END < 1e-8 AS INTEGER) AS optimal
FROM terms"""

ORACLE_SQL: dict[str, str] = {
    "scan_json_roundtrip": RAW + """
SELECT * REPLACE (CAST(registration AS VARCHAR) AS registration,
  CAST("sessionId" AS VARCHAR) AS "sessionId") FROM raw_log""",
    "user_bucket_assign": CLEAN + _SLICES + "SELECT * FROM sliced",
    "user_bucket_counts": CLEAN + _SLICES + """
SELECT bucket, count(DISTINCT "userId") AS n_users, count(*) AS n_events
FROM clean JOIN sliced USING ("userId") GROUP BY bucket""",
    "user_hash_bucket_counts": CLEAN + f"""
SELECT {_HASHED} AS bucket, count(DISTINCT "userId") AS n_users, count(*) AS n_events
FROM clean GROUP BY 1""",
    "scan_bucket_pruned": CLEAN + f"""
SELECT {_HASHED} AS bucket, "userId", count(*) AS n_events, max(ts) AS last_ts
FROM keyed GROUP BY ALL""",
    "scan_slice_pruned": CLEAN + _SLICES + """
SELECT bucket, "userId", count(*) AS n_events, max(ts) AS last_ts
FROM keyed JOIN sliced USING ("userId") GROUP BY ALL""",
    "text_copy_counts": RAW + """
SELECT count(*) AS n_lines, count("userId") AS n_keyed_lines, CAST(0 AS BIGINT) AS n_changed_lines,
  CAST(sum(ts) AS BIGINT) AS sum_ts, count(song) AS n_songs, count("userAgent") AS n_agents FROM raw_log""",
    "extract_user_key": RAW + """
SELECT "userId" AS key_by_path, "userId" AS key_by_pattern, count(*) AS n_lines
FROM raw_log GROUP BY "userId" """,
    "sink_user_features": USERS + "SELECT * FROM users",
    "distinct_users": CLEAN + 'SELECT DISTINCT "userId" FROM clean',
    "profile_missing": RAW + f"SELECT {_missing(_RAW_COLUMNS)} FROM raw_log",
    "profile_missing_clean": CLEAN + "SELECT " + _missing(
        [c for c in _RAW_COLUMNS if c not in ("auth", "firstName", "lastName")]) + " FROM clean",
    "profile_null_features": _users(guards=False) + "SELECT " + ", ".join(
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"'
        for c in ["userId", *FEATURES, "cancelled"] if c != "avg_gender_Unknown") + " FROM users",
    "profile_shape": RAW + "SELECT count(*) AS n_rows, CAST(18 AS BIGINT) AS n_columns FROM raw_log",
    "auth_page_counts": CLEAN + "SELECT auth, page, count(page) AS n_events FROM keyed GROUP BY auth, page",
    "clean_events": CLEAN + "SELECT * REPLACE (ts / 1000 AS ts, registration / 1000 AS registration) FROM clean",
    "clean_artist": RAW + """
SELECT artist, count(*) AS n_events, regexp_replace(artist, '[^0-9a-zA-Z]', ' ', 'g') AS cleaned
FROM raw_log GROUP BY artist""",
    "clean_user_agent": RAW + f"""
SELECT "userAgent", count(*) AS n_events, {_agent('"userAgent"')} AS cleaned
FROM raw_log GROUP BY "userAgent" """,
    "deny_users": CLEAN + """
SELECT "userId", count(*) AS n_events FROM clean
WHERE "userId" NOT IN ('11', '29', '1261737') GROUP BY "userId" """,
    "deny_users_by_table": CLEAN + """
SELECT "userId", count(*) AS n_events FROM clean GROUP BY "userId"
HAVING count(*) FILTER (WHERE page = 'Cancellation Confirmation') = 0""",
    "rows_with_null": _users(guards=False) + f"SELECT * FROM users WHERE {_any_null()}",
    "user_null_length_rows": CLEAN + """SELECT * FROM clean WHERE "userId" = '8' AND length IS NULL""",
    "zero_column_report": _unpivot("""
SELECT '{c}' AS feature, round(CAST(min("{c}") AS DOUBLE), 8) AS min_value,
  round(CAST(max("{c}") AS DOUBLE), 8) AS max_value, round(avg("{c}"), 8) AS mean_value,
  CAST(min("{c}") = 0 AND max("{c}") = 0 AS INTEGER) AS only_zeros,
  CAST(avg("{c}") = 0 AS INTEGER) AS zero_mean FROM users"""),
    "drop_zero_columns": USERS + "SELECT * FROM users",
    "union_zero_fill": _users(signup=True) + """
SELECT * REPLACE (CAST(0 AS DOUBLE) AS avg_num_register_visits,
  CAST(0 AS DOUBLE) AS avg_num_submitreg_clicks, CAST(0 AS DOUBLE) AS avg_num_login_visits) FROM users
UNION ALL SELECT * FROM users""",
    "label_index": LABELLED + "SELECT * FROM label_table",
    "one_hot_events": _one_hot(),
    "one_hot_pipeline_events": _one_hot(),
    "session_rollup": _SESSION_OUTPUT,
    "user_features": USERS + "SELECT * FROM users",
    "user_features_unguarded": _users(guards=False) + "SELECT * FROM users",
    "user_features_extended": _users(head=_FILLED, source="filled", signup=True,
                                     renamed=_ALTERNATE) + "SELECT * FROM users",
    "user_features_wide": _WIDE,
    "user_features_transformer": _WIDE,
    "sql_user_features": _WIDE,
    "user_agent_features": _AGENT_FEATURES,
    "user_features_incremental": USERS + "SELECT * FROM users",
    "published_features": USERS + "SELECT * FROM users",
    "label_dictionary_growth": CLEAN + """,
bounds AS (SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM clean),
sliced AS (SELECT clean.*, (ts - first_ts) * 10 // (last_ts - first_ts + 1) AS part FROM clean, bounds),
arrived AS (SELECT *, CASE WHEN part = 3 THEN 10 ELSE part END AS place FROM sliced),
long AS (
  SELECT 'userId' AS "column", "userId" AS label, part, place FROM arrived
  UNION ALL SELECT 'userAgent', "userAgent", part, place FROM arrived
  UNION ALL SELECT 'page', page, part, place FROM arrived
  UNION ALL SELECT 'artist', artist, part, place FROM arrived WHERE artist IS NOT NULL),
counted AS (SELECT "column", label, part, place, count(*) AS n FROM long GROUP BY ALL),
firsts AS (
  SELECT "column", label, min(place) AS place, arg_min(part, place) AS part, arg_min(n, place) AS n, CAST(sum(n) AS BIGINT) AS n_events
  FROM counted GROUP BY "column", label)
SELECT "column", label, row_number() OVER (PARTITION BY "column" ORDER BY place, n DESC, label) - 1 AS label_rank,
  'part-' || part AS added_in, n_events FROM firsts""",
    "user_label_vectors": CLEAN + """,
ranks AS (SELECT artist, row_number() OVER (ORDER BY count(*) DESC, artist) - 1 AS place FROM clean WHERE artist IS NOT NULL GROUP BY artist),
sessions AS (SELECT "userId", count(DISTINCT "sessionId") AS s FROM clean GROUP BY "userId")
SELECT "userId", CAST(place AS INTEGER) AS place, round(count(*) / any_value(s), 8) AS value
FROM clean JOIN ranks USING (artist) JOIN sessions USING ("userId") GROUP BY "userId", place""",
    "churn_phase": CLEAN + """
SELECT "userId", "sessionId", ts, page,
  CAST(page = 'Cancellation Confirmation' AS INTEGER) AS cancelled,
  CAST(sum(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) OVER (
    PARTITION BY "userId" ORDER BY ts DESC RANGE UNBOUNDED PRECEDING) AS BIGINT) AS phase
FROM clean""",
    "eda_user_summary": _SUMMARY + """
SELECT "userId", round(avg_time_between_sessions, 8) AS avg_time_between_sessions,
  round(avg_session_length, 8) AS avg_session_length, round("avg_gender_F", 8) AS "avg_gender_F",
  round(listening_time_per_session, 8) AS listening_time_per_session, total_number_of_sessions,
  round(avg_num_errors, 8) AS avg_num_errors,
  round(avg_num_paid_interactions, 8) AS avg_num_paid_interactions, cancelled FROM summary""",
    "group_mean_ci": _ci(["avg_num_errors", "total_number_of_sessions",
                          "avg_num_paid_interactions", "avg_gender_F"], ["cancelled"], "count(*)"),
    "group_mean_ci_hours": _ci(["avg_time_between_sessions", "avg_session_length"],
                               ["cancelled"], "count(*)", 3600),
    "group_mean_ci_by_gender": _ci(["avg_time_between_sessions"], ["avg_gender_F", "cancelled"],
                                   "(count(*) - 1)"),
    "scatter_points": _POINTS,
    "series_points": _POINTS,
    "correlation_pairs": _correlations(),
    "correlation_pairs_unguarded": _correlations(_BARE + ["cancelled"], _BARE_USERS),
    "minmax_scaled": _minmax(),
    "minmax_scaled_unguarded": _minmax(_BARE, _BARE_USERS),
    "churn_logreg_cv": _SMALL_FIT + "SELECT 'logistic' AS model, * FROM summary",
    "churn_predictions": _SMALL_FIT + f"""
SELECT "userId", label, CAST(margin > 0 AS INTEGER) AS prediction, {_six('1 / (1 + exp(-margin))')} AS probability FROM tested""",
    "churn_coefficients": _coefficients("DESC"),
    "churn_coefficients_rising": _coefficients("ASC"),
    "churn_certificate": _CERTIFICATE,
    "grid_results": _LARGE_FIT + f"SELECT {_GRID} FROM grid",
    "grid_fold_scores": _LARGE_FIT + "SELECT 'logistic' AS model, params, fold, round(score, 8) AS score FROM scores",
    "churn_elastic_cv": _ELASTIC_FIT + f"""
SELECT {_GRID}, n_train, n_test, f1_positive, accuracy FROM grid LEFT JOIN summary USING (params)""",
    "train_test_split": _SPLIT + 'SELECT "userId", split, fold FROM parts',
    "base_rate": _SPLIT + """
SELECT split, count(*) AS n_rows, round(avg(cancelled), 8) AS base_rate FROM parts GROUP BY split""",
    "classification_metrics": _METRICS,
}
