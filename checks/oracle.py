"""The same queries as DuckDB SQL over the same tables.

Written independently of the Spark code: plain joins, windows and quantile functions.
"""

from lapsewise.plans.catalog import ACTIVITY_BINS, BINS, RATE_FEATURES, SEGMENT_FEATURES
from lapsewise.schema import BOXED_PAGES, BROWSERS, DEVICES, EVENT_SCHEMA, FEATURES, PAGES, RATED_PAGES, page_slug
from lapsewise.sources.activity import AGENTS, FIRST_REGISTRATION_MS

LOG_COLUMNS = ", ".join(f'"{c}"' for c in EVENT_SCHEMA.names)
STAMP = "make_timestamp(ts * 1000)"
UNRATED = "('Cancel', 'Cancellation Confirmation', 'NextSong')"
EDA = ["num_sessions", "session_interval_hours", "avg_session_length", "count_songs",
       "count_unique_artists", "count_unique_songs", "max_days_since_registration"]

_agent_cases = " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(AGENTS))


def r(expression: str, digits: int | None = 6) -> str:
    return expression if digits is None else f"round({expression}, {digits})"


def _values(name: str, items: list[str]) -> str:
    return f"(VALUES {', '.join(f'({chr(39)}{i}{chr(39)})' for i in items)}) AS {name}(v)"


def _stack(table: str, columns: list[str], keep: list[str], name: str, value: str) -> str:
    """Rows (keep, name, value) of the listed columns under each other."""
    kept = "".join(f'"{c}", ' for c in keep)
    return " UNION ALL ".join(
        f'SELECT {kept}\'{c}\' AS {name}, CAST("{c}" AS DOUBLE) AS {value} FROM {table}' for c in columns
    )


def _categories(table: str, columns: list[str], keep: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS feature, CAST(\"{c}\" AS VARCHAR) AS category FROM {table}" for c in columns
    )


def _rate(source: str) -> str:
    return f"""SELECT feature, category,
        count(DISTINCT CASE WHEN churn = 0 THEN "userId" END) AS non_churners,
        count(DISTINCT CASE WHEN churn = 1 THEN "userId" END) AS churners,
        {r('''100.0 * count(DISTINCT CASE WHEN churn = 1 THEN "userId" END)
              / CAST(count(DISTINCT "userId") AS DOUBLE)''', None)} AS churn_rate
        FROM {source} JOIN label USING ("userId") WHERE category IS NOT NULL GROUP BY feature, category"""


def _numeric_stats(log: str, tag: str) -> dict[str, str]:
    """CTEs of the per-user metrics and their summaries for one log."""
    return {
        f"sess{tag}": f"""SELECT "userId", "sessionId", min(ts) AS a, max(ts) AS b, count(*) AS n,
            count(song) AS songs FROM {log} GROUP BY ALL""",
        f"label{tag}": f"""SELECT "userId", max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END)
            AS churn FROM {log} GROUP BY ALL""",
        f"eda_sess{tag}": f"""SELECT "userId", count(*) AS num_sessions,
            CASE WHEN count(*) > 1 THEN CAST(trunc(CAST(max(b) - min(a) - sum(b - a) AS DOUBLE) / 3600000.0
                / (count(*) - 1)) AS INTEGER) END AS session_interval_hours,
            avg(b - a) / 60000.0 AS avg_session_length FROM sess{tag} GROUP BY ALL""",
        f"eda_log{tag}": f"""SELECT "userId", count(*) AS count_songs,
            count(DISTINCT artist) + max(CASE WHEN artist IS NULL THEN 1 ELSE 0 END) AS count_unique_artists,
            count(DISTINCT song) + max(CASE WHEN song IS NULL THEN 1 ELSE 0 END) AS count_unique_songs,
            max(CAST(trunc((ts - registration) / 86400000.0) AS INTEGER)) AS max_days_since_registration
            FROM {log} GROUP BY ALL""",
        f"eda{tag}": f"""SELECT * FROM label{tag} JOIN eda_sess{tag} USING ("userId")
            JOIN eda_log{tag} USING ("userId")""",
        f"eda_long{tag}": "SELECT churn, metric, value FROM ("
        + _stack(f"eda{tag}", EDA, ["churn"], "metric", "value")
        + ") WHERE value IS NOT NULL",
        f"eda_stats{tag}": f"""SELECT metric, churn, count(*) AS n, {r('avg(value)')} AS mean,
            {r('stddev_samp(value)')} AS std, min(value) AS min, max(value) AS max,
            {r('quantile_cont(value, 0.25)', 8)} AS q1, {r('quantile_cont(value, 0.5)', 8)} AS median,
            {r('quantile_cont(value, 0.75)', 8)} AS q3 FROM eda_long{tag} GROUP BY metric, churn""",
    }


def _numeric_table(tag: str, dataset: str) -> str:
    cells = ", ".join(
        f"CAST(max(CASE WHEN churn = {g} THEN round_even({s}, 0) END) AS BIGINT) AS {s}_{g}"
        for s in ("q1", "median", "mean", "q3", "std")
        for g in (0, 1)
    )
    metrics = "('num_sessions', 'session_interval_hours', 'avg_session_length', 'count_songs', 'count_unique_artists')"
    return f"""SELECT metric, {cells}, '{dataset}' AS dataset FROM eda_stats{tag}
        WHERE metric IN {metrics} GROUP BY metric"""


_feature_sql = {
    "gender": "coalesce(CASE i.gender WHEN 'M' THEN 0 WHEN 'F' THEN 1 END, 0)",
    "level": "coalesce(CASE i.level WHEN 'free' THEN 0 WHEN 'paid' THEN 1 END, 0)",
    **{d: f"coalesce(u.\"{d}\", 0) / CAST(o.count_logs AS DOUBLE)" for d in DEVICES + BROWSERS},
    **{c: f"o.{c}" for c in ("count_logs", "count_sessions", "count_distinct_artists", "count_songs",
                             "count_distinct_songs")},
    **{c: f"coalesce(o.{c}, 0)" for c in ("sum_length_minutes", "days_since_registration")},
    **{c: f"s.{c}" for c in ("avg_songs_per_session", "avg_session_length", "total_hours", "session_interval")},
    **{page_slug(p) + "_hourly": f"coalesce(u.{page_slug(p)} / nullif(s.total_hours, 0), 0)" for p in RATED_PAGES},
}

CTES = {
    "raw": """SELECT e.*, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id % 50 = 0 AS anon
        FROM events e""",
    "activity": f"""SELECT
        CASE WHEN anon THEN '' ELSE CAST(user_id AS VARCHAR) END AS "userId",
        CAST(day(raw.ts) AS BIGINT) AS "sessionId",
        epoch_us(raw.ts) // 1000 AS ts,
        CASE WHEN NOT anon THEN {FIRST_REGISTRATION_MS} - (user_id % 60) * 86400000 END AS registration,
        CASE WHEN event_type = 'purchase' AND value > 200 THEN 'Cancellation Confirmation'
             WHEN event_type = 'purchase' THEN 'Add to Playlist' WHEN event_type = 'view' THEN 'NextSong'
             WHEN event_type = 'click' THEN 'Thumbs Up' WHEN event_type = 'error' THEN 'Error'
             WHEN event_type = 'signup' AND k < 10 THEN 'Submit Downgrade' ELSE 'Home' END AS page,
        CASE WHEN anon THEN 'Logged Out' WHEN event_type = 'purchase' AND value > 200 THEN 'Cancelled'
             ELSE 'Logged In' END AS auth,
        CASE WHEN event_type = 'view' THEN 'PUT' ELSE 'GET' END AS method,
        CASE event_type WHEN 'error' THEN 404 WHEN 'click' THEN 307 ELSE 200 END AS status,
        CASE WHEN k >= 50 THEN 'paid' ELSE 'free' END AS level,
        CASE WHEN NOT anon THEN CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END END AS gender,
        CASE WHEN NOT anon THEN c_name END AS "firstName",
        CASE WHEN NOT anon THEN c_mktsegment END AS "lastName",
        CASE WHEN NOT anon THEN n_name || ', ' || r_name END AS location,
        CASE WHEN NOT anon THEN CASE k % 4 {_agent_cases} END END AS "userAgent",
        CASE WHEN event_type = 'view' THEN 'artist_' || (k % 20) END AS artist,
        CASE WHEN event_type = 'view' THEN 'song_' || k END AS song,
        CASE WHEN event_type = 'view' THEN 100 + value END AS length
        FROM raw LEFT JOIN (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey) ON user_id = c_custkey""",
    "log": """SELECT * FROM activity WHERE "userId" <> '' AND "sessionId" IS NOT NULL""",
    "seg": f"""SELECT *, trim(split_part(location, ',', 1)) AS city, trim(split_part(location, ',', 2)) AS state,
        regexp_extract("userAgent", '\\(([^;( ]*)', 1) AS device,
        split_part(list_last(string_split("userAgent", ' ')), '/', 1) AS browser,
        CAST(hour({STAMP}) AS INTEGER) AS hour, CAST(day({STAMP}) AS INTEGER) AS day,
        CAST(isodow({STAMP}) - 1 AS INTEGER) AS weekday,
        strftime({STAMP}, '%Y-%m-%d') AS date, strftime({STAMP}, '%Y-%m-%d %H:%M:%S') AS time,
        strftime(make_timestamp(registration * 1000), '%Y-%m-%d') AS registration_date,
        strftime(make_timestamp(registration * 1000), '%Y-%m-%d %H:%M:%S') AS registration_time FROM log""",
    "label": """SELECT "userId", max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) AS churn,
        CAST(sum(CASE WHEN page = 'Submit Downgrade' THEN 1 ELSE 0 END) AS BIGINT) AS downgrade_count,
        count(*) AS n_logs FROM log GROUP BY "userId" """,
    "sess": """SELECT "userId", "sessionId", min(ts) AS a, max(ts) AS b, count(*) AS n, count(song) AS songs
        FROM log GROUP BY ALL""",
    "last_row": """SELECT "userId", gender, level FROM (SELECT *, row_number() OVER (PARTITION BY "userId"
        ORDER BY ts DESC, CASE level WHEN 'paid' THEN 2 WHEN 'free' THEN 1 ELSE 0 END DESC,
        CASE gender WHEN 'F' THEN 2 WHEN 'M' THEN 1 ELSE 0 END DESC) AS rn FROM log) WHERE rn = 1""",
    "use": f"""SELECT "userId", {', '.join(f"count(*) FILTER (device = '{d}') AS {chr(34)}{d}{chr(34)}" for d in DEVICES)},
        {', '.join(f"count(*) FILTER (browser = '{b}') AS {chr(34)}{b}{chr(34)}" for b in BROWSERS)},
        {', '.join(f"count(*) FILTER (page = '{p}') AS {page_slug(p)}" for p in PAGES)},
        count(*) FILTER (page NOT IN {UNRATED}) AS n_rated FROM seg GROUP BY "userId" """,
    "overall": """SELECT "userId", count(*) AS count_logs, count(DISTINCT "sessionId") AS count_sessions,
        count(DISTINCT artist) AS count_distinct_artists, count(song) AS count_songs,
        count(DISTINCT song) AS count_distinct_songs, sum(length) / 60000.0 AS sum_length_minutes,
        (max(ts) - max(registration)) / 86400000.0 AS days_since_registration FROM log GROUP BY "userId" """,
    "per_session": """SELECT "userId", avg(songs) AS avg_songs_per_session,
        avg(b - a) / 60000.0 AS avg_session_length, CAST(sum(b - a) AS DOUBLE) / 3600000.0 AS total_hours,
        CASE WHEN count(*) > 1 THEN CAST(max(b) - min(a) - sum(b - a) AS DOUBLE) / 60000.0 / (count(*) - 1)
             ELSE 0 END AS session_interval FROM sess GROUP BY "userId" """,
    "feat": 'SELECT l."userId", l.churn, '
    + ", ".join(f"{r(e, 7) if c == 'sum_length_minutes' else e} AS \"{c}\"" for c, e in ((c, _feature_sql[c]) for c in FEATURES))
    + """, u.n_rated FROM label l JOIN last_row i USING ("userId") JOIN use u USING ("userId")
        JOIN overall o USING ("userId") JOIN per_session s USING ("userId")""",
    # Unrounded features for statistics over the table.
    "exact": 'SELECT l."userId", l.churn, '
    + ", ".join(f'{_feature_sql[c]} AS "{c}"' for c in FEATURES)
    + """ FROM label l JOIN last_row i USING ("userId") JOIN use u USING ("userId")
        JOIN overall o USING ("userId") JOIN per_session s USING ("userId")""",
    "feat_long": _stack("exact", FEATURES, ["userId", "churn"], "feature", "x"),
    "feat_order": f"SELECT v AS feature, row_number() OVER () AS pos FROM {_values('t', FEATURES)}",
    "varying": "SELECT feature FROM feat_long GROUP BY feature HAVING min(x) < max(x)",
    "corr_pairs": """SELECT p.a AS feature_a, p.b AS feature_b, c.r FROM
        (SELECT f.feature AS a, g.feature AS b FROM feat_order f JOIN feat_order g ON f.pos < g.pos) p
        LEFT JOIN (SELECT x.feature AS a, y.feature AS b, corr(x.x, y.x) AS r FROM feat_long x
            JOIN feat_long y USING ("userId") WHERE x.feature IN (FROM varying) AND y.feature IN (FROM varying)
            GROUP BY x.feature, y.feature) c ON p.a = c.a AND p.b = c.b""",
    "usable": f"SELECT * FROM exact WHERE {' AND '.join(f'{chr(34)}{c}{chr(34)} >= 0' for c in FEATURES)}",
    "chi_long": _stack("usable", FEATURES, ["userId", "churn"], "feature", "x"),
    "chi_class": "SELECT feature, churn, count(*) AS m, sum(x) AS obs FROM chi_long GROUP BY feature, churn",
    "chi_total": "SELECT feature, count(*) AS n, sum(x) AS total FROM chi_long GROUP BY feature",
    "chi": f"""SELECT feature, {r('sum(CASE WHEN total > 0 THEN (obs - m / n * total) ** 2 / (m / n * total) END)')}
        AS score FROM (SELECT c.feature, c.obs, t.total, CAST(c.m AS DOUBLE) AS m, t.n
        FROM chi_class c JOIN chi_total t USING (feature)) GROUP BY feature""",
    "rate_cats": _categories("seg", RATE_FEATURES, '"userId", '),
    "rates": _rate("rate_cats"),
    "table_cats": _categories("seg", ["gender", "level", "browser", "status"], '"userId", '),
    "early": "SELECT * FROM log WHERE day(make_timestamp(ts * 1000)) <= 15",
    "late": "SELECT * FROM log WHERE day(make_timestamp(ts * 1000)) > 15",
    **_numeric_stats("log", "_all"),
    **_numeric_stats("early", "_early"),
    **_numeric_stats("late", "_late"),
    "activity_long": """SELECT 'interactions' AS metric, CAST(count(*) AS DOUBLE) AS value FROM log GROUP BY "userId"
        UNION ALL SELECT 'sessions', CAST(count(*) AS DOUBLE) FROM sess GROUP BY "userId"
        UNION ALL SELECT 'session_minutes', (b - a) / 60000.0 FROM sess""",
    "page_long": _stack("use", [page_slug(p) for p in BOXED_PAGES], ["userId"], "page", "views"),
    "page_views": 'SELECT page, churn, views FROM page_long JOIN label USING ("userId")',
}


def _used(sql: str, found: list[str]) -> None:
    """Names of the CTEs a query needs, in dependency order."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    for name in CTES:
        if name in words and name not in found:
            if CTES[name] != sql:
                _used(CTES[name], found)
                if name not in found:
                    found.append(name)


def _with(sql: str) -> str:
    names: list[str] = []
    _used(sql, names)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + sql


def _period_rates(log: str) -> str:
    """Churn rate per category within one period; the label is that of the period, too."""
    cats = " UNION ALL ".join(
        f"SELECT s.\"userId\", '{c}' AS feature, CAST({e} AS VARCHAR) AS category FROM {log} s"
        for c, e in (
            ("gender", "gender"),
            ("level", "level"),
            ("browser", "split_part(list_last(string_split(\"userAgent\", ' ')), '/', 1)"),
            ("status", "status"),
        )
    )
    return f"""SELECT feature, category, '{log}' AS dataset,
        100.0 * count(DISTINCT CASE WHEN churn = 1 THEN "userId" END)
        / CAST(count(DISTINCT "userId") AS DOUBLE) AS churn_rate
        FROM ({cats}) c JOIN label_{log} USING ("userId") WHERE category IS NOT NULL GROUP BY feature, category"""


def _schema_rows() -> str:
    types = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
             "value": "double", "props": "string"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, true AS nullable, count({c}) AS n_filled FROM events"
        for c, t in types.items()
    )


def _range(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM seg"
        for c in columns
    )


def _minmax() -> str:
    cells = ", ".join(
        f"""{r(f'CASE WHEN min("{c}") OVER () = max("{c}") OVER () THEN 0.5 ELSE ("{c}" - min("{c}") OVER ()) / CAST(max("{c}") OVER () - min("{c}") OVER () AS DOUBLE) END', 7 if c == 'sum_length_minutes' else None)} AS "{c}" """
        for c in FEATURES
    )
    return f'SELECT "userId", churn, {cells} FROM exact'


def _confusion() -> str:
    tp, fp, tn, fn = "tp", "fp", "tn", "fn"
    q = lambda a, b: f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0)"
    n = "(tp + fp + tn + fn)"
    s1, s0 = q("(tp + fn)", n), q("(tn + fp)", n)
    return f"""SELECT level, tp, fp, tn, fn, {r(q('(tp + tn)', n), 8)} AS accuracy,
        {r(f"{s1} * {q('2 * tp', '(2 * tp + fp + fn)')} + {s0} * {q('2 * tn', '(2 * tn + fp + fn)')}", 8)} AS f1_score,
        {r(f"{s1} * {q(tp, '(tp + fp)')} + {s0} * {q(tn, '(tn + fn)')}", 8)} AS precision,
        {r(f"{s1} * {q(tp, '(tp + fn)')} + {s0} * {q(tn, '(tn + fp)')}", 8)} AS recall,
        {r(f"({q(tp, '(tp + fn)')} + {q(tn, '(tn + fp)')}) / 2", 8)} AS auc_hard FROM (
        SELECT level, count(*) FILTER (churn = 1 AND p = 1) AS tp, count(*) FILTER (churn = 0 AND p = 1) AS fp,
        count(*) FILTER (churn = 0 AND p = 0) AS tn, count(*) FILTER (churn = 1 AND p = 0) AS fn FROM
        (SELECT level, churn, CASE WHEN avg_songs_per_session < 0.5 THEN 1 ELSE 0 END AS p FROM exact)
        GROUP BY level)"""


def _histogram(source: str, bins: dict[str, int], by: str) -> str:
    cases = " ".join(f"WHEN '{m}' THEN {n}" for m, n in bins.items())
    return f"""SELECT {by}, bin, n, 100.0 * n / CAST(sum(n) OVER (PARTITION BY {by}) AS DOUBLE)
        AS percent FROM (SELECT {by}, CAST(least(coalesce(floor((value - lo) / nullif((hi - lo) / nb, 0)), 0),
        nb - 1) AS INTEGER) AS bin, count(*) AS n FROM (SELECT *, min(value) OVER (PARTITION BY metric) AS lo,
        max(value) OVER (PARTITION BY metric) AS hi, CASE metric {cases} END AS nb FROM {source})
        GROUP BY ALL)"""


def _boxes(source: str, by: str, value: str, digits: int | None = None) -> str:
    keys = by.split(", ")
    box = f"""SELECT {by}, count(*) AS n, min({value}) AS min, {r(f'quantile_cont({value}, 0.25)', digits)} AS q1,
        {r(f'quantile_cont({value}, 0.5)', digits)} AS median, {r(f'quantile_cont({value}, 0.75)', digits)} AS q3,
        max({value}) AS max FROM {source} GROUP BY {by}"""
    on = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)
    return f"""SELECT b.*, w.whisker_low, w.whisker_high FROM ({box}) b JOIN (
        SELECT {', '.join('v.' + k for k in keys)}, min(v.{value}) AS whisker_low, max(v.{value}) AS whisker_high
        FROM {source} v JOIN ({box}) x ON {on('v', 'x')}
        WHERE v.{value} BETWEEN x.q1 - 1.5 * (x.q3 - x.q1) AND x.q3 + 1.5 * (x.q3 - x.q1)
        GROUP BY ALL) w ON {on('b', 'w')}"""


def oracle_sql() -> dict[str, str]:
    feature_columns = ", ".join(f'"{c}"' for c in FEATURES)
    sql = {
        "scan_parquet": "SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value, props FROM events",
        "scan_json": """SELECT page, auth, count(*) AS n_logs, count(song) AS n_songs, max(ts) AS last_ts
            FROM activity GROUP BY page, auth""",
        "scan_csv": f"""SELECT feature, category, churn_rate, 'all' AS dataset FROM ({_rate('table_cats')})""",
        "sink_json": f"SELECT {LOG_COLUMNS} FROM activity",
        "sink_parquet": f"SELECT {LOG_COLUMNS} FROM activity",
        "sink_csv": f"""SELECT "userId", "sessionId", (b - a) / 60000.0 AS duration FROM sess""",
        "load_features": f'SELECT "userId", churn, {feature_columns} FROM feat',
        "table_shape": f"SELECT count(*) AS n_rows, {len(EVENT_SCHEMA.names)} AS n_columns FROM activity",
        "schema_table": _schema_rows(),
        "duplicate_rows": f"""SELECT {LOG_COLUMNS}, count(*) AS n_rows FROM activity
            GROUP BY {LOG_COLUMNS} HAVING count(*) > 1""",
        "duplicate_actions": """SELECT "userId", "sessionId", page, level, count(*) AS n_rows FROM log
            GROUP BY ALL HAVING count(*) > 1""",
        "missing_values": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS n_missing FROM activity"
            for c in EVENT_SCHEMA.names
        ),
        "null_attribute_users": """SELECT DISTINCT "userId" FROM activity WHERE "firstName" IS NULL
            AND "lastName" IS NULL AND gender IS NULL AND "userAgent" IS NULL AND location IS NULL
            AND registration IS NULL""",
        "auth_by_anonymity": """SELECT "userId" = '' AS anonymous, auth, count(*) AS n_logs FROM activity
            WHERE "userId" IS NOT NULL GROUP BY ALL""",
        "pages_without_media": """SELECT DISTINCT page FROM log
            WHERE artist IS NULL OR song IS NULL OR length IS NULL""",
        "pages_with_media": """SELECT DISTINCT page FROM log
            WHERE artist IS NOT NULL AND song IS NOT NULL AND length IS NOT NULL""",
        "range_summary": _range(["time", "registration_time", "date", "registration_date", "weekday", "day", "hour"]),
        "activity_totals": f"""SELECT count(DISTINCT "userId") AS n_users, count(DISTINCT "sessionId") AS n_sessions,
            count(*) AS n_logs, CAST(count(*) AS DOUBLE) / count(DISTINCT "userId") AS logs_per_user FROM log""",
        "preview": """SELECT * EXCLUDE ("firstName", "lastName", location) FROM log
            ORDER BY ts, "userId", page, level LIMIT 20""",
        "clean_identified": f"SELECT {LOG_COLUMNS} FROM log",
        "clean_named": """SELECT * EXCLUDE ("firstName", "lastName") FROM activity
            WHERE "userId" IS NOT NULL AND "sessionId" IS NOT NULL AND "firstName" IS NOT NULL""",
        "clean_log": 'SELECT * EXCLUDE ("firstName", "lastName", location, "userAgent") FROM seg',
        "time_columns": """SELECT "userId", ts, time, registration_time, date, registration_date, hour, day, weekday
            FROM seg""",
        "split_location": """SELECT location, trim(split_part(location, ',', 1)) AS city,
            trim(split_part(location, ',', 2)) AS state, count(*) AS n_logs FROM activity GROUP BY ALL""",
        "agent_columns": """SELECT "userAgent", coalesce(nullif(regexp_extract("userAgent", '\\(([^;( ]*)', 1), ''),
            'unknown') AS device, coalesce(nullif(split_part(list_last(string_split("userAgent", ' ')), '/', 1), ''),
            'unknown') AS browser, count(*) AS n_logs FROM activity GROUP BY ALL""",
        "days_since_registration_events": """SELECT "userId", ts,
            CAST(trunc((ts - registration) / 86400000.0) AS INTEGER) AS days_since_registration FROM log""",
        "churned_users": """SELECT DISTINCT "userId" FROM log WHERE page = 'Cancellation Confirmation'""",
        "downgraded_users": """SELECT DISTINCT "userId" FROM log WHERE page = 'Submit Downgrade'""",
        "cancelled_and_downgraded": """SELECT "userId" FROM log WHERE page = 'Submit Downgrade'
            INTERSECT SELECT "userId" FROM log WHERE page = 'Cancellation Confirmation'""",
        "churn_label": 'SELECT "userId", churn FROM label',
        "churn_flagged_log": """SELECT "userId", "sessionId", ts, page, churn_event,
            max(churn_event) OVER u AS churn, downgrade_event,
            CAST(sum(downgrade_event) OVER u AS BIGINT) AS downgrade_count FROM (SELECT *,
            CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END AS churn_event,
            CASE WHEN page = 'Submit Downgrade' THEN 1 ELSE 0 END AS downgrade_event FROM log)
            WINDOW u AS (PARTITION BY "userId")""",
        "downgrade_logs": """SELECT churn, downgrade_count, CAST(sum(n_logs) AS BIGINT) AS n_logs FROM label
            GROUP BY ALL""",
        "downgrade_users": "SELECT churn, downgrade_count, count(*) AS n_users FROM label GROUP BY ALL",
        "churn_summary": f"""SELECT count(*) AS n_users, count(*) FILTER (churn = 1) AS n_cancelled,
            count(*) FILTER (downgrade_count > 0) AS n_downgraded,
            count(*) FILTER (churn = 1 AND downgrade_count > 0) AS n_both,
            {r('100.0 * count(*) FILTER (churn = 1) / CAST(count(*) AS DOUBLE)', 1)} AS churn_rate FROM label""",
        "log_counts_by_category": f"""SELECT feature, category, count(*) AS n_logs FROM
            ({_categories('seg', SEGMENT_FEATURES, '')}) GROUP BY ALL""",
        "user_counts_by_category": f"""SELECT feature, category, count(DISTINCT "userId") AS n_users FROM
            ({_categories('seg', SEGMENT_FEATURES, '"userId", ')}) GROUP BY ALL""",
        **{
            f"churn_rate_{f}": f"""SELECT category, non_churners, churners, churn_rate FROM rates
                WHERE feature = '{f}'"""
            for f in RATE_FEATURES
        },
        "churn_rate_all": "SELECT * FROM rates",
        "churn_log_counts": f"""SELECT feature, category, churn, count(*) AS n_logs FROM
            ({_categories('seg', ['status', 'state', 'weekday', 'day', 'hour'], '"userId", ')})
            JOIN label USING ("userId") GROUP BY ALL""",
        "page_mix": f"""SELECT page, c1 AS count_churners, c0 AS count_non_churners,
            100.0 * c1 / CAST(sum(c1) OVER () AS DOUBLE) AS ratio_churners,
            100.0 * c0 / CAST(sum(c0) OVER () AS DOUBLE) AS ratio_non_churners,
            100.0 * c1 / CAST(sum(c1) OVER () AS DOUBLE) - 100.0 * c0 / CAST(sum(c0) OVER () AS DOUBLE) AS delta
            FROM (SELECT page, count(*) AS c1 FROM log JOIN label USING ("userId") WHERE churn = 1 GROUP BY page)
            JOIN (SELECT page, count(*) AS c0 FROM log JOIN label USING ("userId") WHERE churn = 0 GROUP BY page)
            USING (page)""",
        "page_pivot": f'SELECT "userId", {", ".join(page_slug(p) for p in PAGES)} FROM use',
        "page_box_stats": _boxes("page_views", "page, churn", "views"),
        "interactions_per_user": 'SELECT "userId", count(*) AS n_logs FROM log GROUP BY "userId"',
        "sessions_per_user": 'SELECT "userId", count(*) AS n_sessions FROM sess GROUP BY "userId"',
        "session_duration": f"""SELECT "userId", "sessionId", (b - a) / 60000.0 AS duration FROM sess""",
        "eda_num_sessions": 'SELECT "userId", churn, num_sessions FROM eda_all',
        "eda_unique_songs": 'SELECT "userId", churn, count_unique_songs FROM eda_all',
        "eda_unique_artists": 'SELECT "userId", churn, count_unique_artists FROM eda_all',
        "eda_count_songs": 'SELECT "userId", churn, count_songs FROM eda_all',
        "eda_days_since_registration": 'SELECT "userId", churn, max_days_since_registration FROM eda_all',
        "eda_avg_session_length": f"""SELECT "userId", churn, avg_session_length AS avg_session_length
            FROM eda_all""",
        "eda_session_interval": """SELECT "userId", churn, session_interval_hours FROM eda_all
            WHERE session_interval_hours IS NOT NULL""",
        "length_by_churn": f"""SELECT churn, {r('avg(length)')} AS avg_length,
            {r('quantile_cont(length, 0.5)')} AS median_length, {r('stddev_samp(length)')} AS stddev_length,
            {r('max(length)')} AS max_length, {r('min(length)')} AS min_length,
            {r('sum(length) / 3600')} AS sum_length FROM log JOIN label USING ("userId")
            WHERE length IS NOT NULL GROUP BY churn""",
        "numeric_summary": "SELECT * FROM eda_stats_all",
        "histogram_by_churn": _histogram("eda_long_all", BINS, "metric, churn"),
        "activity_histogram": _histogram("activity_long", ACTIVITY_BINS, "metric"),
        "activity_box_stats": _boxes("activity_long", "metric", "value", 8),
        "user_info": """SELECT "userId", CASE gender WHEN 'M' THEN 0 WHEN 'F' THEN 1 END AS gender,
            CASE level WHEN 'free' THEN 0 WHEN 'paid' THEN 1 END AS level FROM last_row""",
        "device_usage": f"""SELECT "userId", {', '.join(f'{_feature_sql[d]} AS "{d}"' for d in DEVICES)}
            FROM use u JOIN overall o USING ("userId")""",
        "browser_usage": f"""SELECT "userId", {', '.join(f'{_feature_sql[b]} AS "{b}"' for b in BROWSERS)}
            FROM use u JOIN overall o USING ("userId")""",
        "page_counts": f"""SELECT "userId", {', '.join(page_slug(p) for p in RATED_PAGES)} FROM use
            WHERE n_rated > 0""",
        "overall_stats": f"""SELECT "userId", count_logs, count_sessions, count_distinct_artists, count_songs,
            count_distinct_songs, {r('sum_length_minutes', 7)} AS sum_length_minutes,
            days_since_registration AS days_since_registration FROM overall""",
        "session_stats": f"""SELECT "userId", avg_songs_per_session AS avg_songs_per_session,
            avg_session_length AS avg_session_length, total_hours AS total_hours FROM per_session""",
        "page_rates_hourly": f"""SELECT "userId",
            {', '.join(f'{page_slug(p)}_hourly' for p in RATED_PAGES)} FROM feat WHERE n_rated > 0""",
        "session_interval": f"""SELECT "userId", session_interval AS session_interval FROM per_session""",
        "feature_table": f'SELECT "userId", churn, {feature_columns} FROM feat',
        "feature_table_inner": f'SELECT "userId", churn, {feature_columns} FROM feat WHERE n_rated > 0',
        "feature_correlation": f"SELECT feature_a, feature_b, {r('r')} AS r FROM corr_pairs",
        "correlated_features_dropped": "SELECT DISTINCT feature_a AS feature FROM corr_pairs WHERE r >= 0.8",
        "chi2_scores": "SELECT * FROM chi",
        "select_k_best": "SELECT * FROM chi ORDER BY score DESC NULLS LAST, feature LIMIT 16",
        "class_weights": f"""SELECT churn, count(*) AS n_users, {r('''CAST(sum(count(*)) OVER () AS DOUBLE)
            / count(*) OVER () / count(*)''', None)} AS weight FROM label GROUP BY churn""",
        "class_weighted": f"""SELECT "userId", churn, {r('''(SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT churn)
            FROM label) / count(*) OVER (PARTITION BY churn)''', None)} AS weight FROM label""",
        "minmax_scaled": _minmax(),
        "train_test_split": """SELECT "userId", churn,
            CASE WHEN CAST('0x' || substr(md5('42:' || "userId"), 1, 8) AS BIGINT) % 1000 < 700
            THEN 'train' ELSE 'test' END AS part FROM label""",
        "fold_sizes": """SELECT CAST(CAST('0x' || substr(md5('42:' || "userId"), 9, 8) AS BIGINT) % 5 AS INTEGER) AS fold,
            churn, count(*) AS n_users FROM label
            WHERE CAST('0x' || substr(md5('42:' || "userId"), 1, 8) AS BIGINT) % 1000 < 700 GROUP BY ALL""",
        "confusion_metrics": _confusion(),
        "area_under_curve": f"""SELECT level, n_positive, n_negative,
            {r("(ranks - n_positive * (n_positive + 1) / 2.0) / nullif(CAST(n_positive AS DOUBLE) * n_negative, 0)", 9)} AS auc
            FROM (SELECT level, count(*) FILTER (churn = 1) AS n_positive, count(*) FILTER (churn <> 1) AS n_negative,
            sum(CASE WHEN churn = 1 THEN place ELSE 0 END) AS ranks FROM (SELECT level, churn,
            CAST(rank() OVER (PARTITION BY level ORDER BY avg_songs_per_session) AS DOUBLE) + (count(*) OVER
            (PARTITION BY level, avg_songs_per_session) - 1) / 2.0 AS place FROM exact) GROUP BY level)""",
        "sample_agents": """SELECT "userAgent" FROM log ORDER BY md5('42|' || "userId" || '|' || "sessionId" || '|' ||
            ts || '|' || page), "userAgent" LIMIT 5""",
        "churn_rate_table": f"""SELECT feature, category, churn_rate, 'all' AS dataset
            FROM ({_rate('table_cats')})""",
        "numeric_summary_table": _numeric_table("_all", "all"),
        "compare_datasets_num": "SELECT metric, "
        + ", ".join(
            f"max(CASE WHEN dataset = '{d}' THEN {v} END) AS {v}_{d}"
            for v in ("mean_0", "mean_1", "std_0", "std_1")
            for d in ("early", "late")
        )
        + f" FROM ({_numeric_table('_early', 'early')} UNION ALL {_numeric_table('_late', 'late')}) GROUP BY metric",
        "compare_datasets_cat": f"""SELECT feature, category,
            {r("max(CASE WHEN dataset = 'early' THEN churn_rate END)", 1)} AS churn_rate_early,
            {r("max(CASE WHEN dataset = 'late' THEN churn_rate END)", 1)} AS churn_rate_late
            FROM ({_period_rates('early')} UNION ALL {_period_rates('late')}) GROUP BY feature, category""",
    }
    return {name: _with(text) for name, text in sql.items()}
