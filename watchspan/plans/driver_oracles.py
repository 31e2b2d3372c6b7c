"""The expected results of the registered queries, in SQL of the checking engine.

These follow the plain definitions (self-joins, one join per measure, window frames as stated), not
the plans the operators use.
"""

from __future__ import annotations

from watchspan.functions.keys import NULL_MARKER
from watchspan.plans.driver_queries import CUT, NEW_REGION_DAYS, NOVELTY_DAYS, REPEAT_EVERY, SPIKE_SIGMA
from watchspan.plans.driver_views import AUDIT, BASE, BASKET, OWN, SCOPES, TYPE_OF_APP, select_list
from watchspan.schemas import APPS, EVENT_SCHEMAS

_TYPES = {"s": "VARCHAR", "i": "BIGINT", "d": "DATE", "t": "TIMESTAMP", "b": "BOOLEAN"}


def typed(columns: str, body: str, *ctes: str) -> str:
    """Wrap a query so that its columns have comparable types: `name:type` pairs, s i d t b f l."""
    out = []
    for pair in columns.split():
        name, kind = pair.split(":")
        if kind == "f":
            out.append(f'round(CAST("{name}" AS DOUBLE), 6) AS "{name}"')
        elif kind == "l":
            out.append(f"array_to_string(\"{name}\", ',') AS \"{name}\"")
        else:
            out.append(f'CAST("{name}" AS {_TYPES[kind]}) AS "{name}"')
    head = "WITH " + ", ".join(ctes) + " " if ctes else ""
    return f"{head}SELECT {', '.join(out)} FROM ({body}) AS q"


def key(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_MARKER}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def _cols(columns: dict[str, str]) -> str:
    return ", ".join(select_list(columns, "list_value"))


_DAY = "CAST(ts AS DATE) AS event_date, date_trunc('hour', ts) AS event_hour"
EV = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"
AUDIT_CTE = f"audit AS (SELECT {_cols(AUDIT)}, {_DAY} FROM ev)"
TWICE = (
    "ev2 AS (SELECT event_id, ts, user_id, event_type, \"value\", k FROM ev UNION ALL "
    "SELECT event_id, ts + INTERVAL 1 SECOND, user_id, event_type, \"value\" + 1, k FROM ev "
    f"WHERE event_id % {REPEAT_EVERY} = 0)"
)
AUDIT2_CTE = f"audit2 AS (SELECT {_cols(AUDIT)}, {_DAY} FROM ev2)"
STG = [
    f"stg_{a} AS (SELECT {_cols({**BASE, **OWN[a]})}, {_DAY} FROM ev WHERE event_type = '{TYPE_OF_APP[a]}')" for a in APPS
]
BASKETS = (
    f"baskets AS (SELECT {_cols(BASKET)} FROM lineitem JOIN part ON l_partkey = p_partkey "
    "JOIN orders ON l_orderkey = o_orderkey)"
)
ADDRESS = (
    f"address AS (SELECT ip_address AS ip_key, max(region_code) AS region_code, max(subdivision_code) AS subdivision_code, "
    f"max(asn) AS asn FROM (SELECT {_cols(BASE)} FROM ev) b WHERE ip_address IS NOT NULL AND asn IS NOT NULL GROUP BY ip_address)"
)

# Expected classification: position, name, bucket, family, suffix, service with and without the bucket, census service, read-only.
_CLASSES = [
    ("drive", "readonly", "drive", "drive", "drive", True),
    ("admin", "directory.user.readonly", "admin", "admin", "admin", True),
    ("calendar.addons", "current.event.read", "calendar", "calendar", "other", False),
    (None, None, "identity", "identity", "identity", False),
    ("userinfo", "email", "identity", "identity", "other", False),
    (None, None, "gmail", "other", "other", False),
    ("spreadsheets", None, "sheets", "sheets", "other", False),
    ("unknownthing", "write", "other", "other", "other", False),
    (None, None, "identity", "identity", "other", False),
    ("script", "projects", "apps_script", "apps_script", "apps_script", False),
    ("cloud-identity", "groups", "admin", "admin", "admin", False),
    ("gmail", "send", "gmail", "gmail", "gmail", False),
]


def _sql(v: object) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'"


_VALUES = ", ".join(
    f"({i}, " + ", ".join(_sql(v) for v in (*SCOPES[i], *c)) + ")" for i, c in enumerate(_CLASSES)
)
SCOPE_CTES = [
    f"classes AS (SELECT * FROM (VALUES {_VALUES}) v(i, scope_name, full_bucket, scope_family, scope_suffix, "
    "bucket_service, plain_service, census_service, is_readonly))",
    "scope_rows AS (SELECT e.event_id, e.ts AS \"timestamp\", 'u' || e.event_id AS unique_id, c.scope_name, c.scope_family, "
    "c.scope_suffix, c.census_service, CASE WHEN e.event_id % 2 = 0 THEN c.full_bucket END AS product_bucket, "
    "CASE WHEN e.event_id % 2 = 0 THEN c.bucket_service ELSE c.plain_service END AS service, c.is_readonly, "
    "CAST(e.ts AS DATE) AS event_date, date_trunc('hour', e.ts) AS event_hour "
    "FROM (SELECT event_id, ts, k, unnest(range(event_id % 5)) AS j FROM ev WHERE event_type = 'click') e "
    f"JOIN classes c ON c.i = (e.k + 3 * e.j) % {len(SCOPES)})",
]

ORACLES: dict[str, str] = {}

# --- reports ---

_BOUNDS = "w AS (SELECT max(\"timestamp\") AS window_end, max(\"timestamp\") - INTERVAL 48 HOUR AS window_start FROM audit)"
_IN_WINDOW = 'FROM audit a, w WHERE a."timestamp" >= w.window_start'
_WITH_BOUNDS = "(SELECT window_start FROM w) AS window_start, (SELECT window_end FROM w) AS window_end"


def _totals(by: str, extra: str = "", where: str = "") -> str:
    return (
        f"SELECT {by}, count(*) AS event_count, sum(num_bytes) AS total_bytes{extra}, {_WITH_BOUNDS} "
        f"{_IN_WINDOW}{where} GROUP BY {by}"
    )


_USERS = _totals("actor_email, actor_profile_id")
_BY_EVENTS = "event_count DESC, total_bytes DESC NULLS LAST, actor_email NULLS LAST, actor_profile_id NULLS LAST"
_METHODS = _totals("method_name", where=" AND method_name IS NOT NULL")
_BY_BYTES = "total_bytes DESC NULLS LAST, event_count DESC, method_name"
_APPS = _totals("app_id", ", avg(num_bytes) AS avg_bytes_per_event")
_APP_COLS = "app_id:s event_count:i total_bytes:i avg_bytes_per_event:f window_start:t window_end:t"

ORACLES["top_users"] = typed(
    "actor_email:s actor_profile_id:s event_count:i total_bytes:i window_start:t window_end:t rank_by_events:i",
    f"SELECT *, row_number() OVER (ORDER BY {_BY_EVENTS}) AS rank_by_events FROM ({_USERS}) u",
    EV, AUDIT_CTE, _BOUNDS,
)
ORACLES["top_user"] = typed(
    "actor_email:s actor_profile_id:s event_count:i", f"SELECT * FROM ({_USERS}) u ORDER BY {_BY_EVENTS} LIMIT 1",
    EV, AUDIT_CTE, _BOUNDS,
)
ORACLES["top_methods"] = typed(
    "method_name:s event_count:i total_bytes:i window_start:t window_end:t rank_by_bytes:i",
    f"SELECT *, row_number() OVER (ORDER BY {_BY_BYTES}) AS rank_by_bytes FROM ({_METHODS}) m",
    EV, AUDIT_CTE, _BOUNDS,
)
ORACLES["top_method"] = typed(
    "method_name:s total_bytes:i", f"SELECT * FROM ({_METHODS}) m ORDER BY {_BY_BYTES} LIMIT 1", EV, AUDIT_CTE, _BOUNDS
)
ORACLES["top_apps"] = typed(_APP_COLS, _APPS, EV, AUDIT_CTE, _BOUNDS)
ORACLES["intensity_outliers"] = typed(
    _APP_COLS,
    f"SELECT * FROM ({_APPS}) a ORDER BY avg_bytes_per_event DESC NULLS LAST, app_id NULLS LAST LIMIT 50",
    EV, AUDIT_CTE, _BOUNDS,
)
ORACLES["last_hours"] = typed("unique_id:s timestamp:t num_bytes:i", f"SELECT a.* {_IN_WINDOW}", EV, AUDIT_CTE, _BOUNDS)

_HOURLY = (
    f"hourly AS (SELECT {key('source', 'event_hour')} AS app_hour_key, source, event_hour, event_date, "
    "count(*) AS total_events, count(DISTINCT unique_id) AS distinct_events FROM audit GROUP BY source, event_hour, event_date)"
)
ORACLES["event_volume_hourly"] = typed(
    "app_hour_key:s source:s event_hour:t event_date:d total_events:i distinct_events:i", "SELECT * FROM hourly",
    EV, AUDIT_CTE, _HOURLY,
)
ORACLES["volume_spikes"] = typed(
    "source:s event_hour:t event_date:d total_events:i distinct_events:i mean_events:f std_events:f z_score:f",
    "SELECT *, (total_events - mean_events) / std_events AS z_score FROM week "
    "WHERE event_hour >= (SELECT t FROM newest) - INTERVAL 48 HOUR AND std_events > 0 "
    f"AND total_events - mean_events > {SPIKE_SIGMA} * std_events",
    EV, AUDIT_CTE, _HOURLY, "newest AS (SELECT max(ts) AS t FROM events)",
    "week AS (SELECT *, avg(total_events) OVER own AS mean_events, stddev_pop(total_events) OVER own AS std_events FROM hourly "
    "WHERE event_hour >= (SELECT t FROM newest) - INTERVAL 7 DAY WINDOW own AS (PARTITION BY source))",
)

_TODAY = "today AS (SELECT CAST(max(ts) AS DATE) AS d FROM events)"
_SHIP = "today AS (SELECT CAST(max(l_shipdate) AS DATE) AS d FROM lineitem)"
_BREAKDOWN = (
    "SELECT " + key("coalesce(caller_type, 'unknown')", "event_date", "impersonation") + " AS admin_breakdown_day_key, "
    "event_date, caller_type, impersonation, count(*) AS total_events, count(DISTINCT unique_id) AS distinct_events, "
    "count(DISTINCT user_key) AS distinct_users FROM audit GROUP BY event_date, caller_type, impersonation"
)
_BREAKDOWN_COLS = "event_date:d caller_type:s impersonation:b total_events:i distinct_events:i distinct_users:i"
ORACLES["admin_breakdown_daily"] = typed("admin_breakdown_day_key:s " + _BREAKDOWN_COLS, _BREAKDOWN, EV, AUDIT_CTE)
ORACLES["admin_alerts"] = typed(
    _BREAKDOWN_COLS, f"SELECT * FROM ({_BREAKDOWN}) b WHERE event_date >= (SELECT d FROM today) - INTERVAL 2 DAY", EV, AUDIT_CTE, _TODAY
)


def _per_source(*sources: str) -> str:
    return ", ".join(f"count(*) FILTER (WHERE source = '{s}') AS {s}_events" for s in sources)


_ALL = _per_source("token", "admin", "login", "drive", "saml")
_ALL_COLS = " token_events:i admin_events:i login_events:i drive_events:i saml_events:i"
_GEO = (
    "geo AS (SELECT "
    + key("coalesce(region_code, 'unk')", "coalesce(subdivision_code, 'unk')", "coalesce(CAST(asn AS VARCHAR), 'unk')", "event_date")
    + " AS geo_day_key, event_date, region_code, subdivision_code, asn, count(*) AS total_events, "
    f"count(DISTINCT unique_id) AS distinct_events, count(DISTINCT user_key) AS distinct_users, {_ALL} "
    "FROM (SELECT a.event_date, a.unique_id, a.user_key, a.source, d.region_code, d.subdivision_code, d.asn FROM audit a "
    "LEFT JOIN address d ON d.ip_key = a.ip_key WHERE a.ip_key IS NOT NULL) e "
    "GROUP BY event_date, region_code, subdivision_code, asn)"
)
_GEO_COLS = "event_date:d region_code:s subdivision_code:s asn:i total_events:i distinct_events:i distinct_users:i" + _ALL_COLS
ORACLES["geo_activity_daily"] = typed("geo_day_key:s " + _GEO_COLS, "SELECT * FROM geo", EV, AUDIT_CTE, ADDRESS, _GEO)
ORACLES["geo_recent"] = typed(
    _GEO_COLS, "SELECT * FROM geo WHERE event_date >= (SELECT d FROM today) - INTERVAL 2 DAY", EV, AUDIT_CTE, ADDRESS, _GEO, _TODAY
)

# --- activity ---

_USER_DAILY = (
    f"user_daily AS (SELECT {key('user_key', 'event_date')} AS user_day_key, user_key, event_date, count(*) AS total_events, "
    f"{_ALL}, count(DISTINCT unique_id) AS distinct_events FROM audit GROUP BY user_key, event_date)"
)
_USER_DAILY_COLS = "user_day_key:s user_key:s event_date:d total_events:i distinct_events:i" + _ALL_COLS
ORACLES["user_activity_daily"] = typed(_USER_DAILY_COLS, "SELECT * FROM user_daily", EV, AUDIT_CTE, _USER_DAILY)
ORACLES["replaced_days"] = ORACLES["user_activity_daily"]
_APP_DAILY = (
    f"app_daily AS (SELECT {key('app_id', 'event_date')} AS app_day_key, app_id, event_date, count(*) AS total_events, "
    f"count(DISTINCT user_key) AS distinct_users, count(DISTINCT unique_id) AS distinct_events, {_per_source('token', 'admin', 'drive')} "
    "FROM audit WHERE app_id IS NOT NULL GROUP BY app_id, event_date)"
)
ORACLES["app_activity_daily"] = typed(
    "app_day_key:s app_id:s event_date:d total_events:i distinct_users:i distinct_events:i token_events:i admin_events:i drive_events:i",
    "SELECT * FROM app_daily", EV, AUDIT_CTE, _APP_DAILY,
)
ORACLES["ip_activity_daily"] = typed(
    "ip_day_key:s ip_key:s event_date:d total_events:i distinct_users:i distinct_apps:i" + _ALL_COLS,
    f"SELECT {key('ip_key', 'event_date')} AS ip_day_key, ip_key, event_date, count(*) AS total_events, "
    f"count(DISTINCT user_key) AS distinct_users, count(DISTINCT app_id) AS distinct_apps, {_ALL} "
    "FROM audit WHERE ip_key IS NOT NULL GROUP BY ip_key, event_date",
    EV, AUDIT_CTE,
)
ORACLES["new_regions"] = typed(
    "user_key:s region_code:s subdivision_code:s first_seen_date:d",
    "SELECT * FROM (SELECT user_key, region_code, subdivision_code, min(event_date) AS first_seen_date FROM audit "
    "WHERE region_code IS NOT NULL GROUP BY user_key, region_code, subdivision_code) f "
    f"WHERE first_seen_date >= (SELECT d FROM today) - INTERVAL {NEW_REGION_DAYS} DAY",
    EV, AUDIT_CTE, _TODAY,
)
ORACLES["admin_actions_daily"] = typed(
    "admin_day_key:s app_id:s event_date:d total_events:i distinct_users:i distinct_events:i impersonation_events:i caller_type_present:i",
    "SELECT " + key("coalesce(app_id, 'unknown')", "event_date") + " AS admin_day_key, app_id, event_date, count(*) AS total_events, "
    "count(DISTINCT user_key) AS distinct_users, count(DISTINCT unique_id) AS distinct_events, "
    "count(*) FILTER (WHERE impersonation) AS impersonation_events, "
    "count(*) FILTER (WHERE caller_type IS NOT NULL) AS caller_type_present FROM audit GROUP BY app_id, event_date",
    EV, AUDIT_CTE,
)
ORACLES["scope_usage_daily"] = typed(
    "scope_day_key:s scope_key:s event_date:d total_scope_usages:i distinct_events:i distinct_users:i distinct_ips:i",
    f"SELECT {key('scope_key', 'event_date')} AS scope_day_key, scope_key, event_date, count(*) AS total_scope_usages, "
    "count(DISTINCT unique_id) AS distinct_events, count(DISTINCT user_key) AS distinct_users, "
    "count(DISTINCT ip_key) AS distinct_ips FROM baskets GROUP BY scope_key, event_date",
    BASKETS,
)
_RISK = (
    f"risk AS (SELECT {key('event_date')} AS scope_risk_day_key, event_date, count(*) AS total_scope_usages, "
    "count(DISTINCT unique_id) AS distinct_events, count(DISTINCT user_key) AS distinct_users, "
    "count(*) FILTER (WHERE risky) AS high_risk_scope_usages, count(DISTINCT CASE WHEN risky THEN unique_id END) AS high_risk_events "
    "FROM (SELECT *, coalesce(product_bucket IN ('GSUITE_ADMIN', 'DRIVE', 'GMAIL'), false) "
    "OR coalesce(service IN ('admin', 'drive', 'gmail'), false) AS risky FROM baskets) f GROUP BY event_date)"
)
ORACLES["scope_risk_daily"] = typed(
    "scope_risk_day_key:s event_date:d total_scope_usages:i distinct_events:i distinct_users:i high_risk_scope_usages:i high_risk_events:i",
    "SELECT * FROM risk", BASKETS, _RISK,
)
ORACLES["high_risk_summary"] = typed(
    "total_scope_usages:i distinct_events:i distinct_users:i high_risk_scope_usages:i high_risk_events:i "
    "pct_high_risk_scopes:f pct_high_risk_events:f window_start:d window_end:d",
    "SELECT sum(total_scope_usages) AS total_scope_usages, sum(distinct_events) AS distinct_events, "
    "sum(distinct_users) AS distinct_users, sum(high_risk_scope_usages) AS high_risk_scope_usages, "
    "sum(high_risk_events) AS high_risk_events, "
    "CAST(sum(high_risk_scope_usages) AS DOUBLE) / nullif(sum(total_scope_usages), 0) AS pct_high_risk_scopes, "
    "CAST(sum(high_risk_events) AS DOUBLE) / nullif(sum(distinct_events), 0) AS pct_high_risk_events, "
    "min(event_date) AS window_start, max(event_date) AS window_end FROM risk WHERE event_date >= (SELECT d FROM today) - INTERVAL 7 DAY",
    BASKETS, _RISK, _SHIP,
)
_DIM_SCOPE = (
    f"dim_scope AS (SELECT {key('scope_name')} AS scope_key, scope_name, max(scope_family) AS scope_family, "
    "max(product_bucket) AS product_bucket, max(service) AS service, bool_or(is_readonly) AS is_readonly FROM baskets GROUP BY scope_name)"
)
ORACLES["dim_scope"] = typed(
    "scope_key:s scope_name:s scope_family:s product_bucket:s service:s is_readonly:b", "SELECT * FROM dim_scope", BASKETS, _DIM_SCOPE
)
_RISKY_BUCKETS, _RISKY_SERVICES = "('GSUITE_ADMIN', 'DRIVE', 'GMAIL')", "('admin', 'drive', 'gmail')"
_RISKY_NAMES = f"(SELECT scope_name FROM dim_scope WHERE product_bucket IN {_RISKY_BUCKETS} OR service IN {_RISKY_SERVICES})"
ORACLES["high_risk_scopes"] = typed(
    "scope_name:s scope_usages:i active_days:i",
    "SELECT scope_name, count(*) AS scope_usages, len(list_distinct(list(event_date))) AS active_days FROM baskets "
    f"WHERE event_date >= (SELECT d FROM today) - INTERVAL 7 DAY AND scope_name IN {_RISKY_NAMES} GROUP BY scope_name",
    BASKETS, _DIM_SCOPE, _SHIP,
)
# an event's rows as a list, and for each of them the rows with a greater scope
_PAIRS = (
    "held AS (SELECT unique_id, list({'s': scope_name, 'd': event_date, 'u': user_key}) AS items FROM baskets GROUP BY unique_id), "
    "opened AS (SELECT unique_id, items, unnest(items) AS x FROM held), "
    "paired AS (SELECT unique_id, x.d AS event_date, x.u AS user_key, x.s AS scope_a, "
    "unnest(list_transform(list_filter(items, lambda y: y.s > x.s), lambda y: y.s)) AS scope_b FROM opened), "
    f"pairs AS (SELECT {key('scope_a', 'scope_b', 'event_date')} AS scope_pair_day_key, event_date, scope_a, scope_b, count(*) AS cooccurrence_count, "
    "count(DISTINCT unique_id) AS distinct_events, count(DISTINCT user_key) AS distinct_users FROM paired GROUP BY event_date, scope_a, scope_b)"
)
_PAIR_COLS = "event_date:d scope_a:s scope_b:s cooccurrence_count:i distinct_events:i distinct_users:i"
ORACLES["scope_cooccurrence"] = typed("scope_pair_day_key:s " + _PAIR_COLS, "SELECT * FROM pairs", BASKETS, _PAIRS)
_SERVICE_OF = "(SELECT max(service) FROM dim_scope d WHERE d.scope_name = c.{0}) AS service_{1}"
_RISKY_BY_SERVICE = f"(SELECT scope_name FROM dim_scope WHERE service IN {_RISKY_SERVICES})"
ORACLES["high_risk_pairs"] = typed(
    _PAIR_COLS + " service_a:s service_b:s",
    f"SELECT c.*, {_SERVICE_OF.format('scope_a', 'a')}, {_SERVICE_OF.format('scope_b', 'b')} FROM pairs c "
    f"WHERE date_diff('day', event_date, (SELECT d FROM today)) <= 7 AND (scope_a IN {_RISKY_BY_SERVICE} OR scope_b IN {_RISKY_BY_SERVICE})",
    BASKETS, _PAIRS, _DIM_SCOPE, _SHIP,
)

# --- baselines, novelty, drift ---

_MEASURES = (("total_events", "events", "event"), ("token_total_bytes", "token_bytes", "token_bytes"))


def _windowed(entity: str, source: str) -> str:
    frames = ", ".join(
        f"{fn}({col}) OVER (PARTITION BY {entity} ORDER BY event_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS {out}_{many}_{n}d"
        for n in (14, 30) for col, many, _ in _MEASURES for fn, out in (("avg", "mean"), ("stddev_pop", "std"))
    )
    scores = []
    for n in (14, 30):
        for col, many, one in _MEASURES:
            mean, std = f"mean_{many}_{n}d", f"std_{many}_{n}d"
            for den, name in ((std, "z_score"), (mean, "pct_change")):
                scores.append(f"({col} - {mean}) / nullif({den}, 0) AS {one}_{name}_{n}d")
    return f"SELECT *, {', '.join(scores)} FROM (SELECT *, {frames} FROM {source}) w"


_SCORE_COLS = " ".join(
    f"mean_{many}_{n}d:f std_{many}_{n}d:f {one}_z_score_{n}d:f {one}_pct_change_{n}d:f" for n in (14, 30) for _, many, one in _MEASURES
)
ORACLES["app_baseline"] = typed(
    "app_baseline_day_key:s app_id:s event_date:d total_events:i distinct_users:i token_total_bytes:i " + _SCORE_COLS,
    _windowed("app_id", "daily"), EV, AUDIT_CTE, _APP_DAILY,
    f"daily AS (SELECT {key('app_id', 'event_date')} AS app_baseline_day_key, app_id, event_date, total_events, distinct_users, "
    "CAST(coalesce((SELECT sum(t.num_bytes) FROM audit t WHERE t.source = 'token' AND t.app_id = a.app_id AND t.event_date = a.event_date), 0) AS BIGINT) "
    "AS token_total_bytes FROM app_daily a)",
)
_SINCE = f"(SELECT d FROM today) - INTERVAL {NOVELTY_DAYS} DAY"


def _new(item: str, table: str, name: str) -> str:
    return (
        f"{name} AS (SELECT user_key, first_day AS event_date, count(DISTINCT {item}) AS n FROM (SELECT user_key, {item}, min(event_date) AS first_day "
        f"FROM {table} WHERE user_key IS NOT NULL AND {item} IS NOT NULL AND event_date >= {_SINCE} GROUP BY user_key, {item}) f GROUP BY user_key, first_day)"
    )


ORACLES["novelty"] = typed(
    "user_key:s event_date:d new_items:i", "SELECT user_key, event_date, n AS new_items FROM new_apps",
    EV, AUDIT_CTE, _TODAY, _new("app_id", "audit", "new_apps"),
)
ORACLES["user_baseline"] = typed(
    "user_baseline_day_key:s user_key:s event_date:d total_events:i token_total_bytes:i token_distinct_apps:i token_distinct_scopes:i "
    f"all_source_distinct_apps:i all_source_distinct_asns:i new_apps_count_{NOVELTY_DAYS}d:i new_scopes_count_{NOVELTY_DAYS}d:i "
    f"new_asns_count_{NOVELTY_DAYS}d:i " + _SCORE_COLS,
    _windowed("user_key", "daily"), EV, AUDIT_CTE, ADDRESS, _TODAY, *SCOPE_CTES,
    "uses AS (SELECT DISTINCT user_key, event_date, kind, item FROM ("
    "SELECT user_key, event_date, 'app' AS kind, app_id AS item FROM audit UNION ALL "
    "SELECT user_key, event_date, 'token app', app_id FROM audit WHERE source = 'token' UNION ALL "
    "SELECT user_key, event_date, 'asn', (SELECT CAST(max(d.asn) AS VARCHAR) FROM address d WHERE d.ip_key = a.ip_key) FROM audit a UNION ALL "
    "SELECT a.user_key, a.event_date, 'scope', s.scope_name FROM audit a, scope_rows s WHERE a.unique_id = s.unique_id AND a.source = 'token') x "
    "WHERE user_key IS NOT NULL AND item IS NOT NULL)",
    f"marked AS (SELECT u.*, event_date >= {_SINCE} AND NOT EXISTS (SELECT 1 FROM uses p WHERE p.user_key = u.user_key AND p.kind = u.kind "
    f"AND p.item = u.item AND p.event_date >= {_SINCE} AND p.event_date < u.event_date) AS debut FROM uses u)",
    f"daily AS (SELECT {key('user_key', 'event_date')} AS user_baseline_day_key, user_key, event_date, count(*) AS total_events, "
    "CAST(coalesce(sum(num_bytes) FILTER (WHERE source = 'token'), 0) AS BIGINT) AS token_total_bytes, "
    + ", ".join(
        f"(SELECT count(*) FROM marked m WHERE m.user_key = a.user_key AND m.event_date = a.event_date AND m.kind = '{kind}'{more}) AS {name}"
        for kind, more, name in (
            ("app", "", "all_source_distinct_apps"), ("token app", "", "token_distinct_apps"), ("scope", "", "token_distinct_scopes"),
            ("asn", "", "all_source_distinct_asns"), ("app", " AND debut", f"new_apps_count_{NOVELTY_DAYS}d"),
            ("scope", " AND debut", f"new_scopes_count_{NOVELTY_DAYS}d"), ("asn", " AND debut", f"new_asns_count_{NOVELTY_DAYS}d"),
        )
    )
    + " FROM audit a WHERE user_key IS NOT NULL GROUP BY user_key, event_date)",
)


def _drift_ctes(days: str) -> list[str]:
    def other_day(shift: str) -> str:
        return (
            "EXISTS (SELECT 1 FROM days o WHERE o.app_id = d.app_id AND o.scope_key = d.scope_key "
            f"AND o.event_date = d.event_date {shift} INTERVAL 1 DAY)"
        )

    return [
        days,
        "marked AS (SELECT d.*, CAST(d.event_date + INTERVAL 1 DAY AS DATE) AS next_date, "
        f"NOT {other_day('-')} AS appears, NOT {other_day('+')} AS goes FROM days d)",
        "cells AS (SELECT app_id, event_date FROM marked UNION SELECT app_id, next_date FROM marked WHERE goes)",
    ]


def _count_of(day: str, flag: str = "true") -> str:
    return f"(SELECT count(*) FROM marked m WHERE m.app_id = c.app_id AND m.{day} = c.event_date AND {flag})"


_DRIFT_BODY = (
    f"SELECT {key('app_id', 'event_date')} AS app_scope_drift_day_key, *, total_scopes - prior_day_scopes AS net_scope_change, "
    "new_scopes_count + removed_scopes_count > 0 AS has_scope_drift FROM (SELECT c.app_id, c.event_date, "
    f"{_count_of('event_date')} AS total_scopes, {_count_of('next_date')} AS prior_day_scopes, "
    f"{_count_of('event_date', 'appears')} AS new_scopes_count, {_count_of('next_date', 'goes')} AS removed_scopes_count FROM cells c) x"
)
_DRIFT_COLS = (
    "app_scope_drift_day_key:s app_id:s event_date:d total_scopes:i prior_day_scopes:i new_scopes_count:i removed_scopes_count:i "
    "net_scope_change:i has_scope_drift:b"
)
_TYPE_DAYS = (
    "days AS (SELECT DISTINCT event_type AS app_id, CAST(k AS VARCHAR) AS scope_key, CAST(ts AS DATE) AS event_date FROM ev)"
)
ORACLES["scope_drift_daily"] = typed(_DRIFT_COLS, _DRIFT_BODY, EV, *_drift_ctes(_TYPE_DAYS))
ORACLES["scope_drift_items"] = typed(
    "app_scope_drift_scope_day_key:s app_id:s event_date:d scope_key:s change_type:s",
    f"SELECT {key('app_id', 'event_date', 'scope_key', 'change_type')} AS app_scope_drift_scope_day_key, * FROM ("
    "SELECT app_id, event_date, scope_key, 'added' AS change_type FROM marked WHERE appears UNION ALL "
    "SELECT app_id, next_date, scope_key, 'removed' FROM marked WHERE goes) c",
    EV, *_drift_ctes(_TYPE_DAYS),
)
ORACLES["client_scope_drift"] = typed(
    _DRIFT_COLS, _DRIFT_BODY, EV, STG[APPS.index("token")], *SCOPE_CTES,
    *_drift_ctes(
        "days AS (SELECT DISTINCT t.client_id AS app_id, s.scope_name AS scope_key, s.event_date FROM scope_rows s "
        "JOIN stg_token t ON t.unique_id = s.unique_id AND t.event_date = s.event_date WHERE t.client_id IS NOT NULL)"
    ),
)

# --- data quality ---

_GAPS = (
    "gaps AS (SELECT u.user_key, d.event_date, 0 AS total_events FROM (SELECT user_key FROM user_daily GROUP BY user_key) u, "
    "(SELECT CAST(unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT d FROM today), INTERVAL 1 DAY)) AS DATE) AS event_date) d "
    "WHERE d.event_date >= (SELECT d FROM today) - INTERVAL 30 DAY AND NOT EXISTS (SELECT 1 FROM user_daily o "
    "WHERE o.user_key = u.user_key AND o.event_date = d.event_date AND o.total_events > 0))"
)
_GAP_COLS = "user_key:s event_date:d total_events:i"
ORACLES["event_gaps"] = typed(_GAP_COLS, "SELECT * FROM gaps", EV, AUDIT_CTE, _USER_DAILY, _TODAY, _GAPS)
ORACLES["recent_gaps"] = typed(
    _GAP_COLS, "SELECT * FROM gaps WHERE event_date >= (SELECT d FROM today) - INTERVAL 30 DAY", EV, AUDIT_CTE, _USER_DAILY, _TODAY, _GAPS
)
_DUPES = (
    "dupes AS (SELECT event_date, source, count(*) AS total_rows, count(DISTINCT unique_id) AS distinct_event_ids, "
    "count(*) - count(DISTINCT unique_id) AS duplicate_rows FROM audit2 GROUP BY event_date, source)"
)
_DUPE_COLS = "event_date:d source:s total_rows:i distinct_event_ids:i duplicate_rows:i"
ORACLES["duplicate_events"] = typed(_DUPE_COLS, "SELECT * FROM dupes WHERE duplicate_rows > 0", EV, TWICE, AUDIT2_CTE, _DUPES)
ORACLES["recent_duplicates"] = typed(
    _DUPE_COLS, "SELECT * FROM dupes WHERE duplicate_rows > 0 AND event_date >= (SELECT d FROM today) - INTERVAL 30 DAY",
    EV, TWICE, AUDIT2_CTE, _DUPES, _TODAY,
)


def _nulls(col: str) -> str:
    return f"SELECT 'events' AS model, 'not_null' AS test, '{col}' AS column_name, count(*) FILTER (WHERE \"{col}\" IS NULL) AS violations FROM audit2"


def _repeats(*cols: str) -> str:
    known = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (
        f"SELECT 'events', 'unique', '{','.join(cols)}', count(*) FROM (SELECT {', '.join(cols)} FROM audit2 WHERE {known} "
        f"GROUP BY {', '.join(cols)} HAVING count(*) > 1) r"
    )


ORACLES["dq_report"] = typed(
    "model:s test:s column_name:s violations:i",
    " UNION ALL ".join(
        [_nulls(c) for c in ("unique_id", "timestamp", "user_key", "app_id", "num_bytes")]
        + [_repeats("unique_id"), _repeats("user_key", "event_hour")]
    ),
    EV, TWICE, AUDIT2_CTE,
)
ORACLES["misplaced_rows"] = typed("event_id:i ts:t", "SELECT event_id, ts FROM events WHERE event_id % 50 = 0")

# --- dimensions and facts ---

# users straight from the events, whatever their application
_USER_PARTS = ", ".join(
    f"{sql} AS {name}"
    for name, sql in (
        ("actor_profile_id", BASE["actor_profile_id"]), ("actor_email", BASE["actor_email"]),
        ("unit", f"CASE event_type WHEN '{TYPE_OF_APP['saml']}' THEN {OWN['saml']['orgunit_path']} END"),
        ("guest", f"CASE event_type WHEN '{TYPE_OF_APP['drive']}' THEN {OWN['drive']['actor_is_collaborator_account']} END"),
    )
)
_DIM_USER = (
    f"people AS (SELECT {_USER_PARTS} FROM ev), "
    f"dim_user AS (SELECT {key('actor_profile_id', 'actor_email')} AS user_key, actor_profile_id, actor_email, "
    "list_max(list(unit)) AS orgunit_path, list_contains(list(coalesce(guest, false)), true) AS is_collaborator FROM people GROUP BY actor_profile_id, actor_email)"
)
_ALL_IPS = " UNION ALL ".join(f"SELECT ip_address, asn, asn_list, region_code, subdivision_code FROM stg_{a}" for a in APPS)
_DIM_IP = (
    f"seen AS ({_ALL_IPS}), dim_ip AS (SELECT {key('ip_address')} AS ip_key, ip_address, "
    "CASE WHEN max(number) > 0 THEN max(number) WHEN max(asn) > 0 THEN max(asn) END AS asn, "
    "max(region_code) AS region_code, max(subdivision_code) AS subdivision_code, "
    "count(*) FILTER (WHERE number = 0 OR coalesce(asn, 0) = 0) > 0 AS has_unknown_asn FROM ("
    "SELECT *, unnest(asn_list) AS number FROM seen WHERE asn_list IS NOT NULL UNION ALL "
    "SELECT *, asn AS number FROM seen WHERE asn_list IS NULL AND asn IS NOT NULL) x WHERE ip_address IS NOT NULL GROUP BY ip_address)"
)
_DIM_APP = (
    f"dim_app AS (SELECT {key('app_id')} AS app_key, app_id, max(app_name) AS app_name, max(client_type) AS client_type, max(api_name) AS api_name FROM ("
    "SELECT client_id AS app_id, accessing_app_name AS app_name, client_type, api_name FROM stg_token UNION ALL BY NAME "
    "SELECT oauth_client_id AS app_id, oauth_app_name AS app_name FROM stg_admin UNION ALL BY NAME "
    "SELECT oauth_client_id AS app_id, oauth_app_name AS app_name FROM stg_drive) x WHERE app_id IS NOT NULL GROUP BY app_id)"
)
ORACLES["dim_user"] = typed(
    "user_key:s actor_profile_id:s actor_email:s orgunit_path:s is_collaborator:b", "SELECT * FROM dim_user", EV, *STG, _DIM_USER
)
ORACLES["dim_ip"] = typed(
    "ip_key:s ip_address:s asn:i region_code:s subdivision_code:s has_unknown_asn:b", "SELECT * FROM dim_ip", EV, *STG, _DIM_IP
)
ORACLES["dim_application"] = typed(
    "app_key:s app_id:s app_name:s client_type:s api_name:s", "SELECT * FROM dim_app", EV, *STG, _DIM_APP
)
ORACLES["dim_time"] = typed(
    "date_day:d year:i month:i day_of_month:i day_of_year:i week_of_year:i day_of_week:i day_name:s month_name:s is_weekend:b "
    "week_start:d month_start:d quarter_start:d is_month_start:b is_month_end:b",
    "SELECT d AS date_day, year(d) AS year, month(d) AS month, day(d) AS day_of_month, dayofyear(d) AS day_of_year, "
    "weekofyear(d) AS week_of_year, dayofweek(d) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name, "
    "isodow(d) > 5 AS is_weekend, d - CAST(isodow(d) - 1 AS INTEGER) AS week_start, make_date(year(d), month(d), 1) AS month_start, "
    "make_date(year(d), 3 * quarter(d) - 2, 1) AS quarter_start, day(d) = 1 AS is_month_start, last_day(d) = d AS is_month_end "
    "FROM (SELECT CAST(unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS d) x",
)

_FACT_TIME = 'b.unique_id, b."timestamp", b.event_date, b.event_hour, extract(hour FROM b."timestamp") AS hour_of_day'
_FACT_TIME_COLS = "unique_id:s timestamp:t event_date:d event_hour:t hour_of_day:i user_key:s ip_key:s"
_FACT_WHO = "u.user_key, i.ip_key, b.actor_profile_id, b.actor_email, b.ip_address, b.customer_id"
_FACT_WHO_COLS = " actor_profile_id:s actor_email:s ip_address:s customer_id:s"
_FACT_JOINS = (
    "LEFT JOIN (SELECT actor_profile_id, actor_email, user_key FROM dim_user) u USING (actor_profile_id, actor_email) "
    "LEFT JOIN (SELECT ip_address, ip_key FROM dim_ip) i USING (ip_address)"
)
_KIND = {"string": "s", "bigint": "i", "boolean": "b", "timestamp": "t"}


def _kinds(app: str, names: list[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in EVENT_SCHEMAS[app].fields}
    return " ".join(f"{n}:{_KIND.get(types[n], 'l')}" for n in names)


# Per fact: columns taken from the event as they are, and those from the application dimension.
_FACT_PLAIN = {
    "token": "accessing_app_name region_code subdivision_code num_bytes scope_count has_drive_scope has_gmail_scope "
    "has_admin_scope event_type event_name method_name product_buckets",
    "admin": "application_name oauth_app_name region_code subdivision_code resource_detail_count caller_type impersonation event_type event_name",
    "drive": "region_code subdivision_code resource_detail_count resource_id_count applied_label_count primary_event billable "
    "actor_is_collaborator_account user_query parsed_query originating_app_id applied_label_titles event_type event_name",
    "login": "region_code subdivision_code resource_detail_count is_suspicious login_type login_challenge_methods event_type event_name",
    "saml": "region_code subdivision_code orgunit_path initiated_by saml_sp_name saml_status_code saml_second_level_status_code "
    "saml_failure_type event_type event_name",
}
_FACT_APP = {"token": "client_id", "admin": "oauth_client_id", "drive": "oauth_client_id"}

for _app in APPS:
    _plain = _FACT_PLAIN[_app].split()
    _select = f"{_FACT_TIME}, {_FACT_WHO}, " + ", ".join(f"b.{c}" for c in _plain)
    _join, _names = _FACT_JOINS, ""
    if _app in _FACT_APP:
        _app_name = "oauth_app_name_dim" if _app == "admin" else "app_name"
        _select += f", b.{_FACT_APP[_app]} AS app_id, a.app_name AS {_app_name}, a.client_type, a.api_name"
        _join += f" LEFT JOIN dim_app a ON a.app_id = b.{_FACT_APP[_app]}"
        _names = f" app_id:s {_app_name}:s client_type:s api_name:s"
    ORACLES[f"fact_{_app}"] = typed(
        f"{_FACT_TIME_COLS}{_FACT_WHO_COLS} {_kinds(_app, _plain)}{_names}",
        f"SELECT {_select} FROM stg_{_app} b {_join}", EV, *STG, _DIM_USER, _DIM_IP, _DIM_APP,
    )
ORACLES["incremental_upsert"] = ORACLES["fact_token"]
ORACLES["fact_token_scope"] = typed(
    f"token_scope_key:s {_FACT_TIME_COLS} scope_key:s scope_name:s scope_family:s product_bucket:s service:s is_readonly:b",
    f"SELECT {key('b.unique_id', 'b.scope_name')} AS token_scope_key, {_FACT_TIME}, u.user_key, i.ip_key, {key('b.scope_name')} AS scope_key, "
    "b.scope_name, b.scope_family, b.product_bucket, b.service, b.is_readonly FROM scope_rows b "
    f"LEFT JOIN (SELECT unique_id, actor_profile_id, actor_email, ip_address FROM stg_token) e USING (unique_id) {_FACT_JOINS}",
    EV, *STG, *SCOPE_CTES, _DIM_USER, _DIM_IP,
)

# --- incremental ---

_NEWEST = (
    "newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY \"timestamp\" DESC) AS rn FROM audit2) r WHERE rn = 1)"
)
ORACLES["latest_rows"] = typed("unique_id:s timestamp:t source:s num_bytes:i", "SELECT * FROM newest", EV, TWICE, AUDIT2_CTE, _NEWEST)
ORACLES["merged_table"] = typed(
    "unique_id:s timestamp:t event_date:d source:s num_bytes:i", "SELECT * FROM newest", EV, TWICE, AUDIT2_CTE, _NEWEST
)
ORACLES["distinct_keys"] = typed(
    "unique_id:s source:s user_key:s", "SELECT DISTINCT unique_id, source, user_key FROM audit2", EV, TWICE, AUDIT2_CTE
)
ORACLES["repeat_counts"] = typed(
    "rows_before:i rows_after:i rows_removed:i",
    "SELECT count(*) AS rows_before, count(DISTINCT unique_id) AS rows_after, count(*) - count(DISTINCT unique_id) AS rows_removed FROM audit2",
    EV, TWICE, AUDIT2_CTE,
)
ORACLES["tail_replace"] = typed(
    "unique_id:s timestamp:t num_bytes:i load:s",
    f"SELECT *, CASE WHEN \"timestamp\" > TIMESTAMP '{CUT}' THEN 'second' ELSE 'first' END AS load FROM audit", EV, AUDIT_CTE,
)
_COVER = [
    "spans AS (SELECT source, CAST(CAST(min(\"timestamp\") AS DATE) AS TIMESTAMP) AS lo, max(\"timestamp\") AS hi, "
    "CASE source WHEN 'admin' THEN 24 WHEN 'login' THEN 48 WHEN 'saml' THEN 48 WHEN 'drive' THEN 48 ELSE 6 END AS h FROM audit GROUP BY source)",
    "windows AS (SELECT source, idx, lo + to_hours(CAST(idx * h AS BIGINT)) AS window_start, least(lo + to_hours(CAST((idx + 1) * h AS BIGINT)), hi) AS window_end, lo, hi "
    "FROM (SELECT *, unnest(range(0, CAST(ceil(date_diff('second', lo, hi) / 3600.0 / h) AS BIGINT) + 1)) AS idx FROM spans) g WHERE lo + to_hours(CAST(idx * h AS BIGINT)) + INTERVAL 1 SECOND <= hi)",
    "covered AS (SELECT w.source, w.idx, w.window_start, w.window_end, count(a.unique_id) AS num_events, min(a.\"timestamp\") AS earliest_event_time, "
    "max(a.\"timestamp\") AS latest_event_time FROM windows w LEFT JOIN audit a ON a.source = w.source AND a.\"timestamp\" >= w.window_start "
    "AND a.\"timestamp\" < w.window_end GROUP BY ALL)",
]
ORACLES["run_coverage"] = typed(
    "source:s idx:i window_start:t window_end:t num_events:i earliest_event_time:t latest_event_time:t",
    "SELECT * REPLACE (nullif(num_events, 0) AS num_events) FROM covered", EV, AUDIT_CTE, *_COVER,
)
ORACLES["run_manifests"] = typed(
    "source:s start:t end:t num_windows:i earliest_event_time:t latest_event_time:t num_events:i windows:i",
    'SELECT source, min(window_start) AS start, max(window_end) AS "end", count(*) AS num_windows, min(earliest_event_time) AS earliest_event_time, '
    "max(latest_event_time) AS latest_event_time, sum(num_events) AS num_events, count(*) FILTER (WHERE num_events > 0) AS windows FROM ("
    "SELECT c.* REPLACE (s.hi AS window_end) FROM covered c JOIN spans s ON s.source = c.source) r GROUP BY source",
    EV, AUDIT_CTE, *_COVER,
)


def _minutes(later: str, earlier: str) -> str:
    return f"greatest(0.0, (epoch_us({later}) - epoch_us({earlier})) / 60000000.0)"


def _dist(col: str) -> str:
    fns = {"p": f"quantile_cont({col}, 0.95)", "min": f"min({col})", "mean": f"avg({col})", "max": f"max({col})"}
    return ", ".join(f"round({fn}, 3) AS {col}_gap_{k}" for k, fn in fns.items())


_ESTIMATE = [
    f"gaps AS (SELECT source AS app, CASE WHEN num_events > 0 THEN {_minutes('earliest_event_time', 'window_start')} END AS head, "
    f"CASE WHEN num_events > 0 THEN {_minutes('window_end', 'latest_event_time')} END AS tail, earliest_event_time, latest_event_time FROM covered)",
    f"estimate AS (SELECT *, coalesce(least(CAST(ceil(head_gap_p + 1) AS BIGINT), 10), 0) AS recommended_overlap_minutes FROM ("
    f"SELECT app, count(*) AS files_considered, count(head) AS runs_used, {_dist('head')}, {_dist('tail')}, "
    "min(earliest_event_time) AS earliest_event_time, max(latest_event_time) AS latest_event_time FROM gaps GROUP BY app) e)",
]
ORACLES["overlap_estimate"] = typed(
    "app:s files_considered:i runs_used:i "
    + " ".join(f"{c}_gap_{k}:f" for c in ("head", "tail") for k in ("p", "min", "mean", "max"))
    + " earliest_event_time:t latest_event_time:t recommended_overlap_minutes:i",
    "SELECT * FROM estimate", EV, AUDIT_CTE, *_COVER, *_ESTIMATE,
)
_GAP_NAMES = [f"{c}_gap_{k}" for c in ("head", "tail") for k in ("p", "min", "mean", "max")]
ORACLES["overlap_of_all_apps"] = typed(
    "app:s files_considered:i runs_used:i " + " ".join(f"{c}:f" for c in _GAP_NAMES) + " earliest_event_time:t latest_event_time:t recommended_overlap_minutes:i",
    "SELECT * FROM estimate WHERE app IN ('token', 'admin', 'login') UNION ALL BY NAME "
    "SELECT unnest(['drive', 'saml']) AS app, 0 AS files_considered, 0 AS runs_used, 0 AS recommended_overlap_minutes",
    EV, AUDIT_CTE, *_COVER, *_ESTIMATE,
)
ORACLES["overlap_total"] = typed(
    "apps_considered:i apps_with_runs:i total_files_considered:i total_runs_used:i recommended_max_minutes:i total_duration_minutes:f",
    "SELECT count(*) AS apps_considered, count(*) FILTER (WHERE runs_used > 0) AS apps_with_runs, sum(files_considered) AS total_files_considered, "
    "sum(runs_used) AS total_runs_used, max(recommended_overlap_minutes) AS recommended_max_minutes, "
    f"{_minutes('max(latest_event_time)', 'min(earliest_event_time)')} AS total_duration_minutes FROM estimate",
    EV, AUDIT_CTE, *_COVER, *_ESTIMATE,
)

# --- raw logs ---

_ROLLUP = (
    "rollup AS (SELECT event_id, count(*) AS n, list_sort(list(DISTINCT product_bucket) FILTER (WHERE product_bucket IS NOT NULL)) AS buckets "
    "FROM scope_rows GROUP BY event_id)"
)
_FALLBACK = "CASE WHEN e.event_id % 5 = 0 AND e.event_id % 3 = 0 THEN ['DRIVE'] END"
_TOKEN_FLAT = (
    "flat AS (SELECT t.* EXCLUDE (scope_count, product_buckets, has_drive_scope, has_gmail_scope, has_admin_scope), "
    f"coalesce(r.n, 0) AS scope_count, coalesce(r.buckets, {_FALLBACK}) AS product_buckets FROM stg_token t "
    "JOIN ev e ON 'u' || e.event_id = t.unique_id LEFT JOIN rollup r ON r.event_id = e.event_id)"
)
for _app in APPS:
    _cols_of = _kinds(_app, EVENT_SCHEMAS[_app].names)
    if _app != "token":
        ORACLES[f"flatten_{_app}"] = typed(_cols_of, f"SELECT * FROM stg_{_app}", EV, *STG)
    else:
        _flags = ", ".join(
            f"coalesce(list_contains(product_buckets, '{b}'), false) AS has_{n}_scope"
            for n, b in (("drive", "DRIVE"), ("gmail", "GMAIL"), ("admin", "GSUITE_ADMIN"))
        )
        ORACLES["flatten_token"] = typed(_cols_of, f"SELECT *, {_flags} FROM flat", EV, *STG, *SCOPE_CTES, _ROLLUP, _TOKEN_FLAT)


def _given(*cols: str) -> str:
    return " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in cols)


# the client's id, and scopes by one of three parameters
_ID = "CAST(substring(unique_id, 2) AS BIGINT)"
_TOKEN_EXTRA = f"(client_id IS NOT NULL OR {_ID} % 17 = 0)::INTEGER + ({_ID} % 5 > 0 OR {_ID} % 3 = 0)::INTEGER"
ORACLES["flatten_generic"] = typed(
    "app:s unique_id:s actor_email:s asn:i n_parameters:i login_type:s is_suspicious:s",
    " UNION ALL BY NAME ".join(
        f"SELECT '{a}' AS app, unique_id, actor_email, asn, {n} AS n_parameters, {more} FROM stg_{a}"
        for a, n, more in (
            ("login", _given("login_type", "login_challenge_methods", "is_suspicious"), "login_type, CAST(is_suspicious AS VARCHAR) AS is_suspicious"),
            ("drive", _given("user_query", "parsed_query", "originating_app_id", "primary_event", "billable", "actor_is_collaborator_account"), "NULL AS login_type"),
            ("saml", _given("orgunit_path", "initiated_by", "saml_status_code", "saml_second_level_status_code", "saml_sp_name", "saml_failure_type"), "NULL AS login_type"),
            ("admin", "0", "NULL AS login_type"),
            ("token", "3 + " + _given("method_name", "nullif(num_bytes, 0)") + " + " + _TOKEN_EXTRA, "NULL AS login_type"),
        )
    ),
    EV, *STG,
)
FAULTS = (
    f"faults AS (SELECT {BASE['application_name']} AS app, 'u' || event_id AS unique_id, CASE event_id % 19 WHEN 0 THEN 'missing activity timestamp' "
    "WHEN 1 THEN 'invalid activity timestamp' WHEN 2 THEN 'not an activity: malformed JSON or a field of the wrong type' "
    "WHEN 3 THEN 'missing actor' WHEN 4 THEN 'event without name or type' WHEN 5 THEN 'parameter without name' "
    "WHEN 6 THEN CASE WHEN event_id % 3 > 0 THEN 'resource without id' END "
    "WHEN 7 THEN CASE WHEN event_id % 3 > 0 AND event_type = 'signup' THEN 'label without id' END END AS error FROM ev)"
)
ORACLES["dead_letters"] = typed(
    "app:s error:s lines:i", "SELECT app, error, count(*) AS lines FROM faults WHERE error IS NOT NULL GROUP BY app, error", EV, FAULTS,
)
_SCOPE_COLS = "timestamp:t unique_id:s scope_name:s scope_family:s product_bucket:s service:s is_readonly:b"
ORACLES["scope_explode"] = typed(_SCOPE_COLS, "SELECT * FROM scope_rows", EV, *SCOPE_CTES)
ORACLES["scope_classify"] = typed(
    "scope_name:s product_bucket:s scope_family:s scope_suffix:s service:s census_service:s is_readonly:b n:i",
    "SELECT scope_name, product_bucket, scope_family, scope_suffix, service, census_service, is_readonly, count(*) AS n FROM scope_rows GROUP BY ALL",
    EV, *SCOPE_CTES,
)
ORACLES["census"] = typed(
    "scope_name:s product_bucket:s service:s is_readonly:b count:i",
    'SELECT scope_name, product_bucket, census_service AS service, is_readonly, count(*) AS "count" FROM scope_rows '
    "GROUP BY scope_name, product_bucket, census_service, is_readonly",
    EV, *SCOPE_CTES,
)
ORACLES["mixed_shapes"] = typed(
    "app:s unique_id:s n:i",
    f"SELECT {BASE['application_name']} AS app, 'u' || event_id AS unique_id, CASE WHEN event_id % 5 <> 4 AND event_id % 3 = 1 THEN 2 ELSE 1 END AS n FROM events",
)
_SHARED = [c for c in BASE if c != "application_name"]
ORACLES["ingested_table"] = typed(
    "app:s timestamp:t unique_id:s customer_id:s actor_email:s actor_profile_id:s ip_address:s asn:i asn_list:l region_code:s subdivision_code:s event_type:s event_name:s",
    " UNION ALL ".join(f"SELECT '{a}' AS app, " + ", ".join(f'"{c}"' for c in _SHARED) + f" FROM stg_{a}" for a in APPS), EV, *STG,
)
ORACLES["surrogate_keys"] = typed(
    "unique_id:s row_key:s",
    f"SELECT unique_id, {key('user_key', 'event_date', 'num_bytes', 'impersonation')} AS row_key FROM audit", EV, AUDIT_CTE,
)
ORACLES["stream_volume"] = typed(
    "source:s event_hour:t total_events:i",
    "SELECT event_type AS source, date_trunc('hour', ts) AS event_hour, count(*) AS total_events FROM events GROUP BY event_type, date_trunc('hour', ts)",
)
ORACLES["stream_merge"] = typed(
    "unique_id:s timestamp:t event_type:s value:f", "SELECT 'u' || event_id AS unique_id, ts AS \"timestamp\", event_type, \"value\" FROM events"
)

from watchspan.plans.driver_history_oracles import HISTORY  # noqa: E402  (it builds on the definitions above)

ORACLES |= HISTORY
