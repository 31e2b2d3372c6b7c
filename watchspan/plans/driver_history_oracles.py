"""Expected results of the queries on stored tables: what one build over all rows gives."""

from __future__ import annotations

from watchspan.operators.quality import CHECKS
from watchspan.plans.driver_history import AS_OF, DAYS, MODEL_QUERIES, OVERLAP, RENAMED, SPARSE, SPREAD_DAYS
from watchspan.plans.driver_oracles import _TODAY, AUDIT_CTE, EV, FAULTS, ORACLES, SCOPE_CTES, STG, typed
from watchspan.plans.driver_queries import CUT
from watchspan.schemas import APPS

HISTORY: dict[str, str] = {}

_MOVED = f"SELECT * REPLACE (ts + to_days({SPREAD_DAYS}) AS ts) FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e"
_SPREAD = f"ev AS ({_MOVED})"
_SPREAD_SPARSE = f"ev AS ({_MOVED} WHERE {SPARSE})"
_MOVED_TODAY = "today AS (SELECT CAST(max(ts) AS DATE) AS d FROM ev)"


def _spread(name: str, events: str = _SPREAD) -> str:
    """The SQL of a query over the events as they are, over the spread ones."""
    return ORACLES[name].replace(EV, events).replace(_TODAY, _MOVED_TODAY)


HISTORY["app_baseline_incremental"] = _spread("app_baseline", _SPREAD_SPARSE)
HISTORY["user_baseline_incremental"] = _spread("user_baseline")
HISTORY["novelty_incremental"] = _spread("novelty")
HISTORY["late_rows_reach_facts"] = ORACLES["fact_token"]


def _as_text(dimension: str, query: str, key: str, *columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in sorted(columns))
    return f"SELECT '{dimension}' AS dimension, {key} AS row_key, concat_ws('|', {texts}) AS attributes FROM ({ORACLES[query]}) d"


HISTORY["dims_incremental"] = typed(
    "dimension:s row_key:s attributes:s",
    " UNION ALL ".join(
        [
            _as_text("dim_user", "dim_user", "user_key", "actor_profile_id", "actor_email", "orgunit_path", "is_collaborator"),
            _as_text("dim_ip_address", "dim_ip", "ip_key", "ip_address", "asn", "region_code", "subdivision_code", "has_unknown_asn"),
            _as_text("dim_application", "dim_application", "app_key", "app_id", "app_name", "client_type", "api_name"),
            _as_text("dim_time", "dim_time", "CAST(date_day AS VARCHAR)", "day_name"),
        ]
    ),
)

HISTORY["merged_with_moved_keys"] = typed(
    "event_id:i timestamp:t event_type:s value:f event_date:d",
    'SELECT event_id, t AS "timestamp", event_type, CASE WHEN moves THEN value + 1 ELSE value END AS value, CAST(t AS DATE) AS event_date FROM ('
    "SELECT *, CASE WHEN moves THEN ts + INTERVAL 4 DAY ELSE ts END AS t FROM ("
    f"SELECT *, event_id % 10 = 0 AND ts < TIMESTAMP '{CUT}' AS moves FROM events) m) x",
)

HISTORY["manifest_coverage"] = typed(
    "app:s run_id:s idx:i num_events:i earliest_event_time:t latest_event_time:t",
    "SELECT w.app, 'run-' || w.app AS run_id, w.idx, count(*) AS num_events, min(a.\"timestamp\") AS earliest_event_time, max(a.\"timestamp\") AS latest_event_time "
    "FROM windows w JOIN audit a ON a.source = w.app AND a.\"timestamp\" >= w.a AND a.\"timestamp\" < w.b GROUP BY w.app, w.idx",
    EV, AUDIT_CTE,
    "spans AS (SELECT source AS app, date_trunc('day', min(\"timestamp\")) AS lo, max(\"timestamp\") AS hi FROM audit GROUP BY source)",
    "starts AS (SELECT app, lo, unnest(range(0, CAST(floor(epoch(hi - lo) / 18000) AS BIGINT) + 1)) AS idx FROM spans)",
    "windows AS (SELECT app, idx, lo + to_hours(5 * idx) AS a, lo + to_hours(5 * idx + 2 * (1 + idx % 7)) AS b FROM starts)",
)


def _checks(model: str, table: str) -> list[str]:
    required, unique = CHECKS[model]
    parts = [f"SELECT '{model}' AS model, 'not_null' AS test, '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS violations FROM {table}" for c in required]
    return parts + [
        f"SELECT '{model}', 'unique', '{c}', count(*) FROM (SELECT 1 FROM {table} WHERE \"{c}\" IS NOT NULL GROUP BY \"{c}\" HAVING count(*) > 1) r" for c in unique
    ]


_MODELS = {f"stg_{a}_events": f"SELECT * FROM stg_{a}" for a in APPS} | {"stg_token_event_scopes": "SELECT * FROM scope_rows"}
for _model, _query in MODEL_QUERIES.items():
    _old, _new = RENAMED.get(_model, ("", ""))
    _MODELS[_model] = f"SELECT * {f'RENAME ({_old} AS {_new})' if _old else ''} FROM ({ORACLES[_query]}) o"
HISTORY["model_checks"] = typed(
    "model:s test:s column_name:s violations:i",
    " UNION ALL ".join(part for m in _MODELS for part in _checks(m, f"m_{m}")),
    EV, *STG, *SCOPE_CTES, *(f"m_{m} AS MATERIALIZED ({sql})" for m, sql in _MODELS.items()),
)
HISTORY["stream_raw_restart"] = typed(
    "outcome:s lines:i", "SELECT coalesce(error, 'stored') AS outcome, count(*) AS lines FROM faults WHERE app = 'drive' GROUP BY outcome", EV, FAULTS
)

_TOPS = "tops AS (SELECT source AS app, max(\"timestamp\") AS top, CAST(min(\"timestamp\") AS DATE) AS low FROM audit GROUP BY source)"
_KINDS = "kinds AS (SELECT * FROM tops, (VALUES ('processor'), ('loader')) v(kind))"
_FIRST_RUN = f"TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR"
HISTORY["start_chain"] = typed(
    "app:s kind:s start:t first_day:d last_day:d",
    "SELECT app, kind, start, CAST(start AS DATE) - 1 AS first_day, "
    f"CASE WHEN app = 'login' THEN least(CAST(top AS DATE), DATE '{AS_OF[:10]}') ELSE DATE '{AS_OF[:10]}' END AS last_day FROM ("
    f"SELECT *, CASE WHEN app = 'token' THEN top - INTERVAL {OVERLAP} MINUTE WHEN app = 'admin' THEN CAST(low AS TIMESTAMP) "
    f"WHEN app IN ('login', 'drive') AND kind = 'processor' THEN top - INTERVAL {OVERLAP} MINUTE ELSE {_FIRST_RUN} END AS start FROM kinds) x",
    EV, AUDIT_CTE, _TOPS, _KINDS,
)
HISTORY["cursor_after_load"] = typed(
    "app:s cursor:t",
    "SELECT t.app, CASE WHEN t.app = 'token' THEN greatest(t.top, (SELECT max(\"timestamp\") + INTERVAL 1 MINUTE FROM scope_rows)) "
    "WHEN t.app <> 'saml' THEN t.top END AS cursor FROM tops t",
    EV, AUDIT_CTE, _TOPS, *SCOPE_CTES,
)
HISTORY["control_log"] = typed(
    "app:s stage:s cursor:t run_id:s status:s",
    "SELECT app, 'processor' AS stage, CASE WHEN app <> 'admin' THEN top END AS cursor, CASE WHEN app <> 'admin' THEN 'r0' END AS run_id, "
    "CASE WHEN app = 'admin' THEN 'reset' ELSE 'success' END AS status FROM tops UNION ALL SELECT app, 'loader', top, NULL, 'success' FROM tops WHERE app = 'saml'",
    EV, AUDIT_CTE, _TOPS,
)
HISTORY["rebuilt_tables"] = typed(
    "app:s kind:s event_date:d n:i",
    "SELECT 'token' AS app, 'events' AS kind, event_date, count(*) AS n FROM stg_token GROUP BY event_date UNION ALL "
    "SELECT 'saml', 'events', event_date, count(*) FROM stg_saml GROUP BY event_date UNION ALL "
    "SELECT 'token', 'event_scopes', event_date, count(DISTINCT (unique_id, scope_name, coalesce(product_bucket, ''))) FROM scope_rows GROUP BY event_date",
    EV, *STG, *SCOPE_CTES,
)
HISTORY["day_batches"] = typed(
    "app:s batch_start:d batch_end:d",
    "SELECT app, CAST(a AS DATE) AS batch_start, least(CAST(a AS DATE) + 6, CAST(top AS DATE)) AS batch_end FROM ("
    "SELECT app, top, unnest(generate_series(CAST(low AS TIMESTAMP), top, INTERVAL 7 DAY)) AS a FROM tops) x",
    EV, AUDIT_CTE, _TOPS,
)
_BY_DAY = "FROM audit WHERE event_date {} GROUP BY source, event_date"
HISTORY["raw_days"] = typed(
    "app:s event_date:d n:i n_ids:i",
    "SELECT source AS app, event_date, count(*) AS n, count(DISTINCT unique_id) AS n_ids " + _BY_DAY.format(f"BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}'"), EV, AUDIT_CTE,
)
HISTORY["processed_since"] = typed(
    "app:s event_date:d n:i n_addresses:i",
    "SELECT source AS app, event_date, count(*) AS n, count(DISTINCT ip_key) AS n_addresses " + _BY_DAY.format(f">= DATE '{DAYS[1]}'"), EV, AUDIT_CTE,
)
HISTORY["earliest_days"] = typed(
    "app:s raw_day:d processed_day:d",
    f"SELECT source AS app, min(event_date) AS raw_day, min(event_date) FILTER (WHERE event_date >= DATE '{DAYS[0]}') AS processed_day FROM audit GROUP BY source",
    EV, AUDIT_CTE,
)


def _crc_third(value: str) -> str:
    return f"{_crc32(value)} % 3"


def _crc32(value: str) -> str:
    """crc32 of a short text by the polynomial's remainder, byte by byte."""
    table = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    codes = f"list_transform(string_split({value}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)"


HISTORY["scope_dedup"] = typed(
    "timestamp:t unique_id:s scope_name:s product_bucket:s",
    "SELECT max(t) AS \"timestamp\", unique_id, scope_name, product_bucket FROM ("
    "SELECT CASE WHEN third = 0 THEN \"timestamp\" + INTERVAL 1 SECOND ELSE \"timestamp\" END AS t, unique_id, scope_name, product_bucket FROM marked UNION ALL "
    "SELECT \"timestamp\", unique_id, scope_name, NULL FROM marked WHERE third = 1) r GROUP BY unique_id, scope_name, product_bucket",
    EV, *SCOPE_CTES, f"marked AS (SELECT *, {_crc_third('unique_id')} AS third FROM scope_rows)",
)
HISTORY["merged_with_new_column"] = typed(
    "event_id:i timestamp:t event_date:d value:f doubled:f",
    'SELECT event_id, ts AS "timestamp", CAST(ts AS DATE) AS event_date, "value", CASE WHEN event_id % 2 = 1 THEN "value" * 2 END AS doubled FROM events',
)
_USERS_N = "SELECT count(DISTINCT coalesce(actor_email, '')) FROM stg_token"
HISTORY["materialized_models"] = typed(
    "model:s rows:i",
    " UNION ALL ".join(
        [f"SELECT '{a}_events' AS model, (SELECT count(*) FROM stg_{a}) AS rows" for a in APPS]
        + ["SELECT 'token_event_scopes', (SELECT count(*) FROM scope_rows)", "SELECT 'watchspan_empty', 0"]
        + [f"SELECT 'watchspan_users_{k}', ({_USERS_N})" for k in ("view", "table", "incremental")]
        + [f"SELECT 'sum of n', (SELECT count(*) FROM stg_token) + ({_USERS_N})"]
    ),
    EV, *STG, *SCOPE_CTES,
)
HISTORY["census_csv"] = typed(
    "scope_name:s product_bucket:s service:s is_readonly:s count:i",
    f"SELECT scope_name, coalesce(product_bucket, '') AS product_bucket, service, CAST(is_readonly AS VARCHAR) AS is_readonly, \"count\" FROM ({ORACLES['census']}) c",
)
