"""The given tables read as audit data: every row is derived from them, none is made up.

`events` become activities of the five applications, as processed columns and as raw JSON.
`lineitem` with its order and part becomes a set of scopes per event. The column definitions are
SQL text that Spark and the checking engine read alike; only the array constructor differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchspan.operators.dedup import fold_rows
from watchspan.plans.staging import stage
from watchspan.schemas import APPS

# Which event type stands for which application.
APP_OF_TYPE = {"click": "token", "error": "admin", "purchase": "login", "signup": "drive", "view": "saml"}
TYPE_OF_APP = {a: t for t, a in APP_OF_TYPE.items()}

# Scope names with the bucket their messages carry.
SCOPES = [
    ("https://www.googleapis.com/auth/drive.readonly", "DRIVE"),
    ("https://www.googleapis.com/auth/admin.directory.user.readonly", "GSUITE_ADMIN"),
    ("https://www.googleapis.com/auth/calendar.addons.current.event.read", None),
    ("openid", "IDENTITY"),
    ("https://www.googleapis.com/auth/userinfo.email", None),
    ("https://mail.example.com/", "GMAIL"),
    ("https://www.googleapis.com/auth/spreadsheets", "OTHER"),
    ("https://www.googleapis.com/auth/unknownthing.write", None),
    ("https://www.google.com/accounts/OAuthLogin", None),
    ("https://www.googleapis.com/auth/script.projects", "APPS_SCRIPT_API"),
    ("https://www.googleapis.com/auth/cloud-identity.groups", None),
    ("https://www.googleapis.com/auth/gmail.send", None),
]


def _pick(index: str, *values: str) -> str:
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case {index} {whens} end"


# Columns of every activity, over event_id, ts, user_id, event_type, value and k (from props).
_REGION = f"case when event_id % 4 <> 0 then {_pick('(user_id + k % 7) % 5', repr('US'), repr('DE'), repr('IN'), repr('BR'), 'null')} end"
_CLIENT = "case when k % 10 <> 9 then 'app' || k end"
BASE = {
    "timestamp": "ts",
    "unique_id": "'u' || event_id",
    "application_name": "case event_type " + " ".join(f"when '{t}' then '{a}'" for t, a in APP_OF_TYPE.items()) + " end",
    "customer_id": "'c' || (user_id % 3)",
    "actor_email": "case when event_id % 37 <> 0 then 'user' || user_id || '@example.com' end",
    "actor_profile_id": "case when event_id % 41 <> 0 then 'p' || user_id end",
    "ip_address": "case when event_id % 29 <> 0 then '10.0.' || (user_id % 250) || '.' || k end",
    "asn": "case event_id % 4 when 1 then k when 2 then cast(0 as bigint) end",
    "asn_list": "case event_id % 4 when 1 then {arr}(k) when 2 then {arr}(cast(0 as bigint), k) end",
    "region_code": _REGION,
    "subdivision_code": f"case when k % 3 <> 0 then ({_REGION}) || '-' || (k % 3) end",
    "event_type": "event_type",
    "event_name": "'n' || (k % 11)",
}
_BYTES = "cast(round(value * 100) as bigint)"
_OAUTH = {
    "oauth_client_id": _CLIENT,
    "oauth_app_name": "'Client ' || k",
    "impersonation": _pick("event_id % 4", "true", "false"),
}
_DETAILS = {"resource_detail_count": "event_id % 3"}

# What each application adds. The token scope roll-up is a stand-in here; the real one is computed from the raw form.
OWN = {
    "token": {
        "method_name": "case when k % 7 <> 6 then 'm' || (k % 7) end",
        "num_bytes": f"case when event_id % 13 <> 0 then {_BYTES} else 0 end",
        "api_name": "'api' || (k % 5)",
        "client_id": _CLIENT,
        "accessing_app_name": "case when event_id % 2 = 0 then 'App ' || k || ' beta' else 'App ' || k end",
        "client_type": _pick("k % 2", "'WEB'", "'NATIVE'"),
        "scope_count": "event_id % 5",
        "product_buckets": "case when event_id % 5 > 0 then {arr}('B' || (k % 2)) end",
        "has_drive_scope": "k % 2 = 0",
        "has_gmail_scope": "k % 3 = 0",
        "has_admin_scope": "k % 5 = 0",
    },
    "admin": {"caller_type": _pick("event_id % 3", "'USER'", "'KEY'"), **_OAUTH, **_DETAILS},
    "login": {
        "resource_ids": "case when event_id % 3 <> 0 then {arr}('r' || k) end",
        **_DETAILS,
        "login_type": _pick("k % 3", "'google_password'", "'saml'", "'reauth'"),
        "login_challenge_methods": "case event_id % 3 when 0 then {arr}('password', 'idv') when 1 then {arr}('totp') end",
        "is_suspicious": "case when event_id % 7 <> 0 then event_id % 5 = 0 end",
    },
    "drive": {
        **_OAUTH,
        "resource_ids": "case when event_id % 3 <> 0 then {arr}('r' || k, 'r' || (k + 1)) end",
        **_DETAILS,
        "user_query": "case when event_id % 6 = 0 then 'q' || k end",
        "parsed_query": "case when event_id % 6 = 0 then 'parsed q' || k end",
        "primary_event": "case when event_id % 8 <> 0 then event_id % 2 = 0 end",
        "billable": "event_id % 3 = 0",
        "originating_app_id": "'o' || (k % 13)",
        "actor_is_collaborator_account": "case when event_id % 2 = 0 then user_id % 9 = 0 end",
        "resource_id_count": "case when event_id % 3 <> 0 then 2 else 0 end",
        "applied_label_count": "(event_id % 3) * 2",
        "applied_label_titles": "case when event_id % 3 <> 0 then case when k % 2 = 1 then {arr}('T' || (k % 4), 'T9') "
        "else {arr}('T' || (k % 4)) end end",
    },
    "saml": {
        "saml_sp_name": "'sp' || (k % 12)",
        "orgunit_path": "'/ou/' || (user_id % 7)",
        "initiated_by": _pick("k % 2", "'idp'", "'sp'"),
        "saml_status_code": "case when k % 9 <> 0 then 'SUCCESS_URI' else 'FAILURE_URI' end",
        "saml_second_level_status_code": "case when k % 9 = 0 then 'S' || (k % 4) end",
        "saml_failure_type": "case when k % 9 = 0 then 'F' || (k % 5) end",
    },
}

# All activities in the shape of the stacked facts.
AUDIT = {
    "source": BASE["application_name"],
    "timestamp": "ts",
    "unique_id": BASE["unique_id"],
    "user_key": BASE["actor_profile_id"],
    "actor_email": BASE["actor_email"],
    "actor_profile_id": BASE["actor_profile_id"],
    "ip_key": BASE["ip_address"],
    "app_id": f"case when event_type in ('click', 'error', 'signup') then {_CLIENT} end",
    "region_code": BASE["region_code"],
    "subdivision_code": BASE["subdivision_code"],
    "num_bytes": f"case when event_id % 13 <> 0 then {_BYTES} end",
    "method_name": OWN["token"]["method_name"],
    "caller_type": OWN["admin"]["caller_type"],
    "impersonation": _OAUTH["impersonation"],
}

# Line items as scope facts: the order is the event, the part's brand the scope.
BASKET = {
    "event_date": "cast(l_shipdate as date)",
    "unique_id": "l_orderkey",
    "user_key": "o_custkey",
    "ip_key": "l_suppkey",
    "scope_key": "p_brand",
    "scope_name": "p_brand",
    "scope_family": "substring(p_brand, 1, 7)",
    "product_bucket": _pick("cast(substring(p_brand, 7) as int) % 5", "'GMAIL'", "'OTHER'"),
    "service": _pick("cast(substring(p_brand, 7) as int) % 4", "'admin'", "'other'", "'sheets'"),
    "is_readonly": "p_size % 2 = 0",
}


def select_list(columns: dict[str, str], array: str) -> list[str]:
    return [f'{sql.replace("{arr}", array)} as {name}' for name, sql in columns.items()]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_k(events: DataFrame) -> DataFrame:
    return events.selectExpr("*", "cast(get_json_object(props, '$.k') as bigint) as k")


def processed(spark: SparkSession, sf_dir: str, app: str) -> DataFrame:
    """Processed rows of one application; its filter reaches the scan."""
    rows = with_k(read(spark, sf_dir, "events").filter(F.col("event_type") == TYPE_OF_APP[app]))
    return rows.selectExpr(*select_list({**BASE, **OWN[app]}, "array"))


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {a: stage(processed(spark, sf_dir, a), a) for a in APPS}


# (name, bucket) of an event's scopes; every second event names them without buckets.
_NAMES = "array(" + ", ".join(f"'{n}'" for n, _ in SCOPES) + ")"
_BUCKETS = "array(" + ", ".join("null" if b is None else f"'{b}'" for _, b in SCOPES) + ")"
_INDEX = f"cast((k + 3 * j) % {len(SCOPES)} as int)"
SCOPE_PAIRS = (
    "case when event_id % 5 > 0 then transform(sequence(0, cast(event_id % 5 as int) - 1), j -> "
    f"named_struct('scope_name', get({_NAMES}, {_INDEX}), "
    f"'product_bucket', case when event_id % 2 = 0 then get({_BUCKETS}, {_INDEX}) end)) end"
)


def token_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope rows of the token events: timestamp, unique_id, scope_name, product_bucket."""
    rows = with_k(read(spark, sf_dir, "events").filter(F.col("event_type") == "click"))
    return rows.selectExpr("ts as timestamp", f"{BASE['unique_id']} as unique_id", f"inline({SCOPE_PAIRS})")


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All activities in the shape of the stacked facts."""
    rows = with_k(read(spark, sf_dir, "events")).selectExpr(*select_list(AUDIT, "array"))
    return stage(rows, "")


def address_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with place and network, in the shape of the address dimension."""
    rows = with_k(read(spark, sf_dir, "events")).selectExpr(*select_list(BASE, "array"))
    known = rows.filter(F.col("ip_address").isNotNull() & F.col("asn").isNotNull())
    known = fold_rows(known.select("ip_address", "region_code", "subdivision_code", "asn"))
    return known.groupBy(F.col("ip_address").alias("ip_key")).agg(
        *(F.max(c).alias(c) for c in ("region_code", "subdivision_code", "asn"))
    )


def baskets(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Line items as scope facts; with `tasks`, in as many partitions by event."""
    item = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    order = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = item.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if tasks is not None:
        rows, order = rows.repartition(tasks, "l_orderkey"), order.repartition(tasks, "o_orderkey")
    rows = rows.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.selectExpr(*select_list(BASKET, "array"))


# --- the same activities as raw JSON lines ---

_PARAM_TYPES = {
    "value": "string",
    "boolValue": "boolean",
    "intValue": "string",
    "multiValue": "array<string>",
    "multiMessageValue": "array<struct<parameter:array<struct<name:string,value:string,multiValue:array<string>>>>>",
}


def _p(name: str, field: str, sql: str, when: str | None = None) -> str:
    """One event parameter with every field present, so that the structs agree; null unless `when`."""
    fields = ", ".join(f"'{f}', cast({sql if f == field else 'null'} as {t})" for f, t in _PARAM_TYPES.items())
    made = f"named_struct('name', '{name}', {fields})"
    return made if when is None else f"case when {when} then {made} end"


def _present(names: dict[str, str], own: dict[str, str], field: str) -> list[str]:
    return [_p(n, field, own[c], f"({own[c]}) is not null") for n, c in names.items()]


def _raw_params(app: str) -> list[str]:
    own = OWN[app]
    if app == "token":
        message = (
            "named_struct('parameter', array("
            "named_struct('name', 'scope_name', 'value', s.scope_name, 'multiValue', cast(null as array<string>)), "
            "named_struct('name', 'product_bucket', 'value', cast(null as string), "
            "'multiValue', case when s.product_bucket is not null then array(s.product_bucket) end)))"
        )
        return [
            # a repeated name: the later one counts
            _p("client_id", "value", "'an earlier value'", "event_id % 17 = 0"),
            *_present({"method_name": "method_name"}, own, "value"),
            _p("num_response_bytes", "intValue", _BYTES, "event_id % 13 <> 0"),
            _p("api_name", "value", own["api_name"]),
            _p("client_id", "value", _CLIENT, "k % 10 <> 9 or event_id % 17 = 0"),
            _p("app_name", "value", own["accessing_app_name"]),
            _p("client_type", "value", own["client_type"]),
            _p("scope_data", "multiMessageValue", f"transform({SCOPE_PAIRS}, s -> {message})", "event_id % 5 > 0 and event_id % 2 = 0"),
            _p("scope", "multiValue", f"transform({SCOPE_PAIRS}, s -> s.scope_name)", "event_id % 5 > 0 and event_id % 2 = 1"),
            _p("product_bucket", "value", "'drive'", "event_id % 5 = 0 and event_id % 3 = 0"),
        ]
    if app == "login":
        return [
            _p("login_type", "value", own["login_type"]),
            _p("login_challenge_method", "multiValue", "array('password', 'idv')", "event_id % 3 = 0"),
            _p("login_challenge_method", "value", "'totp'", "event_id % 3 = 1"),
            *_present({"is_suspicious": "is_suspicious"}, own, "boolValue"),
        ]
    if app == "drive":
        texts = {n: n for n in ("user_query", "parsed_query", "originating_app_id")}
        flags = {n: n for n in ("primary_event", "billable", "actor_is_collaborator_account")}
        return _present(texts, own, "value") + _present(flags, own, "boolValue")
    if app == "saml":
        sent = {n: n for n in ("orgunit_path", "initiated_by", "saml_status_code", "saml_second_level_status_code")}
        return _present({**sent, "application_name": "saml_sp_name", "failure_type": "saml_failure_type"}, own, "value")
    return []


def raw_lines(spark: SparkSession, sf_dir: str, app: str, broken: bool = False) -> DataFrame:
    """One JSON text per activity. `broken` spoils some lines in a known way, for the dead letters: each of the eight faults."""
    base, own = BASE, OWN[app]

    def spoilt(fault: int, value: str) -> str:
        return f"case when event_id % 19 <> {fault} then {value} end" if broken else value

    time = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
    if broken:
        time = f"case event_id % 19 when 0 then null when 1 then 'not a time' else {time} end"
    params = _raw_params(app)
    if broken:
        unnamed = _p("x", "value", "'y'").replace("'name', 'x'", "'name', cast(null as string)")
        params.append(f"case when event_id % 19 = 5 then {unnamed} end")
    param_list = f"array_compact(array({', '.join(params)}))" if params else "cast(null as array<int>)"

    def col(name: str, dtype: str) -> str:
        return f"cast({own.get(name, 'null').replace('{arr}', 'array')} as {dtype})"

    label = f"array(named_struct('id', {spoilt(7, repr('l1'))}, 'title', 'T' || (k % 4)), named_struct('id', 'l2', 'title', case when k % 2 = 1 then 'T9' end))"
    labels = label if app == "drive" else f"case when false then {label} end"
    parts = {
        "id": f"named_struct('time', {time}, 'uniqueQualifier', {base['unique_id']}, "
        f"'applicationName', {base['application_name']}, 'customerId', {base['customer_id']})",
        "actor": spoilt(3, f"named_struct('callerType', {col('caller_type', 'string')}, 'email', {base['actor_email']}, "
        f"'profileId', {base['actor_profile_id']}, 'applicationInfo', named_struct("
        f"'oauthClientId', {col('oauth_client_id', 'string')}, 'applicationName', {col('oauth_app_name', 'string')}, "
        f"'impersonation', {col('impersonation', 'boolean')}))"),
        "events": f"array(named_struct('name', {spoilt(4, base['event_name'])}, 'type', event_type, "
        f"'resourceIds', {col('resource_ids', 'array<string>')}, 'parameters', {param_list}))",
        "ipAddress": base["ip_address"],
        "networkInfo": "case when event_id % 4 <> 0 then named_struct("
        f"'ipAsn', case when event_id % 4 = 3 then cast(array() as array<bigint>) else {base['asn_list'].replace('{arr}', 'array')} end, "
        f"'regionCode', {base['region_code']}, 'subdivisionCode', {base['subdivision_code']}) end",
        "resourceDetails": "case when event_id % 3 > 0 then transform(sequence(1, cast(event_id % 3 as int)), "
        f"i -> named_struct('id', {spoilt(6, repr('d') + ' || i')}, 'appliedLabels', {labels})) end",
    }
    text = "to_json(named_struct(" + ", ".join(f"'{n}', {sql}" for n, sql in parts.items()) + "))"
    if broken:
        # a cut-off document
        text = f"case when event_id % 19 = 2 then substring({text}, 1, 20) else {text} end"
    # a row group is read by one task; the JSON work on its rows goes to all, and the generator keeps filters on it from going back
    rows = with_k(read(spark, sf_dir, "events").filter(F.col("event_type") == TYPE_OF_APP[app]).repartition("event_id"))
    return rows.selectExpr(f"explode(array({text})) as value", "event_id")
