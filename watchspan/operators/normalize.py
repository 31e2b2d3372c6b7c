"""Nested activities to flat, typed rows, one function per application.

Everything is a built-in expression, so a whole application flattens in one narrow stage without a
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from watchspan.functions.params import param_sql, scope_list_sql
from watchspan.functions.scopes import is_readonly, scope_family, scope_service
from watchspan.schemas import EVENT_SCHEMAS, SCOPE_SCHEMA

_BASE = {
    "timestamp": "try_to_timestamp(id.time)",
    "unique_id": "id.uniqueQualifier",
    "application_name": "id.applicationName",
    "customer_id": "id.customerId",
    "actor_email": "actor.email",
    "actor_profile_id": "actor.profileId",
    "caller_type": "actor.callerType",
    "oauth_client_id": "actor.applicationInfo.oauthClientId",
    "oauth_app_name": "actor.applicationInfo.applicationName",
    "impersonation": "actor.applicationInfo.impersonation",
    "ip_address": "ipAddress",
    "asn": "get(networkInfo.ipAsn, 0)",
    "asn_list": "case when size(networkInfo.ipAsn) > 0 then networkInfo.ipAsn end",
    "region_code": "networkInfo.regionCode",
    "subdivision_code": "networkInfo.subdivisionCode",
    "event_type": "_event.type",
    "event_name": "_event.name",
    "resource_ids": "_event.resourceIds",
    "resource_detail_count": "coalesce(size(resourceDetails), 0)",
}


def _first_event(df: DataFrame) -> DataFrame:
    """Only the first event of an activity is used; it is null when there is none."""
    return df.selectExpr("*", "get(events, 0) as _event")


def _named(exprs: dict[str, str]) -> list[str]:
    return [f"{sql} as {name}" for name, sql in exprs.items()]


def base_record(df: DataFrame) -> DataFrame:
    """The columns all applications share, next to the nested activity."""
    return _first_event(df).selectExpr(*_named(_BASE))


def project_app(df: DataFrame, app: str, own: dict[str, str]) -> DataFrame:
    """The application's table: its columns in its order and types, and nothing else."""
    exprs = {**_BASE, **own}
    return _first_event(df).selectExpr(
        *(f"cast({exprs[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in EVENT_SCHEMAS[app].fields)
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types."""
    return df.selectExpr(*(f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema.fields))


def _sorted_distinct(array: str) -> str:
    """Sorted distinct non-empty texts; an empty array when nothing is left."""
    return f"sort_array(array_distinct(filter({array}, x -> x <> '')))"


def _filled(array: str) -> str:
    return f"case when size({array}) > 0 then {array} end"


_TOKEN = {
    "method_name": param_sql("method_name"),
    "num_bytes": param_sql("num_response_bytes", "bigint", "0"),
    "api_name": param_sql("api_name"),
    "client_id": param_sql("client_id"),
    "accessing_app_name": param_sql("app_name"),
    "client_type": param_sql("client_type"),
    "scope_count": "coalesce(size(_scopes), 0)",
    "product_buckets": _filled("_buckets"),
    "has_drive_scope": "coalesce(array_contains(_buckets, 'DRIVE'), false)",
    "has_gmail_scope": "coalesce(array_contains(_buckets, 'GMAIL'), false)",
    "has_admin_scope": "coalesce(array_contains(_buckets, 'GSUITE_ADMIN'), false)",
}


def flatten_token(df: DataFrame) -> DataFrame:
    """With the scope roll-up; without scopes the upper-cased `product_bucket` parameter stands in."""
    scoped = df.selectExpr("*", f"{scope_list_sql('get(events, 0).parameters')} as _scopes")
    from_scopes = _sorted_distinct("transform(_scopes, s -> s.product_bucket)")
    from_param = _sorted_distinct(f"array(upper({param_sql('product_bucket', params='get(events, 0).parameters')}))")
    buckets = f"case when size(_scopes) > 0 then {from_scopes} else {from_param} end"
    return project_app(scoped.selectExpr("*", f"{buckets} as _buckets"), "token", _TOKEN)


def explode_scopes(df: DataFrame) -> DataFrame:
    """One row per scope of a token activity, classified."""
    rows = df.selectExpr(
        "try_to_timestamp(id.time) as timestamp",
        "id.uniqueQualifier as unique_id",
        f"inline({scope_list_sql('get(events, 0).parameters')})",
    )
    return conform(classify_scopes(rows), SCOPE_SCHEMA)


def classify_scopes(df: DataFrame, name: str = "scope_name", bucket: str = "product_bucket") -> DataFrame:
    """Add family, service and the read-only flag to rows that hold a scope name."""
    return df.withColumns(
        {
            "scope_family": scope_family(df[name]),
            "service": scope_service(df[name], df[bucket]),
            "is_readonly": is_readonly(df[name]),
        }
    )


def flatten_admin(df: DataFrame) -> DataFrame:
    return project_app(df, "admin", {})


_LOGIN = {
    "login_type": param_sql("login_type"),
    "login_challenge_methods": param_sql("login_challenge_method", "array<string>"),
    "is_suspicious": param_sql("is_suspicious", "boolean"),
}


def flatten_login(df: DataFrame) -> DataFrame:
    return project_app(df, "login", _LOGIN)


_LABELS = "flatten(transform(resourceDetails, d -> coalesce(transform(d.appliedLabels, l -> coalesce(l.title, '')), array())))"

_DRIVE = {
    **{n: param_sql(n) for n in ("user_query", "parsed_query", "originating_app_id")},
    **{n: param_sql(n, "boolean") for n in ("primary_event", "billable", "actor_is_collaborator_account")},
    "resource_id_count": "coalesce(size(_event.resourceIds), 0)",
    "applied_label_count": "coalesce(size(_titles), 0)",
    "applied_label_titles": _filled(_sorted_distinct("_titles")),
}


def flatten_drive(df: DataFrame) -> DataFrame:
    """Labels are counted over all resources, with their distinct titles."""
    return project_app(df.selectExpr("*", f"{_LABELS} as _titles"), "drive", _DRIVE)


_SAML = {
    **{n: param_sql(n) for n in ("orgunit_path", "initiated_by", "saml_status_code", "saml_second_level_status_code")},
    "saml_sp_name": param_sql("application_name"),
    "saml_failure_type": param_sql("failure_type"),
}


def flatten_saml(df: DataFrame) -> DataFrame:
    return project_app(df, "saml", _SAML)


def flatten_generic(df: DataFrame) -> DataFrame:
    """All common columns plus the parameters as a name-to-text map, null when there are none."""
    text = (
        "coalesce(cast(p.boolValue as string), p.intValue, to_json(p.multiValue), "
        "to_json(p.multiMessageValue), p.value)"
    )
    # repeated names: the session keeps the last (mapKeyDedupPolicy)
    entries = f"map_from_entries(transform(_event.parameters, p -> struct(p.name, {text})))"
    as_map = f"case when size(_event.parameters) > 0 then {entries} end"
    return _first_event(df).selectExpr(*_named({**_BASE, "parameters": as_map}))


FLATTENERS = {
    "token": flatten_token,
    "admin": flatten_admin,
    "login": flatten_login,
    "drive": flatten_drive,
    "saml": flatten_saml,
}


def normalize(df: DataFrame, app: str) -> DataFrame:
    """Flatten activities of one application into its table schema."""
    return FLATTENERS[app](df)
