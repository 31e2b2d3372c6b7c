"""Schemas of raw activities, processed tables, run manifests and control rows."""

from __future__ import annotations

from pyspark.sql import types as T

APPS = ("token", "login", "saml", "admin", "drive")


S, B, L, I, TS = T.StringType(), T.BooleanType(), T.LongType(), T.IntegerType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    """All columns are nullable."""
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, S)


def _list(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(_struct(**fields))


SL = T.ArrayType(S)
_TYPES = {
    "string": S, "boolean": B, "bigint": L, "int": I, "timestamp": TS, "array<string>": SL, "array<bigint>": T.ArrayType(L),
}


def _columns(text: str) -> T.StructType:
    """A flat table from `name type` pairs."""
    pairs = (column.split() for column in text.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The fields of a raw activity that are read.
_REASON = _struct(reasonType=S)
_LABELS = _list(
    **_texts("id", "title"),
    reason=_REASON,
    fieldValues=_list(
        **_texts("id", "displayName", "type"),
        selectionValue=_struct(id=S, displayName=S, badged=B),
        reason=_REASON,
    ),
)
# intValue arrives quoted or bare, so it is read as text and cast later.
_PARAMETERS = _list(
    name=S, value=S, boolValue=B, intValue=S, multiValue=SL,
    multiMessageValue=_list(parameter=_list(name=S, value=S, multiValue=SL)),
)
RAW_ACTIVITY = _struct(
    id=_struct(**_texts("time", "uniqueQualifier", "applicationName", "customerId")),
    actor=_struct(
        **_texts("callerType", "email", "profileId"),
        applicationInfo=_struct(oauthClientId=S, applicationName=S, impersonation=B),
    ),
    events=_list(name=S, type=S, resourceIds=SL, parameters=_PARAMETERS),
    ipAddress=S,
    networkInfo=_struct(ipAsn=T.ArrayType(L), regionCode=S, subdivisionCode=S),
    resourceDetails=_list(**_texts("id", "title", "type", "relation"), appliedLabels=_LABELS),
    kind=S,
    etag=S,
)

CORRUPT = "_corrupt_record"
RAW_ACTIVITY_CHECKED = T.StructType(RAW_ACTIVITY.fields + [T.StructField(CORRUPT, S)])

# Names, order and types of the processed tables.
EVENT_SCHEMAS = {
    "token": _columns(
        "timestamp timestamp, unique_id string, application_name string, customer_id string, actor_email string, "
        "actor_profile_id string, ip_address string, asn bigint, asn_list array<bigint>, region_code string, "
        "subdivision_code string, event_type string, event_name string, method_name string, num_bytes bigint, "
        "api_name string, client_id string, accessing_app_name string, client_type string, scope_count bigint, "
        "product_buckets array<string>, has_drive_scope boolean, has_gmail_scope boolean, has_admin_scope boolean"
    ),
    "login": _columns(
        "timestamp timestamp, unique_id string, application_name string, customer_id string, actor_email string, "
        "actor_profile_id string, ip_address string, asn bigint, asn_list array<bigint>, region_code string, "
        "subdivision_code string, event_type string, event_name string, resource_ids array<string>, "
        "resource_detail_count bigint, login_type string, login_challenge_methods array<string>, "
        "is_suspicious boolean"
    ),
    "saml": _columns(
        "timestamp timestamp, unique_id string, application_name string, customer_id string, actor_email string, "
        "actor_profile_id string, ip_address string, asn bigint, asn_list array<bigint>, region_code string, "
        "subdivision_code string, event_type string, event_name string, saml_sp_name string, orgunit_path string, "
        "initiated_by string, saml_status_code string, saml_second_level_status_code string, saml_failure_type string"
    ),
    "admin": _columns(
        "timestamp timestamp, unique_id string, application_name string, customer_id string, actor_email string, "
        "actor_profile_id string, caller_type string, oauth_client_id string, oauth_app_name string, "
        "impersonation boolean, ip_address string, asn bigint, asn_list array<bigint>, region_code string, "
        "subdivision_code string, event_type string, event_name string, resource_detail_count bigint"
    ),
    "drive": _columns(
        "timestamp timestamp, unique_id string, application_name string, customer_id string, actor_email string, "
        "actor_profile_id string, oauth_client_id string, oauth_app_name string, impersonation boolean, "
        "ip_address string, asn bigint, asn_list array<bigint>, region_code string, subdivision_code string, "
        "event_type string, event_name string, resource_ids array<string>, resource_detail_count bigint, "
        "user_query string, parsed_query string, primary_event boolean, billable boolean, originating_app_id string, "
        "actor_is_collaborator_account boolean, resource_id_count bigint, applied_label_count bigint, "
        "applied_label_titles array<string>"
    ),
}
SCOPE_SCHEMA = _columns(
    "timestamp timestamp, unique_id string, scope_name string, scope_family string, product_bucket string, "
    "service string, is_readonly boolean"
)

# Manifests of fetch runs and rows of the control log.
MANIFEST = _struct(
    start=TS, end=TS, run_id=S, earliest_event_time=TS, latest_event_time=TS, num_windows=I, num_events=L,
    windows=_list(idx=I, start=TS, end=TS),
)

CONTROL = _columns(
    "app string, stage string, cursor timestamp, last_run timestamp, run_id string, snapshot_path string, status string, "
    "updated_at timestamp"
)


def processed_schema(app: str, kind: str = "events") -> T.StructType:
    """The fixed schema of a processed table."""
    if kind == "events":
        return T.StructType(list(EVENT_SCHEMAS[app].fields))
    if kind == "event_scopes" and app == "token":
        return T.StructType(list(SCOPE_SCHEMA.fields))
    raise ValueError(f"no processed table {kind!r} for application {app!r}")
