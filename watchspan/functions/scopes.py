"""Classification of OAuth scope names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# They decide the results and must stay as they are.
SCOPE_PREFIX = "https://www.googleapis.com/auth/"
BUCKET_SERVICES = {
    "GSUITE_ADMIN": "admin",
    "DRIVE": "drive",
    "GMAIL": "gmail",
    "APPS_SCRIPT_API": "apps_script",
    "APPS_SCRIPT_RUNTIME": "apps_script",
    "CALENDAR": "calendar",
    "IDENTITY": "identity",
}
FAMILY_SERVICES = {
    "admin": "admin",
    "apps": "admin",
    "cloud-identity": "admin",
    "cloudplatformprojects": "cloud_platform",
    "drive": "drive",
    "drive.addons": "drive",
    "datastudio": "datastudio",
    "spreadsheets": "sheets",
    "gmail": "gmail",
    "script": "apps_script",
    "sqlservice": "cloud_sql",
    "workspace": "workspace",
    "calendar": "calendar",
    "calendar.addons": "calendar",
    "userinfo": "identity",
}
IDENTITY_SCOPES = (
    "openid",
    "https://www.googleapis.com/auth/userinfo.email",
    "https://www.googleapis.com/auth/userinfo.profile",
    "https://www.google.com/accounts/oauthlogin",
)
CENSUS_FAMILY_SERVICES = {
    "admin": "admin",
    "apps": "admin",
    "cloud-identity": "admin",
    "cloudplatformprojects": "cloud_platform",
    "drive": "drive",
    "gmail": "gmail",
    "script": "apps_script",
}
CENSUS_IDENTITY_SCOPES = ("openid", "email", "profile")
HIGH_RISK_BUCKETS = ("GSUITE_ADMIN", "DRIVE", "GMAIL")
HIGH_RISK_SERVICES = ("admin", "drive", "gmail")


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def _tail(name: Column) -> Column:
    """What follows the common prefix; null for names without it."""
    return F.when(F.startswith(name, F.lit(SCOPE_PREFIX)), F.substr(name, F.lit(len(SCOPE_PREFIX) + 1)))


def _head_segments(tail: Column) -> Column:
    """First dotted segment, or the one family that spans two segments."""
    first = F.split_part(tail, F.lit("."), F.lit(1))
    second = F.split_part(tail, F.lit("."), F.lit(2))
    return F.when((first == "calendar") & (second == "addons"), F.lit("calendar.addons")).otherwise(first)


def scope_family(name: Column) -> Column:
    return F.nullif(_head_segments(_tail(name)), F.lit(""))


def scope_suffix(name: Column) -> Column:
    tail = _tail(name)
    return F.nullif(F.substr(tail, F.length(_head_segments(tail)) + 2), F.lit(""))


def scope_service(name: Column, bucket: Column) -> Column:
    """Bucket first, then family, then the rule for names outside the common prefix."""
    outside = F.when(F.lower(name).isin(*IDENTITY_SCOPES), "identity").otherwise("other")
    return F.coalesce(_lookup(BUCKET_SERVICES, bucket), _lookup(FAMILY_SERVICES, scope_family(name)), outside)


def scope_service_census(name: Column) -> Column:
    """The coarser classification of the scope census: seven families, no bucket."""
    core = F.split_part(F.split_part(_tail(name), F.lit("/"), F.lit(1)), F.lit("."), F.lit(1))
    inside = F.coalesce(_lookup(CENSUS_FAMILY_SERVICES, core), F.lit("other"))
    outside = F.when(F.lower(name).isin(*CENSUS_IDENTITY_SCOPES), "identity").otherwise("other")
    return F.when(_tail(name).isNotNull(), inside).otherwise(outside)


def is_readonly(name: Column) -> Column:
    return F.endswith(name, F.lit(".readonly"))


def is_high_risk(bucket: Column, service: Column) -> Column:
    """Never null: a missing bucket and service count as low risk."""
    return F.coalesce(bucket.isin(*HIGH_RISK_BUCKETS), F.lit(False)) | F.coalesce(
        service.isin(*HIGH_RISK_SERVICES), F.lit(False)
    )
