"""Raw activities: edge rows of parsing, parameters, scopes and labels."""

import json

import pytest
from pyspark.sql import functions as F

from watchspan.operators import normalize as N
from watchspan.sources.raw import activities_of, parse_lines, split_errors

GOOGLE = "https://www.googleapis.com/auth/"


def activity(uid="u1", time="2025-11-27T03:11:11.616Z", events=None, **rest):
    doc = {
        "id": {"time": time, "uniqueQualifier": uid, "applicationName": "token", "customerId": "c1"},
        "actor": {"email": "a@example.com", "profileId": "p1"},
        "ipAddress": "192.0.2.1",
        "networkInfo": {"ipAsn": [64500, 7], "regionCode": "US", "subdivisionCode": "US-CA"},
        "events": [event()] if events is None else events,
    }
    doc.update(rest)
    return doc


def event(*params, name="activity", type="auth", **rest):
    return {"name": name, "type": type, "parameters": list(params), **rest}


def scope_message(name=None, bucket=None):
    parts = []
    if name is not None:
        parts.append({"name": "scope_name", "value": name})
    if bucket is not None:
        parts.append({"name": "product_bucket", "multiValue": bucket})
    return {"parameter": parts}


def parsed(spark, *docs):
    lines = [(d if isinstance(d, str) else json.dumps(d),) for d in docs]
    return parse_lines(spark.createDataFrame(lines, "value string"))


def flat(spark, app, *docs):
    good, bad = split_errors(parsed(spark, *docs))
    assert bad.count() == 0
    return N.normalize(good, app).collect()


def test_base_record(spark):
    row = flat(spark, "token", activity())[0]
    assert str(row.timestamp) == "2025-11-27 03:11:11.616000"
    assert (row.unique_id, row.asn, row.asn_list, row.region_code) == ("u1", 64500, [64500, 7], "US")
    assert (row.num_bytes, row.scope_count, row.product_buckets, row.has_drive_scope) == (0, 0, None, False)


def test_empty_network_list_and_missing_network(spark):
    empty, none = flat(
        spark, "token", activity(networkInfo={"ipAsn": [], "regionCode": "DE"}), activity(networkInfo=None)
    )
    assert (empty.asn, empty.asn_list, empty.region_code) == (None, None, "DE")
    assert (none.asn, none.asn_list, none.region_code) == (None, None, None)


def test_only_first_event_counts(spark):
    none, two = flat(
        spark, "admin", activity(events=[]), activity(events=[event(name="first"), event(name="second")])
    )
    assert (none.event_name, none.event_type, none.resource_detail_count) == (None, None, 0)
    assert two.event_name == "first"


def test_parameters(spark):
    row = flat(
        spark,
        "token",
        activity(
            events=[
                event(
                    {"name": "client_id", "value": "old"},
                    {"name": "client_id", "value": "app1"},
                    {"name": "num_response_bytes", "intValue": "120"},
                    {"name": "method_name", "value": "files.list"},
                    {"name": "app_name", "value": "App"},
                )
            ]
        ),
    )[0]
    assert (row.client_id, row.num_bytes, row.method_name, row.accessing_app_name) == ("app1", 120, "files.list", "App")
    bare = flat(spark, "token", activity(events=[event({"name": "num_response_bytes", "intValue": 7})]))[0]
    assert bare.num_bytes == 7


def test_scope_rollup_and_rows(spark):
    doc = activity(
        events=[
            event(
                {
                    "name": "scope_data",
                    "multiMessageValue": [
                        scope_message(GOOGLE + "drive.readonly", ["DRIVE", "OTHER"]),
                        scope_message(GOOGLE + "gmail.send", []),
                        scope_message(None, ["GMAIL"]),
                        scope_message("openid", ["IDENTITY"]),
                    ],
                },
                {"name": "scope", "multiValue": ["ignored"]},
            )
        ]
    )
    row = flat(spark, "token", doc)[0]
    assert (row.scope_count, row.product_buckets) == (3, ["DRIVE", "IDENTITY"])
    assert (row.has_drive_scope, row.has_gmail_scope, row.has_admin_scope) == (True, False, False)
    good, _ = split_errors(parsed(spark, doc))
    scopes = {r.scope_name: r for r in N.explode_scopes(good).collect()}
    assert scopes[GOOGLE + "drive.readonly"].is_readonly and scopes[GOOGLE + "drive.readonly"].service == "drive"
    assert scopes[GOOGLE + "gmail.send"].product_bucket is None and scopes[GOOGLE + "gmail.send"].service == "gmail"
    assert scopes["openid"].scope_family is None and len(scopes) == 3


def test_scope_list_only_without_messages(spark):
    listed = activity(events=[event({"name": "scope", "multiValue": [GOOGLE + "spreadsheets", "x"]})])
    nameless = activity(
        events=[
            event(
                {"name": "scope_data", "multiMessageValue": [scope_message(None, ["DRIVE"])]},
                {"name": "scope", "multiValue": ["x"]},
                {"name": "product_bucket", "value": "drive"},
            )
        ]
    )
    first, second = flat(spark, "token", listed, nameless)
    assert (first.scope_count, first.product_buckets) == (2, None)
    # a message without a name still keeps the plain list out; the bucket parameter stands in
    assert (second.scope_count, second.product_buckets, second.has_drive_scope) == (0, ["DRIVE"], True)


@pytest.mark.parametrize(
    "name, bucket, family, service",
    [
        (GOOGLE + "calendar.addons.current.event.read", None, "calendar.addons", "calendar"),
        (GOOGLE + "admin.directory.user.readonly", "OTHER", "admin", "admin"),
        (GOOGLE + "nothing.known", None, "nothing", "other"),
        (GOOGLE, None, None, "other"),
        (GOOGLE + "userinfo.email", None, "userinfo", "identity"),
        ("https://www.google.com/accounts/OAuthLogin", None, None, "identity"),
        ("OpenID", None, None, "identity"),
        ("anything", "GMAIL", None, "gmail"),
        ("", None, None, "other"),
    ],
)
def test_scope_classes(spark, name, bucket, family, service):
    rows = spark.createDataFrame([(name, bucket)], "scope_name string, product_bucket string")
    row = N.classify_scopes(rows).first()
    assert (row.scope_family, row.service) == (family, service)


def test_login_drive_saml(spark):
    login = flat(
        spark,
        "login",
        activity(events=[event({"name": "login_challenge_method", "value": "totp"}, {"name": "is_suspicious", "boolValue": False})]),
        activity(events=[event({"name": "login_challenge_method", "multiValue": ["a", "b"]})]),
        activity(),
    )
    assert [r.login_challenge_methods for r in login] == [["totp"], ["a", "b"], None]
    assert [r.is_suspicious for r in login] == [False, None, None]
    details = [
        {"id": "d1", "appliedLabels": [{"id": "l1", "title": "Z"}, {"id": "l2"}]},
        {"id": "d2", "appliedLabels": [{"id": "l3", "title": "A"}, {"id": "l4", "title": "Z"}]},
        {"id": "d3"},
    ]
    drive = flat(spark, "drive", activity(events=[event(resourceIds=["r1", "r2"])], resourceDetails=details), activity())
    assert (drive[0].applied_label_count, drive[0].applied_label_titles) == (4, ["A", "Z"])
    assert (drive[0].resource_id_count, drive[0].resource_detail_count) == (2, 3)
    assert (drive[1].applied_label_count, drive[1].applied_label_titles, drive[1].resource_id_count) == (0, None, 0)
    saml = flat(spark, "saml", activity(events=[event({"name": "application_name", "value": "sp"}, {"name": "failure_type", "value": "f"})]))[0]
    assert (saml.saml_sp_name, saml.saml_failure_type) == ("sp", "f")


def test_generic_record_keeps_last_of_repeated_names(spark):
    good, _ = split_errors(
        parsed(spark, activity(events=[event({"name": "a", "value": "1"}, {"name": "a", "boolValue": True})]), activity())
    )
    rows = N.flatten_generic(good).select("parameters").collect()
    assert rows[0].parameters == {"a": "true"} and rows[1].parameters is None


def test_dead_letters_keep_the_line_and_never_stop_the_job(spark):
    wrong_type = json.dumps(activity()).replace('"events": [', '"events": "x", "other": [')
    bad_lines = {
        "nope": "malformed",
        '{"id": {"time": "2025-01-01T00:00:00Z"}}': "missing actor",
        json.dumps(activity(time=None)): "missing activity timestamp",
        json.dumps(activity(time="yesterday")): "invalid activity timestamp",
        json.dumps(activity(events=[{"type": "t"}])): "event without name or type",
        json.dumps(activity(events=[event({"value": "x"})])): "parameter without name",
        json.dumps(activity(resourceDetails=[{"title": "x"}])): "resource without id",
        json.dumps(activity(resourceDetails=[{"id": "d", "appliedLabels": [{"title": "x"}]}])): "label without id",
        wrong_type: "wrong type",
        "[1, 2]": "malformed",
    }
    good, bad = split_errors(parsed(spark, activity(), "  ", *bad_lines))
    assert good.count() == 1
    errors = {r.raw: r.error for r in bad.collect()}
    assert set(errors) == set(bad_lines)
    assert all(part in errors[line] for line, part in bad_lines.items())


def test_parse_happens_once(spark):
    good, _ = split_errors(parsed(spark, activity()))
    plan = N.normalize(good, "token")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_mixed_shapes(spark):
    doc = json.dumps(activity())
    texts = [(f'{{"items": [{doc}, {doc}]}}',), (f"[{doc}]",), (doc,), ('{"items": []}',), ("7",)]
    assert activities_of(spark.createDataFrame(texts, "value string")).count() == 4


def test_conform_orders_and_casts(spark):
    from watchspan.schemas import SCOPE_SCHEMA

    rows = spark.range(1).select(
        F.lit(True).alias("is_readonly"), F.lit("2025-01-01").alias("timestamp"), *(F.lit("x").alias(c) for c in SCOPE_SCHEMA.names[1:6])
    )
    assert N.conform(rows, SCOPE_SCHEMA).schema.simpleString() == SCOPE_SCHEMA.simpleString()
