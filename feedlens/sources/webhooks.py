"""Webhook deliveries derived from the ``events`` table (the S6 test feed).

Each event becomes one signed delivery ``(body, signature, received_at)``:
the body is the event as tracker-style JSON, the signature the HMAC-SHA256 of
the body under a test key.  Some deliveries are deliberately damaged so every
branch of verification is exercised: upper-case hex (rejected), a missing
header (rejected), blanks around the signature (accepted), a truncated body
with a valid signature (bad JSON), and an event that carries its own
``receivedAt`` (kept over the arrival time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.crypto import hmac_sha256_hex, signing_key
from feedlens.sources.tables import Tables
from feedlens.sources.tracker import TrackerViews

# Fixed values of the test feed.
TEST_KEY = "feedlens-webhook-test-key"
EVENT_TYPES = {"click": "Issue", "view": "IssueLabel", "purchase": "Comment", "signup": "Project"}
OTHER_TYPE = "Error"


def _json_str(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def deliveries_from_events(spark: SparkSession, sf_dir: str, key: str = TEST_KEY) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    k = F.get_json_object("props", "$.k").try_cast("int")
    etype = F.col("event_type")
    t = None
    for src, dst in EVENT_TYPES.items():
        t = F.when(etype == src, F.lit(dst)) if t is None else t.when(etype == src, F.lit(dst))
    t = t.otherwise(F.lit(OTHER_TYPE))
    dt = F.when(etype == "purchase", F.lit("Issue")).otherwise(F.lit("Event"))
    own_stamp = F.when(etype == "view", F.concat(
        F.lit(',"receivedAt":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z"'))
    ).otherwise(F.lit(""))
    closing = F.when((etype == "error") & (k < 20), F.lit("")).otherwise(F.lit("}"))
    body = F.concat(F.lit('{"type":'), _json_str(t), F.lit(',"action":'), _json_str(etype),
                    F.lit(',"data":{"id":'), _json_str((F.col("event_id") * 2).cast("string")),
                    F.lit(',"type":'), _json_str(dt), F.lit('},"eventId":'),
                    F.col("event_id").cast("string"), own_stamp, F.lit(',"props":'),
                    F.col("props"), closing)
    signed = ev.select(F.col("ts").alias("received_at"), body.alias("_body"), k.alias("_k"))
    sig = hmac_sha256_hex(F.col("_body"), signing_key(spark, key))
    kk = F.col("_k")
    signature = (F.when(kk >= 90, F.upper(sig)).when(kk < 5, F.lit(None).cast("string"))
                 .when(kk.between(40, 44), F.concat(F.lit(" "), sig, F.lit(" ")))
                 .otherwise(sig))
    return signed.select(F.col("_body").cast("binary").alias("body"), signature.alias("signature"),
                         "received_at")


#: Fixed value of the test feed: the first day of the events.
FIRST_DAY = "2024-01-01 00:00:00"


def issue_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history for the issues, from their lineitems: line ``n`` is the version valid from day
    ``4 * (n - 1) + id mod 4`` of the feed on; its state names line, status and return flag."""
    t, v = Tables(spark, sf_dir), TrackerViews(spark, sf_dir)
    state = F.concat_ws(" ", F.col("l_linenumber").cast("string"), "l_linestatus", "l_returnflag")
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max(state).alias("state_name"))
    day = 4 * (F.col("l_linenumber") - 1) + F.col("l_orderkey") % 4
    teams = v.teams.select(F.col("id").alias("_tid"), F.col("name").alias("team_name"))
    issues = (v.issues.join(teams, F.col("team_id") == F.col("_tid"), "left")
              .select(F.col("id").alias("_iid"), "identifier", "title", "team_name"))
    return (lines.join(issues, F.col("l_orderkey") == F.col("_iid"))
            .select(F.col("_iid").alias("id"), (F.lit(FIRST_DAY).cast("timestamp_ntz") + F.make_dt_interval(day)).alias("valid_from"),
                    "identifier", "title", "state_name", "team_name"))
