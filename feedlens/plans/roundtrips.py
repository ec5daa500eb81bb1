"""Registered queries that pass data through the real sources and sinks (S1-S6, K1, K3-K5,
W3): a query's result is written into the shared folder and read back.  The oracle of
each is that of the query written, so a row lost or changed on the way shows.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.operators import issues as ops
from feedlens.operators import requests as rq
from feedlens.plans import clusters, events, requests, tracker
from feedlens.plans.oracle_views import with_views
from feedlens.session import shared_folder
from feedlens.sinks.files import (ACTIVE_HEADER, LISTING_HEADER, LOAD_HEADER, TEAM_HEADER, cluster_example_columns, read_requests,
                                  write_report, write_requests, write_snapshot, write_snapshot_file)
from feedlens.sources import needs
from feedlens.sources.feedback import feedback_from_tables, read_feedback
from feedlens.sources.tracker import TrackerViews, read_entity
from feedlens.sources.webhooks import TEST_KEY, deliveries_from_events
from feedlens.streaming import events as ev

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


# -- feedback_file: S1 S2 (";" sniffed, names normalised, the index column dropped) -------------
def feedback_file(spark, sf_dir):
    fb = feedback_from_tables(spark, sf_dir)
    path = shared_folder(spark, "feedback")
    (fb.select(F.col("doc_id").alias("Unnamed: 0"), F.col("doc_id").alias("Doc_ID"), F.col("lang").alias(" Lang "),
               F.col("priority").alias("PRIORITY"), F.col("request").alias("Request"))
     .write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_feedback(spark, path)


QUERIES["feedback_file"] = feedback_file
ORACLES["feedback_file"] = with_views(["feedback"], """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, priority, request FROM feedback""")


# -- need_documents: S3 (nested documents as JSON lines) -------------------------------------
def need_documents(spark, sf_dir):
    path = shared_folder(spark, "need-docs")
    needs.issue_need_docs(spark, sf_dir).write.json(path, compression="gzip")
    return rq.issue_needs(needs.read_need_docs(spark, path)).drop("_src", "_host")


QUERIES["need_documents"] = need_documents
ORACLES["need_documents"] = requests.ORACLES["requests_nested"]


# -- request_file: K1 (request CSV out and in) ---------------------------------------------
def request_file(spark, sf_dir):
    path = shared_folder(spark, "requests")
    write_requests(requests.requests_deduped(spark, sf_dir), path)
    return read_requests(spark, path)


QUERIES["request_file"] = request_file
ORACLES["request_file"] = requests.ORACLES["requests_deduped"]


# -- entity_files: S4 S5 (every entity read with its fixed schema) ----------------------------
def entity_files(spark, sf_dir):
    v, folder = TrackerViews(spark, sf_dir), shared_folder(spark, "entities")
    read = {}
    for name in ("issues", "states", "projects", "teams", "users"):
        path = os.path.join(folder, name)
        fields = schemas.ENTITY_SCHEMAS[name].fields
        getattr(v, name).select(*[F.col(f.name).cast(f.dataType) for f in fields]).write.parquet(path)
        read[name] = read_entity(spark, name, path)
    return ops.issue_lite(ops.open_issues(read["issues"]), read["states"], read["projects"], read["teams"], read["users"])


QUERIES["entity_files"] = entity_files
ORACLES["entity_files"] = tracker.ORACLES["open_issues"]


# -- event_feed: S6 W3 K5 (landing folder, stream, feed) --------------------------------------
def event_feed(spark, sf_dir):
    folder = shared_folder(spark, "feed")
    landing, feed, log = (os.path.join(folder, d) for d in ("landing", "feed", "log"))
    raw = deliveries_from_events(spark, sf_dir)
    raw.withColumn("received_at", F.col("received_at").cast("timestamp")).write.parquet(landing)
    stream = ev.verified_events(ev.read_webhooks(spark, landing), TEST_KEY)
    ev.start_feed(stream, feed, log).awaitTermination()
    back = spark.read.parquet(feed)
    return back.withColumn("received_at", F.col("received_at").cast("timestamp_ntz"))


QUERIES["event_feed"] = event_feed
ORACLES["event_feed"] = events.ORACLES["verified_events"]


# -- event_outputs: W1 K5 (feed and rejects written by one stream, read back) ---------------------
def event_outputs(spark, sf_dir):
    folder = shared_folder(spark, "outputs")
    landing, feed, rejects, log = (os.path.join(folder, d) for d in ("landing", "feed", "rejects", "log"))
    raw = deliveries_from_events(spark, sf_dir)
    raw.withColumn("received_at", F.col("received_at").cast("timestamp")).write.parquet(landing)
    ev.start_outputs(ev.read_webhooks(spark, landing), TEST_KEY, feed, rejects, log).awaitTermination()
    both = ev.read_output(spark, feed).select(*ev.REJECT_COLUMNS).unionByName(ev.read_output(spark, rejects))
    return both.withColumn("received_at", F.col("received_at").cast("timestamp_ntz"))


QUERIES["event_outputs"] = event_outputs
ORACLES["event_outputs"] = "WITH " + events._DELIVERIES + "\nSELECT received_at, status, body FROM routed"


# -- snapshot_files: K3 (the listing section of the snapshot) ----------------------------------
def snapshot_files(spark, sf_dir):
    path = shared_folder(spark, "snapshot")
    listing = tracker.snapshot_listing(spark, sf_dir)
    write_snapshot({"issue_listing": listing}, path)
    back = spark.read.schema(listing.schema).option("header", True).option("escape", '"').csv(
        os.path.join(path, "section=issue_listing"))
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


QUERIES["snapshot_files"] = snapshot_files
ORACLES["snapshot_files"] = tracker.ORACLES["snapshot_listing"]


# -- snapshot_text: K3 (the whole sectioned file, line by line) ---------------------------------
def snapshot_text(spark, sf_dir):
    path, v = shared_folder(spark, "snapshot-text"), TrackerViews(spark, sf_dir)
    write_snapshot_file(tracker._open_lite(v), v.projects, path, with_team=True)
    lines = spark.read.text(path).filter("value <> ''")
    return lines.select(F.when(F.col("value").startswith("section,"), "header").otherwise(F.substring_index("value", ",", 1)).alias("section"),
                        F.col("value").alias("line"))


def _field(c):
    return f"CASE WHEN regexp_matches({c}, '[\",\\n\\r]') THEN '\"' || replace({c}, '\"', '\"\"') || '\"' ELSE {c} END"


QUERIES["snapshot_text"] = snapshot_text
ORACLES["snapshot_text"] = f"""
WITH a AS ({tracker.ORACLES["snapshot_listing"]}), b AS ({tracker.ORACLES["active_project_load"]}), c AS ({tracker.ORACLES["assignee_load"]})
SELECT section, concat_ws(',', section, {", ".join(map(_field, ("project", "state", "identifier", "title", "assignee", "team")))}) AS line FROM a
UNION ALL SELECT 'active_projects', concat_ws(',', 'active_projects', {_field("project_name")}, project_id, {_field("state")}, open_count) FROM b
UNION ALL SELECT 'assignee_load', concat_ws(',', 'assignee_load', {_field("assignee_name")}, open_count) FROM c
UNION ALL SELECT 'header', unnest(['{LISTING_HEADER}{TEAM_HEADER}', '{ACTIVE_HEADER}', '{LOAD_HEADER}'])"""


# -- report_file, example_columns: K4, K2 A14 -------------------------------------------------
def report_file(spark, sf_dir):
    report, _ = clusters._described(spark, sf_dir)
    path = shared_folder(spark, "report")
    write_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    return back.withColumns({c: F.array_join(c, " | ") for c in ("terms", "examples")})


def example_columns(spark, sf_dir):
    m = clusters._members(spark, sf_dir)
    sizes = clusters.R.ranked(m.groupBy("lang").agg(F.count(F.lit(1)).alias("count")), "lang")
    lists = clusters.R.ranked_list(clusters.examples(spark, sf_dir), "lang", "line", "examples")
    return cluster_example_columns(sizes.join(lists, "lang").withColumnRenamed("lang", "cluster"), clusters.SAMPLES)


QUERIES["report_file"] = report_file
ORACLES["report_file"] = clusters.ORACLES["described_groups"]
QUERIES["example_columns"] = example_columns
_wide = ",\n       ".join(f"coalesce(max(e.line) FILTER (WHERE e.rank = {i}), '') AS \"Example_{i}\""
                         for i in range(1, clusters.SAMPLES + 1))
ORACLES["example_columns"] = f"""
WITH e AS ({clusters.ORACLES["examples"]}),
n AS ({with_views(["feedback"], "")}, {clusters._MEMBERS_SQL.strip()} SELECT lang, count(*) AS n FROM m GROUP BY lang)
SELECT n.lang AS "Cluster", n.n AS "Count", {_wide}
FROM n JOIN e ON n.lang = e.lang GROUP BY n.lang, n.n"""
