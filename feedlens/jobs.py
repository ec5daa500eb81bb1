"""End-to-end jobs: the three entry points of SURVEY §3 as compositions of the
operators (no new logic here).

* :func:`export_requests` (§3.1): need documents → flatten → union → dedupe →
  request CSV (K1).
* :func:`run_analysis` (§3.2): request file → clean, weight, vectorise, choose K,
  cluster, describe → ``pain_point_summary`` (K2) and the insight report (K4).
* :func:`workspace_snapshot` (§3.3): open issues → their listing and three counts (A4, A5, A6),
  optionally written as CSV (K3).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators import issues as ops
from feedlens.operators.analysis import Analysis, analyze
from feedlens.operators.cluster import materialize
from feedlens.operators.requests import all_requests
from feedlens.sinks.files import (write_cluster_examples, write_members, write_report, write_requests,
                                   write_snapshot)
from feedlens.sources.feedback import read_feedback
from feedlens.sources.needs import read_need_docs


def export_requests(spark: SparkSession, issue_docs_path: str, out_path: str | None = None,
                    project_docs_path: str | None = None, scope: dict | None = None,
                    fmt: str = "json") -> DataFrame:
    """§3.1: requests of a scope (issue, project or workspace), one row per id."""
    idocs = read_need_docs(spark, issue_docs_path, "issue", fmt)
    pdocs = read_need_docs(spark, project_docs_path, "project", fmt) if project_docs_path else None
    rows = all_requests(idocs, pdocs, scope)
    if out_path:
        write_requests(rows, out_path)
    return rows


def run_analysis(spark: SparkSession, requests_path: str, out_dir: str | None = None,
                 sep: str | None = None, samples: int = 3, **options) -> Analysis:
    """§3.2: analyse a delimited request file and write the summary and report.

    ``request_id`` names the rows when present (it may repeat or be null: the analysis
    then keys rows itself); otherwise ids are null."""
    rows = read_feedback(spark, requests_path, sep)
    id_col = "request_id"
    if id_col not in rows.columns:
        rows = rows.withColumn(id_col, F.lit(None).cast("string"))
    result = analyze(rows, id_col=id_col, samples=samples, **options)
    if out_dir:
        result.report = materialize(result.report, persist=False)            # k rows, read three times
        write_cluster_examples(result.report, os.path.join(out_dir, "pain_point_summary"), samples)
        write_report(result.report, os.path.join(out_dir, "insights"))
        write_members(result.members, os.path.join(out_dir, "members"))
    return result


def workspace_snapshot(issues: DataFrame, states: DataFrame, projects: DataFrame,
                       teams: DataFrame, users: DataFrame,
                       out_path: str | None = None) -> dict[str, DataFrame]:
    """§3.3: open issues by project and state, active project load, assignee load.

    The denormalised open issues feed three aggregates, so they are written once
    to the checkpoint folder instead of being recomputed per section."""
    lite = materialize(ops.issue_lite(ops.open_issues(issues), states, projects, teams, users),
                       persist=False)
    sections = {
        "issue_listing": ops.snapshot_listing(lite),
        "issues_by_project_state": ops.issues_by_project_state(lite),
        "active_projects": ops.active_project_load(lite, projects),
        "assignee_load": ops.assignee_load(lite),
    }
    if out_path:
        write_snapshot(sections, out_path)
    return sections
