"""Customer-request extract: flatten nested needs, union both hosts, dedupe by id.

``explode`` flattens each page of needs in place (no shuffle).  Dedupe is one
aggregate keyed by request id whose ``min`` runs partially on the map side, so an
id repeated across a third of all pages still reaches the shuffle as one candidate
row per task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.functions import scalars as S
from feedlens.functions.text import strip_ws

ISSUE_HOSTED, PROJECT_HOSTED = 0, 1


def _e(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _request_cols(need: str, project: Column, issue: Column, title: Column) -> list[Column]:
    """The 12 request columns; missing values become ``""``, the body is trimmed."""
    n = F.col(need)
    return [project.alias("project"), issue.alias("issue"), title.alias("issue_title"),
            n["id"].alias("request_id"),
            _e(n["customer"]["name"]).alias("customer"),
            _e(n["customer"]["revenue"]).alias("customer_revenue"),
            _e(n["customer"]["size"]).alias("customer_size"),
            S.priority_label(n["priority"]).alias("priority"),
            _e(n["attachment"]["url"]).alias("source"),
            _e(n["project"]["name"]).alias("reference_project"),
            _e(n["issue"]["identifier"]).alias("reference_issue"),
            strip_ws(_e(n["body"])).alias("request")]


def issue_needs(issue_docs: DataFrame) -> DataFrame:
    """J2 + J4 + P7: one request row per need of each issue document (issues without
    needs vanish, as an inner explode does).  Carries ``_src``/``_host`` for ordering."""
    ex = issue_docs.select("id", "identifier", "title", "project",
                           F.explode("needs").alias("need"))
    return ex.select(*_request_cols("need", S.label_or(F.col("project.name"), S.NO_PROJECT),
                                    _e(F.col("identifier")), _e(F.col("title"))),
                     F.lit(ISSUE_HOSTED).alias("_src"), F.col("id").alias("_host"))


def project_needs(project_docs: DataFrame, host_name: str | None = None) -> DataFrame:
    """J3 + P7: request rows of project documents; host name = given name, else the
    document's name, else ``(Project)``."""
    ex = project_docs.select("id", "name", F.explode("needs").alias("need"))
    name = F.coalesce(F.lit(host_name), F.col("name"), F.lit(S.PROJECT_HOST))
    return ex.select(*_request_cols("need", name, F.lit(""), F.lit("")),
                     F.lit(PROJECT_HOSTED).alias("_src"), F.col("id").alias("_host"))


def _order_key() -> Column:
    """Deterministic stand-in for scan order: issue-hosted first, then host, then the whole row."""
    first = ["_src", "_host", "request", "customer", "priority", "source"]
    rest = [c for c in schemas.REQUEST_COLUMNS if c not in first and c != "request_id"]
    return F.struct(*first, *rest)


def dedupe_requests(rows: DataFrame) -> DataFrame:
    """A1: one row per request id, the first by (host kind, host, row) winning."""
    cols = list(schemas.REQUEST_COLUMNS)
    best = rows.groupBy("request_id").agg(F.min(_order_key()).alias("r"))     # the key holds every other column
    return best.select(*["request_id" if c == "request_id" else F.col(f"r.{c}").alias(c) for c in cols])


def _some(docs: DataFrame, message: str) -> DataFrame:
    if docs.isEmpty():
        raise LookupError(message)
    return docs


def scope_docs(issue_docs: DataFrame, project_docs: DataFrame, scope: dict | None):
    """restrict documents to a scope.

    ``{"issue_id": ..}`` or ``{"identifier": "ENG-12"}`` → that issue only, no
    project documents; ``{"project_id": ..}`` or ``{"project_name": ..}`` → issues
    of that project plus its own documents; ``None`` → everything.  An issue
    scope wins over a project scope.  An unknown issue or project name and a
    malformed identifier are errors (one row at most is read for the check)."""
    scope = scope or {}
    if scope.get("issue_id") is not None:
        return _some(issue_docs.filter(F.col("id") == F.lit(str(scope["issue_id"]))),
                     f"Issue id not found: {scope['issue_id']}"), None
    if scope.get("identifier"):
        if not re.match(S.IDENTIFIER_PATTERN, scope["identifier"]):
            raise ValueError(f"Invalid issue identifier: {scope['identifier']}. Expected TEAMKEY-123")
        key, number = S.parse_identifier(F.lit(scope["identifier"]))
        d_key, d_no = S.parse_identifier(F.col("identifier"))
        return _some(issue_docs.filter((d_key == key) & (d_no == number)),
                     f"No issue found for {scope['identifier']}"), None
    if scope.get("project_id") is not None:
        pid = str(scope["project_id"])
        return (issue_docs.filter(F.col("project.id") == pid),
                project_docs.filter(F.col("id") == pid) if project_docs is not None else None)
    if scope.get("project_name") is not None:
        # exact name; the first matching project (smallest id) wins
        if project_docs is None:
            raise ValueError("a project name needs project documents")
        first = (_some(project_docs.filter(F.col("name") == scope["project_name"]),
                       f"Project not found: {scope['project_name']}").agg(F.min("id").alias("_pid")))
        pd_ = project_docs.join(first, project_docs.id == first._pid, "left_semi")
        idocs = issue_docs.join(first, issue_docs["project.id"] == first._pid, "left_semi")
        return idocs, pd_
    return issue_docs, project_docs


def all_requests(issue_docs: DataFrame, project_docs: DataFrame | None,
                 scope: dict | None = None) -> DataFrame:
    """U1 + A1: union of issue-hosted and project-hosted requests, deduped by id."""
    idocs, pdocs = scope_docs(issue_docs, project_docs, scope) if scope else (issue_docs, project_docs)
    rows = issue_needs(idocs)
    if pdocs is not None:
        rows = rows.unionByName(project_needs(pdocs))
    return dedupe_requests(rows)
