"""Fixed schemas of tracker entities, nested request documents and webhooks."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    out = []
    for f in fields:
        name, dtype = f[0], f[1]
        nullable = f[2] if len(f) > 2 else True
        out.append(T.StructField(name, dtype, nullable))
    return T.StructType(out)


CUSTOMER = _struct(("id", S), ("name", S), ("revenue", S), ("size", S))
ATTACHMENT = _struct(("url", S))
PROJECT_REF = _struct(("id", S), ("name", S))
ISSUE_REF = _struct(("id", S), ("identifier", S), ("title", S))

NEED = _struct(("id", S, False), ("body", S), ("priority", I), ("customer", CUSTOMER),
               ("attachment", ATTACHMENT), ("project", PROJECT_REF), ("issue", ISSUE_REF))

# One connection page of needs hosted by an issue / by a project.
ISSUE_DOC = _struct(("id", S, False), ("identifier", S), ("title", S), ("project", PROJECT_REF),
                    ("page", L), ("needs", T.ArrayType(NEED)))
PROJECT_DOC = _struct(("id", S, False), ("name", S), ("page", L), ("needs", T.ArrayType(NEED)))

REQUEST_COLUMNS = (
    "project", "issue", "issue_title", "request_id", "customer", "customer_revenue",
    "customer_size", "priority", "source", "reference_project", "reference_issue", "request",
)
REQUESTS = _struct(*[(c, S) for c in REQUEST_COLUMNS])

ISSUES = _struct(("id", L, False), ("identifier", S), ("number", L), ("title", S), ("state_id", S),
                 ("project_id", L), ("team_id", L), ("assignee_id", L), ("completed_at", TS),
                 ("canceled_at", TS), ("archived_at", TS), ("updated_at", TS))
STATES = _struct(("id", S, False), ("name", S), ("type", S))
PROJECTS = _struct(("id", L, False), ("name", S), ("state", S), ("archived_at", TS))
TEAMS = _struct(("id", L, False), ("key", S), ("name", S))
USERS = _struct(("id", L, False), ("name", S), ("email", S))
LABELS = _struct(("id", S, False), ("name", S))
ISSUE_LABELS = _struct(("issue_id", L, False), ("label_id", S, False))
TEAM_PROJECTS = _struct(("team_id", L, False), ("project_id", L, False))
CYCLES = _struct(("id", S, False), ("team_id", L, False), ("name", S), ("starts_at", TS),
                 ("ends_at", TS))

ENTITY_SCHEMAS = {
    "issues": ISSUES, "states": STATES, "projects": PROJECTS, "teams": TEAMS, "users": USERS,
    "labels": LABELS, "issue_labels": ISSUE_LABELS, "team_projects": TEAM_PROJECTS,
    "cycles": CYCLES, "issue_docs": ISSUE_DOC, "project_docs": PROJECT_DOC, "requests": REQUESTS,
}

WEBHOOK_RAW = _struct(("body", T.BinaryType(), False), ("signature", S), ("received_at", TS))

EVENT = _struct(("type", S), ("action", S), ("data", _struct(("id", S), ("type", S))),
                ("receivedAt", S))
