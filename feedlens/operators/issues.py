"""Issue-tracking operators: filters, relation joins, counts and listings.

Every operator takes DataFrames and returns a lazy DataFrame.  Counts are hash
aggregates with map-side partial aggregation, so a hot key (one assignee or one
project holding a third of all issues) reaches the shuffle as one partial row
per task.  Relation lookups are equi-joins; adaptive execution decides at
runtime whether a side is small enough to broadcast.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions import scalars as S

# Fixed values.
ACTIVE_PROJECT_STATES = ("planned", "started")
LISTING_SECTION = "issues_by_project_state"
SEARCH_DEFAULT_LIMIT = 200
SEARCH_MAX_LIMIT = 500


# -- filters -----------------------------------------------------------------

def open_issues(issues: DataFrame) -> DataFrame:
    """completed, canceled and archived all null."""
    return issues.filter(F.col("completed_at").isNull() & F.col("canceled_at").isNull()
                         & F.col("archived_at").isNull())


def assignee_issues(issues: DataFrame, user_id=None, include_archived: bool = False,
                    since: _dt.datetime | None = None) -> DataFrame:
    """issues of one assignee (all assignees when ``user_id`` is None);
    archived ones only when asked; ``updated_at > since`` when a cutoff is given."""
    cond = F.lit(True)
    if user_id is not None:
        cond = cond & (F.col("assignee_id") == F.lit(user_id))
    if not include_archived:
        cond = cond & F.col("archived_at").isNull()
    if since is not None:
        cond = cond & (F.col("updated_at") > S.ts_lit(since))
    return issues.filter(cond)


def with_state(issues: DataFrame, states: DataFrame, state_name: str | None = None) -> DataFrame:
    """attach ``state_name`` (missing → ``(No State)``); optionally keep one state,
    compared case-insensitively."""
    s = states.select(F.col("id").alias("_sid"), F.col("name").alias("_sname"))
    out = (issues.join(s, issues.state_id == s._sid, "left")
           .withColumn("state_name", S.label_or(F.col("_sname"), S.NO_STATE))
           .drop("_sid", "_sname"))
    if state_name is not None:
        out = out.filter(S.ci_eq("state_name", state_name))
    return out


def with_label(issues: DataFrame, issue_labels: DataFrame, labels: DataFrame,
               name: str) -> DataFrame:
    """Keep issues that carry a label with this name (case-insensitive); a semi join,
    so an issue with many matching labels still appears once."""
    wanted = labels.filter(S.ci_eq("name", name)).select(F.col("id").alias("_lid"))
    tagged = issue_labels.join(wanted, issue_labels.label_id == wanted._lid, "left_semi")
    return issues.join(tagged, issues.id == tagged.issue_id, "left_semi")


def resolve_user(users: DataFrame, email: str) -> DataFrame:
    """the user whose email equals ``email`` case-insensitively (first by id)."""
    return users.filter(S.ci_eq("email", email)).orderBy("id").limit(1)


def resolve_user_id(users: DataFrame, email: str):
    """F10 as a value: the id of the user with this e-mail; no such user is an error
    (one row at most reaches the driver)."""
    row = resolve_user(users, email).select("id").first()
    if row is None:
        raise LookupError(f"No user found for email: {email}")
    return row[0]


def resolve_users(users: DataFrame, probes: DataFrame, email_col: str) -> DataFrame:
    """F10 for a table of e-mails: ``probes`` with ``resolved_id``, the smallest id of the
    users with that e-mail in any case (null when none)."""
    targets = users.groupBy(F.lower("email").alias("_e")).agg(F.min("id").alias("resolved_id"))
    return probes.join(targets, F.lower(email_col) == F.col("_e"), "left").drop("_e")


def resolve_team(teams: DataFrame, name: str | None = None) -> DataFrame:
    """Team by name (case-insensitive); no name → the first team."""
    if name is not None:
        teams = teams.filter(S.ci_eq("name", name))
    return teams.orderBy("id").limit(1)


def resolve_team_id(teams: DataFrame, name: str | None = None):
    """F10/T8 as a value: the team's id; no such team is an error."""
    row = resolve_team(teams, name).select("id").first()
    if row is None:
        raise LookupError(f"Team not found: {name}" if name is not None else "No teams")
    return row[0]


# -- joins ---------------------------------------------------------------------

def issue_lite(issues: DataFrame, states: DataFrame, projects: DataFrame, teams: DataFrame,
               users: DataFrame) -> DataFrame:
    """One denormalised row per issue with state, project, team and assignee."""
    st = states.select(F.col("id").alias("_sid"), F.col("name").alias("_sname"),
                       F.col("type").alias("state_type"))
    pr = projects.select(F.col("id").alias("_pid"), F.col("name").alias("project_name"))
    tm = teams.select(F.col("id").alias("_tid"), F.col("name").alias("team_name"))
    us = users.select(F.col("id").alias("_uid"), F.col("name").alias("assignee_name"))
    joined = (issues
              .join(st, issues.state_id == st._sid, "left")
              .join(pr, issues.project_id == pr._pid, "left")
              .join(tm, issues.team_id == tm._tid, "left")
              .join(us, issues.assignee_id == us._uid, "left"))
    return joined.select(
        "id", "identifier", F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("_sname", F.lit("")).alias("state_name"), "state_type",
        F.col("_pid").alias("project_id"), "project_name", "team_name",
        F.col("_uid").alias("assignee_id"), "assignee_name")


def active_projects(projects: DataFrame) -> DataFrame:
    """state planned/started in any case, not archived."""
    return projects.filter(F.lower("state").isin(*ACTIVE_PROJECT_STATES)
                           & F.col("archived_at").isNull())


def team_projects(teams: DataFrame, links: DataFrame, projects: DataFrame) -> DataFrame:
    """Team → its projects; teams without projects keep one row with nulls."""
    l = links.join(projects.select(F.col("id").alias("_pid"), F.col("name").alias("project_name")),
                   links.project_id == F.col("_pid"), "inner")
    return (teams.join(l, teams.id == l.team_id, "left")
            .select(teams.id.alias("team_id"), teams.name.alias("team_name"),
                    F.col("_pid").alias("project_id"), "project_name"))


def team_cycles(teams: DataFrame, cycles: DataFrame, now) -> DataFrame:
    """J8 + P14: team → cycles with the active flag evaluated at ``now``."""
    c = cycles.select(F.col("id").alias("cycle_id"), F.col("team_id").alias("_tid"),
                      F.col("name").alias("cycle_name"), "starts_at", "ends_at")
    return (teams.join(c, teams.id == c._tid, "left")
            .select(teams.id.alias("team_id"), teams.name.alias("team_name"), "cycle_id",
                    "cycle_name", "starts_at", "ends_at",
                    F.when(F.col("cycle_id").isNotNull(),
                           S.cycle_active("starts_at", "ends_at", now)).alias("active")))


def issue_listing(issues: DataFrame, states: DataFrame, users: DataFrame,
                  projects: DataFrame) -> DataFrame:
    """J9 + P12 + P13: display lines of every issue."""
    st = states.select(F.col("id").alias("_sid"), F.col("name").alias("_state"))
    us = users.select(F.col("id").alias("_uid"), F.col("name").alias("_assignee"))
    pr = projects.select(F.col("id").alias("_pid"), F.col("name").alias("_project"))
    j = (issues.join(st, issues.state_id == st._sid, "left")
         .join(us, issues.assignee_id == us._uid, "left")
         .join(pr, issues.project_id == pr._pid, "left"))
    return j.select(
        "id", "identifier",
        S.issue_line("title", "identifier", "id", "_state", "_project", "_assignee").alias("line"),
        S.my_issue_line("identifier", "title", "_state").alias("my_line"))


# -- aggregates ------------------------------------------------------------------

def state_counts(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A2 + T2: matching issues per state name, count desc then state.  With ``by`` the order
    is a ``rank`` inside each ``by`` group instead of one sort over all of them."""
    counts = df.groupBy(*by, "state_name").agg(F.count(F.lit(1)).alias("issue_count"))
    order = [F.desc("issue_count"), F.asc("state_name")]
    if not by:
        return counts.orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))


def match_totals(fetched: DataFrame, matched_flag, by: tuple[str, ...] = ()) -> DataFrame:
    """A3: fetched vs matched totals (one pass, ``count_if`` for the matched side)."""
    flag = F.col(matched_flag) if isinstance(matched_flag, str) else matched_flag
    return fetched.groupBy(*by).agg(F.count(F.lit(1)).alias("fetched"),
                                    F.count_if(flag).alias("matched"))


def issues_by_project_state(open_lite: DataFrame) -> DataFrame:
    """A4: open issues by project **name** then state name, with a count."""
    project = S.label_or("project_name", S.NO_PROJECT)
    state = S.label_or("state_name", S.NO_STATE, blank_is_missing=True)
    return (open_lite.groupBy(project.alias("project"), state.alias("state"))
            .agg(F.count(F.lit(1)).alias("issue_count"))
            .orderBy("project", "state"))


def snapshot_listing(open_lite: DataFrame, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """K3 first section: every open issue under its project and state (and ``keep`` columns)."""
    return open_lite.select(
        *keep,
        F.lit(LISTING_SECTION).alias("section"), S.label_or("project_name", S.NO_PROJECT).alias("project"),
        S.label_or("state_name", S.NO_STATE, blank_is_missing=True).alias("state"),
        F.coalesce("identifier", F.lit("")).alias("identifier"), "title",
        F.coalesce("assignee_name", F.lit(S.UNASSIGNED)).alias("assignee"),
        F.coalesce("team_name", F.lit("")).alias("team"))


def active_project_load(open_lite: DataFrame, projects: DataFrame) -> DataFrame:
    """J6 + A5 + T1: open-issue count per referenced active project (by id).

    Issues are counted per project id first (partial aggregation), so the join
    sees one row per referenced project (A12) instead of one per issue."""
    counts = (open_lite.filter(F.col("project_id").isNotNull())
              .groupBy("project_id").agg(F.count(F.lit(1)).alias("open_count")))
    act = active_projects(projects).select(
        F.col("id").alias("_pid"), S.label_or("name", S.UNNAMED_PROJECT).alias("project_name"),
        F.coalesce("state", F.lit("")).alias("state"))
    return (counts.join(act, counts.project_id == act._pid, "inner")
            .select("project_name", "project_id", "state", "open_count")
            .orderBy(F.desc("open_count"), F.collate("project_name", "UNICODE")))


def assignee_load(open_lite: DataFrame) -> DataFrame:
    """A6 + T1: open issues per assignee id (null → ``(unassigned)``), name of the
    first issue seen, count desc then name."""
    key = F.coalesce(F.col("assignee_id").cast("string"), F.lit(S.UNASSIGNED))
    name = S.label_or("assignee_name", S.UNASSIGNED)
    named = (open_lite.groupBy(key.alias("assignee"), name.alias("_name"))     # hash aggregate, one row
             .agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")))  # per assignee and name
    return (named.groupBy("assignee")
            .agg(F.min_by("_name", "_first").alias("assignee_name"), F.sum("_n").alias("open_count"))
            .orderBy(F.desc("open_count"), F.collate("assignee_name", "UNICODE")))


def issue_total(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Number of listed issues, one row (or one row per ``by``)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))


# -- listings, search ------------------------------------------------------------

def project_list(projects: DataFrame) -> DataFrame:
    """T7 + P8: projects by name in locale order; missing name → ``(Unnamed Project)``."""
    return (projects.select("id", S.label_or("name", S.UNNAMED_PROJECT).alias("name"))
            .orderBy(F.collate("name", "UNICODE"), "id"))


def clamp_limit(limit) -> int:
    """Default 200, clamped to 1..500; a non-numeric limit is an error."""
    if limit is None:
        return SEARCH_DEFAULT_LIMIT
    value = float(limit)
    if value != value:
        raise ValueError(f"limit is not a number: {limit!r}")
    return int(max(1, min(SEARCH_MAX_LIMIT, value)))


def lookup_issues(issues: DataFrame, teams: DataFrame, probes: DataFrame, identifier_col: str) -> DataFrame:
    """P15 for a table of identifiers: ``probes`` with ``team_key`` and ``number`` parsed from
    ``TEAM-123`` and ``found_id``, the issue of that team key and number (null when none)."""
    key, number = S.parse_identifier(F.col(identifier_col))
    target = (issues.join(teams.select(F.col("id").alias("_tid"), F.col("key").alias("_key")),
                          F.col("team_id") == F.col("_tid"))
              .select(F.col("id").alias("found_id"), "_key", F.col("number").alias("_number")))
    parsed = probes.withColumn("team_key", key).withColumn("number", number)
    return parsed.join(target, (F.col("team_key") == F.col("_key")) & (F.col("number") == F.col("_number")),
                       "left").drop("_key", "_number")


def matches(query: str) -> Column:
    """title or identifier contains the query in any case."""
    q = query.lower()
    return F.lower(F.coalesce("title", F.lit(""))).contains(q) | F.lower("identifier").contains(q)


def search_issues(issues: DataFrame, query: str | None, limit=None,
                  scan_limit: int | None = None) -> DataFrame:
    """F6 + T6 + P15: ``TEAM-123`` looks the issue up by team key and number;
    otherwise title or identifier contains the query (case-insensitive).

    All issues are searched by default; ``scan_limit=500`` reproduces a picker
    that only looks at the first 500 issues.  Results are the first ``limit``
    matches by issue id (a top-k, so Spark plans TakeOrderedAndProject)."""
    n = clamp_limit(limit)
    q = (query or "").strip()
    base = issues
    if scan_limit is not None:
        base = base.orderBy("id").limit(int(scan_limit))
    out_cols = ["id", "identifier", F.coalesce("title", F.lit("")).alias("title")]
    m = re.match(S.IDENTIFIER_PATTERN, q)
    if m:
        key, number = m.group(1).upper(), int(m.group(2))
        ident_key, _ = S.parse_identifier(F.col("identifier"))
        hits = base.filter((ident_key == key) & (F.col("number") == number))
    elif q:
        hits = base.filter(matches(q))
    else:
        hits = base
    return hits.select(*out_cols).orderBy("id").limit(n)
