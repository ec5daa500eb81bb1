"""Registered issue-tracking queries (Spark plan + SQL oracle per key)."""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.scalars import IDENTIFIER_PATTERN, since_cutoff
from feedlens.operators import issues as ops
from feedlens.operators.search_index import build_index, search_index
from feedlens.plans.oracle_views import with_views
from feedlens.session import shared_folder
from feedlens.sources.tracker import TrackerViews

# Fixed parameters of the registered queries.
NOW = _dt.datetime(1998, 8, 2)
SINCE_DAYS = 1000
LABEL = "r"
STATE = "done"
SEARCH = "urgent"

CUTOFF = since_cutoff(NOW, SINCE_DAYS)
_CUTOFF_SQL = f"TIMESTAMP '{CUTOFF:%Y-%m-%d %H:%M:%S}'"
_RANK_SQL = "row_number() OVER (PARTITION BY assignee_id ORDER BY issue_count DESC, state_name) AS rank"
_NOW_SQL = f"TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _views(spark: SparkSession, sf_dir: str) -> TrackerViews:
    return TrackerViews(spark, sf_dir)


def _open_lite(v: TrackerViews) -> DataFrame:
    return ops.issue_lite(ops.open_issues(v.issues), v.states, v.projects, v.teams, v.users)


# -- issue_state_counts: F3 F5 P16 A2 T2 ----------------------------------------
def issue_state_counts(spark, sf_dir):
    v = _views(spark, sf_dir)
    mine = ops.assignee_issues(v.issue_facts, include_archived=False, since=CUTOFF)
    return ops.state_counts(ops.with_state(mine, v.states), by=("assignee_id",))


QUERIES["issue_state_counts"] = issue_state_counts
ORACLES["issue_state_counts"] = with_views(["issues", "states"], f"""
SELECT *, {_RANK_SQL} FROM (
  SELECT i.assignee_id, coalesce(s.name, '(No State)') AS state_name, count(*) AS issue_count
  FROM issues i LEFT JOIN states s ON i.state_id = s.id
  WHERE i.archived_at IS NULL AND i.updated_at > {_CUTOFF_SQL}
  GROUP BY i.assignee_id, coalesce(s.name, '(No State)')) c""")


# -- filtered_state_counts: A2 after the label and state filters ------------------
def filtered_state_counts(spark, sf_dir):
    v = _views(spark, sf_dir)
    fetched = ops.with_state(ops.assignee_issues(v.issue_facts, since=CUTOFF), v.states, STATE)
    return ops.state_counts(ops.with_label(fetched, v.issue_labels, v.labels, LABEL), by=("assignee_id",))


QUERIES["filtered_state_counts"] = filtered_state_counts
ORACLES["filtered_state_counts"] = with_views(["issues", "states", "labels", "issue_labels"], f"""
SELECT *, {_RANK_SQL} FROM (
SELECT i.assignee_id, coalesce(s.name, '(No State)') AS state_name, count(*) AS issue_count
FROM issues i LEFT JOIN states s ON i.state_id = s.id
WHERE i.archived_at IS NULL AND i.updated_at > {_CUTOFF_SQL}
  AND lower(coalesce(s.name, '(No State)')) = '{STATE.lower()}'
  AND i.id IN (SELECT il.issue_id FROM issue_labels il JOIN labels lb ON il.label_id = lb.id
               WHERE lower(lb.name) = lower('{LABEL}'))
GROUP BY 1, 2) c""")


# -- issue_match_totals: A3 J5 F5 -------------------------------------------------
def issue_match_totals(spark, sf_dir):
    v = _views(spark, sf_dir)
    fetched = ops.with_state(ops.assignee_issues(v.issue_facts, since=CUTOFF), v.states)
    tagged = (ops.with_label(v.issue_facts.select("id"), v.issue_labels, v.labels, LABEL)
              .select(F.col("id").alias("_tagged")))
    flagged = fetched.join(tagged, fetched.id == tagged._tagged, "left")
    matched = F.col("_tagged").isNotNull() & (F.lower("state_name") == STATE.lower())
    return ops.match_totals(flagged, matched, by=("assignee_id",))


QUERIES["issue_match_totals"] = issue_match_totals
ORACLES["issue_match_totals"] = with_views(["issues", "states", "labels", "issue_labels"], f"""
SELECT i.assignee_id, count(*) AS fetched,
       count(*) FILTER (WHERE t.issue_id IS NOT NULL
                        AND lower(coalesce(s.name, '(No State)')) = '{STATE.lower()}') AS matched
FROM issues i
LEFT JOIN states s ON i.state_id = s.id
LEFT JOIN (SELECT DISTINCT il.issue_id FROM issue_labels il JOIN labels lb ON il.label_id = lb.id
           WHERE lower(lb.name) = lower('{LABEL}')) t ON i.id = t.issue_id
WHERE i.archived_at IS NULL AND i.updated_at > {_CUTOFF_SQL}
GROUP BY i.assignee_id""")


# -- issues_with_label: J5 P27 ---------------------------------------------------
def issues_with_label(spark, sf_dir):
    v = _views(spark, sf_dir)
    return (ops.with_label(v.issues, v.issue_labels, v.labels, LABEL.upper())
            .select("id", "identifier", "state_id"))


QUERIES["issues_with_label"] = issues_with_label
ORACLES["issues_with_label"] = with_views(["issues", "labels", "issue_labels"], f"""
SELECT i.id, i.identifier, i.state_id FROM issues i
WHERE i.id IN (SELECT il.issue_id FROM issue_labels il JOIN labels lb ON il.label_id = lb.id
               WHERE lower(lb.name) = lower('{LABEL.upper()}'))""")


# -- open_issues: F1 J1 -----------------------------------------------------------
def open_issues(spark, sf_dir):
    return _open_lite(_views(spark, sf_dir))


QUERIES["open_issues"] = open_issues
ORACLES["open_issues"] = with_views(["open_lite"], "SELECT * FROM open_lite")


# -- issues_by_project_state: A4 P8 ---------------------------------------------
def issues_by_project_state(spark, sf_dir):
    return ops.issues_by_project_state(_open_lite(_views(spark, sf_dir)))


QUERIES["issues_by_project_state"] = issues_by_project_state
ORACLES["issues_by_project_state"] = with_views(["open_lite"], """
SELECT coalesce(project_name, '(No Project)') AS project,
       coalesce(nullif(state_name, ''), '(No State)') AS state, count(*) AS issue_count
FROM open_lite GROUP BY 1, 2""")


# -- snapshot_listing: K3, the rows of the first section --------------------------
def snapshot_listing(spark, sf_dir):
    return ops.snapshot_listing(_open_lite(_views(spark, sf_dir)))


QUERIES["snapshot_listing"] = snapshot_listing
ORACLES["snapshot_listing"] = with_views(["open_lite"], """
SELECT 'issues_by_project_state' AS section, coalesce(project_name, '(No Project)') AS project,
       coalesce(nullif(state_name, ''), '(No State)') AS state, coalesce(identifier, '') AS identifier, title,
       coalesce(assignee_name, '(unassigned)') AS assignee, coalesce(team_name, '') AS team
FROM open_lite""")


# -- active_project_load: F7 J6 A5 A12 T1 --------------------------------------------
def active_project_load(spark, sf_dir):
    v = _views(spark, sf_dir)
    return ops.active_project_load(_open_lite(v), v.projects)


QUERIES["active_project_load"] = active_project_load
ORACLES["active_project_load"] = with_views(["open_lite", "projects"], """
SELECT coalesce(p.name, '(Unnamed Project)') AS project_name, o.project_id,
       coalesce(p.state, '') AS state, count(*) AS open_count
FROM open_lite o JOIN projects p ON o.project_id = p.id
WHERE lower(p.state) IN ('planned', 'started') AND p.archived_at IS NULL
GROUP BY 1, 2, 3""")


# -- assignee_load: A6 T1 ----------------------------------------------------------
def assignee_load(spark, sf_dir):
    return ops.assignee_load(_open_lite(_views(spark, sf_dir)))


QUERIES["assignee_load"] = assignee_load
ORACLES["assignee_load"] = with_views(["open_lite"], """
SELECT coalesce(CAST(assignee_id AS VARCHAR), '(unassigned)') AS assignee,
       arg_min(coalesce(assignee_name, '(unassigned)'), id) AS assignee_name,
       count(*) AS open_count
FROM open_lite GROUP BY 1""")


# -- issue_listing: J9 P12 P13 ------------------------------------------------------
def issue_listing(spark, sf_dir):
    v = _views(spark, sf_dir)
    return ops.issue_listing(v.issues, v.states, v.users, v.projects)


QUERIES["issue_listing"] = issue_listing
ORACLES["issue_listing"] = with_views(["issues", "states", "users", "projects"], """
SELECT i.id, i.identifier,
       concat_ws(' — ',
         '- ' || coalesce(i.title, i.identifier, '<untitled>') || ' (id: ' || CAST(i.id AS VARCHAR) || ')',
         CASE WHEN nullif(s.name, '') IS NOT NULL THEN '[' || s.name || ']' END,
         CASE WHEN nullif(p.name, '') IS NOT NULL THEN 'project: ' || p.name END,
         CASE WHEN nullif(u.name, '') IS NOT NULL THEN 'assignee: ' || u.name END) AS line,
       coalesce(i.identifier, '<no-id>') || ' ' || coalesce(i.title, '<untitled>') || ' ['
         || coalesce(s.name, '(No State)') || ']' AS my_line
FROM issues i
LEFT JOIN states s ON i.state_id = s.id
LEFT JOIN users u ON i.assignee_id = u.id
LEFT JOIN projects p ON i.project_id = p.id""")


# -- issue_search: F6 T6 -----------------------------------------------------------
def issue_search(spark, sf_dir):
    return ops.search_issues(_views(spark, sf_dir).issues, SEARCH)


QUERIES["issue_search"] = issue_search
ORACLES["issue_search"] = with_views(["issues"], f"""
SELECT id, identifier, coalesce(title, '') AS title FROM issues
WHERE contains(lower(coalesce(title, '')), '{SEARCH}') OR contains(lower(identifier), '{SEARCH}')
ORDER BY id LIMIT 200""")


# -- issue_search_indexed: F6 through the trigram index, some searches at once --------------------
INDEX_SEARCHES = (SEARCH, "14", "order 1499", "urgent", "asia-77", "zzz", "der 7 ", "ASIA-12")


def issue_search_indexed(spark, sf_dir):
    path = shared_folder(spark, "search-index")
    build_index(_views(spark, sf_dir).issues, path)
    found = [search_index(spark, path, q).withColumn("query", F.lit(q)) for q in INDEX_SEARCHES]
    return reduce(DataFrame.unionByName, found)


QUERIES["issue_search_indexed"] = issue_search_indexed
_searched = " UNION ALL ".join(
    f"(SELECT id, identifier, coalesce(title, '') AS title, '{q}' AS query FROM issues WHERE "
    + (f"number = {q.split('-')[1]} AND split_part(identifier, '-', 1) = '{q.split('-')[0].upper()}'" if re.match(IDENTIFIER_PATTERN, q) else
       f"contains(lower(coalesce(title, '')), '{q.strip().lower()}') OR contains(lower(identifier), '{q.strip().lower()}')")
    + " ORDER BY id LIMIT 200)" for q in INDEX_SEARCHES)
ORACLES["issue_search_indexed"] = with_views(["issues"], _searched)


# -- issue_lookup: P15 (TEAM-123 identifiers resolved by team key and number) ---------
def issue_lookup(spark, sf_dir):
    """Every issue looked up by its own lower-cased identifier: parse → (key, number) →
    equi-join on (team key, number).  Exercises P15 over the whole table."""
    v = _views(spark, sf_dir)
    probes = v.issues.select(F.col("id").alias("probe_id"), F.lower("identifier").alias("probe"))
    return ops.lookup_issues(v.issues, v.teams, probes, "probe").drop("probe")


QUERIES["issue_lookup"] = issue_lookup
ORACLES["issue_lookup"] = with_views(["issues", "teams"], r"""
SELECT p.probe_id, p.team_key, p.number, t.found_id
FROM (SELECT id AS probe_id,
             CASE WHEN regexp_matches(lower(identifier), '^([A-Za-z]+)-(\d+)$')
                  THEN upper(regexp_extract(lower(identifier), '^([A-Za-z]+)-(\d+)$', 1)) END AS team_key,
             CASE WHEN regexp_matches(lower(identifier), '^([A-Za-z]+)-(\d+)$')
                  THEN TRY_CAST(regexp_extract(lower(identifier), '^([A-Za-z]+)-(\d+)$', 2) AS BIGINT) END AS number
      FROM issues) p
LEFT JOIN (SELECT i.id AS found_id, tm.key AS team_key, i.number FROM issues i JOIN teams tm ON i.team_id = tm.id) t
  ON p.team_key = t.team_key AND p.number = t.number""")


# -- team_projects: J7 ---------------------------------------------------------------
def team_projects(spark, sf_dir):
    v = _views(spark, sf_dir)
    return ops.team_projects(v.teams, v.team_projects, v.projects)


QUERIES["team_projects"] = team_projects
ORACLES["team_projects"] = with_views(["teams", "team_projects", "projects"], """
SELECT t.id AS team_id, t.name AS team_name, l.project_id, l.project_name
FROM teams t LEFT JOIN (SELECT tp.team_id, p.id AS project_id, p.name AS project_name
                        FROM team_projects tp JOIN projects p ON tp.project_id = p.id) l
  ON t.id = l.team_id""")


# -- team_cycles: J8 P14 ---------------------------------------------------------------
def team_cycles(spark, sf_dir):
    v = _views(spark, sf_dir)
    return ops.team_cycles(v.teams, v.cycles, NOW)


QUERIES["team_cycles"] = team_cycles
ORACLES["team_cycles"] = with_views(["teams", "cycles"], f"""
SELECT t.id AS team_id, t.name AS team_name, c.id AS cycle_id, c.name AS cycle_name,
       c.starts_at, c.ends_at,
       CASE WHEN c.id IS NOT NULL THEN (c.starts_at IS NULL OR c.starts_at <= {_NOW_SQL})
                                   AND (c.ends_at IS NULL OR c.ends_at >= {_NOW_SQL}) END AS active
FROM teams t LEFT JOIN cycles c ON t.id = c.team_id""")


# -- project_list: T7 P8 -----------------------------------------------------------------
def project_list(spark, sf_dir):
    return ops.project_list(_views(spark, sf_dir).projects)


QUERIES["project_list"] = project_list
ORACLES["project_list"] = with_views(["projects"], """
SELECT id, coalesce(name, '(Unnamed Project)') AS name FROM projects""")


# -- assignee_issue_totals: F4 A13 (listing totals, archived included) ------------------
def assignee_issue_totals(spark, sf_dir):
    v = _views(spark, sf_dir)
    return ops.issue_total(ops.assignee_issues(v.issue_facts, include_archived=True), by=("assignee_id",))


QUERIES["assignee_issue_totals"] = assignee_issue_totals
ORACLES["assignee_issue_totals"] = with_views(["issues"], """
SELECT assignee_id, count(*) AS total FROM issues GROUP BY assignee_id""")


# -- team_issue_counts: F10 T8 (no name: the first team; a name in any case; an unknown name: none) ----
TEAM_PROBES = (None, "asIA", "EUROPE", "nowhere")


def team_issue_counts(spark, sf_dir):
    v = _views(spark, sf_dir)
    issues, teams = v.issues, v.teams
    found = []
    for name in TEAM_PROBES:
        team = ops.resolve_team(teams, name).select(F.col("id").alias("_tid"), F.col("name").alias("team_name"))
        found.append(issues.join(team, F.col("team_id") == F.col("_tid")).groupBy("team_id", "team_name").agg(
            F.count(F.lit(1)).alias("n_issues")).withColumn("probe", F.lit(name or "").cast("string")))
    return reduce(DataFrame.unionByName, found)


QUERIES["team_issue_counts"] = team_issue_counts
ORACLES["team_issue_counts"] = with_views(["issues", "teams"], " UNION ALL ".join(
    f"SELECT i.team_id, t.name AS team_name, count(*) AS n_issues, '{name or ''}' AS probe FROM issues i JOIN "
    f"(SELECT * FROM teams {f"WHERE lower(name) = '{name.lower()}'" if name else ''} ORDER BY id LIMIT 1) t ON i.team_id = t.id GROUP BY 1, 2"
    for name in TEAM_PROBES))


# -- user_resolution: F10 P27 (every assignee resolved by its e-mail, any case) ----------
def user_resolution(spark, sf_dir):
    """Each user's e-mail upper-cased and resolved back through a case-insensitive
    equi-join on ``lower(email)``; duplicates resolve to the smallest id."""
    v = _views(spark, sf_dir)
    probes = v.users.select(F.col("id").alias("probe_id"), F.upper("email").alias("probe"))
    return ops.resolve_users(v.users, probes, "probe").drop("probe")


QUERIES["user_resolution"] = user_resolution
ORACLES["user_resolution"] = with_views(["users"], """
SELECT p.id AS probe_id, t.resolved_id
FROM users p LEFT JOIN (SELECT lower(email) AS e, min(id) AS resolved_id FROM users GROUP BY 1) t
  ON lower(upper(p.email)) = t.e""")
