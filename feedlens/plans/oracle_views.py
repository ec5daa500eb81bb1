"""SQL mirrors of the derived views, used by the DuckDB oracle queries.

Each constant is one CTE body written in plain ANSI SQL against the benchmark
tables; :func:`with_views` prefixes a query with the CTEs it names.  They must
stay in step with :mod:`feedlens.sources.tracker` and :mod:`feedlens.sources.feedback`.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["teams"] = """
  SELECT r_regionkey AS id, regexp_replace(upper(r_name), '[^A-Z]', '', 'g') AS key, r_name AS name
  FROM region"""

VIEWS["projects"] = """
  SELECT n.n_nationkey AS id, n.n_name AS name,
         CASE r.r_name WHEN 'ASIA' THEN 'Started' WHEN 'EUROPE' THEN 'planned' ELSE 'paused' END AS state,
         CASE WHEN n.n_nationkey % 7 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' END AS archived_at
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

VIEWS["team_projects"] = """
  SELECT n_regionkey AS team_id, n_nationkey AS project_id FROM nation"""

VIEWS["users"] = """
  SELECT c_custkey AS id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email, c_nationkey AS nation_id
  FROM customer"""

VIEWS["states"] = """
  SELECT id,
         CASE id WHEN 'F' THEN 'Done' WHEN 'O' THEN 'Todo' WHEN 'P' THEN 'In Progress' END AS name,
         CASE id WHEN 'F' THEN 'completed' WHEN 'O' THEN 'unstarted' WHEN 'P' THEN 'started' END AS type
  FROM (SELECT DISTINCT o_orderstatus AS id FROM orders) d"""

VIEWS["labels"] = """
  SELECT DISTINCT l_returnflag AS id, l_returnflag AS name FROM lineitem"""

VIEWS["issue_labels"] = """
  SELECT l_orderkey AS issue_id, l_returnflag AS label_id FROM lineitem"""

VIEWS["issues"] = """
  SELECT o.o_orderkey AS id,
         t.key || '-' || CAST(o.o_orderkey AS VARCHAR) AS identifier,
         o.o_orderkey AS number,
         CASE WHEN o.o_orderpriority <> '4-NOT SPECIFIED'
              THEN 'Order ' || CAST(o.o_orderkey AS VARCHAR) || ' ' || lower(substring(o.o_orderpriority, 3, 100))
         END AS title,
         o.o_orderstatus AS state_id,
         c.c_nationkey AS project_id,
         n.n_regionkey AS team_id,
         o.o_custkey AS assignee_id,
         CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate END AS completed_at,
         CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '4-NOT SPECIFIED' THEN o.o_orderdate END AS canceled_at,
         CASE WHEN o.o_orderstatus <> 'P' AND o.o_orderpriority = '5-LOW' THEN o.o_orderdate END AS archived_at,
         o.o_orderdate AS updated_at
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN teams t ON n.n_regionkey = t.id"""

VIEWS["cycles"] = """
  SELECT t.key || '-' || CAST(a.year AS VARCHAR) AS id, a.team_id,
         'Cycle ' || CAST(a.year AS VARCHAR) AS name, a.starts_at, a.ends_at
  FROM (SELECT team_id, year(updated_at) AS year, min(updated_at) AS starts_at,
               max(updated_at) AS ends_at
        FROM issues GROUP BY team_id, year(updated_at)) a
  LEFT JOIN teams t ON a.team_id = t.id"""

VIEWS["open_issues"] = """
  SELECT * FROM issues
  WHERE completed_at IS NULL AND canceled_at IS NULL AND archived_at IS NULL"""

VIEWS["open_lite"] = """
  SELECT i.id, i.identifier, coalesce(i.title, '') AS title, coalesce(s.name, '') AS state_name,
         s.type AS state_type, p.id AS project_id, p.name AS project_name, t.name AS team_name,
         u.id AS assignee_id, u.name AS assignee_name
  FROM open_issues i
  LEFT JOIN states s ON i.state_id = s.id
  LEFT JOIN projects p ON i.project_id = p.id
  LEFT JOIN teams t ON i.team_id = t.id
  LEFT JOIN users u ON i.assignee_id = u.id"""

# Dependency order: a CTE may only use the ones listed before it.
_ORDER = list(VIEWS)


def register_view(name: str, body: str) -> None:
    VIEWS[name] = body
    if name not in _ORDER:
        _ORDER.append(name)


_DEPS = {
    "issues": ["teams"],
    "cycles": ["issues", "teams"],
    "open_issues": ["issues"],
    "open_lite": ["open_issues", "states", "projects", "teams", "users"],
}


def add_deps(name: str, deps: list[str]) -> None:
    _DEPS[name] = deps


# Request-extract and feedback views (mirror feedlens.sources.needs / .feedback).
register_view("accounts", """
  SELECT c.c_custkey, c.c_name, CAST(CAST(round(c.c_acctbal) AS BIGINT) AS VARCHAR) AS revenue,
         CAST(coalesce(s.n, 0) AS VARCHAR) AS size
  FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) s
    ON c.c_custkey = s.o_custkey""")

register_view("issue_requests", """
  SELECT coalesce(p.name, '(No Project)') AS project, coalesce(i.identifier, '') AS issue,
         coalesce(i.title, '') AS issue_title, CAST(l.l_partkey AS VARCHAR) AS request_id,
         coalesce(a.c_name, '') AS customer, coalesce(a.revenue, '') AS customer_revenue,
         coalesce(a.size, '') AS customer_size,
         CASE WHEN l.l_returnflag = 'R' THEN 'Important'
              WHEN l.l_returnflag = 'A' THEN 'Normal'
              WHEN l.l_linenumber > 5 THEN CAST(l.l_linenumber AS VARCHAR)
              ELSE 'Unspecified' END AS priority,
         CASE WHEN l.l_returnflag = 'R' THEN 'https://tracker.example.com/att/'
              || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) ELSE '' END AS source,
         coalesce(p.name, '') AS reference_project, coalesce(i.identifier, '') AS reference_issue,
         CASE WHEN l.l_linestatus = 'O' THEN trim('  ship part ' || CAST(l.l_partkey AS VARCHAR)
              || ' line ' || CAST(l.l_linenumber AS VARCHAR) || ' ') ELSE '' END AS request,
         0 AS _src, CAST(i.id AS VARCHAR) AS _host
  FROM lineitem l JOIN issues i ON l.l_orderkey = i.id
  LEFT JOIN projects p ON i.project_id = p.id
  LEFT JOIN accounts a ON i.assignee_id = a.c_custkey""")
add_deps("issue_requests", ["issues", "projects", "accounts"])

register_view("project_requests", r"""
  SELECT coalesce(n.n_name, '(Project)') AS project, '' AS issue, '' AS issue_title,
         CAST(p.p_partkey AS VARCHAR) AS request_id, '' AS customer, '' AS customer_revenue,
         '' AS customer_size,
         CASE WHEN p.p_size > 40 THEN 'Important' WHEN p.p_size > 20 THEN 'Normal'
              ELSE 'Unspecified' END AS priority,
         '' AS source, coalesce(n.n_name, '') AS reference_project, '' AS reference_issue,
         trim(coalesce(p.p_name, '')) AS request, 1 AS _src, CAST(n.n_nationkey AS VARCHAR) AS _host
  FROM part p LEFT JOIN nation n
    ON CAST(regexp_extract(p.p_brand, '(\d+)$', 1) AS INTEGER) - 1 = n.n_nationkey""")

register_view("feedback", """
  SELECT d.doc_id, d.text AS request, d.lang, c.c_name AS customer, c.c_acctbal AS customer_revenue,
         coalesce(s.n, 0) AS customer_size,
         CASE WHEN l.quality IS NULL THEN 'Unspecified' WHEN l.quality = 1 THEN 'Important'
              WHEN l.quality = 0 THEN 'Normal' ELSE CAST(l.quality AS VARCHAR) END AS priority
  FROM documents d
  LEFT JOIN labels l ON d.doc_id = l.doc_id
  LEFT JOIN customer c ON d.doc_id % (SELECT count(*) FROM customer) = c.c_custkey
  LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) s ON c.c_custkey = s.o_custkey""")


def _closure(names: list[str]) -> set[str]:
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(_DEPS.get(n, []))
    return need


def with_views(names: list[str], query: str) -> str:
    """``WITH <needed views> <query>``."""
    need = _closure(names)
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in _ORDER if n in need]
    if not parts:
        return query
    return "WITH " + ",\n".join(parts) + "\n" + query
