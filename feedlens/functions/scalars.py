"""Column expressions shared by the tracker and request operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed display values.
NO_PROJECT = "(No Project)"
NO_STATE = "(No State)"
UNASSIGNED = "(unassigned)"
PROJECT_HOST = "(Project)"
UNNAMED_PROJECT = "(Unnamed Project)"
UNTITLED = "<untitled>"
NO_ID = "<no-id>"
IDENTIFIER_PATTERN = r"^([A-Za-z]+)-(\d+)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_lit(value) -> Column:
    """A wall-clock timestamp literal (``timestamp_ntz``), independent of the JVM and
    Python time zones."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def priority_label(code) -> Column:
    """1 → Important, 0 → Normal, null → Unspecified, anything else → its digits."""
    c = _c(code)
    return (F.when(c.isNull(), F.lit("Unspecified"))
            .when(c == 1, F.lit("Important"))
            .when(c == 0, F.lit("Normal"))
            .otherwise(c.cast("string")))


def label_or(value, default: str, blank_is_missing: bool = False) -> Column:
    """``value ?? default``; with ``blank_is_missing`` also ``value || default``."""
    c = _c(value)
    if blank_is_missing:
        c = F.nullif(c, F.lit(""))
    return F.coalesce(c, F.lit(default))


def ci_eq(a, b) -> Column:
    """Case-insensitive equality."""
    a = _c(a)
    b = b if isinstance(b, Column) else F.lit(b)
    return F.lower(a) == F.lower(b)


def issue_line(title, identifier, issue_id, state, project, assignee) -> Column:
    """``- <title> (id: <id>)`` then optional ``[state]``, ``project:``, ``assignee:``,
    joined by `` — ``; empty parts are skipped."""
    shown = F.coalesce(_c(title), _c(identifier), F.lit(UNTITLED))
    head = F.concat(F.lit("- "), shown, F.lit(" (id: "), _c(issue_id).cast("string"), F.lit(")"))

    def part(prefix: str, value, suffix: str = "") -> Column:
        v = F.nullif(_c(value), F.lit(""))
        return F.when(v.isNotNull(), F.concat(F.lit(prefix), v, F.lit(suffix)))

    return F.concat_ws(" — ", head, part("[", state, "]"), part("project: ", project),
                       part("assignee: ", assignee))


def my_issue_line(identifier, title, state) -> Column:
    """``<identifier> <title> [<state>]`` with placeholders for missing parts."""
    return F.concat(F.coalesce(_c(identifier), F.lit(NO_ID)), F.lit(" "),
                    F.coalesce(_c(title), F.lit(UNTITLED)), F.lit(" ["),
                    F.coalesce(_c(state), F.lit(NO_STATE)), F.lit("]"))


def cycle_active(starts_at, ends_at, now) -> Column:
    """Active when (start null or start ≤ now) and (end null or end ≥ now)."""
    s, e = _c(starts_at), _c(ends_at)
    n = ts_lit(now)
    return (s.isNull() | (s <= n)) & (e.isNull() | (e >= n))


def parse_identifier(value) -> tuple[Column, Column]:
    """``eng-12`` → (``ENG``, 12); other shapes give (null, null)."""
    c = F.trim(_c(value))
    ok = c.rlike(IDENTIFIER_PATTERN)
    key = F.when(ok, F.upper(F.regexp_extract(c, IDENTIFIER_PATTERN, 1)))
    number = F.when(ok, F.regexp_extract(c, IDENTIFIER_PATTERN, 2).try_cast("bigint"))
    return key, number


def since_cutoff(now: _dt.datetime, days) -> _dt.datetime | None:
    """``now - days``; no cutoff when days is not a positive number."""
    try:
        d = float(days)
    except (TypeError, ValueError):
        return None
    if d != d or d <= 0:
        return None
    return now - _dt.timedelta(days=int(d))
