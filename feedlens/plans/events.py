"""Registered webhook queries (static form of the stream transforms)."""

from __future__ import annotations

from feedlens.functions.crypto import hmac_pads
from feedlens.sources.tracker import TrackerViews
from feedlens.sources.webhooks import FIRST_DAY, TEST_KEY, deliveries_from_events, issue_versions
from feedlens.streaming import events as ev
from feedlens.plans.oracle_views import with_views

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
LATEST = 50

_ipad, _opad = (p.hex() for p in hmac_pads(TEST_KEY))


def _hmac_sql(body: str) -> str:
    return f"sha256(unhex('{_opad}') || unhex(sha256(unhex('{_ipad}') || encode({body}))))"


_DELIVERIES = rf"""
ev AS (SELECT event_id, ts, event_type, props, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k
       FROM events),
bd AS (SELECT *, '{{"type":"' || CASE event_type WHEN 'click' THEN 'Issue' WHEN 'view' THEN 'IssueLabel'
                     WHEN 'purchase' THEN 'Comment' WHEN 'signup' THEN 'Project' ELSE 'Error' END
              || '","action":"' || event_type || '","data":{{"id":"' || CAST(event_id * 2 AS VARCHAR)
              || '","type":"' || CASE WHEN event_type = 'purchase' THEN 'Issue' ELSE 'Event' END
              || '"}},"eventId":' || CAST(event_id AS VARCHAR)
              || CASE WHEN event_type = 'view'
                      THEN ',"receivedAt":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z"' ELSE '' END
              || ',"props":' || props
              || CASE WHEN event_type = 'error' AND k < 20 THEN '' ELSE '}}' END AS body
       FROM ev),
sg AS (SELECT *, {_hmac_sql('body')} AS sig FROM bd),
deliveries AS (SELECT ts AS received_at, body,
                      CASE WHEN k >= 90 THEN upper(sig) WHEN k < 5 THEN NULL
                           WHEN k BETWEEN 40 AND 44 THEN ' ' || sig || ' ' ELSE sig END AS signature
               FROM sg),
routed AS (SELECT received_at, body,
                  CASE WHEN NOT coalesce(trim(signature) = {_hmac_sql('body')}, false) THEN 'bad_signature'
                       WHEN NOT json_valid(body) THEN 'bad_json' ELSE 'ok' END AS status
           FROM deliveries),
verified AS (SELECT received_at, status,
                    json_extract_string(body, '$.type') AS type,
                    json_extract_string(body, '$.action') AS action,
                    json_extract_string(body, '$.data.id') AS data_id,
                    json_extract_string(body, '$.data.type') AS data_type,
                    coalesce(json_extract_string(body, '$.receivedAt'),
                             strftime(received_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z') AS "receivedAt",
                    body
             FROM routed WHERE status = 'ok')"""


def _raw(spark, sf_dir):
    return deliveries_from_events(spark, sf_dir)


# -- verified_events: S6 P17 P18 P19 F8 (W1) ----------------------------------------------
def verified_events(spark, sf_dir):
    return ev.verified_events(_raw(spark, sf_dir), TEST_KEY)


QUERIES["verified_events"] = verified_events
ORACLES["verified_events"] = "WITH " + _DELIVERIES + "\nSELECT * FROM verified"


# -- rejected_events: the side output of W1 ------------------------------------------------
def rejected_events(spark, sf_dir):
    return ev.rejected_events(_raw(spark, sf_dir), TEST_KEY)


QUERIES["rejected_events"] = rejected_events
ORACLES["rejected_events"] = ("WITH " + _DELIVERIES
                              + "\nSELECT received_at, status, body FROM routed WHERE status <> 'ok'")


# -- enriched_events: F9 J10 (W2) -----------------------------------------------------------
def enriched_events(spark, sf_dir):
    v = TrackerViews(spark, sf_dir)
    return ev.enrich_events(ev.verified_events(_raw(spark, sf_dir), TEST_KEY),
                            v.issues, v.states, v.teams)


QUERIES["enriched_events"] = enriched_events
ORACLES["enriched_events"] = with_views(["issues", "states", "teams"], "").rstrip() + ",\n" + \
    _DELIVERIES + """
SELECT v.*, i.identifier, i.title, s.name AS state_name, t.name AS team_name
FROM verified v
LEFT JOIN issues i ON v.data_id = CAST(i.id AS VARCHAR)
LEFT JOIN states s ON i.state_id = s.id
LEFT JOIN teams t ON i.team_id = t.id
WHERE v.data_id IS NOT NULL
  AND (coalesce(contains(lower(v.type), 'issue'), false) OR coalesce(v.data_type = 'Issue', false))"""


# -- event_page: T9 without a limit, every event with its place -----------------------------------
def event_page(spark, sf_dir):
    return ev.numbered_events(ev.verified_events(_raw(spark, sf_dir), TEST_KEY))


QUERIES["event_page"] = event_page
ORACLES["event_page"] = ("WITH " + _DELIVERIES + """
SELECT *, CAST(received_at AS DATE) AS day, row_number() OVER (
            PARTITION BY CAST(received_at AS DATE) ORDER BY received_at DESC, body DESC) AS place FROM verified""")


# -- latest_events: T9 ------------------------------------------------------------------------
def latest_events(spark, sf_dir):
    return ev.latest_events(ev.verified_events(_raw(spark, sf_dir), TEST_KEY), LATEST)


QUERIES["latest_events"] = latest_events
ORACLES["latest_events"] = ("WITH " + _DELIVERIES
                            + f"\nSELECT * FROM verified ORDER BY received_at DESC, body DESC LIMIT {LATEST}")


# -- events_as_of: W2 J10, the issue as it was at the event ---------------------------------------
def events_as_of(spark, sf_dir):
    return ev.enrich_events_as_of(ev.verified_events(_raw(spark, sf_dir), TEST_KEY), issue_versions(spark, sf_dir))


QUERIES["events_as_of"] = events_as_of
ORACLES["events_as_of"] = with_views(["issues", "teams"], "").rstrip() + ",\n" + _DELIVERIES + f""",
lines AS (SELECT l_orderkey, l_linenumber,
                 max(concat_ws(' ', CAST(l_linenumber AS VARCHAR), l_linestatus, l_returnflag)) AS state_name
          FROM lineitem GROUP BY 1, 2),
versions AS (SELECT CAST(i.id AS VARCHAR) AS id, i.identifier, i.title, l.state_name, t.name AS team_name,
                    TIMESTAMP '{FIRST_DAY}' + to_days(CAST(4 * (l.l_linenumber - 1) + l.l_orderkey % 4 AS INTEGER)) AS valid_from
             FROM lines l JOIN issues i ON i.id = l.l_orderkey LEFT JOIN teams t ON i.team_id = t.id)
SELECT v.*, i.identifier, i.title, i.state_name, i.team_name
FROM verified v ASOF LEFT JOIN versions i ON v.data_id = i.id AND v.received_at >= i.valid_from
WHERE v.data_id IS NOT NULL
  AND (coalesce(contains(lower(v.type), 'issue'), false) OR coalesce(v.data_type = 'Issue', false))"""
