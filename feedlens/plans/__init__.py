"""Registry of named queries: each key maps to a Spark plan builder and, when the
result is expressible in SQL, to an equivalent DuckDB/ANSI SQL oracle."""

from __future__ import annotations

from feedlens.plans import clusters, events, requests, roundtrips, text, tracker

_MODULES = [tracker, requests, text, clusters, events, roundtrips]


def queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out


def flagship(spark, sf_dir):
    """The analyzer end to end: cluster report over the request table."""
    return clusters.cluster_report(spark, sf_dir)
