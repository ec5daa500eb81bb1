"""Registered request-extract and feedback-preparation queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from feedlens.functions.text import clean_text, normalize_text
from feedlens.functions.weights import URGENT_PRIORITIES, weights_or_ones, with_weights
from feedlens.operators import requests as rq
from feedlens.operators.text import TEXT_NAME_HINT
from feedlens.operators.text import text_column_scores as _scores
from feedlens.plans.oracle_views import with_views
from feedlens.sources import needs
from feedlens.sources.feedback import feedback_from_tables
from feedlens.sources.tables import Tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

REQUEST_COLS = ("project, issue, issue_title, request_id, customer, customer_revenue, customer_size, "
                "priority, source, reference_project, reference_issue, request")

# -- requests_nested: S3 J2 J4 P6 P7 -------------------------------------------------
def requests_nested(spark, sf_dir):
    docs = needs.issue_need_docs(spark, sf_dir)
    return rq.issue_needs(docs).drop("_src", "_host")


QUERIES["requests_nested"] = requests_nested
ORACLES["requests_nested"] = with_views(["issue_requests"],
                                        f"SELECT {REQUEST_COLS} FROM issue_requests")


# -- project_requests: J3 P7 P8 -------------------------------------------------------
def project_requests(spark, sf_dir):
    docs = needs.project_need_docs(spark, sf_dir)
    return rq.project_needs(docs).drop("_src", "_host")


QUERIES["project_requests"] = project_requests
ORACLES["project_requests"] = with_views(["project_requests"],
                                         f"SELECT {REQUEST_COLS} FROM project_requests")


# -- requests_deduped: U1 A1 (workspace scope) ------------------------------------------
def requests_deduped(spark, sf_dir):
    return rq.all_requests(needs.issue_need_docs(spark, sf_dir),
                           needs.project_need_docs(spark, sf_dir))


QUERIES["requests_deduped"] = requests_deduped
ORACLES["requests_deduped"] = with_views(["issue_requests", "project_requests"], f"""
SELECT {REQUEST_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id
                               ORDER BY _src, _host, request, customer, priority, source) AS rn
  FROM (SELECT * FROM issue_requests UNION ALL SELECT * FROM project_requests) u) r
WHERE rn = 1""")


# -- request_weights: P3 P4 P6 P9 -----------------------------------------------------
def request_weights(spark, sf_dir):
    fb = with_weights(feedback_from_tables(spark, sf_dir))
    return fb.select("doc_id", "priority", "customer_revenue", "customer_size",
                     F.round("weight", 6).alias("weight"))


QUERIES["request_weights"] = request_weights
_URGENT_SQL = ", ".join(f"'{p}'" for p in URGENT_PRIORITIES)
ORACLES["request_weights"] = with_views(["feedback"], f"""
SELECT doc_id, trim(priority) AS priority,
       coalesce(TRY_CAST(customer_revenue AS DOUBLE), 0.0) AS customer_revenue,
       coalesce(TRY_CAST(customer_size AS DOUBLE), 0.0) AS customer_size,
       round((CASE WHEN lower(trim(priority)) IN ({_URGENT_SQL})
                   THEN 5.0 ELSE 1.0 END)
             * ln(1 + ln(1 + greatest(coalesce(TRY_CAST(customer_revenue AS DOUBLE), 0.0), 0.0)))
             * (1 + ln(1 + greatest(coalesce(TRY_CAST(customer_size AS DOUBLE), 0.0), 0.0))), 6) AS weight
FROM feedback""")


# -- fit_weights: P10 on the computed weights and on all-zero ones ---------------------------
def fit_weights(spark, sf_dir):
    fb = with_weights(feedback_from_tables(spark, sf_dir)).select("doc_id", "weight", F.lit(0.0).alias("zero"))
    used, weighted = weights_or_ones(fb)
    ones, _ = weights_or_ones(used, "zero")
    return ones.select("doc_id", F.round("weight", 6).alias("weight"), F.col("zero").alias("zero_weight"),
                       F.lit(weighted).alias("weighted"))


QUERIES["fit_weights"] = fit_weights
ORACLES["fit_weights"] = f"""
WITH w AS ({ORACLES["request_weights"]})
SELECT doc_id, weight, 1.0::DOUBLE AS zero_weight,
       (SELECT max(weight) > 0 AND min(weight) <> max(weight) FROM w) AS weighted
FROM w"""


# -- scoped_requests: F2, one project by name ------------------------------------------------
SCOPE_PROJECT = "NATION_7"


def scoped_requests(spark, sf_dir):
    return rq.all_requests(needs.issue_need_docs(spark, sf_dir), needs.project_need_docs(spark, sf_dir),
                           {"project_name": SCOPE_PROJECT})


QUERIES["scoped_requests"] = scoped_requests
ORACLES["scoped_requests"] = with_views(["issue_requests", "project_requests"], f"""
SELECT {REQUEST_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id
                               ORDER BY _src, _host, request, customer, priority, source) AS rn
  FROM (SELECT * FROM issue_requests UNION ALL SELECT * FROM project_requests) u
  WHERE project = '{SCOPE_PROJECT}') r
WHERE rn = 1""")


# -- clean_texts: P2 P5 F12 -----------------------------------------------------------
def clean_texts(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    c = d.select("doc_id", clean_text("text").alias("clean")).filter(F.col("clean").isNotNull())
    return c.select("doc_id", F.length("clean").cast("bigint").alias("clean_len"),
                    normalize_text("clean").alias("norm"))


QUERIES["clean_texts"] = clean_texts
ORACLES["clean_texts"] = r"""
SELECT doc_id, length(clean) AS clean_len,
       regexp_replace(regexp_replace(lower(clean), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS norm
FROM (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS clean FROM documents) t
WHERE length(clean) > 0"""


# -- text_column_scores: P1 A7 ----------------------------------------------------------
def text_column_scores(spark, sf_dir):
    return _scores(Tables(spark, sf_dir).documents)


def _score_sql(col: str) -> str:
    bonus = "5.0" if re.search(TEXT_NAME_HINT, col) else "0.0"
    return f"""SELECT '{col}' AS column_name, count({col}) AS n_nonnull,
       round(count({col}) * 1.0 / greatest(count(*), 1), 6) AS frac_nonnull,
       round(coalesce(avg(length(CAST({col} AS VARCHAR))), 0.0), 6) AS avg_len,
       round(count({col}) * 10.0 / greatest(count(*), 1)
             + coalesce(avg(length(CAST({col} AS VARCHAR))), 0.0) / 50.0 + {bonus}, 6) AS score
FROM documents"""


ORACLES["text_column_scores"] = "SELECT *, column_name = 'text' AS chosen FROM (\n" + \
    "\nUNION ALL\n".join(_score_sql(c) for c in ("doc_id", "text", "lang", "source", "n_chars")) + \
    ") s"
QUERIES["text_column_scores"] = text_column_scores
