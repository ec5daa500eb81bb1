"""Feedback tables: a delimited file of requests (S1, S2) or the benchmark tables.

``feedback_from_tables`` builds the request table the analyzer works on from
``documents`` (request text) ⟕ ``labels`` (priority code = quality) ⟕
``customer`` (request of doc ``d`` comes from customer ``d mod #customers``;
revenue = account balance, size = number of that customer's orders).  The
customer count is a scalar subquery, evaluated once, not a cross join.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.scalars import priority_label
from feedlens.sources.delimited import read_delimited
from feedlens.sources.tables import Tables

# Fixed values.
DELIMITERS = (",", ";", "\t", "|")
UNNAMED = re.compile(r"^unnamed:?\s*\d*$")


def sniff_delimiter(header_line: str) -> str:
    """Pick the candidate delimiter that occurs most often outside quotes."""
    outside = re.sub(r'"[^"]*"', "", header_line)
    counts = {d: outside.count(d) for d in DELIMITERS}
    best = max(DELIMITERS, key=lambda d: counts[d])
    return best if counts[best] > 0 else ","


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim and lower-case names; drop ``unnamed: N`` index columns."""
    names = [str(c).strip().lower() for c in df.columns]
    renamed = df.toDF(*names)
    return renamed.select(*[F.col(f"`{n}`") for n in names if not UNNAMED.match(n)])


def read_feedback(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Read a delimited request file, every column as a string.

    The delimiter is sniffed from the header line only (one small read) when not
    given; records may span lines and use doubled quotes, and one large file is still
    read by many tasks (:mod:`feedlens.sources.delimited`)."""
    if sep is None:
        first = spark.read.text(path).limit(1).collect()
        sep = sniff_delimiter(first[0][0] if first else "")
    return normalize_columns(read_delimited(spark, path, sep))


def feedback_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request table with columns doc_id, request, lang, customer, customer_revenue,
    customer_size, priority (label text, as the extract writes it)."""
    t = Tables(spark, sf_dir)
    n_customers = t.customer.select(F.count(F.lit(1))).scalar()
    sizes = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    cust = (t.customer.join(sizes, "c_custkey", "left")
            .select("c_custkey", "c_name", "c_acctbal",
                    F.coalesce("n_orders", F.lit(0)).alias("n_orders")))
    docs = t.documents.select("doc_id", "text", "lang",
                              F.pmod("doc_id", n_customers).alias("_cust"))
    lab = t.labels.select(F.col("doc_id").alias("_ldoc"), "quality")
    j = (docs.join(lab, docs.doc_id == lab._ldoc, "left")
         .join(cust, F.col("_cust") == F.col("c_custkey"), "left"))
    return j.select("doc_id", F.col("text").alias("request"), "lang",
                    F.col("c_name").alias("customer"),
                    F.col("c_acctbal").alias("customer_revenue"),
                    F.col("n_orders").alias("customer_size"),
                    priority_label(F.col("quality")).alias("priority"))
