"""S3: customer requests ("needs") nested under the issue or project that hosts them.

Documents arrive the way a tracker API pages them: one row per host and page,
holding at most about ``page_size`` needs.  :func:`read_need_docs` reads such
documents from JSON/parquet with the fixed schema; :func:`issue_need_docs` and
:func:`project_need_docs` derive them from the benchmark tables:

* issue-hosted: one need per ``lineitem`` row of the order (request id =
  ``l_partkey``), customer = the order's customer with revenue ``c_acctbal``
  and size = number of orders of that customer;
* project-hosted: one need per ``part`` row (request id = ``p_partkey``),
  hosted by the project (nation) numbered by its brand.

Pages are chosen by a hash of the need, with ``ceil(n / page_size)`` pages per
host, so even a host holding a third of all needs is split into bounded arrays
spread over many tasks, and a recomputed task produces the same pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.sources.tables import Tables
from feedlens.sources.tracker import TrackerViews

PAGE_SIZE = 50
# Columns whose hash deals the rows of a host to its pages.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
PART_KEY = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


def read_need_docs(spark: SparkSession, path: str, kind: str = "issue",
                   fmt: str = "json") -> DataFrame:
    """Read issue- or project-hosted need documents with their fixed nested schema."""
    schema = schemas.ISSUE_DOC if kind == "issue" else schemas.PROJECT_DOC
    reader = spark.read.schema(schema)
    return reader.json(path) if fmt == "json" else reader.format(fmt).load(path)


def _paged(facts: DataFrame, host: str, row_hash: list[str], page_size: int) -> DataFrame:
    """The rows with a page number each: ``hash(row) mod ceil(n_host / page_size)``.  The host
    counts are a partial aggregate, joined back null-safely (needs without a host are kept); a hot host is split by
    adaptive skew handling."""
    counts = facts.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("_n"))
    hashed = facts.withColumn("_deal", F.xxhash64(*row_hash))      # shuffled in place of the columns it is made of
    return (hashed.join(counts, F.col(host).eqNullSafe(F.col("_host")))
            .withColumn("page", F.pmod("_deal", F.ceil(F.col("_n") / F.lit(page_size))).cast("bigint"))
            .drop("_n", "_host", "_deal"))


def customer_accounts(t: Tables) -> DataFrame:
    """Customer id, name, revenue text and size text (orders per customer)."""
    sizes = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return (t.customer.join(sizes, "c_custkey", "left")
            .select("c_custkey", "c_name",
                    F.round("c_acctbal").cast("bigint").cast("string").alias("revenue"),
                    F.coalesce("n_orders", F.lit(0)).cast("string").alias("size")))


def issue_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per issue id with ``hosts``: its issue, project and customer columns (an element
    for each row a repeated key gives, one as a rule)."""
    t = Tables(spark, sf_dir)
    issues = TrackerViews(spark, sf_dir).issues.select("id", "identifier", "title", "project_id", "assignee_id")
    projects = t.nation.select(F.col("n_nationkey").alias("_pid"), F.col("n_name").alias("project_name"))
    joined = (issues.join(projects, F.col("project_id") == F.col("_pid"), "left")
              .join(customer_accounts(t), F.col("assignee_id") == F.col("c_custkey"), "left"))
    host = F.struct("identifier", "title",
                    F.when(F.col("_pid").isNotNull(),
                           F.struct(F.col("_pid").cast("string").alias("id"),
                                    F.col("project_name").alias("name"))).alias("project"),
                    F.when(F.col("c_custkey").isNotNull(),
                           F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                                    F.col("revenue"), F.col("size"))).alias("customer"))
    return joined.groupBy("id").agg(F.collect_list(host).alias("hosts"))


def _issue_need(order: Column, host: Column, item: Column) -> Column:
    """The need of a lineitem (its part, line, status and flag) of an issue."""
    part, line, flag = item["l_partkey"].cast("string"), item["l_linenumber"], item["l_returnflag"]
    return F.struct(
        part.alias("id"),
        F.when(item["l_linestatus"] == "O",
               F.concat(F.lit("  ship part "), part, F.lit(" line "), line.cast("string"), F.lit(" "))).alias("body"),
        F.when(flag == "R", F.lit(1)).when(flag == "A", F.lit(0))
         .when(line > 5, line).cast("int").alias("priority"),
        host["customer"].alias("customer"),
        F.when(flag == "R", F.struct(F.concat(
            F.lit("https://tracker.example.com/att/"), order.cast("string"),
            F.lit("-"), line.cast("string")).alias("url"))).alias("attachment"),
        host["project"].alias("project"),
        F.struct(order.cast("string").alias("id"), host["identifier"].alias("identifier"),
                 host["title"].alias("title")).alias("issue"))


def issue_need_docs(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Issue documents (schema ``ISSUE_DOC``): one row per (issue, page).

    The lineitems are paged and gathered by their own few columns; what they share with their
    issue is joined once per document and written into the needs there, so it is never shuffled
    once per need."""
    items = Tables(spark, sf_dir).lineitem.filter(F.col("l_orderkey").isNotNull())
    pages = (_paged(items, "l_orderkey", LINE_KEY, page_size)       # counted before any dimension join
             .groupBy("l_orderkey", "page")
             .agg(F.collect_list(F.struct("l_partkey", "l_linenumber", "l_linestatus", "l_returnflag")).alias("_items")))
    docs = pages.join(issue_hosts(spark, sf_dir), F.col("l_orderkey") == F.col("id"))
    needs = F.flatten(F.transform("hosts", lambda host: F.transform(
        "_items", lambda item: _issue_need(F.col("id"), host, item))))
    first = F.get("hosts", F.lit(0))
    return docs.select(F.col("id").cast("string").alias("id"), first["identifier"].alias("identifier"),
                       first["title"].alias("title"), first["project"].alias("project"), "page", needs.alias("needs"))


def project_needs_flat(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """One row per project-hosted need with its host columns and page; parts whose brand
    names no nation share the null host."""
    t = Tables(spark, sf_dir)
    p, n = t.part, t.nation
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).try_cast("int")
    j = _paged(p.join(n, brand_no - 1 == n.n_nationkey, "left"), "n_nationkey", PART_KEY, page_size)
    size = F.col("p_size")
    need = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("body"),
        F.when(size > 40, F.lit(1)).when(size > 20, F.lit(0)).cast("int").alias("priority"),
        F.lit(None).cast(schemas.CUSTOMER).alias("customer"),
        F.lit(None).cast(schemas.ATTACHMENT).alias("attachment"),
        F.when(F.col("n_nationkey").isNotNull(),
               F.struct(F.col("n_nationkey").cast("string").alias("id"),
                        F.col("n_name").alias("name"))).alias("project"),
        F.lit(None).cast(schemas.ISSUE_REF).alias("issue"))
    return j.select(F.col("n_nationkey").cast("string").alias("host_id"),
                    F.col("n_name").alias("name"), need.alias("need"), "page")


def project_need_docs(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Project documents (schema ``PROJECT_DOC``): one row per (project, page)."""
    flat = project_needs_flat(spark, sf_dir, page_size)
    return (flat.groupBy("host_id", "page")
            .agg(F.first("name").alias("name"), F.collect_list("need").alias("needs"))
            .select(F.col("host_id").alias("id"), "name", "page", "needs"))
