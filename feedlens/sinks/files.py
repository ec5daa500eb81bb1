"""File sinks (K1-K4).  Each writes with the DataFrame writer: many part files,
one per task, never funnelled through the driver."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.operators import issues

# Reader options that round-trip what :func:`write_requests` writes.
REQUESTS_READ_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
#: The request column that is quoted always; the others where the value asks for it.
QUOTED_ALWAYS = "request"
_PARTITION_BITS = 33                                       # of monotonically_increasing_id


def csv_field(column: str | Column, always: bool = False) -> Column:
    """A CSV field: quotes doubled; quoted ``always``, else where it holds a quote, comma or line
    break; null is empty."""
    value = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return quoted if always else F.when(value.rlike('[",\\n\\r]'), quoted).otherwise(value)


def request_lines(df: DataFrame) -> DataFrame:
    """K1 line rule: one ``value`` per request (a line may hold line breaks inside quotes)."""
    return df.select(F.concat_ws(",", *[csv_field(c, c == QUOTED_ALWAYS) for c in schemas.REQUEST_COLUMNS]).alias("value"))


def write_requests(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: the 12-column request CSV, ``request`` always quoted and other fields only when needed.

    Lines go through the text sink, the first line of every file behind a header line; one more
    file holds the header alone, so an empty selection is a header-only table."""
    header = F.lit(",".join(schemas.REQUEST_COLUMNS))
    first = F.monotonically_increasing_id() % (1 << _PARTITION_BITS) == 0
    lines = request_lines(df).select(F.when(first, F.concat_ws("\n", header, "value")).otherwise(F.col("value")).alias("value"))
    lines.unionByName(df.sparkSession.range(1).select(header.alias("value"))).write.mode(mode).text(path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Read what :func:`write_requests` wrote (all strings, an empty field is ``""``)."""
    read = spark.read.schema(schemas.REQUESTS).options(**REQUESTS_READ_OPTIONS).csv(path)
    return read.select(*[F.coalesce(c, F.lit("")).alias(c) for c in read.columns])


def cluster_example_columns(report: DataFrame, samples: int) -> DataFrame:
    """K2 layout: ``Cluster, Count, Example_1..N`` with N = the largest example list
    (capped at ``samples``), short lists padded with ``""``."""
    width = report.agg(F.max(F.size("examples")).alias("m")).first()["m"] or 0
    width = min(int(width), samples) if width else samples
    cols = [F.col("cluster").alias("Cluster"), F.col("count").alias("Count")]
    cols += [F.coalesce(F.try_element_at("examples", F.lit(i + 1)), F.lit("")).alias(f"Example_{i + 1}")
             for i in range(width)]
    return report.orderBy("rank").select(*cols)


def write_cluster_examples(report: DataFrame, path: str, samples: int = 3,
                           mode: str = "overwrite") -> None:
    """K2: ``pain_point_summary.csv`` (k rows, so one output file)."""
    (cluster_example_columns(report, samples).coalesce(1).write.mode(mode)
     .option("header", True).option("escape", '"').csv(path))


def write_members(members: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K2/K4: every row of every cluster (rank, cluster, id, line), many part files."""
    members.write.mode(mode).format(fmt).save(path)


def write_snapshot(sections: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """K3: the workspace snapshot, one CSV directory per section
    (``section=issues_by_project_state``, ``section=active_projects``, ...)."""
    for name, df in sections.items():
        (df.write.mode(mode).option("header", True).option("escape", '"')
         .csv(os.path.join(path, f"section={name}")))


# Headers of the sections of the snapshot file, in order.
LISTING_HEADER = "section,project,state,identifier,title,assignee"
TEAM_HEADER = ",team"
ACTIVE_HEADER = "section,project,project_id,state,open_issues"
LOAD_HEADER = "section,assignee,open_issues"
_LINE_ORDER = ["part", "row", "n", "a", "b", "id"]


def snapshot_lines(open_lite: DataFrame, projects: DataFrame, with_team: bool = False) -> DataFrame:
    """K3: the lines of the sectioned snapshot (``value``) with their order: issues by project and
    state, active projects, assignee load, each under its header and a blank line apart."""
    listing = issues.snapshot_listing(open_lite.withColumn("_id", F.col("id")), ["_id"])
    shown = ["section", "project", "state", "identifier", "title", "assignee", *(["team"] if with_team else [])]
    active, load = issues.active_project_load(open_lite, projects), issues.assignee_load(open_lite)

    def lines(df, part, n, a, b, key, fields):
        return df.select(F.lit(part).alias("part"), F.lit(1).alias("row"), n.cast("bigint").alias("n"), a.cast("string").alias("a"),
                         b.cast("string").alias("b"), key.cast("string").alias("id"), F.concat_ws(",", *map(csv_field, fields)).alias("value"))
    none, c = F.lit(None), F.col
    heads = [(i, 0, None, None, None, None, ("\n" if i else "") + h) for i, h in enumerate(
        (LISTING_HEADER + TEAM_HEADER * with_team, ACTIVE_HEADER, LOAD_HEADER))]
    rows = open_lite.sparkSession.createDataFrame(heads, "part int, row int, n bigint, a string, b string, id string, value string")
    for each in (lines(listing, 0, none, c("project"), c("state"), F.lpad(c("_id").cast("string"), 20, "0"), shown),
                 lines(active, 1, -c("open_count"), c("project_name"), none, c("project_id"),
                       [F.lit("active_projects"), "project_name", c("project_id").cast("string"), "state", c("open_count").cast("string")]),
                 lines(load, 2, -c("open_count"), c("assignee_name"), none, c("assignee"),
                       [F.lit("assignee_load"), "assignee_name", c("open_count").cast("string")])):
        rows = rows.unionByName(each)
    return rows


def write_snapshot_file(open_lite: DataFrame, projects: DataFrame, path: str, with_team: bool = False, mode: str = "overwrite") -> None:
    """K3 as one sectioned text: the part files in order of their names, one behind the other, are
    the file.  Lines are dealt by ranges of their order, so no task holds the body."""
    (snapshot_lines(open_lite, projects, with_team).repartitionByRange(*_LINE_ORDER).sortWithinPartitions(*_LINE_ORDER)
     .select("value").write.mode(mode).text(path))


def write_report(report: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """K4: cluster insights (rank, title, representative, summary, terms, examples)."""
    report.orderBy("rank").coalesce(1).write.mode(mode).format(fmt).save(path)
