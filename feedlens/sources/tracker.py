"""Tracker entities (issues, users, states, projects, teams, cycles, labels).

Two ways in:

* ``read_entity`` reads an entity table that already exists as parquet or JSON
  files, with the fixed schema from :mod:`feedlens.schemas`.
* :class:`TrackerViews` derives the same entities from the benchmark tables
  (orders → issues, customer → users, nation → projects, region → teams,
  lineitem → issue labels), so every tracker query runs over data that grows
  with the scale factor.

Dimension joins carry no broadcast hints: adaptive execution measures the built
side at runtime and broadcasts it only when it is below
``spark.sql.autoBroadcastJoinThreshold``; larger sides fall back to a shuffle
join.  The mapping below is the single definition the SQL oracles mirror.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.sources.tables import Tables

# Fixed values of the mapping (they are data conventions, mirrored in the SQL oracles).
STATE_NAMES = {"F": "Done", "O": "Todo", "P": "In Progress"}
STATE_TYPES = {"F": "completed", "O": "unstarted", "P": "started"}
LABELS = ("A", "N", "R")
# Project state by region name of the project's nation; anything else is paused.
PROJECT_STATES = {"ASIA": "Started", "EUROPE": "planned"}
PROJECT_ARCHIVED_AT = "2000-01-01 00:00:00"
ARCHIVE_EVERY_NTH_PROJECT = 7
UNTITLED_PRIORITY = "4-NOT SPECIFIED"
CANCELED_PRIORITY = "4-NOT SPECIFIED"
ARCHIVED_PRIORITY = "5-LOW"


def read_entity(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read one tracker entity or relation table with its fixed schema."""
    schema = schemas.ENTITY_SCHEMAS[name]
    reader = spark.read.schema(schema)
    if fmt == "json":
        return reader.json(path)
    return reader.format(fmt).load(path)


def _case(col: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, F.lit(value)) if expr is None
                else expr.when(col == key, F.lit(value)))
    return expr.otherwise(default) if default is not None else expr


def _rows(spark: SparkSession, columns: str, rows: list[tuple[str, ...]]) -> DataFrame:
    """A small fixed dimension as literal rows (no scan of the facts that use it)."""
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def team_key(name: Column) -> Column:
    """Team key = the letters of the team name, upper-cased (``MIDDLE EAST`` → ``MIDDLEEAST``)."""
    return F.regexp_replace(F.upper(name), "[^A-Z]", "")


class TrackerViews:
    """Tracker entities derived from one benchmark data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    # -- dimensions -----------------------------------------------------
    @property
    def teams(self) -> DataFrame:
        r = self.t.region
        return r.select(F.col("r_regionkey").alias("id"),
                        team_key(F.col("r_name")).alias("key"),
                        F.col("r_name").alias("name"))

    @property
    def projects(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
                .select(F.col("n_nationkey").alias("id"),
                        F.col("n_name").alias("name"),
                        _case(F.col("r_name"), PROJECT_STATES, F.lit("paused")).alias("state"),
                        F.when(F.col("n_nationkey") % ARCHIVE_EVERY_NTH_PROJECT == 0,
                               F.lit(PROJECT_ARCHIVED_AT).cast("timestamp_ntz"))
                        .alias("archived_at")))

    @property
    def team_projects(self) -> DataFrame:
        return self.t.nation.select(F.col("n_regionkey").alias("team_id"),
                                    F.col("n_nationkey").alias("project_id"))

    @property
    def users(self) -> DataFrame:
        c = self.t.customer
        return c.select(F.col("c_custkey").alias("id"),
                        F.col("c_name").alias("name"),
                        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")),
                                 F.lit("@example.com")).alias("email"),
                        F.col("c_nationkey").alias("nation_id"))

    @property
    def states(self) -> DataFrame:
        """The workflow states, a fixed dimension."""
        return _rows(self.spark, "id, name, type", [(i, STATE_NAMES[i], STATE_TYPES[i]) for i in STATE_NAMES])

    @property
    def labels(self) -> DataFrame:
        """The issue labels, a fixed dimension."""
        return _rows(self.spark, "id, name", [(i, i) for i in LABELS])

    @property
    def issue_labels(self) -> DataFrame:
        return self.t.lineitem.select(F.col("l_orderkey").alias("issue_id"),
                                      F.col("l_returnflag").alias("label_id"))

    # -- facts ----------------------------------------------------------
    @property
    def issues(self) -> DataFrame:
        """:attr:`issue_facts` with project (the assignee's nation), team (its region) and the
        identifier built from the team key."""
        c, n = self.t.customer, self.t.nation
        teams = self.teams
        return (self.issue_facts
                .join(c.select("c_custkey", "c_nationkey"), F.col("assignee_id") == F.col("c_custkey"), "left")
                .join(n.select("n_nationkey", "n_regionkey"),
                      F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .join(teams.select(F.col("id").alias("t_id"), F.col("key").alias("t_key")),
                      F.col("n_regionkey") == F.col("t_id"), "left")
                .select("id", F.concat(F.col("t_key"), F.lit("-"), F.col("id").cast("string")).alias("identifier"),
                        "number", "title", "state_id", F.col("c_nationkey").alias("project_id"),
                        F.col("n_regionkey").alias("team_id"), "assignee_id",
                        "completed_at", "canceled_at", "archived_at", "updated_at"))

    @property
    def issue_facts(self) -> DataFrame:
        """The issue columns held by ``orders`` alone, for queries that need neither project
        nor team (left joins are not pruned, so those queries must not contain them)."""
        key = F.col("o_orderkey")
        status, prio, date = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
        title = F.when(prio != UNTITLED_PRIORITY,
                       F.concat(F.lit("Order "), key.cast("string"), F.lit(" "),
                                F.lower(F.substring(prio, 3, 100))))
        return self.t.orders.select(
            key.alias("id"), key.alias("number"), title.alias("title"), status.alias("state_id"),
            F.col("o_custkey").alias("assignee_id"),
            F.when(status == "F", date).alias("completed_at"),
            F.when((status == "P") & (prio == CANCELED_PRIORITY), date).alias("canceled_at"),
            F.when((status != "P") & (prio == ARCHIVED_PRIORITY), date).alias("archived_at"),
            date.alias("updated_at"))

    @property
    def cycles(self) -> DataFrame:
        """One cycle per (team, calendar year) spanning the issues updated in it."""
        i = self.issues
        teams = self.teams
        year = F.year("updated_at")
        agg = (i.groupBy("team_id", year.alias("year"))
               .agg(F.min("updated_at").alias("starts_at"), F.max("updated_at").alias("ends_at")))
        return (agg.join(teams, agg.team_id == teams.id, "left")
                .select(F.concat(F.col("key"), F.lit("-"), F.col("year").cast("string")).alias("id"),
                        F.col("team_id"),
                        F.concat(F.lit("Cycle "), F.col("year").cast("string")).alias("name"),
                        "starts_at", "ends_at"))
