"""Issue search by a trigram index (F6): containing matches without reading every title.

``build_index`` writes three sorted tables, so a filter on their first column skips files and row
groups by their bounds:

* ``postings`` (trigram, id): every run of three characters of an issue's title or identifier;
* ``counts`` (trigram, n): the number of issues holding it;
* ``entries`` (id, number, identifier, title).

A search looks its trigrams up in ``counts``, intersects the postings of the rarest few and verifies
the surviving issues with the very condition of the scan.  Queries shorter than a trigram read the
entries; ``TEAM-123`` filters them by number.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions import scalars as S
from feedlens.operators.issues import clamp_limit, matches

#: Postings read for a search: the rarest trigrams of the query.
RAREST = 3
GRAM = 3
#: Characters, and so trigrams at most, of a part of the index.
CHARS_PER_PARTITION = 1_000_000
MIN_PARTITIONS = 16


def _grams(text: Column) -> Column:
    """All runs of GRAM characters, each once (the lookahead makes runs overlap)."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?s)(?=(" + "." * GRAM + "))"), 1))


def build_index(issues: DataFrame, path: str) -> None:
    """Write the index of ``issues`` (id, number, identifier, title)."""
    spark = issues.sparkSession
    entries = issues.select("id", "number", "identifier", F.coalesce("title", F.lit("")).alias("title"))
    chars = entries.agg(F.sum(F.length("title") + F.coalesce(F.length("identifier"), F.lit(0)))).first()[0] or 0
    parts = max(MIN_PARTITIONS, math.ceil(chars / CHARS_PER_PARTITION))     # a run of characters starts at each
    entries.repartitionByRange(parts, "id").sortWithinPartitions("id").write.parquet(f"{path}/entries")
    stored = spark.read.parquet(f"{path}/entries")
    both = F.array_union(_grams(F.col("title")), _grams(F.coalesce("identifier", F.lit(""))))
    postings = stored.select(F.explode(both).alias("trigram"), "id").repartitionByRange(parts, "trigram", "id")
    postings.sortWithinPartitions("trigram", "id").write.parquet(f"{path}/postings")
    counts = spark.read.parquet(f"{path}/postings").groupBy("trigram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("trigram").sortWithinPartitions("trigram").write.parquet(f"{path}/counts")


def rarest(spark: SparkSession, path: str, query: str) -> list[str] | None:
    """The trigrams of the query held by the fewest issues; None when one is held by none."""
    q = query.lower()
    wanted = sorted({q[i:i + GRAM] for i in range(len(q) - GRAM + 1)})
    found = (spark.read.parquet(f"{path}/counts").filter(F.col("trigram").isin(wanted))
             .orderBy("n", "trigram").collect())                          # as many rows as the query has trigrams
    if len(found) < len(wanted):
        return None
    return [r.trigram for r in found[:RAREST]]


def candidates(spark: SparkSession, path: str, trigrams: list[str]) -> DataFrame:
    """Ids of the issues that hold all the given trigrams."""
    postings = spark.read.parquet(f"{path}/postings").filter(F.col("trigram").isin(trigrams))
    return postings.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(trigrams)).select("id")


def search_index(spark: SparkSession, path: str, query: str | None, limit=None) -> DataFrame:
    """F6 + T6 over an index: the rows of :func:`feedlens.operators.issues.search_issues`."""
    n = clamp_limit(limit)
    q = (query or "").strip()
    entries = spark.read.parquet(f"{path}/entries")
    m = re.match(S.IDENTIFIER_PATTERN, q)
    if m:
        key, _ = S.parse_identifier(F.col("identifier"))
        hits = entries.filter((F.col("number") == int(m.group(2))) & (key == m.group(1).upper()))
    elif len(q) < GRAM:
        hits = entries.filter(matches(q)) if q else entries
    else:
        grams = rarest(spark, path, q)
        if grams is None:
            hits = entries.filter(F.lit(False))
        else:
            hits = entries.join(candidates(spark, path, grams), "id", "left_semi").filter(matches(q))
    return hits.select("id", "identifier", "title").orderBy("id").limit(n)
