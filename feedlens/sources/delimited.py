"""Delimited files with quoted line breaks, read by many tasks.

A quoted field may hold line breaks, so a task that starts inside a file cannot know whether its
first line begins a record.  What a run of lines does to that question is a function of one bit
(inside quotes or not), and such functions compose:

1. every block of a file (the text source's own splits) reports how it ends when it begins outside
   and inside quotes, with the text of the record it would leave open;
2. a prefix scan over the blocks of a file composes these functions: each block learns how it
   begins, and which earlier block began the record it continues;
3. every block is read again with that knowledge and gives the records that lie in it whole; the
   few records across blocks are put together from the texts of step 1.

Quotes count as the CSV rule says: one opens a field only at its start, a doubled one is text.
Records are split into columns by ``from_csv``.  Lines end with ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

from functools import partial
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlens.session import written

QUOTE = '"'


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether the text after ``line`` is inside quotes."""
    if QUOTE not in line:
        return inside
    parts = line.split(QUOTE)
    closed = False                                         # a quote has just ended a field
    at_start = not inside and (not parts[0] or parts[0].endswith(sep))
    for part in parts[1:]:
        if inside:
            inside, closed = False, True
        elif closed:
            inside, closed = True, False                   # doubled
        elif at_start:
            inside = True
        if not inside and part:
            closed, at_start = False, part.endswith(sep)
    return inside


def _blocks(batches):
    """(file, block, lines) of consecutive rows of the same block."""
    def rows():
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value").to_pylist(),
                           batch.column("begins_inside").to_pylist() if "begins_inside" in batch.schema.names else [None] * batch.num_rows)
    for (file, block), run in groupby(rows(), key=lambda r: r[:2]):
        yield file, block, run


_ENDS = pa.schema([("file", pa.string()), ("block", pa.int64()),
                   *[(f"{a}_{b}", t) for a in ("outside", "inside") for b, t in (
                       ("ends_inside", pa.bool_()), ("leading", pa.string()), ("open", pa.string()), ("records", pa.int64()))]])
_ENDS_SQL = "file string, block bigint, " + ", ".join(
    f"{a}_ends_inside boolean, {a}_leading string, {a}_open string, {a}_records bigint" for a in ("outside", "inside"))


class _Run:
    """Records of a block that begins outside or inside quotes."""

    def __init__(self, inside: bool):
        self.inside, self.continued, self.lines, self.leading, self.records = inside, inside, [], None, 0

    def add(self, line: str, sep: str) -> str | None:
        """The record that ends with ``line`` if it began here."""
        self.lines.append(line)
        self.inside = ends_inside(line, self.inside, sep)
        if self.inside:
            return None
        text, self.lines = "\n".join(self.lines), []
        text = text[:-1] if text.endswith("\r") else text
        if self.continued:
            self.continued, self.leading = False, text
            return None
        self.records += text != ""
        return text or None


def _block_ends(batches, sep):
    for file, block, run in _blocks(batches):
        sides = _Run(False), _Run(True)
        for _, _, line, _ in run:
            for side in sides:
                side.add(line, sep)
        row = {"file": [file], "block": [block]}
        for name, side in zip(("outside", "inside"), sides):
            left = "\n".join(side.lines) if side.lines else None
            row |= {f"{name}_ends_inside": [side.inside], f"{name}_records": [side.records],
                    f"{name}_leading": [side.leading if not side.continued else left],
                    f"{name}_open": [None if side.continued else left]}
        yield pa.RecordBatch.from_pydict(row, _ENDS)


def _whole_records(batches, sep):
    for file, block, run in _blocks(batches):
        side, number, records, firsts = None, 0, [], []
        for _, _, line, begins in run:
            side = side or _Run(begins)
            record = side.add(line, sep)
            if record is not None:
                number += 1
                records.append(record)
                firsts.append(block == 0 and number == 1)
                if len(records) >= 1000:
                    yield pa.RecordBatch.from_pydict({"record": records, "first": firsts})
                    records, firsts = [], []
        if records:
            yield pa.RecordBatch.from_pydict({"record": records, "first": firsts})


def _chained(ends: DataFrame) -> DataFrame:
    """Blocks with ``begins_inside``, what they hold of records across blocks, and ``head``, the block
    where the record begins that they begin inside of."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = (F.col("outside_ends_inside") & ~F.col("inside_ends_inside")).cast("int")
    fixed = F.col("outside_ends_inside") == F.col("inside_ends_inside")
    swapped = ends.withColumn("swaps", F.sum(swaps).over(upto))
    last = F.last(F.when(fixed, F.struct(F.col("outside_ends_inside").cast("int").alias("v"), F.col("swaps").alias("s"))), True).over(before)
    known = swapped.withColumn("known", last).withColumn("so_far", F.coalesce(F.max("swaps").over(before), F.lit(0)))
    parity = F.coalesce("known.v", F.lit(0)) + F.col("so_far") - F.coalesce("known.s", F.lit(0))
    begun = known.withColumn("begins_inside", parity % 2 == 1)

    def side(name):
        return F.when(F.col("begins_inside"), F.col(f"inside_{name}")).otherwise(F.col(f"outside_{name}"))
    own = begun.select("file", "block", "begins_inside", side("leading").alias("leading"), side("open").alias("open"), side("records").alias("records"))
    return own.withColumn("head", F.last(F.when(F.col("open").isNotNull(), F.col("block")), True).over(before))


def _across(chained: DataFrame) -> DataFrame:
    """(record, first) of the records that lie in several blocks."""
    begun = chained.filter("open is not null").select("file", F.col("block").alias("head"), "block", F.col("open").alias("text"),
                                                      ((F.col("block") == 0) & (F.col("records") == 0)).alias("first"))
    continued = chained.filter("begins_inside and leading is not null and head is not null").select(
        "file", "head", "block", F.col("leading").alias("text"), F.lit(False).alias("first"))
    parts = begun.unionByName(continued).groupBy("file", "head").agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"), F.bool_or("first").alias("first"))
    return parts.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("record"), "first")


def read_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(record, first): the text of every record; ``first`` marks the first of a file.  Blank lines
    between records are no records."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    chained = written(_chained(lines.mapInArrow(partial(_block_ends, sep=sep), _ENDS_SQL)), "blocks")
    begins = chained.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "begins_inside")
    placed = lines.join(F.broadcast(begins), (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))).drop("_f", "_b")   # a row a block
    whole = placed.mapInArrow(partial(_whole_records, sep=sep), "record string, first boolean")
    return whole.unionByName(_across(chained))


def read_delimited(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """A delimited file or folder with a header line per file, every column a string."""
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}
    names = spark.read.options(header="true", inferSchema="false", **options).csv(path).columns
    if not names:
        return spark.createDataFrame([], StructType([]))
    fields = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))), options)
    rows = read_records(spark, path, sep).filter(~F.col("first")).select(fields.alias("r"))
    return rows.select(*[F.col("r")[f"c{i}"].alias(n) for i, n in enumerate(names)])

