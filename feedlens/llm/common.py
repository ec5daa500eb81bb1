"""Helpers shared by the corpus operators: table reading, scratch tables, word rules.

Word rule of the digests: ``[^\\x20\\x09-\\x0D]+``, i.e. ASCII white space separates.  On UTF-8
bytes this is exactly ``bytes.split()``.
"""

from __future__ import annotations

import ctypes
import os
import uuid
from functools import partial, wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.session import ensure_checkpoint_dir

#: The word rule as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts handled together by the array code: at most this many characters (or one text).
CHUNK_CHARS = 250_000
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
#: Key tables of at most this many rows (8 bytes a key) are broadcast, larger ones shuffled.
BROADCAST_ROWS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.  Unlike
    ``checkpoint()`` the table is columnar and compressed, and its size is known to the
    planner, so joins with it broadcast only what is measured to be small."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def small_side(keys: DataFrame) -> DataFrame:
    """``keys`` (written before, narrow) with a broadcast hint where its row count is in bounds."""
    return F.broadcast(keys) if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else keys


def map_arrow(df: DataFrame, task, schema: str) -> DataFrame:
    """``df.mapInArrow(task, schema)`` in batches of BATCH_ROWS rows and BATCH_BYTES bytes at most
    (a longer row is a batch by itself), so that a Python worker holds little text at a time, and
    returns its memory when a task ends, as it waits for tasks of other stages then."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(partial(_released, task=task), schema)


def _released(batches, task):
    try:
        yield from task(batches)
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)             # where the C library has it
        if trim is not None:
            trim(0)


def isolated(*used: str):
    """For an operator that returns its input's columns: those it does not use are renamed inside it,
    so that no name of theirs clashes with its own working columns."""
    def wrapped(operator):
        @wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            inner = [n if n in used else f"_other{i}" for i, n in enumerate(docs.columns)]
            return operator(docs.toDF(*inner), *args, **options).toDF(*docs.columns)
        return run
    return wrapped


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def chunks(texts: list[str], most: int = CHUNK_CHARS):
    """Consecutive index ranges (lo, hi) whose texts hold about ``most`` characters."""
    lo = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > most:
            yield lo, i
            lo, total = i, 0
        total += len(text) + 1
    if lo < len(texts):
        yield lo, len(texts)


def rows(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
