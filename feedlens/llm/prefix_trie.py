"""Conversation prefix trie by ROLLUP over positional turn-id columns (operator 13).

A turn's id is the 128-bit hash of its role and text, with the text's length behind it.  Sequences
of turns are cut into blocks of WIDTH positional columns; ``GROUP BY block, prior, ROLLUP(t1, ...)``
with ``grouping_id`` aggregates the prefixes of all blocks in one job, where ``prior`` is the node
reached by the blocks before (a sum of 128-bit hashes, each of a position and its turn id, so
prefixes of a conversation of any length are running sums).

Nodes are told apart by that sum.  Each node belongs to its smallest member, which then owns all
deeper nodes of its own sequence too; so the nodes of a subtree are owned by members of its top, and
subtree totals are a second ROLLUP that adds, for each member, what it owns from that level on.

No group is gathered: places in a conversation and running sums come from two-level ranking, a
rollup level sends one partial row per prefix and task, and the ids ending at a node are joined in
sorted chunks whose digest is a stream.

Defined results: rows without conv_id belong to no conversation and are left out; equal turn numbers
of a conversation are ordered by turn id; repeated rows are turns of their own; other columns are
not read; an empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common
from feedlens.operators.ranking import numbered

#: Positional columns of a block.
WIDTH = 8
#: Shared first turns come from the conversation at the last multiple of this.
FAMILY = 100
MOST_SHARED = 5
LANES = 4
CHUNK_IDS = 8192


def turn_id(role, text) -> Column:
    """16 bytes of hash, then 8 bytes of the text's length in code points."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    return F.unhex(F.concat(digest, F.lpad(F.hex(F.char_length(text).cast("bigint")), 16, "0")))


def _lanes(position: Column, turn: Column) -> Column:
    """Hash of a turn at a position as LANES numbers of 32 bits, whose sums do not overflow."""
    digest = F.md5(F.concat_ws(":", position.cast("string"), F.hex(turn)))
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(LANES)])


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, position from 1, turn) of every conversation with the turns it shares with its
    family's first; one row with null position for a conversation without turns."""
    turns = numbered(conversations.filter("conv_id is not null").select(
        "conv_id", "turn", turn_id(F.col("role"), F.col("text")).alias("id")),
        [F.asc_nulls_first("turn"), F.asc("id")], ("conv_id",))
    turns = common.written(turns.select("conv_id", "place", "id"), "turns")
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    heads = (turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") <= MOST_SHARED))
             .groupBy(F.col("conv_id").alias("family")).agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("head")))
    listed = F.coalesce("head", F.array().cast("array<struct<place:bigint,id:binary>>"))
    convs = (turns.select("conv_id").distinct().withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
             .join(heads, "family", "left").select("conv_id", shared.alias("shared"), F.slice(listed, 1, shared).alias("head")))
    convs = common.written(convs, "heads")
    first = convs.select("conv_id", F.explode_outer("head").alias("h")).select(
        "conv_id", F.col("h.place").alias("position"), F.col("h.id").alias("turn"))
    own = (turns.filter(F.col("place") > shared).join(convs.select("conv_id", F.size("head").alias("taken")), "conv_id")
           .select("conv_id", (F.col("place") - shared + F.col("taken")).alias("position"), F.col("id").alias("turn")))
    return first.unionByName(own)


def blocks(sequences: DataFrame) -> DataFrame:
    """One row per conversation and block: ``t1`` ... (null after the end), ``prior`` (the node
    before the block) and ``own`` (the hash sums of the block).  Written."""
    at = F.coalesce(F.col("position") - 1, F.lit(0))
    lanes = F.when(F.col("turn").isNotNull(), _lanes(F.col("position"), F.col("turn")))
    rows = sequences.select("conv_id", F.floor(at / WIDTH).alias("block"), (at % WIDTH).alias("slot"), "turn", lanes.alias("lanes"))
    wide = rows.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == k, F.col("turn"))).alias(f"t{k + 1}") for k in range(WIDTH)],
        *[F.sum(F.coalesce(F.get("lanes", F.lit(i)), F.lit(0))).alias(f"l{i}") for i in range(LANES)])
    run = numbered(wide, [F.asc("block")], ("conv_id",), "_at", {f"p{i}": f"l{i}" for i in range(LANES)})
    return common.written(run.select(
        "conv_id", "block", *_turns(), F.array(*[F.col(f"p{i}") for i in range(LANES)]).alias("prior"),
        F.array(*[F.col(f"l{i}") for i in range(LANES)]).alias("own")), "blocks")


def _turns() -> list[str]:
    return [f"t{k + 1}" for k in range(WIDTH)]


def rolled_up(rows: DataFrame, totals: dict[str, str]) -> DataFrame:
    """Nodes of all blocks: ``key``, ``parent_key``, ``depth``, ``block``, ``level``, ``last`` (the
    node's last turn id) and the given aggregates, by one ROLLUP over the positional columns."""
    columns = ", ".join(_turns())
    aggregates = ", ".join(f"{sql} AS {name}" for name, sql in totals.items())
    levels = rows.sparkSession.sql(
        f"SELECT block, prior, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{rows}} GROUP BY block, prior, ROLLUP({columns})", rows=rows)
    found = levels.withColumn("path", F.array(*_turns())).withColumn("last", F.get("path", F.col("level") - 1))
    # a level whose last column is empty belongs to conversations that ended before; the top of a
    # later block is the last node of the block before
    nodes = found.filter(((F.col("level") == 0) & (F.col("block") == 0)) | F.col("last").isNotNull())
    steps = F.transform(F.slice("path", 1, F.col("level")),
                        lambda turn, i: _lanes(F.col("block") * WIDTH + i + 1, turn))
    key = F.aggregate(steps, F.col("prior"), _plus)
    parent = F.aggregate(F.slice(steps, 1, F.greatest(F.col("level") - 1, F.lit(0))), F.col("prior"), _plus)
    return nodes.select(key.alias("key"), F.when(F.col("level") > 0, parent).alias("parent_key"),
                        (F.col("block") * WIDTH + F.col("level")).alias("depth"), "block", "level", "last", *totals)


def owned(rows: DataFrame, nodes: DataFrame, children: DataFrame) -> DataFrame:
    """``rows`` (blocks) with ``s1`` ...: what the conversation's own nodes save from that level on,
    ``s0``: from the block's top on, and ``leaf``: 1 where it owns a childless node at or after the block."""
    value = (F.col("n_convs") - 1) * F.coalesce(F.conv(F.hex(F.substring("last", 17, 8)), 16, 10).cast("bigint"), F.lit(0))
    childless = F.when(F.col("n_children").isNull(), 1).otherwise(0)
    own = (nodes.join(children, "key", "left").groupBy("conv_id", "block").agg(
        *[F.sum(F.when(F.col("level") == k + 1, value)).alias(f"v{k + 1}") for k in range(WIDTH)],
        F.sum(childless).alias("leaf")))
    wide = rows.join(own, ["conv_id", "block"], "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ["leaf", *[f"v{k + 1}" for k in range(WIDTH)]]})
    wide = wide.withColumn("v", reduce(lambda a, b: a + b, [F.col(f"v{k + 1}") for k in range(WIDTH)]))
    run = numbered(wide, [F.desc("block")], ("conv_id",), "_at", {"later": "v", "later_leaf": "leaf"})
    from_level = {f"s{k}": reduce(lambda a, b: a + b, [F.col("later"), *[F.col(f"v{j}") for j in range(max(k, 1), WIDTH + 1)]])
                  for k in range(WIDTH + 1)}
    return run.select("conv_id", "block", "prior", *_turns(), (F.col("leaf") + F.col("later_leaf")).alias("leaf"),
                      *[c.cast("bigint").alias(n) for n, c in from_level.items()])


def _joined(batches):
    """Chunks of comma-joined ids of sorted (key, conv_id) rows."""
    held, first, ids = None, None, []
    for batch in batches:
        for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (key != held or len(ids) >= CHUNK_IDS):
                yield pa.RecordBatch.from_pydict({"key": [held], "first": [first], "ids": [",".join(map(str, ids))]}, _CHUNK)
                ids = []
            if not ids:
                held, first = key, conv
            ids.append(conv)
    if ids:
        yield pa.RecordBatch.from_pydict({"key": [held], "first": [first], "ids": [",".join(map(str, ids))]}, _CHUNK)


def _digested(batches):
    """SHA-256 of the chunks of each key, which come sorted; one running digest at a time."""
    held, digest = None, None
    for batch in batches:
        keys, digests = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if digest is not None and key == held:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                keys.append(held)
                digests.append(digest.hexdigest())
            held, digest = key, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pydict({"key": keys, "ends_sha256": digests}, _DIGEST)
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"key": [held], "ends_sha256": [digest.hexdigest()]}, _DIGEST)


_KEY = pa.list_(pa.int64())
_CHUNK = pa.schema([("key", _KEY), ("first", pa.int64()), ("ids", pa.string())])
_DIGEST = pa.schema([("key", _KEY), ("ends_sha256", pa.string())])


def end_digests(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids of the conversations that end at each node."""
    ends = rows.select("conv_id", *[F.get("own", F.lit(i)).alias(f"l{i}") for i in range(LANES)]).groupBy("conv_id").agg(
        F.array(*[F.sum(f"l{i}") for i in range(LANES)]).alias("key"))
    chunks = (ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .mapInArrow(_joined, "key array<bigint>, first bigint, ids string"))
    return (common.written(chunks, "ends").repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(_digested, "key array<bigint>, ends_sha256 string"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    rows = blocks(rebuilt(conversations))
    nodes = common.written(rolled_up(rows, {"n_convs": "count(*)", "conv_id": "min(conv_id)"}), "nodes")
    children = nodes.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    saved = "element_at(array(" + ", ".join(f"sum(s{k})" for k in range(WIDTH + 1)) + f"), {WIDTH + 1} - bit_count(grouping_id()))"
    totals = rolled_up(owned(rows, nodes, children), {
        "n_convs": "count(*)", "conv_id": "min(conv_id)", "n_leaves": "sum(leaf)", "saved_tokens": saved})
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    found = totals.join(children, "key", "left").join(end_digests(rows), "key", "left").join(parents, "parent_key", "left")
    return found.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(spark, sf_dir) -> DataFrame:
    return trie(common.table(spark, sf_dir, "conversations"))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLES = {"op13_prefix_trie": f"""
WITH t AS (SELECT conv_id, coalesce(text, '') AS text, turn,
                  md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, id, length(text) AS len,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id, length(text)) AS pos FROM t),
s AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS c FROM p),
c AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, 8 * length(c)),
                        lambda i: CASE WHEN i % 8 = 0 THEN ord(c[CAST(i // 8 + 1 AS INTEGER)])::BIGINT ELSE 0::BIGINT END)),
                      lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295::BIGINT) % {MOST_SHARED + 1} AS h
      FROM s),
n AS (SELECT conv_id, count(*) AS n FROM p GROUP BY conv_id),
r AS (SELECT c.conv_id, p.pos, p.id, p.len FROM c JOIN p ON p.conv_id = c.conv_id - c.conv_id % {FAMILY} AND p.pos <= c.h
      UNION ALL
      SELECT c.conv_id, p.pos - c.h + least(c.h, coalesce(n.n, 0)), p.id, p.len
      FROM c JOIN p ON p.conv_id = c.conv_id AND p.pos > c.h LEFT JOIN n ON n.conv_id = c.conv_id - c.conv_id % {FAMILY}),
path AS (SELECT conv_id, pos AS depth, len, md5(string_agg(id || len, '/') OVER (PARTITION BY conv_id ORDER BY pos)) AS path FROM r
         UNION ALL SELECT conv_id, 0, 0, '' FROM c),
node AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(len) AS saved FROM path GROUP BY 1, 2),
up AS (SELECT node.path, node.depth, o.path AS parent FROM node JOIN path o ON o.conv_id = node.conv_id AND o.depth = node.depth - 1),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM up GROUP BY 1, 2),
sub AS (SELECT o.path, o.depth, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(u.saved) AS saved
        FROM node u JOIN path o ON o.conv_id = u.conv_id AND o.depth <= u.depth
        LEFT JOIN kids k ON k.parent = u.path AND k.depth = u.depth GROUP BY 1, 2),
last AS (SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id),
ends AS (SELECT path.path, path.depth, sha256(string_agg(CAST(path.conv_id AS VARCHAR), ',' ORDER BY path.conv_id)) AS sha
         FROM path JOIN last ON path.conv_id = last.conv_id AND path.depth = last.depth GROUP BY 1, 2)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, node.n_convs,
       coalesce(kids.n, 0) AS n_children, CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens,
       coalesce(ends.sha, sha256('')) AS ends_sha256
FROM node JOIN sub ON node.path = sub.path AND node.depth = sub.depth
LEFT JOIN up ON up.path = node.path AND up.depth = node.depth
LEFT JOIN node above ON above.path = up.parent AND above.depth = up.depth - 1
LEFT JOIN kids ON kids.parent = node.path AND kids.depth = node.depth
LEFT JOIN ends ON ends.path = node.path AND ends.depth = node.depth"""}
