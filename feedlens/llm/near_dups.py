"""N-gram Jaccard join with Bayesian candidate pruning (operator 9).

Documents with equal sets of five-word shingles form a class; everything below works on classes.
128 MinHash values of 16 bits, in 32 bands of four, propose pairs.  A pair is looked at in the
first band it shares, in blocks of at most about 2 * TILE classes: hot bands are cut into tiles and every pair of
tiles is a block of its own, so no group lands in one task.  Inside a block MinHash values are
compared 16 at a time; a pair is dropped once the posterior probability (uniform prior) that its
similarity reaches the threshold falls below TOLERANCE.  The rest is verified exactly on the full
shingle sets.  Links leave a block as counts per class and as edges to the least class reached,
never as all pairs.

A pair of similarity s shares no band with probability (1 - s^4)^32: 4.5e-8 at 0.8, less above.

Defined results: a null text counts as empty; texts without words are one class without links to
others; fewer words than a shingle form one shingle; repeated rows are copies; the class id is
the least doc_id of the group (null where no row of it has an id).  Texts of any length take part
whole; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import math
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm import common
from feedlens.llm.bpe_merge import Costs

SHINGLE = 5
THRESHOLD = 0.8
VALUES, PER_BAND = 128, 4
BANDS = VALUES // PER_BAND
STEP = 16
TOLERANCE = 1e-9
TILE = 512
BUNCH_ROWS = 4096
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def word_cache() -> Costs:
    return Costs({}, xxhash.xxh3_64_intdigest, most=48 << 20)


def shingle_set(text: str, cache: Costs) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, n)
    width = min(n, SHINGLE)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out = out * _PRIME + h[k:n - width + 1 + k]
    return np.unique(_finish(out + np.uint64(width)))


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    g = np.random.Generator(np.random.PCG64(11))
    draw = g.integers(0, 2 ** 63, size=(2, VALUES), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signature(shingles: np.ndarray) -> np.ndarray:
    """BANDS packed words of PER_BAND 16-bit MinHash values."""
    a, b = _functions()
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        part = shingles[i:i + 1024, None] * a
        part += b
        np.minimum(least, part.min(0), out=least)
    return _finish(least).astype(np.uint16).view(np.int64)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Matches needed after each STEP compared values to stay a candidate.

    With a uniform prior the posterior P(similarity >= t | m of n equal) is P(Binomial(n+1, t) <= m)."""
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        below, m = (1 - threshold) ** (n + 1), 0
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def prune(sigs: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, band: np.ndarray,
          threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) met in ``band`` that share no earlier band and survive the size bound and the
    incremental comparison.  ``sigs`` [rows, BANDS], ``band`` per pair."""
    near = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j])
    i, j, band = i[near], j[near], band[near]
    fine = sigs.view(np.uint16)
    matches = np.zeros(len(i), np.int64)
    for step, least in enumerate(least_matches(threshold, tolerance)):
        if not len(i):
            break
        cut = slice(step * STEP, (step + 1) * STEP)
        matches += (fine[i, cut] == fine[j, cut]).sum(1)
        stay = matches >= least
        i, j, band, matches = i[stay], j[stay], band[stay], matches[stay]
    if len(i):
        first = (sigs[i] == sigs[j]).argmax(1) == band
        i, j = i[first], j[first]
    return i, j


def _sign(batches):
    cache = word_cache()
    for batch in batches:
        sets = (shingle_set(t, cache) for t in common.texts_of(batch))
        cids, sizes, sigs = [], [], []
        for s in sets:
            cids.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
            sizes.append(len(s))
            sigs.append(signature(s))
        flat = np.concatenate(sigs) if sigs else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(cids, pa.int64()), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), pa.array(flat, pa.int64()))],
            ["doc_id", "row", "cid", "size", "sig"])


def _groups(batches, keys: list[str]):
    """Runs of complete groups (equal ``keys``, rows sorted by them) as (table, starts)."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < BUNCH_ROWS:
            continue
        starts = _starts(held, keys)
        if len(starts) > 1:
            last = int(starts[-1])
            yield held.slice(0, last).combine_chunks(), starts[:-1]
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks(), _starts(held, keys)


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    return np.ascontiguousarray(flat).reshape(-1, BANDS)


_CANDIDATES = "blk bigint, cid bigint, mult bigint, rep bigint, partners array<bigint>"


def _propose(batches, threshold, tolerance):
    for t, starts in _groups(batches, ["blk"]):
        sigs, sizes = _matrix(t.column("sig")), t.column("size").to_numpy()
        cid, band, tile = (t.column(c).to_numpy() for c in ("cid", "band", "tile"))
        lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
        ends = np.append(starts[1:], t.num_rows)
        ii, jj = [], []
        for a, b in zip(starts.tolist(), ends.tolist()):
            if lo[a] == hi[a]:
                i, j = np.triu_indices(b - a, 1)
                ii.append(i + a)
                jj.append(j + a)
            else:
                left, right = np.flatnonzero(tile[a:b] == lo[a]) + a, np.flatnonzero(tile[a:b] == hi[a]) + a
                ii.append(np.repeat(left, len(right)))
                jj.append(np.tile(right, len(left)))
        i, j = np.concatenate(ii), np.concatenate(jj)
        found = [prune(sigs, sizes, i[x:x + 50_000], j[x:x + 50_000], band[i[x:x + 50_000]], threshold, tolerance)
                 for x in range(0, len(i), 50_000)]
        if not found:
            continue
        i, j = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        rows = np.union1d(i, j)
        if not len(rows):
            continue
        offsets = np.append(np.searchsorted(i, rows), len(i))
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [t.column(c).combine_chunks().take(take) for c in ("blk", "cid", "mult", "rep")]
            + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cid[j], pa.int64()))],
            ["blk", "cid", "mult", "rep", "partners"])


def links_of(sets: list[np.ndarray], partners: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose Jaccard similarity reaches the threshold, exactly."""
    lengths = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(sets) else np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    mark = np.zeros(len(ids) + 1, bool)
    left, right = [], []
    for a, others in enumerate(partners):
        if not len(others):
            continue
        own = ids[ends[a] - lengths[a]:ends[a]]
        mark[own] = True
        for x in range(0, len(others), 256):
            b = others[x:x + 256]
            joined = np.concatenate([mark[ids[ends[k] - lengths[k]:ends[k]]] for k in b])
            common_n = np.add.reduceat(joined, np.cumsum(lengths[b]) - lengths[b], dtype=np.int64)
            linked = b[common_n >= threshold * (lengths[a] + lengths[b] - common_n) - 1e-9]
            left.append(np.full(len(linked), a))
            right.append(linked)
        mark[own] = False
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def _verify(batches, threshold):
    cache = word_cache()
    for t, starts in _groups(batches, ["blk"]):
        columns = {c: t.column(c).to_pylist() for c in ("cid", "mult", "partners", "text")}
        out = {"cid": [], "root": [], "texts": [], "docs": []}
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows]):
            at: dict[int, int] = {}
            sets, partners, mult = [], [], []
            for k in range(a, b):
                cid = columns["cid"][k]
                if cid in at:
                    continue
                s = shingle_set(columns["text"][k] or "", cache)
                if xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) == cid:
                    at[cid] = len(sets)
                    sets.append(s)
                    partners.append(columns["partners"][k])
                    mult.append(columns["mult"][k])
            i, j = links_of(sets, [np.array([at[p] for p in ps], np.int64) for ps in partners], threshold)
            if not len(i):
                continue
            cids, m = np.array(list(at), np.int64), np.array(mult, np.int64)
            root = cids.copy()
            while True:                                            # least class id reached over links
                least = root.copy()
                np.minimum.at(least, i, root[j])
                np.minimum.at(least, j, least[i])
                if (least == root).all():
                    break
                root = least
            n = len(cids)
            texts = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
            docs = np.bincount(i, m[j], n) + np.bincount(j, m[i], n)
            rows = np.flatnonzero(texts)
            for name, v in (("cid", cids), ("root", root), ("texts", texts), ("docs", docs.astype(np.int64))):
                out[name].append(v[rows])
        if out["cid"]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v), pa.int64()) for v in out.values()], list(out))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): least node of the connected component of every node of ``edges`` (a, b).

    Labels move along edges and then jump to the label of their label, until none changes."""
    both = common.written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    labels = common.written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "near-labels")
    while True:
        offered = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m")))
        moved = labels.join(offered, labels["node"] == offered["a"]).select(
            "node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        moved = common.written(moved, "near-moved")
        jump = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
        new = common.written(moved.join(jump, "label").select("node", F.least("label", "to").alias("label"),
                                                              (F.least("label", "to") != F.col("old")).alias("changed")), "near-labels")
        labels = new.select("node", "label")
        if new.filter("changed").isEmpty():
            return labels


def row_key():
    return F.xxhash64(F.lit(17), "doc_id", F.coalesce("text", F.lit("")))


def link(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """(documents, classes): doc_id, row and cid of every document; cid, mult, rep, first_id, label,
    texts and docs of every class.  label is the least cid of the group; texts counts the linked
    classes, docs their documents."""
    signed = common.written(
        docs.select("doc_id", "text", row_key().alias("row"))
        .transform(common.map_arrow, _sign, "doc_id bigint, row bigint, cid bigint, size bigint, sig array<bigint>"), "near-signed")
    classes = common.written(signed.groupBy("cid", "size", "sig").agg(
        F.count("*").alias("mult"), F.min("row").alias("rep"), F.min("doc_id").alias("first_id")), "near-classes")
    exploded = classes.filter("size > 0").select("cid", F.posexplode("sig").alias("band", "value"))
    counts = exploded.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    shared = exploded.join(counts, ["band", "value"])
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    members = (shared.join(classes, "cid")
               .withColumn("tile", F.pmod(F.xxhash64(F.lit(5), "cid"), tiles).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
               .select("cid", "size", "sig", "mult", "rep", "band", "tile", F.least("tile", "other").alias("lo"),
                       F.greatest("tile", "other").alias("hi"), "value")
               .withColumn("blk", F.xxhash64("band", "value", "lo", "hi")).drop("value"))
    proposed = common.written(members.repartition("blk").sortWithinPartitions("blk").transform(
            common.map_arrow,
        partial(_propose, threshold=threshold, tolerance=tolerance), _CANDIDATES), "near-candidates")
    reps = common.written(proposed.select("rep").distinct(), "near-reps")
    # one row of a representative, however often it is repeated, before it meets its blocks
    texts = (docs.select(row_key().alias("rep"), "text").join(common.small_side(reps), "rep", "left_semi")
             .groupBy("rep").agg(F.min("text").alias("text")))
    with_text = texts.join(proposed, "rep").select("blk", "cid", "mult", "partners", "text")
    verified = common.written(with_text.repartition("blk").sortWithinPartitions("blk").transform(
            common.map_arrow,
        partial(_verify, threshold=threshold), "cid bigint, root bigint, texts bigint, docs bigint"), "near-links")
    links = verified.groupBy("cid").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    labels = components(verified.filter("cid != root").select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct())
    joined = (classes.select("cid", "mult", "rep", "first_id").join(links, "cid", "left")
              .join(labels.withColumnRenamed("node", "cid"), "cid", "left")
              .select("cid", "mult", "rep", "first_id", F.coalesce("label", "cid").alias("label"),
                      F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs")))
    return signed.select("doc_id", "row", "cid"), common.written(joined, "near-joined")


def classified(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links (other documents at or above the threshold, copies included) and
    n_text_links (different texts) of every row."""
    every, classes = link(docs, threshold)
    groups = classes.groupBy("label").agg(F.min("first_id").alias("class_id"))
    known = common.written(classes.join(groups, "label").select(
        "cid", "class_id", (F.col("docs") + F.col("mult") - 1).alias("n_links"), F.col("texts").alias("n_text_links")), "near-known")
    return every.join(known, "cid").select("doc_id", "class_id", "n_links", "n_text_links")


@common.isolated("doc_id", "text")
def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: of the least doc_id, null last."""
    every, classes = link(docs, threshold)
    rows = every.join(classes.select("cid", "label"), "cid").groupBy("label", "row").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    rows = common.written(rows, "near-rows")
    best = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("k"))
    judged = common.written(rows.join(best, "label").select("row", "n", (F.col("row") == F.col("k.row")).alias("best"))
                            .filter("n > 1 or not best").select(F.col("row").alias("__near_row"), "best"), "near-judged")
    keyed = docs.withColumn("__near_row", row_key())
    kept = keyed.join(common.small_side(judged.select("__near_row")), "__near_row", "left_anti").drop("__near_row")
    twins = judged.filter("best").select("__near_row")
    if twins.isEmpty():
        return kept
    one = Window.partitionBy("__near_row").orderBy("__near_row")           # equal rows: any one of them
    first = keyed.join(twins, "__near_row", "left_semi").withColumn("__near_nth", F.row_number().over(one)).filter("__near_nth = 1")
    return kept.unionByName(first.drop("__near_row", "__near_nth"))


def op9_near_duplicates(spark, sf_dir) -> DataFrame:
    return classified(common.documents(spark, sf_dir))


QUERIES = {"op9_near_duplicates": op9_near_duplicates}
ORACLES: dict[str, str] = {}
