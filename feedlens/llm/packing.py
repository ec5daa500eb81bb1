"""Packing documents into sequences by cutting-stock column generation (operator 11).

A document's ids end with END.  Whole runs of CAPACITY ids fill a sequence each; the rests (shorter
than a sequence) are packed:

1. Spark counts the rests by length class (WIDTH lengths a class, the upper one counting);
2. on these at most CAPACITY / WIDTH counts an optimisation program chooses patterns, i.e. how many rests
   of each class share a sequence: the simplex method on the patterns found so far, and a knapsack
   dynamic program over the dual prices that finds the next pattern or proves that none helps;
3. the pattern counts are rounded down, low enough that the documents left over hold at least as
   many ids as the patterns leave free;
4. documents are ranked within their class (two-level, no window over a class) and take the places
   of the patterns in that order; offsets are running sums inside a sequence;
5. the documents left over are laid along the free ends of those sequences and then along new ones,
   being cut where one ends: both are gapless lines, overlaid in cells of CAPACITY ids.  The very
   last ids go to sequences of powers of two, which need no padding.

Ids are made once, in one worker pass, and stay in a table; the checksums of whole runs and rests
are taken there, and only left-over documents read their ids again.

Defined results: a null text counts as empty and has one id, END; repeated rows and null ids are
documents of their own; very long texts are encoded in parts cut before a space between a
non-space and a letter, where every encoding begins a new pre-token; special strings inside texts
are special tokens, as in the tokenizer library; other columns are not read; an empty table gives
no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm import common
from feedlens.operators.ranking import numbered

CAPACITY = 2048
#: Lengths in a class of the optimisation program.
WIDTH = 16
#: The program ends when its total is proven to be this near to the least.
GAP = 1e-3
#: Share of the best dual prices so far in the prices a pattern is sought for.
SMOOTHING = 0.8
END = 1
#: A text longer than this is encoded in parts.
PART_CHARS = 250_000
_CUT = re.compile(r"(?<=\S)(?= [^\W\d_])")
#: Ids left over against free ids, so that documents longer than their class's mean do no harm.
MARGIN = 1.02


# -- ids -----------------------------------------------------------------------------------

def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves,
    the others numbered from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level tokenizer file.

    Its merges are in the order of the ids they make (checked), so merging by lowest id is the
    same; the pre-token pattern is the library's.  Runs of white space too long for that engine go
    to the tokenizer library itself."""

    def __init__(self, file: str, pattern: str):
        import tiktoken
        import tokenizers
        spec = json.loads(file)
        vocabulary, byte = spec["model"]["vocab"], _byte_of()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("merges are not in the order of their ids")
        ranks = {bytes(byte[c] for c in piece): i for piece, i in vocabulary.items() if piece not in special}
        self.special = special
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.library = tokenizers.Tokenizer.from_str(file)

    def _part(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= PART_CHARS:
            return self._part(text)
        parts, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, min(at + PART_CHARS, len(text)))
            end = cut.start() if cut else len(text)
            parts.append(self._part(text[at:end]))
            at = end
        return np.concatenate(parts)


def _tokenize(batches, file, pattern, end, capacity):
    encoder = Encoder(file.value, pattern)
    for batch in batches:
        ids, sums = [], []
        for text in common.texts_of(batch):
            packed = np.append(encoder.ids(text), np.uint32(end)).astype("<u4").tobytes()
            ids.append(packed)
            sums.append([zlib.crc32(packed[i:i + 4 * capacity]) for i in range(0, len(packed), 4 * capacity)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(sums, pa.list_(pa.int64()))], ["doc_id", "ids", "crcs"])


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, ids, crcs, row, n), written: packed ids with END, the checksums of each run of
    ``capacity`` ids, a number of the row and its count of ids."""
    import public_tokenizers
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())                   # vocabulary-sized
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").transform(
        common.map_arrow, partial(_tokenize, file=shared, pattern=public_tokenizers.PATTERN, end=END, capacity=capacity),
        f"doc_id {kind}, ids binary, crcs array<bigint>")
    return common.written(made.select("*", F.monotonically_increasing_id().alias("row"),
                                      (F.octet_length("ids") / 4).cast("bigint").alias("n")), "ids", compression="zstd")


# -- patterns ---------------------------------------------------------------------------------

def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best value and item counts of an unbounded knapsack; ``sizes`` rise."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if fitting[c]:
            values = best[c - sizes[:fitting[c]]] + prices[:fitting[c]]
            i = int(values.argmax())
            if values[i] > best[c]:
                best[c], choice[c] = values[i], i
    counts, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return float(best[room]), counts


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a column each) and how often each is used, of a total proven to be within ``gap`` of
    the least that gives every size its ``demand``, not rounded.

    Patterns are priced between the current dual prices and the best ones so far (which start at
    the sizes' shares of the room); prices divided by their best pattern's value are feasible for
    the dual, so they also bound the total from below."""
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse, used = np.diag(1 / np.diag(basis)), demand / np.diag(basis)
    centre, bound = sizes / room, 0.0
    turn = 0
    while True:
        turn += 1
        prices, smooth = inverse.sum(axis=0), SMOOTHING
        while True:
            mixed = smooth * centre + (1 - smooth) * prices
            value, pattern = knapsack(mixed, sizes, room)
            if demand @ mixed / value > bound:
                centre, bound = mixed / value, float(demand @ mixed / value)
            if prices @ pattern > 1 + 1e-9 or smooth == 0 or used.sum() <= bound * (1 + gap):
                break
            smooth = smooth / 2 if smooth > 0.1 else 0.0
        if prices @ pattern <= 1 + 1e-9 or used.sum() <= bound * (1 + gap):
            return basis.astype(np.int64), used
        step = inverse @ pattern
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, used / step, np.inf)
        out = int(ratio.argmin())
        used = used - ratio[out] * step
        used[out] = ratio[out]
        basis[:, out] = pattern
        if turn % 200:
            row = inverse[out] / step[out]
            inverse = inverse - np.outer(step, row)
            inverse[out] = row
        else:
            inverse = np.linalg.inv(basis)
        used = np.maximum(used, 0)


def plan(lengths: dict[int, int], capacity: int = CAPACITY, width: int = WIDTH) -> list[tuple[int, dict[int, int]]]:
    """Whole pattern counts: (times, {class: rests}) for a histogram of rest lengths.

    Class q holds the lengths from (q - 1) * width + 1 to q * width.  Counts are rounded down after
    a common factor, the largest for which the rests left over make up the free ids."""
    size, count = np.array(sorted(lengths)), np.array([lengths[k] for k in sorted(lengths)], float)
    if not len(size):
        return []
    classes, at = np.unique(-(-size // width), return_inverse=True)
    demand = np.bincount(at, count)
    mean = np.bincount(at, count * size) / demand
    patterns, times = column_generation(classes, demand, capacity // width)

    def rounded(share: float) -> np.ndarray:
        return np.floor(times * share + 1e-9)

    def enough(whole: np.ndarray) -> bool:
        taken = patterns @ whole
        free = capacity * whole.sum() - taken @ mean
        return bool((taken <= demand).all() and (demand - taken) @ mean >= MARGIN * free)

    low, high = 0.0, 1.0
    if enough(rounded(high)):
        low = high
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if enough(rounded(middle)) else (low, middle)
    whole = rounded(low).astype(np.int64)
    return [(int(t), {int(classes[i]): int(k) for i, k in enumerate(patterns[:, p]) if k})
            for p, t in enumerate(whole) if t]


# -- places ---------------------------------------------------------------------------------

def _slots(spark, patterns):
    """(class, lo, hi, base, copies, first): ranks lo < rank <= hi of a class take the sequences from
    ``base`` on, ``copies`` to each, at places from ``first`` on.  One row for each class of a pattern."""
    rows, taken, base = [], {}, 0
    for times, pattern in patterns:
        first = 0
        for q in sorted(pattern, reverse=True):
            lo = taken.get(q, 0)
            taken[q] = lo + times * pattern[q]
            rows.append((q, lo, taken[q], base, pattern[q], first))
            first += pattern[q]
        base += times
    return spark.createDataFrame(rows, "q int, lo bigint, hi bigint, base bigint, copies int, first int"), base


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def overlay(fillers: DataFrame, slots: DataFrame, cell: int = CAPACITY) -> DataFrame:
    """(row, start, length, sequence_id, offset): ``fillers`` (row, start, length, at) laid on
    ``slots`` (sequence_id, offset, length, at), two gapless lines from 0, in cells of ``cell``."""
    def cut(df, kind, columns):
        end = F.col("at") + F.col("length")
        one = df.select(F.struct(*columns, "at", end.alias("end")).alias(kind), "at", (end - 1).alias("last"))
        at = one.select(kind, "at", F.explode(F.sequence(F.floor(F.col("at") / cell), F.floor(F.col("last") / cell))).alias("cell"))
        return at.select("cell", F.greatest("at", F.col("cell") * cell).alias("begin"), kind)
    a, b = cut(fillers, "f", ["row", "start"]), cut(slots, "s", ["sequence_id", "offset"])
    both = a.unionByName(b, allowMissingColumns=True)
    here = Window.partitionBy("cell").orderBy("begin")
    until = here.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    marks = both.select("cell", "begin", F.last("f", True).over(until).alias("f"), F.last("s", True).over(until).alias("s"),
                        F.lead("begin").over(Window.partitionBy("cell").orderBy("begin", F.col("f").isNull())).alias("next"))
    length = F.least(F.coalesce("next", (F.col("cell") + 1) * cell), "f.end", "s.end") - F.col("begin")
    parts = marks.select(
        F.col("f.row").alias("row"), (F.col("f.start") + F.col("begin") - F.col("f.at")).alias("start"), length.alias("length"),
        F.col("s.sequence_id").alias("sequence_id"), (F.col("s.offset") + F.col("begin") - F.col("s.at")).alias("offset"))
    # a piece cut by the edge of a cell alone is one piece
    return parts.filter("length > 0").groupBy("row", "sequence_id").agg(
        F.min("start").alias("start"), F.sum("length").alias("length"), F.min("offset").alias("offset"))


def packed(tokens: DataFrame, capacity: int = CAPACITY, width: int = WIDTH) -> DataFrame:
    """Pieces of rows of :func:`tokenized`: doc_id, row, start, length, ids_crc32, doc_tokens,
    sequence_id and offset."""
    spark = tokens.sparkSession
    rest = (F.col("n") % capacity).alias("rest")
    slim = tokens.select("row", "doc_id", "n", rest, F.element_at("crcs", -1).alias("crc")).filter("rest > 0") \
        .withColumn("q", F.ceil(F.col("rest") / width).cast("int"))
    histogram = {r.rest: r["count"] for r in slim.groupBy("rest").count().collect()}          # < capacity rows
    slots, n_patterns = _slots(spark, plan(histogram, capacity, width))

    ranked = numbered(slim, [F.asc("row")], ("q",), "rank").alias("d")
    placed = common.written(ranked.join(F.broadcast(slots).alias("p"), F.expr("d.q = p.q AND rank > lo AND rank <= hi"), "left").select(
        "row", "doc_id", "n", "rest", "crc", (F.col("base") + F.floor((F.col("rank") - 1 - F.col("lo")) / F.col("copies"))).alias("sequence_id"),
        (F.col("first") + (F.col("rank") - 1 - F.col("lo")) % F.col("copies")).alias("slot")), "placed")

    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.col("n") - F.col("rest")).alias("start")
    by_pattern = placed.filter("sequence_id is not null").select(
        "row", "doc_id", start, F.col("rest").alias("length"), F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        "sequence_id", F.coalesce(F.sum("rest").over(inside), F.lit(0)).alias("offset"))

    long = numbered(tokens.filter(F.col("n") >= capacity).select("row", "doc_id", "n", "crcs", F.floor(F.col("n") / capacity).alias("runs")),
                    [F.asc("row")], (), "_at", {"before": "runs"})
    runs = long.select("row", "doc_id", "n", "before", F.posexplode(F.slice("crcs", 1, F.col("runs").cast("int"))).alias("k", "crc"))
    by_run = runs.select(
        "row", "doc_id", (F.col("k").cast("bigint") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), (F.lit(n_patterns) + F.col("before") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    n_runs = tokens.agg(F.coalesce(F.sum(F.floor(F.col("n") / capacity)), F.lit(0))).first()[0]

    fillers = numbered(placed.filter("sequence_id is null").select("row", start, F.col("rest").alias("length")), [F.asc("row")], (), "_at", {"at": "length"})
    ends = placed.filter("sequence_id is not null").groupBy("sequence_id").agg(F.sum("rest").alias("offset")).filter(F.col("offset") < capacity)
    free = numbered(ends.select("sequence_id", "offset", (F.lit(capacity) - F.col("offset")).alias("length")), [F.asc("sequence_id")], (), "_at", {"at": "length"})
    n_fill, n_used, n_free = placed.agg(
        F.coalesce(F.sum(F.when(F.col("sequence_id").isNull(), F.col("rest"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("sequence_id").isNotNull(), F.col("rest"))), F.lit(0)), F.lit(0)).first()
    n_free = n_patterns * capacity - n_used
    over = max(0, n_fill - n_free)
    next_id = n_patterns + n_runs
    fresh = spark.range(over // capacity).select((F.col("id") + next_id).alias("sequence_id"), (F.col("id") * capacity + n_free).alias("at"),
                                                 F.lit(capacity).cast("bigint").alias("length"))
    tail, at, last = [], n_free + over // capacity * capacity, next_id + over // capacity
    for i, power in enumerate(_powers(over % capacity)):
        tail.append((last + i, at, power))
        at += power
    fresh = fresh.unionByName(spark.createDataFrame(tail, "sequence_id bigint, at bigint, length bigint"))
    laid = overlay(fillers.drop("_at"), free.select("sequence_id", "offset", "length", "at").unionByName(
        fresh.withColumn("offset", F.lit(0).cast("bigint"))), capacity)
    q = F.ceil(F.col("n") % capacity / width).cast("int")
    taken = placed.filter("sequence_id is not null").groupBy(q.alias("q")).agg(F.max("row").alias("last"))
    left = tokens.select("row", "doc_id", "n", "ids", q.alias("q")).join(F.broadcast(taken), "q", "left") \
        .filter("q > 0 and row > coalesce(last, -1)")      # a class's places go by rank, so its left-over rows are the last
    return reduce(DataFrame.unionByName, [by_pattern, by_run, _checksummed(laid, left)])


def _checksummed(laid: DataFrame, ids: DataFrame) -> DataFrame:
    """Left-over pieces with the checksums of their ids; only left-over documents' ids move."""
    columns = ["start", "length", "sequence_id", "offset"]
    pieces = laid.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("pieces"))       # pieces of one document
    crc = F.transform("pieces", lambda p: F.struct(*[p[c].alias(c) for c in columns], F.crc32(
        F.substring("ids", (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int"))).alias("crc")))
    return ids.join(pieces, "row").select("row", "doc_id", "n", F.explode(crc).alias("p")).select(
        "row", "doc_id", "p.start", "p.length", F.col("p.crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "p.sequence_id", "p.offset")


def sequences(tokens: DataFrame, pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed ids of every sequence, its pieces in order, not padded."""
    cuts = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))
    parts = tokens.select("row", "ids").join(cuts, "row").select(F.explode(F.transform("cuts", lambda p: F.struct(
        p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset"), F.substring(
            "ids", (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids")))).alias("p"))
    return parts.groupBy("p.sequence_id").agg(F.concat_ws("", F.transform(
        F.array_sort(F.collect_list(F.struct("p.offset", "p.ids"))), lambda x: F.hex(x["ids"]))).alias("ids")) \
        .select("sequence_id", F.unhex("ids").alias("ids"))                                    # at most CAPACITY pieces


def op11_packing(spark, sf_dir) -> DataFrame:
    import public_tokenizers
    return packed(tokenized(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))).drop("row")


QUERIES = {"op11_packing": op11_packing}
ORACLES: dict[str, str] = {}
