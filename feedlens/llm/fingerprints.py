"""Document fingerprints: threshold-scaled sketches of word shingles (operator 3).

A sketch keeps every 64-bit shingle hash that falls below a fixed fraction of the hash range, and
nothing else, whatever the length of the text: its size follows the document, sketches of parts
merge by set union, and the share of common hashes estimates containment even between very unequal
documents.  Beside it, in a column of its own, stands the whole set of hashes of a text of few
shingles, whose sketch holds too little to estimate from; two such texts are compared by these.
Everything here is DataFrame expressions: no Python runs on the executors.

Defined results: a null text counts as empty; an empty text has the empty sketch; fewer words
than a shingle form one shingle of all words.  A likeness is always a number; where a text with
words has no hash below the fraction and cannot be compared whole it is 0 and marked as unknown
(``comparable`` is false).  Two texts without words are alike (1).  Texts of any length are hashed
whole; repeated rows are kept; columns other than doc_id and text are not read.  Rows with a null
doc_id sort after all others, equal ids sort by a hash of their text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm import common

SHINGLE = 5
#: A sketch of n shingles holds n * FRACTION hashes; a containment c is estimated from it with a
#: standard error of sqrt(c * (1 - c) * (1 - FRACTION) / (n * FRACTION)).
FRACTION = 1 / 4
#: Texts of at most so many different shingles keep the whole set beside the sketch.
WHOLE = 256
ROWS_PER_RANGE = 1024
MAX_RANGES = 65_536
_LONG_MAX = (1 << 63) - 1
_HASHES = "array<bigint>"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def _bound(fraction: float) -> Column:
    return F.lit(min(_LONG_MAX, -(1 << 63) + int(fraction * 2 ** 64)))


def marks(text: Column, fraction: float = FRACTION, shingle: int = SHINGLE, whole: int = WHOLE) -> Column:
    """``sketch``: the sorted distinct shingle hashes below ``fraction`` of the hash range; ``every``:
    all of them for a text of at most ``whole``, else null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of_words(h: Column) -> Column:
        n = F.size(h)
        many = F.transform(F.sequence(F.lit(0), n - shingle),
                           lambda i: F.xxhash64(*(h[i + k] for k in range(shingle))))
        return F.array_sort(F.array_distinct(F.when(n >= shingle, many).when(n > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast(_HASHES))))

    def kept(hashes: Column) -> Column:
        return F.struct(F.filter(hashes, lambda x: x < _bound(fraction)).alias("sketch"),
                        F.when(F.size(hashes) <= whole, hashes).alias("every"))

    return _let(_let(F.transform(words, lambda w: F.xxhash64(w)), of_words), kept)


def sketch(text: Column, fraction: float = FRACTION, shingle: int = SHINGLE) -> Column:
    return marks(text, fraction, shingle)["sketch"]


def merge(sketches: Column) -> Column:
    """Sketch of a text whose parts have the given sketches (shingles across joints aside)."""
    return F.array_sort(F.array_distinct(F.flatten(sketches)))


def _share(x: Column, y: Column) -> Column:
    return F.size(F.array_intersect(x, y)) / F.nullif(F.least(F.size(x), F.size(y)), F.lit(0))


def _pair(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """Whether both are whole, and whether one of them is known to have no words."""
    both = a["every"].isNotNull() & b["every"].isNotNull()
    return both, F.coalesce(F.size(a["every"]) == 0, F.lit(False)), F.coalesce(F.size(b["every"]) == 0, F.lit(False))


def comparable(a: Column, b: Column) -> Column:
    """Whether a likeness is more than a stand-in: both are whole, one is empty, or both have a sketch."""
    both, empty_a, empty_b = _pair(a, b)
    return both | empty_a | empty_b | (F.least(F.size(a["sketch"]), F.size(b["sketch"])) > 0)


def likeness(a: Column, b: Column) -> Column:
    """Containment of the smaller in the larger, 0 to 1: exact where both sets are whole, else
    estimated by the sketches; two empty texts: 1; 0 where it is unknown (see :func:`comparable`)."""
    both, empty_a, empty_b = _pair(a, b)
    return (F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).when(both, _share(a["every"], b["every"]))
            .otherwise(F.coalesce(_share(a["sketch"], b["sketch"]), F.lit(0.0))))


def as_string(hashes: Column) -> Column:
    return F.concat_ws(" ", F.transform(hashes, lambda x: F.lower(F.hex(x))))


def _range_of(key: Column, tie: Column, bounds: list[int]) -> Column:
    """Number of the key range of a row; monotone in (key, tie).

    An id that fills several ranges by itself is spread over them by its tie hash.  The bounds
    are searched in two levels, so a row costs about 2 * sqrt(number of bounds) comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    lasts = F.array(*(F.lit(g[-1]) for g in groups))
    table = F.array(*(F.array(*map(F.lit, g)) for g in groups))

    def count(below) -> Column:
        return _let(F.size(F.filter(lasts, below)), lambda c: c * step + F.when(
            c < len(groups), F.size(F.filter(F.get(table, c), below))).otherwise(0))

    lo = F.least(count(lambda b: b < key), F.lit(len(bounds)))
    hi = F.least(count(lambda b: b <= key), F.lit(len(bounds)))
    unit = tie.cast("double") / 2.0 ** 64 + 0.5
    return (lo + F.least(F.floor(unit * (hi - lo + 1)), hi - lo)).cast("int")


def with_next(docs: DataFrame, columns: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``next_<c>`` for every c of ``columns``, taken from the next row by ascending doc_id
    (from the first row after the last).

    Rows are dealt into key ranges of about equal counts.  The first row of a range also goes to
    the range before it, so each range finds its successors alone; the driver sees one key per
    range, at most MAX_RANGES."""
    key, tie = F.coalesce(F.col("doc_id"), F.lit(_LONG_MAX)), F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.withColumns({"_key": key, "_tie": tie})
    n = docs.count()
    ranges = min(MAX_RANGES, math.ceil(n / rows_per_range))
    bounds: list[int] = []
    if ranges > 1:
        at = [i / ranges for i in range(1, ranges)]
        bounds = sorted(docs.select(F.percentile_approx(key, at, max(10_000, 10 * ranges)).alias("b")).first()["b"])
    dealt = keyed.withColumn("_range", _range_of(F.col("_key"), F.col("_tie"), bounds))
    firsts = {r["_range"]: r["f"] for r in
              dealt.select("_range", F.struct("_key", "_tie").alias("f")).groupBy("_range").agg(F.min("f").alias("f")).collect()}
    order = sorted(firsts)
    ends = [(firsts[r]["_key"], firsts[r]["_tie"], order[i - 1]) for i, r in enumerate(order)]
    ghosts = docs.sparkSession.createDataFrame(ends, "_key bigint, _tie bigint, _range int").coalesce(1)
    both = dealt.withColumn("_ghost", F.lit(0)).unionByName(
        keyed.join(F.broadcast(ghosts), ["_key", "_tie"]).withColumn("_ghost", F.lit(1)))
    w = Window.partitionBy("_range").orderBy("_ghost", "_key", "_tie")
    return (both.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
            .filter("_ghost = 0").drop("_key", "_tie", "_range", "_ghost"))


def fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Per document its marks (``own``), those of its edited text (``changed``) and of the ``next``.

    The edited text has the last quarter of the code points replaced by the first as many of the
    next document."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = with_next(base, ["text"])          # hashing a text again is cheaper than moving its sketch
    n = F.char_length("text")
    return (near.withColumn("n_chars", n.cast("long"))
            .withColumn("_cut", F.floor(F.col("n_chars") / 4).cast("int"))
            .withColumn("edited", F.expr("concat(substring(text, 1, int(n_chars) - _cut), substring(next_text, 1, _cut))"))
            .select("doc_id", "n_chars", marks(F.col("text"), fraction).alias("own"),
                    marks(F.col("next_text"), fraction).alias("next"), "edited",
                    marks(F.col("edited"), fraction).alias("changed")))


def op3_fingerprints(spark, sf_dir) -> DataFrame:
    d = fingerprints(common.documents(spark, sf_dir))
    own, nxt, changed = F.col("own"), F.col("next"), F.col("changed")
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    as_string(own["sketch"]).alias("fingerprint"),
                    as_string(changed["sketch"]).alias("edited_fingerprint"),
                    likeness(own, changed).alias("near_edited"), likeness(own, nxt).alias("near_next"),
                    as_string(own["every"]).alias("whole_set"),
                    (comparable(own, changed) & comparable(own, nxt)).alias("comparable"))


QUERIES = {"op3_fingerprints": op3_fingerprints}
ORACLES: dict[str, str] = {}
