"""Substring dedup by compressed FM-indexes per shard (operator 7).

A window is WINDOW consecutive words of one document; every word covered by a window whose word
sequence also starts anywhere else is removed, judged on the input.

Shards are dealt by content, so no document is streamed past foreign shards: each window belongs
to the least hash of its GRAM-word grams (its minimizer), equal windows hence to equal minimizers.
Runs of windows with one minimizer form a segment.  Only minimizers that occur twice in the
corpus can hold repeated windows; they are counted first, and only their segments travel.  Equal
segments meet in a map-side aggregate (every window of a segment seen twice is repeated); the
distinct segments of a shard become one FM-index, and the segments are streamed against it by
backward search, giving for every position the length of the longest string ending there that
occurs twice.  Windows reaching WINDOW are reported.  Segments of a minimizer with more than HOT
occurrences are cut into their windows and dealt by window hash.

Defined results: a null text has no words; documents under WINDOW words lose nothing; texts with
equal words count as repeated wherever they hold a window; repeated rows are kept, each losing
all its words if it holds a window.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common
from feedlens.llm.bpe_merge import Costs
from feedlens.llm.fm_index import FMIndex
from feedlens.llm.near_dups import _finish, _PRIME, _starts, row_key, word_cache

WINDOW = 35
GRAM = 8
HOT = 20_000
SHARD_WORDS = 300_000


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return pick(values[:len(values) - (width - done)], values[width - done:]) if width > done else values


def _poly(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _PRIME + h[k:n + k]
    return _finish(out)


def _hashes(words: list[bytes], cache: Costs) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def window_minimizers(h: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(gram hashes, least gram hash of every window) of at least ``window`` word hashes."""
    grams = _poly(h, gram)
    return grams, _sliding(grams, window - gram + 1, np.minimum)


def minimizers(h: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Gram hash at every position that is the least of some window."""
    if len(h) < window:
        return np.zeros(0, np.int64)
    grams, least = window_minimizers(h, window, gram)
    width = window - gram + 1
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return grams[grams == _sliding(padded, width, np.maximum)].view(np.int64)


def _scan(batches, window):
    cache = word_cache()
    for batch in batches:
        words_key, counts, shas, least = [], [], [], []
        for text in common.texts_of(batch):
            words = text.encode().split()
            joined = b" ".join(words)
            words_key.append(xxhash.xxh3_64_intdigest(joined) - (1 << 63))
            counts.append(len(words))
            shas.append(hashlib.sha256(joined).hexdigest())
            least.append(minimizers(_hashes(words, cache), window) if len(words) >= window else np.zeros(0, np.int64))
        flat = np.concatenate(least) if least else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in least])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(words_key, pa.int64()), pa.array(counts, pa.int64()), pa.array(shas),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
            ["doc_id", "row", "wkey", "n_words", "sha", "mins"])


_SEGMENTS = "m bigint, sub int, sid binary, row bigint, start int, len int, seg binary"


def _cut(batches, window):
    cache = word_cache()
    for batch in batches:
        out = {k: [] for k in ("m", "sub", "sid", "row", "start", "len", "seg")}
        shared = batch.column("shared").to_pylist()
        for row, text, own in zip(batch.column("row").to_pylist(), common.texts_of(batch), shared):
            words = text.encode().split()
            h = _hashes(words, cache)
            least = window_minimizers(h, window)[1].view(np.int64)
            parts = {x["m"]: x["parts"] for x in own}
            bounds = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]]).tolist()
            singles = _poly(h, window) if max(parts.values()) > 1 else None
            for a, b in zip(bounds, bounds[1:]):
                m = int(least[a])
                if m not in parts:
                    continue
                pieces = [(a, b + window - 1, 0)] if parts[m] == 1 else [
                    (i, i + window, int(singles[i] % np.uint64(parts[m]))) for i in range(a, b)]
                for lo, hi, sub in pieces:
                    seg = b" ".join(words[lo:hi])
                    for k, v in zip(out, (m, sub, xxhash.xxh3_128_digest(seg), row, lo, hi - lo, seg)):
                        out[k].append(v)
        types = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def repeated_windows(segments: list[list[bytes]], window: int = WINDOW) -> list[np.ndarray]:
    """For each segment (list of words) the starts of windows that occur twice in the shard."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for s in segments for w in s), np.int64, sum(map(len, segments)))
    if not len(ids):
        return [np.zeros(0, np.int64) for _ in segments]
    often = np.bincount(ids) >= 2
    dense = np.where(often, np.cumsum(often), 0)[ids]                      # 0: a word seen once, matches nothing
    lengths = np.array([len(s) for s in segments])
    first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    text = np.zeros(int(lengths.sum()) + len(segments), np.int64)
    text[np.arange(len(ids)) + np.repeat(np.arange(len(segments)), lengths)] = dense
    barrier = np.cumsum(np.concatenate([[0], text == 0]))
    ends = np.flatnonzero(text[window - 1:] != 0) + window - 1
    ends = ends[barrier[ends + 1] == barrier[ends + 1 - window]]           # whole windows without a 0
    if not len(ends):
        return [np.zeros(0, np.int64) for _ in segments]
    index = FMIndex(text)
    hits = np.concatenate([e[index.matching(text, e, window) >= window] for e in np.array_split(ends, -(-len(ends) // 50_000))])
    starts = np.sort(hits) - (window - 1)
    cuts = np.searchsorted(starts, np.append(first, len(text)))
    return [starts[a:b] - f for a, b, f in zip(cuts, cuts[1:], first)]


def _spans(starts: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Merged word intervals covered by windows at sorted starts."""
    if not len(starts):
        return [], []
    new = np.flatnonzero(np.diff(starts) > window)
    return starts[np.concatenate([[0], new + 1])].tolist(), (starts[np.concatenate([new, [len(starts) - 1]])] + window).tolist()


def _shard_runs(batches):
    """Runs of whole (m, sub) groups with about SHARD_WORDS words."""
    held, words = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        words += int(np.sum(t.column("len").to_numpy()))
        if words < SHARD_WORDS:
            continue
        starts = _starts(held, ["m", "sub"])
        total = np.cumsum(held.column("len").to_numpy())
        lo = 0
        for s in starts[1:].tolist():
            if total[s - 1] - (total[lo - 1] if lo else 0) >= SHARD_WORDS:
                yield held.slice(lo, s - lo)
                lo = s
        held = held.slice(lo)
        words = int(total[-1] - (total[lo - 1] if lo else 0))
    if held is not None and held.num_rows:
        yield held


def _search(batches, window):
    for t in _shard_runs(batches):
        segments = [s.split(b" ") for s in t.column("seg").to_pylist()]
        seen, sids = t.column("seen").to_pylist(), t.column("sid").to_pylist()
        out_sid, out_a, out_b = [], [], []
        for sid, n, segment, starts in zip(sids, seen, segments, repeated_windows(segments, window)):
            a, b = ([0], [len(segment)]) if n > 1 else _spans(starts, window)
            if a:
                out_sid.append(sid)
                out_a.append(a)
                out_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(out_sid, pa.binary()), pa.array(out_a, pa.list_(pa.int32())), pa.array(out_b, pa.list_(pa.int32()))],
                                         ["sid", "a", "b"])


def _remove(batches):
    for batch in batches:
        removed, shas = [], []
        for text, spans in zip(common.texts_of(batch), batch.column("spans").to_pylist()):
            words = text.encode().split()
            keep = np.ones(len(words), bool)
            for x in spans:
                for a, b in zip(x["a"], x["b"]):
                    keep[x["start"] + a:x["start"] + b] = False
            kept = [w for w, k in zip(words, keep.tolist()) if k]
            removed.append(len(words) - len(kept))
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(removed, pa.int64()), pa.array(shas)], ["row", "n_removed", "kept_sha256"])


def removals(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, row, n_words, n_removed and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    scanned = common.written(docs.select("doc_id", row_key().alias("row"), "text").transform(
            common.map_arrow,
        partial(_scan, window=window), "doc_id bigint, row bigint, wkey bigint, n_words bigint, sha string, mins array<bigint>"), "sub-scan")
    copies = common.written(scanned.groupBy("wkey").agg(F.count("*").alias("copies"), F.min("row").alias("row")), "sub-copies")
    # one row of each distinct word sequence takes part; copies are decided by their number alone
    spread = scanned.filter(F.size("mins") > 0).select("row", "mins").join(copies.select("row"), "row").select("row", F.explode("mins").alias("m"))
    # written, so that the join with it is one of two plain shuffles, whose hot keys Spark splits
    counts = common.written(spread.groupBy("m").agg(F.count("*").alias("n")).filter("n > 1").select(
        "m", F.ceil(F.col("n") / hot).cast("int").alias("parts")), "sub-counts")
    suspects = spread.join(counts, "m").groupBy("row").agg(F.collect_set(F.struct("m", "parts")).alias("shared"))
    texts = common.written(docs.select(row_key().alias("row"), "text").join(suspects, "row"), "sub-texts")
    segments = common.written(texts.transform(common.map_arrow, partial(_cut, window=window), _SEGMENTS), "sub-segments")
    distinct = segments.groupBy("m", "sub", "sid", "seg", "len").agg(F.count("*").alias("seen"))
    found = distinct.repartition("m", "sub").sortWithinPartitions("m", "sub").select("m", "sub", "sid", "seg", "len", "seen").transform(
            common.map_arrow,
        partial(_search, window=window), "sid binary, a array<int>, b array<int>")
    spans = segments.select("sid", "row", "start").join(found, "sid").groupBy("row").agg(
        F.collect_list(F.struct("start", "a", "b")).alias("spans"))
    cut = texts.select("row", "text").join(spans, "row").transform(common.map_arrow, _remove, "row bigint, n_removed bigint, kept_sha256 string")
    alone = common.written(cut, "sub-cut")
    every = scanned.select("doc_id", "row", "wkey", "n_words", "sha").join(copies.select("wkey", "copies"), "wkey")
    whole = (F.col("copies") > 1) & (F.col("n_words") >= window)
    once = every.filter(~whole).join(alone, "row", "left")
    rest = once.select("doc_id", "row", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
                       F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
    return rest.unionByName(every.filter(whole).select("doc_id", "row", "n_words", F.col("n_words").alias("n_removed"),
                                                       F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256")))


def op7_substrings(spark, sf_dir) -> DataFrame:
    return removals(common.documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {"op7_substrings": op7_substrings}
ORACLES: dict[str, str] = {}
