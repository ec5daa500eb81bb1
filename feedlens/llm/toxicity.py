"""Toxicity by compression distance (operator 4).

Two zstandard dictionaries share a trained base of ordinary windows, and differ in their tail:
the toxic one ends in segments distilled from toxic training texts (letter sequences far more
frequent in toxic than in ordinary documents), the ordinary one in as many bytes that match
nothing, so both see ordinary prose at equal distances.  Every window of WINDOW words of a text
is compressed with both; the saving of the toxic dictionary is the window's distance.  Counts of
windows per distance threshold feed a logistic calibration, fitted on training documents that the
dictionaries have not seen.

Training reads a bounded sample of labelled documents (TRAIN_PER_CLASS and TRAIN_CHARS), only of
ids whose crc32 mod 4 is not 2.  Scoring covers every whole text.

Defined results: null and empty texts have no windows and get the score of the intercept; without
labelled documents of both kinds every score is 0; a null doc_id is not held out; repeated rows
are kept.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common

TRAIN_PER_CLASS = 1500
TRAIN_CHARS = 20_000
WINDOW = 6
BASE_BYTES = 8192
TAIL_BYTES = 8192
GRAMS = (4, 5, 6)
MIN_ODDS, MIN_LLR = 6.0, 40.0
DISTANCES = (1, 2, 3, 4, 5, 6, 8)
THRESHOLD = 0.3
_LETTERS = re.compile(r"[^\W\d_]+")
_CLEAN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def windows(text: str, n: int = WINDOW) -> list[bytes]:
    words = text.lower().encode().translate(_CLEAN).split()
    return [b" " + b" ".join(words[i:i + n]) + b" " for i in range(0, len(words), n)]


def _words(text: str) -> list[str]:
    return [f" {w} " for w in _LETTERS.findall(text.lower())]


def _grams(text: str) -> set[str]:
    return {w[i:i + k] for w in set(_words(text)) for k in GRAMS for i in range(len(w) - k + 1)}


def _llr(a: int, na: int, b: int, nb: int) -> float:
    """Log-likelihood ratio of the shares a / na and b / nb differing."""
    def ll(k, n, p):
        return k * math.log(p) + (n - k) * math.log(1 - p) if 0 < p < 1 else 0.0
    p = (a + b) / (na + nb)
    return 2 * (ll(a, na, a / na) + ll(b, nb, b / nb) - ll(a, na, p) - ll(b, nb, p))


def distil(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Segments of words covered by letter sequences typical of the toxic texts, rarest first."""
    a, b = Counter(), Counter()
    for counts, texts in ((a, toxic), (b, ordinary)):
        for t in texts:
            counts.update(_grams(t))
    na, nb = len(toxic), len(ordinary)
    least = min(MIN_LLR, 2 * na * math.log(1 + nb / max(na, 1)) / 8)          # reachable in small samples
    hot = {g for g, c in a.items() if c >= 3 and (c + .5) / (na + 1) >= MIN_ODDS * (b[g] + .5) / (nb + 1)
           and _llr(c, na, b[g], nb) >= least}
    found: Counter = Counter()
    for t in toxic:
        for w in _words(t):
            covered = [False] * len(w)
            for k in GRAMS:
                for i in range(len(w) - k + 1):
                    if w[i:i + k] in hot:
                        covered[i:i + k] = [True] * k
            for m in re.finditer("1+", "".join("01"[c] for c in covered)):
                if m.end() - m.start() >= 5:
                    found[w[m.start():m.end()]] += 1
    return [s for s, c in sorted(found.items(), key=lambda x: (x[1], x[0])) if c >= 3]


class Model:
    """Two dictionaries (bytes) and the calibration weights; about 40 KB."""

    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray):
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights

    def __getstate__(self):
        return self.toxic, self.ordinary, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def compressors(self):
        import zstandard
        settings = zstandard.ZstdCompressionParameters.from_level(
            3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
            min_match=4, strategy=zstandard.STRATEGY_FAST, target_length=1)
        return [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=settings).compress
                for d in (self.toxic, self.ordinary)]


def features(text: str, compressors) -> np.ndarray:
    """Log counts of windows by distance, mean and largest distance, log number of windows."""
    toxic, ordinary = compressors
    found = [len(ordinary(w)) - len(toxic(w)) for w in windows(text)]
    if not found:
        return np.zeros(len(DISTANCES) + 4)
    d = np.array(found)
    return np.array([1.0, *(math.log1p(int((d >= k).sum())) for k in DISTANCES), float(d.mean()),
                     min(float(d.max()), 12.0) / 4, math.log1p(len(d)) / 4])


def score(f: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f @ weights, -30, 30)))


def calibrate(f: np.ndarray, y: np.ndarray, l2: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept is not shrunk."""
    w = np.zeros(f.shape[1])
    shrink = np.full(f.shape[1], l2)
    shrink[0] = 1e-6
    for _ in range(30):
        p = score(f, w)
        h = (f * (p * (1 - p))[:, None]).T @ f + np.diag(shrink)
        step = np.linalg.solve(h + 1e-9 * np.eye(len(w)), f.T @ (y - p) - shrink * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(toxic: list[str], ordinary: list[str], toxic_share: float | None = None) -> Model | None:
    """Dictionaries from two thirds of the texts, calibration on the rest."""
    if len(toxic) < 3 or len(ordinary) < 3:
        return None
    import zstandard
    held = slice(0, None, 3)
    fit_t, fit_o = [t for i, t in enumerate(toxic) if i % 3], [t for i, t in enumerate(ordinary) if i % 3]
    prose = [w for t in fit_o for w in windows(t, 8)]
    random.Random(7).shuffle(prose)
    try:
        base = zstandard.train_dictionary(BASE_BYTES, prose[:30_000], level=3).as_bytes()
    except zstandard.ZstdError:                                    # too few samples to train on
        base = b"".join(prose)[-BASE_BYTES:].rjust(64)
    tail = b"".join(s.encode() for s in distil(fit_t, fit_o))[-TAIL_BYTES:].rjust(64)
    filler = bytes(random.Random(5).choice(b"\x00\x01\x02\x03\x04\x05\x06\x07\x0e\x0f\x10\x11") for _ in tail)
    model = Model(base + tail, base + filler, np.zeros(0))
    c = model.compressors()
    f = np.array([features(t, c) for t in [*toxic[held], *ordinary[held]]])
    y = np.array([1.0] * len(toxic[held]) + [0.0] * len(ordinary[held]))
    f[:, 0] = 1.0
    model.weights = calibrate(f, y)
    if toxic_share:                                                # the sample's share is not the corpus's
        model.weights[0] += math.log(toxic_share / (1 - toxic_share)) - math.log(y.mean() / (1 - y.mean()))
    return model


def learnable(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 != 2, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> Model | None:
    """Train on at most ``per_class`` toxic and twice as many ordinary documents by hash of the id."""
    known = (labels.filter("doc_id is not null and toxic is not null").filter(learnable())
             .groupBy("doc_id").agg(F.max("toxic").alias("_toxic")))
    counts = {r["_toxic"] > 0: r["n"] for r in known.groupBy((F.col("_toxic") > 0).cast("int").alias("_toxic")).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = (known.filter("_toxic > 0").orderBy(*order).limit(per_class)
              .unionByName(known.filter("_toxic <= 0").orderBy(*order).limit(2 * per_class)))
    rows = (docs.select("doc_id", "text").filter(F.char_length("text") <= TRAIN_CHARS).filter(learnable())
            .join(F.broadcast(picked), "doc_id").orderBy(*order, "text").limit(3 * per_class).select("text", "_toxic").collect())
    return train([r["text"] for r in rows if r["_toxic"] > 0], [r["text"] for r in rows if r["_toxic"] <= 0],
                 counts[True] / (counts[True] + counts[False]))


def _score(batches, shared, keep):
    model = shared.value
    c = model.compressors() if model else None
    for batch in batches:
        texts = common.texts_of(batch)
        if model is None:
            scores = np.zeros(len(texts))
        else:
            f = np.array([features(t, c) for t in texts]).reshape(len(texts), -1)
            if len(texts):
                f[:, 0] = 1.0
            scores = score(f, model.weights) if len(texts) else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(scores, pa.float64())], [*keep, "__score"])


def scored(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row and ``__score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", __score double"
    return docs.select(*dict.fromkeys([*keep, "text"])).transform(common.map_arrow, partial(_score, shared=shared, keep=keep), schema)


@common.isolated("doc_id", "text")
def drop_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with their columns."""
    return scored(docs, model, docs.columns).filter(F.col("__score") < threshold).drop("__score")


def op4_toxicity(spark, sf_dir) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = fit(docs, common.table(spark, sf_dir, "labels"))
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", (~learnable()).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}
