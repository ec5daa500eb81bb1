"""Quality rules by line sequence labelling (operator 2).

A chain conditional random field marks every line with a word as content or boilerplate;
Viterbi decoding finds the best labelling, and the share of words on content lines decides
retention.  The field is trained here on a bounded sample of labelled documents (TRAIN_DOCS by hash of
the id, of at most TRAIN_CHARS characters each).  Only documents are labelled, so line labels are
latent: expectation-maximisation with the document's label as a constraint on its content share
(posterior regularisation) finds them.  The chain is then trained by maximum likelihood on runs of
lines of different documents joined at random, so that labels change inside the training chains as
they do in mixed documents.  Features and decoding cover whole texts of any length in one pass.

Defined results: a null text has no words; such texts fail the base rule and are not kept; lines
without a word take no part; without labelled documents of both kinds the verdict is the base
rule alone; repeated rows are kept.
"""

from __future__ import annotations

from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common

TRAIN_DOCS = 2000
TRAIN_CHARS = 20_000
CONTENT_SHARE = 0.5
#: Expected content share of a low-quality document at most, of a good one at least, in training.
LOW_SHARE, HIGH_SHARE = 0.15, 0.85
#: Lines of a training chain, and most lines of a run in it.
PIECE, RUN = 64, 8
SYMBOLS = b"#*$%&|<>"
_LOWER, _UPPER, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
#: Upper bounds of the buckets of each line feature.
BUCKETS = [
    (1, 3, 7, 15, 40, 120),            # words
    (0.001, 0.05, 0.2, 0.6),           # symbols per word
    (0.001, 0.1, 0.3, 0.6),            # words equal to the word before
    (0.2, 0.5, 0.8),                   # upper-case share of ASCII letters
    (0.02, 0.1, 0.3),                  # digits per byte
    (0.02, 0.2, 0.6),                  # exclamation marks per word
    (0.3, 0.5, 0.7, 0.9),              # distinct words per word
    (2, 4, 9, 20),                     # bytes per word
    (0.5,),                            # equal to an earlier line
    (0.5,),                            # ends a sentence
]
_OFFSETS = np.cumsum([0] + [len(b) + 1 for b in BUCKETS])
N_FEATURES = int(_OFFSETS[-1])
_EDGES = [np.array(b) for b in BUCKETS]


def lines_of(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(feature numbers [lines, features], words per line, repeated lines) of the lines with a word."""
    values, counts, earlier, dups = [], [], set(), 0
    for line in data.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        dup = line in earlier
        dups += dup
        earlier.add(line)
        size = len(line)
        upper = size - len(line.translate(None, _UPPER))
        letters = upper + size - len(line.translate(None, _LOWER))
        values.append((n, (size - len(line.translate(None, SYMBOLS))) / n, sum(map(eq, words, words[1:])) / n,
                       upper / letters if letters else 0.0, (size - len(line.translate(None, _DIGITS))) / size,
                       line.count(b"!") / n, len(set(words)) / n, size / n, dup, words[-1][-1:] in b".!?"))
        counts.append(n)
    if not counts:
        return np.zeros((0, len(BUCKETS)), np.int64), np.zeros(0, np.int64), 0
    v = np.array(values, float)
    numbers = np.stack([np.searchsorted(e, v[:, i], side="left") + _OFFSETS[i] for i, e in enumerate(_EDGES)], 1)
    return numbers, np.array(counts, np.int64), dups


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows found twice or more in the text."""
    n = len(words)
    if n < 3:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    pair = ids[:-1] * n + ids[1:]
    if n > 2_000_000:                                     # keep the product below 2^63
        pair = np.unique(pair, return_inverse=True)[1]
    _, inverse, counts = np.unique(pair[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[inverse] >= 2
    mask = np.zeros(n, bool)
    for k in range(3):
        mask[k:n - 2 + k] |= twice
    return int(mask.sum())


class Field:
    """Weights of the chain: emissions [feature, label], transitions [label, label], starts."""

    def __init__(self):
        self.emit, self.move, self.start = np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        return self.emit[numbers].sum(1)

    def viterbi(self, numbers: np.ndarray) -> np.ndarray:
        """Best label of each line; ties go to content (1)."""
        if not len(numbers):
            return np.zeros(0, np.int64)
        (m00, m01), (m10, m11) = self.move.tolist()
        scores = self.scores(numbers).tolist()
        a, b = scores[0][0] + self.start[0], scores[0][1] + self.start[1]
        back = []
        for e0, e1 in scores[1:]:
            to0, to1 = b + m10 >= a + m00, b + m11 >= a + m01
            a, b = (b + m10 if to0 else a + m00) + e0, (b + m11 if to1 else a + m01) + e1
            back.append((to0, to1))
        label = int(b >= a)
        out = [label]
        for choice in reversed(back):
            label = int(choice[label])
            out.append(label)
        return np.array(out[::-1])


def _adam(w: np.ndarray, gradient, rounds: int, l2: float) -> np.ndarray:
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        g = gradient(w) - l2 * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w = w + 0.1 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return w


def line_weights(numbers: np.ndarray, gold: np.ndarray, rounds: int = 60, l2: float = 1e-3) -> np.ndarray:
    """Log-odds of content of each feature, from single lines with labels between 0 and 1."""
    def gradient(w):
        miss = gold - 1 / (1 + np.exp(-w[numbers].sum(1)))
        return np.bincount(numbers.ravel(), np.repeat(miss, numbers.shape[1]), N_FEATURES) / len(gold)
    return _adam(np.zeros(N_FEATURES), gradient, rounds, l2)


def constrained(odds: np.ndarray, weights: np.ndarray, doc: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Posterior of content of every line under its document's constraint (posterior regularisation):
    the expected content share of words is at most LOW_SHARE in a low-quality document and at least
    HIGH_SHARE in a good one.  The closest such posterior shifts all log-odds of a document alike."""
    n = len(label)
    total = np.bincount(doc, weights, n)

    def share(shift):
        return np.bincount(doc, weights / (1 + np.exp(-np.clip(odds + shift[doc], -60, 60))), n) / np.maximum(total, 1e-9)
    now = share(np.zeros(n))
    aim = np.where(label > 0, HIGH_SHARE, LOW_SHARE)
    broken = np.where(label > 0, now < aim, now > aim)
    lo, hi = np.full(n, -60.0), np.full(n, 60.0)
    for _ in range(40):
        mid = (lo + hi) / 2
        above = share(mid) > aim
        lo, hi = np.where(above, lo, mid), np.where(above, mid, hi)
    return 1 / (1 + np.exp(-np.clip(odds + np.where(broken, (lo + hi) / 2, 0)[doc], -60, 60)))


def latent_labels(sequences: list[tuple[np.ndarray, np.ndarray, int]], turns: int = 4) -> list[np.ndarray]:
    """Labels of the lines of (features, words, document quality) by expectation-maximisation: lines
    start with their document's label; then line weights are fitted to the labels and the labels set
    to the constrained posteriors of those weights, in turn."""
    numbers, weights = np.concatenate([s for s, _, _ in sequences]), np.concatenate([c for _, c, _ in sequences]).astype(float)
    doc = np.repeat(np.arange(len(sequences)), [len(s) for s, _, _ in sequences])
    label = np.array([q for _, _, q in sequences])
    gold = label[doc].astype(float)
    for _ in range(turns):
        gold = constrained(line_weights(numbers, gold)[numbers].sum(1), weights, doc, label)
    return np.split((gold >= 0.5).astype(np.int64), np.cumsum([len(s) for s, _, _ in sequences])[:-1])


def spliced(sequences: list[tuple[np.ndarray, np.ndarray]], seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Chains of PIECE lines joined from runs of one to RUN lines of the (features, labels) given, in
    random order: labels change inside them, as they do where a page's text meets its surroundings."""
    draw = np.random.default_rng(seed)
    runs = []
    for numbers, labels in sequences:
        at = 0
        while at < len(numbers):
            n = int(draw.integers(1, RUN + 1))
            runs.append((numbers[at:at + n], labels[at:at + n]))
            at += n
    order = draw.permutation(len(runs))
    numbers, labels = np.concatenate([runs[i][0] for i in order]), np.concatenate([runs[i][1] for i in order])
    return [(numbers[i:i + PIECE], labels[i:i + PIECE]) for i in range(0, len(numbers), PIECE)]


def train(chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = 60, l2: float = 1e-3) -> Field:
    """Maximum likelihood of labelled chains by Adam steps on the exact gradient (forward-backward
    over all chains at once)."""
    n, width = len(chains), max(len(c) for c, _ in chains)
    numbers = np.zeros((n, width, len(BUCKETS)), np.int64)
    real, gold = np.zeros((n, width), bool), np.zeros((n, width), np.int64)
    for i, (c, labels) in enumerate(chains):
        numbers[i, :len(c)], real[i, :len(c)], gold[i, :len(c)] = c, True, labels
    truth = np.eye(2)[gold] * real[:, :, None]
    both = (real[:, 1:] & real[:, :-1])[:, :, None, None]
    true_pairs = (truth[:, :-1, :, None] * truth[:, 1:, None, :] * both).sum((0, 1))
    lines = real.sum()
    field = Field()

    def gradient(w):
        field.emit, field.move, field.start = w[:-6].reshape(-1, 2).copy(), w[-6:-2].reshape(2, 2).copy(), w[-2:].copy()
        emit = field.emit[numbers].sum(2)
        alpha, beta = np.zeros((n, width, 2)), np.zeros((n, width, 2))
        alpha[:, 0] = emit[:, 0] + field.start
        for t in range(1, width):
            nxt = np.logaddexp(alpha[:, t - 1, 0:1] + field.move[0], alpha[:, t - 1, 1:2] + field.move[1]) + emit[:, t]
            alpha[:, t] = np.where(real[:, t, None], nxt, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            after = emit[:, t + 1] + beta[:, t + 1]
            nxt = np.logaddexp(field.move[:, 0] + after[:, 0:1], field.move[:, 1] + after[:, 1:2])
            beta[:, t] = np.where(real[:, t + 1, None], nxt, 0.0)
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        diff = truth - np.exp(alpha + beta - z[:, None, None]) * real[:, :, None]
        g_emit = np.stack([np.bincount(numbers.reshape(-1), np.repeat(diff[:, :, k].reshape(-1), len(BUCKETS)), N_FEATURES)
                           for k in range(2)], 1)
        pair = np.exp(alpha[:, :-1, :, None] + field.move + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both
        return np.concatenate([g_emit.ravel(), (true_pairs - pair.sum((0, 1))).ravel(), diff[:, 0].sum(0)]) / lines

    w = _adam(np.zeros(field.emit.size + 6), gradient, rounds, l2)
    field.emit, field.move, field.start = w[:-6].reshape(-1, 2).copy(), w[-6:-2].reshape(2, 2).copy(), w[-2:].copy()
    return field


def learn(sequences: list[tuple[np.ndarray, np.ndarray, int]]) -> Field:
    """The field for (features, words, document quality) of the training documents."""
    if len({q for _, _, q in sequences}) < 2:
        return Field()
    labels = latent_labels(sequences)
    return train(spliced([(s, y) for (s, _, _), y in zip(sequences, labels)]))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Field:
    """Train on at most ``most`` labelled documents, chosen by a hash of the id."""
    picked = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = (docs.select("doc_id", "text").filter(F.char_length("text") <= TRAIN_CHARS)
            .join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(most).select("text", "_quality").collect())
    found = [(*lines_of(r["text"].encode())[:2], int(r["_quality"] > 0)) for r in rows]
    return learn([x for x in found if len(x[0])])


def judge(text: str, field: Field) -> tuple:
    data = text.encode()
    words = data.split()
    n = len(words)
    numbers, counts, dups = lines_of(data)
    labels = field.viterbi(numbers)
    share = float((counts * labels).sum() / n) if n else 0.0
    white = sum(text.count(c) for c in " \t\n\v\f\r")
    repeats = repeated_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    return (n, len(text) - white, len(data) - len(data.translate(None, SYMBOLS)), dups, repeats, failed,
            not failed and share >= CONTENT_SHARE, share)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                  ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                  ("kept", pa.bool_()), ("content_share", pa.float64())])


def _judge(batches, shared):
    for batch in batches:
        found = [judge(t, shared.value) for t in common.texts_of(batch)]
        yield common.rows(_OUT, {"doc_id": batch.column("doc_id"),
                                 **dict(zip(_OUT.names[1:], map(list, zip(*found)) if found else [[]] * 8))})


def quality(docs: DataFrame, field: Field) -> DataFrame:
    """Counts, base rule, content share and verdict of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)               # about 100 numbers
    return docs.select("doc_id", "text").transform(
            common.map_arrow,
        partial(_judge, shared=shared),
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, content_share double")


def op2_line_crf(spark, sf_dir) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return quality(docs, fit(docs, common.table(spark, sf_dir, "labels")))


QUERIES = {"op2_line_crf": op2_line_crf}
ORACLES: dict[str, str] = {}
