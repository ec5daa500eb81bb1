"""Embedding whitening by QDWH spectral divide-and-conquer (operator 12).

Spark sums the moments: tasks turn their vectors into integers, and one row per task and dimension
reaches the shuffle.  The covariance (dimension x dimension, so bounded by the width of a vector) is
split on the driver: the polar factor of the shifted covariance, found by QR-based dynamically
weighted Halley steps, is the matrix sign, hence half of it plus the identity projects on the space
of the eigenvalues above the shift; both invariant subspaces are split again until the leading
components stand alone.  Mean and components are broadcast and tasks project their rows.

Vectors are centred on the integers next to their mean before they are multiplied, so products are
exact integers (and sums of them, up to 2^53) whatever the order of the tasks; the remaining shift,
at most a half in each dimension, is taken off the covariance by its square.

Defined results: a row is left out if its vector is null or holds a null or non-finite entry, an
entry of 2^42 or more, or fewer entries than the longest vector (the rest counts as null); repeated
rows count as often as they stand; a component without variance (an eigenvalue lost in the rounding
of the largest) has null ``whitened`` and explains 0, and the identity error is taken over the
others (0 where there are none); a ``deviation`` beyond 64 bits is null in the query and exact in
``whitened_rows`` (decimal); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = float(1 << 42)
EPS = float(np.finfo(float).eps)


# -- rows ---------------------------------------------------------------------------------

def integer_vectors(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x): the remaining rows, written; x are longs."""
    usable = F.forall(vec_col, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(LARGEST)), F.lit(False)))
    whole = embeddings.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"), usable.alias("usable"))
    width = whole.filter("usable").agg(F.max(F.size("v"))).first()[0] or 0
    x = F.transform("v", lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")) + F.lit(SHIFT))
    return common.written(whole.filter("usable").filter((F.size("v") == width) & F.lit(width > 0)).select("vec_id", x.alias("x")), "integer-vectors")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _sums(batches):
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            n, total = n + len(x), x.sum(axis=0) + (0 if total is None else total)
    if n:
        yield pa.RecordBatch.from_pydict({"n": [n], "s": [total]}, pa.schema([("n", pa.int64()), ("s", pa.list_(pa.int64()))]))


def moments(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    parts = vectors.select("x").mapInArrow(_sums, "n bigint, s array<bigint>")
    sums = (parts.select("n", F.posexplode("s").alias("i", "s")).groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect())     # one row a dimension
    return (sums[0].n, [r.s for r in sums]) if sums else (0, [])


def _products(batches, centre):
    total = None
    for batch in batches:
        if batch.num_rows:
            y = (_matrix(batch) - centre).astype(float)
            total = y.T @ y + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_pydict({"i": list(range(len(total))), "row": list(total)},
                                         pa.schema([("i", pa.int32()), ("row", pa.list_(pa.float64()))]))


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer centre, the mean's distance from it and the covariance."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = np.array([(s - n * c) / n for s, c in zip(sums, centre)])
    centre = np.array(centre, np.int64)
    parts = vectors.select("x").mapInArrow(partial(_products, centre=centre), "i int, row array<double>")
    cells = (parts.select("i", F.posexplode("row").alias("j", "p")).groupBy("i", "j").agg(F.sum("p").alias("p"))
             .toPandas())                                                # one row a cell of the covariance
    out = np.zeros((len(sums), len(sums)))
    out[cells.i, cells.j] = cells.p
    return centre, rest, out / n - np.outer(rest, rest)


# -- spectral divide and conquer -------------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH."""
    n = len(a)
    x, low, eye = a / np.linalg.norm(a), EPS / n, np.eye(n)
    for _ in range(20):                                    # six steps reach the limit from any start
        d = (4 * (1 - low * low) / low ** 4) ** (1 / 3)
        h = np.sqrt(1 + d)
        wa = h + np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * h)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            x = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            x = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x @ x), x)
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < EPS ** (1 / 3):
            break
    return x


def _halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces above and below a shift.

    The mean of the eigenvalues lies strictly between the outer ones; where it or the other
    shifts meet an eigenvalue, the next is tried.  The split that couples least is taken."""
    n, values = len(a), np.sort(np.diag(a))
    mean, spread = values.mean(), np.linalg.norm(a - values.mean() * np.eye(n)) / np.sqrt(n)
    start = np.random.default_rng(n).standard_normal((n, n))
    best = None
    for shift in [np.median(values), mean, *(mean + spread * f for f in (0.25, -0.25, 0.5, -0.5, 0.1, -0.1))]:
        shifted = a - shift * np.eye(n)
        projector = (polar(shifted) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        q, _ = np.linalg.qr(projector @ start[:, :k])
        q, _ = np.linalg.qr(projector @ q, mode="complete")
        coupling = np.linalg.norm(q[:, k:].T @ a @ q[:, :k])
        if best is None or coupling < best[0]:
            best = coupling, q[:, :k], q[:, k:]
        if coupling <= 20 * n * EPS * np.linalg.norm(a):
            break
    if best is None:
        raise ArithmeticError("no shift splits the spectrum")
    return best[1], best[2]


def leading(a: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors."""
    scale = np.linalg.norm(a)
    found: list[np.ndarray] = []

    def descend(block: np.ndarray, basis: np.ndarray) -> None:
        n = len(block)
        even = np.trace(block) / n
        if n == 1 or np.linalg.norm(block - even * np.eye(n)) <= n * EPS * scale:
            found.extend(basis.T)                          # one value: every basis is one of eigenvectors
            return
        for half in _halves(block):                        # above the shift first
            if len(found) < want:
                part = half.T @ block @ half
                descend((part + part.T) / 2, basis @ half)

    descend(a, np.eye(len(a)))
    vectors = np.array(found[:want]).T
    values = np.sum(vectors * (a @ vectors), axis=0)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return values[order], vectors * signs


# -- projection --------------------------------------------------------------------------------

def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """Exact sums of (n*x - S)^2 of rows y = x - centre, where n*x - S = n*y - rest."""
    if y.size and int(np.abs(y).max()) * n >= 1 << 52:
        y = y.astype(object)
    squares = (y * y).sum(axis=1) if y.dtype == object or int(np.abs(y).max(initial=0)) < 1 << 27 else (y.astype(object) ** 2).sum(axis=1)
    mixed = y.astype(object) @ np.array(rest, object) if n * y.shape[1] * max(1, int(np.abs(y).max(initial=0))) >= 1 << 62 else y @ np.array(rest, np.int64)
    constant = sum(r * r for r in rest)
    return [n * n * int(a) - 2 * n * int(b) + constant for a, b in zip(squares, mixed)]


def _project(batches, model):
    from decimal import Decimal
    centre, rest, rest_mean, n, axes = model.value
    for batch in batches:
        y = _matrix(batch) - centre
        off = y - rest_mean
        z = np.stack([(off * axis).sum(axis=1) for axis in axes.T], axis=1) if axes.size else np.zeros((len(y), 0))   # row by row
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([Decimal(d) for d in deviations(y, n, rest)], pa.decimal128(38, 0)),
             pa.array(list(z), pa.list_(pa.float64()))], ["vec_id", "deviation", "z"])


def whitened_rows(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS):
    """(rows, n, explained): ``rows`` holds vec_id, deviation (decimal) and z (one number per
    component, those without variance last and not in z), written; None for an empty fit list."""
    vectors = integer_vectors(embeddings, id_col, vec_col)
    n, sums = moments(vectors)
    if not n:
        return None
    centre, rest_mean, cov = covariance(vectors, n, sums)
    values, axes = leading(cov, min(components, len(sums)))
    trace = float(np.trace(cov))
    live = values > len(sums) * EPS * max(float(values[0]), 0.0)
    explained = np.where(live, values / trace if trace > 0 else 0.0, 0.0)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    model = embeddings.sparkSession.sparkContext.broadcast(
        (centre, rest, rest_mean, n, axes[:, live] / np.sqrt(values[live])))    # dimension x components numbers
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.mapInArrow(partial(_project, model=model), f"vec_id {kind}, deviation decimal(38,0), z array<double>")
    return common.written(rows, "whitened"), n, explained.tolist()


def identity_error(rows: DataFrame, n: int, width: int) -> float:
    """Largest entry of the covariance of ``z`` minus the identity, centred before multiplying."""
    if not width:
        return 0.0
    z = [F.get("z", F.lit(i)) for i in range(width)]
    means = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(z)]).first()
    off = [c - F.lit(m) for c, m in zip(z, means)]
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    sums = rows.agg(*[F.sum(off[i] * off[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs))


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: vec_id, component (from 1), n, deviation (decimal),
    whitened, explained and identity_error."""
    done = whitened_rows(embeddings, id_col, vec_col, components)
    if done is None:
        kind = embeddings.schema[id_col].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), "
                                                       "whitened double, explained double, identity_error double")
    rows, n, explained = done
    error = identity_error(rows, n, sum(e > 0 for e in explained))
    each = F.transform(F.array(*map(F.lit, explained)), lambda e, i: F.struct(
        (i + 1).alias("component"), F.get("z", i).alias("whitened"), e.alias("explained")))
    return rows.select("vec_id", "deviation", F.explode(each).alias("c")).select(
        "vec_id", F.col("c.component").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), F.lit(error).alias("identity_error"))


def op12_whitening(spark, sf_dir) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLES: dict[str, str] = {}
