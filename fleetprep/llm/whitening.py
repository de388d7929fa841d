"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are read as whole numbers, floor(SCALE * entry). The fit list holds each different vector once. On its centred rows X, alternating
products Xv and X'u, each over all rows, build an upper bidiagonal matrix B with XV = UB; both sides are reorthogonalised in full. The singular
values of the small B give the components' deviations, its right singular vectors combined with V the components.

The left vectors are as long as the list, so they are not kept: u = Xw for a w of the vectors' length, and the products with earlier left
vectors that reorthogonalisation needs follow from X'u. One pass over the rows so makes a whole step, and a task returns one row of sums. The
process ends when the wanted components have converged and what is left of the trace cannot hold a larger one, at the latest after as
many steps as vectors have entries. Where a step breaks off (rank, or equal deviations) it goes on from a new direction at right angles to
all before.

Rows whose vector is null or holds a null or an entry that is not finite are left out of the fit and of the result. Shorter vectors count as
filled up with zeros to the longest. Entries beyond the range of a long are its ends. Null or repeated vec_ids: every row is returned. With k
entries there are at most k components; one without any variance has a null `whitened`, and counts neither as explaining nor in the identity
error. Empty table: no rows. A deviation beyond the range of a long is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.llm.tables import only, plus, query, table

SCALE = 256.0  # fixed value
COMPONENTS = 4
BLOCK_BYTES = 2 << 20  # numbers of a block of the fit list, as doubles
FEW = 1024  # blocks whose sums go straight to the driver
TINY = 1e-13  # of the largest singular value: converged, or broken off


@dataclass
class Fit:
    n: int  # vectors of the fit list
    total: list[int]  # their sums by entry
    components: np.ndarray  # one a row
    values: np.ndarray  # eigenvalues, 0 where there is no variance
    trace: float
    steps: int = 0
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.total])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Projections of centred rows, each over its deviation."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return (x @ self.components.T) / np.sqrt(self.values)


def whole_numbers(df: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is whole and finite, with `x`, its numbers."""
    entry = lambda e: e.cast("double")
    good = F.forall(column, lambda e: e.isNotNull() & ~F.isnan(entry(e)) & (F.abs(entry(e)) < float("inf")))
    return df.where(F.col(column).isNotNull() & good).withColumn("x", F.transform(column, lambda e: F.floor(F.lit(SCALE) * entry(e))))


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def blocks(vectors: DataFrame, dim: int) -> DataFrame:
    """Each different vector once, many to a row, written to the shared folder."""
    size = max(1, BLOCK_BYTES // (8 * max(dim, 1)))

    def pack(batches):
        held, waiting = [], 0
        for batch in batches:
            held.append(rows_of(batch.column("x"), dim))
            waiting += batch.num_rows
            while waiting >= size:
                x = np.concatenate(held)
                yield block(x[:size])
                held, waiting = [x[size:]], waiting - size
        if waiting:
            yield block(np.concatenate(held))

    def block(x):
        narrow = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= x.min(initial=0) and x.max(initial=0) <= np.iinfo(t).max)
        return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([narrow]), pa.array([x.astype(narrow).tobytes()], pa.binary())], names=["n", "kind", "data"])

    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x")))
    return stage(vectors.select(padded.alias("x")).distinct().mapInArrow(pack, "n long, kind string, data binary"))


def summed(rows: DataFrame, dim: int, width: int, product: Callable[[np.ndarray], np.ndarray], n_blocks: int) -> np.ndarray:
    """The sum over all blocks of product(block), `width` numbers. A task adds up its own; of many tasks' sums, other tasks add up groups,
    so that the driver gets as many rows as the square root of the number of blocks at most, or FEW."""

    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data")):
                total += product(np.frombuffer(data.as_buffer(), kind).reshape(-1, dim).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def add(batches):
        total = np.zeros(width)
        for batch in batches:
            for data in batch.column("total"):
                total += np.frombuffer(data.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = rows.select("kind", "data").mapInArrow(run, "total binary")
    if n_blocks > FEW:
        parts = parts.repartition(int(n_blocks**0.5)).mapInArrow(add, "total binary")
    return sum((np.frombuffer(r["total"]) for r in parts.collect()), np.zeros(width))


def exact_sums(vectors: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """The number of vectors, their sums by entry, exactly, and the number of blocks."""

    def run(batches):
        n, total, count = 0, [0] * dim, 0
        for batch in batches:
            count += batch.num_rows
            for size, kind, data in zip(batch.column("n").to_pylist(), batch.column("kind").to_pylist(), batch.column("data")):
                x = np.frombuffer(data.as_buffer(), kind).reshape(size, dim)
                # two halves of each number, so that sums stay within a long
                high, low = (x.astype(np.int64) >> 32).sum(axis=0), (x.astype(np.int64) & 0xFFFFFFFF).sum(axis=0)
                n, total = n + size, [t + (a << 32) + b for t, a, b in zip(total, high.tolist(), low.tolist())]
        yield pa.RecordBatch.from_pydict({"n": [n] * dim, "k": list(range(dim)), "total": [str(t) for t in total], "blocks": [count] * dim})

    parts = vectors.mapInArrow(run, "n long, k long, total string, blocks long")
    rows = parts.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("blocks").alias("blocks")).orderBy("k").collect()
    return rows[0]["n"], [int(r["total"]) for r in rows], rows[0]["blocks"]


def right_angle(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v without its parts along the basis; twice, for what rounding leaves."""
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def new_direction(random: np.random.Generator, basis: list[np.ndarray], dim: int) -> np.ndarray:
    v = right_angle(random.standard_normal(dim), basis)
    return v / np.linalg.norm(v)


def bidiagonalise(product: Callable[[np.ndarray], np.ndarray], dim: int, trace: float, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Right singular vectors as rows and singular values; product(t) is X'Xt. Also the number of steps."""
    random = np.random.default_rng(1)
    vs, ws, backs = [new_direction(random, [], dim)], [], []  # right vectors; left ones as coefficients w; X'u of the left ones
    alphas, betas = [], []
    scale = 0.0
    while True:
        k = len(vs) - 1
        t = vs[k] - (betas[k - 1] * ws[k - 1] if k else 0)  # u = Xt
        back = product(t)  # X'u
        for _ in range(2):  # the left side at right angles to the earlier ones
            for w, b in zip(ws, backs):
                c = w @ back
                t, back = t - c * w, back - c * b
        alpha = float(np.sqrt(max(t @ back, 0.0)))
        scale = max(scale, alpha)
        if alpha <= TINY * scale:
            alpha, t, back = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            t, back = t / alpha, back / alpha
        ws.append(t)
        backs.append(back)
        alphas.append(alpha)
        rest = right_angle(back - alpha * vs[k], vs)
        beta = float(np.linalg.norm(rest)) if len(vs) < dim else 0.0
        beta = 0.0 if beta <= TINY * scale else beta
        small = np.diag(alphas) + np.diag(betas, 1) if betas else np.diag(alphas)
        left, values, right = np.linalg.svd(small)
        top = min(wanted, dim)
        close = len(values) >= top and (beta * np.abs(left[-1, :top]) <= TINY * values[0]).all()
        unseen = trace - float((values**2).sum())
        if len(vs) == dim or close and unseen < values[top - 1] ** 2 * (1 - 1e-9):
            return right[:top] @ np.array(vs), values[:top], len(vs)
        vs.append(rest / beta if beta else new_direction(random, vs, dim))
        betas.append(beta)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fit to a table with the column x, an array of whole numbers; None without vectors of at least one entry."""
    dim = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    if not dim:
        return None
    rows = blocks(vectors, dim)
    n, total, n_blocks = exact_sums(rows, dim)
    mean = np.array([s / n for s in total])
    trace = float(summed(rows, dim, dim, lambda x: ((x - mean) ** 2).sum(axis=0), n_blocks).sum())

    def product(t):
        def step(x):
            x = x - mean
            return x.T @ (x @ t)

        return summed(rows, dim, dim, step, n_blocks)

    vectors_, values, steps = bidiagonalise(product, dim, trace, components)
    at = np.argmax(np.abs(vectors_), axis=1)
    vectors_ = vectors_ * np.sign(vectors_[np.arange(len(vectors_)), at])[:, None]
    values = np.where(values <= 1e-10 * max(values[0], 1e-300), 0.0, values**2 / n)
    out = Fit(n, total, vectors_, values, trace / n, steps)
    out.identity_error = identity_error(rows, dim, out, n_blocks)
    return out


def identity_error(rows: DataFrame, dim: int, found: Fit, n_blocks: int) -> float:
    """The largest entry of the whitened list's covariance minus the identity."""
    mean, k = found.mean, int((found.values > 0).sum())
    if not k:
        return 0.0
    white = lambda x: found.whiten(x - mean)[:, :k]
    centre = summed(rows, dim, k, lambda x: white(x).sum(axis=0), n_blocks) / found.n

    def covariance(x):
        w = white(x) - centre
        return (w.T @ w).ravel()

    return float(np.abs(summed(rows, dim, k * k, covariance, n_blocks).reshape(k, k) / found.n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Of each row the sum of (n * x - total) ** 2, exactly; None beyond a long."""
    most = 1 << 63
    reach = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, total), default=0)
    if x.shape[1] * reach**2 < most:
        return ((n * x - np.array(total, np.int64)) ** 2).sum(axis=1).tolist()
    found = ((n * x.astype(object) - np.array(total, object)) ** 2).sum(axis=1).tolist()
    return [int(v) if v < most else None for v in found]


def whitened(df: DataFrame, found: Fit | None, keep: str = "vec_id") -> DataFrame:
    """A row for each vector and component of a table with `x`."""
    schema = plus(df.select(F.col(f"`{keep}`").alias("vec_id")).schema, "component int, n long, deviation long, whitened double, explained double, identity_error double")

    def run(batches):
        dim, k, mean = len(found.total), len(found.values), found.mean
        share = found.values / found.trace if found.trace else np.zeros(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = rows_of(batch.column("x"), dim)
            n, white = len(x), found.whiten(x - mean)
            white[:, found.values <= 0] = np.nan
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(n), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, found.n)),
                    pa.array([d for d in deviations(x, found.n, found.total) for _ in range(k)], pa.int64()), pa.array(white.ravel(), from_pandas=True),
                    pa.array(np.tile(share, n)), pa.array(np.full(n * k, found.identity_error)),
                ],
                names=schema.names,
            )

    if not found:
        return df.sparkSession.createDataFrame([], schema)
    return df.select(F.col(f"`{keep}`").alias("vec_id"), "x").mapInArrow(run, schema)


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_numbers(only(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return whitened(vectors, fit(vectors.select("x")))
