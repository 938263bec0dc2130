"""Whitening of embeddings on principal components found by QDWH spectral divide-and-conquer.

A vector's entries become integers; their covariance V is gathered in two passes: exact sums of each dimension, then
products of differences from the mean, each task's matrix added up by entry (i, j), so that what is shuffled is a matrix
a task and what reaches the driver is one matrix of dimension times dimension. `Spectral` takes V apart there: with s
inside the spectrum, the orthogonal polar factor U of V - s (QR-based dynamically weighted Halley iterations) is 1 on the
eigenvectors above s and -1 on those below, so (1 + U) / 2 is the projector on the upper invariant subspace. Bases of
both subspaces turn V into two smaller blocks, which are split again until a block is one number or a multiple of the
identity. No eigenvalue or singular value routine is called. Components are polished to double precision by one step of
first-order correction against V.

The mean and at most `most` components, a few numbers for each dimension, are broadcast as plain arrays; each row is
projected in its task. The covariance of the whitened rows is then measured by a pass of its own.

Defined results: rows whose vector is null, or holds null or a non-finite entry, are dropped, and so are empty vectors and
those of another length than most rows have (of equally frequent lengths the larger counts). Entries that
are beyond 2**48 once scaled are taken as that bound. A deviation beyond a long is null. Components without variance (at most
1e-13 of the largest eigenvalue times the dimension) are not given, as they can't be whitened; of equal eigenvalues any basis may
stand. Repeated rows and null ids are rows like others; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.hashing import slim_batches
from chronoloom.llm.tables import stored

#: A bound that the sum of a batch of 20,000 integers keeps within a long.
BOUND = float(1 << 48)
SCALE, SHIFT, MOST = 64, 1_000_000, 32
EPS = float(np.finfo(float).eps)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix. least bounds its singular values (of a / norm) from below;
    weights follow that bound, and reach 1 within a few rounds from any start."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    least, one = EPS, np.eye(n)
    for _ in range(12):
        square = least * least
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        basis, _ = np.linalg.qr(np.concatenate([np.sqrt(r) * x, one]))
        new = q / r * x + (p - q / r) / np.sqrt(r) * basis[:n] @ basis[n:].T
        new = (new + new.T) / 2
        change, x = np.abs(new - x).max(), new
        least = min(1.0, least * (p + q * square) / (1 + r * square))
        if least >= 1 - 4 * EPS and change < 1e-8:
            break
    return x


class Spectral:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix, by polar factors of shifted blocks."""

    def __init__(self, matrix: np.ndarray, seed: int = 1):
        self.matrix, self.random = (matrix + matrix.T) / 2, np.random.default_rng(seed)
        self.tiny = EPS * len(matrix) * float(np.linalg.norm(self.matrix))
        found = self.parts(self.matrix)
        order = np.argsort([-value for value, _ in found], kind="stable")
        self.vectors = self.polished(np.stack([found[i][1] for i in order], axis=1)) if len(order) else np.zeros((0, 0))
        self.values = np.einsum("ij,ij->j", self.vectors, self.matrix @ self.vectors)

    def parts(self, block: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """(value, vector in the block's own basis); blocks yet to be split are kept in a list, with their bases."""
        done, left = [], [(block, np.eye(len(block)))]
        while left:
            a, basis = left.pop()
            middle = np.trace(a) / max(len(a), 1)
            if len(a) < 2 or np.abs(a - middle * np.eye(len(a))).max() <= self.tiny:
                done += [(a[i, i], basis[:, i]) for i in range(len(a))]
                continue
            upper, lower = self.split(a)
            left += [(part.T @ a @ part, basis @ part) for part in (upper, lower)]
        return done

    def split(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bases of the invariant subspaces above and below a shift: the mean of the spectrum lies inside it, and a shift
        too near an eigenvalue shows in a projector that is none and is moved."""
        n, one = len(a), np.eye(len(a))
        width, middle = np.sqrt(np.abs(np.sum((a - np.trace(a) / n * one) ** 2) / n)), np.trace(a) / n
        for k in range(24):
            shift = middle + (0 if not k else width * 0.9 * self.random.uniform(-1, 1))
            above = (one + polar(a - shift * one)) / 2
            rank = round(float(np.trace(above)))
            if 0 < rank < n and np.abs(above @ above - above).max() < 1e-9:
                break
        else:
            raise ArithmeticError("no shift splits the block")
        basis, _ = np.linalg.qr(above @ self.random.standard_normal((n, rank)))
        basis, _ = np.linalg.qr(above @ basis)
        rest = np.concatenate([basis, (one - above) @ self.random.standard_normal((n, n - rank))], axis=1)
        whole, _ = np.linalg.qr(rest)
        return whole[:, :rank], whole[:, rank:]

    def polished(self, vectors: np.ndarray) -> np.ndarray:
        """One first-order step: what is left beside the diagonal of vectors' matrix, over the gaps, is turned away."""
        for _ in range(2):
            inner = vectors.T @ self.matrix @ vectors
            gap = np.diag(inner)[None, :] - np.diag(inner)[:, None]
            small = np.abs(gap) <= np.maximum(1e3 * self.tiny, 1e3 * np.abs(inner))
            turn = np.where(small, 0, inner / np.where(small, 1, gap))
            np.fill_diagonal(turn, 0)
            vectors, r = np.linalg.qr(vectors + vectors @ turn)
            vectors = vectors * np.sign(np.diag(r))
        return vectors


def lists(column: pa.Array) -> np.ndarray:
    """The rows of a list column as a matrix; all have one length and no null."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def integers(values: np.ndarray, scale: int, shift: int) -> np.ndarray:
    return np.floor(np.clip(scale * values, -BOUND, BOUND)).astype(np.int64) + shift


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, v: array of double) of the rows to fit, and their dimension."""
    v = F.col(vector_col).cast("array<double>")
    real = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(v) > 0)
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.coalesce(real, F.lit(False)))
    size = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return good.filter(F.size("v") == (size["d"] if size else -1)), (size["d"] if size else 0)


def summed(rows: DataFrame, values, dim: int) -> np.ndarray:
    """Rows' sums of values' products with each other, matrix by entry: one matrix a task, added up by (i, j). values
    takes a batch and gives a matrix of `dim` columns."""
    i, j = np.triu_indices(dim)

    def partial(parts):
        total = np.zeros((dim, dim))
        for batch in parts:
            x = values(batch)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "s"])

    out = np.zeros((dim, dim))
    for r in rows.mapInArrow(partial, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return out


def whitening(rows: DataFrame, most: int = MOST, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row and component (from 1, by falling eigenvalue): vec_id, component, n, deviation (sum over dimensions of
    (n * x - S)**2), whitened, explained (share of the trace), identity_error (largest absolute entry of the whitened
    rows' covariance less the identity)."""
    spark = rows.sparkSession
    slim_batches(spark)
    good, dim = whole_vectors(rows, id_col, vector_col)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dim:
        return spark.createDataFrame([], schema)

    def added(parts):
        for batch in parts:
            sums = integers(lists(batch.column(1)), scale, shift).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(sums), pa.array([len(batch)] * dim, pa.int64())], names=["i", "s", "n"])

    sums = good.mapInArrow(added, "i int, s long, n long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    n, total = sums[0]["n"], [int(r["s"]) for r in sorted(sums)]
    # The mean is taken apart into a whole number and a rest under 1, so that differences from it keep all digits.
    base, rest = np.array([s // n for s in total], np.int64), np.array([s % n / n for s in total])
    centred = lambda column: (integers(lists(column), scale, shift) - base) - rest

    covariance = summed(good, lambda batch: centred(batch.column(1)), dim) / n
    spectral = Spectral(covariance)
    keep = min(most, int(np.sum(spectral.values > 1e-13 * dim * max(spectral.values[0], 0))))
    if not keep:
        return spark.createDataFrame([], schema)
    turn = spectral.vectors[:, :keep] / np.sqrt(spectral.values[:keep])
    explained = spectral.values[:keep] / np.trace(covariance)
    plain = spark.sparkContext.broadcast((base, rest, turn))
    residue = np.array([s % n for s in total], np.int64)

    def rows_of(parts):
        base, rest, turn = plain.value
        for batch in parts:
            whole = integers(lists(batch.column(1)), scale, shift) - base
            # n * x - S is n * whole - residue; Python's integers where a long may not hold the sum of squares.
            if dim * (n * (float(np.abs(whole).max(initial=0)) + 1)) ** 2 < 2**62:
                away = ((n * whole - residue) ** 2).sum(axis=1).tolist()
            else:
                away = [sum((n * a - b) ** 2 for a, b in zip(row, residue.tolist(), strict=True)) for row in whole.tolist()]
                away = [a if a < 2**63 else None for a in away]
            z = (whole - rest) @ turn
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(away, pa.int64()), pa.array(list(z), pa.list_(pa.float64()))], names=["vec_id", "deviation", "z"])

    white = stored(good.mapInArrow(rows_of, "vec_id long, deviation long, z array<double>"))
    mean = np.zeros(keep)
    for r in white.select(F.posexplode("z").alias("i", "c")).groupBy("i").agg(F.avg("c").alias("m")).collect():
        mean[r["i"]] = r["m"]
    error = float(np.abs(summed(white, lambda batch: lists(batch.column(2)) - mean, keep) / n - np.eye(keep)).max())
    share = F.element_at(F.array(*[F.lit(float(e)) for e in explained]), F.col("place") + 1)
    out = white.select("vec_id", "deviation", F.posexplode("z").alias("place", "whitened"))
    return out.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
