"""Operator 12: embedding whitening by mixed-precision eigenvectors.

Vectors become whole numbers ``x = floor(scale * c) + offset``, so sums over any number of rows are
exact whatever the order in which tasks deliver them. Two passes of Arrow functions gather one row of
partial sums per task and dimension (pair of dimensions), which Spark adds up as decimals: the number of rows,
the sums ``S`` and the range; then the products of the rows centred at ``q = floor(S/n)``. With ``r = S - n q`` the
covariance is ``M/n - (r/n)(r/n)'``, where ``r/n`` lies in [0, 1): nothing cancels. Products are
taken by matrix multiplication in blocks so short that every partial sum is a whole number below 2^53, hence exact;
wide ranges are split into high and low halves.

The covariance (dimension squared numbers, the only thing that the driver sees, as ``max_dim`` bounds it) is solved in
float32; its eigenvectors are then corrected by Ogita and Aishima's iteration in extended precision:
with ``R = I - X'X`` and ``S = X'AX``, every step takes ``X + X E`` where ``E_ij = (S_ij + l_j R_ij)/(l_j - l_i)``, and ``R_ij/2``
where two eigenvalues lie closer than the present error. It converges quadratically between
separate eigenvalues. Eigenvalues that stay within the error of each other are a cluster: its subspace is rotated by
the eigenvectors of the small matrix ``X_c' (A - m I) X_c`` with the cluster's mean ``m`` taken
out, where their differences are no longer small, and the iteration goes on.

A third pass projects and whitens, and its own covariance is measured in one more (``identity_error``).

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped; so are empty vectors
and those of another length than the commonest (of ties the longest); an entry's ``x`` beyond 2^47 either way counts as
that limit; repeated rows and ids and null ids count as rows; a component whose eigenvalue is zero to rounding has null
``whitened`` and doesn't count in ``identity_error``; no rows at all give an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import table

LIMIT = 1 << 47
#: Products of numbers up to 2^HALF fit a block sum below 2^53 for some rows.
HALF = 22


def whole(batch: pa.RecordBatch, dim: int, scale: float, offset: int) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    c = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.clip(np.floor(scale * c) + offset, -LIMIT, LIMIT).astype(np.int64)


def finite_vectors(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``v``: the rows whose vector holds finite numbers only, one at least."""
    v = F.col(column).cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False))), F.lit(False))
    return df.select(*keep, v.alias("v")).where(fine & (F.size("v") > 0))


def commonest_length(vectors: DataFrame) -> int:
    """The commonest length of the vectors, 0 without rows."""
    counts = vectors.groupBy(F.size("v").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.max(F.struct("n", "k"))["k"].alias("k")).first()["k"]
    return best or 0


def _products(y: np.ndarray, z: np.ndarray, bits: int) -> np.ndarray:
    """``y' z`` exactly, as Python integers; no entry exceeds 2^bits in magnitude, ``bits`` at most 25."""
    total = np.zeros((y.shape[1], z.shape[1]), object)
    block = max(1, 1 << (52 - 2 * bits))
    for i in range(0, len(y), block):
        total += (y[i:i + block].astype(np.float64).T @ z[i:i + block].astype(np.float64)).astype(np.int64)
    return total


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` of whole numbers up to 2^48 in magnitude, exactly."""
    most = int(np.abs(y).max(initial=0))
    if most < 1 << HALF:
        return _products(y, y, max(1, most.bit_length()))
    high, low = y >> 24, y & ((1 << 24) - 1)
    cross = _products(high, low, 25)
    return (_products(high, high, 25) * (1 << 48)) + (cross + cross.T) * (1 << 24) + _products(low, low, 24)


@dataclass(frozen=True)
class Moments:
    """Rows, and per dimension the sums, the centre and what the centre leaves: ``S = n * centre + rest``."""

    n: int
    sums: list[int]

    @property
    def centre(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)


def moments(vectors: DataFrame, dim: int, scale: float, offset: int) -> Moments:
    """One pass: number of rows and exact sums."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                for part in np.array_split(whole(batch, dim, scale, offset), batch.num_rows // 10_000 + 1):
                    total += part.sum(axis=0)  # at most 10,000 numbers below 2^47 each
        if n:
            yield pa.record_batch({"i": pa.array(range(dim), pa.int32()), "n": pa.array([n] * dim, pa.int64()),
                                   "s": pa.array([str(s) for s in total])})

    parts = vectors.select("v").mapInArrow(sums, "i int, n long, s string")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return Moments(rows[0]["n"], [int(r["s"]) for r in rows])


def covariance(vectors: DataFrame, of: Moments, scale: float, offset: int) -> np.ndarray:
    """The second pass: the covariance (divisor ``n``) in extended precision, from exact sums of centred products."""
    dim, centre = len(of.sums), of.centre

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = exact_products(whole(batch, dim, scale, offset) - centre)
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(dim)
            yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                                   "s": pa.array([str(s) for s in total[i, j]])})

    parts = vectors.select("v").mapInArrow(products, "i int, j int, s string")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # dim^2 / 2 rows
    rest = of.rest.astype(np.longdouble) / of.n
    out = np.empty((dim, dim), np.longdouble)
    for r in rows:
        value = np.longdouble(int(r["s"])) / of.n - rest[r["i"]] * rest[r["j"]]
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = value
    return out


def _clusters(values: np.ndarray, apart: float) -> list[slice]:
    """Runs of two or more sorted values whose neighbours differ by at most ``apart``."""
    cuts = np.flatnonzero(np.abs(np.diff(values)) > apart) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False) if b - a > 1]


def refine(a: np.ndarray, x: np.ndarray, steps: int = 12, blur: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of the symmetric ``a`` from approximate eigenvectors ``x``,
    in the precision of ``a``. Eigenvalues closer than ``blur`` of the norm are left to their cluster's own solve, since
    rounding over so small a gap would outweigh the correction; the last two steps only make them orthogonal."""
    eye = np.eye(len(a), dtype=a.dtype)
    norm = np.abs(a).sum(axis=1).max()
    settling = steps - 2
    for step in range(steps):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        off = s - np.diag(values)
        # Bounds by row sums stand for the spectral norms of Ogita and Aishima's test.
        apart = max(2 * (np.abs(off).sum(axis=1).max() + norm * np.abs(r).sum(axis=1).max()), blur * norm)
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= apart
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        if step > settling:
            break
        if step and np.abs(np.where(near, 0, e)).max() <= 1e-10 and apart <= blur * norm:
            settling = min(settling, step + 1)
        for part in _clusters(values, apart) if step < settling else []:
            # Inside a cluster: the differences from its mean, solved by themselves.
            inner = x[:, part]
            mean = values[part].mean()
            small = inner.T @ (a @ inner - mean * inner)
            size = np.abs(small).max()
            if size > 0:
                _, turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))
                x[:, part] = inner @ turn[:, ::-1].astype(a.dtype)
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of the symmetric ``v``: a float32 solve, refined. Signs are
    fixed by the entry of largest magnitude, which is positive."""
    biggest = float(np.abs(v).max())
    if biggest == 0:
        return np.zeros(len(v)), np.eye(len(v))
    scale = np.longdouble(2.0) ** -int(np.ceil(np.log2(biggest)))
    a = v * scale
    _, x = np.linalg.eigh(a.astype(np.float32))
    values, x = refine(a, x.astype(np.longdouble)[:, ::-1])
    x = x / np.sqrt(np.einsum("ij,ij->j", x, x))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(x))] < 0, -1, 1)
    return (values / scale).astype(np.float64), x.astype(np.float64)


def _deviation(centred: np.ndarray, n: int, rest: np.ndarray) -> list[str]:
    """Per row the sum of ``(n x - S)^2``, exactly."""
    most = float(n) * (float(np.abs(centred).max(initial=0)) + 1)
    if most * most * centred.shape[1] < 2.0 ** 62:
        d = n * centred - rest
        return [str(s) for s in (d * d).sum(axis=1).tolist()]
    return [str(sum((n * y - r) ** 2 for y, r in zip(row, rest.tolist(), strict=True))) for row in centred.tolist()]


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation; small enough (dimensions x components) to travel with every task."""

    dim: int
    n: int
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    scale: float
    offset: int

    def centred(self, batch: pa.RecordBatch) -> np.ndarray:
        return whole(batch, self.dim, self.scale, self.offset) - self.centre

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = ((centred - self.rest / self.n) @ self.vectors) / np.sqrt(self.values)
        out[:, self.values == 0] = np.nan
        return out


def fit(vectors: DataFrame, components: int = 8, scale: float = 1024.0, offset: int = 100_000, max_dim: int = 4096) -> Whitening | None:
    """Fit on all rows of ``vectors`` (:func:`finite_vectors` of one length); None without rows."""
    dim = commonest_length(vectors)
    if dim == 0:
        return None
    if dim > max_dim:
        raise ValueError(f"vectors of {dim} dimensions: the covariance is solved on the driver, for at most max_dim = {max_dim}")
    vectors = vectors.where(F.size("v") == dim)
    of = moments(vectors, dim, scale, offset)
    v = covariance(vectors, of, scale, offset)
    values, x = eigen(v)
    trace = float(np.trace(v))
    k = min(components, dim)
    values = np.where(values > dim * np.finfo(np.float64).eps * max(values[0], 0), values, 0)
    explained = values[:k] / trace if trace > 0 else np.full(k, np.nan)
    return Whitening(dim, of.n, of.centre, of.rest, values[:k], x[:, :k], explained, scale, offset)


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over the components with variance. Each
    task centres its products at its own mean; the tasks' means are joined to the products in the sums."""
    used = np.flatnonzero(model.values > 0)
    k = len(used)
    if k == 0:
        return None

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = model.project(model.centred(batch))[:, used]
                m, here = len(w), w.mean(axis=0)
                shift = here - mean
                products += (w - here).T @ (w - here) + np.outer(shift, shift) * (n * m / (n + m))
                mean, n = mean + shift * (m / (n + m)), n + m
        if n:
            i, j = np.indices((k, k)).reshape(2, -1)
            yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "n": pa.array([n] * k * k, pa.int64()),
                                   "a": pa.array(n * mean[i]), "b": pa.array(n * mean[j]),
                                   "s": pa.array((products + n * np.outer(mean, mean)).ravel())})

    sums = (vectors.select("v").mapInArrow(parts, "i int, j int, n long, a double, b double, s double")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "nabs"]))
    # The whitened rows' mean is zero to rounding, so taking it out cancels nothing.
    cov = (F.col("s") - F.col("a") * F.col("b") / F.col("n")) / F.col("n")
    return sums.agg(F.max(F.abs(cov - (F.col("i") == F.col("j")).cast("int")))).first()[0]


def whiten(rows: DataFrame, model: Whitening, error: float | None = None, id_column: str = "vec_id") -> DataFrame:
    """One row per vector and component of ``rows`` (``id_column``, ``v``): ``component`` (from 1), ``n``, ``deviation`` (decimal),
    ``whitened``, ``explained``, ``identity_error``."""
    k = len(model.values)
    kind = rows.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = model.centred(batch)
                yield pa.record_batch({id_column: batch.column(id_column), "d": pa.array(_deviation(y, model.n, model.rest)),
                                       "w": pa.array(list(model.project(y)), pa.list_(pa.float64()))})

    done = rows.where(F.size("v") == model.dim).select(id_column, "v").mapInArrow(run, f"`{id_column}` {kind}, d string, w array<double>")
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return (done.select(id_column, F.col("d").cast("decimal(38,0)").alias("deviation"), F.posexplode("w").alias("at", "whitened"))
            .select(id_column, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    F.nanvl("whitened", F.lit(None).cast("double")).alias("whitened"),
                    F.nanvl(F.get(explained, F.col("at")), F.lit(None).cast("double")).alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")).where(F.col("component") <= k))


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """Operator 12 over all embeddings: eight components. Every pass reads the table again: that is cheaper than a copy."""
    embeddings = table(spark, sf_dir, "embeddings")
    rows = finite_vectors(embeddings, "embedding", ["vec_id"])
    model = fit(rows)
    if model is None:
        return spark.createDataFrame([], f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, {SCHEMA}")
    fitted = rows.where(F.size("v") == model.dim)
    out = whiten(rows, model, identity_error(fitted, model))
    # Beyond the range of a long the contract's column can't hold the exact number.
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))
