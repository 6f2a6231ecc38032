"""Whitening components of vectors by shifted CholeskyQR.

Vectors are rounded to whole numbers, and each different one counts once in the fit. A pass over them sums the Gram
matrix of the centred rows after the triangular solves found so far; its Cholesky factor is the next
solve. The first factor is shifted, so that it exists for any condition; the passes after it make the rows
orthonormal. The product of the factors is the R of the centred matrix, whose singular values and right vectors give the
components. Tasks send d rows of d sums each, which are added after a shuffle: only one d by d matrix reaches the driver.
"""

from __future__ import annotations

import decimal
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import shuffle_partitions, stored

SUMS = "dim int, i int, sums binary"


def usable(vec: Column) -> Column:
    """Whether a vector is neither null nor holds null or non-finite entries."""
    return F.coalesce(vec.isNotNull() & F.forall(vec, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))


def whole_numbers(vec: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * c) + offset per entry, as longs; scaled entries beyond 2^53 either way count as 2^53."""
    far = float(1 << 53)
    return F.transform(vec, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(far)), F.lit(-far))) + offset)


@dataclass
class Whitening:
    """Centre and components of the vectors of one length."""

    n: int
    sums: list[int]
    largest: int
    factors: list[np.ndarray] = field(default_factory=list)
    components: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit numbers where the largest fits, Python's beyond."""
        kind = np.int64 if self.largest < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        rows = self.centred(x)
        for r in self.factors:
            rows = solve_upper(rows, r)
        return rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components

    def squares(self, x: np.ndarray) -> list[int]:
        d = self.deviations(x)
        if self.largest**2 * max(len(self.sums), 1) >= 1 << 63:
            d = d.astype(object)
        return (d * d).sum(axis=1).tolist()


def solve_upper(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular matrix, column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _by_length(column: pd.Series):
    """(length, places, matrix) of a batch of arrays."""
    lengths = column.map(len).to_numpy()
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield int(d), at, np.stack([np.asarray(column.iloc[i], np.int64) for i in at])


def gram(fit: DataFrame, models: dict[int, Whitening], rows_of: str) -> dict[int, np.ndarray]:
    """Gram matrix, per length, of what the method ``rows_of`` makes of the vectors ``x``."""
    spark = fit.sparkSession
    shared = spark.sparkContext.broadcast(models)

    def partial(batches):
        own: dict[int, np.ndarray] = {}
        for pdf in batches:
            for d, _, x in _by_length(pdf["x"]):
                if d in shared.value:
                    q = getattr(shared.value[d], rows_of)(x)
                    own[d] = own.get(d, 0) + q.T @ q
        for d, g in own.items():
            yield pd.DataFrame({"dim": d, "i": range(len(g)), "sums": [row.tobytes() for row in g]})

    def add(batches):
        own: dict[tuple[int, int], np.ndarray] = {}
        for pdf in batches:
            for d, i, raw in zip(pdf["dim"], pdf["i"], pdf["sums"]):
                own[d, i] = own.get((d, i), 0) + np.frombuffer(raw, np.float64)
        yield pd.DataFrame([(d, i, v.tobytes()) for (d, i), v in own.items()], columns=["dim", "i", "sums"])

    sums = fit.mapInPandas(partial, SUMS).repartition(shuffle_partitions(spark), "dim", "i").mapInPandas(add, SUMS).collect()
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in sums:
        out.setdefault(r["dim"], {})[r["i"]] = np.frombuffer(r["sums"], np.float64)
    return {d: np.stack([rows[i] for i in range(len(rows))]) for d, rows in out.items()}


def cholesky(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of ``g`` plus a shift, which grows until the factor exists."""
    g = (g + g.T) / 2
    least = 100 * len(g) * np.finfo(float).eps * np.trace(g)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(least, shift * 100)


def fit_whitening(fit: DataFrame, most: int = 16, least: float = 1e-12, passes: int = 8) -> dict[int, Whitening]:
    """Models per vector length for the different vectors ``x`` (a stored table of arrays of longs).

    At most ``most`` components each, by falling eigenvalue; those with an eigenvalue of ``least`` times the largest or less, so
    also all of a length whose vectors are equal, have no whitened form and are left out. Signs: the entry of the largest size is positive.
    """
    lengths = fit.select(F.size("x").alias("dim"), F.posexplode("x").alias("i", "v"))
    sums = lengths.groupBy("dim", "i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    models: dict[int, Whitening] = {}
    for d in sorted({r["dim"] for r in sums}):
        own = sorted((r for r in sums if r["dim"] == d), key=lambda r: r["i"])
        n, s = own[0]["n"], [int(r["s"]) for r in own]
        largest = max(max(abs(n * v), abs(t), abs(n * v - t)) for r, t in zip(own, s) for v in (r["low"], r["high"]))
        models[d] = Whitening(n, s, largest)
    eps = np.finfo(float).eps
    traces: dict[int, float] = {}
    going = dict(models)
    for k in range(passes):
        grams = gram(fit, going, "orthogonal") if going else {}
        for d, g in grams.items():
            m = models[d]
            if k == 0:
                traces[d] = float(np.trace(g))
                if traces[d] == 0:
                    del going[d]
                    continue
                m.factors.append(cholesky(g, 11 * (m.n * d + d * (d + 1)) * eps / 2 * traces[d]))
                continue
            spread = np.linalg.eigvalsh((g + g.T) / 2)
            m.factors.append(cholesky(g, 0.0))
            if k >= 2 and (np.minimum(np.abs(spread - 1), np.abs(spread)) < 1e-6).all():
                del going[d]
    for d, m in models.items():
        if not m.factors:
            m.components, m.explained = np.zeros((d, 0)), np.zeros(0)
            continue
        r = m.factors[0]
        for f in m.factors[1:]:
            r = f @ r
        _, sizes, right = np.linalg.svd(r)
        kept = int((sizes[:most] ** 2 > least * sizes[0] ** 2).sum())
        values, vectors = sizes[:kept] ** 2 / m.n, right[:kept].T
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(kept)])
        m.components, m.explained = vectors / np.sqrt(values), values * m.n / traces[d]
    for d, g in gram(fit, {d: m for d, m in models.items() if m.components.shape[1]}, "whitened").items():
        models[d].identity_error = float(np.abs(g / models[d].n - np.eye(len(g))).max())
    return models


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, offset: int = 1_000_000, most: int = 16) -> DataFrame:
    """(``vec_id``, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Rows whose vector is null or holds null or non-finite entries are left out. Vectors of different lengths are
    fitted apart from each other. Null ids and repeated rows keep rows of their own, and equal vectors count once in the
    fit. Empty vectors, a length with one different vector, and an empty table have no components and no rows. ``deviation`` is a whole
    number of up to 38 digits. Other columns of the input, whatever their names, are neither read nor returned.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(usable(F.col("vec")) & (F.size("vec") > 0))
    rows = rows.select("id", whole_numbers(F.col("vec"), scale, offset).alias("x"))
    models = fit_whitening(stored(rows.select("x").distinct()), most)
    shared = df.sparkSession.sparkContext.broadcast(models)

    def project(batches):
        for pdf in batches:
            for d, at, x in _by_length(pdf["x"]):
                m = shared.value.get(d)
                if m is not None and m.components.shape[1]:
                    yield pd.DataFrame({
                        "id": pdf["id"].iloc[at].to_numpy(), "n": m.n, "deviation": [decimal.Decimal(v) for v in m.squares(x)], "w": list(m.whitened(x)),
                        "e": [m.explained] * len(at), "identity_error": m.identity_error})

    id_type = rows.schema["id"].dataType.simpleString()
    found = rows.mapInPandas(project, f"id {id_type}, n bigint, deviation decimal(38,0), w array<double>, e array<double>, identity_error double")
    entry = F.posexplode(F.arrays_zip("w", "e")).alias("at", "c")
    return found.select("id", "n", "deviation", "identity_error", entry).select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.w").alias("whitened"), F.col("c.e").alias("explained"), "identity_error")
