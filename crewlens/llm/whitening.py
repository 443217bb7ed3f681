"""Whitening of embeddings on principal components whose eigenvalues come from exact integers.

1. Every entry c becomes x = floor(256 * c); each distinct x vector stands once in the fit list.
2. Tasks sum the products of the fit list's entries, as whole numbers; only one value per pair of
   dimensions reaches the driver, whatever the number of rows. n * (sum of products) - S * S' is n^2
   times the covariance, a matrix of integers.
3. Tasks find its characteristic polynomial modulo primes, and the driver puts it together, isolates
   its largest roots and finds their vectors (`polynomial.py`); this depends on the dimension alone.
4. Rows are centred exactly, as n * x - S, and projected in double precision.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries, or entries
with no x in 64 bits, are dropped, and so are vectors of another length than the most frequent one
(of equally frequent lengths the greatest counts). Components are those with a positive eigenvalue:
a table of one distinct vector has none and gives no rows, as an empty table does. Repeated rows and
null ids each get their rows. A deviation of over 38 digits is null. Columns besides vec_id and
embedding are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm import polynomial
from crewlens.llm.tables import python_ready
from crewlens.session import stored

SCALE = 256
PRIMES_A_TASK = 16
LIMB = 60


@dataclass
class Whitening:
    """n distinct vectors with sums per dimension; unit vectors, largest eigenvalue first, of the
    matrix n^2 * covariance; its eigenvalues, and their shares of the trace."""

    n: int
    sums: list[int]
    components: list[list[float]] = field(default_factory=list)
    roots: list[Fraction] = field(default_factory=list)
    explained: list[float] = field(default_factory=list)


def integers(embeddings: DataFrame) -> DataFrame:
    """vec_id, x of the rows that take part."""
    scaled = F.transform("embedding", lambda c: c.cast("double") * SCALE)
    whole = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < 2.0**63, F.lit(False)))
    usable = (F.size("embedding") > 0) & whole
    x = F.when(usable, F.transform(scaled, lambda c: F.floor(c).cast("bigint")))
    rows = embeddings.select("vec_id", x.alias("x")).filter("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size("x") == (common["length"] if common else 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _products(x: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns, exact."""
    most = len(x) * int(np.abs(x).max()) ** 2
    if most < 2**53:
        return (x.astype(float).T @ x.astype(float)).astype(np.int64).astype(object)
    wide = x if most < 2**63 else x.astype(object)
    return (wide.T @ wide).astype(object)


def scatter(fit_list: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, sums per dimension and sums of products of the x column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                part = _products(np.column_stack([np.ones(len(x), np.int64), x]))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            sums = [int(v) for v in total[i, j]]
            wide = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays([
                pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                pa.array([Decimal(v >> LIMB) for v in sums], wide),
                pa.array([Decimal(v % (1 << LIMB)) for v in sums], wide)], names=["i", "j", "high", "low"])

    parts = fit_list.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    if not rows:
        return 0, [], []
    size = max(r.j for r in rows) + 1
    whole = [[0] * size for _ in range(size)]
    for r in rows:
        whole[r.i][r.j] = whole[r.j][r.i] = (int(r.high) << LIMB) + int(r.low)
    return whole[0][0], whole[0][1:], [row[1:] for row in whole[1:]]


def characteristic(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients, lowest power first; the matrix must have no negative eigenvalue."""
    trace = sum(row[k] for k, row in enumerate(matrix))
    moduli = polynomial.primes(polynomial.coefficient_bits(trace, len(matrix)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), PRIMES_A_TASK):
                ids = frame["id"].tolist()[at: at + PRIMES_A_TASK]
                yield pd.DataFrame({"id": ids, "r": list(polynomial.residues(matrix, [moduli[k] for k in ids]))})

    tasks = math.ceil(len(moduli) / PRIMES_A_TASK)
    rows = spark.range(0, len(moduli), 1, tasks).mapInPandas(run, "id bigint, r array<bigint>").collect()
    ordered = sorted(rows, key=lambda row: row.id)
    return polynomial.combined([list(row.r) for row in ordered], moduli)


def fit(fit_list: DataFrame, count: int) -> Whitening:
    """fit_list: distinct vectors x. The model of its `count` leading components."""
    n, sums, products = scatter(fit_list)
    size = len(sums)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    trace = sum(row[k] for k, row in enumerate(matrix))
    if not trace:
        return Whitening(n, sums)
    roots, power = polynomial.largest_roots(characteristic(fit_list.sparkSession, matrix), count, trace)
    whole = [Fraction(r, 1 << power) for r in roots]
    return Whitening(n, sums, polynomial.vectors(matrix, roots, power), whole, [float(r / trace) for r in whole])


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (decimal), whitened (one value per component) of rows of vec_id and x."""
    python_ready(rows.sparkSession)
    components = np.array(model.components).reshape(len(model.components), len(model.sums))
    scale = np.sqrt([float(r) for r in model.roots])
    largest = max(map(abs, model.sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            most = model.n * int(np.abs(x).max()) + largest
            kind = np.int64 if len(sums) * most * most < 2**63 else object
            centred = model.n * x.astype(kind) - sums.astype(kind)
            deviation = [int(d) for d in (centred * centred).sum(axis=1)]
            white = (centred.astype(float) @ components.T) / scale
            ends = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([Decimal(d) if d < 10**38 else None for d in deviation], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(ends, white.ravel())], names=["vec_id", "deviation", "whitened"])

    rows = rows.select("vec_id", "x")
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, deviation decimal(38,0), whitened array<double>"
    return (rows if model.components else rows.limit(0)).mapInArrow(run, schema)


def identity_error(white: DataFrame, count: int) -> float | None:
    """Largest absolute entry of the covariance of the column `whitened` less the identity."""
    w = [F.get("whitened", F.lit(k)) for k in range(count)]
    means = white.agg(*(F.avg(x).alias(f"m{k}") for k, x in enumerate(w))).first()
    centred = [x - F.lit(m) for x, m in zip(w, means, strict=True)]
    entries = [F.abs(F.avg(centred[i] * centred[j]) - float(i == j)) for i in range(count) for j in range(i, count)]
    return white.agg(F.greatest(F.lit(0.0), *entries)).first()[0]


def whitened(embeddings: DataFrame, count: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector
    that takes part and each of up to `count` components."""
    python_ready(embeddings.sparkSession)
    rows = integers(embeddings)
    fit_list = stored(rows.select("x").distinct(), "fit_list")
    model = fit(fit_list, count)
    found = len(model.components)
    error = None
    if found:
        white = stored(whiten(fit_list.select(F.lit(None).cast("bigint").alias("vec_id"), "x"), model), "white")
        error = identity_error(white, found)
    parts = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*map(F.lit, model.explained)).cast("array<double>")
    return parts.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
