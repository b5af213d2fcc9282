"""Embedding whitening (operator 13) with a covariance over weighted distinct vectors.

Entries become integers (``floor(scale * c)``), so that equal vectors are equal bytes. Rows with the same
integer vector x are grouped; the group's number of rows, or one, is its weight in the fit. Sums are exact
integers. The covariance is a weighted product of centred vectors, added up task by task; its eigenvectors
are found on the driver, which holds one dimension x dimension matrix. Each distinct vector is whitened
once and joined back to its rows by a 128-bit digest. Vectors with more than one in ``heavy`` of all rows
are fewer than ``heavy`` and are broadcast; the others are no hot keys.

Special cases: rows whose vector is null or holds null or non-finite entries are dropped; entries beyond a
long become the nearest long; shorter vectors count as filled up with zeros; repeated and null ``vec_id``
are rows like others; other columns are ignored. A ``deviation`` beyond a long is null. A component
without variance has null ``whitened`` and 0 ``explained``. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import drop_remembered, ship_package
from wardlens.session import materialize

LONG_MAX = 2**63 - 1


@dataclass(frozen=True)
class WhiteningOptions:
    scale: int = 256
    components: int = 4
    weights: str = "one"     # of a distinct vector in the fit: "one", or "count" for its rows
    heavy: int = 1000        # a vector with more than 1 / heavy of all rows is joined by broadcast

    def __post_init__(self) -> None:
        if self.weights not in ("one", "count"):
            raise ValueError("weights are 'one' or 'count'")


@dataclass(frozen=True)
class Whitening:
    """Fitted transformation: (x - sums / n) @ axes / sqrt(values)."""

    n: int                  # total weight
    sums: tuple[int, ...]   # weighted, exact
    axes: np.ndarray        # (dimension, components), unit columns
    values: np.ndarray      # eigenvalues, falling
    trace: float

    @property
    def live(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        return self.values > len(self.sums) * np.finfo(float).eps * max(self.trace, 0.0)


# ---- vectors as integers ----------------------------------------------------------------------

def integer_vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(places of usable rows, packed integer vectors, their lengths); trailing zeros aren't packed."""
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.zeros(len(column), np.int64)
    sizes[valid] = column.value_lengths().drop_null().to_numpy()
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = np.flatnonzero(valid & (bad[ends] == bad[ends - sizes]))
    packed: list[bytes] = [b""] * len(good)
    for size in np.unique(sizes[good]).tolist():
        own = np.flatnonzero(sizes[good] == size)
        rows = flat[(ends - sizes)[good[own]][:, None] + np.arange(size)]
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.floor(scale * rows)
            x = np.where(scaled >= 2.0**63, LONG_MAX, np.maximum(scaled, -2.0**63).astype(np.int64))
        filled = np.where(x != 0, np.arange(1, size + 1), 0).max(axis=1, initial=0).tolist()
        narrow = (np.abs(x.astype(np.float64)).max(axis=1, initial=0) < 2**15).tolist()
        short, long = x.astype("<i2"), x.astype("<i8")
        for i, k in enumerate(own.tolist()):
            packed[k] = (b"\2" + short[i, :filled[i]].tobytes() if narrow[i] else b"\10" + long[i, :filled[i]].tobytes())
    return good, packed, sizes[good]


def unpacked(column: pa.Array, dimension: int) -> np.ndarray:
    """(rows, dimension) integers of packed vectors."""
    out = np.zeros((len(column), dimension), np.int64)
    for k, blob in enumerate(column.to_pylist()):
        x = np.frombuffer(blob, f"<i{blob[0]}", offset=1)
        out[k, :len(x)] = x
    return out


def _code(vectors: DataFrame, options: WhiteningOptions) -> DataFrame:
    """vec_id, key, x, size of all usable rows."""
    given = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_remembered()
        for batch in batches:
            good, packed, sizes = integer_vectors(batch.column("embedding"), options.scale)
            keys = [hashlib.blake2b(x, digest_size=16).digest() for x in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(good)), pa.array(keys, pa.binary()),
                 pa.array(packed, pa.binary()), pa.array(sizes.astype(np.int32))], names=["vec_id", "key", "x", "size"])

    kind = given.schema["vec_id"].dataType.simpleString()
    return given.mapInArrow(code, f"vec_id {kind}, key binary, x binary, size int")


# ---- fit --------------------------------------------------------------------------------------

def _scaled_offsets(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exact: 64-bit integers where they suffice, else Python's."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    if n * most + max(map(abs, sums), default=0) < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - sums / n as doubles, subtracted before rounding."""
    return (_scaled_offsets(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n * x - sums)^2, exact; None beyond a long."""
    offset = _scaled_offsets(x, n, sums)
    largest = int(np.abs(offset).max(initial=0)) if offset.size else 0
    if largest**2 * max(1, x.shape[1]) <= LONG_MAX:
        return (offset * offset).sum(axis=1).tolist()
    exact = (offset.astype(object) ** 2).sum(axis=1).tolist()
    return [d if d <= LONG_MAX else None for d in exact]


def fit_whitening(distinct: DataFrame, options: WhiteningOptions = WhiteningOptions()) -> Whitening:
    """Fit on distinct vectors (x, copies, size) of a written table; two passes over it.

    Partial sums and partial matrices are added in Spark, entry by entry.
    """
    weight = F.lit(1) if options.weights == "one" else F.col("copies")
    dimension, n = distinct.agg(F.max("size"), F.sum(weight.cast("decimal(38,0)"))).first()
    dimension, n, by_count = dimension or 0, int(n or 0), options.weights == "count"

    def weights_of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("copies").to_numpy() if by_count else np.ones(batch.num_rows, np.int64)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dimension, object)
        for batch in batches:
            x, w = unpacked(batch.column("x"), dimension), weights_of(batch)
            most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
            if most * int(w.sum()) < 2**62:
                total += (x * w[:, None]).sum(axis=0).astype(object)
            else:
                total += (x.astype(object) * w[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimension, dtype=np.int32)), pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))],
            names=["at", "v"])

    kept = distinct.select("x", "copies")
    sums = [0] * dimension
    for at, v in kept.mapInArrow(add_up, "at int, v decimal(38,0)").groupBy("at").agg(F.sum("v")).collect():
        sums[at] = int(v)
    sums = tuple(sums)
    upper = np.triu_indices(dimension)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            d = centred(unpacked(batch.column("x"), dimension), n, sums)
            total += (d * weights_of(batch)[:, None]).T @ d
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper])], names=["at", "v"])

    matrix = np.zeros((dimension, dimension))
    # As many rows as the matrix has entries, whatever the number of vectors.
    parts = kept.mapInArrow(multiply, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    at = parts.column("at").to_numpy()
    matrix[upper[0][at], upper[1][at]] = parts.column("v").to_numpy() / max(n, 1)
    matrix = np.triu(matrix) + np.triu(matrix, 1).T
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1][:options.components], axes[:, ::-1][:, :options.components]
    # Of both signs, the one that makes the entry of largest size positive.
    if axes.size:
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, axes, values, float(np.trace(matrix)))


def whiten_distinct(distinct: DataFrame, model: Whitening) -> DataFrame:
    """key, copies, deviation, whitened of distinct vectors (key, x, copies)."""
    dimension, live = len(model.sums), model.live
    factors = model.axes[:, live] / np.sqrt(model.values[live])

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("x"), dimension)
            out = np.full((batch.num_rows, len(live)), np.nan)
            out[:, live] = centred(x, model.n, model.sums) @ factors
            flat = pa.array(out.ravel(), mask=~np.isfinite(out).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(live))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copies"), pa.array(deviations(x, model.n, model.sums), pa.int64()),
                 pa.ListArray.from_arrays(offsets, flat)], names=["key", "copies", "deviation", "whitened"])

    return distinct.select("key", "x", "copies").mapInArrow(
        whiten, "key binary, copies long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening, options: WhiteningOptions) -> float | None:
    """Largest entry of |covariance - identity| of whitened distinct vectors (a written table)."""
    live = np.flatnonzero(model.live).tolist()
    if not live:
        return None
    weight = F.lit(1.0) if options.weights == "one" else F.col("copies").cast("double")
    part = {k: F.col("whitened")[k] for k in live}
    means = whitened.agg(*[F.sum(weight * part[k]).alias(f"m{k}") for k in live]).first()
    off = {k: part[k] - F.lit(means[f"m{k}"] / model.n) for k in live}
    pairs = [(i, j) for i in live for j in live if i <= j]
    found = whitened.agg(*[F.sum(weight * off[i] * off[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] / model.n - (i == j)) for i, j in pairs)


# ---- all rows ---------------------------------------------------------------------------------

def whiten_vectors(vectors: DataFrame, options: WhiteningOptions = WhiteningOptions()) -> DataFrame:
    """vec_id, n, deviation, whitened, explained, identity_error of every usable row; arrays by component."""
    ship_package(vectors.sparkSession)
    coded = materialize(_code(vectors, options), "whitening-codes")
    distinct = materialize(coded.groupBy("key", "x").agg(F.count("*").alias("copies"), F.max("size").alias("size")),
                           "whitening-distinct")
    model = fit_whitening(distinct, options)
    whitened = materialize(whiten_distinct(distinct, model), "whitening-whitened")
    error = identity_error(whitened, model, options)
    rows = whitened.agg(F.sum("copies")).first()[0] or 0
    is_heavy = F.col("copies") * F.lit(options.heavy).cast("decimal(19,0)") > F.lit(rows)
    # Fewer than ``heavy`` vectors can hold more than 1 / heavy of the rows each.
    heavy = whitened.filter(is_heavy).drop("copies")
    narrow = coded.select("vec_id", "key")
    joined = narrow.join(F.broadcast(heavy), "key").unionByName(
        narrow.join(F.broadcast(heavy.select("key")), "key", "left_anti")
        .join(whitened.filter(~is_heavy).drop("copies"), "key"))
    shares = np.where(model.live, model.values / model.trace if model.trace > 0 else 0.0, 0.0).tolist()
    return joined.select("vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                         F.array(*map(F.lit, shares)).cast("array<double>").alias("explained"),
                         F.lit(error).cast("double").alias("identity_error"))


def whitened_components(vectors: DataFrame, options: WhiteningOptions = WhiteningOptions()) -> DataFrame:
    """One row per usable row and component, numbered from 1."""
    rows = whiten_vectors(vectors, options)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    return rows.select("vec_id", each, "n", "deviation", "identity_error").select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("part.whitened").alias("whitened"), F.col("part.explained").alias("explained"), "identity_error")
