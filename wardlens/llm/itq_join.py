"""Near-duplicate vectors (operator 7): iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample so that the signs of the rotated vectors are balanced,
faithful codes (iterative quantisation); several rotations give enough bits for ``tables`` keys of
``key_bits`` bits. Vectors that agree in a whole key of any table are candidates; their cosine is then
computed from the original vectors, so no link below the threshold is found. A link is counted in
the first table that finds it.

Equal vectors of a label are one class. Keys are shuffled without vectors first, and only classes in keys
with company go on. A crowded key is verified in pairs of blocks; jobs return counts per class and
spanning edges, never pairs.

Special cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
with a null label, link with nothing; vectors of different length are never compared; each row is a vector of
its own, also if its ``vec_id`` is null or occurs again, with the same vector or another. Components are
named by the least ``vec_id`` that isn't null; a row without one is kept only where no other name exists.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import connected_components, ship_package
from wardlens.llm.jaccard_join import _runs, _spanning
from wardlens.session import materialize


@dataclass(frozen=True)
class ItqOptions:
    cosine: float = 0.93
    tables: int = 24
    key_bits: int = 16
    sample: int = 5000       # vectors that rotations are learned on, at most
    rounds: int = 30         # of iterative quantisation
    block: int = 512
    seed: int = 7


def learn_rotations(sample: np.ndarray, options: ItqOptions) -> np.ndarray:
    """(dimension, bits) projections: principal axes, rotated to fit their own signs."""
    dimension = sample.shape[1]
    rng, out = np.random.default_rng(options.seed), []
    axes = np.linalg.svd(sample, full_matrices=True)[2].T if len(sample) else np.eye(dimension)
    projected = sample @ axes
    for _ in range(-(-options.tables * options.key_bits // dimension)):
        rotation = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
        for _ in range(options.rounds if len(sample) else 0):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(projected.T @ signs)
            rotation = u @ v
        out.append(axes @ rotation)
    return np.hstack(out)[:, :options.tables * options.key_bits]


def keys_of(vectors: np.ndarray, projections: np.ndarray, options: ItqOptions) -> np.ndarray:
    """(vectors, tables) keys."""
    bits = vectors @ projections[:vectors.shape[1]] >= 0
    weights = 1 << np.arange(options.key_bits)
    return bits.reshape(len(vectors), options.tables, options.key_bits) @ weights


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first: squares of large or small components must stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def vector_classes(vectors: DataFrame) -> DataFrame:
    """least (vec_id), copies, label, embedding of all distinct vectors that can link."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    good = vectors.select("vec_id", "label", values.alias("embedding")).filter(
        "label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0"
        " AND forall(embedding, x -> x IS NOT NULL AND x = x AND abs(x) < double('Infinity'))"
        " AND exists(embedding, x -> x <> 0)")
    return good.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))


def linked_vectors(classes: DataFrame, options: ItqOptions) -> tuple[DataFrame, DataFrame]:
    """(class, n): linked vectors of other classes; and spanning edges (a, b)."""
    dimension = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    sample = classes.orderBy(F.xxhash64("label", "embedding"), "label", "embedding").limit(options.sample).select("embedding").toArrow()
    rows = [r for r in sample.column("embedding").to_pylist() if len(r) == dimension]
    projections = learn_rotations(_unit(np.array(rows)) if rows else np.empty((0, dimension)), options)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            keys = np.zeros((batch.num_rows, options.tables), np.int64)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                keys[own] = keys_of(_unit(_matrix(batch.column("embedding").take(pa.array(own)))), projections, options)
            flat = pa.array(keys.astype(np.int32).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * options.tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("copies"), batch.column("label"), batch.column("embedding"),
                 pa.ListArray.from_arrays(offsets, flat)], names=["class", "copies", "label", "embedding", "keys"])

    label = classes.schema["label"].dataType.simpleString()
    coded = materialize(classes.select("class", "copies", "label", "embedding").mapInArrow(
        code, f"class long, copies long, label {label}, embedding array<double>, keys array<int>"), "itq-codes")
    entries = coded.select("class", F.size("embedding").alias("size"), "label", F.posexplode("keys").alias("t", "key")).select(
        "class", "t", F.xxhash64("label", "size", "t", "key").alias("key"))
    entries = materialize(entries, "itq-entries")
    crowded = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    placed = (entries.join(crowded, "key").withColumn("blocks", F.expr(f"(n + {options.block - 1}) div {options.block}"))
              .withColumn("block", F.pmod(F.xxhash64("class"), "blocks")))
    # Block pair (i, j), i <= j: block k takes part in all pairs that hold it.
    dealt = placed.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "class", "t", F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("job"),
        (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"),
        F.when(F.col("blocks") == 1, F.pmod("key", F.lit(512))).otherwise(
            F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))).alias("bin"))
    jobs = dealt.join(coded, "class")

    def verify(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        job = rows.column("job").to_numpy()
        order = np.argsort(job, kind="stable")
        cls, copies, table = (rows.column(c).to_numpy()[order] for c in ("class", "copies", "t"))
        left, right = (rows.column(c).to_numpy(zero_copy_only=False)[order] for c in ("left", "right"))
        names, codes = rows.column("label").to_pylist(), rows.column("keys").combine_chunks()
        keys = codes.flatten().to_numpy().reshape(-1, options.tables)[order]
        lists = rows.column("embedding").combine_chunks()
        lists = lists.take(pa.array(order))
        starts, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        labels = [names[k] for k in order.tolist()]
        found: dict[str, list] = {"class": [], "n": [], "peer": []}
        for _, start, end in _runs(job[order]):
            own = np.arange(start, end)
            size = starts[start + 1] - starts[start]
            # Keys are hashed: members of another label or length would be strangers.
            same = np.array([labels[k] == labels[start] and starts[k + 1] - starts[k] == size for k in own])
            own = own[same]
            l, r = own[left[own]], own[right[own]]
            if not len(l) or not len(r):
                continue
            unit = _unit(flat[starts[own][:, None] + np.arange(size)])
            at = {k: i for i, k in enumerate(own.tolist())}
            ul, ur = unit[[at[k] for k in l.tolist()]], unit[[at[k] for k in r.tolist()]]
            linked = (ul @ ur.T >= options.cosine) & (cls[l][:, None] != cls[r][None, :])
            i, j = np.nonzero(linked)
            first = (keys[l[i]] == keys[r[j]]).argmax(axis=1) == table[start]
            i, j = i[first], j[first]
            linked = np.zeros_like(linked)
            linked[i, j] = True
            diagonal = len(l) == len(r) and (l == r).all()
            counts = np.concatenate([np.bincount(i, copies[r[j]], len(l)),
                                     np.zeros(len(r)) if diagonal else np.bincount(j, copies[l[i]], len(r))])
            everyone = np.concatenate([cls[l], cls[r]])
            label = _spanning(linked)
            live = np.flatnonzero((counts > 0) | (everyone != everyone[label]))
            found["class"].append(everyone[live])
            found["n"].append(counts[live].astype(np.int64))
            found["peer"].append(everyone[label][live])
        return pa.table({k: pa.array(np.concatenate(v) if v else np.empty(0, np.int64)) for k, v in found.items()})

    checked = materialize(jobs.groupBy("bin").applyInArrow(verify, "class long, n long, peer long"), "itq-links")
    counts = checked.groupBy("class").agg(F.sum("n").alias("n"))
    return counts, checked.select(F.col("class").alias("a"), F.col("peer").alias("b"))


def near_vectors(vectors: DataFrame, options: ItqOptions = ItqOptions()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    ship_package(vectors.sparkSession)
    # Classes are numbered in the written table; ids of rows aren't unique.
    classes = materialize(vector_classes(vectors).withColumn("class", F.monotonically_increasing_id()), "itq-classes")
    counts, edges = linked_vectors(classes, options)
    components = connected_components(edges, "itq-components").withColumnRenamed("node", "class")
    placed = classes.join(counts, "class", "left").join(components, "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    judged = placed.join(names, "component").select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id",
        F.lit(True).alias("judged"))
    values = F.transform("embedding", lambda x: x.cast("double"))
    joined = vectors.select("vec_id", "label", values.alias("embedding")).join(judged, ["label", "embedding"], "left")
    name = F.when(F.col("judged"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         name.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
