"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are taken apart in pieces of about this many bytes, so that a task's memory is bounded.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package; needed where they don't have it on their path.

    Batches for Python are kept at a size that suits long texts, unless the session chose another.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    if getattr(context, "_wardlens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="wardlens-zip-")
    path = os.path.join(folder, "wardlens_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._wardlens_shipped = True


#: What operators remember in a Python worker between tasks.
REMEMBERED: list[dict] = []


def _libc():
    """The C library's memory settings, where it has them."""
    library = ctypes.CDLL(None)
    return library if hasattr(library, "mallopt") and hasattr(library, "malloc_trim") else None


def drop_remembered(own: dict | None = None) -> None:
    """Drop what other operators left in this Python worker and return free memory to the system.

    Workers live on between stages. This only does anything when the operator changes, as trimming
    after each batch would cost time. Arrays from a megabyte on are then mapped one by one, so that
    they leave no holes behind.
    """
    others = [memory for memory in REMEMBERED if memory is not own and memory]
    for memory in others:
        memory.clear()
    if (others or own is not None and not own) and (library := _libc()):
        pa.default_memory_pool().release_unused()
        library.malloc_trim(0)
        library.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


def slices(batch: pa.RecordBatch, column: str, own: dict | None = None,
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``size`` bytes of text each, one row at least.

    What other operators' tasks left in this worker is dropped; ``own`` stays.
    """
    drop_remembered(own)
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def gathered(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches put together until they hold ``size`` bytes of ``column``."""
    held, room = [], size
    for batch in batches:
        held.append(batch)
        room -= batch.column(column).nbytes
        if room <= 0:
            yield pa.concat_batches(held)
            held, room = [], size
    if held:
        yield pa.concat_batches(held)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: (code of each word, first word of each text + end, words).

    A null text has no words. Codes point into the distinct words.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    filled = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
    if not filled.all():  # leading or trailing white space gives empty words
        keep = filled[codes]
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        codes = codes[keep]
    return codes.astype(np.int64), ends, coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()),
                       np.uint64, len(words))


def window_sums(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sum of each run of ``width`` consecutive values, the first as it is, the others by factors."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out, factor = np.zeros(count, np.uint64), 1
    for k in range(width):
        out += hashes[k:k + count] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % 2**64
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values; position i covers i .. i + width - 1."""
    return mix64(window_sums(hashes, width))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of all nodes that occur in edges (a, b); component is the least node.

    Each round replaces every node by the least of its neighbours and itself and drops edges that
    became loops, so that the edges shrink round by round; then the rounds' maps are composed. All
    steps are joins and aggregations over written tables: a hub is a skewed join key, not a group
    in one task.
    """
    edges = materialize(edges.filter("a <> b").select("a", "b").distinct(), name)
    maps = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
            .select("node", F.least("node", "least").alias("parent")), name)
        maps.append(parent)
        edges = materialize(
            edges.join(parent.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
            .join(parent.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
            .filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(), name)
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps[-1].withColumnRenamed("parent", "component")
    for parent in reversed(maps[:-1]):
        later = found.select(F.col("node").alias("parent"), "component")
        found = parent.join(later, "parent", "left").select(
            "node", F.coalesce("component", "parent").alias("component"))
        found = materialize(found, name)
    return found
