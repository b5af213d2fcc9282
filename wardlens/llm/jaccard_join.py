"""Near-duplicate join on word shingles (operator 2): token-combination prefixes.

Documents with equal shingle sets are one class; links are sought between classes.

1. With shingles in order of their hashes, two sets that link share s among the first n - o + s of each,
   where o is the least overlap. Only these heads, a quarter of all shingles, are compared over all
   classes; classes that share fewer than s with others link with nothing and are done.
2. All shingles of the others are counted. Those of one class alone can't be shared, so only the
   rest travel on; classes with too few of them to link are dropped.
3. With shingles in order of frequency, two sets with overlap o share at least s shingles among the
   first n - o + s of each. Rare shingles index alone. Frequent ones are dealt into c combination classes
   and index in pairs of one class: among s = c + 1 shared shingles, one is rare or two fall into the
   same class. c depends on a size band; a set indexes for its own band and that of the least
   size it can link with.
4. Classes that share an index entry, directly or in a chain, form a cluster; every possible link lies in
   one. Clusters are verified exactly, in blocks: first all blocks against a pivot block, then only
   what isn't yet connected to the cluster's largest component against all blocks. Jobs return
   spanning edges, never pairs, so a group of n copies costs about n rows.

Special cases: null, empty and blank texts have an empty set and link with nothing; texts with fewer
than five words have one shingle; repeated rows and rows that share a ``doc_id`` are results of
their own, whose ``component_id`` is the least ``doc_id`` of all documents reached; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import (connected_components, gathered, mix64, ship_package, slices, split_words,
                                 window_hashes, word_hashes)
from wardlens.session import materialize

#: Bits of a shingle's hash; LOW_BITS of them are packed, the bucket tells the others.
HASH_BITS, LOW_BITS = 54, 48
#: A bucket holds so many times the root of the number of shingles. Rows go from each bucket to each, so that
#: their number grows with the input, not with its square.
BUCKET_ROOT = 32
#: Classes of a bin of small clusters: tasks' groups don't grow with the input.
BIN_CLASSES = 64
#: Packed shingles dealt to buckets at once, about.
DEALT_BYTES = 4 << 20


@dataclass(frozen=True)
class JaccardOptions:
    words: int = 5
    percent: int = 80        # least similarity
    rare: int = 16           # classes that hold a rare shingle, at most
    head: int = 20           # a set's size over what heads share
    combine: int = 6         # frequent shingles in a combination class, about
    block: int = 256         # classes verified at once against as many


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) pairs in order, each once; shingles are hashes of HASH_BITS bits."""
    codes, ends, names = split_words(pc.ascii_lower(texts))
    hashes = word_hashes(names)[codes] if len(names) else np.empty(0, np.uint64)
    place = np.arange(max(0, len(hashes) - words + 1))
    text = np.searchsorted(ends, place, "right") - 1
    good = place + words <= ends[text + 1]
    owners, found = [text[good]], [window_hashes(hashes, words)[good]]
    for k in np.flatnonzero((np.diff(ends) < words) & (np.diff(ends) > 0)).tolist():
        short = hashes[ends[k]:ends[k + 1]]
        owners.append(np.array([k]))
        found.append(mix64(window_hashes(short, len(short)) + np.uint64(len(short))))
    owner, shingle = np.concatenate(owners), np.concatenate(found) >> np.uint64(64 - HASH_BITS)
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    return owner[new], shingle[new]


def _set_names(owner: np.ndarray, shingle: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, fingerprint) of each text's set; equal sets have equal fingerprints."""
    sizes = np.bincount(owner, minlength=count)
    ends = np.concatenate([[0], np.cumsum(sizes)])

    def sums(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[ends[1:]] - total[ends[:-1]]

    first, second = sums(mix64(shingle)), sums(mix64(shingle ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return sizes, mix64(first ^ mix64(second + sizes.astype(np.uint64))).view(np.int64)


def _short_bytes(values: np.ndarray, bits: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)].tobytes()


def _from_short(raw: bytes | pa.Buffer, bits: int) -> np.ndarray:
    width = -(-bits // 8)
    found = np.frombuffer(raw, np.uint8).reshape(-1, width)
    out = np.zeros((len(found), 8), np.uint8)
    out[:, :width] = found
    return out.reshape(-1).view("<u8")


def bucket_count(shingles: int) -> int:
    return max(1 << HASH_BITS - LOW_BITS, int(shingles ** 0.5 / BUCKET_ROOT))


def _bucket_starts(buckets: int) -> np.ndarray:
    """Least hash of each bucket; its hashes less this one have LOW_BITS bits."""
    return np.array([(b << HASH_BITS) // buckets for b in range(buckets)], np.uint64)


def least_overlap(n: np.ndarray | int, options: JaccardOptions):
    """Shingles that a set of ``n`` shares with any set that it links with, at least."""
    return -(-options.percent * n // 100)


def head_size(n: int, options: JaccardOptions) -> int:
    return n - least_overlap(n, options) + max(1, n // options.head)


def least_shared(n, options: JaccardOptions):
    """Shingles that the heads of a set of ``n`` and of any set that it links with share, at least.

    The other set holds ``least_overlap(n)`` shingles or more, and heads share what the smaller one's size asks for.
    """
    return np.maximum(1, least_overlap(n, options) // options.head)


def document_sets(docs: DataFrame, options: JaccardOptions) -> DataFrame:
    """doc_id, n_shingles, class (fingerprint of the set) and head of every row.

    The head holds the first shingles of the set, packed; it is null in copies nearby and for empty sets.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, shingle = shingle_sets(part.column("text"), options.words)
                sizes, names = _set_names(owner, shingle, part.num_rows)
                ends = np.cumsum(sizes)
                heads = [None] * part.num_rows
                for k in _first_copies(sizes, names):
                    start = ends[k] - sizes[k]
                    heads[k] = _short_bytes(shingle[start:start + head_size(int(sizes[k]), options)], HASH_BITS)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(names), pa.array(heads, pa.binary())],
                    names=["doc_id", "n_shingles", "class", "head"])

    return docs.select("doc_id", "text").mapInArrow(name, "doc_id long, n_shingles long, class long, head binary")


def _first_copies(sizes: np.ndarray, names: np.ndarray) -> list[int]:
    """Places of the sets that aren't empty, each once."""
    _, first = np.unique(names, return_index=True)
    return first[sizes[first] > 0].tolist()


def class_texts(docs: DataFrame, options: JaccardOptions) -> DataFrame:
    """class and text of the documents; copies nearby go no further."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, names = _set_names(*shingle_sets(part.column("text"), options.words), part.num_rows)
                kept = _first_copies(sizes, names)
                yield pa.RecordBatch.from_arrays([pa.array(names[kept]), part.column("text").take(pa.array(kept, pa.int64()))],
                                                 names=["class", "text"])

    return docs.select("text").mapInArrow(name, "class long, text string")


def class_sets(docs: DataFrame, options: JaccardOptions) -> DataFrame:
    """class, packed shingles and their number n of the documents' sets; copies nearby go no further."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, shingle = shingle_sets(part.column("text"), options.words)
                sizes, names = _set_names(owner, shingle, part.num_rows)
                ends, kept = np.cumsum(sizes), _first_copies(sizes, names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[kept]), pa.array([_short_bytes(shingle[ends[k] - sizes[k]:ends[k]], HASH_BITS) for k in kept], pa.binary()),
                     pa.array(sizes[kept].astype(np.int64))], names=["class", "shingles", "n"])

    return docs.select("text").mapInArrow(sets, "class long, shingles binary, n long")


def by_bucket(sets: DataFrame, buckets: int) -> DataFrame:
    """Sets of n shingles (class, shingles, n), or parts of them, taken apart by ranges of the hashes, in packed arrays."""
    starts = _bucket_starts(buckets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "shingles", DEALT_BYTES):
            packed = batch.column("shingles")
            names, sizes = (batch.column(c).to_numpy() for c in ("class", "n"))
            number = np.repeat(np.arange(len(names)), pc.binary_length(packed).to_numpy() // -(-HASH_BITS // 8))
            shingle = _from_short(b"".join(packed.to_pylist()), HASH_BITS)
            bucket = np.searchsorted(starts, shingle, "right") - 1
            order = np.argsort(bucket, kind="stable")
            bucket, number, shingle = bucket[order], number[order], shingle[order]
            shingle = shingle - starts[bucket]
            rows = [], [], [], [], []
            for b, start, end in _runs(bucket):
                n = np.bincount(number[start:end], minlength=len(names))
                used = n > 0
                for column, value in zip(rows, (b, names[used].tobytes(), sizes[used].astype("<u4").tobytes(),
                                                n[used].astype("<u4").tobytes(), _short_bytes(shingle[start:end], LOW_BITS))):
                    column.append(value)
            yield _packed(*rows)

    return sets.mapInArrow(deal, PACKED)


def _entries(rows: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, size, shingle) of a bucket's shingles that several classes hold, by shingle and class, each once."""
    cls, size, shingle = _unpack(rows, int(starts[rows.column("bucket")[0].as_py()]))
    order = np.argsort(shingle, kind="stable")
    shingle = shingle[order]
    several = np.zeros(len(shingle), bool)
    several[1:] = shingle[1:] == shingle[:-1]
    several[:-1] |= several[1:]
    shingle, cls, size = shingle[several], cls[order][several], size[order][several]
    order = np.lexsort((cls, shingle))
    shingle, cls, size = shingle[order], cls[order], size[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (cls[1:] != cls[:-1])
    return cls[new], size[new], shingle[new]


def _holders(shingle: np.ndarray) -> np.ndarray:
    """Number of classes that hold the shingle of each entry."""
    _, place, holders = np.unique(shingle, return_inverse=True, return_counts=True)
    return holders[place]


def candidate_classes(sets: DataFrame, options: JaccardOptions) -> DataFrame:
    """Classes whose heads share as many shingles with others' heads as a link takes; no other class has one."""
    heads = sets.filter("head IS NOT NULL")
    size = heads.agg(F.coalesce(F.sum(F.expr(f"octet_length(head) div {-(-HASH_BITS // 8)}")), F.lit(0))).first()[0]
    starts = _bucket_starts(bucket_count(size))

    def share(rows: pa.Table) -> pa.Table:
        cls, size, shingle = _entries(rows, starts)
        shared = _holders(shingle) > 1
        names, first, n = np.unique(cls[shared], return_index=True, return_counts=True)
        need = least_shared(size[shared][first].astype(np.int64), options)
        return pa.table([pa.array(names), pa.array(n), pa.array(need)], names=["class", "shared", "need"])

    dealt = by_bucket(heads.select("class", F.col("head").alias("shingles"), F.col("n_shingles").alias("n")), len(starts))
    found = dealt.groupBy("bucket").applyInArrow(share, "class long, shared long, need long")
    return found.groupBy("class").agg(F.sum("shared").alias("shared"), F.max("need").alias("need")).filter(
        "shared >= need").select("class")


def shared_shingles(sets: DataFrame, shingles: int, options: JaccardOptions) -> DataFrame:
    """Classes with enough shared shingles to link: class, n, tokens (sorted), signatures.

    Given are ``class_sets`` with ``shingles`` in all. Both exchanges carry packed arrays: first
    by ranges of the shingles, to count the classes of each, then by class, for the shingles that
    several classes hold.
    """
    starts = _bucket_starts(bucket_count(shingles))

    def count(rows: pa.Table) -> pa.Table:
        cls, size, shingle = _entries(rows, starts)
        holders = _holders(shingle)
        shared = holders > 1
        shingle, cls, size, holders = shingle[shared], cls[shared], size[shared], holders[shared]
        target = ((cls.view(np.uint64) >> np.uint64(32)) * np.uint64(len(starts)) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((shingle, cls, target))
        shingle, cls, size, holders, target = (x[order] for x in (shingle, cls, size, holders, target))
        out = [], [], [], [], [], []
        for b, start, end in _runs(target):
            names, first, n = np.unique(cls[start:end], return_index=True, return_counts=True)
            row = (b, names.tobytes(), size[start:end][first].astype("<u4").tobytes(), n.astype("<u4").tobytes(),
                   shingle[start:end].astype("<u8").tobytes(), np.minimum(holders[start:end], 65535).astype("<u2").tobytes())
            for column, value in zip(out, row):
                column.append(value)
        return pa.table([pa.array(out[0], pa.int64()), *(pa.array(c, pa.binary()) for c in out[1:])],
                        names=["bucket", "names", "sizes", "counts", "shingles", "holders"])

    def gather(rows: pa.Table) -> pa.Table:
        cls, size, shingle = _unpack(rows, None)
        holders = np.concatenate([np.frombuffer(x, "<u2") for x in rows.column("holders").to_pylist()])
        order = np.lexsort((shingle, cls))
        cls, size, shingle, holders = cls[order], size[order], shingle[order], holders[order]
        out = [], [], [], []
        for name, start, end in _runs(cls):
            n = int(size[start])
            if (end - start) * 100 >= options.percent * n:
                tokens = shingle[start:end]
                signatures = prefix_signatures(tokens, holders[start:end], n, options)
                for column, value in zip(out, (name, n, tokens.tobytes(), signatures)):
                    column.append(value)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                         pa.array(out[3], pa.list_(pa.int64()))], names=["class", "n", "tokens", "signatures"])

    counted = by_bucket(sets, len(starts)).groupBy("bucket").applyInArrow(count, PACKED + ", holders binary")
    return counted.groupBy("bucket").applyInArrow(gather, "class long, n long, tokens binary, signatures array<long>")


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run of equal values."""
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)] if len(values) else [0]
    for start, end in zip(cuts, cuts[1:]):
        yield int(values[start]), start, end


PACKED = "bucket long, names binary, sizes binary, counts binary, shingles binary"


def _packed(bucket: list, names: list, sizes: list, counts: list, shingles: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), *(pa.array(c, pa.binary()) for c in (names, sizes, counts, shingles))],
                                      names=["bucket", "names", "sizes", "counts", "shingles"])


def _unpack(rows: pa.Table, least: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, size, shingle) of all entries; shingles are whole if ``least`` is None, else less this."""
    cls, size, shingle = [], [], []
    for names, sizes, counts, raw in zip(*(rows.column(c).to_pylist() for c in ("names", "sizes", "counts", "shingles"))):
        n = np.frombuffer(counts, "<u4")
        cls.append(np.repeat(np.frombuffer(names, "<i8"), n))
        size.append(np.repeat(np.frombuffer(sizes, "<u4"), n))
        shingle.append(np.frombuffer(raw, "<u8") if least is None else _from_short(raw, LOW_BITS) + np.uint64(least))
    return np.concatenate(cls), np.concatenate(size), np.concatenate(shingle)


def prefix_signatures(tokens: np.ndarray, holders: np.ndarray, n: int, options: JaccardOptions) -> np.ndarray:
    """Index entries of a set of ``n`` shingles, of which ``tokens`` are shared by ``holders`` sets."""
    order = np.lexsort((tokens, holders))
    tokens, holders = tokens[order], holders[order]
    overlap = least_overlap(n, options)
    alone = n - len(tokens)  # unshared shingles stand first
    out = []
    for band in {int(n).bit_length(), int(overlap).bit_length()}:
        least = 1 << band - 1
        classes = max(1, (least * (100 - options.percent) // 100) // options.combine)
        # With overlap s the whole set is the prefix; then all of it is shared. The count depends on
        # the band's least size alone, as both sides of a link must agree on it.
        classes = min(classes, max(0, -(-options.percent * least // 100) - 1))
        prefix = max(0, n - overlap + 1 + classes - alone)
        head, rare = tokens[:prefix], holders[:prefix] <= options.rare
        seed = np.uint64(band * 0x9E3779B97F4A7C15 % 2**64)
        if classes == 0:
            out.append(mix64(head ^ seed))
            continue
        out.append(mix64(head[rare] ^ seed))
        frequent = head[~rare]
        group = mix64(frequent + seed) % np.uint64(classes)
        by_group = np.argsort(group, kind="stable")
        frequent, group = frequent[by_group], group[by_group]
        for _, start, end in _runs(group):
            part = np.sort(frequent[start:end])
            a, b = np.triu_indices(len(part), 1)
            out.append(mix64(mix64(part[a] ^ seed) + part[b]))
    return np.unique(np.concatenate(out)).view(np.int64)


# ---- verification ----------------------------------------------------------------------------

def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, added up over pieces of the shared shingles."""
    sizes = [len(x) for x in left], [len(x) for x in right]
    names, codes = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    cut = sum(sizes[0])
    rows = np.repeat(np.arange(len(left)), sizes[0]), np.repeat(np.arange(len(right)), sizes[1])
    columns = codes[:cut], codes[cut:]
    both = np.bincount(columns[0], minlength=len(names)).astype(bool) & np.bincount(columns[1], minlength=len(names)).astype(bool)
    number = np.cumsum(both) - 1
    out = np.zeros((len(left), len(right)), np.float32)
    step = max(256, (1 << 22) // max(len(left), len(right)))
    for start in range(0, int(both.sum()), step):
        dense = []
        for side, r, c in zip((left, right), rows, columns):
            keep = both[c] & (number[c] >= start) & (number[c] < start + step)
            matrix = np.zeros((len(side), step), np.float32)
            matrix[r[keep], number[c[keep]] - start] = 1
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def _spanning(linked: np.ndarray) -> np.ndarray:
    """Least place that each of the left and right sides (one after the other) is connected with."""
    n, m = linked.shape
    label = np.arange(n + m)
    while True:
        before = label.copy()
        label[:n] = np.minimum(label[:n], np.where(linked, label[None, n:], n + m).min(axis=1, initial=n + m))
        label[n:] = np.minimum(label[n:], np.where(linked, label[:n, None], n + m).min(axis=0, initial=n + m))
        label = label[label]
        if (label == before).all():
            return label


def verify_jobs(jobs: DataFrame, options: JaccardOptions) -> DataFrame:
    """Spanning edges (a, b) of jobs: rows (bin, job, left, right, class, n, tokens)."""

    def verify(rows: pa.Table) -> pa.Table:
        job = rows.column("job").to_numpy()
        order = np.argsort(job, kind="stable")
        cls, n = rows.column("class").to_numpy()[order], rows.column("n").to_numpy()[order]
        left, right = (rows.column(c).to_numpy(zero_copy_only=False)[order] for c in ("left", "right"))
        tokens = [np.frombuffer(x, np.uint64) for x in rows.column("tokens").take(pa.array(order)).to_pylist()]
        a, b = [], []
        for _, start, end in _runs(job[order]):
            own = np.arange(start, end)
            l, r = own[left[start:end]], own[right[start:end]]
            if not len(l) or not len(r):
                continue
            overlap = _overlaps([tokens[k] for k in l], [tokens[k] for k in r])
            linked = 100 * overlap >= options.percent * (n[l][:, None] + n[r][None, :] - overlap)
            names = np.concatenate([cls[l], cls[r]])
            label = _spanning(linked)
            far = np.flatnonzero(names != names[label])
            a.append(names[far])
            b.append(names[label][far])
        pairs = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b)]
        return pa.table([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return jobs.groupBy("bin").applyInArrow(verify, "a long, b long")


def _jobs(members: DataFrame, options: JaccardOptions) -> DataFrame:
    """First round: every block of a cluster against its block 0 and itself.

    Small clusters share bins, so that tasks aren't too small; there are as many as members ask for.
    """
    bins = max(512, members.count() // BIN_CLASSES)
    blocks = F.expr(f"(members + {options.block - 1}) div {options.block}")
    placed = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), "blocks"))
    jobs = F.when(F.col("block") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(
        F.array("block", F.col("block") + F.col("blocks")))
    # Job j < blocks: block 0 against block j; job blocks + j: block j against itself.
    dealt = placed.withColumn("j", F.explode(jobs)).withColumn("job", F.xxhash64("cluster", "j"))
    return dealt.select(
        F.when(F.col("blocks") == 1, F.pmod("job", F.lit(bins))).otherwise(F.col("job")).alias("bin"), "job",
        ((F.col("block") == 0) | (F.col("j") >= F.col("blocks"))).alias("left"),
        ((F.col("block") == F.col("j")) | (F.col("j") >= F.col("blocks"))).alias("right"), "class", "n", "tokens")


def _second_jobs(members: DataFrame, options: JaccardOptions) -> DataFrame:
    """Second round: what is outside a cluster's largest component against all of the cluster."""
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("cluster").agg(F.max_by("component", F.struct("size", "component")).alias("main"),
                                        (F.sum("size") - F.max("size")).alias("outside"))
    placed = members.join(main.filter("outside > 0"), "cluster")
    outer = F.expr(f"(outside + {options.block - 1}) div {options.block}")
    placed = (placed.withColumn("blocks", F.expr(f"(members + {options.block - 1}) div {options.block}"))
              .withColumn("outer", outer)
              .withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), "blocks"))
              .withColumn("from", F.when(F.col("component") != F.col("main"), F.pmod(F.xxhash64("class", F.lit(2)), "outer"))))
    as_right = placed.select("*", F.explode(F.expr("sequence(0L, outer - 1)")).alias("i")).select(
        F.xxhash64("cluster", "i", "block").alias("job"), F.lit(False).alias("left"), F.lit(True).alias("right"), "class", "n", "tokens")
    as_left = placed.filter("from IS NOT NULL").select("*", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("j")).select(
        F.xxhash64("cluster", "from", "j").alias("job"), F.lit(True).alias("left"), F.lit(False).alias("right"), "class", "n", "tokens")
    return as_right.unionByName(as_left).withColumn("bin", F.col("job"))


def link_classes(docs: DataFrame, named: DataFrame, options: JaccardOptions) -> DataFrame:
    """(class, component) of the classes that link with others, given the documents and their ``document_sets``."""
    chosen = materialize(candidate_classes(named, options), "jaccard-candidates")
    sizes = named.select("class", "n_shingles").join(chosen, "class", "left_semi").distinct()
    shingles = sizes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    texts = class_texts(docs, options).join(chosen, "class", "left_semi")
    sets = materialize(shared_shingles(class_sets(texts, options), shingles, options), "jaccard-sets")
    index = materialize(sets.select("class", F.explode("signatures").alias("signature")), "jaccard-index")
    groups = index.groupBy("signature").agg(F.min("class").alias("center"), F.count("*").alias("n")).filter("n > 1")
    star = index.join(groups, "signature").filter("class <> center").select(F.col("class").alias("a"), F.col("center").alias("b"))
    clusters = connected_components(star, "jaccard-clusters").withColumnRenamed("component", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    members = clusters.withColumnRenamed("node", "class").join(sizes, "cluster")
    members = materialize(members.join(sets.select("class", "n", "tokens"), "class"), "jaccard-members")
    first = materialize(verify_jobs(_jobs(members, options), options), "jaccard-edges")
    found = connected_components(first, "jaccard-components")
    # Clusters of one block are done.
    large = members.filter(F.col("members") > options.block).join(
        found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    second = materialize(verify_jobs(_second_jobs(large, options), options), "jaccard-edges")
    if not second.isEmpty():
        found = connected_components(first.union(second), "jaccard-components")
    return found.withColumnRenamed("node", "class")


def near_duplicates(docs: DataFrame, options: JaccardOptions = JaccardOptions()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    ship_package(docs.sparkSession)
    sets = materialize(document_sets(docs, options), "jaccard-documents")
    linked = link_classes(docs, sets, options)
    least = sets.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    named = materialize(least.join(linked, "class", "left").withColumn("component", F.coalesce("component", "class")), "jaccard-classes")
    best = named.groupBy("component").agg(F.min("least").alias("component_id"))
    names = materialize(named.join(best, "component").select("class", "component_id"), "jaccard-names")
    joined = sets.join(names, "class", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(
        F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, options: JaccardOptions = JaccardOptions()) -> DataFrame:
    """One document of each group, the one with the least doc_id, with the columns of ``documents``.

    Of rows with equal doc_id and text one stays; documents without a doc_id or words all stay.
    """
    found = near_duplicates(docs, options)
    dropped = materialize(found.filter("doc_id <> component_id").select("doc_id"), "jaccard-dropped")
    kept = docs.select("doc_id", "text", "lang", "source", "n_chars").join(dropped, "doc_id", "left_anti")
    order = Window.partitionBy("doc_id", "digest").orderBy("source", "lang")
    kept = kept.withColumn("digest", F.xxhash64("text")).withColumn("copy", F.row_number().over(order))
    return kept.filter("copy = 1 OR doc_id IS NULL").drop("copy", "digest")
