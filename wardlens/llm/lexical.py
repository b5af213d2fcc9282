"""Ranked lexical search (operator 11): hybrid of term-at-a-time and document-at-a-time evaluation.

One pass over the documents writes an index of the query terms: blocks of documents, each with its documents'
ids and lengths and a posting list per term. Counts over the whole corpus (documents, terms, document
frequencies) come from the written index. Then every block answers every query by itself:

1. The shortest posting lists, which belong to the rare, heavy terms, are summed term at a time into
   accumulators. These are kept as one more list, in order of documents, bounded by its largest sum. The
   k-th largest sum is a first threshold, as no document's score is below its partial sum.
2. This list and the remaining long ones are evaluated document at a time, in windows of documents. Lists
   whose bounds together stay below the threshold bring up no candidates: they are only looked up
   (binary search, skipping everything between) for candidates of the other lists, heaviest first, and a
   candidate is dropped as soon as what is left can't lift it over the threshold.

The best of all blocks are ranked together. Scores are integers and equal those of a full evaluation.

Blocks hold a bounded number of postings; queries are taken in parts of bounded text, so a large query
table means more passes. Special cases: null texts and texts without a term are no documents; a null
query or one without terms finds nothing; repeated rows of ``docs`` are documents of their own, repeated
(item_id, text) pairs are answered once, and different texts with one item_id are ranked by themselves;
equal scores are in order of doc_id, null last; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import ship_package, slices, split_words
from wardlens.session import materialize


@dataclass(frozen=True)
class SearchOptions:
    top: int = 50
    block_postings: int = 1_000_000   # of an index block; one document more at most
    block_docs: int = 200_000
    short_share: float = 0.25         # accumulated postings, as a share of a block's documents
    short_least: int = 1024           # accumulated postings at least
    window: int = 4096                # candidates per list and window
    query_bytes: int = 4 << 20        # text of the queries that one pass takes, about


#: ASCII letters and digits are kept, capitals lowered, other ASCII separates; bytes of other characters stay.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)], np.uint8)


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each term, first term of each text + end, distinct terms)."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    folded = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer((offsets - offsets[0]).astype(np.int32)),
                                                             pa.py_buffer(_FOLD[data])])
    return split_words(folded)


def _pack(values: np.ndarray) -> bytes:
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


# ---- index ------------------------------------------------------------------------------------

HEADER = -1
INDEX = "block long, term int, docs long, words long, nulls long, a binary, b binary"


class _Block:
    """Documents and postings on their way into one index block."""

    def __init__(self, number: int) -> None:
        self.number, self.docs, self.postings = number, 0, 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, ids: np.ndarray, missing: np.ndarray, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray,
            tf: np.ndarray) -> None:
        self.parts.append((ids, missing, sizes, doc + self.docs, term, tf))
        self.docs, self.postings = self.docs + len(ids), self.postings + len(doc)

    def rows(self) -> pa.RecordBatch:
        """The header row (ids ascending, null ones last, and lengths), then a row per term."""
        ids, missing, sizes, doc, term, tf = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, missing))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        doc = number[doc]
        by_term = np.lexsort((doc, term))
        doc, term, tf = doc[by_term], term[by_term], tf[by_term]
        cuts = [*np.flatnonzero(np.diff(term, prepend=-2)).tolist(), len(term)]
        spans = list(zip(cuts, cuts[1:]))
        gaps = [_pack(np.diff(doc[s:e], prepend=0)) for s, e in spans]
        none = [0] * len(spans)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.number] * (len(spans) + 1), pa.int64()),
             pa.array([HEADER, *(int(term[s]) for s, _ in spans)], pa.int32()),
             pa.array([len(ids), *(e - s for s, e in spans)], pa.int64()),
             pa.array([int(sizes.sum()), *none], pa.int64()), pa.array([int(missing.sum()), *none], pa.int64()),
             pa.array([ids[order].astype("<i8").tobytes(), *gaps], pa.binary()),
             pa.array([_pack(sizes[order]), *(_pack(tf[s:e]) for s, e in spans)], pa.binary())],
            names=["block", "term", "docs", "words", "nulls", "a", "b"])


def build_index(docs: DataFrame, vocabulary: list[str], options: SearchOptions = SearchOptions()) -> DataFrame:
    """Index blocks of ``docs`` (doc_id, text) for the terms of a bounded vocabulary."""
    ship_package(docs.sparkSession)
    known = pa.array(vocabulary, pa.string())

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        block = _Block(first)
        for batch in batches:
            for part in slices(batch, "text"):
                codes, ends, words = terms_of(part.column("text"))
                sizes = np.diff(ends)
                kept = sizes > 0
                number = np.cumsum(kept) - 1
                ids = part.column("doc_id").filter(pa.array(kept))
                term = pc.fill_null(pc.index_in(words, known), -1).to_numpy()[codes] if len(words) else codes
                found = term >= 0
                doc = np.repeat(number, sizes)[found]
                pair, tf = np.unique(doc * max(1, len(known)) + term[found], return_counts=True)
                block.add(pc.fill_null(ids, 0).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False),
                          sizes[kept], pair // max(1, len(known)), pair % max(1, len(known)), tf)
                if block.docs >= options.block_docs or block.postings >= options.block_postings:
                    yield block.rows()
                    block = _Block(block.number + 1)
        if block.docs:
            yield block.rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(index, INDEX)


# ---- scores -----------------------------------------------------------------------------------

def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factors(sizes: np.ndarray, documents: int, words: int) -> np.ndarray:
    """50 + 50 * n / mean length, in integers; Python's where 64 bits don't suffice."""
    if 50 * int(sizes.max(initial=0)) * documents < 2**63:
        return 50 + (50 * sizes * documents) // words
    names, place = np.unique(sizes, return_inverse=True)
    return np.array([50 + (50 * n * documents) // words for n in names.tolist()], np.int64)[place]


def impacts(tf: np.ndarray, factors: np.ndarray, weight: int) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * factors))


@dataclass
class _List:
    """Documents in order with their scores; no score is above ``bound``."""

    docs: np.ndarray
    scores: np.ndarray
    bound: int
    at: int = 0


def _summed(docs: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    first = np.flatnonzero(np.diff(docs, prepend=-1))
    return docs[first], np.add.reduceat(scores, first) if len(first) else scores


def best_of_block(lists: list[_List], documents: int, options: SearchOptions) -> tuple[np.ndarray, np.ndarray]:
    """(document, score) of the ``top`` best documents by falling score, then rising document."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: len(x.docs))
    limit = max(options.short_least, int(options.short_share * documents))
    held = np.cumsum([len(x.docs) for x in lists]) if lists else np.empty(0)
    cut = int((held <= limit).sum())
    short, active = lists[:cut], lists[cut:]
    lowest = 0  # documents at or below can't be among the best
    if short:
        docs, sums = _summed(np.concatenate([x.docs for x in short]), np.concatenate([x.scores for x in short]))
        active = [_List(docs, sums, int(sums.max())), *active]
        if len(sums) >= options.top:
            lowest = int(np.partition(sums, len(sums) - options.top)[len(sums) - options.top]) - 1
    active.sort(key=lambda x: x.bound)
    bounds = np.cumsum([x.bound for x in active])
    best_docs, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
    while True:
        bringing = int((bounds <= lowest).sum())  # the first list that can bring up a candidate
        ahead = [x for x in active[bringing:] if x.at < len(x.docs)]
        if not ahead:
            return best_docs, best_scores
        end = min(int(x.docs[min(x.at + options.window, len(x.docs)) - 1]) for x in ahead) + 1
        found = []
        for x in ahead:
            to = x.at + int(np.searchsorted(x.docs[x.at:x.at + options.window + 1], end))
            found.append((x.docs[x.at:to], x.scores[x.at:to]))
            x.at = to
        docs, scores = _summed(np.concatenate([d for d, _ in found]), np.concatenate([s for _, s in found]))
        for k in range(bringing - 1, -1, -1):
            open_ = scores + bounds[k] > lowest
            docs, scores = docs[open_], scores[open_]
            if not len(docs):
                break
            x = active[k]
            place = np.searchsorted(x.docs, docs)
            place[place == len(x.docs)] = 0
            scores = scores + np.where(x.docs[place] == docs, x.scores[place], 0)
        better = scores > lowest
        docs, scores = np.concatenate([best_docs, docs[better]]), np.concatenate([best_scores, scores[better]])
        order = np.lexsort((docs, -scores))[:options.top]
        best_docs, best_scores = docs[order], scores[order]
        if len(order) == options.top:
            lowest = max(lowest, int(best_scores[-1]))


def search_index(index: DataFrame, queries: list[tuple[object, np.ndarray]], terms: int, item_type: str,
                 options: SearchOptions = SearchOptions()) -> DataFrame:
    """(query, item_id, doc_id, score): the best documents of each query in each block."""
    whole = index.filter(F.col("term") == HEADER).agg(F.sum("docs"), F.sum("words")).first()
    documents, words = whole[0] or 0, whole[1] or 0
    weights = np.zeros(terms, np.int64)
    # As many rows as the queries have distinct terms.
    for row in index.filter(F.col("term") >= 0).groupBy("term").agg(F.sum("docs").alias("df")).collect():
        weights[row.term] = term_weight(documents, row.df)

    def search(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        term, a, b = rows.column("term").to_numpy(), rows.column("a"), rows.column("b")
        header = int(np.flatnonzero(term == HEADER)[0])
        ids, nulls = np.frombuffer(a[header].as_py(), "<i8"), rows.column("nulls")[header].as_py()
        factors = length_factors(_unpack(b[header].as_py()), documents, words)
        places = {t: k for k, t in enumerate(term.tolist())}
        made: dict[int, tuple] = {}

        def listed(t: int) -> tuple:
            if t not in made:
                docs = np.cumsum(_unpack(a[places[t]].as_py()))
                scores = impacts(_unpack(b[places[t]].as_py()), factors[docs], int(weights[t]))
                made[t] = docs, scores, int(scores.max())
            return made[t]

        out: dict[str, list] = {"query": [], "item_id": [], "doc_id": [], "score": []}
        for number, (item, wanted) in enumerate(queries):
            lists = [_List(*listed(t)) for t in wanted.tolist() if t in places and weights[t] > 0]
            docs, scores = best_of_block(lists, len(ids), options)
            if len(docs):
                out["query"] += [number] * len(docs)
                out["item_id"] += [item] * len(docs)
                out["doc_id"] += [None if d >= len(ids) - nulls else int(ids[d]) for d in docs.tolist()]
                out["score"] += scores.tolist()
        return pa.table({"query": pa.array(out["query"], pa.int32()), "item_id": pa.array(out["item_id"], item_arrow),
                         "doc_id": pa.array(out["doc_id"], pa.int64()), "score": pa.array(out["score"], pa.int64())})

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(f"query int, item_id {item_type}, doc_id long, score long")
    item_arrow = to_arrow_type(schema["item_id"].dataType)
    return index.groupBy("block").applyInArrow(search, schema)


def ranked_search(docs: DataFrame, items: DataFrame, options: SearchOptions = SearchOptions()) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item."""
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType.simpleString()
    asked = materialize(items.select("item_id", "text").filter(F.col("text").isNotNull()).distinct(), "search-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // options.query_bytes)
    found = None
    for part in range(parts):
        # About ``query_bytes`` of text, dealt by hash.
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).toArrow().combine_chunks()
        if not mine.num_rows:
            continue
        codes, ends, words = terms_of(mine.column("text").combine_chunks())
        queries = [(item, np.unique(codes[s:e])) for item, s, e in
                   zip(mine.column("item_id").to_pylist(), ends.tolist(), ends[1:].tolist()) if e > s]
        if not queries:
            continue
        index = materialize(build_index(docs, words.to_pylist(), options), "search-index")
        best = search_index(index, queries, len(words), item_type, options)
        # As many rows as blocks have best documents, whatever the number of documents.
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= options.top)
                  .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    return found


#: The same ranking by full evaluation, over the tables ``documents`` and ``benchmark``.
SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT row, doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
asked AS (
  SELECT DISTINCT query, item_id, unnest(terms) AS term
  FROM (SELECT row_number() OVER () AS query, item_id,
          regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))),
postings AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM sizes)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term),
scored AS (
  SELECT query, item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (row), totals
  GROUP BY query, item_id, row, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
