"""Toxicity classifier (operator 8): naive Bayes log-count ratios scale character n-grams.

Features are the character n-grams of words with their borders, present in a text or not, known by a
64-bit hash. The model is fitted on a bounded sample of labelled rows: at most ``per_class`` of each
label, those with the least hashes. Where a label has more, the sample's rows are weighted so that
both labels have their shares of all training labels. Each n-gram gets the log ratio of its shares in both classes;
those that tell classes apart are kept, scaled by that ratio and weighted by logistic regression.
Scoring looks up the n-grams of each distinct word once and covers whole texts.

Special cases: null and empty texts have no features and get the score of the bias alone; labels
that are null or neither 0 nor 1 are ignored; of several labels of a document the highest counts;
repeated documents are scored as often as they occur. Without labels of both classes every score is
the share of label 1 (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import mix64, ship_package, slices, split_words
from wardlens.session import materialize


@dataclass(frozen=True)
class NgramOptions:
    shortest: int = 3
    longest: int = 6
    per_class: int = 3000        # labelled rows of each class that the model is fitted on
    min_texts: int = 4           # of the sample, that hold a kept n-gram
    min_ratio: float = 1.0       # absolute log-count ratio of a kept n-gram
    max_features: int = 60_000
    smoothing: float = 4.0
    decay: float = 1e-4
    steps: int = 150


@dataclass(frozen=True)
class LinearModel:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    options: NgramOptions


def word_ngrams(words: pa.Array, options: NgramOptions) -> tuple[np.ndarray, np.ndarray]:
    """(word, n-gram hash) of all character n-grams of lower-cased words between spaces."""
    joined = " " + " ".join(pc.utf8_lower(words).to_pylist()) + " "
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = chars == 32
    number = np.cumsum(space) - 1          # a space counts for the word after it
    owners, hashes, rolling = [], [], np.zeros(len(chars), np.uint64)
    inner = np.concatenate([[0], np.cumsum(space)])
    for n in range(1, options.longest + 1):
        count = len(chars) - n + 1
        if count <= 0:
            break
        rolling = mix64(rolling[:count] * np.uint64(0x9E3779B97F4A7C15) + chars[n - 1:])
        if n >= options.shortest:
            # Spaces may only stand at either end.
            whole = inner[n - 1:n - 1 + count] - inner[1:1 + count] == 0
            owners.append(number[:count][whole])
            hashes.append(rolling[whole])
    if not owners:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(owners), np.concatenate(hashes)


def _present(texts: pa.Array, options: NgramOptions, features: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) pairs, each once; n-grams are places in ``features`` if those are given."""
    codes, ends, words = split_words(texts)
    owners, grams = word_ngrams(words, options)
    if features is not None:
        place = np.searchsorted(features, grams)
        place[place == len(features)] = 0
        known = features[place] == grams if len(features) else np.zeros(len(grams), bool)
        owners, grams = owners[known], place[known].astype(np.uint64)
    order = np.argsort(owners, kind="stable")
    grams = grams[order]
    counts = np.bincount(owners, minlength=len(words))[:len(words)] if len(words) else np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    # Each text's distinct words, then their n-grams.
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    live = counts[codes] > 0 if len(codes) else np.zeros(0, bool)
    pair = np.unique(text[live] * max(1, len(words)) + codes[live])
    text, code = pair // max(1, len(words)), pair % max(1, len(words))
    n = counts[code]
    at = np.repeat(first[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    text, gram = np.repeat(text, n), grams[at]
    order = np.lexsort((gram, text))
    text, gram = text[order], gram[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
    return text[new], gram[new]


def class_weights(sampled: tuple[float, float], all_labels: tuple[float, float]) -> tuple[float, float]:
    """Weights of a sample's rows of labels 0 and 1 that restore the shares of all labels.

    They sum to the rows sampled, and are 1 where the sample has the shares already.
    """
    if not min(sampled) or not min(all_labels):
        return 1.0, 1.0
    total = sum(sampled) / sum(all_labels)
    return all_labels[0] / sampled[0] * total, all_labels[1] / sampled[1] * total


def fit_weights(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, features: np.ndarray, scale: np.ndarray,
                options: NgramOptions, weight: tuple[float, float] = (1.0, 1.0)) -> LinearModel:
    """Logistic regression over (row, feature) pairs, each with its feature's log-count ratio.

    ``weight`` holds the weights of rows with label 0 and 1.
    """
    positives, total = int(labels.sum()), len(labels)
    share = positives * weight[1] / (positives * weight[1] + (total - positives) * weight[0]) if total else 0.0
    each = np.where(labels > 0, weight[1], weight[0])
    if positives in (0, total):
        return LinearModel(np.empty(0, np.uint64), np.empty(0), _logit(share), options)
    values = scale[columns]
    weights, bias = np.zeros(len(features)), _logit(share)
    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, options.steps + 1):
        z = np.bincount(rows, weights=values * weights[columns], minlength=total) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * each / total
        slope = np.append(np.bincount(columns, weights=values * error[rows], minlength=len(features))
                          + options.decay * weights, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        move = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return LinearModel(features, weights * scale, float(bias), options)


def _logit(p: float) -> float:
    return -40.0 if p <= 0 else 40.0 if p >= 1 else float(np.log(p / (1 - p)))


def score_texts(texts: pa.Array, model: LinearModel) -> np.ndarray:
    rows, places = _present(texts, model.options, model.features)
    z = np.bincount(rows, weights=model.weights[places.astype(np.int64)], minlength=len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of all documents with a label that aren't held out."""
    return (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(label, text) of at most ``per_class`` labelled documents of each class.

    Rows are chosen by the hash of their id from the narrow label table, so the chosen ids are few
    by construction and may be broadcast.
    """
    clean = training_labels(labels, label).withColumn("h", F.xxhash64("doc_id"))
    chosen = None
    for value in (0, 1):
        part = clean.filter(F.col("label") == value).orderBy("h", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def fit_toxicity(docs: DataFrame, labels: DataFrame, options: NgramOptions = NgramOptions()) -> LinearModel:
    ship_package(docs.sparkSession)
    sample = training_sample(docs, labels, "toxic", options.per_class)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, grams = _present(part.column("text"), options, None)
                ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
                blobs = [grams[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(blobs, pa.binary())],
                    names=["doc_id", "label", "grams"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            blobs = [np.frombuffer(b, np.uint64) for b in batch.column("grams").to_pylist()]
            grams = np.concatenate(blobs) if blobs else np.empty(0, np.uint64)
            names, place, n = np.unique(grams, return_inverse=True, return_counts=True)
            pos = np.bincount(place, np.repeat(label, [len(b) for b in blobs]), len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(pos), pa.array(n)], names=["gram", "pos", "n"])

    held = materialize(sample.mapInArrow(present, "doc_id long, label int, grams binary"), "toxicity-sample")
    positives, total = held.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    if positives in (0, total):
        return LinearModel(np.empty(0, np.uint64), np.empty(0), _logit(positives / max(1, total)), options)
    # A label that was sampled in part stands for all its labels, however many rows it has here.
    ones, every = training_labels(labels, "toxic").agg(F.sum("label"), F.count("*")).first()
    counts = every - ones, ones
    weight = class_weights(tuple(min(n, options.per_class) for n in counts), counts)
    low, high = (total - positives) * weight[0], positives * weight[1]
    share, a = high / (low + high), options.smoothing
    ratio = F.log((F.col("pos") * weight[1] + a * share) / ((F.col("n") - F.col("pos")) * weight[0] + a * (1 - share))
                  ) - float(np.log(share / (1 - share)))
    counted = held.mapInArrow(count, "gram long, pos double, n long").groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    chosen = (counted.withColumn("ratio", ratio).filter((F.abs("ratio") >= options.min_ratio) & (F.col("n") >= options.min_texts))
              .orderBy((F.abs("ratio") * F.log1p("n")).desc(), "gram").limit(options.max_features)
              .select("gram", "ratio").toArrow())
    names, scale = chosen.column("gram").to_numpy().view(np.uint64), chosen.column("ratio").to_numpy()
    order = np.argsort(names)
    features, scale = names[order], scale[order]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.flatnonzero(np.isin(features, np.frombuffer(b, np.uint64))).astype("<i4").tobytes()
                     for b in batch.column("grams").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())],
                                             names=["doc_id", "label", "places"])

    # The driver gathers the places of chosen features of the bounded sample only.
    gathered = held.mapInArrow(place, "doc_id long, label int, places binary").toArrow().sort_by("doc_id")
    places = [np.frombuffer(b, "<i4") for b in gathered.column("places").to_pylist()]
    rows = np.repeat(np.arange(len(places)), [len(p) for p in places])
    return fit_weights(rows, np.concatenate(places), gathered.column("label").to_numpy().astype(float), features, scale, options,
                       weight)


def score_toxicity(docs: DataFrame, model: LinearModel) -> DataFrame:
    """(columns of ``docs``, score) for every document, over its whole text."""
    ship_package(docs.sparkSession)
    given = docs.select("doc_id", "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score_texts(part.column("text"), model))], names=["doc_id", "score"])

    return given.mapInArrow(score, "doc_id long, score double")


def classify_toxicity(docs: DataFrame, labels: DataFrame, options: NgramOptions = NgramOptions()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels, options))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, options: NgramOptions = NgramOptions()) -> DataFrame:
    """Documents with a score below 0.5, with the columns of ``documents``."""
    ship_package(docs.sparkSession)
    model = fit_toxicity(docs, labels, options)
    kept = docs.select("doc_id", "text", "lang", "source", "n_chars")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(score_texts(part.column("text"), model) < 0.5))

    return kept.mapInArrow(clean, kept.schema)
