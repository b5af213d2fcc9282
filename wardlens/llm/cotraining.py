"""Quality classifier by co-training (operator 5).

Two views of a document are judged by classifiers of their own: its text (characters and words) and its
metadata (language, source, lengths, line layout). Both are fitted on labelled documents; then, over some rounds,
each labels the documents of an unlabelled pool that it is surest of, for the other one to learn
from. Last, the views are calibrated on labelled documents and combined, and all documents scored.

Sample and pool are bounded and chosen by hash; features are computed on executors and only the
sample's few numbers per document are gathered. Scoring covers whole texts of all documents.

Special cases: null and empty texts have features 0; null lang and source are values of their own;
labels other than 0 and 1 are ignored, of several the highest counts; repeated documents are scored as
often as they occur. With labels of one class only every score is their share of label 1 (0 without labels).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import ship_package, slices, split_words
from wardlens.llm.toxicity import held_out

SLOTS = 16          # hashed values of lang and of source
SYMBOLS = b"!?.,;:#*%&$|<>{}@/\\_="


@dataclass(frozen=True)
class CotrainOptions:
    labelled: int = 8000     # documents with labels that are learned from, at most
    pool: int = 8000         # documents whose labels aren't used, at most
    rounds: int = 5
    per_round: int = 400     # documents that a view labels in a round, at most
    sure: float = 0.9        # least probability of such a label
    decay: float = 1e-2


def text_features(texts: pa.Array) -> np.ndarray:
    """Content view: shares of kinds of characters and words, and how much repeats."""
    texts = pc.fill_null(texts, "").combine_chunks() if isinstance(texts, pa.ChunkedArray) else pc.fill_null(texts, "")
    raw = b"\n".join(t.encode() for t in texts.to_pylist()) + b"\n"
    chars = np.frombuffer(raw, np.uint8)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes + 1)])

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[ends[1:] - 1] - total[ends[:-1]]) / np.maximum(1, sizes)

    kinds = [(chars >= 65) & (chars <= 90), (chars >= 97) & (chars <= 122), (chars >= 48) & (chars <= 57), chars == 32, chars >= 128]
    columns = [share(k) for k in kinds] + [np.sqrt(share(chars == s)) for s in SYMBOLS]
    codes, borders, words = split_words(texts)
    n = np.diff(borders)
    text = np.repeat(np.arange(len(n)), n)
    least = np.maximum(1, n)
    pair, counts = np.unique(text * max(1, len(words)) + codes, return_counts=True)
    owner = pair // max(1, len(words))
    top = np.zeros(len(n))
    np.maximum.at(top, owner, counts)
    again = np.zeros(len(codes))
    again[1:] = (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)[codes] if len(words) else np.zeros(0)
    mean = np.bincount(text, lengths, len(n)) / least
    columns += [np.bincount(owner, minlength=len(n)) / least, top / least, np.bincount(text, again, len(n)) / least,
                mean / 10, np.sqrt(np.maximum(0, np.bincount(text, lengths**2, len(n)) / least - mean**2)) / 10,
                np.log1p(n) / 10]
    return np.column_stack(columns)


def metadata_features(lang: pa.Array, source: pa.Array, texts: pa.Array) -> np.ndarray:
    """Metadata view: hashed language and source, lengths and line layout."""
    count = len(texts)
    out = np.zeros((count, 2 * SLOTS + 7))
    for k, column in enumerate((lang, source)):
        for i, value in enumerate(column.to_pylist()):
            out[i, k * SLOTS + zlib.crc32(repr(value).encode()) % SLOTS] = 1
    for i, text in enumerate(texts.to_pylist()):
        if text:
            lines = text.split("\n")
            sizes = np.array([len(x) for x in lines])
            out[i, 2 * SLOTS:] = (np.log1p(len(text)) / 10, np.log1p(len(lines)) / 5, np.log1p(sizes.mean()) / 10,
                                  np.log1p(sizes.max()) / 10, (sizes < 40).mean(), len(set(lines)) / len(lines),
                                  np.mean([x[-1:] in (".", "!", "?", ":") for x in lines]))
    return out


# ---- models on gathered features ---------------------------------------------------------------

@dataclass(frozen=True)
class View:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias


@dataclass(frozen=True)
class QualityModel:
    content: View | None
    metadata: View | None
    mix: np.ndarray  # bias, weight of the content view, weight of the metadata view

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        if self.content is None:
            return np.full(len(content), self.mix[0])
        z = self.mix[0] + self.mix[1] * self.content.logits(content) + self.mix[2] * self.metadata.logits(metadata)
        return _sigmoid(z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float) -> View:
    """Logistic regression on standardised inputs, by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    ridge = np.full(a.shape[1], decay * len(x) / 100)
    ridge[0] = 1e-6
    for _ in range(25):
        p = _sigmoid(a @ w)
        slope = a.T @ (p - y) + ridge * w
        curve = (a * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ a + np.diag(ridge)
        move = np.linalg.solve(curve, slope)
        w -= move * min(1.0, 5 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    return View(mean, scale, w[1:], float(w[0]))


def cotrain(content: np.ndarray, metadata: np.ndarray, labels: np.ndarray, options: CotrainOptions) -> QualityModel:
    """Fits both views; ``labels`` are 0 or 1, and -1 for documents of the pool."""
    known = np.flatnonzero(labels >= 0)
    y = labels[known].astype(float)
    if len(set(y)) < 2:
        return QualityModel(None, None, np.array([y.mean() if len(y) else 0.0]))
    # Every third labelled document is kept from the views, to calibrate them.
    calibrate = np.zeros(len(known), bool)
    calibrate[::3] = True
    if len(set(y[~calibrate])) < 2 or len(set(y[calibrate])) < 2:
        calibrate[:] = False
    inputs, learned = (content, metadata), [labels.copy(), labels.copy()]
    for own in learned:
        own[known[calibrate]] = -1
    pool = np.flatnonzero(labels < 0)
    views: list[View] = []
    for turn in range(options.rounds + 1):
        views = [fit_logistic(x[own >= 0], own[own >= 0].astype(float), options.decay) for x, own in zip(inputs, learned)]
        if turn == options.rounds:
            break
        for k, other in ((0, 1), (1, 0)):
            open_ = pool[learned[other][pool] < 0]
            p = _sigmoid(views[k].logits(inputs[k][open_]))
            # As many of each label as its share among the labelled.
            for label, sure in ((1, p), (0, 1 - p)):
                share = y.mean() if label else 1 - y.mean()
                most = int(np.ceil(options.per_round * share))
                best = np.argsort(-sure, kind="stable")[:most]
                learned[other][open_[best[sure[best] >= options.sure]]] = label
    rows = known[calibrate] if calibrate.any() else known
    logits = np.column_stack([view.logits(x[rows]) for view, x in zip(views, inputs)])
    final = fit_logistic(logits, labels[rows].astype(float), options.decay)
    weights = final.weights / final.scale
    return QualityModel(views[0], views[1], np.array([final.bias - weights @ final.mean, *weights]))


# ---- Spark jobs ----------------------------------------------------------------------------------

def _views(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = part.column("text")
    return text_features(texts), metadata_features(part.column("lang"), part.column("source"), texts)


def fit_quality(docs: DataFrame, labels: DataFrame, options: CotrainOptions = CotrainOptions()) -> QualityModel:
    ship_package(docs.sparkSession)
    train = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")))
    chosen = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(options.labelled)
    # The pool is chosen from all ids; where it meets labelled documents, their labels count.
    pool = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(
        options.pool).join(chosen, "doc_id", "left_anti").withColumn("label", F.lit(-1))
    sample = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(chosen.unionByName(pool)), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                content, metadata = _views(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(list(content), pa.list_(pa.float64())),
                     pa.array(list(metadata), pa.list_(pa.float64()))], names=["doc_id", "label", "content", "metadata"])

    rows = sample.mapInArrow(features, "doc_id long, label int, content array<double>, metadata array<double>").toArrow()
    rows = rows.sort_by("doc_id")
    if not rows.num_rows:
        return QualityModel(None, None, np.array([0.0]))
    content, metadata = (np.array(rows.column(c).to_pylist(), float) for c in ("content", "metadata"))
    return cotrain(content, metadata, rows.column("label").to_numpy().copy(), options)


def classify_quality(docs: DataFrame, labels: DataFrame, options: CotrainOptions = CotrainOptions()) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted of every document."""
    model = fit_quality(docs, labels, options)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.scores(*_views(part)))],
                                                 names=["doc_id", "score"])

    scored = docs.select("doc_id", "text", "lang", "source").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
