"""Mixing sources to target weights (operator 3).

The words of each source stand in a row, packed into blocks of a fixed number of words. The mix is
a row of slots, dealt into output shards. Each shard draws how many of its slots every source
fills; the draws are multinomial, conditioned on the totals, so that every source meets its target
to the word. A source's slots are numbered over all shards and mapped to its blocks by a
pseudorandom index permutation, one per source and epoch, and blocks are joined by their index.

All of it is DataFrame work. No step sorts or sums a source in one task: positions of documents
come from sums of hashed buckets, the permutation is computed from an index alone.

Special cases: a null text has no words; null is a source of its own; documents without words are
returned with ``taken`` 0; rows that repeat a ``doc_id`` are mixed as separate documents; other
columns are ignored. Without words all targets are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import WORD
from wardlens.session import materialize

PRIME = 2**31 - 1
ROUNDS = 12


@dataclass(frozen=True)
class MixOptions:
    weights: tuple[int, ...] = (3, 1, 2)  # of the sources in code point order, repeating
    share: float = 1.5                    # of the mix, times all words
    cap: float = 2.0                      # of a source's target, times its words
    block_words: int = 512
    shard_slots: int = 4096
    seed: int = 20240117


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, so that it is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def permute(x: str, n: str, key: str) -> Column:
    """A pseudorandom bijection of 0 .. n - 1, by column names: swap-or-not with ``ROUNDS`` rounds.

    Round r pairs x with (K - x) mod n and swaps the two if a hash bit of their larger one is set;
    so it is a bijection for every n, without walking cycles. Both hashes are polynomials modulo
    the prime 2^31 - 1, small enough for 64-bit integers; DuckDB computes the same.
    """
    p = PRIME
    start = f"pmod(({key} + r * 40503) * 48271, {p})"
    shift = _let(_let(start, "h", f"pmod(pmod(h * h, {p}) * h + 11, {p})"), "h",
                 f"pmod(h * {p} + pmod(h * 69621, {p}), {n})")
    mixed = (f"pmod(pmod(pmod(z, {p}) * 16807, {p}) + pmod((z div {p}) * 39373, {p})"
             f" + pmod({key} * 31 + r * 7919, {p}), {p})")
    bit = _let(mixed, "h", _let(f"pmod(pmod(h * h, {p}) * h + 7, {p})", "g", "(g div 32768) % 2"))
    swap = _let(f"pmod({shift} - x, {n})", "y",
                _let("greatest(x, y)", "z", f"CASE WHEN {bit} = 1 THEN y ELSE x END"))
    return F.expr(f"aggregate(sequence(0L, {ROUNDS - 1}L), {x}, (x, r) -> {swap})")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, options: MixOptions) -> DataFrame:
    """One row per source: its number, words, target and slots.

    The resharing above the caps ends where every source holds the lesser of its cap and its weight
    times one level; with the sources in order of cap over weight, that level is the greatest of
    (mix - caps before) / (weights from here on). Windows run over sources, not over documents.
    """
    weights = F.array(*map(F.lit, options.weights))
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("source_no", (F.row_number().over(by_code) - 1).cast("long"))
    sources = sources.withColumn("weight", F.element_at(
        weights, (F.col("source_no") % len(options.weights) + 1).cast("int")).cast("double"))
    sources = sources.withColumn("most", F.lit(options.cap) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    every = Window.partitionBy()
    sources = sources.withColumn("level", F.expr(f"{options.share}D") * F.sum("source_size").over(every)).withColumn(
        "level", (F.col("level") - F.sum("most").over(by_ratio) + F.col("most"))
        / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    sources = sources.withColumn("target", F.least(
        "most", F.max("level").over(every) * F.col("weight")))
    b = options.block_words
    return (sources.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
            .withColumn("epochs", F.expr("CASE WHEN source_size > 0 THEN words div source_size ELSE 0L END"))
            .withColumn("rest", F.expr("words - epochs * source_size"))
            .withColumn("epoch_slots", F.expr(f"(source_size + {b - 1}) div {b}"))
            .withColumn("slots", F.expr(f"epochs * epoch_slots + (rest + {b - 1}) div {b}"))
            .withColumn("first_slot", F.sum("slots").over(by_code) - F.col("slots"))
            .drop("level", "most"))


def draw_slots(sources: DataFrame, options: MixOptions) -> DataFrame:
    """Every slot of the mix: shard, source_no, epoch, block and how many of its words are taken."""
    spark, b, chunk = sources.sparkSession, options.block_words, 1 << 16
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)).cast("long")).first()[0]
    labels = sources.filter("slots > 0").select(
        "source_no", "first_slot", "slots",
        F.explode(F.expr(f"sequence(first_slot div {chunk}, (first_slot + slots - 1) div {chunk})")).alias("chunk"))
    dealt = (spark.range(total).withColumn("n", F.lit(total)).withColumn("seed", F.lit(options.seed).cast("long"))
             .withColumn("label", permute("id", "n", "seed"))
             .withColumn("shard", F.expr(f"id div {options.shard_slots}"))
             .withColumn("chunk", F.expr(f"label div {chunk}")))
    counts = (dealt.join(labels, "chunk").filter("label >= first_slot AND label < first_slot + slots")
              .groupBy("shard", "source_no").agg(F.count("*").alias("n")))
    before = Window.partitionBy("source_no").orderBy("shard")
    drawn = counts.withColumn("first", F.sum("n").over(before) - F.col("n"))
    slots = drawn.select("shard", "source_no", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    slots = slots.join(sources.filter("slots > 0").select("source_no", "source_size", "rest", "epochs", "epoch_slots"), "source_no")
    slots = (slots.withColumn("epoch", F.expr("slot div epoch_slots"))
             .withColumn("index", F.expr("slot % epoch_slots"))
             .withColumn("full", F.expr(f"source_size div {b}"))
             .withColumn("key", F.expr(f"source_no * 7919 + epoch * 104729 + {options.seed}"))
             # The short block of a source closes each epoch; the full ones are permuted.
             .withColumn("block", F.when(F.col("index") < F.col("full"), permute("index", "full", "key"))
                         .otherwise(F.col("index"))))
    length = F.least(F.lit(b), F.col("source_size") - F.col("block") * b)
    # The last slot of a broken epoch is cut, so that the source's words end at its target.
    last = (F.col("epoch") == F.col("epochs")) & ((F.col("index") + 1) * b > F.col("rest"))
    return slots.select("shard", "source_no", "epoch", "block", length.cast("long").alias("length"),
                        F.when(last, F.col("rest") - F.col("index") * b).otherwise(length).cast("long").alias("taken"))


def place_documents(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``start``, the number of words before a document in its source, and a row key.

    Documents stand in order of a hashed bucket, then doc_id. There are about as many buckets as
    documents in one, so both the windows in buckets and those over buckets stay small.
    """
    buckets = max(16, int(sizes.count() ** 0.5))
    numbered = sizes.join(sources.select("source", "source_no", "source_size", "target"),
                          sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    numbered = numbered.withColumn("bucket", F.expr(
        f"pmod(pmod(pmod(coalesce(doc_id, -1), {PRIME}) * 48271, {PRIME}), {buckets})"))
    sums = numbered.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    over = Window.partitionBy("source_no").orderBy("bucket")
    sums = sums.select("source_no", "bucket", (F.sum("words").over(over) - F.col("words")).alias("before"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "size", *[c for c in ("digest",) if c in sizes.columns])
    return (numbered.withColumn("place", F.row_number().over(inside))
            .withColumn("within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .join(sums, ["source_no", "bucket"])
            .withColumn("start", F.col("before") + F.col("within")).drop("before", "within"))


def _pieces(placed: DataFrame, options: MixOptions) -> DataFrame:
    """Documents cut at block borders: words low .. high - 1 of ``block``."""
    b = options.block_words
    return (placed.filter("size > 0")
            .withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")))
            .withColumn("low", F.greatest(F.lit(0), F.col("start") - F.col("block") * b).cast("long"))
            .withColumn("high", F.least(F.lit(b), F.col("start") + F.col("size") - F.col("block") * b).cast("long")))


def _plan(docs: DataFrame, options: MixOptions, digest: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    extra = [F.xxhash64("text").alias("digest")] if digest else []
    sizes = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *extra), "mix-sizes")
    sources = materialize(source_targets(sizes, options).coalesce(1), "mix-sources")
    return materialize(draw_slots(sources, options), "mix-slots"), place_documents(sizes, sources), sources


def mix(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, words ``taken`` by the mix."""
    slots, placed, _ = _plan(docs, options)
    key = ["source_no", "bucket", "place"]
    used = slots.groupBy("source_no", "block").agg(
        F.sum(F.when(F.col("taken") == F.col("length"), 1).otherwise(0)).alias("whole"),
        F.max(F.when(F.col("taken") < F.col("length"), F.col("taken")).otherwise(0)).alias("cut"))
    taken = (_pieces(placed.select(*key, "start", "size"), options).join(used, ["source_no", "block"])
             .withColumn("n", F.expr("whole * (high - low) + greatest(0, least(high, cut) - low)"))
             .groupBy(*key).agg(F.sum("n").alias("taken")))
    return placed.join(taken, key, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """The mix as documents: one row per document and epoch that takes words of it.

    A document that an epoch takes whole keeps its text; of others, the taken words remain, with
    single spaces. Columns as in ``documents``.
    """
    slots, placed, _ = _plan(docs, options, digest=True)
    key = ["source_no", "bucket", "place"]
    same = Window.partitionBy("doc_id", "digest", "source").orderBy("doc_id")
    takes = (_pieces(placed.select(*key, "doc_id", "source", "digest", "start", "size"), options)
             .join(slots, ["source_no", "block"])
             .withColumn("n", F.expr("least(high, taken) - low")).filter("n > 0")
             .groupBy(*key, "doc_id", "source", "digest", "size", "epoch")
             .agg(F.array_sort(F.collect_list(F.struct(
                 (F.col("block") * options.block_words + F.col("low") - F.col("start")).cast("int").alias("at"),
                 F.col("n").cast("int").alias("n")))).alias("parts"), F.sum("n").alias("n"))
             .groupBy(*key, "doc_id", "source", "digest", "size")
             .agg(F.collect_list(F.struct("epoch", "n", "parts")).alias("epochs")))
    takes = takes.withColumn("copy", F.row_number().over(
        Window.partitionBy("doc_id", "digest", "source").orderBy(*key))).drop(*key)
    texts = docs.select("doc_id", "text", "lang", "source").withColumn("digest", F.xxhash64("text")).withColumn(
        "copy", F.row_number().over(same))
    on = (texts["doc_id"].eqNullSafe(takes["doc_id"]) & (texts["digest"] == takes["digest"])
          & texts["source"].eqNullSafe(takes["source"]) & (texts["copy"] == takes["copy"]))
    joined = texts.join(takes.drop("lang"), on).select(
        texts["doc_id"], "text", "lang", texts["source"], "size", F.explode("epochs").alias("e"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.expr("array_join(flatten(transform(e.parts, p -> slice(words, p.at + 1, p.n))), ' ')")
    return (joined.withColumn("words", F.when(F.col("e.n") < F.col("size"), words))
            .withColumn("text", F.when(F.col("e.n") < F.col("size"), cut).otherwise(F.col("text")))
            .select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")))
