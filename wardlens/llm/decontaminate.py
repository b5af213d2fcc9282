"""Benchmark decontamination by templates (operator 9).

Words become typed placeholders where they are numbers, units after numbers, or names (capitalised
words inside a sentence), else their lower-cased core without punctuation at either end. Runs of
``width`` consecutive template words are hashed, in documents and in benchmark items, and joined by
hash; so a question with other numbers or names still matches. A match counts only if its slots are
consistent: each value in the item stands for one value in the document. This is judged by alignment
(place in the document less place in the item), so that a copy is found beside variants of itself.
Windows of the words themselves are matched beside those of templates, so that no verbatim copy depends
on what is taken for a name, and a document's window may begin a sentence at any name.

Documents are read once. A filter of fixed size, made from the item windows and checked in place,
drops windows that can't match before anything is shuffled; the join after it is exact, whatever the
size of the benchmark. A document is reported for an item if the windows of one alignment cover
``coverage`` of the item's windows, with consistent alignments at most ``shift`` words away (small
insertions), or all windows found in the document do and are consistent, or all verbatim ones do.

Special cases: null and empty texts have no windows; items with fewer than ``width`` words have one
window of their own length, those with fewer than ``least_words`` one of the words themselves only; template
windows with fewer than ``least_literals`` words that are no placeholders and windows of words without a
letter or digit count nowhere; of rows that share a
``doc_id`` each text is judged by itself and the best reported, those without one by their texts, a row for each;
repeated items are reported each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import mix64, ship_package, slices, split_words, window_sums, word_hashes
from wardlens.session import materialize

#: Words that are units after a number, and numbers that are words.
UNITS = frozenset("""% percent mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres
    kilometer kilometers g kg mg lb lbs oz gram grams kilogram kilograms ounce ounces pound pounds ton tons l ml liter
    liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month
    months year years mph kmh dollar dollars euro euros cent cents usd eur gbp degree degrees celsius fahrenheit watt
    watts kw volt volts""".split())
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
    sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
    half twice""".split())
#: Fixed patterns: numbers, what surrounds a word's core, and ends of sentences.
NUMBER = r"^[\"'(]*[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?%?[\"').,;:!?]*$"
EDGES = r"^[^\p{L}\p{N}\p{M}]+|[^\p{L}\p{N}\p{M}]+$"
CLOSES = r"""[.!?:]["')\]»”’]*$"""
NUMBER_CODE, UNIT_CODE, NAME_CODE = 1, 2, 3


@dataclass(frozen=True)
class TemplateOptions:
    width: int = 8
    least_words: int = 5
    least_literals: int = 3
    coverage: float = 0.5
    shift: int = 16
    filter_bits: int = 26


@dataclass(frozen=True)
class Templates:
    """Template words of several texts in a row."""

    hashes: np.ndarray    # of template words; placeholders have the hash of their type
    exact: np.ndarray     # of the words' cores, or of words that have none
    cored: np.ndarray     # whether a word has a core
    kinds: np.ndarray     # 0 literal, else a placeholder's code
    ends: np.ndarray
    codes: np.ndarray
    cores: pa.Array       # the words by code, lower-cased, without punctuation at their ends


def templates(texts: pa.Array) -> Templates:
    codes, ends, words = split_words(texts)
    bare = pc.replace_substring_regex(words, EDGES, "")
    cores = pc.utf8_lower(bare)
    count = len(words)
    hashes = word_hashes(cores)
    flag = lambda mask: mask.to_numpy(zero_copy_only=False)
    number = flag(pc.or_(pc.match_substring_regex(words, NUMBER), pc.is_in(cores, pa.array(sorted(NUMBER_WORDS)))))
    units = pa.array(sorted(UNITS))
    unit = flag(pc.or_(pc.is_in(cores, units), pc.is_in(words, units)))
    capital = flag(pc.utf8_is_upper(pc.utf8_slice_codeunits(bare, 0, 1)))
    closes = flag(pc.match_substring_regex(words, CLOSES))
    kinds = np.zeros(len(codes), np.int64)
    if len(codes):
        starts = np.zeros(len(codes) + 1, bool)
        starts[ends[:-1]] = True
        starts[1:] |= np.append(closes[codes][:-1], True)
        kinds[capital[codes] & ~starts[:-1]] = NAME_CODE
        kinds[number[codes]] = NUMBER_CODE
        after = np.zeros(len(codes), bool)
        after[1:] = number[codes][:-1]
        kinds[unit[codes] & after & (kinds != NUMBER_CODE)] = UNIT_CODE
    tokens = np.where(kinds > 0, mix64(kinds.astype(np.uint64)), hashes[codes] if count else np.empty(0, np.uint64))
    bald = pc.equal(cores, "")
    exact, cored = word_hashes(pc.if_else(bald, words, cores)), ~flag(bald)
    own = lambda values, kind: values[codes] if count else np.empty(0, kind)
    return Templates(tokens, own(exact, np.uint64), own(cored, bool), kinds, ends, codes, cores)


#: Readings of a window: its template, the template with a name in front read as a word, its words.
TEMPLATE, OPENED, EXACT = 0, 1, 2


def windows(t: Templates, width: int, options: TemplateOptions, reading: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in all words, hash) of all windows that count, in one reading."""
    hashes = window_sums(t.exact if reading == EXACT else t.hashes, width)
    if not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64), hashes
    count = len(hashes)
    place = np.arange(count)
    text = np.searchsorted(t.ends, place, "right") - 1
    good = place + width <= t.ends[text + 1]
    literal = np.concatenate([[0], np.cumsum(t.cored if reading == EXACT else t.kinds == 0)])
    literal = literal[width:][:count] - literal[:count]
    if reading == OPENED:
        hashes += t.exact[:count] - t.hashes[:count]
        literal = literal + 1
        good &= t.kinds[:count] == NAME_CODE
    good &= literal >= (1 if reading == EXACT else min(options.least_literals, width))
    salt = np.uint64(width + (1 << 32) * (reading == EXACT))
    return text[good], place[good], mix64(mix64(hashes[good]) + salt)


def _slots(t: Templates, place: int, width: int, reading: int = TEMPLATE) -> list[str]:
    first = place + (reading == OPENED)
    if not t.kinds[first:place + width].any():
        return []
    return [t.cores[int(t.codes[k])].as_py() for k in range(first, place + width) if t.kinds[k]]


def item_windows(items: DataFrame, options: TemplateOptions) -> DataFrame:
    """item_id, item_no, at, exact, width, hash, slots of the benchmark's windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                t = templates(part.column("text"))
                sizes = np.diff(t.ends)
                rows: list[tuple] = []
                for width in np.unique(np.minimum(sizes, options.width)).tolist():
                    readings = (EXACT,) if width < min(options.least_words, options.width) else (TEMPLATE, EXACT)
                    for reading in readings if width else ():
                        text, place, hashes = windows(t, width, options, reading)
                        own = np.minimum(sizes[text], options.width) == width
                        for k, p, h in zip(text[own].tolist(), place[own].tolist(), hashes[own].view(np.int64).tolist()):
                            rows.append((part.column("item_id")[k].as_py(), part.column("item_no")[k].as_py(),
                                         p - int(t.ends[k]), reading == EXACT, width, h, _slots(t, p, width)))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("item_id", "item_no", "at", "exact", "width", "hash", "slots"), r)) for r in rows],
                    pa.schema([("item_id", pa.int64()), ("item_no", pa.int64()), ("at", pa.int32()), ("exact", pa.bool_()), ("width", pa.int32()),
                               ("hash", pa.int64()), ("slots", pa.list_(pa.string()))]))

    numbered = items.select("item_id", "text").withColumn("item_no", F.monotonically_increasing_id())
    return numbered.mapInArrow(
        cut, "item_id long, item_no long, at int, exact boolean, width int, hash long, slots array<string>")


def _filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of all hashes' low bits: 2^bits bits, however many hashes there are."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(1 << bits - 3, np.uint8)
        for batch in batches:
            low = batch.column("hash").to_numpy().view(np.uint64) & np.uint64((1 << bits) - 1)
            np.bitwise_or.at(bitmap, (low >> np.uint64(3)).astype(np.int64), (1 << (low & np.uint64(7))).astype(np.uint8))
        used = np.flatnonzero(bitmap)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(bitmap[used].astype(np.int32))], names=["place", "byte"])

    # At most one row for each byte of the bitmap.
    filled = hashes.select("hash").mapInArrow(fill, "place long, byte int").groupBy("place").agg(
        F.expr("bit_or(byte)").alias("byte")).toArrow()
    bitmap = np.zeros(1 << bits - 3, np.uint8)
    bitmap[filled.column("place").to_numpy()] = filled.column("byte").to_numpy()
    return bitmap


def document_windows(docs: DataFrame, bitmap: np.ndarray, widths: list[int], options: TemplateOptions) -> DataFrame:
    """doc_id, key of the text, place, hash and slots of the documents' windows that pass the filter."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bitmap)
    bits = options.filter_bits

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                t = templates(part.column("text"))
                for width, reading in ((w, r) for w in widths for r in (TEMPLATE, OPENED, EXACT)):
                    text, place, hashes = windows(t, width, options, reading)
                    low = hashes & np.uint64((1 << bits) - 1)
                    hit = (known[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    text, place, hashes = text[hit], place[hit], hashes[hit]
                    # Equal words need no slots of their own.
                    slots = [None if reading == EXACT else _slots(t, p, width, reading) for p in place.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(text)), part.column("key").take(pa.array(text)),
                         pa.array((place - t.ends[text]).astype(np.int64)),
                         pa.array(hashes.view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
                        names=["doc_id", "key", "place", "hash", "slots"])

    return docs.select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(
        cut, "doc_id long, key long, place long, hash long, slots array<string>")


@dataclass
class Alignment:
    """Item places that a document's windows cover, and what each of the item's values stands for."""

    places: set[int]
    values: dict[str, str]
    consistent: bool = True

    def add(self, places: set[int], values: dict[str, str]) -> None:
        self.places |= places
        for item, doc in values.items():
            self.consistent &= self.values.setdefault(item, doc) == doc

    def agrees(self, other: Alignment) -> bool:
        few, many = sorted((self.values, other.values), key=len)
        return other.consistent and all(many.get(item, doc) == doc for item, doc in few.items())

    def exact(self) -> bool:
        return all(item == doc for item, doc in self.values.items())


def best_alignment(hits: list[dict], n_windows: int, options: TemplateOptions) -> tuple[int, bool]:
    """Most item places of a consistent alignment, and whether it holds the item's own values."""
    by_offset: dict[int, Alignment] = {}
    pooled = Alignment(set(), {})
    for hit in hits:
        values = Alignment(set(), {})
        for slot in hit["slots"]:
            values.add(set(), {slot["item"]: slot["doc"]})
        own = by_offset.setdefault(hit["place"] - hit["at"], Alignment(set(), {}))
        own.consistent &= values.consistent
        own.add({hit["at"]}, values.values)
        pooled.consistent &= own.consistent
        pooled.add({hit["at"]}, values.values)
    if pooled.consistent:
        return len(pooled.places), pooled.exact()
    verbatim = Alignment(set(), {})
    for own in by_offset.values():
        if own.consistent and own.exact():
            verbatim.add(own.places, own.values)
    best = (len(verbatim.places), True)
    for offset, own in by_offset.items():
        if not own.consistent:
            continue
        whole = Alignment(set(own.places), dict(own.values))
        for distance in range(1, options.shift + 1):
            for near in (by_offset.get(offset - distance), by_offset.get(offset + distance)):
                if near and not near.places <= whole.places and whole.agrees(near):
                    whole.add(near.places, near.values)
        best = max(best, (len(whole.places), whole.exact()))
        if best == (n_windows, True):
            break
    return best


def judge_item(hits: list[dict], template_places: set[int], n_exact: int,
               options: TemplateOptions) -> tuple[int, int, bool]:
    """Matched windows, windows and exactness: of the item's templates or, if too few match, of its words."""
    n = len(template_places)
    matched, exact = best_alignment([hit for hit in hits if hit["at"] in template_places], n, options)
    if n and matched >= options.coverage * n:
        return matched, n, exact
    # Equal words don't count where the templates around them hold other values.
    values: dict[tuple[int, str], str] = {}
    split = {hit["place"] - hit["at"] for hit in hits for slot in hit["slots"]
             if values.setdefault((hit["place"] - hit["at"], slot["item"]), slot["doc"]) != slot["doc"]}
    words = [hit for hit in hits if hit["exact"] and hit["place"] - hit["at"] not in split]
    matched, exact = best_alignment(words, n_exact, options)
    return matched, n_exact, exact


def leaked_items(docs: DataFrame, items: DataFrame, options: TemplateOptions = TemplateOptions()) -> DataFrame:
    """Rows of ``contaminated`` with ``text_key``, which is null for documents with a ``doc_id``."""
    ship_package(docs.sparkSession)
    cut = materialize(item_windows(items, options), "item-windows")
    sizes = cut.groupBy("item_no").agg(F.count_if(~F.col("exact")).alias("n_template"), F.count_if("exact").alias("n_exact"),
                                       F.collect_set(F.when(~F.col("exact"), F.col("at"))).alias("template_places"))
    widths = sorted(r[0] for r in cut.select("width").distinct().collect())  # at most options.width numbers
    found = document_windows(docs, _filter(cut, options.filter_bits), widths, options)
    items_ = cut.select("item_id", "item_no", "at", "hash", "exact", F.col("slots").alias("item_slots"))
    joined = found.join(items_, "hash").filter(F.col("exact") == F.col("slots").isNull()).withColumn(
        "slots", F.coalesce("slots", "item_slots")).filter(F.size("slots") == F.size("item_slots"))
    pairs = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))  # (item, doc)
    hits = joined.select("doc_id", "key", "item_id", "item_no", F.struct("at", "place", "exact", pairs.alias("slots")).alias("hit"))
    # A text's windows that match one item: as many as the text is long.
    marked = hits.groupBy("doc_id", "key", "item_id", "item_no").agg(F.collect_set("hit").alias("hits")).join(sizes, "item_no")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [judge_item(batch.column("hits")[k].as_py(), set(batch.column("template_places")[k].as_py()), n, options)
                      for k, n in enumerate(batch.column("n_exact").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "key", "item_id", "item_no")), *(
                    pa.array([j[k] for j in judged], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.bool_())))],
                names=["doc_id", "key", "item_id", "item_no", "n_matched", "n_windows", "exact"])

    judged = marked.select("doc_id", "key", "item_id", "item_no", "template_places", "n_exact", "hits").mapInArrow(
        judge, "doc_id long, key long, item_id long, item_no long, n_matched long, n_windows long, exact boolean")
    best = (judged.filter((F.col("n_windows") > 0) & (F.col("n_matched") >= options.coverage * F.col("n_windows")))
            .withColumn("text_key", _text_key(F.col("key"))).groupBy("doc_id", "text_key", "item_id", "item_no")
            .agg(F.max(F.struct("n_matched", "n_windows", "exact")).alias("best")))
    return best.select("doc_id", "text_key", "item_id", "best.n_matched", "best.n_windows",
                       (F.col("best.n_matched") / F.col("best.n_windows")).alias("coverage"), "best.exact")


def _text_key(key: Column) -> Column:
    """Texts without a ``doc_id`` are told apart by their hash."""
    return F.when(F.col("doc_id").isNull(), key)


def contaminated(docs: DataFrame, items: DataFrame, options: TemplateOptions = TemplateOptions()) -> DataFrame:
    """doc_id, item_id, n_matched, n_windows, coverage and exact for each leaked item.

    ``exact`` tells whether all slots hold the item's own values. Texts without a ``doc_id`` have a row each.
    """
    return leaked_items(docs, items, options).drop("text_key")


def drop_contaminated(docs: DataFrame, items: DataFrame, options: TemplateOptions = TemplateOptions()) -> DataFrame:
    """Documents without a leaked item, with the columns of ``documents``."""
    leaked = materialize(leaked_items(docs, items, options).select(
        F.col("doc_id").alias("leaked_id"), F.col("text_key").alias("leaked_key")).distinct(), "leaked")
    same = F.col("doc_id").eqNullSafe(F.col("leaked_id")) & _text_key(F.xxhash64("text")).eqNullSafe(F.col("leaked_key"))
    return docs.select("doc_id", "text", "lang", "source", "n_chars").join(leaked, same, "left_anti")
