"""Language identification (operator 12) by rank-order profiles.

A profile lists the most frequent character n-grams of a language in order. A text's own most frequent
n-grams are ranked the same way, and its distance to a language is the sum of how far each n-gram is out of
place in that profile; one that the profile lacks is out by the profile's length. The nearest language
is predicted.

Profiles count the n-grams of all training rows: words are counted per language first, with map-side
combine, and taken apart once each. N-grams are those of runs of letters (with their combining marks),
lower-cased character by character, with a blank at both ends, and are known by a 64-bit hash.

Special cases: null texts and texts without a letter are ``und`` with score 0, and so is every text if
nothing was learned; rows without a language or without ``doc_id`` are not learned from, but predicted;
repeated rows count as often as they occur; equal frequencies are ordered by hash; at equal distance the
language with more n-grams in training, then the first by name, is predicted. Other columns are ignored.
Profiles (``profile`` n-grams for each language) are sent to all tasks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import mix64, ship_package, slices, split_words
from wardlens.session import materialize

UNKNOWN = "und"
#: (text, n-gram) entries held at a time.
ENTRIES = 4 << 20
_FIELD = 24  # bits of a count or an n-gram's number in a packed entry
_TEXTS = 1 << 12


@dataclass(frozen=True)
class ProfileOptions:
    longest: int = 5        # n-grams have 1 to so many characters
    profile: int = 1000     # n-grams of a language's profile
    document: int = 1000    # ranked n-grams of a text, at most


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]   # in order of preference at equal distance
    grams: np.ndarray            # sorted hashes of all profiles' n-grams
    ranks: np.ndarray            # (n-grams, languages); profile + document where a profile lacks one
    options: ProfileOptions


# ---- n-grams ----------------------------------------------------------------------------------

_CODES = 0x110000  # of characters


def letter_grams(words: pa.Array, longest: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each length up to ``longest``, (word, n-gram hash) of all n-grams of the words' runs of letters in
    order of words; whether each word has a letter."""
    chars = np.frombuffer((" " + " ".join(pc.utf8_lower(words).to_pylist()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    number = np.cumsum(chars == 32) - 1  # a blank counts for the word after it
    seen = np.zeros(_CODES, bool)
    seen[chars] = True
    kinds, letters, marks = np.flatnonzero(seen), np.zeros(_CODES, bool), np.zeros(_CODES, bool)
    category = [unicodedata.category(chr(c))[0] for c in kinds.tolist()]
    letters[kinds], marks[kinds] = [c == "L" for c in category], [c == "M" for c in category]
    letter = letters[chars]
    inside = letter | marks[chars]
    has_letter = np.bincount(number[letter], minlength=len(words))[:len(words)] > 0
    chars = np.where(inside, chars, 32).astype(np.uint64)
    outside = np.concatenate([[0], np.cumsum(~inside)])
    found, rolling = [], np.zeros(len(chars), np.uint64)
    for n in range(1, longest + 1):
        count = len(chars) - n + 1
        if count <= 0:
            break
        rolling = mix64(rolling[:count] * np.uint64(0x9E3779B97F4A7C15) + chars[n - 1:])
        # Blanks may only stand at either end, and never alone.
        if n < 3:
            whole = outside[n:n + count] - outside[:count] < n
        else:
            whole = outside[n - 1:n - 1 + count] == outside[1:1 + count]
        found.append((number[:count][whole], rolling[whole]))
    return found, has_letter


class WordGrams:
    """N-grams of distinct words: word k has the numbers ``grams[starts[k]:starts[k] + sizes[k]]``.

    Numbers point into ``names``, the distinct hashes in order.
    """

    def __init__(self, words: pa.Array, longest: int) -> None:
        found, self.has_letter = letter_grams(words, longest)
        counts = [np.bincount(owner, minlength=len(words))[:len(words)] for owner, _ in found]
        self.sizes = sum(counts, np.zeros(len(words), np.int64))
        self.starts = np.cumsum(self.sizes) - self.sizes
        coded = pa.array(np.concatenate([h for _, h in found]) if found else np.empty(0, np.uint64)).dictionary_encode()
        names = coded.dictionary.to_numpy()
        order = np.argsort(names)
        self.names, place = names[order], np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        number, at, free = place[coded.indices.to_numpy()], 0, self.starts.copy()
        self.grams = np.empty(len(number), np.int64)
        for (owner, _), count in zip(found, counts):  # owners rise, so each word's n-grams of a length stand together
            self.grams[np.arange(len(owner)) + np.repeat(free - (np.cumsum(count) - count), count)] = number[at:at + len(owner)]
            at, free = at + len(owner), free + count

    def of(self, codes: np.ndarray) -> np.ndarray:
        """N-grams of all words ``codes``, word by word."""
        n = self.sizes[codes]
        return self.grams[np.repeat(self.starts[codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _merged(text: np.ndarray, gram: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of equal (text, gram), ordered by text, falling sum, gram."""
    fits = len(text) and int(count.sum()) < 1 << _FIELD and int(gram.max()) < 1 << _FIELD and int(text.max()) < _TEXTS
    if fits:  # one sort of packed integers
        packed = np.sort((text << 2 * _FIELD) | (gram << _FIELD) | count)
        key, count = packed >> _FIELD, packed & ((1 << _FIELD) - 1)
    else:
        order = np.lexsort((gram, text))
        text, gram, count = text[order], gram[order], count[order]
        key = np.cumsum(np.concatenate([[0], (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])])) if len(text) else text
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    total = np.add.reduceat(count, first) if len(first) else count
    if fits:
        text, gram = key[first] >> _FIELD, key[first] & ((1 << _FIELD) - 1)
        top = (1 << _FIELD) - 1
        packed = np.sort((text << 2 * _FIELD) | ((top - total) << _FIELD) | gram)
        return packed >> 2 * _FIELD, packed & top, top - ((packed >> _FIELD) & top)
    text, gram = text[first], gram[first]
    order = np.lexsort((gram, -total, text))
    return text[order], gram[order], total[order]


def ranked_grams(codes: np.ndarray, ends: np.ndarray, apart: WordGrams,
                 most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, n-gram's number, rank from 0) of the ``most`` most frequent n-grams of texts, some texts at a time.

    Text k has the words ``codes[ends[k]:ends[k + 1]]``.
    """
    words, sizes = max(1, len(apart.sizes)), apart.sizes
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    pair, times = np.unique(text * words + codes, return_counts=True)
    text, code = pair // words, pair % words
    live = sizes[code] > 0
    text, code, times = text[live], code[live], times[live]
    entries = np.concatenate([[0], np.cumsum(sizes[code])])
    start = 0
    while start < len(text):
        end = int(np.searchsorted(entries, entries[start] + ENTRIES, "right")) - 1
        end = min(end, int(np.searchsorted(text, text[start] + _TEXTS)))
        if end < len(text):
            end = int(np.searchsorted(text, text[end]))  # whole texts
        if end <= start:  # a text beyond the limit: its n-grams are summed part by part
            end = int(np.searchsorted(text, text[start], "right"))
            total, at = np.zeros(len(apart.names), np.int64), start
            while at < end:
                to = max(at + 1, min(end, int(np.searchsorted(entries, entries[at] + ENTRIES, "right")) - 1))
                times_each = np.repeat(times[at:to], sizes[code[at:to]])
                total += np.bincount(apart.of(code[at:to]), times_each, len(total)).astype(np.int64)
                at = to
            found = np.flatnonzero(total)
            found = found[np.argsort(-total[found], kind="stable")][:most]
            yield np.full(len(found), text[start]), found, np.arange(len(found))
        else:
            own, n = code[start:end], sizes[code[start:end]]
            t, g, _ = _merged(np.repeat(text[start:end] - text[start], n), apart.of(own), np.repeat(times[start:end], n))
            held = np.bincount(t)
            rank = np.arange(len(t)) - np.repeat(np.cumsum(held) - held, held)
            kept = rank < most
            yield t[kept] + text[start], g[kept], rank[kept]
        start = end


# ---- training ---------------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def language_grams(docs: DataFrame, options: ProfileOptions = ProfileOptions()) -> DataFrame:
    """(lang, gram, n) over all rows of ``docs`` (lang, text) with a language."""
    ship_package(docs.sparkSession)
    given = docs.filter(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                codes, ends, words = split_words(part.column("text"))
                lang = part.column("lang").dictionary_encode()
                own = np.repeat(lang.indices.to_numpy().astype(np.int64), np.diff(ends))
                pair, n = np.unique(own * max(1, len(words)) + codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(pair // max(1, len(words)))), words.take(pa.array(pair % max(1, len(words)))),
                     pa.array(n)], names=["lang", "word", "n"])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word", size=1 << 20):
                apart, lang = WordGrams(part.column("word"), options.longest), part.column("lang").dictionary_encode()
                names, own = apart.names, np.repeat(lang.indices.to_numpy().astype(np.int64), apart.sizes)
                pair, place = np.unique(own * max(1, len(names)) + apart.grams, return_inverse=True)
                total = np.bincount(place, np.repeat(part.column("n").to_numpy(), apart.sizes), len(pair)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(pair // max(1, len(names)))),
                     pa.array(names[pair % max(1, len(names))].view(np.int64)), pa.array(total)], names=["lang", "gram", "n"])

    words = given.mapInArrow(count_words, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams = words.mapInArrow(count_grams, "lang string, gram long, n long")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_profiles(docs: DataFrame, options: ProfileOptions = ProfileOptions()) -> Profiles:
    """Profiles of all languages of ``docs`` (lang, text), all rows counted."""
    counted = materialize(language_grams(docs, options), "language-grams")
    # Hashes are unsigned where texts are ranked, so their order is that of the bits, sign last.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), (F.col("gram") < 0), "gram")
    best = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= options.profile)
    totals = {r.lang: r.n for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    rows = best.select("lang", "gram", "rank").toArrow()  # ``profile`` rows for each language
    languages = tuple(sorted(totals, key=lambda name: (-totals[name], name)))
    grams, place = np.unique(rows.column("gram").to_numpy().view(np.uint64), return_inverse=True)
    # An n-gram that a profile lacks stands so far behind that it is always out by the profile's length.
    ranks = np.full((len(grams), len(languages)), options.profile + options.document, np.int64)
    number = {name: k for k, name in enumerate(languages)}
    ranks[place, [number[name] for name in rows.column("lang").to_pylist()]] = rows.column("rank").to_numpy() - 1
    return Profiles(languages, grams, ranks, options)


# ---- prediction -------------------------------------------------------------------------------

def predict_languages(texts: pa.Array, profiles: Profiles) -> tuple[list[str], np.ndarray]:
    """Nearest language of each text, and 1 - distance as a share of the largest one possible."""
    most, count = profiles.options.profile, len(profiles.languages)
    codes, ends, words = split_words(texts)
    apart = WordGrams(words, profiles.options.longest)
    distance, seen = np.zeros((len(texts), count)), np.zeros(len(texts), np.int64)
    place = np.searchsorted(profiles.grams, apart.names)
    place[place == len(profiles.grams)] = 0
    listed = profiles.grams[place] == apart.names if len(profiles.grams) else np.zeros(len(place), bool)
    for text, gram, rank in ranked_grams(codes, ends, apart, profiles.options.document):
        known = listed[gram]
        all_, own = np.bincount(text, minlength=len(texts)), np.bincount(text[known], minlength=len(texts))
        seen += all_
        text, at, rank = text[known], place[gram[known]], rank[known]
        for k in range(count):
            # A text can have more ranks than a profile: nothing is further out than its length.
            out = np.minimum(np.abs(profiles.ranks[at, k] - rank), most)
            distance[:, k] += (all_ - own) * float(most) + np.bincount(text, out, len(texts))
    spoken = np.concatenate([[0], np.cumsum(apart.has_letter[codes])])
    told = (spoken[ends[1:]] > spoken[ends[:-1]]) & (count > 0)
    if not count:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    share = distance / np.maximum(seen * most, 1)[:, None]
    best = share.argmin(axis=1)
    score = np.where(told, 1 - share[np.arange(len(texts)), best], 0.0)
    return [profiles.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), told.tolist())], score


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``, over its whole text."""
    ship_package(docs.sparkSession)
    given = docs.select("doc_id", "text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                names, score = predict_languages(part.column("text"), profiles)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])

    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def classify_languages(docs: DataFrame, options: ProfileOptions = ProfileOptions()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; held-out rows are not learned from."""
    profiles = fit_profiles(docs.filter(~held_out(F.col("doc_id"))), options)
    return identify(docs, profiles).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
