"""Ranked search, language profiles and whitening against brute force, with odd rows and tables."""

import collections
import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import zlib

from wardlens.llm import language, lexical, whitening
from wardlens.llm.common import mix64, split_words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Clashing names on purpose: operators use such columns inside.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, block long, term string, word string, "
        "gram int, rank string, key string")
TAIL = ("src", 1, 7, "t", "w", 3, "r", "k")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, *TAIL) for i, t, lang in rows], DOCS)


# ---- op 11 ----

def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(rows, items, top=50):
    docs = [(i, collections.Counter(terms(t))) for i, t in rows if terms(t)]
    count, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(w for _, c in docs for w in c)
    found = collections.Counter()
    for item, text in {x for x in items if x[1] is not None}:
        scored = []
        for doc_id, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * count) // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1)))
                        * ((10**9 * c[w]) // (1000 * c[w] + 20 * m)) for w in set(terms(text)) if c[w])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:top], 1):
            found[(item, rank, doc_id, -score)] += 1
    return found


@pytest.fixture(scope="module")
def searched():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(300)]
    weight = 1 / np.arange(1, 301)
    weight /= weight.sum()
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=weight))
    rows = [(k, text(int(rng.integers(1, 60)))) for k in range(400)]
    rows += [(1000 + k, "w0, W1;w2 the same") for k in range(120)]            # equal scores
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, rows[7][1]), (None, text(9)), (2000, None), (2001, ""),
             (2002, " .,!\n"), (2003, "Ünï cödé w3 ÄÖ K"), (2004, "w0 " * 30000), (2005, "w7" * 40000)]
    items = [(k, text(int(rng.integers(1, 25)))) for k in range(30)]
    items += [(3, items[3][1]), (4, "w9 w10 w200"), (40, None), (41, ""), (42, "?!"), (43, "missing words"),
              (None, "w1 w250"), (44, "ünï cödé Ünï cödé"), (45, " ".join(vocabulary))]
    return rows, items


SMALL = lexical.SearchOptions(block_docs=60, block_postings=500, short_least=5, short_share=0.05, window=3, query_bytes=900)


@pytest.mark.parametrize("options", [lexical.SearchOptions(), SMALL])
def test_search_equals_full_evaluation(spark, searched, options):
    rows, items = searched
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")
    found = lexical.ranked_search(documents(spark, [(i, t, "en") for i, t in rows]).repartition(3), asked, options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, found.collect())) == brute_search(rows, items)


def test_search_of_empty_tables(spark):
    some = documents(spark, [(1, "a b", "en")])
    none, items = documents(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked_search(none, items).count() == 0
    assert lexical.ranked_search(some, items.filter("false")).count() == 0
    assert [tuple(r)[:3] for r in lexical.ranked_search(some, items).collect()] == [(1, 1, 1)]


def test_best_of_block_skips_without_loss():
    rng, options = np.random.default_rng(1), lexical.SearchOptions(top=5, short_least=20, short_share=0.01, window=8)
    for _ in range(60):
        lists, total = [], np.zeros(900, np.int64)
        for n in rng.integers(1, 500, int(rng.integers(1, 9))).tolist():
            docs = np.sort(rng.choice(900, n, replace=False))
            scores = rng.integers(1, 40 if n > 100 else 300, n)
            total[docs] += scores
            lists.append(lexical._List(docs, scores, int(scores.max())))
        docs, scores = lexical.best_of_block(lists, 900, options)
        order = np.lexsort((np.arange(900), -total))[:5]
        order = order[total[order] > 0]
        assert docs.tolist() == order.tolist() and scores.tolist() == total[order].tolist()


def test_lookups_leave_long_lists_unread(monkeypatch):
    """With heavy rare terms, a long list is only looked up for their documents."""
    long = lexical._List(np.arange(100_000), np.ones(100_000, np.int64), 1)
    rare = lexical._List(np.arange(0, 100_000, 1000), np.full(100, 50, np.int64), 50)
    docs, scores = lexical.best_of_block([long, rare], 100_000, lexical.SearchOptions(short_share=0.01))
    assert long.at == 0 and docs.tolist() == list(range(0, 50_000, 1000)) and set(scores.tolist()) == {51}


def test_length_factors_beyond_64_bits():
    sizes = np.array([1, 10**7, 10**7, 3])
    documents_, words = 10**12, 10**15
    assert lexical.length_factors(sizes, documents_, words).tolist() == [50 + 50 * n * documents_ // words for n in sizes.tolist()]


# ---- op 12 ----

def gram_hash(gram):
    h = np.zeros(1, np.uint64)
    for c in gram:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(ord(c)))
    return int(h[0])


def grams_of(text, longest):
    counts = collections.Counter()
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        clean = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in "".join(c.lower()[0] for c in word))
        for piece in clean.split(" "):
            if piece:
                padded = f" {piece} "
                counts.update(g for n in range(1, longest + 1) for k in range(len(padded) - n + 1)
                              if (g := padded[k:k + n]).strip(" "))
    return counts


def ranking(counts, most):
    order = sorted(counts, key=lambda g: (-counts[g], gram_hash(g)))
    return {g: k for k, g in enumerate(order[:most])}


def brute_languages(rows, options):
    learned = collections.defaultdict(collections.Counter)
    for doc_id, text, lang in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 != 1 and lang is not None:
            learned[lang] += grams_of(text, options.longest)
    profiles = {lang: ranking(c, options.profile) for lang, c in learned.items() if c}
    prefer = sorted(profiles, key=lambda lang: (-sum(learned[lang].values()), lang))
    out = collections.Counter()
    for doc_id, text, _ in rows:
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
        own = ranking(grams_of(text, options.longest), options.document)
        if not prefer or not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            out[(doc_id, held, "und", 0.0)] += 1
            continue
        far = {lang: sum(min(abs(p[g] - r), options.profile) if g in p else options.profile for g, r in own.items())
               for lang, p in profiles.items()}
        best = min(prefer, key=lambda lang: (far[lang], prefer.index(lang)))
        out[(doc_id, held, best, round(1 - far[best] / (len(own) * options.profile), 9))] += 1
    return out


@pytest.fixture(scope="module")
def spoken():
    rng = np.random.default_rng(8)
    stems = {"xa": "lo ma rin tesk ano pel", "yb": "zu krat ómi dže fop ñil", "zc": "да не шо прив ёлк мир"}
    rows = []
    for k in range(150):
        lang = sorted(stems)[k % 3]
        parts = stems[lang].split()
        text = " ".join("".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(1, 40))))
        rows.append((k, text.capitalize() + ("." if k % 2 else "!?"), lang if k % 11 else None))
    long = " ".join(rows[1][1] for _ in range(300))
    return rows + [(200, None, "xa"), (201, "", "xa"), (202, "123 ... 45", "yb"), (203, " \n\t ", "zc"), (204, long, "yb"),
                   (205, "Ma" * 30000, "xa"), (7, *rows[7][1:]), (7, *rows[7][1:]), (None, rows[3][1], "xa"),
                   (206, "don't e-maiĺ K İ", "xa"), (207, "́̂", "yb"), (208, "qqqqq", None)]


@pytest.mark.parametrize("options", [language.ProfileOptions(), language.ProfileOptions(3, 40, 25), language.ProfileOptions(4, 30, 90)])
def test_languages_equal_brute_force(spark, spoken, options, monkeypatch):
    monkeypatch.setattr(language, "ENTRIES", 5000)
    found = language.classify_languages(documents(spark, spoken), options)
    rows = collections.Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in found.collect())
    assert rows == brute_languages(spoken, options)


def test_languages_of_held_out_texts(spark, spoken):
    found = language.classify_languages(documents(spark, spoken[:150])).filter("held_out").collect()
    truth = {i: lang for i, _, lang in spoken if lang}
    asked = [(r.lang_pred, truth[r.doc_id]) for r in found if r.doc_id in truth]
    assert len(asked) > 30 and sum(a == b for a, b in asked) >= 0.95 * len(asked)


def test_languages_without_training_or_rows(spark, spoken):
    unlabelled = documents(spark, [(i, t, None) for i, t, _ in spoken])
    assert {(r.lang_pred, r.score) for r in language.classify_languages(unlabelled).collect()} == {("und", 0.0)}
    assert language.classify_languages(documents(spark, [])).count() == 0


def test_texts_in_parts_rank_like_whole_ones(monkeypatch):
    texts = pa.array(["ab cd ab ef " * 50, "xyz", None, "ab " * 9 + "cd ef gh ij kl mn op"])
    codes, ends, words = split_words(texts)
    apart = language.WordGrams(words, 5)
    read = lambda: [np.concatenate(x).tolist() for x in zip(*language.ranked_grams(codes, ends, apart, 1000))]
    whole = read()
    for entries in (1, 7, 60):
        monkeypatch.setattr(language, "ENTRIES", entries)
        assert read() == whole


# ---- op 13 ----

VECTORS = "vec_id long, embedding array<float>, label int, key string, x string, copies string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "k", "x", "c", "n") for i, v in rows], VECTORS)


def brute_whitening(rows, weights="one", scale=256):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dimension = max((len(v) for _, v in good), default=0)
    x = np.array([[math.floor(scale * float(np.float32(c))) for c in v] + [0] * (dimension - len(v)) for _, v in good], np.int64)
    fit, counts = np.unique(x, axis=0, return_counts=True)
    w = counts if weights == "count" else np.ones(len(fit), np.int64)
    n, sums = int(w.sum()), (fit * w[:, None]).sum(axis=0)
    d = fit - sums / n
    values, axes = np.linalg.eigh((d * w[:, None]).T @ d / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    return good, n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ axes / np.sqrt(values), values / np.trace(np.cov(fit.T, bias=True, fweights=w))


@pytest.fixture(scope="module")
def embedded():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 6)) * np.array([3, 2, 1.5, 1, 0.5, 0.2])
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(500 + k, base[3].tolist()) for k in range(150)]                   # a third of all rows
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6),
             (904, [-0.0] * 6), (905, [0.001, -0.001, 0.0, 0.0, 0.0, 0.0]), (None, base[4].tolist()), (7, base[8].tolist()),
             (906, []), (907, [1.5, 2.0]), (908, [300.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    return rows


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_brute_force(spark, embedded, weights):
    good, n, deviation, whitened, explained = brute_whitening(embedded, weights)
    found = whitening.whiten_vectors(vectors(spark, embedded), whitening.WhiteningOptions(weights=weights, heavy=20)).collect()
    assert len(found) == len(good)
    key = lambda i, d: (i is None, i or 0, d)
    found.sort(key=lambda r: key(r.vec_id, r.deviation))
    order = sorted(range(len(good)), key=lambda k: key(good[k][0], int(deviation[k])))
    assert [(r.vec_id, r.n, r.deviation) for r in found] == [(good[k][0], n, int(deviation[k])) for k in order]
    got, expected = np.array([r.whitened for r in found]), whitened[order]
    signs = np.sign((got * expected).sum(axis=0))
    assert np.allclose(got, expected * signs, atol=1e-9)
    assert np.allclose(found[0].explained, explained) and all(r.identity_error < 1e-9 for r in found)
    assert len({tuple(r.explained) for r in found}) == 1


def test_components_are_numbered_rows(spark, embedded):
    found = whitening.whitened_components(vectors(spark, embedded))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [t for _, t in found.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    counts = {r.component: r["count"] for r in found.groupBy("component").count().collect()}
    assert set(counts) == {1, 2, 3, 4} and set(counts.values()) == {len(embedded) - 4}


def test_whitening_of_flat_tiny_and_huge_vectors(spark):
    flat = whitening.whitened_components(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 2.0])])).collect()
    assert {(r.vec_id, r.component, r.n, r.explained) for r in flat} == {
        (k, c, 2, 1.0 if c == 1 else 0.0) for k in (1, 2, 3) for c in (1, 2)}
    assert {round(abs(r.whitened), 9) for r in flat if r.component == 1} == {1.0}
    assert {r.whitened for r in flat if r.component == 2} == {None}
    one = whitening.whitened_components(vectors(spark, [(1, [0.5, 0.5])])).collect()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(0, None, 0.0, None)}
    huge = whitening.whiten_vectors(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 1.0])])).collect()
    assert {r.vec_id: r.deviation for r in huge} == {1: None, 2: None, 3: sum(v * v for v in (1, 512))}
    assert whitening.whitened_components(vectors(spark, [])).count() == 0
    assert whitening.whitened_components(vectors(spark, [(1, None), (2, [])])).count() == 0
