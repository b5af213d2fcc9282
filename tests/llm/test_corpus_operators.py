"""Corpus operators against brute force, with nulls, empty and repeated rows, and clashing columns."""

import collections
import html
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from wardlens.llm import (cotraining, decontaminate, html_text, itq_join, jaccard_join, licenses, linkgraph,
                          mixing, token_files, toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Clashing names on purpose: operators use such columns inside.
DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("size", T.StringType()), ("class", T.StringType()), ("hash", T.StringType()))])
BASE = " ".join(f"word{k}" for k in range(60))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", "z") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(1, 120)))), f"s{k % 4}" if k % 5 else None) for k in range(160)]
    for k in range(40):  # near copies of one text, a few words changed
        words = BASE.split()
        for p in rng.choice(60, int(rng.integers(0, 3)), replace=False):
            words[p] = f"new{k}x{p}"
        rows.append((200 + k, " ".join(words), "hot"))
    rows += [(300, None, "s1"), (301, "", None), (302, " \t\n", "s2"), (303, "One", "s1"), (304, "one", "s1"),
             (305, BASE.upper(), "hot"), (306, "long " * 5000, "s3"), (5, rows[5][1], rows[5][2]), (None, "no id here", "s1")]
    return rows


# ---- op 1 ----

def test_rans_blocks_round_trip_and_tell_damage():
    rng = np.random.default_rng(0)
    ids = rng.zipf(1.4, 9000) % 500
    coder = token_files.Coder(token_files.scaled_frequencies(np.bincount(ids)))
    for n in (1, 2, 63, 64, 65, 9000):
        payload = coder.encode(ids[:n], 64, 16)
        assert (coder.decode(payload) == ids[:n]).all()
    points = -(-9000 // (64 * 16))
    assert (np.concatenate([coder.decode(payload, k, 1) for k in range(points)]) == ids).all()
    broken = bytearray(payload)
    broken[-1] ^= 1
    with pytest.raises(ValueError):
        coder.decode(bytes(broken))


def test_token_files_equal_the_tokenizer(spark, corpus, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    extra = [(400, "Don't <|endoftext|>x　y ΑΣ é 12 \x1c\x85z", "s1"), (401, "'S  foo\r\nbar", "s1")]
    rows = corpus + extra
    options = token_files.TokenOptions(path, block_tokens=2000, lanes=16, checkpoint_steps=8)
    found = token_files.tokenize_to_files(documents(spark, rows), options, str(tmp_path / "out")).collect()
    tokenizer, start, expected = Tokenizer.from_file(path), 0, collections.Counter()
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected[(doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        start += len(ids)
    assert collections.Counter(map(tuple, found)) == expected
    empty = token_files.tokenize_to_files(documents(spark, []), options, str(tmp_path / "empty"))
    assert empty.count() == 0


@pytest.mark.parametrize("most", [1, 40, 10_000])
def test_forgotten_words_change_no_ids(monkeypatch, most):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "CACHE_WORDS", most)
    monkeypatch.setattr(token_files, "_WORDS", {})
    path, rng = public_tokenizers.path("word_bpe_49k.json"), np.random.default_rng(4)
    tokenizer = Tokenizer.from_file(path)
    for _ in range(30):
        texts = [" ".join(f"w{k}x" for k in rng.zipf(1.5, 30) % 300) for _ in range(4)] + [None, ""]
        ids, sizes = token_files.encode_texts(pa.array(texts), path, 2)
        expected = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
        assert ids.tolist() == sum(expected, []) and sizes.tolist() == list(map(len, expected))


def test_shared_words_change_no_ids(spark, corpus, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "_WORDS", {})
    monkeypatch.setattr(token_files, "SHARED_WORDS", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    raw = token_files.shared_words(documents(spark, corpus).repartition(4), token_files.TokenOptions(path))
    shared = pa.ipc.open_stream(raw).read_all()
    words = shared.column("word").to_pylist()
    assert len(set(words)) == len(words) == 50
    for word, ids in zip(words, shared.column("ids").to_pylist()):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(word, add_special_tokens=False).ids
    token_files._known(path, 2).share("test", raw)
    texts = [text for _, text, _ in corpus] + ["a <|endoftext|> b x<|endoftext|>y"]
    ids, sizes = token_files.encode_texts(pa.array(texts), path, 2)
    expected = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert ids.tolist() == sum(expected, []) and sizes.tolist() == list(map(len, expected))
    batches = [pa.record_batch({"text": pa.array([t], pa.string())}) for t in ("a", "bb" * 50, None, "c")]
    assert [b.num_rows for b in token_files.gathered(iter(batches), "text", 100)] == [2, 2]


def test_letters_and_punctuation_are_encoded_apart(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "_WORDS", {})
    path, rng = public_tokenizers.path("word_bpe_49k.json"), np.random.default_rng(5)
    ids, _ = token_files.encode_texts(pa.array(["The the the, The, THE! the!"]), path, 2)
    assert sorted(token_files._known(path, 2).names.to_pylist()) == ["!", ",", "the"]
    tokenizer = Tokenizer.from_file(path)
    # Marks that join letters, letters beyond the plain ones, contractions, digits, a special token.
    letters = list("abcABC\u00e9\u00c9\u00df\u00ff\u00c0''.,!?-<|>\u0327\u0301\u0130\u0131\u017f\u212aK1\u0968\u00aa\u00ba\u00d7\u00f7\u00b5\u03a3 \u200d\ufb01   ")
    texts = ["".join(rng.choice(letters, 2000)) for _ in range(40)] + [
        "'S don't x's. rock'n'roll' the<|endoftext|>. abc<| !x x! ! 12, x1. a.b ... \u00ab\u00e9t\u00e9\u00bb", None, ""]
    ids, sizes = token_files.encode_texts(pa.array(texts), path, 2)
    expected = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert ids.tolist() == sum(expected, []) and sizes.tolist() == list(map(len, expected))


def test_shared_words_are_read_without_an_object_each(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tracemalloc

    monkeypatch.setattr(token_files, "_WORDS", {})
    known, count = token_files._known(public_tokenizers.path("word_bpe_49k.json"), 2), 50_000
    table = pa.table({"word": [f"w{k}" for k in range(count)],
                      "ids": pa.array([np.arange(k % 4, dtype="<u4").tobytes() for k in range(count)], pa.binary())})
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        for batch in table.to_batches(max_chunksize=7000):
            stream.write_batch(batch)
    raw = out.getvalue().to_pybytes()
    tracemalloc.start()
    known.share("test", raw)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * count
    assert known.sizes.tolist() == [1] + [k % 4 for k in range(count)]
    assert known.flat.tolist() == [2] + [i for k in range(count) for i in range(k % 4)]


# ---- op 2 ----

def brute_components(rows):
    sets = []
    for doc_id, text, _ in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append((doc_id, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    label = list(range(len(sets)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                label[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return collections.Counter(
        (doc_id, len(x), min(least[find(i)], default=None)) for i, (doc_id, x) in enumerate(sets))


def test_jaccard_sends_on_candidates_only(spark, corpus):
    docs, options = documents(spark, corpus), jaccard_join.JaccardOptions()
    sets = jaccard_join.materialize(jaccard_join.document_sets(docs, options), "test-sets")
    chosen = {r["class"] for r in jaccard_join.candidate_classes(sets, options).collect()}
    names = {r.doc_id: r["class"] for r in sets.collect()}
    texts = {}
    for doc_id, _, component in brute_components(corpus):
        texts.setdefault(component, set()).add(names[doc_id])
    # Every class with a link to another class is a candidate; most classes of unlike texts are none.
    assert all(found <= chosen for found in texts.values() if len(found) > 1)
    assert len([k for k in range(160) if names[k] in chosen]) < 40


def test_jaccard_rows_grow_with_the_input():
    for shingles in (10**7, 10**9, 10**12):
        few, many = jaccard_join.bucket_count(shingles), jaccard_join.bucket_count(5 * shingles)
        assert many ** 2 <= 5.2 * few ** 2  # rows from each bucket to each
    for buckets in (64, 65, 171, 1000):
        starts = jaccard_join._bucket_starts(buckets)
        assert max(np.diff(np.append(starts, np.uint64(1 << jaccard_join.HASH_BITS)))) <= 1 << jaccard_join.LOW_BITS


@pytest.mark.parametrize("options", [jaccard_join.JaccardOptions(), jaccard_join.JaccardOptions(rare=2, combine=2, block=8)])
def test_jaccard_components_equal_brute_force(spark, corpus, options):
    found = jaccard_join.near_duplicates(documents(spark, corpus), options)
    assert collections.Counter(map(tuple, found.collect())) == brute_components(corpus)
    assert jaccard_join.near_duplicates(documents(spark, []), options).count() == 0


def test_one_of_each_group_stays(spark, corpus):
    kept = [r.doc_id for r in jaccard_join.drop_near_duplicates(documents(spark, corpus)).collect()]
    expected = {(i, c) for i, _, c in brute_components(corpus)}
    assert sorted(i for i in kept if i is not None) == sorted(i for i, c in expected if i == c and i is not None)
    assert None in kept


# ---- op 3 ----

def test_mix_meets_targets(spark, corpus):
    options = mixing.MixOptions(block_words=16, shard_slots=8)
    docs = documents(spark, corpus)
    rows = mixing.mix(docs, options).collect()
    assert len(rows) == len(corpus)
    sizes = collections.Counter()
    for _, text, source in corpus:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target, open_, left = {}, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values())
    while True:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w > 2 * sizes[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            del open_[s]
    target |= {s: level * w for s, w in open_.items()}
    by_size = collections.Counter((r.source_size, round(r.target, 6)) for r in rows)
    assert by_size == collections.Counter((sizes[s], round(target[s], 6)) for _, _, s in corpus)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    taken = collections.Counter()
    for r in rows:
        taken[round(r.target, 6)] += r.taken
    for s in order:
        same = [x for x in order if round(target[x], 6) == round(target[s], 6)]
        assert abs(taken[round(target[s], 6)] - sum(target[x] for x in same)) <= len(same)
    again = mixing.mix(docs.repartition(7), options).collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(map(tuple, again))
    words = collections.Counter()
    for r in mixing.mixed_documents(docs, options).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    expected = collections.Counter()
    for r in rows:
        expected[r.doc_id] += r.taken
    assert +words == +expected


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100, 1000):
        df = spark.range(n).selectExpr("id", f"{n}L AS n", "5L AS k")
        assert sorted(r[0] for r in df.select(mixing.permute("id", "n", "k")).collect()) == list(range(n))


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [(1, None, "a"), (2, "", None)])).select("taken").distinct().collect()[0][0] == 0


# ---- op 4 ----

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<b>b</b> c<br>d</p>", "ab c d"),
    ('<nav>menu</nav><article><h1>T &amp; x</h1><p>long enough text here<p>short</article><footer>f</footer>', "T & x\nlong enough text here\nshort"),
    ('<script>var t="</p>";</script><article><p>a b &eacute;</p><div class="comments">no</div></article>', "a b é"),
    ('<body><div class="sidebar">side</div><div id=content><p>some long text of a page, really<p>b<ul><li>c</ul></div>',
     "some long text of a page, really\nb\nc"),
])
def test_main_text(page, text):
    assert html_text.extract_text(page) == text


@pytest.mark.parametrize("tag", ["article", "main"])
def test_ratios_choose_beside_articles(tag):
    real = [f"This is paragraph {k} of the real text, which is long and stands in a plain element." for k in range(6)]
    links = "".join(f'<p><a href="/{k}">x</a> <i>y</i></p>' for k in range(12))
    body = "".join(f"<p>{p}</p>" for p in real)
    teaser = f'<{tag}><p><a href="/"><b>More</b></a> <i>now</i></p></{tag}>'
    assert html_text.extract_text(f"<body>{teaser}<div>{links}</div><div>{body}</div></body>") == "\n".join(real)
    # A poor region is not lifted by the article next to it.
    assert html_text.extract_text(f"<body><{tag}>{body}</{tag}><div>{links}</div></body>") == "\n".join(real)


def test_ids_and_word_parts_drop_no_article_text():
    parts = ['<h2 id="search">Search</h2>', '<section id="related-work"><h2 id="related">Related work</h2><p>Others did it.</p></section>',
             '<p class="share-price">The price rose.</p>', '<div class="side-by-side">Two views.</div>', '<p class="skip-lists">Lists of lists.</p>',
             '<h2 id="legal-status">Legal status</h2>', '<section id="comments-on-method">A word on it.</section>',
             '<pre>x = 1 <span class="comment"># one</span></pre>', "<p>Then <math><mi>a</mi><mo>=</mo><mn>1</mn></math> holds.</p>"]
    text = "Search\nRelated work\nOthers did it.\nThe price rose.\nTwo views.\nLists of lists.\nLegal status\nA word on it.\nx = 1 # one\nThen a=1 holds."
    dropped = '<div class="related">no</div><p class="ad">no</p><ul class="share">no</ul><div role="search">no</div>'
    assert html_text.extract_text(f"<article>{''.join(parts)}{dropped}</article>") == text
    long = "<p>This is a paragraph of the real text, long enough to count as that by its ratio.</p>" * 3
    found = html_text.extract_text(f'<div id=content>{long}<h2 id="related-work">Work</h2>{long}</div><div class="site-nav">no</div>'
                                   '<div id="sidebar">no</div><div class="cookie-consent">no</div>')
    assert "Work" in found.split("\n") and "no" not in found.split("\n")


def test_pages_keep_rows(spark):
    rows = [(1, "u", "<article><p>a</article>"), (1, "u", "<article><p>a</article>"), (2, None, None)]
    found = html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0)], key=str)


# ---- op 5, 8 ----

def labelled(spark, texts):
    docs = documents(spark, [(k, t, "s") for k, (t, _) in enumerate(texts)])
    labels = spark.createDataFrame([(k, y, 1 - y) for k, (_, y) in enumerate(texts) if k % 2] + [(None, 1, 1), (1, None, None)],
                                   "doc_id long, toxic int, quality int")
    return docs, labels


def test_classifiers_learn_and_cover_odd_texts(spark):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne") for b in ("ru", "sa", "te", "vo")]
    texts = []
    for k in range(400):
        bad = int(rng.random() < 0.3)
        w = list(rng.choice(words, 30))
        if bad:
            w[3:5] = ["grumpf", "grumpf!!"]
            w += ["###"] * 10
        texts.append((" ".join(w), bad))
    texts += [(None, 0), ("", 0), ("x" * 100_000, 0)]
    docs, labels = labelled(spark, texts)
    for found, label in ((toxicity.classify_toxicity(docs, labels), 1), (cotraining.classify_quality(docs, labels), 0)):
        rows = {r.doc_id: r for r in found.collect()}
        assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows.values())
        held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
        assert all(rows[k].held_out == (k in held) for k in range(400))
        right = np.mean([rows[k].predicted == (texts[k][1] if label else 1 - texts[k][1]) for k in held])
        assert right > 0.95
    none = labels.filter("false")
    assert {r.predicted for r in toxicity.classify_toxicity(docs, none).collect()} == {0}
    assert cotraining.classify_quality(docs, none).count() == len(texts)
    assert toxicity.classify_toxicity(documents(spark, []), labels).count() == 0


def test_a_capped_sample_decides_like_all_labels(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ne") for b in ("ru", "sa", "te", "vo") for c in "xyz"])
    texts = []
    for k in range(3000):
        bad = int(rng.random() < 0.1)
        w = list(rng.choice(words, 6))
        if rng.random() < (0.75 if bad else 0.05):  # words that tell something, but not all
            w[2] = "grumpf"
        texts.append((" ".join(w), bad))
    texts += [("", 0), ("qqq", 0), ("grumpf", 0)]
    docs = documents(spark, [(k, t, "s") for k, (t, _) in enumerate(texts)])
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    whole, capped = ({r.doc_id: r for r in toxicity.classify_toxicity(docs, labels, toxicity.NgramOptions(per_class=n)).collect()}
                     for n in (10_000, 200))
    same = np.mean([whole[k].predicted == capped[k].predicted for k in whole])
    assert same > 0.97
    # Texts without a known n-gram are scored by the bias alone.
    z = [np.log(r[3000].score / (1 - r[3000].score)) for r in (whole, capped)]
    assert abs(z[0] - z[1]) < 0.5
    mean = [np.mean([r.score for r in rows.values()]) for rows in (whole, capped)]
    assert abs(mean[0] - mean[1]) < 0.03


# ---- op 6 ----

def test_rules_and_trust(spark):
    rows = [(1, "http://A.Example.com/de/x?y", ""), (2, "https://b.org/fr/1", '<a href="http://c.io/">x</a>'),
            (3, "http://c.io/z", None), (4, "http://d.io", "<a href='//a.example.com/q'>"), (5, None, "x"), (6, "nothing", ""),
            (7, "http://net/", ""), (8, "http://x.example.net/en/", ""), (9, "http://x.net", ""), (9, "http://x.net", "")]
    found = linkgraph.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = collections.Counter(map(tuple, found))
    assert got == collections.Counter([
        (1, "a.example.com", "/de/x", "example.com/de/", "block"), (2, "b.org", "/fr/1", "org/fr/", "allow"),
        (3, "c.io", "/z", None, "allow"), (4, "d.io", "", None, "block"), (5, "", "", None, "allow"),
        (6, "", "", None, "allow"), (7, "net", "/", "net/", "block"),
        (8, "x.example.net", "/en/", "example.net/en/", "allow"), (9, "x.net", "", None, "allow"), (9, "x.net", "", None, "allow")])


# ---- op 7 ----

def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    vectors = [(base[k % 30] + rng.standard_normal(16) * 0.05 * (k % 4)).tolist() for k in range(200)]
    rows = [(k, v, k % 3 if k % 11 else None) for k, v in enumerate(vectors)]
    rows += [(500, [0.0] * 16, 1), (501, None, 1), (502, [float("nan")] * 16, 1), (503, [1.0, None], 1), (504, [1.0, 2.0], 1),
             (505, vectors[3], 0), (506, [], 1), (507, [x * 1e200 for x in vectors[3]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in itq_join.near_vectors(df, itq_join.ItqOptions(tables=24, key_bits=8, block=16)).collect()}
    good = [(i, np.array(v) / np.abs(v).max(), y) for i, v, y in rows if y is not None and v and None not in v
            and np.isfinite(v).all() and any(v)]
    expected = {i: 0 for i, _, _ in rows}
    for a, (i, u, y) in enumerate(good):
        for j, v, z in good[:a]:
            if y == z and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.93:
                expected[i] += 1
                expected[j] += 1
    assert all(found[i].n_links <= n for i, n in expected.items())
    assert sum(r.n_links for r in found.values()) >= 0.9 * sum(expected.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert itq_join.near_vectors(df.filter("false")).count() == 0


# ---- op 9 ----

def test_templates_catch_other_numbers_and_need_consistent_slots(spark):
    item = "the old farmer has 12 apples and gives 5 apples to each child so how many apples of 12 are left at noon"
    rows = [(1, f"Before it. {item} and more", "s"), (2, item.replace("12", "40").replace("5", "8"), "s"),
            (3, item.replace("12", "40", 1), "s"), (4, "a clean text without any of these things in it at all", "s"), (5, None, "s"),
            (6, item, "s"), (6, item, "s"), (None, item, "s")]
    items = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contaminated(documents(spark, rows), items).collect()}
    assert set(found) == {1, 2, 6, None} and found[None].exact and found[1].exact and not found[2].exact and found[6].item_id == 7
    kept = decontaminate.drop_contaminated(documents(spark, rows), items).collect()
    assert collections.Counter(r.doc_id for r in kept) == collections.Counter([3, 4, 5])
    assert decontaminate.contaminated(documents(spark, []), items).count() == 0


def test_texts_without_ids_are_judged_one_by_one(spark):
    item = "the old farmer has 12 apples and gives 5 apples to each child so how many apples of 12 are left at noon"
    clean = "a clean text without any of these things in it at all"
    rows = [(None, item, "s"), (None, f"Look: {item}", "s"), (None, item, "s"), (None, clean, "s"), (None, None, "s"), (1, item, "s"), (2, clean, "s")]
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontaminate.contaminated(documents(spark, rows), items)
    assert "text_key" not in found.columns
    assert sorted((r.doc_id or 0, r.item_id) for r in found.collect()) == [(0, 7), (0, 7), (1, 7)]
    kept = decontaminate.drop_contaminated(documents(spark, rows), items).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (0, clean), (2, clean)]


def test_templates_find_a_copy_beside_variants(spark):
    item = "the old farmer has 12 apples and gives 5 apples to each child so how many apples of 12 are left at noon"
    variant, mixed = item.replace("12", "40").replace("5", "8"), item.replace("12", "40", 1)
    other = "quite another text of fourteen words stands between both so that nothing touches here"
    words = item.split()
    half = " ".join(words[:11] + ["perhaps"] + words[11:])
    rows = [(1, f"{item} {other} {variant}", "s"), (2, f"{mixed} {other} {item}", "s"), (3, mixed, "s"),
            (4, f"{half.replace('12', '40').replace('5', '8')} {other} {item.replace('12', '77')}", "s"),
            (5, f"{other} {' '.join(item.replace('12', '9').split()[:9])} {other} {item}", "s"),
            (6, item, "s"), (6, mixed, "s"), (7, f"{half} {other} {mixed}", "s")]
    items = spark.createDataFrame([(1, item), (2, variant)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.exact for r in decontaminate.contaminated(documents(spark, rows), items).collect()}
    assert found == {(1, 1): True, (1, 2): True, (2, 1): True, (2, 2): False, (4, 1): False, (4, 2): False,
                     (5, 1): True, (5, 2): False, (6, 1): True, (6, 2): False, (7, 1): True, (7, 2): False}
    kept = decontaminate.drop_contaminated(documents(spark, rows), items).collect()
    assert [r.doc_id for r in kept] == [3]


def test_short_items_and_copies_after_any_word_are_found(spark):
    items = spark.createDataFrame([(1, "What is the capital of France?"), (2, "Solve for x"), (3, "Tom buys 12 pens and sells 5 pens"),
                                   (4, "1 2 3 4 5 6 7 8 9 10"), (5, "?"), (6, "")], "item_id long, text string")
    rows = [(1, "Question 5\nWhat is the capital of France?", "s"), (2, "Question what IS the capital of France", "s"),
            (3, "Now solve for x.", "s"), (4, "Problem 7\nTom buys 30 pens and sells 8 pens", "s"), (5, "0 1 2 3 4 5 6 7 8 9 10 11", "s"),
            (6, "What was the capital of France ? Solve it for y and 10 9 8 7 6 5 4 3 2 1", "s")]
    found = {(r.doc_id, r.item_id): r.exact for r in decontaminate.contaminated(documents(spark, rows), items).collect()}
    assert found == {(1, 1): True, (2, 1): True, (3, 2): True, (4, 3): False, (5, 4): True}


# ---- op 10 ----

def test_license_base_places_equal_brute_force(spark, corpus):
    rows = corpus + [(500, "MIT License mit license, the Apache License; x", "s"), (501, "GNU General-Public\nLicense v3. mit licensed", "s"),
                     (502, "Licensed under the Apache License, Version 2.0", "s"), (503, "mit license " * 2000, "s")]
    found = licenses.scan_licenses(documents(spark, rows)).collect()
    expected = collections.Counter()
    for doc_id, text, _ in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        at = [(k, label) for phrase, label in licenses.BASE for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        places = [k for k, _ in at]
        expected[(doc_id, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))] += 1
    assert collections.Counter(tuple(r)[:6] for r in found) == expected
    by_id = {r.doc_id: r for r in found}
    assert by_id[501].labels == "gpl,gpl-3.0" and by_id[502].labels == "apache,apache-2.0"
    assert by_id[503].n_detections == 3999 and by_id[503].n_base == 2000
    assert 240 < len(licenses.signature_rules())


def matching_texts(pattern):
    """A text for each way through a pattern's groups and classes, with and without what is optional."""
    parser = re._parser

    def ways(part):
        texts = [""]
        for op, arg in part:
            name = str(op)
            if name == "LITERAL":
                more = [chr(arg)]
            elif name == "IN":
                more = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])] + [
                    chr(x[1] if str(x[0]) == "LITERAL" else x[1][1]) for x in arg[-1:]]
            elif name == "BRANCH":
                more = [t for branch in arg[1] for t in ways(branch)]
            elif name == "SUBPATTERN":
                more = ways(arg[3])
            else:
                assert name == "MAX_REPEAT", name
                more = [t * n for n in {arg[0], min(arg[1], max(1, arg[0]))} for t in ways(arg[2])]
            texts = [a + b for a in texts for b in dict.fromkeys(more)]
        return texts

    return ways(parser.parse(pattern))


def test_gates_and_keywords_are_in_every_match(spark):
    rules = licenses.signature_rules()
    gates = licenses.gate_words(rules)
    examples = []
    for k, rule in enumerate(rules):
        texts = matching_texts(rule.pattern)
        for text in texts:
            assert re.fullmatch(rule.pattern, text) and rule.keyword in text, (rule, text)
            assert any(g in text for g in gates), (rule, text)
        # The text that is likeliest to have no gate word.
        examples.append(min(texts, key=lambda t: (sum(t.count(g) for g in gates), len(t), t)))
    rows = [(k, f"so it is {t} here", "s") for k, t in enumerate(examples)]
    rows += [(1000 + k, f"licensing permission and warranty so it is {t} here", "s") for k, t in enumerate(examples)]
    found = {r.doc_id: (r.labels, r.score, r.n_detections) for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert all(found[k] == found[1000 + k] and found[k][2] > 0 for k in range(len(rules)))


def test_rules_of_ones_own_need_no_gate_word(spark):
    rules = [licenses.SignatureRule("own", "house rules", "the house rules", 10, 0.5)]
    rows = [(1, "This code is distributed under BSD.", "s"), (2, "released under ISC", "s"), (3, "Here the house rules apply", "s")]
    docs = documents(spark, rows)
    assert {r.doc_id: r.labels for r in licenses.scan_licenses(docs).collect()} == {1: "bsd", 2: "isc", 3: ""}
    assert {r.doc_id: r.labels for r in licenses.scan_licenses(docs, rules).collect()} == {1: "", 2: "", 3: "own"}
