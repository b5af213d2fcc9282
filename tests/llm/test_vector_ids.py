"""Linked vectors where ids repeat or are missing, against brute force."""

import collections

import numpy as np

from wardlens.llm import itq_join

SCHEMA = "vec_id long, embedding array<double>, label int, class string, keys string, copies int, component string"


def brute(rows, cosine=0.93):
    usable = [v is not None and label is not None and any(v) for _, v, label in rows]
    unit = [np.array(v) / np.linalg.norm(v) if ok else None for (_, v, _), ok in zip(rows, usable)]
    group, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= cosine:
                links[i], links[j] = links[i] + 1, links[j] + 1
                group[find(i)] = find(j)
    names = collections.defaultdict(list)
    for k, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            names[find(k)].append(vec_id)
    return collections.Counter((vec_id, links[k], name := min(names[find(k)], default=None), vec_id == name)
                               for k, (vec_id, _, _) in enumerate(rows))


def test_repeated_and_missing_ids(spark):
    rng = np.random.default_rng(4)
    near = lambda v: (v + rng.normal(size=12) * 0.02).tolist()
    a, b, c = (rng.normal(size=12) for _ in range(3))
    rows = [(1, a.tolist(), 0), (1, b.tolist(), 0), (2, near(a), 0), (3, near(b), 0), (4, near(b), 0),   # one id, two vectors
            (None, c.tolist(), 0), (7, near(c), 0), (8, near(c), 0),                                    # linked without an id
            (None, rng.normal(size=12).tolist(), 0), (None, None, 0), (9, None, 0),
            (5, a.tolist(), 1), (5, a.tolist(), 1), (None, a.tolist(), 1),                              # equal rows, other label
            (None, b.tolist(), 2), (None, near(b), 2), (6, b.tolist(), None)]
    rows += [(100 + k % 30, rng.normal(size=12).tolist(), 3) for k in range(60)]
    df = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)
    found = itq_join.near_vectors(df, itq_join.ItqOptions(key_bits=8, block=4)).collect()
    assert collections.Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == brute(rows)
