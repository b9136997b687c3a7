"""Centroid clustering, ranked lexical search and MinHash near-duplicates against brute force."""
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from playledger.llm import centroid_clustering as cc
from playledger.llm import lexical_search as ls
from playledger.llm import minhash as mh

VECTORS = "vec_id long, embedding array<float>"


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in np.array(v, np.float32).astype(float).tolist()]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        centroids = [[sum(x) // len(own) for x in zip(*own)] if (own := [v for (_, v), a in zip(kept, at) if a == n]) else c
                     for n, c in enumerate(centroids)]
    last = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in last)
    return sorted(((i, n, d, sum(e for _, e, m in last if m == n), total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
                   for i, d, n in last), key=str)


def some_vectors(seed, n):
    r = random.Random(seed)
    heart = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, r.choice([0, 0.02, 0.5])) for x in r.choice(heart)]) for i in range(n)]
    rows += [(n, None), (n + 1, [0.5] * 63), (n + 2, [0.5] * 65), (n + 3, [float("nan")] + [0.5] * 63), (n + 4, [float("inf")] + [0.5] * 63), (n + 5, [None] + [0.5] * 63)]
    return rows + [(None, heart[0]), (None, heart[1]), (3, heart[2]), (3, heart[2]), rows[0]]


@pytest.mark.parametrize("seed,n", [(1, 200), (2, 40), (3, 6)])
def test_clusters(spark, seed, n):
    rows = some_vectors(seed, n)
    frame = spark.createDataFrame([(*r, 1) for r in rows], VECTORS + ", cluster int").repartition(5)
    assert sorted(map(tuple, cc.cluster(frame).collect()), key=str) == brute_clusters(rows)


def test_clusters_without_vectors(spark):
    out = cc.cluster(spark.createDataFrame([(1, None), (2, [1.0])], VECTORS))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert cc.cluster(spark.createDataFrame([], VECTORS)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        cc.cluster(spark.createDataFrame([(1, [1e30] * 64)], VECTORS)).collect()


def test_bounds_never_exceed_distances_and_prune():
    r = np.random.default_rng(4)
    heart = r.integers(-200, 200, (16, 64))
    v = heart[r.integers(0, 16, 3000)] + r.integers(-3, 4, (3000, 64))
    pivots, pairs = cc.choose_pivots(heart + 1, v[:500], 2)
    near = np.sqrt(np.stack([cc.squared(v, p) for p in pivots], 1).astype(float))
    finder = cc.Nearest(heart, pivots, pairs)
    exact = np.stack([cc.squared(v, c) for c in heart], 1)
    assert (finder.bounds(near) <= exact).all()
    at, d, done = finder.assign(v, near)
    assert (at == exact.argmin(1)).all() and (d == exact.min(1)).all()
    assert done < 3 * len(v)  # of 16 distances each
    big = cc.Nearest(heart * 300_000, pivots * 300_000, pairs)  # near the bound of 64 bits
    assert (big.bounds(near * 300_000.0) <= np.stack([cc.squared(v * 300_000, c) for c in heart * 300_000], 1).astype(float)).all()


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k=10):
    found = [(i, words_of(t)) for i, t in docs]
    found = [(i, w) for i, w in found if w]
    n, total = len(found), sum(len(w) for _, w in found)
    df = Counter(t for _, w in found for t in set(w))
    out = []
    for item, text in set(items):
        scores = []
        for i, w in found:
            tf, m = Counter(w), 100 - 75 + (75 * len(w) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in words_of(text) if t in tf)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


DOCS, ITEMS = "doc_id long, text string, score string", "item_id long, text string, rank string"


def a_collection(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "x1", "ſ", "İ"]
    rows = [(i, r.choice([" ", ", ", "\n", "-"]).join(r.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=r.randrange(0, 90))).title()) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "...!?"), (None, "w1 w2"), (None, "w1 w2"), (2, "w1 w2"), (0, "w59 " * 4000 + "w3"), rows[3]]
    items = [(j, " ".join(r.choices(vocabulary, k=r.randrange(1, 12)))) for j in range(12)]
    return rows, items + [(50, None), (51, ""), (52, "unknown words"), (53, "w1 w1 w1"), (None, "w7 w2"), items[0], (1, "w9")]


@pytest.mark.parametrize("seed,n,block,width", [(1, 150, 10 ** 6, 1024), (2, 60, 7, 4), (3, 4, 1, 64)])
def test_search(spark, monkeypatch, seed, n, block, width):
    monkeypatch.setattr(ls, "BATCH", 16)
    rows, items = a_collection(seed, n)
    docs = spark.createDataFrame([(*x, "") for x in rows], DOCS).repartition(4)
    out = ls.search(docs, spark.createDataFrame([(*x, "") for x in items], ITEMS), block_terms=block)
    assert sorted(map(tuple, out.collect()), key=str) == brute_search(rows, items)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b", "")], DOCS), spark.createDataFrame([(1, "a", "")], ITEMS)
    assert ls.search(docs, items).count() == 1
    assert ls.search(docs.where("false"), items).count() == 0 and ls.search(docs, items.where("false")).count() == 0


def test_bounds_hold():
    r = random.Random(3)
    for _ in range(30):
        docs = [Counter(r.choices([b"t%d" % k for k in range(3000)], k=r.randrange(1, 2000))) for _ in range(20)]
        docs[0][b"t1"] = 5_000_000
        words = [b"t%d" % k for k in r.sample(range(3000), 40)]
        block = ls.Queries({t: j for j, t in enumerate(words)}, np.array([r.randrange(9000) for _ in words]),
                           [np.array(r.sample(range(40), 9)) for _ in range(5)], [np.array([1, 2, 1, 1, 3, 1, 1, 1, 1])] * 5, 20, sum(sum(d.values()) for d in docs))
        n = np.array([sum(d.values()) for d in docs])
        bound = block.bounds(block.folded(), n, [ls.sketch(d).tobytes() for d in docs])
        for j, d in enumerate(docs):
            tf = np.array([d[t] for t in words])
            worth = block.weights * ls.impact(tf, ls.norm(n[j], block.many, block.total))
            assert all(bound[j, q] >= (worth[p] * t).sum() for q, (p, t) in enumerate(zip(block.places, block.times)))


def brute_near(rows, k=3, percent=85):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                label[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        c = root(a)
        least[c] = i if least.get(c) is None else least[c] if i is None else min(i, least[c])
    return sorted(((i, len(sets[a]), least[root(a)], i == least[root(a)]) for a, (i, _) in enumerate(rows)), key=str)


NEAR = "doc_id long, text string, component_id string"


def near_texts(seed, n, families):
    r = random.Random(seed)
    vocabulary = [f"V{k}" for k in range(400)]
    heads = [r.choices(vocabulary, k=r.choice([1, 2, 3, 4, 8, 20, 60, 150])) for _ in range(families)]
    passage = r.choices(vocabulary, k=40)
    out = []
    for i in range(n):
        w = list(r.choice(heads))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5, 8])):
            w[r.randrange(len(w))] = r.choice(vocabulary).lower()
        out.append((r.randrange(n), " ".join(w + (passage if r.random() < 0.2 else []) + ([r.choice(vocabulary)] if r.random() < 0.3 else []))))
    return out + [(n, None), (n + 1, ""), (n + 2, " \n"), (None, out[0][1]), (None, "one two"), (None, "One  two"), out[1]]


@pytest.mark.parametrize("seed,n,families,stars", [(1, 200, 30, 2), (2, 150, 3, 2), (3, 150, 2, 1), (4, 120, 1, 3)])
def test_near_duplicates(spark, seed, n, families, stars):
    rows = near_texts(seed, n, families)
    frame = spark.createDataFrame([(*x, "") for x in rows], NEAR).repartition(6)
    assert sorted(map(tuple, mh.near_duplicates(frame, stars=stars).collect()), key=str) == brute_near(rows)


def test_a_chain_of_near_duplicates(spark):
    # each links with the next only; the star of a bucket reaches few of them
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(words[3 * i:3 * i + 100])) for i in range(60)]
    frame = spark.createDataFrame([(*x, "") for x in rows], NEAR)
    assert sorted(map(tuple, mh.near_duplicates(frame).collect()), key=str) == brute_near(rows)


def test_near_duplicates_of_nothing(spark):
    frame = spark.createDataFrame([(1, None, ""), (2, "", "")], NEAR)
    assert sorted(map(tuple, mh.near_duplicates(frame).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert mh.near_duplicates(frame.where("false")).count() == 0


def test_shingles_of_long_texts(monkeypatch):
    from playledger.llm import common
    r = random.Random(7)
    text = " ".join(r.choices("abcdefghij", k=3000)).encode()
    whole = mh.shingles(text, 3)
    for block in (1, 10, 333):
        monkeypatch.setattr(common, "_BLOCK_BYTES", block)
        assert (mh.shingles(text, 3) == whole).all()
    assert len(mh.shingles(b"a b", 3)) == 1 and len(mh.shingles(b"", 3)) == 0 and len(mh.shingles(None, 3)) == 0


def test_signatures_agree_as_often_as_sets():
    r = np.random.default_rng(1)
    for size in (3, 30, 300, 3000):
        rate, want = [], []
        for _ in range(60):
            a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[: max(1, int(len(a) * 0.9))], r.integers(0, 1 << 63, max(1, size // 20), dtype=np.uint64)]))
            want.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
            rate.append((mh.signature(a) == mh.signature(b)).mean())
        assert abs(np.mean(rate) - np.mean(want)) < 0.04
