"""SimHash: fingerprints against the definition, components against all pairs."""
import random

import numpy as np
import xxhash

from playledger.llm import common, simhash
from playledger.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps, bits=3):
    """{fp: least fp reachable} by comparing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def clusters(seed, n):
    """Fingerprints with near neighbours, chains of steps and crowded prefixes."""
    r = random.Random(seed)
    out = set()
    while len(out) < n:
        f = r.getrandbits(64) if r.random() < 0.6 else (0xABCD << 48) | r.getrandbits(48)
        for _ in range(r.choice([1, 1, 3, 8])):
            out.add(f)
            for _ in range(r.choice([1, 2, 3, 4])):
                f ^= 1 << r.randrange(64)
    return sorted(out)


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def check_links(spark, fps, part_rows):
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    rows = simhash.links(frame, 3, part_rows).collect()
    want = brute_components(fps)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    mask = (1 << 64) - 1
    for x, y in rows:
        assert want[x & mask] == want[y & mask]
        a, b = find(x & mask), find(y & mask)
        root[max(a, b)] = min(a, b)
    assert {f: find(f) for f in fps} == want


def test_links_against_all_pairs(spark):
    check_links(spark, clusters(1, 700), simhash.PART_ROWS)


def test_crowded_parts_are_opened(spark):
    check_links(spark, clusters(2, 400), 20)
    check_links(spark, [signed(0) & ((1 << 64) - 1), 1, 3, 7, 15, 1 << 63, (1 << 63) | 1], 1)


def test_frontier_is_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 16)
    key = np.array(sorted(clusters(3, 300)), np.uint64)
    label = np.arange(len(key))
    n = np.array([0])
    simhash.walk(key, 0, (n, n + len(key), n, n + len(key), n), 3, label)
    want = brute_components(key.tolist())
    got = {int(key[i]): int(key[j]) for i, j in enumerate(label)}
    assert got == want


def test_fingerprints(monkeypatch):
    r = random.Random(5)
    for n in (0, 1, 2, 3, 4, 50, 400):
        t = " ".join(r.choice(["Ab", "é", "c", "\t", "DD", "x\x0by"]) for _ in range(n))
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t)
        with monkeypatch.context() as m:
            m.setattr(common, "_BLOCK_BYTES", 7)
            assert simhash.fingerprint(t.encode()) == brute_fingerprint(t)
    assert simhash.fingerprint(None) == 0


def test_near_duplicates_of_the_table(spark, docs, doc_rows):
    fp = {i: brute_fingerprint(t) for i, t, _ in doc_rows}
    comp = brute_components(fp.values())
    least = {}
    for i, f in fp.items():
        least[comp[f]] = min(least.get(comp[f], i), i)
    got = {r.doc_id: (r.fp & ((1 << 64) - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f, least[comp[f]]) for i, f in fp.items()}


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, " \t"), (4, "a b c d"), (2, "A b C d"), (2, "a b c d"), (None, "a b c d"), (None, "zz")]
    frame = spark.createDataFrame([(a, b, 0, 1) for a, b in rows], "doc_id long, text string, fp int, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (4, 2), (2, 2), (2, 2), (None, 2), (None, None)], key=str)
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(3, 3), (None, 4)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in edges:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {f: find(f) for f in root}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
