"""Exact and substring duplicates, benchmark leaks: against brute force."""
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from playledger.llm import common, decontam, exact_dedup, substring_dedup

SCHEMA = "doc_id long, text string"


def test_exact_with_colliding_hashes(spark):
    r = random.Random(1)
    rows = [(i, r.choice([None, "", "a", "b", "a ", "cc", "dd"])) for i in range(60)] + [(3, "a"), (3, "a"), (None, "b"), (None, "only")]
    frame = spark.createDataFrame([(a, b, 1) for a, b in rows], SCHEMA + ", kept int")
    for keep, best in (("max", max), ("min", min)):
        for weak in (F.md5, lambda t: F.length(t)):
            got = sorted(map(str, exact_dedup.exact_duplicates(frame, keep=keep, content_hash=weak).collect()))
            groups = {}
            for i, t in rows:
                groups.setdefault(t or "", []).append(i)
            want = []
            for i, t in rows:
                own = groups[t or ""]
                k = best([x for x in own if x is not None], default=None)
                want.append(str(("doc", i, k, len(own), i == k, hashlib.sha256((t or "").encode()).hexdigest())))
            plain = [str(("doc", *x)) for x in exact_dedup.exact_duplicates(frame, keep=keep, content_hash=weak).toLocalIterator()]
            assert len(got) == len(rows) and sorted(plain) == sorted(want)


def test_drop_duplicates_leaves_one_row(spark):
    rows = [(1, "a", 5), (1, "a", 5), (2, "a", 6), (3, None, 7), (4, "", 8), (None, "z", 9)]
    out = exact_dedup.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string, text_sha256 int"))
    assert out.columns == ["doc_id", "text", "text_sha256"]
    assert sorted(map(str, ((r[0], r[2]) for r in out.collect()))) == sorted(map(str, [(1, 5), (3, 7), (None, 9)]))
    assert exact_dedup.drop_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_repeats(rows, window):
    least = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


def some_texts(seed, n):
    """Texts with shared passages, runs, near copies and borders in many places."""
    r = random.Random(seed)
    shared = [[r.choice("abcdefgh") + str(r.randrange(30)) for _ in range(r.randrange(8, 40))] for _ in range(6)]
    shared += [["x"] * 30, ["x", "y"] * 12]
    out = []
    for i in range(n):
        w = []
        for _ in range(r.randrange(0, 5)):
            s = r.choice(shared)
            a = r.randrange(len(s))
            w += r.choice([s, s[a:], s[:a], ["x"] * r.randrange(20), [r.choice("abc") + str(r.randrange(5000)) for _ in range(9)]])
        out.append((r.randrange(n), r.choice([" ", "\n", " \t "]).join(w)))
    return out + [(n, None), (n + 1, ""), out[0]]


def test_substring_against_brute_force(spark, monkeypatch):
    for seed, block, gather in ((1, 1 << 20, 100_000), (2, 40, 50), (3, 90, 10)):
        monkeypatch.setattr(common, "_BLOCK_BYTES", block)
        monkeypatch.setattr(substring_dedup, "GATHER", gather)
        rows = some_texts(seed, 40)
        got = sorted(tuple(r) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect())
        assert got == brute_repeats(rows, 13)


def test_substring_odd_rows(spark):
    t = " ".join(f"w{k}" for k in range(20))
    frame = spark.createDataFrame([(None, t, 1), (None, t, 1), (4, t, 1)], SCHEMA + ", starts int")
    got = sorted(((r.doc_id or -1, r.n_removed) for r in substring_dedup.remove_repeats(frame).collect()))
    assert got == [(-1, 20), (-1, 20), (4, 0)]
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_substring_table(spark, docs, doc_rows):
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == brute_repeats([(i, t) for i, t, _ in doc_rows], 13)


def brute_leaks(docs, items, k=5, t=0.8):
    def shingles(x, sizes):
        w = (x or "").lower().encode().split()
        return {tuple(w[i:i + n]) for n in sizes for i in range(len(w) - n + 1)}
    d, b = {}, {}
    for i, x in docs:
        d.setdefault(i, set()).update(shingles(x, range(1, k + 1)))
    for i, x in items:
        n = len((x or "").split())
        b.setdefault(i, set()).update(shingles(x, [min(n, k)] if n else []))
    return sorted(((i, j, len(s & q), len(q)) for i, s in d.items() for j, q in b.items() if q and len(s & q) / len(q) >= t), key=str)


def test_leaks(spark):
    r = random.Random(3)
    vocabulary = [f"W{k}" for k in range(300)]
    items = [(j, " ".join(r.choices(vocabulary, k=r.choice([3, 5, 6, 9, 20, 60])))) for j in range(25)] + [(99, None), (3, "a b c d e f")]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.randrange(0, 90)))) for i in range(30)] + [(50, None), (51, "")]
    for i in range(40):  # items inside texts, some words replaced
        w = r.choice(items[:25])[1].split()
        for _ in range(r.choice([0, 0, 1, 2])):
            w[r.randrange(len(w))] = "other"
        docs.append((100 + i // 2, " ".join(r.choices(vocabulary, k=40) + w + r.choices(vocabulary, k=5)).lower()))
    docs.append((None, items[5][1]))
    frame = spark.createDataFrame([(a, b, 0) for a, b in docs], SCHEMA + ", item_id int")
    leaks = decontam.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((x.doc_id, x.item_id, x.n_shared, x.n_item) for x in leaks.collect()), key=str)
    assert got == brute_leaks(docs, items) and len(got) > 10
    assert decontam.find_leaks(spark.createDataFrame([], SCHEMA), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontam.find_leaks(frame, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_leaks_short_items_and_split_texts(spark):
    words = [f"w{k}" for k in range(44)]
    docs = [(1, " ".join(words[:22])), (1, " ".join(words[18:])), (3, "Just Three Words"), (4, "so just three words here"), (5, "just three"), (6, "three just words")]
    items = [(1, " ".join(words[:40])), (2, "just three words"), (3, "three"), (4, ""), (5, "absent words")]
    leaks = decontam.find_leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((x.doc_id, x.item_id, x.n_shared, x.n_item) for x in leaks.collect()), key=str)
    assert got == brute_leaks(docs, items)
    assert {(a, b) for a, b, _, _ in got} == {(1, 1), (3, 2), (4, 2), (3, 3), (4, 3), (5, 3), (6, 3)}


@pytest.mark.parametrize("send", [(0, 1 << 25, 0), (0, 1 << 25, 10 ** 6), (10 ** 6, 0, 0)])
def test_leaks_however_they_are_sent(spark, monkeypatch, send):
    for name, value in zip(("SEND_ROWS", "SEND_BYTES", "SEND_HASHES"), send):
        monkeypatch.setattr(decontam, name, value)
    docs = [(i, f"a b c d e f{i % 3} g h") for i in range(9)] + [(9, "a b")]
    items = [(1, "a b c d e f1 g h"), (2, "a b"), (3, "x y")]
    leaks = decontam.find_leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((x.doc_id, x.item_id, x.n_shared, x.n_item) for x in leaks.collect()), key=str) == brute_leaks(docs, items)


def test_substring_of_other_windows(spark):
    assert [substring_dedup.pair_rounds(w) for w in (2, 13, 30, 100)] == [1, 2, 3, 5]
    for window in (4, 30):
        rows = some_texts(window, 30)
        got = sorted(tuple(r) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), window=window).collect())
        assert got == brute_repeats(rows, window)


def test_leaks_without_broadcast(spark, docs, doc_rows, monkeypatch):
    monkeypatch.setattr(decontam, "SEND_ROWS", 0)
    monkeypatch.setattr(common, "SEND_KEYS", 0)
    items = duckdb.sql("SELECT item_id, text FROM read_parquet('/root/testdata/sf0.001/benchmark.parquet')").fetchall()
    leaks = decontam.find_leaks(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))
    assert sorted(((x.doc_id, x.item_id, x.n_shared, x.n_item) for x in leaks.collect()), key=str) == brute_leaks([(i, t) for i, t, _ in doc_rows], items)
