"""The pipeline against a brute-force version of its stages."""
import duckdb
import public_tokenizers
import tiktoken

import corpus_pipeline as P
from playledger.llm import bpe, quality
from test_dedup import brute_leaks
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_run(spark, docs):
    assert [n for n, _ in P.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "encode"]
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet') ORDER BY 1").fetchall()
    rows = [(i, t) for i, t in rows if model.score(quality.statistics((t or "").encode())[None])[0] >= 0.7]
    first = {}
    for i, t in rows:
        first.setdefault(t or "", i)
    rows = [(i, t) for i, t in rows if first[t or ""] == i]
    fp = {i: brute_fingerprint(t) for i, t in rows}
    comp = brute_components(fp.values())
    least = {}
    for i, f in fp.items():
        least.setdefault(comp[f], i)
    rows = [(i, t) for i, t in rows if least[comp[fp[i]]] == i]
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    leaked = {x[0] for x in brute_leaks(rows, items)}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(), special_tokens={})
    want = {i: lib.encode_ordinary(t or "") for i, t in rows if i not in leaked}
    got = {r.doc_id: r.ids for r in P.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_columns_and_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, fp int, _id int"
    odd = [(1, None), (2, ""), (2, ""), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (4, "tie " * 50), (5, "tie " * 50)]
    full = spark.createDataFrame([(i, t, None, None, None, "s", 1, 2) for i, t in odd], schema)
    for frame in (full, full.where("false")):
        for name, stage in P.STAGES:
            out = stage(spark, frame, SF)
            assert out.columns == (frame.columns if name != "encode" else ["doc_id", "ids", "n_tokens"])
            assert out.count() <= frame.count()


def test_rows_of_one_id_are_judged_each(spark):
    schema = "doc_id long, text string"
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clean = ["one clean text of eight words is here", "another clean text which has nine words in it"]
    rows = [(1, item), (1, clean[0]), (None, item + " and more"), (None, clean[0]), (None, clean[1])]
    left = P.decontamination_stage(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, [rows[1], *rows[3:]]))

    # the fingerprint does not see case, so these are near duplicates: two texts under one id, and null ids only
    rows = [(1, "zz " * 9), (2, clean[0]), (2, clean[0].upper()), (1, clean[0].title()), (None, clean[1]), (None, clean[1].upper()), (3, "yy xx ww")]
    kept = [tuple(r) for r in P.near_dedup_stage(spark, spark.createDataFrame(rows, schema), SF).collect()]
    assert len(kept) == 4 and rows[0] in kept and rows[3] in kept and rows[6] in kept
    assert sum(i is None for i, _ in kept) == 1


def test_very_long_texts(spark):
    long = "".join(f"word{k % 40_000}{' ' if k % 9 else chr(10)}" for k in range(160_000))  # above a megabyte
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(1, long), (2, long), (3, long + " end"), (4, long[::-1] + " " + item), (5, long[::-1]), (6, "a short one of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = P.exact_dedup_stage(spark, docs, SF)
    assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == [1, 3, 4, 5, 6]
    docs = P.near_dedup_stage(spark, docs, SF)
    assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == [1, 4, 6]
    docs = P.decontamination_stage(spark, docs, SF)
    assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == [1, 6]
    out = {r.doc_id: r.ids for r in P.encode_stage(spark, docs, SF).collect()}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(), special_tokens={})
    assert out == {i: lib.encode_ordinary(t) for i, t in rows if i in (1, 6)}
    assert P.quality_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).count() <= 6


def test_dropped_rows_sent_or_joined(spark, docs, monkeypatch):
    from playledger.llm import common
    stages = (P.exact_dedup_stage, P.near_dedup_stage, P.decontamination_stage)
    sent = [sorted(r.doc_id for r in stage(spark, docs, SF).select("doc_id").collect()) for stage in stages]
    monkeypatch.setattr(common, "SEND_KEYS", 0)
    assert sent == [sorted(r.doc_id for r in stage(spark, docs, SF).select("doc_id").collect()) for stage in stages]


def test_run_leaves_its_result_only(spark):
    import glob
    from playledger.session import ensure_checkpoint_dir
    at = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{at}/playledger-*"))
    n = P.run(spark, SF).count()
    left = set(glob.glob(f"{at}/playledger-*")) - before
    assert n and len(left) == 1 and "llm-encode" in left.pop()
