"""BPE: the transducer against the tiktoken library, the decoder against Python's UTF-8 decoder."""
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from playledger.llm import bpe


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), np.uint32).tolist()


@pytest.fixture(scope="module")
def tools():
    ranks = bpe.read_ranks()
    own = bpe.Encoder(ranks)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own, lib, bpe.Decoder(own.transducer.token)


TEXT = st.text(st.one_of(st.sampled_from("aabe thing.'s \n\t  01é日😀ñ  \x1c"), st.characters(exclude_categories=["Cs"])), max_size=80)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_like_the_library(tools, text):
    own, lib, decoder = tools
    ids = ids_of(own, text)
    assert ids == lib.encode_ordinary(text)
    assert decoder.decode(ids) == text


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=400, max_size=3000), st.integers(0, 700))
def test_long_pieces_settle(tools, text, n):
    own, lib, _ = tools
    for t in (text, "=" * n + "-" * n + text, "aaaa" * n):
        assert ids_of(own, t) == lib.encode_ordinary(t)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50255), max_size=12))
def test_decoder_of_any_ids(tools, ids):
    own, _, decoder = tools
    assert decoder.decode(ids) == b"".join(own.transducer.token[i] for i in ids).decode(errors="replace")


def test_decoder_of_any_bytes(tools):
    own, _, decoder = tools
    byte = {t: i for t, i in own.transducer.ranks.items() if len(t) == 1}
    for raw in (b"\xe2\x82", b"\xe2\x82A", b"\xf0\x9f\x98\x80", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf4\x90\x80\x80", b"\xe0\x80\x80\xff", b"\x80"):
        assert decoder.decode([byte[raw[k:k + 1]] for k in range(len(raw))]) == raw.decode(errors="replace")


def test_small_tables(tools, monkeypatch):
    own, lib, _ = tools
    for name, value in (("STATES", 5), ("PAIRS", 7), ("MEMORY", 3), ("WINDOW", 16)):
        monkeypatch.setattr(bpe, name, value)
    small = bpe.Encoder(own.transducer.ranks)
    for t in ("the internationalisation of thtionndre, erthat\n" * 5, "x" * 100 + " y" * 60, "a  b \n c"):
        assert ids_of(small, t) == lib.encode_ordinary(t)
    long = "the und ciones, " * 90_000
    assert ids_of(own, long) == lib.encode_ordinary(long)


def test_query(spark, doc_rows, tools):
    from playledger.llm import queries
    _, lib, _ = tools
    want = {}
    for i, t, _ in doc_rows:
        ids = lib.encode_ordinary(t or "")
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want[i] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_odd_rows(spark):
    schema = "doc_id long, text string, ids string"
    rows = [(1, None, "x"), (2, "", "x"), (2, "hi <|endoftext|>", "x"), (2, "hi <|endoftext|>", "x"), (None, "hi", "x")]
    out = bpe.decode(bpe.encode(spark.createDataFrame(rows, schema))).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted((str(a), b or "") for a, b, _ in rows)
    packed = bpe.decode(bpe.encode(spark.createDataFrame(rows, schema), packed=True)).collect()
    assert sorted((str(r.doc_id), r.text) for r in packed) == sorted((str(r.doc_id), r.text) for r in out)
    assert {bytes(r.ids) for r in packed} == {b"".join(i.to_bytes(4, "little") for i in r.ids) for r in out}
    assert bpe.decode(bpe.encode(spark.createDataFrame([], schema))).count() == 0
