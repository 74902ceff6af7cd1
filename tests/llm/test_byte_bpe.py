import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastemap.llm import byte_bpe, registry

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.vocabulary()


@pytest.fixture(scope="module")
def tokens(ranks):
    return byte_bpe.TokenTable.build(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own(tokens):
    return byte_bpe.ByteEncoder(tokens, P.PATTERN, byte_bpe.newer_characters())


def ids(own, texts):
    return [np.frombuffer(b, "<u4").tolist() for b in own(texts)]


def test_hash_is_minimal_and_perfect(tokens, ranks):
    every = list(ranks)
    assert tokens.find(every) == [ranks[t] for t in every]
    assert sorted(tokens.ranks.tolist()) == sorted(ranks.values()) and len(tokens.hashes) == len(ranks)
    absent = [b"", b"\xff\xfe zzz", b"not a token at all"]
    assert tokens.find(absent) == [-1] * 3 and [tokens.rank(t) for t in absent] == [-1] * 3


def merged_plainly(piece: bytes, ranks: dict) -> list[int]:
    parts = [bytes([b]) for b in piece]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@given(st.binary(max_size=40))
@settings(max_examples=200, deadline=None)
def test_heap_equals_plain_merging(tokens, ranks, piece):
    assert byte_bpe.merged(piece, tokens) == merged_plainly(piece, ranks)


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_equals_the_library(own, library, text):
    assert ids(own, [text]) == [library.encode_ordinary(text)]


def test_every_code_point_is_cut_like_the_library(own, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 40_000):
        text = "\n".join(f"a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)} 2{chr(c)}  x" for c in points[lo:lo + 40_000:7])
        assert ids(own, [text]) == [library.encode_ordinary(text)]


def test_long_texts_and_slices(own, library, monkeypatch):
    rnd = random.Random(5)
    texts = ["ab" * 30_000, "\n" * 5000, "one two  three\t" * 4000, "՘\U000323b0 x" * 3000, "",
             "".join(rnd.choice("abcdefgh ") for _ in range(50_000))]
    want = [library.encode_ordinary(t) for t in texts]
    assert ids(own, texts) == want
    monkeypatch.setattr(byte_bpe, "SLICE_CHARS", 1000)
    monkeypatch.setattr(byte_bpe, "SLICE_PIECES", 77)
    assert ids(own, texts) == want


def test_tables_without_all_bytes_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.TokenTable.build({b"a": 0, b"b": 1})


def test_frames_round_trip(spark, doc_frame, tokens, library):
    rows = [(1, "Hello world's  end\n"), (2, None), (3, ""), (None, "null id"), (1, "Hello world's  end\n"),
            (5, "x y " * 40_000), (6, "ünïcödé 123 <|endoftext|> \U0001f600")]
    frame = doc_frame([(r[0], r[1], "s", "clash") for r in rows], ", decoded string")
    shared = spark.sparkContext.broadcast(tokens)
    coded = byte_bpe.encode_texts(frame, shared, P.PATTERN)
    assert coded.columns == [*frame.columns, "ids"]
    out = byte_bpe.decode_ids(coded, shared).collect()
    assert len(out) == len(rows)
    for r in out:
        assert list(r["ids"]) == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert byte_bpe.encode_texts(doc_frame([]), shared, P.PATTERN).count() == 0
    lost = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in byte_bpe.decode_ids(lost, shared).collect()} == {1: None, 2: b""}


def test_registered_query(spark, doc_frame, tmp_path, library):
    rows = [(1, "Some text, some more."), (2, None), (3, ""), (4, "zażółć gęślą jaźń")]
    doc_frame([(*r, "s", 1) for r in rows], ", ids long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in registry.QUERIES["op11_byte_bpe"](spark, str(tmp_path)).collect()}
    for i, t in rows:
        want = library.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
