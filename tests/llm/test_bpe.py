"""Ids against the tokenizer library, and round trips."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe
from millrace.llm.queries import QUERIES, RANK_FILE

RAW = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
LIBRARY = tiktoken.Encoding(
    "all", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.pieces_of(RAW).ranks, special_tokens={}
)
PIECES = ["'", "'s", "'re", "'ll", "'l", "'v", " ", "  ", "\n", "\t", " ", "a", "les", "é", "日本", "12", "٣", "!?", ".", "<|endoftext|>"]


def encoded(texts):
    return [x.to_pylist() for x in bpe.encode_texts(pa.array(texts, pa.string()), RAW)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=5))
def test_ids_agree_with_the_library(texts):
    ids, starts = encoded(texts)
    assert ids == [LIBRARY.encode_ordinary(t) for t in texts]
    for text, tokens, at in zip(texts, ids, starts):
        data = text.encode()
        cuts = [*at, len(data)]
        assert [data[a:b] for a, b in zip(cuts, cuts[1:])] == [LIBRARY.decode_single_token_bytes(i) for i in tokens]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text_comes_back(texts):
    ids = bpe.encode_texts(pa.array(texts, pa.string()), RAW)[0]
    assert bpe.decode_ids(ids, RAW).to_pylist() == [t.encode() for t in texts]
    assert ids.to_pylist() == [LIBRARY.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_class_of_the_library():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(points), 200_000):
        text = "".join(f"a{c}1{c}!{c} {c}" for c in points[first : first + 200_000 : 7])
        assert encoded([text])[0][0] == LIBRARY.encode_ordinary(text)


def test_very_long_pieces():
    text = "x" * 5_000 + " " * 900 + "ab" * 4_000 + "'" * 99 + "!" * 700
    assert encoded([text, None, "", text])[0] == [LIBRARY.encode_ordinary(text), [], [], LIBRARY.encode_ordinary(text)]


def test_table_with_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "it's  here", "z"), (3, "é\n", "q"), (3, "é\n", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.digests(docs, RAW).collect()), key=repr)
    want = []
    for key, text, _ in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        digest = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        want.append((key, len(ids), *digest))
    assert got == sorted(want, key=repr)
    assert bpe.digests(docs.limit(0), RAW).count() == 0


def test_query_on_whole_table(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op6_bpe"](spark, small).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = LIBRARY.encode_ordinary(docs[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(docs[row["doc_id"]].encode()).hexdigest()


def test_scan_is_associative_over_block_borders():
    text = "word " * 100 + "'s" * 200
    for shift in range(0, bpe.BLOCK, 13):
        assert encoded(["z" * shift + text])[0][0] == LIBRARY.encode_ordinary("z" * shift + text)


def test_unknown_ids_raise():
    with pytest.raises(IndexError):
        bpe.decode_ids(pa.array([[10**7]], pa.list_(pa.int32())), RAW)
