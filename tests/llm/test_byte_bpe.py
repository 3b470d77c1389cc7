from __future__ import annotations

import base64

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st

from matchday.llm.byte_bpe import chunks_of, decode, encode, stitched

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SPLIT = regex.compile(PATTERN).findall


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab '\n l1,ére", max_size=80), st.integers(1, 12), st.integers(0, 9))
def test_stitching_gives_the_pieces_of_the_whole_text(text, size, overlap):
    chunks = [(s, t, SPLIT(t)) for s, t in chunks_of(text, size, overlap)]
    assert [p for part in stitched(chunks, SPLIT) for p in part] == SPLIT(text)


@pytest.mark.parametrize("size", [40, 32_768])
def test_ids_equal_the_library(spark, odd, empty, documents, encoding, size):
    for docs in (odd, spark.createDataFrame(documents), empty):
        found = decode(encode(docs, RANKS, PATTERN, keep=("doc_id", "text"), size=size, overlap=16), RANKS, PATTERN).collect()
        assert len(found) == docs.count()
        for r in found:
            assert list(r.ids) == encoding.encode_ordinary(r.text or "")
            assert bytes(r.decoded) == (r.text or "").encode()


def test_text_without_a_boundary(spark, encoding):
    docs = spark.createDataFrame([(1, "a" * 300 + "," + "b" * 200)], "doc_id long, text string")
    found = encode(docs, RANKS, PATTERN, size=50, overlap=5).collect()
    assert list(found[0].ids) == encoding.encode_ordinary("a" * 300 + "," + "b" * 200)
