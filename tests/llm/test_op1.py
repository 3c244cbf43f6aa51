import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pelorus.llm import op1_bpe
from pelorus.llm.registry import op1_bpe_round_trip, tokenizer_path

T = Tokenizer.from_file(tokenizer_path())
OWN = op1_bpe.PairIndexBPE(tokenizer_path())
ALPHABET = st.one_of(
    st.sampled_from(list(" \n\t.,'!aeht\x1c\x85\xa0​᠎　") + ["the", " the", "<|endoftext|>", "1", "é", "'s", "'ll"]),
    st.characters(codec="utf-8"),
)
CASES = ["", " ", "  a", "a  b ", "a\n\nb", "aaaaaaa", "x <|endoftext|> y", "<|endoftext|>", "don't we'll", "한국 🙂", "a" * 5000, "ab " * 3000]


def want(text):
    return T.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(ALPHABET, max_size=30).map("".join))
def test_encode_equals_the_library(text):
    ids = OWN.encode(text)
    assert ids == want(text)
    assert OWN.decode(ids) == T.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert OWN.encode(text) == want(text)


def test_decode_of_broken_bytes():
    ids = want("🙂é")[:-1]
    assert OWN.decode(ids) == T.decode(ids, skip_special_tokens=False)


def test_frames(spark):
    rows = [(i, t, "x") for i, t in enumerate(CASES)] + [(None, "the", None), (3, None, None), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    coded = op1_bpe.encode_documents(docs, tokenizer_path())
    assert sorted((r.doc_id or -1, list(r.ids)) for r in coded.collect()) == sorted((i or -1, want(t or "")) for i, t, _ in rows)
    back = op1_bpe.decode_documents(coded, tokenizer_path())
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted((i or -1, t or "") for i, t, _ in rows)
    assert op1_bpe.round_trip(docs.limit(0), tokenizer_path()).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op1_bpe_round_trip(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = want(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
