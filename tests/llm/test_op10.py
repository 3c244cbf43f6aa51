import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pelorus.llm.bpe_pieces import EagerPieceCache, PieceCache
from pelorus.llm.op10_token_files import _library_encoder, write_tokens
from pelorus.llm.registry import op10_token_files, tokenizer_path

from test_op1 import ALPHABET

T = Tokenizer.from_file(tokenizer_path())
_, encode = _library_encoder(tokenizer_path())


def want(rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = T.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[1])


def test_cases(spark):
    rows = [(5, "the dog, the cat."), (None, "null id"), (2, None), (9, ""), (1, "x <|endoftext|> y"), (7, "long word " * 5000), (3, "don't. Stop!\n\nNew"), (4, "naïve, 한국어.")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int")
    written = write_tokens(docs, tokenizer_path())
    assert sorted((tuple(r) for r in written.documents().collect()), key=key) == want(rows)
    assert [m[4] for m in written.manifest] == list(np.cumsum([0] + [m[3] for m in written.manifest[:-1]]))
    assert write_tokens(docs.limit(0), tokenizer_path()).documents().count() == 0


def test_repeated_rows(spark):
    rows = [(3, "same")] * 200 + [(3, "other")] * 2 + [(i, f"doc {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in write_tokens(docs, tokenizer_path()).documents().collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(i for i, _ in rows)
    assert [r[1] for r in got] == list(np.cumsum([0] + [r[2] for r in got[:-1]]))
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want(rows))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op10_token_files(spark, sf).collect()), key=key) == want(rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=30).map("".join))
def test_pieces_equal_the_library(text):
    for kind in (PieceCache, EagerPieceCache):
        cache = kind(encode, b"".join, {"<|endoftext|>": np.array([50256], "<u4").tobytes()}, 2)
        for _ in range(2):  # the second time from memory
            assert b"".join(cache.look([text])[0]) == np.array(T.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
