import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from tabscope.llm import bpe
from tabscope.llm.arrays import utf8
from tests.llm import cases

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS)
PARTS = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ve", "'ll", "'t", "r", "e", "l", "v", "ab", "B", "é", "中", "1", "²", "!", "''", "　", "😀", "don't"]


def encoded(texts):
    ids, stops, bounds = CODEC.encode(*utf8(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], stops, bounds


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS)).map("".join), st.text(), st.none()), min_size=1))
def test_same_ids_as_the_library(texts):
    found, _, _ = encoded(texts)
    assert found == [LIBRARY.encode_ordinary(t or "") for t in texts]


def test_long_pieces_and_long_texts():
    texts = ["a" * 5000, "ab" * 3000, " " * 3000, cases.LONG, "x" * 33, ""]
    assert encoded(texts)[0] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_a_full_cache_is_replaced(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_SLOTS", 5)
    for texts in (["one two three four five six seven"], ["eight nine ten"], ["one two"]):
        assert encoded(texts)[0] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_monoid_composes_like_the_transitions():
    by_class, product, values = bpe.monoid()
    table = bpe.transitions()
    assert (values[by_class] == table).all()
    for a in range(len(table)):
        for b in range(len(table)):
            assert (values[product[by_class[a], by_class[b]]] == table[b][table[a]]).all()


def test_offsets_end_tokens():
    text = "naïve don't 中文"
    found, stops, _ = encoded([text])
    assert [text.encode()[a:b] for a, b in zip([0, *stops], stops, strict=False)] == [
        LIBRARY.decode_single_token_bytes(i) for i in found[0]
    ]


def test_frames_round_trip(spark):
    docs = cases.documents(spark).selectExpr("*", "'old' AS ids", "1 AS decoded")
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(back) == len(cases.ROWS)
    for row in back:
        assert row.decoded == (row.text or "").encode()
        assert row.ids == LIBRARY.encode_ordinary(row.text or "")


def test_digests(spark):
    rows = bpe.digests(cases.documents(spark).select("doc_id", "text"), PATH).collect()
    want = []
    for doc_id, text, *_ in cases.ROWS:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((str(doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted(want)


def test_wrong_offsets_are_refused(spark):
    tokens = bpe.encode(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), PATH)
    with pytest.raises(Exception, match="do not belong"):
        bpe.decode(tokens.selectExpr("doc_id", "ids", "transform(ends, x -> x + 1) AS ends"), PATH).collect()


def test_empty_table(spark):
    assert bpe.digests(cases.documents(spark).limit(0), PATH).count() == 0
