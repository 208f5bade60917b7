import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_fixture as fixture
from tracewell.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ENCODER = bpe.Encoder(RANKS)
OTHER = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = st.lists(st.sampled_from(["a", "b", "th", "ing", "é", "中", "zz", "0", "aaaa", "\U0001F600"]), min_size=1,
                  max_size=150).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=5))
def test_pieces_are_encoded_as_by_plain_merging(pieces):
    data = [p.encode() for p in pieces]
    assert ENCODER.encode_pieces(data) == [OTHER._core_bpe.encode_single_piece(d) for d in data]


@settings(max_examples=100, deadline=None)
@given(PIECES, PIECES)
def test_join_is_the_encoding_of_the_concatenation(a, b):
    a, b = a.encode(), b.encode()
    assert ENCODER.join(ENCODER.merge(a), ENCODER.merge(b)) == ENCODER.merge(a + b)


def test_long_pieces():
    for piece in ("a" * 4097, "ab" * 3000, "thing" * 999, "中" * 700):
        assert ENCODER.encode_pieces([piece.encode()]) == [OTHER._core_bpe.encode_single_piece(piece.encode())]


def test_round_trip_of_awkward_texts(spark):
    texts = fixture.awkward_texts()
    docs = fixture.documents(spark, [*texts, texts[7]], ids=[*range(len(texts) - 1), None, 7])
    rows = fixture.collected(bpe.with_digests(docs, RANKS, public_tokenizers.PATTERN))
    apart = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert sorted(map(str, apart.collect())) == sorted(
        map(str, bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN).collect()))
    assert len(rows[7]) == 2
    for i, text in zip([*range(len(texts) - 1), None], texts):
        ids = OTHER.encode_ordinary(text or "")
        for row in rows[i]:
            assert row.ids == ids and row.n_tokens == len(ids)
            assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table_and_unknown_ids(spark):
    assert bpe.digests(fixture.no_documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    unknown = spark.createDataFrame([([10 ** 6],), (None,)], "ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(unknown, RANKS).collect()
    assert bpe.decode(unknown.filter("ids IS NULL"), RANKS).first().decoded == b""


def test_store_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    store = bpe.PieceStore(ENCODER)
    for pieces in (["one", "two"], ["three", "four", "one"], ["a"], ["b", "c", "d", "e"]):
        ids, lengths = store.ids_of(pieces)
        assert ids.tolist() == [i for p in pieces for i in OTHER._core_bpe.encode_single_piece(p.encode())]
        assert len(lengths) == len(pieces)
