"""Encoder, bit packing, length histogram: exact round trips and counts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import bitpack, encoder, length_histogram
from strata.llm.encoder import Encoder
from strata.session import scratch_path
from tests.llm.cases import empty, hostile

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER, ENCODER = Tokenizer.from_file(PATH), Encoder(PATH)


def plain(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t\r  \x85\x1c'sab1é.,<|>")), st.characters(codec="utf-8")), max_size=40)))
def test_pieces_give_the_ids_of_the_whole_text(texts):
    assert [ENCODER.encode(t).tolist() for t in texts] == [plain(t) for t in texts]


_SNIPPETS = [*" \n'sabcé09.,!", "  ", "\n\n", " \n", "\n ", "'s", "'re", "'ve", "'ll", "'m", "'t", "'d", "''", " '", "don't", "×", "\t", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_SNIPPETS), max_size=25).map("".join), max_size=12))
def test_many_texts_give_the_ids_of_each(texts):
    assert [x.tolist() for x in ENCODER.encode_many(texts)] == [plain(t) for t in texts]


def test_many_texts_in_slices(monkeypatch):
    monkeypatch.setattr(encoder, "SLICE_CHARS", 30)
    texts = ["It's a 'quoted' word", "", "x" * 100, "ends ", " begins", "\n", "naïve café", "日本 語", "a\n\n  b"] * 5
    assert [x.tolist() for x in ENCODER.encode_many(texts)] == [plain(t) for t in texts]
    assert ENCODER.encode_many([]) == []


def test_pretokens_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(encoder, "byte_sums", lambda data: (np.zeros(len(data) + 1, np.uint64), np.ones(len(data), np.uint64)))
    texts = ["aa bb cc", "dd ee"]  # all hashes are 0
    assert [x.tolist() for x in ENCODER.encode_many(texts)] == [plain(t) for t in texts]


def test_texts_are_encoded_many_at_a_time():
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "aeiou" for c in ["", "st", "nd", "rk"]]
    texts = [" ".join(words[(i * k) % len(words)] for k in range(1, 200)) for i in range(1, 400)]
    calls, enc = [], Encoder(PATH)
    enc.encode = lambda t: calls.append(t) or Encoder.encode(enc, t)
    assert [x.tolist() for x in enc.encode_many(texts)] == [plain(t) for t in texts]
    assert not calls and not enc.pieces  # plain texts are not taken apart one by one
    assert len(enc.pretokens) <= 2 * len(words)


def test_other_tokenizers_are_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    enc = Encoder(path)
    assert not enc.by_piece
    texts = ["Some  Words here", "", "<|endoftext|> x"]
    assert [enc.encode(t).tolist() for t in texts] == [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("width", [1, 3, 7, 8, 11, 15, 16, 17, 20, 31, 32])
def test_pack_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001, dtype=np.uint64).astype("<u4")
    payload = bitpack.pack(ids, width)
    assert len(payload) == -(-1001 * width // 8)
    assert (bitpack.unpack(payload, width, 1001) == ids).all()
    for first, n in ((0, 1), (7, 9), (500, 501), (1000, 1), (3, 0)):
        assert (bitpack.unpack(payload, width, n, first) == ids[first:first + n]).all()


def expected(rows):
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
        ids = np.array([*plain(r.text), 2], dtype="<u4")
        out.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_packed_files(spark):
    docs = hostile(spark)
    path = scratch_path(spark, "t-packed")
    bitpack.write_packed(docs, path, PATH, block_ids=500)
    found = bitpack.read_documents(spark, path).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected(docs.collect())
    assert bitpack.document_ids(spark, path, 9) == [*plain(docs.filter("doc_id = 9").first().text), 2]
    assert bitpack.document_ids(spark, path, 10**9) == []


def test_packed_files_of_nothing(spark):
    path = scratch_path(spark, "t-packed")
    bitpack.write_packed(empty(spark), path, PATH)
    assert bitpack.read_documents(spark, path).collect() == []


def test_length_histogram(spark):
    docs = hostile(spark)
    lengths = sorted(len(plain(r.text)) for r in docs.collect())
    sums = length_histogram.with_suffix_sums(length_histogram.length_counts(docs, PATH)).cache()
    for r in sums.collect():
        assert r.n_docs == lengths.count(r.n_tokens)
        assert r.docs_above == sum(x > r.n_tokens for x in lengths)
        assert r.tokens_above == sum(x for x in lengths if x > r.n_tokens)
        assert r.tokens_if_cut == sum(min(x, r.n_tokens) for x in lengths)
        assert (r.total_docs, r.total_tokens, r.docs_upto) == (len(lengths), sum(lengths), sum(x <= r.n_tokens for x in lengths))
    assert {r.n_tokens for r in sums.collect()} == set(lengths)
    limits = [1, 7, 100, 10**6]
    assert {r.context_limit: r.tokens for r in length_histogram.truncated_totals(sums, limits).collect()} == {
        n: sum(min(x, n) for x in lengths) for n in limits}
    for r in length_histogram.quantiles(sums, [1, 50, 99, 100]).collect():
        assert r.n_tokens == lengths[max(0, -(-r.percent * len(lengths) // 100) - 1)]
    nothing = length_histogram.with_suffix_sums(length_histogram.length_counts(empty(spark), PATH))
    assert nothing.collect() == []
    assert nothing.agg(F.count(F.lit(1))).first()[0] == 0
