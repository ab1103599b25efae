import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from llm_helpers import documents, odd_documents, SF_SMALL
from releasemill.llm import bytebpe, queries, tokencount

RANKS = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
SPECIFICATION = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


@pytest.fixture(scope="module")
def model():
    return bytebpe.serialise(RANKS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return Tokenizer.from_str(SPECIFICATION)


def test_bpe_query_equals_the_library(spark, documents, library):
    found = queries.QUERIES["op6_byte_bpe"](spark, SF_SMALL).collect()
    assert len(found) == len(documents)
    for row in found:
        ids = library.encode_ordinary(documents[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(documents[row.doc_id].encode()).hexdigest()


def test_bpe_of_odd_texts(model, library, monkeypatch):
    codec = bytebpe.Codec(model, PATTERN)
    letters = "ab '\t\n   é1½!<|endoftext|>s’中\x00\x1c▁▁Ġ𝔘Āǿ"
    source = random.Random(1)
    texts = ["", " ", "x" * 5000 + " " * 3000] + [
        "".join(source.choice(letters) for _ in range(source.randint(1, 60))) for _ in range(2000)
    ]
    for text in texts:
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    monkeypatch.setattr(bytebpe, "AT_ONCE", 7)
    monkeypatch.setattr(bytebpe, "MEMORY", 5)
    small = bytebpe.Codec(model, PATTERN)
    assert all(small.encode(t) == codec.encode(t) for t in texts[:300])
    assert all(small.decode(codec.encode(t)) == t.encode() for t in texts[:300])


def test_model_is_a_valid_file(model):
    loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert loaded.get_piece_size() == len(RANKS) + 1 and loaded.is_unknown(len(RANKS))
    with pytest.raises(ValueError):
        bytebpe.serialise({b"a": 0})


def test_bpe_of_odd_rows(odd_documents, model, library):
    found = bytebpe.round_trip(odd_documents, model, PATTERN, ["doc_id", "n_chars"]).collect()
    rows = [(r.doc_id, r.text or "") for r in odd_documents.collect()]
    expected = [(i, len(library.encode_ordinary(t)), t.encode()) for i, t in rows]
    got = [(r.doc_id, r.n_tokens, bytes(r.decoded)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert bytebpe.round_trip(odd_documents.limit(0), model, PATTERN, ["doc_id"]).count() == 0
    assert bytebpe.decoded(bytebpe.encoded(odd_documents, model, PATTERN).drop("n_tokens"), model, PATTERN).count() == 12


def test_count_query_equals_the_library(spark, documents, counter):
    found = queries.QUERIES["op7_token_counts"](spark, SF_SMALL).collect()
    assert len(found) == len(documents)
    for row in found:
        text = documents[row.doc_id]
        tokens = len(counter.encode(text, add_special_tokens=False))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), tokens, tokens > 1024)


@pytest.mark.parametrize("frequent", [0, 3, 100_000])
def test_counts_of_odd_rows(odd_documents, counter, frequent):
    found = tokencount.token_counts(odd_documents, SPECIFICATION, PATTERN, 1024, frequent=frequent).collect()
    expected = []
    for row in odd_documents.collect():
        text = row.text or ""
        tokens = len(counter.encode(text, add_special_tokens=False))
        expected.append((row.doc_id, len(text.encode()), tokens, tokens > 1024))
    got = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    empty = odd_documents.limit(0)
    assert tokencount.token_counts(empty, SPECIFICATION, PATTERN, 1024).count() == 0


def test_pretokens_of_new_characters_follow_the_library(counter, monkeypatch):
    splitter = tokencount.Splitter(SPECIFICATION, PATTERN)
    points = [p for p in range(0x30000) if not 0xD800 <= p < 0xE000]
    for point in random.Random(2).sample(points, 4000) + [0x558, 0x58B, 0x208F, 0xA7CE, 0x10940]:
        text = f"a{chr(point)}b {chr(point)}{chr(point)} 1"
        pieces = [p for part in splitter.split(text) for p in part]
        assert len(pieces) == len(counter.pre_tokenizer.pre_tokenize_str(text))
        assert "".join(pieces) == text
    monkeypatch.setattr(tokencount, "AT_ONCE", 3)
    text = "one two  three <|endoftext|> four" * 5
    assert sum(tokencount.piece_counts(counter, [p for part in splitter.split(text) for p in part])) == len(
        counter.encode(text, add_special_tokens=False)
    )
