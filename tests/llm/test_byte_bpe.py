import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD, documents
from tillbook.llm import byte_bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def whole():
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_encodes_as_the_rank_library(whole, text):
    bpe = byte_bpe.coder(PATH, P.PATTERN)
    ids = bpe.encode([text])[0]
    assert ids == whole.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_runs_of_one_character(whole):
    bpe = byte_bpe.coder(PATH, P.PATTERN)
    for c in " !-=a0é\n":
        for n in (1, 2, 3, 5, 7, 16, 31, 100):
            for before in ("", " ", "a"):
                assert bpe.encode([before + c * n])[0] == whole.encode_ordinary(before + c * n)


def test_characters_younger_than_the_tables(whole):
    texts = ["a࢏ b", "x₏", "\U00010940\U00010941 y"]
    assert byte_bpe.coder(PATH, P.PATTERN).encode(texts) == [whole.encode_ordinary(t) for t in texts]


def test_split_characters_and_offsets():
    bpe = byte_bpe.coder(PATH, P.PATTERN)
    ids = bpe.encode(["aé中🙂 x"])[0]
    offsets = bpe.character_offsets(ids)
    assert offsets[0][0] == 0 and offsets[-1][1] == 6
    assert any(a == b for a, b in zip(offsets, offsets[1:])), "the emoji lies in several tokens"
    assert bpe.decode_text(ids[:-2]).startswith("aé中") and "�" in bpe.decode_text(ids[: offsets.index((3, 4)) + 1])


def test_columns_and_odd_rows(spark):
    docs = documents(spark, ODD)
    out = byte_bpe.decode(byte_bpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert out.columns == [*docs.columns, "bpe_ids", "bpe_offsets", "bpe_text"]
    rows = out.collect()
    assert sorted((r.shard, r.bpe_text) for r in rows) == [(i, t or "") for i, (_, t) in enumerate(ODD)]
    assert all(len(r.bpe_ids) == len(r.bpe_offsets) for r in rows)
    assert byte_bpe.digests(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_query_digests(spark, whole):
    texts = {i: t for i, (_, t) in enumerate(ODD)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in byte_bpe.digests(docs, PATH, P.PATTERN).collect():
        text = texts[r.doc_id] or ""
        ids = whole.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bounded_memory_forgets_and_goes_on(monkeypatch, whole):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 20)
    bpe = byte_bpe.ByteBpe(PATH, P.PATTERN)
    rng = random.Random(0)
    for _ in range(30):
        texts = [" ".join(str(rng.randrange(1000)) for _ in range(30)) for _ in range(2)]
        assert bpe.encode(texts) == [whole.encode_ordinary(t) for t in texts]
