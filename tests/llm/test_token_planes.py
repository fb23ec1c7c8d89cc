import tempfile
import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import ODD, documents
from tillbook.llm import token_planes

PATH = P.path("word_bpe_49k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aZ é\n.'!<|>1_"))))
def test_word_coder_is_the_library(text):
    assert list(token_planes.coder(PATH).encode([text], 1)[0]) == [*library().encode(text, add_special_tokens=False).ids, 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1)), st.sampled_from(["byte", "bit"]))
def test_planes_round_trip(ids, kind):
    ids = np.array(ids, np.uint32)
    assert (token_planes.from_planes(token_planes.to_planes(ids, kind), len(ids), kind) == ids).all()


def test_joined_crc():
    raw = np.random.default_rng(0).bytes(5000)
    cuts = [0, 1, 700, 700, 4096, 5000]
    pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
    assert token_planes.joined_crc((zlib.crc32(p), len(p)) for p in pieces) == zlib.crc32(raw)


def check(spark, rows, block, kind):
    folder = tempfile.mkdtemp() + "/planes"
    token_planes.write(documents(spark, rows), folder, PATH, end=1, block=block, kind=kind)
    got = sorted(map(tuple, token_planes.read_documents(spark, folder).collect()), key=lambda r: r[1])
    tokenizer, expected, start = library(), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == expected


def test_files_round_trip(spark):
    check(spark, ODD, token_planes.BLOCK_IDS, "byte")


def test_documents_that_span_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_planes, "FILE_TEXT_BYTES", 20_000)
    check(spark, ODD + [(i, f"text number {i} goes here") for i in range(10, 60)], 64, "bit")


def test_empty_table(spark):
    check(spark, [], 64, "byte")
