import hashlib

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm.bpe import PROVEN, TreeBPE, decode_documents, encode_documents, round_trip

PATH = P.path("byte_bpe_multi_50k.tiktoken")
SMALL = TreeBPE(PATH, P.PATTERN, leaf=6, window=1)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab '\n\t 19.!s�éß漢 "), st.characters(exclude_categories=("Cs",))), max_size=120))
def test_tree_equals_library_and_round_trips(text):
    ids = SMALL.encode(text)
    assert ids == SMALL.core.encode_ordinary(text)
    assert SMALL.decode(ids) == text.encode()


def test_long_runs_without_stable_places():
    for text in ("x" * 3000, " " * 3000, "\n" * 500 + "a", "'" * 900 + "re" * 300, "12" * 2000 + "'s"):
        assert SMALL.encode(text) == SMALL.core.encode_ordinary(text)


def test_odd_rows(odd_docs, no_docs):
    got = {(r.id, r.n_tokens): r for r in round_trip(odd_docs, PATH, P.PATTERN, leaf=64).collect()}
    want = odd_docs.select("doc_id", "text").collect()
    assert len(want) == odd_docs.count()
    for r in want:
        ids = SMALL.core.encode_ordinary(r.text or "")
        row = got[r.doc_id, len(ids)]
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert round_trip(no_docs, PATH, P.PATTERN).count() == 0


def test_encode_then_decode(odd_docs):
    enc = encode_documents(odd_docs.where("doc_id IS NOT NULL"), PATH, P.PATTERN)
    back = {r.id: bytes(r.bytes) for r in decode_documents(enc, PATH, P.PATTERN).collect()}
    assert back[3] == back[4] == b""
    assert back[9].decode().startswith("Émigré")


def test_the_tree_decides_ordinary_texts():
    bpe = TreeBPE(PATH, P.PATTERN)
    text = "an ordinary text of some words, with 12 numbers and (marks) in it. " * 15
    assert bpe.encode(text) == bpe.core.encode_ordinary(text)
    assert bpe.joins >= len(text) // 64 - 1
    assert P.PATTERN == PROVEN


def test_a_wrong_edge_fails_loudly():
    bpe = TreeBPE(PATH, P.PATTERN, leaf=8, window=2, stable="(?<=[a-z])(?=[a-z])")
    with pytest.raises(RuntimeError):
        for n in range(9, 40):
            bpe.encode("international understanding and misinterpretations"[:n])
    with pytest.raises(ValueError):
        TreeBPE(PATH, r"\S+|\s+")
