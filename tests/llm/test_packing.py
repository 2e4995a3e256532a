import os
import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quirework.llm.packing import Packer, added_tokens, balance, pack_documents, powers_of_two, rank_encoder

os.environ["TOKENIZERS_PARALLELISM"] = "false"
LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
RANKS = P.path("byte_bpe_50k.tiktoken")
ADDED = added_tokens(P.path("byte_bpe_50k.json"))
PIECES = st.lists(st.one_of(st.text(max_size=20), st.sampled_from([*ADDED, "<|endoftext|", "|>", "<|", " "])), max_size=8)
ENCODE = rank_encoder(RANKS, P.PATTERN, ADDED)


@settings(max_examples=300, deadline=None)
@given(PIECES.map("".join))
def test_ranks_give_the_ids_of_the_tokenizers_file(text):
    assert ENCODE(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_one_id():
    text = "a <|endoftext|><|endoftext|> b<|endoftext|"
    assert ENCODE(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODE(text).count(50256) == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=40))
def test_balance_fills_exactly(lengths):
    total = sum(lengths)
    caps = [64] * (total // 64) + powers_of_two(total % 64)
    cuts = balance(lengths, caps, 1.0, 0.01)
    used = [0] * len(caps)
    for n, c in zip(lengths, cuts, strict=True):
        assert sum(x for _, x in c) == n
        for k, x in c:
            used[k] += x
    assert used == caps


def test_whole_pieces_go_to_the_cheapest_sequence():
    assert balance([60, 50, 10], [64, 64], 1.0, 0.0) == [[(0, 60)], [(1, 50)], [(1, 10)]]


def check(rows, docs):
    encode = ENCODE
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.id, r.doc_tokens), []).append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0
        assert at <= 1024
    for r in docs:
        ids = np.array([*encode(r.text or ""), 0], "<u4")
        pieces = [p for p in by_doc[r.doc_id, len(ids)]]
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) or len({q.text for q in docs if q.doc_id == r.doc_id}) > 1
        copies = sum(q.doc_id == r.doc_id and q.text == r.text for q in docs)
        assert sum(p.length for p in pieces) == copies * len(ids)


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text").collect()
    for group in (64, 1 << 19):
        check(pack_documents(odd_docs.coalesce(2), RANKS, P.PATTERN, ADDED, group_tokens=group).collect(), docs)
    assert pack_documents(no_docs, RANKS, P.PATTERN).count() == 0


def test_carried_tail_keeps_its_place():
    p = Packer(0, 8, 1.0, 0.1)
    p.add(1, np.arange(5, dtype="<u4"))
    p.pack(last=False)
    assert not p.rows and p.tokens == 5
    p.add(2, np.arange(20, dtype="<u4"))
    p.pack(last=True)
    assert sum(r[2] for r in p.rows) == 25
