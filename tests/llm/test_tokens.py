import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from catalodge.llm.packing import assign, pack
from catalodge.llm.pretokens import PreTokenCache
from catalodge.llm.token_counts import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab'.,sS <|>\x1c é")), max_size=40), max_size=6))
def test_cache_equals_library(texts):
    texts += ["a<|endoftext|>b it's O'Neil's <|ENDOFTEXT|>", "Ångström, naïve!! 12ab34", "é  x"]
    cache = PreTokenCache(PATH, list, lambda a, b: a + b, capacity=5)
    for text in texts:
        chunks = cache.split([text.encode()])[0]
        assert sum((cache.table[c] for c in chunks), []) == ids_of(text)


def test_token_counts(odd_docs):
    got = sorted(map(tuple, token_counts(odd_docs, PATH, 2048).collect()), key=repr)
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    want = sorted(((i, len(t.encode()), len(ids_of(t)), len(ids_of(t)) > 2048) for i, t in rows), key=repr)
    assert got == want


def test_token_counts_of_nothing(no_docs):
    assert token_counts(no_docs, PATH).count() == 0


@pytest.mark.parametrize("lengths", [[1], [4096], [1, 2, 3], [5000, 100, 4096, 8192, 1], [700] * 50 + [30] * 9])
def test_assign(lengths):
    placed = assign(lengths, 4096)
    parts, rooms = defaultdict(list), defaultdict(list)
    for d, start, length, sequence, offset in placed:
        parts[d].append((start, length))
        rooms[sequence].append((offset, length))
    for d, n in enumerate(lengths):
        at = 0
        for start, length in sorted(parts[d]):
            assert start == at and length > 0
            at += length
        assert at == n
    for pieces in rooms.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0


def test_assign_balances_cost():
    placed = assign([2048] * 8 + [64] * 256, 4096)
    cost = defaultdict(float)
    for _, _, length, sequence, _ in placed:
        cost[sequence] += length + length * length / 4096
    assert max(cost.values()) < 1.2 * min(cost.values())


def test_pack(odd_docs):
    docs = {}
    for k, r in enumerate(odd_docs.collect()):
        docs.setdefault(r["doc_id"], []).append(ids_of(r["text"]) + [2])
    pieces = pack(odd_docs, PATH).collect()
    seen, rooms = defaultdict(int), defaultdict(list)
    for p in pieces:
        ids = list(struct.unpack(f"<{p['length']}I", p["ids"]))
        assert any(full[p["start"] : p["start"] + p["length"]] == ids and len(full) == p["doc_tokens"] for full in docs[p["doc_id"]])
        assert zlib.crc32(p["ids"]) == p["ids_crc32"]
        seen[p["doc_id"]] += p["length"]
        rooms[p["sequence_id"]].append((p["offset"], p["length"]))
    assert seen == {i: sum(map(len, full)) for i, full in docs.items()}
    for spans in rooms.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


def test_pack_of_nothing(no_docs):
    assert pack(no_docs, PATH).count() == 0


def test_pack_needs_a_power_of_two(odd_docs):
    with pytest.raises(ValueError):
        pack(odd_docs, PATH, limit=1000)
