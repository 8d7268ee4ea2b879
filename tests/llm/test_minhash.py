"""MinHash against sets of shingles, and edits against plain slices."""

import hashlib

import numpy as np
from texts import GERMAN, prose

from catalodge.llm import minhash
from catalodge.llm.queries import QUERIES


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(one, two):
    return len(one & two) / len(one | two) if one | two else 1.0


def by_id(rows):
    return {row["doc_id"]: row for row in rows}


def check(rows, result):
    rows = sorted(rows)
    found = by_id(result)
    assert len(found) == len(result) == len(rows)
    for at, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edit = text[: len(text) - cut] + following[:cut]
        row = found[doc_id]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        assert abs(row["near_edited"] - jaccard(shingles(text), shingles(edit))) < 0.22
        assert abs(row["near_next"] - jaccard(shingles(text), shingles(following))) < 0.22


def test_edits_and_likeness(spark):
    rows = [(7 * i - 300, prose(i, 20 + i) + " é日本" * (i % 3)) for i in range(120)]
    rows += [(5000, None), (5001, ""), (5002, "x"), (5003, "日本語のテキスト"), (5004, "w " * 30_000), (-(2**62), "low"), (2**62 + 1, "high"), (2**62, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(rows, minhash.edited_likeness(docs).collect())


def test_odd_documents(spark, odd_docs, no_docs):
    found = minhash.edited_likeness(odd_docs).collect()
    assert len(found) == odd_docs.count() and minhash.edited_likeness(no_docs).collect() == []
    texts = {(row["doc_id"], len(row["text"] or "")) for row in odd_docs.collect()}
    assert {(row["doc_id"], row["n_chars"]) for row in found} == texts
    equal = [row["signature"] for row in found if row["doc_id"] in (1, 5)]
    assert len(set(equal)) == 1 and len(equal) == 3
    empty = [row["signature"] for row in found if row["doc_id"] in (2, 3, 4)]
    assert len(set(empty)) == 1 and empty[0] not in equal


def test_one_document_is_its_own_next(spark):
    docs = spark.createDataFrame([(3, prose(1, 40))], "doc_id long, text string")
    row = minhash.edited_likeness(docs).first()
    assert row["near_next"] == 1.0 and 0.3 < row["near_edited"] < 0.9


def test_signature_estimates_jaccard():
    words = minhash.word_codes()
    gaps = []
    for seed in range(60):
        text = prose(seed, 300).split()
        other = text[:]
        for place in range(0, 300, 5 + seed):
            other[place] = "neu"
        pair = [" ".join(text), " ".join(other)]
        one, two = (minhash.signature(codes) for codes in words.codes([t.encode() for t in pair]))
        gaps.append(minhash.likeness(one, two) - jaccard(*map(shingles, pair)))
    assert abs(np.mean(gaps)) < 0.02 and np.abs(gaps).max() < 0.17


def test_minima_are_those_of_each_permutation():
    hashes = np.random.default_rng(3).integers(0, 1 << 64, 3000, np.uint64)
    want = [min((int(a) * int(x) + int(b)) % 2**64 for x in hashes[:50]) for a, b in zip(minhash.FACTORS, minhash.TERMS, strict=True)]
    assert minhash.minima(hashes[:50]).tolist() == want
    assert (minhash.minima(hashes) == np.minimum(minhash.minima(hashes[:999]), minhash.minima(hashes[999:]))).all()
    assert minhash.shingle_hashes(np.arange(3)).shape == (1,) and minhash.shingle_hashes(np.arange(9)).shape == (5,)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(row) for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    result = QUERIES["op12_minhash"](spark, sf).collect()
    check(docs, result)
    prints = {}
    for row in result:
        prints.setdefault(dict(docs)[row["doc_id"]], set()).add(row["fingerprint"])
    assert all(len(found) == 1 for found in prints.values())
    assert prose(1, 8, GERMAN)
