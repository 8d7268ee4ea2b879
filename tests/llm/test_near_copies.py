"""Near copies against brute-force Jaccard similarity of five-word shingles."""

import random

import pytest
from texts import WORDS

from catalodge.llm import minhash
from catalodge.llm import near_copies as near


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(one, two):
    return len(one & two) / len(one | two) if one | two else 1.0


def classes(pairs, ids):
    root = {i: i for i in ids}
    for one, two in pairs:
        low, high = sorted((root[one], root[two]))
        root = {i: low if r == high else r for i, r in root.items()}
    return root


def drawn(draw, n):
    return [draw.choice(WORDS) + str(draw.randrange(400)) for _ in range(n)]


def changed(draw, words, times):
    words = words[:]
    for _ in range(times):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def corpus():
    draw, rows = random.Random(8), []
    for base in range(60):
        words = drawn(draw, draw.choice((60, 150, 400)))
        rows.append(words)
        rows += [changed(draw, words, max(1, round(len(words) * share))) for share in (0.005, 0.01, 0.02, 0.03, 0.06)]
    hot = drawn(draw, 200)
    rows += [changed(draw, hot, draw.randrange(1, 4)) for _ in range(120)]
    rows += [drawn(draw, n) for n in (1, 3, 4, 5, 9)]
    return [(3 * i + 7, " ".join(words)) for i, words in enumerate(rows)]


def test_recall_and_precision_against_all_pairs(spark, corpus):
    sets = {i: shingles(t) for i, t in corpus}
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if similarity(sets[a], sets[b]) >= 0.8]
    want = classes(linked, ids)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    got = dict(map(tuple, near.near_copies(docs).collect()))
    assert got.keys() == want.keys()
    found = sum(got[a] == got[b] for a, b in linked) / len(linked)
    assert found >= 0.97
    # Nothing is in a class that no chain of similar pairs leads to.
    assert all(want[i] == want[c] for i, c in got.items())


def test_blocks_lose_no_link(spark, corpus, monkeypatch):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    whole = sorted(map(tuple, near.near_copies(docs).collect()))
    monkeypatch.setattr(near, "BLOCK_DOCS", 7)
    assert sorted(map(tuple, near.near_copies(docs).collect())) == whole


def test_large_groups_write_shingles_once_and_send_candidates_only(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(i, " ".join(drawn(draw, 60))) for i in range(120)]
    rows += [(1000 + i, text + " more") for i, text in rows[:9]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups = docs.selectExpr("doc_id", "CAST(0 AS LONG) AS grp")
    written, met = [], []

    def noted(df, name):
        out = near_materialize(df, name)
        written.append((name, "shingles" in df.columns))
        if name == "meetings":
            met.append(out.count())
        return out

    near_materialize = near.materialize
    monkeypatch.setattr(near, "materialize", noted)
    monkeypatch.setattr(near, "BLOCK_DOCS", 4)
    monkeypatch.setattr(near, "TILE_DOCS", 40)
    got = dict(map(tuple, near.verified_classes(docs, groups, 5, 12, 0.8).collect()))
    assert all(c == (i - 1000 if i >= 1000 else i) for i, c in got.items()) and len(got) == len(rows)
    assert [name for name, has in written if has] == ["members"]
    # All 129 documents met all 33 blocks before; of those without a near copy hardly any is sent.
    assert len(met) == 1 and met[0] <= 60


def test_bands_against_all_pairs(spark, corpus):
    corpus = corpus[:200] + [(10_000 + i, corpus[3 * i][1]) for i in range(30)]
    sets = {i: shingles(t) for i, t in corpus}
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if similarity(sets[a], sets[b]) >= 0.8]
    want = classes(linked, ids)
    got = dict(map(tuple, minhash.near_copies(spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)).collect()))
    assert got.keys() == want.keys() and all(want[i] == want[c] for i, c in got.items())
    assert sum(got[a] == got[b] for a, b in linked) >= 0.99 * len(linked)


def test_bands_of_odd_documents(spark, odd_docs, no_docs):
    got = dict(map(tuple, minhash.near_copies(odd_docs).collect()))
    assert got[5] == 1 and got[3] == got[4] == 2 and got[6] == 6 and minhash.near_copies(no_docs).count() == 0


def test_odd_documents(spark, odd_docs, no_docs):
    rows = near.near_copies(odd_docs).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == odd_docs.where("doc_id IS NOT NULL").select("doc_id").distinct().count()
    got = dict(map(tuple, rows))
    assert got[5] == 1 and got[3] == got[4] == 2 and got[6] == 6 and got[9] == 9
    assert near.near_copies(no_docs).count() == 0
