import base64
import gzip
import hashlib
import random
import re
import uuid

import numpy as np
import pytest
from texts import prose

import corpus_pipeline
from catalodge.llm import decontaminate, quality, warc
from catalodge.llm.exact_dedup import DigestIndex, exact_dedup
from catalodge.llm.queries import TOKENIZER
from catalodge.session import shared_dir

VOCABULARY = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st")]


def passage(seed, words=40):
    return prose(seed, words, VOCABULARY)


def edited(text, seed, share):
    draw, out = random.Random(seed), []
    for word in text.split():
        roll = draw.random()
        if roll < share / 2:
            out.append("changed")
        elif roll < share:
            out += [word.upper() + ",", "added"]
        else:
            out.append(word)
    return " ".join(out)


def slow_align(item, window):
    h = np.zeros((len(item) + 1, len(window) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(window, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a == b else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_equals_dynamic_program():
    draw = np.random.default_rng(2)
    items, windows = draw.integers(1, 6, (30, 12)), draw.integers(1, 6, (30, 25))
    score, _, end = decontaminate.align(items, windows)
    for k in range(30):
        assert score[k] == slow_align(items[k], windows[k]) == slow_align(items[k], windows[k][: end[k] + 1])


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(i, passage(i)) for i in range(6)] + [(90, None), (91, ""), (92, "two words"), (93, passage(3))]
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_leaks(docs, items):
    def words(text):
        return [w for w in (re.sub(r"[\W_]+", "", c.lower()) for c in (text or "").split()) if w]

    return {(d, i) for d, t in docs for i, b in items if len(words(b)) > 2 and slow_align(words(b), words(t)) >= len(words(b))}


def test_leaks(spark, benchmark, odd_docs, no_docs):
    docs = []
    for i in range(6):
        docs += [(10 * i + k, f"{passage(500 + i, 80)} {edited(passage(i), k, share)} {passage(700 + i, 50)}") for k, share in enumerate((0, 0.1, 0.25))]
    docs += [(900 + i, passage(900 + i, 200)) for i in range(10)]
    docs += [(2000 + i, passage(0)) for i in range(50)] + [(1000, " | ".join(passage(1).split())), (1001, None), (1002, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.find_leaks(frame, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == brute_leaks(docs, [(r["item_id"], r["text"]) for r in benchmark.collect()])
    texts = dict(docs)
    exact = next(r for r in found if r["doc_id"] == 10)
    cut = texts[10].split()[exact["first_word"] : exact["last_word"] + 1]
    assert exact["score"] == 1.0 and " ".join(cut) == passage(1)
    clean = {r["doc_id"] for r in decontaminate.without_leaks(frame, benchmark).collect()}
    assert clean == set(texts) - {r["doc_id"] for r in found}
    assert decontaminate.find_leaks(odd_docs, benchmark).count() == 0
    kept = decontaminate.without_leaks(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert decontaminate.find_leaks(no_docs, benchmark).count() == 0
    assert decontaminate.find_leaks(frame, benchmark.limit(0)).count() == 0


def test_edited_copies_alone_are_leaks(spark):
    """Items of which only edited copies exist, or one exact and many edited ones, and edits that leave no two words together."""
    words = {i: passage(40 + i).split() for i in range(5)}
    fifth = {i: " ".join("changed" if k % 5 == 2 else w for k, w in enumerate(own)) for i, own in words.items()}
    docs = [(0, f"{passage(501, 80)} {fifth[0]} {passage(701, 50)}")]
    docs += [(1, passage(41))] + [(100 + k, f"{passage(800 + k, 30)} {fifth[1]}") for k in range(30)]
    docs += [(2, " ".join("changed" if k % 3 == 2 else w for k, w in enumerate(words[2])))]
    docs += [(3, " between ".join(words[3])), (4, edited(passage(44), 7, 0.45)), (5, f"{passage(44, 25)} {passage(502, 300)}")]
    items = [(i, " ".join(own)) for i, own in words.items()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(frame, benchmark).collect()}
    assert found == brute_leaks(docs, items)
    assert found >= {(0, 0), (1, 1), (2, 2), (3, 3), *((100 + k, 1) for k in range(30))}
    clean = {r["doc_id"] for r in decontaminate.without_leaks(frame, benchmark).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in found}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8])
def test_bounds_lose_no_leak(threshold):
    """Scores of random edits of all strengths against the whole dynamic program."""
    texts = [passage(i, 10 + 4 * i) for i in range(8)]
    items = decontaminate.index_items(list(enumerate(texts)))
    docs = [f"{passage(600 + k, 25)} {edited(texts[k % 8], k, (k % 11) / 12)} {passage(700 + k, 90)}" for k in range(66)]
    codes = list(decontaminate.coded(items, [d.encode() for d in docs]))
    counts = sum(np.bincount(c, minlength=len(items.vocabulary) + 1) for c in codes)
    matcher = decontaminate.Matcher(items, decontaminate.seeds_of(items, counts, threshold), threshold)
    want = {(t, i): slow_align(w, c) / (2 * len(w)) for t, c in enumerate(codes) for i, w in enumerate(items.words)}
    got = {(t, i): share for t, i, share, _, _ in matcher.matches([d.encode() for d in docs])}
    assert got == {pair: share for pair, share in want.items() if share >= threshold}


def test_leaks_in_blocks(spark, benchmark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{passage(50 + i, 30)} {passage(i)}") for i in range(6)], "doc_id long, text string")
    whole = sorted(map(tuple, decontaminate.find_leaks(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    assert len(list(decontaminate.item_blocks(benchmark))) > 3
    assert sorted(map(tuple, decontaminate.find_leaks(docs, benchmark).collect())) == whole
    assert decontaminate.without_leaks(docs, benchmark).count() == 0


def folder(spark):
    return f"{shared_dir(spark, 'test-archives')}/{uuid.uuid4().hex}"


PAGES = [(1, "u", "aa"), (2, None, "aa"), (3, "a\nb", "x\r\n\r\ny"), (4, "", None), (5, "z", ""), (6, "z", "é" * 400_000), (None, "n", "aa"), (7, "r", "q"), (7, "r", "q")]


@pytest.mark.parametrize("least", [0, 3])
def test_archives(spark, least):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, digest string, first int")
    want = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        first = min((i for i, _, h in PAGES if (h or "").encode() == payload and i is not None), default=None)
        revisit = len(payload) >= least and first is not None and first != page_id
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((page_id, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    got = warc.archive_round_trip(pages, folder(spark), least)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert warc.archive_round_trip(pages.limit(0), folder(spark)).count() == 0


def test_members_and_sidecar(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    archives = warc.write_archives(pages.coalesce(1), folder(spark))
    index = warc.normalise(archives).collect()
    old = archives.first()["file"].removeprefix("file://")
    new = index[0]["file"].removeprefix("file://")
    with open(old, "rb") as a, open(new, "rb") as b:
        one, many = a.read(), b.read()
    assert gzip.decompress(one) == gzip.decompress(many)
    with open(new + ".idx") as f:
        lines = [line.split("\t") for line in f.read().splitlines()]
    assert [(int(o), int(n), r) for o, n, r in lines] == [(r["offset"], r["length"], r["record_id"]) for r in index]
    for r in index:
        member = gzip.decompress(many[r["offset"] : r["offset"] + r["length"]])
        assert member.startswith(b"WARC/1.1\r\n") and r["record_id"].encode() in member


def test_damaged_archives():
    whole = gzip.compress(warc.record(1, "u", b"abc", None, False))
    import io

    assert len(list(warc.records(warc.inflated(io.BytesIO(whole))))) == 1
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(io.BytesIO(whole[:-12]))))
    cut = gzip.compress(warc.record(1, "u", b"abc", None, False)[:-6])
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(io.BytesIO(cut))))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Small tables: junk, exact copies, near copies and leaks among clean documents."""
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for i in range(240):
        text = passage(i + 3000, 120)
        if i % 6 == 0:
            text = " ".join(w + "&&&" for w in text.split())
        if i % 10 == 1:
            text += " " + passage(i % 4)
        rows.append((i, text))
        labels.append((i, int(i % 6 != 0), 0))
    rows += [(1000 + i, rows[i][1]) for i in range(20)] + [(1100 + i, rows[i][1] + " end") for i in range(2, 9)]
    rows += [rows[5], (1200, None), (1201, "")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(i, passage(i)) for i in range(4)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def word_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages(spark, corpus):
    """Each stage against a brute-force version of its decision on the same input."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = corpus_pipeline.materialize(stage(spark, docs, corpus), f"test-{name}")
        steps[name] = before, sorted((r["doc_id"], *((r["text"],) if name != "packing" else ())) for r in docs.collect())
        assert name == "packing" or docs.columns == columns
    before, after = steps["quality"]
    model = quality.train(spark.read.parquet(f"{corpus}/documents.parquet"), spark.read.parquet(f"{corpus}/labels.parquet"))
    good = [r for r in before if model.score(np.array([quality.shape((r[1] or "").encode())]))[0] >= 0.3]
    assert sorted(good, key=repr) == sorted(after, key=repr)
    assert not any("&&&" in (t or "") for _, t in after) and {i for i, _ in after} >= {i for i in range(240) if i % 6}
    before, after = steps["exact_dedup"]
    last = {}
    for i, text in before:
        last[text or ""] = max(last.get(text or "", i), i)
    assert sorted(last.values()) == [i for i, _ in after]
    before, after = steps["near_dedup"]
    sets = {i: word_shingles(t) for i, t in before}
    root = {i: i for i in sets}
    for one in sorted(sets):
        for two in sets:
            if one < two and root[one] != root[two] and len(sets[one] & sets[two]) >= 0.8 * len(sets[one] | sets[two]):
                low, high = sorted((root[one], root[two]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert sorted(set(root.values())) == [i for i, _ in after] and len(after) < len(before)
    before, after = steps["decontamination"]
    leaks = brute_leaks(before, [(i, passage(i)) for i in range(4)])
    assert {i for i, _ in after} == {i for i, _ in before} - {d for d, _ in leaks} and leaks
    before, pieces = steps["packing"]
    assert {i for i, _ in before} == {p[0] for p in pieces}


def test_run_is_all_stages(spark, corpus):
    from catalodge.llm.packing import pack

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, corpus), "test-run")
    want = {(r["doc_id"], r["doc_tokens"]) for r in pack(docs, TOKENIZER).collect()}
    assert {(r["doc_id"], r["doc_tokens"]) for r in corpus_pipeline.run(spark, corpus).collect()} == want


def test_stages_on_odd_documents(spark, corpus, odd_docs, no_docs):
    """Columns of any name pass; an empty table stays empty."""
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, corpus)
            assert name == "packing" or out.columns == docs.columns
            assert out.count() <= docs.count() or name == "packing"
    once = corpus_pipeline.drop_copies(spark, odd_docs, corpus)
    kept = exact_dedup(odd_docs, DigestIndex(spark, folder(spark), 4)).where("kept").select("doc_id", "text_sha256").distinct()
    assert once.count() == kept.count()
