import math
import random
import re

import numpy as np
import pytest
from texts import GERMAN, WORDS, prose

from catalodge.llm import language, pii, quality, toxicity
from catalodge.llm.common import bucket_of, fold
from catalodge.llm.crf import best_paths, chains, expected


def labelled(spark, n=400):
    """Documents whose signs say quality and whose insults say toxicity; every fifth insult is spelled with digits."""
    rows, labels = [], []
    for i in range(n):
        text = prose(i, 40)
        good, toxic = i % 4 != 0, i % 3 == 0
        if not good:
            text = " ".join(w + "&&&" for w in text.split())
        if toxic:
            text += " you stupid " + ("moron" if i % 5 else "m0ron") + " " + prose(i + n, 5)
        else:
            text += " " + prose(i + n, 8)
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_fold(spark):
    ids = [0, 5, 123456789012, -3]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(fold("doc_id", 5).alias("f")).collect()
    assert [r["f"] for r in got] == [bucket_of(i, 5) for i in ids]


def test_quality(spark, odd_docs, no_docs):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, model).collect()}
    held = [i for i in scored if bucket_of(i, 5) == 0]
    assert len(scored) == 400 and len(held) > 40
    assert all((scored[i] >= 0.3) == (i % 4 != 0) for i in held)
    assert {r["doc_id"] for r in quality.keep_good(docs, model).collect()} == {i for i in scored if scored[i] >= 0.3}
    got = quality.score_documents(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["score"] >= 0.3 for r in got)
    assert quality.score_documents(no_docs, model).count() == 0


def test_quality_without_two_labels(spark):
    docs, labels = labelled(spark, 40)
    for chosen, want in ((labels.limit(0), True), (labels.where("quality = 1"), True), (labels.where("quality = 0"), False)):
        got = quality.score_documents(docs, quality.train(docs, chosen)).collect()
        assert len(got) == 40 and all((r["score"] >= 0.3) == want for r in got)


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(spark, 100)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    one, two = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(one.weights, two.weights) and one.threshold == two.threshold


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    docs, labels = labelled(spark)
    tables = {}

    def noted(df, name):
        tables[name] = real(df, name)
        return tables[name]

    real = quality.materialize
    monkeypatch.setattr(quality, "materialize", noted)
    monkeypatch.setattr(quality, "BUCKET_ROWS", 50)
    monkeypatch.setattr(quality, "LEAST_IN_BUCKET", 8)
    model = quality.train(docs, labels)
    learned = [i for i in range(400) if bucket_of(i, 5) != 0]
    rows = {r["doc_id"]: r for r in tables["quality-rows"].collect()}
    assert sorted(rows) == learned
    packed = [np.frombuffer(r["labels"], np.int8) for r in tables["quality-buckets"].collect()]
    assert len(packed) > 3 and sum(map(len, packed)) >= len(learned)
    for k, found in enumerate(packed):
        winners, losers = quality._pairs(k, found, 10, 11)
        assert set(winners) == set(np.flatnonzero(found == 1)) and set(losers) == set(np.flatnonzero(found == 0))
    # The cut errs as little as any over all rows.
    strength = model.strength(np.array([rows[i]["shape"] for i in learned]))
    label = np.array([rows[i]["label"] for i in learned])
    errors = [((strength > cut) != (label == 1)).sum() for cut in (*strength, strength.min() - 1)]
    assert ((strength >= model.threshold) != (label == 1)).sum() == min(errors)


def test_preferences_decide():
    draw = np.random.default_rng(0)
    shapes = draw.random((600, 3))
    labels = (shapes[:, 1] > 0.4).astype(int)
    model = quality.fit(shapes, labels, float(labels.mean()), 0.3)
    strength = model.strength(shapes)
    good, bad = strength[labels == 1], strength[labels == 0]
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert ((model.score(shapes) >= 0.3) == (labels == 1)).mean() > 0.95


def test_toxicity(spark, odd_docs, no_docs):
    docs, labels = labelled(spark, 600)
    model = toxicity.train(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, model).collect()}
    held = [i for i in scored if bucket_of(i, 5) == 0]
    assert np.mean([(scored[i] >= 0.5) == (i % 3 == 0) for i in held]) > 0.97
    got = toxicity.toxicity(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] < 0.5 for r in got)
    assert toxicity.toxicity(no_docs, model).count() == 0


def test_toxicity_without_labels(spark):
    docs, labels = labelled(spark, 20)
    for chosen in (labels.limit(0), labels.where("toxic = 1")):
        got = toxicity.toxicity(docs, toxicity.train(docs, chosen)).collect()
        assert len(got) == 20 and all(0 <= r["score"] <= 1 for r in got)


def test_obfuscated_words_and_nearness():
    words = toxicity.Words({})
    codes = next(words.codes([b"YOU are an 1d10t, stup1d SCUM"]))
    assert [bool(c & toxicity.ADDRESSED) for c in codes] == [True, False, False, False, False, False]
    assert [bool(c & toxicity.DISGUISED) for c in codes] == [False, False, False, True, True, False]
    assert codes[5] & toxicity.LEXICON and codes[5] & toxicity.CAPITALS
    for hits, address in (([3, 9], [1, 5]), ([4], [4 + 7]), ([4], [4]), ([], [1]), ([2], [])):
        want = max((1 / max(1, abs(h - a)) for h in hits for a in address), default=0.0)
        assert toxicity.nearness(np.array(hits, int), np.array(address, int)) == pytest.approx(want)


def test_isotonic_is_the_best_monotone_fit():
    x, y = np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1])
    knots, values = toxicity.isotonic(x, y, np.ones(5))
    assert list(values) == [0, 0.5, 1] and list(knots[:2]) == [1, 2]


def slow_chain(e, switch):
    n = len(e)
    paths = {(): 0.0}
    for t in range(n):
        paths = {p + (k,): v + e[t, k] + (switch[p[-1], k] if p else 0) for p, v in paths.items() for k in range(e.shape[1])}
    total = sum(math.exp(v) for v in paths.values())
    out = np.zeros_like(e)
    for p, v in paths.items():
        for t, k in enumerate(p):
            out[t, k] += math.exp(v) / total
    return out, max(paths, key=lambda p: (paths[p], [-k for k in p]))


def test_chains_equal_enumeration(monkeypatch):
    monkeypatch.setattr("catalodge.llm.crf.BLOCK", 2)
    draw = np.random.default_rng(3)
    lengths = np.array([3, 0, 1, 7, 2])
    e, switch = draw.normal(size=(lengths.sum(), 3)), draw.normal(size=(3, 3))
    got, at = chains(e, lengths, switch), 0
    padded = np.zeros((5, 7, 3))
    for k, n in enumerate(lengths):
        padded[k, :n] = e[at : at + n]
        if n:
            share, best = slow_chain(e[at : at + n], switch)
            assert np.allclose(got[at : at + n], share)
            assert tuple(best_paths(padded, lengths, switch)[k, :n]) == best
        at += n
    node, edge = expected(padded[3:4], switch)
    assert np.allclose(node[0], slow_chain(padded[3], switch)[0]) and edge.sum() == pytest.approx(6)


def test_every_language_is_a_class(spark):
    """More than 64 languages, one of which has long documents only."""
    rows = []
    for k in range(66):
        own = [f"{chr(945 + k % 24)}{chr(1072 + k % 31)}{x}" for x in ("a", "be", "ci", "do", "fum")]
        rows += [(100 * k + j, prose(100 * k + j, 5000 if k == 65 else 20, own), f"l{k:02}") for j in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(len(t.encode()) > language.SAMPLE_BYTES for _, t, lang in rows if lang == "l65")
    model = language.train(docs)
    assert model.languages == sorted({lang for _, _, lang in rows})
    got = {r["doc_id"]: r["lang_pred"] for r in language.languages(docs, model).collect()}
    held = [(i, lang) for i, _, lang in rows if bucket_of(i, 4) == 2]
    assert np.mean([got[i] == lang for i, lang in held]) > 0.95
    assert all(got[i] == "l65" for i, _, lang in rows if lang == "l65")
    assert language.whole_words([b"a bc d", b"e fg h", b"xyz", b"i jk"]) == [b"a bc", b"fg", b"xyz", b"jk"]


def test_repeated_training_rows_count_once(spark):
    rows = [(1, prose(1), "en")] * 300 + [(i, prose(i, 30, GERMAN), "de") for i in range(2, 6)]
    docs = spark.createDataFrame([(d + 100, t, lang) for d, t, lang in rows], "doc_id long, text string, lang string")
    once = docs.dropDuplicates()
    one, two = (language.train(d, folds=1, held=5) for d in (docs, once))
    assert one.languages == two.languages and np.array_equal(one.switch, two.switch)


def test_language(spark, odd_docs, no_docs):
    rows = [(i, prose(i, 30, GERMAN if i % 2 else WORDS), "de" if i % 2 else "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    got = {r["doc_id"]: r for r in language.languages(docs, model).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in rows if bucket_of(i, 4) == 2]) > 0.97
    # Words of a switched text are labelled each: the score is the share of the language.
    mixed = spark.createDataFrame([(1, prose(900, 90) + " " + prose(901, 30, GERMAN))], "doc_id long, text string")
    row = language.languages(mixed, model).first()
    assert row["lang_pred"] == "en" and 0.65 < row["score"] < 0.85
    odd = language.languages(odd_docs, model).collect()
    assert len(odd) == odd_docs.count()
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} == {2, 3, 4}
    assert all(0 <= r["score"] <= 1 for r in odd)
    assert language.languages(no_docs, model).count() == 0
    unknown = language.train(no_docs)
    assert {r["lang_pred"] for r in language.languages(odd_docs, unknown).collect()} == {"und"}


def test_word_features_mark_affixes():
    owner, feature = language.word_features(["abcd", "ab", "é"], {"ab": 0})
    of = [set(feature[owner == k].tolist()) for k in range(3)]
    assert of[0] & of[1] and not of[2] & of[0]
    assert (1 << language.HASH_BITS) in of[1]
    again = language.word_features(["zz", "abcd"], {})
    assert set(again[1][again[0] == 1].tolist()) == of[0]


PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def slow_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_patterns():
    draw = random.Random(5)
    for alphabet in ("0123456789.- ", "ab@.-1 ", "+()12 -.", "1.2", "12@a.+ -"):
        for _ in range(1500):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(60)))
            assert pii.base_spans(text) == slow_spans(text)
    assert pii.base_spans("1" * 200_000 + "@" * 10_000 + "." * 10_000) == []


@pytest.fixture(scope="module")
def network():
    draw = random.Random(8)
    texts = []
    for i in range(300):
        value = (
            f"{draw.choice('abcde')}o.{i}@mail{i % 9}.example.com",
            f"{draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}",
            f"+1 ({draw.randrange(900) + 99}) 555-{draw.randrange(9000) + 1000}",
        )[i % 3]
        texts.append(f"{prose(i, 30)} {value} {prose(i + 999, 30)}")
    return pii.train_network(*pii.training_windows(texts))


def test_long_runs_of_zeros_and_odd_digits_in_addresses():
    zeros = "0" * 5000
    assert pii.base_spans(f"x 1.2.3.{zeros} y") == [(2, 1, 8 + len(zeros))]
    assert pii.base_spans(f"x 1.2.3.{zeros}256 y") == [] == pii.base_spans("1.2.3." + "9" * 5000)
    assert not pii.valid(1, "1.2.3.²", 0, 7) and not pii.valid(1, "1.2.3.٣", 0, 7) and pii.valid(1, "1.2.3.4", 0, 7)


def test_network_adds_what_patterns_miss(network):
    text = f"{prose(1, 40)} jo.81 (at) mail3 (dot) example.com {prose(2, 40)}"
    (own, every), (_, clean) = pii.all_spans(network, [text, prose(77, 400) + " in 2024, version 2.0"])
    assert own == [] and clean == []
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in every] == [("email", "jo.81 (at) mail3 (dot) example.com")]


def test_windows_agree_with_one_window(network):
    part = f"{prose(3, 8)} co.7@mail1.example.com on"[: pii.WINDOW]
    whole = pii.blended(network, [part])[0]
    x = np.full((1, pii.WINDOW), pii.PADDING)
    x[0, : len(part)] = pii.symbols(part)
    assert np.allclose(whole, pii.scores(network, x)[0, : len(part)], atol=1e-4)
    assert len(pii.blended(network, [part * 5])[0]) == 5 * len(part)


def test_gradient_is_the_slope():
    draw = np.random.default_rng(1)
    x, y = draw.integers(1, 90, (4, 12)), draw.integers(0, pii.TAGS, (4, 12))
    net = pii.Network(
        draw.normal(0, 0.3, (2, pii.SYMBOLS, 4 * pii.HIDDEN)).astype(np.float32),
        draw.normal(0, 0.2, (2, pii.HIDDEN, 4 * pii.HIDDEN)).astype(np.float32),
        draw.normal(0, 0.2, (2 * pii.HIDDEN, pii.TAGS)).astype(np.float32),
        np.zeros(pii.TAGS, np.float32),
        draw.normal(0, 0.2, (pii.TAGS, pii.TAGS)).astype(np.float32),
    )

    def loss(n):
        e, total = pii.scores(n, x).astype(float), 0.0
        for row, tags in zip(e, y, strict=True):
            alpha = row[0]
            for t in range(1, len(row)):
                alpha = np.log(np.exp(alpha[:, None] + n.switch).sum(axis=0)) + row[t]
            gold = row[np.arange(len(row)), tags].sum() + n.switch[tags[:-1], tags[1:]].sum()
            total += np.log(np.exp(alpha).sum()) - gold
        return total / len(x)

    grad = pii.gradient(net, x, y)
    for p, g in zip(net, grad, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, p[at] = p[at], p[at] + 1e-2
        up = loss(net)
        p[at] = old - 1e-2
        down = loss(net)
        p[at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(g[at]), rel=0.05)


def test_no_valid_span_of_a_full_decode_is_lost(network):
    """What a decode of whole texts finds is found, and all that counts as an address lies in a stretch."""
    at = ["Jane (AT) example (DOT) com", "jane [AT] example.com", "jane at example.com", "jo (At) mail (Dot) example.com", f"{'j' * 60} at mail dot example dot com"]
    texts = [f"{prose(60 + k, 30)} {value} {prose(80 + k, 30)}" for k, value in enumerate(at)]
    for value, text in zip(at, texts, strict=True):
        s = text.index(value)
        assert pii.valid(0, text, s, s + len(value))
        assert any(a <= s and s + len(value) <= b for a, b in pii.stretches(text))
    for text, (_, every) in zip(texts, pii.all_spans(network, texts), strict=True):
        for s, kind, e, sure in pii.decode(network, [text])[0]:
            span = text[s:e].rstrip(".,;: ")
            s = s + len(span) - len(span.lstrip())
            e = s + len(span.lstrip())
            if sure >= pii.SURE and pii.valid(kind, text, s, e):
                assert any(a < e and s < b for a, _, b in every)
    assert any(every for _, every in pii.all_spans(network, texts))


def test_personal_data(spark, odd_docs, no_docs, network):
    rows = {}
    for r in odd_docs.collect():
        rows.setdefault(r["doc_id"], []).append(slow_spans(r["text"] or ""))
    got = pii.personal_data(odd_docs, network).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        spans = rows[r["doc_id"]].pop() if len(rows[r["doc_id"]]) > 1 else rows[r["doc_id"]][0]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for _, k, _ in spans) for x in range(4)]
        assert set(pii.joined(spans).split(",")) - {""} <= set(r["spans"].split(","))
    assert next(r for r in got if r["doc_id"] == 11)["spans"].count("email") == 1
    assert pii.personal_data(no_docs, network).count() == 0
    assert pii.train(no_docs) is None
    assert all(r["n_added"] == 0 for r in pii.personal_data(odd_docs, None).collect())
