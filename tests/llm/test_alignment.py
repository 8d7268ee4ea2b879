"""Alignment of two tokenizers against a plain version over whole token lists."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from texts import prose
from tokenizers import Tokenizer

from catalodge.llm import alignment
from catalodge.llm.pretokens import BYTE_SIGNS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "a  b\n\nc \t d  e  ",
    " ",
    "x▁y z",
    "\nfoo <|endoftext|> <s> <0x0A> é日本語 \n x\r\n",
    "naïve ﬁ　wide em​zero",
    "don't I'll  we've 's\x85q\x1c z",
    "tail\n",
    "  no break",
]


def ends(parts):
    at, found = 0, []
    for part in parts:
        at += len(part)
        found.append(at)
    return found


def plain(rows):
    """Result rows with their counts, from whole lists of tokens and links."""
    a_of, b_of = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_of.encode_special_tokens = True
    byte_of = {sign: byte for byte, sign in enumerate(BYTE_SIGNS)}
    told, counts = [], Counter()
    for doc_id, text in rows:
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        a_parts = [bytes(byte_of[s] for s in a_of.id_to_token(i)) for i in a]
        b_parts = [
            bytes([int(b_of.id_to_piece(i)[3:-1], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if text and not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
            a, b, a_parts, b_parts = [], [], [], []
        a_at, b_at = ({end: i for i, end in enumerate(ends(parts))} for parts in (a_parts, b_parts))
        groups, links, from_a, from_b = [], [], 0, 0
        for end in sorted(a_at.keys() & b_at.keys()):
            i, j = a_at[end] + 1, b_at[end] + 1
            groups.append(",".join(map(str, a[from_a:i])) + "|" + ",".join(map(str, b[from_b:j])))
            links.append((a[i - 1], b[j - 1]))
            from_a, from_b = i, j
        counts.update(links)
        told.append((doc_id, len(a), len(b), groups, links))
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return Counter(
        (
            doc_id,
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(counts[pair] == highest[pair[1]] for pair in links),
            sum(counts[pair] for pair in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for doc_id, n_a, n_b, groups, links in told
    )


def test_whole_documents(spark, odd_docs):
    odd = spark.createDataFrame(list(enumerate(ODD, 100)), "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(odd)
    want = plain([tuple(row) for row in docs.collect()])
    got = alignment.align(docs, A, B)
    assert got.columns == [field.split()[0] for field in alignment.ALIGNED.split(", ")]
    assert Counter(map(tuple, got.collect())) == want


def test_many_runs_and_levels_of_merges(spark):
    rows = [(i, prose(i % 40, 30 + i % 7)) for i in range(300)] + [(1000 + i, "the the the") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = alignment.align(docs, A, B, run_links=200, fan=3)
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_clashing_columns_and_empty_table(spark, odd_docs, no_docs):
    clash = odd_docs.withColumn("run", F.lit("x")).withColumn("answers", F.lit(1)).withColumn("parts", F.lit(2))
    assert alignment.align(clash, A, B).count() == odd_docs.count()
    assert alignment.align(no_docs, A, B).collect() == []


def test_bites_do_not_change_a_long_text(monkeypatch):
    texts = ["\n".join(prose(i, 50) + "  " for i in range(n)) for n in (60, 1, 0, 3, 25)] + [None, "x"]
    whole = list(alignment.Aligner(A, B).documents(texts))
    monkeypatch.setattr(alignment, "BITE", 400)
    monkeypatch.setattr(alignment, "KEPT_CHUNKS", 50)
    for one, two in zip(whole, alignment.Aligner(A, B).documents(texts), strict=True):
        assert one[:2] == two[:2]
        counted = [np.unique(np.repeat(t.keys, t.times), return_counts=True) for t in (one, two)]
        assert all((a == b).all() for a, b in zip(*counted, strict=True))


def test_text_is_not_cut_where_pieces_could_go_on():
    aligner = alignment.Aligner(A, B)
    assert aligner.may_cut and not aligner.cuts_at(["a▁b"]) and not aligner.cuts_at(["\n"])
    text = prose(1, 40) + "\n\n  x y\nz "
    cut = next(aligner.documents([text]))
    aligner.may_cut = False
    aligner.forget()
    whole = next(aligner.documents([text]))
    assert cut[:2] == whole[:2] and sorted(cut.keys) == sorted(whole.keys)


def test_heap_merge_and_totals(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 3)
    draw = np.random.default_rng(5)
    counted = []
    for _ in range(9):
        keys = np.unique([alignment.pair_key(int(a), int(b)) for a, b in draw.integers(0, 12, (draw.integers(0, 40), 2))]).astype(np.int64)
        counted.append((keys, draw.integers(1, 9, len(keys))))
    blobs = [alignment.pack(*one) for one in counted]
    total = Counter()
    for keys, counts in counted:
        total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    steps = list(alignment.merge(blobs))
    merged = [(k, n) for keys, sums, _ in steps for k, n in zip(keys.tolist(), sums.tolist(), strict=True)]
    assert merged == sorted(total.items())
    highest = Counter()
    for key, n in total.items():
        highest[key >> 24] = max(highest[key >> 24], n)
    for (keys, _), answer in zip(counted, alignment.totals(blobs), strict=True):
        assert alignment.unpack_values(answer).tolist() == [2 * total[k] + (total[k] == highest[k >> 24]) for k in keys.tolist()]
