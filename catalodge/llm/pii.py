"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans. The network is trained in numpy on spans that are
labelled by the patterns in a bounded sample of documents, and on spans made from those
so that the patterns miss them. Text around digits, at signs and spelled-out signs, without
one of which no span is a valid value, is cut into overlapping windows; their scores are
blended and one best path over the whole stretch decides. A network span is added where it
overlaps no other and is a valid value.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import column, hash_share, slices, text_of
from catalodge.llm.crf import best_paths, chains, expected

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns of the base spans.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Bounds of the training sample, and the size and schedule of the network.
SAMPLE_DOCS, SAMPLE_CHARS = 3000, 1 << 14
WINDOW, STRIDE, MARGIN = 96, 48, 40
HIDDEN, TAGS = 20, 1 + 2 * len(KINDS)
TRAIN_WINDOWS, BATCH, ROUNDS, STEP = 1536, 64, 10, 0.02
AT_ONCE = 512
SURE = 0.9

# What every valid span holds: a digit, or an at sign as valid() takes it. Dots written as words widen a stretch.
AT = re.compile(r"@|[(\[{ ]at[)\]} ]", re.IGNORECASE)
TRIGGER = re.compile(rf"\d+|{AT.pattern}|[(\[{{ ]dot[)\]}} ]", re.IGNORECASE)
PADDING, OTHER_LETTER, OTHER = 0, 96, 97
SYMBOLS = 98


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches that are valid, leftmost and non-overlapping within a kind."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        # A match ends with the longest domain and starts as far left as its local part goes.
        domain, start = DOMAIN.match(text, at), at
        while domain and start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            done = domain.end()
            found.append((start, 0, done))
        at = text.find("@", max(done, at + 1))
    for run in DOTTED.finditer(text):
        parts, place = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = ".".join(parts[k : k + 4])
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in parts[k : k + 4])):
                found.append((place, 1, place + len(four)))
            place += len(four) + 1
    found += [(m.start(), 2, m.end()) for m in DIGITS.finditer(text) if m.end() - m.start() > 11 and is_card(m[0])]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(found)


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text in which a span can lie: MARGIN characters around what every span holds one of, and on to the next blank."""
    merged: list[tuple[int, int]] = []
    for mark in TRIGGER.finditer(text):
        start, end = max(0, mark.start() - MARGIN), min(len(text), mark.end() + MARGIN)
        floor = merged[-1][1] if merged else 0
        while start > floor and not text[start - 1].isspace():
            start -= 1
        if not merged or end > floor:
            while end < len(text) and not text[end].isspace():
                end += 1
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def symbols(text: str) -> list[int]:
    """Characters as numbers: printable ASCII each, other letters and all else as one."""
    return [ord(c) - 31 if " " <= c <= "~" else OTHER_LETTER if c.isalpha() else OTHER for c in text]


class Network(NamedTuple):
    """A bidirectional LSTM over one-hot characters, a linear layer and CRF transitions.

    `table[d, symbol]` and `state[d]` are the input and recurrent weights of direction d;
    gates lie side by side: input, forget, output, candidate.
    """

    table: np.ndarray
    state: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    switch: np.ndarray


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def run_cells(net: Network, x: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states of both directions, (2, windows, places, HIDDEN), the second in reading order too."""
    n, width = x.shape
    both = np.stack((x, x[:, ::-1]))
    h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    states = np.empty((2, n, width, HIDDEN), np.float32)
    for t in range(width):
        z = h @ net.state
        z[0] += net.table[0][both[0, :, t]]
        z[1] += net.table[1][both[1, :, t]]
        gates, fresh = sigmoid(z[:, :, : 3 * HIDDEN]), np.tanh(z[:, :, 3 * HIDDEN :])
        i, f, o = gates[:, :, :HIDDEN], gates[:, :, HIDDEN : 2 * HIDDEN], gates[:, :, 2 * HIDDEN :]
        old_c, old_h = c, h
        c = f * c + i * fresh
        bent = np.tanh(c)
        h = o * bent
        states[:, :, t] = h
        if trace is not None:
            trace.append((i, f, o, fresh, old_c, old_h, bent))
    states[1] = states[1][:, ::-1]
    return states


def scores(net: Network, x: np.ndarray) -> np.ndarray:
    """Tag scores of each place, (windows, places, TAGS)."""
    states = run_cells(net, x)
    return np.concatenate((states[0], states[1]), axis=2) @ net.out + net.bias


def gradient(net: Network, x: np.ndarray, tags: np.ndarray) -> Network:
    """Gradient of the mean negative log likelihood of the tags."""
    trace: list = []
    states = run_cells(net, x, trace)
    joined = np.concatenate((states[0], states[1]), axis=2)
    node, edge = expected((joined @ net.out + net.bias).astype(np.float64), net.switch.astype(np.float64))
    gold = np.eye(TAGS)[tags]
    node = ((node - gold) / len(x)).astype(np.float32)
    edge = (edge - np.einsum("sti,stj->ij", gold[:, :-1], gold[:, 1:])) / len(x)
    back = node @ net.out.T
    n, width = x.shape
    both = np.stack((x, x[:, ::-1]))
    into = np.stack((back[:, :, :HIDDEN], back[:, ::-1, HIDDEN:]))
    d_table, d_state = np.zeros_like(net.table), np.zeros_like(net.state)
    dh, dc = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    for t in reversed(range(width)):
        i, f, o, fresh, old_c, old_h, bent = trace[t]
        dh = dh + into[:, :, t]
        dc = dc + dh * o * (1 - bent**2)
        dz = np.concatenate(
            (dc * fresh * i * (1 - i), dc * old_c * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - fresh**2)), axis=2
        )
        d_state += old_h.transpose(0, 2, 1) @ dz
        for d in (0, 1):
            np.add.at(d_table[d], both[d, :, t], dz[d])
        dh, dc = dz @ net.state.transpose(0, 2, 1), dc * f
    return Network(
        d_table,
        d_state,
        np.einsum("stf,stk->fk", joined, node),
        node.sum(axis=(0, 1)),
        edge.astype(np.float32),
    )


def train_network(x: np.ndarray, tags: np.ndarray, seed: int = 3) -> Network:
    draw = np.random.default_rng(seed)
    wide = 4 * HIDDEN
    net = Network(
        draw.normal(0, 0.3, (2, SYMBOLS, wide)).astype(np.float32),
        draw.normal(0, 0.2, (2, HIDDEN, wide)).astype(np.float32),
        draw.normal(0, 0.2, (2 * HIDDEN, TAGS)).astype(np.float32),
        np.zeros(TAGS, np.float32),
        np.zeros((TAGS, TAGS), np.float32),
    )
    mean, spread = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    steps = ROUNDS * ((len(x) + BATCH - 1) // BATCH)
    done = 0
    for _ in range(ROUNDS):
        order = draw.permutation(len(x))
        for a in range(0, len(x), BATCH):
            some = order[a : a + BATCH]
            done += 1
            rate = STEP * (1 - 0.95 * done / steps)
            for p, g, m, v in zip(net, gradient(net, x[some], tags[some]), mean, spread, strict=True):
                g = np.clip(g, -5, 5)
                m += 0.1 * (g - m)
                v += 0.01 * (g**2 - v)
                p -= rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.99**done)) + 1e-6)
    return net


def variant(draw: np.random.Generator, kind: int, span: str) -> str:
    """The same value written so that the pattern of its kind misses it."""
    if kind == 0:
        name, _, domain = span.partition("@")
        at, dot = ((" (at) ", "."), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" at ", " dot "), (" @ ", "."), ("{at}", "{dot}"))[draw.integers(6)]
        return name + at + domain.replace(".", dot)
    if kind == 1:
        return span
    if kind == 2:
        digits = digits_of(span)
        sign = (".", " - ", "  ", "/")[draw.integers(4)]
        return sign.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return ("00" + span[1:], span[1:].lstrip("0123456789 "), "tel " + span[1:], span.replace(" ", "/"))[draw.integers(4)]


def training_windows(texts: list[str], seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the texts with tags: base spans as they are, variants of them, and digits that are nobody's data."""
    draw = np.random.default_rng(seed)
    spans, plain = [], []
    for text in texts:
        own = base_spans(text)
        spans += [(text, s, k, e) for s, k, e in own]
        plain += [(text, a, b) for a, b in stretches(text) if not any(s < b and e > a for s, _, e in own)]
        if not own and len(text) > WINDOW:
            at = int(draw.integers(len(text) - WINDOW))
            plain.append((text, at, at + WINDOW))
    x, y = [], []

    def add(text: str, marks: list[tuple[int, int, int]], around: int) -> None:
        start = max(0, around - int(draw.integers(16, WINDOW - 16)))
        chars, tags = np.full(WINDOW, PADDING), np.zeros(WINDOW, np.int64)
        part = text[start : start + WINDOW]
        chars[: len(part)] = symbols(part)
        for s, k, e in marks:
            a, b = max(0, s - start), min(WINDOW, e - start)
            if a < b:
                tags[a:b] = 2 + 2 * k
                if s >= start:
                    tags[a] = 1 + 2 * k
        x.append(chars)
        y.append(tags)

    by_kind = [[s for s in spans if s[2] == k] for k in range(len(KINDS))]
    for n in range(TRAIN_WINDOWS):
        have = [k for k in by_kind if k]
        if plain and (n % 3 == 0 or not have):
            text, a, b = plain[int(draw.integers(len(plain)))]
            own = base_spans(text)
            add(text, own, int(draw.integers(a, max(a + 1, b))))
        elif have:
            kind = have[int(draw.integers(len(have)))]
            text, s, k, e = kind[int(draw.integers(len(kind)))]
            if n % 3 == 1:
                add(text, base_spans(text), s)
            else:
                other = variant(draw, k, text[s:e])
                add(text[:s] + other + text[e:], [(s, k, s + len(other))], s)
    return np.array(x), np.array(y)


def train(docs: DataFrame, text: str = "text") -> Network | None:
    """A network from about SAMPLE_DOCS of the documents that hold a digit or an at sign, of SAMPLE_CHARS at most.

    None if none of them has a base span: then there is nothing to learn from, and only
    base spans are reported. The sample is chosen by a hash of the ids.
    """
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("body"))
    usable = body.where((F.length("body") <= SAMPLE_CHARS) & F.col("body").rlike("[0-9@]"))
    rows = usable.where(hash_share("doc_id", SAMPLE_DOCS / max(1, usable.count())))
    texts = [t for _, t in sorted((r["doc_id"] or 0, r["body"]) for r in rows.toLocalIterator())]
    if not any(base_spans(t) for t in texts):
        return None
    return train_network(*training_windows(texts))


def valid(kind: int, text: str, start: int, end: int) -> bool:
    """Whether a span of the network is a whole value of its kind."""
    span = text[start:end]
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return False
    digits = digits_of(span)
    if kind == 0:
        low = span.lower()
        return bool(AT.search(span) and re.search(r"\.[a-z]|dot", low) and re.match(r"[a-z0-9]", low) and len(span) >= 8)
    if kind == 1:
        parts = span.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return is_card(span) and not re.search(r"[^0-9 ./-]", span)
    return 9 <= len(digits) <= 15 and len(re.findall(r"[ ()/.-]+", span)) >= 2 and not re.search(r"[^0-9 +()/.-]", span)


def blended(net: Network, parts: list[str]) -> list[np.ndarray]:
    """Tag scores of stretches of text: windows overlap, and a place's scores are weighted by how far it is from a window's end."""
    weight = (1 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)
    places = [(p, a) for p, part in enumerate(parts) for a in range(0, max(1, len(part) - (WINDOW - STRIDE)), STRIDE)]
    totals = [np.zeros((len(part), TAGS), np.float32) for part in parts]
    norms = [np.zeros(len(part), np.float32) for part in parts]
    coded = [symbols(part) for part in parts]
    for at in range(0, len(places), AT_ONCE):
        some = places[at : at + AT_ONCE]
        x = np.full((len(some), WINDOW), PADDING)
        for row, (p, a) in enumerate(some):
            piece = coded[p][a : a + WINDOW]
            x[row, : len(piece)] = piece
        for (p, a), found in zip(some, scores(net, x), strict=True):
            n = min(WINDOW, len(parts[p]) - a)
            totals[p][a : a + n] += found[:n] * weight[:n, None]
            norms[p][a : a + n] += weight[:n]
    return [total / norm[:, None] for total, norm in zip(totals, norms, strict=True)]


def decode(net: Network, parts: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """(start, kind, end, sureness) of the spans on the best path over each whole stretch."""
    found: list[list] = [[] for _ in parts]
    blends = blended(net, parts)
    order = sorted(range(len(parts)), key=lambda p: len(parts[p]))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and stop - at < AT_ONCE and len(parts[order[stop]]) <= 1.5 * len(parts[order[at]]):
            stop += 1
        some = order[at:stop]
        lengths = np.array([len(parts[p]) for p in some])
        padded = np.zeros((len(some), lengths.max(), TAGS), np.float32)
        for row, p in enumerate(some):
            padded[row, : lengths[row]] = blends[p]
        paths = best_paths(padded, lengths, net.switch)
        shares = chains(np.concatenate([blends[p] for p in some]).astype(np.float64), lengths, net.switch.astype(np.float64))
        ends = np.cumsum(lengths)
        for row, tags in enumerate(paths):
            tags, p = tags[: lengths[row]], some[row]
            if not tags.any():
                continue
            share, start = shares[ends[row] - lengths[row] : ends[row]], 0
            for t in range(1, len(tags) + 1):
                kind = (tags[start] - 1) // 2
                if t == len(tags) or tags[t] == 0 or (tags[t] - 1) // 2 != kind or tags[t] % 2:
                    if tags[start]:
                        own = share[start:t, 1 + 2 * kind : 3 + 2 * kind].sum(axis=1)
                        found[p].append((start, int(kind), t, float(own.mean())))
                    start = t
        at = stop
    return found


def all_spans(net: Network | None, texts: list[str]) -> list[tuple[list, list]]:
    """For each text its base spans, and those together with what the network adds, as (start, kind, end)."""
    base = [base_spans(text) for text in texts]
    if net is None:
        return [(own, own) for own in base]
    where = [(k, a, b) for k, text in enumerate(texts) for a, b in stretches(text)]
    added: list[list] = [[] for _ in texts]
    for (k, a, _), spans in zip(where, decode(net, [texts[k][a:b] for k, a, b in where]), strict=True):
        for s, kind, e, sure in spans:
            s, e = s + a, e + a
            while s < e and texts[k][s].isspace():
                s += 1
            while e > s and (texts[k][e - 1].isspace() or texts[k][e - 1] in ".,;:"):
                e -= 1
            if sure >= SURE and valid(kind, texts[k], s, e):
                added[k].append((s, kind, e))
    out = []
    for own, more in zip(base, added, strict=True):
        # Base spans stay. Both lists are sorted, so one pass finds what overlaps.
        kept, at, reach = [], 0, -1
        for s, kind, e in more:
            while at < len(own) and own[at][0] < e:
                reach = max(reach, own[at][2])
                at += 1
            if reach <= s:
                kept.append((s, kind, e))
        out.append((own, sorted(own + kept)))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{s}:{e}" for s, kind, e in spans)


def personal_data(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """For each row: doc_id, counts of base spans by kind, base_sha256, spans, n_added.

    `spans` lists base spans and those that the network adds, as kind:start:end in code
    points by start, then kind. Null counts as empty, which has no span. Rows that repeat
    keep a row each, an empty table gives an empty result, other columns are not read.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, rows = column(batch, "body"), []
            for at in range(0, len(texts), 256):
                for own, every in all_spans(net, texts[at : at + 256]):
                    counts = [sum(kind == k for _, kind, _ in own) for k in range(len(KINDS))]
                    digest = hashlib.sha256(joined(own).encode()).hexdigest()
                    rows.append((*counts, digest, joined(every), len(every) - len(own)))
            if rows:
                ids = batch.column(batch.schema.get_field_index("doc_id"))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                arrays = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *arrays], [f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("body")).mapInArrow(run, schema)
