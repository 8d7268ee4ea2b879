"""Linear-chain conditional random fields in numpy: marginals, expectations and best paths."""

from __future__ import annotations

import numpy as np

BLOCK = 64


def scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def chains(emissions: np.ndarray, lengths: np.ndarray, switch: np.ndarray) -> np.ndarray:
    """Forward-backward: the probability of each language for each word of sequences laid end to end.

    Long sequences are cut into blocks of BLOCK words. The product of a block's transition
    matrices carries the forward and backward messages over it, so that the words of all
    blocks are done side by side and the result is that of the plain recursion.
    """
    n = emissions.shape[1]
    weight = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    step = np.exp(switch - switch.max())
    blocks = (lengths + BLOCK - 1) // BLOCK
    total = int(blocks.sum())
    if not total:
        return np.zeros((0, n))
    doc = np.repeat(np.arange(len(lengths)), blocks)
    first = np.cumsum(blocks) - blocks
    place = np.arange(total) - first[doc]
    size = np.minimum(BLOCK, lengths[doc] - place * BLOCK)
    start = (np.cumsum(lengths) - lengths)[doc] + place * BLOCK
    # cells[t, b]: the weights of word t of block b; words behind a block's end are never read.
    rows = np.minimum(start[None] + np.arange(BLOCK)[:, None], len(weight) - 1)
    live = np.arange(BLOCK)[:, None] < size[None]
    cells = weight[rows]

    # carry[b]: from the language before the block to that of its last word. The first word
    # of a text has no transition.
    opening = place == 0
    carry = np.broadcast_to(np.eye(n), (total, n, n)).copy()
    if blocks.max() > 1:
        for t in range(BLOCK):
            moved = carry @ step if t else np.where(opening[:, None, None], np.eye(n), step)
            moved = moved * cells[t][:, None]
            moved /= moved.sum(axis=(1, 2), keepdims=True)
            carry = np.where(live[t][:, None, None], moved, carry)
    before, after = np.ones((total, n)) / n, np.ones((total, n)) / n
    for k in range(1, int(blocks.max())):
        at = np.flatnonzero(place == k)
        before[at] = scaled(np.einsum("bi,bij->bj", before[at - 1], carry[at - 1]))
    for k in range(int(blocks.max()) - 1, 0, -1):
        at = np.flatnonzero(place == k)
        after[at - 1] = scaled(np.einsum("bij,bj->bi", carry[at], after[at]))

    forward = np.empty((BLOCK, total, n))
    state = before
    for t in range(int(size.max())):
        moved = state @ step
        if t == 0:
            moved[opening] = 1.0
        state = np.where(live[t][:, None], scaled(moved * cells[t]), state)
        forward[t] = state
    state = after
    out = np.empty_like(weight)
    for t in reversed(range(int(size.max()))):
        inside = live[t]
        out[start[inside] + t] = scaled(forward[t][inside] * state[inside])
        state = np.where(inside[:, None], scaled((state * cells[t]) @ step.T), state)
    return out


def expected(emission: np.ndarray, switch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward on sequences of one length: word marginals, and expected transitions summed over all."""
    weight, step = np.exp(emission - emission.max(axis=2, keepdims=True)), np.exp(switch)
    s, length, n = emission.shape
    forward, backward = np.empty_like(weight), np.ones_like(weight) / n
    forward[:, 0] = scaled(weight[:, 0])
    for t in range(1, length):
        forward[:, t] = scaled((forward[:, t - 1] @ step) * weight[:, t])
    for t in range(length - 2, -1, -1):
        backward[:, t] = scaled((backward[:, t + 1] * weight[:, t + 1]) @ step.T)
    pair = forward[:, :-1, :, None] * step * (weight * backward)[:, 1:, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return scaled(forward * backward), pair.sum(axis=(0, 1))


def best_paths(emission: np.ndarray, lengths: np.ndarray, switch: np.ndarray) -> np.ndarray:
    """The best tag of each place of padded sequences (sequences, places, tags), by dynamic programming.

    Ties go to the lower tag. Places behind a sequence's length get tag 0.
    """
    rows, width, _ = emission.shape
    score = emission[:, 0].copy()
    come = np.zeros((width, rows, emission.shape[2]), np.int16)
    for t in range(1, width):
        live = t < lengths
        total = score[live][:, :, None] + switch[None]
        come[t, live] = total.argmax(axis=1)
        score[live] = total.max(axis=1) + emission[live, t]
    tags = np.zeros((rows, width), np.int64)
    now = score.argmax(axis=1)
    for t in range(width - 1, -1, -1):
        live = t < lengths
        tags[live, t] = now[live]
        now = np.where(live, come[t, np.arange(rows), now], now)
    return tags
