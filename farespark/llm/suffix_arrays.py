"""Suffix arrays by Larsson-Sadakane refinement and Kasai's common prefixes, in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a byte array.

    Suffixes are first ordered by seven bytes. Then only groups of equal rank
    are refined, by the rank of what follows, doubling the length each time.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    padded = np.concatenate([text.astype(np.uint64) + 1, np.zeros(8, np.uint64)])
    first = np.zeros(n, np.uint64)
    for i in range(7):  # nine bits a byte, so that an end sorts before byte 0
        first = (first << np.uint64(9)) | padded[i : i + n]
    order = np.argsort(first)
    head = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    h = 7
    while True:
        ends = np.concatenate([head[1:], [True]])
        open_ = np.flatnonzero(~(head & ends))  # places in groups of two or more
        if not len(open_):
            break
        p = order[open_]
        follow = np.where(p + h < n, rank[np.minimum(p + h, n - 1)] + 1, 0)
        mine = rank[p]
        key = mine * (n + 1) + follow  # under 2**63 for texts under 2**31 bytes
        by = np.argsort(key)
        p, key = p[by], key[by]
        order[open_] = p
        split = np.concatenate([[True], key[1:] != key[:-1]])
        head[open_] = split
        rank[p] = open_[np.flatnonzero(split)][np.cumsum(split) - 1]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int, lanes: int = 256) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it, up to ``most``; 0 for the first.

    Kasai's rule goes through the text from left to right and loses one byte
    a step. Here stretches of ``lanes`` places go side by side; each starts
    from nothing, so a stretch costs ``most`` comparisons more at most.
    """
    n = len(text)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(0, n, lanes)
    stop = np.minimum(at + lanes, n)
    held = np.zeros(len(at), np.int64)
    step = 16
    padded = np.concatenate([text.astype(np.int16), np.full(step, -1, np.int16)])
    width = np.arange(step)
    while len(at):
        j = before[at]
        a, b = at + held, j + held
        ok = (j >= 0) & (a < n) & (b < n) & (held < most)
        same = np.zeros(len(at), np.int64)
        if ok.any():
            x, y = a[ok], b[ok]
            eq = (padded[x[:, None] + width] == padded[y[:, None] + width]) & (x[:, None] + width < n) & (y[:, None] + width < n)
            same[ok] = np.where(eq.all(axis=1), step, eq.argmin(axis=1))
        held += same
        done = (same < step) | (held >= most)
        out[place[at[done]]] = np.minimum(held[done], most)
        at = at + done
        held = np.where(done, np.maximum(np.minimum(held, most) - 1, 0), held)
        go = at < stop
        at, stop, held = at[go], stop[go], held[go]
    return out


def repeated_windows(text: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each valid start: does its window of ``length`` bytes start at another valid place; number of its class.

    ``valid``: mask of the starts; a valid window lies within ``text``.
    """
    order = suffix_array(text)  # whole: Kasai's rule does not hold for suffixes that are ordered by some bytes only
    same = common_prefixes(text, order, length) >= length
    group = np.cumsum(~same) - 1
    live = valid[order]
    size = np.bincount(group[live], minlength=int(group[-1]) + 1 if len(group) else 0)
    repeated, names = np.zeros(len(text), bool), np.full(len(text), -1, np.int64)
    repeated[order] = live & (size[group] >= 2)
    names[order] = np.where(live, group, -1)
    return repeated, names
