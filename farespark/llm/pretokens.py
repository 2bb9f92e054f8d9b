"""Pre-tokenisation of byte-level BPE without a regular expression, over arrays of code points.

The pattern is that of the public byte-level vocabularies: contractions,
letters, digits and other signs each with one space before them, white space.
Every code point has a class, and a class is a transition function of a small
automaton. Functions compose associatively, so the states of a whole batch
come from a blocked prefix scan: the functions that compositions can reach are
numbered (under twenty), a composition is one look-up in their table, blocks
are scanned side by side, and the blocks' totals are scanned in turn. A
boundary then depends on the states and classes next to it.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

# Classes of code points.
WHITE, SPACE, LETTER, NUMBER, SIGN, QUOTE, SHORT, R_OR_V, E, L, END = range(11)
# States: what the code point before belongs to. AFTER_QUOTE, AFTER_RV and AFTER_L wait for the rest of a contraction, DONE ends one.
IN_WHITE, IN_SPACE, IN_LETTER, IN_NUMBER, IN_SIGN, AFTER_QUOTE, AFTER_RV, AFTER_L, DONE = range(9)
N_STATES = 9
END_POINT = 0x110000
# White space of the pattern (fixed values: the Unicode property White_Space).
_WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


# The letters and the numbers that Unicode 16.0, which both tokenizer libraries follow, has beyond Unicode 15.1, by range.
_LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
_NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


@functools.cache
def classes() -> np.ndarray:
    """Class of each code point; END_POINT separates texts."""
    out = np.full(END_POINT + 1, SIGN, np.uint8)
    for c in range(END_POINT):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    for ranges, kind in ((_LETTERS_16, LETTER), (_NUMBERS_16, NUMBER)):
        for first, last in ranges:
            out[first : last + 1] = kind
    out[_WHITE] = WHITE
    for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", SHORT), ("rv", R_OR_V), ("e", E), ("l", L)):
        out[[ord(c) for c in chars]] = kind
    out[END_POINT] = END
    return out


def _step(state: int, kind: int) -> int:
    if kind in (WHITE, END):
        return IN_WHITE
    if kind == SPACE:
        return IN_SPACE
    if kind == NUMBER:
        return IN_NUMBER
    if kind == SIGN:
        return IN_SIGN
    if kind == QUOTE:  # it can open a contraction only where a token starts
        return IN_SIGN if state in (IN_SPACE, IN_SIGN, AFTER_QUOTE) else AFTER_QUOTE
    if state == AFTER_QUOTE:
        return {SHORT: DONE, R_OR_V: AFTER_RV, L: AFTER_L}.get(kind, IN_LETTER)
    if (state, kind) in ((AFTER_RV, E), (AFTER_L, L)):
        return DONE
    return IN_LETTER


@functools.cache
def functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(compose, apply, of_class): compose[f, g] is f, then g; apply[f, state]; the functions are those that compositions of classes reach."""
    made = [tuple(_step(s, k) for s in range(N_STATES)) for k in range(END + 1)]
    known: dict[tuple, int] = {}
    names = [known.setdefault(f, len(known)) for f in made]
    todo = list(known)
    generators = list(known)
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    every = np.array(list(known), np.int32)
    compose = np.array([[known[tuple(every[g][every[f]])] for g in range(len(every))] for f in range(len(every))], np.int32)
    return compose, every, np.array(names, np.int32)


_BLOCK = 64


@functools.cache
def _tables() -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Number of functions m; m * compose and apply as look-up tables at f * m + g and f * m + state; m * function of a class."""
    compose, apply, names = functions()
    m = max(len(compose), N_STATES)
    chain, state = np.zeros((len(compose), m), np.intp), np.zeros((len(compose), m), np.intp)
    chain[:, : len(compose)] = compose * m
    state[:, :N_STATES] = apply
    return m, chain.ravel(), state.ravel(), names.astype(np.intp)


def states(f: np.ndarray, start: int = IN_WHITE) -> np.ndarray:
    """The state after each of the functions ``f`` (numbers), applied in turn from ``start``."""
    m, chain, state, _ = _tables()
    n = len(f)
    if n <= _BLOCK:
        out = np.empty(n, np.uint8)
        for i, g in enumerate(f.tolist()):
            out[i] = start = state[g * m + start]
        return out
    blocks = -(-n // _BLOCK)
    cols = np.zeros(blocks * _BLOCK, np.intp)
    cols[:n] = f
    cols = np.ascontiguousarray(cols.reshape(blocks, _BLOCK).T)
    cols[0] *= m
    for i in range(1, _BLOCK):
        np.add(cols[i], cols[i - 1], out=cols[i])
        np.take(chain, cols[i], out=cols[i], mode="clip")
    at = np.empty(blocks, np.intp)
    at[0] = start
    at[1:] = states(cols[-1, :-1] // m, start)
    cols += at
    return state.astype(np.uint8).take(cols.T.ravel()[:n], mode="clip")


def starts(points: np.ndarray) -> np.ndarray:
    """True where a token starts. ``points``: code points of texts, END_POINT after each text."""
    if not len(points):
        return np.zeros(0, bool)
    kind = classes()[points]
    state = states(_tables()[3][kind])
    n = len(points)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = IN_WHITE, state[:-1]
    last = np.empty(n, np.uint8)
    last[0], last[1:] = END, kind[:-1]
    follows = np.full(n, END, np.uint8)
    follows[:-1] = kind[1:]
    white = (kind == WHITE) | (kind == SPACE)
    was_white = (last == WHITE) | (last == SPACE)
    # White space: a new run, or the last of a run before something else.
    out = white & (~was_white | ((follows != WHITE) & (follows != SPACE) & (follows != END)))
    # Others: a space before belongs to them; else the kind of token changes.
    what = np.array([0, 0, 1, 2, 3, 3, 1, 1, 1, 1, 4], np.uint8)
    mine, other = what[kind], ~white & (kind != END)
    done = state == DONE
    later = np.zeros(n, bool)
    later[:-1] = done[1:]
    completes = done | (((state == AFTER_RV) | (state == AFTER_L)) & later)
    token = np.array([0, 0, 1, 2, 3, 3, 1, 1, 5], np.uint8)[before]
    changed = (token != mine) & (before != IN_SPACE)
    changed &= ~((before == AFTER_QUOTE) & completes)
    changed &= ~(((before == AFTER_RV) | (before == AFTER_L)) & done)
    out |= other & changed
    out |= (last == END) & (kind != END)
    return out


def split_batch(texts: list[str]) -> list[list[str]]:
    """The pre-tokens of each text; joined they are the text."""
    out: list[list[str]] = []
    for part in _parts(texts):
        points = np.frombuffer("".join(t + "\0" for t in part).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.fromiter((len(t) + 1 for t in part), np.int64, len(part))
        ends = np.cumsum(sizes)
        points[ends - 1] = END_POINT
        at = np.flatnonzero(starts(points))
        cut = np.searchsorted(at, ends)
        lo = 0
        for t, end, hi, size in zip(part, ends.tolist(), cut.tolist(), sizes.tolist()):
            a = (at[lo:hi] - (end - size)).tolist()
            out.append([t[x:y] for x, y in zip(a, [*a[1:], len(t)])])
            lo = hi
    return out


def _parts(texts: list[str], most: int = 1 << 20):
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t) + 1
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part
