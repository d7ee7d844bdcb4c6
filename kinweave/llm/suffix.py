"""Suffix arrays of byte strings by induced sorting, in NumPy.

The steps are those of induced sorting (SA-IS): suffixes are classified as
smaller (S) or larger (L) than their right neighbour; substrings between
leftmost S positions (LMS) are sorted by inducing and named by comparing neighbours
byte by byte; the string of names, at most half as long, is sorted by itself; the
order of all suffixes is then induced from that of the LMS suffixes in two linear
passes. The passes go bucket by bucket, each bucket's suffixes at once: a suffix
induces only into its own bucket (as often as its symbol repeats in a row) or into
buckets still to come.

One step departs from the published recursion: the string of names has an alphabet
too large for a pass bucket by bucket, so its suffixes are not induced again but
sorted by doubling ranks, only within groups that are still tied.

Arrays of positions are 32 bits wide and dropped early: the peak is about 30 bytes
for each byte of the text.

Permuted common prefixes (PLCP) follow the order of the text: a position whose
left symbol equals that of its predecessor in the suffix array has one less than
the position before it; the others are compared directly, 8 bytes a step.
"""

from __future__ import annotations

import numpy as np


def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it (S)."""
    n = len(t)
    s = np.zeros(n, bool)
    if n < 2:
        return s
    up, down = t[:-1] < t[1:], t[:-1] > t[1:]
    # equal neighbours take the type of the next position where they differ; the last suffix is L
    known = np.append(up | down, True)
    at = np.where(known, np.arange(n, dtype=np.int32), np.int32(n))
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    s[:-1] = np.append(up, False)[nxt[:-1]]
    return s


def _place(sa: np.ndarray, fill: np.ndarray, pos: np.ndarray, symbol: np.ndarray, step: int) -> None:
    """Put positions at the next free places of their symbols' buckets, in order."""
    order = np.argsort(symbol, kind="stable")
    pos, symbol = pos[order], symbol[order]
    new = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
    count = np.diff(np.append(new, len(symbol)))
    within = np.arange(len(symbol)) - np.repeat(new, count)
    sa[fill[symbol] + step * within] = pos
    fill[symbol[new]] += step * count


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array from LMS positions in sorted order (or, for LMS
    substrings, in any order). ``t``: uint8."""
    n = len(t)
    count = np.bincount(t, minlength=256).astype(np.int64)
    end = np.cumsum(count)
    start = end - count
    sa = np.full(n, -1, np.int32)
    symbols = np.flatnonzero(count)

    tail = end - 1
    if len(lms):
        _place(sa, tail, lms[::-1], t[lms[::-1]], -1)
    s_from = tail + 1  # LMS suffixes stand at the end of their buckets
    head = start.copy()
    last = n - 1
    sa[head[t[last]]] = last
    head[t[last]] += 1
    for c in symbols:
        at = start[c]
        while at < head[c]:
            stop = head[c]
            p = sa[at:stop]
            p = p[p > 0] - 1
            before = t[p]
            own = p[before == c]
            if len(own):
                sa[stop : stop + len(own)] = own
                head[c] += len(own)
            more = before > c
            if more.any():
                _place(sa, head, p[more], before[more], 1)
            at = stop
        p = sa[s_from[c] : end[c]]
        p = p[p > 0] - 1
        if len(p):
            before = t[p]
            more = before > c
            _place(sa, head, p[more], before[more], 1) if more.any() else None

    tail = end - 1
    for c in symbols[::-1]:
        at = end[c] - 1
        while at > tail[c]:
            stop = tail[c]
            p = sa[stop + 1 : at + 1][::-1]
            p = p[p > 0] - 1
            before = t[p]
            own = p[before == c]
            if len(own):
                sa[stop - len(own) + 1 : stop + 1] = own[::-1]
                tail[c] -= len(own)
            less = before < c
            if less.any():
                _place(sa, tail, p[less], before[less], -1)
            at = stop
        p = sa[start[c] : head[c]][::-1]
        p = p[p > 0] - 1
        if len(p):
            before = t[p]
            less = before < c
            _place(sa, tail, p[less], before[less], -1) if less.any() else None
    return sa


def by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string over a large alphabet."""
    n = len(names)
    sa = np.argsort(names)
    sorted_names = names[sa]
    first = np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = group
    tied = ~(first & np.append(first[1:], True))
    places = np.flatnonzero(tied)
    k = 1
    while len(places):
        own = sa[places]
        key = rank[own] * (n + 1) + rank[np.minimum(own + k, n)] + 1
        order = np.argsort(key)
        own, key = own[order], key[order]
        sa[places] = own
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[own] = places[np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))]
        places = places[~(first & np.append(first[1:], True))]
        k *= 2
    return sa


def _words(t: np.ndarray) -> np.ndarray:
    """The 8 bytes at every place of ``t`` and a little beyond, little-endian."""
    padded = np.concatenate([t, np.zeros(16, np.uint8)])
    return np.ndarray((len(t) + 8,), "<u8", padded, 0, (1,))


def _same(t: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the strings of ``n`` bytes at ``a`` and ``b`` are equal, 8 bytes a step."""
    word = _words(t)
    same = np.ones(len(a), bool)
    live = np.flatnonzero(n > 0)
    got = 0
    while len(live):
        rest = np.minimum(n[live] - got, 8).astype(np.uint64)
        mask = ~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * rest)
        equal = (word[a[live] + got] ^ word[b[live] + got]) & mask == 0
        same[live[~equal]] = False
        got += 8
        live = live[equal & (n[live] > got)]
    return same


def suffix_array(t: np.ndarray) -> np.ndarray:
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    s = classify(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) < 2:
        return induce(t, s, lms)
    number = np.full(n, -1, np.int32)  # place among the LMS positions
    number[lms] = np.arange(len(lms), dtype=np.int32)
    sa = induce(t, s, lms)
    which = number[sa]
    which = which[which >= 0]
    del sa, number
    # name LMS substrings: equal ones, both ends included, get one name; the last one ends at the text's end, like no other
    size = np.append(lms[1:], n - 1) + 1 - lms
    a, b = which[:-1], which[1:]
    new = (size[a] != size[b]) | (a == len(lms) - 1) | (b == len(lms) - 1)
    old = np.flatnonzero(~new)
    new[old] = ~_same(t, lms[a[old]], lms[b[old]], size[a[old]])
    if new.all():
        return induce(t, s, lms[which])
    names = np.empty(len(lms), np.int32)
    names[which] = np.concatenate([[0], np.cumsum(new)])
    del a, b, old, which, size, new
    return induce(t, s, lms[by_doubling(names)])


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(predecessor, PLCP) by text position; the first suffix has predecessor -1."""
    n = len(t)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    at = np.arange(n, dtype=np.int32)
    has = phi >= 0
    reducible = phi > 0
    reducible[:1] = False
    some = np.flatnonzero(reducible)
    reducible[some] = t[some - 1] == t[phi[some] - 1]
    del some
    plcp = np.zeros(n, np.int32)
    a = np.flatnonzero(has & ~reducible)
    b = phi[a].astype(np.int64)
    word = _words(t)
    live = np.arange(len(a))
    got = np.zeros(len(a), np.int64)
    most = n - np.maximum(a, b)
    while len(live):
        done = got[live]
        differ = word[a[live] + done] ^ word[b[live] + done]
        low = differ & (~differ + np.uint64(1))
        step = np.where(differ == 0, np.uint8(8), np.bitwise_count(low - np.uint64(1)) >> 3)
        got[live] = np.minimum(done + step, most[live])
        live = live[(step == 8) & (got[live] < most[live])]
    plcp[a] = got
    del a, b, got, most
    # a reducible position has one less than the one before it in its chain
    chain = np.maximum.accumulate(np.where(has & reducible, np.int32(0), at))
    plcp = np.where(reducible, plcp[chain] - (at - chain), plcp)
    return phi, np.maximum(plcp, 0)
