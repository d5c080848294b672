"""Induced suffix sorting of many short strings at once, on numpy arrays.

The strings of a batch lie one after another in one array; each ends with its
own sentinel 0.  Every step of the induced sorting is taken by all strings
together, so a batch costs as many steps as its longest string has letters and
each step is a few array operations.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for a suffix smaller than its successor (S), False for a larger one (L)."""
    n = len(s)
    differ = np.append(s[:-1] != s[1:], True)
    at = np.where(differ, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]               # the next place where neighbours differ
    nxt = np.append(s[1:], 0)
    small = s[at] < nxt[at]
    small[ends] = True
    return small


def _induce(s_key, begin, lengths, small, lms, bucket_begin, bucket_end) -> np.ndarray:
    """Suffix order induced from the order of ``lms``.  ``s_key``: bucket of each letter (its string's own).
    ``begin``, ``lengths``: strings, longest first."""
    n = len(s_key)
    sa = np.full(n, -1, np.int64)
    key = s_key[lms]
    order = np.argsort(key, kind="stable")
    key, put = key[order], lms[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(first, len(key)))
    sa[bucket_end[key] - np.repeat(count, count) + np.arange(len(key)) - np.repeat(first, count)] = put
    starts = np.zeros(n + 1, bool)
    starts[begin] = True
    # by the suffix that is read (one place for "none"): is the one before it L, or S?
    before = np.append(False, small)[:n + 1]
    before_large, before_small = ~before, before.copy()
    for flags in (before_large, before_small):
        flags[:n][starts[:n]] = False
        flags[n] = False
    alive = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left")   # strings longer than j
    heads = bucket_begin.copy()
    for j in range(int(lengths[0])):
        p = sa[begin[:alive[j]] + j]
        p = p[before_large[p]] - 1
        k = s_key[p]
        to = heads[k]
        sa[to] = p
        heads[k] = to + 1
    tails = bucket_end.copy()
    last = begin + lengths - 1
    for j in range(int(lengths[0])):
        p = sa[last[:alive[j]] - j]
        p = p[before_small[p]] - 1
        k = s_key[p]
        to = tails[k] - 1
        sa[to] = p
        tails[k] = to
    return sa


def suffix_arrays(s: np.ndarray, begin: np.ndarray, lengths: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """``s``: letters of all strings, each ending with its only 0 and lying
    ``begin[i] : begin[i] + lengths[i]``; the strings follow each other in
    ``s``, longest first.  ``alphabet``: letters of string i are below
    ``alphabet[i]``.  Returns, string by string, its suffixes' places in ``s``
    in order."""
    n, ends = len(s), begin + lengths - 1
    if not n:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(begin)), lengths)
    base = np.cumsum(alphabet) - alphabet
    key = base[owner] + s
    size = np.bincount(key, minlength=int(alphabet.sum()))
    bucket_end = np.cumsum(size)
    bucket_begin = bucket_end - size
    small = _types(s, ends)
    is_lms = small.copy()
    is_lms[1:] &= ~small[:-1]
    is_lms[begin] = False
    is_lms[ends] = True
    lms = np.flatnonzero(is_lms)
    sa = _induce(key, begin, lengths, small, lms, bucket_begin, bucket_end)

    # name the sorted leftmost-smaller substrings
    found = sa[is_lms[sa]]
    until = np.full(n + 1, 0, np.int64)
    until[lms[:-1]] = np.where(owner[lms[1:]] == owner[lms[:-1]], lms[1:] - lms[:-1], 0)   # a sentinel alone: 0
    span = until[found]
    new = np.ones(len(found), bool)
    at = np.flatnonzero((owner[found[1:]] == owner[found[:-1]]) & (span[1:] == span[:-1])) + 1
    a, b, left, d = found[at], found[at - 1], span[at], 0
    while len(at):                                           # letter by letter while equal
        same = s[a + d] == s[b + d]
        over = same & (left == d)
        new[at[over]] = False
        on = same & ~over
        at, a, b, left, d = at[on], a[on], b[on], left[on], d + 1
    first = np.append(True, owner[found[1:]] != owner[found[:-1]])
    name = np.cumsum(new) - 1
    heads = np.flatnonzero(first)
    per = np.diff(np.append(heads, len(found)))
    name = name - np.repeat(name[heads], per)
    if new.all():
        order = found
    else:
        # the strings of names, in text order; a string with distinct names is sorted already
        named = np.zeros(n, np.int64)
        named[found] = name
        distinct = np.add.reduceat(~new, heads) == 0
        again = np.flatnonzero(~distinct)
        rank = np.argsort(-per[again], kind="stable")        # longest first
        again = again[rank]
        sizes = per[again]
        sub_begin = np.cumsum(sizes) - sizes
        take = np.repeat(heads[again] - sub_begin, sizes) + np.arange(int(sizes.sum()))
        where = lms[take]                                    # lms holds each string's places in text order, as found does by rank
        sub = suffix_arrays(named[where], sub_begin, sizes, sizes)
        order = found.copy()
        order[take] = where[sub]
    return _induce(key, begin, lengths, small, order, bucket_begin, bucket_end)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """PLCP: by text place, the length of the prefix shared with the suffix
    before it in the order (0 for the first of a string, ``firsts`` in ``sa``).
    Letters that end a string must be unique among its neighbours' matches."""
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    phi[sa[firsts]] = -1
    # irreducible: the letters before the two suffixes differ; only these are compared
    prev = np.append(-1, s[:-1])
    known = (phi < 0) | (prev != np.where(phi > 0, prev[phi], -2))
    known[0] = True
    at = np.flatnonzero(known & (phi >= 0))
    length = np.zeros(n, np.int64)
    wide = np.zeros(n + 4, np.uint64)
    for k in range(4):
        wide[:max(n - k, 0)] |= s[k:].astype(np.uint64) << np.uint64(16 * k)
    a, b, own = at.copy(), phi[at], at
    while len(own):                                          # four letters a round
        same = wide[a] == wide[b]
        length[own[same]] += 4
        own, a, b = own[same], a[same] + 4, b[same] + 4
        inside = (a < n) & (b < n)
        own, a, b = own[inside], a[inside], b[inside]
    a, b, own = at + length[at], phi[at] + length[at], at
    for _ in range(4):
        inside = (a < n) & (b < n)
        own, a, b = own[inside], a[inside], b[inside]
        same = s[a] == s[b]
        length[own[same]] += 1
        own, a, b = own[same], a[same] + 1, b[same] + 1
    last = np.maximum.accumulate(np.where(known, np.arange(n), 0))
    return np.maximum(length[last] - (np.arange(n) - last), 0)
