"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays."""

from __future__ import annotations

import numpy as np


def _runs(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equals in a sorted array start, and how long they are."""
    cuts = (c[1:] != c[:-1]).nonzero()[0]
    first = np.zeros(len(cuts) + 1, dtype=np.int64)
    first[1:] = cuts + 1
    sizes = np.empty_like(first)
    sizes[:-1] = first[1:] - first[:-1]
    sizes[-1] = len(c) - first[-1]
    return first, sizes


def _scan(sa: np.ndarray, symbol: np.ndarray, edge: np.ndarray, step: int) -> None:
    """One pass of induced sorting: every suffix in ``sa``, left to right (step 1) or
    right to left (-1), puts the one before it next to the edge of its bucket.
    ``symbol`` is negative where a suffix is not of the type that is wanted, and at the end of the text.

    Stretches of the array are done at once.  A stretch ends where the first of
    its suffixes would be put inside it, as what stands there must be seen in turn.
    """
    n, at, size = len(sa), 0, 1024
    steps = step * np.arange(1 << 16)
    while at < n:
        size = min(size, n - at)
        part = sa[at:at + size] if step > 0 else sa[n - at - size:n - at][::-1]
        before = part - 1                                                  # -1, of the first suffix or no suffix yet: nothing
        c = symbol[before]
        where = (c >= 0).nonzero()[0]
        done = size
        if len(where):
            c, j = c[where], before[where]
            lands = edge[c]
            nearest = int(lands.min()) - at if step > 0 else n - 1 - at - int(lands.max())
            if nearest < size:                                             # seen from here
                done = nearest
                some = int(where.searchsorted(done))
                c, j = c[:some], j[:some]
            if len(c):
                order = c.argsort(kind="stable")
                c, j = c[order], j[order]
                first, sizes = _runs(c)
                heads = c[first]
                free = edge[heads]
                place = (free - step * first).repeat(sizes)
                place += steps[:len(c)]
                sa[place] = j
                edge[heads] = free + step * sizes
        at += done
        size = min(len(steps), 2 * size if done == size else max(64, 2 * done))


def _induce(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """The order of all suffixes that follows from the order of ``seeds``, the leftmost-smaller ones."""
    sizes = np.bincount(t, minlength=alphabet)
    ends = np.cumsum(sizes)
    sa = np.zeros(len(t), dtype=np.int32)                                  # 0: none yet; it moves nothing, nor does the first suffix
    order = np.argsort(t[seeds], kind="stable")
    c = t[seeds][order]
    first, runs = _runs(c)
    sa[np.arange(len(c)) + (ends[c[first]] - runs - first).repeat(runs)] = seeds[order]
    none = t.dtype.type(-1)
    _scan(sa, np.where(smaller, none, t), ends - sizes, 1)
    sa[smaller[sa]] = 0                                                    # the seeds are put anew, among their kind
    sa[0] = len(t) - 1
    symbol = np.where(smaller, t, none)
    symbol[-1] = none
    _scan(sa, symbol, ends - 1, -1)
    return sa


def suffix_array(t: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffixes of ``t`` in order; its last symbol is 0 and occurs nowhere else.

    A suffix is smaller or larger than the one after it; a smaller one behind a
    larger one is leftmost-smaller.  The substrings from one of those to the next
    are sorted by inducing from them as they stand, named in that order, and the
    string of names is sorted by this function, unless all names differ.  From
    the true order of the leftmost-smaller suffixes that of all others follows.
    """
    n = len(t)
    t = t.astype(np.int16 if alphabet < 1 << 15 else np.int32)              # numpy sorts the short ones by radix
    if n == 1:
        return np.zeros(1, dtype=np.int32)
    differ = np.flatnonzero(np.diff(t) != 0)
    nxt = differ[np.searchsorted(differ, np.arange(n - 1))]                # the last symbol differs from all
    smaller = np.append(t[nxt] < t[nxt + 1], True)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) == 1:
        return _induce(t, smaller, lms, alphabet)
    found = _induce(t, smaller, lms, alphabet)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    found = found[is_lms[found]]
    # names: equal substrings, ends included, get the same
    number = np.zeros(n, dtype=np.int32)
    number[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms), 0)[number[found]]
    new = np.append(True, length[1:] != length[:-1])
    live, k = np.flatnonzero(~new), 0
    while live.size:
        other = t[found[live] + k] != t[found[live - 1] + k]
        new[live[other]] = True
        live = live[~other & (length[live] > k)]
        k += 1
    names = np.cumsum(new) - 1
    if names[-1] + 1 == len(lms):
        order = found
    else:
        reduced = np.empty(len(lms), dtype=np.int32)
        reduced[number[found]] = names
        order = lms[suffix_array(reduced, int(names[-1]) + 1)]
    return _induce(t, smaller, order, alphabet)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp) by text position: the suffix just before it in order (-1: none)
    and their common prefix.

    plcp + position never falls along the text, and rises only where the symbols
    before the two suffixes differ: only those are compared, four symbols at once.
    """
    n = len(t)
    phi = np.empty(n, dtype=sa.dtype)
    phi[sa[0]], phi[sa[1:]] = -1, sa[:-1]
    here = np.arange(n)
    prev = (phi > 0) & (here > 0) & (t[np.maximum(phi, 1) - 1] == t[np.maximum(here, 1) - 1])
    i = np.flatnonzero(~prev & (phi >= 0))
    wide = np.append(t, np.zeros(4, dtype=t.dtype)).astype(np.uint64)
    word = wide[:n] | wide[1:n + 1] << np.uint64(16) | wide[2:n + 2] << np.uint64(32) | wide[3:n + 3] << np.uint64(48)
    common = np.zeros(len(i), dtype=np.int64)
    live = np.arange(len(i))
    while live.size:
        a = i[live] + common[live]
        x = word[a] ^ word[phi[i[live]] + common[live]]
        same = (x & np.uint64(0xFFFF) == 0).astype(np.int64)
        for bits in (32, 48):
            same += x & np.uint64((1 << bits) - 1) == 0
        same += x == 0
        common[live] += same
        live = live[same == 4]
    reach = np.zeros(n, dtype=np.int64)
    reach[i] = i + common
    return phi, np.maximum(np.maximum.accumulate(reach) - here, 0)


def repeats(pieces: list[bytes], width: int) -> list[np.ndarray]:
    """For each piece the starts of its substrings of ``width`` bytes that stand
    anywhere else in the pieces too."""
    sizes = np.array([len(p) for p in pieces])
    body = np.frombuffer(b"\x00".join(pieces) + b"\x00\x00", dtype=np.uint8).astype(np.int64) + 2
    ends = np.cumsum(sizes + 1) - 1
    body[ends] = 1                                                         # between the pieces
    body[-1] = 0
    sa = suffix_array(body, 258)
    phi, plcp = permuted_prefixes(body, sa)
    far = np.flatnonzero(plcp >= width)
    hit = np.zeros(len(body), dtype=bool)
    hit[far] = True
    hit[phi[far]] = True
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [np.flatnonzero(hit[a:max(a, e - width + 1)]) for a, e in zip(starts.tolist(), ends.tolist())]
