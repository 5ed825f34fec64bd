"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays."""

from __future__ import annotations

import numpy as np

# Beyond so many distinct symbols, ranks are doubled instead of visiting bucket by bucket.
MOST_BUCKETS = 4096


def smaller_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is a unique smallest one."""
    n = len(s)
    differ = np.flatnonzero(s[1:] != s[:-1])
    # A run of equal symbols has the type of its last place.
    nxt = differ[np.searchsorted(differ, np.arange(n - 1))]
    out = np.ones(n, bool)
    out[:-1] = s[nxt] < s[nxt + 1]
    return out


def _within(keys: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by key, place of each in its key's group, and group sizes."""
    order = np.argsort(keys, kind="stable")
    size = np.bincount(keys, minlength=kinds)
    start = np.cumsum(size) - size
    return order, np.arange(len(keys)) - start[keys[order]], size


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, kinds: int) -> np.ndarray:
    """All suffixes, induced from the leftmost-smaller ones in the order given.

    A bucket is taken whole: its entries put their predecessors into their buckets in one step, again for those that
    fell into the same bucket.
    """
    n = len(s)
    size = np.bincount(s, minlength=kinds)
    head, tail = np.cumsum(size) - size, np.cumsum(size)
    start, end = head.copy(), tail.copy()
    sa = np.full(n, -1, np.int64)
    by, _, count = _within(s[lms], kinds)
    seeds, at = lms[by], np.cumsum(count) - count

    def put(entries, larger):
        before = entries[entries > 0] - 1
        before = before[small[before] != larger]
        if not len(before):
            return
        key = s[before]
        order, place, many = _within(key, kinds)
        k = key[order]
        if larger:
            sa[head[k] + place] = before[order]
            head[:] += many
        else:
            sa[tail[k] - 1 - place] = before[order]
            tail[:] -= many

    for c in np.flatnonzero(size).tolist():
        done = start[c]
        while done < head[c]:
            upto = int(head[c])
            put(sa[done:upto].copy(), True)
            done = upto
        if count[c]:
            put(seeds[at[c]:at[c] + count[c]], True)
    for c in np.flatnonzero(size)[::-1].tolist():
        done = end[c]
        while done > tail[c]:
            downto = int(tail[c])
            put(sa[downto:done][::-1].copy(), False)
            done = downto
        if head[c] > start[c]:
            put(sa[start[c]:head[c]][::-1].copy(), False)
    # The last suffix has no larger neighbour to induce it.
    sa[0] = n - 1
    return sa


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of names by doubling ranks; only places whose rank is shared are sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    rank = np.empty(n, np.int64)
    # A rank is the first place of its group, so settled ranks stay.
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = 1
    while True:
        ends = np.append(new[1:], True)
        loose = np.flatnonzero(~(new & ends))
        if not len(loose) or step >= n:
            return order
        ids = order[loose]
        second = np.where(ids + step < n, rank[np.minimum(ids + step, n - 1)] + 1, 0)
        again = np.argsort(rank[ids] * np.int64(n + 1) + second)
        ids, second = ids[again], second[again]
        first = rank[ids]
        order[loose] = ids
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        new[loose] = fresh
        rank[ids] = loose[np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))]
        step *= 2


def suffix_array(s: np.ndarray, kinds: int) -> np.ndarray:
    """Order of all suffixes of ``s``, symbols 0 to kinds - 1, whose last symbol is its only 0."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    if kinds > MOST_BUCKETS:
        return _doubled(s)
    small = smaller_types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    rough = _induce(s, small, lms, kinds)
    place = np.full(len(s), -1, np.int64)
    place[lms] = np.arange(len(lms))
    sorted_ = place[rough]
    sorted_ = sorted_[sorted_ >= 0]
    # Equal substrings get equal names.
    length = np.append(np.diff(lms) + 1, 1)
    a, b = sorted_[:-1], sorted_[1:]
    same = length[a] == length[b]
    live, k = np.flatnonzero(same), 0
    while len(live):
        live = live[length[a[live]] > k]
        equal = s[lms[a[live]] + k] == s[lms[b[live]] + k]
        same[live[~equal]] = False
        live, k = live[equal], k + 1
    number = np.concatenate([[0], np.cumsum(~same)]) if len(sorted_) else np.zeros(0, np.int64)
    names = np.empty(len(lms), np.int64)
    names[sorted_] = number
    many = int(number[-1]) + 1 if len(number) else 0
    ordered = sorted_ if many == len(lms) else suffix_array(names, many)
    return _induce(s, small, lms[ordered], kinds)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray, heads: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix, by place in the text, with the one before it in the order, up to ``most``.

    Where the symbols before both suffixes are equal, the value is one less than the place before has. All others,
    and ``heads``, are compared, four symbols a step. Values are exact while no run between heads is longer than
    what ``most`` leaves.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    known = np.zeros(n, bool)
    known[1:] = (before[1:] > 0) & (s[:-1] == s[before[1:] - 1])
    known[heads] = False
    known[before < 0] = False
    at = np.flatnonzero(~known & (before >= 0))
    padded = np.concatenate([s.astype(np.uint16), np.zeros(most + 8, np.uint16)])
    four = np.ndarray(len(padded) - 3, np.uint64, padded.data, strides=(2,))
    length = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        x = four[at[live] + length[live]] ^ four[before[at[live]] + length[live]]
        stop = x != 0
        low = x[stop] & (~x[stop] + np.uint64(1))
        length[live[stop]] += np.log2(low.astype(np.float64)).astype(np.int64) >> 4
        live = live[~stop]
        length[live] += 4
        live = live[length[live] < most]
    out = np.zeros(n, np.int64)
    # Each place continues the last compared one.
    source = np.zeros(n, np.int64)
    source[at] = at
    start = before < 0
    source[start] = np.flatnonzero(start)
    source = np.maximum.accumulate(source)
    value = np.zeros(n, np.int64)
    value[at] = length
    out = value[source] - (np.arange(n) - source)
    return np.maximum(out, 0)
