"""Suffix arrays by induced sorting, and the common prefixes of neighbouring suffixes."""

from __future__ import annotations

import numpy as np

EMPTY = -1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``text``, whose last value must be 0 and the only 0.

    Suffixes are of type S if smaller than the next one, else L. The leftmost S positions begin the
    substrings that are sorted first, by inducing L and S suffixes from them in bucket order; equal
    substrings get equal names, and the suffixes of the string of names, if a name repeats, are sorted by
    doubling: its buckets are so many and small that induced stretches there are a few places each.
    The order of the leftmost S suffixes then induces that of all others.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    text = text.astype(_narrow(int(text.max())))
    small = _types(text)
    leftmost = small.copy()
    leftmost[0] = False
    leftmost[1:] &= ~small[:-1]
    begins = np.flatnonzero(leftmost)
    counts = np.bincount(text)
    ends = np.cumsum(counts)
    starts = ends - counts

    order = _induced(text, small, starts, ends, begins)
    order = order[leftmost[order]]
    names, distinct = _names(text, begins, order)
    if distinct < len(begins):
        order = begins[_doubled(names)]
    return _induced(text, small, starts, ends, order)


def _narrow(most: int) -> type:
    """The type of a text of values up to ``most``. Numpy sorts 16 bits by counting, wider ones by comparing."""
    return np.uint16 if most < 1 << 16 else np.int32 if most < 1 << 31 else np.int64


def _types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one; the last is, by convention."""
    n = len(text)
    less = np.zeros(n, dtype=bool)
    less[:-1] = text[:-1] < text[1:]
    less[-1] = True
    differs = np.append(text[:-1] != text[1:], True)
    # A run of equal values has the type of its last member.
    at = np.where(differs, np.arange(n), n)
    return less[np.minimum.accumulate(at[::-1])[::-1]]


def _names(text, begins, order) -> tuple[np.ndarray, int]:
    """Numbers for the substrings that begin at ``begins``, equal for equal ones, given their order."""
    following = np.append(begins[1:], begins[-1] + 1)
    length = np.zeros(len(text), dtype=np.int64)
    length[begins] = following - begins
    length[begins[:-1]] += 1  # up to and with the next begin
    a, b = order[:-1], order[1:]
    open_ = np.flatnonzero(length[a] == length[b])
    fresh = np.ones(len(order), dtype=np.int64)
    depth = 0
    while len(open_):
        done = length[a[open_]] <= depth
        fresh[open_[done] + 1] = 0
        open_ = open_[~done]
        open_ = open_[text[a[open_] + depth] == text[b[open_] + depth]]
        depth += 1
    rank = np.cumsum(fresh) - 1
    of = np.zeros(len(text), dtype=np.int64)
    of[order] = rank
    return of[begins], int(rank[-1]) + 1


def _doubled(names: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``names``, whose last value must be the least and single.

    Those that share their first names are told apart by the places that the suffixes behind these have
    so far; each round doubles what is shared, and looks only at those not yet told apart.
    """
    n = len(names)
    order = names.argsort()
    open_ = np.arange(n)
    key = names[order]
    rank = np.empty(n, dtype=np.int64)  # the first place of those not told apart
    step = 1
    while True:
        fresh = np.append(True, key[1:] != key[:-1])
        edge = np.flatnonzero(fresh)
        count = np.diff(np.append(edge, len(key)))
        rank[order[open_]] = np.repeat(open_[edge], count)
        open_ = open_[np.repeat(count > 1, count)]
        if not len(open_):
            return order
        tied = order[open_]
        key = rank[tied] * n + rank[tied + step]
        by = key.argsort()
        order[open_], key = tied[by], key[by]
        step *= 2


def _induced(text, small, starts, ends, seeds) -> np.ndarray:
    """All suffixes in bucket order, induced from ``seeds`` in the order given."""
    n = len(text)
    found = np.full(n, EMPTY, dtype=np.int64)
    found[_slots(text[seeds], ends - np.bincount(text[seeds], minlength=len(ends)))] = seeds
    _scan(found, text, ~small, starts.copy())
    found[small[np.maximum(found, 0)] & (found != EMPTY)] = EMPTY
    # The second scan is the first one seen from the right: turned round, with the buckets turned round.
    back = found[::-1].copy()
    back[n - 1] = n - 1  # the last suffix is the first of all
    _scan(back, len(ends) - 1 - text, small, (n - ends)[::-1].copy())
    return back[::-1]


def _slots(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The next free places of the buckets, in the order of the values."""
    n = len(values)
    order = values.argsort(kind="stable")
    ranked = values[order]
    place = np.arange(n)
    first = place.copy()  # of the equal values
    first[1:][ranked[1:] == ranked[:-1]] = 0
    np.maximum.accumulate(first, out=first)
    place -= first
    place += heads[ranked]
    slots = np.empty(n, dtype=np.int64)
    slots[order] = place
    return slots


def _scan(found, text, wanted, heads) -> None:
    """From left to right, place the suffix before each one found into its bucket, if it is wanted.

    Whole stretches are worked off at once, up to the first place that the stretch itself fills.
    """
    n, at, width = len(found), 0, 256
    while at < n:
        end = min(n, at + width)
        before = found[at:end] - 1
        source = ((before >= 0) & wanted[before]).nonzero()[0]  # an empty place has no one before it
        if not len(source):
            at, width = end, width * 2
            continue
        before = before[source]
        values = text[before]
        slots = _slots(values, heads)
        stop = min(end, int(slots.min()))
        if stop < end:
            now = int(source.searchsorted(stop - at))
            before, values, slots = before[:now], values[:now], slots[:now]
        found[slots] = before
        np.maximum.at(heads, values, slots + 1)
        width = width * 2 if stop == end else max(64, 2 * (stop - at))
        at = stop


def common_prefixes(data: np.ndarray, order: np.ndarray, positions: np.ndarray, most: int) -> np.ndarray:
    """For each of ``positions``, the bytes its suffix shares with the one before it in ``order``, up to
    ``most``: the permuted array of common prefixes. ``data`` must go on for ``most`` bytes behind them."""
    before = np.full(len(data) + 1, EMPTY, dtype=np.int64)
    before[order[1:]] = order[:-1]
    other = before[positions]
    shared = np.zeros(len(positions), dtype=np.int64)
    words = _words(data, most)
    open_ = np.flatnonzero(other != EMPTY)
    for depth in range(0, most, 8):
        differ = words[positions[open_] + depth] ^ words[other[open_] + depth]
        equal = differ == 0
        low = differ[~equal] & (~differ[~equal] + np.uint64(1))
        shared[open_[~equal]] = depth + (np.bitwise_count(low - np.uint64(1)) >> 3)
        open_ = open_[equal]
        if not len(open_):
            break
    shared[open_] = most
    return np.minimum(shared, most)


def _words(data: np.ndarray, most: int) -> np.ndarray:
    """The eight bytes from each position on, the first one lowest."""
    padded = np.concatenate((data, np.zeros(most + 16, dtype=np.uint8))).astype(np.uint64)
    for k in (1, 2, 4):
        padded = padded[: len(padded) - k] | (padded[k:] << np.uint64(8 * k))
    return padded
