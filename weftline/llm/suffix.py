"""Suffix arrays by induced sorting, vectorised in numpy.

SA-IS (Nong, Zhang, Chan, 2009): suffixes are classified as larger or smaller
than their successor, the leftmost-smaller substrings are sorted and named, the
string of names is ranked, and the whole array is induced from them. Induction
runs bucket by bucket, each as a few array operations; runs of one byte enter
their bucket at once. Names are ranked by doubling rather than by induction, as
their alphabet is as large as the string; ``depth`` says how many leading bytes
must be in order, and they are refined only that far. Substrings and common
prefixes are compared by their bytes, eight at a time.
"""

from __future__ import annotations

import numpy as np

from weftline.llm.textbytes import U64


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is larger than the end."""
    n = len(text)
    at = np.where(np.append(text[:-1] != text[1:], True), np.arange(n), n)
    step = np.minimum.accumulate(at[::-1])[::-1]
    less = np.append(text[:-1] < text[1:], False)
    return less[step]


def _append(sa: np.ndarray, ends: np.ndarray, text: np.ndarray, items: np.ndarray, down: bool) -> None:
    """Put items, in order, at their buckets' ends, which move up, or down."""
    symbols = text[items]
    order = np.argsort(symbols, kind="stable")
    symbols, items = symbols[order], items[order]
    counts = np.bincount(symbols, minlength=256)
    place = np.arange(len(items)) - (np.cumsum(counts) - counts)[symbols]
    if down:
        sa[ends[symbols] - 1 - place] = items
        ends -= counts
    else:
        sa[ends[symbols] + place] = items
        ends += counts


def runs_before(text: np.ndarray) -> np.ndarray:
    """How many equal bytes stand right before each position."""
    at = np.arange(len(text))
    new = np.append(True, text[1:] != text[:-1])
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _spread_runs(sa: np.ndarray, place: int, ends: np.ndarray, back: np.ndarray, step: int) -> int:
    """Write a bucket from ``place`` on: the given ends of runs, then what stands one before each, and so on.

    Gives the number of places written. Suffixes nearer to the end of their run
    come first, among equally near ones the order of the ends holds.
    """
    length = back[ends] + 1
    near = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    items = np.repeat(ends, length) - near
    n = len(items)
    if n > len(ends):
        items = items[np.argsort(near, kind="stable")]
    if n:
        sa[place : place + n * step if place + n * step >= 0 else None : step] = items
    return n


def induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array induced from the leftmost-smaller suffixes in the order given."""
    n = len(text)
    sizes = np.bincount(text, minlength=256)
    stop = np.cumsum(sizes)
    start = stop - sizes
    sa = np.full(n, -1, np.int64)
    tails = stop.copy()
    _append(sa, tails, text, lms[::-1], True)
    low = tails.copy()  # leftmost-smaller suffixes of c stand from low[c] to stop[c]
    heads = start.copy()
    _append(sa, heads, text, np.array([n - 1]), False)
    back = runs_before(text)
    for c in np.flatnonzero(sizes):
        heads[c] = start[c] + _spread_runs(sa, start[c], sa[start[c] : heads[c]], back, 1)
        for items in (sa[start[c] : heads[c]] - 1, sa[low[c] : stop[c]] - 1):
            items = items[items >= 0]
            _append(sa, heads, text, items[(text[items] != c) & ~smaller[items]], False)
    tails = stop.copy()
    for c in np.flatnonzero(sizes)[::-1]:
        tails[c] = stop[c] - _spread_runs(sa, stop[c] - 1, sa[tails[c] : stop[c]][::-1], back, -1)
        for items in (sa[tails[c] : stop[c]][::-1] - 1, sa[start[c] : heads[c]][::-1] - 1):
            items = items[items >= 0]
            _append(sa, tails, text, items[(text[items] != c) & smaller[items]], True)
    return sa


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, the first lowest; zeros follow the end."""
    long = np.concatenate([text, np.zeros(16, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(long, 8)[: len(text) + 8].copy().view("<u8").reshape(-1).astype(U64)


def equal_bytes(eight: np.ndarray, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether n_a bytes from a and n_b bytes from b are the same."""
    same = n_a == n_b
    at = np.flatnonzero(same)
    done = 0
    while len(at):
        left = n_a[at] - done
        mask = np.where(left >= 8, ~U64(0), (U64(1) << (U64(8) * np.minimum(left, 7).astype(U64))) - U64(1))
        alike = ((eight[a[at] + done] ^ eight[b[at] + done]) & mask) == 0
        same[at[~alike]] = False
        at = at[alike & (left > 8)]
        done += 8
    return same


def rank_names(names: np.ndarray, depth: int) -> np.ndarray:
    """The order of the suffixes of a string of names, by refining ranks recursively."""
    rank, k = names.astype(np.int64) + 1, 1
    while True:
        order = np.argsort(rank, kind="stable")
        if k >= depth or len(np.unique(rank)) == len(rank):
            return order
        after = np.zeros(len(rank), np.int64)
        after[: max(len(rank) - k, 0)] = rank[k:]
        both = rank * (rank.max() + 1) + after
        order = np.argsort(both, kind="stable")
        new = np.ones(len(rank), np.int64)
        new[1:] = both[order][1:] != both[order][:-1]
        rank = np.empty(len(new), np.int64)
        rank[order] = np.cumsum(new)
        k *= 2


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """All suffixes of a byte array in order, by their first ``depth`` bytes at least."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = smaller_types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        first = induce(text, smaller, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        found = first[is_lms[first]]
        # a leftmost-smaller substring ends with the first byte of the next one
        end = np.append(lms[1:] + 1, n)
        number = np.full(n, -1, np.int64)
        number[lms] = np.arange(len(lms))
        order = number[found]
        same = equal_bytes(eight_bytes(text), lms[order[:-1]], lms[order[1:]], (end - lms)[order[:-1]], (end - lms)[order[1:]])
        # the last one also ends the text
        same &= (order[:-1] != len(lms) - 1) & (order[1:] != len(lms) - 1)
        names = np.empty(len(lms), np.int64)
        names[order] = np.cumsum(np.append(False, ~same))
        lms = lms[rank_names(names, n if depth is None else depth)]
    return induce(text, smaller, lms)


def permuted_lcp(text: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """Per text position the common prefix with its predecessor in the array, at most limit."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    here = np.flatnonzero(before >= 0)
    there = before[here]
    room = np.minimum(limit, n - np.maximum(here, there))
    out = np.zeros(n, np.int64)
    eight = eight_bytes(text)
    at, done = here, 0
    while len(at):
        differ = eight[at + done] ^ eight[there + done]
        ended = (differ != 0) | (done + 8 >= room)
        # the lowest byte that differs is the first
        first = np.zeros(len(at), np.int64)
        for k in range(1, 9):
            first += (differ & ((U64(1) << U64(8 * k)) - U64(1) if k < 8 else ~U64(0))) == 0
        out[at[ended]] = np.minimum(done + first, room)[ended]
        at, there, room = at[~ended], there[~ended], room[~ended]
        done += 8
    return out
