"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard of text.

The scans of induced sorting move whole buckets: all suffixes known to start with one character are
taken in order, and the suffixes before them are appended to their buckets by a stable sort on one
character. Each suffix is moved once.
"""

from __future__ import annotations

import numpy as np


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Type of each suffix: smaller than the one after it? The empty suffix is the smallest."""
    n = len(text)
    rising = np.zeros(n, bool)
    differs = np.flatnonzero(text[:-1] != text[1:])
    following = np.searchsorted(differs, np.arange(n))
    known = following < len(differs)
    at = differs[np.minimum(following, max(0, len(differs) - 1))] if len(differs) else np.zeros(n, np.int64)
    rising[known] = text[at[known]] < text[at[known] + 1]
    return rising


def _dispatch(places: np.ndarray, text: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Append suffixes to the buckets of their first characters, keeping their order."""
    if len(places):
        chars = text[places]
        order = np.argsort(chars, kind="stable")
        places, chars = places[order], chars[order]
        cuts = np.flatnonzero(np.diff(chars)) + 1
        for part in np.split(places, cuts):
            into[text[part[0]]].append(part)


def _waves(first: list[np.ndarray], char: int, text: np.ndarray, into: list[list[np.ndarray]], up: bool) -> list[np.ndarray]:
    """A bucket's suffixes of one type in scanning order; those before them go to their buckets."""
    done = []
    wave = np.concatenate(first) if first else None
    while wave is not None and len(wave):
        done.append(wave)
        before = wave[wave > 0] - 1
        chars = text[before]
        other = chars > char if up else chars < char
        _dispatch(before[other], text, into)
        wave = before[chars == char]
    return done


def _induce(text: np.ndarray, leftmost: list[np.ndarray], size: int) -> tuple[list[list[np.ndarray]], list[list[np.ndarray]]]:
    """From leftmost-smaller suffixes in order by bucket, all suffixes: the falling ones of each bucket in order,
    and its rising ones from the last to the first."""
    falling: list[list[np.ndarray]] = [[] for _ in range(size)]
    last = np.array([len(text) - 1])
    falling[text[-1]].append(last)
    for char in range(size):
        falling[char] = _waves(falling[char], char, text, falling, up=True)
        seeds = leftmost[char]
        _dispatch(seeds[seeds > 0] - 1, text, falling)
    rising: list[list[np.ndarray]] = [[] for _ in range(size)]
    for char in range(size - 1, -1, -1):
        rising[char] = _waves(rising[char], char, text, rising, up=False)
        for part in reversed(falling[char]):
            back = part[::-1]
            before = back[back > 0] - 1
            _dispatch(before[text[before] < char], text, rising)
    return falling, rising


def _by_bucket(places: np.ndarray, text: np.ndarray, size: int) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in range(size)]
    _dispatch(places, text, parts)
    return [p[0] if p else np.zeros(0, np.int64) for p in parts]


def _ranked(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Order of the suffixes of the reduced string. Its alphabet is about as large as itself, so it
    is sorted by doubling ranks, until they differ or stand for ``depth`` names."""
    rank, span = names.astype(np.int64), 1
    while True:
        order = np.argsort(rank, kind="stable")
        if depth is not None and span >= depth:
            return order
        ahead = np.full(len(rank), 0, np.int64)
        ahead[: len(rank) - span] = rank[span:] + 1 if span < len(rank) else 0
        pair = rank * (len(rank) + 2) + ahead
        order = np.argsort(pair, kind="stable")
        changed = np.concatenate([[0], np.diff(pair[order]) != 0]).cumsum()
        rank = np.empty_like(rank)
        rank[order] = changed
        span *= 2
        if changed[-1] == len(rank) - 1 or span >= len(rank):
            return order


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Starts of all suffixes in order (by their first ``depth`` characters at least, if given)."""
    text = np.asarray(text).astype(np.uint16)
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    size = int(text.max()) + 1
    smaller = _smaller_than_next(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) > 1:
        # sort the substrings between neighbouring leftmost-smaller places, by a first induction
        _, rising = _induce(text, _by_bucket(leftmost, text, size), size)
        is_leftmost = np.zeros(n, bool)
        is_leftmost[leftmost] = True
        parts = [p[::-1] for char in range(size) for p in reversed(rising[char])]
        placed = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        placed = placed[is_leftmost[placed]]
        ends = np.append(leftmost[1:], n - 1)
        length = np.zeros(n, np.int64)
        length[leftmost] = ends - leftmost + 1
        one, two = placed[:-1], placed[1:]
        same = (length[one] == length[two]) & (two != leftmost[-1]) & (one != leftmost[-1])
        pairs = np.flatnonzero(same)
        if len(pairs):
            sizes = length[one[pairs]]
            starts = np.cumsum(sizes) - sizes
            inner = np.arange(sizes.sum()) - np.repeat(starts, sizes)
            agree = text[np.repeat(one[pairs], sizes) + inner] == text[np.repeat(two[pairs], sizes) + inner]
            same[pairs] = np.logical_and.reduceat(agree, starts)
        name = np.zeros(n, np.int64)
        name[placed] = np.concatenate([[0], (~same).cumsum()])
        reduced = name[leftmost]
        leftmost = leftmost[_ranked(reduced, None if depth is None else depth)]
    falling, rising = _induce(text, _by_bucket(leftmost, text, size), size)
    parts = []
    for char in range(size):
        parts += falling[char]
        parts += [p[::-1] for p in reversed(rising[char])]
    return np.concatenate(parts)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each place, how many characters (``most`` at most) its suffix
    shares with the one before it in order. Places whose preceding characters differ are compared; the
    others share one character less than the place before them."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    chained = (at > 0) & (before > 0)
    chained[chained] = text[at[chained] - 1] == text[before[chained] - 1]
    # of an exact suffix array this follows; beyond a limited depth neighbours may be in any order
    chained[1:] &= before[:-1] + 1 == before[1:]
    lone = np.flatnonzero(~chained & (before >= 0))
    shared = np.zeros(n, np.int64)
    active, k = lone, 0
    while len(active) and k < most:
        active = active[np.maximum(active, before[active]) + k < n]
        active = active[text[active + k] == text[before[active] + k]]
        shared[active] += 1
        k += 1
    anchor = np.maximum.accumulate(np.where(chained, -1, at))
    steps = at - anchor
    out = np.where(chained, shared[np.maximum(anchor, 0)] - steps, shared)
    # a capped value only bounds what follows it: compare again where it matters
    unsure = np.flatnonzero(chained & (shared[np.maximum(anchor, 0)] >= most))
    out[unsure] = 0
    active, k = unsure, 0
    while len(active) and k < most:
        active = active[np.maximum(active, before[active]) + k < n]
        active = active[text[active + k] == text[before[active] + k]]
        out[active] += 1
        k += 1
    return np.maximum(out, 0)
