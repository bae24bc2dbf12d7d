"""Suffix arrays by linear grouping, and the repeated strings of a set of byte strings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_DELIMITERS = np.zeros(256, bool)
_DELIMITERS[[9, 10, 13, 32]] = True
#: A window looks this far for the boundary it is sorted by; the rest of it follows the boundary.
REACH = 64
#: Bytes behind a coarse boundary that decide it, and one in how many is taken.
_AHEAD, _ONE_IN = 4, 3


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a public finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of the suffixes in ascending order; a suffix that ends sorts before its extensions.

    Phase 1 groups suffixes by their longest Lyndon prefix. Groups, at first one per symbol, are taken in
    descending order. Each suffix of the group finds the nearest suffix before it in a lower group, along
    pointers already known; one that is found l times has this group's prefix l times behind its own, so
    the found ones leave their groups for new ones just above, ordered by l. Phase 2 goes through the
    array from its least suffix: a suffix put in place puts its predecessor, and along the pointers those
    before it, at the first free place of their groups. Nothing is renamed or repeated.
    """
    n = len(symbols) + 1
    text = np.zeros(n, np.int64)
    text[:-1] = np.unique(np.asarray(symbols, np.int64), return_inverse=True)[1].ravel() + 1
    groups = int(text.max()) + 1
    group: list[int] = text.tolist()
    order = np.argsort(text, kind="stable")
    members: list[list[int]] = [x.tolist() for x in np.split(order, np.cumsum(np.bincount(text, minlength=groups))[:-1])]
    below, above = list(range(-1, groups - 1)), [*range(1, groups), -1]
    previous, done = [-1] * n, [False] * n

    now = groups - 1
    while now >= 0:
        own = [s for s in members[now] if group[s] == now]
        members[now] = own
        own.sort()
        found: dict[int, int] = {}
        for s in own:
            j = s - 1
            while j >= 0 and (done[j] or group[j] == now):
                j = previous[j]
            previous[s] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        for s in own:
            done[s] = True
        if found:
            parts: dict[tuple[int, int], list[int]] = {}
            for j, times in found.items():
                parts.setdefault((times, group[j]), []).append(j)
            for times, old in sorted(parts, reverse=True) if len(parts) > 1 else parts:
                part = parts[times, old]
                new = len(members)
                members.append(part)
                for j in part:
                    group[j] = new
                up = above[old]
                above.append(up)
                below.append(old)
                above[old] = new
                below[up] = new
        now = below[now]

    sizes = np.bincount(group, minlength=len(members)).tolist()
    free, at, now = [0] * len(members), 0, 0
    while now >= 0:
        free[now] = at
        at += sizes[now]
        now = above[now]
    array = [-1] * n
    placed = [False] * n
    array[0], placed[n - 1] = n - 1, True
    for i in range(n):
        s = array[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            array[free[g]] = s
            free[g] += 1
            placed[s] = True
            s = previous[s]
    return array[1:]


def _boundaries(data: np.ndarray, ends: np.ndarray, level: int) -> np.ndarray:
    """Whether a token starts at each byte. Level 0: some words, 1: words, 2: bytes.

    A start is decided by the byte before it and at level 0 by the next few, never by what lies farther."""
    n = len(data)
    if level == 2:
        return np.ones(n, bool)
    starts = np.zeros(n, bool)
    starts[1:] = _DELIMITERS[data[:-1]]
    if level == 0:
        ahead = np.zeros(n, np.uint64)
        padded = np.concatenate([data, np.zeros(_AHEAD, np.uint8)]).astype(np.uint64)
        for k in range(_AHEAD):
            ahead = ahead * np.uint64(257) + padded[k : n + k]
        starts &= mixed(ahead) % np.uint64(_ONE_IN) == 0
        starts &= np.arange(n) + _AHEAD <= ends
    return starts


def repeats(parts: list[bytes], width: int) -> list[np.ndarray]:
    """For each string, whether the ``width`` bytes from each start already start earlier.

    Earlier means in a string before or at a lesser start of the same one. The result has an entry per
    start that leaves room for ``width`` bytes. Every window is sorted by the suffix array of the tokens
    from the first token boundary in its first ``REACH`` bytes, at the coarsest level that has one there;
    windows are equal if the bytes before the boundary are and the suffixes share the rest of the width.
    """
    if width <= REACH + _AHEAD:
        raise ValueError("windows must be longer than the search for a boundary")
    return _repeats(parts, width, 0)


def _repeats(parts: list[bytes], width: int, level: int) -> list[np.ndarray]:
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    n = len(data)
    first = np.cumsum(sizes) - sizes
    end_of = np.repeat(first + sizes, sizes)
    open_ = np.flatnonzero(np.arange(n) + width <= end_of)
    repeated = np.zeros(n, bool)
    starts = _boundaries(data, end_of, level)
    if level < 2:
        starts &= np.arange(n) > np.repeat(first, sizes)
    places = np.append(np.flatnonzero(starts), n)
    at = np.searchsorted(places, open_ + (level < 2))
    near = places[at] <= open_ + REACH
    if near.any():
        _mark(data, end_of, places[:-1], open_[near], at[near], width, level, repeated)
    if not near.all():
        # The other windows go to the next level, with the bytes they need and no others.
        rest = open_[~near]
        new = np.append(True, (np.diff(rest) != 1) | (end_of[rest[1:]] != end_of[rest[:-1]]))
        starts, stops = rest[new], rest[np.append(new[1:], True)] + width
        raw = data.tobytes()
        below = _repeats([raw[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], width, level + 1)
        repeated[rest[np.concatenate(below)]] = True
    return [repeated[a : a + max(0, s - width + 1)] for a, s in zip(first.tolist(), sizes.tolist(), strict=True)]


def _mark(data, end_of, places, windows, token, width, level, repeated) -> None:
    """Set ``repeated`` at the windows that an equal one precedes."""
    # Only strings that hold such a window take part.
    used = np.isin(end_of[places], np.unique(end_of[windows]))
    number = np.cumsum(used) - 1
    places, token = places[used], number[token]
    ends = end_of[places]
    following = np.append(places[1:], len(data))
    last = np.append(ends[1:] != ends[:-1], True)
    over = _AHEAD if level == 0 else 0
    stops = np.where(last, ends, np.minimum(following + over, ends))
    raw = data.tobytes()
    tokens = [raw[a:b] for a, b in zip(places.tolist(), stops.tolist(), strict=True)]
    ranks = {t: k + 2 for k, t in enumerate(sorted(set(tokens)))}
    # A lower symbol parts the strings.
    symbols = np.insert(np.fromiter(map(ranks.__getitem__, tokens), np.int64, len(tokens)), np.flatnonzero(last) + 1, 1)
    array = np.array(suffix_array(symbols.tolist()), np.int64)
    is_token = symbols != 1
    array = (np.cumsum(is_token) - 1)[array[is_token[array]]]
    rank = np.empty(len(array), np.int64)
    rank[array] = np.arange(len(array))
    shared = _shared(data, places[array], ends[array], width)
    n = len(data)
    power = np.ones(n + 1, np.uint64)
    power[1:] = np.cumprod(np.full(n, _ODD, np.uint64), dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    before = places[token] - windows
    tail = (sums[places[token]] - sums[windows]) * _inverse_powers(power, windows)
    key = np.empty(len(windows), np.uint64)
    for u in np.unique(before):
        chosen = np.flatnonzero(before == u)
        classes = np.cumsum(shared < width - u)
        key[chosen] = classes[rank[token[chosen]]].astype(np.uint64)
    key = mixed(mixed(mixed(key + _ODD) + tail) + before.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    repeated[windows[again]] = True


def _inverse_powers(power: np.ndarray, at: np.ndarray) -> np.ndarray:
    """1 / power[at] modulo 2 ** 64; the base is odd, so Newton's steps double the right bits."""
    x = power[at]
    inverse = x.copy()
    for _ in range(5):
        inverse = inverse * (np.uint64(2) - x * inverse)
    return inverse


def _shared(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Bytes each suffix shares with the one before it, ``width`` at most; 0 for the first."""
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    found = np.zeros(len(starts), np.int64)
    step = 1 << 14
    for a in range(1, len(starts), step):
        b = min(len(starts), a + step)
        span = np.arange(width)
        differ = padded[starts[a:b, None] + span] != padded[starts[a - 1 : b - 1, None] + span]
        room = np.minimum(ends[a:b] - starts[a:b], ends[a - 1 : b - 1] - starts[a - 1 : b - 1])
        equal = np.where(differ.any(1), differ.argmax(1), width)
        found[a:b] = np.minimum(equal, room)
    return found
