"""Suffix arrays by induced sorting over numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than their successor; the leftmost of each run of S
suffixes (LMS) are sorted first, by their substrings and then, where substrings repeat, by the order of the
string of substring names, found the same way. The other suffixes follow by induction: a sweep over the
buckets of first symbols places all L suffixes, a sweep back all S suffixes. Each bucket is worked on as whole
arrays, one wave per repetition of its symbol, instead of one suffix at a time.
"""

from __future__ import annotations

import numpy as np

# With more names than this, buckets are too small for whole-array work, and ranks are doubled instead.
WIDE_ALPHABET = 1024


def classes(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is of type S, and the positions of the LMS suffixes. The last symbol must be a
    unique smallest one."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    step = np.append(step, -1)
    step[-1] = 1  # the end counts as S
    # equal neighbours have the type of the next change
    nearest = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    small = step[nearest] > 0
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    return small, lms


def _by_symbol(symbols: np.ndarray):
    """Indices of equal symbols in their order, symbol by symbol."""
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    cuts = np.flatnonzero(np.diff(ordered)) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.append(cuts, len(order))
    return [(int(ordered[a]), order[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]


def induced(s: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from the order of the LMS suffixes given."""
    size = int(s.max()) + 1
    arriving: list[list[np.ndarray]] = [[] for _ in range(size)]
    seeds: list[np.ndarray | None] = [None] * size
    for symbol, own in _by_symbol(s[lms]):
        seeds[symbol] = lms[own]
    larger: list[np.ndarray | None] = [None] * size
    present = np.flatnonzero(np.bincount(s, minlength=size)).tolist()

    def send(entries: np.ndarray, symbol: int, kind: bool) -> np.ndarray | None:
        """Predecessors of the wanted type go to their buckets; those of this bucket are returned."""
        before = entries[entries > 0] - 1
        before = before[small[before] == kind]
        same = None
        if len(before):
            for target, own in _by_symbol(s[before]):
                if target == symbol:
                    same = before[own]
                else:
                    arriving[target].append(before[own])
        return same

    for symbol in present:
        waves = arriving[symbol]
        if waves:
            wave = waves[0] if len(waves) == 1 else np.concatenate(waves)
            done = [wave]
            while (wave := send(wave, symbol, False)) is not None:
                done.append(wave)
            larger[symbol] = np.concatenate(done)
            arriving[symbol] = []
        if seeds[symbol] is not None:
            send(seeds[symbol], symbol, False)
    arriving = [[] for _ in range(size)]
    arriving[int(s[-1])].append(np.array([len(s) - 1]))
    parts: list[np.ndarray] = []
    for symbol in reversed(present):
        waves = arriving[symbol]
        if waves:
            wave = waves[0] if len(waves) == 1 else np.concatenate(waves)
            done = [wave]
            while (wave := send(wave, symbol, True)) is not None:
                done.append(wave)
            parts.append(np.concatenate(done))
        if larger[symbol] is not None:
            back = larger[symbol][::-1]
            parts.append(back)
            send(back, symbol, True)
    return np.concatenate(parts)[::-1]


def doubled(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of many names, by doubling the length that ranks look at."""
    n, rank, reach = len(names), np.unique(names, return_inverse=True)[1].astype(np.int64), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-reach] = rank[reach:] + 1
        key = rank * (n + 2) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1 or reach >= n:
            return order
        reach *= 2


def _named(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in text order, equal ones alike, given the LMS positions in sorted order."""
    after = np.zeros(len(s), np.int64)
    after[lms[:-1]] = lms[1:]
    after[lms[-1]] = lms[-1]
    a, b = ordered[:-1], ordered[1:]
    length = after[a] - a
    differs = length != after[b] - b
    todo = np.flatnonzero(~differs)
    offset = 0
    while len(todo):
        unlike = s[a[todo] + offset] != s[b[todo] + offset]
        differs[todo[unlike]] = True
        offset += 1
        todo = todo[~unlike & (length[todo] >= offset)]
    names = np.zeros(len(s), np.int64)
    names[ordered] = np.concatenate([[0], np.cumsum(differs)])
    return names[lms]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of ``s`` in order. The last symbol must be a unique smallest one."""
    n = len(s)
    if n <= 1:
        return np.arange(n)
    small, lms = classes(s)
    if len(lms) > 1:
        rough = induced(s, small, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = rough[is_lms[rough]]
        names = _named(s, lms, ordered)
        alphabet = int(names.max()) + 1
        if alphabet == len(lms):
            lms = ordered
        else:
            lms = lms[suffix_array(names) if alphabet <= WIDE_ALPHABET else doubled(names)]
    return induced(s, small, lms)


def permuted_prefixes(raw: np.ndarray, left: np.ndarray, order: np.ndarray, longest: int) -> np.ndarray:
    """For every position, the length of the prefix its suffix shares with the one before it in ``order``.

    In text order, counted up to ``longest`` and up to the end of either one's segment (``left`` bytes away).
    Eight bytes are compared at a time.
    """
    n = len(raw)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([raw, np.zeros(longest + 16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded.tobytes(), strides=(1,)).copy()
    place = np.flatnonzero((before >= 0) & (left > 0))
    place = place[left[before[place]] > 0]
    common = np.zeros(n, np.int64)
    limit = np.minimum(np.minimum(left[place], left[before[place]]), longest)
    offset = 0
    while len(place):
        unlike = words[place + offset] ^ words[before[place] + offset]
        # bytes alike from the low end
        lowest = unlike & (~unlike + np.uint64(1))
        alike = np.where(unlike == 0, 8, (np.log2(np.maximum(lowest, 1).astype(float)) // 8).astype(np.int64))
        common[place] = np.minimum(offset + alike, limit)
        offset += 8
        more = (alike == 8) & (limit > offset)
        place, limit = place[more], limit[more]
    return common
