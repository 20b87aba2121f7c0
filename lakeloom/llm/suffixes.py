"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays."""

from __future__ import annotations

import numpy as np

#: Texts over larger alphabets (names in the recursion) are sorted by doubling ranks.
MAX_BUCKETS = 1 << 12


def _types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last, a lone smallest symbol, counts as smaller)."""
    n = len(s)
    differs = np.empty(n, bool)
    differs[:-1] = s[:-1] != s[1:]
    differs[-1] = True
    # Within a run of equal symbols the run's end decides.
    ends = np.nonzero(differs)[0]
    smaller = np.empty(len(ends), bool)
    smaller[:-1] = s[ends[:-1]] < s[ends[:-1] + 1]
    smaller[-1] = True
    return np.repeat(smaller, np.diff(ends, prepend=-1))


def _place(array: np.ndarray, pointer: np.ndarray, suffixes: np.ndarray, symbols: np.ndarray, step: int) -> None:
    """Put suffixes, in their order, at the pointers of their buckets, which move by ``step`` for each."""
    order = np.argsort(symbols, kind="stable")
    symbols, suffixes = symbols[order], suffixes[order]
    starts = np.nonzero(np.diff(symbols, prepend=-1))[0]
    counts = np.diff(starts, append=len(symbols))
    rank = np.arange(len(symbols)) - np.repeat(starts, counts)
    # A pointer that moves down stands one past its next place.
    array[pointer[symbols] + step * rank - (step < 0)] = suffixes
    pointer[symbols[starts]] += step * counts


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Order of all suffixes from ordered leftmost-smaller ones. Each bucket is
    scanned in waves: what a wave places in its own bucket is the next wave."""
    n, sizes = len(s), last - first
    array = np.full(n, -1, np.int32)
    small = s.astype(np.uint8) if len(first) <= 256 else s.astype(np.uint16)

    # Larger suffixes, from the left.
    of = np.searchsorted(s[lms], np.arange(len(first) + 1))
    head = first.copy()
    for c in np.nonzero(sizes)[0]:
        done = first[c]
        while done < head[c]:
            wave, done = array[done : head[c]], head[c]
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                _place(array, head, before, small[before], 1)
        before = lms[of[c] : of[c + 1]]
        before = before[before > 0] - 1
        if len(before):
            _place(array, head, before, small[before], 1)

    # Smaller suffixes, from the right.
    tail = last.copy()
    for c in np.nonzero(sizes)[0][::-1]:
        done = last[c]
        while done > tail[c]:
            wave, done = array[tail[c] : done][::-1], tail[c]
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _place(array, tail, before, small[before], -1)
        wave = array[first[c] : head[c]][::-1]
        before = wave[wave > 0] - 1
        before = before[smaller[before]]
        if len(before):
            _place(array, tail, before, small[before], -1)
    array[0] = n - 1
    return array


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix order by doubling ranks, of whatever is not told apart yet."""
    n = len(s)
    order = np.argsort(s, kind="stable").astype(np.int32)
    ranks = np.empty(n, np.int32)
    starts = np.concatenate([[True], s[order[1:]] != s[order[:-1]]])
    ranks[order] = np.nonzero(starts)[0][np.cumsum(starts) - 1]
    width = 1
    while not starts.all():
        # Only groups of equal rank are sorted again, by the ranks ``width`` further on.
        tied = ~(starts & np.concatenate([starts[1:], [True]]))
        at = np.nonzero(tied)[0]
        part = order[at]
        further = np.where(part + width < n, ranks[np.minimum(part + width, n - 1)], -1)
        again = np.lexsort((further, ranks[part]))
        part, further = part[again], further[again]
        order[at] = part
        new = np.concatenate([[True], (ranks[part[1:]] != ranks[part[:-1]]) | (further[1:] != further[:-1])])
        starts[at] = new
        ranks[part] = at[np.nonzero(new)[0][np.cumsum(new) - 1]]
        width *= 2
    return order


def _names(s: np.ndarray, lms_sorted: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names, in text order, of the substrings from one leftmost-smaller place to the next."""
    n = len(s)
    length = np.zeros(n, np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    size = length[lms_sorted]
    new = np.ones(len(lms_sorted), bool)
    same = np.nonzero(size[1:] == size[:-1])[0] + 1
    if len(same):
        # Symbol by symbol over all neighbours of equal size that still agree.
        step, live = 0, same
        while len(live):
            a, b = lms_sorted[live - 1] + step, lms_sorted[live] + step
            live = live[s[a] == s[b]]
            step += 1
            ended = size[live] == step
            new[live[ended]] = False
            live = live[~ended]
    name = np.empty(n, np.int32)
    name[lms_sorted] = np.cumsum(new) - 1
    return name[lms]


def _sort(s: np.ndarray, alphabet: int) -> np.ndarray:
    if alphabet > MAX_BUCKETS or len(s) < 64:
        return _doubled(s)
    smaller = _types(s)
    lms = (np.nonzero(smaller[1:] & ~smaller[:-1])[0] + 1).astype(np.int32)
    last = np.cumsum(np.bincount(s, minlength=alphabet))
    first = np.concatenate([[0], last[:-1]])
    # Sort leftmost-smaller substrings: any order within a bucket will do to begin with.
    by_symbol = lms[np.argsort(s[lms], kind="stable")]
    array = _induce(s, smaller, by_symbol, first, last)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    names = _names(s, array[is_lms[array]], lms)
    count = int(names.max()) + 1
    if count < len(lms):
        order = _sort(names, count)
    else:
        order = np.empty(len(lms), np.int32)
        order[names] = np.arange(len(lms))
    return _induce(s, smaller, lms[order], first, last)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``data`` (bytes). A suffix that is a prefix of another comes first."""
    if not len(data):
        return np.zeros(0, np.int64)
    if len(data) >= 1 << 31:
        raise ValueError("a shard has fewer than 2**31 bytes")
    s = np.append(data.astype(np.int32) + 1, np.int32(0))
    return _sort(s, 257)[1:]


#: Places whose common prefixes are found first, each from what the place before it leaves over.
STRIDES = (32, 4, 1)


def common_prefixes(data: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """For each suffix, in text order, the length it has in common with the one
    before it in ``array``, counted up to ``most``.

    In text order a length is at least that of the place before, less one, so a
    comparison goes on where that one ended. To take many places at once, every
    32nd place is compared first; the places between start from what the last
    known place carries over, every 4th, then all. Comparisons take 8 bytes a step.
    """
    n = len(data)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    padded = np.concatenate([data, np.zeros(most + 16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (n + most + 8, 8), (1, 1)).copy().view("<u8").ravel()
    before = np.empty(n, np.int32)
    before[array[1:]] = array[:-1]
    before[array[0]] = -1
    limit = n - np.maximum(np.arange(n), before)
    known = None
    for stride in STRIDES:
        live = np.arange(0, n, stride)
        if known is not None:
            live = live[live % known != 0]
            carried = live - live % known
            out[live] = np.maximum(out[carried] - live % known, 0)
        live = live[before[live] >= 0]
        step = np.minimum(out[live], limit[live])
        going = step < np.minimum(most, limit[live])
        out[live[~going]] = step[~going]
        live, step = live[going], step[going]
        while len(live):
            x = words[live + step] ^ words[before[live] + step]
            differ = x != 0
            ended, bits = live[differ], x[differ]
            low = bits & (~bits + np.uint64(1))
            out[ended] = step[differ] + np.round(np.log2(low.astype(np.float64))).astype(np.int64) // 8
            live, step = live[~differ], step[~differ] + 8
            done = step >= most
            out[live[done]] = step[done]
            live, step = live[~done], step[~done]
        out[before < 0] = 0
        at = np.arange(0, n, stride)
        out[at] = np.minimum(np.minimum(out[at], most), limit[at])
        out[before < 0] = 0
        known = stride
    return out
