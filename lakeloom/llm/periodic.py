r"""Periodic runs of words: stretches that repeat with a period.

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are identical), at least ``min_length`` words and ``min_exponent``
periods long, that no neighbouring word extends keeping the period. Loops such
as a menu or a line repeated over and over are runs; all but their first
period can be dropped.

Found by descending-LCP Kruskal within each text:

1. A run of period q that starts at s shares ``length - q`` words between the
   suffixes at s and s + q. So only places whose next ``least_lcp`` words come
   again in the same text matter; a rolling hash finds them (it may name too
   many, never too few).
2. Suffixes of the texts that have such places are sorted by doubling ranks;
   the ranks of every round give the common prefixes of neighbours (LCP).
3. Suffix classes are united by decreasing LCP. Each class keeps its places in
   an ordered set, the smaller goes into the larger. Two places that become
   neighbours in a united set, at a distance p within their LCP, begin a run
   of smallest period p if no earlier word continues it: a smaller period q
   would have united the places q apart before, and they would lie between.
   For ``min_exponent`` of 2 or more every run is found so, once.

A text is one row and is searched by one task; the texts of a batch are
searched together in groups of about ``GROUP_WORDS`` words. Nothing is
shuffled, a lost executor repeats its partitions.

Nulls: a null text has no words; a null id stays null. Words are what lies
between ``[\x20\x09-\x0D]``. Texts without words have no runs and an empty
collapsed text. Repeated rows are searched each. Very long texts are searched
whole, in memory of about a hundred bytes a word. Ties: runs with equal start
are listed by period. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words searched together; a longer text is searched alone.
GROUP_WORDS = 400_000
#: Most places in one block of an ordered set; twice as many are split.
BLOCK = 1024

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RUNS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


def least_lcp(min_length: int, min_exponent: int) -> int:
    """Words that the suffixes at a run's first two periods share, at least."""
    return min(max(min_length - q, (min_exponent - 1) * q, 1) for q in range(1, min_length + 2))


class _Ids(dict):
    """A number for each distinct word."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


class OrderedPlaces:
    """An ordered set of places in blocks, so that one more costs the root of its size."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, place: int):
        self.blocks, self.firsts, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, place: int) -> tuple[int, int]:
        """Insert a place; its neighbours, -1 where there is none."""
        b = max(bisect_right(self.firsts, place) - 1, 0)
        block = self.blocks[b]
        at = bisect_left(block, place)
        before = block[at - 1] if at else -1
        after = block[at] if at < len(block) else self.firsts[b + 1] if b + 1 < len(self.blocks) else -1
        block.insert(at, place)
        self.firsts[b] = block[0]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[b : b + 1] = [block[:BLOCK], block[BLOCK:]]
            self.firsts.insert(b + 1, block[BLOCK])
        return before, after


def repeated_windows(words: np.ndarray, doc: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Which places begin ``width`` words that come again in their document (or have the hash of such)."""
    n = len(words)
    found = np.zeros(n, bool)
    if n < width:
        return found
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base)]))
    value = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(31)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:n])])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, inverse)]))
    place = np.arange(n - width + 1)
    place = place[place + width <= ends[doc[place]]]
    h = (sums[place + width] - sums[place]) * back[place] + doc[place].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    found[place[order[1:][same]]] = True
    found[place[order[:-1][same]]] = True
    return found


def sorted_suffixes(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share a first word with another, in order within their
    documents, and the words that each shares with the one before it.

    ``words`` differ between documents; ``ends`` has the end of each place's.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    new = np.concatenate([[True], words[order[1:]] != words[order[:-1]]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1  # 0: past the end
    shared = ~(new & np.concatenate([new[1:], [True]]))
    active = order[shared]
    rounds, step = [rank.copy()], 1
    listed = active
    while len(active):
        ahead = active + step
        inside = ahead < ends[active]
        second = np.where(inside, rank[np.where(inside, ahead, 0)], 0).astype(np.int64)
        old = rank[active].astype(np.int64)
        by = np.argsort(old * (n + 1) + second, kind="stable")
        active, old, second = active[by], old[by], second[by]
        at = np.arange(len(active))
        group = np.concatenate([[True], old[1:] != old[:-1]])
        new = group | np.concatenate([[True], second[1:] != second[:-1]])
        first_of_group = np.maximum.accumulate(np.where(group, at, 0))
        rank[active] = old + np.maximum.accumulate(np.where(new, at, 0)) - first_of_group
        active = active[~(new & np.concatenate([new[1:], [True]]))]
        step *= 2
        rounds.append(rank.copy())
    suffixes = listed[np.argsort(rank[listed], kind="stable")]
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    shared_words = np.zeros(len(a), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        inside = (a < ends[suffixes[:-1]]) & (b < ends[suffixes[1:]])
        same = inside & (rounds[k][np.where(inside, a, 0)] == rounds[k][np.where(inside, b, 0)])
        a[same] += 1 << k
        b[same] += 1 << k
        shared_words[same] += 1 << k
    return suffixes, np.concatenate([[0], shared_words]) if len(suffixes) else shared_words


def find_runs(words: np.ndarray, doc: np.ndarray, ends: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs; ``words`` of all documents one after the other,
    ``doc`` the document of each place, ``ends`` the end of each document."""
    least = least_lcp(min_length, min_exponent)
    wanted = np.zeros(len(ends), bool)
    wanted[doc[repeated_windows(words, doc, ends, least)]] = True
    keep = np.flatnonzero(wanted[doc])
    if not len(keep):
        return []
    # Only documents that have repeated windows, their words told apart by document.
    own = doc[keep]
    words = words[keep] + own * (int(words.max()) + 1)
    past = np.cumsum(np.bincount(own, minlength=len(ends)))[own]
    suffixes, shared = sorted_suffixes(words, past)
    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")]

    # Numbered by their place in suffix order: an edge unites neighbours there.
    parent = list(range(len(suffixes)))
    places = suffixes.tolist()
    sets: dict[int, OrderedPlaces] = {}
    seeds: list[tuple[int, int, int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for e, lcp in zip(edges.tolist(), shared[edges].tolist()):
        x, y = root(e - 1), root(e)
        large = sets.pop(x, None) or OrderedPlaces(places[x])
        small = sets.pop(y, None) or OrderedPlaces(places[y])
        if large.size < small.size:
            x, y, large, small = y, x, small, large
        parent[y] = x
        sets[x] = large
        farthest, added = lcp // (min_exponent - 1), list(small)
        for k, place in enumerate(added):
            before, after = large.add(place)
            # Neighbours from the same set are not new, and what is still to be added may lie between.
            if before >= 0 and place - before <= farthest and not (k and before == added[k - 1]):
                seeds.append((before, place - before, lcp))
            if after >= 0 and after - place <= farthest and (k + 1 == len(added) or after < added[k + 1]):
                seeds.append((place, after - place, lcp))
    if not seeds:
        return []
    start, period, lcp = np.array(seeds, np.int64).T
    begins = np.concatenate([[True], own[1:] != own[:-1]])
    first = begins[start] | (words[start - 1] != words[start + period - 1])
    found = np.stack([start, lcp + period, period], axis=1)[first & (lcp + period >= min_length)]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return [(int(keep[s]), length, q) for s, length, q in found.tolist()]


def search(texts: list[str | None], min_length: int, min_exponent: int) -> tuple[list[int], list[list[tuple[int, int, int]]], list[str]]:
    """Of each text the number of words, the runs, and the text without the repeated periods."""
    ids = _Ids()
    lists = [(t or "").encode().split() for t in texts]
    sizes = np.array([len(w) for w in lists], np.int64)
    words = np.fromiter((i for w in lists for i in map(ids.__getitem__, w)), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(words, doc, ends, min_length, min_exponent) if len(words) else ():
        d = int(doc[start])
        runs[d].append((start - int(ends[d] - sizes[d]), length, period))
    collapsed = []
    for own, found in zip(lists, runs):
        if found:
            change = np.zeros(len(own) + 1, np.int64)
            for start, length, period in found:
                change[start + period] += 1
                change[start + length] -= 1
            own = [own[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(own).decode())
    return sizes.tolist(), runs, collapsed


def _run_lists(runs: list[list[tuple[int, int, int]]]) -> pa.Array:
    flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
    offsets = np.concatenate([[0], np.cumsum([len(found) for found in runs])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=RUN.names))


def periodic_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs (``start, length, period``
    in words, by start, then period) and its words joined by one space, but for
    those that a run contains after its first period."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("runs have at least 2 periods and 2 words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # About six bytes a word: groups by size, each at least one text.
            texts = b.column(1).to_pylist()
            group = np.cumsum([len(t or "") for t in texts]) // (6 * GROUP_WORDS)
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    sizes, runs, collapsed = search(texts[lo:hi], min_length, min_exponent)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), _run_lists(runs), pa.array(collapsed, pa.string())], names=RUNS.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, RUNS)


def most_repeated(runs: Column) -> Column:
    """The run with the greatest exact length / period, the first of equal ones; null if there is none."""
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(more(best, r), r).otherwise(best))
