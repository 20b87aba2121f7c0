"""Ranked search against scoring everything."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import awkward_rows, frame

from lakeloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_search(docs, items, k):
    """Scores of all pairs, from the definitions alone."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in plain_terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in items], "item_id long, text string, query string, score long")


@pytest.fixture
def small(monkeypatch):
    """Buckets and blocks of a size that small tables fill."""
    monkeypatch.setattr(lexical, "BUCKET", 4)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 60)
    monkeypatch.setattr(lexical, "LONGEST", 0.2)


def test_terms():
    text = "The rivière-Ñandú's 42 x_y\x00Z\x7f🙂 É"
    assert [t.decode() for t in lexical.terms(text)] == plain_terms(text) == ["the", "rivière", "Ñandú", "s", "42", "x", "y", "z", "🙂", "É"]
    assert lexical.terms(None) == []


@pytest.mark.parametrize("k", [1, 3, 10])
def test_awkward_rows(spark, small, k):
    rows = awkward_rows()
    docs = [(i, t) for i, t, _ in rows]
    rng = random.Random(k)
    items = [(n, " ".join(rng.choices((rng.choice(docs)[1] or "").split() or ["nothing"], k=rng.randrange(1, 12)))) for n in range(25)]
    items += [(25, None), (26, ""), (27, "?!"), (28, "unheard of"), (29, "the the the of"), (29, "the the the of"), (30, "two WORDS")]
    got = found(lexical.search(frame(spark, rows), item_frame(spark, items), k))
    assert got == plain_search(docs, items, k)


def test_ties_and_common_terms(spark, small):
    # Equal scores across many buckets; one term that every document has.
    docs = [(i, "same text " + ("rare" if i % 37 == 0 else "plenty") + " all") for i in reversed(range(300))] + [(None, "same text plenty all")]
    items = [(0, "plenty"), (1, "rare all"), (2, "all"), (3, "same same rare")]
    got = found(lexical.search(frame(spark, [(i, t, "a") for i, t in docs]), item_frame(spark, items), 10))
    assert got == plain_search(docs, items, 10)


def test_empty_tables(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "a")]
    assert found(lexical.search(frame(spark, []), item_frame(spark, items))) == []
    assert found(lexical.search(frame(spark, [(1, None, "a")]), item_frame(spark, items))) == []
    assert found(lexical.search(frame(spark, [(i, t, "a") for i, t in docs]), item_frame(spark, []))) == []


def test_bounds_leave_documents_out(monkeypatch):
    """Pruning is real: short vectors are not read, coordinates name few candidates."""
    rng = np.random.default_rng(1)
    w = np.array([9000, 8000, 100, 50], np.int64)
    items = lexical.Items.of([(0, 0, 1), (0, 1, 1), (0, 2, 1)], w)
    scored = []
    monkeypatch.setattr(lexical.Searcher, "_keep", lambda self, i, ids, score: scored.extend(ids.tolist()))
    searcher = lexical.Searcher(items, 2, np.array([12_000 * 100_000]))
    # Two documents with both rare terms, many with common ones only.
    terms = [np.array([0, 1], np.int32)] * 2 + [np.array([2, 3], np.int32)] * 60
    values = [np.array([100_000, 100_000])] * 2 + [rng.integers(90_000, 110_000, 2) for _ in range(60)]
    root = np.sqrt(w)
    length = np.array([np.sqrt(((root[t] * v) ** 2).sum()) for t, v in zip(terms, values)])
    order = np.argsort(-length)
    offsets = np.cumsum([0] + [2] * 62)
    assert searcher.bucket(order, length[order], offsets, np.concatenate([terms[i] for i in order]), np.concatenate([values[i] for i in order]))
    assert sorted(scored) == [0, 1]
    few = order[2:]
    assert not searcher.bucket(few, length[few], offsets[:61], np.concatenate([terms[i] for i in few]), np.concatenate([values[i] for i in few]))
