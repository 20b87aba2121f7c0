"""Periodic runs against a plain search."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import pytest
from llm_helpers import awkward_rows, frame

from lakeloom.llm import periodic
from lakeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(words, min_length, min_exponent):
    """Every period, every maximal stretch that keeps it; shortest periods only."""
    n, found = len(words), set()
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q))
            if length >= max(min_length, min_exponent * q) and not smaller:
                found.add((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def plain_words(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize("min_length,min_exponent", [(2, 2), (4, 2), (6, 3), (24, 3), (10, 4)])
def test_random_words(min_length, min_exponent):
    rng = random.Random(min_length * 10 + min_exponent)
    texts = []
    for _ in range(120):
        texts.append(" ".join(rng.choice("ab" if rng.random() < 0.6 else "abc") for _ in range(rng.randrange(60))))
    for _ in range(60):  # powers, with and without errors
        root = [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        words = (root * 12)[: rng.randrange(1, 80)]
        if rng.random() < 0.5 and words:
            words[rng.randrange(len(words))] = "z"
        texts.append(" ".join(["x"] * rng.randrange(3) + words + words[: rng.randrange(5)]))
    sizes, runs, collapsed = periodic.search(texts, min_length, min_exponent)
    for text, n, found, kept in zip(texts, sizes, runs, collapsed):
        words = text.split()
        want = plain_runs(words, min_length, min_exponent)
        assert n == len(words)
        assert found == want
        assert kept == plain_collapsed(words, want)


def test_ordered_places_keep_order_across_blocks(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 2)
    rng = random.Random(4)
    order = rng.sample(range(200), 200)
    places = periodic.OrderedPlaces(order[0])
    held = [order[0]]
    for x in order[1:]:
        before, after = places.add(x)
        assert before == max((y for y in held if y < x), default=-1)
        assert after == min((y for y in held if y > x), default=-1)
        held.append(x)
    assert list(places) == sorted(held) and places.size == 200


def test_one_word_many_times_is_quick():
    n = 60_000
    _, runs, collapsed = periodic.search(["w " * n, "v w " * n], 24, 3)
    assert runs == [[(0, n, 1)], [(0, 2 * n, 2)]]
    assert collapsed == ["w", "v w"]


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = {}
    for r in periodic.periodic_runs(frame(spark, rows), 4, 2).collect():
        got.setdefault((r["doc_id"], r["collapsed"]), []).append(r)
    for i, text, _ in rows:
        words = plain_words(text)
        if len(words) > 1000:
            continue
        want = plain_runs(words, 4, 2)
        found = got[(i, plain_collapsed(words, want))].pop()
        assert [tuple(x) for x in found["runs"]] == want and found["n_words"] == len(words)
    long = next(v for (i, _), v in got.items() if i == 75)[0]
    assert [tuple(x) for x in long["runs"]] == [(0, 20_000, 97)]
    assert periodic.periodic_runs(frame(spark, [])).collect() == []


def test_limits():
    assert periodic.least_lcp(24, 3) == 16
    with pytest.raises(ValueError):
        periodic.periodic_runs(None, 24, 1)


def test_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        words = plain_words(text)
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        _, (runs,), _ = periodic.search([" ".join(words)], 24, 3)  # the search itself has its own tests
        if n < 600:
            assert runs == plain_runs(words, 24, 3)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
