"""Language identification: parts against plain versions, held-out accuracy."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_helpers import DOCS, awkward_rows, frame
from pyspark.sql import functions as F

from lakeloom.llm import language
from lakeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_hash(gram, bits):
    h = 0
    for n, c in enumerate(gram, 1):
        h = (((h * 0x01000193) ^ ord(c)) * 0x9E3779B1 + n) % 2**32
    return (h * 0x85EBCA6B) % 2**32 >> (32 - bits)


@pytest.mark.parametrize("text", ["", "a", "Ab ab", "rivière 漢字🙂 x" * 3, "ÀÉ"])
def test_ngrams(text):
    low = text.lower()
    want = Counter(plain_hash(low[i : i + n], 15) for n in (1, 2, 3) for i in range(len(low) - n + 1))
    places, counts = language.ngram_counts(text, 15, 3)
    assert dict(zip(places.tolist(), counts.tolist())) == want


def test_ftrl_is_the_plain_recurrence():
    """Coordinate by coordinate, with plain loops."""
    rng = np.random.default_rng(3)
    docs = [(np.sort(rng.choice(12, 5, replace=False)), rng.random(5)) for _ in range(30)]
    labels = rng.integers(0, 3, 30)
    pen = language.Penalties(alpha=0.7, beta=0.5, l1=0.2, l2=0.3)
    z, n = np.zeros((13, 3)), np.zeros((13, 3))
    language.ftrl_pass(z, n, docs, labels, pen, np.random.default_rng(9))
    zs, ns = [[0.0] * 3 for _ in range(13)], [[0.0] * 3 for _ in range(13)]
    for d in np.random.default_rng(9).permutation(30):
        x = {**{int(p): float(v) for p, v in zip(*docs[d])}, 12: 1.0}
        w = {}
        for i in x:
            for k in range(3):
                a = zs[i][k]
                w[i, k] = 0.0 if abs(a) <= pen.l1 else -(a - math.copysign(pen.l1, a)) / ((pen.beta + math.sqrt(ns[i][k])) / pen.alpha + pen.l2)
        e = [math.exp(sum(x[i] * w[i, k] for i in x)) for k in range(3)]
        for i in x:
            for k in range(3):
                g = x[i] * (e[k] / sum(e) - (labels[d] == k))
                s = (math.sqrt(ns[i][k] + g * g) - math.sqrt(ns[i][k])) / pen.alpha
                zs[i][k] += g - s * w[i, k]
                ns[i][k] += g * g
    assert np.allclose(z, zs) and np.allclose(n, ns)
    assert (pen.weights(z, n) == 0).any()  # the L1 penalty leaves exact zeros


def test_temperature_has_the_smallest_loss():
    rng = np.random.default_rng(0)
    true = rng.normal(size=(2000, 3)) * 2
    labels = np.array([rng.choice(3, p=language.softmax(t)) for t in true])
    assert 2.5 < language.best_temperature(true * 3, labels) < 3.6
    loss = lambda t: -np.log(language.softmax(true * 3 / t)[np.arange(2000), labels]).mean()
    best = language.best_temperature(true * 3, labels)
    assert all(loss(best) <= loss(t) + 1e-9 for t in np.linspace(0.5, 10, 80))
    assert language.best_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_document_frequencies_count_every_document(spark, monkeypatch):
    rows = awkward_rows()
    n, df = language.document_frequencies(frame(spark, rows).repartition(90), 12, 3)
    texts = [t for _, t, _ in rows if language.has_letter(t)]
    want = np.zeros(1 << 12, int)
    for t in texts:
        want[language.ngram_counts(t, 12, 3)[0]] += 1
    assert n == len(texts) and (df == want).all()


def test_awkward_rows(spark):
    rng = random.Random(1)
    french = [f"le la les rivière {rng.choice(['été', 'forêt', 'où'])} {rng.randrange(99)} dans une" for _ in range(60)]
    german = [f"der die das straße {rng.choice(['größe', 'über', 'für'])} {rng.randrange(99)} und eine" for _ in range(60)]
    rows = [(i, t, lang, "s", 1, "x", 1, 7, "f") for i, (t, lang) in enumerate([(t, "fr") for t in french] + [(t, "de") for t in german])]
    rows += [(500, None, "fr", "s", 1, "x", 1, 7, "f"), (501, "", "de", "s", 1, "x", 1, 7, "f"), (502, "12 34 ² _", "de", "s", 1, "x", 1, 7, "f"), (None, "über", "de", "s", 1, "x", 1, 7, "f"), (503, french[0], None, "s", 1, "x", 1, 7, "f")]
    rows += [(7, german[0] + " copy", "zz", "s", 1, "x", 1, 7, "f")] * 3 + [(504, "der " * 50_000, None, "s", 1, "x", 1, 7, "f")]
    docs = spark.createDataFrame(rows, DOCS)
    model = language.fit(docs, F.lit(True))
    got = [tuple(r) for r in language.predict(docs, model).collect()]
    assert len(got) == len(rows)
    by_id = {i: (lang, s) for i, lang, s in got}
    assert {by_id[i][0] for i in (*range(7), *range(8, 60))} == {"fr"} and {by_id[i][0] for i in range(60, 120)} == {"de"}
    assert by_id[500] == by_id[501] == by_id[502] == ("und", 0.0)
    assert by_id[None][0] == "de" and by_id[503][0] == "fr" and by_id[504][0] == "de"
    assert all(0 <= s <= 1 for _, _, s in got)
    assert [tuple(r) for r in language.predict(docs, language.fit(docs, F.lit(True))).collect()] == got  # reruns agree


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], DOCS)
    model = language.fit(empty, F.lit(True))
    assert language.predict(empty, model).collect() == []
    docs = frame(spark, [(1, "bonjour", "a"), (2, None, "a")])
    assert [tuple(r) for r in language.predict(docs, model).collect()] == [(1, "und", 0.0), (2, "und", 0.0)]
    assert [tuple(r) for r in language.predict(docs, language.fit(docs, F.lit(True))).collect()] == [(1, "en", 1.0), (2, "und", 0.0)]


def test_query_held_out_accuracy(spark):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    got = QUERIES["op13_language"](spark, SF).collect()
    assert len(got) == len(langs)
    judged = [r for r in got if r["held_out"] and r["lang_pred"] != "und" and langs[r["doc_id"]] is not None]
    right = [r for r in judged if r["lang_pred"] == langs[r["doc_id"]]]
    assert len(right) >= 0.97 * len(judged)
    # Calibrated: mean score near the share that is right.
    assert abs(sum(r["score"] for r in judged) / len(judged) - len(right) / len(judged)) < 0.05
