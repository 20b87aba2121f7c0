r"""Language identification by sparse multinomial logistic regression.

Features are character n-grams (1 to ``max_n`` code points of the text, its
simple letters lower-cased), hashed to 2**bits places; a text's vector has
``(1 + log tf) * idf`` of its places, scaled to length 1. Document frequencies
are counted over the whole texts of all learning documents.

The weights come from follow-the-regularised-leader (FTRL-Proximal) with an
elastic net: per coordinate, the gradients seen so far give a closed-form
weight that is exactly 0 within the L1 penalty and drawn towards 0 by the L2
penalty, so the model is sparse. Training is bounded to ``max_train`` learning
documents, those first in a hashed order. They are dealt to workers by that
hash; in each round every worker passes over its share from the common state
and the states, of a fixed size, are averaged, weighted by rows. A tenth of
the sample, kept from training, then gives the temperature that the logits
are divided by (smallest log loss, golden-section search), so that scores are
probabilities of being right. Scoring reads every whole text where it lies;
only the model travels.

A label that only the calibration rows have is not predicted. With one
label, or none, in the sample there is nothing to tell apart: that label, or
``und``, is predicted.

Nulls: a text that is null or has no letter is ``und`` with score 0, as no
language has any evidence; documents without label, text or letters do not
train. A null id stays null; such rows do not train. Ties in the hashed order
go by id; of rows with equal id one trains, the first by label and text. Equal probabilities go to the label first by code point. Repeated
rows are scored each. Very long texts are read whole. An empty table gives an
empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import scratch, stored

UNDETERMINED = "und"
#: With fewer rows than this a round has several passes.
FEW_ROWS = 3_000
_LETTER = regex.compile(r"\p{L}")

PREDICTED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_SHARE = T.StructType(
    [
        T.StructField("worker", T.IntegerType()),
        T.StructField("calibrates", T.BooleanType()),
        T.StructField("lang", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("places", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def ngram_counts(text: str, bits: int, max_n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places (sorted) of the text's character n-grams and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    shift, counts = np.uint32(32 - bits), np.zeros(1 << bits, np.int64)
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, max_n + 1):
        if len(codes) < n:
            break
        # An n-gram's hash from that of the n - 1 before its last character.
        h = (h[: len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1 :]) * np.uint32(0x9E3779B1) + np.uint32(n)
        counts += np.bincount((h * np.uint32(0x85EBCA6B)) >> shift, minlength=1 << bits)
    places = np.flatnonzero(counts)
    return places.astype(np.uint32), counts[places]


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    idf: np.ndarray  # (places,)
    weights: np.ndarray  # (places + 1, labels); the last row is the bias
    temperature: float
    max_n: int

    @property
    def bits(self) -> int:
        return len(self.idf).bit_length() - 1

    def logits(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        places = places.astype(np.int64)
        return vector(places, counts, self.idf) @ self.weights[places] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNDETERMINED, 0.0
        p = softmax(self.logits(*ngram_counts(text, self.bits, self.max_n)) / self.temperature)
        best = int(np.argmax(p))
        return self.labels[best], float(p[best])


def vector(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of length 1."""
    x = (1 + np.log(counts)) * idf[places]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Penalties:
    """FTRL-Proximal: rate ``alpha / (beta + root of the squared gradients' sum)``, L1 and L2 penalties."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.5

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The weights that minimise the linearised losses so far plus the elastic net."""
        drawn = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -drawn / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def ftrl_pass(z: np.ndarray, n: np.ndarray, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, penalties: Penalties, rng) -> None:
    """One pass over ``docs`` (places, values) in random order; changes the state ``z, n`` in place. The last row is the bias."""
    bias = len(z) - 1
    for i in rng.permutation(len(docs)):
        places = np.append(docs[i][0].astype(np.int64), bias)
        x = np.append(docs[i][1], 1.0)
        zi, ni = z[places], n[places]
        w = penalties.weights(zi, ni)
        p = softmax(x @ w)
        p[labels[i]] -= 1
        g = x[:, None] * p[None, :]
        g2 = g * g
        sigma = (np.sqrt(ni + g2) - np.sqrt(ni)) / penalties.alpha
        z[places] = zi + g - sigma * w
        n[places] = ni + g2


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the smallest log loss, between 1/20 and 20 (golden-section search on its logarithm)."""

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), labels]).mean())

    if not len(logits):
        return 1.0
    ratio = (np.sqrt(5) - 1) / 2
    lo, hi = -np.log(20), np.log(20)
    a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
    fa, fb = loss(a), loss(b)
    for _ in range(60):
        if fa <= fb:
            hi, b, fb = b, a, fa
            a = hi - ratio * (hi - lo)
            fa = loss(a)
        else:
            lo, a, fa = a, b, fb
            b = lo + ratio * (hi - lo)
            fb = loss(b)
    return float(np.exp((lo + hi) / 2))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are kept from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def document_frequencies(docs: DataFrame, bits: int, max_n: int) -> tuple[int, np.ndarray]:
    """Of the texts that have letters, their number and how many have each place."""
    schema = T.StructType([T.StructField("texts", T.LongType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, df = 0, np.zeros(1 << bits, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                if has_letter(text):
                    texts += 1
                    df[ngram_counts(text, bits, max_n)[0]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([texts], pa.int64()), pa.array([df.tobytes()], pa.binary())], names=schema.names)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        df = sum((np.frombuffer(c, np.int64) for c in pdf["counts"]), np.zeros(1 << bits, np.int64))
        return pd.DataFrame({"texts": [int(pdf["texts"].sum())], "counts": [df.tobytes()]})

    # One row of fixed size from each task, added up in groups of at most 64 until few are left.
    sums = stored(docs.select("text").mapInArrow(run, schema), "language-df")
    left = sums.count()
    while left > 64:
        groups = -(-left // 64)
        dealt = sums.withColumn("group", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(groups)))
        sums = stored(dealt.groupBy("group").applyInPandas(lambda pdf: add(pdf), schema), "language-df")
        left = sums.count()
    rows = sums.collect()
    return sum(r["texts"] for r in rows), sum((np.frombuffer(r["counts"], np.int64) for r in rows), np.zeros(1 << bits, np.int64))


def fit(
    docs: DataFrame,
    usable: Column,
    bits: int = 15,
    max_n: int = 3,
    max_train: int = 12_000,
    docs_per_worker: int = 1_500,
    rounds: int = 3,
    penalties: Penalties = Penalties(),
    seed: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Learn from the rows of ``docs`` for which ``usable`` (an expression over ``doc_id``) holds; weights from at most ``max_train`` of them."""
    with scratch(docs.sparkSession):
        named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        learning = named.where(usable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        return _fit(learning, bits, max_n, max_train, docs_per_worker, rounds, penalties, seed)


def _fit(learning: DataFrame, bits, max_n, max_train, docs_per_worker, rounds, penalties, seed) -> Model:
    spark = learning.sparkSession
    order = F.xxhash64(F.lit(seed), "doc_id")
    # Ids alone are ordered; at most max_train of them are broadcast.
    sample = stored(learning.select("doc_id").distinct().orderBy(order, "doc_id").limit(max_train), "language-sample")
    n = sample.count()
    texts, df = document_frequencies(learning, bits, max_n)
    idf = np.log((1 + texts) / (1 + df)) + 1
    workers = max(1, round(n / docs_per_worker))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [ngram_counts(t, bits, max_n) for t in b.column(4).to_pylist()]
            packed = [pa.array([x.tobytes() for x in side], pa.binary()) for side in ([p for p, _ in found], [c for _, c in found])]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), *packed], names=_SHARE.names)

    # One row of an id, the first by label and text.
    first = learning.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("first")).select("doc_id", "first.*")
    dealt = first.select(F.pmod(order, F.lit(workers)).cast("int").alias("worker"), (F.pmod(F.shiftright(order, 32), F.lit(10)) == 0).alias("calibrates"), "lang", "doc_id", "text")
    shares = stored(dealt.mapInArrow(features, _SHARE), "language-shares")
    labels = tuple(sorted(r["lang"] for r in shares.where("NOT calibrates").select("lang").distinct().collect()))
    shape = ((1 << bits) + 1, len(labels))
    if len(labels) < 2:
        return Model(labels, idf, np.zeros(shape), 1.0, max_n)

    z, seen = np.zeros(shape), np.zeros(shape)
    state = "worker int, rows long, z binary, n binary"
    number = {lang: i for i, lang in enumerate(labels)}
    sc = spark.sparkContext
    for r in range(rounds):
        common = sc.broadcast((z.astype(np.float32), seen.astype(np.float32), idf))
        # Few rows make few steps: they are passed over several times a round.
        passes = max(1, min(8, FEW_ROWS // max(1, n)))
        trainer = _trainer(common, number, penalties, passes, seed + r, shape)
        found = sorted(shares.where("NOT calibrates").groupBy("worker").applyInPandas(trainer, state).collect(), key=lambda x: x["worker"])
        share = np.array([x["rows"] for x in found], float)
        share /= share.sum()
        z = sum(s * np.frombuffer(x["z"], np.float32).reshape(shape) for s, x in zip(share, found))
        seen = sum(s * np.frombuffer(x["n"], np.float32).reshape(shape) for s, x in zip(share, found))
        common.destroy()
    model = Model(labels, idf, penalties.weights(z, seen), 1.0, max_n)
    return Model(labels, idf, model.weights, _calibrated(shares, model, number), max_n)


def _trainer(common, number: dict[str, int], penalties: Penalties, passes: int, seed: int, shape):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        z, n, idf = (a.astype(np.float64) for a in common.value)
        pdf = pdf.sort_values(["doc_id", "lang", "places", "counts"], ignore_index=True)
        docs = []
        for p, c in zip(pdf["places"], pdf["counts"]):
            places = np.frombuffer(p, np.uint32).astype(np.int64)
            docs.append((places, vector(places, np.frombuffer(c, np.int64), idf)))
        labels = np.array([number[x] for x in pdf["lang"]])
        rng = np.random.default_rng((seed, int(pdf["worker"].iloc[0])))
        for _ in range(passes):
            ftrl_pass(z, n, docs, labels, penalties, rng)
        return pd.DataFrame({"worker": [pdf["worker"].iloc[0]], "rows": [len(pdf)], "z": [z.astype(np.float32).tobytes()], "n": [n.astype(np.float32).tobytes()]})

    return run


def _calibrated(shares: DataFrame, model: Model, number: dict[str, int]) -> float:
    """Temperature from the rows kept from training: at most about max_train / 10, of one number a label."""
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("logits", T.ArrayType(T.DoubleType()))])
    common = shares.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = common.value
        for b in batches:
            label, logits = [], []
            for lang, p, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                if lang in number:
                    label.append(number[lang])
                    logits.append(m.logits(np.frombuffer(p, np.uint32), np.frombuffer(c, np.int64)).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(logits, pa.list_(pa.float64()))], names=schema.names)

    rows = shares.where("calibrates").select("lang", "places", "counts").mapInArrow(run, schema).collect()
    return best_temperature(np.array([r["logits"] for r in rows]), np.array([r["label"] for r in rows], int))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every text."""
    common = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = common.value
        for b in batches:
            found = [m.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=PREDICTED.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PREDICTED)
