r"""Toxicity by a factorization machine over hashed terms.

Terms (``\w+`` of the lower-cased text) are hashed to 2**bits places. A text's
logit is the sum of the weights of its distinct terms plus, for every pair of
them, the product of their factor vectors (scaled by the number of terms
whose factors are not 0): pairs such as an insult with the mention of a group
get a weight of their own without being counted one by one.

The model is fitted on a bounded sample of at most ``max_train`` labelled
rows, those first in a hashed order. Places that fewer than ``least_texts`` of its
texts have, a fixed number whatever the sample's size, are left out of the
model; of the others, chance ones are held back by the caution. Weights start
from the log-odds of the label given the place, drawn towards 0 by
``caution`` standard errors. Every place has factors, small and random at
first, so that a pair is learned also if neither of its terms tells anything
alone. A vector is drawn towards 0 as a whole, from round to round up to
``shrink``: those that stay 0 add no noise, and leave 0 when their gradient
exceeds that. The sample is dealt to workers by hash; in each round every
worker trains from the common model on its share and the models, of a fixed
size, are averaged. Scoring reads every whole text where it lies; only the
model travels.

Nulls: a null text is an empty one, its score is that of the bias; rows
without label, or whose label is null, do not train. Ties in the hashed order
go by id. Repeated rows are scored each. Without labelled rows the model is
neutral (score 0.5). An empty table gives an empty result. Other columns are
never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import scratch, stored

_TERM = re.compile(r"\w+")


def hashed_terms(text: str, bits: int) -> np.ndarray:
    """Sorted places of the distinct terms."""
    mask = (1 << bits) - 1
    found = {zlib.crc32(t.encode()) & mask for t in set(_TERM.findall(text.lower()))}
    return np.array(sorted(found), dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    bias: float
    row: np.ndarray  # (2**bits,): the model's row of each place, 0 for places that are not in it
    weights: np.ndarray  # (rows,)
    factors: np.ndarray  # (rows, rank)

    @property
    def paired(self) -> np.ndarray:
        """Of each row, whether its factors are not 0."""
        return self.factors.any(axis=1)

    @property
    def bits(self) -> int:
        return len(self.row).bit_length() - 1

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        """Probability of the label for each document's places."""
        return _sigmoid(self.bias + _forward(self.weights, self.factors, *_flat(self.known(docs), self.paired))[0])

    def known(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """The documents' rows of the model."""
        return [r[r > 0] for r in (self.row[d] for d in docs)]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


#: Logits of pairs are scaled by so much over the root of the number of terms with factors, 1 at most.
PAIR_SCALE = 2.5


def _flat(docs: list[np.ndarray], paired: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places, the document of each, and the scale of each document's pairs."""
    places = (np.concatenate(docs) if len(docs) else np.zeros(0, np.uint32)).astype(np.int64)
    of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    return places, of, np.minimum(1, PAIR_SCALE / np.sqrt(np.maximum(np.bincount(of, paired[places], len(docs)), 1)))


def _sums(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    if values.ndim == 1:
        return np.bincount(of, values, n)
    return np.stack([np.bincount(of, values[:, j], n) for j in range(values.shape[1])], axis=1)


def _forward(weights, factors, places, of, scale):
    """Logits without bias, each document's factor sums, and the factors in use."""
    n = len(scale)
    v = factors[places].astype(np.float64)
    sums = _sums(v, of, n)
    pairs = 0.5 * ((sums**2).sum(1) - np.bincount(of, (v**2).sum(1), n))
    return np.bincount(of, weights[places], n) + scale * pairs, sums, v


def initial_model(with_label: np.ndarray, without: np.ndarray, n_with: int, n_without: int, rank: int, least_texts: int, caution: float, seed: int) -> Model:
    """From the numbers of texts with and without the label, in all and by place."""
    n = n_with + n_without
    used = with_label + without >= least_texts
    odds = np.log((with_label + 0.5) / (n_with - with_label + 0.5)) - np.log((without + 0.5) / (n_without - without + 0.5))
    error = np.sqrt(1 / (with_label + 0.5) + 1 / (n_with - with_label + 0.5) + 1 / (without + 0.5) + 1 / (n_without - without + 0.5))
    row = np.where(used, np.cumsum(used), 0).astype(np.int32)
    weights = np.append(0, (np.sign(odds) * np.maximum(0, np.abs(odds) - caution * error))[used])
    # Smaller in longer texts, whose pairs are more. Row 0 is no place.
    size = max(1.0, (with_label + without)[used].sum() / max(n, 1))
    factors = np.random.default_rng(seed).standard_normal((len(weights), rank)) * 0.3 / np.sqrt(size)
    factors[0] = 0
    return Model(float(np.log((n_with + 0.5) / (n_without + 0.5))), row, weights.astype(np.float32), factors.astype(np.float32))


def train(model: Model, docs: list[np.ndarray], labels: np.ndarray, epochs: int, seed: int, rate: float = 0.05, decay: float = 0.01, batch: int = 32, shrink: float = 0.0) -> Model:
    """AdaGrad on the logistic loss over ``epochs`` passes; each step draws factor vectors towards 0 by ``shrink`` of its size."""
    docs = model.known(docs)
    rng = np.random.default_rng(seed)
    bias, weights, factors = model.bias, model.weights.astype(np.float64), model.factors.astype(np.float64)
    paired = model.paired
    seen_w, seen_v, seen_b = np.full(weights.shape, 1.0), np.full(factors.shape, 1.0), 1.0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            places, of, scale = _flat([docs[i] for i in rows], paired)
            logits, sums, v = _forward(weights, factors, places, of, scale)
            error = _sigmoid(bias + logits) - labels[rows]
            used, back = np.unique(places, return_inverse=True)
            m = len(used)
            gw = np.bincount(back, error[of], m) + decay * weights[used]
            gv = _sums((error * scale)[of, None] * (sums[of] - v), back, m) + decay * factors[used]
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            weights[used] -= rate * gw / np.sqrt(seen_w[used])
            moved = factors[used] - 2 * rate * gv / np.sqrt(seen_v[used])
            least = 2 * rate * shrink / np.sqrt(seen_v[used].mean(1, keepdims=True))
            factors[used] = moved * np.maximum(0, 1 - least / np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12))
            paired[used] = factors[used].any(axis=1)
            gb = error.sum()
            seen_b += gb**2
            bias -= rate * gb / np.sqrt(seen_b)
    return replace(model, bias=float(bias), weights=weights.astype(np.float32), factors=factors.astype(np.float32))


_SHARE = T.StructType([T.StructField("worker", T.IntegerType()), T.StructField("label", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("places", T.BinaryType())])


def _counter(bits: int):
    """Numbers of texts with and without the label in one worker's share."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        label = pdf["label"].to_numpy() > 0
        found = [np.bincount(np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(x, np.uint32) for x in pdf["places"][rows])]).astype(np.int64), minlength=1 << bits).astype(np.int32) for rows in (label, ~label)]
        return pd.DataFrame({"n_with": [int(label.sum())], "n_without": [int((~label).sum())], "with_label": [found[0].tobytes()], "without": [found[1].tobytes()]})

    return one


def _trainer(common, epochs: int, seed: int, shrink: float):
    """Trains the common model on one worker's share."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "places"])
        places = [np.frombuffer(x, np.uint32) for x in pdf["places"]]
        m = train(common.value, places, pdf["label"].to_numpy(np.float64), epochs, seed, shrink=shrink)
        return pd.DataFrame({"worker": pdf["worker"].iloc[:1].to_numpy(), "rows": len(pdf), "bias": m.bias, "weights": [m.weights.tobytes()], "factors": [m.factors.tobytes()]})

    return one


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    usable: Column,
    bits: int = 18,
    rank: int = 4,
    max_train: int = 30_000,
    docs_per_worker: int = 4_000,
    least_texts: int = 3,
    caution: float = 2.0,
    rounds: int = 6,
    epochs: int = 1,
    shrink: float = 0.08,
    seed: int = 11,
) -> Model:
    """Fit on at most ``max_train`` rows of ``labels`` for which ``usable`` (an expression over ``doc_id``) holds."""
    with scratch(docs.sparkSession):
        return _fit(docs, labels, label_col, usable, bits, rank, max_train, docs_per_worker, least_texts, caution, rounds, epochs, shrink, seed)


def _fit(docs, labels, label_col, usable, bits, rank, max_train, docs_per_worker, least_texts, caution, rounds, epochs, shrink, seed) -> Model:
    order = F.xxhash64(F.lit(seed), "doc_id")
    sample = labels.where(usable & F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    # One label per document: the largest, should a document have several.
    sample = sample.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label")).orderBy(order, "doc_id").limit(max_train)
    sample = stored(sample, "toxicity-sample")
    n = sample.count()
    workers = max(1, round(n / docs_per_worker))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = [hashed_terms(t or "", bits).tobytes() for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(places, pa.binary())], names=_SHARE.names)

    # At most max_train rows of two numbers are broadcast.
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    labelled = labelled.select(F.pmod(order, F.lit(workers)).cast("int").alias("worker"), "label", "doc_id", "text").mapInArrow(features, _SHARE)
    shares = stored(labelled, "toxicity-shares")

    # One row of counts of fixed size from each of max_train / docs_per_worker workers.
    counts = shares.groupBy("worker").applyInPandas(_counter(bits), "n_with long, n_without long, with_label binary, without binary").collect()
    n_with, n_without = (sum(x[c] for x in counts) for c in ("n_with", "n_without"))
    with_label, without = (sum((np.frombuffer(x[c], np.int32) for x in counts), np.zeros(1 << bits)) for c in ("with_label", "without"))
    model = initial_model(with_label, without, n_with, n_without, rank, least_texts, caution, seed)
    if not counts:
        return model
    # Few rows make few steps: they are passed over up to three times a round.
    epochs *= min(3, max(1, round(docs_per_worker * workers / max(1, n))))
    result = "worker int, rows long, bias double, weights binary, factors binary"
    sc = docs.sparkSession.sparkContext
    for r in range(rounds):
        common = sc.broadcast(model)

        # One model, of its used places only, from each of max_train / docs_per_worker workers.
        found = sorted(shares.groupBy("worker").applyInPandas(_trainer(common, epochs, seed + r, shrink * r / max(1, rounds - 1)), result).collect(), key=lambda x: x["worker"])
        share = np.array([x["rows"] for x in found], float)
        share /= share.sum()
        model = replace(
            model,
            bias=float(sum(s * x["bias"] for s, x in zip(share, found))),
            weights=sum(s * np.frombuffer(x["weights"], np.float32) for s, x in zip(share, found)).astype(np.float32),
            factors=sum(s * np.frombuffer(x["factors"], np.float32) for s, x in zip(share, found)).astype(np.float32).reshape(-1, rank),
        )
        common.destroy()
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` of every text."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    common = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = common.value
        for b in batches:
            texts = b.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                found = m.scores([hashed_terms(t or "", m.bits) for t in texts[at : at + 256]])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, 256), pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32), pa.int32())], names=schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are kept from training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose score is below ``threshold``."""
    common = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        m = common.value
        runs = [texts.iloc[i : i + 256] for i in range(0, len(texts), 256)]
        return pd.Series(np.concatenate([m.scores([hashed_terms(t or "", m.bits) for t in run]) for run in runs]) if runs else np.zeros(0))

    return docs.where(scored(F.col(text_col)) < threshold)
