r"""Ranked lexical search: the best documents of a whole table for each of a stated set of items.

Terms are the maximal runs of digits, Latin letters (only A-Z lower-cased) and
characters beyond ASCII. A document's score for an item is the sum, over the
item's terms with repeats, of integer weights times integer impacts:

* ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` over the N documents that have terms,
* ``f = 10**9 * tf div (1000 * tf + 8 * m)`` with ``m = 100 - b + b * n * N div L``
  for a document of n terms, L terms in all.

That is an inner product, and the largest are found by length (norm buckets):

1. Documents become vectors over the items' terms, ``sqrt(w) * f``, stored
   with their lengths; the terms of no item add nothing to any score.
2. Those of the longest vectors are searched first, which gives every item a
   score that its last place reaches at least.
3. Every partition is sorted by length, longest first, and read in buckets. A
   bucket whose longest vector times the item's length stays below the item's
   threshold is left out (Cauchy-Schwarz), and with it all that follow.
   Inside a bucket, a cosine as large as needed bounds each coordinate from
   both sides: only documents within the bounds of all the item's coordinates
   that must be above 0 are candidates.
4. Candidates are scored again exactly in integers; each partition hands on
   its best per item, a window ranks them.

Thresholds leave out only what lies strictly below them, so ties and results
are exact. Texts are never shuffled; the vectors are sorted where they lie.
Items are taken in blocks of bounded size (``BLOCK_TERMS``), whose terms and
weights are broadcast; every block is searched against all documents.

Nulls: a null text has no terms; a document without terms counts nowhere. An
item without terms has no results. Null ids come last among equal scores.
Repeated documents are ranked each; repeated items are answered each. Very
long texts are read whole. Empty tables give an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import kept, scratch, stored, stored_at
from lakeloom.plans.workspace import delete_path

#: Terms of items (with their numbers) that a block has, about; a longer item is a block of its own.
BLOCK_TERMS = 400_000
#: Vectors in a bucket.
BUCKET = 1024
#: Vectors at least as long as all but this share give the first thresholds.
LONGEST = 0.03
#: Bounds are computed in doubles; by so much they are widened.
SLACK = 1e-9

#: Bytes of terms as they are counted, all others as spaces.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

ITEM_TERMS = T.StructType([T.StructField("query", T.LongType()), T.StructField("term", T.BinaryType()), T.StructField("times", T.LongType())])
COUNTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("tfs", T.ArrayType(T.IntegerType())),
    ]
)
VECTORS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("impacts", T.ArrayType(T.LongType())),
    ]
)
FOUND = T.StructType([T.StructField("query", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int, b: int = 75) -> np.ndarray:
    """f of each count ``tf`` in a document of ``n`` terms."""
    m = 100 - b + (b * n.astype(np.int64) * n_docs) // n_terms
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass(frozen=True)
class Items:
    """The items of a block: terms and integer weights (repeats included) of each, one after the other."""

    query: np.ndarray  # (items,)
    start: np.ndarray  # (items + 1,)
    term: np.ndarray
    weight: np.ndarray  # w times repeats
    unit: np.ndarray  # coordinates of the vectors of length 1
    length: np.ndarray  # (items,)
    root: np.ndarray  # of each term of the vocabulary, sqrt(w)

    @staticmethod
    def of(rows: list[tuple[int, int, int]], w: np.ndarray) -> Items:
        """From ``query, term, times`` sorted by query, and the terms' weights."""
        rows = [r for r in rows if w[r[1]] > 0]
        query, term, times = np.array(rows, np.int64).reshape(-1, 3).T
        queries, start = np.unique(query, return_index=True)
        root = np.sqrt(w.astype(np.float64))
        value = root[term] * times
        start = np.append(start, len(rows)).astype(np.int64)
        length = np.sqrt(np.array([(value[a:b] ** 2).sum() for a, b in zip(start, start[1:])]))
        return Items(queries, start, term, w[term] * times, value / np.repeat(length, np.diff(start)), length, root)


class Searcher:
    """The best ``k`` documents of each item among vectors given longest first."""

    def __init__(self, items: Items, k: int, thresholds: np.ndarray):
        self.items, self.k = items, k
        self.threshold = np.maximum(thresholds, 1).astype(np.int64)
        none = np.zeros(0, np.int64)
        self.best = [(none, none) for _ in items.query]

    def bucket(self, ids: np.ndarray, length: np.ndarray, offsets: np.ndarray, term: np.ndarray, impact: np.ndarray) -> bool:
        """Search a bucket (``offsets``: entries of each vector); whether later ones may still matter."""
        items = self.items
        active = np.flatnonzero(items.length * (length[0] * (1 + SLACK)) >= self.threshold)
        if not len(active):
            return False
        doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
        order = np.argsort(term, kind="stable")
        term, doc, impact = term[order], doc[order], impact[order]
        at = np.searchsorted(term, np.arange(len(items.root) + 1))
        part = items.root[term] * impact / length[doc]
        for i in active.tolist():
            mine = slice(items.start[i], items.start[i + 1])
            t, unit = items.term[mine], items.unit[mine]
            cosine = min(1.0, self.threshold[i] / (items.length[i] * length[0]))
            spread = np.sqrt((1 - cosine * cosine) * np.maximum(0, 1 - unit * unit))
            least = unit * cosine - spread - SLACK
            needed = np.flatnonzero(least > 0)
            if len(needed):
                # Within the bounds of every coordinate that cannot be 0.
                most = np.where(unit < cosine, unit * cosine + spread, 1.0) + SLACK
                hits = np.zeros(len(ids), np.int64)
                for c in needed.tolist():
                    lo, hi = at[t[c]], at[t[c] + 1]
                    hits[doc[lo:hi][(part[lo:hi] >= least[c]) & (part[lo:hi] <= most[c])]] += 1
                candidate = hits == len(needed)
                if not candidate.any():
                    continue
            else:
                candidate = None
            score = np.zeros(len(ids), np.int64)
            for c, w in zip(t.tolist(), items.weight[mine].tolist()):
                lo, hi = at[c], at[c + 1]
                score[doc[lo:hi]] += w * impact[lo:hi]  # a vector has a term once
            good = score >= self.threshold[i]
            if candidate is not None:
                good &= candidate
            good = np.flatnonzero(good)
            if len(good):
                self._keep(i, ids[good], score[good])
        return True

    def _keep(self, i: int, ids: np.ndarray, score: np.ndarray) -> None:
        ids, score = np.concatenate([self.best[i][0], ids]), np.concatenate([self.best[i][1], score])
        order = np.lexsort((ids, -score))[: self.k]
        self.best[i] = ids[order], score[order]
        if len(order) == self.k:
            self.threshold[i] = max(self.threshold[i], score[order[-1]])


#: Stands for a null id, which comes last among equal scores.
_NO_ID = np.iinfo(np.int64).max


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column."""
    offsets = column.offsets.to_numpy()
    return (offsets - offsets[0]).astype(np.int64), column.values.to_numpy()[offsets[0] : offsets[-1]]


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _item_terms(items: DataFrame) -> DataFrame:
    """``query, term, times`` of ``query, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(q, t, c) for q, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for t, c in Counter(terms(text)).items()]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type) for c, type in zip(columns, (pa.int64(), pa.binary(), pa.int64()))], names=ITEM_TERMS.names)

    return items.select("query", "text").mapInArrow(run, ITEM_TERMS)


def _counted(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents that have terms; terms of the vocabulary only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for b in batches:
            rows, n, held = [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                found = terms(text)
                if found:
                    counts = Counter(map(number, found))
                    counts.pop(None, None)
                    rows.append(i), n.append(len(found)), held.append(counts)
            offsets = np.cumsum([0, *map(len, held)])
            term, tf = (np.fromiter((x for c in held for x in side(c)), np.int32, int(offsets[-1])) for side in (dict.keys, dict.values))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), _lists(offsets, pa.array(term)), _lists(offsets, pa.array(tf))], names=COUNTS.names)

    return docs.mapInArrow(run, COUNTS)


def _vectors(counted: DataFrame, roots, n_docs: int, n_terms: int, b: int) -> DataFrame:
    """``doc_id, length, terms, impacts`` of the documents that have terms of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = roots.value
        for batch in batches:
            offsets, term = _flat(batch.column(2))
            _, tf = _flat(batch.column(3))
            size = np.diff(offsets)
            of = np.repeat(np.arange(batch.num_rows), size)
            impact = impacts(tf, batch.column(1).to_numpy()[of], n_docs, n_terms, b)
            length = np.sqrt(np.bincount(of, (root[term] * impact) ** 2, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length), batch.column(2), _lists(offsets, pa.array(impact))], names=VECTORS.names)

    return counted.where(F.size("terms") > 0).mapInArrow(run, VECTORS).where("length > 0")


def _searched(vectors: DataFrame, items, k: int, thresholds) -> DataFrame:
    """Each partition's ``query, doc_id, score`` of at most ``k`` best documents an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items.value, k, thresholds.value)
        more = True
        for batch in batches:
            for at in range(0, batch.num_rows if more else 0, BUCKET):
                b = batch.slice(at, BUCKET)
                offsets, term = _flat(b.column(2))
                _, impact = _flat(b.column(3))
                ids = b.column(0).fill_null(_NO_ID).to_numpy()
                more = searcher.bucket(ids, b.column(1).to_numpy(), offsets, term, impact)
                if not more:
                    break
        sizes = [len(ids) for ids, _ in searcher.best]
        if sum(sizes):
            ids, score = (np.concatenate(x) for x in zip(*searcher.best))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(items.value.query, sizes)), pa.array(ids), pa.array(score)], names=FOUND.names)

    return vectors.sortWithinPartitions(F.desc("length")).mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, b: int = 75, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` highest-scoring documents of every item, ties by id."""
    with scratch(docs.sparkSession):
        return kept(_search(docs, items, k, b, id_col, text_col, item_col, item_text_col), "lexical-result")


def _search(docs, items, k, b, id_col, text_col, item_col, item_text_col) -> DataFrame:
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    numbered = stored(items.select(F.monotonically_increasing_id().alias("query"), F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")), "lexical-items")
    of_items = stored(_item_terms(numbered), "lexical-item-terms")
    n_blocks = max(1, math.ceil(of_items.count() / BLOCK_TERMS))
    parts = []
    for block in range(n_blocks):
        # About BLOCK_TERMS rows.
        rows = sorted((r["query"], bytes(r["term"]), r["times"]) for r in of_items.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == block).collect())
        if not rows:
            continue
        number = {t: i for i, t in enumerate(sorted({t for _, t, _ in rows}))}
        vocabulary = sc.broadcast(number)
        counted, counted_path = stored_at(_counted(docs, vocabulary), "lexical-counts")
        total = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            break
        # One row for each term of the block.
        df = {r["term"]: r["df"] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
        w = np.array([weight(total["docs"], df[t]) if t in df else 0 for t in range(len(number))], np.int64)
        block_items = Items.of([(q, number[t], times) for q, t, times in rows], w)
        if not len(block_items.query):
            continue
        shared, roots = sc.broadcast(block_items), sc.broadcast(block_items.root)
        vectors = stored(_vectors(counted, roots, total["docs"], total["terms"], b), "lexical-vectors")
        delete_path(spark, counted_path)

        # One score for each item of the block.
        thresholds = np.zeros(len(block_items.query), np.int64)
        long = vectors.agg(F.percentile_approx("length", 1 - LONGEST)).first()[0]
        first = _ranked(_searched(vectors.where(F.col("length") >= F.lit(long or 0.0)), shared, k, sc.broadcast(thresholds)), k)
        for r in first.where(F.col("rank") == k).collect():
            thresholds[np.searchsorted(block_items.query, r["query"])] = r["score"]
        parts.append(stored(_ranked(_searched(vectors, shared, k, sc.broadcast(thresholds)), k), "lexical-found"))
    if not parts:
        empty = numbered.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
        return empty
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    doc_id = F.when(F.col("doc_id") != int(_NO_ID), F.col("doc_id"))
    return numbered.select("query", "item_id").join(found, "query").select("item_id", F.col("rank").cast("int").alias("rank"), doc_id.alias("doc_id"), "score")
