"""Approximate nearest neighbours by cosine: a neighbour graph built by
NN-descent, searched greedily.

Equal vectors are one node; it keeps the few smallest ids that an answer can
need, so a vector with a third of all rows is one node like any other. The
graph starts from the neighbours within blocks of vectors that follow each
other in the order of random hyperplane codes, for several sets of
hyperplanes. Then, round by round, neighbours of neighbours are joined: every
node brings its neighbours, and a sample of the nodes that have it as
neighbour, together; pairs of which at least one is new to it are compared,
and whatever beats a node's worst neighbour enters. It ends when a round
changes few neighbours.

A query walks the graph from its own node: of the best nodes met so far those
not yet expanded bring their neighbours, until the best ``pool`` are all
expanded. A query is one row, with its pool and the nodes it has met; all
queries take each step together, and of a step only nodes that a query has not
met are joined with their vectors. What all queries ask for in a step is counted
and broadcast only up to ``BROADCAST_ASKED`` rows; any more are shuffled, so the
driver's memory does not depend on the number of queries.

What the joins carry are codes, one byte a component; each of the returned
scores is the cosine of the original vectors in double precision, of which
the best ``RESCORED`` times ``k + 1`` nodes of a pool are scored.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows without id. Repeated rows count
once; of an id with several vectors the smallest (by component) is taken.
Ties go to the smaller id. With fewer candidates than ``k`` all are returned.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import kept, scratch, stored, stored_at
from lakeloom.plans.workspace import delete_path

#: So many times the nodes that an answer can need are scored on their original vectors.
RESCORED = 4
#: So many nodes that walks ask for are broadcast at most: about 10 MB in the driver.
BROADCAST_ASKED = 200_000

_EDGES = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType()), T.StructField("sim", T.FloatType())])


def _edge_batch(src, dst, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(sim, pa.float32())], names=_EDGES.names)


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (double) of the rows that take part."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where("vec_id IS NOT NULL AND size(vector) > 0")
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.coalesce(good, F.lit(False))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").head()
    return rows.where(F.size("vector") == (usual["d"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0), np.float32)


def nodes_of(rows: DataFrame, keep: int) -> DataFrame:
    """``node, ids, unit``: different vectors with their ``keep`` smallest ids, and unit vectors in single precision."""
    scale = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    # The largest component first made 1, so that no square over- or underflows.
    peak = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= keep)
    nodes = rows.groupBy("vector").agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = nodes.withColumn("vector", F.transform("vector", lambda x: x / peak)).withColumn("length", scale)
    return nodes.select("node", "ids", F.transform("vector", lambda x: (x / F.col("length")).cast("float")).alias("unit"))


def codes_of(nodes: DataFrame) -> DataFrame:
    """``node, code``: unit vectors with one byte a component, the largest 127."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("code", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                unit = _matrix(b.column(1))
                codes = np.round(unit * (127 / np.abs(unit).max(axis=1, keepdims=True))).astype(np.int8)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], names=schema.names)

    return nodes.select("node", "unit").mapInArrow(run, schema)


def _decoded(codes: list[bytes]) -> np.ndarray:
    """Vectors of length 1 from their codes."""
    x = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _block_edges(nodes: DataFrame, dims: int, degree: int, seed: int, bits: int = 24, block: int = 128) -> DataFrame:
    """Neighbours within blocks of nodes that follow each other by hyperplane code."""
    planes = np.random.default_rng(seed).standard_normal((dims, bits)).astype(np.float32)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                signs = _matrix(b.column(1)) @ planes > 0
                yield pa.RecordBatch.from_arrays([pa.array(signs @ weights, pa.int64()), b.column(0), b.column(1)], names=["code", "node", "unit"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(rows: pa.Table) -> pa.RecordBatch:
            ids, unit = rows.column(1).to_numpy(), _matrix(rows.column(2))
            sims = unit @ unit.T
            np.fill_diagonal(sims, -2)
            k = min(degree, len(ids) - 1)
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(ids), 0), np.int64)
            return _edge_batch(np.repeat(ids, k), ids[best].ravel(), np.take_along_axis(sims, best, 1).ravel())

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= 2 * block:
                rows = pa.Table.from_batches(held)
                while rows.num_rows >= 2 * block:
                    yield solve(rows.slice(0, block))
                    rows = rows.slice(block)
                held = rows.to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    coded = nodes.select("node", "unit").mapInArrow(code, "code long, node long, unit array<float>")
    return coded.repartitionByRange("code", "node").sortWithinPartitions("code", "node").mapInArrow(compare, _EDGES)


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """Each node's ``degree`` best neighbours, ``new`` unless they were there before."""
    edges = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    nth = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    return edges.withColumn("nth", nth).where(F.col("nth") <= degree)


def _local_join(graph: DataFrame, codes: DataFrame, degree: int, reverse: int, seed: int) -> DataFrame:
    """Better neighbours found among the neighbours of each node."""
    nth = F.row_number().over(Window.partitionBy("dst").orderBy(~F.col("new"), F.xxhash64(F.lit(seed), "src")))
    back = graph.withColumn("_nth", nth).where(F.col("_nth") <= reverse).select(F.col("dst").alias("pivot"), F.col("src").alias("node"), "new")
    members = graph.select(F.col("src").alias("pivot"), F.col("dst").alias("node"), "new").unionByName(back)
    members = members.groupBy("pivot", "node").agg(F.max("new").alias("new"))
    worst = graph.groupBy("src").agg(F.when(F.count("*") < degree, F.lit(-2.0)).otherwise(F.min("sim")).cast("float").alias("worst"))
    known = codes.join(worst, codes["node"] == worst["src"]).select("node", "code", "worst")
    # At most degree + reverse members a pivot.
    gathered = members.join(known, "node").groupBy("pivot").agg(F.collect_list(F.struct("node", "new", "worst", "code")).alias("m")).select("m")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(0)
            bounds = lists.offsets.to_numpy()
            m = lists.values
            node, new, worst = (m.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            unit = _decoded(m.field(3).to_pylist()) if len(m) else None
            out = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                ids, fresh, bar = node[lo:hi], new[lo:hi], worst[lo:hi]
                sims = unit[lo:hi] @ unit[lo:hi].T
                np.fill_diagonal(sims, -3)
                # One that is new to the pivot, and better than the worst neighbour of the other.
                sims[~(fresh[:, None] | fresh[None, :])] = -3
                i, j = np.nonzero(sims > bar[:, None])
                out.append((ids[i], ids[j], sims[i, j]))
            if out:
                yield _edge_batch(*(np.concatenate(x) for x in zip(*out)))

    return gathered.mapInArrow(compare, _EDGES)


def neighbour_graph(nodes: DataFrame, codes: DataFrame, degree: int = 30, trees: int = 4, reverse: int = 14, rounds: int = 6, settled: float = 0.02, seed: int = 5) -> DataFrame:
    """``src, dst, sim``: about the ``degree`` nearest nodes of every node."""
    first = nodes.select(F.size("unit").alias("d")).head()
    dims = first["d"] if first else 1
    blocks = reduce(DataFrame.unionByName, [_block_edges(nodes, dims, degree, seed + t) for t in range(trees)])
    graph, path = stored_at(_best(blocks.withColumn("new", F.lit(True)), degree), "ann-graph")
    size = graph.count()
    for r in range(rounds):
        found = _local_join(graph, codes, degree, reverse, seed + r).withColumn("new", F.lit(True))
        known = graph.select("src", "dst", "sim", F.lit(False).alias("new"))
        last = path
        graph, path = stored_at(_best(known.unionByName(found), degree), "ann-graph")
        delete_path(nodes.sparkSession, last)
        if graph.where("new").count() <= settled * size:
            break
    return graph.select("src", "dst", "sim")


_MET = T.StructType([T.StructField("query", T.LongType()), T.StructField("node", T.LongType()), T.StructField("sim", T.FloatType())])
#: A query's walk: ``pool`` its best nodes (best first) with ``sims``, ``done``: whether they were expanded,
#: ``seen``: all nodes it met, ``ask``: the nodes of the next join.
_WALK = T.StructType(
    [
        T.StructField("query", T.LongType()),
        T.StructField("code", T.BinaryType()),
        T.StructField("pool", T.BinaryType()),
        T.StructField("sims", T.BinaryType()),
        T.StructField("done", T.BinaryType()),
        T.StructField("seen", T.BinaryType()),
        T.StructField("ask", T.ArrayType(T.LongType())),
    ]
)


class _Walk:
    """A row of ``_WALK``."""

    def __init__(self, query: int, code: bytes, pool: bytes | None, sims: bytes | None, done: bytes | None, seen: bytes | None, ask=None):
        self.query, self.code = query, code
        first = np.array([query])
        self.pool, self.seen = (first if x is None else np.frombuffer(x, np.int64) for x in (pool, seen))
        self.sims = np.ones(1, np.float32) if sims is None else np.frombuffer(sims, np.float32)
        self.done = np.zeros(1, bool) if done is None else np.frombuffer(done, bool)
        self.ask = np.zeros(0, np.int64)

    def expand(self, beam: int) -> None:
        """The next nodes to expand: the best that are not."""
        now = np.flatnonzero(~self.done)[:beam]
        self.done = self.done.copy()
        self.done[now] = True
        self.ask = self.pool[now]

    def reach(self, found: np.ndarray) -> None:
        """Of the neighbours found, those not met before."""
        fresh = np.setdiff1d(found, self.seen)
        self.seen = np.concatenate([self.seen, fresh])
        self.ask = fresh

    def meet(self, nodes: np.ndarray, codes: list[bytes], pool: int) -> None:
        """Take the nodes met into the pool."""
        if len(nodes):
            sims = (_decoded(codes) @ _decoded([self.code])[0]).astype(np.float32)
            nodes, sims = np.concatenate([self.pool, nodes]), np.concatenate([self.sims, sims])
            done = np.concatenate([self.done, np.zeros(len(nodes) - len(self.done), bool)])
            best = np.lexsort((nodes, -sims))[:pool]
            self.pool, self.sims, self.done = nodes[best], sims[best], done[best]


def _walks(walks: list[_Walk]) -> pa.RecordBatch:
    binary = [pa.array([getattr(w, c).tobytes() for w in walks], pa.binary()) for c in ("pool", "sims", "done", "seen")]
    columns = [pa.array([w.query for w in walks], pa.int64()), pa.array([w.code for w in walks], pa.binary()), *binary, pa.array([w.ask for w in walks], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=_WALK.names)


def _each_walk(rows: DataFrame, change) -> DataFrame:
    """``change(walk, further columns)`` applied to every walk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(_WALK)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                walks = [_Walk(*row) for row in zip(*(part.column(i).to_pylist() for i in range(n)))]
                for k, w in enumerate(walks):
                    change(w, [part.column(i)[k] for i in range(n, part.num_columns)])
                yield _walks(walks)

    return rows.mapInArrow(run, _WALK)


def _asked(walks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``query`` and the nodes that it asks for, a row each, to be joined; and how many these are."""
    n = walks.agg(F.sum(F.size("ask"))).first()[0] or 0
    rows = walks.select("query", F.explode("ask").alias(name))
    # Counted, as Spark takes each list for one value and a stored walk for mostly other columns: by its estimate
    # the driver would gather lists of over thirty times the broadcast limit.
    return F.broadcast(rows) if n <= BROADCAST_ASKED else rows.hint("merge"), n


def greedy_search(queries: DataFrame, codes: DataFrame, graph: DataFrame, pool: int = 320, beam: int = 40, reverse: int = 30, most_steps: int = 40) -> DataFrame:
    """``query, node, sim``: the best ``pool`` nodes that each query node (column ``query``) meets."""
    spark = queries.sparkSession
    nth = F.row_number().over(Window.partitionBy("dst").orderBy(F.desc("sim"), "src"))
    back = graph.withColumn("nth", nth).where(F.col("nth") <= reverse).select(F.col("dst").alias("at"), F.col("src").alias("node"))
    ways = graph.select(F.col("src").alias("at"), F.col("dst").alias("node")).unionByName(back)
    # At most degree + reverse a node.
    ways = stored(ways.groupBy("at").agg(F.collect_set("node").alias("to")), "ann-ways")

    def expand(w: _Walk, _) -> None:
        w.expand(beam)

    def reach(w: _Walk, more) -> None:
        lists = more[0].values
        w.reach(lists.flatten().to_numpy() if lists is not None else np.zeros(0, np.int64))

    def meet(w: _Walk, more) -> None:
        met = more[0].values
        if met is not None:
            w.meet(met.field(0).to_numpy(), met.field(1).to_pylist(), pool)
        w.expand(beam)

    first = codes.join(queries.select(F.col("query").alias("node")), "node").select(F.col("node").alias("query"), "code")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in _WALK.fields[2:]]
    walks, path = stored_at(_each_walk(first.select("query", "code", *none), expand), "ann-walks")
    for _ in range(most_steps):
        asked, n = _asked(walks, "at")
        if not n:
            break
        # Neighbours of the expanded nodes, then the vectors of those not met before: bounded lists a query.
        front = asked.join(ways, "at").groupBy("query").agg(F.collect_list("to").alias("found"))
        reached, reached_path = stored_at(_each_walk(walks.join(front, "query", "left"), reach), "ann-reached")
        fresh, _ = _asked(reached, "node")
        vectors = fresh.join(codes, "node").groupBy("query").agg(F.collect_list(F.struct("node", "code")).alias("met"))
        last = path
        walks, path = stored_at(_each_walk(reached.join(vectors, "query", "left"), meet), "ann-walks")
        delete_path(spark, last)
        delete_path(spark, reached_path)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for query, nodes, sims in zip(*(b.column(i).to_pylist() for i in range(3))):
                nodes, sims = np.frombuffer(nodes, np.int64), np.frombuffer(sims, np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), query)), pa.array(nodes), pa.array(sims)], names=_MET.names)

    return walks.select("query", "pool", "sims").mapInArrow(pairs, _MET)


def nearest(table: DataFrame, is_query, k: int = 5, degree: int = 30, pool: int = 320, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found of every row for which ``is_query`` (an expression over ``vec_id``) holds."""
    with scratch(table.sparkSession):
        return kept(_nearest(table, is_query, k, degree, pool, id_col, vector_col), "ann-result")


def _nearest(table: DataFrame, is_query, k: int, degree: int, pool: int, id_col: str, vector_col: str) -> DataFrame:
    rows = stored(usable(table, id_col, vector_col), "ann-rows")
    nodes = stored(nodes_of(rows, k + 1), "ann-nodes")
    codes = stored(codes_of(nodes), "ann-codes")
    graph = neighbour_graph(nodes, codes, degree)
    of_node = nodes.select("node", F.explode("ids").alias("vec_id"))

    # The node of every query row, through its vector.
    vector_of = rows.join(nodes.select(F.col("node").alias("vec_id"), "node"), "vec_id").select("node", "vector")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector").join(vector_of, "vector").select("query_id", "node")
    queries = stored(queries, "ann-queries")
    met = greedy_search(queries.select(F.col("node").alias("query")).distinct(), codes, graph, pool)

    # Copies of near nodes, scored on the original vectors; k + 1 of them are enough for any query at the node.
    near = met.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "node"))).where(F.col("nth") <= RESCORED * (k + 1))
    a = vector_of.select(F.col("node").alias("query"), F.col("vector").alias("a"))
    scored = near.join(vector_of.withColumnRenamed("vector", "b"), "node").join(a, "query")

    def dot(x: str, y: str):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    # Vectors whose squares would leave the doubles are scaled by a power of two first, which changes no digit.
    for c in ("a", "b"):
        peak = F.array_max(F.transform(c, lambda x: F.abs(x)))
        power = F.pow(F.lit(2.0), -F.floor(F.log2(peak)).cast("double"))
        odd = (peak > 1e100) | (peak < 1e-100)
        scored = scored.withColumn("p", F.when(odd, power)).withColumn(c, F.when(F.col("p").isNotNull(), F.transform(c, lambda x: x * F.col("p"))).otherwise(F.col(c)))
    scored = scored.select("query", "node", (dot("a", "b") / (F.sqrt(dot("a", "a")) * F.sqrt(dot("b", "b")))).alias("score"))
    ids = scored.join(of_node, "node").groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = [F.desc("score"), "vec_id"]
    ids = ids.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("nth") <= k + 1).drop("nth")
    answers = queries.join(ids, queries["node"] == ids["query"]).where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
