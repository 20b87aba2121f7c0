r"""N-gram Jaccard join by token-combination prefixes.

Documents are sets of distinct word shingles (here: tokens); two documents
link when ``100 * |intersection| >= percent * |union|``. Returned are link
components: copies of a set are one class, and no link between different sets
is lost.

1. Sets are hashed once; equal sets become one class.
2. Of a set of n tokens at most ``e = n - ceil(percent * n / 100)`` may be
   missing from a partner. So of the first e + k tokens in a fixed order (here:
   by hash) at least k are shared with any partner, and the one of two partners
   whose first tokens end first finds its k among the other's. From here on a
   set is its first tokens, and partners have ``required`` of them in common:
   k of the smallest set that could be a partner.
3. First tokens are counted, ordered from rare to frequent and dealt to
   frequency classes: single rare tokens are indexed, of more frequent classes
   combinations of 2 and of 3 tokens. A class is split into sub-classes by
   hash, so that the combinations of a long document stay in proportion to its
   length. The prefix of a set is extended until, over all sub-classes,
   ``max(0, tokens - (combination size - 1))`` exceeds the number of first
   tokens that may be missing. If no combination of two partners' prefixes were
   shared, more than that would be missing from the one whose prefix ends
   first: a contradiction, so every linked pair shares an index entry. Tokens
   that no other set has come first and need no entry; a set with too many of
   them has no partner at all. The number of sub-classes goes by powers of two
   of the set size; sets near a boundary are indexed for both.
4. Entries connect sets to candidate clusters: sets that share an entry are
   united inside each batch of a task, and only a spanning forest and one set
   per entry go on to the shuffle by entry, where the same is done again. So
   an entry that very many sets have is a few rows. Sets that are alike share
   very many entries, which meet in as many batches: of every ``EARLY``
   entries one is united first, and for the others a set stands as the first of
   its component, so that they only link what is not united yet.
5. Of clusters with more than ``FEW_SETS`` sets, whole sets are indexed in
   the same way, their tokens counted within these clusters: prefixes are as
   long as they can be, and common tokens exceed what partners must share far
   less often. Sets that only have boilerplate in common fall apart here. Each
   token of each such set is listed once, however large its cluster is.
6. Within a cluster every set is compared with one hub (the set with fewest
   unshared tokens). Sets linked to the hub need no comparison among
   themselves; all other pairs are verified in blocks, exactly, and only a
   spanning forest of their links leaves a task. So a group of many thousand
   near copies is spread over many tasks and never written out as pairs.
7. Links give components.

Tokens are 64-bit hashes of shingles.

Nulls: a null text is an empty set, which links with nothing, as does a text
without words. A text with fewer words than a shingle is one shingle. Rows
with equal id and different texts are told apart by an own row number; rows
without id take part and may have a null component. Repeated rows are copies.
Very long texts are long sets. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import fresh_name, kept, scratch, stored, stored_at
from lakeloom.llm.components import connected_components, spanning_forest
from lakeloom.operators.bloom import filter_bytes, key_filter, with_may_contain
from lakeloom.plans.broadcast import DEFAULT_MAX_BYTES
from lakeloom.plans.workspace import delete_path

#: Tokens in at most so many sets are indexed singly, then by twos; all others by threes.
SINGLES, TWOS = 16, 512
#: Further first tokens: as many as may be missing, but no more than this share of a set.
MARGIN = 0.1
#: One of so many index entries is united before the others, a power of two: sets share dozens of entries, so few are left to do.
EARLY = 16
#: Clusters of at most so many sets are compared as they are: less work than listing their tokens.
FEW_SETS = 3
#: Most sets, and about most tokens, in a block.
BLOCK_SETS, BLOCK_TOKENS = 256, 500_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes: A-Z lower-cased, words split at white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    width = min(n, len(ids))
    # A whole short text differs from any full shingle by its width.
    h = np.full(len(ids) - width + 1, width, np.uint64)
    for j in range(width):
        h = _mixed(h) + ids[j : len(ids) - width + 1 + j]
    return np.unique(_mixed(h))


def allowed(n: int, percent: int) -> int:
    """Most tokens of a set of ``n`` that a partner may lack."""
    return n - (percent * n + 99) // 100


def margin(n: int, percent: int) -> int:
    """k: how many of its first tokens a set of ``n`` shares with any partner, at least."""
    e = allowed(n, percent)
    return min(1 + min(e, int(MARGIN * n)), n - e)


def required(n: int, percent: int, whole: bool = False) -> int:
    """First tokens that partners have in common, whichever of them ends first; of ``whole`` sets, all tokens in common."""
    return n - allowed(n, percent) if whole else margin((percent * n + 99) // 100, percent)


def signatures(n: int, df: np.ndarray, tokens: np.ndarray, percent: int, whole: bool = False) -> set[int]:
    """Index entries of a set of ``n`` tokens; ``tokens`` are its first (or all) tokens that other sets have too (``df`` sets each)."""
    need = len(tokens) - required(n, percent, whole) + 1  # first tokens of this set alone come before these
    if need <= 0:
        return set()
    order = np.lexsort((tokens, df))
    tokens, df = tokens[order].tolist(), df[order].tolist()
    least, most = (percent * n + 99) // 100, 100 * n // percent
    out: set[int] = set()
    for level in range(max(1, least).bit_length() - 1, max(1, most).bit_length()):
        # Three tokens a sub-class at most do not count; there must be enough others. With no sub-class all are single.
        groups = required(1 << level, percent, whole) // 4
        held: dict[tuple[int, int], list[int]] = {}
        left = need
        for t, f in zip(tokens, df):
            size = 1 if f <= SINGLES or not groups else 2 if f <= TWOS else 3
            group = held.setdefault((size, (t >> 20) % groups if size > 1 else 0), [])
            group.append(t)
            left -= len(group) >= size
            if not left:
                break
        for (size, _), group in held.items():
            if size == 1:
                out.update(group)
            else:
                for c in combinations(sorted(group), size):
                    out.add(xxhash.xxh3_64_intdigest(np.array(c, np.uint64).tobytes()))
    return out


def _linked(common, a, b, percent: int):
    return 100 * common >= percent * (a + b - common)


def verify_block(sizes: np.ndarray, sets: list[np.ndarray], percent: int, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Links between the sets at ``first`` and those at ``second`` (all at once), as a spanning forest."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    token, column = np.unique(flat, return_inverse=True)
    shared = np.bincount(column, minlength=len(token)) > 1
    keep = shared[column]
    rename = np.cumsum(shared) - 1
    owner, column = owner[keep], rename[column[keep]]
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    row_a, row_b = np.full(len(sets), -1), np.full(len(sets), -1)
    row_a[first], row_b[second] = np.arange(len(first)), np.arange(len(second))
    common = np.zeros((len(first), len(second)), np.float64)
    width = 4096
    for start in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, (start, start + width))
        o, c = owner[lo:hi], column[lo:hi] - start
        a, b = np.zeros((len(first), width), np.float32), np.zeros((len(second), width), np.float32)
        in_a, in_b = row_a[o] >= 0, row_b[o] >= 0
        a[row_a[o[in_a]], c[in_a]] = 1
        b[row_b[o[in_b]], c[in_b]] = 1
        common += a @ b.T
    found = _linked(common, sizes[first][:, None], sizes[second][None, :], percent)
    forest = []
    for i, j in zip(*np.nonzero(found)):
        x, y = root(int(first[i])), root(int(second[j]))
        if x != y:
            parent[x] = y
            forest.append((int(first[i]), int(second[j])))
    return forest


def _long(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64, copy=False)))


def _set_scan(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """All columns of ``docs`` but the last, its text, and ``n, digest, first``: size, digest and first tokens of every document's set."""
    known = docs.schema.fields[:-1]
    schema = T.StructType([*known, T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("first", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digests, first = [], [], []
            for text in b.column(len(known)).to_pylist():
                s = shingles(text, shingle)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                first.append(_long(s[: allowed(len(s), percent) + margin(len(s), percent)]))
            columns = [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), _lists(first)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(known))), *columns], names=schema.names)

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``rep, n, tokens`` of the classes in ``wanted`` (``rep, h1, h2``)."""
    schema = T.StructType([T.StructField("rep", T.LongType()), T.StructField("n", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [_long(shingles(text, shingle)) for text in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), _lists(sets)], names=schema.names)

    # Only texts whose hashes are wanted (and a few by chance) leave their task; equal ones are combined there.
    n_wanted = wanted.count()
    texts = docs.select("h1", "h2", "text")
    if filter_bytes(n_wanted) <= DEFAULT_MAX_BYTES:
        blocks = stored(key_filter(wanted, ["h1", "h2"], n_wanted), "ngram-filter")
        may = fresh_name(texts.columns, "may")
        texts = with_may_contain(texts, ["h1", "h2"], blocks, n_wanted, may).where(may).drop(may)
    texts = texts.groupBy("h1", "h2").agg(F.first("text").alias("text"))
    return texts.join(wanted, ["h1", "h2"]).select("rep", "text").mapInArrow(run, schema)


def _index(first: DataFrame, percent: int, whole: bool = False) -> DataFrame:
    """``rep, unshared, entries`` from ``rep, n, token``: index entries of each set that may have a partner. ``whole``: by all tokens, not the first alone."""
    shared = first.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = first.join(shared, "token").groupBy("rep").agg(F.first("n").alias("n"), F.collect_list(F.struct("df", "token")).alias("shared"))
    schema = T.StructType([T.StructField("rep", T.LongType()), T.StructField("unshared", T.LongType()), T.StructField("entries", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: tuple[list, list, list] = ([], [], [])
            lists = b.column(2)
            bounds = lists.offsets.to_numpy()
            df, tok = (lists.values.field(i).to_numpy() for i in range(2))
            for i, (rep, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                lo, hi = bounds[i], bounds[i + 1]
                found = signatures(n, df[lo:hi], tok[lo:hi].view(np.uint64), percent, whole)
                if found:
                    rows[0].append(rep)
                    rows[1].append(allowed(n, percent) + margin(n, percent) - (hi - lo))
                    rows[2].append(_long(np.array(sorted(found), np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), _lists(rows[2])], names=schema.names)

    return held.mapInArrow(run, schema)


def _entry_links(entry: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each distinct entry comes first (by set), and links that connect the sets of every entry."""
    order = np.lexsort((rep, entry))
    e, r = entry[order], rep[order]
    same = e[1:] == e[:-1]
    a, b = spanning_forest(r[1:][same], r[:-1][same])
    return order[np.concatenate([[True], ~same])] if len(e) else order, a, b


def _clusters(index: DataFrame) -> DataFrame:
    """``rep, cluster`` of all sets that share an index entry with another, or are connected by such."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("entry", "a", "b")])

    def rows(entry: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = np.ones(len(first), bool)
        columns = [
            pa.array(np.concatenate([entry, np.zeros(len(a), np.int64)]), mask=np.concatenate([~none, np.ones(len(a), bool)])),
            pa.array(np.concatenate([first, a])),
            pa.array(np.concatenate([np.zeros(len(first), np.int64), b]), mask=np.concatenate([none, np.zeros(len(b), bool)])),
        ]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def united(early: bool, of: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(1)
                offsets = lists.offsets.to_numpy()
                entry = lists.values.to_numpy()[offsets[0] : offsets[-1]]
                rep = np.repeat(batch.column(0).to_numpy(), np.diff(offsets))
                now = (entry % of == 0) == early
                entry, rep = entry[now], rep[now]
                at, a, b = _entry_links(entry, rep)
                # An entry goes on with the first set of its component: what one batch unites is one set from here.
                first = rep[at]
                place = np.minimum(np.searchsorted(a, first), max(len(a) - 1, 0))
                if len(a):
                    first = np.where(a[place] == first, b[place], first)
                yield rows(entry[at], first, a, b)

        return run

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_entry = last_rep = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                # Sorted by entry: the entry that a batch ends with may go on in the next.
                entry = np.concatenate([last_entry, batch.column(0).to_numpy()])
                rep = np.concatenate([last_rep, batch.column(1).to_numpy()])
                _, a, b = _entry_links(entry, rep)
                last_entry, last_rep = entry[-1:], rep[-1:]
                yield rows(np.zeros(0, np.int64), np.zeros(0, np.int64), a, b)

    def components(sets: DataFrame, early: bool, known: DataFrame | None = None) -> DataFrame:
        own, own_path = stored_at(sets.mapInArrow(united(early, EARLY), schema), "ngram-entries")
        met = own.where("b IS NULL").select("entry", F.col("a").alias("rep")).repartition("entry").sortWithinPartitions("entry", "rep").mapInArrow(across, schema)
        links = own.where("b IS NOT NULL").select("a", "b").unionByName(met.select("a", "b"))
        found = connected_components(links if known is None else links.unionByName(known.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        delete_path(index.sparkSession, own_path)
        return found

    sets = index.select("rep", "entries")
    early = components(sets, True)
    named = sets.join(early.withColumnRenamed("node", "rep"), "rep", "left").select(F.coalesce("root", "rep").alias("rep"), "entries")
    return components(named, False, early).select(F.col("node").alias("rep"), F.col("root").alias("cluster"))


def _hub_links(members: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """``members`` with ``linked``: whether the set links with its cluster's hub."""
    schema = T.StructType([*members.schema.fields, T.StructField("hub", T.LongType()), T.StructField("linked", T.BooleanType())])
    names = members.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, hub = b.column(names.index("tokens")), b.column(len(names) + 1)
            linked = []
            for i in range(b.num_rows):
                x, y = own[i].values.to_numpy(), hub[i].values.to_numpy()
                linked.append(bool(_linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names) + 1)), pa.array(linked)], names=schema.names)

    return members.join(hubs, "cluster").select(*names, "hub", "hub_tokens").mapInArrow(run, schema)


def _parted(members: DataFrame, percent: int) -> DataFrame:
    """``members`` with the sets of all but the smallest clusters dealt anew to clusters by their whole sets; those without a candidate are gone."""
    large = stored(members.groupBy("cluster").count().where(F.col("count") > FEW_SETS).select("cluster"), "ngram-large")
    if not large.head(1):
        return members
    theirs = members.join(large, "cluster", "left_semi")
    index, index_path = stored_at(_index(theirs.select("rep", "n", F.explode("tokens").alias("token")), percent, whole=True), "ngram-whole-index")
    clusters = _clusters(index)
    delete_path(members.sparkSession, index_path)
    again = theirs.drop("cluster").join(clusters, "rep").select(*members.columns)
    return stored(members.join(large, "cluster", "left_anti").unionByName(again), "ngram-parted")


def _verified_links(sets: DataFrame, index: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that connect whatever is linked within the clusters."""
    found, found_path = stored_at(sets.join(clusters, "rep").join(index.select("rep", "unshared"), "rep").select("cluster", "rep", "unshared", "n", "tokens"), "ngram-members")
    members = _parted(found, percent)
    if members is not found:
        delete_path(sets.sparkSession, found_path)
    hubs = members.groupBy("cluster").agg(F.min(F.struct("unshared", "rep"))["rep"].alias("hub"))
    hubs = hubs.join(members.select(F.col("rep").alias("hub"), F.col("tokens").alias("hub_tokens")), "hub")
    tried = stored(_hub_links(members, hubs, percent).drop("unshared"), "ngram-hubs")
    star = tried.where("linked AND rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))

    def blocks(of: Column) -> Column:
        return F.greatest(F.ceil(F.count_if(of) / BLOCK_SETS), F.ceil(F.sum(F.when(of, F.col("n")).otherwise(0)) / BLOCK_TOKENS))

    counts = tried.groupBy("cluster").agg(blocks(~F.col("linked")).alias("loose"), blocks(F.col("linked")).alias("tied")).where("loose > 0")
    spread = F.xxhash64("rep")
    block = F.when(F.col("linked"), F.col("loose") + F.pmod(spread, F.greatest("tied", F.lit(1)))).otherwise(F.pmod(spread, F.col("loose")))
    partners = F.sequence(F.lit(0).cast("long"), F.when(F.col("linked"), F.col("loose")).otherwise(F.col("loose") + F.col("tied")) - 1)
    dealt = tried.join(counts, "cluster").withColumn("block", block).withColumn("partner", F.explode(partners))
    dealt = dealt.select("cluster", F.least("block", "partner").alias("one"), F.greatest("block", "partner").alias("two"), "block", "rep", "n", "tokens")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", ignore_index=True)
        sets = [np.asarray(t, np.int64) for t in pdf["tokens"]]
        of, one, two = pdf["block"].to_numpy(), pdf["one"].iloc[0], pdf["two"].iloc[0]
        links = verify_block(pdf["n"].to_numpy(), sets, percent, np.nonzero(of == one)[0], np.nonzero(of == two)[0])
        rep = pdf["rep"].to_numpy()
        return pd.DataFrame({"a": [int(rep[i]) for i, _ in links], "b": [int(rep[j]) for _, j in links]}, dtype="int64")

    # Dealt anew: rows that still lie by cluster would leave all blocks of a large one to one task.
    dealt = dealt.repartition("cluster", "one", "two")
    return star.unionByName(dealt.groupBy("cluster", "one", "two").applyInPandas(verify, "a long, b long"))


def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``. With ``row_col``, a column that tells rows apart, also
    that and ``kept``: true for one row of a component, that with the smallest id (rows without id last, of equal ids the first row)."""
    with scratch(docs.sparkSession):
        return kept(_components(docs, shingle, percent, id_col, text_col, row_col), "ngram-result")


def _components(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.col(row_col).alias("own")] if row_col else []
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), F.monotonically_increasing_id().alias("row"), *own, text.alias("text"))
    full, full_path = stored_at(_set_scan(docs, shingle, percent), "ngram-first")
    scan = stored(full.drop("first"), "ngram-scan")

    # Classes of equal sets.
    classes = scan.where("n > 0").groupBy("digest").agg(F.min("row").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("least_doc"), F.first(F.struct("h1", "h2")).alias("any"))
    classes = stored(classes.select("digest", "rep", "least_doc", "any.*"), "ngram-classes")

    first = full.where("n > 0").groupBy("digest").agg(F.min("row").alias("rep"), F.first("n").alias("n"), F.first("first").alias("first"))
    index = stored(_index(first.select("rep", "n", F.explode("first").alias("token")), percent), "ngram-index")
    delete_path(docs.sparkSession, full_path)
    clusters = stored(_clusters(index), "ngram-clusters")

    sets = _sets(docs, classes.join(clusters, "rep").select("rep", "h1", "h2"), shingle)
    links = _verified_links(sets, index, clusters, percent)
    roots = stored(connected_components(links), "ngram-roots")
    of_class = classes.join(roots, classes["rep"] == roots["node"]).select("digest", "root", "least_doc")
    smallest = of_class.groupBy("root").agg(F.min("least_doc").alias("keep"))
    of_class = of_class.join(smallest, "root").select("digest", "keep")
    alone = classes.join(roots, classes["rep"] == roots["node"], "left_anti").select("digest", F.col("least_doc").alias("keep"))
    named = stored(of_class.unionByName(alone), "ngram-components")
    own = [F.col("own").alias(row_col)] if row_col else []
    result = scan.where("n > 0").join(named, "digest")
    result = result.select("doc_id", F.col("n").alias("n_shingles"), F.col("keep.doc_id").alias("component_id"), *own, *([(F.col("row") == F.col("keep.row")).alias("kept")] if own else []))
    return result.unionByName(scan.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *own, *([F.lit(True).alias("kept")] if own else [])))
