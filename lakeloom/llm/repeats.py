"""Suffix-array dedup: removal of every byte that a repeated string of ``length`` bytes covers.

A string counts as repeated if it starts anywhere else too, in any document or
the same one; all its copies go. Strings never cross documents and are judged
on the input.

1. Each window of ``length`` bytes has an anchor, the ``gram``-byte string in
   it with the least hash (the leftmost of equal ones). Equal windows have
   equal anchors at equal places, and the windows of one anchor form a run.
   A run's context are the bytes its windows cover. Anchors that occur once
   are dropped: their windows repeat nowhere.
2. Contexts that occur twice as a whole are repeated as a whole. This settles
   the inside of copies, however many, by counts.
3. The other contexts of a repeated anchor are repeated in part or not at all.
   They meet the anchor's other contexts (each different one once) in shards:
   a shard's array of suffixes is sorted by induction, and the prefixes that
   neighbours have in common, in text order, tell which windows are repeated.
   A window is owned by one context, so no window meets itself. An anchor with
   more than ``hot`` different contexts is not sent to one shard: the windows
   of its contexts are counted by their own digests instead, which Spark
   combines before the shuffle. Either way is exact.
4. The repeated windows' bytes are cut out of the texts.

Contexts, and windows of hot anchors, are compared by 128 bits (anchor and
context digests); documents are joined by id and a digest of the text.

Nulls: a null text is empty; rows without id take part like any other.
Repeated rows are copies of each other. Texts shorter than ``length`` keep all
their bytes. Cutting may leave bytes that are no whole characters, so what is
kept is binary. An empty table gives an empty result. Very long texts are
scanned piece by piece. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import kept, scratch, stored
from lakeloom.llm.suffixes import common_prefixes, suffix_array

#: Bytes hashed together, and bytes of a suffix array (at least one anchor's contexts).
PIECE, SHARD = 4_000_000, 500_000
#: Different contexts that an anchor may have in a shard.
HOT = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Places within a piece; a piece has fewer than 2**24 bytes.
_PLACE_BITS = np.uint64(24)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` (a power of two) bytes, put together from halves."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    base, width = _BASE, 1
    while width < gram:
        h = h[:-width] * base + h[width:]
        base, width = base * base, 2 * width
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def _least_places(h: np.ndarray, window: int) -> np.ndarray:
    """The leftmost place of the least hash of every ``window`` hashes."""
    place = np.arange(len(h), dtype=np.uint64)
    # The upper bits of the hash decide, then the place: alike in every text.
    m = ((h >> _PLACE_BITS) << _PLACE_BITS) | place
    width = 1
    while 2 * width <= window:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < window:
        m = np.minimum(m[: len(m) - (window - width)], m[window - width :])
    return (m & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)


def contexts(data: bytes, length: int, gram: int, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first byte and end of the context of every run of windows, in order."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    array = np.frombuffer(data, np.uint8)
    for start in range(0, len(array) - length + 1, piece):
        part = array[start : start + piece + length - 1]
        h = _gram_hashes(part, gram)
        anchor = _least_places(h, length - gram + 1)
        runs = np.nonzero(np.diff(anchor, prepend=-1))[0]
        last = np.append(runs[1:], len(anchor)) - 1
        found.append((h[anchor[runs]], start + runs, start + last + length))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def repeated_windows(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each context, the byte ranges covered by windows that occur in two contexts, or twice."""
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    array = suffix_array(joined)
    lcp = common_prefixes(joined, array, length)
    # A separator is an ordinary byte here: only windows inside one context count, and these start
    # early enough in it; one that also lies across a separator would not be a window of the input.
    sizes = np.array([len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    owned = np.zeros(len(joined) + 1, np.int64)
    np.add.at(owned, first, 1)
    np.add.at(owned, first + np.maximum(sizes - length + 1, 0), -1)
    owned = np.cumsum(owned)[:-1] > 0
    # Groups of neighbours with a common prefix of the whole length: repeated if two windows are owned.
    same = lcp[array] >= length
    group = np.cumsum(~same)
    count = np.bincount(group, owned[array], int(group[-1]) + 1)
    repeated = np.zeros(len(joined), bool)
    repeated[array] = (count[group] > 1) & owned[array]
    out = []
    for a, n in zip(first, sizes):
        hit = np.nonzero(repeated[a : a + n])[0]
        if len(hit):
            cut = np.nonzero(np.diff(hit) > length)[0]
            out.append([(int(s), int(e) + length) for s, e in zip(hit[np.append(0, cut + 1)], hit[np.append(cut, len(hit) - 1)])])
        else:
            out.append([])
    return out


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


_LONGS = T.ArrayType(T.LongType())


def _scan(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, text_hash, anchors, digests, places``: the runs of every document (place: first byte * 2**20 + size of the context)."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), *(T.StructField(n, _LONGS) for n in ("anchors", "digests", "places"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(2).to_pylist():
                data = text.encode()
                h, first, end = contexts(data, length, gram)
                view = memoryview(data)
                digest = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(first.tolist(), end.tolist())), np.uint64, len(h))
                rows.append((_long(h), _long(digest), (first << 20) + (end - first)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(_lists([r[i] for r in rows]) for i in range(3))], names=schema.names)

    return docs.mapInArrow(run, schema)


def _pack(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, packed``: texts compressed for a shuffle."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([zip_.compress(t.encode()) for t in b.column(2).to_pylist()], pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _same_document(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def _bytes_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``doc_id, text_hash, contexts: array of (rid, anchor, times, place)``) as one row per context with its ``bytes``."""
    schema = T.StructType([*(T.StructField(n, T.LongType()) for n in ("rid", "anchor", "times", "place")), T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                data, rows = _unpack(b.column(0)[i].as_py()), b.column(1)[i].values
                columns = [rows.field(j) for j in range(4)]
                parts = [data[p >> 20 : (p >> 20) + (p & 0xFFFFF)] for p in columns[3].to_pylist()]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())], names=schema.names)

    packed = _pack(docs)
    # Rows that are alike in id and text give the same bytes; one of them will do.
    rows = packed.join(wanted, _same_document(packed, wanted)).groupBy(packed["doc_id"], packed["text_hash"]).agg(F.first("packed").alias("packed"), F.first("contexts").alias("contexts"))
    return rows.select("packed", "contexts").mapInArrow(run, schema)


_RANGES = T.StructType([T.StructField("rid", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _sharded(parts: DataFrame, length: int, shard: int) -> DataFrame:
    """Repeated ranges of contexts that occur once, by suffix arrays over whole anchors."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = [
            (rid, (place >> 20) + s, (place >> 20) + e)
            for (_, rid, times, place, _), ranges in zip(rows, repeated_windows([r[4] for r in rows], length))
            if times == 1
            for s, e in ranges
        ]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_RANGES.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for row in zip(*(b.column(n).to_pylist() for n in ("anchor", "rid", "times", "place", "bytes"))):
                if size >= shard and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield solve(rows)

    return parts.repartition("anchor").sortWithinPartitions("anchor", "rid", "place").mapInArrow(run, _RANGES)


def _counted(parts: DataFrame, length: int) -> DataFrame:
    """The same for contexts of hot anchors, by counts of every window's digest."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("window", T.LongType()), T.StructField("rid", T.LongType()), T.StructField("start", T.LongType()), T.StructField("times", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for anchor, rid, times, place, data in zip(*(b.column(n).to_pylist() for n in ("anchor", "rid", "times", "place", "bytes"))):
                for s in range(len(data) - length + 1):
                    window = np.uint64(xxhash.xxh3_64_intdigest(data[s : s + length])).astype(np.int64)
                    rows.append((anchor, int(window), rid, (place >> 20) + s, times))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=schema.names)

    windows = parts.select("anchor", "rid", "times", "place", "bytes").mapInArrow(run, schema)
    often = windows.groupBy("anchor", "window").agg(F.count("*").alias("c")).where("c > 1").select("anchor", "window")
    return windows.where("times = 1").join(often, ["anchor", "window"]).select("rid", "start", (F.col("start") + length).alias("end"))


def repeated_ranges(docs: DataFrame, length: int = 200, gram: int = 32, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``doc_id, text_hash, ranges``: for each document with repeated strings, its byte ranges to be cut (they may overlap)."""
    scan = stored(_scan(docs, length, gram).withColumn("rid", F.monotonically_increasing_id()), "repeats-scan")
    runs = F.explode(F.arrays_zip("anchors", "digests", "places")).alias("run")
    anchors = scan.select(F.explode("anchors").alias("anchor"))
    # Stored, so that both sides of the join are shuffled for it and Spark can split a hot anchor.
    often = stored(anchors.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "repeats-often")
    all_runs = scan.select("rid", runs).select("rid", F.col("run.anchors").alias("anchor"), F.col("run.digests").alias("digest"), F.col("run.places").alias("place"))
    found = stored(all_runs.join(often, "anchor"), "repeats-anchors")

    # Different contexts of each repeated anchor.
    kinds = found.groupBy("anchor", "digest").agg(F.count("*").alias("times"), F.min(F.struct("rid", "place")).alias("at"))
    kinds = stored(kinds.select("anchor", "digest", "times", "at.rid", "at.place"), "repeats-kinds")
    whole = kinds.where("times > 1").select("anchor", "digest")
    start = F.shiftright("place", 20)
    whole = found.join(whole, ["anchor", "digest"]).select("rid", start.alias("start"), (start + F.col("place").bitwiseAND(0xFFFFF)).alias("end"))

    # Contexts that occur once meet the others of their anchor.
    many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    open_ = kinds.join(many, "anchor").select("rid", F.struct("rid", "anchor", "times", "place").alias("context"))
    open_ = open_.groupBy("rid").agg(F.collect_list("context").alias("contexts"))
    wanted = scan.select("rid", "doc_id", "text_hash").join(open_, "rid").groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("contexts")).alias("contexts"))
    parts = stored(_bytes_of(docs, wanted), "repeats-parts")
    hot_anchors = stored(many.where(F.col("kinds") > hot).select("anchor"), "repeats-hot")
    partly = _sharded(parts.join(hot_anchors, "anchor", "left_anti"), length, shard)
    partly = partly.unionByName(_counted(parts.join(hot_anchors, "anchor"), length))

    ranges = whole.unionByName(partly).groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    named = scan.select("rid", "doc_id", "text_hash").join(ranges, "rid")
    return named.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


_KEPT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])
_KEPT_DIGEST = T.StructType([*_KEPT.fields[:4], T.StructField("kept_sha256", T.StringType())])


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 32, hot: int = HOT, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (or ``kept_sha256``) of every row of ``docs``."""
    if length < 2 * gram:
        raise ValueError("length must be at least twice gram")
    if length >= 1 << 18:
        raise ValueError("length must be less than 2**18: sizes of contexts are kept in 20 bits")
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    with scratch(docs.sparkSession):
        ranges = kept(repeated_ranges(docs, length, gram, hot, shard), "repeats-ranges")
    schema = _KEPT_DIGEST if digest else _KEPT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for packed, ranges in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                data = _unpack(packed)
                spans = merged([(r["start"], r["end"]) for r in ranges or ()])
                ends = [0, *(e for _, e in spans)]
                kept = b"".join(data[a:z] for a, z in zip(ends, [*(s for s, _ in spans), len(data)]))
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest() if digest else kept))
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=schema.names)

    packed = _pack(docs)
    return packed.join(ranges, _same_document(packed, ranges), "left").select(packed["doc_id"], "packed", "ranges").mapInArrow(run, schema)
