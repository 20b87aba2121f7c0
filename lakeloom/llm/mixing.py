r"""Mixing sources to target weights.

Words (``[^\x20\x09-\x0D]+``) of each source are packed, document after
document, into blocks of ``block_words``. Targets share the total size by
weight and are capped at ``max_repeat`` times their source's size, the excess
being reshared by weight. The mix is a row of slots, ``slots_per_shard`` to an
output shard. Each slot draws its source, which makes the counts of a shard
multinomial; as totals of such draws wander off their targets, draws beyond a
source's quota of blocks are handed to the sources that came short. The j-th
slot of a source takes the block at place j of an endless row of pseudorandom
permutations of the source's block indexes, so no block is used more than once
more than any other, nor more than ``max_repeat`` times. Slots and blocks are
joined by index.

Only DataFrame functions are used. A source may hold most rows: places within
a source are found by two-step sums (chunks of a source, then rows of a chunk;
shards, then slots of a shard), so no task sees more than one chunk or shard.
What is kept per source (one row each) passes through one task.

All draws are hashes of ``seed``, slot and round, so reruns agree.

Nulls: a null text has size 0; rows without source form a source that comes
last. Documents of size 0 are returned with nothing taken. Rows are told apart
by the place that ``common.located`` gave them; without it rows of equal id
are told apart by size and text, then are alike. Very long texts fill many blocks. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACE_CLASS, WORD_CLASS, fresh_name, stored

#: Documents in a chunk of a source, on average.
CHUNK_DOCS = 5000
#: Intervals are looked up by equal joins on so many buckets.
BUCKETS = 4096
#: Rounds of the index permutation.
ROUNDS = 12


@dataclass(frozen=True)
class Mix:
    #: source, sid, source_size, target, n_blocks, quota: one row per source.
    sources: DataFrame
    #: row, doc_id, sid, size, offset (first word's place in its source; null for size 0).
    documents: DataFrame
    #: shard, slot, sid, block, epoch: the mix.
    slots: DataFrame
    #: sid, block, row, doc_id, offset, size, first (word's place in the document), words.
    segments: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_CLASS}+")), F.lit(0)).cast("long")


def _hash(seed: int, *columns) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def targets(sizes: DataFrame, weights: list[float], max_repeat: int) -> DataFrame:
    """``sid, target`` added to ``source, source_size``: sources by code point,
    null last, get the weights in turn."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("sid", (F.row_number().over(everything) - 1).cast("long"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = s.withColumn("weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size").cast("double") * max_repeat)
    # In order of cap by weight, the capped sources come first: a source is
    # capped if the level that fills the total without it would exceed its cap.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum(F.col("source_size").cast("double")).over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    s = s.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    # The level of the first source below its cap holds for all that follow.
    s = s.withColumn("water", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))).over(everywhere)["level"])
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("water"))
    return s.select("source", "sid", "source_size", target.alias("target"))


def _permuted(index: Column, n: Column, key: Column) -> Column:
    """Place of ``index`` in a pseudorandom permutation of ``0 .. n-1``, by
    swap-or-not rounds: each pairs all places and swaps a random half of the pairs."""

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        return F.when(F.xxhash64(key, r, F.greatest(x, partner)).bitwiseAND(1) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, swap)


def _located(values: DataFrame, value: str, intervals: DataFrame, start: str, length: str, span: int) -> DataFrame:
    """Join each row of ``values`` to the interval ``[start, start + length)`` that holds its ``value``:
    an equal join on a bucket of the value, then a filter. ``span``: the end of all intervals."""
    width = max(1, -(-span // BUCKETS))
    end = F.col(start) + F.col(length)
    buckets = F.sequence(F.floor(F.col(start) / width), F.floor((end - 1) / width))
    parts = intervals.where(F.col(length) > 0).withColumn("_bucket", F.explode(buckets))
    values = values.withColumn("_bucket", F.floor(F.col(value) / width))
    return values.join(parts, "_bucket").where((F.col(value) >= F.col(start)) & (F.col(value) < end)).drop("_bucket")


def mix(
    docs: DataFrame,
    weights: list[float] = (5.0, 2.0, 1.0),
    max_repeat: int = 3,
    block_words: int = 128,
    slots_per_shard: int = 1024,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> Mix:
    """``row_col``: a column that tells the rows apart (``common.located``), where ids may not."""
    spark = docs.sparkSession
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("hash"), (F.col(row_col) if row_col else F.lit(None).cast("long")).alias("row")), "mix-sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), list(weights), max_repeat)
    sources = sources.withColumn("n_blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    wanted = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long")
    sources = sources.withColumn("quota", F.when(F.col("n_blocks") > 0, F.least(wanted, F.col("n_blocks") * max_repeat)).otherwise(0))
    running = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    sources = stored(sources.withColumn("first_draw", F.coalesce(F.sum("quota").over(running), F.lit(0))), "mix-sources")
    known = sources.select(F.col("source").alias("_source"), "sid")

    # Pack: the place of every document in its source, by chunks in hashed order.
    n_docs = sized.count()
    # Rows without id, or with one that many have, are dealt by their text and place.
    chunk = F.pmod(_hash(seed, "doc_id", "hash", "row"), F.lit(max(1, n_docs // CHUNK_DOCS)))
    placed = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).select("row", "doc_id", "size", "hash", "sid", chunk.alias("chunk"))
    full = placed.where(F.col("size") > 0)
    chunks = full.groupBy("sid", "chunk").agg(F.sum("size").alias("chunk_size"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("sid", "chunk", F.coalesce(F.sum("chunk_size").over(before), F.lit(0)).alias("chunk_start"))
    within = Window.partitionBy("sid", "chunk").orderBy("doc_id", "size", "hash", "row").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(chunks, ["sid", "chunk"])
    full = full.select("row", "doc_id", "sid", "size", (F.col("chunk_start") + F.col("inside")).alias("offset"))
    empty = placed.where(F.col("size") == 0).select("row", "doc_id", "sid", "size", F.lit(None).cast("long").alias("offset"))
    documents = stored(full.unionByName(empty), "mix-documents")

    end = F.col("offset") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("offset") / block_words), F.floor((end - 1) / block_words)))
    segments = documents.where("offset IS NOT NULL").withColumn("block", block)
    start = F.greatest(F.col("offset"), F.col("block") * block_words)
    segments = segments.select("sid", "block", "row", "doc_id", "offset", "size", (start - F.col("offset")).alias("first"), (F.least(end, (F.col("block") + 1) * block_words) - start).alias("words"))

    # Draw: each slot a source.
    n_slots = sources.agg(F.sum("quota")).head()[0] or 0
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), F.floor(F.col("id") / slots_per_shard).alias("shard"))
    slots = slots.withColumn("draw", F.pmod(_hash(seed, F.lit("source"), "slot"), F.lit(max(n_slots, 1))))
    drawn = _located(slots, "draw", sources.select("sid", "first_draw", "quota"), "first_draw", "quota", n_slots).select("shard", "slot", "sid")
    counts = drawn.groupBy("sid", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy("sid", "shard").orderBy("slot")
    drawn = drawn.withColumn("nth", F.row_number().over(inside) - 1).join(counts.select("sid", "shard", "earlier"), ["sid", "shard"])
    drawn = drawn.select("shard", "slot", "sid", (F.col("earlier") + F.col("nth")).alias("place"))

    # Hand draws beyond a quota to sources that came short.
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    balance = sources.select("sid", "quota").join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    balance = balance.withColumn("over", F.greatest(F.col("got") - F.col("quota"), F.lit(0))).withColumn("short", F.greatest(F.col("quota") - F.col("got"), F.lit(0)))
    balance = balance.withColumn("over_start", F.coalesce(F.sum("over").over(running), F.lit(0))).withColumn("short_start", F.coalesce(F.sum("short").over(running), F.lit(0)))
    balance = stored(balance, "mix-balance")
    drawn = drawn.join(balance.select("sid", "quota", "over_start"), "sid")
    right = drawn.where(F.col("place") < F.col("quota")).select("shard", "slot", "sid", "place")
    spare = drawn.where(F.col("place") >= F.col("quota")).select("shard", "slot", (F.col("over_start") + F.col("place") - F.col("quota")).alias("nth"))
    lacking = balance.select("sid", "got", "short", "short_start")
    handed = _located(spare, "nth", lacking, "short_start", "short", balance.agg(F.sum("short")).head()[0] or 0)
    handed = handed.select("shard", "slot", "sid", (F.col("got") + F.col("nth") - F.col("short_start")).alias("place"))

    # Map: the place among the source's slots through its permutation of block indexes.
    slots = right.unionByName(handed).join(sources.select("sid", "n_blocks"), "sid")
    epoch = F.floor(F.col("place") / F.col("n_blocks"))
    key = _hash(seed, F.lit("block"), "sid", "epoch")
    slots = slots.withColumn("epoch", epoch).withColumn("key", key)
    slots = slots.select("shard", "slot", "sid", _permuted(F.pmod("place", "n_blocks"), F.col("n_blocks"), F.col("key")).alias("block"), "epoch")
    return Mix(sources, documents, slots, segments)


def segment_uses(m: Mix) -> DataFrame:
    """The segments with ``uses``: how often the mix takes them."""
    uses = m.slots.groupBy("sid", "block").agg(F.count("*").alias("uses"))
    return m.segments.join(uses, ["sid", "block"], "left").withColumn("uses", F.coalesce("uses", F.lit(0)))


def taken(m: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    full = segment_uses(m).groupBy("sid", "offset", "doc_id", "size").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    empty = m.documents.where("offset IS NULL").select("sid", "offset", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return full.unionByName(empty).join(m.sources.select("sid", "source_size", "target"), "sid").select("doc_id", "size", "source_size", "target", "taken")


def materialise(docs: DataFrame, m: Mix, row_col: str | None = None) -> DataFrame:
    """The mix as rows like ``docs``, those that ``m`` was made of (with the same
    ``row_col``, which is dropped; without one, ids must be distinct): copy c of a
    document has, in order, the words of its segments that are taken more than
    c times; documents of which nothing is taken are gone. A whole copy keeps
    its text as it was."""
    part = F.struct("first", "words", "uses")
    key, own = (row_col, "row") if row_col else ("doc_id", "doc_id")
    if not row_col:
        n, ids = m.documents.agg(F.count("*"), F.count_distinct("doc_id")).head()
        if ids < n:
            raise ValueError("ids are null or repeated: locate the rows first")
    p_key, p_parts, p_most, p_copy, p_words = (fresh_name(docs.columns, n) for n in ("mix_key", "mix_parts", "mix_most", "mix_copy", "mix_words"))
    parts = segment_uses(m).where("uses > 0").groupBy(F.col(own).alias(p_key)).agg(F.array_sort(F.collect_list(part)).alias(p_parts), F.max("uses").alias(p_most))
    copies = docs.join(parts, F.col(key) == F.col(p_key)).withColumn(p_copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(p_most))))
    chosen = F.filter(p_parts, lambda p: p["uses"] >= F.col(p_copy))
    n_chosen = F.aggregate(chosen, F.lit(0).cast("long"), lambda n, p: n + p["words"])
    words = F.regexp_extract_all("text", F.lit(f"({SPACE_CLASS}*{WORD_CLASS}+{SPACE_CLASS}*)"), F.lit(1))
    cut = F.array_join(F.flatten(F.transform(chosen, lambda p: F.slice(F.col(p_words), (p["first"] + 1).cast("int"), p["words"].cast("int")))), "")
    copies = copies.withColumn(p_words, words)
    text = F.when(n_chosen == F.size(p_words), F.col("text")).otherwise(cut)
    mixed = copies.withColumn("text", text)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*[c for c in docs.columns if c != row_col])
