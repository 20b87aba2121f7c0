"""A Bloom filter over keys, as a DataFrame: which rows of a large table a batch can touch.

A key sets ``BITS`` bits of one 64-bit word, chosen by its hash; words lie in
blocks of ``BLOCK_WORDS``. Building is an aggregation (``bit_or``, combined
map-side), testing a join with the blocks on the block's number and a look at
one word. A key of the batch always passes; a few others pass by chance and
are told apart by the join that follows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 5
BLOCK_WORDS = 512
#: Filter bits for each key; with 5 bits set in one word about 0.5 % of other keys pass.
BITS_PER_KEY = 24


def words_for(n_keys: int) -> int:
    """Words of a filter for ``n_keys``, whole blocks."""
    words = max(1, -(-n_keys * BITS_PER_KEY // 64))
    return -(-words // BLOCK_WORDS) * BLOCK_WORDS


def filter_bytes(n_keys: int) -> int:
    return words_for(n_keys) * 8


def _hash(keys) -> Column:
    return F.xxhash64(F.lit(0x5EED), *[F.col(f"`{k}`") for k in keys])


def _place(h: Column, words: int) -> tuple[Column, Column]:
    """Block and word of a hash (its upper half)."""
    word = F.pmod(F.shiftrightunsigned(h, 32), F.lit(words).cast("long"))
    return (word - word % BLOCK_WORDS).alias("block"), (word % BLOCK_WORDS).cast("int")


def _mask(h: Column) -> Column:
    """``BITS`` bits of a word, from six bits of the lower half each."""
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(batch: DataFrame, keys, n_keys: int) -> DataFrame:
    """``block, words`` (an array of ``BLOCK_WORDS`` longs) for the keys of ``batch``, of which there are about ``n_keys``."""
    words = words_for(n_keys)
    h = batch.select(_hash(keys).alias("h"))
    block, word = _place(F.col("h"), words)
    masks = h.select(block.alias("block"), word.alias("word"), _mask(F.col("h")).alias("mask")).groupBy("block", "word").agg(F.bit_or("mask").alias("mask"))
    # At most BLOCK_WORDS entries a block.
    held = masks.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("held"))
    every = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1)), lambda w: F.coalesce(F.element_at("held", w), F.lit(0).cast("long")))
    return held.select("block", every.alias("words"))


def with_may_contain(df: DataFrame, keys, blocks: DataFrame, n_keys: int, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: false only if the row's key is in no batch row.
    ``blocks`` (``key_filter`` of the same ``n_keys``) are broadcast: the caller
    has checked ``filter_bytes``."""
    words = words_for(n_keys)
    block, word = _place(F.col("_bf_h"), words)
    hashed = df.withColumn("_bf_h", _hash(keys)).withColumn("_bf_block", block)
    found = hashed.join(F.broadcast(blocks.select(F.col("block").alias("_bf_block"), F.col("words").alias("_bf_words"))), "_bf_block", "left")
    mask = _mask(F.col("_bf_h"))
    passes = F.coalesce(F.get("_bf_words", word).bitwiseAND(mask) == mask, F.lit(False))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], passes.alias(name))
