"""Token counts with a digest cache.

Every text is reduced to the digest of its normalised content. Digests are
joined, together with the digest of the tokenizer's version, to counts stored
by earlier runs; only distinct misses are encoded, and their counts are
appended to the cache. The final counts come from a join on the digest alone,
so copies of a text, however many, are encoded once.

Normalisation: null becomes the empty text; nothing else may be changed, as
the tokenizers count white space and case.

The cache is a Parquet folder ``tokenizer=<version digest>/`` of
``content binary, n_tokens long``. Spark's commit makes an append visible
whole or not at all, so a lost run leaves no partial counts behind and is
simply repeated. Writers at the same time, or a retried append, may store a
digest several times, always with the same count: reading takes it once.

Nulls: a null text counts as empty (0 bytes, 0 tokens); a null id stays null.
Repeated rows are counted each. Very long texts are encoded whole. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.plans.workspace import path_exists

CACHE = T.StructType([T.StructField("content", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
#: Units of text whose counts a worker remembers; it then starts afresh.
UNIT_MEMORY = 400_000
#: The sign that sentencepiece writes for a space.
MARK = "▁"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and its library's version."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"|{library.__name__} {library.__version__}".encode()).hexdigest()


class PieceCounter:
    """Counts tokens of a sentencepiece model.

    If no piece of a BPE model has a space mark after another character, no
    merge crosses the place before a space that follows a non-space. A text
    then falls into units there whose counts add up, and the counts of common
    units are remembered. Other models encode whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self._sp = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        self._splits = (
            spec.trainer_spec.model_type == pb.TrainerSpec.BPE
            and spec.trainer_spec.byte_fallback
            and not norm.precompiled_charsmap
            and norm.add_dummy_prefix
            and norm.escape_whitespaces
            and not norm.remove_extra_whitespaces
            and not any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED or MARK in p.piece.lstrip(MARK) for p in spec.pieces)
        )
        self._odd_units = re.compile(f"(?<=[^ {MARK}]) (?=[^ ])").split
        self._memory: dict[str, int] = {}

    def _encoded(self, units: list[str]) -> list[int]:
        return [len(x) for x in self._sp.encode(units, num_threads=1)]

    def count(self, text: str) -> int:
        if not self._splits:
            return self._encoded([text])[0]
        odd = "  " in text or MARK in text or text[:1] == " " or text[-1:] == " "
        units = self._odd_units(text) if odd else text.split(" ")
        memory = self._memory
        if len(memory) > UNIT_MEMORY:
            memory.clear()
        new = list({u for u in units if u not in memory})
        if new:
            memory.update(zip(new, self._encoded(new)))
        total = sum(map(memory.__getitem__, units))
        for u in new:
            if len(u) > 64:
                del memory[u]
        return total


class FileCounter:
    """Counts tokens of a tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tk = Tokenizer.from_file(path)
        self._tk.no_truncation()
        self._tk.no_padding()

    def count(self, text: str) -> int:
        return len(self._tk.encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=4)
def counter(path: str):
    return PieceCounter(path) if path.endswith(".model") else FileCounter(path)


def read_cache(spark, cache_path: str, version: str) -> DataFrame:
    """``content, n_tokens`` of every digest that is stored, once: two writers may both have appended it."""
    where = f"{cache_path}/tokenizer={version}"
    if path_exists(spark, where):
        return spark.read.schema(CACHE).parquet(where).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), CACHE)


def fill_cache(docs: DataFrame, cache_path: str, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """Encode the distinct texts that the cache lacks, append their counts, and return the cache."""
    spark, version = docs.sparkSession, tokenizer_version(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    distinct = docs.select(F.unhex(F.sha2(text, 256)).alias("content"), text.alias("text")).dropDuplicates(["content"])
    missing = distinct.join(read_cache(spark, cache_path, version), "content", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path).count
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([count(t) for t in b.column(1).to_pylist()], pa.int64())], names=CACHE.names)

    missing.select("content", "text").mapInArrow(encode, CACHE).write.mode("append").parquet(f"{cache_path}/tokenizer={version}")
    return read_cache(spark, cache_path, version)


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``."""
    cache = fill_cache(docs, cache_path, tokenizer_path, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("content"))
    return keyed.join(cache, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
