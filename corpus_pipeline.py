"""A training corpus from ``documents``: five stages, each an operator of
``lakeloom.llm`` applied to all that its predecessor kept.

Every stage but the last returns the columns of ``documents``. ``run`` writes
each stage as Parquet to the shared folder, reads it again for the next one,
and then deletes what the stage made and what it read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import bpe, mixing, ngram_join, stream_dedup, toxicity
from lakeloom.llm.common import collecting, located, stored_at, table
from lakeloom.plans.workspace import delete_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not predict to be toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", ~toxicity.held_out())
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest id."""
    return stream_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared five-word shingles (Jaccard 0.8 or more), the one with the smallest id."""
    rows, place = located(docs, "near-rows")
    others = ngram_join.jaccard_components(rows, shingle=5, percent=80, row_col=place).where("NOT kept").select(place)
    return rows.join(others, place, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents: copy c of a document has what is taken more than c times."""
    rows, place = located(docs, "mix-rows")
    return mixing.materialise(rows, mixing.mix(rows, row_col=place), place)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every remaining row."""
    import public_tokenizers

    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE", encode),
]

#: SQL cannot express the first and last stages; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        made: list[str] = []
        with collecting(made):
            result = stage(spark, docs, sf_dir)
        docs, path = stored_at(result, name.replace(" ", "-"))
        for p in [*made, *([last] if last else [])]:
            delete_path(spark, p)
        last = path
    return docs
