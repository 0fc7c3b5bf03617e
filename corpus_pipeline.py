"""Corpus pipeline: five operators of ``leasegrid.llm``, each stage written as Parquet and read again.

Quality classifier, SimHash near-dedup, benchmark decontamination, mixing of
sources, token files. All but the last stage return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leasegrid.llm import bitplane_store, ordinal_quality, simhash_tiles, temperature_mix, template_decon
from leasegrid.llm.queries import MIN_TAIL, tokenizer_path
from leasegrid.session import shared_path

#: No source is read more often than this; every document that is left is read at least once.
MAX_REPETITION = 1.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade reaches the limit; poor and toxic ones go."""
    ratings = ordinal_quality.graded(_table(spark, sf_dir, "labels"))
    return ordinal_quality.select_quality(docs, ratings, MIN_TAIL).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of the smallest id (rows without an id come last)."""
    return simhash_tiles.keep_one(docs, shingle=3, max_distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return template_decon.decontaminate(docs, template_decon.find_leaks(docs, _table(spark, sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are read again, up to the repetition limit; a row per reading."""
    return temperature_mix.mix_sources(docs, max_repetition=MAX_REPETITION, budget_ratio=None).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed corpus, read back: one row per reading of a document."""
    return bitplane_store.token_files(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("token output", tokens),
]
#: The classifier, fingerprints and token ids are beyond SQL; tests compare the run with a plain re-computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written to the shared folder and read as the next input."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
