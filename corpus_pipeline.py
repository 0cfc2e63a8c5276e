"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again as
the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    from tabforge.llm.language import drop_unknown, train
    return drop_unknown(docs, *train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, similarity 0.8)."""
    from tabforge.llm.near_dups import drop_copies
    return drop_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    from tabforge.llm.decontaminate import drop_contaminated
    from tabforge.session import table
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is masked."""
    from tabforge.llm.personal_data import mask_personal_data
    return mask_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text that is left, encoded and decoded."""
    import public_tokenizers
    from tabforge.llm.bpe import roundtrip
    return roundtrip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
    ("personal_data", personal_data), ("tokens", tokens)]

#: Language mixtures and message passing have no SQL form; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm._store import stored
    from tabforge.session import table
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
