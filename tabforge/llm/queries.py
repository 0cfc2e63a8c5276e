"""Registered queries of the corpus operators: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabforge.llm import licences
from tabforge.session import table


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.near_dups import near_dups
    return near_dups(table(spark, sf_dir, "documents"), words=2)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tabforge.llm.bpe import roundtrip
    return roundtrip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.licences import scan_licences
    return scan_licences(table(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.nearest import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.personal_data import find_personal_data
    return find_personal_data(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tabforge.llm.token_files import token_roundtrip
    return token_roundtrip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.decontaminate import contamination
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.language import fold_of
    from tabforge.llm.quality import score, train, word_vectors
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    vec = word_vectors(docs)
    net = train(docs, labels.where(fold_of(5) != 0), vec)
    found = score(docs, vec, net)
    return found.select("doc_id", (fold_of(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.language import fold_of, identify, train
    docs = table(spark, sf_dir, "documents")
    langs, logp = train(docs.where(fold_of(4) != 2))
    found = identify(docs, langs, logp)
    return found.select("doc_id", (fold_of(4) == 2).alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.warc import archive_roundtrip
    return archive_roundtrip(table(spark, sf_dir, "pages")).drop("url")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.hard_negatives import hard_negatives
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public
    from tabforge.llm.fertility import quality_rules
    found = quality_rules(table(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"),
                          public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm.prefix_trie import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("key")


QUERIES = {f.__name__: f for f in (
    op1_near_dups, op2_byte_bpe, op3_licences, op4_nearest, op5_personal_data, op6_token_files, op7_decontaminate,
    op8_quality, op9_language, op10_warc, op11_hard_negatives, op12_fertility, op13_prefix_trie)}
ORACLES: dict[str, str] = {"op3_licences": licences.oracle()}
