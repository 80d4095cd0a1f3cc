"""Documents to token ids in five stages: language, boilerplate lines, near-copies, benchmark passages, pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanmart.llm import decontamination, language_id, line_dedup, sentence_pieces, simhash
from loanmart.llm.shared import documents, ready, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without letters go."""
    ready(spark)
    return language_id.keep_known(docs, "doc_id", "text", "lang")


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sites; ``n_chars`` follows the text.

    Equal texts count for one site: copies are what the next stage removes.
    """
    ready(spark)
    cleaned = line_dedup.remove_boilerplate(docs, "doc_id", "text", "source", copies_once=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    ready(spark)
    return simhash.one_of_each(docs, "doc_id", "text", shingle=4, max_bits=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    items = ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = written(decontamination.find(docs, "doc_id", "text", items, "item_id", "text").select("doc_id").distinct())
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["doc_id"]), "left_anti")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_crc32, n_chars, text_md5``: the ids, and digests of them and of what they decode to.

    The file is a BPE model whose piece scores are searched for the best sum, so the ids are not those of merging.
    """
    ready(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentence_pieces.encode(docs, "doc_id", "text", path).withColumnRenamed("doc_id", "id")
    return sentence_pieces.digest(coded, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_boilerplate),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("sentence_pieces", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before it wrote."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # language models and piece scores are beyond SQL; tests hold each stage against plain Python
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
