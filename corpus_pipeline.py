"""The corpus pipeline: language ID, line dedup, near-dedup, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import langid, line_dedup, packing, secrets, simhash
from loomspark.llm.common import materialise, remainder, table

#: SQL has no word-first language model, XXH64 or tokenizer: tests/llm holds the stages against brute force instead.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undetermined (null texts and texts without a letter) go; the others stay as they are."""
    model = langid.learn(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return langid.filter_known(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share are cut out of every text; all documents stay, with n_chars as it is then."""
    found = line_dedup.drop_common_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with a similarity of 0.8 (shingles of five words) the one with the smallest id stays.

    Rows without an id are compared like any others and come last in the choice; rows that share an id are told apart by
    their texts.
    """
    return simhash.keep_one(docs, 0.8, 5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; all documents stay, with n_chars as it is then."""
    import public_tokenizers as tok

    masked = secrets.redact(docs, secrets.ready(tok.path("byte_bpe_50k.tiktoken")))
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars"))).select(*(f"`{c}`" for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 2048 tokens."""
    import public_tokenizers as tok

    return packing.pack(docs, tok.path("byte_bpe_50k.json"), rank_path=tok.path("byte_bpe_50k.tiktoken"), pattern=tok.PATTERN)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
