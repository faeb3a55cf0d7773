"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Toxic documents go; repeated lines go; one document of each group of near copies (five-word shingles,
Jaccard 0.8 or more) stays; sources are mixed to their target weights, documents repeated or left out; what
remains is packed into sequences.  Each stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table, small_batches
from tessera.llm.lines import drop_repeated_lines
from tessera.llm.mixing import emit_copies
from tessera.llm.ngram_join import drop_near_copies
from tessera.llm.packing import pack_documents
from tessera.llm.toxicity import drop_toxic
from tessera.session import write_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field, fitted on the labels, does not predict toxic."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id has; a null text stays null."""
    out = drop_repeated_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    return out.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    with small_batches(spark):  # its jobs run in here, all but the last join
        return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return emit_copies(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard),
          ("mix_sources", mix_sources), ("best_fit_packing", best_fit_packing)]

#: SQL has no field of words, tokenizer or packing; tests/llm/test_pipeline.py compares with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with small_batches(spark):
            docs, _ = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
