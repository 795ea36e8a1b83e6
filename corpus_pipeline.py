"""A training corpus from ``documents``: language ID, line dedup, near-dedup, mixing, packing.

Each stage takes the documents that the one before kept and is written as Parquet and read
again, so a stage starts from files of the shared folder whatever executors were lost. All but
the last return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickscope.llm import langid, line_dedup, mixing, packing, simhash
from clickscope.llm.common import stage, table

RAW_BITS = 8.0   # a text that no language explains better than raw bytes is rejected, if it is
RAW_BYTES = 256  # this long: in a short one the cost of a phrase, not the language, decides
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _on_documents(work):
    """A stage from ``work(docs)``: other columns than those of ``documents`` bear neutral
    names inside, so that none clashes with an operator's, and all come back as they were."""
    def stage_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in COLUMNS else f"_extra_{i}" for i, c in enumerate(docs.columns)]
        return work(docs.toDF(*names)).select(*names).toDF(*docs.columns)

    stage_of.__doc__ = work.__doc__
    return stage_of


@_on_documents
def identified(docs: DataFrame) -> DataFrame:
    """Documents with a letter that some learned language explains; a null ``lang`` is filled in.

    Rejected are texts without a letter (null and empty ones too) and, among those of at least
    ``RAW_BYTES`` bytes, those of ``RAW_BITS`` bits a byte or more in every language.
    """
    explained = (F.octet_length("text") < RAW_BYTES) | (F.col("bits_per_byte") < RAW_BITS)
    found = langid.identify(docs).where((F.col("lang_pred") != "und") & explained)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred"))


@_on_documents
def lines_deduplicated(docs: DataFrame) -> DataFrame:
    """Documents without the lines that occur earlier; ``n_chars`` follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("bigint"))


@_on_documents
def near_deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each SimHash component (4 words, 4 bits)."""
    return simhash.keep_one(docs, words=4, radius=4)


@_on_documents
def mixed(docs: DataFrame) -> DataFrame:
    """Whole copies of documents by source targets, in training order."""
    return mixing.mix(docs, keep=docs.columns, each_copy=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens: a row for each piece of a document."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [("language_id", identified), ("line_dedup", lines_deduplicated), ("simhash_near_dedup", near_deduplicated),
          ("mixing", mixed), ("packing", packed)]

ORACLE_SQL = None  # no SQL for tokenizers and fingerprints; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
