"""From documents to packed training sequences, in stages that are written as Parquet and read again.

Unless a contract of an operator says otherwise, the near-duplicate stage links documents by five-word shingles at a
similarity of 0.8.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.line_dedup import line_dedup
from tessera.llm.ngram_join import ngram_components
from tessera.llm.packing import pack, token_pieces
from tessera.llm.quality_rules import quality_rules
from tessera.llm.scratch import delete, owned, small_batches, stored
from tessera.llm.substring_dedup import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


_kept: list[str] = []


def _own_stage(stage):
    """A stage that first deletes what the stage before it kept in the shared folder, for its result is written by then."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete(spark, _kept)
        small_batches(spark)
        with owned(_kept):
            return stage(spark, docs, sf_dir)

    return run


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    A null or empty text has no words, so it goes. Null ids, languages and sources are values like others; equal texts of one
    language and source have one verdict, repeated rows each stay or go. An empty table gives none."""
    return quality_rules(docs).where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one.

    A null text becomes an empty one. A null id is the smallest, and rows of one id count as one document, so repeated rows get
    equal texts. No document goes; an empty table gives none."""
    return _documents(line_dedup(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, and of rows of one id and text, one document stays: that of the smallest id.

    A null id is the smallest. Of several texts of the smallest id, the first in the order of a hash stays. Texts of one
    id, or without one, that are no near copies of each other are different documents. Rows are told apart by numbers that
    are stored with them; hashes (128 bits beside the id) only tell whether rows of one id that have no words are equal. An
    empty table gives none."""
    no_id = F.lit(-(2**63))
    text = F.coalesce("text", F.lit(""))
    numbered = docs.select(*COLUMNS).withColumns({"_key": F.monotonically_increasing_id(), "_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(1), F.reverse(text))})
    rows = stored(numbered, "pipeline-numbered")
    found = ngram_components(rows.select("_key", "doc_id", "_h1", "_h2", "text"), id_col="_key", width=5, percent=80, name="pipeline-ngrams")
    alone = F.when(F.col("n_shingles") == 0, F.struct(F.coalesce("doc_id", no_id).alias("_id"), "_h1", "_h2"))
    group = F.struct(F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component"), alone.alias("alone"))
    first = F.min(F.struct(F.coalesce("doc_id", no_id).alias("_id"), "_h1", "_h2", "_key")).alias("_first")
    stay = stored(found.groupBy(group.alias("_group")).agg(first).select("_first._key"), "pipeline-stay")
    return rows.join(stay, "_key", "left_semi").select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more stay in the first document that has them.

    A null text becomes an empty one. Ties and repeated rows are treated as substring_dedup says. No document goes; an empty
    table gives none."""
    return _documents(substring_dedup(docs, name="pipeline-substrings"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences.

    A null or empty text is its end mark alone. Rows of one id, or without one, are packed each by itself. An empty table
    gives no pieces."""
    return pack(token_pieces(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    (name, _own_stage(stage))
    for name, stage in (("quality_rules", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_copies), ("substring_dedup", substrings), ("best_fit_packing", packing))
]

#: SQL can't express the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
