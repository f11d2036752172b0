"""A corpus in five stages: toxic documents go, exact and near copies go, repeated passages
are cut out, and what is left is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
in the shared folder and reads it back as the next stage's docs. All but the last return the
columns of ``docs``, also extra ones, whatever their names.

* NULL text counts as empty in every stage, and stays NULL until it is packed.
* NULL ids: a row with a NULL id is the last choice of a group of copies.
* Rows that repeat id and text become one row in the second stage.
* A text that repeats an earlier document whole is empty after the fourth stage, and stays.
* Very long texts are worked on whole; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwell.llm import exact_dedup, minhash, packing, repeats, toxicity
from tickwell.llm.common import staged, table
from tickwell.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.3. The model learns from labelled rows of docs."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.held_out())
    return toxicity.clean(docs, model, 0.3)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share three quarters of their five-word shingles, linked over any number
    of steps, the row with the smallest id."""
    return minhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes or more that a document with a smaller id holds."""
    return repeats.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(docs, VOCABULARY)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("minhash_near_dedup", drop_near_copies),
          ("suffix_dedup", cut_repeats), ("best_fit_packing", pack)]

#: A trained model and components over several steps are beyond SQL; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
