"""A training-data pipeline over ``documents``: five of the operators in a row.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage
before it kept, and returns a DataFrame; ``run`` writes it as Parquet to the
cluster-shared folder and reads it back for the next stage, so a lost
executor never reaches back further than one stage. All stages but the last
return the columns of ``documents``; the last returns the packed pieces.

Whatever else the table holds is carried along: further columns keep their
names and values, also where an operator uses a name like theirs inside.
Empty tables give empty results in every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from revmart.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from revmart.llm.common import apply_llm_confs, fold, materialise, table
from revmart.llm.tokens import public_path
from revmart.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(fn: Stage) -> Stage:
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_llm_confs(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (score 0.7 or more).

    A null text and one without words score 0 and stay; without both labels everything stays; of repeated
    rows each is scored.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) == 1)


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    A null text equals the empty one; a null doc_id is the smallest; of rows that repeat both, one stays.
    """
    path = scratch_path(spark, "digest-index")
    return exact_dedup.keep_first(docs, exact_dedup.DigestIndex(spark, path, "digest_index_" + path[-12:]), batches=3)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together by a Jaccard of 0.8 of word 5-grams the smallest doc_id stays.

    Texts without words and rows without a doc_id hang together with nothing and stay.
    """
    return ngram_join.keep_representatives(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions 5, 2, 1, repeating; a document comes up to three times, two a shard in part.

    Texts without words take no part; a null source is the last one; ties go by the seeded order.
    """
    return mixing.mixed_texts(docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens.

    A null or empty text gives its end id alone; longer documents are cut; repeated rows are packed each.
    """
    return packing.pack_documents(docs, public_path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A trained classifier and a tokenizer have no SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
