"""The operators' registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revmart.llm import bpe, embedding_dedup, exact_dedup, hmm_lm, language_id, mixing, ngram_join, packing, periodic_runs, pu_quality, spelling, token_files, toxicity
from revmart.llm.common import LOWER, UPPER, apply_llm_confs, fold, table
from revmart.llm.tokens import public_path
from revmart.session import scratch_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of remainder 1 are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity(docs, labels, fold("doc_id", 3) == 1)


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of remainder 0 are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return pu_quality.quality(docs, labels, fold("doc_id", 5) == 0)


def op3_hmm_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of remainder 2 are held out."""
    docs = table(spark, sf_dir, "documents")
    return hmm_lm.hmm_scores(docs, fold("doc_id", 7) == 2)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: the second and third meet an index that holds texts."""
    path = scratch_path(spark, "digest-index")
    index = exact_dedup.DigestIndex(spark, path, "digest_index_" + path[-12:])
    return exact_dedup.dedup_batch(table(spark, sf_dir, "documents"), index, batches=3)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def near_copies_of_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op6 on the whole table and three altered copies of each vector: a case with links."""
    return embedding_dedup.near_vectors(embedding_dedup.with_near_copies(table(spark, sf_dir, "embeddings")))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of remainder 1 are held out; lang_pred is the best language, rejected marks a narrow margin."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, fold("doc_id", 3) == 1)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"),
                                   public_path("byte_bpe_50k.json"), end_id=2, vocab_size=50_257)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_path("word_bpe_49k.json"), end_id=1, capacity=4096)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(table(spark, sf_dir, "documents"))
    return spelling.spelling_variants(spelling.frequent_words(runs))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs))


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_llm_confs(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


QUERIES = {fn.__name__: _query(fn) for fn in (
    op1_toxicity,
    op2_pu_quality,
    op3_hmm_language_model,
    op4_exact_dedup,
    op5_mix_sources,
    op6_embedding_near_dedup,
    op7_ngram_jaccard_join,
    op8_language_id,
    op9_token_files,
    op10_best_fit_packing,
    op11_bpe,
    op12_spelling_variants,
    op13_periodic_runs,
    near_copies_of_embeddings,
)}

ORACLE = {
    "op4_exact_dedup": f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)""",
    "op5_mix_sources": mixing.MIX_SQL.format(docs="documents"),
    "op6_embedding_near_dedup": embedding_dedup.NEAR_SQL,
    "near_copies_of_embeddings": embedding_dedup.NEAR_COPIES_SQL,
    "op7_ngram_jaccard_join": ngram_join.JOIN_SQL,
    "op12_spelling_variants": spelling.VARIANTS_SQL.format(upper=UPPER, lower=LOWER),
}
