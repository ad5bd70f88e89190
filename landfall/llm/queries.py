"""The registered queries of these operators: thin selections over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import block_naming, divergence, fingerprint, langid, middle, mixing, ngram_join, packing, pii, quality_votes, repeats, toxicity, wavelet
from landfall.llm.common import documents, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op8_mix_sources", mixing.ORACLE)
def op8(spark, sf_dir):
    return mixing.mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""


@query("op9_exact_dedup", EXACT_SQL)
def op9(spark, sf_dir):
    return block_naming.exact_groups(documents(spark, sf_dir))


@query("op2_vector_packing")
def op2(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir))


@query("op5_wavelet_shards")
def op5(spark, sf_dir):
    return wavelet.round_trip(documents(spark, sf_dir))


@query("op1_rank_order_langid")
def op1(spark, sf_dir):
    docs = documents(spark, sf_dir)
    profiles = langid.train_profiles(docs.filter(~langid.held_out()))
    return langid.identify(docs, profiles).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query("op7_ngram_jaccard_join")
def op7(spark, sf_dir):
    return ngram_join.similar_classes(documents(spark, sf_dir))


@query("op3_one_permutation_minhash")
def op3(spark, sf_dir):
    return fingerprint.fingerprints(documents(spark, sf_dir))


@query("op10_kneser_ney_toxicity")
def op10(spark, sf_dir):
    return toxicity.toxicity_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op4_bootstrapped_pii")
def op4(spark, sf_dir):
    return pii.find_personal_data(documents(spark, sf_dir))


@query("op6_sparse_suffix_repeats")
def op6(spark, sf_dir):
    return repeats.repeated_passages(documents(spark, sf_dir))


@query("op13_fill_in_middle", middle.ORACLE)
def op13(spark, sf_dir):
    return middle.digests(documents(spark, sf_dir))


@query("op12_source_divergence", divergence.ORACLE)
def op12(spark, sf_dir):
    return divergence.audit_sources(documents(spark, sf_dir))


@query("op11_weak_supervision_quality")
def op11(spark, sf_dir):
    judged = quality_votes.judge_quality(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )
