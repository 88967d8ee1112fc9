"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.maxent import score

    return score(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.decontaminate import decontaminate, digest

    return digest(decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.pseudonyms import pseudonymise

    # The key is the caller's secret; a fixed one makes this query repeatable.
    return pseudonymise(table(spark, sf_dir, "documents"), key=b"a fixed key for the registered query")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.suffix_dedup import digest, remove_repeats

    return digest(remove_repeats(table(spark, sf_dir, "documents")))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from ridgecast.llm.secrets import Ledger, digest, findings
    from ridgecast.llm.store import shared_dir

    docs = table(spark, sf_dir, "documents")
    # A ledger of this call's own: the result is that of a first run. A caller who scans again gives a path that stays.
    return digest(findings(docs, Ledger(spark, f"{shared_dir(spark)}/ridgecast/secrets-{uuid.uuid4().hex}").update(docs)))


def secret_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run over a ledger: of the documents with their secrets redacted, only changed texts are scanned.

    Per document: the rules that had yet to see its text before that run, and the spans that are left after it.
    """
    import uuid

    from ridgecast.llm.secrets import Ledger, findings, redact, unseen
    from ridgecast.llm.store import materialize, shared_dir

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = Ledger(spark, f"{shared_dir(spark)}/ridgecast/secrets-{uuid.uuid4().hex}")
    first = ledger.update(docs)
    second = materialize(redact(docs, first), "redacted")
    new = materialize(unseen(second, first), "unseen")
    left = findings(second, ledger.update(second)).select("doc_id", F.size("spans").cast("long").alias("n_spans"))
    return new.join(left, "doc_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.language import identify

    return identify(table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridgecast.llm.nearest import search

    return search(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (
    op1_best_fit_packing,
    op2_benchmark_decontamination,
    op3_feistel_pseudonyms,
    op4_suffix_array_dedup,
    op5_secret_scans,
    op6_maxent_scores,
    op7_quality_classifier,
    op8_ngram_jaccard_join,
    op9_language_id,
    op10_nearest_neighbours,
    pipeline,
)


def llm_queries() -> dict:
    return {f.__name__: f for f in (*QUERIES, secret_rescan)}


def llm_oracle_sql() -> dict[str, str]:
    from ridgecast.llm.oracles import ORACLES

    return dict(ORACLES)
