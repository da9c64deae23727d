"""The corpus pipeline: toxic documents go, near-copies go, benchmark passages go, secrets are masked, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from biblioweave.llm import decontam, minhash, packing, queries, secrets, toxicity
from biblioweave.llm.common import table
from biblioweave.operators.durable import durable


_READ = ("doc_id", "text", "n_chars")


def passing(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with all columns it does not read under numbered names, so that none meets its working columns."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, *rest, **settings) -> DataFrame:
        names = [c if c.lower() in _READ else f"_passed_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), *rest, **settings).toDF(*docs.columns)

    return run


@passing
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = queries.toxicity_field(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, field).where("score < 0.5").select(*docs.columns)


@passing
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row of each class stays. Ids of the rows that go are broadcast only up to ``broadcast_rows``."""
    found = durable(minhash.near_duplicates(docs), "near-copies")
    copy = F.xxhash64(F.coalesce("text", F.lit("")))
    gone = found.where("NOT is_first").select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).distinct()
    if gone.count() <= broadcast_rows:
        gone = F.broadcast(gone)
    kept = docs.withColumn("_own", copy)
    kept = kept.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_copy")), "left_anti")
    if found.where("is_first").groupBy("doc_id", "copy").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id", "_own"])
    return kept.select(*docs.columns)


@passing
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.with_flag(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*docs.columns)


@passing
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span becomes ``[SECRET]``; a text without one stays as it is, a null text null."""
    model = secrets.train(secrets.labelled_strings(docs.select(F.coalesce("text", F.lit("")).alias("text"))))
    spans = secrets.with_spans(docs, model)
    masked = spans.withColumn("text", secrets.redact(F.col("text"), F.col("_spans")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return masked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs, f"pipeline-{name}")
    return docs
