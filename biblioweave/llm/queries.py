"""The registered queries of this subpackage: thin digests of what the operators return, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import audit, chat, codes, decontam, minhash, neighbours, oracles, packing, quality, secrets, suffix, syncmers, toxicity, urls
from .common import table, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op11_filter_audit": oracles.FILTER_AUDIT, "op13_box_codes": oracles.BOX_CODES}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def register(function):
    QUERIES[function.__name__] = function
    return function


def remainder(modulus: int):
    """crc32 of the id as text, which deals labelled rows to learning and holding out."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


@register
def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = syncmers.fingerprints(table(spark, sf_dir, "documents"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ahead = syncmers.with_next(prints, {"text": "_next_text", "sketch": "_next_sketch"}, buckets)
    changed = ahead.withColumn("_edited", syncmers.edited(F.col("text"), F.coalesce("_next_text", F.lit(""))))
    both = syncmers.with_anchors(changed, "_edited", "_anchors").withColumn("_edited_sketch", syncmers.sketch(F.col("_anchors")))
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint",
        syncmers.fingerprint(F.col("_edited_sketch")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("sketch"), F.col("_edited_sketch")).alias("near_edited"),
        syncmers.likeness(F.col("sketch"), F.col("_next_sketch")).alias("near_next"),
    )


@register
def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


def secret_spans(docs: DataFrame) -> DataFrame:
    """Both Markov models are trained on all strings of the corpus that the fixed rules label."""
    model = secrets.train(secrets.labelled_strings(texts(docs)))
    return secrets.scan(docs, model)


def _count_of(kind: str) -> Column:
    """``n_<kind>``: base spans of the kind. The lambda has one parameter, as Spark passes the place in the array as a second one."""
    number = secrets.KINDS.index(kind)
    return F.size(F.filter("base", lambda s: s.kind == number)).cast("long").alias(f"n_{kind}")


@register
def op3_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[_count_of(kind) for kind in secrets.KINDS[:3]], F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


@register
def op4_event_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digests(chat.render(chat.fold(chat.table_events(rows))))


@register
def op5_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def toxicity_field(docs: DataFrame, labels: DataFrame) -> toxicity.Field:
    return toxicity.train(docs, labels, remainder(5) != 0)


@register
def op6_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.with_score(texts(docs), toxicity_field(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_words",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start, s.end)), ",").alias("spans"),
    )


@register
def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "is_first")


@register
def op9_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.train(docs, table(spark, sf_dir, "labels"), remainder(4) != 2)
    scored = quality.score(docs, trees)
    return scored.select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@register
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


@register
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op12_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register
def op13_box_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest(codebooks)).alias("codebooks_sha256")
    )
