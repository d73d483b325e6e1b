"""One query for each operator over the test tables, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tierline.llm import chat, classifier, embeddings, merkle, mixing, packing, phrases, pii, quality, secrets, sharding, simhash, topk


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _tokenizer(name: str) -> str:
    """The place of a tokenizer's file, found by the package that brings it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    placed = packing.pack(_table(spark, sf, "documents"), _tokenizer("word_bpe_49k.json"))
    return placed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op2_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(*chat.formatted_parts(turns, _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op3_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf, "embeddings"))


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = pii.scan(docs, pii.train(docs))

    def count(kind: str):
        listed = F.split(F.col("base"), ",")
        return F.size(F.filter(listed, lambda s: s.startswith(f"{kind}:"))).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(kind) for kind in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def op6_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf, "documents"))
    base = secrets.KINDS[:3]
    return found.select(
        "doc_id",
        *[secrets.count(F.col("spans"), kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secrets.digest(F.col("spans"), base), 256).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judged(_table(spark, sf, "documents"))


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    held_out = classifier.remainder(F.col("doc_id")) == 2
    model = classifier.train(docs, _table(spark, sf, "labels").filter(~held_out))
    return classifier.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted")
    )


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    rows = sharding.assigned(_table(spark, sf, "documents"), shards=40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    fields = [F.col(f) for f in merkle.FIELDS]
    lowered = [F.translate("text", UPPER, UPPER.lower()) if f == "text" else F.col(f) for f in merkle.FIELDS]
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    leaves = _table(spark, sf, "documents").select(
        "doc_id", "source", merkle.leaf(fields).alias("leaf"), F.when(tampers, merkle.leaf(lowered)).alias("tampered")
    )
    found = merkle.manifest(leaves, carry=("tampered",))
    used = F.coalesce("tampered", "leaf")
    folded = found.withColumn("folded_root", merkle.folded(used, F.col("left"), F.col("right")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.proof(F.col("left"), F.col("right")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_secret_scans": op6_secret_scans,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash": op8_simhash,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_sharding": op10_sharding,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op3_embedding_near_dedup": embeddings.ORACLE,
    "op4_mixing": mixing.ORACLE,
    "op7_quality_rules": quality.oracle(),
    "op11_merkle_manifest": merkle.oracle(f"translate(text, '{UPPER}', '{UPPER.lower()}')", 5),
    "op12_exact_top_k": topk.oracle("vec_id % 50 = 0"),
    "op13_collocations": phrases.oracle(),
}
