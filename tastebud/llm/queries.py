"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, decontam, jaccard, lm, mixing, oracle, pii, quality, ranked, rules, secrets, simhash, urls
from .common import held_out, table

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Host, path, verdict of the listed keys.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_lm_score(spark: SparkSession, sf_dir: str, pieces_path: str = PIECES) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.lattice_scores(docs, held_out(docs["doc_id"], 7, 2), lm.load_pieces(pieces_path))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = chat.formatted(rows).withColumn("turns", chat.read_back(F.col("formatted")))
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"])), "")
    return out.withColumn("learned", learned).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(F.col("fail_bits"), "base")).alias("base_failed"),
        rules.passes(F.col("fail_bits"), "v2").alias("kept"), "fail_bits")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judged(table(spark, sf_dir, "pages"), listed)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fitted(docs))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, table(spark, sf_dir, "labels"), held_out(docs["doc_id"], 3, 1))


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), width=4, radius=4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mix, op2_lm_score, op3_jaccard, op4_chat, op5_pii, op6_rules, op7_urls, op8_secrets, op9_decontam, op10_quality,
                                     op11_ranked, op12_centroids, op13_simhash)}

ORACLE_SQL: dict[str, str] = {
    "op3_jaccard": oracle.OP3, "op4_chat": oracle.OP4, "op6_rules": oracle.OP6, "op7_urls": oracle.url_rules(URL_RULES),
    "op11_ranked": oracle.OP11, "op12_centroids": oracle.centroid_rounds()}
