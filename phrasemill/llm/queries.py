"""The registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, divergence, flac, packing, periodic, pieces, quality, secrets, simhash, token_counts, token_files, urls
from .common import stored, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory, files = token_files.write_token_files(table(spark, sf_dir, "documents"))
    return token_files.read_token_files(spark, directory, files)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("_k")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digest(chat.format_chats(turns))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents")).drop("chunks")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urls.train(urls.training_table(spark))
    return urls.judge(table(spark, sf_dir, "pages"), weights).drop("score")


def op10_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams are stored as a column in the shared folder and read back from there."""
    media = stored(flac.to_media(table(spark, sf_dir, "documents")), "flac")
    return flac.digest(media)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(periodic.planted(table(spark, sf_dir, "documents"))))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(table(spark, sf_dir, "documents"), decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_pack, op3_token_files, op4_simhash, op5_quality, op6_chat, op7_secrets, op8_token_counts, op9_urls, op10_flac,
        op11_source_divergence, op12_periodic_runs, op13_sentencepiece,
    )
}

ORACLE_SQL: dict[str, str] = {"op1_decontaminate": decontaminate.ORACLE, "op6_chat": chat.ORACLE, "op11_source_divergence": divergence.ORACLE}
