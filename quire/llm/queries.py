"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, classifier, cws, html, mixing, pieces, rules, sharding, simhash, urls
from .common import read


def op1_cws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.compared(read(spark, sf_dir, "documents"))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(read(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(read(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.amounts(mixing.mix(read(spark, sf_dir, "documents")))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: A conversation whose texts are control strings, beside those of the table.
TRICKY = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(rows.unionByName(spark.createDataFrame(TRICKY, "conv_id bigint, turn bigint, role string, text string")))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))[0]



def op9_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: A public SentencePiece model; its path is a parameter of the operator.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.sampled(read(spark, sf_dir, "documents"), MODEL)


QUERIES = {f.__name__: f for f in (op1_cws, op2_urls, op3_simhash, op4_html, op5_mixing, op6_rules, op7_chat, op8_sharding, op9_classifier, op10_pieces)}
