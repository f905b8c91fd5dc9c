"""The registered queries opN_<name>: each applies its operator to the whole of its table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_cnn, oracle, spotsigs
from .chat_template import CONTROLS, format_conversations, read_back
from .common import table
from .labelled import held_out
from .licences import scan
from .mixing import mix
from .packing import pack
from .quality_rules import quality_rules
from .sharding import shard
from .simhash import as_hex, near_duplicates
from .toxicity import toxicity

#: What both turns of conversation -1 say.
OWN_TEXT = "</s>[INST] ok [/INST]"


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the formatted texts say, read back from them."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    for b in batches:
        turns = ["".join(f"{role}\n{text}\n" for role, text in read_back(f)) for f in b["formatted"]]
        learned = [CONTROLS.unescape("".join(f[s["start"] : s["stop"]] for s in spans)) for f, spans in zip(b["formatted"], b["spans"], strict=True)]
        yield pd.DataFrame({"conv_id": b["conv_id"], "n_turns": [len(read_back(f)) for f in b["formatted"]], "turns_sha256": list(map(sha, turns)), "loss_chars": list(map(len, learned)), "loss_sha256": list(map(sha, learned)), "formatted_chars": list(map(len, b["formatted"]))})


def op1_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", OWN_TEXT), (-1, 1, "assistant", OWN_TEXT)], turns.schema)
    formatted = format_conversations(turns.unionByName(own))
    return formatted.mapInPandas(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


#: Wanted shares of tokens by language and labelled quality.
TARGETS = {"en/1": 0.5, "de/1": 0.15, "fr/1": 0.15, "es/1": 0.12, "en/0": 0.05, "de/0": 0.01, "fr/0": 0.01, "es/0": 0.01}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents: language and quality."""
    known = docs.select("doc_id", "lang").join(labels.select("doc_id", "quality"), "doc_id")
    return known.where("lang is not null and quality is not null").select("doc_id", F.concat_ws("/", "lang", "quality").alias("domain"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), TARGETS)
    return mixed.select("doc_id", "mix.tokens", F.array_join(F.transform("mix.posterior", lambda x: F.round(x, 6).cast("string")), ",").alias("posterior"), "mix.rate", "mix.copies")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")


#: The place of a document in a tree of directories: every eighth is the licence file of its directory, at one of three depths.
PATH = """CASE WHEN doc_id % 8 <> 0 THEN concat(source, '/', lang, '/', CAST(doc_id % 7 AS string), '/', CAST(doc_id AS string), '.txt')
  WHEN doc_id % 3 = 0 THEN concat(source, '/LICENSE') WHEN doc_id % 3 = 1 THEN concat(source, '/', lang, '/LICENSE')
  ELSE concat(source, '/', lang, '/', CAST(doc_id % 7 AS string), '/COPYING.txt') END"""


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").selectExpr("doc_id", f"{PATH} AS path", "text")).withColumnRenamed("file_id", "doc_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law held is bytes; tokens and rows are balanced with it."""
    rows = shard(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _scored(rows: DataFrame, least: float) -> DataFrame:
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.5)


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(byte_cnn.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.3)


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spotsigs.fingerprints(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("s")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("s_edited")).alias("edited_fingerprint"),
        spotsigs.jaccard(F.col("s"), F.col("s_edited")).alias("near_edited"),
        spotsigs.jaccard(F.col("s"), F.col("s_next")).alias("near_next"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.SQL.items() if k in queries()}
