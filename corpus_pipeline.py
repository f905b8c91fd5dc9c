"""A training corpus from raw documents: judged, cleaned, deduplicated, mixed and packed.

Each stage takes all its predecessor kept, as a table, and returns a table; ``run`` writes each stage's rows to the shared folder and reads
them again, so that a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, shared_dir, table
from ledgerlens.llm.mixing import mix
from ledgerlens.llm.packing import pack
from ledgerlens.llm.quality_rules import quality_rules
from ledgerlens.llm.shingle_join import near_duplicates
from ledgerlens.llm.simhash import keep_named
from ledgerlens.llm.toxicity import toxicity

#: Wanted shares of tokens by language. The total is the least at which no language shrinks.
TARGETS = {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1}
TOXIC = 0.5


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    They go by an explode of nothing: a filter would be pushed below the verdict and compute its costly parts once more for each use.
    """
    q, k = fresh(docs, "quality", "kept")
    judged = quality_rules(docs, out=q).select(*docs.columns, F.explode(F.when(F.col(f"{q}.kept"), F.array(F.lit(True)))).alias(k))
    return judged.select(docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    s = fresh(docs, "score")[0]
    return toxicity(docs, table(spark, sf_dir, "labels"), out=s).where(F.col(s) < TOXIC).select(docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: those that share four fifths or more of their five-word shingles.

    SimHash balls link the nearest, an exact completion the rest, which no ball of bounded size reaches.
    """
    return keep_named(docs, near_duplicates(docs)).select(docs.columns)


def balance(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document appears as often as its fitted rate says, once at least; languages meet their target shares."""
    m = fresh(docs, "mix")[0]
    domains = docs.select("doc_id", F.col("lang").alias("domain")).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    mixed = mix(docs, domains, TARGETS, budget="cover", out=m)
    copies = F.greatest(F.col(f"{m}.copies"), F.lit(1).cast("long"))
    return mixed.withColumn(m, F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every copy of every document with its bin. Copies of a document are alike; copy (0, 1 ..) tells them apart."""
    same = Window.partitionBy("doc_id", "piece").orderBy("bin_id", "bin_offset")
    return pack(docs).withColumn("copy", F.row_number().over(same) - 1)


STAGES = [("quality rules", judge), ("toxicity", clean), ("near duplicates", deduplicate), ("mixing", balance), ("packing", sequences)]

#: Two stages learn models, which SQL can't express; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
