"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next stage's
``docs``.  Every stage works on all rows its predecessor kept; all but the last
return the columns of ``docs``.  ``run`` applies the stages to ``documents``.  The
order that mixing writes is the order of the slots in each shard.

Rows are dropped by anti-joins with lean tables of (id, hash of the text), so equal
ids with different texts are told apart.  Of repeated rows with one id and one
text, the near-duplicate stage keeps one.  Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.bounded_ring import ordered_digest
from caseflow.llm.common import find_package, read_table
from caseflow.llm.kn_quality import quality_rules
from caseflow.llm.latent_decontam import contaminated
from caseflow.llm.pfair_mix import mix_sources
from caseflow.llm.setsketch_dedup import near_duplicates
from caseflow.session import stage

#: SQL cannot express the models, sketches and schedules of the stages; tests/llm compares run() with brute force.
ORACLE_SQL = None


#: Percent of common five-word shingles from which documents are near-duplicates here; op8's own contract is 85.
NEAR_PERCENT = 80


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, hash of text) is not in ``gone(doc_id, _key)``."""
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("_key").alias("_gone_key")).distinct()
    return docs.join(gone, same_text(docs, gone), "left_anti")


def same_text(docs: DataFrame, keys: DataFrame) -> Column:
    """Whether a row of ``docs`` has the id and text of ``keys(id, hash)``; nulls are equal."""
    first, second = keys.columns
    return docs["doc_id"].eqNullSafe(keys[first]) & (F.xxhash64(docs["text"]) == keys[second])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside their language's perplexity bands."""
    find_package(spark)
    return without(docs, quality_rules(docs).where(~F.col("kept")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    find_package(spark)
    verdicts = stage(near_duplicates(docs, num=NEAR_PERCENT))
    kept = without(docs, verdicts.where(~F.col("kept")))
    repeated = verdicts.where("kept and n_shingles > 0").groupBy("doc_id", "_key").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    keys = repeated.select(F.col("doc_id").alias("_again_id"), F.col("_key").alias("_again_key"))
    both = kept.join(keys, same_text(kept, keys), "left_semi")
    return without(kept, repeated).unionByName(both.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    find_package(spark)
    hits = contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["_gone_id"]), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves sources by their target weights."""
    # own names, so that columns named like the operator's output keep their values
    inner = [f"_d{i}" for i in range(len(docs.columns))]
    name = dict(zip(docs.columns, inner, strict=True))
    mixed = mix_sources(docs.toDF(*inner), source=name["source"], key=name["doc_id"])
    return mixed.orderBy("position").select(*inner).toDF(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; the slots of a shard keep the order of ``docs``, the mixed one."""
    return ordered_digest(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
