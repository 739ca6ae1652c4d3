"""Training-data pipeline: rule filter, language filter, near-duplicate removal, source mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborspark.llm import bpe_codec, jaccard, langid, mixing, quality
from arborspark.llm.lookup import within_bound
from arborspark.llm.queries import table, tokenizer_path
from arborspark.session import land


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), keep_text=True)
    return judged.filter("kept").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; a missing lang is filled in."""
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    told = langid.identify(docs, model).filter(F.col("lang_pred") != langid.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: five words, similarity 0.8 or more.

    The smallest doc_id of a group stays.  Different texts under one doc_id are
    documents of their own, equal ones are one; documents without doc_id stay.
    """
    repeated = land(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    once = docs.join(within_bound(repeated), "doc_id", "left_anti")
    again = docs.join(within_bound(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    # texts of a repeated doc_id go by numbers below all doc_ids
    floor = min(docs.agg(F.min("doc_id")).first()[0] or 0, 0) - 1
    again = land(again.withColumn("_node", F.lit(floor) - F.monotonically_increasing_id()), "again")
    nodes = once.select("doc_id", "text").unionByName(again.select(F.col("_node").alias("doc_id"), "text"))
    found = land(jaccard.similar(nodes, width=5, percent=80), "classes")
    own = land(found.join(within_bound(again.select(F.col("_node").alias("doc_id"), F.col("doc_id").alias("real"))), "doc_id", "left").filter("real is not null"), "own")
    mixed = land(own.select("component_id").distinct(), "mixed")
    # the smallest node stays, but where numbers of repeated ids take part the smallest real doc_id
    members = found.join(within_bound(mixed), "component_id", "left_semi").join(within_bound(own.select("doc_id", "real")), "doc_id", "left")
    members = members.withColumn("real", F.coalesce("real", "doc_id"))
    stays = land(members.groupBy("component_id").agg(F.min(F.struct("real", "doc_id")).alias("m")).select(F.col("m.doc_id").alias("doc_id")), "stays")
    plain = found.join(within_bound(mixed), "component_id", "left_anti").filter("doc_id <> component_id").select("doc_id")
    other = members.select("doc_id").join(within_bound(stays), "doc_id", "left_anti")
    doubles = within_bound(land(plain.unionByName(other).distinct(), "doubles"))
    left = once.join(doubles, "doc_id", "left_anti").select(docs.columns)
    return left.unionByName(again.withColumnRenamed("doc_id", "_id").withColumnRenamed("_node", "doc_id").join(doubles, "doc_id", "left_anti").withColumn("doc_id", F.col("_id")).select(docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; sources weigh 1, 2, 3 in turn."""
    rows = land(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "rows")
    sized = rows.select(F.col("_mix_row").alias("doc_id"), "source", mixing.word_count("text").alias("size"))
    copies = land(mixing.mix(sized, weights=(1, 2, 3), cap=3).select(F.col("doc_id").alias("_mix_row"), F.col("copies").alias("_copies")).filter("_copies > 0"), "copies")
    taken = rows.join(within_bound(copies), "_mix_row")
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).drop("_copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, with the digest of their decoded text."""
    coded = bpe_codec.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path(), decoded="decoded", keep_text=False)
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("language_id", language_id), ("jaccard_join", jaccard_join), ("mix_sources", mix_sources), ("bpe_codec", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
