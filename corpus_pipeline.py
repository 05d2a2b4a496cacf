"""From raw documents to token ids: rules, line dedup, near dedup, mixing, encoding.

Every stage works on all that its predecessor kept, read back from Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm.bpe_codec import encode_documents
from lettermill.llm.common import digest16, packed, unpacked, whole_text
from lettermill.llm.line_dedup import dedup_lines
from lettermill.llm.mixing import mix
from lettermill.llm.near_dedup import near_duplicates
from lettermill.llm.quality_rules import judge
from lettermill.storage import new_work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep. Null and empty texts fail the base
    rules; repeated rows are judged alike; an empty table stays empty."""
    return unpacked(judge(docs, carry=True).filter("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another one keeps; n_chars follows the text. A null or empty text
    becomes or stays empty, and every row stays."""
    return unpacked(dedup_lines(docs), docs, text=F.col("kept"), n_chars=F.length("kept").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 or more: the one with the smallest
    doc_id, none last, and of those the one with the least digest of its text. Texts without words are
    linked with nothing. Of rows that repeat doc_id and text one stays."""
    found = near_duplicates(docs, percent=80, keys=True)
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    alone = F.col("group").isNull()
    winners = found.filter(~alone).groupBy("group").agg(F.min(name).alias("w")).select("w.doc_id", "w.digest")
    winners = winners.unionByName(found.filter(alone).select("doc_id", "digest").distinct())
    winners = winners.select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("id"), digest16(whole_text()).alias("body"))
    # one shuffle of texts, by digest, serves the join and the repeated rows
    same = (F.col("body") == F.col("kept_digest")) & F.col("id").eqNullSafe(F.col("kept_id"))
    return unpacked(rows.join(winners, same, "left_semi").dropDuplicates(["id", "body"]), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens meet the target shares. Null keys are values of their own; rows that
    repeat doc_id and text stand or fall together."""
    return unpacked(mix(docs).filter("kept"), docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the characters that decoding them gives; none for null and empty texts."""
    return encode_documents(docs).select("doc_id", "n_tokens", "ids", F.length("decoded").cast("long").alias("n_chars"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe_codec", bpe_codec),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = new_work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The outlier test of the first stage is iterative and has no SQL; tests/llm has a brute-force version.
ORACLE_SQL = None
