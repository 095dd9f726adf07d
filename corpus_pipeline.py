"""A corpus pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and
its result is written as Parquet in the shared folder and read again. All but
the last return the columns of ``documents``; null and empty texts pass every
stage (they are not toxic, link with nothing, match nothing, hold no secret and
have no ids), an empty table gives an empty result, and columns beyond those of
``documents`` pass through the filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremarts.llm import bpe, credentials, decontam, neardup, toxicity
from caremarts.llm.common import table, written
from caremarts.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents scored at or over their language's threshold go."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net).where("not toxic_flag").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near-duplicates stays.

    Rows that repeat an id and text are one document, of which one row stays;
    rows without an id are not compared and stay.
    """
    gone = neardup.near_duplicates(docs).where("not kept and doc_id is not null").select("doc_id")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = left.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    once = left.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"), least_chars=1)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: reported secrets are replaced by a mark, and n_chars follows."""
    return credentials.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token ids of each text, with what they decode to checked by its digest."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary(), decoded="decoded")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode_tokens),
]

#: A trained classifier, edit distances and BPE merges cannot be stated in SQL;
#: tests/llm holds the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
