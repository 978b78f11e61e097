"""From raw documents to token ids: quality rules, line dedup, near dedup, decontamination, encoding.

Each stage is written as Parquet and read again as the next one's documents, in the shared folder. All but the last
return the columns of ``documents``, with ``n_chars`` kept in step with the text.

Null and empty texts have no words and go in the first stage. Rows with a null doc_id are documents like others, but none
that others are copies of: in near dedup they go for a copy with an id, and one of equal ones stays. Of rows that share an
id, equal ones become one in near dedup, the rest are judged row by row. An empty table gives an empty result; further
columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoferry.llm import decontamination, line_dedup, near_dedup, pieces, quality_rules
from geoferry.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, but for one document's."""
    done = line_dedup.without_shared_lines(docs)
    return done.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else done


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    done = pieces.tokenized(docs, pieces.model_bytes())
    others = [F.col(f"`{name}`") for name in docs.columns if name not in ("text", "n_tokens", "ids")]
    return done.select(*others, F.size("__ids").cast("long").alias("n_tokens"), F.col("__ids").alias("ids"))


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("benchmark", benchmark), ("encode", encode)]

#: Two of the stages go on until nothing changes, or follow a model file; tests compare with a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), Scratch()
    for name, stage in STAGES:
        after = Scratch()
        docs = after.stage(stage(spark, docs, sf_dir), f"stage-{name}")
        before.drop(spark)
        before = after
    return docs
