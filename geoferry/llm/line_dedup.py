"""Drop lines that many documents share.

A line's key is the line stripped of white space at both ends, with A-Z in lower case. A key of at least
``least_length`` code points held by at least ``least_documents`` documents loses all its lines, except in the document
with the largest id that holds it. Everything else stays, joined by newlines in its old order.

Null and empty texts are one empty line. Rows that share a doc_id count as one document. A null doc_id counts as no
document: it can't be the one that keeps a line. Further columns of the rows stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import SPACES, ascii_lower, hash128, shuffled_join, staged

#: Fixed values of the contract.
LEAST_LENGTH, LEAST_DOCUMENTS = 40, 5


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def keyed_lines(docs: DataFrame, key: str, text: str, least_length: int) -> DataFrame:
    """Row hash, document and place of every line that is long enough, with the hash of its key."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("doc"), whole.alias("text"))
    lines = rows.select("doc", *hash128("r", F.col("doc"), F.col("text")), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return (
        lines.where(F.char_length("line") >= least_length)
        .withColumn("line", line_key(F.col("line")))
        .where(F.char_length("line") >= least_length)
        .select("doc", "r0", "r1", "at", *hash128("h", F.col("line")))
    )


def shared_keys(lines: DataFrame, least_documents: int) -> DataFrame:
    """Keys held by enough documents, and the largest of these. Both groupings combine before they shuffle."""
    return (
        lines.where(F.col("doc").isNotNull())
        .groupBy("h0", "h1", "doc").agg(F.lit(1).alias("one"))
        .groupBy("h0", "h1").agg(F.count("*").alias("n_documents"), F.max("doc").alias("keeper"))
        .where(F.col("n_documents") >= least_documents)
    )


def with_kept_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """All rows and columns of ``docs``, with ``__n_lines``, ``__n_dropped`` and ``__kept`` (the text that stays).

    Only 128-bit hashes of long lines are shuffled. A hot key's lines are dealt out anew by the join, since the keys
    come from a written table. The texts are shuffled once, to meet the places of their dropped lines.
    """
    lines = staged(keyed_lines(docs, key, text, least_length), "lines")
    keys = staged(shared_keys(lines, least_documents), "shared-lines")
    dropped = (
        shuffled_join(lines, keys.select("h0", "h1", "keeper"), ["h0", "h1"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("r0", "r1").agg(F.collect_set("at").alias("__dropped"))
    )
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    row_hashes = hash128("__r", F.col(f"`{key}`"), whole)
    places = dropped.withColumnsRenamed({"r0": "__p0", "r1": "__p1"}).hint("shuffle_hash")
    rows = docs.withColumns({f"__r{number}": hashed for number, hashed in enumerate(row_hashes)})
    joined = rows.join(places, (F.col("__r0") == F.col("__p0")) & (F.col("__r1") == F.col("__p1")), "left")
    split = F.split(whole, "\n")
    stays = F.array_except(F.sequence(F.lit(0), F.size("__split") - 1), F.col("__dropped"))
    kept = F.when(F.col("__dropped").isNull(), whole).otherwise(
        F.array_join(F.transform(stays, lambda at: F.get(F.col("__split"), at)), "\n")
    )
    return (
        joined.withColumn("__split", split)
        .withColumn("__n_lines", F.size("__split").cast("long"))
        .withColumn("__n_dropped", F.coalesce(F.size("__dropped"), F.lit(0)).cast("long"))
        .withColumn("__kept", kept)
        .drop("__split", "__dropped", "__r0", "__r1", "__p0", "__p1")
    )


def without_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits: int) -> DataFrame:
    """The documents with the shared lines gone from their texts; all columns stay, the text null where it was."""
    done = with_kept_lines(docs, key, text, **limits)
    new = F.when(F.col(f"`{text}`").isNotNull(), F.col("__kept")).alias(text)
    return done.select(*[new if name == text else F.col(f"`{name}`") for name in docs.columns])


def line_dedup_report(docs: DataFrame) -> DataFrame:
    done = with_kept_lines(docs)
    return done.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.col("__kept"), 256).alias("kept_sha256"),
    )
