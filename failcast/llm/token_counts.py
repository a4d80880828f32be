"""Exact token totals from a histogram of document lengths.

Documents are aggregated by their encoded length. Suffix sums over the distinct lengths
then answer how many documents and tokens lie at or above any length, what a corpus cut
off at any context limit keeps, and every quantile, without going back to the documents.
Suffix sums run inside buckets of lengths and over the buckets' totals, so no task gets
more than a bucket of lengths or one total for each bucket.

Defined cases: a null or empty text has length 0; rows that repeat an id count each; an
empty table gives an empty histogram, total 0 and no quantile; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import documents, written
from failcast.llm.tokens import default_path, encoder

BUCKET = 4096


def lengths(docs: DataFrame, *, text_col: str = "text", path: str | None = None) -> DataFrame:
    """(n_tokens long): one row for each row of ``docs``."""
    ship(docs.sparkSession)
    path = path or default_path()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for pdf in batches:
            yield pd.DataFrame({"n_tokens": [len(encode(t or "")) for t in pdf["text"]]}, dtype="int64")

    return docs.select(F.col(text_col).alias("text")).mapInPandas(count, "n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """(n_tokens) -> one row for each length with its suffix sums.

    n_docs: documents of this length; docs_from, tokens_from: documents this long or
    longer, and their tokens; kept_at_limit: tokens left if every document is cut off at
    this length; docs_over: documents that such a limit cuts; fraction_to: share of
    documents up to this length.
    """
    plain = written(counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs")).withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET)))
    per_bucket = plain.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    later = per_bucket.select("bucket", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"))
    whole = per_bucket.agg(F.sum("d").alias("d_all"), F.sum("t").alias("t_all"))
    down = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        plain.join(later, "bucket")
        .crossJoin(F.broadcast(whole))  # one row
        .withColumn("docs_from", F.sum("n_docs").over(down) + F.col("d_above"))
        .withColumn("tokens_from", F.sum(F.col("n_docs") * F.col("n_tokens")).over(down) + F.col("t_above"))
    )
    return sums.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("docs_from") * F.col("n_tokens")).alias("kept_at_limit"),
        (F.col("docs_from") - F.col("n_docs")).alias("docs_over"),
        ((F.col("d_all") - F.col("docs_from") + F.col("n_docs")) / F.col("d_all")).alias("fraction_to"),
    )


def total(hist: DataFrame) -> int:
    return int(hist.agg(F.sum(F.col("n_docs") * F.col("n_tokens"))).first()[0] or 0)


def kept_at(hist: DataFrame, limit: int) -> int:
    """Tokens left if every document is cut off at ``limit``, whether or not a document is so long."""
    below = hist.where(F.col("n_tokens") < limit).agg(F.sum(F.col("n_docs") * F.col("n_tokens"))).first()[0] or 0
    longer = hist.where(F.col("n_tokens") >= limit).agg(F.max("docs_from")).first()[0] or 0
    return int(below + limit * longer)


def quantile(hist: DataFrame, q: float) -> int | None:
    """The least length that a share ``q`` of the documents does not exceed."""
    return hist.where(F.col("fraction_to") >= q).agg(F.min("n_tokens")).first()[0]


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(lengths(documents(spark, sf_dir).select("text")))
