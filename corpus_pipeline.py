"""The corpus pipeline: toxic documents go, repeated lines go, one document of each near
copy stays, sources are mixed to their targets, and what is taken is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. Each stage is written as Parquet in the shared folder and
read again, so a lost executor costs work of one stage at most.

Defined cases: null texts go through as empty ones; the toxicity stage judges each row by
its own text, whatever its id; rows that repeat an id are one document for line dedup, and
stay or go together in near-dedup; a null id is an id like any other there; the mix takes rows of
a null source as a source of its own; an empty table, or stage that keeps nothing, gives an
empty result; columns beside those of ``documents`` are dropped at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.llm import line_dedup, mixing, packing, similar, toxicity
from failcast.llm.common import documents, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional language models reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs.select(*COLUMNS), labels)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent long lines stay in one document; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose five-word shingles are at least 0.8 alike stays."""
    return similar.keep_one_similar(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences; one row per piece."""
    found = packing.pack_documents(docs.select("doc_id", "text"))
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", remove_repeated_lines),
    ("SimHash near-dedup", remove_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the language models, the cube method or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
