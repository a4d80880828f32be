"""Pack token sequences by vector bin packing with the dot-product heuristic.

An example has a demand in three dimensions: tokens, segments (one) and loss-bearing
tokens; a sequence has a limit in each. A sequence is opened and filled with the item
that fits and has the largest dot product of demand and what is left of the limits, each
dimension weighed by its mean demand, until nothing fits; then the next is opened.
Documents longer than a sequence are cut into full sequences and one rest, which is packed.

Of a document all tokens bear loss but the first of each piece, which nothing predicts. Of
a conversation only the turns of ``LOSS_ROLES`` do, so the limit on them binds by itself, and
so does that on segments (turns) where turns are short.

Items are dealt to blocks of about ``BLOCK`` items, so a task holds a bounded number,
whatever share of the items one document or source has.

Defined cases: a null or empty text has its closing id alone; rows that repeat an id are
packed as separate documents; a null id or role is one like any other; turns that repeat a
number are ordered by role and text, a null number comes first; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import dealt_by, documents, give_back, spread, written
from failcast.llm.tokens import default_path, encoder

LIMIT = 2048
SEGMENTS = 512
BLOCK = 8192
CLOSING_ID = 1
LOSS_ROLES = ("assistant",)
PIECES = "doc_id long, no_id boolean, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, salt long"


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per piece of each document: full pieces of ``limit`` ids and a rest. A null id is 0 with ``no_id``."""
    ship(docs.sparkSession)
    path = path or default_path()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, seen = encoder(path), 0
        for pdf in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "no_id", "start", "length", "ids_crc32", "doc_tokens", "salt")}
            for doc, no_id, text in zip(pdf["doc_id"], pdf["no_id"], pdf["text"], strict=True):
                ids = array("I", encode(text or ""))
                ids.append(CLOSING_ID)
                raw = ids.tobytes()
                for start in range(0, len(ids), limit):
                    length = min(limit, len(ids) - start)
                    for k, v in zip(out, (doc, no_id, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), len(ids), seen), strict=True):
                        out[k].append(v)
                    seen += 1
            made = pd.DataFrame(out)
            yield made.assign(loss_tokens=made["length"] - 1)[[x.split()[0] for x in PIECES.split(", ")]]
        give_back()

    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"), F.col(id_col).isNull().alias("no_id"), F.col(text_col).alias("text"))
    return plain.mapInPandas(cut, PIECES)


def fill(demand: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Items to sequences: rows of ``demand`` never exceed ``limits`` together."""
    if (demand > limits).any():
        raise ValueError("an item exceeds the limits of a sequence")
    alone = np.flatnonzero(demand[:, 0] == limits[0])
    out = [[int(i)] for i in alone]  # nothing fits beside these
    rest = np.flatnonzero(demand[:, 0] != limits[0])
    order = rest[np.lexsort((rest, -demand[rest, 2], -demand[rest, 0]))]
    need = demand[order].astype(float)
    # Items of equal demand are alike: keep one row for each kind, with its members in order.
    kinds, first, inverse = np.unique(-need, axis=0, return_index=True, return_inverse=True)
    kinds = -kinds
    members: list[list[int]] = [[] for _ in kinds]
    for i, k in zip(order.tolist(), inverse.ravel().tolist(), strict=True):
        members[k].append(i)
    left = np.array([len(m) for m in members])
    total = int(left.sum())
    weight = 1 / np.maximum(need.mean(0), 1e-9) ** 2 if total else np.ones(demand.shape[1])
    while total:
        room, row = limits.astype(float), []
        while True:
            fits = (left > 0) & (kinds <= room).all(1)
            if not fits.any():
                break
            k = int(np.where(fits, kinds @ (weight * room), -1.0).argmax())
            row.append(members[k][-left[k]])
            left[k] -= 1
            total -= 1
            room -= kinds[k]
        out.append(row)
    return out


def pack(items: DataFrame, *, limit: int = LIMIT, segments: int = SEGMENTS, loss: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """``items`` with doc_id, start, salt, length, loss_tokens and, if a piece is several, n_segments -> with sequence_id, offset long."""
    blocks = max(1, math.ceil(items.count() / block))
    bits = 24
    dealt = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(blocks)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema) + ", sequence_id long, offset long"

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "salt"], kind="stable").reset_index(drop=True)
        own = pdf["n_segments"] if "n_segments" in pdf else np.ones(len(pdf))
        demand = np.stack((pdf["length"], own, pdf["loss_tokens"]), axis=1).astype(np.int64)
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for k, row in enumerate(fill(demand, np.array([limit, segments, loss]))):
            sequence[row] = k
            offset[row] = np.cumsum(demand[row, 0]) - demand[row, 0]
        out = pdf.assign(sequence_id=(int(pdf["block"].iloc[0]) << bits) + sequence, offset=offset)
        return out.drop(columns="block")

    return dealt_by(dealt, blocks, "block").groupBy("block").applyInPandas(place, schema)


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT, segments: int = SEGMENTS) -> DataFrame:
    """One row per piece: where its ids are in its document and in which sequence they lie."""
    packed = pack(written(pieces(docs, id_col=id_col, text_col=text_col, path=path, limit=limit)), limit=limit, segments=segments, loss=limit)
    return packed.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id", "salt")


def turns(conversations: DataFrame, *, path: str | None = None, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, no_id, turn, length, bears_loss, name): every turn's tokens, its closing id among them."""
    ship(conversations.sparkSession)
    path = path or default_path()

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path)
        for some in batches:
            yield pd.Series([len(encode(t or "")) + 1 for t in some], dtype="int64")

    # Turns that repeat a number are told apart by what they say.
    name = F.concat_ws(":", F.coalesce("role", F.lit("")), F.hex(F.xxhash64("text")))
    bears = F.coalesce(F.col("role").isin(*loss_roles), F.lit(False))
    return conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("no_id"), F.col("turn").cast("long").alias("turn"), tokens("text").alias("length"), bears.alias("bears_loss"), name.alias("name"))


def turn_offsets(counted: DataFrame) -> DataFrame:
    """``turns`` with ``start`` long, the tokens of its conversation before it, and ``before``, its segments before it.

    Turns are sorted in ranges over all conversations, so that one that has very many is in
    many tasks; only its sums, one for each range, meet.
    """
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["turn", "name"]
    key = ["conv_id", "no_id"]
    ranged = written(counted.repartitionByRange(parts, *key, *order).withColumn("__part", F.spark_partition_id()))
    sums = ranged.groupBy(*key, "__part").agg(F.sum("length").alias("__sum"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(*key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    sums = sums.select(*key, "__part", zero("__sum", earlier).alias("__tokens"), zero("__n", earlier).alias("__turns"))
    own = Window.partitionBy(*key, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(sums, [*key, "__part"])
    return out.withColumns({"start": F.col("__tokens") + zero("length", own), "before": F.col("__turns") + zero(F.lit(1), own)}).drop("__part", "__tokens", "__turns")


def pack_conversations(conversations: DataFrame, *, path: str | None = None, limit: int = LIMIT, segments: int = SEGMENTS, loss: int = LIMIT // 2, loss_roles: tuple[str, ...] = LOSS_ROLES, block: int = BLOCK) -> DataFrame:
    """(conv_id, start, length, n_segments, loss_tokens, loss_spans, sequence_id, offset): one row per piece of a conversation.

    A conversation is its turns' ids end to end, each turn closed by an id of its own. It is
    cut at every ``limit`` ids (``loss``, if that is less) and after every ``segments`` turns, so
    each piece fits alone. ``loss_spans`` are the parts of a piece that bear loss: from, to, from, to and so on.
    """
    cut = min(limit, loss)
    placed = turn_offsets(turns(conversations, path=path, loss_roles=loss_roles))
    end = F.col("start") + F.col("length")
    spread = placed.withColumn("cut", F.explode(F.sequence(F.floor(F.col("start") / cut), F.floor((end - 1) / cut))))
    low, high = F.greatest("start", F.col("cut") * cut), F.least(end, (F.col("cut") + 1) * cut)
    spread = spread.select("conv_id", "no_id", "cut", F.floor(F.col("before") / segments).alias("run"), "bears_loss", low.alias("low"), high.alias("high"))
    size = F.col("high") - F.col("low")
    # A piece has at most ``cut`` ids, so as many turns at most.
    items = spread.groupBy(F.col("conv_id").alias("doc_id"), "no_id", "cut", "run").agg(
        F.min("low").alias("start"),
        F.sum(size).alias("length"),
        F.count("*").alias("n_segments"),
        F.coalesce(F.sum(F.when(F.col("bears_loss"), size)), F.lit(0)).alias("loss_tokens"),
        F.sort_array(F.collect_list(F.when(F.col("bears_loss"), F.struct("low", "high")))).alias("spans"),
    )
    spans = F.flatten(F.transform("spans", lambda x: F.array(x["low"] - F.col("start"), x["high"] - F.col("start"))))
    items = items.select("doc_id", "no_id", "start", "length", "n_segments", "loss_tokens", spans.alias("loss_spans"), F.col("no_id").cast("long").alias("salt"))
    packed = pack(written(items), limit=limit, segments=segments, loss=loss, block=block)
    return packed.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("conv_id"), "start", "length", "n_segments", "loss_tokens", "loss_spans", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack_documents(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction data: conversations packed under limits on tokens, turns and the assistant's tokens, all of which can bind."""
    found = pack_conversations(spread(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return found.withColumn("loss_spans", F.array_join("loss_spans", ","))
