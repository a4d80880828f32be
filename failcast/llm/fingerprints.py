"""Document fingerprints: digests of a text's improbable features.

Every window of 16 bytes has a rarity: its cross-entropy under the byte pairs of the whole
corpus, taken from prefix sums. In every run of 16 neighbouring windows the rarest, first of
equals, gets a vote; windows with at least ``VOTES`` votes are features. Features enter a
chain of Bloom filters in order of place, five bits each, ``PER_FILTER`` to a filter. Two
digests are compared filter by filter: the bits in common beyond what chance gives, divided
by the most there could be; each filter of the shorter digest takes its best partner.

Texts with few such windows take those with fewer votes too, down to one, until there are ``FEW``.

Pairs of neighbours in id order are made without a global window: documents are dealt to
ranges of ids, one to a task, and the first document of each range visits the range before. The
ranges' first ids, one for about ``RANGE_ROWS`` documents, are a one-row table.

Defined cases: a null or empty text has no features and the digest of none, alike (1.0) to
another of none and unlike (0.0) all others; a text under 16 bytes is one feature; rows that
repeat an id are ordered by text; a null id comes first; the last document's next is the
first; a single document is its own next; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import documents, written

WINDOW = 16
VOTES, FEW = 4, 24
FILTER_BITS = 2048
PER_FILTER = 160
HASHES = 5
#: Bits in common count from this share of the way between chance and the most there could be.
BEYOND_CHANCE = 0.1
RANGE_ROWS = 50_000
HEAD = "if1"


def byte_pairs(docs: DataFrame, *, text_col: str = "text") -> np.ndarray:
    """How often each of the 65,536 byte pairs is in all the texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << 16, np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                if text:
                    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint16)
                    total += np.bincount(b[:-1] << 8 | b[1:], minlength=1 << 16)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"pair": some, "n": total[some]})

    rows = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 << 16, np.int64)
    for r in rows:
        out[r.pair] = r.n
    return out


def costs(pairs: np.ndarray) -> np.ndarray:
    """Sixteenths of a bit that each byte costs after the byte before it."""
    grid = pairs.reshape(256, 256) + 0.5
    return np.round(-16 * np.log2(grid / grid.sum(1, keepdims=True))).astype(np.int32).ravel()


def _least_in_runs(x: np.ndarray, length: int) -> np.ndarray:
    """The minimum of every run of ``length`` neighbours."""
    done = 1
    while done < length:
        step = min(done, length - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def features(data: bytes, cost: np.ndarray) -> list[int]:
    """Hashes of the selected windows in order of place, each once."""
    if len(data) < WINDOW:
        return [xxhash.xxh3_64_intdigest(data)] if data else []
    b = np.frombuffer(data, np.uint8).astype(np.uint16)
    before = np.concatenate(([0], np.cumsum(cost[b[:-1] << 8 | b[1:]], dtype=np.int64)))
    rarity = before[WINDOW - 1 :] - before[: len(before) - WINDOW + 1]
    order = ((np.int64(1 << 20) - rarity) << np.int64(40)) | np.arange(len(rarity))
    winner = _least_in_runs(order, min(WINDOW, len(order))) & ((1 << 40) - 1)
    turn = np.flatnonzero(np.concatenate(([True], winner[1:] != winner[:-1])))
    votes = np.diff(np.concatenate((turn, [len(winner)])))
    least = next((v for v in range(VOTES, 1, -1) if (votes >= v).sum() >= FEW), 1)
    return list(dict.fromkeys(xxhash.xxh3_64_intdigest(data[p : p + WINDOW]) for p in winner[turn][votes >= least].tolist()))


def filters(found: list[int]) -> np.ndarray:
    """The chain of Bloom filters: one row of bytes for each."""
    if not found:
        return np.zeros((0, FILTER_BITS // 8), np.uint8)
    h = np.array(found, np.uint64)
    row = np.arange(len(h)) // PER_FILTER
    bits = np.zeros((int(row[-1]) + 1, FILTER_BITS), bool)
    width = FILTER_BITS.bit_length() - 1
    for j in range(HASHES):
        bits[row, ((h >> np.uint64(width * j)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1)


def digest(made: np.ndarray) -> str:
    return f"{HEAD}:{len(made)}:{made.tobytes().hex()}"


def undigest(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text.rsplit(":", 1)[1]), np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if len(b) < len(a):
        a, b = b, a
    bits_a, bits_b = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(1, dtype=np.int64)
        most = np.minimum(bits_a[i], bits_b)
        chance = bits_a[i] * bits_b / FILTER_BITS
        start = chance + BEYOND_CHANCE * (most - chance)
        total += float(np.clip((common - start) / np.maximum(most - start, 1e-9), 0, 1).max())
    return total / len(a)


def _cuts(ids: DataFrame, ranges: int) -> DataFrame:
    """(id long) -> one row: the sorted first ids of the ranges, and whether a null comes before them."""
    part = F.spark_partition_id().alias("part")
    firsts = ids.repartitionByRange(ranges, "id").select("id", part).groupBy("part").agg(F.min("id").alias("first"), F.bool_or(F.col("id").isNull()).alias("null"))
    return written(firsts.agg(F.sort_array(F.collect_list(F.when(~F.col("null"), F.col("first")))).alias("cuts"), F.coalesce(F.bool_or("null"), F.lit(False)).alias("null")))


def _range_of(key: Column, cuts: Column, ranges: int) -> Column:
    """How many of the sorted cuts, ``ranges`` at most, are at or below the key (null: none): a binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(ranges.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(cuts, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at))


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, no_id, text, range, guest) in partitions sorted so that each row's next follows it.

    The row after the last of a range is a guest: the first row of the next range.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(ids.count() / RANGE_ROWS))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cut = rows.crossJoin(F.broadcast(_cuts(ids, ranges)))  # one row, 8 bytes for each range
    cut = cut.withColumn("range", _range_of(F.col("id"), F.col("cuts"), ranges))
    lowest, highest = F.when(F.col("null"), 0).otherwise(1), F.size("cuts")
    before = F.when(F.col("range") > lowest, F.col("range") - 1).otherwise(highest)
    first = F.when(F.col("range") == 0, F.col("id").isNull()).otherwise(F.get("cuts", F.col("range") - 1) == F.col("id"))
    own = F.struct(F.col("range").alias("at"), F.lit(False).alias("guest"))
    visit = F.struct(before.alias("at"), F.lit(True).alias("guest"))
    both = cut.select("id", "text", F.explode(F.when(first, F.array(own, visit)).otherwise(F.array(own))).alias("to"))
    dealt = both.select("id", "text", F.col("to.at").alias("range"), F.col("to.guest").alias("guest")).repartitionById(ranges + 1, "range")
    return dealt.sortWithinPartitions("range", "guest", "id", "text").select(F.coalesce("id", F.lit(0)).alias("doc_id"), F.col("id").isNull().alias("no_id"), "text", "range", "guest")


RESULT = "doc_id long, no_id boolean, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's digest, that of its edit (second half replaced by the next text's start), and their likeness."""
    spark = docs.sparkSession
    ship(spark)
    cost = spark.sparkContext.broadcast(costs(byte_pairs(docs, text_col=text_col)))
    names = [x.split()[0] for x in RESULT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = cost.value
        made = lambda s: filters(features(s.encode("utf-8", "surrogatepass"), table))
        held: tuple | None = None  # the row before, still without its next
        for pdf in batches:
            out = []
            for doc, no_id, text, where, guest in zip(pdf["doc_id"], pdf["no_id"], pdf["text"], pdf["range"], pdf["guest"], strict=True):
                own = made(text)
                if held is not None and held[3] == where:
                    doc_, no_id_, text_, _, own_ = held
                    half = len(text_) // 2
                    edited = text_[: len(text_) - half] + text[:half]
                    other = made(edited)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((doc_, no_id_, len(text_), sha, digest(own_), digest(other), likeness(own_, other), likeness(own_, own)))
                held = None if guest else (doc, no_id, text, where, own)
                if len(out) >= 2000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    found = with_next(docs, id_col=id_col, text_col=text_col).mapInPandas(run, RESULT)
    return found.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(documents(spark, sf_dir).select("doc_id", "text"))
