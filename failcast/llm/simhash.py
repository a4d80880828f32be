"""SimHash near-duplicates by exact comparison of tiles.

Fingerprints that differ are laid out by the bit counts of their two halves. A Hamming
distance is never below the sum of the two differences in bit count, so tiles farther
apart than the radius are not paired and inside a pair only rows of near bit counts are
compared, by numpy exclusive-or and bit counts. A tile holds at most ``TILE`` fingerprints.
A pair of tiles returns a spanning forest of its links, never all pairs of a group.

Defined cases: a null or empty text has no words and the fingerprint zero, which links
like any other; equal fingerprints are one node; a null ``doc_id`` is never a component's
id unless no other is reachable; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import dealt_by, documents, small_side, written
from failcast.llm.components import components

TILE = 1 << 15
#: Bit counts of a half are grouped so wide.
WIDTH = 4
SEED = 42
#: Ids (8 bytes each) that may be broadcast to drop their documents.
ANTI_ROWS = 1_000_000


def fingerprint_of(text: str | None, words_in_shingle: int = 4) -> int:
    """The 64-bit fingerprint of a text: a bit is set if it is in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = words_in_shingle
    last = max(1, len(words) - k + 1)
    starts, ends = starts[:last].tolist(), (ends[k - 1 :] if len(words) >= k else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    set_in = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 15):
        hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)], strict=True)], np.uint64)
        set_in += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > last, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, words_in_shingle: int = 4) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(x, words_in_shingle) for x in texts], np.uint64).view(np.int64))

    return made(text)


class Joined:
    """Labels of nodes, joined pair by pair; a label is the least node of its tree."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, found_a: np.ndarray, found_b: np.ndarray) -> None:
        la, lb = self.label[found_a], self.label[found_b]
        apart = la != lb
        if not apart.any():
            return
        pairs = np.unique(np.stack((np.minimum(la[apart], lb[apart]), np.maximum(la[apart], lb[apart]))), axis=1)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        for x, y in pairs.T.tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        into = np.arange(len(self.label))
        moved = list(parent)
        into[moved] = [root(x) for x in moved]
        self.label = into[self.label]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        node = np.flatnonzero(self.label != np.arange(len(self.label)))
        return node, self.label[node]


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between ``a`` and ``b`` (or within ``a``): positions in both, laid end to end."""
    rows = np.asarray(a, np.uint64)
    cols = rows if b is None else np.asarray(b, np.uint64)
    shift = 0 if b is None else len(rows)
    joined = Joined(len(rows) + (0 if b is None else len(cols)))

    def sorted_cells(x: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], np.ndarray]]:
        high, low = np.bitwise_count(x >> np.uint64(32)), np.bitwise_count(x & np.uint64(0xFFFFFFFF))
        code = high.astype(np.int64) * 64 + low
        order = np.argsort(code, kind="stable")
        cuts = np.flatnonzero(np.diff(code[order])) + 1
        return code, {(int(code[g[0]]) // 64, int(code[g[0]]) % 64): g for g in np.split(order, cuts) if len(g)}

    _, cells_a = sorted_cells(rows)
    cells_b = cells_a if b is None else sorted_cells(cols)[1]
    for (ha, la_), ia in cells_a.items():
        for (hb, lb_), ib in cells_b.items():
            if abs(ha - hb) + abs(la_ - lb_) > radius or (b is None and (hb, lb_) < (ha, la_)):
                continue
            right, at, step = cols[ib], 0, 1
            while at < len(ia):  # the first rows join most of a large group; later blocks then find little to join
                block = ia[at : at + step]
                near_a, near_b = np.nonzero(np.bitwise_count(rows[block][:, None] ^ right[None, :]) <= radius)
                joined.join(block[near_a], ib[near_b] + shift)
                at += step
                step = max(1, min(step * 2, (1 << 19) // len(right)))
    return joined.links()


def links(prints: DataFrame, *, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (fp long) -> (u, v): links of at most ``radius`` bits that keep every component connected."""
    spark: SparkSession = prints.sparkSession
    half = lambda x: F.bit_count(x).cast("int")
    high, low = half(F.shiftrightunsigned("fp", 32)), half(F.col("fp").bitwiseAND(0xFFFFFFFF))
    cell = prints.select("fp", F.floor(high / WIDTH).cast("int").alias("ch"), F.floor(low / WIDTH).cast("int").alias("cl"))
    # At most 9 x 9 cells, however many fingerprints there are.
    chunks = {(r.ch, r.cl): -(-r.n // tile) for r in cell.groupBy("ch", "cl").agg(F.count("*").alias("n")).collect()}
    if not chunks:
        return spark.createDataFrame([], "u long, v long")
    near = lambda x, y: max(0, (abs(x[0] - y[0]) - 1) * WIDTH + 1) + max(0, (abs(x[1] - y[1]) - 1) * WIDTH + 1) <= radius
    rows = [(x[0], x[1], x < y or x == y, *(x if x <= y else y), *(y if x <= y else x), chunks[x], chunks[y]) for x in chunks for y in chunks if near(x, y)]
    partner = spark.createDataFrame(rows, "ch int, cl int, first boolean, ah int, al int, bh int, bl int, mine int, theirs int")
    split = cell.join(F.broadcast(partner.select("ch", "cl", "mine").distinct()), ["ch", "cl"])
    tiles = split.groupBy("ch", "cl", F.pmod(F.xxhash64("fp"), F.col("mine")).cast("int").alias("chunk")).agg(F.collect_list("fp").alias("fps"))
    dealt = tiles.join(F.broadcast(partner), ["ch", "cl"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)))
    own = (F.col("ah") == F.col("bh")) & (F.col("al") == F.col("bl"))
    a, b = F.when(own, F.least("chunk", "other")).when(F.col("first"), F.col("chunk")).otherwise(F.col("other")), F.when(own, F.greatest("chunk", "other")).when(F.col("first"), F.col("other")).otherwise(F.col("chunk"))
    side = F.when(own, F.when(F.col("chunk") <= F.col("other"), 0).otherwise(1)).when(F.col("first"), 0).otherwise(1)
    paired = dealt.select("ah", "al", "bh", "bl", a.alias("a"), b.alias("b"), side.alias("side"), "fps")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left = [np.asarray(x, np.int64) for x in pdf.loc[pdf["side"] == 0, "fps"]]
        right = [np.asarray(x, np.int64) for x in pdf.loc[pdf["side"] == 1, "fps"]]
        first, second = left[0], right[0] if right else None
        node, root = forest(first.view(np.uint64), None if second is None else second.view(np.uint64), radius)
        both = first if second is None else np.concatenate((first, second))
        return pd.DataFrame({"u": both[node], "v": both[root]})

    keys = ("ah", "al", "bh", "bl", "a", "b")
    pairs = sum(r[-1] * r[-2] for r in rows)
    return dealt_by(paired, pairs, *keys).groupBy(*keys).applyInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fp long, component_id): one row for each row of ``docs``."""
    ship(docs.sparkSession)
    made = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), words_in_shingle).alias("fp")))
    distinct = made.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(distinct.select("fp"), radius=radius))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(ids, "root").select(F.col("fp").alias("of"), "component_id")
    return made.join(of_print, F.col("fp") == F.col("of"), "left").select("doc_id", "fp", "component_id")


def only_first(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without those that ``found`` (doc_id, component_id) has in another's group; texts move only if these are many."""
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    copies = written(found.groupBy("doc_id").agg(F.bool_or(own).alias("stays")).where("not stays").select(F.col("doc_id").alias("__copy")))
    return docs.join(small_side(copies, ANTI_ROWS), F.col(id_col).eqNullSafe(F.col("__copy")), "left_anti")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each group: the smallest id (rows that repeat an id stay together)."""
    return only_first(docs, near_duplicates(docs, id_col=id_col, **options), id_col)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
