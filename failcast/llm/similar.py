"""Near copies by the exact similarity of their shingle sets, found by wide SimHash prints.

A text's set holds the hashes of its different five-word shingles. Its print is a SimHash
of ``PRINT`` 64-bit words over that set. At a Jaccard similarity of 0.8 the sets' cosine is
0.89 and two prints differ in 15 % of their bits, one standard deviation being 2.9 of the
first 64 and 5.7 of all 256: ``FIRST_RADIUS`` and ``RADIUS`` lie 3.7 and 4.4 deviations
above. Prints are compared tile by tile; those within both radii are candidates. Inside a
component of candidates, documents are linked if their sets are at least ``SIMILARITY``
alike, counted exactly; components of these links are the groups.

Defined cases: equal sets are one node; a null or empty text has the empty set, like any
other of them and nothing else; a text below five words is one shingle; a null ``doc_id``
names a group only if no other is in it; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import dealt_by, give_back, small_side, written
from failcast.llm.components import components
from failcast.llm.simhash import SEED, Joined, only_first

WORDS = 5
SIMILARITY = 0.8
PRINT = 4
FIRST_RADIUS, RADIUS = 20, 64
TILE = 1 << 17
#: A smaller table is still cut into up to so many tiles, of ``LEAST`` prints at least.
TILES, LEAST = 16, 1 << 12
#: Of sets compared exactly at once: documents and shingles.
CHUNK, CHUNK_SHINGLES = 1 << 12, 1 << 22
PRINTS = [f"f{j}" for j in range(PRINT)]
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def shingles_of(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles of ``k`` words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, last = xxhash.xxh64_intdigest, max(1, len(words) - k + 1)
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:last].tolist()
    ends = (ends[k - 1 :] if len(words) >= k else ends[-1:]).tolist()
    return np.unique(np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, last))


def print_of(shingles: np.ndarray) -> np.ndarray:
    """The wide SimHash of a set, ``PRINT`` words; bits are set that over half of the hashes have."""
    out = np.zeros(PRINT, np.uint64)
    for j in range(PRINT if len(shingles) else 0):
        with np.errstate(over="ignore"):
            h = shingles if j == 0 else (shingles ^ (shingles >> np.uint64(32))) * _ODD[j]
            h = h if j == 0 else (h ^ (h >> np.uint64(29))) * _ODD[0]
            h = h if j == 0 else h ^ (h >> np.uint64(32))
        n = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 15):
            n += np.unpackbits(h[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[j] = np.packbits(n * 2 > len(h), bitorder="little").view(np.uint64)[0]
    return out


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of ``shingles_of``."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def near_prints(a: np.ndarray, b: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the candidates between two tiles of prints (rows of ``PRINT`` words), or within one: positions, laid end to end."""
    right, shift = (a, 0) if b is None else (b, len(a))
    joined, first, at, step = Joined(len(a) + (0 if b is None else len(b))), np.ascontiguousarray(right[:, 0]), 0, 1
    while at < len(a):
        block = a[at : at + step]
        from_ = at if b is None else 0
        x, y = np.nonzero(np.bitwise_count(block[:, :1] ^ first[None, from_:]) <= FIRST_RADIUS)
        y = y + from_
        near = np.bitwise_count(block[x] ^ right[y]).sum(1, dtype=np.int64) <= RADIUS
        joined.join(x[near] + at, y[near] + shift)
        at += step
        step = max(1, min(step * 2, (1 << 19) // len(first)))
    return joined.links()


def linked(prints: np.ndarray, sets: list[np.ndarray], cut: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the exact links between the sets before ``cut`` and those after, or among all if ``cut`` is their number."""
    n = len(sets)
    joined, size = Joined(n), np.array([len(x) for x in sets])
    for i in range(cut):
        low = cut if cut < n else i + 1
        other = np.arange(low, n)
        small, large = np.minimum(size[i], size[other]), np.maximum(size[i], size[other])
        # The same radii as of the tiles, so cutting a component into chunks changes nothing.
        far = np.bitwise_count(prints[i] ^ prints[other])
        may = (small >= similarity * large) & (far[:, 0] <= FIRST_RADIUS) & (far.sum(1, dtype=np.int64) <= RADIUS)
        for j in other[may].tolist():
            if joined.label[i] != joined.label[j] and alike(sets[i], sets[j]) >= similarity:
                joined.join(np.array([i]), np.array([j]))
    return joined.links()


def _pairs(cut: DataFrame) -> DataFrame:
    """Rows dealt into numbered chunks (``chunk`` of ``chunks``) -> each row once for each pair of chunks (a <= b) of its group that has it."""
    out = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return out.withColumn("a", F.least("chunk", "other")).withColumn("b", F.greatest("chunk", "other")).drop("other")


def _candidates(nodes: DataFrame) -> DataFrame:
    """(node, f0..) -> (u, v): links that keep every component of candidates connected."""
    n = nodes.count()
    tiles = max(-(-n // TILE), min(TILES, -(-n // LEAST)), 1)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["chunk", "node"], kind="stable")
        first = (pdf["chunk"] == pdf["a"]).to_numpy()
        own = bool(first.all() and (pdf["a"] == pdf["b"]).all())
        prints, name = pdf[PRINTS].to_numpy(np.int64).view(np.uint64), pdf["node"].to_numpy()
        if not own and (first.all() or not first.any()):
            return pd.DataFrame({"u": name[:0], "v": name[:0]})
        node, root = near_prints(prints, None) if own else near_prints(prints[first], prints[~first])
        return pd.DataFrame({"u": name[node], "v": name[root]})

    cut = nodes.select("node", *PRINTS).withColumn("chunks", F.lit(tiles)).withColumn("chunk", F.pmod(F.xxhash64("node"), F.lit(tiles)).cast("int"))
    pairs = dealt_by(_pairs(cut).drop("chunks"), tiles * (tiles + 1) // 2, "a", "b")
    return pairs.groupBy("a", "b").applyInPandas(compare, "u long, v long")


def similar_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, component_id): one row for each row of ``docs``; components of pairs at least ``similarity`` alike."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))

    @F.pandas_udf("struct<node long, size int, " + ", ".join(f"{f} long" for f in PRINTS) + ">")
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in batches:
            rows = np.zeros((len(some), PRINT + 2), np.uint64)
            for i, text in enumerate(some):
                found = shingles_of(text)
                rows[i, 0], rows[i, 1], rows[i, 2:] = xxhash.xxh64_intdigest(found.tobytes()), len(found), print_of(found)
            yield pd.DataFrame(rows.view(np.int64), columns=["node", "size", *PRINTS]).astype({"size": "int32"})
        give_back()

    made = written(texts.select("doc_id", "th", printed("text").alias("p")).select("doc_id", "th", "p.*"))
    nodes = written(made.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("th").alias("th"), F.first("size").alias("size"), *[F.first(f).alias(f) for f in PRINTS]))
    # The empty set is like no other; its print means nothing.
    maybe = written(components(_candidates(nodes.where("size > 0"))).select(F.col("node").alias("member"), F.col("root").alias("candidate")))
    weight = maybe.join(nodes.select("node", "size"), F.col("member") == F.col("node")).groupBy(F.col("candidate").alias("whole"))
    chunks = written(weight.agg(F.greatest(F.ceil(F.count("*") / chunk), F.ceil(F.sum("size") / CHUNK_SHINGLES)).cast("int").alias("chunks")))
    chosen = written(maybe.join(nodes, F.col("member") == F.col("node")).join(small_side(chunks), F.col("candidate") == F.col("whole")).select("candidate", "node", F.col("th").alias("of"), *PRINTS, "chunks"))

    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        return pd.Series([shingles_of(x).tobytes() for x in text])

    whole = texts.join(small_side(chosen), F.col("th") == F.col("of")).dropDuplicates(["candidate", "node"]).withColumn("set", packed("text"))
    cut = whole.select("candidate", "node", *PRINTS, "chunks", "set").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int"))

    def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(second=pdf["chunk"] != pdf["a"]).sort_values(["second", "node"], kind="stable")
        name, sets = pdf["node"].to_numpy(), [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        first = int((~pdf["second"]).sum())
        if not first or (first == len(pdf) and pdf["a"].iloc[0] != pdf["b"].iloc[0]):
            return pd.DataFrame({"u": name[:0], "v": name[:0]})
        node, root = linked(pdf[PRINTS].to_numpy(np.int64).view(np.uint64), sets, first, similarity)
        return pd.DataFrame({"u": name[node], "v": name[root]})

    links = _pairs(cut).drop("chunks").groupBy("candidate", "a", "b").applyInPandas(confirm, "u long, v long")
    found = components(links)
    rooted = nodes.select("node", "least").join(found.select(F.col("node").alias("member"), "root"), F.col("node") == F.col("member"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = rooted.join(ids, "root").select(F.col("node").alias("of"), "component_id")
    return made.join(of_node, F.col("node") == F.col("of"), "left").select("doc_id", "component_id")


def keep_one_similar(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each group: the smallest id (rows that repeat an id stay together)."""
    return only_first(docs, similar_copies(docs, id_col=id_col, **options), id_col)
