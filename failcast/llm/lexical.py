"""Ranked lexical search: a blocked sparse matrix product.

Items are the rows of a sparse matrix of term multiplicities, documents the columns of one of
int64 impacts. Documents are worked on in blocks, in the task that reads them: a block's impacts
are stored by term, and an item's row of the product is merged from the rows of its terms
(Gustavson's algorithm) into an array with a place for each document of the block. Of each
block only what can still be among an item's best is kept, so a task sends at most ``top`` rows
for each item; these are reduced in two steps, so that no task gets what all tasks sent.

Counts over all documents (documents with terms, terms, and documents for each term of an item)
come from a pass of its own: each task adds up its own documents first.

Items are worked on in blocks too, as many as have ``ENTRIES`` (item, term) pairs each; only one
block's pairs are broadcast at a time, and never collected beside another's. An item of very many
terms is one block's, whatever it needs: its size is that of its own text.

A term is a maximal run of ASCII letters and digits and of all other code points from 128 on,
with A-Z lower-cased; in UTF-8 these are runs of bytes, so texts are never decoded.

Defined cases: a null or empty text has no terms: such a document is not counted and never
found, such an item finds nothing; rows that repeat a document's id are documents of their own;
rows that repeat an item's id are one item with the terms of all of them; a null id is an id
like any other, and comes last among equal scores; documents of equal score and
id are alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import LOWER, UPPER, ascii_lower, documents, forget, spread, value_once, whole_text, written

TOP = 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: (item, term) pairs of a block of items, and documents and words of a block of documents.
ENTRIES = 500_000
DOCS = 4_096
WORDS = 2_000_000
#: Into how many groups the tasks' best are dealt before the last reduction.
GROUPS = 64

_LETTERS = {*b"0123456789", *UPPER.encode(), *LOWER.encode(), *range(128, 256)}
#: Bytes of terms, lower-cased; all others are blanks.
FOLD = bytes((b | 32 if 65 <= b <= 90 else b) if b in _LETTERS else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(batches: Iterator[pa.RecordBatch], known: dict[bytes, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of documents: ids, whether null, terms of each; then, by term: terms, documents, occurrences."""
    get = known.get
    ids: list[np.ndarray] = []
    nulls: list[np.ndarray] = []
    lengths: list[int] = []
    found: list[np.ndarray] = []
    rows: list[int] = []
    words = 0

    def block():
        n = np.array(lengths, np.int64)
        which = np.concatenate(found) if found else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(rows)), rows)
        key, tf = np.unique(which * len(n) + doc, return_counts=True)  # by term, then document
        return np.concatenate(ids), np.concatenate(nulls), n, key // max(1, len(n)), key % max(1, len(n)), tf.astype(np.int64)

    for batch in batches:
        id_, texts = batch.column("id"), batch.column("text")
        for at in range(0, batch.num_rows, 256):  # a block ends after any of these
            some = id_.slice(at, 256)
            ids.append(some.fill_null(0).to_numpy(zero_copy_only=False))
            nulls.append(some.is_null().to_numpy(zero_copy_only=False))
            for text in texts.slice(at, 256).to_pylist():
                own = terms(text)
                mine = [k for k in map(get, own) if k is not None]
                lengths.append(len(own))
                rows.append(len(mine))
                found.append(np.array(mine, np.int64))
                words += len(mine)
            if len(lengths) >= DOCS or words >= WORDS:
                yield block()
                ids, nulls, lengths, found, rows, words = [], [], [], [], [], 0
    if lengths:
        yield block()


def term_counts(docs: DataFrame, known) -> DataFrame:
    """(term, n): for each known term the documents that have it; at -1 the documents with any term, at -2 all terms. ``known`` is a broadcast dictionary."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value
        df, with_terms, all_terms = np.zeros(len(place), np.int64), 0, 0
        for _, _, n, term, _, _ in _blocks(batches, place):
            df += np.bincount(term, minlength=len(df))
            with_terms, all_terms = with_terms + int((n > 0).sum()), all_terms + int(n.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *seen.tolist()], pa.int64()), pa.array([with_terms, all_terms, *df[seen].tolist()], pa.int64())], ["term", "n"])

    return docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def impacts(tf: np.ndarray, n: np.ndarray, w: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """w * (10^9 tf div (1000 tf + 12 m)) with m = 75 + 25 n N div L, for each occurrence count."""
    if n.max(initial=0) <= (2**62) // (25 * max(1, n_docs)):
        m = 75 + 25 * n * n_docs // max(1, n_terms)
    else:
        m = np.array([75 + 25 * int(x) * n_docs // max(1, n_terms) for x in n], np.int64)
    return w * (1_000_000_000 * tf // (1000 * tf + 12 * m))


class Best:
    """The best documents of one item so far, highest score first, then smallest id, nulls last."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        least = self.score[-1] if len(self.score) == self.top else 1
        at = np.flatnonzero(score >= least)
        if len(at) > self.top:  # those below the block's own last place cannot be among the best
            at = at[score[at] >= np.partition(score[at], len(at) - self.top)[len(at) - self.top]]
        if not len(at):
            return
        score, ids, null = (np.concatenate(x) for x in ((self.score, score[at]), (self.id, ids[at]), (self.null, null[at])))
        order = np.lexsort((ids, null, -score))[: self.top]
        self.score, self.id, self.null = score[order], ids[order], null[order]


def merged_row(item: tuple[np.ndarray, np.ndarray], starts: np.ndarray, doc: np.ndarray, impact: np.ndarray, into: np.ndarray) -> np.ndarray:
    """The item's row of the product: the rows of its terms, times their multiplicity, added up in ``into``."""
    into[:] = 0
    for term, times in zip(*item, strict=True):
        a, b = starts[term], starts[term + 1]
        if a < b:
            into[doc[a:b]] += times * impact[a:b]  # a term has a document once
    return into


def task_best(docs: DataFrame, known, items, weights, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, task, doc_id, score): at most ``top`` rows for each item from each task."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, w = known.value, weights.value
        rows = {k: (np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)) for k, (a, b) in value_once(items).items()}
        best = {k: Best(top) for k in rows}
        for ids, null, n, term, doc, tf in _blocks(batches, place):
            impact = impacts(tf, n[doc], w[term], n_docs, n_terms)
            starts = np.searchsorted(term, np.arange(len(place) + 1))
            into = np.zeros(len(n), np.int64)
            for k, item in rows.items():
                best[k].add(merged_row(item, starts, doc, impact, into), ids, null)
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        for k, b in best.items():
            if len(b.score):
                size = len(b.score)
                yield pa.RecordBatch.from_arrays([pa.array([k] * size, pa.int64()), pa.array([task] * size, pa.int32()), pa.array(b.id, pa.int64(), mask=b.null), pa.array(b.score, pa.int64())], ["item", "task", "doc_id", "score"])

    return docs.mapInArrow(run, "item long, task int, doc_id long, score long")


def _ranked(df: DataFrame, keys: list, top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def item_terms(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", entries: int = ENTRIES) -> tuple[DataFrame, int]:
    """(block, item, item_id, term, times) and the number of blocks; ``item`` is the item's number in its block's broadcast."""
    words = F.regexp_extract_all(ascii_lower(whole_text(text_col)), F.lit(TERM), F.lit(0))
    pairs = written(items.select(F.col(id_col).alias("item_id"), F.explode(words).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times")))
    blocks = max(1, math.ceil(pairs.count() / entries))
    named = F.xxhash64("item_id", F.col("item_id").isNull())
    return pairs.withColumn("block", F.pmod(named, F.lit(blocks)).cast("int")), blocks


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, entries: int = ENTRIES) -> DataFrame:
    """(item_id, rank int, doc_id, score long): each item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    pairs, blocks = item_terms(items, id_col=item_col, text_col=item_text_col, entries=entries)
    out = []
    for block in range(blocks):
        own = pairs.where(F.col("block") == block).orderBy(F.asc_nulls_last("item_id")).select("item_id", F.encode("term", "UTF-8").alias("term"), "times").collect()
        place: dict[bytes, int] = {}
        rows: dict = {}
        for r in own:
            term, times = rows.setdefault(r.item_id, ([], []))
            term.append(place.setdefault(bytes(r.term), len(place)))
            times.append(r.times)
        names = list(rows)
        packed = {k: (np.array(rows[i][0], np.int64).tobytes(), np.array(rows[i][1], np.int64).tobytes()) for k, i in enumerate(names)}
        del own, rows
        known = spark.sparkContext.broadcast(place)
        counts = {r.term: r.n for r in term_counts(plain, known).collect()}  # a number for each term of the block
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        w = np.array([weight(n_docs, counts.get(k, 0)) for k in range(len(place))], np.int64)
        best = task_best(plain, known, spark.sparkContext.broadcast(packed), spark.sparkContext.broadcast(w), n_docs, n_terms, top)
        some = _ranked(best.withColumn("group", F.pmod(F.col("task"), F.lit(GROUPS))), ["item", "group"], top).drop("rank", "group")
        kind = items.schema[item_col].dataType
        number = spark.createDataFrame([(k, i) for k, i in enumerate(names)], f"item long, item_id {kind.simpleString()}")
        ranked = _ranked(some, ["item"], top).join(F.broadcast(number), "item")
        out.append(written(ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")))
        known.unpersist()
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    forget(pairs)
    return found


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spread(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return search(documents(spark, sf_dir).select("doc_id", "text"), items.select("item_id", "text"))


def _text_terms(table: str, key: str) -> str:
    return f"SELECT {key}, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM {table}"


OP13_SQL = f"""
WITH words AS ({_text_terms("documents", "doc_id")}),
totals AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_terms FROM words),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
asked AS (SELECT item_id, term, count(*) AS times FROM ({_text_terms("benchmark", "item_id")}) GROUP BY item_id, term),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS impact
  FROM tfs JOIN weights USING (term) JOIN lengths USING (doc_id), totals),
scores AS (
  SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
