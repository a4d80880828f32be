"""Reversible line de-duplication: sharded cuckoo filters over exact reference counts.

State is two tables. *Postings* hold each (line key, document) once and are the exact
truth: inserting documents adds rows, deleting documents removes rows, and reference
counts and keepers follow from them. *Filters* hold one cuckoo filter for each shard of
the key space, with the fingerprints of the keys that are frequent now; keys that become
frequent are inserted, keys that cease to be frequent are deleted. A filter over ``FULL`` of its
places is built again, larger, from the exact table. Lookups go to the filters
first, where the postings lie, and only survivors move to the exact table; filters beyond ``BROADCAST_BYTES``
are joined to postings by shard instead.

``Store`` keeps both in a folder as a log of batches, so that batches of documents can come
and go in later sessions.

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars``
code points are never dropped; rows that repeat a ``doc_id`` are one document and each
gives its own result row; all rows with a null ``doc_id`` are one document that comes before
all others; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import WHITE_SPACE, ascii_lower, hot_join, small_side, whole_text, written

SLOTS = 4
MAX_KICKS = 500
FULL = 0.9
#: Keys in one filter, postings in one probing task.
SHARD_KEYS = 200_000
PROBE_ROWS = 100_000
BROADCAST_SHARDS = 100_000
#: Of all filters together.
BROADCAST_BYTES = 64 << 20
#: Documents whose lost keys (16 bytes each) may be broadcast.
BROADCAST_LINES = 100_000
BROADCAST_DOCS = 200_000
#: Rows without an id are dealt by their text to so many groups.
NULL_GROUPS = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; what finds no place goes to an exact stash."""

    def __init__(self, table: np.ndarray, stash: set[int]):
        self.table, self.stash = table, stash
        self.mask = len(table) - 1

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        buckets = 1 << max(2, math.ceil(math.log2(max(1, n) / (SLOTS * 0.8))))
        return cls(np.zeros((buckets, SLOTS), np.uint16), set())

    @classmethod
    def load(cls, table: bytes, stash: bytes) -> CuckooFilter:
        return cls(np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy(), set(np.frombuffer(stash, np.int64).tolist()))

    def dump(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), np.array(sorted(self.stash), np.int64).tobytes()

    def load_share(self) -> float:
        """Taken places, with what found none, by the number of places."""
        return (np.count_nonzero(self.table) + len(self.stash)) / self.table.size

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of 64-bit keys."""
        h = _mix(np.asarray(keys, np.int64).view(np.uint64))
        prints = (h >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (h & np.uint64(self.mask)).astype(np.int64)
        return prints, first, first ^ self._jump(prints)

    def _jump(self, prints: np.ndarray) -> np.ndarray:
        return (_mix(prints) & np.uint64(self.mask)).astype(np.int64)

    def insert(self, keys: np.ndarray) -> None:
        table = self.table
        jumps: dict[int, int] = {}
        for key, f, a, b in zip(np.asarray(keys, np.int64).tolist(), *(x.tolist() for x in self.places(keys)), strict=True):
            moves: list[tuple[int, int]] = []
            at = a if (table[a] == 0).any() else b
            for kick in range(MAX_KICKS):
                free = np.flatnonzero(table[at] == 0)
                if len(free):
                    table[at, free[0]] = f
                    break
                slot = (kick * 7 + f) % SLOTS
                f, table[at, slot] = int(table[at, slot]), f
                moves.append((at, slot))
                if f not in jumps:
                    jumps[f] = int(self._jump(np.array([f], np.uint16))[0])
                at ^= jumps[f]
            else:  # undo the moves, so that every other key keeps its place
                for at, slot in reversed(moves):
                    f, table[at, slot] = int(table[at, slot]), f
                self.stash.add(key)

    def delete(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted before."""
        for key, f, a, b in zip(np.asarray(keys, np.int64).tolist(), *(x.tolist() for x in self.places(keys)), strict=True):
            if key in self.stash:
                self.stash.remove(key)
                continue
            for at in (a, b):
                found = np.flatnonzero(self.table[at] == f)
                if len(found):
                    self.table[at, found[0]] = 0
                    break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        f, a, b = self.places(keys)
        found = (self.table[a] == f[:, None]).any(1) | (self.table[b] == f[:, None]).any(1)
        return found | np.isin(np.asarray(keys, np.int64), np.array(sorted(self.stash), np.int64)) if self.stash else found


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE_SPACE)))


def key_hash(key: Column) -> Column:
    """128 bits that stand for the key."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def _group(id_: Column, text: Column) -> Column:
    """0, or the group of a row without an id."""
    return F.when(id_.isNull(), F.pmod(F.xxhash64(text), F.lit(NULL_GROUPS)).cast("int")).otherwise(0)


def postings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40) -> DataFrame:
    """(h1, h2, doc_id, part): every long line key with each document that holds it, once (of null ids once for each group)."""
    keys = F.filter(F.transform(F.split(whole_text(text_col), "\n"), line_key), lambda k: F.char_length(k) >= min_chars)
    found = docs.select(F.col(id_col).alias("doc_id"), _group(F.col(id_col), whole_text(text_col)).alias("part"), F.explode(F.array_distinct(F.transform(keys, key_hash))).alias("k"))
    return found.select("k.h1", "k.h2", "doc_id", "part").distinct()


def insert_documents(state: DataFrame, new: DataFrame) -> DataFrame:
    """Postings after documents came in."""
    return state.unionByName(new).distinct()


def delete_documents(state: DataFrame, ids: DataFrame) -> DataFrame:
    """Postings after the documents in ``ids`` (doc_id) went; the inverse of inserting them."""
    gone = ids.select(F.col("doc_id").alias("gone")).distinct()
    return state.join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti")


def reference_counts(state: DataFrame) -> DataFrame:
    """(h1, h2, refs, keeper): in how many documents a key is, and the largest of them."""
    return state.groupBy("h1", "h2").agg((F.count("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("refs"), F.max("doc_id").alias("keeper"))


def _shard(n: int) -> Column:
    return F.pmod(F.shiftrightunsigned("h2", 7), F.lit(n)).cast("int")


FILTERS = "shard int, slots binary, stash binary, share double"


def _row_of(made: CuckooFilter, shard: int) -> pd.DataFrame:
    slots, stash = made.dump()
    return pd.DataFrame({"shard": [shard], "slots": [slots], "stash": [stash], "share": [made.load_share()]})


def build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """One cuckoo filter for each shard of the frequent keys."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.sized(len(pdf))
        made.insert(pdf["h1"].to_numpy())
        return _row_of(made, int(pdf["shard"].iloc[0]))

    return frequent.select("h1", _shard(shards).alias("shard")).groupBy("shard").applyInPandas(build, FILTERS)


def update_filters(filters: DataFrame, became: DataFrame, ceased: DataFrame, shards: int, frequent: DataFrame | None = None) -> DataFrame:
    """Filters after some keys became frequent and others ceased to be (h1, h2 of each).

    With ``frequent``, the keys as they are now, a filter that is over ``FULL`` is built again from them.
    """
    changes = became.select("h1", _shard(shards).alias("shard"), F.lit(True).alias("add")).unionByName(ceased.select("h1", _shard(shards).alias("shard"), F.lit(False).alias("add")))

    def update(old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
        add, gone = change.loc[change["add"], "h1"].to_numpy(), change.loc[~change["add"], "h1"].to_numpy()
        made = CuckooFilter.load(old["slots"].iloc[0], old["stash"].iloc[0]) if len(old) else CuckooFilter.sized(len(add))
        made.delete(gone)
        if made.load_share() + len(add) / made.table.size <= FULL or not rebuilds:
            made.insert(add)
            return _row_of(made, int((old if len(old) else change)["shard"].iloc[0]))
        slots, stash = made.dump()
        return pd.DataFrame({"shard": [int(old["shard"].iloc[0] if len(old) else change["shard"].iloc[0])], "slots": [slots], "stash": [stash], "share": [2.0]})

    rebuilds = frequent is not None
    new = filters.select("shard", "slots", "stash").groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, FILTERS)
    if frequent is None:
        return new
    new = written(new)
    full = new.where("share > 1").select(F.col("shard").alias("full"))
    again = frequent.withColumn("shard", _shard(shards)).join(full, F.col("shard") == F.col("full"), "left_semi")
    return new.where("share <= 1").unionByName(build_filters(again, shards))


def probe(state: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Postings whose key may be frequent."""
    size = filters.agg(F.coalesce(F.sum(F.octet_length("slots") + F.octet_length("stash")), F.lit(0))).first()[0]
    return (_probe_in_place if size <= BROADCAST_BYTES else _probe_by_shard)(state, filters, shards)


def _probe_in_place(state: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Every task has all filters, ``BROADCAST_BYTES`` at most; postings do not move."""
    held = state.sparkSession.sparkContext.broadcast({r.shard: (bytes(r.slots), bytes(r.stash)) for r in filters.select("shard", "slots", "stash").collect()})

    @F.pandas_udf("boolean")
    def known(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        made = {shard: CuckooFilter.load(*x) for shard, x in held.value.items()}
        for shard, h1 in batches:
            keys, out = h1.to_numpy(), np.zeros(len(h1), bool)
            for s, own in pd.Series(np.arange(len(keys))).groupby(shard.to_numpy()):
                if s in made:
                    out[own.to_numpy()] = made[s].contains(keys[own.to_numpy()])
            yield pd.Series(out)

    return state.where(known(_shard(shards), F.col("h1")))


def _probe_by_shard(state: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Postings meet their shard's filter; a shard with many postings is split, its filter copied to each part."""
    # pandas would turn whole numbers beside a null into floats
    dealt = state.select("h1", "h2", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "part", _shard(shards).alias("shard"))
    deals = dealt.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(PROBE_ROWS)).cast("int").alias("deals"))
    # One row for each shard: broadcast while these are few, or all postings would meet by shard.
    deals = F.broadcast(deals) if shards <= BROADCAST_SHARDS else deals
    left = dealt.join(deals, "shard").withColumn("deal", F.pmod(F.xxhash64("doc_id", "part", "h1"), F.col("deals")).cast("int")).drop("deals")
    right = filters.select("shard", "slots", "stash").join(deals, "shard").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")

    def look(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        wanted = ["h1", "h2", "doc_id", "no_id", "part"]
        if not len(known) or not len(rows):
            return rows.iloc[:0][wanted]
        found = CuckooFilter.load(known["slots"].iloc[0], known["stash"].iloc[0]).contains(rows["h1"].to_numpy())
        return rows.loc[found, wanted]

    found = left.groupBy("shard", "deal").cogroup(right.groupBy("shard", "deal")).applyInPandas(look, "h1 long, h2 long, doc_id long, no_id boolean, part int")
    return found.select("h1", "h2", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "part")


def _lost(maybe: DataFrame, frequent: DataFrame) -> DataFrame:
    """(__gone_id, __gone_part, __gone): the keys that a document loses, by postings that may be frequent and the exact table."""
    # Very many documents may have one line.
    keys = ["h1", "h2"]
    found = maybe.join(F.broadcast(frequent), keys) if frequent.count() <= BROADCAST_LINES else hot_join(written(maybe), frequent, keys)
    sure = found.where(F.col("doc_id").isNull() & F.col("keeper").isNotNull() | (F.col("doc_id") < F.col("keeper")))
    return sure.groupBy(F.col("doc_id").alias("__gone_id"), F.col("part").alias("__gone_part")).agg(F.collect_list(F.struct("h1", "h2")).alias("__gone"))


def dropped_lines(state: DataFrame, *, min_docs: int = 5) -> DataFrame:
    """(__gone_id, __gone_part, __gone): the keys that a document loses."""
    frequent = written(reference_counts(state).where(F.col("refs") >= min_docs))
    shards = max(1, math.ceil(frequent.count() / SHARD_KEYS))
    return _lost(probe(state, written(build_filters(frequent, shards)), shards), frequent)


def _without(docs: DataFrame, gone: DataFrame, *, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    lines = F.split(whole_text(text_col), "\n")

    def stays(line: Column) -> Column:
        key = line_key(line)
        return (F.char_length(key) < min_chars) | ~F.array_contains(F.col("__gone"), key_hash(key))

    kept = F.when(F.col("__gone").isNull(), lines).otherwise(F.filter(lines, stays))
    same = F.col(id_col).eqNullSafe(F.col("__gone_id")) & (F.col("__part") == F.col("__gone_part"))
    # Texts move only if the documents that lose lines are many.
    side = small_side(written(gone), BROADCAST_DOCS)
    joined = docs.withColumn("__part", _group(F.col(id_col), whole_text(text_col))).join(side, same, "left")
    return (
        joined.withColumn("__kept", kept)
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", F.col("n_lines") - F.size("__kept"))
        .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join("__kept", "\n")))
        .drop("__kept", "__gone", "__gone_id", "__gone_part", "__part")
    )


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with its text less the repeated lines, and ``n_lines``, ``n_dropped`` long (in place of columns so named)."""
    ship(docs.sparkSession)
    state = written(postings(docs, id_col=id_col, text_col=text_col, min_chars=min_chars))
    return _without(docs, dropped_lines(state, min_docs=min_docs), id_col=id_col, text_col=text_col, min_chars=min_chars)


class Store:
    """Line dedup's state in a folder: a log of posting batches and, for each, the filters after it.

    A batch is a folder ``batch=N`` with rows of sign 1 (came) or -1 (went). A version counts
    once its filters are written, last, so a batch that was cut off is as if it had never begun. A batch only
    moves its own rows, its keys and the postings of these. After every ``compact_every`` batches the postings that
    are left are written together, in a folder for each shard of keys, so reading the state takes one such version and
    the few batches since, however long the log is.
    """

    def __init__(self, spark: SparkSession, path: str, *, min_chars: int = 40, min_docs: int = 5, shards: int = 64, compact_every: int = 16):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every
        self.min_chars, self.min_docs, self.shards = min_chars, min_docs, shards

    def _whole(self, kind: str) -> list[int]:
        """Versions of a kind that were written to their end."""
        jvm = self.spark._jvm
        found = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/version=*/_SUCCESS")
        done = found.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(found)
        return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in done)

    def version(self) -> int:
        """Of the last whole batch; -1 if there is none."""
        return max(self._whole("filters"), default=-1)

    def _log(self, to: int) -> DataFrame:
        """Signed postings: those of the last compacted version up to ``to`` and of the batches since."""
        base = max((v for v in self._whole("compacted") if v <= to), default=-1)
        parts = [self.spark.read.parquet(f"{self.path}/compacted/version={base}").select("h1", "h2", "doc_id", "part", F.lit(1).alias("sign"))] if base >= 0 else []
        if base < to:
            parts.append(self.spark.read.parquet(*[f"{self.path}/postings/batch={i}" for i in range(base + 1, to + 1)]).select("h1", "h2", "doc_id", "part", "sign"))
        return reduce(DataFrame.unionByName, parts)

    def postings(self) -> DataFrame:
        """The postings now."""
        n = self.version()
        if n < 0:
            return self.spark.createDataFrame([], "h1 long, h2 long, doc_id long, part int")
        return self._log(n).groupBy("h1", "h2", "doc_id", "part").agg(F.sum("sign").alias("sign")).where("sign > 0").drop("sign")

    def compact(self) -> None:
        """Write the postings now as one version, by shards of keys."""
        n = self.version()
        if n >= 0:
            self.postings().withColumn("shard", _shard(self.shards)).repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{self.path}/compacted/version={n}")

    def filters(self) -> DataFrame:
        n = self.version()
        return self.spark.read.parquet(f"{self.path}/filters/version={n}") if n >= 0 else self.spark.createDataFrame([], FILTERS)

    def _apply(self, changes: DataFrame) -> None:
        """Append rows with their sign and bring the filters up to date."""
        before, old, n = self.postings(), self.filters(), self.version() + 1
        changes.write.mode("overwrite").parquet(f"{self.path}/postings/batch={n}")
        changes = self.spark.read.parquet(f"{self.path}/postings/batch={n}")
        keys = changes.select("h1", "h2").distinct()
        was = before.join(keys, ["h1", "h2"], "left_semi")
        now = was.withColumn("sign", F.lit(1)).unionByName(changes).groupBy("h1", "h2", "doc_id", "part").agg(F.sum("sign").alias("sign")).where("sign > 0")
        enough = F.col("refs") >= self.min_docs
        was, now = written(reference_counts(was).where(enough)), written(reference_counts(now).where(enough))
        became, ceased = now.join(was, ["h1", "h2"], "left_anti"), was.join(now, ["h1", "h2"], "left_anti")
        rest = reference_counts(before.join(keys, ["h1", "h2"], "left_anti")).where(enough)
        made = update_filters(old, became, ceased, self.shards, now.unionByName(rest))
        made.write.mode("overwrite").parquet(f"{self.path}/filters/version={n}")
        if (n + 1) % self.compact_every == 0:
            self.compact()

    def insert(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Documents come in; what is there already stays as it is."""
        new = postings(docs, id_col=id_col, text_col=text_col, min_chars=self.min_chars)
        held = self.postings().select(*[F.col(c).alias(f"__{c}") for c in new.columns])
        same = F.lit(True)
        for c in new.columns:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        self._apply(new.join(held, same, "left_anti").withColumn("sign", F.lit(1)))

    def delete(self, ids: DataFrame) -> None:
        """The documents in ``ids`` (doc_id) go: the inverse of inserting them."""
        held = self.postings()
        gone = ids.select(F.col("doc_id").alias("gone")).distinct()
        self._apply(held.join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi").withColumn("sign", F.lit(-1)))

    def dedup(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs``, which were inserted, less the lines that the store has too often."""
        own = postings(docs, id_col=id_col, text_col=text_col, min_chars=self.min_chars)
        maybe = written(probe(own, self.filters(), self.shards))
        wanted = self.postings().join(maybe.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
        gone = _lost(maybe, written(reference_counts(wanted).where(F.col("refs") >= self.min_docs)))
        return _without(docs, gone, id_col=id_col, text_col=text_col, min_chars=self.min_chars)


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    from failcast.llm.common import documents

    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(whole_text("text"), 256).alias("kept_sha256"))


OP10_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.doc_id, i, line, coalesce(keyed.doc_id <> keeper, false) AS gone
  FROM keyed LEFT JOIN frequent ON keyed.k = frequent.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
