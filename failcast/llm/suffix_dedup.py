"""Remove strings that a document with a smaller id has too: distributed prefix doubling.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document
with a smaller id. Spark sorts positions by the names of 16, 32 and ``length`` bytes there, and
what only one document has leaves after each round.

Ranking every position of a corpus would move many times the corpus, so the first round
runs on a sparse sample that loses nothing: in every string of ``length`` bytes the ``GRAM``-byte
prefix with the least name, leftmost of equals, is its anchor, and equal strings have equal
anchors at equal places. Round one sorts the anchors by their 16 bytes. Round two doubles them:
every string around an anchor has the 16 bytes after it or those before it whole, so anchors
are sorted by the 32 bytes to either side, each standing for the strings that hold these. In
the last round the strings of what is left go where their 32 bytes lead, are sorted by
document and compared at the full length. Names are hashes; two alike by chance
only send a few more strings on, for in the last round the bytes themselves are compared.

Copies of a whole text are settled first, by digest. Of equal anchors or equal strings that
meet in one batch only one travels on, so a passage in a third of all documents sends a row
for each batch, not for each document. Anchors with over ``HOT`` occurrences, whose strings
would still meet in one task, are ranked at the full length at once: each of their windows
goes where its own name leads. Round two keeps, besides a batch, only the names of one
anchor's different strings, so of ``HOT`` strings at most.

Defined cases: a null text is empty; a text shorter than ``length`` loses nothing; rows that
repeat an id do not count against each other; a null id is smaller than all others; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import documents, forget, free_shuffles, temporary_table, whole_text, written

LENGTH = 50
GRAM = 16
#: Bytes that a task works on at once, and windows of one document at once.
BATCH_BYTES = 1_000_000
PIECE = 1_000_000
#: Occurrences of an anchor above which its windows are dealt by their own names.
HOT = 50_000
#: So many hot names may be broadcast (8 bytes each); more are joined.
BROADCAST_NAMES = 100_000
#: Strings compared at once.
COMPARED = 4_000
MARKER = -1
_PLACE = 24
_M = np.uint64(0x9E3779B97F4A7C15)


def names(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit names of the ``length`` bytes at every position (of what follows the end too: never used)."""
    name, k = data.astype(np.uint64) + np.uint64(1), 1
    with np.errstate(over="ignore"):
        while k < length:
            offset = min(k, length - k)
            pair = (name ^ (name >> np.uint64(32))) * _M + np.uint64(2 * k + 1)
            pair[: len(name) - offset] += name[offset:] * np.uint64(0xD6E8FEB86659FD93)
            name = pair ^ (pair >> np.uint64(29))
            k += offset
    return name


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column."""
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _pieces(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (row, first byte, last byte) of bounded size; long rows come in overlapping pieces."""
    group, size = [], 0
    for row in range(len(offsets) - 1):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while end - at >= length:
            stop = min(end, at + PIECE + length - 1)
            group.append((row, at, stop))
            size += stop - at
            if size >= BATCH_BYTES:
                yield group
                group, size = [], 0
            if stop == end:
                break
            at += PIECE
    if group:
        yield group


def anchors_of(data: np.ndarray, group: list[tuple[int, int, int]], length: int) -> tuple[np.ndarray, ...]:
    """Of a group: name, row, first window, number of windows and place of every anchor."""
    parts = [data[a:b] for _, a, b in group]
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size) - size
    joined = np.concatenate(parts)
    name = names(joined, GRAM)
    order = (name >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(joined), dtype=np.uint64)
    runs, done = order, 1
    while done < length - GRAM + 1:
        step = min(done, length - GRAM + 1 - done)
        runs = np.minimum(runs[:-step], runs[step:])
        done += step
    which = np.repeat(np.arange(len(parts)), size)[: len(runs)]
    inside = np.arange(len(runs)) - begin[which] <= size[which] - length
    window = np.flatnonzero(inside[: len(runs)])
    place = (runs[window] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (np.diff(window) != 1))))
    first, n = window[new], np.diff(np.concatenate((new, [len(window)])))
    part = which[first]
    rows = np.array([g[0] for g in group])[part]
    shift = np.array([g[1] for g in group])[part]
    return name[place[new]], rows, first - begin[part] + shift, n, place[new] - begin[part] + shift


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal keys, and each row's run."""
    new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1


ANCHORS = "name long, uid long, at long, weight int"


def _leading(name: np.ndarray, uid: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Rows of ``ANCHORS``. Of a name that several documents of a batch have, one row goes where it leads.

    That has their number as weight; the others have weight 0 and go anywhere. Names of one document
    have weight 1. Names are cut to 48 bits here.
    """
    name = (name >> np.uint64(16)).view(np.int64)
    order = np.lexsort((uid, name))
    name, uid, at = name[order], uid[order], at[order]
    start, run = _groups(name)
    stop = np.concatenate((start[1:], [len(name)])) - 1
    known = (uid[start] != uid[stop])[run]
    weight = np.where(known, 0, 1).astype(np.int32)
    weight[start] = np.where(known[start], stop - start + 1, 1)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (name, uid, at, weight)], ["name", "uid", "at", "weight"])


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """(uid, data) -> anchors with their windows: ``at`` holds the first, their number and how far the anchor is from the first."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("data"))
            ids = batch.column("uid").to_numpy()
            for group in _pieces(offsets, length):
                name, row, first, n, place = anchors_of(data, group, length)
                yield _leading(name, ids[row], ((first - offsets[row]) * 64 + n) * 64 + place - first)

    return texts.select("uid", "data").mapInArrow(find, ANCHORS)


def names_at(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """64-bit names of the 2 * ``GRAM`` bytes at some places."""
    words = data[place[:, None] + np.arange(2 * GRAM)].view(np.uint64)
    name = np.zeros(len(place), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words.shape[1]):
            name = (name ^ words[:, k]) * _M
            name ^= name >> np.uint64(29)
    return name


def doubled(texts: DataFrame, length: int) -> DataFrame:
    """(uid, data, at array) -> rows of ``ANCHORS`` for the 32 bytes from each anchor on and for those up to its end.

    The first stand for the windows that hold them, the second for the rest; ``at`` holds the first window and their number.
    """
    reach = length - 2 * GRAM  # from a window's start to the last anchor whose next 16 bytes are inside

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("data"))
            ids, lists = batch.column("uid").to_numpy(), batch.column("at")
            every = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            many = max(1, BATCH_BYTES // (4 * GRAM))
            for low in range(0, len(every), many):
                at, row = every[low : low + many], owner[low : low + many]
                first, n = at >> 12, (at >> 6) & 63
                place = first + (at & 63)
                turn = np.clip(place - reach, first, first + n)  # the first window that holds the next 16 bytes
                out = []
                for side, begin, end, start in ((0, turn, first + n, place), (1, first, turn, place - GRAM)):
                    some = np.flatnonzero(end > begin)
                    name = names_at(data, offsets[row[some]] + start[some])
                    out.append((name if not side else ~name, ids[row[some]], begin[some] * 64 + (end - begin)[some]))
                yield _leading(*(np.concatenate(x) for x in zip(*out, strict=True)))

    return texts.select("uid", "data", "at").mapInArrow(find, ANCHORS)


def shared_anchors(found: DataFrame, parts: int) -> DataFrame:
    """(uid, at, name) of the anchors that at least two documents have; for a name with over ``HOT`` a row of uid ``MARKER`` too."""
    most = HOT

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None  # of the last name, all of one document so far
        passed, total = None, 0  # the last name, if two documents have it, and its occurrences so far
        for batch in batches:
            name, uid, at, weight = (batch.column(c).to_numpy() for c in ("name", "uid", "at", "weight"))
            astray = weight == 0
            sent = [(uid[astray], at[astray], name[astray])]
            name, uid, at, weight = name[~astray], uid[~astray], at[~astray], weight[~astray]
            if held is not None:
                name, uid, at, weight = (np.concatenate((a, b)) for a, b in zip(held, (name, uid, at, weight), strict=True))
                held = None
            if len(name):
                start, run = _groups(name)
                low, high = np.minimum.reduceat(uid, start), np.maximum.reduceat(uid, start)
                goes_on = name[start] == passed if passed is not None else np.zeros(len(start), bool)
                shared = (low != high) | (np.maximum.reduceat(weight, start) > 1) | goes_on
                sent.append(tuple(x[shared[run]] for x in (uid, at, name)))
                before = np.where(goes_on, total, 0)
                counts = np.add.reduceat(weight.astype(np.int64), start) + before
                hot = name[start][shared & (counts > most) & (before <= most)]
                sent.append((np.full(len(hot), MARKER), np.zeros(len(hot), np.int64), hot))
                passed, total = (int(name[-1]), int(counts[-1])) if shared[-1] else (None, 0)
                if not shared[-1]:
                    held = tuple(x[start[-1] :] for x in (name, uid, at, weight))
            uid, at, name = (np.concatenate(x) for x in zip(*sent, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(at), pa.array(name)], ["uid", "at", "name"])

    route = F.when(F.col("weight") == 0, F.xxhash64("uid", "at")).otherwise(F.col("name"))
    return found.repartition(parts, route).sortWithinPartitions("name", "uid").mapInArrow(keep, "uid long, at long, name long")


def marked_hot(shared: DataFrame) -> DataFrame:
    """``shared`` without its markers, with ``hot``."""
    rows = shared.where(F.col("uid") != MARKER)
    names_ = written(shared.where(F.col("uid") == MARKER).select(F.col("name").alias("hot_name")))
    n = names_.count()
    if not n:
        return rows.withColumn("hot", F.lit(False))
    side = F.broadcast(names_) if n <= BROADCAST_NAMES else names_
    return rows.join(side, F.col("name") == F.col("hot_name"), "left").withColumn("hot", F.col("hot_name").isNotNull()).drop("hot_name")


STRINGS = "name long, key long, uid long, at long, data binary"


def strings(texts: DataFrame, length: int) -> DataFrame:
    """(uid, key, data, at array, name array, hot array) -> the strings around the anchors; of hot ones each window by itself.

    Of equal strings in a batch only the smallest document's travels with its bytes; all
    windows of the others are known to repeat (data null).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("data"))
            ids, keys = batch.column("uid").to_numpy(), batch.column("key").to_numpy()
            lists = batch.column("at")
            at, name = lists.flatten().to_numpy(), batch.column("name").flatten().to_numpy()
            hot = batch.column("hot").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            many = np.where(hot, at % 64, 1)
            own = np.repeat(np.arange(len(at)), many)
            step = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
            at, name, row, hot = np.where(hot[own], (at[own] // 64 + step) * 64 + 1, at[own]), name[own], row[own], hot[own]
            first, size = offsets[row] + at // 64, at % 64 + length - 1
            many_at_once = max(1, BATCH_BYTES // (2 * length))
            for low in range(0, len(at), many_at_once):
                part = slice(low, low + many_at_once)
                f, s = first[part], size[part]
                begin = np.cumsum(s) - s
                joined = data[np.repeat(f - begin, s) + np.arange(int(s.sum()))]
                # The windows of a string: named alike if and only if the strings are alike.
                whole = names(joined, length)
                mark = whole[begin] ^ (whole[begin + s - length] * _M)
                order = np.lexsort((keys[row[part]], s, mark))
                start, run = _groups(mark[order])
                cut = np.flatnonzero(np.diff(s[order])) + 1  # names of different sizes may agree
                start = np.union1d(start, cut)
                run = np.searchsorted(start, np.arange(len(s)), "right") - 1
                k = keys[row[part]][order]
                again = k > k[start][run]
                repeat = np.zeros(len(s), bool)
                repeat[order] = again
                holder = np.empty(len(s), np.int64)
                holder[order] = order[start][run]
                some = np.flatnonzero(repeat)
                if len(some):  # strings of one name are of one size
                    size_, at_ = s[some], np.cumsum(s[some]) - s[some]
                    inner = np.arange(int(size_.sum())) - np.repeat(at_, size_)
                    differ = joined[np.repeat(begin[some], size_) + inner] != joined[np.repeat(begin[holder[some]], size_) + inner]
                    repeat[some[np.add.reduceat(differ, at_) > 0]] = False
                where = np.concatenate((begin, [len(joined)])).astype(np.int32)
                payload = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(where), pa.py_buffer(joined)])
                payload = pa.compute.if_else(pa.array(repeat), pa.scalar(None, pa.binary()), payload)
                u, a, n = ids[row[part]], at[part], np.where(hot[part], whole[begin].view(np.int64), name[part])
                yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(keys[row[part]]), pa.array(u), pa.array(a), payload], [x.split()[0] for x in STRINGS.split(", ")])

    return texts.select("uid", "key", "data", "at", "name", "hot").mapInArrow(cut, STRINGS)


def _least_holders(name: np.ndarray, key: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Of windows in order of key: the first with the same bytes. Names only say where to look."""
    _, first, inverse = np.unique(name, return_index=True, return_inverse=True)
    holder = first[inverse]
    if (windows != windows[holder]).any():  # different bytes of one name
        _, first, inverse = np.unique(np.ascontiguousarray(windows).view(f"V{windows.shape[1]}").ravel(), return_index=True, return_inverse=True)
        holder = first[inverse]
    return holder


def repeated_spans(found: DataFrame, length: int, parts: int, name_of=names) -> DataFrame:
    """(uid, begin, end): byte ranges to remove; they may overlap."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: int | None = None  # the name whose strings may go on in the next batch; of its different windows name, least key and bytes
        seen, seen_key, seen_bytes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, length), np.uint8)

        def spans(uid: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(begin), pa.array(end)], ["uid", "begin", "end"])

        for whole in batches:
            lost = whole.column("data").is_null().to_numpy(zero_copy_only=False)
            uid, at = whole.column("uid").to_numpy(), whole.column("at").to_numpy()
            if lost.any():
                yield spans(uid[lost], at[lost] // 64, at[lost] // 64 + at[lost] % 64 + length - 1)
            whole = whole.filter(pa.array(~lost))
            for low in range(0, len(whole), COMPARED):
                batch = whole.slice(low, COMPARED)
                data, offsets = _binary(batch.column("data"))
                name, key, uid, at = (batch.column(c).to_numpy() for c in ("name", "key", "uid", "at"))
                n = at % 64
                owner = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                place = offsets[:-1][owner] - offsets[0] + step
                data = data[offsets[0] : offsets[-1]]
                own = name_of(data, length)[place]
                if last is None or last != int(name[0]):
                    seen, seen_key, seen_bytes = seen[:0], seen_key[:0], seen_bytes[:0]
                every, every_key = np.concatenate((seen, own)), np.concatenate((seen_key, key[owner]))
                windows = np.concatenate((seen_bytes, data[place[:, None] + np.arange(length)]))
                # Rows come in order of key, so the first of equal windows has the least key.
                holder = _least_holders(every, every_key, windows)
                gone = (every_key[holder] < every_key)[len(seen) :]
                goes_on = int(name[0]) == last
                last = int(name[-1])
                tail = np.concatenate((np.full(len(seen), goes_on and int(name[0]) == last), name[owner] == last))
                stay = np.flatnonzero(tail & (holder == np.arange(len(holder))))
                seen, seen_key, seen_bytes = every[stay], every_key[stay], windows[stay]
                hit = np.flatnonzero(gone)
                if len(hit):
                    new = np.concatenate(([True], (np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)))
                    a = np.flatnonzero(new)
                    b = np.concatenate((a[1:], [len(hit)])) - 1
                    o = owner[hit[a]]
                    start = at[o] // 64 + step[hit[a]]
                    yield spans(uid[o], start, start + (hit[b] - hit[a]) + length)

    route = F.when(F.col("data").isNull(), F.xxhash64("uid", "at")).otherwise(F.col("name"))
    return found.repartition(parts, route).sortWithinPartitions("name", "key").mapInArrow(compare, "uid long, begin long, end long")


def _settled():
    """Merge a document's ranges and take them out of its bytes."""

    @F.pandas_udf("struct<n_removed long, n_spans long, kept binary>")
    def apply(data: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for raw, own in zip(data, spans, strict=True):
            if raw is None or own is None:
                out.append((0, 0, None))
                continue
            raw, kept, at, removed, n = bytes(raw), [], 0, 0, 0
            begin = end = None
            for s in sorted((int(x["begin"]), int(x["end"])) for x in own):
                if end is None or s[0] > end:
                    if end is not None:
                        kept.append(raw[at:begin])
                        at, removed, n = end, removed + end - begin, n + 1
                    begin, end = s
                else:
                    end = max(end, s[1])
            kept += [raw[at:begin], raw[end:]]
            out.append((removed + end - begin, n + 1, b"".join(kept)))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept"])

    return apply


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans long, kept binary): one row for each row of ``docs``."""
    if not GRAM < length <= GRAM + 47:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + 47}")
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = temporary_table("texts")
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key"), text.cast("binary").alias("data"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("t"), text).alias("h2"))
    # Bucketed by row, so that what is found out about a text meets it again without moving it.
    rows.withColumn("uid", F.monotonically_increasing_id()).repartition(parts, "uid").write.bucketBy(parts, "uid").option("compression", "zstd").saveAsTable(table)
    free_shuffles(spark)
    texts = spark.table(table)
    firsts = texts.groupBy("h1", "h2").agg(F.min("key").alias("least"))
    copies = written(texts.select("uid", "key", "h1", "h2").join(firsts, ["h1", "h2"]).where("key > least").select(F.col("uid").alias("copy")))
    own = texts.join(copies, texts["uid"] == F.col("copy"), "left_anti").where(F.octet_length("data") >= length)
    shared = written(shared_anchors(anchors(own, length), parts))
    free_shuffles(spark)
    if length >= 3 * GRAM - 1:  # else a window may have neither the 16 bytes before its anchor nor those after it
        lists = shared.where(F.col("uid") != MARKER).groupBy("uid").agg(F.collect_list("at").alias("at")).select(F.col("uid").alias("of"), "at")
        again = written(shared_anchors(doubled(texts.select("uid", "data").join(lists, F.col("uid") == F.col("of")), length), parts))
        free_shuffles(spark)
        forget(shared)
        shared = again
    else:
        shared = shared.withColumn("at", F.shiftright("at", 6))
    gathered = marked_hot(shared).groupBy("uid").agg(F.collect_list(F.struct("at", "name", "hot")).alias("x"))
    listed = gathered.select(F.col("uid").alias("of"), F.col("x.at").alias("at"), F.col("x.name").alias("name"), F.col("x.hot").alias("hot"))
    joined = texts.select("uid", "key", "data").join(listed, F.col("uid") == F.col("of"))
    spans = written(repeated_spans(strings(joined, length), length, parts))
    free_shuffles(spark)
    forget(shared)
    per_row = spans.groupBy(F.col("uid").alias("of")).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    out = texts.select("uid", "doc_id", "data").join(per_row, F.col("uid") == F.col("of"), "left").join(copies, F.col("uid") == F.col("copy"), "left")
    n = F.octet_length("data").cast("long")
    all_gone = F.col("copy").isNotNull() & (n >= length)
    out = out.withColumn("s", _settled()(F.when(F.col("spans").isNotNull(), F.col("data")), F.col("spans")))
    return out.select(
        "doc_id",
        n.alias("n_bytes"),
        F.when(all_gone, n).otherwise(F.col("s.n_removed")).alias("n_removed"),
        F.when(all_gone, F.lit(1)).otherwise(F.col("s.n_spans")).cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(b"")).otherwise(F.coalesce("s.kept", "data")).alias("kept"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n
  FROM documents),
w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
least_holder AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
hit AS (SELECT doc_id, i FROM w JOIN least_holder USING (s) WHERE m < doc_id),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM hit),
runs AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, run, min(i) AS b, max(i) + 50 AS e FROM runs GROUP BY doc_id, run),
parts AS (
  SELECT doc_id, b AS place, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS a, b AS z FROM spans
  UNION ALL
  SELECT d.doc_id, n + 1, coalesce(max(e), 0), n FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id, n),
kept AS (
  SELECT doc_id, coalesce(string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY place), '') AS k
  FROM parts JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(e - b)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) JOIN kept USING (doc_id)
"""
