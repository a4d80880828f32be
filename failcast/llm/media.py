"""Media columns: payloads stored as content-defined chunks, each chunk once.

A media file (8-bit PCM audio with a 44-byte header) is cut where a rolling gear hash of the
last 32 bytes has its top bits zero, between ``LEAST`` and ``MOST`` bytes. A chunk is named by
its digest. Chunks that a store has already are left out by an anti join, and the new
ones are written once each, compressed, to a table bucketed by digest. Chunks are short, so
they are compressed against a dictionary trained here on at most ``SAMPLE`` chunks (a
documented bound) and kept beside a named store. A media row is its
ordered list of digests; reading joins the lists to the store, puts the chunks in order and
checks every chunk's digest and the file's SHA-256 before anything is computed from it.

Digests that very many lists name are joined in salted copies, so no task makes more than
about ``HOT_REFS`` rows of one chunk.

Defined cases: a null text is an empty payload, which is stored as 192 spaces; equal texts
are one media file; rows that repeat an id each give a row; a null id stays; an empty table
gives an empty result; other columns are not read. A missing or damaged chunk raises.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import documents, free_shuffles, hot_keys, temporary_table, whole_text, written

FRAME = 192
LEAST, MOST, CUT_BITS = 1024, 16384, 12
LEVEL = 13
DICTIONARY, SAMPLE = 112 * 1024, 4000
RATE = 8000
HOT_REFS = 20_000
HEADER = 44


def gear_table() -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([i]), 1) for i in range(256)], np.uint32)


def cuts(data: bytes, gear: np.ndarray) -> list[int]:
    """Ends of the chunks."""
    h = gear[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):  # h[i] becomes the sum of gear[data[i - j]] << j over j < 2k
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    marks = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    out, at = [], 0
    while len(data) - at > LEAST:
        k = int(np.searchsorted(marks, at + LEAST))
        end = min(int(marks[k]) if k < len(marks) else len(data), at + MOST, len(data))
        if end == len(data):
            break
        out.append(end)
        at = end
    return [*out, len(data)]


def media_file(payload: bytes) -> bytes:
    """The payload as unsigned 8-bit mono samples."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload))
    return head + payload


def samples(file: bytes) -> bytes:
    size = struct.unpack_from("<I", file, 40)[0]
    if file[:4] != b"RIFF" or len(file) != HEADER + size:
        raise ValueError("not a media file of this kind")
    return file[HEADER:]


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b" " * (max(1, -(-len(raw) // FRAME)) * FRAME - len(raw)), len(raw)


def chunks_of(file: bytes, gear: np.ndarray) -> list[bytes]:
    ends = cuts(file, gear)
    return [file[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def digest_of(chunk: bytes) -> bytes:
    return hashlib.sha256(chunk).digest()[:16]


def manifests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media_sha256 binary, digests): the ordered chunk list of each row's media file."""

    @F.pandas_udf("struct<n_bytes long, media_sha256 binary, digests array<binary>>")
    def listed(texts: pd.Series) -> pd.DataFrame:
        gear, out = gear_table(), []
        for text in texts:
            payload, n = padded(text)
            file = media_file(payload)
            out.append((n, hashlib.sha256(file).digest(), [digest_of(c) for c in chunks_of(file, gear)]))
        return pd.DataFrame(out, columns=["n_bytes", "media_sha256", "digests"])

    return docs.select(F.col(id_col).alias("doc_id"), listed(F.col(text_col)).alias("m")).select("doc_id", "m.*")


def trained_dictionary(docs: DataFrame, *, text_col: str = "text") -> bytes:
    """A compression dictionary from chunks of texts chosen by hash; empty where there are too few."""
    text = whole_text(text_col)
    share = SAMPLE / max(1, docs.count())
    # Texts whose 64-bit hash is under this share of its range; however many rows, about SAMPLE of them.
    bound = -(1 << 63) + int(share * (1 << 64)) if share < 1 else (1 << 63) - 1

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gear = gear_table()
        for pdf in batches:
            found = {digest_of(c): c for t in pdf["text"] for c in chunks_of(media_file(padded(t)[0]), gear)}
            yield pd.DataFrame({"digest": list(found), "chunk": list(found.values())})

    chosen = docs.select(text.alias("text")).where(F.xxhash64("text") <= bound).mapInPandas(cut, "digest binary, chunk binary")
    # The least digests, so that reruns train the same dictionary.
    sample = [bytes(r.chunk) for r in chosen.dropDuplicates(["digest"]).orderBy("digest").limit(SAMPLE).collect()]
    try:
        return zstandard.train_dictionary(min(DICTIONARY, sum(map(len, sample)) // 8), sample).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too small
        return b""


def _with(dictionary: bytes) -> dict:
    if not dictionary:
        return {}
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)  # else it is taken in again for every chunk
    return {"dict_data": held}


def chunks(docs: DataFrame, dictionary: bytes = b"", *, text_col: str = "text") -> DataFrame:
    """(digest, packed): chunks, each once for a stretch of a task's rows."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gear, pack, seen = gear_table(), zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, **_with(dictionary)), set()
        for pdf in batches:
            found: dict[bytes, bytes] = {}
            for text in pdf["text"]:
                for c in chunks_of(media_file(padded(text)[0]), gear):
                    d = digest_of(c)
                    if d not in seen:
                        seen.add(d)
                        found[d] = pack.compress(c)
                if len(seen) > 500_000:
                    seen.clear()
            yield pd.DataFrame({"digest": list(found), "packed": list(found.values())})

    return docs.select(F.col(text_col).alias("text")).mapInPandas(cut, "digest binary, packed binary")


def store(new: DataFrame, name: str | None = None) -> DataFrame:
    """Write chunks, each once, to a table bucketed by digest; of a table that is there already, those that it lacks.

    Without a name the table goes when the driver ends.
    """
    spark = new.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if name and spark.catalog.tableExists(name):
        known = spark.table(name)
        n = int(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first().data_type)
        new = written(new.join(known.select("digest"), "digest", "left_anti"))
    name = name or temporary_table("chunks")
    new.repartition(n, "digest").dropDuplicates(["digest"]).write.bucketBy(n, "digest").option("compression", "none").mode("append").saveAsTable(name)
    return spark.table(name)


def rebuilt(lists: DataFrame, kept: DataFrame) -> DataFrame:
    """(media_sha256, digests), (digest, packed) -> (media_sha256, n_chunks, parts): what a file is put together from."""
    one = lists.groupBy("media_sha256").agg(F.first("digests").alias("digests"))
    refs = written(one.select("media_sha256", F.size("digests").alias("n_chunks"), F.posexplode("digests").alias("at", "digest")))
    hot = refs.groupBy("digest").agg(F.ceil(F.count("*") / F.lit(HOT_REFS)).cast("int").alias("copies")).where("copies > 1")
    hot = written(hot)
    cold = refs.join(hot.select("digest"), "digest", "left_anti").join(kept, "digest")
    salted = refs.join(hot, "digest").withColumn("salt", F.pmod(F.xxhash64("media_sha256"), F.col("copies")).cast("int")).drop("copies")
    copied = kept.join(hot, "digest").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    both = cold.unionByName(salted.join(copied, ["digest", "salt"]).drop("salt"))
    parts = F.sort_array(F.collect_list(F.struct("at", "digest", "packed")))
    return both.groupBy("media_sha256", "n_chunks").agg(parts.alias("parts"))


def _put_together(sha: bytes, n: int, parts: list, unpack: zstandard.ZstdDecompressor) -> bytes:
    """The file of a media row; raises unless all is there and undamaged."""
    out = []
    for part in parts:
        chunk = unpack.decompress(bytes(part["packed"]), max_output_size=MOST)
        if digest_of(chunk) != bytes(part["digest"]):
            raise ValueError("a chunk is damaged")
        out.append(chunk)
    file = b"".join(out)
    if len(out) != n or hashlib.sha256(file).digest() != sha:
        raise ValueError("a media file cannot be put together")
    return file


def describe(payload: bytes) -> str:
    """Exact features of the samples about the middle level 128."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int((np.signbit(x[1:]) != np.signbit(x[:-1])).sum())
    return f"samples={len(x)};sum={int(x.sum())};energy={int((x * x).sum())};least={int(x.min())};most={int(x.max())};crossings={crossings}"


READ = "media_sha256 binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string"


def read_back(parts: DataFrame, dictionary: bytes = b"") -> DataFrame:
    """Facts of every media file, computed from its stored bytes."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor(**_with(dictionary))
        for pdf in batches:
            out = []
            for sha, n, own in zip(pdf["media_sha256"], pdf["n_chunks"], pdf["parts"], strict=True):
                file = _put_together(bytes(sha), int(n), own, unpack)
                payload = samples(file)
                out.append((bytes(sha), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(file), describe(payload)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in READ.split(", ")])

    return parts.select("media_sha256", "n_chunks", "parts").mapInPandas(read, READ)


def media_columns(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", name: str | None = None) -> DataFrame:
    """Store every text's media file, read it back and describe it: one row for each row of ``docs``.

    A named store stays, with its dictionary in the table ``name``_dictionary, and takes only
    the chunks that it lacks when it is given more.
    """
    spark = docs.sparkSession
    ship(spark)
    lists = written(manifests(docs, id_col=id_col, text_col=text_col))
    if name and spark.catalog.tableExists(f"{name}_dictionary"):
        dictionary = bytes(spark.table(f"{name}_dictionary").first()[0])
    else:
        dictionary = trained_dictionary(docs, text_col=text_col)
        if name:
            spark.createDataFrame([(dictionary,)], "dictionary binary").write.saveAsTable(f"{name}_dictionary")
    kept = store(chunks(docs, dictionary, text_col=text_col), name)
    free_shuffles(spark)
    # All rows of one text, such as all empty ones, have one media file: its facts are broadcast where they are many.
    key = F.col("media_sha256") == F.col("__hot")
    hot = hot_keys(lists, ["media_sha256"]).withColumnRenamed("media_sha256", "__hot")
    parts = []
    for how in ("left_anti",) if hot.isEmpty() else ("left_semi", "left_anti"):
        own = lists.join(F.broadcast(hot), key, how)
        facts = read_back(rebuilt(own.select("media_sha256", "digests"), kept), dictionary)
        parts.append(own.select("doc_id", "n_bytes", "media_sha256").join(F.broadcast(facts) if how == "left_semi" else facts, "media_sha256"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("media_sha256", F.lower(F.hex("media_sha256")))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media_columns(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
