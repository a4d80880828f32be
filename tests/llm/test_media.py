import hashlib
import random
import zlib

import pytest

from failcast.llm import media


def texts():
    rng = random.Random(7)
    shared = "".join(rng.choice("abcdef ghij\n") for _ in range(9000))
    out = [None, "", "a", "é" * 100, shared, "x" + shared, "y" * 333 + shared, shared, " " * 5000, "".join(rng.choice("äbc") for _ in range(40_000))]
    return out + [f"text {i} " * i for i in range(20)]


def test_round_trip(spark, docs_of, tmp_path, monkeypatch):
    monkeypatch.setattr(media, "HOT_REFS", 2)
    docs_of(texts()).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in media.op4_media(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts())
    for i, t in enumerate(texts()):
        raw = (t or "").encode()
        payload = raw + b" " * ((-len(raw)) % 192 if raw else 192)
        file = media.media_file(payload)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-16:]), len(file), hashlib.sha256(file).hexdigest())
        assert r.feature == media.describe(payload)
    assert media.samples(media.media_file(b"\x00\xff" * 96)) == b"\x00\xff" * 96


def test_cuts_follow_content():
    gear = media.gear_table()
    rng = random.Random(3)
    data = rng.randbytes(200_000)
    slow, h = [], 0
    for i, b in enumerate(data):
        h = (h * 2 + int(gear[b])) % (1 << 32)
        if i >= 31 and h >> (32 - media.CUT_BITS) == 0:
            slow.append(i + 1)
    ends, at = [], 0
    while len(data) - at > media.LEAST:
        end = min([m for m in slow if m >= at + media.LEAST][:1] + [len(data)])
        end = min(end, at + media.MOST, len(data))
        if end == len(data):
            break
        ends.append(end)
        at = end
    assert media.cuts(data, gear) == [*ends, len(data)] and len(ends) > 20
    moved = set(media.chunks_of(b"some bytes before" + data, gear))
    assert sum(c in moved for c in media.chunks_of(data, gear)) > len(ends) * 0.8


def test_chunks_are_stored_once_and_damage_shows(spark, docs_of):
    docs = docs_of(texts())
    kept = media.store(media.chunks(docs), "kept_chunks")
    n = kept.count()
    assert n == kept.select("digest").distinct().count()
    assert media.store(media.chunks(docs_of([*texts()[:8], "new"])), "kept_chunks").count() == n + 1
    lists = media.manifests(docs).select("media_sha256", "digests")
    with pytest.raises(Exception, match="cannot be put together"):
        media.read_back(media.rebuilt(lists, kept.where("length(packed) < 400"))).collect()


def test_repeats_and_empty(spark, docs_of):
    assert media.media_columns(docs_of([])).count() == 0
    rows = media.media_columns(docs_of(["a", "a", "b"], ids=[1, 1, None])).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]


def test_named_stores_stay(spark, docs_of):
    first = media.media_columns(docs_of(texts()), name="kept_media").collect()
    n = spark.table("kept_media").count()
    again = media.media_columns(docs_of([*texts(), "more"]), name="kept_media").collect()
    assert len(again) == len(first) + 1 and spark.table("kept_media").count() == n + 1
    assert {r.media_sha256 for r in first} < {r.media_sha256 for r in again}


def test_the_sample_is_the_same_in_reruns(spark, docs_of, monkeypatch):
    monkeypatch.setattr(media, "SAMPLE", 12)
    docs = docs_of([f"{i} " * (200 + i) for i in range(60)])
    assert media.trained_dictionary(docs) == media.trained_dictionary(docs.repartition(5))
