import hashlib
import random

import numpy as np
import pytest

from failcast.llm import suffix_dedup as sd


def brute(rows, length=50):
    """(id, text) -> (id, n_bytes, n_removed, n_spans, sha)."""
    least = {}
    order = lambda d: (d is not None, d or 0)
    for doc, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            least[s] = min(least.get(s, order(doc)), order(doc))
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < order(doc):
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [say(rng.randint(8, 40)) for _ in range(5)]
    texts = [None, "", "short", "a" * 49, "a" * 50, "a" * 51, "a" * 300, "ab" * 100, "b" + "ab" * 60]
    for _ in range(50):
        t = say(rng.randint(0, 60))
        for p in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.randint(0, 20)
            t += " " + p[cut:] + say(rng.randint(0, 5))
        texts.append(t)
    texts += [texts[20], texts[30], texts[30], texts[31] + "!", "x" + texts[32], texts[33][:200]]
    return texts


@pytest.mark.parametrize("sizes", [(4_000_000, 4_000_000, 50_000), (700, 90, 50_000), (700, 90, 3)])
def test_matches_brute_force(spark, docs_of, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(sd, "HOT", sizes[2])
    monkeypatch.setattr(sd, "BATCH_BYTES", sizes[0])
    monkeypatch.setattr(sd, "PIECE", sizes[1])
    texts = corpus()
    ids = random.Random(1).sample(range(-20, 500), len(texts) - 1) + [None]
    rows = list(zip(ids, texts, strict=True)) + [(ids[12], texts[12]), (ids[13], texts[40])]
    docs_of([t for _, t in rows], ids=[i for i, _ in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in sd.op3_suffix_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("hot", [50_000, 5])
def test_groups_that_go_on_in_the_next_batch(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT", hot)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rng = random.Random(5)
        passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
        texts = [f"{i} {passage}{i * 7}" + "".join(rng.choice("xyz") for _ in range(i % 60)) for i in range(60)]
        rows = list(enumerate(texts))
        found = sd.remove_repeats(docs_of(texts)).collect()
        got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found), key=str)
        assert got == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_names_tell_strings_apart():
    data = np.frombuffer(bytes(random.Random(2).choices(b"ab", k=3000)), np.uint8)
    for length in (16, 50):
        name = sd.names(data, length)
        by = {}
        for i in range(len(data) - length + 1):
            by.setdefault(data[i : i + length].tobytes(), set()).add(int(name[i]))
        assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)


def test_different_bytes_of_one_name(spark):
    """Bytes decide where names agree by chance."""
    strings = [f"{i % 4} and fifty more bytes so that this is long enough".encode() for i in range(9)]
    rows = [(1, i, i, 1, x[:50]) for i, x in enumerate(strings)]
    found = spark.createDataFrame(rows, "name long, key long, uid long, at long, data binary")
    weak = lambda data, length: np.zeros(len(data), np.uint64)
    got = sorted(r.uid for r in sd.repeated_spans(found, 50, 2, name_of=weak).collect())
    assert got == [4, 5, 6, 7, 8]


def test_lengths_without_a_doubled_round(spark, docs_of):
    texts = corpus()[:30]
    for length in (20, 46, 47, 63):
        found = sd.remove_repeats(docs_of(texts), length=length).collect()
        got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found), key=str)
        assert got == brute(list(enumerate(texts)), length)


def test_empty_table(spark, docs_of):
    assert sd.remove_repeats(docs_of([])).count() == 0


def test_hot_names_are_marked_once(spark, docs_of, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 9)
    texts = spark.createDataFrame([(i, f"{i} the same passage of over fifty bytes that every document has {i}".encode()) for i in range(40)], "uid long, data binary").repartition(5)
    shared = sd.shared_anchors(sd.anchors(texts, 50), 3)
    marks = [r.name for r in shared.where(f"uid = {sd.MARKER}").collect()]
    assert marks and len(marks) == len(set(marks))
    assert {r.hot for r in sd.marked_hot(shared).where(f"name = {marks[0]}").collect()} == {True}
