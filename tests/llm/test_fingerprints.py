import hashlib
import random

import numpy as np
import pytest

from failcast.llm import fingerprints as fp


def made_texts():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 300, 3000]))) for _ in range(60)] + [None, "", "ab"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_matches_brute_force(spark, docs_of, tmp_path, partitions):
    texts = made_texts()
    ids = random.Random(2).sample(range(-50, 2000), len(texts))
    docs_of(texts, ids=ids).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = {r.doc_id: r for r in fp.op1_fingerprints(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    pairs = np.zeros(1 << 16, np.int64)
    for t in texts:
        b = (t or "").encode()
        for x, y in zip(b, b[1:]):
            pairs[x << 8 | y] += 1
    cost = fp.costs(pairs)
    make = lambda s: fp.filters(fp.features(s.encode(), cost))
    docs = sorted(zip(ids, [t or "" for t in texts], strict=True))
    assert set(rows) == set(ids)
    for k, (doc, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fp.digest(make(text)) and r.edited_fingerprint == fp.digest(make(edited))
        assert r.near_edited == fp.likeness(make(text), make(edited)) and r.near_next == fp.likeness(make(text), make(after))
    long = [rows[i] for i, t in docs if len(t) > 300]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95 and np.median([r.near_edited for r in long]) > 0.3


def test_selection_by_brute_force():
    data = max(made_texts()[:60], key=len).encode()[:1500]
    cost = fp.costs(np.arange(1 << 16) % 7)
    rarity = [sum(int(cost[data[i] << 8 | data[i + 1]]) for i in range(p, p + fp.WINDOW - 1)) for p in range(len(data) - fp.WINDOW + 1)]
    votes = {}
    for s in range(len(rarity) - fp.WINDOW + 1):
        best = max(range(s, s + fp.WINDOW), key=lambda p: (rarity[p], -p))
        votes[best] = votes.get(best, 0) + 1
    want = lambda least: list(dict.fromkeys(fp.xxhash.xxh3_64_intdigest(data[p : p + fp.WINDOW]) for p in sorted(votes) if votes[p] >= least))
    assert fp.features(data, cost) == want(fp.VOTES) and len(want(fp.VOTES)) >= fp.FEW
    short = fp.features(data[:60], cost)
    assert len(short) > sum(v >= fp.VOTES for p, v in votes.items() if p < 60 - 2 * fp.WINDOW)


@pytest.mark.parametrize("low", [(1 << 53) - 2, (1 << 62) - 2, -(1 << 62)])
def test_neighbours_of_large_ids(spark, docs_of, low):
    ids = [low + i for i in random.Random(5).sample(range(40), 12)]
    texts = [f"{i} is the text " * 9 for i in range(len(ids))]
    rows = {r.doc_id: r for r in fp.compare_edits(docs_of(texts, ids=ids).repartition(3)).collect()}
    order = sorted(zip(ids, texts, strict=True))
    for k, (doc, text) in enumerate(order):
        half = len(text) // 2
        edited = text[: len(text) - half] + order[(k + 1) % len(order)][1][:half]
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_digest_round_trip_and_bounds():
    cost = fp.costs(np.random.default_rng(0).integers(0, 99, 1 << 16))
    a = fp.filters(fp.features(bytes(random.Random(3).randbytes(60_000)), cost))
    assert (fp.undigest(fp.digest(a)) == a).all() and len(a) > 1
    none = fp.filters([])
    assert fp.likeness(a, a) == 1 and fp.likeness(none, none) == 1 and fp.likeness(a, none) == 0


def test_repeats_nulls_single_and_empty(spark, docs_of):
    assert fp.compare_edits(docs_of([])).count() == 0
    (one,) = fp.compare_edits(docs_of(["hello there " * 20])).collect()
    assert one.near_next == 1.0
    rows = fp.compare_edits(docs_of(["b" * 90, "a" * 90, "c", None], ids=[4, 4, None, None])).collect()
    # In order of id, then text: "", "c", "aa...", "bb...".
    assert {r.edited_sha256 for r in rows} == {hashlib.sha256(x.encode()).hexdigest() for x in ("", "c", "a" * 45 + "b" * 45, "b" * 45)}
    assert len(rows) == 4 and sorted(str(r.doc_id) for r in rows) == ["4", "4", "None", "None"]
