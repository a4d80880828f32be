import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from failcast.llm import packing, token_counts, tokens

TEXTS = [None, "", "a", "Hello world, hello.", "été  \n\n x<|endoftext|>y", "word " * 5000, "   \t" * 700, "1234567 !!! 中文 \U0001f600", "z" * 3000, "don't we'll\r\n"]


def ids_of(text):
    return Tokenizer.from_file(tokens.default_path()).encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizers():
    encode = tokens.encoder(tokens.default_path())
    for text in TEXTS:
        assert encode(text or "") == ids_of(text)


def test_pieces_cover_every_id(spark, docs_of, tmp_path):
    docs_of(TEXTS + TEXTS[3:4], ids=[*range(len(TEXTS)), 2**60 + 1]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = packing.op5_packing(spark, str(tmp_path)).collect()
    texts = dict(enumerate(TEXTS)) | {2**60 + 1: TEXTS[3]}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = [*ids_of(texts[doc]), 1]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_fill_keeps_every_limit():
    rng = np.random.default_rng(2)
    demand = np.stack((rng.integers(1, 2049, 3000), np.ones(3000, int), rng.integers(0, 2049, 3000)), axis=1)
    demand[:, 2] = np.minimum(demand[:, 2], demand[:, 0])
    limits = np.array([2048, 6, 1200])
    demand = demand[(demand <= limits).all(1)]
    out = packing.fill(demand, limits)
    assert sorted(i for row in out for i in row) == list(range(len(demand)))
    assert all((demand[row].sum(0) <= limits).all() for row in out)
    with pytest.raises(ValueError):
        packing.fill(np.array([[9, 1, 9]]), np.array([8, 8, 8]))


def test_little_padding():
    rng = np.random.default_rng(2)
    size = rng.integers(1, 2048, 4000)
    out = packing.fill(np.stack((size, np.ones(4000, int), size), axis=1), np.array([2048, 512, 2048]))
    assert size.sum() / (2048 * len(out)) > 0.97


def test_empty_null_ids_and_repeats(spark, docs_of):
    assert packing.pack_documents(docs_of([])).count() == 0
    rows = packing.pack_documents(docs_of(["a b", "a b", "c"], ids=[5, 5, None])).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["5", "5", "None"]


def test_histogram(spark, docs_of, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "BUCKET", 7)
    docs_of(TEXTS * 2).write.parquet(f"{tmp_path}/documents.parquet")
    n = [len(ids_of(t)) for t in TEXTS] * 2
    hist = token_counts.op7_token_counts(spark, str(tmp_path)).cache()
    rows = {r.n_tokens: r for r in hist.collect()}
    assert set(rows) == set(n)
    for limit, r in rows.items():
        assert r.n_docs == n.count(limit)
        assert r.docs_from == sum(x >= limit for x in n) and r.tokens_from == sum(x for x in n if x >= limit)
        assert r.kept_at_limit == sum(min(x, limit) for x in n)
        assert r.docs_over == sum(x > limit for x in n)
        assert abs(r.fraction_to - sum(x <= limit for x in n) / len(n)) < 1e-12
    assert token_counts.total(hist) == sum(n)
    for limit in (0, 3, 500, 10**6):
        assert token_counts.kept_at(hist, limit) == sum(min(x, limit) for x in n)
    assert token_counts.quantile(hist, 0.5) == sorted(n)[len(n) // 2 - 1]
    empty = token_counts.histogram(token_counts.lengths(docs_of([])))
    assert empty.count() == 0 and token_counts.total(empty) == 0 and token_counts.quantile(empty, 0.5) is None


def one_by_one(demand, limits):
    """The heuristic item by item: the fitting one with the largest weighed dot product, larger demands first among equals."""
    alone = [i for i, d in enumerate(demand) if d[0] == limits[0]]
    left = [i for i, d in enumerate(demand) if d[0] != limits[0]]
    weight = 1 / np.maximum(np.mean([demand[i] for i in left], axis=0), 1e-9) ** 2
    out = [[tuple(demand[i])] for i in alone]
    while left:
        room, row = np.array(limits, float), []
        while fits := [i for i in left if (demand[i] <= room).all()]:
            best = max(fits, key=lambda i: (float(demand[i] @ (weight * room)), tuple(demand[i])))
            row.append(tuple(demand[best]))
            room -= demand[best]
            left.remove(best)
        out.append(row)
    return out


def test_fill_is_the_heuristic():
    rng = np.random.default_rng(8)
    demand = np.stack((rng.integers(1, 60, 200), np.ones(200, int), rng.integers(0, 30, 200)), axis=1)
    demand[:, 2] = np.minimum(demand[:, 2], demand[:, 0])
    limits = np.array([64, 5, 32])
    got = [[tuple(demand[i]) for i in row] for row in packing.fill(demand, limits)]
    assert got == one_by_one(demand, limits)


def test_each_limit_binds():
    limits = np.array([100, 4, 50])
    tight = lambda d, k: [(d[row].sum(0)[k] == limits[k]) for row in packing.fill(d, limits)]
    long, many, taught = np.array([[25, 1, 1]] * 40), np.array([[3, 1, 1]] * 40), np.array([[25, 1, 25]] * 40)
    assert all(tight(long, 0)) and all(tight(many, 1)) and all(tight(taught, 2))
    assert not any(tight(many, 0)) and not any(tight(taught, 0)) and not any(tight(taught, 1))


def test_conversations(spark):
    texts = ["Hello there", "", "word " * 90, "What is it?", None, "Yes. " * 40]
    rows, want = [], defaultdict(list)
    # Conversation 4 is the one whose long turns are the assistant's, so that loss is full before tokens are.
    for conv in [0, 1, 2, 3, 4, None]:
        n = {0: 40, 1: 1, 4: 12}.get(conv, 7)
        for turn in range(n):
            role, text = ("assistant", "user", None)[(turn + (conv or 0)) % 3], texts[(turn * 5 + (conv or 0)) % 6]
            rows.append((conv, turn, role, text, "x"))
            size = len(ids_of(text)) + 1
            want[conv] += [role == "assistant"] * size
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, start string").repartition(5)
    limits = {"limit": 128, "segments": 6, "loss": 40}
    got = packing.pack_conversations(df, **limits).collect()
    by_conv, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_conv[r.conv_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_conv) == set(want)
    for conv, own in by_conv.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at
            mask = [False] * r.length
            for a, b in zip(r.loss_spans[::2], r.loss_spans[1::2], strict=True):
                mask[a:b] = [True] * (b - a)
            assert mask == want[conv][at : at + r.length] and sum(mask) == r.loss_tokens
            at += r.length
        assert at == len(want[conv])
    sums = [(sum(r.length for r in x), sum(r.n_segments for r in x), sum(r.loss_tokens for r in x)) for x in by_seq.values()]
    assert all(a <= 128 and b <= 6 and c <= 40 for a, b, c in sums)
    assert any(b == 6 and a < 128 for a, b, _ in sums) and any(c == 40 and a < 128 for a, _, c in sums)
    assert packing.pack_conversations(df.limit(0)).count() == 0
