import hashlib
import math

import numpy as np
import pytest

from failcast.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, code string, error string"


def floats(v):
    return [None if x is None else float(np.float32(x)) for x in v]


def brute(rows, parts=4, entries=256, rounds=4):
    """The contract in plain Python integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    whole = [[math.floor(1024 * x) for x in v] + [0] * (longest - len(v)) for _, v, _ in kept]
    size = longest // parts
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    cut = lambda k, p: whole[k][p * size : (p + 1) * size]
    books = [[cut(k, p) for k in order] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for k in range(len(kept)):
                of.setdefault(near(cut(k, p), books[p])[1], []).append(cut(k, p))
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e], strict=True)] if e in of else old for e, old in enumerate(books[p])]
    found = [[near(cut(k, p), books[p]) for p in range(parts)] for k in range(len(kept))]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), err, by_label[label], sha) for (i, _, label), f, err in zip(kept, found, errors, strict=True)), key=str)


def run(spark, rows, place):
    spark.createDataFrame([(i, v, label, "x", "x", "x", "x") for i, v, label in rows], SCHEMA).repartition(3).write.parquet(f"{place}/embeddings.parquet")
    return sorted((tuple(r) for r in V.op11_vector_codes(spark, str(place)).collect()), key=str)


def test_equals_brute_force_with_ties_and_bad_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(int(i), floats(rng.integers(-3, 4, 8) / 64), [None, 1, 2, 2][i % 4]) for i in rng.permutation(330)]  # few values: many equal distances
    rows += [(1000 + i, floats([0.25] * 8), 7) for i in range(40)] + [(3, rows[0][1], 5), (3, rows[1][1], 5), (None, floats([0.5] * 8), None)]
    rows += [(5000, None, 1), (5001, [0.1, None] + [0.0] * 6, 1), (-1, [math.nan] * 8, 1), (-2, [math.inf] + [0.0] * 7, 1)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_other_lengths_and_few_vectors(spark, tmp_path):
    rows = [(1, floats([0.5, -0.25, 1.0]), 1), (2, [], None), (3, floats([0.125] * 10), 1), (4, floats([0.5, -0.25, 1.0]), 2)]
    assert run(spark, rows, tmp_path) == brute(rows)


def test_empty_and_only_bad(spark, tmp_path):
    assert run(spark, [], tmp_path / "a") == []
    assert run(spark, [(1, None, 1), (2, [math.nan], 1)], tmp_path / "b") == []


def test_components_beyond_int64(spark, tmp_path):
    rows = [(i, floats([1e30 * (i % 3), 2.0, -3e9, 0.5]), i % 2) for i in range(9)]
    got, want = run(spark, rows, tmp_path), brute(rows)
    assert [(g[0], g[1], g[4]) for g in got] == [(w[0], w[1], w[4]) for w in want]
    assert all(g[2] == (w[2] if w[2] < 2**63 else None) for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("spread", [3, 300, 100_000, 2**27])
def test_screening_never_loses_the_nearest(spread):
    rng = np.random.default_rng(spread)
    x, book = rng.integers(-spread, spread + 1, (500, 16)), rng.integers(-spread, spread + 1, (256, 16))
    book[100:110] = book[:10]  # equal entries: the lower index wins
    x[:200] = book[rng.integers(0, 256, 200)] + rng.integers(-1, 2, (200, 16))
    exact = ((x[:, None, :] - book) ** 2).sum(axis=2)
    index, distance = V.nearest(x, book)
    assert (index == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert V.screened(x, book).sum(axis=1).mean() < 40  # nearly all entries are ruled out


def test_codes_decode_to_near_vectors(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, floats(rng.normal(0, 0.2, 16)), 0) for i in range(600)], "vec_id long, embedding array<float>, label int")
    codes, books = V.compress(df)
    back = {r.id: r.vector for r in V.decoded(codes, books).collect()}
    off = [np.linalg.norm(np.array(back[r.vec_id]) - np.array(r.embedding)) / np.linalg.norm(r.embedding) for r in df.collect()]
    assert len(back) == 600 and np.mean(off) < 0.45
    with pytest.raises(ValueError):
        V.train(df.selectExpr("vec_id as id", "embedding as vector"), entries=300)


def test_group_sums_of_hot_and_rare_labels(spark, monkeypatch):
    monkeypatch.setattr(V, "HOT_SHARE", 0.1)
    rows = [(i, [None, "hot", f"r{i % 40}"][min(2, i % 5)], i) for i in range(500)]
    got = V.with_group_sums(spark.createDataFrame(rows, "i int, label string, error long"), "label", "error", "total").collect()
    want = {}
    for _, label, e in rows:
        want[label] = want.get(label, 0) + e
    assert len(got) == 500 and all(r.total == want[r.label] for r in got)
