import numpy as np
import pytest

from failcast.llm import mixing


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    p, size = rng.random(500), rng.integers(0, 5000, 500).astype(float)
    out = mixing.flight(p, size, rng.random(500))
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert abs(out.sum() - p.sum()) < 1e-6 and abs(out @ size - p @ size) < 1e-3


def test_inclusion_follows_probability():
    p, size = np.full(12, 0.3), np.arange(12.0)
    rng = np.random.default_rng(0)
    mean = np.mean([mixing.flight(p, size, rng.random(12)) for _ in range(600)], axis=0)
    assert abs(mean - 0.3).max() < 0.12


def test_landing_is_near():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 400):
        p, size = np.full(n, 0.37), (10 ** rng.uniform(0, 4, n)).round()
        out = mixing.fly_and_land(p, size, rng.random(n))
        assert set(out) <= {0.0, 1.0}
        if n >= 40:
            assert abs(out @ size - p @ size) < 50 and abs(out.sum() - p.sum()) < 8


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * w[s] / free > most * sizes[s]} if free else set()
        if not over:
            return {s: most * sizes[s] if s in capped else left * w[s] / free for s in names}
        capped |= over


def test_targets_and_totals(spark, docs_of, tmp_path):
    rng = np.random.default_rng(5)
    n = 900
    sources = [["b", "a", None, "é", "hot"][min(4, int(k))] for k in rng.integers(0, 8, n)]
    texts = [None if i % 50 == 0 else "w " * int(rng.integers(0, 60)) for i in range(n)]
    docs_of(texts, sources=sources).write.parquet(f"{tmp_path}/documents.parquet")
    rows = mixing.op9_mixing(spark, str(tmp_path)).collect()
    again = mixing.op9_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == n
    sizes = {}
    for s, t in zip(sources, texts, strict=True):
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    taken = {s: 0 for s in sizes}
    for r in rows:
        s = sources[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 5 for s in sizes)


def test_small_blocks_repeats_and_empty(spark, docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    rows = mixing.mix(docs_of(["a b"] * 6, ids=[1, 1, 1, None, None, 2])).collect()
    assert len(rows) == 6 and len({r.uid for r in rows}) == 6


@pytest.mark.parametrize("block", [4, 8, 14, 17, 18])
def test_every_block_comes_to_an_end(spark, block):
    units = spark.range(200).selectExpr("cast(id as string) uid", "id % 2 as g", "0.25 as prob", "cast(id as double) as size")
    found = mixing.cube_sample(units, ["g"], block=block).collect()
    assert len(found) == 200 and abs(sum(r.chosen for r in found) - 50) <= 2
    assert abs(sum(r.chosen * float(r.uid) for r in found) / (0.25 * 199 * 100) - 1) < 0.01


def test_a_block_that_cannot_shrink_is_refused(spark):
    units = spark.range(20).selectExpr("cast(id as string) uid", "0 as g", "0.25 as prob", "1.0 as size")
    for block in (0, 2, 3):
        with pytest.raises(ValueError):
            mixing.cube_sample(units, ["g"], block=block)


def test_small_source_beside_one_of_many_blocks(spark):
    rows = [(f"{g}.{i}", g, 0.37, float(round(10 ** ((i * 7919 + g * 31) % 997 / 300)))) for g in range(20) for i in range(50)]
    rows += [(f"hot.{i}", 99, 0.37, float(1 + i % 800)) for i in range(5000)]
    units = spark.createDataFrame(rows, "uid string, g int, prob double, size double")
    chosen = {r.uid: r.chosen for r in mixing.cube_sample(units, ["g"]).collect()}
    assert len(chosen) == len(rows)
    for g in range(20):
        words = [(chosen[u] * size, 0.37 * size) for u, of, _, size in rows if of == g]
        assert abs(sum(x for x, _ in words) / sum(y for _, y in words) - 1) < 0.001


def test_few_blocks_land_on_as_many(spark):
    """A source of three blocks lands on sixteen documents, not on the six that its flights leave."""
    rng = np.random.default_rng(4)
    rows = [(f"{g}.{i}", g, 0.37, float(round(10 ** rng.uniform(1, 4)))) for g in range(8) for i in range(70)]
    chosen = {r.uid: r.chosen for r in mixing.cube_sample(spark.createDataFrame(rows, "uid string, g int, prob double, size double"), ["g"], block=25).collect()}
    assert len(chosen) == len(rows)
    for g in range(8):
        words = [(chosen[u] * size, 0.37 * size) for u, of, _, size in rows if of == g]
        assert abs(sum(x for x, _ in words) / sum(y for _, y in words) - 1) < 0.001


def test_repeated_documents_are_what_the_mix_takes(spark, docs_of):
    texts = [f"{i % 40} " * (1 + i % 7) for i in range(120)] + ["same words here"] * 9
    ids = [*range(110), *[3] * 10, *[None] * 9]
    sources = [["a", "b", None][i % 3] for i in range(120)] + ["a"] * 9
    docs = docs_of(texts, ids=ids, sources=sources)
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.source] = taken.get((r.doc_id, r.source), 0) + r.copies * r.size
    got = {}
    for r in mixing.repeat_documents(docs).collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len(r.text.split())
    assert {k: v for k, v in taken.items() if v} == got
