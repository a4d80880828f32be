import random

import numpy as np
import xxhash

from failcast.llm import simhash


def brute(texts, radius=4, k=4):
    prints = []
    for t in texts:
        words = (t or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
        bits = 0
        for b in range(64):
            if sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) * 2 > len(shingles):
                bits |= 1 << b
        prints.append(bits if shingles else 0)
    comp = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(len(texts)):
                if (prints[i] ^ prints[j]).bit_count() <= radius and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    return [(i, f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, comp, strict=True))]


def test_matches_brute_force(spark, docs_of, tmp_path):
    rng = random.Random(4)
    base = [" ".join(rng.choice("the Of and là to x".split()) + str(rng.randrange(90)) for _ in range(rng.choice([3, 30, 200]))) for _ in range(25)]
    texts = [None, "", " \n\t", "one", "ONE", "two words", *base, base[3], *[b + " tail" for b in base[:12]]]
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in simhash.op6_simhash(spark, str(tmp_path)).collect())
    assert got == brute(texts)


def test_forest_keeps_components_over_chains_and_dense_groups():
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([s ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for s in seeds]))
    node, root = simhash.forest(x, None, 4)
    label = np.arange(len(x))
    label[node] = root
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 4
    want = np.arange(len(x))
    while True:
        new = np.array([want[near[i]].min() for i in range(len(x))])
        if (new == want).all():
            break
        want = new
    assert len(np.unique(label)) == len(np.unique(want))
    assert all(len(np.unique(want[label == r])) == 1 for r in np.unique(label))
    assert len(node) <= len(x)


def test_tiles_smaller_than_groups(spark):
    x = [(1 << 40) ^ (1 << i) for i in range(30)] + [0, (1 << 62) - 1, -5]
    prints = spark.createDataFrame([(v,) for v in x], "fp long")
    one, many = simhash.links(prints).collect(), simhash.links(prints, tile=3).collect()
    joined = lambda e: simhash.components(spark.createDataFrame(e)).groupBy("root").count().collect()
    assert sorted(joined(one)) == sorted(joined(many)) and len(joined(one)) == 2


def test_empty_repeated_and_null_ids(spark, docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    got = simhash.near_duplicates(docs_of(["a b c d e", "a b c d e", "a b c d e"], ids=[7, 7, None])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got) == [(False, 7), (False, 7), (True, 7)]
    assert simhash.keep_one(docs_of(["a b c d e", "a b c d e", "z"], ids=[3, 2, 9])).count() == 2
