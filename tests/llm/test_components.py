import random

from failcast.llm import components


def brute_force(links):
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_matches_brute_force(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(80)] + [(5, 5), (7, 8), (8, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {x: r for x, r in brute_force(links).items() if any(x in p and p[0] != p[1] for p in links)}
    assert {x: found[x] for x in want} == want


def test_empty_and_strings(spark):
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0
    found = components.components(spark.createDataFrame([("b", "a"), ("c", "b")], "u string, v string")).collect()
    assert {r.node: r.root for r in found} == {"a": "a", "b": "a", "c": "a"}


def test_hashes_whose_sum_is_over_64_bits(spark):
    edges = spark.range(1000).selectExpr("id + 1 AS u", "0L AS v")
    hashes = [r[0] for r in edges.selectExpr("abs(xxhash64(u, v))").collect()]
    assert sum(hashes) > 1 << 63
    assert components._print_of(edges)[0] == 1000
    found = components.components(edges)
    assert found.where("root = 0").count() == 1001
