import math
import re
from collections import Counter

import numpy as np
import pytest

from failcast.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    found = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in found)
    n_terms = sum(sum(c.values()) for _, c in found)
    df = Counter(w for _, c in found for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, []).extend(words(t))
    out = []
    for item, own in asked.items():
        scores = []
        for doc, c in found:
            m = 75 + 25 * sum(c.values()) * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 12 * m)) for w in own if c[w])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in docs], "doc_id long, text string, score string, rank string, id string")
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    return d, q


DOCS = [(i, " ".join(f"w{(i * k) % 37}" for k in range(1, 2 + i % 23))) for i in range(300)]
DOCS += [(1000, None), (1001, ""), (1002, " \x00,.!"), (7, "W5 w5"), (7, "w5 W5"), (None, "w5 w5"), (1003, "Été été ÉTÉ naïve x"), (1004, "a" * 100_000), (1005, "w1 " * 40_000)]
ITEMS = [(0, "w1, W2; w3 w3"), (1, None), (2, "nothing here"), (3, "été Été naïve"), (None, "w5"), (4, "w1"), (4, "w7 w7"), (5, "a" * 100_000), (6, "")]


@pytest.mark.parametrize("entries", [lexical.ENTRIES, 3])
def test_equals_brute_force(spark, monkeypatch, entries):
    monkeypatch.setattr(lexical, "DOCS", 50)
    d, q = frames(spark, DOCS, ITEMS)
    got = sorted(map(tuple, lexical.search(d.repartition(5), q, entries=entries).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == brute(DOCS, ITEMS)


def test_few_and_empty(spark):
    d, q = frames(spark, DOCS[:3], ITEMS)
    assert sorted(map(tuple, lexical.search(d, q, top=2).collect()), key=str) == brute(DOCS[:3], ITEMS, top=2)
    assert lexical.search(d.limit(0), q).count() == 0 and lexical.search(d, q.limit(0)).count() == 0


def test_bytes_and_code_points_agree():
    text = "".join(map(chr, range(300))) + "aB1\U0001f600é z"
    assert [t.decode() for t in lexical.terms(text.encode())] == words(text)


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(0)
    best, rows = lexical.Best(5), []
    for _ in range(20):
        score, ids, null = rng.integers(0, 4, 30), rng.integers(0, 50, 30), rng.random(30) < 0.1
        best.add(score, ids, null)
        rows += [(-s, n, i) for s, n, i in zip(score.tolist(), null.tolist(), ids.tolist(), strict=True) if s > 0]
    want = sorted(rows)[:5]
    assert [(-s, n, i) for s, n, i in zip(best.score.tolist(), best.null.tolist(), best.id.tolist(), strict=True)] == want


def test_impacts_of_huge_corpora():
    tf, n, w = np.array([1, 5]), np.array([10, 10**9]), np.array([100, 200])
    big = 10**13
    want = [int(a) * ((10**9 * int(t)) // (1000 * int(t) + 12 * (75 + 25 * int(x) * big // 10**15))) for t, x, a in zip(tf, n, w, strict=True)]
    assert lexical.impacts(tf, n, w, big, 10**15).tolist() == want
