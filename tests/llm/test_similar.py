import random

from failcast.llm import similar, simhash


def copies(rng, base, changed):
    words = base.split()
    for at in rng.sample(range(len(words)), changed):
        words[at] = f"changed{rng.randrange(10**9)}"
    return " ".join(words)


def made_texts():
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([7, 60, 200, 600]))) for _ in range(40)]
    texts = [*base, None, "", " \n", "one", "ONE", *[copies(rng, b, k) for b in base for k in (1, 2, 4) if len(b.split()) > 50]]
    return [*texts, *texts[:5]]


def brute(texts, similarity=0.8):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(texts)))
    near = [[j for j in range(len(sets)) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= similarity * max(1, len(sets[i] | sets[j]))] for i in range(len(sets))]
    while True:
        new = [min(comp[j] for j in near[i]) for i in range(len(comp))]
        if new == comp:
            return comp
        comp = new


def test_groups_are_those_of_exact_similarity(spark, docs_of):
    texts = made_texts()
    want = brute(texts)
    docs = docs_of(texts)
    for chunk in (similar.CHUNK, 2):
        got = {r.doc_id: r.component_id for r in similar.similar_copies(docs, chunk=chunk).collect()}
        assert [got[i] for i in range(len(texts))] == want
    assert similar.keep_one_similar(docs).count() == len(set(want)) < simhash.keep_one(docs).count()


def test_pipeline_stage_drops_copies_beyond_four_bits(spark, docs_of):
    import corpus_pipeline

    rng = random.Random(8)
    base = " ".join(f"w{rng.randrange(3000)}" for _ in range(300))
    out = corpus_pipeline.remove_near_copies(spark, docs_of([base, *[copies(rng, base, 5) for _ in range(20)], "something else"]), "")
    assert sorted(r.doc_id for r in out.collect()) == [0, 21]


def test_empty_repeated_and_null_ids(spark, docs_of):
    assert similar.similar_copies(docs_of([])).count() == 0
    got = similar.similar_copies(docs_of(["a b c d e", "a b c d e", "a b c d e"], ids=[7, 7, None])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got) == [(False, 7), (False, 7), (True, 7)]
