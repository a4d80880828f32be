from failcast.llm import token_counts


def test_answers_for_every_limit(spark):
    lengths = [0, 0, 3, 5, 5, 5, 9, 4096, 4097, 20_000]
    hist = token_counts.histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    rows = {r.n_tokens: r for r in hist.collect()}
    for n, r in rows.items():
        longer = [x for x in lengths if x >= n]
        assert (r.n_docs, r.docs_from, r.tokens_from) == (lengths.count(n), len(longer), sum(longer))
        assert r.kept_at_limit == sum(min(x, n) for x in lengths) and r.docs_over == sum(x > n for x in lengths)
        assert abs(r.fraction_to - sum(x <= n for x in lengths) / len(lengths)) < 1e-12
    assert token_counts.total(hist) == sum(lengths)
    for limit in (0, 1, 4, 5, 4096, 5000, 30_000):
        assert token_counts.kept_at(hist, limit) == sum(min(x, limit) for x in lengths)
    for q in (0.1, 0.5, 0.7, 0.95, 1.0):
        assert token_counts.quantile(hist, q) == min(n for n in lengths if sum(x <= n for x in lengths) >= q * len(lengths))


def test_empty(spark):
    hist = token_counts.histogram(spark.createDataFrame([], "n_tokens long"))
    assert hist.count() == 0 and token_counts.total(hist) == 0 and token_counts.quantile(hist, 0.5) is None
