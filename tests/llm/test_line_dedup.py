import hashlib

import numpy as np

from failcast.llm import line_dedup

WHITE = " \t\n\x0b\f\r"


def brute(rows, min_chars=40, min_docs=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(WHITE).translate(lower)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    order = lambda d: (d is not None, d or 0)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or doc == max(holders[key(x)], key=order)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_matches_brute_force(spark, docs_of, tmp_path):
    long, short = "Ä Common line that is long enough to count, Yes", "short line"
    texts = [None, "", "\n\n"] + [f"  {long}\t\nown {i}\n{short}\n{long.upper() if i % 2 else long}" for i in range(9)] + ["x" * 39, "y" * 40] * 5 + [long + "é" * 3]
    ids = [*range(len(texts) - 1), None]
    rows = list(zip(ids, texts, strict=True)) + [(4, texts[4])]
    docs_of([t for _, t in rows], ids=[i for i, _ in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in line_dedup.op10_line_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_filter_inserts_deletes_and_stashes():
    rng = np.random.default_rng(0)
    keys = rng.integers(-(1 << 62), 1 << 62, 3000)
    made = line_dedup.CuckooFilter.sized(3000)
    made.insert(keys)
    made = line_dedup.CuckooFilter.load(*made.dump())
    assert made.contains(keys).all()
    others = rng.integers(-(1 << 62), 1 << 62, 100_000)
    assert made.contains(others).mean() < 0.002
    made.delete(keys[:1500])
    assert made.contains(keys[1500:]).all() and made.contains(keys[:1500]).mean() < 0.01
    full = line_dedup.CuckooFilter(np.zeros((4, 4), np.uint16), set())
    full.insert(keys[:40])
    assert full.stash and full.contains(keys[:40]).all()
    full.delete(keys[:40])
    assert not full.stash and not full.table.any()


def test_deletion_reverses_insertion(spark, docs_of):
    line = "this line is repeated in many of the documents here"
    old = line_dedup.postings(docs_of([line] * 4 + ["another line that is long enough to be counted"], ids=[1, 2, 3, 4, 5]))
    new = line_dedup.postings(docs_of([line] * 3, ids=[10, 11, 12]))
    both = line_dedup.insert_documents(old, new)
    back = line_dedup.delete_documents(both, spark.createDataFrame([(10,), (11,), (12,)], "doc_id long"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, old.collect()))
    frequent = lambda s: line_dedup.reference_counts(s).where("refs >= 5")
    assert [(r.refs, r.keeper) for r in frequent(both).collect()] == [(7, 12)] and frequent(back).count() == 0
    none = frequent(old)
    filters = line_dedup.update_filters(line_dedup.build_filters(none, 1), frequent(both), none, 1)
    assert line_dedup.probe(both, filters, 1).count() == 7
    emptied = line_dedup.update_filters(filters, none, frequent(both), 1)
    assert line_dedup.probe(both, emptied, 1).count() == 0


def test_probing_by_shard_gives_the_same(spark, docs_of, monkeypatch):
    line = "this line is repeated in many of the documents here"
    state = line_dedup.postings(docs_of([f"{line} {i % 7}" for i in range(60)], ids=[*range(59), None]))
    frequent = line_dedup.reference_counts(state).where("refs >= 9")
    filters = line_dedup.build_filters(frequent, 3)
    one = sorted(map(str, line_dedup.probe(state, filters, 3).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 5)
    assert one and one == sorted(map(str, line_dedup.probe(state, filters, 3).collect()))


def test_full_filters_are_built_again(spark):
    key = lambda n: spark.range(n).selectExpr("xxhash64(id) AS h1", "xxhash64(id, 1) AS h2")
    few, many = key(12), key(400)
    filters = line_dedup.build_filters(few, 1)
    grown = line_dedup.update_filters(filters, many.join(few, ["h1", "h2"], "left_anti"), few.limit(0), 1, many)
    (row,) = grown.collect()
    assert row.share <= line_dedup.FULL and len(row.slots) > len(filters.first().slots) and not row.stash
    made = line_dedup.CuckooFilter.load(row.slots, row.stash)
    assert made.contains(np.array([r.h1 for r in many.collect()])).all()


def test_store_keeps_inserts_and_deletes(spark, docs_of, tmp_path):
    common = ["the first of the lines that many documents share", "the second of the lines that many documents share"]
    texts = [f"own line {i}\n{common[i % 2]}\n{common[0]}" for i in range(10)]
    first, second = docs_of(texts[:6]), docs_of(texts[6:], ids=range(6, 10))
    open_ = lambda: line_dedup.Store(spark, f"file://{tmp_path}/lines", shards=2)
    keys = lambda: sorted(map(str, open_().postings().collect()))
    prints = lambda: {r.shard: sorted(np.frombuffer(r.slots, np.uint16)[np.frombuffer(r.slots, np.uint16) > 0].tolist()) for r in open_().filters().collect()}
    open_().insert(first)
    start, start_prints = keys(), prints()
    assert open_().version() == 0 and sum(map(len, start_prints.values())) == 1  # the second line is in three documents
    open_().insert(second)
    open_().insert(second.limit(2))  # nothing new
    assert sum(map(len, prints().values())) == 2
    every = docs_of(texts)
    got = sorted((r.doc_id, r.n_dropped) for r in open_().dedup(every).collect())
    want = sorted((r.doc_id, r.n_dropped) for r in line_dedup.dedup_lines(every).collect())
    assert got == want and sum(n for _, n in got) == 18
    open_().delete(second.select("doc_id"))
    assert keys() == start and {k: v for k, v in prints().items() if v} == {k: v for k, v in start_prints.items() if v}


def test_compacted_store_reads_few_batches_and_says_the_same(spark, docs_of, tmp_path):
    common = "a line that is in every document of this small corpus"
    stores = [line_dedup.Store(spark, f"file://{tmp_path}/{n}", shards=2, compact_every=n) for n in (2, 100)]
    for store in stores:
        for k in range(3):
            store.insert(docs_of([f"{common}\nown line of number {k}"] * 2, ids=[2 * k, 2 * k + 1]))
        store.delete(spark.createDataFrame([(0,), (5,)], "doc_id long"))
    every = docs_of([f"{common}\nx"] * 6)
    found = [(sorted(map(str, x.postings().collect())), sorted(map(str, x.dedup(every).collect()))) for x in stores]
    assert found[0] == found[1] and stores[0]._whole("compacted") == [1, 3] and stores[1]._whole("compacted") == []
    assert not any("/postings/" in f for f in stores[0].postings().inputFiles())


def test_null_ids_are_one_document(spark, docs_of):
    line = "this line is repeated in many of the documents here"
    rows = [(None, f"{line}\n{i}") for i in range(6)]
    docs = docs_of([t for _, t in rows], ids=[i for i, _ in rows])
    assert {r.n_dropped for r in line_dedup.dedup_lines(docs).collect()} == {0}
    more = docs_of([t for _, t in rows] + [line] * 4, ids=[None] * 6 + [1, 2, 3, 4])
    assert sorted((str(r.doc_id), r.n_dropped) for r in line_dedup.dedup_lines(more).collect()) == [("1", 1), ("2", 1), ("3", 1), ("4", 0)] + [("None", 1)] * 6


def test_empty_table_and_extra_columns(spark, docs_of):
    assert line_dedup.dedup_lines(docs_of([])).count() == 0
    out = line_dedup.dedup_lines(docs_of(["a\nb", None]))
    assert [(r.text, r.n_lines, r.n_dropped, r.source) for r in out.orderBy("doc_id").collect()] == [("a\nb", 2, 0, "s"), (None, 1, 0, "s")]
