import corpus_pipeline
import pytest

from failcast.llm import mixing, simhash


@pytest.fixture(scope="module")
def sf(spark, docs_of, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("sf"))
    line = "This boiler plate line is repeated in very many documents."
    texts = [f"{line}\nunique text {i} " + " ".join(f"w{i * j % 97}" for j in range(60)) for i in range(40)]
    texts += [texts[3]] * 4 + [None, ""] + ["vile slur words vile slur " + t for t in texts[:12]]
    docs_of(texts, sources=[f"s{i % 3}" for i in range(len(texts))]).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 46)) for i in range(len(texts))], "doc_id long, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def test_stages_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == list(corpus_pipeline.COLUMNS)
            out = corpus_pipeline.written(out)
        if k == 1:
            assert out.where("text like 'This boiler plate%'").count() == 1 and out.where("n_chars <> char_length(text)").count() == 0
        if k == 2:
            found = simhash.near_duplicates(docs)
            assert out.count() == found.select("component_id").distinct().count() < n
        if k == 3:
            want = {r.doc_id: r.copies for r in mixing.mix(docs).where("copies > 0").collect()}
            got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
            assert got == want
        docs, n = out, out.count()
    assert {"doc_id", "sequence_id", "offset"} < set(docs.columns)


def test_run_is_the_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert sorted(map(str, docs.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(str, corpus_pipeline.run(spark, sf).select("doc_id", "start", "length", "ids_crc32").collect()))
