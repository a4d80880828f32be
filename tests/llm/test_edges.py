"""Every query over nulls in any column, empty and very long texts, ties, repeated rows, clashing columns, and an empty table."""

import hashlib
import math

import pytest

from failcast.llm import queries, tokens

TEXTS = [None, "", " ", "\n" * 3000, "w" * 200_000, " " * 200_000, "ab1 " * 60_000, "tie tie tie", "tie tie tie", "é\U0001f600\x0b\x00end"]
ALL = TEXTS + TEXTS[7:9]
VECTORS = [(0, [0.5] * 8, 1), (0, [0.5] * 8, 1), (None, [0.25] * 8, None), (1, None, 1), (2, [0.5, None] * 4, 2), (3, [math.nan] * 8, 3), (4, [], 4), (5, [1.0, 2.0], None)]
ITEMS = [(0, "TIE, tie"), (0, "end"), (None, "ab1"), (1, None), (2, "")]
TURNS = [(0, 0, "user", "hello there"), (0, 1, "assistant", "word " * 3000), (0, 1, None, None), (None, None, "assistant", ""), (1, 0, "assistant", "tie"), (1, 0, "assistant", "tie")]
EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def places(spark, docs_of, tmp_path_factory):
    out = {}
    for kind, texts in (("full", ALL), ("empty", [])):
        place = str(tmp_path_factory.mktemp(kind))
        ids = [None if i == 9 else i % 10 for i in range(len(texts))]
        sources = [None if i % 3 == 0 else "s" for i in range(len(texts))]
        docs_of(texts, ids=ids, sources=sources).write.parquet(f"{place}/documents.parquet")
        some = lambda rows: rows if texts else []  # noqa: B023, E731
        labels = [(0, 1, 1), (1, 0, None), (2, None, 1), (None, 1, 1), (2, 1, 0)]
        spark.createDataFrame(some(labels), "doc_id long, toxic int, quality int").write.parquet(f"{place}/labels.parquet")
        spark.createDataFrame(some([(*v, "x") for v in VECTORS]), "vec_id long, embedding array<float>, label int, code string").write.parquet(f"{place}/embeddings.parquet")
        spark.createDataFrame(some([(*v, "x") for v in ITEMS]), "item_id long, text string, rank string").write.parquet(f"{place}/benchmark.parquet")
        spark.createDataFrame(some([(*v, "x") for v in TURNS]), "conv_id long, turn int, role string, text string, start string").write.parquet(f"{place}/conversations.parquet")
        out[kind] = place
    return out


def of(rows, doc_id):
    return [r for r in rows if r.doc_id == doc_id]


#: What the rows of the null text (id 0, one of two) and of the empty one (id 1, one of two) must say, with ids 0 and 1 also those of the ties.
VALUES = {
    "op1_fingerprints": lambda rows: sorted(r.n_chars for r in of(rows, 0)) == [0, 11] and of(rows, 3)[0].n_chars == 3000,
    "op2_licenses": lambda rows: all(r.n_licensed == 0 and r.families == "" for r in rows) and of(rows, 3)[0].n_paragraphs == 3001,
    "op3_suffix_dedup": lambda rows: sorted((r.n_bytes, r.n_removed) for r in of(rows, 0)) == [(0, 0), (11, 0)] and of(rows, 5)[0].n_bytes == 200_000,
    "op4_media": lambda rows: sorted(r.payload_bytes for r in of(rows, 0)) == [192, 192] and of(rows, 3)[0].payload_bytes == 3072,
    "op6_simhash": lambda rows: any(r.fingerprint == "0" * 16 for r in of(rows, 0)) and len({r.fingerprint for r in of(rows, 7) + of(rows, 8)}) == 1,
    "op8_toxicity": lambda rows: all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows),
    "op9_mixing": lambda rows: sorted(r.size for r in of(rows, 0)) == [0, 3] and all(r.taken <= 2 * r.size for r in rows),
    "op10_line_dedup": lambda rows: any((r.n_lines, r.n_dropped, r.kept_sha256) == (1, 0, EMPTY) for r in of(rows, 0)) and of(rows, 3)[0].n_lines == 3001,
    "op11_vector_codes": lambda rows: sorted(str(r.vec_id) for r in rows) == ["0", "0", "4", "5", "None"] and all(r.error == 0 for r in rows),
    "op12_pii": lambda rows: all(r.n_email == r.n_ip == r.n_card == r.n_phone == 0 and r.spans == "" and r.base_sha256 == EMPTY for r in rows),
    "op13_search": lambda rows: {r.item_id for r in rows} == {0, None} and sorted(r.doc_id for r in rows if r.item_id == 0 and r.doc_id is not None) == [0, 1, 7, 8],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_edges(spark, places, name):
    run = queries.QUERIES[name]
    rows = run(spark, places["full"]).collect()
    encode = tokens.encoder(tokens.default_path())
    if name == "op7_token_counts":
        assert sum(r.n_docs for r in rows) == len(ALL)
    elif name == "op5_packing":
        assert sum(r.length for r in rows) == sum(len(encode(t or "")) + 1 for t in ALL)
    elif name == "conversation_packing":
        assert sum(r.length for r in rows) == sum(len(encode(t or "")) + 1 for _, _, _, t in TURNS)
        assert sum(r.loss_tokens for r in rows) == sum(len(encode(t or "")) + 1 for _, _, role, t in TURNS if role == "assistant")
    elif name not in ("op11_vector_codes", "op13_search"):
        assert len(rows) == len(ALL)
    assert VALUES.get(name, lambda rows: True)(rows)
    assert run(spark, places["empty"]).count() == 0


def test_pipeline_edges(spark, places):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, places["full"]).collect()
    assert rows and all(r.length > 0 and r.start + r.length <= r.doc_tokens for r in rows)
    assert corpus_pipeline.run(spark, places["empty"]).count() == 0
