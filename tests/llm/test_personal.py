import hashlib
import random
import re

import pytest

from failcast.llm import personal as P

BASE = {p.kind: re.compile(p.plain) for p in P.BASE}


def valid(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and P.luhn(digits) == 1
    return kind == "email" or 8 <= len(digits) <= 15


def listed(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def brute(text):
    text = text or ""
    base = [(k, *m.span()) for k, kind in enumerate(P.KINDS) for m in BASE[kind].finditer(text) if valid(kind, m.group())]
    models = P.trained()
    added = {(k, a, b) for k, kind in enumerate(P.KINDS) for _, a, b, row in P.candidates_in(text, kind) if sum(P.margin_of(t, row) for t in models[kind].trees) >= models[kind].least}
    counts = [sum(k == j for k, _, _ in base) for j in range(4)]
    return (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed({*base, *added}))


def card(start):
    return next(start + f"{i:03}" for i in range(1000) if P.luhn((start + f"{i:03}").replace(" ", "").replace("-", "")))


TRICKY = [
    "a@b.c_d@e.f and a.b@c-d.e.f. x@y z@.q @w.e r@t..y é.x@mail.de",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0255 1.2.3 10.0.0.1",
    card("4111 1111 1111 1") + " 12/27, " + card("4111-1111-1111-1") + " and " + card("4111111111111"),
    "+1 (743) 555-3824 227.5.221.1 +49 30 1234567, +1234567 +1 2 3. +",
    "write to jo.doe [at] mail1 [dot] com or jo at host dot org, jo @ shop.de\njößé.x@maüil.example.com",
    "ip 2001:db8::ff00:42:8329 at 12:30:45, server 10[.]2[.]3[.]4 mac 00:1b:44:11:3a:b7",
    "call (743) 555-3824 or 743-555-3824; tel 030/123456, order 4381893557741609 \U0001f600 0049 30 123 4567",
    "9" * 3000 + " " + "1 " * 3000 + "w" * 30_000 + "@" + "." * 3000 + "+1" + " " * 3000 + "a.b" * 3000,
    "12 34 56 78\x0b90 +1 743 \x00 12",
    "1.1.1.1 " * 700 + "x@y.z " * 700,
]


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(4)
    alphabet = ["@", ".", "-", " ", "+", "1", "23", "456", "7890", "a", "Zé", "(", ")", ":", " at ", " dot ", "[at]", "com", "/", "\n"]
    texts = [*TRICKY, None, "", *["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(300)]]
    texts += [t for kind in P.KINDS for t, _, _ in P._examples(rng, kind, 60)]
    docs = docs_of(texts)
    found = P.found_spans(docs)
    from pyspark.sql import functions as F

    got = {r.doc_id: tuple(r)[1:] for r in found.select("doc_id", *[f"n_{k}" for k in P.KINDS], F.sha2(P.listed(F.col("base")), 256), P.listed(F.col("spans"))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == brute(t), (i, (t or "")[:200])


def test_held_out_quality():
    """On examples that were neither trained nor calibrated on."""
    models = P.trained()
    for kind in P.KINDS:
        rng, found, missed, wrong = random.Random(f"test {kind}"), 0, 0, 0
        for text, a, b in P._examples(rng, kind, 800):
            got = {(s, e) for _, s, e, row in P.candidates_in(text, kind) if sum(P.margin_of(t, row) for t in models[kind].trees) >= models[kind].least}
            found, missed = found + (a >= 0 and (a, b) in got), missed + (a >= 0 and (a, b) not in got)
            wrong += sum(not (a <= s and e <= b) for s, e in got)
        assert found / (found + missed) > 0.85 and wrong / (found + wrong) < 0.04, (kind, found, missed, wrong)


@pytest.mark.parametrize("text", ["It was left on page 12 at noon, line 4 dot matrix.", "In 2024-10-12 at 12:30:45 we had 1,234,567 visits.", "Version 2.0, section 4.2.1 and 3.14159265", 'token = "7c12db9d7f6e12c"'])
def test_clean_texts_have_no_spans(text):
    assert brute(text)[-1] == ""


def test_probabilities_rise_with_margins():
    for model in P.trained().values():
        assert model.slope > 0 and model.slope * model.least / 1000 + model.start >= -1e-9


def test_redacted(spark, docs_of):
    rows = {r.doc_id: (r.text, r.n_spans) for r in P.redacted(docs_of(["mail é a@b.cd now", None, "10.0.0.1, call (743) 555-3824.", "none"])).collect()}
    assert rows[0] == ("mail é [EMAIL] now", 1) and rows[1] == ("", 0) and rows[3] == ("none", 0)
    assert rows[2][0].startswith("[IP], call") and "555" not in rows[2][0]


def test_plan_is_native(spark, docs_of):
    plan = P.found_spans(docs_of(["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
