import duckdb

from failcast.llm import licenses


# Statements that are not among the templates.
NEW_STATEMENTS = {
    "apache-2.0": ("This file is licensed under the Apache License, Version 2.0", "Distributed under the Apache 2.0 license.", "Code is available under the Apache License, Version 2.0."),
    "mit": ("This software is released under the MIT license.", "Distributed under the terms of the MIT License.", "MIT License", "Code is available under the MIT License"),
    "bsd": ("Licensed under the BSD 3-Clause License.", "Released under a BSD-style license.", "Distributed under the BSD 3-Clause License"),
    "gpl": ("Released under the GNU General Public License, version 2.", "This program is licensed under the GNU General Public License.", "Licensed under the GPL, version 3.", "This work is licensed under the GNU General Public License, version 3"),
    "lgpl": ("Released under the GNU Lesser General Public License, version 3.", "This library is licensed under the GNU Lesser General Public License."),
    "agpl": ("Released under the GNU Affero General Public License.", "This work is licensed under the GNU Affero General Public License, version 3."),
    "mpl-2.0": ("Released under the Mozilla Public License, version 2.0.", "Subject to the terms of the Mozilla Public License, v. 2.0."),
    "cc-by": ("This text is licensed under CC BY 4.0.", "Released under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Released under CC BY-SA 4.0.", "Images are licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Released under CC BY-NC 4.0.", "Images are licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc0": ("Licensed under CC0 1.0 Universal.", "Dedicated to the public domain under CC0 1.0 Universal."),
    "unlicense": ("Free and unencumbered software released into the public domain.",),
    "proprietary": ("Copyright 2019 Some Company. All rights reserved.", "This file is proprietary and confidential.", "Copyright 2021 by the authors. All rights reserved."),
}
# Other licences and versions, denials and prose.
NO_STATEMENTS = (
    "Licensed under the Eclipse Public License, version 2.0",
    "Released under the Apache License, Version 1.1.",
    "This text is not licensed under the MIT license",
    "This text is not distributed under the Apache License, Version 2.0.",
    "The images are never available under the MIT License.",
    "Licensed under CC BY-NC-ND 4.0",
    "Distributed under the Boost Software License, Version 1.0.",
    "My licence to drive a lorry expired in the spring of that year.",
    "Mit und.",
    "mit",
    "gnu",
    "Permission",
)


def judged(spark, docs_of, lines):
    rows = licenses.classify(docs_of(lines).selectExpr("doc_id", "text as line")).collect()
    return [(r.family, r.confirmed) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_families_and_counter_examples(spark, docs_of):
    want = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    got = judged(spark, docs_of, [t for _, t in want] + list(licenses.COUNTER_EXAMPLES))
    assert got[: len(want)] == [(f, True) for f, _ in want]
    assert not any(confirmed for _, confirmed in got[len(want) :])


def test_statements_that_were_not_trained_on(spark, docs_of):
    want = [f for f, texts in NEW_STATEMENTS.items() for _ in texts]
    others = [*licenses.counter_statements(True), *NO_STATEMENTS]
    got = judged(spark, docs_of, [t for texts in NEW_STATEMENTS.values() for t in texts] + others)
    right = sum(g == (f, True) for g, f in zip(got, want, strict=False))
    wrong = [g for g, f in zip(got, want, strict=False) if g[1] and g[0] != f] + [g for g in got[len(want) :] if g[1]]
    assert right >= 0.9 * len(want) and len(wrong) <= 2


def test_unmarked_paragraphs_are_unknown():
    """Whatever words and pairs a paragraph has, without a mark the unknown class leads."""
    classes, weights, start = licenses.trained()
    unknown = classes.index(licenses.UNKNOWN)
    assert all(start[unknown] > x for j, x in enumerate(start) if j != unknown)
    marked = {g for x in licenses.marks() for g in x}
    assert all(w[unknown] >= max(w) for g, w in weights.items() if g not in marked)
    assert not marked & (licenses.ORDINARY | licenses.EVERYDAY | set(licenses.DENYING))


def test_scan_equals_sql(spark, docs_of, tmp_path):
    one, two = "Released under the MIT License.", "Licensed under CC BY-NC 4.0."
    texts = [None, "", f"a\n{one}\nb", f"{one}\n{two}\n{one}", "a license to wed\nplain", "x " * 4000 + "\n" + two, "Permission", "gnu", "mit", *NO_STATEMENTS, *[x[0] for x in NEW_STATEMENTS.values()]]
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = licenses.op2_licenses(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(licenses.oracle_sql()).fetchall()
    assert sorted(map(tuple, rows.collect())) == sorted(want)
    found = {r.doc_id: (r.n_licensed, r.families) for r in rows.collect()}
    assert found[2] == (1, "mit") and found[3] == (3, "cc-by-nc,mit") and found[5] == (1, "cc-by-nc") and found[0] == (0, "")


def test_scan_finds_every_template(spark, docs_of):
    want = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    want.append(("gpl", "Released under the GPL, version 3."))
    docs = docs_of([f"Some prose.\n{t}\nThat is all of it." for _, t in want] + ["Mit und."])
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, (family, text) in enumerate(want):
        assert (rows[i].n_licensed, rows[i].families) == (1, family), text
    assert rows[len(want)].n_licensed == 0


def test_repeats_nulls_and_empty(spark, docs_of):
    assert licenses.scan(docs_of([])).count() == 0
    rows = licenses.scan(docs_of(["Released under the MIT License."] * 3, ids=[1, 1, None])).collect()
    assert [r.n_licensed for r in rows] == [1, 1, 1]


def test_no_python_in_the_plan(spark, docs_of):
    plan = licenses.scan(docs_of(["Released under the MIT License."]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
