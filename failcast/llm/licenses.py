"""Licence scans of paragraphs: a trained classifier with a calibrated unknown class.

A sparse logistic regression over word 1- and 2-grams, trained here on the templates below,
on cut and noised copies of them and on counter-examples (other licences, other versions,
negations, prose), gives every paragraph (line) a probability for each licence family and for
"unknown". A temperature fitted on copies and counter-examples that were not trained on
calibrates the probabilities. A prediction stands only if the paragraph also
agrees with one of the family's templates: the weight of the word pairs they share, divided by the
smaller of both weights, is at least ``AGREE``. A pair weighs less the more families' templates
have it. A family of one version needs that version in the paragraph.

Only grams of the templates can speak for a family; what counter-examples add, and ``DENYING``
words, can only speak for the unknown class. Grams of ``ORDINARY`` words alone are no features,
and ``EVERYDAY`` words (some are words of other languages) only in pairs. So a paragraph without any word or pair of
``marks`` is unknown whatever else it says, and only paragraphs with one are scored: the SQL
counterpart scores all of them. Scanning is DataFrame functions alone; the weights, whose
number follows from the templates and examples, are a small literal table.

Defined cases: a null or empty text is one empty paragraph and has no licence; rows that
repeat an id each give a row, with the findings in all of that id's different paragraphs;
a null ``doc_id`` is an id; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.llm.common import LOWER, UPPER, ascii_lower, documents, whole_text, written

UNKNOWN = "unknown"
AGREE = 0.6
SURE = 0.5
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"

# Words that any prose has.
ORDINARY = frozenset(
    "a all also an and any are as at be been but by can do for from had has have he her his if in into is it its may no not of off on one or other our out she should so some such than that the their them then there these they this those to under up use used was we were what when where which who will with would you your".split()
)

# Words of the templates that everyday texts have too.
EVERYDAY = frozenset(
    "associated author binary charge compliance conditions confidential copy deal details distributed document documentation example except extent file files following form forms found free general governed granted hereby identifier law library mit modification modify number obtaining part permission permitted person possible prior program project provided public publication published publisher received related restriction rights see software source style subject terms text version work written 1.0 2 2.0 2.1 2024 3 4.0 v".split()
)

# Ordinary words that are features all the same; they speak for the unknown class alone.
DENYING = ("cannot", "neither", "never", "no", "nor", "not", "without")

# What the paragraph must have for a family of one version.
VERSIONS = {"apache-2.0": ("2.0", "apache-2.0"), "mpl-2.0": ("2.0", "mpl-2.0")}

# Customary licence statements by family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
        "This project is licensed under the terms of the Apache 2.0 license.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the MIT license, see the LICENSE file for details.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GPL, version 2 or later.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is distributed under the terms of the GNU Affero General Public License.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc0": (
        "Released under CC0 1.0 Universal, public domain dedication.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2024 Example Corporation. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.",
        "This document is proprietary and confidential.",
    ),
}

# Licences of no family, by the names they are granted under.
OTHER_LICENCES = (
    "Eclipse Public License, version 2.0",
    "Apache License, Version 1.1",
    "Mozilla Public License, Version 1.1",
    "Artistic License 2.0",
    "Boost Software License, Version 1.0",
    "zlib License",
    "European Union Public Licence, version 1.2",
    "CC BY-ND 4.0",
    "CC BY-NC-ND 4.0",
    "Creative Commons Attribution-NoDerivatives 4.0 International License",
    "Common Development and Distribution License, version 1.0",
    "Academic Free License, version 3.0",
    "SIL Open Font License, Version 1.1",
    "Microsoft Public License",
    "Open Database License",
    "Q Public License, version 1.0",
)
GRANTS = ("Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This project is licensed under the terms of the {}.", "This software is distributed under the {}.", "SPDX-License-Identifier: {}")
NAMED = ("Apache License, Version 2.0", "MIT License", "MIT license", "BSD 3-Clause License", "GNU General Public License, version 3", "GPL, version 2", "GNU Lesser General Public License", "GNU Affero General Public License", "Mozilla Public License, Version 2.0", "CC BY 4.0", "CC BY-SA 4.0", "CC BY-NC 4.0", "CC0 1.0 Universal")
DENIALS = ("This work is not licensed under the {}.", "The code is not released under the {}.", "The project is no longer licensed under the {}.", "It was never released under the {}.", "This is not {}.", "The files are not available under the {}.", "We chose not to use the {}.", "It is not under the {}.")

# Sentences that have a word of licences and grant nothing.
COUNTER_EXAMPLES = (
    "Er kommt mit dem Zug und mit uns.",
    "Mit und mit der Zeit.",
    "Mit einer Frau und mit einem Kind.",
    "The MIT campus is near the river.",
    "The GNU project was announced long ago.",
    "Apache is the name of a people.",
    "Creative people work in the commons.",
    "The software was released last year.",
    "Use the source file in the directory.",
    "Read the text file for details.",
    "Permission denied while reading the file.",
    "All rights and duties pass to the buyer.",
    "The rights of all persons are protected by law.",
    "The driver lost his license after the accident.",
    "A fishing licence costs twenty pounds a year.",
    "Copyright law is taught in the second year.",
    "She asked for permission to leave the room early.",
    "The warranty on the washing machine ran out last week.",
    "The police had a warrant to search the house.",
    "Gnus graze on the plain in large herds.",
    "The charity redistributes food to families in need.",
    "He is a licensed plumber and works in the city.",
    "The debate over software licenses went on for years.",
    "Poetic license allows the author to bend the facts.",
    "The council refused the bar a license to serve alcohol.",
    "The song entered the public domain many decades ago.",
    "Without permission nobody may enter the laboratory.",
    "The proprietary blend of spices is a family secret.",
    "License plates must be visible from behind.",
    "Redistribution of wealth was the topic of the lecture.",
    "The apache helicopter landed near the village.",
    "Students at MIT built a small robot.",
    "Which license should a new project choose?",
)

# Words that noise is made of.
FILLER = "time people way water day part place year work week number point home room area money story fact month lot right study book eye job word business issue side kind head house service friend father power hour game line end member law car city name".split()


def tokens(text: str) -> list[str]:
    import re

    return re.findall(TOKEN, text.translate(str.maketrans(UPPER, LOWER)))


def grams(found: list[str]) -> set[str]:
    return set(found) | {f"{a} {b}" for a, b in zip(found, found[1:], strict=False)}


def counter_statements(held: bool) -> list[str]:
    """Grants of licences of no family and denials of those of families; every fourth is held out of training."""
    every = [g.format(x) for x in OTHER_LICENCES for g in GRANTS] + [d.format(x) for x in NAMED for d in DENIALS]
    return [x for i, x in enumerate(every) if ((i + i // len(DENIALS)) % 4 == 3) == held]


def _examples(rng: random.Random, per_template: int, held: bool) -> list[tuple[list[str], str]]:
    out = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            whole = tokens(text)
            out += [(whole, family)] * 4
            for _ in range(per_template):
                cut = list(whole)
                if len(cut) > 12:
                    a = rng.randrange(len(cut) - 9)
                    cut = cut[a : a + rng.randint(10, len(cut) - a)] if len(cut) - a > 10 else cut
                cut = [w for w in cut if rng.random() > 0.06] or list(whole)
                for _ in range(rng.choice([0, 0, 1, 3])):
                    cut.insert(rng.choice([0, len(cut)]), rng.choice(FILLER))
                out.append((cut, family))
    every = [w for texts in TEMPLATES.values() for t in texts for w in tokens(t)]
    for text in (*COUNTER_EXAMPLES, *counter_statements(held)):
        out += [(tokens(text), UNKNOWN)] * 2
        for _ in range(per_template // 4):
            out.append(([rng.choice(FILLER) for _ in range(rng.randint(0, 8))] + tokens(text) + [rng.choice(FILLER) for _ in range(rng.randint(0, 8))], UNKNOWN))
    for _ in range(40 * per_template):
        out.append(([rng.choice(every) if rng.random() < 0.25 else rng.choice(FILLER) for _ in range(rng.randint(3, 40))], UNKNOWN))
    return out


@lru_cache(maxsize=1)
def trained() -> tuple[list[str], dict[str, list[float]], list[float]]:
    """Classes, weights of each gram by class, intercepts; temperature is worked in. The same on every machine."""
    rng = random.Random(2)
    classes = [*TEMPLATES, UNKNOWN]
    learn, held = _examples(rng, 12, False), _examples(rng, 4, True)
    texts = [t for texts in TEMPLATES.values() for t in texts] + [*COUNTER_EXAMPLES, *counter_statements(False)]
    plain = ORDINARY | set(DENYING)
    vocabulary = sorted(g for g in set().union(*(grams(tokens(t)) for t in texts)) if g in DENYING or g not in EVERYDAY and not plain.issuperset(g.split()))
    place = {g: i for i, g in enumerate(vocabulary)}

    def matrix(rows: list[tuple[list[str], str]]) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.zeros((len(rows), len(vocabulary) + 1)), np.zeros(len(rows), int)
        for i, (found, family) in enumerate(rows):
            own = grams(found)
            for g in own & place.keys():
                x[i, place[g]] = 1 / np.sqrt(len(own))
            x[i, -1] = 1
            y[i] = classes.index(family)
        return x, y

    x, y = matrix(learn)
    w, moved = np.zeros((x.shape[1], len(classes))), np.zeros((x.shape[1], len(classes)))
    one = np.eye(len(classes))[y]
    of_templates = set().union(*(grams(tokens(t)) for own in TEMPLATES.values() for t in own))
    against = [i for g, i in place.items() if g in DENYING or g not in of_templates]
    for _ in range(200):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        moved = 0.9 * moved - 1.5 * (x.T @ (p - one) / len(x) * 4 + 1e-4 * w)
        w += moved
        w[against, :-1] = np.minimum(w[against, :-1], w[against, -1:])
    hx, hy = matrix(held)

    def loss(t: float) -> float:
        z = hx @ w / t
        z -= z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), hy]))

    w = np.round(w / min((0.4, 0.6, 0.8, 1.0, 1.25, 1.6, 2.0, 2.5, 3.0), key=loss), 4)
    return classes, {g: w[i].tolist() for g, i in place.items()}, w[-1].tolist()


def _weights(spark: SparkSession) -> DataFrame:
    _, weights, _ = trained()
    rows = ", ".join(f"('{g}', array({', '.join(f'{x}D' for x in w)}))" for g, w in weights.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(gram, w)")


@lru_cache(maxsize=1)
def template_pairs() -> tuple[list[tuple[str, int, int, float]], dict[str, float]]:
    """(pair, family, template, the template's whole weight) and every pair's weight: 1 less the share of other families that have it, squared."""
    own = {(f, k): sorted({f"{a} {b}" for a, b in zip(tokens(t), tokens(t)[1:], strict=False)} or set(tokens(t))) for f, texts in enumerate(TEMPLATES.values()) for k, t in enumerate(texts)}
    families: dict[str, set[int]] = {}
    for (f, _), pairs in own.items():
        for p in pairs:
            families.setdefault(p, set()).add(f)
    weight = {p: round((1 - (len(x) - 1) / len(TEMPLATES)) ** 2 / len(x), 6) for p, x in families.items()}
    return [(p, f, k, round(sum(weight[x] for x in pairs), 6)) for (f, k), pairs in own.items() for p in pairs], weight


def _templates(spark: SparkSession) -> DataFrame:
    rows, weight = template_pairs()
    values = ", ".join(f"('{p}', {f}, {k}, {t}D, {weight[p]}D)" for p, f, k, t in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(gram, family, template, t_weight, weight)")


@lru_cache(maxsize=1)
def marks() -> tuple[list[str], list[str]]:
    """Words and pairs that weigh more for some family than for the unknown class: no other can lift a paragraph out of it."""
    found = [g for g, w in trained()[1].items() if max(w[:-1]) > w[-1]]
    return [g for g in found if " " not in g], [g for g in found if " " in g]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(TOKEN), F.lit(0))


def pairs_of(words: Column) -> Column:
    """The different pairs of neighbours in an array of words."""
    at = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))))


def _marked(text: Column) -> Column:
    singles, pairs = marks()
    literal = lambda x: F.array(*[F.lit(g) for g in x])
    # Pairs are made only where a line has the first word of one.
    heads = sorted({p.split()[0] for p in pairs})

    def any_of(words: Column) -> Column:
        return F.arrays_overlap(words, literal(singles)) | (F.arrays_overlap(words, literal(heads)) & F.arrays_overlap(pairs_of(words), literal(pairs)))

    # As an element of an array the words are made once.
    return F.exists(F.array(words_of(text)), any_of)


def candidate_paragraphs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, line): the lines that have a word with a weight of its own; all others are unknown."""
    lines = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("paragraph", "line"))
    return lines.where(_marked(F.col("line")))


def classify(paragraphs: DataFrame) -> DataFrame:
    """(key..., line) -> key, family, probability, similarity, confirmed; keys are all columns but ``line``."""
    spark = paragraphs.sparkSession
    classes, _, start = trained()
    keys = [c for c in paragraphs.columns if c != "line"]
    texts = paragraphs.select("line").distinct()  # many documents share a statement
    words = written(texts.withColumn("words", words_of(F.col("line"))))
    pairs = words.withColumn("pairs", pairs_of(F.col("words")))
    pairs = pairs.withColumn("pairs", F.when(F.size("pairs") > 0, F.col("pairs")).otherwise(F.array_distinct("words"))).withColumn("all", F.array_distinct(F.array_union("words", "pairs")))
    n = len(classes)
    hits = pairs.select("line", F.size("all").alias("n_grams"), F.explode("all").alias("gram")).join(F.broadcast(_weights(spark)), "gram")
    sums = hits.groupBy("line", "n_grams").agg(*[F.sum(F.element_at("w", j + 1)).alias(f"s{j}") for j in range(n)])
    scored = pairs.select("line", F.size("all").alias("n_grams")).join(sums.drop("n_grams"), "line", "left")
    logits = [F.round(F.coalesce(F.col(f"s{j}"), F.lit(0.0)) / F.sqrt(F.greatest("n_grams", F.lit(1))) + start[j], 6) for j in range(n)]
    z = scored.select("line", F.array(*logits).alias("z"))
    z = z.withColumn("top", F.array_max("z")).withColumn("k", (F.array_position("z", F.col("top")) - 1).cast("int"))
    p = z.select("line", "k", (1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"))
    own = pairs.select("line", F.explode("pairs").alias("gram"))
    known = F.broadcast(_templates(spark))
    each = known.select("gram", "weight").distinct()
    # Pairs that no template has weigh 1.
    size = own.join(F.broadcast(each), "gram", "left").groupBy(F.col("line").alias("of")).agg(F.sum(F.coalesce("weight", F.lit(1.0))).alias("p_weight"))
    overlap = own.join(known, "gram").groupBy("line", "family", "template", "t_weight").agg(F.sum("weight").alias("n")).join(size, F.col("line") == F.col("of"))
    best = overlap.groupBy("line", F.col("family").alias("k")).agg(F.max(F.round(F.col("n") / F.least("p_weight", "t_weight"), 6)).alias("similarity"))
    name = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("k") + 1)
    judged = p.join(best, ["line", "k"], "left").withColumn("family", F.when(F.col("probability") >= SURE, name).otherwise(F.lit(UNKNOWN)))
    judged = judged.join(pairs.select(F.col("line").alias("__line"), "words"), F.col("line") == F.col("__line"))
    versioned = F.lit(True)
    for f, versions in VERSIONS.items():
        versioned = versioned & ((F.col("family") != f) | F.arrays_overlap("words", F.array(*[F.lit(v) for v in versions])))
    judged = judged.select("__line", "family", "probability", F.coalesce("similarity", F.lit(0.0)).alias("similarity"), versioned.alias("versioned"))
    judged = judged.withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("similarity") >= AGREE) & F.col("versioned"))
    return paragraphs.join(judged, F.col("line") == F.col("__line")).select(*keys, "line", "family", "probability", "similarity", "confirmed")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, n_licensed, n_unconfirmed long, families string, least_probability, least_similarity): one row for each row of ``docs``."""
    judged = classify(written(candidate_paragraphs(docs, id_col=id_col, text_col=text_col).distinct()))
    of_doc = judged.groupBy("doc_id").agg(
        F.count_if("confirmed").alias("n_licensed"),
        F.count_if((F.col("family") != UNKNOWN) & ~F.col("confirmed")).alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
        F.round(F.min(F.when(F.col("confirmed"), F.col("probability"))), 3).alias("least_probability"),
        F.round(F.min(F.when(F.col("confirmed"), F.col("similarity"))), 3).alias("least_similarity"),
    )
    of_doc = of_doc.withColumnRenamed("doc_id", "of")
    all_docs = docs.select(F.col(id_col).alias("doc_id"), F.size(F.split(whole_text(text_col), "\n")).cast("long").alias("n_paragraphs"))
    out = all_docs.join(of_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left").drop("of")
    return out.na.fill(0, ["n_licensed", "n_unconfirmed"]).na.fill("", ["families"])


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir).select("doc_id", "text"))


def oracle_sql() -> str:
    """The scan as DuckDB SQL, with the trained weights as a literal table."""
    classes, weights, start = trained()
    n = len(classes)
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    w_rows = ", ".join(f"({quote(g)}, [{', '.join(f'{x}::DOUBLE' for x in w)}])" for g, w in weights.items())
    rows, weight = template_pairs()
    t_rows = [f"({quote(p)}, {f}, {k}, {t}::DOUBLE, {weight[p]}::DOUBLE)" for p, f, k, t in rows]
    versioned = " AND ".join(f"(family <> '{f}' OR list_has_any(words, [{', '.join(map(quote, v))}]))" for f, v in VERSIONS.items())
    sums = ", ".join(f"sum(w[{j + 1}]) AS s{j}" for j in range(n))
    logits = ", ".join(f"round(coalesce(s{j}, 0.0) / sqrt(greatest(len(a), 1)) + {start[j]}::DOUBLE, 6)" for j in range(n))
    names = ", ".join(quote(c) for c in classes)
    return f"""
WITH weights(gram, w) AS (VALUES {w_rows}),
templates(gram, family, template, t_weight, weight) AS (VALUES {", ".join(t_rows)}),
paragraphs AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
tokenised AS (
  SELECT line, regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '{TOKEN}') AS words
  FROM (SELECT DISTINCT line FROM paragraphs)),
paired AS (
  SELECT line, words, list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, greatest(len(words), 1))]) AS p FROM tokenised),
gathered AS (
  SELECT line, words, CASE WHEN len(p) > 0 THEN p ELSE words END AS p, list_distinct(list_concat(words, p)) AS a FROM paired),
sums AS (
  SELECT line, {sums} FROM (SELECT line, unnest(a) AS gram FROM gathered) JOIN weights USING (gram) GROUP BY line),
logits AS (SELECT gathered.line, [{logits}] AS z FROM gathered LEFT JOIN sums USING (line)),
picked AS (
  SELECT line, list_position(z, list_max(z)) - 1 AS k,
         1 / list_sum([exp(x - list_max(z)) FOR x IN z]) AS probability FROM logits),
own AS (SELECT line, unnest(list_distinct(p)) AS gram FROM gathered),
sizes AS (
  SELECT line, sum(coalesce(weight, 1.0)) AS p_weight
  FROM own LEFT JOIN (SELECT DISTINCT gram, weight FROM templates) USING (gram) GROUP BY line),
overlap AS (
  SELECT line, family, template, round(sum(weight) / least(any_value(p_weight), any_value(t_weight)), 6) AS share
  FROM own JOIN templates USING (gram) JOIN sizes USING (line)
  GROUP BY line, family, template),
best AS (SELECT line, family AS k, max(share) AS similarity FROM overlap GROUP BY line, family),
judged AS (
  SELECT picked.line, CASE WHEN probability >= {SURE} THEN ([{names}])[k + 1] ELSE '{UNKNOWN}' END AS family,
         words, probability, coalesce(similarity, 0.0) AS similarity
  FROM picked LEFT JOIN best USING (line, k) JOIN gathered USING (line)),
marked AS (
  SELECT doc_id, family, probability, similarity,
         family <> '{UNKNOWN}' AND similarity >= {AGREE} AND {versioned} AS confirmed
  FROM paragraphs JOIN judged USING (line)),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE confirmed) AS n_licensed,
         count(*) FILTER (WHERE family <> '{UNKNOWN}' AND NOT confirmed) AS n_unconfirmed,
         string_agg(DISTINCT family, ',' ORDER BY family) FILTER (WHERE confirmed) AS families,
         round(min(probability) FILTER (WHERE confirmed), 3) AS least_probability,
         round(min(similarity) FILTER (WHERE confirmed), 3) AS least_similarity
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, len(string_split(coalesce(text, ''), chr(10)))::BIGINT AS n_paragraphs,
       coalesce(n_licensed, 0)::BIGINT AS n_licensed, coalesce(n_unconfirmed, 0)::BIGINT AS n_unconfirmed,
       coalesce(families, '') AS families, least_probability, least_similarity
FROM documents d LEFT JOIN per_doc USING (doc_id)
"""
