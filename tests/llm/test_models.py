"""Toxicity, licences, neighbours and mixing."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstrata.llm import licences, mixing, neighbours, toxicity
from clickstrata.llm.common import workspace


@pytest.fixture(scope="module")
def toxic_tables(spark):
    draw = random.Random(8)
    bad = ["idiot", "moron", "worthless"]
    rows, labels = [], []
    for i in range(500):
        words = [f"{draw.choice('abcdefg')}{draw.choice(['lo', 'ra', 'ti', 'mun'])}{draw.randrange(40)}" for _ in range(60)]
        toxic = int(i % 4 == 0)
        if toxic:
            words[draw.randrange(60)] = draw.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([*labels, (None, 1), (3000, 1), (7, None)], "doc_id bigint, toxic int")
    return docs, labels


@pytest.fixture(scope="module")
def model(toxic_tables):
    docs, labels = toxic_tables
    return toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))


def test_held_out_labels_are_met(toxic_tables, model):
    docs, labels = toxic_tables
    scored = toxicity.score_documents(docs, model).join(labels, "doc_id").where("toxic IS NOT NULL")
    rows = scored.where("held_out").collect()
    assert len(rows) > 90
    assert sum(r.predicted == r.toxic for r in rows) > 0.95 * len(rows)
    assert {r.held_out for r in scored.collect()} == {True, False}


def test_misspellings_share_grams(model):
    clean, near, word = (
        model.score(toxicity.lower_words("alo1 bra2 cti3 " + w)) for w in ("emun7", "idioot", "idiot")
    )
    assert word > near > clean


def test_scores_of_a_table(rows_of, model):
    docs = rows_of([(1, None), (2, ""), (None, "idiot"), (4, "alo1 " * 50_000 + "Idiot"), (4, "!")], ["score"])
    found = toxicity.score_documents(docs, model).collect()
    assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found if r.doc_id in (1, 2)} == {model.score([])}
    kept = toxicity.drop_toxic(docs, model).collect()
    assert len(kept) == sum(r.predicted == 0 for r in found)
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_fit_holds_no_words_in_the_driver(spark, rows_of):
    words = [f"w{i:04d}" for i in range(3000)]
    rows = [(i, " ".join(words[(i * 7 + k * 11) % 3000] for k in range(400))) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id bigint, toxic int")
    docs, settings = rows_of(rows), toxicity.Settings(passes=1)
    tracemalloc.start()
    try:
        toxicity.fit(docs, labels, settings)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8e6  # as objects in the driver, the words of the windows took five times that


def test_no_labels_make_a_model_that_rejects_nothing(toxic_tables):
    docs, labels = toxic_tables
    assert toxicity.fit(docs, labels.limit(0)).score([b"idiot"]) < toxicity.THRESHOLD


def test_licence_notices_are_named(spark, rows_of):
    plain = [(i, f"Line {i} of words.\nAnother one about {i} things") for i in range(60)]
    notices = list(licences.notices(spark).collect())
    rows = plain + [(1000 + i, f"Some text.\n{r.text}\nMore.") for i, r in enumerate(notices)]
    rows += [(2000, "A driving licence costs money.\nThe museum has the copyright."), (2001, None), (2002, "")]
    rows += [(2003, "word " * 30_000 + notices[0].text), (None, notices[0].text), (1000, rows[60][1])]
    docs = rows_of(rows, ["families", "row"])
    model = licences.train(docs)
    found = licences.scan_licences(docs, model).collect()
    assert len(found) == len(rows)
    families = defaultdict(list)
    for r in found:
        families[r.doc_id].append(r.families)
    for i, r in enumerate(notices):
        assert set(families[1000 + i]) == {r.family}, r.text
    assert len(families[1000]) == 2 and families[2003] == families[None] == ["apache-2.0"]
    assert all(families[i] == [""] for i in [*range(60), 2000, 2001, 2002])
    assert all((r.probability is None) == (r.families == "") for r in found)
    assert licences.scan_licences(docs.limit(0), model).count() == 0


WRAPPED = {
    "mit": """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to
the following conditions:""",
    "bsd": """Redistribution and use in source and binary
forms, with or without modification, are
permitted provided that the following
conditions are met:
1. Redistributions of source code must retain
   the above copyright notice.""",
    "gpl": """This program is free software: you can
redistribute it and/or modify it under the
terms of the GNU General Public License as
published by the Free Software Foundation,
either version 3 of the License, or
(at your option) any later version.""",
    "cc-by": "Distributed under CC BY 4.0",
}


def test_wrapped_and_hintless_notices_are_named(spark, rows_of):
    plain = [(i, f"Line {i} of words.\nAnother one about {i} things") for i in range(60)]
    rows, expected = [], {}
    for i, (family, text) in enumerate(WRAPPED.items()):
        for j, mark in enumerate(("", "# ", " * ", "dnl ")):
            marked = "\n".join((mark + line).rstrip() for line in text.split("\n"))
            rows.append((100 + 10 * i + j, f"int x;\n{mark.rstrip()}\n{marked}\n\nOther words"))
            expected[rows[-1][0]] = family
    rows += [(200, "This is under the GNU GPL v3"), (201, "cc cc cc\n\nsoftware"), (202, "ccx")]
    expected |= {200: "gpl", 201: "", 202: ""}
    docs = rows_of(plain + rows)
    found = licences.scan_licences(docs, licences.train(docs)).collect()
    assert len(found) == len(plain) + len(rows)
    named = {r.doc_id: r.families for r in found}
    assert {i: named[i] for i in expected} == expected and not any(named[i] for i in range(60))


def test_no_confirmed_text_is_without_a_hint_word():
    hints = set(licences.hint_words())
    for text in (t for texts in licences.NOTICES.values() for t in texts):
        words = re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())
        pairs = set(zip(words, words[1:], strict=False))
        without = [p for p in pairs if not hints.intersection(p)]
        assert len(without) < licences.CONFIRMED * len(pairs), text


def brute_neighbours(rows, asked, k):
    usable = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = min(usable.get(i, v), v)
    out = []
    for q in sorted(asked & set(usable)):
        away = sorted(
            (float(np.sqrt(sum((a - b) ** 2 for a, b in zip(usable[q], v, strict=True)))), i)
            for i, v in usable.items()
            if i != q and len(v) == len(usable[q])
        )
        out += [(q, rank, i) for rank, (_, i) in enumerate(away[:k], 1)]
    return out


def test_factor_one_is_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 150)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.integers(0, 5, 3)]) for i in range(500)]
    rows += [(600 + i, [1.0, 2.0, 3.0]) for i in range(300)]  # one common vector
    rows += [(1000, None), (1001, [0.0, 0.0, 0.0]), (1002, [1.0, None, 2.0]), (1003, [1.0, float("nan"), 2.0])]
    rows += [(1010, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (1020, [1.0, 2.0]), (1030, [2.0, 2.0])]
    rows += [rows[10], (10, [9.0, 9.0, 9.0]), (1040, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("x"))
    asked = F.col("vec_id") % 10 == 0
    with workspace(spark, "test") as work:
        usable = work.written(neighbours.usable(table), "vectors")
        index = neighbours.build_index(usable, work, 150)
        assert index.count() > 5
        found = neighbours.search(index, usable.where(asked), 10, 1.0, 30).collect()
    expected = brute_neighbours(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 10)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == expected
    assert neighbours.nearest_neighbours(table.limit(0), asked).count() == 0


def test_recall_of_the_chosen_factor(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table.collect()]
    found = neighbours.nearest_neighbours(table, F.col("vec_id") % 100 == 0).collect()
    expected = {(q, i) for q, _, i in brute_neighbours(rows, {i for i, _ in rows if i % 100 == 0}, 10)}
    assert len({(r.query_id, r.vec_id) for r in found} & expected) >= 0.9 * len(expected)


def mixed_rows(docs, **settings):
    return mixing.mix_sources(docs, **settings).collect()


def test_every_prefix_keeps_the_weights(spark):
    counts = {"a": 700, "b": 320, "c": 90, None: 40}
    rows = [(i, s, "en") for s, n in counts.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, mix_slot string")
    weights = {"a": 5, "b": 3, "c": 1, None: 1}
    rows = mixed_rows(docs, weights=weights, block_rows=10, period=50)
    assert len(rows) == sum(counts.values())
    blocks = {(r.source, r.mix_block): r for r in rows}
    slots = {r.mix_slot: key for key, r in blocks.items()}
    assert len(slots) == len(blocks) and len({r.mix_order for r in rows}) == len(rows)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    full = Counter((r.source, r.mix_block) for r in rows)
    assert max(full.values()) == 10
    horizon = min(s for s in range(10**6) if s not in slots or full[slots[s]] < 10)
    assert all(r.on_target == (r.mix_slot < horizon) for r in rows) and horizon > 30
    parts = {r.key: r.parts for r in mixing.source_parts(docs, weights, 50).collect()}
    assert sum(parts.values()) == 50
    taken = Counter()
    for slot in range(horizon):
        taken[slots[slot][0]] += 1
        for source in counts:
            share = parts["null" if source is None else f"={source}"] / 50
            assert abs(taken[source] - share * (slot + 1)) < 1


def test_mixing_numbers_large_sources_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 37)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"))
    rows = mixed_rows(docs.unionByName(docs.limit(5)), block_rows=8)
    assert sorted(r.mix_order for r in rows) == list(range(1005))


def test_mixing_edges(spark):
    docs = spark.createDataFrame([(None, None), (1, "a"), (1, "a")], "doc_id bigint, source string")
    assert len({r.mix_order for r in mixed_rows(docs)}) == 3
    assert mixed_rows(docs.limit(0)) == []
    with pytest.raises(ValueError, match="longer period"):
        mixing.source_parts(spark.range(9).select(F.col("id").alias("source")), period=8)


@pytest.mark.parametrize(
    "weights",
    [
        {"s0": 0.9} | {f"s{i}": 0.1 / 19 for i in range(1, 20)},
        {"s0": 0.9} | {f"s{i}": 0.005 for i in range(1, 19)} | {"s19": 0.01},
        {"s0": 5, "s1": 3, "s2": 0.00001, "s3": 0},
        None,
    ],
)
def test_prefixes_keep_the_given_weights(spark, weights):
    counts = {f"s{i}": 3000 if i == 0 else 40 + 31 * i for i in range(20 if not weights else len(weights))}
    rows = [(i, s) for s, n in counts.items() for i in range(n)]
    rows = mixed_rows(spark.createDataFrame(rows, "doc_id bigint, source string"), weights=weights, block_rows=2)
    assert len(rows) == sum(counts.values())
    blocks = {(r.source, r.mix_block): r for r in rows}
    slots = {r.mix_slot: r for r in blocks.values()}
    assert len(slots) == len(blocks) and len({r.mix_order for r in rows}) == len(rows)
    wanted = weights or {s: n**0.5 for s, n in counts.items()}
    total, taken, slot = sum(wanted.values()), Counter(), 0
    while slot in slots and slots[slot].on_target:
        taken[slots[slot].source] += 1
        slot += 1
        assert all(abs(taken[s] - w / total * slot) < 1 for s, w in wanted.items())
    assert slot > 90 and not any(r.on_target for r in rows if r.mix_slot >= slot)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows if wanted[r.source])
    idle = [r.mix_slot for r in rows if not wanted[r.source]]
    assert not idle or min(idle) > max(r.mix_slot for r in rows if wanted[r.source])


#: Lines as people write them, none of them a notice word for word.
LINES = [
    ("// SPDX-License-Identifier: MIT", "mit"),
    ("# SPDX-License-Identifier: GPL-3.0-or-later", "gpl"),
    (" * SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("MIT License", "mit"),
    ("This software is released under the MIT license", "mit"),
    ("Released under the Apache License 2.0", "apache-2.0"),
    (
        "This program is free software: you can redistribute it and/or modify\n"
        "# it under the terms of the GNU Affero General Public License as\n"
        "# published by the Free Software Foundation, either version 3",
        "agpl",
    ),
    (
        "This program is free software: you can redistribute it and/or modify\n"
        "it under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation, either version 3 of the License, or",
        "gpl",
    ),
    ("Licensed under the GNU AGPL v3", "agpl"),
    ("SPDX-License-Identifier: AGPL-3.0-only", "agpl"),
    (
        "Permission to use, copy, modify, and/or distribute this software for any\n"
        "purpose with or without fee is hereby granted, provided that the above\n"
        "copyright notice and this permission notice appear in all copies.",
        "isc",
    ),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    (
        "This program and the accompanying materials are made available under the\n"
        "terms of the Eclipse Public License 2.0 which is available at",
        "epl-2.0",
    ),
    ("Licensed under the EUPL, Version 1.2 or later", "eupl-1.2"),
    ("Distributed under the Boost Software License, Version 1.0. (See file LICENSE_1_0.txt)", "bsl-1.0"),
    ("Licensed under the Mozilla Public License 2.0", "mpl-2.0"),
    ("The driving licence was lost under the bridge.", ""),
    ("The public library lends software under its own terms.", ""),
]


def test_licence_lines_in_use(spark, rows_of):
    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(i, text) for i, (text, _) in enumerate(LINES)]
    found = licences.scan_licences(rows_of(rows), licences.train(plain)).collect()
    assert {r.doc_id: r.families for r in found} == {i: name for i, (_, name) in enumerate(LINES)}


def test_ordinary_pieces_hold_whole_lines_once(spark, rows_of, monkeypatch):
    """Repeated and hinted lines, and lines of many pieces; the smallest hashes of all pieces."""
    long = " ".join(f"w{i}" for i in range(300))
    docs = rows_of([(i, "same line\n\nan mit license") for i in range(400)] + [(1000, long), (1001, None), (1002, "")])
    pieces = [r.words for r in licences._ordinary_pieces(docs).collect()]
    assert ["same", "line"] in pieces and len(pieces) == 1 + 9
    assert {w for p in pieces for w in p} == {"same", "line", *long.split()}
    monkeypatch.setattr(licences, "ORDINARY_ROWS", 3)
    assert len(licences._ordinary_pieces(docs).collect()) <= 3
    assert licences._ordinary_pieces(docs.limit(0)).collect() == []
