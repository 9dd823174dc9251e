"""Licence notices in texts, found by a trained paragraph classifier; DataFrame functions only.

A sparse logistic regression on word n-grams tells licence families from each other and from
paragraphs that are no notice (``unknown``). It is trained on the notices below, each in many
versions with words left out, and on a bounded choice of ordinary paragraphs. Its probabilities
are calibrated with one temperature on versions kept from training; below ``LEAST`` a paragraph
is unknown. A prediction counts once a notice of that family confirms it: enough of the
notice's word pairs must stand in the paragraph.

Both single lines and paragraphs, the lines up to a blank one, are read, so a notice may be
wrapped. Only those are classified that a notice could confirm: the words in ``hint_words`` stand
in so many pairs of each notice that no text without one of them has enough of its pairs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm.common import workspace

UNKNOWN = "unknown"

# The short notices that public licences ask authors to use, by family.
NOTICES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF '
        "ANY KIND, either express or implied.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software.",
        "The MIT License (MIT)",
        "MIT License",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GPL, version 2 or any later version.",
        "Distributed under the GNU GPL v3.",
        "under the GNU GPL v2",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL, version 3 or any later version.",
        "Distributed under the GNU AGPL v3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related "
        "rights to this work.",
        "Released into the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, Version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "eupl-1.2": (
        "Licensed under the EUPL, Version 1.2.",
        "Licensed under the European Union Public Licence, Version 1.2.",
        "SPDX-License-Identifier: EUPL-1.2",
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ),
}

# Ordinary sentences that use the words of notices.
ORDINARY = (
    "A driving licence is valid for ten years.",
    "The restaurant lost its license after the inspection.",
    "All rights reserved.",
    "The copyright of the picture belongs to the museum.",
    "He asked for permission to leave the room.",
    "The warranty covers parts and labour for two years.",
    "You need a license to fish in this lake.",
    "Permission denied while opening the file.",
    "The redistribution of income was the subject of the debate.",
    "Copyright law differs from country to country.",
    "The company sells licenses for its software by the seat.",
    "This version of the program needs a license key.",
)

#: Words too common to be hints.
COMMON = frozenset(
    "a above an and any are as at be by copy file for form free from in into is it law may met no not "
    "of on or other see that the this to under use used with without work you your 2 2.0 2.1 3 4.0".split()
)

#: Words of a piece of a longer paragraph; pieces overlap by half.
PIECE_WORDS = 64

VERSIONS, HELD_VERSIONS = 16, 6
VOCABULARY = 4096
ORDINARY_ROWS = 2000

#: Lines taken for each ordinary piece that is needed, against repeated, empty and hinted ones.
SPARE_LINES = 8
LEAST = 0.5
CONFIRMED = 0.6


def words_of(text: Column) -> Column:
    """Lower-case words; a point or hyphen inside one belongs to it."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), 0)


def _runs(words: Column, n: int) -> Column:
    last = F.size(words) - n
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(1), last + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
        ),
    ).otherwise(F.array().cast("array<string>"))


def grams_of(words: Column) -> Column:
    """Distinct words, pairs and triples."""
    return F.array_distinct(F.concat(words, _runs(words, 2), _runs(words, 3)))


def _literal_rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    values = F.array(*[F.struct(F.lit(a).alias("family"), F.lit(t).alias("text")) for a, t in rows])
    return spark.range(1).select(F.explode(values).alias("r")).select("r.*")


def notices(spark: SparkSession) -> DataFrame:
    """``family, text``: one row per notice."""
    return _literal_rows(spark, [(f, t) for f, texts in NOTICES.items() for t in texts])


def _versions(rows: DataFrame) -> DataFrame:
    """Each text whole and with words left out: ``family, version, words``."""
    numbered = rows.withColumn(
        "version", F.explode(F.sequence(F.lit(0), F.lit(VERSIONS + HELD_VERSIONS - 1)))
    ).withColumn("words", words_of(F.col("text")))
    lost = F.filter(
        "words",
        lambda w, i: F.pmod(F.xxhash64(w, i, F.col("version"), F.col("text")), F.lit(8)) > 0,
    )
    return numbered.select(
        "family", "version", F.when(F.col("version") == 0, F.col("words")).otherwise(lost).alias("words")
    )


def hint_words() -> list[str]:
    """Words one of which stands in every text that a notice confirms, for all notices.

    A text with ``CONFIRMED`` of a notice's pairs lacks less than the others' share. For each
    notice, words are chosen until more pairs than that have one: the shared pairs include such.
    """
    chosen: set[str] = set()
    for text in (t for texts in NOTICES.values() for t in texts):
        words = re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())
        pairs = set(zip(words, words[1:], strict=False))
        left = {w for w in words if w not in COMMON} - chosen
        while sum(bool(chosen.intersection(p)) for p in pairs) <= (1 - CONFIRMED) * len(pairs) + 1e-9:
            best = max(left, key=lambda w: (sum(w in p and not chosen.intersection(p) for p in pairs), len(w), w))
            left.remove(best)
            chosen.add(best)
    return sorted(chosen)


def _hinted(text: Column) -> Column:
    """Whether a text may have a hint word; whether it has is asked of its words."""
    # every hint word begins after the start or after another sign; ends are left open
    starts = "|".join(re.escape(w) for w in hint_words())
    return F.lower(text).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{starts})")


def _has_hint(words: Column) -> Column:
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in hint_words()]))


def paragraphs(docs: DataFrame) -> DataFrame:
    """Lines and paragraphs of ``text`` in pieces: ``words`` beside the other columns.

    ``part`` numbers a text's paragraphs; ``joined`` is true of a paragraph of several lines. A
    line without letters and digits is blank, so that comment marks may stand in it; other marks
    are no part of words. Pieces without a hint word are left out, but each text has one piece
    more, without words and with a null ``part``, so that it is not lost.
    """
    unmarked = F.regexp_replace("text", r"(?im)^[ \t]*(?:dnl|rem)(?![\p{L}\p{N}])", "")
    unmarked = F.regexp_replace(unmarked, r"\n[^\p{L}\p{N}\n]*(?=\n)", "\f")
    others = [c for c in docs.columns if c != "text"]
    split = F.filter(F.split(unmarked, "\f+"), _hinted)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    texts = F.transform(F.filter(lines, _hinted), lambda x: F.struct(F.lit(False).alias("joined"), x.alias("text")))
    whole = F.struct(F.lit(True).alias("joined"), F.col("text"))
    nothing = F.struct(F.lit(False).alias("joined"), F.lit("").alias("text"))
    each = docs.select(*others, F.posexplode(F.concat(split, F.array(F.lit(None).cast("string")))).alias("part", "text"))
    each = each.select(
        *others,
        F.when(F.col("text").isNotNull(), F.col("part")).alias("part"),
        F.explode(
            F.when(F.col("text").isNull(), F.array(nothing))
            .when(F.size(lines) > 1, F.concat(texts, F.array(whole)))
            .otherwise(texts)
        ).alias("t"),
    ).select(*others, "part", "t.joined", words_of(F.col("t.text")).alias("words"))
    pieces = _pieces(F.col("words"))
    kept = F.when(F.col("part").isNull(), pieces).otherwise(F.filter(pieces, _has_hint))
    return each.select(*others, "part", "joined", F.explode(kept).alias("words"))


@dataclass
class Classifier:
    """The vocabulary of n-grams, the regression over it, and its temperature."""

    grams: CountVectorizerModel
    regression: LogisticRegressionModel
    families: list[str]
    temperature: float = 1.0

    def margins(self, rows: DataFrame) -> DataFrame:
        """Adds ``margins``: an array with one number per family."""
        counted = self.grams.transform(rows.withColumn("grams", grams_of(F.col("words"))))
        scored = self.regression.transform(counted)
        return scored.withColumn("margins", vector_to_array("rawPrediction")).drop(
            "grams", "features", "rawPrediction", "probability", "prediction"
        )

    def probabilities(self, temperature: Column) -> Column:
        top = F.array_max("margins")
        parts = F.transform("margins", lambda m: F.exp((m - top) / temperature))
        total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
        return F.transform(parts, lambda x: x / total)

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds ``family`` and ``probability`` of the likeliest family, or unknown."""
        names = F.array(*[F.lit(f) for f in self.families])
        sure = self.margins(rows).withColumn("p", self.probabilities(F.lit(self.temperature)))
        best = sure.withColumn("probability", F.array_max("p")).withColumn(
            "family", F.get(names, F.array_position("p", F.col("probability")).cast("int") - 1)
        )
        known = F.col("probability") >= LEAST
        return best.withColumn("family", F.when(known, F.col("family")).otherwise(UNKNOWN)).drop(
            "p", "margins"
        )


def _pieces(words: Column) -> Column:
    """Overlapping pieces that together hold all the words."""
    half = PIECE_WORDS // 2
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - half), F.lit(half))
    return F.transform(starts, lambda i: F.slice(words, i, PIECE_WORDS))


def _ordinary_pieces(docs: DataFrame) -> DataFrame:
    """``words`` of at most ``ORDINARY_ROWS`` pieces of lines without a hint.

    The lines whose hashes are below a threshold are taken, a few times as many as are needed
    whatever the number of lines, each text once, and of their pieces those with the smallest
    hashes. No line above the threshold is sorted, sent or read for hints.
    """
    line_ends = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = docs.agg(F.coalesce(F.sum(line_ends + 1), F.lit(0)).alias("n")).first()["n"]
    below = int(min(1.0, SPARE_LINES * ORDINARY_ROWS / max(lines, 1)) * 2**64) - 2**63
    chosen = (
        docs.select(F.explode(F.split("text", "\n")).alias("text"))
        .where(F.xxhash64("text") <= min(below, 2**63 - 1))
        .where(F.length("text") > 0)
        .distinct()
        .where(~_hinted(F.col("text")))
    )
    pieces = chosen.select(words_of(F.col("text")).alias("all")).select(
        F.explode(_pieces(F.col("all"))).alias("words")
    )
    return pieces.orderBy(F.xxhash64("words"), "words").limit(ORDINARY_ROWS)


def train(docs: DataFrame) -> Classifier:
    """Fit to the notices and to ordinary paragraphs.

    The ordinary ones are the sentences above and at most ``ORDINARY_ROWS`` pieces of lines of
    ``docs`` without a hint. Null and empty texts have none; without any the sentences remain.
    """
    with workspace(docs.sparkSession, "licences") as work:
        return _fit(docs.sparkSession, work.written(_ordinary_pieces(docs), "ordinary"))


def _fit(spark: SparkSession, plain: DataFrame) -> Classifier:
    families = [UNKNOWN, *NOTICES]
    names = F.array(*[F.lit(f) for f in families])
    ordinary = _literal_rows(spark, [(UNKNOWN, t) for t in ORDINARY])
    rows = _versions(notices(spark).unionByName(ordinary)).unionByName(
        plain.select(
            F.lit(UNKNOWN).alias("family"),
            F.pmod(F.xxhash64("words"), F.lit(VERSIONS + HELD_VERSIONS)).cast("int").alias("version"),
            "words",
        )
    )
    # a few thousand short rows, bounded by the constants above
    rows = rows.withColumn("label", (F.array_position(names, F.col("family")) - 1).cast("double"))
    rows = rows.withColumn("grams", grams_of(F.col("words"))).cache()
    counter = CountVectorizer(
        inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=3.0, binary=True
    )
    fitted = rows.where(F.col("version") < VERSIONS)
    grams = counter.fit(fitted.where(F.col("family") != UNKNOWN))
    regression = LogisticRegression(
        family="multinomial", maxIter=60, regParam=0.002, elasticNetParam=0.5, aggregationDepth=2
    ).fit(grams.transform(fitted))
    model = Classifier(grams, regression, families)
    model.temperature = _temperature(model, rows.where(F.col("version") >= VERSIONS))
    rows.unpersist()
    return model


def _temperature(model: Classifier, held: DataFrame) -> float:
    """The temperature with the smallest log loss on versions kept from training."""
    scored = model.margins(held.drop("grams"))
    tried = F.array(*[F.lit(x / 10) for x in (3, 5, 7, 10, 14, 20, 30)])
    each = scored.withColumn("temperature", F.explode(tried))
    truth = F.get(model.probabilities(F.col("temperature")), F.col("label").cast("int"))
    losses = each.groupBy("temperature").agg(F.avg(-F.log(F.greatest(truth, F.lit(1e-12)))).alias("loss"))
    best = losses.orderBy("loss", "temperature").first()
    return float(best["temperature"]) if best else 1.0


def confirmed(predicted: DataFrame) -> DataFrame:
    """Adds ``share``: the most that a piece has of the word pairs of a notice of its family."""
    spark = predicted.sparkSession
    pairs = notices(spark).select(
        "family", F.array_distinct(_runs(words_of(F.col("text")), 2)).alias("pairs")
    )
    known = pairs.groupBy("family").agg(F.collect_list("pairs").alias("notices"))
    own = F.array_distinct(_runs(F.col("words"), 2))
    joined = predicted.withColumn("own", own).join(F.broadcast(known), "family", "left")
    shares = F.transform(
        "notices", lambda n: F.size(F.array_intersect(n, F.col("own"))) / F.size(n)
    )
    return joined.withColumn("share", F.coalesce(F.array_max(shares), F.lit(0.0))).drop(
        "notices", "own"
    )


def scan_licences(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row per row of ``docs``: the licence families its text names.

    ``families`` are the confirmed ones, sorted and comma-joined; ``n_notices`` their pieces;
    ``n_unconfirmed`` the pieces predicted as a family that no notice confirmed, of those with a
    hint word; ``family`` and ``probability`` belong to the confirmed piece with the highest
    probability (then the first family name), and are null without one. A paragraph of several
    lines counts for the families that none of its lines names.

    Null and empty texts name none. Repeated rows are answered each; an empty table gives an
    empty result; other columns are ignored.
    """
    narrow = docs.select("doc_id", "text")
    none = F.coalesce(~_hinted(F.col("text")), F.lit(True))
    clean = narrow.where(none).select(
        "doc_id",
        F.lit("").alias("families"),
        F.lit(0).cast("bigint").alias("n_notices"),
        F.lit(0).cast("bigint").alias("n_unconfirmed"),
        F.lit(None).cast("string").alias("family"),
        F.lit(None).cast("double").alias("probability"),
    )
    rows = narrow.where(~none).withColumn("row", F.monotonically_increasing_id())
    found = confirmed(model.predict(paragraphs(rows)))
    sure = F.col("share") >= CONFIRMED
    known = (F.col("family") != UNKNOWN) & F.col("part").isNotNull()
    named = F.when(known & sure, F.col("family"))
    unsure = known & ~sure
    best = F.struct((-F.col("probability")).alias("p"), named.alias("family"))
    # of each paragraph and prediction: the lines, or else the joined pieces
    by_part = found.groupBy("row", "doc_id", "part", named.alias("named"), unsure.alias("unsure")).agg(
        F.count(F.when(~F.col("joined"), 1)).alias("lines"),
        F.count(F.when(F.col("joined"), 1)).alias("pieces"),
        F.min(F.when(~F.col("joined"), best)).alias("line_best"),
        F.min(best).alias("piece_best"),
    )
    times = F.when(F.col("lines") > 0, F.col("lines")).otherwise(F.col("pieces"))
    hinted = by_part.groupBy("row", "doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("named")), ",").alias("families"),
        F.coalesce(F.sum(F.when(F.col("named").isNotNull(), times)), F.lit(0)).alias("n_notices"),
        F.coalesce(F.sum(F.when(F.col("unsure"), times)), F.lit(0)).alias("n_unconfirmed"),
        F.min(F.when(F.col("named").isNotNull(), F.coalesce("line_best", "piece_best"))).alias("best"),
    )
    return clean.unionByName(
        hinted.select(
            "doc_id",
            "families",
            "n_notices",
            "n_unconfirmed",
            F.col("best.family").alias("family"),
            (-F.col("best.p")).alias("probability"),
        )
    )
