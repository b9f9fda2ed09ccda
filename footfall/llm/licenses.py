"""Licence notices in texts: a trained classifier of paragraphs, confirmed by templates.

Only DataFrame operations and the JVM's machine-learning library run here. Paragraphs are
lines up to a blank one, or one of marks alone; wrapped lines and comment marks make no difference.
Features are the different runs of one to three words, hashed; a multinomial logistic regression
over them tells licence families from other text; a second, one-dimensional one, fitted on variants
that the first has not seen, turns its margin into the probability that a paragraph is a notice at
all. A prediction stands if that probability is high enough and the paragraph holds enough of a
template of the predicted family.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.session import stage

# --- fixed values: wordings of licence notices in common use, by family ---------------------
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License.",
        "Released under the Apache License 2.0.",
        "This project is available under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
        "Licensed under the BSD License.",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Available under a Creative Commons non-commercial license.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GNU GPL version 2 or later.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction.",
        "This software is distributed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "Released under the MPL 2.0 license.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "Released under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "reserved": [
        "Copyright 2020 Example Company. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the "
        "copyright holder.",
        "This software is proprietary and confidential. Unauthorized copying is prohibited.",
    ],
}
#: Sentences that use the words of notices and are none.
OTHER = [
    "He lost his driving license last summer.",
    "The license of the restaurant was revoked by the city.",
    "A fishing license is required at the lake.",
    "She moved to Apache Junction with her family.",
    "The general public was invited to the opening.",
    "They studied at MIT and later founded a company.",
    "The paper discusses public domain works and copyright history.",
    "The version of the story told here is not the common one.",
    "All rights come with duties, the teacher said.",
    "This work is the result of many years.",
    "He was granted permission to leave.",
    "The license plate was released under a cover of mud.",
    "Free software is a matter of debate.",
    "The copyright term was extended by the court.",
    "Under the terms of the contract the rent is due on Monday.",
    "The company is licensed to sell wine in three states.",
    "Creative people often share common interests.",
    "You may not use the lift without a key.",
]
#: Background lines with one of these may be notices and are not trained on as ordinary text.
KEYS = (
    "licen[cs]|copyright|public domain|creative commons|redistribut|permission|proprietary|"
    "free software|cc0|cc[ -]by"
)
# --- end of fixed values --------------------------------------------------------------------

UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *sorted(TEMPLATES)]
BUCKETS = 1 << 12
#: Ordinary lines the model is fitted with at most, from documents taken by hash of their id.
BACKGROUND_DOCUMENTS, BACKGROUND_LINES = 200, 1000
#: Variants of each template.
VARIANTS = 24
PROBABILITY, CONFIRMED = 0.5, 0.5
#: Marks of comments that are words; others hold no letters.
MARKS = r"(?i)^\s*(?:rem|dnl)\s"
#: Words that may stand between those of a template, and words around a notice that are looked at.
LOOSE, AROUND = 10, 5


def words(line: Column) -> Column:
    """Lower-cased runs of letters; numbers differ between versions and are left out."""
    return F.filter(F.split(F.lower(line), r"[^\p{L}]+"), lambda w: w != "")


def runs(of: Column) -> Column:
    """Different runs of one to three words of a column (stored ahead, as it is used repeatedly)."""
    n = F.size(of)

    def joined(k: int):
        return lambda i: F.array_join(F.slice(of, i, k), " ")

    parts = [
        F.transform(
            F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(
                F.array().cast("array<int>")
            ),
            joined(k),
        )
        for k in (1, 2, 3)
    ]
    return F.array_distinct(F.concat(*parts))


@dataclass
class Model:
    families: LogisticRegressionModel
    notice: LogisticRegressionModel
    templates: dict[str, list[list[str]]]  # runs of words of the templates, by family
    common: dict[str, int]  # how many background lines have a word of the templates


def anchors(parts: list[str], common: dict[str, int], confirmed: float) -> list[str]:
    """Words of a template, rare ones first; a text with none of them has less than `confirmed` of
    its runs, so leaving it out loses nothing."""
    chosen, left = [], list(parts)
    single = {p for p in parts if " " not in p}
    for word in sorted(single, key=lambda w: (common.get(w, 0), -len(w), w)):
        if len(left) < confirmed * len(parts):
            break
        chosen.append(word)
        left = [p for p in left if word not in p.split(" ")]
    return chosen


def _features(rows: DataFrame, parts: str = "parts") -> DataFrame:
    return HashingTF(
        inputCol=parts, outputCol="features", numFeatures=BUCKETS, binary=True
    ).transform(rows)


def fit(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Train on variants of the templates against other sentences and ordinary lines.

    A variant leaves out some words and has foreign ones before and behind. Ordinary lines come from
    a bounded number of documents and are used only if they have none of the keys.
    """
    spark = documents.sparkSession
    templates = spark.createDataFrame(
        [(f, t) for f in sorted(TEMPLATES) for t in TEMPLATES[f]], "family STRING, template STRING"
    )
    known: dict[str, list[list[str]]] = {}
    for row in (
        templates.withColumn("words", words(F.col("template")))
        .select("family", runs(F.col("words")).alias("parts"))
        .collect()
    ):
        known.setdefault(row.family, []).append(row.parts)
    body = F.col(text).cast("string")
    plain = stage(
        documents.select(F.xxhash64(F.col(doc_id).cast("string")).alias("o"), body.alias("body"))
        .where("body is not null")
        .orderBy("o", F.xxhash64("body"))
        .limit(BACKGROUND_DOCUMENTS)
        .select("o", F.explode(F.split("body", r"[\r\n]+")).alias("template"))
        .where((F.col("template") != "") & ~F.lower("template").rlike(KEYS))
        .orderBy(F.xxhash64("o", "template"))
        .limit(BACKGROUND_LINES),
        "licence_background",
    )
    single = sorted({p for f in known.values() for t in f for p in t if " " not in p})
    common = {
        row.word: row["count"]
        for row in plain.select(F.explode(F.array_distinct(words(F.col("template")))).alias("word"))
        .where(F.col("word").isin(single))
        .groupBy("word")
        .count()
        .collect()
    }
    other = spark.createDataFrame([(x,) for x in OTHER], "template STRING")
    source = (
        templates.select("family", "template", F.lit(VARIANTS).alias("n"))
        .unionByName(
            other.select(F.lit(UNKNOWN).alias("family"), "template", F.lit(VARIANTS).alias("n"))
        )
        .unionByName(
            plain.select(F.lit(UNKNOWN).alias("family"), "template", F.lit(2).alias("n"))
        )
        .withColumn("seed", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    )
    kept = F.filter(
        words(F.col("template")),
        lambda w, i: (F.col("seed") == 0) | (F.pmod(F.xxhash64(w, i, F.col("seed")), F.lit(10)) > 0),
    )
    foreign = [_foreign(side) for side in ("before", "behind")]
    variants = F.when(F.col("seed") == 0, kept).otherwise(F.concat(foreign[0], kept, foreign[1]))
    label = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")) - 1
    training = stage(
        _features(
            source.withColumn("words", variants).select(
                label.cast("double").alias("label"),
                runs(F.col("words")).alias("parts"),
                (F.pmod(F.xxhash64("template", "seed"), F.lit(3)) == 0).alias("aside"),
            )
        ).drop("parts"),
        "licence_training",
    ).coalesce(1)  # a few thousand rows, read in every step of the fit
    families = LogisticRegression(
        maxIter=60, regParam=1e-4, standardization=False, family="multinomial"
    ).fit(
        training.where("not aside").select("label", "features")
    )
    aside = families.transform(training.where("aside").select("label", "features"))
    notice = LogisticRegression(maxIter=50, regParam=1e-4).fit(
        aside.select(
            (F.col("label") > 0).cast("double").alias("label"),
            array_to_vector(F.array(_margin(F.col("rawPrediction")))).alias("features"),
        )
    )
    return Model(families, notice, known, common)


def _foreign(side: str) -> Column:
    """One to five made-up words that depend on the variant."""
    many = F.pmod(F.xxhash64("seed", "template", F.lit(side)), F.lit(5)).cast("int") + 1
    return F.transform(
        F.sequence(F.lit(1), many),
        lambda i: F.substring(
            F.translate(
                F.md5(F.concat_ws("-", i, F.col("seed"), F.col("template"), F.lit(side))),
                "0123456789",
                "ghijklmnop",
            ),
            1,
            5,
        ),
    )


def _margin(raw: Column) -> Column:
    """How far the best family is above other text."""
    values = vector_to_array(raw)
    return F.array_max(F.slice(values, 2, len(FAMILIES) - 1)) - values[0]


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once for a row, however often later columns use it."""
    return df.withColumn(name, F.explode(F.array(value)))


def _paragraphs(documents: DataFrame, doc_id: str, text: str, anchor: list[str]) -> DataFrame:
    """A row per paragraph with one of the words `anchor`: row, doc_id, paragraph (the number of its
    first line), lines, words, and of each word the line it is in."""
    # line breaks stay at the end of a line, so that blank lines can be told
    lines = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string").alias("body"),
    ).where("body is not null")
    lines = _once(lines, "every", F.split("body", r"(?<=[\r\n])(?![\r\n])")).drop("body")
    lines = _once(lines, "filled", F.transform("every", lambda x: x.rlike(r"[\p{L}\p{N}]")))
    lines = _once(lines, "ends", F.transform("every", lambda x: x.rlike(r"(?>\r\n|\r|\n)[\r\n]")))
    places = F.sequence(F.lit(1), F.size("every"))

    def at(column: str, i: Column) -> Column:
        return F.get(column, i - 1)

    starts = F.filter(
        places,
        lambda i: at("filled", i) & ((i == 1) | ~at("filled", i - 1) | at("ends", i - 1)),
    )
    stops = F.filter(
        places,
        lambda i: at("filled", i)
        & ((i == F.size("every")) | at("ends", i) | ~at("filled", i + 1)),
    )
    parts = F.transform(
        F.arrays_zip(starts.alias("a"), stops.alias("z")),
        lambda p: F.struct(
            (p.a - 1).alias("paragraph"),
            F.transform(
                F.slice("every", p.a, p.z - p.a + 1),
                lambda x: F.regexp_replace(x, r"[\r\n]+$", ""),
            ).alias("lines"),
        ),
    )
    found = lines.select("row", "doc_id", F.explode(parts).alias("p")).select("row", "doc_id", "p.*")
    by_line = F.transform("lines", lambda x: words(F.regexp_replace(x, MARKS, "")))
    found = _once(found, "by_line", by_line)
    found = _once(found, "words", F.flatten("by_line")).where(
        F.arrays_overlap("words", F.lit(anchor))
    )
    owner = F.transform(
        "by_line", lambda x, i: F.array_repeat(F.col("paragraph") + i, F.size(x))
    )
    return found.withColumn("owner", F.flatten(owner)).drop("by_line")


def _windows(paragraphs: DataFrame, model: Model, anchor: list[str], confirmed: float) -> DataFrame:
    """Windows of paragraphs that hold enough of a template: where they begin and end, the words
    between, and these with those around.

    Paragraphs are cut into pieces that overlap by the longest window, so that each window lies in
    a piece. Windows are as long as the template, longer by some words, and whole pieces; the best
    of those that begin near each other are taken, and cut to the first and last pair of words of
    the template.
    """
    table = [
        (family, sum(" " not in p for p in parts), parts, anchors(parts, model.common, confirmed))
        for family, every in sorted(model.templates.items())
        for parts in every
    ]
    longest = max(n for _, n, _, _ in table) + LOOSE
    templates = paragraphs.sparkSession.createDataFrame(
        [(table,)],
        "templates ARRAY<STRUCT<family: STRING, n: INT, parts: ARRAY<STRING>, anchors: ARRAY<STRING>>>",
    )
    size = F.size("words")
    pieces = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), size - longest), F.lit(longest)),
        lambda i: F.struct(
            i.alias("start"),
            F.slice("words", i, 2 * longest).alias("words"),
            F.slice("owner", i, 2 * longest).alias("owner"),
        ),
    )
    pieces = paragraphs.select(
        "row",
        "doc_id",
        "paragraph",
        F.xxhash64("lines").alias("digest"),
        F.explode(F.filter(pieces, lambda p: F.arrays_overlap(p.words, F.lit(anchor)))).alias("p"),
    ).select("row", "doc_id", "paragraph", "digest", "p.*")
    holds = F.filter(
        "templates",
        lambda t: F.arrays_overlap(t.anchors, F.col("words"))
        & (F.size(F.array_intersect(t.parts, F.col("parts"))) >= F.size(t.parts) * confirmed),
    )
    near = (
        _once(pieces, "parts", runs(F.col("words")))
        .crossJoin(F.broadcast(templates))  # one row
        .withColumn("t", F.explode(holds))
        .select(
            *pieces.columns, F.col("t.family").alias("family"), F.col("t.n").alias("n"),
            F.col("t.parts").alias("template"),
        )
    )

    def part_of(i: Column, k: int) -> Column:
        run = F.array_join(F.slice("words", i, k), " ")
        return ((i + k - 1 <= size) & F.array_contains("template", run)).cast("int")

    places = F.sequence(F.lit(1), size)
    near = _once(near, "pairs", F.transform(places, lambda i: part_of(i, 2)))
    near = _once(
        near,
        "held",
        F.transform(places, lambda i: part_of(i, 1) + F.element_at("pairs", i) + part_of(i, 3)),
    )
    n = F.col("n")
    lengths = F.array_distinct(F.array(F.least(size, n), F.least(size, n + LOOSE), size))
    near = near.withColumn("length", F.explode(lengths))
    near = _once(
        near,
        "sums",
        F.transform(
            F.sequence(F.lit(1), size - F.col("length") + 1),
            lambda j: F.aggregate(F.slice("held", j, F.col("length")), F.lit(0), lambda x, y: x + y),
        ),
    )
    half = F.floor(n / 2).cast("int")
    best = F.filter(
        F.sequence(F.lit(1), F.size("sums")),
        lambda j: (F.element_at("sums", j) >= F.size("template") * confirmed)
        & (
            F.element_at("sums", j)
            == F.array_max(F.slice("sums", F.greatest(F.lit(1), j - half), 2 * half + 1))
        ),
    )
    near = near.withColumn("j", F.explode(best))
    near = _once(near, "inside", F.slice("words", F.col("j"), F.col("length")))
    near = _once(
        near, "matched", F.size(F.array_intersect(F.col("template"), runs(F.col("inside"))))
    ).where(F.col("matched") >= F.size("template") * confirmed)
    within = F.filter(
        F.sequence(F.col("j"), F.col("j") + F.col("length") - 1),
        lambda i: (F.element_at("pairs", i) == 1) & (i < F.col("j") + F.col("length") - 1),
    )
    near = _once(near, "within", within)
    some = F.size("within") > 0
    near = _once(near, "low", F.when(some, F.array_min("within")).otherwise(F.col("j")))
    near = _once(
        near,
        "high",
        F.when(some, F.array_max("within") + 1).otherwise(F.col("j") + F.col("length") - 1),
    )
    first = F.greatest(F.lit(1), F.col("low") - AROUND)
    near = _once(near, "core", F.slice("words", F.col("low"), F.col("high") - F.col("low") + 1))
    near = _once(near, "wide", F.slice("words", first, F.col("high") + AROUND - first + 1))
    return near.select(
        "row",
        "doc_id",
        "paragraph",
        "digest",
        "family",
        "matched",
        (F.col("matched") / F.size("template")).alias("share"),
        (F.col("start") + F.col("low") - 1).alias("begin"),
        (F.col("start") + F.col("high") - 1).alias("end"),
        F.element_at("owner", F.col("low")).alias("line"),
        F.element_at("owner", F.col("high")).alias("last_line"),
        runs(F.col("core")).alias("parts"),
        runs(F.col("wide")).alias("wide_parts"),
    )


def _notices(
    documents: DataFrame, model: Model, doc_id: str, text: str, probability: float, confirmed: float
) -> tuple[DataFrame, DataFrame]:
    """Notices without their paragraphs' texts, and the paragraphs looked at."""
    anchor = sorted(
        {w for f in model.templates.values() for t in f for w in anchors(t, model.common, confirmed)}
    )
    # stored, so that rows keep their numbers
    paragraphs = stage(_paragraphs(documents, doc_id, text, anchor), "licence_paragraphs")
    windows = stage(_windows(paragraphs, model, anchor, confirmed), "licence_windows")
    # the words of the notice tell its family, those around it whether it is one
    around = model.families.copy({model.families.rawPredictionCol: "wideRaw"})
    scored = model.families.transform(_features(windows)).drop(
        "features", "prediction", "probability"
    )
    scored = stage(
        around.transform(_features(scored, "wide_parts")).select(
            *[c for c in windows.columns if c not in ("parts", "wide_parts")],
            vector_to_array("rawPrediction").alias("raw"),
            vector_to_array("wideRaw").alias("wide"),
        ),
        "licence_scores",
    )

    def families(raw: str) -> Column:
        return F.slice(raw, 2, len(FAMILIES) - 1)

    best = F.array_position(families("raw"), F.array_max(families("raw"))).cast("int")
    slope, shift = float(model.notice.coefficients[0]), float(model.notice.intercept)
    margin = F.array_max(families("wide")) - F.col("wide")[0]
    sure = scored.withColumn("probability", 1 / (1 + F.exp(-(margin * slope + shift)))).where(
        (F.col("probability") >= probability)
        & (F.col("family") == F.element_at(F.array(*[F.lit(f) for f in FAMILIES[1:]]), best))
    )
    # of windows that overlap, the one that holds most of its template stands
    ranked = F.array_sort(
        F.collect_set(
            F.struct(
                (-F.col("matched")).alias("less"),
                (-F.col("share")).alias("low"),
                (F.col("end") - F.col("begin")).alias("length"),
                (-F.col("probability")).alias("unsure"),
                *["begin", "end", "family", "line", "last_line"],
            )
        )
    )
    standing = F.aggregate(
        "ranked",
        F.filter("ranked", lambda x: F.lit(False)),
        lambda kept, x: F.when(
            F.exists(kept, lambda y: (x.begin <= y.end) & (y.begin <= x.end)), kept
        ).otherwise(F.concat(kept, F.array(x))),
    )
    notices = (
        sure.groupBy("row", "doc_id", "paragraph", "digest")
        .agg(ranked.alias("ranked"))
        .select("row", "doc_id", "paragraph", "digest", F.explode(standing).alias("n"))
        .select(
            "row",
            "doc_id",
            F.col("paragraph").alias("number"),
            "digest",
            "n.line",
            "n.last_line",
            F.col("n.begin").alias("word"),
            "n.family",
            (-F.col("n.unsure")).alias("probability"),
            (-F.col("n.low")).alias("share"),
        )
    )
    return notices, paragraphs


def find_notices(
    documents: DataFrame,
    model: Model,
    doc_id: str = "doc_id",
    text: str = "text",
    probability: float = PROBABILITY,
    confirmed: float = CONFIRMED,
) -> DataFrame:
    """Notices found: doc_id, line (from 0, blank ones not counted), paragraph, word (its first one
    in the paragraph, from 1), family, probability, share of the template.

    Paragraphs without any anchor of a template can't hold `confirmed` (above 0) of one and are not
    looked at further; all others are, whole, however long. Of windows that overlap the one with
    most of its template stands, so a paragraph may hold several notices. Null and empty texts have
    no notices. Repeated rows give repeated notices; no documents, none. The model and the templates
    are fixed in size.
    """
    notices, paragraphs = _notices(documents, model, doc_id, text, probability, confirmed)
    texts = paragraphs.select("row", F.col("paragraph").alias("number"), "lines")
    return notices.join(texts, ["row", "number"]).select(
        "doc_id",
        "line",
        F.array_join("lines", "\n").alias("paragraph"),
        "word",
        "family",
        "probability",
        "share",
    )


def licences(
    documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of documents: doc_id, families (in order of name), n_notices, probability.

    probability is that of the surest notice, null without one. Rows with the same doc_id share
    their notices; a null id has none of its own.
    """
    found = (
        _notices(documents, model, doc_id, text, PROBABILITY, CONFIRMED)[0]
        .groupBy("doc_id")
        .agg(
            F.array_sort(F.collect_set("family")).alias("families"),
            F.count_distinct("number", "word", "digest").alias("n_notices"),
            F.max("probability").alias("probability"),
        )
    )
    return (
        documents.select(F.col(doc_id).alias("doc_id"))
        .join(found, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("families", F.array().cast("array<string>")).alias("families"),
            F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
            "probability",
        )
    )
