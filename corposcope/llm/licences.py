"""Licence families of paragraphs: a trained classifier whose predictions a template has to confirm.

Sparse word n-grams of a paragraph go through a multinomial logistic regression over the licence
families and an unknown class, trained on worn copies of the templates and on all paragraphs of the corpus
that are scored and that no template is found in. The chance that a family needs is calibrated on a held-out
fifth of these, and the word trigrams of a template of that family have to be found again. A line is a paragraph; notices that are wrapped over
several lines are found by template trigrams in the words of neighbouring lines, whatever the width.
DataFrame functions and the JVM's own regression only.
"""

from __future__ import annotations

import json
import math
import re
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stored

# Notices and opening sentences of public licences, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GNU General Public License, version 2.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal, public domain dedication.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "Proprietary": [
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}
UNKNOWN = "unknown"
# Paragraphs that speak of licences without granting one.
OTHERS = [
    "A driving license is issued by the office in the town hall.",
    "The license of the pilot was renewed last year by the agency.",
    "Copyright law is taught in the second term of the course.",
    "She lost the licence plate of the car on the way.",
    "The public license office is open on weekdays from nine to five.",
    "The terms of the agreement were not made public by either side.",
    "Free software was given to every person who came to the fair.",
    "The general said that the public was right to ask for the file.",
]
# A paragraph with one of these words speaks of a licence.
CUES = r"(?i)licen[sc]|spdx|copyright|redistribut|permission|free software|creative commons|\bcc[ -]?(by|0)|public domain|rights reserved|proprietary|apache"
# The same where a line break, its comment marks and the number of a line may stand between two words.
SPREAD_CUES = re.sub(r" |\[ -\]\?", lambda m: r"[\W\d_]+" if m[0] == " " else r"[\W\d_]*", CUES)
WORDED = r"[\p{L}\p{N}]"
# Share of a template's trigrams that has to be found again.
CONFIRMED = 0.5


# Words that any text may have; the last to be taken as a sign of a template.
COMMON = set("a an and are as at be by for from in is it its of on or that the this to under with without later public any all you may".split())


def cover_words(templates: dict[str, list[str]], share: float = CONFIRMED) -> list[str]:
    """Words of which, or of cue words, a text holds at least one if it holds ``share`` of the distinct trigrams of any template: of each
    template fewer trigrams than that are without one of them. The longest words come first, as they are rare in other texts."""
    chosen: set[str] = set()
    for text in (t for texts in templates.values() for t in texts):
        words = re.findall(r"[a-z0-9]+", text.lower())
        runs = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        while True:
            bare = [r for r in runs if not chosen & set(r) and not any(re.search(CUES, w) for w in r)]
            if len(bare) < max(math.ceil(share * len(runs)), 1):
                break
            chosen.add(max((w for r in bare for w in r), key=lambda w: (w not in COMMON, len(w), w)))
    return sorted(chosen)


# Only text that a cue or a cover word is in can be confirmed, so only that is scored.
LOOK = CUES + r"|(?<![\p{L}\p{N}])(" + "|".join(cover_words(TEMPLATES)) + r")(?![\p{L}\p{N}])"
SPREAD_LOOK = SPREAD_CUES + LOOK[len(CUES) :]
FEATURES = 1 << 14
# Worn copies of a template, percent of the words that a copy lacks.
COPIES = 24
WORN = 12
# Share of a template's trigrams from which a paragraph is no example of an unknown one.
LIKE = 0.3
# Share of held-out unknown paragraphs that may reach the chance a family needs, and bounds of that chance.
SLIPS = 0.01
CHANCE = (0.5, 0.95)


def paragraphs(text: str = "text") -> Column:
    """The lines of a text that have a word; null has none."""
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
    return F.filter(lines, lambda p: p.rlike(WORDED))


def blocks(docs: DataFrame, cues: str = WORDED) -> DataFrame:
    """``(doc_id, at, lines)``: runs of neighbouring paragraphs without a blank line in between, of which
    one run matches ``cues`` at least; ``at`` is the number of the first paragraph."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    placed = F.filter(F.transform(lines, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: x["p"].rlike(WORDED))
    docs = docs.where(F.coalesce(F.col("text").cast("string").rlike(cues), F.lit(False))).select("doc_id", placed.alias("_lines"))
    # Numbered lines, and an empty one before each that does not follow the last: no line has a line break.
    gap = lambda x, n: F.when(F.get("_lines", n - 1)["i"] < x["i"] - 1, "\n").otherwise("")
    numbered = F.transform("_lines", lambda x, n: F.concat(gap(x, n), n.cast("string"), F.lit(":"), x["p"]))
    each = F.filter(F.split(F.array_join(numbered, "\n"), "\n\n"), lambda b: b.rlike(cues))
    found = docs.select("doc_id", F.explode_outer(each).alias("_block")).where("_block <> ''")
    bare = F.transform(F.split("_block", "\n"), lambda p: F.regexp_replace(p, r"^\d+:", ""))
    return found.select("doc_id", F.substring_index("_block", ":", 1).cast("int").alias("at"), bare.alias("lines"))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _runs(words: Column, n: int) -> Column:
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def _features(df: DataFrame, words: str = "words") -> DataFrame:
    """Counts of hashed words and word pairs as a sparse vector."""
    terms = df.withColumn("_terms", F.concat(F.col(words), _runs(F.col(words), 2)))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_terms", outputCol="_features").transform(terms).drop("_terms")


def _template_runs(spark: SparkSession) -> DataFrame:
    """``(template, family, run, n, place)``: the distinct word trigrams of each fixed template, their number
    and the first word of each."""
    rows, number = [], 0
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = re.findall(r"[a-z0-9]+", text.lower())
            runs = {" ".join(words[i : i + 3]): i for i in reversed(range(len(words) - 2))}
            rows += [(number, family, run, len(runs), place) for run, place in sorted(runs.items())]
            number += 1
    return spark.createDataFrame(rows, "template int, family string, run string, n int, place int")


def template_matches(lines: DataFrame) -> DataFrame:
    """``(doc_id, at, family, matched)`` of stored paragraphs ``(doc_id, at, words)``: the largest share of a
    family's template whose trigrams the paragraph has; families without a common trigram are left out.
    The broadcast table is the fixed templates."""
    runs = lines.select("doc_id", "at", F.explode(F.array_distinct(_runs(F.col("words"), 3))).alias("run"))
    found = runs.join(F.broadcast(_template_runs(lines.sparkSession)), "run")
    shares = found.groupBy("doc_id", "at", "family", "template").agg((F.count("*") / F.first("n")).alias("share"))
    return shares.groupBy("doc_id", "at", "family").agg(F.max("share").alias("matched"))


def _block_words(stored_blocks: DataFrame) -> DataFrame:
    """``words`` of all lines of a block, and the line of each as ``owners``."""
    words = F.flatten(F.transform("lines", _words))
    owners = F.flatten(F.transform("lines", lambda p, i: F.array_repeat(i, F.size(_words(p)))))
    return stored_blocks.withColumn("words", words).withColumn("owners", owners)


def wrapped_matches(stored_blocks: DataFrame) -> DataFrame:
    """``(block, family, matched, start, stop, first, last)`` of stored blocks ``(block, lines)``: places where
    trigrams of a template go over several lines, the share of them, the words from ``start`` up to ``stop`` and
    the lines from ``first`` to ``last``.

    Trigrams belong to one place while the beginnings of the template that they speak for are at most half of it
    apart, so two copies in a row are two places. The broadcast table is the fixed templates."""
    several = _block_words(stored_blocks.where(F.size("lines") > 1).select("block", "lines"))
    starts = F.when(F.size("words") >= 3, F.sequence(F.lit(1), F.size("words") - 2)).otherwise(F.array().cast("array<int>"))
    runs = F.transform(starts, lambda i: F.struct(
        F.array_join(F.slice("words", i, 3), " ").alias("run"), (i - 1).alias("at"), F.get("owners", i - 1).alias("first"), F.get("owners", i + 1).alias("last")
    ))
    found = several.select("block", F.explode_outer(runs).alias("r")).where("r is not null").select("block", "r.*")
    found = found.join(F.broadcast(_template_runs(stored_blocks.sparkSession)), "run").withColumn("begin", F.col("at") - F.col("place"))
    order = Window.partitionBy("block", "template").orderBy("begin", "at")
    far = F.col("begin") - F.lag("begin").over(order) > (F.col("n") + 2) / 2
    found = found.withColumn("_far", F.coalesce(far, F.lit(False)).cast("int")).withColumn("copy", F.sum("_far").over(order))
    places = found.groupBy("block", "family", "template", "copy").agg(
        (F.count_distinct("run") / F.first("n")).alias("matched"),
        F.min("at").alias("start"), (F.max("at") + 3).alias("stop"), F.min("first").alias("first"), F.max("last").alias("last"),
    )
    return places.where("first < last").drop("template", "copy")


class Looked(NamedTuple):
    """What is looked at in a table, all stored: blocks of lines, their lines that are scored, and what is found
    of the templates in these lines and over several lines of a block."""

    blocks: DataFrame
    lines: DataFrame
    shares: DataFrame
    places: DataFrame


def looked_at(docs: DataFrame) -> Looked:
    cued = stored(blocks(docs, SPREAD_LOOK).withColumn("block", F.monotonically_increasing_id()), "licence_blocks")
    lines = cued.select("doc_id", "block", F.col("at").alias("_first"), F.posexplode("lines").alias("line", "paragraph"))
    lines = lines.where(F.col("paragraph").rlike(LOOK)).withColumn("words", _words(F.col("paragraph")))
    lines = stored(lines.withColumn("at", F.struct("block", "line")), "licence_lines")
    return Looked(cued, lines, stored(template_matches(lines), "licence_shares"), stored(wrapped_matches(cued), "licence_places"))


def training_paragraphs(spark: SparkSession, looked: Looked, *, copies: int = COPIES) -> DataFrame:
    """``(family, words, held_out, drawn)``: worn copies of every template, and unknown paragraphs: the fixed ones
    and, with ``drawn``, every line of the corpus that is scored and that no template is found in. A fifth is held out."""
    known = [(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(UNKNOWN, t) for t in OTHERS]
    fixed = spark.createDataFrame(known, "family string, text string").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    words = _words(F.col("text"))
    worn = F.filter(words, lambda w, i: (F.col("copy") == 0) | (F.pmod(F.xxhash64(w, i, "copy", "text"), F.lit(100)) >= WORN))
    fixed = fixed.select("family", worn.alias("words"), (F.col("copy") % 5 == 4).alias("held_out"), F.lit(False).alias("drawn"))
    like = looked.shares.where(F.col("matched") >= LIKE).select("at.block", "at.line")
    # Lines of a wrapped notice have few trigrams each.
    wrapped = looked.places.where(F.col("matched") >= LIKE).select("block", F.explode(F.sequence("first", "last")).alias("line"))
    clean = looked.lines.join(like.unionByName(wrapped).distinct(), ["block", "line"], "left_anti").select(
        F.lit(UNKNOWN).alias("family"), "words", (F.pmod(F.xxhash64("doc_id", F.col("_first") + F.col("line")), F.lit(5)) == 4).alias("held_out"), F.lit(True).alias("drawn")
    )
    return fixed.unionByName(clean)


def train(spark: SparkSession, docs: DataFrame) -> tuple[LogisticRegressionModel, list[str], float]:
    """The regression, its classes in order, and the chance that a family needs."""
    return _trained(spark, looked_at(docs))


def _trained(spark: SparkSession, looked: Looked) -> tuple[LogisticRegressionModel, list[str], float]:
    families = [*TEMPLATES, UNKNOWN]
    number = F.create_map(*[c for i, f in enumerate(families) for c in (F.lit(f), F.lit(float(i)))])
    examples = stored(training_paragraphs(spark, looked), "licence_examples").withColumn("label", number[F.col("family")])
    taught = examples.where("not held_out")
    # The lines of the corpus weigh as much as the fixed examples at most, or a family's chance would fall as the corpus grows.
    sizes = taught.agg(F.count_if("drawn").alias("drawn"), F.count_if(~F.col("drawn")).alias("fixed")).first()
    weight = F.when(F.col("drawn"), min(1.0, sizes["fixed"] / max(sizes["drawn"], 1))).otherwise(1.0)
    regression = LogisticRegression(featuresCol="_features", labelCol="label", weightCol="weight", family="multinomial", maxIter=60, regParam=1e-4, probabilityCol="_chances", rawPredictionCol="_raw", predictionCol="_class")
    model = regression.fit(_features(taught.withColumn("weight", weight)))
    judged = _family(model, _features(examples.where(f"held_out and family = '{UNKNOWN}'")), families)
    reached = judged.agg(F.percentile_approx("_chance", 1 - SLIPS, 1000)).first()[0]
    return model, families, min(max(reached or CHANCE[0], CHANCE[0]), CHANCE[1])


def _family(model: LogisticRegressionModel, df: DataFrame, families: list[str]) -> DataFrame:
    """The likeliest family and its chance."""
    chances = F.slice(vector_to_array("_chances"), 1, len(families) - 1)
    found = model.transform(df).withColumn("_each", chances).withColumn("_chance", F.array_max("_each"))
    names = F.array(*[F.lit(f) for f in families])
    return found.withColumn("_family", F.element_at(names, F.array_position("_each", F.col("_chance")).cast("int"))).drop("_each", "_chances", "_raw", "_class", "_features")


def licence_paragraphs(docs: DataFrame, model: LogisticRegressionModel, families: list[str], chance: float) -> DataFrame:
    """``(doc_id, at, paragraph, family, score, matched)`` of the lines that are confirmed or have a cue word, and of confirmed
    notices that are wrapped over several lines, one row each in place of their lines.

    ``at`` counts the paragraphs of the document from 0, a wrapped notice being at its first line. ``family`` is ``unknown`` where no family reaches the
    chance or no template of it is found again; ``score`` is the family's chance in any case.
    """
    return _paragraphs(looked_at(docs), model, families, chance)


def _paragraphs(looked: Looked, model: LogisticRegressionModel, families: list[str], chance: float) -> DataFrame:
    judged = _family(model, _features(looked.lines), families)
    shares = looked.shares.select(F.col("doc_id").alias("_id"), F.col("at").alias("_at"), F.col("family").alias("_f"), "matched")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("at") == F.col("_at")) & (F.col("_family") == F.col("_f"))
    judged = judged.join(shares, same, "left").withColumn("matched", F.coalesce("matched", F.lit(0.0)))
    confirmed = (F.col("_chance") >= chance) & (F.col("matched") >= CONFIRMED)
    judged = judged.withColumn("family", F.when(confirmed, F.col("_family")).otherwise(UNKNOWN))
    alone = stored(judged.select("doc_id", "block", "line", (F.col("_first") + F.col("line")).alias("at"), "paragraph", "family", F.col("_chance").alias("score"), "matched"), "licence_alone")
    wrapped = stored(_wrapped(looked, model, families, chance), "licence_wrapped")
    # A line of a wrapped notice is no paragraph of its own, unless it is confirmed without the others;
    # a wrapped notice of that line's family is the line's.
    covered = wrapped.select("block", "family", "first", F.explode(F.sequence("first", "last")).alias("line"))
    within = covered.select("block", "line", F.lit(True).alias("_within")).distinct()
    # What is not confirmed is reported where a cue word speaks of a licence.
    lone = alone.join(within, ["block", "line"], "left").where((F.col("family") != UNKNOWN) | (F.col("_within").isNull() & F.col("paragraph").rlike(CUES)))
    had = covered.join(alone, ["block", "line", "family"], "left_semi").select("block", "family", "first")
    columns = ["doc_id", "at", "paragraph", "family", "score", "matched"]
    return lone.select(columns).unionByName(wrapped.join(had, ["block", "family", "first"], "left_anti").select(columns))


def _wrapped(looked: Looked, model: LogisticRegressionModel, families: list[str], chance: float) -> DataFrame:
    """The confirmed notices that go over several lines; of those with words in common the best matched one."""
    places = looked.places.where(F.col("matched") >= CONFIRMED)
    places = _block_words(looked.blocks.join(places, "block")).withColumn("words", F.slice("words", F.col("start") + 1, F.col("stop") - F.col("start")))
    judged = _family(model, _features(stored(places.drop("owners"), "licence_places")), families)
    sure = judged.where((F.col("_family") == F.col("family")) & (F.col("_chance") >= chance))
    order = Window.partitionBy("block").orderBy("start", "stop", "family")
    apart = F.col("start") >= F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    sure = sure.withColumn("_apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("place", F.sum("_apart").over(order))
    whole = F.array_join(F.slice("lines", F.col("first") + 1, F.col("last") - F.col("first") + 1), "\n")
    best = F.max(F.struct("matched", F.col("_chance").alias("score"), (F.col("stop") - F.col("start")).alias("n"), "family", "first", "last", "at", whole.alias("paragraph")))
    found = sure.groupBy("block", "place").agg(F.first("doc_id").alias("doc_id"), best.alias("b"))
    return found.select("doc_id", "block", "b.first", "b.last", (F.col("b.at") + F.col("b.first")).alias("at"), "b.paragraph", "b.family", "b.score", "b.matched")


def scan_licences(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_paragraphs, n_licences, n_unknown, families, score)``, one per row of ``docs``.

    ``n_paragraphs`` counts lines with a word, ``n_licences`` lines and wrapped notices with a confirmed family,
    ``n_unknown`` lines with a cue word that have none and are in no wrapped notice;
    ``families`` are the distinct confirmed ones in order, joined by commas, ``score`` the largest chance of
    a confirmed paragraph or 0. Null and empty texts have no paragraph; rows that repeat a ``doc_id`` share what is
    found under it; an empty table gives no rows. Only blocks of lines with a cue are looked at
    and shuffled; counts per document are joined to the ids.
    """
    looked = looked_at(docs)
    found = _paragraphs(looked, *_trained(docs.sparkSession, looked))
    confirmed = F.col("family") != UNKNOWN
    per = found.groupBy("doc_id").agg(
        F.count_if(confirmed).alias("n_licences"),
        F.count_if(~confirmed).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(confirmed, F.col("family")))), ",").alias("families"),
        F.max(F.when(confirmed, F.col("score"))).alias("score"),
    )
    rows = docs.select("doc_id", F.size(paragraphs()).cast("long").alias("n_paragraphs"))
    per = per.withColumnRenamed("doc_id", "_id")
    joined = rows.join(per, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id", "n_paragraphs", F.coalesce("n_licences", zero).alias("n_licences"), F.coalesce("n_unknown", zero).alias("n_unknown"),
        F.coalesce("families", F.lit("")).alias("families"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
