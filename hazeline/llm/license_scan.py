"""Licence families of paragraphs: a trained n-gram classifier with an unknown class, confirmed by templates.

A paragraph is a line. Its features are its one- and two-word runs. A sparse multinomial logistic regression is trained on
variants of the templates below (words dropped, corpus words around them) against ordinary sentences about licences and paragraphs of at
most SAMPLE_DOCS documents, those with the smallest hashes, whose lines speak of no licence. A part of the variants and paragraphs is held out: the
probability that a family must reach is set above all that held-out paragraphs without a licence reach. A prediction counts
only if it also holds CONFIRM of the word pairs of one template of its family.

Scoring is one expression over the lines of a document, without a shuffle. Lines that no template could confirm are passed
over at once: ``telling_words`` is a set of words such that each CONFIRM part of a template's pairs holds one of them.

Nulls and odd rows: a null text has no paragraphs; blank lines are not counted; every input row gives one output row; an empty table
gives an empty result. Other columns are not looked at, and ``scanned`` passes all of them on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.registry import query, table

UNKNOWN = "unknown"
#: Documents from which ordinary paragraphs for training are taken, and paragraphs taken of each.
SAMPLE_DOCS = 200
SAMPLE_LINES = 10
#: Training variants of each template; one in HELD_OUT is not trained on.
VARIANTS = 40
HELD_OUT = 4
VOCABULARY = 4096
CONFIRM = 0.5
LOWEST, HIGHEST = 0.5, 0.9

#: Notices by which the families are known.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License", "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0", "Released under the Apache License 2.0",
        "you may not use this file except in compliance with the License",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "GPL": (
        "licensed under the GNU General Public License, version 3", "licensed under the GNU General Public License, version 2",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
    ),
    "LGPL": (
        "licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License", "Licensed under the BSD 2-Clause license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Released under the Mozilla Public License, version 2.0",
    ),
    "ISC": (
        "Released under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "CC-BY": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC0": ("released under CC0 1.0 Universal", "dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication"),
    "Unlicense": ("This is free and unencumbered software released into the public domain", "Released under the Unlicense"),
}

#: Sentences that speak of licences and grant none.
ORDINARY = (
    "He lost his driving license on the way to work", "The license of the restaurant was renewed by the city last year",
    "You need a fishing license and a permit for the lake", "All rights reserved by the owner of the house",
    "The public was free to use the road without restriction", "She was licensed to practice medicine under the law of the state",
    "The general spoke to the public about version two of the plan", "Copies of the notice were distributed free of charge",
    "The work is licensed under terms that we keep to ourselves", "Released under the name of the band in the spring",
    "Poetic license is not a license to lie", "This product is licensed under the Acme Commercial License Agreement",
)


def line_words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def pairs_of(words: Column) -> Column:
    """Runs of two words."""
    ahead = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    both = F.zip_with(words, ahead, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(both, lambda g: g.isNotNull()))


def grams_of(words: Column) -> Column:
    return F.concat(F.array_distinct(words), pairs_of(words))


def rows_of(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """(family, line) of literal rows."""
    made = F.array(*(F.struct(F.lit(a).alias("family"), F.lit(b).alias("line")) for a, b in rows))
    return spark.range(1).select(F.inline(made))


def ordinary_lines(docs: DataFrame) -> DataFrame:
    """Lines of the documents with the smallest hashes of id and length; both bounds are parameters."""
    least = docs.select(F.xxhash64("doc_id", F.octet_length("text")).alias("h"), "text").orderBy("h").limit(SAMPLE_DOCS)
    lines = F.slice(F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0), 1, SAMPLE_LINES)
    return least.select(F.explode(lines).alias("line")).where(
        ~F.lower("line").rlike("licen[sc]|copyright|gnu|creative commons|public domain|warrant")
    )


def training_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(family, words, held_out)."""
    known = rows_of(spark, [(f, t) for f, texts in TEMPLATES.items() for t in texts])
    plain = rows_of(spark, [(UNKNOWN, t) for t in ORDINARY])
    versions = known.union(plain).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    # the first variant is the template; the others drop up to a quarter of its words, and every other one has words around it
    dropped = F.filter(
        line_words(F.col("line")), lambda w, i: (F.col("v") == 0) | (F.pmod(F.xxhash64(w, i, F.col("v")), F.lit(16)) >= F.col("v") % 5)
    )
    around = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.hex(F.pmod(F.xxhash64(i, F.col("v")), F.lit(1000))))
    varied = versions.select(
        "family", F.when(F.col("v") % 2 == 1, F.concat(F.slice(around, 1, 3), dropped, F.slice(around, 4, 3))).otherwise(dropped).alias("words"),
        (F.col("v") % HELD_OUT == HELD_OUT - 1).alias("held_out"),
    )
    lines = ordinary_lines(docs).select(
        F.lit(UNKNOWN).alias("family"), line_words(F.col("line")).alias("words"),
        (F.pmod(F.xxhash64("line"), F.lit(HELD_OUT)) == 0).alias("held_out"),
    )
    return varied.union(lines).where(F.size("words") > 0)


@dataclass(frozen=True)
class Model:
    """Weights of each gram for each family, the families in order, intercepts, the probability to reach, telling words."""

    families: list[str]
    weights: dict[str, list[float]]
    intercepts: list[float]
    threshold: float
    telling: list[str]

    def scores(self, grams: Column) -> Column:
        weights = F.create_map(*(x for g, row in self.weights.items() for x in (F.lit(g), F.array(*map(F.lit, row)))))
        known = F.filter(F.transform(grams, lambda g: F.element_at(weights, g)), lambda w: w.isNotNull())
        start = F.array(*map(F.lit, self.intercepts))
        return F.aggregate(known, start, lambda acc, w: F.zip_with(acc, w, lambda a, b: a + b))

    def probability(self, scores: Column, number: int | None = None) -> Column:
        """Of the family with that number, or of the likeliest."""
        one = F.array_max(scores) if number is None else scores[number]
        return let(one, lambda x: 1 / F.aggregate(scores, F.lit(0.0), lambda a, b: a + F.exp(b - x)))


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def plain_words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def telling_words(ordinary: set[str]) -> list[str]:
    """Words of templates, without ordinary ones wherever the rest is enough.

    A line is confirmed by CONFIRM of a template's pairs. If fewer of its pairs are without telling words, such a line has one.
    """
    telling = {w for texts in TEMPLATES.values() for t in texts for w in plain_words(t)} - ordinary
    for texts in TEMPLATES.values():
        for t in texts:
            words = plain_words(t)
            pairs = set(zip(words, words[1:], strict=False))
            if sum(not telling & set(p) for p in pairs) >= CONFIRM * len(pairs):
                telling |= set(words)
    return sorted(telling)


def train(spark: SparkSession, docs: DataFrame) -> Model:
    rows = training_rows(spark, docs).withColumn("grams", grams_of(F.col("words"))).coalesce(2).cache()
    fitted = rows.where("NOT held_out")
    index = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(fitted)
    counter = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, binary=True).fit(fitted)
    regression = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=0.001, maxIter=40, standardization=False)
    fit = regression.fit(counter.transform(index.transform(fitted)))
    matrix = fit.coefficientMatrix.toArray().T
    weights = {g: [round(float(x), 6) for x in row] for g, row in zip(counter.vocabulary, matrix, strict=True) if row.any()}
    # the words of a bounded number of lines
    common = rows.where(F.col("family") == UNKNOWN).select(F.explode("words").alias("w")).distinct().collect()
    telling = telling_words({r.w for r in common})
    model = Model(list(index.labels), weights, [round(float(x), 6) for x in fit.interceptVector.toArray()], LOWEST, telling)
    unknown = model.families.index(UNKNOWN)
    chance = 1 - let(model.scores(F.col("grams")), lambda x: model.probability(x, unknown))
    reached = rows.where("held_out").where(F.col("family") == UNKNOWN).agg(F.max(chance)).first()[0]
    rows.unpersist()
    return replace(model, threshold=min(HIGHEST, max(LOWEST, reached or 0.0)))


def scanned(docs: DataFrame, model: Model) -> DataFrame:
    """docs with ``__paragraphs``, the number of its lines that are not blank, and ``__licences``, an array of (family, line) in order."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.trim(x)) > 0)
    telling = F.array(*map(F.lit, model.telling))
    speaking = F.filter(lines, lambda x: F.arrays_overlap(F.split(F.lower(x), "[^a-z0-9]+"), telling))
    families = F.array(*map(F.lit, model.families))
    templates = F.create_map(
        *(x for f, texts in TEMPLATES.items() for x in (F.lit(f), F.array(*(pairs_of(line_words(F.lit(t))) for t in texts))))
    )

    def confirmed(family: Column, pairs: Column) -> Column:
        return F.exists(
            F.element_at(templates, family), lambda t: F.size(F.array_intersect(t, pairs)) >= CONFIRM * F.size(t)
        )

    def judged(line: Column) -> Column:
        def of_words(words: Column) -> Column:
            return let(pairs_of(words), lambda pairs: let(
                model.scores(F.concat(F.array_distinct(words), pairs)), lambda scores: of_scores(pairs, scores)
            ))

        def of_scores(pairs: Column, scores: Column) -> Column:
            at = F.array_position(scores, F.array_max(scores)).cast("int")
            return F.struct(
                F.element_at(families, at).alias("family"), line.alias("line"), pairs.alias("pairs"),
                model.probability(scores).alias("p"),
            )

        return let(line_words(line), of_words)

    found = F.filter(
        F.transform("__lines", judged),
        lambda x: (x["family"] != UNKNOWN) & (x["p"] > model.threshold) & confirmed(x["family"], x["pairs"]),
    )
    return docs.withColumns({"__paragraphs": F.coalesce(F.size(lines), F.lit(0)), "__lines": speaking}).withColumn(
        "__licences", F.transform(found, lambda x: F.struct(x["family"].alias("family"), x["line"].alias("line")))
    ).drop("__lines")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    families = F.array_sort(F.array_distinct(F.transform("__licences", lambda x: x["family"])))
    return scanned(docs, train(spark, docs)).select(
        "doc_id", F.col("__paragraphs").cast("long").alias("n_paragraphs"),
        F.coalesce(F.size("__licences"), F.lit(0)).cast("long").alias("n_licences"),
        F.coalesce(F.array_join(families, ","), F.lit("")).alias("families"),
    )
