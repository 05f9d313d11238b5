"""Licence scan: a trained paragraph classifier, an unknown class, and a template comparison. JVM side only.

Features are word uni-, bi- and trigrams of the templates below that hold a telling word (one of a template that hardly
occurs in corpus paragraphs), hashed; a multinomial logistic regression learns the licence families and an unknown class
from templates with words dropped and swapped for corpus words, and from paragraphs without licences. Templates are long
notices and short forms of speech around each family's names. A share of them, whole forms, is held out; on their variants the
threshold is calibrated: the lowest probability at which the rows accepted are at least as often right as asked. A prediction
is confirmed if the paragraph shares enough of its word bigrams with a template of the family.

Every paragraph (line) is scored, and for every line break the last words before it with the first ones after it, up to a
blank line; both are as long as the longest template, so a wrapped notice stands whole in the window of its first break. A
window is reported under its first line where it holds more of a template than the lines and windows beside it. Texts, then
lines, that the model cannot accept at its threshold are left out before: without the words that its weights name
(needed_words) no family can reach it. Similarity is compared for what the model accepts.
Training is bounded by the templates and SAMPLE corpus paragraphs; scoring covers every paragraph.

Defined cases: null and empty texts have no paragraphs; a paragraph without a family is reported as unknown if it has
a licence stem; words are parted at hyphens; repeated rows
give repeated results; ties between families go to the first in order; other columns play no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from risewatch.llm.shared import settle

UNKNOWN = "unknown"
#: Short licence notices as their stewards recommend them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "This project is distributed under the Apache 2.0 license.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal.",
        "Dedicated to the public domain under the CC0 license.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GPL, version 2 or later.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "Licensed under the MIT license.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}
#: Names of the families in short forms of speech; a name that is one word needs no form around it.
NAMES = {
    "Apache-2.0": ["Apache License 2.0", "Apache-2.0", "Apache License, Version 2.0", "Apache 2.0"],
    "BSD": ["BSD-3-Clause", "BSD 3-Clause License", "BSD-2-Clause", "BSD license"],
    "CC-BY": ["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "CC0": ["CC0", "CC0-1.0", "CC0 1.0 Universal"],
    "GPL": ["GPLv3", "GPLv2", "GPL-3.0-or-later", "GPL-2.0-only", "GNU GPL", "GNU General Public License"],
    "LGPL": ["LGPLv3", "LGPLv2.1", "LGPL-2.1-or-later", "GNU LGPL", "GNU Lesser General Public License"],
    "MIT": ["MIT License", "MIT", "the MIT license"],
    "MPL": ["MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0"],
}
FORMS = [
    "Released under {}.",
    "SPDX-License-Identifier: {}",
    "{}",
    "Licensed under the {}.",
    "License: {}",
    "This project is licensed under the terms of the {}.",
    "Distributed under the {}, see the file LICENSE.",
    "The code is available under the {}.",
]
#: Sentences with licence words that grant nothing.
DECOYS = [
    "He lost his driving license after the accident.",
    "The restaurant applied for a liquor license last year.",
    "A fishing license is required at the lake.",
    "Copyright 2020 by the author. All rights reserved.",
    "The permission to enter the building was denied.",
    "The warranty covers parts and labour for two years.",
    "The apache helicopter landed near the village.",
    "She is a licensed nurse and works at the hospital.",
    "The gnu is a large antelope of the savanna.",
    "Students at MIT released a new study on public transport.",
    "The creative commons room is open to all residents.",
    "Version 2.0 of the manual was published in the spring.",
    "The public domain of the kings was sold.",
    "Mozilla announced its new office.",
    "The code of the building is available at the office.",
    "This project was released under pressure in May.",
    "See the file on the desk, it is distributed to all.",
    "Under the terms of the agreement the work is done by June.",
]
STEMS = ["licen", "gpl", "copyright", "permission is", "redistribut", "creative commons", "cc by", "cc-by", "cc0", "mozilla public", "spdx"]
BINS = 1 << 15
VARIANTS, SAMPLE = 24, 4000
PRECISION, CONFIRM = 0.99, 0.6
#: A word is telling if at most this share of the sampled paragraphs holds it.
TELLING = 0.0005


def templates() -> dict[str, list[str]]:
    """Each family's notices and its names in every form; a bare name must be two words or a licence's own."""
    out = {}
    for family, notices in TEMPLATES.items():
        short = [form.format(name) for form in FORMS for name in NAMES[family] if form != "{}" or name != "MIT"]
        out[family] = [*notices, *short]
    return out


def _held_out(number: int) -> bool:
    """Whole wordings are kept from training: every fifth of a family's templates, in the order of the forms."""
    return number % 5 == 4


def _literal_rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """family, text"""
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(a).alias("family"), F.lit(b).alias("text")) for a, b in rows])).alias("r")).select("r.*")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}+.]+"), lambda w: w != "")


def _clean(words: Column) -> Column:
    return F.filter(F.transform(words, lambda w: F.regexp_replace(w, r"^[.-]+|[.-]+$", "")), lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    at = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat_ws(" ", F.slice(words, i, n)))


def has_stem(text: Column) -> Column:
    low = F.lower(text)
    found = F.contains(low, F.lit(STEMS[0]))
    for stem in STEMS[1:]:
        found = found | F.contains(low, F.lit(stem))
    return found


def paragraphs(docs: DataFrame, span: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, paragraph (number of the line), wrapped, words, stem of every line with words, and of every line break.

    wrapped: the last `span` words of the line and as many after it, up to a line without words.
    """
    texts = docs.where(F.col(text_col).isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.split(F.col(text_col), "\n").alias("lines"))
    texts = texts.withColumn("words", F.transform("lines", lambda x: _clean(_words(x))))
    texts = texts.withColumn("heads", F.transform("words", lambda w: F.slice(w, 1, span)))
    lines = texts.select("row", "doc_id", "heads", "lines", F.posexplode("words").alias("paragraph", "words")).where(F.size("words") > 0)
    after = F.slice("heads", F.col("paragraph") + 2, span)
    blank = F.array_position(F.transform(after, lambda w: F.size(w) == 0), True).cast("int")
    after = F.slice(F.flatten(F.when(blank > 0, F.slice(after, 1, F.greatest(blank - 1, F.lit(0)))).otherwise(after)), 1, span)
    before = F.slice("words", F.greatest(F.size("words") - (span - 1), F.lit(1)), span)
    both = F.array(
        F.struct(F.lit(False).alias("wrapped"), F.col("words").alias("words"), has_stem(F.element_at("lines", F.col("paragraph") + 1)).alias("stem")),
        F.struct(F.lit(True).alias("wrapped"), F.when(F.size(after) > 0, F.concat(before, after)).otherwise(F.array().cast("array<string>")).alias("words"), F.lit(False).alias("stem")),
    )
    return lines.select("row", "doc_id", "paragraph", F.explode(both).alias("x")).select("row", "doc_id", "paragraph", "x.*").where(F.size("words") > 0)


def _texts() -> list[tuple[str, str, bool]]:
    """family, text, held out"""
    known = [(family, text, _held_out(i)) for family, all_of in templates().items() for i, text in enumerate(all_of)]
    return known + [(UNKNOWN, text, _held_out(i)) for i, text in enumerate(DECOYS)]


def sampled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """text, words of SAMPLE corpus paragraphs without a stem, picked by hash."""
    plain = docs.where(F.col(text_col).isNotNull()).select(F.pmod(F.xxhash64(F.lit(9), F.col(text_col)), F.lit(1 << 30)).alias("h"), F.explode(F.split(F.col(text_col), "\n")).alias("text"))
    picked = plain.where(~has_stem(F.col("text")) & (F.length("text") > 0)).orderBy("h", "text").limit(SAMPLE)
    return settle(picked.select("text", _clean(_words(F.col("text"))).alias("words")))


def training_rows(spark: SparkSession, sample: DataFrame) -> DataFrame:
    """family, words, held: noisy templates, decoys, and the sampled paragraphs; held out by template and by paragraph."""
    texts = _texts()
    base = _literal_rows(spark, [(family, text) for family, text, _ in texts])
    held = F.col("text").isin([text for _, text, out in texts if out])
    base = base.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))

    def noisy(words: Column, share: int) -> Column:
        """Each variant but the first loses some words of long notices; which ones, a hash decides."""
        kept = (F.col("variant") == 0) | (F.size(words) < 8)
        return F.filter(words, lambda w, i: kept | (F.pmod(F.xxhash64(w, i, F.col("variant"), F.col("family")), F.lit(100)) >= share))

    # a notice often stands in running text: variants carry corpus words before or after
    pool = [r["words"] for r in sample.select(F.slice("words", 1, 12).alias("words"), "text").orderBy(F.xxhash64("text")).limit(40).collect()] or [[]]
    beside = F.element_at(F.array(*[F.array(*map(F.lit, x)).cast("array<string>") for x in pool]), F.pmod(F.xxhash64("text", "variant"), F.lit(len(pool))).cast("int") + 1)
    words = noisy(_clean(_words(F.col("text"))), 12)
    words = F.when(F.col("variant") % 4 == 1, F.concat(beside, words)).when(F.col("variant") % 4 == 2, F.concat(words, beside)).otherwise(words)
    known = base.select("family", words.alias("words"), held.alias("held"))
    rest = sample.select(F.lit(UNKNOWN).alias("family"), "words", (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("held"))
    return settle(known.union(rest))


def _features(rows: DataFrame, known: list[str]) -> DataFrame:
    """Sparse counts of the known n-grams; words elsewhere have none."""
    words = F.col("words")
    grams = F.concat(words, _grams(words, 2), _grams(words, 3))
    kept = F.array_intersect(grams, F.array(*map(F.lit, known)))
    return HashingTF(numFeatures=BINS, binary=True, inputCol="grams", outputCol="features").transform(rows.withColumn("grams", kept))


def template_words(spark: SparkSession) -> list[tuple[str, list[str]]]:
    """family, words of every template."""
    rows = _literal_rows(spark, [(f, t) for f, all_of in templates().items() for t in all_of])
    return [tuple(r) for r in rows.select("family", _clean(_words(F.col("text")))).collect()]


def _joined(words: list[str], n: int) -> list[str]:
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


class LicenceModel:
    def __init__(self, spark: SparkSession, docs: DataFrame, text_col: str = "text") -> None:
        self.families = [*sorted(TEMPLATES), UNKNOWN]
        texts = template_words(spark)
        self.span = max(len(words) for _, words in texts)
        #: what a paragraph is compared with: a template's bigrams, or the word of a template of one
        self.templates: dict[str, list[list[str]]] = {f: [] for f in TEMPLATES}
        for family, words in texts:
            parts = sorted(set(_joined(words, 2) or words))
            if parts not in self.templates[family]:
                self.templates[family].append(parts)
        sample = sampled(docs, text_col)
        vocabulary = sorted({w for _, words in texts for w in words})
        inside = F.explode(F.array_intersect(F.array_distinct("words"), F.array(*map(F.lit, vocabulary))))
        #: share of the sampled paragraphs that hold a template's word
        counts = {r["w"]: r["n"] for r in sample.select(inside.alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
        size = max(1, sample.count())
        self.common = {w: counts.get(w, 0) / size for w in vocabulary}
        telling = {w for w, share in self.common.items() if share <= TELLING}
        grams = {g for _, words in texts for n in (1, 2, 3) for g in _joined(words, n)}
        self.grams = sorted(g for g in grams if not telling.isdisjoint(g.split(" ")))
        rows = training_rows(spark, sample).withColumn("label", F.array_position(F.array(*map(F.lit, self.families)), F.col("family")).cast("double") - 1)
        rows = _features(rows, self.grams)
        train = settle(rows.where("not held").select("label", "features"))
        self.model: LogisticRegressionModel = LogisticRegression(regParam=1e-5, maxIter=80, family="multinomial").fit(train)
        self.threshold, self.accuracy = self._calibrate(rows.where("held").select("label", "features"))
        self.needed = self.needed_words()

    def needed_words(self) -> list[str]:
        """Words of which every text that the model gives a family at its threshold has at least one.

        A probability t takes a lead of log(t / (1 - t)) over the unknown class. Without these words the sum of all positive
        differences between the family's and the unknown class's weights, over the n-grams that are left, stays below
        that for each family. Words that are rare in the corpus and shared by few families are taken first.
        """
        tf = HashingTF(numFeatures=BINS, binary=True)
        at = [tf.indexOf(g) for g in self.grams]
        weights, start = self.model.coefficientMatrix.toArray()[:, at], self.model.interceptVector.toArray()
        unknown = self.families.index(UNKNOWN)
        gains = np.delete(np.maximum(weights - weights[unknown], 0), unknown, axis=0)
        start = np.delete(start - start[unknown], unknown) - np.log(self.threshold / (1 - self.threshold))
        words = sorted({w for g in self.grams for w in g.split(" ")})
        holds = np.array([[w in g.split(" ") for g in self.grams] for w in words], float).reshape(len(words), len(self.grams))
        shared = [sum(any(w in part.split(" ") for t in all_of for part in t) for all_of in self.templates.values()) for w in words]
        cost = np.array([(1 + n) * (1 + size * 1e5) for n, size in zip(shared, (self.common.get(w, 0) for w in words), strict=True)])
        left, needed = np.ones(len(self.grams)), []
        while (over := start + gains @ left + 1e-6 >= 0).any():
            value = holds @ (gains[over].sum(axis=0) * left) / cost
            if not len(value) or value.max() <= 0:
                return []  # the intercept alone is enough: everything is scored
            best = int(value.argmax())
            needed.append(words[best])
            left *= 1 - holds[best]
        return needed

    def _scored(self, rows: DataFrame) -> DataFrame:
        p = vector_to_array("probability")
        out = self.model.transform(rows).withColumn("p", p).withColumn("best", F.array_max("p"))
        return out.withColumn("guess", F.element_at(F.array(*map(F.lit, self.families)), F.array_position("p", F.col("best")).cast("int")))

    def _calibrate(self, held_out: DataFrame) -> tuple[float, float]:
        """Lowest threshold in steps of 0.05 at which accepted held-out rows are right in PRECISION of cases; accuracy of all."""
        names = F.array(*map(F.lit, self.families))
        right = F.element_at(names, F.col("label").cast("int") + 1) == F.col("guess")
        rows = self._scored(held_out).select(F.floor(F.col("best") * 20).alias("step"), "guess", right.cast("int").alias("right"))
        steps = {r["step"]: r for r in rows.groupBy("step").agg(F.sum(F.when(F.col("guess") != UNKNOWN, F.col("right"))).alias("right"), F.count(F.when(F.col("guess") != UNKNOWN, 1)).alias("n"), F.sum("right").alias("all_right"), F.count("*").alias("all")).collect()}
        right_n = n = 0
        threshold = 0.95
        for step in range(20, 5, -1):
            if step in steps:
                right_n, n = right_n + (steps[step]["right"] or 0), n + steps[step]["n"]
            if n and right_n < PRECISION * n:
                break
            threshold = step / 20
        return min(threshold, 0.95), sum(r["all_right"] for r in steps.values()) / max(1, sum(r["all"] for r in steps.values()))

    def _template_sql(self) -> str:
        """SQL of a map from family to its templates' parts, which the optimiser folds to a literal."""
        quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
        lists = {f: ", ".join("array(" + ", ".join(map(quoted, t)) + ")" for t in all_of) for f, all_of in self.templates.items()}
        return "map(" + ", ".join(f"{quoted(f)}, array({x})" for f, x in lists.items()) + ")"

    def scan(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filtered: bool = True) -> DataFrame:
        """doc_id, paragraph, family, probability, similarity, confirmed of every paragraph with a family or a licence stem.

        similarity: the largest share of a template's word bigrams (of the predicted family) that the paragraph holds.
        filtered: leave out what cannot be accepted before it is scored; the result is the same without.
        """
        text, needed = F.col(text_col), F.array(*map(F.lit, self.needed))
        filtered = filtered and bool(self.needed)
        if filtered:
            docs = docs.where(has_stem(text) | F.arrays_overlap(_clean(_words(text)), needed))
        found = paragraphs(docs, self.span, id_col, text_col)
        if filtered:
            found = found.where(F.col("stem") | F.arrays_overlap("words", needed))
        found = self._scored(_features(found, self.grams))
        sure = (F.col("guess") != UNKNOWN) & (F.col("best") >= self.threshold)
        found = found.where(sure | F.col("stem"))
        parts = F.concat("words", _grams(F.col("words"), 2))
        of_guess = F.coalesce(F.element_at(F.expr(self._template_sql()), F.col("guess")), F.array().cast("array<array<string>>"))
        shares = F.array_max(F.transform(of_guess, lambda t: F.size(F.array_intersect(t, parts)) / F.size(t)))
        found = found.select("row", "doc_id", "paragraph", "wrapped", F.when(sure, F.col("guess")).otherwise(F.lit(UNKNOWN)).alias("family"), F.col("best").alias("probability"), F.coalesce(shares, F.lit(0.0)).alias("similarity"))
        # a window counts where it holds more than its line and what begins later, and no less than what begins earlier
        whole = F.when(F.col("family") != UNKNOWN, F.col("similarity")).otherwise(F.lit(0.0))
        lines = Window.partitionBy("row").orderBy("paragraph")
        window, line = F.when(F.col("wrapped"), whole), F.when(~F.col("wrapped"), whole)
        later = F.greatest(F.coalesce(F.max(window).over(lines.rangeBetween(1, 1)), F.lit(0.0)), F.coalesce(F.max(line).over(lines.rangeBetween(0, self.span)), F.lit(0.0)))
        earlier = F.coalesce(F.max(window).over(lines.rangeBetween(-1, -1)), F.lit(0.0))
        found = found.withColumn("stands", F.col("wrapped") & (whole > later) & (whole >= earlier))
        taken = F.max("stands").over(Window.partitionBy("row", "paragraph"))
        found = found.withColumn("taken", taken).where(F.col("stands") | ~F.col("wrapped") & ~F.col("taken"))
        return found.select("doc_id", "paragraph", "family", "probability", "similarity").withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("similarity") >= CONFIRM))
