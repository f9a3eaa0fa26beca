"""Licence statements, by a trained paragraph classifier in DataFrame functions.

Texts are taken as words of letters and digits, so comment marks drop out. Two kinds of
passages are scored: every line, and every line end inside a paragraph (the lines up to one
without words), with up to ``REACH`` words on both sides; no template has more words, so a
statement that is wrapped stands whole in one of them or fills whole lines. Words and pairs of
neighbours are hashed into bins, and a multinomial logistic regression over the bins gives
each family a probability. The class ``unknown`` is trained on other lines, and the
probabilities are calibrated by a temperature on held-out statements. A line is reported if a
family reaches the fitted threshold. The family counts only if a template of it confirms it:
enough of the word pairs of the shorter of the two must stand in the other. What is not
confirmed is unknown. A line end is reported, as the place of the line before it, if it is
confirmed and neither of its two lines is by itself.

The regression is fitted to statements made from the templates and to a bounded sample of
lines of the documents. Scoring covers every passage of every document: ``_gate`` spares the
sums for the single families where their bound, from the fitted weights, is below the
threshold already.

Null and empty texts have no passages. Documents without a likely family give no rows. Null
and repeated ids and repeated lines give a row each. An empty table gives none, and the
regression is then fitted to the made statements alone. Only the two named columns are read.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BINS = 4096
#: Paragraphs of the documents that the unknown class is fitted to, and made statements for
#: each template.
SAMPLE_LINES = 1500
MADE = 40
#: The threshold lets this share of held-out statements pass.
RECALL = 0.99
#: Families whose bound is one sum.
GROUP = 3
CONFIRMED = 0.7
#: Words on each side of a line end.
REACH = 24
#: A passage with fewer pairs doesn't count as the shorter side.
LEAST_PAIRS = 2
UNKNOWN = "unknown"
# The usual short notices of public licences.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0.",
        "This work has been released into the public domain.",
    ),
    "proprietary": ("All rights reserved.", "Unauthorized copying of this file is not permitted without permission"),
}
#: Further templates, of names alone.
SHORT = {
    "mit": ("The MIT License (MIT)", "License: MIT"),
    "apache": ("License: Apache-2.0", "under the terms of the Apache License"),
    "gpl": (
        "License: GPL-3.0",
        "Distributed under the terms of the GPL, version 3",
        "under the terms of the GNU General Public License",
    ),
    "bsd": ("License: BSD-3-Clause", "BSD 3-Clause License"),
    "cc-by": ("Available under CC BY 4.0", "Creative Commons Attribution 4.0 International"),
    "cc-by-sa": (
        "Available under CC BY-SA 4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International",
    ),
    "cc-by-nc": (
        "Available under CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International",
    ),
}
FAMILIES = (*TEMPLATES, UNKNOWN)


@dataclass(frozen=True)
class LicenceModel:
    """Coefficients per family and bin, intercepts, the temperature and the threshold."""

    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]
    temperature: float
    threshold: float


def _all_templates() -> list[tuple[str, str]]:
    return [(f, t) for f, ts in TEMPLATES.items() for t in (*ts, *SHORT.get(f, ()))]


def _plain(text: Column) -> Column:
    """Lower case, with one blank for everything between words but line ends."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


def _words(plain: Column) -> Column:
    return F.array_remove(F.split(F.trim(plain), " "), "")


def _pairs(words: str) -> Column:
    """The pairs of neighbours, as texts."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def _binned(passages: DataFrame) -> DataFrame:
    """Adds __l_2, the pairs, and __l_b, the bin of every distinct word and pair of __l_w."""
    grams = F.array_distinct(F.concat("__l_w", "__l_2"))
    return passages.withColumn("__l_2", _pairs("__l_w")).withColumn(
        "__l_b", F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BINS)).cast("int"))
    )


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, place, __l_w, __l_own, __l_next): the words of every line with words, and of every
    line end in a paragraph; then with those of both lines, else null. Places are from 0."""
    lines = docs.select(
        id_col, F.transform(F.split(_plain(F.col(text_col)), "\n"), _words).alias("__l_lines")
    )
    each = F.transform(
        "__l_lines",
        lambda w, i: F.struct(i.alias("place"), w.alias("own"), F.get("__l_lines", i + 1).alias("next")),
    )
    # The outer form, as the plain one evaluates the lines a second time to filter on them.
    line = lines.select(id_col, F.explode_outer(each).alias("p")).filter(F.size("p.own") > 0)
    own, after = F.col("p.own"), F.col("p.next")
    tail = F.slice(own, F.greatest(F.size(own) - REACH + 1, F.lit(1)), F.lit(REACH))
    none = F.lit(None).cast("array<string>")
    alone = F.struct(own.alias("w"), none.alias("own"), none.alias("next"))
    end = F.struct(
        F.concat(tail, F.slice(after, 1, REACH)).alias("w"), own.alias("own"), after.alias("next")
    )
    both = F.when(F.size(after) > 0, F.array(alone, end)).otherwise(F.array(alone))
    return line.select(id_col, F.col("p.place").alias("place"), F.explode_outer(both).alias("u")).select(
        id_col,
        "place",
        F.col("u.w").alias("__l_w"),
        F.col("u.own").alias("__l_own"),
        F.col("u.next").alias("__l_next"),
    )


def made_statements(n: int = MADE, seed: int = 3) -> list[tuple[str, str]]:
    """(line, family): templates with other words around them or cut, some words lost or recased."""
    rng = random.Random(seed)
    syllables = ["ba", "er", "th", "on", "in", "ly", "qu", "sch", "ment", "os", "ti", "re"]

    def filler(low: int, high: int) -> list[str]:
        return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]

    out = []
    for family, template in _all_templates():
        for _ in range(n):
            own = template.split()
            if len(own) > 5 and rng.random() < 0.4:
                del own[rng.randrange(len(own))]
            text = [*filler(0, 6), *own, *filler(0, 12)]
            if len(own) > 10 and rng.random() < 0.4:  # a line of a wrapped statement
                size = rng.randint(5, len(own) - 1)
                begin = rng.randint(0, len(own) - size)
                text = own[begin : begin + size]
            elif rng.random() < 0.3:
                text = [*filler(1, 2), "copyright", str(rng.randint(1990, 2030)), *text]
            line = " ".join(text)
            out.append((rng.choice([line, line, line.lower(), line.upper()]), family))
    odd = ["license", "licence", "copyright", "permission", "warranty", "version", "public", "under", "rights"]
    for _ in range(n * 8):
        text = filler(2, 25)
        for _ in range(rng.randint(0, 2)):
            text.insert(rng.randrange(len(text)), rng.choice(odd))
        out.append((" ".join(text), UNKNOWN))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenceModel:
    """Fits to made statements and a bounded sample; a fifth is held out for calibration."""
    spark: SparkSession = docs.sparkSession
    made = spark.createDataFrame(made_statements(), "line string, family string")
    first = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    other = docs.select(
        id_col, F.get(first, F.pmod(F.xxhash64(id_col), F.size(first)).cast("int")).alias("line")
    ).select("line", F.xxhash64(id_col, "line").alias("h"))
    # Hashes alone are ordered, so that no task gathers the lines of all others.
    last = other.select("h").orderBy("h").limit(SAMPLE_LINES).agg(F.max("h")).first()[0]
    other = other.filter(F.col("h") <= F.lit(last)).limit(SAMPLE_LINES)
    other = other.select("line", F.lit(UNKNOWN).alias("family"), F.lit(True).alias("sampled"))
    every = made.withColumn("sampled", F.lit(False)).unionByName(other)
    binned = _binned(every.withColumn("__l_w", _words(_plain(F.col("line")))))
    templates = _template_grams(spark)
    # A sampled line that a template confirms states a licence, and teaches nothing here.
    rows = [
        r
        for r in binned.select("family", "__l_b", "__l_2", "line", "sampled").collect()
        if not (r["sampled"] and any(_share(set(r["__l_2"]), g) >= CONFIRMED for _, g in templates))
    ]
    rows.sort(key=lambda r: (r["family"], r["line"]))
    places = {f: float(n) for n, f in enumerate(FAMILIES)}
    data = [
        (places[r["family"]], Vectors.sparse(BINS, sorted({(b, 1.0) for b in r["__l_b"]})))
        for r in rows
    ]
    held, used = data[::5], [d for k, d in enumerate(data) if k % 5]
    model = LogisticRegression(
        featuresCol="x", labelCol="y", family="multinomial", maxIter=60, regParam=1e-3
    ).fit(spark.createDataFrame(used, ["y", "x"]).coalesce(1))
    weights = model.coefficientMatrix.toArray()
    intercepts = model.interceptVector.toArray()
    logits = [(int(y), weights[:, x.indices].sum(axis=1) + intercepts) for y, x in held]

    def loss(t: float) -> float:
        return sum(
            math.log(sum(math.exp((v - z.max()) / t) for v in z)) - (z[y] - z.max()) / t
            for y, z in logits
        )

    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=loss)
    sure = sorted(
        1 / sum(math.exp((v - z[y]) / temperature) for v in z)
        for y, z in logits
        if FAMILIES[y] != UNKNOWN
    )
    threshold = sure[int(len(sure) * (1 - RECALL))] if sure else 1.0
    return LicenceModel(
        tuple(tuple(map(float, w)) for w in weights),
        tuple(map(float, intercepts)),
        temperature,
        min(threshold, 0.5),
    )


def _literal(values: tuple[float, ...]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _template_grams(spark: SparkSession) -> list[tuple[str, list[str]]]:
    rows = [(f, k, t) for k, (f, t) in enumerate(_all_templates())]
    made = spark.createDataFrame(rows, "family string, k int, line string").coalesce(1)
    found = made.withColumn("__l_w", _words(_plain(F.col("line")))).withColumn("__l_2", _pairs("__l_w"))
    return [(r["family"], sorted(set(r["__l_2"]))) for r in sorted(found.collect(), key=lambda r: r["k"])]


def _share(pairs: set[str], template: list[str]) -> float:
    """The share of the shorter side's pairs that stand in the other; see _overlap."""
    return len(pairs.intersection(template)) / max(min(len(template), max(len(pairs), LEAST_PAIRS)), 1)


def _overlap(pairs: str, family: str, templates: list[tuple[str, list[str]]]) -> Column:
    """The largest _share over the templates of a family."""
    by_family: dict[str, list[Column]] = {}
    for name, grams in templates:
        own = F.split(F.lit("\n".join(grams)), "\n")
        least = F.least(F.lit(len(grams)), F.greatest(F.size(pairs), F.lit(LEAST_PAIRS)))
        by_family.setdefault(name, []).append(F.size(F.array_intersect(pairs, own)) / least.cast("double"))
    overlap = F.lit(0.0)
    for name, shares in by_family.items():
        most = F.greatest(*shares) if len(shares) > 1 else shares[0]
        overlap = F.when(F.col(family) == name, most).otherwise(overlap)
    return overlap


def _lead(model: LicenceModel, group: list[int]) -> tuple[float, list[float]]:
    """How far the families of a group lead the class unknown at most: by the intercept, and
    by each bin."""
    unknown = FAMILIES.index(UNKNOWN)
    bins = [max(model.weights[k][b] - model.weights[unknown][b] for k in group) for b in range(BINS)]
    return max(model.intercepts[k] - model.intercepts[unknown] for k in group), bins


def _others() -> list[int]:
    return [k for k, f in enumerate(FAMILIES) if f != UNKNOWN]


def _least(model: LicenceModel) -> float:
    """The lead that a family at the threshold has.

    A family of probability p leaves unknown 1 - p at most, so its logit leads that of unknown
    by log(p / (1 - p)) times the temperature or more. The small slack is for the order of
    the sums.
    """
    p = min(max(model.threshold, 1e-12), 1 - 1e-12)
    return model.temperature * math.log(p / (1 - p)) - 1e-6


def _gate(model: LicenceModel) -> Column:
    """False only where no family can reach the threshold.

    No family of a group leads by more than the sum of the bins' largest leads in the group:
    all families first, then a few at a time.
    """
    least = F.lit(_least(model))

    def reached(group: list[int]) -> Column:
        first, lead = _lead(model, group)
        table = _literal(tuple(lead))
        return F.aggregate("__l_b", F.lit(first), lambda a, b: a + F.get(table, b)) >= least

    others = _others()
    groups = [reached(others[k : k + GROUP]) for k in range(0, len(others), GROUP)]
    return reached(others) & reduce(or_, groups)


#: Bits of a field in a packed sum, and fields of one.
FIELD = 21
FIELDS = 3
#: Passages with more grams are not bounded; the fields hold the sums of the others.
MOST_GRAMS = 2000


def _packed(model: LicenceModel) -> tuple[tuple[int, ...], list[int]]:
    """For every bin the largest leads in ``FIELDS`` groups of families, as rounded numbers in
    fields of one; and for each group the least sum that may reach the threshold.

    A sum of packed numbers is the packed sums: fields may borrow, which unpacking undoes.
    """
    others = _others()
    groups = [_lead(model, others[g::FIELDS]) for g in range(FIELDS)]
    top = max([abs(x) for _, bins in groups for x in bins] + [1e-9])
    scale = (2 ** (FIELD - 1) - 1) / (MOST_GRAMS * (top + 1))
    packed = tuple(
        sum(round(bins[b] * scale) << FIELD * g for g, (_, bins) in enumerate(groups)) for b in range(BINS)
    )
    return packed, [math.floor((_least(model) - first) * scale) for first, _ in groups]


def _may_reach(total: Column, n: Column, least: list[int]) -> Column:
    """Whether a packed sum of n numbers may reach the least of any group; each number may be
    rounded down by a half."""
    half, mask = 1 << (FIELD - 1), (1 << FIELD) - 1
    slack = n / F.lit(2) + F.lit(1)
    reached = n > MOST_GRAMS
    for bound in least:
        low = (total.bitwiseAND(F.lit(mask)).bitwiseXOR(F.lit(half))) - F.lit(half)
        reached = reached | (low + slack >= F.lit(bound))
        total = F.shiftright(total - low, FIELD)
    return reached


def _possible(docs: DataFrame, model: LicenceModel, id_col: str, text_col: str) -> DataFrame:
    """Those of ``paragraphs`` that may reach the threshold.

    Words and pairs are hashed once, where they stand; the grams of a line, and those on both
    sides of its end, are picked from these hashes, made distinct, and summed in one pass for
    all groups of families. Only passages that pass are built.
    """
    packed, least = _packed(model)
    table = F.split(F.lit(",".join(map(str, packed))), ",").cast("array<bigint>")

    def hashed(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(F.concat_ws(" ", a, b))
        )
        return F.struct(w.alias("w"), F.transform(w, lambda x: F.xxhash64(x)).alias("h"), pairs.alias("p"))

    def last(x: Column, most: int) -> Column:
        return F.slice(x, F.greatest(F.size(x) - most + 1, F.lit(1)), F.lit(most))

    def gathered(t: Column, i: Column) -> Column:
        after = F.get("__l_lines", i + 1)
        both = (F.size(t["w"]) > 0) & (F.size(after["w"]) > 0)
        across = F.xxhash64(F.concat_ws(" ", F.get(t["w"], F.size(t["w"]) - 1), F.get(after["w"], F.lit(0))))
        end = F.concat(
            last(t["h"], REACH),
            last(t["p"], REACH - 1),
            F.array(across),
            F.slice(after["h"], 1, REACH),
            F.slice(after["p"], 1, REACH - 1),
        )
        return F.struct(
            i.alias("place"),
            t["w"].alias("own"),
            after["w"].alias("next"),
            F.array_distinct(F.concat(t["h"], t["p"])).alias("alone"),
            F.when(both, F.array_distinct(end)).alias("end"),
        )

    def summed(t: Column) -> Column:
        def of(grams: Column) -> Column:
            zero = F.lit(0).cast("bigint")
            return F.aggregate(
                grams, zero, lambda a, x: a + F.get(table, F.pmod(x, F.lit(BINS)).cast("int"))
            )

        return F.struct(
            *(t[c].alias(c) for c in ("place", "own", "next")),
            F.size(t["alone"]).alias("n_alone"),
            F.when(F.size(t["alone"]) <= MOST_GRAMS, of(t["alone"])).otherwise(0).alias("alone"),
            F.size(t["end"]).alias("n_end"),
            of(t["end"]).alias("end"),
        )

    def judged(t: Column) -> Column:
        return F.struct(
            *(t[c].alias(c) for c in ("place", "own", "next")),
            ((t["n_alone"] > 0) & _may_reach(t["alone"], t["n_alone"], least)).alias("alone"),
            F.coalesce((t["n_end"] > 0) & _may_reach(t["end"], t["n_end"], least), F.lit(False)).alias("end"),
        )

    lines = docs.select(id_col, F.transform(F.split(_plain(F.col(text_col)), "\n"), _words).alias("__l_lines"))
    steps = (lambda x: F.transform(x, hashed), lambda x: F.transform(x, gathered), lambda x: F.transform(x, summed))
    for step in steps:
        lines = _worked_out(lines, {"__l_made": step("__l_lines")}).drop("__l_lines").withColumnRenamed("__l_made", "__l_lines")
    near = F.filter(F.transform("__l_lines", judged), lambda c: c["alone"] | c["end"])
    near = _worked_out(lines, {"__l_near": near}).select(id_col, F.explode("__l_near").alias("p"))
    own, after = F.col("p.own"), F.col("p.next")
    none = F.lit(None).cast("array<string>")
    alone = F.struct(own.alias("w"), none.alias("own"), none.alias("next"))
    end = F.struct(F.concat(last(own, REACH), F.slice(after, 1, REACH)).alias("w"), own.alias("own"), after.alias("next"))
    units = F.concat(
        F.when(F.col("p.alone"), F.array(alone)).otherwise(F.slice(F.array(alone), 1, 0)),
        F.when(F.col("p.end"), F.array(end)).otherwise(F.slice(F.array(end), 1, 0)),
    )
    return near.select(id_col, F.col("p.place").alias("place"), F.explode_outer(units).alias("u")).select(
        id_col,
        "place",
        F.col("u.w").alias("__l_w"),
        F.col("u.own").alias("__l_own"),
        F.col("u.next").alias("__l_next"),
    )


def _worked_out(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns behind a generator, so that no later filter repeats them below itself."""
    row = F.explode_outer(F.array(F.struct(*(c.alias(n) for n, c in columns.items()))))
    return df.select("*", row.alias("__l_row")).select("*", "__l_row.*").drop("__l_row")


def scanned(
    docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, place, family, probability, overlap) of every line with a likely family."""
    binned = _binned(_possible(docs, model, id_col, text_col)).drop("__l_2").withColumnRenamed("__l_b", "__l_h")
    lines = _worked_out(binned, {"__l_b": F.col("__l_h")}).drop("__l_h").filter(_gate(model))

    def logit(k: int) -> Column:
        table = _literal(model.weights[k])
        total = F.aggregate("__l_b", F.lit(model.intercepts[k]), lambda a, b: a + F.get(table, b))
        return total / F.lit(model.temperature)

    scored = _worked_out(lines, {"__l_z": F.array(*map(logit, range(len(FAMILIES))))})
    top = F.array_max("__l_z")
    best = F.get(F.array(*map(F.lit, FAMILIES)), (F.array_position("__l_z", top) - 1).cast("int"))
    spread = F.aggregate(
        F.transform("__l_z", lambda z: F.exp(z - F.array_max("__l_z"))), F.lit(0.0), lambda a, b: a + b
    )
    likely = _worked_out(scored, {"__l_f": best, "probability": 1 / spread}).filter(
        (F.col("__l_f") != UNKNOWN) & (F.col("probability") >= model.threshold)
    )
    templates = _template_grams(docs.sparkSession)
    passages = {"overlap": "__l_w", "__l_before": "__l_own", "__l_after": "__l_next"}
    pairs = {f"__l_2{n}": F.array_distinct(_pairs(w)) for n, w in passages.items()}
    found = _worked_out(likely, pairs)
    found = _worked_out(found, {n: _overlap(f"__l_2{n}", "__l_f", templates) for n in passages})
    sure = F.col("overlap") >= CONFIRMED
    told = (F.col("__l_before") >= CONFIRMED) | (F.col("__l_after") >= CONFIRMED)
    return (
        found.filter(F.col("__l_own").isNull() | (sure & ~told))
        .withColumn("family", F.when(sure, F.col("__l_f")).otherwise(F.lit(UNKNOWN)))
        .select(id_col, "place", "family", "probability", "overlap")
    )
