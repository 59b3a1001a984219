"""Licence families of paragraphs: a sparse n-gram classifier, an unknown class, and templates that must agree."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.models import logistic
from ledgerline.operators.quantiles import quantile_row

from .common import Scratch

# Usual notices of each licence family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
}
FAMILIES = sorted(TEMPLATES)
UNKNOWN = float(len(FAMILIES))


def words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams(w: Column) -> Column:
    """64-bit hashes of words and of pairs of neighbours, each once, from the words' hashes."""
    return F.array_distinct(F.concat(w, F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.xxhash64(a, b))))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, para, grams): the lines of each text that hold a word, with their n-grams."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("para", "line"))
    hashes = F.transform(words(F.col("line")), lambda w: F.xxhash64(w))
    return once(lines.select("doc_id", "para", hashes.alias("w")), "w").where(F.size("w") > 0).select("doc_id", "para", grams(F.col("w")).alias("grams"))


def once(df: DataFrame, column: str) -> DataFrame:
    """``column`` behind a one-row explode: later steps read its value and do not spell out its expression again."""
    return df.withColumn(column, F.explode(F.array(column)))


def template_table(spark) -> DataFrame:
    """(family, label, grams) of every template: as many rows as the list above."""
    rows = [(f, float(FAMILIES.index(f)), t) for f in FAMILIES for t in TEMPLATES[f]]
    return spark.createDataFrame(rows, "family string, label double, text string").select("family", "label", grams(F.transform(words(F.col("text")), lambda w: F.xxhash64(w))).alias("grams"))


def hashed(df: DataFrame, features: int = 1 << 14) -> DataFrame:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=features, binary=True).transform(df)


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, para, held, agreements, grams) of every paragraph; a quarter is held out.

    ``agreements`` has, for each family, the largest share of a template's n-grams that stand in the paragraph. It is
    null where none reaches ``least``: at one half, for an ordinary paragraph. Templates are compared with those n-grams
    of a paragraph that stand in any template, and only where these are enough for that share of the template.
    """
    held = F.pmod(F.xxhash64("doc_id", "para", F.lit("licence")), F.lit(4)) == 0
    known: dict[str, list[list[int]]] = {f: [] for f in FAMILIES}
    for r in template_table(docs.sparkSession).collect():  # as many rows as there are templates
        known[r["family"]].append(r["grams"])
    any_of = sorted({g for templates in known.values() for t in templates for g in t})

    def share(t: list[int]) -> Column:
        common = F.size(F.array_intersect(F.array(*map(F.lit, t)), F.col("shared")))
        return F.when(F.size("shared") >= least * len(t), common / F.lit(float(len(t)))).otherwise(F.lit(0.0))

    best = F.array(*[F.greatest(*map(share, known[f]), F.lit(0.0)) for f in FAMILIES])
    pool = once(paragraphs(docs, id_col, text_col), "grams").select("*", F.array_intersect("grams", F.array(*map(F.lit, any_of))).alias("shared"))
    pool = once(once(pool, "shared").withColumn("best", best), "best")
    return pool.select("doc_id", "para", held.alias("held"), F.when(F.array_max("best") >= least, F.col("best")).alias("agreements"), "grams")


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, para, held, agreements, features): what ``train`` and ``scan_licences`` read of every paragraph.

    Whoever calls both writes it once; it takes about the size of the texts.
    """
    return hashed(compared(docs, id_col, text_col, least)).drop("grams")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seen: DataFrame | None = None) -> tuple[PipelineModel, float]:
    """(classifier, threshold) from the templates and every ordinary paragraph of ``docs``.

    Two regressions on the same n-grams: one tells the unknown class from all families and learns from every ordinary
    paragraph but the quarter held out; one tells the families apart and learns from the templates. Paragraphs that hold
    half of a template stay out. The quarter held out calibrates: the threshold is the chance of a family that all but
    one in a thousand of its paragraphs stay below, at least one half. ``seen`` is what ``featured`` makes of ``docs``,
    written; without it, it is written here.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "licences")
    seen = scratch.write(featured(docs, id_col, text_col), "seen") if seen is None else seen
    plain = seen.where(F.col("agreements").isNull())
    taught = plain.where(~F.col("held")).select(F.lit(UNKNOWN).alias("label"), "features")
    known = template_table(spark).select("label", "grams")
    # A notice often has words of its own around it: each template also teaches with an ordinary paragraph behind it.
    behind = F.broadcast(compared(docs, id_col, text_col).where(F.col("agreements").isNull() & ~F.col("held")).select(F.col("grams").alias("more")).limit(8))
    mixed = known.join(behind, F.lit(True)).select("label", F.array_union("grams", F.slice("more", 1, 60)).alias("grams"))
    notices = scratch.write(hashed(known.unionByName(mixed)).select("label", "features").coalesce(1), "notices")
    # The last class has to be seen even where no paragraph is ordinary.
    blank = hashed(spark.range(1).select(F.lit(UNKNOWN).alias("label"), F.array(F.xxhash64(F.lit("-"))).alias("grams"))).select("label", "features")
    each = max(1, taught.count()) / (len(FAMILIES) * 10)
    is_known = F.col("label") != UNKNOWN
    shown = notices.unionByName(blank).coalesce(1).unionByName(taught)
    shown = shown.select("*", is_known.cast("double").alias("known"), F.when(is_known, F.lit(max(1.0, each))).otherwise(F.lit(1.0)).alias("weight"))
    any_family = LogisticRegression(family="binomial", labelCol="known", weightCol="weight", regParam=1e-3, maxIter=30, probabilityCol="chances", rawPredictionCol="odds", predictionCol="is_known").fit(shown)
    which = logistic("label", family="multinomial", regParam=1e-3, maxIter=30, probabilityCol="shares", rawPredictionCol="margins", predictionCol="likeliest").fit(notices)
    chances = scratch.write(any_family.transform(plain.where("held").select("features")).select(F.get(vector_to_array("chances"), F.lit(1)).alias("p")), "chances")
    level = quantile_row(chances, ["p"], [0.999], stored=True).first()["p_q"]
    return PipelineModel([any_family, which]), max(0.5, min(0.95, level[0] if level else 0.5))


def scan_licences(docs: DataFrame, model: PipelineModel, threshold: float, id_col: str = "doc_id", text_col: str = "text", confirm: float = 0.8, seen: DataFrame | None = None) -> DataFrame:
    """(doc_id, para, family, p, agreement): paragraphs whose family the classifier names and a template confirms.

    A paragraph is named if the chance that it is of any family reaches ``threshold``; its family is the likeliest one.
    It is confirmed if ``confirm`` of the n-grams of one of that family's templates stand in it. Null, empty and blank
    texts have no paragraphs; repeated rows are scanned each for itself. Nothing is shuffled. ``seen`` is what
    ``featured`` makes of ``docs`` for a ``least`` of at most ``confirm``, if it is written already.
    """
    scored = model.transform(featured(docs, id_col, text_col, confirm) if seen is None else seen)
    scored = once(scored.select("doc_id", "para", "agreements", F.get(vector_to_array("chances"), F.lit(1)).alias("chance"), vector_to_array("shares").alias("shares")), "chance")
    named = once(scored.where(F.col("chance") >= threshold), "shares")
    best = F.array_max("shares")
    place = F.array_position("shares", best).cast("int") - 1
    named = named.select("doc_id", "para", F.get(F.array(*map(F.lit, FAMILIES)), place).alias("family"), (F.col("chance") * best).alias("p"), F.get("agreements", place).alias("agreement"))
    return named.where(F.col("agreement") >= confirm)
