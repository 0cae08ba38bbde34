"""Licence scan by Dice coefficient over word bigrams (operator 9). DataFrame functions only."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import let, materialise, pick
from tessera.llm.decontaminate import tokens

THRESHOLD = 0.8
#: Most (size, template) rows of a template table that are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000

# Notices and paragraphs by which public licences are stated.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                     "conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license_id string, text string")


def bigrams(t: Column) -> Column:
    """Distinct word bigrams of a token array, hashed; a single word stands for itself."""
    return let(t, lambda w: F.when(F.size(w) > 1, F.array_distinct(F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.xxhash64(
        x, F.get(w, i + 1))))).otherwise(F.transform(w, lambda x: F.xxhash64(x))))


def units(docs: DataFrame) -> DataFrame:
    """``doc_id, unit, place, text``: every line, every paragraph of several lines, and the whole text if it has several paragraphs."""
    d = pick(docs, "doc_id", "text").where("text is not null")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.lit("line").alias("unit"), i.alias("place"), x.alias("text")))
    parts = F.filter(F.transform(F.split("text", r"\n[ \t\r]*\n"), lambda x, i: F.struct(F.lit("paragraph").alias("unit"), i.alias("place"), x.alias("text"))),
                     lambda s: F.instr(s["text"], "\n") > 0)
    whole = F.when(F.col("text").rlike(r"\n[ \t\r]*\n"), F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("place"), F.col("text").alias("text")))).otherwise(
        F.array().cast("array<struct<unit:string,place:int,text:string>>"))
    return d.select("doc_id", F.inline(F.concat(lines, parts, whole)))


def _template_rows(templates: DataFrame, threshold: float) -> DataFrame:
    """``license_id, tb, words, need``: distinct bigrams, number of words, and the least bigrams that a match shares."""
    t = pick(templates, "license_id", "text").select("license_id", tokens(F.col("text")).alias("w"))
    t = t.select("license_id", bigrams(F.col("w")).alias("tb"), F.size("w").alias("words")).where(F.size("tb") > 0).distinct()
    return t.withColumn("need", F.ceil(F.size("tb") * threshold / (2 - threshold) - 1e-9).cast("int"))


def passages(docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, license_id, dice, place, n_passages``: templates found anywhere inside texts, across lines and sentences.

    A window has as many words as the template (fewer at the end of the text)
    and begins with one of its bigrams; moving a window to its first shared
    bigram loses none, so no notice is missed for where it stands. Templates
    travel in groups of at most ``BROADCAST_ROWS`` bigrams as one row each, and
    a text only meets those of which it holds enough bigrams (Dice t needs
    t/(2-t) of them). dice is that of the best window (ties: the first), place
    its first word, n_passages the windows that reach the threshold, windows
    that overlap the one before counted with it.
    """
    t = materialise(_template_rows(templates, threshold).where("words > 1"))
    groups = max(1, -(-(t.agg(F.sum(F.size("tb"))).first()[0] or 0) // BROADCAST_ROWS))
    # the words' hashes of every text once, whatever the number of groups
    d = pick(docs, "doc_id", "text").where("text is not null")
    d = d.select("doc_id", let(tokens(F.col("text")), lambda w: F.when(F.size(w) > 1, F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.xxhash64(x, F.get(w, i + 1))))).alias("h"))
    found = None
    for g in range(groups):
        some = t.where(F.pmod(F.xxhash64("tb"), F.lit(groups)) == g) if groups > 1 else t
        row = some.agg(F.collect_list(F.struct("license_id", "tb", "words", "need")).alias("templates"), F.array_distinct(F.flatten(F.collect_list("tb"))).alias("every"), F.min("need").alias("least"))
        part = _windows(d.where("h is not null"), row, threshold)
        found = part if found is None else found.unionByName(part)
    return found


def _windows(d: DataFrame, row: DataFrame, threshold: float) -> DataFrame:
    # one row with at most BROADCAST_ROWS bigrams
    d = d.withColumn("one", F.lit(1)).join(F.broadcast(row.withColumn("one", F.lit(1))), "one").drop("one")
    held = F.array_intersect("h", "every")
    near = let(held, lambda x: F.when(F.size(x) >= F.col("least"), F.filter("templates", lambda k: F.size(F.array_intersect(x, k["tb"])) >= k["need"])))
    d = d.select("doc_id", "h", near.alias("near")).where(F.size("near") > 0).select("doc_id", "h", F.explode("near").alias("k"))

    def windows(k: Column, h: Column) -> Column:
        starts = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(k["tb"], x), i)), lambda i: i.isNotNull())
        enough = let(starts, lambda s: F.filter(s, lambda i, j: F.coalesce(F.get(s, j + k["need"] - 1) <= i + k["words"] - 2, F.lit(False))))
        scored = F.transform(enough, lambda i: let(F.array_distinct(F.slice(h, i + 1, k["words"] - 1)), lambda u: F.struct(
            (2 * F.size(F.array_intersect(u, k["tb"])) / (F.size(u) + F.size(k["tb"]))).alias("dice"), (-i).alias("place"))))
        return F.filter(scored, lambda x: x["dice"] >= threshold - 1e-12)

    d = d.select("doc_id", F.col("k.license_id").alias("license_id"), F.col("k.words").alias("words"), windows(F.col("k"), F.col("h")).alias("x")).where(F.size("x") > 0)
    apart = F.size(F.filter("x", lambda w, j: F.coalesce(F.get("x", j - 1)["place"] - w["place"] >= F.col("words"), F.lit(True))))
    d = d.select("doc_id", "license_id", F.array_max("x").alias("b"), apart.alias("n"))
    return d.select("doc_id", "license_id", F.col("b.dice").alias("dice"), (-F.col("b.place")).alias("place"), F.col("n").cast("long").alias("n_passages"))


def scan(docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Licences found: ``doc_id, license_id, dice, unit, place, n_units, n_passages``, one row per document and licence.

    Every unit of a text (see ``units``), normalised to lower-case words, is
    compared with the templates of fitting size: as a Dice coefficient of
    ``threshold`` t needs sizes within [t/(2-t), (2-t)/t] of each other, a
    unit only meets templates whose size range holds its own. Notices that
    stand inside a unit, or across units, come from ``passages``. dice is the
    best of all (ties: lines before paragraphs before the text before
    passages, then the earliest), n_units the number of units that reach the
    threshold, n_passages the number of passages that do, of the licence's
    template with the most.

    Null and empty texts and templates without words match nothing; a null
    doc_id is reported as null; repeated rows count their units again; empty
    tables give an empty result; extra columns are ignored.
    """
    t = _template_rows(templates, threshold).select("license_id", "tb").distinct()
    lo, hi = threshold / (2 - threshold), (2 - threshold) / threshold
    fits = t.withColumn("n", F.explode(F.sequence(F.ceil(F.size("tb") * lo - 1e-9), F.floor(F.size("tb") * hi + 1e-9))))
    fits = fits.withColumn("n", F.col("n").cast("int"))
    if fits.count() <= BROADCAST_ROWS:
        fits = F.broadcast(fits)
    u = units(docs).select("doc_id", F.when(F.col("unit") == "line", 0).when(F.col("unit") == "paragraph", 1).otherwise(2).alias("kind"), "place",
                           let(bigrams(tokens(F.col("text"))), lambda b: F.struct(F.size(b).alias("n"), b.alias("ub"))).alias("b"))
    # a generator between the bigrams and the join, so that the join's key isn't computed ahead of it a second time
    u = u.select("doc_id", "kind", "place", F.inline_outer(F.array("b")))
    dice = 2 * F.size(F.array_intersect("ub", "tb")) / (F.size("ub") + F.size("tb"))
    hits = u.join(fits, "n").select("doc_id", "license_id", "kind", "place", dice.alias("dice"), F.lit(0).cast("long").alias("n_passages")).where(F.col("dice") >= threshold - 1e-12)
    inside = passages(docs, templates, threshold).select("doc_id", "license_id", F.lit(3).alias("kind"), "place", "dice", "n_passages")
    # a unit counts once per licence, by its best template
    order = F.struct(F.col("dice"), (-F.col("kind")).alias("k"), (-F.col("place")).alias("p"))
    best = hits.unionByName(inside).groupBy("doc_id", "license_id").agg(
        F.max(order).alias("b"), F.count_distinct(F.when(F.col("kind") < 3, F.struct("kind", "place"))).cast("long").alias("n_units"), F.max("n_passages").alias("n_passages"))
    kind = F.get(F.array(*[F.lit(x) for x in ("line", "paragraph", "text", "passage")]), -F.col("b.k"))
    return best.select("doc_id", "license_id", F.col("b.dice").alias("dice"), kind.alias("unit"), (-F.col("b.p")).cast("long").alias("place"), "n_units", "n_passages")
