"""License notices in texts: MinHash bands over overlapping windows find templates, shingle containment verifies them.

Templates fall into classes by their number of shingles n, each from 2^c to 2^(c+1) - 1. For a class, a text is cut into
windows of 3 * 2^c shingles that begin every 2^c, so any place a template can stand in lies inside one window. A window
that holds at least 80 % of a template's shingles has a Jaccard similarity to it of 0.8 / 3.2 = 0.25 or more, and 32
bands of one MinHash each meet with a probability of at least 1 - 0.75^32 = 0.9999. What the bands retrieve is checked
exactly. Everything is Spark's own functions.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.operators.skew import join_on
from feedkit.session import written

SHINGLE = 5
PERCENT = 80
BANDS = 32
STRIDES = 3

# License identifiers and public notices that name them. A notice has at least SHINGLE words.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)

_NO_WORD = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


def folded(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """Runs of a-z, digits and characters beyond ASCII of a folded text; an empty array for null."""
    found = F.split(F.regexp_replace(text, _NO_WORD, " "), " ")
    return F.coalesce(F.filter(found, lambda w: w != ""), F.array().cast("array<string>"))


def shingles_of(words: Column) -> Column:
    """64-bit hashes of all runs of SHINGLE words, in order."""
    size = F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0))
    # Shifted copies side by side, so that the words are worked out once and not once per place.
    runs = F.arrays_zip(*[F.slice(words, F.lit(k + 1), size).alias(f"w{k}") for k in range(SHINGLE)])
    return F.transform(runs, lambda r: F.xxhash64(*[r[f"w{k}"] for k in range(SHINGLE)]))


def _plain_words(text: str) -> list[str]:
    folded = "".join(c.lower() if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text)
    return folded.split()


def _plain_shingles(text: str) -> list[tuple[str, ...]]:
    words = _plain_words(text)
    return [tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def marks(templates=TEMPLATES) -> list[str]:
    """Words of which every window that passes for a template holds one.

    A window that holds enough of a template's shingles misses a few of them at most. So it is enough that, of every
    template, one shingle more than that holds a marked word. Long words are rare, and picked first.
    """
    need = []
    for _, text in templates:
        shingles = {frozenset(s) for s in _plain_shingles(text)}
        n = len(set(_plain_shingles(text)))
        if n:
            need.append([shingles, n - -(-PERCENT * n // 100) + 1])
    chosen: list[str] = []
    while any(short > 0 for _, short in need):
        held = Counter(w for shingles, short in need if short > 0 for w in set().union(*shingles))
        best = max(held, key=lambda w: (len(w) * held[w] ** 0.5, w))
        chosen.append(best)
        for entry in need:
            covered = {s for s in entry[0] if best in s}
            entry[0] -= covered
            entry[1] -= len(covered)
    return chosen


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """Rows (template, license, cls, n, wanted): the class and the distinct shingles of each template. As many as given."""
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(templates)], "template int, license string, notice string")
    rows = rows.withColumn("wanted", F.array_distinct(shingles_of(words_of(folded(F.col("notice"))))))
    n = F.size("wanted")
    return rows.filter(n > 0).select("template", "license", F.floor(F.log2(n)).cast("int").alias("cls"), n.alias("n"), "wanted")


def _bands(shingles: Column) -> Column:
    """The smallest hash of the shingles under each of BANDS hash functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.struct(k.alias("band"), F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, k))).alias("low")),
    )


def find_licenses(docs: DataFrame, templates=TEMPLATES, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, license, template, first_word, n_shingles): windows of a text that hold a template.

    ``first_word`` is where the window begins, ``n_shingles`` how many of the template's shingles it holds. Null and
    short texts hold nothing. Rows that repeat an id are each searched, and what they hold is reported for the id once
    per window. A null id is reported as null. Other columns are left out.
    """
    spark = docs.sparkSession
    # Written, so that their size is known before the joins are planned and the texts are not shuffled for them.
    table = written(template_table(spark, templates))
    marked = marks(templates)
    some = F.lit(False)
    for word in marked:
        some = some | F.contains("_lower", F.lit(word))
    # Only windows with a marked word can pass, so only these are made.
    rows = docs.select(F.col(id_).alias("id"), folded(F.col(text)).alias("_lower")).filter(some)
    rows = rows.select("id", words_of(F.col("_lower")).alias("words"))
    spots = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(marked), i)))
    rows = rows.select("id", "words", spots.alias("spots")).filter((F.size("spots") > 0) & (F.size("words") >= SHINGLE))
    sizes = (len(set(_plain_shingles(t))) for _, t in templates)
    classes = F.array(*[F.lit(c) for c in sorted({n.bit_length() - 1 for n in sizes if n})])
    rows = rows.select("*", F.explode(classes).alias("cls")).withColumn("step", F.pow(F.lit(2), F.col("cls")).cast("int"))
    long_ = F.col("step") * STRIDES + SHINGLE - 1

    def around(spot: Column) -> Column:
        first = F.greatest(F.ceil((spot - long_ + 1) / F.col("step")), F.lit(0)).cast("int")
        return F.transform(F.sequence(first, F.floor(spot / F.col("step")).cast("int")), lambda w: w * F.col("step"))

    rows = rows.withColumn("first", F.explode(F.array_distinct(F.flatten(F.transform("spots", around)))))
    windows = rows.select("id", "cls", "first", shingles_of(F.slice("words", F.col("first") + 1, long_)).alias("s"))
    windows = windows.filter(F.size("s") > 0)
    keyed = windows.select("*", F.inline(_bands(F.col("s"))))
    # As many rows as templates times BANDS.
    keys = table.select(F.col("template").alias("t"), F.col("cls").alias("t_cls"), F.inline(_bands(F.col("wanted"))))
    keys = written(keys.withColumnsRenamed({"band": "t_band", "low": "t_low"}))
    met = join_on(keyed, keys, {"cls": "t_cls", "band": "t_band", "low": "t_low"}, "inner")
    met = met.groupBy("id", "cls", "first", "t").agg(F.first("s").alias("s"))
    both = join_on(met, table.drop("cls"), {"t": "template"}, "inner").withColumnRenamed("t", "template")
    sure = both.withColumn("held", F.size(F.array_intersect("s", "wanted"))).filter(100 * F.col("held") >= PERCENT * F.col("n"))
    return sure.groupBy("id", "license", "template", "first").agg(F.max("held").alias("n_shingles")).select(
        "id", "license", "template", F.col("first").alias("first_word"), "n_shingles"
    )


def license_digest(docs: DataFrame, templates=TEMPLATES, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, n_templates (templates it holds) and licenses (their sorted identifiers, comma-joined)."""
    found = find_licenses(docs, templates, id_, text).groupBy("id").agg(
        F.countDistinct("template").alias("n"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("names")
    )
    joined = join_on(docs.select(F.col(id_).alias("_d")), found.filter("id IS NOT NULL"), {"_d": "id"})
    return joined.select(
        F.col("_d").alias(id_), F.coalesce("n", F.lit(0)).cast("long").alias("n_templates"), F.coalesce("names", F.lit("")).alias("licenses")
    )
