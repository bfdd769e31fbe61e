"""Licence scan: Dice coefficient over word bigrams against licence templates.

Every line of a text, and the text as a whole, is a unit.  A unit can reach the
threshold only against templates of a similar number of bigrams, so the size
names the candidates: units and templates meet by an equality join on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.llm.adaptive_quality import let

THRESHOLD = 0.8

# Public licence names and the notices and grants that name them.
TEMPLATES: list[tuple[str, str]] = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def bigrams(unit: Column) -> Column:
    """Neighbouring words of the normalised unit, one entry per occurrence."""
    plain = F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))
    pairs = lambda w: F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return let(F.split(plain, " "), pairs)


def common(a: Column, b: Column) -> Column:
    """Size of the common part of two bags; ``b`` is a template."""
    in_bag = lambda bag, x: F.size(F.filter(bag, lambda y: y == x))
    counts = F.transform(F.array_distinct(b), lambda x: F.least(in_bag(a, x), in_bag(b, x)))
    return F.aggregate(counts, F.lit(0), lambda n, x: n + x)


def sized_templates(spark: SparkSession, templates: Sequence[tuple[str, str]], threshold: float) -> DataFrame:
    """A row per template and admissible unit size: |A| from t/(2-t) |B| to (2-t)/t |B|."""
    rows = F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(t).alias("notice")) for n, t in templates])
    least = F.ceil(F.col("t_size") * (threshold / (2 - threshold)) - 1e-9)
    most = F.floor(F.col("t_size") * ((2 - threshold) / threshold) + 1e-9)
    return (
        spark.range(1)
        .select(F.inline(rows))
        .select("licence", bigrams(F.col("notice")).alias("t_bigrams"))
        .withColumn("t_size", F.size("t_bigrams"))
        .withColumn("size", F.explode(F.sequence(least, most)))
    )


def scan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per match: doc_id, line (from 1; 0 is the whole text), licence, dice.

    A unit names the template it is most like; ties go to the licence that sorts
    first.  NULL and empty texts, and units of fewer than two words, match
    nothing.  Repeated rows match each for itself; an empty table gives no rows.
    """
    table = sized_templates(docs.sparkSession, templates, threshold)
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    units = let(lines, lambda x: F.concat(F.when(F.size(x) > 1, F.array(F.col(text))).otherwise(F.array(F.lit(""))), x))
    # The size bounds of all templates hold before the join: (2-t)/t of the longest, t/(2-t) of the shortest.
    sized = (
        docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(units).alias("line", "unit"))
        .select("doc_id", "line", bigrams(F.col("unit")).alias("bigrams"))
        .withColumn("size", F.size("bigrams").cast("long"))
        .filter("size > 0")
    )
    met = sized.join(F.broadcast(table), "size")  # the fixed templates times their admissible sizes
    dice = 2 * common(F.col("bigrams"), F.col("t_bigrams")) / (F.col("size") + F.col("t_size"))
    scored = met.filter(F.arrays_overlap("bigrams", "t_bigrams")).select("doc_id", "line", "bigrams", "licence", dice.alias("dice"))
    best = F.max_by("licence", F.struct(F.col("dice"), negative_name(F.col("licence"), templates)))
    return (
        scored.filter(F.col("dice") >= threshold)
        .groupBy("doc_id", "line")
        .agg(best.alias("licence"), F.max("dice").alias("dice"))
    )


def negative_name(licence: Column, templates: Sequence[tuple[str, str]]) -> Column:
    """Falls as names rise, so that of equal scores the first name wins."""
    order = {name: -i for i, name in enumerate(sorted({n for n, _ in templates}))}
    return F.create_map(*[F.lit(x) for item in order.items() for x in item])[licence]


def by_document(docs: DataFrame, **options) -> DataFrame:
    """One row per document id: the licences found, the best score, the number of matching units."""
    found = scan(docs, **options).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("licence")).alias("licences"),  # no more than the templates name
        F.max("dice").alias("dice"),
        F.count("*").alias("n_matches"),
    )
    ids = docs.select(F.col(options.get("doc_id", "doc_id")).alias("_id"))
    return ids.join(found, F.col("_id").eqNullSafe(F.col("doc_id")), "left").select(
        F.col("_id").alias("doc_id"),
        F.coalesce(F.array_join("licences", ","), F.lit("")).alias("licences"),
        F.coalesce("dice", F.lit(0.0)).alias("dice"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
    )


def oracle() -> str:
    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
    words = lambda c: f"string_split(trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    pairs = lambda c: f"[x[1] || ' ' || x[2] for x in list_zip({c}[:-2], {c}[2:])]"
    return f"""
with notices(licence, notice) as (values {values}),
templates as (select licence, row_number() over () as t, {pairs(words("notice"))} as bag from notices),
units as (
  select doc_id, unnest(case when text like '%' || chr(10) || '%' then [text] else [] end || string_split(text, chr(10))) as unit
  from documents where text is not null),
bags as (select doc_id, row_number() over () as u, {pairs(words("unit"))} as bag from units),
sized as (select * from bags where len(bag) between (select min(len(bag)) * 0.66 from templates) and (select max(len(bag)) * 1.51 from templates)),
left_side as (select doc_id, u, len(bag) as size, unnest(bag) as pair from sized),
a as (select doc_id, u, size, pair, count(*) as n from left_side group by all),
right_side as (select licence, t, len(bag) as size, unnest(bag) as pair from templates),
b as (select licence, t, size, pair, count(*) as n from right_side group by all),
scored as (
  select doc_id, u, licence, t, 2 * sum(least(a.n, b.n)) / (a.size + b.size) as dice
  from a join b using (pair) group by doc_id, u, licence, t, a.size, b.size),
best as (
  select doc_id, u, licence, dice from scored where dice >= 0.8
  qualify row_number() over (partition by doc_id, u order by dice desc, licence) = 1),
found as (select doc_id, string_agg(distinct licence, ',' order by licence) as licences, max(dice) as dice, count(*) as n_matches from best group by doc_id)
select d.doc_id, coalesce(licences, '') as licences, coalesce(dice, 0.0) as dice, coalesce(n_matches, 0) as n_matches
from documents d left join found f using (doc_id)"""
