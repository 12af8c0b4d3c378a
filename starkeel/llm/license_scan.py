"""Licence notices found by Dice coefficient over word bigrams, in SQL functions only.

Every line of a text, and every paragraph of several lines, is normalised to
words of a-z and 0-9 and compared with licence templates by the Dice
coefficient of their sets of word bigrams. Two bounds spare comparisons and
lose nothing:

- a pair can only reach the threshold t if the sizes of both sets are within a
  factor of (2 - t) / t;
- a pair shares at least t / (2 - t) of the template's bigrams, so a unit that
  has none of certain words (``anchors``, chosen so that fewer bigrams are left
  without one) cannot match. Texts without any anchor are not even split.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Wordings of common licence notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def bigrams(text: str) -> set[str]:
    w = words(text)
    return {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}


def anchors(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every unit that reaches the threshold has one.

    Per template the longest words first, until the bigrams without any of
    them are fewer than a match must share.
    """
    found: set[str] = set()
    for _, text in templates:
        own = bigrams(text)
        must = math.ceil(threshold / (2 - threshold) * len(own) - 1e-9)
        chosen: set[str] = set()
        for w in sorted(set(words(text)), key=lambda w: (len(w), w), reverse=True):
            if sum(not chosen & set(b.split()) for b in own) < must:
                break
            chosen.add(w)
        found |= chosen
    return sorted(found)


def _normal(unit: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " "))


def _bigrams(unit: Column) -> Column:
    w = F.split(unit, " ")
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.slice(pairs, 1, F.greatest(F.size(w) - 1, F.lit(0))))


def _fits(size: Column, n: int, threshold: float) -> Column:
    """Whether a set of ``size`` can reach the threshold with one of ``n``."""
    return ((2 - threshold) * size >= threshold * n - 1e-9) & (threshold * size <= (2 - threshold) * n + 1e-9)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per unit and licence that match: doc_id, unit, unit_no, license, dice, unit_text.

    ``unit`` is ``line`` or ``paragraph``, ``unit_no`` its number in the text
    from 0; of several templates of a licence the best counts. Null and empty
    texts give no row. Repeated rows are scanned each; other columns are not
    read. Nothing is shuffled: a text is read by one task and never leaves it.
    """
    wanted = rf"(?<![a-z0-9])(?:{'|'.join(anchors(templates, threshold))})(?![a-z0-9])"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.lower("text").rlike(wanted))
    units = [
        rows.select("doc_id", F.lit(name).alias("unit"), F.posexplode(F.split("text", cut)).alias("unit_no", "unit_text"))
        for name, cut in (("line", r"\n"), ("paragraph", r"\n[ \t\r]*\n"))
    ]
    found = units[0].unionByName(units[1].filter(F.instr(F.trim(F.col("unit_text")), "\n") > 0))
    found = found.filter(F.lower("unit_text").rlike(wanted))
    found = found.withColumn("own", _bigrams(_normal(F.col("unit_text"))))
    sets = [(name, sorted(bigrams(text))) for name, text in templates]
    scores: dict[str, Column] = {}
    for name, own in sets:
        shared = F.size(F.array_intersect("own", F.array(*map(F.lit, own))))
        dice = F.when(_fits(F.size("own"), len(own), threshold), 2.0 * shared / (F.size("own") + F.lit(len(own))))
        dice = F.coalesce(dice, F.lit(0.0))
        scores[name] = F.greatest(scores[name], dice) if name in scores else dice
    each = F.array(*[F.struct(F.lit(n).alias("license"), d.alias("dice")) for n, d in scores.items()])
    matched = found.select("doc_id", "unit", "unit_no", "unit_text", F.inline(each))
    return matched.filter(F.col("dice") >= threshold - 1e-9)


def oracle_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same over ``documents`` in DuckDB, without the bounds."""
    values = ", ".join(
        f"('{name}', [{', '.join(repr(b) for b in sorted(bigrams(text)))}])" for name, text in templates
    )
    return f"""
with lines as (
    select doc_id, 'line' as unit, unnest(split(text, chr(10))) as unit_text,
        generate_subscripts(split(text, chr(10)), 1) - 1 as unit_no
    from documents
), paragraphs as (
    select * from (
        select doc_id, 'paragraph' as unit, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) as unit_text,
            generate_subscripts(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), 1) - 1 as unit_no
        from documents
    ) where instr(trim(unit_text), chr(10)) > 0
), units as (
    select doc_id, unit, unit_no, unit_text,
        split(trim(regexp_replace(lower(unit_text), '[^a-z0-9]+', ' ', 'g')), ' ') as w
    from (select * from lines union all select * from paragraphs)
), sets as (
    select doc_id, unit, unit_no, unit_text,
        list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) as own
    from units
), templates(license, grams) as (values {values})
select doc_id, unit, unit_no, license, max(dice) as dice from (
    select doc_id, unit, unit_no, license,
        2.0 * len(list_intersect(own, grams)) / (len(own) + len(grams)) as dice
    from sets, templates
) where dice >= {threshold} - 1e-9 group by all
"""
