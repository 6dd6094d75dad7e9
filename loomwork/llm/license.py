"""Licence notices by the Dice coefficient over word bigrams, in native DataFrame expressions only.

A text is normalised to lower-case words of a-z and 0-9, whatever its line ends and marks,
so a notice may be wrapped, quoted or stand inside a longer sentence. Two sets of a and b
bigrams have a Dice coefficient of at most 2 min(a, b) / (a + b); so a template matched at
threshold t lacks (2 - 2t) / (2 - t) of its bigrams at most, and any (that many + 1) of
them, its anchors, form a test that a matching text must pass. Texts with no anchor are
left out before they are cut into words. Each anchor found in the others places the
template: the window of as many words as the template has, in which the anchor stands
where the template has it, is compared with the template, unless its size already rules a
match out. Everything is row-local but the last sum by document.
"""

from __future__ import annotations

from functools import reduce
from math import floor
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The usual notices, headers and grants of common licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal."],
    "EPL-2.0": ["Licensed under the Eclipse Public License, Version 2.0."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "ISC": [
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    ],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0."],
    "Proprietary": ["All rights reserved."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


def words_of(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _pairs(text: str) -> list[str]:
    w = words_of(text)
    return [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def anchors_of(texts: list[str], least: float) -> tuple[list[set[str]], list[str]]:
    """For each text bigrams of which every text that matches it holds at least one, and words of which every such bigram holds one.

    Words are chosen greedily, those first that fill most of what texts still need, long ones before short ones.
    """
    grams = [sorted(set(_pairs(t))) for t in texts]
    need = [floor(len(g) * (2 - 2 * least) / (2 - least) + 1e-9) + 1 for g in grams]
    have: list[set[str]] = [set() for _ in texts]
    chosen: list[str] = []

    def gain(word: str) -> float:
        fills = sum(min(n - len(h), sum(word in g.split() and g not in h for g in own)) for own, n, h in zip(grams, need, have, strict=True))
        return fills * min(len(word), 7) ** 4

    while any(len(h) < n for h, n in zip(have, need, strict=True)):
        word = max(sorted({w for own in grams for g in own for w in g.split()}), key=gain)
        chosen.append(word)
        for own, n, h in zip(grams, need, have, strict=True):
            h |= set([g for g in own if word in g.split() and g not in h][: max(0, n - len(h))])
    return have, chosen


def _table(templates: dict[str, list[str]], least: float) -> tuple[list[tuple[str, list[str], int]], list[tuple[str, int, int]], list[str]]:
    """Templates with bigrams as (licence, bigrams, words); anchors as (bigram, template, place in it); words that anchors hold."""
    known = [(k, t) for k, texts in templates.items() for t in texts if _pairs(t)]
    chosen, marks = anchors_of([t for _, t in known], least)
    anchors = [(g, i, p) for i, ((_, t), own) in enumerate(zip(known, chosen, strict=True)) for p, g in enumerate(_pairs(t)) if g in own]
    return [(k, sorted(set(_pairs(t))), len(words_of(t))) for k, t in known], anchors, marks


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """``doc_id, license, dice, places`` of every licence found in every text.

    dice: the best coefficient, rounded to six places; places: at how many words of the
    text windows that reach ``least`` begin. Templates of one word have no bigrams and match nothing;
    null, empty and other texts without a match give no rows; documents that share a
    doc_id are one, a null one too; an empty table gives no rows; other columns are
    ignored. A long text is cut into words only if it holds an anchor.
    """
    known, anchors, marks = _table(templates, least)
    if not known:
        return docs.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("dice"), F.lit(0).cast("long").alias("places")).limit(0)
    lower = docs.select("doc_id", F.explode(F.array(F.lower("text"))).alias("text")).where(F.col("text").isNotNull())  # explode: what is made here is made once
    rare = [m for m in marks if len(m) > 4]
    pairs = sorted({g.replace(" ", "[^a-z0-9]+") for g, _, _ in anchors if not set(g.split()) & set(rare)})  # of short words alone: the pair itself
    tests = [F.contains("text", F.lit(m)) for m in rare] + ([F.col("text").rlike("|".join(pairs))] if pairs else [])
    marked = lower.where(reduce(or_, tests))
    words = marked.select("doc_id", F.explode(F.array(F.split(F.trim(F.regexp_replace("text", "[^a-z0-9]+", " ")), " "))).alias("w"))
    at = "filter(transform(sequence(0, size(w) - 2), i -> struct(i, concat(w[i], ' ', w[i + 1]) as g)), x -> array_contains(grams, x.g))"
    grams = F.array(*[F.lit(g) for g in sorted({g for g, _, _ in anchors})])
    rows = words.where(F.size("w") > 1).withColumn("grams", grams).select("doc_id", "w", F.explode(F.array(F.expr(at))).alias("found")).where(F.size("found") > 0)
    need = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(i).alias("t"), F.lit(p).alias("p"), F.lit(known[i][2]).alias("n")) for g, i, p in anchors])
    windows = """flatten(transform(found, x -> transform(filter(need, y -> y.g = x.g),
                   y -> struct(y.t as t, x.i - y.p as at, slice(w, greatest(x.i - y.p, 0) + 1, y.n + least(x.i - y.p, 0)) as win))))"""
    cut = rows.withColumn("need", need).select("doc_id", F.inline(F.array_distinct(F.expr(windows))))
    own = F.expr("array_distinct(transform(sequence(1, size(win) - 1), i -> concat(win[i - 1], ' ', win[i])))")
    has = F.element_at(F.array(*[F.array(*map(F.lit, g)) for _, g, _ in known]), F.col("t") + 1)
    named = F.element_at(F.array(*[F.lit(k) for k, _, _ in known]), F.col("t") + 1)
    a, b = F.size("own"), F.size("has")
    sized = cut.where(F.size("win") > 1).select("doc_id", "at", named.alias("license"), F.explode(F.array(own)).alias("own"), has.alias("has")).where(2 * F.least(a, b) >= least * (a + b) - 1e-9)
    found = sized.select("doc_id", "license", "at", (2 * F.size(F.array_intersect("own", "has")) / (a + b)).alias("dice")).where(F.col("dice") >= least - 1e-9)
    return found.groupBy("doc_id", "license").agg(F.round(F.max("dice"), 6).alias("dice"), F.count_distinct("at").alias("places"))


def oracle(templates: dict[str, list[str]] = TEMPLATES, least: float = 0.8) -> str:
    """The same in DuckDB's SQL, without tests and size bounds."""
    known, anchors, _ = _table(templates, least)
    rows = ", ".join("({}, '{}', [{}], {})".format(i, k, ", ".join(f"'{g}'" for g in grams), n) for i, (k, grams, n) in enumerate(known))
    places = ", ".join(f"('{g}', {i}, {p})" for g, i, p in anchors)
    return f"""
        WITH known(t, license, has, n) AS (VALUES {rows}), anchor(g, t, p) AS (VALUES {places}),
        doc AS (SELECT row_number() OVER () AS k, doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL),
        gram AS (SELECT k, i, w[i] || ' ' || w[i + 1] AS g FROM (SELECT k, w, unnest(range(1, len(w))) AS i FROM doc)),
        spot AS (SELECT DISTINCT k, t, i - p AS pos FROM gram JOIN anchor USING (g)),
        win AS (SELECT doc_id, license, pos, has, list_slice(w, greatest(pos, 1), pos + n - 1) AS v FROM spot JOIN known USING (t) JOIN doc USING (k)),
        scored AS (SELECT doc_id, license, pos, has, list_distinct([v[j] || ' ' || v[j + 1] for j in range(1, len(v))]) AS own FROM win WHERE len(v) > 1),
        dice AS (SELECT doc_id, license, pos, 2.0 * len(list_intersect(own, has)) / (len(own) + len(has)) AS dice FROM scored)
        SELECT doc_id, license, round(max(dice), 6) AS dice, count(DISTINCT pos) AS places FROM dice WHERE dice >= {least} - 1e-9 GROUP BY doc_id, license"""
