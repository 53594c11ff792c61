"""Licence scans: Dice coefficient over word bigrams between normalised text and licence templates; DataFrame functions only.

The units of a text are its sentences (a line end also ends one), its paragraphs (parted by blank lines) and the whole.
Units and templates are normalised alike: lower case, every run of characters that are neither letters nor digits is a blank.
With d and t word bigrams (repeats count) of which s are shared, the coefficient is 2 s / (d + t); a unit matches from
THRESHOLD on. Since s is at most the smaller of d and t, a template is a candidate only for units with
t * THRESHOLD / (2 - THRESHOLD) <= d <= t * (2 - THRESHOLD) / THRESHOLD; units that fit no template are dropped
before their bigrams are compared. A unit that matches shares at least t * THRESHOLD / (2 - THRESHOLD) bigrams, so it holds one
of the bigrams ``phrases`` gives, and so does its text: texts without any are not cut, units without any are dropped.

A notice need not be a unit: it may be a part of a sentence, or lie in a comment whose marks and line ends keep its lines
from being a paragraph. So windows slide over the words of the whole text as well (marks and line ends are blanks there): one from
every shared bigram on, of at most t bigrams and up to the last shared one among them, matched like a unit. Of windows that
overlap, the one of the highest coefficient stays (ties: more shared bigrams, then the template listed first, then the first
window). Windows count (as level 4) where no unit of the text matches their licence. Windows hold one of the
``phrases`` for the same reason. Units and windows share one pass over the texts: the text's words count as a unit of level 4.

Near-identical notices of several licences: each unit counts for the one template of the highest coefficient (ties: the
template listed first).

The SQL states the units with TEMPLATES, and no windows, no WORDINGS and no choice among licences; the results are equal
where notices are units of their own that match one licence, as in the given tables.

Shared bigrams are found by an equi-join with the templates' bigrams, a fixed list of a few hundred rows and the only
thing broadcast. What is left after it is small and grouped by row, unit and template. Rows that repeat both doc_id and text count
once. Defined results: null or blank texts match nothing; a table without matches gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm.common import keep_named

THRESHOLD = 0.8

# Names and texts of public licences' notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("All-rights-reserved", "All rights reserved."),
]

# More wordings, and the notices of licences that resemble others.
_LATER = "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_GNU = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License as " + _LATER
WORDINGS = [
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Distributed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", _GNU.format("program", "Affero", 3)),
    ("LGPL-3.0", _GNU.format("library", "Lesser", 3)),
    ("LGPL-3.0", _GNU.format("program", "Lesser", 3)),
    ("LGPL-2.1", _GNU.format("library", "Lesser", "2.1")),
    ("AGPL-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("LGPL-warranty", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
]

_WORDS = "split(trim(regexp_replace(lower({0}), '[^\\\\p{{L}}\\\\p{{N}}]+', ' ')), ' ')"
_BIGRAMS = "transform(sequence(0, size(words) - 2), i -> concat(words[i], ' ', words[i + 1]))"


def template_bigrams(spark: SparkSession, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """template, license, bigram, t_count (times it occurs), t (bigrams of the template), and the bounds low and high of d."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(a).alias("license"), F.lit(b).alias("text")) for i, (a, b) in enumerate(templates)])
    words = spark.range(1).select(F.inline(rows)).withColumn("words", F.expr(_WORDS.format("text")))
    words = words.where("size(words) > 1").withColumn("t", F.expr("size(words) - 1"))
    each = words.select("template", "license", "t", F.explode(F.expr(_BIGRAMS)).alias("bigram"))
    counted = each.groupBy("template", "license", "t", "bigram").agg(F.count("*").alias("t_count"))
    return counted.withColumns({"low": F.col("t") * threshold / (2 - threshold), "high": F.col("t") * (2 - threshold) / threshold})


def phrases(index: list, threshold: float = THRESHOLD) -> list[str]:
    """Bigrams of which every unit and window that matches one of the templates holds at least one: in each template, less
    than t * threshold / (2 - threshold) bigrams are others. Those without short words come first. ``index``: rows of ``template_bigrams``."""
    out: list[str] = []
    rank = lambda r: (r["bigram"] not in out, *sorted(-len(w) for w in r["bigram"].split())[::-1], r["bigram"])
    for k in sorted({r["template"] for r in index}):
        own = [r for r in index if r["template"] == k]
        for r in sorted(own, key=rank):
            t, free = r["t"], sum(x["t_count"] for x in own if x["bigram"] not in out)
            if not free or round(2 * free / (free + t), 6) < threshold:
                break
            if r["bigram"] not in out:
                out.append(r["bigram"])
    return out


def holds(held: list[str]) -> Column:
    """Whether ``words`` hold one of these bigrams."""
    return (F.size("words") > 1) & F.arrays_overlap(F.expr(_BIGRAMS), F.lit(held) if held else F.expr("cast(array() as array<string>)"))


def units(docs: DataFrame, held: list[str]) -> DataFrame:
    """doc_id, text_hash, level (1 sentence, 2 paragraph, 3 text, 4 the text again, for windows), place, words of every unit
    of the texts that hold one of these bigrams."""
    rows = keep_named(docs, {"doc_id": "long", "text": "string"}).where(F.col("text").isNotNull())
    # words are made inside the generators, so that filters on them don't make them again
    words = _WORDS.format("u")
    texts = rows.select("doc_id", "text", F.inline(F.expr(f"array(struct({_WORDS.format('text')} as words))"))).where(holds(held))
    return texts.select("doc_id", F.xxhash64("text").alias("text_hash"), F.inline(F.expr(
        rf"""concat(
            transform(split(regexp_replace(text, '([.!?])\\s+', '$1\n'), '\n'), (u, i) -> struct(1 as level, i as place, {words} as words)),
            transform(split(text, '\n\\s*\n'), (u, i) -> struct(2 as level, i as place, {words} as words)),
            array(struct(3 as level, 0 as place, words), struct(4 as level, 0 as place, words)))""")))


def anchors(templates, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every window that matches one of the templates holds at least one: in each template, less than
    t * threshold / (2 - threshold) bigrams are without them. ``scan`` asks for the stricter ``phrases``."""
    out: list[str] = []
    for _, text in templates:
        words = re.sub(r"[\W_]+", " ", text.lower()).split()
        t = len(words) - 1
        for w in sorted(set(words), key=lambda x: (-len(x), x)):
            free = sum(not {x, y} & set(out) for x, y in zip(words, words[1:]))
            if not free or round(2 * free / (free + t), 6) < threshold:
                break
            out.append(w)
    return out


def scan(docs: DataFrame, templates=TEMPLATES + WORDINGS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and licence: doc_id, license, dice (the best unit's, to six places), level (of the best
    unit, the smallest one among equals; 4 for windows) and n_units (units that match; if none does, windows)."""
    index = template_bigrams(docs.sparkSession, templates, threshold)
    fixed = index.collect()  # the fixed list
    low, high = min((r["low"] for r in fixed), default=0.0), max((r["high"] for r in fixed), default=-1.0)
    held = phrases(fixed, threshold)
    fit = units(docs, held).withColumn("d", F.expr("size(words) - 1"))
    fit = fit.where(F.expr(f"level = 4 or d between {low!r}D and {high!r}D")).where(holds(held))
    each = fit.select("doc_id", "text_hash", "level", "place", "d", F.posexplode(F.expr(_BIGRAMS)).alias("at", "bigram"))
    unit = ["doc_id", "text_hash", "level", "place", "d"]
    own = [*unit, "template", "license", "t"]
    shared = each.join(F.broadcast(index), (each["bigram"] == index["bigram"]) & ((F.col("level") == 4) | F.col("d").between(F.col("low"), F.col("high"))))
    hits = shared.groupBy(*own, "low").agg(F.array_sort(F.collect_set(F.struct("at", each["bigram"], "t_count"))).alias("h"))
    hits = hits.withColumn("low", F.expr("cast(ceil(low - 1e-4) as int)")).where("size(h) >= low")
    # a unit is compared whole; windows go from each hit on, over the hits within t places; as many as the lemma asks for
    near = hits.select(*own, F.inline(F.expr(
        "if(level < 4, array(struct(0 as begin, h as w)), "
        "transform(filter(sequence(1, size(h)), i -> try_element_at(h, i + low - 1).at - h[i - 1].at < t), "
        "i -> struct(h[i - 1].at as begin, slice(h, i, t) as w)))")))
    near = near.select(*own, "begin", F.inline("w")).where("level < 4 or at < begin + t")
    per = near.groupBy(*own, "begin", "bigram", "t_count").agg(F.count("*").alias("n"), F.max("at").alias("last"))
    per = per.groupBy(*own, "begin").agg(F.sum(F.least("n", "t_count")).alias("s"), F.max("last").alias("stop"))
    found = per.withColumn("dice", F.expr("round(2 * s / (if(level < 4, d, stop - begin + 1) + t), 6)")).where(F.col("dice") >= threshold)
    # all templates of a unit overlap from its first word on, so one of them stays
    best = found.groupBy(*unit).agg(F.array_sort(F.collect_list(F.expr(
        "struct(-dice as cost, if(level < 4, 0, -s) as s, template, begin, stop, license, dice)"))).alias("w"))
    picked = F.expr("aggregate(w, slice(w, 1, 0), (a, x) -> if(exists(a, y -> y.begin <= x.stop + 1 and x.begin <= y.stop + 1), a, concat(a, array(x))))")
    marked = best.select("doc_id", "level", F.inline(picked)).select("doc_id", "level", "license", "dice")
    best = marked.groupBy("doc_id", "license", (F.col("level") < 4).alias("unit"), "dice").agg(
        F.min("level").alias("level"), F.count("*").alias("n"))
    both = best.groupBy("doc_id", "license", "unit").agg(F.max("dice").alias("dice"), F.max_by("level", "dice").alias("level"), F.sum("n").alias("n_units"))
    return both.groupBy("doc_id", "license").agg(F.max(F.struct("unit", "dice", "level", "n_units")).alias("x")).select("doc_id", "license", "x.dice", "x.level", "x.n_units")


def scan_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The units' result in DuckDB SQL (see above)."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(a)}, {quote(b)})" for i, (a, b) in enumerate(templates))
    words = r"string_split(trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    return rf"""
WITH tw AS (SELECT template, license, {words.format('body')} AS words FROM (VALUES {values}) v(template, license, body)),
tb AS (SELECT template, license, len(words) - 1 AS t, unnest([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS bigram FROM tw WHERE len(words) > 1),
tc AS (SELECT template, license, t, bigram, count(*) AS t_count FROM tb GROUP BY ALL),
rows_ AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
cut AS (
  SELECT doc_id, text, 1 AS level, unnest(range(len(u))) AS place, unnest(u) AS unit
  FROM (SELECT doc_id, text, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)) AS u FROM rows_)
  UNION ALL SELECT doc_id, text, 2, unnest(range(len(u))), unnest(u) FROM (SELECT doc_id, text, regexp_split_to_array(text, '\n\s*\n') AS u FROM rows_)
  UNION ALL SELECT doc_id, text, 3, 0, text FROM rows_),
un AS (SELECT doc_id, hash(text) AS h, level, place, {words.format('unit')} AS words FROM cut),
ub AS (SELECT doc_id, h, level, place, len(words) - 1 AS d, unnest([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS bigram
  FROM un WHERE len(words) - 1 BETWEEN (SELECT min(t) * {threshold} / (2 - {threshold}) FROM tc) AND (SELECT max(t) * (2 - {threshold}) / {threshold} FROM tc)),
uc AS (SELECT doc_id, h, level, place, d, bigram, count(*) AS n FROM ub GROUP BY ALL),
sh AS (SELECT doc_id, h, level, place, template, license, d, t, sum(least(n, t_count)) AS s FROM uc JOIN tc USING (bigram) GROUP BY ALL),
fd AS (SELECT doc_id, h, level, place, license, max(round(2.0 * s / (d + t), 6)) AS dice FROM sh WHERE round(2.0 * s / (d + t), 6) >= {threshold} GROUP BY ALL)
SELECT doc_id, license, max(dice)::DOUBLE AS dice, min(level) FILTER (dice = top) AS level, count(*) AS n_units
FROM (SELECT *, max(dice) OVER (PARTITION BY doc_id, license) AS top FROM fd) GROUP BY doc_id, license"""
