"""License scans, in DataFrame functions alone.

Text is normalised to lower-case words of letters and digits, so comment marks go. Units are each line, the whole text, and for
each template blocks of lines: a block starts with a line that holds one of the template's first ``OPENING`` bigrams and
has the fewest lines (empty ones aside) that hold as many words as the template, or all lines to the end. So a licence that is
wrapped over lines inside a longer text is one unit. A unit is like a template when the Dice coefficient of their sets of word bigrams, 2 * shared / (unit's + template's), is ``LEAST_DICE`` or
more. That bounds the sizes: a unit whose number of bigrams is out of the template's bounds is never compared. It also means
that a match shares so many bigrams that some hold one of the ``anchor_words``, chosen so that this is certain for every
template; text without any of these words is not cut into bigrams.

Null text and text without two words match nothing. Ties go to the first template in the list. Equal rows are scanned each
on its own. A very long text is one row of a task; only lines that open a template are joined to blocks. The id may have any
name and no other column is carried, so none can clash. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_DICE = 0.75

#: Notices by which texts name their licence, and openings of licence texts, all in public use.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("reserved", "All rights reserved."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)
OPENING = 5


@dataclass(frozen=True)
class Template:
    place: int
    name: str
    bigrams: tuple[str, ...]
    n_words: int

    @property
    def opening(self) -> str:
        """A pattern of lines that start a block."""
        return opening_pattern(self.bigrams[:OPENING])

    def bounds(self, least: float) -> tuple[float, float]:
        """Numbers of bigrams of a unit that can reach ``least``."""
        n = len(self.bigrams)
        return n * least / (2 - least), n * (2 - least) / least

    def least_shared(self, least: float) -> int:
        return max(1, math.ceil(least * (math.ceil(self.bounds(least)[0]) + len(self.bigrams)) / 2 - 1e-9))


def opening_pattern(pairs: Sequence[str]) -> str:
    return rf"(?:^| )(?:{'|'.join(pairs)})(?: |$)"


def templates(texts: Sequence[tuple[str, str]] = TEMPLATES) -> list[Template]:
    made = []
    for place, (name, text) in enumerate(texts):
        words = re.findall(r"[^\W_]+", text.lower())
        made.append(Template(place, name, tuple(dict.fromkeys(map(" ".join, zip(words, words[1:], strict=False)))), len(words)))
    return made


def anchor_words(tests: Sequence[Template], least: float) -> list[str]:
    """Few long words, such that too few bigrams of any template are without one of them for a match."""
    anchors: set[str] = set()
    open_bigrams = {t: set(t.bigrams) for t in tests}
    while waiting := [t for t in tests if len(open_bigrams[t]) >= t.least_shared(least)]:
        words = sorted({w for t in waiting for b in open_bigrams[t] for w in b.split()})
        best = max(words, key=lambda w: len(w) * sum(w in b.split() for t in waiting for b in open_bigrams[t]))
        anchors.add(best)
        open_bigrams = {t: {b for b in left if best not in b.split()} for t, left in open_bigrams.items()}
    return sorted(anchors)


def normal(text: Column) -> Column:
    """Words joined by single spaces; lines stay lines."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def bigrams(unit: Column) -> Column:
    """Distinct word bigrams of normalised text."""
    words = F.array_remove(F.split(unit, r"[ \n]+"), "")
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def _best(found: Column, tests: Sequence[Template], least: float) -> Column:
    """The best template for a unit's bigrams: (dice, -place, name), or null."""
    n = F.size(found)
    scored = []
    for t in tests:
        low, high = t.bounds(least)
        dice = F.round(2.0 * F.size(F.array_intersect(found, F.array(*map(F.lit, t.bigrams)))) / (n + len(t.bigrams)), 6)
        scored.append(F.when((n >= low) & (n <= high), F.when(dice >= least, F.struct(dice.alias("dice"), F.lit(-t.place).alias("order"), F.lit(t.name).alias("name")))))
    return F.array_max(F.array(*scored))


def _block(lines: Column, start: Column, n_words: int) -> Column:
    """The fewest lines from ``start`` on that hold so many words, as one text."""
    empty = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"))

    def more(held: Column, line: Column) -> Column:
        longer = F.struct(F.concat(held["text"], F.lit(" "), line).alias("text"), (held["n"] + F.size(F.split(F.trim(line), " "))).alias("n"))
        return F.when(held["n"] >= n_words, held).otherwise(longer)

    return F.aggregate(F.slice(lines, start, n_words), empty, more)["text"]


def _blocks(lines: Column, starts: Column, test: Template, least: float) -> Column:
    """The matches of a template among its blocks."""
    own = F.filter(starts, lambda i: F.element_at(lines, i).rlike(test.opening))
    units = F.transform(own, lambda i: bigrams(_block(lines, i, test.n_words)))
    return F.filter(F.transform(units, lambda b: _best(b, [test], least)), lambda m: m.isNotNull())


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text: str = "text", texts: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """Per document ``whole_license`` of the whole text, ``n_license_lines``, the best line's ``license`` and ``dice``, and the
    best block's ``block_license`` and ``block_dice``."""
    tests = templates(texts)
    anchored = rf"(?:^|[ \n])(?:{'|'.join(anchor_words(tests, least))})(?:[ \n]|$)"
    rows = docs.select(F.col(id_column), normal(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    near = rows.withColumn("near", F.col("t").rlike(anchored))
    all_lines = F.filter(F.split("t", "\n"), lambda x: F.trim(x) != "")
    lines = F.transform(F.filter(F.split("t", "\n"), lambda x: x.rlike(anchored)), bigrams)
    none = F.array().cast("array<array<string>>")
    cut = near.select(
        id_column,
        F.when(F.col("near"), lines).otherwise(none).alias("lines"),
        F.when(F.col("near"), bigrams(F.col("t"))).alias("whole"),
        F.when(F.col("near"), all_lines).otherwise(F.array().cast("array<string>")).alias("all_lines"),
    )
    any_opening = opening_pattern(sorted({b for t in tests for b in t.bigrams[:OPENING]}))
    places = F.when(F.size("all_lines") > 0, F.sequence(F.lit(1), F.size("all_lines"))).otherwise(F.array().cast("array<int>"))
    opened = cut.withColumn("starts", F.filter(places, lambda i: F.element_at("all_lines", i).rlike(any_opening)))
    found = F.flatten(F.array(*[_blocks(F.col("all_lines"), F.col("starts"), t, least) for t in tests]))
    matched = opened.select(
        id_column,
        F.filter(F.transform("lines", lambda b: _best(b, tests, least)), lambda m: m.isNotNull()).alias("matches"),
        F.when(F.col("whole").isNotNull(), _best(F.col("whole"), tests, least)).alias("w"),
        F.when(F.size("starts") > 0, F.array_max(found)).alias("block"),
    )
    best = F.array_max("matches")
    return matched.select(
        id_column,
        F.col("w.name").alias("whole_license"),
        F.size("matches").cast("long").alias("n_license_lines"),
        best["name"].alias("license"),
        best["dice"].alias("dice"),
        F.col("block.name").alias("block_license"),
        F.col("block.dice").alias("block_dice"),
    )
