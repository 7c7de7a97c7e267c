"""License scans: Dice coefficient of word bigrams between parts of a text and licence templates."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import col

#: Short notices and standard headers of common licences (publicly known wording).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def normalised_words(text: Column) -> Column:
    """Words of a text: lower case, everything but ASCII letters and digits separates."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Distinct neighbouring words; of a single word, the word itself; none of no words."""
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(F.when(F.size(words) == 1, words).otherwise(pairs))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Least and greatest number of bigrams that can reach ``threshold`` against ``size`` of them:
    the Dice coefficient is at most twice the smaller number over the sum of both."""
    return max(1, ceil(threshold * size / (2 - threshold) - 1e-9)), floor((2 - threshold) * size / threshold + 1e-9)


def template_table(templates: Sequence[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """(licence, bigrams) of templates, with the same rules as ``normalised_words`` and ``bigrams``."""
    out = []
    for name, text in templates:
        words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])] or words
        out.append((name, sorted(set(pairs))))
    return out


def anchors(table: Sequence[tuple[str, list[str]]], threshold: float) -> str:
    """A pattern that occurs in the lower-case form of every part that can match a template.

    A part at ``threshold`` shares at least threshold / (2 - threshold) of the template's bigrams. So many of them may be missing,
    and one more may not: the longest ones, as the rarest, are taken.
    """
    found = set()
    for _, pairs in table:
        needed = ceil(threshold * len(pairs) / (2 - threshold) - 1e-9)
        found.update(sorted(pairs, key=lambda p: (-len(p), p))[: len(pairs) - needed + 1])
    by_first: dict[str, set[str]] = {}
    for pair in found:
        first, _, second = pair.partition(" ")
        by_first.setdefault(first, set()).add(second)
    options = []
    for first, seconds in sorted(by_first.items()):
        ends = "|".join(sorted(s for s in seconds if s))
        options.append(first if "" in seconds else f"{first}[^a-z0-9]+(?:{ends})")
    return f"(?<![a-z0-9])(?:{'|'.join(options)})(?![a-z0-9])"


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """One row per row of ``docs``: id, n_matches, licenses, best_license, best_dice, matches.

    The parts of a text are its lines, the sentences of lines that have several, its paragraphs (between blank lines, or comment
    lines without a word) of several lines, and the whole text if it has several paragraphs. Sentences count on through the text. A part matches a template if the Dice coefficient of
    their sets of word bigrams is ``threshold`` or more; of several templates the best counts, of equals the
    first licence by name. ``matches`` lists kind, number (from 0), licence and coefficient of each
    matching part; ``licenses`` the distinct names, sorted; ``best_*`` are null without a match.
    Null and empty texts and those without a word match nothing. Repeated rows stay. Other columns are not read.

    Texts without any of the templates' ``anchors`` cannot match and are not cut into parts. Parts outside every template's size
    bounds are never compared. Templates are a fixed list in the plan. Everything is a row-wise expression: no shuffle.
    """
    table = [(n, b, *size_bounds(len(b), threshold)) for n, b in template_table(templates) if b]
    least, most = min(t[2] for t in table), max(t[3] for t in table)
    text = F.coalesce(col(text_col), F.lit(""))
    paragraphs = F.split(text, r"\n[ \t\r*#/;-]*\n")
    lines = F.split(text, "\n")
    sentences = F.flatten(F.filter(F.transform(lines, lambda t: F.split(t, r"(?<=[.!?;:])[ \t]+")), lambda s: F.size(s) > 1))

    def parts(kind: str, texts: Column) -> Column:
        return F.transform(texts, lambda t, i: F.struct(F.lit(kind).alias("kind"), i.alias("number"), t.alias("text")))

    every = F.concat(
        parts("line", lines),
        parts("sentence", sentences),
        F.filter(parts("paragraph", paragraphs), lambda p: F.instr(p["text"], "\n") > 0),
        F.filter(parts("text", F.array(text)), lambda _: F.size(paragraphs) > 1),
    )
    may = F.rlike(F.lower(text), F.lit(anchors([t[:2] for t in table], threshold)))
    every = F.when(may, every).otherwise(F.array().cast("array<struct<kind:string,number:int,text:string>>"))
    # characters bound the words, before any part is cut into words: w words need 2w - 1 characters
    sized = F.filter(every, lambda p: F.length(p["text"]) >= least)
    # one step a transform: what a lambda names twice is worked out twice
    worded = F.transform(sized, lambda p: F.struct(p["kind"], p["number"], normalised_words(p["text"]).alias("words")))
    worded = F.filter(worded, lambda p: F.size(p["words"]) >= least)
    paired = F.transform(worded, lambda p: F.struct(p["kind"], p["number"], bigrams(p["words"]).alias("bigrams")))
    paired = F.filter(paired, lambda p: F.size(p["bigrams"]).between(least, most))

    def compared(p: Column) -> Column:
        options = []
        for name, pairs, low, high in table:
            size = F.size(p["bigrams"])
            common = F.size(F.array_intersect(p["bigrams"], F.array(*map(F.lit, pairs))))
            dice = F.when(size.between(low, high), F.lit(2.0) * common / (size + len(pairs))).otherwise(F.lit(0.0))
            options.append(F.struct((-dice).alias("rank"), F.lit(name).alias("license"), dice.alias("dice")))
        best = F.array_min(F.array(*options))
        return F.struct(p["kind"].alias("kind"), p["number"].alias("number"), best["license"].alias("license"), best["dice"].alias("dice"))

    matches = F.filter(F.transform(paired, compared), lambda m: m["dice"] >= threshold)
    best = F.array_min(F.transform("matches", lambda m: F.struct((-m["dice"]).alias("rank"), m["license"].alias("license"), m["dice"].alias("dice"))))
    rows = docs.select(col(id_col).alias("id"), matches.alias("matches"))
    return rows.select(
        F.col("id").alias(id_col),
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        best["license"].alias("best_license"),
        best["dice"].alias("best_dice"),
        "matches",
    )
