"""Licence scans: normalised text compared to templates by the Dice coefficient over word bigrams.

Every line of a text and the text as a whole are compared. For a template that the whole text does not fit,
so are the windows of consecutive words, across lines, that touch no line fitting it: notices wrapped over lines
or inside a paragraph. A piece of n bigrams can only reach the
threshold t for a template of m bigrams if t / (2 - t) <= n / m <= (2 - t) / t, so that most
pieces are pruned by their length before any bigram is made. A window can only reach it if the text shares
t / (2 - t) of the template's bigrams, which is counted first; texts without two words of the templates never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlake.llm.common import replace, text_of

THRESHOLD = 0.8

#: Short licence notices by name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

#: Full licence texts and headers, usually wrapped over many lines.
FULL_TEXTS = [
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-clauses", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
]


def words_of(column: Column) -> Column:
    """Lower-case letters and digits with single blanks between the words."""
    return F.trim(F.regexp_replace(F.lower(column), "[^a-z0-9]+", " "))


def plain_bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, normalised like the texts."""
    words = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bigrams(words: Column) -> Column:
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.concat_ws(" ", F.element_at(words, i.cast("int")), F.element_at(words, (i + 1).cast("int"))),
    )
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def windows(lines: Sequence[str], grams: frozenset[str], threshold: float) -> list[float]:
    """Dice of the windows of consecutive words that fit a template, best first, none over another.

    ``lines`` are normalised. The best windows begin and end with a bigram of the template. Lines that fit by themselves
    are left out, and no window reaches over them.
    """
    low, high = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
    runs: list[list[str]] = [[]]
    for line in lines:
        words = line.split(" ")
        own = {f"{a} {b}" for a, b in zip(words, words[1:])}
        if round(2 * len(own & grams) / (len(own) + len(grams)), 9) >= threshold:
            runs.append([])
        else:
            runs[-1] += words
    out = []
    for run in runs:
        pairs = [f"{a} {b}" for a, b in zip(run, run[1:])]
        hits = [i for i, p in enumerate(pairs) if p in grams]
        fitting = []
        for n, begin in enumerate(hits):
            seen: set[str] = set()
            shared: set[str] = set()
            at, best = begin, None
            for end in hits[n:]:
                # Repeated bigrams lengthen a window without adding to its size; twice the bound leaves room for them.
                if end - begin >= 2 * high * len(grams):
                    break
                seen.update(pairs[at : end + 1])
                at = end + 1
                shared.add(pairs[end])
                if len(seen) > high * len(grams):
                    break
                dice = round(2 * len(shared) / (len(seen) + len(grams)), 9)
                if dice >= threshold and len(seen) >= low * len(grams) and (best is None or dice > -best[0]):
                    best = (-dice, begin, end)
            if best:
                fitting.append(best)
        taken: list[tuple[int, int]] = []
        # A word belongs to one window: bigrams next to each other share one.
        for dice, begin, end in sorted(fitting):
            if all(end + 1 < a or begin > b + 1 for a, b in taken):
                taken.append((begin, end))
                out.append(-dice)
    return sorted(out, reverse=True)


def _search_windows(grams: list[tuple[str, list[str]]], threshold: float):
    """Dices of the windows per template, in the order of ``grams``; null where the text has none."""
    sets = [frozenset(g) for _, g in grams]
    union = frozenset().union(*sets)
    low = threshold / (2 - threshold) - 1e-9

    def one(lines: list[str] | None) -> list[list[float]] | None:
        words = " ".join(lines or []).split(" ")
        own = {f"{a} {b}" for a, b in zip(words, words[1:])}
        shared = own & union
        out: list[list[float]] = [[] for _ in sets]
        for i, s in enumerate(sets):
            n = len(shared & s) if shared else 0
            if n >= low * len(s) and round(2 * n / (len(own) + len(s)), 9) < threshold:
                out[i] = windows(lines, s, threshold)
        return out if any(out) else None

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lines in batches:
            yield pa.array([one(x.as_py()) for x in lines], pa.list_(pa.list_(pa.float64())))

    return run


def scan(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = (*TEMPLATES, *FULL_TEXTS), threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``licenses``: (name, dice, n_pieces) per template found, by name.

    Pieces are lines, the whole text, and windows where neither fits. ``dice`` is the best of the document's pieces, rounded to 9 digits. Null, empty and unlicensed
    texts have an empty list; a column of that name is replaced; repeated rows get equal lists. Templates are
    a parameter of a few hundred entries that travels with the plan; those of fewer than two words fit nothing.
    """
    docs = replace(docs, ["licenses"])
    grams = [(name, plain_bigrams(text)) for name, text in sorted(templates)]
    grams = [(name, g) for name, g in grams if g]
    shape = "array<struct<name:string,dice:double,n_pieces:int>>"
    if not grams:
        return docs.withColumn("licenses", F.array().cast(shape))
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least = min(len(g) for _, g in grams) * low
    most = max(len(g) for _, g in grams) * high
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, g)).alias("grams")) for n, g in grams])
    known = F.array(*map(F.lit, sorted({w for _, g in grams for b in g for w in b.split(" ")})))
    lines = F.filter(F.transform(F.split(text_of(text_col), "\n"), words_of), lambda x: x != "")
    whole = F.array_join("__llm_lines", " ")
    pieces = F.when(F.size("__llm_lines") > 1, F.concat("__llm_lines", F.array(whole))).otherwise(F.col("__llm_lines"))

    def fits(words: Column) -> Column:
        # n words have less than n distinct bigrams, d distinct words at least d - 1; one word must be shared.
        distinct = F.size(F.array_distinct(words))
        return (F.size(words) > least) & (distinct - 1 <= most) & (F.size(F.array_intersect(words, known)) > 0)

    split = F.transform(pieces, lambda x: F.split(x, " "))
    candidates = F.transform(F.filter("__llm_words", fits), bigrams)

    def dice(piece: Column, template: Column) -> Column:
        sizes = F.size(piece) + F.size(template["grams"])
        ratio = F.size(piece) / F.size(template["grams"])
        shared = 2 * F.size(F.array_intersect(piece, template["grams"])) / sizes
        return F.when(ratio.between(low - 1e-9, high + 1e-9), F.round(shared, 9)).otherwise(F.lit(0.0))

    def found(template: Column, i: Column) -> Column:
        reached = F.filter(F.transform("__llm_pieces", lambda p: dice(p, template)), lambda d: d >= threshold)
        inside = F.coalesce(F.element_at("__llm_windows", i + 1), F.array().cast("array<double>"))
        both = F.concat(reached, inside)
        return F.struct(
            template["name"].alias("name"), F.array_max(both).alias("dice"), F.size(both).cast("int").alias("n_pieces")
        )

    rows = docs.withColumn("__llm_lines", lines).withColumn("__llm_words", split)
    rows = rows.withColumn("__llm_pieces", candidates)
    # Two words of the templates at least must be there; the search counts the bigrams themselves.
    some = F.size(F.array_intersect(F.split(whole, " "), known)) > 1
    search = F.arrow_udf(_search_windows(grams, threshold), "array<array<double>>", F.ArrowUDFType.SCALAR_ITER)
    rows = rows.withColumn("__llm_windows", search(F.when(some, F.col("__llm_lines"))))
    listed = F.filter(F.transform(table, found), lambda x: x["n_pieces"] > 0).cast(shape)
    return rows.withColumn("licenses", listed).drop("__llm_lines", "__llm_words", "__llm_pieces", "__llm_windows")
