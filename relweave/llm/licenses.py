"""License recognition by sentence rules, in Spark expressions.

Texts are cut into sentences, sentences are normalised to lower-case letters and digits,
and known ones are mapped to an identifier. The sequence of identifiers is matched against
ordered rules, longer statements before the sentences they are made of; a rule takes its
identifiers out of the sequence. What no rule takes is reported as left over.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# Known sentences: identifier and wording.
SENTENCES = {
    "MitShort": "Released under the MIT License.",
    "MitLicensed": "Licensed under the MIT License.",
    "MitTitle": "The MIT License (MIT)",
    "MitGrant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,'
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions:"
    ),
    "MitNotice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MitAsIs": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "BsdUse": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    ),
    "BsdSource": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BsdBinary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution."
    ),
    "BsdEndorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission."
    ),
    "ApacheShort": "Licensed under the Apache License, Version 2.0.",
    "ApacheHead": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    ),
    "ApacheCopy": "You may obtain a copy of the License at",
    "GplShort3": "This work is licensed under the GNU General Public License, version 3.",
    "GplShort2": "This work is licensed under the GNU General Public License, version 2.",
    "GplHead3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published"
        " by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GplHead2": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published"
        " by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "GplWarranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "CcByNc": "Licensed under CC BY-NC 4.0.",
    "CcBy": "Licensed under CC BY 4.0.",
    "CcBySa": "Licensed under CC BY-SA 4.0.",
    "CcZero": "Licensed under CC0 1.0.",
}
# Ordered rules: licence and the identifiers that state it, one after another.
RULES = [
    ("MIT", ["MitTitle", "MitGrant", "MitNotice", "MitAsIs"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs"]),
    ("BSD-3-Clause", ["BsdUse", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdUse", "BsdSource", "BsdBinary"]),
    ("Apache-2.0", ["ApacheHead", "ApacheCopy"]),
    ("GPL-3.0-or-later", ["GplHead3", "GplWarranty"]),
    ("GPL-2.0-or-later", ["GplHead2", "GplWarranty"]),
    ("GPL-3.0-or-later", ["GplHead3"]),
    ("GPL-2.0-or-later", ["GplHead2"]),
    ("Apache-2.0", ["ApacheHead"]),
    ("Apache-2.0", ["ApacheShort"]),
    ("MIT", ["MitShort"]),
    ("MIT", ["MitLicensed"]),
    ("MIT", ["MitTitle"]),
    ("GPL-3.0", ["GplShort3"]),
    ("GPL-2.0", ["GplShort2"]),
    ("CC-BY-NC-4.0", ["CcByNc"]),
    ("CC-BY-4.0", ["CcBy"]),
    ("CC-BY-SA-4.0", ["CcBySa"]),
    ("CC0-1.0", ["CcZero"]),
]
# Every known sentence holds one of these.
WORDS = ("licen", "permission", "redistribut", "warranty", "cc0")
# End of the fixed values.

ENDS = r"[.!?:;]+(?:[\x20\x09-\x0D]+|$)"
NEW_LINE = r"\n"


def plain(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known() -> dict[str, str]:
    """Identifier of every piece of wording; a sentence with a stop inside is known by its pieces."""
    out = {}
    for name, wording in SENTENCES.items():
        pieces = [p for p in (plain(x) for x in re.split(ENDS, wording)) if p]
        for i, piece in enumerate(pieces):
            out.setdefault(piece, name if i == 0 else f"{name}{i}")
    return out


def rules(identifiers: dict[str, str]) -> list[tuple[str, str]]:
    """(licence, sequence) with every sentence spelt as its pieces."""

    def spelt(name: str) -> str:
        return "".join(f"<{identifiers[p]}>" for p in (plain(x) for x in re.split(ENDS, SENTENCES[name])) if p)

    return [(licence, "".join(map(spelt, names))) for licence, names in RULES]


def sequence(text: Column, separator: str, identifiers: dict[str, str]) -> Column:
    """Identifiers of the known sentences of a lower-cased text, in order, as <a><b>."""
    table = F.create_map(*[F.lit(x) for pair in identifiers.items() for x in pair])
    sentences = F.transform(F.split(text, separator), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    ids = F.filter(F.transform(sentences, lambda s: F.element_at(table, s)), lambda x: x.isNotNull())
    return F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, sentences, licenses, left_over) of every row.

    `sentences` is the sequence of identifiers, `licenses` the licences found, each once,
    in rule order and joined by commas, `left_over` how many known sentences no rule took.
    A sentence ends at a stop or colon before a blank, or at a line's end; for wordings
    that run over lines the text is also read with line ends as blanks, and the reading
    that knows more sentences counts (that by lines if equal). Null and empty texts have
    none; every row is judged by itself.
    """
    identifiers = known()
    low = F.lower(text_or_empty())
    any_word = F.lit(False)
    for w in WORDS:
        any_word = any_word | F.contains(low, F.lit(w))
    held = docs.select("doc_id", F.when(any_word, low).alias("low"))
    lines = sequence(F.col("low"), f"{ENDS}|{NEW_LINE}", identifiers)
    whole = sequence(F.col("low"), ENDS, identifiers)
    both = held.select("doc_id", F.coalesce(lines, F.lit("")).alias("lines"), F.coalesce(whole, F.lit("")).alias("whole"))
    count = lambda c: F.length(c) - F.length(F.replace(F.col(c) if isinstance(c, str) else c, F.lit("<"), F.lit("")))
    seq = both.select("doc_id", F.when(count("whole") > count("lines"), F.col("whole")).otherwise(F.col("lines")).alias("sentences"))
    ordered = F.array(*[F.struct(F.lit(a).alias("licence"), F.lit(b).alias("ids")) for a, b in rules(identifiers)])
    state = "struct<rest:string,found:array<string>>"
    zero = F.struct(F.col("sentences").alias("rest"), F.array().cast("array<string>").alias("found")).cast(state)

    def step(s: Column, rule: Column) -> Column:
        hit = F.contains(s["rest"], rule["ids"])
        found = F.when(hit, F.array_union(s["found"], F.array(rule["licence"]))).otherwise(s["found"])
        return F.struct(F.replace(s["rest"], rule["ids"], F.lit("|")).alias("rest"), found.alias("found")).cast(state)

    done = seq.select("doc_id", "sentences", F.aggregate(ordered, zero, step).alias("s"))
    return done.select("doc_id", "sentences", F.array_join("s.found", ",").alias("licenses"), count(F.col("s.rest")).cast("long").alias("left_over"))


def oracle() -> str:
    """The same in the SQL of DuckDB."""
    identifiers = known()
    q = lambda x: "'" + x.replace("'", "''") + "'"
    table = f"map([{', '.join(map(q, identifiers))}], [{', '.join(map(q, identifiers.values()))}])"
    words = " OR ".join(f"contains(low, {q(w)})" for w in WORDS)

    def ids(separator: str) -> str:
        plain_sql = "trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))"
        found = f"list_filter(list_transform(string_split_regex(low, {q(separator)}), lambda s: ids[{plain_sql}]), lambda x: x IS NOT NULL)"
        return f"coalesce(array_to_string(list_transform({found}, lambda x: '<' || x || '>'), ''), '')"

    steps, last = [], "m"
    for i, (_licence, ids_text) in enumerate(rules(identifiers)):
        steps.append(f"r{i} AS (SELECT *, contains(rest{i}, {q(ids_text)}) AS f{i}, replace(rest{i}, {q(ids_text)}, '|') AS rest{i + 1} FROM {last})")
        last = f"r{i}"
    each = ", ".join(f"CASE WHEN f{i} THEN {q(a)} END" for i, (a, _) in enumerate(RULES))
    n = len(RULES)
    return f"""
WITH t AS (SELECT doc_id, lower(coalesce(text, '')) AS low, {table} AS ids FROM documents),
k AS (SELECT doc_id, ids, CASE WHEN {words} THEN low END AS low FROM t),
s AS (SELECT doc_id, {ids(f"{ENDS}|{NEW_LINE}")} AS by_line, {ids(ENDS)} AS whole FROM k),
m AS (SELECT doc_id, CASE WHEN length(whole) - length(replace(whole, '<', '')) > length(by_line) - length(replace(by_line, '<', ''))
      THEN whole ELSE by_line END AS sentences, sentences AS rest0 FROM s),
{', '.join(steps)},
l AS (SELECT doc_id, sentences, rest{n} AS rest, list_filter([{each}], lambda x: x IS NOT NULL) AS found FROM {last})
SELECT doc_id, sentences,
  array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ',') AS licenses,
  CAST(length(rest) - length(replace(rest, '<', '')) AS BIGINT) AS left_over
FROM l"""
