"""License scan: positional rare-token index over licence notices, in DataFrame functions only.

1. One pass counts in how many documents each licence word occurs (idf over
   the whole corpus; at most one row per licence word reaches the driver).
2. The postings of a word are its (notice, place) pairs in all notices.  A file
   looks up its highest-idf licence words: a notice can only stand in a file that
   holds the rarest word of its key phrase, so the file goes down its words, by
   falling idf, to the second rarest key word of every notice whose rarest it holds.
3. A place of a looked-up word minus its place in a notice is a vote for (notice,
   start).  Votes are sorted; a start with two of them is a candidate.
4. A candidate counts when the notice's key phrase stands there word for word and
   the idf-weighted share of its words in place reaches ``SHARE``.

No match is lost: the two rarest key words of a notice that stands in a file are
both looked up and vote for its start.  Work follows the votes, not the number of
notices.  A document is judged inside its own row: no shuffle beyond the idf count,
so neither hot sources nor copies matter.

Cases: a null, empty or wordless text has no words and no labels; repeated rows
are judged each; places count again when a phrase repeats or overlaps; words of
equal idf are looked up together; a notice whose start the text cuts off does not
count; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import table

#: Idf-weighted share of a notice's words that must stand in place.
SHARE = 0.7


@dataclass(frozen=True)
class Notice:
    """``key``: a phrase of at least two words of ``text`` that must stand."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(BETWEEN, self.text.lower()) if w]

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, once A-Z are lower.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Phrases of the contract, then short forms and paragraphs of public licence notices with a phrase that
#: must be there.
BASE = (
    Notice("cc-by", "cc by", "cc by", True),
    Notice("gpl", "general public license", "general public license", True),
    Notice("reserved", "all rights reserved", "all rights reserved", True),
)
NOTICES = (
    Notice("agpl-3.0", "gnu affero general public license version 3", "affero general public license"),
    Notice("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
           "redistribution and use"),
    Notice("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Notice("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    Notice("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    Notice("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution"),
    Notice("cc0", "cc0 1 0 universal public domain dedication", "public domain dedication"),
    Notice("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    Notice("gpl-3.0", "this work is licensed under the gnu general public license version 3",
           "general public license version 3"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy"),
    Notice("lgpl", "gnu lesser general public license", "lesser general public license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
           "permission is hereby granted"),
    Notice("mit", "released under the mit license", "mit license"),
    Notice("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain",
           "free and unencumbered software"),
    Notice("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
           "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
           "option) any later version.", "affero general public license"),
    Notice("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
           "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
           "may not use this file except in compliance"),
    Notice("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
           "list of conditions and the following disclaimer.", "redistributions of source code must retain"),
    Notice("boost-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
           "software and accompanying documentation covered by this license (the Software) to use, reproduce, display, "
           "distribute, execute, and transmit the Software", "accompanying documentation covered by this license"),
    Notice("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
           "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
           "option) any later version.", "either version 2 of the license"),
    Notice("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
           "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
           "option) any later version.", "gnu general public license as published"),
    Notice("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
           "with or without fee is hereby granted"),
    Notice("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
           "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
           "deal in the software without restriction"),
    Notice("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
           "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "source code form is subject"),
    Notice("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
           "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
           "either in source code form or as a compiled binary"),
    Notice("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
           "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
           "software for any purpose, including commercial applications, and to alter it and redistribute it freely",
           "held liable for any damages arising from the use"),
)
ALL = BASE + NOTICES


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, BETWEEN), lambda w: w != "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rarity(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """idf of every licence word over the whole ``words`` table (column ``words``)."""
    hit = words.select(F.explode_outer(F.array_append(F.array_intersect("words", _strings(vocabulary)), F.lit(""))).alias("w"))
    # One row per licence word, and one (the empty word) for the number of documents.
    found = {r[0]: r[1] for r in hit.groupBy("w").agg(F.count(F.lit(1))).collect()}
    n = found.get("", 0)
    return {w: math.log((n + 1) / (found.get(w, 0) + 1)) + 1 for w in vocabulary}


def reach(idf: dict[str, float], notices: tuple[Notice, ...] = ALL) -> dict[str, float]:
    """Rarest key word of a notice -> how far down in idf a file that holds it looks up its words."""
    out: dict[str, float] = {}
    for n in notices:
        rarest, second = sorted(n.key.split(), key=lambda w: (-idf[w], w))[:2]
        out[rarest] = min(out.get(rarest, math.inf), idf[second])
    return out


def postings(notices: tuple[Notice, ...] = ALL) -> dict[str, list[tuple[int, int]]]:
    """Word -> every (notice, place) where it stands in a notice."""
    out: dict[str, list[tuple[int, int]]] = {}
    for k, n in enumerate(notices):
        for i, w in enumerate(n.words):
            out.setdefault(w, []).append((k, i))
    return out


def _map(of: dict, value) -> Column:
    return F.create_map(*[F.lit(x) if isinstance(x, str) else value(x) for pair in of.items() for x in pair])


def _looked_up(idf: dict[str, float], notices: tuple[Notice, ...]) -> Column:
    """The file's highest-idf licence words; null if it holds no notice's rarest key word."""
    floors = reach(idf, notices)
    rarest = F.array_intersect("words", _strings(sorted(floors)))
    floor = F.array_min(F.transform(rarest, lambda w: F.element_at(_map(floors, F.lit), w)))
    held = F.array_intersect("words", _strings(sorted(idf)))
    found = F.filter(held, lambda w: F.element_at(_map(idf, F.lit), w) >= floor)
    return F.when(F.arrays_overlap("words", _strings(sorted(floors))), found)


def _votes(notices: tuple[Notice, ...]) -> Column:
    """Sorted (notice, start) votes of the looked-up words' places."""
    index = _map(postings(notices), lambda ps: F.array(*[
        F.struct(F.lit(k).alias("notice"), F.lit(i).alias("place")) for k, i in ps]))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda p: F.array_contains("looked_up", F.get("words", p)))
    votes = F.flatten(F.transform(at, lambda p: F.transform(F.element_at(index, F.get("words", p)), lambda x: F.struct(
        x["notice"].alias("notice"), (p - x["place"]).alias("start")))))
    none = F.array().cast("array<struct<notice:int,start:int>>")
    return F.when(F.col("looked_up").isNotNull(), F.array_sort(F.filter(votes, lambda v: v["start"] >= 0))).otherwise(none)


def _judged(idf: dict[str, float], notices: tuple[Notice, ...]) -> Column:
    """array of (notice, label, start, words, share, base) of candidates that count."""
    def per_notice(value) -> Column:
        return F.array(*[value(n) for n in notices])

    def shares(n: Notice) -> Column:
        total = sum(idf[w] for w in n.words)
        return F.array(*[F.lit(idf[w] / total) for w in n.words])

    texts, weights = per_notice(lambda n: _strings(n.words)), per_notice(shares)
    keys, key_at = per_notice(lambda n: _strings(n.key.split())), per_notice(lambda n: F.lit(n.key_at))

    def part(start: Column, width: Column) -> Column:
        return F.slice("words", start + 1, width)

    def key_stands(c: Column) -> Column:
        key = F.get(keys, c["notice"])
        return part(c["start"] + F.get(key_at, c["notice"]), F.size(key)) == key

    def judged(c: Column) -> Column:
        of = F.get(texts, c["notice"])
        # A text that ends before the notice gives nulls, which match nothing.
        there = F.zip_with(of, part(c["start"], F.size(of)), lambda a, b: F.coalesce(a == b, F.lit(False)))
        held = F.zip_with(F.get(weights, c["notice"]), there, lambda w, ok: F.when(ok, w).otherwise(F.lit(0.0)))
        share = F.aggregate(held, F.lit(0.0), lambda total, w: total + w)
        base = F.get(per_notice(lambda n: F.lit(n.base)), c["notice"])
        return F.struct(
            F.get(per_notice(lambda n: F.lit(n.label)), c["notice"]).alias("label"), c["start"].alias("start"),
            F.size(of).alias("words"), F.when(base, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0))).alias("share"),
            base.alias("base"))

    return F.filter(F.transform(F.filter("candidates", key_stands), judged), lambda x: x["share"] >= SHARE)


def scanned(docs: DataFrame, notices: tuple[Notice, ...] = ALL) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and ``found``:
    an array of (label, first word from 0, words, share, base) with every place that counts."""
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    idf = rarity(words, sorted({w for n in notices for w in n.words}))
    placed = words.select("doc_id", "words", _looked_up(idf, notices).alias("looked_up"))
    placed = placed.select("doc_id", "words", _votes(notices).alias("votes"))
    # Sorted votes: a start that two words agree on follows itself.
    again = F.filter("votes", lambda v, i: F.coalesce(F.get("votes", i - 1) == v, F.lit(False)))
    placed = placed.select("doc_id", "words", F.array_distinct(again).alias("candidates"))
    found = placed.select("doc_id", F.size("words").cast("long").alias("n_words"), _judged(idf, notices).alias("found"))
    base = F.filter("found", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["start"])
    joined = lambda of: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(of, lambda x: x["label"]))))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"), "found")


def op6_licenses(spark, sf_dir) -> DataFrame:
    """Licence phrases and notices in all ``documents``."""
    return scanned(table(spark, sf_dir, "documents")).drop("found")
