"""License scans: MinHash bands of overlapping text windows retrieve templates, containment verifies.

A text is cut into windows of ``WINDOW`` words that start every ``STEP`` words, a template into windows of the same size that
start at every word (a shorter template is one window). A window's set is its two-word shingles. Inside a
longer template a window of the text meets a window of the template word by word; a template of at most
``WINDOW`` words shares at least half of its shingles with one of the two windows around it. With 8 bands of one
value each a similarity of 0.5 is found with probability 0.996, 0.6 with 0.9993, an equal window
always. Found templates are verified by the share of their shingles that the words around the window hold.
All is done by Spark's own expressions; the MinHash values of a window are a few minima of exclusive-ors,
few enough that the generated code stays small and is compiled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areacast.sources.tables import written

WINDOW, STEP, BANDS = 8, 4, 8
# Up to so many distinct band values, windows are compared with the list of them before the join.
LISTED = 20_000
# The notices that name a public license, and passages of the license texts themselves.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "You may convey verbatim copies of the Program's source code as you receive it, in any medium, provided that you "
        "conspicuously and appropriately publish on each copy an appropriate copyright notice",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License",
        "You may copy and distribute verbatim copies of the Program's source code as you receive it, in any medium, provided "
        "that you conspicuously and appropriately publish on each copy an appropriate copyright notice and disclaimer of warranty",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU "
        "General Public License, supplemented by the additional permissions listed below.",
    ),
    "AGPL-3.0": (
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically "
        "designed to ensure cooperation with the community in the case of network server software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide. This software is distributed without any warranty.",
        "CC0 1.0 Universal Public Domain Dedication",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED.",
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
        "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software",
    ),
}
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _once(value: Column, name: str) -> Column:
    """A column that is computed once per row, however often it is used: the planner copies plain ones."""
    return F.explode(F.array(value)).alias(name)


def _with_shingles(texts: DataFrame, text: Column, *columns: Column) -> DataFrame:
    """The columns and ``shingles``: hashes of each two neighbouring words in lower case, in their order."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))
    rows = texts.select(*columns, _once(words, "_words"))
    kept = [c for c in rows.columns if c != "_words"]
    rows = rows.select(*kept, "_words", F.greatest(F.size("_words") - 1, F.lit(0)).alias("_last"))
    pairs = F.zip_with(
        F.slice("_words", 1, F.col("_last")), F.slice("_words", 2, F.col("_last")),
        lambda a, b: F.xxhash64(a, b),
    )
    return rows.select(*kept, _once(pairs, "shingles"))


def _banded(texts: DataFrame, step: int, *columns: str) -> DataFrame:
    """``columns`` of ``texts`` (with ``shingles``) per window: ``at``, its first word, and ``minima``, one per band.

    The last windows may be shorter. A text of fewer than two words has no window. A row holds the shingles of its
    window only, so a long text costs no more per window than a short one.
    """
    width = WINDOW - 1
    cut = F.transform(
        F.sequence(F.lit(0), F.size("shingles") - 1, F.lit(step)),
        lambda at: F.struct(at.alias("at"), F.slice("shingles", at + 1, width).alias("own")),
    )
    rows = texts.where(F.size("shingles") > 0).select(*columns, F.explode(cut).alias("w"))
    first = F.get("w.own", F.lit(0))
    rows = rows.select(*columns, F.col("w.at").alias("at"), *[
        F.coalesce(F.get("w.own", F.lit(i)), first, F.lit(0)).alias(f"_h{i}") for i in range(width)
    ])
    # A fixed number of its own makes each minimum that of another hash function.
    minima = F.array(*[
        F.least(*[F.col(f"_h{i}").bitwiseXOR(F.lit(_probe(b))) for i in range(width)])
        for b in range(BANDS)
    ])
    return rows.select(*columns, "at", _once(minima, "minima"))


def _exploded(windows: DataFrame, *columns: str) -> DataFrame:
    return windows.select(*columns, F.posexplode("minima").alias("band", "value"))


def _probe(number: int) -> int:
    """The number-th of a sequence of well-spread 64-bit numbers."""
    value = (number + 1) * 0x9E3779B97F4A7C15 % 2**64
    value = (value ^ value >> 31) * 0xBF58476D1CE4E5B9 % 2**64
    return (value ^ value >> 29) - 2**63


def template_index(docs: DataFrame, templates: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """(band, value, license, part, length, set) of the templates' windows; of one size whatever the corpus."""
    rows = [(name, i, t) for name, texts in templates.items() for i, t in enumerate(texts)]
    texts = docs.sparkSession.createDataFrame(rows, "license string, part int, text string")
    texts = _with_shingles(texts, F.col("text"), F.col("license"), F.col("part"))
    texts = texts.select(
        "*", F.size("shingles").alias("length"), F.array_distinct("shingles").alias("set")
    )
    # Short tails of a template say little; its last full window holds their words.
    windows = _banded(texts, 1, "license", "part", "length", "set").where(
        F.col("at") <= F.greatest(F.col("length") - (WINDOW - 1), F.lit(0))
    )
    found = _exploded(windows, "license", "part", "length", "set")
    return written(found.distinct(), "templates")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """(d1, d2, text): the texts that are not null, by two digests."""
    value = F.col(text).cast("string")
    return docs.where(value.isNotNull()).select(
        F.xxhash64(value).alias("d1"), F.xxhash64(F.lit("again"), value).alias("d2"), value.alias("text")
    )


def _places(ats: Column, length: Column) -> Column:
    """The runs of windows that are no further apart than the template is long: (start, end) in words."""

    def add(done: Column, at: Column) -> Column:
        last = F.element_at(done, -1)
        new = F.struct(at.alias("start"), (at + WINDOW).alias("end"))
        apart = (F.size(done) == 0) | (at - last["end"] > length)
        longer = F.struct(last["start"].alias("start"), (at + WINDOW).alias("end"))
        return F.when(apart, F.concat(done, F.array(new))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        )

    return F.aggregate(F.sort_array(ats), F.array().cast("array<struct<start:int,end:int>>"), add)


def find(
    docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, text: str = "text",
    share: float = 0.8,
) -> DataFrame:
    """(d1, d2, licenses) of each distinct text that holds a license, by two digests of the text.

    licenses: (license, containment, at, spans) once per license, with the best share of a passage's distinct
    shingles around a window, the first word of the first such window, and all places (start, end, part, containment) by
    word numbers: runs of such windows, end exclusive, so a place is exact to a few words. Where passages of several licenses
    are alike, a place counts for those that it holds the largest share of.
    """
    texts = _keyed(docs, text)
    index = template_index(docs, templates)
    windows = _banded(_with_shingles(texts, F.col("text"), F.col("d1"), F.col("d2")), STEP, "d1", "d2")
    values = index.select("band", "value").distinct()
    if values.count() <= LISTED:
        known: dict[int, list[int]] = {}
        for row in values.collect():
            known.setdefault(row["band"], []).append(row["value"])
        wanted = [F.get("minima", F.lit(b)).isin(found) for b, found in sorted(known.items())]
        windows = windows.where(reduce(Column.__or__, wanted, F.lit(False)))
    # The index has a size that the planner knows, and is sent to the windows where that is small.
    names = index.select("band", "value", "license", "part").distinct()
    hits = _exploded(windows, "d1", "d2", "at").join(names, ["band", "value"])
    hits = written(hits.groupBy("d1", "d2", "license", "part").agg(F.collect_set("at").alias("ats")), "windows")
    # Only texts with such a window are cut again, copies of them once.
    again = texts.join(hits.select("d1", "d2").distinct(), ["d1", "d2"], "left_semi").dropDuplicates(["d1", "d2"])
    again = _with_shingles(again, F.col("text"), F.col("d1"), F.col("d2"))
    parts = index.select("license", "part", "length", "set").dropDuplicates(["license", "part"])
    found = hits.join(F.broadcast(parts), ["license", "part"]).join(again, ["d1", "d2"])

    def containment(at: Column) -> Column:
        around = F.slice(
            "shingles", F.greatest(at - F.col("length"), F.lit(0)) + 1, F.col("length") * 2 + WINDOW
        )
        return F.size(F.array_intersect("set", around)) / F.size("set")

    checked = F.transform("ats", lambda at: F.struct(at.alias("at"), containment(at).alias("share")))
    found = found.select("d1", "d2", "license", "part", "length", F.filter(checked, lambda c: c["share"] >= share).alias("kept"))
    found = found.where(F.size("kept") > 0).select(
        "d1", "d2", "license", "part", F.array_max(F.transform("kept", lambda c: c["share"])).alias("containment"),
        F.explode(_places(F.transform("kept", lambda c: c["at"]), F.col("length"))).alias("place"),
    )
    span = F.struct("place.start", "place.end", "part", "containment", "license")
    found = found.groupBy("d1", "d2").agg(F.sort_array(F.collect_list(span)).alias("all"))

    def beaten(one: Column) -> Column:
        return F.exists("all", lambda two: (
            (two["containment"] > one["containment"]) & (two["start"] < one["end"]) & (one["start"] < two["end"])
            & (two["license"] != one["license"])
        ))

    left = found.select("d1", "d2", F.explode(F.filter("all", lambda one: ~beaten(one))).alias("s"))
    best = left.groupBy("d1", "d2", F.col("s.license").alias("license")).agg(
        F.max("s.containment").alias("containment"), F.min("s.start").alias("at"),
        F.sort_array(F.collect_list(F.struct("s.start", "s.end", "s.part", "s.containment"))).alias("spans"),
    )
    return best.groupBy("d1", "d2").agg(
        F.sort_array(F.collect_list(F.struct("license", "containment", "at", "spans"))).alias("licenses")
    )


def scan(
    docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, text: str = "text",
    share: float = 0.8,
) -> DataFrame:
    """All rows with ``licenses``, empty where there is none; a column of that name is replaced.

    Null and empty texts hold none, repeated texts hold the same; without templates none is found.
    """
    columns = [c for c in docs.columns if c.lower() != "licenses"]
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = find(docs, templates, text, share).withColumnsRenamed(
        {"d1": "_license_d1", "d2": "_license_d2", "licenses": "_license_found"}
    )
    keyed = docs.select(
        *columns, F.xxhash64(value).alias("_license_d1"),
        F.xxhash64(F.lit("again"), value).alias("_license_d2"),
    )
    spans = "array<struct<start:int,end:int,part:int,containment:double>>"
    none = F.array().cast(f"array<struct<license:string,containment:double,at:int,spans:{spans}>>")
    return keyed.join(found, ["_license_d1", "_license_d2"], "left").select(
        *columns, F.coalesce("_license_found", none).alias("licenses")
    )
