"""Licence scans: TF-IDF cosine to templates, then inheritance along directories.

Every line and every paragraph of a file, anywhere in its text, is compared with licence
templates as a sparse vector of term frequency times inverse document frequency. Document
frequencies of the templates' terms are counted over all files; a term outside the templates
weighs as much as one that no other file has, so it only lengthens a passage's vector. The
best template at or above the threshold is the file's own licence. Passages that only one
licence has, such as the title of its text or a clause that sets it apart, go before those
that licences share, and a notice of reserved rights, which many licences carry, comes last.
A template counts only if the passage has all of its version numbers. A licence file, by its
name, also speaks for its directory: files without a licence of their own take that of the
nearest directory above them that has one.

Defined cases: a null or empty text has no licence of its own, but may inherit one; a null
path has no directory; of equal scores the smaller licence name wins, of a directory's
licence files the best match and then the smallest path; repeated rows are scanned each for
itself; an empty table gives an empty result; further columns of any name are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlake.llm.common import Scratch

# Wordings by which files name their licence, as commonly published.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
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
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Titles of the licences' texts, and clauses by which one differs from another.
DECIDING: list[tuple[str, str]] = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("ISC", "ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the University nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "Artistic-1.0",
        "The name of the Copyright Holder may not be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-1.1", "MOZILLA PUBLIC LICENSE Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("CC0-1.0", "CC0 1.0 Universal"),
]
# Notices that other licences carry as well.
NOTICES: list[tuple[str, str]] = [
    ("Proprietary", "Copyright. All rights reserved."),
    ("Proprietary", "All rights reserved."),
]
#: All templates; those of an earlier list go before those of a later one.
RANKED = [(rank, *t) for rank, group in enumerate((DECIDING, TEMPLATES, NOTICES)) for t in group]


THRESHOLD = 0.8
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)\b"

_TERM = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
#: A version number, by itself or with what joins it to a name.
_VERSION = re.compile(r"\d+(?:\.\d+)?")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


#: The mark of an item of a list, behind that of a comment.
_ITEM = re.compile(r"[\s/*#;]*(?:\(?(?:\d+|[a-z])[.)]|[*•-])\s")
#: The mark of a comment alone.
_BARE = re.compile(r"[\s/*#;!-]*")


def passages(text: str) -> Iterator[str]:
    """All lines, all paragraphs of several lines, and the items of lists in them; the lines
    of a comment count without its marks."""
    paragraph: list[str] = []
    for line in [*text.split("\n"), ""]:
        if not _BARE.fullmatch(line):
            yield line
            paragraph.append(line)
            continue
        if len(paragraph) > 1:
            yield " ".join(paragraph)
        starts = [i for i, x in enumerate(paragraph) if i and _ITEM.match(x)]
        if starts:
            for a, b in zip([0, *starts], [*starts, len(paragraph)]):
                if b - a > 1:
                    yield " ".join(paragraph[a:b])
        paragraph = []


class Matcher:
    """Templates and terms with their weights."""

    def __init__(self, frequency: dict[str, int], files: int):
        self.unknown = 1 + math.log(1 + files)
        self.weight = {
            t: 1 + math.log((1 + files) / (1 + frequency.get(t, 0))) for _, _, text in RANKED for t in terms(text)
        }
        self.templates = []
        for rank, name, text in RANKED:
            vector = {t: n * self.weight[t] for t, n in Counter(terms(text)).items()}
            versions = frozenset(t for t in vector if _VERSION.fullmatch(t))
            self.templates.append((rank, name, vector, versions, math.sqrt(sum(w * w for w in vector.values()))))

    def best(self, text: str) -> tuple[str | None, float]:
        """The licence whose template a passage of the text is nearest to, and the cosine."""
        found: tuple[int, float, str] | None = None
        for passage in passages(text):
            known, strange = {}, []
            for term in terms(passage):
                if term in self.weight:
                    known[term] = known.get(term, 0) + 1
                else:
                    strange.append(term)
            if not known:
                continue
            vector = {t: n * self.weight[t] for t, n in known.items()}
            inside = sum(w * w for w in vector.values())
            # Strange terms that are all different are the fewest the norm can have.
            if inside < THRESHOLD**2 * (inside + len(strange) * self.unknown**2):
                continue
            outside = sum(n * n for n in Counter(strange).values()) * self.unknown**2
            length = math.sqrt(inside + outside)
            for rank, name, template, versions, norm in self.templates:
                if not versions <= known.keys():
                    continue
                score = round(sum(w * template.get(t, 0.0) for t, w in vector.items()) / (length * norm), 9)
                if score >= THRESHOLD and (found is None or (rank, -score, name) < found):
                    found = (rank, -score, name)
        return (found[2], -found[1]) if found else (None, 0.0)


def term_frequencies(texts: DataFrame) -> dict[str, int]:
    """In how many texts each term of the templates occurs."""
    wanted = frozenset(t for _, _, text in RANKED for t in terms(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total.update(wanted.intersection(terms(text or "")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "n"]
        )

    rows = texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {row["term"]: row["n"] for row in rows.collect()}


def scan(files: DataFrame) -> DataFrame:
    """``files`` (id, path, text) as (id, path, licence, score): each file's own licence."""
    texts = files.select("text")
    matcher = Matcher(term_frequencies(texts), files.count())

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [matcher.best(text or "") for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["id", "path", "licence", "score"],
            )

    kind = files.schema["id"].dataType.simpleString()
    return files.select("id", "path", "text").mapInArrow(match, f"id {kind}, path string, licence string, score double")


def inherit(scanned: DataFrame) -> DataFrame:
    """(id, path, own, score, licence, declared_in) of ``scan``'s rows.

    Directories, not files, are joined with the directories above them; a directory then
    gives all of its files what it found.
    """
    parts = F.split("path", "/")
    above = F.slice(parts, 1, F.size(parts) - 1)
    rows = scanned.select("*", F.array_join(above, "/").alias("directory"), F.element_at(parts, -1).alias("name"))
    speaks = rows.filter(F.col("licence").isNotNull() & F.col("name").rlike(LICENCE_FILE))
    declared = speaks.groupBy("directory").agg(
        F.min_by("licence", F.struct((-F.col("score")).alias("s"), "path")).alias("given")
    )
    directories = rows.filter("directory is not null").select("directory").distinct()
    steps = F.split("directory", "/")
    up = F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")
    chain = directories.select("directory", steps.alias("steps"), up)
    chain = chain.select("directory", "depth", F.array_join(F.slice("steps", 1, F.col("depth")), "/").alias("parent"))
    chain = chain.distinct()
    nearest = chain.join(declared.withColumnRenamed("directory", "parent"), "parent")
    nearest = nearest.groupBy("directory").agg(F.max_by(F.struct("given", "parent"), "depth").alias("from"))
    # Rows without a path have no directory to be joined by, and would all meet in one task.
    nowhere = rows.filter("directory is null").withColumn("from", F.lit(None).cast(nearest.schema["from"].dataType))
    found = rows.filter("directory is not null").join(nearest, "directory", "left").unionByName(nowhere)
    own = F.col("licence").isNotNull()
    return found.select(
        "id",
        "path",
        F.col("licence").alias("own"),
        "score",
        F.coalesce("licence", "from.given").alias("licence"),
        F.when(~own, F.col("from.parent")).alias("declared_in"),
    )


def license_scan(files: DataFrame) -> DataFrame:
    """``scan`` and then ``inherit``; what is scanned is written, as it is used several times."""
    scratch = Scratch(files.sparkSession, "licences")
    return inherit(scratch.keep(scan(files), "scanned"))
