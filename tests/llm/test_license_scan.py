import math
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from matchlake.llm import license_scan, queries
from matchlake.llm.license_scan import RANKED, THRESHOLD, Matcher, passages, terms

#: What many prose files have, so that words of every day weigh little.
COMMON = {t: 900 for t in "the of and to a in this is for or you with by any that be as are not all".split()}
#: Texts of licences as this system holds them, where it does.
STORED = Path("/usr/share/common-licenses")

MIT = """Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
ISC = """Copyright (c) 2024, Some One

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.
"""
BSD_2 = """Copyright (c) 2024, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software without
   specific prior written permission.
"""
HEADER = """/*
 * This {what} is free software{stop} you can redistribute it and/or modify
 * it under the terms of the GNU {kind}General Public License as published by
 * the Free Software Foundation{comma} either version {version} of the License, or
 * (at your option) any later version.
 */
int main() {{}}
"""


def header(kind, version, what="program"):
    new = version == "3"
    return HEADER.format(kind=kind, version=version, what=what, stop=":" if new else ";", comma="," if new else ";")


@pytest.mark.parametrize("frequency", [{}, COMMON], ids=["rare words", "common words"])
def test_texts_and_headers_are_told_apart(frequency):
    matcher = Matcher(frequency, 1000)
    expected = {
        MIT: "MIT", ISC: "ISC", BSD_2: "BSD-2-Clause", BSD_3: "BSD-3-Clause",
        BSD_3.replace("\n\n1.", "\n1."): "BSD-3-Clause",
        header("", "2"): "GPL-2.0", header("", "3"): "GPL-3.0", header("Affero ", "3"): "AGPL-3.0",
        header("Lesser ", "2.1", "library"): "LGPL-2.1", header("Lesser ", "3", "library"): "LGPL-3.0",
        "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in "
        "compliance with the License.\n# You may obtain a copy of the License at\n#\n"
        "#     http://www.apache.org/licenses/LICENSE-2.0": "Apache-2.0",
        "Licensed under the Apache License, Version 1.1.": None,
        "Copyright 2024. All rights reserved.": "Proprietary",
        "All rights reserved.": "Proprietary",
        "The license of a party is granted.": None, "": None,
    }
    assert {text: matcher.best(text)[0] for text in expected} == expected


@pytest.mark.skipif(not STORED.exists(), reason="no licence texts on this system")
@pytest.mark.parametrize("frequency", [{}, COMMON], ids=["rare words", "common words"])
def test_whole_texts(frequency):
    names = {
        "Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0",
        "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1",
        "MPL-2.0": "MPL-2.0", "Artistic": "Artistic-1.0", "GFDL-1.3": "GFDL-1.3",
    }
    matcher = Matcher(frequency, 1000)
    there = {f: n for f, n in names.items() if (STORED / f).exists()}
    assert {f: matcher.best((STORED / f).read_text())[0] for f in there} == there


def plain_best(text, frequency, files):
    """Every passage against every template, by the definition of the cosine."""
    known = {t for _, _, x in RANKED for t in terms(x)}
    weigh = lambda t: 1 + math.log((1 + files) / (1 + frequency.get(t, 0))) if t in known else 1 + math.log(1 + files)
    found = []
    for passage in passages(text or ""):
        a = {t: n * weigh(t) for t, n in Counter(terms(passage)).items()}
        for rank, name, template in RANKED:
            b = {t: n * weigh(t) for t, n in Counter(terms(template)).items()}
            if any(re.fullmatch(r"\d+(\.\d+)?", t) and t not in a for t in b):
                continue
            length = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
            score = sum(w * b.get(t, 0) for t, w in a.items()) / length if length else 0
            if score >= THRESHOLD:
                found.append((rank, -round(score, 9), name))
    return min(found)[2] if found else None


def test_query_equals_a_plain_scan_and_a_walk_up_the_tree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    frequency = Counter(t for d in docs for t in set(terms(d["text"] or "")))
    own, path = {}, {}
    for d in docs:
        i = d["doc_id"]
        own[i] = plain_best(d["text"], frequency, len(docs))
        path[i] = f"{d['source'] or 'none'}/{i // 512}/{i // 64}/{'LICENSE' if i % 8 == 0 else 'file'}.{i}"
    declared = {}
    for i in sorted(own):
        if own[i] and i % 8 == 0:
            declared.setdefault(path[i].rpartition("/")[0], set()).add(own[i])
    found = {r["doc_id"]: r for r in queries.op2_license_scan(spark, "/root/testdata/sf0.001").collect()}
    assert {i: r["own"] for i, r in found.items()} == own and len(set(own.values())) > 2
    for i, row in found.items():
        folder = path[i].rpartition("/")[0]
        while folder not in declared and folder:
            folder = folder.rpartition("/")[0]
        if own[i]:
            assert (row["licence"], row["declared_in"]) == (own[i], None)
        else:
            assert row["declared_in"] == (folder or None)
            assert row["licence"] in declared.get(folder, {None})


def test_odd_files(spark):
    """Ties, repeated rows, a very long line, rows without a path, and clashing names."""
    rows = [
        (1, "a/LICENSE", "Released under the MIT License.\nLicensed under CC BY 4.0."),
        (1, "a/LICENSE", "Released under the MIT License.\nLicensed under CC BY 4.0."),
        (2, "a/COPYING", "Released under the MIT License."),
        (3, "a/b/x", "word " * 50_000 + "Released under the MIT License."),
        (4, "a/b/y", "word " * 50_000 + "\nReleased under the MIT License."),
        (5, None, None),
        (6, None, "Released under the MIT License."),
        (7, "", ""),
        (8, "/", "x"),
    ]
    files = spark.createDataFrame(rows, "id long, path string, text string")
    for name in ("own", "licence", "directory", "declared_in", "score", "name", "given", "from", "parent"):
        files = files.withColumn(name, F.lit("mine"))
    found = license_scan.license_scan(files).collect()
    assert sorted((r["id"], r["own"], r["licence"], r["declared_in"]) for r in found) == [
        (1, "CC-BY-4.0", "CC-BY-4.0", None), (1, "CC-BY-4.0", "CC-BY-4.0", None), (2, "MIT", "MIT", None),
        (3, None, "MIT", "a"), (4, "MIT", "MIT", None), (5, None, None, None),
        (6, "MIT", "MIT", None), (7, None, None, None), (8, None, None, None),
    ]
    assert license_scan.license_scan(files.limit(0)).count() == 0
