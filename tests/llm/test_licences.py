import math
import re
from collections import Counter

from pyspark.sql import functions as F

from strophe.llm.licences import FULL_TEXTS, LICENCE_FILE, NOTICES, Templates, licences


def words(text):
    return Counter(re.findall("[a-z0-9]+", text.lower()))


def brute_force(rows, least=0.8):
    """(licence, score, origin, directory) of each (id, path, text) with different ids."""
    notices = [words(t) for _, t in NOTICES]
    seen = Counter(t for n in notices for t in n)

    def vector(counts):
        v = {t: n * (math.log((1 + len(notices)) / (1 + seen[t])) + 1) for t, n in counts.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()} if length else {}

    vectors = [(name, vector(n)) for (name, _), n in zip(NOTICES, notices)]
    own = {}
    for i, path, text in rows:
        named = path is not None and re.search(LICENCE_FILE, path)
        units = [(line, False) for line in (text or "").split("\n")] + ([(text or "", True)] if named else [])
        found = [(-round(sum(w * v.get(t, 0) for t, w in vector(words(u)).items()), 6), name, not whole)
                 for u, whole in units for name, v in vectors]
        best = min((f for f in found if -f[0] >= least), default=None)
        own[i] = best and (best[1], -best[0], "header" if best[2] else "file", None)
    given = {}
    for i, path, _ in rows:
        if path is not None and re.search(LICENCE_FILE, path) and own[i]:
            key = path.rpartition("/")[0]
            given[key] = min(given.get(key, (9, "")), (-own[i][1], own[i][0]))
    out = {}
    for i, path, _ in rows:
        out[i] = own[i]
        if own[i] is None:
            parts = (path or "").split("/")[:-1]
            near = next(("/".join(parts[:n]) for n in range(len(parts), -1, -1) if path is not None and "/".join(parts[:n]) in given), None)
            out[i] = (None, None, "none", None) if near is None else (given[near][1], -given[near][0], "inherited", near)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.0, "y") for r in rows], "doc_id long, path string, text string, licence string, score double, row string")


ROWS = [
    (1, "LICENSE", "Released under the MIT License."), (2, "a.py", "code"), (3, "lib/b.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
    (4, "lib/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."), (5, "lib/sub/deep/c.py", None),
    (6, "lib/sub/COPYING", "nothing that is known"), (7, "other/COPYING", "All rights reserved."), (8, "other/LICENCE", "Licensed under CC BY-NC 4.0."),
    (9, "other/d", ""), (10, None, "Licensed under CC BY-SA 4.0."), (11, None, None), (12, "other/sub/e", "the license of all this work"),
    (13, "x/LICENSE", "\n".join(["Licensed under the Apache License, Version 2.0 (the \"License\");", "you may not use this file except in", "compliance with the License."])),
    (14, "x/y/f", "a " * 30_000), (15, "x//g", "q"), (16, "", "mit und ohne"), (17, "z/license-mit", "ALL RIGHTS RESERVED"),
]


def test_scan_and_inheritance(spark):
    got = {r.doc_id: (r.licence, r.score, r.origin, r.directory) for r in licences(table(spark, ROWS)).collect()}
    assert got == brute_force(ROWS)


def test_filter_loses_nothing():
    """Without a needed term no notice is reached: a notice less those terms is not."""
    templates = Templates()
    needed = set(templates.needed())
    for at, count in enumerate(templates.counts):
        left = sum(w * w for t, _, template, w in templates.weights() if template == at and t not in needed)
        assert math.sqrt(left) < templates.least


def test_empty_and_repeated(spark):
    assert licences(table(spark, [])).count() == 0
    assert licences(table(spark, [ROWS[0], ROWS[0], ROWS[4], ROWS[4]])).count() == 4


def test_columns(spark):
    assert licences(table(spark, ROWS[:2])).columns == ["doc_id", "path", "licence", "score", "origin", "directory"]


def test_wrapped_headers_and_full_texts(spark):
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n")
    bsd = (" * Redistribution and use in source and binary forms, with or without\n *\n"
           " * modification, are permitted provided that the following conditions\n * are met:\n")
    long_block = "\n".join(next(text for name, text in NOTICES if name == "GPL-3.0" and len(text) > 100).split(" "))
    full = dict(FULL_TEXTS)
    mine = "Copyright (c) 2020, Some Body\nAll rights reserved.\n\n"
    rows = [(1, "a/x.py", f"#!/bin/sh\n# Copyright 2020 Some Body\n{gpl}\nimport os\n"), (2, "a/y.c", f"/*\n{bsd} */\nint main;"),
            (3, "a/z", f"some words\n\n{long_block}\n\nmore words")]
    rows += [(10 + i, f"d{i}/LICENSE", mine + text) for i, text in enumerate(full.values())]
    rows += [(100 + i, f"d{i}/src/f.py", "code") for i in range(len(full))] + [(200, "b/doc.txt", full["MIT"])]
    got = {r.doc_id: r for r in licences(table(spark, rows)).collect()}
    assert [got[i].licence for i in (1, 2, 3)] == ["GPL-3.0", "BSD-3-Clause", "GPL-3.0"]
    assert all(got[i].origin == "header" for i in (1, 2, 3))
    for i, name in enumerate(full):
        assert (got[10 + i].licence, got[10 + i].origin) == (name, "file")
        assert (got[100 + i].licence, got[100 + i].origin, got[100 + i].directory) == (name, "inherited", f"d{i}")


def test_filter_loses_no_full_text():
    templates = Templates()
    needed, weights = set(templates.needed(full=True)), templates.full_weights()
    for at in range(len(templates.full)):
        assert math.sqrt(sum(w * w for t, _, template, w in weights if template == at and t not in needed)) < templates.least
