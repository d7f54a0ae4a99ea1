"""Licence scans: sparse TF-IDF cosine to notices, then inheritance from the nearest directory.

Every line of every text is a possible header, and so are spans of 2 to 8 neighbouring lines and
whole blocks of lines, since headers wrap (lines without a term, such as a bare comment sign, end a
block and do not count in a span; comment signs are no terms).  The whole text of a licence file (by its
name) is one more unit, and only that one is held against full licence texts as well; such a text decides
before any line of it does.  Units and templates are sparse vectors of term counts times the
inverse document frequency among the templates; a unit has the licence of the template with
the largest cosine, if that reaches ``least``.

Most lines cannot reach it, and that is decided without a vector: by Cauchy-Schwarz a unit
without a template's heaviest terms has at most the cosine that the template's other terms
carry of its length.  A text moves on only if it holds one of these terms, so the terms of
nearly all lines are never exploded, and nothing is lost.  Of spans and blocks only those go on whose
cosine can reach ``least``: dot products add up over lines and squared lengths add up to no less.

A file without a licence of its own takes that of the nearest directory above it with a
licence file.  Paths are exploded into their ancestors and joined to those directories.

Nulls: a null text has no licence of its own; a null path has no ancestors.  Of several
licence files in a directory the best score counts, then the smaller licence name.  Rows
that repeat an id or a path are scored one by one.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.arrays import term_counts
from ..sources.staging import stage
from ..wordlists import ENGLISH_STOPWORDS
from .base import query, table

TERM = "[a-z0-9]+"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"

# Public notices of licences.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)

# Full texts of licences, one file for each; their names are those of the notices or of SPDX.
FULL_TEXTS = tuple(sorted((p.name.removesuffix(".txt"), p.read_text()) for p in resources.files(__package__).joinpath("licence_texts").iterdir()))
SPAN = 8  # lines of a span


@dataclass(frozen=True)
class Templates:
    """Vectors of the notices, which also give the frequencies, and of full texts.  ``least`` is the smallest cosine that counts."""

    notices: tuple[tuple[str, str], ...] = NOTICES
    full: tuple[tuple[str, str], ...] = FULL_TEXTS
    least: float = 0.8
    counts: tuple[Counter, ...] = field(init=False)
    idf: dict[str, float] = field(init=False)

    def __post_init__(self) -> None:
        counts = tuple(Counter(re.findall(TERM, text.lower())) for _, text in self.notices)
        n = len(counts)
        seen = Counter(term for c in counts for term in c)
        object.__setattr__(self, "counts", counts)
        object.__setattr__(self, "idf", {t: math.log((1 + n) / (1 + df)) + 1 for t, df in seen.items()})

    @property
    def unseen(self) -> float:
        """The weight of a term that no template has."""
        return math.log(1 + len(self.counts)) + 1

    def weights(self) -> list[tuple[str, str, int, float]]:
        """``(term, licence, template, weight)`` of unit vectors."""
        return self._weights(self.notices, self.counts)

    def full_weights(self) -> list[tuple[str, str, int, float]]:
        return self._weights(self.full, [Counter(re.findall(TERM, text.lower())) for _, text in self.full])

    def _weights(self, texts, counts) -> list[tuple[str, str, int, float]]:
        rows = []
        for at, ((licence, _), count) in enumerate(zip(texts, counts)):
            weighted = {t: n * self.idf.get(t, self.unseen) for t, n in count.items()}
            length = math.sqrt(sum(w ** 2 for w in weighted.values()))
            rows += [(t, licence, at, w / length) for t, w in weighted.items()]
        return rows

    def needed(self, full: bool = False) -> list[str]:
        """Terms of which a unit must have one: without these a template cannot be reached.

        Any terms do whose weights together suffice; those that are not common words are taken first.
        """
        terms, weights = set(), self.full_weights() if full else self.weights()
        for at in range(len(self.full if full else self.notices)):
            mine = sorted(((w, t) for t, _, template, w in weights if template == at),
                          key=lambda x: (x[1] in ENGLISH_STOPWORDS, -x[0], x[1]))
            left = sum(w * w for w, _ in mine)
            while mine and math.sqrt(max(left, 0.0)) >= self.least - 1e-9:
                w, t = mine.pop(0)
                left -= w * w
                terms.add(t)
        return sorted(terms)


def ancestors(path: Column) -> Column:
    """The directories above a path, the nearest last; the root is the empty string."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def line_spans(text: str, templates: Templates, vectors: dict[str, np.ndarray]) -> list[str]:
    """Spans of 2 to ``SPAN`` lines and longer blocks that may have a notice's cosine; ``vectors`` are those of the terms."""
    held, block, blocks = [], 0, []
    for line in text.lower().split("\n"):
        terms = re.findall(TERM, line)
        if terms:
            held.append((line, terms))
            blocks.append(block)
        else:
            block += 1
    if len(held) < 2:
        return []
    dots, squares = np.zeros((len(held) + 1, len(templates.notices))), np.zeros(len(held) + 1)
    for i, (_, terms) in enumerate(held, 1):
        for t, n in Counter(terms).items():
            squares[i] += (n * templates.idf.get(t, templates.unseen)) ** 2
            if t in vectors:
                dots[i] += n * templates.idf[t] * vectors[t]
    dots, squares, found = dots.cumsum(0), squares.cumsum(), []
    for k in range(2, min(SPAN, len(held)) + 1):
        bound = (dots[k:] - dots[:-k]).max(1) / np.sqrt(squares[k:] - squares[:-k])
        found += [(i, i + k) for i in np.flatnonzero(bound >= templates.least - 1e-5).tolist()]
    edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(held)]
    for a, b in zip(edges, edges[1:]):
        if b - a > SPAN and (dots[b] - dots[a]).max() / np.sqrt(squares[b] - squares[a]) >= templates.least - 1e-5:
            found.append((a, b))
    return ["\n".join(line for line, _ in held[a:b]) for a, b in found]


def own_licences(files: DataFrame, templates: Templates) -> DataFrame:
    """``(row, licence, score, whole)`` of the best unit of each of ``files(row, path, text)`` that has one."""
    spark = files.sparkSession
    one_of = lambda terms: F.lit(r"(?i)(?<![a-z0-9])(" + "|".join(sorted(terms)) + ")(?![a-z0-9])")
    needed, needed_whole = one_of(templates.needed()), one_of({*templates.needed(), *templates.needed(full=True)})
    # One row for each term of the templates, which are given: its weight there and in each of them.
    names = [name for name, _ in (*templates.notices, *templates.full)]
    short, full_weights = len(templates.notices), templates.full_weights()
    idf = {t: templates.unseen for t, *_ in full_weights} | templates.idf
    vectors = {t: [0.0] * len(names) for t in idf}
    for t, _, at, w in templates.weights():
        vectors[t][at] = w
    for t, _, at, w in full_weights:
        vectors[t][short + at] = w
    in_notices = {t: np.array(vectors[t][:short]) for t in templates.idf}
    # A task gets the weights and not the texts.
    light = Templates(templates.notices, (), templates.least)

    @F.pandas_udf("array<string>")
    def spans(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [] if text is None else line_spans(text, light, in_notices))

    is_file = F.coalesce(F.rlike("path", F.lit(LICENCE_FILE)), F.lit(False))
    has_notice = F.rlike("text", needed)
    possible = (files.where(F.when(is_file, F.rlike("text", needed_whole)).otherwise(has_notice))
                .select("row", "text", is_file.alias("is_file"), spans("text").alias("spans")))
    as_lines = lambda texts: F.transform(texts, lambda text: F.struct(text.alias("unit"), F.lit(False).alias("whole")))
    whole = F.when(F.col("is_file"), F.array(F.struct(F.col("text").alias("unit"), F.lit(True).alias("whole"))))
    empty = F.array().cast("array<struct<unit:string,whole:boolean>>")
    units = (possible.select("row", F.posexplode_outer(F.concat(as_lines(F.split("text", "\n")), as_lines(F.col("spans")), F.coalesce(whole, empty))).alias("n", "u"))
             .select("row", "n", "u.unit", "u.whole").where(F.when(F.col("whole"), F.rlike("unit", needed_whole)).otherwise(F.rlike("unit", needed))))
    counted = units.select("row", "n", "whole", F.inline_outer(term_counts(F.regexp_extract_all(F.lower("unit"), F.lit(TERM), 0))))
    known = spark.createDataFrame([(t, w, vectors[t]) for t, w in sorted(idf.items())],
                                  "term string, idf double, vector array<double>")
    weighted = (counted.where("term is not null").join(F.broadcast(known), "term", "left")
                .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(templates.unseen))))
    # The terms of a unit stand in one task, where they are summed up before the shuffle.
    sums = weighted.groupBy("row", "n", "whole").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"),
        *[F.sum(F.col("w") * F.get("vector", F.lit(k))).alias(f"dot{k}") for k in range(len(names))])
    cosines = F.array(*[F.struct(F.round(F.col(f"dot{k}") / F.col("length"), 6).alias("score"), F.lit(name).alias("licence"),
                                 F.lit(k >= short).alias("full")) for k, name in enumerate(names)])
    scored = sums.select("row", "whole", F.inline(cosines)).where((F.col("score") >= templates.least) & (~F.col("full") | F.col("whole")))
    best = F.min(F.struct((~F.col("full")).alias("notice"), (-F.col("score")).alias("s"), "licence", (~F.col("whole")).alias("line"))).alias("best")
    return scored.groupBy("row").agg(best).select(
        "row", "best.licence", (-F.col("best.s")).alias("score"), (~F.col("best.line")).alias("whole"))


def licences(files: DataFrame, templates: Templates = Templates(), id_col: str = "doc_id", path_col: str = "path",
             text_col: str = "text") -> DataFrame:
    """``(id, path, licence, score, origin, directory)`` of each row of ``files``.

    ``origin`` is ``header``, ``file``, ``inherited`` or ``none``; ``directory`` is where an
    inherited licence comes from.
    """
    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    # A row is known by its id and path; rows that agree in both share the best licence of their texts.
    row = F.struct("id", "path").alias("row")
    own = stage(own_licences(rows.select(row, "path", "text"), templates))
    given = (own.where(F.rlike("row.path", F.lit(LICENCE_FILE)))
             .select(F.element_at(ancestors(F.col("row.path")), -1).alias("directory"), "licence", "score")
             .groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"))
             .select("directory", F.col("best.licence").alias("_licence"), (-F.col("best.s")).alias("_score")))
    above = (rows.select(row, F.posexplode(ancestors(F.col("path"))).alias("depth", "directory"))
             .join(given, "directory")
             .groupBy("row").agg(F.max(F.struct("depth", "directory", "_licence", "_score")).alias("near")))
    left = rows.select("id", "path", row)
    own, above = own.withColumnRenamed("row", "_own"), above.withColumnRenamed("row", "_above")
    met = left.join(own, F.col("row").eqNullSafe(F.col("_own")), "left").join(above, F.col("row").eqNullSafe(F.col("_above")), "left")
    origin = (F.when(F.col("licence").isNotNull(), F.when(F.col("whole"), "file").otherwise("header"))
              .when(F.col("near").isNotNull(), "inherited").otherwise("none"))
    return met.select(
        F.col("id").alias(id_col), "path", F.coalesce("licence", "near._licence").alias("licence"),
        F.coalesce("score", "near._score").alias("score"), origin.alias("origin"),
        F.when(F.col("licence").isNull(), F.col("near.directory")).alias("directory"))


# Documents have no path.  This one files them by source and language; every sixteenth is the licence file of its folder.
_PATH = """concat(source, '/', lang, '/', CAST(doc_id DIV 256 AS STRING), '/',
           CASE WHEN doc_id % 16 = 0 THEN 'LICENSE' ELSE 'doc' END, CAST(doc_id AS STRING))"""
_PATH_SQL = """concat(source, '/', lang, '/', CAST(doc_id // 256 AS VARCHAR), '/',
           CASE WHEN doc_id % 16 = 0 THEN 'LICENSE' ELSE 'doc' END, CAST(doc_id AS VARCHAR))"""
_T = Templates()
_WEIGHTS_SQL = ", ".join(f"('{t}', '{name}', {at}, {w!r}::DOUBLE)" for t, name, at, w in _T.weights())
_IDF_SQL = ", ".join(f"('{t}', {w!r}::DOUBLE)" for t, w in sorted(_T.idf.items()))


@query(rf"""
WITH weights(term, licence, template, weight) AS (VALUES {_WEIGHTS_SQL}),
idf(term, idf) AS (VALUES {_IDF_SQL}),
files AS (SELECT doc_id, {_PATH_SQL} AS path, text FROM documents),
units AS (
  SELECT doc_id, path, n, unit, false AS whole
  FROM (SELECT doc_id, path, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM files)
  UNION ALL SELECT doc_id, path, 0, text, true FROM files WHERE regexp_matches(path, '/LICENSE[^/]*$')),
terms AS (
  SELECT doc_id, path, n, whole, term, count(*) AS tf
  FROM (SELECT doc_id, path, n, whole, unnest(regexp_extract_all(lower(unit), '{TERM}')) AS term FROM units) GROUP BY ALL),
weighted AS (SELECT t.*, tf * coalesce(idf, {_T.unseen!r}) AS w FROM terms t LEFT JOIN idf USING (term)),
lengths AS (SELECT doc_id, n, sqrt(sum(w * w)) AS length FROM weighted GROUP BY doc_id, n),
dots AS (SELECT doc_id, path, n, whole, licence, template, sum(w * weight) AS dot FROM weighted JOIN weights USING (term) GROUP BY ALL),
scored AS (SELECT *, round(dot / length, 6) AS score FROM dots JOIN lengths USING (doc_id, n) WHERE round(dot / length, 6) >= {_T.least}),
own AS (SELECT doc_id, path, licence, score, whole FROM scored
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence, whole DESC) = 1),
given AS (SELECT regexp_replace(path, '/[^/]*$', '') AS directory, licence, score FROM own WHERE regexp_matches(path, '/LICENSE[^/]*$')
          QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '') ORDER BY score DESC, licence) = 1),
above AS (
  SELECT f.doc_id, g.directory, g.licence, g.score FROM files f JOIN given g ON starts_with(f.path, g.directory || '/')
  QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(g.directory) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(o.licence, a.licence) AS licence, coalesce(o.score, a.score) AS score,
       CASE WHEN o.licence IS NOT NULL THEN CASE WHEN o.whole THEN 'file' ELSE 'header' END
            WHEN a.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.licence IS NULL THEN a.directory END AS directory
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN above a USING (doc_id)
""")
def op3_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences(table(spark, folder, "documents").select("doc_id", F.expr(_PATH).alias("path"), "text"))
