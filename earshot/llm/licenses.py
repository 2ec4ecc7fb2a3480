"""License scans: TF-IDF cosine of headers and licence files to templates, inherited by directory.

A header is a line with a cue word; a licence file is compared line by line and as a whole. Each
is a sparse vector of word weights (inverse document frequencies over all texts, counted for the
templates' words; other words weigh as much as a word that no text has), and the template of
greatest cosine names the license if it reaches ``LEAST``. A file of which at least ``SHARE`` of
the words stand in such lines, or whose name says so, is a licence file and speaks for its
directory. A file without a license of its own takes that of the nearest directory above it (its
own included): the distinct directories are joined, ancestor by ancestor, with those that have
one, so a hot directory costs one row, and files are joined with the outcome.

Null and empty texts have no license of their own but inherit. Null paths have no directory.
Several licence files in a directory: greatest cosine, then smallest license, then smallest
path. Equal rows get equal results. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .common import map_arrow, small_batches, written

LEAST, SHARE = 0.6, 0.5
#: Directories with an outcome are broadcast up to this many rows.
BROADCAST_ROWS = 1_000_000
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|unlicense)(\.[a-z]+)?$"
_CUE = re.compile(r"licen[sc]|copyright|spdx|permission|warrant|redistribut|public domain", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")

#: Usual notices of common licenses, by SPDX identifier.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                   "with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "SPDX-License-Identifier: GPL-3.0-only",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, version 3 of the License"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "SPDX-License-Identifier: GPL-2.0-only"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.",
                 "SPDX-License-Identifier: LGPL-3.0-only"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.",
                 "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Scanner:
    """Cosine of a text to the templates under word weights ``idf`` (``other`` for all other words)."""

    def __init__(self, idf: dict[str, float], other: float, templates: dict[str, list[str]]) -> None:
        self.idf, self.other = idf, other
        # the inverted index of the templates' unit vectors
        self.names, self.index = [], {}
        for name, texts in sorted(templates.items()):
            for t in texts:
                v, norm = self._vector(words(t))
                for w, x in v.items():
                    self.index.setdefault(w, []).append((len(self.names), x / norm))
                self.names.append(name)

    def _vector(self, found: list[str]) -> tuple[dict[str, float], float]:
        v = {w: n * self.idf.get(w, self.other) for w, n in Counter(found).items()}
        return v, math.sqrt(sum(x * x for x in v.values()))

    def best(self, found: list[str]) -> tuple[float, str | None]:
        """(cosine, license) of the nearest template; ties: smallest license."""
        v, norm = self._vector(found)
        dots: dict[int, float] = {}
        for w, x in v.items():
            for t, y in self.index.get(w, ()):
                dots[t] = dots.get(t, 0.0) + x * y
        if not dots:
            return 0.0, None
        t = min(dots, key=lambda t: (-round(dots[t] / norm, 9), self.names[t]))
        return dots[t] / norm, self.names[t]

    def scan(self, text: str, whole: bool, least: float) -> tuple[str | None, float, float]:
        """(license, cosine, share of the words in license lines); ``whole``: compare the whole text too."""
        if not text or not (whole or _CUE.search(text)):
            return None, 0.0, 0.0
        inside, found = 0, []
        for line in text.split("\n"):
            if _CUE.search(line):
                own = words(line)
                score, name = self.best(own)
                if score >= least:
                    found.append((-score, name))
                    inside += len(own)
        all_ = words(text) if found or whole else []
        if whole:
            score, name = self.best(all_)
            if score >= least:
                found.append((-score, name))
        score, name = min(found, default=(0.0, None))
        return name, -score, inside / len(all_) if inside else 0.0


def idf(docs: DataFrame, text: str, templates: dict[str, list[str]]) -> tuple[dict[str, float], float]:
    """Weights of the templates' words from their document counts over all rows (a row per word)."""
    vocabulary = {w for texts in templates.values() for t in texts for w in words(t)}
    small_batches(docs.sparkSession)

    def count(batches):
        n, found = 0, Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                n += 1
                if t:
                    found.update(vocabulary.intersection(words(t)))
        yield pa.RecordBatch.from_arrays([pa.array(["", *found]), pa.array([n, *found.values()], pa.int64())],
                                         names=["word", "n"])

    rows = docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {r["word"]: r["n"] for r in rows}                    # at most the templates' words
    n = df.pop("", 0)
    weight = lambda k: math.log((1 + n) / (1 + k)) + 1        # noqa: E731
    return {w: weight(df.get(w, 0)) for w in vocabulary}, weight(0)


def scan(docs: DataFrame, path: Column, text: str = "text", key: str = "doc_id", least: float = LEAST,
         share: float = SHARE, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """Per row: key, path, license (null: none), evidence (header, file, inherited, none), cosine and
    the path of the licence file it is inherited from."""
    weights, other = idf(docs, text, templates)
    rows = docs.select(F.col(key).alias("_key"), path.alias("_path"), F.col(text).alias("_text"),
                       F.coalesce(path.rlike(FILE_NAME), F.lit(False)).alias("_named"))

    def make():
        scanner = Scanner(weights, other, templates)

        def f(texts, named):
            found = [scanner.scan(t, n, least) for t, n in zip(texts.to_pylist(), named.to_pylist(), strict=True)]
            return [x[0] for x in found], [round(x[1], 6) for x in found], [x[2] for x in found]
        return f
    fields = [T.StructField("_license", T.StringType()), T.StructField("_score", T.DoubleType()),
              T.StructField("_share", T.DoubleType())]
    own = map_arrow(rows, ["_text", "_named"], fields, make, keep=["_key", "_path", "_named"])
    own = own.withColumns({"_file": F.col("_license").isNotNull() & (F.col("_named") | (F.col("_share") >= share)),
                           "_dir": F.regexp_replace(F.col("_path"), "(^|/)[^/]*$", "")})
    own = written(own, "licenses")
    speaks = own.where("_file").groupBy("_dir").agg(F.min(F.struct(
        (-F.col("_score")).alias("s"), F.col("_license").alias("l"), F.col("_path").alias("p"))).alias("_best"))
    parts = F.split("_dir", "/")
    above = own.where("_license is null and _dir is not null").select("_dir").distinct().select(
        "_dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
            F.array_join(F.slice(parts, F.lit(1), i), "/").alias("up"), i.alias("depth")))).alias("a"))
    near = (above.select("_dir", "a.*").join(speaks.withColumnRenamed("_dir", "up"), "up")
            .groupBy("_dir").agg(F.max_by("_best", "depth").alias("_near")))
    near = written(near, "inherited")
    if near.count() <= BROADCAST_ROWS:
        near = F.broadcast(near)
    none = F.col("_license").isNull()
    return own.join(near, "_dir", "left").select(
        F.col("_key").alias(key), F.col("_path").alias("path"), F.coalesce("_license", "_near.l").alias("license"),
        F.when(F.col("_file"), "file").when(~none, "header").when(F.col("_near").isNotNull(), "inherited")
        .otherwise("none").alias("evidence"), F.when(~none, F.col("_score")).alias("score"),
        F.when(none, F.col("_near.p")).alias("inherited_from"))
