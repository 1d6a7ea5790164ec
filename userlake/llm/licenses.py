"""License scans: TF-IDF cosine to templates, then inheritance from the nearest directory above.

Every sentence, line and paragraph of a file, and the file as a whole, is held
against the templates; term weights come from the document frequencies of all
files. A unit that reaches the bound must share one of the heaviest terms of a
template, the rest of which alone could not reach it, so files without such a
term are passed over. The file as a whole is also held against whole licence
texts, with weights of their own. A file whose whole text reaches the bound to
either, or that has a licence and the name of a licence file, is a licence file
and speaks for its directory. A file without a licence of its own takes that of
the nearest directory above it that has one.

A whole text that is reached names the licence, unless a wording of a licence
whose whole text is not held scores higher.

Defined cases: a null or empty text has no licence of its own; a null path has
no directory and inherits nothing; ties go to the first licence by name;
repeated rows are scanned each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from importlib.resources import files as package_files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.llm.common import stored

MIN_COSINE = 0.7
# Directories in which very many files lie are dealt over this many tasks.
SALTS = 16

# Fixed: wordings of common licence notices and openings of licence files.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has dedicated all copyright and related rights to this work to "
        "the public domain worldwide.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE in the project root for license information.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction.',
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
}

# Terms that a file must and must not have to be given a whole text's name, where variants not held are much alike.
APART: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "CC-BY-SA-4.0": (frozenset({"sharealike"}), frozenset({"noncommercial", "noderivatives"})),
}
LICENSE_NAME = r"(?i)^(?:(?:un)?licen[cs]es?|copying|copyright)(?:[^a-z].*)?$"

_WORD = re.compile(r"[^\W_]+")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
_SENTENCE = re.compile(r"\n|(?<=[.!?;:])\s+")


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def units(text: str) -> Iterator[str]:
    """The parts of a text that are scored by themselves, and the whole."""
    seen = set()
    for paragraph in _PARAGRAPH.split(text):
        for unit in (paragraph, *_SENTENCE.split(paragraph)):
            if unit and unit not in seen:
                seen.add(unit)
                yield unit
    if text not in seen:
        yield text


class Matcher:
    """Scores texts against the templates with given term weights."""

    def __init__(self, files: int, frequency: dict[str, int], templates=TEMPLATES, bound: float = MIN_COSINE):
        self.bound = bound
        self.weight = {t: math.log((files + 1) / (frequency.get(t, 0) + 1)) + 1 for t in vocabulary(templates)}
        self.foreign = math.log(files + 1) + 1  # terms of no template count as the rarest
        self.vectors: list[tuple[str, dict[str, float]]] = []
        self.telling: set[str] = set()
        for name in sorted(templates):
            for wording in templates[name]:
                vector = {t: n * self.weight[t] for t, n in Counter(terms(wording)).items()}
                norm = math.sqrt(sum(v * v for v in vector.values()))
                vector = {t: v / norm for t, v in vector.items()}
                self.vectors.append((name, vector))
                rest = 1.0
                for t in sorted(vector, key=lambda t: (-vector[t], t)):
                    if rest < (bound - 1e-6) ** 2:
                        break
                    self.telling.add(t)
                    rest -= vector[t] ** 2

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """Highest cosine and its licence; of equal ones the first by name."""
        counts = Counter(words)
        values = {t: n * self.weight.get(t, self.foreign) for t, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in values.values()))
        top, license = 0.0, None
        for name, vector in self.vectors:
            score = sum(v * values[t] for t, v in vector.items() if t in values) / norm if norm else 0.0
            if score > top + 1e-9:
                top, license = score, name
        return top, license

    def scan(self, text: str | None) -> tuple[str | None, float | None, bool]:
        """Licence of a text, its cosine, and whether the whole text is a licence."""
        whole = terms(text or "")
        if self.telling.isdisjoint(whole):
            return None, None, False
        top, license = 0.0, None
        for unit in units(text):
            words = terms(unit)
            if not self.telling.isdisjoint(words):
                score, name = self.best(words)
                if score > top + 1e-9 or (abs(score - top) <= 1e-9 and name and (license is None or name < license)):
                    top, license = score, name
        if top < self.bound:
            return None, None, False
        return license, top, self.best(whole)[0] >= self.bound


@cache
def whole_texts() -> dict[str, tuple[str, ...]]:
    """Whole licence texts by name, from the files beside this module."""
    folder = package_files(__package__) / "license_texts"
    return {f.name.removesuffix(".txt"): (f.read_text(encoding="utf-8"),) for f in folder.iterdir() if f.name.endswith(".txt")}


class WholeMatcher:
    """Scores files as wholes against whole licence texts."""

    def __init__(self, files: int, frequency: dict[str, int], bound: float = MIN_COSINE):
        self.bound, self.names = bound, frozenset(whole_texts())
        self.matcher = Matcher(files, frequency, whole_texts(), bound)

    def best(self, text: str | None) -> tuple[float, str | None]:
        """Cosine and licence of the whole text that is reached, or none."""
        words, weight = terms(text or ""), self.matcher.weight
        known = foreign = 0.0
        for t, n in Counter(words).items():
            if t in weight:
                known += (n * weight[t]) ** 2
            else:
                foreign += (n * self.matcher.foreign) ** 2
        if known < (self.bound - 1e-6) ** 2 * (known + foreign):  # the rest is foreign, so no cosine can reach the bound
            return 0.0, None
        score, name = self.matcher.best(words)
        must, must_not = APART.get(name, (frozenset(), frozenset()))
        if score < self.bound or not must.issubset(words) or not must_not.isdisjoint(words):
            return 0.0, None
        return score, name


def judged(matcher: Matcher, whole: WholeMatcher, text: str | None) -> tuple[str | None, float | None, bool]:
    """Licence of a file, its cosine, and whether the file is a licence, by wordings and whole texts."""
    license, cosine, is_license = matcher.scan(text)
    score, name = whole.best(text)
    if name is None:
        return license, cosine, is_license
    if license is None or license in whole.names or cosine <= score:
        license, cosine = name, score
    return license, cosine, True


def vocabulary(templates=TEMPLATES) -> frozenset[str]:
    return frozenset(t for wordings in templates.values() for w in wordings for t in terms(w))


def term_frequencies(files: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of files, and of files with each term of the templates and whole texts; bounded by these."""
    known = vocabulary() | vocabulary(whole_texts())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, Counter()
        for batch in batches:
            total += batch.num_rows
            for text in batch.column(0):
                found.update(known.intersection(terms(text.as_py() or "")))
        rows = [("", total), *found.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["term", "n"])

    rows = files.select("text").mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    frequency = {r["term"]: r["n"] for r in rows}
    return frequency.pop("", 0), frequency


def own_licenses(files: DataFrame) -> DataFrame:
    """file_id, directory, license, cosine and is_license_file by the text of each file."""
    weights = term_frequencies(files)
    shared = files.sparkSession.sparkContext.broadcast((Matcher(*weights), WholeMatcher(*weights)))  # bounded by the templates

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judged(*shared.value, t.as_py()) for t in batch.column("text")]
            names, scores, whole = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file_id"), batch.column("directory"), pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array([w or (n is not None and bool(x)) for w, n, x in zip(whole, names, batch.column("named").to_pylist())], pa.bool_()),
                ],
                ["file_id", "directory", "license", "cosine", "is_license_file"],
            )

    name = F.substring_index("path", "/", -1)
    directory = F.col("path").substr(F.lit(1), F.greatest(F.length("path") - F.length(name) - 1, F.lit(0)))
    return files.select("file_id", directory.alias("directory"), name.rlike(LICENSE_NAME).alias("named"), "text").mapInArrow(
        scan, "file_id bigint, directory string, license string, cosine double, is_license_file boolean"
    )


def nearest_license(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """For each directory the licence of the nearest licensed directory at or above it, where there is one."""
    parts = F.split("directory", "/")
    above = directories.select(
        "directory", parts.alias("parts"), F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth")
    ).select("directory", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("above"))
    return (
        above.join(licensed.select(F.col("directory").alias("above"), F.col("license").alias("inherited")), "above")
        .groupBy("directory")
        .agg(F.max_by(F.struct("inherited", "above"), "depth").alias("near"))
        .select("directory", "near.inherited", F.col("near.above").alias("from_directory"))
    )


def scan_licenses(files: DataFrame) -> DataFrame:
    """file_id, license, origin (own, inherited or null), cosine and from_directory of each (file_id, path, text)."""
    own = stored(own_licenses(files), "licenses")
    order = F.struct(-F.col("cosine"), F.col("license"))
    licensed = (
        own.where("is_license_file AND directory IS NOT NULL").groupBy("directory").agg(F.min_by("license", order).alias("license"))
    )
    directories = own.where("directory IS NOT NULL AND license IS NULL").select("directory").distinct()
    near = nearest_license(directories, licensed).withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    salted = own.withColumn("salt", F.pmod(F.xxhash64("file_id"), F.lit(SALTS)))
    return salted.join(near, ["directory", "salt"], "left").select(
        "file_id",
        F.coalesce("license", "inherited").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        "cosine",
        F.when(F.col("license").isNull(), F.col("from_directory")).alias("from_directory"),
        "is_license_file",
    )


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as files that lie in a folder for each source and language."""
    part = lambda c: F.replace(F.coalesce(F.col(c), F.lit("unknown")), F.lit("/"), F.lit("_"))
    return documents.select(
        F.col("doc_id").alias("file_id"),
        F.concat_ws("/", F.lit(""), part("source"), part("lang"), F.col("doc_id").cast("string")).alias("path"),
        "text",
    )
