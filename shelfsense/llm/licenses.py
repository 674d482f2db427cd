"""Licences of files: TF-IDF cosine of their parts to templates, and inheritance down the directories.

Only DataFrame functions. What is compared with the templates is every line, the whole file, and windows: where
a heavy word of a template occurs, the words around it that lie as the template's words lie around that word,
whatever lines they stand in. So a header of several lines, a notice inside a longer line and a licence text
with other text about it are each seen at the template's own length.

A template's heavy words are as many of the words that are rarest in the files as leave the rest less than the
threshold's share of its length: by Cauchy-Schwarz a part without any of them cannot reach the threshold, so
files without one end at the scan, and lines without one are not multiplied. A first pass counts the files that
hold each word of a template. Windows are taken from pieces of CHUNK words with a margin of the longest
template, so that no row grows with the occurrences in a file.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.llm.common import lower_ascii
from shelfsense.llm.licence_templates import TEMPLATES
from shelfsense.operators.spread import spread_join
from shelfsense.sources.session import release_shuffles, stored

THRESHOLD = 0.7
CHUNK = 1024
DOMINANT = 0.5  # share of a file's words in its licence line from which the file stands for its directory
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)[^/]*$"

# Short notices of public licences, as they are commonly written.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_WORD = r"spdx-license-identifier: ?[a-z0-9.+\-]+|[a-z0-9]+(?:[.\-][a-z0-9]+)*"  # an identifier is one word with its tag
ALL_TEMPLATES = NOTICES + TEMPLATES


def _words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(_WORD), F.lit(0))


def notice_words(notices: Sequence[tuple[str, str]]) -> tuple[list[tuple], float]:
    """``(notice, licence, word, weight, idf)``, notices of unit length; and an unseen word's weight.

    The inverse document frequency is that of the notices; a word of no notice weighs as much as the rarest.
    """
    bags = [Counter(re.findall(_WORD, text.lower())) for _, text in notices]
    spread = Counter(w for bag in bags for w in bag)
    idf = {w: math.log((len(bags) + 1) / (n + 0.5)) for w, n in spread.items()}
    rows = []
    for i, ((licence, _), bag) in enumerate(zip(notices, bags)):
        weights = {w: n * idf[w] for w, n in bag.items()}
        length = math.sqrt(sum(v * v for v in weights.values()))
        rows += [(i, licence, w, v / length, idf[w]) for w, v in weights.items()]
    return rows, math.log((len(bags) + 1) / 0.5)


def heavy_words(rows: list[tuple], files_with: dict[str, int], threshold: float) -> list[tuple[int, str]]:
    """``(notice, word)``: a part at the threshold has one word at least; each notice leaves out its commonest first."""
    heavy: set[tuple[int, str]] = set()
    by_notice: dict[int, list[tuple]] = {}
    for notice, _, word, weight, _ in rows:
        by_notice.setdefault(notice, []).append((-files_with.get(word, 0), weight, word))
    for notice, words in by_notice.items():
        rest = 0.0
        for _, weight, word in sorted(words):
            if rest + weight**2 < 0.999 * threshold**2:
                rest += weight**2
            else:
                heavy.add((notice, word))
    return sorted(heavy)


def _constants(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """A fixed table from one constant of the plan."""
    names = [field.split()[0] for field in fields.split(", ")]
    return spark.range(1).select(F.explode(_constant([dict(zip(names, r)) for r in rows], f"array<struct<{fields}>>")).alias("r")).select("r.*")


def _constant(value: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _known_words(words: Iterable[str]) -> Column:
    return F.split(F.lit("\n".join(sorted(set(words)))), "\n")


def _directory(path: Column) -> Column:
    """Everything before the last slash; a path without one is in the root, the empty directory."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def _lines(files: DataFrame) -> DataFrame:
    lines = files.select("path", "of", F.posexplode_outer(F.split("text", "\n")).alias("place", "line"))
    return lines.select("path", "of", F.lit("line").alias("part"), "place", _words(F.col("line")).alias("words"))


def _whole(files: DataFrame) -> DataFrame:
    return files.select("path", "of", F.lit("file").alias("part"), F.lit(0).alias("place"), _words(F.col("text")).alias("words"))


def _windows(files: DataFrame, heavy: list[tuple[int, str]], notices: Sequence[tuple[str, str]]) -> DataFrame:
    """For every heavy word of every template, the words that lie around its occurrences as they do in the template.

    ``place`` is the position of the window's first word; a window is cut where the text begins or ends.
    """
    texts = [re.findall(_WORD, text.lower()) for _, text in notices]
    frames: dict[str, set[tuple[int, int]]] = {}  # words before, and in all
    for notice, word in heavy:
        frames.setdefault(word, set()).add((texts[notice].index(word), len(texts[notice])))
    margin = max(len(t) for t in texts)
    start = F.sequence(F.lit(0), F.size("words") - 1, F.lit(CHUNK))
    chunks = files.select("path", "of", _words(F.col("text")).alias("words")).where("of > 0").select(
        "path", "of", F.explode(F.transform(start, lambda k: F.struct(
            k.alias("start"),
            F.least(k, F.lit(margin)).alias("before"),
            F.slice("words", F.greatest(k - margin, F.lit(0)) + 1, F.least(k, F.lit(margin)) + CHUNK + margin).alias("near"),
        ))).alias("c"),
    ).select("path", "of", "c.*")
    words = _known_words(frames)
    chunks = chunks.where(F.arrays_overlap("near", words))
    spots = chunks.select(
        "path", "of", "start", "before", "near",
        F.transform(
            F.filter(
                F.transform("near", lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
                lambda x: x["word"].isin(sorted(frames)) & (x["at"] >= F.col("before")) & (x["at"] < F.col("before") + CHUNK),
            ),
            lambda x: F.struct(x["at"].alias("at"), F.array_position(words, x["word"]).cast("int").alias("word")),
        ).alias("spots"),
    )
    shapes = _constant([[{"b": b, "n": n} for b, n in sorted(frames[w])] for w in sorted(frames)], "array<array<struct<b int, n int>>>")
    cuts = F.array_distinct(F.flatten(F.transform("spots", lambda x: F.transform(
        F.element_at(shapes, x["word"]), lambda f: F.struct((x["at"] - f["b"]).alias("first"), (x["at"] - f["b"] + f["n"]).alias("end"))
    ))))
    cut = spots.select("path", "of", "start", "before", F.explode(F.transform(cuts, lambda c: F.struct(
        c["first"].alias("first"), F.slice("near", F.greatest(c["first"], F.lit(0)) + 1, c["end"] - F.greatest(c["first"], F.lit(0))).alias("words")
    ))).alias("w"))
    return cut.select(
        "path", "of", F.lit("window").alias("part"), (F.col("start") - F.col("before") + F.greatest("w.first", F.lit(0))).alias("place"), "w.words"
    ).distinct()


def _matches(
    files: DataFrame, path_col: str, text_col: str, notices: Sequence[tuple[str, str]], threshold: float, parts: Sequence[str]
) -> DataFrame:
    rows, unseen = notice_words(notices)
    files = files.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    noted = _known_words(r[2] for r in rows)
    holders = files.select(F.explode_outer(F.array_intersect(_words(F.col("text")), noted)).alias("word")).groupBy("word").count().collect()
    heavy = heavy_words(rows, {r["word"]: r["count"] for r in holders}, threshold)  # a row per word of a template
    any_heavy = _known_words(w for _, w in heavy)
    likely = stored(files.where(F.arrays_overlap(_words(F.col("text")), any_heavy)).withColumn("of", F.size(_words(F.col("text")))), "likely-files")
    units = [
        {"line": _lines, "file": _whole, "window": lambda f: _windows(f, heavy, notices)}[part](likely) for part in parts
    ]
    worded = reduce(DataFrame.union, units).where(F.arrays_overlap("words", any_heavy))
    key = ["path", "of", "part", "place", "n_words"]
    counts = stored(
        worded.select("path", "of", "part", "place", F.size("words").alias("n_words"), F.explode("words").alias("word"))
        .groupBy(*key, "word").agg(F.count(F.lit(1)).alias("n")),
        "licence-words",
    )
    postings = F.broadcast(_constants(files.sparkSession, rows, "notice int, licence string, word string, weight double, idf double"))  # the templates' words, a fixed table
    known = F.broadcast(_constants(files.sparkSession, sorted({(r[2], r[4]) for r in rows}), "word string, idf double"))
    weighed = counts.join(known, "word", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(unseen)))
    lengths = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    products = weighed.drop("idf").join(postings.drop("idf"), "word").groupBy(*key, "notice", "licence").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot"), F.count(F.lit(1)).alias("shared")
    )
    single = [notice for notice, n in Counter(r[0] for r in rows).items() if n == 1]
    enough = (F.col("shared") >= 2) | F.col("notice").isin(single)
    right = lengths.toDF("p", "o", "q", "l", "m", "length")
    same = F.col("path").eqNullSafe(F.col("p")) & (F.col("of") == F.col("o")) & (F.col("part") == F.col("q")) & (F.col("place") == F.col("l")) & (F.col("n_words") == F.col("m"))
    scored = products.join(right, same).withColumn("similarity", F.round(F.col("dot") / F.col("length"), 6))
    best = F.max_by(F.struct("licence", "similarity"), F.struct("similarity", -F.col("notice"))).alias("best")
    return scored.where((F.col("similarity") >= threshold) & enough).groupBy(*key).agg(best).select(*key, "best.licence", "best.similarity")


def licence_lines(files: DataFrame, path_col: str, text_col: str, notices: Sequence[tuple[str, str]] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """``path, line_no, licence, similarity, n_words``: the best notice of every line at the threshold."""
    found = _matches(files, path_col, text_col, notices, threshold, ["line"])
    return found.select("path", F.col("place").alias("line_no"), "n_words", "licence", "similarity")


def licence_parts(
    files: DataFrame, path_col: str, text_col: str, templates: Sequence[tuple[str, str]] = ALL_TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """``path, of, part, place, n_words, licence, similarity``: the best template of every line, window and file at the threshold.

    ``part`` is line, window or file; ``place`` is the line's number, the window's first word, or 0; ``of``
    counts the words of the file, ``n_words`` those of the part.
    """
    return _matches(files, path_col, text_col, templates, threshold, ["line", "window", "file"])


def file_licences(
    files: DataFrame, path_col: str = "path", text_col: str = "text", notices: Sequence[tuple[str, str]] = ALL_TEMPLATES,
    threshold: float = THRESHOLD, dominant: float = DOMINANT, licence_file: str = LICENCE_FILE,
) -> DataFrame:
    """One row per file: the path, ``licence, similarity, origin, licence_dir``.

    ``origin`` is ``own`` where a line, a window or the whole of the file is like a template (the most similar
    part counts, then the longest, the first, and the first licence by name), ``inherited`` where the nearest directory at or above the file has a licence file, else null. A file
    is a licence file if it has a licence of its own and its name says so or the notice has at least
    ``dominant`` of its words; of several in a directory the most similar counts, then the smallest path. Null
    and empty texts have no own licence; a null path inherits nothing; rows that repeat a path share the best
    licence found under it; other columns are not read; an empty table gives an empty result.
    """
    release_shuffles(files.sparkSession)
    found = licence_parts(files, path_col, text_col, notices, threshold)
    own = stored(
        found.groupBy("path").agg(
            F.min_by(
                F.struct("licence", "similarity"), F.struct(-F.col("similarity"), -F.col("n_words"), "place", "licence")
            ).alias("best"),
            F.max(F.col("n_words") / F.col("of")).alias("share"),
        ),
        "own-licences",
    )
    names = own.select(F.col("path").alias("own_path"), "best", "share")
    same = F.col("path").eqNullSafe(F.col("own_path"))
    rows = stored(files.select(F.col(path_col).alias("path")).join(names, same, "left").withColumn("dir", _directory(F.col("path"))), "licensed-files")

    stands = F.col("path").rlike(licence_file) | (F.col("share") >= dominant)
    owned = rows.where(F.col("best").isNotNull() & F.col("path").isNotNull() & stands)
    by_dir = owned.groupBy("dir").agg(F.min_by("best", F.struct(-F.col("best.similarity"), "path")).alias("dir_best"))
    # directories with the licence of the nearest one above: a path has as many ancestors as it has slashes
    dirs = rows.where("path IS NOT NULL").select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.select(
        "dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("above")
    ).distinct()
    held = above.join(by_dir.withColumnRenamed("dir", "above"), "above")
    nearest = stored(
        held.groupBy("dir").agg(F.max_by(F.struct("above", "dir_best"), F.length("above")).alias("near")), "directory-licences"
    )
    joined = spread_join(rows, nearest, ["dir"], "left")
    has, inherits = F.col("best").isNotNull(), F.col("near").isNotNull()
    return joined.select(
        F.col("path").alias(path_col),
        F.when(has, F.col("best.licence")).otherwise(F.col("near.dir_best.licence")).alias("licence"),
        F.when(has, F.col("best.similarity")).otherwise(F.col("near.dir_best.similarity")).alias("similarity"),
        F.when(has, "own").when(inherits, "inherited").alias("origin"),
        F.when(~has, F.col("near.above")).alias("licence_dir"),
    )
