"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, and inheritance by directory.

Built of DataFrame operations alone. Only words of the templates have columns in the vectors;
document frequencies are counted over all files for these words, and any other word weighs as one
that no file holds. Each distinct header is scored once, however many files carry it. An SPDX tag
is read as it stands, and a header that holds a notice word for word has its licence also where other
words make the cosine small. A file without a licence of its own takes that of the licence file in its nearest ancestor directory.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.sources.shared import stored

#: Notices by which licences are granted, by SPDX identifier.
NOTICES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0. This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, Public Domain Dedication."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License."),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Copyright (c) All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
#: Whole texts of the short licences, and the titles by which the texts of the long ones begin.
TEXTS = (
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", _BSD + _AS_IS),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _AS_IS),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
#: Fixed values; any may be replaced by the caller.
TEMPLATES = (*NOTICES, *TEXTS)

#: Words that a header holds; lines and blocks of lines without one are not compared.
CUE = r"licen[cs]e|copyright|spdx|public domain|permission is hereby granted|all rights reserved|creative commons"
#: The same as plain texts: a file without any of them is not looked at further.
CUES = ("license", "licence", "copyright", "spdx", "public domain", "permission is hereby granted", "all rights reserved", "creative commons")
#: Names of licence files.
LICENCE_FILE = r"(?i)^(un)?(licen[cs]e|copying|notice)([._-].*)?$"
LEAST_SCORE = 0.6
#: The licence expression of an SPDX tag; it names the licence, so it is read and not compared.
SPDX = r"(?i)spdx-license-identifier:[ \t]*(\(*[a-z0-9.+-]+\)*(?:[ \t]+(?:or|and|with)[ \t]+\(*[a-z0-9.+-]+\)*)*)"
#: Licence of those who grant none; any other licence of the same file goes before it.
NONE_GRANTED = "Proprietary"


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license string, notice string")


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _frequencies(files: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, weight): inverse document frequency of each template word over all files."""
    every = F.array(*[F.lit(word) for word in vocabulary])
    # One array per file of the template words it holds; only these few are shuffled, counted per task first.
    held = files.select(F.array_intersect(words_of(F.coalesce("text", F.lit(""))), every).alias("held"))
    counted = held.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    spark = files.sparkSession
    known = spark.createDataFrame([(word,) for word in vocabulary], "word string")
    total = files.agg(F.count("*").alias("files"))
    return known.join(counted, "word", "left").withColumn("files", total.select("files").scalar()).select(
        "word", weight(F.coalesce("df", F.lit(0)), F.col("files")).alias("weight"), weight(F.lit(0), F.col("files")).alias("unknown")
    )


def weight(df: Column, files: Column) -> Column:
    return F.log((files + 1) / (df + 1)) + 1


def _vectors(texts: DataFrame, idf: DataFrame, *by: str) -> DataFrame:
    """(by, word, x) of unit length for every word of ``text``; a null word stands for the others."""
    counts = texts.select(*by, F.explode(words_of(F.col("text"))).alias("word")).groupBy(*by, "word").agg(F.count("*").alias("tf"))
    unknown = idf.agg(F.max("unknown")).scalar()
    weighed = counts.join(idf.select("word", "weight"), "word", "left").withColumn("x", F.col("tf") * F.coalesce("weight", unknown))
    norms = weighed.groupBy(*by).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    known = weighed.where("weight IS NOT NULL")
    return known.join(norms, list(by)).select(*by, "word", (F.col("x") / F.col("norm")).alias("x"))


def scored(headers: DataFrame, notices: DataFrame, idf: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(key, license, score): the closest template of each header (key, header), if close enough.

    Scores are rounded to six digits; of equally close licences the first by name is taken.
    """
    left = _vectors(headers.select("key", F.col("header").alias("text")), idf, "key")
    right = _vectors(notices.select("license", "notice", F.col("notice").alias("text")), idf, "license", "notice")
    dots = left.join(right.withColumnRenamed("x", "y"), "word").groupBy("key", "license", "notice").agg(F.sum(F.col("x") * F.col("y")).alias("score"))
    close = dots.withColumn("score", F.round("score", 6)).where(F.col("score") >= least)
    best = close.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("away"), "license")).alias("best"))
    return best.select("key", "best.license", (-F.col("best.away")).alias("score"))


def stated(headers: DataFrame, notices: DataFrame) -> DataFrame:
    """(key, tagged, held): the licence that a header's SPDX tag names, and that of the longest notice it holds word for word.

    Neither depends on the number of files. A tag with one known identifier gives the name that the
    notices use, without ``-only`` or ``-or-later``; any other expression is given as written.
    """
    def phrase(text: Column) -> Column:
        return F.concat(F.lit(" "), F.array_join(words_of(text), " "), F.lit(" "))

    # The first by length, then by name, is the best one; notices are few.
    known = notices.where(F.size(words_of(F.col("notice"))) > 0).select("license", phrase(F.col("notice")).alias("said")).distinct().collect()
    known.sort(key=lambda r: (r.license == NONE_GRANTED, -len(r.said.split()), r.license))
    names = {r.license.lower(): r.license for r in known}
    tag = F.regexp_extract("header", SPDX, 1)
    plain = F.regexp_replace(F.lower(tag), r"(-only|-or-later|\+)$", "")
    named = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), plain) if names else F.lit(None)
    said = headers.select("key", F.when(tag != "", F.coalesce(named, tag)).alias("tagged"), phrase(F.col("header")).alias("said"))
    held = F.coalesce(*[F.when(F.contains(F.col("said"), F.lit(r.said)), F.lit(r.license)) for r in known], F.lit(None).cast("string"))
    return said.select("key", "tagged", held.alias("held"))


def found_in(headers: DataFrame, notices: DataFrame, idf: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(key, license, score): by SPDX tag, else the closest template, else a notice that the header holds whole."""
    both = stated(headers, notices).join(scored(headers, notices, idf, least), "key", "left")
    license = F.coalesce("tagged", "license", "held")
    score = F.when(F.col("tagged").isNotNull() | F.col("license").isNull(), 1.0).otherwise(F.col("score"))
    return both.select("key", license.alias("license"), score.alias("score")).where("license IS NOT NULL")


def _cued(text: Column) -> Column:
    """Whether a text holds a cue; it is lower-cased once and searched without regular expressions."""
    found = F.transform(F.array(F.lower(text)), lambda low: reduce(or_, [F.contains(low, F.lit(cue)) for cue in CUES]))
    return F.exists(found, lambda yes: yes)


def _blocks(text: Column) -> Column:
    """Neighbouring lines: up to lines without any sign, and up to lines that hold comment marks at most."""
    unmarked = F.regexp_replace(text, r"(?m)^[ \t]*(?:REM|dnl)\b", "")
    paragraphs = F.split(F.regexp_replace(unmarked, r"(?m)^[^A-Za-z0-9\n]+$", ""), r"\n\n+")
    return F.concat(F.split(unmarked, r"\n[ \t\r]*\n"), paragraphs)


def scan(files: DataFrame, path: str = "path", text: str = "text", notices: DataFrame | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """(path, license, score, found, given_by) for every row of ``files``.

    Headers are the lines with a cue, in any place of the text, and the blocks of neighbouring lines
    around them, so that a notice may be wrapped and set in comment marks; the whole text of a
    licence file is compared as well. ``found`` is ``header`` for a licence of the file's own, ``inherited`` for
    one taken from the directory ``given_by``, else null with no licence. A directory's licence is
    that of its closest licence file, the first by path on a tie. Null and empty texts have no
    headers; rows with a null path, or a path without slashes, lie in the root directory. Rows
    that repeat a path count as one file for its licence, the closest header winning; one that
    grants a licence goes before one that reserves all rights. Further columns are ignored.
    """
    notices = templates(files.sparkSession) if notices is None else notices
    files = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    vocabulary = sorted({r.word for r in notices.select(F.explode(words_of(F.col("notice"))).alias("word")).distinct().collect()})
    idf = stored(_frequencies(files, vocabulary))
    lines = F.filter(F.concat(F.split("text", "\n"), _blocks(F.col("text"))), lambda part: F.lower(part).rlike(CUE))
    licence_file = F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE)
    compared = F.array_distinct(F.when(licence_file, F.array_append(lines, F.col("text"))).otherwise(lines))
    # Only files with a cue are split into lines. The parts come out of a generator, so that what is inferred of them later
    # stays above it and does not split the text again.
    split = files.where(_cued(F.col("text"))).select("path", licence_file.alias("licence_file"), F.inline(F.array(F.struct(compared.alias("compared")))))
    said = split.select("path", "licence_file", F.explode("compared").alias("header"))
    # A header can be a whole file, so its words and its files are grouped by a digest of it.
    headers = stored(said.withColumn("key", F.unhex(F.sha2("header", 256))))
    # Stored, as a header that very many files hold is a hot key of the join that follows.
    best = stored(found_in(stored(headers.groupBy("key").agg(F.first("header").alias("header"))), notices, idf, least))
    order = F.struct((F.col("license") == NONE_GRANTED).alias("none"), (-F.col("score")).alias("away"), "license")
    own = stored(
        headers.select("path", "licence_file", "key").join(best, "key").groupBy("path").agg(F.min(order).alias("best"), F.first("licence_file").alias("licence_file"))
        .select("path", "best.license", (-F.col("best.away")).alias("score"), "licence_file")
    )
    first = F.min(F.struct((-F.col("score")).alias("away"), "path", "license"))
    given = own.where("licence_file").groupBy(_place(F.col("path")).alias("place")).agg(first.alias("best"))
    given = given.select("place", "best.license", (-F.col("best.away")).alias("score"))
    # Inheritance is settled once per directory, not per file.
    places = files.select(_place(F.col("path")).alias("own_place")).distinct()
    ancestors = places.select("own_place", F.explode(_ancestors(F.col("own_place"))).alias("place"))
    nearest = ancestors.join(given, "place").groupBy("own_place").agg(
        F.max(F.struct(F.length("place").alias("depth"), "place", "license", "score")).alias("near")
    ).select("own_place", F.col("near.place").alias("given_by"), F.col("near.license").alias("place_license"), F.col("near.score").alias("place_score"))
    rows = files.select("path").withColumn("own_place", _place(F.col("path")))
    joined = rows.join(own.select("path", "license", "score"), "path", "left").join(nearest, "own_place", "left")
    has_own, inherits = F.col("license").isNotNull(), F.col("place_license").isNotNull()
    return joined.select(
        "path",
        F.coalesce("license", "place_license").alias("license"),
        F.coalesce("score", "place_score").alias("score"),
        F.when(has_own, "header").when(inherits, "inherited").alias("found"),
        F.when(~has_own, F.col("given_by")).alias("given_by"),
    )


def _place(path: Column) -> Column:
    """Directory of a path with its closing slash, so that prefixes are ancestors; the root is empty."""
    return F.coalesce(F.regexp_extract(path, "^(.*/)[^/]*$", 1), F.lit(""))


def _ancestors(place: Column) -> Column:
    """The directory itself and all above it, down to the root."""
    parts = F.split(place, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/"))))
