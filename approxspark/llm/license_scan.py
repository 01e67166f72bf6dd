"""Operator 6: licences of files by TF-IDF cosine to templates, inherited from the nearest directory.

Only DataFrame operations. Every line or sentence of a text (a header) and the text as a whole (a
licence file) is compared with templates; words weigh (1 + log tf) * idf, document frequencies being
counted over all texts, and words that no template has weigh as if no text had them. A template can
only reach the threshold where one of its weightiest words occurs (else Cauchy-Schwarz bounds the
cosine below it), so texts and segments without any such word are passed over.

Statements that span lines are compared likewise with full licence texts (``licenses/``) and standard
notices: the text as a whole (a licence file, which comes before any header within it) and windows of
as many words as the template has, one in each ``STEPS``-th part of it, so that a statement is met wherever it
begins. Line ends and comment marks part words and are no words, so that wrapped notices read as one. A text
or window is passed over where it has fewer of a template's words than the least number that can
reach the threshold (the same bound). SPDX lines name their licence by its exact identifier, as near
identifiers are other licences.

One pass over all texts writes which of the templates' words each has, with the text's SHA-256; from these
follow the document frequencies and the texts that have to be compared, each once however many files
share it. A second pass fetches these texts; nothing else carries texts or paths.

A file without a
licence of its own takes that of the nearest ancestor directory that holds a licence file: found for
each directory by joining its ancestors' paths, then joined to the files by their directory.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_scratch, store
from .hot import left_join

#: Licence statements as their projects word them (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, "
        "either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details. "
        "You should have received a copy of the GNU {0}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.")
#: Standard notices that wrap over lines (fixed values). GPL-2.0, LGPL and BSD-2-Clause are here and among the
#: full texts lest their near likes be taken for the licences of TEMPLATES.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", _GNU.format("", 3)), ("GPL-2.0", _GNU.format("", 2)), ("LGPL-3.0", _GNU.format("Lesser ", 3)), ("LGPL-2.1", _GNU.format("Lesser ", "2.1")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/ "
                     "or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
#: SPDX identifiers by licence.
SPDX = {i: lic for lic, ids in (
    ("Apache-2.0", "Apache-2.0"), ("MIT", "MIT"), ("GPL-3.0", "GPL-3.0 GPL-3.0+ GPL-3.0-only GPL-3.0-or-later"), ("GPL-2.0", "GPL-2.0 GPL-2.0+ GPL-2.0-only GPL-2.0-or-later"),
    ("LGPL-3.0", "LGPL-3.0 LGPL-3.0+ LGPL-3.0-only LGPL-3.0-or-later"), ("LGPL-2.1", "LGPL-2.1 LGPL-2.1+ LGPL-2.1-only LGPL-2.1-or-later"),
    ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), ("BSD-3-Clause", "BSD-3-Clause"), ("BSD-2-Clause", "BSD-2-Clause"), ("MPL-2.0", "MPL-2.0 MPL-2.0-no-copyleft-exception")) for i in ids.lower().split()}
#: Windows begin at every so-manieth part of a template's words.
STEPS = 16
#: Texts to compare of which every task can have a list (32 bytes and a few numbers each); beyond that they are joined by shuffling.
FEW = 200_000
WORDS = r"[^\p{L}\p{N}]+"
#: Ends of lines and of sentences.
SEGMENTS = r"\n|(?<=[.!?;])[ \t]+"


@functools.cache
def full_texts() -> tuple[tuple[str, str], ...]:
    """Licences and their whole texts, as their files under ``licenses/`` have them."""
    return tuple((p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt")))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def word_list(some: Sequence[str]) -> Column:
    """An array of words as one folded literal (thousands of literals make plans slow)."""
    return F.split(F.lit(" ".join(some)), " ")


def array_words(text: Column, vocabulary: Sequence[str]) -> Column:
    """The distinct words of a text that are in the vocabulary."""
    return F.array_intersect(words(text), word_list(vocabulary))


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _vectors(templates: Sequence[tuple[str, str]], df: dict[str, int], n: int) -> tuple[list[dict[str, float]], dict[str, float]]:
    """Templates as vectors of length 1, and the idf of their words."""
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for _, t in templates for w in template_words(t)}
    out = []
    for _, t in templates:
        v = {w: (1 + math.log(c)) * idf[w] for w, c in Counter(template_words(t)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({w: x / norm for w, x in v.items()})
    return out, idf


def _anchors(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """Words without all of which no template reaches the threshold."""
    found: set[str] = set()
    for v in vectors:
        rest = 1.0
        for w, x in sorted(v.items(), key=lambda p: (-p[1], p[0])):
            if math.sqrt(max(0.0, rest)) < threshold * 0.999:
                break
            found.add(w)
            rest -= x * x
    return sorted(found)


def _least_words(vector: dict[str, float], threshold: float) -> int:
    """How many of a template's words a text must have at least to reach the threshold."""
    have, n = 0.0, 0
    for x in sorted(vector.values(), reverse=True):
        if math.sqrt(have) >= threshold * 0.999:
            break
        have += x * x
        n += 1
    return n


def _candidates(base: DataFrame, vectors: list[dict[str, float]], threshold: float) -> DataFrame:
    """(t, of): the long templates whose words in a text weigh enough, from the words present in each text."""
    spark = base.sparkSession
    weigh = spark.createDataFrame([(i, w, x * x) for i, v in enumerate(vectors) for w, x in v.items()], "template int, w string, xx double")
    least = min(_least_words(v, threshold) for v in vectors)
    have = base.where(F.size("present") >= least).select("t", "row", F.explode("present").alias("w")).join(F.broadcast(weigh), "w")  # parameters, not data
    have = have.groupBy("row", "t", "template").agg(F.sum("xx").alias("s")).where(F.col("s") >= (threshold * 0.999) ** 2)
    return have.groupBy("t").agg(F.array_sort(F.collect_set("template")).alias("of"))


def _cosines(words_of: DataFrame, key: Sequence[str], templates: Sequence[tuple[str, str]], vectors: list[dict[str, float]], idf: dict[str, float], n: int, threshold: float) -> DataFrame:
    """Hits (key, license, score) of word lists (key, w, a row a word), each compared with every template."""
    spark = words_of.sparkSession
    known = spark.createDataFrame([(w, idf[w], [v.get(w, 0.0) for v in vectors]) for w in sorted(idf)], "w string, idf double, x array<double>")
    found = words_of.groupBy(*key, "w").agg(F.count(F.lit(1)).alias("c")).join(F.broadcast(known), "w", "left")  # parameters, not data
    y = (F.lit(1.0) + F.log(F.col("c").cast("double"))) * F.coalesce("idf", F.lit(math.log(1 + n) + 1))
    dots = [F.sum(F.coalesce(F.get("x", F.lit(i)), F.lit(0.0)) * F.col("y")).alias(f"_{i}") for i in range(len(templates))]
    sums = found.withColumn("y", y).groupBy(*key).agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("norm"), *dots)
    each = F.explode(F.array(*[F.struct(F.lit(lic).alias("license"), F.round(F.col(f"_{i}") / F.col("norm"), 6).alias("score")) for i, (lic, _) in enumerate(templates)]))
    return sums.select(*key, each.alias("h")).select(*key, "h.*").where(F.col("score") >= threshold)


def _segments(some: DataFrame, templates: Sequence[tuple[str, str]], vectors: list[dict[str, float]], idf: dict[str, float], n: int, threshold: float) -> DataFrame:
    """Hits (t, k, license, score) of the templates: k = 0 is the whole text, 1 a line or sentence."""
    pattern = r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, _anchors(vectors, threshold))) + r")(?![\p{L}\p{N}])"
    parts = F.concat(F.array(F.col("text")), F.filter(F.split("text", SEGMENTS), lambda s: s.rlike(pattern)))
    parts = some.where("anchored").select("t", F.posexplode(parts).alias("k", "s"))
    # segments are numbered within their stored text's partition: the number only groups a segment's words
    parts = parts.select("t", F.least("k", F.lit(1)).alias("k"), F.monotonically_increasing_id().alias("segment"), words(F.col("s")).alias("w"))
    parts = parts.select("t", "k", "segment", F.explode("w").alias("w"))
    return _cosines(parts, ["t", "k", "segment"], templates, vectors, idf, n, threshold).drop("segment")


def _long(some: DataFrame, templates: Sequence[tuple[str, str]], vectors: list[dict[str, float]], idf: dict[str, float], n: int, threshold: float) -> DataFrame:
    """Hits (t, k, license, score) of the long templates: k = 0 is the whole text, 1 a window of it."""
    spark = some.sparkSession
    lengths = [len(template_words(t)) for _, t in templates]
    sized = spark.createDataFrame(
        [(i, length, max(1, length // STEPS), _least_words(vectors[i], threshold), sorted(vectors[i])) for i, length in enumerate(lengths)],
        "template int, length int, step int, least int, has array<string>")
    texts = some.where(F.size("of") > 0).select("t", words(F.col("text")).alias("all"), F.explode("of").alias("template")).join(F.broadcast(sized), "template")
    texts = texts.where(F.size("all") > 0)
    enough = lambda w: F.size(F.array_intersect(w, F.col("has"))) >= F.col("least")
    window = lambda at: F.slice("all", at + 1, F.col("length"))
    starts = F.filter(F.sequence(F.lit(0), F.size("all") - 1, F.col("step")), lambda at: enough(window(at)))
    whole = F.filter(F.array(F.struct(F.lit(0).alias("k"), F.col("all").alias("w"))), lambda z: enough(z["w"]))
    cuts = F.concat(whole, F.transform(starts, lambda at: F.struct(F.lit(1).alias("k"), window(at).alias("w"))))
    windows = texts.select("t", "template", F.explode(cuts).alias("z")).select("t", "template", "z.*", F.monotonically_increasing_id().alias("window"))
    windows = windows.select("t", "template", "k", "window", F.explode("w").alias("w"))
    known = spark.createDataFrame(sorted(idf.items()), "w string, idf double")
    weigh = spark.createDataFrame([(i, w, x) for i, v in enumerate(vectors) for w, x in v.items()], "template int, w string, x double")
    found = windows.groupBy("t", "template", "k", "window", "w").agg(F.count(F.lit(1)).alias("c"))
    found = found.join(F.broadcast(known), "w", "left").join(F.broadcast(weigh), ["template", "w"], "left")  # parameters, not data
    y = (F.lit(1.0) + F.log(F.col("c").cast("double"))) * F.coalesce("idf", F.lit(math.log(1 + n) + 1))
    scores = found.withColumn("y", y).groupBy("t", "template", "k", "window").agg((F.sum(F.col("x") * F.col("y")) / F.sqrt(F.sum(F.col("y") * F.col("y")))).alias("s"))
    named = spark.createDataFrame([(i, lic) for i, (lic, _) in enumerate(templates)], "template int, license string")
    return scores.select("t", "template", "k", F.round("s", 6).alias("score")).where(F.col("score") >= threshold).join(F.broadcast(named), "template").select("t", "k", "license", "score")


def _spdx(some: DataFrame) -> DataFrame:
    """Hits of SPDX lines, by the identifiers they name."""
    line = F.explode(F.regexp_extract_all("text", F.lit(r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]*)"), F.lit(1)))
    ids = some.where("spdx").select("t", line.alias("l")).select("t", F.explode(F.split(F.lower("l"), r"[^a-z0-9.+-]+")).alias("spdx"))
    known = some.sparkSession.createDataFrame(sorted(SPDX.items()), "spdx string, license string")
    return ids.join(F.broadcast(known), "spdx").select("t", F.lit(1).alias("k"), "license", F.lit(1.0).alias("score")).distinct()


def scan(files: DataFrame, path: Column | str = "path", id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.7, long: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per file: doc_id, path, license, score, origin, from_dir.

    ``templates`` are compared with lines, sentences and whole texts, ``long`` (by default NOTICES and
    full_texts()) with windows of words and whole texts. A text that is a licence of ``long`` as a whole
    goes before headers within it.
    origin is ``header`` (a line, sentence or window of the file), ``file`` (the whole text is a licence; it also
    licenses its directory), ``inherited`` (from_dir is the directory) or null. The best score wins, then
    the licence's name; a directory with several licence files takes the best score, then name. Null and
    empty texts have no licence of their own but may inherit; a null path has no directory; rows that
    repeat an id are files of their own; an empty table gives no rows; other columns are not read.
    """
    spark = files.sparkSession
    where = F.col(path) if isinstance(path, str) else path
    rows = files.select(F.col(id_col).alias("doc_id"), where.cast("string").alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    long = (*NOTICES, *full_texts()) if long is None else long
    vocabulary = sorted({"spdx", *(w for _, t in (*templates, *long) for w in template_words(t))})
    name = F.unhex(F.sha2("text", 256)).alias("t")
    base, base_path = store(rows.select("doc_id", "path", name, array_words(F.col("text"), vocabulary).alias("present"), F.monotonically_increasing_id().alias("row")), "license-words")
    counted = base.select(F.explode(F.concat(F.array(F.lit("")), "present")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    df = {r["w"]: r["n"] for r in counted.collect()}  # a row a template word; '' counts the texts
    n = df.pop("", 0)
    vectors, idf = _vectors(templates, df, n)
    far, far_idf = _vectors(long, df, n)

    # which texts have to be compared, and with what
    anchored = F.arrays_overlap("present", word_list(_anchors(vectors, threshold)))
    need = base.where(anchored | F.array_contains("present", "spdx")).select("t", anchored.alias("anchored"), F.array_contains("present", "spdx").alias("spdx"), F.array().cast("array<int>").alias("of"))
    if long:
        need = need.unionByName(_candidates(base, far, threshold).select("t", F.lit(False).alias("anchored"), F.lit(False).alias("spdx"), "of"))
    need = need.groupBy("t").agg(F.max("anchored").alias("anchored"), F.max("spdx").alias("spdx"), F.max("of").alias("of"))
    need, need_path = store(need, "license-need")
    wanted = F.broadcast(need) if need.count() <= FEW else need
    some, some_path = store(rows.select(name, "text").join(wanted, "t").groupBy("t").agg(*[F.first(c).alias(c) for c in ("text", "anchored", "spdx", "of")]), "license-texts")

    hits = _segments(some, templates, vectors, idf, n, threshold).unionByName(_spdx(some)).withColumn("all", F.lit(False))
    if long:
        hits = hits.unionByName(_long(some, long, far, far_idf, n, threshold).withColumn("all", F.col("k") == 0))
    best = F.max_by(F.struct("license", "score", F.when(F.col("k") == 0, "file").otherwise("header").alias("origin")), F.struct("all", "score", F.col("k") == 0, "license"))
    own, _ = store(hits.groupBy("t").agg(best.alias("own")), "license-own")
    files, _ = store(left_join(base.drop("present"), own, "t", n), "licences")
    drop_scratch(spark, base_path, need_path, some_path)

    # licence files by directory, then each directory's nearest ancestor that has one
    directory = F.when(F.col("path").contains("/"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).when(F.col("path").isNotNull(), F.lit(""))
    files = files.withColumn("dir", directory)
    held = files.where("own.origin = 'file' AND dir IS NOT NULL").groupBy("dir").agg(F.max(F.struct("own.score", "own.license")).alias("l"))
    parents = files.select("dir").where("dir IS NOT NULL").distinct()
    steps = F.split("dir", "/")
    above = parents.select("dir", F.posexplode(F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(steps))), lambda i: F.array_join(F.slice(steps, 1, i), "/"))).alias("depth", "up"))
    nearest = above.join(held.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "l")).alias("near"))
    joined = left_join(files, nearest, "dir", n)
    inherits = F.col("own").isNull() & F.col("near").isNotNull()
    return joined.select(
        "doc_id", "path", F.coalesce("own.license", "near.l.license").alias("license"), F.coalesce("own.score", "near.l.score").alias("score"),
        F.coalesce("own.origin", F.when(inherits, F.lit("inherited"))).alias("origin"), F.when(inherits, F.col("near.up")).alias("from_dir"))
