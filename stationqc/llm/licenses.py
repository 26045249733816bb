"""Licence scans: sparse TF-IDF cosine of lines and whole texts to templates, then inheritance from the nearest ancestor directory.

A document is a file at /<source>/<lang>/<doc_id> unless the table has a `path`. Its units are its lines (headers and notices) and its whole text (a licence
file). Terms are runs of ASCII letters and digits in lower case; a term of the templates weighs its count times its inverse frequency over all
documents, any other term 1 per occurrence. A unit whose cosine to a template reaches THRESHOLD has that licence; the best unit is the file's own.

Notices are short, and whole licences are not like them: a whole text is compared with whole licences (`license_files`) too, by the same cosine, with the terms
of these as the vocabulary. As common words make long English texts alike, it also has to have half of a licence's distinct terms, so only texts that
have them are weighed; a text too short to hold the shortest of them is not even split.

A unit that has none of a template's heaviest terms can't reach the threshold: its cosine is at most the share of the template's norm that the lighter terms
hold. So only texts with one of these terms (`anchors`) are split into units; this leaves out nothing.

A file whose whole text is a licence gives it to its directory (the best cosine, then the least path). Files without their own take that of the nearest
directory above them. Null texts have no licence of their own; null sources and languages make the directory "-". Repeated rows are files each.
All on built-in functions; what reaches the driver is one number per template term.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm.common import let, read, written
from stationqc.llm.license_files import FILES

THRESHOLD = 0.6

#: The notices by which public licences ask to be named, and their common short forms.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

_FORMS = [(name, Counter(re.findall("[a-z0-9]+", form.lower()))) for name, forms in TEMPLATES.items() for form in forms]
VOCABULARY = sorted({t for _, terms in _FORMS for t in terms})

#: Whole licences, and the share of whose distinct terms a whole text must have.
_WHOLE = [(name, {t: int(n) for t, n in (x.split(":") for x in counted.split())}) for name, counted in FILES.items()]
WHOLE_VOCABULARY = sorted({t for _, terms in _WHOLE for t in terms})
LEAST_TERMS = 0.5
#: Bytes of directories with a licence that are given to every task, and copies of each beyond.
SMALL = 16 << 20
SALT = 32


def terms(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+"), F.lit(0)), F.lower)


def inverse_frequencies(docs: DataFrame) -> dict[str, float]:
    """Of each term of the templates and of whole licences, over all documents."""
    every = sorted({*VOCABULARY, *WHOLE_VOCABULARY})
    known = docs.sparkSession.range(1).select(F.explode(F.split(F.lit(" ".join(["", *every])), " ")).alias("term"))  # "" counts documents
    present = F.concat(F.array_distinct(terms(F.coalesce("text", F.lit("")))), F.array(F.lit("")))
    found = docs.select(F.explode(present).alias("term")).join(F.broadcast(known), "term")
    counts = {r["term"]: r["count"] for r in found.groupBy("term").count().collect()}  # a row per known term
    return {t: math.log((counts.get("", 0) + 1) / (counts.get(t, 0) + 1)) + 1 for t in every}


def _vectors(idf: dict[str, float]) -> list[tuple[str, dict[str, float]]]:
    """The forms' TF-IDF vectors of length 1."""
    found = []
    for name, counted in _FORMS:
        vector = {t: n * idf[t] for t, n in counted.items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        found.append((name, {t: w / norm for t, w in vector.items()}))
    return found


def anchors(idf: dict[str, float], threshold: float = THRESHOLD) -> list[str]:
    """Terms of which a unit has one if its cosine to some form reaches the threshold."""
    found: set[str] = set()
    for _, vector in _vectors(idf):
        rest = 1.0
        for t, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < threshold * threshold:
                break
            found.add(t)
            rest -= w * w
    return sorted(found)


def _best(unit: Column, idf: dict[str, float]) -> Column:
    """(cosine, license) of the form that is nearest to the unit's terms."""
    weights = F.create_map(*[F.lit(x) for t in VOCABULARY for x in (t, idf[t])])
    inside = lambda u: F.array_intersect(u, F.array(*map(F.lit, VOCABULARY)))

    def of(u: Column) -> Column:
        counted = F.transform(inside(u), lambda t: F.struct(t.alias("t"), F.size(F.filter(u, lambda x: x == t)).alias("n")))
        known = F.transform(counted, lambda x: F.struct(x["t"].alias("t"), x["n"].alias("n"), (x["n"] * weights[x["t"]]).alias("w")))

        def cosines(k: Column) -> Column:
            square = F.aggregate(k, F.lit(0.0), lambda a, x: a + x["w"] * x["w"])
            others = F.size(u) - F.aggregate(k, F.lit(0), lambda a, x: a + x["n"])
            norm = F.sqrt(square + others)
            each = []
            for name, vector in _vectors(idf):
                share = F.create_map(*[F.lit(x) for t, w in sorted(vector.items()) for x in (t, w)])
                dot = _dot(k, share)
                each.append(F.struct(F.round(dot / norm, 6).alias("cosine"), F.lit(name).alias("license")))
            return F.when(F.size(k) > 0, F.array_max(F.array(*each)))

        return let(known, cosines)

    return let(unit, of)


def _dot(known: Column, share: Column) -> Column:
    return F.aggregate(known, F.lit(0.0), lambda a, x: a + x["w"] * F.coalesce(F.try_element_at(share, x["t"]), F.lit(0.0)))


def _counted(found: Column) -> Column:
    """(term, n) of the distinct terms of an array."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda b: F.transform(b, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(b, k + 1), F.size(s)) - i).alias("n"))))

    return F.when(F.size(found) > 0, let(F.sort_array(found), runs))


def _whole_licenses(texts: DataFrame, idf: dict[str, float], threshold: float) -> DataFrame:
    """rid and whole (cosine, license) of the texts (rid, text) that are whole licences."""
    rows = [f"{t} {idf[t]!r} " + ",".join(str(counted.get(t, 0)) for _, counted in _WHOLE) for t in WHOLE_VOCABULARY]
    table = texts.sparkSession.range(1).select(F.explode(F.split(F.lit("\n".join(rows)), "\n")).alias("row")).select(F.split("row", " ").alias("row"))
    table = table.select(F.col("row")[0].alias("term"), F.col("row")[1].cast("double").alias("idf"), F.split(F.col("row")[2], ",").cast("array<int>").alias("of"))
    found = texts.select("rid", F.explode(_counted(terms(F.col("text")))).alias("x")).select("rid", "x.*").join(F.broadcast(table), "term", "left")
    weight = F.col("n") * F.col("idf")
    sums = [F.sum(F.coalesce(weight * weight, F.col("n").cast("double"))).alias("square")]
    for k in range(len(_WHOLE)):
        sums += [F.sum(weight * F.col("idf") * F.col("of")[k]).alias(f"dot{k}"), F.count_if(F.col("of")[k] > 0).alias(f"has{k}")]
    each = []
    for k, (name, counted) in enumerate(_WHOLE):
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in counted.items()))
        cosine = F.round(F.col(f"dot{k}") / norm / F.sqrt("square"), 6)
        each.append(F.when((cosine >= threshold) & (F.col(f"has{k}") >= LEAST_TERMS * len(counted)), F.struct(cosine.alias("cosine"), F.lit(name).alias("license"))))
    return found.groupBy("rid").agg(*sums).select("rid", F.array_max(F.array(*each)).alias("whole")).filter("whole is not null")


def _least(counted: dict[str, int]) -> int:
    """Of a licence's distinct terms, those that a whole text must have."""
    return math.ceil(LEAST_TERMS * len(counted))


def _shortest(counted: dict[str, int]) -> int:
    """Code points of the shortest text with that many of them."""
    lengths = sorted(map(len, counted))[: _least(counted)]
    return sum(lengths) + len(lengths) - 1


def _has_half(text: Column) -> Column:
    """Whether a text has half of the distinct terms of some whole licence."""
    literal = lambda some: F.split(F.lit(" ".join(sorted(some))), " ")
    has = lambda known: reduce(or_, [F.size(F.array_intersect(known, literal(counted))) >= _least(counted) for _, counted in _WHOLE])
    enough = min(_least(counted) for _, counted in _WHOLE)
    of = lambda known: F.when(F.size(known) >= enough, let(known, has)).otherwise(False)
    half = let(F.array_intersect(terms(text), literal(WHOLE_VOCABULARY)), of)
    return F.when(F.length(text) >= min(_shortest(counted) for _, counted in _WHOLE), half).otherwise(False)


def own_licenses(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, own (cosine, license of the best unit) and file (of the whole text), null below the threshold, of docs (doc_id, path, text)."""
    idf = inverse_frequencies(docs)
    pattern = r"(?i)(?<![A-Za-z0-9])(?:" + "|".join(anchors(idf, threshold)) + r")(?![A-Za-z0-9])"
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(pattern))
    units = F.transform(F.concat(F.array("text"), lines), lambda unit: _best(terms(unit), idf))
    found = F.when(F.col("text").rlike(pattern), units)
    reached = lambda u: F.when(u["cosine"] >= threshold, u)
    # Numbers of rows are stable as they are written.
    like = F.when(_has_half(F.col("text")), F.col("text"))
    out = docs.select("doc_id", "path", found.alias("units"), like.alias("text"), F.monotonically_increasing_id().alias("rid"))
    out = written(out.select("doc_id", "path", reached(F.array_max("units")).alias("own"), reached(F.get("units", F.lit(0))).alias("file"), "text", "rid"))
    whole = _whole_licenses(out.filter("text is not null").select("rid", "text"), idf, threshold)
    compared = out.filter("text is not null").drop("text").join(whole, "rid", "left")
    compared = compared.select("doc_id", "path", F.greatest("own", "whole").alias("own"), F.greatest("file", "whole").alias("file"))
    return out.filter("text is null").select("doc_id", "path", "own", "file").unionByName(compared)


def _to_directories(files: DataFrame, nearest: DataFrame) -> DataFrame:
    """Files with the row of their directory, which may hold any share of them: given to all tasks up to SMALL bytes, else in SALT copies."""
    size = nearest.agg(F.sum(F.length("dir") + F.length("from.above") + F.length("from.license") + 64)).first()[0] or 0
    if size <= SMALL:
        return files.join(F.broadcast(nearest), "dir", "left")
    copies = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return files.withColumn("salt", F.pmod(F.xxhash64("path", "doc_id"), F.lit(SALT)).cast("int")).join(copies, ["dir", "salt"], "left")


def inherited(files: DataFrame) -> DataFrame:
    """doc_id, path, license, cosine, given_by ("own", "directory" or null) and directory: where an inherited licence comes from."""
    parent = lambda path: F.regexp_extract(path, "^(.*)/[^/]*$", 1)
    files = files.withColumn("dir", parent(F.col("path")))
    given = files.filter("file is not null").groupBy("dir").agg(F.min(F.struct(-F.col("file.cosine"), F.col("path"), F.col("file.license"))).alias("best"))
    given = given.select(F.col("dir").alias("above"), F.col("best.license").alias("license"))
    # Only directories are joined to those above them: /a/b has /a/b, /a and the root.
    dirs = files.select("dir").distinct()
    depth = F.size(F.split("dir", "/"))
    above = dirs.select("dir", F.explode(F.sequence(F.lit(1), depth)).alias("depth")).withColumn("above", F.array_join(F.slice(F.split("dir", "/"), 1, F.col("depth")), "/"))
    nearest = above.join(given, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "license")).alias("from"))
    rows = _to_directories(files, written(nearest))
    return rows.select(
        "doc_id",
        "path",
        F.coalesce("own.license", "from.license").alias("license"),
        F.col("own.cosine").alias("cosine"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("from").isNotNull(), "directory").alias("given_by"),
        F.when(F.col("own").isNull(), F.col("from.above")).alias("directory"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    path = F.concat_ws("/", F.lit(""), F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    return inherited(written(own_licenses(docs.select("doc_id", path.alias("path"), "text"))))


def _oracle() -> str:
    whole = ", ".join(f"('{name}', '{counted}')" for name, counted in FILES.items())
    forms = ", ".join(f"({k}, '{name}', '{t}', {n})" for k, (name, counted) in enumerate(_FORMS) for t, n in sorted(counted.items()))
    return rf"""
WITH form(k, license, term, n) AS (VALUES {forms}),
whole_form AS (
  SELECT license, split_part(x, ':', 1) AS term, CAST(split_part(x, ':', 2) AS INT) AS n
  FROM (SELECT license, unnest(string_split(counted, ' ')) AS x FROM (VALUES {whole}) f (license, counted)) WHERE x <> ''),
vocabulary AS (SELECT DISTINCT term FROM form),
whole_vocabulary AS (SELECT DISTINCT term FROM whole_form),
d AS (SELECT row_number() OVER () AS rid, doc_id, '/' || coalesce(source, '-') || '/' || coalesce(lang, '-') AS dir, coalesce(CAST(doc_id AS VARCHAR), '-') AS file, coalesce(text, '') AS text FROM documents),
unit AS (
  SELECT rid, 0 AS u, text AS body FROM d
  UNION ALL SELECT rid, row_number() OVER (PARTITION BY rid), body FROM (SELECT rid, unnest(string_split(text, chr(10))) AS body FROM d)),
word AS (SELECT rid, u, lower(unnest(regexp_extract_all(body, '[A-Za-z0-9]+'))) AS term FROM unit),
df AS (SELECT term, count(DISTINCT rid) AS n FROM word JOIN vocabulary USING (term) WHERE u = 0 GROUP BY term),
idf AS (SELECT term, ln(((SELECT count(*) FROM d) + 1) / (coalesce(df.n, 0) + 1)) + 1 AS w FROM vocabulary LEFT JOIN df USING (term)),
form_norm AS (SELECT k, sqrt(sum(n * w * n * w)) AS norm FROM form JOIN idf USING (term) GROUP BY k),
tf AS (SELECT rid, u, term, count(*) AS n FROM word GROUP BY ALL),
unit_norm AS (SELECT rid, u, sqrt(sum(CASE WHEN w IS NULL THEN n ELSE n * w * n * w END)) AS norm FROM tf LEFT JOIN idf USING (term) GROUP BY rid, u),
dots AS (SELECT tf.rid, tf.u, form.k, form.license, sum(tf.n * w * form.n * w) AS dot FROM tf JOIN form USING (term) JOIN idf USING (term) GROUP BY ALL),
cosines AS (SELECT rid, u, license, round(dot / form_norm.norm / unit_norm.norm, 6) AS cosine FROM dots JOIN form_norm USING (k) JOIN unit_norm USING (rid, u)),
whole_df AS (SELECT term, count(DISTINCT rid) AS n FROM word JOIN whole_vocabulary USING (term) WHERE u = 0 GROUP BY term),
whole_idf AS (SELECT term, ln(((SELECT count(*) FROM d) + 1) / (coalesce(f.n, 0) + 1)) + 1 AS w FROM whole_vocabulary LEFT JOIN whole_df f USING (term)),
whole_norm AS (SELECT license, sqrt(sum(n * w * n * w)) AS norm, count(*) AS terms FROM whole_form JOIN whole_idf USING (term) GROUP BY license),
text_norm AS (SELECT rid, sqrt(sum(CASE WHEN w IS NULL THEN n ELSE n * w * n * w END)) AS norm FROM tf LEFT JOIN whole_idf USING (term) WHERE u = 0 GROUP BY rid),
whole_dots AS (
  SELECT tf.rid, f.license, sum(tf.n * w * f.n * w) AS dot, count(*) AS has
  FROM tf JOIN whole_form f USING (term) JOIN whole_idf USING (term) WHERE tf.u = 0 GROUP BY ALL),
whole_cosines AS (
  SELECT rid, 0 AS u, license, round(dot / l.norm / t.norm, 6) AS cosine
  FROM whole_dots JOIN whole_norm l USING (license) JOIN text_norm t USING (rid) WHERE has >= {LEAST_TERMS} * terms),
reached AS (SELECT * FROM (SELECT * FROM cosines UNION ALL SELECT * FROM whole_cosines) WHERE cosine >= {THRESHOLD}),
own AS (SELECT rid, max({{'c': cosine, 'l': license}}) AS b FROM reached GROUP BY rid),
file AS (SELECT rid, max({{'c': cosine, 'l': license}}) AS b FROM reached WHERE u = 0 GROUP BY rid),
given AS (SELECT dir, (min({{'c': -b.c, 'p': dir || '/' || file, 'l': b.l}})).l AS license FROM file JOIN d USING (rid) GROUP BY dir),
above AS (SELECT dir, depth, array_to_string(string_split(dir, '/')[1:depth], '/') AS above FROM (SELECT dir, unnest(range(1, len(string_split(dir, '/')) + 1)) AS depth FROM (SELECT DISTINCT dir FROM d))),
nearest AS (SELECT a.dir, max({{'d': depth, 'a': above, 'l': license}}) AS f FROM above a JOIN given g ON g.dir = a.above GROUP BY a.dir)
SELECT doc_id, d.dir || '/' || d.file AS path, coalesce(own.b.l, nearest.f.l) AS license, own.b.c AS cosine,
  CASE WHEN own.b IS NOT NULL THEN 'own' WHEN nearest.f IS NOT NULL THEN 'directory' END AS given_by,
  CASE WHEN own.b IS NULL THEN nearest.f.a END AS directory
FROM d LEFT JOIN own USING (rid) LEFT JOIN nearest USING (dir)
"""


ORACLE_SQL = _oracle()
